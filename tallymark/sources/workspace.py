"""Tables written on the way, in the folder that every executor can reach."""

from __future__ import annotations

import hashlib
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """Where intermediate tables go: the folder that ``spark.checkpoint.dir`` names.

    A session that names none uses its warehouse, which executors reach as well.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return (named or f"{warehouse}/stages").rstrip("/")


def table_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared folder that no other application uses."""
    return "/".join([
        shared_folder(spark), f"tallymark-{spark.sparkContext.applicationId}", *parts])


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written once and read back: what it draws or samples is settled."""
    path = table_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def digest(*parts) -> str:
    return hashlib.sha1("\x00".join(map(str, parts)).encode()).hexdigest()[:16]


class TableStore:
    """Tables that are written once per application and then read as Parquet.

    The path of a table tells the list of files it came from; new input files give a
    new table.
    """

    def __init__(self) -> None:
        self._written: set[str] = set()
        self._number = 0
        # One table may need another, so the same thread may enter twice.
        self._lock = threading.RLock()

    def next_number(self) -> int:
        """A number no earlier table of this application has."""
        self._number += 1
        return self._number

    def ensure(self, path: str, build) -> None:
        """Write the table unless this application already has."""
        self.once(path, lambda: build().write.mode("overwrite").parquet(path))

    def once(self, path: str, write) -> None:
        """Let ``write`` make what is to lie at the path, unless it lies there already."""
        with self._lock:
            if path not in self._written:
                write()
                self._written.add(path)
