"""Stage tables, worker set-up and column helpers shared by the operators."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

CHECKPOINT_SETTING = "spark.checkpoint.dir"
#: Bytes of text that a task works on at a time.
CHUNK_BYTES = 8 << 20
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package where it lies at the same place.

    On a cluster the package is sent with ``--py-files`` as usual.
    """
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), _ROOT])


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share.

    That is ``spark.checkpoint.dir``; a session without it uses its warehouse.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or (
        spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/stages")
    return f"{folder.rstrip('/')}/llm-{uuid.uuid4().hex[:12]}/{name}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame written once as Parquet and read back; cuts lineage safely."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """The frame written once in buckets of ``key``: joins by it shuffle the other side only.

    Spark keeps buckets of tables alone, so there is a table for as long as it takes to read it
    back; its files are not the catalog's and stay.
    """
    spark = df.sparkSession
    own = f"{name}_{uuid.uuid4().hex}"
    (df.write.format("parquet").option("compression", "zstd").option("path", scratch(spark, name))
     .bucketBy(shuffle_parts(spark), key).saveAsTable(own))
    kept = spark.table(own)
    spark.sql(f"DROP TABLE {own}")
    return kept


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_memories: list[dict] = []


def memory() -> dict:
    """An empty dict for what an operator keeps in a worker from task to task."""
    _memories.append({})
    return _memories[-1]


def forget() -> None:
    """Empty all such dicts: a worker serves several operators and need not hold what all knew."""
    for kept in _memories:
        kept.clear()


def text_bytes(column: str = "text") -> Column:
    """The text as UTF-8 bytes, null as empty: workers then decode nothing needlessly."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b"").cast("binary"))


def lower_ascii(column: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def extended(kept: DataFrame, added: str) -> StructType:
    """The columns of ``kept`` followed by those of a schema text."""
    return StructType([*kept.schema.fields, *StructType.fromDDL(added).fields])


#: Columns of documents that operators know by name.
KNOWN = ("doc_id", "text", "source", "lang", "n_chars")


def out_of_the_way(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The documents with all other columns renamed, and the names to give back.

    A stage may then name columns of its own as it likes.
    """
    back = {f"x{i}": c for i, c in enumerate(docs.columns) if c not in KNOWN}
    return docs.withColumnsRenamed({c: x for x, c in back.items()}), back


def by_size(values: list[bytes], limit: int = CHUNK_BYTES):
    """Ranges (start, end) of consecutive values with about ``limit`` bytes each."""
    return by_length(map(len, values), limit)


def by_length(lengths, limit: int):
    """Ranges (start, end) of consecutive lengths that add up to about ``limit``."""
    start = size = end = 0
    for end, length in enumerate(lengths, 1):
        size += length
        if size >= limit:
            yield start, end
            start, size = end, 0
    if start < end:
        yield start, end
