"""Silver, log and summary tables on disk."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymark.operators.totals import join_on
from tallymark.plans.gold import Gold
from tallymark.plans.silver import silver_sorted
from tallymark.schemas import DQ_LOG_SCHEMA, SILVER_SCHEMA
from tallymark.sources.workspace import written


#: A report covers some years of one type, so a changed report touches few of these.
SILVER_PARTITION = ["dataset_type", "year"]


def _silver_writer(df: DataFrame):
    return silver_sorted(df, SILVER_PARTITION).write.mode("overwrite").partitionBy(*SILVER_PARTITION)


def write_silver(df: DataFrame, path: str) -> None:
    """Full refresh of the Silver table, one partition per dataset type and year, rows sorted."""
    _silver_writer(df).parquet(path)


def touched_partitions(old: DataFrame, new: DataFrame, changed: DataFrame) -> DataFrame:
    """Type and year of every partition with a row of a ``changed`` source, before or after.

    A type or year that is NULL is a partition of its own.
    """
    both = old.select("source_file", *SILVER_PARTITION).unionByName(
        new.select("source_file", *SILVER_PARTITION))
    return join_on(both, changed.select("source_file").distinct(), ["source_file"], "left_semi"
                   ).select(*SILVER_PARTITION).distinct()


def refresh_silver(new: DataFrame, path: str, changed: DataFrame) -> DataFrame:
    """Bring the Silver table at ``path`` up to ``new`` where ``changed`` sources have rows.

    ``new`` is the whole table as it is to be and must not read the table at ``path``. Only the
    partitions that a changed source has or had rows in are read from it and replaced; all other
    files stay as they are. Partitions left without a row are removed. Returns the touched
    partitions.
    """
    spark = new.sparkSession
    touched = written(touched_partitions(read_silver(spark, path), new, changed), "touched")
    rows = join_on(new, touched, SILVER_PARTITION, "left_semi")
    _silver_writer(rows).option("partitionOverwriteMode", "dynamic").parquet(path)
    left = rows.select(*SILVER_PARTITION).distinct()
    for gone in join_on(touched, left, SILVER_PARTITION, "left_anti").toLocalIterator():
        remove_partition(spark, path, gone.asDict())
    return touched


def remove_partition(spark: SparkSession, path: str, values: dict) -> None:
    """Take one partition's folder away, on whatever file system the table lies."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    folder = "/".join([path, *[
        names.getPartitionPathString(name, None if value is None else str(value))
        for name, value in values.items()]])
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SILVER_SCHEMA).parquet(path).select(*SILVER_SCHEMA.fieldNames())


def write_gold(gold: Gold, folder: str) -> None:
    """Replace the eight Gold tables below ``folder``.

    Facts keep the order of Silver, so their files still have narrow value ranges.
    """
    def write(item):
        name, df = item
        df.write.mode("overwrite").parquet(f"{folder}/{name}")

    # The tables do not depend on each other; small ones need not wait for large ones.
    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(write, gold.tables().items()))


def read_gold(spark: SparkSession, folder: str, like: Gold) -> Gold:
    """The written tables, with the types of ``like``."""
    return Gold(**{
        name: spark.read.schema(df.schema).parquet(f"{folder}/{name}")
        for name, df in like.tables().items()
    })


def write_csv(df: DataFrame, path: str) -> None:
    """Exchange files: quoted text, header line, NULL as the word NULL."""
    (
        df.write.mode("overwrite").option("header", True).option("nullValue", "NULL")
        .option("escape", '"').csv(path)
    )


def read_typed_csv(spark: SparkSession, path: str, schema=SILVER_SCHEMA) -> DataFrame:
    """Exchange files by the given types. Empty text and NULL give NULL; a row that does
    not fit the types stops the job."""
    loaded = (
        spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
        .option("nullValue", "NULL").option("escape", '"').csv(path)
    )
    empty_to_null = {
        f.name: F.nullif(F.col(f.name), F.lit(""))
        for f in schema if f.dataType.typeName() == "string"
    }
    return loaded.withColumns(empty_to_null)


def append_log(spark: SparkSession, path: str, entry: dict) -> None:
    """Add one stage outcome to the data-quality log."""
    row = spark.createDataFrame(
        [(None, entry["stage"], entry["status"], entry["rows_checked"],
          entry["critical_error_count"], entry["details"])], DQ_LOG_SCHEMA)
    row.withColumn("timestamp", F.current_timestamp()).write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DQ_LOG_SCHEMA).parquet(path)


def publish(spark: SparkSession, folder: str, run: str) -> None:
    """Make a finished run the current one, by one appended row."""
    spark.createDataFrame([(run,)], "run string").withColumn(
        "published", F.current_timestamp()).write.mode("append").parquet(f"{folder}/published")


def current_run(spark: SparkSession, folder: str) -> str | None:
    """Path of the run published last below ``folder``."""
    row = spark.read.schema("run string, published timestamp").parquet(f"{folder}/published").agg(
        F.max_by("run", "published").alias("run")).first()
    return row["run"]


def replace_summary(summary: DataFrame, path: str) -> None:
    """Write the validation summary of this run in place of the last one."""
    summary.withColumn("validation_date", F.current_timestamp()).write.mode("overwrite").parquet(path)
