"""The delivery log: what was tried for each planned report, and what its months prove.

The log is appended to and never changed; one event is one try, or the note that a report was
passed over because its file was there already. What a report stands at is folded from its
events, in any order and on any number of tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallymark.operators.totals import join_on

REPORT_KEY = ["state_code", "report", "from_year", "to_year"]
SUCCESS, SKIPPED, FAILED = STATUSES = ("SUCCESS", "SKIPPED", "FAILED")
#: A report that no event names.
NOT_RUN = "NOT RUN"
EVENT_SCHEMA = (
    "timestamp timestamp, state_code string, report string, from_year int, to_year int, "
    "status string, message string")


def append_events(events: DataFrame, path: str) -> None:
    """Add events to the log, a folder of CSV files with a header each."""
    events.select(*[c.split()[0] for c in EVENT_SCHEMA.split(", ")]).write.mode("append").option(
        "header", True).option("escape", '"').csv(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """All events; what is no time, year or known status is NULL."""
    read = spark.read.schema(EVENT_SCHEMA).option("header", True).option("escape", '"').csv(path)
    return read.withColumn("status", F.when(F.col("status").isin(*STATUSES), F.col("status")))


def standing(events: DataFrame) -> DataFrame:
    """Per report: tries, failures, the last event and when it was first delivered.

    Equal times go to the status and message that come last in the alphabet. Events without a
    known status tell nothing.
    """
    known = events.filter(F.col("status").isNotNull())
    tried = F.col("status") != SKIPPED
    # Structs compare field by field; a NULL time is before all others.
    last = F.max(F.struct("timestamp", "status", F.coalesce("message", F.lit("")).alias("message")))
    return known.groupBy(*REPORT_KEY).agg(
        F.count_if(tried).alias("attempts"),
        F.count_if(F.col("status") == FAILED).alias("failures"),
        last.alias("_last"),
        F.min(F.when(F.col("status") == SUCCESS, F.col("timestamp"))).alias("first_success"),
    ).select(
        *REPORT_KEY, "attempts", "failures", F.col("_last.status").alias("last_status"),
        F.col("_last.timestamp").alias("last_time"), F.col("_last.message").alias("last_message"),
        "first_success")


def _verdict(logged: Column, found: Column) -> Column:
    done = logged.isin(SUCCESS, SKIPPED)
    return (
        F.when(done & (found == "DELIVERED"), "DONE")
        .when(found == "MISMATCH", "WRONG MONTHS")
        .when(done, "LOST")
        .when(found == "DELIVERED", "NOT LOGGED")
        .when(logged == FAILED, "RETRY")
        .otherwise("OPEN"))


def run_status(coverage: DataFrame, events: DataFrame) -> DataFrame:
    """Every planned report: what the log says, what its months prove, and what follows.

    ``coverage`` has the planned reports with DELIVERED, MISMATCH or MISSING. DONE: both agree.
    LOST: the log knows a delivery that is not there. NOT LOGGED: the file is there and no event
    tells of its delivery. WRONG MONTHS: the file is there and its months are others. RETRY: the
    last try failed. OPEN: neither tried nor there.
    """
    joined = join_on(coverage.withColumnRenamed("status", "found"), standing(events), REPORT_KEY, "left")
    logged = F.coalesce("last_status", F.lit(NOT_RUN))
    return joined.select(
        *REPORT_KEY, F.coalesce("attempts", F.lit(0)).alias("attempts"),
        F.coalesce("failures", F.lit(0)).alias("failures"), logged.alias("last_status"),
        "last_time", "last_message", "first_success", "found",
        _verdict(logged, F.col("found")).alias("verdict"))


def to_fetch(status: DataFrame) -> DataFrame:
    """The reports that a next run has to fetch: all that are not there with their own months."""
    return status.filter(F.col("found") != "DELIVERED").select(*REPORT_KEY)


def strangers(coverage: DataFrame, events: DataFrame) -> DataFrame:
    """What the log tells of reports that nobody planned."""
    return join_on(standing(events), coverage, REPORT_KEY, "left_anti")
