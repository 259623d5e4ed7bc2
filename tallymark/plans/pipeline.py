"""The whole run: report lines to Gold, with a gate after each stage."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymark.functions.reports import DEFAULT_NAMING, ReportNaming
from tallymark.operators import keys
from tallymark.plans import bronze, quality, reconciliation, silver, views
from tallymark.plans.gold import Gold, build_gold
from tallymark.plans.silver import GateError
from tallymark.schemas import SILVER_COLUMNS, UNIFIED_COLUMNS, VALID_YEARS
from tallymark.sources import tables


@dataclass(frozen=True)
class Medallion:
    """What a run leaves: Silver, Gold over it, what was refused and why, and the checks."""

    path: str
    silver: DataFrame
    gold: Gold
    rejects: DataFrame
    failures: DataFrame
    structure: DataFrame
    dedup_log: DataFrame
    reconciliation: dict[str, DataFrame]
    summary: DataFrame


def _check(spark, df: DataFrame, report: DataFrame, stage: str, columns, log: str) -> None:
    errors = quality.schema_errors(df, columns)
    entry = quality.stage_result(report, stage, df.count(), errors)
    tables.append_log(spark, log, entry)
    if entry["status"] == "FAIL":
        raise GateError(f"{stage} failed: {entry['details']}")


def run_medallion(
    spark: SparkSession, lines: DataFrame, states: DataFrame, folder: str,
    naming: ReportNaming = DEFAULT_NAMING, years=VALID_YEARS, with_views: bool = False,
) -> Medallion:
    """Consolidate, transform, validate, remove repeats, load, build Gold, reconcile.

    A run writes its tables to a new folder below ``folder``, which all executors must
    reach, and is published by one row appended after the last check. A stage that fails
    raises: what was published before stays as it is. Every table is written once and
    then read by all checks, so no check computes the reports again.
    """
    run = f"{folder}/run-{uuid.uuid4().hex[:12]}"
    log = f"{folder}/dq_log"

    def kept(df: DataFrame, name: str) -> DataFrame:
        path = f"{run}/{name}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    reports = bronze.parse(lines, naming, kept(bronze.find_heads(lines, naming), "heads"))
    failures = kept(bronze.failures(reports, naming), "failures")
    structure = kept(bronze.structure_check(reports), "structure")
    unified = kept(bronze.unify(reports), "unified")
    unified_key = ["dataset_type", "dimension_value", "period", "source_file"]
    unified_report = quality.dq_unified(
        unified.withColumn("date", F.to_date("period")), years, unified_key)
    _check(spark, unified, unified_report, "unified_validation", UNIFIED_COLUMNS, log)

    accepted, rejected = silver.transform(silver.unified_names(unified), states, naming, years)
    staged, rejects = kept(accepted, "silver_staged"), kept(rejected, "silver_rejects")
    # The one shuffle by the business key; every later question about keys reads this table.
    state = kept(keys.key_state(staged), "silver_keys")
    _check(spark, staged, quality.dq_silver(staged, years, state=state), "silver_validation",
           SILVER_COLUMNS, log)

    counts = keys.state_counts(state)
    dedup_log = kept(keys.summary_of(counts), "dedup_log")
    if dedup_log.filter("conflicting_value_groups > 0").limit(1).count():
        silver.require_no_conflicts(staged)
    loadable = silver.drop_aggregates(keys.first_rows(state, SILVER_COLUMNS))
    tables.write_silver(loadable, f"{run}/silver")
    loaded = tables.read_silver(spark, f"{run}/silver")
    # A state has one row per key, so a key can only be repeated or lost by the load itself.
    expected, found = silver.drop_aggregates(state).count(), loaded.count()
    if expected != found:
        raise GateError(f"{found} rows were loaded for {expected} business keys")

    planned = build_gold(loaded)
    tables.write_gold(planned, f"{run}/gold")
    gold = tables.read_gold(spark, f"{run}/gold", planned)
    checks = {
        "by_dataset": kept(reconciliation.reconcile_by_dataset(loaded, gold), "reconcile_by_dataset"),
        "overall": kept(reconciliation.reconcile_overall(loaded, gold), "reconcile_overall"),
        "metrics": kept(reconciliation.reconcile_metrics(loaded, gold), "reconcile_metrics"),
    }
    summary_path = f"{run}/validation_summary"
    tables.replace_summary(reconciliation.validation_summary(loaded, gold), summary_path)
    summary = spark.read.parquet(summary_path).drop("validation_date")
    if summary.filter("status = 'FAIL'").limit(1).count():
        raise GateError("Silver and Gold row counts differ")
    if checks["overall"].filter("overall_status <> 'PASS'").limit(1).count():
        raise GateError("Silver and Gold do not reconcile")
    tables.publish(spark, folder, run)
    if with_views:
        views.register_views(gold)
    return Medallion(
        run, loaded, gold, rejects, failures, structure, dedup_log, checks, summary)
