"""Named analyses as functions of (session, folder of order tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymark.functions.numbers import rounded
from tallymark.operators import checks, keys
from tallymark.plans import (
    analytics, bronze, gold, measures, pipeline, quality, reconciliation, run_log, silver, views)
from tallymark.schemas import (
    CATEGORY, FUEL, GRAINS, MANUFACTURER, MEASURE, UNIFIED_TO_SILVER)
from tallymark.sources import tables
from tallymark.sources.market import Market, row_hash

# Rendered reports with foreign months name years this much later.
FOREIGN_YEARS = 7
MIN_BASE = 20
CORRELATION_DIGITS = 8


def comparable(df: DataFrame) -> DataFrame:
    """Whole numbers of any width as bigint."""
    narrow = ("byte", "short", "integer")
    return df.select(*[
        F.col(f.name).cast("bigint").alias(f.name) if f.dataType.typeName() in narrow
        else F.col(f.name)
        for f in df.schema
    ])


# --- Bronze ---------------------------------------------------------------

def _reports(m: Market) -> bronze.Reports:
    return bronze.parse(m.report_lines(), heads=m.report_heads())


def _files(m: Market) -> DataFrame:
    return m.report_lines().select("source_file").distinct()


def _scan(m):
    return m.scanned_lines().groupBy("source_file").agg(F.count("*").alias("line_count"))


def _cells(m):
    rows = bronze.body(_reports(m))
    return rows.select(
        "source_file", F.size("cells").alias("cell_count"),
        F.array_join("cells", "|").alias("cells"))


def _unpivoted(m):
    return bronze.unpivot_months(bronze.body(_reports(m)))


_CELL = ["source_file", "dataset_type", "dimension_value", "label", "cell"]


def _plan(m) -> DataFrame:
    first, last = m.years()
    single = [(y, y) for y in range(first, last + 1)]
    return bronze.report_plan(
        m.states(), {r: single for r in ("vehicle_category", "fuel", "manufacturer")})


def _coverage(m):
    return bronze.report_coverage(_plan(m), _reports(m))


def _expected_files(m):
    """A file for each state and year of each report."""
    first, last = m.years()
    planned = m.states().count() * (last - first + 1)
    return bronze.structure_summary(_reports(m), {g.dataset_type: planned for g in GRAINS})


def _events(m) -> DataFrame:
    """A log with up to three events per planned report, written in two parts and read back.

    Which events there are follows from a hash of the report, as do a damaged status here and
    there and reports that nobody planned.
    """
    h = row_hash("state_code", "report", "from_year")
    tries = _plan(m).withColumn("_h", h).select(
        "*", F.explode(F.sequence(F.lit(0), (F.col("_h") % 4).cast("int"))).alias("_i")
    ).filter("_i > 0")
    last = F.col("_i") == F.col("_h") % 4
    status = (
        F.when(~last, run_log.FAILED).when(F.col("_h") % 5 == 0, run_log.FAILED)
        .when(F.col("_h") % 7 == 0, run_log.SKIPPED).when(F.col("_h") % 11 == 0, "n/a")
        .otherwise(run_log.SUCCESS))
    events = tries.select(
        F.timestamp_seconds(1_700_000_000 + F.col("_h") % 100_000 + 60 * F.col("_i")).alias("timestamp"),
        F.when(F.col("_h") % 13 == 0, "zz").otherwise(F.col("state_code")).alias("state_code"),
        "report", "from_year", "to_year", status.alias("status"),
        F.when(status == run_log.FAILED, F.concat(F.lit('try "'), F.col("_i").cast("string"), F.lit('", failed')))
        .alias("message"))
    path = m.fresh_path("run-log")
    odd = F.col("from_year") % 2 == 1
    run_log.append_events(events.filter(odd), path)
    run_log.append_events(events.filter(~odd), path)
    return run_log.read_events(m.spark, path)


def _clocked(df: DataFrame) -> DataFrame:
    """Times as whole seconds."""
    return df.withColumns({
        f.name: F.unix_seconds(f.name) for f in df.schema if f.dataType.typeName() == "timestamp"})


def _period_attrs(m):
    cells = bronze.drop_undated(bronze.drop_summary_rows(_unpivoted(m)))
    return cells.select(
        "source_file", "dimension_value", "label", "period", "year", "month", "month_name")


def _counts(m):
    cells = bronze.drop_summary_rows(_unpivoted(m))
    return cells.select(
        "source_file", "dimension_value", "label",
        bronze.count_or_zero("cell").alias(MEASURE))


BRONZE = {
    "scan_reports": _scan,
    "classify_report": lambda m: bronze.classify(_files(m)),
    "exclude_national": lambda m: bronze.without_national(_files(m)),
    "report_lines": lambda m: bronze.header_lines(_reports(m)),
    "parse_cells": _cells,
    "unpivot_months": lambda m: _unpivoted(m).select(*_CELL),
    "drop_summary_rows": lambda m: bronze.drop_summary_rows(_unpivoted(m)).select(*_CELL),
    "coerce_counts": _counts,
    "period_attrs": _period_attrs,
    "unify_reports": lambda m: bronze.unify(_reports(m)),
    "consolidation_failures": lambda m: bronze.failures(_reports(m)),
    "report_coverage": _coverage,
    "run_status": lambda m: _clocked(run_log.run_status(_coverage(m), _events(m))),
    "reports_to_fetch": lambda m: run_log.to_fetch(run_log.run_status(_coverage(m), _events(m))),
    "unplanned_events": lambda m: _clocked(run_log.strangers(_plan(m), _events(m))),
    "bronze_expected_files": _expected_files,
    "bronze_structure_check": lambda m: bronze.structure_check(_reports(m)),
    "bronze_structure_summary": lambda m: bronze.structure_summary(_reports(m)),
    "total_reconcile": lambda m: bronze.total_reconcile(_reports(m)),
    "title_lineage": lambda m: bronze.title_lineage(_reports(m)),
    "one_report_check": lambda m: bronze.report_quality(_reports(m)),
}


# --- Silver ---------------------------------------------------------------

def _padded(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "dimension_value", F.concat(F.lit("  "), "dimension_value", F.lit("   ")))


def _as_text(df: DataFrame) -> DataFrame:
    """Numbers as the texts that files hold, some of them damaged."""
    h = row_hash("source_file", "dimension_value", "period", F.lit("text"))
    return df.select(
        "dataset_type", "state_code", "dimension_value", "period",
        F.when(h % 89 == 0, "n.a.").when(h % 83 == 0, F.concat(F.col("year").cast("string"), F.lit(".0")))
        .otherwise(F.col("year").cast("string")).alias("year"),
        F.when(h % 79 == 0, "x").otherwise(F.concat(F.lit(" "), F.col("month").cast("string"))).alias("month"),
        F.when(h % 73 == 0, "1,000").when(h % 71 == 0, "inf")
        .otherwise(F.concat(F.col(MEASURE).cast("string"), F.lit(" "))).alias(MEASURE))


def _accepted(m: Market) -> DataFrame:
    return silver.drop_exact_duplicates(silver.accepted(m.dirty(), m.years()))


def _staged(m: Market) -> DataFrame:
    """Accepted rows as the stage table that the later Silver steps read."""
    return m.stage("silver-staged", lambda: _accepted(m))


def _deduped(m: Market) -> DataFrame:
    return m.stage("silver-deduped", lambda: silver.dedup(_staged(m)))


def _written(m: Market) -> DataFrame:
    path = m.fresh_path("silver-sorted")
    tables.write_silver(_staged(m), path)
    return tables.read_silver(m.spark, path)


def _refreshed(m: Market) -> DataFrame:
    """Silver as an earlier run left it, brought up to date where a fifth of the sources changed.

    The earlier run lacks some of their rows, has other counts in some, and has a year that is
    gone by now.
    """
    staged = _staged(m)
    h = row_hash("source_file")
    changed = staged.filter(h % 5 == 0).select("source_file").distinct()
    older = staged.filter((h % 10 != 0) | (F.col("month") < 7)).withColumn(
        MEASURE, F.when(h % 5 == 0, F.col(MEASURE) + 1).otherwise(F.col(MEASURE)))
    gone = older.filter(h % 5 == 0).withColumn("year", F.lit(1899))
    path = m.fresh_path("silver-refreshed")
    tables.write_silver(older.unionByName(gone), path)
    tables.refresh_silver(staged, path, changed)
    return tables.read_silver(m.spark, path)


def _csv_round(m: Market) -> DataFrame:
    path = m.fresh_path("silver-csv")
    tables.write_csv(m.dirty(), path)
    return tables.read_typed_csv(m.spark, path)


def _state_codes(m: Market) -> DataFrame:
    return silver.with_state_code(_files(m))


SILVER = {
    "require_columns": lambda m: checks.require_columns(
        silver.unified_names(m.dirty()), UNIFIED_TO_SILVER),
    "standardise": lambda m: silver.standardise(silver.unified_names(_padded(m.dirty()))),
    "extract_state_code": _state_codes,
    "map_state": lambda m: silver.map_state(_state_codes(m), m.states()),
    "coerce_types": lambda m: silver.coerce_types(_as_text(m.dirty())),
    "reject_rows": lambda m: silver.rejected(m.dirty(), m.years()),
    "drop_exact_duplicates": _accepted,
    "silver_sort_write": _written,
    "silver_refresh": _refreshed,
    "dedup_business_key": lambda m: silver.dedup(_staged(m)),
    "dedup_conflicts": lambda m: keys.conflicts(m.dirty()),
    "dedup_log": lambda m: keys.dedup_summary(_staged(m)),
    "load_gate": lambda m: silver.load_gate(_deduped(m)),
    "load_gate_violations": lambda m: silver.gate_violations(_staged(m)),
    "silver_load": _csv_round,
    "silver_latest_sample": lambda m: silver.latest_sample(m.dirty()),
}


# --- Data quality ---------------------------------------------------------

def _dq_log(m: Market) -> DataFrame:
    """Outcome of both stage validations, read back from the log."""
    outcomes = [
        quality.stage_result(quality.dq_unified(m.dirty(), m.years()), "unified_validation", m.dirty().count()),
        quality.stage_result(quality.dq_silver(m.silver(), m.years()), "silver_validation", m.silver().count()),
    ]
    path = m.fresh_path("dq-log")
    for entry in outcomes:
        tables.append_log(m.spark, path, entry)
    return tables.read_log(m.spark, path).select("stage", "status", "rows_checked", "critical_error_count")


QUALITY = {
    "dq_unified": lambda m: quality.dq_unified(m.dirty(), m.years()),
    "dq_silver": lambda m: quality.dq_silver(m.dirty(), m.years()),
    "dq_profile": lambda m: quality.dq_profile(m.dirty(), m.years()),
    "dq_log": _dq_log,
    "duplicate_records": lambda m: keys.duplicate_records(m.dirty()),
    "duplicate_sources": lambda m: quality.duplicate_sources(m.dirty()),
    "duplicate_datasets": lambda m: quality.duplicate_datasets(m.dirty()),
    "top_duplicate_sources": lambda m: quality.top_duplicate_sources(m.dirty()),
    "multi_source_keys": lambda m: keys.multi_source_keys(m.dirty()),
    "overlap_sources": lambda m: keys.overlap_sources(m.dirty()),
    "silver_summary": lambda m: quality.summary(m.dirty()),
    "dataset_summary": lambda m: quality.dataset_summary(m.dirty()),
    "coverage_summary": lambda m: quality.coverage_summary(m.dirty()),
    "duplicate_keys": lambda m: keys.duplicate_keys(m.dirty()),
    "null_counts": lambda m: quality.null_counts(m.dirty()),
    "negative_counts": lambda m: quality.negative_counts(m.dirty()),
    "invalid_years": lambda m: quality.invalid_years(m.dirty(), m.years()),
    "invalid_months": lambda m: quality.invalid_months(m.dirty()),
    "count_statistics": lambda m: quality.count_statistics(m.dirty()),
    "null_profile": lambda m: quality.null_profile(m.dirty()),
    "silver_metric_rows": lambda m: quality.silver_metric_rows(m.dirty()),
}


# --- Gold, views, analyses, reconciliation, measures ----------------------

GOLD = {
    "dim_date": lambda m: m.gold().dim_date,
    "dim_state": lambda m: m.gold().dim_state,
    "dim_category": lambda m: m.gold().dim_category,
    "dim_fuel": lambda m: m.gold().dim_fuel,
    "dim_manufacturer": lambda m: m.gold().dim_manufacturer,
    "fact_category": lambda m: m.fact(CATEGORY),
    "fact_fuel": lambda m: m.fact(FUEL),
    "fact_manufacturer": lambda m: m.fact(MANUFACTURER),
    "gold_row_counts": lambda m: gold.gold_row_counts(m.gold()),
    "silver_vs_gold": lambda m: gold.silver_vs_gold(m.silver(), m.gold()),
    "gold_summary": lambda m: gold.gold_summary(m.gold()),
    "fact_duplicates": lambda m: gold.fact_duplicates(gold.build_gold(m.dirty())),
    "fact_null_negative": lambda m: gold.fact_null_negative(gold.build_gold(m.dirty())),
    "gold_status": lambda m: gold.gold_status(m.gold()),
}


def _per_grain(pattern: str, build) -> dict:
    def bind(grain):
        return lambda m: build(m.fact(grain), grain)

    return {pattern.format(g.name): bind(g) for g in GRAINS}


VIEWS = {
    name: query
    for pattern, build in views.VIEW_BUILDERS.items()
    for name, query in _per_grain(pattern, build).items()
}
VIEWS["vw_state_market_summary"] = lambda m: views.state_market_summary(m.gold())


def _correlation(a, b):
    def query(m):
        df = analytics.yearly_correlation(m.fact(a), a, m.fact(b), b)
        name = f"{a.name}_{b.name}_correlation"
        return df.withColumn(name, rounded(name, CORRELATION_DIGITS))

    return query


_PLURAL = {"category": "categories", "fuel": "fuels", "manufacturer": "manufacturers"}
ANALYTICS = {
    **{f"top_{_PLURAL[g.name]}": _per_grain("{}", analytics.top_values)[g.name] for g in GRAINS},
    **_per_grain("{}_year_trend", analytics.year_trend),
    "monthly_trend": lambda m: analytics.monthly_trend(m.silver()),
    **{f"top10_{_PLURAL[g.name]}_by_year": _per_grain("{}", analytics.top_values_by_year)[g.name]
       for g in GRAINS},
    "manufacturer_share": lambda m: analytics.market_share(m.fact(MANUFACTURER), MANUFACTURER, 20),
    "fuel_share": lambda m: analytics.market_share(m.fact(FUEL), FUEL),
    "category_share": lambda m: analytics.market_share(m.fact(CATEGORY), CATEGORY),
    **_per_grain("{}_yoy", analytics.year_over_year),
    "peak_month": lambda m: analytics.extreme_month(m.silver()),
    "lowest_month": lambda m: analytics.extreme_month(m.silver(), lowest=True),
    "category_fuel_comparison": lambda m: analytics.category_fuel_comparison(
        m.fact(CATEGORY), m.fact(FUEL)),
    "manufacturer_concentration": lambda m: analytics.grain_concentration(
        m.fact(MANUFACTURER), MANUFACTURER, 5, "top_5_vehicles",
        "total_reported_manufacturer_vehicles"),
    "category_concentration": lambda m: analytics.grain_concentration(
        m.fact(CATEGORY), CATEGORY, 3, "top_3_categories_vehicles",
        "total_reported_category_vehicles"),
    "fuel_concentration": lambda m: analytics.grain_concentration(
        m.fact(FUEL), FUEL, 3, "top_3_fuel_vehicles", "total_reported_fuel_vehicles"),
    "dataset_distribution": lambda m: analytics.dataset_distribution(m.silver()),
    "annual_total": lambda m: analytics.annual_total(m.silver()),
    "month_rank": lambda m: analytics.month_rank(m.silver()),
    **_per_grain("top_{}_by_year", lambda fact, g: analytics.top_values_by_year(fact, g, 1)),
    "zero_counts": lambda m: analytics.zero_counts(m.dirty()),
    "dq_summary": lambda m: analytics.dq_summary(m.dirty(), m.years()),
    "state_anomalies": lambda m: analytics.state_anomalies(m.silver()),
    "priority_anomalies": lambda m: analytics.priority_anomalies(m.silver()),
    "corr_category_fuel": _correlation(CATEGORY, FUEL),
    "corr_fuel_manufacturer": _correlation(FUEL, MANUFACTURER),
    "corr_category_manufacturer": _correlation(CATEGORY, MANUFACTURER),
}


def _medallion(m: Market) -> DataFrame:
    """The closing summary of a whole run over the rendered reports."""
    folder = m.fresh_path("medallion")
    first, last = m.years()
    return pipeline.run_medallion(
        m.spark, m.scanned_lines(), m.states(), folder, years=(first, last + FOREIGN_YEARS)).summary


RECONCILIATION = {
    "reconcile_by_dataset": lambda m: reconciliation.reconcile_by_dataset(m.silver(), m.gold()),
    # The soiled rows against Gold of the clean ones: a case that does not reconcile.
    "reconcile_soiled": lambda m: reconciliation.reconcile_by_dataset(m.dirty(), m.gold()),
    "reconcile_overall": lambda m: reconciliation.reconcile_overall(m.silver(), m.gold()),
    "reconcile_metrics": lambda m: reconciliation.reconcile_metrics(m.silver(), m.gold()),
    "validation_summary": lambda m: reconciliation.validation_summary(
        m.dirty(), gold.build_gold(m.dirty())),
    "run_medallion": _medallion,
}

MEASURES = {
    "coverage_table": lambda m: measures.coverage_table(m.gold()),
    "state_ranking": lambda m: measures.state_ranking(m.fact(CATEGORY)),
    "state_vs_national": lambda m: measures.state_vs_national(m.fact(CATEGORY)),
    "state_growth": lambda m: measures.state_growth(m.fact(CATEGORY)),
    "fuel_mix_trend": lambda m: measures.mix_trend(m.fact(FUEL), FUEL),
    "top10_makers_in_state": lambda m: measures.top_in_state(m.fact(MANUFACTURER), MANUFACTURER),
    "gainers_decliners": lambda m: measures.gainers_decliners(m.fact(FUEL), FUEL),
    "guarded_growth": lambda m: measures.guarded_growth(
        m.fact(MANUFACTURER), MANUFACTURER, MIN_BASE),
    "rolling_trend": lambda m: measures.rolling_trend(m.fact(CATEGORY), CATEGORY),
    "calendar": lambda m: measures.date_table(m.silver()),
    "correlated_movement": lambda m: measures.correlated_movement(m.silver()),
}

FAMILIES = [
    BRONZE, SILVER, QUALITY, GOLD, VIEWS, ANALYTICS, RECONCILIATION, MEASURES]


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query):
        return lambda spark, sf_dir: comparable(query(Market(spark, sf_dir)))

    return {name: bind(query) for family in FAMILIES for name, query in family.items()}
