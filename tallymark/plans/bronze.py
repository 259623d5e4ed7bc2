"""Report lines to the Unified long table, with checks on the reports themselves.

Input is a frame of (source_file, line_order, line), which :func:`cut` completes. A report may be of any size: its
lines are never gathered, only its header line is looked up and joined to them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tallymark.functions.numbers import count_of, count_or_zero, number
from tallymark.functions.reports import (
    DEFAULT_NAMING, OTHER, STRICT_MONTH_PATTERN, ReportNaming, expected_header, header_key,
    is_national, month_columns, report_type, split_cells, state_code)
from tallymark.operators.totals import join_on
from tallymark.schemas import (
    MEASURE, NO_HEADER, NO_MONTHS, NO_ROWS, PLANNED_STATES, REPORT_RANGES, SUMMARY_LABELS,
    UNIFIED_COLUMNS)


def classify(files: DataFrame, naming: ReportNaming = DEFAULT_NAMING) -> DataFrame:
    """Each file with its dataset type, its national flag and whether it is processed."""
    return files.withColumns({
        "dataset_type": report_type("source_file", naming),
        "is_national": is_national("source_file", naming),
    }).withColumn(
        "is_processed", ~F.col("is_national") & (F.col("dataset_type") != OTHER))


def without_national(files: DataFrame, naming: ReportNaming = DEFAULT_NAMING) -> DataFrame:
    return files.filter(~is_national("source_file", naming))


def cut(lines: DataFrame, naming: ReportNaming = DEFAULT_NAMING) -> DataFrame:
    """Lines with the type of their report and their cells: the rows of the Bronze table.

    Stored with the lines, these are worked out once; as part of a longer plan the
    optimizer would copy them into every filter that looks at them.
    """
    return classify(lines, naming).select(
        "source_file", "dataset_type", "is_national", "is_processed", "line_order", "line",
        F.when(F.col("is_processed"), split_cells("line")).alias("cells"))


@dataclass(frozen=True)
class Reports:
    """Lines of supported reports and one head per report."""

    lines: DataFrame
    heads: DataFrame

    @property
    def headers(self) -> DataFrame:
        """The heads of reports that have a header."""
        return self.heads.filter("header IS NOT NULL")

    def files(self) -> DataFrame:
        return self.heads.select("source_file", "dataset_type")


def _supported(cut_lines: DataFrame) -> DataFrame:
    return cut_lines.filter("is_processed").select(
        "source_file", "dataset_type", "line_order", "cells")


def find_heads(cut_lines: DataFrame, naming: ReportNaming = DEFAULT_NAMING) -> DataFrame:
    """What is known of each supported report before its rows are looked at.

    Header cells, their months and their place, and the title with its place; NULL where a
    report has none. The header is the first line whose first cell is the one its type must
    have, the title the first line that is not blank, if it stands before the header. One
    aggregate finds both; it has a map-side part, so no line is shuffled. Store the result beside
    the lines: every check of the reports begins with it.
    """
    lines = _supported(cut_lines)
    is_header = header_key(F.element_at("cells", 1)) == F.lower(
        expected_header("dataset_type", naming))
    found = lines.groupBy("source_file", "dataset_type").agg(
        F.min(F.when(is_header, F.col("line_order"))).alias("header_order"),
        F.min_by(F.when(is_header, F.col("cells")), F.when(is_header, F.col("line_order")))
        .alias("header"),
        F.min(F.when(_has_text(), F.struct(
            "line_order", F.array_join("cells", ",").alias("title")))).alias("_first"))
    titled = F.col("_first.line_order") < F.col("header_order")
    return found.select(
        "source_file", "dataset_type", "header", "header_order",
        F.when(F.col("header").isNotNull(), month_columns("header")).alias("months"),
        F.when(titled, F.col("_first.title")).alias("title"),
        F.when(titled, F.col("_first.line_order")).alias("title_order"))


def parse(
    cut_lines: DataFrame, naming: ReportNaming = DEFAULT_NAMING, heads: DataFrame | None = None,
) -> Reports:
    """The supported reports of a Bronze table, with their stored heads or newly found ones."""
    return Reports(
        _supported(cut_lines), find_heads(cut_lines, naming) if heads is None else heads)


def _has_text() -> Column:
    return (F.size("cells") > 1) | (F.element_at("cells", 1) != "")


def not_blank(reports: Reports) -> DataFrame:
    return reports.lines.filter(_has_text())


def header_lines(reports: Reports) -> DataFrame:
    """Header cells per report."""
    return reports.headers.select(
        "source_file", "dataset_type",
        F.size("header").cast("bigint").alias("column_count"),
        F.size("months").cast("bigint").alias("month_count"),
        F.array_join("header", "|").alias("header"))


def body(reports: Reports) -> DataFrame:
    """Data rows: the lines after the header that are not blank, with their header.

    Reports differ in size, so the join on the report is left to adaptive execution:
    it broadcasts the headers when they prove small and splits a report that is not.
    """
    heads = reports.headers.select("source_file", "header_order", "header", "months")
    joined = not_blank(reports).join(heads, "source_file")
    return joined.filter(F.col("line_order") > F.col("header_order")).select(
        "source_file", "dataset_type", "line_order", "cells", "header", "months")


def is_summary_row(value) -> Column:
    return F.lower(F.trim(value)).isin(*SUMMARY_LABELS)


def unpivot_months(rows: DataFrame) -> DataFrame:
    """One row per data row and month column, as text; all other columns are dropped."""
    cells = rows.select(
        "source_file", "dataset_type", F.element_at("cells", 1).alias("dimension_value"),
        "cells", F.explode("months").alias("m"))
    return cells.select(
        "source_file", "dataset_type", "dimension_value", "m.label",
        F.get("cells", F.col("m.position")).alias("cell"),
        "m.period", "m.year", "m.month", "m.month_name")


def drop_summary_rows(rows: DataFrame) -> DataFrame:
    value = F.coalesce("dimension_value", F.lit(""))
    return rows.filter((value != "") & ~is_summary_row(value))


def drop_undated(rows: DataFrame) -> DataFrame:
    """Rows whose label is a month of the calendar."""
    return rows.filter("period IS NOT NULL")


def long_rows(reports: Reports) -> DataFrame:
    """Unified rows of all reports before full repeats are dropped."""
    cells = drop_undated(drop_summary_rows(unpivot_months(body(reports))))
    return cells.withColumn(MEASURE, count_or_zero("cell")).select(*UNIFIED_COLUMNS)


def unify(reports: Reports) -> DataFrame:
    """The Unified table: every report in one plan, fully identical rows once."""
    return long_rows(reports).dropDuplicates()


def failures(reports: Reports, naming: ReportNaming = DEFAULT_NAMING) -> DataFrame:
    """Reports that gave no rows and why; the others go on regardless."""
    sizes = body(reports).groupBy("source_file").agg(
        F.count_if(
            (F.element_at("cells", 1) != "") & ~is_summary_row(F.element_at("cells", 1))
        ).alias("value_rows"))
    heads = reports.headers.select(
        "source_file",
        F.exists("months", lambda m: m["period"].isNotNull()).alias("dated"),
        F.size("months").alias("month_count"))
    state = (
        reports.files().join(heads, "source_file", "left").join(sizes, "source_file", "left")
    )
    error = (
        F.when(
            F.col("month_count").isNull(),
            F.replace(F.lit(NO_HEADER), F.lit("{}"), expected_header("dataset_type", naming)))
        .when(F.col("month_count") == 0,
              F.replace(F.lit(NO_MONTHS), F.lit("{}"), F.col("source_file")))
        .when(~F.col("dated") | (F.coalesce("value_rows", F.lit(0)) == 0), F.lit(NO_ROWS))
    )
    return state.select(F.col("source_file").alias("file"), error.alias("error")).filter(
        "error IS NOT NULL")


def structure_check(reports: Reports, max_months: int = 36) -> DataFrame:
    """Per report: rows, month columns, a Total column, and VALID or INVALID.

    Maker reports only need rows. The real header is looked at, whatever line it is on.
    """
    counts = body(reports).groupBy("source_file").agg(F.count("*").alias("row_count"))
    heads = reports.headers.select(
        "source_file",
        F.size(F.filter("header", lambda h: F.regexp_like(h, F.lit(STRICT_MONTH_PATTERN))))
        .cast("bigint").alias("month_columns"),
        F.array_contains("header", "Total").alias("has_total"))
    joined = (
        reports.files().join(heads, "source_file", "left").join(counts, "source_file", "left")
        .select(
            "source_file", "dataset_type",
            F.coalesce("row_count", F.lit(0)).alias("row_count"),
            F.coalesce("month_columns", F.lit(0)).alias("month_columns"),
            F.coalesce("has_total", F.lit(False)).alias("has_total"))
    )
    sound = (F.col("row_count") > 0) & (
        (F.col("dataset_type") == "Manufacturer")
        | (F.col("month_columns").between(1, max_months) & F.col("has_total")))
    return joined.withColumn("status", F.when(sound, "VALID").otherwise("INVALID"))


def structure_summary(reports: Reports, expected: dict[str, int] | None = None) -> DataFrame:
    """Valid and invalid reports per dataset type, against the expected number of files.

    With numbers expected, a type without a report is listed with 0 files, and one that nobody
    expected without a verdict.
    """
    out = structure_check(reports).groupBy("dataset_type").agg(
        F.count("*").alias("files"),
        F.count_if(F.col("status") == "VALID").alias("valid_files"),
        F.count_if(F.col("status") == "INVALID").alias("invalid_files"))
    if not expected:
        return out
    wanted = reports.lines.sparkSession.createDataFrame(
        list(expected.items()), "dataset_type string, expected_files long")
    both = wanted.join(out, "dataset_type", "full").select(
        "dataset_type",
        *[F.coalesce(c, F.lit(0)).alias(c)
          for c in ("files", "valid_files", "invalid_files")], "expected_files")
    return both.withColumn("files_status", F.when(
        F.col("files") == F.col("expected_files"), "PASS").when(
        F.col("expected_files").isNotNull(), "FAIL"))


def total_reconcile(reports: Reports) -> DataFrame:
    """Months against the stated Total, by row (ROW) and by month column (COLUMN).

    A stated total or a cell that is no whole number in range gives NULL and CHECK.
    """
    rows = body(reports).withColumn("value", F.element_at("cells", 1)).filter("value <> ''")
    total_at = F.array_position("header", "Total")
    month_sum = F.aggregate(
        "months", F.lit(0).cast("bigint"),
        lambda acc, m: acc + count_or_zero(F.get("cells", m["position"])))
    by_row = rows.filter(total_at > 0).select(
        "source_file", F.lit("ROW").alias("direction"), F.col("value").alias("item"),
        month_sum.alias("month_sum"),
        count_of(F.get("cells", (total_at - 1).cast("int"))).alias("stated_total"))
    cells = unpivot_months(rows).withColumn("n", count_or_zero("cell"))
    is_total = is_summary_row(F.col("dimension_value"))
    by_column = (
        cells.groupBy("source_file", F.lit("COLUMN").alias("direction"), F.col("label").alias("item"))
        .agg(
            F.coalesce(F.sum(F.when(~is_total, F.col("n"))), F.lit(0)).alias("month_sum"),
            F.sum(F.when(is_total, F.col("n"))).alias("stated_total"))
        .filter("stated_total IS NOT NULL")
    )
    both = by_row.unionByName(by_column)
    return both.withColumn(
        "status",
        F.when(F.col("month_sum") == F.col("stated_total"), "PASS").otherwise("CHECK"))


def report_quality(reports: Reports) -> DataFrame:
    """Per report: rows, repeated values, empty, non-numeric and negative cells."""
    cells = F.transform("months", lambda m: F.coalesce(F.get("cells", m["position"]), F.lit("")))

    def hits(condition):
        return F.size(F.filter("_cells", condition))

    rows = body(reports).select(
        "source_file", F.element_at("cells", 1).alias("value"), cells.alias("_cells"))
    per_value = rows.groupBy("source_file", "value").agg(
        F.count("*").alias("n"),
        F.sum(hits(lambda c: c == "")).alias("empty"),
        F.sum(hits(lambda c: (c != "") & number(c).isNull())).alias("text"),
        F.sum(hits(lambda c: number(c) < 0)).alias("negative"))
    return per_value.groupBy("source_file").agg(
        F.sum("n").alias("row_count"),
        F.sum(F.col("n") - 1).alias("duplicate_values"),
        F.sum("empty").alias("empty_cells"),
        F.sum("text").alias("non_numeric_cells"),
        F.sum("negative").alias("negative_cells"))


def _claimed_years(text, pattern: str):
    first = F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).cast("int")
    last = F.nullif(F.regexp_extract(text, pattern, 2), F.lit("")).cast("int")
    return first, F.coalesce(last, first)


def title_lineage(reports: Reports) -> DataFrame:
    """Years claimed by title and file name against the years of the month columns.

    All of it stands in the heads of the reports; no line is read.
    """
    found = F.transform("months", lambda m: m["year"])
    title_from, title_to = _claimed_years(F.col("title"), r"\((\d{4})(?:-(\d{4}))?\)")
    name_from, name_to = _claimed_years(F.col("source_file"), r"_(\d{4})_(\d{4})\.csv$")
    heads = reports.heads.select(
        "source_file", "title",
        F.array_min(found).alias("found_from"), F.array_max(found).alias("found_to"))
    claimed = heads.select(
        "source_file", "title",
        title_from.alias("title_from"), title_to.alias("title_to"),
        name_from.alias("name_from"), name_to.alias("name_to"), "found_from", "found_to")
    agrees = (
        (F.col("title_from") == F.col("found_from")) & (F.col("title_to") == F.col("found_to"))
        & (F.col("name_from") == F.col("found_from")) & (F.col("name_to") == F.col("found_to")))
    return claimed.withColumn(
        "status", F.when(F.coalesce(agrees, F.lit(False)), "PASS").otherwise("CHECK"))


def report_plan(states: DataFrame, ranges=REPORT_RANGES) -> DataFrame:
    """Every report that should be delivered: states x reports x their year ranges."""
    spans = F.array(*[
        F.struct(
            F.lit(report).alias("report"), F.lit(lo).alias("from_year"), F.lit(hi).alias("to_year"))
        for report, years in ranges.items() for lo, hi in years
    ])
    return states.select("state_code", F.inline(spans))


def planned_states(states: DataFrame) -> DataFrame:
    """The states that deliver reports, out of a table that knows more codes."""
    return states.filter(F.col("state_code").isin(*PLANNED_STATES))


def report_coverage(
    plan: DataFrame, reports: Reports, naming: ReportNaming = DEFAULT_NAMING,
) -> DataFrame:
    """Plan against delivered files: DELIVERED, MISMATCH or MISSING.

    A file counts as delivered when its name fits and its month columns lie within the
    range its name claims; a fitting name over other months is a mismatch.
    """
    lineage = title_lineage(reports).select(
        "source_file", "name_from", "name_to", "found_from", "found_to")
    delivered = (
        lineage.join(reports.files(), "source_file")
        .select(
            state_code("source_file", naming).alias("state_code"),
            F.lower("dataset_type").alias("report"),
            F.col("name_from").alias("from_year"), F.col("name_to").alias("to_year"),
            F.coalesce(
                (F.col("found_from") >= F.col("name_from"))
                & (F.col("found_to") <= F.col("name_to")), F.lit(False)).alias("fits"))
        .groupBy("state_code", "report", "from_year", "to_year")
        .agg(F.max("fits").alias("fits"))
    )
    keys = ["state_code", "report", "from_year", "to_year"]
    return join_on(plan, delivered, keys, "left").select(
        *keys,
        F.when(F.col("fits"), "DELIVERED").when(~F.col("fits"), "MISMATCH").otherwise("MISSING")
        .alias("status"))
