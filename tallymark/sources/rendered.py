"""Market frames written out as report text, faults included.

The text has the layouts, marks and oddities of delivered reports, so that the Bronze
steps can be run and checked on data of any size. Every fault follows from a hash of the
file, row or cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallymark.functions.reports import BOM
from tallymark.plans.bronze import cut
from tallymark.schemas import MEASURE, REPORT_HEADERS
from tallymark.sources.market import row_hash
from tallymark.sources.records import records
from tallymark.sources.report_files import split_physical
from tallymark.sources.workspace import written

MONTHS = range(1, 13)
LABELS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
NO_BREAK = "\u00a0"
# A line break and a control sign within a quoted name.
BROKEN = "\nand\u0001Co"
# Years added to the month labels of files whose content is not what their name says.
SHIFT = 7


def _names(path: str) -> Column:
    """The file's own name and, for some states, copies under names to be skipped."""
    def other(code, pattern, replacement):
        named = F.regexp_replace(path, pattern, replacement)
        return F.when((F.col("state_code") == code) & (named != F.col(path)), named)

    return F.filter(
        F.array(
            F.col(path),
            other("aa", "_aa_monthwise", "_monthwise"),
            other("bb", "_bb_monthwise", "_test_bb_monthwise"),
            other("cc", "/market_", "/old_"),
            other("dd", "manufacturer_dd_monthwise", "manufacturer")),
        lambda n: n.isNotNull())


def report_rows(silver: DataFrame) -> DataFrame:
    """One row per file and value with the twelve cell texts and what they stand for."""
    wide = silver.groupBy(
        "source_file", "dataset_type", "state_code", "state", "year", "dimension_value"
    ).agg(*[
        F.coalesce(F.sum(F.when(F.col("month") == m, F.col(MEASURE))), F.lit(0)).alias(f"c{m}")
        for m in MONTHS
    ])
    filled = wide.select(
        "source_file", "dataset_type", "state_code", "state", "year", "dimension_value",
        F.array(*[f"c{m}" for m in MONTHS]).alias("cells"),
        F.transform(
            F.sequence(F.lit(1), F.lit(12)),
            lambda m: row_hash("source_file", "dimension_value", m.cast("string"))).alias("hashes"),
        row_hash("source_file").alias("file_hash"),
        row_hash("source_file", "dimension_value").alias("row_hash"))

    def text(n, h):
        shown = n.cast("string")
        return (
            F.when(h % 101 == 0, "n/a").when(h % 103 == 0, F.concat(F.lit("-"), shown))
            .when(h % 107 == 0, F.concat(F.lit("  "), shown, F.lit("  ")))
            .when(h % 109 == 0, F.concat(shown, F.lit(".0"))).when(h % 113 == 0, "NaN")
            .otherwise(shown))

    def counted(n, h):
        lost = (h % 101 == 0) | (h % 103 == 0) | (
            (h % 113 == 0) & (h % 107 != 0) & (h % 109 != 0))
        return F.when(lost, F.lit(0).cast("bigint")).otherwise(n)

    return filled.select(
        *[c for c in filled.columns if c not in ("cells", "hashes")],
        F.zip_with("cells", "hashes", text).alias("texts"),
        F.zip_with("cells", "hashes", counted).alias("counts"))


def _joined(first: Column, texts: Column, total: Column, maker: Column) -> Column:
    cells = F.concat(F.array(first), texts, F.array(total.cast("string")))
    quoted = F.concat(F.lit('"'), F.array_join(cells, '","'), F.lit('"'))
    return F.when(maker, quoted).otherwise(F.array_join(cells, ","))


def _line_sum(counts) -> Column:
    return F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, x: a + x)


def report_lines(silver: DataFrame) -> DataFrame:
    """The rows of a Bronze table of every report."""
    rows = report_rows(silver)
    maker = F.col("dataset_type") == "Manufacturer"
    stated = _line_sum("counts") + F.when(F.col("row_hash") % 53 == 0, 1).otherwise(0)
    name = (
        F.when(F.col("file_hash") % 37 == 0, "Grand Total")
        .when(maker & (F.col("row_hash") % 5 == 0),
              F.concat("dimension_value", F.lit(f", LTD {NO_BREAK} ")))
        .when(maker & (F.col("row_hash") % 7 == 0), F.concat("dimension_value", F.lit(BROKEN)))
        .when(maker, F.concat("dimension_value", F.lit(f" {NO_BREAK} ")))
        .otherwise(F.col("dimension_value"))
    )
    copies = F.when(F.col("row_hash") % 59 == 0, 2).otherwise(1)
    # Rows stand in the order of a hash of their value; each copy and each physical line of one
    # has a place of its own.
    place = F.shiftleft(F.xxhash64("dimension_value"), 3)
    data = rows.select(
        "source_file", "state_code", F.lit(2).alias("block"), place.alias("place"),
        F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"),
        _joined(name, F.col("texts"), stated, maker).alias("value")
    ).select(
        "source_file", "state_code", "block", "place", "copy",
        F.posexplode(F.split("value", "\n")).alias("at", "value")
    ).select(
        "source_file", "state_code", "block",
        (F.col("place") + 4 * F.col("copy") + F.col("at")).alias("row"), "value")

    files = rows.groupBy("source_file", "dataset_type", "state_code", "state", "year", "file_hash").agg(
        *[F.sum(F.element_at("counts", m)).alias(f"t{m}") for m in MONTHS])
    headers = F.element_at(
        F.create_map(*[F.lit(x) for kv in REPORT_HEADERS.items() for x in kv]), F.col("dataset_type"))
    head = F.when(F.col("file_hash") % 29 == 0, "Unknown").otherwise(headers)
    title_year = F.col("year") + F.when(F.col("file_hash") % 23 == 0, 3).otherwise(0)
    column_year = (
        F.col("year") + F.when(F.col("file_hash") % 43 == 0, SHIFT).otherwise(0)).cast("string")
    labels = F.array(*[
        F.when(F.col("file_hash") % 31 == 0, f"M{m:02d}")
        .otherwise(F.concat(column_year, F.lit("-" + LABELS[m - 1])))
        for m in MONTHS
    ])
    title = F.concat(
        F.lit('"'), headers, F.lit(" and Month Wise Data for "), F.col("state"), F.lit(" ("),
        title_year.cast("string"), F.lit(')"'))
    header = _joined(head, labels, F.lit("Total"), maker)
    sums = F.array(*[
        F.col(f"t{m}") + (F.when(F.col("file_hash") % 47 == 0, 1).otherwise(0) if m == 3 else 0)
        for m in MONTHS
    ])
    blanks = F.array(*[F.lit("5")] * 12)

    def line(block, value, where=None):
        entry = F.struct(F.lit(block).alias("block"), value.alias("value"))
        return entry if where is None else F.when(where, entry)

    total = _joined(
        F.lit("Total"), F.transform("sums", lambda x: x.cast("string")), _line_sum("sums"), maker)
    blank = _joined(F.lit("  "), blanks, F.lit(60), maker)
    around = F.filter(
        F.array(
            line(0, F.concat(title, F.lit("\\n\\n"), header), ~maker),
            line(0, F.concat(F.lit(BOM), title), maker),
            line(1, header, maker),
            line(3, blank, F.col("file_hash") % 3 == 0),
            line(4, total, ~maker)),
        lambda e: e.isNotNull())
    framed = files.withColumn("sums", sums).select(
        "source_file", "state_code", F.inline(around)).select(
        "source_file", "state_code", "block", F.lit(0).alias("row"), "value")
    lines = data.unionByName(framed)
    named = lines.withColumn("source_file", F.explode(_names("source_file"))).drop("state_code")
    return cut(records(written(split_physical(named), "physical-lines"), written))
