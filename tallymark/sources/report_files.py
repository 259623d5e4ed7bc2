"""Folders of report files as lines of text with lineage and order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallymark.functions.reports import BOM, DEFAULT_NAMING, ReportNaming
from tallymark.plans.bronze import cut
from tallymark.sources.records import records
from tallymark.sources.trees import list_tree, write_tree
from tallymark.sources.workspace import written

LINE_SCHEMA = (
    "source_file string, dataset_type string, is_national boolean, is_processed boolean, "
    "line_order struct<block: bigint, row: bigint, part: bigint>, line string, "
    "cells array<string>")


def line_order(block, row, part) -> Column:
    """Place of a line in its file; structs compare field by field."""
    return F.struct(
        block.cast("bigint").alias("block"),
        row.cast("bigint").alias("row"),
        part.cast("bigint").alias("part"))


def relative_path(path: Column, root: str) -> Column:
    """Path below ``root``; the scheme and authority of both sides are left out."""
    bare = root.split("://", 1)[-1] if "://" in root else root.removeprefix("file:")
    bare = "/" + bare.strip("/") + "/"
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.element_at(F.split(decoded, "\\Q" + bare + "\\E", 2), -1)


def scan_files(spark: SparkSession, root: str) -> DataFrame:
    """Every CSV file below ``root``, its size and time, without reading contents."""
    return list_tree(spark, root, "*.csv")


def changed_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files that two listings do not have alike: ADDED, REMOVED or CHANGED.

    ``before`` is a written listing of :func:`scan_files`.
    """
    old = before.select("source_file", F.struct("bytes", "modified").alias("_old"))
    new = after.select("source_file", F.struct("bytes", "modified").alias("_new"))
    what = F.when(F.col("_old").isNull(), "ADDED").when(F.col("_new").isNull(), "REMOVED").otherwise(
        "CHANGED")
    return old.join(new, "source_file", "full").filter(
        ~F.col("_old").eqNullSafe(F.col("_new"))).select("source_file", what.alias("change"))


def split_physical(raw: DataFrame) -> DataFrame:
    """Physical lines (source_file, block, row, value) as report lines.

    Some reports hold backslash-n pairs where line breaks belong; marks are dropped.
    """
    pieces = raw.select(
        "source_file", "block", "row",
        F.posexplode(F.split(F.translate("value", BOM + "\r", ""), r"\\n")).alias("part", "line"))
    return pieces.select(
        "source_file",
        line_order(F.col("block"), F.col("row"), F.col("part")).alias("line_order"),
        "line")


def _physical(files: DataFrame, name: Column) -> DataFrame:
    return files.select(
        name.alias("source_file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), "value")


def write_reports(lines: DataFrame, root: str) -> None:
    """Report lines as CSV files below ``root``; a NULL line is that of an empty file."""
    write_tree(lines, root, ["line_order"])


def scan_lines(
    spark: SparkSession, root: str, table: str, naming: ReportNaming = DEFAULT_NAMING,
) -> DataFrame:
    """All lines of all CSV files below ``root``, kept as the Bronze table at ``table``.

    Files are read line by line, so one of any size is split over tasks. The place of a
    line (start of its split, running number in the task, piece of the physical line) is
    written with it: later steps compare places and must not see them drawn twice. A quoted
    cell may hold line breaks, wherever a file is split (``records``).
    """
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(root)
    name = relative_path(F.col("_metadata.file_path"), root)
    lines = records(split_physical(_physical(files, name)), written)
    # A file without a byte gives no line; it gets a blank one, so that checks list it.
    empty = scan_files(spark, root).filter("bytes = 0").select(
        "source_file", line_order(F.lit(0), F.lit(0), F.lit(0)).alias("line_order"),
        F.lit("").alias("line"))
    cut(lines.unionByName(empty), naming).write.mode("overwrite").parquet(table)
    return spark.read.schema(LINE_SCHEMA).parquet(table)
