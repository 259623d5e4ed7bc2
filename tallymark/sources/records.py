"""Records of report files: physical lines put together where a quoted cell holds a line break.

A file is cut into splits that know nothing of each other, so no task can tell by itself whether
a line begins inside quotes. Each line tells where it ends for either beginning: it keeps the
side it began on, changes it, or ends on one side whatever it began on. These compose, so a line's
beginning follows from the last line before it that settles the side and the changes since.
Windows find that inside a split; what a split does as a whole, one row each, is passed on over
the splits of a file. Only files with a line that leaves a cell open take part.

A quote opens a cell only at its beginning; a doubled one inside quotes stands for itself. A cell
that is still open at the end of its file was never one: its lines stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallymark.functions.numbers import as_column

QUOTE = '"'
BREAK = "\n"


def ends_inside(line, begins_inside: bool) -> Column:
    """Whether a line ends within quotes, given how it begins."""
    pieces = F.split(as_column(line), QUOTE)
    before = F.transform(pieces, lambda p, i: F.struct(p.alias("text"), i.alias("i")))
    start = F.struct(F.lit(begins_inside).alias("inside"), F.lit(False).alias("closed"))

    def quote(state: Column, piece: Column) -> Column:
        """The state after the quote that follows ``piece``."""
        text = piece["text"]
        opens = (
            F.endswith(text, F.lit(","))
            | ((text == "") & (state["closed"] | (piece["i"] == 0))))
        return F.struct(
            (~state["inside"] & opens).alias("inside"), state["inside"].alias("closed"))

    # No quote follows the last piece.
    return F.aggregate(
        F.slice(before, 1, F.greatest(F.size(before) - 1, F.lit(0))), start, quote)["inside"]


def open_files(lines: DataFrame) -> DataFrame:
    """Files with a line that begins outside quotes and ends inside."""
    quoted = lines.filter(F.contains("line", F.lit(QUOTE)))
    return quoted.filter(ends_inside("line", False)).select("source_file").distinct()


def with_beginnings(lines: DataFrame) -> DataFrame:
    """Each line with ``inside``: whether it begins within quotes. Lines are a written table.

    ``unclosed`` tells that the file's last cell stays open.
    """
    plain = ~F.contains("line", F.lit(QUOTE))
    from_out = F.when(plain, F.lit(False)).otherwise(ends_inside("line", False))
    from_in = F.when(plain, F.lit(True)).otherwise(ends_inside("line", True))
    known = lines.withColumns({"_out": from_out, "_in": from_in}).withColumns({
        # A line that ends on one side either way settles it, one that swaps both turns it.
        "_settled": F.when(F.col("_out") == F.col("_in"), F.col("_out")),
        "_turn": (F.col("_out") & ~F.col("_in")).cast("long"),
        "_block": F.col("line_order.block"),
    })
    split = W.partitionBy("source_file", "_block").orderBy("line_order")
    so_far = split.rowsBetween(W.unboundedPreceding, 0)
    earlier = split.rowsBetween(W.unboundedPreceding, -1)
    turned = known.withColumn("_turns", F.sum("_turn").over(so_far))
    last = F.when(F.col("_settled").isNotNull(), F.struct("_settled", "_turns"))
    marked = turned.withColumn("_last", last).withColumns({
        "_set": F.last("_last", ignorenulls=True).over(earlier),
        "_before": F.col("_turns") - F.col("_turn"),
    })

    # What each split does as a whole; one row per split of an open file.
    whole = marked.groupBy("source_file", "_block").agg(
        F.sum("_turn").alias("_all"), F.max_by("_last", F.when(F.col("_last").isNotNull(), F.col("line_order"))).alias("_end"))
    in_order = W.partitionBy("source_file").orderBy("_block")
    to_here = in_order.rowsBetween(W.unboundedPreceding, 0)
    # Turns after the split's last settling line, and how many there were up to any split.
    rest = whole.withColumn("_sum", F.sum("_all").over(to_here)).withColumn(
        "_fixed", F.when(F.col("_end").isNotNull(), F.struct(
            F.col("_end._settled").alias("side"),
            (F.col("_sum") - F.col("_all") + F.col("_end._turns")).alias("at"))))

    def side(window, turns: Column) -> Column:
        fixed = F.last("_fixed", ignorenulls=True).over(window)
        odd = (turns - F.coalesce(fixed["at"], F.lit(0))) % 2 == 1
        return F.coalesce(fixed["side"], F.lit(False)) != odd

    entered = rest.select(
        "source_file", "_block",
        side(in_order.rowsBetween(W.unboundedPreceding, -1), F.col("_sum") - F.col("_all"))
        .alias("_entry"),
        side(to_here, F.col("_sum")).alias("_exit"), "_sum")
    ends = entered.groupBy("source_file").agg(F.max_by("_exit", "_block").alias("unclosed"))
    side_of = (
        F.coalesce(F.col("_set._settled"), F.col("_entry"))
        != ((F.col("_before") - F.coalesce(F.col("_set._turns"), F.lit(0))) % 2 == 1))
    return (
        marked.join(entered.select("source_file", "_block", "_entry"), ["source_file", "_block"])
        .join(ends, "source_file")
        .select(*lines.columns, side_of.alias("inside"), "unclosed"))


def joined(lines: DataFrame) -> DataFrame:
    """Records of open files: each takes the place of its first line."""
    begun = with_beginnings(lines).withColumn("_block", F.col("line_order.block"))
    first = F.when(~F.col("inside"), F.col("line_order"))
    split = W.partitionBy("source_file", "_block").orderBy("line_order").rowsBetween(
        W.unboundedPreceding, 0)
    placed = begun.withColumn("_first", F.last(first, ignorenulls=True).over(split))
    # A record that began in an earlier split: the last beginning of the splits before.
    starts = begun.groupBy("source_file", "_block").agg(F.max(first).alias("_latest"))
    carried = starts.select(
        "source_file", "_block", F.max("_latest").over(
            W.partitionBy("source_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
        ).alias("_carried"))
    last_start = starts.groupBy("source_file").agg(F.max("_latest").alias("_last_start"))
    record = F.coalesce("_first", "_carried", "line_order")
    own = placed.join(carried, ["source_file", "_block"]).join(last_start, "source_file").withColumn(
        "_record", record)
    # What no quote closes was never open.
    loose = F.col("unclosed") & (F.col("_record") == F.col("_last_start"))
    own = own.withColumn("_record", F.when(loose, F.col("line_order")).otherwise(F.col("_record")))
    return (
        own.groupBy("source_file", F.col("_record").alias("line_order"))
        .agg(F.sort_array(F.collect_list(F.struct("line_order", "line"))).alias("_lines"))
        .select("source_file", "line_order",
                F.array_join(F.col("_lines.line"), BREAK).alias("line")))


def records(lines: DataFrame, keep) -> DataFrame:
    """Lines (source_file, line_order, line) as records.

    ``keep(frame, name)`` writes a frame and reads it back: the places of lines must not be drawn
    twice, and most files need no second look.
    """
    torn = keep(open_files(lines), "open-files")
    if torn.isEmpty():
        return lines
    apart = keep(lines.join(torn, "source_file", "left_semi"), "open-lines")
    return lines.join(torn, "source_file", "left_anti").unionByName(joined(apart))
