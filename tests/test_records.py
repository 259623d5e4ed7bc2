"""Quoted cells with line breaks, in files cut into any splits."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from tallymark.functions.reports import split_cells
from tallymark.sources.records import ends_inside, records
from tallymark.sources.report_files import line_order, scan_lines
from tallymark.sources.workspace import written


def as_lines(spark, texts, width=3):
    """Lines of several files, ``width`` of them to a split."""
    rows = [(name, n // width, n % width, line)
            for name, text in texts.items() for n, line in enumerate(text.split("\n"))]
    raw = spark.createDataFrame(rows, "source_file string, block long, row long, line string")
    return raw.repartition(8).select(
        "source_file", line_order(F.col("block"), F.col("row"), F.lit(0)).alias("line_order"), "line")


def in_order(frame):
    found = {}
    for r in frame.orderBy("source_file", "line_order").collect():
        found.setdefault(r.source_file, []).append(r.line)
    return found


def csv_records(text):
    """Records as the standard reader cuts them, each as its lines joined."""
    lines, out, start = text.split("\n"), [], 0
    reader = csv.reader(io.StringIO(text, newline=""))
    for _ in reader:
        out.append("\n".join(lines[start:reader.line_num]))
        start = reader.line_num
    return out


def closed(text):
    """Whether the standard reader ends outside quotes."""
    try:
        list(csv.reader(io.StringIO(text, newline=""), strict=True))
    except csv.Error as error:
        return "unexpected end" not in str(error)
    return True


@pytest.mark.parametrize("line, outside, inside", [
    ('', False, True), ('a,b', False, True), ('"a",b', False, False), ('"a', True, False),
    ('a",b', False, False), ('a","b', True, True), ('"a ""x"" b', True, False), ('"', True, False),
    ('5" pipe,1', False, False), ('"a""', True, False), ('x, "y', False, False),
])
def test_where_a_line_ends(spark, line, outside, inside):
    row = spark.createDataFrame([(line,)], "line string").select(
        ends_inside("line", False), ends_inside("line", True)).first()
    assert (row[0], row[1]) == (outside, inside)


def test_random_files_as_the_standard_reader_cuts_them(spark):
    rng = random.Random(11)
    texts = {}
    while len(texts) < 60:
        cells = ["a", "", '"q"', '"x,y"', '"two\nlines"', '"\n\n"', '"he said ""no"""', '"a""\n""b"',
                 '"end\n"', 'mid"dle', "7"]
        rows = [",".join(rng.choices(cells, k=rng.randrange(1, 5))) for _ in range(rng.randrange(1, 25))]
        text = "\n".join(r or "z" for r in rows)
        if closed(text) and text.strip("\n") == text:
            texts[f"f{len(texts)}"] = text
    for width in (1, 2, 7):
        got = in_order(records(as_lines(spark, texts, width), written))
        for name, text in texts.items():
            assert got[name] == csv_records(text), (width, text)


def test_a_cell_that_never_closes_was_never_open(spark):
    texts = {"open": 'h,"a\nb"\nx,"stray\nc,d\ne,f', "plain": "a,b\nc,d", "one": '"'}
    got = in_order(records(as_lines(spark, texts, 2), written))
    assert got == {"open": ['h,"a\nb"', 'x,"stray', "c,d", "e,f"], "plain": ["a,b", "c,d"], "one": ['"']}


def test_a_report_cut_into_many_splits(spark, tmp_path):
    """Real splits of a file: quoted cells lie across most of them."""
    name = "fuel/market_fuel_an_monthwise_2025_2026.csv"
    rows = [f'"DIESEL {i}\nsecond line {"x" * (i % 90)}\n{i}",{i}' for i in range(4000)]
    (tmp_path / "fuel").mkdir()
    (tmp_path / name).write_text("Fuel,2025-Jan\n" + "\n".join(rows) + "\n", encoding="utf-8")
    (tmp_path / "fuel/market_fuel_ap_monthwise_2025_2026.csv").write_text("")
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "4096")
    try:
        out = scan_lines(spark, str(tmp_path), str(tmp_path / "table"))
        splits = out.filter(F.col("source_file") == name).select("line_order.block").distinct().count()
    finally:
        spark.conf.set(setting, before)
    assert splits > 40
    cells = {r.cells[1]: r.cells[0] for r in out.filter("size(cells) = 2").collect()}
    assert len(cells) == 4001
    for i in range(4000):
        text = f"DIESEL {i}\nsecond line {'x' * (i % 90)}\n{i}"
        assert cells[str(i)] == text
    assert out.filter(F.col("source_file").contains("_ap_")).count() == 1


def test_cells_keep_any_sign(spark):
    texts = ['"a\u0001b",c', '"a\u0001b,c\u0001a",\u0001', 'x\u0001a,y\u0001b', '"\u0001,\u0001b"']
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.c for r in frame.select(split_cells("t").alias("c"), "i").orderBy("i").collect()]
    assert got == [["a\u0001b", "c"], ["a\u0001b,c\u0001a", "\u0001"], ["x\u0001a", "y\u0001b"],
                   ["\u0001,\u0001b"]]
