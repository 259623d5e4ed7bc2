import os

from pyspark.sql import functions as F

from tallymark.sources.trees import ListingReader, list_tree, write_tree


def make(root, *names, text=""):
    for name in names:
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)


def test_listing_tells_all_visible_files(spark, tmp_path, rows):
    make(tmp_path, "a.csv", "x/b.csv", "x/y/z/c.csv", "x/no.txt", "_x/d.csv", "x/.e.csv", "x/_f.csv")
    make(tmp_path, "x y/h+%20é.csv", text="12345")
    want = [("a.csv", 0), ("x y/h+%20é.csv", 5), ("x/b.csv", 0), ("x/y/z/c.csv", 0)]
    for tasks in (1, 2, 64):
        for root in (str(tmp_path), f"file://{tmp_path}/", f"file:{tmp_path}"):
            assert rows(list_tree(spark, root, "*.csv", tasks), "source_file", "bytes") == want
    (found,) = list_tree(spark, str(tmp_path), "a.csv").select(
        F.unix_micros("modified").alias("m")).collect()
    assert abs(found.m / 1e6 - os.path.getmtime(tmp_path / "a.csv")) < 1e-3
    assert list_tree(spark, str(tmp_path), "*.none").count() == 0


def test_folders_are_listed_side_by_side(tmp_path):
    make(tmp_path, *[f"s{i}/t{j}/f.csv" for i in range(4) for j in range(5)])
    reader = ListingReader(str(tmp_path), "*.csv", 8)
    parts = reader.partitions()
    assert sum(p.deep for p in parts) == 20 and len(parts) == 25
    found = [n for p in parts for b in reader.read(p) for n in b.column(0).to_pylist()]
    assert sorted(found) == sorted(f"s{i}/t{j}/f.csv" for i in range(4) for j in range(5))


def test_written_files_have_their_names_and_order(spark, tmp_path):
    lines = spark.range(30_000).select(
        F.concat(F.lit("d"), F.col("id") % 3, F.lit("/r"), F.col("id") % 7, F.lit(".csv"))
        .alias("source_file"), F.col("id").alias("at"), F.concat(F.lit("é,"), "id").alias("line"))
    empty = spark.createDataFrame([("d0/none.csv", 0, None)], "source_file string, at long, line string")
    root = tmp_path / "tree"
    for _ in range(2):  # a second run writes the same files again
        write_tree(lines.union(empty), str(root), ["at"])
    found = sorted(str(p.relative_to(root)) for p in root.rglob("*") if p.is_file())
    assert found == sorted([f"d{a}/r{b}.csv" for a in range(3) for b in range(7)] + ["d0/none.csv"])
    assert (root / "d0/none.csv").read_text() == ""
    want = "".join(f"é,{i}\n" for i in range(30_000) if i % 3 == 1 and i % 7 == 4)
    assert (root / "d1/r4.csv").read_text() == want
