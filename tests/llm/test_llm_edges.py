"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib

import public_tokenizers
import pytest

import corpus_pipeline
from tallymark.llm import bpe, common, decontam, langid, licenses, lines, lm, minhash, quality, rans
from tallymark.llm import repeats

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("block long, key string, label string, band long, node long, h1 long, kept string, "
            "n_tokens string, n_words string, score string, class_counts string, line string, "
            "a long, b long, raw string, held_out string")
LONG = " ".join(f"word{i % 997}x{i}" for i in range(60_000))
ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "s1", 0),
    (3, "The same words stand here and in the next row of it.", "en", "s1", 52),
    (3, "The same words stand here and in the next row of it.", "en", "s1", 52),
    (4, "The same words stand here and in the next row of it.", "en", None, 52),
    (None, "A row without an id holds some words of the language too.", "en", "s2", 57),
    (5, LONG, "de", "s2", len(LONG)),
    (6, " \t\n \r\n", "fr", "s3", 6),
    (7, "1234 5678", None, "s3", 9),
    (8, "café 中文 \U0001f600 naïve", "fr", "s3", 15),
]
BENCHMARK = "item_id long, text string"


@pytest.fixture
def docs(spark):
    common.ship(spark)
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture
def empty(spark):
    common.ship(spark)
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def clashing(docs):
    from pyspark.sql import functions as F

    names = [part.split() for part in CLASHING.split(", ")]
    return docs.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in names])


def token_files(docs):
    return rans.read_files(*rans.write_files(docs, public_tokenizers.path("byte_bpe_50k.json")))


def encoded(docs):
    return bpe.encoded(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                       public_tokenizers.PATTERN, ["doc_id"])


def scored(docs):
    return lm.scored(docs.withColumn("held_out", langid.remainder(docs["doc_id"], 10) == 0))


PER_ROW = {
    "lines": lines.line_report, "lm": scored, "langid": langid.held_out_report,
    "licenses": licenses.scan, "bpe": encoded, "rans": token_files, "repeats": repeats.removed,
    "minhash": minhash.near_classes, "quality": quality.quality_report,
}


@pytest.mark.parametrize("name", PER_ROW)
def test_every_row_has_a_result(docs, clashing, empty, name):
    run = PER_ROW[name]
    plain = run(docs).collect()
    assert sorted(str(r["doc_id"]) for r in plain) == sorted(str(r[0]) for r in ROWS)
    again = run(clashing).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, plain))
    assert run(empty).collect() == []


def test_defined_results(docs):
    def by_id(df):
        return {r["doc_id"]: r for r in df.collect()}

    void = hashlib.sha256(b"").hexdigest()
    assert by_id(encoded(docs))[1][1:4] == (0, void, void)
    found = by_id(langid.held_out_report(docs))
    assert [found[i]["lang_pred"] for i in (1, 2, 6, 7)] == ["und"] * 4
    assert found[1]["score"] == 0.0 and 0 < found[3]["score"] <= 1
    found = by_id(licenses.scan(docs))
    assert found[1][1:] == (0, 0, None, None, "", "", 0.0)
    found = by_id(minhash.near_classes(docs))
    assert found[1]["class_id"] == 1 and found[4]["class_id"] == 3
    assert found[4]["class_rows"] == 3 and found[2]["class_rows"] == 1
    found = by_id(quality.quality_report(docs))
    assert not found[1]["kept"] and found[1]["base_failed"] and found[1]["n_words"] == 0
    found = by_id(lines.line_report(docs))
    assert found[1]["n_lines"] == 1 and found[1]["kept_sha256"] == void
    found = by_id(repeats.removed(docs))
    assert found[1]["n_bytes"] == 0 and found[3]["n_removed"] == 0
    found = by_id(scored(docs))
    assert found[1]["n_tokens"] == 1 and found[2]["n_tokens"] == 1
    found = by_id(token_files(docs))
    assert found[None]["start"] == 0 and found[1]["n_tokens"] == 1


def test_stages_keep_columns(spark, docs, clashing, empty, tmp_path):
    spark.createDataFrame([(1, None), (None, "x y z"), (2, "")], BENCHMARK).write.parquet(
        str(tmp_path / "benchmark.parquet"))
    for frame in (clashing, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = common.staged(stage(spark, frame, str(tmp_path)), name)
            if name != "bpe":
                assert out.columns == frame.columns
                assert [f.dataType for f in out.schema] == [f.dataType for f in frame.schema]
            frame = out
    kept = minhash.one_of_each(docs).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["1", "2", "3", "5", "6", "7", "8", "None"]
    assert decontam.without_leaks(docs, spark.createDataFrame([], BENCHMARK)).count() == len(ROWS)
    assert decontam.matches(docs, spark.createDataFrame([], BENCHMARK)).collect() == []


def test_scratch_uses_the_shared_folder(spark):
    assert common.scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
