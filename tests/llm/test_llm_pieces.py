"""Pieces put together from words and marks, and many of them encoded in one text."""

import random
import string

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallymark.llm import common, pieces, rans

PACKED = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
ALPHABET = [*"ab'stdreLLvm.,;   \n\t\r\x0b\x1c\x1f\x00019é 　-_<|>", "'ll", "endoftext",
            "<|endoftext|>"]


@pytest.fixture
def table():
    rans._tokenizers.clear()
    return rans.worker_pieces(PACKED)


def test_marks_make_no_new_words(table):
    table.texts([b"so thonwh. thonwh, thonwh; (thonwh) thonwh.\nthonwh"], 0)
    assert set(table.known) == {"so", "thonwh"}


def test_pieces_as_the_library_has_them(table):
    own = Tokenizer.from_str(PACKED)
    chosen = random.Random(5)
    for limit in (1000, 3):
        table.limit = limit
        for _ in range(20):
            texts = ["".join(chosen.choices(ALPHABET, k=chosen.randint(0, 40))) for _ in range(300)]
            ids, counts = table.texts([t.encode() for t in texts], 0)
            wanted = [e.ids + [0] for e in own.encode_batch_fast(texts, add_special_tokens=False)]
            assert counts.tolist() == list(map(len, wanted))
            assert (ids == np.concatenate(wanted)).all()


def test_marks_at_the_end_need_no_search(table, monkeypatch):
    class Searches:
        def findall(self, text):
            raise AssertionError(f"searched {text!r}")

    own = Tokenizer.from_str(PACKED)
    texts = [f"start thonwh{a}{b} thonwh" for a in [*string.punctuation, "_'", "'_"]
             for b in ["", *string.punctuation, "$$$"]]
    monkeypatch.setattr(pieces, "ASCII_MATCHES", Searches())
    ids, _ = table.texts([t.encode() for t in texts], 0)
    assert ids.tolist() == [i for t in texts for i in [*own.encode(t, add_special_tokens=False).ids, 0]]


def test_counts_come_with_the_last_row_of_a_part(spark):
    common.ship(spark)
    texts = ["red blue. " * 150_000, None, "green, " * 200_000, "x", ""]
    rows = common.staged(rans.id_rows(spark.createDataFrame(
        list(enumerate(texts)), "doc_id long, text string").coalesce(1),
        public_tokenizers.path("byte_bpe_50k.json")), "ids")
    wanted = np.zeros(0, np.int64)
    parts = {}
    for r in rows.collect():
        wanted = rans.summed(wanted, np.bincount(rans.from_planes(r["ids"], np.uint32)))
        parts.setdefault(r["part"], []).append((r["seq"], r["counts"] is not None))
    assert sum(map(len, parts.values())) > len(parts)
    for found in parts.values():
        assert [last for _, last in sorted(found)] == [False] * (len(found) - 1) + [True]
    counted = rans.id_counts(rows)
    assert {r["id"]: r["n"] for r in counted.collect()} == {
        i: int(n) for i, n in enumerate(wanted) if n}
    read = counted._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1]
    assert read.startswith("struct<counts:binary>")
