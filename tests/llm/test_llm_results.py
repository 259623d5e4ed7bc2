"""Each operator against a plain version of it, on the smallest tables."""

import base64
import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from tallymark.llm import bpe, components, decontam, langid, lm, minhash, pieces, quality, queries
from tallymark.llm import licenses, lines, rans, repeats, trie
from tallymark.llm.exchange import packed, shard_cuts, unpacked

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


def result(spark, name):
    return {r["doc_id"]: r for r in queries.llm_queries()[name](spark, SF_DIR).collect()}


@pytest.mark.parametrize("name", sorted(queries.llm_oracles()))
def test_sql_counterpart(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    frame = queries.llm_queries()[name](spark, SF_DIR)
    names = sorted(frame.columns)
    ours = sorted((tuple(r) for r in frame.select(*names).collect()), key=repr)
    rel = con.sql(queries.llm_oracles()[name])
    order = [[d[0] for d in rel.description].index(n) for n in names]
    assert ours == sorted((tuple(r[i] for i in order) for r in rel.fetchall()), key=repr)


def test_lines_near_threshold_are_counted_exactly(spark):
    rows = [(i, f"a line on many sites\nown line number {i} here\nagain a line",
             "en", f"s{i % 11}", 0) for i in range(30)]
    rows += [(100 + i, f"a line on nine sites\nown line number {i} there", "en", f"s{i % 9}", 0)
             for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                        "n_chars long")
    out = {r["doc_id"]: r for r in lines.without_boilerplate(frame).collect()}
    assert out[0]["text"] == "own line number 0 here" and out[0]["n_chars"] == 22
    assert out[100]["text"].startswith("a line on nine sites") and out[100]["n_chars"] == 0


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, "
                                 "n_chars long")


def test_a_text_of_boilerplate_alone_loses_it(spark):
    menu = "home about and contact\nall rights are reserved"
    rows = [(i, f"{menu}\nthis page tells of matter number {i} and goes on about it at length",
             f"s{i}") for i in range(12)]
    rows += [(50, menu + "\nx", "s1"), (51, menu, "s2")]
    out = {r["doc_id"]: r["text"] for r in lines.without_boilerplate(documents(spark, rows)).collect()}
    assert out[0].startswith("this page") and out[50] == "x" and out[51] == ""


def test_lines_that_copies_share_stay(spark):
    body = [f"line {k} of a text that was copied to many sites and edited in one word"
            for k in range(4)]

    def copy(i):
        own = list(body)
        own[i % 4] = own[i % 4].replace("edited", f"edited{i}")
        return "\n".join(own)

    rows = [(i, copy(i), f"s{i % 20}") for i in range(2000)]
    rows += [(5000 + i, "\n".join(body), f"s{i}") for i in range(20)]
    docs = documents(spark, rows)
    kept = lines.without_boilerplate(docs)
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == {i: t for i, t, _ in rows}
    assert kept.select("n_chars").distinct().count() > 1


def test_language_model(spark, texts):
    got = result(spark, "op2_lm_scoring")
    words = {i: t.encode().lower().split() + [None] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    one = Counter(w for i in words if not held[i] for w in words[i])
    two = Counter(p for i in words if not held[i] for p in zip(["<s>"] + words[i][:-1], words[i]))
    after = Counter(a for a, _ in two)
    total, distinct = sum(one.values()), len(one)
    one["<s>"] = sum(not h for h in held.values())
    for i, own in words.items():
        r = got[i]
        floor = [(one[w] + 0.1) / (total + 0.1 * (distinct + 1)) for w in own]
        p = [f if not one[a] else max(two[a, w] - lm.DISCOUNT, 0) / one[a]
             + lm.DISCOUNT * after[a] / one[a] * f
             for a, w, f in zip(["<s>"] + own[:-1], own, floor)]
        assert r["held_out"] == held[i] and r["n_tokens"] == len(own)
        assert r["train_tokens"] == total and r["n_known"] == sum(one[w] > 0 for w in own)
        assert r["base_score"] == pytest.approx(sum(map(math.log10, floor)), abs=1e-6)
        step = -trie.LOWEST / trie.LEVELS
        assert abs(r["score"] - sum(map(math.log10, p))) <= step * len(own)


def test_language_model_is_a_distribution(spark):
    rows = [(i, " ".join(random.Random(i).choices("abcdefg", k=40)), i == 3) for i in range(12)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    context = "a b"
    probes = [(100 + i, f"{context} {w}".strip(), True) for i, w in enumerate("abcdefg")]
    probes += [(200, context, True), (300, "a", True)]
    out = {r["doc_id"]: r["score"] for r in lm.scored(frame.union(
        spark.createDataFrame(probes, frame.schema))).collect()}
    # p(w | b) = score(a b w end) - end after w ... the end after b closes the sum.
    ends = {w: _end_after(rows, w) for w in "abcdefg"}
    total = sum(10 ** (out[100 + i] - ends[w]) for i, w in enumerate("abcdefg")) + 10 ** out[200]
    before = 10 ** (out[200] - _end_after(rows, "b"))
    assert total / before == pytest.approx(1.0, abs=0.12)


def test_language_model_hot_context_with_one_successor(spark):
    """A third of the rows are copies; a word of theirs is dealt and has one successor."""
    texts = ["zig zag " * 10] * 40 + [" ".join(random.Random(i).choices("abcdefghijk", k=30))
                                      for i in range(80)]
    rows = [(i, t, False) for i, t in enumerate(texts)]
    rows += [(1000 + i, f"zig {w}", True) for i, w in enumerate("abcdefghijk")]
    out = {r["doc_id"]: r["score"] for r in lm.scored(spark.createDataFrame(
        rows, "doc_id long, text string, held_out boolean")).collect()}
    words = [t.split() + [None] for t in texts]
    one = Counter(w for t in words for w in t)
    two = Counter(p for t in words for p in zip(["<s>"] + t[:-1], t))
    after, total = Counter(a for a, _ in two), sum(one.values())
    one["<s>"], distinct = len(texts), len(one)
    for i, w in enumerate("abcdefghijk"):
        want = 0
        for a, b in (("<s>", "zig"), ("zig", w), (w, None)):
            floor = (one[b] + 0.1) / (total + 0.1 * (distinct + 1))
            want += math.log10((max(two[a, b] - lm.DISCOUNT, 0)
                                + lm.DISCOUNT * after[a] * floor) / one[a])
        assert out[1000 + i] == pytest.approx(want, abs=3 * -trie.LOWEST / trie.LEVELS)


def _end_after(rows, word):
    texts = [t.split() + [None] for _, t, held in rows if not held]
    one = Counter(w for t in texts for w in t)
    two = Counter(p for t in texts for p in zip(t, t[1:]))
    after = sum(1 for a, _ in two if a == word)
    total, distinct = sum(one.values()), len(one)
    floor = (one[None] + 0.1) / (total + 0.1 * (distinct + 1))
    return math.log10(max(two[word, None] - 0.75, 0) / one[word] + 0.75 * after / one[word] * floor)


@given(st.lists(st.integers(0, 2**62), max_size=200))
@settings(max_examples=60, deadline=None)
def test_elias_fano_and_packing(values):
    values = np.array(sorted(values), np.uint64)
    low, low_bits, high_bits = trie.EliasFano.write(values)
    back = trie.EliasFano.read(len(values), low, np.frombuffer(low_bits, np.uint8),
                               np.frombuffer(high_bits, np.uint8))
    assert (back == values).all() and (unpacked(packed(values)) == values).all()
    cuts = shard_cuts(values, 7)
    assert cuts[0] == 0 and cuts[-1] == len(values) and (np.diff(cuts) >= 0).all()


def test_language_id(spark):
    got = result(spark, "op3_language_id")
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(
        f"{SF_DIR}/documents.parquet").collect()}
    held = [i for i, r in got.items() if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert sum(got[i]["lang_pred"] == truth[i] for i in held) >= 0.95 * len(held)


def test_forward_backward_and_switches():
    rng = np.random.default_rng(0)
    scores, moves = rng.normal(size=(7, 3)), rng.normal(size=(3, 3))
    found, _ = langid.marginals(scores, np.array([4, 0, 3]), moves)
    for start, n in ((0, 4), (4, 3)):
        total = np.zeros((n, 3))
        for path in np.ndindex(*[3] * n):
            w = math.exp(sum(scores[start + t, s] for t, s in enumerate(path))
                         + sum(moves[a, b] for a, b in zip(path, path[1:])))
            for t, s in enumerate(path):
                total[t, s] += w
        assert np.allclose(found[start:start + n], total / total.sum(axis=1, keepdims=True))
    english = [("the house of the people is on the hill with that tree", "en")] * 20
    french = [("la maison des gens est sur une colline avec cet arbre", "fr")] * 20
    field = langid.fit(english + french)
    switched = field.word_labels("the house of the people la maison des gens est")
    assert [label for _, label, _ in switched] == ["en"] * 5 + ["fr"] * 5


def test_bpe(spark, texts):
    got = result(spark, "op5_bpe")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {token: i for i, token in enumerate(bpe.read_ranks(path))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                special_tokens={})
    for i, text in texts.items():
        ids = library.encode_ordinary(text)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def codec():
    tokens = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    ranks = {token: i for i, token in enumerate(tokens)}
    return bpe.Codec(tokens, public_tokenizers.PATTERN), tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@given(text=st.text(st.one_of(st.sampled_from(" \n\t\r 　'sT9.!x\x1c\x85"),
                              st.characters(blacklist_categories=["Cs"])), max_size=60))
@settings(max_examples=300, deadline=None)
def test_bpe_any_text(codec, text):
    own, library = codec
    ids = own.encode(text).tolist()
    assert ids == library.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


def test_perfect_hash_is_minimal():
    keys = [f"key{i}".encode() for i in range(1000)]
    table = bpe.PerfectHash(keys)
    assert sorted(table.place_of) == list(range(1000))
    assert [table.find(k) for k in keys] == list(range(1000))


def distance(pattern, text):
    """Least edit distance of the pattern to any stretch of the text, row by row."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@given(st.text("ab c", min_size=1, max_size=40), st.text("ab c", max_size=60))
@settings(max_examples=100, deadline=None)
def test_bit_parallel_distance(pattern, text):
    assert decontam.least_distance(decontam.character_masks(pattern), len(pattern), text) == \
        distance(pattern, text)


def test_decontamination(spark):
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "omega", "kappa", "sigma", "theta"]
    items = [(i, " ".join(rng.choices(words, k=15))) for i in range(6)]
    rows = []
    for i in range(40):
        text = " ".join(rng.choices(words, k=20))
        if i % 2:
            planted = list(items[i % 6][1])
            for _ in range(i % 8):
                planted[rng.randrange(len(planted))] = rng.choice("xyz ")
            text += " " + "".join(planted).upper() + " tail"
        rows.append((i, text))
    got = {tuple(r) for r in decontam.matches(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = set()
    for i, text in rows:
        for j, item in items:
            d = distance(decontam.normal(item), decontam.normal(text))
            if d <= decontam.EDIT_RATE * len(decontam.normal(item)):
                want.add((i, j, d))
    assert got == want and len(want) >= 10


def test_decontamination_in_blocks(spark, monkeypatch):
    items = spark.createDataFrame([(i, f"passage number {i} of the test set here") for i in
                                   range(20)], "item_id long, text string")
    assert sum(len(b) for b in decontam.item_blocks(items, 100)) == 20
    assert len(list(decontam.item_blocks(items, 100))) > 3


def test_token_files(spark, texts):
    got = result(spark, "op7_token_files")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start = 0
    for i in sorted(texts):
        ids = tokenizer.encode(texts[i], add_special_tokens=False).ids + [0]
        assert tuple(got[i]) == (i, start, len(ids),
                                 zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_token_files_with_added_tokens(spark):
    texts = ["<|endoftext|>", "a  <|endoftext|>  b c", "one<|endoftext|><|endoftext|> two", "a  b",
             "", "plain words", "x " * 3 + "<|endoftext|>\n\n y", "<|endoftext", "a  b <|endoftext|>"]
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = {r["doc_id"]: r for r in rans.read_files(*rans.write_files(spark.createDataFrame(
        list(enumerate(texts)), "doc_id long, text string"), path)).collect()}
    tokenizer, start = Tokenizer.from_file(path), 0
    for i, text in enumerate(texts):
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        assert tuple(got[i]) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


@given(st.lists(st.integers(0, 300), max_size=3000), st.integers(0, 3))
@settings(max_examples=30, deadline=None)
def test_range_coder(ids, repeat):
    ids = np.array(ids * 40 ** repeat if len(ids) < 50 else ids, np.int64)
    counts = np.bincount(ids, minlength=1)
    freq = rans.shared_table(counts)
    assert not len(ids) or freq.sum() == 1 << rans.BITS and (freq[counts > 0] > 0).all()
    table = rans.Table(freq)
    assert (rans.decode(len(ids), *rans.encode(ids, table), table) == ids).all()


def test_damaged_block_is_told(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "some words to encode here")], "doc_id long, text string")
    files, freq = rans.write_files(docs, public_tokenizers.path("byte_bpe_50k.json"))
    bad = files.withColumn("ids_crc32", F.col("ids_crc32") + 1)
    with pytest.raises(Exception, match="damaged"):
        rans.read_files(bad, freq).collect()


def plain_removal(texts):
    seen, out = set(), {}
    for i, text in sorted(texts.items()):
        raw = text.encode()
        covered = bytearray(len(raw))
        for p in range(len(raw) - 99):
            if raw[p:p + 100] in seen:
                covered[p:p + 100] = b"\1" * 100
            seen.add(raw[p:p + 100])
        kept = bytes(b for b, c in zip(raw, covered) if not c)
        spans = sum(c and not (k and covered[k - 1]) for k, c in enumerate(covered))
        out[i] = (i, len(raw), sum(covered), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_repeats(spark, texts):
    got = result(spark, "op8_suffix_dedup")
    assert {i: tuple(r) for i, r in got.items()} == plain_removal(texts)


def test_repeats_of_all_kinds(spark, monkeypatch):
    unit = bytes(range(65, 125)).decode()
    texts = {0: "", 1: "x" * 99, 2: "y" * 250, 3: "ab" * 200, 4: "y" * 250, 5: "z" + "y" * 120,
             6: unit * 5, 7: "short", 8: "q" * 10 + unit * 2 + "w", 9: "ab" * 70 + "c" + unit * 2}
    rng = random.Random(1)
    base = "".join(rng.choices("abcd ", k=600))
    for i in range(10, 40):
        a, b = rng.randrange(400), rng.randrange(100, 300)
        texts[i] = "".join(rng.choices("abcd ", k=rng.randrange(60))) + base[a:a + b] + "é"
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[:5] for r in repeats.removed(frame).collect()}
    assert got == plain_removal(texts)


def multiset(text):
    words = re.split(rb"[\x20\x09-\x0D]+", text.encode().lower().strip(b" \t\n\r\x0b\x0c"))
    words = [w for w in words if w]
    if len(words) < 5:
        return Counter([tuple(words)]) if words else Counter()
    return Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def plain_classes(texts, least=0.8):
    sets = {i: multiset(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(texts):
        for j in sorted(texts):
            if j < i and sets[i] and sets[j]:
                both = sum((sets[i] & sets[j]).values())
                if both and both >= least * (sets[i] | sets[j]).total():
                    a, b = root(i), root(j)
                    parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in texts}


def test_near_classes(spark, texts):
    got = result(spark, "op9_near_dedup")
    want = plain_classes(texts)
    assert {i: r["class_id"] for i, r in got.items()} == want
    sizes = Counter(want.values())
    assert all(r["class_rows"] == sizes[want[i]] for i, r in got.items())


def test_chains_of_near_copies(spark):
    """Links run between members of a bucket that its leader does not resemble."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(5000)]
    texts, current = {}, rng.choices(words, k=200)
    for i in range(25):
        texts[i] = " ".join(current)
        at = rng.randrange(190)
        current = current[:at] + rng.choices(words, k=2) + current[at + 2:]
    texts[50] = " ".join(rng.choices(words, k=200))
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_classes(frame).collect()}
    assert got == plain_classes(texts)


def test_crowded_buckets_in_blocks(spark, monkeypatch):
    """A tree of drifting copies whose buckets hold many groups, compared in small blocks."""
    monkeypatch.setattr(minhash, "SMALL", 2)
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(6)
    words = [f"w{i}" for i in range(5000)]
    known = [rng.choices(words, k=120)]
    for _ in range(120):
        own = list(rng.choice(known))
        for _ in range(rng.choice((1, 2, 4))):
            own[rng.randrange(120)] = rng.choice(words)
        known.append(own)
    texts = {i: " ".join(own) for i, own in enumerate(known)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_classes(frame).collect()}
    assert got == plain_classes(texts)


def test_signature_estimates_weighted_similarity():
    rng = random.Random(4)
    errors = []
    for trial in range(40):
        words = [f"t{trial}w{i}".encode() for i in range(400)]
        a = rng.choices(words[:40], k=200)
        b = [rng.choice(words) if rng.random() < 0.1 else w for w in a]
        owner, keys, counts = minhash.shingles([b" ".join(a), b" ".join(b)], 1)
        s = minhash.signatures(owner, keys, counts, 2, 512)
        x, y = Counter(a), Counter(b)
        errors.append((s[0] == s[1]).mean() - (x & y).total() / (x | y).total())
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.04


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (200, 201), (201, 202)]
    got = {r["node"]: r["label"] for r in components.components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 200: 200, 201: 200, 202: 200}


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = set()
    for i in range(len(words) - 4):
        if seen[tuple(words[i:i + 5])] > 1:
            covered |= set(range(i, i + 5))
    earlier, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in earlier
            earlier.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


def test_quality_counts(spark, texts):
    got = result(spark, "op10_quality")
    for i, text in texts.items():
        assert tuple(got[i])[1:7] == plain_counts(text)
        assert not (got[i]["base_failed"] and got[i]["kept"])


def test_quality_verdict_follows_labels(spark):
    got = result(spark, "op10_quality")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(
        f"{SF_DIR}/labels.parquet").collect()}
    good = [got[i]["kept"] for i, q in labels.items() if q == 1 and not got[i]["base_failed"]]
    bad = [got[i]["kept"] for i, q in labels.items() if q == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.35 * len(bad)


@pytest.mark.parametrize("kind", ["one source", "copies", "near copies"])
def test_quality_reference_is_not_moved_by_a_hot_group(spark, kind):
    """A third of the rows are odd texts: of one source, equal, or nearly equal on all sources."""
    rng = random.Random(8)
    words = "the of and to in a is that house river people garden letter evening".split()
    rows = [(i, " ".join(rng.choices(words, k=200)), "en", f"s{i % 10}") for i in range(400)]
    odd = " ".join("#%04d" % rng.randrange(9999) for _ in range(200))
    for i in range(400, 600):
        text = odd if kind == "copies" else odd + f" #{i}"
        rows.append((i, text, "en", "s0" if kind == "one source" else f"s{i % 10}"))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["kept"] for r in quality.quality_report(frame).collect()}
    assert all(got[i] for i in range(400)) and not any(got[i] for i in range(400, 600))


def test_js_distance():
    counts = np.array([[3.0, 1.0, 0.0], [0.0, 0.0, 0.0]])
    reference = np.array([[0.25, 0.25, 0.5], [1.0, 0.0, 0.0]])
    p, q = counts[0] / 4, reference[0]
    m = (p + q) / 2
    want = math.sqrt(sum(a * math.log2(a / c) for a, c in zip(p, m) if a) / 2
                     + sum(b * math.log2(b / c) for b, c in zip(q, m) if b) / 2)
    found = quality.js_distance(counts, reference)
    assert found[0] == pytest.approx(want) and math.isnan(found[1])


def test_license_lines(spark):
    rows = [(1, "Released under the MIT-License\nmit license, mit license"),
            (2, "Licensed under the Apache License, v. 2.0 today"),
            (3, "PERMISSION is hereby granted, free of charge, to any person obtaining a copy of "
                "this software and its documentation files"),
            (4, "permission is hereby granted"), (5, "mitt license the apache licenses")]
    got = {r["doc_id"]: r for r in licenses.scan(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"]) == (3, 3, 7)
    assert got[1]["labels"] == "mit,mit-notice" and got[1]["score"] == 1.0
    assert got[3]["labels"] == "mit-text" and 0.8 <= got[3]["score"] < 1
    assert got[4]["labels"] == "" and got[5]["n_base"] == 0


def test_license_texts_over_broken_lines(spark):
    import random
    import textwrap

    def wrapped(name, width=64):
        return textwrap.fill(" ".join(licenses.TEMPLATES[name].split()), width)

    mixed = [w for t in licenses.TEMPLATES.values() for w in licenses.words_of(t)]
    random.Random(3).shuffle(mixed)
    other = "some words of another matter altogether " * 40
    rows = [(i, f"{other}\n\n{wrapped(name)}\n\n{other}")
            for i, name in enumerate(licenses.TEMPLATES)]
    rows += [(100, " ".join(mixed[:600])), (101, "It is released under the Apache license."),
             (102, wrapped("mit-full").lower().replace("software", "program")),
             (103, ("x " * 50000) + wrapped("bsd-2-full"))]
    rows += [(104 + k, "word " * k + wrapped("isc-full") + " word" * 200) for k in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan(frame).collect()}
    for i, name in enumerate(licenses.TEMPLATES):
        assert name in got[i]["labels"].split(",") and got[i]["score"] == 1.0
    assert got[100]["labels"] == "" and got[101]["labels"] == "apache"
    assert "mit-full" in got[102]["labels"] and got[102]["score"] < 1
    assert "bsd-2-full" in got[103]["labels"]
    assert all("isc-full" in got[104 + k]["labels"] for k in range(60))
    con = duckdb.connect()
    documents = frame.toPandas()  # noqa: F841  (read by the SQL)
    con.register("documents", documents)
    rel = con.sql(licenses.oracle())
    names = [d[0] for d in rel.description]
    want = {r[names.index("doc_id")]: dict(zip(names, r)) for r in rel.fetchall()}
    assert {i: r.asDict() for i, r in got.items()} == want


def test_piece_memo_joins_runs():
    memo = pieces.PieceMemo(lambda t: f"<{t}>".encode())
    assert memo.text("a b  c\n d") == b"<a>< b >< c\n>< d>"
    assert memo.text("a b c") == b"<a>< b>< c>"


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    truth = {r["doc_id"]: r["text"] for r in docs.collect()}
    from tallymark.llm.common import staged

    sets = []
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF_DIR), name)
        sets.append({r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()})
    assert set(sets[0]) == {i for i, r in result(spark, "op10_quality").items() if r["kept"]}
    assert set(sets[1]) == set(sets[0]) and len(truth) > len(sets[0])
    want = plain_classes(sets[1])
    assert set(sets[2]) == set(want.values())
    items = [decontam.normal(r["text"]) for r in spark.read.parquet(
        f"{SF_DIR}/benchmark.parquet").collect()]
    leaked = {i for i, t in sets[2].items() if any(x in decontam.normal(t) for x in items)}
    assert not leaked & set(sets[3]) and set(sets[2]) - set(sets[3]) >= leaked
    assert {i: sets[3][i] for i in sets[4]} == sets[4] and len(sets[4]) == len(sets[3])
    run = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert run == {r["doc_id"]: r["n_tokens"] for r in docs.collect()}
