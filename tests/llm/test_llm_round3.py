"""Centroid clustering, the Merkle manifest and token counts against plain versions."""

import hashlib
import math
import os
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from tallymark.llm import centroids, common, counts, manifest, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("tree string, node string, now string, pos long, total long, part int, place long, "
         "row long, block long, raw binary, words string, word string, cluster int, parts int")


@pytest.fixture(autouse=True)
def shipped(spark):
    common.ship(spark)


def clashing(frame):
    """The frame with columns named as the operators name theirs."""
    return frame.select("*", *[
        F.lit(None).cast(kind).alias(name)
        for name, kind in (c.split() for c in CLASH.split(", ")) if name not in frame.columns])


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


# Centroids -----------------------------------------------------------------------------------

def plain_clusters(vectors, plan):
    """Clusters of (id, parts) by comparing everything, in Python integers."""
    start = sorted(vectors, key=lambda v: (hashlib.sha256(
        f"{plan.seed}:{'' if v[0] is None else v[0]}".encode()).hexdigest(), v[1]))
    centres = [list(v[1]) for v in start[:plan.clusters]]

    def nearest(x):
        gaps = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centres]
        return gaps.index(min(gaps)), min(gaps)

    for _ in range(plan.rounds):
        own = [nearest(v[1])[0] for v in vectors]
        for j in range(len(centres)):
            mine = [v[1] for v, o in zip(vectors, own) if o == j]
            if mine:
                centres[j] = [sum(c) // len(mine) for c in zip(*mine)]
    own = [nearest(v[1]) for v in vectors]
    inertia = [sum(d for o, d in own if o == j) for j in range(len(centres))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted([(v[0], o, d, inertia[o], sum(inertia), names[o])
                   for v, (o, d) in zip(vectors, own)], key=repr)


def test_clusters_over_several_rounds(spark):
    plan = centroids.Plan(clusters=7, rounds=6, dims=5, scale=8)
    rng = np.random.default_rng(5)
    middle = rng.normal(0, 6, (9, 5))
    made = [(i, (middle[i % 9] + rng.normal(0, 1.5, 5)).tolist()) for i in range(900)]
    frame = spark.createDataFrame(made, "vec_id long, embedding array<double>")
    out = centroids.clustered(frame, plan)
    plain = plain_clusters([(i, [math.floor(8 * x) for x in v]) for i, v in made], plan)
    assert rows_of(out.drop("scans")) == plain
    # Bounds settle most vectors: far fewer scans than one per vector and round.
    assert out.agg(F.sum("scans")).first()[0] < 900 * 3


def test_unusable_vectors_ties_and_repeats(spark):
    plan = centroids.Plan(clusters=4, rounds=2, dims=2, scale=1)
    good = [(1, [0.0, 0.0]), (1, [0.0, 0.0]), (2, [2.5, -0.5]), (None, [-3.0, 7.0]),
            (None, [-3.0, 7.0]), (3, [1.0, 0.0]), (4, [1e300, -1e300])]
    bad = [(5, None), (6, []), (7, [1.0]), (8, [1.0, None]), (9, [float("nan"), 0.0]),
           (10, [float("inf"), 0.0]), (11, [1.0, 2.0, 3.0])]
    frame = clashing(spark.createDataFrame(good + bad, "vec_id long, embedding array<double>"))
    far = centroids.FARTHEST

    def whole(x):
        return math.floor(min(max(x, -far), far))

    plain = plain_clusters([(i, [whole(x) for x in v]) for i, v in good], plan)
    assert rows_of(centroids.clustered(frame, plan).drop("scans")) == plain
    assert centroids.clustered(frame.filter("vec_id > 4"), plan).collect() == []
    few = centroids.clustered(frame.filter("vec_id = 2"), plan).collect()
    assert [(r["vec_id"], r["cluster"], r["distance"]) for r in few] == [(2, 0, 0)]


def test_loosening_bounds_every_point_and_beats_the_move():
    rng = np.random.default_rng(1)
    smaller = 0
    for _ in range(200):
        k, d = 6, 4
        old = rng.integers(-40, 40, (k, d))
        new = old + rng.integers(-6, 7, (k, d)) * (rng.random((k, 1)) < 0.8)
        radii = rng.random(k) * 12
        loss = centroids.loosening(old, new, radii)
        move = np.sqrt(((new - old) ** 2).sum(1))
        for i in range(k):
            way = rng.normal(size=(300, d))
            way /= np.linalg.norm(way, axis=1, keepdims=True)
            x = old[i] + way * radii[i] * rng.random((300, 1)) ** (1 / d)
            for j in set(range(k)) - {i}:
                lost = (np.linalg.norm(x - old[j], axis=1) - np.linalg.norm(x - new[j], axis=1))
                assert lost.max() <= loss[i] + 1e-9
            others = max(move[j] for j in range(k) if j != i)
            assert loss[i] <= others + 1e-9
            smaller += loss[i] < others - 1e-9
    assert smaller > 600  # of 1,200 spheres


# Manifest ------------------------------------------------------------------------------------

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(nodes):
    """Root, and siblings and sides of each node."""
    where = [[(i, [])] for i in range(len(nodes))]
    paths = [[] for _ in nodes]
    while len(nodes) > 1:
        up, above = [], []
        for i in range(0, len(nodes), 2):
            pair = nodes[i:i + 2]
            for side, members in enumerate(where[i:i + 2]):
                for leaf, _ in members:
                    paths[leaf].append((pair[1 - side], side) if len(pair) == 2 else None)
            up.append(sha("".join(pair)))
            above.append([m for members in where[i:i + 2] for m in members])
        nodes, where = up, above
    return nodes[0] if nodes else None, paths


def plain_manifest(docs, tampered):
    def leaf(r):
        order = (r[0], r[3], r[2], r[4], r[1])
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in order))

    trees = {}
    for r in docs:
        now = r if not tampered(r) else (*r[:4], None if r[4] is None else r[4] + 1)
        trees.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), r[0], leaf(now)))
    langs = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    low = {g: plain_tree([t[2] for t in sorted(trees[g])]) for g in langs}
    root, high = plain_tree([low[g][0] for g in langs])
    out = []
    for g, upper in zip(langs, high):
        for (_, _, node, doc_id, now), path in zip(sorted(trees[g]), low[g][1]):
            folded = now
            for step in path + upper:
                folded = sha(folded if step is None else
                             step[0] + folded if step[1] else folded + step[0])
            proof = sha("".join(s[0] for s in path + upper if s))
            out.append((doc_id, node, low[g][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


ODD = [(i, f"text {i} é", g, "s", i) for i in range(150) for g in ("en", None)[:1 + i % 2]]
ODD += [(7, None, "de", None, None), (None, "", "de", "s", 0), (None, "", "de", "s", 0),
        (9, "x" * 3_000_000, "é", "s", 3_000_000), (9, "one id", "é", "s", 6),
        (14, "lone", "zz", "s", 2 ** 63 - 1), (3, "", "", "", 0)]


@pytest.mark.parametrize("bits", [1, 2, 3, 12])
def test_manifest_in_superblocks_of_any_size(spark, bits):
    """Small superblocks give several levels of exchange."""
    frame = spark.createDataFrame(ODD, DOCS)
    if bits == 2:
        frame = clashing(frame)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    got = rows_of(manifest.manifest(frame, {"n_chars": more}, tampered, bits))
    assert got == plain_manifest(
        ODD, lambda r: r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0)
    assert manifest.manifest(frame.limit(0), span_bits=bits).collect() == []


def test_untampered_manifest_verifies(spark):
    frame = spark.createDataFrame(ODD[:1], DOCS)
    [only] = manifest.manifest(frame).collect()
    assert only["verified"] and only["leaf"] == only["root"]
    assert only["proof_sha256"] == sha("")


@pytest.mark.parametrize("name", ["op11_centroids", "op12_manifest"])
def test_sql_counterparts_cover_their_columns(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    frame = queries.llm_queries()[name](spark, SF_DIR)
    rel = con.sql(queries.llm_oracles()[name]).select(*map(duckdb.ColumnExpression, frame.columns))
    assert rows_of(frame) == sorted(rel.fetchall(), key=repr)


# Token counts --------------------------------------------------------------------------------

def library_counts(rows):
    library = SentencePieceProcessor(model_file=MODEL)
    return sorted([(i, len((t or "").encode()), len(library.encode(t or "")),
                    len(library.encode(t or "")) > 4096) for i, t in rows], key=repr)


def test_query_equals_the_library(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet")
            .select("doc_id", "text").collect()]
    assert rows_of(queries.op13_token_counts(spark, SF_DIR)) == library_counts(rows)


def test_odd_texts_count_as_in_the_library(spark, monkeypatch):
    signs = ["a", "Zeit", " ", "  ", "▁", "\n", "\t", "7", "<s>", "</s>", "<unk>", "<0x0A>", "é",
             "中文", "\U0001f600", "\x00", "ﬁ", "'", "the", " the", ".", "\r\n", "-", "ß"]
    rng = random.Random(3)
    rows = [(i, "".join(rng.choices(signs, k=rng.randrange(40)))) for i in range(1500)]
    rows += [(1, None), (1, None), (None, ""), (None, " "), (2, "word " * 300_000),
             (3, "x" * 20_000), (4, "y " * 4095 + "y"), (5, "y " * 4096 + "y")]
    frame = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(counts.token_counts(frame, MODEL)) == library_counts(rows)
    assert counts.token_counts(frame.limit(0), MODEL).collect() == []
    # Slices and blocks of a few characters, in this process.
    monkeypatch.setattr(counts, "SLICE_CHARS", 3)
    with open(MODEL, "rb") as file:
        counting = counts.Counting(file.read())
    for _, text in rows[:400]:
        found = counting.frequencies(text)
        total = sum(n * often for n, often in zip(counting.pieces(list(found)), found.values()))
        assert total == len(counting.library.encode(text))


def test_numbers_survive_packing():
    numbers = np.array([0, 1, 255, 256, 70_000, 2 ** 32 - 1], np.uint32)
    packed = counts.planes(numbers.view(np.uint8), 4)
    assert counts.from_planes(packed, 6, np.uint32).tolist() == numbers.tolist()
    assert counts.from_planes(counts.planes(np.zeros(0, np.uint8), 4), 0, np.uint32).size == 0


def test_other_models_are_refused():
    class Joining:
        get_piece_size = staticmethod(lambda: 1)
        is_byte = is_control = is_unknown = staticmethod(lambda i: False)
        id_to_piece = staticmethod(lambda i: "of▁the")

    real = counts.SentencePieceProcessor
    counts.SentencePieceProcessor = lambda model_proto: Joining()
    try:
        with pytest.raises(ValueError):
            counts.Counting(b"")
    finally:
        counts.SentencePieceProcessor = real


# Stages ----------------------------------------------------------------------------------------

def test_stages_give_back_columns_of_any_name(spark, tmp_path):
    """Names that the stages use themselves; values must come back as they were."""
    import corpus_pipeline

    names = ["__key", "__row", "__bands", "__found", "__lines", "__removed", "__tried", "k0", "x1",
             "n_tokens", "ids_sha256", "bpe_n_tokens", "text_bytes", "digest"]
    body = " ".join(f"word{i}" for i in range(40))
    rows = [(i, f"{body} {i} " + " ".join(f"own{i}x{j}" for j in range(60)), "en", "s", 9)
            for i in range(12)]
    frame = spark.createDataFrame(rows, DOCS)
    frame = frame.select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in names])
    spark.createDataFrame([(1, "no such text at all in here")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    kept = None
    for name, stage in corpus_pipeline.STAGES:
        frame = common.staged(stage(spark, frame, str(tmp_path)), name)
        kept = frame.collect()
        assert kept
        for r in kept:
            assert [r[n] for n in names] == [f"{n}{r['doc_id']}" for n in names]
    assert {"bpe_bpe_n_tokens", "bpe_ids_sha256", "decoded_sha256", "token_ids"} <= set(frame.columns)


def test_ranges_of_lengths():
    assert list(common.by_length([], 5)) == []
    assert list(common.by_length([9, 1, 1, 3, 1], 5)) == [(0, 1), (1, 4), (4, 5)]
    assert list(common.by_length([0, 0], 5)) == [(0, 2)]
