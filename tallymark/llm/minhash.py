"""Near-duplicates by BagMinHash signatures of word-shingle multisets.

A text is the multiset of its five-word shingles. A shingle of weight w (its count) draws
points of Poisson processes over time, one process for each block of weight levels (0,1],
(1,2], (2,4], (4,8] and so on, with the block's length as its rate; a point carries a level
within its block, and levels above w are passed over. Each point falls into one of the
signature's slots; a slot keeps its earliest point. Two texts agree in a slot with exactly
their weighted Jaccard similarity. Drawing stops when time passes the latest slot, so a long
text costs little more than its number of shingles.

Texts with equal words are one node. Nodes that share a band of the signature are candidates;
the multiset overlap of a pair is computed exactly before it counts as a link.

Candidates are not all pairs of a band's bucket. In a first pass every node meets the leader
of its bucket; linked nodes become one group. Only buckets that still hold several groups go
further: there, nodes of different groups are compared, in a small bucket pair by pair, in a
crowded one block against block inside a task, so no link between groups is lost.

Defined results: words are split at ASCII blanks and compared without ASCII case; a text of one
to four words is one shingle; null texts and texts without a word are never duplicates of
anything; rows with equal ids are handled each by its own text.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallymark.llm.common import by_size, extended, forget, out_of_the_way, ship, staged
from tallymark.llm.components import components

U = np.uint64
GOLDEN = 0x9E3779B97F4A7C15
SMALL = 8  # members of a bucket whose pairs are compared one by one
BLOCK = 512  # members of a larger bucket that a task compares with as many others
COLUMNS = 4096
#: Bytes of text signed at a time: the arrays of a chunk are some forty times as large.
SHINGLE_BYTES = 1 << 20


@dataclass(frozen=True)
class NearRules:
    width: int = 5
    similarity: float = 0.8
    bands: int = 32
    rows: int = 5

    @property
    def slots(self) -> int:
        return self.bands * self.rows


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of 64-bit numbers."""
    x = x + U(GOLDEN)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingles(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle, count), sorted by text and shingle."""
    hashes: dict[bytes, int] = {}
    split = [text.lower().split() for text in texts]
    for word in set(chain.from_iterable(split)):
        hashes[word] = xxhash.xxh64_intdigest(word)
    n_words = np.fromiter(map(len, split), np.int64, len(texts))
    words = np.fromiter(map(hashes.__getitem__, chain.from_iterable(split)), U, int(n_words.sum()))
    ends = np.cumsum(n_words)
    owner = np.repeat(np.arange(len(texts)), n_words)
    n = max(len(words) - width + 1, 0)
    keys = np.zeros(n, dtype=U)
    for i in range(width):
        keys = mixed(keys ^ words[i:i + n])
    inside = owner[:n] == owner[width - 1:width - 1 + n] if n else np.zeros(0, bool)
    owners, found = [owner[:n][inside]], [keys[inside]]
    for i in np.flatnonzero((n_words > 0) & (n_words < width)):
        key = np.array([n_words[i]], dtype=U)
        for word in words[ends[i] - n_words[i]:ends[i]]:
            key = mixed(key ^ word)
        owners.append(np.array([i]))
        found.append(key)
    owner, keys = np.concatenate(owners).astype(np.int64), np.concatenate(found)
    order = np.lexsort((keys, owner))
    owner, keys = owner[order], keys[order]
    if not len(keys):
        return owner, keys, np.zeros(0, np.int64)
    first = np.concatenate([[True], (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])])
    starts = np.flatnonzero(first)
    counts = np.diff(np.concatenate([starts, [len(keys)]]))
    return owner[starts], keys[starts], counts


def signatures(owner: np.ndarray, keys: np.ndarray, counts: np.ndarray, n: int,
               slots: int) -> np.ndarray:
    """(n, slots) earliest times; infinite for a text without shingles."""
    out = np.full(n * slots, np.inf)
    blocks = [(owner, mixed(keys), np.ones(len(keys)), np.zeros(len(keys)), counts)]
    level = 1
    while (more := counts > level).any():
        size = int(more.sum())
        blocks.append((owner[more], mixed(keys[more] ^ U(level * 2654435761)),
                       np.full(size, float(level)), np.full(size, float(level)), counts[more]))
        level *= 2
    doc, seed, rate, low, weight = (np.concatenate(parts) for parts in zip(*blocks))
    time = np.zeros(len(doc))
    draw = 0
    while len(doc):
        draw += 1
        a = mixed(seed + U((draw * 0xD1342543DE82EF95) & 0xFFFFFFFFFFFFFFFF))
        b = mixed(a)
        time = time - np.log(((a >> U(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / rate
        slot = (b & U(0xFFFFFFFF)).astype(np.int64) % slots
        height = low + 1 + np.floor((b >> U(32)).astype(np.float64) * 2.0 ** -32 * rate)
        counted = height <= weight
        np.minimum.at(out, doc[counted] * slots + slot[counted], time[counted])
        present = np.unique(doc)
        latest = np.full(n, np.inf)
        latest[present] = out.reshape(n, slots)[present].max(axis=1)
        going = time < latest[doc]
        doc, seed, rate, low, weight, time = (
            x[going] for x in (doc, seed, rate, low, weight, time))
    return out.reshape(n, slots)


def bands_of(signature: np.ndarray, rules: NearRules) -> np.ndarray:
    """(n, bands) hashes of each band's rows and its number."""
    bits = signature.view(U).reshape(len(signature), rules.bands, rules.rows)
    key = np.tile(np.arange(rules.bands, dtype=U), (len(signature), 1))
    for i in range(rules.rows):
        key = mixed(key ^ bits[:, :, i])
    return key


def content_key(text: bytes) -> bytes | None:
    """128 bits that stand for the words of a text; None without a word."""
    words = text.lower().split()
    return xxhash.xxh128_digest(b" ".join(words)) if words else None


def signed(docs: DataFrame, rules: NearRules) -> DataFrame:
    """All columns plus ``__row``, ``__key`` and ``__bands`` (null without a word)."""
    ship(docs.sparkSession)
    text = docs.columns.index("text")

    def run(batches):
        forget()
        for whole in batches:
            texts = [(t or "").encode() for t in whole.column(text).to_pylist()]
            for start, end in by_size(texts, SHINGLE_BYTES):
                own = texts[start:end]
                owner, keys, counts = shingles(own, rules.width)
                bands = bands_of(signatures(owner, keys, counts, len(own), rules.slots), rules)
                content = [content_key(t) for t in own]
                yield pa.RecordBatch.from_arrays(
                    whole.slice(start, end - start).columns + [
                        pa.array(content, pa.binary()),
                        pa.array([row.view(np.int64) if key else None
                                  for row, key in zip(bands, content)], pa.list_(pa.int64()))],
                    names=whole.schema.names + ["__key", "__bands"])

    return docs.mapInArrow(
        run, extended(docs, "__key binary, __bands array<long>")
    ).withColumn("__row", F.monotonically_increasing_id())


def payloads(rows: DataFrame, width: int) -> DataFrame:
    """(node, text) as (node, elements): the sorted multiset packed as bytes.

    The n-th copy of a shingle is an element of its own, so multiset overlap is set overlap.
    """
    def run(batches):
        for whole in batches:
            texts = [(t or "").encode() for t in whole.column(1).to_pylist()]
            for start, end in by_size(texts, SHINGLE_BYTES):
                owner, keys, counts = shingles(texts[start:end], width)
                copy = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
                owner, keys = np.repeat(owner, counts), np.repeat(keys, counts)
                keys = np.where(copy > 0, mixed(keys ^ (copy.astype(U) << U(40))), keys)
                order = np.lexsort((keys, owner))
                owner, keys = owner[order], keys[order]
                cuts = np.searchsorted(owner, np.arange(end - start + 1))
                yield pa.RecordBatch.from_arrays(
                    [whole.column(0).slice(start, end - start),
                     pa.array([keys[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())],
                    names=["node", "elements"])

    return rows.mapInArrow(run, "node long, elements binary")


def similarity(a: bytes, b: bytes) -> float:
    """Weighted Jaccard similarity of two packed multisets."""
    x, y = np.frombuffer(a, U), np.frombuffer(b, U)
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    shared = int((y[at] == x).sum())
    return shared / (len(x) + len(y) - shared)


def verified(pairs: DataFrame, packed: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) with ``linked``: whether their overlap reaches ``least``."""
    wide = (pairs.join(packed.toDF("a", "pa"), "a").join(packed.toDF("b", "pb"), "b")
            .select("a", "b", "pa", "pb"))

    def run(batches):
        for batch in batches:
            linked = [similarity(x, y) >= least - 1e-12 for x, y in zip(
                batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(linked, pa.bool_())],
                names=["a", "b", "linked"])

    return wide.mapInArrow(run, "a long, b long, linked boolean")


def links_between(labels: np.ndarray, packed: list[bytes], least: float) -> list[tuple[int, int]]:
    """For members of a bucket in several groups, one link (i, j) from each member outside the
    largest group to each other group that it is similar to."""
    _, group, sizes = np.unique(labels, return_inverse=True, return_counts=True)
    outside = np.flatnonzero(group != sizes.argmax())
    if not len(outside):
        return []
    parts = [np.frombuffer(p, U) for p in packed]
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    _, number, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(parts)), size)
    shared = counts[number] > 1  # an element of one member is in no overlap
    column = np.cumsum(counts > 1) - 1
    owner, number = owner[shared], column[number[shared]]
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    overlap = np.zeros((len(outside), len(parts)), np.float32)
    for low in range(0, int((counts > 1).sum()), COLUMNS):
        a, b = np.searchsorted(number, (low, low + COLUMNS))
        holds = np.zeros((len(parts), COLUMNS), np.float32)
        holds[owner[a:b], number[a:b] - low] = 1
        overlap += holds[outside] @ holds.T
    union = size[outside][:, None] + size[None, :] - overlap
    good = (overlap >= (least - 1e-6) * union) & (group[outside][:, None] != group[None, :])
    found = []
    for i, row in zip(outside, good):
        hits = np.flatnonzero(row)
        if len(hits):
            _, first = np.unique(group[hits], return_index=True)
            found += [(int(i), int(j)) for j in hits[first]
                      if similarity(packed[i], packed[j]) >= least - 1e-12]
    return found


def links_within(members: DataFrame, packed: DataFrame, least: float) -> DataFrame:
    """Links (a, b) between groups inside crowded buckets (band, node, label, size).

    A bucket is dealt into blocks, and each pair of blocks is compared in one task: rows grow
    with the number of blocks, not with pairs, and no task holds more than two blocks.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = members.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    paired = dealt.select("band", "node", "label", F.least("own", "other").alias("i"),
                          F.greatest("own", "other").alias("j")).join(packed, "node")

    def run(group: pa.Table) -> pa.Table:
        nodes = group["node"].to_numpy()
        found = links_between(group["label"].to_numpy(), group["elements"].to_pylist(), least)
        return pa.table({"a": pa.array([nodes[i] for i, _ in found], pa.int64()),
                         "b": pa.array([nodes[j] for _, j in found], pa.int64())})

    return paired.groupBy("band", "i", "j").applyInArrow(run, "a long, b long")


def classes(docs: DataFrame, rules: NearRules = NearRules()) -> tuple[DataFrame, DataFrame]:
    """The staged rows of ``docs`` with ``__row``, and (``__row``, ``label``) of rows with words.

    Rows of one class have one label, a node number.
    """
    rows = staged(signed(docs, rules), "signed")
    nodes = staged(
        rows.where(F.col("__key").isNotNull()).groupBy("__key").agg(F.min("__row").alias("node")),
        "nodes")
    first = rows.join(nodes, rows["__row"] == nodes["node"], "left_semi").select(
        F.col("__row").alias("node"), "__bands")
    buckets = staged(first.select("node", F.explode("__bands").alias("band")), "buckets")
    shared = buckets.groupBy("band").agg(F.min("node").alias("a"), F.max("node").alias("last"))
    leaders = shared.where(F.col("a") != F.col("last"))
    crowded = staged(buckets.join(leaders, "band").select(
        "band", "a", F.col("node").alias("b")), "crowded")
    involved = crowded.select("b").distinct().withColumnRenamed("b", "__row")
    packed = staged(payloads(rows.select("__row", "text").join(involved, "__row", "left_semi"),
                             rules.width), "payloads")
    pairs = crowded.where(F.col("a") != F.col("b")).select("a", "b").distinct()
    met = staged(verified(pairs, packed, rules.similarity), "met")
    links = met.where("linked").select("a", "b")
    groups = components(links)
    # What the leaders left apart: nodes of different groups in one bucket that have not met.
    placed = staged(crowded.join(groups.withColumnRenamed("node", "b"), "b", "left").select(
        "band", F.col("b").alias("node"), F.coalesce("label", "b").alias("label")), "placed")
    split = placed.groupBy("band").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size")
    ).where("low != high")
    apart = placed.join(split.select("band", "size"), "band")
    few = apart.where(F.col("size") <= SMALL).drop("size")
    left, right = few.toDF("band", "a", "la"), few.toDF("band", "b", "lb")
    unmet = (left.join(right, "band").where((F.col("a") < F.col("b")) & (F.col("la") != F.col("lb")))
             .select("a", "b").distinct().join(met.select("a", "b"), ["a", "b"], "left_anti"))
    more = staged(
        verified(unmet, packed, rules.similarity).where("linked").select("a", "b").unionByName(
            links_within(apart.where(F.col("size") > SMALL), packed, rules.similarity)), "more")
    if more.limit(1).count():
        groups = components(links.unionByName(more))
    labels = nodes.join(groups, "node", "left").select(
        "__key", F.coalesce("label", "node").alias("label"))
    return rows, rows.select("__row", "__key").join(labels, "__key").select("__row", "label")


def near_classes(docs: DataFrame, rules: NearRules = NearRules()) -> DataFrame:
    """Per document row: ``doc_id``, ``class_id`` (least id of its class), ``class_rows``.

    A text without a word is a class of its own row.
    """
    rows, labels = classes(docs.select("doc_id", "text"), rules)
    sized = labels.join(rows.select("__row", "doc_id"), "__row")
    per_class = sized.groupBy("label").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("class_rows"))
    member = labels.join(per_class, "label").select("__row", "class_id", "class_rows")
    return rows.select("__row", "doc_id").join(member, "__row", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("class_rows", F.lit(1)).cast("long").alias("class_rows"))


def one_of_each(docs: DataFrame, rules: NearRules = NearRules()) -> DataFrame:
    """The documents, with all their columns, one row per class: its least id, first row.

    Other columns may have any name.
    """
    docs, back = out_of_the_way(docs)
    rows, labels = classes(docs, rules)
    sized = labels.join(rows.select("__row", "doc_id"), "__row")
    kept = sized.groupBy("label").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "__row")).alias("m")).select(
        F.col("m.__row").alias("__row"))
    wordless = rows.where(F.col("__key").isNull()).select("__row")
    return rows.join(kept.unionByName(wordless), "__row", "left_semi").select(
        *docs.columns).withColumnsRenamed(back)
