"""Language model scoring with an n-gram trie that is spread over shards.

The model is a bigram with interpolated absolute discounting over a smoothed unigram. It has an
entry for every word and word pair of the training texts; nothing is pruned, so it grows with
the corpus, and no machine holds it whole. Texts are read once into blocks of word numbers. Each
block asks the word shards for the counts of its words, then the pair shards for its pairs; a
pair shard counts the training pairs it is sent, builds its part of the trie and answers
from it. A context is one node of one shard; one with more than a shard's share of the corpus
is dealt over several by its successors. There are fewer dealt contexts than shards; the distinct
successors of each are counted over the corpus beforehand and sent with its pairs, so that all its
nodes back off alike, also those without a training pair.

Words are known by 64-bit and successors in a context by 40-bit hashes; a wrong hit needs a
collision within one context. A text is its words and an end.

Defined results: null text is empty and is its end alone; a null id counts as empty text when
ids are dealt into held-out and training; words unseen in training get the unigram's floor;
repeated rows each count and each are scored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallymark.llm.common import bucketed, ship, text_bytes
from tallymark.llm.exchange import (
    U, bits, flags, from_planes, gathered, packed, planes, replies, rows_of, shard_count,
    shard_cuts, unpacked)
from tallymark.llm.minhash import mixed
from tallymark.llm.trie import ID_BITS, Trie, quantised, restored

END = b"\n"  # no word holds a blank
BEGIN = U(xxhash.xxh64_intdigest(b"\n\n"))
BLOCK_WORDS = 1_000_000
DISCOUNT = 0.75
SMOOTHING = 0.1
#: Steps of a log10 probability sent with a pair.
FINE = 4096.0

BLOCK_ROWS = ("block long, ids array<long>, held array<boolean>, lengths array<long>, "
              "names binary, words binary")


def blocks(docs: DataFrame) -> DataFrame:
    """(doc_id, held, raw) rows as blocks of word numbers.

    ``names`` are the hashes of a block's words, the most frequent first, and ``words`` the
    numbers of all words of its texts, each text ended by the end word.
    """
    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0

        def fresh():
            numbers: dict[bytes, int] = defaultdict()
            numbers.default_factory = numbers.__len__
            return numbers, [], [], [], [], 0

        numbers, ids, held, lengths, words, size = fresh()

        def row():
            found = np.concatenate(words)
            order = np.argsort(-np.bincount(found), kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, numbers), U, len(numbers))[order]
            return pa.RecordBatch.from_pydict({
                "block": pa.array([part << 32 | seq], pa.int64()),
                "ids": pa.array([ids], pa.list_(pa.int64())),
                "held": pa.array([held], pa.list_(pa.bool_())),
                "lengths": pa.array([lengths], pa.list_(pa.int64())),
                "names": pa.array([hashes.tobytes()], pa.binary()),
                "words": pa.array([planes(rank[found])], pa.binary())})

        for batch in batches:
            for name, out, raw in zip(*(c.to_pylist() for c in batch.columns)):
                own = raw.lower().split()
                own.append(END)
                ids.append(name)
                held.append(out)
                lengths.append(len(own))
                words.append(np.fromiter(map(numbers.__getitem__, own), np.int64, len(own)))
                size += len(own)
                if size >= BLOCK_WORDS:
                    yield row()
                    numbers, ids, held, lengths, words, size = fresh()
                    seq += 1
        if ids:
            yield row()

    return docs.mapInArrow(run, BLOCK_ROWS)


class Block:
    def __init__(self, row: dict) -> None:
        self.row = row
        self.names = np.frombuffer(row["names"], U)
        self.words = from_planes(row["words"], np.uint32)
        self.lengths = np.array(row["lengths"], np.int64)
        self.held = np.array(row["held"], bool)
        self.owner = np.repeat(np.arange(len(self.lengths), dtype=np.int32), self.lengths)
        self.training = ~self.held[self.owner]
        self.order = np.argsort(self.names)

    def own_counts(self) -> np.ndarray:
        """Training occurrences in this block of each word, in order of the names."""
        return np.bincount(self.words[self.training], minlength=len(self.names))[self.order]

    def counts(self, answers: list[bytes]) -> np.ndarray:
        """Training occurrences in the corpus of each word number."""
        told = np.concatenate([from_planes(a, np.uint64) for a in answers]).astype(np.int64)
        out = np.empty(len(told), np.int64)
        out[self.order] = told
        return out

    def pairs(self):
        """Distinct pairs as (context number, word number, training count), and for each place
        of a word the number of its pair. The context after a text's start is one past the last
        word."""
        n = len(self.names)
        places = np.empty(len(self.words), np.int64)
        places[1:] = self.words[:-1]
        places[np.cumsum(self.lengths) - self.lengths] = n
        places *= n
        places += self.words
        keys, inverse = np.unique(places, return_inverse=True)
        seen = np.bincount(inverse, self.training, len(keys)).astype(np.int64)
        return keys // n, keys % n, seen, inverse


def tell_counts(rows: list[dict]) -> tuple[list[bytes], int]:
    """Sums of the counts of each name; the figure is the number of names seen in training."""
    parts = [unpacked(r["names"]) for r in rows]
    counts = np.concatenate([from_planes(r["counts"], np.uint32) for r in rows])
    distinct, inverse = np.unique(np.concatenate(parts), return_inverse=True)
    total = np.bincount(inverse, counts, len(distinct)).astype(np.uint64)
    cuts = np.cumsum([len(p) for p in parts])[:-1]
    return [planes(t) for t in np.split(total[inverse], cuts)], int((total > 0).sum())


def floor_log(counts: np.ndarray, total: int, distinct: int) -> np.ndarray:
    """log10 of the smoothed unigram probability."""
    return np.log10((counts + SMOOTHING) / (total + SMOOTHING * (distinct + 1)))


def dealt_over(counts, total: int, shards: int):
    """Over how many nodes contexts with these counts are dealt."""
    return 1 + counts * shards // max(total, 1)


class Dealt:
    """Names of the dealt contexts with the exact numbers of their successors in training."""

    def __init__(self, successors: dict[int, int]) -> None:
        self.names = np.array(sorted(successors), U)
        self.sizes = np.array([successors[int(n)] for n in self.names], np.uint32)

    def successors(self, names: np.ndarray) -> np.ndarray:
        """Of each context its number of successors, 0 where it is not dealt."""
        if not len(self.names):
            return np.zeros(len(names), np.uint32)
        at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        return np.where(self.names[at] == names, self.sizes[at], 0).astype(np.uint32)


def dealt_contexts(rows: DataFrame, counted: DataFrame, starts: int, total: int,
                   shards: int) -> Dealt:
    """The contexts with more than a shard's share of the training words, fewer than shards."""
    def frequent(batches):
        for row in rows_of(batches):
            names = np.sort(np.frombuffer(row["names"], U))
            counts = np.concatenate([from_planes(a, np.uint64) for a in row["counts"]])
            hot = dealt_over(counts.astype(np.int64), total, shards) > 1
            yield pa.RecordBatch.from_pydict({"name": pa.array(names[hot].view(np.int64))})

    names = np.array([r["name"] for r in rows.select("block", "names").join(
        gathered(counted, "counts"), "block").mapInArrow(frequent, "name long").distinct()
        .collect()], np.int64).view(U)
    if dealt_over(starts, total, shards) > 1:
        names = np.append(names, BEGIN)

    def followed(batches):
        for row in rows_of(batches):
            block = Block(row)
            context, word, seen, _ = block.pairs()
            own = np.append(block.names, BEGIN)
            hot = np.isin(own, names)[context] & (seen > 0)
            yield pa.RecordBatch.from_pydict({
                "context": pa.array(own[context[hot]].view(np.int64)),
                "word": pa.array(block.names[word[hot]].view(np.int64))})

    found = (rows.mapInArrow(followed, "context long, word long").distinct()
             .groupBy("context").count().collect()) if len(names) else []
    return Dealt({r["context"] % (1 << 64): r["count"] for r in found})


def ask_pairs(block: Block, counts: np.ndarray, starts: int, total: int, distinct: int,
              shards: int, dealt: Dealt) -> pa.RecordBatch:
    """A block's pairs, one message per shard."""
    context, word, seen, _ = block.pairs()
    nodes, ids, of_context = nodes_of(block, counts, starts, total, shards, context, word)
    successors = dealt.successors(np.append(block.names, BEGIN))[context]
    order = np.lexsort((ids, nodes))
    nodes, ids, seen = nodes[order], ids[order], seen[order]
    fine = np.rint(-floor_log(counts, total, distinct) * FINE).astype(np.uint16)[word[order]]
    new = np.concatenate([[True], nodes[1:] != nodes[:-1]])
    first = np.flatnonzero(new)
    sizes = np.diff(np.concatenate([first, [len(nodes)]]))
    names = nodes[first]
    cuts = shard_cuts(names, shards)
    bounds = np.concatenate([first, [len(nodes)]])[cuts]
    used = [s for s in range(shards) if cuts[s] < cuts[s + 1]]

    def sliced(values, edges, pack):
        return pa.array([pack(values[edges[s]:edges[s + 1]]) for s in used], pa.binary())

    return pa.RecordBatch.from_pydict({
        "shard": pa.array(used, pa.int32()),
        "block": pa.array([block.row["block"]] * len(used), pa.int64()),
        "names": sliced(names, cuts, packed),
        "sizes": sliced(sizes.astype(np.uint32), cuts, planes),
        "context_counts": sliced(of_context[order][first].astype(np.uint64), cuts, planes),
        "successors": sliced(successors[order][first], cuts, planes),
        "ids": sliced(ids, bounds, lambda v: planes(v)[:ID_BITS // 8 * len(v)]),
        "seen": sliced(seen.astype(np.uint32), bounds, planes),
        "fine": sliced(fine, bounds, planes)})


def nodes_of(block: Block, counts: np.ndarray, starts: int, total: int, shards: int,
             context: np.ndarray, word: np.ndarray):
    """For each pair: its node's name, its id there, its context's count.

    A context with more than a shard's share of all words is dealt over several nodes.
    """
    names = np.append(block.names, BEGIN)
    all_counts = np.append(counts, starts)
    own = all_counts[context]
    split = dealt_over(own, total, shards)
    ids = mixed(block.names)[word]
    turn = (ids >> U(ID_BITS)) % split.astype(U)
    return (mixed(names[context] ^ mixed(turn)), ids & U((1 << ID_BITS) - 1), own)


PAIR_ROWS = ("shard int, block long, names binary, sizes binary, context_counts binary, "
             "successors binary, ids binary, seen binary, fine binary")


def tell_weights(rows: list[dict]) -> tuple[list[bytes], int]:
    """Build the shard's trie from the training pairs and answer all pairs from it."""
    nodes, ids, seen, fine, own, dealt, codes_of = [], [], [], [], [], [], []
    for r in rows:
        sizes = from_planes(r["sizes"], np.uint32).astype(np.int64)
        counts = from_planes(r["context_counts"], np.uint64)
        successors = from_planes(r["successors"], np.uint32)
        nodes.append(np.repeat(unpacked(r["names"]), sizes))
        own.append(np.repeat(counts, sizes))
        dealt.append(np.repeat(successors, sizes))
        # Every node of a dealt context backs off alike, also one without a training pair.
        codes_of.append(np.repeat(np.where(successors > 0, quantised(np.log10(backoffs(
            np.maximum(successors, 1), np.maximum(counts, 1)))), 0).astype(np.uint8), sizes))
        seen.append(from_planes(r["seen"], np.uint32))
        fine.append(from_planes(r["fine"], np.uint16))
        high = bytes((8 - ID_BITS // 8) * len(nodes[-1]))
        ids.append(from_planes(r["ids"] + high, np.uint64))
    cuts = np.cumsum([len(n) for n in nodes])[:-1]
    trained = [s > 0 for s in seen]

    def picked(parts):
        return np.concatenate([p[t] for p, t in zip(parts, trained)])

    trie = trained_trie(*map(picked, (nodes, ids, seen, fine, own, dealt)))
    seen, fine, own, dealt = [], [], [], []  # not needed any more
    node, word = np.concatenate(nodes), np.concatenate(ids)
    nodes, ids = [], []
    found, codes = trie.find(node, word)
    # A node without a training pair is not in the trie and has code 0.
    codes = np.where(found | (codes > 0), codes, np.concatenate(codes_of))
    answers = [c.tobytes() + bits(f) for c, f in zip(np.split(codes, cuts), np.split(found, cuts))]
    return answers, trie.length


def backoffs(successors: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.minimum(DISCOUNT * successors / counts, 1.0)


def trained_trie(node, word, seen, fine, own, dealt) -> Trie:
    order = np.lexsort((word, node))
    node, word = node[order], word[order]
    if not len(node):
        empty = np.zeros(0)
        return Trie(np.zeros(0, U), empty, np.zeros(1, np.int64), np.zeros(0, U), empty)
    new = np.concatenate([[True], (node[1:] != node[:-1]) | (word[1:] != word[:-1])])
    first = np.flatnonzero(new)
    count = np.add.reduceat(seen[order].astype(np.float64), first)
    node, word = node[first], word[first]
    fine, own, dealt = fine[order][first], own[order][first], dealt[order][first]
    opens = np.concatenate([[True], node[1:] != node[:-1]])
    starts = np.append(np.flatnonzero(opens), len(node))
    # A dealt context has more successors than those at this node.
    successors = np.where(dealt[starts[:-1]] > 0, dealt[starts[:-1]], np.diff(starts))
    backoff = backoffs(successors, own[starts[:-1]])
    each = np.repeat(backoff, np.diff(starts))
    p = (count - DISCOUNT) / own + each * 10.0 ** (fine / -FINE)
    return Trie(node[starts[:-1]], np.log10(backoff), starts, word, np.log10(np.minimum(p, 1.0)))


def scored(docs: DataFrame, held: str = "held_out") -> DataFrame:
    """Scores of all texts by a model learned from the rows whose ``held`` column is false."""
    spark = docs.sparkSession
    ship(spark)
    # Blocks are the bulk and meet their answers three times: they stay where they lie.
    rows = bucketed(blocks(docs.select(
        F.col("doc_id").cast("long"), F.col(held).alias("held"), text_bytes().alias("raw"))),
        "blocks", "block")
    figures = rows.select(
        F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("all"),
        F.aggregate(F.zip_with("lengths", "held", lambda n, h: F.when(h, 0).otherwise(n)),
                    F.lit(0).cast("long"), lambda a, x: a + x).alias("training"),
        F.size(F.filter("held", lambda h: ~h)).alias("texts"),
    ).agg(F.sum("all"), F.sum("training"), F.sum("texts")).first()
    n_words, total, starts = (int(x or 0) for x in figures)
    shards = shard_count(spark, 8 * n_words, per_partition=2)

    def ask_counts(batches):
        for row in rows_of(batches):
            block = Block(row)
            names, counts = block.names[block.order], block.own_counts().astype(np.uint32)
            cuts = shard_cuts(names, shards)
            used = [s for s in range(shards) if cuts[s] < cuts[s + 1]]
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array(used, pa.int32()),
                "block": pa.array([row["block"]] * len(used), pa.int64()),
                "names": pa.array([packed(names[cuts[s]:cuts[s + 1]]) for s in used], pa.binary()),
                "counts": pa.array([planes(counts[cuts[s]:cuts[s + 1]]) for s in used],
                                   pa.binary())})

    counted = replies(rows.mapInArrow(
        ask_counts, "shard int, block long, names binary, counts binary"), tell_counts, "counts")
    distinct = int(counted.groupBy("shard").agg(F.max("figure").alias("n"))
                   .agg(F.sum("n")).first()[0] or 0)
    dealt = dealt_contexts(rows, counted, starts, total, shards)
    known = rows.join(gathered(counted, "counts"), "block")

    def ask(batches):
        for row in rows_of(batches):
            block = Block(row)
            yield ask_pairs(block, block.counts(row["counts"]), starts, total, distinct, shards,
                            dealt)

    weighed = replies(known.mapInArrow(ask, PAIR_ROWS), tell_weights, "weights")

    def finish(batches):
        for row in rows_of(batches):
            yield _scores(row, shards, starts, total, distinct)

    return known.join(gathered(weighed, "weights"), "block").mapInArrow(
        finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double")


def _scores(row: dict, shards: int, starts: int, total: int, distinct: int) -> pa.RecordBatch:
    block = Block(row)
    counts = block.counts(row["counts"])
    floor = floor_log(counts, total, distinct)
    context, word, _, inverse = block.pairs()
    nodes, ids, _ = nodes_of(block, counts, starts, total, shards, context, word)
    order = np.lexsort((ids, nodes))
    sizes = np.diff(shard_cuts(nodes[order], shards))
    codes, found = [], []
    for answer, n in zip(row["weights"], sizes[sizes > 0]):
        codes.append(np.frombuffer(answer[:n], np.uint8))
        found.append(flags(answer[n:], n))
    weight = np.empty(len(order))
    weight[order] = restored(np.concatenate(codes))
    hit = np.empty(len(order), bool)
    hit[order] = np.concatenate(found)
    value = np.where(hit, weight, weight + floor[word])
    n = len(block.lengths)
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array(row["ids"], pa.int64()),
        "held_out": pa.array(row["held"], pa.bool_()),
        "n_tokens": pa.array(block.lengths, pa.int64()),
        "n_known": pa.array(np.bincount(block.owner, counts[block.words] > 0, n).astype(np.int64)),
        "train_tokens": pa.array([total] * n, pa.int64()),
        "base_score": pa.array(np.bincount(block.owner, floor[block.words], n)),
        "score": pa.array(np.bincount(block.owner, value[inverse], n))})
