"""Removal of repeated 100-byte strings by prefix doubling over sampled positions.

A position's rank for length 2n is the pair of the ranks of n at it and at n further: ranks
double from single bytes to 32 and, past the threshold, 100. Ranks are 64-bit names of the pairs,
so that equal strings get equal names wherever they are. Spark sorts the names of all blocks in
ranges of the name space and tells each block which of its names are not unique; what is unique
drops out before the next length.

Of the 32-byte strings only the least named one in each 100-byte window is sent: equal windows
pick equal ones, so a window whose pick is unique is unique itself. Windows that remain send
the names of their 100 bytes, and the first place of each name in order of documents is told.

Whole documents that equal an earlier one need no windows: all their bytes are covered.

Defined results: null text is empty; a text below 100 bytes loses nothing; rows go by
``doc_id`` (null first) and then by their bytes; of rows with equal bytes the first stays;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallymark.llm.common import ship, staged, text_bytes
from tallymark.llm.exchange import (
    U, bits, flags, gathered, packed, replies, rows_of, shard_count, shard_cuts, unpacked)
from tallymark.llm.minhash import mixed

LENGTH = 100
SAMPLE = 32
BLOCK_BYTES = 4 << 20
STRETCH = 1 << 15
BYTE_RANKS = mixed(np.arange(256, dtype=U))


def doubled(ranks: np.ndarray, offset: int) -> np.ndarray:
    """Ranks of the pairs (rank here, rank ``offset`` further)."""
    out = ranks[:len(ranks) - offset] * U(0x9E3779B97F4A7C15)
    out += ranks[offset:] * U(0xC2B2AE3D27D4EB4F)
    out ^= out >> U(29)
    out *= U(0xBF58476D1CE4E5B9)
    out ^= out >> U(32)
    return out


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Least or largest of each ``width`` values in a row, by doubling."""
    size, out = 1, values
    while 2 * size <= width:
        out = pick(out[:len(out) - size], out[size:])
        size *= 2
    rest = width - size
    return pick(out[:len(out) - rest], out[rest:]) if rest else out


class Block:
    """Ranks and windows of the documents of one block, laid end to end."""

    def __init__(self, data: bytes, lengths: np.ndarray, skip: np.ndarray) -> None:
        self.raw = np.frombuffer(data, np.uint8)
        self.lengths = lengths
        n = len(self.raw)
        self.owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        windows = max(n - LENGTH + 1, 0)
        self.valid = self.owner[:windows] == self.owner[n - windows:]
        self.valid &= ~skip[self.owner[:windows]]
        if not self.valid.any():
            self.valid = np.zeros(0, bool)
            return
        self.sample = np.empty(n - SAMPLE + 1, U)
        self.least = np.empty(windows, U)
        for low, high in self._stretches():
            rank = BYTE_RANKS[self.raw[low:high + LENGTH - 1]]
            size = 1
            while size < SAMPLE:
                rank = doubled(rank, size)
                size *= 2
            self.sample[low:low + len(rank)] = rank
            self.least[low:high] = sliding(rank, LENGTH - SAMPLE + 1, np.minimum)

    def _stretches(self):
        """Ranges of windows so short that their ranks stay in the processor's cache."""
        windows = len(self.valid)
        return ((low, min(low + STRETCH, windows)) for low in range(0, windows, STRETCH))

    def picks(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct sampled names, sorted, and whether each is at two places or more."""
        if not len(self.valid):
            return np.zeros(0, U), np.zeros(0, bool)
        width = LENGTH - SAMPLE + 1
        found = np.empty(len(self.sample), bool)
        shown = np.where(self.valid, self.least, U(0))
        for low in range(0, len(self.sample), STRETCH):
            high = min(low + STRETCH, len(self.sample))
            own = shown[max(0, low - width + 1):high]
            left = np.zeros(max(0, width - 1 - low), U)
            right = np.zeros(high - low + width - 1 - len(own) - len(left), U)
            reached = sliding(np.concatenate([left, own, right]), width, np.maximum)
            found[low:high] = self.sample[low:high] == reached
        names, counts = np.unique(self.sample[found], return_counts=True)
        return names, counts > 1

    def remaining(self, names: np.ndarray, repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the windows whose pick is repeated, and the windows' names."""
        if not len(self.valid):
            return np.zeros(0, np.int64), np.zeros(0, U)
        change = np.flatnonzero(self.least[1:] != self.least[:-1]) + 1
        starts = np.concatenate([[0], change])
        sizes = np.diff(np.concatenate([starts, [len(self.least)]]))
        at = np.minimum(np.searchsorted(names, self.least[starts]), len(names) - 1)
        good = (names[at] == self.least[starts]) & repeated[at]
        places = np.flatnonzero(np.repeat(good, sizes) & self.valid)
        if not len(places):
            return places, np.zeros(0, U)
        out = np.empty(len(places), U)
        cuts = np.searchsorted(places, np.arange(0, len(self.valid) + STRETCH, STRETCH))
        for (low, high), a, b in zip(self._stretches(), cuts, cuts[1:]):
            if a < b:
                rank = doubled(self.sample[low:high + LENGTH - SAMPLE], SAMPLE)
                rank = doubled(rank, LENGTH - 2 * SAMPLE)
                out[a:b] = rank[places[a:b] - low]
        return places, out


def first_places(names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct names sorted, index of the first of each, and for all whether they are first."""
    distinct, first = np.unique(names, return_index=True)
    is_first = np.zeros(len(names), bool)
    is_first[first] = True
    return distinct, first, is_first


def tell_repeated(rows: list[dict]) -> tuple[list[bytes], int]:
    """For each name of each message whether it is at two places or more in all of them."""
    parts = [unpacked(r["names"]) for r in rows]
    names = np.concatenate(parts)
    many = np.concatenate([flags(r["many"], len(p)) for r, p in zip(rows, parts)])
    _, inverse, counts = np.unique(names, return_inverse=True, return_counts=True)
    repeated = counts > 1
    repeated[inverse[many]] = True
    cuts = np.cumsum([len(p) for p in parts])[:-1]
    return [bits(f) for f in np.split(repeated[inverse], cuts)], len(counts)


def tell_later(rows: list[dict]) -> tuple[list[bytes], int]:
    """For each name of each message whether an earlier block has it too."""
    parts = [unpacked(r["names"]) for r in rows]
    _, _, is_first = first_places(np.concatenate(parts))
    cuts = np.cumsum([len(p) for p in parts])[:-1]
    return [bits(f) for f in np.split(~is_first, cuts)], int(is_first.sum())


BLOCK_ROWS = ("block long, ids array<long>, keys array<binary>, lengths array<long>, data binary")


def blocks(docs: DataFrame) -> DataFrame:
    """All documents in ascending order as rows of many; ``block`` ascends too."""
    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0

        def row():
            return pa.RecordBatch.from_pydict({
                "block": pa.array([part << 32 | seq], pa.int64()),
                "ids": pa.array([ids], pa.list_(pa.int64())),
                "keys": pa.array([[xxhash.xxh128_digest(t) for t in texts]],
                                 pa.list_(pa.binary())),
                "lengths": pa.array([list(map(len, texts))], pa.list_(pa.int64())),
                "data": pa.array([b"".join(texts)], pa.binary())})

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(name)
                texts.append(text)
                size += len(text)
                if size >= BLOCK_BYTES:
                    yield row()
                    ids, texts, size, seq = [], [], 0, seq + 1
        if ids:
            yield row()

    ordered = (docs.select(F.col("doc_id").cast("long"), text_bytes().alias("raw"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "raw"))
    return ordered.mapInArrow(run, BLOCK_ROWS)


def copies(rows: DataFrame) -> DataFrame:
    """(block, copies): numbers of the documents that equal an earlier one."""
    docs = rows.select("block", F.posexplode("keys").alias("i", "key"))
    first = docs.groupBy("key").agg(
        F.min(F.struct("block", "i")).alias("first"), F.count("*").alias("n")).where("n > 1")
    return (docs.join(first.select("key", "first"), "key")
            .where(F.struct("block", "i") != F.col("first"))
            .groupBy("block").agg(F.collect_list("i").alias("copies")))


def _opened(row: dict) -> tuple[Block, np.ndarray]:
    skip = np.zeros(len(row["lengths"]), bool)
    skip[np.array(row["copies"] or [], np.int64)] = True
    return Block(row["data"], np.array(row["lengths"], np.int64), skip), skip


def _messages(block: int, shards: int, names: np.ndarray, many: np.ndarray | None):
    cuts = shard_cuts(names, shards)
    used = [s for s in range(shards) if cuts[s] < cuts[s + 1]]
    columns = {
        "shard": pa.array(used, pa.int32()), "block": pa.array([block] * len(used), pa.int64()),
        "names": pa.array([packed(names[cuts[s]:cuts[s + 1]]) for s in used], pa.binary())}
    if many is not None:
        columns["many"] = pa.array([bits(many[cuts[s]:cuts[s + 1]]) for s in used], pa.binary())
    return pa.RecordBatch.from_pydict(columns)


def _told(names: np.ndarray, shards: int, answers: list[bytes]) -> np.ndarray:
    """The answers to all names of a block."""
    cuts = shard_cuts(names, shards)
    sizes = [b - a for a, b in zip(cuts, cuts[1:]) if a < b]
    return np.concatenate([np.zeros(0, bool), *[flags(a, n) for a, n in zip(answers, sizes)]])


def removed(docs: DataFrame) -> DataFrame:
    """Per document row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``
    and ``kept``, the remaining bytes."""
    spark = docs.sparkSession
    ship(spark)
    rows = staged(blocks(docs), "blocks")
    total = rows.agg(F.sum(F.length("data"))).first()[0] or 0
    shards = shard_count(spark, total)
    known = rows.join(copies(rows), "block", "left").select(
        "block", "ids", "lengths", "data", "copies")

    def ask_picks(batches):
        for row in rows_of(batches):
            block, _ = _opened(row)
            yield _messages(row["block"], shards, *block.picks())

    repeated = gathered(replies(known.mapInArrow(
        ask_picks, "shard int, block long, names binary, many binary"), tell_repeated, "repeated"))

    def ask_windows(batches):
        for row in rows_of(batches):
            block, _ = _opened(row)
            names, _ = block.picks()
            _, windows = block.remaining(names, _told(names, shards, row["answers"] or []))
            yield _messages(row["block"], shards, np.unique(windows), None)

    later = gathered(replies(known.join(repeated, "block").mapInArrow(
        ask_windows, "shard int, block long, names binary"), tell_later, "later"), "later")

    def finish(batches):
        for row in rows_of(batches):
            block, skip = _opened(row)
            names, _ = block.picks()
            places, windows = block.remaining(names, _told(names, shards, row["answers"] or []))
            distinct, first, is_first = first_places(windows)
            gone = ~is_first
            gone[first] = _told(distinct, shards, row["later"] or [])
            yield _result(row, block, places[gone], skip)

    return known.join(repeated, "block", "left").join(
        later, "block", "left").mapInArrow(
        finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                "kept binary")


def _result(row: dict, block: Block, starts: np.ndarray, skip: np.ndarray) -> pa.RecordBatch:
    n = len(block.raw)
    change = np.zeros(n + 1, np.int32)
    change[starts] += 1  # no place twice
    change[starts + LENGTH] -= 1
    covered = np.cumsum(change[:-1]) > 0
    whole = skip & (block.lengths >= LENGTH)
    covered |= whole[block.owner]
    opens = covered.copy()
    opens[1:] &= ~covered[:-1] | (block.owner[1:] != block.owner[:-1])
    docs = len(block.lengths)
    kept = block.raw[~covered].tobytes()
    n_removed = np.bincount(block.owner[covered], minlength=docs)
    ends = np.cumsum(block.lengths - n_removed)
    texts = [kept[a:b] for a, b in zip(np.concatenate([[0], ends[:-1]]), ends)]
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array(row["ids"], pa.int64()),
        "n_bytes": pa.array(block.lengths, pa.int64()),
        "n_removed": pa.array(n_removed, pa.int64()),
        "n_spans": pa.array(np.bincount(block.owner[opens], minlength=docs), pa.int64()),
        "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
        "kept": pa.array(texts, pa.binary())})
