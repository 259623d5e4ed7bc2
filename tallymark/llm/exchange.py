"""Asking all of a corpus about hashes: blocks of rows send sorted hashes, shards answer.

A block is one row that holds many documents, a shard a range of the hash space. A block sends
each shard one message with the hashes that fall into its range; the shard sees the messages of
all blocks for its range and answers each. Messages hold packed arrays, so that a hash costs a
few bytes and no row of its own, and a hash that a block holds a thousand times is sent once.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallymark.llm.common import shuffle_parts, staged

U = np.uint64
SHARD_BYTES = 64 << 20


def shard_count(spark, total_bytes: int, per_partition: int = 1) -> int:
    """Some per shuffle partition, more where a shard would see too much text."""
    return max(per_partition * shuffle_parts(spark), -(-total_bytes // SHARD_BYTES), 1)


def rows_of(batches):
    """The rows of all batches one by one: rows are large, so no batch is copied whole."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def shard_cuts(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Where the ranges of the shards begin in sorted hashes; one more entry for the end."""
    shard = ((hashes >> U(32)) * U(shards)) >> U(32)
    return np.searchsorted(shard, np.arange(shards + 1).astype(U))


def packed(sorted_hashes: np.ndarray) -> bytes:
    """Sorted hashes as differences, byte plane by byte plane: the high planes are empty."""
    if not len(sorted_hashes):
        return b""
    steps = np.diff(sorted_hashes, prepend=U(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, U)
    planes = np.frombuffer(raw, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(U).ravel(), dtype=U)


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags.astype(bool)).tobytes()


def flags(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)


def planes(values: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, so that small ones compress well."""
    width = values.dtype.itemsize
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes()


def from_planes(raw: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    whole = np.frombuffer(raw, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(whole.T).view(dtype).ravel()


def replies(messages: DataFrame, reply: Callable[[list[dict]], tuple[list[bytes], int]],
            name: str) -> DataFrame:
    """(block, shard, answer, figure) of every message.

    ``messages`` has ``shard``, ``block`` and further columns; ``reply`` gets the messages of one
    shard in order of the blocks and gives one answer to each, and one figure of the shard.
    """
    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["block"])
        answers, figure = reply(rows)
        return pa.table({"block": pa.array([r["block"] for r in rows], pa.int64()),
                         "shard": pa.array([r["shard"] for r in rows], pa.int32()),
                         "answer": pa.array(answers, pa.binary()),
                         "figure": pa.array([figure] * len(rows), pa.int64())})

    return staged(messages.groupBy("shard").applyInArrow(
        run, "block long, shard int, answer binary, figure long"), name)


def gathered(answers: DataFrame, column: str = "answers") -> DataFrame:
    """(block, answers): all answers to a block in order of the shards."""
    return answers.groupBy("block").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("shard", "answer"))), lambda x: x["answer"])
        .alias(column))
