"""Token counts without tokens: each distinct pre-token is counted once, documents sum counts.

A model whose pieces hold blanks at their beginning only never merges over the place before a
run of blanks, nor next to a character that no longer piece holds. Text is cut there into
pre-tokens. A block (some MB of documents) keeps for each document how often it holds which of
the block's distinct pre-tokens; these go to Spark as rows, sorted by pre-token so that the
library counts each distinct one once, and the counts are joined to the frequencies of the block
that asked. Documents then sum count times frequency. A pre-token has one row per block at most,
however often it occurs, so that no word is hot.

Defined results: a null text is empty; an empty text has no tokens; invalid UTF-8 is read with
replacement characters; repeated rows and rows without an id each have their own result. Very
long texts are cut into slices where the model always cuts, so that no more than a slice's
pre-tokens are listed at a time. An empty table gives an empty result. Other columns of the
table are ignored and cannot clash; ties do not occur.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from sentencepiece import SentencePieceProcessor

from tallymark.llm.common import ship, staged, text_bytes

#: The sign that the models write for a blank.
BLANK = "▁"
BLOCK_BYTES = 64 << 20
BLOCK_ROWS = 1 << 20
#: Counts that a task packs together for the blocks that asked.
ANSWERS = 1 << 20
SLICE_CHARS = 1 << 20


class Counting:
    """Pre-tokens of a model's texts, and the number of pieces of each."""

    def __init__(self, model: bytes) -> None:
        self.library = library = SentencePieceProcessor(model_proto=model)
        ids = range(library.get_piece_size())
        longer = [
            piece for i in ids
            if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i))
            and len(piece := library.id_to_piece(i)) > 1]
        within = set("".join(longer)) - {BLANK}
        alone = next((c for c in "\n\t\x01\x02" if c not in within), None)
        probe = " A  b ﬁ\n\t "
        if (alone is None or any(BLANK in piece.lstrip(BLANK) for piece in longer)
                or library.normalize(probe) != self.marked(probe)):
            raise ValueError("the model rewrites texts or joins words over blanks")
        inside = "".join(map(re.escape, sorted(within)))
        self.cut = re.compile(f"{BLANK}*[{inside}]+|{BLANK}+|[^{BLANK}{inside}]+")
        self.word_start = re.compile(f"(?<!{BLANK}){BLANK}")
        # What follows a lone character is encoded as inside a text, without the first blank.
        self.alone = alone
        self.extra = len(library.encode(alone))

    @staticmethod
    def marked(text: str) -> str:
        return BLANK + text.replace(" ", BLANK) if text else ""

    def frequencies(self, text: str) -> Counter:
        """How often the text holds each of its pre-tokens."""
        found: Counter = Counter()
        marked = self.marked(text)
        start = 0
        while start < len(marked):
            cut = self.word_start.search(marked, start + SLICE_CHARS)
            stop = cut.start() if cut else len(marked)
            whole = start == 0 and stop == len(marked)
            found.update(self.cut.findall(marked if whole else marked[start:stop]))
            start = stop
        return found

    def pieces(self, words: list[str]) -> list[int]:
        found = self.library.encode([self.alone + word for word in words], num_threads=1)
        return [len(ids) - self.extra for ids in found]


_models: dict[bytes, Counting] = {}


def worker_model(model: bytes) -> Counting:
    """One model per worker process, kept over its tasks."""
    if model not in _models:
        _models.clear()
        _models[model] = Counting(model)
    return _models[model]


class Block:
    """Distinct pre-tokens of some documents and the documents' frequencies."""

    def __init__(self) -> None:
        self.words: dict[str, int] = {}
        self.ids: list = []
        self.sizes: list[int] = []
        self.lengths: list[int] = []
        self.at: list[np.ndarray] = []
        self.often: list[np.ndarray] = []
        self.bytes = 0

    def add(self, doc_id, size: int, found: Counter) -> None:
        known = self.words
        self.ids.append(doc_id)
        self.sizes.append(size)
        self.lengths.append(len(found))
        at = np.fromiter((known.setdefault(w, len(known)) for w in found), np.uint32, len(found))
        often = np.fromiter(found.values(), np.uint32, len(found))
        order = np.argsort(at)
        # Words are numbered as they come: gaps between sorted numbers are small.
        self.at.append(np.diff(at[order], prepend=np.uint32(0)))
        self.often.append(often[order])
        self.bytes += size

    def row(self, number: int, id_type: pa.DataType) -> pa.RecordBatch:
        gaps = np.concatenate(self.at) if self.at else np.zeros(0, np.uint32)
        often = np.concatenate(self.often) if self.often else np.zeros(0, np.uint32)
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()),
             pa.array([list(self.words)], pa.list_(pa.string())),
             pa.array([self.ids], pa.list_(id_type)),
             pa.array([self.sizes], pa.list_(pa.int64())),
             pa.array([self.lengths], pa.list_(pa.int32())),
             pa.array([planes(gaps.view(np.uint8), 4)], pa.binary()),
             pa.array([planes(often.view(np.uint8), 4)], pa.binary())],
            names=["block", "words", "ids", "sizes", "lengths", "gaps", "often"])


def planes(raw: np.ndarray, width: int) -> bytes:
    """Numbers as their lowest bytes, then the next, and so on, compressed."""
    return pa.compress(np.ascontiguousarray(raw.reshape(-1, width).T).tobytes(), codec="zstd",
                       asbytes=True)


def from_planes(packed: bytes, n: int, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = pa.decompress(packed, n * width, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, n).T).view(kind)[:, 0]


def answers_by_block(waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Counts of some pre-tokens as one row for each block that asked for them."""
    block, at, n = map(np.concatenate, zip(*waiting))
    order = np.lexsort((at, block))
    block, at, n = block[order], at[order].astype(np.uint32), n[order]
    starts = np.flatnonzero(np.diff(block, prepend=-1))
    stops = np.append(starts[1:], len(block))
    gaps = [planes(np.diff(at[a:b], prepend=np.uint32(0)).view(np.uint8), 4)
            for a, b in zip(starts, stops)]
    return pa.RecordBatch.from_arrays(
        [pa.array(block[starts]), pa.array(stops - starts, pa.int32()),
         pa.array(gaps, pa.binary()),
         pa.array([planes(n[a:b].view(np.uint8), 4) for a, b in zip(starts, stops)], pa.binary())],
        names=["asked", "entries", "gaps", "pieces"])


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096) -> DataFrame:
    """Id, bytes, tokens and whether these exceed ``limit``, of every document."""
    spark = docs.sparkSession
    ship(spark)
    with open(model_file, "rb") as file:  # a vocabulary, of fixed size
        model = spark.sparkContext.broadcast(file.read())
    kind = docs.schema["doc_id"].dataType.simpleString()

    def blocks(batches):
        counting = worker_model(model.value)
        first = TaskContext.get().partitionId() << 32
        block = Block()
        number, id_type = 0, None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = raw.as_py()
                block.add(doc_id, len(raw), counting.frequencies(raw.decode("utf-8", "replace")))
                if block.bytes >= BLOCK_BYTES or len(block.ids) >= BLOCK_ROWS:
                    yield block.row(first + number, id_type)
                    block, number = Block(), number + 1
        if block.ids:
            yield block.row(first + number, id_type)

    def count(batches):
        """Rows sorted by pre-token: the library sees each distinct one once."""
        counting = worker_model(model.value)
        last, n_last = None, 0
        waiting, rows = [], 0
        for batch in batches:
            coded = batch.column("word").dictionary_encode()
            words = coded.dictionary.to_pylist()
            if not words:
                continue
            known = [n_last] if words[0] == last else []
            found = known + counting.pieces(words[len(known):])
            last, n_last = words[-1], found[-1]
            n = np.array(found, np.uint32)[coded.indices.to_numpy()]
            waiting.append((batch.column("block").to_numpy(), batch.column("at").to_numpy(), n))
            rows += len(n)
            if rows >= ANSWERS:
                yield answers_by_block(waiting)
                waiting, rows = [], 0
        if waiting:
            yield answers_by_block(waiting)

    def summed(block: pa.Table, answers: pa.Table) -> pa.Table:
        lengths = block["lengths"].combine_chunks().flatten().to_numpy()
        entries = int(lengths.sum())
        ends = np.cumsum(lengths.astype(np.int64))
        starts = ends - lengths
        # Numbers from gaps: the running sum, less the sum before the document.
        running = np.cumsum(from_planes(block["gaps"][0].as_py(), entries, np.uint32),
                            dtype=np.int64)
        before = np.where(starts > 0, running[starts - 1], 0) if entries else starts
        at = running - np.repeat(before, lengths)
        often = from_planes(block["often"][0].as_py(), entries, np.uint32)
        pieces = np.zeros(sum(answers["entries"].to_pylist()), np.int64)
        for n, gaps, found in zip(*(answers[c].to_pylist() for c in ("entries", "gaps", "pieces"))):
            pieces[np.cumsum(from_planes(gaps, n, np.uint32), dtype=np.int64)] = from_planes(
                found, n, np.uint32)
        tokens = np.concatenate([[0], np.cumsum(often * pieces[at])])
        total = tokens[ends] - tokens[starts]
        return pa.table({
            "doc_id": block["ids"].combine_chunks().flatten(),
            "n_bytes": block["sizes"].combine_chunks().flatten(),
            "n_tokens": pa.array(total, pa.int64()), "over_limit": pa.array(total > limit)})

    found = staged(
        docs.select("doc_id", text_bytes().alias("raw")).mapInArrow(
            blocks, f"block long, words array<string>, ids array<{kind}>, sizes array<long>, "
                    "lengths array<int>, gaps binary, often binary"), "frequencies")
    words = found.select("block", F.posexplode("words").alias("at", "word"))
    answers = words.repartition("word").sortWithinPartitions("word").mapInArrow(
        count, "asked long, entries int, gaps binary, pieces binary")
    return found.drop("words").groupBy("block").cogroup(answers.groupBy("asked")).applyInArrow(
        summed, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
