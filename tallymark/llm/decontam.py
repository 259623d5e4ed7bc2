"""Benchmark decontamination by pieces and bit-parallel edit distance.

A test item of n characters may differ by k = floor(rate * n) edits. Split into k + 1 pieces,
at least one piece of any passage within k edits is untouched: an automaton of all pieces
finds the places, and Myers' bit vectors give the exact least distance around each.

Texts and items are compared in lower case with single spaces. The items are the stated query
set: they go to the tasks in blocks of bounded size, each checked against all documents.

Defined results: null or empty texts and items match nothing; a document matches an item once,
with the least distance in it; repeated rows each give their matches; null ids stay null.
"""

from __future__ import annotations

import math
import zlib

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallymark.llm.common import memory, ship, text_bytes

EDIT_RATE = 0.05
BLOCK_CHARS = 2 << 20


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def pieces(text: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece) of ``k + 1`` pieces of nearly equal length."""
    n = len(text)
    cuts = [i * n // (k + 1) for i in range(k + 2)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]


def character_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def least_distance(masks: dict[str, int], m: int, text: str) -> int:
    """Least edit distance between the pattern and any stretch of the text."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best = m
    get = masks.get
    for c in text:
        equal = get(c, 0)
        across = (((equal & plus) + plus) ^ plus) | equal
        down = equal | minus
        up = minus | (full & ~(across | plus))
        gone = plus & across
        if up & high:
            score += 1
        elif gone & high:
            score -= 1
            if score < best:
                best = score
        up = up << 1 & full
        gone = gone << 1 & full
        plus = gone | (full & ~(down | up))
        minus = up & down
    return best


class Finder:
    """All items of one block, ready to search texts."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float = EDIT_RATE) -> None:
        places: dict[str, list[tuple[int, int]]] = {}
        self.items = []
        for name, raw in items:
            text = normal(raw)
            if not text:
                continue
            k = min(math.floor(rate * len(text)), len(text) - 1)
            number = len(self.items)
            self.items.append((name, len(text), k, character_masks(text)))
            for offset, piece in pieces(text, k):
                places.setdefault(piece, []).append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), tuple(where)))
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def matches(self, raw: str) -> list[tuple[int | None, int]]:
        """(item, least distance) of every item found in the text."""
        if self.empty or not raw:
            return []
        text = normal(raw)
        shifts: dict[int, dict[int, int]] = {}
        for end, (size, where) in self.automaton.iter(text):
            for number, offset in where:
                own = shifts.setdefault(number, {})
                shift = end + 1 - size - offset
                own[shift] = own.get(shift, 0) + 1
        found = []
        for number, own in shifts.items():
            name, m, k, masks = self.items[number]
            best = 0 if max(own.values()) == k + 1 else k + 1
            seen = None
            for shift in sorted(own) if best else ():
                # Hits a few places apart are seen in one window.
                low, high = shift - k, shift + m + k
                if seen is not None and low <= seen[2] + k:
                    seen = (seen[0], high, shift)
                    continue
                if seen is not None:
                    best = min(best, least_distance(masks, m, text[max(0, seen[0]):seen[1]]))
                seen = (low, high, shift)
            if best and seen is not None:
                best = min(best, least_distance(masks, m, text[max(0, seen[0]):seen[1]]))
            if best <= k:
                found.append((name, best))
        return sorted(found, key=lambda x: (x[0] is not None, x[0], x[1]))


_finders: dict[tuple, Finder] = memory()


def worker_finder(items: list, rate: float) -> Finder:
    key = (zlib.crc32(repr(items).encode()), len(items), rate)
    if key not in _finders:
        _finders.clear()
        _finders[key] = Finder(items, rate)
    return _finders[key]


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS):
    """The items in blocks of about ``block_chars`` characters, one at a time."""
    usable = benchmark.select(F.col("item_id").cast("long"), "text").where(
        F.length(F.trim("text")) > 0)
    total = usable.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    for block in range(blocks):
        rows = usable.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        if rows or blocks == 1:
            yield sorted(((r["item_id"], r["text"]) for r in rows),
                         key=lambda x: (x[0] is not None, x))


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE) -> DataFrame:
    """Pairs (``doc_id``, ``item_id``, ``distance``) of documents that hold a test item."""
    ship(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long"), text_bytes().alias("raw"))

    def search(items):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches):
            finder = worker_finder(sent.value, rate)
            for batch in batches:
                out = [(doc, item, distance)
                       for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                       for item, distance in finder.matches(raw.decode("utf-8", "replace"))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[i] for row in out], pa.int64()) for i in range(3)],
                    names=["doc_id", "item_id", "distance"])

        return source.mapInArrow(run, "doc_id long, item_id long, distance long")

    # There is always a block, if only an empty one.
    parts = [search(items) for items in item_blocks(benchmark)]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def without_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE) -> DataFrame:
    """The documents, with all their columns, that hold no test item."""
    ship(docs.sparkSession)

    def keep(frame, items):
        sent = docs.sparkSession.sparkContext.broadcast(items)
        text = frame.columns.index("text")

        def run(batches):
            finder = worker_finder(sent.value, rate)
            for batch in batches:
                clean = [raw is None or not finder.matches(raw)
                         for raw in batch.column(text).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return frame.mapInArrow(run, frame.schema)

    for items in item_blocks(benchmark):
        docs = keep(docs, items)
    return docs
