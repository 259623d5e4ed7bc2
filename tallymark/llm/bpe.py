"""Byte-level BPE in two tiers: a minimal perfect hash for whole pre-tokens, a heap for the rest.

A pre-token that is in the vocabulary is one id, found through a hash function without empty
or shared places. Any other is merged from bytes: the parts are linked, and a heap gives the
pair of lowest rank, leftmost first, as the rank files ask for.

Defined results: null text is empty and has no ids; invalid UTF-8 is read with replacement
characters; every byte is in the vocabulary, so decoding gives the text's bytes back.
"""

from __future__ import annotations

import base64
import hashlib
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallymark.llm.common import extended, memory, ship, text_bytes
from tallymark.llm.pieces import PieceMemo

SPREAD = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file by rank; the ranks are 0 to n - 1."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class PerfectHash:
    """Minimal perfect hash by hash and displace: n keys, n places.

    Keys fall into buckets; the largest bucket first seeks a displacement under which all of
    its keys hit free places. Buckets of one key name their place outright.
    """

    def __init__(self, keys: list[bytes], per_bucket: int = 4) -> None:
        self.n = len(keys)
        self.buckets = max(1, self.n // per_bucket)
        hashes = [xxhash.xxh64_intdigest(key) for key in keys]
        if len(set(hashes)) != self.n:
            raise ValueError("keys repeat or collide")
        members: list[list[int]] = [[] for _ in range(self.buckets)]
        for i, h in enumerate(hashes):
            members[h % self.buckets].append(i)
        self.shift = [0] * self.buckets
        self.place_of = [-1] * self.n  # key number at each place
        free = self.place_of
        order = sorted(range(self.buckets), key=lambda b: -len(members[b]))
        singles = []
        for b in order:
            own = members[b]
            if len(own) < 2:
                singles.extend([b] * len(own))
                continue
            d = 1
            while True:
                places = [self._place(hashes[i], d) for i in own]
                if len(set(places)) == len(own) and all(free[p] < 0 for p in places):
                    break
                d += 1
            self.shift[b] = d
            for i, p in zip(own, places):
                free[p] = i
        empty = (p for p in range(self.n) if free[p] < 0)
        for b in singles:
            p = next(empty)
            self.shift[b] = -p - 1
            free[p] = members[b][0]

    def _place(self, h: int, d: int) -> int:
        return (((h ^ (d * SPREAD)) & MASK) * SPREAD >> 17 & MASK) % self.n

    def find(self, key: bytes) -> int:
        """Number of the only key that this one can be; the caller compares."""
        h = xxhash.xxh64_intdigest(key)
        d = self.shift[h % self.buckets]
        return self.place_of[-d - 1 if d < 0 else self._place(h, d)]


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: pairs merge by lowest rank, leftmost first."""
    n = len(word)
    after = list(range(1, n + 1))  # start of the next part; -1 when merged away
    before = list(range(-1, n - 1))
    get = ranks.get
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(word[i:i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, end = heappop(heap)
        j = after[i]
        if j < 0 or j >= n or after[j] != end:
            continue  # one of the two has merged since
        after[i], after[j] = end, -1
        if end < n:
            before[end] = i
            r = get(word[i:after[end]])
            if r is not None:
                heappush(heap, (r, i, after[end]))
        p = before[i]
        if p >= 0:
            r = get(word[p:end])
            if r is not None:
                heappush(heap, (r, p, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:after[i]]])
        i = after[i]
    return out


class Codec:
    """Encoder and decoder of one rank file; pickles as its tokens and pattern."""

    def __init__(self, tokens: list[bytes], pattern: str) -> None:
        self.tokens = tokens
        self.ranks = {token: rank for rank, token in enumerate(tokens)}
        self.hash = PerfectHash(tokens)
        self.pattern = regex.compile(pattern)
        self.decimal = [str(i) for i in range(len(tokens))]
        self.memo = PieceMemo(self.chunk)

    def pre_token(self, word: bytes) -> list[int]:
        found = self.hash.find(word)
        if self.tokens[found] == word:
            return [found]
        return merge(word, self.ranks)

    def chunk(self, text: str) -> bytes:
        ids: list[int] = []
        for match in self.pattern.findall(text):
            ids.extend(self.pre_token(match.encode()))
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.memo.text(text), dtype="<u4")

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_codecs: dict[str, Codec] = memory()


def worker_codec(packed: bytes, pattern: str) -> Codec:
    """One codec per worker process, kept over its tasks."""
    key = hashlib.sha256(packed + pattern.encode()).hexdigest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec([base64.b64decode(line) for line in packed.split(b"\n")], pattern)
    return _codecs[key]


def encoded(docs: DataFrame, rank_file: str, pattern: str, keep: list[str],
            with_ids: bool = False) -> DataFrame:
    """Columns ``keep`` of every row, the number of ids, digests and (if asked) the ids.

    A result whose name a kept column has is called ``bpe_`` and that name.

    The vocabulary is a file of fixed size and goes to the workers with the task.
    """
    ship(docs.sparkSession)
    packed = docs.sparkSession.sparkContext.broadcast(
        b"\n".join(map(base64.b64encode, read_ranks(rank_file))))

    def run(batches):
        codec = worker_codec(packed.value, pattern)
        for batch in batches:
            counts, id_digests, byte_digests, ids = [], [], [], []
            for raw in batch.column(batch.num_columns - 1).to_pylist():
                found = codec.encode(raw.decode("utf-8", "replace"))
                listed = found.tolist()
                counts.append(len(listed))
                id_digests.append(hashlib.sha256(
                    ",".join(map(codec.decimal.__getitem__, listed)).encode()).hexdigest())
                byte_digests.append(hashlib.sha256(codec.decode(listed)).hexdigest())
                if with_ids:
                    ids.append(found)
            extra = [pa.array(counts, pa.int64()), pa.array(id_digests), pa.array(byte_digests)]
            names = ["n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                offsets = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]).astype(np.int32)
                flat = np.concatenate(ids) if ids else np.zeros(0, dtype="<u4")
                extra.append(pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int32))))
                names.append("token_ids")
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-1] + extra, names=batch.schema.names[:-1] + names)

    outputs = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (
        ", token_ids array<int>" if with_ids else "")
    taken = {c.lower() for c in keep}

    def free(name: str) -> str:
        return free(f"bpe_{name}") if name in taken else name

    kept = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)])
    done = docs.select(
        *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], text_bytes().alias("text_bytes")
    ).mapInArrow(run, extended(kept, outputs))
    results = {name: free(name) for name in done.columns[len(keep):]}
    return done.withColumnsRenamed(results | {f"k{i}": c for i, c in enumerate(keep)})
