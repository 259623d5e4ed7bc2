"""Token ids as files of range-coded blocks, in ascending document order.

All blocks share one frequency table. A block holds whole documents and is coded on its own
by an asymmetric numeral system with interleaved states; at fixed steps the states and the
place in the stream are kept, so that the stretches between are decoded side by side. Each
block carries a checksum of its stream and one of its ids.

Defined results: null text is empty and has the end id only; rows come in order of ``doc_id``
(null first), then of their text; repeated rows are all kept.
"""

from __future__ import annotations

import os
import zlib
from array import array
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallymark.llm.common import by_size, memory, ship, staged, text_bytes
from tallymark.llm.exchange import from_planes, planes, rows_of
from tallymark.llm.pieces import PieceTable

BITS = 20
LOW = 1 << 31
LANES = 1024
STEPS = 256  # between checkpoints
BLOCK_IDS = 1 << 19
TEXT_AT_ONCE = 4 << 20
TOGETHER = 100  # new pieces
END_ID = 0


def shared_table(counts: np.ndarray) -> np.ndarray:
    """Counts as frequencies that sum to 2**BITS; every id that occurs keeps one at least."""
    total = counts.sum()
    if total == 0:
        return counts.astype(np.int64)
    freq = np.where(counts > 0, np.maximum(1, counts * (1 << BITS) // total), 0).astype(np.int64)
    rest = (1 << BITS) - int(freq.sum())
    order = np.argsort(-freq, kind="stable")
    if rest > 0:
        freq[order[0]] += rest
    while rest < 0:  # the largest give, none below one
        for i in order:
            take = min(-rest, int(freq[i]) // 2)
            freq[i] -= take
            rest += take
            if rest == 0:
                break
    return freq


class Table:
    def __init__(self, freq: np.ndarray) -> None:
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.int32), freq)
        self.filler = int(np.argmax(freq)) if len(freq) else 0


def encode(ids: np.ndarray, table: Table) -> tuple[bytes, bytes, bytes]:
    """Stream of 32-bit words, states at each checkpoint, place of each in the stream."""
    steps = -(-len(ids) // LANES)
    padded = np.full(steps * LANES, table.filler, dtype=np.int64)
    padded[:len(ids)] = ids
    rows = padded.reshape(steps, LANES)
    x = np.full(LANES, LOW, dtype=np.uint64)
    words, states, places = [], [], []
    written = 0
    shift, bits = np.uint64(32), np.uint64(BITS)
    freqs, begins = table.freq[rows], table.start[rows]
    limits = freqs << np.uint64(63 - BITS)
    for step in range(steps - 1, -1, -1):
        freq, start = freqs[step], begins[step]
        full = x >= limits[step]
        if full.any():
            words.append(x[full].astype(np.uint32))
            written += len(words[-1])
            x[full] >>= shift
        quotient = x // freq
        x = (quotient << bits) + (x - quotient * freq) + start
        if step % STEPS == 0:
            states.append(x.copy())
            places.append(written)
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
    # Reading begins at the other end of the stream.
    starts = written - np.array(places[::-1], dtype=np.int64)
    kept = np.concatenate(states[::-1]) if states else np.zeros(0, np.uint64)
    return stream.astype("<u4").tobytes(), kept.astype("<u8").tobytes(), starts.astype(
        "<i8").tobytes()


def decode(n: int, stream: bytes, states: bytes, starts: bytes, table: Table) -> np.ndarray:
    """The ids of a block; all stretches between checkpoints advance together."""
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    words = np.frombuffer(stream, "<u4").astype(np.uint64)
    x = np.frombuffer(states, "<u8").reshape(-1, LANES).copy()
    place = np.frombuffer(starts, "<i8").copy()
    steps = -(-n // LANES)
    out = np.zeros((len(x) * STEPS, LANES), dtype=np.int64)
    mask, bits, shift = np.uint64((1 << BITS) - 1), np.uint64(BITS), np.uint64(32)
    base = np.arange(len(x)) * STEPS
    for step in range(min(STEPS, steps)):
        if step and len(x) > 1 and base[-1] + step == steps:  # the last stretch is shorter
            x, place, base = x[:-1], place[:-1], base[:-1]
        slot = x & mask
        symbol = table.symbol[slot.astype(np.int64)]
        out[base + step] = symbol
        x = table.freq[symbol] * (x >> bits) + slot - table.start[symbol]
        low = x < np.uint64(LOW)
        if low.any():
            rank = np.cumsum(low, axis=1)
            source = (place[:, None] + rank - 1)[low]
            x[low] = (x[low] << shift) | words[source]
            place += rank[:, -1]
    return out.ravel()[:n]


_tokenizers: dict[str, PieceTable] = memory()


def worker_pieces(packed: str) -> PieceTable:
    """One tokenizer per worker process, with the pieces it has seen."""
    key = f"{len(packed)}-{zlib.crc32(packed.encode())}"
    if key not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, models, pre_tokenizers

        tokenizer = Tokenizer.from_str(packed)
        added = tuple(t.content for t in tokenizer.get_added_tokens_decoder().values())

        def encode_pieces(texts: list[str]) -> list[bytes]:
            return [array("I", e.ids).tobytes()
                    for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        model, cut = tokenizer.model, tokenizer.pre_tokenizer
        vocabulary = tokenizer.get_vocab(with_added_tokens=False)
        # The byte-level alphabet has one sign for a byte.
        n_bytes = np.zeros(max(tokenizer.get_vocab().values(), default=0) + 1, np.int64)
        for token, number in vocabulary.items():
            n_bytes[number] = len(token)

        def encode_many(pieces: list[str]) -> list[bytes]:
            """Pieces that follow a space each, many to a text; the bytes of ids tell them apart."""
            texts = ["".join(pieces[i:i + TOGETHER]) for i in range(0, len(pieces), TOGETHER)]
            ids = np.concatenate([np.zeros(0, np.uint32)] + [
                np.array(e.ids, np.uint32)
                for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
            wanted = np.cumsum([len(piece.encode()) for piece in pieces], dtype=np.int64)
            ends = np.cumsum(n_bytes[ids])
            at = np.searchsorted(ends, wanted)
            if not len(ids) or at[-1] >= len(ends) or (ends[at] != wanted).any():
                return encode_pieces(pieces)  # an added token among them
            raw, stops = ids.tobytes(), (4 * (at + 1)).tolist()
            return [raw[a:b] for a, b in zip([0, *stops], stops)]

        def encode_word(letters: str, after_space: bool) -> bytes:
            # The byte-level alphabet has letters as they are and this sign for a space.
            found = model.tokenize("\u0120" + letters if after_space else letters)
            return array("I", [t.id for t in found]).tobytes()

        plain = (isinstance(model, models.BPE) and isinstance(cut, pre_tokenizers.ByteLevel)
                 and cut.use_regex and not cut.add_prefix_space and tokenizer.normalizer is None)
        _tokenizers.clear()
        _tokenizers[key] = PieceTable(
            encode_pieces, added=added, **(
                {"word": encode_word, "many": encode_many} if plain else {}))
    return _tokenizers[key]


ID_ROWS = ("part int, seq int, before long, n_docs int, n_ids long, doc_ids binary, lengths binary, "
           "ids binary, counts binary")


def id_rows(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """Ids of all texts in ascending document order, whole documents to a row.

    The last row of a part has the counts of each id in the part.
    """
    ship(docs.sparkSession)
    with open(tokenizer_file, encoding="utf-8") as file:
        packed = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches):
        table = worker_pieces(packed.value)
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        names, lengths, ids, size = [], [], [], 0
        tally = np.zeros(0, np.int64)

        def row(last):
            nonlocal tally
            together = np.concatenate(ids)
            tally = summed(tally, np.bincount(together))
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                "before": pa.array([before], pa.int64()),
                "n_docs": pa.array([len(names)], pa.int32()), "n_ids": pa.array([size], pa.int64()),
                "doc_ids": pa.array([_packed_ids(names)], pa.binary()),
                "lengths": pa.array([np.array(lengths, "<i8").tobytes()], pa.binary()),
                "ids": pa.array([planes(together)], pa.binary()),
                "counts": pa.array([tally.astype("<i8").tobytes() if last else None], pa.binary())})

        for batch in batches:
            own = batch.column(0).to_pylist()
            texts = batch.column(1).to_pylist()
            for start, stop in by_size(texts, TEXT_AT_ONCE):
                found, counts = table.texts(texts[start:stop], END_ID)
                # Whole documents up to the size of a block.
                ends = np.cumsum(counts)
                at = 0
                while at < len(counts):
                    if size >= BLOCK_IDS:
                        yield row(False)
                        before += size
                        names, lengths, ids, size, seq = [], [], [], 0, seq + 1
                    low = int(ends[at - 1]) if at else 0
                    to = int(np.searchsorted(ends, low + BLOCK_IDS - size)) + 1
                    to = min(to, len(counts))
                    names += own[start + at:start + to]
                    lengths += counts[at:to].tolist()
                    ids.append(found[low:int(ends[to - 1])])
                    size += len(ids[-1])
                    at = to
        if names:
            yield row(True)

    ordered = (docs.select("doc_id", text_bytes().alias("raw"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "raw"))
    return ordered.mapInArrow(run, ID_ROWS)


def _packed_ids(names: list) -> bytes:
    """Document ids as 64-bit numbers after one byte each that tells null."""
    return np.array([name is None for name in names], np.uint8).tobytes() + np.array(
        [name or 0 for name in names], "<i8").tobytes()


def _unpacked_ids(packed: bytes, n: int) -> list:
    null = np.frombuffer(packed[:n], np.uint8)
    return [None if e else int(v) for e, v in zip(null, np.frombuffer(packed[n:], "<i8"))]


def summed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sum of two arrays of counts, the shorter one filled with zeros."""
    short, long = sorted((a, b), key=len)
    out = long.astype(np.int64)
    out[:len(short)] += short
    return out


def id_counts(rows: DataFrame) -> DataFrame:
    """How often each id occurs, from the counts of the parts; the ids are not read."""
    def run(batches):
        counts = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                counts = summed(counts, np.frombuffer(raw, "<i8"))
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"id": pa.array(found, pa.int64()),
                                          "n": pa.array(counts[found], pa.int64())})

    return (rows.select("counts").where(F.col("counts").isNotNull())
            .mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")))


FILE_ROWS = ("part int, seq int, n_docs int, n_ids long, first_id long, doc_ids binary, "
             "lengths binary, stream binary, states binary, starts binary, "
             "stream_crc32 long, ids_crc32 long")


def write_files(docs: DataFrame, tokenizer_file: str) -> tuple[DataFrame, np.ndarray]:
    """Encode all texts and write the coded blocks; gives the files and the shared table.

    The table has an entry per id of the vocabulary, a fixed size. The offsets are one
    number per part of the files, which are as many as shuffle partitions at most.
    """
    rows = staged(id_rows(docs, tokenizer_file), "ids")
    spark = docs.sparkSession
    counted = id_counts(rows).collect()  # at most one row per id of the vocabulary
    counts = np.zeros(max((r["id"] for r in counted), default=0) + 1, dtype=np.int64)
    for r in counted:
        counts[r["id"]] = r["n"]
    freq = shared_table(counts)
    parts = rows.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    first = dict(zip((r["part"] for r in parts), accumulate([0, *(r["n"] for r in parts)])))
    packed = spark.sparkContext.broadcast((freq, first))

    def run(batches):
        table, first_of = Table(packed.value[0]), packed.value[1]
        for r in rows_of(batches):
            ids = from_planes(r["ids"], np.uint32)
            stream, states, starts = encode(ids, table)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([r["part"]], pa.int32()),
                "seq": pa.array([r["seq"]], pa.int32()),
                "n_docs": pa.array([r["n_docs"]], pa.int32()),
                "n_ids": pa.array([r["n_ids"]], pa.int64()),
                "first_id": pa.array([first_of[r["part"]] + r["before"]], pa.int64()),
                "doc_ids": pa.array([r["doc_ids"]], pa.binary()),
                "lengths": pa.array([r["lengths"]], pa.binary()),
                "stream": pa.array([stream], pa.binary()),
                "states": pa.array([states], pa.binary()),
                "starts": pa.array([starts], pa.binary()),
                "stream_crc32": pa.array([zlib.crc32(stream)], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(ids.astype("<u4"))], pa.int64())})

    return staged(rows.mapInArrow(run, FILE_ROWS), "files"), freq


def read_files(files: DataFrame, freq: np.ndarray) -> DataFrame:
    """Per document from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    A block whose checksums fail raises.
    """
    packed = files.sparkSession.sparkContext.broadcast(freq)

    def run(batches):
        table = Table(packed.value)
        for r in rows_of(batches):
            if zlib.crc32(r["stream"]) != r["stream_crc32"]:
                raise ValueError(f"stream of block {r['part']}/{r['seq']} is damaged")
            ids = decode(r["n_ids"], r["stream"], r["states"], r["starts"], table)
            raw = ids.astype("<u4").tobytes()
            if zlib.crc32(raw) != r["ids_crc32"]:
                raise ValueError(f"ids of block {r['part']}/{r['seq']} are damaged")
            lengths = np.frombuffer(r["lengths"], "<i8")
            ends = np.cumsum(lengths)
            first = ends - lengths
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(_unpacked_ids(r["doc_ids"], r["n_docs"]), pa.int64()),
                "start": pa.array(first + r["first_id"], pa.int64()),
                "n_tokens": pa.array(lengths, pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(raw[4 * a:4 * b])
                                       for a, b in zip(first, ends)], pa.int64())})

    return files.select("part", "seq", "n_docs", "n_ids", "first_id", "doc_ids", "lengths",
                        "stream", "states", "starts", "stream_crc32", "ids_crc32").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")
