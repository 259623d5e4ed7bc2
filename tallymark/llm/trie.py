"""An n-gram trie in Elias-Fano coded levels, laid out in one memory-mapped file.

Level one holds the contexts, in order of their names, with a pointer to the first of each
context's successors and a quantised back-off weight. Level two holds the successors' ids and
quantised probabilities. Ids are kept relative to their context: the number of the context
leads, so the whole level is one rising sequence, and looking an id up in a context is a
search for the successor of one number in it.
"""

from __future__ import annotations

import mmap
import tempfile

import numpy as np

U = np.uint64
ID_BITS = 40
LEVELS = 255  # of a quantised weight
LOWEST = -12.0  # log10 of the smallest probability told apart


def quantised(log10: np.ndarray) -> np.ndarray:
    return np.rint(np.clip(log10, LOWEST, 0.0) / LOWEST * LEVELS).astype(np.uint8)


def restored(codes: np.ndarray) -> np.ndarray:
    return codes.astype(np.float64) * (LOWEST / LEVELS)


class EliasFano:
    """A rising sequence: low bits side by side, high bits as gaps in a bitmap."""

    @staticmethod
    def write(values: np.ndarray) -> tuple[int, bytes, bytes]:
        """(number of low bits, low bits, high bits)."""
        n = len(values)
        if not n:
            return 0, b"", b""
        low = max(0, int(values[-1] // U(n)).bit_length() - 1)
        high = (values >> U(low)).astype(np.int64)
        bitmap = np.zeros(int(high[-1]) + n + 1, np.uint8)
        bitmap[high + np.arange(n)] = 1
        parts = []
        for start in range(0, n, 1 << 16):  # whole bytes: 65536 is a multiple of 8
            own = values[start:start + (1 << 16)]
            shifts = np.arange(low, dtype=U)
            parts.append(np.packbits((own[:, None] >> shifts & U(1)).astype(np.uint8)).tobytes())
        return low, b"".join(parts), np.packbits(bitmap).tobytes()

    @staticmethod
    def read(n: int, low: int, low_bits: np.ndarray, high_bits: np.ndarray) -> np.ndarray:
        if not n:
            return np.zeros(0, U)
        out = (np.flatnonzero(np.unpackbits(high_bits))[:n] - np.arange(n)).astype(U) << U(low)
        if low:
            for start in range(0, n, 1 << 16):
                m = min(1 << 16, n - start)
                at = start * low // 8
                own = np.unpackbits(low_bits[at:at + -(-m * low // 8)], count=m * low)
                own = own.reshape(m, low)
                value = np.zeros(m, U)
                for bit in range(low):
                    value |= own[:, bit].astype(U) << U(bit)
                out[start:start + m] |= value
        return out


class Trie:
    """Written once, then mapped; the file has no name and goes with the object."""

    def __init__(self, contexts: np.ndarray, backoff: np.ndarray, starts: np.ndarray,
                 ids: np.ndarray, weights: np.ndarray) -> None:
        """``contexts`` rise; ``starts`` has one more entry; ``ids`` rise in each context."""
        if len(contexts) >= 1 << (64 - ID_BITS):
            raise ValueError("too many contexts in one shard; use more shards")
        owner = np.repeat(np.arange(len(contexts), dtype=np.int64), np.diff(starts))
        relative = owner.astype(U) << U(ID_BITS) | ids
        self.sizes = []
        self.file = tempfile.TemporaryFile()
        for values in (contexts, starts.astype(U), relative):
            low, low_bits, high_bits = EliasFano.write(values)
            self.sizes.append((len(values), low, len(low_bits), len(high_bits)))
            self.file.write(low_bits)
            self.file.write(high_bits)
        self.file.write(quantised(backoff).tobytes())
        self.file.write(quantised(weights).tobytes())
        self.file.flush()
        self.length = self.file.tell()
        self.map = mmap.mmap(self.file.fileno(), 0, access=mmap.ACCESS_READ) if self.length else b""

    def levels(self):
        """(contexts, back-off codes, starts, relative ids, probability codes) from the map."""
        raw = np.frombuffer(self.map, np.uint8)
        at, out = 0, []
        for n, low, n_low, n_high in self.sizes:
            out.append(EliasFano.read(n, low, raw[at:at + n_low],
                                      raw[at + n_low:at + n_low + n_high]))
            at += n_low + n_high
        contexts, starts, relative = out
        backoff = raw[at:at + len(contexts)]
        return contexts, backoff, starts, relative, raw[at + len(contexts):]

    def find(self, contexts: np.ndarray, ids: np.ndarray, levels=None):
        """(found, code): the probability code of a successor, else its context's back-off.

        A context that is not in the trie backs off for nothing.
        """
        known, backoff, starts, relative, codes = levels or self.levels()
        found = np.zeros(len(contexts), bool)
        out = np.zeros(len(contexts), np.uint8)
        if not len(known) or not len(contexts):
            return found, out
        at = np.minimum(np.searchsorted(known, contexts), len(known) - 1)
        here = known[at] == contexts
        out[here] = backoff[at[here]]
        target = at.astype(U) << U(ID_BITS) | ids
        place = np.searchsorted(relative, target)  # the successor of the target
        inside = here & (place < starts[at + 1].astype(np.int64))
        inside[inside] = relative[place[inside]] == target[inside]
        found[inside] = True
        out[inside] = codes[place[inside]]
        return found, out
