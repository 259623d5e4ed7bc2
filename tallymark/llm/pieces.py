"""Splitting text where a byte-level tokenizer always splits, and remembering the answers.

The public pattern begins a new match at every space that a non-space follows. Text cut at
those spaces can be encoded piece by piece: most pieces are words seen before.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LONGEST_KEPT = 64
KEPT_PIECES = 400_000
#: The matches of the public pattern in ASCII text.
ASCII_MATCHES = re.compile(
    r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
#: A run of these at the end of a piece is one match.
MARKS = string.punctuation


class PieceMemo(dict):
    """Piece after a space -> encoded bytes; None for a piece that continues the one before.

    The memory is bounded: a full memo becomes the older half, whose pieces come back as they
    are used, and what was older is forgotten.
    """

    def __init__(self, encode: Callable[[str], bytes], limit: int = KEPT_PIECES) -> None:
        super().__init__()
        self.encode = encode
        self.limit = limit
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str):
        if not piece or piece[0].isspace():
            return None
        value = self.older.get(piece)
        if value is None:
            value = self.encode(" " + piece)
        if len(piece) <= LONGEST_KEPT:
            self[piece] = value
        return value

    def text(self, text: str) -> bytes:
        """The encoded whole text."""
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()
        if not text:
            return b""
        pieces = text.split(" ")
        values = list(map(self.__getitem__, pieces[1:]))
        if None in values:
            return b"".join(map(self.encode, joined(pieces)))
        return (self.encode(pieces[0]) if pieces[0] else b"") + b"".join(values)


class PieceTable:
    """Encodes many texts together: the distinct pieces once, then arrays of ids.

    A text that holds one of the ``added`` strings, which the encoder cuts out before it cuts
    words, is encoded in one piece.

    ``word`` gives the ids of letters alone, after a space or not, without another look for words
    in them. With it an ASCII piece is put together from its words and marks, which are far fewer
    than the pieces they make. ``many`` gives the same as ``encode`` for pieces after a space each.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = KEPT_PIECES,
                 added: tuple[str, ...] = (), word: Callable[[str, bool], bytes] | None = None,
                 many: Callable[[list[str]], list[bytes]] | None = None) -> None:
        self.encode = encode
        self.added = added
        self.limit = limit
        self.word = word
        self.many = many or encode
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def _of(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that follow a space each; those that continue one are empty."""
        if len(self.known) > self.limit:
            self.known, self.older = {}, self.known
        if len(self.marks) > self.limit:
            self.marks = {}
        known, older, marks = self.known, self.older, self.marks
        values = list(map(known.get, pieces))
        new = []
        for i in [i for i, value in enumerate(values) if value is None]:
            piece = pieces[i]
            if self.word is None or len(piece) > LONGEST_KEPT or not piece.isascii():
                value = older.get(piece)
                if value is None:
                    new.append(i)
                    continue
                known[piece] = value
            else:
                letters = piece.rstrip(MARKS)
                if letters.isalpha():
                    value = known.get(letters) or self._after_space(letters)
                    if letters is not piece:
                        tail = piece[len(letters):]
                        value += marks.get(tail) or self._match(tail)
                else:
                    value = b"".join(map(self._match, ASCII_MATCHES.findall(" " + piece)))
            values[i] = value
        for i, v in zip(new, self.many([" " + pieces[i] for i in new])):
            values[i] = v
            if len(pieces[i]) <= LONGEST_KEPT:
                self.known[pieces[i]] = v
        return values

    def _after_space(self, letters: str) -> bytes:
        value = self.known.get(letters)
        if value is None:
            value = self.older.get(letters)
            if value is None:
                value = self.word(letters, True)
            self.known[letters] = value
        return value

    def _match(self, match: str) -> bytes:
        """Ids of one match of the pattern."""
        if match[0] == " " and match[1:].isalpha():
            return self._after_space(match[1:])
        value = self.marks.get(match)
        if value is None:
            value = self.word(match, False) if match.isalpha() else self.encode([match])[0]
            self.marks[match] = value
        return value

    def texts(self, raw: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each followed by ``end``, and how many each has."""
        try:
            column = pa.array(raw, pa.binary()).cast(pa.string())
        except pa.ArrowInvalid:  # not UTF-8
            column = pa.array([t.decode("utf-8", "replace") for t in raw], pa.string())
        lists = pc.split_pattern(column, " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        entry = coded.indices.to_numpy().astype(np.int64)
        heads = pc.utf8_slice_codeunits(coded.dictionary, 0, 1).dictionary_encode()
        odd = np.array([not h or h.isspace() for h in heads.dictionary.to_pylist()], bool)[
            heads.indices.to_numpy()]
        values = self._of(pieces)
        first = offsets[:-1]
        # First pieces follow no space; texts with runs of spaces are cut in longer chunks.
        strange = np.zeros(len(entry), bool)
        strange[:] = odd[entry]
        strange[first] = False
        whole = np.add.reduceat(strange, first) > 0 if len(first) else np.zeros(0, bool)
        held = np.zeros(len(first), bool)
        for content in self.added:
            held |= pc.match_substring(column, content).to_numpy(zero_copy_only=False)
        whole |= held
        heads = [pieces[i] for i in entry[first]]
        chunks, sizes = [], []
        for i in range(len(first)):
            if held[i]:
                own = [column[i].as_py()]
            elif whole[i]:
                own = joined([pieces[j] for j in entry[first[i]:offsets[i + 1]]])
            else:
                own = [heads[i]] if heads[i] else []
            chunks += own
            sizes.append(len(own))
        found = self.encode(chunks)
        at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        stop = np.array([end], np.uint32).tobytes()
        values += [b"".join(found[a:b]) for a, b in zip(at, at[1:])] + [stop]
        length = np.fromiter(map(len, values), np.int64, len(values)) // 4
        begin = np.cumsum(length) - length
        store = np.frombuffer(b"".join(values), np.uint32)
        # The order of the output: of each text its head, its other pieces, the end.
        shift = np.arange(len(first))
        order = np.full(len(entry) + len(first), len(values) - 1, np.int64)
        place = np.arange(len(entry)) + np.repeat(shift, np.diff(offsets))
        order[place] = entry
        order[first + shift] = len(pieces) + shift
        taken = length[order]
        skip = np.zeros(len(order), bool)
        skip[place] = np.repeat(whole, np.diff(offsets))
        skip[first + shift] = False
        taken[skip] = 0
        ends = np.cumsum(taken)
        ids = store[np.arange(int(ends[-1]) if len(ends) else 0)
                    + np.repeat(begin[order] - (ends - taken), taken)]
        return ids, np.add.reduceat(taken, first + shift) if len(first) else np.zeros(0, np.int64)


def joined(pieces: list[str]) -> list[str]:
    """Pieces of a text split at spaces as chunks; runs of spaces stay with the chunk before."""
    chunks = [pieces[0]]
    for piece in pieces[1:]:
        if not piece or piece[0].isspace():
            chunks[-1] += " " + piece
        else:
            chunks.append(" " + piece)
    return [chunk for chunk in chunks if chunk]
