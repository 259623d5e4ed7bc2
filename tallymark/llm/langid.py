"""Language of every word by a linear-chain conditional random field, and of a text from that.

A word's features are its affixes and inner byte n-grams (hashed) and its entry in a lexicon of
words seen in training. Their weights and the weights of label transitions are learned together:
training sequences splice runs of sampled documents of several languages, so that the field
sees where texts switch. Forward-backward gives each word's label probabilities; a text's
language is the one with most expected words, its score their share.

The field is fitted on a bounded sample of labelled rows (``Training.max_rows``); it predicts
every word of every text.

Defined results: null text or text without a letter is ``und`` with score 0; with no labelled
row to learn from every text is ``und``; equal texts get equal results; ties go to the first
label in order.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallymark.llm.common import by_size, extended, ship, text_bytes

UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
U = np.uint64
WORDS_AT_ONCE = 16_384
TEXT_AT_ONCE = 4 << 20


@dataclass(frozen=True)
class Training:
    max_rows: int = 1200  # labelled rows to learn from, shared evenly among the languages
    space: int = 1 << 17  # hashed features
    lexicon_from: int = 3  # sample occurrences that make a lexicon word
    epochs: int = 3
    batch: int = 64
    words: int = 200  # of a training sequence
    rate: float = 0.2
    seed: int = 7


def features(words: list[bytes], lexicon: set[bytes], space: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words end to end, and where each word's begin.

    Every word has features, so that no stretch is empty.
    """
    framed = [b"\x02" + word + b"\x03" for word in words]
    sizes = np.fromiter(map(len, framed), np.int64, len(framed))
    raw = np.frombuffer(b"".join(framed), np.uint8).astype(U)
    owner = np.repeat(np.arange(len(framed)), sizes)
    ends = np.cumsum(sizes)
    at_start = np.zeros(len(raw), bool)
    at_start[ends - sizes] = True
    owners, found = [], []
    value = np.zeros(len(raw), U)
    for n in range(1, 7):
        m = len(raw) - n + 1
        if m <= 0:
            break
        value = value[:m] * U(0x100000001B3) + raw[n - 1:] + U(1)
        inside = owner[:m] == owner[n - 1:]
        if n == 1:
            inside &= raw[:m] > 3
        elif n > 4:  # longer ones as affixes only
            last = np.zeros(m, bool)
            tail = ends - n
            last[tail[sizes >= n]] = True
            inside &= at_start[:m] | last
        places = np.flatnonzero(inside)
        h = value[places] * U(0x9E3779B97F4A7C15) + U(n * 7919)
        h ^= h >> U(32)
        owners.append(owner[places])
        found.append((h * U(0xD6E8FEB86659FD93) >> U(40)).astype(np.int64) % space)
    known = [i for i, word in enumerate(words) if word in lexicon]
    owners.append(np.array(known, np.int64))
    found.append(np.array([xxhash.xxh64_intdigest(words[i], seed=11) % space for i in known],
                          np.int64))
    owners.append(np.arange(len(words)))  # a constant
    found.append(np.full(len(words), space - 1, np.int64))
    owner, number = np.concatenate(owners), np.concatenate(found)
    order = np.argsort(owner, kind="stable")
    return number[order], np.searchsorted(owner[order], np.arange(len(words)))


def emissions(weights: np.ndarray, numbers: np.ndarray, starts: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros((0, weights.shape[1]), np.float32)
    return np.add.reduceat(weights[numbers], starts, axis=0)


def marginals(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray):
    """Label probabilities of every word by forward-backward.

    ``scores`` holds the words of all texts end to end. Texts advance together, longest first,
    so that step t handles all texts of more than t words at once.
    """
    n_labels = scores.shape[1]
    order = np.argsort(-lengths, kind="stable")
    size = lengths[order]
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])[order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), side="left")
    offset = np.concatenate([[0], np.cumsum(active)])
    step = np.repeat(np.arange(longest), active)
    rank = np.arange(int(offset[-1])) - offset[step]
    word = first[rank] + step  # place of each (step, text) among the words
    e = scores[word].astype(np.float64)
    e = np.exp(e - e.max(axis=1, keepdims=True)) if len(e) else e
    a = np.exp(moves - moves.max())
    forward = np.empty_like(e)
    state = None
    for t in range(longest):
        low, high = offset[t], offset[t + 1]
        state = e[low:high] if t == 0 else (state[:active[t]] @ a) * e[low:high]
        state = state / state.sum(axis=1, keepdims=True)
        forward[low:high] = state
    out = np.empty_like(e)
    back = np.ones((len(lengths), n_labels))
    backward_next = None
    pair = np.zeros((n_labels, n_labels))
    for t in range(longest - 1, -1, -1):
        low, high = offset[t], offset[t + 1]
        if t + 1 < longest:
            nxt = slice(offset[t + 1], offset[t + 2])
            n = active[t + 1]
            ahead = e[nxt] * back[:n]
            joint = forward[low:low + n].T @ (ahead / ((forward[low:low + n] @ a) * ahead).sum(
                axis=1, keepdims=True))
            pair += joint * a
            renewed = ahead @ a.T
            back[:n] = renewed / renewed.sum(axis=1, keepdims=True)
        both = forward[low:high] * back[:active[t]]
        out[low:high] = both / both.sum(axis=1, keepdims=True)
    result = np.empty_like(out)
    result[word] = out
    return result, pair


@dataclass
class Field:
    labels: list[str]
    weights: np.ndarray
    moves: np.ndarray
    lexicon: set[bytes]

    def score_words(self, words: list[bytes]) -> np.ndarray:
        """Label scores of each word, some thousand words at a time to bound memory."""
        parts = [emissions(self.weights, *features(words[i:i + WORDS_AT_ONCE], self.lexicon,
                                                   len(self.weights)))
                 for i in range(0, len(words), WORDS_AT_ONCE)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.labels)), np.float32)

    def word_labels(self, text: str) -> list[tuple[str, str, float]]:
        """(word, label, probability) of each word of one text."""
        words = [w.encode() for w in text.lower().split()]
        if not words:
            return []
        found, _ = marginals(self.score_words(words), np.array([len(words)]), self.moves)
        return [(w.decode(), self.labels[int(p.argmax())], float(p.max()))
                for w, p in zip(words, found)]

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        split = [text.lower().encode().split() if LETTER.search(text) else [] for text in texts]
        numbers: dict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        ids = np.fromiter(map(numbers.__getitem__, chain.from_iterable(split)), np.int64,
                          int(lengths.sum()))
        if not len(ids) or not self.labels:
            return [(UNKNOWN, 0.0)] * len(texts)
        scores = self.score_words(list(numbers))
        found, _ = marginals(scores[ids], lengths, self.moves)
        owner = np.repeat(np.arange(len(texts)), lengths)
        total = np.stack([np.bincount(owner, found[:, k], len(texts))
                          for k in range(len(self.labels))], axis=1)
        best = total.argmax(axis=1)
        return [(self.labels[best[i]], float(min(1.0, total[i, best[i]] / n))) if n else
                (UNKNOWN, 0.0) for i, n in enumerate(lengths)]


def spliced(texts: list[tuple[str, int]], rng, words: int):
    """Runs of the sampled texts dealt into sequences of (word, label), with switches."""
    runs = []
    for text, label in texts:
        own = text.lower().encode().split()
        start = 0
        while start < len(own):
            end = start + int(rng.integers(5, words))
            runs.append((own[start:end], label))
            start = end
    sequence: list[bytes] = []
    marks: list[int] = []
    for i in rng.permutation(len(runs)):
        sequence += runs[i][0]
        marks += [runs[i][1]] * len(runs[i][0])
        while len(sequence) >= words:
            yield sequence[:words], marks[:words]
            sequence, marks = sequence[words:], marks[words:]
    if sequence:
        yield sequence, marks


def fit(rows: list[tuple[str, str]], how: Training = Training()) -> Field:
    """A field from (text, language) rows, by stochastic gradient with per-weight rates."""
    labels = sorted({lang for _, lang in rows})
    place = {lang: i for i, lang in enumerate(labels)}
    rng = np.random.default_rng(how.seed)
    texts = [(text, place[lang]) for text, lang in rows]
    counts = Counter(chain.from_iterable(text.lower().encode().split() for text, _ in texts))
    lexicon = {word for word, n in counts.items() if n >= how.lexicon_from}
    vocabulary = list(counts)
    number = {word: i for i, word in enumerate(vocabulary)}
    feature, start = features(vocabulary, lexicon, how.space) if vocabulary else (
        np.zeros(0, np.int64), np.zeros(0, np.int64))
    end = np.append(start[1:], len(feature))
    k = len(labels)
    weights, moves = np.zeros((how.space, k), np.float32), np.zeros((k, k))
    seen_w, seen_m = np.full((how.space, k), 1e-3, np.float32), np.full((k, k), 1e-3)
    for _ in range(how.epochs if k else 0):
        sequences = list(spliced(texts, rng, how.words))
        for at in range(0, len(sequences), how.batch):
            batch = sequences[at:at + how.batch]
            lengths = np.array([len(s) for s, _ in batch])
            ids = np.array([number[w] for s, _ in batch for w in s])
            truth = np.array([m for _, marks in batch for m in marks])
            distinct, inverse = np.unique(ids, return_inverse=True)
            sizes = end[distinct] - start[distinct]
            ends = np.cumsum(sizes)
            picks = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes) + np.repeat(
                start[distinct], sizes)
            own = feature[picks]
            scores = emissions(weights, own, ends - sizes)
            found, pair = marginals(scores[inverse], lengths, moves)
            slope = -found
            slope[np.arange(len(truth)), truth] += 1
            per_word = np.stack([np.bincount(inverse, slope[:, j], len(distinct))
                                 for j in range(k)], axis=1) / len(batch)
            spread = np.repeat(per_word, sizes, axis=0)
            touched, where = np.unique(own, return_inverse=True)
            g = np.stack([np.bincount(where, spread[:, j], len(touched)) for j in range(k)],
                         axis=1).astype(np.float32)
            seen_w[touched] += g * g
            weights[touched] += how.rate * g / np.sqrt(seen_w[touched])
            same = np.repeat(np.arange(len(batch)), lengths)
            inner = same[1:] == same[:-1]
            real = np.zeros((k, k))
            np.add.at(real, (truth[:-1][inner], truth[1:][inner]), 1)
            g = (real - pair) / len(batch)
            seen_m += g * g
            moves += how.rate * g / np.sqrt(seen_m)
    return Field(labels, weights, moves, lexicon)


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; a null id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % parts


def training_rows(docs: DataFrame, how: Training) -> list[tuple[str, str]]:
    """At most ``max_rows`` labelled rows, even over the languages, picked by a hash."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    turn = Window.partitionBy("lang").orderBy("h", "doc_id")
    picked = (labelled.select("lang", "doc_id", F.xxhash64("doc_id").alias("h"))
              .withColumn("turn", F.row_number().over(turn))
              .where(F.col("turn") <= how.max_rows)
              .orderBy("turn", "lang").limit(how.max_rows).select("doc_id", "lang").distinct())
    # The sample has a proven bound.
    rows = (labelled.join(F.broadcast(picked), (labelled["doc_id"].eqNullSafe(picked["doc_id"]))
                          & (labelled["lang"] == picked["lang"]), "left_semi")
            .select("doc_id", "text", "lang").orderBy("doc_id", "text").limit(how.max_rows).collect())
    return [(r["text"], r["lang"]) for r in rows]


def predicted(docs: DataFrame, field: Field, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with ``lang_pred`` and ``score`` of every whole text."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        model = sent.value
        for batch in batches:
            raw = batch.column(batch.num_columns - 1).to_pylist()
            out: list[tuple[str, float]] = []
            for start, end in by_size(raw, TEXT_AT_ONCE):
                out += model.predict([t.decode("utf-8", "replace") for t in raw[start:end]])
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-1] + [pa.array([p for p, _ in out], pa.string()),
                                      pa.array([s for _, s in out], pa.float64())],
                names=batch.schema.names[:-1] + ["lang_pred", "score"])

    kept = docs.select(*keep)
    return docs.select(*keep, text_bytes().alias("raw")).mapInArrow(
        run, extended(kept, "lang_pred string, score double"))


def held_out_report(docs: DataFrame, how: Training = Training(), parts: int = 3,
                    part: int = 1) -> DataFrame:
    """Learn from rows outside one part of the ids; predict all rows."""
    fold = remainder(F.col("doc_id"), parts)
    field = fit(training_rows(docs.where(fold != part).select("doc_id", "text", "lang"), how), how)
    marked = docs.select("doc_id", "text", (fold == part).alias("held_out"))
    return predicted(marked, field, ["doc_id", "held_out"])
