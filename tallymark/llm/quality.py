"""Quality rules: divergence of a text's histograms from those of its language.

A text is described by two histograms: character classes, and common words of the language
lists plus all others. The reference of a language is, entry by entry, the mean of the middle
third of the shares of its texts. Only texts that the histogram judges have a voice: long enough
and not failed by the base rule. Equal texts have one voice together, and the voices of a source
add up to one, so that no group of copies and no hot source moves the reference far. A text far
from its reference by Jensen-Shannon distance is rejected.

Defined results: a null or empty text has zero counts and fails the base rule. A document
without a language is held against the reference of all documents. Short texts are not judged by
a histogram (minimum-length guards); where a language has no judged text, distances are null.
Documents without a source share one unnamed source; a text found in several sources speaks for
the first by name. Repeated rows give one result each.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallymark.llm.common import by_length, extended, forget, ship, staged
from tallymark.llm.lines import NO_SITE, text_key

# Common words of the languages.
COMMON_WORDS = (
    # English
    "the of and to in a is that it for was on are as with be by this from or have an he they "
    "which at not but his we "
    # French
    "le la les de des du et en un une que qui dans pour pas au sur par ce il elle avec est plus "
    "se ne ou son "
    # German
    "der die das und ist von den mit zu ein eine für auf nicht dem des sich auch im als wie "
    "bei oder aus "
    # Spanish
    "el los las y del por con una su para al lo como más pero sus o esta entre cuando muy sin"
).split()
WORDS = list(dict.fromkeys(COMMON_WORDS))
SYMBOLS = b"#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "line", "stop", "mark", "symbol", "other", "letter")


def _class_table() -> np.ndarray:
    table = np.full(256, CLASSES.index("other"), dtype=np.int8)
    for low, high, name in ((b"a", b"z", "lower"), (b"A", b"Z", "upper"), (b"0", b"9", "digit")):
        table[low[0]:high[0] + 1] = CLASSES.index(name)
    for chars, name in ((b" \t\x0b\x0c\r", "space"), (b"\n", "line"), (b".,;:", "stop"),
                        (b"!?'\"()-", "mark"), (SYMBOLS, "symbol")):
        table[list(chars)] = CLASSES.index(name)
    table[0xC0:] = CLASSES.index("letter")
    table[0x80:0xC0] = -1  # later bytes of a character
    return table


CLASS_OF = _class_table()
STATS = pa.schema([
    ("n_words", pa.int64()), ("n_chars", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
    ("class_counts", pa.list_(pa.int64())), ("word_counts", pa.list_(pa.int64()))])
TRIM = 1 / 3  # of the voices, left out at either end of an entry's shares
#: Bytes of text counted at a time: the arrays of a chunk are some forty times as large.
STATS_BYTES = 1 << 20
STEPS = 4096  # of a share, by which shares are ordered


@dataclass(frozen=True)
class Rules:
    """Limits; a text shorter than a guard is not judged by that histogram.

    The histogram of a short text strays by chance, about as one over the root of its length,
    so each limit has a floor for long texts and a part that shrinks with the length.
    """

    min_words: int = 10
    max_repeat_percent: int = 20
    min_class_chars: int = 100
    class_floor: float = 0.25
    class_base: float = 0.20
    class_slack: float = 4.0
    min_histogram_words: int = 100
    word_floor: float = 0.25
    word_base: float = 0.10
    word_slack: float = 2.6


def repeat_words(ids: np.ndarray, owner: np.ndarray, n_docs: int, width: int = 5) -> np.ndarray:
    """Per text, the words that lie in a window of ``width`` words found twice or more in it."""
    out = np.zeros(n_docs, dtype=np.int64)
    n = len(ids) - width + 1
    if n <= 0:
        return out
    key = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        key = key * np.uint64(0x9E3779B97F4A7C15) + ids[i:i + n].astype(np.uint64) + np.uint64(1)
        key ^= key >> np.uint64(29)
    key = key * np.uint64(0xBF58476D1CE4E5B9) + owner[:n].astype(np.uint64)
    key ^= key >> np.uint64(32)
    key *= np.uint64(0x94D049BB133111EB)
    places = np.flatnonzero(owner[:n] == owner[width - 1:])
    _, inverse, counts = np.unique(key[places], return_inverse=True, return_counts=True)
    hits = places[counts[inverse] > 1]
    covered = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(covered, hits, 1)
    np.add.at(covered, hits + width, -1)
    inside = np.cumsum(covered[:-1]) > 0
    return np.bincount(owner[inside], minlength=n_docs)


def dup_lines(text: bytes) -> int:
    lines = text.split(b"\n")
    if len(lines) < 2:
        return 0
    with_word = [line for line in lines if line and not line.isspace()]
    return len(with_word) - len(set(with_word))


def text_stats(texts: list[bytes]) -> pa.RecordBatch:
    n = len(texts)
    raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, n)
    owner = np.repeat(np.arange(n, dtype=np.int32), lengths)
    classes = CLASS_OF[raw]
    starts = classes >= 0
    k = len(CLASSES)
    hist = np.bincount(owner[starts] * k + classes[starts], minlength=n * k).reshape(n, k)
    blank = CLASSES.index("space"), CLASSES.index("line")
    word_chars = hist.sum(axis=1) - hist[:, blank[0]] - hist[:, blank[1]]

    numbers: dict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    common = {word.encode(): i for i, word in enumerate(WORDS)}
    split = [text.split() for text in texts]
    n_words = np.fromiter(map(len, split), np.int64, n)
    ids = np.fromiter(map(numbers.__getitem__, chain.from_iterable(split)), np.int64,
                      int(n_words.sum()))
    kind = np.full(max(len(numbers), 1), len(WORDS), dtype=np.int64)
    for word, number in numbers.items():
        place = common.get(word.lower())
        if place is not None:
            kind[number] = place
    word_owner = np.repeat(np.arange(n, dtype=np.int64), n_words)
    m = len(WORDS) + 1
    word_hist = np.bincount(word_owner * m + kind[ids], minlength=n * m).reshape(n, m)
    return pa.RecordBatch.from_arrays([
        pa.array(n_words), pa.array(hist.sum(axis=1)), pa.array(word_chars),
        pa.array(hist[:, CLASSES.index("symbol")]),
        pa.array([dup_lines(text) for text in texts], pa.int64()),
        pa.array(repeat_words(ids, word_owner, n)),
        _lists(hist), _lists(word_hist)], schema=STATS)


def _lists(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(rows.astype(np.int64).ravel()))


def with_stats(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    """Columns ``keep`` and the counts of each whole ``text``, which may be among them."""
    ship(docs.sparkSession)
    sent = keep if text in keep else [*keep, text]

    def run(batches):
        forget()
        for batch in batches:
            raw = batch.column(sent.index(text)).cast(pa.binary()).fill_null(b"")
            sizes = pc.binary_length(raw).to_pylist()
            for start, end in by_length(sizes, STATS_BYTES):
                own = batch.slice(start, end - start)
                stats = text_stats(raw.slice(start, end - start).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    own.columns[:len(keep)] + stats.columns, names=[*keep, *STATS.names])

    return docs.select(*sent).mapInArrow(
        run, extended(docs.select(*keep), "n_words long, n_chars long, word_chars long, "
             "n_symbols long, n_dup_lines long, n_repeat_words long, class_counts array<long>, "
             "word_counts array<long>"))


def js_distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Row by row the square root of the Jensen-Shannon divergence in bits, 0 to 1.

    A row without counts, or with a reference of zeros, gives NaN.
    """
    with np.errstate(divide="ignore", invalid="ignore"):
        p = counts / counts.sum(axis=1, keepdims=True)
        q = reference / reference.sum(axis=-1, keepdims=True)
        middle = (p + q) / 2
        parts = [np.where(x > 0, x * np.log2(x / middle), 0.0).sum(axis=-1) for x in (p, q)]
        return np.sqrt(np.maximum((parts[0] + parts[1]) / 2, 0.0)) + 0 * (p[:, 0] + q[..., 0])


def base_failed(rules: Rules) -> Column:
    return (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))


def by_key(frame: DataFrame) -> DataFrame:
    """The rows under the key of all documents, and under that of their language if they have one."""
    return frame.withColumn("key", F.explode(F.array_compact(F.array(
        F.lit("all"), F.concat(F.lit("l"), "lang"))))).drop("lang")


def references(stats: DataFrame, rules: Rules) -> DataFrame:
    """(key, class_reference, word_reference) of each language and of all; lists of shares."""
    first = (stats.where(~base_failed(rules)).groupBy("lang", "digest").agg(
        F.min("source").alias("source"),
        *[F.first(c).alias(c) for c in ("n_chars", "n_words", "class_counts", "word_counts")]))
    voices = staged(first.select("lang", "source", F.inline(F.array(*[F.struct(
        F.lit(part).alias("part"), F.col(total).alias("total"), F.lit(least).alias("least"),
        F.col(counts).alias("counts")) for part, total, counts, least in _parts(rules)])))
        .where(F.col("total") >= F.col("least")).drop("least"), "voices")
    sizes = by_key(voices.groupBy("lang", "source", "part").agg(F.count("*").alias("n"))).groupBy(
        "key", "source", "part").agg(F.sum("n").alias("size"))
    # Shares of zero are left to the remainder of the voices.
    share = F.col("count") / F.col("total")
    steps = (
        voices.select("lang", "source", "part", "total", F.posexplode("counts").alias("i", "count"))
        .where(F.col("count") > 0)
        .groupBy("lang", "source", "part", "i", F.floor(share * STEPS).alias("step"))
        .agg(F.count("*").alias("n"), F.sum(share).alias("sum")))
    weighed = by_key(steps).join(sizes, ["key", "source", "part"]).groupBy(
        "key", "part", "i", "step").agg(F.sum(F.col("n") / F.col("size")).alias("weight"),
                                        F.sum(F.col("sum") / F.col("size")).alias("sum"))
    # At most STEPS + 1 rows of an entry.
    entry = Window.partitionBy("key", "part", "i")
    placed = (
        weighed.join(sizes.groupBy("key", "part").agg(F.count("*").alias("voices")), ["key", "part"])
        .withColumn("end", F.col("voices") - F.sum("weight").over(entry) + F.sum("weight").over(
            entry.orderBy("step"))))
    taken = F.greatest(F.lit(0.0), F.least("end", (1 - TRIM) * F.col("voices")) - F.greatest(
        F.col("end") - F.col("weight"), TRIM * F.col("voices")))
    middle = placed.groupBy("key", "part", "i").agg(F.sum(
        taken * F.col("sum") / F.col("weight")).alias("share"))
    return middle.groupBy("key").agg(*[F.map_from_entries(F.collect_list(F.when(
        F.col("part") == part, F.struct("i", "share")))).alias(part)
        for part, *_ in _parts(rules)]).select("key", *[
            F.array(*[F.coalesce(F.col(part)[i], F.lit(0.0)) for i in range(size)])
            .alias(f"{part}_reference")
            for part, size in (("class", len(CLASSES)), ("word", len(WORDS) + 1))])


def _parts(rules: Rules) -> list[tuple[str, str, str, int]]:
    """Of each histogram its name, the columns of its total and counts, and the least total."""
    return [("class", "n_chars", "class_counts", rules.min_class_chars),
            ("word", "n_words", "word_counts", rules.min_histogram_words)]


def judged(docs: DataFrame, keep: list[str], rules: Rules = Rules()) -> DataFrame:
    """Columns ``keep`` as ``k0``, ``k1`` and so on, the base counts, both distances and the
    verdict; so named, no column of the documents clashes with a result."""
    named = docs.withColumn("lang", F.col("lang").cast("string")) if "lang" in docs.columns \
        else docs.withColumn("lang", F.lit(None).cast("string"))
    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None)
    stats = staged(with_stats(named.select(
        *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], "lang",
        *([] if "text" in keep else ["text"]), F.coalesce(source, F.lit(NO_SITE)).alias("source"),
        text_key(F.coalesce("text", F.lit(""))).alias("digest")),
        [*[f"k{i}" for i in range(len(keep))], "lang", "source", "digest"],
        f"k{keep.index('text')}" if "text" in keep else "text"), "stats")
    compared = _joined(stats, rules)
    failed = base_failed(rules)
    odd_class = (F.col("n_chars") >= rules.min_class_chars) & (
        F.col("class_distance") > _limit(
            rules.class_floor, rules.class_base, rules.class_slack, F.col("n_chars")))
    odd_words = (F.col("n_words") >= rules.min_histogram_words) & (
        F.col("word_distance") > _limit(
            rules.word_floor, rules.word_base, rules.word_slack, F.col("n_words")))
    return compared.select(
        *[f"k{i}" for i in range(len(keep))], "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", failed.alias("base_failed"),
        (~failed & ~F.coalesce(odd_class, F.lit(False)) & ~F.coalesce(odd_words, F.lit(False)))
        .alias("kept"), "class_distance", "word_distance")


def _limit(floor: float, base: float, slack: float, length: Column) -> Column:
    return F.greatest(F.lit(floor), F.lit(base) + F.lit(slack) / F.sqrt(length))


def _joined(stats: DataFrame, rules: Rules) -> DataFrame:
    side = stats.withColumn("key", F.coalesce(F.concat(F.lit("l"), "lang"), F.lit("all")))
    none = [F.array_repeat(F.lit(0.0), n) for n in (len(CLASSES), len(WORDS) + 1)]
    wide = side.join(references(stats, rules), "key", "left").select(
        *[c for c in stats.columns if not c.endswith("_counts")], "class_counts", "word_counts",
        F.coalesce("class_reference", none[0]).alias("class_reference"),
        F.coalesce("word_reference", none[1]).alias("word_reference"))
    kept = wide.drop("class_counts", "word_counts", "class_reference", "word_reference")

    def run(batches):
        for batch in batches:
            counts = [np.asarray(c.flatten()).reshape(batch.num_rows, -1) if batch.num_rows else
                      np.zeros((0, 1)) for c in batch.columns[-4:]]
            found = [js_distance(counts[i], counts[i + 2]) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-4] + [pa.array(d, pa.float64(), from_pandas=True) for d in found],
                names=batch.schema.names[:-4] + ["class_distance", "word_distance"])

    return wide.mapInArrow(
        run, extended(kept, "class_distance double, word_distance double"))


def quality_report(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per document row: ``doc_id``, counts, distances and the verdict."""
    return judged(docs, ["doc_id"], rules).withColumnRenamed("k0", "doc_id")


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents whose verdict is kept, with all their columns.

    The verdict is computed beside the row and not joined back, so that repeated ids and
    null ids keep their own verdict.
    """
    return judged(docs, docs.columns, rules).where("kept").select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(docs.columns)])
