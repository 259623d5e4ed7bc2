"""Line dedup by the number of sites a line is found on.

Every line of at least ``min_words`` words is known by a 128-bit hash. A HyperLogLog sketch
of sites per line tells its spread; a line whose estimate lies near the threshold gets an
exact count of its sites. Lines on ``min_sites`` sites or more are candidates.

Copies of one document on many sites make each of its lines a candidate, though it stands in
one context only. So the sites of a candidate are counted once more, over the rows in which
candidates are at most ``max_common`` percent of the text, that is, beside text of their own. Candidates
on ``min_sites`` such sites are boilerplate and are removed from every text, also from those
that hold little else. A line that only copies share stays for the near-duplicate stage.

Defined results: null or empty text has one empty line and loses nothing; documents without
a source share one unnamed site; repeated rows each get their result; equal texts lose the
same lines; a text exactly at ``max_common`` counts; an empty table gives an empty table. A
text is held whole with its lines in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tallymark.llm.common import out_of_the_way, staged

BLANK = r"\x20\x09-\x0D"
NO_SITE = "\x00"


@dataclass(frozen=True)
class LineRules:
    min_sites: int = 10
    min_words: int = 3
    sketch_bits: int = 10
    near: float = 0.3  # estimates within this share of the threshold are counted exactly
    max_common: int = 60  # percent of candidates in a text that tells of sites, by characters


def eligible(line: Column, min_words: int) -> Column:
    word, gap = f"[^{BLANK}]+", f"[{BLANK}]+"
    return line.rlike(f"(?:{word}{gap}){{{min_words - 1}}}[^{BLANK}]")


def line_key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(line, F.lit(1)).alias("h2"))


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def lines_of(docs: DataFrame, rules: LineRules) -> DataFrame:
    """(row, text key, characters of the text, site, line hash, characters) per line."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),  # drawn once, as the lines are stored
        text_key(text).alias("key"),
        F.length(text).alias("size"),
        F.coalesce(F.col("source").cast("string"), F.lit(NO_SITE)).alias("site"),
        text.alias("text"))
    # A select of its own: beside a generator, columns are worked out for every line.
    return rows.select(
        "row", "key", "size", "site", F.explode(F.split("text", "\n")).alias("line"),
    ).where(eligible(F.col("line"), rules.min_words)).select(
        "row", "key", "size", "site", line_key(F.col("line")).alias("h"),
        F.length("line").alias("chars")).select("row", "key", "size", "site", "h.h1", "h.h2", "chars")


def spread(lines: DataFrame, rules: LineRules) -> DataFrame:
    """(h1, h2) of every line on at least ``min_sites`` sites.

    A line seen fewer times than that cannot be on as many sites; it needs no sketch.
    """
    often = lines.groupBy("h1", "h2").count().where(F.col("count") >= rules.min_sites)
    seen = lines.join(often, ["h1", "h2"], "left_semi")
    estimates = staged(
        seen.groupBy("h1", "h2").agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(rules.sketch_bits))).alias("sites")),
        "estimates")
    low, high = rules.min_sites * (1 - rules.near), rules.min_sites * (1 + rules.near)
    near = estimates.where(F.col("sites").between(low, high))
    exact = (seen.join(near, ["h1", "h2"], "left_semi").select("h1", "h2", "site").distinct()
             .groupBy("h1", "h2").count().where(F.col("count") >= rules.min_sites))
    return (estimates.where(F.col("sites") > high).select("h1", "h2")
            .unionByName(exact.select("h1", "h2")))


def beside_own_text(places: DataFrame, rules: LineRules) -> DataFrame:
    """Of the places of candidates, those in rows that have enough text of their own."""
    rows = places.groupBy("row").agg(
        F.sum("chars").alias("common"), F.first("size").alias("size"))
    own = rows.where(100 * F.col("common") <= rules.max_common * F.col("size").cast("long")).select("row")
    return places.join(own, "row", "left_semi")


def cleaned(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """All rows and columns with boilerplate lines taken out of ``text``.

    Adds ``__lines`` and ``__removed``, the number of lines and of removed ones.
    """
    lines = staged(lines_of(docs, rules), "lines")
    places = staged(lines.join(spread(lines, rules), ["h1", "h2"]), "candidates")
    common = spread(beside_own_text(places, rules), rules)
    # At most one entry per line of the text.
    found = (places.join(common, ["h1", "h2"]).groupBy("key")
             .agg(F.collect_set(F.struct("h1", "h2")).alias("__found")))
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = F.split(text, "\n")

    def stays(line):
        return ~(F.array_contains(F.col("__found"), line_key(line))
                 & eligible(line, rules.min_words))

    kept = F.filter(parts, stays)
    tried = F.when(F.col("__found").isNotNull(), F.struct(
        F.array_join(kept, "\n").alias("text"), (F.size(parts) - F.size(kept)).alias("n")))
    keyed = docs.withColumn("__key", text_key(text))
    joined = keyed.join(found.withColumnRenamed("key", "__key"), "__key", "left").withColumn(
        "__tried", tried)
    taken = F.col("__tried").isNotNull()
    return joined.select(
        *[F.when(taken, F.col("__tried.text")).otherwise(F.col("text")).alias(c)
          if c == "text" else F.col(c) for c in docs.columns],
        F.size(parts).cast("long").alias("__lines"),
        F.when(taken, F.col("__tried.n")).otherwise(0).cast("long").alias("__removed"))


def line_report(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """Per document row: number of lines, of removed lines, digest of what stays."""
    return cleaned(docs.select("doc_id", "text", "source"), rules).select(
        "doc_id", F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"),
        F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("kept_sha256"))


def without_boilerplate(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The documents with their columns, boilerplate lines taken out.

    Where lines went, a column ``n_chars`` tells the new length. Other columns may have any name.
    """
    docs, back = out_of_the_way(docs)
    done = cleaned(docs, rules)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        done = done.withColumn("n_chars", F.when(
            F.col("__removed") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return done.select(*docs.columns).withColumnsRenamed(back)


def oracle(rules: LineRules = LineRules()) -> str:
    word, gap = f"[^{BLANK}]+", f"[{BLANK}]+"
    enough = f"regexp_matches(line, '(?:{word}{gap}){{{rules.min_words - 1}}}[^{BLANK}]')"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         coalesce(source, chr(1)) AS site FROM documents),
l AS (
  SELECT rid, site, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos FROM d),
often AS (
  SELECT line FROM l WHERE {enough} GROUP BY line
  HAVING count(DISTINCT site) >= {rules.min_sites}),
crowded AS (
  SELECT rid FROM l JOIN often USING (line) JOIN d USING (rid) GROUP BY rid
  HAVING 100 * sum(length(line)) > {rules.max_common} * any_value(length(text))),
common AS (
  SELECT line FROM often JOIN l USING (line) ANTI JOIN crowded USING (rid) GROUP BY line
  HAVING count(DISTINCT site) >= {rules.min_sites}),
per AS (
  SELECT rid, count(*) AS n_lines, count(common.line) AS n_removed,
         coalesce(string_agg(l.line, chr(10) ORDER BY pos) FILTER (common.line IS NULL), '')
         AS kept
  FROM l LEFT JOIN common USING (line) GROUP BY rid)
SELECT doc_id, n_lines, n_removed, sha256(kept) AS kept_sha256 FROM per JOIN d USING (rid)
"""
