"""License scans: phrases, notices, and an exact set-similarity join with license texts.

A template is the set of words of a license text. A text block is a window of one and a half
times as many words as the license has; windows follow each other so closely that a license of
its usual length lies whole in one of them, however its lines are broken. A block meets the
template when it holds at least ``THRESHOLD`` of the template's words. A whole text that holds
fewer has no such block and is not cut into windows. Words are ordered by how many blocks hold
them, rarest first. A block that meets a template must hold one of the template's first
``size - need + 1`` words (prefix filter), must hold ``need`` known words in all, its window being
no longer than stated (length filter), and after its first common word both sides must have
enough words left (positional filter). What passes is verified, so every block that meets a
template is found. Notices of a few words say too little as sets: they must stand in order.

All of it is built from column functions. Defined results: null or empty text has no words,
no places and no labels, and score 0; repeated rows each get their result; equal containments
give one score; an empty table gives an empty table; columns other than ``doc_id`` and ``text``
are not looked at. One text with its words is held by one task.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, functions as F

from tallymark.llm.common import lower_ascii, staged
from tallymark.llm.lines import text_key

# Separators of words, phrases with their labels.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
THRESHOLD = 0.8
# Short notices (any of the forms, word for word) and texts of public licenses.
NOTICES = {
    "mit-notice": ("released under the mit license", "licensed under the mit license"),
    "apache-2.0-notice": ("licensed under the apache license version 2 0",
                          "licensed under the apache license v 2 0"),
    "gpl-3.0-notice": ("licensed under the gnu general public license version 3",
                       "licensed under the gnu general public license v3"),
    "mpl-2.0-notice": ("subject to the terms of the mozilla public license v 2 0",),
    "cc-by-nc-4.0-notice": ("licensed under cc by nc 4 0",),
}
TEMPLATES = {
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of
        this software and associated documentation files""",
    "mit-full": """Permission is hereby granted, free of charge, to any person obtaining a copy of
        this software and associated documentation files (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons
        to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial
        portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
        EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS
        FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
        CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE
        USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "apache-text": """you may not use this file except in compliance with the License""",
    "apache-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not
        use this file except in compliance with the License. You may obtain a copy of the License
        at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed
        to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License
        for the specific language governing permissions and limitations under the License.""",
    "gpl-text": """This program is free software: you can redistribute it and/or modify it under the
        terms of the GNU General Public License as published by the Free Software Foundation""",
    "gpl-header": """This program is free software: you can redistribute it and/or modify it under
        the terms of the GNU General Public License as published by the Free Software Foundation,
        either version 3 of the License, or (at your option) any later version. This program is
        distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        General Public License for more details.""",
    "bsd-text": """Redistribution and use in source and binary forms, with or without modification,
        are permitted provided that the following conditions are met""",
    "bsd-2-full": """Redistribution and use in source and binary forms, with or without
        modification, are permitted provided that the following conditions are met:
        1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce
        the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution. THIS SOFTWARE IS
        PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
        FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
        CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
        CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
        SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON
        ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
        NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF
        ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "isc-full": """Permission to use, copy, modify, and/or distribute this software for any purpose
        with or without fee is hereby granted, provided that the above copyright notice and this
        permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR
        DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
        DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF
        USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
        ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "mpl-header": """This Source Code Form is subject to the terms of the Mozilla Public License,
        v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at
        https://mozilla.org/MPL/2.0/.""",
}


def words_of(text: str) -> list[str]:
    return [w for w in re.split(SEPARATORS, text.lower()) if w]


def need(size: int, threshold: float = THRESHOLD) -> int:
    return math.ceil(threshold * size - 1e-9)


def spaced(text: Column) -> Column:
    """The words with one space between them."""
    return F.trim(F.regexp_replace(lower_ascii(text), SEPARATORS, " "))


def n_spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def whole(phrase: str) -> str:
    return f"(?:(?<= )|^)(?:{phrase})(?= |$)"


def base_columns(words: Column) -> dict[str, Column]:
    """Counts and places of the phrases in a text of single-spaced words."""
    total = F.when(words == "", F.lit(0)).otherwise(n_spaces(words) + 1).cast("long")
    maybe = words.contains("license")
    counts = {p: F.when(words.contains(p), F.regexp_count(words, F.lit(whole(p)))).otherwise(0)
              for p in PHRASES}
    n_base = sum(counts.values(), F.lit(0)).cast("long")
    forward = whole("|".join(PHRASES))
    mirrored = F.reverse(words)
    backward = whole("|".join(p[::-1] for p in PHRASES))
    first = n_spaces(F.substring(words, F.lit(1), F.regexp_instr(words, F.lit(forward)) - 1))
    place = F.regexp_instr(mirrored, F.lit(backward))
    after = n_spaces(F.substring(mirrored, F.lit(1), place - 1))
    last = total - after - 1 - n_spaces(F.regexp_extract(mirrored, backward, 0))
    hit = maybe & (n_base > 0)
    return {
        "n_words": total,
        "n_base": n_base,
        "first_word": F.when(hit, first),
        "last_word": F.when(hit, last),
        "base": F.filter(F.array(*[F.when(counts[p] > 0, F.lit(PHRASES[p])) for p in PHRASES]),
                         lambda x: x.isNotNull()),
    }


def window(length: int) -> tuple[int, int]:
    """Words of a window and words from one to the next, for a template of ``length`` words."""
    width = length + length // 2
    return width, max(1, width - length)


def let(value: Column, then) -> Column:
    """``then(value)`` with the value worked out once, also where lambdas use it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def blocks(docs: DataFrame, templates: dict[str, str], threshold: float) -> DataFrame:
    """(key, template, start, tokens): windows that hold enough known words, with those."""
    own = {n: sorted(set(words_of(t))) for n, t in templates.items()}
    known = F.array(*[F.lit(w) for w in sorted(set().union(*own.values()))])
    plan = F.array(*[
        F.struct(F.lit(n).alias("name"), F.array(*map(F.lit, ws)).alias("words"),
                 F.lit(need(len(ws), threshold)).alias("least"),
                 *[F.lit(x).alias(c) for c, x in
                   zip(("width", "stride"), window(len(words_of(templates[n]))))])
        for n, ws in own.items()])
    fewest = min(need(len(ws), threshold) for ws in own.values())
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select(text_key(text).alias("key"), spaced(text).alias("words"))
    may_meet = let(F.array_intersect(F.split("words", " "), known), lambda tokens: F.when(
        F.size(tokens) >= fewest, F.filter(
            plan, lambda t: F.size(F.array_intersect(t["words"], tokens)) >= t["least"])))
    fits = texts.select("key", "words", F.explode(may_meet).alias("t"))

    def windows(words):
        starts = F.sequence(F.lit(0), F.size(words) - 1, F.col("t.stride"))
        return F.filter(
            F.transform(starts, lambda i: F.struct(i.alias("start"), F.array_intersect(
                F.slice(words, i + 1, F.col("t.width")), known).alias("tokens"))),
            lambda b: F.size(b["tokens"]) >= F.col("t.least"))

    return fits.select("key", F.col("t.name").alias("template"),
                       F.inline(let(F.split("words", " "), windows)))


def meeting(cut: DataFrame, templates: dict[str, str], threshold: float) -> DataFrame:
    """(key, template, containment) of every block that meets its template."""
    own = {n: sorted(set(words_of(t))) for n, t in templates.items()}
    counted = {r["token"]: r["n"] for r in cut.select(F.explode("tokens").alias("token"))
               .groupBy("token").agg(F.count("*").alias("n")).collect()}  # template words only
    rank = {w: i for i, w in enumerate(
        sorted(set().union(*own.values()), key=lambda w: (counted.get(w, 0), w)))}
    order = F.create_map(*[F.lit(x) for pair in rank.items() for x in pair])
    ranked = cut.select("key", "template", "start", F.sort_array(
        F.transform("tokens", lambda t: F.element_at(order, t))).alias("tokens"))
    entries = []
    for name, listed in own.items():
        sides = sorted(rank[w] for w in listed)
        least = need(len(sides), threshold)
        entries += [(sides[i], name, i, least, sides) for i in range(len(sides) - least + 1)]
    index = cut.sparkSession.createDataFrame(
        entries, "token int, template string, i int, least int, template_tokens array<int>")
    hits = (
        ranked.withColumn("size", F.size("tokens"))
        .select("key", "template", "start", "tokens", "size",
                F.posexplode("tokens").alias("j", "token"))
        .join(index, ["template", "token"])
        .where(F.col("size") >= F.col("least"))
        .groupBy("key", "template", "start").agg(
            F.min(F.struct("i", "j", "least", "size", "template_tokens", "tokens")).alias("h"))
        .select("key", "template", "h.*")
    )
    left = 1 + F.least(F.size("template_tokens") - F.col("i") - 1, F.col("size") - F.col("j") - 1)
    common = F.size(F.array_intersect("tokens", "template_tokens"))
    return (hits.where(left >= F.col("least")).withColumn("common", common)
            .where(F.col("common") >= F.col("least"))
            .select("key", "template",
                    (F.col("common") / F.size("template_tokens")).alias("containment")))


def noticed(words: Column, notices: dict[str, tuple[str, ...]]) -> Column:
    """Labels of the notices that stand in a text of single-spaced words."""
    framed = F.concat(F.lit(" "), words, F.lit(" "))

    def stands(form):
        return framed.contains(f" {form} ")

    labels = []
    for label, forms in notices.items():
        any_form = stands(forms[0])
        for form in forms[1:]:
            any_form = any_form | stands(form)
        labels.append(F.when(any_form, F.lit(label)))
    return F.when(words.contains("licensed") | words.contains("license"), F.array_compact(
        F.array(*labels))).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, templates: dict[str, str] | None = None,
         threshold: float = THRESHOLD,
         notices: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Per document row the phrase counts and places, all labels and the best containment."""
    templates = TEMPLATES if templates is None else templates
    notices = NOTICES if notices is None else notices
    text = F.coalesce(F.col("text"), F.lit(""))
    with_words = docs.select("doc_id", text_key(text).alias("key"), spaced(text).alias("words"))
    base = with_words.select("doc_id", "key", *[
        c.alias(n) for n, c in base_columns(F.col("words")).items()],
        noticed(F.col("words"), notices).alias("noticed"))
    cut = staged(blocks(docs, templates, threshold), "license-blocks")
    per_text = meeting(cut, templates, threshold).groupBy("key").agg(
        F.collect_set("template").alias("found"), F.max("containment").alias("best"))
    joined = base.join(per_text, "key", "left")
    labels = F.array_union(F.array_union(F.col("base"), F.col("noticed")), F.coalesce(
        F.col("found"), F.array().cast("array<string>")))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.when((F.col("n_base") > 0) | (F.size("noticed") > 0), 1.0)
        .otherwise(F.coalesce(F.col("best"), F.lit(0.0))).alias("score"))


def oracle(templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> str:
    """The same by counting, for every template and window, the template's words inside.

    Places of words are joined to templates and dealt to the windows that cover them.
    """
    templates = TEMPLATES if templates is None else templates
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = ("list_filter(string_split_regex(" + low
             + ", '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')")
    rows = []
    for name, text in templates.items():
        own = sorted(set(words_of(text)))
        listed = ", ".join(f"'{w}'" for w in own)
        width, stride = window(len(words_of(text)))
        rows.append(f"('{name}', [{listed}], {need(len(own), threshold)}, {len(own)}, "
                    f"{width}, {stride})")
    forms = ", ".join(f"('{n}', ' {form} ')" for n, fs in NOTICES.items() for form in fs)
    starts = []
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        same = " AND ".join(f"w[i + {k}] = '{p}'" if k else f"w[i] = '{p}'"
                            for k, p in enumerate(parts))
        starts.append(f"SELECT rid, i - 1 AS place, '{label}' AS label FROM spots WHERE {same}")
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
t AS (SELECT rid, doc_id, {words.format('text')} AS w FROM d),
spots AS (SELECT rid, w, unnest(list_filter(range(1, len(w) + 1), lambda i:
         w[i] IN ('mit', 'apache', 'general'))) AS i FROM t),
places AS ({' UNION ALL '.join(starts)}),
base AS (SELECT rid, count(*) AS n, min(place) AS lo, max(place) AS hi,
                list(DISTINCT label) AS labels FROM places GROUP BY rid),
templates(name, words, least, size, width, stride) AS (VALUES {', '.join(rows)}),
parts AS (SELECT name, least, size, width, stride, unnest(words) AS word FROM templates),
p AS (SELECT rid, unnest(w) AS word, unnest(range(len(w))) AS pos FROM t),
hits AS (
  SELECT rid, name, least, size, word,
         unnest(range(CAST(greatest(0, ceil((pos - width + 1) / stride)) AS BIGINT),
                      pos // stride + 1)) AS k
  FROM p JOIN parts USING (word)),
met AS (
  SELECT rid, name, count(DISTINCT word) / any_value(size) AS containment FROM hits
  GROUP BY rid, name, k HAVING count(DISTINCT word) >= any_value(least)),
notices(name, form) AS (VALUES {forms}),
said AS (SELECT DISTINCT rid, name FROM t, notices
         WHERE contains(' ' || array_to_string(w, ' ') || ' ', form)),
method AS (SELECT rid, list(DISTINCT name) AS labels, max(containment) AS best
           FROM (SELECT * FROM met UNION ALL SELECT rid, name, 1.0 FROM said) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base,
       CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word,
       array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(coalesce(base.labels, [])
                       || coalesce(method.labels, []))), ',') AS labels,
       CASE WHEN coalesce(n, 0) > 0 THEN 1.0 ELSE coalesce(best, 0.0) END AS score
FROM t LEFT JOIN base USING (rid) LEFT JOIN method USING (rid)
"""
