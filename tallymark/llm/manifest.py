"""A Merkle manifest of a table: one tree per language, one over their roots, a proof per row.

Leaves are numbered within their tree by a range sort and the sizes of the partitions before.
``SPAN`` consecutive leaves form a superblock. A superblock is reduced to one node, the nodes of
a tree form superblocks again, and so on; what every tree comes to is a leaf of the tree of
trees. Then the way down: at each level the nodes are cogrouped by superblock with the outer
nodes that their superblock's own proof needs, and one function finishes the local reduction,
joins the proofs and, for leaves, folds them. No task holds more than a superblock and the
proof of one node, so neither a hot language nor a long table gathers anywhere.

Defined results: a null field is written ``-``; a null language is a tree of its own, before the
others; a null id comes before all others of its tree; rows with one id stand in the order of
their leaf digest, equal rows anyhow, each with its own place and proof. Very long texts are
digested where they lie and go nowhere. An empty table gives an empty result, without a root.
Other columns of the table are ignored and cannot clash.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallymark.llm.common import ship, staged

#: Leaves of a superblock; a power of two.
SPAN_BITS = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
OUTER = "siblings string, sides string, subroot string, root string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def written(value: Column) -> Column:
    """A field as its byte count and value, null as a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame, current: dict[str, Column] | None = None,
           changed: Column | None = None) -> DataFrame:
    """Tree, id and leaf of every row; ``now`` is the leaf with ``current`` where ``changed``."""
    def leaf(values: dict[str, Column]) -> Column:
        return F.sha2(F.concat(*[written(values.get(f, F.col(f))) for f in FIELDS]), 256)

    now = F.when(changed, leaf(current)) if current else F.lit(None).cast("string")
    return docs.select(
        # Null before all languages, these by their bytes.
        F.coalesce(F.concat(F.lit("1"), "lang"), F.lit("0")).alias("tree"),
        "doc_id", leaf({}).alias("node"), now.alias("now"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``pos`` of every row in its tree and ``total``, its tree's size; ``order`` sorts a tree."""
    keys = ["tree", *order]
    place = F.monotonically_increasing_id()
    dealt = staged(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("part", F.spark_partition_id())
        .withColumn("place", place), "numbered")
    sizes = dealt.groupBy("tree", "part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    # One row per partition and tree in it.
    by_part = Window.partitionBy("tree").orderBy("part")
    sizes = sizes.select(
        "tree", "part", "first", F.sum("n").over(Window.partitionBy("tree")).alias("total"),
        (F.sum("n").over(by_part.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
        .alias("before"))
    return (
        dealt.join(sizes, ["tree", "part"])
        .withColumn("pos", F.col("place") - F.col("first") + F.col("before"))
        .drop("part", "place", "first", "before"))


def climb(nodes: list[str], steps: int | None) -> list[list[str]]:
    """All levels of a run of nodes: ``steps`` of them above it, or up to a single node."""
    levels = [nodes]
    while len(levels) <= steps if steps is not None else len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest("".join(last[i:i + 2])) for i in range(0, len(last), 2)])
    return levels


def siblings(levels: list[list[str]], i: int) -> tuple[str, str]:
    """Sibling digests of node ``i`` level by level, and on which side each stands."""
    found, sides = [], []
    for level in levels[:-1]:
        other = i ^ 1
        if other < len(level):
            found.append(level[other])
            sides.append("l" if other < i else "r")
        else:
            sides.append("-")
        i >>= 1
    return "".join(found), "".join(sides)


def fold(node: str, proof: str, sides: str) -> str:
    """What a node and its siblings come to."""
    at = 0
    for side in sides:
        if side == "-":
            node = digest(node)
            continue
        other = proof[at:at + 64]
        at += 64
        node = digest(other + node if side == "l" else node + other)
    return node


def _steps(total: int, bits: int) -> int | None:
    return bits if total > 1 << bits else None


def parents(nodes: DataFrame, bits: int) -> DataFrame:
    """One node for each superblock."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = int(rows["total"].iloc[0])
        top = climb(rows.sort_values("pos")["node"].tolist(), _steps(total, bits))[-1]
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "node": top,
                             "total": [-(-total >> bits)]})

    blocks = nodes.select("tree", "pos", "node", "total",
                          F.shiftright("pos", bits).alias("block"))
    return blocks.groupBy("tree", "block").applyInPandas(
        run, "tree string, pos long, node string, total long")


def upward(nodes: DataFrame, bits: int) -> list[DataFrame]:
    """Levels of superblocks above ``nodes``, the last with one node per tree."""
    largest = nodes.agg(F.max("total")).first()[0] or 1
    levels = [nodes]
    while len(levels) == 1 or largest > 1:
        levels.append(staged(parents(levels[-1], bits), "parents"))
        largest = -(-largest >> bits)
    return levels


def exchanged(nodes: DataFrame, outer: DataFrame, bits: int, finish, schema: str) -> DataFrame:
    """Nodes cogrouped with the outer nodes of their superblock, given to ``finish``."""
    blocks = nodes.withColumn("block", F.shiftright("pos", bits))
    return blocks.groupBy("tree", "block").cogroup(
        outer.withColumnRenamed("pos", "block").groupBy("tree", "block")
    ).applyInPandas(finish, schema)


def inner(bits: int):
    """Every node's place and the outer nodes that its own proof needs."""
    def run(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        levels = climb(rows["node"].tolist(), _steps(int(rows["total"].iloc[0]), bits))
        own = [siblings(levels, i) for i in range(len(rows))]
        up = outer.iloc[0]
        return pd.DataFrame({
            "tree": rows["tree"], "pos": rows["pos"], "node": rows["node"],
            "siblings": [s + up["siblings"] for s, _ in own],
            "sides": [s + up["sides"] for _, s in own],
            "subroot": up["subroot"], "root": up["root"]})
    return run


def last(bits: int):
    """Proof of every leaf, and the root that the leaf as it is now folds to."""
    def run(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        levels = climb(rows["node"].tolist(), _steps(int(rows["total"].iloc[0]), bits))
        up = outer.iloc[0]
        above: dict[str, str] = {}
        proofs, roots = [], []
        for i, (node, now) in enumerate(zip(rows["node"], rows["now"])):
            found, sides = siblings(levels, i)
            proofs.append(digest(found + up["siblings"]))
            top = fold(now if isinstance(now, str) else node, found, sides)
            if top not in above:
                above[top] = fold(top, up["siblings"], up["sides"])
            roots.append(above[top])
        return pd.DataFrame({
            "doc_id": rows["doc_id"], "leaf": rows["node"], "subroot": up["subroot"],
            "root": up["root"], "proof_sha256": proofs, "folded_root": roots})
    return run


def manifest(docs: DataFrame, current: dict[str, Column] | None = None,
             changed: Column | None = None, span_bits: int = SPAN_BITS) -> DataFrame:
    """Leaf, roots, proof digest and verdict of every row.

    The manifest is that of ``docs``. A row for which ``changed`` holds is verified as it is
    now, with the fields in ``current``; any other as it was.
    """
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = staged(leaves(docs, current, changed), "leaves").withColumn(
        "row", F.monotonically_increasing_id())
    trees = upward(numbered(rows, ["doc_id", "node", "row"]), span_bits)
    subroots = trees[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node")
    # The tree of trees: one leaf per language.
    over = upward(numbered(subroots, ["name"]), span_bits)
    path = over[-1].select(
        "tree", "pos", "node", F.lit("").alias("siblings"), F.lit("").alias("sides"),
        F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"))
    schema = f"tree string, pos long, node string, {OUTER}"
    for level in reversed(over[:-1]):
        path = exchanged(level.select("tree", "pos", "node", "total"), path.drop("node"),
                         span_bits, inner(span_bits), schema)
    path = path.join(over[0].select("pos", "name"), "pos").select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"), "siblings", "sides",
        F.col("node").alias("subroot"), "root")
    for level in reversed(trees[1:-1]):
        path = exchanged(level, path, span_bits, inner(span_bits), schema).drop("node")
    return exchanged(
        trees[0].drop("row"), path, span_bits, last(span_bits),
        f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string",
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle() -> str:
    """The same trees level by level in recursive SQL; the check value is worked out by bits."""
    def one(name: str) -> str:
        return f"coalesce(octet_length(encode({name}::VARCHAR)) || ':' || {name}::VARCHAR, '-')"

    def leaf(chars: str) -> str:
        return "sha256(" + " || ".join(
            chars if f == "n_chars" else one(f) for f in FIELDS) + ")"

    # Eight steps per character, the lowest bit first.
    crc = """xor(4294967295::BIGINT, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(
            range(8 * length(doc_id::VARCHAR)),
            lambda i: ((ascii(substr(doc_id::VARCHAR, i // 8 + 1, 1)) >> (i % 8)::INTEGER) & 1)
                      ::BIGINT)),
        lambda c, b: CASE WHEN xor(c, b) & 1 = 1 THEN xor(xor(c, b) >> 1, 3988292384::BIGINT)
                          ELSE xor(c, b) >> 1 END))"""
    proof = """SELECT p.n, string_agg(s.node, '' ORDER BY s.level) AS proof
               FROM {leaf} p JOIN {tree} s ON s.tree = p.tree
               AND s.pos = xor(p.pos >> s.level::INTEGER, 1) GROUP BY p.n"""

    def tree(name: str, source: str) -> str:
        return f"""{name} AS (
            SELECT 0 AS level, tree, pos, node, count(*) OVER (PARTITION BY tree) AS width
            FROM {source}
            UNION ALL
            SELECT level + 1, tree, pos // 2, sha256(string_agg(node, '' ORDER BY pos)),
                   (any_value(width) + 1) // 2
            FROM {name} WHERE width > 1 GROUP BY level, tree, pos // 2)"""

    return f"""
    WITH RECURSIVE rows AS (
        SELECT doc_id, coalesce('1' || lang, '0') AS tree, {leaf(one("n_chars"))} AS node,
               CASE WHEN {crc} % 7 = 0 THEN {leaf(one("(n_chars + 1)"))} END AS now
        FROM documents),
    leaf AS (SELECT *, row_number() OVER () AS n, row_number() OVER (
             PARTITION BY tree ORDER BY doc_id NULLS FIRST, node) - 1 AS pos FROM rows),
    {tree("low", "leaf")},
    subroot AS (SELECT tree AS name, '' AS tree, node,
                row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, tree AS n
                FROM low WHERE width = 1),
    {tree("high", "subroot")},
    low_proof AS ({proof.format(leaf="leaf", tree="low")}),
    high_proof AS ({proof.format(leaf="subroot", tree="high")}),
    height AS (SELECT tree, max(level) AS h FROM low GROUP BY tree),
    top AS (SELECT node AS root, level AS h FROM high WHERE width = 1),
    place AS (SELECT l.n, l.tree, coalesce(l.now, l.node) AS node, l.pos, s.pos AS above, h.h
              FROM leaf l JOIN height h ON h.tree = l.tree JOIN subroot s ON s.name = l.tree),
    fold AS (
        SELECT n, tree, node, pos, above, h, 0 AS level, false AS up FROM place
        UNION ALL
        SELECT f.n, f.tree, sha256(CASE WHEN s.node IS NULL THEN f.node
                                   WHEN f.pos % 2 = 1 THEN s.node || f.node
                                   ELSE f.node || s.node END),
               f.pos // 2, f.above, f.h, f.level + 1, false
        FROM fold f LEFT JOIN low s ON s.tree = f.tree AND s.level = f.level
             AND s.pos = xor(f.pos, 1)
        WHERE f.level < f.h),
    lift AS (
        SELECT n, node, above AS pos, 0 AS level FROM fold WHERE level = h
        UNION ALL
        SELECT f.n, sha256(CASE WHEN s.node IS NULL THEN f.node
                           WHEN f.pos % 2 = 1 THEN s.node || f.node ELSE f.node || s.node END),
               f.pos // 2, f.level + 1
        FROM lift f LEFT JOIN high s ON s.level = f.level AND s.pos = xor(f.pos, 1)
        WHERE f.level < (SELECT h FROM top))
    SELECT l.doc_id, l.node AS leaf, s.node AS subroot, t.root,
           sha256(coalesce(a.proof, '') || coalesce(b.proof, '')) AS proof_sha256,
           f.node AS folded_root, f.node = t.root AS verified
    FROM leaf l JOIN subroot s ON s.name = l.tree CROSS JOIN top t
    JOIN lift f ON f.n = l.n AND f.level = t.h
    LEFT JOIN low_proof a ON a.n = l.n LEFT JOIN high_proof b ON b.n = l.tree"""
