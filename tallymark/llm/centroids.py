"""Centroid clustering of integer vectors, with bounds that tighten by plane geometry.

Every vector carries an upper bound of the distance to its own centroid and a lower bound of the
distance to every other one. When centroids move, the lower bounds of a cluster are loosened not
by the largest move but by what the move can take away from any point of the cluster's sphere:
seen from the midpoint of a move, points under an angle t to it lose at most ``move * cos(t)``
(the hyperbola through such a point, with both places of the centroid as foci, lies inside the
cone of its asymptotes). Only vectors whose bounds then overlap are scanned, in integers.

Spark holds the vectors; what the driver and the tasks exchange are the centroids, sums, counts
and radii of ``clusters`` clusters, whose number is a parameter.

Defined results: vectors of another length, null vectors and vectors with a null, NaN or infinite
component are left out; an empty table gives an empty result; repeated rows each have a result;
with fewer vectors than clusters each vector starts one. Equal distances go to the smaller
number. Start centroids with equal hashes (repeated ids) are taken in the order of their
components; a null id hashes as an empty one. Components are limited to +-2^27 after scaling, so
that every squared distance fits a long. Other columns of the table are ignored; a row is one
vector, so very long rows do not occur.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallymark.llm.common import ship, staged

FARTHEST = 1 << 27
#: Bounds are floating numbers; they decide only where they differ by more than this share.
SLACK = 1e-9
STATE = "vec_id {id}, parts array<int>, cluster int, upper double, lower double, scans int"


@dataclass(frozen=True)
class Plan:
    """How many clusters, rounds and components; components are floor(scale * x)."""

    clusters: int = 16
    rounds: int = 3
    dims: int = 64
    scale: int = 64
    seed: str = "1"


def whole_vectors(table: DataFrame, plan: Plan) -> DataFrame:
    """Id and integer components of every usable vector."""
    vector = F.col("embedding").cast("array<double>")

    def unusable(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    def part(x: Column) -> Column:
        scaled = F.least(F.greatest(x * plan.scale, F.lit(float(-FARTHEST))),
                         F.lit(float(FARTHEST)))
        return F.floor(scaled).cast("int")

    usable = F.coalesce((F.size(vector) == plan.dims) & ~F.exists(vector, unusable), F.lit(False))
    return table.filter(usable).select("vec_id", F.transform(vector, part).alias("parts"))


def first_centroids(vectors: DataFrame, plan: Plan) -> np.ndarray:
    name = F.concat(F.lit(f"{plan.seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = vectors.orderBy(F.sha2(name, 256), "parts").limit(plan.clusters).collect()
    return np.array([r["parts"] for r in rows], np.int64).reshape(len(rows), plan.dims)


def squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, one row per vector and one column per centroid."""
    out = np.empty((len(vectors), len(centroids)), np.int64)
    for j, centroid in enumerate(centroids):
        gap = vectors - centroid
        out[:, j] = np.einsum("ij,ij->i", gap, gap)
    return out


def nearest(vectors: np.ndarray, centroids: np.ndarray):
    """Nearest centroid (ties: smaller number), its distance and that of the second nearest."""
    found = squared(vectors, centroids)
    own = found.argmin(axis=1)
    rows = np.arange(len(vectors))
    best = np.sqrt(found[rows, own].astype(float))
    if len(centroids) == 1:
        return own, best, np.full(len(vectors), np.inf)
    others = found.copy()
    others[rows, own] = np.iinfo(np.int64).max
    return own, best, np.sqrt(others.min(axis=1).astype(float))


def loosening(old: np.ndarray, new: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """For each cluster, how much nearer any other centroid can have come to one of its points.

    ``radii`` bound the distance of a cluster's points from its old centroid. In the plane of the
    move and the sphere's centre, the sphere spans an angle as seen from the midpoint of the
    move; its edge next to the direction of the move loses most.
    """
    old, new = old.astype(float), new.astype(float)
    move = np.sqrt(((new - old) ** 2).sum(axis=1))
    loss = np.zeros((len(old), len(old)))
    for j in np.flatnonzero(move):
        middle = (old[j] + new[j]) / 2
        gap = old - middle
        away = np.sqrt((gap ** 2).sum(axis=1))
        inside = away <= radii * (1 + SLACK)
        far = np.where(inside, 1.0, away)
        along = gap @ (new[j] - old[j]) / move[j]
        angle = np.arccos(np.clip(along / far, -1, 1))
        spread = np.arcsin(np.clip(radii / far, 0, 1))
        nearest_angle = np.maximum(angle - spread, 0.0)
        loss[:, j] = np.where(inside, move[j], move[j] * np.maximum(np.cos(nearest_angle), 0.0))
    np.fill_diagonal(loss, 0.0)
    return loss.max(axis=1, initial=0.0)


def _parts(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _state(ids: pa.Array, parts: pa.Array, cluster, upper, lower, scans) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids, parts, pa.array(cluster, pa.int32()), pa.array(upper, pa.float64()),
         pa.array(lower, pa.float64()), pa.array(scans, pa.int32())],
        names=["vec_id", "parts", "cluster", "upper", "lower", "scans"])


def scan_all(centroids: np.ndarray, dims: int):
    """Every vector against every centroid, as at the start."""
    def run(batches):
        for batch in batches:
            own, upper, lower = nearest(_parts(batch.column("parts"), dims), centroids)
            yield _state(batch.column("vec_id"), batch.column("parts"), own, upper, lower,
                         np.ones(len(own)))
    return run


def advance(old: np.ndarray, new: np.ndarray, radii: np.ndarray, dims: int):
    """Bounds after a move of the centroids; only what they leave open is scanned."""
    loss = loosening(old, new, radii)
    own_move = np.sqrt(((new - old).astype(float) ** 2).sum(axis=1))

    def run(batches):
        for batch in batches:
            cluster = batch.column("cluster").to_numpy(zero_copy_only=False).astype(np.int64)
            upper = batch.column("upper").to_numpy() + own_move[cluster]
            lower = batch.column("lower").to_numpy() - loss[cluster]
            scans = batch.column("scans").to_numpy(zero_copy_only=False).astype(np.int64)
            open_ = np.flatnonzero(upper * (1 + SLACK) >= lower * (1 - SLACK))
            if len(open_):
                parts = _parts(batch.column("parts").take(pa.array(open_)), dims)
                gap = parts - new[cluster[open_]]
                upper[open_] = np.sqrt(np.einsum("ij,ij->i", gap, gap).astype(float))
                still = upper[open_] * (1 + SLACK) >= lower[open_] * (1 - SLACK)
                open_, parts = open_[still], parts[still]
            if len(open_):
                cluster[open_], upper[open_], lower[open_] = nearest(parts, new)
                scans[open_] += 1
            yield _state(batch.column("vec_id"), batch.column("parts"), cluster, upper, lower,
                         scans)
    return run


def summary(state: DataFrame, k: int, dims: int):
    """Count, radius and exact component sums of every cluster."""
    def run(batches):
        count, radius = np.zeros(k, np.int64), np.zeros(k)
        sums = np.zeros((k, dims), np.int64)
        for batch in batches:
            cluster = batch.column("cluster").to_numpy(zero_copy_only=False)
            upper = batch.column("upper").to_numpy()
            parts = _parts(batch.column("parts"), dims)
            for j in np.unique(cluster):
                mine = cluster == j
                count[j] += mine.sum()
                radius[j] = max(radius[j], upper[mine].max())
                sums[j] += parts[mine].sum(axis=0)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(count[used]), pa.array(radius[used]),
             pa.array(sums[used].tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "radius", "sums"])

    parts = state.mapInArrow(run, "cluster int, n long, radius double, sums array<long>")
    rows = (
        parts.select("cluster", "n", "radius", F.posexplode("sums").alias("dim", "value"))
        .groupBy("cluster", "dim")
        .agg(F.sum("n").alias("n"), F.max("radius").alias("radius"),
             F.sum(F.col("value").cast("decimal(38,0)")).alias("total"))
        .collect())  # at most clusters * dims rows
    count, radius = [0] * k, np.zeros(k)
    sums = [[0] * dims for _ in range(k)]
    for r in rows:
        count[r["cluster"]], radius[r["cluster"]] = r["n"], r["radius"]
        sums[r["cluster"]][r["dim"]] = int(r["total"])
    return count, radius, sums


def moved(centroids: np.ndarray, count, sums) -> np.ndarray:
    """Componentwise floor of the mean; an empty cluster keeps its place."""
    return np.array([[s // n for s in row] if n else old.tolist()
                     for old, n, row in zip(centroids, count, sums)], np.int64)


def clustered(table: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """Cluster, distance, inertia and centroid digest of every vector.

    Besides, ``scans``: against all centroids the vector was held so often (first scan included).
    """
    spark = table.sparkSession
    ship(spark)
    kind = table.schema["vec_id"].dataType.simpleString()
    schema = STATE.format(id=kind)
    vectors = whole_vectors(table, plan)
    centroids = first_centroids(vectors, plan)
    k, dims = len(centroids), plan.dims
    if k == 0:
        return spark.createDataFrame(
            [], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, "
                "centroid_sha256 string, scans int")
    state = staged(vectors.mapInArrow(scan_all(centroids, dims), schema), "state")
    for _ in range(plan.rounds):
        count, radius, sums = summary(state, k, dims)
        new = moved(centroids, count, sums)
        state = staged(state.mapInArrow(advance(centroids, new, radius, dims), schema), "state")
        centroids = new

    def distances(batches):
        for batch in batches:
            cluster = batch.column("cluster").to_numpy(zero_copy_only=False)
            gap = _parts(batch.column("parts"), dims) - centroids[cluster]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("cluster"),
                 pa.array(np.einsum("ij,ij->i", gap, gap)), batch.column("scans")],
                names=["vec_id", "cluster", "distance", "scans"])

    found = staged(state.mapInArrow(
        distances, f"vec_id {kind}, cluster int, distance long, scans int"), "distances")
    totals = {r["cluster"]: int(r["total"]) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    about = spark.createDataFrame(
        [(j, totals.get(j, 0), sum(totals.values()), hashlib.sha256(
            ",".join(map(str, centroids[j].tolist())).encode()).hexdigest()) for j in range(k)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row per cluster: bounded by the plan.
    return found.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "scans")


def oracle(plan: Plan = Plan()) -> str:
    """The same clusters by comparing every vector with every centroid in SQL."""
    def assign(r: int) -> str:
        return f"""
        gaps{r} AS (SELECT v.n, c.c, sum((v.x - c.x) * (v.x - c.x)) AS d
                    FROM parts v JOIN centre{r} c ON v.i = c.i GROUP BY v.n, c.c),
        own{r} AS (SELECT n, min(c) AS c, min(d) AS d FROM (
                   SELECT *, min(d) OVER (PARTITION BY n) AS least FROM gaps{r})
                   WHERE d = least GROUP BY n)"""

    def move(r: int) -> str:
        return f"""
        mean{r} AS (SELECT o.c, v.i, sum(v.x)::BIGINT AS s, count(*) AS m
                    FROM parts v JOIN own{r} o ON o.n = v.n GROUP BY o.c, v.i),
        centre{r + 1} AS (SELECT c.c, c.i, CASE WHEN m.m IS NULL THEN c.x
                          ELSE (m.s - ((m.s % m.m) + m.m) % m.m) // m.m END AS x
                          FROM centre{r} c LEFT JOIN mean{r} m ON m.c = c.c AND m.i = c.i)"""

    steps = ",".join(
        part for r in range(plan.rounds) for part in (assign(r), move(r))) + "," + assign(plan.rounds)
    return f"""
    WITH kept AS (SELECT vec_id, row_number() OVER () AS n,
                         list_transform(embedding, lambda x: floor({plan.scale} * x::DOUBLE)::BIGINT) AS v
                  FROM embeddings WHERE len(embedding) = {plan.dims}
                  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS (SELECT n, unnest(v) AS x, unnest(range({plan.dims})) AS i FROM kept),
        start AS (SELECT n, row_number() OVER (ORDER BY sha256('{plan.seed}:' || vec_id)) - 1 AS c
                  FROM kept QUALIFY c < {plan.clusters}),
        centre0 AS (SELECT s.c, v.i, v.x FROM start s JOIN parts v ON v.n = s.n),
        {steps},
        digest AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS h
                   FROM centre{plan.rounds} GROUP BY c)
    SELECT k.vec_id, o.c::INTEGER AS cluster, o.d::BIGINT AS distance,
           (sum(o.d) OVER (PARTITION BY o.c))::BIGINT AS cluster_inertia,
           (sum(o.d) OVER ())::BIGINT AS inertia, g.h AS centroid_sha256
    FROM own{plan.rounds} o JOIN kept k ON k.n = o.n JOIN digest g ON g.c = o.c"""
