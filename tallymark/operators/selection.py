"""Exact order statistics and quantiles by counting in ever narrower ranges."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, functions as F

#: Buckets of a range that one pass tells apart.
BUCKETS = 4096


def at_places(counted: DataFrame, value: str, weight: str, places, low: int, high: int) -> dict:
    """The values at ``places`` (from 0) of the sorted whole numbers, each ``weight`` times there.

    Each pass counts the rows of every range still open in ``BUCKETS`` parts and goes on in the
    part that holds the place, until a part is one value. The driver gets counts only, at most
    ``BUCKETS`` a range; no task sorts or keeps the values.
    """
    # Place wanted -> its range and how many rows lie below that.
    open_ = {place: (low, high, 0) for place in places}
    found: dict[int, int] = {}
    while open_:
        ranges = sorted({(lo, hi, below) for lo, hi, below in open_.values()})
        v = F.col(value).cast("decimal(20,0)")
        number, bucket = F, F
        steps = []
        for i, (lo, hi, _) in enumerate(ranges):
            step = -(-(hi - lo + 1) // BUCKETS)
            steps.append(step)
            inside = F.col(value).between(lo, hi)
            number = number.when(inside, F.lit(i))
            bucket = bucket.when(inside, F.floor((v - F.lit(lo).cast("decimal(20,0)")) / step))
        rows = (
            counted.select(number.alias("r"), bucket.cast("int").alias("b"), F.col(weight).alias("w"))
            .filter("r IS NOT NULL").groupBy("r", "b").agg(F.sum("w").alias("n")).collect())
        sizes: dict[int, dict[int, int]] = {}
        for r in rows:
            sizes.setdefault(r["r"], {})[r["b"]] = r["n"]
        narrowed = {}
        for place, part in open_.items():
            i = ranges.index(part)
            lo, hi, below = part
            for b in sorted(sizes[i]):
                if place < below + sizes[i][b]:
                    first = lo + b * steps[i]
                    last = min(hi, first + steps[i] - 1)
                    if first == last:
                        found[place] = first
                    else:
                        narrowed[place] = (first, last, below)
                    break
                below += sizes[i][b]
        open_ = narrowed
    return found


def quantiles(counted: DataFrame, value: str, weight: str, points) -> list[float | None]:
    """Exact quantiles of weighted whole numbers, between neighbours by linear interpolation."""
    low, high, rows = counted.agg(F.min(value), F.max(value), F.sum(weight)).first()
    if not rows:
        return [None] * len(points)
    wanted = [Fraction(str(q)) * (rows - 1) for q in points]
    places = {p for at in wanted for p in (int(at), min(int(at) + 1, rows - 1))}
    found = at_places(counted, value, weight, places, low, high)
    return [
        float(found[int(at)] + (at - int(at)) * (found[min(int(at) + 1, rows - 1)] - found[int(at)]))
        for at in wanted]
