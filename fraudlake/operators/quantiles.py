"""Exact quantiles (linear interpolation) of many columns at once, by radix selection.

One path for every size: no sort, no sketch, and no task that holds the values of a
column. A pass counts the values of every open interval into buckets that follow the
order of doubles, with each bucket's smallest and largest value. The bucket of a wanted
rank is the next interval, unless the rank is its first or last value or all its values
are equal, which settles it. The first pass cuts by sign and binary exponent (32 buckets
an octave); inside such a bucket doubles are evenly spaced, so each further pass takes
12 bits of the remaining 47: five passes at most (a sixth beside a power of two).

All columns and probabilities share a pass. Counts are combined before the shuffle, so
a value that a third of the rows hold is one row per task.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import AGG_CHUNK

BUCKETS = 4096
OCTAVE = 32       # buckets of the first pass between two powers of two
FAR = 1100 * OCTAVE  # above the bucket of every finite double
SPAN = 1 << 18    # more than any pass has buckets in an interval


def wide_agg(df: DataFrame, exprs: list[Column], chunk: int = AGG_CHUNK) -> list:
    """Values of many global aggregates, a bounded number per job so that the
    generated code stays within the JVM's method size."""
    out = []
    for i in range(0, len(exprs), chunk):
        part = [e.alias(f"a{j}") for j, e in enumerate(exprs[i:i + chunk])]
        out.extend(df.agg(*part).first())
    return out


def exact_quantiles(df: DataFrame, series: dict[str, Column], probs: list[float],
                    weight: Column | None = None, buckets: int = BUCKETS) -> dict[str, list]:
    """``{name: [quantile per prob]}``; a series without values gives ``None``. NaN is
    the greatest value. With ``weight`` (whole numbers) a row counts that many times;
    rows of weight null or below 1 don't count.
    Like ``DataFrame.approxQuantile`` this runs at once and returns a bounded set of
    numbers, but the numbers are exact. ``buckets`` trades passes for counters."""
    out = {c: [None] * len(probs) for c in series}
    names = list(series)
    for i in range(0, len(names), AGG_CHUNK):
        part = {c: series[c].cast("double") for c in names[i:i + AGG_CHUNK]}
        out.update(_select(df, part, probs, weight, buckets))
    return out


def _first_bucket(x: Column) -> Column:
    exponent = F.floor(F.log2(F.abs(x)) * F.lit(float(OCTAVE))) + F.lit(FAR)
    infinite = F.abs(x) == F.lit(math.inf)
    return (F.when(F.isnan(x), F.lit(3 * FAR))
            .when(infinite, F.when(x > 0, F.lit(3 * FAR - 1)).otherwise(F.lit(-3 * FAR)))
            .when(x > 0, exponent).when(x < 0, -exponent).when(x == 0, F.lit(0))
            + F.lit(3 * FAR)).cast("long")


def _next_bucket(x: Column, lo: float, hi: float, buckets: int) -> Column:
    """Subtraction, division and multiplication round without changing an order, so
    buckets follow the values; the two ends always get different ones."""
    part = (x - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(buckets - 1))
    return F.floor(part).cast("long")


def _count(df: DataFrame, cells: list[tuple[Column, Column]], weight: Column | None,
           bucket=lambda x: F.lit(0)) -> DataFrame:
    """(interval, bucket, n, lo, hi) of the (place, value) columns; place is the
    interval's number times ``SPAN`` plus the bucket, null outside. ``bucket`` of the value is
    added to the place after the columns became rows: written out once for each column, it
    outgrows what the JVM compiles."""
    rows = F.array(*[F.struct(place.alias("place"), x.alias("x")) for place, x in cells])
    if weight is None:
        tall, n = df.select(F.inline(rows)), F.count(F.lit(1))
    else:
        tall = df.select(weight.cast("long").alias("w"), F.inline(rows)).where("w > 0")
        n = F.sum("w")
    tall = tall.withColumn("place", F.col("place") + bucket(F.col("x")))
    counted = tall.where("place is not null").groupBy("place").agg(
        n.alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    return counted.select(F.expr(f"place div {SPAN}").cast("int").alias("interval"),
                          (F.col("place") % SPAN).alias("bucket"), "n", "lo", "hi")


def _pick(counted: DataFrame, ranks: Column) -> list:
    """The bucket that holds each wanted rank of each interval, a row per rank."""
    whole = Window.partitionBy("interval")  # bounded: the buckets of one interval
    return (
        counted.withColumn("upto", F.sum("n").over(whole.orderBy("bucket")))
        .withColumn("total", F.sum("n").over(whole))
        .select("interval", "n", "lo", "hi", "total", (F.col("upto") - F.col("n")).alias("before"),
                F.explode(ranks).alias("rank"))
        .where("rank >= before and rank < before + n").collect())


def _open(row) -> bool:
    """Whether the row's bucket does not tell the value at its rank yet."""
    settled = row["lo"] == row["hi"] or math.isnan(row["lo"])
    return not (settled or row["rank"] in (row["before"], row["before"] + row["n"] - 1))


def _select(df, series, probs, weight, buckets):
    names, found, totals = list(series), {}, {}
    cells = [(F.lit(i * SPAN).cast("long"), series[c]) for i, c in enumerate(names)]
    at = F.array_distinct(F.flatten(F.array(*[
        F.array(F.floor(h), F.ceil(h)) for h in ((F.col("total") - 1) * F.lit(float(p)) for p in probs)])))
    # (column, rank in the column, rank in the bucket, lo, hi)
    got = [(names[r["interval"]], r["rank"], r) for r in _pick(_count(df, cells, weight, _first_bucket), at)]
    totals = {c: r["total"] for c, _, r in got}
    while got:
        wanted = {}  # interval -> [(rank in the column, rank in the interval)]
        for c, rank, r in got:
            if _open(r):
                wanted.setdefault((c, r["lo"], r["hi"]), []).append((rank, r["rank"] - r["before"]))
            else:
                found[c, rank] = r["lo"] if r["rank"] == r["before"] else r["hi"]
        if not wanted:
            break
        intervals = list(wanted)
        cells = [(_places(series[c], [(i, lo, hi) for i, (k, lo, hi) in enumerate(intervals) if k == c],
                          buckets), series[c]) for c in dict.fromkeys(k for k, _, _ in intervals)]
        ranks = F.element_at(F.create_map(*[e for i, k in enumerate(intervals) for e in (
            F.lit(i), F.array(*[F.lit(j).cast("long") for _, j in wanted[k]]))]), F.col("interval"))
        back = [{j: rank for rank, j in wanted[k]} for k in intervals]
        got = [(intervals[r["interval"]][0], back[r["interval"]][r["rank"]], r)
               for r in _pick(_count(df, cells, weight), ranks)]
    return {c: [_between(found, c, p * (totals[c] - 1)) for p in probs] for c in totals}


def _places(x: Column, intervals: list[tuple[int, float, float]], buckets: int) -> Column:
    """A column's open intervals are apart, so a value is in at most one of them."""
    place = F.when(F.isnan(x), F.lit(None).cast("long"))
    for i, lo, hi in intervals:
        place = place.when((x >= F.lit(lo)) & (x <= F.lit(hi)),
                           _next_bucket(x, lo, hi, buckets) + F.lit(i * SPAN))
    return place


def _between(found: dict, c: str, h: float) -> float:
    low, high = math.floor(h), math.ceil(h)
    a, b = found[c, low], found[c, high]
    return a if low == high or a == b else (high - h) * a + (h - low) * b
