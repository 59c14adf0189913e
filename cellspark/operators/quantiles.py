"""Exact quantiles by distributed selection.

``median`` and ``percentile`` gather the distinct values of a group in one task.  Here a
quantile is found by narrowing the range of values that can hold it: each round counts the
values of that range in BINS equal bins (summed in part before the shuffle), and the bin
that holds the wanted rank becomes the next range.  It ends when a range holds one value,
however often it occurs.  What is kept between rounds is a row per group and rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.pipeline import materialize, tidy

#: Bins per range and round.
BINS = 1024
_MOST = 1.7976931348623157e308


@tidy
def quantiles(df: DataFrame, value: str, probs: list[float], by: list[str] | None = None) -> DataFrame:
    """Columns ``by``, n and q: the quantiles ``probs`` of ``value`` per group, interpolated
    linearly between the two values around each (as ``percentile`` does).  Null and NaN
    values are left out, and a group without others has no row; infinite values count as
    the largest numbers.  A null group is a group."""
    by = by or []
    names = [f"_g{i}" for i in range(len(by))]
    v = F.col(value).cast("double")
    v = F.when(v == float("inf"), F.lit(_MOST)).when(v == float("-inf"), F.lit(-_MOST)).otherwise(v)
    rows = df.select(*[F.col(c).alias(g) for c, g in zip(by, names, strict=True)], v.alias("_v")).where("_v IS NOT NULL AND NOT isnan(_v)")
    rows = materialize(rows)
    shape = rows.groupBy(*names).agg(F.count("*").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")).where("n > 0")
    at = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(x), F.ceil(x)) for x in at])))
    state = materialize(shape.select(*names, "n", "lo", "hi", F.lit(0).cast("long").alias("below"), F.explode(ranks).alias("rank")))

    while not state.where("lo < hi").isEmpty():
        spans = state.where("lo < hi").select(*names, "lo", "hi").distinct()
        spans = spans.select(*[F.col(g).alias(f"s{g}") for g in names], "lo", "hi")
        if not by:
            spans = F.broadcast(spans)  # a row per rank at most
        inside = F.col("_v").between(F.col("lo"), F.col("hi"))
        for g in names:
            inside &= F.col(g).eqNullSafe(F.col(f"s{g}"))
        # halves, as the width of a range can exceed the largest number
        place = F.floor((F.col("_v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * BINS)
        bins = (rows.join(spans, inside).withColumn("bin", F.least(F.lit(BINS - 1), F.coalesce(place, F.lit(0)).cast("int")))
                .groupBy(*names, "lo", "hi", "bin").agg(F.count("*").alias("c"), F.min("_v").alias("bin_lo"), F.max("_v").alias("bin_hi")))
        w = Window.partitionBy(*names, "lo", "hi").orderBy("bin")  # BINS rows at most
        bins = bins.withColumn("upto", F.sum("c").over(w))
        a, b = state.alias("a"), bins.alias("b")
        hit = (F.col("a.lo") == F.col("b.lo")) & (F.col("a.hi") == F.col("b.hi"))
        for g in names:
            hit &= F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}"))
        first = F.col("a.below") + F.col("b.upto") - F.col("b.c")
        hit &= (F.col("a.rank") >= first) & (F.col("a.rank") < first + F.col("b.c"))
        state = materialize(a.join(b, hit, "left").select(
            *[F.col(f"a.{g}").alias(g) for g in names], F.col("a.n").alias("n"), F.coalesce("b.bin_lo", "a.lo").alias("lo"), F.coalesce("b.bin_hi", "a.hi").alias("hi"),
            (F.col("a.below") + F.coalesce(F.col("b.upto") - F.col("b.c"), F.lit(0))).alias("below"), F.col("a.rank").alias("rank")))
    found = state.withColumn("lo", F.when(F.col("lo") == _MOST, float("inf")).when(F.col("lo") == -_MOST, float("-inf")).otherwise(F.col("lo")))
    found = found.groupBy(*names).agg(F.first("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("rank", "lo"))).alias("m")).where("n > 0")  # two per prob
    q = []
    for x in at:
        low, high = F.element_at("m", F.floor(x)), F.element_at("m", F.ceil(x))
        q.append(F.when(low == high, low).otherwise(low * (F.ceil(x) - x) + high * (x - F.floor(x))))
    return found.select(*[F.col(g).alias(c) for c, g in zip(by, names, strict=True)], "n", F.array(*q).alias("q"))
