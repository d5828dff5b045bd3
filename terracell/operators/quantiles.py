"""Exact quantiles per group for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .joins import lookup_join

STEPS = 200        # cuts a sketch gives
ACCURACY = 2000    # of the sketch: a rank is off by at most this share of the rows
TARGET = 100_000   # rows of a bracket that are sorted together


def grouped_quantiles(
    df: DataFrame, keys: list[str], value: str, probs: dict[str, float]
) -> DataFrame:
    """One row per group with the quantiles named in ``probs`` (linear interpolation).

    ``percentile`` keeps every distinct value of a group in one task. Here a
    bracket of values closes in on the rank of each quantile. A pass counts
    the rows of a group below and inside the bracket and sketches those
    inside; the next bracket lies one cut of the sketch beyond the rank on either side. Sketches
    merge map-side, and ``df`` is read again with the brackets joined on, so
    nothing but a row per group and quantile is stored. A bracket of at most TARGET rows, or of a
    single value, is not narrowed further; the values inside the brackets are
    then counted and ranked. A bracket that the counts prove wrong is taken
    back, so the sketch decides how much is sorted, never the result.
    Groups with a null key are left out.
    """
    present = F.lit(True)
    for k in keys:
        present &= F.col(k).isNotNull()
    rows = df.where(present & F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(
        *keys, F.col(value).cast("double").alias("_v"))
    done, wide = [], materialize(_first_brackets(rows, keys, probs), "brackets")
    while True:
        small = (F.col("_inside") <= TARGET) | F.col("_lo").eqNullSafe(F.col("_hi")) & F.col("_lo").isNotNull() | F.col("_stuck")
        done.append(wide.where(small).drop("_cuts"))
        wide = wide.where(~small)
        if wide.isEmpty():
            break
        wide = materialize(_narrowed(rows, wide, keys), "brackets")
    brackets = done[0]
    for d in done[1:]:
        brackets = brackets.unionByName(d)
    return _interpolated(rows, brackets, keys, list(probs))


def _sketch(column: Column) -> Column:
    return F.percentile_approx(column, [i / STEPS for i in range(1, STEPS)], ACCURACY)


def _first_brackets(rows: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame:
    """A bracket without limits for each group and quantile: _q, the exact rank _h, _below, _inside, _cuts."""
    groups = rows.groupBy(*keys).agg(F.count("*").alias("_inside"), _sketch(F.col("_v")).alias("_cuts"))
    spots = F.array(*[F.struct(F.lit(name).alias("q"), F.lit(float(p)).alias("p")) for name, p in probs.items()])
    none = F.lit(None).cast("double")
    return groups.withColumn("_s", F.explode(spots)).select(
        *keys, F.col("_s.q").alias("_q"), (F.col("_s.p") * (F.col("_inside") - 1)).alias("_h"), none.alias("_lo"), none.alias("_hi"),
        F.lit(0).cast("long").alias("_below"), "_inside", "_cuts", F.lit(False).alias("_stuck"))


def _narrowed(rows: DataFrame, wide: DataFrame, keys: list[str]) -> DataFrame:
    """The next brackets: limits from the cuts, numbers from the rows."""
    at = lambda rank: (rank - F.col("_below")) / F.col("_inside") * STEPS
    left, right = F.floor(at(F.floor("_h"))) - 1, F.ceil(at(F.ceil("_h") + 1)) + 1
    cut = lambda k: F.get("_cuts", (k - 1).cast("int"))  # the k-th cut has k / STEPS of the rows below; none beyond the ends
    chosen = materialize(wide.select(
        *keys, "_q", "_h", "_below", "_inside", F.col("_lo").alias("_old_lo"), F.col("_hi").alias("_old_hi"),
        F.coalesce(F.when(left >= 1, cut(left)), F.col("_lo")).alias("_lo"),
        F.coalesce(F.when(right <= STEPS - 1, cut(right)), F.col("_hi")).alias("_hi")), "chosen")
    over = lambda c: F.coalesce(F.col("_v") >= F.col(c), F.lit(True))
    under = lambda c: F.coalesce(F.col("_v") <= F.col(c), F.lit(True))
    joined = lookup_join(rows, chosen.select(*keys, "_q", "_old_lo", "_old_hi", "_lo", "_hi"), keys, extra=over("_old_lo") & under("_old_hi"))
    inside = over("_lo") & under("_hi")
    counted = joined.groupBy(*keys, "_q").agg(
        F.count(F.when(~over("_lo"), 1)).alias("_more"), F.count(F.when(inside, 1)).alias("_now"), _sketch(F.when(inside, F.col("_v"))).alias("_cuts"))
    both = chosen.join(counted, [*keys, "_q"])
    below = F.col("_below") + F.col("_more")
    good = (F.floor("_h") >= below) & (F.ceil("_h") < below + F.col("_now"))
    pick = lambda new, old: F.when(good, F.col(new)).otherwise(F.col(old))
    return both.select(
        *keys, "_q", "_h", pick("_lo", "_old_lo").alias("_lo"), pick("_hi", "_old_hi").alias("_hi"),
        F.when(good, below).otherwise(F.col("_below")).alias("_below"), pick("_now", "_inside").alias("_inside"), "_cuts",
        (~good | (F.col("_now") == F.col("_inside"))).alias("_stuck"))


def _interpolated(rows: DataFrame, brackets: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Count the values inside the brackets and read off the ranks on either side of _h."""
    # quantiles of a group with the same bracket share it
    shared = materialize(brackets.groupBy(*keys, "_lo", "_hi", "_below").agg(
        F.collect_list(F.struct("_q", "_h")).alias("_qs")).withColumn("_b", F.xxhash64("_lo", "_hi")), "brackets")
    limits = shared.select(*keys, "_b", "_lo", "_hi")
    inside = F.coalesce(F.col("_v") >= F.col("_lo"), F.lit(True)) & F.coalesce(F.col("_v") <= F.col("_hi"), F.lit(True))
    counts = lookup_join(rows, limits, keys, extra=inside).groupBy(*keys, "_b", "_v").agg(F.count("*").alias("_c"))
    upto = Window.partitionBy(*keys, "_b").orderBy("_v")
    ranked = counts.withColumn("_end", F.sum("_c").over(upto))
    placed = ranked.join(shared.select(*keys, "_b", "_below", F.explode("_qs").alias("_s")), [*keys, "_b"])
    end = F.col("_below") + F.col("_end")
    has = lambda rank: (rank >= end - F.col("_c")) & (rank < end)
    low, high = F.floor("_s._h"), F.ceil("_s._h")
    found = placed.where(has(low) | has(high)).groupBy(*keys, F.col("_s._q").alias("_q"), F.col("_s._h").alias("_h")).agg(
        F.max(F.when(has(low), F.col("_v"))).alias("_a"), F.max(F.when(has(high), F.col("_v"))).alias("_z"))
    quantile = F.col("_a") + (F.col("_h") - F.floor("_h")) * (F.col("_z") - F.col("_a"))
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col("_q") == n, quantile)).alias(n) for n in names])
