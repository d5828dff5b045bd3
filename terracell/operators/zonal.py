"""Statistics of raster cells per region."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..constants import DEFAULT_STATS
from .quantiles import grouped_quantiles

# Population deviation; NULL (nodata) values are left out of every statistic.
_STATS = {
    "mean": F.avg, "std": F.stddev_pop, "min": F.min, "max": F.max,
    "sum": F.sum, "count": F.count,
}


def zonal_stats(labelled: DataFrame, keys: list[str], stats: list[str] | None = None, value: str = "value") -> DataFrame:
    """One row per ``keys`` with the chosen statistics.

    All of them combine in the map-side aggregation, so a dominant region sends
    one row per task.
    """
    names = stats or DEFAULT_STATS
    unknown = [s for s in names if s not in _STATS]
    if unknown:
        raise ValueError(f"unknown statistics {unknown}; use {sorted(_STATS)}")
    return labelled.groupBy(*keys).agg(
        F.count(value).alias("n"), *[_STATS[s](value).alias(s) for s in names]
    )


def zonal_quantiles(labelled: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    q = grouped_quantiles(labelled, keys, value, {"p25": 0.25, "median": 0.5, "p75": 0.75})
    return q.withColumn("iqr", F.col("p75") - F.col("p25"))


def class_cover(labelled: DataFrame, keys: list[str], cls: str = "class") -> DataFrame:
    """Cell count and fraction (0..1) of the valid cells per class.

    Counts come first, so the window sees one row per region and class.
    """
    counts = labelled.where(F.col(cls).isNotNull()).groupBy(*keys, cls).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(*keys))
    return counts.withColumn("pct", F.col("n") / total)


def class_summary(labelled: DataFrame, keys: list[str], cls: str = "class", value: str = "value") -> DataFrame:
    """Counts and moments per region and class, the one pass over the cells from
    which both the statistics and the class cover of a region follow."""
    return labelled.groupBy(*keys, F.col(cls).alias("class")).agg(
        F.count("*").alias("n_cells"), F.count(value).alias("n"), F.avg(value).alias("mean"),
        F.var_pop(value).alias("var"), F.min(value).alias("min"), F.max(value).alias("max"),
    )


def stats_from_classes(summary: DataFrame, keys: list[str]) -> DataFrame:
    """n, mean, std, min, max per region, merged from its classes.

    The variance is the mean variance within classes plus the variance between
    their means, which loses no digits to large sums of squares.
    """
    n = F.sum("n").over(Window.partitionBy(*keys))
    centre = F.sum(F.col("n") * F.col("mean")).over(Window.partitionBy(*keys)) / F.nullif(n, F.lit(0))
    spread = summary.withColumn("_m", centre).withColumn(
        "_ss", F.col("n") * (F.col("var") + (F.col("mean") - F.col("_m")) * (F.col("mean") - F.col("_m")))
    )
    return spread.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.max("_m").alias("mean"),
        F.sqrt(F.sum("_ss") / F.nullif(F.sum("n"), F.lit(0))).alias("std"),
        F.min("min").alias("min"), F.max("max").alias("max"),
    )


def cover_from_classes(summary: DataFrame, keys: list[str]) -> DataFrame:
    """Cell count and fraction per class, as ``class_cover`` gives."""
    valid = summary.where(F.col("class").isNotNull()).select(*keys, "class", F.col("n_cells").alias("n"))
    return valid.withColumn("pct", F.col("n") / F.sum("n").over(Window.partitionBy(*keys)))


def counts(labelled: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Cells, valid cells and the valid proportion."""
    agg = labelled.groupBy(*keys).agg(F.count("*").alias("n_cells"), F.count(value).alias("n_valid"))
    return agg.withColumn("valid_share", F.col("n_valid") / F.col("n_cells"))


def to_long(wide: DataFrame, region: str, source: Column, variable: Column, stats: list[str]) -> DataFrame:
    """(region_uid, source, variable, stat, value) from one row per region."""
    base = wide.select(
        F.col(region).alias("region_uid"), source.alias("source"), variable.alias("variable"),
        *[F.col(s).cast("double").alias(s) for s in stats],
    )
    return base.unpivot(["region_uid", "source", "variable"], stats, "stat", "value")


def to_wide(long: DataFrame, stats: list[str]) -> DataFrame:
    """One row per region × source × variable, a column per statistic."""
    return long.groupBy("region_uid", "source", "variable").pivot("stat", stats).agg(F.first("value"))


def merge_long(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out
