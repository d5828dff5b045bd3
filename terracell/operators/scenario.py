"""Perturbations of values and what they do to features."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def unit_hash(key: Column, seed: str) -> Column:
    """Number in [0, 1) that depends on the key and seed only, not on partitioning."""
    digest = F.md5(F.concat(key.cast("string"), F.lit("|"), F.lit(seed)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 4294967296.0


def add_noise(df: DataFrame, key: Column, value: str, epsilon: float, seed: str) -> DataFrame:
    """Value plus uniform noise in ±epsilon."""
    return df.withColumn("noisy", F.col(value) + (unit_hash(key, seed) * 2 - 1) * epsilon)


def apply_scenarios(df: DataFrame, value: str, deltas: dict[str, float]) -> DataFrame:
    """Each row once per scenario, with the value shifted by its delta."""
    table = F.array(*[
        F.struct(F.lit(n).alias("scenario"), F.lit(float(d)).alias("delta")) for n, d in sorted(deltas.items())
    ])
    return df.withColumn("_s", F.explode(table)).withColumns(
        {"scenario": F.col("_s.scenario"), "delta": F.col("_s.delta"), value: F.col(value) + F.col("_s.delta")}
    ).drop("_s")


def sensitivity(df: DataFrame, value: str, keys: list[str], delta: float,
                features: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Change of each feature per unit change of the value.

    Base and shifted features come from the same aggregation pass.
    """
    v = F.col(value)
    aggs = [f(v + s * delta).alias(f"{n}_{s}") for n, f in features.items() for s in (0, 1)]
    wide = df.groupBy(*keys).agg(*aggs)
    return wide.select(
        *keys, *[((F.col(f"{n}_1") - F.col(f"{n}_0")) / delta).alias(f"d_{n}") for n in features]
    )
