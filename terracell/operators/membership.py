"""Soft region membership of cells."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.binding import let
from ..session import materialize
from .joins import lookup_join

BLOCK_POINTS = 256  # points that share a list of regions, on average


def centroids(features: DataFrame, key: str, x: Column, y: Column) -> DataFrame:
    return features.groupBy(F.col(key).alias("code")).agg(F.avg(x).alias("cx"), F.avg(y).alias("cy"))


def _squares(level: Column, x: Column, y: Column) -> list[Column]:
    """The grid square of side 2^level that holds a point."""
    side = F.pow(F.lit(2.0), level)
    return [F.floor(x / side).alias("gx"), F.floor(y / side).alias("gy")]


def _around(df: DataFrame, level: Column, x: Column, y: Column) -> DataFrame:
    """A row for each of the nine squares of ``level`` around a point."""
    side = F.pow(F.lit(2.0), level)
    near = lambda v: F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.floor(v / side) + d))
    return df.withColumn("level", level).withColumn("gx", near(x)).withColumn("gy", near(y))


def relevant_regions(blocks: DataFrame, regions: DataFrame, half: float, reach: float) -> DataFrame:
    """(bx, by, regions): the regions that matter for any point of a square block.

    ``blocks`` has bx, by and the middle x, y; no point is farther than ``half``
    from it. With near the distance of a point to its nearest region, a region
    matters if it lies within sqrt(near^2 + reach^2). The smallest grid level
    at which one of the nine squares around the middle holds a region bounds near; the squares of the level that
    covers the resulting radius hold all candidates, and the exact
    distances from the middle then leave those that can matter.
    """
    c = F.col
    box = blocks.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    span = regions.agg(F.min("cx"), F.max("cx"), F.min("cy"), F.max("cy")).first()
    width = max(max(box[i + 1], span[i + 1]) - min(box[i], span[i]) for i in (0, 2))
    bottom = math.floor(math.log2(max(half, 1e-300)))
    # the ninefold neighbourhood of the top level holds everything, also beyond the radius
    top = max(bottom, math.ceil(math.log2(max(3 * width + 3 * half + reach, 1e-300)))) + 2
    levels = F.array(*[F.lit(n) for n in range(bottom, top + 1)])
    spread = regions.withColumn("level", F.explode(levels)).withColumns(dict(zip(("gx", "gy"), _squares(c("level"), c("cx"), c("cy")), strict=True)))
    taken = spread.select("level", "gx", "gy").distinct()
    asked = _around(blocks.withColumn("at", F.explode(levels)), c("at"), c("x"), c("y"))
    first = asked.join(taken, ["level", "gx", "gy"]).groupBy("bx", "by", "x", "y").agg(F.min("level").alias("level"))
    bound = F.lit(math.sqrt(8.0)) * F.pow(F.lit(2.0), c("level"))  # a corner two squares off
    radius = F.sqrt(F.pow(bound + half, F.lit(2.0)) + reach ** 2) + half
    wide = first.withColumn("level", F.least(F.ceil(F.log2(radius)), F.lit(top)).cast("int"))
    met = _around(wide, c("level"), c("x"), c("y")).join(spread, ["level", "gx", "gy"])
    gap = F.hypot(c("cx") - c("x"), c("cy") - c("y"))
    listed = met.groupBy("bx", "by").agg(F.min(gap).alias("near"), F.collect_list(F.struct("code", "cx", "cy", gap.alias("gap"))).alias("r"))
    limit = F.sqrt(F.pow(c("near") + half, F.lit(2.0)) + reach ** 2) + half
    return listed.select("bx", "by", F.array_sort(F.transform(
        F.filter("r", lambda r: r["gap"] <= limit * (1 + 1e-9)), lambda r: F.struct(r["code"].alias("code"), r["cx"].alias("cx"), r["cy"].alias("cy")))).alias("regions"))


def soft_membership(points: DataFrame, regions: DataFrame, bandwidth: float = 1.0, block: float | None = None) -> DataFrame:
    """``membership``: softmax of minus squared distance to the region centroids.

    ``points`` has id, x, y; ``regions`` has code, cx, cy. The result is one row
    per point with an ARRAY<STRUCT<code, p>> ordered by code, of the regions
    whose weight can change a double: with n regions those left out weigh less
    than n * exp(-cut) < 2^-54 of the nearest one together. Which they are is
    looked up on a grid for square blocks of points, so a point meets the
    regions around it and no others, and points are not multiplied. ``block`` is the side of a
    block; by default it holds about BLOCK_POINTS points.
    """
    if points.isEmpty() or regions.isEmpty():
        return points.withColumn("membership", F.expr("CAST(NULL AS ARRAY<STRUCT<code: STRING, p: DOUBLE>>)"))
    regions = materialize(regions.select("code", "cx", "cy").where("cx IS NOT NULL AND cy IS NOT NULL"), "centroids")
    reach = math.sqrt(math.log(2.0) * 54 + math.log(regions.count())) * float(bandwidth)
    if block is None:
        n, w, h = points.agg(F.count("x"), F.max("x") - F.min("x"), F.max("y") - F.min("y")).first()
        block = math.sqrt(max(w, 1e-9) * max(h, 1e-9) * BLOCK_POINTS / max(n, 1)) or 1.0
    place = {"bx": F.floor(F.col("x") / block), "by": F.floor(F.col("y") / block)}
    placed = points.withColumns(place)
    blocks = materialize(placed.where("x IS NOT NULL AND y IS NOT NULL").select("bx", "by").distinct().select(
        "bx", "by", ((F.col("bx") + 0.5) * block).alias("x"), ((F.col("by") + 0.5) * block).alias("y")), "blocks")
    lists = relevant_regions(blocks, regions, block * math.sqrt(0.5), reach)
    met = lookup_join(placed, lists, ["bx", "by"], how="left")
    near = let(F.col("regions"), lambda c: _softmax(c, bandwidth, reach ** 2 / float(bandwidth) ** 2))
    return met.withColumn("membership", near).drop("bx", "by", "regions")


def _softmax(centres: Column, bandwidth: float, cut: float) -> Column:
    def distance(r):
        dx, dy = F.col("x") - r.getField("cx"), F.col("y") - r.getField("cy")
        return (dx * dx + dy * dy) / F.lit(float(bandwidth) ** 2)

    # Distances are taken from the nearest centroid, so the largest weight is 1.
    weighed = let(
        F.transform(centres, distance),
        lambda d: let(F.array_min(d), lambda near: F.zip_with(
            centres, d, lambda r, v: F.struct(r.getField("code").alias("code"), (near - v).alias("e")))),
    )
    kept = F.transform(F.filter(weighed, lambda r: r["e"] >= -cut), lambda r: F.struct(r["code"].alias("code"), F.exp(r["e"]).alias("w")))
    total = lambda w: F.aggregate(w, F.lit(0.0), lambda acc, v: acc + v["w"])
    return let(kept, lambda w: let(total(w), lambda s: F.transform(
        w, lambda r: F.struct(r["code"].alias("code"), (r["w"] / s).alias("p")))))


def best_member(membership: Column) -> Column:
    """Struct (code, p) of the likeliest region; equal shares go to the first code."""
    none = F.struct(F.lit(None).cast("string").alias("code"), F.lit(-1.0).alias("p"))
    return F.aggregate(
        membership, none, lambda best, m: F.when(m.getField("p") > best.getField("p"), m).otherwise(best)
    )


def membership_entropy(membership: Column) -> Column:
    """Uncertainty of the assignment, in nats."""
    term = lambda p: F.when(p > 0, -p * F.ln(p)).otherwise(F.lit(0.0))
    return F.aggregate(membership, F.lit(0.0), lambda acc, m: acc + term(m.getField("p")))
