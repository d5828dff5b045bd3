"""Geometry defects that need more than one row's arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.rings import clean_rings, geom_area, geom_bounds, geom_edges, geom_perimeter, is_usable, orient, ring_flags
from ..session import materialize
from .nesting import shell_flags


def repair_features(features: DataFrame) -> DataFrame:
    """Clean rings, shells counter-clockwise, holes clockwise; geometries that end up empty are kept for the next step to drop.

    A single ring is a shell. Features of several rings are stored, and their
    rings are nested as rows of their own; only the flags come back.
    """
    cleaned = features.withColumn("geom", clean_rings(F.col("geom")))
    several = materialize(cleaned.where(F.size("geom") > 1).withColumn("_row", F.monotonically_increasing_id()), "rings")
    flags = shell_flags(several.select("_row", F.posexplode("geom").alias("i", "ring")), ["_row"])
    shells = flags.groupBy("_row").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "shell"))), lambda f: f["shell"]).alias("_shells"))
    nested = several.join(shells, "_row").withColumn("geom", orient(F.col("geom"), F.col("_shells"))).select(*features.columns)
    single = cleaned.where(F.col("geom").isNull() | (F.size("geom") <= 1)).withColumn("geom", orient(F.col("geom")))
    return single.unionByName(nested)


def defect_flags(features: DataFrame, key: str = "feature_id") -> DataFrame:
    """Row-local defects, crossing edges and whether any defect remains after repair."""
    local = features.select(
        key, is_usable(F.col("geom")).alias("usable"), ring_flags(F.col("geom")).alias("f")
    ).select(key, "usable", *[
        F.coalesce(f"f.{c}", F.lit(False)).alias(c)
        for c in ("open_ring", "repeated_vertex", "zero_area", "too_short")
    ])
    crossed = crossing_features(features, key).withColumn("self_cross", F.lit(True))
    return local.join(crossed, key, "left").withColumn("self_cross", F.coalesce("self_cross", F.lit(False)))


def crossing_features(features: DataFrame, key: str = "feature_id") -> DataFrame:
    """Features with two edges that properly cross.

    Edges are compared only inside the small bins they run through. A feature
    with n edges gets n vertical slabs; within a slab an edge covers just the
    heights it has there, so edges along an outline share few bins.
    """
    c = F.col
    boxed = features.select(
        key, geom_edges(c("geom")).alias("edges"), geom_bounds(c("geom")).alias("b")
    ).select(
        key, c("b.xmin").alias("bx"), c("b.ymin").alias("by"), F.size("edges").alias("n"),
        F.greatest(c("b.xmax") - c("b.xmin"), c("b.ymax") - c("b.ymin")).alias("size"),
        F.posexplode("edges").alias("i", "e"),
    ).where("n > 3 and size > 0").select(
        key, "i", "e.*", "bx", "by", (c("size") / c("n")).alias("step"),
        (c("size") / F.ceil(F.sqrt("n"))).alias("rise"), (c("size") * 1e-9).alias("eps"),
    )
    slab = lambda x: F.floor((x - c("bx")) / c("step"))
    lo, hi = F.least("x1", "x2"), F.greatest("x1", "x2")
    slabs = boxed.withColumn("gx", F.explode(F.sequence(slab(lo), slab(hi))))
    left = F.greatest(lo, c("bx") + c("gx") * c("step"))
    right = F.least(hi, c("bx") + (c("gx") + 1) * c("step"))
    at = lambda x: c("y1") + (x - c("x1")) * (c("y2") - c("y1")) / F.nullif(c("x2") - c("x1"), F.lit(0.0))
    upright = c("x1") == c("x2")
    bottom = F.when(upright, F.least("y1", "y2")).otherwise(F.least(at(left), at(right))) - c("eps")
    top = F.when(upright, F.greatest("y1", "y2")).otherwise(F.greatest(at(left), at(right))) + c("eps")
    level = lambda y: F.floor((y - c("by")) / c("rise"))
    binned = slabs.withColumn("gy", F.explode(F.sequence(level(bottom), level(top)))).select(
        key, "gx", "gy", "i", "x1", "y1", "x2", "y2"
    )
    other = binned.select(key, "gx", "gy", *[c(f).alias(f"o_{f}") for f in ("i", "x1", "y1", "x2", "y2")])
    side = lambda px, py, ax, ay, bx, by: F.signum((bx - ax) * (py - ay) - (by - ay) * (px - ax))
    own, far = [c(f) for f in ("x1", "y1", "x2", "y2")], [c(f"o_{f}") for f in ("x1", "y1", "x2", "y2")]
    apart = lambda line, p: side(p[0], p[1], *line) * side(p[2], p[3], *line) < 0
    met = binned.join(other, [key, "gx", "gy"]).where(
        (c("i") < c("o_i")) & apart(own, far) & apart(far, own)
    )
    return met.select(key).distinct()


def compactness(features: DataFrame, keys: list[str]) -> DataFrame:
    """Area, perimeter and 4πA/P² per feature; slivers come out near 0."""
    area, perimeter = geom_area(F.col("geom")), geom_perimeter(F.col("geom"))
    return features.select(*keys, area.alias("area"), perimeter.alias("perimeter")).withColumn(
        "compactness",
        F.lit(4 * 3.141592653589793) * F.col("area") / F.nullif(F.col("perimeter") * F.col("perimeter"), F.lit(0.0)),
    )
