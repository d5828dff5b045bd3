"""Dissolving features into regions, as edge tables.

A dissolved region has no size bound, so its outline is kept as one row per
edge (uid, x1, y1, x2, y2) and never gathered into a single geometry. Area,
bounds and raster rows all follow from edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..constants import AREA_CRS, M2_PER_KM2
from ..functions.crs import reproject
from ..functions.rings import geom_edges
from ..session import materialize
from .chains import rank_chains


def feature_edges(features: DataFrame, keys: list[str]) -> DataFrame:
    """Directed edges of (repaired) features."""
    return features.select(*keys, F.explode(geom_edges(F.col("geom"))).alias("e")).select(*keys, "e.*")


def dissolve_outline(edges: DataFrame, key: str = "uid") -> DataFrame:
    """Outline edges per key: edges shared by neighbours cancel.

    Neighbours run their common edge in opposite directions, so an edge seen
    both ways is interior; one seen only one way, however often, is outline
    (so copies of a polygon count once). Null keys are dropped. One shuffle on
    (key, edge), partially aggregated: a dominant region is spread by its edges.
    """
    a, b = (F.struct(F.col(f"x{i}").alias("x"), F.col(f"y{i}").alias("y")) for i in (1, 2))
    kept = edges.where(F.col(key).isNotNull() & (a != b))
    forward = a < b
    both = kept.groupBy(key, F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).agg(
        F.bool_or(forward).alias("fwd"), F.bool_or(~forward).alias("rev")
    )
    outline = both.where(F.col("fwd") != F.col("rev"))
    start = F.when(F.col("fwd"), F.col("lo")).otherwise(F.col("hi"))
    end = F.when(F.col("fwd"), F.col("hi")).otherwise(F.col("lo"))
    return outline.select(
        key, start.getField("x").alias("x1"), start.getField("y").alias("y1"),
        end.getField("x").alias("x2"), end.getField("y").alias("y2"),
    )


def project_edges(edges: DataFrame, source: str, target: str) -> DataFrame:
    p1, p2 = (reproject(F.col(f"x{i}"), F.col(f"y{i}"), source, target) for i in (1, 2))
    return edges.withColumns({"x1": p1[0], "y1": p1[1], "x2": p2[0], "y2": p2[1]})


def edge_measures(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Area, perimeter, bounds and edge count per key."""
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    return edges.groupBy(*keys).agg(
        (F.abs(F.sum(cross)) / 2).alias("area"),
        F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))).alias("perimeter"),
        F.min(F.least("x1", "x2")).alias("xmin"), F.min(F.least("y1", "y2")).alias("ymin"),
        F.max(F.greatest("x1", "x2")).alias("xmax"), F.max(F.greatest("y1", "y2")).alias("ymax"),
        F.count("*").alias("n_edges"),
    )


def area_km2(edges: DataFrame, keys: list[str], crs: str, area_crs: str = AREA_CRS) -> DataFrame:
    """Area per key in an equal-area system."""
    if crs is None:
        raise ValueError("area needs a CRS")
    flat = project_edges(edges, crs, area_crs)
    return edge_measures(flat, keys).select(*keys, (F.col("area") / M2_PER_KM2).alias("area_km2"))


def first_metadata(features: DataFrame, key: str, columns: list[str], order: str) -> DataFrame:
    """Other columns of the first feature of each key."""
    return features.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.min_by(c, order).alias(c) for c in columns]
    )


def _followers(edges: DataFrame, key: str) -> DataFrame:
    """(key, id, nxt): the edge after each one, that starts where it ends and bounds the same ground.

    Where rings touch, edges that arrive and edges that leave take turns around
    the vertex, and the ground on the left of one that arrives reaches to the next
    one that leaves, clockwise: the sharpest left turn. Numbering both kinds by angle pairs them
    off one to one, whatever the outline.
    """
    angle = lambda x, y: F.atan2(F.col(f"y{y}") - F.col(f"y{x}"), F.col(f"x{y}") - F.col(f"x{x}"))
    spoke = lambda end, kind, other: edges.select(
        key, F.col(f"x{end}").alias("vx"), F.col(f"y{end}").alias("vy"), "id", F.lit(kind).alias("kind"), angle(end, other).alias("a"))
    around = Window.partitionBy(key, "vx", "vy")
    spokes = spoke(1, "out", 2).unionByName(spoke(2, "in", 1)).withColumn(
        "place", F.row_number().over(Window.partitionBy(key, "vx", "vy", "kind").orderBy("a", "id")) - 1)
    shift = F.when(F.min_by("kind", F.struct("a", "kind")).over(around) == "in", -1).otherwise(0)
    outs = F.count(F.when(F.col("kind") == "out", 1)).over(around)
    spokes = spokes.withColumns({"shift": shift, "outs": outs})
    ends = spokes.where("kind = 'in'").select(
        key, "vx", "vy", "id", F.pmod(F.col("place") + F.col("shift"), F.nullif("outs", F.lit(0))).alias("place"),
        F.row_number().over(Window.partitionBy(key, "vx", "vy").orderBy("place")).alias("k"), "outs")
    starts = spokes.where("kind = 'out'").select(key, "vx", "vy", F.col("id").alias("nxt"), "place")
    # more edges may arrive than leave where an outline is not closed
    return ends.where(F.col("k") <= F.col("outs")).join(starts, [key, "vx", "vy", "place"]).select(key, "id", "nxt")


def outline_rings(outline: DataFrame, key: str = "uid") -> DataFrame:
    """Order outline edges into rings: (key, ring, pos, x, y).

    A ring is named by its smallest edge and counted from there. No ring is
    gathered in one task, whatever its length; see ``rank_chains``.
    """
    ident = F.xxhash64(*[F.col(c) for c in (key, "x1", "y1", "x2", "y2")])
    edges = materialize(outline.withColumn("id", ident), "edges")
    links = edges.select(key, "id").join(_followers(edges, key), [key, "id"], "left")
    placed = rank_chains(links, key)
    return placed.join(edges.select(key, "id", "x1", "y1"), [key, "id"]).select(
        key, "ring", "pos", F.col("x1").alias("x"), F.col("y1").alias("y"))
