"""T-junctions: edges that a neighbour's vertex divides."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize

SPAN = 8  # cells along an edge


def _undirected(edges: DataFrame, key: str) -> DataFrame:
    """One row per edge and key, lower end first, with the directions it is seen in."""
    a, b = (F.struct(F.col(f"x{i}").alias("x"), F.col(f"y{i}").alias("y")) for i in (1, 2))
    kept = edges.where(F.col(key).isNotNull() & (a != b))
    return kept.groupBy(key, F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).agg(
        F.bool_or(a < b).alias("fwd"), F.bool_or(a > b).alias("rev"))


def split_edges(edges: DataFrame, key: str = "uid", tolerance: float = 0.0) -> DataFrame:
    """``edges`` with every edge cut at the vertices of its key that lie inside it.

    Where a long edge of one polygon meets several short ones of its neighbours,
    both sides consist of the same pieces afterwards, so that they cancel in
    ``dissolve_outline``. A vertex lies on an edge if it is no farther from it than
    ``tolerance``; the pieces then run through the vertex itself.

    Edges meet vertices by equi-join on grid cells. Every edge uses cells of
    its own magnitude, the power of two next to a SPAN-th of its length, so it
    covers few of them; a vertex is looked up once per magnitude in use. A
    region that holds most edges is spread by its cells. Repeated edges are given once.
    """
    c = F.col
    lines = materialize(_undirected(edges, key), "lines")
    length = F.hypot(c("hi.x") - c("lo.x"), c("hi.y") - c("lo.y"))
    level = F.floor(F.log2(length / SPAN)).cast("int")
    sized = lines.withColumn("level", level)
    levels = [r[0] for r in sized.select("level").distinct().collect()]  # magnitudes of doubles: some dozens
    if not levels:
        return edges.select(key, "x1", "y1", "x2", "y2")
    cell = F.pow(F.lit(2.0), c("level"))
    at = lambda v: F.floor(v / cell)
    margin = F.lit(float(tolerance))
    # by column, then the rows the edge has between the sides of the column
    columns = sized.withColumn("cell", cell).withColumn(
        "gx", F.explode(F.sequence(at(c("lo.x") - margin), at(F.greatest("lo.x", "hi.x") + margin))))
    flat = c("hi.x") == c("lo.x")
    slope = F.when(~flat, (c("hi.y") - c("lo.y")) / F.nullif(c("hi.x") - c("lo.x"), F.lit(0.0)))
    side = lambda x: c("lo.y") + (F.least(F.greatest(x, c("lo.x")), c("hi.x")) - c("lo.x")) * slope
    left, right = side(c("gx") * c("cell") - margin), side((c("gx") + 1) * c("cell") + margin)
    slack = margin + c("cell") * 1e-6
    low = F.when(flat, F.least("lo.y", "hi.y")).otherwise(F.least(left, right)) - slack
    high = F.when(flat, F.greatest("lo.y", "hi.y")).otherwise(F.greatest(left, right)) + slack
    covered = columns.withColumn("gy", F.explode(F.sequence(at(low), at(high)))).select(key, "level", "gx", "gy", "lo", "hi")
    vertices = lines.select(key, F.explode(F.array("lo", "hi")).alias("v")).distinct()
    looked = vertices.withColumn("level", F.explode(F.array(*[F.lit(n) for n in sorted(levels)]))).select(
        key, "level", at(c("v.x")).alias("gx"), at(c("v.y")).alias("gy"), "v")
    dx, dy = c("hi.x") - c("lo.x"), c("hi.y") - c("lo.y")
    px, py = c("v.x") - c("lo.x"), c("v.y") - c("lo.y")
    cross, along = dx * py - dy * px, (dx * px + dy * py) / (dx * dx + dy * dy)
    on_line = cross * cross <= margin * margin * (dx * dx + dy * dy)
    cuts = materialize(
        covered.join(looked, [key, "level", "gx", "gy"])
        .where((c("v") != c("lo")) & (c("v") != c("hi")) & on_line & (along > 0) & (along < 1))
        .select(key, "lo", "hi", "v", along.alias("t")), "cuts")
    # an edge with many cuts is sorted, not gathered: the window spills
    order = Window.partitionBy(key, "lo", "hi").orderBy("t", "v")
    last = F.lead("t").over(order).isNull()
    piece = F.struct(F.coalesce(F.lag("v").over(order), c("lo")).alias("a"), c("v").alias("b"))
    tail = F.struct(c("v").alias("a"), c("hi").alias("b"))
    pieces = cuts.withColumn("p", F.when(last, F.array(piece, tail)).otherwise(F.array(piece))).select(
        key, "lo", "hi", F.explode("p").alias("p"))
    cut = pieces.join(lines, [key, "lo", "hi"]).select(key, "p.a", "p.b", "fwd", "rev")
    whole = lines.join(cuts.select(key, "lo", "hi").distinct(), [key, "lo", "hi"], "left_anti").select(
        key, c("lo").alias("a"), c("hi").alias("b"), "fwd", "rev")
    ends = F.filter(F.array(
        F.when(c("fwd"), F.struct(c("a").alias("s"), c("b").alias("e"))),
        F.when(c("rev"), F.struct(c("b").alias("s"), c("a").alias("e")))), lambda e: e.isNotNull())
    return cut.unionByName(whole).where("a <> b").select(key, F.explode(ends).alias("e")).select(
        key, c("e.s.x").alias("x1"), c("e.s.y").alias("y1"), c("e.e.x").alias("x2"), c("e.e.y").alias("y2")).distinct()
