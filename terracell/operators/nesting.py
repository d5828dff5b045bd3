"""Which rings of a feature are shells and which are holes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.rings import ring_edges

EDGES_PER_KEY = 4096  # edges of one bin that are compared in one piece


def shell_flags(rings: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, i and ``shell`` per ring: true if an even number of other rings of the feature hold it.

    ``rings`` has ``keys``, the ring's number i and its ``ring``. A ray from the
    middle of the ring's first edge crosses the edges of the other rings as
    often, odd or even, as rings hold the point, so only crossings are
    counted, never pairs of rings. Edges and rays meet by equi-join on
    horizontal bins, as many per feature as leave an edge about two of them; bins
    with many edges are dealt out again, so no feature is held by one task.
    """
    c = F.col
    edges = rings.select(*keys, "i", F.explode(ring_edges(c("ring"))).alias("e")).select(*keys, "i", "e.*")
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    extent = edges.groupBy(*keys).agg(
        F.min(low).alias("y0"), (F.max(high) - F.min(low)).alias("height"), F.sum(high - low).alias("run"), F.count("*").alias("n"))
    bins = F.greatest(F.ceil(c("n") * c("height") / F.greatest("run", "height")), F.lit(1))
    frame = extent.select(*keys, "y0", F.nullif(c("height") / bins, F.lit(0.0)).alias("step"),
                          F.ceil(2 * c("n") / bins / EDGES_PER_KEY).cast("int").alias("parts"))
    level = lambda y: F.coalesce(F.floor((y - c("y0")) / c("step")), F.lit(0))
    facing = edges.where("y1 <> y2").join(frame, keys).select(
        *keys, c("i").alias("j"), "x1", "y1", "x2", "y2", F.explode(F.sequence(level(low), level(high))).alias("bin"),
        F.pmod(F.xxhash64("i", "x1", "y1", "x2", "y2"), c("parts")).cast("int").alias("part"))
    a, b = F.get(c("ring"), F.lit(0)), F.get(c("ring"), F.lit(1))
    middle = lambda f: ((a.getField(f) + b.getField(f)) / 2).alias(f"p{f}")
    rays = rings.select(*keys, "i", middle("x"), middle("y")).join(frame, keys).select(
        *keys, "i", "px", "py", level(c("py")).alias("bin"), F.explode(F.sequence(F.lit(0), c("parts") - 1)).alias("part"))
    # the lower end of an edge counts, the upper does not
    crossed = ((c("y1") > c("py")) != (c("y2") > c("py"))) & (
        c("px") < c("x1") + (c("py") - c("y1")) * (c("x2") - c("x1")) / (c("y2") - c("y1")))
    odd = rays.join(facing, [*keys, "bin", "part"]).where((c("i") != c("j")) & crossed).groupBy(*keys, "i").agg(
        (F.count("*") % 2 == 1).alias("held"))
    return rings.select(*keys, "i").join(odd, [*keys, "i"], "left").select(
        *keys, "i", (~F.coalesce("held", F.lit(False))).alias("shell"))
