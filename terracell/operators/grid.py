"""Grid alignment and neighbourhoods of raster cells.

Windows here run inside one tile of one raster row or column. A tile borrows
the few cells it needs from its neighbours, so no window is longer than a tile
and its margin, however tall or wide the raster is.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..constants import TILE
from ..functions.windows import Grid


def align(
    cells: DataFrame, target_row: Column, target_col: Column, keys: list[str] | None = None,
    value: str = "value", cls: str | None = None,
) -> DataFrame:
    """Cells moved to a coarser grid: mean value and majority class.

    Equal votes go to the class that sorts first. Both come from one pass over
    the cells, first by (target, class), then by target.
    """
    keys = keys or []
    dims = [*keys, "row", "col"]
    moved = cells.select(
        *keys, target_row.alias("row"), target_col.alias("col"), F.col(value).alias("_v"),
        (F.col(cls) if cls else F.lit(None).cast("string")).alias("_k"),
    )
    votes = moved.groupBy(*dims, "_k").agg(
        F.count("*").alias("_n"), F.count("_v").alias("_nv"), F.sum("_v").alias("_s")
    )
    first = F.min(F.when(F.col("_k").isNotNull(), F.struct((-F.col("_n")).alias("o"), F.col("_k").alias("k"))))
    out = votes.groupBy(*dims).agg(
        (F.sum("_s") / F.nullif(F.sum("_nv"), F.lit(0))).alias("mean"),
        F.sum("_n").alias("n_cells"), first.getField("k").alias("majority"),
    )
    return out if cls else out.drop("majority")


def onto_grid(cells: DataFrame, source: Grid, target: Grid, keys: list[str] | None = None,
              value: str = "value", cls: str | None = None) -> DataFrame:
    """Align by the cell centres: each goes to the target cell that holds it."""
    row = F.floor((source.y(F.col("row")) - target.y0) / target.dy)
    col = F.floor((source.x(F.col("col")) - target.x0) / target.dx)
    return align(cells, row, col, keys, value, cls)


def neighbourhood_mean(cells: DataFrame, grid: Grid, radius: float, keys: list[str] | None = None,
                       value: str = "value") -> DataFrame:
    """Mean over all cells whose centre is within ``radius``, the cell included.

    For each row offset the disc covers a run of columns. Every cell is handed to
    the rows that reach it and added up there by run width; a frame along the
    row then sums each width over its run. A cell is copied once per row of the
    disc instead of once per neighbour, and no pairs are formed.
    """
    keys = keys or []
    reach = int(math.floor(radius / abs(grid.dy) + 1e-12))
    width_at = {}
    for d in range(-reach, reach + 1):
        rest = max(radius**2 - (d * grid.dy) ** 2, 0.0)
        width_at[d] = int(math.floor(math.sqrt(rest) / abs(grid.dx) + 1e-12))
    widths = sorted(set(width_at.values()))
    offsets = F.array(*[
        F.struct(F.lit(d).alias("d"), F.lit(w).alias("w")) for d, w in width_at.items()
    ])
    handed = cells.select(*keys, "row", "col", F.col(value).alias("_v"), F.explode(offsets).alias("_o"))
    lines = handed.groupBy(*keys, (F.col("row") + F.col("_o.d")).alias("row"), "col").agg(
        *[F.sum(F.when(F.col("_o.w") == w, F.col("_v"))).alias(f"_s{w}") for w in widths],
        *[F.count(F.when(F.col("_o.w") == w, F.col("_v"))).alias(f"_n{w}") for w in widths],
        F.bool_or(F.col("_o.d") == 0).alias("_own"),
        F.max(F.when(F.col("_o.d") == 0, F.col("_v"))).alias("value"),
    )
    margin = max(widths)
    touched = F.sequence(F.floor((F.col("col") - margin) / TILE), F.floor((F.col("col") + margin) / TILE))
    spread = lines.withColumn("tile", F.explode(touched))
    line = Window.partitionBy(*keys, "row", "tile").orderBy("col")
    summed = spread.select(
        *keys, "row", "col", "tile", "value", "_own",
        *[F.coalesce(F.sum(f"_s{w}").over(line.rangeBetween(-w, w)), F.lit(0.0)).alias(f"_s{w}") for w in widths],
        *[F.sum(f"_n{w}").over(line.rangeBetween(-w, w)).alias(f"_n{w}") for w in widths],
    ).where(F.col("_own") & (F.floor(F.col("col") / TILE) == F.col("tile")))
    total = sum((F.col(f"_s{w}") for w in widths[1:]), F.col(f"_s{widths[0]}"))
    n = sum((F.col(f"_n{w}") for w in widths[1:]), F.col(f"_n{widths[0]}"))
    return summed.select(
        *keys, "row", "col", "value", n.alias("n_near"), (total / F.nullif(n, F.lit(0))).alias("near_mean")
    )


def neighbour_pairs(cells: DataFrame, cls: str, keys: list[str] | None = None) -> DataFrame:
    """One row per adjacent pair (right and down): its two classes.

    Each cell also goes to the tile before it when it lies on the tile's first
    row or column; inside a tile the neighbour is the next cell of the line.
    """
    keys = keys or []
    base = cells.select(*keys, "row", "col", F.col(cls).alias("_k"))

    def along(line: str, step: str) -> DataFrame:
        tile = F.floor(F.col(step) / TILE)
        first = F.pmod(F.col(step), F.lit(TILE)) == 0
        spread = base.withColumn(
            "tile", F.explode(F.when(first, F.array(tile - 1, tile)).otherwise(F.array(tile)))
        )
        w = Window.partitionBy(*keys, line, "tile").orderBy(step)
        nxt = spread.withColumns({"_to": F.lead("_k").over(w), "_at": F.lead(step).over(w)})
        own = F.floor(F.col(step) / TILE) == F.col("tile")
        return nxt.where(own & (F.col("_at") == F.col(step) + 1)).select(
            *keys, F.col("_k").alias("a"), F.col("_to").alias("b")
        )

    return along("row", "col").unionByName(along("col", "row"))


def edge_density(cells: DataFrame, cls: str, keys: list[str] | None = None) -> DataFrame:
    """Share of adjacent pairs with unlike classes."""
    pairs = neighbour_pairs(cells, cls, keys).where("a is not null and b is not null")
    return pairs.groupBy(*(keys or [])).agg(
        F.count("*").alias("n_pairs"), F.count_if(F.col("a") != F.col("b")).alias("n_unlike"),
        F.avg((F.col("a") != F.col("b")).cast("double")).alias("edge_density"),
    )
