"""Which cells lie in which region.

A region becomes runs of columns per raster row (a scan-line fill), and cells
find their runs by an equi-join on (row, column tile) plus a column range. The
runs grow with the outline and the rows a region spans, not with its cells, so
they are usually small enough to broadcast and the cell table is not shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..constants import TILE
from ..functions.windows import Grid
from .joins import lookup_join


def _depth_runs(edges: DataFrame, grid: Grid, key: str) -> DataFrame:
    """Runs (key, row, col_lo, col_hi, depth): how many features lie over each run.

    An edge crosses the rows whose centre lies in [min y, max y); from there on,
    to the right, the depth changes by the edge's direction. Crossings are added
    up by the first column they affect, so edges shared by neighbours cancel in
    the map-side aggregation and the window sees at most a value per column of
    one raster row and region.
    """
    r1 = (F.col("y1") - grid.y0) / grid.dy - 0.5
    r2 = (F.col("y2") - grid.y0) / grid.dy - 0.5
    lo, hi = F.greatest(F.floor(F.least(r1, r2)), F.lit(0)), F.ceil(F.greatest(r1, r2))
    if grid.height is not None:
        hi = F.least(hi, F.lit(grid.height - 1))
    sloped = edges.where((F.col("y1") != F.col("y2")) & F.col(key).isNotNull()).withColumns(
        {"_lo": lo, "_hi": hi}
    )
    rows = sloped.where("_lo <= _hi").withColumn("row", F.explode(F.sequence("_lo", "_hi")))
    y = grid.y(F.col("row"))
    x = F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    first = F.greatest(F.ceil((x - grid.x0) / grid.dx - 0.5), F.lit(0))
    if grid.width is not None:
        first = F.least(first, F.lit(grid.width))
    turns = rows.where((F.col("y1") > y) != (F.col("y2") > y)).select(
        key, "row", first.alias("col_lo"), F.when(F.col("y2") > F.col("y1"), 1).otherwise(-1).alias("turn")
    ).groupBy(key, "row", "col_lo").agg(F.sum("turn").alias("turn")).where("turn <> 0")
    along = Window.partitionBy(key, "row").orderBy("col_lo")
    return turns.select(
        key, "row", "col_lo", (F.lead("col_lo").over(along) - 1).alias("col_hi"),
        F.abs(F.sum("turn").over(along)).alias("depth"),
    ).where("depth > 0 and col_hi is not null")


def row_runs(edges: DataFrame, grid: Grid, key: str = "uid") -> DataFrame:
    """Runs (key, row, tile, col_lo, col_hi) of cells whose centre is inside.

    A cell is inside where the depth is not zero, so the union of overlapping or
    repeated features is exact.
    """
    return _depth_runs(edges, grid, key).select(
        key, "row", "col_lo", "col_hi",
        F.explode(F.sequence(_tile("col_lo"), _tile("col_hi"))).alias("tile"),
    )


def coverage(edges: DataFrame, grid: Grid, key: str = "uid") -> DataFrame:
    """Cells inside each region and how many of them several features cover.

    Flags regions whose features overlap, at the resolution of the grid; for
    those the summed polygon area is an upper bound and ``n_cells`` times the
    cell area the estimate that counts shared ground once.
    """
    length = F.col("col_hi") - F.col("col_lo") + 1
    return _depth_runs(edges, grid, key).groupBy(key).agg(
        F.sum(length).alias("n_cells"), F.sum(F.when(F.col("depth") > 1, length).otherwise(0)).alias("n_overlap")
    )


def _tile(column: str):
    return F.floor(F.col(column) / TILE)


def label_cells(cells: DataFrame, runs: DataFrame) -> DataFrame:
    """Cells with the key of every region that holds them."""
    keyed = cells.withColumn("tile", _tile("col"))
    inside = F.col("col").between(F.col("col_lo"), F.col("col_hi"))
    return lookup_join(keyed, runs, ["row", "tile"], extra=inside).drop("tile", "col_lo", "col_hi")


def box_tiles(boxes: DataFrame, grid: Grid, keys: list[str]) -> DataFrame:
    """Row and column ranges of boxes (xmin..ymax), cut by tile.

    A cell belongs to a box when its centre does, borders included.
    """
    rows = [(F.col(c) - grid.y0) / grid.dy - 0.5 for c in ("ymin", "ymax")]
    cols = [(F.col(c) - grid.x0) / grid.dx - 0.5 for c in ("xmin", "xmax")]
    ranges = boxes.select(
        *keys,
        F.greatest(F.ceil(F.least(*rows)), F.lit(0)).alias("row_lo"), F.floor(F.greatest(*rows)).alias("row_hi"),
        F.greatest(F.ceil(F.least(*cols)), F.lit(0)).alias("col_lo"), F.floor(F.greatest(*cols)).alias("col_hi"),
    ).where("row_lo <= row_hi and col_lo <= col_hi")
    by_row = ranges.withColumn("row_tile", F.explode(F.sequence(_tile("row_lo"), _tile("row_hi"))))
    return by_row.withColumn("tile", F.explode(F.sequence(_tile("col_lo"), _tile("col_hi"))))


def cells_in_boxes(cells: DataFrame, tiles: DataFrame) -> DataFrame:
    """Cells with the keys of every box that holds them."""
    keyed = cells.withColumns({"row_tile": _tile("row"), "tile": _tile("col")})
    inside = F.col("row").between(F.col("row_lo"), F.col("row_hi")) & F.col("col").between(
        F.col("col_lo"), F.col("col_hi")
    )
    joined = lookup_join(keyed, tiles, ["row_tile", "tile"], extra=inside)
    return joined.drop("row_tile", "tile", "row_lo", "row_hi", "col_lo", "col_hi")
