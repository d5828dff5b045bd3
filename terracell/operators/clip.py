"""Cutting cell tables to windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.windows import window_of, window_origin
from .joins import lookup_join


def clip_to_window(cells: DataFrame, window: DataFrame) -> DataFrame:
    """Cells inside the one-row ``window`` table (column ``win``); no filling.

    The window is a scalar subquery, so the scan gets plain row and column
    bounds instead of a join.
    """
    bound = lambda e: window.select(e).scalar()
    win = F.col("win")
    row_lo, col_lo = bound(win.getField("row_off")), bound(win.getField("col_off"))
    row_hi = bound(win.getField("row_off") + win.getField("height") - 1)
    col_hi = bound(win.getField("col_off") + win.getField("width") - 1)
    return cells.where(F.col("row").between(row_lo, row_hi) & F.col("col").between(col_lo, col_hi))


def window_cells(window: DataFrame, rasters: DataFrame | None = None) -> DataFrame:
    """Every (row, col) of the one-row ``window`` table, for each row of ``rasters``.

    Window rows are spread over the cluster before each is expanded into its
    columns, so no task holds a whole window.
    """
    win = F.col("win")
    if rasters is None:
        rasters, keys = window.select(win), []
    else:
        keys = rasters.columns
        rasters = rasters.withColumn("win", window.select(win).scalar())
    rows = rasters.select(
        *keys,
        F.explode(F.sequence(F.col("win.row_off"), F.col("win.row_off") + F.col("win.height") - 1)).alias("row"),
        F.col("win.col_off").alias("_c"), F.col("win.width").alias("_w"),
    )
    return rows.repartition(*keys, "row").select(
        *keys, "row", F.explode(F.sequence(F.col("_c"), F.col("_c") + F.col("_w") - 1)).alias("col")
    )


def boundless_clip(cells: DataFrame, window: DataFrame, nodata: float | None, keys: list[str] | None = None) -> DataFrame:
    """Clip in which cells outside the raster are filled with nodata (0 without one).

    ``keys`` identify a raster; each raster present in ``cells`` gets the full
    window.
    """
    keys = keys or []
    full = window_cells(window, cells.select(*keys).distinct() if keys else None)
    inside = clip_to_window(cells, window)
    fill = F.lit(0.0 if nodata is None else float(nodata))
    return full.join(inside, [*keys, "row", "col"], "left").withColumn("value", F.coalesce("value", fill))


def drop_empty_windows(cells: DataFrame, keys: list[str], nodata: Column) -> DataFrame:
    """Without the windows (``keys``) in which every value is nodata.

    ``nodata`` may be NULL (nothing is dropped) or NaN (NaN equals NaN here).
    The flags are partially aggregated, and the keys to drop go to the cells,
    which are not moved unless those keys take too many bytes to send.
    """
    empty = cells.groupBy(*keys).agg(
        F.bool_and(F.col("value").eqNullSafe(nodata) & nodata.isNotNull()).alias("_empty")
    ).where("_empty").drop("_empty")
    return lookup_join(cells, empty, keys, "left_anti")


def clipped_meta(meta: DataFrame, bbox: Column) -> DataFrame:
    """Raster metadata of the clip: new origin, width and height per raster."""
    geo = [F.col(c) for c in ("x0", "y0", "dx", "dy")]
    win = meta.withColumn("win", window_of(bbox, *geo))
    moved = win.withColumn("_o", window_origin(F.col("win"), *geo))
    return moved.withColumns(
        {"x0": F.col("_o.x0"), "y0": F.col("_o.y0"),
         "width": F.col("win.width"), "height": F.col("win.height")}
    ).drop("_o")


def nodata_to_null(cells: DataFrame, nodata: Column) -> DataFrame:
    same = F.col("value").eqNullSafe(nodata)
    return cells.withColumn("value", F.when(~same | nodata.isNull(), F.col("value")))

