"""Raster windows: which rows and columns of a grid a box covers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Grid:
    """North-up raster grid; ``height`` or ``width`` None means open-ended."""

    x0: float
    y0: float
    dx: float
    dy: float
    width: int | None = None
    height: int | None = None
    crs: str = "EPSG:4326"
    nodata: float | None = None

    def x(self, col: Column) -> Column:
        return (col + 0.5) * self.dx + self.x0

    def y(self, row: Column) -> Column:
        return (row + 0.5) * self.dy + self.y0

    def window(self, bbox: Column) -> Column:
        return window_of(
            bbox, F.lit(self.x0), F.lit(self.y0), F.lit(self.dx), F.lit(self.dy)
        )


def window_of(bbox: Column, x0: Column, y0: Column, dx: Column, dy: Column) -> Column:
    """Window of a box: offsets rounded down, lengths rounded up, independently.

    ``dy`` may be negative (rows run south). The window may reach outside the
    raster.
    """
    left = F.least((bbox.getField("xmin") - x0) / dx, (bbox.getField("xmax") - x0) / dx)
    top = F.least((bbox.getField("ymin") - y0) / dy, (bbox.getField("ymax") - y0) / dy)
    across = F.abs((bbox.getField("xmax") - bbox.getField("xmin")) / dx)
    down = F.abs((bbox.getField("ymax") - bbox.getField("ymin")) / dy)
    return F.struct(
        F.floor(left).alias("col_off"), F.floor(top).alias("row_off"),
        F.ceil(across).alias("width"), F.ceil(down).alias("height"),
    )


def window_origin(win: Column, x0: Column, y0: Column, dx: Column, dy: Column) -> Column:
    """Upper-left corner of a window, the transform of the clipped raster."""
    return F.struct(
        (x0 + win.getField("col_off") * dx).alias("x0"),
        (y0 + win.getField("row_off") * dy).alias("y0"),
    )
