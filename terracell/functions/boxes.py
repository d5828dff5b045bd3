"""Bounding boxes: STRUCT<xmin, ymin, xmax, ymax>."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$|^\s*[+-]?(?i:nan|inf|infinity)\s*$"
BOX_TYPE = "struct<xmin:double,ymin:double,xmax:double,ymax:double>"


def box(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    return F.struct(
        xmin.cast("double").alias("xmin"), ymin.cast("double").alias("ymin"),
        xmax.cast("double").alias("xmax"), ymax.cast("double").alias("ymax"),
    )


def coerce_bbox(items: Column) -> Column:
    """Box from an array of exactly four number texts, else NULL.

    The order of the corners is not checked.
    """
    as_number = lambda e: F.when(e.rlike(_NUMBER), e.try_cast("double"))
    usable = (F.size(items) == 4) & F.forall(items, lambda e: as_number(e).isNotNull())
    at = lambda i: as_number(F.get(items, F.lit(i)))
    return F.when(usable, box(at(0), at(1), at(2), at(3)))


def union_boxes(b: str = "bbox") -> Column:
    """Aggregate: the box around all boxes in column ``b``; NULL for none."""
    xmin = F.min(F.col(f"{b}.xmin"))
    return F.when(
        xmin.isNotNull(),
        box(xmin, F.min(F.col(f"{b}.ymin")), F.max(F.col(f"{b}.xmax")), F.max(F.col(f"{b}.ymax"))),
    )


def format_bbox(b: Column, precision: int = 5) -> Column:
    spec = ", ".join([f"%.{precision}f"] * 4)
    return F.format_string(
        f"[{spec}]", b.getField("xmin"), b.getField("ymin"), b.getField("xmax"), b.getField("ymax")
    )
