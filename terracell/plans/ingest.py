"""From a plan to stored clips: window, fill, drop, write, report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.windows import window_of
from ..operators.clip import clipped_meta, drop_empty_windows
from ..operators.joins import lookup_join
from ..session import materialize
from ..sources.cells import RASTER_KEYS, read_manifest, write_cells, write_meta


def run_ingest(plan: DataFrame, cells: DataFrame, meta: DataFrame, aoi: DataFrame, root: str) -> DataFrame:
    """Clip the rasters of ``plan`` to the area of interest and store them; what became of each.

    ``plan`` has the raster keys, ``meta`` the georeference and nodata of every
    raster, ``aoi`` one row with ``bbox``. A clip covers the whole window, cells
    outside the raster are filled with nodata (0 without one). Clips of nothing but nodata
    are left out. Cells go below ``root``/cells, metadata of the clips to
    ``root``/meta. The result is ``plan`` with ``status``: written, empty,
    present (stored before and left alone) or missing (no such raster).
    """
    keys = RASTER_KEYS
    spark = plan.sparkSession
    stored = read_manifest(spark, f"{root}/cells")
    asked = materialize(plan.select(*keys).distinct(), "plan")
    open_ = asked if stored is None else asked.join(stored, keys, "left_anti")
    box = aoi.select("bbox").scalar()
    rasters = materialize(lookup_join(meta, open_, keys, "left_semi").withColumn(
        "win", window_of(box, *[F.col(c) for c in ("x0", "y0", "dx", "dy")])), "rasters")
    window = rasters.select(*keys, "win", "nodata")
    within = F.col("row").between(F.col("win.row_off"), F.col("win.row_off") + F.col("win.height") - 1) & F.col("col").between(
        F.col("win.col_off"), F.col("win.col_off") + F.col("win.width") - 1)
    inside = lookup_join(cells, window.select(*keys, "win"), keys, extra=within).select(*keys, "band", "row", "col", "value")
    rows = window.select(*keys, "nodata", "win", F.explode(F.sequence(
        F.col("win.row_off"), F.col("win.row_off") + F.col("win.height") - 1)).alias("row")).repartition(*keys, "row")
    full = rows.select(*keys, "nodata", "row", F.explode(F.sequence(
        F.col("win.col_off"), F.col("win.col_off") + F.col("win.width") - 1)).alias("col"))
    filled = materialize(full.join(inside, [*keys, "row", "col"], "left").select(
        *keys, F.coalesce("band", F.lit(1)).alias("band"), "row", "col",
        F.coalesce("value", "nodata", F.lit(0.0)).alias("value"), "nodata"), "filled")
    kept = drop_empty_windows(filled, keys, F.col("nodata"))
    write_cells(kept.drop("nodata"), f"{root}/cells")
    written = materialize(kept.select(*keys).distinct(), "written")
    write_meta(clipped_meta(lookup_join(rasters.drop("win"), written, keys, "left_semi"), box).drop("win"), f"{root}/meta")
    marks = written.withColumn("status", F.lit("written")).unionByName(
        rasters.select(*keys).join(written, keys, "left_anti").withColumn("status", F.lit("empty")))
    if stored is not None:
        marks = marks.unionByName(asked.join(stored, keys, "left_semi").withColumn("status", F.lit("present")))
    return plan.join(marks, keys, "left").withColumn("status", F.coalesce("status", F.lit("missing")))
