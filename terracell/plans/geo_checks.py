"""The checks of the geo stage in one table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..constants import WORKING_CRS
from ..functions.crs import same_crs
from ..operators import qa
from ..operators.joins import lookup_join

CHECKS = ("crs", "bounds", "nodata")


def run_checks(
    meta: DataFrame, cells: DataFrame, bounds: DataFrame, check: str = "all", crs: str = WORKING_CRS,
    nodata_limit: float = 0.5,
) -> DataFrame:
    """(check, entity, status, detail) for one check or all of them.

    ``meta`` is raster metadata, ``cells`` the cell table with the same raster
    keys, ``bounds`` the region bounds. A region outside the joint extent of the
    rasters is a warning, one without bounds fails; a region is reported once.
    """
    if check != "all" and check not in CHECKS:
        raise ValueError(f"unknown check {check!r}; use all or one of {CHECKS}")
    wanted = CHECKS if check == "all" else (check,)
    keys = ["source", "var", "year", "month"]
    raster = F.concat_ws("/", *keys)
    parts = []
    if "crs" in wanted:
        parts.append(qa.finding(meta, "crs", raster, qa.verdict(~same_crs(F.col("crs"), crs)), F.col("crs")))
    if "bounds" in wanted:
        far_x, far_y = F.col("x0") + F.col("dx") * F.col("width"), F.col("y0") + F.col("dy") * F.col("height")
        extent = meta.agg(
            F.min(F.least("x0", far_x)).alias("xmin"), F.min(F.least("y0", far_y)).alias("ymin"),
            F.max(F.greatest("x0", far_x)).alias("xmax"), F.max(F.greatest("y0", far_y)).alias("ymax"),
        )
        e = lambda c: extent.select(c).scalar()
        within = (F.col("xmin") >= e("xmin")) & (F.col("ymin") >= e("ymin")) & (F.col("xmax") <= e("xmax")) & (F.col("ymax") <= e("ymax"))
        marked = bounds.groupBy("uid").agg(F.max(within.isNull()).alias("unknown"), F.min(F.coalesce(within, F.lit(True))).alias("within"))
        parts.append(qa.finding(marked, "bounds", F.col("uid"), qa.verdict(F.col("unknown"), ~F.col("within")), F.lit(None)))
    if "nodata" in wanted:
        nodata = meta.select(*keys, "nodata")
        shares = qa.nodata_shares(lookup_join(cells, nodata, keys, "left"), keys, F.col("nodata"), nodata_limit)
        parts.append(qa.finding(shares, "nodata", raster, F.col("status"), F.round("nodata_share", 6)))
    return qa.all_findings(*parts)
