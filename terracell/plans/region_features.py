"""Zonal chain and the merged feature table per region."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas
from ..constants import DEFAULT_STATS
from ..functions.windows import Grid
from ..operators import dissolve as ds, zones as zn, zonal as zs
from ..operators.repair import repair_features
from ..sources.cells import write_table
from ..sources.polygons import read_regions


MAX_FEATURES = 5000  # columns a feature table may get


def label_by_region(cells: DataFrame, features: DataFrame, grid: Grid, key: str = "uid", repaired: bool = False) -> DataFrame:
    """Cells with the region that holds their centre.

    Rings of ``features`` may run either way: they are repaired first, unless ``repaired`` says they are.
    """
    clean = features if repaired else repair_features(features)
    return label_by_outline(cells, ds.feature_edges(clean, [key]), grid, key)


def label_by_outline(cells: DataFrame, outline: DataFrame, grid: Grid, key: str = "uid") -> DataFrame:
    """As ``label_by_region``, from edges: those of repaired features or the stored outline of dissolved regions."""
    return zn.label_cells(cells, zn.row_runs(outline, grid, key))


def run_zonal(spark: SparkSession, root: str, cells: DataFrame, grid: Grid, *, source: str, variable: str, stats: list[str] | None = None,
              layer: str = "regions", version: str | None = None, wanted: dict[str, list[str]] | None = None) -> None:
    """Zonal statistics of the regions stored below ``root`` and the features made of them, stored beside.

    Dissolved layers are labelled by their outline, others by their features.
    Writes ``zonal_stats`` and ``region_features``.
    """
    regions = read_regions(spark, root, layer, version)
    if "geom" in regions.columns:
        labelled = label_by_region(cells, regions, grid)
    else:
        labelled = label_by_outline(cells, read_regions(spark, root, f"{layer}_outline", version), grid)
    names = stats or DEFAULT_STATS
    write_table(zonal_table(labelled, "uid", F.lit(source), F.lit(variable), names), f"{root}/zonal_stats")
    stored = spark.read.schema(schemas.ZONAL).parquet(f"{root}/zonal_stats")
    write_table(pivot_features(stored, wanted or {variable: names}), f"{root}/region_features")


def zonal_table(labelled: DataFrame, key: str, source: Column, variable: Column, stats: list[str] | None = None) -> DataFrame:
    names = stats or DEFAULT_STATS
    return zs.to_long(zs.zonal_stats(labelled, [key], names), key, source, variable, names)


def definitions(table: DataFrame) -> dict[str, list[str]]:
    """variable → statistics, from a (variable, stat) definition table."""
    rows = table.select("variable", "stat").distinct().orderBy("variable", "stat").limit(MAX_FEATURES + 1).collect()
    if len(rows) > MAX_FEATURES:
        raise ValueError(f"more than {MAX_FEATURES} features are defined")
    wanted: dict[str, list[str]] = {}
    for r in rows:
        wanted.setdefault(r["variable"], []).append(r["stat"])
    return wanted


def pivot_features(long: DataFrame, wanted: dict[str, list[str]]) -> DataFrame:
    """One row per region with a ``variable_stat`` column for each definition.

    Every column is a conditional aggregate, so one shuffle serves all of them.
    """
    cols = [
        F.max(F.when((F.col("variable") == v) & (F.col("stat") == s), F.col("value"))).alias(f"{v}_{s}")
        for v, stats in wanted.items() for s in stats
    ]
    return long.groupBy("region_uid").agg(*cols)


def merge_features(tables: list[DataFrame], on: list[str]) -> DataFrame:
    """Feature tables joined on the region (and period); absent ones give NULL."""
    return reduce(lambda a, b: a.join(b, on, "full"), tables)
