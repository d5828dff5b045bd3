"""Raster cell tables: partitioned Parquet, one row per cell."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas
from ..constants import TILE

RASTER_KEYS = ["source", "var", "year", "month"]
MANIFEST = "_rasters"


def read_cells(
    spark: SparkSession,
    path: str,
    source: str | None = None,
    var: str | None = None,
    years: tuple[int, int] | None = None,
    months: list[str] | None = None,
    rows: tuple[int, int] | None = None,
    cols: tuple[int, int] | None = None,
) -> DataFrame:
    """Scan only the wanted rasters (partition filter) and the wanted window
    (row and column ranges, pushed down to the row groups)."""
    df = spark.read.schema(schemas.CELL).parquet(path)
    return select_cells(df, source, var, years, months, rows, cols)


def select_cells(df, source=None, var=None, years=None, months=None, rows=None, cols=None) -> DataFrame:
    tests: list[Column] = []
    if source is not None:
        tests.append(F.col("source") == source)
    if var is not None:
        tests.append(F.col("var") == var)
    if years is not None:
        tests.append(F.col("year").between(*years))
    if months is not None:
        tests.append(F.col("month").isin(list(months)))
    if rows is not None:
        tests.append(F.col("row").between(*rows))
    if cols is not None:
        tests.append(F.col("col").between(*cols))
    for t in tests:
        df = df.where(t)
    return df


def write_cells(df: DataFrame, path: str, overwrite: bool = False, keys: list[str] | None = None) -> None:
    """One folder per raster. Rows are ordered by tile inside each file, so a
    window read skips row groups; ``overwrite`` replaces only the rasters
    present in ``df``, without it a raster that is there already is an error.
    A large raster is spread over several files by row tile. The rasters stored are listed in a
    manifest beside them, so that finding out costs no look at the cells.
    """
    keys = keys or RASTER_KEYS
    before = read_manifest(df.sparkSession, path)
    if not overwrite:
        _refuse_present(df, before if before is not None else _stored(df, path), path, keys)
    tile_row = F.floor(F.col("row") / TILE)
    tile_col = F.floor(F.col("col") / TILE)
    laid_out = df.repartition(*keys, tile_row).sortWithinPartitions(*keys, tile_row, tile_col, "row", "col")
    writer = laid_out.write.partitionBy(*keys)
    if overwrite:
        writer = writer.option("partitionOverwriteMode", "dynamic").mode("overwrite")
    else:
        writer = writer.mode("append")
    writer.parquet(path)
    _list_rasters(df, path, keys, before)


def write_region_clips(clips: DataFrame, path: str) -> None:
    """Per-region clipped rasters: ``source=…/region_uid=…/var=…/year=…/month=…`` folders.

    Writing one variable or month of a region leaves its others as they are.
    """
    write_cells(clips, path, overwrite=True, keys=["source", "region_uid", "var", "year", "month"])


def _found(read):
    """The table, or None where its path does not exist."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _stored(df: DataFrame, path: str) -> DataFrame | None:
    return _found(lambda: df.sparkSession.read.schema(df.schema).parquet(path))


def read_manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """The raster keys stored below ``path`` in their last version, or None without a manifest.

    Its name begins with an underscore, so readers of the cells pass over it.
    """
    versions = _found(lambda: spark.read.parquet(f"{path}/{MANIFEST}"))
    if versions is None:
        return None
    last = versions.agg(F.max("version")).first()[0]
    return versions.where(F.col("version") == last)


def _list_rasters(df: DataFrame, path: str, keys: list[str], before: DataFrame | None) -> None:
    """Write the next version of the manifest, from the folders that are there now; older versions stay."""
    folders = _stored(df, path).select(*keys).distinct()
    version = 0 if before is None else before.agg(F.max("version")).first()[0] + 1
    folders.write.mode("append").parquet(f"{path}/{MANIFEST}/version={version}")


def _refuse_present(df: DataFrame, stored: DataFrame | None, path: str, keys: list[str]) -> None:
    """Raise if a raster of ``df`` is among those stored below ``path``."""
    if stored is None:
        return
    again = df.select(*keys).distinct().join(stored.select(*keys).distinct(), keys, "left_semi").orderBy(*keys).first()
    if again:
        raise ValueError(f"{path} already holds {again.asDict()}")


def write_meta(meta: DataFrame, path: str) -> None:
    """Add raster_meta rows: one per (source, var, year, month); rows of a raster that is there already are an error."""
    if not meta.groupBy(*RASTER_KEYS).count().where("count > 1").isEmpty():
        raise ValueError("several metadata rows for one raster")
    _refuse_present(meta, _stored(meta, path), path, RASTER_KEYS)
    meta.write.mode("append").parquet(path)


def read_meta(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RASTER_META).parquet(path)


def write_table(df: DataFrame, path: str, overwrite: bool = True) -> None:
    """Zonal statistics and region features."""
    df.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)
