"""Region and source catalogs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions.boxes import coerce_bbox, union_boxes


def _read_strict(spark: SparkSession, path: str, schema: str, fmt: str, key: str, multi_line: bool) -> DataFrame:
    """Read with a fixed schema; a malformed record or an empty catalog fails."""
    if fmt not in ("json", "parquet"):
        raise ValueError(f"unsupported catalog format {fmt!r}")
    reader = spark.read.schema(schema)
    if fmt == "json":
        reader = reader.option("mode", "FAILFAST").option("multiLine", multi_line)
    df = reader.format(fmt).load(path)
    if df.where(F.col(key).isNotNull()).isEmpty():
        raise ValueError(f"no catalog entries with a {key!r} in {path}")
    return df


def load_regions(spark: SparkSession, path: str, fmt: str = "json", multi_line: bool = False) -> DataFrame:
    """Region definitions: JSON lines, one JSON array per file (``multi_line``) or Parquet."""
    return _read_strict(spark, path, schemas.REGION, fmt, "uid", multi_line)


def load_sources(spark: SparkSession, path: str, fmt: str = "json", multi_line: bool = False) -> DataFrame:
    return _read_strict(spark, path, schemas.SOURCE, fmt, "source", multi_line)


def source_variables(sources: DataFrame) -> DataFrame:
    """One row per (source, variable); ``listed`` tells whether vars_active names it."""
    return sources.select(
        "source", F.coalesce("vars_active", F.array().cast("array<string>")).alias("_active"),
        F.explode("vars").alias("var", "def"),
    ).select(
        "source", "var", "def.var_name", "def.var_units",
        F.coalesce("def.active", F.lit(False)).alias("active"),
        F.array_contains("_active", F.col("var")).alias("listed"),
    )


def resolve_aoi(regions: DataFrame, top_level: list | None = None) -> DataFrame:
    """One-row table with the area of interest ``bbox``.

    A valid top-level box wins; else the union of the valid region boxes; NULL
    when there is none.
    """
    union = regions.select(coerce_bbox(F.col("bounds")).alias("bbox")).agg(union_boxes().alias("u"))
    if top_level is None:
        return union.select(F.col("u").alias("bbox"))
    top = coerce_bbox(F.array(*[F.lit(None if v is None else str(v)) for v in top_level]))
    return union.select(F.coalesce(top, F.col("u")).alias("bbox"))


def require_aoi(aoi: DataFrame) -> DataFrame:
    """The same row, or a failed job when no box was found."""
    message = F.raise_error(F.lit("no area of interest: give bounds or region bounds"))
    return aoi.select(
        F.when(F.col("bbox").isNull(), message.cast("string")).alias("_guard"), "bbox"
    ).where(F.col("_guard").isNull()).select("bbox")
