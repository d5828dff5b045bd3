"""Polygon layers, bounds tables and their files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions.crs import crs_code


def read_features(spark: SparkSession, path: str, fmt: str = "parquet", crs: str | None = None) -> DataFrame:
    """Polygon features; ``fmt`` is parquet (geom and crs columns) or geojsonl
    (one GeoJSON feature per line, properties become columns).

    An empty layer is refused at once; a row without a CRS stops the job that
    reads it.
    """
    if fmt == "parquet":
        df = spark.read.parquet(path)
    elif fmt == "geojsonl":
        df = _from_geojson(spark.read.text(path), crs)
    else:
        raise ValueError(f"unsupported polygon format {fmt!r}")
    if df.isEmpty():
        raise ValueError(f"no features in {path}")
    return require_crs(df)


def require_crs(df: DataFrame) -> DataFrame:
    missing = F.raise_error(F.lit("polygon layer has rows without a CRS"))
    return df.withColumn("crs", F.when(F.col("crs").isNull(), missing.cast("string")).otherwise(F.col("crs")))


def layer_crs(features: DataFrame) -> str:
    """The one reference system all features of a layer are in."""
    found = sorted(r[0] for r in require_crs(features).select(crs_code(F.col("crs")).alias("c")).distinct().limit(3).collect())
    if len(found) != 1:
        raise ValueError(f"a layer needs one CRS, not {found or 'none'}")
    return found[0]


def _from_geojson(lines: DataFrame, crs: str | None) -> DataFrame:
    """A column per property of any feature, as text; of properties that differ in case only, the first keeps its name.

    The CRS is the feature's own, else ``crs``, else geographic degrees.
    """
    point, ring = "ARRAY<DOUBLE>", "ARRAY<ARRAY<DOUBLE>>"
    head = F.from_json(
        "value", "STRUCT<id: BIGINT, geometry: STRUCT<type: STRING, coordinates: STRING>, properties: MAP<STRING, STRING>, "
        "crs: STRUCT<properties: STRUCT<name: STRING>>>",
        {"mode": "FAILFAST"},
    )
    df = lines.where(F.trim("value") != "").select(head.alias("f"))
    text = F.col("f.geometry.coordinates")
    polygon = F.from_json(text, f"ARRAY<{ring}>")
    multi = F.flatten(F.from_json(text, f"ARRAY<ARRAY<{ring}>>"))
    rings = F.when(F.col("f.geometry.type") == "MultiPolygon", multi).otherwise(polygon)
    geom = F.transform(
        rings,
        lambda r: F.transform(
            r, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))
        ),
    )
    own = {"feature_id", "geom", "crs"}
    names = [r[0] for r in df.select(F.explode(F.map_keys("f.properties")).alias("k")).distinct().orderBy("k").collect()]
    columns = []
    for name in names:  # as many as the layer has attributes
        title = f"{name}_" if name.lower() in own else name
        own.add(title.lower())
        columns.append(F.try_element_at("f.properties", F.lit(name)).alias(title))
    return df.select(
        F.col("f.id").alias("feature_id"), *columns, geom.alias("geom"),
        F.coalesce(crs_code(F.col("f.crs.properties.name")), F.lit(crs or "EPSG:4326")).alias("crs"),
    )


def layer_path(root: str, layer: str, version: str | None = None) -> str:
    base = f"{root.rstrip('/')}/version={version}" if version else root.rstrip("/")
    return f"{base}/layer={layer}"


def write_regions(
    df: DataFrame, root: str, layer: str = "regions", version: str | None = None, overwrite: bool = True
) -> str:
    """Write one layer. A versioned layer is never replaced."""
    mode = "overwrite" if overwrite and version is None else "errorifexists"
    path = layer_path(root, layer, version)
    df.write.mode(mode).parquet(path)
    return path


def read_regions(spark: SparkSession, root: str, layer: str = "regions", version: str | None = None) -> DataFrame:
    return spark.read.parquet(layer_path(root, layer, version))


def write_bounds(bounds: DataFrame, path: str, overwrite: bool = True) -> None:
    bounds.to(_struct(bounds.sparkSession, schemas.BOUNDS)).write.mode(
        "overwrite" if overwrite else "errorifexists"
    ).parquet(path)


def read_bounds(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.BOUNDS).parquet(path)


def write_qa_csv(regions: DataFrame, path: str | None) -> None:
    """All columns but the geometry; nothing when no path is given."""
    if path:
        flat = regions.drop("geom")
        flat.write.mode("overwrite").option("header", True).csv(path)


def _struct(spark: SparkSession, ddl: str):
    return spark.createDataFrame([], ddl).schema
