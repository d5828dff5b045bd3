"""Table schemas, as DDL text Spark parses."""

VERTEX = "STRUCT<x: DOUBLE, y: DOUBLE>"
GEOM = f"ARRAY<ARRAY<{VERTEX}>>"

REGION = (
    "uid STRING, scheme STRING, level STRING, code STRING, name STRING, "
    "bounds ARRAY<STRING>"
)

SOURCE = (
    "source STRING, provider STRING, type STRING, format STRING, product STRING, "
    "collection STRING, version STRING, coverage STRING, default_coverage STRING, "
    "coverage_map MAP<STRING, STRING>, coverage_path STRING, temporal_path STRING, "
    "base_url STRING, url_template STRING, local_glob STRING, cache_dir STRING, "
    "temporal STRUCT<kind: STRING, start_year: INT, end_year: INT, months: ARRAY<STRING>>, "
    "vars_active ARRAY<STRING>, "
    "vars MAP<STRING, STRUCT<var_name: STRING, var_units: STRING, active: BOOLEAN>>, "
    "notes STRING"
)

BOUNDS = (
    "uid STRING, code STRING, name STRING, xmin DOUBLE, ymin DOUBLE, "
    "xmax DOUBLE, ymax DOUBLE, area_km2 DOUBLE"
)

CELL = (
    "source STRING, var STRING, year INT, month STRING, band INT, "
    "row BIGINT, col BIGINT, value DOUBLE"
)

RASTER_META = (
    "source STRING, var STRING, year INT, month STRING, crs STRING, x0 DOUBLE, "
    "y0 DOUBLE, dx DOUBLE, dy DOUBLE, width BIGINT, height BIGINT, nodata DOUBLE"
)

ZONAL = "region_uid STRING, source STRING, variable STRING, stat STRING, value DOUBLE"
