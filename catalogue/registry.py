"""Region selection, polygons and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from terracell.functions import boxes as bx, crs, rings as rg
from terracell.functions.codes import normalize_code
from terracell.operators import dissolve as ds, regions as ops, repair as rp
from terracell.operators.junctions import split_edges
from terracell.plans.prep_regions import prepare_regions
from terracell.session import scratch_path
from terracell.sources import catalog, polygons as layers

from . import standins as st

SCHEME = "ASIA"


def _raw_code():
    k, n = F.col("c_custkey") % 6, st.text("c_nationkey")
    return (
        F.when(k == 0, F.concat(F.lit(" 0"), n)).when(k == 1, F.concat(n, F.lit("h")))
        .when(k == 2, F.concat(F.lit("000"), n, F.lit(" x"))).when(k == 3, F.concat(F.lit("-"), n))
        .when(k == 4, F.lit(" "))
    )


_RAW_SQL = """raw AS (
  SELECT c_custkey, c_mktsegment, CASE c_custkey % 6 WHEN 0 THEN ' 0' || c_nationkey WHEN 1 THEN c_nationkey || 'h'
    WHEN 2 THEN '000' || c_nationkey || ' x' WHEN 3 THEN '-' || c_nationkey WHEN 4 THEN ' ' END AS raw FROM customer),
tok AS (SELECT *, coalesce(regexp_extract(raw, '[A-Za-z0-9]+'), '') AS t FROM raw),
norm AS (SELECT *, CASE WHEN regexp_matches(t, '^[0-9]+$') THEN regexp_replace(t, '^0+([0-9])', '\\1') ELSE t END AS code FROM tok)"""


def code_normalize(spark, sf):
    return st.table(spark, sf, "customer").select("c_custkey", normalize_code(_raw_code()).alias("code"))


def region_select(spark, sf):
    wanted = ops.wanted_regions(st.regions(spark, sf), SCHEME, 3)
    return ops.select_features(st.polygons(spark, sf), wanted, SCHEME, 3).select(
        "feature_id", "uid", "scheme", "level", "code", "name"
    )


def dup_codes(spark, sf):
    rows = st.table(spark, sf, "customer").select(F.col("c_mktsegment").alias("scheme"), normalize_code(_raw_code()).alias("code"))
    return ops.duplicate_codes(rows.where("code <> ''"), ["scheme"])


def wanted_codes(spark, sf):
    return ops.wanted_codes(st.table(spark, sf, "customer").select(_raw_code().alias("code")))


def missing_codes(spark, sf):
    wanted = st.table(spark, sf, "customer").select(normalize_code(st.text(F.col("c_custkey") % 30)).alias("code"))
    return ops.missing_codes(wanted, st.polygons(spark, sf))


def code_sample(spark, sf):
    return ops.code_sample(st.table(spark, sf, "customer").select(_raw_code().alias("raw")), "raw")


def code_field_scores(spark, sf):
    k = F.col("p_size") % 8
    names = ["US_L3CODE", "NA_L3CODE", "L3_KEY", "US_L3NAME", "OBJECTID", "REGION_LABEL", "LEVEL3_DESC"]
    column = F.lit(None).cast("string")
    for i, n in enumerate(names):
        column = F.when(k == i, n).otherwise(column)
    column = F.coalesce(column, F.concat(F.lit("eco_"), F.lower("p_type")))
    columns = st.table(spark, sf, "part").select(
        F.concat(F.lit("layer_"), st.text(F.floor(F.col("p_partkey") / 4))).alias("dataset"), column.alias("column")
    )
    return ops.best_code_fields(columns)


def coerce_bbox(spark, sf):
    return st.boxes(spark, sf).select(
        "vec_id", "i", bx.coerce_bbox(F.col("bounds")).alias("b")
    ).select("vec_id", "i", F.col("b").isNotNull().alias("valid"), bx.format_bbox(F.col("b")).alias("shown"))


def union_bbox(spark, sf):
    b = st.boxes(spark, sf).select("label", bx.coerce_bbox(F.col("bounds")).alias("bbox"))
    return b.groupBy("label").agg(bx.union_boxes().alias("u")).select("label", "u.*")


def aoi_resolve(spark, sf):
    aoi = catalog.require_aoi(catalog.resolve_aoi(st.boxes(spark, sf)))
    return aoi.select("bbox.*", bx.format_bbox(F.col("bbox")).alias("shown"))


def region_bounds(spark, sf):
    return ops.region_bounds(st.polygons(spark, sf), ["code"])


def feature_bounds(spark, sf):
    wanted = ops.wanted_regions(st.regions(spark, sf), SCHEME, 3)
    return ops.feature_bounds(ops.select_features(st.polygons(spark, sf), wanted, SCHEME, 3))


def dissolve_edges(spark, sf):
    outline = ds.dissolve_outline(ds.feature_edges(st.polygons(spark, sf), ["code"]), "code")
    return ds.edge_measures(outline, ["code"])


def dissolve_by_name(spark, sf):
    """Bounds of each region name after uniting all its polygons."""
    named = st.polygons(spark, sf).join(st.regions(spark, sf).select(
        normalize_code(F.col("code")).alias("code"), F.col("scheme").alias("name")), "code")
    outline = ds.dissolve_outline(ds.feature_edges(named, ["name"]), "name")
    return ds.edge_measures(outline, ["name"]).select("name", "xmin", "ymin", "xmax", "ymax", "n_edges")


def outline_rings(spark, sf):
    outline = ds.dissolve_outline(ds.feature_edges(st.polygons(spark, sf), ["code"]), "code")
    rings = ds.outline_rings(outline, "code")
    return rings.groupBy("code").agg(
        F.count_distinct("ring").alias("n_rings"), F.count("*").alias("n_vertices"), F.max("pos").alias("last_pos")
    )


def _bricks(spark, sf):
    """Cells of the raster grid as polygons, in every other row as bricks of two: T-junctions along the rows."""
    c = st.cells(spark, sf).join(st.table(spark, sf, "customer").select(F.col("c_custkey").alias("cell_id"), "c_nationkey"), "cell_id")
    x, y, v = F.col("col"), F.col("row"), st.vertex
    wide = F.when(y % 2 == 0, 2).otherwise(1)
    ring = F.array(v(x, y), v(x + wide, y), v(x + wide, y + 1), v(x, y + 1), v(x, y))
    return c.where("row % 2 = 1 OR col % 2 = 0").select((F.col("c_nationkey") % 3).alias("code"), F.array(ring).alias("geom"))


def dissolve_t_junction(spark, sf):
    edges = split_edges(ds.feature_edges(_bricks(spark, sf), ["code"]), "code")
    return ds.edge_measures(ds.dissolve_outline(edges, "code"), ["code"]).drop("n_edges")


def nested_rings(spark, sf):
    """Shells, holes and islands of each nation, drawn in either direction."""
    signed = F.transform("geom", rg.signed_area)
    return rp.repair_features(st.nested(spark, sf)).select(
        "code", F.size("geom").alias("n_rings"), F.size(F.filter(signed, lambda s: s > 0)).alias("n_shells"),
        F.round(F.aggregate(signed, F.lit(0.0), lambda a, b: a + b), 6).alias("area"))


def prepared_regions_albers(spark, sf):
    """As prepared_regions, from a layer whose own CRS is the equal-area one."""
    to_flat = lambda x, y: crs.reproject(x, y, "EPSG:4326", "EPSG:5070")
    features = st.geo_polygons(spark, sf).withColumn("geom", rg.map_vertices(F.col("geom"), to_flat)).withColumn("crs", F.lit("epsg:5070"))
    present = features.select(F.lpad("code", 2, "0").alias("code"))
    wanted = st.regions(spark, sf).join(present, "code", "left_semi")
    b = prepare_regions(wanted, features.drop("code"), scheme=SCHEME).bounds
    return b.select("uid", "code", "name", *[F.round(c, 6).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")],
                    F.round("area_km2", 3).alias("area_km2"))


def polygon_area_km2(spark, sf):
    edges = ds.feature_edges(st.geo_polygons(spark, sf), ["feature_id", "code"])
    area = ds.area_km2(edges, ["feature_id", "code"], "EPSG:4326")
    return area.groupBy("code").agg(F.count("*").alias("n"), F.round(F.sum("area_km2"), 3).alias("area_km2"))


def reproject_albers(spark, sf):
    c = st.cells(spark, sf)
    lon = st.GRID.x(F.col("col")) - 100
    lat = F.col("row").cast("double") % 20 + 25.25
    px, py = crs.reproject(lon, lat, "EPSG:4326", "EPSG:5070")
    flat = c.select("cell_id", px.alias("px"), py.alias("py"))
    back = crs.reproject(F.col("px"), F.col("py"), "EPSG:5070", "EPSG:4326")
    return flat.select(
        "cell_id", F.round("px", 3).alias("px"), F.round("py", 3).alias("py"),
        F.round(back[0], 6).alias("lon"), F.round(back[1], 6).alias("lat"),
    )


def transform_bounds(spark, sf):
    box = ops.feature_bounds(st.geo_polygons(spark, sf).withColumnRenamed("feature_id", "uid").drop("code"))
    flat = ops.reproject_bounds(box, ["uid"], "EPSG:4326", "EPSG:5070")
    return flat.select(F.col("uid").alias("feature_id"), *[F.round(c, 3).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])


def _defective(spark, sf):
    x, y, v = F.col("x"), F.col("y"), st.vertex
    a, b, c, d = v(x, y), v(x + 1, y), v(x + 1, y + 1), v(x, y + 1)
    kind = F.col("feature_id") % 6
    geom = (
        F.when(kind == 1, F.array(F.array(a, b, c, d)))
        .when(kind == 2, F.array(F.array(a, b, b, c, d, a)))
        .when(kind == 3, F.array(F.array(a, c, b, d, a)))
        .when(kind == 4, F.array(F.array(a, b, a), F.array(a, b, c, d, a)))
        .when(kind == 5, F.array(F.array(a, d, c, b, a)))
        .otherwise(F.array(F.array(a, b, c, d, a)))
    )
    return st.corners(spark, sf).select("feature_id", geom.alias("geom"))


def repair_flags(spark, sf):
    broken = _defective(spark, sf)
    fixed = rp.repair_features(broken)
    signed = F.aggregate("geom", F.lit(0.0), lambda acc, r: acc + rg.signed_area(r))
    after = fixed.select("feature_id", F.size("geom").alias("rings_after"), signed.alias("area_after"))
    return rp.defect_flags(broken).join(after, "feature_id")


def simplify(spark, sf):
    x, y, v = F.col("x"), F.col("y"), st.vertex
    d = F.abs(F.col("amount")) % 1
    ring = F.array(v(x, y), v(x + d, y), v(x + 0.9, y + 0.1), v(x + 1, y), v(x + 1, y + 1), v(x, y + d), v(x, y))
    g = st.corners(spark, sf).select("feature_id", F.array(ring).alias("geom"))
    return g.select(
        "feature_id", F.size(F.flatten("geom")).alias("n_before"),
        F.size(F.flatten(rg.simplify(F.col("geom"), 0.5))).alias("n_after"),
    )


def valid_geometry_sorted(spark, sf):
    c = st.corners(spark, sf)
    sq = st.square(F.col("x"), F.col("y"))
    geom = F.when(F.col("amount") < 0, None).when(F.col("amount") > 9000, F.slice(sq, 1, 0)).otherwise(sq)
    layer = c.select("feature_id", F.col("US_L3CODE").alias("code"), "amount", geom.alias("geom"))
    wanted = ops.wanted_regions(st.regions(spark, sf), SCHEME, 3)
    kept = ops.drop_unusable(ops.select_features(layer, wanted, SCHEME, 3))
    out = ops.output_columns(kept.withColumn("area_km2", rg.geom_area(F.col("geom"))))
    return out.drop("geom").orderBy("code")


def prepared_regions(spark, sf):
    features = st.geo_polygons(spark, sf)
    present = features.select(F.lpad("code", 2, "0").alias("code"))
    wanted = st.regions(spark, sf).join(present, "code", "left_semi")
    done = prepare_regions(wanted, features.drop("code"), scheme=SCHEME)
    b = done.bounds
    return b.select("uid", "code", "name", *[F.round(c, 6).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")],
                    F.round("area_km2", 3).alias("area_km2"))


def merge_suspects(spark, sf):
    rows = st.table(spark, sf, "customer").select(
        F.concat(F.lit("l3_"), F.lpad(st.text("c_nationkey"), 3, "0")).alias("uid"),
        normalize_code(_raw_code()).alias("code"), F.col("c_mktsegment").alias("name"),
    )
    return ops.merge_suspects(rows)


def geojson_columns(spark, sf):
    """Layer written as GeoJSON and read back: attributes as columns, CRS from the layer, code field inferred."""
    root = scratch_path(spark, "geojson")
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    points = lambda *p: F.array(*[F.array(a, b) for a, b in p])
    ring = points((x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1), (x, y))
    several = F.col("feature_id") % 2 == 0
    line = st.corners(spark, sf).select(F.to_json(F.struct(
        F.lit("Feature").alias("type"), F.col("feature_id").alias("id"),
        F.struct(F.lit("name").alias("type"), F.struct(F.lit("urn:ogc:def:crs:EPSG::4326").alias("name")).alias("properties")).alias("crs"),
        F.struct(F.when(several, "MultiPolygon").otherwise("Polygon").alias("type"),
                 F.when(several, F.to_json(F.array(F.array(ring)))).otherwise(F.to_json(F.array(ring))).alias("coordinates")).alias("geometry"),
        F.struct("US_L3CODE", F.concat(F.lit("region "), F.col("US_L3CODE")).alias("US_L3NAME"),
                 F.when(F.col("amount") > 0, F.col("amount")).alias("amount")).alias("properties"))).alias("value"))
    # coordinates as JSON, not as text
    line.select(F.regexp_replace(F.regexp_replace("value", r'"coordinates":"', '"coordinates":'), r'\]"\}', "]}").alias("value")).write.text(root)
    layer = layers.read_features(spark, root, "geojsonl")
    field = ops.pick_code_field([c for c in layer.columns if c not in ("geom", "crs")])
    return layer.select("feature_id", normalize_code(F.col(field)).alias("code"), F.col("US_L3NAME").alias("name"), "crs",
                        F.col("amount").cast("double").alias("amount"), rg.geom_area(F.col("geom")).alias("area"))


def catalog_load(spark, sf):
    root = scratch_path(spark, "catalog")
    regions = st.regions(spark, sf).withColumn("bounds", F.array(F.lit("0"), F.lit("0"), F.lit("1"), F.lit("1")))
    regions.write.json(f"{root}/regions")
    st.polygons(spark, sf).drop("code").write.parquet(f"{root}/features")
    loaded = catalog.load_regions(spark, f"{root}/regions")
    layer = layers.read_features(spark, f"{root}/features")
    wanted = ops.wanted_regions(loaded, SCHEME, 3)
    field = ops.pick_code_field(layer.columns)
    coded = layer.withColumn("code", normalize_code(F.col(field)))
    return ops.select_features(coded, wanted, SCHEME, 3).groupBy("uid", "code").agg(F.count("*").alias("n"))


_N, _C, _R = crs.CONE_N, crs.CONE_C, crs.RHO_0


def _geo_edges_sql() -> str:
    x, y = st.albers_sql("vlon", "vlat", _N, _C, _R)
    return f"""{st.GEO}, v AS (
  SELECT feature_id, code, i, lon + a * 0.1::DOUBLE AS vlon, lat + b * 0.1::DOUBLE AS vlat
  FROM geo CROSS JOIN (VALUES (0, 0, 0), (1, 1, 0), (2, 1, 1), (3, 0, 1)) AS s(i, a, b)),
p AS (SELECT feature_id, code, i, {x} AS px, {y} AS py FROM v),
area AS (
  SELECT p.feature_id, p.code, abs(sum(p.px * q.py - q.px * p.py)) / 2 / 1000000 AS a
  FROM p JOIN p q ON p.feature_id = q.feature_id AND q.i = (p.i + 1) % 4 GROUP BY 1, 2)"""


def _bounds_sql() -> str:
    x, y = st.albers_sql("plon", "plat", _N, _C, _R)
    return f"""WITH {st.GEO}, pts AS (
  SELECT feature_id,
    CASE e WHEN 2 THEN lon WHEN 3 THEN lon + 0.1::DOUBLE ELSE lon + (lon + 0.1::DOUBLE - lon) * (i / 22.0::DOUBLE) END AS plon,
    CASE e WHEN 0 THEN lat WHEN 1 THEN lat + 0.1::DOUBLE ELSE lat + (lat + 0.1::DOUBLE - lat) * (i / 22.0::DOUBLE) END AS plat
  FROM geo CROSS JOIN range(0, 23) AS r(i) CROSS JOIN range(0, 4) AS s(e)),
p AS (SELECT feature_id, {x} AS px, {y} AS py FROM pts)
SELECT feature_id, round(min(px), 3) AS xmin, round(min(py), 3) AS ymin,
       round(max(px), 3) AS xmax, round(max(py), 3) AS ymax FROM p GROUP BY 1"""


_AX, _AY = st.albers_sql("lon", "lat", _N, _C, _R)
_ASIA = f"SELECT uid, code, name FROM regions WHERE scheme = '{SCHEME}' AND level = 3"

QUERIES = {f.__name__: f for f in (
    code_normalize, region_select, dup_codes, wanted_codes, missing_codes, code_sample, code_field_scores,
    coerce_bbox, union_bbox, aoi_resolve, region_bounds, feature_bounds, dissolve_edges, dissolve_by_name, dissolve_t_junction,
    nested_rings, outline_rings,
    polygon_area_km2, reproject_albers, transform_bounds, repair_flags, simplify, valid_geometry_sorted,
    prepared_regions, prepared_regions_albers, merge_suspects, catalog_load, geojson_columns,
)}

SQL = {
    "code_normalize": f"WITH {_RAW_SQL} SELECT c_custkey, code FROM norm",
    "region_select": f"""WITH {st.REGIONS}, {st.SQUARES}
SELECT feature_id, uid, '{SCHEME}' AS scheme, 3 AS level, code, name FROM squares JOIN ({_ASIA}) USING (code)""",
    "dup_codes": f"""WITH {_RAW_SQL} SELECT c_mktsegment AS scheme, code, count(*) AS n FROM norm
WHERE code <> '' GROUP BY 1, 2 HAVING count(*) > 1""",
    "wanted_codes": f"WITH {_RAW_SQL} SELECT DISTINCT code FROM norm WHERE code <> ''",
    "missing_codes": """SELECT CAST(c_custkey % 30 AS VARCHAR) AS code FROM customer
EXCEPT SELECT CAST(s_nationkey AS VARCHAR) FROM supplier""",
    "code_sample": f"WITH {_RAW_SQL} SELECT DISTINCT code FROM norm WHERE code <> '' ORDER BY code LIMIT 25",
    "code_field_scores": """WITH c AS (
  SELECT 'layer_' || (p_partkey // 4) AS dataset, CASE p_size % 8 WHEN 0 THEN 'US_L3CODE' WHEN 1 THEN 'NA_L3CODE'
    WHEN 2 THEN 'L3_KEY' WHEN 3 THEN 'US_L3NAME' WHEN 4 THEN 'OBJECTID' WHEN 5 THEN 'REGION_LABEL'
    WHEN 6 THEN 'LEVEL3_DESC' ELSE 'eco_' || lower(p_type) END AS "column" FROM part),
s AS (SELECT *, lower("column") AS n FROM c),
p AS (SELECT dataset, "column",
    CASE WHEN n LIKE '%l3%' OR n LIKE '%level3%' OR n LIKE '%lvl3%' THEN 4 ELSE 0 END
  + CASE WHEN n LIKE '%code%' THEN 3 ELSE 0 END
  + CASE WHEN n LIKE '%us%' AND (n LIKE '%l3%' OR n LIKE '%level3%') THEN 2 ELSE 0 END
  + CASE WHEN n LIKE '%eco%' OR n LIKE '%region%' THEN 1 ELSE 0 END
  - CASE WHEN n LIKE '%name%' OR n LIKE '%desc%' OR n LIKE '%label%' THEN 2 ELSE 0 END AS score FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY score DESC, "column" DESC) AS k FROM p)
SELECT dataset, "column", score, score >= 3 AS confident FROM r WHERE k = 1""",
    "coerce_bbox": f"""WITH {st.BOXES} SELECT vec_id, i, valid, CASE WHEN valid THEN
  printf('[%.5f, %.5f, %.5f, %.5f]', xmin, ymin, xmax, ymax) ELSE '[null, null, null, null]' END AS shown FROM boxes""",
    "union_bbox": f"""WITH {st.BOXES} SELECT label, min(xmin) FILTER (valid) AS xmin, min(ymin) FILTER (valid) AS ymin,
  max(xmax) FILTER (valid) AS xmax, max(ymax) FILTER (valid) AS ymax FROM boxes GROUP BY label""",
    "aoi_resolve": f"""WITH {st.BOXES}, u AS (SELECT min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax
  FROM boxes WHERE valid) SELECT *, printf('[%.5f, %.5f, %.5f, %.5f]', xmin, ymin, xmax, ymax) AS shown FROM u""",
    "region_bounds": f"WITH {st.BOUNDS} SELECT * FROM bounds",
    "feature_bounds": f"""WITH {st.REGIONS}, {st.SQUARES}
SELECT uid, code, name, CAST(x AS DOUBLE) AS xmin, CAST(y AS DOUBLE) AS ymin, CAST(x + 1 AS DOUBLE) AS xmax,
  CAST(y + 1 AS DOUBLE) AS ymax FROM squares JOIN ({_ASIA}) USING (code)""",
    "dissolve_edges": f"""WITH {st.SQUARE_EDGES}, o AS (
  SELECT code, min(x1) AS x1, min(y1) AS y1, min(x2) AS x2, min(y2) AS y2 FROM edges
  GROUP BY code, least(x1, x2), least(y1, y2), greatest(x1, x2), greatest(y1, y2) HAVING count(*) = 1)
SELECT code, abs(sum(x1 * y2 - x2 * y1)) / 2 AS area, CAST(count(*) AS DOUBLE) AS perimeter,
  min(least(x1, x2)) AS xmin, min(least(y1, y2)) AS ymin, max(greatest(x1, x2)) AS xmax,
  max(greatest(y1, y2)) AS ymax, count(*) AS n_edges FROM o GROUP BY code""",
    "dissolve_by_name": f"""WITH {st.REGIONS}, {st.SQUARE_EDGES}, o AS (
  SELECT scheme AS name, min(x1) AS x1, min(y1) AS y1, min(x2) AS x2, min(y2) AS y2 FROM edges JOIN regions USING (code)
  GROUP BY scheme, least(x1, x2), least(y1, y2), greatest(x1, x2), greatest(y1, y2) HAVING count(*) = 1)
SELECT name, min(least(x1, x2)) AS xmin, min(least(y1, y2)) AS ymin, max(greatest(x1, x2)) AS xmax,
  max(greatest(y1, y2)) AS ymax, count(*) AS n_edges FROM o GROUP BY 1""",
    "dissolve_t_junction": f"""WITH {st.CELLS}, brick AS (
  SELECT c_nationkey % 3 AS code, col AS x, "row" AS y, CASE "row" % 2 WHEN 0 THEN 2 ELSE 1 END AS wide
  FROM cells JOIN customer ON cell_id = c_custkey WHERE "row" % 2 = 1 OR col % 2 = 0),
unit AS (SELECT code, x + i AS x, y FROM brick CROSS JOIN (VALUES (0), (1)) AS s(i) WHERE i < wide),
e AS (SELECT code, x + a AS x1, y + b AS y1, x + c AS x2, y + d AS y2
  FROM unit CROSS JOIN (VALUES (0,0,1,0), (1,0,1,1), (1,1,0,1), (0,1,0,0)) AS s(a, b, c, d)),
o AS (SELECT code, min(x1) AS x1, min(y1) AS y1, min(x2) AS x2, min(y2) AS y2 FROM e
  GROUP BY code, least(x1, x2), least(y1, y2), greatest(x1, x2), greatest(y1, y2) HAVING count(*) = 1),
area AS (SELECT code, CAST(count(*) AS DOUBLE) AS area FROM unit GROUP BY code)
SELECT code, area, CAST(count(*) AS DOUBLE) AS perimeter, CAST(min(least(x1, x2)) AS DOUBLE) AS xmin,
  CAST(min(least(y1, y2)) AS DOUBLE) AS ymin, CAST(max(greatest(x1, x2)) AS DOUBLE) AS xmax,
  CAST(max(greatest(y1, y2)) AS DOUBLE) AS ymax FROM o JOIN area USING (code) GROUP BY code, area""",
    "nested_rings": """SELECT CAST(s_nationkey AS VARCHAR) AS code, CAST(count(*) AS INTEGER) AS n_rings,
  CAST(count(*) FILTER (j % 2 = 0) AS INTEGER) AS n_shells,
  round(sum(CASE j % 2 WHEN 0 THEN 1 ELSE -1 END * (0.9::DOUBLE - 0.2::DOUBLE * j) * (0.9::DOUBLE - 0.2::DOUBLE * j)), 6) AS area
FROM supplier CROSS JOIN range(0, 4) AS r(j) WHERE j <= s_suppkey % 4 GROUP BY 1""",
    "outline_rings": f"""WITH RECURSIVE {st.SQUARE_EDGES}, o AS MATERIALIZED (
  SELECT row_number() OVER () AS id, * FROM (
    SELECT code, min(x1) AS x1, min(y1) AS y1, min(x2) AS x2, min(y2) AS y2 FROM edges
    GROUP BY code, least(x1, x2), least(y1, y2), greatest(x1, x2), greatest(y1, y2) HAVING count(*) = 1)),
d AS (SELECT *, CASE WHEN x2 > x1 THEN 0 WHEN y2 > y1 THEN 1 WHEN x2 < x1 THEN 2 ELSE 3 END AS dir FROM o),
nxt AS MATERIALIZED (SELECT a.code, a.id, arg_max(b.id, (b.dir - a.dir + 6) % 4) AS nxt
  FROM d a JOIN d b ON a.code = b.code AND a.x2 = b.x1 AND a.y2 = b.y1 GROUP BY 1, 2),
walk AS (SELECT code, id AS start, id AS cur, 0 AS step FROM nxt
  UNION ALL SELECT w.code, w.start, n.nxt, w.step + 1 FROM walk w JOIN nxt n ON n.id = w.cur WHERE n.nxt <> w.start),
ring AS (SELECT code, start, min(cur) AS ring, max(step) AS last FROM walk GROUP BY 1, 2)
SELECT code, count(DISTINCT ring) AS n_rings, count(*) AS n_vertices, CAST(max(last) AS BIGINT) AS last_pos FROM ring GROUP BY 1""",
    "polygon_area_km2": f"WITH {_geo_edges_sql()} SELECT code, count(*) AS n, round(sum(a), 3) AS area_km2 FROM area GROUP BY code",
    "reproject_albers": f"""WITH {st.CELLS}, g AS (SELECT cell_id, cx - 100 AS lon, CAST("row" AS DOUBLE) % 20 + 25.25::DOUBLE AS lat FROM cells)
SELECT cell_id, round({_AX}, 3) AS px, round({_AY}, 3) AS py, round(lon, 6) AS lon, round(lat, 6) AS lat FROM g""",
    "transform_bounds": _bounds_sql(),
    "repair_flags": """WITH k AS (SELECT s_suppkey AS feature_id, s_suppkey % 6 AS k FROM supplier)
SELECT feature_id, true AS usable, k = 1 AS open_ring, k = 2 AS repeated_vertex, k IN (3, 4) AS zero_area, k = 4 AS too_short,
  k = 3 AS self_cross, CASE WHEN k = 3 THEN 0 ELSE 1 END AS rings_after, CASE WHEN k = 3 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS area_after FROM k""",
    "simplify": f"""WITH {st.SQUARES}, d AS (SELECT feature_id, x, y, abs(amount) % 1 AS d FROM squares),
v AS (SELECT feature_id, i, round((x + vx) / 0.5::DOUBLE) AS sx, round((y + vy) / 0.5::DOUBLE) AS sy FROM d,
  LATERAL (VALUES (0, 0.0::DOUBLE, 0.0::DOUBLE), (1, d, 0.0), (2, 0.9, 0.1), (3, 1.0, 0.0), (4, 1.0, 1.0), (5, 0.0, d), (6, 0.0, 0.0)) AS t(i, vx, vy)),
w AS (SELECT *, lag(sx) OVER o AS px, lag(sy) OVER o AS py FROM v WINDOW o AS (PARTITION BY feature_id ORDER BY i))
SELECT feature_id, 7 AS n_before, CAST(count(*) FILTER (i = 0 OR sx <> px OR sy <> py) AS INTEGER) AS n_after FROM w GROUP BY 1""",
    "valid_geometry_sorted": f"""WITH {st.REGIONS}, {st.SQUARES}
SELECT uid, '{SCHEME}' AS scheme, 3 AS level, code, name, 1.0::DOUBLE AS area_km2 FROM squares JOIN ({_ASIA}) USING (code)
WHERE NOT amount < 0 AND NOT amount > 9000 ORDER BY code""",
    "prepared_regions": f"""WITH {st.REGIONS}, {_geo_edges_sql()}
SELECT uid, code, name, round(min(lon), 6) AS xmin, round(min(lat), 6) AS ymin, round(max(lon + 0.1::DOUBLE), 6) AS xmax,
  round(max(lat + 0.1::DOUBLE), 6) AS ymax, round(sum(a), 3) AS area_km2
FROM geo JOIN area USING (feature_id, code) JOIN ({_ASIA}) USING (code) GROUP BY 1, 2, 3""",
    "prepared_regions_albers": f"""WITH {st.REGIONS}, {_geo_edges_sql()}
SELECT uid, code, name, round(min(lon), 6) AS xmin, round(min(lat), 6) AS ymin, round(max(lon + 0.1::DOUBLE), 6) AS xmax,
  round(max(lat + 0.1::DOUBLE), 6) AS ymax, round(sum(a), 3) AS area_km2
FROM geo JOIN area USING (feature_id, code) JOIN ({_ASIA}) USING (code) GROUP BY 1, 2, 3""",
    "geojson_columns": """SELECT s_suppkey AS feature_id, CAST(s_nationkey AS VARCHAR) AS code, 'region ' || s_nationkey AS name, 'EPSG:4326' AS crs,
  CASE WHEN s_acctbal > 0 THEN s_acctbal END AS amount, 1.0::DOUBLE AS area FROM supplier""",
    "merge_suspects": f"""WITH {_RAW_SQL} SELECT 'l3_' || lpad(CAST(c.c_nationkey AS VARCHAR), 3, '0') AS uid,
  count(DISTINCT c.c_mktsegment) AS n_names, count(DISTINCT code) AS n_codes FROM norm JOIN customer c USING (c_custkey)
GROUP BY 1 HAVING count(DISTINCT c.c_mktsegment) > 1 OR count(DISTINCT code) > 1""",
    "catalog_load": f"""WITH {st.REGIONS}, {st.SQUARES}
SELECT uid, code, count(*) AS n FROM squares JOIN ({_ASIA}) USING (code) GROUP BY 1, 2""",
}
