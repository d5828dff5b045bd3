"""Fetch plans, coverage, audits and partitioned reads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from terracell import schemas
from terracell.functions import crs
from terracell.functions.names import aoi_name, file_name, pad_month, render_template, stem
from terracell.plans import fetch_plan as fp, ingest, region_features as rf
from terracell.session import scratch_path
from terracell.sources import catalog, cells as cs, manifest, polygons as layers
from terracell.operators import regions as ops, zones

from . import raster, standins as st

# URL templates of the monthly climate and annual land-cover archives.
MONTHLY_TEMPLATE = "{base_url}/{coverage_path}/{temporal_path}/{var}/{year}/CHELSA_{var}_{month}_{year}_V.{version}.tif"
ANNUAL_TEMPLATE = "{base_url}/{temporal_path}_NLCD_{product}_{year}_{coverage_code}_C{collection}V{version}.zip"


def _context():
    return {
        "base_url": F.lit("https://host/data"), "coverage_path": F.col("path"),
        "temporal_path": F.lit("monthly"), "version": F.lit("2.1"),
    }


def _requests(spark, sf):
    """One request per part: its words are the variables, its size picks the first year."""
    part = st.table(spark, sf, "part")
    start = F.lit(1995) + F.col("p_size") % 5
    requested = F.when(F.col("p_size") > 40, F.array(F.lit("pr"), F.lit("tas")))
    active = F.split("p_name", " ")
    months = F.when(F.col("p_retailprice") < 950, F.array(F.lit("1"), F.lit("7"), F.lit("12")))
    return part.select(
        F.col("p_partkey").alias("source"), F.lower("p_type").alias("path"),
        fp.resolve_variables(requested, active).alias("vars"),
        fp.year_range(start, start + F.col("p_size") % 2).alias("years"),
        fp.resolve_months(F.lit(None).cast("array<string>"), months).alias("months"),
    )


def _plan(spark, sf):
    return fp.with_urls(fp.expand_plan(_requests(spark, sf)), MONTHLY_TEMPLATE, _context()).drop("path")


def _existing(spark, sf):
    """Outputs that are there: the months in which the part was shipped, for each of its variables; some come more than once."""
    shipped = st.table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("source"), F.year("l_shipdate").alias("year"),
        pad_month(F.month("l_shipdate")).alias("month"),
    )
    wanted = _requests(spark, sf).select("source", "path", "vars")
    url = render_template(MONTHLY_TEMPLATE, {
        **_context(), "var": F.col("var"), "year": F.col("year"), "month": F.col("month")
    })
    each = shipped.join(wanted, "source").select("source", "path", "year", "month", F.explode("vars").alias("var"))
    return each.select("source", aoi_name(file_name(url)).alias("out_name"))


def fetch_plan(spark, sf):
    return _plan(spark, sf)


def plan_limit(spark, sf):
    return fp.limit_plan(_plan(spark, sf), 24).select("source", "n", "out_name")


def plan_skip_existing(spark, sf):
    return fp.skip_existing(_plan(spark, sf), _existing(spark, sf), ["source", "out_name"]).select("source", "n", "out_name")


def plan_dry_run(spark, sf):
    marked = fp.mark_actions(_plan(spark, sf), _existing(spark, sf), ["source", "out_name"])
    return marked.groupBy("source", "action").agg(F.count("*").alias("n"))


def coverage_resolve(spark, sf):
    mapping = F.create_map(*[F.lit(v) for v in ("conus", "CU", "alaska", "AK", "hawaii", "HI")])
    k = F.col("p_size") % 5
    asked = F.when(k == 0, "conus").when(k == 1, "ak").when(k == 2, "hawaii")
    default = F.when(k == 3, "alaska")
    cov = fp.resolve_coverage(asked, default, F.lit("conus"), mapping)
    return st.table(spark, sf, "part").select("p_partkey", cov.alias("c")).select("p_partkey", "c.*")


def archive_plan(spark, sf):
    src = st.table(spark, sf, "part").select(
        "p_partkey", (F.lit(1985) + F.col("p_size") % 40).alias("year"), F.lit(ANNUAL_TEMPLATE).alias("url_template")
    )
    plan = fp.archive_plan(src, {
        "base_url": F.lit("https://www.mrlc.gov/downloads/sciweb1/shared/mrlc/data-bundles"),
        "temporal_path": F.lit("Annual"), "product": F.lit("LndCov"), "year": F.col("year"),
        "coverage_code": F.lit("CU"), "collection": F.lit(1), "version": F.lit(1),
    })
    return plan.select("p_partkey", "url", "out_name")


def archive_actions(spark, sf):
    """Archives of the parts: shipped parts are on disk, returned ones already unpacked."""
    plan = archive_plan(spark, sf).select("p_partkey", F.concat(
        stem(F.col("out_name")), F.lit("_"), st.text("p_partkey"), F.lit(".zip")).alias("out_name"))
    names = plan.withColumnRenamed("p_partkey", "l_partkey")
    shipped = st.table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("r"))
    on_disk = shipped.join(names, "l_partkey")
    stems = on_disk.where("r").select(stem(F.col("out_name")).alias("stem"))
    return fp.archive_actions(plan, on_disk, stems)


def _audit(spark, sf):
    part = st.table(spark, sf, "part")
    folder = F.concat(F.lit("data/raw/"), st.text("p_partkey"))
    sources = part.select(
        st.text("p_partkey").alias("source"),
        F.when(F.col("p_size") <= 10, F.concat(F.lit("./"), folder, F.lit("/*_[!A-M].tif")))
        .when(F.col("p_size") <= 20, F.concat(folder, F.lit("/*A.t[hi]f"))).alias("local_glob"),
        F.when(F.col("p_size") <= 40, folder).otherwise(" ").alias("cache_dir"),
    )
    files = st.table(spark, sf, "lineitem").select(F.concat(
        F.lit("file:/lake/data/raw/"), st.text("l_partkey"), F.lit("/"), st.text("l_orderkey"), F.lit("_"),
        st.text("l_linenumber"), F.lit("_"), F.col("l_returnflag"), F.lit(".tif"),
    ).alias("path"))
    return manifest.audit_sources(sources, files, root="/lake")


def source_audit(spark, sf):
    return _audit(spark, sf).withColumn("sample", F.array_join("sample", ","))


def source_audit_overall(spark, sf):
    return manifest.overall(_audit(spark, sf))


def source_audit_json(spark, sf):
    return manifest.as_json(_audit(spark, sf).select("source", "ok", "rule", "count"))


def crs_filter(spark, sf):
    c = st.cells_with_crs(spark, sf)
    return c.where(crs.is_geographic(F.col("crs"))).select("cell_id", "crs")


def cells_by_source(spark, sf):
    root = scratch_path(spark, "cells")
    one = st.cells(spark, sf).select(
        F.lit("customer").alias("source"), F.lit("acctbal").alias("var"), F.lit(1995).alias("year"),
        F.lit("01").alias("month"), F.lit(1).alias("band"), "row", "col", "value",
    )
    two = st.monthly(spark, sf).select(
        F.lit("orders").alias("source"), F.lit("tas").alias("var"), F.year("month").alias("year"),
        pad_month(F.month("month")).alias("month"), F.lit(1).alias("band"),
        F.col("region").cast("bigint").alias("row"), F.lit(0).cast("bigint").alias("col"), F.col("v").alias("value"),
    )
    cs.write_cells(one, root)
    cs.write_cells(two, root, overwrite=True)
    read = cs.read_cells(spark, root, source="orders", var="tas", years=(1996, 1998), months=["01", "06"], rows=(5, 20))
    kept = cs.read_cells(spark, root, source="customer")
    return read.unionByName(kept).groupBy("source", "var", "year", "month").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")
    )


def cells_rewrite(spark, sf):
    """A raster per class, stored, refused when stored again, half of them replaced; what the manifest and the cells say then."""
    root = scratch_path(spark, "rewrite")
    one = st.cells(spark, sf).select(
        F.lit("customer").alias("source"), F.lower("class").alias("var"), F.lit(1995).alias("year"),
        F.lit("01").alias("month"), F.lit(1).alias("band"), "row", "col", "value",
    )
    cs.write_cells(one, root)
    try:
        cs.write_cells(one.where("var = 'building'"), root)
        raise AssertionError("a stored raster was written again")
    except ValueError:
        pass
    cs.write_cells(one.where("var < 'c'").withColumn("value", F.col("value") + 1).where("row % 2 = 0"), root, overwrite=True)
    listed = cs.read_manifest(spark, root).select("var", "version")
    return cs.read_cells(spark, root).groupBy("var").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")).join(listed, "var")


def ingest_chain(spark, sf):
    """Plan to stored clips: a raster per market segment, one of them only nodata, one asked for that does not exist."""
    root = scratch_path(spark, "ingest")
    cells = st.cells(spark, sf).select(
        F.lit("customer").alias("source"), F.lower("class").alias("var"), F.lit(1995).alias("year"), F.lit("01").alias("month"),
        F.lit(1).alias("band"), "row", "col",
        F.when((F.col("value") < 0) | (F.col("class") == "BUILDING"), F.lit(raster.NODATA)).otherwise(F.col("value")).alias("value"))
    meta = cells.groupBy("source", "var", "year", "month").agg(F.max("row").alias("r")).select(
        "source", "var", "year", "month", F.lit("EPSG:4326").alias("crs"), F.lit(st.GRID.x0).alias("x0"), F.lit(st.GRID.y0).alias("y0"),
        F.lit(st.GRID.dx).alias("dx"), F.lit(st.GRID.dy).alias("dy"), F.lit(50).cast("long").alias("width"),
        (F.col("r") + 1).alias("height"), F.lit(raster.NODATA).alias("nodata"))
    plan = meta.select("source", "var", "year", "month").unionByName(meta.select("source", "var", F.lit(1996).alias("year"), "month").where("var = 'machinery'"))
    done = ingest.run_ingest(plan, cells, meta, raster.wide_aoi(spark, sf), root)
    again = ingest.run_ingest(plan.where("var = 'machinery'"), cells, meta, raster.wide_aoi(spark, sf), root).where("status = 'present'")
    kept = cs.read_cells(spark, f"{root}/cells").groupBy("var", "year").agg(
        F.count("*").alias("n_cells"), F.count_if(F.col("value") != raster.NODATA).alias("n_valid"))
    sizes = cs.read_meta(spark, f"{root}/meta").select("var", "year", "width", "height")
    report = done.select("var", "year", "status").unionByName(again.select("var", "year", "status"))
    return report.join(kept, ["var", "year"], "left").join(sizes, ["var", "year"], "left")


def source_catalog(spark, sf):
    """Source catalog written as JSON and loaded under its schema: a row per source and variable."""
    root = scratch_path(spark, "sources")
    words = F.array_distinct(F.split("p_name", " "))
    define = lambda w: F.struct(w.alias("var_name"), F.lit("1").alias("var_units"), (F.length(w) > 4).alias("active"))
    st.table(spark, sf, "part").select(
        st.text("p_partkey").alias("source"), F.col("p_brand").alias("provider"), F.lit("raster").alias("type"),
        F.lit(MONTHLY_TEMPLATE).alias("url_template"), F.slice(words, 1, 1).alias("vars_active"),
        F.struct(F.lit("monthly").alias("kind"), (F.lit(1980) + F.col("p_size")).alias("start_year")).alias("temporal"),
        F.map_from_arrays(words, F.transform(words, define)).alias("vars"),
    ).write.json(root)
    loaded = catalog.load_sources(spark, root)
    named = catalog.source_variables(loaded).select("source", "var", "active", "listed")
    return named.join(loaded.select("source", "provider", F.col("temporal.start_year").alias("start_year"),
                                    F.col("cache_dir").isNull().alias("no_cache")), "source")


def region_clips(spark, sf):
    """Two variables clipped to the box of each region, stored as one raster per region, one of them replaced."""
    root = scratch_path(spark, "clips")
    boxes = zones.box_tiles(ops.region_bounds(st.polygons(spark, sf), ["code"]), st.GRID, ["code"])
    clipped = zones.cells_in_boxes(st.cells(spark, sf), boxes).select(
        F.lit("customer").alias("source"), F.col("code").alias("region_uid"), F.explode(F.array(
            F.struct(F.lit("acctbal").alias("var"), F.col("value").alias("value")),
            F.struct(F.lit("key").alias("var"), F.col("cell_id").cast("double").alias("value")))).alias("v"),
        F.lit(1995).alias("year"), F.lit("01").alias("month"), F.lit(1).alias("band"), "row", "col")
    clipped = clipped.select("source", "region_uid", "v.var", "year", "month", "band", "row", "col", "v.value")
    cs.write_region_clips(clipped, root)
    cs.write_region_clips(clipped.where("var = 'key' AND region_uid = '7'").withColumn("value", -F.col("value")), root)
    back = spark.read.schema(clipped.schema).parquet(root)
    return back.groupBy("region_uid", "var").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


def sink_roundtrip(spark, sf):
    root = scratch_path(spark, "sinks")
    wanted = ops.wanted_regions(st.regions(spark, sf), "ASIA", 3)
    regions = ops.select_features(st.polygons(spark, sf), wanted, "ASIA", 3).withColumn("area_km2", F.lit(1.0))
    out = ops.output_columns(regions)
    layers.write_regions(out, root, version="v0")
    back = layers.read_regions(spark, root, version="v0")
    layers.write_bounds(ops.feature_bounds(back), f"{root}/bounds")
    layers.write_qa_csv(back, f"{root}/qa")
    csv = spark.read.option("header", True).schema(back.drop("geom").schema).csv(f"{root}/qa")
    zonal = rf.zonal_table(raster._labelled(spark, sf), "code", F.lit("customer"), F.lit("acctbal"))
    cs.write_table(zonal, f"{root}/zonal_stats")
    meta = st.cells(spark, sf).groupBy(F.lower("class").alias("var")).agg(
        F.max("col").alias("c"), F.max("row").alias("r")
    ).select(
        F.lit("customer").alias("source"), "var", F.lit(1995).alias("year"), F.lit("01").alias("month"),
        F.lit("EPSG:4326").alias("crs"), F.lit(st.GRID.x0).alias("x0"), F.lit(st.GRID.y0).alias("y0"),
        F.lit(st.GRID.dx).alias("dx"), F.lit(st.GRID.dy).alias("dy"), (F.col("c") + 1).alias("width"),
        (F.col("r") + 1).alias("height"), F.lit(None).cast("double").alias("nodata"),
    )
    cs.write_meta(meta, f"{root}/meta")
    parts = [
        spark.read.schema(schemas.ZONAL).parquet(f"{root}/zonal_stats").select(
            F.lit("zonal").alias("artifact"), F.col("region_uid").alias("uid")),
        cs.read_meta(spark, f"{root}/meta").select(F.lit("meta").alias("artifact"), F.concat_ws(":", "var", "width", "height").alias("uid")),
        back.select(F.lit("regions").alias("artifact"), "uid"),
        layers.read_bounds(spark, f"{root}/bounds").select(F.lit("bounds").alias("artifact"), "uid"),
        csv.select(F.lit("csv").alias("artifact"), "uid"),
    ]
    return reduce(DataFrame.unionByName, parts).groupBy("artifact", "uid").agg(F.count("*").alias("n"))


_PLAN = """req AS (
  SELECT p_partkey AS source, lower(p_type) AS path,
    CASE WHEN p_size > 40 THEN ['pr', 'tas'] ELSE string_split(p_name, ' ') END AS vars,
    1995 + p_size % 5 AS y0, p_size % 2 AS extra,
    CASE WHEN p_retailprice < 950 THEN ['01', '07', '12'] ELSE ['01','02','03','04','05','06','07','08','09','10','11','12'] END AS months
  FROM part),
loop AS (
  SELECT source, path, vars[v] AS var, CAST(y0 + y AS INTEGER) AS year, months[m] AS month,
    CAST((v - 1) * (extra + 1) * len(months) + y * len(months) + m AS BIGINT) AS n
  FROM req, LATERAL unnest(range(1, len(vars) + 1)) AS a(v), LATERAL unnest(range(0, extra + 1)) AS b(y),
    LATERAL unnest(range(1, len(months) + 1)) AS c(m)),
plan AS (
  SELECT source, var, year, month, n,
    'https://host/data/' || path || '/monthly/' || var || '/' || year || '/CHELSA_' || var || '_' || month || '_' || year || '_V.2.1.tif' AS url,
    'CHELSA_' || var || '_' || month || '_' || year || '_V.2.1_AOI.tif' AS out_name FROM loop)"""

_HAVE = _PLAN + """, have AS (
  SELECT DISTINCT l_partkey AS source, 'CHELSA_' || var || '_' || lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') || '_' || year(l_shipdate) || '_V.2.1_AOI.tif' AS out_name
  FROM lineitem JOIN (SELECT source, unnest(vars) AS var FROM req) ON l_partkey = source)"""

_AUDIT = """src AS (
  SELECT p_partkey AS k, p_size, CAST(p_partkey AS VARCHAR) AS source,
    CASE WHEN p_size <= 20 THEN 'local_glob' WHEN p_size <= 40 THEN 'cache_dir' ELSE 'none' END AS rule FROM part),
hits AS (
  SELECT source, 'data/raw/' || l_partkey || '/' || l_orderkey || '_' || l_linenumber || '_' || l_returnflag || '.tif' AS path
  FROM src JOIN lineitem ON l_partkey = k WHERE rule = 'cache_dir' OR (rule = 'local_glob' AND l_returnflag IN ('N', 'R') = (p_size <= 10))),
cnt AS (SELECT source, count(*) AS n, list_sort(list(path))[1:5] AS sample FROM hits GROUP BY 1),
audit AS (
  SELECT source, rule = 'none' OR coalesce(n, 0) > 0 AS ok,
    CASE WHEN rule = 'none' THEN 'unchecked' WHEN coalesce(n, 0) > 0 THEN 'present' ELSE 'missing' END AS status, rule,
    CASE WHEN rule <> 'none' THEN coalesce(n, 0) END AS count,
    CASE WHEN rule <> 'none' THEN coalesce(array_to_string(sample, ','), '') END AS sample,
    CASE WHEN rule = 'cache_dir' AND coalesce(n, 0) = 0 THEN 'missing or empty dir' END AS reason
  FROM src LEFT JOIN cnt USING (source))"""

QUERIES = {f.__name__: f for f in (
    fetch_plan, plan_limit, plan_skip_existing, plan_dry_run, coverage_resolve, archive_plan, archive_actions, source_audit,
    source_audit_overall, source_audit_json, crs_filter, cells_by_source, cells_rewrite, ingest_chain, source_catalog, region_clips,
    sink_roundtrip,
)}

SQL = {
    "fetch_plan": f"WITH {_PLAN} SELECT * FROM plan",
    "plan_limit": f"WITH {_PLAN} SELECT source, n, out_name FROM plan WHERE n <= 24",
    "plan_skip_existing": f"""WITH {_HAVE} SELECT source, n, out_name FROM plan
  WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h.source = plan.source AND h.out_name = plan.out_name)""",
    "plan_dry_run": f"""WITH {_HAVE} SELECT source, CASE WHEN h.out_name IS NULL THEN 'fetch' ELSE 'skip' END AS action, count(*) AS n
  FROM plan LEFT JOIN have h USING (source, out_name) GROUP BY 1, 2""",
    "coverage_resolve": """WITH k AS (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'conus' WHEN 1 THEN 'ak' WHEN 2 THEN 'hawaii' WHEN 3 THEN 'alaska' ELSE 'conus' END AS name FROM part)
SELECT p_partkey, name, CASE name WHEN 'conus' THEN 'CU' WHEN 'alaska' THEN 'AK' WHEN 'hawaii' THEN 'HI' ELSE name END AS code,
  name IN ('conus', 'alaska', 'hawaii') AS known FROM k""",
    "archive_plan": """WITH k AS (SELECT p_partkey, 'Annual_NLCD_LndCov_' || (1985 + p_size % 40) || '_CU_C1V1.zip' AS out_name FROM part)
SELECT p_partkey, 'https://www.mrlc.gov/downloads/sciweb1/shared/mrlc/data-bundles/' || out_name AS url, out_name FROM k""",
    "archive_actions": """WITH s AS (SELECT l_partkey, bool_or(l_returnflag = 'R') AS r FROM lineitem GROUP BY 1)
SELECT p_partkey, 'Annual_NLCD_LndCov_' || (1985 + p_size % 40) || '_CU_C1V1_' || p_partkey || '.zip' AS out_name,
  CASE WHEN r THEN 'skip' WHEN l_partkey IS NOT NULL THEN 'extract' ELSE 'fetch' END AS action FROM part LEFT JOIN s ON l_partkey = p_partkey""",
    "source_audit": f"WITH {_AUDIT} SELECT * FROM audit",
    "source_audit_overall": f"WITH {_AUDIT} SELECT bool_and(ok) AS ok, CASE WHEN bool_and(ok) THEN 0 ELSE 2 END AS exit_code FROM audit",
    "source_audit_json": f"""WITH {_AUDIT} SELECT source, '{{"source":"' || source || '","ok":' || ok || ',"rule":"' || rule || '"' ||
  CASE WHEN count IS NULL THEN '' ELSE ',"count":' || count END || '}}' AS json FROM audit""",
    "crs_filter": f"""WITH {st.CELLS}, c AS (SELECT cell_id, {st.CRS_SQL} AS crs FROM cells)
SELECT * FROM c WHERE upper(trim(crs)) IN ('EPSG:4326', 'WGS84')""",
    "cells_by_source": f"""WITH {st.MONTHLY}
SELECT 'customer' AS source, 'acctbal' AS var, 1995 AS year, '01' AS month, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer
UNION ALL SELECT 'orders', 'tas', CAST(year(month) AS INTEGER), lpad(CAST(month(month) AS VARCHAR), 2, '0'), count(*), round(sum(v), 2)
FROM monthly WHERE year(month) BETWEEN 1996 AND 1998 AND month(month) IN (1, 6) AND region BETWEEN 5 AND 20 GROUP BY 3, 4""",
    "cells_rewrite": """WITH c AS (SELECT lower(c_mktsegment) AS var, c_custkey // 50 AS r, c_acctbal AS v FROM customer)
SELECT var, count(*) AS n, round(sum(CASE WHEN var < 'c' THEN v + 1 ELSE v END), 2) AS total, 1 AS version
FROM c WHERE var >= 'c' OR r % 2 = 0 GROUP BY 1""",
    "ingest_chain": f"""WITH {raster._WIDE}, g AS (SELECT r0 + i AS "row", c0 + j AS col FROM win, LATERAL unnest(range(0, h)) AS a(i), LATERAL unnest(range(0, w)) AS b(j)),
k AS (SELECT DISTINCT lower(class) AS var FROM cells),
f AS (SELECT var, count(*) AS n_cells, count(*) FILTER (value >= 0 AND class <> 'BUILDING') AS n_valid
  FROM k CROSS JOIN g LEFT JOIN cells ON cells."row" = g."row" AND cells.col = g.col AND lower(class) = var GROUP BY 1),
s AS (SELECT *, CASE WHEN n_valid > 0 THEN 'written' ELSE 'empty' END AS status FROM f),
rows_ AS (SELECT var, 1995 AS year, status FROM s UNION ALL SELECT 'machinery', 1996, 'missing' UNION ALL SELECT var, 1995, 'present' FROM s WHERE var = 'machinery' AND status = 'written')
SELECT r.var, r.year, r.status, CASE WHEN r.year = 1995 AND s.status = 'written' THEN n_cells END AS n_cells,
  CASE WHEN r.year = 1995 AND s.status = 'written' THEN n_valid END AS n_valid, CASE WHEN r.year = 1995 AND s.status = 'written' THEN w END AS width,
  CASE WHEN r.year = 1995 AND s.status = 'written' THEN h END AS height FROM rows_ r JOIN s USING (var) CROSS JOIN win""",
    "source_catalog": """WITH w AS (SELECT CAST(p_partkey AS VARCHAR) AS source, p_brand AS provider, 1980 + p_size AS start_year, string_split(p_name, ' ') AS ws FROM part)
SELECT DISTINCT source, x AS var, length(x) > 4 AS active, x = ws[1] AS listed, provider, CAST(start_year AS INTEGER) AS start_year, true AS no_cache
FROM w, LATERAL unnest(ws) AS t(x)""",
    "region_clips": f"""WITH {st.CELLS}, {st.BOUNDS}, c AS (SELECT code AS region_uid, cell_id, value FROM cells
  JOIN bounds ON cx BETWEEN xmin AND xmax AND cy BETWEEN ymin AND ymax)
SELECT region_uid, 'acctbal' AS var, count(*) AS n, round(sum(value), 2) AS total FROM c GROUP BY 1
UNION ALL SELECT region_uid, 'key', count(*), round(sum(CASE WHEN region_uid = '7' THEN -cell_id ELSE cell_id END), 2) FROM c GROUP BY 1""",
    "sink_roundtrip": f"""WITH {st.REGIONS}, {st.LABELLED}, u AS (SELECT uid, count(*) AS n FROM squares
  JOIN (SELECT uid, code FROM regions WHERE scheme = 'ASIA') USING (code) GROUP BY 1)
SELECT artifact, uid, n FROM u CROSS JOIN (VALUES ('regions'), ('bounds'), ('csv')) AS t(artifact)
UNION ALL SELECT 'zonal', code, 4 FROM (SELECT DISTINCT code FROM labelled)
UNION ALL SELECT 'meta', lower(class) || ':' || (max(col) + 1) || ':' || (max("row") + 1), 1 FROM cells GROUP BY class""",
}
