"""Quality checks on polygons, cells, statistics and series."""

from __future__ import annotations

from pyspark.sql import functions as F

from terracell.functions.names import pad_month
from terracell.operators import qa, regions as ops, repair as rp, zonal as zs
from terracell.plans import geo_checks
from terracell.sources.catalog import source_variables

from . import raster, standins as st

# Limits per class, standing for the plausible ranges of each variable.
RULES = {
    "AUTOMOBILE": (0.0, None), "BUILDING": (None, 9000.0), "FURNITURE": (0.0, 9500.0), "HOUSEHOLD": (-500.0, 8000.0),
}
STATS = [("automobile", "pct"), ("building", "pct"), ("furniture", "pct"), ("household", "pct"), ("machinery", "pct"),
         ("acctbal", "mean"), ("acctbal", "median")]


def qa_row_counts(spark, sf):
    tables = {n: st.table(spark, sf, n) for n in ("supplier", "customer", "nation")}
    return qa.row_counts(tables, {"nation": 25, "supplier": 7})


def qa_crs(spark, sf):
    return qa.crs_mismatch(st.cells_with_crs(spark, sf), "EPSG:4326").select("cell_id", "crs")


def qa_precision(spark, sf):
    pairs = F.transform(F.sequence(F.lit(0), F.floor(F.size("embedding") / 2).cast("int") - 1), lambda i: F.slice("embedding", i * 2 + 1, F.lit(2)))
    e = lambda i: F.get("q", F.lit(i)).cast("double")
    pts = st.table(spark, sf, "embeddings").select("vec_id", F.posexplode(pairs).alias("i", "q")).select("vec_id", "i", e(0).alias("x"), e(1).alias("y"))
    return qa.precision_loss(pts, "x", "y", 2, 0.004).select("vec_id", "i")


def qa_geometry(spark, sf):
    x, y, v = F.col("x"), F.col("y"), st.vertex
    h = F.col("amount") / 10000
    ring = F.array(v(x, y), v(x + 1, y), v(x + 1, y + h), v(x, y + h), v(x, y))
    shapes = st.corners(spark, sf).select("feature_id", F.array(ring).alias("geom"))
    return qa.geometry_findings(rp.compactness(shapes, ["feature_id"]), 0.1, 0.5).select("feature_id", "issue")


def qa_missing_stats(spark, sf):
    # small shares count as not measured
    long = raster._long(spark, sf).withColumn("value", F.when((F.col("stat") != "pct") | (F.col("value") >= 0.15), F.col("value")))
    return qa.missing_stats(long, spark.createDataFrame(STATS, "variable STRING, stat STRING"))


def qa_ranges(spark, sf):
    bad = qa.out_of_range(st.cells(spark, sf), "class", "value", RULES)
    return bad.select("cell_id", "class", "value")


def qa_extent_gaps(spark, sf):
    cells = st.cells(spark, sf).withColumn("value", F.when(F.col("value") >= 0, F.col("value")))
    cells = cells.withColumn("raster", F.lit("customer"))
    # the extent is known from elsewhere: the highest customer that any order names
    known = st.table(spark, sf, "orders").agg((F.floor(F.max("o_custkey") / 50) + 1).alias("height")).where("height IS NOT NULL")
    meta = known.select(F.explode(F.array(F.lit("customer"), F.lit("absent"))).alias("raster"), F.lit(st.GRID.width).alias("width"), "height")
    return qa.extent_gaps(cells, keys=["raster"], meta=meta)


def qa_outside_extent(spark, sf):
    c = st.cells(spark, sf)
    x, y = st.GRID.x(F.col("col")), st.GRID.y(F.col("row"))
    extent = c.agg(F.min(x).alias("xmin"), F.min(y).alias("ymin"), F.max(x).alias("xmax"), F.max(y).alias("ymax"))
    return qa.outside_extent(ops.region_bounds(st.polygons(spark, sf), ["code"]), extent).select("code")


def qa_geo_checks(spark, sf):
    """Months of orders as rasters of one row, a column per region."""
    cells = st.monthly(spark, sf).select(
        F.lit("orders").alias("source"), F.lit("tas").alias("var"), F.year("month").alias("year"),
        pad_month(F.month("month")).alias("month"), F.when(F.col("v") < 250000, F.lit(-1.0)).otherwise(F.col("v")).alias("value"),
    )
    crs = F.when(F.col("month") == "02", "EPSG:5070").otherwise("EPSG:4326")
    meta = cells.select("source", "var", "year", "month").distinct().select(
        "*", crs.alias("crs"), F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(1.0).alias("dx"), F.lit(1.0).alias("dy"),
        F.lit(9).alias("width"), F.lit(1000000).alias("height"), F.lit(-1.0).alias("nodata"),
    )
    bounds = ops.region_bounds(st.polygons(spark, sf), ["code"]).withColumnRenamed("code", "uid")
    return geo_checks.run_checks(meta, cells, bounds).select("check", "entity", "status")


def qa_pct_sum(spark, sf):
    cover = zs.class_cover(raster._labelled(spark, sf), ["code"])
    return qa.pct_sums(cover, ["code"]).withColumn("pct_sum", F.round("pct_sum", 6))


def _null_rates(spark, sf):
    key = lambda k: F.get_json_object("props", f"$.{k}")
    events = st.table(spark, sf, "events").select(
        "event_type", key("k").alias("k"), key("z").alias("z"), F.when(F.col("value") <= 15, F.col("value")).alias("value")
    )
    return qa.null_rates(events, ["event_type"], ["k", "z", "value"], 0.5)


def qa_null_rate(spark, sf):
    wide = _null_rates(spark, sf)
    return wide.withColumn("null_rate", F.round("null_rate", 6))


def qa_distribution(spark, sf):
    m = st.monthly(spark, sf).withColumn("v", F.col("v") / 1000)
    d = qa.distribution(m, ["region"], F.year("month"), "v", 2.0)
    return d.withColumns({"variance": F.round("variance", 4), "ratio": F.round("ratio", 4)})


def qa_alignment(spark, sf):
    gaps = qa.missing_periods(st.daily(spark, sf).select("region", "day"), ["region"], "day", None, None, "1 day")
    return gaps.withColumn("day", st.text("day"))


def qa_duplicates(spark, sf):
    lines = st.table(spark, sf, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("day"))
    return qa.duplicate_periods(lines, ["l_suppkey"], "day").withColumn("day", st.text("day"))


def qa_leakage(spark, sf):
    lines = st.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("ts"))
    orders = st.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.to_date("o_orderdate").alias("target"))
    return qa.leakage(lines, orders, ["k"], "ts", F.date_add("target", 60)).select(
        "k", "l_linenumber", "l_partkey", F.datediff("ts", "target").alias("ahead")
    )


def qa_outliers(spark, sf):
    out = qa.outliers(st.daily(spark, sf).select("region", "day", "v"), ["region"], "v", 1.5)
    return out.select("region", st.text("day").alias("day"), F.round("robust_z", 4).alias("robust_z"))


def qa_active_flags(spark, sf):
    words = F.array_distinct(F.split("p_name", " "))
    define = lambda w: F.struct(w.alias("var_name"), F.lit("1").alias("var_units"), (F.length(w) > 4).alias("active"))
    sources = st.table(spark, sf, "part").select(
        F.col("p_partkey").alias("source"), F.slice(words, 1, 1).alias("vars_active"),
        F.map_from_arrays(words, F.transform(words, define)).alias("vars"),
    )
    return qa.active_flags(source_variables(sources)).select("source", "var", "active", "listed")


def _findings(spark, sf):
    cover = qa.pct_sums(zs.class_cover(raster._labelled(spark, sf), ["code"]), ["code"])
    nulls = _null_rates(spark, sf)
    ranges = st.cells(spark, sf).join(
        qa.out_of_range(st.cells(spark, sf), "class", "value", RULES).select("cell_id").withColumn("bad", F.lit(True)),
        "cell_id", "left",
    )
    return [
        qa_row_counts(spark, sf),
        qa.finding(cover, "pct_sum", F.col("code"), F.col("status"), F.col("pct_sum")),
        qa.finding(nulls, "null_rate", F.concat_ws(".", "event_type", "column"), F.col("status"), F.col("null_rate")),
        qa.finding(ranges, "range", F.col("cell_id"), qa.verdict(F.coalesce("bad", F.lit(False))), F.col("value")),
    ]


def qa_report(spark, sf):
    return qa.report(*_findings(spark, sf))


_RANGE = """(class = 'AUTOMOBILE' AND value < 0) OR (class = 'BUILDING' AND value > 9000)
  OR (class = 'FURNITURE' AND (value < 0 OR value > 9500)) OR (class = 'HOUSEHOLD' AND (value < -500 OR value > 8000))"""

_NULLS = """ev AS (SELECT event_type, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.z') AS z,
    CASE WHEN value <= 15 THEN value END AS value FROM events),
rates AS (
  SELECT event_type, n_rows, "column", null_rate, CASE WHEN null_rate > 0.5 THEN 'fail' ELSE 'pass' END AS status FROM (
    SELECT event_type, count(*) AS n_rows, count(*) FILTER (k IS NULL) / count(*) AS rk, count(*) FILTER (z IS NULL) / count(*) AS rz,
      count(*) FILTER (value IS NULL) / count(*) AS rv FROM ev GROUP BY 1)
  CROSS JOIN LATERAL (VALUES ('k', rk), ('z', rz), ('value', rv)) AS t("column", null_rate))"""

_COUNTS = """counts AS (
  SELECT 'row_count' AS "check", t AS entity, CASE WHEN (t = 'nation' AND n <> 25) OR (t = 'supplier' AND n <> 7) OR n = 0 THEN 'fail' ELSE 'pass' END AS status,
    CAST(n AS VARCHAR) AS detail
  FROM (SELECT 'supplier' AS t, count(*) AS n FROM supplier UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'nation', count(*) FROM nation))"""

_EXPECTED = ", ".join(f"('{v}', '{s}')" for v, s in STATS)

QUERIES = {f.__name__: f for f in (
    qa_row_counts, qa_crs, qa_precision, qa_geometry, qa_missing_stats, qa_ranges, qa_extent_gaps, qa_outside_extent,
    qa_geo_checks, qa_pct_sum, qa_null_rate, qa_distribution, qa_alignment, qa_duplicates, qa_leakage, qa_outliers, qa_active_flags,
    qa_report,
)}

SQL = {
    "qa_row_counts": f"WITH {_COUNTS} SELECT * FROM counts",
    "qa_crs": f"""WITH {st.CELLS}, c AS (SELECT cell_id, {st.CRS_SQL} AS crs FROM cells)
SELECT * FROM c WHERE crs IS NULL OR upper(trim(crs)) NOT IN ('EPSG:4326', 'WGS84')""",
    "qa_precision": """WITH p AS (SELECT vec_id, CAST(i AS INTEGER) AS i, CAST(embedding[2 * i + 1] AS DOUBLE) AS x, CAST(embedding[2 * i + 2] AS DOUBLE) AS y
  FROM embeddings, LATERAL unnest(range(0, len(embedding) // 2)) AS t(i))
SELECT vec_id, i FROM p WHERE sqrt((x - round(x, 2)) ** 2 + (y - round(y, 2)) ** 2) > 0.004""",
    "qa_geometry": """WITH g AS (SELECT s_suppkey AS feature_id, abs(s_acctbal / 10000) AS h FROM supplier),
m AS (SELECT feature_id, h AS area, 4 * pi() * h / ((2 + 2 * h) * (2 + 2 * h)) AS c FROM g)
SELECT feature_id, CASE WHEN area <= 0 THEN 'no_area' WHEN area < 0.1 THEN 'tiny' ELSE 'sliver' END AS issue FROM m WHERE area < 0.1 OR c < 0.5""",
    "qa_missing_stats": f"""WITH {raster._ZONAL}, l AS (SELECT region_uid, variable, stat, CASE WHEN stat <> 'pct' OR value >= 0.15 THEN value END AS value FROM long)
SELECT region_uid, variable, stat FROM (SELECT DISTINCT region_uid FROM l) CROSS JOIN (VALUES {_EXPECTED}) AS w(variable, stat)
EXCEPT SELECT region_uid, variable, stat FROM l WHERE value IS NOT NULL""",
    "qa_ranges": f"WITH {st.CELLS} SELECT cell_id, class, value FROM cells WHERE {_RANGE}",
    "qa_extent_gaps": f"""WITH {st.CELLS}, r AS (SELECT unnest(range(0, max(o_custkey) // 50 + 1)) AS "row" FROM orders)
SELECT raster, r."row", c.col FROM (VALUES ('customer'), ('absent')) AS k(raster) CROSS JOIN r CROSS JOIN range(0, 50) AS c(col)
WHERE raster = 'absent' OR NOT EXISTS (SELECT 1 FROM cells x WHERE x."row" = r."row" AND x.col = c.col AND x.value >= 0)""",
    "qa_outside_extent": f"""WITH {st.CELLS}, {st.BOUNDS}, e AS (SELECT min(cx) AS x0, min(cy) AS y0, max(cx) AS x1, max(cy) AS y1 FROM cells)
SELECT code FROM bounds CROSS JOIN e WHERE xmin < x0 OR ymin < y0 OR xmax > x1 OR ymax > y1""",
    "qa_geo_checks": f"""WITH {st.MONTHLY}, {st.BOUNDS}, r AS (SELECT 'orders/tas/' || year(month) || '/' || lpad(CAST(month(month) AS VARCHAR), 2, '0') AS entity,
  month(month) AS m, count(*) FILTER (v < 250000) / count(*) AS share FROM monthly GROUP BY 1, 2)
SELECT 'crs' AS "check", entity, CASE WHEN m = 2 THEN 'fail' ELSE 'pass' END AS status FROM r
UNION ALL SELECT 'nodata', entity, CASE WHEN share >= 1 THEN 'fail' WHEN share > 0.5 THEN 'warn' ELSE 'pass' END FROM r
UNION ALL SELECT 'bounds', code, CASE WHEN xmax > 9 THEN 'warn' ELSE 'pass' END FROM bounds""",
    "qa_pct_sum": f"WITH {raster._ZONAL} SELECT code, round(sum(pct), 6) AS pct_sum, 'pass' AS status FROM cov GROUP BY 1",
    "qa_null_rate": f"WITH {_NULLS} SELECT event_type, n_rows, \"column\", round(null_rate, 6) AS null_rate, status FROM rates",
    "qa_distribution": f"""WITH {st.MONTHLY}, y AS (SELECT region, CAST(year(month) AS INTEGER) AS period, count(*) AS n, var_pop(v / 1000) AS variance, min(v) = max(v) AS is_constant FROM monthly GROUP BY 1, 2),
r AS (SELECT *, variance / nullif(lag(variance) OVER (PARTITION BY region ORDER BY period), 0) AS ratio FROM y)
SELECT region, period, n, round(variance, 4) AS variance, is_constant, round(ratio, 4) AS ratio,
  CASE WHEN coalesce(ratio > 2.0, false) THEN 'fail' WHEN is_constant THEN 'warn' ELSE 'pass' END AS status FROM r""",
    "qa_alignment": f"""WITH {st.DAILY} SELECT region, CAST(d AS VARCHAR) AS day FROM (
  SELECT region, CAST(d AS DATE) AS d FROM (SELECT DISTINCT region FROM daily) CROSS JOIN (
    SELECT unnest(range(min(day), max(day) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM daily)
  EXCEPT SELECT region, day FROM daily)""",
    "qa_duplicates": """SELECT l_suppkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "qa_leakage": """SELECT l_orderkey AS k, l_linenumber, l_partkey, CAST(datediff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS ahead
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE CAST(l_shipdate AS DATE) > CAST(o_orderdate AS DATE) + 60""",
    "qa_outliers": f"""WITH {st.DAILY}, m AS (SELECT region, median(v) AS m FROM daily GROUP BY 1),
d AS (SELECT region, day, v, m, abs(v - m) AS d FROM daily JOIN m USING (region)),
s AS (SELECT region, median(d) * 1.4826::DOUBLE AS mad FROM d GROUP BY 1)
SELECT region, CAST(day AS VARCHAR) AS day, round((v - m) / mad, 4) AS robust_z FROM d JOIN s USING (region) WHERE d / mad > 1.5""",
    "qa_active_flags": """WITH w AS (SELECT p_partkey AS source, string_split(p_name, ' ') AS ws FROM part),
v AS (SELECT DISTINCT source, x AS var, length(x) > 4 AS active, x = ws[1] AS listed FROM w, LATERAL unnest(ws) AS t(x))
SELECT * FROM v WHERE active <> listed""",
    "qa_report": f"""WITH {raster._ZONAL}, {_NULLS}, {_COUNTS}, f AS (
  SELECT "check", status FROM counts UNION ALL SELECT 'null_rate', status FROM rates
  UNION ALL SELECT 'pct_sum', CASE WHEN abs(sum(pct) - 1) > 0.000001 THEN 'fail' ELSE 'pass' END FROM cov GROUP BY code
  UNION ALL SELECT 'range', CASE WHEN {_RANGE} THEN 'fail' ELSE 'pass' END FROM cells)
SELECT "check", status, count(*) AS n FROM f GROUP BY 1, 2""",
}
