"""Windows, clips, units, alignment and zonal statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from terracell.functions.boxes import box, union_boxes
from terracell.functions.climate import to_celsius
from terracell.functions.rings import geom_bounds
from terracell.functions.windows import window_of, window_origin
from terracell.operators.dissolve import feature_edges
from terracell import schemas
from terracell.functions.windows import Grid
from terracell.operators import clip, grid, legend as lg, regions as ops, zonal as zs, zones
from terracell.plans.prep_regions import prepare_regions, store_regions
from terracell.plans.region_features import label_by_region, run_zonal
from terracell.session import materialize, scratch_path

from . import standins as st

AOI_CODE = "7"
NODATA = -9999.0


def _aoi(spark, sf):
    """Box around the polygons of one region."""
    p = st.polygons(spark, sf).where(F.col("code") == AOI_CODE)
    return p.select(geom_bounds(F.col("geom")).alias("bbox")).agg(union_boxes().alias("bbox"))


def _labelled(spark, sf):
    return label_by_region(st.cells(spark, sf), st.polygons(spark, sf).drop("code").withColumnRenamed("US_L3CODE", "code"), st.GRID, "code", repaired=True)


def window_clip(spark, sf):
    window = _aoi(spark, sf).select(st.GRID.window(F.col("bbox")).alias("win"))
    return clip.clip_to_window(st.cells(spark, sf), window).select("cell_id", "row", "col", "value")


def window_profile(spark, sf):
    b = ops.region_bounds(st.polygons(spark, sf), ["code"])
    g = [F.lit(v) for v in (st.GRID.x0, st.GRID.y0, st.GRID.dx, st.GRID.dy)]
    win = b.withColumn("w", window_of(F.struct("xmin", "ymin", "xmax", "ymax"), *g))
    return win.withColumn("o", window_origin(F.col("w"), *g)).select(
        "code", "w.*", F.round("o.x0", 6).alias("x0"), F.round("o.y0", 6).alias("y0")
    )


def wide_aoi(spark, sf):
    """The box of the region with two degrees around it, in part beyond the raster."""
    c = F.col
    wide = box(c("bbox.xmin") - 2, c("bbox.ymin") - 2, c("bbox.xmax") + 2, c("bbox.ymax") + 2)
    return _aoi(spark, sf).select(wide.alias("bbox"))


def boundless_clip(spark, sf):
    window = wide_aoi(spark, sf).select(st.GRID.window(F.col("bbox")).alias("win"))
    return clip.boundless_clip(st.cells(spark, sf).select("row", "col", "value"), window, NODATA)


def nodata_filter(spark, sf):
    c = st.cells(spark, sf).select(
        F.floor(F.col("cell_id") / 2).alias("part"), "cell_id",
        F.when(F.col("value") < 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
    )
    kept = clip.drop_empty_windows(c, ["part"], F.lit(float("nan")))
    return clip.nodata_to_null(kept, F.lit(float("nan"))).groupBy("part").agg(
        F.count("*").alias("n_cells"), F.count("value").alias("n_valid")
    )


def region_clip(spark, sf):
    b = ops.region_bounds(st.polygons(spark, sf), ["code"])
    tiles = zones.box_tiles(b, st.GRID, ["code"])
    return zones.cells_in_boxes(st.cells(spark, sf), tiles).select("code", "cell_id", "value")


def region_overlap(spark, sf):
    """Squares widened by half overlap their right neighbours of the same code."""
    x, y = F.col("x"), F.col("y")
    ring = F.array(st.vertex(x, y), st.vertex(x + 1.5, y), st.vertex(x + 1.5, y + 1), st.vertex(x, y + 1), st.vertex(x, y))
    wide = st.corners(spark, sf).select(F.col("US_L3CODE").alias("code"), F.array(ring).alias("geom"))
    return zones.coverage(feature_edges(wide, ["code"]), st.GRID, "code")


def unit_convert(spark, sf):
    c = st.cells(spark, sf)
    units = F.when(F.col("class") == "BUILDING", "K").otherwise("1")
    return c.select("cell_id", F.round(to_celsius(F.col("value"), units), 6).alias("value"))


def class_names(spark, sf):
    rows = [("AUTOMOBILE", "developed"), ("BUILDING", "barren"), ("FURNITURE", "forest"), ("HOUSEHOLD", "wetland")]
    return lg.class_names(st.cells(spark, sf), spark.createDataFrame(rows, "class STRING, name STRING")).select("cell_id", "class_name")


def legend_cover(spark, sf):
    """Share of each named class in each region; the nations outside the first world region are the legend."""
    legend = st.table(spark, sf, "nation").where("n_regionkey <> 0").select(F.col("n_nationkey").alias("class"), F.col("n_name").alias("name"))
    classes = st.table(spark, sf, "customer").select(F.col("c_custkey").alias("cell_id"), F.col("c_nationkey").alias("nation"))
    cells = _labelled(spark, sf).drop("class").join(classes, "cell_id")
    cover = zs.class_cover(lg.class_names(cells, legend, "nation").withColumnRenamed("class_name", "class"), ["code"])
    return cover.withColumn("pct", F.round("pct", 6))


def zonal_holes(spark, sf):
    """Statistics of regions with holes and islands, drawn in either direction, on a raster whose rows run downwards."""
    cells = st.cells(spark, sf)
    height = cells.agg(F.coalesce(F.max("row") + 1, F.lit(1))).first()[0]
    grid_down = Grid(x0=0.0, y0=height * st.DY, dx=0.2, dy=-st.DY, width=50)
    flipped = cells.withColumn("row", F.lit(height - 1) - F.col("row"))
    labelled = label_by_region(flipped, st.nested(spark, sf), grid_down, "code")
    z = zs.zonal_stats(labelled, ["code"])
    return z.select("code", "n", *[F.round(s, 6).alias(s) for s in ("mean", "min", "max")])


def zonal_run(spark, sf):
    """From the region catalog to stored zonal statistics and features: prepare, store, label by the stored outline, aggregate, store, reread."""
    root = scratch_path(spark, "zonal-run")
    present = st.polygons(spark, sf).select("code").distinct().select(F.lpad("code", 2, "0").alias("code"))
    wanted = st.regions(spark, sf).join(present, "code", "left_semi")
    prepared = prepare_regions(wanted, st.polygons(spark, sf).drop("code"), scheme="ASIA")
    store_regions(prepared, root, version="v0")
    run_zonal(spark, root, st.cells(spark, sf), st.GRID, source="customer", variable="acctbal", version="v0")
    stats = spark.read.schema(schemas.ZONAL).parquet(f"{root}/zonal_stats")
    wide = spark.read.parquet(f"{root}/region_features")
    long = wide.unpivot("region_uid", [c for c in wide.columns if c != "region_uid"], "stat", "value").withColumn("variable", F.lit("feature"))
    return stats.select("region_uid", "variable", "stat", "value").unionByName(long).withColumn("value", F.round("value", 6))


def grid_align(spark, sf):
    block = lambda c: F.floor(F.col(c) / 5)
    out = grid.align(st.cells(spark, sf), block("row"), block("col"), cls="class")
    return out.withColumn("mean", F.round("mean", 6))


def zonal_basic(spark, sf):
    z = zs.zonal_stats(_labelled(spark, sf), ["code"])
    return z.select("code", "n", *[F.round(s, 6).alias(s) for s in ("mean", "std", "min", "max")])


def zonal_quantiles(spark, sf):
    q = zs.zonal_quantiles(_labelled(spark, sf).select("code", "value"), ["code"])
    return q.select("code", *[F.round(s, 6).alias(s) for s in ("p25", "median", "p75", "iqr")])


def zonal_class_pct(spark, sf):
    return zs.class_cover(_labelled(spark, sf), ["code"]).withColumn("pct", F.round("pct", 6))


def zonal_counts(spark, sf):
    cells = _labelled(spark, sf).withColumn("value", F.when(F.col("value") >= 0, F.col("value")))
    return zs.counts(cells, ["code"]).withColumn("valid_share", F.round("valid_share", 6))


def _long(spark, sf):
    summary = materialize(zs.class_summary(_labelled(spark, sf), ["code"]), "classes")
    stats = zs.to_long(
        zs.stats_from_classes(summary, ["code"]), "code", F.lit("customer"), F.lit("acctbal"), ["mean", "std", "min", "max"]
    )
    cover = zs.cover_from_classes(summary, ["code"]).select(
        F.col("code").alias("region_uid"), F.lit("customer").alias("source"), F.lower("class").alias("variable"),
        F.lit("pct").alias("stat"), F.col("pct").alias("value"),
    )
    return zs.merge_long(stats, cover)


def zonal_long(spark, sf):
    return _long(spark, sf).withColumn("value", F.round("value", 6))


def zonal_wide(spark, sf):
    wide = zs.to_wide(_long(spark, sf), ["mean", "max", "pct"])
    return wide.select("region_uid", "source", "variable", *[F.round(s, 6).alias(s) for s in ("mean", "max", "pct")])


_WIN = f"""{st.CELLS}, {st.BOUNDS}, win AS (
  SELECT code, xmin, ymin, xmax, ymax, CAST(floor(xmin / 0.2::DOUBLE) AS BIGINT) AS col_off, CAST(floor(ymin / {st.DY}::DOUBLE) AS BIGINT) AS row_off,
    CAST(ceil((xmax - xmin) / 0.2::DOUBLE) AS BIGINT) AS width, CAST(ceil((ymax - ymin) / {st.DY}::DOUBLE) AS BIGINT) AS height FROM bounds)"""

_WIDE = f"""{st.CELLS}, {st.BOUNDS}, win AS (
  SELECT CAST(floor((xmin - 2) / 0.2::DOUBLE) AS BIGINT) AS c0, CAST(floor((ymin - 2) / {st.DY}::DOUBLE) AS BIGINT) AS r0,
    CAST(ceil((xmax + 2 - (xmin - 2)) / 0.2::DOUBLE) AS BIGINT) AS w, CAST(ceil((ymax + 2 - (ymin - 2)) / {st.DY}::DOUBLE) AS BIGINT) AS h
  FROM bounds WHERE code = '{AOI_CODE}')"""

_ZONAL = f"""{st.LABELLED}, z AS (
  SELECT code, count(*) AS n, avg(value) AS mean, stddev_pop(value) AS std, min(value) AS min, max(value) AS max FROM labelled GROUP BY 1),
cov AS (SELECT code, class, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY code) AS pct FROM labelled GROUP BY 1, 2),
long AS (
  SELECT code AS region_uid, 'customer' AS source, 'acctbal' AS variable, stat, value FROM z
    CROSS JOIN LATERAL (VALUES ('mean', mean), ('std', std), ('min', min), ('max', max)) AS t(stat, value)
  UNION ALL SELECT code, 'customer', lower(class), 'pct', pct FROM cov)"""

QUERIES = {f.__name__: f for f in (
    window_clip, window_profile, boundless_clip, nodata_filter, region_clip, region_overlap, unit_convert, class_names, legend_cover, grid_align,
    zonal_holes, zonal_run,
    zonal_basic, zonal_quantiles, zonal_class_pct, zonal_counts, zonal_long, zonal_wide,
)}

SQL = {
    "window_clip": f"""WITH {_WIN} SELECT cell_id, "row", col, value FROM cells JOIN win ON code = '{AOI_CODE}'
  AND "row" >= row_off AND "row" < row_off + height AND col >= col_off AND col < col_off + width""",
    "window_profile": f"""WITH {_WIN} SELECT code, col_off, row_off, width, height, round(col_off * 0.2::DOUBLE, 6) AS x0,
  round(row_off * {st.DY}::DOUBLE, 6) AS y0 FROM win""",
    "boundless_clip": f"""WITH {_WIDE}, g AS (SELECT r0 + i AS "row", c0 + j AS col FROM win, LATERAL unnest(range(0, h)) AS a(i), LATERAL unnest(range(0, w)) AS b(j))
SELECT g."row", g.col, coalesce(value, -9999.0::DOUBLE) AS value FROM g LEFT JOIN cells ON cells."row" = g."row" AND cells.col = g.col""",
    "nodata_filter": """SELECT c_custkey // 2 AS part, count(*) AS n_cells, count(*) FILTER (c_acctbal >= 0) AS n_valid
FROM customer GROUP BY 1 HAVING count(*) FILTER (c_acctbal >= 0) > 0""",
    "region_clip": f"""WITH {st.CELLS}, {st.BOUNDS} SELECT code, cell_id, value FROM cells
JOIN bounds ON cx BETWEEN xmin AND xmax AND cy BETWEEN ymin AND ymax""",
    "region_overlap": f"""WITH {st.CELLS}, {st.SQUARES}, c AS (SELECT code, cell_id, count(*) AS k FROM cells
  JOIN squares ON cx >= x AND cx < x + 1.5 AND cy >= y AND cy < y + 1 GROUP BY 1, 2)
SELECT code, count(*) AS n_cells, count(*) FILTER (k > 1) AS n_overlap FROM c GROUP BY 1""",
    "unit_convert": """SELECT c_custkey AS cell_id, round(CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal - 273.15::DOUBLE ELSE c_acctbal END, 6) AS value FROM customer""",
    "class_names": """SELECT c_custkey AS cell_id, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'developed' WHEN 'BUILDING' THEN 'barren'
  WHEN 'FURNITURE' THEN 'forest' WHEN 'HOUSEHOLD' THEN 'wetland' ELSE 'unclassified' END AS class_name FROM customer""",
    "legend_cover": f"""WITH {st.LABELLED}, n AS (SELECT l.code, CASE WHEN n_regionkey <> 0 THEN n_name ELSE 'unclassified' END AS class
  FROM labelled l JOIN customer ON cell_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey WHERE value IS NOT NULL)
SELECT code, class, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY code), 6) AS pct FROM n GROUP BY 1, 2""",
    "zonal_holes": f"""WITH {st.LABELLED}, near AS (SELECT l.code, value, s_suppkey,
    least(cx - s_suppkey % 10, s_suppkey % 10 + 1 - cx, cy - s_suppkey // 10, s_suppkey // 10 + 1 - cy) AS d
  FROM (SELECT code, cell_id, value, (cell_id % 50 + 0.5::DOUBLE) * 0.2::DOUBLE AS cx, (cell_id // 50 + 0.5::DOUBLE) * 0.3333333333333333::DOUBLE AS cy FROM labelled) l
  JOIN supplier ON cx >= s_suppkey % 10 AND cx < s_suppkey % 10 + 1 AND cy >= s_suppkey // 10 AND cy < s_suppkey // 10 + 1)
SELECT code, count(*) AS n, round(avg(value), 6) AS mean, round(min(value), 6) AS min, round(max(value), 6) AS max FROM near
WHERE least(floor((d + 0.05) / 0.1), s_suppkey % 4 + 1) % 2 = 1 GROUP BY 1""",
    "zonal_run": f"""WITH {_ZONAL}, {st.REGIONS}, l AS (SELECT uid, stat, long.value FROM long JOIN regions ON region_uid = code
  WHERE scheme = 'ASIA' AND level = 3 AND variable = 'acctbal')
SELECT uid AS region_uid, 'acctbal' AS variable, stat, round(value, 6) AS value FROM l
UNION ALL SELECT uid, 'feature', 'acctbal_' || stat, round(value, 6) FROM l""",
    "grid_align": f"""WITH {st.CELLS}, v AS (SELECT "row" // 5 AS r, col // 5 AS c, class, count(*) AS n, sum(value) AS s FROM cells GROUP BY 1, 2, 3),
k AS (SELECT *, row_number() OVER (PARTITION BY r, c ORDER BY n DESC, class) AS k FROM v)
SELECT r AS "row", c AS col, round(sum(s) / sum(n), 6) AS mean, CAST(sum(n) AS BIGINT) AS n_cells, max(class) FILTER (k = 1) AS majority FROM k GROUP BY 1, 2""",
    "zonal_basic": f"WITH {_ZONAL} SELECT code, n, round(mean, 6) AS mean, round(std, 6) AS std, round(min, 6) AS min, round(max, 6) AS max FROM z",
    "zonal_quantiles": f"""WITH {st.LABELLED} SELECT code, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS median,
  round(quantile_cont(value, 0.75), 6) AS p75, round(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 6) AS iqr FROM labelled GROUP BY 1""",
    "zonal_class_pct": f"WITH {_ZONAL} SELECT code, class, n, round(pct, 6) AS pct FROM cov",
    "zonal_counts": f"""WITH {st.LABELLED} SELECT code, count(*) AS n_cells, count(*) FILTER (value >= 0) AS n_valid,
  round(count(*) FILTER (value >= 0) / count(*), 6) AS valid_share FROM labelled GROUP BY 1""",
    "zonal_long": f"WITH {_ZONAL} SELECT region_uid, source, variable, stat, round(value, 6) AS value FROM long",
    "zonal_wide": f"""WITH {_ZONAL} SELECT region_uid, source, variable, round(max(value) FILTER (stat = 'mean'), 6) AS mean,
  round(max(value) FILTER (stat = 'max'), 6) AS max, round(max(value) FILTER (stat = 'pct'), 6) AS pct FROM long GROUP BY 1, 2, 3""",
}
