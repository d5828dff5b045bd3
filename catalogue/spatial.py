"""Neighbourhoods, patches, membership, merged features, scenarios and the model."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from terracell.operators import fingerprint, grid, membership as mb, model, patches as pt, scenario as sc, seasonal as sn
from terracell.operators import series as sr, zonal as zs
from terracell.plans import region_features as rf
from terracell.session import materialize

from . import raster, standins as st

RADIUS = 0.7


def neighborhood_mean(spark, sf):
    out = grid.neighbourhood_mean(st.cells(spark, sf), st.GRID, RADIUS)
    return out.select("row", "col", "n_near", F.round("near_mean", 6).alias("near_mean"))


def edge_density(spark, sf):
    return grid.edge_density(st.cells(spark, sf), "class").withColumn("edge_density", F.round("edge_density", 6))


def _patches(spark, sf):
    return pt.patches(st.cells(spark, sf), "class")


def patches(spark, sf):
    return _patches(spark, sf).select("cell_id", "class", "patch")


def patch_sizes(spark, sf):
    return pt.patch_sizes(_patches(spark, sf), "class")


def soft_membership(spark, sf):
    c = st.corners(spark, sf)
    centres = mb.centroids(c, "US_L3CODE", F.col("x") + 0.5, F.col("y") + 0.5)
    cells = st.cells(spark, sf)
    points = cells.select("cell_id", st.GRID.x(F.col("col")).alias("x"), st.GRID.y(F.col("row")).alias("y"))
    out = mb.soft_membership(points, centres).select(
        "cell_id", mb.best_member(F.col("membership")).alias("b"), mb.membership_entropy(F.col("membership")).alias("h")
    )
    return out.select("cell_id", "b.code", F.round("b.p", 6).alias("p"), F.round("h", 6).alias("entropy"))


def _feature_tables(spark, sf):
    long = raster._long(spark, sf)
    wanted = rf.definitions(spark.createDataFrame(
        [("acctbal", "mean"), ("acctbal", "max"), ("building", "pct"), ("furniture", "pct")], "variable STRING, stat STRING"
    ))
    zonal = rf.pivot_features(long, wanted)
    region = F.col("region").cast("string").alias("region_uid")
    m = materialize(st.monthly(spark, sf), "monthly")
    seasons = sn.seasonal_summary(m, ["region"], "month", "v").groupBy(region).agg(F.max("amplitude").alias("max_amplitude"))
    hot = sr.runs(m.where(F.col("v") > 260000).withColumnRenamed("month", "day"), ["region"], "day", "v")
    events = hot.groupBy(region).agg(F.count("*").alias("n_hot"))
    return [zonal, seasons, events]


def region_features(spark, sf):
    out = rf.merge_features(_feature_tables(spark, sf), ["region_uid"])
    names = ("acctbal_mean", "acctbal_max", "building_pct", "furniture_pct", "max_amplitude")
    return out.select("region_uid", *[F.round(c, 6).alias(c) for c in names], "n_hot")


def noise_augment(spark, sf):
    out = sc.add_noise(st.cells(spark, sf), F.col("cell_id"), "value", 0.5, "s1")
    return out.select("cell_id", F.round("noisy", 6).alias("noisy"))


def scenario_delta(spark, sf):
    temps = st.daily(spark, sf).select("region", (F.col("v") / 10000).alias("t"))
    out = sc.apply_scenarios(temps, "t", {"base": 0, "plus2": 2, "minus2": -2})
    return out.groupBy("region", "scenario").agg(
        F.round(F.avg("t"), 6).alias("mean_t"), F.count_if(F.col("t") > 30).alias("n_hot"),
    )


def sensitivity(spark, sf):
    temps = st.daily(spark, sf).select("region", (F.col("v") / 10000).alias("t"))
    out = sc.sensitivity(temps, "t", ["region"], 2.0, {
        "mean": F.avg, "gdd": lambda t: F.sum(F.greatest(t - 10.0, F.lit(0.0))),
        "hot": lambda t: F.count_if(t > 30).cast("double"),
    })
    return out.select("region", *[F.round(f"d_{n}", 4).alias(f"d_{n}") for n in ("mean", "gdd", "hot")])


def content_hash(spark, sf):
    cells = raster._labelled(spark, sf)
    table = cells.groupBy("code", "class").agg(
        F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")
    )
    return fingerprint.content_hash(table, ["code", "class", "n", "lo", "hi"])


def rf_split(spark, sf):
    """Share of each region's months that the model learns from; the same at any partitioning."""
    train, test = model.split_by_key(st.monthly(spark, sf), F.concat_ws("|", "region", "month"))
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return parts.groupBy("region", "part").agg(F.count("*").alias("n"), F.min(st.text("month")).alias("first"), F.max(st.text("month")).alias("last"))


def rf_metrics(spark, sf):
    """Next month's value from this month's features, by region and month."""
    m = sn.monthly_anomaly(st.monthly(spark, sf), ["region"], "month", "v")
    line = Window.partitionBy("region").orderBy("month")
    table = m.select(
        "region", "month", "v", "anomaly", F.month("month").cast("double").alias("moy"),
        F.lag("v", 1).over(line).alias("lag1"), F.lead("v", 1).over(line).alias("label"),
    ).where("label is not null and lag1 is not null")
    names = ["v", "anomaly", "moy", "lag1"]
    train, test = model.split_by_key(table, F.concat_ws("|", "region", "month"))
    fitted = model.fit_forest(train, names, "label")
    rows = [(k, float(v)) for k, v in model.forest_metrics(fitted, test, "label").items()]
    rows += [(f"importance_{k}", float(v)) for k, v in model.importances(fitted, names).items()]
    return spark.createDataFrame(rows, "metric STRING, value DOUBLE")


_PATCH = """WITH RECURSIVE cells AS (SELECT c_custkey AS id, c_custkey // 50 AS r, c_custkey % 50 AS c, c_mktsegment AS k FROM customer),
links AS (SELECT a.id AS a, b.id AS b FROM cells a JOIN cells b ON a.k = b.k AND abs(a.r - b.r) + abs(a.c - b.c) = 1),
reach AS (SELECT id AS a, id AS b FROM cells UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
lab AS (SELECT a AS cell_id, min(b) AS patch FROM reach GROUP BY 1),
out AS (SELECT cell_id, k AS class, patch FROM lab JOIN cells ON id = cell_id)"""

_SOFT = f"""{st.CELLS}, {st.SQUARES}, ctr AS (SELECT code, avg(x + 0.5::DOUBLE) AS cx0, avg(y + 0.5::DOUBLE) AS cy0 FROM squares GROUP BY 1),
d AS (SELECT cell_id, ctr.code, (cx - cx0) * (cx - cx0) + (cy - cy0) * (cy - cy0) AS d2 FROM cells CROSS JOIN ctr),
w AS (SELECT cell_id, code, exp(min(d2) OVER (PARTITION BY cell_id) - d2) AS w FROM d),
p AS (SELECT cell_id, code, w / sum(w) OVER (PARTITION BY cell_id) AS p FROM w),
b AS (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY p DESC, code) AS r, sum(CASE WHEN p > 0 THEN -p * ln(p) ELSE 0 END) OVER (PARTITION BY cell_id) AS h FROM p)"""

QUERIES = {f.__name__: f for f in (
    neighborhood_mean, edge_density, patches, patch_sizes, soft_membership, region_features, noise_augment,
    scenario_delta, sensitivity, content_hash, rf_split, rf_metrics,
)}

SQL = {
    "neighborhood_mean": f"""WITH {st.CELLS} SELECT a."row", a.col, count(*) AS n_near, round(avg(b.value), 6) AS near_mean FROM cells a
JOIN cells b ON (a.cx - b.cx) ** 2 + (a.cy - b.cy) ** 2 <= 0.49 AND b."row" BETWEEN a."row" - 3 AND a."row" + 3 GROUP BY 1, 2""",
    "edge_density": f"""WITH {st.CELLS}, p AS (SELECT a.class <> b.class AS u FROM cells a JOIN cells b ON b."row" = a."row" AND b.col = a.col + 1
  UNION ALL SELECT a.class <> b.class FROM cells a JOIN cells b ON b."row" = a."row" + 1 AND b.col = a.col)
SELECT count(*) AS n_pairs, count(*) FILTER (u) AS n_unlike, round(count(*) FILTER (u) / count(*), 6) AS edge_density FROM p""",
    "patches": f"{_PATCH} SELECT * FROM out",
    "patch_sizes": f"{_PATCH} SELECT patch, class, count(*) AS n_cells FROM out GROUP BY 1, 2",
    "soft_membership": f"WITH {_SOFT} SELECT cell_id, code, round(p, 6) AS p, round(h, 6) AS entropy FROM b WHERE r = 1",
    "region_features": f"""WITH {raster._ZONAL}, {st.MONTHLY}, zz AS (SELECT region_uid, max(value) FILTER (variable = 'acctbal' AND stat = 'mean') AS a,
  max(value) FILTER (variable = 'acctbal' AND stat = 'max') AS b, max(value) FILTER (variable = 'building') AS c, max(value) FILTER (variable = 'furniture') AS d FROM long GROUP BY 1),
se AS (SELECT CAST(region AS VARCHAR) AS region_uid, max(amp) AS amp FROM (SELECT region, year(month) AS y, max(v) - min(v) AS amp FROM monthly GROUP BY 1, 2) GROUP BY 1),
i AS (SELECT region, month - CAST(row_number() OVER (PARTITION BY region ORDER BY month) AS INTEGER) AS g FROM monthly WHERE v > 260000),
ev AS (SELECT CAST(region AS VARCHAR) AS region_uid, count(DISTINCT g) AS n_hot FROM i GROUP BY 1)
SELECT region_uid, round(a, 6) AS acctbal_mean, round(b, 6) AS acctbal_max, round(c, 6) AS building_pct, round(d, 6) AS furniture_pct,
  round(amp, 6) AS max_amplitude, n_hot FROM zz FULL JOIN se USING (region_uid) FULL JOIN ev USING (region_uid)""",
    "rf_split": f"""WITH {st.MONTHLY}, u AS (SELECT region, CAST(month AS VARCHAR) AS month,
  CAST('0x' || substr(md5(region || '|' || CAST(month AS VARCHAR) || '|split'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u FROM monthly)
SELECT region, CASE WHEN u < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS part, count(*) AS n, min(month) AS first, max(month) AS last FROM u GROUP BY 1, 2""",
    "noise_augment": """SELECT c_custkey AS cell_id, round(c_acctbal + (CAST('0x' || substr(md5(c_custkey || '|s1'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE * 2 - 1) * 0.5::DOUBLE, 6) AS noisy FROM customer""",
    "scenario_delta": f"""WITH {st.DAILY} SELECT region, scenario, round(avg(v / 10000 + delta), 6) AS mean_t, count(*) FILTER (v / 10000 + delta > 30) AS n_hot
FROM daily CROSS JOIN (VALUES ('base', 0.0::DOUBLE), ('plus2', 2.0), ('minus2', -2.0)) AS s(scenario, delta) GROUP BY 1, 2""",
    "sensitivity": f"""WITH {st.DAILY}, t AS (SELECT region, v / 10000 AS t FROM daily)
SELECT region, round((avg(t + 2) - avg(t)) / 2, 4) AS d_mean, round((sum(greatest(t + 2 - 10, 0)) - sum(greatest(t - 10, 0))) / 2, 4) AS d_gdd,
  round((count(*) FILTER (t + 2 > 30) - count(*) FILTER (t > 30)) / 2, 4) AS d_hot FROM t GROUP BY 1""",
    "content_hash": f"""WITH {st.LABELLED}, t AS (SELECT code, class, count(*) AS n, CAST(round(min(value) * 1000) AS BIGINT) AS lo, CAST(round(max(value) * 1000) AS BIGINT) AS hi FROM labelled GROUP BY 1, 2)
SELECT count(*) AS n_rows, CAST(sum(CAST('0x' || substr(md5(concat_ws('|', code, class, n, lo, hi)), 1, 12) AS BIGINT)) AS VARCHAR) AS content_hash FROM t""",
}
