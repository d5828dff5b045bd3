"""Domain tables derived from the given ones, in Spark and as SQL CTEs.

Polygons are unit squares from supplier, ten to a row. The raster is customer,
fifty cells to a row, laid over the squares with no cell centre on an edge. Both grow in
y with the data. Series come from orders (temperature) and lineitem (rain).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from terracell.functions.windows import Grid

DY = 0.3333333333333333
GRID = Grid(x0=0.0, y0=0.0, dx=0.2, dy=DY, width=50)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def text(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


# -- region catalog and polygons ------------------------------------------------

def regions(spark, sf) -> DataFrame:
    nation = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    key = text("n_nationkey")
    return nation.select(
        F.concat(F.lit("l3_"), F.lpad(key, 3, "0"), F.lit("_"), F.lower("n_name")).alias("uid"),
        F.col("r_name").alias("scheme"), F.lit("3").alias("level"),
        F.lpad(key, 2, "0").alias("code"), F.col("n_name").alias("name"),
    )


REGIONS = """regions AS (
  SELECT 'l3_' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') || '_' || lower(n_name) AS uid,
         r_name AS scheme, 3 AS level, CAST(n_nationkey AS VARCHAR) AS code, n_name AS name
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def vertex(x, y) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def square(x: Column, y: Column) -> Column:
    """Closed counter-clockwise unit square."""
    return F.array(F.array(vertex(x, y), vertex(x + 1, y), vertex(x + 1, y + 1), vertex(x, y + 1), vertex(x, y)))


def corners(spark, sf) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("feature_id"), text("s_nationkey").alias("US_L3CODE"),
        (F.col("s_suppkey") % 10).alias("x"), F.floor(F.col("s_suppkey") / 10).alias("y"),
        F.col("s_acctbal").alias("amount"),
    )


def polygons(spark, sf) -> DataFrame:
    return corners(spark, sf).select(
        "feature_id", "US_L3CODE", F.col("US_L3CODE").alias("code"),
        square(F.col("x"), F.col("y")).alias("geom"), F.lit("EPSG:4326").alias("crs"),
    )


def nested(spark, sf) -> DataFrame:
    """A feature per nation: in the square of each supplier one to four rings in each other, drawn in either direction."""
    x, y, k = F.col("x").cast("double"), F.col("y").cast("double"), F.col("feature_id")

    def ring(j):
        west, south, east, north = x + 0.05 + 0.1 * j, y + 0.05 + 0.1 * j, x + 0.95 - 0.1 * j, y + 0.95 - 0.1 * j
        a, b, c, d = vertex(west, south), vertex(east, south), vertex(east, north), vertex(west, north)
        return F.when((k + j) % 3 == 0, F.array(a, d, c, b, a)).otherwise(F.array(a, b, c, d, a))

    rings = F.slice(F.array(*[ring(j) for j in range(4)]), F.lit(1), (k % 4 + 1).cast("int"))
    return corners(spark, sf).groupBy(F.col("US_L3CODE").alias("code")).agg(F.flatten(F.collect_list(rings)).alias("geom"))


SQUARES = """squares AS (
  SELECT s_suppkey AS feature_id, CAST(s_nationkey AS VARCHAR) AS code,
         s_suppkey % 10 AS x, s_suppkey // 10 AS y, s_acctbal AS amount
  FROM supplier)"""

SQUARE_EDGES = f"""{SQUARES}, edges AS (
  SELECT feature_id, code, CAST(x + a AS DOUBLE) AS x1, CAST(y + b AS DOUBLE) AS y1,
         CAST(x + c AS DOUBLE) AS x2, CAST(y + d AS DOUBLE) AS y2
  FROM squares CROSS JOIN (VALUES (0,0,1,0), (1,0,1,1), (1,1,0,1), (0,1,0,0)) AS s(a, b, c, d))"""


# -- geographic squares (0.1 degree) for the projections --------------------------

def lon_of(x: Column, y: Column) -> Column:
    return (x + F.floor(y / 100) % 40 * 10).cast("double") * 0.1 - 120.0


def lat_of(y: Column) -> Column:
    return (y % 100).cast("double") * 0.1 + 25.0


def geo_polygons(spark, sf) -> DataFrame:
    x, y = F.col("x"), F.col("y")
    lon, lat = lon_of(x, y), lat_of(y)
    ring = F.array(
        vertex(lon, lat), vertex(lon + 0.1, lat), vertex(lon + 0.1, lat + 0.1), vertex(lon, lat + 0.1), vertex(lon, lat)
    )
    return corners(spark, sf).select(
        "feature_id", "US_L3CODE", F.col("US_L3CODE").alias("code"),
        F.array(ring).alias("geom"), F.lit("EPSG:4326").alias("crs"),
    )


GEO = f"""{SQUARES}, geo AS (
  SELECT feature_id, code, CAST(x + (y // 100) % 40 * 10 AS DOUBLE) * 0.1::DOUBLE - 120.0::DOUBLE AS lon,
         CAST(y % 100 AS DOUBLE) * 0.1::DOUBLE + 25.0::DOUBLE AS lat
  FROM squares)"""

# Equal-area conic, written out: e2, e and the cone constants of EPSG:5070.
ALBERS_Q = """(0.9933056199770992::DOUBLE * (sin(radians({lat})) / (1 - 0.006694380022900788::DOUBLE * sin(radians({lat})) * sin(radians({lat})))
  - ln((1 - 0.08181919104281579::DOUBLE * sin(radians({lat}))) / (1 + 0.08181919104281579::DOUBLE * sin(radians({lat})))) / (2 * 0.08181919104281579::DOUBLE)))"""


def albers_sql(lon: str, lat: str, n: float, c: float, rho0: float) -> tuple[str, str]:
    q = ALBERS_Q.format(lat=lat)
    rho = f"(6378137.0::DOUBLE / {n!r}::DOUBLE * sqrt({c!r}::DOUBLE - {n!r}::DOUBLE * {q}))"
    theta = f"({n!r}::DOUBLE * radians({lon} + 96.0::DOUBLE))"
    return f"{rho} * sin({theta})", f"{rho0!r}::DOUBLE - {rho} * cos({theta})"


# -- raster -------------------------------------------------------------------------

def cells(spark, sf) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        key.alias("cell_id"), F.floor(key / 50).alias("row"), (key % 50).alias("col"),
        F.col("c_acctbal").alias("value"), F.col("c_mktsegment").alias("class"),
    )


CELLS = """cells AS (
  SELECT c_custkey AS cell_id, c_custkey // 50 AS "row", c_custkey % 50 AS col,
         (c_custkey % 50 + 0.5::DOUBLE) * 0.2::DOUBLE AS cx,
         (c_custkey // 50 + 0.5::DOUBLE) * 0.3333333333333333::DOUBLE AS cy,
         c_acctbal AS value, c_mktsegment AS class
  FROM customer)"""

# A reference system per class, spelled in several ways and missing for one.
CRS_NAMES = {
    "AUTOMOBILE": "epsg:4326", "BUILDING": " WGS84", "FURNITURE": "EPSG:5070", "HOUSEHOLD": "EPSG:4326",
}
CRS_SQL = "CASE class " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CRS_NAMES.items()) + " END"


def cells_with_crs(spark, sf) -> DataFrame:
    names = F.create_map(*[F.lit(t) for pair in CRS_NAMES.items() for t in pair])
    return cells(spark, sf).withColumn("crs", F.try_element_at(names, F.col("class")))


LABELLED = f"""{CELLS}, {SQUARES}, labelled AS (
  SELECT code, cell_id, "row", col, value, class FROM cells
  JOIN squares ON cx >= x AND cx < x + 1 AND cy >= y AND cy < y + 1)"""

BOUNDS = f"""{SQUARES}, bounds AS (
  SELECT code, CAST(min(x) AS DOUBLE) AS xmin, CAST(min(y) AS DOUBLE) AS ymin,
         CAST(max(x) + 1 AS DOUBLE) AS xmax, CAST(max(y) + 1 AS DOUBLE) AS ymax,
         CAST(count(*) AS BIGINT) AS n_features
  FROM squares GROUP BY code)"""


# -- series ---------------------------------------------------------------------------

def _cents(col: str) -> Column:
    return F.round(F.col(col) * 100).cast("bigint")


def order_days(spark, sf) -> DataFrame:
    """Orders per region and day. Orders are summed per customer and day before
    they meet the customer table, in whole cents, so sums do not depend on order."""
    per_customer = table(spark, sf, "orders").groupBy(
        "o_custkey", F.to_date("o_orderdate").alias("day")
    ).agg(
        F.sum(_cents("o_totalprice")).alias("cents"), F.count("*").alias("n"),
        F.max("o_totalprice").alias("hi"), F.min("o_totalprice").alias("lo"),
    )
    where = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("region"))
    return per_customer.join(where, "o_custkey")


def daily(spark, sf) -> DataFrame:
    return order_days(spark, sf).groupBy("region", "day").agg(
        (F.sum("cents").cast("double") / 100 / F.sum("n")).alias("v"),
        F.max("hi").alias("hi"), F.min("lo").alias("lo"),
    )


def monthly(spark, sf) -> DataFrame:
    month = F.trunc("day", "month").alias("month")
    return order_days(spark, sf).groupBy("region", month).agg(
        (F.sum("cents").cast("double") / 100 / F.sum("n")).alias("v")
    )


def rain(spark, sf) -> DataFrame:
    per_supplier = table(spark, sf, "lineitem").groupBy(
        "l_suppkey", F.to_date("l_shipdate").alias("day")
    ).agg(F.sum("l_quantity").alias("q"))
    where = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("region"))
    return per_supplier.join(where, "l_suppkey").groupBy("region", "day").agg(F.sum("q").alias("v"))


DAILY = """daily AS (
  SELECT c_nationkey AS region, CAST(o_orderdate AS DATE) AS day,
         CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 / COUNT(*) AS v,
         MAX(o_totalprice) AS hi, MIN(o_totalprice) AS lo
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""

MONTHLY = """monthly AS (
  SELECT c_nationkey AS region, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 / COUNT(*) AS v
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""

RAIN = """rain AS (
  SELECT s_nationkey AS region, CAST(l_shipdate AS DATE) AS day, CAST(SUM(l_quantity) AS DOUBLE) AS v
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)"""


# -- boxes ------------------------------------------------------------------------------

def boxes(spark, sf) -> DataFrame:
    """Box texts from every four numbers of embeddings; some too short, some not numeric, some with a NULL."""
    quads = F.transform(F.sequence(F.lit(0), F.floor(F.size("embedding") / 4).cast("int") - 1), lambda i: F.slice("embedding", i * 4 + 1, F.lit(4)))
    rows = table(spark, sf, "embeddings").select("vec_id", "label", F.posexplode(quads).alias("i", "q"))
    e = lambda i: F.get("q", F.lit(i)).cast("double")
    corners_ = [F.least(e(0), e(2)), F.least(e(1), e(3)), F.greatest(e(0), e(2)), F.greatest(e(1), e(3))]
    t = [c.cast("string") for c in corners_]
    kind = (F.col("vec_id") + F.col("i")) % 5
    bounds = (
        F.when(kind == 1, F.array(*t[:3]))
        .when(kind == 2, F.array(*t[:3], F.concat(F.lit("x"), t[3])))
        .when(kind == 3, F.array(t[0], F.lit(None).cast("string"), t[2], t[3]))
        .otherwise(F.array(*t))
    )
    return rows.select("vec_id", "i", "label", bounds.alias("bounds"))


BOXES = """boxes AS (
  SELECT vec_id, CAST(i AS INTEGER) AS i, label, (vec_id + i) % 5 IN (0, 4) AS valid,
         CAST(least(q[1], q[3]) AS DOUBLE) AS xmin, CAST(least(q[2], q[4]) AS DOUBLE) AS ymin,
         CAST(greatest(q[1], q[3]) AS DOUBLE) AS xmax, CAST(greatest(q[2], q[4]) AS DOUBLE) AS ymax
  FROM (SELECT vec_id, label, i, embedding[4 * i + 1 : 4 * i + 4] AS q FROM embeddings, LATERAL unnest(range(0, len(embedding) // 4)) AS t(i)))"""
