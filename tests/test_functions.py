"""Column functions: codes, boxes, names, projections, rings, windows, units."""

import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as hs
from pyspark.sql import functions as F

from conftest import ring, square
from terracell import schemas
from terracell.functions import boxes, climate, codes, crs, names, rings, windows
from terracell.operators.repair import repair_features
from terracell.operators import regions as rg
from terracell.plans import fetch_plan as fp


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


@pytest.mark.parametrize("text, code", [
    ("07", "7"), (" 7 ", "7"), ("7", "7"), (None, ""), ("", ""), (" ", ""), ("56h", "56h"), ("07h", "07h"),
    ("000", "0"), ("7.0", "7"), ("-7", "7"), ("0" * 5 + "9" * 30, "9" * 30), ("#", ""), ("a1 b2", "a1"),
])
def test_normalize_code(spark, text, code):
    assert one(spark, codes.normalize_code(F.lit(text).cast("string")))[0] == code


def test_codes_of_other_types(spark):
    ints = spark.createDataFrame([(7,), (None,)], "c INT")
    assert [r.code for r in codes.with_code(ints, "c").collect()] == ["7", ""]
    floats = spark.createDataFrame([(7.0,), (1e7,), (float("nan"),), (None,)], "c DOUBLE")
    assert [r.code for r in codes.with_code(floats, "c").collect()] == ["7", "10000000", "", ""]


@pytest.mark.parametrize("items, ok", [
    (["1", "2", "3", "4"], True), (["1", " 2.5 ", "-3e2", ".5"], True), (["1", "2", "3"], False),
    (["1", "2", "3", "x"], False), (["1", "2", "3", None], False), (["4", "3", "2", "1"], True), (None, False),
    (["1d", "2", "3", "4"], False), (["nan", "2", "3", "inf"], True),
])
def test_coerce_bbox(spark, items, ok):
    df = spark.createDataFrame([(items,)], "b ARRAY<STRING>")
    assert (df.select(boxes.coerce_bbox(F.col("b"))).first()[0] is not None) == ok


def test_union_and_format_of_the_four_region_boxes(spark):
    # The boxes of the v0 regions.
    rows = [
        (-105.2905959881059, 31.24640492063735, -99.98732968804357, 43.52244399079329),
        (-122.44880693738553, 34.926694863035934, -118.59042729491934, 40.22189418601387),
        (-84.27050247251928, 37.1159033299228, -78.66885739747221, 41.43535203116498),
        (-82.16572621480822, 24.5439344938386, -80.0310975038927, 27.207226731531915),
    ]
    df = spark.createDataFrame(rows, "xmin DOUBLE, ymin DOUBLE, xmax DOUBLE, ymax DOUBLE")
    df = df.select(F.struct("xmin", "ymin", "xmax", "ymax").alias("bbox"))
    text = df.agg(boxes.union_boxes().alias("u")).select(boxes.format_bbox(F.col("u"))).first()[0]
    assert text == "[-122.44881, 24.54393, -78.66886, 43.52244]"
    assert df.where("false").agg(boxes.union_boxes()).first()[0] is None


def test_urls_and_names(spark):
    # Archive templates and the URLs they must give.
    monthly = "{base_url}/{coverage_path}/{temporal_path}/{var}/{year}/CHELSA_{var}_{month}_{year}_V.{version}.tif"
    ctx = {
        "base_url": F.lit("https://os.unil.cloud.switch.ch/chelsa02/chelsa"), "coverage_path": F.lit("global"),
        "temporal_path": F.lit("monthly"), "var": F.lit("tas"), "year": F.lit(2011), "month": F.lit("01"),
        "version": F.lit("2.1"),
    }
    want = "https://os.unil.cloud.switch.ch/chelsa02/chelsa/global/monthly/tas/2011/CHELSA_tas_01_2011_V.2.1.tif"
    url = names.render_template(monthly, ctx)
    assert one(spark, url)[0] == want
    assert one(spark, names.render_template(F.lit(monthly), ctx))[0] == want
    assert one(spark, names.aoi_name(names.file_name(url)))[0] == "CHELSA_tas_01_2011_V.2.1_AOI.tif"
    shp = names.render_template("{base_url}/{coverage_path}/{product}.zip", {
        "base_url": F.lit("https://dmap-prod-oms-edc.s3.us-east-1.amazonaws.com/ORD/Ecoregions"),
        "coverage_path": F.lit("us"), "product": F.lit("us_eco_l3"),
    })
    assert one(spark, shp)[0].endswith("/ORD/Ecoregions/us/us_eco_l3.zip")


def test_template_refuses_gaps(spark):
    with pytest.raises(KeyError):
        names.render_template("{a}/{b}", {"a": F.lit("x")})
    for template in ("{a}/{b}", F.lit("{a}/{b}")):
        with pytest.raises(Exception, match="no value for: b"):
            one(spark, names.render_template(template, {"a": F.lit("x"), "b": F.lit(None).cast("string")}))
    with pytest.raises(Exception, match="no value for: b"):
        one(spark, names.render_template(F.lit("{a}/{b}"), {"a": F.lit("x")}))


@pytest.mark.parametrize("raw, want", [("1", "01"), ("12", "12"), ("123", "123"), ("", "00")])
def test_pad_month(spark, raw, want):
    assert one(spark, names.pad_month(F.lit(raw)))[0] == want


@pytest.mark.parametrize("name, want", [("a.b.zip", "a.b"), ("plain", "plain"), ("x.tif", "x")])
def test_stem(spark, name, want):
    assert one(spark, names.stem(F.lit(name)))[0] == want


@pytest.mark.parametrize("glob, path, hit", [
    ("data/raw/*.7z", "data/raw/a.7z", True), ("data/raw/*.7z", "data/raw/x/a.7z", False),
    ("data/**/a?.tif", "data/x/y/ab.tif", True), ("data/**/a?.tif", "data/ab.tif", True),
    ("data/a+b(1).tif", "data/a+b(1).tif", True), ("data/a.tif", "data/axtif", False),
    ("data/[ab]?.tif", "data/b1.tif", True), ("data/[ab]?.tif", "data/c1.tif", False), ("d/[!a-c]*", "d/dx", True), ("d/[!a-c]*", "d/bx", False),
    ("./data//x/./*.tif", "data/x/a.tif", True), ("d/[]x].t", "d/].t", True), ("d/[^a].t", "d/^.t", True), ("d/[ab.t", "d/[ab.t", True),
    ("d/[!a]b", "d//b", False), ("**/*.tif", "a.tif", True), ("**/*.tif", "x/y/a.tif", True), ("d/**", "d/x/y", True), ("d/a{1}$.t", "d/a{1}$.t", True),
])
def test_globs(spark, glob, path, hit):
    df = spark.createDataFrame([(glob, path)], "g STRING, p STRING").withColumn("r", names.glob_regex(F.col("g")))
    assert df.select(F.expr("p rlike r")).first()[0] is hit


@pytest.mark.parametrize("path, root, want", [
    ("file:/lake/data/a", "/lake", "data/a"), ("hdfs://host:8020/lake/data/a", "hdfs://host:8020/lake/", "data/a"), ("./data//a", "", "data/a"),
    ("/lake2/a", "/lake", "/lake2/a"), ("s3a://bucket/lake/./a", "s3a://bucket/lake", "a"), ("data/a", "/lake", "data/a"),
])
def test_relative_paths(spark, path, root, want):
    assert one(spark, names.relative_path(F.lit(path), root).alias("p")).p == want


def test_plain_paths_are_left_alone_without_replacing(spark):
    odd = ["", "/", "//", "./", ".//", "a/", "a//", "a/./", "./a/./././b", "a.b/c", "a./b", "a/.b", "/./a", "a/\n", "x:/y/", "s3a://b//c/./d/", None, "a/b.tif"]
    df = spark.createDataFrame([(p,) for p in odd], "p STRING")
    old = lambda c: F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "/+", "/"), r"(?<=^|/)(?:\./)+", ""), "(?<=.)/+$", "")
    bare = F.regexp_replace(old(F.regexp_replace("p", r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?(?=/)", "")), "/$", "")
    got = df.select("p", names.plain_path(F.col("p")).alias("a"), old(F.col("p")).alias("b"), names.relative_path(F.col("p")).alias("c"), bare.alias("d"))
    assert all(r.a == r.b and r.c == r.d for r in got.collect())
    assert "Contains" in df.select(names.plain_path(F.col("p")))._jdf.queryExecution().executedPlan().toString()  # told by a look first


def test_folder_before_the_first_wildcard(spark):
    got = one(spark, *[names.glob_folder(F.lit(g)).alias(f"g{i}") for i, g in enumerate(("./a/b/*.t", "a/[bc]/d", "*.t", "a/b.t"))])
    assert tuple(got) == ("a/b", "a", "", "a")


def test_albers_reference_point_and_inverse(spark):
    x, y = crs.reproject(F.lit(-75.0), F.lit(35.0), "EPSG:4326", "epsg:5070")
    r = one(spark, x.alias("x"), y.alias("y"))
    assert (round(r.x, 2), round(r.y, 2)) == (1885428.39, 1535969.29)
    pts = [(lon / 1.0, lat / 1.0) for lon in range(-125, -65, 7) for lat in range(24, 50, 3)]
    df = spark.createDataFrame(pts, "lon DOUBLE, lat DOUBLE")
    for target in ("EPSG:5070", "EPSG:3857"):
        px, py = crs.reproject(F.col("lon"), F.col("lat"), "EPSG:4326", target)
        back = df.select("lon", "lat", px.alias("x"), py.alias("y"))
        blon, blat = crs.reproject(F.col("x"), F.col("y"), target, "EPSG:4326")
        worst = back.select(F.max(F.abs(blon - F.col("lon")) + F.abs(blat - F.col("lat")))).first()[0]
        assert worst < 1e-9


def test_crs_allow_list(spark):
    with pytest.raises(ValueError):
        crs.reproject(F.lit(0.0), F.lit(0.0), "EPSG:4326", "EPSG:27700")
    df = spark.createDataFrame([("epsg:4326",), (" WGS84",), ("EPSG:5070",)], "c STRING")
    assert [r[0] for r in df.select(crs.is_geographic(F.col("c"))).collect()] == [True, True, False]


def test_reprojected_box_is_wider_than_its_corners(spark):
    df = spark.createDataFrame([(1, -105.0, 30.0, -85.0, 40.0)], "k INT, xmin DOUBLE, ymin DOUBLE, xmax DOUBLE, ymax DOUBLE")
    got = rg.reproject_bounds(df, ["k"], "EPSG:4326", "EPSG:5070").first()
    mid = crs.reproject(F.lit(-96.0), F.lit(30.0), "EPSG:4326", "EPSG:5070")[1]
    corner = crs.reproject(F.lit(-105.0), F.lit(30.0), "EPSG:4326", "EPSG:5070")[1]
    assert got.ymin < one(spark, corner)[0] and abs(got.ymin - one(spark, mid)[0]) < 2000


def geoms(spark, *values):
    return spark.createDataFrame([(i, g) for i, g in enumerate(values)], f"feature_id BIGINT, geom {schemas.GEOM}")


def test_repair_orients_outer_rings_and_holes(spark):
    outer, hole, island = square(0, 0, 10, 10), square(2, 2, 4, 4), square(3, 3, 1, 1)
    flipped = [list(reversed(outer)), hole, island]
    df = geoms(spark, flipped, [outer[:-1]], [outer[:2] + outer[1:]], [ring((0, 0), (1, 1), (0, 0))], [])
    fixed = repair_features(df)
    area = dict(fixed.select("feature_id", rings.geom_area(F.col("geom"))).collect())
    assert area[0] == pytest.approx(100 - 16 + 1)
    assert area[1] == area[2] == 100.0
    size = dict(fixed.select("feature_id", F.size("geom")).collect())
    assert size[3] == 0 and size[4] == 0
    signs = fixed.where("feature_id = 0").select(F.transform("geom", rings.signed_area)).first()[0]
    assert [math.copysign(1, s) for s in signs] == [1, -1, 1]


def test_bounds_perimeter_simplify(spark):
    df = geoms(spark, [square(1, 2, 3, 4)])
    r = df.select(rings.geom_bounds(F.col("geom")).alias("b"), rings.geom_perimeter(F.col("geom")).alias("p")).first()
    assert tuple(r.b) == (1.0, 2.0, 4.0, 6.0) and r.p == 14.0
    wiggly = [ring((0, 0), (0.1, 0.02), (1, 0), (1, 1), (0.9, 1.04), (0, 1), (0, 0)), square(5, 5, 0.01, 0.01)]
    flat = geoms(spark, wiggly).select(rings.simplify(F.col("geom"), 0.5)).first()[0]
    assert len(flat) == 1 and len(flat[0]) == 5


def test_windows(spark):
    grid = windows.Grid(x0=-10.0, y0=50.0, dx=0.5, dy=-0.5)
    b = boxes.box(F.lit(-9.8), F.lit(48.1), F.lit(-8.7), F.lit(49.9))
    win = one(spark, grid.window(b).alias("w")).w
    assert (win.col_off, win.row_off, win.width, win.height) == (0, 0, 3, 4)


def test_units(spark):
    r = one(spark, climate.to_celsius(F.lit(300.0), F.lit("K")), climate.to_celsius(F.lit(3.0), F.lit("mm")),
            climate.saturation_vapor_pressure(F.lit(20.0)), climate.degree_days(F.lit(20.0), F.lit(10.0)),
            climate.degree_days(F.lit(5.0), F.lit(1.0)))
    assert r[0] == pytest.approx(26.85) and r[1] == 3.0 and r[2] == pytest.approx(2.338, abs=1e-3)
    assert r[3] == 5.0 and r[4] == 0.0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(hs.lists(hs.tuples(*[hs.floats(-180, 180, allow_subnormal=False)] * 4), min_size=1, max_size=6))
def test_union_contains_every_box(spark, rows):
    df = spark.createDataFrame([([repr(v) for v in r],) for r in rows], "b ARRAY<STRING>")
    u = df.select(boxes.coerce_bbox(F.col("b")).alias("bbox")).agg(boxes.union_boxes().alias("u")).first().u
    assert all(u.xmin <= r[0] and u.ymin <= r[1] and u.xmax >= r[2] and u.ymax >= r[3] for r in rows)


def test_year_guard_and_defaults(spark):
    with pytest.raises(Exception, match="is after end_year"):
        one(spark, fp.year_range(F.lit(2012), F.lit(2011)))
    assert one(spark, fp.year_range(F.lit(2011), F.lit(2012)))[0] == [2011, 2012]
    none = F.lit(None).cast("array<string>")
    assert len(one(spark, fp.resolve_months(none, none))[0]) == 12
    assert one(spark, fp.resolve_months(F.array(F.lit("1")), none))[0] == ["01"]
    with pytest.raises(Exception, match="no variables"):
        one(spark, fp.resolve_variables(none, F.array().cast("array<string>")))
