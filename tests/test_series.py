"""Plans, series, scenarios, checks and the model."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from terracell.operators import model, qa, scenario as sc, seasonal as sn, series as sr
from terracell.plans import fetch_plan as fp, geo_checks

DAY0 = dt.date(2000, 1, 1)


def daily(spark, values, region="r"):
    rows = [(region, DAY0 + dt.timedelta(days=i), float(v)) for i, v in enumerate(values) if v is not None]
    return spark.createDataFrame(rows, "region STRING, day DATE, v DOUBLE")


def request(spark, vars_, years, months):
    return spark.createDataFrame([("s", vars_, years, months)], "source STRING, vars ARRAY<STRING>, years ARRAY<INT>, months ARRAY<STRING>")


def test_plan_order_size_and_limit(spark):
    plan = fp.expand_plan(request(spark, ["tas", "pr", "tas"], [2011, 2012], ["01", "02", "12"]))
    rows = plan.orderBy("n").collect()
    want = [(v, y, m) for v in ("tas", "pr", "tas") for y in (2011, 2012) for m in ("01", "02", "12")]
    assert [(r["var"], r.year, r.month) for r in rows] == want and [r.n for r in rows] == list(range(1, 19))
    for limit, n in ((0, 0), (1, 1), (99, 18), (None, 18)):
        assert fp.limit_plan(plan, limit).count() == n
    full = request(spark, [f"v{i}" for i in range(13)], list(range(1979, 2023)), [f"{m:02d}" for m in range(1, 13)])
    assert fp.expand_plan(full).count() == 6864


def test_limit_counts_skipped_items(spark):
    plan = fp.expand_plan(request(spark, ["a"], [2000], ["01", "02", "03", "04"])).withColumn("out_name", F.col("month"))
    have = spark.createDataFrame([("01",), ("01",), ("03",)], "out_name STRING")
    assert [r.n for r in fp.skip_existing(fp.limit_plan(plan, 2), have, ["out_name"]).collect()] == [2]
    assert fp.skip_existing(plan, have, ["out_name"], overwrite=True).count() == 4
    marked = {r.n: r.action for r in fp.mark_actions(plan, have, ["out_name"]).collect()}
    assert marked == {1: "skip", 2: "fetch", 3: "skip", 4: "fetch"}
    assert {r.action for r in fp.mark_actions(plan, have, ["out_name"], True).collect()} == {"fetch"}


def test_dry_run_never_gathers_the_names_there(spark):
    plan = spark.createDataFrame([(1, 10, "a"), (2, 10, "a"), (3, 11, "a"), (4, None, "b"), (5, 10, None)], "n INT, source INT, out_name STRING")
    have = spark.createDataFrame([("a", 10), ("a", 10), ("b", None), ("a", 12), (None, 10)], "out_name STRING, source INT")
    marked = fp.mark_actions(plan, have, ["source", "out_name"])
    assert marked.columns == ["source", "out_name", "n", "action"]
    assert sorted((r.n, r.action) for r in marked.collect()) == [(1, "skip"), (2, "skip"), (3, "fetch"), (4, "fetch"), (5, "fetch")]
    assert "Aggregate" not in marked._jdf.queryExecution().executedPlan().toString()


def test_dry_run_writes_nothing(spark, tmp_path):
    out = tmp_path / "out"
    fp.mark_actions(
        fp.expand_plan(request(spark, ["a"], [2000], ["01"])).withColumn("out_name", F.lit("x")),
        spark.createDataFrame([], "out_name STRING"), ["out_name"],
    ).collect()
    assert not out.exists()


def test_archive_actions(spark):
    plan = spark.createDataFrame([("a.zip",), ("b.zip",), ("c.zip",)], "out_name STRING")
    zips, dirs = spark.createDataFrame([("a.zip",), ("b.zip",)], "out_name STRING"), spark.createDataFrame([("a",)], "stem STRING")
    assert {r.out_name: r.action for r in fp.archive_actions(plan, zips, dirs).collect()} == {
        "a.zip": "skip", "b.zip": "extract", "c.zip": "fetch"}
    assert {r.action for r in fp.archive_actions(plan, zips, dirs, overwrite=True).collect()} == {"fetch"}


def test_doy_thresholds_wrap_and_match_numpy(spark):
    rng = np.random.default_rng(0)
    values = rng.normal(size=3 * 366)
    df = daily(spark, values)
    got = {r.doy: r for r in sr.doy_thresholds(df, ["region"], "day", "v", {"hi": 0.95, "lo": 0.05}, 7).collect()}
    days = [(DAY0 + dt.timedelta(days=i)).timetuple().tm_yday for i in range(len(values))]
    for doy in (1, 3, 180, 360, 366):
        near = {(doy - 1 + o) % 366 + 1 for o in range(-7, 8)}
        pool = [v for v, d in zip(values, days) if d in near]
        assert got[doy].hi == pytest.approx(np.quantile(pool, 0.95)) and got[doy].lo == pytest.approx(np.quantile(pool, 0.05))
    assert set(got) == set(range(1, 367))


def test_runs_break_on_missing_days(spark):
    runs = sr.runs(daily(spark, [1, 2, None, 3, 4, 5]), ["region"], "day", "v").orderBy("start_day").collect()
    assert [(r.n_days, r.intensity) for r in runs] == [(2, 2.0), (3, 5.0)]
    s = sr.event_summary(spark.createDataFrame(runs), ["region"]).first()
    assert (s.n_events, s.event_days, s.longest, s.mean_days, s.max_intensity, s.start_month) == (2, 5, 3, 2.5, 5.0, 1)


def test_rolling_anomaly_uses_dates(spark):
    z = sr.rolling_anomaly(daily(spark, [1, None, 3, 5]), ["region"], "day", "v", (2,)).orderBy("day").collect()
    assert [r.mean_2 for r in z] == [1.0, 3.0, 4.0]
    m = np.array([1.0, 3.0, 4.0])
    assert [r.z_2 for r in z] == pytest.approx(list((m - m.mean()) / m.std()))
    assert sr.rolling_anomaly(daily(spark, [2, 2]), ["region"], "day", "v", (2,)).first().z_2 is None


def test_time_since_trend_and_shift(spark):
    df = daily(spark, [1, 9, 1, 1, 9])
    since = sr.days_since_last(df, ["region"], "day", F.col("v") > 5).orderBy("day").collect()
    assert [r.days_since for r in since] == [None, 0, 1, 2, 0]
    months = spark.createDataFrame([("r", dt.date(2000 + i // 12, i % 12 + 1, 1), 2.0 * i + (50 if i >= 12 else 0)) for i in range(24)], "region STRING, m DATE, v DOUBLE")
    t = sr.trend(months.where("m < '2001-01-01'"), ["region"], "m", "v", 60).orderBy("m").collect()
    assert t[0].slope is None and all(r.slope == pytest.approx(2.0) for r in t[1:])
    shift = {r.m.month: r for r in sr.regime_shift(months, ["region"], "m", "v", 6, 1.0).where("year(m) = 2001").collect()}
    assert shift[1].is_shift and not shift[12].is_shift
    acc = sr.acceleration(months, ["region"], "m", "v").orderBy("m").collect()
    assert acc[0].delta is None and acc[1].acceleration is None and acc[2].acceleration == 0.0


def test_bucket_holds_its_limits(spark):
    out = sr.running_bucket(daily(spark, [5, 5, -20, 3, 4]), ["region"], "day", F.col("v"), 8).first()
    assert (out.n_periods, out.storage) == (5, 7.0)


def test_compound_events(spark):
    heat = daily(spark, [0, 9, 9, 0, 9, 0, 0, 0]).withColumnRenamed("v", "value")
    dry = daily(spark, [5, 0, 0, 5, 5, 5, 5, 5]).withColumnRenamed("v", "value")
    rows = sr.compound_events(heat, dry, ["region"], "day", 2, 0.5, -0.5).collect()
    assert [(r.start_day, r.n_days) for r in rows] == [(dt.date(2000, 1, 2), 2)]


def test_seasonal_and_landcover(spark):
    months = spark.createDataFrame([("r", dt.date(2000, m, 1), float(v)) for m, v in enumerate([0, 1, 4, 9, 10, 8, 3, 1, 0, 0, 0, 0], 1)], "region STRING, m DATE, v DOUBLE")
    p = sn.phenology(months, ["region"], "m", "v").first()
    assert (p.green_up, p.senescence) == (4, 6)
    assert sn.seasonal_summary(months, ["region"], "m", "v").first().amplitude == 10.0
    obs = spark.createDataFrame([(1, 2000, "a"), (1, 2000, "a"), (1, 2000, "b"), (1, 2001, "b"), (1, 2003, "a"), (2, 2000, "b"), (2, 2000, "a"), (2, 2001, "a")], "cell INT, y INT, k STRING")
    yearly = sn.yearly_class(obs, "cell", F.col("y"), "k")
    rates = {(r.from_class, r.to_class): (r.n, r.rate) for r in sn.transition_rates(yearly).collect()}
    assert rates == {("a", "b"): (1, 0.5), ("a", "a"): (1, 0.5)}


def test_noise_does_not_depend_on_partitioning(spark):
    df = spark.range(200).select("id", F.lit(10.0).alias("v"))
    a = {r.id: r.noisy for r in sc.add_noise(df, F.col("id"), "v", 0.5, "s").collect()}
    b = {r.id: r.noisy for r in sc.add_noise(df.repartition(5), F.col("id"), "v", 0.5, "s").collect()}
    assert a == b and all(9.5 <= v < 10.5 for v in a.values()) and len(set(a.values())) > 190


def test_scenarios_and_sensitivity(spark):
    df = daily(spark, [1, 2, 3])
    out = {r.scenario: r.m for r in sc.apply_scenarios(df, "v", {"base": 0, "up": 2}).groupBy("scenario").agg(F.avg("v").alias("m")).collect()}
    assert out == {"base": 2.0, "up": 4.0}
    assert sc.sensitivity(df, "v", ["region"], 2.0, {"mean": F.avg, "max": F.max}).first().d_mean == 1.0


def test_checks_find_what_is_planted(spark):
    df = spark.createDataFrame([("pr", -1.0), ("pr", 5.0), ("ndvi", 1.2), ("ndvi", float("nan")), ("other", -9.0), ("pr", None)], "variable STRING, value DOUBLE")
    bad = qa.out_of_range(df, "variable", "value", {"pr": (0.0, None), "ndvi": (-1.0, 1.0)}).collect()
    assert sorted((r.variable, str(r.value)) for r in bad) == [("ndvi", "1.2"), ("ndvi", "nan"), ("pr", "-1.0")]
    cover = spark.createDataFrame([("a", 0.5), ("a", 0.5), ("b", 0.7)], "uid STRING, pct DOUBLE")
    assert {r.uid: r.status for r in qa.pct_sums(cover, ["uid"]).collect()} == {"a": "pass", "b": "fail"}
    gaps = qa.missing_periods(daily(spark, [1, None, 1]).withColumnRenamed("day", "d"), ["region"], "d", "2000-01-01", "2000-01-04", "1 day")
    assert sorted(r.d.day for r in gaps.collect()) == [2, 4]
    long = spark.createDataFrame([("a", "v", "mean", 1.0), ("a", "v", "max", None), ("b", "v", "max", 2.0)], "region_uid STRING, variable STRING, stat STRING, value DOUBLE")
    wanted = spark.createDataFrame([("v", "mean"), ("v", "max")], "variable STRING, stat STRING")
    assert sorted((r.region_uid, r.stat) for r in qa.missing_stats(long, wanted).collect()) == [("a", "max"), ("b", "mean")]
    cells = spark.createDataFrame([(0, 0, 1.0), (0, 1, None), (2, 0, 1.0)], "row BIGINT, col BIGINT, value DOUBLE")
    assert sorted(tuple(r) for r in qa.extent_gaps(cells, 2, 3).collect()) == [(0, 1), (1, 0), (1, 1), (2, 1)]
    assert sorted(tuple(r) for r in qa.extent_gaps(cells, 2).collect()) == [(0, 1), (2, 1)]
    out = qa.outliers(daily(spark, [1, 2, 3, 2, 1, 3, 100]), ["region"], "v", 3.0).collect()
    assert [r.v for r in out] == [100.0]
    flat = qa.distribution(daily(spark, [2] * 400), ["region"], F.year("day"), "v", 2.0).collect()
    assert {r.status for r in flat} == {"warn"}


@pytest.mark.parametrize("width", [1, 63, 64, 65, 130])
def test_extent_gaps_at_word_borders(spark, width):
    absent = {(r, c) for r in range(3) for c in (0, 31, 62, 63, 64, 127, 128, 129) if c < width and (r + c) % 3}
    rows = [(r, c, 1.0) for r in range(3) for c in range(width) if (r, c) not in absent]
    df = spark.createDataFrame(rows + rows[:5], "row BIGINT, col BIGINT, value DOUBLE")
    want = absent | {(3, c) for c in range(width)}
    assert {tuple(r) for r in qa.extent_gaps(df, width, 4).collect()} == want


def test_geo_checks_choose_and_refuse(spark):
    keys = "source STRING, var STRING, year INT, month STRING"
    meta = spark.createDataFrame([("s", "v", 2000, "01", "EPSG:4326", 0.0, 10.0, 1.0, -1.0, 10, 10, -9.0)],
                                 keys + ", crs STRING, x0 DOUBLE, y0 DOUBLE, dx DOUBLE, dy DOUBLE, width INT, height INT, nodata DOUBLE")
    cells = spark.createDataFrame([("s", "v", 2000, "01", -9.0), ("s", "v", 2000, "01", None)], keys + ", value DOUBLE")
    bounds = spark.createDataFrame([("a", 1.0, 1.0, 2.0, 2.0), ("b", 1.0, -3.0, 2.0, 2.0)], "uid STRING, xmin DOUBLE, ymin DOUBLE, xmax DOUBLE, ymax DOUBLE")
    got = {(r.check, r.entity): r.status for r in geo_checks.run_checks(meta, cells, bounds).collect()}
    assert got == {("crs", "s/v/2000/01"): "pass", ("bounds", "a"): "pass", ("bounds", "b"): "warn", ("nodata", "s/v/2000/01"): "fail"}
    assert {r.check for r in geo_checks.run_checks(meta, cells, bounds, "crs").collect()} == {"crs"}
    with pytest.raises(ValueError):
        geo_checks.run_checks(meta, cells, bounds, "speed")


def test_forest_learns_and_repeats(spark):
    df = spark.range(400).select("id", (F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("z")).withColumn("y", F.col("x") * 3)
    train, test = model.split_by_key(df, F.col("id"))
    assert train.count() + test.count() == 400 and test.count() > 40
    first, again = (model.forest_metrics(model.fit_forest(train, ["x", "z"], "y"), test, "y") for _ in range(2))
    assert first == again and first["r2"] > 0.9
    tuned = model.tune_forest(train, ["x", "z"], "y", [5], [2, 6], folds=2)
    imp = model.importances(tuned, ["x", "z"])
    assert imp["x"] > imp["z"]


def test_extent_gaps_by_raster_with_a_missing_row(spark):
    cells = spark.createDataFrame([("a", 0, 0, 1.0), ("a", 0, 1, 1.0), ("b", 1, 0, 1.0)], "r STRING, row BIGINT, col BIGINT, value DOUBLE")
    got = sorted(tuple(r) for r in qa.extent_gaps(cells, 2, 2, ["r"]).collect())
    assert got == [("a", 1, 0), ("a", 1, 1), ("b", 0, 0), ("b", 0, 1), ("b", 1, 1)]


def test_names_of_one_reference_system(spark):
    meta = spark.createDataFrame([("a", "wgs84 "), ("b", "EPSG:5070"), ("c", None)], "id STRING, crs STRING")
    assert sorted(r["id"] for r in qa.crs_mismatch(meta, "EPSG:4326").collect()) == ["b", "c"]
