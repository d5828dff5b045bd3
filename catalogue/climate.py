"""Features of daily and monthly series, and land-cover change."""

from __future__ import annotations

from pyspark.sql import functions as F

from terracell import constants as k
from terracell.operators import seasonal as sn, series as sr
from terracell.session import materialize

from . import standins as st

KEY = ["region"]


def _daily(spark, sf):
    return st.daily(spark, sf).select("region", "day", "v")


def _shown(df, day="day", **rounded):
    cols = {day: st.text(day), **{c: F.round(c, d) for c, d in rounded.items()}}
    return df.withColumns(cols)


def drought_proxy(spark, sf):
    z = sr.rolling_anomaly(_daily(spark, sf), KEY, "day", "v", k.DROUGHT_WINDOWS)
    return _shown(z.select("region", "day", "z_30", "z_90", "z_180"), z_30=5, z_90=5, z_180=5)


def hot_extreme(spark, sf):
    return _shown(sr.beyond_doy_threshold(_daily(spark, sf), KEY, "day", "v", k.HOT_Q, above=True), v=6, threshold=6)


def cold_snap(spark, sf):
    return _shown(sr.beyond_doy_threshold(_daily(spark, sf), KEY, "day", "v", k.COLD_Q, above=False), v=6, threshold=6)


def _dry_runs(spark, sf):
    return sr.runs(sr.below_local_quantile(st.rain(spark, sf), KEY, "v", k.DRY_Q), KEY, "day", "v", "min")


def dry_spell(spark, sf):
    return _dry_runs(spark, sf).withColumns({"start_day": st.text("start_day"), "end_day": st.text("end_day")})


def event_stats(spark, sf):
    hot = sr.beyond_doy_threshold(_daily(spark, sf), KEY, "day", "v", 0.8, above=True)
    return sr.event_summary(sr.runs(hot, KEY, "day", "v"), KEY).withColumns(
        {"mean_days": F.round("mean_days", 6), "max_intensity": F.round("max_intensity", 6)}
    )


def days_since_event(spark, sf):
    return _shown(sr.days_since_last(_daily(spark, sf), KEY, "day", F.col("v") > 400000))


def compound_heat_dry(spark, sf):
    heat = _daily(spark, sf).withColumnRenamed("v", "value")
    dry = st.rain(spark, sf).withColumnRenamed("v", "value")
    runs = sr.compound_events(heat, dry, KEY, "day", 2, 0.5, -0.5)
    return runs.select(
        "region", st.text("start_day").alias("start_day"), "n_days", F.round("intensity", 6).alias("intensity")
    )


def heat_wave(spark, sf):
    """Hot days per region as observed and after a fixed warming of two units."""
    d = _daily(spark, sf).withColumn("v", F.col("v") / 10000)
    limits = sr.doy_thresholds(d, KEY, "day", "v", {"threshold": k.HOT_Q})
    joined = d.withColumn("doy", F.dayofyear("day")).join(limits, ["region", "doy"])
    return joined.groupBy("region").agg(
        F.count_if(F.col("v") > F.col("threshold")).alias("n_base"),
        F.count_if(F.col("v") + 2.0 > F.col("threshold")).alias("n_warmed"),
    )


def stress_signal(spark, sf):
    return _shown(sr.stress_signal(st.monthly(spark, sf), KEY, "month", "v"), "month", v=6, z=6, pct_rank=6, return_period=6)


def acceleration(spark, sf):
    return _shown(sr.acceleration(st.monthly(spark, sf), KEY, "month", "v"), "month", v=6, delta=6, acceleration=6)


def volatility(spark, sf):
    return _shown(sr.volatility(st.monthly(spark, sf), KEY, "month", "v", k.VOLATILITY_MONTHS), "month", volatility=4)


def trend_slope(spark, sf):
    return _shown(sr.trend(st.monthly(spark, sf), KEY, "month", "v", k.TREND_MONTHS), "month", slope=4)


def regime_shift(spark, sf):
    r = sr.regime_shift(st.monthly(spark, sf), KEY, "month", "v", k.REGIME_MONTHS, k.REGIME_SIGMAS)
    return _shown(r, "month", shift=4)


def gap_series(spark, sf):
    """Differences, volatility, slope and shift of a series that lacks every seventh month."""
    full = materialize(st.monthly(spark, sf).where((F.year("month") * 12 + F.month("month")) % 7 != 3), "gaps")
    parts = [
        sr.acceleration(full, KEY, "month", "v").drop("v"), sr.volatility(full, KEY, "month", "v", k.VOLATILITY_MONTHS),
        sr.trend(full, KEY, "month", "v", k.TREND_MONTHS),
        sr.regime_shift(full, KEY, "month", "v", k.REGIME_MONTHS, k.REGIME_SIGMAS).drop("is_shift"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, [*KEY, "month"], "left")
    return _shown(out, "month", delta=6, acceleration=6, volatility=4, slope=4, shift=4)


def seasonal_summary(spark, sf):
    s = sn.seasonal_summary(st.monthly(spark, sf), KEY, "month", "v")
    return s.withColumns({c: F.round(c, d) for c, d in (("mean", 4), ("peak", 6), ("amplitude", 6))})


def phenology(spark, sf):
    return sn.phenology(st.monthly(spark, sf), KEY, "month", "v")


def monthly_anomaly(spark, sf):
    return _shown(sn.monthly_anomaly(st.monthly(spark, sf), KEY, "month", "v"), "month", v=6, normal=4, anomaly=4)


def aridity(spark, sf):
    rain = st.rain(spark, sf).groupBy("region", F.trunc("day", "month").alias("month")).agg(F.sum("v").alias("pr"))
    both = rain.join(st.monthly(spark, sf), ["region", "month"]).withColumn("pet", F.col("v") / 100)
    out = sn.aridity(both.withColumn("year", F.year("month")), ["region", "year"], "pr", "pet")
    return out.withColumns({c: F.round(c, 4) for c in ("precip", "pet", "aridity")})


def gdd(spark, sf):
    d = st.daily(spark, sf).withColumn("year", F.year("day"))
    out = sn.growing_degree_days(d, ["region", "year"], F.col("hi") / 10000, F.col("lo") / 10000, k.GDD_BASE_C)
    return out.withColumn("gdd", F.round("gdd", 7))


def vpd(spark, sf):
    wet = st.rain(spark, sf).select("region", "day", F.least("v", F.lit(100.0)).alias("rh"))
    both = _daily(spark, sf).join(wet, ["region", "day"])
    out = sn.vpd_summary(both, KEY, F.col("v") / 10000, F.col("rh"))
    return out.withColumns({c: F.round(c, 6) for c in ("vpd_mean", "vpd_max")})


def soil_bucket(spark, sf):
    out = sr.running_bucket(st.monthly(spark, sf), KEY, "month", F.col("v") - 300000, 200000)
    return out.withColumn("storage", F.round("storage", 6))


def _yearly(spark, sf):
    return sn.yearly_class(st.table(spark, sf, "lineitem"), "l_partkey", F.year("l_shipdate"), "l_returnflag")


def yearly_landcover(spark, sf):
    return _yearly(spark, sf)


def transition_rates(spark, sf):
    return sn.transition_rates(_yearly(spark, sf)).withColumn("rate", F.round("rate", 6))


_DOY = """near AS (SELECT region, v, (dayofyear(day) - 1 + o + 366) % 366 + 1 AS doy FROM daily CROSS JOIN range(-7, 8) AS r(o)),
lim AS (SELECT region, doy, quantile_cont(v, {q}) AS threshold FROM near GROUP BY 1, 2),
beyond AS (SELECT region, day, v, threshold FROM daily JOIN lim USING (region) WHERE doy = dayofyear(day) AND v {op} threshold)"""


def _beyond(q, op):
    return st.DAILY + ", " + _DOY.format(q=q, op=op)


_BEYOND_OUT = "SELECT region, CAST(day AS VARCHAR) AS day, round(v, 6) AS v, round(threshold, 6) AS threshold FROM beyond"

_RUNS = """isl AS (SELECT region, day, v, day - CAST(row_number() OVER (PARTITION BY region ORDER BY day) AS INTEGER) AS g FROM {src}),
runs AS (SELECT region, min(day) AS start_day, max(day) AS end_day, count(*) AS n_days, {agg}(v) AS intensity FROM isl GROUP BY region, g)"""

_Z = ", ".join(
    f"round((m{n} - avg(m{n}) OVER (PARTITION BY region)) / nullif(stddev_pop(m{n}) OVER (PARTITION BY region), 0), 5) AS z_{n}"
    for n in k.DROUGHT_WINDOWS
)
_M = ", ".join(
    f"avg(v) OVER (PARTITION BY region ORDER BY day RANGE BETWEEN INTERVAL {n - 1} DAYS PRECEDING AND CURRENT ROW) AS m{n}"
    for n in k.DROUGHT_WINDOWS
)
_MONTH = "CAST(month AS VARCHAR) AS month"
_BY = "PARTITION BY region ORDER BY month"
_BY_T = "PARTITION BY region ORDER BY year(month) * 12 + month(month)"

_YEARLY = """votes AS (SELECT l_partkey AS cell, CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag AS class, count(*) AS n FROM lineitem GROUP BY 1, 2, 3),
yearly AS (SELECT cell, year, class FROM (SELECT *, row_number() OVER (PARTITION BY cell, year ORDER BY n DESC, class) AS r FROM votes) WHERE r = 1)"""

QUERIES = {f.__name__: f for f in (
    drought_proxy, hot_extreme, cold_snap, dry_spell, event_stats, days_since_event, compound_heat_dry, heat_wave,
    stress_signal, acceleration, volatility, trend_slope, regime_shift, gap_series, seasonal_summary, phenology, monthly_anomaly,
    aridity, gdd, vpd, soil_bucket, yearly_landcover, transition_rates,
)}

SQL = {
    "drought_proxy": f"WITH {st.DAILY}, r AS (SELECT region, day, {_M} FROM daily) SELECT region, CAST(day AS VARCHAR) AS day, {_Z} FROM r",
    "hot_extreme": f"WITH {_beyond(0.95, '>')} {_BEYOND_OUT}",
    "cold_snap": f"WITH {_beyond(0.05, '<')} {_BEYOND_OUT}",
    "dry_spell": f"""WITH {st.RAIN}, q AS (SELECT region, quantile_cont(v, 0.2) AS t FROM rain GROUP BY 1),
dry AS (SELECT region, day, v FROM rain JOIN q USING (region) WHERE v < t), {_RUNS.format(src='dry', agg='min')}
SELECT region, CAST(start_day AS VARCHAR) AS start_day, CAST(end_day AS VARCHAR) AS end_day, n_days, intensity FROM runs""",
    "event_stats": f"""WITH {_beyond(0.8, '>')}, {_RUNS.format(src='beyond', agg='max')}
SELECT region, count(*) AS n_events, CAST(sum(n_days) AS BIGINT) AS event_days, max(n_days) AS longest, round(avg(n_days), 6) AS mean_days,
  round(max(intensity), 6) AS max_intensity, CAST(month(arg_max(start_day, n_days * 1000000 - (start_day - DATE '1970-01-01'))) AS INTEGER) AS start_month FROM runs GROUP BY 1""",
    "days_since_event": f"""WITH {st.DAILY}, l AS (SELECT region, day, max(CASE WHEN v > 400000 THEN day END) OVER (PARTITION BY region ORDER BY day) AS e FROM daily)
SELECT region, CAST(day AS VARCHAR) AS day, CAST(day - e AS INTEGER) AS days_since FROM l""",
    "compound_heat_dry": f"""WITH {st.DAILY}, {st.RAIN}, a AS (SELECT region, day, (v - avg(v) OVER p) / stddev_pop(v) OVER p AS z FROM daily WINDOW p AS (PARTITION BY region)),
b AS (SELECT region, day, (v - avg(v) OVER p) / stddev_pop(v) OVER p AS z FROM rain WINDOW p AS (PARTITION BY region)),
hits AS (SELECT region, day, a.z AS v FROM a JOIN b USING (region, day) WHERE a.z > 0.5 AND b.z < -0.5), {_RUNS.format(src='hits', agg='max')}
SELECT region, CAST(start_day AS VARCHAR) AS start_day, n_days, round(intensity, 6) AS intensity FROM runs WHERE n_days >= 2""",
    "heat_wave": f"""WITH {st.DAILY}, t AS (SELECT region, day, v / 10000 AS v FROM daily),
near AS (SELECT region, v, (dayofyear(day) - 1 + o + 366) % 366 + 1 AS doy FROM t CROSS JOIN range(-7, 8) AS r(o)),
lim AS (SELECT region, doy, quantile_cont(v, 0.95) AS h FROM near GROUP BY 1, 2)
SELECT t.region, count(*) FILTER (v > h) AS n_base, count(*) FILTER (v + 2.0::DOUBLE > h) AS n_warmed
FROM t JOIN lim ON lim.region = t.region AND doy = dayofyear(day) GROUP BY 1""",
    "stress_signal": f"""WITH {st.MONTHLY} SELECT region, {_MONTH}, round(v, 6) AS v, round((v - avg(v) OVER (PARTITION BY region)) / nullif(stddev_pop(v) OVER (PARTITION BY region), 0), 6) AS z,
  round(percent_rank() OVER (PARTITION BY region ORDER BY v), 6) AS pct_rank,
  round((count(*) OVER (PARTITION BY region) + 1) / rank() OVER (PARTITION BY region ORDER BY v DESC), 6) AS return_period FROM monthly""",
    "acceleration": f"""WITH {st.MONTHLY} SELECT region, {_MONTH}, round(v, 6) AS v, round(v - max(v) OVER one, 6) AS delta,
  round(v - 2 * max(v) OVER one + max(v) OVER two, 6) AS acceleration FROM monthly
  WINDOW one AS ({_BY_T} RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING), two AS ({_BY_T} RANGE BETWEEN 2 PRECEDING AND 2 PRECEDING)""",
    "volatility": f"""WITH {st.MONTHLY} SELECT region, {_MONTH},
  round(stddev_samp(v) OVER ({_BY_T} RANGE BETWEEN 11 PRECEDING AND CURRENT ROW), 4) AS volatility FROM monthly""",
    "trend_slope": f"""WITH {st.MONTHLY} SELECT region, {_MONTH}, round(CASE WHEN count(v) OVER w >= 2 THEN
  regr_slope(v, (year(month) - 1970) * 12 + month(month)) OVER w END, 4) AS slope FROM monthly WINDOW w AS ({_BY_T} RANGE BETWEEN 59 PRECEDING AND CURRENT ROW)""",
    "regime_shift": f"""WITH {st.MONTHLY}, s AS (SELECT region, month, avg(v) OVER ({_BY_T} RANGE BETWEEN CURRENT ROW AND 11 FOLLOWING)
  - avg(v) OVER ({_BY_T} RANGE BETWEEN 12 PRECEDING AND 1 PRECEDING) AS shift, stddev_pop(v) OVER (PARTITION BY region) AS sd FROM monthly)
SELECT region, {_MONTH}, round(shift, 4) AS shift, abs(shift) > sd AS is_shift FROM s WHERE shift IS NOT NULL""",
    "gap_series": f"""WITH {st.MONTHLY}, g AS (SELECT *, year(month) * 12 + month(month) AS t FROM monthly WHERE (year(month) * 12 + month(month)) % 7 <> 3),
w AS (SELECT region, month, v, t, max(v) OVER (PARTITION BY region ORDER BY t RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS one,
    max(v) OVER (PARTITION BY region ORDER BY t RANGE BETWEEN 2 PRECEDING AND 2 PRECEDING) AS two,
    stddev_samp(v) OVER (PARTITION BY region ORDER BY t RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) AS sd,
    count(v) OVER (PARTITION BY region ORDER BY t RANGE BETWEEN 59 PRECEDING AND CURRENT ROW) AS n,
    regr_slope(v, t) OVER (PARTITION BY region ORDER BY t RANGE BETWEEN 59 PRECEDING AND CURRENT ROW) AS slope,
    avg(v) OVER (PARTITION BY region ORDER BY t RANGE BETWEEN CURRENT ROW AND 11 FOLLOWING)
      - avg(v) OVER (PARTITION BY region ORDER BY t RANGE BETWEEN 12 PRECEDING AND 1 PRECEDING) AS shift FROM g)
SELECT region, {_MONTH}, round(v - one, 6) AS delta, round(v - 2 * one + two, 6) AS acceleration, round(sd, 4) AS volatility,
  round(CASE WHEN n >= 2 THEN slope END, 4) AS slope, round(shift, 4) AS shift FROM w""",
    "seasonal_summary": f"""WITH {st.MONTHLY} SELECT region, CAST(year(month) AS INTEGER) AS year, round(avg(v), 4) AS mean, round(max(v), 6) AS peak,
  round(max(v) - min(v), 6) AS amplitude FROM monthly GROUP BY 1, 2""",
    "phenology": f"""WITH {st.MONTHLY}, y AS (SELECT region, CAST(year(month) AS INTEGER) AS year, CAST(month(month) AS INTEGER) AS m, v, min(v) OVER w AS lo, max(v) OVER w AS hi
  FROM monthly WINDOW w AS (PARTITION BY region, year(month)))
SELECT region, year, min(m) FILTER (v > lo + (hi - lo) * 0.5::DOUBLE) AS green_up, max(m) FILTER (v > lo + (hi - lo) * 0.5::DOUBLE) AS senescence FROM y GROUP BY 1, 2""",
    "monthly_anomaly": f"""WITH {st.MONTHLY} SELECT region, {_MONTH}, round(v, 6) AS v, round(avg(v) OVER w, 4) AS normal,
  round(v - avg(v) OVER w, 4) AS anomaly FROM monthly WINDOW w AS (PARTITION BY region, month(month))""",
    "aridity": f"""WITH {st.MONTHLY}, {st.RAIN}, r AS (SELECT region, CAST(date_trunc('month', day) AS DATE) AS month, sum(v) AS pr FROM rain GROUP BY 1, 2)
SELECT region, CAST(year(month) AS INTEGER) AS year, round(sum(pr), 4) AS precip, round(sum(v / 100), 4) AS pet, round(sum(pr) / sum(v / 100), 4) AS aridity
FROM r JOIN monthly USING (region, month) GROUP BY 1, 2""",
    "gdd": f"""WITH {st.DAILY} SELECT region, CAST(year(day) AS INTEGER) AS year, round(sum(greatest((hi / 10000 + lo / 10000) / 2 - 10, 0)), 7) AS gdd FROM daily GROUP BY 1, 2""",
    "vpd": f"""WITH {st.DAILY}, {st.RAIN}, b AS (SELECT region, daily.v / 10000 AS t, least(rain.v, 100.0) AS rh FROM daily JOIN rain USING (region, day)),
e AS (SELECT region, 0.6108::DOUBLE * exp(17.27::DOUBLE * t / (t + 237.3::DOUBLE)) * (1 - rh / 100) AS vpd FROM b)
SELECT region, round(avg(vpd), 6) AS vpd_mean, round(max(vpd), 6) AS vpd_max FROM e GROUP BY 1""",
    "soil_bucket": f"""WITH RECURSIVE {st.MONTHLY}, s AS (SELECT region, v, row_number() OVER ({_BY}) AS i, count(*) OVER (PARTITION BY region) AS n FROM monthly),
f AS (SELECT region, 0::BIGINT AS i, 0.0::DOUBLE AS w FROM (SELECT DISTINCT region FROM monthly)
  UNION ALL SELECT s.region, s.i, greatest(0.0::DOUBLE, least(200000.0::DOUBLE, w + (s.v - 300000))) FROM f JOIN s ON s.region = f.region AND s.i = f.i + 1)
SELECT f.region, CAST(n AS INTEGER) AS n_periods, round(w, 6) AS storage FROM f JOIN s ON s.region = f.region AND s.i = f.i WHERE f.i = n""",
    "yearly_landcover": f"WITH {_YEARLY} SELECT * FROM yearly",
    "transition_rates": f"""WITH {_YEARLY}, p AS (SELECT a.class AS from_class, b.class AS to_class, count(*) AS n FROM yearly a JOIN yearly b ON a.cell = b.cell AND b.year = a.year + 1 GROUP BY 1, 2)
SELECT from_class, to_class, n, round(n / sum(n) OVER (PARTITION BY from_class), 6) AS rate FROM p""",
}
