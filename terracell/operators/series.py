"""Operators on time series per region or cell.

Each entity holds one row per day or month, so a window over one entity is
bounded by the calendar, never by the raw rows: aggregate to (entity, period)
first. ``keys`` are the entity columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..constants import DOY_HALF_WINDOW
from ..functions.binding import let


def _day_number(day: str) -> Column:
    return F.unix_date(F.col(day))


def rolling_anomaly(df: DataFrame, keys: list[str], day: str, value: str, windows: tuple[int, ...]) -> DataFrame:
    """Mean over the last n days (by date, gaps shrink the sample) and its z-score
    against the entity's own history of that mean."""
    line = Window.partitionBy(*keys).orderBy(_day_number(day))
    rolled = df.select(
        *keys, day,
        *[F.avg(value).over(line.rangeBetween(-(n - 1), 0)).alias(f"mean_{n}") for n in windows],
    )
    whole = Window.partitionBy(*keys)
    z = lambda n: zscore(F.col(f"mean_{n}"), whole)
    return rolled.select("*", *[z(n).alias(f"z_{n}") for n in windows])


def zscore(value: Column, group) -> Column:
    """Standard score with the population deviation; NULL for a constant group."""
    return (value - F.avg(value).over(group)) / F.nullif(F.stddev_pop(value).over(group), F.lit(0.0))


def _sorted_quantile(values: Column, prob: float) -> Column:
    """Quantile of a sorted array, with linear interpolation."""
    spot = (F.size(values) - 1) * F.lit(float(prob))
    low = F.get(values, F.floor(spot).cast("int"))
    high = F.get(values, F.ceil(spot).cast("int"))
    return low + (high - low) * (spot - F.floor(spot))


def doy_thresholds(df: DataFrame, keys: list[str], day: str, value: str, probs: dict[str, float],
                   half_window: int = DOY_HALF_WINDOW) -> DataFrame:
    """Quantiles per entity and day of year over the days within ``half_window``.

    Values are gathered per day of year first (one per year) and only those
    short arrays are handed to the neighbouring days; the calendar bounds both.
    """
    per_doy = df.where(F.col(value).isNotNull()).groupBy(*keys, F.dayofyear(F.col(day)).alias("_at")).agg(
        F.collect_list(F.col(value).cast("double")).alias("_vs")
    )
    offsets = F.sequence(F.lit(-half_window), F.lit(half_window))
    near = F.transform(offsets, lambda o: (F.col("_at") - 1 + o + 366) % 366 + 1)
    pooled = per_doy.select(*keys, "_vs", F.explode(near).alias("doy")).groupBy(*keys, "doy").agg(
        F.flatten(F.collect_list("_vs")).alias("_vs")
    )
    limits = let(F.sort_array("_vs"), lambda v: F.struct(*[_sorted_quantile(v, p).alias(n) for n, p in probs.items()]))
    return pooled.select(*keys, "doy", limits.alias("_q")).select(*keys, "doy", "_q.*")


def beyond_doy_threshold(df: DataFrame, keys: list[str], day: str, value: str, prob: float, above: bool) -> DataFrame:
    """Days above (or below) their own day-of-year quantile."""
    limits = doy_thresholds(df, keys, day, value, {"threshold": prob})
    joined = df.withColumn("doy", F.dayofyear(F.col(day))).join(limits, [*keys, "doy"])
    test = F.col(value) > F.col("threshold") if above else F.col(value) < F.col("threshold")
    return joined.where(test).select(*keys, day, value, "threshold")


def below_local_quantile(df: DataFrame, keys: list[str], value: str, prob: float) -> DataFrame:
    """Rows below the entity's own quantile."""
    limit = F.percentile(value, F.lit(prob)).over(Window.partitionBy(*keys))
    return df.withColumn("threshold", limit).where(F.col(value) < F.col("threshold"))


def runs(df: DataFrame, keys: list[str], day: str, value: str, extreme: str = "max") -> DataFrame:
    """Runs of consecutive dates among the given (flagged) days."""
    order = Window.partitionBy(*keys).orderBy(day)
    island = F.date_sub(F.col(day), F.row_number().over(order))
    pick = F.max if extreme == "max" else F.min
    return df.withColumn("_run", island).groupBy(*keys, "_run").agg(
        F.min(day).alias("start_day"), F.max(day).alias("end_day"),
        F.count("*").alias("n_days"), pick(value).alias("intensity"),
    ).drop("_run")


def event_summary(events: DataFrame, keys: list[str]) -> DataFrame:
    """Counts, durations, intensity and season of the runs of each entity.

    The season is the start month of the longest run; equal lengths go to the
    earliest.
    """
    first_longest = F.min_by(F.month("start_day"), F.struct(-F.col("n_days"), F.col("start_day")))
    return events.groupBy(*keys).agg(
        F.count("*").alias("n_events"), F.sum("n_days").alias("event_days"),
        F.max("n_days").alias("longest"), F.avg("n_days").alias("mean_days"),
        F.max("intensity").alias("max_intensity"), first_longest.alias("start_month"),
    )


def days_since_last(df: DataFrame, keys: list[str], day: str, is_event: Column) -> DataFrame:
    """Days since the last event day up to each day; NULL before the first."""
    upto = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(is_event, F.col(day)), ignorenulls=True).over(upto)
    return df.select(*keys, day, F.datediff(F.col(day), last).alias("days_since"))


def _period_number(period: str, per: str) -> Column:
    """Months or days counted through the calendar, so that frames measure time, not rows."""
    return (F.year(period) * 12 + F.month(period)).cast("long") if per == "month" else _day_number(period).cast("long")


def _calendar(df: DataFrame, keys: list[str], period: str, per: str):
    """``df`` with the number of its period, and the window in calendar order to put a RANGE frame on."""
    return df.withColumn("_t", _period_number(period, per)), Window.partitionBy(*keys).orderBy("_t")


def acceleration(df: DataFrame, keys: list[str], period: str, value: str, per: str = "month") -> DataFrame:
    """First and second difference to the one and two periods before; NULL where one of them is missing."""
    dated, order = _calendar(df, keys, period, per)
    one, two = (F.max(value).over(order.rangeBetween(-k, -k)) for k in (1, 2))
    return dated.select(
        *keys, period, value, (F.col(value) - one).alias("delta"),
        (F.col(value) - one * 2 + two).alias("acceleration"),
    )


def volatility(df: DataFrame, keys: list[str], period: str, value: str, length: int, per: str = "month") -> DataFrame:
    """Deviation over the last ``length`` periods of the calendar; missing ones do not reach further back."""
    dated, order = _calendar(df, keys, period, per)
    return dated.select(*keys, period, F.stddev_samp(value).over(order.rangeBetween(-(length - 1), 0)).alias("volatility"))


def trend(df: DataFrame, keys: list[str], period: str, value: str, length: int, per: str = "month") -> DataFrame:
    """Slope per period over the last ``length`` periods of the calendar; NULL for fewer than two values."""
    dated, order = _calendar(df, keys, period, per)
    frame = order.rangeBetween(-(length - 1), 0)
    slope = F.when(F.count(value).over(frame) >= 2, F.regr_slope(F.col(value), F.col("_t").cast("double")).over(frame))
    return dated.select(*keys, period, slope.alias("slope"))


def stress_signal(df: DataFrame, keys: list[str], period: str, value: str) -> DataFrame:
    """z-score, percent rank and return period (n + 1) / rank within the entity."""
    group = Window.partitionBy(*keys)
    n = F.count(value).over(group)
    return df.select(
        *keys, period, value, zscore(F.col(value), group).alias("z"),
        F.percent_rank().over(group.orderBy(value)).alias("pct_rank"),
        ((n + 1) / F.rank().over(group.orderBy(F.desc(value)))).alias("return_period"),
    )


def regime_shift(df: DataFrame, keys: list[str], period: str, value: str, length: int, sigmas: float, per: str = "month") -> DataFrame:
    """Compares the mean of the ``length`` periods from here on with the mean of those before; no row where one side is empty."""
    dated, order = _calendar(df, keys, period, per)
    before = F.avg(value).over(order.rangeBetween(-length, -1))
    after = F.avg(value).over(order.rangeBetween(0, length - 1))
    sigma = F.stddev_pop(value).over(Window.partitionBy(*keys))
    shift = dated.select(*keys, period, (after - before).alias("shift"), sigma.alias("_s"))
    return shift.where("shift is not null").select(
        *keys, period, "shift", (F.abs("shift") > F.col("_s") * sigmas).alias("is_shift")
    )


def running_bucket(df: DataFrame, keys: list[str], period: str, change: Column, capacity: float) -> DataFrame:
    """Store filled and emptied in time order, held between 0 and ``capacity``.

    The fold needs order; it runs over one entity's periods, which the calendar bounds.
    """
    steps = df.select(*keys, F.struct(F.col(period).alias("t"), change.cast("double").alias("d")).alias("s"))
    series = steps.groupBy(*keys).agg(F.array_sort(F.collect_list("s")).alias("s"))
    clamp = lambda w: F.greatest(F.lit(0.0), F.least(F.lit(float(capacity)), w))
    return series.select(
        *keys, F.size("s").alias("n_periods"),
        F.aggregate("s", F.lit(0.0), lambda w, s: clamp(w + s.getField("d"))).alias("storage"),
    )


def compound_events(left: DataFrame, right: DataFrame, keys: list[str], day: str, min_days: int,
                    high: float = 1.0, low: float = -1.0) -> DataFrame:
    """Runs of at least ``min_days`` days with the left series high and the right one low.

    Both have ``value``; scores are relative to each entity's own history.
    """
    group = Window.partitionBy(*keys)
    score = lambda df, name: df.select(*keys, day, zscore(F.col("value"), group).alias(name))
    both = score(left, "z_a").join(score(right, "z_b"), [*keys, day])
    hits = both.where((F.col("z_a") > high) & (F.col("z_b") < low))
    return runs(hits, keys, day, "z_a").where(F.col("n_days") >= min_days)
