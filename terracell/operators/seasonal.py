"""Seasonal, climate and land-cover features from (entity, period, value) tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.climate import degree_days, vapor_pressure_deficit


def seasonal_summary(df: DataFrame, keys: list[str], period: str, value: str) -> DataFrame:
    """Mean, peak and amplitude per entity and year."""
    return df.groupBy(*keys, F.year(period).alias("year")).agg(
        F.avg(value).alias("mean"), F.max(value).alias("peak"),
        (F.max(value) - F.min(value)).alias("amplitude"),
    )


def phenology(df: DataFrame, keys: list[str], period: str, value: str) -> DataFrame:
    """First and last month of each year above half of the year's amplitude."""
    year = Window.partitionBy(*keys, "year")
    by_year = df.withColumn("year", F.year(period))
    base, top = F.min(value).over(year), F.max(value).over(year)
    active = by_year.withColumn("_on", F.col(value) > base + (top - base) * 0.5)
    month = lambda agg: agg(F.when(F.col("_on"), F.month(period)))
    return active.groupBy(*keys, "year").agg(
        month(F.min).alias("green_up"), month(F.max).alias("senescence"),
    )


def monthly_anomaly(df: DataFrame, keys: list[str], period: str, value: str) -> DataFrame:
    """Value minus the mean of the same calendar month of the entity."""
    normal = F.avg(value).over(Window.partitionBy(*keys, F.month(period)))
    return df.select(*keys, period, value, normal.alias("normal"), (F.col(value) - normal).alias("anomaly"))


def aridity(df: DataFrame, keys: list[str], precip: str, pet: str) -> DataFrame:
    total = df.groupBy(*keys).agg(F.sum(precip).alias("precip"), F.sum(pet).alias("pet"))
    return total.withColumn("aridity", F.col("precip") / F.nullif(F.col("pet"), F.lit(0.0)))


def growing_degree_days(df: DataFrame, keys: list[str], tmax: Column, tmin: Column, base: float) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(degree_days(tmax, tmin, base)).alias("gdd"))


def vpd_summary(df: DataFrame, keys: list[str], temp_c: Column, humidity: Column) -> DataFrame:
    vpd = vapor_pressure_deficit(temp_c, humidity)
    return df.groupBy(*keys).agg(F.avg(vpd).alias("vpd_mean"), F.max(vpd).alias("vpd_max"))


def yearly_class(observations: DataFrame, cell: str, year: Column, cls: str) -> DataFrame:
    """Majority class per cell and year; equal votes go to the class that sorts first.

    Votes are counted before the shuffle, so a cell sends at most years ×
    classes rows; the rest of the chain reuses one partitioning by cell.
    """
    votes = observations.groupBy(F.col(cell).alias("cell"), year.alias("year"), F.col(cls).alias("k")).agg(
        F.count("*").alias("n")
    ).repartition("cell")
    return votes.groupBy("cell", "year").agg(F.min(F.struct(-F.col("n"), F.col("k").alias("k"))).alias("w")).select(
        "cell", "year", F.col("w.k").alias("class")
    )


def transition_rates(yearly: DataFrame) -> DataFrame:
    """Share of each class that turns into each class from one year to the next."""
    line = Window.partitionBy("cell").orderBy("year")
    steps = yearly.select(
        F.lag("class").over(line).alias("from_class"), F.col("class").alias("to_class"),
        (F.col("year") - F.lag("year").over(line)).alias("gap"),
    ).where("gap = 1")
    counts = steps.groupBy("from_class", "to_class").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("from_class"))
    return counts.withColumn("rate", F.col("n") / total)
