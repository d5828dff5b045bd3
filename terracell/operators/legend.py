"""Names of raster classes from a legend table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .joins import lookup_join


def check_legend(legend: DataFrame) -> None:
    """Raise if a class has several names or none."""
    bad = legend.groupBy("class").agg(F.count("*").alias("n"), F.count("name").alias("named")).where("n > 1 OR named = 0").orderBy("class").first()
    if bad:
        raise ValueError(f"legend names class {bad['class']!r} {bad['named']} times")


def class_names(cells: DataFrame, legend: DataFrame, cls: str = "class", unknown: str = "unclassified", check: bool = True) -> DataFrame:
    """``cells`` with ``class_name`` from ``legend`` (class, name); classes it does not list are ``unknown``, missing ones stay NULL."""
    if check:
        check_legend(legend)
    named = lookup_join(cells, legend.select(F.col("class").alias(cls), F.col("name").alias("class_name")), [cls], "left")
    return named.withColumn("class_name", F.when(F.col(cls).isNotNull(), F.coalesce("class_name", F.lit(unknown))))


def unused_classes(cells: DataFrame, legend: DataFrame, cls: str = "class") -> DataFrame:
    """Legend rows without a cell."""
    return legend.join(cells.select(F.col(cls).alias("class")).distinct(), "class", "left_anti")
