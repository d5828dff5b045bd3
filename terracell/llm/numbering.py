"""Gapless row numbers within groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

PARTS = 64


def number_rows(rows: DataFrame, group: str, cell: str, order: list, name: str) -> DataFrame:
    """``name``: the number of a row in its ``group``, from 0, ordered by ``cell`` and then ``order``.

    ``rows`` must be a stored table, ``group`` free of nulls and ``cell`` of few
    values per group: rows are sorted within (group, cell) only, and the counts
    of the cells give each its first number, so a group that holds most rows is
    still spread over its cells.
    """
    counts = rows.groupBy(group, cell).agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(group, cell, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    at = F.row_number().over(Window.partitionBy(group, cell).orderBy(*order)) - 1
    return rows.withColumn("_at", at).join(first, [group, cell]).withColumn(
        name, (F.col("_first") + F.col("_at")).cast("long")).drop("_at", "_first")
