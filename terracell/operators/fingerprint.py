"""Content hash of a table, independent of row order and partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _text(df: DataFrame, name: str, digits: int) -> Column:
    kind = df.schema[name].dataType.typeName()
    col = F.col(name)
    if kind in ("double", "float"):
        # Whole units of 10^-digits, so summation order cannot show.
        col = F.round(col * 10**digits).cast("decimal(38,0)")
    return F.coalesce(col.cast("string"), F.lit("~"))


def content_hash(df: DataFrame, columns: list[str], digits: int = 3) -> DataFrame:
    """Row count and the sum of the row digests (first 12 hex digits of md5)."""
    row = F.concat_ws("|", *[_text(df, c, digits) for c in columns])
    digest = F.conv(F.substring(F.md5(row), 1, 12), 16, 10).cast("decimal(20,0)")
    return df.agg(F.count("*").alias("n_rows"), F.sum(digest).cast("string").alias("content_hash"))
