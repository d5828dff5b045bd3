"""Region codes: one comparable spelling per code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def normalize_code(text: Column) -> Column:
    """First alphanumeric token; an all-digit token loses its leading zeros.

    NULL and token-free text give ''. Digits are never cast to a number, so
    codes of any length keep their value.
    """
    token = F.regexp_extract(text, "[A-Za-z0-9]+", 0)
    stripped = F.when(token.rlike("^[0-9]+$"), F.regexp_replace(token, "^0+(?=[0-9])", ""))
    return F.coalesce(stripped, token, F.lit(""))


def code_text(df: DataFrame, field: str) -> Column:
    """Text of a code column of any primitive type (NaN counts as missing)."""
    col = F.col(f"`{field}`")
    if isinstance(df.schema[field].dataType, (T.DoubleType, T.FloatType)):
        whole = (col == F.floor(col)) & (F.abs(col) < F.lit(1e15))
        return F.when(
            ~F.isnan(col),
            F.when(whole, col.cast("bigint").cast("string")).otherwise(col.cast("string")),
        )
    return col.cast("string")


def with_code(df: DataFrame, field: str, out: str = "code") -> DataFrame:
    return df.withColumn(out, normalize_code(code_text(df, field)))


def is_blank(text: Column) -> Column:
    return F.coalesce(F.length(F.trim(text)) == 0, F.lit(True))
