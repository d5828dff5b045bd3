"""Quality checks. Each returns the offending rows or one verdict row per entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..constants import MAD_SCALE, PCT_SUM_EPS
from ..functions.crs import same_crs

PASS, WARN, FAIL = "pass", "warn", "fail"


def verdict(failed: Column, warned: Column | None = None) -> Column:
    status = F.when(failed, FAIL)
    if warned is not None:
        status = status.when(warned, WARN)
    return status.otherwise(PASS)


def finding(df: DataFrame, check: str, entity: Column, status: Column, detail: Column) -> DataFrame:
    """The common shape of all checks: (check, entity, status, detail)."""
    return df.select(
        F.lit(check).alias("check"), entity.cast("string").alias("entity"),
        status.alias("status"), detail.cast("string").alias("detail"),
    )


def report(*findings: DataFrame) -> DataFrame:
    """Number of findings per check and status."""
    return all_findings(*findings).groupBy("check", "status").agg(F.count("*").alias("n"))


def all_findings(*findings: DataFrame) -> DataFrame:
    out = findings[0]
    for f in findings[1:]:
        out = out.unionByName(f)
    return out


def crs_mismatch(meta: DataFrame, expected: str) -> DataFrame:
    """Rasters whose reference system is missing or not the expected one."""
    return meta.where(~same_crs(F.col("crs"), expected))


def precision_loss(df: DataFrame, x: str, y: str, digits: int, tolerance: float) -> DataFrame:
    """Points moved by more than ``tolerance`` when rounded to ``digits``."""
    moved = F.hypot(F.col(x) - F.round(x, digits), F.col(y) - F.round(y, digits))
    return df.withColumn("moved", moved).where(F.col("moved") > tolerance)


def geometry_findings(measured: DataFrame, min_area: float, min_compactness: float) -> DataFrame:
    """Missing, tiny or sliver polygons from (area, compactness)."""
    bad = F.col("area").isNull() | F.isnan("area") | (F.col("area") <= 0)
    return measured.withColumn(
        "issue",
        F.when(bad, "no_area").when(F.col("area") < min_area, "tiny")
        .when(F.col("compactness") < min_compactness, "sliver"),
    ).where("issue is not null")


def missing_stats(long: DataFrame, stats: DataFrame) -> DataFrame:
    """Region × variable × statistic combinations without a value.

    ``stats`` lists (variable, stat). Each region is expected to have all of
    them; regions are those present in the table.
    """
    wanted = stats.select("variable", "stat").distinct().agg(
        F.array_sort(F.collect_list(F.struct("variable", "stat"))).alias("w")
    )
    regions = long.select("region_uid").distinct()
    expected = regions.select("region_uid", F.explode(wanted.scalar()).alias("w")).select("region_uid", "w.*")
    present = long.where(F.col("value").isNotNull()).select("region_uid", "variable", "stat").distinct()
    return expected.join(present, ["region_uid", "variable", "stat"], "left_anti")


def out_of_range(df: DataFrame, variable: str, value: str, rules: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Rows whose value breaks the limits of their variable; NaN breaks any limit."""
    low = F.create_map(*[p for k, (lo, _) in rules.items() for p in (F.lit(k), F.lit(lo).cast("double"))])
    high = F.create_map(*[p for k, (_, hi) in rules.items() for p in (F.lit(k), F.lit(hi).cast("double"))])
    lo, hi = F.try_element_at(low, F.col(variable)), F.try_element_at(high, F.col(variable))
    known = F.col(variable).isin(*rules)
    broken = F.isnan(value) | F.coalesce(F.col(value) < lo, F.lit(False)) | F.coalesce(F.col(value) > hi, F.lit(False))
    return df.where(known & broken)


def extent_gaps(cells: DataFrame, width: int | None = None, height: int | None = None, keys: list[str] | None = None,
                meta: DataFrame | None = None) -> DataFrame:
    """Cells of the raster extent without a value, as (row, col), per raster if ``keys`` name its columns.

    The columns present are folded into one bit mask per 64 columns before the
    shuffle, so one row moves for 64 cells and only words with a gap are
    unfolded. The extent is ``width`` and ``height``, or that of each raster in
    ``meta`` (keys, width, height): then rasters without any cell are reported
    too. With neither ``height`` nor ``meta`` the rows are those of the table.
    """
    bit = F.when(F.col("value").isNotNull(), F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), F.pmod(F.col("col"), F.lit(64)).cast("int")
    ))
    keys = keys or []
    words = cells.groupBy(*keys, "row", F.floor(F.col("col") / 64).alias("word")).agg(
        F.coalesce(F.bit_or(bit), F.lit(0).cast("bigint")).alias("seen")
    )
    if meta is not None:
        rows = meta.where("height > 0 AND width > 0").select(
            *keys, F.col("width").alias("_width"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("height").cast("bigint") - 1)).alias("row"))
    elif height is None:
        rows = cells.select(*keys, "row").distinct()
    elif keys:
        rows = cells.select(*keys).distinct().withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(height - 1)).cast("array<bigint>")))
    else:
        rows = cells.sparkSession.range(height).select(F.col("id").alias("row"))
    if meta is None:
        rows = rows.withColumn("_width", F.lit(width))
    last = F.floor((F.col("_width") - 1) / 64)
    expected = rows.select(*keys, "row", "_width", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("word"))
    bits = F.when(F.col("word") < last, 64).otherwise(F.col("_width") - last * 64).cast("int")
    full = F.call_function("shiftrightunsigned", F.lit(-1).cast("bigint"), F.lit(64) - bits)
    seen = F.coalesce("seen", F.lit(0).cast("bigint"))
    partial = expected.join(words, [*keys, "row", "word"], "left").where(seen.bitwiseAND(full) != full)
    absent = F.filter(
        F.sequence(F.lit(0), bits - 1),
        lambda i: F.call_function("shiftright", seen, i).bitwiseAND(F.lit(1).cast("bigint")) == 0,
    )
    return partial.select(*keys, "row", "word", F.explode(absent).alias("_i")).select(
        *keys, "row", (F.col("word") * 64 + F.col("_i")).alias("col")
    )


def outside_extent(bounds: DataFrame, extent: DataFrame) -> DataFrame:
    """Regions that reach outside the one-row raster extent (xmin..ymax)."""
    e = lambda c: extent.select(c).scalar()
    return bounds.where(
        (F.col("xmin") < e("xmin")) | (F.col("ymin") < e("ymin"))
        | (F.col("xmax") > e("xmax")) | (F.col("ymax") > e("ymax"))
    )


def nodata_shares(cells: DataFrame, keys: list[str], nodata: Column, limit: float) -> DataFrame:
    """Share of nodata cells per raster; a raster without any value fails."""
    empty = F.col("value").isNull() | F.col("value").eqNullSafe(nodata)
    share = cells.groupBy(*keys).agg((F.count_if(empty) / F.count("*")).alias("nodata_share"))
    return share.withColumn("status", verdict(F.col("nodata_share") >= 1, F.col("nodata_share") > limit))


def row_counts(tables: dict[str, DataFrame], expected: dict[str, int] | None = None) -> DataFrame:
    expected = expected or {}
    parts = []
    for name, df in tables.items():
        want = F.lit(expected.get(name)).cast("bigint")
        n = df.agg(F.count("*").alias("n"))
        ok = F.col("n") == want if name in expected else F.col("n") > 0
        parts.append(finding(n, "row_count", F.lit(name), verdict(~ok), F.col("n")))
    return all_findings(*parts)


def pct_sums(cover: DataFrame, keys: list[str], pct: str = "pct", eps: float = PCT_SUM_EPS) -> DataFrame:
    sums = cover.groupBy(*keys).agg(F.sum(pct).alias("pct_sum"))
    return sums.withColumn("status", verdict(F.abs(F.col("pct_sum") - 1) > eps))


def null_rates(df: DataFrame, keys: list[str], columns: list[str], limit: float) -> DataFrame:
    """Null share of each column per group, against one limit."""
    rates = df.groupBy(*keys).agg(
        F.count("*").alias("n_rows"),
        *[(F.count_if(F.col(c).isNull()) / F.count("*")).alias(c) for c in columns],
    )
    long = rates.unpivot([*keys, "n_rows"], columns, "column", "null_rate")
    return long.withColumn("status", verdict(F.col("null_rate") > limit))


def distribution(df: DataFrame, keys: list[str], period: Column, value: str, max_ratio: float) -> DataFrame:
    """Variance per period against the one before, and constant features."""
    per = df.groupBy(*keys, period.alias("period")).agg(
        F.count(value).alias("n"), F.var_pop(value).alias("variance"),
        (F.min(value) == F.max(value)).alias("is_constant"),
    )
    before = F.lag("variance").over(Window.partitionBy(*keys).orderBy("period"))
    ratio = per.withColumn("ratio", F.col("variance") / F.nullif(before, F.lit(0.0)))
    return ratio.withColumn(
        "status", verdict(F.coalesce(F.col("ratio") > max_ratio, F.lit(False)), F.col("is_constant"))
    )


def missing_periods(df: DataFrame, keys: list[str], period: str, start: str | None, end: str | None, step: str) -> DataFrame:
    """Periods of a calendar that an entity lacks; without ``start`` or ``end`` it runs from the first or to the last period of all."""
    ends = df.agg(F.min(period).alias("lo"), F.max(period).alias("hi"))
    bound = lambda given, name: F.lit(given).cast("date") if given else ends.select(F.col(name).cast("date")).scalar()
    calendar = F.sequence(bound(start, "lo"), bound(end, "hi"), F.expr(f"interval {step}"))
    expected = df.select(*keys).distinct().withColumn(period, F.explode(calendar))
    return expected.join(df.select(*keys, period), [*keys, period], "left_anti")


def duplicate_periods(df: DataFrame, keys: list[str], period: str) -> DataFrame:
    return df.groupBy(*keys, period).agg(F.count("*").alias("n")).where("n > 1")


def leakage(features: DataFrame, targets: DataFrame, on: list[str], feature_ts: str, target_ts: Column) -> DataFrame:
    """Feature rows dated after the target they would predict."""
    return features.join(targets, on).where(F.col(feature_ts) > target_ts)


def outliers(df: DataFrame, keys: list[str], value: str, k: float) -> DataFrame:
    """Rows further than k scaled MADs from the group's median.

    For tables with one row per entity and period, whose groups the calendar bounds.
    """
    group = Window.partitionBy(*keys)
    centred = df.withColumn("_m", F.median(value).over(group)).withColumn("_d", F.abs(F.col(value) - F.col("_m")))
    spread = centred.withColumn("_mad", F.median("_d").over(group) * MAD_SCALE)
    scored = spread.withColumn("robust_z", (F.col(value) - F.col("_m")) / F.nullif(F.col("_mad"), F.lit(0.0)))
    return scored.where(F.abs("robust_z") > k).drop("_m", "_d", "_mad")


def active_flags(variables: DataFrame) -> DataFrame:
    """Catalog variables whose own flag disagrees with the list of active ones."""
    return variables.where(F.col("active") != F.col("listed"))
