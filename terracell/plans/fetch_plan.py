"""What to fetch: one row per raster file, before anything is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.names import aoi_name, file_name, pad_month, render_template, stem

_ALL_MONTHS = [f"{m:02d}" for m in range(1, 13)]


def resolve_variables(requested: Column, active: Column) -> Column:
    """Requested variables, else the active ones; neither is an error."""
    listed = F.when(F.size(active) > 0, active)
    missing = F.raise_error(F.lit("no variables requested and none active")).cast("array<string>")
    return F.coalesce(requested, listed, missing)


def resolve_months(requested: Column, configured: Column) -> Column:
    """Requested months, else the configured ones, else all; two digits each."""
    chosen = F.coalesce(
        requested, F.when(F.size(configured) > 0, configured), F.array(*[F.lit(m) for m in _ALL_MONTHS])
    )
    return F.transform(chosen, pad_month)


def year_range(start: Column, end: Column) -> Column:
    """Inclusive years. Without the guard ``sequence`` would count down."""
    bad = F.raise_error(F.concat(
        F.lit("start_year "), start.cast("string"), F.lit(" is after end_year "), end.cast("string")
    )).cast("array<int>")
    return F.when(start > end, bad).otherwise(F.sequence(start.cast("int"), end.cast("int")))


def expand_plan(requests: DataFrame) -> DataFrame:
    """(source, n, var, year, month) for each request, variables outermost.

    ``requests`` has source, vars, years, months (arrays) and any context
    columns. ``n`` is the position in the nested loop, computed from the three
    positions, so numbering needs neither a sort nor a window.
    """
    per_year = F.size("months")
    per_var = F.size("years") * per_year
    context = [c for c in requests.columns if c not in ("vars", "years", "months")]
    wide = requests.select(
        *context, "years", "months", per_year.alias("_py"), per_var.alias("_pv"),
        F.posexplode("vars").alias("_v", "var"),
    )
    wide = wide.select(*[c for c in wide.columns if c != "years"], F.posexplode("years").alias("_y", "year"))
    wide = wide.select(*[c for c in wide.columns if c != "months"], F.posexplode("months").alias("_m", "month"))
    n = F.col("_v").cast("bigint") * F.col("_pv") + F.col("_y") * F.col("_py") + F.col("_m") + 1
    return wide.withColumn("n", n).drop("_v", "_y", "_m", "_py", "_pv")


def with_urls(plan: DataFrame, template: str | Column, context: dict[str, Column]) -> DataFrame:
    """Adds the url and the name of the clipped output."""
    values = {**context, "var": F.col("var"), "year": F.col("year"), "month": F.col("month")}
    return plan.withColumn("url", render_template(template, values)).withColumn(
        "out_name", aoi_name(file_name(F.col("url")))
    )


def limit_plan(plan: DataFrame, limit: int | None) -> DataFrame:
    """First ``limit`` items of each request, counted before any skipping."""
    return plan if limit is None else plan.where(F.col("n") <= limit)


def skip_existing(plan: DataFrame, existing: DataFrame, on: list[str], overwrite: bool = False) -> DataFrame:
    """Items whose output is not there yet (all of them when overwriting)."""
    return plan if overwrite else plan.join(existing.select(*on), on, "left_anti")


def mark_actions(plan: DataFrame, existing: DataFrame, on: list[str], overwrite: bool = False) -> DataFrame:
    """The plan with ``action`` fetch or skip: the answer of a dry run.

    ``existing`` may repeat: it is only asked whether a name is there, so no
    task has to hold the different names.
    """
    asked = {c: f"_asked_{i}" for i, c in enumerate(on)}  # names that ``existing`` does not know
    there = existing.select(*on)
    for c, name in asked.items():
        there = there.where(F.col(c) == F.col(name).outer())
    skip = there.exists() & F.lit(not overwrite)
    rest = [c for c in plan.columns if c not in on]
    return plan.select(*[F.col(c).alias(n) for c, n in asked.items()], *rest).select(
        *[F.col(n).alias(c) for c, n in asked.items()], *rest, F.when(skip, "skip").otherwise("fetch").alias("action"))


def resolve_coverage(requested: Column, default: Column, coverage: Column, mapping: Column) -> Column:
    """Struct (name, code, known): requested, else default, else the declared
    coverage, mapped to the provider's code. An unmapped name passes through
    with ``known`` false, for the caller to reject."""
    name = F.coalesce(requested, default, coverage)
    code = F.try_element_at(mapping, name)
    return F.struct(
        name.alias("name"), F.coalesce(code, name).alias("code"), code.isNotNull().alias("known")
    )


def archive_plan(sources: DataFrame, context: dict[str, Column]) -> DataFrame:
    """One archive per source row: its url and file name."""
    return sources.withColumn("url", render_template(F.col("url_template"), context)).withColumn(
        "out_name", file_name(F.col("url"))
    )


def archive_actions(plan: DataFrame, archives: DataFrame, extracted: DataFrame, overwrite: bool = False) -> DataFrame:
    """What is left to do per archive: skip, extract or fetch.

    ``archives`` lists the archive files present (out_name), ``extracted`` the
    folders that already hold unpacked data (stem, the name without its ending).
    """
    have = archives.select("out_name").distinct().withColumn("_zip", F.lit(True))
    done = extracted.select("stem").distinct().withColumn("_dir", F.lit(True))
    both = plan.withColumn("stem", stem(F.col("out_name"))).join(
        have, "out_name", "left"
    ).join(done, "stem", "left")
    return both.withColumn(
        "action",
        F.when(F.lit(overwrite), "fetch").when(F.col("_dir"), "skip").when(F.col("_zip"), "extract").otherwise("fetch"),
    ).drop("_zip", "_dir", "stem")
