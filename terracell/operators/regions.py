"""Selecting region polygons and attaching their canonical columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import CODE_SAMPLE, DEFAULT_LEVEL, DEFAULT_SCHEME, OUTPUT_COLUMNS
from ..functions.codes import normalize_code, with_code
from ..functions.crs import reproject
from ..functions.rings import geom_bounds, is_usable


def wanted_regions(regions: DataFrame, scheme: str = DEFAULT_SCHEME, level: int = DEFAULT_LEVEL) -> DataFrame:
    """Catalog rows of one scheme and level, with the normalised ``code``."""
    same_level = F.coalesce(F.col("level").cast("int"), F.lit(-1)) == level
    return regions.where((F.col("scheme") == scheme) & same_level).select(
        "uid", normalize_code(F.col("code").cast("string")).alias("code"),
        F.coalesce("name", F.lit("")).alias("name"),
    )


def duplicate_codes(wanted: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Codes that occur more than once within ``keys``."""
    return wanted.groupBy(*(keys or []), "code").agg(F.count("*").alias("n")).where("n > 1")


def check_wanted(wanted: DataFrame, scheme: str, level: int) -> None:
    """Fail on an empty selection, an invalid code or a repeated code."""
    per_code = wanted.groupBy("code").agg(F.count("*").alias("n"))
    row = per_code.agg(
        F.count("*").alias("codes"), F.count_if(F.col("code") == "").alias("blank"),
        F.min(F.when(F.col("n") > 1, F.col("code"))).alias("repeated"),
    ).first()
    if row["codes"] == 0:
        raise ValueError(f"no regions for scheme={scheme} level={level}")
    if row["blank"]:
        raise ValueError("a wanted region has no valid code")
    if row["repeated"] is not None:
        raise ValueError(f"code {row['repeated']!r} is repeated; codes must be unique per scheme and level")


def wanted_codes(regions: DataFrame) -> DataFrame:
    return regions.select(normalize_code(F.col("code").cast("string")).alias("code")).where("code <> ''").distinct()


def code_sample(features: DataFrame, field: str = "code", n: int = CODE_SAMPLE) -> DataFrame:
    """First distinct non-empty codes in text order."""
    codes = with_code(features, field, "code").select("code").where("code <> ''").distinct()
    return codes.orderBy("code").limit(n)


def code_field_score(name: Column) -> Column:
    """How likely a column of this name holds the level-three code."""
    n = F.lower(name)
    has = lambda *words: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(n, w))
    points = lambda test, p: F.when(test, p).otherwise(0)
    return (
        points(has("l3", "level3", "lvl3"), 4)
        + points(has("code"), 3)
        + points(has("us") & has("l3", "level3"), 2)
        + points(has("eco", "region"), 1)
        + points(has("name", "desc", "label"), -2)
    )


def best_code_fields(columns: DataFrame, minimum: int = 3) -> DataFrame:
    """Best-scoring column per dataset from a (dataset, column) catalog.

    Ties go to the name that sorts last; ``confident`` is false below ``minimum``.
    """
    scored = columns.select("dataset", "column", code_field_score(F.col("column")).alias("score"))
    best = scored.groupBy("dataset").agg(F.max(F.struct("score", "column")).alias("b"))
    return best.select("dataset", "b.column", "b.score", (F.col("b.score") >= minimum).alias("confident"))


def pick_code_field(columns: list[str], preferred: str | None = None) -> str:
    """The code column of one layer, from its schema."""
    from pyspark.sql import SparkSession

    if preferred:
        if preferred not in columns:
            raise ValueError(f"code field {preferred!r} not found; columns: {columns}")
        return preferred
    spark = SparkSession.getActiveSession()
    names = spark.createDataFrame([(c,) for c in columns], "column STRING")
    top = names.select("column", code_field_score(F.col("column")).alias("score")).orderBy(
        F.desc("score"), F.desc("column")
    ).limit(8).collect()
    if not top or top[0]["score"] < 3:
        guesses = [(r["score"], r["column"]) for r in top]
        raise ValueError(f"cannot infer the code column; name it explicitly. Best guesses: {guesses}")
    return top[0]["column"]


def select_features(features: DataFrame, wanted: DataFrame, scheme: str, level: int) -> DataFrame:
    """Features (with ``code``) of the wanted regions, canonical columns attached.

    Semi join and lookup in one: every wanted code is unique. The catalog is
    left to the optimizer, which broadcasts it by its real size.
    """
    own = [c for c in features.columns if c not in ("uid", "name", "scheme", "level")]
    return features.select(*own).join(wanted.select("code", "uid", "name"), "code").withColumns(
        {"scheme": F.lit(scheme), "level": F.lit(level)}
    )


def drop_unusable(features: DataFrame) -> DataFrame:
    return features.where(is_usable(F.col("geom")))


def output_columns(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in OUTPUT_COLUMNS if c in df.columns])


def missing_codes(wanted: DataFrame, found: DataFrame) -> DataFrame:
    """Wanted codes without a feature."""
    return wanted.select("code").distinct().join(found.select("code").distinct(), "code", "left_anti")


def feature_bounds(features: DataFrame) -> DataFrame:
    """One bounds row per feature row."""
    keep = [c for c in ("uid", "code", "name") if c in features.columns]
    area = [c for c in ("area_km2",) if c in features.columns]
    return features.select(*keep, geom_bounds(F.col("geom")).alias("b"), *area).select(*keep, "b.*", *area)


def region_bounds(features: DataFrame, keys: list[str]) -> DataFrame:
    """One bounds row per key over all its features, with their number."""
    boxes = features.select(*keys, geom_bounds(F.col("geom")).alias("b"))
    return boxes.groupBy(*keys).agg(
        F.min("b.xmin").alias("xmin"), F.min("b.ymin").alias("ymin"),
        F.max("b.xmax").alias("xmax"), F.max("b.ymax").alias("ymax"),
        F.count("*").alias("n_features"),
    )


def reproject_bounds(boxes: DataFrame, keys: list[str], source: str, target: str, added: int = 21) -> DataFrame:
    """Boxes (xmin..ymax per key) in another CRS, with ``added`` points per edge.

    The points are rows for a moment, so the projection runs as compiled code;
    they are combined again before the shuffle.
    """
    c = F.col
    share = c("_i") / F.lit(float(added + 1))
    across = c("xmin") + (c("xmax") - c("xmin")) * share
    along = c("ymin") + (c("ymax") - c("ymin")) * share
    points = F.array(*[
        F.struct(x.alias("x"), y.alias("y"))
        for x, y in ((across, c("ymin")), (across, c("ymax")), (c("xmin"), along), (c("xmax"), along))
    ])
    steps = boxes.select(*keys, "xmin", "ymin", "xmax", "ymax", F.explode(
        F.sequence(F.lit(0), F.lit(added + 1))).alias("_i"))
    outline = steps.select(*keys, F.explode(points).alias("_p")).select(*keys, "_p.x", "_p.y")
    x, y = reproject(c("x"), c("y"), source, target)
    return outline.select(*keys, x.alias("x"), y.alias("y")).groupBy(*keys).agg(
        F.min("x").alias("xmin"), F.min("y").alias("ymin"), F.max("x").alias("xmax"), F.max("y").alias("ymax")
    )


def merge_suspects(features: DataFrame) -> DataFrame:
    """uids that carry more than one code or name."""
    pairs = features.groupBy("uid").agg(
        F.count_distinct("name").alias("n_names"), F.count_distinct("code").alias("n_codes")
    )
    return pairs.where("n_names > 1 or n_codes > 1")
