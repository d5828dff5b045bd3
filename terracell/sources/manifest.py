"""File manifests and the presence audit of declared inputs."""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..constants import FILE_SAMPLE
from ..functions.codes import is_blank
from ..functions.names import folder_at, folder_depth, glob_folder, glob_regex, plain_path, relative_path

HELD = 100_000  # sources a task keeps samples of

# Executors get the functions themselves, so they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length) of every file below ``root``; contents are never read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select("path", "length")


def _presence(hits: DataFrame) -> DataFrame:
    """(source, n, sample): matches and the first few paths in order, in one pass.

    A task keeps its count and its few smallest paths per source; those of the
    tasks are merged by source.
    """
    def run(batches):
        held: dict[str, list] = {}

        def flush():
            found = [(k, n, paths) for k, (n, paths) in held.items()]
            held.clear()
            columns = list(zip(*found, strict=True)) or [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                columns, (pa.string(), pa.int64(), pa.list_(pa.string())), strict=True)], names=["source", "n", "sample"])

        for b in batches:
            sources, paths = (c.to_numpy(zero_copy_only=False).tolist() for c in b.columns)
            ends = [i for i in range(1, len(sources)) if sources[i] != sources[i - 1]] + [len(sources)] * bool(sources)
            start = 0
            for end in ends:  # a run of rows of one source, long where the join has sorted by folder
                source, part = sources[start], paths[start:end]
                own = held.get(source)
                if own is None:
                    part.sort()
                    held[source] = [end - start, part[:FILE_SAMPLE]]
                else:
                    own[0] += end - start
                    if len(own[1]) < FILE_SAMPLE or min(part) < own[1][-1]:
                        part += own[1]
                        part.sort()
                        own[1] = part[:FILE_SAMPLE]
                start = end
            if len(held) > HELD:
                yield flush()
        yield flush()

    parts = hits.select(F.col("source").cast("string"), "path").mapInArrow(run, "source STRING, n BIGINT, sample ARRAY<STRING>")
    return parts.groupBy("source").agg(
        F.sum("n").alias("n"), F.slice(F.array_sort(F.flatten(F.collect_list("sample"))), 1, FILE_SAMPLE).alias("sample"))


def audit_sources(sources: DataFrame, files: DataFrame, wanted: DataFrame | None = None, root: str = "") -> DataFrame:
    """Presence of the files each source declares.

    ``sources`` has source, local_glob, cache_dir, relative to ``root``;
    ``files`` has path, as listed (absolute, with a scheme) or relative. A glob
    rule needs one match, a folder rule one file at any
    depth, no rule passes as 'unchecked'. ``wanted`` (source) limits the audit
    and reports ids the catalog does not know.

    Files meet rules by folder, at the depths rules have, so a rule is compared
    with the files of its own folder only. The listing is read once.
    """
    catalog = sources.select(
        "source",
        F.when(~is_blank(F.col("local_glob")), F.lit("local_glob"))
        .when(~is_blank(F.col("cache_dir")), F.lit("cache_dir"))
        .otherwise(F.lit("none")).alias("rule"),
        "local_glob", "cache_dir",
    )
    glob = F.col("rule") == "local_glob"
    rules = catalog.where(F.col("rule") != "none").select(
        F.col("source").cast("string").alias("source"), "rule",
        F.when(glob, glob_folder(F.col("local_glob"))).otherwise(F.nullif(plain_path(F.col("cache_dir")), F.lit("."))).alias("folder"),
        F.when(glob, glob_regex(F.col("local_glob"))).alias("pattern"),
    ).withColumn("folder", F.coalesce("folder", F.lit("")))
    depth = F.when(F.col("folder") == "", 0).otherwise(folder_depth(F.col("folder")) + 1)
    depths = sorted(r[0] for r in rules.select(depth.alias("d")).distinct().collect())  # as many as folders can be nested
    listed = files.select(relative_path(F.col("path"), root).alias("path"))
    at = F.filter(F.array(*[F.lit(d) for d in depths]).cast("array<int>"), lambda d: d <= F.col("deep"))
    deep = listed.withColumn("deep", folder_depth(F.col("path")))
    placed = deep.select("path", F.explode(at).alias("depth")).select("path", folder_at("path", "depth").alias("folder"))
    hits = placed.join(rules, "folder").where(
        F.col("pattern").isNull() | F.expr("path rlike pattern")
    ).select("source", "path")
    audit = catalog.join(_presence(hits), "source", "left")
    if wanted is not None:
        audit = wanted.select("source").distinct().join(audit, "source", "left")
    known = F.col("rule").isNotNull()
    checked = F.col("rule").isin("local_glob", "cache_dir")
    found = F.coalesce("n", F.lit(0))
    return audit.select(
        "source",
        F.coalesce(F.when(checked, found > 0), F.col("rule") == "none", F.lit(False)).alias("ok"),
        F.when(~known, "unknown").when(~checked, "unchecked")
        .when(found > 0, "present").otherwise("missing").alias("status"),
        "rule",
        F.when(checked, found.cast("bigint")).alias("count"),
        F.when(checked, F.coalesce("sample", F.array().cast("array<string>"))).alias("sample"),
        F.when(~known, "unknown source")
        .when((F.col("rule") == "cache_dir") & (found == 0), "missing or empty dir").alias("reason"),
    )


def overall(audit: DataFrame) -> DataFrame:
    """One row: ``ok`` over all sources and the exit code that goes with it."""
    return audit.agg(F.coalesce(F.bool_and("ok"), F.lit(True)).alias("ok")).select(
        "ok", F.when(F.col("ok"), 0).otherwise(2).alias("exit_code")
    )


def as_json(audit: DataFrame) -> DataFrame:
    """One JSON document per source."""
    return audit.select("source", F.to_json(F.struct(*audit.columns)).alias("json"))
