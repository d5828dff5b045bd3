"""Mixing sources to target weights by proportionate-fair block scheduling."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import materialize, scratch_path, without
from .numbering import PARTS, number_rows

BLOCK = 32        # rows of a block
PERIOD = 1000     # slots of a period at least
ROOT = 10**6      # square roots are kept to one part in so many
CHUNK = 1 << 18   # blocks of the timetable stored at once


def source_key(source: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null"))


def target_shares(counts: dict[str, int], weights: dict | None = None) -> tuple[dict[str, int], int]:
    """Units of each source and the period: units / period is exactly the target weight, normalised to one.

    Without ``weights`` a source counts with the square root of its rows, so a
    source that dominates the input gets less and a rare one more. ``weights``
    maps sources to targets, read as the decimals they are written as; sources
    it lacks count as the smallest one given. A null source is a source of its own.
    """
    if not counts:
        return {}, 0
    if weights is None:
        raw = {k: Fraction(math.isqrt(n * ROOT * ROOT)) for k, n in counts.items()}
    else:
        given = {f"={k}": Fraction(str(w)) for k, w in weights.items()}
        least = min(given.values())
        if least <= 0:
            raise ValueError("weights must be positive")
        raw = {k: given.get(k, least) for k in counts}
    whole = math.lcm(*(w.denominator for w in raw.values()))
    units = {k: int(w * whole) for k, w in raw.items()}
    least = math.gcd(*units.values())
    times = -(-PERIOD * least // sum(units.values()))  # whole periods up to PERIOD slots
    units = {k: u // least * times for k, u in units.items()}
    if (period := sum(units.values())) >= 1 << 63:
        raise ValueError("the weights have no common period below 2^63 slots")
    return units, period


def timetable(counts: dict[str, int], units: dict[str, int], period: int, block: int) -> Iterator[tuple]:
    """(source_key, block, release, deadline, slot, start) of every block of the run, by slot.

    Block k of a source with u of Q units may run from slot floor(k Q / u) and
    must have run by slot ceil((k + 1) Q / u). One block runs per slot: the
    released one of the earliest deadline, ties to the first source by name. As
    the units fill the period, every block meets its window, which keeps each
    source that has not run out within one block of its target at all times. A
    source that has run out has no blocks any more, and slots for which no
    block is released stay empty. ``start`` counts the rows of the blocks before.
    """
    def window(s, k):
        return k * period // units[s], -(-(k + 1) * period // units[s])

    waiting = [(0, s, 0) for s in counts]
    heapq.heapify(waiting)
    ready: list[tuple] = []
    t = start = 0
    while waiting or ready:
        if not ready:
            t = max(t, waiting[0][0])
        while waiting and waiting[0][0] <= t:
            release, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (window(s, k)[1], s, k, release))
        deadline, s, k, release = heapq.heappop(ready)
        yield s, k, release, deadline, t, start
        start += min(block, counts[s] - k * block)
        t += 1
        if (k + 1) * block < counts[s]:
            heapq.heappush(waiting, (window(s, k + 1)[0], s, k + 1))


def store_timetable(spark: SparkSession, blocks: Iterator[tuple]) -> DataFrame:
    """The timetable as a stored table. The driver holds CHUNK blocks at a time."""
    path = scratch_path(spark, "timetable")
    schema = pa.schema([("source_key", pa.string()), *((n, pa.int64()) for n in ("block", "release", "deadline", "slot", "start"))])
    more = True
    while more:
        part = [row for _, row in zip(range(CHUNK), blocks)]
        more = len(part) == CHUNK
        columns = [pa.array(c, f.type) for c, f in zip(zip(*part) if part else [[]] * len(schema), schema)]
        held = spark.createDataFrame(pa.Table.from_arrays(columns, schema=schema))
        held.write.mode("append").parquet(path)
    return spark.read.schema(held.schema).parquet(path)


def mix(docs: DataFrame, weights: dict | None = None, source: str = "source", key: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """(key, source, units, period, block, release, deadline, slot, position) of every row.

    Rows of a source go by the MD5 of their key into blocks of ``block`` rows;
    null keys come first. A source that has run out leaves its slots empty, so
    the rest keep their proportions. ``position`` is the row's place in the
    mixture, from 0. No row is dropped or repeated. The driver holds the
    sources with their rows and times the blocks.
    """
    spark = docs.sparkSession
    mixed = F.coalesce(F.md5(F.col(key).cast("string")), F.lit(""))
    rows = materialize(
        docs.select(
            F.col(key).alias("_key"), F.col(source).alias("_source"), source_key(source).alias("source_key"), mixed.alias("_md5"),
            F.when(F.col(key).isNull(), F.format_string("!%02d", F.pmod(F.spark_partition_id(), F.lit(PARTS))))
            .otherwise(F.substring(mixed, 1, 2)).alias("_cell")),
        "mix-rows",
    )
    counts = {r["source_key"]: r["n"] for r in rows.groupBy("source_key").agg(F.count("*").alias("n")).collect()}
    units, period = target_shares(counts, weights)
    table = store_timetable(spark, timetable(counts, units, period, block))
    shares = spark.createDataFrame(list(units.items()), "source_key STRING, units LONG").withColumn("period", F.lit(period).cast("long"))
    numbered = number_rows(rows, "source_key", "_cell", ["_md5", "_key"], "_n").withColumns({
        "block": F.floor(F.col("_n") / block), "_in": F.col("_n") % block})
    return numbered.join(table.join(F.broadcast(shares), "source_key"), ["source_key", "block"]).select(
        F.col("_key").alias(key), F.col("_source").alias(source), "units", "period", "block", "release", "deadline", "slot",
        (F.col("start") + F.col("_in")).cast("long").alias("position"))


def in_order(docs: DataFrame, mixed: DataFrame, key: str = "doc_id", position: str | None = None) -> DataFrame:
    """``docs`` in the order of the mixture: ranges of positions to files, sorted within.

    Rows with a null key, or a key that ``mixed`` lacks, come first. Of rows
    that repeat a key, all take the first position of that key. With
    ``position`` that place stays as a column of this name, null for the rows
    that come first.
    """
    at = mixed.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min("position").alias("_position"))
    rest = without(docs, ["_position", "_key", *([position] if position else [])])
    placed = rest.join(at, rest[key] == at["_key"], "left").drop("_key").repartitionByRange("_position").sortWithinPartitions("_position")
    return placed.withColumnRenamed("_position", position) if position else placed.drop("_position")
