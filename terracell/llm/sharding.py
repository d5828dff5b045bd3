"""Sharding over fixed virtual slots and a versioned slot-to-shard map."""

from __future__ import annotations

import heapq

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import materialize, without
from .numbering import PARTS, number_rows

SLOTS = 4096       # fixed for the life of a data set
RANGE = 4096       # positions whose rows are numbered together
SLACK = 0.001      # shards may differ by this share of the mean before slots move


def with_slot(docs: DataFrame, key: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """``docs`` with ``size`` (UTF-8 bytes plus 1; null text: 1), ``text_crc32`` and ``virtual_slot``.

    The slot is a hash of the key alone and never changes. A null key has the
    slot of the hash of nothing. The checksum of a null text is that of an
    empty one.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    return without(docs, ["size", "text_crc32", "virtual_slot"]).withColumns({
        "size": (F.octet_length(body) + 1).cast("long"),
        "text_crc32": F.crc32(body),
        "virtual_slot": F.pmod(F.xxhash64(key), F.lit(slots)).cast("int"),
    })


def slot_bytes(sized: DataFrame) -> dict[int, int]:
    """Bytes per slot; at most as many entries as slots."""
    return {r[0]: r[1] for r in sized.groupBy("virtual_slot").agg(F.sum("size")).collect()}


def rebalance(old: dict[int, int], weight: dict[int, int], shards: int, slots: int = SLOTS) -> dict[int, int]:
    """A new slot-to-shard map from ``old`` that moves slots only where the balance asks for it.

    Slots without a shard, or whose shard is gone, are placed first: heaviest
    first, onto the lightest shard. Then slots go from the heaviest to the
    lightest shard, each the largest that narrows their gap, until the gap is
    within SLACK of the mean or no slot narrows it.
    """
    held: list[set[int]] = [set() for _ in range(shards)]
    load = [0] * shards
    free = []
    for s in range(slots):
        if old.get(s, shards) < shards:
            held[old[s]].add(s)
            load[old[s]] += weight.get(s, 0)
        else:
            free.append(s)
    heap = [(load[k], len(held[k]), k) for k in range(shards)]
    heapq.heapify(heap)
    for s in sorted(free, key=lambda s: (-weight.get(s, 0), s)):
        _, _, k = heapq.heappop(heap)
        held[k].add(s)
        load[k] += weight.get(s, 0)
        heapq.heappush(heap, (load[k], len(held[k]), k))
    mean = sum(load) / shards
    while True:
        top, low = max(range(shards), key=lambda k: (load[k], -k)), min(range(shards), key=lambda k: (load[k], k))
        gap = load[top] - load[low]
        fit = [(weight.get(s, 0), -s) for s in held[top] if 0 < weight.get(s, 0) < gap]
        if gap <= SLACK * mean or not fit:
            break
        half = [x for x in fit if 2 * x[0] <= gap]
        size, s = max(half) if half else min(fit)
        held[top].remove(-s)
        held[low].add(-s)
        load[top] -= size
        load[low] += size
    return {s: k for k, own in enumerate(held) for s in own}


def write_map(spark: SparkSession, path: str, version: int, shards: int, assigned: dict[int, int], weight: dict[int, int]) -> None:
    """Store one version of the map; a version is never replaced."""
    rows = [(s, k, int(weight.get(s, 0)), shards) for s, k in sorted(assigned.items())]
    spark.createDataFrame(rows, "virtual_slot INT, shard INT, bytes LONG, shards INT").coalesce(1).write.parquet(
        f"{path}/version={version}")


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    """One version of the map, at most as many rows as slots."""
    return spark.read.parquet(f"{path}/version={version}").withColumn("map_version", F.lit(version))


def latest_version(spark: SparkSession, path: str) -> int | None:
    """The number of the last map below ``path``, or None where there is none."""
    try:
        return spark.read.parquet(path).agg(F.max("version")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def next_version(spark: SparkSession, path: str, version: int, sized: DataFrame, shards: int, slots: int = SLOTS) -> int:
    """Edit map ``version`` for the bytes of ``sized`` and ``shards`` shards.

    Returns the new version, or ``version`` where no slot has to move.
    """
    held = read_map(spark, path, version).collect()
    old = {r["virtual_slot"]: r["shard"] for r in held}
    weight = slot_bytes(sized)
    new = rebalance(old, weight, shards, slots)
    if new == old and all(r["shards"] == shards for r in held):
        return version
    write_map(spark, path, version + 1, shards, new, weight)
    return version + 1


def shard(
    docs: DataFrame, path: str, shards: int = 16, key: str = "doc_id", text: str = "text", slots: int = SLOTS, position: str | None = None,
) -> DataFrame:
    """Rows (key, size, text_crc32, virtual_slot, map_version, law, shard, slot, grown_shard) for every row of ``docs``.

    The law is ``bytes``: the map stored below ``path`` spreads the slots so
    that shards have nearly equal bytes. Where there is a map already, its last
    version is edited for these rows: only slots move that the balance asks for, and
    a version is added if any does. ``slot`` numbers
    the rows of a shard from 0, in the order of the column ``position`` if one
    is named, rows without a position first. Rows with equal keys share a
    virtual slot and a shard; an empty table gives no rows.
    """
    spark = docs.sparkSession
    place = F.col(position).cast("long") if position else F.lit(None).cast("long")
    thin = materialize(
        with_slot(docs.withColumn("_place", place), key, text, slots).select(
            key, "size", "text_crc32", "virtual_slot", "_place", F.pmod(F.spark_partition_id(), F.lit(PARTS)).alias("_part")),
        "sized",
    )
    version = latest_version(spark, path)
    if version is None:
        version, weight = 0, slot_bytes(thin)
        write_map(spark, path, version, shards, rebalance({}, weight, shards, slots), weight)
    else:
        version = next_version(spark, path, version, thin, shards, slots)
    held = read_map(spark, path, version).select("virtual_slot", "shard", "map_version")  # SLOTS rows
    if position:
        cell = F.coalesce(F.floor(F.col("_place") / RANGE), F.col("_part") - PARTS)
    else:
        cell = F.col("virtual_slot") * PARTS + F.col("_part")
    placed = thin.join(F.broadcast(held), "virtual_slot").withColumn("_cell", cell.cast("long"))
    return number_rows(placed, "shard", "_cell", ["_place", key, "text_crc32"], "slot").select(
        key, "size", "text_crc32", "virtual_slot", "map_version", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
