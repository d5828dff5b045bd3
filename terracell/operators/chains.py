"""Positions along linked chains and rings of any length."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize


def rank_chains(links: DataFrame, key: str) -> DataFrame:
    """(key, id, ring, pos) of the elements of ``links`` (key, id, nxt): their chain and their place in it.

    List ranking by contraction. In a round an element leaves if its random
    number beats those of both neighbours; about a third do, no two of them adjacent.
    It tells its neighbours about each other and is stored with its
    distance from the one before it. What is left of a chain, in the end a single
    element, is its origin. Then the rounds are undone: the elements that left last are placed
    first, each beside a neighbour that has a place. So tables shrink by a third
    per round and are small where rounds are many, and every join is on ids that occur once.

    A closed chain is named by its smallest id and counted from it; an open one
    is counted from its first element.
    """
    c = F.col
    before = links.where(c("nxt").isNotNull()).select(key, c("nxt").alias("id"), c("id").alias("prv"))
    active = materialize(links.join(before, [key, "id"], "left").select(
        key, "id", "prv", "nxt", F.lit(1).cast("long").alias("dp"), F.lit(1).cast("long").alias("dn")), "chain")
    left, origins, k = [], [], 0
    while True:
        single = c("nxt").eqNullSafe(c("prv")) & (c("nxt").isNull() | (c("nxt") == c("id")))
        origins.append(active.where(single).select(key, "id", c("id").alias("origin"), F.lit(0).cast("long").alias("pos"), c("nxt").isNotNull().alias("closed")))
        active = active.where(~single)
        if active.isEmpty():
            break
        luck = lambda col: F.xxhash64(col, F.lit(k))
        leaves = c("prv").isNotNull() & (luck(c("id")) > luck(c("prv"))) & (c("nxt").isNull() | (luck(c("id")) > luck(c("nxt"))))
        gone, stay = active.where(leaves), active.where(~leaves)
        none = F.lit(None).cast("long")
        to_prv = gone.select(key, c("prv").alias("id"), none.alias("prv"), "nxt", none.alias("dp"), (c("dp") + c("dn")).alias("dn"),
                             F.lit("nxt").alias("news"))
        to_nxt = gone.where(c("nxt").isNotNull()).select(key, c("nxt").alias("id"), "prv", none.alias("nxt"), (c("dp") + c("dn")).alias("dp"),
                                                         none.alias("dn"), F.lit("prv").alias("news"))
        told = stay.withColumn("news", F.lit("own")).unionByName(to_prv).unionByName(to_nxt)
        own = lambda name: F.max(F.when(c("news") == "own", c(name)))
        heard = lambda news, name: F.max(F.when(c("news") == news, c(name)))
        any_news = lambda news: F.bool_or(c("news") == news)
        side = lambda news, name: F.when(any_news(news), heard(news, name)).otherwise(own(name)).alias(name)
        left.append(materialize(gone.select(key, "id", "prv", "dp"), "left"))
        active = materialize(told.groupBy(key, "id").agg(side("prv", "prv"), side("nxt", "nxt"), side("prv", "dp"), side("nxt", "dn")), "chain")
        k += 1
    placed = origins[0]
    for o in origins[1:]:
        placed = placed.unionByName(o)
    placed = materialize(placed, "placed")
    for gone in reversed(left):
        beside = placed.select(key, c("id").alias("prv"), "origin", c("pos").alias("at"), "closed")
        back = gone.join(beside, [key, "prv"]).select(key, "id", "origin", (c("at") + c("dp")).alias("pos"), "closed")
        placed = placed.unionByName(materialize(back, "placed"))
    chains = placed.groupBy(key, "origin").agg(
        F.min("id").alias("ring"), F.when(F.first("closed"), F.min_by("pos", "id")).otherwise(0).alias("first"), F.count("*").alias("size"))
    return placed.join(chains, [key, "origin"]).select(
        key, "id", "ring", F.pmod(c("pos") - c("first"), c("size")).alias("pos"))
