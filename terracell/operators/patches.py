"""Patches: connected cells (right, left, up, down) of one class."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from ..constants import TILE
from ..session import materialize

HUB = 10_000   # links of a node up to which they may share a task
HUBS = 10_000  # nodes whose minimum is broadcast, at most

# Executors get the tile function itself, so they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _label_tile(pdf: pd.DataFrame, tile: int) -> pd.DataFrame:
    """Smallest cell id of the patch of each cell, seen within one tile."""
    r = pdf["row"].to_numpy() % tile
    c = pdf["col"].to_numpy() % tile
    kind = np.full((tile + 2, tile + 2), -1, dtype=np.int64)
    kind[r + 1, c + 1] = pd.factorize(pdf["k"])[0]
    label = np.full(kind.shape, np.iinfo(np.int64).max)
    label[r + 1, c + 1] = pdf["cell_id"].to_numpy()
    same_v = (kind[1:] == kind[:-1]) & (kind[1:] >= 0)
    same_h = (kind[:, 1:] == kind[:, :-1]) & (kind[:, 1:] >= 0)
    changed = True
    while changed:
        before = label.copy()
        # Sweep minima down, up, right and left; each sweep crosses the tile.
        for i in range(1, tile + 2):
            np.minimum(label[i], label[i - 1], out=label[i], where=same_v[i - 1])
        for i in range(tile, -1, -1):
            np.minimum(label[i], label[i + 1], out=label[i], where=same_v[i])
        for j in range(1, tile + 2):
            np.minimum(label[:, j], label[:, j - 1], out=label[:, j], where=same_h[:, j - 1])
        for j in range(tile, -1, -1):
            np.minimum(label[:, j], label[:, j + 1], out=label[:, j], where=same_h[:, j])
        changed = bool((before != label).any())
    return pdf.assign(local=label[r + 1, c + 1])


def patches(cells: DataFrame, cls: str, keys: list[str] | None = None, tile: int = TILE) -> DataFrame:
    """Cells with ``patch``, the smallest cell id of their patch.

    ``cells`` has cell_id (unique over all rasters), row, col and the class;
    ``keys`` identify a raster. Tiles are labelled one by one (a tile has at most
    tile × tile cells); only the patch pieces that touch across tile borders enter
    the merge, which runs until nothing changes.
    """
    keys = keys or []
    keyed = cells.where(F.col(cls).isNotNull()).select(
        *keys, F.col("cell_id").cast("bigint").alias("cell_id"), F.col("row").cast("bigint").alias("row"),
        F.col("col").cast("bigint").alias("col"), F.col(cls).alias("k"),
    )
    tiles = keyed.groupBy(*keys, F.floor(F.col("row") / tile).alias("tr"), F.floor(F.col("col") / tile).alias("tc"))
    labelled = T.StructType(keyed.schema.fields + [T.StructField("local", T.LongType())])
    local = materialize(tiles.applyInPandas(lambda pdf: _label_tile(pdf, tile), labelled), "tiles")
    merged = merge_labels(_border_links(local, keys, tile))
    return local.join(merged, F.col("local") == F.col("node"), "left").select(
        *keys, "cell_id", "row", "col", F.col("k").alias(cls), F.coalesce("root", "local").alias("patch")
    )


def _border_links(local: DataFrame, keys: list[str], tile: int) -> DataFrame:
    """Pairs of pieces that meet across a tile border."""
    links = []
    for step, line in (("row", "col"), ("col", "row")):
        place = F.pmod(F.col(step), F.lit(tile))
        ends = local.where(place == tile - 1).select(
            *keys, (F.col(step) + 1).alias("s"), F.col(line).alias("l"), "k", F.col("local").alias("u")
        )
        starts = local.where(place == 0).select(
            *keys, F.col(step).alias("s"), F.col(line).alias("l"), "k", F.col("local").alias("v")
        )
        links.append(ends.join(starts, [*keys, "s", "l", "k"]).select("u", "v"))
    return links[0].unionByName(links[1]).distinct()


def merge_labels(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node each node is connected to.

    Alternates the large-star and small-star steps (Kiveris et al., 2014):
    first every larger neighbour, then every smaller one, is linked to the
    smallest node around. Both are a group minimum joined back to the links;
    a hub's links stay spread over tasks.
    """
    edges = materialize(links.where("u <> v"), "links")
    state = _fingerprint(edges)
    while True:
        large = _star(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), larger=True)
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        edges = materialize(_star(down, larger=False), "links")
        before, state = state, _fingerprint(edges)
        if state == before:
            return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))


def _fingerprint(edges: DataFrame) -> tuple:
    """Order-free digest of the links, one row from the cluster per round."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum(h.cast("decimal(20,0)"))).first())


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Link the (larger | smaller) neighbours of each u to the smallest node at u.

    Minima combine map-side. Nodes with more than HUB links, or a share of them
    that leaves at most HUBS such nodes, are hubs: their minima are broadcast, so that
    their links stay where they are; only the others are shuffled to meet theirs.
    """
    low = materialize(links.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select(
        "u", F.least("u", "m").alias("m"), "n"), "low")
    total, most = low.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    many = max(HUB, total // HUBS)
    if most > many:
        hubs = low.where(F.col("n") > many).select("u", F.col("m").alias("hub"))  # fewer than HUBS
        marked = links.join(F.broadcast(hubs), "u", "left")
        joined = marked.where("hub IS NOT NULL").select("u", "v", F.col("hub").alias("m")).unionByName(
            marked.where("hub IS NULL").select("u", "v").join(low.where(F.col("n") <= many).select("u", "m"), "u"))
    else:
        joined = links.join(low.select("u", "m"), "u")
    if larger:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        own = low.select("u", F.col("m").alias("v"))
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)
    return out.where("u <> v").distinct()


def patch_sizes(labelled: DataFrame, cls: str) -> DataFrame:
    return labelled.groupBy("patch", cls).agg(F.count("*").alias("n_cells"))
