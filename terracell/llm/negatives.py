"""Hard negatives for contrastive training, by coordinate pruning in length buckets.

Vectors are scaled to integers, so that scores are exact. The rows are stored
in the order of their lengths; a task reads them in runs, and cuts a run into
buckets whose lengths differ by at most the factor RATIO. A bucket sorts its
rows by each coordinate of their unit vectors. For an anchor and the score it still
needs, the angle between anchor and row is bounded, so each of the anchor's
FOCUS largest coordinates leaves a range of feasible values: the ranges are
looked up in the sorted lists, the shortest is intersected with the others, and
only what is left is scored. A bucket too short for the score is passed over.

1. ``positives``: the k highest rows of the anchor's label. The score needed is
   the k-th best so far.
2. ``negatives``: for each positive the k highest rows of other labels whose
   score lies between two shares of the positive's. The highest share bounds
   the feasible values from the other side too.

Anchors go to the tasks in turns of at most TURN_BYTES; a turn reads all rows.
A task keeps k rows per anchor (or positive) of the turn, and the tasks' lists
are merged by a window with its limit pushed below the shuffle.

Rows whose id, label or vector is null, or that have a null or non-finite
component, take no part. Shorter vectors count as filled up with zeros. Scaled
components are limited to +-LIMIT. Rows equal in id, label and vector count
once; other rows of one id are anchors and candidates each, but never of rows of their
own id. Ties go to the smaller id. Other input columns are not read. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import materialize, share, shared

TURN_BYTES = 8 << 20   # anchors sent to the tasks at once
RATIO = 1.5            # longest over shortest vector of a bucket
FOCUS = 4              # coordinates of an anchor whose ranges are intersected
LIMIT = 1 << 26        # scaled components beyond are set to it
_EDGE = 1e-9           # ranges are this much wider, against rounding


def scaled(rows: DataFrame, scale: int, vec: str = "embedding", label: str = "label", key: str = "vec_id") -> DataFrame:
    """(id, label, v, length2, row): the usable rows, each component floor(scale * x)."""
    usable = F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vec).isNotNull() & ~F.exists(
        vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    level = lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int")
    kept = rows.where(usable).select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), F.transform(vec, level).alias("v"))
    kept = kept.dropDuplicates(["id", "label", "v"])
    length2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    return kept.withColumn("length2", length2).withColumn("row", F.xxhash64("id", "label", "v"))


# --- one bucket, in a task ---

class Bucket:
    """Rows of similar length with their sorted coordinate lists."""

    def __init__(self, ids, labels, keys, matrix):
        self.ids, self.labels, self.keys, self.matrix = ids, labels, keys, matrix
        self.exact = matrix.astype("float64")
        lengths = np.sqrt((self.exact ** 2).sum(1))
        self.shortest, self.longest = lengths.min(), lengths.max()
        self.unit = self.exact / np.where(lengths > 0, lengths, 1)[:, None]
        self.order = np.argsort(self.unit, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.unit, self.order, axis=0)
        self.top = np.abs(matrix).max(initial=0)

    def candidates(self, anchor: "Anchor", low: float, high: float) -> np.ndarray:
        """Rows whose score may lie from ``low`` to ``high``, by the ranges of the focus coordinates."""
        everything = np.arange(len(self.ids))
        if not self.longest or not anchor.length:
            return everything if low <= 0 <= high else everything[:0]
        # a row as short as can be needs the smallest angle, or may have the largest
        low_cos = low / (anchor.length * (self.longest if low >= 0 else max(self.shortest, 1e-300)))
        high_cos = high / (anchor.length * (self.longest if high < 0 else max(self.shortest, 1e-300)))
        if low_cos > 1 + _EDGE or high_cos < -1 - _EDGE:
            return everything[:0]
        widest, least = np.arccos(np.clip(low_cos, -1, 1)), np.arccos(np.clip(high_cos, -1, 1))
        # the angles a row may have to a coordinate axis that lies at ``at`` from the anchor
        at = anchor.angles
        near = np.maximum(np.maximum(at - widest, least - at), 0)
        far = np.minimum(np.minimum(at + widest, 2 * np.pi - least - at), np.pi)
        bottom, top = np.cos(far) - _EDGE, np.cos(near) + _EDGE
        spans = [(np.searchsorted(self.sorted[:, f], b), np.searchsorted(self.sorted[:, f], t, side="right"))
                 for f, b, t in zip(anchor.focus, bottom, top, strict=True)]
        first = min(range(len(spans)), key=lambda i: spans[i][1] - spans[i][0])
        found = self.order[spans[first][0]: spans[first][1], anchor.focus[first]]
        for i, f in enumerate(anchor.focus):
            if i != first and spans[i][1] - spans[i][0] < len(self.ids):
                x = self.unit[found, f]
                found = found[(x >= bottom[i]) & (x <= top[i])]
        return found

    def scores(self, anchor: "Anchor", rows: np.ndarray) -> np.ndarray:
        """Exact inner products with some rows."""
        if self.top * anchor.top * self.matrix.shape[1] < 1 << 53:
            picked = (self.exact @ anchor.exact)[rows] if 2 * len(rows) > len(self.ids) else self.exact[rows] @ anchor.exact
            return picked.astype("int64")
        return (self.matrix[rows].astype("int64") * anchor.vector.astype("int64")).sum(1)


class Anchor:
    def __init__(self, row, ident, label, vector):
        self.row, self.id, self.label, self.vector = row, ident, label, vector
        self.exact = vector.astype("float64")
        self.length = float(np.sqrt((self.exact ** 2).sum()))
        self.top = int(np.abs(vector).max(initial=0))
        unit = self.exact / (self.length or 1)
        self.focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        self.angles = np.arccos(np.clip(unit[self.focus], -1, 1))


class Best:
    """The highest ``k`` rows so far between two scores."""

    def __init__(self, k: int, low: float, high: float):
        self.k, self.floor, self.high = k, low, high
        self.score = np.zeros(0, "int64")
        self.id, self.row = self.score, self.score

    @property
    def low(self) -> float:
        return self.floor if len(self.score) < self.k else max(self.floor, self.score[-1])

    def add(self, score, ids, rows):
        """Take in rows that are sorted by score, highest first, ties by id and row."""
        start = np.searchsorted(-score, -self.high) if np.isfinite(self.high) else 0
        end = np.searchsorted(-score, -self.low, side="right") if np.isfinite(self.low) else len(score)
        end = min(end, start + self.k)
        if end <= start:
            return
        score, ids, rows = (np.concatenate([a, b[start:end]]) for a, b in (
            (self.score, score), (self.id, ids), (self.row, rows)))
        keep = np.lexsort((rows, ids, -score))[: self.k]
        self.score, self.id, self.row = score[keep], ids[keep], rows[keep]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of a column as rows, filled up with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype("int64")
    out = np.zeros((len(column), dim), "int32")
    out[np.arange(dim) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def _buckets(batch: pa.RecordBatch, dim: int, label_of: dict) -> Iterator[Bucket]:
    """The rows of a batch, longest first, cut where the length falls below the share RATIO allows."""
    get = lambda name: batch.column(batch.schema.get_field_index(name))
    length = np.sqrt(get("length2").to_numpy())
    order = np.argsort(-length, kind="stable")
    ids, keys, matrix = get("id").to_numpy()[order], get("row").to_numpy()[order], _matrix(get("v"), dim)[order]
    labels = np.array([label_of.setdefault(x, len(label_of)) for x in get("label").to_pylist()], "int64")[order]
    length, at = length[order], 0
    while at < len(ids):
        end = at + int(np.searchsorted(-length[at:], -length[at] / RATIO, side="right")) if length[at] else len(ids)
        yield Bucket(ids[at:end], labels[at:end], keys[at:end], matrix[at:end])
        at = end


def _search(held, dim: int, k: int, same: bool):
    """Map function over stored rows: the best rows of each aim of each anchor, per task."""
    def run(batches):
        anchors = shared(held)
        label_of: dict = {}
        todo = []
        for row, ident, label, vector, aims in anchors:
            anchor = Anchor(row, ident, label_of.setdefault(label, len(label_of)), np.asarray(vector, "int32"))
            todo.append((anchor, [(aim, Best(k, low, high)) for aim, low, high in aims]))
        for batch in batches:
            for bucket in _buckets(batch, dim, label_of):
                for anchor, aims in todo:
                    found = bucket.candidates(anchor, min(b.low for _, b in aims), max(b.high for _, b in aims))
                    match = (bucket.labels[found] == anchor.label) == same
                    found = found[match & (bucket.ids[found] != anchor.id)]
                    if not len(found):
                        continue
                    score = bucket.scores(anchor, found)
                    enough = score >= min(b.low for _, b in aims)
                    found, score = found[enough], score[enough]
                    order = np.lexsort((bucket.keys[found], bucket.ids[found], -score))
                    found, score = found[order], score[order]
                    for _, best in aims:
                        best.add(score, bucket.ids[found], bucket.keys[found])
        out = [(a.row, a.id, aim, *row) for a, aims in todo for aim, b in aims for row in zip(b.score.tolist(), b.id.tolist(), b.row.tolist(), strict=True)]
        names = ["anchor", "anchor_id", "aim", "score", "id", "row"]
        columns = list(zip(*out, strict=True)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)
    return run


def _best(stored: DataFrame, anchors: list, dim: int, k: int, same: bool) -> DataFrame:
    """(anchor, anchor_id, aim, score, id, row, rank): the ``k`` best rows of each aim over all tasks."""
    held = share(stored.sparkSession, anchors)
    found = stored.select("id", "label", "v", "length2", "row").mapInArrow(
        _search(held, dim, k, same), "anchor BIGINT, anchor_id BIGINT, aim BIGINT, score BIGINT, id BIGINT, row BIGINT")
    order = Window.partitionBy("anchor", "anchor_id", "aim").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, every: int = 100, scale: int = 256, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         vec: str = "embedding", label: str = "label", key: str = "vec_id") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of the negatives of each anchor and positive.

    Anchors are the rows whose id is divisible by ``every``, positives the
    highest rows of the same label. A negative's score is from ``low`` to
    ``high`` percent of the positive's.
    """
    spark = rows.sparkSession
    stored = materialize(scaled(rows, scale, vec, label, key).repartitionByRange(F.desc("length2"), "row").sortWithinPartitions(
        F.desc("length2"), "row"), "vectors")
    dim = stored.agg(F.max(F.size("v"))).first()[0] or 0
    targets = stored.where(F.col("id") % every == 0).select("id", "label", "v", "row")
    turns = -(-targets.count() * (4 * dim + 64) // TURN_BYTES) or 1
    targets = materialize(targets.withColumn("turn", F.pmod(F.hash("row", F.lit(7)), F.lit(turns))).repartition("turn"), "anchors")
    done = []
    for turn in range(turns):
        # at most about TURN_BYTES of anchors
        held = targets.where(F.col("turn") == turn).select("id", "label", "v", "row").toArrow().to_pylist()
        find = [(a["row"], a["id"], a["label"], np.resize(np.append(np.array(a["v"], "int32"), np.zeros(dim, "int32")), dim),
                 [(0, -np.inf, np.inf)]) for a in held]
        liked = materialize(_best(stored, find, dim, positives, True), "positives")
        aims: dict[tuple, list] = {}
        for p in liked.select("anchor", "anchor_id", "rank", "score").toArrow().to_pylist():
            least, most = -(-low * p["score"] // 100), high * p["score"] // 100
            if least <= most:
                aims.setdefault((p["anchor"], p["anchor_id"]), []).append((p["rank"], least, most))
        against = [(*a[:4], aims[a[:2]]) for a in find if a[:2] in aims]
        found = _best(stored, against, dim, negatives, False)
        who = liked.select("anchor", "anchor_id", F.col("rank").cast("long").alias("aim"), F.col("id").alias("positive_id"),
                           F.col("score").alias("positive_score"))
        done.append(materialize(found.join(who, ["anchor", "anchor_id", "aim"]).select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score")), "negatives"))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out
