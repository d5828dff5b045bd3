"""Toxicity scores from FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import add_columns, id_remainder, share, shared, without
from .wordhash import Powers, mix, text_words

BITS = 20                      # the model has at most 2^20 weights, 4 MB
STEMS = (4, 5)                 # first bytes of words that are features too
SHARD_ROWS = 8192              # labelled rows per learner; learners' weights are averaged
SHARD_BYTES = 48 << 20    # of text in a shard, about
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.2, 1.0, 1.0, 1.0
HELD_OUT, HELD = 4, 2          # rows whose id remainder of 4 is 2 are never learned from
THRESHOLD = 0.3
LABELS_BROADCAST = 2_000_000   # labels of at most this many rows (16 bytes each) are broadcast

_SIZE = 1 << BITS
_GAP = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def features(words: np.ndarray, *stems: np.ndarray) -> np.ndarray:
    """Hashed unigrams, first bytes of words, bigrams and bigrams that skip one word, with repeats."""
    parts = [words, *(mix(s * _GAP[0] + np.uint64(i + 1)) for i, s in enumerate(stems))]
    for skip, factor in ((1, _GAP[1]), (2, _GAP[2])):
        if len(words) > skip:
            parts.append(mix(words[:-skip] * _GAP[0] + words[skip:] * factor))
    return (np.concatenate(parts) >> np.uint64(64 - BITS)).astype("int32")


def text_features(column: pa.Array, powers: Powers):
    """The features of each text of a column, in order."""
    families = [text_words(column, powers, True, stem) for stem in (0, *STEMS)]
    return (features(*f) for f in zip(*families, strict=True))


def fit_shard(rows: list, labels: np.ndarray) -> np.ndarray:
    """Weights (bias last) after EPOCHS passes of FTRL-proximal with per-coordinate rates.

    ``rows`` holds the distinct features of each text. The order of rows is
    shuffled with a fixed seed.
    """
    z, n = np.zeros(_SIZE + 1), np.zeros(_SIZE + 1)
    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            at = rows[i]
            zi, ni = z[at], n[at]
            root = np.sqrt(ni)
            w = np.where(np.abs(zi) > L1, (np.sign(zi) * L1 - zi) / ((BETA + root) / ALPHA + L2), 0.0)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - labels[i]
            z[at] = zi + g - (np.sqrt(ni + g * g) - root) / ALPHA * w
            n[at] = ni + g * g
    return np.where(np.abs(z) > L1, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic"):
    """(indices, weights) of the averaged model, indices sorted; empty without labelled rows.

    All rows with a text, a label of 0 or 1 and an id remainder other than HELD
    are learned from, in shards of about SHARD_ROWS, fewer where they are longer than
    SHARD_BYTES, by a hash of the row. Of several labels of a key the highest
    counts; rows of a repeated key each count.
    """
    marks = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        F.max(label).cast("double").alias("y")).where(id_remainder(F.col("_key"), HELD_OUT) != HELD)
    count = marks.count()
    if not count:
        return np.zeros(0, "int64"), np.zeros(0)
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("_key"), F.col(text).alias("t"))
    rows = rows.join(F.broadcast(marks) if count <= LABELS_BROADCAST else marks, "_key")
    size, number = rows.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0)), F.count("*")).first()
    if not number:
        return np.zeros(0, "int64"), np.zeros(0)
    shards = max(-(-number // SHARD_ROWS), -(-size // SHARD_BYTES))
    rows = rows.select(F.pmod(F.xxhash64("_key", "t"), F.lit(shards)).alias("shard"), "t", "y")

    def fit(table: pa.Table) -> pa.Table:
        powers = Powers()
        own = [np.append(np.unique(f), np.int32(_SIZE)) for f in text_features(table["t"].combine_chunks(), powers)]
        w = fit_shard(own, table["y"].to_numpy())
        at = np.flatnonzero(w)
        return pa.table({"i": pa.array(at, pa.int32()), "w": pa.array(w[at], pa.float64())})

    learned = rows.groupBy("shard").applyInArrow(fit, "i INT, w DOUBLE")
    model = learned.groupBy("i").agg((F.sum("w") / shards).alias("w")).orderBy("i").toArrow()
    return model["i"].to_numpy().astype("int64"), model["w"].to_numpy().astype("float64")


def score(docs: DataFrame, model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from THRESHOLD on).

    The score is the logistic of the weights of the distinct features of the
    whole text; null, empty and wordless texts have none and score the bias.
    """
    dense = np.zeros(_SIZE + 1)
    dense[model[0]] = model[1]
    held = share(docs.sparkSession, dense)

    def start():
        powers, w = Powers(), shared(held)
        used = w != 0

        def work(texts):
            out = []
            for at in text_features(texts, powers):
                out.append(float(1 / (1 + np.exp(-np.clip(w[np.unique(at[used[at]])].sum() + w[_SIZE], -30, 30)))))
            return (out,)
        return work

    rest = without(docs, ["held_out", "score", "predicted"])
    return add_columns(rest, [("score", T.DoubleType(), pa.float64())], start, [text]).withColumns({
        "held_out": id_remainder(F.col(key), HELD_OUT) == HELD, "predicted": (F.col("score") >= THRESHOLD).cast("int")})
