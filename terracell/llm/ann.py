"""Approximate nearest neighbours by learned partitions of a neighbour graph."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import add_columns, materialize, share, shared, without

SAMPLE = 6000        # vectors the partitions and the router are fitted on
DEGREE = 10          # neighbours per vertex of the graph
PARTS = 64           # learned partitions, at any number of rows
SPARE = 1.1          # a partition holds at most this times its fair share of the sample
HIDDEN = 64          # width of the router's hidden layer
RECALL = 0.95        # recall the number of probed partitions is set for, on held-out vectors of the sample
BLOCK = 16384        # rows and queries compared in one group


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows with an id and a vector that is not null, empty, zero, or holding null or non-finite components."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col(key).isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.exists(v, lambda x: x != 0))


def neighbour_graph(x: np.ndarray, degree: int) -> np.ndarray:
    """The ``degree`` vertices of largest inner product with each vertex."""
    near = np.empty((len(x), min(degree, len(x) - 1)), dtype="int32")
    for a in range(0, len(x), 512):
        s = x[a:a + 512] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        near[a:a + 512] = np.argpartition(-s, near.shape[1] - 1, axis=1)[:, : near.shape[1]]
    return near


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int, sweeps: int = 8) -> np.ndarray:
    """Part of each vertex: median cuts along main directions, then moves that cut fewer edges.

    A vertex moves to the part most of its neighbours are in, if that part has
    room; no part grows beyond SPARE of its share.
    """
    part = np.zeros(len(x), dtype="int64")
    count = 1
    while count < parts:
        new = part.copy()
        for p in range(count):
            own = np.flatnonzero(part == p)
            if len(own) > 1:
                centred = x[own] - x[own].mean(axis=0)
                axis = np.linalg.eigh(centred.T @ centred)[1][:, -1]
                order = own[np.argsort(centred @ axis, kind="stable")]
                new[order[len(order) // 2:]] = p + count
        part, count = new, count * 2
    room = int(np.ceil(SPARE * len(x) / parts))
    sizes = np.bincount(part, minlength=parts)
    back = [[] for _ in range(len(x))]
    for i, row in enumerate(near):
        for j in row:
            back[j].append(i)
    joined = [np.concatenate([near[i], np.array(b, dtype="int32")]) for i, b in enumerate(back)]
    order = np.random.default_rng(5)
    for _ in range(sweeps):
        moved = 0
        for i in order.permutation(len(x)):
            votes = np.bincount(part[joined[i]], minlength=parts)
            votes[sizes >= room] = 0
            best = int(votes.argmax())
            if best != part[i] and votes[best] > np.count_nonzero(part[joined[i]] == part[i]):
                sizes[part[i]] -= 1
                sizes[best] += 1
                part[i] = best
                moved += 1
        if moved < len(x) // 200:
            break
    return part


class Router:
    """One hidden layer; ``probabilities`` of the parts that a vector and its neighbours are in."""

    def __init__(self, x: np.ndarray, target: np.ndarray, epochs: int = 25):
        parts = target.shape[1]
        r = np.random.default_rng(3)
        d = x.shape[1]
        self.scale = 1.0 / max(1e-12, float(np.sqrt((x * x).sum(axis=1).mean())))
        w = [r.normal(0, d ** -0.5, (d, HIDDEN)), np.zeros(HIDDEN), r.normal(0, HIDDEN ** -0.5, (HIDDEN, parts)), np.zeros(parts)]
        first, second = [np.zeros_like(v) for v in w], [np.zeros_like(v) for v in w]
        step, self.w = 0, w
        for _ in range(epochs):
            for a in np.array_split(r.permutation(len(x)), max(1, len(x) // 256)):
                v = x[a] * self.scale * np.sqrt(d)
                h = np.maximum(v @ w[0] + w[1], 0)
                p = (self._softmax(h @ w[2] + w[3]) - target[a]) / len(a)
                g = (p @ w[2].T) * (h > 0)
                step += 1
                for k, grad in enumerate((v.T @ g, g.sum(0), h.T @ p, p.sum(0))):
                    first[k] = 0.9 * first[k] + 0.1 * grad
                    second[k] = 0.999 * second[k] + 0.001 * grad * grad
                    w[k] -= 3e-3 * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)

    @staticmethod
    def _softmax(s):
        s = np.exp(s - s.max(axis=1, keepdims=True))
        return s / s.sum(axis=1, keepdims=True)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        v = x * self.scale * np.sqrt(x.shape[1])
        return self._softmax(np.maximum(v @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3])


def targets(part: np.ndarray, near: np.ndarray, parts: int) -> np.ndarray:
    """Shares of the parts among each vertex (a third) and its neighbours."""
    out = np.zeros((len(part), parts))
    for column in near.T:
        out[np.arange(len(part)), part[column]] += 2 / 3 / near.shape[1]
    out[np.arange(len(part)), part] += 1 / 3
    return out


def probes(p: np.ndarray, mass: float) -> np.ndarray:
    """Which parts each row probes: the most probable ones until their probabilities reach ``mass``."""
    order = np.argsort(-p, axis=1, kind="stable")
    before = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1) - np.take_along_axis(p, order, axis=1)
    out = np.zeros(p.shape, dtype=bool)
    np.put_along_axis(out, order, before < mass, axis=1)
    return out


def fit(x: np.ndarray, parts: int, k: int):
    """(router, mass) for a sample: partitions, classifier, and the probability mass that gives RECALL.

    Four fifths of the sample teach the router; recall is measured with the
    other vectors as queries against the whole sample.
    """
    if parts < 2 or len(x) < 4 * parts:
        return None, 1.0
    near = neighbour_graph(x, max(k, DEGREE))
    part = balanced_parts(x, near[:, :DEGREE], parts)
    shares = targets(part, near, parts)
    order = np.random.default_rng(11).permutation(len(x))
    teach, ask = order[: len(x) * 4 // 5], order[len(x) * 4 // 5:]
    router = Router(x[teach], shares[teach])
    home, p = router.probabilities(x).argmax(axis=1), router.probabilities(x[ask])
    for mass in [*np.arange(0.3, 0.98, 0.02), 0.98, 0.985, 0.99, 0.995]:
        if np.take_along_axis(probes(p, mass), home[near[ask, :k]], axis=1).mean() >= RECALL:
            return router, float(mass)
    return router, 1.0


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("float64")
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def search(
    vectors: DataFrame, k: int = 20, every: int = 20, key: str = "vec_id", vector: str = "embedding", sample: int = SAMPLE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row whose id is divisible by ``every``.

    Nearness is the inner product in double precision, ties to the smaller id;
    rows with the query's own id are no candidates. The index is fitted on at
    most ``sample`` vectors (those of smallest hashed id) and holds every usable
    row, each in its most probable partition. A query goes to its most probable
    partitions until their probabilities reach the mass that gave RECALL on the
    sample; one that finds fewer than ``k`` rows there goes to all the others too,
    so a list is short only if the table has no more candidates. Partitions
    and queries are compared in blocks of about BLOCK, so no task holds more,
    whatever the size of a partition. Vectors must have one length. Rows equal
    in id and vector count once; other rows of one id are candidates each, and
    queries each with a list of their own.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).dropDuplicates()
    taken = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").toArrow()["v"].combine_chunks()
    parts = PARTS
    router, mass = fit(_matrix(taken), parts, k)
    held = share(spark, router)

    def start():
        model = shared(held)

        def work(ids, vs):
            x = _matrix(vs)
            if model is None:
                return [0] * len(ids), [[0] if i % every == 0 else [] for i in ids.to_pylist()]
            p = model.probabilities(x) if len(x) else np.zeros((0, parts))
            ask = probes(p, mass)
            return p.argmax(axis=1).tolist(), [np.flatnonzero(a).tolist() if i % every == 0 else [] for i, a in zip(ids.to_pylist(), ask, strict=True)]
        return work

    routed = add_columns(rows, [("part", T.IntegerType(), pa.int32()), ("ask", T.ArrayType(T.IntegerType()), pa.list_(pa.int32()))], start, ["id", "v"])
    routed = materialize(routed.withColumn("seq", F.monotonically_increasing_id()), "vectors")
    sizes = routed.groupBy("part").agg(F.count("*").alias("n")).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).drop("n")
    asked = routed.where(F.col("id") % every == 0).select(F.col("id").alias("qid"), F.col("v").alias("q"), "seq", "ask")
    sides = F.broadcast(sizes)  # one row per partition, PARTS rows

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            ids, x = right["id"].to_numpy(), _matrix(right["v"].combine_chunks())
            qid, qseq, q = left["qid"].to_numpy(), left["qseq"].to_numpy(), _matrix(left["q"].combine_chunks())
            for a in range(0, len(q), 256):
                s = q[a:a + 256] @ x.T
                s[qid[a:a + 256, None] == ids[None, :]] = -np.inf
                far = min(k, s.shape[1]) - 1
                limit = -np.partition(-s, far, axis=1)[:, far]
                for i in range(len(s)):
                    at = np.flatnonzero((s[i] >= limit[i] - 1e-9 * (1 + abs(limit[i]))) & (s[i] > -np.inf))
                    exact = (q[a + i] * x[at]).sum(axis=1)
                    best = np.lexsort((ids[at], -exact))[:k]
                    out.append((np.full(len(best), qseq[a + i]), np.full(len(best), qid[a + i]), ids[at][best], exact[best]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [*[np.zeros(0, "int64")] * 3, np.zeros(0)]
        names, kinds = ["qseq", "query_id", "vec_id", "score"], [pa.int64()] * 3 + [pa.float64()]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, cols, kinds, strict=True)})

    def ranked(found):
        rank = F.row_number().over(Window.partitionBy("qseq").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k).select("qseq", "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

    def compared(asked):
        turns = max(1, -(-asked.count() // BLOCK))
        stored = routed.join(sides, "part").select(
            "part", F.pmod("seq", "blocks").cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(turns - 1))).alias("turn"), "id", "v")
        posed = asked.select(F.col("seq").alias("qseq"), "qid", "q", F.pmod("seq", F.lit(turns)).cast("int").alias("q_turn"), F.explode("ask").alias("part")).join(sides, "part").select(
            F.col("part").alias("q_part"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("q_block"), "q_turn", "qseq", "qid", "q")
        return posed.groupBy("q_part", "q_block", "q_turn").cogroup(stored.groupBy("part", "block", "turn")).applyInArrow(
            compare, "qseq BIGINT, query_id BIGINT, vec_id BIGINT, score DOUBLE")

    near = materialize(ranked(compared(asked)), "near")
    # queries whose partitions held too few rows go to all the others that hold any
    full = near.where(F.col("rank") == k).select("qseq")
    others = F.array_except(F.lit([r["part"] for r in sizes.select("part").collect()]).cast("array<int>"), "ask")
    short = asked.join(full, asked["seq"] == full["qseq"], "left_anti").withColumn("ask", others).where(F.size("ask") > 0)
    if short.isEmpty():
        return near.drop("qseq")
    return ranked(near.drop("rank").unionAll(compared(materialize(short, "short")))).drop("qseq")
