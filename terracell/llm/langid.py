"""Language identification with interpolated Kneser-Ney character models."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from ..operators.quantiles import grouped_quantiles
from .common import add_columns, id_remainder, materialize, share, shared, without

ORDER = 4
BLOCK_ENTRIES = 8 << 20  # entries scored against at once; more languages take more passes
REJECT = 0.5             # scores below are rejected by ``identify(...).accepted``
HELD_OUT = 5             # rows whose id remainder is 0 of this many are never learned from

_WORD = re.compile(r"[^\W\d_]+")
_PAD, _END = "\x02", "\x03"
_WORDS_HELD = 300_000


def words(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    return _WORD.findall(text.lower()) if text else []


def word_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, word, n) over all rows; counted per task before the shuffle."""
    schema = "lang STRING, word STRING, n BIGINT"

    def run(batches):
        held: dict[str, Counter] = {}

        def rows():
            flat = [(la, w, n) for la, c in held.items() for w, n in c.items()]
            held.clear()
            cols = zip(*flat) if flat else ([], [], [])
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.string(), pa.int64()), strict=True)],
                names=["lang", "word", "n"])

        for b in batches:
            for t, la in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held.setdefault(la, Counter()).update(words(t))
                if sum(map(len, held.values())) > _WORDS_HELD:
                    yield rows()
        yield rows()

    chosen = docs.select(F.col(text).alias("t"), F.col(lang).cast("string").alias("la")).where("t IS NOT NULL AND la IS NOT NULL")
    return chosen.mapInArrow(run, schema).groupBy("lang", "word").agg(F.sum("n").alias("n"))


def counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, ord, kind, slot, c, types): n-gram counts ('g') and their contexts ('h') by 64-bit hashes.

    The highest order counts occurrences; each lower order counts the different
    characters that precede an n-gram, as Kneser-Ney smoothing asks. All rows
    of ``docs`` are counted. N-grams stay within a word and its borders.
    """
    held = word_counts(docs, text, lang)
    padded = F.concat(F.lit(_PAD * (ORDER - 1)), "word", F.lit(_END))
    top = materialize(
        held.select("lang", "n", padded.alias("p"))
        .select("lang", "n", F.explode(F.transform(F.sequence(F.lit(1), F.length("p") - ORDER + 1),
                                                   lambda i: F.substring("p", i, F.lit(ORDER)))).alias("g"))
        .groupBy("lang", "g").agg(F.sum("n").alias("c")), "ngrams")
    levels = {ORDER: top}
    for k in range(ORDER - 1, 0, -1):
        levels[k] = levels[k + 1].groupBy("lang", F.substring("g", 2, k).alias("g")).agg(F.count("*").alias("c"))
    slot = F.xxhash64
    parts = []
    for k, level in levels.items():
        h = F.substring("g", 1, k - 1)
        parts.append(level.select("lang", F.lit(k).alias("ord"), F.lit("g").alias("kind"), slot(F.col("g")).alias("slot"), "c", F.lit(1).alias("t")))
        parts.append(level.select("lang", F.lit(k).alias("ord"), F.lit("h").alias("kind"), slot(h).alias("slot"), "c", F.lit(1).alias("t")))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy("lang", "ord", "kind", "slot").agg(F.sum("c").alias("c"), F.sum("t").alias("types"))


class Model:
    """Sorted hash arrays of one language; ``logs`` gives the log2 probability of n-grams."""

    def __init__(self, rows):
        self.levels = {}
        for k in range(1, ORDER + 1):
            side = {}
            for kind in ("g", "h"):
                own = rows[(rows["ord"] == k) & (rows["kind"] == kind)].sort_values("slot")
                side[kind] = (own["slot"].to_numpy("int64"), own["c"].to_numpy("float64"), own["types"].to_numpy("float64"))
            once, twice = float((side["g"][1] == 1).sum()), float((side["g"][1] == 2).sum())
            self.levels[k] = (side["g"][:2], side["h"], once / (once + 2 * twice) if once and twice else 0.5)
        self.uniform = 1.0 / (len(self.levels[1][0][0]) + 1)

    @staticmethod
    def _find(keys, values, slots):
        if not len(keys):
            return np.zeros(len(slots))
        at = np.minimum(np.searchsorted(keys, slots), len(keys) - 1)
        return np.where(keys[at] == slots, values[at], 0.0)

    def logs(self, grams, contexts):
        """``grams[k]``, ``contexts[k]``: slots of the last k characters and of those less the last one."""
        p = np.full(len(grams[1]), self.uniform)
        for k in range(1, ORDER + 1):
            (gk, gc), (hk, hc, ht), cut = self.levels[k]
            c, total, types = self._find(gk, gc, grams[k]), self._find(hk, hc, contexts[k]), self._find(hk, ht, contexts[k])
            seen = np.maximum(total, 1.0)
            p = np.where(total > 0, (np.maximum(c - cut, 0) + cut * types * p) / seen, p)
        return np.log2(np.maximum(p, 1e-12))


def _slot(text: str) -> int:
    """The slot Spark's xxhash64 gives: all 64 bits, signed."""
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (h >> 63 << 64)


class _Table:
    """Rows of an array that grows by doubling, so that many small additions copy little."""

    def __init__(self, *tail: int, dtype="float64"):
        self.data, self.n = np.zeros((1024, *tail), dtype), 0

    def add(self, rows):
        end = self.n + len(rows)
        if end > len(self.data):
            grown = np.zeros((max(end, 2 * len(self.data)), *self.data.shape[1:]), self.data.dtype)
            grown[: self.n] = self.data[: self.n]
            self.data = grown
        self.data[self.n:end] = rows
        self.n = end


class Scorer:
    """Cross-entropies of texts under several models; costs of words are remembered."""

    def __init__(self, models):
        self.models = models
        self.grams: dict[str, int] = {}
        self.costs = _Table(len(models))
        self.words: dict[str, int] = {}
        self.rows = _Table(len(models))
        self.sizes = _Table(dtype="int64")

    def _learn(self, new):
        """Costs of words not met before."""
        if len(self.words) + len(new) > _WORDS_HELD:
            self.words.clear()
            self.rows.n = self.sizes.n = 0
        ids, starts = [], []
        fresh = []
        for w in new:
            starts.append(len(ids))
            p = _PAD * (ORDER - 1) + w + _END
            for i in range(len(w) + 1):
                g = p[i:i + ORDER]
                k = self.grams.get(g)
                if k is None:
                    k = self.grams[g] = len(self.grams)
                    fresh.append(g)
                ids.append(k)
        if fresh:
            slots = {k: np.array([_slot(g[-k:]) for g in fresh], dtype="int64") for k in range(1, ORDER + 1)}
            heads = {k: np.array([_slot(g[-k:-1]) for g in fresh], dtype="int64") for k in range(1, ORDER + 1)}
            self.costs.add(-np.stack([m.logs(slots, heads) for m in self.models], axis=1))
        rows = np.add.reduceat(self.costs.data[np.array(ids)], starts, axis=0)
        for w in new:
            self.words[w] = len(self.words)
        self.rows.add(rows)
        self.sizes.add(np.fromiter((len(w) + 1 for w in new), "int64", len(new)))
        if len(self.grams) > 2_000_000:
            self.grams.clear()
            self.costs.n = 0

    def batch(self, texts):
        """Per text: bits per character under each model (None without letters) and characters."""
        for t in texts:
            ws = words(t)
            if not ws:
                yield None, 0
                continue
            total, size = np.zeros(len(self.models)), 0
            for at in range(0, len(ws), 100_000):
                part = ws[at:at + 100_000]
                new = [w for w in dict.fromkeys(part) if w not in self.words]
                if new:
                    if len(self.words) + len(new) > _WORDS_HELD:
                        new = list(dict.fromkeys(part))
                    self._learn(new)
                rows = np.fromiter(map(self.words.__getitem__, part), "int64", len(part))
                total += self.rows.data[rows].sum(axis=0)
                size += int(self.sizes.data[rows].sum())
            yield total / size, size


def cross_entropies(docs: DataFrame, models: dict[str, Model], text: str, name: str) -> DataFrame:
    """``docs`` with ``name``: struct(lang, bits, second, size), the best language, its bits and the runner-up's."""
    langs = sorted(models)
    held = share(docs.sparkSession, [models[k] for k in langs])
    kind = T.StructType([T.StructField("lang", T.StringType()), T.StructField("bits", T.DoubleType()),
                         T.StructField("second", T.DoubleType()), T.StructField("size", T.LongType())])
    pa_kind = pa.struct([("lang", pa.string()), ("bits", pa.float64()), ("second", pa.float64()), ("size", pa.int64())])

    def start():
        scorer = Scorer(shared(held))

        def work(texts):
            out = []
            for bits, size in scorer.batch(texts.to_pylist()):
                if bits is None:
                    out.append(None)
                    continue
                order = np.argsort(bits, kind="stable")
                second = float(bits[order[1]]) if len(order) > 1 else None
                out.append({"lang": langs[order[0]], "bits": float(bits[order[0]]), "second": second, "size": size})
            return (out,)
        return work

    return add_columns(docs, [(name, kind, pa_kind)], start, [text])


def _exact(column):
    """Sum of a column as a whole number of 2^-50: the same for any order of the rows."""
    return F.sum(F.rint(column * float(1 << 50)).cast("decimal(20,0)"))


def _chance(weights, x):
    """Logistic function of a linear form in the columns of ``x``."""
    z = F.lit(float(weights[0]))
    for w, c in zip(weights[1:], x, strict=True):
        z = z + float(w) * c
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))


def _fit(rows: DataFrame, x: list[str], y: str, steps=50, ridge=1e-3):
    """Logistic regression by Newton steps, each one aggregate over all ``rows``.

    A wrong row of zeros is added, so the fit stays finite when all are right.
    """
    one = [F.lit(1.0), *map(F.col, x)]
    n = len(one)
    pairs = [(i, j) for i in range(n) for j in range(i, n)]
    w = np.zeros(n)
    for _ in range(steps):
        p = F.col("_p")
        sums = rows.withColumn("_p", _chance(w, one[1:])).agg(
            *[_exact((F.col(y) - p) * c) for c in one], *[_exact(one[i] * one[j] * (p * (1 - p) + 1e-9)) for i, j in pairs]).first()
        sums = [float(v or 0) / (1 << 50) for v in sums]
        added = 1 / (1 + np.exp(-np.clip(w[0], -30, 30)))
        grad, hess = np.array(sums[:n]) - ridge * w, ridge * np.eye(n)
        grad[0] -= added
        hess[0, 0] += added * (1 - added) + 1e-9
        for (i, j), v in zip(pairs, sums[n:], strict=True):
            hess[i, j] += v
            hess[j, i] = hess[i, j]
        move = np.linalg.solve(hess, grad)
        w += move
        if np.abs(move).max() < 1e-8:
            break
    return [float(v) for v in w]


def _usual(rows: DataFrame) -> dict[str, float]:
    """Per language the bits per character up to which a text is usual: the median and eight deviations."""
    rows = rows.where("_size >= 20")
    middle = {r["lang"]: r["middle"] for r in grouped_quantiles(rows, ["lang"], "_bits", {"middle": 0.5}).collect()}
    fine = F.rint(F.col("_bits") * float(1 << 36)).cast("decimal(14,0)")
    found = {}
    for lang, n, total, squares in rows.groupBy("lang").agg(F.count("*"), F.sum(fine), F.sum(fine * fine)).collect():
        spread = (n * int(squares) - int(total) ** 2) ** 0.5 / n / (1 << 36)
        found[lang] = middle[lang] + 8 * max(spread, 0.05)
    return found


def _blocks(sizes: dict[str, int]):
    """Languages in groups of at most BLOCK_ENTRIES entries (or one language)."""
    block, total = [], 0
    for lang in sorted(sizes):
        if block and total + sizes[lang] > BLOCK_ENTRIES:
            yield block
            block, total = [], 0
        block.append(lang)
        total += sizes[lang]
    if block:
        yield block


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred``, ``score``, ``bits_per_char`` and ``accepted``.

    One character model per value of ``lang``, learned from every row with a
    text, a language and an id remainder other than 0 of HELD_OUT (a null id
    counts as remainder 0, so such rows are held out). The prediction is the
    language of lowest cross-entropy per character, ties to the first by name.
    ``score`` is the chance that it is right, from a logistic fit of the lead over the runner-up and the
    text's length on all learned rows, times the chance
    of so high a cross-entropy among learned rows of that language. Below
    REJECT a row is not accepted. Texts that are null or without letters are
    ``und`` with score 0 and not accepted, as is everything when nothing can be learned.

    The fit needs the scores of the learned rows before any row has its final
    one. With ``keep``, the columns of ``docs`` to return, all rows are scored
    once and stored with those columns; without it texts would have to be
    stored again, so the learned rows are scored twice instead.
    """
    added = ["held_out", "lang_pred", "score", "bits_per_char", "accepted"]
    rest = without(docs, added).withColumn("held_out", id_remainder(F.col(key), HELD_OUT) == 0)
    learned = rest.where(~F.col("held_out") & F.col(lang).isNotNull())
    arrays = materialize(counts(learned, text, lang), "language-models")
    sizes = {r[0]: r[1] for r in arrays.groupBy("lang").count().collect()}
    blocks = list(_blocks(sizes))
    kept = rest.columns if keep is None else [*without(rest.select(*keep), added).columns, "held_out"]
    if not blocks:
        return rest.select(*kept).withColumns({
            "lang_pred": F.lit("und"), "score": F.lit(0.0), "bits_per_char": F.lit(None).cast("double"), "accepted": F.lit(False)})

    def scored(rows):
        names = []
        for i, block in enumerate(blocks):
            own = arrays.where(F.col("lang").isin(block)).toArrow().to_pandas()
            rows = cross_entropies(rows, {k: Model(own[own["lang"] == k]) for k in block}, text, f"_best{i}")
            names.append(f"_best{i}")
            if len(blocks) > 1:
                rows = materialize(rows, "scored")
        best = F.array_min(F.array(*[F.struct(F.col(f"{n}.bits").alias("bits"), F.col(f"{n}.lang").alias("lang")) for n in names]))
        marks = F.array_sort(F.filter(F.array(*[x for n in names for x in (F.col(f"{n}.bits"), F.col(f"{n}.second"))]), lambda b: b.isNotNull()))
        return rows.withColumns({"_lang": best["lang"], "_bits": best["bits"], "_second": F.get(marks, F.lit(1)),
                                 "_size": F.col(f"{names[0]}.size")}).drop(*names)

    own = F.col(lang).cast("string").alias("_own")
    marks = ["_lang", "_bits", "_second", "_size"]
    if keep is None:
        every = None
        fitted = materialize(scored(learned.select(text, own)).select("_own", *marks), "calibration")
    else:
        every = materialize(scored(rest.select(text, own, *without(rest.select(*kept), [text]).columns)).select(*kept, "_own", *marks), "scores")
        fitted = every.where(~F.col("held_out") & F.col("_own").isNotNull())
    spread = F.least(F.coalesce(F.col("_second") - F.col("_bits"), F.lit(4.0)), F.lit(4.0))
    sure = F.log1p(spread * F.col("_size"))
    fitted = fitted.where("_lang IS NOT NULL").select(
        F.col("_own").alias("lang"), "_bits", "_size", sure.alias("sure"), spread.alias("lead"), (F.col("_lang") == F.col("_own")).cast("double").alias("right"))
    weights, limits = [5.0, 0.0, 0.0], {}
    if not fitted.isEmpty():
        weights, limits = _fit(fitted, ["sure", "lead"], "right"), _usual(fitted)
    table = F.create_map(*[F.lit(v) for pair in sorted(limits.items()) for v in pair]) if limits else None
    most = F.coalesce(F.element_at(table, F.col("_lang")), F.lit(1e9)) if limits else F.lit(1e9)
    right = 1 / (1 + F.exp(-(F.lit(weights[0]) + weights[1] * sure + weights[2] * spread)))
    # short texts scatter more, so the limit on bits per character widens with one over the root of the length
    usual = 1 / (1 + F.exp(F.greatest(F.lit(-30.0), F.least(F.lit(30.0), 4 * (F.col("_bits") - most - 8 / F.sqrt(F.col("_size").cast("double")))))))
    score = F.coalesce(right * usual, F.lit(0.0))
    return (scored(rest) if every is None else every.drop("_own")).withColumns({
        "lang_pred": F.coalesce("_lang", F.lit("und")), "score": score, "bits_per_char": F.col("_bits"),
        "accepted": F.col("_lang").isNotNull() & (score >= REJECT),
    }).drop(*marks)
