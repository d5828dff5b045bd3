"""How the word use of each source of a language differs from its other sources, by a frequent-pattern tree.

In a language the terms found in at least MIN_DOCS of its documents are kept,
V of them. A source gives a kept term with n occurrences there
p(n) = 1 + floor(UNIT * (n + 1) / (N + V)), N all its occurrences of kept terms.
The divergence of a source from another one is the sum over all kept terms of
d(p, q) = floor((p - q)^2 / q), p and q their values. Everything is exact.

Most terms do not occur in most sources, so the sum is taken as a base, all V terms with
p(0) and q(0), and corrections:

* a term with n > 0 here: d(p(n), q(0)) - d(p(0), q(0)); likewise n > 0 there;
* a term with n > 0 here and m > 0 there:
  d(p(n), q(m)) - d(p(n), q(0)) - d(p(0), q(m)) + d(p(0), q(0)).

The first kind needs only how many terms a source has with each n. The second
comes from the tree. A term is a row, its nonzero (source, n) ordered by source; equal rows
are one with a multiplicity. Rows are sorted by their items and range-partitioned,
so a task inserts them depth first: it holds a single path of its tree, and a node
that the next row does not share is complete. Its multiplicity then goes to
each of its ancestors, once per pair of node and ancestor, however many
terms lie below. Trees of different tasks share nothing, and their sums add up.

Null text, lang and source are ''. Languages without kept terms keep their
sources with value 0. Repeated rows count as documents each. Other input columns
are not read, so their names cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import materialize, utf8

MIN_DOCS = 3
UNIT = 1_000_000_000
TOP = 200
HELD = 400_000        # entries a task adds up before it passes them on

# letters lower-cased, bytes of other characters as they are, all else a space
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of every term, counted in the tasks before the shuffle."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    names = ["lang", "source", "term", "n", "docs"]
    one = 1 << 40  # occurrences below, documents above

    def flush(held):
        for (lang, source), found in held.items():
            values = list(found.values())
            term = pa.array(list(found), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([
                pa.repeat(pa.scalar(lang, pa.string()), len(term)), pa.repeat(pa.scalar(source, pa.string()), len(term)), term,
                pa.array([v % one for v in values], pa.int64()), pa.array([v >> 40 for v in values], pa.int64())], names=names)

    def run(batches):
        held, entries = {}, 0
        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(langs), 256):
                for i, text in enumerate(utf8(batch.column(2).slice(at, 256)), at):
                    found = held.setdefault((langs[i], sources[i]), {})
                    get, before = found.get, len(found)
                    for term, k in Counter(text.translate(_TERM).split()).items():
                        found[term] = get(term, 0) + one + k
                    entries += len(found) - before
                if entries > HELD:
                    yield from flush(held)
                    held, entries = {}, 0
        yield from flush(held)

    parts = rows.mapInArrow(run, "lang STRING, source STRING, term STRING, n BIGINT, docs BIGINT")
    # dealt by term alone, so that the rows of a term are together for the next step too; there are a few per task and source
    return parts.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, items): the kept terms, each with its (source, n) in the order of the sources."""
    rows = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("items"))
    return rows.where(F.col("docs") >= min_docs).select("lang", "term", "items")


def pair_counts(kept: DataFrame) -> DataFrame:
    """(lang, a, n, b, m, terms): how many terms occur n > 0 times in source a and m > 0 times in source b, a before b."""
    merged = kept.where(F.size("items") > 1).groupBy("lang", "items").agg(F.count("*").alias("terms"))
    ordered = merged.repartitionByRange("lang", "items").sortWithinPartitions("lang", "items")
    names = ["lang", "a", "n", "b", "m", "terms"]

    def run(batches):
        totals: Counter = Counter()
        path: list[list] = []   # the open path of the tree: [item, multiplicity of the finished rows below]
        lang = None

        def close(depth):
            while len(path) > depth:
                (source, n), terms = path.pop()
                for (other, m), _ in path:
                    totals[lang, other, m, source, n] += terms
                if path:
                    path[-1][1] += terms

        def flush():
            columns = list(zip(*((*k, v) for k, v in totals.items()), strict=True)) or [[]] * 6
            kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            langs, terms = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for i, row in enumerate(batch.column(1).to_pylist()):
                if langs[i] != lang:
                    close(0)
                    lang = langs[i]
                items = [(x["source"], x["n"]) for x in row]
                shared = 0
                while shared < min(len(path), len(items)) and path[shared][0] == items[shared]:
                    shared += 1
                close(shared)
                path.extend([item, 0] for item in items[shared:])
                path[-1][1] += terms[i]
                if len(totals) > HELD:
                    yield flush()
                    totals.clear()
        close(0)
        yield flush()

    parts = ordered.mapInArrow(run, "lang STRING, a STRING, n BIGINT, b STRING, m BIGINT, terms BIGINT")
    return parts.groupBy("lang", "a", "n", "b", "m").agg(F.sum("terms").alias("terms"))


def price(n: str, total: str, size: str):
    """p of a term with ``n`` occurrences; in decimals where a long is too short."""
    whole = f"greatest({total} + {size}, 1L)"
    return F.expr(f"""1 + CASE WHEN {n} < 9000000000L THEN ({UNIT}L * ({n} + 1L)) div {whole}
        ELSE (CAST({UNIT} AS DECIMAL(10, 0)) * (CAST({n} AS DECIMAL(20, 0)) + 1)) div {whole} END""")


def gap(p: str, q: str):
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def _exact_sum(column):
    return F.sum(column.cast("decimal(38,0)"))


def divergences(groups: DataFrame, used: DataFrame, pairs: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every pair of sources of a language.

    ``groups`` has lang, source, total and size (N and V), ``used`` has
    lang, source, n and terms, ``pairs`` the result of ``pair_counts``.
    """
    here = groups.withColumn("p0", price("0", "total", "size")).withColumnRenamed("total", "own_total")
    there = groups.select("lang", F.col("source").alias("item"), F.col("total").alias("item_total"), price("0", "total", "size").alias("q0"))
    both = here.join(there, "lang").where("source <> item")
    base = both.select("lang", "source", "item", (F.col("size").cast("decimal(20,0)") * gap("p0", "q0")).alias("value"))
    own = both.join(used, ["lang", "source"]).withColumn("p", price("n", "own_total", "size"))
    mine = own.select("lang", "source", "item", (F.col("terms").cast("decimal(18,0)") * (gap("p", "q0") - gap("p0", "q0"))).alias("value"))
    other = both.join(used.withColumnRenamed("source", "item"), ["lang", "item"]).withColumn("q", price("n", "item_total", "size"))
    theirs = other.select("lang", "source", "item", (F.col("terms").cast("decimal(18,0)") * (gap("p0", "q") - gap("p0", "q0"))).alias("value"))
    turned = pairs.select("lang", F.col("a").alias("source"), "n", F.col("b").alias("item"), "m", "terms").unionByName(
        pairs.select("lang", F.col("b").alias("source"), F.col("m").alias("n"), F.col("a").alias("item"), F.col("n").alias("m"), "terms"))
    cells = turned.join(both, ["lang", "source", "item"]).withColumn("p", price("n", "own_total", "size")).withColumn(
        "q", price("m", "item_total", "size"))
    shared = cells.select("lang", "source", "item", (F.col("terms").cast("decimal(18,0)") * (
        gap("p", "q") - gap("p", "q0") - gap("p0", "q") + gap("p0", "q0"))).alias("value"))
    parts = base.unionByName(mine).unionByName(theirs).unionByName(shared)
    return parts.groupBy("lang", "source", "item").agg(_exact_sum(F.col("value")).cast("long").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank: of each source its divergence from the other sources of
    the language (part pair), and the ``top`` terms it has more of than the language has as a whole (part term)."""
    kept = materialize(kept_terms(term_counts(docs), min_docs), "terms")
    cells = kept.select("lang", "term", F.aggregate("items", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("all_n"), F.inline("items"))
    used = materialize(cells.groupBy("lang", "source", "n").agg(F.count("*").alias("terms")), "used")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("size"))
    totals = used.groupBy("lang", "source").agg(F.sum(F.col("n") * F.col("terms")).alias("total"))
    found = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    groups = materialize(found.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("size", F.lit(0)).alias("size")), "groups")
    pair = divergences(groups, used, pair_counts(kept)).withColumn("part", F.lit("pair"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair = pair.withColumn("rank", F.row_number().over(order))
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    priced = cells.join(groups, ["lang", "source"]).join(langs, "lang").withColumn("p", price("n", "total", "size")).withColumn(
        "q", price("all_n", "lang_total", "size"))
    term = priced.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap("p", "q").alias("value"))
    term = term.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pair.unionByName(term).select("lang", "source", "part", "item", "value", "rank")
