"""Personal data: base patterns, and bootstrapped contextual extraction of identifiers they miss."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import materialize, without

# The base kinds, in order, and what they match. Possessive repeats and the test of what
# comes before only keep the search linear: a start inside a run fails exactly when the run's start does.
KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# a text without the mark has no match of the kind
_MARK = {"email": "@", "ip": ".", "card": None, "phone": "+"}
CONTEXT = "context"

TOKEN = r"(?:\G|(?<![A-Za-z0-9._%+@/-]))(?=[A-Za-z._%+@/-]*+[0-9])[A-Za-z0-9._%+@/-]{6,}+"  # identifier-shaped
REACH = 48          # code points before an instance that its pattern may reach
MIN_KNOWN = 5       # different known instances a pattern needs
PRECISION = 0.8     # share of known among a pattern's instances
BELIEF = 0.8        # score from which an instance counts as known


def _pieces(text: Column, pattern: str, when: Column):
    """(matches, gaps): the matches of a pattern and the text around them, one gap more than matches."""
    regex = F.lit(pattern)
    none = F.array().cast("array<string>")
    return F.when(when, F.regexp_extract_all(text, regex, F.lit(0))).otherwise(none), F.when(when, F.split(text, pattern, -1)).otherwise(none)


def _starts(matches: Column, gaps: Column) -> Column:
    """Start of each match in code points."""
    sizes = F.zip_with(matches, F.slice(gaps, 1, F.greatest(F.size(matches), F.lit(0))), lambda m, g: F.struct(
        F.length(g).cast("long").alias("g"), F.length(m).cast("long").alias("m")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(sizes, start, lambda a, s: F.struct(
        (a["at"] + s["g"] + s["m"]).alias("at"), F.concat(a["out"], F.array(a["at"] + s["g"])).alias("out")))["out"]


def _valid(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        short = F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(short, lambda p: (F.length(p) <= 3) & (F.lpad(p, 3, "0") <= "255"))
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(8, 15)
    each = F.transform(F.split(F.reverse(digits), "(?<=.)(?=.)"), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.floor(d.cast("int") / 5) + (d.cast("int") * 2) % 10))
    return F.length(digits).between(16, 19) & (F.aggregate(each, F.lit(0).cast("long"), lambda a, d: a + d) % 10 == 0)


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base``: array of (kind, start, end) in the order of KINDS, then by start.

    Matches are leftmost and do not overlap within a kind; those that fail the
    kind's test are dropped. Positions count code points, ends are exclusive.
    A null or empty text has none.
    """
    out = without(docs, ["base", "_t", *(f"_{p}_{k}" for k in KINDS for p in "mgs")]).withColumn("_t", F.coalesce(F.col(text), F.lit("")))
    digit = F.col("_t").rlike("[0-9]")
    steps = {}
    for kind, pattern in KINDS.items():
        when = F.lit(True) if _MARK[kind] is None else F.contains(F.col("_t"), F.lit(_MARK[kind]))
        steps[f"_m_{kind}"], steps[f"_g_{kind}"] = _pieces(F.col("_t"), pattern, when if kind == "email" else when & digit)
    out = out.withColumns(steps)
    out = out.withColumns({f"_s_{k}": _starts(F.col(f"_m_{k}"), F.col(f"_g_{k}")) for k in KINDS})
    parts = []
    for kind in KINDS:
        pairs = F.zip_with(f"_m_{kind}", f"_s_{kind}", lambda m, s: F.struct(m.alias("m"), s.alias("s")))
        good = F.filter(pairs, lambda p: _valid(kind, p["m"]))
        parts.append(F.transform(good, lambda p: F.struct(
            F.lit(kind).alias("kind"), p["s"].alias("start"), (p["s"] + F.length(p["m"])).alias("end"))))
    return out.withColumn("base", F.concat(*parts)).drop(*steps, *(f"_s_{k}" for k in KINDS))


def _tail(before: Column) -> Column:
    """The pattern of a place: the last two chunks of the text before it, in lower case, digits as 0."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.right(before, F.lit(REACH)), r"(\S+\s+)?\S*\s*$", 0)), "[0-9]", "0")


def _tokens(out: DataFrame) -> DataFrame:
    """``out`` with ``tokens``: identifier-shaped tokens (token, pattern, start, end, known) of ``_t``.

    The pattern is lexical: the last two chunks of text before the token, back
    to the token before it. A token is known when it overlaps a base span.
    """
    m, g = _pieces(F.col("_t"), TOKEN, F.col("_t").rlike("[0-9]"))
    out = out.withColumns({"_m": m, "_g": g}).withColumn("_s", _starts(F.col("_m"), F.col("_g")))
    rows = F.zip_with(F.zip_with("_m", "_s", lambda t, s: F.struct(t.alias("t"), s.alias("s"))), F.slice("_g", 1, F.greatest(F.size("_m"), F.lit(0))),
                      lambda p, x: F.struct(p["t"].alias("token"), _tail(x).alias("pattern"), p["s"].alias("start"), (p["s"] + F.length(p["t"])).alias("end")))
    known = lambda t: F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
    return out.withColumn("_r", rows).withColumn("tokens", F.transform("_r", lambda t: F.struct(
        t["token"].alias("token"), t["pattern"].alias("pattern"), t["start"].alias("start"), t["end"].alias("end"), known(t).alias("known")))
    ).drop("_m", "_g", "_s", "_r")


def _seeds(out: DataFrame) -> DataFrame:
    """``out`` with ``seeds``: each base span as a known instance (token, pattern, known) as a whole.

    Its pattern is that of a token at the start of the span.
    """
    def seed(b):
        reach = F.least(b["start"], F.lit(REACH)).cast("int")
        before = F.substring(F.col("_t"), (b["start"] - reach + 1).cast("int"), reach)
        gap = F.element_at(F.split(before, TOKEN, -1), -1)
        whole = F.substring(F.col("_t"), (b["start"] + 1).cast("int"), (b["end"] - b["start"]).cast("int"))
        return F.struct(whole.alias("token"), _tail(gap).alias("pattern"), F.lit(True).alias("known"))
    return out.withColumn("seeds", F.transform("base", seed))


def bootstrap(links: DataFrame) -> DataFrame:
    """(pattern, token) pairs whose token is discovered and whose pattern is trusted.

    ``links`` are the edges (pattern, token, known) of the pattern-instance
    graph. In each round a pattern's precision is the share of known among its
    different instances, and patterns of enough known instances and precision
    are trusted; an instance's belief is the chance that not all trusted
    patterns it occurs with are wrong, and from BELIEF on it is known. Known
    instances stay known, so the rounds end: when one changes nothing.
    """
    edges = materialize(links.where("pattern <> ''").groupBy("pattern", "token").agg(F.max("known").alias("seed")), "edges")
    seeds = edges.groupBy("token").agg(F.max("seed").alias("known"))
    state = materialize(seeds.withColumn("found", F.lit(False)), "instances")
    while True:
        joined = edges.join(state, "token")
        scores = joined.groupBy("pattern").agg(F.count("*").alias("n"), F.count_if("known").alias("k"))
        trusted = materialize(scores.where((F.col("k") >= MIN_KNOWN) & (F.col("k") >= PRECISION * F.col("n"))).select(
            "pattern", (F.col("k") / F.col("n")).alias("precision")), "patterns")
        doubt = edges.join(trusted, "pattern").groupBy("token").agg(
            F.exp(F.sum(F.log(F.greatest(1 - F.col("precision"), F.lit(1e-9))))).alias("doubt"))
        new = materialize(state.join(doubt, "token", "left").select("token", (F.col("known") | (F.coalesce(1 - F.col("doubt"), F.lit(0.0)) >= BELIEF)).alias("known"), (
            F.col("found") | (~F.col("known") & (F.coalesce(1 - F.col("doubt"), F.lit(0.0)) >= BELIEF))).alias("found")), "instances")
        changed = not new.join(state.select("token", F.col("known").alias("was")), "token").where("known <> was").isEmpty()
        state = new
        if not changed:
            break
    return edges.join(state.where("found"), "token").join(trusted, "pattern").select("pattern", "token")


def extract(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans, contexts) of every row of ``docs``.

    ``contexts`` are the spans of kind ``context``: identifier-shaped tokens
    outside all base spans that bootstrapping discovered, where they follow a
    trusted pattern. Base spans and known tokens are the seeds. ``spans`` lists base and context spans as kind:start:end,
    comma-joined, by kind and start. Rows are told apart by a stored number, so keys may be null or repeat.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    held = materialize(_seeds(_tokens(base_spans(rows))).select(
        "key", "base", "tokens", "seeds", F.monotonically_increasing_id().alias("row")), "spans")
    seen = held.select("row", F.inline("tokens"))
    seeds = held.select(F.inline("seeds")).select("pattern", "token", "known")
    good = bootstrap(seen.select("pattern", "token", "known").unionAll(seeds))
    more = seen.where("NOT known").join(good, ["pattern", "token"]).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("more"))
    named = F.transform("more", lambda s: F.struct(F.lit(CONTEXT).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    out = held.select("row", "key", "base").join(more, "row", "left").withColumn(
        "contexts", F.coalesce(named, F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")))
    line = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return out.select(
        F.col("key").alias(key), *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(line(F.col("base")), 256).alias("base_sha256"),
        line(F.concat("base", "contexts")).alias("spans"), "contexts")
