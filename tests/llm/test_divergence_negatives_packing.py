"""Divergence audit, hard negatives and packing against brute force, with odd inputs."""

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from check_queries import compare, connect
from terracell.llm import divergence, negatives, packing, queries

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
SF = "/root/testdata/sf0.01"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_twins(spark, name):
    assert compare(spark, connect(SF), SF, name, queries.QUERIES[name], queries.SQL[name])[1] == "ok"


# --- divergence ---

def brute_audit(rows, min_docs=3, top=200):
    terms = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")))
             for _, t, lang, source, _ in rows]
    out = set()
    for lang in {x[0] for x in terms}:
        docs = collections.Counter(t for a, _, ws in terms if a == lang for t in set(ws))
        kept = sorted(t for t, n in docs.items() if n >= min_docs)
        counts = {}
        for a, s, ws in terms:
            if a == lang:
                counts.setdefault(s, collections.Counter()).update(w for w in ws if docs[w] >= min_docs)
        price = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        p, q = {s: price(c) for s, c in counts.items()}, price(sum(counts.values(), collections.Counter()))
        d = lambda x, y: (x - y) ** 2 // y
        for s in counts:
            pairs = [(sum(d(p[s][t], p[o][t]) for t in kept), o) for o in counts if o != s]
            over = [(d(p[s][t], q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", over)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, i, v, k) for k, (v, i) in enumerate(found[: top if part == "term" else None], 1)}
    return out


def audited(docs, **how):
    got = [tuple(r) for r in divergence.audit(docs, **how).collect()]
    assert len(set(got)) == len(got)
    return set(got)


def test_divergence_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 40)
    r = random.Random(4)
    words = [f"{a}{b}" for a in "abcdé你" for b in "abcde"] + ["Ab", "aB", "x1y", "ÄB", "äb"]
    rows = []
    for i in range(240):
        text = " ".join(r.choice(words) for _ in range(r.randrange(0, 25)))
        rows.append((i, text, r.choice(["en", "en", "en", "de", None, ""]), r.choice(["s0", "s0", "s0", "s1", "s2", "z", None, "é"]), 1))
    rows += [(900, None, "en", "s1", 1), (None, "", "en", "only", 1), (901, "ab " * 30000, "en", "s0", 1), (902, "alone", "xx", "a", 1), (903, "", "xx", "b", 1)]
    rows += [(904, "ab ab ca", "en", "s2", 1)] * 5
    docs = frame(spark, rows).withColumnRenamed("n_chars", "term")
    assert audited(docs) == brute_audit(rows)
    assert audited(docs.repartition(7), top=3) == brute_audit(rows, top=3)
    assert {x[3:] for x in audited(docs) if x[0] == "xx"} == {("a", 0, 1), ("b", 0, 1)}


def test_pair_counts_of_the_tree(spark):
    r = random.Random(5)
    kept = [("l", f"t{i}", [(s, r.randrange(1, 4)) for s in "abcdef" if r.random() < 0.5]) for i in range(500)]
    rows = spark.createDataFrame(kept, "lang STRING, term STRING, items ARRAY<STRUCT<source STRING, n BIGINT>>")
    got = {tuple(x)[1:5]: x["terms"] for x in divergence.pair_counts(rows).collect()}
    assert got == collections.Counter((a, n, b, m) for _, _, items in kept for (a, n), (b, m) in itertools.combinations(items, 2))


def test_divergence_of_an_empty_table(spark):
    assert divergence.audit(frame(spark, [])).count() == 0


def test_large_counts_stay_exact(spark):
    terms = spark.createDataFrame([("l", "t", [("a", 10**13), ("b", 3)]), ("l", "u", [("a", 1)])],
                                  "lang STRING, term STRING, items ARRAY<STRUCT<source STRING, n BIGINT>>")
    assert terms.select(divergence.price(str(10**13), str(10**13 + 1) + "L", "2L")).first()[0] == 1 + 10**9 * (10**13 + 1) // (10**13 + 3)


# --- hard negatives ---

def brute_mine(rows, every=100, k=5, n=10, low=30, high=90):
    usable = sorted({(i, lab, tuple(int(np.floor(256 * float(x))) for x in v)) for i, lab, v in rows
                     if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)})
    out = collections.Counter()
    for a, lab, v in usable:
        if a % every:
            continue
        score = sorted(((-sum(x * y for x, y in zip(v, w, strict=False)), j, m) for j, m, w in usable if j != a))
        for ps, p, _ in [s for s in score if s[2] == lab][:k]:
            found = [s for s in score if s[2] != lab and low * -ps <= 100 * -s[0] <= high * -ps][:n]
            out.update((a, p, rank, j, -ps, -ns) for rank, (ns, j, _) in enumerate(found, 1))
    return out


VECTORS = "vec_id BIGINT, label INT, embedding ARRAY<FLOAT>"


def mined(spark, rows, **how):
    got = negatives.mine(spark.createDataFrame(rows, VECTORS).repartition(5), **how).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return collections.Counter(tuple(r) for r in got.collect())


def vectors(seed, n, dim, spread=1.0, labels=4):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(labels, dim))
    return [(i, i % labels, [float(np.float32(x)) for x in (centre[i % labels] * r.uniform(0, 2) + r.normal(size=dim) * spread) * r.choice([0.1, 1, 3])])
            for i in range(n)]


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_negatives_equal_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(negatives, "TURN_BYTES", 2500)  # several turns of anchors
    rows = vectors(1, 900, 8, spread)
    rows += [(1000 + i, i % 4, rows[17][2]) for i in range(60)]                       # one vector many times: ties by id
    rows += [(3000, None, [1.0] * 8), (3100, 1, None), (3200, 1, [float("nan")] * 8), (3300, 1, [None] * 8), (3400, 2, [float("-inf")] * 8)]
    rows += [(3500, 2, [0.0] * 8), (3600, 3, []), (3700, 3, [2.0, 1.0]), (None, 1, [1.0] * 8), (100, 0, [0.5] * 8), (100, 0, [0.5] * 8)]
    assert mined(spark, rows) == brute_mine(rows)


def test_pruning_leaves_the_feasible_rows():
    r = np.random.default_rng(3)
    matrix = (r.normal(size=(400, 6)) * r.uniform(50, 75, size=(400, 1))).astype("int32")
    matrix[::50] = 0
    bucket = negatives.Bucket(np.arange(400), np.zeros(400), np.arange(400), matrix)
    for v in [*(r.normal(size=(30, 6)) * 60).astype("int32"), np.zeros(6, "int32"), np.array([90, 0, 0, 0, 0, 0], "int32")]:
        anchor, score = negatives.Anchor(0, -1, 0, v), matrix.astype("int64") @ v.astype("int64")
        for low, high in ((-np.inf, np.inf), (9000, np.inf), (15000, 20000), (-200, 200), (-np.inf, -9000), (-20000, -8000), (0, 0)):
            found = bucket.candidates(anchor, low, high)
            want = set(np.flatnonzero((score >= low) & (score <= high)))
            assert want <= set(found) and len(set(found)) == len(found)
            assert (bucket.scores(anchor, found) == score[found]).all()
    rows = r.normal(size=(400, 6))
    rows = (rows / np.linalg.norm(rows, axis=1)[:, None] * 1000).astype("int32")
    bucket = negatives.Bucket(np.arange(400), np.zeros(400), np.arange(400), rows)
    left = [len(bucket.candidates(negatives.Anchor(0, -1, 0, v), 850_000, np.inf)) for v in rows[:40]]
    assert np.mean(left) < 100


def test_negatives_of_large_components_and_small_tables(spark):
    rows = [(0, 0, [1e30, 1.0]), (1, 0, [3e7, -2.0]), (2, 1, [1e5, 5.0]), (3, 1, [1.5e5, 5.0])]
    got = mined(spark, rows, every=2, low=0, high=100)
    top = negatives.LIMIT
    assert got[(0, 1, 1, 3, top * top + 256 * -512, top * int(256 * 1.5e5) + 256 * 1280)] == 1
    assert not mined(spark, rows[:1]) and negatives.mine(spark.createDataFrame([], VECTORS)).count() == 0


# --- packing ---

CAPACITY = 64


def word_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [tok.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def packed(spark, texts, keys=None, **how):
    import public_tokenizers
    keys = list(range(len(texts))) if keys is None else keys
    docs = frame(spark, [(k, t, "en", "s", 1) for k, t in zip(keys, texts, strict=True)]).withColumnRenamed("n_chars", "offset")
    return packing.pack_documents(docs.repartition(3), public_tokenizers.path("word_bpe_49k.json"), CAPACITY, 1, **how)


def odd_texts(seed=7):
    r = random.Random(seed)
    some = ["it's 12 o''clock, we'll see...", "Ünï CÖDÉ 你好 İstanbul ΣΑΣ", "a<|endoftext|>b <|startoftext|>", "t\x1cab \x85 y z q", "é é ﬁ",
            "\x00\x07 tab\tnew\n\nline", "'s 's't''re", "x" * 3000, "😀😀 a_b--c 3.14", " \n ", None, "", "word " * 700]
    letters = "aAbBzZéÉßñ'’.,!?-_09 \t\n你😀ΣσİÍ"
    return some + ["".join(r.choice(letters) for _ in range(r.randrange(0, 160))) for _ in range(300)] + ["same text again"] * 40


def test_pieces_and_places(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 64)
    texts = odd_texts()
    ids = word_ids(texts)
    rows = packed(spark, texts, keep_ids=True).collect()
    want = {(i, k // CAPACITY, k, tuple(own[k:k + CAPACITY])) for i, own in enumerate(ids) for k in range(0, len(own), CAPACITY)}
    assert {(r["doc_id"], r["piece"], r["start"], tuple(np.frombuffer(r["ids"], "<u4"))) for r in rows} == want and len(rows) == len(want)
    assert all(r["length"] == len(r["ids"]) // 4 and r["ids_crc32"] == zlib.crc32(r["ids"]) for r in rows)
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [0, *itertools.accumulate(n for _, n in own)][:-1] and sum(n for _, n in own) <= CAPACITY
    assert len(bins) <= -(-sum(map(len, ids)) // CAPACITY) * 1.02 + 1


def test_sequences_hold_the_ids(spark):
    texts = odd_texts(8)[:60]
    got = packing.sequences(packed(spark, texts, keep_ids=True)).collect()
    assert sorted(i for r in got for i in np.frombuffer(r["ids"], "<u4")) == sorted(i for own in word_ids(texts) for i in own)
    assert all(len(r["ids"]) == 4 * r["length"] <= 4 * CAPACITY for r in got)


def test_repeated_null_keys_and_an_empty_table(spark):
    rows = packed(spark, ["a b", "a b", None, "c"], [5, 5, None, None]).collect()
    assert sorted((str(r["doc_id"]), r["length"]) for r in rows) == [("5", 3), ("5", 3), ("None", 1), ("None", 2)]
    assert len({r["sequence_id"] for r in rows}) == 1 and sorted(r["offset"] for r in rows) == [0, *itertools.accumulate(
        r["length"] for r in sorted(rows, key=lambda r: r["offset"]))][:-1]
    assert packed(spark, []).count() == 0


def triples(seed, bins, capacity=100):
    """Lengths that fill ``bins`` bins exactly, three in each."""
    r = random.Random(seed)
    out = []
    for _ in range(bins):
        a = r.randrange(26, 40)
        b = r.randrange(27, 38)
        out += [a, b, capacity - a - b]
    return np.array(sorted(out, reverse=True), "int64")


def test_evolution_improves_and_stays_valid():
    gains = 0
    for seed in range(6):
        sizes, rng = triples(seed, 30), np.random.default_rng(seed)
        first = packing.evolve(sizes, [], 100, rng, 0)
        last = packing.evolve(sizes, list(first), 100, rng, 400)
        for bins in last:
            assert set(bins) == set(range(bins.max() + 1)) and np.bincount(bins, weights=sizes).max() <= 100
        rank = lambda b: (b.max(), -packing.fitness(sizes, b, 100))
        assert rank(last[0]) <= rank(first[0])
        gains += rank(last[0]) < rank(first[0])
    assert gains >= 4


def test_crossover_keeps_injected_bins_whole():
    sizes, rng = triples(3, 20), np.random.default_rng(0)
    one, two = packing.evolve(sizes, [], 100, rng, 0)[:2]
    for _ in range(50):
        child = packing.crossover(sizes, one, two, 100, rng)
        assert np.bincount(child, weights=sizes).max() <= 100
        groups = lambda b: {frozenset(np.flatnonzero(b == k)) for k in range(b.max() + 1)}
        assert groups(child) & groups(two)


def test_open_bins_of_blocks_meet_again(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 30)
    lengths = [70] * 100 + [30] * 100 + [11] * 5
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id BIGINT, length INT")
    got = packing.pack(rows.repartition(4), 100).toPandas()
    assert len(got) == 205 and got.groupby("sequence_id")["length"].sum().max() <= 100
    assert got["sequence_id"].nunique() <= 103
