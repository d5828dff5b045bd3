"""The operators on small tables: brute force, nulls, empty and long texts, repeats, empty tables, clashing columns."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from terracell.llm import ann, decontam, jaccard, langid, mixing, records, sharding, suffix, toxicity
from terracell.llm.ann import search
from terracell.llm.decontam import decontaminate, remove_spans
from terracell.llm.langid import identify
from terracell.llm.pii import extract

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def texts(spark, values, ids=None):
    ids = range(len(values)) if ids is None else ids
    return frame(spark, [(i, t, "en", "s", 1) for i, t in zip(ids, values, strict=True)])


def prose(seed, n, vocab=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocab)}" for _ in range(n))


# --- decontamination ---

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


def brute_hits(docs, items):
    windows = collections.defaultdict(set)
    for i, t in items:
        ws = words(t)
        if i is not None and ws:
            for k in range(max(1, len(ws) - 12)):
                windows[tuple(ws[k:k + 13])].add(str(i))
    out = {}
    for d, t in docs:
        ws, hit, found = words(t), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(ws) - size + 1):
                if (at := tuple(ws[k:k + size])) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[at]
        ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[d] = (len(ws), len(hit), len(found), ids, bool(hit) and 20 * len(hit) >= len(ws))
    return out


@pytest.fixture(scope="module")
def contaminated():
    r = random.Random(4)
    items = [(i, prose(i, r.choice([1, 3, 12, 13, 14, 40]), 30)) for i in range(25)] + [(None, "w1 w2"), (99, ""), (98, None), (3, prose(3, 20, 30))]
    docs = [(i, prose(100 + i, 60, 30)) for i in range(20)] + [(40, items[5][1].upper() + " É"), (41, None), (42, ""), (43, "!!"), (44, prose(1, 30000, 30))]
    docs += [(50 + i, prose(7, 20) + " " + t[:200] + " " + prose(8, 15)) for i, t in items[:25] if t]
    return docs, items


def check_hits(got, want):
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got} == want


def test_decontamination_equals_brute_force(spark, contaminated):
    docs, items = contaminated
    table = texts(spark, [t for _, t in docs], [i for i, _ in docs]).withColumnRenamed("n_chars", "N_HIT")
    got = decontaminate(table, frame(spark, items, "item_id INT, text STRING"))
    assert got.columns.count("n_hit") == 1 and "N_HIT" not in got.columns
    check_hits(got.collect(), brute_hits(docs, items))


def test_decontamination_in_several_blocks(spark, contaminated, monkeypatch):
    docs, items = contaminated
    monkeypatch.setattr("terracell.llm.decontam.BLOCK_BYTES", 300)
    monkeypatch.setattr("terracell.llm.decontam.PIECE_WORDS", 9)
    got = decontaminate(texts(spark, [t for _, t in docs], [i for i, _ in docs]), frame(spark, items, "item_id INT, text STRING"))
    check_hits(got.collect(), brute_hits(docs, items))


def test_decontamination_of_empty_tables(spark):
    items = frame(spark, [(1, "a b")], "item_id INT, text STRING")
    assert decontaminate(texts(spark, []), items).count() == 0
    assert decontaminate(texts(spark, ["a b"]), items.limit(0)).first()["n_hit"] == 0


def test_spans_are_cut_from_texts(spark):
    item = " ".join(f"i{k}" for k in range(14))
    found = decontaminate(texts(spark, [f"Keep, {item.upper()} -- the rest", None, "plain"]), frame(spark, [(1, item)], "item_id INT, text STRING"))
    assert [r["clean_text"] for r in remove_spans(found).orderBy("doc_id").collect()] == ["Keep,  -- the rest", None, "plain"]


# --- sharding ---

def test_shards_have_equal_bytes_and_gapless_slots(spark, tmp_path):
    r = random.Random(1)
    values = [prose(i, r.randrange(1, 300)) for i in range(3000)] + [None, "", "x" * 5000]
    rows = sharding.shard(texts(spark, values), str(tmp_path / "map"), 16).collect()
    assert len(rows) == len(values) and {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}
    load = collections.Counter()
    for r in rows:
        t = (values[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(t) + 1, zlib.crc32(t))
        load[r["shard"]] += r["size"]
    assert len(load) == 16 and max(load.values()) - min(load.values()) < 0.01 * sum(load.values()) / 16
    for k in range(16):
        assert sorted(r["slot"] for r in rows if r["shard"] == k) == list(range(sum(r["shard"] == k for r in rows)))


def test_rebalancing_moves_few_slots(spark, tmp_path):
    path, docs = str(tmp_path / "map"), texts(spark, [prose(i, 50) for i in range(500)])
    sharding.shard(docs, path, 4)
    sized = sharding.with_slot(docs)
    assert sharding.next_version(spark, path, 0, sized, 5) == 1
    old = {r["virtual_slot"]: r["shard"] for r in sharding.read_map(spark, path, 0).collect()}
    new = {r["virtual_slot"]: r["shard"] for r in sharding.read_map(spark, path, 1).collect()}
    weight = sharding.slot_bytes(sized)
    moved = sum(weight.get(s, 0) for s in old if old[s] != new[s])
    assert set(new.values()) == set(range(5)) and moved < 0.3 * sum(weight.values())


def test_sharding_of_null_and_repeated_keys(spark, tmp_path):
    rows = sharding.shard(texts(spark, ["a"] * 50, [None] * 30 + [7] * 20), str(tmp_path / "map"), 3).collect()
    assert len(rows) == 50
    assert all(sorted(r["slot"] for r in rows if r["shard"] == k) == list(range(sum(r["shard"] == k for r in rows))) for k in range(3))
    assert sharding.shard(texts(spark, []), str(tmp_path / "none"), 3).count() == 0


# --- Jaccard join ---

def brute_components(values):
    sets = []
    for t in values:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    low = list(range(len(values)))
    changed = True
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in pairs:
            m = min(low[i], low[j])
            changed |= low[i] != m or low[j] != m
            low[i] = low[j] = m
    return [len(s) for s in sets], low


def near_copies():
    r = random.Random(9)
    base = [prose(i, 120) for i in range(12)]
    shared = prose(77, 60)
    values = list(base)
    for b in base:
        for _ in range(6):
            w = b.split()
            for _ in range(r.randrange(0, 5)):
                w[r.randrange(len(w))] = f"x{r.randrange(99)}"
            values.append(" ".join(w))
    values += [shared + " " + prose(200 + i, r.choice([5, 12, 40])) for i in range(25)]
    values += ["a b", "A  b", "a b c", None, "", " \t", "word", "long " * 9000, base[0].upper()]
    r.shuffle(values)
    return values


@pytest.mark.parametrize("cross", [0, 30])
def test_join_components_equal_brute_force(spark, monkeypatch, cross):
    monkeypatch.setattr(jaccard, "CROSS", cross)
    monkeypatch.setattr(jaccard, "LOCAL", 2)
    values = near_copies()
    sizes, low = brute_components(values)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join_components(texts(spark, values)).collect()}
    assert got == {i: (sizes[i], low[i]) for i in range(len(values))}


def test_prefixes_of_similar_sets_share_their_level():
    r = np.random.default_rng(2)
    heavy = np.unique(r.integers(1, 1 << 63, 40).astype("uint64"))
    order = jaccard.Order(heavy, r.integers(2, 5000, len(heavy)))
    for _ in range(300):
        n = int(r.integers(1, 60))
        a = np.unique(np.concatenate([r.integers(1, 1 << 63, n).astype("uint64"), r.choice(heavy, 30)]))
        b = np.unique(np.concatenate([a[r.random(len(a)) < 0.95], r.integers(1, 1 << 63, 2).astype("uint64")]))
        common = len(np.intersect1d(a, b))
        if common * 5 >= 4 * (len(a) + len(b) - common):
            (k, p), (m, q) = order.prefix(a), order.prefix(b)
            assert len(np.intersect1d(p, q)) >= min(k, m)


def test_one_of_each_group_stays(spark):
    base = prose(1, 50)
    docs = texts(spark, [base, base.upper(), prose(2, 50), None, "", base])
    assert sorted(r["doc_id"] for r in jaccard.keep_one(docs).collect()) == [0, 2, 3, 4]
    assert jaccard.keep_one(docs).columns == docs.columns
    again = texts(spark, [base, base, prose(2, 50), None, prose(2, 50)], [None, 4, 4, None, None])
    kept = jaccard.keep_one(again).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted([(4, base), (4, prose(2, 50)), (None, None)], key=str)
    assert jaccard.keep_one(texts(spark, [])).count() == 0


# --- repeated strings ---

def brute_repeats(values, size):
    data = [(t or "").encode() for t in values]
    seen = collections.Counter(t[i:i + size] for t in data for i in range(len(t) - size + 1))
    out = []
    for t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if seen[t[i:i + size]] > 1:
                gone[i:i + size] = b"\1" * size
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), kept))
    return out


@pytest.mark.parametrize("hot, rows", [(200_000, 8192), (3, 8192), (200_000, 5)])
def test_repeats_equal_brute_force(spark, monkeypatch, hot, rows):
    monkeypatch.setattr(suffix, "HOT", hot)
    monkeypatch.setattr(suffix, "SORT_ROWS", rows)
    r = random.Random(6)
    passage, other = prose(1, 200), prose(2, 150)
    values = [prose(10 + i, 150) for i in range(8)]
    values += [prose(30 + i, r.randrange(40)) + passage[r.randrange(300): 500 + r.randrange(300)] + prose(60 + i, 30) for i in range(20)]
    values += [prose(90, 20) + other + prose(91, 20) + other, "ab" * 900, "é" * 700, passage, passage, None, "", "x" * 399, "y" * 400, "z" * 401]
    values += [passage[:400] + "!" + passage[401:800], prose(5, 3000)]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix.remove_repeats(texts(spark, values)).collect()}
    assert got == dict(enumerate(brute_repeats(values, suffix.WINDOW)))


def test_repeats_in_pieces_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(suffix, "PIECE", 1000)
    values = [prose(1, 900), prose(2, 100) + prose(1, 900)[1500:2600] + prose(3, 50)]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix.remove_repeats(texts(spark, values)).collect()}
    assert got == dict(enumerate(brute_repeats(values, suffix.WINDOW)))
    assert suffix.remove_repeats(texts(spark, [])).count() == 0


def test_blind_trie_sorts():
    r = random.Random(3)
    for size in (2, 3, 40):
        rows = [bytes(r.choice(b"ab") for _ in range(24)) for _ in range(size)]
        assert [rows[i] for i in suffix.blind_order(rows)] == sorted(rows)


def test_a_second_batch_edits_the_map(spark, tmp_path):
    path = str(tmp_path / "map")
    first = texts(spark, [prose(i, 30) for i in range(400)])
    one = {r["doc_id"]: r for r in sharding.shard(first, path, 4).collect()}
    same = {r["doc_id"]: r["shard"] for r in sharding.shard(first, path, 4).collect()}
    assert {r["map_version"] for r in one.values()} == {0} and same == {i: r["shard"] for i, r in one.items()}
    assert sharding.latest_version(spark, path) == 0
    grown = first.unionByName(texts(spark, [prose(i, 300) for i in range(400, 460)], range(400, 460)))
    two = sharding.shard(grown, path, 4).collect()
    assert {r["map_version"] for r in two} == {1} == {sharding.latest_version(spark, path)}
    moved = sum(one[r["doc_id"]]["shard"] != r["shard"] for r in two if r["doc_id"] in one)
    load = collections.Counter()
    for r in two:
        load[r["shard"]] += r["size"]
    assert moved < 200 and max(load.values()) < 1.1 * sum(load.values()) / 4
    five = sharding.shard(grown, path, 5).collect()
    assert {r["map_version"] for r in five} == {2} and {r["shard"] for r in five} == set(range(5))
    assert sharding.latest_version(spark, str(tmp_path / "none")) is None


# --- mixing ---

def test_blocks_meet_their_windows_and_targets(spark):
    counts = {"a": 900, "b": 300, "c": 40, None: 25}
    rows = [(i, "t", "en", s, 1) for i, s in enumerate(s for s, n in counts.items() for _ in range(n))] + [(None, "t", "en", "a", 1)] * 70
    got = mixing.mix(frame(spark, rows), block=4).collect()
    assert len(got) == len(rows) and sorted(r["position"] for r in got) == list(range(len(rows)))
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in got)
    assert sorted(r["doc_id"] for r in got if r["doc_id"] is not None) == list(range(1265))
    units = {r["source"]: r["units"] for r in got}
    assert sum(units.values()) == got[0]["period"]
    blocks = {(r["source"], r["block"]): r["slot"] for r in got}
    assert len(set(blocks.values())) == len(blocks)
    end = min(max(slot for (s, _), slot in blocks.items() if s == k) for k in units)  # until the first source runs out
    for t in range(1, end):
        for s, u in units.items():
            assert abs(sum(slot < t for (k, _), slot in blocks.items() if k == s) - t * u / got[0]["period"]) < 1


def test_given_weights_and_order(spark):
    docs = frame(spark, [(i, "t", "en", "ab"[i % 2], 1) for i in range(64)])
    mixed = mixing.mix(docs, {"a": 3.0, "b": 1.0}, block=1)
    assert {r["source"]: r["units"] for r in mixed.collect()} == {"a": 750, "b": 250}
    place = {r["doc_id"]: r["position"] for r in mixed.collect()}
    out = mixing.in_order(docs, mixed)
    assert out.columns == docs.columns and [place[r["doc_id"]] for r in out.collect()] == list(range(64))
    assert mixing.mix(docs.limit(0)).count() == 0


def test_lag_against_the_weights_does_not_grow():
    weights = {"a": 20, **{f"r{i:02d}": 1 for i in range(20)}}
    counts = {f"={k}": w * 4000 for k, w in weights.items()}
    units, period = mixing.target_shares(counts, weights)
    done = dict.fromkeys(counts, 0)
    for key, block, release, deadline, slot, start in mixing.timetable(counts, units, period, 32):
        assert release <= slot < deadline and start == 32 * slot and block == done[key]
        done[key] += 1
        assert all(abs(n * 40 - (slot + 1) * weights[k[1:]]) < 40 for k, n in done.items())
    assert done == {k: n // 32 for k, n in counts.items()}


def test_small_weights_are_exact(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 3)
    docs = frame(spark, [(i, "t", "en", "ab"[i % 2], 1) for i in range(20)])
    got = mixing.mix(docs, {"b": 10000, "a": 1}, block=1).collect()
    assert {r["source"]: (r["units"], r["period"]) for r in got} == {"a": (1, 10001), "b": (10000, 10001)}
    assert sorted(r["position"] for r in got) == list(range(20))
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in got)
    assert mixing.target_shares({"=a": 1, "=b": 1}, {"a": 0.1, "b": 0.2}) == ({"=a": 334, "=b": 668}, 1002)


def test_many_equal_short_items(spark):
    import time
    items = [(i, "lorem") for i in range(8000)] + [(9000 + i, "ipsum lorem") for i in range(500)]
    value = "lorem ipsum " * 5000
    start = time.time()
    automaton = decontam.Automaton([(str(i), True, t.encode().split()) for i, t in items], 13)
    built = time.time()
    spans, found = automaton.scan(decontam.words(value.encode()))
    assert time.time() - built < 1.0 and built - start < 2.0
    assert spans == [(0, 9999)] and found == {str(i) for i, _ in items}
    docs = [(1, value[:120]), (2, "ipsum"), (3, "ipsum lorem x")]
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in decontaminate(
        texts(spark, [t for _, t in docs], [d for d, _ in docs]), spark.createDataFrame(items, "item_id BIGINT, text STRING")).collect()}
    assert got == brute_hits(docs, items)


# --- language ---

def test_languages_are_told_apart(spark):
    r = random.Random(5)
    make = lambda letters: " ".join("".join(r.choice(letters) for _ in range(r.randrange(2, 8))) for _ in range(30))
    rows = [(i, make("abcdefgh" if i % 2 else "ghijklmnop"), ["x", "y"][i % 2], "s", 1) for i in range(200)]
    rows += [(900, None, "x", "s", 1), (901, "", "x", "s", 1), (902, "12 !?", "y", "s", 1), (None, make("abcdefgh"), None, "s", 1), (903, make("abc") * 3000, None, "s", 1)]
    got = {r["doc_id"]: r for r in identify(frame(spark, rows).withColumnRenamed("n_chars", "score")).collect()}
    assert all(got[i]["lang_pred"] == ["x", "y"][i % 2] and got[i]["accepted"] and 0 <= got[i]["score"] <= 1 for i in range(200))
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(200))
    assert all((got[i]["lang_pred"], got[i]["score"], got[i]["accepted"]) == ("und", 0.0, False) for i in (900, 901, 902))
    assert got[None]["lang_pred"] == got[903]["lang_pred"] == "y"


def brute_bits(words_of, word):
    """Bits of a word under interpolated Kneser-Ney 4-grams, from the counts of the words learned."""
    grams = {4: collections.Counter()}
    for w, n in words_of.items():
        p = "\x02" * 3 + w + "\x03"
        for i in range(len(p) - 3):
            grams[4][p[i:i + 4]] += n
    for k in (3, 2, 1):
        grams[k] = collections.Counter(g[1:] for g in grams[k + 1])
    total, types, cut = {}, {}, {}
    for k, own in grams.items():
        total[k], types[k] = collections.Counter(), collections.Counter()
        for g, c in own.items():
            total[k][g[:-1]] += c
            types[k][g[:-1]] += 1
        once, twice = sum(c == 1 for c in own.values()), sum(c == 2 for c in own.values())
        cut[k] = once / (once + 2 * twice) if once and twice else 0.5
    p, bits = "\x02" * 3 + word + "\x03", 0.0
    for i in range(len(p) - 3):
        q = 1 / (len(grams[1]) + 1)
        for k in (1, 2, 3, 4):
            g = p[i + 4 - k:i + 4]
            if total[k][g[:-1]]:
                q = (max(grams[k][g] - cut[k], 0) + cut[k] * types[k][g[:-1]] * q) / total[k][g[:-1]]
        bits -= np.log2(q)
    return bits


def test_cross_entropies_equal_brute_force(spark):
    r = random.Random(12)
    make = lambda letters: " ".join("".join(r.choice(letters) for _ in range(r.randrange(1, 7))) for _ in range(r.randrange(1, 12)))
    rows = [(i, make("abcdeé你" if i % 2 else "cdefgß"), ["x", "y"][i % 2], "s", 1) for i in range(120)]
    rows += [(500, "zzz qqq ab", None, "s", 1), (501, "Cd CD cd" * 40, "x", "s", 1), (501, "Cd CD cd" * 40, "x", "s", 1)]
    learned = {"x": collections.Counter(), "y": collections.Counter()}
    for i, t, la, _, _ in rows:
        if la and zlib.crc32(str(i).encode()) % 5:
            learned[la].update(langid.words(t))
    for got in identify(frame(spark, rows)).collect():
        ws = langid.words(got["text"])
        bits = {la: sum(brute_bits(own, w) for w in ws) / sum(len(w) + 1 for w in ws) for la, own in learned.items()}
        assert got["bits_per_char"] == pytest.approx(min(bits.values()), rel=1e-9) and bits[got["lang_pred"]] == min(bits.values())


def test_calibration_counts_every_learned_row(spark, monkeypatch):
    rows = [(i, f"{'abcdefgh'[i % 8]}a{'cdef'[i // 8 % 4]}" if i % 2 else f"{'xyzuvw'[i % 6]}z", ["x", "y"][i % 2], "s", 1) for i in range(26_000)]
    learned = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(26_000))
    seen, fit = [], langid._fit
    monkeypatch.setattr(langid, "_fit", lambda x, *more: seen.append(x.count()) or fit(x, *more))
    docs = frame(spark, rows)
    whole = {r["doc_id"]: (r["lang_pred"], r["score"], r["bits_per_char"], r["accepted"]) for r in identify(docs).collect()}
    slim = identify(docs, keep=["doc_id"])
    assert slim.columns == ["doc_id", "held_out", "lang_pred", "score", "bits_per_char", "accepted"]
    assert {r["doc_id"]: (r["lang_pred"], r["score"], r["bits_per_char"], r["accepted"]) for r in slim.collect()} == whole
    assert seen == [learned, learned] and learned > 20_000


def test_calibration_equals_numpy(spark):
    r = np.random.default_rng(3)
    n = 400
    x = np.abs(r.normal(size=(n, 2)) * [4, 1])
    right = (r.random(n) < 1 / (1 + np.exp(1 - x[:, 0]))).astype(float)
    w = np.zeros(3)
    full, y = np.column_stack([np.ones(n + 1), np.vstack([x, np.zeros((1, 2))])]), np.append(right, 0.0)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        w += np.linalg.solve((full * (p * (1 - p) + 1e-9)[:, None]).T @ full + 1e-3 * np.eye(3), full.T @ (y - p) - 1e-3 * w)
    bits, sizes, langs = 2 + r.random(n) * 4, r.integers(10, 60, n), [["x", "y", "z"][i % 3] for i in range(n)]
    rows = spark.createDataFrame(
        [(float(a), float(b), float(c), float(d), int(e), f) for (a, b), c, d, e, f in zip(x, right, bits, sizes, langs)],
        "sure DOUBLE, lead DOUBLE, right DOUBLE, _bits DOUBLE, _size BIGINT, lang STRING")
    assert langid._fit(rows, ["sure", "lead"], "right") == pytest.approx(list(w), rel=1e-6)
    got = langid._usual(rows)
    for k in "xyz":
        own = np.array([b for b, s, la in zip(bits, sizes, langs) if la == k and s >= 20])
        assert got[k] == pytest.approx(np.median(own) + 8 * max(own.std(), 0.05), rel=1e-5)


def test_language_without_anything_to_learn(spark):
    docs = frame(spark, [(1, "abc", None, "s", 1)])
    assert identify(docs).first()["lang_pred"] == "und" and identify(docs.limit(0)).count() == 0


def test_different_ngrams_stay_apart(spark):
    r = random.Random(6)
    values = ["".join(chr(r.randrange(0x4E00, 0x9000)) for _ in range(40)) for _ in range(600)]
    got = langid.counts(texts(spark, values)).where("ord = 4 AND kind = 'g'")
    padded = ["\x02" * 3 + v + "\x03" for v in values]
    want = {p[i:i + 4] for p in padded for i in range(len(p) - 3)}
    assert {r["slot"] for r in got.collect()} == {langid._slot(g) for g in want} and got.count() == len(want)


# --- toxicity ---

def test_toxicity_is_learned_and_labels_stay_apart(spark):
    r = random.Random(8)
    rows, labels = [], []
    for i in range(1200):
        bad = i % 5 == 0
        ws = prose(i, 40).replace("w", "q").split()
        ws = [re.sub(r"\d", lambda m: "abcdefghij"[int(m.group())], w) for w in ws]
        if bad:
            ws[r.randrange(40)] = r.choice(["vile", "nasty", "awful"])
        rows.append((i, " ".join(ws), "en", "s", 1))
        labels.append((i, int(bad)))
    rows += [(5000, None, "en", "s", 1), (5001, "", "en", "s", 1), (None, "Vile", "en", "s", 1)]
    marks = frame(spark, labels + [(None, 1), (1, None)], "doc_id BIGINT, toxic INT")
    docs = frame(spark, rows)
    model = toxicity.train(docs, marks)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(1200) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] == (i in set(held)) for i in range(1200))
    assert np.mean([got[i]["predicted"] == (i % 5 == 0) for i in held]) > 0.98
    assert got[5000]["score"] == got[5001]["score"] and 0 <= got[5000]["score"] <= 1 and len(model[0]) <= 1 << 20
    flipped = toxicity.train(docs, frame(spark, [(i, 1 - y if i in set(held) else y) for i, y in labels], "doc_id BIGINT, toxic INT"))
    assert np.array_equal(flipped[0], model[0]) and np.allclose(flipped[1], model[1])
    none = toxicity.train(docs, marks.limit(0))
    assert toxicity.score(docs, none).first()["score"] == 0.5


def test_ftrl_equals_the_plain_updates():
    r = np.random.default_rng(5)
    rows = [np.append(np.unique(r.choice(50, size=r.integers(1, 9))), toxicity._SIZE).astype("int32") for _ in range(300)]
    labels = np.array([float(3 in row or 7 in row) for row in rows])
    z, n, order = collections.defaultdict(float), collections.defaultdict(float), np.random.default_rng(7)
    weight = lambda j: 0.0 if abs(z[j]) <= toxicity.L1 else (
        (toxicity.L1 if z[j] > 0 else -toxicity.L1) - z[j]) / ((toxicity.BETA + n[j] ** 0.5) / toxicity.ALPHA + toxicity.L2)
    for _ in range(toxicity.EPOCHS):
        for i in order.permutation(len(rows)):
            w = {j: weight(j) for j in rows[i].tolist()}
            g = 1 / (1 + np.exp(-sum(w.values()))) - labels[i]
            for j, v in w.items():
                z[j] += g - ((n[j] + g * g) ** 0.5 - n[j] ** 0.5) / toxicity.ALPHA * v
                n[j] += g * g
    got = toxicity.fit_shard(rows, labels)
    assert np.allclose([got[j] for j in sorted(z)], [weight(j) for j in sorted(z)], atol=1e-9)
    assert 0 < np.count_nonzero(got) < len(z) and not got[[j for j in range(100, 200)]].any()


def test_shards_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD_BYTES", 20_000)
    key, other = [k for k in range(20) if zlib.crc32(str(k).encode()) % 4 != 2][:2]
    rows = [(key, f"{'vile' if i % 2 else 'kind'} {prose(i, 100, 30)}", "en", "s", 1) for i in range(200)]  # one key holds all rows
    docs, marks = frame(spark, rows), frame(spark, [(key, 1)], "doc_id BIGINT, toxic INT")
    model = toxicity.train(docs, marks)
    assert len(model[0]) and toxicity.score(docs, model).where("score > 0.3").count() == 200
    assert not len(toxicity.train(docs, frame(spark, [(other, 1)], "doc_id BIGINT, toxic INT"))[0])


# --- token records ---

def test_token_files_round_trip(spark, tmp_path, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    monkeypatch.setattr(records, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(records, "RANGE_BYTES", 20_000)
    name = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(name)
    values = [prose(i, 80) for i in range(60)] + [None, "", "Ünï cödé 你好\n\n  x", "a<|endoftext|>b", "t\x1cab \x85 y", "it's  2024!", "w " * 20000]
    path = str(tmp_path / "tokens")
    records.write(texts(spark, values, [None, *range(1, len(values))]), path, name, public_tokenizers.PATTERN)
    got = sorted(records.index(spark, path).collect(), key=lambda r: r["start"])
    at = 0
    for r, (i, t) in zip(got, enumerate(values), strict=True):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        assert (r["key"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i or None, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        at += len(ids)
    one = records.read(spark, path).where("key = 5").first()
    assert np.frombuffer(one["ids"], dtype="<u4").tolist() == tok.encode(values[5], add_special_tokens=False).ids + [0]


def test_new_pieces_are_encoded_together_and_forgotten(monkeypatch):
    import public_tokenizers
    monkeypatch.setattr(records, "CACHE", 200)
    monkeypatch.setattr(records, "GROUP", 300)
    monkeypatch.setattr(records, "JOINED", 7)
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, rng = records._tokenizer(path), np.random.default_rng(5)
    parts = [*" \t\n\r\x0b\x00az09'.,!_-\xaa\xb5\xba\xd7\xdf\xe9\xff\u0149\u017f\u0180\xb2\xbd\u0663\u2019\u2014\u2026\u4e2d\U0001f600\u200b\u3000\xa0\x7f\x85\x1c\u0301",
             "'ll", " the", " words", "  ", "<|endoftext|>", "q" * 70, " repeated"]
    values = ["".join(rng.choice(parts, rng.integers(0, 30))) for _ in range(600)]
    calls = []
    made = records._pieces_encoder(tok, "<u2")
    monkeypatch.setattr(records, "_pieces_encoder", lambda *_: lambda pieces: calls.append(list(pieces)) or made(pieces))
    encode, kind = records._encoder(path, public_tokenizers.PATTERN)
    assert [np.frombuffer(g, kind).tolist() for g in encode(values)] == [tok.encode(v, add_special_tokens=False).ids for v in values]
    assert max(map(len, calls)) > 1 and all(len(set(c)) == len(c) for c in calls)
    assert sum(c.count(" repeated") for c in calls) < len(calls) / 4  # what comes again outlives the others


def test_records_of_a_large_vocabulary(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers
    tok = Tokenizer(models.WordLevel({"[end]": 0, **{f"w{i}": i for i in range(1, 70_001)}}, unk_token="[end]"))
    tok.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    tok.save(str(tmp_path / "wide.json"))
    values = ["w70000 w5", "w1", None, "w65536 w65535 w69999"]
    records.write(texts(spark, values), str(tmp_path / "t"), str(tmp_path / "wide.json"))
    got = {r["key"]: np.frombuffer(r["ids"], "<u4").tolist() for r in records.read(spark, str(tmp_path / "t")).collect()}
    assert got == {0: [70000, 5, 0], 1: [1, 0], 2: [0], 3: [65536, 65535, 69999, 0]}
    assert [(r["start"], r["n_tokens"]) for r in records.index(spark, str(tmp_path / "t")).orderBy("key").collect()] == [(0, 3), (3, 2), (5, 1), (6, 4)]


def test_records_are_fetched_through_the_index(spark, tmp_path, monkeypatch):
    import public_tokenizers
    monkeypatch.setattr(records, "CHUNK_BYTES", 2000)
    path, values = str(tmp_path / "t"), [prose(i, 60) for i in range(50)]
    records.write(texts(spark, values), path, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    stored = records.write_index(spark, path)
    assert stored.count() == 50 and stored.select("file").distinct().count() > 3
    whole = {r["key"]: bytes(r["ids"]) for r in records.read(spark, path).collect()}
    order = random.Random(4).choices(range(50), k=80)
    place = spark.createDataFrame(list(enumerate(order)), "place BIGINT, key BIGINT")
    got = sorted(records.fetch(spark, path, place.join(stored.select("key", "file", "offset"), "key")).collect(), key=lambda r: r["place"])
    assert [r["key"] for r in got] == order and all(bytes(r["ids"]) == whole[r["key"]] and 4 * r["n_tokens"] == len(r["ids"]) for r in got)
    one, again, two = ([r["key"] for r in records.shuffled(spark, path, seed).collect()] for seed in (1, 1, 2))
    assert sorted(one) == list(range(50)) and one == again and one != two


def test_damaged_records_are_refused():
    data = records.frame(b"\0" * 9 + b"ab") + records.frame(b"\0" * 9)
    assert [len(b) for _, b in records.frames(data)] == [11, 9]
    for at in (3, 10, 15, len(data) - 1):
        with pytest.raises(ValueError):
            list(records.frames(data[:at] + bytes([data[at] ^ 1]) + data[at + 1:]))
    with pytest.raises(ValueError):
        list(records.frames(data[:-3]))


def test_tokens_of_an_empty_table(spark, tmp_path):
    import public_tokenizers
    records.write(texts(spark, []), str(tmp_path / "t"), public_tokenizers.path("byte_bpe_50k.json"))
    assert records.index(spark, str(tmp_path / "t")).count() == 0


# --- personal data ---

def brute_spans(t):
    t, out = t or "", []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m.group() if c.isdigit()]
        if 16 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


def test_base_spans_equal_brute_force(spark):
    r = random.Random(2)
    parts = ["4598495729440943", "4111 1111-1111 1111", "a.b@c.de", "x@y.z_w@q.com", "a@b", "1.2.3.4", "256.1.1.1", "001.02.3.255", "1.2.3.4.5.6.7.8", "+1 (527) 555-9774",
             "+12", "@", "😀", "é", " ", "\n", "+", ".", "-", "word", "0", "+1-(2)", "a@b.c@d.e", "99999999999.1.1.1", "_", "%"]
    values = ["".join(r.choice(parts) for _ in range(r.randrange(1, 12))) for _ in range(400)]
    values += [None, "", "1" * 30000, "a" * 30000, "1 " * 9000, "a@" + "b." * 9000 + "c", "+1" + "(" * 9000, "1.2" * 5000]
    got = {r["doc_id"]: r for r in extract(texts(spark, values)).collect()}
    for i, t in enumerate(values):
        base = brute_spans(t)
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert got[i]["base_sha256"] == hashlib.sha256(line.encode()).hexdigest(), (i, t and t[:80])
        assert [got[i][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(k == x for x, _, _ in base) for k in ("email", "ip", "card", "phone")]
        assert got[i]["spans"].startswith(line)


def test_contexts_discover_identifiers(spark):
    values = [f"see also contact: user{i}@mail.com thanks" for i in range(40)] + ["see also contact: user77(at)mail", "see also contact: jd4711x", "other words jd9999x"]
    got = extract(texts(spark, values, [None, *range(1, 43)])).collect()
    found = {r["doc_id"]: r["contexts"] for r in got if r["contexts"]}
    assert set(found) == {40, 41} and [(c["start"], c["end"]) for c in found[41]] == [(18, 25)]
    assert extract(texts(spark, [])).count() == 0


def test_whole_spans_are_seeds(spark):
    phones = [f"please dial: +1 (017) 555-77{i:02d} now" for i in range(10, 20)] + ["please dial: x5557713 now"]
    cards = [f"paid by card# {c} ok" for c in ("4111 1111 1111 1111", "5500 0000 0000 0004", "4012 8888 8888 1881", "5555 5555 5555 4444", "5105 1051 0510 5100")]
    emails = [f"write to mail> {'abcdefgh'[i]}.doe@example.com soon" for i in range(8)]
    values = [*phones, *cards, "paid by card# 4111x1111y ok", *emails, "write to mail> jd4711(at)x soon"]
    got = {r["doc_id"]: [values[r["doc_id"]][c["start"]:c["end"]] for c in r["contexts"]] for r in extract(texts(spark, values)).collect()}
    assert {i: c for i, c in got.items() if c} == {10: ["x5557713"], 16: ["4111x1111y"], 25: ["jd4711"]}


def test_bootstrapping_goes_on_until_nothing_changes(spark):
    known, values = [f"user{i}@mail.com" for i in range(5)], []
    for level in "abcde":
        new = [f"id{level}{j}999" for j in "vwxyz"]
        values += [f"step{level} way{t[3]}: {x} end" for t in new for x in [*known, t]]
        known = new
    found = {values[r["doc_id"]][c["start"]:c["end"]] for r in extract(texts(spark, values)).collect() for c in r["contexts"]}
    assert found == {f"id{level}{j}999" for level in "abcde" for j in "vwxyz"}


# --- nearest neighbours ---

def test_neighbours_reach_the_recall(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(3000, 16)).astype("float32")
    x[100:400] = x[100]
    rows = [(i, [float(v) for v in x[i]]) for i in range(3000)]
    rows += [(5000, None), (5020, [0.0] * 16), (5040, [float("nan")] * 16), (5060, [None] + [1.0] * 15), (5080, [float("inf")] * 16), (None, [1.0] * 16)]
    got = search(spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>"), k=20, every=20, sample=1500).toPandas()
    assert sorted(got["query_id"].unique()) == list(range(0, 3000, 20))
    d, hit = x.astype("float64"), 0
    for q, own in got.groupby("query_id"):
        own = own.sort_values("rank")
        s = (d[q] * d).sum(axis=1)
        assert own["rank"].tolist() == list(range(1, 21)) and np.allclose(own["score"], s[own["vec_id"]], rtol=0, atol=1e-12)
        order = np.lexsort((np.arange(3000), -s))
        want = [v for v in order if v != q][:20]
        hit += len(set(want) & set(own["vec_id"]))
        if 100 <= q < 400:
            assert own["vec_id"].tolist() == want
    assert hit >= 0.9 * 20 * 150


def test_repeated_ids_have_whole_lists(spark):
    x = np.random.default_rng(9).normal(size=(61, 8))
    rows = [(i, x[i].tolist()) for i in range(60)] + [(20, x[20].tolist()), (20, x[60].tolist()), (31, x[31].tolist())]
    got = search(spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>"), k=5).collect()
    lists = collections.defaultdict(list)
    for i, v in {(i, tuple(v)) for i, v in rows}:
        if i % 20 == 0:
            near = sorted((-float((np.array(v) * np.array(w)).sum()), j) for j, w in {(j, tuple(w)) for j, w in rows} if j != i)[:5]
            lists[i].append([j for _, j in near])
    want = collections.Counter((i, k + 1, j) for i, own in lists.items() for own_list in own for k, j in enumerate(own_list))
    assert collections.Counter((r["query_id"], r["rank"], r["vec_id"]) for r in got) == want and len(lists[20]) == 2


def test_few_and_no_vectors(spark):
    some = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [0.5, 1.0])], "vec_id BIGINT, embedding ARRAY<FLOAT>")
    assert [(r["rank"], r["vec_id"]) for r in search(some).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert search(some.limit(0)).count() == 0


def test_short_lists_are_filled_from_other_partitions(spark, monkeypatch):
    fit = ann.fit
    monkeypatch.setattr(ann, "fit", lambda x, parts, k: (fit(x, parts, k)[0], 0.01))
    x = np.random.default_rng(4).normal(size=(640, 8))
    x[:300] = x[0] + x[:300] * 0.01
    got = search(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id BIGINT, embedding ARRAY<DOUBLE>")).toPandas()
    assert {q: sorted(own["rank"]) for q, own in got.groupby("query_id")} == {q: list(range(1, 21)) for q in range(0, 640, 20)}
    assert not got.duplicated(["query_id", "vec_id"]).any() and (got["query_id"] != got["vec_id"]).all()
