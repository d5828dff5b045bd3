"""The corpus pipeline on a small table."""

import hashlib
import math
import random
import zlib
from fractions import Fraction

import corpus_pipeline
from test_text_operators import brute_components, brute_hits
from terracell.llm.common import materialize
from terracell.llm.mixing import mix

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def test_slots_follow_the_mixture(spark):
    rows = [(i, f"text {i}", "en", "a" if i % 3 else "b", 1) for i in range(6000)] + [(None, f"no key {i}", "en", None, 1) for i in range(5)]
    docs = materialize(spark.createDataFrame(rows, SCHEMA))
    place = {r["doc_id"]: r["position"] for r in mix(docs).collect()}
    stages = dict(corpus_pipeline.STAGES)
    got = stages["shard"](spark, materialize(stages["mix"](spark, docs, "")), "").collect()
    assert len(got) == len(rows)
    for shard in range(corpus_pipeline.SHARDS):
        own = sorted((r for r in got if r["shard"] == shard), key=lambda r: r["slot"])
        assert [r["slot"] for r in own] == list(range(len(own)))
        keys = [r["doc_id"] for r in own]
        assert keys == sorted(keys, key=lambda k: -1 if k is None else place[k])


def brute_places(rows):
    """Position of each key: slot after slot, the released block of the earliest deadline."""
    own = {}
    for r in rows:
        own.setdefault("null" if r["source"] is None else f"={r['source']}", []).append(r["doc_id"])
    root = {s: math.isqrt(len(k) * 10**12) for s, k in own.items()}
    todo = {s: sorted(k, key=lambda k: hashlib.md5(str(k).encode()).hexdigest()) for s, k in own.items()}
    done, order, t = dict.fromkeys(own, 0), [], 0
    while any(todo.values()):
        weight = {s: Fraction(root[s], sum(root.values())) for s in own if todo[s]}
        ready = [(math.ceil((done[s] + 1) / w), s) for s, w in weight.items() if math.floor(done[s] / w) <= t]
        if ready:
            s = min(ready)[1]
            order, todo[s], done[s] = order + todo[s][:32], todo[s][32:], done[s] + 1
        t += 1
    return {k: i for i, k in enumerate(order)}


def test_stages_equal_brute_force(spark, tmp_path):
    r = random.Random(8)
    make = lambda letters, n: " ".join("".join(r.choice(letters) for _ in range(r.randrange(3, 8))) for _ in range(n))
    values = [make("abcdefgh" if i % 2 else "ijklmnop", 40) for i in range(300)]
    item = make("abcdefgh", 15)
    values += [values[1] + " abc", values[2].upper(), values[3], values[5] + " " + item, item, None, "", "12 !?"]
    langs = ["x" if (v or "i").lower().strip()[:1] in "abcdefgh" else "y" for v in values]
    rows = [(i, v, langs[i], [None, "s", "s", "t", "u"][i % 5], len(v or ""), i * 0.5, f"p{i}", i) for i, v in enumerate(values)]
    docs = spark.createDataFrame(rows, SCHEMA + ", score DOUBLE, position STRING, Shard INT")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (None, values[7])], "item_id BIGINT, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    found, tables = materialize(docs), {}
    for name, stage in corpus_pipeline.STAGES:
        found = materialize(stage(spark, found, str(tmp_path)), name)
        tables[name] = found.collect()
    for name in ("language_id", "near_duplicates", "decontaminate", "mix"):
        assert all(tuple(r)[:8] == rows[r["doc_id"]] for r in tables[name])
    ids = {name: sorted(r["doc_id"] for r in own) for name, own in tables.items()}
    assert ids["language_id"] == [i for i, v in enumerate(values) if any(c.isalpha() for c in v or "")]
    _, low = brute_components([values[i] for i in ids["language_id"]])
    assert ids["near_duplicates"] == [i for at, i in enumerate(ids["language_id"]) if low[at] in (at, None)]
    hits = brute_hits([(i, values[i]) for i in ids["near_duplicates"]], [(1, item), (None, values[7])])
    assert ids["decontaminate"] == [i for i in ids["near_duplicates"] if not hits[i][-1]] != ids["near_duplicates"]
    place = brute_places(tables["decontaminate"])
    assert {r["doc_id"]: r["mix_position"] for r in tables["mix"]} == place
    shards = {}
    for r in sorted(tables["shard"], key=lambda r: place[r["doc_id"]]):
        text = values[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["slot"]) == (len(text) + 1, zlib.crc32(text), shards.get(r["shard"], 0))
        shards[r["shard"]] = r["slot"] + 1
    assert ids["shard"] == ids["mix"] == ids["decontaminate"]
    assert sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(str, tables["shard"]))


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id BIGINT, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
