"""Cells: clips, zonal statistics, quantiles, grids, patches, membership, files."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from terracell.functions.windows import Grid
from terracell.operators import legend as lg
from terracell.operators import clip, fingerprint, grid, joins, membership as mb, patches as pt, quantiles, zonal as zs
from terracell.sources import cells as cs, manifest


def raster(spark, rows, cols, fn, missing=()):
    data = [(r * cols + c, r, c, *fn(r, c)) for r in range(rows) for c in range(cols) if (r, c) not in missing]
    return spark.createDataFrame(data, "cell_id BIGINT, row BIGINT, col BIGINT, value DOUBLE, class STRING"), data


def test_lookup_join_is_the_same_when_salted(spark):
    rng = random.Random(1)
    facts = spark.createDataFrame([(0 if i % 3 else rng.randint(0, 9), i) for i in range(600)], "k INT, v INT")
    lookup = spark.createDataFrame([(k, k * 10) for k in range(0, 8)], "k INT, w INT")
    for how in ("inner", "left", "left_semi", "left_anti"):
        a, b = (sorted(joins.lookup_join(facts, lookup, ["k"], how, limit=n).collect()) for n in (100_000, 0)) if how != "left" else (
            sorted(joins.lookup_join(facts, lookup, ["k"], how, limit=n).fillna(-1).collect()) for n in (100_000, 0))
        assert a == b == sorted(facts.join(lookup, "k", how).fillna(-1).collect())
    extra = F.col("v") > F.col("w")
    a, b = (sorted(joins.lookup_join(facts, lookup, ["k"], extra=extra, limit=n).collect()) for n in (100_000, 0))
    assert a == b and len(a) == facts.join(lookup, "k").where("v > w").count()


def test_lookups_are_measured_in_bytes(spark):
    df = spark.createDataFrame([("ab", 1, [1.0, 2.0]), (None, 2, None)], "s STRING, i INT, a ARRAY<DOUBLE>")
    assert joins.held_bytes(df) >= 2 + 2 * 4 and joins.held_bytes(df.limit(0)) == 0
    long = df.withColumn("s", F.repeat(F.lit("x"), 100_000))
    assert joins.held_bytes(long) - joins.held_bytes(df) >= 199_000


@pytest.mark.parametrize("target", [100_000, 300, 5])
def test_grouped_quantiles_match_numpy(spark, target, monkeypatch):
    monkeypatch.setattr(quantiles, "TARGET", target)
    rng = np.random.default_rng(3)
    groups = {
        "hot": rng.normal(size=20000), "ties": rng.integers(0, 3, 500).astype(float), "one": np.array([4.2]),
        "two": np.array([1.0, 2.0]), "skew": np.exp(rng.normal(size=3000) * 4),
    }
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("hot", None), ("two", float("nan")), (None, 1.0)]
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE")
    probs = {"q0": 0.0, "q13": 0.13, "q50": 0.5, "q999": 0.999, "q100": 1.0}
    got = {r.g: r for r in quantiles.grouped_quantiles(df, ["g"], "v", probs).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(np.quantile(vs, p), rel=1e-12, abs=1e-12), (g, name)


def test_a_wrong_sketch_changes_no_quantile(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "TARGET", 50)
    monkeypatch.setattr(quantiles, "_sketch", lambda c: F.array(*[F.max(c)] * (quantiles.STEPS - 1)))
    df = spark.range(1000).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v"))
    got = quantiles.grouped_quantiles(df, ["g"], "v", {"a": 0.25, "b": 0.999}).first()
    assert (got["a"], got["b"]) == (249.75, pytest.approx(998.001))


def test_zonal_statistics(spark):
    df = spark.createDataFrame([("a", 1.0, "x"), ("a", 3.0, "y"), ("a", None, None), ("b", 5.0, "x")], "uid STRING, value DOUBLE, class STRING")
    row = zs.zonal_stats(df, ["uid"]).where("uid = 'a'").first()
    assert (row.n, row.mean, row["std"], row["min"], row["max"]) == (2, 2.0, 1.0, 1.0, 3.0)
    with pytest.raises(ValueError):
        zs.zonal_stats(df, ["uid"], ["mode"])
    cover = {(r.uid, r["class"]): r.pct for r in zs.class_cover(df, ["uid"]).collect()}
    assert cover == {("a", "x"): 0.5, ("a", "y"): 0.5, ("b", "x"): 1.0}
    long = zs.to_long(zs.zonal_stats(df, ["uid"]), "uid", F.lit("s"), F.lit("v"), ["mean", "std"])
    assert long.count() == 4 and zs.to_wide(long, ["mean", "std"]).where("region_uid = 'b'").first()["mean"] == 5.0
    assert zs.counts(df, ["uid"]).where("uid = 'a'").first().valid_share == pytest.approx(2 / 3)


def test_class_summary_gives_the_same_statistics(spark):
    rng = np.random.default_rng(1)
    rows = [("ab"[int(v) % 2], None if i % 9 == 0 else float(v) + 1e6, None if i % 7 == 0 else "xyz"[i % 3]) for i, v in enumerate(rng.normal(size=400) * 5)]
    df = spark.createDataFrame(rows + [("none", None, "x")], "uid STRING, value DOUBLE, class STRING")
    summary = zs.class_summary(df, ["uid"])
    a = {r.uid: r for r in zs.zonal_stats(df, ["uid"]).collect()}
    b = {r.uid: r for r in zs.stats_from_classes(summary, ["uid"]).collect()}
    assert set(a) == set(b) == {"a", "b", "none"}
    for uid in a:
        for name in ("n", "mean", "std", "min", "max"):
            assert b[uid][name] == (None if a[uid][name] is None else pytest.approx(a[uid][name], rel=1e-9))
    pct = lambda t: sorted((r.uid, r["class"], r.n, round(r.pct, 12)) for r in t.collect())
    assert pct(zs.cover_from_classes(summary, ["uid"])) == pct(zs.class_cover(df, ["uid"]))


def test_boundless_clip_fills_outside(spark):
    df, _ = raster(spark, 4, 4, lambda r, c: (float(r * 4 + c), "k"))
    win = spark.createDataFrame([((2, 2, 5, 4),)], "win STRUCT<col_off: BIGINT, row_off: BIGINT, width: BIGINT, height: BIGINT>")
    out = {(r.row, r.col): r.value for r in clip.boundless_clip(df.select("row", "col", "value"), win, -9.0).collect()}
    assert len(out) == 20 and out[(3, 3)] == 15.0 and out[(5, 6)] == -9.0
    two = df.select(F.lit("t").alias("var"), "row", "col", "value").unionByName(
        df.select(F.lit("p").alias("var"), "row", "col", "value"))
    keyed = clip.boundless_clip(two, win, None, ["var"])
    assert keyed.count() == 40 and keyed.where("value = 0").count() == 32
    outside = win.select(F.struct(F.lit(50).alias("col_off"), F.lit(50).alias("row_off"), F.lit(2).alias("width"), F.lit(2).alias("height")).alias("win"))
    assert [r.value for r in clip.boundless_clip(df.select("row", "col", "value"), outside, None).collect()] == [0.0] * 4


@pytest.mark.parametrize("nodata, kept", [(-1.0, {"b"}), (float("nan"), {"a", "b"}), (None, {"a", "b", "c"})])
def test_windows_of_nodata_are_dropped(spark, nodata, kept):
    rows = [("a", -1.0), ("a", -1.0), ("b", -1.0), ("b", 2.0), ("c", float("nan")), ("c", float("nan"))]
    df = spark.createDataFrame(rows, "var STRING, value DOUBLE")
    got = {r["var"] for r in clip.drop_empty_windows(df, ["var"], F.lit(nodata).cast("double")).collect()}
    assert got == (kept | {"c"} if nodata == -1.0 else kept)


def test_clipped_meta(spark):
    meta = spark.createDataFrame([("s", "v", 2000, "01", "EPSG:4326", -180.0, 90.0, 0.5, -0.5, 720, 360, None)],
                                 "source STRING, var STRING, year INT, month STRING, crs STRING, x0 DOUBLE, y0 DOUBLE, dx DOUBLE, dy DOUBLE, width BIGINT, height BIGINT, nodata DOUBLE")
    box = F.struct(F.lit(-100.0).alias("xmin"), F.lit(30.0).alias("ymin"), F.lit(-98.9).alias("xmax"), F.lit(31.0).alias("ymax"))
    r = clip.clipped_meta(meta, box).first()
    assert (r.x0, r.y0, r.width, r.height) == (-100.0, 31.0, 3, 2)


def test_align_means_and_majorities(spark):
    df, data = raster(spark, 6, 6, lambda r, c: (float(r + c), "ab"[(r * c) % 2]))
    src, dst = Grid(0, 0, 1, 1, 6, 6), Grid(0, 0, 2, 3, 3, 2)
    got = {(r.row, r.col): (r.mean, r.majority) for r in grid.onto_grid(df, src, dst, cls="class").collect()}
    for (tr, tc), (mean, majority) in got.items():
        mine = [d for d in data if d[1] // 3 == tr and d[2] // 2 == tc]
        votes = sorted(((-sum(d[4] == k for d in mine)), k) for k in "ab")
        assert mean == pytest.approx(np.mean([d[3] for d in mine])) and majority == votes[0][1]
    assert len(got) == 6


def test_neighbourhood_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(grid, "TILE", 4)
    rng = random.Random(8)
    holes = {(rng.randrange(13), rng.randrange(11)) for _ in range(30)}
    df, data = raster(spark, 13, 11, lambda r, c: (rng.random(), "k"), holes)
    g = Grid(0, 0, 0.5, 0.8)
    got = {(r.row, r.col): (r.n_near, r.near_mean) for r in grid.neighbourhood_mean(df, g, 1.75).collect()}
    assert len(got) == len(data)
    for _, r, c, v, _k in data:
        near = [d[3] for d in data if ((d[1] - r) * 0.8) ** 2 + ((d[2] - c) * 0.5) ** 2 <= 1.75**2]
        assert got[(r, c)][0] == len(near) and got[(r, c)][1] == pytest.approx(np.mean(near))


def test_edge_density_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(grid, "TILE", 3)
    rng = random.Random(4)
    holes = {(rng.randrange(10), rng.randrange(10)) for _ in range(12)}
    df, data = raster(spark, 10, 10, lambda r, c: (0.0, rng.choice("ab")), holes)
    at = {(d[1], d[2]): d[4] for d in data}
    pairs = [(k, at[q]) for (r, c), k in at.items() for q in ((r, c + 1), (r + 1, c)) if q in at]
    row = grid.edge_density(df, "class").first()
    assert (row.n_pairs, row.n_unlike) == (len(pairs), sum(a != b for a, b in pairs))


def flood(data):
    at = {(d[1], d[2]): (d[0], d[4]) for d in data}
    label = {}
    for p in sorted(at, key=lambda q: at[q][0]):
        if p in label:
            continue
        stack, label[p] = [p], at[p][0]
        while stack:
            r, c = stack.pop()
            for q in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)):
                if q in at and q not in label and at[q][1] == at[p][1]:
                    label[q] = at[p][0]
                    stack.append(q)
    return {at[p][0]: v for p, v in label.items()}


@pytest.mark.parametrize("classes", ["ab", "a", "abcd"])
def test_patches_match_flood_fill(spark, classes):
    rng = random.Random(len(classes))
    holes = {(rng.randrange(17), rng.randrange(15)) for _ in range(60)}
    df, data = raster(spark, 17, 15, lambda r, c: (0.0, rng.choice(classes)), holes)
    got = {r.cell_id: r.patch for r in pt.patches(df, "class", tile=4).collect()}
    assert got == flood(data)


def test_patches_keep_rasters_apart(spark):
    rows = [(i, "t" if i < 4 else "p", 0, i % 4, 1) for i in range(8)]
    df = spark.createDataFrame(rows, "cell_id BIGINT, var STRING, row BIGINT, col BIGINT, kind INT")
    got = pt.patches(df, "kind", ["var"], tile=2)
    assert {(r["var"], r.patch) for r in got.collect()} == {("t", 0), ("p", 4)}
    assert dict(got.dtypes)["kind"] == "int"


def test_merge_labels_on_a_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 300)] + [(3, 7), (500, 400), (400, 500)]
    df = spark.createDataFrame(links, "u BIGINT, v BIGINT")
    got = {r.node: r.root for r in pt.merge_labels(df).collect()}
    assert all(got[i] == 100 for i in range(101, 161)) and all(got[i] == 3 for i in range(200, 300))
    assert got[500] == 400 and got[7] == 3


def test_links_of_a_hub_stay_spread(spark, monkeypatch):
    monkeypatch.setattr(pt, "HUB", 500)
    n = 40_000
    links = spark.range(1, n + 1, 1, 8).select(F.lit(0).cast("long").alias("u"), F.col("id").alias("v")).unionByName(
        spark.range(n + 1, n + 900).select("id", (F.col("id") + 1).alias("v")).toDF("u", "v"))
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        links = pt.materialize(links, "links")
        star = pt._star(links, larger=True)
        sizes = [r[0] for r in star.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert max(sizes) < 2 * sum(sizes) / len(sizes)
        got = pt.merge_labels(links).groupBy("root").count().collect()
        assert {r["root"]: r["count"] for r in got} == {0: n, n + 1: 899}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("block", [None, 0.5, 64.0])
def test_membership_is_a_softmax(spark, block):
    centres = [("a", 0.0, 0.0), ("b", 1.0, 0.0), ("c", 0.0, 2.0), ("d", 40.0, 40.0), ("e", 1.0, 1.0)]
    pts = spark.createDataFrame([(1, 0.2, 0.1), (2, 39.0, 41.0), (3, None, 1.0)], "id INT, x DOUBLE, y DOUBLE")
    regions = spark.createDataFrame(centres, "code STRING, cx DOUBLE, cy DOUBLE")
    for r in mb.soft_membership(pts, regions, block=block).select("*", mb.best_member(F.col("membership")).alias("best")).collect():
        if r.id == 3:
            assert not r.membership
            continue
        w = {c: math.exp(-((r.x - cx) ** 2 + (r.y - cy) ** 2)) for c, cx, cy in centres}
        got = {m.code: m.p for m in r.membership}
        assert sorted(got) == [m.code for m in r.membership] and sum(w[c] for c in set(w) - set(got)) < 2 ** -53 * max(w.values())
        assert got == pytest.approx({c: w[c] / sum(w.values()) for c in got}, rel=1e-12)
        assert r.best.code == {1: "a", 2: "d"}[r.id]
    assert mb.soft_membership(pts.limit(0), regions).count() == 0


def test_membership_among_many_regions(spark):
    rng = np.random.default_rng(6)
    xy = np.concatenate([rng.uniform(0, 400, size=(99_000, 2)), rng.normal(size=(999, 2)) * 0.5 + 2000, [[-5000.0, 9000.0]]])
    regions = spark.createDataFrame(pd.DataFrame({"code": [f"r{i:06d}" for i in range(len(xy))], "cx": xy[:, 0], "cy": xy[:, 1]}))
    at = np.concatenate([rng.uniform(-20, 420, size=(80, 2)), rng.normal(size=(10, 2)) + 2000, [[1000.0, 1000.0], [-4000.0, 9000.0]]])
    pts = spark.createDataFrame(pd.DataFrame({"id": range(len(at)), "x": at[:, 0], "y": at[:, 1]}))
    got = mb.soft_membership(pts, regions, block=8.0).collect()
    assert len(got) == len(at)
    for r in got:
        d = ((xy - at[r.id]) ** 2).sum(1)
        w = np.exp(d.min() - d)
        p = {int(m.code[1:]): m.p for m in r.membership}
        assert set(np.flatnonzero(w > 1e-15)) <= set(p) and len(p) < 5000
        assert all(v == pytest.approx(w[i] / w.sum(), rel=1e-9) for i, v in p.items())


def cell_rows(spark, source, var, year, n, value):
    return spark.range(n).select(
        F.lit(source).alias("source"), F.lit(var).alias("var"), F.lit(year).alias("year"), F.lit("01").alias("month"),
        F.lit(1).alias("band"), F.floor(F.col("id") / 40).alias("row"), (F.col("id") % 40).alias("col"),
        F.lit(float(value)).alias("value"),
    )


def test_cell_tables_prune_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "cells")
    cs.write_cells(cell_rows(spark, "s", "tas", 2000, 1600, 1), path)
    cs.write_cells(cell_rows(spark, "s", "tas", 2001, 1600, 1), path)
    cs.write_cells(cell_rows(spark, "s", "tas", 2001, 800, 5), path, overwrite=True)
    years = {r.year: (r.n, r.v) for r in cs.read_cells(spark, path).groupBy("year").agg(F.count("*").alias("n"), F.max("value").alias("v")).collect()}
    assert years == {2000: (1600, 1.0), 2001: (800, 5.0)}
    part = cs.read_cells(spark, path, source="s", var="tas", years=(2000, 2000), rows=(5, 9), cols=(0, 3))
    assert part.count() == 20
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan and "GreaterThanOrEqual(row,5)" in plan


def test_region_clip_files(spark, tmp_path):
    df = cell_rows(spark, "s", "tas", 2000, 80, 1).withColumn("region_uid", F.when(F.col("row") == 0, "a").otherwise("b"))
    cs.write_region_clips(df, str(tmp_path / "clips"))
    assert spark.read.parquet(str(tmp_path / "clips" / "source=s" / "region_uid=a")).count() == 40


def test_audit_of_real_files(spark, tmp_path):
    for name in ["raw/g/a.7z", "raw/g/b.7z", "raw/g/sub/c.7z", "raw/n/x/y.zip"] + [f"raw/m/f{i}.tif" for i in range(7)]:
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"x" * 3)
    files = manifest.list_files(spark, str(tmp_path))
    assert files.agg(F.sum("length")).first()[0] == 33
    src = spark.createDataFrame([
        ("g", "raw/g/*.7z", "raw/none"), ("deep", "raw/**/*.7z", None), ("n", " ", "raw/n/"), ("m", None, "raw/m"),
        ("gone", None, "raw/zzz"), ("miss", "raw/g/*.tif", None), ("free", None, None),
    ], "source STRING, local_glob STRING, cache_dir STRING")
    got = {r.source: r for r in manifest.audit_sources(src, files, root=str(tmp_path)).collect()}
    assert got["g"]["count"] == 2 and got["g"]["sample"] == ["raw/g/a.7z", "raw/g/b.7z"]
    assert got["deep"]["count"] == 3 and got["n"]["count"] == 1
    assert got["m"]["count"] == 7 and got["m"]["sample"] == [f"raw/m/f{i}.tif" for i in range(5)]
    assert (got["gone"].ok, got["gone"].status) == (False, "missing") and not got["miss"].ok
    assert (got["free"].ok, got["free"].status, got["free"]["count"]) == (True, "unchecked", None)
    asked = spark.createDataFrame([("g",), ("what",)], "source STRING")
    some = manifest.audit_sources(src, files, asked, str(tmp_path))
    assert {r.source: r.reason for r in some.collect()} == {"g": None, "what": "unknown source"}
    assert tuple(manifest.overall(some).first()) == (False, 2)
    assert tuple(manifest.overall(some.where("source = 'g'")).first()) == (True, 0)
    assert '"count":2' in manifest.as_json(some).where("source = 'g'").first()["json"]


def test_content_hash_ignores_order_and_partitioning(spark):
    df = spark.range(500).select("id", (F.col("id") / 7).alias("v"), F.when(F.col("id") > 3, "x").alias("s"))
    a = fingerprint.content_hash(df, df.columns).first()
    b = fingerprint.content_hash(df.repartition(7).orderBy(F.desc("id")), df.columns).first()
    c = fingerprint.content_hash(df.withColumn("v", F.col("v") + 1), df.columns).first()
    assert a == b and a != c


def test_a_stored_raster_is_not_doubled(spark, tmp_path):
    path = str(tmp_path / "again")
    cs.write_cells(cell_rows(spark, "s", "tas", 2000, 20, 1), path)
    with pytest.raises(ValueError, match="already holds"):
        cs.write_cells(cell_rows(spark, "s", "tas", 2000, 20, 1), path)
    assert spark.read.parquet(path).count() == 20


def test_clips_of_two_variables_stay(spark, tmp_path):
    path = str(tmp_path / "both")
    for var in ("pr", "tas"):
        cs.write_region_clips(cell_rows(spark, "s", var, 2000, 10, 1).withColumn("region_uid", F.lit("u")), path)
    assert {r["var"] for r in spark.read.parquet(path).select("var").distinct().collect()} == {"pr", "tas"}


def test_legend_names_and_guards(spark):
    cells = spark.createDataFrame([(1, "a"), (2, "b"), (3, "z"), (4, None)], "id INT, class STRING")
    table = spark.createDataFrame([("a", "water"), ("b", "forest"), ("c", "ice")], "class STRING, name STRING")
    assert {r.id: r.class_name for r in lg.class_names(cells, table).collect()} == {1: "water", 2: "forest", 3: "unclassified", 4: None}
    assert [r["class"] for r in lg.unused_classes(cells, table).collect()] == ["c"]
    for bad in ([("a", "x"), ("a", "y")], [("a", None)]):
        with pytest.raises(ValueError, match="'a'"):
            lg.class_names(cells, spark.createDataFrame(bad, "class STRING, name STRING"))


def test_the_manifest_lists_versions_of_stored_rasters(spark, tmp_path):
    path = str(tmp_path / "cells")
    assert cs.read_manifest(spark, path) is None
    cs.write_cells(cell_rows(spark, "s", "tas", 2000, 20, 1), path)
    cs.write_cells(cell_rows(spark, "s", "tas", 2001, 20, 1), path)
    with pytest.raises(ValueError, match="2001"):
        cs.write_cells(cell_rows(spark, "s", "tas", 2001, 20, 1), path)
    cs.write_cells(cell_rows(spark, "s", "tas", 2001, 8, 5), path, overwrite=True)
    listed = [(r["year"], r["month"], r["version"]) for r in cs.read_manifest(spark, path).orderBy("year").collect()]
    assert listed == [(2000, "01", 2), (2001, "01", 2)]
    assert cs.read_cells(spark, path).count() == 28


def test_a_table_without_a_manifest_is_read_once(spark, tmp_path):
    path = str(tmp_path / "cells")
    cell_rows(spark, "s", "tas", 2000, 20, 1).write.partitionBy(*cs.RASTER_KEYS).parquet(path)
    with pytest.raises(ValueError, match="2000"):
        cs.write_cells(cell_rows(spark, "s", "tas", 2000, 20, 1), path)


def test_cells_are_not_moved_to_drop_windows(spark, tmp_path):
    cs.write_cells(cell_rows(spark, "s", "tas", 2000, 100, 1).unionByName(cell_rows(spark, "s", "pr", 2000, 100, -1)), str(tmp_path / "c"))
    cells = cs.read_cells(spark, str(tmp_path / "c"))
    kept = clip.drop_empty_windows(cells, cs.RASTER_KEYS, F.lit(-1.0))
    assert {r["var"] for r in kept.select("var").distinct().collect()} == {"tas"} and kept.count() == 100
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
