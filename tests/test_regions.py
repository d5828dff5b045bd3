"""Region selection, dissolve, zones and the preparation chain."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import ring, square
from terracell import schemas
from terracell.functions.windows import Grid
from terracell import session
from terracell.functions import rings as rg_functions
from terracell.operators import chains, dissolve as ds, nesting, regions as rg, repair as rp, zones
from terracell.operators.chains import rank_chains
from terracell.operators.junctions import split_edges
from terracell.operators.repair import repair_features
from terracell.plans import region_features as rf
from terracell.plans.prep_regions import prepare_regions, store_regions
from terracell.sources import catalog, polygons


def catalog_rows(spark, *rows):
    full = [(f"l3_{c}", s, lv, c, n, None) for s, lv, c, n in rows]
    return spark.createDataFrame(full, schemas.REGION)


def layer(spark, *rows, crs="EPSG:4326"):
    return spark.createDataFrame(
        [(i, c, g, crs) for i, (c, g) in enumerate(rows)],
        f"feature_id BIGINT, US_L3CODE STRING, geom {schemas.GEOM}, crs STRING",
    )


def test_wanted_selection_and_guards(spark):
    regions = catalog_rows(spark, ("EPA_US", "3", "07", "a"), ("EPA_US", None, "8", "b"), ("X", "3", "9", "c"), ("EPA_US", "3", "70", None))
    wanted = rg.wanted_regions(regions, "EPA_US", 3)
    assert sorted(map(tuple, wanted.select("code", "name").collect())) == [("7", "a"), ("70", "")]
    rg.check_wanted(wanted, "EPA_US", 3)
    with pytest.raises(ValueError, match="no regions"):
        rg.check_wanted(rg.wanted_regions(regions, "EPA_US", 4), "EPA_US", 4)
    for codes, text in ((("7", "07"), "repeated"), (("7", " "), "no valid code")):
        bad = rg.wanted_regions(catalog_rows(spark, *[("EPA_US", "3", c, "n") for c in codes]))
        with pytest.raises(ValueError, match=text):
            rg.check_wanted(bad, "EPA_US", 3)


def test_code_field_choice(spark):
    assert rg.pick_code_field(["OBJECTID", "US_L3NAME", "NA_L3CODE", "US_L3CODE"]) == "US_L3CODE"
    assert rg.pick_code_field(["a", "b"], "b") == "b"
    with pytest.raises(ValueError, match="not found"):
        rg.pick_code_field(["a"], "b")
    with pytest.raises(ValueError, match="cannot infer"):
        rg.pick_code_field(["OBJECTID", "NAME"])
    # Known scores.
    names = spark.createDataFrame([("US_L3CODE", 9), ("NA_L3CODE", 7), ("L3_KEY", 4), ("US_L3NAME", 4)], "c STRING, s INT")
    assert names.where(rg.code_field_score(F.col("c")) != F.col("s")).isEmpty()
    ties = spark.createDataFrame([("d", "aL3"), ("d", "bL3")], "dataset STRING, column STRING")
    assert rg.best_code_fields(ties).first()["column"] == "bL3"


def shared(spark):
    """Two unit squares side by side, a copy of one, a square with a hole, another region."""
    holed = [square(10, 0, 4, 4), list(reversed(square(11, 1, 2, 2)))]
    return layer(
        spark, ("07", [square(0, 0)]), ("7", [square(1, 0)]), ("7", [square(1, 0)]), ("70", holed), ("99", [square(50, 50)]),
        ("70", None), ("70", []),
    )


def test_prepare_dissolved(spark):
    regions = catalog_rows(spark, ("EPA_US", "3", "07", "seven"), ("EPA_US", "3", "70", "seventy"))
    got = prepare_regions(regions, shared(spark), crs="EPSG:5070", target_crs="EPSG:5070")
    rows = {r.code: r for r in got.bounds.collect()}
    assert rows["7"].area_km2 == pytest.approx(2e-6) and rows["70"].area_km2 == pytest.approx(12e-6)
    assert (rows["7"].xmin, rows["7"].xmax) == (0, 2)
    assert got.outline.where("uid = 'l3_07'").count() == 6
    assert got.regions.columns == ["uid", "scheme", "level", "code", "name", "area_km2"]


def test_prepare_undissolved_keeps_features(spark):
    regions = catalog_rows(spark, ("EPA_US", "3", "7", "seven"))
    got = prepare_regions(regions, shared(spark), dissolve=False)
    assert got.regions.count() == 3 and got.bounds.count() == 3
    assert got.regions.columns == ["uid", "scheme", "level", "code", "name", "area_km2", "geom"]
    assert got.regions.agg(F.min("area_km2")).first()[0] > 10000  # a degree square near the equator


def test_prepare_reports_lost_codes(spark):
    lost = catalog_rows(spark, ("EPA_US", "3", "7", "a"), ("EPA_US", "3", "12", "b"))
    with pytest.raises(ValueError, match="without a usable feature.*12"):
        prepare_regions(lost, shared(spark))
    empty_only = layer(spark, ("5", []), ("6", [square(0, 0)]))
    with pytest.raises(ValueError, match="no wanted code matched"):
        prepare_regions(catalog_rows(spark, ("EPA_US", "3", "5", "a")), empty_only)


def test_store_and_versions(spark, tmp_path):
    regions = catalog_rows(spark, ("EPA_US", "3", "7", "seven"))
    got = prepare_regions(regions, shared(spark), crs="EPSG:5070", target_crs="EPSG:5070")
    root, bounds, csv = (str(tmp_path / n) for n in ("reg", "bounds", "qa"))
    store_regions(got, root, version="v0", bounds_path=bounds, qa_csv=csv)
    assert polygons.read_regions(spark, root, version="v0").count() == 1
    assert polygons.read_bounds(spark, bounds).columns == ["uid", "code", "name", "xmin", "ymin", "xmax", "ymax", "area_km2"]
    assert spark.read.option("header", True).csv(csv).first()["uid"] == "l3_7"
    with pytest.raises(Exception, match="(?i)already exists"):
        store_regions(got, root, version="v0")
    store_regions(got, root)
    store_regions(got, root)


def test_feature_sources(spark, tmp_path):
    lines = [
        '{"id": 1, "geometry": {"type": "Polygon", "coordinates": [[[0,0],[1,0],[1,1],[0,0]]]}, "properties": {"US_L3CODE": "7"}}',
        '{"id": 2, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0,0],[1,0],[1,1],[0,0]]],[[[5,5],[6,5],[6,6],[5,5]]]]}, "properties": {}}',
    ]
    path = tmp_path / "a.geojsonl"
    path.write_text("\n".join(lines))
    df = polygons.read_features(spark, str(path), "geojsonl")
    assert dict(df.select("feature_id", F.size("geom")).collect()) == {1: 1, 2: 2}
    empty = tmp_path / "none"
    shared(spark).where("false").write.parquet(str(empty))
    with pytest.raises(ValueError, match="no features"):
        polygons.read_features(spark, str(empty))
    bare = tmp_path / "bare"
    layer(spark, ("7", [square(0, 0)]), crs=None).write.parquet(str(bare))
    with pytest.raises(Exception, match="without a CRS"):
        polygons.read_features(spark, str(bare)).select("crs").collect()


def test_catalogs(spark, tmp_path):
    good = tmp_path / "r.json"
    good.write_text('[{"uid": "a", "scheme": "S", "level": 3, "code": "7", "bounds": [1, 2, 3, 4]}, {"uid": "b", "bounds": [0, 0, "x", 1]}]')
    df = catalog.load_regions(spark, str(good), multi_line=True)
    assert df.count() == 2
    assert tuple(catalog.require_aoi(catalog.resolve_aoi(df)).first().bbox) == (1.0, 2.0, 3.0, 4.0)
    assert tuple(catalog.resolve_aoi(df, [9, 9, 10, 10]).first().bbox) == (9.0, 9.0, 10.0, 10.0)
    assert tuple(catalog.resolve_aoi(df, [9, 9, "q", 10]).first().bbox) == (1.0, 2.0, 3.0, 4.0)
    with pytest.raises(Exception, match="no area of interest"):
        catalog.require_aoi(catalog.resolve_aoi(df.where("uid = 'b'"))).collect()
    broken = tmp_path / "bad.json"
    broken.write_text('{"uid": "a", "code": \n{"uid"')
    with pytest.raises(Exception):
        catalog.load_regions(spark, str(broken)).collect()
    void = tmp_path / "void.json"
    void.write_text("[]")
    with pytest.raises(ValueError, match="no catalog entries"):
        catalog.load_regions(spark, str(void), multi_line=True)
    src = tmp_path / "s.json"
    src.write_text('{"source": "c", "vars_active": ["pr"], "vars": {"pr": {"var_units": "mm", "active": true}, "tas": {"active": true}}}')
    v = catalog.source_variables(catalog.load_sources(spark, str(src)))
    assert sorted((r["var"], r.active, r.listed) for r in v.collect()) == [("pr", True, True), ("tas", True, False)]


def follow(edges):
    """Rings by walking the outline, for comparison."""
    nxt = {}
    for x1, y1, x2, y2 in edges:
        nxt.setdefault((x1, y1), []).append((x2, y2))
    count = 0
    while nxt:
        at = start = next(iter(nxt))
        count += 1
        while at in nxt:
            to = nxt[at].pop()
            if not nxt[at]:
                del nxt[at]
            at = to
        assert at == start
    return count


def test_outline_rings_follow_the_outline(spark):
    cells = [(x, y) for x in range(9) for y in range(7) if (x, y) not in ((4, 3), (7, 1))] + [(20, 20)]
    feats = layer(spark, *[("a", [square(x, y)]) for x, y in cells]).withColumnRenamed("US_L3CODE", "uid")
    outline = ds.dissolve_outline(ds.feature_edges(feats, ["uid"]))
    edges = [tuple(r) for r in outline.select("x1", "y1", "x2", "y2").collect()]
    got = ds.outline_rings(outline).collect()
    rings = {}
    for r in got:
        rings.setdefault(r.ring, {})[r.pos] = (r.x, r.y)
    assert len(rings) == follow(edges) == 4
    seen = set()
    for points in rings.values():
        assert sorted(points) == list(range(len(points)))
        seen |= {points[i] + points[(i + 1) % len(points)] for i in points}
    assert seen == set(edges)


def test_touching_corners_split_into_two_rings(spark):
    feats = layer(spark, ("a", [square(0, 0)]), ("a", [square(1, 1)])).withColumnRenamed("US_L3CODE", "uid")
    rings = ds.outline_rings(ds.dissolve_outline(ds.feature_edges(feats, ["uid"])))
    assert sorted(r["count"] for r in rings.groupBy("ring").count().collect()) == [4, 4]


def test_chains_are_ranked_in_any_shape(spark):
    r = random.Random(3)
    links, want, at = [], {}, 0
    for size, closed in [(1, True), (1, False), (2, True), (2, False), (3, True), (40, True), (55, False), (300, True)]:
        ids = r.sample(range(at, at + 10 * size), size)
        at += 10 * size
        links += [("k", a, b) for a, b in zip(ids, ids[1:] + ids[:1])][: size if closed else size - 1] + ([] if closed else [("k", ids[-1], None)])
        start = ids.index(min(ids)) if closed else 0
        want.update({x: (min(ids), (i - start) % size) for i, x in enumerate(ids)})
    got = rank_chains(spark.createDataFrame(links, "k STRING, id BIGINT, nxt BIGINT"), "k").collect()
    assert {x["id"]: (x["ring"], x["pos"]) for x in got} == want and len(got) == len(want)


def test_a_long_ring_stays_spread(spark, monkeypatch):
    n, largest = 4000, []

    def watched(df, stem="stage"):
        out = session.materialize(df, stem)
        if stem in ("chain", "left") and out.count() > 500:
            largest.append(out.groupBy(F.spark_partition_id()).count().agg(F.max("count") / F.sum("count")).first()[0])
        return out

    monkeypatch.setattr(chains, "materialize", watched)
    links = spark.range(n).select(F.lit("k").alias("k"), "id", ((F.col("id") + 1) % n).alias("nxt")).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rank_chains(links, "k")
        assert got.where("id <> pos OR ring <> 0").count() == 0 and got.count() == n
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(largest) < 0.4


def brute_outline(boxes):
    """(area, perimeter) of the union of integer boxes that do not overlap."""
    cells = {(i, j) for x, y, w, h in boxes for i in range(x, x + w) for j in range(y, y + h)}
    return len(cells), sum((i + a, j + b) not in cells for i, j in cells for a, b in ((0, 1), (1, 0), (0, -1), (-1, 0)))


def test_t_junctions_leave_no_inner_edge(spark):
    r, boxes, taken = random.Random(9), [], set()
    for _ in range(600):
        x, y, w, h = r.randrange(40), r.randrange(40), r.choice([1, 1, 2, 7, 30]), r.choice([1, 1, 3, 12])
        own = {(i, j) for i in range(x, x + w) for j in range(y, y + h)}
        if not own & taken:
            taken |= own
            boxes.append((x, y, w, h))
    turn = lambda x, y: (x * 3 - y * 4 + 0.5, x * 4 + y * 3)
    for place, scale, tolerance in ((lambda x, y: (x, y), 1, 0.0), (turn, 5, 0.0), (lambda x, y: (x / 10, y * 0.7), None, 1e-9)):
        geoms = [[ring(*[place(*p) for p in ((x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y))])] for x, y, w, h in boxes]
        feats = layer(spark, *[("a", g) for g in geoms]).withColumnRenamed("US_L3CODE", "uid")
        edges = split_edges(ds.feature_edges(feats, ["uid"]), tolerance=tolerance)
        got = ds.edge_measures(ds.dissolve_outline(edges), ["uid"]).first()
        area, perimeter = brute_outline(boxes)
        if scale:
            assert got["area"] == pytest.approx(area * scale ** 2) and got["perimeter"] == pytest.approx(perimeter * scale)
        else:
            assert got["area"] == pytest.approx(area * 0.07)
        rings = ds.outline_rings(ds.dissolve_outline(edges))
        assert rings.count() == ds.dissolve_outline(edges).count()
    assert split_edges(ds.feature_edges(feats, ["uid"]).limit(0)).count() == 0


def test_many_rings_are_nested_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(nesting, "EDGES_PER_KEY", 64)
    r, rows, want = random.Random(2), [], []
    for i in range(25):
        for j in range(20):
            for depth in range(r.randrange(1, 6)):
                sq = square(i + 0.1 * depth, j + 0.1 * depth, 1 - 0.2 * depth - 0.01, 1 - 0.2 * depth - 0.01)
                rows.append(sq[::-1] if r.random() < 0.5 else sq)
                want.append(depth % 2 == 0)
    big = [square(-1, -1, 40, 40)]  # one ring around all turns every other over
    feats = layer(spark, ("a", rows), ("b", big + rows), ("c", [square(0, 0)]))
    got = {x["US_L3CODE"]: [s > 0 for s in x["s"]] for x in repair_features(feats).select(
        "US_L3CODE", F.transform("geom", rg_functions.signed_area).alias("s")).collect()}
    assert got == {"a": want, "b": [True] + [not w for w in want], "c": [True]}


def inside(x, y, rings):
    odd = False
    for r in rings:
        for a, b in zip(r, r[1:]):
            if (a["y"] > y) != (b["y"] > y) and x < a["x"] + (y - a["y"]) * (b["x"] - a["x"]) / (b["y"] - a["y"]):
                odd = not odd
    return odd


def blob(rng, cx, cy, size, n=11):
    import math

    pts = [
        (cx + size * (0.4 + rng.random()) * math.cos(2 * math.pi * i / n), cy + size * (0.4 + rng.random()) * math.sin(2 * math.pi * i / n))
        for i in range(n)
    ]
    return ring(*pts, pts[0])


@pytest.mark.parametrize("dy", [0.37, -0.37])
def test_zone_labels_match_ray_casting(spark, dy, monkeypatch):
    monkeypatch.setattr(zones, "TILE", 4)
    rng = random.Random(5)
    polys = [(u, [blob(rng, rng.uniform(0, 12), rng.uniform(0, 12), 3)]) for u in "aabbcc"]
    polys.append(("d", [square(1, 1, 8, 8), list(reversed(square(3, 3, 3, 3)))]))
    grid = Grid(x0=-1.0, y0=-1.0 if dy > 0 else 14.0, dx=0.41, dy=dy, width=37, height=41)
    cells = [(r * 37 + c, r, c, float(r)) for r in range(41) for c in range(37)]
    df = spark.createDataFrame(cells, "cell_id BIGINT, row BIGINT, col BIGINT, value DOUBLE")
    feats = layer(spark, *polys).withColumnRenamed("US_L3CODE", "uid")
    got = sorted((r.uid, r.cell_id) for r in rf.label_by_region(df, rp.repair_features(feats), grid).collect())
    want = set()
    for u, g in polys:
        for i, r, c, _ in cells:
            if inside(grid.x0 + (c + 0.5) * grid.dx, grid.y0 + (r + 0.5) * grid.dy, g):
                want.add((u, i))
    assert got == sorted(want)  # a cell in two features of one region counts once


def test_coverage_counts_shared_ground_once(spark):
    feats = layer(spark, ("a", [square(0, 0, 4, 4)]), ("a", [square(2, 2, 4, 4)]), ("b", [square(0, 0, 2, 2)]), ("b", [square(2, 0, 2, 2)]))
    edges = ds.feature_edges(feats.withColumnRenamed("US_L3CODE", "uid"), ["uid"])
    got = {r.uid: (r.n_cells, r.n_overlap) for r in zones.coverage(edges, Grid(0, 0, 1, 1)).collect()}
    assert got == {"a": (28, 4), "b": (8, 0)}


def test_boxes_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(zones, "TILE", 3)
    grid = Grid(x0=0.0, y0=10.0, dx=1.0, dy=-1.0)
    cells = [(r * 10 + c, r, c) for r in range(10) for c in range(10)]
    df = spark.createDataFrame(cells, "cell_id BIGINT, row BIGINT, col BIGINT")
    boxes = [("a", 0.5, 0.5, 3.5, 9.0), ("b", -5.0, -5.0, 50.0, 50.0), ("c", 4.1, 4.1, 4.2, 4.2)]
    b = spark.createDataFrame(boxes, "uid STRING, xmin DOUBLE, ymin DOUBLE, xmax DOUBLE, ymax DOUBLE")
    got = sorted((r.uid, r.cell_id) for r in zones.cells_in_boxes(df, zones.box_tiles(b, grid, ["uid"])).collect())
    want = sorted(
        (u, i) for u, x0, y0, x1, y1 in boxes for i, r, c in cells
        if x0 <= c + 0.5 <= x1 and y0 <= 10 - (r + 0.5) <= y1
    )
    assert got == want


def crosses(g):
    segs = [(a["x"], a["y"], b["x"], b["y"]) for r in g for a, b in zip(r, r[1:])]
    side = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    for i, s in enumerate(segs):
        for t in segs[i + 1:]:
            a, b, c, d = s[:2], s[2:], t[:2], t[2:]
            if side(a, b, c) * side(a, b, d) < 0 and side(c, d, a) * side(c, d, b) < 0:
                return True
    return False


def test_self_crossings_match_brute_force(spark):
    rng = random.Random(2)
    shapes = [[blob(rng, 0, 0, 5, n=rng.randint(4, 30))] for _ in range(15)]
    for _ in range(25):
        pts = [(rng.uniform(0, 9), rng.uniform(0, 9)) for _ in range(rng.randint(3, 6))]
        shapes.append([ring(*pts, pts[0])])
    df = spark.createDataFrame(list(enumerate(shapes)), f"feature_id BIGINT, geom {schemas.GEOM}")
    got = {r.feature_id for r in rp.crossing_features(df).collect()}
    want = {i for i, g in enumerate(shapes) if crosses(g)}
    assert got == want and 0 < len(want) < len(shapes)


def test_the_layer_says_its_crs(spark):
    flat = layer(spark, ("1", [square(0, 0, 1000, 1000)]), ("1", [square(1000, 0, 1000, 1000)]), crs=" epsg:5070 ")
    regions = catalog_rows(spark, ("EPA_US", "3", "1", "a"))
    got = prepare_regions(regions, flat, target_crs="EPSG:5070")
    assert got.regions.first().area_km2 == pytest.approx(2.0)
    mixed = flat.unionByName(layer(spark, ("1", [square(0, 0)])))
    for bad in (mixed, flat.withColumn("crs", F.lit(None).cast("string")), flat.limit(0)):
        with pytest.raises(Exception, match="CRS"):
            prepare_regions(regions, bad)


def test_geojson_attributes_keep_their_names(spark, tmp_path):
    lines = [
        '{"type":"Feature","id":1,"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]},"properties":{"NA_L3CODE":"07","geom":"x","n":3}}',
        '{"type":"Feature","id":2,"geometry":null,"properties":{"NA_L3CODE":"8","crs":"y"},"crs":{"type":"name","properties":{"name":"urn:ogc:def:crs:OGC:1.3:CRS84"}}}',
        '{"type":"Feature","id":3,"geometry":{"type":"Polygon","coordinates":[]},"properties":null}',
    ]
    (tmp_path / "l.geojsonl").write_text("\n".join(lines))
    got = polygons.read_features(spark, str(tmp_path / "l.geojsonl"), "geojsonl", crs="EPSG:5070")
    assert set(got.columns) == {"feature_id", "NA_L3CODE", "crs_", "geom_", "n", "geom", "crs"}
    rows = {r.feature_id: r for r in got.collect()}
    assert (rows[1].NA_L3CODE, rows[1].geom_, rows[1].n, rows[1].crs) == ("07", "x", "3", "EPSG:5070")
    assert (rows[2].crs, rows[2].crs_, rows[2].geom) == ("EPSG:4326", "y", None) and rows[3].NA_L3CODE is None


@pytest.mark.parametrize("dissolve", [True, False])
def test_from_the_registry_to_stored_features(spark, tmp_path, dissolve):
    outer, hole = square(0, 0, 6, 6)[::-1], square(1, 1, 2, 2)[::-1]
    feats = layer(spark, ("7", [outer, hole]), ("8", [square(6, 0, 2, 6)]), crs="EPSG:5070")
    regions = catalog_rows(spark, ("EPA_US", "3", "7", "a"), ("EPA_US", "3", "8", "b"))
    store_regions(prepare_regions(regions, feats, target_crs="EPSG:5070", dissolve=dissolve), str(tmp_path))
    for name, grid in (("up", Grid(0.0, 0.0, 1.0, 1.0, 8, 6)), ("down", Grid(0.0, 6.0, 1.0, -1.0, 8, 6))):
        cells = spark.createDataFrame([(r, c, float(r * 8 + c)) for r in range(6) for c in range(8)], "row BIGINT, col BIGINT, value DOUBLE")
        rf.run_zonal(spark, str(tmp_path), cells, grid, source="s", variable="v", stats=["mean", "max"])
        own = [(r, c) for r in range(6) for c in range(6) if not (1 <= c < 3 and 1 <= (r if name == "up" else 5 - r) < 3)]
        wide = {r.region_uid: r for r in spark.read.parquet(str(tmp_path / "region_features")).collect()}
        assert wide["l3_7"].v_mean == pytest.approx(sum(r * 8 + c for r, c in own) / len(own)) and wide["l3_8"].v_max == 47.0
        assert spark.read.parquet(str(tmp_path / "zonal_stats")).count() == 4
