"""From a region catalog and a polygon layer to clean, measured regions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..constants import AREA_CRS, DEFAULT_LEVEL, DEFAULT_SCHEME, M2_PER_KM2, WORKING_CRS
from ..functions.codes import with_code
from ..functions.crs import reproject
from ..functions.rings import geom_area, map_vertices
from ..operators import dissolve as ds, regions as rg
from ..operators.junctions import split_edges
from ..operators.repair import repair_features
from ..session import materialize
from ..sources.polygons import layer_crs, write_bounds, write_qa_csv, write_regions


@dataclass
class PreparedRegions:
    """``regions``: the output columns (no geom when dissolved, see ``outline``);
    ``bounds``: xmin..ymax per row; ``outline``: edges per uid, dissolved only."""

    regions: DataFrame
    bounds: DataFrame
    outline: DataFrame | None = None


def prepare_regions(
    regions: DataFrame,
    features: DataFrame,
    *,
    scheme: str = DEFAULT_SCHEME,
    level: int = DEFAULT_LEVEL,
    code_field: str | None = None,
    crs: str | None = None,
    target_crs: str = WORKING_CRS,
    area_crs: str = AREA_CRS,
    dissolve: bool = True,
    check: bool = True,
) -> PreparedRegions:
    """Select, clean, dissolve, measure and reproject.

    Coordinates are in ``crs``, by default that of the layer (its ``crs`` column).
    Area is measured after the dissolve, so shared ground counts once. The
    completeness check comes last: a region whose only geometry was empty is
    missing.
    """
    crs = crs or layer_crs(features)
    wanted = rg.wanted_regions(regions, scheme, level)
    if check:
        rg.check_wanted(wanted, scheme, level)
    field = rg.pick_code_field([c for c in features.columns if c not in ("geom", "crs")], code_field)
    coded = with_code(features, field)
    chosen = rg.select_features(coded, wanted, scheme, level)
    clean = rg.drop_unusable(repair_features(chosen))
    if check:
        clean = materialize(clean, "clean")
        _check_complete(wanted, clean, coded)
    if dissolve:
        return _dissolved(clean, crs, target_crs, area_crs)
    to_area = lambda x, y: reproject(x, y, crs, area_crs)
    to_target = lambda x, y: reproject(x, y, crs, target_crs)
    measured = clean.withColumn(
        "area_km2", geom_area(map_vertices(F.col("geom"), to_area)) / M2_PER_KM2
    ).withColumn("geom", map_vertices(F.col("geom"), to_target))
    out = rg.output_columns(measured)
    return PreparedRegions(out, rg.feature_bounds(out))


def _dissolved(clean: DataFrame, crs: str, target_crs: str, area_crs: str) -> PreparedRegions:
    meta = ds.first_metadata(clean, "uid", ["scheme", "level", "code", "name"], "feature_id")
    edges = split_edges(ds.feature_edges(clean, ["uid"]))
    outline = materialize(ds.dissolve_outline(edges), "outline")
    area = ds.area_km2(outline, ["uid"], crs, area_crs)
    target = ds.project_edges(outline, crs, target_crs)
    boxes = ds.edge_measures(target, ["uid"]).select("uid", "xmin", "ymin", "xmax", "ymax")
    table = meta.join(area, "uid").join(boxes, "uid")
    out = table.select("uid", "scheme", "level", "code", "name", "area_km2")
    bounds = table.select("uid", "code", "name", "xmin", "ymin", "xmax", "ymax", "area_km2")
    return PreparedRegions(out, bounds, target)


def _check_complete(wanted: DataFrame, clean: DataFrame, coded: DataFrame) -> None:
    # the wanted codes are a caller's selection, so the error can name every one that is missing
    lost = [r["code"] for r in rg.missing_codes(wanted, clean).orderBy("code").collect()]
    if not lost:
        return
    if clean.isEmpty():
        seen = [r["code"] for r in rg.code_sample(coded, "code").collect()]
        raise ValueError(f"no wanted code matched; wanted {lost}, codes in the layer {seen}")
    raise ValueError(f"{len(lost)} codes without a usable feature: {lost}")


def store_regions(prepared: PreparedRegions, root: str, *, layer: str = "regions", version: str | None = None,
                  overwrite: bool = True, bounds_path: str | None = None, qa_csv: str | None = None) -> None:
    """Write the region layer, its outline, the bounds table and the optional CSV."""
    write_regions(prepared.regions, root, layer, version, overwrite)
    if prepared.outline is not None:
        write_regions(prepared.outline, root, f"{layer}_outline", version, overwrite)
    if bounds_path:
        write_bounds(prepared.bounds, bounds_path, overwrite)
    write_qa_csv(prepared.regions, qa_csv)
