"""Polygon columns: ARRAY of rings, a ring being an ARRAY<STRUCT<x, y>>.

Outer rings run counter-clockwise and holes clockwise once a feature has been
repaired, so signed areas add up across parts and holes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from .binding import let

Point = tuple[Column, Column]


def _vertex(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def close_ring(ring: Column) -> Column:
    def closed(r):
        first, last = F.get(r, F.lit(0)), F.get(r, F.size(r) - 1)
        return F.when((F.size(r) > 0) & (first != last), F.concat(r, F.array(first))).otherwise(r)

    return let(ring, closed)


def ring_edges(ring: Column) -> Column:
    """Directed edges of one ring, the closing edge included."""
    def edges(r):
        n = F.greatest(F.size(r) - 1, F.lit(0))
        return F.zip_with(
            F.slice(r, F.lit(1), n), F.slice(r, F.lit(2), n),
            lambda a, b: F.struct(
                a.getField("x").alias("x1"), a.getField("y").alias("y1"),
                b.getField("x").alias("x2"), b.getField("y").alias("y2"),
            ),
        )

    return let(close_ring(ring), edges)


def geom_edges(geom: Column) -> Column:
    return F.flatten(F.transform(geom, ring_edges))


def signed_area(ring: Column) -> Column:
    """Shoelace sum around the first vertex; positive for counter-clockwise."""
    ox = F.get(ring, F.lit(0)).getField("x")
    oy = F.get(ring, F.lit(0)).getField("y")
    twice = F.aggregate(
        ring_edges(ring), F.lit(0.0),
        lambda acc, e: acc + (e.x1 - ox) * (e.y2 - oy) - (e.x2 - ox) * (e.y1 - oy),
    )
    return twice / 2


def geom_area(geom: Column) -> Column:
    return F.abs(F.aggregate(geom, F.lit(0.0), lambda acc, r: acc + signed_area(r)))


def geom_perimeter(geom: Column) -> Column:
    return F.aggregate(
        geom_edges(geom), F.lit(0.0), lambda acc, e: acc + F.hypot(e.x2 - e.x1, e.y2 - e.y1)
    )


def geom_bounds(geom: Column) -> Column:
    xs = F.transform(F.flatten(geom), lambda v: v.getField("x"))
    ys = F.transform(F.flatten(geom), lambda v: v.getField("y"))
    return F.struct(
        F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
        F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"),
    )


def is_usable(geom: Column) -> Column:
    """False for NULL or empty geometry."""
    return geom.isNotNull() & (F.size(geom) > 0) & F.exists(geom, lambda r: F.size(r) > 0)


def map_vertices(geom: Column, fn: Callable[[Column, Column], Point]) -> Column:
    """Apply a point function (a projection, a snap) to every vertex."""
    return F.transform(
        geom, lambda ring: F.transform(ring, lambda v: _vertex(*fn(v.getField("x"), v.getField("y"))))
    )


def _without_repeats(ring: Column) -> Column:
    return F.filter(ring, lambda v, i: (i == 0) | (v != F.get(ring, i - 1)))


def clean_rings(geom: Column) -> Column:
    """Repair what a ring shows by itself: repeated vertices, open rings, rings without area."""
    rings = F.transform(geom, lambda r: close_ring(_without_repeats(r)))
    return F.filter(rings, lambda r: (F.size(r) >= 4) & (signed_area(r) != 0))


def orient(geom: Column, shells: Column | None = None) -> Column:
    """Shells counter-clockwise, holes clockwise; ``shells`` says which is which, without it all are shells."""
    def turned(ring, i):
        outer = F.lit(True) if shells is None else F.get(shells, i)
        return F.when(outer == (signed_area(ring) > 0), ring).otherwise(F.reverse(ring))

    return F.transform(geom, turned)


def ring_flags(geom: Column) -> Column:
    """Defects of a geometry before repair."""
    any_ring = lambda test: F.exists(geom, test)
    return F.struct(
        any_ring(lambda r: F.get(r, F.lit(0)) != F.get(r, F.size(r) - 1)).alias("open_ring"),
        any_ring(lambda r: F.size(_without_repeats(r)) < F.size(r)).alias("repeated_vertex"),
        any_ring(lambda r: signed_area(r) == 0).alias("zero_area"),
        any_ring(lambda r: F.size(close_ring(_without_repeats(r))) < 4).alias("too_short"),
    )


def simplify(geom: Column, step: float) -> Column:
    """Snap vertices to a grid of ``step``, drop repeats, then rings that collapsed."""
    snap = lambda c: F.round(c / F.lit(step)) * F.lit(step)
    snapped = map_vertices(geom, lambda x, y: (snap(x), snap(y)))
    rings = F.transform(snapped, lambda r: close_ring(_without_repeats(r)))
    return F.filter(rings, lambda r: F.size(r) >= 4)
