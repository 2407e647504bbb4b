"""What a report of a repaired path shows: where it seems to double back, and what became of each unit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.paths import neighbours


def corner(x1: Column, y1: Column, x2: Column, y2: Column, x3: Column, y3: Column) -> Column:
    """Angle in degrees at the second of three points, between the ways to the first and to the third; 0 if one of them lies on it."""
    ax, ay, bx, by = x1 - x2, y1 - y2, x3 - x2, y3 - y2
    sizes = F.sqrt(ax * ax + ay * ay) * F.sqrt(bx * bx + by * by)
    cosine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (ax * bx + ay * by) / F.nullif(sizes, F.lit(0.0))))
    return F.when(sizes == 0, F.lit(0.0)).otherwise(F.degrees(F.acos(cosine)))


def flat_corners(points: Column, least: float = 150.0) -> Column:
    """(at, flat) of each place i whose points i, i+1 and i+2 are known: whether the angle in the middle has `least` degrees. points: array of structs lon, lat."""
    known = lambda c: F.coalesce(F.forall(F.array(*(c["three"][str(n)][x] for n in range(3) for x in ("lon", "lat"))), lambda x: x.isNotNull()), F.lit(False))
    angle = lambda c: corner(*(c["three"][str(n)][x] for n in range(3) for x in ("lon", "lat")))
    places = F.transform(neighbours(F.coalesce(points, F.array()), 3), lambda three, i: F.struct(i.alias("at"), three.alias("three")))
    return F.transform(F.filter(places, known), lambda c: F.struct(c["at"].alias("at"), (angle(c) >= least).alias("flat")))


def backtrack_regions(points: Column, least: float = 150.0) -> Column:
    """Array of (first, last): runs of places with a flat corner, from 0, in one fold over the path and without a shuffle.

    A run starts at its first flat place i and lasts to the third point of the next known place that isn't flat, or to the path's end. Places
    with an unknown point are passed over: they neither end a run nor start one. Paths of fewer than three points have none.
    """
    none = F.array().cast("array<struct<first:int,last:int>>")

    def step(run: Column, corner_: Column) -> Column:
        closed = F.when((run["open"] >= 0) & ~corner_["flat"], F.concat(run["done"], F.array(F.struct(run["open"].alias("first"), (corner_["at"] + 2).alias("last"))))).otherwise(run["done"])
        opened = F.when(~corner_["flat"], F.lit(-1)).when(run["open"] >= 0, run["open"]).otherwise(corner_["at"])
        return F.struct(closed.alias("done"), opened.alias("open"))

    def end(run: Column) -> Column:
        return F.when(run["open"] >= 0, F.concat(run["done"], F.array(F.struct(run["open"].alias("first"), (F.size(points) - 1).alias("last"))))).otherwise(run["done"])

    return F.aggregate(flat_corners(points, least), F.struct(none.alias("done"), F.lit(-1).alias("open")), step, end)


def unit_classes(raw: Column, repaired: Column) -> Column:
    """Struct of places from 0: anchors and inserted in the repaired path, dropped in the raw one, and the repaired path's start and end (null if it is empty)."""
    places = lambda path, keep: F.filter(F.transform(path, lambda u, i: F.when(keep(u), i)), lambda i: i.isNotNull())
    filled = F.size(repaired) > 0
    return F.struct(
        places(repaired, lambda u: F.array_contains(raw, u)).alias("anchors"), places(repaired, lambda u: ~F.array_contains(raw, u)).alias("inserted"),
        places(raw, lambda u: ~F.array_contains(repaired, u)).alias("dropped"), F.when(filled, 0).alias("start"), F.when(filled, F.size(repaired) - 1).alias("end"),
    )
