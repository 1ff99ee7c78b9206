"""Zones given as rings: their cells (OP-U3), the points in them (OP-J2), the area of their union (OP-A9), exactly.

Ring edges are clipped to the cells that they pass. Of a cell that no edge passes, the centre
decides for all its points. In the others a point is compared with the centre: the path from one to
the other stays in the cell, so only the edges clipped to it can be crossed, and each crossing turns
inside to outside. So a point meets a handful of edges, however long the outline is.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scarmap.functions.geo import cell_of
from scarmap.operators.burn import PIXEL_M
from scarmap.operators.groups import map_groups
from scarmap.operators.outlines import boxed_pairs

#: Side of the cells in metres. Any size gives the same result; smaller cells hold fewer edges.
ZONE_CELL_M = 200
#: Edges reach so many metres beyond themselves, against rounding; one edge too many changes nothing.
WIDER_M = 1e-3
#: Height in metres of the bands in which unions are swept. Any height gives the same area.
BAND_M = 100.0


def ring_edges(rings: DataFrame, keys: tuple[str, ...] = ("geom_id",)) -> DataFrame:
    """``(*keys, x0, y0, x1, y1)``: the sides of ``rings(*keys, ring)``, closed where they aren't;
    points without both coordinates are left out, as are sides of no length and rows without a key."""
    whole = F.filter("ring", lambda p: p[0].isNotNull() & p[1].isNotNull())
    r = rings.dropna(subset=list(keys)).select(*keys, whole.alias("p")).where(F.size("p") > 1)
    pairs = F.arrays_zip(F.col("p").alias("a"), F.concat(F.slice("p", 2, F.size("p") - 1), F.slice("p", 1, 1)).alias("b"))
    e = r.select(*keys, F.explode(pairs).alias("e"))
    at = lambda p, i: F.col(f"e.{p}")[i].cast("double")
    return e.select(*keys, at("a", 0).alias("x0"), at("a", 1).alias("y0"), at("b", 0).alias("x1"), at("b", 1).alias("y1")).where("x0 <> x1 or y0 <> y1")


def rasterise(rings: DataFrame, cell_m: int = PIXEL_M) -> DataFrame:
    """OP-U3: ``(geom_id, cx, cy)``: cells whose centre is inside, by the even-odd rule, of
    ``rings(geom_id, ring)`` in metres, all rings of a geometry taken together (holes included)."""
    return ring_spans(rings, cell_m).select("geom_id", F.explode(F.sequence("first", "last")).alias("cx"), "cy")


def ring_spans(rings: DataFrame, cell_m: int = PIXEL_M) -> DataFrame:
    """``(geom_id, cy, first, last)``: the cells of OP-U3 as runs.

    Each side is cut by the centre lines of the rows that it crosses; in a row every second stretch
    between cuts is inside."""
    e = ring_edges(rings).where("y0 <> y1")
    row = lambda y: F.ceil(y / cell_m - 0.5)
    e = e.withColumn("from", row(F.least("y0", "y1"))).withColumn("to", row(F.greatest("y0", "y1")) - 1).where("from <= to")
    cuts = e.withColumn("cy", F.explode(F.sequence("from", "to")))
    cuts = cuts.select("geom_id", "cy", (F.col("x0") + ((F.col("cy") + 0.5) * cell_m - F.col("y0")) * (F.col("x1") - F.col("x0")) / (F.col("y1") - F.col("y0"))).alias("x"))
    spans = cuts.groupBy("geom_id", "cy").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    pairs = F.transform(F.sequence(F.lit(0), F.floor(F.size("xs") / 2).cast("int") - 1), lambda i: F.struct(F.get("xs", 2 * i).alias("a"), F.get("xs", 2 * i + 1).alias("b")))
    spans = spans.select("geom_id", "cy", F.explode(pairs).alias("s"))
    first, last = F.ceil(F.col("s.a") / cell_m - 0.5), F.ceil(F.col("s.b") / cell_m - 0.5) - 1
    return spans.select("geom_id", "cy", first.cast("long").alias("first"), last.cast("long").alias("last")).where("first <= last")


def edge_cells(edges: DataFrame, cell_m: int = ZONE_CELL_M) -> DataFrame:
    """``edges`` with ``cx, cy``, a row for each cell that the edge passes: row by row the columns
    between the places where it enters and leaves the row."""
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    e = edges.withColumn("cy", F.explode(F.sequence(cell_of(low - WIDER_M, cell_m), cell_of(high + WIDER_M, cell_m))))
    at = lambda y: F.col("x0") + (F.greatest(low, F.least(high, y)) - F.col("y0")) / (F.col("y1") - F.col("y0")) * (F.col("x1") - F.col("x0"))
    flat = F.col("y0") == F.col("y1")
    a = F.when(flat, F.col("x0")).otherwise(at(F.col("cy") * cell_m - WIDER_M))
    b = F.when(flat, F.col("x1")).otherwise(at((F.col("cy") + 1) * cell_m + WIDER_M))
    e = e.withColumn("a", a).withColumn("b", b)
    columns = F.sequence(cell_of(F.least("a", "b") - WIDER_M, cell_m), cell_of(F.greatest("a", "b") + WIDER_M, cell_m))
    return e.withColumn("cx", F.explode(columns)).drop("a", "b")


def _turn(x: Column, y: Column) -> Column:
    """On which side of an edge a point is: positive on its left."""
    return (F.col("x1") - F.col("x0")) * (y - F.col("y0")) - (x - F.col("x0")) * (F.col("y1") - F.col("y0"))


def _right(x: Column, y: Column) -> Column:
    """Whether the ray from a point to the right crosses the edge. This is the rule for inside: an
    odd number of crossings. A point on an edge counts as just right of it and, above all, just above."""
    across = (F.col("y0") > y) != (F.col("y1") > y)
    return across & F.when(F.col("y1") > F.col("y0"), _turn(x, y) > 0).otherwise(_turn(x, y) < 0)


def _up(x: Column, y: Column) -> Column:
    """The same for the ray upwards, with the same answer for points on edges: moved right by a
    little and up by much less, a point is below an edge that it is on where that one rises."""
    across = (F.col("x0") > x) != (F.col("x1") > x)
    rises = (F.col("y1") - F.col("y0")) * (F.col("x1") - F.col("x0")) > 0
    below = F.when(F.col("x1") > F.col("x0"), _turn(x, y) < 0).otherwise(_turn(x, y) > 0)
    return across & (below | ((_turn(x, y) == 0) & rises))


def points_in_rings(points: DataFrame, rings: DataFrame, cell_m: int = ZONE_CELL_M) -> DataFrame:
    """OP-J2: ``(point_id, geom_id)`` of the points of ``points(point_id, x_m, y_m)`` in a geometry
    of ``rings(geom_id, ring)``, all its rings taken together by the even-odd rule, holes included.

    Of a point exactly on an edge the place just right of it and above counts, so zones that share
    an edge never share a point. Points without coordinates are nowhere; repeated points give
    repeated rows; rings of fewer than two places, and null geometries, hold nothing.
    """
    cell = ["geom_id", "cx", "cy"]
    centres = rasterise(rings, cell_m).select(*cell)
    passed = edge_cells(ring_edges(rings), cell_m)
    placed = points.where("x_m is not null and y_m is not null").select("point_id", F.col("x_m").cast("double").alias("x_m"), F.col("y_m").cast("double").alias("y_m"))
    spots = placed.select("x_m", "y_m", cell_of(F.col("x_m"), cell_m).alias("cx"), cell_of(F.col("y_m"), cell_m).alias("cy")).distinct()
    mx, my, x, y = (F.col("cx") + 0.5) * cell_m, (F.col("cy") + 0.5) * cell_m, F.col("x_m"), F.col("y_m")
    turns = sum((c.cast("int") for c in (_right(x, y), _right(mx, y), _up(mx, y), _up(mx, my))), F.lit(0))
    turned = spots.join(passed, ["cx", "cy"]).groupBy(*cell, "x_m", "y_m").agg(F.sum(turns).alias("turns"))
    near_edges = turned.join(centres.withColumn("inside", F.lit(1)), cell, "left").where((F.coalesce("inside", F.lit(0)) + F.col("turns")) % 2 == 1)
    far_inside = spots.join(centres.join(passed.select(*cell), cell, "left_anti"), ["cx", "cy"])
    found = near_edges.select("geom_id", "x_m", "y_m").unionByName(far_inside.select("geom_id", "x_m", "y_m"))
    return placed.join(found, ["x_m", "y_m"]).select("point_id", "geom_id")


def _meetings(x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray) -> np.ndarray:
    """The heights at which segments that rise from (x0, y0) to (x1, y1) cross each other."""
    pairs = boxed_pairs(np.stack([np.minimum(x0, x1), y0], 1), np.stack([np.maximum(x0, x1), y1], 1))
    i, j = pairs.T
    si, sj = ((x1 - x0) / (y1 - y0))[i], ((x1 - x0) / (y1 - y0))[j]
    lo, hi = np.maximum(y0[i], y0[j]), np.minimum(y1[i], y1[j])
    with np.errstate(divide="ignore", invalid="ignore"):
        y = lo + ((x0[j] + sj * (lo - y0[j])) - (x0[i] + si * (lo - y0[i]))) / (si - sj)
    return y[(y > lo) & (y < hi)]


def covered_area(geom: np.ndarray, x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray) -> float:
    """The area inside at least one geometry, of rising segments that bound them; each geometry by
    the even-odd rule from the left.

    Between the heights at which a segment begins, ends or crosses another one, their order from
    left to right stays, and what is covered is trapezia: their middle width times the height."""
    heights = np.unique(np.concatenate([y0, y1, _meetings(x0, y0, x1, y1)]))
    first, last = np.searchsorted(heights, y0), np.searchsorted(heights, y1)
    n = last - first
    of = np.repeat(np.arange(len(geom)), n)
    slab = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    middle = (heights[slab] + heights[slab + 1]) / 2
    x = x0[of] + (middle - y0[of]) * (x1[of] - x0[of]) / (y1[of] - y0[of])
    own = np.lexsort((x, geom[of], slab))
    new = np.ones(len(own), bool)
    new[1:] = (slab[own][1:] != slab[own][:-1]) | (geom[of][own][1:] != geom[of][own][:-1])
    nth = np.arange(len(own)) - np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))
    enters = np.empty(len(own), np.int64)
    enters[own] = 1 - 2 * (nth % 2)
    order = np.lexsort((-enters, x, slab))
    slab, x, depth = slab[order], x[order], np.cumsum(enters[order])
    inside = (depth[:-1] > 0) & (slab[1:] == slab[:-1])
    return float(((x[1:] - x[:-1]) * (heights[slab[:-1] + 1] - heights[slab[:-1]]))[inside].sum())


def union_area(rings: DataFrame, key: str = "fire", band_m: float = BAND_M) -> DataFrame:
    """OP-A9: ``(key, area_m2)``: the exact area of the union of the geometries of each key, of
    ``rings(key, geom_id, ring)``; a geometry is all its rings by the even-odd rule.

    Sides are cut into horizontal bands of ``band_m``, and the bands swept one by one, so a task
    holds what crosses one band of one key: an outline's sides, whatever the area. Rings without an
    extent and rows without a key or geom_id add nothing; a key with nothing else has no row.
    """
    e = ring_edges(rings, (key, "geom_id")).where("y0 <> y1")
    up = F.col("y1") > F.col("y0")
    at = lambda a, b: F.when(up, F.col(a)).otherwise(F.col(b))
    e = e.select(key, "geom_id", at("x0", "x1").alias("x0"), at("y0", "y1").alias("y0"), at("x1", "x0").alias("x1"), at("y1", "y0").alias("y1"))
    e = e.withColumn("band", F.explode(F.sequence(F.floor(F.col("y0") / band_m), F.ceil(F.col("y1") / band_m) - 1)))
    lo, hi = F.greatest("y0", F.col("band") * band_m), F.least("y1", (F.col("band") + 1) * band_m)
    x = lambda y: F.col("x0") + (y - F.col("y0")) / (F.col("y1") - F.col("y0")) * (F.col("x1") - F.col("x0"))
    e = e.select(key, "band", F.xxhash64("geom_id").alias("geom"), x(lo).alias("x0"), lo.alias("y0"), x(hi).alias("x1"), hi.alias("y1")).where("y0 < y1")
    schema = f"{key} {dict(rings.dtypes)[key]}, area double"

    def swept(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        columns = [pdf[c].to_numpy() for c in ("geom", "x0", "y0", "x1", "y1")]
        ends = [*starts[1:], len(pdf)]
        return pdf[[key]].iloc[starts].reset_index(drop=True).assign(area=[covered_area(*[c[a:b] for c in columns]) for a, b in zip(starts, ends, strict=True)])

    return map_groups(e, [key, "band"], ["geom", "x0", "y0"], swept, schema).groupBy(key).agg(F.sum("area").alias("area_m2"))
