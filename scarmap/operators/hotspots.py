"""Hot spots: filters, clusters, summaries and footprints."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scarmap.functions.geo import CELL_M, cell_of
from scarmap.operators.components import connected_components
from scarmap.shared import written

#: Points this near are one fire; a hot pixel's half width; cells this wide hold one fire only.
DISTANCE_M, RADIUS_M = 2000, 187.0


def filter_confidence(df: DataFrame, drop_low: bool = True) -> DataFrame:
    """OP-P3: without low-confidence points (``l``, any case); null and numeric confidences stay.
    ``drop_low=False`` keeps all, as a source that coerces the column to numbers does."""
    return df.where(F.coalesce(F.lower(F.col("confidence").cast("string")) != "l", F.lit(True))) if drop_low else df


def _boxes(spots: DataFrame, *keys: str) -> DataFrame:
    return spots.groupBy(*keys).agg(F.min("x_m").alias("x0"), F.max("x_m").alias("x1"), F.min("y_m").alias("y0"), F.max("y_m").alias("y1"))


def _pairs_apart(pairs: DataFrame, distance_m: int) -> DataFrame:
    """``pairs`` of boxes (a_x0 … b_y1) that are not farther apart than the distance, with ``sure``:
    whether all their points are within it."""
    gap = lambda c: F.greatest(F.col(f"b_{c}0") - F.col(f"a_{c}1"), F.col(f"a_{c}0") - F.col(f"b_{c}1"), F.lit(0.0))
    span = lambda c: F.greatest(F.col(f"b_{c}1") - F.col(f"a_{c}0"), F.col(f"a_{c}1") - F.col(f"b_{c}0"))
    square, least, most = float(distance_m) ** 2, gap("x") ** 2 + gap("y") ** 2, span("x") ** 2 + span("y") ** 2
    return pairs.where(least <= square).withColumn("sure", most <= square)


def _side(df: DataFrame, side: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns])


def cluster_hotspots(points: DataFrame, distance_m: int = DISTANCE_M, parts: int = 4) -> DataFrame:
    """OP-J1: ``(point_id, cluster_id)`` of ``points(point_id, x_m, y_m)``; two points within
    ``distance_m`` are of one cluster, transitively; the id is the cluster's smallest point_id.

    Cells are so small that all points in one are within the distance; each is one node, however
    many points it holds. Whether two neighbouring cells are linked is settled coarse to fine: by
    the boxes of their points, then by those of ``parts`` x ``parts`` squares of each. Only squares
    that this leaves open, of cells that are not in one cluster yet, are compared point by point, so
    a dense front never becomes a square of positions. Points without a position take no part.
    """
    side = int(distance_m / math.sqrt(2))
    reach = math.ceil(distance_m / side)
    placed = points.where("x_m is not null and y_m is not null").select("point_id", "x_m", "y_m", F.floor(F.col("x_m") / side).alias("cx"), F.floor(F.col("y_m") / side).alias("cy"))
    cells = written(placed.groupBy("cx", "cy").agg(F.min("point_id").alias("node"), F.min("x_m").alias("x0"), F.max("x_m").alias("x1"), F.min("y_m").alias("y0"), F.max("y_m").alias("y1")), "cells")
    steps = F.sequence(F.lit(-reach), F.lit(reach))
    moved = _side(cells, "a").withColumn("dx", F.explode(steps)).withColumn("dy", F.explode(steps))
    other = _side(cells, "b")
    pairs = moved.join(other, (F.col("a_cx") + F.col("dx") == F.col("b_cx")) & (F.col("a_cy") + F.col("dy") == F.col("b_cy"))).where("a_node < b_node")
    pairs = written(_pairs_apart(pairs, distance_m).select("a_node", "b_node", "sure"), "cell_pairs")
    # Squares of the cells of open pairs, then their points.
    square = lambda c: F.floor((F.col(f"{c}_m") - F.col(f"c{c}") * side) * parts / side)
    open_ = pairs.where(~F.col("sure")).select("a_node", "b_node")
    spots = placed.select("cx", "cy", "x_m", "y_m").distinct().join(cells.select("cx", "cy", "node"), ["cx", "cy"]).select("node", "x_m", "y_m", square("x").alias("sx"), square("y").alias("sy"))
    squares = _boxes(spots, "node", "sx", "sy")
    fine = written(_pairs_apart(open_.join(_side(squares, "a"), "a_node").join(_side(squares, "b"), "b_node"), distance_m).select("a_node", "b_node", "a_sx", "a_sy", "b_sx", "b_sy", "sure"), "square_pairs")
    links = pairs.where("sure").select(F.col("a_node").alias("src"), F.col("b_node").alias("dst")).unionByName(fine.where("sure").select(F.col("a_node").alias("src"), F.col("b_node").alias("dst")).distinct())
    known = connected_components(links)
    of = lambda s: known.select(F.col("node").alias(f"{s}_node"), F.col("component").alias(f"{s}_of"))
    rest = fine.join(of("a"), "a_node", "left").join(of("b"), "b_node", "left").where(F.coalesce("a_of", "a_node") != F.coalesce("b_of", "b_node"))
    met = rest.join(_side(spots, "a"), ["a_node", "a_sx", "a_sy"]).join(_side(spots, "b"), ["b_node", "b_sx", "b_sy"])
    met = met.where((F.col("a_x_m") - F.col("b_x_m")) ** 2 + (F.col("a_y_m") - F.col("b_y_m")) ** 2 <= float(distance_m) ** 2)
    late = written(met.select(F.col("a_node").alias("src"), F.col("b_node").alias("dst")).distinct(), "late_links")
    found = connected_components(late.unionByName(known.select(F.col("node").alias("src"), F.col("component").alias("dst")))) if not late.isEmpty() else known
    named = cells.join(found, cells["node"] == found["node"], "left").select("cx", "cy", F.coalesce("component", cells["node"]).alias("cluster_id"))
    return placed.join(named, ["cx", "cy"]).select("point_id", "cluster_id")


def add_hotspots(clustered: DataFrame, points: DataFrame, distance_m: int = DISTANCE_M) -> DataFrame:
    """OP-J1, incremental: ``(point_id, x_m, y_m, cluster_id)`` of the points of ``clustered``, same
    columns, and those of ``points(point_id, x_m, y_m)`` that it doesn't have, as
    :func:`cluster_hotspots` would cluster all of them.

    Points only link clusters, never part them. So only the new points, and stored ones in cells
    within reach of theirs, are clustered; a stored cluster that has a point in one of these goes with
    it. Of the others not even the labels are looked at again, but for the join that finds them untouched.
    """
    side = int(distance_m / math.sqrt(2))
    reach = math.ceil(distance_m / side) + 1
    cell = [F.floor(F.col("x_m") / side).alias("cx"), F.floor(F.col("y_m") / side).alias("cy")]
    placed = points.where("point_id is not null and x_m is not null and y_m is not null").select("point_id", "x_m", "y_m").dropDuplicates(["point_id"])
    new = written(placed.join(clustered.select("point_id"), "point_id", "left_anti"), "new_points")
    steps = F.sequence(F.lit(-reach), F.lit(reach))
    around = new.select(*cell).distinct().withColumn("i", F.explode(steps)).withColumn("j", F.explode(steps)).select((F.col("cx") + F.col("i")).alias("cx"), (F.col("cy") + F.col("j")).alias("cy")).distinct()
    near = written(clustered.select("point_id", "x_m", "y_m", "cluster_id", *cell).join(around, ["cx", "cy"], "left_semi"), "near_points")
    local = written(cluster_hotspots(near.select("point_id", "x_m", "y_m").unionByName(new), distance_m), "local_clusters")
    # Clusters are named by their smallest point, stored and local ones alike, so the smallest name wins.
    links = near.select("point_id", F.col("cluster_id").alias("dst")).join(local, "point_id").select(F.col("cluster_id").alias("src"), "dst").distinct()
    joined = connected_components(links)
    names = joined.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
    fresh = new.join(local, "point_id")
    both = clustered.select("point_id", "x_m", "y_m", "cluster_id").unionByName(fresh.select("point_id", "x_m", "y_m", "cluster_id"))
    return both.join(names, both["cluster_id"] == names["_n"], "left").select("point_id", "x_m", "y_m", F.coalesce("_c", "cluster_id").alias("cluster_id"))


def summarize_clusters(points: DataFrame, members: DataFrame) -> DataFrame:
    """OP-A1: one row a cluster, of ``points(point_id, acq_date, frp, …)`` and its members (OP-J2
    for clusters is that equi-join). A cluster without any frp has frp_total 0."""
    return points.join(members, "point_id").groupBy("cluster_id").agg(
        F.count("*").alias("n_points"),
        F.min("acq_date").alias("date_debut"),
        F.max("acq_date").alias("date_fin"),
        F.max("frp").alias("frp_max"),
        F.coalesce(F.sum("frp"), F.lit(0.0)).alias("frp_total"),
    )


def min_points(clusters: DataFrame, k: int = 5) -> DataFrame:
    """OP-P8: clusters of k points or more."""
    return clusters.where(F.col("n_points") >= k)


def top_fires(clusters: DataFrame, n: int = 10, k: int = 5) -> DataFrame:
    """OP-K1: the n strongest clusters of k points or more, ties to the smaller id."""
    return min_points(clusters, k).orderBy(F.desc_nulls_last("frp_total"), "cluster_id").limit(n)


def points_in_cells(points: DataFrame, zones: DataFrame, cell_m: int = CELL_M) -> DataFrame:
    """OP-J2: ``(point_id, geom_id)`` of points in zones given as cells ``(geom_id, cx, cy)``."""
    at = points.select("point_id", cell_of(F.col("x_m"), cell_m).alias("cx"), cell_of(F.col("y_m"), cell_m).alias("cy"))
    return at.join(zones.select("geom_id", "cx", "cy").distinct(), ["cx", "cy"]).select("point_id", "geom_id")


def hot_footprint(points: DataFrame, cell_m: int = CELL_M, radius_m: float = RADIUS_M) -> DataFrame:
    """OP-A10 (cells): ``(fire, cx, cy)`` whose centre lies in the inscribed 16-gon around a point
    of ``points(fire, x_m, y_m)``. Positions are distinct before they are expanded."""
    reach = math.ceil(radius_m / cell_m)
    steps = F.sequence(F.lit(-reach), F.lit(reach))
    spots = points.select("fire", "x_m", "y_m").distinct().where("x_m is not null and y_m is not null")
    cells = spots.select("fire", "x_m", "y_m", F.explode(steps).alias("i")).select("fire", "x_m", "y_m", (cell_of(F.col("x_m"), cell_m) + F.col("i")).alias("cx"), F.explode(steps).alias("j"))
    cells = cells.select("fire", "x_m", "y_m", "cx", (cell_of(F.col("y_m"), cell_m) + F.col("j")).alias("cy"))
    dx, dy = (F.col("cx") + 0.5) * cell_m - F.col("x_m"), (F.col("cy") + 0.5) * cell_m - F.col("y_m")
    sides = [math.radians(11.25 + 22.5 * k) for k in range(8)]
    outward = F.greatest(*[F.abs(dx * math.cos(a) + dy * math.sin(a)) for a in sides])
    return cells.where(outward <= radius_m * math.cos(math.radians(11.25))).select("fire", "cx", "cy").distinct()


def footprint_estimate(cells: DataFrame, cell_m: int = CELL_M, margin: float = 0.35) -> DataFrame:
    """OP-A10 (areas): the estimate in hectares to one decimal, and its bounds to none."""
    ha = F.count("*") * (cell_m * cell_m) / 10_000
    return cells.groupBy("fire").agg(
        F.round(ha, 1).alias("surface_estimee_ha"), F.round(ha * (1 - margin), 0).alias("surface_min_ha"), F.round(ha * (1 + margin), 0).alias("surface_max_ha")
    )


def zone_points(clusters: DataFrame, points: DataFrame, members: DataFrame) -> DataFrame:
    """OP-J2: the points of retained clusters only, with their cluster."""
    return points.join(members, "point_id").join(clusters.select("cluster_id"), "cluster_id", "left_semi")


def clustered(points: DataFrame, drop_low: bool = True) -> tuple[DataFrame, DataFrame]:
    """Filtered points and their cluster membership, written once for the steps that read both."""
    kept = filter_confidence(points, drop_low)
    return kept, written(cluster_hotspots(kept), "members")
