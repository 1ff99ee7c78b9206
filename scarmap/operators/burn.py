"""Burnt area from pixel pairs: indices, masks, components, attachment."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scarmap.operators.components import connected_components
from scarmap.operators.groups import map_groups
from scarmap.operators.ranking import medians
from scarmap.operators.scenes import UNUSABLE_SCL
from scarmap.shared import written

THRESHOLD, LEAST_HA, LEAST_NBR, PIXEL_M, NEAR_M, MAIN_M = 0.15, 1.0, 0.20, 20, 3000, 2000
BLOCK = 512
# Severity cut points of dNBR, and the thresholds of the validation sweep.
SEVERITY = ((0.10, "unburnt"), (0.27, "low"), (0.44, "moderate_low"), (0.66, "moderate_high"))
THRESHOLDS = (0.10, 0.15, 0.20, 0.27, 0.35, 0.44, 0.55, 0.66)


def nbr(pixels: DataFrame) -> DataFrame:
    """OP-P4: ``valid`` and ``nbr`` (float, null where invalid) of ``pixels(b8a, b12, scl, …)``."""
    a, b = F.col("b8a").cast("float"), F.col("b12").cast("float")
    bright = (F.col("b8a") + F.col("b12")) * 1e-4 >= 0.05
    valid = F.coalesce(~F.col("scl").isin(*UNUSABLE_SCL) & (F.col("b8a") > 0) & (F.col("b12") > 0) & bright, F.lit(False))
    return pixels.withColumn("valid", valid).withColumn("nbr", F.when(F.col("valid"), ((a - b) / (a + b)).cast("float")))


def pixel_pairs(pre: DataFrame, post: DataFrame) -> DataFrame:
    """OP-J6, OP-P5: both images' NBR at each pixel of one tile, and dnbr where both are valid.
    Images of different tiles have no common pixel, so nothing is resampled."""
    keys = ["fire", "tile", "row", "col"]
    a = nbr(pre).select(*keys, F.col("nbr").alias("nbr_pre"), F.col("valid").alias("valid_pre"))
    b = nbr(post).select(*keys, F.col("nbr").alias("nbr_post"), F.col("valid").alias("valid_post"))
    return a.join(b, keys).withColumn("usable", F.col("valid_pre") & F.col("valid_post")).withColumn("dnbr", (F.col("nbr_pre") - F.col("nbr_post")).cast("float"))


def burn_mask(pairs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """OP-P5: the burnt pixels."""
    return pairs.where(F.col("dnbr") >= F.lit(threshold).cast("float"))


def severity(dnbr: Column) -> Column:
    """OP-P6: class by the cut points; high above the last, null for null."""
    out = F.lit("high")
    for cut, name in reversed(SEVERITY):
        out = F.when(dnbr < F.lit(cut).cast("float"), name).otherwise(out)
    return F.when(dnbr.isNotNull(), out)


def label_block(rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """OP-U2: for each pixel of a block the index of its 4-connected component's first pixel.
    Labels spread along whole runs of rows and of columns in turn until nothing changes."""
    if not len(rows):
        return np.zeros(0, np.int64)
    r0, c0 = rows.min(), cols.min()
    grid = np.full((rows.max() - r0 + 1, cols.max() - c0 + 1), -1, np.int64)
    grid[rows - r0, cols - c0] = np.arange(len(rows))
    label = np.where(grid >= 0, grid, np.iinfo(np.int64).max)
    inside = grid >= 0

    def along(a: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Each run of set cells in row-major order gets its smallest label."""
        flat, on = a.ravel(), m.ravel()
        new = on.copy()
        new[1:] &= ~on[:-1]
        new.reshape(m.shape)[:, 0] |= m[:, 0]
        starts = np.flatnonzero(new)
        of = np.cumsum(new) - 1
        out = flat.copy()
        least = np.minimum.reduceat(np.where(on, flat, np.iinfo(np.int64).max), starts) if len(starts) else flat[:0]
        out[on] = least[of[on]]
        return out.reshape(a.shape)

    while True:
        after = along(along(label, inside).T, inside.T).T
        if np.array_equal(after, label):
            return label[rows - r0, cols - c0]
        label = after


def burn_components(mask: DataFrame, keys: tuple[str, ...] = ("fire",), block: int = BLOCK) -> DataFrame:
    """OP-A3 (labels): ``(*keys, row, col, comp_id)`` of ``mask(*keys, row, col)``; 4-neighbours
    only. Blocks are labelled by themselves; only the labels that meet at a block's edge make a
    graph. comp_id is the number row * 2^32 + col of the component's first pixel.

    The labels are written once, for the seams and the result both read them. A component's number
    is its smallest label, which is what the seam graph gives, so nothing is gathered by component."""
    k = list(keys)
    dealt = mask.select(*k, "row", "col").distinct().withColumn("_br", F.floor(F.col("row") / block)).withColumn("_bc", F.floor(F.col("col") / block))
    schema = ", ".join(f"{n} {t}" for n, t in mask.select(*k).dtypes) + ", row long, col long, label long"

    def label(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        rows, cols = pdf["row"].to_numpy(np.int64), pdf["col"].to_numpy(np.int64)
        number = np.empty(len(pdf), np.int64)
        for a, b in zip(starts, [*starts[1:], len(pdf)], strict=True):
            first = label_block(rows[a:b], cols[a:b])
            number[a:b] = rows[a:b][first] * (1 << 32) + cols[a:b][first]
        return pdf[k].assign(row=rows, col=cols, label=number)

    labelled = written(map_groups(dealt, [*k, "_br", "_bc"], ["row", "col"], label, schema), "labelled")
    edge = labelled.where((F.pmod(F.col("row"), F.lit(block)).isin(0, block - 1)) | (F.pmod(F.col("col"), F.lit(block)).isin(0, block - 1)))
    steps = F.array(F.struct(F.lit(1).alias("dr"), F.lit(0).alias("dc")), F.struct(F.lit(0).alias("dr"), F.lit(1).alias("dc")))
    ahead = edge.select(*k, "label", F.explode(steps).alias("s"), "row", "col").select(*k, F.col("label").alias("other"), (F.col("row") + F.col("s.dr")).alias("row"), (F.col("col") + F.col("s.dc")).alias("col"))
    node = lambda c: F.struct(*k, F.col(c).alias("label"))
    seams = edge.join(ahead, [*k, "row", "col"]).where("label <> other").select(node("label").alias("src"), node("other").alias("dst"))
    merged = connected_components(seams).select(*[F.col("node")[n].alias(n) for n in (*k, "label")], F.col("component.label").alias("_c"))
    return labelled.join(merged, [*k, "label"], "left").select(*k, "row", "col", F.coalesce("_c", "label").alias("comp_id"))


def component_areas(labels: DataFrame, least_ha: float = LEAST_HA, keys: tuple[str, ...] = ("fire",), pixel_area_m2: float = 400.0) -> DataFrame:
    """OP-A3 (areas): ``(*keys, comp_id, n_pixels, area_ha)`` of components of ``least_ha`` or more."""
    area = F.col("n_pixels") * pixel_area_m2 / 10_000
    return labels.groupBy(*keys, "comp_id").agg(F.count("*").alias("n_pixels")).withColumn("area_ha", area).where(F.col("area_ha") >= least_ha)


def median_nbr(pairs: DataFrame) -> DataFrame:
    """OP-A4: ``(fire, nbr_median)`` before the fire over detected usable pixels; 0 if there are none."""
    value = F.when(F.col("usable") & F.col("detected"), F.col("nbr_pre").cast("double"))
    return medians(pairs.withColumn("_v", value), ["fire"], "_v").select("fire", F.coalesce("median", F.lit(0.0)).alias("nbr_median"))


def vegetation_gate(medians: DataFrame, least: float = LEAST_NBR) -> DataFrame:
    """OP-P7: fires whose ground was green enough before."""
    return medians.where(F.col("nbr_median") >= least)


def masked_share(zone: DataFrame) -> DataFrame:
    """OP-A5: ``(fire, part_masquee)`` of zone pixels ``(fire, usable)``."""
    n = F.count("*")
    return zone.groupBy("fire").agg((1 - F.sum(F.coalesce(F.col("usable").cast("int"), F.lit(0))) / F.greatest(n, F.lit(1))).alias("part_masquee"))


def free_sides(labels: DataFrame, keys: tuple[str, ...] = ("fire",)) -> DataFrame:
    """``(*keys, comp_id, x, y, flat, turn)``: the sides of pixels that have a pixel of the component
    on one side only, flat ones from corner (x, y) to (x + 1, y), others to (x, y + 1), in pixel
    corners; y grows with the row. ``turn`` is 1 if the pixel is on the left of that way (a row
    before, or a column after), -1 if it is on the right. ``labels(*keys, comp_id, row, col)`` has a pixel once.

    A side of two pixels gets 1 and -1, which add up to none. Pixels are exchanged once, by their
    component and BLOCK rows of corners; only those in the last row of a block go to the next one too."""
    k = [*keys, "comp_id"]
    at = lambda y: F.floor(y / BLOCK)
    both = F.array_distinct(F.array(at(F.col("row")), at(F.col("row") + 1)))
    dealt = labels.select(*k, "row", "col", F.explode(both).alias("_b")).repartition(*k, "_b")
    side = lambda dx, dy, flat, turn: F.struct((F.col("col") + dx).alias("x"), (F.col("row") + dy).alias("y"), F.lit(flat).alias("flat"), F.lit(turn).alias("turn"))
    sides = F.array(side(0, 0, True, -1), side(0, 1, True, 1), side(0, 0, False, 1), side(1, 0, False, -1))
    each = dealt.select(*k, "_b", F.explode(sides).alias("s")).select(*k, "_b", "s.*").where(at(F.col("y")) == F.col("_b"))
    return each.groupBy(*k, "_b", "x", "y", "flat").agg(F.sum("turn").alias("turn")).where("turn <> 0").drop("_b")


def boundary(labels: DataFrame, keys: tuple[str, ...] = ("fire",)) -> DataFrame:
    """Pixels of a component with a side that is free, and how many sides are."""
    row = F.when(F.col("flat") & (F.col("turn") > 0), F.col("y") - 1).otherwise(F.col("y"))
    col = F.when(~F.col("flat") & (F.col("turn") < 0), F.col("x") - 1).otherwise(F.col("x"))
    return free_sides(labels, keys).groupBy(*keys, "comp_id", row.alias("row"), col.alias("col")).agg(F.count("*").alias("sides"))


def compactness(labels: DataFrame, keys: tuple[str, ...] = ("fire",)) -> DataFrame:
    """OP-F8: Polsby-Popper 4πA/P² of pixel components; P is the length of their free sides."""
    k = [*keys, "comp_id"]
    perimeter = boundary(labels, keys).groupBy(*k).agg((F.sum("sides") * PIXEL_M).alias("p"))
    area = labels.groupBy(*k).agg((F.count("*") * PIXEL_M * PIXEL_M).alias("a"))
    return area.join(perimeter, k).select(*k, F.when(F.col("p") > 0, 4 * math.pi * F.col("a") / F.col("p") ** 2).otherwise(0.0).alias("compactness"))


def gap_m(dr: Column, dc: Column) -> Column:
    """Distance between two pixel squares, exact: 0 where they touch."""
    free = lambda d: F.greatest(F.abs(d) - 1, F.lit(0))
    return F.sqrt(free(dr) ** 2 + free(dc) ** 2) * PIXEL_M


def attach_components(labels: DataFrame, zone: DataFrame, most_m: float = NEAR_M, tile: int = 16) -> DataFrame:
    """OP-J8: ``(fire, comp_id, distance_m)`` of the components within ``most_m`` of the fire's zone
    ``(fire, row, col)``.

    A component that has a pixel of the zone is at 0; of the others only boundary pixels matter, on
    both sides. These are first boxed by squares of ``tile`` pixels. Boxes meet by an equi-join on
    wider squares; the farthest that two boxes' pixels can be apart bounds a component's distance,
    and only pairs of boxes that can beat it (and ``most_m``) are looked at pixel by pixel.
    """
    wide = tile * (int(most_m / PIXEL_M / tile) + 2)
    at = lambda c, n: F.floor(F.col(c) / n)
    area = zone.select("fire", "row", "col").distinct()
    edge = boundary(labels).select("fire", "comp_id", "row", "col", at("row", tile).alias("tr"), at("col", tile).alias("tc"))
    rim = boundary(area.withColumn("comp_id", F.lit(0))).select("fire", F.col("row").alias("zr"), F.col("col").alias("zc"), at("row", tile).alias("ur"), at("col", tile).alias("uc"))
    edge, rim = written(edge, "edge"), written(rim, "rim")
    box = lambda r, c: [F.min(r).alias(f"{r}0"), F.max(r).alias(f"{r}1"), F.min(c).alias(f"{c}0"), F.max(c).alias(f"{c}1")]
    mine = edge.groupBy("fire", "comp_id", "tr", "tc").agg(*box("row", "col")).withColumns({"br": at("row0", wide), "bc": at("col0", wide)})
    theirs = rim.groupBy("fire", "ur", "uc").agg(*box("zr", "zc")).withColumns({"br": at("zr0", wide), "bc": at("zc0", wide)})
    steps = F.sequence(F.lit(-1), F.lit(1))
    near = mine.withColumn("i", F.explode(steps)).withColumn("j", F.explode(steps)).withColumns({"br": F.col("br") + F.col("i"), "bc": F.col("bc") + F.col("j")}).drop("i", "j")
    least = lambda a, z: F.greatest(F.col(f"{z}0") - F.col(f"{a}1"), F.col(f"{a}0") - F.col(f"{z}1"), F.lit(0))
    most = lambda a, z: F.greatest(F.col(f"{z}1") - F.col(f"{a}0"), F.col(f"{a}1") - F.col(f"{z}0"))
    met = near.join(theirs, ["fire", "br", "bc"]).select(
        "fire", "comp_id", "tr", "tc", "ur", "uc", gap_m(least("row", "zr"), least("col", "zc")).alias("lower"), gap_m(most("row", "zr"), most("col", "zc")).alias("upper")
    )
    met = written(met.where(F.col("lower") <= most_m), "boxes")
    bound = met.groupBy("fire", "comp_id").agg(F.min("upper").alias("bound"))
    open_ = met.join(bound, ["fire", "comp_id"]).where(F.col("lower") <= F.col("bound")).select("fire", "comp_id", "tr", "tc", "ur", "uc")
    pixels = edge.join(open_, ["fire", "comp_id", "tr", "tc"]).join(rim, ["fire", "ur", "uc"])
    apart = pixels.select("fire", "comp_id", gap_m(F.col("row") - F.col("zr"), F.col("col") - F.col("zc")).alias("d"))
    inside = labels.join(area, ["fire", "row", "col"], "left_semi").select("fire", "comp_id").distinct().withColumn("d", F.lit(0.0))
    return apart.unionByName(inside).groupBy("fire", "comp_id").agg(F.min("d").alias("distance_m")).where(F.col("distance_m") <= most_m)


def split_main(labels: DataFrame, near_m: float = MAIN_M) -> DataFrame:
    """OP-J8: ``(fire, comp_id, main)``: components within ``near_m`` of the largest one (of equal
    size the first) are the fire, the others isolated detections."""
    sizes = labels.groupBy("fire", "comp_id").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("fire").agg(F.max_by("comp_id", F.struct("n", (-F.col("comp_id")).alias("o"))).alias("comp_id"))
    core = boundary(labels).join(largest, ["fire", "comp_id"]).select("fire", "row", "col")
    near = attach_components(labels, core, near_m).select("fire", "comp_id", F.lit(True).alias("main"))
    return sizes.select("fire", "comp_id").join(near, ["fire", "comp_id"], "left").withColumn("main", F.coalesce("main", F.lit(False)))
