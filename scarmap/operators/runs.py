"""Zones as runs of cells (OP-G1 to OP-G3, OP-A9, OP-J7): ``(*keys, cy, first, last)``, ends included.

A zone takes rows in proportion to its outline, not to its area. Zones are combined by a sweep along
each row of the grid: where runs begin and end, the number of runs that are open changes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scarmap.operators.burn import PIXEL_M
from scarmap.operators.overlap import overlapping_words, words_of_runs
from scarmap.operators.zones import ring_spans


def runs_of_cells(cells: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """The runs of zones ``(*keys, cx, cy)``; repeated cells count once."""
    ends = cells.select(*keys, "cy", F.col("cx").alias("first"), F.col("cx").alias("last"))
    return combined(ends, None, lambda a, b: a, keys)


def runs_of_rings(rings: DataFrame, cell_m: int = PIXEL_M) -> DataFrame:
    """The runs, by geom_id, of ``rings(geom_id, ring)``, as OP-U3 has their cells."""
    return ring_spans(rings, cell_m)


def cells_of_runs(runs: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """``(*keys, cx, cy)``: the cells of runs, as often as runs hold them."""
    return runs.select(*keys, F.explode(F.sequence("first", "last")).alias("cx"), "cy")


def combined(a: DataFrame, b: DataFrame | None, rule: Callable[[Column, Column], Column], keys: tuple[str, ...] = ()) -> DataFrame:
    """The runs of what is wanted by ``rule(in a, in b)``, which must be false outside both; the runs
    of a zone may overlap and repeat. Runs that touch are one. Rows without a row or an end are left out.

    Ends at the same place are added up before they are exchanged; one exchange, by keys and row,
    serves the sweep and the joining of what it leaves."""
    k = list(keys)

    def ends(runs: DataFrame, name: str) -> DataFrame:
        other = "b" if name == "a" else "a"
        at = F.explode(F.array(F.struct(F.col("first").cast("long").alias("x"), F.lit(1).alias(name)), F.struct((F.col("last") + 1).cast("long").alias("x"), F.lit(-1).alias(name))))
        whole = runs.where("cy is not null and first <= last")
        return whole.select(*k, F.col("cy").cast("long").alias("cy"), at.alias("e")).select(*k, "cy", "e.x", f"e.{name}", F.lit(0).alias(other)).select(*k, "cy", "x", "a", "b")

    every = ends(a, "a") if b is None else ends(a, "a").unionByName(ends(b, "b"))
    turns = every.groupBy(*k, "cy", "x").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    row = W.partitionBy(*k, "cy").orderBy("x")
    upto = row.rowsBetween(W.unboundedPreceding, 0)
    swept = turns.select(*k, "cy", "x", F.lead("x").over(row).alias("next"), rule(F.sum("a").over(upto) > 0, F.sum("b").over(upto) > 0).alias("in"))
    begins = F.col("in") & ~F.coalesce(F.lag("in").over(row), F.lit(False))
    marked = swept.withColumn("_b", begins.cast("int")).withColumn("_run", F.sum("_b").over(upto)).where("in")
    return marked.groupBy(*k, "cy", "_run").agg(F.min("x").alias("first"), (F.max("next") - 1).alias("last")).drop("_run")


def union_runs(a: DataFrame, b: DataFrame | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """OP-G1: what either zone has; of one zone, each of its cells once."""
    return combined(a, b, lambda x, y: x | y, keys)


def intersect_runs(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """OP-G2: what both zones have."""
    return combined(a, b, lambda x, y: x & y, keys)


def subtract_runs(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """OP-G3: what the first zone has and the second has not."""
    return combined(a, b, lambda x, y: x & ~y, keys)


def runs_area_ha(runs: DataFrame, key: str = "fire", cell_m: int = PIXEL_M) -> DataFrame:
    """OP-A9: ``(key, area_ha)`` of the union of each key's runs."""
    return union_runs(runs, keys=(key,)).groupBy(key).agg((F.sum(F.col("last") - F.col("first") + 1) * (cell_m * cell_m) / 10_000).alias("area_ha"))


def overlapping(a: DataFrame, b: DataFrame, over: float) -> DataFrame:
    """OP-J7: ``(a_id, b_id, ratio)`` of zones given as runs by ``geom_id`` that share more than
    ``over`` of the smaller one; see :func:`scarmap.operators.overlap.overlapping_words`."""
    return overlapping_words(words_of_runs(a), words_of_runs(b), over)
