"""Scoring detections against official perimeters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scarmap.operators.burn import BLOCK, LEAST_HA, THRESHOLDS
from scarmap.operators.components import connected_components
from scarmap.operators.groups import map_groups
from scarmap.operators.ranking import medians
from scarmap.shared import written

PIXEL_HA = 0.04


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of ``root`` that edges from a to b connect; a root is its tree's first pixel,
    and every pixel points to its root before and after."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            after = root[root]
            if np.array_equal(after, root):
                break
            root[:] = after


def block_tree(rows: np.ndarray, cols: np.ndarray, level: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The component tree of a block's pixels, sorted by row and column, by falling level: (level,
    first pixel of each pixel's component there, -1 where a pixel is below). Each side between
    pixels is looked at once, at the level at which both are there."""
    at = {rc: i for i, rc in enumerate(zip(rows.tolist(), cols.tolist(), strict=True))}
    pairs = [(i, j) for (r, c), i in at.items() for j in (at.get((r, c + 1)), at.get((r + 1, c))) if j is not None]
    a, b = np.array(pairs, np.int64).reshape(-1, 2).T
    meet, root = np.minimum(level[a], level[b]), np.arange(len(rows))
    for k in range(int(level.max(initial=-1)), -1, -1):
        _joined(root, a[meet == k], b[meet == k])
        yield k, np.where(level >= k, root, -1)


def level_components(pixels: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(fire, k, n, zone, both)``: the components of 4-neighbours of each nested mask, of
    ``pixels(fire, row, col, level, zone, both)``: mask k is the pixels of level k or more. n counts
    a component's pixels, zone and both those that are marked by 1.

    Blocks are labelled once for all masks, and hand on counts rather than pixels, and the pixels
    at their edges; components that meet at an edge are joined in one graph of all masks.
    """
    dealt = pixels.withColumn("_br", F.floor(F.col("row") / block)).withColumn("_bc", F.floor(F.col("col") / block))
    kind = dict(pixels.dtypes)["fire"]
    schema = f"fire {kind}, k int, label long, n long, zone long, both long, row long, col long"

    def tree(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        parts = []
        for lo, hi in zip(starts, [*starts[1:], len(pdf)], strict=True):
            rows, cols, level = (pdf[c].to_numpy(np.int64)[lo:hi] for c in ("row", "col", "level"))
            marks = [np.ones(hi - lo), *(pdf[c].to_numpy(float)[lo:hi] for c in ("zone", "both"))]
            number, fire = rows * (1 << 32) + cols, pdf["fire"].iloc[lo]
            edge = np.isin(rows % block, (0, block - 1)) | np.isin(cols % block, (0, block - 1))
            for k, root in block_tree(rows, cols, level):
                on = root >= 0
                own = np.flatnonzero(root == np.arange(len(root)))
                sums = [np.bincount(root[on], m[on], len(root))[own].astype(np.int64) for m in marks]
                none = pd.Series([None] * len(own), dtype="Int64")
                parts.append(pd.DataFrame({"fire": fire, "k": k, "label": number[own], **dict(zip(("n", "zone", "both"), sums, strict=True)), "row": none, "col": none}))
                e = np.flatnonzero(edge & on)
                parts.append(pd.DataFrame({"fire": fire, "k": k, "label": number[root[e]], "n": 0, "zone": 0, "both": 0, "row": pd.array(rows[e], "Int64"), "col": pd.array(cols[e], "Int64")}))
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({c: [] for c in ("fire", "k", "label", "n", "zone", "both", "row", "col")})

    nodes = written(map_groups(dealt, ["fire", "_br", "_bc"], ["row", "col"], tree, schema), "level_nodes")
    edge = nodes.where("row is not null").select("fire", "k", "row", "col", "label")
    steps = F.array(F.struct(F.lit(1).alias("dr"), F.lit(0).alias("dc")), F.struct(F.lit(0).alias("dr"), F.lit(1).alias("dc")))
    ahead = edge.select("fire", "k", F.col("label").alias("other"), F.explode(steps).alias("s"), "row", "col").select("fire", "k", "other", (F.col("row") + F.col("s.dr")).alias("row"), (F.col("col") + F.col("s.dc")).alias("col"))
    node = lambda c: F.struct("fire", "k", F.col(c).alias("label"))
    seams = edge.join(ahead, ["fire", "k", "row", "col"]).where("label <> other").select(node("label").alias("src"), node("other").alias("dst"))
    merged = connected_components(seams).select("node.fire", "node.k", "node.label", F.col("component.label").alias("_c"))
    whole = nodes.where("row is null").join(merged, ["fire", "k", "label"], "left")
    return whole.groupBy("fire", "k", F.coalesce("_c", "label").alias("component")).agg(*[F.sum(c).alias(c) for c in ("n", "zone", "both")]).drop("component")


def sweep(pairs: DataFrame, zone: DataFrame, truth: DataFrame, thresholds: tuple[float, ...] = THRESHOLDS, least_ha: float = LEAST_HA, block: int = BLOCK) -> DataFrame:
    """OP-A6: a row for each (fire, seuil): detected area in the zone, IoU, recall, precision and
    area error, in hectares and shares; zeros where nothing is detected. Components under
    ``least_ha`` go before the zone cuts them. ``pairs(fire, row, col, dnbr)``, a row a pixel; zone
    and truth ``(fire, row, col)``, the truth taken within the zone. Masks are nested, so a pixel
    goes through once, with the number of thresholds that it reaches."""
    cuts = sorted(thresholds)
    level = sum(((F.col("dnbr") >= F.lit(t).cast("float")).cast("int") for t in cuts), F.lit(-1))
    keys = ["fire", "row", "col"]
    true = truth.select(*keys).distinct().join(zone.select(*keys), keys, "left_semi")
    flag = lambda df, name: df.select(*keys).distinct().withColumn(name, F.lit(1))
    over = pairs.where(F.col("dnbr") >= F.lit(cuts[0]).cast("float")).select(*keys, level.alias("level"))
    marked = over.join(flag(zone, "zone"), keys, "left").join(flag(true, "both"), keys, "left").fillna(0, ["zone", "both"])
    inside = level_components(marked, block).where((F.col("n") * PIXEL_HA >= least_ha) & (F.col("zone") > 0))
    of = F.element_at(F.array(*[F.lit(thresholds.index(t)) for t in cuts]), F.col("k") + 1)
    hits = inside.groupBy("fire", of.alias("k")).agg(F.sum("zone").alias("detected"), F.sum("both").alias("both"), F.count("*").alias("n_polygones"))
    sizes = zone.select("fire").distinct().join(true.groupBy("fire").agg(F.count("*").alias("true")), "fire", "left").fillna(0, ["true"])
    every = sizes.select("fire", "true", F.posexplode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("k", "seuil"))
    all_rows = every.join(hits, ["fire", "k"], "left").fillna(0, ["detected", "both", "n_polygones"])
    union = F.col("detected") + F.col("true") - F.col("both")
    share = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return all_rows.select(
        "fire",
        "seuil",
        "n_polygones",
        (F.col("detected") * PIXEL_HA).alias("surface_detectee_ha"),
        share(F.col("both"), union).alias("iou"),
        share(F.col("both"), F.col("true")).alias("rappel"),
        share(F.col("both"), F.col("detected")).alias("precision"),
        F.when((F.col("true") > 0) & (F.col("detected") > 0), (F.col("detected") - F.col("true")) / F.col("true") * 100).otherwise(0.0).alias("ecart_surface_pct"),
    )


def best_threshold(results: DataFrame) -> DataFrame:
    """OP-A7: the threshold of the highest IoU of each fire, the first of equal ones."""
    return results.groupBy("fire").agg(F.max_by("seuil", F.struct("iou", -F.col("seuil"))).alias("seuil"), F.max("iou").alias("iou"))


def comparison_caps(zone: DataFrame, footprint: DataFrame, usable: DataFrame, truth: DataFrame) -> DataFrame:
    """OP-A8: share of the zone in the image, usable share of the zone, and the recall that masked
    truth leaves possible; all ``(fire, row, col)``."""
    keys = ["fire", "row", "col"]
    flag = lambda df, name: df.select(*keys).distinct().withColumn(name, F.lit(1))
    joined = zone.select(*keys).distinct().join(flag(footprint, "f"), keys, "left").join(flag(usable, "u"), keys, "left").join(flag(truth, "t"), keys, "left")
    both = F.sum(F.when(F.col("t").isNotNull() & F.col("u").isNotNull(), 1).otherwise(0))
    return joined.groupBy("fire").agg(
        (F.count("f") / F.count("*")).alias("part_couverte"),
        (F.count("u") / F.count("*")).alias("part_exploitable"),
        F.when(F.count("t") > 0, both / F.count("t")).otherwise(0.0).alias("rappel_plafond"),
    )


def classify_detections(labels: DataFrame, truth: DataFrame) -> DataFrame:
    """OP-J9: ``(fire, comp_id, on_fire)``: whether a component shares a pixel with the truth."""
    touching = labels.join(truth.select("fire", "row", "col"), ["fire", "row", "col"], "left_semi").select("fire", "comp_id").distinct().withColumn("on_fire", F.lit(True))
    return labels.select("fire", "comp_id").distinct().join(touching, ["fire", "comp_id"], "left").withColumn("on_fire", F.coalesce("on_fire", F.lit(False)))


def false_positive_report(comps: DataFrame) -> DataFrame:
    """OP-A11: per fire, of ``comps(fire, on_fire, area_ha, compactness)``."""
    off, on = ~F.col("on_fire"), F.col("on_fire")
    area = lambda c: F.coalesce(F.sum(F.when(c, F.col("area_ha"))), F.lit(0.0))
    sums = comps.groupBy("fire").agg(
        F.count_if(on).alias("n_on"),
        F.count_if(off).alias("n_off"),
        area(on).alias("area_on_ha"),
        area(off).alias("area_off_ha"),
        (area(off) / F.sum("area_ha") * 100).alias("off_pct"),
        F.max(F.when(off, F.col("area_ha"))).alias("max_off_ha"),
    )
    middles = {"median_off_ha": (off, "area_ha"), "compactness_on": (on, "compactness"), "compactness_off": (off, "compactness")}
    values = comps.select("fire", F.explode(F.array(*[F.struct(F.lit(n).alias("what"), F.when(c, F.col(v)).cast("double").alias("v")) for n, (c, v) in middles.items()])).alias("m")).select("fire", "m.*")
    found = medians(values, ["fire", "what"], "v").groupBy("fire").agg(*[F.max(F.when(F.col("what") == n, F.col("median"))).alias(n) for n in middles])
    joined = sums.join(found.withColumnRenamed("fire", "_fire"), F.col("fire").eqNullSafe(F.col("_fire")), "left")
    return joined.select("fire", "n_on", "n_off", "area_on_ha", "area_off_ha", "off_pct", "median_off_ha", "max_off_ha", "compactness_on", "compactness_off")


def assemble_products(parts: DataFrame, cells: DataFrame) -> DataFrame:
    """OP-A12: one row a product, of ``parts(produit, part_id, dmg_src_id)`` and their cells
    ``(part_id, cx, cy)``: number of parts, sorted different sources, area of the union (1 dp)."""
    ids = parts.groupBy("produit").agg(F.count_distinct("part_id").alias("n_polygones"), F.array_join(F.sort_array(F.collect_set("dmg_src_id")), ",").alias("dmg_src_id"))
    area = parts.join(cells, "part_id").select("produit", "cx", "cy").distinct().groupBy("produit").agg(F.round(F.count("*") * PIXEL_HA, 1).alias("surface_ha"))
    return ids.join(area, "produit", "left")


def attach_context(products: DataFrame, context: DataFrame, labels: DataFrame) -> DataFrame:
    """OP-J10: each product with its image context, by its code or by the code that the map has
    (RTP01_v2 for VECTORS_v1), blanks where neither is known; the fire's label from (activation,
    aoi), else the two joined."""
    fields = [c for c in context.columns if c != "produit"]
    first = context.select(F.col("produit").alias("_k1"), F.struct(*fields).alias("_a"))
    second = context.select(F.col("produit").alias("_k2"), F.struct(*fields).alias("_b"))
    out = products.join(first, F.col("produit") == F.col("_k1"), "left").join(second, F.replace("produit", F.lit("VECTORS_v1"), F.lit("RTP01_v2")) == F.col("_k2"), "left")
    out = out.withColumn("_c", F.coalesce("_a", "_b")).join(labels, ["activation", "aoi"], "left")
    return out.select(*products.columns, F.coalesce("feu", F.concat_ws("/", "activation", "aoi")).alias("feu"), *[F.coalesce(F.col("_c")[f], F.lit("")).alias(f) for f in fields])


def pick_aoi(products: DataFrame, aois: DataFrame) -> DataFrame:
    """OP-J11: ``(produit, aoi_id)``: the zone of the same product, else of the same activation and
    aoi (the smallest id of several)."""
    own = aois.groupBy("produit").agg(F.min("aoi_id").alias("_own"))
    same = aois.groupBy("activation", "aoi").agg(F.min("aoi_id").alias("_same"))
    return products.join(own, "produit", "left").join(same, ["activation", "aoi"], "left").select("produit", F.coalesce("_own", "_same").alias("aoi_id"))


def reference_keys(products: DataFrame) -> list[Column]:
    """OP-K5: by fire, date and type; equal ones by product or id, where there is that column."""
    return [F.col(c) for c in ("feu", "date_situation", "type_produit", *[c for c in ("produit", "id") if c in products.columns])]


def reference_order(products: DataFrame) -> DataFrame:
    """OP-K5: sorted by :func:`reference_keys`."""
    return products.orderBy(*reference_keys(products))


def declared_keys(fires: DataFrame) -> list[Column]:
    """OP-K5: by falling surface, unknown as 0; equal ones by alert, commune and INSEE code, as far
    as there are such columns."""
    return [F.coalesce("surface_ha", F.lit(0.0)).desc(), *[F.col(c) for c in ("alerte", "commune", "insee", "id") if c in fires.columns]]


def declared_order(fires: DataFrame) -> DataFrame:
    """OP-K5: declared fires, sorted by :func:`declared_keys`."""
    return fires.orderBy(*declared_keys(fires))
