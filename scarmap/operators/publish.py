"""Publication: matching, merging, labels, reserves, totals."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scarmap.functions.labels import day_month
from scarmap.operators.components import connected_components
from scarmap.operators.groups import map_groups
from scarmap.operators.overlap import overlapping_words, words_of_cells
from scarmap.operators.ranking import with_place
from scarmap.shared import discard, written

OVERLAP, MATCH_DAYS, ALERT_RATIO = 0.3, 10, 1.3
# Columns of the published table, in order.
CSV_COLUMNS = (
    "id feu statut commune departement surface_ha surface_min_ha surface_max_ha debut fin n_points_chauds image_avant image_apres "
    "latence_jours seuil_dnbr part_masquee prochain_passage calcule_le"
).split()


def overlaps(a: DataFrame, b: DataFrame, over: float = OVERLAP) -> DataFrame:
    """``(a_id, b_id, ratio)`` of zones ``(geom_id, cx, cy)`` that share more than ``over`` of the
    smaller one."""
    return overlapping_words(words_of_cells(a), words_of_cells(b), over)


def match_archive(clusters: DataFrame, cluster_cells: DataFrame, archive: DataFrame, archive_cells: DataFrame, days: int = MATCH_DAYS) -> DataFrame:
    """OP-J7, OP-W5: ``(cluster_id, id, ratio)``: the record that a cluster continues: it overlaps
    enough, and its last heat is at most ``days`` before the cluster's start (a later one matches);
    the largest overlap wins, then the earliest record, then the smaller id. Pairs are ranked where
    they are counted, so few of a cluster's are exchanged, however many records it meets."""
    day = lambda c: F.unix_date(F.col(c).cast("date")).cast("long")
    starts = clusters.select(F.col("cluster_id").alias("id"), (day("date_debut") - days).alias("since")).where("since is not null")
    ends = archive.select("id", "premier", day("dernier").alias("until")).where("until is not null")
    pairs = overlapping_words(words_of_cells(cluster_cells, "cluster_id"), words_of_cells(archive_cells, "id"), OVERLAP, starts, ends, ("since", "until"), ("premier", "b_id"))
    best = W.partitionBy("a_id").orderBy(F.desc("ratio"), "premier", "b_id")
    return pairs.withColumn("_n", F.row_number().over(best)).where("_n = 1").select(F.col("a_id").alias("cluster_id"), F.col("b_id").alias("id"), "ratio")


def union_cells(*zones: DataFrame) -> DataFrame:
    """OP-G1: the cells of any of the zones, once."""
    out = zones[0].select("cx", "cy")
    for z in zones[1:]:
        out = out.unionByName(z.select("cx", "cy"))
    return out.distinct()


def intersect_cells(a: DataFrame, b: DataFrame) -> DataFrame:
    """OP-G2: the cells of both."""
    return a.select("cx", "cy").intersect(b.select("cx", "cy"))


def subtract_cells(a: DataFrame, *scars: DataFrame) -> DataFrame:
    """OP-G3: the cells of ``a`` that no scar has."""
    out = a.select("cx", "cy").distinct()
    for s in scars:
        out = out.join(s.select("cx", "cy"), ["cx", "cy"], "left_anti")
    return out


def union_area_ha(cells: DataFrame, key: str = "fire", cell_m: int = 20) -> DataFrame:
    """OP-A9: area of a union of zones: each cell once, however many parts cover it."""
    return cells.select(key, "cx", "cy").distinct().groupBy(key).agg((F.count("*") * (cell_m * cell_m) / 10_000).alias("area_ha"))


#: Cells up to which a component of overlapping fires is merged in one task; larger ones go in rounds.
GROUP_CELLS = 1 << 18
#: What becomes of a fire: it is kept, its figures join a kept one's, or a measure stands for it.
KEPT, FUSED, DROPPED, REPLACED = "kept", "fused", "dropped", "replaced"
_DECISION = "slot {0}, id {0}, place long, fate string, under {0}, signal long"


def _decide(same: bool, home_measured: bool, n: int, n_home: int) -> tuple[str, int | None]:
    """Fate of a fire of n cells that overlaps a home of n_home cells, and the size of the estimate
    if it is over ALERT_RATIO times the measure."""
    if same:
        return FUSED, None
    estimate, measure = (n, n_home) if home_measured else (n_home, n)
    return DROPPED if home_measured else REPLACED, estimate if estimate > ALERT_RATIO * measure else None


def _merge_groups(pdf: pd.DataFrame, starts: np.ndarray, over: float) -> pd.DataFrame:
    out: list[tuple] = []
    for a, b in zip(starts, [*starts[1:], len(pdf)], strict=True):
        out += _merge_group(pdf.iloc[a:b], over)
    return pd.DataFrame(out, columns=["slot", "id", "place", "fate", "under", "signal"]).astype({"signal": "Int64"})


def _merge_group(pdf: pd.DataFrame, over: float) -> list[tuple]:
    homes: list[dict] = []
    out = []
    for r in pdf.itertuples():
        own = np.asarray(r.cells, np.int64)
        met = ((h, len(np.intersect1d(own, h["cells"], assume_unique=True))) for h in homes)
        home = next((h for h, n in met if n > over * min(len(own), len(h["cells"]))), None)
        if home is None:
            homes.append({"slot": r.id, "under": r.id, "measured": r.measured, "cells": own})
            out.append((r.id, r.id, r.place, KEPT, r.id, None))
            continue
        fate, signal = _decide(home["measured"] == r.measured, home["measured"], len(own), len(home["cells"]))
        if fate == FUSED:
            home["cells"] = np.union1d(home["cells"], own)
        elif fate == REPLACED:
            home |= {"under": r.id, "measured": True, "cells": own}
        out.append((home["slot"], r.id, r.place, fate, home["under"], signal))
    return out


def _merge_rounds(fires: DataFrame, cells: DataFrame, over: float, kind: str) -> DataFrame:
    """Decisions on ``fires(id, place, measured)`` in rounds of joins, for components too large for
    a task. In a round those are decided that no earlier open fire can bear upon: none is on one of
    their cells, nor on a cell of a home that they touch. They bear upon different homes, so one
    round of joins settles them as one after the other would. With sizes in no spatial order the
    rounds grow with the logarithm of the component; where each fire touches just the next smaller
    one, each waits for the one before, and the rounds are as many as the chain is long."""
    spark = fires.sparkSession
    open_ = written(cells.join(fires.select("id", "place", "measured"), "id"), "open")
    homes = spark.createDataFrame([], f"slot {kind}, slot_place long, under {kind}, home_measured boolean, cell long")
    decided = None
    while not open_.isEmpty():
        first = open_.groupBy("cell").agg(F.min("place").alias("first"))
        blocked = open_.join(first, "cell").where("first < place").select("id")
        touch = written(open_.select("id", "place", "cell").join(homes.select("slot", "cell"), "cell").groupBy("id", "place", "slot").agg(F.count("*").alias("both")), "touch")
        foremost = touch.groupBy("slot").agg(F.min("place").alias("first"))
        blocked = blocked.unionByName(touch.join(foremost, "slot").where("first < place").select("id")).distinct()
        ready = open_.join(blocked, "id", "left_anti").groupBy("id", "place", "measured").agg(F.count("*").alias("n"))
        sizes = homes.groupBy("slot", "slot_place", "under", "home_measured").agg(F.count("*").alias("n_home"))
        met = ready.join(touch.select("id", "slot", "both"), "id").join(sizes, "slot").where(F.col("both") > over * F.least("n", "n_home"))
        best = met.groupBy("id").agg(F.min_by(F.struct("slot", "slot_place", "under", "home_measured", "n_home"), "slot_place").alias("h"))
        joined = ready.join(best, "id", "left")
        same, measured = F.col("h.home_measured") == F.col("measured"), F.col("h.home_measured")
        fate = F.when(F.col("h").isNull(), KEPT).when(same, FUSED).when(measured, DROPPED).otherwise(REPLACED)
        estimate, measure = F.when(measured, F.col("n")).otherwise(F.col("h.n_home")), F.when(measured, F.col("h.n_home")).otherwise(F.col("n"))
        signal = F.when(~same & (estimate > ALERT_RATIO * measure), estimate)
        own = F.col("fate").isin(KEPT, REPLACED)
        now = joined.select(F.coalesce("h.slot", "id").alias("slot"), F.coalesce("h.slot_place", "place").alias("slot_place"), "id", "place", "measured", fate.alias("fate"), signal.alias("signal"), F.col("h.under").alias("was"))
        now = written(now.withColumn("under", F.when(own, F.col("id")).otherwise(F.col("was"))).drop("was"), "decided")
        gone = now.where(F.col("fate") == REPLACED).select("slot")
        more = open_.select("id", "cell").join(now.where(F.col("fate") != DROPPED), "id").select("slot", "slot_place", "under", F.col("measured").alias("home_measured"), "cell")
        homes_after = written(homes.join(gone, "slot", "left_anti").unionByName(more).distinct(), "homes")
        open_after = written(open_.join(now.select("id"), "id", "left_anti"), "open")
        discard(touch, homes, open_)
        homes, open_ = homes_after, open_after
        now = now.select("slot", "id", "place", "fate", "under", "signal")
        decided = now if decided is None else decided.unionByName(now)
    discard(homes, open_)
    return decided if decided is not None else spark.createDataFrame([], _DECISION.format(kind))


def merge_decisions(fires: DataFrame, cells: DataFrame, over: float = OVERLAP, group_cells: int = GROUP_CELLS) -> DataFrame:
    """OP-G4, OP-U5: ``(slot, id, place, fate, under, signal)`` for every fire of ``fires(id, statut,
    area)`` with cells ``(id, cx, cy)``.

    In the order of falling ``area`` (the sum of a fire's polygons; ties by id), place is the fire's
    number in it, each fire joins the first kept one whose zone so far shares more than ``over`` of
    the smaller of the two. Of one status the zones unite and it is ``fused``. Between a measure
    (no status is one) and an estimate the measure stays: a later estimate is ``dropped``, a later
    measure has ``replaced`` the estimate and what had joined it. ``under`` is the fire that holds
    the slot from then on, ``signal`` the cells of an estimate over 1.3 times the measure.

    Fires that share no cell, directly or through others, cannot meet. Components of up to
    ``group_cells`` cells are merged in a task each; larger ones in rounds of joins.
    A fire without cells is kept. Null ids are left out.
    """
    kind = dict(fires.dtypes)["id"]
    fires = fires.where("id is not null").select("id", "area", (F.coalesce("statut", F.lit("mesure")) == "mesure").alias("measured"))
    own = written(cells.select("id", F.shiftleft(F.col("cx").cast("long"), 32).bitwiseOR(F.col("cy").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).alias("cell")).distinct(), "fire_cells")
    least = own.groupBy("cell").agg(F.min("id").alias("least"))
    touching = own.join(least, "cell").where("id <> least").select(F.col("id").alias("src"), F.col("least").alias("dst")).distinct()
    comps = connected_components(touching)
    placed = fires.join(comps, fires["id"] == comps["node"], "left").select("id", "area", "measured", F.coalesce("component", "id").alias("component"))
    sizes = own.groupBy("id").agg(F.count("*").alias("n"))
    placed = written(placed.join(sizes, "id", "left"), "placed")
    whole = placed.groupBy("component").agg(F.sum("n").alias("total"))
    placed = written(with_place(placed.join(whole, "component"), F.desc("area"), F.col("id")), "ordered")
    small = placed.where(F.coalesce("total", F.lit(0)) <= group_cells)
    rows = small.join(own, "id", "left").groupBy("component", "id", "place", "measured").agg(F.sort_array(F.collect_list("cell")).alias("cells"))
    out = map_groups(rows, ["component"], ["place"], lambda pdf, starts: _merge_groups(pdf, starts, over), _DECISION.format(kind))
    large = placed.where(F.col("total") > group_cells)
    if large.isEmpty():
        return out
    bare = large.where("n is null").select(F.col("id").alias("slot"), "id", "place", F.lit(KEPT).alias("fate"), F.col("id").alias("under"), F.lit(None).cast("long").alias("signal"))
    return out.unionByName(_merge_rounds(large, own.join(large.select("id"), "id", "left_semi"), over, kind)).unionByName(bare)


def merge_duplicates(fires: DataFrame, cells: DataFrame, over: float = OVERLAP, cell_m: int = 20, group_cells: int = GROUP_CELLS) -> DataFrame:
    """OP-G4: the fires that stay, ``(id, feu, statut, n_points_chauds, premier, dernier, area_ha,
    fusionnes, alertes)``, of ``fires(id, feu, statut, area, n_points_chauds, premier, dernier)`` and
    cells ``(id, cx, cy)``, after :func:`merge_decisions`.

    A kept fire has its own points and those of the fires fused with it, the first and last of their
    dates, the area of the union of their cells, and their names; a measure that stands for a much
    larger estimate has an alert for it.
    """
    return merge_zones(fires, cells, over, cell_m, group_cells)[0]


def merge_zones(fires: DataFrame, cells: DataFrame, over: float = OVERLAP, cell_m: int = 20, group_cells: int = GROUP_CELLS) -> tuple[DataFrame, DataFrame]:
    """OP-G4: the result of :func:`merge_duplicates`, and the cells ``(id, cx, cy)`` of each fire
    that stays, its own and those of the fires fused with it, which can be parted again (OP-J8)."""
    decisions = written(merge_decisions(fires, cells, over, group_cells), "decisions")
    holder = decisions.groupBy("slot").agg(F.max_by("under", "place").alias("holder"))
    mine = written(decisions.join(holder, "slot").where((F.col("under") == F.col("holder")) & (F.col("fate") != DROPPED) | F.col("signal").isNotNull() & (F.col("under") == F.col("holder"))), "parts")
    counts = mine.where(F.col("fate") != DROPPED)
    text = F.concat(F.lit("chaleur détectée sur ~"), F.format_string("%.0f", F.col("signal") * (cell_m * cell_m) / 10_000), F.lit(" ha, au-delà du périmètre mesuré — le feu déborde probablement de l'image"))
    told = mine.where("signal is not null").groupBy("holder").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", text.alias("t")))), lambda x: x["t"]).alias("alertes"))
    facts = counts.join(fires.drop("area"), "id")
    own, named = F.col("id") == F.col("holder"), F.when(F.col("fate") == FUSED, F.struct("place", "feu"))
    sums = facts.groupBy(F.col("holder").alias("id")).agg(
        F.max(F.when(own, F.col("feu"))).alias("feu"),
        F.max(F.when(own, F.coalesce("statut", F.lit("mesure")))).alias("statut"),
        F.sum("n_points_chauds").alias("n_points_chauds"),
        F.min("premier").alias("premier"),
        F.max("dernier").alias("dernier"),
        F.transform(F.sort_array(F.collect_list(named)), lambda x: x["feu"]).alias("fusionnes"),
    )
    zone = written(counts.select("id", "holder").join(cells.select("id", "cx", "cy"), "id").select(F.col("holder").alias("id"), "cx", "cy").distinct(), "zones")
    area = zone.groupBy(F.col("id").alias("holder")).agg((F.count("*") * (cell_m * cell_m) / 10_000).alias("area_ha"))
    out = sums.join(area.withColumnRenamed("holder", "id"), "id", "left").join(told.withColumnRenamed("holder", "id"), "id", "left")
    out = out.select("id", "feu", "statut", "n_points_chauds", "premier", "dernier", F.coalesce("area_ha", F.lit(0.0)).alias("area_ha"), "fusionnes", F.coalesce("alertes", F.array().cast("array<string>")).alias("alertes"))
    return out, zone


# The French texts of sides and reserves below, and of the alert above.


def disambiguate(features: DataFrame) -> DataFrame:
    """OP-W6: ``feu`` with — nord/sud/est/ouest where several features ``(feu, x, y, …)`` share it."""
    group = W.partitionBy("feu")
    dx, dy = F.col("x") - F.avg("x").over(group), F.col("y") - F.avg("y").over(group)
    side = F.when(F.abs(dy) >= F.abs(dx), F.when(dy > 0, "nord").otherwise("sud")).otherwise(F.when(dx > 0, "est").otherwise("ouest"))
    return features.withColumn("feu", F.when(F.count("*").over(group) >= 2, F.concat("feu", F.lit(" — "), side)).otherwise(F.col("feu")))


def reserves(f: DataFrame) -> Column:
    """OP-F6: the ordered list of what limits a feature's figures, of the columns statut,
    motif_attente, part_masquee, fin and image_apres (ISO dates), n_isoles, fusionnes, alertes."""
    pending, none = F.col("statut") == "en_attente", F.array().cast("array<string>")
    merged = F.coalesce(F.col("fusionnes"), none)
    after = F.concat(
        F.lit("chaleur encore détectée le "), day_month(F.col("fin")), F.lit(", après l'image du "), day_month(F.col("image_apres")),
        F.lit(" — le périmètre s'arrête à cette image et sous-estime probablement la surface finale"),
    )
    ordered = F.array(
        F.when(pending, F.coalesce("motif_attente", F.lit("aucune image exploitable"))),
        F.when(pending, F.lit("emprise des points chauds, pas un périmètre brûlé mesuré")),
        F.when(F.col("part_masquee") > 0.05, F.format_string("%.0f%% de la zone masquée par les nuages ou la fumée", F.col("part_masquee") * 100)),
        F.when((F.col("image_apres") != "") & (F.col("fin") > F.col("image_apres")), after),
        F.when(F.col("n_isoles") > 0, F.concat(F.col("n_isoles").cast("string"), F.lit(" détections isolées écartées du périmètre"))),
        F.when(F.size(merged) > 0, F.concat(F.lit("détection fusionnée avec : "), F.array_join(merged, ", "))),
    )
    return F.concat(F.array_compact(ordered), F.coalesce(F.col("alertes"), none))


def to_features(records: DataFrame) -> DataFrame:
    """OP-F7: the 20 published properties of fire records: the columns of the flat table, then
    motif_attente and the list of reserves (OP-F6).

    Missing status is a measure; missing names, image dates and calcule_le are blank; the surface
    has one decimal. Images may be structs with a date, or dates. Columns that the records lack are
    null; they may also have n_isoles, fusionnes and alertes, for the reserves.
    """
    kinds = dict(records.dtypes)
    flat = records.withColumns({c: F.col(f"{c}.date") for c in ("image_avant", "image_apres") if kinds.get(c, "").startswith("struct")})
    needed = {c: "string" for c in (*CSV_COLUMNS, "motif_attente")} | {"surface_ha": "double", "part_masquee": "double", "n_isoles": "bigint", "fusionnes": "array<string>", "alertes": "array<string>"}
    flat = flat.withColumns({c: F.lit(None).cast(t) for c, t in needed.items() if c not in kinds})
    blank = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("feu", "commune", "departement", "image_avant", "image_apres", "calcule_le")}
    flat = flat.withColumns(blank | {"statut": F.coalesce("statut", F.lit("mesure")), "surface_ha": F.round(F.col("surface_ha").cast("double"), 1)})
    noted = flat.withColumns({"fin": F.col("fin").cast("string")}) if kinds.get("fin") == "date" else flat
    return noted.select(*CSV_COLUMNS, "motif_attente", reserves(noted).alias("reserves")) if noted is flat else noted.withColumn("reserves", reserves(noted)).withColumn("fin", F.col("fin").cast("date")).select(*CSV_COLUMNS, "motif_attente", "reserves")


def publication_keys() -> list[Column]:
    """OP-K3: pending first, then by falling surface, then by id."""
    return [F.col("statut") != "en_attente", F.desc_nulls_last("surface_ha"), F.col("id")]


def publication_order(features: DataFrame) -> DataFrame:
    """OP-K3: sorted by :func:`publication_keys`."""
    return features.orderBy(*publication_keys())


def publication_totals(features: DataFrame, isolated: DataFrame | None = None, hotspots: DataFrame | None = None) -> DataFrame:
    """OP-A13: ``(statut, n, total_ha)``: number and hectares of each status, then of the isolated
    detections ``(surface_ha, …)`` (``isole``) and the number of hot spots (``point_chaud``)."""
    total = F.coalesce(F.sum("surface_ha"), F.lit(0.0)).cast("double").alias("total_ha")
    out = features.groupBy("statut").agg(F.count("*").alias("n"), total)
    if isolated is not None:
        out = out.unionByName(isolated.agg(F.count("*").alias("n"), total).withColumn("statut", F.lit("isole")))
    if hotspots is not None:
        out = out.unionByName(hotspots.agg(F.count("*").alias("n")).select(F.lit("point_chaud").alias("statut"), "n", F.lit(None).cast("double").alias("total_ha")))
    return out
