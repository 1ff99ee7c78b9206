"""The whole detection: from hot spots to today's fire records, and the day's run with the archive after it."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scarmap.functions import geo, labels
from scarmap.operators import burn, hotspots, outlines, publish, records, scenes
from scarmap.shared import discard, written

MARGIN_M = 6000
#: Days of scenes that tell when the next one is due.
RECENT_DAYS = 120

#: Reads windows ``(scene_id, tile, row0, row1, col0, col1, …)`` of images: gives ``(scene_id, tile,
#: row, col, b8a, b12, scl)`` of their pixels, once for each scene. Rows and columns are cells of the
#: Lambert-93 lattice.
Reader = Callable[[DataFrame], DataFrame]


def table_reader(pixels: DataFrame) -> Reader:
    """The reader of a table of pixels. Windows are few (some a fire), so Spark mostly sends them to
    where the pixels are, and the scan of a table partitioned by scene reads those scenes only."""

    def read(windows: DataFrame) -> DataFrame:
        w = windows.select(F.col("scene_id").alias("_s"), "row0", "row1", "col0", "col1").distinct()
        inside = (F.col("scene_id") == F.col("_s")) & F.col("row").between(F.col("row0"), F.col("row1")) & F.col("col").between(F.col("col0"), F.col("col1"))
        return pixels.join(w, inside).select(*pixels.columns).dropDuplicates(["scene_id", "tile", "row", "col"])

    return read


def detect(
    points: DataFrame,
    communes: DataFrame,
    catalogue: DataFrame,
    read: Reader,
    now,
    archive: DataFrame | None = None,
    archive_cells: DataFrame | None = None,
    most_fires: int = 10,
    least_points: int = 5,
    commune_m: int = 1000,
    threshold: float = burn.THRESHOLD,
) -> DataFrame:
    """Today's records of the ``most_fires`` strongest fires of ``points(point_id, x_m, y_m, acq_date,
    frp, confidence)``: OP-J1, A1, K1, J2, A10, J3, J7, J4, J5, A2, J6, A3, J8, A4, A5, L2 in turn.

    ``communes(cx, cy, commune, departement)`` has cells of ``commune_m``; a fire whose centre is in
    none is abroad and dropped. ``catalogue(scene_id, tile, datetime, xmin, ymin, xmax, ymax)`` lists
    the images. A fire that goes on with one of the ``archive(id, premier, dernier)``, of zones
    ``archive_cells(id, cx, cy)``, has that record's id.

    Images are looked at late: coverage is read for the ranked candidates only, bands for the two
    images chosen, all within the fire's box. Columns: id, cluster_id, statut, motif, commune,
    departement, premier, dernier, n_points_chauds, frp_total, surface_ha, n_polygones, image_avant,
    image_apres, tuile, part_masquee, nbr_avant_median, latence_jours, surface_estimee_ha,
    surface_min_ha, surface_max_ha, prochain_passage.
    """
    fires, cells = _fires_of_today(points, communes, archive, archive_cells, most_fires, least_points, commune_m)
    out, _, tables = _examined(fires, cells, catalogue, read, now, threshold)
    discard(*tables, fires, cells)
    return out.drop("fire")


def _placed(fires: DataFrame, cells: DataFrame) -> DataFrame:
    """``fires(fire, …)`` with the centre of their cells, x and y, and the box of these."""
    middle = lambda c: (F.avg(c) + 0.5) * geo.CELL_M
    box = [f(c).alias(f"{n}{c}") for f, n in ((F.min, "lo_"), (F.max, "hi_")) for c in ("cx", "cy")]
    return fires.join(cells.groupBy("fire").agg(middle("cx").alias("x"), middle("cy").alias("y"), *box), "fire")


def _fires_of_today(points, communes, archive, archive_cells, most_fires: int, least_points: int, commune_m: int) -> tuple[DataFrame, DataFrame]:
    """The strongest fires of the hot spots, placed and named, and their cells ``(fire, cx, cy)``; both are written."""
    kept, members = hotspots.clustered(points)
    top = written(hotspots.top_fires(hotspots.summarize_clusters(kept, members), most_fires, least_points), "top")
    cells = written(hotspots.hot_footprint(hotspots.zone_points(top, kept, members).withColumnRenamed("cluster_id", "fire")), "zones")
    centred = _placed(top.withColumn("fire", F.col("cluster_id")), cells).withColumns({"cx": F.floor(F.col("x") / commune_m), "cy": F.floor(F.col("y") / commune_m)})
    fires = scenes.attach_commune(centred, communes).drop("cx", "cy")
    lon, lat = geo.lonlat(F.col("x"), F.col("y"))
    fires = fires.withColumn("id", labels.fire_id(F.col("date_debut"), F.col("commune"), F.col("departement"), lat, lon))
    if archive is not None:
        same = publish.match_archive(fires.select("cluster_id", "date_debut"), cells.withColumnRenamed("fire", "cluster_id"), archive, archive_cells).select("cluster_id", F.col("id").alias("_known"))
        fires = fires.join(same, "cluster_id", "left").withColumn("id", F.coalesce("_known", "id")).drop("_known")
    named = written(fires, "named")
    discard(top)
    return named, cells


def _examined(fires: DataFrame, cells: DataFrame, catalogue: DataFrame, read: Reader, now, threshold: float) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """The records of ``fires``, with column fire; the burnt pixels of each, ``(fire, comp_id, row, col)``,
    and the written tables that these are read from."""
    side = geo.CELL_M
    edge = {f"{a}{b}": (F.col(f"{'lo' if b == 'min' else 'hi'}_c{a}") + (0 if b == "min" else 1)) * side + (-MARGIN_M if b == "min" else MARGIN_M) for a in "xy" for b in ("min", "max")}
    fires = written(fires.withColumns(edge).withColumns({"start": F.col("date_debut"), "now": F.lit(now).cast("date")}), "fires")
    window = {"row0": F.col("lo_cy"), "row1": F.col("hi_cy"), "col0": F.col("lo_cx"), "col1": F.col("hi_cx")}

    def coverage(candidates: DataFrame) -> DataFrame:
        found = written(candidates.select("fire", "scene_id", "tile"), "candidates")
        seen = read(found.join(fires.select("fire", *[e.alias(n) for n, e in window.items()]), "fire"))
        zone = found.select("fire", "tile").distinct().join(cells.select("fire", F.col("cy").alias("row"), F.col("cx").alias("col")), "fire")
        return scenes.scene_coverage(zone, seen.select("scene_id", "tile", "row", "col", "scl"), found)

    post = written(scenes.pick_post(fires, catalogue, coverage), "post")
    pre = written(scenes.pick_pre(fires.join(post.where("scene_id is not null").select("fire", "tile"), "fire"), catalogue, coverage), "pre")

    def image(chosen: DataFrame) -> DataFrame:
        box = chosen.where("scene_id is not null").select("fire", "scene_id", "tile").join(fires.select("fire", *[e.alias(n) for n, e in window.items()]), "fire")
        here = box.select("fire", F.col("scene_id").alias("_s"), *window)
        inside = (F.col("scene_id") == F.col("_s")) & F.col("row").between(F.col("row0"), F.col("row1")) & F.col("col").between(F.col("col0"), F.col("col1"))
        return read(box).join(here, inside).select("fire", "tile", "row", "col", "b8a", "b12", "scl")

    pairs = written(burn.pixel_pairs(image(pre), image(post)), "pairs")
    found = burn.burn_components(burn.burn_mask(pairs, threshold))
    areas = burn.component_areas(found)
    large = written(found.join(areas.select("fire", "comp_id"), ["fire", "comp_id"], "left_semi"), "components")
    zone = cells.select("fire", F.col("cy").alias("row"), F.col("cx").alias("col"))
    near = written(burn.attach_components(large, zone), "near")
    mine = written(large.join(near.select("fire", "comp_id"), ["fire", "comp_id"], "left_semi"), "burnt")
    detected = pairs.join(mine.select("fire", "row", "col", F.lit(True).alias("detected")), ["fire", "row", "col"], "left").withColumn("detected", F.coalesce("detected", F.lit(False)))
    masked = burn.masked_share(zone.join(pairs.select("fire", "row", "col", "usable"), ["fire", "row", "col"], "left"))
    facts = fires.join(post.select("fire", F.col("n_tried").alias("n_after"), F.col("scene_id").alias("image_apres"), F.col("tile").alias("tuile")), "fire", "left")
    facts = facts.join(pre.select("fire", F.col("scene_id").alias("image_avant")), "fire", "left")
    facts = facts.join(large.groupBy("fire").agg(F.count_distinct("comp_id").alias("n_components")), "fire", "left").join(near.groupBy("fire").agg(F.min("distance_m").alias("nearest_m")), "fire", "left")
    facts = facts.join(mine.groupBy("fire").agg(F.count("*").alias("burnt"), F.count_distinct("comp_id").alias("n_polygones")), "fire", "left").join(burn.median_nbr(detected), "fire", "left").join(masked, "fire", "left")
    facts = facts.withColumns({"n_clear_after": F.col("image_apres").isNotNull().cast("int"), "n_clear_before": F.col("image_avant").isNotNull().cast("int")})
    told = records.decide_outcome(facts).join(hotspots.footprint_estimate(cells), "fire")
    days = catalogue.select(F.col("scene_id").alias("image_apres"), F.col("datetime").cast("date").alias("_day")).distinct()
    told = told.join(days, "image_apres", "left").join(_passes(fires, catalogue, now), "fire", "left")
    measured, pending = F.col("statut") == "mesure", F.col("statut") == "en_attente"
    when = lambda c, e, n: F.when(c, e).alias(n)
    out = told.select(
        "fire", "id", "cluster_id", "statut", "motif", "commune", "departement", F.col("date_debut").alias("premier"), F.col("date_fin").alias("dernier"), F.col("n_points").alias("n_points_chauds"), "frp_total",
        when(measured, F.round(F.col("burnt") * 0.04, 1), "surface_ha"), when(measured, F.col("n_polygones"), "n_polygones"), when(measured, F.col("image_avant"), "image_avant"), when(measured, F.col("image_apres"), "image_apres"),
        when(measured, F.col("tuile"), "tuile"), when(measured, F.col("part_masquee"), "part_masquee"), when(measured, F.col("nbr_median"), "nbr_avant_median"), when(measured, labels.latency_days(F.col("_day"), F.col("date_debut")), "latence_jours"),
        *[when(~measured, F.col(c), c) for c in ("surface_estimee_ha", "surface_min_ha", "surface_max_ha")], when(pending, F.col("next_pass"), "prochain_passage"),
    )
    out = written(out, "records")
    discard(post, pre, pairs, large, near)
    return out, mine, [fires, mine]


class Day(NamedTuple):
    """What a day's run leaves: its records, the archive and its zones after it, the outlines of its measured fires."""

    records: DataFrame
    archive: DataFrame
    cells: DataFrame
    outlines: DataFrame


#: What the archive tells of a fire, beside its state.
FACTS = ["commune", "departement", "n_points_chauds", "frp_total"]


def daily(
    points: DataFrame,
    communes: DataFrame,
    catalogue: DataFrame,
    read: Reader,
    now,
    archive: DataFrame,
    archive_cells: DataFrame,
    most_fires: int = 10,
    least_points: int = 5,
    retry_days: int = records.PENDING_DAYS,
    commune_m: int = 1000,
    threshold: float = burn.THRESHOLD,
) -> Day:
    """The day's run: :func:`detect` of the hot spots, the fires still waiting for an image tried again
    (OP-P9, K2), and the outcomes of both taken into the archive (OP-L1, S5). Fires of either sort go
    through the images together.

    ``archive(id, statut, premier, dernier, surface_ha, surface_estimee_ha, motif, prochain_passage,
    commune, departement, n_points_chauds, frp_total)`` has one row an id, ``archive_cells(id, cx, cy)``
    the zones. A waiting fire is tried on its zone in the archive, with the archive's facts, unless it
    has none, is too long without heat, or burns today. Of several fires of today under one id a
    measured one speaks for it, then the weakest, which is the last one looked at.

    The new zone of a measured fire is its burnt pixels, that of one that waits its footprint; a
    discarded or unmentioned record keeps its own, and so does a measured one that now waits. ``outlines(id, …)`` are
    multipolygons of the measured zones. Nulls among the facts stay null; an empty archive, no hot
    spots or no images give what the others tell.
    """
    fires, cells = _fires_of_today(points, communes, archive, archive_cells, most_fires, least_points, commune_m)
    with_zone = archive_cells.select("id").distinct().withColumn("has_emprise", F.lit(True))
    flagged = archive.join(with_zone, "id", "left").withColumn("has_emprise", F.coalesce("has_emprise", F.lit(False)))
    waiting = written(records.top_pending(records.pending_fires(flagged, fires, now, retry_days), most_fires), "waiting")
    # one sort of key for both: a cluster's number and a record's id
    today = lambda df: df.withColumn("fire", F.concat(F.lit("c"), F.col("fire").cast("string")))
    again = lambda df: df.withColumn("fire", F.concat(F.lit("a"), F.col("id").cast("string")))
    old_cells = again(archive_cells.join(waiting.select("id"), "id", "left_semi")).select("fire", "cx", "cy").distinct()
    zones = written(today(cells).select("fire", "cx", "cy").unionByName(old_cells), "day_zones")
    old = again(waiting).select(
        "fire", "id", "commune", "departement", F.col("premier").alias("date_debut"), F.col("dernier").alias("date_fin"), F.col("n_points_chauds").alias("n_points"), "frp_total"
    )
    both = today(fires).unionByName(_placed(old, zones), allowMissingColumns=True)
    told, burnt, tables = _examined(both, zones, catalogue, read, now, threshold)
    speaks = W.partitionBy("id").orderBy((F.col("statut") == "mesure").desc(), F.asc_nulls_last("frp_total"), F.desc("fire"))
    told = written(told.withColumn("_n", F.row_number().over(speaks)).where("_n = 1").drop("_n"), "day_records")

    state = records.merge_status(archive, told)
    before = archive.select("id", F.col("statut").alias("_old"))
    # outcomes that bring facts and a zone of their own: a discard doesn't, nor does waiting after a measure
    rules = (F.col("statut") == "mesure") | ((F.col("statut") == "en_attente") & F.coalesce(F.col("_old") != "mesure", F.lit(True)))
    fresh = written(told.join(before, "id", "left").where(rules), "fresh")
    facts = archive.select("id", *FACTS).join(fresh.select("id"), "id", "left_anti").unionByName(fresh.select("id", *FACTS))
    after = written(state.join(facts, "id", "left"), "day_archive")

    measured = fresh.where("statut = 'mesure'").select("fire", "id")
    perimeters = burnt.join(measured, "fire").select("id", F.col("col").alias("cx"), F.col("row").alias("cy"))
    footprints = zones.join(fresh.where("statut = 'en_attente'").select("fire", "id"), "fire").select("id", "cx", "cy")
    kept = archive_cells.select("id", "cx", "cy").join(fresh.select("id"), "id", "left_anti")
    new_cells = written(kept.unionByName(perimeters).unionByName(footprints), "day_cells")
    named = burnt.join(measured, "fire").drop("fire").withColumnRenamed("id", "fire")
    rings = outlines.multipolygons(outlines.outlines(named, outlines.PERIMETER_M), "fire").withColumnRenamed("fire", "id")
    shapes = written(rings, "day_outlines")
    discard(*tables, fires, cells, waiting, zones, fresh)
    return Day(told.drop("fire"), after, new_cells, shapes)


def _passes(fires: DataFrame, catalogue: DataFrame, now) -> DataFrame:
    """``(fire, next_pass)`` over the scenes of the last RECENT_DAYS whose box meets the fire's: six
    gaps between passes are wanted, so older scenes say nothing. Boxes meet by squares of 20 km."""
    recent = catalogue.where(F.datediff(F.lit(now).cast("date"), F.col("datetime").cast("date")) <= RECENT_DAYS)
    f, s = fires.select("fire", "xmin", "xmax", "ymin", "ymax"), recent
    meets = (F.col("f.xmin") <= F.col("s.xmax")) & (F.col("s.xmin") <= F.col("f.xmax")) & (F.col("f.ymin") <= F.col("s.ymax")) & (F.col("s.ymin") <= F.col("f.ymax"))
    span = lambda c: F.explode(F.sequence(F.floor(F.col(f"{c}min") / 20_000), F.floor(F.col(f"{c}max") / 20_000)))
    cut = lambda df: df.withColumn("_bx", span("x")).withColumn("_by", span("y"))
    seen = cut(f).alias("f").join(cut(s).alias("s"), (F.col("f._bx") == F.col("s._bx")) & (F.col("f._by") == F.col("s._by")) & meets).select(F.col("f.fire").alias("place"), "s.datetime").distinct()
    return scenes.next_pass(seen, now).withColumnRenamed("place", "fire")
