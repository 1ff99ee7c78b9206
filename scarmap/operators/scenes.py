"""Image choice: coverage, as-of joins and the next pass."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

COVERAGE, AFTER_TRIED, BEFORE_TRIED, BEFORE_DAYS, PASSES = 0.55, 6, 8, 60, 6
# Scene classes that say nothing of the ground.
UNUSABLE_SCL = (0, 1, 3, 6, 8, 9, 10, 11)


#: A coverage table ``(fire, scene_id, coverage)``, or a function that gives one for the ranked
#: candidates ``(fire, scene_id, tile, datetime, rank)``, so that only these are looked at.
Coverage = DataFrame | Callable[[DataFrame], DataFrame]


def scene_coverage(zones: DataFrame, scl: DataFrame, candidates: DataFrame | None = None) -> DataFrame:
    """OP-A2: ``(fire, scene_id, coverage)``: of the zone's pixels that the scene's tile has, the
    share of usable ones. ``zones(fire, tile, row, col)``, ``scl(scene_id, tile, row, col, scl)``.
    A pair without common pixels has no row; pick_* count that as 0. With ``candidates(fire,
    scene_id)`` only those pairs are read."""
    if candidates is not None:
        zones = zones.join(candidates.select("fire", "scene_id").distinct(), "fire")
    keys = ["tile", "row", "col"] if candidates is None else ["scene_id", "tile", "row", "col"]
    seen = zones.join(scl, keys)
    return seen.groupBy("fire", "scene_id").agg(F.avg((~F.col("scl").isin(*UNUSABLE_SCL)).cast("double")).alias("coverage"))


def _pick(ranked: DataFrame, coverage: Coverage, least: float) -> DataFrame:
    seen = coverage(ranked) if callable(coverage) else coverage
    tried = ranked.join(seen.select("fire", "scene_id", "coverage"), ["fire", "scene_id"], "left")
    clear = F.coalesce("coverage", F.lit(0.0)) >= least
    return tried.groupBy("fire").agg(
        F.count("*").alias("n_tried"),
        F.min_by(F.when(clear, F.col("scene_id")), F.when(clear, F.col("rank"))).alias("scene_id"),
        F.min_by(F.when(clear, F.col("tile")), F.when(clear, F.col("rank"))).alias("tile"),
    )


def _ranked(found: DataFrame, tried: int) -> DataFrame:
    """The newest scenes of each fire; the limit on the rank goes below the shuffle."""
    order = W.partitionBy("fire").orderBy(F.desc("datetime"), "scene_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= tried)


def _span(lo: Column, hi: Column, width: int) -> Column:
    return F.explode(F.sequence(F.floor(lo / width), F.floor(hi / width)))


def _day(c: str | Column) -> Column:
    return F.unix_date((F.col(c) if isinstance(c, str) else c).cast("date"))


def pick_post(fires: DataFrame, scenes: DataFrame, coverage: Coverage, least: float = COVERAGE, tried: int = AFTER_TRIED, bin_m: int = 20_000, bin_days: int = 15) -> DataFrame:
    """OP-J4, OP-W4: ``(fire, n_tried, scene_id, tile)``: of the newest ``tried`` scenes whose box
    meets the fire's, from its start to the day after ``now``, the first that is clear; null where
    none is. The rank is taken before the coverage is looked at. Fires without scenes have no row.

    ``fires(fire, start, now, xmin, ymin, xmax, ymax)``, ``scenes(scene_id, tile, datetime, …)``.
    They meet by an equi-join on squares of ``bin_m`` and spans of ``bin_days``, then exactly; a
    pair that shares several squares is kept in the first one only.
    """
    cut = lambda df, days: df.withColumn("_bx", _span(F.col("xmin"), F.col("xmax"), bin_m)).withColumn("_by", _span(F.col("ymin"), F.col("ymax"), bin_m)).withColumn("_bt", days)
    f = cut(fires, _span(_day("start"), _day("now") + 1, bin_days)).alias("f")
    s = cut(scenes.dropDuplicates(["scene_id", "tile"]), F.floor(_day("datetime") / bin_days)).alias("s")
    same = (F.col("f._bx") == F.col("s._bx")) & (F.col("f._by") == F.col("s._by")) & (F.col("f._bt") == F.col("s._bt"))
    meets = (F.col("f.xmin") <= F.col("s.xmax")) & (F.col("s.xmin") <= F.col("f.xmax")) & (F.col("f.ymin") <= F.col("s.ymax")) & (F.col("s.ymin") <= F.col("f.ymax"))
    first = lambda c: F.floor(F.greatest(F.col(f"f.{c}min"), F.col(f"s.{c}min")) / bin_m)
    once = (F.col("f._bx") == first("x")) & (F.col("f._by") == first("y"))
    when = (F.col("s.datetime") >= F.col("f.start")) & (F.col("s.datetime").cast("date") <= F.date_add(F.col("f.now").cast("date"), 1))
    found = f.join(s, same & once & meets & when).select("f.fire", "s.scene_id", "s.tile", "s.datetime")
    return _pick(_ranked(found, tried), coverage, least)


def pick_pre(fires: DataFrame, scenes: DataFrame, coverage: Coverage, least: float = COVERAGE, tried: int = BEFORE_TRIED, days: int = BEFORE_DAYS, strict_before: bool = False) -> DataFrame:
    """OP-J5, OP-W4: as pick_post, of the scenes of the after image's tile in the ``days`` days up
    to the start, that day included unless ``strict_before``. ``fires(fire, tile, start)``.

    The scenes of a tile in two spans of ``days`` days are one sorted array, as many as that time has,
    so a fire meets one row, whatever the length of the archive, and takes its first ones from it.
    """
    span = F.floor(_day("datetime") / days)
    newest = F.struct((-F.unix_micros(F.col("datetime").cast("timestamp"))).alias("order"), "scene_id", "datetime")
    held = scenes.where("datetime is not null").dropDuplicates(["scene_id", "tile"]).select("tile", F.explode(F.array(span, span + 1)).alias("_bt"), newest.alias("s"))
    held = held.groupBy("tile", "_bt").agg(F.sort_array(F.collect_list("s")).alias("held"))
    met = fires.select("fire", "tile", "start", F.floor(_day("start") / days).alias("_bt")).join(held, ["tile", "_bt"])
    first = F.date_sub(F.col("start").cast("date"), days)
    until = (lambda s: s["datetime"] < F.col("start")) if strict_before else (lambda s: s["datetime"].cast("date") <= F.col("start").cast("date"))
    within = F.filter("held", lambda s: until(s) & (s["datetime"].cast("date") >= first))
    found = met.select("fire", "tile", F.posexplode(F.slice(within, 1, tried)).alias("rank", "s"))
    return _pick(found.select("fire", "s.scene_id", "tile", "s.datetime", (F.col("rank") + 1).alias("rank")), coverage, least)


def attach_commune(clusters: DataFrame, communes: DataFrame) -> DataFrame:
    """OP-J3: clusters with the commune of their centre's cell; a centre in none (abroad) drops the
    cluster. ``clusters(cluster_id, cx, cy, …)``, ``communes(cx, cy, commune, departement)``."""
    return clusters.join(communes, ["cx", "cy"])


def next_pass(scenes: DataFrame, today, passes: int = PASSES) -> DataFrame:
    """OP-W3: ``(place, next_pass)`` of ``scenes(place, datetime)``: the last pass and as many
    steps as reach ``today``, a step being the longest of the last gaps; null under three dates."""
    dates = scenes.select("place", F.to_date("datetime").alias("d")).distinct()
    order = W.partitionBy("place").orderBy("d")
    gaps = dates.withColumn("gap", F.datediff("d", F.lag("d").over(order))).withColumn("recent", F.row_number().over(W.partitionBy("place").orderBy(F.desc("d"))))
    step = F.max(F.when(F.col("recent") <= passes, F.col("gap")))
    of = gaps.groupBy("place").agg(F.max("d").alias("last"), F.count("*").alias("n"), step.alias("step"))
    ahead = F.greatest(F.lit(1), F.ceil(F.datediff(F.lit(today).cast("date"), "last") / F.col("step")).cast("int"))
    return of.select("place", F.when(F.col("n") >= 3, F.date_add("last", (ahead * F.col("step")).cast("int"))).alias("next_pass"))
