"""Fire records: chains, authority, status merges, journal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scarmap.operators.ranking import with_running_in

GAP_DAYS, PENDING_DAYS, CHANGE, JOURNAL_MOST = 10, 21, 0.05, 200


def chain_records(archive: DataFrame, gap_days: int = GAP_DAYS) -> DataFrame:
    """OP-W1: ``archive(id, lieu, premier, dernier, …)`` with ``chain``, a number within the place.
    A record goes on with the chain if it begins within ``gap_days`` whole days of the latest end so
    far. Rows without a first date are left out, as unreadable records are.

    The latest end, and the number of chains, run on over ranges of the order, so a place of very
    many records is split over tasks."""
    order = [F.col("lieu").asc_nulls_first(), F.col("premier"), F.col("id").asc_nulls_first()]
    dated = archive.where("premier is not null")
    ends = with_running_in(dated, "lieu", order, {"_latest": ("dernier", F.max)}, own=False)
    new = ends.withColumn("_new", F.when(F.datediff("premier", "_latest") <= gap_days, 0).otherwise(1))
    return with_running_in(new, "lieu", order, {"chain": ("_new", F.sum)}).select(*archive.columns, "chain")


def consolidate(chains: DataFrame) -> DataFrame:
    """OP-W2: one row a chain: the record of authority (measured before others, then the latest
    computed, then the larger id), under the earliest record's id, over the chain's dates.

    ``ignored`` says that the authority's geometry is missing (column has_geometry, where there is
    one): such a chain is left intact, see :func:`after_consolidation`. Without an image the
    authority's own latency stays (column latence_jours, where there is one)."""
    have = set(chains.columns)
    best = F.struct((F.col("statut") == "mesure").alias("m"), F.col("calcule_le"), F.col("id"))
    first = F.struct("premier", "id")
    geometry = F.col("has_geometry") if "has_geometry" in have else F.lit(True)
    latency = F.col("latence_jours") if "latence_jours" in have else F.lit(None).cast("int")
    merged = chains.groupBy("lieu", "chain").agg(
        F.min_by("id", first).alias("id"),
        F.max_by("id", best).alias("authority"),
        F.max_by("statut", best).alias("statut"),
        F.max_by("surface_ha", best).alias("surface_ha"),
        F.min("premier").alias("premier"),
        F.max("dernier").alias("dernier"),
        F.max_by("image_apres", best).alias("image_apres"),
        F.count("*").alias("n_records"),
        (~F.coalesce(F.max_by(geometry, best), F.lit(False))).alias("ignored"),
        F.max_by(latency, best).alias("_own"),
    )
    return merged.withColumn("latence_jours", F.coalesce(F.datediff("image_apres", "premier"), "_own")).drop("_own")


def after_consolidation(chains: DataFrame, consolidated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """OP-W2: the archive ``(id, lieu, statut, surface_ha, premier, dernier, image_apres)`` and the
    renames ``(absorbed, survivor)`` for the journal (OP-L4): consolidated chains are one record,
    ignored ones keep all of theirs."""
    columns = ["id", "lieu", "statut", "surface_ha", "premier", "dernier", "image_apres"]
    fate = consolidated.select("lieu", "chain", F.col("id").alias("survivor"), "ignored")
    each = chains.join(fate, ["lieu", "chain"])
    archive = consolidated.where(~F.col("ignored")).select(*columns).unionByName(each.where("ignored").select(*columns))
    return archive, each.where(~F.col("ignored") & (F.col("id") != F.col("survivor"))).select(F.col("id").alias("absorbed"), "survivor")


def pending_fires(archive: DataFrame, done: DataFrame, today, days: int = PENDING_DAYS) -> DataFrame:
    """OP-P9: records that wait for an image, have an outline and heat of the last days, and were
    not handled in this run."""
    fresh = F.datediff(F.lit(today).cast("date"), "dernier") <= days
    return archive.where((F.col("statut") == "en_attente") & F.col("has_emprise") & fresh).join(done.select("id"), "id", "left_anti")


def top_pending(pending: DataFrame, n: int) -> DataFrame:
    """OP-K2: the n strongest pending fires, unknown strength last; ties to the smaller id."""
    return pending.orderBy(F.desc_nulls_last("frp_total"), "id").limit(n)


# Motives of the outcomes.
NO_AFTER = "aucune image satellite depuis le départ du feu"
CLOUDY_AFTER = "images trop couvertes par les nuages ou la fumée"
NO_BEFORE = "aucune image avant-feu exploitable pour la comparaison"
NO_TRACE = "images exploitables, mais aucune trace de brûlé au seuil retenu"
TOO_FAR = "traces de brûlé sur l'image, mais aucune près des points chauds"
NO_VEGETATION = "couvert végétal insuffisant avant le feu (NBR %.2f) — chaume, sol nu ou site industriel, pas un feu de végétation"


def decide_outcome(fires: DataFrame, max_gap_m: float = 3000, min_nbr: float = 0.20) -> DataFrame:
    """OP-L2: statut and motif of ``fires(n_after, n_clear_after, n_clear_before, n_components,
    nearest_m, nbr_median, …)``; the first condition that holds decides."""
    cases = [
        (F.coalesce("n_after", F.lit(0)) == 0, "en_attente", NO_AFTER),
        (F.coalesce("n_clear_after", F.lit(0)) == 0, "en_attente", CLOUDY_AFTER),
        (F.coalesce("n_clear_before", F.lit(0)) == 0, "en_attente", NO_BEFORE),
        (F.coalesce("n_components", F.lit(0)) == 0, "ecarte", NO_TRACE),
        (F.coalesce(F.col("nearest_m") > max_gap_m, F.lit(True)), "ecarte", TOO_FAR),
        (F.coalesce("nbr_median", F.lit(0.0)) < min_nbr, "ecarte", NO_VEGETATION),
    ]
    statut, motif = F.lit("mesure"), F.lit(None).cast("string")
    for condition, status, motive in reversed(cases):
        statut, motif = F.when(condition, status).otherwise(statut), F.when(condition, F.format_string(motive, F.coalesce("nbr_median", F.lit(0.0))) if "%" in motive else F.lit(motive)).otherwise(motif)
    return fires.withColumn("statut", statut).withColumn("motif", motif)


def merge_status(archive: DataFrame, today: DataFrame) -> DataFrame:
    """OP-L1 (and the records of OP-S5): the archive ``(id, statut, premier, dernier, surface_ha,
    surface_estimee_ha, motif, prochain_passage)`` after today's outcomes, same columns.

    A measure overwrites and drops the estimate; a pending outcome is not written over a measure; a
    discard changes only records that exist and are not measured. The first date kept is the
    archive's, the last the later one."""
    a, t = archive.alias("a"), today.alias("t")
    both = a.join(t, F.col("a.id") == F.col("t.id"), "full_outer")
    old, new = F.col("a.statut"), F.col("t.statut")
    take = F.when(new.isNull(), False).when(new == "mesure", True).when(new == "en_attente", F.coalesce(old != "mesure", F.lit(True))).otherwise(old.isNotNull() & (old != "mesure"))
    discard = take & (new == "ecarte")
    pick = lambda c: F.when(take, F.col(f"t.{c}")).otherwise(F.col(f"a.{c}"))
    out = both.where(old.isNotNull() | take).select(
        F.coalesce("a.id", "t.id").alias("id"),
        pick("statut").alias("statut"),
        F.coalesce("a.premier", "t.premier").alias("premier"),
        F.when(take, F.greatest("a.dernier", "t.dernier")).otherwise(F.col("a.dernier")).alias("dernier"),
        F.when(discard, F.col("a.surface_ha")).otherwise(pick("surface_ha")).alias("surface_ha"),
        F.when(take & (new == "mesure"), F.lit(None)).when(discard, F.col("a.surface_estimee_ha")).otherwise(pick("surface_estimee_ha")).alias("surface_estimee_ha"),
        pick("motif").alias("motif"),
        F.when(discard | (take & (new == "mesure")), F.lit(None)).otherwise(pick("prochain_passage")).alias("prochain_passage"),
    )
    return out


def journal_diff(published: DataFrame, state: DataFrame, events: DataFrame, now, change: float = CHANGE, most: int = JOURNAL_MOST) -> tuple[DataFrame, DataFrame]:
    """OP-L3, OP-K4: the journal's events and state after ``published(id, surface_ha, image)``.

    An unknown id is ``nouveau``; a change of ``change`` or more of a surface above 0 is
    ``agrandi`` or ``revise``. Ids no longer published lose their events and state; the newest
    ``most`` events are kept, new ones ahead of old ones of the same date."""
    now = now if isinstance(now, Column) else F.lit(now).cast("timestamp")
    before = state.select("id", F.col("surface_ha").alias("previous"))
    compared = published.join(before.withColumn("known", F.lit(True)), "id", "left")
    share = (F.col("surface_ha") - F.col("previous")) / F.col("previous")
    kind = F.when(F.col("known").isNull(), "nouveau").when((F.col("previous") > 0) & (F.abs(share) >= change), F.when(share > 0, "agrandi").otherwise("revise"))
    fresh = compared.withColumn("type", kind).where("type is not null").select(now.alias("date"), "type", "id", "surface_ha", F.col("previous").alias("surface_precedente"), "image", F.lit(0).alias("_old"))
    kept = events.join(published.select("id"), "id", "left_semi").select("date", "type", "id", "surface_ha", "surface_precedente", "image", F.lit(1).alias("_old"))
    newest = fresh.unionByName(kept).orderBy(F.desc("date"), "_old", "id", "type").limit(most).drop("_old")
    return newest, published.select("id", "surface_ha", "image", now.alias("vu_le"))


def carry_journal(events: DataFrame, state: DataFrame, renamed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """OP-L4: after a consolidation ``renamed(absorbed, survivor)``: events take the survivor's id,
    absorbed ids leave the state, and survivors' surface is 0, so that no growth is announced."""
    moved = events.join(renamed, events["id"] == renamed["absorbed"], "left")
    moved = moved.withColumn("_id", F.coalesce("survivor", "id")).drop("id", "absorbed", "survivor").withColumnRenamed("_id", "id")
    left = state.join(renamed, state["id"] == renamed["absorbed"], "left_anti")
    survivors = renamed.select(F.col("survivor").alias("_s")).distinct()
    left = left.join(survivors, left["id"] == F.col("_s"), "left").withColumn("surface_ha", F.when(F.col("_s").isNotNull(), 0.0).otherwise(F.col("surface_ha"))).drop("_s")
    return moved.select(*events.columns), left
