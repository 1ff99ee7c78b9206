"""Queries of records, text and streams over the driver's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from scarmap.functions import labels
from scarmap.jobs.inputs import cte, view
from scarmap.operators import publish, records, textjobs, validate
from scarmap.operators.ranking import with_place
from scarmap.shared import fresh_path
from scarmap.streaming import fires as streams

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    """WITH c AS (SELECT c_custkey AS id, DATE '2024-01-01' + CAST(c_custkey % 300 AS INTEGER) AS d, concat('Saint-', c_mktsegment, ' l''été ', c_name) AS n, CASE WHEN c_nationkey % 4 = 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS dep, 41 + c_custkey % 1000 AS la, c_custkey % 700 AS lo FROM customer)
    SELECT id, concat(strftime(d, '%Y%m%d'), '-', coalesce(dep, '00'), '-', left(replace(lower(n), ' ', '-'), 24), '-', la, '25', lo, '75') AS fire_id,
    concat(coalesce(dep, '00'), '-', left(replace(lower(n), ' ', '-'), 24), '-', la, '25', lo, '75') AS lieu, strftime(d, '%d/%m') AS jour FROM c"""
)
def f1_f2_f5_labels(spark, sf_dir):
    c = _table(spark, sf_dir, "customer")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 300).cast("int"))
    name = F.concat(F.lit("Saint-"), "c_mktsegment", F.lit(" l'été "), "c_name")
    dep = F.when(F.col("c_nationkey") % 4 != 0, F.col("c_nationkey").cast("string"))
    fid = labels.fire_id(day, name, dep, 41 + F.col("c_custkey") % 1000 + 0.25, -(F.col("c_custkey") % 700) - 0.75)
    return c.select(F.col("c_custkey").alias("id"), fid.alias("fire_id"), labels.place_key(fid).alias("lieu"), labels.day_month(day.cast("string")).alias("jour"))


@query("WITH p AS (SELECT p_partkey AS id, concat('EMSR', 500 + p_size, '_AOI0', p_partkey % 9, '_', p_type, '_PRODUCT_r1_', CASE WHEN p_partkey % 2 = 0 THEN 'RTP01_v2' ELSE 'VECTORS_v1' END) AS code FROM part) SELECT id, split_part(code, '_', 1) AS activation, split_part(code, '_', 2) AS aoi, split_part(code, '_', 3) AS type_produit, regexp_replace(code, '_(RTP[0-9]+|VECTORS)_v[0-9]+$', '') AS produit FROM p")
def f3_product_parts(spark, sf_dir):
    code = F.concat(F.lit("EMSR"), (F.col("p_size") + 500).cast("string"), F.lit("_AOI0"), (F.col("p_partkey") % 9).cast("string"), F.lit("_"), "p_type", F.lit("_PRODUCT_r1_"), F.when(F.col("p_partkey") % 2 == 0, "RTP01_v2").otherwise("VECTORS_v1"))
    return _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), labels.product_parts(code).alias("p")).select("id", "p.*")


_CHAIN = (
    cte("records")
    + """, l AS (SELECT *, max(dernier) OVER (PARTITION BY lieu ORDER BY premier, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM records),
    c AS (SELECT *, sum(CASE WHEN date_diff('day', latest, premier) <= 10 THEN 0 ELSE 1 END) OVER (PARTITION BY lieu ORDER BY premier, id ROWS UNBOUNDED PRECEDING) AS chain FROM l) """
)


@query(_CHAIN + "SELECT id, lieu, CAST(chain AS BIGINT) AS chain FROM c")
def w1_chains(spark, sf_dir):
    return records.chain_records(view(spark, sf_dir, "records")).select("id", "lieu", "chain")


@query(
    _CHAIN + """, b AS (SELECT *, row_number() OVER (PARTITION BY lieu, chain ORDER BY (statut = 'mesure') DESC, calcule_le DESC, id DESC) AS best, row_number() OVER (PARTITION BY lieu, chain ORDER BY premier, id) AS fst FROM c)
    SELECT lieu, CAST(chain AS BIGINT) AS chain, max(id) FILTER (WHERE fst = 1) AS id, max(id) FILTER (WHERE best = 1) AS authority, max(statut) FILTER (WHERE best = 1) AS statut, max(surface) FILTER (WHERE best = 1) AS surface_ha, min(premier) AS premier, max(dernier) AS dernier, max(image_apres) FILTER (WHERE best = 1) AS image_apres, count(*) AS n_records,
    date_diff('day', min(premier), max(image_apres) FILTER (WHERE best = 1)) AS latence_jours, NOT bool_or(has_emprise) FILTER (WHERE best = 1) AS ignored FROM b GROUP BY lieu, chain"""
)
def w2_f4_consolidate(spark, sf_dir):
    return records.consolidate(_chains(spark, sf_dir))


def _chains(spark, sf_dir):
    return records.chain_records(view(spark, sf_dir, "records").withColumnsRenamed({"surface": "surface_ha", "has_emprise": "has_geometry"}))


@query(
    _CHAIN + """, b AS (SELECT *, row_number() OVER (PARTITION BY lieu, chain ORDER BY (statut = 'mesure') DESC, calcule_le DESC, id DESC) AS best, row_number() OVER (PARTITION BY lieu, chain ORDER BY premier, id) AS fst FROM c),
    g AS (SELECT lieu, chain, bool_or(has_emprise) FILTER (WHERE best = 1) AS whole, max(id) FILTER (WHERE fst = 1) AS survivor FROM b GROUP BY lieu, chain)
    SELECT 'record' AS kind, survivor AS id, survivor AS other FROM g WHERE whole UNION ALL SELECT 'record', b.id, b.id FROM b JOIN g ON g.lieu = b.lieu AND g.chain = b.chain WHERE NOT whole
    UNION ALL SELECT 'renamed', b.id, survivor FROM b JOIN g ON g.lieu = b.lieu AND g.chain = b.chain WHERE whole AND b.id <> survivor"""
)
def w2_after_consolidation(spark, sf_dir):
    chains = _chains(spark, sf_dir)
    archive, renamed = records.after_consolidation(chains, records.consolidate(chains))
    return archive.select(F.lit("record").alias("kind"), "id", F.col("id").alias("other")).unionByName(renamed.select(F.lit("renamed").alias("kind"), F.col("absorbed").alias("id"), F.col("survivor").alias("other")))


_PENDING = cte("records") + ", p AS (SELECT id, surface AS frp_total FROM records WHERE statut = 'en_attente' AND has_emprise AND date_diff('day', dernier, DATE '1999-06-01') <= 21 AND id NOT IN (SELECT id FROM records WHERE lieu % 10 = 0)) "


def _pending(spark, sf_dir):
    r = view(spark, sf_dir, "records").withColumnRenamed("surface", "frp_total")
    return records.pending_fires(r, r.where("lieu % 10 = 0"), "1999-06-01")


@query(_PENDING + "SELECT id FROM p")
def p9_pending(spark, sf_dir):
    return _pending(spark, sf_dir).select("id")


@query(_PENDING + "SELECT id, frp_total FROM p ORDER BY frp_total DESC NULLS LAST, id LIMIT 25")
def k2_top_pending(spark, sf_dir):
    return records.top_pending(_pending(spark, sf_dir), 25).select("id", "frp_total")


@query(
    """WITH f AS (SELECT o_orderkey AS fire, o_orderkey % 5 AS na, o_orderkey % 3 AS ca, o_custkey % 4 AS cb, o_custkey % 6 AS nc, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE (o_orderkey * 7) % 4000 END AS gap, CAST(o_custkey % 40 AS DOUBLE) / 100 AS nm FROM orders)
    SELECT fire, CASE WHEN na = 0 OR ca = 0 OR cb = 0 THEN 'en_attente' WHEN nc = 0 OR gap IS NULL OR gap > 3000 OR nm < 0.20 THEN 'ecarte' ELSE 'mesure' END AS statut,
    CASE WHEN na = 0 THEN 'aucune image satellite depuis le départ du feu' WHEN ca = 0 THEN 'images trop couvertes par les nuages ou la fumée' WHEN cb = 0 THEN 'aucune image avant-feu exploitable pour la comparaison'
         WHEN nc = 0 THEN 'images exploitables, mais aucune trace de brûlé au seuil retenu' WHEN gap IS NULL OR gap > 3000 THEN 'traces de brûlé sur l''image, mais aucune près des points chauds'
         WHEN nm < 0.20 THEN concat('couvert végétal insuffisant avant le feu (NBR ', printf('%.2f', nm), ') — chaume, sol nu ou site industriel, pas un feu de végétation') END AS motif FROM f"""
)
def l2_outcomes(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    f = _table(spark, sf_dir, "orders").select(k.alias("fire"), (k % 5).alias("n_after"), (k % 3).alias("n_clear_after"), (c % 4).alias("n_clear_before"), (c % 6).alias("n_components"), F.when(k % 13 != 0, k * 7 % 4000).alias("nearest_m"), ((c % 40).cast("double") / 100).alias("nbr_median"))
    return records.decide_outcome(f).select("fire", "statut", "motif")


# Of four records one is in the archive only, one is met again with another outcome, one is discarded today, one is new.
MERGED = (
    cte("records") + """, a AS (SELECT id, statut, premier, dernier, CASE WHEN statut = 'mesure' THEN surface END AS s, CASE WHEN statut <> 'mesure' THEN surface * 2 END AS e, DATE '2030-01-01' AS np FROM records WHERE id % 4 < 3),
    t AS (SELECT id, CASE statut WHEN 'mesure' THEN 'ecarte' WHEN 'ecarte' THEN 'mesure' ELSE statut END AS statut, premier + 1 AS premier, dernier + 5 AS dernier, surface AS s, surface * 3 AS e, DATE '2031-01-01' AS np FROM records WHERE id % 4 IN (1, 3)
          UNION ALL SELECT id, 'ecarte', premier, dernier + 4, NULL, NULL, NULL FROM records WHERE id % 4 = 2),
    j AS (SELECT a.id AS aid, t.id AS tid, a.statut AS o, t.statut AS n, a.premier AS ap, t.premier AS tp, a.dernier AS ad, t.dernier AS td, a.s AS asf, t.s AS ts, a.e AS ae, t.e AS te, a.np AS anp, t.np AS tnp FROM a FULL JOIN t ON a.id = t.id),
    k AS (SELECT *, CASE WHEN n IS NULL THEN FALSE WHEN n = 'mesure' THEN TRUE WHEN n = 'en_attente' THEN coalesce(o <> 'mesure', TRUE) ELSE o IS NOT NULL AND o <> 'mesure' END AS take FROM j)
    SELECT coalesce(aid, tid) AS id, CASE WHEN take THEN n ELSE o END AS statut, coalesce(ap, tp) AS premier, CASE WHEN take THEN greatest(coalesce(ad, td), td) ELSE ad END AS dernier,
    CASE WHEN take AND n = 'ecarte' THEN asf WHEN take THEN ts ELSE asf END AS surface_ha, CASE WHEN take AND n = 'mesure' THEN NULL WHEN take AND n = 'ecarte' THEN ae WHEN take THEN te ELSE ae END AS surface_estimee_ha,
    CASE WHEN take AND n IN ('mesure', 'ecarte') THEN NULL WHEN take THEN tnp ELSE anp END AS prochain_passage FROM k WHERE o IS NOT NULL OR take"""
)


def archive_and_today(spark, sf_dir):
    r = view(spark, sf_dir, "records")
    m = F.col("statut") == "mesure"
    none = F.lit(None).cast("string").alias("motif")
    s = F.col("surface")
    a = r.where("id % 4 < 3").select("id", "statut", "premier", "dernier", F.when(m, s).alias("surface_ha"), F.when(~m, s * 2).alias("surface_estimee_ha"), none, F.lit("2030-01-01").cast("date").alias("prochain_passage"))
    swapped = F.when(m, "ecarte").when(F.col("statut") == "ecarte", "mesure").otherwise(F.col("statut")).alias("statut")
    t = r.where("id % 4 in (1, 3)").select("id", swapped, F.date_add("premier", 1).alias("premier"), F.date_add("dernier", 5).alias("dernier"), s.alias("surface_ha"), (s * 3).alias("surface_estimee_ha"), none, F.lit("2031-01-01").cast("date").alias("prochain_passage"))
    empty = F.lit(None).cast("bigint")
    t2 = r.where("id % 4 = 2").select("id", F.lit("ecarte").alias("statut"), "premier", F.date_add("dernier", 4).alias("dernier"), empty.alias("surface_ha"), empty.alias("surface_estimee_ha"), none, F.lit(None).cast("date").alias("prochain_passage"))
    return a, t.unionByName(t2)


@query(MERGED)
def l1_merge_status(spark, sf_dir):
    return records.merge_status(*archive_and_today(spark, sf_dir)).drop("motif")


# Published is what wasn't discarded; the state knows the records of before 1999, the events those of before 1998.
JOURNAL = (
    cte("records")
    + """, p AS (SELECT id, CAST(surface AS DOUBLE) AS s, CAST(image_apres AS VARCHAR) AS image FROM records WHERE statut <> 'ecarte'), st AS (SELECT id, CASE WHEN id % 11 = 0 THEN 0.0 ELSE surface * (0.90 + (id % 21) / 100.0) END AS prev FROM records WHERE premier < DATE '1999-01-01'),
    old AS (SELECT premier AS d, 'nouveau' AS type, id, CAST(surface AS DOUBLE) AS s, CAST(NULL AS DOUBLE) AS prev, 1 AS o FROM records WHERE premier < DATE '1998-01-01' AND statut <> 'ecarte'),
    n AS (SELECT DATE '2001-12-01' AS d, CASE WHEN st.id IS NULL THEN 'nouveau' WHEN prev > 0 AND abs((s - prev) / prev) >= 0.05 THEN CASE WHEN s > prev THEN 'agrandi' ELSE 'revise' END END AS type, p.id, s, prev, 0 AS o FROM p LEFT JOIN st ON st.id = p.id),
    u AS (SELECT * FROM n WHERE type IS NOT NULL UNION ALL SELECT * FROM old) """
)
NOW = "2001-12-01 00:00:00"


def journal_inputs(spark, sf_dir):
    r = view(spark, sf_dir, "records")
    s = F.col("surface").cast("double")
    p = r.where("statut <> 'ecarte'").select("id", s.alias("surface_ha"), F.col("image_apres").cast("string").alias("image"))
    state = r.where("premier < '1999-01-01'").select("id", F.when(F.col("id") % 11 == 0, 0.0).otherwise(F.col("surface") * (0.90 + (F.col("id") % 21) / 100.0)).alias("surface_ha"), F.lit("").alias("image"))
    events = r.where("premier < '1998-01-01'").select(F.col("premier").cast("timestamp").alias("date"), F.lit("nouveau").alias("type"), "id", s.alias("surface_ha"), F.lit(None).cast("double").alias("surface_precedente"), F.lit("").alias("image"))
    return p, state, events


@query(JOURNAL + "SELECT type, id, CAST(floor(s) AS BIGINT) AS surface_ha FROM u ORDER BY d DESC, o, id, type LIMIT 200")
def l3_k4_journal(spark, sf_dir):
    events, _ = records.journal_diff(*journal_inputs(spark, sf_dir), now=NOW)
    return events.select("type", "id", F.floor("surface_ha").alias("surface_ha"))


@query(JOURNAL + "SELECT type, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM n WHERE type IS NOT NULL GROUP BY type")
def l3_changes(spark, sf_dir):
    p, state, events = journal_inputs(spark, sf_dir)
    events, _ = records.journal_diff(p, state, events.where("false"), now=NOW, most=1 << 30)
    return events.groupBy("type").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


@query(
    JOURNAL + """, rn AS (SELECT id AS absorbed, id - 1 AS survivor FROM records WHERE statut = 'en_attente' AND lieu % 2 = 0) SELECT 'event' AS kind, coalesce(rn.survivor, old.id) AS id, CAST(floor(s) AS BIGINT) AS surface_ha FROM old LEFT JOIN rn ON old.id = rn.absorbed
    UNION ALL SELECT 'state', id, CAST(floor(CASE WHEN id IN (SELECT survivor FROM rn) THEN 0 ELSE s END) AS BIGINT) FROM p WHERE id NOT IN (SELECT absorbed FROM rn)"""
)
def l4_carry_journal(spark, sf_dir):
    p, _, events = journal_inputs(spark, sf_dir)
    renamed = view(spark, sf_dir, "records").where("statut = 'en_attente' and lieu % 2 = 0").select(F.col("id").alias("absorbed"), (F.col("id") - 1).alias("survivor"))
    e, s = records.carry_journal(events.join(p.select("id"), "id", "left_semi"), p, renamed)
    out = lambda df, kind: df.select(F.lit(kind).alias("kind"), "id", F.floor("surface_ha").alias("surface_ha"))
    return out(e, "event").unionByName(out(s, "state"))


@query(
    """WITH f AS (SELECT c_custkey AS id, c_mktsegment || c_nationkey AS feu, c_custkey % 91 AS x, (c_custkey * 3) % 101 AS y FROM customer), m AS (SELECT *, x - avg(x) OVER w AS dx, y - avg(y) OVER w AS dy, count(*) OVER w AS n FROM f WINDOW w AS (PARTITION BY feu))
    SELECT id, CASE WHEN n < 2 THEN feu ELSE feu || ' — ' || CASE WHEN abs(dy) >= abs(dx) THEN CASE WHEN dy > 0 THEN 'nord' ELSE 'sud' END ELSE CASE WHEN dx > 0 THEN 'est' ELSE 'ouest' END END END AS feu FROM m"""
)
def w6_homonyms(spark, sf_dir):
    k = F.col("c_custkey")
    f = _table(spark, sf_dir, "customer").select(k.alias("id"), F.concat("c_mktsegment", F.col("c_nationkey").cast("string")).alias("feu"), (k % 91).alias("x"), (k * 3 % 101).alias("y"))
    return publish.disambiguate(f).select("id", "feu")


@query(
    cte("records") + """, f AS (SELECT id, statut, CAST(dernier AS VARCHAR) AS fin, CASE WHEN id % 3 = 0 THEN CAST(dernier - 2 AS VARCHAR) ELSE CAST(image_apres AS VARCHAR) END AS im, (id % 50) / 100.0 AS pm, id % 3 AS iso FROM records)
    SELECT id, array_to_string(list_filter([CASE WHEN statut = 'en_attente' THEN 'm' || id END, CASE WHEN statut = 'en_attente' THEN 'emprise des points chauds, pas un périmètre brûlé mesuré' END,
    CASE WHEN id % 50 > 5 THEN printf('%.0f%%', round(pm * 100, 3)) || ' de la zone masquée par les nuages ou la fumée' END,
    CASE WHEN fin > im THEN 'chaleur encore détectée le ' || substr(fin, 9, 2) || '/' || substr(fin, 6, 2) || ', après l''image du ' || substr(im, 9, 2) || '/' || substr(im, 6, 2) || ' — le périmètre s''arrête à cette image et sous-estime probablement la surface finale' END,
    CASE WHEN iso > 0 THEN iso || ' détections isolées écartées du périmètre' END, CASE WHEN id % 7 = 0 THEN 'détection fusionnée avec : a, b' END, CASE WHEN id % 9 = 0 THEN 'alerte' END], lambda x: x IS NOT NULL), ' | ') AS reserves FROM f"""
)
def f6_reserves(spark, sf_dir):
    r = view(spark, sf_dir, "records")
    i = F.col("id")
    f = r.select(
        "id", "statut", F.concat(F.lit("m"), i.cast("string")).alias("motif_attente"), ((i % 50) / 100.0).alias("part_masquee"), F.col("dernier").cast("string").alias("fin"),
        F.when(i % 3 == 0, F.date_sub("dernier", 2)).otherwise(F.col("image_apres")).cast("string").alias("image_apres"), (i % 3).alias("n_isoles"),
        F.when(i % 7 == 0, F.array(F.lit("a"), F.lit("b"))).alias("fusionnes"), F.when(i % 9 == 0, F.array(F.lit("alerte"))).alias("alertes"),
    )
    return f.select("id", F.array_join(publish.reserves(f), " | ").alias("reserves"))


def raw_features(spark, sf_dir):
    r = view(spark, sf_dir, "records")
    i, m = F.col("id"), F.col("statut") == "mesure"
    image = lambda days: F.struct(F.concat(F.lit("S2_"), i.cast("string")).alias("id"), F.date_add("premier", days).cast("string").alias("date"), F.lit(1.5).alias("nuages_pct"))
    return r.select(
        "id", F.when(F.col("statut") != "mesure", F.col("statut")).alias("statut"), F.when(i % 4 > 0, F.concat(F.lit("Feu "), F.col("lieu").cast("string"))).alias("feu"), (i % 96).cast("string").alias("departement"),
        (F.col("surface") / 10 + 0.04).alias("surface_ha"), F.when(~m, F.col("surface") * 0.65).alias("surface_min_ha"), F.when(~m, F.col("surface") * 1.35).alias("surface_max_ha"),
        F.col("premier").cast("string").alias("debut"), F.col("dernier").cast("string").alias("fin"), (i % 300).alias("n_points_chauds"),
        F.when(m, image(-3)).alias("image_avant"), F.when(m, image(3)).alias("image_apres"), F.when(m, F.lit(3)).alias("latence_jours"), F.when(m, F.lit(0.15)).alias("seuil_dnbr"), F.when(m, (i % 40) / 100.0).alias("part_masquee"),
        F.when(~m, F.date_add("dernier", 5)).cast("string").alias("prochain_passage"), F.when(~m, F.concat(F.lit("motif "), (i % 3).cast("string"))).alias("motif_attente"), F.when(i % 5 == 0, F.array(F.lit("x"))).alias("fusionnes"),
    )


def published(spark, sf_dir):
    return publish.to_features(raw_features(spark, sf_dir))


_FEATURES = cte("records") + """, f AS (SELECT id, statut, CASE WHEN id % 4 > 0 THEN concat('Feu ', lieu) ELSE '' END AS feu, '' AS commune, CAST(id % 96 AS VARCHAR) AS departement, round(CAST(surface AS DOUBLE) / 10 + 0.04, 1) AS surface_ha,
    CASE WHEN statut <> 'mesure' THEN CAST(surface AS DOUBLE) * CAST(0.65 AS DOUBLE) END AS surface_min_ha, CASE WHEN statut <> 'mesure' THEN CAST(surface AS DOUBLE) * CAST(1.35 AS DOUBLE) END AS surface_max_ha, CAST(premier AS VARCHAR) AS debut, CAST(dernier AS VARCHAR) AS fin, id % 300 AS n_points_chauds,
    CASE WHEN statut = 'mesure' THEN CAST(premier - 3 AS VARCHAR) ELSE '' END AS image_avant, CASE WHEN statut = 'mesure' THEN CAST(premier + 3 AS VARCHAR) ELSE '' END AS image_apres, CASE WHEN statut = 'mesure' THEN 3 END AS latence_jours,
    CASE WHEN statut = 'mesure' THEN CAST(0.15 AS DOUBLE) END AS seuil_dnbr, CASE WHEN statut = 'mesure' THEN CAST(id % 40 AS DOUBLE) / 100 END AS part_masquee, CASE WHEN statut <> 'mesure' THEN CAST(dernier + 5 AS VARCHAR) END AS prochain_passage, '' AS calcule_le,
    CASE WHEN statut <> 'mesure' THEN concat('motif ', id % 3) END AS motif_attente,
    array_to_string(list_filter([CASE WHEN statut = 'en_attente' THEN concat('motif ', id % 3) END, CASE WHEN statut = 'en_attente' THEN 'emprise des points chauds, pas un périmètre brûlé mesuré' END,
      CASE WHEN statut = 'mesure' AND id % 40 > 5 THEN concat(id % 40, '% de la zone masquée par les nuages ou la fumée') END,
      CASE WHEN statut = 'mesure' AND dernier > premier + 3 THEN concat('chaleur encore détectée le ', strftime(dernier, '%d/%m'), ', après l''image du ', strftime(premier + 3, '%d/%m'), ' — le périmètre s''arrête à cette image et sous-estime probablement la surface finale') END,
      CASE WHEN id % 5 = 0 THEN 'détection fusionnée avec : x' END], lambda x: x IS NOT NULL), ' | ') AS reserves FROM records) """


@query(_FEATURES + "SELECT * FROM f")
def f7_features(spark, sf_dir):
    return published(spark, sf_dir).withColumn("reserves", F.array_join("reserves", " | "))


@query(_FEATURES + "SELECT id, statut, surface_ha, row_number() OVER (ORDER BY statut <> 'en_attente', surface_ha DESC NULLS LAST, id) AS place FROM f")
def k3_publication_order(spark, sf_dir):
    return with_place(published(spark, sf_dir).select("id", "statut", "surface_ha"), *publish.publication_keys())


@query(_FEATURES + "SELECT statut, count(*) AS n, CAST(round(sum(surface_ha) * 10) AS BIGINT) AS total FROM f GROUP BY statut UNION ALL SELECT 'isole', count(*), CAST(round(sum(p_size) * 10) AS BIGINT) FROM part UNION ALL SELECT 'point_chaud', count(*), NULL FROM events")
def a13_totals(spark, sf_dir):
    isolated, points = _table(spark, sf_dir, "part").select(F.col("p_size").alias("surface_ha")), _table(spark, sf_dir, "events")
    totals = publish.publication_totals(published(spark, sf_dir), isolated, points)
    return totals.select("statut", "n", F.round(F.col("total_ha") * 10).cast("long").alias("total"))


_PRODUCTS = """WITH p AS (SELECT p_partkey AS pid, concat('E', p_size, '_A', p_partkey % 9, '_', CASE WHEN p_partkey % 2 = 0 THEN 'RTP01_v2' ELSE 'VECTORS_v1' END) AS produit, concat('E', p_size) AS activation, concat('A', p_partkey % 9) AS aoi FROM part) """


def _products(spark, sf_dir):
    act, aoi = F.concat(F.lit("E"), F.col("p_size").cast("string")), F.concat(F.lit("A"), (F.col("p_partkey") % 9).cast("string"))
    return _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pid"), F.concat_ws("_", act, aoi, F.when(F.col("p_partkey") % 2 == 0, "RTP01_v2").otherwise("VECTORS_v1")).alias("produit"), act.alias("activation"), aoi.alias("aoi"))


@query(_PRODUCTS + ", c AS (SELECT DISTINCT produit, concat('c', length(produit)) AS capteur FROM p WHERE produit LIKE '%RTP01_v2' AND pid % 3 > 0), l AS (SELECT DISTINCT activation, aoi, concat('Feu ', activation) AS feu FROM p WHERE aoi = 'A1') SELECT pid, coalesce(feu, p.activation || '/' || p.aoi) AS feu, coalesce(a.capteur, b.capteur, '') AS capteur FROM p LEFT JOIN c a ON a.produit = p.produit LEFT JOIN c b ON b.produit = replace(p.produit, 'VECTORS_v1', 'RTP01_v2') LEFT JOIN l ON l.activation = p.activation AND l.aoi = p.aoi")
def j10_context(spark, sf_dir):
    p = _products(spark, sf_dir)
    c = p.where("produit like '%RTP01_v2' and pid % 3 > 0").select("produit", F.concat(F.lit("c"), F.length("produit").cast("string")).alias("capteur")).distinct()
    names = p.where("aoi = 'A1'").select("activation", "aoi", F.concat(F.lit("Feu "), "activation").alias("feu")).distinct()
    return validate.attach_context(p, c, names).select("pid", "feu", "capteur")


@query(_PRODUCTS + ", d AS (SELECT DISTINCT produit, activation, aoi FROM p), a AS (SELECT pid AS aoi_id, produit, activation, aoi FROM p WHERE pid % 5 = 0) SELECT d.produit, coalesce((SELECT min(aoi_id) FROM a WHERE a.produit = d.produit), (SELECT min(aoi_id) FROM a WHERE a.activation = d.activation AND a.aoi = d.aoi)) AS aoi_id FROM d")
def j11_pick_aoi(spark, sf_dir):
    p = _products(spark, sf_dir)
    return validate.pick_aoi(p.drop("pid").distinct(), p.where("pid % 5 = 0").withColumnRenamed("pid", "aoi_id"))


@query("SELECT p_partkey AS id, p_brand AS feu, row_number() OVER (ORDER BY p_brand, p_retailprice, p_type, p_partkey) AS place FROM part")
def k5_reference_order(spark, sf_dir):
    p = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("feu"), F.col("p_retailprice").alias("date_situation"), F.col("p_type").alias("type_produit"))
    return with_place(p, *validate.reference_keys(p)).select("id", "feu", "place")


@query(
    "WITH r AS (SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS alerte, concat('Ville ', o_orderkey) AS commune, CAST(1000 + 100 + o_orderkey % 900 AS DOUBLE) AS surface_ha FROM orders) "
    "SELECT commune, surface_ha, row_number() OVER (ORDER BY surface_ha DESC, alerte, commune) AS place FROM r"
)
def k5_declared_order(spark, sf_dir):
    rows = textjobs.table_rows(view(spark, sf_dir, "htmltables")).select("alerte", "commune", "surface_ha")
    return with_place(rows, *validate.declared_keys(rows)).select("commune", "surface_ha", "place")


@query(
    "SELECT o_custkey AS page_id, CAST(year(o_orderdate) AS VARCHAR) AS annee, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS alerte, '33' AS departement, concat('Ville ', o_orderkey) AS commune, concat('33', 100 + o_orderkey % 800) AS insee, CAST(1000 + 100 + o_orderkey % 900 AS DOUBLE) AS surface_ha, o_orderstatus AS nature FROM orders"
)
def t1_f9_table_rows(spark, sf_dir):
    return textjobs.table_rows(view(spark, sf_dir, "htmltables")).select("page_id", "annee", "alerte", "departement", "commune", "insee", "surface_ha", "nature")


@query("SELECT o_custkey AS page_id, count(*) + o_custkey % 2 AS announced, count(*) AS n_read, o_custkey % 2 = 1 AS incomplete FROM orders GROUP BY o_custkey")
def t2_incomplete_pages(spark, sf_dir):
    pages = view(spark, sf_dir, "htmltables")
    return textjobs.incomplete_pages(pages, textjobs.table_rows(pages)).withColumn("announced", F.col("announced").cast("long"))


@query(
    """SELECT o_orderkey AS produit, concat('12/07/2022 10:', 10 + o_orderkey % 50) AS situation, concat('11/07/2022 09:', 10 + o_orderkey % 50) AS evenement, concat('1:', o_custkey) AS echelle, 'SPOT6' AS image_post_capteur, concat('0', 1 + o_orderkey % 9, '/08/2022 10:30') AS image_post_dates,
    'Sentinel-2A' AS image_pre_capteur, '01/07/2022' AS image_pre_dates, concat_ws(' ; ', CASE WHEN o_orderkey % 3 = 0 THEN 'fumée dense' END, CASE WHEN o_orderkey % 5 = 0 THEN 'feu encore actif' END) AS reserves FROM orders"""
)
def t3_legends(spark, sf_dir):
    out = textjobs.legends(view(spark, sf_dir, "legendtexts"))
    return out.select("produit", "situation", "evenement", "echelle", "image_post_capteur", "image_post_dates", "image_pre_capteur", "image_pre_dates", "reserves")


def _audited(spark, sf_dir):
    return view(spark, sf_dir, "audited")


_SECRET_SQL = " UNION ALL ".join(
    f"SELECT path, '{label.replace(chr(39), chr(39) * 2)}' AS rule, left(regexp_extract(content, '{pattern.replace(chr(39), chr(39) * 2)}'), 60) AS excerpt FROM audited WHERE regexp_matches(content, '{pattern.replace(chr(39), chr(39) * 2)}')"
    for pattern, label in textjobs.SECRETS
)


@query(cte("audited") + " " + _SECRET_SQL)
def t4_secrets(spark, sf_dir):
    return textjobs.scan_secrets(_audited(spark, sf_dir)).select("path", "rule", "excerpt")


@query(
    cte("audited")
    + rf""", h AS (SELECT path, regexp_extract(content, '{textjobs.LOCAL_PATH}') AS l, regexp_extract(content, '{textjobs.EMAIL}') AS m FROM audited)
    SELECT path, 'chemin local absolu' AS rule, left(l, 60) AS excerpt FROM h WHERE l <> '' UNION ALL SELECT path, 'adresse courriel', left(m, 60) FROM h WHERE m <> '' AND m NOT LIKE '%ems-copernicus.eu%' AND m NOT LIKE '%example.%'"""
)
def t5_identity(spark, sf_dir):
    return textjobs.scan_identity(_audited(spark, sf_dir)).select("path", "rule", "excerpt")


@query(cte("audited") + " SELECT d.path, p.p_brand AS name FROM audited d JOIN (SELECT DISTINCT p_brand FROM part WHERE length(p_brand) >= 8) p ON contains(d.content, p.p_brand)")
def t6_known_secrets(spark, sf_dir):
    known = _table(spark, sf_dir, "part").select(F.col("p_brand").alias("name"), F.col("p_brand").alias("value")).distinct()
    return textjobs.scan_known(_audited(spark, sf_dir), known)


@query(
    r"""WITH p AS (SELECT page_id, url, html FROM pages), l AS (SELECT concat('p/', page_id) AS path, url, regexp_extract(url, 'https?://([A-Za-z0-9.-]+)', 1) AS d FROM p)
    SELECT path, 'error' AS level, left(url, 70) AS excerpt FROM l UNION ALL SELECT path, 'error', left(url, 70) FROM l
    UNION ALL SELECT DISTINCT '', 'alert', unnest(regexp_extract_all(url || ' ' || html, 'https?://([A-Za-z0-9.-]+)', 1)) FROM p"""
)
def t7_third_party_loads(spark, sf_dir):
    p = _table(spark, sf_dir, "pages")
    content = F.concat(F.lit('<script src="'), "url", F.lit('"></script><link rel="stylesheet" href="'), "url", F.lit('">'), "html")
    return textjobs.scan_loads(p.select(F.concat(F.lit("p/"), F.col("page_id").cast("string")).alias("path"), content.alias("content"))).drop("rule")


@query(
    cte("audited") + """, f AS (SELECT CASE path WHEN 'doc/0' THEN 'index.html' WHEN 'doc/1' THEN 'data/feux.geojson' ELSE path END AS path, bytes FROM audited), n AS (SELECT count(*) AS n FROM part)
    SELECT count(*) AS n_files, CAST(sum(bytes) AS BIGINT) AS bytes, any_value(n) AS n_features, sum(bytes) > 25000000 AS too_large, any_value(n) = 0 AS empty, count(*) > 0 AND bool_or(path = 'index.html') AND bool_or(path = 'data/feux.geojson') AS passes FROM f, n"""
)
def t8_completeness(spark, sf_dir):
    path = F.when(F.col("path") == "doc/0", "index.html").when(F.col("path") == "doc/1", "data/feux.geojson").otherwise(F.col("path"))
    return textjobs.completeness(_audited(spark, sf_dir).withColumn("path", path), _table(spark, sf_dir, "part").select(F.lit(1).alias("n")))


def _drained(stream, spark, name: str):
    """All that the stream gives of what there is now, written to the shared folder and read back."""
    at = fresh_path(spark, name)
    stream.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{at}/out")


def _event_stream(spark, sf_dir):
    path = f"{sf_dir}/events.parque[t]"  # a pattern, for a stream takes no plain file
    raw = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    return raw.select(F.col("ts").cast("timestamp").alias("ts"), "event_id", (F.col("user_id") % 20).alias("cx"), (F.col("user_id") % 7).alias("cy"), F.round(F.col("value") * 100).cast("long").alias("frp"), F.col("event_type").alias("capteur"), F.col("user_id").alias("lieu"))


@query("SELECT DISTINCT epoch_us(ts) AS micros, event_type AS capteur, user_id % 20 AS latitude, user_id % 7 AS longitude FROM events")
def x1_stream_distinct(spark, sf_dir):
    twice = _event_stream(spark, sf_dir).withColumn("_again", F.explode(F.array(F.lit(0), F.lit(1)))).withColumnsRenamed({"cx": "latitude", "cy": "longitude"})
    return _drained(streams.distinct_hotspots(twice), spark, "x1").select(F.unix_micros("ts").alias("micros"), "capteur", "latitude", "longitude")


@query(
    """WITH e AS (SELECT ts, user_id % 20 AS cx, user_id % 7 AS cy, CAST(round(value * 100) AS BIGINT) AS frp FROM events), d AS (SELECT unnest(generate_series(0, 4)) AS k), w AS (SELECT date_trunc('day', ts) - INTERVAL '1' DAY * k AS debut, cx, cy, frp FROM e, d)
    SELECT CAST(debut AS DATE) AS debut, cx, cy, count(*) AS n_points, CAST(sum(frp) AS BIGINT) AS frp_total FROM w WHERE debut + INTERVAL '5' DAY <= (SELECT max(ts) - INTERVAL '1' DAY FROM events) GROUP BY debut, cx, cy"""
)
def x2_stream_windows(spark, sf_dir):
    out = _drained(streams.heat_windows(_event_stream(spark, sf_dir)), spark, "x2")
    return out.withColumn("debut", F.col("debut").cast("date"))


@query(
    """WITH e AS (SELECT user_id AS lieu, CASE WHEN user_id % 3 = 0 THEN DATE '2024-01-01' + CAST(12 * (day(ts) - 1) AS INTEGER) ELSE CAST(ts AS DATE) END AS d, CAST(round(value * 100) AS BIGINT) AS frp FROM events), g AS (SELECT *, CASE WHEN date_diff('day', lag(d) OVER w, d) <= 10 THEN 0 ELSE 1 END AS nw FROM e WINDOW w AS (PARTITION BY lieu ORDER BY d)),
    s AS (SELECT *, sum(nw) OVER (PARTITION BY lieu ORDER BY d RANGE UNBOUNDED PRECEDING) AS k FROM g)
    SELECT lieu, min(d) AS debut, max(d) AS fin, count(*) AS n_points, CAST(sum(frp) AS BIGINT) AS frp_total FROM s GROUP BY lieu, k HAVING max(d) + 10 < (SELECT max(d) - 1 FROM e)"""
)
def x3_stream_sessions(spark, sf_dir):
    """A third of the places burn every twelfth day of a year, so that their sessions end."""
    stream = _event_stream(spark, sf_dir)
    spread = F.timestamp_seconds(F.lit(1704067200) + 12 * 86400 * (F.dayofmonth("ts") - 1))
    out = _drained(streams.fire_sessions(stream.withColumn("ts", F.when(F.col("lieu") % 3 == 0, spread).otherwise(F.col("ts")))), spark, "x3")
    return out.withColumns({"debut": F.col("debut").cast("date"), "fin": F.col("fin").cast("date")})


@query(
    """WITH e AS (SELECT user_id AS lieu, CASE WHEN user_id % 3 = 0 THEN DATE '2024-01-01' + CAST(12 * (day(ts) - 1) AS INTEGER) ELSE CAST(ts AS DATE) END AS d, CAST(round(value * 100) AS BIGINT) AS frp FROM events),
    t AS (SELECT lieu, d, count(*) AS n, sum(frp) AS frp FROM e GROUP BY lieu, d), g AS (SELECT *, CASE WHEN date_diff('day', lag(d) OVER w, d) <= 10 THEN 0 ELSE 1 END AS nw FROM t WINDOW w AS (PARTITION BY lieu ORDER BY d)),
    s AS (SELECT *, sum(nw) OVER (PARTITION BY lieu ORDER BY d) AS k FROM g),
    c AS (SELECT lieu, k, d, nw, min(d) OVER w AS premier, sum(n) OVER w AS n, sum(frp) OVER w AS frp, lead(d) OVER (PARTITION BY lieu, k ORDER BY d) IS NULL AS final FROM s WINDOW w AS (PARTITION BY lieu, k ORDER BY d))
    SELECT lieu, CASE WHEN nw = 1 THEN 'opened' ELSE 'grown' END AS type, premier, d AS dernier, CAST(n AS BIGINT) AS n_points, CAST(frp AS BIGINT) AS frp_total FROM c
    UNION ALL SELECT lieu, 'closed', premier, d, CAST(n AS BIGINT), CAST(frp AS BIGINT) FROM c WHERE final AND (d + 10 < (SELECT max(d) - 1 FROM e) OR EXISTS (SELECT 1 FROM s WHERE s.lieu = c.lieu AND s.k > c.k))"""
)
def x3_fire_events(spark, sf_dir):
    """Fires as they are opened, grow and are closed, with the places of x3_stream_sessions."""
    stream = _event_stream(spark, sf_dir)
    spread = F.timestamp_seconds(F.lit(1704067200) + 12 * 86400 * (F.dayofmonth("ts") - 1))
    store, kept = "spark.sql.streaming.stateStore.providerClass", spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set(store, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        return _drained(streams.fire_events(stream.withColumn("ts", F.when(F.col("lieu") % 3 == 0, spread).otherwise(F.col("ts")))), spark, "x3e")
    finally:
        spark.conf.set(store, kept)
