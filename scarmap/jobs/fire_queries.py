"""Queries of hot spots, scenes, pixels and zones over the driver's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from scarmap.functions import geo
from scarmap.jobs import detect
from scarmap.jobs.inputs import cte, view
from scarmap.operators import burn, hotspots, outlines, publish, records, scenes, validate, zones
from scarmap.shared import written

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


_KEPT = "kept AS (SELECT * FROM hotspots WHERE lower(confidence) <> 'l')"
_CLUSTERS = (
    cte("hotspots")
    + f""", {_KEPT}, pos AS (SELECT x_m, y_m, min(point_id) AS pid FROM kept GROUP BY x_m, y_m),
    near AS (SELECT a.pid AS a, b.pid AS b FROM pos a JOIN pos b ON (a.x_m - b.x_m) * (a.x_m - b.x_m) + (a.y_m - b.y_m) * (a.y_m - b.y_m) <= 4000000),
    reach(a, b) AS (SELECT pid, pid FROM pos UNION SELECT r.a, n.b FROM reach r JOIN near n ON r.b = n.a),
    lab AS (SELECT a, min(b) AS cluster_id FROM reach GROUP BY a),
    clusters AS (SELECT l.cluster_id, count(*) AS n_points, min(k.acq_date) AS date_debut, max(k.acq_date) AS date_fin, max(frp_centi) AS frp_max, sum(frp_centi) AS frp_total
                 FROM kept k JOIN pos p ON k.x_m = p.x_m AND k.y_m = p.y_m JOIN lab l ON l.a = p.pid GROUP BY l.cluster_id) """
)


_GON = ", ".join(f"abs(dx * cos(radians({11.25 + 22.5 * k})) + dy * sin(radians({11.25 + 22.5 * k})))" for k in range(8))
_BAD = "(0, 1, 3, 6, 8, 9, 10, 11)"


def _points(spark, sf_dir):
    return view(spark, sf_dir, "hotspots").withColumnRenamed("frp_centi", "frp")


@query(
    cte("hotspots")
    + """, d AS (SELECT point_id, radians(latitude) AS phi, radians(longitude - 3.0) AS lam, 0.081819191042816 AS e, 0.725607765053267 AS n FROM hotspots
    WHERE latitude BETWEEN 41.2 AND 51.2 AND longitude BETWEEN -5.3 AND 9.7),
    i AS (SELECT *, ln(tan(pi() / 4 + phi / 2) * pow((1 - e * sin(phi)) / (1 + e * sin(phi)), e / 2)) AS iso FROM d)
    SELECT point_id, CAST(round(10 * (700000 + 11754255.426096 * exp(-n * iso) * sin(n * lam))) AS BIGINT) AS x_dm,
           CAST(round(10 * (12655612.049876 - 11754255.426096 * exp(-n * iso) * cos(n * lam))) AS BIGINT) AS y_dm FROM i"""
)
def p1_p2_lambert93(spark, sf_dir):
    x, y = geo.lambert93(F.col("latitude"), F.col("longitude"))
    inside = geo.in_bbox(view(spark, sf_dir, "hotspots"))
    return inside.select("point_id", F.round(x * 10).cast("long").alias("x_dm"), F.round(y * 10).cast("long").alias("y_dm"))


@query(cte("hotspots") + f", {_KEPT} SELECT confidence, count(*) AS n, sum(frp_centi) AS frp FROM kept GROUP BY confidence")
def p3_confidence(spark, sf_dir):
    return hotspots.filter_confidence(_points(spark, sf_dir)).groupBy("confidence").agg(F.count("*").alias("n"), F.sum("frp").alias("frp"))


@query(_CLUSTERS + "SELECT cluster_id, n_points, date_debut, date_fin, frp_max, CAST(frp_total AS BIGINT) AS frp_total FROM clusters")
def j1_a1_clusters(spark, sf_dir):
    kept, members = hotspots.clustered(_points(spark, sf_dir))
    return hotspots.summarize_clusters(kept, members).withColumn("frp_total", F.col("frp_total").cast("long"))


@query(_CLUSTERS + "SELECT cluster_id, n_points, date_debut, date_fin, frp_max, CAST(frp_total AS BIGINT) AS frp_total FROM clusters WHERE n_points >= 5 ORDER BY frp_total DESC, cluster_id LIMIT 10")
def k1_top_fires(spark, sf_dir):
    kept, members = hotspots.clustered(_points(spark, sf_dir))
    return hotspots.top_fires(hotspots.summarize_clusters(kept, members)).withColumn("frp_total", F.col("frp_total").cast("long"))


@query(_CLUSTERS + "SELECT l.cluster_id, k.point_id FROM kept k JOIN pos p ON k.x_m = p.x_m AND k.y_m = p.y_m JOIN lab l ON l.a = p.pid JOIN clusters c ON c.cluster_id = l.cluster_id WHERE c.n_points >= 5")
def j2_p8_retained_points(spark, sf_dir):
    kept, members = hotspots.clustered(_points(spark, sf_dir))
    retained = hotspots.min_points(hotspots.summarize_clusters(kept, members))
    return hotspots.zone_points(retained, kept, members).select("cluster_id", "point_id")


# Pixels of the images of "passes", from the image's day and the pixel's place: a third of the images is cloudy; ground burns in
# patches of 6 x 8 on the 21st day.
_CLOUDY = "(day + tile) % 3 = 0"
_SCL = f"CASE WHEN {_CLOUDY} AND (r + c) % 10 < 7 THEN 9 WHEN (r * 7 + c * 3) % 29 = 0 THEN 3 ELSE 4 END"
_BURNT = "(day >= 19732 AND CAST(floor(r / 6) AS BIGINT) % 2 = 0 AND CAST(floor(c / 8) AS BIGINT) % 2 = 0)"
_B8A = f"CASE WHEN {_BURNT} THEN 1500 + (r * 7 + c * 11) % 400 ELSE 3000 + (r * 7 + c * 11) % 500 END"
_B12 = f"CASE WHEN {_BURNT} THEN 1700 + (r * 5 + c) % 500 ELSE 900 + (r * 5 + c) % 300 END"
_F = "f AS (SELECT s.*, t.*, m.commune, m.departement FROM shape s JOIN top t ON t.cluster_id = s.fire JOIN communes m ON m.cx = floor(s.x / 50000) AND m.cy = floor(s.y / 50000))"
_CHAIN = (
    _CLUSTERS.replace(cte("hotspots"), cte("hotspots", "communes", "passes"))
    + f""", top AS (SELECT * FROM clusters WHERE n_points >= 5 ORDER BY frp_total DESC, cluster_id LIMIT 10),
    spot AS (SELECT DISTINCT t.cluster_id AS fire, k.x_m, k.y_m FROM kept k JOIN pos p ON k.x_m = p.x_m AND k.y_m = p.y_m JOIN lab l ON l.a = p.pid JOIN top t ON t.cluster_id = l.cluster_id),
    steps AS (SELECT unnest(generate_series(-10, 10)) AS s), around AS (SELECT fire, x_m, y_m, CAST(floor(x_m / 20) AS BIGINT) + i.s AS c, CAST(floor(y_m / 20) AS BIGINT) + j.s AS r FROM spot, steps i, steps j),
    off AS (SELECT *, (c + 0.5) * 20 - x_m AS dx, (r + 0.5) * 20 - y_m AS dy FROM around),
    cell AS (SELECT DISTINCT fire, r, c FROM off WHERE greatest({_GON}) <= 187 * cos(radians(11.25))),
    shape AS (SELECT fire, count(*) AS n, (avg(c) + 0.5) * 20 AS x, (avg(r) + 0.5) * 20 AS y, min(c) * 20 - 6000 AS x0, (max(c) + 1) * 20 + 6000 AS x1, min(c) AS c0, max(c) AS c1, min(r) AS r0, max(r) AS r1 FROM cell GROUP BY fire),
    {_F},
    ca AS (SELECT f.fire, p.*, row_number() OVER (PARTITION BY f.fire ORDER BY p.datetime DESC, p.scene_id) AS rk FROM f JOIN passes p ON f.x0 <= p.xmax AND p.xmin <= f.x1 AND p.datetime >= f.date_debut AND p.datetime <= DATE '2024-02-11'),
    va AS (SELECT fire, scene_id, any_value(tile) AS tile, any_value(day) AS day, any_value(rk) AS rk, avg(CASE WHEN {_SCL} IN {_BAD} THEN 0.0 ELSE 1.0 END) AS p FROM ca JOIN cell USING (fire) WHERE rk <= 6 GROUP BY fire, scene_id),
    post AS (SELECT fire, arg_min(scene_id, rk) AS scene_id, arg_min(tile, rk) AS tile, arg_min(day, rk) AS day FROM va WHERE p >= 0.55 GROUP BY fire),
    cb AS (SELECT f.fire, p.*, row_number() OVER (PARTITION BY f.fire ORDER BY p.datetime DESC, p.scene_id) AS rk FROM f JOIN post USING (fire) JOIN passes p ON p.tile = post.tile AND p.datetime <= f.date_debut AND p.datetime >= f.date_debut - INTERVAL '60' DAY),
    vb AS (SELECT fire, scene_id, any_value(tile) AS tile, any_value(day) AS day, any_value(rk) AS rk, avg(CASE WHEN {_SCL} IN {_BAD} THEN 0.0 ELSE 1.0 END) AS p FROM cb JOIN cell USING (fire) WHERE rk <= 8 GROUP BY fire, scene_id),
    pre AS (SELECT fire, arg_min(scene_id, rk) AS scene_id, arg_min(tile, rk) AS tile, arg_min(day, rk) AS day FROM vb WHERE p >= 0.55 GROUP BY fire),
    win AS (SELECT f.fire, r.r, c.c FROM f JOIN (SELECT DISTINCT r FROM (SELECT unnest(generate_series((SELECT min(r0) FROM shape), (SELECT max(r1) FROM shape))) AS r)) r ON r.r BETWEEN f.r0 AND f.r1
            JOIN (SELECT unnest(generate_series((SELECT min(c0) FROM shape), (SELECT max(c1) FROM shape))) AS c) c ON c.c BETWEEN f.c0 AND f.c1),
    one AS (SELECT fire, r, c, {_SCL} AS scl, {_B8A} AS a, {_B12} AS b FROM pre JOIN win USING (fire)), two AS (SELECT fire, r, c, {_SCL} AS scl, {_B8A} AS a, {_B12} AS b FROM post JOIN win USING (fire) WHERE fire IN (SELECT fire FROM pre)),
    prs AS (SELECT one.fire, one.r, one.c, one.scl NOT IN {_BAD} AND two.scl NOT IN {_BAD} AS usable, (CAST(one.a AS REAL) - CAST(one.b AS REAL)) / (CAST(one.a AS REAL) + CAST(one.b AS REAL)) AS n1, (CAST(two.a AS REAL) - CAST(two.b AS REAL)) / (CAST(two.a AS REAL) + CAST(two.b AS REAL)) AS n2
            FROM one JOIN two ON two.fire = one.fire AND two.r = one.r AND two.c = one.c),
    hit AS (SELECT *, r * 4294967296 + c AS id, CAST(floor(r / 6) AS BIGINT) * 100000 + CAST(floor(c / 8) AS BIGINT) AS patch FROM prs WHERE usable AND n1 - n2 >= CAST(0.15 AS REAL)),
    touch AS (SELECT a.fire, a.id AS a, b.id AS b FROM hit a JOIN hit b ON a.fire = b.fire AND a.patch = b.patch AND ((a.r = b.r AND b.c IN (a.c - 1, a.c + 1)) OR (a.c = b.c AND b.r IN (a.r - 1, a.r + 1)))),
    far(fire, a, b) AS (SELECT fire, id, id FROM hit UNION SELECT x.fire, x.a, n.b FROM far x JOIN touch n ON n.fire = x.fire AND n.a = x.b),
    part AS (SELECT fire, a, min(b) AS comp FROM far GROUP BY fire, a), big AS (SELECT fire, comp FROM part GROUP BY fire, comp HAVING count(*) >= 25),
    px AS (SELECT h.fire, h.r, h.c, p.comp FROM hit h JOIN part p ON p.fire = h.fire AND p.a = h.id JOIN big ON big.fire = p.fire AND big.comp = p.comp),
    nr AS (SELECT px.fire, px.comp FROM px JOIN cell z ON z.fire = px.fire AND abs(px.r - z.r) <= 151 AND abs(px.c - z.c) <= 151 AND pow(greatest(abs(px.r - z.r) - 1, 0), 2) + pow(greatest(abs(px.c - z.c) - 1, 0), 2) <= 22500 GROUP BY px.fire, px.comp),
    total AS (SELECT px.fire, count(*) AS n_px, count(DISTINCT px.comp) AS n_polygones FROM px JOIN nr ON nr.fire = px.fire AND nr.comp = px.comp GROUP BY px.fire)"""
)


def _said(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_TOLD = f"""SELECT f.*, CASE WHEN post.fire IS NULL OR pre.fire IS NULL THEN 'en_attente' WHEN total.fire IS NULL THEN 'ecarte' ELSE 'mesure' END AS statut,
    CASE WHEN f.fire NOT IN (SELECT fire FROM ca) THEN {_said(records.NO_AFTER)} WHEN post.fire IS NULL THEN {_said(records.CLOUDY_AFTER)} WHEN pre.fire IS NULL THEN {_said(records.NO_BEFORE)}
         WHEN f.fire NOT IN (SELECT fire FROM big) THEN {_said(records.NO_TRACE)} WHEN total.fire IS NULL THEN {_said(records.TOO_FAR)} END AS motif,
    total.n_px, total.n_polygones, post.scene_id AS image_apres, pre.scene_id AS image_avant, post.tile AS tuile, post.day - date_diff('day', DATE '1970-01-01', f.date_debut) AS latence_jours
    FROM f LEFT JOIN post USING (fire) LEFT JOIN pre USING (fire) LEFT JOIN total USING (fire)"""
_ESTIMATE = "n * 400 / 10000.0"
_DETECTED = (
    _CHAIN
    + f""", told AS ({_TOLD}), hidden AS (SELECT z.fire, avg(CASE WHEN coalesce(p.usable, false) THEN 0.0 ELSE 1.0 END) AS part FROM cell z LEFT JOIN prs p ON p.fire = z.fire AND p.r = z.r AND p.c = z.c GROUP BY z.fire)
    SELECT cluster_id, commune, departement, n_points AS n_points_chauds, CAST(frp_total AS DOUBLE) AS frp_total, date_debut AS premier, date_fin AS dernier, statut, motif,
           CASE WHEN statut = 'mesure' THEN round(n_px * 0.04, 1) END AS surface_ha, CASE WHEN statut = 'mesure' THEN n_polygones END AS n_polygones, CASE WHEN statut = 'mesure' THEN image_apres END AS image_apres,
           CASE WHEN statut = 'mesure' THEN image_avant END AS image_avant, CASE WHEN statut = 'mesure' THEN tuile END AS tuile, CASE WHEN statut = 'mesure' THEN latence_jours END AS latence_jours,
           CASE WHEN statut = 'mesure' THEN round(part, 3) END AS part_masquee, CASE WHEN statut <> 'mesure' THEN round({_ESTIMATE}, 1) END AS surface_estimee_ha,
           CASE WHEN statut <> 'mesure' THEN round({_ESTIMATE} * CAST(1 - CAST(0.35 AS DOUBLE) AS DOUBLE), 0) END AS surface_min_ha, CASE WHEN statut <> 'mesure' THEN round({_ESTIMATE} * CAST(1 + CAST(0.35 AS DOUBLE) AS DOUBLE), 0) END AS surface_max_ha
    FROM told LEFT JOIN hidden USING (fire)"""
)
# the same chain over today's fires and the ten strongest of the archive that wait
_DAY = (
    _CHAIN.replace(cte("hotspots", "communes", "passes"), cte("hotspots", "communes", "passes", "waited"))
    .replace("    cell AS (", "    pend AS (SELECT * FROM waited WHERE statut = 'en_attente' AND DATE '2024-02-10' - dernier <= 21 ORDER BY frp_total DESC, id LIMIT 10),\n    hotcell AS (")
    .replace("    shape AS (", "    edge4 AS (SELECT unnest(generate_series(0, 3)) AS s), cell AS (SELECT fire, CAST(r AS BIGINT) AS r, CAST(c AS BIGINT) AS c FROM hotcell UNION ALL SELECT k, cy0 + i.s, cx0 + j.s FROM pend, edge4 i, edge4 j),\n    shape AS (")
)
_DAY = _DAY.replace(_F, _F[:-1] + " UNION ALL BY NAME SELECT s.*, p.k AS cluster_id, p.premier AS date_debut, p.dernier AS date_fin, p.frp_total, p.n_points_chauds AS n_points FROM shape s JOIN pend p ON p.k = s.fire)")
_DAY += f""", told AS ({_TOLD})
    SELECT coalesce(w.id, CONCAT('C', CAST(t.fire AS VARCHAR))) AS fiche, coalesce(t.statut, w.statut) AS statut, coalesce(w.premier, t.date_debut) AS premier, coalesce(t.date_fin, w.dernier) AS dernier,
           CASE WHEN t.statut = 'mesure' THEN round(t.n_px * 0.04, 1) WHEN t.statut = 'en_attente' THEN NULL ELSE w.surface_ha END AS surface_ha,
           CASE WHEN t.statut = 'mesure' THEN NULL WHEN t.statut = 'en_attente' THEN round({_ESTIMATE}, 1) ELSE w.surface_estimee_ha END AS surface_estimee_ha, t.motif,
           CAST(coalesce(w.frp_total, t.frp_total) AS DOUBLE) AS frp_total, coalesce(w.n_points_chauds, t.n_points) AS n_points_chauds, CASE WHEN t.statut = 'mesure' THEN t.n_px WHEN t.statut = 'en_attente' THEN t.n ELSE 16 END AS n_cells
    FROM waited w FULL JOIN told t ON t.fire = w.k WHERE w.id IS NOT NULL OR t.statut <> 'ecarte'"""


def _drawn(windows, passes):
    """The pixels of windows of the images of ``passes``, drawn rather than read."""
    w = windows.select("scene_id", "tile", "row0", "row1", "col0", "col1").distinct()
    days = passes.select("scene_id", "day")
    px = w.join(days, "scene_id").withColumn("r", F.explode(F.sequence("row0", "row1"))).withColumn("c", F.explode(F.sequence("col0", "col1")))
    bands = px.select("scene_id", "tile", F.col("r").alias("row"), F.col("c").alias("col"), F.expr(_B8A).alias("b8a"), F.expr(_B12).alias("b12"), F.expr(_SCL).alias("scl"))
    return bands.dropDuplicates(["scene_id", "tile", "row", "col"])


@query(_DETECTED)
def wa_detect(spark, sf_dir):
    """Hot spots to fire records, all steps."""
    passes = view(spark, sf_dir, "passes")
    wide = {"ymin": F.lit(0), "ymax": F.lit(10_000_000)}
    out = detect.detect(_points(spark, sf_dir), view(spark, sf_dir, "communes"), passes.withColumns(wide), lambda w: _drawn(w, passes), "2024-02-10", commune_m=50_000)
    return out.withColumn("part_masquee", F.round("part_masquee", 3)).drop("id", "nbr_avant_median", "prochain_passage")


@query(_DAY)
def wa_daily(spark, sf_dir):
    """A day's run with an archive: today's fires, those that waited, the records and zones after it."""
    passes, waited = view(spark, sf_dir, "passes"), view(spark, sf_dir, "waited")
    wide = {"ymin": F.lit(0), "ymax": F.lit(10_000_000)}
    text = F.lit(None).cast("string")
    archive = waited.drop("k", "cx0", "cy0").withColumns({"motif": text, "prochain_passage": F.lit(None).cast("date"), "commune": text, "departement": text})
    steps = F.sequence(F.lit(0), F.lit(3))
    cells = waited.withColumn("i", F.explode(steps)).withColumn("j", F.explode(steps)).select("id", (F.col("cx0") + F.col("i")).alias("cx"), (F.col("cy0") + F.col("j")).alias("cy"))
    points, communes = _points(spark, sf_dir), view(spark, sf_dir, "communes")
    day = detect.daily(points, communes, passes.withColumns(wide), lambda w: _drawn(w, passes), "2024-02-10", archive, cells, commune_m=50_000)
    sizes = day.cells.groupBy("id").agg(F.count("*").alias("n_cells"))
    name = F.coalesce(F.concat(F.lit("C"), F.col("cluster_id").cast("string")), F.col("id"))
    out = day.archive.join(day.records.select("id", "cluster_id"), "id", "left").join(sizes, "id")
    return out.select(name.alias("fiche"), "statut", "premier", "dernier", "surface_ha", "surface_estimee_ha", "motif", "frp_total", "n_points_chauds", "n_cells")


@query(
    cte("zones") + ", pts AS (SELECT event_id AS point_id, (event_id * 31) % 9000 AS x_m, (event_id * 17) % 7000 AS y_m FROM events) "
    "SELECT z.geom_id, count(*) AS n FROM pts p JOIN (SELECT DISTINCT geom_id, cx, cy FROM zones) z ON z.cx = floor(p.x_m / 20) AND z.cy = floor(p.y_m / 20) GROUP BY z.geom_id"
)
def j2_points_in_zones(spark, sf_dir):
    pts = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("point_id"), (F.col("event_id") * 31 % 9000).alias("x_m"), (F.col("event_id") * 17 % 7000).alias("y_m"))
    return hotspots.points_in_cells(pts, view(spark, sf_dir, "zones")).groupBy("geom_id").agg(F.count("*").alias("n"))


@query(
    cte("hotspots")
    + f""", spot AS (SELECT DISTINCT lieu, x_m, y_m FROM hotspots), steps AS (SELECT unnest(generate_series(-10, 10)) AS s),
    around AS (SELECT lieu, x_m, y_m, floor(x_m / 20) + i.s AS cx, floor(y_m / 20) + j.s AS cy FROM spot, steps i, steps j),
    d AS (SELECT *, (cx + 0.5) * 20 - x_m AS dx, (cy + 0.5) * 20 - y_m AS dy FROM around),
    hit AS (SELECT DISTINCT lieu, cx, cy FROM d WHERE greatest({_GON}) <= 187 * cos(radians(11.25)))
    SELECT lieu AS fire, round(count(*) * 400 / 10000.0, 1) AS surface_estimee_ha, round(count(*) * 400 / 10000.0 * CAST(1 - CAST(0.35 AS DOUBLE) AS DOUBLE), 0) AS surface_min_ha, round(count(*) * 400 / 10000.0 * CAST(1 + CAST(0.35 AS DOUBLE) AS DOUBLE), 0) AS surface_max_ha FROM hit GROUP BY lieu"""
)
def a10_hot_footprint(spark, sf_dir):
    pts = view(spark, sf_dir, "hotspots").withColumnRenamed("lieu", "fire")
    return hotspots.footprint_estimate(hotspots.hot_footprint(pts))


def _fires(spark, sf_dir):
    f = view(spark, sf_dir, "fires").select("fire", F.col("start_day").alias("start"), F.col("now_day").alias("now"), "xmin", "xmax")
    s = view(spark, sf_dir, "scenes")
    return f.withColumns({"ymin": F.lit(0), "ymax": F.lit(10)}), s.withColumns({"ymin": F.lit(0), "ymax": F.lit(10)})


_PERCENT = "(fire * 31 + tile * 17 + year(datetime) * 5 + month(datetime) * 29 + day(datetime) * 7) % 100"


def _coverage(candidates):
    """What a reading of the scenes would give, for the candidates only; some can't be read."""
    return candidates.where("(fire + tile) % 9 <> 0").select("fire", "scene_id", (F.expr(_PERCENT) / 100).alias("coverage"))


_TRIED = (
    f"tried AS (SELECT c.*, CASE WHEN (fire + tile) % 9 = 0 THEN 0 ELSE {_PERCENT} END AS p FROM cand c WHERE rk <= {{0}}) "
    "SELECT fire, count(*) AS n_tried, min_by(scene_id, rk) FILTER (WHERE p >= 55) AS scene_id, min_by(tile, rk) FILTER (WHERE p >= 55) AS tile FROM tried GROUP BY fire"
)


@query(
    cte("scenes", "fires")
    + """, cand AS (SELECT f.fire, s.scene_id, s.tile, s.datetime, row_number() OVER (PARTITION BY f.fire ORDER BY s.datetime DESC, s.scene_id) AS rk
      FROM fires f JOIN scenes s ON f.xmin <= s.xmax AND s.xmin <= f.xmax AND s.datetime >= f.start_day AND s.datetime <= f.now_day + INTERVAL '1' DAY), """
    + _TRIED.format(6)
)
def j4_w4_pick_post(spark, sf_dir):
    f, s = _fires(spark, sf_dir)
    return scenes.pick_post(f, s, _coverage, bin_m=1000)


@query(
    cte("scenes", "fires")
    + """, cand AS (SELECT f.fire, s.scene_id, s.tile, s.datetime, row_number() OVER (PARTITION BY f.fire ORDER BY s.datetime DESC, s.scene_id) AS rk
      FROM fires f JOIN scenes s ON s.tile = CAST(floor(f.xmin / 1000) AS BIGINT) AND s.datetime <= f.start_day AND s.datetime >= f.start_day - INTERVAL '60' DAY), """
    + _TRIED.format(8)
)
def j5_pick_pre(spark, sf_dir):
    f, s = _fires(spark, sf_dir)
    return scenes.pick_pre(f.withColumn("tile", F.floor(F.col("xmin") / 1000)), s, _coverage)


@query(
    cte("scenes")
    + """, d AS (SELECT DISTINCT tile AS place, datetime AS d FROM scenes), g AS (SELECT place, d, date_diff('day', lag(d) OVER w, d) AS gap, row_number() OVER (PARTITION BY place ORDER BY d DESC) AS k FROM d WINDOW w AS (PARTITION BY place ORDER BY d)),
    m AS (SELECT place, max(d) AS l, count(*) AS n, max(gap) FILTER (WHERE k <= 6) AS step FROM g GROUP BY place)
    SELECT place, CAST(l + INTERVAL '1' DAY * CAST(step * greatest(1, ceil(date_diff('day', l, DATE '2002-06-01') / step)) AS BIGINT) AS DATE) AS next_pass FROM m"""
)
def w3_next_pass(spark, sf_dir):
    return scenes.next_pass(view(spark, sf_dir, "scenes").withColumnRenamed("tile", "place"), "2002-06-01")


@query(
    "WITH c AS (SELECT c_custkey AS cluster_id, c_custkey % 40 AS cx, c_nationkey % 7 AS cy FROM customer), m AS (SELECT DISTINCT n_nationkey % 30 AS cx, n_regionkey AS cy, concat('COMMUNE_', n_nationkey % 30) AS commune FROM nation) "
    "SELECT cluster_id, commune FROM c JOIN m ON c.cx = m.cx AND c.cy = m.cy"
)
def j3_attach_commune(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("cluster_id"), (F.col("c_custkey") % 40).alias("cx"), (F.col("c_nationkey") % 7).alias("cy"))
    key = F.col("n_nationkey") % 30
    m = spark.read.parquet(f"{sf_dir}/nation.parquet").select(key.alias("cx"), F.col("n_regionkey").alias("cy"), F.concat(F.lit("COMMUNE_"), key.cast("string")).alias("commune")).distinct()
    return scenes.attach_commune(c, m).select("cluster_id", "commune")


_PAIRS = (
    cte("pixels")
    + f""", v AS (SELECT *, s1 NOT IN {_BAD} AND a1 > 0 AND b1 > 0 AND (a1 + b1) * 1e-4 >= 0.05 AS v1, s2 NOT IN {_BAD} AND a2 > 0 AND b2 > 0 AND (a2 + b2) * 1e-4 >= 0.05 AS v2 FROM pixels),
    nb AS (SELECT *, CASE WHEN v1 THEN (CAST(a1 AS REAL) - CAST(b1 AS REAL)) / (CAST(a1 AS REAL) + CAST(b1 AS REAL)) END AS n1, CASE WHEN v2 THEN (CAST(a2 AS REAL) - CAST(b2 AS REAL)) / (CAST(a2 AS REAL) + CAST(b2 AS REAL)) END AS n2 FROM v),
    pairs AS (SELECT fire, r, c, v1 AND v2 AS usable, n1, n1 - n2 AS dnbr FROM nb), burnt AS (SELECT * FROM pairs WHERE dnbr >= CAST(0.15 AS REAL)),
    """
)
_COMPONENTS = (
    _PAIRS
    + """near AS (SELECT a.fire, a.r * 4294967296 + a.c AS a, b.r * 4294967296 + b.c AS b FROM burnt a JOIN burnt b ON a.fire = b.fire AND ((a.r = b.r AND b.c IN (a.c - 1, a.c + 1)) OR (a.c = b.c AND b.r IN (a.r - 1, a.r + 1)))),
    reach(fire, a, b) AS (SELECT fire, r * 4294967296 + c, r * 4294967296 + c FROM burnt UNION SELECT x.fire, x.a, n.b FROM reach x JOIN near n ON n.fire = x.fire AND n.a = x.b),
    lab AS (SELECT fire, a, min(b) AS comp_id FROM reach GROUP BY fire, a),
    labels AS (SELECT b.fire, b.r, b.c, l.comp_id, b.n1 FROM burnt b JOIN lab l ON l.fire = b.fire AND l.a = b.r * 4294967296 + b.c), """
)


def _images(spark, sf_dir):
    px = view(spark, sf_dir, "pixels")
    at = ["fire", "tile", F.col("r").alias("row"), F.col("c").alias("col")]
    return px.select(*at, F.col("a1").alias("b8a"), F.col("b1").alias("b12"), F.col("s1").alias("scl")), px.select(*at, F.col("a2").alias("b8a"), F.col("b2").alias("b12"), F.col("s2").alias("scl"))


def _pairs(spark, sf_dir):
    return burn.pixel_pairs(*_images(spark, sf_dir))


@query(cte("pixels") + f" SELECT z.fire, p.fire AS scene_id, CAST(round(avg(CASE WHEN p.s1 NOT IN {_BAD} THEN 1.0 ELSE 0.0 END) * 1000000) AS BIGINT) AS coverage_ppm FROM pixels z JOIN pixels p ON p.r = z.r AND p.c = z.c GROUP BY z.fire, p.fire")
def a2_scene_coverage(spark, sf_dir):
    """Each fire's zone in each scene."""
    pre, _ = _images(spark, sf_dir)
    zone, scl = pre.select("fire", "tile", "row", "col"), pre.select(F.col("fire").alias("scene_id"), "tile", "row", "col", "scl")
    found = scenes.scene_coverage(zone, scl)
    return found.select("fire", "scene_id", F.round(F.col("coverage") * 1_000_000).cast("long").alias("coverage_ppm"))


@query(_PAIRS + "s AS (SELECT 1) SELECT fire, r, c, CAST(round(dnbr * 10000) AS BIGINT) AS dnbr_e4 FROM pairs")
def p4_j6_dnbr(spark, sf_dir):
    return _pairs(spark, sf_dir).select("fire", F.col("row").alias("r"), F.col("col").alias("c"), F.round(F.col("dnbr").cast("double") * 10000).cast("long").alias("dnbr_e4"))


@query(
    _PAIRS + """s AS (SELECT fire, CASE WHEN dnbr IS NULL THEN NULL WHEN dnbr < CAST(0.10 AS REAL) THEN 'unburnt' WHEN dnbr < CAST(0.27 AS REAL) THEN 'low' WHEN dnbr < CAST(0.44 AS REAL) THEN 'moderate_low'
    WHEN dnbr < CAST(0.66 AS REAL) THEN 'moderate_high' ELSE 'high' END AS severity, dnbr >= CAST(0.15 AS REAL) AS burnt FROM pairs) SELECT fire, severity, count(*) AS n, count(*) FILTER (WHERE burnt) AS n_burnt FROM s GROUP BY fire, severity"""
)
def p5_p6_severity(spark, sf_dir):
    p = _pairs(spark, sf_dir).select("fire", burn.severity(F.col("dnbr")).alias("severity"), (F.col("dnbr") >= F.lit(burn.THRESHOLD).cast("float")).alias("burnt"))
    return p.groupBy("fire", "severity").agg(F.count("*").alias("n"), F.count_if("burnt").alias("n_burnt"))


@query(_COMPONENTS + "s AS (SELECT 1) SELECT fire, comp_id, count(*) AS n_pixels, count(*) * 400 / 10000.0 AS area_ha FROM labels GROUP BY fire, comp_id HAVING count(*) >= 25")
def a3_burn_components(spark, sf_dir):
    labels = burn.burn_components(burn.burn_mask(_pairs(spark, sf_dir)), block=16)
    return burn.component_areas(labels)


@query(_PAIRS + "s AS (SELECT fire, coalesce(median(CAST(n1 AS DOUBLE)) FILTER (WHERE usable AND dnbr >= CAST(0.15 AS REAL)), 0.0) AS m FROM pairs GROUP BY fire) SELECT fire, CAST(round(m * 1000000) AS BIGINT) AS median_e6 FROM s WHERE m >= 0.20")
def a4_p7_vegetation(spark, sf_dir):
    pairs = _pairs(spark, sf_dir).withColumn("detected", F.coalesce(F.col("dnbr") >= F.lit(burn.THRESHOLD).cast("float"), F.lit(False)))
    return burn.vegetation_gate(burn.median_nbr(pairs)).select("fire", F.round(F.col("nbr_median") * 1_000_000).cast("long").alias("median_e6"))


@query(_PAIRS + "s AS (SELECT 1) SELECT fire, CAST(round((1 - sum(CAST(usable AS INT)) / greatest(count(*), 1)) * 1000000) AS BIGINT) AS masked_ppm FROM pairs GROUP BY fire")
def a5_masked_share(spark, sf_dir):
    return burn.masked_share(_pairs(spark, sf_dir)).select("fire", F.round(F.col("part_masquee") * 1_000_000).cast("long").alias("masked_ppm"))


@query(
    _COMPONENTS + """zone AS (SELECT fire, r AS zr, c AS zc FROM pairs WHERE r % 30 = 3 AND c % 20 = 0),
    d AS (SELECT l.fire, l.comp_id, min(pow(greatest(abs(l.r - z.zr) - 1, 0), 2) + pow(greatest(abs(l.c - z.zc) - 1, 0), 2)) AS d2 FROM labels l JOIN zone z ON z.fire = l.fire GROUP BY l.fire, l.comp_id)
    SELECT fire, comp_id, CAST(d2 AS BIGINT) AS d2 FROM d WHERE d2 <= 25"""
)
def j8_attach_components(spark, sf_dir):
    pairs = written(_pairs(spark, sf_dir), "pairs")
    labels = written(burn.burn_components(burn.burn_mask(pairs), block=16), "labels")
    near = burn.attach_components(labels, pairs.where("row % 30 = 3 and col % 20 = 0"), 100)
    return near.select("fire", "comp_id", F.round((F.col("distance_m") / 20) ** 2).cast("long").alias("d2"))


@query(
    _COMPONENTS + """size AS (SELECT fire, comp_id, count(*) AS n FROM labels GROUP BY fire, comp_id), big AS (SELECT fire, arg_max(comp_id, n * 1000000 - row) AS comp_id FROM (SELECT *, row_number() OVER (PARTITION BY fire ORDER BY comp_id) AS row FROM size) GROUP BY fire),
    core AS (SELECT l.* FROM labels l JOIN big b ON b.fire = l.fire AND b.comp_id = l.comp_id),
    d AS (SELECT l.fire, l.comp_id, min(pow(greatest(abs(l.r - z.r) - 1, 0), 2) + pow(greatest(abs(l.c - z.c) - 1, 0), 2)) AS d2 FROM labels l JOIN core z ON z.fire = l.fire GROUP BY l.fire, l.comp_id)
    SELECT fire, comp_id, d2 <= 100 AS main FROM d"""
)
def j8_split_main(spark, sf_dir):
    labels = written(burn.burn_components(burn.burn_mask(_pairs(spark, sf_dir)), block=16), "labels")
    return burn.split_main(labels, 200)


@query(
    _COMPONENTS + """s AS (SELECT unnest([1, -1, 0, 0]) AS dr, unnest([0, 0, 1, -1]) AS dc), p AS (SELECT l.fire, l.comp_id, count(*) * 20 AS p FROM labels l, s WHERE NOT EXISTS (SELECT 1 FROM burnt b WHERE b.fire = l.fire AND b.r = l.r + s.dr AND b.c = l.c + s.dc) GROUP BY l.fire, l.comp_id),
    a AS (SELECT fire, comp_id, count(*) * 400 AS a FROM labels GROUP BY fire, comp_id) SELECT a.fire, a.comp_id, CAST(round(4 * pi() * a / (p * p) * 1000000) AS BIGINT) AS compactness_e6 FROM a JOIN p ON a.fire = p.fire AND a.comp_id = p.comp_id"""
)
def f8_compactness(spark, sf_dir):
    labels = written(burn.burn_components(burn.burn_mask(_pairs(spark, sf_dir)), block=16), "labels")
    return burn.compactness(labels).select("fire", "comp_id", F.round(F.col("compactness") * 1_000_000).cast("long").alias("compactness_e6"))


_ZONE = "zone AS (SELECT fire, r, c FROM pairs WHERE c < 36), truth AS (SELECT fire, r, c FROM pairs WHERE (r + c) % 5 < 3 AND c > 3), "


def _sweep(spark, sf_dir):
    pairs = written(_pairs(spark, sf_dir), "pairs")
    zone = pairs.where("col < 36").select("fire", "row", "col")
    truth = pairs.where("(row + col) % 5 < 3 and col > 3").select("fire", "row", "col")
    return pairs, zone, truth, validate.sweep(pairs, zone, truth)


_SWEEP = (
    _PAIRS
    + _ZONE
    + """t AS (SELECT unnest([0, 1, 2, 3, 4, 5, 6, 7]) AS k, unnest([0.10, 0.15, 0.20, 0.27, 0.35, 0.44, 0.55, 0.66]) AS seuil),
    m AS (SELECT t.k, p.fire, p.r, p.c, p.r * 4294967296 + p.c AS id FROM pairs p JOIN t ON p.dnbr >= CAST(t.seuil AS REAL)),
    near AS (SELECT a.k, a.fire, a.id AS a, b.id AS b FROM m a JOIN m b ON a.k = b.k AND a.fire = b.fire AND ((a.r = b.r AND b.c IN (a.c - 1, a.c + 1)) OR (a.c = b.c AND b.r IN (a.r - 1, a.r + 1)))),
    reach(k, fire, a, b) AS (SELECT k, fire, id, id FROM m UNION SELECT x.k, x.fire, x.a, n.b FROM reach x JOIN near n ON n.k = x.k AND n.fire = x.fire AND n.a = x.b),
    lab AS (SELECT k, fire, a, min(b) AS comp FROM reach GROUP BY k, fire, a), big AS (SELECT k, fire, comp FROM lab GROUP BY k, fire, comp HAVING count(*) >= 25),
    inz AS (SELECT m.k, m.fire, m.r, m.c, l.comp FROM m JOIN lab l ON l.k = m.k AND l.fire = m.fire AND l.a = m.id JOIN big g ON g.k = l.k AND g.fire = l.fire AND g.comp = l.comp JOIN zone z ON z.fire = m.fire AND z.r = m.r AND z.c = m.c),
    tz AS (SELECT t.* FROM truth t JOIN zone z ON z.fire = t.fire AND z.r = t.r AND z.c = t.c), nt AS (SELECT fire, count(*) AS n FROM tz GROUP BY fire),
    h AS (SELECT i.k, i.fire, count(*) AS det, count(z.r) AS bo, count(DISTINCT comp) AS np FROM inz i LEFT JOIN tz z ON z.fire = i.fire AND z.r = i.r AND z.c = i.c GROUP BY i.k, i.fire),
    res AS (SELECT nt.fire, t.seuil, coalesce(np, 0) AS n_polygones, coalesce(det, 0) AS det, coalesce(bo, 0) AS bo, nt.n FROM nt CROSS JOIN t LEFT JOIN h ON h.k = t.k AND h.fire = nt.fire) """
)


@query(
    _SWEEP + """SELECT fire, CAST(seuil AS DOUBLE) AS seuil, n_polygones, CAST(det AS BIGINT) AS n_detected, CAST(round(bo / (det + n - bo) * 1000000) AS BIGINT) AS iou_e6, CAST(round(bo / n * 1000000) AS BIGINT) AS rappel_e6,
    CAST(round(CASE WHEN det > 0 THEN bo / det ELSE 0 END * 1000000) AS BIGINT) AS precision_e6, CAST(round(CASE WHEN det > 0 THEN (det - n) / n * 100 ELSE 0 END * 10000) AS BIGINT) AS ecart_e4 FROM res"""
)
def a6_threshold_sweep(spark, sf_dir):
    e6 = lambda c: F.round(F.col(c) * 1_000_000).cast("long").alias(f"{c}_e6")
    out = _sweep(spark, sf_dir)[3]
    return out.select("fire", "seuil", "n_polygones", F.round(F.col("surface_detectee_ha") / 0.04).cast("long").alias("n_detected"), e6("iou"), e6("rappel"), e6("precision"), F.round(F.col("ecart_surface_pct") * 10_000).cast("long").alias("ecart_e4"))


@query(_SWEEP + "SELECT fire, CAST(arg_max(seuil, bo / (det + n - bo) - seuil * 1e-9) AS DOUBLE) AS seuil, CAST(round(max(bo / (det + n - bo)) * 1000000) AS BIGINT) AS iou_e6 FROM res GROUP BY fire")
def a7_best_threshold(spark, sf_dir):
    best = validate.best_threshold(_sweep(spark, sf_dir)[3])
    return best.select("fire", "seuil", F.round(F.col("iou") * 1_000_000).cast("long").alias("iou_e6"))


@query(
    _PAIRS + _ZONE + """j AS (SELECT z.fire, p.r % 11 <> 0 AS f, p.usable AS u, t.r IS NOT NULL AS t FROM zone z JOIN pairs p ON p.fire = z.fire AND p.r = z.r AND p.c = z.c LEFT JOIN truth t ON t.fire = z.fire AND t.r = z.r AND t.c = z.c)
    SELECT fire, CAST(round(avg(CAST(f AS INT)) * 1000000) AS BIGINT) AS couverte_e6, CAST(round(avg(CAST(u AS INT)) * 1000000) AS BIGINT) AS exploitable_e6, CAST(round(sum(CAST(t AND u AS INT)) / sum(CAST(t AS INT)) * 1000000) AS BIGINT) AS plafond_e6 FROM j GROUP BY fire"""
)
def a8_comparison_caps(spark, sf_dir):
    pairs = written(_pairs(spark, sf_dir), "pairs")
    caps = validate.comparison_caps(pairs.where("col < 36"), pairs.where("row % 11 <> 0"), pairs.where("usable"), pairs.where("(row + col) % 5 < 3 and col > 3"))
    e6 = lambda c, n: F.round(F.col(c) * 1_000_000).cast("long").alias(n)
    return caps.select("fire", e6("part_couverte", "couverte_e6"), e6("part_exploitable", "exploitable_e6"), e6("rappel_plafond", "plafond_e6"))


@query(
    _COMPONENTS + """truth AS (SELECT fire, r, c FROM pairs WHERE r % 16 < 9), a AS (SELECT l.fire, l.comp_id, count(*) * 0.04 AS ha, count(t.r) > 0 AS on_fire FROM labels l LEFT JOIN truth t ON t.fire = l.fire AND t.r = l.r AND t.c = l.c GROUP BY l.fire, l.comp_id)
    SELECT fire, count(*) FILTER (WHERE on_fire) AS n_on, count(*) FILTER (WHERE NOT on_fire) AS n_off, CAST(round(coalesce(sum(ha) FILTER (WHERE NOT on_fire), 0) * 100) AS BIGINT) AS off_ares, CAST(round(median(ha) FILTER (WHERE NOT on_fire) * 1000) AS BIGINT) AS median_off, CAST(round(max(ha) FILTER (WHERE NOT on_fire) * 100) AS BIGINT) AS max_off FROM a GROUP BY fire"""
)
def j9_a11_false_positives(spark, sf_dir):
    pairs = written(_pairs(spark, sf_dir), "pairs")
    labels = written(burn.burn_components(burn.burn_mask(pairs), block=16), "labels")
    classes = validate.classify_detections(labels, pairs.where("row % 16 < 9"))
    comps = classes.join(burn.component_areas(labels, 0), ["fire", "comp_id"]).join(burn.compactness(labels), ["fire", "comp_id"])
    r = validate.false_positive_report(comps)
    n = lambda c, by, name: F.round(F.col(c) * by).cast("long").alias(name)
    return r.select("fire", "n_on", "n_off", n("area_off_ha", 100, "off_ares"), n("median_off_ha", 1000, "median_off"), n("max_off_ha", 100, "max_off"))


_HALVES = cte("zones") + ", a AS (SELECT DISTINCT cx, cy FROM zones WHERE geom_id % 2 = 0), b AS (SELECT DISTINCT cx, cy FROM zones WHERE geom_id % 2 = 1) "


def _halves(spark, sf_dir):
    z = view(spark, sf_dir, "zones")
    return z.where("geom_id % 2 = 0"), z.where("geom_id % 2 = 1")


@query(_HALVES + "SELECT cx, cy FROM a UNION SELECT cx, cy FROM b")
def g1_union(spark, sf_dir):
    return publish.union_cells(*_halves(spark, sf_dir))


@query(_HALVES + "SELECT cx, cy FROM a INTERSECT SELECT cx, cy FROM b")
def g2_intersection(spark, sf_dir):
    return publish.intersect_cells(*_halves(spark, sf_dir))


@query(_HALVES + "SELECT cx, cy FROM a EXCEPT SELECT cx, cy FROM b")
def g3_difference(spark, sf_dir):
    return publish.subtract_cells(*_halves(spark, sf_dir))


@query(cte("zones") + " SELECT p_size AS fire, count(DISTINCT (cx, cy)) * 400 / 10000.0 AS area_ha FROM zones GROUP BY p_size")
def a9_union_area(spark, sf_dir):
    return publish.union_area_ha(view(spark, sf_dir, "zones").withColumnRenamed("p_size", "fire"))


@query(
    cte("zones") + """, z AS (SELECT DISTINCT geom_id, cx, cy FROM zones), n AS (SELECT geom_id, count(*) AS n, DATE '2024-01-01' + CAST(geom_id % 40 AS INTEGER) AS d FROM z GROUP BY geom_id),
    p AS (SELECT a.geom_id AS a, b.geom_id AS b, count(*) AS k FROM z a JOIN z b ON a.cx = b.cx AND a.cy = b.cy WHERE a.geom_id % 2 = 0 AND b.geom_id % 2 = 1 GROUP BY ALL),
    r AS (SELECT p.*, k / least(na.n, nb.n) AS ratio, nb.d AS premier FROM p JOIN n na ON na.geom_id = a JOIN n nb ON nb.geom_id = b WHERE k > 0.3 * least(na.n, nb.n) AND date_diff('day', nb.d + 2, na.d) <= 10),
    o AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY ratio DESC, premier, b) AS rk FROM r) SELECT a AS cluster_id, b AS id, CAST(round(ratio * 1000000) AS BIGINT) AS ratio_e6 FROM o WHERE rk = 1"""
)
def j7_w5_match_archive(spark, sf_dir):
    even, odd = _halves(spark, sf_dir)
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("geom_id") % 40).cast("int"))
    clusters = even.select(F.col("geom_id").alias("cluster_id"), day.alias("date_debut")).distinct()
    archive = odd.select(F.col("geom_id").alias("id"), day.alias("premier"), F.date_add(day, 2).alias("dernier")).distinct()
    found = publish.match_archive(clusters, even.withColumnRenamed("geom_id", "cluster_id"), archive, odd.withColumnRenamed("geom_id", "id"))
    return found.select("cluster_id", "id", F.round(F.col("ratio") * 1_000_000).cast("long").alias("ratio_e6"))


_MERGED = cte("firesites") + """,
    c AS (SELECT DISTINCT id, site, cx, cy FROM firesites),
    f AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY n DESC, id) AS k FROM (SELECT id, site, feu, coalesce(statut, 'mesure') = 'mesure' AS m, n_points, premier, count(*) AS n FROM firesites GROUP BY ALL)),
    ck AS (SELECT c.*, f.k FROM c JOIN f ON f.id = c.id),
    shared AS (SELECT a.site, a.k AS ka, b.k AS kb, count(*) AS n FROM ck a JOIN ck b ON a.site = b.site AND a.cx = b.cx AND a.cy = b.cy AND a.k < b.k GROUP BY ALL),
    s2 AS (SELECT a.site, a.id AS id1, a.m AS m1, a.n AS n1, b.id AS id2, b.m AS m2, b.n AS n2,
                  CASE WHEN coalesce(s.n, 0) > 0.3 * least(a.n, b.n) THEN CASE WHEN a.m = b.m THEN 'fused' WHEN a.m THEN 'dropped' ELSE 'replaced' END ELSE 'kept' END AS fate2
           FROM f a JOIN f b ON b.site = a.site AND a.k = 1 AND b.k = 2 LEFT JOIN shared s ON s.site = a.site AND s.ka = 1 AND s.kb = 2),
    za AS (SELECT DISTINCT ck.site, cx, cy FROM ck JOIN s2 ON s2.site = ck.site WHERE (k = 1 AND fate2 <> 'replaced') OR (k = 2 AND fate2 IN ('fused', 'replaced'))),
    na AS (SELECT site, count(*) AS n FROM za GROUP BY site),
    i3 AS (SELECT ck.site, count(*) AS n FROM ck JOIN za ON za.site = ck.site AND za.cx = ck.cx AND za.cy = ck.cy WHERE k = 3 GROUP BY ck.site),
    s3 AS (SELECT s2.*, g.id AS id3, g.m AS m3, g.n AS n3, na.n AS na, CASE WHEN fate2 = 'replaced' THEN id2 ELSE id1 END AS ha, fate2 = 'replaced' OR m1 AS ma,
                  CASE WHEN coalesce(i3.n, 0) > 0.3 * least(g.n, na.n) THEN 'A' WHEN fate2 = 'kept' AND coalesce(s.n, 0) > 0.3 * least(g.n, n2) THEN 'B' ELSE 'C' END AS home
           FROM s2 JOIN na ON na.site = s2.site JOIN f g ON g.site = s2.site AND g.k = 3 LEFT JOIN i3 ON i3.site = s2.site LEFT JOIN shared s ON s.site = s2.site AND s.ka = 2 AND s.kb = 3),
    h3 AS (SELECT *, CASE home WHEN 'A' THEN ha ELSE id2 END AS hh, CASE home WHEN 'A' THEN ma ELSE m2 END AS hm, CASE home WHEN 'A' THEN na ELSE n2 END AS hn FROM s3),
    d AS (SELECT site, id1 AS id, 1 AS k, 'A' AS slot, 'kept' AS fate, id1 AS under, NULL AS signal FROM s2
          UNION ALL SELECT site, id2, 2, CASE WHEN fate2 = 'kept' THEN 'B' ELSE 'A' END, fate2, CASE WHEN fate2 IN ('kept', 'replaced') THEN id2 ELSE id1 END,
                           CASE WHEN fate2 = 'dropped' AND n2 > 1.3 * n1 THEN n2 WHEN fate2 = 'replaced' AND n1 > 1.3 * n2 THEN n1 END FROM s2
          UNION ALL SELECT site, id3, 3, home, CASE WHEN home = 'C' THEN 'kept' WHEN hm = m3 THEN 'fused' WHEN hm THEN 'dropped' ELSE 'replaced' END, CASE WHEN home = 'C' OR (NOT hm AND m3) THEN id3 ELSE hh END,
                           CASE WHEN home <> 'C' AND hm AND NOT m3 AND n3 > 1.3 * hn THEN n3 WHEN home <> 'C' AND NOT hm AND m3 AND hn > 1.3 * n3 THEN hn END FROM h3),
    e AS (SELECT d.*, h.holder FROM d JOIN (SELECT site, slot, arg_max(under, k) AS holder FROM d GROUP BY site, slot) h ON h.site = d.site AND h.slot = d.slot),
    mine AS (SELECT * FROM e WHERE under = holder AND (fate <> 'dropped' OR signal IS NOT NULL)),
    area AS (SELECT holder, count(DISTINCT (cx, cy)) AS n FROM mine JOIN c ON c.id = mine.id WHERE fate <> 'dropped' GROUP BY holder)
    SELECT m.holder AS id, max(f.feu) FILTER (WHERE f.id = m.holder) AS feu, CASE WHEN bool_or(f.m) FILTER (WHERE f.id = m.holder) THEN 'mesure' ELSE 'en_attente' END AS statut,
           CAST(sum(f.n_points) FILTER (WHERE fate <> 'dropped') AS BIGINT) AS n_points_chauds, min(f.premier) FILTER (WHERE fate <> 'dropped') AS premier,
           CAST(max(f.premier + 5) FILTER (WHERE fate <> 'dropped') AS DATE) AS dernier, any_value(area.n) * 400 / 10000.0 AS area_ha,
           coalesce(string_agg(f.feu, ', ' ORDER BY m.k) FILTER (WHERE fate = 'fused'), '') AS fusionnes,
           coalesce(string_agg(concat('chaleur détectée sur ~', printf('%.0f', signal * 0.04), ' ha, au-delà du périmètre mesuré — le feu déborde probablement de l''image'), ', ' ORDER BY m.k) FILTER (WHERE signal IS NOT NULL), '') AS alertes
    FROM mine m JOIN f ON f.id = m.id JOIN area ON area.holder = m.holder GROUP BY m.holder"""


@query(_MERGED)
def g4_merge_duplicates(spark, sf_dir):
    """Groups of three fires, so that SQL can follow the order step by step."""
    z = written(view(spark, sf_dir, "firesites"), "firesites")
    fires = z.groupBy("id", "feu", "statut", F.col("n_points").alias("n_points_chauds"), "premier").agg(F.count("*").cast("double").alias("area")).withColumn("dernier", F.date_add("premier", 5))
    out = publish.merge_duplicates(fires, z.select("id", "cx", "cy"))
    return out.withColumns({"n_points_chauds": F.col("n_points_chauds").cast("long"), "fusionnes": F.array_join("fusionnes", ", "), "alertes": F.array_join("alertes", ", ")})


@query(
    cte("zones") + ", pt AS (SELECT DISTINCT geom_id % 50 AS produit, geom_id, p_size % 4 AS s FROM zones) SELECT pt.produit, count(DISTINCT pt.geom_id) AS n_polygones, array_to_string(list_sort(list_distinct(list(CAST(s AS VARCHAR)))), ',') AS dmg_src_id, "
    "(SELECT round(count(DISTINCT (cx, cy)) * 0.04, 1) FROM zones z WHERE z.geom_id % 50 = pt.produit) AS surface_ha FROM pt GROUP BY pt.produit"
)
def a12_assemble_products(spark, sf_dir):
    z = view(spark, sf_dir, "zones")
    parts = z.select((F.col("geom_id") % 50).alias("produit"), F.col("geom_id").alias("part_id"), (F.col("p_size") % 4).cast("string").alias("dmg_src_id")).distinct()
    return validate.assemble_products(parts, z.select(F.col("geom_id").alias("part_id"), "cx", "cy"))


@query(_COMPONENTS + "s AS (SELECT 1) SELECT fire, comp_id, count(*) AS n_pixels FROM labels GROUP BY fire, comp_id")
def u4_outlines(spark, sf_dir):
    """The area that a component's rings enclose, holes taken off, is that of its pixels."""
    labels = written(burn.burn_components(burn.burn_mask(_pairs(spark, sf_dir)), block=16), "labels")
    rings = outlines.outlines(labels, tolerance_m=0.0)
    turns = F.transform(F.sequence(F.lit(0), F.size("xy") - 2), lambda i: F.get("xy", i)[0] * F.get("xy", i + 1)[1] - F.get("xy", i + 1)[0] * F.get("xy", i)[1])
    area = rings.select("fire", "comp_id", F.aggregate(turns, F.lit(0.0), lambda t, x: t + x).alias("a2"))
    return area.groupBy("fire", "comp_id").agg(F.round(F.abs(F.sum("a2")) / 800).cast("long").alias("n_pixels"))


@query("SELECT p_partkey AS geom_id, (p_size % 9 + 1) * (p_partkey % 5 + 2) - 1 AS n_cells FROM part")
def u3_rasterise(spark, sf_dir):
    """Rectangles of whole cells, each with a hole of one cell."""
    k = F.col("p_partkey")
    x, y, w, h = (k * 7 % 400) * 20, (k * 13 % 300) * 20, (F.col("p_size") % 9 + 1) * 20, (k % 5 + 2) * 20
    box = lambda x0, y0, x1, y1: F.array(*[F.array(a.cast("double"), b.cast("double")) for a, b in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))])
    rings = spark.read.parquet(f"{sf_dir}/part.parquet").select(k.alias("geom_id"), F.explode(F.array(box(x, y, x + w, y + h), box(x, y, x + 20, y + 20))).alias("ring"))
    return zones.rasterise(rings).groupBy("geom_id").agg(F.count("*").alias("n_cells"))
