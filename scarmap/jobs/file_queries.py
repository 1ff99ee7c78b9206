"""Queries of sources, sinks and the journal stream: written from the driver's tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from scarmap.functions import geo
from scarmap.jobs.fire_queries import _CLUSTERS
from scarmap.jobs.inputs import cte, view
from scarmap.jobs.record_queries import JOURNAL, MERGED, NOW, archive_and_today, journal_inputs, published
from scarmap.operators import burn, hotspots, outlines
from scarmap.shared import fresh_path, written
from scarmap.sources import files
from scarmap.streaming import fires as streams

QUERIES, ORACLE = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


@query(
    cte("hotspots") + """ SELECT CASE WHEN point_id % 2 = 0 THEN 'VIIRS_SNPP_NRT' ELSE 'VIIRS_NOAA20_NRT' END AS capteur, CAST(round(latitude * 100) AS BIGINT) AS lat, CAST(round(longitude * 100) AS BIGINT) AS lon,
    CAST(300 + point_id % 60 AS DOUBLE) AS bright_ti4, CASE WHEN point_id % 17 > 0 THEN CAST(frp_centi AS DOUBLE) END AS frp, confidence, acq_date, lpad(CAST(point_id % 2400 AS VARCHAR), 4, '0') AS acq_time FROM hotspots"""
)
def s1_read_hotspots(spark, sf_dir):
    """Two sensors' files and a third that is missing; some heats are no numbers."""
    h, out = view(spark, sf_dir, "hotspots"), fresh_path(spark, "hotspots")
    i = F.col("point_id")
    rows = h.select(
        "latitude", "longitude", (300 + i % 60).alias("bright_ti4"), F.when(i % 17 > 0, F.col("frp_centi").cast("string")).otherwise("n/a").alias("frp"), "confidence", "acq_date",
        F.lpad((i % 2400).cast("string"), 4, "0").alias("acq_time"), (i % 2).alias("sensor"),
    )
    rows.write.partitionBy("sensor").csv(out, header=True)
    got = files.read_hotspots(spark, {"VIIRS_SNPP_NRT": f"{out}/sensor=0", "VIIRS_NOAA20_NRT": f"{out}/sensor=1", "VIIRS_NOAA21_NRT": f"{out}/sensor=2"})
    hundredths = lambda c: F.round(F.col(c) * 100).cast("long")
    return got.select("capteur", hundredths("latitude").alias("lat"), hundredths("longitude").alias("lon"), "bright_ti4", "frp", "confidence", "acq_date", "acq_time")


@query(
    cte("hotspots") + """ SELECT DISTINCT CASE WHEN point_id % 2 = 0 THEN 'VIIRS_SNPP_NRT' ELSE 'VIIRS_NOAA20_NRT' END AS capteur, CAST(round(latitude * 100) AS BIGINT) AS lat, CAST(round(longitude * 100) AS BIGINT) AS lon,
    CAST(epoch(acq_date) AS BIGINT) + CAST(floor((point_id % 1440) / 60) * 3600 + point_id % 1440 % 60 * 60 AS BIGINT) AS seconds FROM hotspots"""
)
def x1_sensor_files(spark, sf_dir):
    """Files of two sensors that arrive in two drops, the second one over half of the first again;
    the stream is started anew in between."""
    h, at = view(spark, sf_dir, "hotspots"), fresh_path(spark, "sensors")
    i = F.col("point_id")
    rows = h.select("latitude", "longitude", (300 + i % 60).alias("bright_ti4"), F.col("frp_centi").alias("frp"), "confidence", "acq_date", F.lpad((F.floor(i % 1440 / 60) * 100 + i % 1440 % 60).cast("string"), 4, "0").alias("acq_time"), (i % 2).alias("sensor"), (i % 3).alias("third"))
    rows = written(rows, "passes")
    for drop in (rows.where("third < 2"), rows.where("third > 0")):
        drop.drop("third").write.mode("append").partitionBy("sensor").csv(f"{at}/in", header=True)
        stream = streams.distinct_hotspots(streams.hotspot_files(spark, {"VIIRS_SNPP_NRT": f"{at}/in/sensor=0", "VIIRS_NOAA20_NRT": f"{at}/in/sensor=1"}), "400 days")
        stream.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()
    hundredths = lambda c: F.round(F.col(c) * 100).cast("long")
    return spark.read.parquet(f"{at}/out").select("capteur", hundredths("latitude").alias("lat"), hundredths("longitude").alias("lon"), F.unix_seconds("ts").alias("seconds"))


@query(
    """SELECT concat('dossier=f-', s_suppkey) AS dossier, s_name AS id, DATE '2024-01-01' + CAST(s_suppkey % 90 AS INTEGER) AS premier,
    DATE '2024-01-01' + CAST(s_suppkey % 90 + CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE 4 END AS INTEGER) AS dernier, s_suppkey % 50 AS n_points_chauds, CASE WHEN s_suppkey % 2 = 0 THEN concat('S', s_suppkey) END AS image_id
    FROM supplier WHERE s_suppkey % 13 > 0 AND s_suppkey % 11 > 0"""
)
def s2_read_archive(spark, sf_dir):
    """A folder for each record; some are broken or lack the first date, some the last one."""
    out, k = fresh_path(spark, "archive"), F.col("s_suppkey")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (k % 90).cast("int"))
    record = F.struct(
        F.col("s_name").alias("id"), F.when(k % 11 > 0, F.concat(day.cast("string"), F.lit("T10:00:00Z"))).alias("premier_point_chaud"), F.when(k % 3 > 0, F.date_add(day, 4).cast("string")).alias("dernier_point_chaud"),
        (k % 50).alias("n_points_chauds"), F.when(k % 2 == 0, F.struct(F.concat(F.lit("S"), k.cast("string")).alias("id"))).alias("image_apres"),
    )
    texts = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.concat(F.lit("f-"), k.cast("string")).alias("dossier"), F.when(k % 13 > 0, F.to_json(record)).otherwise('{"id": broken').alias("content"))
    texts.repartition("dossier").write.partitionBy("dossier").text(out)
    return files.read_archive(spark, out, "*/*.txt").select("dossier", "id", "premier", "dernier", "n_points_chauds", F.col("image_apres.id").alias("image_id"))


@query("SELECT c_custkey AS id, 1 + c_custkey % 2 AS n_polygons, (c_custkey % 50 + 10) * (c_custkey % 50 + 10) - CASE WHEN c_custkey % 3 = 0 THEN 4 ELSE 0 END + CASE WHEN c_custkey % 2 = 1 THEN 8 ELSE 0 END AS area_ares FROM customer")
def s3_a9_geojson(spark, sf_dir):
    """Files of fifty features: a square, some with a hole; every other one with a triangle beside it."""
    k, out = F.col("c_custkey"), fresh_path(spark, "geojson")
    point = lambda x, y: F.array(F.lit(x).cast("double") if isinstance(x, int) else x.cast("double"), F.lit(y).cast("double") if isinstance(y, int) else y.cast("double"))
    side = (k % 50 + 10) * 10
    square = F.array(point(0, 0), F.array(side.cast("double"), F.lit(0.0)), F.array(side.cast("double"), side.cast("double")), F.array(F.lit(0.0), side.cast("double")), point(0, 0))
    hole = F.array(*[point(x, y) for x, y in ((20, 20), (20, 40), (40, 40), (40, 20), (20, 20))])
    triangle = F.array(F.array(*[point(x, y) for x, y in ((1000, 0), (1040, 0), (1040, 40), (1000, 0))]))
    polygon = F.when(k % 3 == 0, F.array(square, hole)).otherwise(F.array(square))
    shape = F.when(k % 2 == 0, F.to_json(F.struct(F.lit("Polygon").alias("type"), polygon.alias("coordinates")))).otherwise(F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), F.array(polygon, triangle).alias("coordinates"))))
    feature = F.concat(F.lit('{"type":"Feature","properties":{"id":'), k.cast("string"), F.lit('},"geometry":'), shape, F.lit("}"))
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.floor(k / 50).alias("part"), feature.alias("f"))
    text = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list("f"), ","), F.lit("]}"))
    c.groupBy("part").agg(text.alias("value")).write.partitionBy("part").text(out)
    got = files.read_geojson(spark, f"{out}/*")
    return got.select(F.col("properties")["id"].cast("long").alias("id"), F.size("multi").cast("long").alias("n_polygons"), F.round(geo.multipolygon_area_ha(F.col("multi")) * 100).cast("long").alias("area_ares"))


_SITES = cte("records", "zones") + """, z AS (SELECT geom_id AS id, count(DISTINCT (cx, cy)) AS n FROM zones GROUP BY geom_id)
    SELECT r.id, r.statut, CAST(round(CAST(r.surface AS DOUBLE) / 10 + 0.04, 1) AS VARCHAR) AS surface_ha, CASE WHEN r.statut <> 'mesure' THEN concat('motif ', r.id % 3) END AS motif_attente, CASE WHEN z.id IS NOT NULL THEN 1 END AS n_polygons, z.n * 4 AS area_ares,
           (SELECT count(*) FROM part) AS n_isolated, (SELECT count(*) FROM hotspots) AS n_points FROM records r LEFT JOIN z ON z.id = r.id"""


@query(_SITES.replace("WITH RECURSIVE ", cte("hotspots") + ", ", 1))
def s4_write_publication(spark, sf_dir):
    """Features with outlines (OP-U4) of their cells, read back from the table and the GeoJSON
    lines; areas are worked out again from the published degrees."""
    out, x0, y0 = fresh_path(spark, "site"), 600000.0, 6300000.0
    cells = view(spark, sf_dir, "zones").select(F.col("geom_id").alias("fire"), F.col("cy").alias("row"), F.col("cx").alias("col"))
    labels = written(burn.burn_components(cells), "labels")
    shapes = outlines.multipolygons(outlines.outlines(labels, tolerance_m=0.0), "fire", x0, y0).withColumnRenamed("fire", "id")
    isolated = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("feu"), F.col("p_size").alias("surface_ha"))
    points = view(spark, sf_dir, "hotspots").select("longitude", "latitude", "acq_date", F.col("frp_centi").alias("frp"))
    files.write_publication(published(spark, sf_dir), shapes, isolated, shapes, points, out)
    table = spark.read.csv(f"{out}/feux.csv", header=True).select(F.col("id").cast("long").alias("id"), "statut", "surface_ha")
    back = files.read_geojson(spark, f"{out}/feux.geojsonl/*", lines=True)
    metres = F.transform("multi", lambda p: F.transform(p, lambda r: F.transform(r, lambda xy: F.array(*geo.lambert93(xy[1], xy[0])))))
    shaped = back.select(F.col("properties")["id"].cast("long").alias("id"), F.col("properties")["motif_attente"].alias("motif_attente"), F.when(F.col("multi").isNotNull(), F.size("multi")).cast("int").alias("n_polygons"), F.round(geo.multipolygon_area_ha(metres) * 100).cast("long").alias("area_ares"))
    n = lambda name: spark.read.text(f"{out}/{name}.geojsonl").agg(F.count("*").alias("n")).first()[0]
    return table.join(shaped, "id").withColumns({"n_isolated": F.lit(n("isolees")).cast("long"), "n_points": F.lit(n("points_chauds")).cast("long")})


@query(_CLUSTERS + "SELECT l.cluster_id, k.point_id FROM kept k JOIN pos p ON k.x_m = p.x_m AND k.y_m = p.y_m JOIN lab l ON l.a = p.pid")
def j1_stream_clusters(spark, sf_dir):
    """Hot spots that arrive in three batches, clustered as they come."""
    path, source = fresh_path(spark, "clusters"), fresh_path(spark, "arriving")
    kept = hotspots.filter_confidence(view(spark, sf_dir, "hotspots")).select("point_id", "x_m", "y_m", (F.col("point_id") % 3).alias("third"))
    kept.repartition(3, "third").write.partitionBy("third").parquet(source)
    stream = spark.readStream.schema("point_id long, x_m double, y_m double").option("maxFilesPerTrigger", 1).parquet(f"{source}/*")
    stream.writeStream.foreachBatch(streams.cluster_upsert(path)).option("checkpointLocation", fresh_path(spark, "j1")).trigger(availableNow=True).start().awaitTermination()
    return files.read_version(spark, path).select("cluster_id", "point_id")


@query(MERGED)
def s5_upsert_archive(spark, sf_dir):
    """The archive written, brought up to date as a new version, and read back."""
    archive, today = archive_and_today(spark, sf_dir)
    path = fresh_path(spark, "archive")
    files.write_version(archive, path, "statut")
    return files.upsert_archive(spark, path, today).drop("motif")


@query(
    JOURNAL + """, e AS (SELECT 'event' AS kind, id, type, CAST(floor(s) AS BIGINT) AS surface_ha FROM u ORDER BY d DESC, o, id, type LIMIT 200)
    SELECT * FROM e UNION ALL SELECT 'state', id, NULL, CAST(floor(s) AS BIGINT) FROM p"""
)
def x4_journal_upsert(spark, sf_dir):
    """A stream of published records, of one publication in several batches, applied to a stored journal."""
    p, state, events = journal_inputs(spark, sf_dir)
    path, source = fresh_path(spark, "journal"), fresh_path(spark, "published")
    start = streams.joined(events, state.withColumn("vu_le", F.lit(NOW).cast("timestamp"))).withColumn("epoch", F.lit(-1).cast("long"))
    files.write_version(start, path)
    p = p.withColumns({"publication": F.lit("2001-12-01"), "records": F.lit(p.count())})
    p.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(p.schema).option("maxFilesPerTrigger", 2).parquet(source)
    upsert = streams.journal_upsert(path, NOW)
    stream.writeStream.foreachBatch(upsert).option("checkpointLocation", fresh_path(spark, "x4")).trigger(availableNow=True).start().awaitTermination()
    return streams.journal(spark, path).where("kind <> 'waiting'").select("kind", "id", "type", F.floor("surface_ha").alias("surface_ha"))
