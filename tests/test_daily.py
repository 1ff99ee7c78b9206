from datetime import date

from pyspark.sql import functions as F

from scarmap.jobs import detect

FIELDS = "id string, statut string, premier date, dernier date, surface_ha double, surface_estimee_ha double, motif string, prochain_passage date, commune string, departement string, n_points_chauds long, frp_total double"


def run(spark, archive, images):
    """One fire of today, at (700 km, 6.6 M m), and an archive with zones of 6 x 6 cells; all burns in each image after the 5th."""
    points = spark.createDataFrame([(i, 700_000.0 + i, 6_600_000.0, date(2024, 2, 8), 3.0, "h") for i in range(6)], "point_id long, x_m double, y_m double, acq_date date, frp double, confidence string")
    communes = spark.createDataFrame([(700, 6600, "Ici", "33"), (699, 6600, "Ici", "33"), (700, 6599, "Ici", "33"), (699, 6599, "Ici", "33")], "cx long, cy long, commune string, departement string")
    catalogue = spark.createDataFrame([(f"s{d}", 1, date(2024, m, d), 600_000, 6_500_000, 800_000, 6_700_000) for m, d in images], "scene_id string, tile int, datetime date, xmin int, ymin int, xmax int, ymax int")
    zones = [(r[0], cx, cy) for k, r in enumerate(archive) if r[0] != "none" for cx in range(34_000 + 100 * k, 34_006 + 100 * k) for cy in range(330_500, 330_506)]

    def read(windows):
        px = windows.select("scene_id", "tile", F.explode(F.sequence("row0", "row1")).alias("row"), "col0", "col1").select("scene_id", "tile", "row", F.explode(F.sequence("col0", "col1")).alias("col")).distinct()
        burnt = F.col("scene_id") == "s9"
        return px.withColumns({"b8a": F.when(burnt, 1500).otherwise(3000), "b12": F.when(burnt, 1800).otherwise(900), "scl": F.lit(4)})

    day = detect.daily(points, communes, catalogue, read, "2024-02-10", spark.createDataFrame(archive, FIELDS), spark.createDataFrame(zones, "id string, cx long, cy long"))
    return {r.id: r for r in day.archive.collect()}, {r.id: r["count"] for r in day.cells.groupBy("id").count().collect()}, {r.id for r in day.outlines.collect()}, day.records.collect()


def record(id_, statut, last):
    return (id_, statut, date(2024, 2, 1), last, 5.0 if statut == "mesure" else None, None, None, None, None, None, None, None)


ARCHIVE = [
    record("waits", "en_attente", date(2024, 2, 3)),
    record("old", "en_attente", date(2023, 12, 3)),
    record("none", "en_attente", date(2024, 2, 3)),
    record("done", "mesure", date(2024, 2, 3)),
]


def test_waiting_fires_are_tried_again_and_measured(spark):
    archive, cells, shapes, told = run(spark, ARCHIVE, [(1, 20), (2, 9)])
    new = next(r.id for r in told if r.cluster_id is not None)
    assert {r.id for r in told} == {"waits", new} and new not in {a[0] for a in ARCHIVE}
    assert {i: r.statut for i, r in archive.items()} == {"waits": "mesure", "old": "en_attente", "none": "en_attente", "done": "mesure", new: "mesure"}
    assert archive["waits"].surface_ha == 1.4 and archive["waits"].surface_estimee_ha is None and archive["waits"].premier == date(2024, 2, 1)
    assert archive[new].commune == "Ici" and archive[new].n_points_chauds == 6 and archive["done"].surface_ha == 5.0
    assert cells["waits"] == cells["old"] == cells["done"] == 36 and "none" not in cells and cells[new] > 200
    assert shapes == {"waits", new}


def test_without_images_all_wait_and_an_empty_archive_takes_the_day(spark):
    archive, cells, shapes, told = run(spark, ARCHIVE[:1] + ARCHIVE[2:3], [(1, 20)])
    assert {r.statut for r in archive.values()} == {"en_attente"} and len(archive) == 3 and not shapes
    assert len(told) == 2 and cells["waits"] == 36 and archive["waits"].surface_estimee_ha == 1.4
    archive, cells, shapes, told = run(spark, [], [(1, 20), (2, 9)])
    assert [r.statut for r in archive.values()] == ["mesure"] and set(cells) == set(archive) == shapes and len(told) == 1
