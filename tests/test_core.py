import json
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from scarmap.functions import geo, labels
from scarmap.operators import burn, hotspots, publish, records, scenes, textjobs, zones
from scarmap.operators.components import connected_components
from scarmap.sources import files


def d(s):
    return dt.date.fromisoformat(s)


def test_lambert93_and_ring_area(spark):
    df = spark.createDataFrame([(46.5, 3.0), (48.8566, 2.3522)], "lat double, lon double")
    x, y = geo.lambert93(F.col("lat"), F.col("lon"))
    got = df.select(x, y).collect()
    assert got[0][0] == pytest.approx(700000, abs=0.01) and got[0][1] == pytest.approx(6600000, abs=0.01)
    assert got[1][0] == pytest.approx(652469.02, abs=0.02) and got[1][1] == pytest.approx(6862035.26, abs=0.02)
    square = [[0.0, 0.0], [1000.0, 0.0], [1000.0, 1000.0], [0.0, 1000.0], [0.0, 0.0]]
    hole = [[100.0, 100.0], [100.0, 200.0], [200.0, 200.0], [200.0, 100.0]]
    multi = spark.createDataFrame([([[square, hole]],)], "m array<array<array<array<double>>>>")
    assert multi.select(geo.multipolygon_area_ha(F.col("m"))).first()[0] == pytest.approx(99.0)


def test_components_chain_star_and_empty(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain, "src long, dst long")).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[i] for i in range(100, 140)} == {100}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_cluster_distance_is_2000_m_and_transitive(spark):
    pts = [(1, 0.0, 0.0), (2, 1999.0, 0.0), (3, 3999.0, 0.0), (4, 6000.0, 0.0), (5, 6000.0, 2000.0), (6, 0.0, 9000.0), (7, 0.0, 9000.0), (8, None, 1.0)]
    got = {r.point_id: r.cluster_id for r in hotspots.cluster_hotspots(spark.createDataFrame(pts, "point_id long, x_m double, y_m double")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 6}


def test_chains_gap_of_ten_days(spark):
    rows = [("a", "p", d("2024-01-01"), d("2024-01-02")), ("b", "p", d("2024-01-12"), d("2024-01-12")), ("c", "p", d("2024-01-23"), d("2024-01-23")), ("e", "q", None, None)]
    got = {r.id: r.chain for r in records.chain_records(spark.createDataFrame(rows, "id string, lieu string, premier date, dernier date")).collect()}
    assert got == {"a": 1, "b": 1, "c": 2}


def test_scene_rank_is_taken_before_coverage(spark):
    fires = spark.createDataFrame([(1, "t", d("2024-01-20"))], "fire long, tile string, start date")
    sc = spark.createDataFrame([(f"s{i}", "t", d("2024-01-20") - dt.timedelta(days=i)) for i in range(9)], "scene_id string, tile string, datetime date")
    only_ninth = spark.createDataFrame([(1, "s8", 0.9)], "fire long, scene_id string, coverage double")
    assert scenes.pick_pre(fires, sc, only_ninth).first().scene_id is None
    start_day = spark.createDataFrame([(1, "s0", 0.55)], "fire long, scene_id string, coverage double")
    assert scenes.pick_pre(fires, sc, start_day).first().scene_id == "s0"
    assert scenes.pick_pre(fires, sc, start_day, strict_before=True).first().scene_id is None


def test_block_labels_against_flood_fill():
    rng = np.random.default_rng(3)
    for _ in range(20):
        grid = rng.random((17, 23)) < 0.55
        rows, cols = np.nonzero(grid)
        got = burn.label_block(rows, cols)
        seen = np.full(grid.shape, -1)
        for k, (r, c) in enumerate(zip(rows, cols, strict=True)):
            stack = [(r, c)] if seen[r, c] < 0 else []
            while stack:
                a, b = stack.pop()
                if 0 <= a < 17 and 0 <= b < 23 and grid[a, b] and seen[a, b] < 0:
                    seen[a, b] = k
                    stack += [(a + 1, b), (a - 1, b), (a, b + 1), (a, b - 1)]
        assert (seen[rows, cols] == got).all()


def test_components_cross_blocks_and_corners_do_not_touch(spark):
    mask = [(1, 15, c) for c in range(10, 30)] + [(1, 16, 30), (2, 0, 0)]
    got = burn.burn_components(spark.createDataFrame(mask, "fire long, row long, col long"), block=16).groupBy("fire", "comp_id").count().collect()
    assert sorted((r.fire, r["count"]) for r in got) == [(1, 1), (1, 20), (2, 1)]


def test_nbr_rules(spark):
    px = [(1, 3000, 1000, 4), (2, 3000, 1000, 9), (3, 0, 1000, 4), (4, 300, 199, 4), (5, 300, 200, 4)]
    got = {r.k: r.nbr for r in burn.nbr(spark.createDataFrame(px, "k int, b8a int, b12 int, scl int")).collect()}
    assert got[1] == 0.5 and got[2] is None and got[3] is None and got[4] is None and got[5] == pytest.approx(0.2)


def test_merge_duplicates_strict_and_status(spark):
    def strip(i, lo, hi):
        return [(i, x, 0) for x in range(lo, hi)]

    cells = spark.createDataFrame(strip(1, 0, 20) + strip(2, 17, 27) + strip(3, 100, 110) + strip(4, 106, 114) + strip(5, 200, 230) + strip(6, 205, 215), "id long, cx long, cy long")
    fires = spark.createDataFrame([(1, "mesure", 20.0), (2, "mesure", 10.0), (3, "mesure", 10.0), (4, "mesure", 8.0), (5, "en_attente", 30.0), (6, "mesure", 10.0)], "id long, statut string, area double")
    for group_cells in (1 << 18, 0):
        got = {r.id: (r.under, r.fate, r.signal) for r in publish.merge_decisions(fires, cells, group_cells=group_cells).collect()}
        assert got[2] == (2, "kept", None)  # exactly 30 % is not more than 30 %
        assert got[4] == (3, "fused", None)
        assert got[5] == (5, "kept", None) and got[6] == (6, "replaced", 30)


def test_rasterise_square_with_hole(spark):
    ring = lambda a, b: [[float(a), float(a)], [float(b), float(a)], [float(b), float(b)], [float(a), float(b)]]
    rings = spark.createDataFrame([(1, ring(0, 100)), (1, ring(40, 60)), (2, None)], "geom_id long, ring array<array<double>>")
    got = {(r.cx, r.cy) for r in zones.rasterise(rings).collect()}
    assert got == {(x, y) for x in range(5) for y in range(5)} - {(2, 2)}


def test_numbers_and_pages(spark):
    rows = spark.createDataFrame([("1,917.00 ha",), ("12 ha",), ("ha",), (None,), (",",)], "t string")
    assert [r[0] for r in rows.select(labels.number_in(F.col("t"))).collect()] == [1917.0, 12.0, None, None, None]
    html = "<table><tr><td>a</td><td>b</td><td>2022</td><td>x</td><td>33</td><td>Le <b>Porge</b> INSEE : 33333</td><td>3,245.20 ha</td></tr><tr><td>1</td></tr></table>"
    r = textjobs.table_rows(spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")).collect()
    assert len(r) == 1 and (r[0].commune, r[0].insee, r[0].surface_ha, r[0].nature) == ("Le Porge", "33333", 3245.2, "")


def test_email_exemption_looks_at_the_first_hit(spark):
    files_ = spark.createDataFrame([("a", "x@example.org y@private.fr"), ("b", "y@private.fr"), ("c", None)], "path string, content string")
    assert [r.path for r in textjobs.scan_identity(files_).collect()] == ["b"]
    assert sorted(r.path for r in textjobs.scan_identity(files_, all_hits=True).collect()) == ["a", "b"]


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("latitude,longitude,bright_ti4,frp,confidence,acq_date,acq_time\n44.1,2.0,300,NaN,n,2024-01-01,0101\nbad,2.0,300,5,l,2024-01-01,0101\n")
    got = files.read_hotspots(spark, {"S1": str(tmp_path / "a.csv"), "S2": str(tmp_path / "none.csv")}).collect()
    assert [(r.latitude, r.frp, r.capteur) for r in got] == [(44.1, None, "S1"), (None, 5.0, "S1")]
    for name, body in {"one": '{"id": "one", "premier_point_chaud": "2024-02-03T10:00:00Z"}', "two": "{broken", "three": '{"id": "three"}'}.items():
        (tmp_path / "feux" / name).mkdir(parents=True)
        (tmp_path / "feux" / name / "info.json").write_text(body)
    got = files.read_archive(spark, str(tmp_path / "feux")).collect()
    assert [(r.id, r.premier, r.dernier) for r in got] == [("one", d("2024-02-03"), d("2024-02-03"))]
    (tmp_path / "g.geojson").write_text('{"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"surface_ha": 1.5}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1]]]}}]}')
    g = files.read_geojson(spark, str(tmp_path / "g.geojson")).first()
    assert g.multi == [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0]]]] and g.properties["surface_ha"] == "1.5"


def test_entry_and_oracles_name_the_same_queries():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.oracle_sql()) > 50


def test_status_merge(spark):
    schema = "id string, statut string, premier date, dernier date, surface_ha double, surface_estimee_ha double, motif string, prochain_passage date"
    a = [("a", "mesure", d("2024-01-01"), d("2024-01-02"), 5.0, None, None, None), ("b", "en_attente", d("2024-01-01"), d("2024-01-02"), None, 7.0, "m", d("2024-02-01"))]
    t = [("a", "en_attente", d("2024-01-03"), d("2024-01-09"), None, 9.0, "x", None), ("b", "ecarte", d("2024-01-03"), d("2024-01-09"), None, None, "y", None), ("c", "ecarte", d("2024-01-03"), d("2024-01-09"), None, None, "y", None)]
    got = {r.id: r for r in records.merge_status(spark.createDataFrame(a, schema), spark.createDataFrame(t, schema)).collect()}
    assert set(got) == {"a", "b"} and (got["a"].statut, got["a"].surface_ha) == ("mesure", 5.0)
    assert (got["b"].statut, got["b"].motif, got["b"].premier, got["b"].dernier, got["b"].prochain_passage) == ("ecarte", "y", d("2024-01-01"), d("2024-01-09"), None)


def test_next_pass_takes_the_longest_recent_gap(spark):
    days = ["2024-01-01", "2024-01-06", "2024-01-11", "2024-01-14"]
    df = spark.createDataFrame([("p", d(x)) for x in days] + [("q", d(days[0]))], "place string, datetime date")
    assert {r.place: r.next_pass for r in scenes.next_pass(df, "2024-01-20").collect()} == {"p": d("2024-01-24"), "q": None}


def test_outlines_of_a_square_with_a_hole_and_corner_contact(spark):
    from scarmap.operators import outlines

    cells = [(1, r, c) for r in range(6) for c in range(6) if (r, c) not in {(2, 2), (3, 3)}]
    labels_ = burn.burn_components(spark.createDataFrame(cells, "fire long, row long, col long"))
    rings = [r.xy for r in outlines.outlines(labels_).collect()]
    area = sum(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(x, x[1:], strict=False)) / 2 for x in rings)
    assert len(rings) in (2, 3) and abs(area) == 34 * 400 and sorted(len(x) for x in rings)[-1] >= 5


def test_versions_survive_a_dead_job(spark, tmp_path):
    at = str(tmp_path / "table")
    assert files.read_version(spark, at) is None
    files.write_version(spark.range(3), at)
    (tmp_path / "table" / "version-000000002").mkdir()  # begun, never ended
    assert files.read_version(spark, at).count() == 3
    files.write_version(files.read_version(spark, at).where("id > 0"), at)
    assert files.read_version(spark, at).count() == 2


def test_journal_batches_are_applied_once(spark, tmp_path):
    from scarmap.streaming import fires as streams

    at = str(tmp_path / "journal")
    apply = streams.journal_upsert(at, "2024-05-01 00:00:00")
    batch = lambda *rows: spark.createDataFrame([(*r, r[2], 2) for r in rows], "id long, surface_ha double, image string, publication string, records long")
    apply(batch((1, 10.0, "a"), (2, 5.0, "a")), 0)
    apply(batch((1, 11.0, "b"), (3, 7.0, "b")), 1)
    once = sorted(map(str, streams.journal(spark, at).collect()))
    apply(batch((1, 11.0, "b"), (3, 7.0, "b")), 1)
    assert sorted(map(str, streams.journal(spark, at).collect())) == once
    events = sorted((r.id, r.type) for r in streams.parts(streams.journal(spark, at))[1].collect())
    assert events == [(1, "agrandi"), (1, "nouveau"), (3, "nouveau")]


def test_chains_without_their_geometry_stay(spark):
    rows = [("a", "p", "en_attente", 1.0, d("2024-01-01"), d("2024-01-02"), None, 1, True), ("b", "p", "mesure", 2.0, d("2024-01-05"), d("2024-01-06"), d("2024-01-08"), 2, False), ("c", "q", "mesure", 3.0, d("2024-01-01"), d("2024-01-02"), None, 1, True), ("e", "q", "en_attente", 4.0, d("2024-01-03"), d("2024-01-09"), None, 9, False)]
    chains = records.chain_records(spark.createDataFrame(rows, "id string, lieu string, statut string, surface_ha double, premier date, dernier date, image_apres date, calcule_le long, has_geometry boolean"))
    out = records.consolidate(chains)
    assert {r.lieu: r.ignored for r in out.collect()} == {"p": True, "q": False}
    archive, renamed = records.after_consolidation(chains, out)
    assert sorted(r.id for r in archive.collect()) == ["a", "b", "c"] and [tuple(r) for r in renamed.collect()] == [("e", "c")]


def test_archive_and_geometry_files(spark, tmp_path):
    shape = [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0]]]]
    geo_schema = "id string, multi array<array<array<array<double>>>>"
    best = files.best_geometry(spark.createDataFrame([("a", shape), ("b", None)], geo_schema), spark.createDataFrame([("a", None), ("b", shape), ("c", shape)], geo_schema))
    assert {r.id: r.multi for r in best.collect()} == {"a": shape, "b": shape, "c": shape}
    raw = spark.createDataFrame([("a", 12.34, d("2024-01-01"), d("2024-01-03")), ("b", None, None, None)], "id string, surface_ha double, debut date, fin date")
    features = publish.to_features(raw)
    assert features.columns == [*publish.CSV_COLUMNS, "motif_attente", "reserves"] and len(features.columns) == 20
    points = spark.createDataFrame([(2.0, 45.0, d("2024-01-01"))], "longitude double, latitude double, acq_date date")
    out = str(tmp_path / "site")
    files.write_publication(features, best, features.limit(0), best, points, out)
    table = {r.id: r for r in spark.read.csv(f"{out}/feux.csv", header=True).collect()}
    assert (table["a"].surface_ha, table["a"].statut, table["b"].surface_ha) == ("12.3", "mesure", None)
    back = {r.properties["id"]: r for r in files.read_geojson(spark, f"{out}/feux.geojsonl/*", lines=True).collect()}
    assert back["a"].multi == shape and set(back["a"].properties) == set(features.columns)


def test_publication_is_ordered_and_put_in_place(spark, tmp_path):
    raw = spark.createDataFrame([(f"f{i:03d}", ["mesure", "en_attente", "ecarte"][i % 3], float(i * 37 % 101) if i % 7 else None) for i in range(90)], "id string, statut string, surface_ha double")
    features = publish.to_features(raw)
    shapes = spark.createDataFrame([], "id string, multi array<array<array<array<double>>>>")
    points = spark.createDataFrame([(2.0, 45.0, d("2024-01-02")), (1.0, 45.0, d("2024-01-01"))], "longitude double, latitude double, acq_date date")
    out = str(tmp_path / "site")
    for wanted in (features.limit(3), features):
        files.write_publication(wanted, shapes, features.limit(0), shapes, points, out)
    lines = lambda folder: [line for f in sorted((tmp_path / "site" / folder).glob("part-*")) for line in f.read_text().splitlines()]
    ids = [r.id for r in publish.publication_order(features).collect()]
    assert [line.split(",")[0] for line in lines("feux.csv") if not line.startswith("id,")] == ids
    for statut in ("mesure", "en_attente", "ecarte"):
        of = {r.id for r in features.where(F.col("statut") == statut).collect()}
        assert [json.loads(x)["properties"]["id"] for x in lines(f"feux.geojsonl/statut={statut}")] == [i for i in ids if i in of]
    assert ["2024-01-01" in x for x in lines("points_chauds.geojsonl")] == [True, False]
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["site"]


def test_old_versions_are_deleted(spark, tmp_path):
    at = str(tmp_path / "table")
    for i in range(6):
        files.write_version(spark.range(i), at)
    assert sorted(p.name for p in (tmp_path / "table").iterdir()) == [f"version-{n:09d}" for n in (4, 5, 6)]
    assert files.read_version(spark, at).count() == 5
