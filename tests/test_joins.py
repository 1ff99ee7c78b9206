"""Distance joins, components and scans against brute force."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scarmap.functions import geo
from scarmap.operators import burn, hotspots, outlines, scenes, textjobs
from scarmap.operators.ranking import with_place


def roots(n, linked):
    of = list(range(n))
    for i in range(n):
        for j in range(i):
            if linked(i, j) and of[i] != of[j]:
                a, b = sorted((of[i], of[j]))
                of = [a if c == b else c for c in of]
    return of


@pytest.mark.parametrize("spread", [9_000, 40_000])
def test_clusters_against_all_pairs(spark, spread):
    rng = random.Random(spread)
    front = [(rng.gauss(0, 900), rng.gauss(5000, 300)) for _ in range(150)]
    points = [(rng.uniform(0, spread), rng.uniform(0, spread)) for _ in range(120)] + front + [(0.0, 0.0), (2000.0, 0.0), (4000.5, 0.0)]
    linked = lambda i, j: (points[i][0] - points[j][0]) ** 2 + (points[i][1] - points[j][1]) ** 2 <= 2000.0**2
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "point_id long, x_m double, y_m double")
    got = {r.point_id: r.cluster_id for r in hotspots.cluster_hotspots(df).collect()}
    assert [got[i] for i in range(len(points))] == roots(len(points), linked)
    assert hotspots.cluster_hotspots(df.limit(0)).count() == 0


def test_attached_components_against_all_pixels(spark):
    rng = random.Random(2)
    patches = [(rng.randrange(300), rng.randrange(300), rng.randint(1, 9), rng.randint(1, 9)) for _ in range(60)]
    pixels = sorted({(1, r, c) for r0, c0, h, w in patches for r in range(r0, r0 + h) for c in range(c0, c0 + w)})
    zone = [(1, r, c) for r in range(100, 130) for c in range(150, 170)] + [(1, 10, 10)]
    labels = burn.burn_components(spark.createDataFrame(pixels, "fire long, row long, col long"), block=32)
    at = {}
    for r in labels.collect():
        at.setdefault(r.comp_id, []).append((r.row, r.col))
    z = np.array([x[1:] for x in zone])
    want = {}
    for comp, own in at.items():
        apart = np.maximum(np.abs(np.array(own)[:, None, :] - z[None]) - 1, 0)
        want[comp] = float(np.sqrt((apart**2).sum(axis=2)).min() * 20)
        own = {tuple(p) for p in own}
        if own & {x[1:] for x in zone}:
            want[comp] = 0.0
    zones = spark.createDataFrame(zone, "fire long, row long, col long")
    for most in (3000, 700, 100):
        got = {r.comp_id: r.distance_m for r in burn.attach_components(labels, zones, most).collect()}
        assert got == pytest.approx({c: d for c, d in want.items() if d <= most})


def test_components_of_several_keys(spark):
    rng = random.Random(3)
    mask = sorted({(rng.choice(["a", "b"]), rng.randrange(2), rng.randrange(40), rng.randrange(40)) for _ in range(2500)})
    got = burn.burn_components(spark.createDataFrame(mask, "fire string, k int, row long, col long"), ("fire", "k"), block=16).collect()
    assert len(got) == len(mask)
    for key in {m[:2] for m in mask}:
        own = [m[2:] for m in mask if m[:2] == key]
        place = {p: i for i, p in enumerate(own)}
        of = list(range(len(own)))
        for i, (r, c) in enumerate(own):
            for near in ((r - 1, c), (r, c - 1)):
                if near in place:
                    a, b = sorted((of[i], of[place[near]]))
                    of = [a if x == b else x for x in of] if a != b else of
        want = {p: own[of[i]][0] * (1 << 32) + own[of[i]][1] for p, i in place.items()}
        assert {(r.row, r.col): r.comp_id for r in got if (r.fire, r.k) == key} == want


def test_known_secrets_in_several_automata(spark):
    rng = random.Random(4)
    secrets = ["".join(rng.choice("abc") for _ in range(9)) for _ in range(60)] + ["short", None]
    files = [(f"f{i}", "".join(rng.choice("abc") for _ in range(4000))) for i in range(20)] + [("none", None), ("two", secrets[0] + secrets[0])]
    df = spark.createDataFrame(files, "path string, content string")
    known = spark.createDataFrame([(f"n{i}", s) for i, s in enumerate(secrets)] + [("again", secrets[0])], "name string, value string")
    want = sorted((p, n) for p, c in files if c for n, s in [*((f"n{i}", s) for i, s in enumerate(secrets)), ("again", secrets[0])] if s and len(s) >= 8 and s in c)
    for at_once in (100_000, 16):
        assert sorted((r.path, r.name) for r in textjobs.scan_known(df, known, at_once=at_once).collect()) == want
    assert textjobs.scan_known(df, known.limit(0)).count() == 0


def test_lonlat_is_the_inverse(spark):
    df = spark.range(200).select((F.col("id") * 5000.0 + 100000).alias("x"), (6000000 + F.col("id") * 5500.0).alias("y"))
    lon, lat = geo.lonlat(F.col("x"), F.col("y"))
    there = df.select("x", "y", lon.alias("lon"), lat.alias("lat"))
    x, y = geo.lambert93(F.col("lat"), F.col("lon"))
    assert there.agg(F.max(F.abs(x - F.col("x")) + F.abs(y - F.col("y")))).first()[0] < 1e-3


def test_places_in_an_order(spark):
    df = spark.range(1000).select("id", (F.col("id") * 37 % 101).alias("v"))
    got = with_place(df, F.col("v").desc(), F.col("id")).collect()
    want = {i: n + 1 for n, i in enumerate(sorted(range(1000), key=lambda i: (-(i * 37 % 101), i)))}
    assert {r.id: r.place for r in got} == want
    assert with_place(df.limit(0), F.col("id")).count() == 0


def test_simplified_outlines_keep_their_area(spark):
    cells = [(1, r, c) for r in range(60) for c in range(60) if (r - 30) ** 2 + (c - 30) ** 2 <= 28**2 and not (r - 30) ** 2 + (c - 30) ** 2 <= 6**2]
    labels = burn.burn_components(spark.createDataFrame(cells, "fire long, row long, col long"))
    full = outlines.outlines(labels, 0.0).collect()
    turns = lambda xy: sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(xy, xy[1:], strict=False)) / 2
    area = sum(turns(r.xy) for r in full)
    assert abs(area) == len(cells) * 400
    for tolerance in (outlines.PERIMETER_M, outlines.WEB_M, outlines.FOOTPRINT_M):
        rings = outlines.outlines(labels, tolerance).collect()
        assert len(rings) == 2 and sum(len(r.xy) for r in rings) <= sum(len(r.xy) for r in full)
        assert abs(sum(turns(r.xy) for r in rings)) == pytest.approx(abs(area), rel=0.02 if tolerance < 60 else 0.12)
        for r in rings:  # no corner of the full ring is farther from the simplified one than allowed
            whole = np.array(next(f.xy for f in full if f.ring == r.ring))
            kept = np.array(r.xy)
            a, v = kept[:-1], np.diff(kept, axis=0)
            t = np.clip(((whole[:, None] - a) * v).sum(axis=2) / np.maximum((v**2).sum(axis=1), 1e-9), 0, 1)
            assert np.sqrt((((whole[:, None] - a) - t[:, :, None] * v) ** 2).sum(axis=2)).min(axis=1).max() <= tolerance + 1e-6
    multi = outlines.multipolygons(outlines.outlines(labels, 0.0), x0=600000.0, y0=6300000.0).first().multi
    assert len(multi) == 1 and len(multi[0]) == 2 and all(r[0] == r[-1] for r in multi[0])
    assert turns(multi[0][0]) > 0 > turns(multi[0][1])


def test_scenes_of_long_archives_and_several_squares(spark):
    rng = random.Random(6)
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    fires = [(i, day(n), day(n + rng.randrange(40)), x, x + w, 0.0, 10.0, f"t{i % 4}") for i in range(40) for n, x, w in [(rng.randrange(400), rng.uniform(0, 5000), rng.uniform(0, 3000))]]
    sc = [(f"s{i}", f"t{i % 4}", day(rng.randrange(460)), x, x + 2500.0, 0.0, 10.0) for i in range(300) for x in [rng.uniform(-1000, 6000)]]
    f = spark.createDataFrame(fires, "fire long, start date, now date, xmin double, xmax double, ymin double, ymax double, tile string")
    s = spark.createDataFrame(sc + sc[:20], "scene_id string, tile string, datetime date, xmin double, xmax double, ymin double, ymax double")
    clear = {(i, n): (i * 31 + int(n[1:]) * 17) % 100 / 100 for i, *_ in fires for n, *_ in sc}
    cover = lambda c: c.select("fire", "scene_id", (F.expr("(fire * 31 + cast(substring(scene_id, 2) as int) * 17) % 100") / 100).alias("coverage"))

    def best(found, tried):
        found = sorted(found, key=lambda x: (-x[2].toordinal(), x[0]))[:tried]
        return next((x[0] for x in found if clear[i, x[0]] >= 0.55), None)

    post = {r.fire: (r.n_tried, r.scene_id) for r in scenes.pick_post(f.drop("tile"), s, cover, bin_m=700, bin_days=9).collect()}
    pre = {r.fire: (r.n_tried, r.scene_id) for r in scenes.pick_pre(f, s, cover).collect()}
    for i, start, now, x0, x1, _, _, tile in fires:
        a = [x for x in sc if x[3] <= x1 and x0 <= x[4] and start <= x[2] <= now + dt.timedelta(days=1)]
        b = [x for x in sc if x[1] == tile and start - dt.timedelta(days=60) <= x[2] <= start]
        assert post.get(i) == ((min(6, len(a)), best(a, 6)) if a else None)
        assert pre.get(i) == ((min(8, len(b)), best(b, 8)) if b else None)


def test_groups_across_batches(spark):
    from scarmap.operators.groups import map_groups

    rng = random.Random(9)
    rows = [(None if g == 3 else g, i) for g in range(40) for i in range(rng.choice([1, 1, 2, 30, 200]))]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g int, i int").repartition(3)

    def sums(pdf, starts):
        ends = [*starts[1:], len(pdf)]
        assert all(pdf["i"].iloc[a:b].is_monotonic_increasing for a, b in zip(starts, ends, strict=True))
        return pdf[["g"]].iloc[starts].assign(n=np.array(ends) - starts, s=[int(pdf["i"].iloc[a:b].sum()) for a, b in zip(starts, ends, strict=True)])

    want = {}
    for g, i in rows:
        want.setdefault(g, []).append(i)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for size in ("1", "7", "64", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        got = [(r.g, r.n, r.s) for r in map_groups(df, ["g"], ["i"], sums, "g int, n long, s long").collect()]
        assert sorted(got, key=str) == sorted(((g, len(x), sum(x)) for g, x in want.items()), key=str)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
