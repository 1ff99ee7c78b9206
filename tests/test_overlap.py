"""Overlaps of crowds of zones: every pair is found, and none is exchanged."""

import datetime
import random

from scarmap.operators import publish, runs
from scarmap.shared import discard_all


def _written(spark):
    return sum(e.totalShuffleWrite() for e in (lambda s: (s.apply(i) for i in range(s.length())))(spark._jsc.sc().statusStore().executorList(True)))


def _zones(rng, n, name):
    """Small zones on top of each other, a few over a tile's side, one without any neighbour."""
    out = {}
    for i in range(n):
        wide, high = (rng.randint(70, 150), rng.randint(1, 4)) if i % 50 == 7 else (rng.randint(1, 9), rng.randint(1, 6))
        x, y = rng.randint(-75, -55) if i % 2 else rng.randint(-8, 3), rng.randint(-7, 4)
        out[f"{name}{i}"] = {(x + dx, y + dy) for dx in range(wide) for dy in range(high) if (dx + dy) % 7 != 3}
    return {**{k: c for k, c in out.items() if c}, f"{name}far": {(10**7, -(10**7))}}


def _cells(spark, zones, key):
    return spark.createDataFrame([(z, x, y) for z, cs in zones.items() for x, y in [*cs, next(iter(cs))]], f"{key} string, cx long, cy long")


def _ratios(a, b):
    return {(i, j): n for i, x in a.items() for j, y in b.items() if (n := len(x & y) / min(len(x), len(y))) > 0.3}


def test_every_pair_of_a_crowd(spark):
    rng = random.Random(11)
    a, b = _zones(rng, 300, "a"), _zones(rng, 260, "b")
    want = _ratios(a, b)
    da, db = _cells(spark, a, "geom_id"), _cells(spark, b, "geom_id")
    for found in (publish.overlaps(da, db), runs.overlapping(*(runs.runs_of_cells(z, ("geom_id",)) for z in (da, db)), 0.3)):
        rows = found.collect()
        assert len(rows) == len(want) and {(r.a_id, r.b_id): r.ratio for r in rows} == want
    assert any(len(a[i]) > 100 and len(b[j]) > 100 for i, j in want) and any(len(a[i]) > 100 > len(b[j]) for i, j in want)
    assert publish.overlaps(da.limit(0), db).count() == 0
    discard_all(spark)


def test_a_crowded_tile_is_dealt_to_groups(spark, monkeypatch):
    from scarmap.operators import overlap

    for name, n in (("MOST_A", 40), ("MOST_B", 30), ("BLOCK", 16)):
        monkeypatch.setattr(overlap, name, n)
    rng = random.Random(12)
    a, b = _zones(rng, 120, "a"), _zones(rng, 110, "b")
    rows = publish.overlaps(_cells(spark, a, "geom_id"), _cells(spark, b, "geom_id")).collect()
    want = _ratios(a, b)
    assert len(rows) == len(want) and {(r.a_id, r.b_id): r.ratio for r in rows} == want
    discard_all(spark)


def test_archive_matches_of_a_crowd(spark):
    rng = random.Random(13)
    a, b = _zones(rng, 200, "a"), _zones(rng, 180, "b")
    day = lambda n: None if n == 3 else datetime.date(2024, 1, 1) + datetime.timedelta(n)
    starts = {i: day(rng.randint(0, 30)) for i in a}
    dates = {j: (day(rng.randint(0, 4)), day(rng.randint(0, 12))) for j in b}
    clusters = spark.createDataFrame(list(starts.items()), "cluster_id string, date_debut date")
    archive = spark.createDataFrame([(j, *d) for j, d in dates.items()], "id string, premier date, dernier date")
    want = {}
    for (i, j), ratio in _ratios(a, b).items():
        if starts[i] and dates[j][1] and (starts[i] - dates[j][1]).days <= 10:
            mine = (-ratio, dates[j][0] is not None, dates[j][0] or datetime.date.min, j)
            want[i] = min(want.get(i, mine), mine)
    got = publish.match_archive(clusters, _cells(spark, a, "cluster_id"), archive, _cells(spark, b, "id")).collect()
    assert len(got) == len(want) and {r.cluster_id: (r.id, r.ratio) for r in got} == {i: (w[3], -w[0]) for i, w in want.items()}
    discard_all(spark)


def test_pairs_are_not_exchanged(spark):
    n = 700  # ids are hashes, which don't compress
    cells = lambda key: spark.range(n).selectExpr(f"xxhash64(id) as {key}", "explode(sequence(0L, 3 + id % 3)) as cx", "id % 2 as cy")
    dates = lambda key, *names: spark.range(n).selectExpr(f"xxhash64(id) as {key}", *[f"date'2024-01-01' as {c}" for c in names])
    before = _written(spark)
    spans = runs.runs_of_cells(cells("geom_id"), ("geom_id",))
    assert runs.overlapping(spans, spans, 0.3).count() == n * n // 2
    middle = _written(spark)
    assert publish.match_archive(dates("cluster_id", "date_debut"), cells("cluster_id"), dates("id", "premier", "dernier"), cells("id")).count() == n
    after = _written(spark)
    sizes = middle - before, after - middle
    assert max(sizes) < 2 * n * n, sizes  # less than four bytes a pair
    discard_all(spark)
