"""Zones as runs against sets of cells."""

import random

from scarmap.operators import runs, zones


def test_set_operations(spark):
    rng = random.Random(7)
    a = [(f, rng.randint(-3, 3), x := rng.randint(-20, 20), x + rng.randint(-1, 9)) for f in (1, 2, None) for _ in range(25)]
    b = [(f, rng.randint(-3, 3), x := rng.randint(-20, 20), x + rng.randint(0, 5)) for f in (1, 2, 3) for _ in range(15)]
    schema = "fire long, cy long, first long, last long"
    da, db = spark.createDataFrame([*a, *a[:5], (1, None, 0, 4), (1, 2, None, 4)], schema), spark.createDataFrame(b, schema)
    cells = lambda rows: {(f, x, y) for f, y, lo, hi in rows for x in range(lo, hi + 1)}
    sa, sb = cells(a), cells(b)
    for got, want in ((runs.union_runs(da, db, ("fire",)), sa | sb), (runs.intersect_runs(da, db, ("fire",)), sa & sb), (runs.subtract_runs(da, db, ("fire",)), sa - sb), (runs.union_runs(da, keys=("fire",)), sa)):
        rows = [(r.fire, r.cy, r["first"], r["last"]) for r in got.collect()]
        listed = [c for r in rows for c in cells([r])]
        assert len(listed) == len(set(listed)) and set(listed) == want
        ends = {(f, y, hi) for f, y, _, hi in rows}
        assert not any((f, y, lo - 1) in ends for f, y, lo, _ in rows)  # runs that touch are one
    area = {r.fire: r.area_ha for r in runs.runs_area_ha(da).collect()}
    assert all(abs(area[f] - 0.04 * len({c for c in sa if c[0] == f})) < 1e-9 for f in (1, 2, None))
    assert runs.union_runs(da.limit(0), db.limit(0), ("fire",)).count() == 0


def test_overlaps_and_rings(spark):
    rng = random.Random(8)
    square = lambda x, y, s: [[x, y], [x + s, y], [x + s, y + s], [x, y + s]]
    rings = spark.createDataFrame([(i, square(rng.uniform(0, 4000), rng.uniform(0, 600), rng.uniform(50, 3000))) for i in range(14)], "geom_id long, ring array<array<double>>")
    spans, cells = runs.runs_of_rings(rings), {}
    for r in zones.rasterise(rings).collect():
        cells.setdefault(r.geom_id, set()).add((r.cx, r.cy))
    assert {(r.geom_id, r.cx, r.cy) for r in runs.cells_of_runs(spans, ("geom_id",)).collect()} == {(g, *c) for g, cs in cells.items() for c in cs}
    assert spans.count() < sum(map(len, cells.values())) / 20
    got = {(r.a_id, r.b_id): r.ratio for r in runs.overlapping(spans, spans, 0.3).collect()}
    want = {(i, j): n for i, x in cells.items() for j, y in cells.items() if (n := len(x & y) / min(len(x), len(y))) > 0.3}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
