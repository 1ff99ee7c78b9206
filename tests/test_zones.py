"""Points in rings against a plain ray test."""

import math
import random

from scarmap.operators import zones


def inside(x, y, rings):
    """Right ray, even-odd, with the same rule on edges."""
    odd = False
    for ring in rings:
        for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (y0 > y) != (y1 > y):
                turn = (x1 - x0) * (y - y0) - (x - x0) * (y1 - y0)
                odd ^= turn > 0 if y1 > y0 else turn < 0
    return odd


def star(rng, cx, cy, r, n):
    return [[cx + r * rng.uniform(0.4, 1) * math.cos(2 * math.pi * k / n), cy + r * rng.uniform(0.4, 1) * math.sin(2 * math.pi * k / n)] for k in range(n)]


def check(spark, geoms, points, cell_m):
    rings = spark.createDataFrame([(g, r) for g, rs in geoms.items() for r in rs], "geom_id long, ring array<array<double>>")
    df = spark.createDataFrame(points, "point_id long, x_m double, y_m double")
    got = sorted((r.point_id, r.geom_id) for r in zones.points_in_rings(df, rings, cell_m).collect())
    want = sorted((i, g) for i, x, y in points if x is not None and y is not None for g, rs in geoms.items() if inside(x, y, rs))
    assert got == want
    return got


def test_random_rings_with_holes(spark):
    rng = random.Random(1)
    geoms = {}
    for g in range(25):
        cx, cy, r = rng.uniform(-900, 900), rng.uniform(-900, 900), rng.uniform(5, 700)
        geoms[g] = [star(rng, cx, cy, r, rng.randint(3, 30)), star(rng, cx, cy, r * 0.35, 5)]
    points = [(i, rng.uniform(-1600, 1600), rng.uniform(-1600, 1600)) for i in range(1500)] + [(5, 1.0, 1.0), (5, 1.0, 1.0), (6, None, 2.0)]
    for cell in (37, 200, 5000):
        assert len(check(spark, geoms, points, cell)) > 500


def test_points_on_edges_corners_and_cell_lines(spark):
    """Whole numbers, so that points, corners, edges, cell lines and centres meet in every way."""
    rng = random.Random(2)
    geoms = {g: [[[rng.randint(-6, 6) * 5.0, rng.randint(-6, 6) * 5.0] for _ in range(rng.randint(3, 7))] for _ in range(rng.randint(1, 2))] for g in range(40)}
    points = [(i * 100 + j, i * 2.5 - 35, j * 2.5 - 35) for i in range(29) for j in range(29)]
    check(spark, geoms, points, 10)
    check(spark, geoms, points, 7)


def test_neighbours_share_no_point(spark):
    squares = {g: [[[g * 10.0, 0.0], [g * 10.0 + 10, 0.0], [g * 10.0 + 10, 10.0], [g * 10.0, 10.0]]] for g in range(4)}
    got = check(spark, squares, [(i, i * 2.5, 5.0) for i in range(16)] + [(100, 0.0, 0.0), (101, 0.0, 10.0), (102, 40.0, 5.0)], 20)
    assert [g for _, g in got if _ < 16] == [i // 4 for i in range(16)]


def test_odd_inputs(spark):
    rings = spark.createDataFrame([(1, None), (2, []), (3, [[0.0, 0.0]]), (4, [[0.0, 0.0], [5.0, 5.0]]), (5, [[0.0, 0.0], [9.0, 0.0], [9.0, None], [9.0, 9.0], [0.0, 0.0]]), (None, [[0.0, 0.0], [9.0, 0.0], [9.0, 9.0]])], "geom_id long, ring array<array<double>>")
    points = spark.createDataFrame([(1, 6.0, 2.0, "a"), (2, 2.0, 6.0, "b"), (None, 6.0, 2.0, "c")], "point_id long, x_m double, y_m double, geom_id string")
    got = zones.points_in_rings(points, rings).collect()
    assert sorted((r.point_id is None, r.geom_id) for r in got) == [(False, 5), (True, 5)]
    assert zones.points_in_rings(points.limit(0), rings).count() == zones.points_in_rings(points, rings.limit(0)).count() == 0


def area_by_hand(geoms):
    """Slab by slab over all pairs of sides, in plain Python."""
    sides = [(g, p, q) for g, rs in geoms.items() for r in rs for p, q in zip(r, r[1:] + r[:1], strict=True)]
    ys = {p[1] for _, p, _ in sides}
    for i, (_, a, b) in enumerate(sides):
        for _, c, d in sides[:i]:
            den = (b[0] - a[0]) * (d[1] - c[1]) - (b[1] - a[1]) * (d[0] - c[0])
            if den:
                t = ((c[0] - a[0]) * (d[1] - c[1]) - (c[1] - a[1]) * (d[0] - c[0])) / den
                if 0 <= t <= 1:
                    ys.add(a[1] + t * (b[1] - a[1]))
    total, ys = 0.0, sorted(ys)
    for lo, hi in zip(ys[:-1], ys[1:], strict=True):
        y = (lo + hi) / 2
        cuts = sorted((p[0] + (y - p[1]) * (q[0] - p[0]) / (q[1] - p[1]), g) for g, p, q in sides if (p[1] > y) != (q[1] > y))
        inside = set()
        for (x, g), (after, _) in zip(cuts[:-1], cuts[1:], strict=True):
            inside ^= {g}
            total += (after - x) * (hi - lo) * bool(inside)
    return total


def test_union_area_of_overlapping_rings(spark):
    rng = random.Random(4)
    fires = {f: {g: [star(rng, rng.uniform(0, 300), rng.uniform(-200, 200), rng.uniform(50, 250), rng.randint(3, 9))] + ([star(rng, 0, 0, 60, 4)] if g % 2 else []) for g in range(rng.randint(1, 5))} for f in range(8)}
    fires[8] = {0: [[[0.0, 0.0], [100.0, 0.0], [100.0, 100.0], [0.0, 100.0]]], 1: [[[100.0, 0.0], [200.0, 0.0], [200.0, 100.0], [100.0, 100.0]]], 2: [[[0.0, 0.0], [100.0, 0.0], [100.0, 100.0], [0.0, 100.0]]]}
    rows = [(f, g, r) for f, gs in fires.items() for g, rs in gs.items() for r in rs] + [(9, 0, [[1.0, 1.0], [2.0, 1.0]]), (None, 1, [[0.0, 0.0], [1.0, 1.0], [1.0, 0.0]]), (8, 3, None)]
    rings = spark.createDataFrame(rows, "fire long, geom_id long, ring array<array<double>>")
    for band in (30.0, 100.0, 10_000.0):
        got = {r.fire: r.area_m2 for r in zones.union_area(rings, "fire", band).collect()}
        assert got.keys() == fires.keys()
        for f, gs in fires.items():
            assert abs(got[f] - area_by_hand(gs)) <= 1e-6 * got[f]
    assert abs(got[8] - 20_000) < 1e-6
