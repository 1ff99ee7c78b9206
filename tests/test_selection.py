"""Medians by selection, and the threshold sweep by one component tree, against plain ways."""

import math
import random
import statistics

import numpy as np
from pyspark.sql import functions as F

from scarmap.operators import burn, validate
from scarmap.operators.ranking import medians


def test_medians_of_large_groups(spark):
    rng = random.Random(1)
    values = {
        "even": [rng.gauss(0, 1) for _ in range(400)],
        "odd": [rng.gauss(0, 1e9) for _ in range(401)],
        "ties": [rng.choice([1.0, 2.0, 2.0, 3.0]) for _ in range(300)],
        "two": [1.0] * 50 + [4.0] * 50,
        "one value": [7.5] * 120,
        "wide": [math.copysign(10.0 ** rng.uniform(-300, 300), rng.random() - 0.5) for _ in range(101)],
        "extreme": [-1.7e308] * 40 + [1.0] + [1.7e308] * 40,
        "small": [3.0, 1.0],
        "none": [None, float("nan")],
        None: [rng.random() for _ in range(90)],
    }
    rows = [(g, i, v) for g, vs in values.items() for i, v in enumerate(vs)] + [("even", 0, None), ("odd", 0, float("nan"))]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, n int, x double")
    want = {g: statistics.median(v) if (v := [x for x in vs if x is not None and x == x]) else None for g, vs in values.items()}
    for most, bins in ((1, 4096), (100, 512), (1 << 20, 4096)):
        got = {r.g: r["median"] for r in medians(df, ["g"], "x", most, bins).collect()}
        assert got.keys() == want.keys()
        assert all((got[g] is None) == (want[g] is None) and (want[g] is None or math.isclose(got[g], want[g], rel_tol=1e-12)) for g in want)
    assert medians(df.limit(0), ["g"], "x").count() == 0


def test_sweep_against_a_labelling_for_each_threshold(spark):
    rng = np.random.default_rng(2)
    rows = [(f, r, c, float(np.float32(rng.random()))) for f in (1, 2) for r in range(30) for c in range(30) if rng.random() < 0.95]
    pairs = spark.createDataFrame(rows, "fire long, row long, col long, dnbr double").withColumn("dnbr", F.col("dnbr").cast("float"))
    zone = pairs.where("col < 24 and row > 2").select("fire", "row", "col")
    truth = pairs.where("(row * 7 + col * 3) % 5 < 3").select("fire", "row", "col")
    thresholds = (0.66, 0.1, 0.35, 0.5)
    got = {(r.fire, r.seuil): (r.n_polygones, round(r.surface_detectee_ha / 0.04), round(r.precision, 9)) for r in validate.sweep(pairs, zone, truth, thresholds, 0.12, block=8).collect()}
    inside, true = {tuple(x) for x in zone.collect()}, {tuple(x) for x in truth.collect()}
    for t in thresholds:
        labels = burn.burn_components(burn.burn_mask(pairs, t), block=64).collect()
        for f in (1, 2):
            sizes = {}
            for x in labels:
                if x.fire == f:
                    sizes.setdefault(x.comp_id, []).append((f, x.row, x.col))
            kept = [[p for p in v if p in inside] for v in sizes.values() if len(v) * 0.04 >= 0.12]
            n = sum(map(len, kept))
            both = sum(p in true for v in kept for p in v)
            assert got[f, t] == (sum(bool(v) for v in kept), n, round(both / n, 9) if n else 0)


def test_chains_of_a_place_in_many_ranges(spark):
    from datetime import date, timedelta

    from scarmap.operators import records

    rng = random.Random(3)
    day = lambda n: date(2020, 1, 1) + timedelta(days=n)
    rows = []
    for i in range(600):
        a = rng.randint(0, 2500)
        rows.append((i, rng.choice([7, 7, 7, 7, None, 1, 9]), day(a) if rng.random() < 0.98 else None, day(a + rng.choice([0, 2, 30])) if rng.random() < 0.9 else None))
    df = spark.createDataFrame(rows, "id long, lieu long, premier date, dernier date")
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        got = {r.id: r.chain for r in records.chain_records(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    want = {}
    for place in {r[1] for r in rows}:
        latest, chain = None, 0
        for i, _, a, b in sorted((r for r in rows if r[1] == place and r[2]), key=lambda r: (r[2], r[0])):
            chain += latest is None or (a - latest).days > 10
            latest = b if latest is None else max(latest, b or latest)
            want[i] = chain
    assert got == want
