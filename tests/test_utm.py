"""UTM against known places, a round trip and areas by finite differences."""

import math
import random

from pyspark.sql import functions as F

from scarmap.functions import utm


def test_known_places_and_round_trip(spark):
    rng = random.Random(1)
    rows = [(0, 0.0, 3.0), (1, 45.0, 3.0), (2, 0.0, 6.0 - 1e-12)] + [(i, rng.uniform(-80, 84), rng.uniform(-180, 179.9)) for i in range(3, 400)] + [(400, None, 3.0)]
    df = spark.createDataFrame(rows, "i int, lat double, lon double").withColumn("zone", utm.zone_of(F.col("lon")))
    e, n = utm.utm(F.col("lat"), F.col("lon"), F.col("zone"))
    df = df.withColumn("e", e).withColumn("n", n)
    lat, lon = utm.from_utm(F.col("e"), F.col("n"), F.col("zone"), F.col("lat") < 0)
    got = {r.i: r for r in df.withColumn("lat2", lat).withColumn("lon2", lon).collect()}
    assert got[400].e is None and got[0].zone == 31
    assert (round(got[0].e, 6), round(got[0].n, 6)) == (500000.0, 0.0)
    assert abs(got[1].e - 500000) < 1e-6 and abs(got[1].n - 0.9996 * 4984944.378) < 2e-3  # the meridian's length to 45 degrees
    assert abs(got[2].e - 833978.557) < 2e-3  # three degrees from the meridian, on the equator
    for r in got.values():
        if r.lat is not None:
            assert abs(r.lat2 - r.lat) * 111_000 < 1e-3 and abs(r.lon2 - r.lon) * 111_000 * math.cos(math.radians(r.lat)) < 1e-3


def test_pixel_areas(spark):
    """A pixel's area against the ellipsoid's, by the latitude and longitude of its sides."""
    rng = random.Random(2)
    rows = [(rng.uniform(200_000, 800_000), rng.uniform(4_500_000, 5_700_000)) for _ in range(60)]
    df = spark.createDataFrame(rows, "e double, n double")
    z, s = F.lit(31), F.lit(False)
    at = lambda de, dn: F.struct(*[c.alias(k) for k, c in zip(("lat", "lon"), utm.from_utm(F.col("e") + de, F.col("n") + dn, z, s), strict=True)])
    h = 500.0
    got = df.select(utm.pixel_area_m2(F.col("e"), F.col("n"), z, s, 2 * h).alias("area"), *[at(a * h, b * h).alias(k) for k, a, b in (("w", -1, 0), ("o", 1, 0), ("s", 0, -1), ("n", 0, 1), ("m", 0, 0))]).collect()
    for r in got:
        sine = math.sin(math.radians(r.m.lat))
        w = 1 - utm.E**2 * sine * sine
        across, along = utm.A / math.sqrt(w) * math.cos(math.radians(r.m.lat)), utm.A * (1 - utm.E**2) / w**1.5
        x1, y1 = math.radians(r.o.lon - r.w.lon) * across, math.radians(r.o.lat - r.w.lat) * along
        x2, y2 = math.radians(r.n.lon - r.s.lon) * across, math.radians(r.n.lat - r.s.lat) * along
        assert abs(abs(x1 * y2 - x2 * y1) / r.area - 1) < 1e-5
