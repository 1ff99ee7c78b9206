"""Duplicate fires merged in groups and in rounds, against the rule in plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from scarmap.operators import publish


def merged(fires, cells, over=0.3):
    """The rule as it is told: fires by falling area, each meets the kept ones in order."""
    kept = []
    for f in sorted(fires, key=lambda f: (-f["area"], f["id"])):
        own = cells.get(f["id"], set())
        f = f | {"cells": own, "fusionnes": [], "alertes": []}
        home = next((k for k in kept if len(own & k["cells"]) > over * min(len(own), len(k["cells"]))), None)
        if home is None:
            kept.append(f)
        elif (home["statut"] or "mesure") == (f["statut"] or "mesure"):
            home["cells"] = home["cells"] | own
            home["n_points_chauds"] += f["n_points_chauds"]
            home["fusionnes"].append(f["feu"])
            home["premier"], home["dernier"] = min(home["premier"], f["premier"]), max(home["dernier"], f["dernier"])
        else:
            measure, estimate = (home, f) if (home["statut"] or "mesure") == "mesure" else (f, home)
            if len(estimate["cells"]) > 1.3 * len(measure["cells"]):
                measure["alertes"].append(f"chaleur détectée sur ~{len(estimate['cells']) * 0.04:.0f} ha, au-delà du périmètre mesuré — le feu déborde probablement de l'image")
            if measure is f:
                kept[next(i for i, k in enumerate(kept) if k is home)] = f
    return sorted((k["id"], k["feu"], k["statut"] or "mesure", k["n_points_chauds"], k["premier"], k["dernier"], round(len(k["cells"]) * 0.04, 6), tuple(k["fusionnes"]), tuple(k["alertes"])) for k in kept)


@pytest.fixture(scope="module")
def landscape(spark):
    rng = random.Random(21)
    fires, cells = [], {}
    for i in range(90):
        x, y, w, h = rng.randrange(60), rng.randrange(60), rng.randint(2, 14), rng.randint(2, 14)
        cells[i] = {(a - 20, b - 20) for a in range(x, x + w) for b in range(y, y + h) if rng.random() < 0.95}
        day = dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(30))
        fires.append({"id": i, "feu": f"F{i}", "statut": rng.choice(["mesure", "en_attente", None, "mesure"]), "area": float(len(cells[i]) + rng.randrange(3)), "n_points_chauds": rng.randrange(50), "premier": day, "dernier": day + dt.timedelta(days=rng.randrange(6))})
    fires.append({"id": 900, "feu": "bare", "statut": "mesure", "area": 0.0, "n_points_chauds": 1, "premier": day, "dernier": day})
    schema = "id long, feu string, statut string, area double, n_points_chauds long, premier date, dernier date"
    df = spark.createDataFrame([tuple(f.values()) for f in fires], schema)
    c = spark.createDataFrame([(i, a, b) for i, s in cells.items() for a, b in s], "id long, cx long, cy long")
    return df, c.unionByName(c.where("id % 7 = 0")), merged(fires, cells)


@pytest.mark.parametrize("group_cells", [1 << 18, 0, 400])
def test_merge_follows_the_rule(landscape, group_cells):
    fires, cells, want = landscape
    got = publish.merge_duplicates(fires, cells, group_cells=group_cells).collect()
    assert sorted((r.id, r.feu, r.statut, r.n_points_chauds, r.premier, r.dernier, round(r.area_ha, 6), tuple(r.fusionnes), tuple(r.alertes)) for r in got) == want
    assert 20 < len(want) < 85 and any(w[7] for w in want) and any(w[8] for w in want)


def test_merge_of_nothing(spark, landscape):
    fires, cells, _ = landscape
    assert publish.merge_duplicates(fires.limit(0), cells.limit(0)).count() == 0
    alone = publish.merge_decisions(fires.limit(3), cells.limit(0)).groupBy("fate").agg(F.count("*").alias("n")).collect()
    assert [(r.fate, r.n) for r in alone] == [("kept", 3)]
