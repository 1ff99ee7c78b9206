"""What jobs leave behind: tables of their inner steps and shuffle files."""

import os
import random

import pytest
from pyspark.sql import functions as F

from scarmap.jobs import zone_queries
from scarmap.operators import burn, outlines
from scarmap.shared import discard, discard_all, shared_folder, steps, written


def _tables(spark):
    folder = shared_folder(spark)
    return sorted(n.rpartition("-")[0] for n in os.listdir(folder) if "-" in n and os.path.isdir(f"{folder}/{n}"))


def test_a_publication_leaves_what_its_result_reads(spark, sf_dir):
    discard_all(spark)
    before = _tables(spark)
    out = zone_queries.wc_publish_site(spark, sf_dir)
    left = _tables(spark)
    for name in before:
        left.remove(name)
    assert set(left) - {"ranges"} == {"patched", "site", "site_journal", "site_features", "site_records"}
    assert out.count() > 0
    discard_all(spark)


def test_steps_delete_what_is_not_kept(spark):
    discard_all(spark)
    before = _tables(spark)
    with steps(spark) as kept:
        with steps(spark) as inner:
            written(spark.range(3), "gone")
            a = inner(written(spark.range(4), "outer"))
        b = kept(written(a.where("id > 0"), "stays"))
        assert a.count() == 4
    assert b.count() == 3 and sorted([*before, "stays"]) == _tables(spark)
    with pytest.raises(ValueError, match="stop"), steps(spark):
        written(spark.range(3), "gone")
        raise ValueError("stop")
    discard(b)
    assert before == _tables(spark)


def _shuffle_files(spark):
    every = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (every.apply(i).getName() for i in range(every.length())) if n.endswith(".data")}


def test_written_tables_leave_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    t = written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n")))
    assert not _shuffle_files(spark) - before and t.count() == 7
    discard(t)


def test_free_sides(spark):
    rng = random.Random(5)
    cells = {(f, r, c) for f in (1, 2) for r in range(505, 520) for c in range(-4, 9) if rng.random() < 0.6}
    labels = spark.createDataFrame([(f, 7, r, c) for f, r, c in cells], "fire long, comp_id long, row long, col long")
    free = {p: sum((p[0], p[1] + dr, p[2] + dc) not in cells for dr, dc in ((0, 1), (0, -1), (1, 0), (-1, 0))) for p in cells}
    got = burn.boundary(labels).collect()
    assert len(got) == len({(r.fire, r.row, r.col) for r in got}) and {(r.fire, r.row, r.col): r.sides for r in got} == {p: n for p, n in free.items() if n}
    want = set()
    for f, r, c in cells:
        for (dr, dc), side in (((-1, 0), (c + 1, r, c, r)), ((1, 0), (c, r + 1, c + 1, r + 1)), ((0, -1), (c, r, c, r + 1)), ((0, 1), (c + 1, r + 1, c + 1, r))):
            if (f, r + dr, c + dc) not in cells:
                want.add((f, *side))
    edges = [(e.fire, e.x0, e.y0, e.x1, e.y1) for e in outlines.boundary_edges(labels).collect()]
    assert len(edges) == len(want) and set(edges) == want
