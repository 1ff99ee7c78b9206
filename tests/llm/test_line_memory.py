"""What the line stage holds: temporaries of a worker, and texts in its last join."""

import random
import re
import tracemalloc

import corpus_pipeline
import numpy as np
import pyarrow as pa
from scarmap.llm import line_dedup, similar_sets


def peak_mb(work):
    tracemalloc.start()
    try:
        out = work()
        return out, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_pairs_are_sorted_in_parts():
    values = np.random.default_rng(1).integers(0, 1 << 63, 500_000, dtype=np.uint64)
    lengths = np.full(5000, 100)
    values = np.concatenate([values, values])  # set i + 5000 is set i
    lengths = np.concatenate([lengths, lengths])
    got, mb = peak_mb(lambda: similar_sets.likenesses(values, lengths, np.arange(5000), np.arange(5000) + 5000))
    assert (got == 1).all()
    assert mb < 40  # 41 where HELD elements are sorted at once


def test_hashes_of_runs_hold_few_arrays():
    points = np.random.default_rng(2).integers(32, 127, 1_000_000, dtype=np.uint32)
    got, mb = peak_mb(lambda: line_dedup._run_hashes(points))
    c, values = 0x9E3779B97F4A7C15, [0] * 3
    for i in range(3):
        for p in points[i : i + 10].tolist():
            values[i] = (values[i] * c + p + 1) % (1 << 64)
    assert got[:3].tolist() == line_dedup._mixed(np.array(values, np.uint64)).tolist()
    assert len(got) == 1_000_000 - 9
    assert mb < 36  # an array takes 8


def test_lines_leave_a_batch_in_parts_and_once():
    rng = random.Random(3)
    made = [" ".join(str(rng.randrange(10**9)) for _ in range(20)) for _ in range(3000)]
    texts = [f"{x}\nCommon  line of all\n{x}" for x in made] + [None, ""]
    parts = list(line_dedup._texts(1)([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])]))
    lines = [x for part in parts for x in part.column("line").to_pylist()]
    assert sorted(lines) == sorted({*made, "common line of all"})
    assert [x for part in parts for x in part.column("line_id").to_pylist()] == [line_dedup.line_key(x) for x in lines]
    assert max(sum(map(len, part.column("line").to_pylist())) for part in parts) < line_dedup.AT_ONCE + 1000 < sum(map(len, lines))


def test_texts_go_through_the_last_join_once(spark):
    docs = spark.createDataFrame([(1, "one line\nof two", 15, "web"), (2, "one line\nmore", 13, "web")], "doc_id long, text string, n_chars long, source string")
    out = corpus_pipeline.line_stage(spark, docs, "")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan
    assert not re.search(r"struct\([^\n]*, text, text#", plan), plan
    assert sorted(map(tuple, out.collect())) == [(1, "one line\nof two", 15, "web"), (2, "more", 4, "web")]
