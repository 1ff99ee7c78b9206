"""Lines of a template, all in crowded buckets, against all pairs; lines of every length."""

import random

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F
from scarmap.llm import line_dedup, registry, similar_sets

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def templated(n=1200, seed=4):
    """Lines that share 115 of about 150 characters, some of them with one true partner."""
    rng = random.Random(seed)
    made = lambda k: "".join(rng.choice(LETTERS) for _ in range(k))
    common = made(115)
    lines = []
    for i in range(n):
        own = made(24)
        lines.append(common + own)
        if i % 10 == 0:
            lines.append(common + own[:-6] + made(6))
    return lines


def test_true_pairs_of_crowded_buckets_are_all_linked(spark):
    lines = templated()
    keys = line_dedup.band_keys(lines)
    shingles = [{x[i : i + 10] for i in range(len(x) - 9)} for x in lines]
    by_band = {}
    for i, row in enumerate(keys.tolist()):
        for k in row:
            by_band.setdefault(k, []).append(i)
    assert max(map(len, by_band.values())) > 500
    pairs = [(i, i + 1) for i in range(len(lines) - 1) if len(shingles[i] & shingles[i + 1]) >= 0.8 * len(shingles[i] | shingles[i + 1])]
    want = [(i, j) for i, j in pairs if (keys[i] == keys[j]).any()]
    assert len(want) > 100
    ids = [line_dedup.line_key(x) for x in lines]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string").withColumn("row", F.xxhash64("text"))
    keyed = line_dedup.line_places(docs)
    found = []
    for block, elements in ((4096, 1 << 22), (64, 1 << 20), (4096, 3000)):  # a block each, several by count, several by size
        got = {r.node: r.component for r in line_dedup.similar_lines(docs, keyed, block=block, elements=elements).collect()}
        assert all(ids[i] in got and got[ids[i]] == got.get(ids[j]) for i, j in want)
        assert len(set(got.values())) >= len(want) - 5  # unlike lines are not joined
        found.append(got)
    assert found[0] == found[1] == found[2]


def test_shared_counts_and_likenesses(monkeypatch):
    rng = random.Random(2)
    sets = [[rng.randrange(300) for _ in range(rng.randint(0, 80))] for _ in range(40)]
    values = np.array([(x * 0x9E3779B97F4A7C15) % (1 << 64) for s in sets for x in s], np.uint64)
    lengths = np.array([len(s) for s in sets])
    want = [[len(set(a) & set(b)) for b in sets] for a in sets]
    assert similar_sets.shared_counts(values, lengths).tolist() == want
    monkeypatch.setattr(similar_sets, "MATRIX", 40 * 7)
    assert similar_sets.shared_counts(values, lengths).tolist() == want
    a, b = np.array([(i, j) for i in range(40) for j in range(40)]).T
    like = [len(set(sets[i]) & set(sets[j])) / max(1, len(set(sets[i]) | set(sets[j]))) if sets[i] or sets[j] else 1.0 for i, j in zip(a, b, strict=True)]
    assert similar_sets.likenesses(values, lengths, a, b).tolist() == like
    monkeypatch.setattr(similar_sets, "HELD", 100)
    assert similar_sets.likenesses(values, lengths, a, b).tolist() == like


def test_shingle_sets_of_lines():
    lines = ["short", "", "exactly te", "a longer line, with a longer line", "x" * 30]
    values, lengths = line_dedup.shingle_sets(lines)
    assert lengths.tolist() == [1, 1, 1, 24, 21] and len(values) == 48
    assert values[2] == line_dedup.shingle_sets(["exactly te"])[0][0] and len(set(values[-21:].tolist())) == 1
    assert line_dedup.shingle_sets([])[1].tolist() == []


def test_a_long_line_is_hashed_in_pieces(monkeypatch):
    rng = random.Random(8)
    lines = ["".join(rng.choice(LETTERS) for _ in range(n)) for n in (5000, 10, 400, 1009, 12)]
    whole = line_dedup.band_keys(lines)
    monkeypatch.setattr(line_dedup, "AT_ONCE", 100)
    assert (line_dedup.band_keys(lines) == whole).all()


def test_queries_drop_short_copies(spark, tmp_path):
    short = ["ok", "Read more", "all rights reserved here", "x" * 39, "\u00e9"]
    rows = [(i, "\n".join([f"line of document {i * 7919} alone {'abcdefgh'[i] * 30}", "", *short, ""])) for i in range(8)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    want = {0: rows[0][1]} | {i: "\n".join([t.split("\n")[0], "", ""]) for i, t in rows if i}
    got = registry.queries()["op8_line_dedup"](spark, str(tmp_path)).collect()
    assert {r.doc_id: r.text for r in got} == want and {r.n_dropped for r in got} == {0, len(short)}
    assert {r.doc_id: r.text for r in corpus_pipeline.line_stage(spark, docs, str(tmp_path)).collect()} == want
