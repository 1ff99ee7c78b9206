"""Near copies against brute force over all pairs."""

import random

import corpus_pipeline
from pyspark.sql import functions as F
from scarmap.llm import similar_sets


def shingles(text, k=5):
    w = text.split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def components(sets, similar=0.8):
    comp = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if comp[i] != comp[j] and len(a & sets[j]) >= similar * len(a | sets[j]) - 1e-9:
                comp = [comp[j] if c == comp[i] else c for c in comp]
    return comp


def planted(rng, n=60):
    """Texts, a copy of each with 1 to 4 words replaced (likeness 0.8 to 0.95, mostly), and a
    crowd that shares half of its words."""
    word = lambda: f"w{rng.randrange(5000)}"
    texts = []
    for i in range(n):
        w = [word() for _ in range(200)]
        texts.append(" ".join(w))
        for at in rng.sample(range(200), 1 + i % 5):
            w[at] = word()
        texts.append(" ".join(w))
    shared = [word() for _ in range(150)]
    for _ in range(40):
        w = shared + [word() for _ in range(30)]
        texts += [" ".join(w), " ".join(w[:-3])]
    return texts


def test_near_copy_stage_against_all_pairs(spark, tmp_path):
    texts = planted(random.Random(12))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, source string")
    got = {r.doc_id for r in corpus_pipeline.near_copy_stage(spark, docs, str(tmp_path)).collect()}
    comp = components([shingles(t) for t in texts])
    assert got == {min(i for i in range(len(comp)) if comp[i] == c) for c in set(comp)}
    assert len(got) < len(texts) - 40


def test_near_copy_stage_keeps_rows(spark, tmp_path):
    t = ["one two three four five six seven " + x * 9 for x in ("a ", "b ", "c ", "d ")]
    rows = [(None, t[0]), (None, t[1]), (None, t[1]), (1, t[2]), (1, t[3]), (None, t[2]), (2, t[3].upper()), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(str, corpus_pipeline.near_copy_stage(spark, docs, str(tmp_path)).collect()))
    assert len(got) == 5 and sum("doc_id=None" in r for r in got) == 2 and sum("doc_id=1" in r for r in got) == 2
    assert any("doc_id=3" in r for r in got)


def test_prefix_pairs_leave_no_pair_out(spark):
    rng = random.Random(5)
    base = [set(rng.sample(range(400), rng.randint(1, 40))) for _ in range(60)]
    sets = base + [(s - set(rng.sample(sorted(s), len(s) // 9))) | {rng.randrange(400)} for s in base]
    df = spark.createDataFrame([(i, i, sorted(s)) for i, s in enumerate(sets)], "id long, component long, grams array<long>")
    got = {(r.src, r.dst) for r in similar_sets.prefix_pairs(df, 0.8).collect()}
    want = {(i, j) for i, a in enumerate(sets) for j in range(i) if len(a & sets[j]) >= 0.8 * len(a | sets[j]) - 1e-9}
    assert want and want <= got
    assert similar_sets.prefix_pairs(df.withColumn("component", F.lit(1)), 0.8).count() == 0
