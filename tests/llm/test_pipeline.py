import random

import corpus_pipeline
from scarmap.llm import line_dedup

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus(spark):
    rng = random.Random(3)
    en, fr = "the cat sat on a mat with this other thing and went".split(), "le chat est sur une table avec cette chose et va".split()
    text = lambda w, n: "\n".join(" ".join(rng.choice(w) + rng.choice(["", "s", "ed"]) for _ in range(14)) for _ in range(n))
    rows = [(i, text(en if i % 2 else fr, 6), "en" if i % 2 else "fr", f"src{i % 3}") for i in range(80)]
    rows += [(100, rows[3][1], "en", "src0"), (101, "12345 ??? 678", "en", "src0"), (102, None, "en", None), (103, "", None, "src1")]
    rows += [(104, rows[5][1].split("\n")[0] + "\n" + text(en, 5), "en", "src1")]
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long"), rows


def test_stages(spark, tmp_path):
    docs, rows = corpus(spark)
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, seen[-1], str(tmp_path))
        out.write.parquet(str(tmp_path / f"s{len(seen)}"))
        seen.append(spark.read.parquet(str(tmp_path / f"s{len(seen)}")))
    assert all(s.columns == COLUMNS for s in seen[:-1])
    first = {r.doc_id for r in seen[1].collect()}
    assert first == {r[0] for r in rows} - {101, 102, 103}
    lined = {r.doc_id: r for r in seen[2].collect()}
    assert 100 not in lined  # an exact copy has no line left
    copied = line_dedup.normalised(rows[5][1].split("\n")[0])
    assert sum(copied in line_dedup.normalised(r.text) for r in lined.values()) == 1
    assert all(r.n_chars == len(r.text) for r in lined.values())
    assert set(range(80)) <= set(lined)
    near = {r.doc_id for r in seen[3].collect()}
    assert near == set(lined)
    mixed = [r.doc_id for r in seen[4].collect()]
    assert set(mixed) <= near and max(mixed.count(i) for i in set(mixed)) <= 2
    assert seen[5].count() == len(mixed)


def test_empty(spark, tmp_path):
    docs, _ = corpus(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
