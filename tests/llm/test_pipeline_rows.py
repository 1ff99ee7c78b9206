"""All stages on rows that repeat ids, lack them, or have columns of clashing names."""

import corpus_pipeline


def test_stages_keep_rows_and_columns(spark, tmp_path):
    line = lambda a, i: f"{a} " + " ".join(f"{a}{(i * 7 + j) % 29}x the and of" for j in range(12))
    texts = [line(w, i) for i, w in enumerate("cat dog hen fox owl bee ant elk".split())]
    rows = [(1, texts[0]), (1, texts[1]), (None, texts[2]), (None, texts[3]), (2, texts[4]), (2, texts[4]), (3, texts[5]), (None, texts[5]), (4, None), (5, ""), (6, "12 34"), (7, texts[6]), (8, texts[7] + " end")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, p string, row int, t string, r string, `_key` int, component string, n_lines int, m map<string, int>, `a.b` int, `row.text` string"
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or ""), "p", 1, "t", "r", 2, "c", 3, {"k": 1}, 4, "q") for d, t in rows], schema)
    now = docs
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        seen.append(now)
    named = [(r.doc_id, r.text) for r in seen[0].collect()]
    assert sorted(named, key=str) == sorted(((d, t) for d, t in rows if t and "the" in t), key=str)
    for s in seen[:4]:
        assert docs.columns == s.columns and all((r.p, r.row, r.t, r.r, r["_key"], r.component, r.n_lines, r.m, r["a.b"], r["row.text"]) == ("p", 1, "t", "r", 2, "c", 3, {"k": 1}, 4, "q") for r in s.collect())
    near = sorted(((r.doc_id, r.text) for r in seen[2].collect()), key=str)
    lined = {(r.doc_id, r.text) for r in seen[1].collect()}
    # Of the text that doc 3 and a row without an id share, the line of the latter, which sorts first, is kept.
    assert [d for d, _ in near] == [1, 1, 2, 7, 8, None, None, None]
    assert set(near) <= lined and len([d for d, _ in near if d == 1]) == 2
    assert seen[4].columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"] and seen[4].count() == seen[3].count() > 0
