"""Order MinHash by rows: the limit on k-mers that are compared decides nothing of the result."""

import random

from pyspark.sql import functions as F
from test_operators import brute_signature, words

from scarmap.llm import order_minhash


def test_texts_done_again_have_the_same_signatures(spark, monkeypatch):
    rng = random.Random(31)
    texts = [words(rng, n) for n in (1, 2, 3, 5, 12, 13, 14, 40, 300)] + ["x " * 300, "a b c " * 40, "", None, " \n", "的一是在不" * 9]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[8])], "doc_id long, text string").repartition(3)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_chars)
    plain = sorted(order_minhash.edited_fingerprints(docs).collect(), key=key)
    keyed = docs.where("doc_id is not null").distinct()
    monkeypatch.setattr(order_minhash, "LOOKED", 2)
    # so few leave texts to be done again
    left = order_minhash.signatures(keyed, ["doc_id"], "text", 2).where(~F.col("whole")).count()
    assert left > 5
    assert sorted(order_minhash.edited_fingerprints(docs).collect(), key=key) == plain and len(plain) == len(texts) + 2
    got = {r.doc_id: r.s for r in order_minhash.with_signature(keyed, "text", "s").collect()}
    assert all(got[i] == brute_signature(t) for i, t in enumerate(texts))
    assert {r.doc_id: r.signature for r in plain if r.doc_id is not None} == got


def test_entries_are_rows_and_no_lambda(spark):
    """Hashing in all orders is the bulk of the work: no function of an array may do it, element by element."""
    df = spark.createDataFrame([(1, "a b c")], "row long, text string")
    plan = order_minhash.signatures(df, ["row"], "text")._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" in plan and "array_min(transform" not in plan
