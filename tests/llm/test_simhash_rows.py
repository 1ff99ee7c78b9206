"""SimHash dedup keeps rows, not ids."""

from scarmap.llm import simhash


def test_simhash_dedup_keeps_a_row_of_each_component(spark):
    texts = [" ".join(f"{x}{i}" for i in range(30)) for x in "abcd"]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1].upper()), (1, texts[2]), (1, texts[3]), (None, texts[2]), (2, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text.lower()) for r in simhash.simhash_dedup(docs).collect()]
    assert sorted(got, key=str) == sorted([(None, texts[0]), (None, texts[1]), (1, texts[2]), (1, texts[3])], key=str)
    assert simhash.simhash_dedup(docs.limit(0)).count() == 0
