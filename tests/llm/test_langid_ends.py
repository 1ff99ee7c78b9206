"""Texts whose only letter is the last code point."""

from scarmap.llm import langid


def test_one_letter_texts_have_a_language(spark, monkeypatch):
    rows = [(i, "a cat and a dog b", "en") for i in range(20)] + [(100, "a", None), (101, "5 b", None), (102, "5 6", None), (103, None, None), (104, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.language_id(docs).collect()}
    assert [got[i] for i in range(100, 105)] == ["en", "en", "und", "und", "und"]
    whole = [a.tolist() for a in langid.trigrams("ab, cd e f")]
    for at_once in (1, 2, 3, 10):
        monkeypatch.setattr(langid, "COUNTED_AT_ONCE", at_once)
        assert [a.tolist() for a in langid.trigrams("ab, cd e f")] == whole
