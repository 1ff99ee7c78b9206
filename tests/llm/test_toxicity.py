"""Toxicity: the model against plain counting, and held-out accuracy."""

import math
import random
import zlib
from collections import Counter

from pyspark.sql import functions as F

from scarmap.llm import toxicity as tx

LEVEL = tx.ORDER


def made_up(n, seed=4):
    rng = random.Random(seed)
    parts = ["ta", "ri", "mo", "len", "sko", "ve", "du", "pra", "ni", "gel"]
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(5, 120))]
        bad = rng.random() < 0.15
        if bad:
            words.insert(rng.randint(0, len(words)), rng.choice(["ozzig", "ozzigta", "Ozzigri", "wuxxle"]))
        rows.append((i, " ".join(words), int(bad)))
    return rows


def by_hand(texts, classes, discount):
    """llr of every gram that has an entry, and of the four letters before."""
    toxic, ordinary, every = Counter(), Counter(), set()
    for t, c in zip(texts, classes, strict=True):
        for w in set(tx.WORDS.findall((t or "").lower())):
            every.update(tx.grams(w))
            if c is not None:
                (toxic if c else ordinary).update(tx.grams(w))
    level = {LEVEL: every}
    for k in range(LEVEL - 1, 0, -1):
        level[k] = Counter(g[1:] for g in level[k + 1])

    def p(g):
        k, h = len(g), g[:-1]
        here = {x: n for x, n in level[k].items() if x[:-1] == h}
        lower = 1 / (len(level[1]) + 1) if k == 1 else p(g[1:])
        return (max(level[k][g] - 0.75, 0) + 0.75 * len(here) * lower) / sum(here.values())

    total, back = ({c: Counter() for c in "to"} for _ in range(2))
    for c, of in (("t", toxic), ("o", ordinary)):
        for g, n in of.items():
            total[c][g[:-1]] += n
            back[c][g[:-1]] += min(n, discount)
    share = lambda c, h: back[c][h] / total[c][h] if total[c][h] else 1.0
    out = {}
    for g in {*toxic, *ordinary}:
        h = g[:-1]
        if share("t", h) != 1 or share("o", h) != 1:
            out[h] = math.log(share("t", h) / share("o", h))
        if max(toxic[g], ordinary[g]) > discount:
            likely = [(max(of[g] - discount, 0) / total[c][h] if total[c][h] else 0) + share(c, h) * p(g[1:]) for c, of in (("t", toxic), ("o", ordinary))]
            out[g] = math.log(likely[0] / likely[1])
    return out


def test_entries_equal_plain_counting(spark):
    rows = [(i, t, c if i % 3 else None) for i, t, c in made_up(60)] + [(900, None, 1), (901, "", 0), (902, "7 8 !", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, class int").repartition(3)
    counts = tx.class_counts(docs)
    entries = {r.gram: r.llr for r in tx.evidence_entries(counts, tx.shared_probabilities(counts), 3.0).collect()}
    want = by_hand([t for _, t, _ in rows], [c for _, _, c in rows], 3.0)
    assert entries.keys() == want.keys()
    assert all(abs(entries[g] - want[g]) < 1e-9 for g in want)


def test_shared_probabilities_add_up_to_one_at_most(spark):
    docs = spark.createDataFrame([(i, t, None) for i, t, _ in made_up(40)], "doc_id long, text string, class int")
    sums = tx.shared_probabilities(tx.class_counts(docs)).groupBy(F.expr("substring(gram, 1, 3)")).agg(F.sum("p").alias("s")).collect()
    assert all(0 < r.s <= 1 + 1e-9 for r in sums)


def test_held_out_accuracy(spark):
    rows = made_up(1500)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, c) for i, _, c in rows if i % 2], "doc_id long, toxic int")
    got = {r.doc_id: r for r in tx.toxicity(docs, labels).collect()}
    assert len(got) == 1500
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for i, r in got.items())
    assert sum(got[i].predicted == c for i, _, c in rows) >= 0.99 * 1500


def test_labels_of_held_out_rows_are_not_learned(spark):
    rows = made_up(300)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    kept = [(i, c) for i, _, c in rows]
    turned = [(i, 1 - c if zlib.crc32(str(i).encode()) % 5 == 0 else c) for i, c in kept]
    scores = [sorted((r.doc_id, r.score) for r in tx.toxicity(docs, spark.createDataFrame(x, "doc_id long, toxic int")).collect()) for x in (kept, turned)]
    assert scores[0] == scores[1]


def test_odd_rows(spark):
    rows = made_up(200)
    docs = spark.createDataFrame([(i, t, "x", 1.0) for i, t, _ in rows] + [(None, "ozzig", "y", 2.0), (5000, None, None, None), (5001, "", "", 0.0), (5002, "12 !!", "", 0.0), (5003, "ozzigta " * 30000, "", 0.0), (5003, "ozzigta", "", 0.0)], "doc_id long, text string, toxic string, score double")
    labels = spark.createDataFrame([(i, c, "z") for i, _, c in rows] + [(0, None, "z"), (None, 1, "z"), (3, 7, "z")], "doc_id long, toxic int, text string")
    got = tx.toxicity(docs, labels).collect()
    assert len(got) == docs.count()
    by = {r.doc_id: r for r in got}
    assert by[None].predicted == 1 and not by[None].held_out
    assert by[5000].score == by[5001].score == by[5002].score < 0.5
    assert {r.score for r in got if r.doc_id == 5003} == {by[5003].score} and by[5003].predicted == 1
    for d, lab in ((docs, labels.limit(0)), (docs, labels.where("toxic = 0")), (docs.limit(0), labels)):
        assert all(r.score == 0 and r.predicted == 0 for r in tx.toxicity(d, lab).collect())


def test_model_does_not_switch_with_its_size(spark, monkeypatch):
    """A model of more entries than go to the tasks has the same scores, to the last bit."""
    rows = made_up(300) + [(5000, None, 0), (5001, "", 0), (5002, "x" * 5000 + " ozzig", 0), (5002, "ÖzZig ∂ 的一", 0)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, "wuxxle")], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, c) for i, _, c in rows], "doc_id long, toxic int")
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.score)
    whole = sorted(tx.toxicity(docs, labels).collect(), key=key)
    monkeypatch.setattr(tx, "MOST_ENTRIES", 5)
    bounded = sorted(tx.toxicity(docs, labels, 5).collect(), key=key)
    assert bounded == whole and len(whole) == len(rows) + 1 and len({r.score for r in whole}) > 20


def test_every_label_that_is_not_held_out_is_learned(spark):
    labels = spark.range(300_000).select(F.col("id").alias("doc_id"), F.lit(0).alias("toxic"))
    kept = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(300_000))
    assert kept > 200_000 and tx.learned_labels(labels).count() == kept


def test_words_are_those_of_the_plain_pattern():
    rng = random.Random(8)
    signs = "abzABZ09_ -.,\n\x1c\x7f\x85\u00a0éßİΣσ½²٣的一\u0301\u200bǅ"
    texts = ["".join(rng.choice(signs[:n]) for _ in range(rng.randint(0, 40))) for n in (16, len(signs)) for _ in range(1500)] + [None, ""]
    assert all(tx.words_of(t) == set(tx.WORDS.findall((t or "").lower())) for t in texts)


def test_words_seen_before_are_not_looked_at_again(monkeypatch):
    """Neither words that say nothing nor others are; and forgetting them changes no evidence."""
    rows = [t for _, t, _ in made_up(120)] + ["word", "", None, "x" * 100]
    entries = {g: rng for i, g in enumerate(sorted({g for t in rows for w in tx.words_of(t) for g in tx.grams(w)})) if (rng := (i * 7919) % 2001 - 1000)}
    plain = tx.Evidence(entries)
    want = [max([0.0, *(plain.word(w) for w in tx.words_of(t))]) for t in rows]
    looked = tx.Evidence(entries)
    assert [looked.document(t) for t in rows] == want and looked.document("x" * 100) == want[-1]
    monkeypatch.setattr(looked, "word", lambda w: 1 / 0)
    assert [looked.document(t) for t in rows[:-1]] == want[:-1]
    monkeypatch.undo()
    monkeypatch.setattr(tx, "REMEMBERED", 7)
    small = tx.Evidence(entries)
    assert [small.document(t) for t in rows] == want and len(small.seen) <= 7
