"""Toxicity by class-conditional Kneser-Ney models of letters.

A word is read letter by letter, each after the four before it, beginning from its edge. Each class
has counts of its own for these five letters (in how many of its documents' words); below them
stand shared backoff counts, Kneser-Ney continuation counts (after how many different letters
something comes) of every word in the corpus, labelled or not. So expressions that the labelled
texts hold rarely are smoothed by what the whole corpus says, alike for both classes.

The difference of the two log-likelihoods of a word, normalised by its length, is its evidence, and
a document goes by its strongest word: a mean over the whole text would drown one word in a long
one. A logistic curve, fitted to labelled documents, makes a score of it.

Class counts are those of every labelled document that isn't held out, the shared counts those of the
whole corpus; both are tables that are never gathered in one place. Where neither class has more of
some five letters than the discount takes away, the shared probability cancels, so only the five
letters that a class has often have an entry, and one number for each four letters before them.
Entries are whole numbers, whose sums are the same in any order: a table of few of them goes to the
tasks, a larger one is joined with the corpus's words, and either way gives the same evidence.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scarmap.llm.langid import held_out
from scarmap.shared import discard, written

#: Letters looked at together.
ORDER = 5
#: The edge of a word, before and after it.
EDGE = "\n"
WORDS = re.compile(r"[^\W\d_]+")
_BLANKED = {i: " " for i in range(128) if not chr(i).isalpha()}
_STRETCHES = re.compile(r"[a-z\x80-\U0010ffff]+")
#: What is taken from each class count for the shared backoff, and from shared counts.
CLASS_DISCOUNT, SHARED_DISCOUNT = 3.0, 0.75
#: Entries that go to the tasks, at most; more of them stay a table. The evidence is the same.
MOST_ENTRIES = 1 << 20
#: Parts of one that entries are rounded to.
UNITS = 1 << 32
#: Words a task counts, and five-letter counts it holds, before it hands them on.
COUNTED_WORDS, COUNTED_GRAMS = 1 << 17, 1 << 18
#: Documents whose words a task hands on at a time, and grams.
HANDED_DOCS, HANDED_GRAMS = 256, 1 << 16
#: Words of up to so many letters are remembered, so many of them.
REMEMBERED_CHARS, REMEMBERED = 48, 1 << 17
#: Steps of evidence in which labelled documents are counted for the curve.
STEPS = 20
TOXIC, ORDINARY = 1, 0


def grams(word: str, order: int = ORDER) -> list[str]:
    """The letters of a word, and the edge after it, each with the ``order`` - 1 before it."""
    padded = EDGE * (order - 1) + word + EDGE
    return [padded[i : i + order] for i in range(len(word) + 1)]


def words_of(text: str | None) -> set[str]:
    """The different words of a text in lower case, as WORDS finds them: in ASCII what is left of it without
    other characters; else stretches that can hold words are looked at once each."""
    lower = (text or "").lower()
    if lower.isascii():
        return set(lower.translate(_BLANKED).split())
    out = set()
    for piece in set(_STRETCHES.findall(lower)):
        if piece.isalpha():
            out.add(piece)
        else:
            out.update(WORDS.findall(piece))
    return out


def learned_labels(labels: DataFrame) -> DataFrame:
    """``(doc_id, class)`` of every labelled document that isn't held out. A document that any label
    calls toxic is toxic; other labels than 0 and 1 say nothing."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(TOXIC, ORDINARY) & ~held_out(F.col("doc_id")))
    return known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("class"))


def class_counts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """``(gram, toxic, ordinary)`` for every gram of every word of ``docs(text, class)``: how often
    documents of a class have it, each document's different words counted once. Rows without a class
    bring their grams, with counts of 0.

    Tasks count words, and then the grams of different words, before anything is shuffled.
    """
    schema = pa.schema([("gram", pa.string()), ("toxic", pa.int64()), ("ordinary", pa.int64())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, found = (Counter(), Counter(), set()), (Counter(), Counter(), set())

        def settle() -> None:
            for of, into in zip(words[:2], found[:2], strict=True):
                into.update(chain.from_iterable(grams(w, order) for w, n in of.items() if n == 1))
                for w, n in of.items():
                    if n > 1:
                        for g in grams(w, order):
                            into[g] += n
            for w in words[2]:
                found[2].update(grams(w, order))
            for x in words:
                x.clear()

        def handed() -> pa.RecordBatch:
            every = list(found[2].union(*found[:2]))
            out = pa.RecordBatch.from_pydict({"gram": every, "toxic": [found[0][g] for g in every], "ordinary": [found[1][g] for g in every]}, schema)
            for x in found:
                x.clear()
            return out

        for batch in batches:
            for text, kind in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                own = words_of(text.as_py())
                words[2 if kind is None else 0 if kind == TOXIC else 1].update(own)
                if sum(map(len, words)) > COUNTED_WORDS:
                    settle()
                    if sum(map(len, found)) > COUNTED_GRAMS:
                        yield handed()
        settle()
        yield handed()

    parts = docs.select("text", "class").mapInArrow(counted, "gram string, toxic long, ordinary long")
    return parts.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def shared_probabilities(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """``(gram, p)`` for all grams of ``order`` - 1 letters: the Kneser-Ney probability of the last
    letter after the others, from continuation counts of the whole corpus."""
    levels = {order: counts.select("gram")}
    for k in range(order - 1, 0, -1):
        levels[k] = levels[k + 1].groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(F.count("*").cast("double").alias("n"))
    letters = written(levels[1], "letters")
    total, kinds = letters.agg(F.sum("n"), F.count("*")).first()
    total, kinds = total or 1.0, kinds or 0
    out = letters.select("gram", ((F.greatest(F.col("n") - SHARED_DISCOUNT, F.lit(0.0)) + SHARED_DISCOUNT * kinds / (kinds + 1)) / total).alias("p"))
    for k in range(2, order):
        before = Window.partitionBy(F.expr(f"substring(gram, 1, {k - 1})"))
        here = levels[k].select("gram", "n", F.sum("n").over(before).alias("total"), F.count("*").over(before).alias("kinds"), F.expr("substring(gram, 2)").alias("shorter"))
        lower = out.select(F.col("gram").alias("shorter"), F.col("p").alias("q"))
        kept = (F.greatest(F.col("n") - SHARED_DISCOUNT, F.lit(0.0)) + SHARED_DISCOUNT * F.col("kinds") * F.col("q")) / F.col("total")
        out = here.join(lower, "shorter").select("gram", kept.alias("p"))
    return out


def evidence_entries(counts: DataFrame, shared: DataFrame, discount: float, order: int = ORDER) -> DataFrame:
    """``(gram, llr)``: the logarithm of how many times likelier the toxic class makes the last
    letter of a gram. A gram of ``order`` - 1 letters stands for all that begin with it and have no
    entry of their own; 0 where it has none either."""
    before = Window.partitionBy("before")
    seen = counts.where("toxic > 0 or ordinary > 0").withColumn("before", F.expr(f"substring(gram, 1, {order - 1})"))
    for c in ("toxic", "ordinary"):
        seen = seen.withColumn(f"{c}_total", F.sum(c).over(before)).withColumn(f"{c}_back", F.sum(F.least(F.col(c).cast("double"), F.lit(discount))).over(before))
    back = {c: F.when(F.col(f"{c}_total") > 0, F.col(f"{c}_back") / F.col(f"{c}_total")).otherwise(1.0) for c in ("toxic", "ordinary")}
    often = (F.col("toxic") > discount) | (F.col("ordinary") > discount)
    seen = seen.select("gram", "before", often.alias("often"), *[f"{c}{x}" for c in back for x in ("", "_total")], *[b.alias(f"{c}_share") for c, b in back.items()])
    joined = seen.where("often").withColumn("suffix", F.expr("substring(gram, 2)")).join(shared.withColumnRenamed("gram", "suffix"), "suffix")
    likely = {
        c: F.when(F.col(f"{c}_total") > 0, F.greatest(F.col(c) - discount, F.lit(0.0)) / F.col(f"{c}_total")).otherwise(0.0) + F.col(f"{c}_share") * F.col("p")
        for c in back
    }
    own = joined.select("gram", F.log(likely["toxic"] / likely["ordinary"]).alias("llr"))
    rest = seen.where("toxic_share <> 1 or ordinary_share <> 1").groupBy(F.col("before").alias("gram")).agg(F.first(F.log(F.col("toxic_share") / F.col("ordinary_share"))).alias("llr"))
    return own.unionByName(rest)


def evidence_of(total: int, letters: int) -> float:
    """The evidence of a word of so many letters whose entries add up to ``total``: for each letter and edge."""
    return float(total) / float((letters + 1) * UNITS)


class Evidence:
    """The evidence of words, and of documents by their strongest word."""

    def __init__(self, entries: dict[str, int], order: int = ORDER) -> None:
        self.entries, self.order = entries, order
        # letters before which nothing is known end a look, so those of each entry must be known
        for g in [g for g in entries if len(g) == order and g[:-1] not in entries]:
            entries[g[:-1]] = 0
        # words that were looked at, and the evidence of those that speak for the toxic class
        self.seen: set[str] = set()
        self.strong: dict[str, float] = {}

    def word(self, word: str) -> float:
        """The difference of both log-likelihoods for each letter and edge."""
        get, k, total = self.entries.get, self.order - 1, 0
        padded = EDGE * k + word + EDGE
        for i in range(len(word) + 1):
            back = get(padded[i : i + k])
            if back is not None:
                total += get(padded[i : i + k + 1], back)
        found = evidence_of(total, len(word))
        if len(word) <= REMEMBERED_CHARS:
            if len(self.seen) >= REMEMBERED:
                self.seen.clear()
                self.strong.clear()
            self.seen.add(word)
            if found > 0:
                self.strong[word] = found
        return found

    def document(self, text: str | None) -> float:
        """0 at least: a text without words, or with no toxic word, says nothing."""
        own = words_of(text)
        strongest = max(map(self.strong.__getitem__, self.strong.keys() & own), default=0.0)
        return max(strongest, max(map(self.word, own - self.seen), default=0.0))


def evidence_in_tasks(docs: DataFrame, entries: DataFrame, kind: str) -> DataFrame:
    """``(doc_id, evidence)`` of every row of ``docs(doc_id, text)``, with the entries (few) in each task."""
    shared = docs.sparkSession.sparkContext.broadcast({r["gram"]: r["units"] for r in entries.collect()})

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = Evidence(shared.value)
        for batch in batches:
            values = pa.array([evidence.document(t.as_py()) for t in batch.column(1)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), values], ["doc_id", "evidence"])

    return written(docs.select("doc_id", "text").mapInArrow(found, f"doc_id {kind}, evidence double"), "evidence")


def evidence_by_tables(docs: DataFrame, entries: DataFrame, kind: str, order: int = ORDER) -> DataFrame:
    """What :func:`evidence_in_tasks` gives, of entries that may be as many as they like: each different
    word of the corpus meets its entries once, then documents their words."""

    def spoken_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, HANDED_DOCS):
                part = batch.slice(at, HANDED_DOCS)
                own = pa.array([list(words_of(t.as_py())) for t in part.column(1)], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([part.column(0), own], ["doc_id", "words"])

    def word_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, letters, of = [], [], []
        handed = lambda: pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int64()), "letters": pa.array(letters, pa.int64()), "gram": pa.array(of, pa.string())})
        for batch in batches:
            for i, w in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                word = w.as_py()
                own = grams(word, order)
                at += [i] * len(own)
                letters += [len(word)] * len(own)
                of += own
                if len(of) > HANDED_GRAMS:
                    yield handed()
                    at, letters, of = [], [], []
        yield handed()

    spoken = written(docs.select("doc_id", "text").mapInArrow(spoken_words, f"doc_id {kind}, words array<string>").withColumn("row", F.monotonically_increasing_id()), "spoken")
    words = written(spoken.select(F.explode("words").alias("word")).distinct().withColumn("at", F.monotonically_increasing_id()), "words")
    parts = words.select("at", "word").mapInArrow(word_grams, "at long, letters long, gram string").withColumn("before", F.expr(f"substring(gram, 1, {order - 1})"))
    back = entries.select(F.col("gram").alias("before"), F.col("units").alias("back"))
    met = parts.join(entries, "gram", "left").join(back, "before", "left")
    totals = met.groupBy("at").agg(F.sum(F.coalesce("units", "back", F.lit(0))).alias("total"), F.first("letters").alias("letters"))
    value = F.col("total").cast("double") / ((F.col("letters") + 1) * F.lit(UNITS)).cast("double")
    strong = words.join(totals.where("total > 0"), "at").select("word", value.alias("evidence"))
    best = spoken.select("row", F.explode("words").alias("word")).join(strong, "word").groupBy("row").agg(F.max("evidence").alias("evidence"))
    out = written(spoken.select("row", "doc_id").join(best, "row", "left").select("doc_id", F.coalesce("evidence", F.lit(0.0)).alias("evidence")), "evidence")
    discard(spoken, words)
    return out


def fitted_curve(steps: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Slope and middle of the logistic curve for (evidence, toxic documents, ordinary documents)
    of each step. One pretended document of either class at each end keeps the slope finite where
    the classes don't overlap; without both classes every score is below one half."""
    if not sum(t for _, t, _ in steps) or not sum(o for _, _, o in steps):
        return 0.0, 0.0
    x, t, o = (np.array(v, float) for v in zip(*steps, strict=True))
    x, t, o = np.append(x, [x.min(), x.max()]), np.append(t, [1, 1]), np.append(o, [1, 1])
    middle, spread = x.mean(), x.std() + 1e-9
    z, w = (x - middle) / spread, np.zeros(2)
    design = np.stack([np.ones_like(z), z], 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -500, 500)))
        grad = design.T @ (t - (t + o) * p) - 1e-3 * w
        step = np.linalg.solve((design * ((t + o) * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2), grad)
        w = w + step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    slope = max(w[1], 1e-9) / spread
    return float(slope), float(middle - w[0] / w[1] * spread) if w[1] > 1e-9 else 0.0


def train(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``(gram, units)``: the entries learned from the texts of ``docs(doc_id, text)`` and the classes
    of ``known(doc_id, class)``, in whole UNITS-th parts."""
    # labels are as many as the documents, so texts go to them by a shuffle at any size
    counts = written(class_counts(docs.join(known.hint("shuffle_hash"), "doc_id", "left")), "gram_counts")
    shared = written(shared_probabilities(counts), "shared")
    entries = written(evidence_entries(counts, shared, CLASS_DISCOUNT).select("gram", F.floor(F.col("llr") * UNITS + 0.5).cast("long").alias("units")), "entries")
    discard(counts, shared)
    return entries


def toxicity(docs: DataFrame, labels: DataFrame, most_entries: int = MOST_ENTRIES) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs(doc_id, text, …)``.

    Labels, ``labels(doc_id, toxic, …)``, are only learned from rows that are not held out, from all
    of those; a score looks at the whole text and nothing else. ``most_entries`` decides where the
    entries stand while documents are read, and nothing of the result.

    Null and empty texts, and texts without a letter, have no evidence and the score of that. Where
    nothing was learned (an empty table, no label, one class only) all scores are 0. Repeated rows
    are scored alike; a null doc_id is not held out and has no label; a document that one label
    calls toxic and another doesn't is toxic; other columns are ignored.
    """
    plain, kind = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text")), dict(docs.dtypes)["doc_id"]
    known = written(learned_labels(labels), "known")
    entries = train(plain, known)
    found = (evidence_in_tasks if entries.count() <= most_entries else evidence_by_tables)(plain, entries, kind)
    steps = found.join(known, "doc_id").groupBy(F.floor(F.col("evidence") * STEPS).alias("step")).agg(F.sum("class").alias("t"), F.sum(1 - F.col("class")).alias("o")).collect()
    slope, middle = fitted_curve([((r["step"] + 0.5) / STEPS, r["t"], r["o"]) for r in sorted(steps, key=lambda r: r["step"])])
    discard(known, entries)
    score = F.lit(0.0) if not slope else 1 / (1 + F.exp(F.least(F.lit(500.0), -slope * (F.col("evidence") - middle))))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
