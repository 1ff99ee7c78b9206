"""License scans: overlapping windows of a text against license templates, with expressions only.

A text is read as normalised words (lower case, letters and digits only) and five-word shingles.
Templates of more than half of size and up to size words are a class of size = 8, 16, 32, …; its
windows are 1.5 * size words long and begin at every half size, so each occurrence of a template
lies whole in a window. MinHash signatures of windows and templates are cut into BANDS bands of one
value each; a window retrieves the templates that it agrees with in a band, and exact containment
then decides.

A window that holds 0.8 or more of a template's shingles has a Jaccard likeness J of about 0.25 at
least, and no band agrees with probability (1 - J) ** BANDS, under one in 1,000; typically (J near
0.5) it is one in ten million. A band of a window can only agree with a template's if the window
holds the shingle that the template has there, its smallest in that order. So the windows without
such a shingle are passed over before anything is signed; this leaves out no agreement, and texts
without licenses cost one pass over their words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scarmap.shared import written

SHINGLE, CONTAINED, BANDS = 5, 0.8, 24
#: Templates are broadcast: so many words of them at most (several hundred whole licenses).
MOST_TEMPLATE_WORDS = 400_000


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(words: str) -> Column:
    """Hashes of the five-word shingles of an array column; one for a shorter text, none for none."""
    at = F.sequence(F.lit(0), F.size(words) - SHINGLE)
    full = F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(SHINGLE)]))
    short = F.array(F.xxhash64(F.array_join(words, " ")))
    return F.when(F.size(words) >= SHINGLE, full).when(F.size(words) > 0, short).otherwise(F.array().cast("array<long>"))


def _hash_in(order: int, shingle: Column) -> Column:
    return F.xxhash64(shingle, F.lit(order))


def _bands(shingles: Column) -> Column:
    """The smallest hash in each of BANDS hash orders."""

    def smallest(order: int) -> Column:
        return F.array_min(F.transform(shingles, lambda x: _hash_in(order, x)))

    return F.array(*[smallest(order) for order in range(BANDS)])


def template_table(templates: DataFrame) -> DataFrame:
    """``(license_id, size, shingles)`` of ``templates(license_id, text)``, with size the class's. A
    template without words is left out; rows that repeat are one; of one license_id with several
    texts each is a template."""
    listed = templates.select("license_id", "text").distinct().select("license_id", _words(F.col("text")).alias("words"))
    size = F.greatest(F.lit(8), F.pow(F.lit(2.0), F.ceil(F.log2(F.size("words")))).cast("int"))
    return listed.where(F.size("words") > 0).select("license_id", size.alias("size"), F.size("words").alias("n_words"), F.array_distinct(_shingles("words")).alias("shingles"))


def touched_windows(docs: DataFrame, by_size: dict[int, list[int]]) -> DataFrame:
    """``(doc_id, size, start, shingles)``: the windows of each class that hold a shingle of
    ``by_size``, those that a template of the class has in a band; start counts words."""
    every = sorted({x for xs in by_size.values() for x in xs})
    step = docs.select("doc_id", _words(docs["text"]).alias("w"))
    step = step.select("doc_id", _shingles("w").alias("s"))
    hits = F.filter(F.transform("s", lambda x, i: F.struct(i.alias("at"), x.alias("x"))), lambda h: h["x"].isin(every))
    step = step.select("doc_id", "s", hits.alias("hits"))

    def starts(size: int, xs: list[int]) -> Column:
        stride, shingles = size // 2, size + size // 2 - SHINGLE + 1
        own = F.filter("hits", lambda h: h["x"].isin(xs))
        first = lambda at: F.greatest(F.lit(0), F.ceil((at - (shingles - 1)) / stride).cast("int"))
        of_hit = lambda h: F.sequence(first(h["at"]), F.floor(h["at"] / stride).cast("int"))
        windows = F.array_distinct(F.flatten(F.transform(own, of_hit)))
        return F.transform(windows, lambda k: F.struct(F.lit(size).alias("size"), (k * stride).alias("start"), F.lit(shingles).alias("n")))

    windows = F.concat(*[starts(size, xs) for size, xs in sorted(by_size.items())])
    # Outer, for a condition on the arrays would be pushed below the steps that make them, and
    # there be worked out anew for each word.
    step = step.select("doc_id", "s", F.explode_outer(windows).alias("v")).where(F.col("v").isNotNull())
    return step.select("doc_id", "v.size", "v.start", F.array_distinct(F.slice("s", F.col("v.start") + 1, F.col("v.n"))).alias("shingles"))


def _band_shingles(shingles: Column) -> Column:
    """The different shingles that have the smallest hash in some order."""

    def of(order: int) -> Column:
        return F.array_min(F.transform(shingles, lambda x: F.struct(_hash_in(order, x).alias("h"), x.alias("x"))))["x"]

    return F.array_distinct(F.array(*[of(order) for order in range(BANDS)]))


def scan_licenses(docs: DataFrame, templates: DataFrame, contained: float = CONTAINED) -> DataFrame:
    """``(doc_id, license_id, containment, n_windows, first_word)``: the ``templates(license_id,
    text)`` found in each document of ``docs(doc_id, text, …)``.

    containment is the largest share of the template's shingles in one window, ``contained`` at
    least; n_windows the number of windows that have it, first_word where the first begins. Texts
    are scanned where they are read; only the windows that match are shuffled. The templates' words
    are counted before they are broadcast.

    Null and empty texts match nothing. Rows repeating a doc_id are one document, whose windows are
    told apart by where they begin; null doc_ids are another. An empty table, or no templates, give
    no rows; other columns are ignored.
    """
    known = written(template_table(templates), "templates")
    if (known.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]) > MOST_TEMPLATE_WORDS:
        raise ValueError(f"more than {MOST_TEMPLATE_WORDS} words of templates: scan for them in parts")
    by_size: dict[int, list[int]] = {}
    for row in known.select("size", _band_shingles(F.col("shingles")).alias("x")).collect():
        by_size.setdefault(row["size"], []).extend(row["x"])
    if not by_size:
        return docs.select("doc_id", F.lit("").alias("license_id"), F.lit(0.0).alias("containment"), F.lit(0).cast("long").alias("n_windows"), F.lit(0).alias("first_word")).where("false")
    banded = known.select("license_id", "size", F.col("shingles").alias("of_template"), F.posexplode(_bands(F.col("shingles"))).alias("band", "value"))
    windows = touched_windows(docs, by_size)
    signed = windows.select("doc_id", "size", "start", "shingles", F.posexplode(_bands(F.col("shingles"))).alias("band", "value"))
    shared = F.size(F.array_intersect("shingles", "of_template")) / F.size("of_template")
    found = signed.join(F.broadcast(banded), ["size", "band", "value"]).select("doc_id", "license_id", "start", shared.alias("containment"))
    found = found.where(F.col("containment") >= contained)
    # a window is found once for each band that agrees
    return found.groupBy("doc_id", "license_id").agg(
        F.max("containment").alias("containment"), F.count_distinct("start").alias("n_windows"), F.min("start").alias("first_word")
    )
