"""Mixing sources to target weights: hash-random order, prefix sums, a cut at each exact budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scarmap.llm.tables import whole_row
from scarmap.operators.ranking import with_place, with_running
from scarmap.shared import written

#: Sources in order of their names weigh these, again and again.
WEIGHTS = (5, 2, 1)
#: The mix takes so many times the words there are, and no source more than so many times its own.
SHARE, MOST = 1.5, 2.0
#: Ranges of the hash key within a source; each is sorted and summed by itself, so that a source
#: of any size is spread over as many tasks.
RANGE_BITS = 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def order_key(docs: DataFrame) -> Column:
    return F.xxhash64(docs["doc_id"], docs["text"])


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sizes(source, source_size)``, one row a source, with sid, weight, cap and target.

    With sources ordered by cap / weight, those that reach their cap are the first ones; taking
    row i as the first that doesn't, the rest share what is left at the level
    (share - caps before) / (weights from i on). That level is right where it is within row i's
    own cap, and the largest such level is the answer of resharing until none is above. The driver
    sees three numbers.
    """
    listed = with_place(sizes.select("source", "source_size"), F.col("source").asc_nulls_last(), name="sid")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("sid") - 1) % len(weights) + 1).cast("int"))
    listed = listed.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    listed = with_running(listed, [F.col("cap") / F.col("weight"), F.col("sid")], {"caps": "cap", "weights": "weight"})
    words, all_weights = listed.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    left = F.lit(float(words) * share) - (F.col("caps") - F.col("cap"))
    heavier = F.lit(all_weights) - (F.col("weights") - F.col("weight"))
    listed = listed.withColumn("level", left / heavier)
    best = listed.agg(F.max(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level")))).first()[0]
    target = F.col("cap") if best is None else F.least("cap", F.lit(best) * F.col("weight"))
    return listed.select("source", "source_size", F.col("sid").cast("int").alias("sid"), "weight", target.alias("target"))


def _budgets(targets: DataFrame) -> DataFrame:
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    return targets.withColumn("epochs", epochs).withColumn("rest", (budget - epochs * F.col("source_size")).cast("long"))


def _placed(docs: DataFrame, weights: tuple[int, ...], share: float, most: float) -> tuple[DataFrame, DataFrame]:
    """The sources' budgets, and each row with the words before it in its source's random order."""
    narrow = written(docs.select("doc_id", "source", word_count(docs["text"]).alias("size"), order_key(docs).alias("key")), "sizes")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = written(_budgets(source_targets(sizes, weights, share, most)), "budgets")
    named = sources.withColumnRenamed("source", "name")
    rows = narrow.join(named, narrow["source"].eqNullSafe(named["name"])).withColumn("range", F.shiftright("key", 64 - RANGE_BITS).cast("int"))
    ranges = rows.groupBy("sid", "range").agg(F.sum("size").alias("words"))
    earlier = W.partitionBy("sid").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.select("sid", "range", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    within = W.partitionBy("sid", "range").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = rows.withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0)))
    return sources, placed.join(ranges, ["sid", "range"]).withColumn("before", F.col("offset") + F.col("within"))


def mix_words(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for every row of ``docs(doc_id, text, source, …)``.

    A source's documents stand in the order of a hash of their doc_id and text, the same in each
    run. Its budget (the target, rounded) takes whole epochs of the source, then the words from the
    beginning of the order up to the exact rest, so that at most one document of a source is taken
    in part and the words taken are exactly the budget. Prefix sums are of ranges of the hash key,
    then of rows within a range; a hot source is many ranges. The sources themselves, one row each,
    are ranked by ranges as well.

    Null texts have size 0; a null source is a source, the last one; a source without words has
    target 0. Rows repeating a doc_id are rows of their own; no rows give no rows; other columns
    are ignored.
    """
    _, placed = _placed(docs, weights, share, most)
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    taken = (F.col("epochs") * F.col("size") + part).cast("long")
    return placed.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The mix itself: rows of ``docs``, all columns, once for each time that they are taken.

    As mix_words, with the last document of a source's last epoch taken whole if half of it or
    more is within the budget, else not. A source's decision is one key (rows up to it are taken
    once more), so the texts are filtered where they are read and never shuffled.
    """
    sources, placed = _placed(docs.select("doc_id", "text", "source"), weights, share, most)
    inside = F.col("before") + F.col("size") / 2 <= F.col("rest")
    cuts = placed.groupBy("sid").agg(F.max(F.when(inside & (F.col("rest") > 0), F.col("key"))).alias("cut"))
    plan = written(sources.join(cuts, "sid").select(F.col("source").alias("_source"), "epochs", "cut"), "cuts")
    keyed = docs.select(whole_row(docs).alias("row"), docs["source"].alias("_of"), order_key(docs).alias("_key"))
    joined = keyed.join(plan, keyed["_of"].eqNullSafe(plan["_source"]))
    copies = (F.col("epochs") + F.coalesce((F.col("_key") <= F.col("cut")).cast("int"), F.lit(0))).cast("int")
    return joined.where(copies > 0).select("row", F.explode(F.array_repeat(F.lit(0), copies))).select("row.*")
