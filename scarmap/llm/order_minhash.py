"""Document fingerprints by Order MinHash, with expressions only.

A text is read as letters: its words, where a longer word (a line without white space, a script that
doesn't part words) gives one letter for each ``PIECE`` characters in a row, so one letter more for each
character more. That is said of each word alone: a text has the letters of its parts whatever stands beside
them, and no text is read in another alphabet than the others. A
k-mer that occurs again gets the number of its occurrence, so a text is a set of numbered k-mers. Each
entry of a signature has a hash order of its own, and selects the two numbered k-mers that come
first in it. They are put back into the order in which they stand in the text, and hashed as a tuple.
Two texts agree in an entry where they share those k-mers *and* their order, which is what makes the
likeness follow edit distance. A text of two numbered k-mers or more has an ordered tuple in each entry.

All k-mers are hashed in all orders, as rows. Those up to a limit, about ``LOOKED`` an entry, go on to be
compared; a text of which some entry doesn't have two up to the limit is done again without a limit, so
the limit decides nothing of the result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scarmap.llm.tables import column
from scarmap.shared import written

#: Letters in a k-mer; entries, each a tuple of two k-mers.
KMER, ENTRIES = 2, 32
#: Characters of a letter at most.
PIECE = 12
#: Low bits that hold a k-mer's place in the text; the others hold its hash.
PLACE_BITS = 28
_PLACE, _HASH = (1 << PLACE_BITS) - 1, (1 << (64 - PLACE_BITS)) - 1
#: K-mers an entry, about, that are compared with each other; with fewer than two a text is done again.
LOOKED = 12
_LAST = (1 << 63) - 1


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _numbered(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``texts`` as ``(*keys, x)``: the numbered k-mers of column ``text``, each a long with its place above
    its hash. Linear in the text but for a sort of plain longs."""
    given = F.coalesce(F.col(text), F.lit(""))
    step = texts.select(*keys, F.array_remove(F.split(given, r"[\x20\x09-\x0D]+"), "").alias("_w"))

    def pieces(word: Column) -> Column:
        # the characters stand in an array of their own, to be split once a word and not once a piece
        of = lambda ch: F.transform(F.sequence(F.lit(0), F.size(ch) - PIECE), lambda i: F.xxhash64(*[F.get(ch, i + j) for j in range(PIECE)]))
        return _bound(F.filter(F.split(word, ""), lambda c: c != ""), of)

    parted = F.flatten(F.transform("_w", lambda w: F.when(F.length(w) > PIECE, pieces(w)).otherwise(F.array(F.xxhash64(w)))))
    letters = F.when(F.exists("_w", lambda w: F.length(w) > PIECE), parted).otherwise(F.transform("_w", lambda w: F.xxhash64(w)))
    step = step.select(*keys, letters.alias("_w"))
    grams = F.transform(
        F.slice("_w", 1, F.size("_w") - (KMER - 1)),
        lambda x, i: F.shiftleft(F.xxhash64(x, *[F.get("_w", i + j) for j in range(1, KMER)]), PLACE_BITS).bitwiseOR(i.cast("long")),
    )
    single = F.transform("_w", lambda x: F.shiftleft(x, PLACE_BITS))
    step = step.select(*keys, F.sort_array(F.when(F.size("_w") >= KMER, grams).otherwise(single)).alias("_s"))

    def occurrence(x: Column, i: Column) -> Column:
        """How many of the same k-mer stand before place i of the sorted ones: the longest way back, by halves."""
        alike = lambda back: F.shiftright(F.get("_s", i - back), PLACE_BITS) == F.shiftright(x, PLACE_BITS)
        steps = F.transform(F.sequence(F.floor(F.log2(F.size("_s"))).cast("int"), F.lit(0), F.lit(-1)), lambda b: F.pow(F.lit(2), b).cast("int"))
        far = F.aggregate(steps, F.lit(0), lambda n, step: F.when(alike(n + step), n + step).otherwise(n))
        return F.when(alike(F.lit(1)), F.when(alike(F.lit(2)), far).otherwise(1)).otherwise(0)

    place = lambda x: F.shiftleft(x.bitwiseAND(F.lit(_PLACE)), 64 - PLACE_BITS)
    return step.select(
        *keys,
        F.transform("_s", lambda x, i: place(x).bitwiseOR(F.shiftrightunsigned(F.xxhash64(F.shiftright(x, PLACE_BITS), occurrence(x, i)), PLACE_BITS))).alias("x"),
    )


def signatures(texts: DataFrame, keys: list[str], text: str, looked: int | None = LOOKED) -> DataFrame:
    """``(*keys, signature, whole)`` of the texts in ``texts(*keys, text)`` that hold a word. Rows of equal
    keys have equal texts. With ``looked`` None everything is compared and all are ``whole``; else a
    signature that isn't is to be made again so."""
    n = F.size("x")
    share = F.lit(float(looked or 0)) / n
    limit = F.lit(_LAST) if looked is None else F.when(n <= looked, F.lit(_LAST)).otherwise((share * 2.0**64 - 2.0**63).cast("long"))
    step = _numbered(texts, keys, text).select(*keys, "x", limit.alias("limit"))
    # the generator reads x and the limit, so they are worked out before it and not once an entry; the
    # outer form of the next one is not taken for a filter, which would work them out twice
    entries = F.when((n > 0) & F.col("limit").isNotNull(), F.array(*[F.lit(j) for j in range(ENTRIES)]))
    step = step.select(*keys, "x", "limit", F.explode(entries).alias("j")).select(*keys, "limit", "j", F.posexplode_outer("x").alias("at", "x"))
    step = step.withColumn("h", F.xxhash64(F.col("x").bitwiseAND(F.lit(_HASH)), "j")).where((F.col("h") <= F.col("limit")) | (F.col("at") == 0))
    step = step.groupBy(*keys, "j").agg(F.collect_list(F.struct("h", "x")).alias("of"), F.max("limit").alias("limit"))
    step = step.select(*keys, "j", "limit", "of", F.array_min("of").alias("m"))
    step = step.select(*keys, "j", "limit", "m", F.array_min(F.array_remove("of", F.col("m"))).alias("n"))
    m, n, before = F.col("m.h"), F.col("n.h"), F.col("m.x") < F.col("n.x")
    pair = F.when(n.isNull(), F.xxhash64(m)).when(before, F.xxhash64(m, n)).otherwise(F.xxhash64(n, m))
    whole = (F.col("limit") == _LAST) | F.coalesce(n <= F.col("limit"), F.lit(False))
    step = step.select(*keys, F.struct("j", pair.alias("v")).alias("entry"), whole.alias("whole"))
    step = step.groupBy(*keys).agg(F.sort_array(F.collect_list("entry")).alias("of"), F.bool_and("whole").alias("whole"))
    return step.select(*keys, F.col("of.v").alias("signature"), "whole")


def with_signature(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df``, in its order, with column ``name``: the signature of column ``text``, an array of ENTRIES longs.

    A text of one letter is one k-mer, and each of its entries a tuple of one; one without words has
    an empty signature. Of a text of two or three letters few k-mers outlive an edit, and seldom a tuple.
    """
    keep = [c for c in df.columns if c != name]
    numbered = written(df.select(F.struct(*[column(df, c) for c in keep]).alias("kept"), column(df, text).alias("text"), F.monotonically_increasing_id().alias("row")), "texts")
    texts = numbered.select("row", "text").repartition("row")
    found = written(signatures(texts, ["row"], "text", LOOKED), "signatures")
    again = written(signatures(texts.join(found.where(~F.col("whole")), "row", "left_semi"), ["row"], "text", None), "signatures")
    every = found.where("whole").unionByName(again)
    made = F.coalesce("signature", F.array().cast("array<long>")).alias(name)
    return numbered.join(every, "row", "left").orderBy("row").select("kept.*", made)


def likeness(a: Column, b: Column) -> Column:
    """The share of entries in which the two agree; 1 for two signatures without any, 0 for one."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda n, x: n + x)
    return F.when(F.greatest(F.size(a), F.size(b)) == 0, F.lit(1.0)).when(F.least(F.size(a), F.size(b)) == 0, F.lit(0.0)).otherwise(same / F.size(a))


def spelled(signature: Column) -> Column:
    """The signature as a string of 16 hex digits an entry."""
    return F.array_join(F.transform(signature, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def _next_documents(keys: DataFrame) -> DataFrame:
    """Each key ``(kid, th, doc_id, n)`` with the next one's, in order of doc_id (nulls first), then
    th; after the last comes the first. Keys are dealt out by ranges; what joins the ranges is one
    row for each."""
    spark = keys.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("th").asc()]
    dealt = written(keys.repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id()), "order")
    within = W.partitionBy("part").orderBy(*order)
    ahead = dealt.withColumn("ahead", F.lead(F.struct("kid", "th")).over(within))
    firsts = dealt.groupBy("part").agg(F.min_by(F.struct("kid", "th"), F.struct("doc_id", "th")).alias("first"))
    by_part = W.partitionBy(F.lit(0)).orderBy("part")
    after = firsts.select("part", F.coalesce(F.lead("first").over(by_part), F.first("first").over(by_part)).alias("after"))
    joined = ahead.join(after, "part").withColumn("next", F.coalesce("ahead", "after"))
    return written(joined.select("doc_id", "kid", "th", "n", F.col("next.kid").alias("next_kid"), F.col("next.th").alias("next_th")), "next")


def _edited(keyed: DataFrame, of: DataFrame, chain: DataFrame) -> DataFrame:
    """``(doc_id, kid, th, text, n_chars, edited)`` for each row of ``of(kid, th, text)``, which are those of
    ``keyed`` that ``chain`` is about."""
    wanted = chain.select(
        F.col("next_kid").alias("kid"), F.col("next_th").alias("th"), F.col("kid").alias("to_kid"), F.col("th").alias("to_th"), "doc_id", F.floor(F.col("n") / 4).cast("int").alias("q")
    )
    pieces = keyed.join(wanted, ["kid", "th"]).select(F.col("to_kid").alias("kid"), F.col("to_th").alias("th"), "doc_id", "q", F.expr("left(text, q)").alias("piece"))
    # all columns are asked for wherever this is used, so that one exchange serves all uses
    pieces = pieces.groupBy("kid", "th").agg(F.min("doc_id").alias("doc_id"), F.min("q").alias("q"), F.min("piece").alias("piece"))
    return of.join(pieces, ["kid", "th"]).select(
        "doc_id", "kid", "th", "text", F.length("text").cast("long").alias("n_chars"), F.expr("concat(left(text, length(text) - q), piece)").alias("edited")
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, signature, edited_signature, near_edited, near_next)`` for every
    row of ``docs(doc_id, text, …)``.

    The edited text is the text with its last floor(n_chars / 4) code points replaced by as many of
    the first code points of the next document, by doc_id; after the last comes the first. The
    texts are shuffled once, by key, and read from that for each use; what goes from a document to the
    one before it is only the piece that is needed. Texts and edited texts are signed in tasks of their own.

    Null texts are empty. Rows repeating both doc_id and text are one document in the order and
    rows of their own in the result; of one doc_id with different texts, those follow each other.
    Null doc_ids come first. A single document is its own next. No rows give no rows; other columns
    are ignored.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    kid, th = F.coalesce(docs["doc_id"], F.lit(0)).cast("long").alias("kid"), F.xxhash64(text, docs["doc_id"].isNull()).alias("th")
    chain = _next_documents(docs.select("doc_id", kid, th, F.length(text).alias("n")).distinct())
    keyed = docs.select(kid, th, text.alias("text"))  # the same columns for all joins, so that one exchange serves them
    keys, sides = ["kid", "th"], ("text", "edited")

    def signed(of: DataFrame, looked: int | None) -> list[DataFrame]:
        return [signatures(of, keys, side, looked).withColumn("side", F.lit(side)) for side in sides]

    def together(parts: list[DataFrame]) -> DataFrame:
        # keys as a struct are no partitioning that a union keeps, so no task has more than one side to hold
        parts = [p.select(F.struct(*keys).alias("key"), *[c for c in p.columns if c not in keys]) for p in parts]
        return written(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), "signatures").select("key.*", "*").drop("key")

    edited = _edited(keyed, keyed, chain)
    rows = edited.select(*keys, F.lit("row").alias("side"), "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
    found = together([rows, *signed(edited, LOOKED)])
    left = written(chain.join(found.where(~F.col("whole")).select(*keys), keys, "left_semi"), "unsettled")
    # few as a rule, and then texts are not shuffled for them
    again = together(signed(_edited(keyed, keyed.join(left.select(*keys), keys, "left_semi"), left), None))

    def of_side(side: str, name: str) -> DataFrame:
        whole = found.where((F.col("side") == side) & F.col("whole"))
        # a text of which one side alone was unsettled has been made again on both
        more = again.where(F.col("side") == side).join(whole, keys, "left_anti")
        return whole.select(*keys, F.col("signature").alias(name)).unionByName(more.select(*keys, F.col("signature").alias(name)))

    none = F.array().cast("array<long>")
    plain = of_side("text", "signature")
    following = plain.select(F.col("kid").alias("next_kid"), F.col("th").alias("next_th"), F.col("signature").alias("next_signature"))
    of_next = chain.join(following, ["next_kid", "next_th"], "left").select(*keys, F.coalesce("next_signature", none).alias("next_signature"))
    out = found.where("side = 'row'").select(*keys, "doc_id", "n_chars", "edited_sha256").join(plain, keys, "left").join(of_side("edited", "edited_signature"), keys, "left")
    out = out.withColumns({c: F.coalesce(c, none) for c in ("signature", "edited_signature")}).join(of_next, keys)
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "signature",
        "edited_signature",
        likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
    )
