"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has 64 bits. To find every pair within ``radius`` differing bits, bit i is given a
code m(i), a nonzero vector of radius + 1 bits, and table v (every nonzero vector of that length)
keeps the bits with an odd <m(i), v>. Up to ``radius`` differing bits have at most ``radius``
codes, so some v is orthogonal to all of them: in that table the two agree on every kept bit.
Radius 3 takes 15 tables of about 32 bits, and no pair is ever missed.

Where near copies are meant by the likeness of their word shingles (:func:`near_dedup`), the same
tables retrieve, bands of MinHash values add the pairs whose fingerprints are farther apart (at a
likeness of 0.8 about ten bits), and the exact likeness decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scarmap.llm.near_copies import SIMILAR, band_keys, shingle_set
from scarmap.llm.similar_sets import BLOCK, BLOCK_ELEMENTS, crowds, similar_components
from scarmap.llm.tables import first_rows, row_keys
from scarmap.operators.components import connected_components
from scarmap.shared import discard, written

BITS = 64
#: Buckets of up to so many different fingerprints are joined with themselves; larger ones are
#: linked through neighbourhood keys, which takes no pairs.
PAIR_BUCKET = 128
#: Texts whose sets are made at a time.
TEXTS_AT_ONCE = 512
#: Shingles whose bits are counted at a time, so that a very long text takes bounded memory.
COUNT_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    """The unsigned fingerprint of one text; 0 for no words. bytes.lower() and bytes.split() are
    ASCII only: A-Z, and white space x20 and x09-x0D."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[:n].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    h64 = xxhash.xxh64_intdigest
    counts, block = np.zeros(BITS, np.int64), []
    for a, b in spans:
        block.append(h64(joined[a:b], 42))
        if len(block) == COUNT_AT_ONCE:
            counts += _bit_counts(block)
            block = []
    if block:
        counts += _bit_counts(block)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def _bit_counts(hashes: list[int]) -> np.ndarray:
    octets = np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text") -> Column:
    """Column of the signed 64-bit fingerprint of ``text``."""

    @F.pandas_udf("long")
    def of_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
            yield pd.Series(values.view(np.int64))

    return of_texts(docs[text])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def covering_masks(radius: int) -> list[int]:
    """One mask for each table, as signed 64-bit integers."""
    codes = (1 << (radius + 1)) - 1
    return [_signed(sum(1 << i for i in range(BITS) if ((i % codes + 1) & v).bit_count() & 1)) for v in range(1, codes + 1)]


def _near_masks(most: int) -> list[int]:
    """All bit patterns of up to ``most`` set bits."""
    out = [0]
    level = [(0, 0)]
    for _ in range(most):
        level = [(p | 1 << i, i + 1) for p, start in level for i in range(start, BITS)]
        out += [_signed(p) for p, _ in level]
    return out


def fingerprint_links(distinct: DataFrame, radius: int = 3, pair_bucket: int = PAIR_BUCKET) -> DataFrame:
    """Links ``(src, dst)`` whose connected components are those of all pairs within ``radius`` bits.

    ``distinct`` has one row for each fingerprint ``fp``. In a table's bucket of up to
    ``pair_bucket`` fingerprints each is compared with its fellows. Fingerprints of a larger bucket
    are linked without pairs: two within ``radius`` meet at a point that is within radius // 2 bits
    of one and within the rest of the other, so each sends itself to all points that near, and
    where a point has a close member (all close ones are within the radius of all the others
    there), everyone at it is linked to the smallest close one. That is linear in the bucket.
    """
    masks = F.array(*[F.lit(m).cast("long") for m in covering_masks(radius)])
    keyed = distinct.select("fp", F.posexplode(masks).alias("v", "mask")).select("fp", F.xxhash64("v", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"))
    buckets = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = written(keyed.join(buckets, "key"), "buckets")
    small = members.where(F.col("n") <= pair_bucket).select("key", "fp")
    pairs = (
        small.join(small.withColumnRenamed("fp", "other"), "key")
        .where("fp < other")
        .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= radius)
        .select(F.col("fp").alias("src"), F.col("other").alias("dst"))
    )
    crowded = members.where(F.col("n") > pair_bucket).select("fp").distinct()
    close, far = radius // 2, radius - radius // 2
    offsets = F.split(F.lit(",".join(map(str, _near_masks(far)))), ",").cast("array<long>")  # one literal, folded once
    points = crowded.select("fp", F.explode(offsets).alias("off")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("off")).alias("point"), (F.bit_count("off") <= close).alias("close")
    )
    centres = points.groupBy("point").agg(F.min(F.when(F.col("close"), F.col("fp"))).alias("centre")).where("centre is not null")
    stars = points.join(centres, "point").where("fp <> centre").select(F.col("fp").alias("src"), F.col("centre").alias("dst"))
    return pairs.unionByName(stars)


def _placed(marked: DataFrame, radius: int, pair_bucket: int) -> DataFrame:
    """``(fp, least, component)`` of each fingerprint of ``marked(doc_id, fp, …)``."""
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    links = connected_components(fingerprint_links(nodes.select("fp"), radius, pair_bucket))
    return written(nodes.join(links, nodes["fp"] == links["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component")), "components")


def simhash_components(docs: DataFrame, shingle: int = 3, radius: int = 3, pair_bucket: int = PAIR_BUCKET) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs(doc_id, text, …)``.

    component_id is the smallest doc_id that can be reached over links of ``radius`` or fewer
    differing bits, the row's own included. Rows of equal fingerprint are one node, so copies are
    never expanded into pairs. Only narrow columns are shuffled; the texts are read once.

    Null and empty texts, and texts without words, have fingerprint 0 and are linked like any
    other. A text of fewer words than a shingle is one shingle. Repeated rows stay; a null doc_id
    keeps its row and is never a component_id unless its component has no other. An empty table
    gives no rows; other columns are ignored.
    """
    marked = written(docs.select("doc_id", fingerprints(docs, shingle).alias("fp")), "fingerprints")
    placed = _placed(marked, radius, pair_bucket)
    named = placed.join(placed.groupBy("component").agg(F.min("least").alias("component_id")), "component")
    return marked.join(named.select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def simhash_dedup(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row, the first by doc_id (nulls last) and then hashes of text and row, of each component
    of ``docs(doc_id, text, …)``, all columns. Rows of one doc_id, or of none, whose texts are in
    different components all stay."""
    keyed = row_keys(docs)
    marked = written(keyed.select("doc_id", "t", "r", fingerprints(keyed, shingle, "row.text").alias("fp")), "fingerprints")
    placed = _placed(marked, radius, PAIR_BUCKET).select("fp", "component")
    return first_rows(docs, marked.join(placed, "fp"))


def _table_keys(fp: int, masks: np.ndarray) -> np.ndarray:
    """The bucket of a fingerprint in each covering table."""
    kept = (np.uint64(fp) & masks) + np.arange(len(masks), dtype=np.uint64)
    kept = (kept ^ (kept >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return (kept ^ (kept >> np.uint64(32)) ^ np.arange(1, len(masks) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def set_fingerprint(hashes: np.ndarray) -> int:
    """The fingerprint of a set of shingle hashes; 0 for none."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), COUNT_AT_ONCE):
        counts += _bit_counts(hashes[at : at + COUNT_AT_ONCE])
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def in_parts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The batches in parts of TEXTS_AT_ONCE, so that few results are held."""
    for texts in batches:
        for lo in range(0, max(1, len(texts)), TEXTS_AT_ONCE):
            yield texts.iloc[lo : lo + TEXTS_AT_ONCE]


def _signed_sets(text: str, radius: int) -> Column:
    masks = np.array(covering_masks(radius), np.int64).view(np.uint64)

    @F.pandas_udf("node long, size int, keys array<long>")
    def of_texts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in in_parts(batches):
            nodes, sizes, keys = [], [], []
            for t in texts:
                hashes = shingle_set(t)
                nodes.append(xxhash.xxh64_intdigest(hashes.tobytes()) - (1 << 63))
                sizes.append(len(hashes))
                keys.append(np.concatenate([_table_keys(set_fingerprint(hashes), masks), band_keys(hashes)]) if len(hashes) else np.zeros(0, np.int64))
            yield pd.DataFrame({"node": np.array(nodes, np.int64), "size": np.array(sizes, np.int32), "keys": pd.Series(keys, dtype=object)})

    return of_texts(F.col(text))


def _set_of(text: str) -> Column:
    @F.pandas_udf("array<long>")
    def of_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in in_parts(batches):
            yield pd.Series([shingle_set(t).view(np.int64) for t in texts], dtype=object)

    return of_texts(F.col(text))


def _arrays(loads: list) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, loads), np.int64, len(loads))
    return np.concatenate([np.zeros(0, np.int64), *loads]).astype(np.int64, copy=False).view(np.uint64), lengths


def near_components(docs: DataFrame, similar: float = SIMILAR, radius: int = 3, block: int = BLOCK, elements: int = BLOCK_ELEMENTS) -> DataFrame:
    """``(doc_id, t, r, component)`` for every row of ``docs(doc_id, text, …)``; components are
    those of the pairs whose sets of five-word shingles have a Jaccard likeness of ``similar`` or
    more. Texts of equal sets are one node; texts without words are one component.

    Nodes meet in a covering table of their fingerprints or in a band; all that meet are settled
    exactly, however large a bucket is.
    """
    marked = written(row_keys(docs).select("doc_id", "t", "r", _signed_sets("row.text", radius).alias("s")), "signed")
    nodes = marked.groupBy(F.col("s.node").alias("id")).agg(F.min("t").alias("t"), F.first("s.size").alias("size"), F.first("s.keys").alias("keys"))
    members = crowds(nodes.select("id", "size", "keys"))
    wanted = nodes.select("id", "t").join(members.select("id").distinct(), "id", "left_semi")
    texts = docs.select(F.xxhash64("text").alias("t"), "text").join(wanted, "t").groupBy("id").agg(F.min("text").alias("text"))
    sets = written(texts.select("id", _set_of("text").alias("load")), "sets")
    joined = similar_components(members, sets, _arrays, similar, block, elements)
    discard(members, sets)
    flat = marked.select("doc_id", "t", "r", F.col("s.node").alias("id"))
    return flat.join(joined, flat["id"] == joined["node"], "left").select("doc_id", "t", "r", F.coalesce("component", "id").alias("component"))


def near_dedup(docs: DataFrame, similar: float = SIMILAR, radius: int = 3) -> DataFrame:
    """One row, the first by doc_id (nulls last) and then hashes of text and row, of each component
    of :func:`near_components`, all columns. Rows of one doc_id whose texts are no near copies all
    stay, as do rows of a null doc_id. An empty table gives no rows."""
    return first_rows(docs, near_components(docs, similar, radius))
