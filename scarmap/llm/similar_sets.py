"""Components of sets whose exact Jaccard likeness reaches a bound, among sets that meet in a bucket.

The buckets of a banding are cut into blocks of bounded size. In a block all pairs are settled at
once: the product of its incidence matrix with itself counts what each two sets share, and only the
components that this gives leave the task. A bucket of one block is thereby exact. Of a larger one,
every block also holds the bucket's smallest set, which mostly joins the blocks' components; what is
still apart is then settled by a prefix join: two sets can reach the bound only if they share one of
their rarest elements, and each such pair of different components is verified.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scarmap.operators.components import connected_components
from scarmap.shared import discard, written

#: Sets, and elements of sets, in a block: about so many at most, for sets are dealt by hash.
BLOCK, BLOCK_ELEMENTS = 512, 1 << 20
#: Elements hashed, and entries of an incidence matrix, that are held at a time: a worker takes about
#: a hundred bytes for each element.
HELD, MATRIX = 1 << 20, 1 << 21
#: Elements of pairs of sets that are sorted at a time.
SORTED = 1 << 18
#: Sets of one element that are joined in a task; more are dealt over several.
DEALT = 512
#: Keeps rounding from making a bound too tight.
_EPS = 1e-9

#: Blocks of up to so many sets are compared pair by pair, all pairs of many blocks in one sort.
FEW = 6

#: From what sets are made of (texts, arrays) to their elements: all 64-bit hashes in one array, in
#: the order of the sets and maybe with repeats, and how many each set has.
Hashed = Callable[[list], tuple[np.ndarray, np.ndarray]]


def crowds(keyed: DataFrame) -> DataFrame:
    """``(key, id, size, first, n, total)`` of the buckets with two ids or more, of ``keyed(id,
    size, keys)``; total is the sum of the sizes. Of buckets with the same ids one is kept."""
    dealt = keyed.select("id", "size", F.explode("keys").alias("key")).repartition("key")
    # the condition on the size keeps the columns of both readings the same, so that they share one shuffle
    shared = dealt.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.max("size").alias("most")).where("lo < hi and most >= 0").select("key")
    met = written(dealt.join(shared.hint("shuffle_hash"), "key").distinct(), "met")
    ids = F.xxhash64("id")
    buckets = met.groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("n"), F.sum("size").alias("total"), F.bit_xor(ids).alias("x"), F.sum(F.shiftright(ids, 20)).alias("s"))
    kept = buckets.groupBy("first", "n", "total", "x", "s").agg(F.min("key").alias("key")).select("key", "first", "n", "total")
    out = written(met.join(kept, "key"), "buckets")
    discard(met)
    return out


def _spans(starts: np.ndarray, lengths: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the elements of the sets ``of`` are in the flat array, and the place in ``of`` of each."""
    n = lengths[of]
    ends = np.cumsum(n)
    owner = np.repeat(np.arange(len(of)), n)
    return np.arange(int(n.sum())) + (starts[of] - (ends - n))[owner], owner


def likenesses(values: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The Jaccard likeness of the sets a[i] and b[i], by one sort for all pairs: a pair's number is
    put above an element's hash, and below it which of the two has it. Two empty sets are alike."""
    starts, out = np.cumsum(lengths) - lengths, []
    held = np.cumsum(lengths[a] + lengths[b]) // min(HELD, SORTED)
    for part in np.split(np.arange(len(a)), np.flatnonzero(np.diff(held)) + 1) if len(a) else []:
        bits = np.uint64(int(len(part)).bit_length() + 1)
        keys = []
        for side, of in enumerate((a[part], b[part])):
            at, owner = _spans(starts, lengths, of)
            keys.append((owner.astype(np.uint64) << (np.uint64(64) - bits)) | (values[at] >> bits) & ~np.uint64(1) | np.uint64(side))
        k = np.sort(np.concatenate(keys))
        k = k[np.r_[True, k[1:] != k[:-1]]] if len(k) else k
        pair = (k >> (np.uint64(64) - bits)).astype(np.int64)
        each = np.bincount(pair, minlength=len(part))
        both = np.bincount(pair[1:][(k[1:] ^ k[:-1]) == 1], minlength=len(part))
        out.append(np.where(each > 0, both / np.maximum(each - both, 1), 1.0))
    return np.concatenate(out) if out else np.zeros(0)


def shared_counts(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How many elements each two of the sets have in common, as a matrix."""
    n = len(lengths)
    bits = np.uint64(n.bit_length())
    k = np.sort((values >> bits << bits) | np.repeat(np.arange(n, dtype=np.uint64), lengths))
    rows = (k & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    k >>= bits
    of = np.cumsum(np.r_[False, k[1:] != k[:-1]]) if len(k) else np.zeros(0, np.int64)
    out, width = np.zeros((n, n)), max(1, MATRIX // max(1, n))
    for lo in range(0, int(of[-1]) + 1 if len(of) else 0, width):
        part = slice(*np.searchsorted(of, [lo, lo + width]))
        a = np.zeros((n, min(width, int(of[-1]) + 1 - lo)), np.float32)
        a[rows[part], of[part] - lo] = 1
        out += a @ a.T
    return out


def block_components(values: np.ndarray, lengths: np.ndarray, similar: float) -> np.ndarray:
    """The component of each set, as the index of its first one, over pairs that reach the bound.
    Empty sets are like each other."""
    both = shared_counts(values, lengths)
    n = both.diagonal()
    linked = both >= similar * (n[:, None] + n[None, :] - both) - _EPS
    label = np.arange(len(lengths))
    while True:
        after = np.where(linked, label[None, :], len(lengths)).min(axis=1)
        after = np.minimum(after, after[after])
        if np.array_equal(after, label):
            return label
        label = after


def _linker(hashed: Hashed, similar: float):
    """For mapInPandas over rows ``(key, block, id, size, load)`` sorted by key, block and id."""

    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        ids = rows["id"].to_numpy()
        known, at, of = np.unique(ids, return_index=True, return_inverse=True)
        values, lengths = hashed(rows["load"].to_numpy()[at].tolist())
        starts = np.cumsum(lengths) - lengths
        key, block = rows["key"].to_numpy(), rows["block"].to_numpy()
        bounds = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (block[1:] != block[:-1])])
        counts = np.diff(np.r_[bounds, len(rows)])
        a, b = [], []
        for n in range(2, FEW + 1):
            first = bounds[counts == n]
            for i in range(n):
                for j in range(i):
                    a.append(of[first + i])
                    b.append(of[first + j])
        a, b = np.concatenate(a), np.concatenate(b)
        alike = likenesses(values, lengths, a, b) >= similar - _EPS
        src, dst = [known[a[alike]]], [known[b[alike]]]
        for first, n in zip(bounds[counts > FEW].tolist(), counts[counts > FEW].tolist(), strict=True):
            own = of[first : first + n]
            label = block_components(values[_spans(starts, lengths, own)[0]], lengths[own], similar)
            joined = np.flatnonzero(label != np.arange(n))
            src.append(known[own[joined]])
            dst.append(known[own[label[joined]]])
        return pd.DataFrame({"src": np.concatenate(src), "dst": np.concatenate(dst)})

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        elements = 0
        for batch in batches:
            while len(batch):
                # whole blocks up to HELD elements; the last block of a batch may go on in the next
                size = batch["size"].to_numpy().cumsum()
                take = max(1, int(np.searchsorted(size, HELD - elements, "right")))
                part, batch = batch.iloc[:take], batch.iloc[take:]
                held.append(part)
                elements += int(part["size"].sum())
                if elements >= HELD or len(batch):
                    rows = pd.concat(held, ignore_index=True)
                    same = (rows["key"].to_numpy() == rows["key"].iloc[-1]) & (rows["block"].to_numpy() == rows["block"].iloc[-1])
                    first = int(np.argmax(same))
                    if first:
                        yield settle(rows.iloc[:first])
                    held = [rows.iloc[first:]]
                    elements = int(held[0]["size"].sum())
        if held:
            yield settle(pd.concat(held, ignore_index=True))

    return links


def block_links(members: DataFrame, loads: DataFrame, hashed: Hashed, similar: float, block: int, elements: int) -> DataFrame:
    """Links ``(src, dst)``, as many as it takes, of the components of each block of ``members``
    of :func:`crowds`, with ``loads(id, load)``."""
    deals = F.greatest(F.lit(1), F.ceil(F.col("n") / block), F.ceil(F.col("total") / elements)).cast("int")
    dealt = members.withColumn("deals", deals)
    own = F.pmod(F.xxhash64("id"), F.col("deals")).cast("int")
    blocks = F.when(F.col("id") == F.col("first"), F.sequence(F.lit(0), F.col("deals") - 1)).otherwise(F.array(own))
    placed = dealt.select("key", "id", "size", F.explode(blocks).alias("block"))
    rows = placed.join(loads, "id").select("key", "block", "id", "size", "load").repartition("key", "block").sortWithinPartitions("key", "block", "id")
    return rows.mapInPandas(_linker(hashed, similar), "src long, dst long")


def prefix_pairs(sets: DataFrame, similar: float) -> DataFrame:
    """Pairs ``(src, dst)`` of ``sets(id, component, grams)`` of different components, among them
    all whose likeness is ``similar`` or more. The grams of a set differ from each other.

    A set of n shares at least similar * n elements with such a partner, so one of its
    n - similar * n + 1 rarest ones. Pairs whose sizes, or whose elements from a shared one on, are
    too few are left out.
    """
    sized = sets.select("id", "component", F.size("grams").alias("n"), "grams")
    each = sized.select("id", "component", "n", F.explode("grams").alias("gram"))
    often = each.groupBy("gram").agg(F.count("*").alias("often"))
    ranked = each.join(often, "gram").groupBy("id", "component", "n").agg(F.sort_array(F.collect_list(F.struct("often", "gram"))).alias("g"))
    length = (F.col("n") - F.ceil(F.col("n") * similar - _EPS) + 1).cast("int")
    firsts = ranked.select("id", "component", "n", F.posexplode(F.slice("g", F.lit(1), length)).alias("at", "e"))
    postings = written(firsts.where("e.often > 1").select("e.gram", "id", "component", "n", "at"), "postings")
    mixed = postings.groupBy("gram").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("m")).where("lo < hi")
    open_ = postings.join(mixed.select("gram", (F.col("m") / DEALT + 1).cast("int").alias("deals")), "gram")
    a = open_.select("gram", F.pmod(F.xxhash64("id"), F.col("deals")).cast("int").alias("deal"), *[F.col(c).alias(f"a_{c}") for c in ("id", "component", "n", "at")])
    b = open_.select("gram", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)).alias("deal"), *[F.col(c).alias(f"b_{c}") for c in ("id", "component", "n", "at")])
    fits = F.least("a_n", "b_n") >= F.greatest("a_n", "b_n") * similar - _EPS
    rest = F.least(F.col("a_n") - F.col("a_at"), F.col("b_n") - F.col("b_at"))
    enough = rest >= (F.col("a_n") + F.col("b_n")) * (similar / (1 + similar)) - _EPS
    pairs = a.join(b, ["gram", "deal"]).where((F.col("a_id") > F.col("b_id")) & (F.col("a_component") != F.col("b_component")) & fits & enough)
    return pairs.select(F.col("a_id").alias("src"), F.col("b_id").alias("dst")).distinct()


def _verified(pairs: DataFrame, loads: DataFrame, hashed: Hashed, similar: float) -> DataFrame:
    """The pairs ``(src, dst)`` whose exact Jaccard likeness is ``similar`` or more."""

    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        out = [np.zeros(0, bool)]
        for lo in range(0, len(a), 256):
            n = len(a.iloc[lo : lo + 256])
            values, lengths = hashed([*a.iloc[lo : lo + 256], *b.iloc[lo : lo + 256]])
            out.append(likenesses(values, lengths, np.arange(n), np.arange(n) + n) >= similar - _EPS)
        return pd.Series(np.concatenate(out))

    a, b = loads.select(F.col("id").alias("src"), F.col("load").alias("a")), loads.select(F.col("id").alias("dst"), F.col("load").alias("b"))
    return pairs.join(a, "src").join(b, "dst").where(alike("a", "b")).select("src", "dst")


def similar_components(members: DataFrame, loads: DataFrame, hashed: Hashed, similar: float, block: int = BLOCK, elements: int = BLOCK_ELEMENTS) -> DataFrame:
    """``(node, component)`` of the ids linked to another: the components of all pairs of
    likeness ``similar`` or more that meet in a bucket of :func:`crowds`, as a table of
    :func:`written`.

    ``loads(id, load)`` has what the sets are made of, once for each id, and ``hashed`` makes them.
    """
    joined = written(connected_components(block_links(members, loads, hashed, similar, block, elements)), "joined")
    large = members.where((F.col("n") > block) | (F.col("total") > elements))
    placed = large.join(joined, large["id"] == joined["node"], "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    apart = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    open_ = written(placed.join(apart.select("key").hint("shuffle_hash"), "key").select("id", "component").distinct(), "apart")
    if open_.isEmpty():
        discard(open_)
        return joined

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), 64):
                part = batch.iloc[lo : lo + 64]
                values, lengths = hashed(part["load"].tolist())
                each = [np.unique(x).view(np.int64) for x in np.split(values, np.cumsum(lengths)[:-1])]
                yield pd.DataFrame({"id": part["id"], "component": part["component"], "grams": pd.Series(each, index=part.index, dtype=object)})

    sets = open_.join(loads, "id").mapInPandas(grams, "id long, component long, grams array<long>")
    more = _verified(prefix_pairs(sets, similar), loads, hashed, similar)
    out = written(connected_components(joined.select(F.col("node").alias("src"), F.col("component").alias("dst")).unionByName(more)), "joined")
    discard(joined, open_)
    return out
