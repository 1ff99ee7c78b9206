"""Overlaps of zones (OP-J7) by tiles: no table of pairs is exchanged or kept.

A zone is a set of words ``(id, cy, w, bits)``, the cells 64 w to 64 w + 63 of a row as bits. The
shared cells of all pairs of a block of zones and another one are a product of two matrices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scarmap.shared import discard, written

#: Side of the tiles in cells, at least and at most. Zones of up to a tile's side are compared as wholes.
LEAST_SIDE, MOST_SIDE = 8, 64
#: Bytes of the zones of ``b`` that a task holds at once; zones of either side that a group has, at most.
HELD, MOST_A, MOST_B = 1 << 26, 1 << 17, 1 << 14
#: Zones of a block, and pairs that a partition looks at, about.
BLOCK, PAIRS = 1024, 1 << 28
_TILE = ["tx", "ty", "ab", "bb"]


def words_of_cells(cells: DataFrame, key: str = "geom_id") -> DataFrame:
    """The words of zones ``(key, cx, cy)``; repeated cells count once. Rows without a key or a
    coordinate are left out."""
    at = cells.select(F.col(key).alias("id"), F.col("cy").cast("long").alias("cy"), F.col("cx").cast("long").alias("first"))
    return _words(at.withColumn("last", F.col("first")).withColumn("w", F.floor(F.col("first") / 64)))


def words_of_runs(runs: DataFrame, key: str = "geom_id") -> DataFrame:
    """The words of zones given as runs ``(key, cy, first, last)``, which may overlap and repeat."""
    ends = runs.where("first <= last").select(F.col(key).alias("id"), *[F.col(c).cast("long").alias(c) for c in ("cy", "first", "last")])
    split = ends.withColumn("w", F.explode(F.sequence(F.floor(F.col("first") / 64), F.floor(F.col("last") / 64))))
    return _words(split.withColumns({"first": F.greatest("first", F.col("w") * 64), "last": F.least("last", F.col("w") * 64 + 63)}))


def _words(parts: DataFrame) -> DataFrame:
    bits = F.expr("shiftleft(shiftrightunsigned(-1L, cast(63 - last + first as int)), cast(first - w * 64 as int))")
    there = parts.where("id is not null and cy is not null and w is not null")
    return there.groupBy("id", "cy", "w").agg(F.bit_or(bits).alias("bits"), F.min("first").alias("first"), F.max("last").alias("last"))


def _sizes(words: DataFrame) -> DataFrame:
    box = [F.min("first").alias("x0"), F.max("last").alias("x1"), F.min("cy").alias("y0"), F.max("cy").alias("y1")]
    return words.groupBy("id").agg(F.sum(F.bit_count("bits")).cast("long").alias("n"), *box)


def _small(side: int) -> Column:
    return F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) < side


def _at(c: Column | str, side: int) -> Column:
    return F.floor((F.col(c) if isinstance(c, str) else c) / side)


def _items(words: DataFrame, sizes: DataFrame, side: int, any_large: bool) -> DataFrame:
    """``(tx, ty, hx, hy, id, n, words)``: zones by the tiles that they are compared in. A small one is
    in each tile of its box, hx and hy say whether the box begins in it; of a large one each tile has
    what is in a window of two tiles a side, in which small ones that begin in the tile lie."""
    listed = F.collect_list(F.struct("cy", "w", "bits")).alias("words")
    span = lambda a, b: F.explode(F.sequence(_at(a, side), _at(b, side)))
    whole = words.join(sizes.where(_small(side)), "id").groupBy("id", "n", "x0", "x1", "y0", "y1").agg(listed)
    small = whole.withColumn("tx", span("x0", "x1")).withColumn("ty", span("y0", "y1"))
    small = small.select("tx", "ty", (F.col("tx") == _at("x0", side)).alias("hx"), (F.col("ty") == _at("y0", side)).alias("hy"), "id", "n", "words")
    if not any_large:
        return small
    cut = words.join(sizes.where(~_small(side)).select("id", "n"), "id")
    cut = cut.withColumn("tx", span(F.col("first") - side, F.col("last"))).withColumn("ty", span(F.col("cy") - side, F.col("cy")))
    no = F.lit(False)
    return small.unionByName(cut.groupBy("tx", "ty", "id", "n").agg(listed).withColumns({"hx": no, "hy": no}))


def _bits(part: pa.RecordBatch, tx: int, ty: int, side: int) -> np.ndarray:
    """A row of 0 and 1 for each zone: the cells of the tile's window that it has."""
    words = part.column("words")
    cy, w, bits = (c.to_numpy(zero_copy_only=False) for c in words.flatten().flatten())
    of = np.repeat(np.arange(len(words)), np.diff(words.offsets.to_numpy()))
    i, bit = np.nonzero(np.unpackbits(np.ascontiguousarray(bits).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    x, y, wide = w[i] * 64 + bit - tx * side, cy[i] - ty * side, 2 * side
    inside = (x >= 0) & (x < wide) & (y >= 0) & (y < wide)
    out = np.zeros((len(words), wide * wide), np.uint8)
    out[of[i[inside]], y[inside] * wide + x[inside]] = 1
    return out


def _column(part: pa.RecordBatch, name: str) -> np.ndarray:
    return part.column(name).to_numpy(zero_copy_only=False)


class _Block:
    """Zones of one side in a tile, at most BLOCK."""

    def __init__(self, part: pa.RecordBatch, side: int, bound: str | None):
        self.part = part
        self.bits = _bits(part, int(part.column("tx")[0].as_py()), int(part.column("ty")[0].as_py()), side)
        self.hx, self.hy, self.n = (_column(part, c) for c in ("hx", "hy", "n"))
        self.bound = _column(part, bound) if bound else None


def _ratios(a: _Block, b: _Block) -> np.ndarray:
    """Shared cells by the size of the smaller zone, 0 for pairs that are settled in another tile or
    out of bounds. Counts are under 2^24, so sums in single precision are exact."""
    both = a.bits.astype(np.float32) @ b.bits.T.astype(np.float32)
    here = (a.hx[:, None] | b.hx) & (a.hy[:, None] | b.hy)
    if a.bound is not None:
        here &= a.bound[:, None] <= b.bound
    return np.where(here, both / np.minimum(a.n[:, None], b.n), 0.0)


def _blocks(part: pa.RecordBatch, side: int, bound: str | None) -> Iterator[_Block]:
    for i in range(0, part.num_rows, BLOCK):
        yield _Block(part.slice(i, BLOCK), side, bound)


def _pairs(a: _Block, held: list[_Block], over: float, best: bool) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
    """``(rows of a, block of b, rows of it, ratios)`` of the pairs over ``over``; with ``best`` only the first
    of the largest ratio for each zone of ``a``."""
    if not best:
        for k, b in enumerate(held):
            r = _ratios(a, b)
            i, j = np.nonzero(r > over)
            yield i, k, j, r[i, j]
        return
    most, block, row = np.full(len(a.n), over), np.full(len(a.n), -1), np.zeros(len(a.n), np.int64)
    for k, b in enumerate(held):
        r = _ratios(a, b)
        j = r.argmax(axis=1)
        found = r[np.arange(len(j)), j]
        more = found > most
        most[more], block[more], row[more] = found[more], k, j[more]
    for k in np.unique(block[block >= 0]):
        i = np.flatnonzero(block == k)
        yield i, int(k), row[i], most[i]


def overlapping_words(a: DataFrame, b: DataFrame, over: float, a_facts: DataFrame | None = None, b_facts: DataFrame | None = None, bounds: tuple[str, str] | None = None, best: tuple[str, ...] = ()) -> DataFrame:
    """OP-J7: ``(a_id, *a_facts, b_id, *b_facts, ratio)`` of zones given as words that share more than
    ``over`` (0 or more) of the smaller one. Facts are ``(id, …)``, and take other zones out;
    ``bounds`` names a number of a and one of b, which must not be less. With ``best``, columns of b
    in whose order a's first partner of the largest ratio is wanted, a zone of a has a few rows, of
    which one is the best; otherwise every pair has one row.

    Zones that fit a tile are copied to the tiles of their box, at most four; a pair is settled in the
    tile where the boxes' common part begins, so what is exchanged doesn't grow with the number of
    pairs. A crowded tile is dealt to groups of MOST_A and MOST_B zones. A larger zone is cut by tiles
    for the ones that fit. Pairs of two larger zones are counted by a join on words and exchanged;
    tiles are such that about one zone in a hundred is larger, but have at most MOST_SIDE cells a side.
    """
    spark = a.sparkSession
    a, b = written(a, "words"), written(b, "words")
    sizes = {"a": written(_sizes(a), "sizes"), "b": written(_sizes(b), "sizes")}
    extent = sizes["a"].unionByName(sizes["b"]).select(F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")).alias("e"))
    most, usual = extent.agg(F.max("e") + 1, F.percentile_approx("e", 0.99) + 1).first()
    side = max(LEAST_SIDE, min(MOST_SIDE, usual or 0))
    any_large = most is not None and most > side
    facts = {"a": a_facts, "b": b_facts}
    own = {s: [c for c in (f.columns if f is not None else []) if c != "id"] for s, f in facts.items()}

    def told(of: DataFrame, s: str) -> DataFrame:
        out = of.join(facts[s], "id") if facts[s] is not None else of
        return out.withColumnRenamed("id", f"{s}_id")

    items = {s: written(told(_items(w, sizes[s], side, any_large), s), "items") for s, w in (("a", a), ("b", b))}
    count = lambda s: items[s].groupBy("tx", "ty").agg(F.count("*").alias(f"c_{s}"))
    tiles = written(count("a").join(count("b"), ["tx", "ty"]), "tiles")
    most_b = min(MOST_B, HELD // (4 * side * side))
    work = tiles.agg(F.sum(F.col("c_a").cast("double") * F.col("c_b"))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(10_000, int(work / PAIRS) + 1))
    columns = {s: [f"{s}_id", *own[s]] for s in "ab"}
    types = {s: dict(items[s].dtypes) for s in "ab"}

    def dealt(s: str, o: str, mine: int, theirs: int) -> DataFrame:
        n = lambda c, m: F.ceil(F.col(f"c_{c}") / m)
        met = items[s].join(tiles, ["tx", "ty"]).withColumn(f"{s}b", F.pmod(F.xxhash64(f"{s}_id"), n(s, mine)))
        met = met.withColumn(f"{o}b", F.explode(F.sequence(F.lit(0).cast("long"), n(o, theirs) - 1))).withColumn("is_a", F.lit(s == "a"))
        return met.select(*_TILE, "is_a", "hx", "hy", "n", "words", *[F.col(c) if c in columns[s] else F.lit(None).cast(types[x][c]).alias(c) for x in "ab" for c in columns[x]])

    both = dealt("a", "b", MOST_A, most_b).unionByName(dealt("b", "a", most_b, MOST_A))
    schema = ", ".join(f"`{c}` {types[s][c]}" for s in "ab" for c in columns[s]) + ", ratio double"
    a_bound, b_bound = bounds or (None, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, rows_of_b, held = None, [], None
        for batch in batches:
            keys = np.stack([_column(batch, c) for c in _TILE], 1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if lo == hi:
                    continue
                if tuple(keys[lo]) != tile:
                    tile, rows_of_b, held = tuple(keys[lo]), [], None
                part = batch.slice(lo, hi - lo)
                n_b = int((~_column(part, "is_a").astype(bool)).sum())
                if n_b:
                    rows_of_b.append(part.slice(0, n_b))
                if n_b == part.num_rows:
                    continue
                if held is None:
                    held = [k for p in rows_of_b for k in _blocks(p, side, b_bound)]
                for own_rows in _blocks(part.slice(n_b), side, a_bound):
                    for i, k, j, ratio in _pairs(own_rows, held, over, bool(best)):
                        if len(i):
                            left = [own_rows.part.column(c).take(pa.array(i)) for c in columns["a"]]
                            right = [held[k].part.column(c).take(pa.array(j)) for c in columns["b"]]
                            yield pa.RecordBatch.from_arrays([*left, *right, pa.array(ratio)], [*columns["a"], *columns["b"], "ratio"])

    out = both.repartition(tasks, *_TILE).sortWithinPartitions(*_TILE, "is_a", *best).mapInArrow(run, schema)
    if any_large:
        out = out.unionByName(_large_pairs(a, b, sizes, side, over, told, bounds).select(*out.columns))
    else:
        discard(a, b, *sizes.values())
    return out


def _large_pairs(a: DataFrame, b: DataFrame, sizes: dict[str, DataFrame], side: int, over: float, told, bounds: tuple[str, str] | None) -> DataFrame:
    """The pairs of two zones that are larger than a tile, counted word by word."""
    big = {s: sizes[s].where(~_small(side)).select("id", F.col("n").alias(f"n_{s}")) for s in "ab"}
    words = {s: w.join(big[s], "id").select(F.col("id").alias(f"{s}_id"), "cy", "w", F.col("bits").alias(f"bits_{s}")) for s, w in (("a", a), ("b", b))}
    shared = words["a"].join(words["b"], ["cy", "w"]).groupBy("a_id", "b_id").agg(F.sum(F.bit_count(F.col("bits_a").bitwiseAND(F.col("bits_b")))).alias("both"))
    out = shared.join(told(big["a"], "a"), "a_id").join(told(big["b"], "b"), "b_id").withColumn("ratio", F.col("both") / F.least("n_a", "n_b"))
    out = out.where(F.col("ratio") > over)
    return out.where(F.col(bounds[0]) <= F.col(bounds[1])) if bounds else out
