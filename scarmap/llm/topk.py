"""Exact top-k search by inner product with no random access.

Candidates are cut into blocks. In a block each dimension has its list of candidates, sorted by
that component; a query reads the lists from whichever end its own component's sign favours, in
rounds of some ranks each. What has been read of a candidate gives its lower bound with the
smallest value a list can still hold, and its upper bound with the value at the list's frontier.
A query stops reading when the candidates whose upper bound reaches its k-th best lower bound are
few; no other can be among the best, and the final scores of those few are then computed exactly.

Queries are cut into blocks too. A block of candidates is sent to a task once, its lists are sorted
once, and the blocks of queries pass by it one after the other; memory is bounded by a block of each,
and only k rows for each query and candidate block are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scarmap.shared import written

#: Rows in a block, on average: vectors are dealt by a hash.
CANDIDATE_BLOCK, QUERY_BLOCK = 8192, 512
#: Ranks read of a list by the end of each round, as shares of its length.
ROUNDS = (0.12, 0.3, 0.5, 0.75, 1.0)
#: A query stops reading when no more than so many candidates for each result are left.
FEW = 24
#: Whole numbers and their products are exact in doubles up to here.
EXACT = float(1 << 53)


class Lists:
    """A block of candidates with its sorted lists, one for each dimension."""

    def __init__(self, ids: np.ndarray, values: np.ndarray) -> None:
        self.ids, self.values = ids, values
        self.x = values.astype(np.float64)
        order = np.argsort(self.x, axis=0, kind="stable")
        self.rank = np.empty(order.shape, np.int32)
        np.put_along_axis(self.rank, order, np.arange(len(ids), dtype=np.int32)[:, None], axis=0)
        self.sorted = np.take_along_axis(self.x, order, axis=0)
        self.most = float(np.abs(self.x).max(initial=0))

    def _exact_in(self, q: np.ndarray) -> type | None:
        """A type in which sums of products with these queries are exact, or None."""
        most = self.most * float(np.abs(q).max(initial=0)) * max(1, q.shape[1])
        return np.float32 if most < 1 << 24 else np.float64 if most < EXACT else None

    def best(self, q_ids: np.ndarray, queries: np.ndarray, k: int, few: int = FEW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(query row, candidate row, score)`` arrays: the k best of the block for each query,
        ties to the smaller id. Scores are clipped to 64 bits."""
        n, q = len(self.ids), queries.astype(np.float64)
        kind = self._exact_in(q)
        work = kind or np.float64
        # Where doubles may round, bounds are widened by more than they can be off.
        slack = 0.0 if kind else 4 * q.shape[1] * np.finfo(np.float64).eps * self.most * np.abs(q).sum(axis=1)
        x, ranked = self.x.astype(work), self.sorted.astype(work)
        up, down = np.maximum(q, 0).T.astype(work), np.minimum(q, 0).T.astype(work)
        own = self.ids[:, None] == q_ids[None, :]
        lower = (ranked[0] @ up + ranked[-1] @ down)[None, :].repeat(n, axis=0)  # the least that each list can hold
        going, cols, rows, depth = np.arange(len(q_ids)), [], [], 0
        for share in ROUNDS:
            before, depth = depth, max(1, min(n, int(np.ceil(share * n))))
            top = (self.rank >= n - depth) & (self.rank < n - before)
            low = (self.rank >= before) & (self.rank < depth)
            lower += ((x - ranked[0]) * top) @ up[:, going] + ((x - ranked[-1]) * low) @ down[:, going]
            if depth < n:
                above, below = (self.rank < n - depth).astype(work), (self.rank >= depth).astype(work)
                upper = lower + above @ ((ranked[n - depth] - ranked[0])[:, None] * up[:, going]) + below @ ((ranked[depth - 1] - ranked[-1])[:, None] * down[:, going])
            else:
                upper = lower
            least = np.where(own[:, going], -np.inf, lower)
            kth = np.partition(least, n - k, axis=0)[n - k] if n > k else np.full(len(going), -np.inf)
            gap = 2 * slack[going] if not kind else 0.0
            alive = (upper + gap >= kth) & ~own[:, going]
            done = alive.sum(axis=0) <= few * k if depth < n else np.ones(len(going), bool)
            at, of = np.nonzero(alive[:, done])
            rows.append(at)
            cols.append(going[done][of])
            going, lower = going[~done], lower[:, ~done]
            if not len(going):
                break
        cols, rows = np.concatenate(cols), np.concatenate(rows)
        if kind:
            scores = np.concatenate([np.einsum("ij,ij->i", self.x[rows[a : a + 65536]], q[cols[a : a + 65536]]) for a in range(0, len(rows), 65536)] or [np.zeros(0)]).astype(np.int64)
            order = np.lexsort((self.ids[rows], -scores, cols))
        else:
            whole = [int(np.dot(self.values[r].astype(object), queries[c].astype(object))) for r, c in zip(rows, cols, strict=True)]
            order = np.array(sorted(range(len(rows)), key=lambda i: (cols[i], -whole[i], self.ids[rows[i]])), np.int64)
            scores = np.array([min(max(s, -(1 << 63)), (1 << 63) - 1) for s in whole], np.int64)
        cols, rows, scores = cols[order], rows[order], scores[order]
        first = np.flatnonzero(np.r_[True, cols[1:] != cols[:-1]]) if len(cols) else np.zeros(0, np.int64)
        place = np.arange(len(cols)) - np.repeat(first, np.diff(np.r_[first, len(cols)]))
        return cols[place < k], rows[place < k], scores[place < k]


def _packed(vectors: DataFrame, block_rows: int, name: str) -> DataFrame:
    """Blocks ``(dims, block, blocks, ids, xs)`` of about ``block_rows`` vectors of one length."""
    sized = vectors.withColumn("dims", F.size("x"))
    blocks = sized.groupBy("dims").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    dealt = sized.join(blocks, "dims").withColumn("block", F.pmod(F.xxhash64("id", "x"), F.col("blocks")).cast("int"))
    rows = dealt.groupBy("dims", "block", "blocks").agg(F.sort_array(F.collect_list(F.struct("id", "x"))).alias("rows"))
    return written(rows.select("dims", "block", "blocks", F.col("rows")["id"].alias("ids"), F.col("rows")["x"].alias("xs")), name)


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5, candidate_block: int = CANDIDATE_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row of ``queries(id, x)`` the k rows of
    ``candidates(id, x)`` of another id with the highest inner product, ties to the smaller id.

    ``x`` is an array of whole numbers (bigint). A query meets the candidates of its own length; if
    they are fewer than k it gets them all, if none it has no row. Repeated rows of an id are
    candidates, and queries, of their own. Rows with a null id or x take no part, nor do those of
    an empty x. Scores beyond 64 bits rank as they are and are given as the largest (or smallest)
    number there is.
    """
    spark = candidates.sparkSession
    candidates, queries = (df.where("id is not null and x is not null and size(x) > 0").select("id", "x") for df in (candidates, queries))
    c = _packed(candidates, candidate_block, "candidates")
    q = _packed(queries, query_block, "queries")
    # With few blocks of candidates each goes to several tasks, which share the queries.
    shares = max(1, -(-2 * spark.sparkContext.defaultParallelism // max(1, c.count())))
    mine = c.select("dims", F.col("block").alias("c_block"), F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"), F.lit(-1).alias("q_block"), "ids", "xs")
    lengths = c.select("dims", "blocks").distinct().withColumnRenamed("blocks", "c_blocks")
    asked = q.join(lengths, "dims").select("dims", F.explode(F.sequence(F.lit(0), F.col("c_blocks") - 1)).alias("c_block"), F.pmod("block", F.lit(shares)).alias("share"), F.col("block").alias("q_block"), "ids", "xs")
    met = mine.unionByName(asked).repartition("dims", "c_block", "share").sortWithinPartitions("dims", "c_block", "share", "q_block")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lists = at = None
        for batch in batches:
            for r in batch.itertuples():
                ids, values = np.asarray(r.ids, np.int64), np.stack([np.asarray(v, np.int64) for v in r.xs])
                if r.q_block < 0:
                    lists, at = Lists(ids, values), (r.dims, r.c_block, r.share)
                elif at == (r.dims, r.c_block, r.share):
                    cols, rows, scores = lists.best(ids, values, k)
                    yield pd.DataFrame({"query_id": ids[cols], "q_row": cols.astype(np.int64), "vec_id": lists.ids[rows], "score": scores, "q_block": np.int64(r.q_block), "dims": np.int64(r.dims)})

    found = met.mapInPandas(search, "query_id long, q_row long, vec_id long, score long, q_block long, dims long")
    best = W.partitionBy("dims", "q_block", "q_row", "query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def scaled(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``(id, x)`` of ``vectors(vec_id, embedding, …)``: components floor(scale * component).

    Null vectors and vectors with a null or non-finite component are left out, as are empty ones,
    and those with a component that is no 64-bit number when scaled.
    """
    x = F.col("embedding").cast("array<double>")
    fits = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float((1 << 63) // scale))
    fine = F.coalesce(F.forall(x, fits), F.lit(False)) & (F.size("embedding") > 0)
    whole = F.transform(x, lambda v: F.when(fits(v), F.floor(v * F.lit(float(scale)))).cast("long"))
    return vectors.where(fine).select(F.col("vec_id").alias("id"), whole.alias("x"))
