"""Connected components of an edge table (OP-U1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scarmap.shared import discard, written

#: Rounds after which something must be wrong: star contraction halves the depth each time.
MOST_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.min("dst").alias("m"))
    least = least.select("src", F.least("src", "m").alias("m"))
    joined = both.join(least, "src").where("dst > src")
    return joined.select(F.col("dst").alias("src"), F.col("m").alias("dst")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("src").agg(F.min("dst").alias("m"))
    others = edges.join(least, "src").where("dst <> m")
    return (
        others.select(F.col("dst").alias("src"), F.col("m").alias("dst"))
        .unionByName(least.select("src", F.col("m").alias("dst")))
        .distinct()
    )


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(node, component)`` for every node of an edge; the component is its smallest node.

    Alternating star contraction: each round joins the edges with one minimum per node, so no
    node's neighbours are ever gathered in a task (a node of very many neighbours is a skewed
    join, which AQE splits), and the number of rounds grows with the logarithm of the longest
    chain. Each round is written to the shared folder; the driver sees two numbers of it.

    Edges with a null end and loops say nothing and are left out; repeated and reversed edges are
    merged. No edges: no rows. Columns other than the two named are ignored.
    """
    now = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).where("src <> dst")
    now = written(now.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(), "edges")
    sign = _sign(now)
    for _ in range(MOST_ROUNDS):
        if sign[0] == 0:
            break
        after = written(_small_star(_large_star(now)), "edges")
        discard(now)
        now, before, sign = after, sign, _sign(after)
        if sign == before:
            break
    else:
        raise RuntimeError(f"no fixed point after {MOST_ROUNDS} rounds")
    stars = now.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    roots = now.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    return stars.unionByName(roots)


def _sign(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("src", "dst")), F.lit(0))).first()
    return row[0], row[1]
