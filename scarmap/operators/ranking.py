"""Places, running sums and medians, without one task that holds all rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scarmap.shared import discard, written

#: Values of a group whose median is taken in one buffer, at most.
MOST_BUFFERED = 1 << 20
#: Bins of a round of selection.
BINS = 4096


def with_running(df: DataFrame, order: list[Column], sums: dict[str, str], place: str | None = None) -> DataFrame:
    """``df`` with running sums in ``order``: ``sums`` names, for each new column, the column that it
    adds up, its own row included; ``place``, if given, is the row's number from 1.

    Rows are dealt by ranges of the order and added up within their range; what the ranges exchange
    is one row each. Rows that the order doesn't tell apart are taken as they come.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    given = df.columns
    dealt = written(df.repartitionByRange(ranges, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    of = {**{n: F.col(c) for n, c in sums.items()}, **({place: F.lit(1).cast("long")} if place else {})}
    totals = dealt.groupBy("_part").agg(*[F.sum(e).alias(f"_t_{n}") for n, e in of.items()])
    before = W.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("_part", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in of])
    within = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    summed = dealt.withColumns({f"_w_{n}": F.sum(e).over(within) for n, e in of.items()}).join(offsets, "_part")
    return summed.select(*given, *[(F.col(f"_b_{n}") + F.col(f"_w_{n}")).alias(n) for n in of])


def with_place(df: DataFrame, *order: Column, name: str = "place") -> DataFrame:
    """``df`` with the number, from 1, of each row in ``order``; see :func:`with_running`."""
    return with_running(df, list(order), {}, name)


def with_running_in(df: DataFrame, group: str, order: list[Column], runs: dict[str, tuple[str, Callable[..., Column]]], own: bool = True) -> DataFrame:
    """``df`` with aggregates that run on within each ``group`` in ``order``, whose first column is
    the group: ``runs`` names for each new column the column that it is of, and ``F.max``, ``F.min`` or
    ``F.sum``. With ``own`` a row counts its own value, else only those before it (null for the first).

    Rows are dealt by ranges of the order, and run on within the part of a group that a range holds.
    Only its first and last group can go on in other ranges; of these, ranges exchange a row each.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(df.repartitionByRange(ranges, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    bounds = dealt.groupBy("_part").agg(F.min(F.struct(F.col(group).alias("g"))).alias("_lo"), F.max(F.struct(F.col(group).alias("g"))).alias("_hi"))
    at_ends = dealt.join(bounds, "_part").where(F.col(group).eqNullSafe(F.col("_lo.g")) | F.col(group).eqNullSafe(F.col("_hi.g")))
    parts = at_ends.groupBy("_part", F.col(group).alias("_g")).agg(*[of(c).alias(f"_t_{n}") for n, (c, of) in runs.items()])
    before = W.partitionBy("_g").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    carried = parts.select(F.col("_part").alias("_p"), "_g", *[of(f"_t_{n}").over(before).alias(f"_b_{n}") for n, (_, of) in runs.items()])
    within = W.partitionBy("_part", group).orderBy(*order[1:]).rowsBetween(W.unboundedPreceding, 0 if own else -1)
    local = dealt.withColumns({f"_w_{n}": of(c).over(within) for n, (c, of) in runs.items()})
    met = local.join(carried, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")), "left")

    def both(n: str, of: Callable[..., Column]) -> Column:
        a, b = F.col(f"_b_{n}"), F.col(f"_w_{n}")
        joined = F.greatest(a, b) if of is F.max else F.least(a, b) if of is F.min else a + b
        return F.coalesce(joined, a, b).alias(n)

    return met.select(*df.columns, *[both(n, of) for n, (_, of) in runs.items()])


def medians(df: DataFrame, keys: list[str], value: str, most: int = MOST_BUFFERED, bins: int = BINS) -> DataFrame:
    """``(*keys, median)`` of every group of ``df``: the middle of its values, or the mean of the two
    middle ones; null for a group without values. Nulls and NaNs are no values.

    Groups of up to ``most`` values are buffered. In larger ones the middle is selected: the values
    between two bounds are counted in equal bins, the bin that holds the wanted place gives the
    next bounds, its own least and greatest value, until these are one. Bins are of magnitudes until
    the bounds are within a factor of two, so about seven rounds do, however values are spread. A
    group's rows are never gathered: a round exchanges a row for each bin and task.
    """
    v = df.select(*keys, F.col(value).cast("double").alias("v"))
    v = v.withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    sizes = written(v.groupBy(*keys).agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")), "sizes")
    large = sizes.where(F.col("n") > most)
    same = lambda a, b: _all(a[k].eqNullSafe(b[k]) for k in keys)
    if not large.limit(1).count():
        return v.groupBy(*keys).agg(F.percentile("v", 0.5).alias("median"))
    small = v.join(large.select(*keys), same(v, large), "left_anti").groupBy(*keys).agg(F.percentile("v", 0.5).alias("median"))
    held = written(v.where("v is not null").join(large.select(*keys), same(v, large), "left_semi"), "held")
    place = F.explode(F.array(F.struct(F.lit(0).alias("which"), F.floor((F.col("n") + 1) / 2).alias("place")), F.struct(F.lit(1).alias("which"), F.floor(F.col("n") / 2 + 1).alias("place"))))
    state = written(large.select(*keys, "lo", "hi", place.alias("p")).select(*keys, "lo", "hi", "p.which", "p.place"), "bounds")
    while state.where("lo < hi").limit(1).count():
        open_ = state.where("lo < hi").select(*[F.col(k).alias(f"_{k}") for k in keys], "which", "place", "lo", "hi")
        met = held.join(open_, _all(held[k].eqNullSafe(open_[f"_{k}"]) for k in keys) & held["v"].between(open_["lo"], open_["hi"]))
        narrow = ((F.col("lo") > 0) & (F.col("hi") <= F.col("lo") * 2)) | ((F.col("hi") < 0) & (F.col("lo") >= F.col("hi") * 2))
        share = lambda f: (f("v") - f("lo")) / (f("hi") - f("lo"))
        at = F.least(F.lit(bins - 1), F.floor(F.when(narrow, share(F.col)).otherwise(share(_magnitude)) * bins))
        counted = met.groupBy(*keys, "which", "place", at.alias("bin")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        upto = F.sum("n").over(W.partitionBy(*keys, "which").orderBy("bin").rowsBetween(W.unboundedPreceding, 0))
        found = counted.withColumn("upto", upto).where((F.col("upto") >= F.col("place")) & (F.col("upto") - F.col("n") < F.col("place")))
        found = found.select(*keys, "lo", "hi", "which", (F.col("place") - F.col("upto") + F.col("n")).alias("place"))
        after = written(state.where("lo = hi").unionByName(found), "bounds")
        discard(state)
        state = after
    return small.unionByName(state.groupBy(*keys).agg(F.avg("lo").alias("median")))


def _magnitude(c: str) -> Column:
    """Sign and logarithm of a number in one, in the order of the numbers: the logarithm of the
    smallest double is over -745."""
    v = F.col(c)
    return F.when(v == 0, 0.0).otherwise(F.signum(v) * (F.log(F.abs(v)) + 750))


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out
