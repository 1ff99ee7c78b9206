"""Reading the driver's tables, and rows told apart by what they hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(df: DataFrame, name: str) -> Column:
    """The column of exactly this name; dots and backquotes in it are no path."""
    return df["`" + name.replace("`", "``") + "`"]


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct."""
    return F.struct(*[column(df, c) for c in df.columns])


def row_keys(docs: DataFrame) -> DataFrame:
    """``(row, doc_id, t, r)`` for each row: the whole of it, its id, and hashes of its text and of
    the whole. What the columns of ``docs`` are called doesn't matter."""
    plain = [F.to_json(column(docs, c)) if "map<" in kind else column(docs, c) for c, kind in docs.dtypes]
    return docs.select(whole_row(docs).alias("row"), docs["doc_id"].alias("doc_id"), F.xxhash64(docs["text"]).alias("t"), F.xxhash64(*plain).alias("r"))


def first_rows(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """The first row of ``docs`` of each component of ``placed(doc_id, t, r, component)``, by
    doc_id (nulls last), then hash of the text and of the row. Equal rows count as one."""
    spot = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t", "r")
    firsts = placed.groupBy("component").agg(F.min(spot).alias("k")).select(F.col("k.doc_id").alias("d1"), F.col("k.t").alias("t1"), F.col("k.r").alias("r1"))
    keyed = row_keys(docs)
    same = keyed["doc_id"].eqNullSafe(F.col("d1")) & (keyed["t"] == F.col("t1")) & (keyed["r"] == F.col("r1"))
    return keyed.join(firsts, same, "left_semi").dropDuplicates(["doc_id", "t", "r"]).select("row.*")
