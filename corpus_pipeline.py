"""The corpus pipeline: from raw documents to token ids, in five stages.

Every stage takes rows as they are: rows of one doc_id, or of none, are documents of their own (equal
rows of one doc_id are one to the near-copy stage), null texts have no language and go first, an empty
table gives an empty table, and other columns, whatever their names, are carried along to the last
stage, which has columns of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scarmap.llm import bpe, langid, line_dedup, mixing, simhash
from scarmap.llm.registry import tokenizer_path
from scarmap.llm.tables import column, table, whole_row
from scarmap.shared import discard, written

#: Texts less like every language than this (cosine) are none.
LEAST_SCORE = 0.05


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: those without a letter, or like no language, go."""
    labels, profiles = langid.train_profiles(docs.where(~langid.held_out(docs["doc_id"])))
    marked = docs.select(whole_row(docs).alias("row"), langid.predictor(labels, profiles)(docs["text"]).alias("p"))
    return marked.where((F.col("p.lang_pred") != langid.UNDETERMINED) & (F.col("p.score") >= LEAST_SCORE)).select("row.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents rid of lines that repeat an earlier one; those left without a word go."""
    others = F.struct(*[column(docs, c) for c in docs.columns if c != "text"])
    packed = docs.select("doc_id", "text", others.alias("row"))
    out = line_dedup.dedup_lines(packed, least_chars=line_dedup.EVERY_LINE).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return out.select(*[(changed[c] if c in changed else F.col("row").getField(c)).alias(c) for c in docs.columns])


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group linked by a five-word Jaccard likeness of 0.8 or more."""
    return simhash.near_dedup(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source's documents as often as its target weight takes them."""
    return mixing.mix_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, little-endian and 32 bits wide, with a digest of what they decode to."""
    coded = bpe.bpe_round_trip(docs, tokenizer_path())
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_copy_stage),
    ("source_mixing", mixing_stage),
    ("bpe_encoding", token_stage),
]

#: Learned profiles, MinHash and BPE have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, sf_dir), name)
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
