"""Queries of the training-data operators, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scarmap.llm import alignment, bpe, chat, html, langid, licenses, line_dedup, mixing, order_minhash, periodic, simhash, topk, toxicity
from scarmap.llm.license_texts import license_table
from scarmap.llm.tables import table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return simhash.simhash_components(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_texts(table(spark, sf_dir, "pages"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = r"\### Assistant: </turn> ok"
    added = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(probe).alias("text")) for i, r in enumerate(("user", "assistant"))])).alias("t"),
    ).select("conv_id", "t.*")
    chats = chat.format_chats(turns.unionByName(added))
    read = chats.select(
        "conv_id", F.length("formatted").cast("long").alias("formatted_chars"), chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("segments")).alias("loss")
    )
    spelled = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spelled, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = order_minhash.edited_fingerprints(table(spark, sf_dir, "documents"))
    return marked.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        order_minhash.spelled(F.col("signature")).alias("fingerprint"),
        order_minhash.spelled(F.col("edited_signature")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.scaled(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors.where("id % 50 = 0"), vectors)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_words(table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.bpe_round_trip(table(spark, sf_dir, "documents"), tokenizer_path())
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, least_chars=line_dedup.EVERY_LINE)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), license_table(spark))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digest(periodic.periodic_runs(table(spark, sf_dir, "documents"), periodic.planted_runs))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict:
    return {
        f.__name__: f
        for f in (
            op1_simhash_near_dedup,
            op2_html_extraction,
            op3_chat_formatting,
            op4_order_minhash,
            op5_exact_top_k,
            op6_mixing,
            op7_bpe,
            op8_line_dedup,
            op9_language_id,
            op10_license_scan,
            op11_alignment,
            op12_periodic_runs,
            op13_toxicity,
        )
    }


_ESCAPED = "length(replace(replace(replace({0}, '\\', '\\s'), '<', '\\l'), '>', '\\g'))"

ORACLE = {
    "op3_chat_formatting": f"""
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
        r AS (SELECT *, role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS starts FROM t)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(sum({_ESCAPED.format("text")} + CASE WHEN starts THEN 6 + {_ESCAPED.format("role")} ELSE 3 END) AS BIGINT) AS formatted_chars
        FROM r GROUP BY conv_id""",
    "op5_exact_top_k": """
        WITH e AS (SELECT vec_id AS id, list_transform(embedding, lambda v: floor(CAST(v AS DOUBLE) * 256)) AS x FROM embeddings
                   WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
        p AS (SELECT q.id AS query_id, c.id AS vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score FROM e q JOIN e c ON q.id <> c.id WHERE q.id % 50 = 0),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
}


def oracle_sql() -> dict:
    return dict(ORACLE)
