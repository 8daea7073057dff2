"""The registered queries opN_<name>: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, exact_dedup, language, merkle, mixing, near_dedup, packing, passages, pii, resampling
from .common import Scratch, table


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.copies(table(spark, sf_dir, "documents"), Scratch(spark))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = F.lit("\\### Assistant: </turn> ok")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), text.alias("text"))
    done = chat_format.format_conversations(rows.unionByName(extra))
    read = done.select("conv_id", "formatted", chat_format.parse_all(F.col("formatted")).alias("turns"), chat_format.loss_text(F.col("formatted"), F.col("mask")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def op1_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.memberships(table(spark, sf_dir, "documents"), Scratch(spark))
    best = F.array_max(F.transform(F.map_entries("posterior"), lambda e: F.struct(e["value"].alias("p"), e["key"].alias("d"))))
    return found.select("doc_id", "tokens", best["d"].alias("domain"), best["p"].alias("posterior"), "rate", "copies")


def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), Scratch(spark))
    return found.select(F.col("id").alias("doc_id"), "log_weight", F.col("key").alias("gumbel_key"), "kept")


def op3_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.groups(table(spark, sf_dir, "documents"), Scratch(spark), width=2)
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary())


def op5_language_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language.train(docs))
    return found.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op6_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passages(table(spark, sf_dir, "documents"), Scratch(spark))


def op7_merkle_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare_edits(table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(table(spark, sf_dir, "documents"))
    said = lambda which: F.array_join(F.transform(which, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))
    return found.select("doc_id", *map(n, pii.KINDS), F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"), F.coalesce(F.array_max(F.col("spans")["score"]), F.lit(0.0)).alias("top_score"))


QUERIES = {f.__name__: f for f in (op1_soft_mixing, op2_importance_resampling, op3_lsh_forest, op4_best_fit_packing, op5_language_field, op6_compact_windows, op7_merkle_fingerprint, op8_pii, op9_chat_format, op10_exact_dedup)}

#: DuckDB SQL of the queries that SQL can express.
ORACLES = {
    "op10_exact_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
             g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)""",
    "op9_chat_format": r"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) r(i)),
             e AS (SELECT *, replace(replace(replace(text, '\', '\b'), '</turn>', '\t'), '###', '\h') AS coded FROM c)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length(role) + length(coded) + 17)::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id""",
}
