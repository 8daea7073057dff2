"""Queries over conversations: stages, objects, relations, calls, chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import chunks, joins, stages, versions
from ..sources.dialogue import conversations
from .registry import query

TOK = r"list_distinct(list_transform(regexp_extract_all(coalesce(text, ''), '[A-Za-z_][A-Za-z0-9_.:/-]*|[\x{4e00}-\x{9fff}]{2,}'), lambda t: lower(t)))"
STAGED = f"""
    m AS (SELECT conv_id AS session_id, 'e' || (turn + 1) AS id, (turn + 1)::INT AS ord, role, text, {TOK} AS tok FROM conversations WHERE role IN ('user', 'assistant')),
    b AS (SELECT *, coalesce(last_value(CASE WHEN role = 'user' THEN tok END IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), []) AS prev,
          ord - lag(ord) OVER (PARTITION BY session_id ORDER BY ord) AS gap FROM m),
    n AS (SELECT *, len(list_filter(tok, lambda t: NOT list_contains(prev, t))) AS novel, len(list_filter(tok, lambda t: list_contains(prev, t))) AS shared FROM b),
    staged AS (SELECT session_id, id, ord, role, text, tok, sum((gap IS NULL OR (role = 'user' AND (gap >= 180 OR (regexp_matches(text, '{X.TOPIC[5:]}') AND novel >= 2) OR (novel >= 5 AND shared = 0))))::INT) OVER (PARTITION BY session_id ORDER BY ord)::BIGINT AS stage FROM n)"""
ROLLUP = """rollup AS (SELECT session_id, stage, min(ord) AS start_order, max(ord) AS end_order, count(*) AS messages, count(*) FILTER (role = 'user') AS user_messages, substr(coalesce(arg_min(text, ord), ''), 1, 80) AS label FROM staged GROUP BY ALL)"""
CUE = r"(?:^|[^A-Za-z])(?:that|avec|nicht|para)(?:[^A-Za-z]|$)"


def staged(spark, sf_dir: str) -> DataFrame:
    return stages.identify_stages(conversations(spark, sf_dir))


@query(f"WITH {STAGED} SELECT session_id, id, ord, stage FROM staged")
def stage_sessions(spark, sf_dir):
    return staged(spark, sf_dir).select("session_id", "id", "ord", F.col("stage").cast("long").alias("stage"))


@query(f"WITH {STAGED}, {ROLLUP} SELECT * FROM rollup")
def stage_rollup(spark, sf_dir):
    return stages.stage_rollup(staged(spark, sf_dir).withColumn("stage", F.col("stage").cast("long")))


@query(f"""WITH {STAGED}, r AS (SELECT conv_id AS session_id, 'e' || (turn + 1) AS id, (turn + 1)::INT AS ord FROM conversations)
    SELECT r.session_id, r.id, last_value(s.stage IGNORE NULLS) OVER (PARTITION BY r.session_id ORDER BY r.ord)::BIGINT AS stage FROM r LEFT JOIN staged s USING (session_id, id)""")
def stage_fill(spark, sf_dir):
    return stages.fill_stages(conversations(spark, sf_dir), staged(spark, sf_dir)).select("session_id", "id", F.col("stage").cast("long").alias("stage"))


@query(f"""WITH {STAGED}, {ROLLUP}, p AS (SELECT conv_id AS session_id, (turn + 1)::INT AS ord FROM conversations)
    SELECT p.session_id, p.ord, coalesce(max(stage) FILTER (ord BETWEEN start_order AND end_order), max(stage) FILTER (start_order <= ord), min(stage)) AS stage FROM p LEFT JOIN rollup USING (session_id) GROUP BY ALL""")
def stage_of_order(spark, sf_dir):
    s = staged(spark, sf_dir).withColumn("stage", F.col("stage").cast("long"))
    return stages.stage_of_order(conversations(spark, sf_dir).select("session_id", "ord"), stages.stage_rollup(s))


@query(f"""WITH t AS (SELECT conv_id AS session_id, unnest({TOK}) AS token FROM conversations), c AS (SELECT session_id, token, count(*) AS n FROM t GROUP BY ALL)
    SELECT session_id, token, n, row_number() OVER (PARTITION BY session_id ORDER BY n DESC, token) AS place FROM c QUALIFY place <= 3""")
def message_tokens_topk(spark, sf_dir):
    t = conversations(spark, sf_dir).select("session_id", F.explode(X.tokens(F.col("text"))).alias("token")).groupBy("session_id", "token").agg(F.count("*").alias("n"))
    w = Window.partitionBy("session_id").orderBy(F.desc("n"), "token")
    return t.withColumn("place", F.row_number().over(w).cast("long")).where(F.col("place") <= 3)


@query("""WITH r AS (SELECT conv_id AS session_id, 'e' || (turn + 1) AS id, turn + 1 AS ord, role, lower(substr(text, 1, 2)) AS call_id FROM conversations),
    w AS (SELECT *, count(*) FILTER (role = 'user') OVER p AS calls, last_value(CASE WHEN role = 'user' THEN id END IGNORE NULLS) OVER p AS call FROM r WHERE role IN ('user', 'assistant') WINDOW p AS (PARTITION BY session_id, call_id ORDER BY ord))
    SELECT session_id, id, CASE WHEN calls = 1 THEN call END AS call_source, CASE WHEN calls <> 1 THEN 'unmatched_result' END AS reason FROM w WHERE role = 'assistant'""")
def call_pairing(spark, sf_dir):
    r = conversations(spark, sf_dir).where(F.col("role").isin("user", "assistant")).withColumn("call_id", F.lower(F.substring("text", 1, 2))).withColumn("kind", F.when(F.col("role") == "user", "call").otherwise("result"))
    return versions.pair_calls(r).select("session_id", "id", "call_source", "reason")


@query(f"""WITH {STAGED}, o AS (SELECT session_id, id, ord, stage, text, unnest(list_filter(tok, lambda t: length(t) >= 6)) AS object FROM staged)
    SELECT DISTINCT a.session_id, a.id AS src, b.id AS dst, a.stage AS stage_from, b.stage AS stage_to, 'revision' AS relation FROM o a JOIN o b ON a.session_id = b.session_id AND a.object = b.object AND b.ord > a.ord AND a.stage <> b.stage AND regexp_matches(b.text, '{CUE}')""")
def discussion_edges(spark, sf_dir):
    s = staged(spark, sf_dir).withColumn("stage", F.col("stage").cast("long"))
    return stages.discussion_edges(s, CUE, F.filter("tokens", lambda t: F.length(t) >= 6))


@query()
def object_index(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.col("page_id").alias("session_id"), F.lit("e1").alias("id"), F.lit(1).alias("ord"), F.lit(1).alias("stage"), F.col("html").alias("text"))
    out = stages.object_index(pages)
    return out.select("session_id", "object_id", "object_kind", *(F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("aliases", "message_ids", "stage_ids")))


@query(r"""WITH r AS (SELECT conv_id AS session_id, turn + 1 AS ord, 'e' || (turn + 1) AS id, regexp_matches(text, '(?:^|[^A-Za-z])(?:that|avec|nicht|para)(?:[^A-Za-z]|$)') AS hit FROM conversations)
    SELECT session_id, id FROM r QUALIFY bool_or(hit) OVER (PARTITION BY session_id ORDER BY ord ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)""")
def evidence_projection(spark, sf_dir):
    r = conversations(spark, sf_dir)
    cited = r.where(F.col("text").rlike(CUE)).select("session_id", F.col("id").alias("source"))
    return chunks.evidence_projection(r, cited, 1).select("session_id", "id")


@query("""WITH r AS (SELECT conv_id, turn, 'e' || (turn + 1) AS id, text, row_number() OVER (PARTITION BY lower(substr(text, 1, 12)) ORDER BY conv_id, turn) AS n, first_value(conv_id || ':' || turn) OVER (PARTITION BY lower(substr(text, 1, 12)) ORDER BY conv_id, turn) AS f FROM conversations)
    SELECT conv_id, turn, CASE WHEN n > 1 THEN f END AS same_as FROM r""")
def body_dedup(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", F.concat_ws(":", "conv_id", "turn").alias("id"), F.lower(F.substring("text", 1, 12)).alias("body"), F.struct("conv_id", "turn").alias("at"))
    return chunks.body_dedup(c, [], "at", "body").select("conv_id", "turn", "same_as")


@query("""WITH s AS (SELECT conv_id AS session_id, role AS source, min(turn) AS o FROM conversations GROUP BY ALL)
    SELECT session_id, source, '资料' || row_number() OVER (PARTITION BY session_id ORDER BY o, source) AS ref FROM s""")
def local_references(spark, sf_dir):
    c = conversations(spark, sf_dir).select("session_id", F.col("role").alias("source"), "ord")
    return chunks.local_references(c, ["session_id"])


@query()
def chunk_packing(spark, sf_dir):
    r = conversations(spark, sf_dir).withColumn("size", chunks.record_size("id", "role", "text"))
    return chunks.pack_chunks(r, 2000, 1).withColumn("record_ids", F.array_join("record_ids", ","))


@query()
def line_fragments(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("string").alias("id"), "text")
    f = chunks.fragments(d, 2000)
    return f.select("id", "parent_id", F.length("text").alias("chars"), "fragment.first_line", "fragment.last_line")


@query("""SELECT conv_id AS session_id, 'e' || (turn + 1) AS id, CASE WHEN role = 'system' THEN 'document' ELSE 'conversation' END AS source_kind FROM conversations""")
def source_kinds(spark, sf_dir):
    c = conversations(spark, sf_dir)
    return c.select("session_id", "id", X.source_kind(F.col("kind"), F.when(F.col("role") == "system", "document").otherwise("other")).alias("source_kind"))


@query("""SELECT conv_id AS session_id, count(*) AS records, count(*) FILTER (role = 'user') AS users, count(*) FILTER (length(text) > 400) AS long_texts FROM conversations WHERE turn + 1 <= 3 GROUP BY ALL""")
def cutoff_counts(spark, sf_dir):
    c = conversations(spark, sf_dir).where(F.col("ord") <= 3)
    return c.groupBy("session_id").agg(F.count("*").alias("records"), F.count_if(F.col("role") == "user").alias("users"), F.count_if(F.length("text") > 400).alias("long_texts"))
