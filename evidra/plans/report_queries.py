"""Queries of reports and views over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reports, review
from ..sources.dialogue import conversations
from .event_queries import events
from .registry import query, table


@query("""SELECT t.track, coalesce(total, 0) AS total, coalesce(approved, 0) AS approved, coalesce(rejected, 0) AS rejected FROM (VALUES ('en'), ('de'), ('xx')) t(track) LEFT JOIN
    (SELECT lang AS track, count(*) AS total, count(*) FILTER (quality = 1) AS approved, count(*) FILTER (quality = 0) AS rejected FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1) q USING (track)""")
def question_stats(spark, sf_dir):
    q = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").select(F.col("lang").alias("track"), F.when(F.col("quality") == 1, "approved").when(F.col("quality") == 0, "rejected").alias("status"))
    return reports.question_stats(q, ["en", "de", "xx"], ["approved", "rejected"])


@query("""SELECT CASE WHEN quality = 0 THEN 'quality' WHEN toxic = 1 THEN 'toxic' ELSE 'malformed' END AS reason, count(*) AS n FROM labels GROUP BY 1""")
def rejection_histogram(spark, sf_dir):
    return reports.rejection_histogram(table(spark, sf_dir, "labels").select(F.when(F.col("quality") == 0, "quality").alias("reason"), F.when(F.col("toxic") == 1, "toxic").alias("error_type")))


@query("""WITH m AS (SELECT c_nationkey AS merged, o_orderpriority AS collection, o_custkey % 20 AS member, o_orderkey AS ord, o_orderkey AS s, o_orderkey + 5 AS e, o_orderstatus = 'F' AS f, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey)
    SELECT merged, collection, member, min(ord) AS ord, min(s) AS "start", max(e) AS "end", bool_and(f) AS "full", arg_min(o_totalprice, ord) AS price FROM m GROUP BY 1, 2, 3""")
def scope_merge(spark, sf_dir):
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    k = F.col("o_orderkey")
    return reports.merge_scopes(o.select(F.col("c_nationkey").alias("merged"), F.col("o_orderpriority").alias("collection"), (F.col("o_custkey") % 20).alias("member"), k.alias("ord"), k.alias("start"), (k + 5).alias("end"), (F.col("o_orderstatus") == "F").alias("full"), F.col("o_totalprice").alias("price")))


@query("""WITH r AS (SELECT o_orderkey AS ord, o_custkey AS target, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) > 1 AS again FROM orders) SELECT ord, target FROM r ORDER BY again, ord LIMIT 1200""")
def distinct_targets(spark, sf_dir):
    return reports.distinct_targets(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ord"), F.col("o_custkey").alias("target")), 1200)


@query("""SELECT p_brand AS track, count(*) AS groups, sum(p_size % 4)::BIGINT AS targets, sum(p_size % 4 * CASE p_brand WHEN 'Brand#11' THEN 5 ELSE 6 END)::BIGINT AS max_calls FROM part GROUP BY 1""")
def plan_cost(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("track"), F.when(F.col("p_size") % 4 > 0, F.sequence(F.lit(1), F.col("p_size") % 4)).otherwise(F.array().cast("array<int>")).alias("types"))
    brands = [r[0] for r in p.select("track").distinct().collect()]
    return reports.plan_cost(p, {b: 5 if b == "Brand#11" else 6 for b in brands})


@query("""WITH e AS (SELECT DISTINCT 'o' || l_orderkey AS src, 'p' || l_partkey AS dst FROM lineitem), n AS (SELECT 'p' || p_partkey AS id, 'part' AS kind FROM part)
    SELECT id, kind FROM n UNION ALL SELECT id, 'missing' FROM (SELECT src AS id FROM e UNION SELECT dst FROM e) WHERE id NOT IN (SELECT id FROM n)""")
def viewer_nodes(spark, sf_dir):
    e = table(spark, sf_dir, "lineitem").select(F.lit(0).alias("session_id"), F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("src"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("dst"))
    n = table(spark, sf_dir, "part").select(F.lit(0).alias("session_id"), F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"), F.lit("part").alias("kind"))
    return reports.viewer_graph(n, e)[0].drop("session_id")


@query("""WITH ev AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ord FROM events), w AS (SELECT *, min(ord) OVER (PARTITION BY user_id) AS lo, max(ord) OVER (PARTITION BY user_id) AS hi FROM ev)
    SELECT user_id, event_id, least(4, floor((ord - lo) * 5 / (hi - lo + 1)))::INT AS phase FROM w""")
def order_phases(spark, sf_dir):
    return reports.phases(events(spark, sf_dir).withColumn("session_id", F.col("user_id"))).select("user_id", "event_id", "phase")


@query("""SELECT conv_id AS session_id, role AS source, min(turn + 1)::INT AS position, CASE WHEN role IN ('user', 'assistant') THEN role ELSE '' END AS roles, count(DISTINCT (turn, text)) AS bodies FROM conversations GROUP BY conv_id, role""")
def material_view(spark, sf_dir):
    c = conversations(spark, sf_dir).select("session_id", F.col("role").alias("id"), F.lit(None).cast("string").alias("parent_id"), "ord", "source_kind", "role", "text", *(F.lit(None).cast(k).alias(n) for n, k in (("content", "string"), ("success", "boolean"), ("complete", "boolean"), ("timestamp", "string"), ("path", "string"))))
    return reports.material_view(c).select("session_id", "source", "position", F.array_join("roles", ",").alias("roles"), F.size("bodies").cast("long").alias("bodies"))


@query("""WITH v AS (SELECT c_nationkey AS session_id, o_orderpriority AS path, o_orderkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY o_orderdate, o_orderkey) AS seen FROM orders JOIN customer ON o_custkey = c_custkey),
    i AS (SELECT *, lead(seen) OVER (PARTITION BY session_id, path ORDER BY seen) AS until FROM v)
    SELECT DISTINCT i.session_id, i.path AS src, 'n' || i.o_orderkey AS dst, p.seen AS observed_snapshot FROM i JOIN v p ON p.session_id = i.session_id AND p.seen <= 25 AND i.seen <= p.seen AND (i.until IS NULL OR i.until > p.seen)""")
def historical_edges(spark, sf_dir):
    from ..operators.versions import intervals
    from .event_queries import states

    v = intervals(states(spark, sf_dir), "observed_at").withColumn("version_id", F.col("o_orderkey"))
    e = v.select("session_id", "version_id", F.col("path").alias("src"), F.concat(F.lit("n"), F.col("o_orderkey").cast("string")).alias("dst"), F.lit("contains").alias("kind"))
    return reports.historical_edges(v, e, 25).drop("kind")


@query("""WITH c AS (SELECT n_nationkey AS task, 'c' || s_suppkey AS id, CASE WHEN s_acctbal > 0 THEN 'yes' ELSE 'no' END AS active FROM supplier JOIN nation ON s_nationkey = n_nationkey),
    i AS (SELECT s_nationkey AS task, 'c' || l_suppkey AS id, CASE l_returnflag WHEN 'R' THEN 'failed' WHEN 'N' THEN 'passed' ELSE 'uncertain' END AS status FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
    g AS (SELECT task, id, bool_or(status = 'failed') AS bad, bool_and(status = 'passed') AS good FROM i GROUP BY 1, 2)
    SELECT task, id, CASE WHEN active <> 'yes' THEN 'not_applicable' WHEN bad THEN 'violated' WHEN good THEN 'applied' ELSE 'insufficient' END AS status FROM c LEFT JOIN g USING (task, id)""")
def history_review(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    cid = lambda c: F.concat(F.lit("c"), F.col(c).cast("string"))
    con = s.select(F.col("s_nationkey").alias("task"), cid("s_suppkey").alias("id"), F.when(F.col("s_acctbal") > 0, "yes").otherwise("no").alias("active"))
    items = table(spark, sf_dir, "lineitem").join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("s_nationkey").alias("task"), F.array(cid("l_suppkey")).alias("basis"), F.when(F.col("l_returnflag") == "R", "failed").when(F.col("l_returnflag") == "N", "passed").otherwise("uncertain").alias("status"))
    return review.history_review(con, items)


@query()
def run_manifest(spark, sf_dir):
    d, lab = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    m = reports.manifest(sources=d.groupBy("source").agg(F.count("*").alias("n")), languages=d.groupBy("lang").agg(F.count("*").alias("n")), labels=lab.groupBy("quality", "toxic").agg(F.count("*").alias("n")))
    return m.select(reports.viewer_json(F.struct(*m.columns)).alias("manifest"))
