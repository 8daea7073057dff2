"""Queries over events and the star schema: bands, as-of, versions, graphs, trial metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import graph, joins, metrics, review, versions
from ..scratch import Scratch
from .registry import query, table

EV = "ev AS (SELECT user_id, event_id, event_type, value, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ord FROM events)"
STATES = "v AS (SELECT c_nationkey AS session_id, o_orderpriority AS path, o_orderkey, o_orderstatus AS status, row_number() OVER (PARTITION BY c_nationkey ORDER BY o_orderdate, o_orderkey) AS observed_at FROM orders JOIN customer ON o_custkey = c_custkey)"


def events(spark, sf_dir) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts", F.row_number().over(w).cast("long").alias("ord"))


def states(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    w = Window.partitionBy("c_nationkey").orderBy("o_orderdate", "o_orderkey")
    return o.select(F.col("c_nationkey").alias("session_id"), F.col("o_orderpriority").alias("path"), "o_orderkey", F.col("o_orderstatus").alias("status"), F.row_number().over(w).cast("long").alias("observed_at"))


@query(f"WITH {EV} SELECT a.user_id, a.event_id AS l_event_id, b.event_id AS r_event_id FROM ev a JOIN ev b ON a.user_id = b.user_id AND abs(a.ord - b.ord) <= 6 WHERE a.event_type = 'error' AND b.event_type = 'purchase'")
def context_band(spark, sf_dir):
    e = events(spark, sf_dir)
    j = joins.band_join(e.where("event_type = 'error'"), e.where("event_type = 'purchase'"), ["user_id"], "ord", 6)
    return j.select("user_id", "l_event_id", "r_event_id")


@query(f"WITH {EV} SELECT user_id, event_id FROM ev QUALIFY bool_or(event_type = 'error') OVER (PARTITION BY user_id ORDER BY ord ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)")
def neighbour_padding(spark, sf_dir):
    return joins.pad_hits(events(spark, sf_dir), ["user_id"], "ord", F.col("event_type") == "error", 2).select("user_id", "event_id")


@query(f"""WITH {EV}, g AS (SELECT *, (coalesce(event_id - lag(event_id) OVER (PARTITION BY user_id ORDER BY ord) >= 300, true))::INT AS st FROM ev), s AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY ord)::BIGINT AS session FROM g)
    SELECT user_id, session, min(event_id) AS first_event, max(event_id) AS last_event, count(*) AS n FROM s GROUP BY ALL""")
def event_sessions(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ord")
    e = events(spark, sf_dir).withColumn("st", F.coalesce(F.col("event_id") - F.lag("event_id").over(w) >= 300, F.lit(True)).cast("int"))
    return e.withColumn("session", F.sum("st").over(w)).groupBy("user_id", "session").agg(F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"), F.count("*").alias("n"))


@query(f"""WITH {EV}, p AS (SELECT * FROM ev WHERE event_type = 'click'), q AS (SELECT user_id, ord AS at, event_id AS seen, value AS price FROM ev WHERE event_type = 'purchase')
    SELECT p.user_id, p.event_id, q.seen, q.price FROM p ASOF LEFT JOIN q ON p.user_id = q.user_id AND p.ord >= q.at""")
def asof_versions(spark, sf_dir):
    e = events(spark, sf_dir)
    v = e.where("event_type = 'purchase'").select("user_id", "ord", F.col("event_id").alias("seen"), F.col("value").alias("price"))
    j = joins_as_of(e.where("event_type = 'click'"), v)
    return j.select("user_id", "event_id", "version.seen", "version.price")


def joins_as_of(points: DataFrame, v: DataFrame) -> DataFrame:
    return versions.as_of_join(points, v, ["user_id"], "ord", "ord")


@query(f"WITH {STATES} SELECT session_id, path, o_orderkey, observed_at AS valid_from, lead(observed_at) OVER (PARTITION BY session_id, path ORDER BY observed_at) AS valid_to FROM v")
def version_intervals(spark, sf_dir):
    return versions.intervals(states(spark, sf_dir), "observed_at").select("session_id", "path", "o_orderkey", "valid_from", "valid_to")


@query(f"WITH {STATES}, i AS (SELECT *, lead(observed_at) OVER (PARTITION BY session_id, path ORDER BY observed_at) AS valid_to FROM v) SELECT session_id, path, o_orderkey, status FROM i WHERE observed_at <= 100 AND (valid_to IS NULL OR valid_to > 100)")
def files_at_cutoff(spark, sf_dir):
    return versions.as_of(versions.intervals(states(spark, sf_dir), "observed_at"), 100).select("session_id", "path", "o_orderkey", "status")


@query("""WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders)
    SELECT a.o_custkey AS session_id, a.o_orderkey AS version_id, b.o_orderkey AS ancestor, (a.n - b.n)::INT AS distance FROM r a JOIN r b ON a.o_custkey = b.o_custkey AND b.n < a.n""")
def version_ancestry(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    v = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("session_id"), F.col("o_orderkey").alias("version_id"), F.lag("o_orderkey").over(w).alias("previous"))
    return versions.ancestry(v, Scratch(spark))


EDGES = "e AS (SELECT DISTINCT 's' || l_suppkey AS a, 'p' || l_partkey AS b FROM lineitem)"


@query(f"""WITH {EDGES}, u AS (SELECT a, b FROM e UNION SELECT b, a FROM e), d1 AS (SELECT DISTINCT b AS node FROM u WHERE a = 's1'), d2 AS (SELECT DISTINCT u.b AS node FROM u JOIN d1 ON u.a = d1.node)
    SELECT node, min(depth) AS depth FROM (SELECT 's1' AS node, 0 AS depth UNION ALL SELECT node, 1 FROM d1 UNION ALL SELECT node, 2 FROM d2) GROUP BY node""")
def khop_scope(spark, sf_dir):
    e = table(spark, sf_dir, "lineitem").select(F.lit(0).alias("session_id"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("src"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("dst")).distinct()
    seeds = spark.createDataFrame([(0, "s1")], "session_id int, node string")
    return graph.khop(e, seeds, 2).select("node", "depth")


@query("""WITH c AS (SELECT DISTINCT c_nationkey AS n FROM customer), s AS (SELECT DISTINCT s_nationkey AS n FROM supplier),
    r0 AS (SELECT n_nationkey AS n FROM nation WHERE n_regionkey = 0)
    SELECT 'c' || c_custkey AS item, CASE WHEN c_nationkey IN (FROM r0) THEN 1 END AS max_distance, CASE WHEN c_nationkey IN (FROM r0) THEN 'easy' ELSE 'unknown' END AS difficulty FROM customer
    UNION ALL SELECT 's' || s_suppkey, CASE WHEN s_nationkey IN (FROM r0) THEN 2 END, CASE WHEN s_nationkey IN (FROM r0) THEN 'medium' ELSE 'unknown' END FROM supplier""")
def shortest_difficulty(spark, sf_dir):
    name = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    n = table(spark, sf_dir, "nation").select(name("n", "n_nationkey").alias("src"), name("r", "n_regionkey").alias("dst"), F.lit(1).alias("weight"))
    c = table(spark, sf_dir, "customer").select(name("c", "c_custkey").alias("src"), name("n", "c_nationkey").alias("dst"), F.lit(0).alias("weight"))
    s = table(spark, sf_dir, "supplier").select(name("s", "s_suppkey").alias("src"), name("n", "s_nationkey").alias("dst"), F.lit(1).alias("weight"))
    edges = n.unionByName(c).unionByName(s).withColumn("session_id", F.lit(0))
    dist = graph.distances(edges, spark.createDataFrame([(0, "r0")], "session_id int, node string"))
    items = c.select(F.col("src").alias("node")).unionByName(s.select(F.col("src").alias("node"))).select(F.lit(0).alias("session_id"), F.col("node").alias("item"), F.lit("r0").alias("start"), "node")
    return graph.difficulty(items, dist).select("item", "max_distance", "difficulty")


@query(f"""WITH {EV}, b AS (SELECT user_id, event_id, unnest(list_distinct([event_type, 'd' || dayofmonth(ts)])) AS block FROM ev),
    t AS (SELECT *, row_number() OVER (PARTITION BY user_id, block ORDER BY event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id, block) AS n FROM b),
    thin AS (SELECT * FROM t WHERE n <= 4 OR i IN (round_even(0, 0), round_even((n - 1) / 3, 0), round_even(2 * (n - 1) / 3, 0), n - 1)),
    met AS (SELECT DISTINCT b.user_id, b.event_id, thin.event_id AS neighbour FROM b JOIN thin USING (user_id, block) WHERE b.event_id <> thin.event_id),
    w AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_id ORDER BY neighbour) - 1 AS i, count(*) OVER (PARTITION BY user_id, event_id) AS n FROM met)
    SELECT user_id, event_id, neighbour FROM w WHERE n <= 5 OR i IN (0, round_even((n - 1) / 4, 0), round_even(2 * (n - 1) / 4, 0), round_even(3 * (n - 1) / 4, 0), n - 1)""")
def posting_thinned_neighbors(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("blocks", F.array("event_type", F.concat(F.lit("d"), F.dayofmonth("ts").cast("string"))))
    return joins.blocked_neighbours(e, ["user_id"], "event_id", "blocks", ["event_id"], 4, 5)


ACT = """acts AS (SELECT user_id, event_id AS seq, CASE event_type WHEN 'view' THEN 'file_editor' WHEN 'signup' THEN 'think' WHEN 'purchase' THEN 'finish' ELSE 'terminal' END AS tool, CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'cd x && cat y' ELSE 'ls' END AS cmd, event_type, value FROM events),
    resp AS (SELECT user_id, count(*) AS provider_requests, sum(floor(value))::BIGINT AS prompt_tokens, sum(CASE WHEN event_id % 50 <> 0 THEN event_id % 100 END)::BIGINT AS completion_tokens, bool_and(event_id % 50 <> 0) AS usage_complete FROM events WHERE event_type = 'purchase' GROUP BY 1),
    m AS (SELECT a.user_id, count(*) AS raw_action_count, count(*) FILTER (tool NOT IN ('think', 'finish')) AS tool_calls, count(*) FILTER (tool = 'file_editor') AS file_view_calls, count(*) FILTER (event_type = 'click') AS shell_read_or_search_calls, count(*) FILTER (tool = 'think') AS think_tool_calls FROM acts a GROUP BY 1)"""
METRICS = "mm AS (SELECT user_id, raw_action_count, tool_calls, file_view_calls, shell_read_or_search_calls, think_tool_calls, coalesce(provider_requests, 0) AS provider_requests, coalesce(prompt_tokens, 0) + coalesce(completion_tokens, 0) AS total_tokens, coalesce(usage_complete, false) AS usage_complete FROM m LEFT JOIN resp USING (user_id))"
COLS = ["user_id", "raw_action_count", "tool_calls", "file_view_calls", "shell_read_or_search_calls", "think_tool_calls", "provider_requests", "total_tokens", "usage_complete"]


def measured(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    t = F.col("event_type")
    acts = e.select("user_id", F.lit("ActionEvent").alias("kind"), F.col("event_id").alias("seq"), F.when(t == "view", "file_editor").when(t == "signup", "think").when(t == "purchase", "finish").otherwise("terminal").alias("tool_name"), F.when(t == "view", "view").when(t == "click", "cd x && cat y").otherwise("ls").alias("command"), F.col("event_id").cast("string").alias("tool_call_id"), F.lit(None).cast("string").alias("content"), F.lit(None).cast("string").alias("thought"))
    seen = acts.withColumn("kind", F.lit("ObservationEvent")).withColumn("content", F.repeat(F.lit("x"), (F.col("seq") % 9).cast("int")))
    resp = e.where(t == "purchase").select("user_id", F.floor("value").alias("prompt_tokens"), F.when(F.col("event_id") % 50 != 0, F.col("event_id") % 100).alias("completion_tokens"), F.lit(None).cast("string").alias("reasoning"))
    return metrics.measure(acts.unionByName(seen), resp, ["user_id"])


@query(f"WITH {ACT}, {METRICS}, o AS (SELECT user_id, sum(CASE WHEN tool = 'file_editor' THEN seq % 9 END)::BIGINT AS file_view_chars FROM acts GROUP BY 1) SELECT mm.*, coalesce(file_view_chars, 0) AS file_view_chars FROM mm JOIN o USING (user_id)")
def tool_metrics(spark, sf_dir):
    return measured(spark, sf_dir).select(*COLS, "file_view_chars")


@query(f"""WITH {ACT}, {METRICS}, t AS (SELECT *, user_id // 2 AS task, file_view_calls % 3 > 0 AS ok FROM mm)
    SELECT a.task, a.ok AND b.ok AS both_passed, b.ok::INT - a.ok::INT AS completion_difference, CASE WHEN a.ok AND b.ok THEN b.tool_calls - a.tool_calls END AS tool_calls_difference, CASE WHEN a.ok AND b.ok AND a.usage_complete AND b.usage_complete THEN b.total_tokens - a.total_tokens END AS total_tokens_difference FROM t a JOIN t b ON a.task = b.task AND a.user_id % 2 = 0 AND b.user_id % 2 = 1""")
def paired_deltas(spark, sf_dir):
    t = measured(spark, sf_dir).select(F.floor(F.col("user_id") / 2).alias("task"), (F.col("user_id") % 2).alias("condition"), (F.col("file_view_calls") % 3 > 0).alias("ok"), "tool_calls", "total_tokens", "usage_complete")
    return metrics.paired_deltas(t, "task", "condition", 0, 1, "ok", ["tool_calls", "total_tokens"], {"total_tokens": "usage_complete"})


@query("""SELECT user_id, CASE WHEN count(CASE WHEN event_type <> 'error' THEN value END) = count(*) THEN round(sum(value), 4) END AS total, count(*) AS n FROM events GROUP BY user_id""")
def strict_totals(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.round(metrics.strict_sum(F.when(F.col("event_type") != "error", F.col("value"))), 4).alias("total"), F.count("*").alias("n"))


@query("""WITH t AS (SELECT event_type, user_id % 2 AS c, (value > 50)::INT AS ok FROM events)
    SELECT event_type, count(*) FILTER (c = 0) AS n_without, count(*) FILTER (c = 1) AS n_with, avg(ok) FILTER (c = 0) AS rate_without, avg(ok) FILTER (c = 1) AS rate_with, avg(ok) FILTER (c = 1) - avg(ok) FILTER (c = 0) AS difference FROM t GROUP BY 1""")
def pass_rates(spark, sf_dir):
    t = table(spark, sf_dir, "events").select("event_type", (F.col("user_id") % 2).alias("c"), (F.col("value") > 50).alias("ok"))
    return metrics.pass_rates(t, ["event_type"], "c", 0, 1, "ok")


@query("""SELECT event_type, count(*) AS n, min(value) AS value_min, max(value) AS value_max, round(avg(value), 3) AS value_mean, round(median(value), 3) AS value_median FROM events GROUP BY 1""")
def usage_summary(spark, sf_dir):
    return metrics.usage_summary(table(spark, sf_dir, "events"), ["event_type"], ["value"])


@query("""SELECT user_id, count(*) FILTER (event_type = 'view') AS "view", count(*) FILTER (event_type = 'error') AS "error", count(*) FILTER (event_type NOT IN ('view', 'error')) AS unknown FROM events GROUP BY 1""")
def conditional_counts(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", F.when(F.col("event_type").isin("view", "error"), F.col("event_type")).alias("s"))
    return metrics.counts_by_state(e, "s", ["view", "error", "unknown"], ["user_id"])


@query("""SELECT p_partkey AS id, CASE WHEN n > 0 AND bad > 0 THEN 'failed' WHEN n = 1 AND good = 1 THEN 'passed' ELSE 'uncertain' END AS status FROM
    (SELECT p_partkey, count(l_orderkey) AS n, count(*) FILTER (l_returnflag = 'R') AS bad, count(*) FILTER (l_returnflag = 'N') AS good FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY 1)""")
def acceptance(spark, sf_dir):
    items = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.array(F.concat(F.lit("t::"), F.col("p_partkey").cast("string"))).alias("tests"))
    cases = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("t::"), F.col("l_partkey").cast("string")).alias("id"), F.when(F.col("l_returnflag") == "R", "failed").when(F.col("l_returnflag") == "N", "passed").otherwise("skipped").alias("status"))
    return metrics.assess_acceptance(items, cases, "passed")


@query("""SELECT o_orderkey, count(*) FILTER (s IN (1, 2, 3, 4, 5)) = count(*) AND count(DISTINCT s) = count(*) AS ok FROM (SELECT o_orderkey, l_suppkey % 7 AS s FROM orders JOIN lineitem ON o_orderkey = l_orderkey) GROUP BY 1""")
def sources_contained(spark, sf_dir):
    l = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_orderkey").agg(F.collect_list(F.col("l_suppkey") % 7).alias("s"))
    return l.select("o_orderkey", joins.contained(F.col("s"), F.array(*(F.lit(i).cast("long") for i in range(1, 6)))).alias("ok"))


@query("""WITH l AS (SELECT DISTINCT 'shop/' || p_brand || '/' || p_size AS path FROM part), r AS (SELECT DISTINCT p_brand || '/' || p_size AS path FROM part WHERE p_size % 3 = 0 UNION SELECT DISTINCT p_size::VARCHAR FROM part WHERE p_size % 5 = 0)
    SELECT l.path AS l_path, r.path AS r_path FROM l JOIN r ON l.path = r.path OR ends_with(l.path, '/' || r.path) OR ends_with(r.path, '/' || l.path)""")
def path_suffixes(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    l = p.select(F.concat_ws("/", F.lit("shop"), "p_brand", "p_size").alias("path")).distinct()
    r = p.where("p_size % 3 = 0").select(F.concat_ws("/", "p_brand", "p_size").alias("path")).union(p.where("p_size % 5 = 0").select(F.col("p_size").cast("string"))).distinct()
    return joins.suffix_join(l, r, [], "path")


@query("""WITH a AS (SELECT DISTINCT l_orderkey AS request, 'q' || l_linenumber AS id FROM lineitem), r AS (SELECT l_orderkey AS request, 'q' || (CASE WHEN l_quantity > 40 THEN 9 ELSE l_linenumber END) AS id, l_linenumber AS n FROM lineitem),
    c AS (SELECT request, count(*) AS k, min(id) AS o FROM a GROUP BY 1), j AS (SELECT r.*, CASE WHEN a.id IS NOT NULL THEN a.id WHEN c.k = 1 THEN c.o END AS candidate, a.id IS NOT NULL AS own FROM r LEFT JOIN a USING (request, id) LEFT JOIN c USING (request))
    SELECT request, id, n, candidate, CASE WHEN candidate IS NULL OR count(*) OVER (PARTITION BY request, candidate) > 1 THEN 'malformed' WHEN own THEN 'matched' ELSE 'placeholder' END AS state FROM j""")
def review_matching(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    cand = l.select(F.col("l_orderkey").alias("request"), F.concat(F.lit("q"), F.col("l_linenumber").cast("string")).alias("id"), F.lit(None).cast("string").alias("alias")).distinct()
    rev = l.select(F.col("l_orderkey").alias("request"), F.concat(F.lit("q"), F.when(F.col("l_quantity") > 40, 9).otherwise(F.col("l_linenumber")).cast("string")).alias("id"), F.col("l_linenumber").alias("n"))
    return review.match_reviews(rev, cand).select("request", "id", "n", "candidate", "state")


@query()
def event_beam(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("session_id", F.col("user_id"))
    t = F.col("event_type")
    idx = e.select("session_id", F.lpad(F.col("event_id").cast("string"), 9, "0").alias("id"), "ord", F.array(F.concat(F.lit("day"), F.dayofmonth("ts").cast("string"))).alias("paths"), F.array_compact(F.array(F.when(t == "error", F.lit("failure")), F.when(t == "purchase", F.lit("change")), F.when(t == "click", F.lit("feedback")))).alias("labels"), F.lit(1).alias("versions"))
    return graph.beam(idx, Scratch(spark), width=2, depth=3).withColumn("event_ids", F.array_join("event_ids", ","))


@query("""SELECT session_id, id, kind, list_aggregate(list_sort(labels), 'string_agg', ',') AS labels, n_sources FROM (
    SELECT a.user_id AS session_id, a.event_id AS id, CASE a.event_type WHEN 'error' THEN 'result' ELSE 'patch' END AS kind, list_distinct(list_concat(list(b.event_type), [min(CASE a.event_type WHEN 'error' THEN 'failure' ELSE 'change' END)])) AS labels, count(DISTINCT b.event_id) AS n_sources
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ord FROM events) a JOIN (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ord FROM events) b ON a.user_id = b.user_id AND abs(a.ord - b.ord) <= 3 WHERE a.event_type IN ('error', 'purchase') GROUP BY a.user_id, a.event_id, a.event_type)""")
def event_index(spark, sf_dir):
    e = events(spark, sf_dir).select(F.col("user_id").alias("session_id"), F.col("event_id").alias("id"), "ord", "event_type")
    ev = e.where(F.col("event_type").isin("error", "purchase")).select("session_id", "id", "ord", F.when(F.col("event_type") == "error", "result").otherwise("patch").alias("kind"), (F.col("event_type") != "error").alias("success"), F.array().cast("array<string>").alias("affected_paths"))
    return graph.event_index(e, ev, F.array("event_type"), 3).select("session_id", "id", "kind", F.array_join("labels", ",").alias("labels"), F.size("source_ids").cast("long").alias("n_sources"))
