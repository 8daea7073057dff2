"""Reports and views: manifests, question statistics, material views, scope merges, plan costs, viewer tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What a state is called in a material view.
OUTCOME = {True: "操作成功", False: "操作失败"}
CONTENT = {"known": "内容已知", "unknown": "内容未知，不能视为完整代码", "deleted": "文件已删除，没有可用文件内容"}
SOURCE_FIELDS = "id ord source_line timestamp kind source_kind role call_id name text path content success changes is_error".split()


def source_view(records: DataFrame) -> DataFrame:
    """Only the fields that may go into a model's context."""
    return records.select("session_id", *(c for c in SOURCE_FIELDS if c in records.columns))


def material_view(records: DataFrame) -> DataFrame:
    """By session and source: kinds, roles, timestamps, paths in order of first sight, outcomes and distinct bodies."""
    state = lambda m, c: F.create_map(*(x for k, v in m.items() for x in (F.lit(k), F.lit(v))))[F.col(c)]
    body = F.struct("ord", "text", "content", state(OUTCOME, "success").alias("outcome"), F.when(F.col("complete"), "完整").when(~F.col("complete"), "不完整，不能当作完整输出").alias("completeness"))
    first = F.array_sort(F.collect_list(F.when(F.col("path").isNotNull(), F.struct("ord", "path"))))["path"]
    return records.groupBy("session_id", F.coalesce("parent_id", "id").alias("source")).agg(
        F.min("ord").alias("position"), F.array_sort(F.collect_set("source_kind")).alias("source_kinds"), F.array_sort(F.collect_set(F.when(F.col("role").isin("user", "assistant"), F.col("role")))).alias("roles"),
        F.array_sort(F.collect_list(F.when(F.col("timestamp").isNotNull(), F.struct("ord", "timestamp"))))["timestamp"].alias("timestamps"), F.array_distinct(first).alias("paths"), F.array_sort(F.collect_set(body)).alias("bodies"))


def safe_facts(facts: DataFrame, known: DataFrame) -> DataFrame:
    """Facts without hashes and without record ids that have no local reference; known ids (session_id, source, ref) are rewritten.

    Ids are looked up token by token through a join; the statement is put together again in order.
    """
    parts = F.regexp_extract_all("statement", F.lit(r"[A-Za-z0-9_#-]+|[^A-Za-z0-9_#-]+"), F.lit(0))
    t = facts.where(~F.col("statement").rlike(r"\b[0-9a-f]{32,64}\b")).select("session_id", "id", F.posexplode(parts).alias("i", "source")).join(known, ["session_id", "source"], "left")
    leak = F.col("ref").isNull() & F.col("source").rlike(r"^[ev]\d+(#fragment-\d+)?$")
    g = t.groupBy("session_id", "id").agg(F.bool_or(leak).alias("leak"), F.array_join(F.array_sort(F.collect_list(F.struct("i", F.coalesce("ref", "source").alias("s"))))["s"], "").alias("statement"))
    return g.where(~F.col("leak")).drop("leak")


def focus_payload(facts: DataFrame, materials: DataFrame, refs: DataFrame) -> DataFrame:
    """By session: facts (statement, references) and material metadata without bodies."""
    f = facts.select("session_id", "id", "statement", F.explode("sources").alias("source")).join(refs, ["session_id", "source"]).groupBy("session_id", "id", "statement").agg(F.array_sort(F.collect_set("ref")).alias("refs"))
    f = f.groupBy("session_id").agg(F.array_sort(F.collect_list(F.struct("id", "statement", "refs"))).alias("facts"))
    m = materials.join(refs, ["session_id", "source"]).groupBy("session_id").agg(F.array_sort(F.collect_list(F.struct("position", "ref", "source_kinds", "roles", "paths"))).alias("materials"))
    return f.join(m, "session_id", "full")


def merge_scopes(members: DataFrame, order: str = "ord") -> DataFrame:
    """(scope members: merged, collection, member, ord, start, end, full) first wins by id; starts and ends widen, full holds only if all are."""
    w = Window.partitionBy("merged", "collection", "member").orderBy(order)
    span = Window.partitionBy("merged", "collection", "member")
    m = members.withColumn("n", F.row_number().over(w)).withColumn("start", F.min("start").over(span)).withColumn("end", F.max("end").over(span)).withColumn("full", F.bool_and(F.coalesce("full", F.lit(False))).over(span))
    return m.where("n = 1").drop("n")


def historical_edges(valid: DataFrame, edges: DataFrame, cutoff: int) -> DataFrame:
    """Every code edge of a version with the points up to the cutoff at which a snapshot shows it.

    valid: session_id, version_id, valid_from, valid_to; edges: session_id, version_id, src, dst, kind. Points are the versions' own orders.
    """
    points = valid.select("session_id", F.col("valid_from").alias("observed_snapshot")).where(F.col("observed_snapshot") <= cutoff).distinct()
    e = edges.join(valid.select("session_id", "version_id", "valid_from", "valid_to"), ["session_id", "version_id"])
    return e.join(points, "session_id").where("valid_from <= observed_snapshot and (valid_to is null or valid_to > observed_snapshot)").select("session_id", "src", "dst", "kind", "observed_snapshot").distinct()


def scope_members(records: DataFrame, versions: DataFrame, ancestry: DataFrame, chosen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of chosen events (session_id, group, ord): versions at their orders with ancestors, and records at or one order beside them."""
    v = versions.join(chosen.withColumnRenamed("ord", "observed_at"), ["session_id", "observed_at"]).select("session_id", "group", "version_id")
    up = v.join(ancestry, ["session_id", "version_id"]).select("session_id", "group", F.col("ancestor").alias("version_id"))
    near = chosen.select("session_id", "group", F.explode(F.array(*(F.col("ord") + d for d in (-1, 0, 1)))).alias("ord")).distinct()
    return v.unionByName(up).distinct(), records.join(near, ["session_id", "ord"]).select("session_id", "group", "id").distinct()


def question_stats(questions: DataFrame, tracks: list[str], statuses: list[str]) -> DataFrame:
    """Counts by track and status, zero where there are none, for every listed track."""
    spark = questions.sparkSession
    all_ = spark.createDataFrame([(t,) for t in tracks], "track string")
    q = questions.groupBy("track").agg(F.count("*").alias("total"), *(F.count_if(F.col("status") == s).alias(s) for s in statuses))
    return all_.join(q, "track", "left").fillna(0)


def rejection_histogram(rejections: DataFrame) -> DataFrame:
    """Counts by reason, or error type, or malformed."""
    return rejections.groupBy(F.coalesce("reason", "error_type", F.lit("malformed")).alias("reason")).agg(F.count("*").alias("n"))


def manifest(**parts: DataFrame) -> DataFrame:
    """One row: each part as an array of its rows, sorted."""
    out = None
    for name, df in parts.items():
        one = df.agg(F.array_sort(F.collect_list(F.struct(*df.columns))).alias(name))
        one = one.withColumn("__k", F.lit(1))
        out = one if out is None else out.join(one, "__k")
    return out.drop("__k")


def plan_cost(groups: DataFrame, per_type: dict[str, int]) -> DataFrame:
    """Upper bounds of model calls by track: the sum of the bound of each group's types, and the groups and types."""
    bound = F.create_map(*(x for k, v in per_type.items() for x in (F.lit(k), F.lit(v))))[F.col("track")]
    g = groups.withColumn("calls", F.size("types") * bound)
    return g.groupBy("track").agg(F.count("*").alias("groups"), F.sum(F.size("types")).alias("targets"), F.sum("calls").alias("max_calls"))


def distinct_targets(items: DataFrame, budget: int) -> DataFrame:
    """At most `budget` items (ord, target): the first of each target first, then others, each in order."""
    own = Window.partitionBy("target").orderBy("ord")
    ranked = items.withColumn("again", (F.row_number().over(own) > 1))
    return ranked.orderBy("again", "ord").limit(budget).drop("again")


def join_qa_inputs(questions: DataFrame, requests: DataFrame, types: list[str]) -> DataFrame:
    """Approved public questions with their saved generation request; a type outside the list is an error, a question without a request goes."""
    ok = questions.withColumn("type", F.when(F.col("type").isin(*types), F.col("type")).otherwise(F.raise_error(F.concat(F.lit("Unsupported type: "), F.coalesce("type", F.lit("none"))))))
    return ok.where("status = 'approved'").join(requests, "id")


def viewer_graph(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """nodes (session_id, id, kind) with the ends of edges (session_id, src, dst) that are not among them, as kind missing; distinct edges."""
    ends = edges.select("session_id", F.explode(F.array("src", "dst")).alias("id")).distinct()
    lost = ends.join(nodes.select("session_id", "id"), ["session_id", "id"], "left_anti").withColumn("kind", F.lit("missing"))
    return nodes.select("session_id", "id", "kind").unionByName(lost), edges.distinct()


def viewer_json(value: Column) -> Column:
    """JSON that can stand in a script element: <, U+2028 and U+2029 are escaped."""
    j = F.replace(F.to_json(value), F.lit("<"), F.lit("\\u003c"))
    for c, code in (("\u2028", "\\u2028"), ("\u2029", "\\u2029")):
        j = F.replace(j, F.lit(c), F.lit(code))
    return j


def phases(points: DataFrame, n: int = 5) -> DataFrame:
    """Each session's orders in n cells of equal width."""
    w = Window.partitionBy("session_id")
    lo, hi = F.min("ord").over(w), F.max("ord").over(w)
    return points.withColumn("phase", F.least(F.lit(n - 1), F.floor((F.col("ord") - lo) * n / (hi - lo + 1))).cast("int"))


def public_reply(events: DataFrame, keys: list[str]) -> DataFrame:
    """The latest finish or agent message."""
    said = events.where((F.col("tool_name") == "finish") | (F.col("kind") == "MessageEvent"))
    return said.groupBy(*keys).agg(F.max_by("content", "seq").alias("reply"))


def files_changed(snapshots: DataFrame) -> DataFrame:
    """Rows whose file map differs from the one before."""
    w = Window.partitionBy("session_id").orderBy("ord")
    return snapshots.withColumn("__b", F.lag("files").over(w)).where(~F.col("files").eqNullSafe(F.col("__b"))).drop("__b")


def artifact_evidence(claims: DataFrame, files: DataFrame) -> DataFrame:
    """claims (id, value /path:a or /path:a-b) with ok: whether the path is a file (path, lines) with those lines."""
    m = lambda g: F.regexp_extract("value", r"^\s*(/[^\s:]+):(\d+)(?:-(\d+))?\s*$", g)
    a = F.try_to_number(m(2), F.lit("9999999999")).cast("long")
    b = F.coalesce(F.try_to_number(F.nullif(m(3), F.lit("")), F.lit("9999999999")).cast("long"), a)
    c = claims.withColumn("path", m(1)).withColumn("a", a).withColumn("b", b).join(files, "path", "left")
    return c.select("id", "value", F.coalesce((F.col("a") >= 1) & (F.col("a") <= F.col("b")) & (F.col("b") <= F.col("lines")), F.lit(False)).alias("ok"))
