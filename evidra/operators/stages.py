"""Stages of a dialogue, forward fill, object index and relations across stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X

GAP, CUE = 180, 2


def identify_stages(records: DataFrame, gap: int = GAP) -> DataFrame:
    """Visible messages (session_id, id, ord, role, text) with tokens and stage, from 1.

    A stage starts at the first message, or at a user's that comes `gap` orders after the message
    before it, or has a topic marker and two words new since the user's last one, or five new words
    and none in common. One sort by session serves all windows.
    """
    seen = records.where((F.col("kind") == "message") & F.col("role").isin("user", "assistant")).withColumn("tokens", X.tokens(F.col("text")))
    w = Window.partitionBy("session_id").orderBy("ord")
    last = F.last(F.when(F.col("role") == "user", F.col("tokens")), True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    seen = seen.withColumn("before", F.coalesce(last, F.array().cast("array<string>"))).withColumn("gap", F.col("ord") - F.lag("ord").over(w))
    new, shared = F.size(F.array_except("tokens", "before")), F.size(F.array_intersect("tokens", "before"))
    topic = F.coalesce(F.col("text").rlike(X.TOPIC), F.lit(False))
    starts = F.col("gap").isNull() | ((F.col("role") == "user") & ((F.col("gap") >= gap) | (topic & (new >= CUE)) | ((new >= 5) & (shared == 0))))
    return seen.withColumn("stage", F.sum(starts.cast("int")).over(w)).drop("before", "gap")


def stage_rollup(staged: DataFrame) -> DataFrame:
    return staged.groupBy("session_id", "stage").agg(
        F.min("ord").alias("start_order"), F.max("ord").alias("end_order"), F.count("*").alias("messages"), F.count_if(F.col("role") == "user").alias("user_messages"),
        F.min_by(F.substring(F.coalesce("text", F.lit("")), 1, 80), "ord").alias("label"))


def fill_stages(records: DataFrame, staged: DataFrame) -> DataFrame:
    """Every record with a stage: a message's own, a result that of its call (the last of its id), else that of the last message."""
    own = records.join(staged.select("session_id", "id", F.col("stage").alias("own")), ["session_id", "id"], "left")
    w = Window.partitionBy("session_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    now = own.withColumn("now", F.last("own", True).over(w))
    calls = now.where("kind = 'call' and call_id is not null").groupBy("session_id", "call_id").agg(F.max_by("now", "ord").alias("of_call"))
    return now.join(calls, ["session_id", "call_id"], "left").withColumn("stage", F.when(F.col("kind") == "result", F.coalesce("of_call", "now")).otherwise(F.col("now"))).drop("own", "now", "of_call")


def stage_of_order(points: DataFrame, stages: DataFrame) -> DataFrame:
    """points (session_id, ord) with the last stage that holds the order, else the last that began before it, else the first."""
    s = stages.select("session_id", "stage", "start_order", "end_order")
    j = points.join(s, "session_id", "left").groupBy(*points.columns).agg(
        F.max(F.when((F.col("start_order") <= F.col("ord")) & (F.col("ord") <= F.col("end_order")), F.col("stage"))).alias("holds"),
        F.max(F.when(F.col("start_order") <= F.col("ord"), F.col("stage"))).alias("before"), F.min("stage").alias("first"))
    return j.select(*points.columns, F.coalesce("holds", "before", "first").alias("stage"))


def message_objects(text: Column) -> Column:
    """Files, symbols and tokens that are not weak."""
    weak = X.WEAK_OBJECTS
    return F.array_distinct(F.concat(X.found(text, X.FILE), X.found(text, X.SYMBOL), F.filter(X.tokens(text), lambda t: ~t.isin(*weak))))


def discussion_edges(staged: DataFrame, cue: str | None = None, objects: Column | None = None) -> DataFrame:
    """Pairs of messages of different stages that share an object, the later with a cue.

    Exploded objects meet in an equi-join; only messages with a cue are on the later side, and no
    pair of lists is ever compared.
    """
    obj = staged.select("session_id", "id", "ord", "stage", "text", F.explode(objects if objects is not None else message_objects(F.col("text"))).alias("object"))
    cued = F.col("text").rlike(cue) if cue else F.col("text").rlike(X.RELATION_CUE) | F.col("text").rlike(X.REFERENCE_CUE)
    a = obj.select("session_id", "object", F.col("id").alias("src"), F.col("ord").alias("a"), F.col("stage").alias("stage_from"))
    b = obj.where(cued).select("session_id", "object", F.col("id").alias("dst"), F.col("ord").alias("b"), F.col("stage").alias("stage_to"), F.when(F.col("text").rlike(X.FEEDBACK_CUE), "feedback").otherwise("revision").alias("relation"))
    return a.join(b, ["session_id", "object"]).where("b > a and stage_from <> stage_to").select("session_id", "src", "dst", "stage_from", "stage_to", "relation").distinct()


def object_index(staged: DataFrame, versions: DataFrame | None = None) -> DataFrame:
    """A row per object: its kind, aliases and the messages, events, versions and stages it occurs in."""
    t = F.col("text")
    kind = lambda o: F.when(o.rlike(r"(?i)\.(?:py|js|mjs|ts|tsx|jsx|json|yaml|yml)$"), "file").otherwise("symbol")
    named = F.transform(F.array_distinct(F.concat(X.found(t, X.FILE), X.found(t, X.SYMBOL))), lambda o: F.struct(o.alias("name"), kind(o).alias("kind"), F.lit(1).alias("rank")))
    cued = F.transform(F.filter(X.tokens(t), lambda o: (F.length(o) >= 3) & ~o.isin("user", "assistant", "需要", "可以")), lambda o: F.struct(o.alias("name"), F.lit("conversation_object").alias("kind"), F.lit(2).alias("rank")))
    rows = staged.select("session_id", F.col("id").alias("message"), F.lit(None).cast("string").alias("event"), F.lit(None).cast("string").alias("version"), "ord", "stage", F.explode(F.concat(named, F.when(t.rlike(X.RELATION_CUE), cued).otherwise(F.array().cast("array<struct<name:string,kind:string,rank:int>>")))).alias("o"))
    rows = rows.select("session_id", "message", "event", "version", F.col("ord").cast("long").alias("ord"), F.col("stage").cast("long").alias("stage"), "o.name", "o.kind", "o.rank")
    if versions is not None:
        rows = rows.unionByName(versions.select("session_id", F.lit(None).cast("string").alias("message"), F.col("source").alias("event"), F.col("version_id").alias("version"), F.col("observed_at").cast("long").alias("ord"), F.lit(None).cast("long").alias("stage"), F.col("path").alias("name"), F.lit("file").alias("kind"), F.lit(0).alias("rank")))
    key = F.lower(F.translate("name", "\\", "/"))
    sets = {c: F.array_sort(F.collect_set(c)) for c in ("message", "event", "version", "stage")}
    aliases = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(F.col("kind") == "file", F.array("name", F.substring_index("name", "/", -1))).otherwise(F.array("name"))))))
    return rows.groupBy("session_id", key.alias("object_id")).agg(F.min_by("kind", F.struct("rank", "ord", "name")).alias("object_kind"), aliases.alias("aliases"), *(v.alias(f"{c}_ids") for c, v in sets.items()))
