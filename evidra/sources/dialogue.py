"""Readers of recorded dialogues. Each gives the record table; a session is a file unless a column says otherwise.

Schemas are given, never inferred. Rows that break a reader's contract raise when they are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import diff as D
from ..functions import text as X

CHANGE = "struct<type:string,content:string,unified_diff:string,move_path:string>"
ITEM = f"kind string, role string, text string, content string, call_id string, name string, path string, complete boolean, success boolean, is_error boolean, workspace string, source_kind string, timestamp string, changes map<string,{CHANGE}>"
RECORD = ("session_id", "id", "ord", "kind", "source_kind", "role", "call_id", "name", "text", "path", "content", "complete", "success", "is_error", "changes", "workspace", "timestamp", "original_id")
EDITS = ("str_replace", "create", "insert", "undo_edit")


def _records(df: DataFrame) -> DataFrame:
    """The record columns in order; what a source lacks is null, ids are e1, e2, ... by order."""
    df = df.withColumn("id", F.concat(F.lit("e"), F.col("ord").cast("string")))
    kinds = {"ord": "int", "complete": "boolean", "success": "boolean", "is_error": "boolean", "changes": "string"}
    return df.select(*((F.col(c) if c in df.columns else F.lit(None)).cast(kinds.get(c, "string")).alias(c) for c in RECORD if c != "source_kind"), X.source_kind(F.col("kind"), F.col("source_kind") if "source_kind" in df.columns else F.lit(None).cast("string")).alias("source_kind"))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("session_id"), F.col("value").alias("doc"))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """session_id, line (from 1, blank lines counted) and value of JSON lines files: a file is read whole, then split."""
    w = _files(spark, path).select("session_id", F.posexplode(F.split("doc", "\n")).alias("at", "value"))
    return w.where(F.btrim("value") != "").select("session_id", (F.col("at") + 1).alias("line"), "value")


def unified(spark: SparkSession, path: str) -> DataFrame:
    """Version 1 documents: {version, workspace, records}."""
    d = _files(spark, path).withColumn("d", F.from_json("doc", f"version int, workspace string, records array<struct<{ITEM.replace(', ', ',').replace(' ', ':')}>>"))
    ok = (F.col("d.version") == 1) & F.col("d.records").isNotNull()
    d = d.select("session_id", F.when(ok, F.col("d")).otherwise(F.raise_error(F.lit("Unsupported dialogue document"))).alias("d"))
    kind = F.when(F.col("kind").isin("message", "call", "result", "observation", "patch"), F.col("kind")).otherwise(F.raise_error(F.lit("Unsupported record kind")))
    r = d.select("session_id", F.col("d.workspace").alias("root"), F.posexplode("d.records").alias("at", "r")).select("session_id", "root", (F.col("at") + 1).alias("ord"), "r.*").withColumn("workspace", F.coalesce("workspace", "root")).withColumn("kind", kind).withColumn("changes", F.to_json("changes"))
    return _records(r)


def messages(spark: SparkSession, path: str) -> DataFrame:
    """A list of {role, content}."""
    d = _files(spark, path).select("session_id", F.posexplode(F.from_json("doc", "array<struct<role:string,content:string>>")).alias("at", "m"))
    role = F.when(F.col("m.role").isin("user", "assistant"), F.col("m.role")).otherwise(F.raise_error(F.lit("Unsupported message role")))
    return _records(d.select("session_id", (F.col("at") + 1).alias("ord"), F.lit("message").alias("kind"), role.alias("role"), F.col("m.content").alias("text")))


def flat_text(v: Column) -> Column:
    """A string, or a list of parts with text joined by line feeds, from a VARIANT."""
    whole = F.try_variant_get(v, "$", "string")
    parts = F.try_variant_get(v, "$", "array<variant>")
    return F.when(F.schema_of_variant(v).startswith("ARRAY"), F.array_join(F.transform(parts, lambda p: F.coalesce(F.try_variant_get(p, "$.text", "string"), F.lit(""))), "\n")).otherwise(whole)


def codex(lines: DataFrame) -> DataFrame:
    """Rollout lines (session_id, line, value): the latest cwd is carried forward as workspace, kept rows are numbered anew."""
    g = lambda p, t="string": F.try_variant_get("v", p, t)
    r = lines.withColumn("v", F.parse_json("value")).withColumn("type", g("$.type")).withColumn("what", g("$.payload.type"))
    w = Window.partitionBy("session_id").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    r = r.withColumn("workspace", F.last(F.when(F.col("type").isin("session_meta", "turn_context"), g("$.payload.cwd")), True).over(w))
    item = F.col("type") == "response_item"
    kind = (F.when(item & (F.col("what") == "message") & g("$.payload.role").isin("user", "assistant"), "message").when(item & F.col("what").isin("function_call", "custom_tool_call"), "call")
            .when(item & F.col("what").isin("function_call_output", "custom_tool_call_output"), "result").when((F.col("type") == "event_msg") & (F.col("what") == "patch_apply_end"), "patch"))
    r = r.withColumn("kind", kind).where("kind is not null")
    v = lambda p: F.try_variant_get("v", p, "variant")
    text = F.when(F.col("kind") == "message", flat_text(v("$.payload.content"))).when(F.col("kind") == "call", F.coalesce(g("$.payload.arguments"), g("$.payload.input"), F.lit(""))).when(F.col("kind") == "result", flat_text(v("$.payload.output")))
    r = r.withColumn("ord", F.row_number().over(Window.partitionBy("session_id").orderBy("line")))
    return _records(r.select("session_id", "ord", "kind", "workspace", text.alias("text"), g("$.payload.role").alias("role"), g("$.payload.call_id").alias("call_id"), g("$.payload.name").alias("name"), g("$.timestamp").alias("timestamp"), F.when(F.col("kind") == "patch", F.coalesce(g("$.payload.success", "boolean"), F.lit(False))).alias("success"), F.when(F.col("kind") == "patch", F.to_json(v("$.payload.changes"))).alias("changes"), F.coalesce(g("$.payload.source_kind"), g("$.payload.metadata.source_kind")).alias("source_kind")))


OBSERVED = "struct<command:string,path:string,is_error:boolean,prev_exist:boolean,old_content:string,new_content:string>"


def openhands(lines: DataFrame, visible_schema: str = "model-visible-dialogue-v1") -> DataFrame:
    """Rows of user, assistant, tool_call and tool_result. A successful whole-file edit also gives its state before (observation) and a patch.

    Rows of the visible schema must be dense, unique and matched; no versions are rebuilt from them.
    """
    shape = f"id string, schema string, sequence int, kind string, call_id string, tool_name string, timestamp string, text string, is_error boolean, action struct<command:string,path:string>, observation {OBSERVED}"
    r = lines.select("session_id", "line", F.from_json("value", shape).alias("r"), F.col("value")).select("session_id", "line", "value", "r.*")
    calls = r.where("kind = 'tool_call'").groupBy("session_id", "call_id").agg(F.max_by(F.struct("line", "tool_name", "action"), "line").alias("call"), F.count("*").alias("calls"))
    w = Window.partitionBy("session_id").orderBy("line")
    j = r.join(calls, ["session_id", "call_id"], "left").withColumn("nth", F.row_number().over(w)).withColumn("first", F.row_number().over(Window.partitionBy("session_id", "id").orderBy("line")))
    visible = F.coalesce(F.col("schema") == visible_schema, F.lit(False))
    message, call, result = F.col("kind").isin("user", "assistant"), F.col("kind") == "tool_call", F.col("kind") == "tool_result"
    fault = (F.when(~F.coalesce(message | call | result, F.lit(False)), "Unsupported record").when(F.col("schema").isNotNull() & ~visible, "Mixed or unsupported dialogue schema")
             .when(visible & (~F.coalesce(F.col("sequence") == F.col("nth"), F.lit(False)) | (F.coalesce("id", F.lit("")) == "") | (F.col("first") > 1)), "Invalid public event identity or sequence")
             .when(visible & message & F.col("text").isNull(), "Public message requires actual text").when(visible & call & (F.col("call_id").isNull() | (F.col("calls") > 1)), "Missing or repeated public call ID")
             .when(visible & result & (F.col("text").isNull() | F.col("call").isNull() | (F.col("call.line") > F.col("line")) | ~F.col("call.tool_name").eqNullSafe(F.col("tool_name"))), "Unmatched public tool result or missing text"))
    j = j.withColumn("kind", F.when(fault.isNotNull(), F.raise_error(fault)).otherwise(F.col("kind")))
    o = F.col("observation")
    whole = lambda c: c.isNotNull() & ~c.rlike(X.TRUNCATED)
    edit = ~visible & result & (F.col("tool_name") == "file_editor") & (F.col("call.tool_name") == "file_editor") & o["command"].isin(*EDITS) & (o["command"] == F.col("call.action.command")) & (o["path"] == F.col("call.action.path")) & (o["path"] != "") & (o["is_error"] == F.lit(False)) & whole(o["new_content"])
    before, fresh_file = whole(o["old_content"]), F.coalesce(~o["prev_exist"], F.lit(False))

    @F.pandas_udf("string")
    def diff(a, b):
        import pandas as pd

        return pd.Series([D.make_diff(x or "", y or "") for x, y in zip(a, b)])

    change = F.when(fresh_file, F.to_json(F.create_map(o["path"], F.struct(F.lit("add").alias("type"), o["new_content"].alias("content"))))).otherwise(F.to_json(F.create_map(o["path"], F.struct(F.lit("update").alias("type"), diff(o["old_content"], o["new_content"]).alias("unified_diff")))))
    edit = F.coalesce(edit, F.lit(False))
    none = F.lit(None).cast("string")
    part = lambda kind, content, changes, suffix: F.struct(kind.alias("kind"), content.alias("content"), changes.alias("changes"), F.lit(suffix).alias("suffix"))
    base = part(F.when(message, F.lit("message")).when(call, F.lit("call")).otherwise(F.lit("result")), none, none, "")
    parts = F.array_compact(F.array(base, F.when(edit & before, part(F.lit("observation"), o["old_content"], none, ":before")), F.when(edit & ~before & ~fresh_file, part(F.lit("observation"), o["new_content"], none, ":after")), F.when(edit & (before | fresh_file), part(F.lit("patch"), none, change, ":after"))))
    said = F.when(visible | message, F.col("text")).when(call, F.to_json("action")).when(edit & before, F.to_json(o.dropFields("new_content", "old_content"))).when(edit, F.to_json(o.dropFields("new_content"))).otherwise(F.to_json(o))
    e = j.select("session_id", "line", "id", "call_id", "tool_name", "timestamp", said.alias("said"), o["path"].alias("at"), F.when(message, F.col("kind")).alias("role"), "is_error", F.posexplode(parts).alias("i", "p"))
    e = e.withColumn("ord", F.row_number().over(Window.partitionBy("session_id").orderBy("line", "i")))
    own = F.col("i") == 0
    return _records(e.select("session_id", "ord", "p.kind", "role", F.when(own | (F.col("p.kind") == "patch"), F.col("call_id")).alias("call_id"), F.when(own, F.col("tool_name")).alias("name"), F.when(own, F.col("said")).alias("text"), F.when(F.col("p.kind") == "observation", F.col("at")).alias("path"), "p.content", F.when(F.col("p.kind") == "observation", True).alias("complete"), F.when(F.col("p.kind") == "patch", True).alias("success"), F.when(own, F.col("is_error")).alias("is_error"), "p.changes", F.lit("/workspace/candidate").alias("workspace"), "timestamp", F.concat(F.coalesce("id", F.col("line").cast("string")), F.col("p.suffix")).alias("original_id")))


def read_dialogue(spark: SparkSession, path: str) -> DataFrame:
    """The reader the input's shape asks for: JSON lines by their first row's kind, else unified or message list."""
    if path.endswith(".jsonl"):
        lines = _lines(spark, path)
        head = lines.orderBy("line").select(F.from_json("value", "kind string").alias("r")).limit(1).head()
        return openhands(lines) if head and head.r.kind else codex(lines)
    head = spark.read.text(path, wholetext=True).select(F.btrim(F.substring("value", 1, 100)).startswith("[")).limit(1).head()
    return messages(spark, path) if head and head[0] else unified(spark, path)


def cutoff(records: DataFrame, at: int) -> DataFrame:
    """Records up to the cutoff, which must lie within each session's orders."""
    w = Window.partitionBy("session_id")
    ok = F.lit(at).between(1, F.max("ord").over(w))
    return records.withColumn("ord", F.when(ok, F.col("ord")).otherwise(F.raise_error(F.lit("Cutoff out of range")))).where(F.col("ord") <= at)


def seed_events(records: DataFrame, event: str) -> DataFrame:
    return records.where(F.coalesce("original_id", "id") == event)


def seed_objects(records: DataFrame, wanted: str) -> DataFrame:
    """Records that name every part of path::symbol as a whole word."""
    hay = F.concat_ws("\n", F.coalesce("text", F.lit("")), F.coalesce("path", F.lit("")))
    out = records
    for token in [t for t in wanted.split("::", 1) if t]:
        import re

        quoted = "".join("\\" + c if re.match(r"[^A-Za-z0-9_\s]", c) else c for c in token)
        out = out.where(hay.contains(token) & hay.rlike(f"(?<![A-Za-z0-9_]){quoted}(?![A-Za-z0-9_])"))
    return out


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations table as records: order is the turn plus 1, all rows are messages."""
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return c.select(F.col("conv_id").alias("session_id"), F.concat(F.lit("e"), (F.col("turn") + 1).cast("string")).alias("id"), (F.col("turn") + 1).cast("int").alias("ord"), F.lit("message").alias("kind"), F.lit("conversation").alias("source_kind"), "role", F.lit(None).cast("string").alias("call_id"), F.col("text"))
