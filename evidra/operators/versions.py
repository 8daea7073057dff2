"""Versioned file state: patch replay, validity intervals, as-of graphs, ancestry."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import diff as D

VERSION = "session_id string, version_seq int, version_id string, path string, observed_at int, source string, status string, previous string, content string, sha256 string, reason string"


def _path(path: str, workspace: str | None) -> str:
    path, root = path.replace("\\", "/"), (workspace or "").replace("\\", "/").rstrip("/")
    return path[len(root) + 1 :] if root and path.startswith(root + "/") else path


class Replay:
    """The state of one session's files while its records pass in order."""

    def __init__(self, state: dict | None = None, made: int = 0):
        self.state, self.made = dict(state or {}), made  # path -> (version id, status, content)

    def _put(self, path, status, content, record, previous, reason=None) -> dict:
        self.made += 1
        v = f"v{self.made}"
        self.state[path] = (v, status, content)
        return {"version_seq": self.made, "version_id": v, "path": path, "observed_at": record["ord"], "source": record["id"], "status": status, "previous": previous,
                "content": content, "sha256": None if content is None else hashlib.sha256(content.encode()).hexdigest(), "reason": reason}

    def take(self, record: dict) -> list[dict]:
        """The versions a record installs. An edit that succeeded but cannot be replayed makes its files unknown."""
        root = record.get("workspace")
        if record["kind"] == "observation":
            path, whole = _path(record["path"], root), record.get("complete") is True
            before = self.state.get(path, (None,))[0]
            return [self._put(path, "known" if whole else "unknown", record["content"] if whole else None, record, before, None if whole else "partial_observation")]
        if record["kind"] != "patch" or record.get("success") is not True:
            return []
        out = []
        for raw, change in json.loads(record.get("changes") or "{}").items():
            path = _path(raw, root)
            to = _path(change.get("move_path") or raw, root)
            held, status, content = self.state.get(path, (None, None, None))
            try:
                new = self._edited(change, status, content)
                if new is not None and to != path and self.state.get(to, (None, "deleted"))[1] != "deleted":
                    raise ValueError("Move destination already observed")
            except (ValueError, KeyError, TypeError) as e:
                out.append(self._put(path, "unknown", None, record, held, str(e)))
                if to != path:
                    out.append(self._put(to, "unknown", None, record, self.state.get(to, (None,))[0]))
                continue
            if new is None:
                out.append(self._put(path, "deleted", None, record, held))
            else:
                out.append(self._put(to, "known", new, record, held))
                if to != path:
                    out.append(self._put(path, "deleted", None, record, held))
        return out

    @staticmethod
    def _edited(change: dict, status: str | None, content: str | None) -> str | None:
        match change.get("type"):
            case "delete":
                return None
            case "add":
                if status not in (None, "deleted"):
                    raise ValueError("Add conflicts with observed file")
                return change["content"]
            case "update":
                if status != "known":
                    raise ValueError("Missing complete base")
                return D.apply_diff(content, change["unified_diff"])
        raise ValueError("Unsupported patch operation")


def replay(records: DataFrame) -> DataFrame:
    """Versions of every session's files. records: session_id, id, ord, kind, workspace, path, content, complete, success, changes (JSON).

    The fold depends on order, so a session is one group; its rows stream through in order, and only
    the latest content of each file is held.
    """
    need = ["session_id", "id", "ord", "kind", "workspace", "path", "content", "complete", "success", "changes"]

    rows = records.where(F.col("kind").isin("observation", "patch")).select(*(F.col(c) for c in need))

    def run(batches):
        import pyarrow as pa

        session, state = None, None
        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["session_id"] != session or state is None:
                    session, state = r["session_id"], Replay()
                out += [{"session_id": session} | v for v in state.take(r)]
            yield pa.RecordBatch.from_pylist(out, schema=_ARROW())

    return rows.repartition("session_id").sortWithinPartitions("session_id", "ord").mapInArrow(run, VERSION)


def _ARROW():
    import pyarrow as pa

    kinds = {"string": pa.string(), "int": pa.int32()}
    return pa.schema([(n, kinds[k]) for n, k in (x.strip().split(" ") for x in VERSION.split(","))])


CODE = "struct<status:string,symbols:array<struct<name:string,kind:string,line:int,end_line:int>>,references:array<struct<`from`:string,expression:string,line:int,simple_name:string>>,imports:map<string,struct<module:string,level:int,name:string>>>"


def with_code(versions: DataFrame) -> DataFrame:
    """versions with a code column; each distinct (path, content) is parsed once."""
    @F.pandas_udf(CODE)
    def code(path, content):
        import pandas as pd

        rows = [D.inspect_code(p, c) for p, c in zip(path, content)]
        return pd.DataFrame(rows, columns=["status", "symbols", "references", "imports"])

    known = versions.where("content is not null").select("path", "sha256", "content").dropDuplicates(["path", "sha256"])
    return versions.join(known.select("path", "sha256", code("path", "content").alias("code")), ["path", "sha256"], "left")


def intervals(versions: DataFrame, order: str = "version_seq") -> DataFrame:
    """versions with valid_from and valid_to (exclusive, null while current); intervals of no length are left out."""
    w = Window.partitionBy("session_id", "path").orderBy(order)
    return versions.withColumn("valid_from", F.col("observed_at")).withColumn("valid_to", F.lead("observed_at").over(w)).where("valid_to is null or valid_to > valid_from")


def as_of(valid: DataFrame, cutoff) -> DataFrame:
    """The versions that hold at the cutoff."""
    c = F.lit(cutoff) if isinstance(cutoff, int) else cutoff
    return valid.where((F.col("valid_from") <= c) & (F.col("valid_to").isNull() | (F.col("valid_to") > c)))


def as_of_join(points: DataFrame, versions: DataFrame, keys: list[str], at: str, order: str) -> DataFrame:
    """points with the latest version (struct) whose order is not after theirs.

    Points and versions are merged into one sorted run per key and the last version is carried
    forward: one shuffle, no range join, whatever the number of versions.
    """
    v = versions.select(*keys, F.col(order).alias("__at"), F.struct(*[c for c in versions.columns if c not in keys]).alias("version"))
    p = points.select(*keys, F.col(at).alias("__at"), F.struct(*points.columns).alias("__point"))
    both = v.withColumn("__point", F.lit(None).cast(p.schema["__point"].dataType)).unionByName(p.withColumn("version", F.lit(None).cast(v.schema["version"].dataType)))
    w = Window.partitionBy(*keys).orderBy("__at", F.col("__point").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("version", F.last("version", True).over(w)).where("__point is not null").select("__point.*", "version")


OWN_ANCESTOR = "a version is its own ancestor"


def ancestry(versions: DataFrame, scratch) -> DataFrame:
    """(session_id, version_id, ancestor, distance) over previous, to the first version.

    A session's versions meet in one task, which walks up from each and passes on what it finds: the input is
    shuffled once, the result written once. A version that is its own ancestor is an error.
    """
    step = versions.where("previous is not null").select("session_id", "version_id", "previous")
    shape = step.select("session_id", "version_id", F.col("previous").alias("ancestor"), F.lit(1).alias("distance")).schema

    def run(batches):
        import pyarrow as pa

        def walk(session, rows):
            up = {}
            for v, p in rows:
                up.setdefault(v, []).append(p)
            if session is None:  # joins nothing
                up = {}
            for v, p in rows:
                ways = [(p, 1)]
                while ways:
                    at, d = ways.pop()
                    yield session, v, at, d
                    more = up.get(at, ())
                    if more and d >= len(up):
                        raise ValueError(OWN_ANCESTOR)
                    ways += [(x, d + 1) for x in more]

        def sessions():
            session, rows = None, []
            for b in batches:
                for s, v, p in zip(*(c.to_pylist() for c in b.columns)):
                    if rows and s != session:
                        yield session, rows
                        rows = []
                    session = s
                    rows.append((v, p))
            if rows:
                yield session, rows

        names, out = ["session_id", "version_id", "ancestor", "distance"], ([], [], [], [])
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(shape)
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(x, kinds.field(n).type) for x, n in zip(out, names)], names)
        for session, rows in sessions():
            for row in walk(session, rows):
                for to, x in zip(out, row):
                    to.append(x)
                if len(out[0]) >= 50_000:
                    yield batch()
                    out = ([], [], [], [])
        if out[0]:
            yield batch()

    try:
        return scratch.save(step.repartition("session_id").sortWithinPartitions("session_id").mapInArrow(run, shape), "ancestry")
    except Exception as e:
        if OWN_ANCESTOR in str(e):
            raise ValueError(OWN_ANCESTOR) from None
        raise


def pair_calls(records: DataFrame) -> DataFrame:
    """Results with call_source (their call, if exactly one call of the id came before) and a reason if there is none."""
    w = Window.partitionBy("session_id", "call_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    is_call = F.col("kind") == "call"
    seen = records.where(F.col("kind").isin("call", "result")).withColumn("calls", F.count_if(is_call).over(w)).withColumn("call", F.last(F.when(is_call, F.col("id")), True).over(w))
    ok = F.col("call_id").isNotNull() & (F.col("calls") == 1)
    return seen.where("kind = 'result'").withColumn("call_source", F.when(ok, F.col("call"))).withColumn("reason", F.when(~ok, "unmatched_result")).drop("calls", "call")


def code_graph(valid: DataFrame, cutoff) -> tuple[DataFrame, DataFrame, DataFrame]:
    """nodes, edges and unresolved references of the files known at the cutoff. valid: intervals with code."""
    files = as_of(valid, cutoff).where("status = 'known'")
    sym = files.select("session_id", "path", "version_id", "source", F.explode("code.symbols").alias("s"))
    node = F.concat_ws("::", "path", "s.name")
    nodes = files.select("session_id", F.col("path").alias("node"), F.lit("file").alias("kind"), "version_id").unionByName(sym.select("session_id", node.alias("node"), "s.kind", "version_id"))
    contains = sym.select("session_id", F.col("path").alias("src"), node.alias("dst"), F.lit("contains").alias("kind"), "source").distinct()
    refs = files.select("session_id", "path", "source", "code.imports", F.explode("code.references").alias("r"))
    got = F.try_element_at("imports", F.col("r.simple_name"))
    up = F.concat_ws("/", F.slice(F.split("path", "/"), F.lit(1), F.greatest(F.size(F.split("path", "/")) - got["level"], F.lit(0))))
    module = F.concat(F.when(up == "", "").otherwise(F.concat(up, F.lit("/"))), F.replace(got["module"], F.lit("."), F.lit("/")), F.lit(".py"))
    target = F.when(got["level"] > 0, F.concat_ws("::", module, got["name"])).otherwise(F.concat_ws("::", "path", "r.simple_name"))
    refs = refs.select("session_id", "source", F.when(F.col("r.from") == "<module>", F.col("path")).otherwise(F.concat_ws("::", "path", "r.from")).alias("src"), F.when(F.col("r.simple_name").isNotNull(), target).alias("dst"), "r.expression")
    known = nodes.select("session_id", F.col("node").alias("dst")).distinct()
    calls = refs.join(known, ["session_id", "dst"], "left_semi").select("session_id", "src", "dst", F.lit("call_reference").alias("kind"), "source")
    lost = refs.join(known, ["session_id", "dst"], "left_anti").select("session_id", "src", "expression", "source")
    return nodes, contains.unionByName(calls), lost
