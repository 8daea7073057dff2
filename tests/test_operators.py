import json
from collections import Counter

from pyspark.sql import functions as F

from evidra.operators import chunks, evidence, graph, joins, metrics, review, selection, stages, versions
from evidra.scratch import Scratch
from evidra.sources import artifacts, dialogue
from evidra.streaming import replay as streaming

REC = "session_id string, id string, ord int, kind string, workspace string, path string, content string, complete boolean, success boolean, changes string"


def records(spark):
    ch = lambda **k: json.dumps(k)
    rows = [
        ("s", "e1", 1, "observation", "/w", "/w/a.py", "def f():\n    pass\n", True, None, None),
        ("s", "e2", 2, "patch", None, None, None, None, True, ch(**{"a.py": {"type": "update", "unified_diff": "@@ -2 +2 @@\n-    pass\n+    return 1\n"}, "b.py": {"type": "add", "content": "from .a import f\nf()\n"}})),
        ("s", "e3", 3, "patch", None, None, None, None, False, ch(**{"a.py": {"type": "delete"}})),
        ("s", "e4", 4, "patch", None, None, None, None, True, ch(**{"a.py": {"type": "update", "unified_diff": "@@ -1,0 +2 @@\n+x = 1\n", "move_path": "c.py"}})),
        ("s", "e5", 5, "patch", None, None, None, None, True, ch(**{"b.py": {"type": "update", "unified_diff": "broken"}})),
        ("t", "e1", 1, "observation", None, "z", "half", False, None, None),
        ("t", "e2", 2, "patch", None, None, None, None, True, ch(z={"type": "delete"})),
        ("t", "e3", 3, "patch", None, None, None, None, True, ch(z={"type": "add", "content": "new"})),
    ]
    return spark.createDataFrame(rows, REC)


def test_replay_intervals_and_code_graph(spark):
    v = versions.replay(records(spark)).cache()
    got = {(r.session_id, r.version_seq): (r.path, r.status, r.previous, r.reason) for r in v.collect()}
    assert got == {
        ("s", 1): ("a.py", "known", None, None), ("s", 2): ("a.py", "known", "v1", None), ("s", 3): ("b.py", "known", None, None), ("s", 4): ("c.py", "known", "v2", None), ("s", 5): ("a.py", "deleted", "v2", None),
        ("s", 6): ("b.py", "unknown", "v3", "Unsupported diff header"), ("t", 1): ("z", "unknown", None, "partial_observation"), ("t", 2): ("z", "deleted", "v1", None), ("t", 3): ("z", "known", "v2", None)}
    valid = versions.intervals(versions.with_code(v))
    assert {(r.path, r.version_id) for r in versions.as_of(valid, 2).where("session_id = 's'").collect()} == {("a.py", "v2"), ("b.py", "v3")}
    nodes, edges, lost = versions.code_graph(valid, 2)
    assert {(r.src, r.dst, r.kind) for r in edges.where("session_id = 's'").collect()} == {("a.py", "a.py::f", "contains"), ("b.py", "a.py::f", "call_reference")}
    assert lost.where("session_id = 's'").count() == 0 and nodes.where("session_id = 's'").count() == 3
    anc = versions.ancestry(v, Scratch(spark))
    assert {(r.version_id, r.ancestor, r.distance) for r in anc.where("session_id = 's'").collect()} == {("v2", "v1", 1), ("v4", "v2", 1), ("v5", "v2", 1), ("v4", "v1", 2), ("v5", "v1", 2), ("v6", "v3", 1)}


def test_replay_stream_equals_batch(spark, tmp_path):
    rec = records(spark)
    for i in (1, 2, 3, 4, 5):
        rec.where(f"ord = {i}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    got = streaming.replay_stream(spark.readStream.schema(rec.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")))
    q = got.writeStream.format("memory").queryName("versions_out").option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").start()
    try:
        q.processAllAvailable()
        a = Counter(tuple(r) for r in spark.table("versions_out").collect())
    finally:
        q.stop()
    assert a == Counter(tuple(r) for r in versions.replay(rec).collect())


def test_call_pairing(spark):
    rows = [("s", "e1", 1, "call", "a"), ("s", "e2", 2, "result", "a"), ("s", "e3", 3, "call", "a"), ("s", "e4", 4, "result", "a"), ("s", "e5", 5, "result", "x"), ("s", "e6", 6, "result", None)]
    got = versions.pair_calls(spark.createDataFrame(rows, "session_id string, id string, ord int, kind string, call_id string")).collect()
    assert {r.id: r.call_source for r in got} == {"e2": "e1", "e4": None, "e5": None, "e6": None}


def test_stage_boundaries(spark):
    rows = [("s", "e1", 1, "message", "user", "alpha beta gamma delta epsilon"), ("s", "e2", 2, "message", "assistant", "one two three four five six"), ("s", "e3", 3, "message", "user", "alpha beta"), ("s", "e4", 4, "message", "user", "kilo lima mike november oscar"), ("s", "e5", 5, "message", "user", "kilo 现在修改 papa quebec"), ("s", "e6", 400, "message", "user", "kilo"), ("s", "e7", 401, "message", "system", "x")]
    r = spark.createDataFrame(rows, "session_id string, id string, ord int, kind string, role string, text string")
    s = stages.identify_stages(r)
    assert {x.id: x.stage for x in s.collect()} == {"e1": 1, "e2": 1, "e3": 1, "e4": 2, "e5": 3, "e6": 4}
    assert stages.stage_rollup(s).count() == 4
    filled = stages.fill_stages(r.withColumn("call_id", F.lit(None).cast("string")), s)
    assert {x.id: x.stage for x in filled.collect()}["e7"] == 4


def test_discussion_edges_and_plan(spark):
    rows = [("s", "e1", 1, "use build.py here", 1), ("s", "e2", 2, "现在修改 build.py", 2), ("s", "e3", 3, "build.py 反馈不对", 3), ("s", "e4", 4, "build.py again", 3)]
    s = spark.createDataFrame(rows, "session_id string, id string, ord int, text string, stage long")
    e = stages.discussion_edges(s)
    assert {(x.src, x.dst, x.relation) for x in e.collect()} == {("e1", "e2", "revision"), ("e1", "e3", "feedback"), ("e2", "e3", "feedback")}
    plan = e._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan


def test_joins_have_equi_keys(spark):
    a = spark.range(50).select((F.col("id") % 3).alias("s"), F.col("id").alias("ord"))
    j = joins.band_join(a, a, ["s"], "ord", 6)
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    want = Counter((x % 3, x, y) for x in range(50) for y in range(50) if x % 3 == y % 3 and abs(x - y) <= 6)
    assert Counter(tuple(r) for r in j.select("s", "l_ord", "r_ord").collect()) == want


def test_spread_places(spark):
    for n, k in ((10, 4), (7, 7), (8, 1), (33, 5), (100, 32)):
        got = sorted(r.i for r in joins.spread(spark.range(n).select(F.lit(0).alias("s"), F.col("id").alias("i")), ["s"], ["i"], k).collect())
        assert got == (list(range(n)) if n <= k else [0] if k == 1 else sorted({round(j * (n - 1) / (k - 1)) for j in range(k)})), (n, k)


def test_distances_and_difficulty(spark):
    e = spark.createDataFrame([(0, "v1", "e1", 0), (0, "v1", "v2", 1), (0, "v2", "v3", 1), (0, "v3", "v4", 1), (0, "x", "y", 1)], "session_id int, src string, dst string, weight int")
    d = graph.distances(e, spark.createDataFrame([(0, "e1")], "session_id int, node string"))
    assert {(r.node, r.distance) for r in d.collect()} == {("e1", 0), ("v1", 0), ("v2", 1), ("v3", 2), ("v4", 3)}
    need = spark.createDataFrame([(0, "q1", "e1", "v2"), (0, "q2", "e1", "v2"), (0, "q2", "e1", "v4"), (0, "q3", "e1", "y")], "session_id int, item string, start string, node string")
    assert {(r.item, r.max_distance, r.difficulty) for r in graph.difficulty(need, d).collect()} == {("q1", 1, "easy"), ("q2", 3, "hard"), ("q3", None, "unknown")}


def test_khop_adaptive_stops_at_the_budget(spark):
    e = spark.createDataFrame([(0, f"n{i}", f"n{i + 1}") for i in range(6)], "session_id int, src string, dst string")
    size = spark.createDataFrame([(f"n{i}", 10) for i in range(7)], "node string, size int")
    kept, log = graph.khop_adaptive(e, spark.createDataFrame([(0, "n0")], "session_id int, node string"), size, 1, 4, 30)
    assert {r.node for r in kept.collect()} == {"n0", "n1", "n2"} and log[-1]["over_budget"]


def test_chunks_and_fragments(spark):
    r = spark.createDataFrame([("s", f"e{i}", i, s) for i, s in enumerate([5, 5, 5, 50, 3, 3], 1)], "session_id string, id string, ord int, size int")
    got = chunks.pack_chunks(r, 20, 1).orderBy("chunk_index").collect()
    assert [x.record_ids for x in got] == [["e1", "e2", "e3"], ["e3"], ["e4"], ["e5", "e6"]] or all(x.size <= 20 or len(x.record_ids) == 1 for x in got)
    assert {i for x in got for i in x.record_ids} == {f"e{i}" for i in range(1, 7)} and [x.over_budget for x in got if x.record_ids == ["e4"]] == [True]
    text = "".join(f"line {i}\n" for i in range(50)) + "x" * 300
    f = chunks.fragments(spark.createDataFrame([("r1", text), ("r2", "short"), ("r3", None)], "id string, text string"), 100)
    rows = sorted(f.where("parent_id = 'r1'").collect(), key=lambda x: x.fragment["index"])
    assert "".join(x.text for x in rows) == text and all(len(x.text) <= 100 for x in rows[:-1]) and f.where("parent_id is null").count() == 2


def test_parsed_responses(spark):
    p = review.parse_response
    assert p("NO_FACTS")["verdict"] == "no_facts" and p("NO_QA")["verdict"] == "no_qa"
    assert p("NO_QA\nMISSING_KIND: reason\nMISSING_OBJECT: a.py")["missing_object"] == "a.py" and p("NO_QA\nMISSING_KIND: other\nMISSING_OBJECT: x")["error"]
    assert p("FACT f1\nTEXT: x")["error"] == "Unclosed FACT block" and p("hi")["error"] == "No tagged model blocks found" and p(None)["error"]
    b = p("QA q1\nQUESTION: why?\nFACT_IDS: f1, f2\nANSWER_POINT: because || SOURCES: e1,e2\nFORBIDDEN_POINT: none\nFORBIDDEN_POINT: no || SOURCES: e3\nEND_QA")["blocks"][0]
    assert b["fields"] == {"question": "why?"} and b["fact_ids"] == ["f1", "f2"] and b["answer_points"] == [{"text": "because", "sources": ["e1", "e2"]}] and len(b["forbidden_points"]) == 1
    assert p("FOCUS: x\nSOURCES: e1")["blocks"][0]["sources"] == ["e1"] and p("REVIEW q1\nok: true\nEND_REVIEW")["blocks"][0]["fields"] == {"ok": "true"}
    got = review.parse_responses(spark.createDataFrame([(1, "NO_QA"), (2, None)], "id int, content string")).select("id", "parsed.error", "parsed.verdict").collect()
    assert {r.id: (r.verdict, bool(r.error)) for r in got} == {1: ("no_qa", False), 2: (None, True)}


CAND = "id string, ord int, qa_mode string, type string, status string, question string, answer_target string, points array<struct<text:string,sources:array<string>>>, fact_ids array<string>, evidence_group_id string, track string, difficulty_distance int"


def cands(spark):
    pt = lambda t, *s: [(t, list(s))]
    rows = [
        ("a", 1, "code", "t1", "needs_review", "Why  X?", "target", pt("claim one", "e1"), ["f1"], "g1", None, 0),
        ("b", 2, "code", "t1", "approved", "why x?", "target", pt("Claim one", "e1"), ["f1"], "g1", None, 0),
        ("c", 3, "code", "t2", "approved", "how much", "Target", pt("claim one", "e1") + pt("claim two", "e9"), ["f2", "f3"], "g2", None, 2),
        ("d", 4, "code", "t2", "approved", "other 5", "target", pt("claim one", "e1"), ["f4"], "g3", None, 0),
        ("e", 5, "general", "t1", "approved", "Why X?", "target", pt("claim one", "e1"), ["f1"], "g1", None, 0),
    ]
    return spark.createDataFrame(rows, CAND)


def test_duplicates(spark):
    f = selection.features(cands(spark))
    assert {r.id: r.duplicate_of for r in selection.exact_duplicates(f).collect()} == {"a": "b", "b": None, "c": None, "d": None, "e": None}
    got = {(r.id, r.duplicate_of, r.reason) for r in selection.reviewed_duplicates(f, Scratch(spark)).collect()}
    assert got == {("a", "b", "duplicate_question_or_answer"), ("b", "c", "near_duplicate_answer_target")}
    pairs = {(r.a, r.b) for r in selection.nominated_pairs(f).collect()}
    assert ("a", "b") in pairs and not any("e" in p for p in pairs)
    small, large = selection.clusters(f, Scratch(spark), 4)
    assert small.count() == 4 and large.count() == 0


def test_selection(spark):
    got = {r.id: (r.place, r.selection_status) for r in selection.novelty_select(cands(spark), {"code": 2}).collect()}
    assert got == {"c": (1, "selected"), "b": (2, "selected"), "a": (None, "not_approved"), "d": (None, "over_quota"), "e": (None, "unknown_qa_mode")}
    dec = spark.createDataFrame([(1, "a", "b"), (2, "b", "a"), (3, "d", "d"), (4, "e", "b"), (5, "b", "c")], "ord int, candidate_id string, duplicate_of string")
    assert {(r.candidate_id, r.duplicate_of) for r in selection.apply_decisions(cands(spark), dec).collect()} == {("a", "b"), ("b", "c")}
    ok = spark.createDataFrame([("ok", True), ("不同目标", True), ("", True), ("different target", False)], "reason string, t boolean").select("reason", "t", selection.review_consistent(F.col("reason"), {"same_target": F.col("t")}).alias("r"))
    assert [r.r for r in ok.collect()] == [True, False, False, True]
    over = selection.audit(spark.createDataFrame([("a", "raw", None), ("b", "raw", None)], "id string, status string, reason string"), spark.createDataFrame([("a", "rejected", "x")], "id string, status string, reason string"), spark.createDataFrame([("a", "published", None)], "id string, status string, reason string"))
    assert {(r.id, r.status, r.reason) for r in over.collect()} == {("a", "published", "x"), ("b", "raw", None)}


def test_replenishment(spark):
    pool = spark.createDataFrame([("code" if i % 2 else "general", i) for i in range(20)], "mode string, ord int")
    run = lambda part: part.select("mode", F.col("ord").cast("string").alias("id"), F.when(F.col("ord") % 3 == 0, "approved").otherwise("rejected").alias("status"))
    out, receipts = selection.replenish(pool, run, {"code": 2, "general": 99}, {"code": 10, "general": 6})
    n = {(r["mode"], r["status"]): r["count"] for r in out.groupBy("mode", "status").count().collect()}
    assert n[("code", "approved")] >= 2 and sum(r["taken"] for r in receipts if r["mode"] == "general") == 6


def test_strict_metrics(spark):
    t = spark.createDataFrame([("a", 0, True, 5, 10, True), ("a", 1, True, 3, None, True), ("b", 0, False, 1, 1, True), ("b", 1, True, 2, 2, True)], "task string, c int, ok boolean, calls int, tokens int, whole boolean")
    got = {r.task: r for r in metrics.paired_deltas(t, "task", "c", 0, 1, "ok", ["calls", "tokens"], {"tokens": "whole"}).collect()}
    assert (got["a"].calls_difference, got["a"].tokens_difference, got["b"].calls_difference, got["b"].completion_difference) == (-2, None, None, 1)
    assert t.agg(metrics.strict_sum(F.col("calls")).alias("a"), metrics.strict_sum(F.col("tokens")).alias("b")).head().asDict() == {"a": 11, "b": None}
    items = spark.createDataFrame([("a1", ["m::x"]), ("a2", ["m::y", "m::z"]), ("a3", []), ("a4", ["m::w"])], "id string, tests array<string>")
    cases = spark.createDataFrame([("m::x", "passed"), ("m::y", "passed"), ("m::z", "failed"), ("m::w", "passed"), ("m::w", "passed")], "id string, status string")
    got = metrics.assess_acceptance(items, cases, "failed")
    assert {r.id: r.status for r in got.collect()} == {"a1": "passed", "a2": "failed", "a3": "uncertain", "a4": "uncertain"}
    assert metrics.acceptance_status(got, "passed").head().status == "failed"


def test_junit(spark):
    xml = "<testsuite><testcase classname='m' name='a'/><testcase classname='m' name='b'><failure/></testcase></testsuite>"
    r = spark.createDataFrame([(1, 1, xml), (2, 0, "<x"), (3, 0, "<testsuite><testcase classname='m' name='a'/></testsuite>")], "task int, exit_code int, xml string")
    c = review.junit_cases(r)
    assert {(x.task, x.id, x.status) for x in c.collect()} == {(1, "m::a", "passed"), (1, "m::b", "failed"), (2, None, "error"), (3, "m::a", "passed")}
    assert {x.task: x.status for x in review.junit_rollup(c).collect()} == {1: "failed", 2: "error", 3: "passed"}


def test_acceptance_items(spark):
    lines = spark.createDataFrame([(1, "| a1 | works | task | test:m::x |"), (1, "| a2 | | task | inspect: y |"), (1, "| a3 | z | c1 | command: run |"), (1, "| a4 | z | c9 | test:m::q |"), (1, "| id | x | y | z |")], "task int, line string")
    got = review.acceptance_items(lines, ["c1"])
    assert {r.id: (r.tests, r.error is None) for r in got.collect()} == {"a1": (["m::x"], True), "a2": ([], False), "a3": (["command::run"], True), "a4": (["m::q"], False)}
    con = spark.createDataFrame([(1, "c1", True), (1, "c2", True), (1, "c3", False)], "task int, id string, active boolean")
    assert [r.id for r in review.uncovered_contracts(got, con).collect()] == ["c2"]


FACT = "session_id string, id string, ord int, statement string, sources array<string>, qa_mode string, source_kind string"


def test_evidence_chain(spark):
    rows = [("s", "f1", 1, "parse_config 必须 keep order", ["e1"], "general", None), ("s", "f2", 2, "parse_config 之前失败, 后来改为 safe_load", ["e2"], "general", None), ("s", "f3", 3, "unrelated Thing", ["e3"], "general", None), ("s", "f4", 4, "parse_config 必须 keep order ", ["e1"], "general", None)]
    facts = spark.createDataFrame(rows, FACT)
    assert {r.id: r.canonical for r in evidence.merge_facts(facts).collect()} == {"f1": "f1", "f2": "f2", "f3": "f3", "f4": "f1"}
    rec = spark.createDataFrame([("s", f"e{i}", None, i, 1, ["a.py"] if i < 3 else [], "text", "message", "conversation") for i in (1, 2, 3)], "session_id string, id string, parent_id string, ord int, stage int, affected_paths array<string>, text string, kind string, source_kind string")
    ver = versions.replay(records(spark))
    idx = evidence.source_index(rec, ver, versions.pair_calls(spark.createDataFrame([], "session_id string, id string, ord int, kind string, call_id string")), versions.ancestry(ver, Scratch(spark)))
    info = evidence.fact_info(facts.where("id <> 'f4'"), idx).withColumn("source_kinds", F.array(F.lit("conversation")))
    got = {r.id: r for r in info.collect()}
    assert got["f2"].paths == ["a.py"] and "change" in got["f2"].labels and got["f1"].entities[0] == "parse_config"
    s = evidence.pair_scores(info)
    assert ("f1", "f2") in {(r.a, r.b) for r in s.where("linked").collect()}
    assert not any("f3" in (r.a, r.b) and r.linked for r in s.collect())
    g = evidence.build_groups(info, s).collect()
    assert any(r.facts == ["f1", "f2"] for r in g)
    allowed = spark.createDataFrame([("s", "e1", "conversation"), ("s", "e2", "tool")], "session_id string, source string, kind string")
    v = {r.id: r.reason for r in review.validate_facts(facts, allowed).collect()}
    assert v == {"f1": None, "f2": None, "f3": "unknown_or_missing_evidence", "f4": None}


def write(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def test_readers(spark, tmp_path):
    doc = {"version": 1, "workspace": "/w", "records": [{"kind": "message", "role": "user", "text": "hi"}, {"kind": "patch", "success": True, "changes": {"a.py": {"type": "add", "content": "x"}}}]}
    u = dialogue.read_dialogue(spark, write(tmp_path, "u.json", json.dumps(doc))).orderBy("ord").collect()
    assert [(r.id, r.kind, r.source_kind, r.workspace) for r in u] == [("e1", "message", "conversation", "/w"), ("e2", "patch", "code", "/w")] and json.loads(u[1].changes)["a.py"]["content"] == "x"
    m = dialogue.read_dialogue(spark, write(tmp_path, "m.json", json.dumps([{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]))).collect()
    assert [(r.role, r.text) for r in m] == [("user", "a"), ("assistant", "b")]
    codex = [{"type": "session_meta", "payload": {"cwd": "/x"}}, {"type": "response_item", "payload": {"type": "message", "role": "user", "content": [{"text": "p"}, {"text": "q"}]}}, {"type": "response_item", "payload": {"type": "reasoning"}}, {"type": "response_item", "payload": {"type": "function_call", "call_id": "c", "name": "sh", "arguments": "ls"}}, {"type": "response_item", "payload": {"type": "function_call_output", "call_id": "c", "output": "ok"}}, {"type": "event_msg", "payload": {"type": "patch_apply_end", "call_id": "c", "success": True, "changes": {"a": {"type": "delete"}}}}]
    c = dialogue.read_dialogue(spark, write(tmp_path, "c.jsonl", "\n".join(map(json.dumps, codex)))).orderBy("ord").collect()
    assert [(r.id, r.kind, r.text, r.workspace) for r in c] == [("e1", "message", "p\nq", "/x"), ("e2", "call", "ls", "/x"), ("e3", "result", "ok", "/x"), ("e4", "patch", None, "/x")]
    hands = [{"id": "r1", "kind": "user", "text": "go"}, {"id": "r2", "kind": "tool_call", "call_id": "k", "tool_name": "file_editor", "action": {"command": "str_replace", "path": "/workspace/candidate/a.py"}}, {"id": "r3", "kind": "tool_result", "call_id": "k", "tool_name": "file_editor", "observation": {"command": "str_replace", "path": "/workspace/candidate/a.py", "is_error": False, "prev_exist": True, "old_content": "a\n", "new_content": "b\n"}}]
    h = dialogue.read_dialogue(spark, write(tmp_path, "h.jsonl", "\n".join(map(json.dumps, hands)))).orderBy("ord")
    assert [(r.id, r.kind) for r in h.collect()] == [("e1", "message"), ("e2", "call"), ("e3", "result"), ("e4", "observation"), ("e5", "patch")]
    v = versions.replay(h).orderBy("version_seq").collect()
    assert [(r.path, r.status, r.content) for r in v] == [("a.py", "known", "a\n"), ("a.py", "known", "b\n")]


def test_public_rows_must_be_dense(spark, tmp_path):
    import pytest

    rows = [{"id": "a", "schema": "model-visible-dialogue-v1", "sequence": 2, "kind": "user", "text": "x"}]
    with pytest.raises(Exception, match="Invalid public event identity or sequence"):
        dialogue.read_dialogue(spark, write(tmp_path, "p.jsonl", json.dumps(rows[0]))).collect()


def test_artifacts(spark, tmp_path):
    import pytest

    df = spark.createDataFrame([(1, "x", None), (2, "x", None), (3, "y", 4)], "k int, a string, b int")
    artifacts.save_pooled(df, str(tmp_path / "p"), ["k"])
    assert Counter(map(tuple, artifacts.load_pooled(spark, str(tmp_path / "p")).select("k", "a", "b").collect())) == Counter(map(tuple, df.collect()))
    assert spark.read.parquet(str(tmp_path / "p/pool")).count() == 2
    with pytest.raises(Exception):
        artifacts.save_new(df, str(tmp_path / "p/pool"))
    rec = artifacts.convert(dialogue.read_dialogue(spark, write(tmp_path, "m.json", json.dumps([{"role": "user", "content": "a"}]))), str(tmp_path / "rec"))
    assert rec.head().records == 1


def test_reports(spark):
    from evidra.operators import reports

    facts = spark.createDataFrame([("s", "f1", "see e1 and e1-x", ["e1"]), ("s", "f2", "leaks e9", ["e1"]), ("s", "f3", "h " + "a" * 40, ["e1"])], "session_id string, id string, statement string, sources array<string>")
    refs = spark.createDataFrame([("s", "e1", "资料1")], "session_id string, source string, ref string")
    assert {(r.id, r.statement) for r in reports.safe_facts(facts, refs).collect()} == {("f1", "see 资料1 and e1-x")}
    claims = spark.createDataFrame([("a", "/w/x.py:2-3"), ("b", "/w/x.py:9"), ("c", "none"), ("d", "/q:1")], "id string, value string")
    files = spark.createDataFrame([("/w/x.py", 5)], "path string, lines int")
    assert {r.id for r in reports.artifact_evidence(claims, files).where("ok").collect()} == {"a"}
    j = spark.range(1).select(reports.viewer_json(F.struct(F.lit("<b>\u2028 c").alias("x"))).alias("j")).head().j
    assert j == '{"x":"\\u003cb>\\u2028 c"}'
    q = spark.createDataFrame([("q1", "approved", "t"), ("q2", "approved", "t"), ("q3", "rejected", "t")], "id string, status string, type string")
    assert [r.id for r in reports.join_qa_inputs(q, spark.createDataFrame([("q1", 1)], "id string, request int"), ["t"]).collect()] == ["q1"]
    snap = spark.createDataFrame([("s", 1, "a"), ("s", 2, "a"), ("s", 3, "b")], "session_id string, ord int, files string")
    assert [r.ord for r in reports.files_changed(snap).orderBy("ord").collect()] == [1, 3]


def test_single_review_and_admission(spark):
    good = {k: True for k in review.CHECKS}
    rows = [
        ("a", "general", None, "what?", "fine", good), ("b", "general", None, "why?", "fine", good), ("c", "general", None, "what?", "fine", good | {"unambiguous": False}), ("d", "general", None, "what?", "", good),
        ("e", "code", "history_core", "what?", "fine", good | {"history_requirement_correct": True, "current_snapshot_alone_sufficient": False, "history_evidence_required": True}),
        ("f", "code", "history_core", "what?", "should be false", good | {"history_requirement_correct": True, "current_snapshot_alone_sufficient": False, "history_evidence_required": True})]
    df = spark.createDataFrame(rows, "id string, qa_mode string, track string, question string, reason string, checks map<string,boolean>")
    assert {r.id: r.status for r in review.single_review(df).collect()} == {"a": "approved", "b": "needs_review", "c": "rejected", "d": "rejected", "e": "approved", "f": "needs_review"}
    keys = ["BASELINE", "REFERENCE", "VERDICT", "COVERAGE", "MUTATIONS", "TESTS"]
    t = spark.createDataFrame([("unmet", "pass", "accept", "complete", "caught", "executable", "failed", "passed", 0), ("unmet", "pass", "accept", "complete", "caught", "executable", "failed", "failed", 0), ("unmet", "pass", "accept", "complete", "unavailable", "partial", "passed", "unavailable", 0), ("unmet", "pass", "accept", None, "caught", "executable", "failed", "passed", 0)], [*keys, "b", "r", "k"])
    assert [r.a for r in t.select(review.admitted({k: F.col(k) for k in keys}, F.col("b"), F.col("r"), F.col("k")).alias("a")).collect()] == [True, False, True, False]


def test_history_contracts(spark):
    ev = spark.createDataFrame([(1, "x", 1), (1, "y", 5)], "task int, id string, ord int")
    c = spark.createDataFrame([(1, 1, "c1", "s", "s", "b", ["x"], [], "no", "external"), (1, 2, "c2", "s", "s", "b", ["y"], ["c1"], "yes", "external"), (2, 1, "c1", "s", "s", "b", ["zz"], [], "yes", "external"), (3, 1, "c1", "s", " ", "b", ["zz"], [], "yes", "external")], "task int, ord int, id string, statement string, scope string, behavior string, sources array<string>, supersedes array<string>, active string, repository string")
    f = review.freeze_contracts(c, ev)
    assert {(r.task, r.id): r.error is None for r in f.collect()} == {(1, "c1"): True, (1, "c2"): True, (2, "c1"): False, (3, "c1"): False}
    assert {r.task for r in review.contract_errors(f).collect()} == {2, 3}
    back = c.where("task = 1").withColumn("supersedes", F.when(F.col("id") == "c1", F.array(F.lit("c2"))).otherwise(F.array().cast("array<string>")))
    assert {r.id for r in review.freeze_contracts(back, ev).where("error is not null").collect()} == {"c1"}
    q = spark.createDataFrame([(1, "c2", "complete", "ans")], "task int, id string, coverage string, quote string")
    assert review.oracle_coverage(c.where("task = 1"), q, "the answer").head().covered and not review.oracle_coverage(c.where("task = 1"), q, "other").head().covered


def test_object_matches_and_guards(spark):
    e = spark.createDataFrame([("s", "f1", ["a.py::run"], ["e1"]), ("s", "f2", ["a.py"], ["e2"]), ("s", "f3", ["run"], ["e2"]), ("s", "f4", ["run"], ["e9"]), ("s", "f5", ["b.py"], ["e2"])], "session_id string, entry string, objects array<string>, sources array<string>")
    w = spark.createDataFrame([("s", "a.py::Run")], "session_id string, object string")
    assert {r.entry for r in evidence.match_objects(e, w).collect()} == {"f1", "f2", "f3"}
    c = spark.createDataFrame([("s", "a", 5, "q", ["e1"], 10), ("s", "b", 5, "q", ["zz"], 10), ("s", "c", 5, "q", ["e9"], 10), ("s", "d", 5, "修复后", ["e1"], 10), ("s", "e", 5, "q", ["e1"], 999), ("s", "f", 5, "q", [], 1)], "session_id string, id string, cutoff int, question string, sources array<string>, size int")
    scope = spark.createDataFrame([("s", "e1", 1), ("s", "e9", 9)], "session_id string, source string, ord int")
    kept = spark.createDataFrame([("s", "a", "e1")], "session_id string, id string, source string")
    assert {r.id: r.guard for r in evidence.candidate_guard(c, scope, kept, 100).collect()} == {"a": "complete", "b": "unknown_source", "c": "source_after_cutoff", "d": "historical_event_not_held", "e": "over_budget", "f": "no_sources"}


def test_static_checks_expansion_and_guards(spark):
    g = spark.createDataFrame([("s", "g1", "f1", ["e1"], True), ("s", "g2", "f2", ["e1", "e2"], True), ("s", "g3", "f1", ["e1"], False), ("s", "g4", "f1", ["e1"], True)], "session_id string, group string, fact string, sources array<string>, complete boolean")
    c = spark.createDataFrame([("s", "g1", "e1"), ("s", "g2", "e1"), ("s", "g3", "e1"), ("s", "g4", "e1"), ("s", "g4", "zz")], "session_id string, group string, source string")
    sc = spark.createDataFrame([("s", "e1"), ("s", "e2")], "session_id string, source string")
    assert {r.group: r.status for r in evidence.static_check(g, c, sc).collect()} == {"g1": "supported", "g2": "insufficient", "g3": "unknown", "g4": "insufficient"}
    ch = spark.createDataFrame([("g", i, f"e{i:02}", 50 if i < 3 else 10) for i in range(15)], "group string, rank int, source string, size_after int")
    got = {r.source: r.audit for r in evidence.expand_once(ch, ["group"], 20).collect()}
    assert got["e02"] == "over_budget" and got["e03"] == "applied" and got["e14"] == "not_tried" and list(got.values()).count("applied") == 1
    base = spark.createDataFrame([("s", "g", "f1")], "session_id string, group string, fact string")
    links = spark.createDataFrame([("s", "f1", "f2", True), ("s", "f2", "f3", False), ("s", "f3", "f4", False), ("s", "f3", "f5", True)], "session_id string, a string, b string, anchor boolean")
    assert {r.fact for r in evidence.guard_closure(base, links).collect()} == {"f1", "f2", "f3"}


def test_windowed_counts_and_replenish_stream(spark, tmp_path):
    ev = spark.createDataFrame([("a", "2024-01-01 00:10:00"), ("a", "2024-01-01 00:20:00"), ("b", "2024-01-01 01:10:00"), ("z", "2024-01-09 00:00:00")], "event_type string, t string").select("event_type", F.to_timestamp("t").alias("ts"))
    ev.coalesce(1).write.parquet(str(tmp_path / "ev"))
    q = streaming.stage_counts_stream(spark.readStream.schema(ev.schema).parquet(str(tmp_path / "ev"))).writeStream.format("memory").queryName("counts_out").outputMode("append").option("checkpointLocation", str(tmp_path / "c1")).start()
    q.processAllAvailable()
    q.stop()
    assert {(r.event_type, r.n) for r in spark.table("counts_out").collect()} >= {("a", 2), ("b", 1)}
    c = cands(spark)
    for i in (1, 2, 3):
        c.where(f"ord % 3 = {i % 3}").coalesce(1).write.mode("append").parquet(str(tmp_path / "cand"))
    s = streaming.replenish_stream(spark.readStream.schema(c.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "cand")), str(tmp_path / "out"), str(tmp_path / "c2"), {"code": 2}, lambda o, lim: selection.novelty_select(o, lim)).start()
    s.processAllAvailable()
    s.stop()
    got = {(r.id, r.selection_status) for r in spark.read.parquet(str(tmp_path / "out/selected")).collect()}
    assert got == {(r.id, r.selection_status) for r in selection.novelty_select(c, {"code": 2}).collect()}
