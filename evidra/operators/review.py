"""Model output parsing, validation of facts and candidates, and the review states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from .joins import contained

# Tags of the block format, with the names their fields get.
MISSING = ("earlier_state", "later_state", "reason", "outcome", "dependency")
KINDS = ("conversation", "document", "tool", "code", "test")
QA_FIELDS = {
    "QA_MODE": "qa_mode", "TYPE": "type", "CATEGORY": "category", "DIFFICULTY": "difficulty", "DIFFICULTY_REASON": "difficulty_reason", "TRACK": "track",
    "MEMORY_REQUIREMENT": "memory_requirement", "USE_CASE": "use_case", "ANSWER_TARGET": "answer_target", "EXTERNAL_KNOWLEDGE": "external_knowledge", "QUESTION": "question"}
FACT_FIELDS = {"TEXT": "statement", "SOURCE_KIND": "source_kind"}
EMPTY_POINTS = ("", "无", "none", "n/a", "-")
BLOCK = "kind string, id string, fields map<string,string>, sources array<string>, fact_ids array<string>, answer_points array<struct<text:string,sources:array<string>>>, forbidden_points array<struct<text:string,sources:array<string>>>"
PARSED = f"struct<error:string,verdict:string,missing_kind:string,missing_object:string,blocks:array<struct<{BLOCK.replace(', ', ',').replace(' ', ':')}>>>"


def _ids(text: str) -> list[str]:
    return [x for x in (p.strip() for p in text.replace("，", ",").split(",")) if x]


def _block(kind: str, name: str, lines: list[str]) -> dict:
    b: dict = {"kind": kind, "id": name, "fields": {}, "sources": None, "fact_ids": None, "answer_points": [], "forbidden_points": []}
    for line in lines:
        tag, colon, value = line.partition(":")
        tag, value = tag.strip(), value.strip()
        if not colon:
            continue
        if kind == "REVIEW":
            b["fields"][tag] = value
        elif kind == "FACT" and tag == "SOURCES":
            b["sources"] = _ids(value)
        elif kind == "FACT" and tag in FACT_FIELDS:
            b["fields"][FACT_FIELDS[tag]] = value
        elif kind == "QA" and tag == "FACT_IDS":
            b["fact_ids"] = _ids(value)
        elif kind == "QA" and tag in ("ANSWER_POINT", "FORBIDDEN_POINT"):
            text, mark, sources = value.partition("|| SOURCES:")
            if tag == "ANSWER_POINT" or text.strip().casefold() not in EMPTY_POINTS:
                b[tag.lower() + "s"].append({"text": text.strip(), "sources": _ids(sources) if mark else []})
        elif kind == "QA" and tag in QA_FIELDS:
            b["fields"][QA_FIELDS[tag]] = value
    return b


def parse_response(content: str | None) -> dict:
    """error, or verdict (facts, questions, reviews, focus, no_facts, no_qa) and blocks, of one model response."""
    out: dict = {"error": None, "verdict": None, "missing_kind": None, "missing_object": None, "blocks": []}
    if content is None:
        return out | {"error": "LLM content must be text"}
    lines = [x for x in (line.strip() for line in content.splitlines()) if x]
    head = lines[0] if lines else ""
    if head == "NO_QA":
        named = dict((a.strip(), b.strip()) for a, _, b in (x.partition(":") for x in lines[1:]))
        if len(lines) == 1:
            return out | {"verdict": "no_qa"}
        if len(lines) == 3 and list(named) == ["MISSING_KIND", "MISSING_OBJECT"] and named["MISSING_KIND"] in MISSING and named["MISSING_OBJECT"]:
            return out | {"verdict": "no_qa", "missing_kind": named["MISSING_KIND"], "missing_object": named["MISSING_OBJECT"]}
        return out | {"error": "Invalid NO_QA response"}
    if head.startswith("FOCUS:"):
        focus, sources = head[6:].strip(), _ids(lines[1][8:]) if len(lines) == 2 and lines[1].startswith("SOURCES:") else []
        if not focus or not sources:
            return out | {"error": "Invalid FOCUS response"}
        return out | {"verdict": "focus", "blocks": [_block("FOCUS", focus, []) | {"sources": sources}]}
    open_, body = None, []
    for line in lines:
        kind, _, name = line.partition(" ")
        if open_ is None and (kind in ("FACT", "QA") and name or kind == "REVIEW"):
            open_, body = (kind, name.strip()), []
        elif open_ and line == f"END_{open_[0]}":
            out["blocks"].append(_block(*open_, body))
            open_ = None
        elif open_:
            body.append(line)
    if open_:
        return out | {"error": f"Unclosed {open_[0]} block", "blocks": []}
    for kind, verdict in (("FACT", "facts"), ("QA", "questions"), ("REVIEW", "reviews")):
        if some := [b for b in out["blocks"] if b["kind"] == kind]:
            return out | {"verdict": verdict, "blocks": some}
    return out | ({"verdict": "no_facts"} if lines == ["NO_FACTS"] else {"error": "No tagged model blocks found"})


def parse_responses(responses: DataFrame, content: str = "content") -> DataFrame:
    """responses with parsed: a response that cannot be read has an error, and fails no other."""
    @F.pandas_udf(PARSED)
    def parse(text):
        import pandas as pd

        return pd.DataFrame([parse_response(t) for t in text], columns=["error", "verdict", "missing_kind", "missing_object", "blocks"])

    return responses.withColumn("parsed", parse(F.col(content)))


def validate_facts(facts: DataFrame, source_kinds: DataFrame) -> DataFrame:
    """facts (session_id, id, ord, statement, sources, source_kind) with source_kinds and reason, the first that applies, null if accepted.

    source_kinds: session_id, source, kind of every id that may be cited.
    """
    k = source_kinds.groupBy("session_id", "source").agg(F.min("kind").alias("kind"))
    cited = facts.select("session_id", "id", "ord", F.explode_outer("sources").alias("source")).join(k, ["session_id", "source"], "left")
    g = cited.groupBy("session_id", "id", "ord").agg(F.count("source").alias("n"), F.count_distinct("source").alias("d"), F.count_if(F.col("source").isNotNull() & F.col("kind").isNull()).alias("unknown"), F.array_sort(F.collect_set("kind")).alias("source_kinds"))
    j = facts.join(g, ["session_id", "id", "ord"])
    first = F.row_number().over(Window.partitionBy("session_id", "id").orderBy("ord")) == 1
    r = (F.when(F.coalesce("id", F.lit("")) == "", "invalid_or_duplicate_id").when(~first, "invalid_or_duplicate_id").when(F.coalesce(F.btrim("statement"), F.lit("")) == "", "missing_statement")
         .when((F.col("n") == 0) | (F.col("d") < F.col("n")) | (F.col("unknown") > 0), "unknown_or_missing_evidence").when(F.size("source_kinds") == 0, "untyped_evidence").when(F.col("source_kind").isNotNull() & ~F.col("source_kind").isin(*KINDS), "invalid_source_kind"))
    one = F.when(F.size("source_kinds") == 1, F.get("source_kinds", F.lit(0)))
    return j.withColumn("reason", r).withColumn("source_kind", F.coalesce("source_kind", one)).drop("n", "d", "unknown")


def validate_candidates(candidates: DataFrame, allowed: Column) -> DataFrame:
    """candidates (id, ord, question, points) with reason: id, question, points, sources of points, leaks of internal ids or vague recency."""
    w = Window.partitionBy("id").orderBy("ord")
    texts = F.concat_ws("\n", F.col("question"), F.array_join(F.col("points")["text"], "\n"))
    bad_point = F.exists("points", lambda p: (F.coalesce(F.btrim(p["text"]), F.lit("")) == ""))
    bad_source = F.exists("points", lambda p: ~F.coalesce(contained(p["sources"], allowed), F.lit(False)))
    r = (F.when((F.coalesce("id", F.lit("")) == "") | (F.row_number().over(w) > 1), "invalid_or_duplicate_id").when(F.coalesce(F.btrim("question"), F.lit("")) == "", "missing_question").when(F.coalesce(F.size("points"), F.lit(0)) == 0, "missing_answer_points")
         .when(bad_point, "empty_answer_point").when(bad_source, "unknown_or_missing_evidence").when(texts.rlike(X.INTERNAL_ID), "internal_id_leak").when(texts.rlike("(?u)上次|上一次|最近一次|最后一次"), "unsupported_recency"))
    return candidates.withColumn("reason", r).withColumn("status", F.when(r.isNull(), "awaiting_semantic_review").otherwise("rejected"))


def point_ids(points: Column, letter: str = "A") -> Column:
    return F.transform(points, lambda p, i: F.concat(F.lit(letter), (i + 1).cast("string")))


def step(status: Column, waiting: str, outcome: Column, to: dict[str, str], other: str = "needs_review") -> Column:
    """The status after a review: only a waiting candidate moves; an outcome that is not listed, or null, goes to `other`."""
    return F.when(status != waiting, status).otherwise(F.coalesce(F.create_map(*(x for k, v in to.items() for x in (F.lit(k), F.lit(v))))[outcome], F.lit(other)))


def target_review(status: Column, outcome: Column) -> Column:
    return step(status, "awaiting_semantic_review", outcome, {"aligned": "awaiting_semantic_review", "mixed": "rejected", "drifted": "rejected"})


def relevance_review(candidates: DataFrame) -> DataFrame:
    """candidates (status, points, relevance map of A1... to required or extra): extra points go; none left is a rejection."""
    kept = F.transform(F.filter(F.arrays_zip(F.col("points").alias("p"), point_ids(F.col("points")).alias("k")), lambda z: F.coalesce(F.try_element_at("relevance", z["k"]), F.lit("required")) != "extra"), lambda z: z["p"])
    mapped = F.col("relevance").isNotNull() & (F.size(F.array_except(point_ids(F.col("points")), F.map_keys("relevance"))) == 0)
    s = F.when(F.col("status") != "awaiting_semantic_review", F.col("status")).when(~F.coalesce(mapped, F.lit(False)), "needs_review").when(F.size(kept) == 0, "rejected").otherwise("awaiting_atomicity_review")
    return candidates.withColumn("__s", s).withColumn("points", F.when(F.col("__s") == "awaiting_atomicity_review", kept).otherwise(F.col("points"))).withColumn("status", F.col("__s")).drop("__s")


def atomicity_review(status: Column, points: Column, states: Column) -> Column:
    """Every point must be mapped; a compound one rejects."""
    v = F.map_values(states)
    whole = states.isNotNull() & (F.size(F.array_except(point_ids(points), F.map_keys(states))) == 0)
    return F.when(status != "awaiting_atomicity_review", status).when(~F.coalesce(whole, F.lit(False)), "needs_review").when(F.array_contains(v, "compound"), "rejected").when(F.exists(v, lambda x: x != "single"), "needs_review").otherwise("awaiting_completeness_review")


def completeness_review(status: Column, outcome: Column) -> Column:
    return step(status, "awaiting_completeness_review", outcome, {"complete": "awaiting_evidence_review", "missing": "rejected", "uncertain": "needs_review"})


def evidence_review(status: Column, points: Column, forbidden: Column, decided: Column) -> Column:
    """A points must be supported and F points contradicted; insufficient or missing decisions wait, stale or opposite ones reject.

    decided: map of point id to supported, contradicted, insufficient or stale, as X.assignments gives with its sources cut off.
    """
    need = F.concat(point_ids(points), point_ids(forbidden, "F"))
    got = F.transform(need, lambda k: F.struct(k.alias("k"), F.substring_index(F.try_element_at(decided, k), "@", 1).alias("v")))
    bad = F.exists(got, lambda g: F.coalesce((g["v"] == "stale") | (g["k"].startswith("A") & (g["v"] == "contradicted")) | (g["k"].startswith("F") & (g["v"] == "supported")), F.lit(False)))
    open_ = F.exists(got, lambda g: g["v"].isNull() | ~g["v"].isin("supported", "contradicted"))
    return F.when(status != "awaiting_evidence_review", status).when(decided.isNull(), "needs_review").when(bad, "rejected").when(open_, "needs_review").otherwise("approved")


def supplement(first: Column, more: Column) -> Column:
    """The first decisions with those of `more` for points they leave out; made decisions don't change."""
    none = F.create_map().cast("map<string,string>")
    a, b = F.coalesce(first, none), F.coalesce(more, none)
    return F.map_concat(F.map_filter(b, lambda k, v: ~F.map_contains_key(a, k)), a)


def match_reviews(reviews: DataFrame, candidates: DataFrame) -> DataFrame:
    """reviews (request, id) with candidate (request, alias): matched, placeholder (one candidate, id like q1), or malformed (unknown, repeated)."""
    c = candidates.select("request", F.col("id").alias("candidate"), F.explode(F.array_distinct(F.array_compact(F.array("id", "alias")))).alias("id"))
    c = c.withColumn("owners", F.count("*").over(Window.partitionBy("request", "id")))
    alone = candidates.groupBy("request").agg(F.count("*").alias("__n"), F.first("id").alias("only"))
    j = reviews.join(c, ["request", "id"], "left").join(alone, "request", "left")
    who = F.coalesce(F.when(F.col("owners") == 1, F.col("candidate")), F.when(F.col("id").rlike(r"^q\d+$") & (F.col("__n") == 1), F.col("only")))
    j = j.withColumn("candidate", who)
    again = F.count("*").over(Window.partitionBy("request", "candidate"))
    state = F.when(F.col("candidate").isNull(), "malformed").when(again > 1, "malformed").when(F.col("owners") == 1, "matched").otherwise("placeholder")
    return j.withColumn("state", state).drop("owners", "__n", "only")


def acceptance_items(lines: DataFrame, contracts: list[str]) -> DataFrame:
    """Rows of a four-column table (task, line) as id, requirement, basis, tests, check and error, null if the row is sound."""
    cells = F.transform(F.split(F.regexp_replace(F.btrim("line"), r"^\||\|$", ""), r"\|"), lambda c: F.regexp_replace(F.btrim(c), "^`+|`+$", ""))
    t = lines.withColumn("c", cells).where((F.size("c") == 4) & F.get("c", F.lit(0)).rlike(r"^a\d+$"))
    get = lambda i: F.get("c", F.lit(i))
    t = t.select("task", get(0).alias("id"), get(1).alias("requirement"), F.transform(F.split(get(2), ","), lambda x: F.btrim(x)).alias("basis"), get(3).alias("check"))
    tests = F.when(F.col("check").startswith("test:"), F.transform(F.split(F.substring("check", 6, 100_000), ","), lambda x: F.regexp_replace(F.btrim(x), "^`+|`+$", ""))).when(F.col("check").startswith("command:"), F.array(F.concat(F.lit("command::"), F.btrim(F.substring("check", 9, 100_000))))).otherwise(F.array().cast("array<string>"))
    t = t.withColumn("tests", tests)
    again = F.count("*").over(Window.partitionBy("task", "id")) > 1
    known = F.array(F.lit("task"), *map(F.lit, contracts))
    error = (F.when((F.col("requirement") == "") | (F.col("check") == "") | again | (F.size(F.array_except("basis", known)) > 0), "Invalid acceptance item")
             .when((F.size("tests") == 0) & ~F.col("check").startswith("inspect:"), "Acceptance check must be test:, command:, or inspect:").when(F.exists("tests", lambda x: ~x.rlike(r"^[\w.]+::[\w\[\].-]+$")), "Use exact JUnit classname::name"))
    return t.withColumn("error", error)


def uncovered_contracts(items: DataFrame, contracts: DataFrame) -> DataFrame:
    """Active contracts (task, id, active) that no item of their task is based on."""
    cited = items.select("task", F.explode("basis").alias("id")).distinct()
    return contracts.where("active").join(cited, ["task", "id"], "left_anti").select("task", "id")


def admitted(said: dict[str, Column], baseline: Column, reference: Column, skipped: Column) -> Column:
    """Whether a task counts. said: BASELINE, REFERENCE, VERDICT, COVERAGE, MUTATIONS, TESTS as the validator put them.

    A model's word never overrides a test: executable tests must fail before and pass after, without skips, with mutations caught.
    """
    word = lambda k, *v: F.coalesce(said[k].isin(*v), F.lit(False))
    agreed = word("BASELINE", "unmet") & word("REFERENCE", "pass") & word("VERDICT", "accept") & word("COVERAGE", "complete")
    sound = ~word("MUTATIONS", "missed") & (baseline != "error") & ~reference.isin("failed", "error")
    run = (baseline == "failed") & (reference == "passed") & (F.coalesce(skipped, F.lit(0)) == 0) & word("MUTATIONS", "caught")
    return agreed & sound & F.when(word("TESTS", "executable"), run).otherwise(word("TESTS", "partial", "unavailable") & word("MUTATIONS", "caught", "unavailable"))


# The checks of a single review.
CHECKS = "evidence_supported version_consistent unambiguous difficulty_justified not_answer_leaking natural_wording practical_useful answer_complete atomic_points_correct type_correct".split()
CODE_CHECKS = "history_requirement_correct current_snapshot_alone_sufficient history_evidence_required".split()
CAUSAL = "(?iu)为什么|为何|原因|导致|why|cause"


def single_review(reviews: DataFrame) -> DataFrame:
    """reviews (qa_mode, track, question, reason, checks map of booleans) with status and failed: one decision over all checks.

    A missing check, or a reason or a second flag that contradicts one, waits for review; a false one rejects.
    """
    c = lambda k: F.try_element_at("checks", F.lit(k))
    code, causal = F.coalesce("qa_mode", F.lit("code")) == "code", F.coalesce(F.col("question").rlike(CAUSAL), F.lit(False))
    need = F.concat(F.array(*map(F.lit, CHECKS)), F.when(causal, F.array(F.lit("causal_support"))).otherwise(F.array().cast("array<string>")), F.when(code, F.array(*map(F.lit, CODE_CHECKS))).otherwise(F.array().cast("array<string>")))
    missing = F.filter(need, lambda k: F.try_element_at("checks", k).isNull())
    yes = F.filter(F.array(*map(F.lit, CHECKS)), lambda k: ~F.coalesce(F.try_element_at("checks", k), F.lit(False)))
    failed = F.concat(yes, F.when(causal & (c("causal_support") == F.lit(False)), F.array(F.lit("causal_support"))).otherwise(F.array().cast("array<string>")))
    alone, history = c("current_snapshot_alone_sufficient"), c("history_evidence_required")
    track = ((F.col("track") == "history_core") & ~alone & history) | ((F.col("track") == "inference_control") & alone & ~history)
    hist, why = c("history_requirement_correct"), F.coalesce("reason", F.lit(""))
    conflict = (hist & why.rlike("(?iu)应为\\s*false|should be false|不符合.*(?:history|历史)|不成立")) | (~hist & why.rlike("(?iu)符合|正确|consistent|satisfied") & ~why.rlike("(?iu)不符合|不正确|not\\s+(?:consistent|satisfied)")) | (c("type_correct") != c("category_correct"))
    valid = (F.size(failed) == 0) & F.coalesce(c("qa_mode_correct"), F.lit(True)) & (~code | F.coalesce(hist & track, F.lit(False))) & (F.btrim(why) != "")
    s = F.when((F.size(missing) > 0) | F.coalesce(conflict, F.lit(False)), "needs_review").when(valid, "approved").otherwise("rejected")
    return reviews.withColumn("status", s).withColumn("missing", missing).withColumn("failed", failed)


def freeze_contracts(contracts: DataFrame, events: DataFrame) -> DataFrame:
    """contracts (task, ord, id, statement, scope, behavior, sources, supersedes, active yes or no, repository) with at and error.

    Sources must be events (task, id, ord); what is superseded must be defined before and cite only earlier events.
    """
    cited = contracts.select("task", F.col("id").alias("cid"), "ord", F.explode_outer("sources").alias("id")).join(events.select("task", "id", F.col("ord").alias("at")), ["task", "id"], "left")
    c = cited.groupBy("task", F.col("cid").alias("id"), "ord").agg(F.max("at").alias("at"), F.bool_and(F.col("at").isNotNull()).alias("found"))
    j = contracts.join(c, ["task", "id", "ord"])
    old = j.select("task", F.col("id").alias("prior"), F.col("ord").alias("prior_ord"), F.col("at").alias("prior_at"))
    sup = j.select("task", "id", "ord", "at", F.explode("supersedes").alias("prior")).join(old, ["task", "prior"], "left").groupBy("task", "id", "ord").agg(F.bool_and(F.coalesce(F.col("prior_ord") < F.col("ord"), F.lit(False))).alias("known"), F.bool_and(F.coalesce(F.col("at") > F.col("prior_at"), F.lit(False))).alias("later"))
    j = j.join(sup, ["task", "id", "ord"], "left")
    blank = F.lit(False)
    for col in ("statement", "scope", "behavior"):
        blank = blank | (F.coalesce(F.btrim(col), F.lit("")) == "")
    first = F.row_number().over(Window.partitionBy("task", "id").orderBy("ord")) == 1
    bad = (F.coalesce("id", F.lit("")) == "") | ~first | ~F.coalesce("found", F.lit(False)) | blank | ~F.coalesce("known", F.lit(True)) | ~F.coalesce(F.col("active").isin("yes", "no"), F.lit(False)) | ~F.coalesce(F.col("repository").isin("recoverable", "external", "uncertain"), F.lit(False))
    e = F.when(bad, "Invalid historical contract or public source reference").when(~F.coalesce("later", F.lit(True)), "Historical replacement must cite a later public event")
    return j.withColumn("error", e).drop("found", "known", "later")


def contract_errors(frozen: DataFrame) -> DataFrame:
    """Tasks whose contracts cannot be used: a faulty one, none active, or an active one that is not external."""
    g = frozen.groupBy("task").agg(F.first("error", True).alias("error"), F.count_if(F.col("active") == "yes").alias("live"), F.count_if((F.col("active") == "yes") & (F.col("repository") != "external")).alias("inside"))
    return g.select("task", F.coalesce("error", F.when((F.col("live") == 0) | (F.col("inside") > 0), "Main historical tasks require active external rules")).alias("error")).where("error is not null")


def history_review(contracts: DataFrame, items: DataFrame) -> DataFrame:
    """(task, id, status): not_applicable, violated, applied or insufficient, from the acceptance items (task, basis, status) based on each contract."""
    b = items.select("task", "status", F.explode("basis").alias("id"))
    g = b.groupBy("task", "id").agg(F.bool_or(F.col("status") == "failed").alias("bad"), F.bool_and(F.col("status") == "passed").alias("good"))
    return contracts.join(g, ["task", "id"], "left").select("task", "id", F.when(F.col("active") != "yes", "not_applicable").when(F.col("bad"), "violated").when(F.col("good"), "applied").otherwise("insufficient").alias("status"))


def oracle_coverage(contracts: DataFrame, quotes: DataFrame, answer: str) -> DataFrame:
    """(task, covered): every active contract has exactly one quote (task, id, coverage, quote), complete and found in the answer."""
    q = quotes.groupBy("task", "id").agg(F.count("*").alias("n"), F.first("coverage").alias("coverage"), F.first("quote").alias("quote"))
    j = contracts.where("active = 'yes'").join(q, ["task", "id"], "left")
    ok = (F.col("n") == 1) & (F.col("coverage") == "complete") & (F.btrim("quote") != "") & F.lit(answer).contains(F.col("quote"))
    return j.groupBy("task").agg(F.bool_and(F.coalesce(ok, F.lit(False))).alias("covered"))


def junit_cases(reports: DataFrame, xml: str = "xml") -> DataFrame:
    """(task, exit_code, id, status) of each test case; a report that cannot be read has one row of status error."""
    kind = reports.schema["task"].dataType.simpleString()

    def run(batches):
        import xml.etree.ElementTree as ET

        import pyarrow as pa

        for b in batches:
            out = []
            for task, code, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                try:
                    cases = list(ET.fromstring(text or "").iter("testcase"))
                except ET.ParseError:
                    out.append((task, code, None, "error"))
                    continue
                for c in cases:
                    tags = {x.tag for x in c}
                    out.append((task, code, f"{c.get('classname', '')}::{c.get('name', '')}", next((s for t, s in (("error", "error"), ("failure", "failed"), ("skipped", "skipped")) if t in tags), "passed")))
            cols = list(zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], b.schema.field(0).type), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.string())], ["task", "exit_code", "id", "status"])

    return reports.select("task", F.col("exit_code").cast("int").alias("exit_code"), xml).mapInArrow(run, f"task {kind}, exit_code int, id string, status string")


def junit_rollup(cases: DataFrame) -> DataFrame:
    """By task: error before failed before a non-zero exit before passed, which needs a passed case; else unavailable."""
    n = lambda s: F.count_if(F.col("status") == s)
    g = cases.groupBy("task").agg(F.max("exit_code").alias("exit_code"), F.count("id").alias("tests"), *(n(s).alias(s) for s in ("passed", "failed", "error", "skipped")))
    return g.withColumn("status", F.when(F.col("error") > 0, "error").when(F.col("failed") > 0, "failed").when(F.col("exit_code") != 0, "error").when(F.col("passed") > 0, "passed").otherwise("unavailable"))
