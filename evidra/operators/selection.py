"""Duplicates, privacy gate, quotas, novelty and audit over question candidates.

candidates: id, qa_mode, type, status, question, answer_target, points array<struct<text, sources>>,
fact_ids, evidence_group_id, track, difficulty_distance; ord is the input order.
"""

from __future__ import annotations

from heapq import heapify, heappop, heapreplace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..scratch import Scratch
from .graph import components



def mode() -> Column:
    return F.coalesce(F.col("qa_mode"), F.lit("code"))


def features(candidates: DataFrame) -> DataFrame:
    """candidates with mode, claims, sources, question and target as compared, time and condition scope, block keys and rank."""
    said = F.concat_ws("\n", F.coalesce("answer_target", F.lit("")), F.coalesce("question", F.lit("")))
    norm = lambda xs: F.array_sort(F.array_distinct(F.transform(xs, X.normalized)))
    texts = F.filter(F.coalesce(F.col("points")["text"], F.array().cast("array<string>")), lambda t: t.isNotNull() & (F.btrim(t) != ""))
    c = candidates.withColumn("mode", mode()).withColumn("claims", F.filter(norm(texts), lambda t: t != "")).withColumn("answer_sources", F.array_sort(F.array_distinct(F.flatten(F.coalesce(F.col("points")["sources"], F.array().cast("array<array<string>>"))))))
    c = c.withColumn("q_norm", X.normalized(F.col("question"))).withColumn("target_norm", X.normalized(F.col("answer_target")))
    c = c.withColumn("times", norm(X.found(said, X.TEMPORAL_VALUE))).withColumn("phases", F.array_compact(F.array(F.when(said.rlike(X.BEFORE), F.lit("before")), F.when(said.rlike(X.AFTER), F.lit("after"))))).withColumn("conditions", norm(X.found(said, X.CONDITION)))
    named = F.filter(F.transform(X.found(F.concat_ws("\n", F.col("answer_target"), F.array_join(texts, "\n")), X.SEMANTIC_TOKEN), lambda t: F.btrim(F.lower(t))), lambda t: ~t.isin(*X.GENERIC_BLOCK_TOKENS))
    keys = F.concat(F.transform("answer_sources", lambda s: F.concat_ws("\u0001", F.lit("source"), F.col("mode"), s)), F.when(F.col("target_norm") != "", F.array(F.concat_ws("\u0001", F.lit("target"), "mode", "target_norm"))).otherwise(F.array().cast("array<string>")), F.transform(named, lambda t: F.concat_ws("\u0001", F.lit("object"), F.col("mode"), t)))
    rank = F.struct(F.when(F.col("status") == "approved", 0).when(F.col("status") == "needs_review", 1).otherwise(2).alias("s"), (-F.size("claims")).alias("c"), F.coalesce("id", F.lit("")).alias("i"))
    return c.withColumn("block_keys", F.array_distinct(keys)).withColumn("rank", rank)


def exact_duplicates(feat: DataFrame) -> DataFrame:
    """feat with duplicate_of: the first row of equal mode, question, claims (not empty) and sources; approved first, then input order."""
    key = [F.col(c) for c in ("mode", "q_norm", "claims", "answer_sources")]
    ok = (F.col("q_norm") != "") & (F.size("claims") > 0)
    key.append(F.when(~ok, F.struct("id", "ord")))  # rows that duplicate nothing never meet in one task
    w = Window.partitionBy(*key).orderBy(F.coalesce(F.col("status") == "approved", F.lit(False)).desc(), "ord")
    first = F.first("id").over(w)
    return feat.withColumn("duplicate_of", F.when(ok & (F.row_number().over(w) > 1), first))


def nominated_pairs(feat: DataFrame, extra: list[str] = ()) -> DataFrame:
    """(a, b) ids of one mode that share a block key and a source, fit in time and overlap in target, points or question."""
    cols = ["id", "mode", "answer_sources", "times", "phases", "answer_target", "question", "claims"]
    e = feat.select(*cols, F.explode("block_keys").alias("k"))
    a = e.select("k", *(F.col(c).alias(f"a_{c}") for c in cols))
    b = e.select("k", *(F.col(c).alias(f"b_{c}") for c in cols))
    apart = lambda c: (F.size(f"a_{c}") > 0) & (F.size(f"b_{c}") > 0) & ~F.arrays_overlap(f"a_{c}", f"b_{c}")
    met = a.join(b, "k").where("a_id < b_id and a_mode = b_mode").drop("k").dropDuplicates(["a_id", "b_id"])
    met = met.where(F.arrays_overlap("a_answer_sources", "b_answer_sources") & ~apart("times") & ~apart("phases"))
    points = F.exists("a_claims", lambda x: F.exists("b_claims", lambda y: X.text_contains(x, y, 0.5)))
    like = X.text_contains(F.col("a_answer_target"), F.col("b_answer_target"), 0.55) | points | X.text_contains(F.col("a_question"), F.col("b_question"), 0.55)
    return met.where(like).select(F.col("a_id").alias("a"), F.col("b_id").alias("b"))


def clusters(feat: DataFrame, scratch: Scratch, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """(id, cluster) of clusters of 2 to `most` candidates, and (cluster, size) of the larger ones, which are not reviewed."""
    pairs = nominated_pairs(feat).withColumn("session_id", F.lit(0))
    found = components(pairs, scratch).select(F.col("node").alias("id"), F.col("root").alias("cluster"))
    sized = scratch.save(found.join(found.groupBy("cluster").agg(F.count("*").alias("size")), "cluster"), "clusters")
    return sized.where(F.col("size") <= most).select("id", "cluster"), sized.where(F.col("size") > most).select("cluster", "size").distinct()


def _greedy(group_key: str, feat: DataFrame, choose, shape: str) -> DataFrame:
    """choose(rows in order) over each group, as dictionaries."""
    def run(key, t):
        import pyarrow as pa

        return pa.Table.from_pylist(choose(t.to_pylist()), schema=ARROW)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    ARROW = to_arrow_schema(_parse_datatype_string(shape))
    return feat.groupBy(group_key).applyInArrow(run, shape)


def reviewed_duplicates(feat: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, duplicate_of, reason): exact duplicates, then those of equal target, times, conditions, with a common source and claims within the winner's.

    Winners are only kept rows, in order of rank, so groups are taken as connected components of shared keys
    (mode, target, times, phases, conditions), each small and folded in order. Digests stand for texts; rows that share
    no claim and source with another of their group neither win nor lose and stay out of the fold.
    """
    digest = lambda t: F.sha2(t, 256)
    key = digest(F.to_json(F.struct("mode", "target_norm", "times", "phases", "conditions")))
    thin = feat.select("id", "ord", "status", "mode", "rank", "answer_sources", F.when(F.col("q_norm") != "", digest("q_norm")).otherwise("").alias("q_norm"), F.transform("claims", digest).alias("claims"), F.when(F.col("target_norm") != "", key).alias("g"))
    exact = scratch.save(exact_duplicates(thin), "exact")
    rest = exact.where("duplicate_of is null and g is not null and size(claims) > 0").select("g", "id", "rank", "claims", "answer_sources").withColumn("row", F.monotonically_increasing_id())
    meets = rest.select("g", "id", "rank", F.explode("claims").alias("c"), "answer_sources").select("g", "id", "rank", "c", F.explode("answer_sources").alias("s"))
    meets = meets.groupBy("g", "c", F.coalesce("s", F.lit("\u0001")).alias("s")).agg(F.count("*").alias("n")).where("n > 1").select("g", "c").distinct()
    some = rest.withColumn("c", F.explode("claims")).join(meets, ["g", "c"], "left_semi").drop("c").dropDuplicates(["g", "row"])

    def choose(rows):
        kept, by, out = [], {}, []
        for r in sorted(rows, key=lambda r: (r["rank"]["s"], r["rank"]["c"], r["rank"]["i"])):
            c, s = set(r["claims"]), set(r["answer_sources"])
            near = {i for x in c for y in s for i in by.get((x, y), ())}
            win = min((i for i in near if c <= kept[i][1] or kept[i][1] <= c), default=None)
            if win is not None:
                out.append({"id": r["id"], "duplicate_of": kept[win][0]})
            else:
                for x in c:
                    for y in s:
                        by.setdefault((x, y), []).append(len(kept))
                kept.append((r["id"], c))
        return out

    near = _greedy("g", some, choose, "id string, duplicate_of string").withColumn("reason", F.lit("near_duplicate_answer_target"))
    return exact.where("duplicate_of is not null").select("id", "duplicate_of", F.lit("duplicate_question_or_answer").alias("reason")).unionByName(near)


def apply_decisions(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """(candidate_id, duplicate_of) of decisions that hold, taken in order: no cycle, no other mode, no winner of worse rank.

    decisions: ord, candidate_id, duplicate_of.
    """
    f = features(candidates).select("id", "mode", "rank")
    side = lambda n: f.select(F.col("id").alias(n), F.col("mode").alias(f"{n}_mode"), F.col("rank").alias(f"{n}_rank"))
    ok = decisions.join(side("candidate_id"), "candidate_id").join(side("duplicate_of"), "duplicate_of").where("candidate_id <> duplicate_of and candidate_id_mode = duplicate_of_mode and duplicate_of_rank <= candidate_id_rank").select(F.col("candidate_id_mode").alias("mode"), "ord", "candidate_id", "duplicate_of")

    def choose(rows):
        gone, out = set(), []
        for r in sorted(rows, key=lambda r: r["ord"]):
            if r["candidate_id"] not in gone and r["duplicate_of"] not in gone:
                gone.add(r["candidate_id"])
                out.append({"candidate_id": r["candidate_id"], "duplicate_of": r["duplicate_of"]})
        return out

    return _greedy("mode", ok, choose, "candidate_id string, duplicate_of string")


def review_consistent(reason: Column, flags: dict[str, Column]) -> Column:
    """A duplicate review counts if its reason is not empty and contradicts no flag that is true."""
    # What contradicts each flag.
    against = {
        "same_target": r"(?iu)目标(?:并?不|不)(?:相同|一致)|不同(?:目标|用途|决策)|not\s+the\s+same\s+target|different\s+(?:target|goal)",
        "same_time": r"(?iu)(?:时间|时点|时期|版本|条件)(?:并?不|不)(?:相同|一致)|不同(?:时间|时点|时期|版本|条件)|前后(?:时间|时点|版本)不同|not\s+the\s+same\s+(?:time|version|condition)|different\s+(?:time|version|condition)",
        "same_answer": r"(?iu)答案(?:并?不|不)(?:相同|一致)|不同答案|答案.*(?:矛盾|冲突)|not\s+the\s+same\s+answer|different\s+answer",
    }
    out = F.coalesce(F.btrim(reason) != "", F.lit(False))
    for name, flag in flags.items():
        out = out & ~(F.coalesce(flag, F.lit(False)) & reason.rlike(against[name]))
    return out


def quota(rows: DataFrame, track: str, order: list, limits: dict[str, int]) -> DataFrame:
    """rows with place in their track and selection_status: selected, over_quota, unknown_qa_mode or not_approved (status unchanged)."""
    ok = F.col("status") == "approved"
    w = Window.partitionBy(track, F.coalesce(ok, F.lit(False))).orderBy(*order)
    limit = F.create_map(*(x for k, v in limits.items() for x in (F.lit(k), F.lit(v))))[F.col(track)] if limits else F.lit(None).cast("int")
    n = F.row_number().over(w)
    s = F.when(~F.coalesce(ok, F.lit(False)), "not_approved").when(limit.isNull(), "unknown_qa_mode").when(n > limit, "over_quota").otherwise("selected")
    return rows.withColumn("place", n).withColumn("selection_status", s)


def novelty_select(candidates: DataFrame, limits: dict[str, int]) -> DataFrame:
    """(id, track, place, selection_status): per mode, again and again the candidate with a new type, a new group, most new facts and history, first on ties.

    Fact and group ids belong to one mode, so modes are folded apart. Only approved rows of a mode with a limit can
    be picked, and of those with equal type, group, facts and history the first `limit`; the fold takes no others.
    """
    c = candidates.withColumn("mode", mode()).select("mode", "id", "ord", "status", "type", F.coalesce("evidence_group_id", "id").alias("g"), F.array_sort(F.array_distinct(F.coalesce("fact_ids", F.array().cast("array<string>")))).alias("facts"), (F.coalesce(F.col("track") == "history_core", F.lit(False)) | (F.coalesce("difficulty_distance", F.lit(0)) > 0)).alias("far"))
    limit = F.create_map(*(x for k, v in limits.items() for x in (F.lit(k), F.lit(v))))[F.col("mode")] if limits else F.lit(None).cast("int")
    c = c.withColumn("limit", limit).withColumn("ok", F.coalesce(F.col("status") == "approved", F.lit(False)) & F.coalesce(F.col("limit") > 0, F.lit(False)))
    same = Window.partitionBy("mode", "type", "g", "facts", "far").orderBy("ord", "id")

    def choose(rows):
        left = sorted(rows, key=lambda r: (r["ord"] is None, r["ord"] or 0, r["id"] or ""))
        for r in left:
            r["facts"] = set(r["facts"])
        types, groups, facts, out = set(), set(), set(), []
        worth = lambda i: (left[i]["type"] not in types, left[i]["g"] not in groups, len(left[i]["facts"] - facts), left[i]["far"])
        # What a row is worth only falls, so a row whose worth of old is its worth now and the largest is the best.
        key = lambda i: (*(-int(x) for x in worth(i)), i)
        heap = [key(i) for i in range(len(left))]
        heapify(heap)
        while heap and len(out) < left[0]["limit"]:
            now = key(heap[0][-1])
            if now != heap[0]:
                heapreplace(heap, now)
                continue
            best = left[heappop(heap)[-1]]
            types.add(best["type"])
            groups.add(best["g"])
            facts.update(best["facts"])
            out.append({"p_mode": best["mode"], "p_id": best["id"], "p_ord": best["ord"], "p_copy": best["copy"], "place": len(out) + 1})
        return out

    kinds = {f.name: f.dataType.simpleString() for f in c.schema.fields}
    copies = Window.partitionBy("mode", "id", "ord", "ok").orderBy("type", "g", "facts", "far")
    numbered = c.withColumn("copy", F.when(F.col("ok"), F.row_number().over(copies)))
    some = numbered.where("ok").withColumn("n", F.row_number().over(same)).where(F.col("n") <= max(limits.values(), default=0)).drop("n")
    picked = _greedy("mode", some, choose, f"p_mode string, p_id {kinds['id']}, p_ord {kinds['ord']}, p_copy int, place int")
    j = numbered.join(F.broadcast(picked), (F.col("mode") == F.col("p_mode")) & F.col("id").eqNullSafe(F.col("p_id")) & F.col("ord").eqNullSafe(F.col("p_ord")) & (F.col("copy") == F.col("p_copy")), "left")
    status = F.when(~F.coalesce(F.col("status") == "approved", F.lit(False)), "not_approved").when(F.col("limit").isNull(), "unknown_qa_mode").when(F.col("place").isNull(), "over_quota").otherwise("selected")
    return j.select(F.col("id").cast("string").alias("id"), F.col("mode").alias("track"), "place", status.alias("selection_status"))


def privacy_gate(questions: DataFrame, text: str, workspaces: list[str] = ()) -> DataFrame:
    """questions with redacted text and gate: credential, duplicate (of mode and text after redaction) or public."""
    q = questions.withColumn("mode", mode()).withColumn("secret", X.credential_detected(F.col(text))).withColumn("redacted", X.redact_paths(F.col(text), workspaces))
    w = Window.partitionBy("mode", "secret", F.sha2(X.normalized(F.col("redacted")), 256)).orderBy("ord")  # digests travel, not texts
    return q.withColumn("gate", F.when(F.col("secret"), "credential").when(F.row_number().over(w) > 1, "duplicate").otherwise("public")).drop("secret")


def public_projection(candidates: DataFrame) -> DataFrame:
    """What may be published: no sources or private fields; category and track for code only."""
    code = mode() == "code"
    return candidates.select("id", mode().alias("qa_mode"), "question", F.coalesce(F.col("points")["text"], F.array().cast("array<string>")).alias("answer_points"), F.when(code, F.col("type")).alias("category"), F.when(code, F.col("track")).alias("track"))


def audit(raw: DataFrame, *layers: DataFrame) -> DataFrame:
    """raw (id, status, reason) overlaid by each layer in turn: the last that names a value holds."""
    out = raw
    for i, layer in enumerate(layers):
        out = out.join(layer.select("id", F.col("status").alias(f"s{i}"), F.col("reason").alias(f"r{i}")), "id", "left")
    n = range(len(layers) - 1, -1, -1)
    return out.select("id", F.coalesce(*(F.col(f"s{i}") for i in n), "status").alias("status"), F.coalesce(*(F.col(f"r{i}") for i in n), "reason").alias("reason"))


def replenish(pool: DataFrame, run_batch, target: dict[str, int], budget: dict[str, int], batch: int = 2, blocked=lambda out: False) -> tuple[DataFrame | None, list[dict]]:
    """Takes batches of the pool (mode, ord, ...) round robin by mode until each mode has its target, spent its budget or has no more.

    run_batch(rows) returns outcomes (mode, id, status, ...); selection looks at all outcomes so far. Receipts say what each batch gave.
    """
    scratch, outcomes, receipts = Scratch(pool.sparkSession), None, []
    taken, open_ = dict.fromkeys(target, 0), list(target)
    size = {r[0]: r[1] for r in pool.groupBy("mode").count().collect()}
    while open_:
        for m in list(open_):
            n = min(batch, budget.get(m, 0) - taken[m], size.get(m, 0) - taken[m])
            have = 0 if outcomes is None else outcomes.where((F.col("mode") == m) & (F.col("status") == "approved")).count()
            if n <= 0 or have >= target[m]:
                open_.remove(m)
                continue
            w = Window.partitionBy("mode").orderBy("ord")
            part = pool.where(F.col("mode") == m).withColumn("nth", F.row_number().over(w)).where(F.col("nth").between(taken[m] + 1, taken[m] + n)).drop("nth")
            got = scratch.save(run_batch(part), f"batch{len(receipts)}")
            taken[m] += n
            outcomes = got if outcomes is None else outcomes.unionByName(got)
            receipts.append({"mode": m, "taken": n, "approved": got.where("status = 'approved'").count()})
            if blocked(got):
                return outcomes, receipts
    return outcomes, receipts
