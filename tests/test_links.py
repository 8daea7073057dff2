"""Ancestry and distances to their end, entities and links of facts, contained lines against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from evidra.functions import text as X
from evidra.operators import evidence, graph, joins, versions
from evidra.scratch import Scratch


def test_ancestry_of_a_long_chain(spark):
    v = spark.createDataFrame([("s", f"v{i}", f"v{i - 1}" if i else None) for i in range(200)], "session_id string, version_id string, previous string")
    got = {(r.version_id, r.ancestor): r.distance for r in versions.ancestry(v, Scratch(spark)).collect()}
    assert got == {(f"v{i}", f"v{j}"): i - j for i in range(200) for j in range(i)}
    loop = spark.createDataFrame([("s", "a", "b"), ("s", "b", "a")], v.schema)
    with pytest.raises(ValueError):
        versions.ancestry(loop, Scratch(spark))


def test_distances_of_a_long_chain(spark):
    e = spark.createDataFrame([(0, f"n{i}", f"n{i + 1}", 1) for i in range(12)], "session_id int, src string, dst string, weight int")
    d = graph.distances(e, spark.createDataFrame([(0, "n0")], "session_id int, node string"))
    assert {r.node: r.distance for r in d.collect()} == {f"n{i}": i for i in range(13)}
    need = spark.createDataFrame([(0, "q", "n0", "n12")], "session_id int, item string, start string, node string")
    assert graph.difficulty(need, d).head().difficulty == "hard"


def test_chinese_entities(spark):
    said = [("修改 缓存策略刷新", {"zh:缓存策略", "zh:存策略刷", "zh:策略刷新"}), ("把 `缓存策略` 改好", {"zh:缓存策略", "zhx:缓存策略"}), ("chunk_2 scope_3 stage_4 e12 widgetx", {"widgetx"}), ("数据记录", set()), (None, set())]
    got = spark.createDataFrame([(t,) for t, _ in said], "t string").select(X.entities(F.col("t")).alias("e")).collect()
    assert [set(r.e) for r in got] == [w for _, w in said]


INFO = "session_id string, id string, entities array<string>, paths array<string>, sources array<string>, labels array<string>, statement_labels array<string>, stages array<string>, qa_mode string, observed_failure boolean, lineage array<string>, versions array<string>, orders array<int>, public_evidence boolean"


def fact(i, entities=(), paths=(), labels=(), lineage=(), cited=(), public=False):
    return ("s", i, list(entities), list(paths), [f"e{i}"], list(labels), list(labels), [], "code", False, list(lineage), list(cited), [1], public)


@pytest.mark.parametrize(
    "a, b, score, linked",
    [
        (dict(entities=["widgetx", "logger"]), dict(entities=["widgetx", "logger"]), 3, True),  # one weak name says nothing
        (dict(entities=["client", "logger"]), dict(entities=["client", "logger"]), 6, True),  # two do
        (dict(entities=["logger"], paths=["p"]), dict(entities=["logger"], paths=["p"]), 2, False),
        (dict(entities=["zh:缓存策略"]), dict(entities=["zh:缓存策略"]), 0, False),  # a term alone may be chance
        (dict(entities=["zh:缓存策略"], labels=["decision"]), dict(entities=["zh:缓存策略"], labels=["feedback"]), 3, True),
        (dict(entities=["zhx:缓存策略"]), dict(entities=["zhx:缓存策略"]), 3, True),  # a marked one is not
        (dict(entities=["zh:缓存策略", "zh:存策略刷"]), dict(entities=["zh:缓存策略", "zh:存策略刷"]), 6, True),
        # public facts: a file name is no object, and a path needs an ancestor
        (dict(entities=["x.py"], paths=["x.py"], cited=["v2"], lineage=["v1"], public=True), dict(entities=["x.py"], paths=["x.py"], cited=["v3"], lineage=["v1"], public=True), 2, False),
        (dict(entities=["x.py"], paths=["x.py"], cited=["v2"], lineage=["v1"], public=True), dict(entities=["x.py"], paths=["x.py"], cited=["v1"], public=True), 2, True),
    ],
)
def test_pair_scores(spark, a, b, score, linked):
    info = spark.createDataFrame([fact("a", **a), fact("b", **b)], INFO)
    r = evidence.pair_scores(info).head()
    assert (r.score, r.linked) == (score, linked)


def test_contained_lines_against_brute_force(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdef") for _ in range(r.randrange(2, 6)))
    right = [" ".join(word() for _ in range(r.randrange(1, 25))) for _ in range(150)]
    left = [right[i] for i in range(5)] + ["first " + right[i] for i in range(5, 12)] + [right[i][5:] for i in range(12, 30)] + [right[i].replace("a", "b", 2) for i in range(30, 50)] + [right[50] + " " + right[51], "ab", "a"]

    def grams(t):
        return {t[i : i + 3] for i in range(len(t) - 2)} if len(t) > 3 else {t}

    want = {(x, y) for x in left for y in right if x.strip() and len(grams(x.strip()) & grams(y)) / min(len(grams(x.strip())), len(grams(y))) >= 0.78}
    frame = lambda ts: spark.createDataFrame([(t.strip(),) for t in set(ts)], "t string")
    got = {(x.l_t, x.r_t) for x in joins.contained_pairs(frame(left), frame(right), "t", Scratch(spark)).collect()}
    assert got == {(x.strip(), y) for x, y in want}


def test_contained_lines_of_a_held_table_shuffle_nothing(spark, monkeypatch):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdé𝒳") for _ in range(r.randrange(1, 6)))
    right = [" ".join(word() for _ in range(r.randrange(1, 400 if i % 9 == 0 else 20))) for i in range(90)] + ["ab", "", None]
    left = [*right[:40], *(x[3:60] for x in right[40:60]), "ab", "a", "", None]
    frame = lambda ts: spark.createDataFrame(list(enumerate(ts)), "id int, t string")
    pairs = lambda: joins.contained_pairs(frame(left), frame(right), "t", Scratch(spark), l_keep=["id"], r_keep=["id"])
    plan = pairs()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan
    held = sorted(map(tuple, pairs().collect()))
    monkeypatch.setattr(joins, "HELD", 0)
    assert held == sorted(map(tuple, pairs().collect())) and len(held) > 60


def test_novelty_fold_takes_few_rows_and_equals_the_plain_one(spark, monkeypatch):
    from evidra.operators import selection

    r = random.Random(3)
    rows = [(f"c{i:04}" if i != 7 else "c0006", i if i != 7 else 6, "m" if i % 3 else "n", r.choice(["approved", "approved", "rejected"]), r.choice("ab"), r.choice(["g", "h", None]), r.sample("uvwxyz", r.randrange(3)) if i > 9 else ["u", None], r.choice(["history_core", None])) for i in range(900)]
    c = spark.createDataFrame(rows, "id string, ord int, qa_mode string, status string, type string, evidence_group_id string, fact_ids array<string>, track string").withColumn("difficulty_distance", F.lit(0))
    types, groups, facts, want = set(), set(), set(), []
    left = [x for x in rows if x[2] == "m"]
    while left:
        best = max(left, key=lambda x: (x[4] not in types, (x[5] or x[0]) not in groups, len(set(x[6]) - facts), x[7] == "history_core"))
        left.remove(best)
        if best[3] != "approved" or sum(w[1] is not None for w in want) >= 5:
            want.append((best[0], None, "not_approved" if best[3] != "approved" else "over_quota"))
            continue
        types.add(best[4]), groups.add(best[5] or best[0]), facts.update(best[6])
        want.append((best[0], sum(w[1] is not None for w in want) + 1, "selected"))
    took, plain = [], selection._greedy
    monkeypatch.setattr(selection, "_greedy", lambda key, feat, *more: (took.append(feat.count()), plain(key, feat, *more))[1])
    got = selection.novelty_select(c, {"m": 5}).collect()
    assert sorted(((x.id, x.place, x.selection_status) for x in got if x.track == "m"), key=str) == sorted(want, key=str)
    assert {x.selection_status for x in got if x.track == "n"} == {"not_approved", "unknown_qa_mode"} and len(got) == 900 and took[0] < 450


def test_ancestry_writes_its_result_once(spark):
    v = spark.createDataFrame([("s", f"v{i}", f"v{i - 1}" if i else None) for i in range(40)] + [(None, "a", "b"), (None, "b", "c"), ("t", "m", "l"), ("t", "m", "r"), ("t", "l", "z"), ("t", "r", "z"), ("t", None, "m")], "session_id string, version_id string, previous string")
    saved = []

    class Counting(Scratch):
        def save(self, df, name):
            saved.append(name)
            return super().save(df, name)

    got = sorted(map(tuple, versions.ancestry(v, Counting(spark)).where("session_id is null or session_id = 't'").collect()), key=str)
    want = [(None, "a", "b", 1), (None, "b", "c", 1), *(("t", "m", x, 1) for x in "lr"), *(("t", x, "z", 1) for x in "lr"), *[("t", "m", "z", 2)] * 2, ("t", None, "m", 1), *(("t", None, x, 2) for x in "lr"), *[("t", None, "z", 3)] * 2]
    assert got == sorted(want, key=str) and len(saved) == 1


def test_credentials_of_odd_letters_and_long_texts_between_urls(spark):
    said = {"My pa\u017f\u017fword is hunter22": True, "the to\u212aen is abcd": True, "AP\u0130 KEY: zzz9 and ap\u0131 key is q9": True, "\u5bc6\u7801\u4e3a abc": True, "SK-" + "a" * 16: True, "Bearer abcdefgh": True,
            "-----BEGIN RSA private KEY-----": True, "HTTPS://a:b@c": True, "token=None": False, "access granted": False, "": False, None: False}
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(said)], "i int, t string").orderBy("i").select(X.credential_detected(F.col("t"))).collect()]
    assert got == list(said.values())
    long = "/home/ann x " * 3000
    texts = {long + "http://h/home/ann?e12 e12 http:// e12\n": "~ x " * 3000 + f"http://h/home/ann?e12 {X.INTERNAL_NAME} http:// {X.INTERNAL_NAME}\n", "e12 C:\\Users\\ann\\x": f"{X.INTERNAL_NAME} ~\\x", "": "", None: ""}
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(X.redact_paths(F.col("t"))).collect()]
    assert got == list(texts.values())


def test_privacy_gate_shuffles_digests(spark):
    from evidra.operators import selection

    q = spark.createDataFrame([(1, "t" * 50, "en")], "ord int, text string, qa_mode string")
    plan = selection.privacy_gate(q, "text").select("ord", "gate")._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2(" in plan[plan.index("Window") :]


def test_best_pairs_are_those_of_all_pairs(spark, monkeypatch):
    r = random.Random(8)
    words = [f"name{i}" for i in range(60)]
    some = lambda k, xs=words: r.sample(xs, min(k, len(xs)))
    rows = [("s" if i % 4 else "t", f"f{i:03}", some(r.randrange(7)), some(r.randrange(2), ["p1", "p2", "p3"]) if i % 4 else [], [f"e{i // 2 if i % 9 == 0 else i}"], some(r.randrange(3), ["failure", "change", "decision"]) if i % 4 else ["constraint"]) for i in range(160)]
    info = spark.createDataFrame(rows, "session_id string, id string, entities array<string>, paths array<string>, sources array<string>, labels array<string>")
    info = info.withColumn("stages", F.array().cast("array<string>")).withColumn("lineage", F.col("stages")).withColumn("qa_mode", F.lit("general")).withColumn("observed_failure", F.lit(False)).withColumn("orders", F.array(F.lit(1)))
    monkeypatch.setattr(evidence, "TILE", 5)

    def top(df):
        by = {}
        for x in df.where("linked").collect():
            for a, b in ((x.a, x.b), (x.b, x.a)):
                by.setdefault((x.session_id, a), set()).add((-x.score, b))
        return {k: sorted(v)[:3] for k, v in by.items()}

    whole = evidence.pair_scores(info)
    assert top(evidence.best_pairs(info, Scratch(spark))) == top(whole)
    linked = [(x.a, x.b) for x in whole.collect()]
    share = {(a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[1] < b[1] and any(set(a[c]) & set(b[c]) for c in (2, 3, 4))}
    assert len(linked) == len(set(linked)) and set(linked) == share  # no posting is thinned


def test_all_pairs_of_a_common_entity_are_scored(spark):
    rows = [("s", f"f{i:03}", ["cache"], [f"e{i}"]) for i in range(150)]
    info = spark.createDataFrame(rows, "session_id string, id string, entities array<string>, sources array<string>").withColumn("paths", F.array().cast("array<string>"))
    info = info.withColumn("stages", F.col("paths")).withColumn("lineage", F.col("paths")).withColumn("labels", F.col("paths")).withColumn("qa_mode", F.lit("general")).withColumn("observed_failure", F.lit(False)).withColumn("orders", F.array(F.lit(1)))
    assert evidence.pair_scores(info).count() == 150 * 149 // 2


def test_reviewed_duplicates_fold_only_rows_that_meet(spark, monkeypatch):
    from evidra.operators import selection

    r = random.Random(4)
    rows = [(f"c{i:03}", i, "m", r.choice(["approved", "rejected"]), f"q{i if i % 5 else 0}", "target", [(x, r.sample(["a", "b", "c"], 1)) for x in r.sample([f"w{j}" for j in range(8)] if i < 80 else [f"own{i}"], r.randrange(1, 4) if i < 80 else 1)]) for i in range(300)]
    c = spark.createDataFrame(rows, "id string, ord int, qa_mode string, status string, question string, answer_target string, points array<struct<text:string,sources:array<string>>>")
    feat = selection.features(c)
    exact = {x.id: x.duplicate_of for x in selection.exact_duplicates(feat).collect()}
    kept, want = [], [(i, d) for i, d in exact.items() if d]
    for x in sorted((x for x in feat.collect() if not exact[x.id]), key=lambda x: tuple(x["rank"])):
        cl, so = set(x.claims), set(x.answer_sources)
        win = next((k for k in kept if (k[3] == x.conditions) and so & k[2] and (cl <= k[1] or k[1] <= cl)), None)
        want.append((x.id, win[0])) if win else kept.append((x.id, cl, so, x.conditions))
    took, plain = [], selection._greedy
    monkeypatch.setattr(selection, "_greedy", lambda key, df, *more: (took.append(df.count()), plain(key, df, *more))[1])
    assert sorted((x.id, x.duplicate_of) for x in selection.reviewed_duplicates(feat, Scratch(spark)).collect()) == sorted(want)
    assert took[0] <= 80 and len(want) > 5
