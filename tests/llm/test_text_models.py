import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from evidra.llm import language, mixing, packing, resampling
from evidra.llm import words as W
from evidra.llm.common import Scratch
from evidra.llm.queries import vocabulary

from .conftest import WORDS, docs_of, prose


def test_word_hashes_follow_the_words():
    texts = ["Hello, big  WORLD", "", "hello, big world", "x", "\tä b\n", "big"]
    raw = [t.encode() for t in texts]
    data, bounds = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    starts, ends, first = W.split(data, bounds)
    h = W.hashes(data, starts, ends)
    words = [w for r in raw for w in r.lower().split()]
    assert np.diff(first).tolist() == [len(r.split()) for r in raw]
    assert len(set(zip(words, h.tolist()))) == len(set(words)) == len(set(h.tolist()))
    x, begin = W.shingles(h, first, 2)
    assert np.diff(begin).tolist() == [2, 0, 2, 1, 1, 1] and x[0] == x[2] and x[1] == x[3]


def quality_docs(spark):
    r = random.Random(2)
    good = [prose(1000 + i, 60) for i in range(60)]
    bad = [" | ".join(r.choice(WORDS) + "***" for _ in range(40)) for _ in range(30)]
    docs = docs_of(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(0, 90, 2)] + [(None, 1, 0), (1, None, 0), (3, 1, None)], "doc_id bigint, quality int, toxic int")
    return docs, labels


def test_resampling_parts_good_from_bad_and_takes_k(spark):
    docs, labels = quality_docs(spark)
    kept = {r.doc_id for r in resampling.keep(docs, labels).collect()}
    assert len(kept & set(range(60))) >= 58 and len(kept - set(range(60))) <= 2
    for k in (0, 7, 90, 200):
        assert sum(r.kept for r in resampling.scores(docs, labels, Scratch(spark), k=k).collect()) == min(k, 90)


def grams(text):
    """N-grams of a text, as strings, by plain Python."""
    words = re.findall(rb"[0-9A-Za-z_\x80-\xff]+|[^0-9A-Za-z_\x80-\xff\x20\x09-\x0d]+", text.encode().lower())
    return words + list(zip(words, words[1:]))


def test_resampling_against_brute_force(spark):
    docs, labels = quality_docs(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = {i for i in range(0, 60, 2)} | {3}
    raw, target = (Counter(g for i in ids for g in grams(texts[i])) for ids in (texts, good))
    scale, add = target.total() / raw.total(), resampling.SMOOTHING
    want = {i: sum(np.log((target[g] + add) / (raw[g] * scale + add)) for g in grams(t)) for i, t in texts.items()}
    got = {r.id: r for r in resampling.scores(docs, labels, Scratch(spark)).collect()}
    for i, w in want.items():  # but for n-grams that share a bucket
        assert abs(got[i].log_weight - w) < 0.02 * abs(w) + 0.5
    known = {i: int(i < 60) for i in range(0, 90, 2)} | {3: 1}
    k = round(len(texts) * sum(known.values()) / len(known))
    first = sorted(got, key=lambda i: -got[i].key)[:k]
    assert {i for i, r in got.items() if r.kept} == set(first)


def test_resampling_inclusion_follows_the_weights(spark):
    from pyspark.sql import functions as F

    n, k = 40_000, 2_000  # a fourth of the rows have each of the weights 1, 2, 3, 4
    rows = spark.range(n).withColumn("w", F.col("id") % 4 + 1).withColumn("key", F.log("w") + resampling.gumbel(F.col("id")))
    v, _ = resampling.kth_largest(rows, "key", k)
    got = {r.w: r["count"] for r in rows.where(F.col("key") >= v).groupBy("w").count().collect()}
    lam = 0.0  # a row of weight w is among the k with probability 1 - exp(-w lam)
    while sum(n / 4 * (1 - np.exp(-w * lam)) for w in (1, 2, 3, 4)) < k:
        lam += 1e-5
    for w in (1, 2, 3, 4):
        want = n / 4 * (1 - np.exp(-w * lam))
        assert abs(got[w] - want) < 4 * want**0.5
    assert sum(got.values()) == k


def test_kth_largest(spark):
    r = random.Random(4)
    v = [r.choice([1.5, r.random(), r.gauss(0, 1e6)]) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in v], "x double")
    for k in (1, 10, 1500, 3000):
        got, above = resampling.kth_largest(df, "x", k, most=50)
        assert got == sorted(v, reverse=True)[k - 1] and above == sum(x > got for x in v)


def test_resampling_edge_cases(spark, edge, empty):
    docs, labels = quality_docs(spark)
    none = labels.limit(0)
    for lab in (labels, none):
        got = resampling.keep(edge, lab)
        assert got.columns == edge.columns
        assert resampling.scores(edge, lab, Scratch(spark)).count() == edge.count()
        assert resampling.keep(empty, lab).count() == 0
    assert resampling.keep(edge, none).count() == edge.count()


ODD = ["it's I'M don't ÀÉÎ ß ſ İ ŉ x²³ 1½ <|endoftext|> <|x '' 's \xa0 a­b Σς ΑΣ", "", "  ", "a\x1fb\x85c", "'s's'll'", "ﬁ é é ǅ", "\r\n\t", "漢字 и ещё", "\u0301x \u0301", "a\x0bb\x0cc", "×a÷b éx×", "a<|ENDOFTEXT|>b A<|endoftext|>B", "—“x”…", "İstanbul ŉa ſt"]


def test_encoder_equals_the_tokenizer():
    e = packing.Encoder(vocabulary())
    r = random.Random(1)
    random_texts = ["".join(r.choice("aA'sStTé2½ \n.,!<|>ªµßøÿĀŉ×÷_-\u00ad\x0b\x1c漢İ\u0301") for _ in range(300)) for _ in range(80)]
    texts = [*ODD, *random_texts, prose(5, 500)]
    for t in texts:
        assert e(t).tolist() == e.whole(t).tolist(), t
    raw = [t.encode() for t in texts]
    for _ in range(2):
        ids, begin = e.many(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]))
        for i, t in enumerate(texts):
            assert ids[begin[i] : begin[i + 1]].tolist() == e.whole(t).tolist(), t
        e.forget()


def check_packing(rows, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary())
    want = sorted((d if d is not None else -1, i // 2048, i, len(ids[i : i + 2048]), zlib.crc32(np.array(ids[i : i + 2048], "<u4").tobytes())) for d, text in docs for ids in [t.encode(text or "", add_special_tokens=False).ids + [0]] for i in range(0, len(ids), 2048))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return len(by), sum(r.length for r in rows)


def test_packing(spark, edge, edge_rows, empty):
    n, total = check_packing(packing.pack_documents(edge, vocabulary()).collect(), [(r[0], r[1]) for r in edge_rows])
    assert n <= -(-total // 2048) + 1
    assert packing.pack_documents(empty, vocabulary()).count() == 0
    texts = [prose(i, 20 + 37 * (i % 30)) for i in range(300)]
    n, total = check_packing(packing.pack_documents(docs_of(spark, texts).repartition(7), vocabulary()).collect(), list(enumerate(texts)))
    assert n <= -(-total // 2048) + 1


def test_rounds_join_what_tasks_left_apart(spark):
    items = spark.createDataFrame([(i, 700 + i % 5) for i in range(90)], "doc_id bigint, length bigint").repartition(30)
    got = packing.pack(items, Scratch(spark)).collect()
    assert len(got) == 90 and len({r.sequence_id for r in got}) == 45


@pytest.mark.parametrize("most", [60, 250, 1000])
def test_rounds_of_many_tasks_reach_the_bound(spark, most):
    r = random.Random(12)
    sizes = [min(2048, max(1, round(r.lognormvariate(5, 1.3)))) for _ in range(4000)] + [1, 1, 2048, 2047]
    items = spark.createDataFrame(list(enumerate(sizes)), "doc_id bigint, length bigint").repartition(9)
    got = packing.pack(items, Scratch(spark), most=most).collect()
    assert sorted(x.doc_id for x in got) == list(range(len(sizes)))
    by = {}
    for x in sorted(got, key=lambda x: (x.sequence_id, x.offset)):
        assert x.offset == by.get(x.sequence_id, 0)
        by[x.sequence_id] = x.offset + x.length
    assert max(by.values()) <= 2048 and sum(v <= 1024 for v in by.values()) <= 1
    assert len(by) <= 1.005 * -(-sum(sizes) // 2048) + (most < 100) * 4


def test_best_fit_never_overfills():
    r = random.Random(8)
    for _ in range(50):
        sizes = [r.randrange(1, 101) for _ in range(r.randrange(0, 60))]
        bins, offsets = packing.best_fit(sizes, 100)
        fill = {}
        for s, b, o in sorted(zip(sizes, bins, offsets), key=lambda x: (x[1], x[2])):
            assert o == fill.get(b, 0)
            fill[b] = o + s
        assert all(f <= 100 for f in fill.values())


LANGS = {"en": "the and ing tion of this with that".split(), "de": "und der ich sch ein nicht zu heit".split(), "fr": "le que eaux ment une est avec ère".split()}


def speech(lang, seed, n=60):
    r = random.Random(seed)
    return " ".join("".join(r.choice(LANGS[lang]) for _ in range(r.randrange(1, 3))) for _ in range(n))


def test_language_on_held_out_texts_and_code_switching(spark):
    rows = [(i, speech(lang, i), lang) for i, lang in enumerate(list(LANGS) * 60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    field = language.train(docs)
    got = {r.doc_id: r for r in language.predict(docs, field).collect()}
    out = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(out) > 30 and sum(got[i].lang_pred == rows[i][2] for i in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in got.values())
    mixed = speech("en", 900, 30) + " " + speech("de", 901, 30)
    spans = language.predict(docs_of(spark, [mixed]), field, spans=True).head().spans
    cut = len(mixed) // 2
    share = lambda lang, a, b: sum(min(s.end, b) - max(s.start, a) for s in spans if s.lang == lang and s.start < b and s.end > a)
    assert share("en", 0, cut) > 0.8 * cut and share("de", cut, len(mixed)) > 0.8 * cut


def test_posteriors_against_enumeration():
    f = language.Field(["a", "b"])
    f.step[:] = [[0.3, -0.2], [0.1, 0.5]]
    e = np.random.default_rng(1).normal(size=(7, 2))
    first = np.array([0, 4, 4, 7])
    got, moves = f.posteriors(e, first, pairs=True)
    import itertools

    want, pairs = np.zeros_like(e), np.zeros((2, 2))
    for i, j in zip(first[:-1], first[1:]):
        total = 0
        part, two = np.zeros((j - i, 2)), np.zeros((2, 2))
        for path in itertools.product(range(2), repeat=j - i) if j > i else []:
            p = np.exp(sum(e[i + t, y] for t, y in enumerate(path)) + sum(f.step[a, b] for a, b in zip(path, path[1:])))
            total += p
            for t, y in enumerate(path):
                part[t, y] += p
            for a, b in zip(path, path[1:]):
                two[a, b] += p
        if j > i:
            want[i:j] = part / total
            pairs += two / total
    assert np.allclose(got, want) and np.allclose(moves, pairs)


def test_language_learns_from_short_and_long_texts(spark):
    few = {"aa": "baka lumo", "bb": "xerth quilp"}
    rows = [(i, (w + " ") * n, lang) for n, part in ((2, 0), (2000, 1)) for i, (lang, w) in enumerate(list(few.items()) * 30, 100 * part)]
    for some in (rows[:60], rows[60:], [r for r in rows if (r[2] == "aa") == (r[0] < 100)]):
        docs = spark.createDataFrame(some, "doc_id bigint, text string, lang string")
        field = language.train(docs)
        assert field is not None and field.langs == ["aa", "bb"]
        got = {r.doc_id: r.lang_pred for r in language.predict(docs, field).collect()}
        assert got == {r[0]: r[2] for r in some}


def test_language_edge_cases(spark, edge, edge_rows, empty):
    field = language.train(edge)
    got = language.predict(edge, field).collect()
    assert len(got) == len(edge_rows)
    lettered = [bool(r[1]) and any(c.isalpha() for c in r[1]) for r in edge_rows]
    assert [r.lang_pred != "und" for r in got] == lettered
    assert language.train(empty) is None and language.predict(empty, None).count() == 0
    assert {r.lang_pred for r in language.predict(edge, None).collect()} == {"und"}
    assert language.predict(edge, field, spans=True).count() == len(edge_rows)


def test_mixing_meets_its_targets(spark):
    rows = [(i, speech(lang, i, 40 + i % 20), None if i % 7 == 0 else lang) for i, lang in enumerate(["en"] * 120 + ["de"] * 40 + ["fr"] * 20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    want = {"en": 0.5, "de": 0.3, "fr": 0.2}
    got = mixing.memberships(docs, Scratch(spark), want).collect()
    assert len(got) == len(rows) and all(r.rate >= 0 for r in got)
    total = sum(r.tokens for r in got)
    for d, share in want.items():
        assert abs(sum(r.tokens * r.rate * r.posterior[d] for r in got) / total - share) < 0.01
    assert all(abs(r.copies - r.rate) < 1 for r in got)
    n = {r.doc_id: r.copies for r in got}
    mixed = mixing.mix(docs, want)
    assert mixed.columns == docs.columns
    seen = {}
    for r in mixed.collect():
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {k: v for k, v in n.items() if v}


def solved(tokens, p, aim, ridge=mixing.RIDGE):
    """Rates by plain projected gradient with momentum, run to its end."""
    size, r, t = tokens @ p, np.ones(len(tokens)), 1.0
    z = r.copy()
    for _ in range(100_000):
        g = p @ ((tokens * z) @ p / size - aim / size) + ridge * (z - 1)
        n = np.maximum(0, z - g / (1 + ridge))
        t = 1.0 if g @ (tokens * (n - r)) > 0 else t
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        z, r, t = n + (t - 1) / t2 * (n - r), n, t2
    return r


def test_mixing_against_brute_force(spark):
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.3, 0.3, 0.3], 40)
    tokens = rng.integers(1, 1000, 40)
    names = ["a", "b", "c"]
    cells = spark.createDataFrame([(str(i), int(n), [float(x) for x in q]) for i, (n, q) in enumerate(zip(tokens, p))], "cell string, tokens bigint, p array<double>")
    for want in ({"a": 0.98, "b": 0.01, "c": 0.01}, {"a": 1, "b": 1, "c": 1}, {"b": 1.0}):
        pulls, got = mixing.fit(cells, names, want)
        aim = np.array([want.get(d, 0.0) for d in names]) / sum(want.values()) * tokens.sum()
        rates = solved(tokens.astype(float), p, aim)
        assert np.allclose(np.maximum(0, 1 - p @ np.array(pulls)), rates, atol=1e-5)
        for d, m, a in zip(names, (tokens * rates) @ p / tokens.sum(), aim / tokens.sum()):
            assert abs(got[d][0] - a) < 1e-12 and abs(got[d][1] - m) < 1e-6


def test_mixing_of_a_domain_of_one_document(spark):
    docs = spark.createDataFrame([(i, speech("en", i), "en") for i in range(20)] + [(99, speech("fr", 5), "fr")], "doc_id bigint, text string, lang string")
    marks, _ = mixing.cells(docs, Scratch(spark), "lang", "doc_id", "text")
    assert set(marks) == {"en", "fr"}


def test_mixing_edge_cases(spark, edge, edge_rows, empty):
    got = mixing.memberships(edge, Scratch(spark), tokens="t0", posterior="p0", rate="r0", copies="c0").collect()
    assert len(got) == len(edge_rows)
    assert mixing.mix(edge).columns == edge.columns
    assert mixing.mix(empty).count() == 0
    no_lang = edge.drop("lang").selectExpr("*", "cast(null as string) as lang")
    assert mixing.mix(no_lang).count() == len(edge_rows)


@pytest.mark.parametrize("name", ["python", "pandas", "arrow"])
def test_mixing_stays_native(spark, name):
    docs = docs_of(spark, [prose(i, 30) for i in range(20)])
    plan = mixing.mix(docs)._jdf.queryExecution().toString().lower()
    assert f"{name}udf" not in plan and f"{name}eval" not in plan and "mapin" not in plan
