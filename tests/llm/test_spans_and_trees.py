import hashlib
import random
import re
import tempfile
import time
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evidra.llm import chat_format, merkle, passages, pii
from evidra.llm.common import Scratch

from .conftest import SHAPE, docs_of, prose


def plain_base(text):
    """The contract's base kinds by plain finditer."""
    pats = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def luhn(s):
        d = [int(c) for c in s][::-1]
        return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0

    out = []
    for k, (kind, p) in enumerate(pats.items()):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), k, kind, m.end()))
    return [(a, kind, b) for a, _, kind, b in sorted(out)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab@.-+%_ 0123456789()é\n", max_size=120))
def test_base_spans_equal_plain_matches(text):
    assert [(a, k, b) for a, k, b, _ in pii.spans(text) if k in pii.BASE] == plain_base(text)


def test_known_spans():
    t = "mail a.b@c.example, card 4111 1111 1111 1111, not 4111 1111 1111 1112, tel +49 (0)30 1234567, ip 10.0.0.256 or 10.0.0.25, iban DE89 3704 0044 0532 0130 00."
    assert [(k, t[a:b]) for a, k, b, _ in pii.spans(t)] == [("email", "a.b@c.example"), ("card", "4111 1111 1111 1111"), ("phone", "+49 (0)30 1234567"), ("ip", "10.0.0.25"), ("iban", "DE89 3704 0044 0532 0130 00")]
    near = {k: s for _, k, _, s in pii.spans(t)}
    assert near["phone"] > {k: s for _, k, _, s in pii.spans("version +49 (0)30 1234567")}["phone"]


def test_extreme_digits_and_ibans():
    zeros = "0" * 5000
    for t, want in ((zeros + ".1.1.1", [("ip", 0, 5006)]), (zeros + "256.1.1.1", []), ("1." + zeros + "1.2.3 x", [("ip", 0, 5007)]), ("1.2.3.4.5.6.7.8", [("ip", 0, 7), ("ip", 8, 15)])):
        assert [(k, a, b) for a, k, b, _ in pii.spans(t)] == want
    for t in ("7" * 1_000_000, "+" * 100_000, "1 " * 300_000, "a@" * 200_000, "A1" * 300_000, "1." * 300_000):
        began = time.time()
        pii.spans(t)
        assert time.time() - began < 10
    iban = "ES91 2100 0418 4502 0005 1332"
    for t in (iban, iban + " TEST", iban + " TEST AGAIN", iban + " " + iban):
        assert [t[a:b] for a, k, b, _ in pii.spans(t) if k == "iban"] == [iban] * (1 + (t.count("ES91") > 1)), t


def test_pii_query_columns(spark, edge_rows):
    from evidra.llm.queries import QUERIES

    rows = [*edge_rows, (90, "a@b.example +49 30 1234567 10.0.0.1 4111111111111111 DE89370400440532013000", *[None] * 12)]
    with tempfile.TemporaryDirectory() as d:
        spark.createDataFrame(rows, SHAPE).write.parquet(f"{d}/documents.parquet")
        got = sorted(QUERIES["op8_pii"](spark, d).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.base_sha256, r.spans))
    want = []
    for r in rows:
        base = plain_base(r[1] or "")
        said = ",".join(f"{k}:{a}:{b}" for a, k, b in base)
        n = Counter(k for _, k, _ in base)
        want.append((r[0] is None, r[0] or 0, hashlib.sha256(said.encode()).hexdigest(), n["email"], n["ip"], n["card"], n["phone"]))
    assert sorted(want) == sorted((r.doc_id is None, r.doc_id or 0, r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got)
    assert [r.spans.count("iban") for r in got if r.doc_id == 90] == [1]


def test_pii_edge_cases(edge, edge_rows, empty):
    assert pii.scan(edge).count() == len(edge_rows) and pii.scan(empty).count() == 0
    got = pii.redact(edge)
    assert got.columns == edge.columns and [r.text for r in got.collect()] == [r[1] for r in edge_rows]


NASTY = [None, "", "\\### Assistant: </turn> ok", "</turn>\n### user[0]: hi</turn>\n", "\\t\\h\\b\\", "####", "</turn", "]: [1]: x", "plain", "### assistant[2]: eA==</turn>", "\n", "a\u0000b", "é漢🙂"]


def conversations(spark):
    r = random.Random(6)
    rows = [(c, t, r.choice(["user", "assistant", "system", None, "we]: ird[0]"]), r.choice(NASTY), "x") for c in range(12) for t in range(r.randrange(1, 9))]
    rows += [(3, 0, "user", "again", "x")] * 2 + [(None, None, None, None, None)]
    return rows, spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, formatted string")


def test_chat_round_trip(spark):
    rows, df = conversations(spark)
    out = chat_format.format_conversations(df).select("conv_id", "formatted", "mask", chat_format.parse_all(F.col("formatted")).alias("turns"), chat_format.loss_text(F.col("formatted"), F.col("mask")).alias("loss")).collect()
    want = defaultdict(list)
    for c, t, role, text, _ in rows:
        want[c].append(((t is not None, t or 0), role or "", text or ""))
    assert len(out) == len(want)
    for r in out:
        turns = [(a, b) for _, a, b in sorted(want[r.conv_id])]
        assert [(t.role, t.text) for t in r.turns] == turns
        assert r.loss == "".join(b for a, b in turns if a == "assistant")
        for t, m in zip(r.turns, r.mask):
            body = r.formatted[m.start : m.start + m.length]
            assert m.level != "0" or body == t.text


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="\\</turn>#bht]:[ \n0", max_size=30), min_size=1, max_size=20))
def test_escapes_are_reversible(texts):
    def put(s, pairs):
        for a, b in pairs:
            s = s.replace(a, b)
        return s

    for t in texts:
        coded = put(t, chat_format.CODES)
        assert "</turn>" not in coded and "###" not in coded
        assert put(coded, [(b, a) for a, b in reversed(chat_format.CODES)]) == t


def test_chat_empty(spark):
    assert chat_format.format_conversations(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


def sha(letter, parts):
    return hashlib.sha256((letter + "".join(parts)).encode()).hexdigest()


def root(text):
    section = lambda s: sha("s", [sha("p", [sha("l", [x]) for x in re.split(r"(?<=[.!?] )", p)]) for p in s.split("\n")])
    return sha("r", [section(s) for s in text.split("\n\n")])


def compare(rows, got):
    order = sorted(((d is None, d or 0, t or "") for d, t in rows))
    assert len(got) == len(rows)
    want = []
    for i, (_, d, t) in enumerate(order):
        nxt = order[(i + 1) % len(order)][2]
        h = len(t) // 2
        e = t[: len(t) - h] + nxt[:h]
        want.append((order[i][0], d, len(t), hashlib.sha256(e.encode()).hexdigest(), root(t), root(e)))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in got) == sorted(want)
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and (r.near_edited == 1) == (r.fingerprint == r.edited_fingerprint)


def test_merkle_against_brute_force(spark, edge, edge_rows, empty):
    compare([(r[0], r[1]) for r in edge_rows], merkle.compare_edits(edge).collect())
    assert merkle.compare_edits(empty).count() == 0
    texts = [prose(i, 1 + 7 * (i % 40)).replace(", ", "\n", 3).replace(". ", "\n\n", 1) for i in range(2500)]
    rows = list(enumerate(texts))
    compare(rows, merkle.compare_edits(docs_of(spark, texts).repartition(5)).collect())
    compare(rows[:1], merkle.compare_edits(docs_of(spark, texts[:1])).collect())


def test_merkle_ranges_cover_every_id(spark):
    values = [-1, 0, 1, 2, 3, 5, 6, 250, 496, 497, 499, 1000]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v bigint")
    for bounds in ([], [5], [1, 2, 3], list(range(0, 500, 7))):
        got = {r.v: r.b for r in df.select("v", merkle._bucket(F.col("v"), bounds).alias("b")).collect()}
        assert got == {v: bisect_left(bounds, v) for v in values} | {None: len(bounds)}


def test_merkle_branches_locate_edits(spark):
    text = "One one. Two two.\nThree three. Four.\n\nFive five. Six."
    edited = text.replace("Four", "Fore")
    df = spark.createDataFrame([(1, text), (2, edited), (3, "Other.\n\nWords here.")], "id int, text string")
    trees = {r.id: r for r in merkle.with_tree(df, "text", "root", "nodes").collect()}
    one = spark.createDataFrame([(trees[1].nodes, trees[2].nodes, trees[3].nodes)], "a array<bigint>, b array<bigint>, c array<bigint>")
    there, none, every = one.select(merkle.differing(F.col("a"), F.col("b")), merkle.differing(F.col("a"), F.col("a")), merkle.differing(F.col("a"), F.col("c"))).head()
    # root, the section, the paragraph and the sentence of the edit, and nothing else
    assert len(there) == 4 and none == [] and len(every) == len(trees[1].nodes)
    assert trees[1].root != trees[2].root


def plant():
    p = [prose(500 + i, 70) for i in range(3)]
    texts = [prose(i, 150) for i in range(30)]
    for i, k in ((3, 0), (7, 0), (11, 0), (12, 1), (20, 1), (25, 2)):
        w = texts[i].split()
        texts[i] = " ".join(w[:60] + p[k].split() + w[60:])
    w = p[2].split()
    w[30] = "changed"
    texts[28] = " ".join(w)
    return texts


def test_planted_passages(spark):
    texts = plant()
    got = passages.passages(docs_of(spark, texts), Scratch(spark))
    rows = got.collect()
    assert {r.doc_id for r in rows} == {3, 7, 11, 12, 20, 25, 28}
    for r in rows:
        if r.doc_id in (3, 7, 11, 12, 20):
            assert r.start_word <= 62 and r.end_word >= 127 and r.similarity >= 0.8
    shown = passages.passage_texts(docs_of(spark, texts), got.where("doc_id = 7")).head().passage
    assert prose(500, 70)[:40] in shown


def test_passages_behind_common_lines(spark):
    """Passages that hold a line which many unrelated documents have, the smallest of all among them."""
    line = prose(77, 14)
    texts = [prose(3000 + i, 40) + " " + line + " " + prose(4000 + i, 40) for i in range(40)]
    want = set()
    for g in range(6):
        p = prose(5000 + g, 25) + " " + line + " " + prose(6000 + g, 25)
        for k in range(2):
            want.add(len(texts))
            texts.append(prose(7000 + 2 * g + k, 60) + " " + p + " " + prose(8000 + 2 * g + k, 60))
    for rounds in (passages.ROUNDS, None):
        got = {r.doc_id for r in passages.passages(docs_of(spark, texts), Scratch(spark), rounds=rounds).collect()}
        assert got == want


def test_near_passages_are_found(spark):
    """Recall of passages of 64 and of 51 words with one word changed, at any place."""
    r, texts = random.Random(21), []
    for i in range(150):
        n = 64 if i % 2 else 51
        p = prose(9000 + i, n).split()
        q = list(p)
        q[r.randrange(n)] = f"changed{i}"
        texts += [prose(10_000 + i, 30) + " " + " ".join(p) + " " + prose(11_000 + i, 30), prose(12_000 + i, 30) + " " + " ".join(q) + " " + prose(13_000 + i, 30)]
    got = {x.doc_id for x in passages.passages(docs_of(spark, texts), Scratch(spark)).collect()}
    both = [{2 * i, 2 * i + 1} <= got for i in range(150)]
    assert sum(both[1::2]) >= 74 and sum(both[::2]) >= 70


def test_passages_alike_one_that_a_pivot_explains(spark):
    """The second of three is alike the first and the third, which are not alike: the third is tied to the second."""
    texts = []
    for i in range(40):
        p = prose(20_000 + i, 60).split()
        for k in range(3):
            q = list(p)
            q[15] = f"changed{i}" if k else q[15]
            q[45] = f"other{i}" if k == 2 else q[45]
            texts.append(" ".join(q))
    rows = passages.passages(docs_of(spark, texts), Scratch(spark)).collect()
    links = {(r.class_doc, r.doc_id) for r in rows}
    assert not any((3 * i, 3 * i + 2) in links for i in range(40))
    assert sum((3 * i, 3 * i + 1) in links and (3 * i + 1, 3 * i + 2) in links for i in range(40)) >= 37


def test_passages_behind_many_unlike_texts(spark):
    """Pairs whose common block nine smaller documents have amid other words: more than a few pivots would get to."""
    texts = []
    for g in range(20):
        block = prose(30_000 + g, 30)
        texts += [prose(31_000 + 20 * g + k, 15) + " " + block + " " + prose(32_000 + 20 * g + k, 15) for k in range(9)]
        texts += [prose(33_000 + g, 15) + " " + block + " " + prose(34_000 + g, 15)] * 2
    rows = passages.passages(docs_of(spark, texts), Scratch(spark)).collect()
    assert {r.doc_id for r in rows} == {11 * g + k for g in range(20) for k in (9, 10)}


def test_ties_against_brute_force():
    rng = np.random.default_rng(5)
    for turn in range(30):
        base = rng.integers(0, 2**32, (4, 60), np.uint64).astype(np.uint32)
        tokens = []
        for _ in range(25):
            t = base[rng.integers(4)].copy()
            t[rng.integers(0, 60, rng.integers(0, 9))] = rng.integers(0, 2**32, 1, np.uint64).astype(np.uint32)
            tokens.append(np.concatenate([base[0][:5], t[rng.integers(0, 5) :]]) if turn % 3 else t[rng.integers(0, 50, 60)])
        docs = rng.permutation(25).tolist()
        known = [rng.random(25) < 0.1, rng.random(25) < 0.1]

        def parts(pairs):
            comp = list(range(25))
            for i, j in pairs:
                comp = [comp[j] if c == comp[i] else c for c in comp]
            return {frozenset(k for k in range(25) if comp[k] == c) for c in comp}

        given = [(i, j) for f in known for i in np.flatnonzero(f).tolist() for j in np.flatnonzero(f).tolist()]
        want = [(i, j) for i in range(25) for j in range(25) if docs[i] > docs[j] and passages.alike(tokens[i], tokens[j])]
        got = passages.ties(docs, tokens, known)
        assert all(docs[i] > docs[j] and found for i, j, found in got)
        assert parts(given + [(i, j) for i, j, _ in got]) == parts(given + want)


def test_near_excerpts_leave_no_passage_out():
    rng = np.random.default_rng(8)
    for turn in range(30):
        base = rng.integers(0, 2**32, (3, 90), np.uint64).astype(np.uint32)
        tokens = []
        for _ in range(20):
            t = base[rng.integers(3)].copy()
            t[rng.integers(0, 90, rng.integers(0, 14))] = rng.integers(0, 2**32, 1, np.uint64).astype(np.uint32)
            tokens.append(np.concatenate([base[0][:20], t[rng.integers(0, 40) :], t[: rng.integers(0, 60)]]) if turn % 2 else t[rng.integers(0, 40, 70)])
        near, some = passages.near_excerpts(tokens), 0
        for i in range(20):
            found = [j for j in range(20) if passages.alike(tokens[i], tokens[j]) or passages.alike(tokens[j], tokens[i])]
            assert near(i)[found].all()
            some += len(found) - 1
        assert some or not turn % 2
    line = rng.integers(0, 2**32, 38, np.uint64).astype(np.uint32)
    unlike = [np.concatenate([line, rng.integers(0, 2**32, 60, np.uint64).astype(np.uint32)]) for _ in range(200)]
    assert [np.flatnonzero(passages.near_excerpts(unlike)(i)).tolist() for i in (0, 50)] == [[0], [50]]


def test_equal_texts_travel_once(spark):
    """Of copies that meet behind an unlike text, one goes to the comparison with its tokens, once for a key, and all are tied."""

    class Counting(Scratch):
        def save(self, df, name):
            out = super().save(df, name)
            if name == "cuts_pairs":
                rows.append(out.count())
            return out

    rows, block = [], prose(40_000, 30)
    copy = prose(40_001, 15) + " " + block + " " + prose(40_002, 15)
    texts = [prose(41_000 + k, 15) + " " + block + " " + prose(42_000 + k, 15) for k in range(3)] + [copy] * 50
    got = passages.passages(docs_of(spark, texts), Counting(spark)).collect()
    assert {r.doc_id for r in got} == set(range(3, 53))
    assert 0 < rows[0] <= 4 * 4


def test_window_pairs_against_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(100):
        c = rng.integers(0, 200, 30)
        a, z = c - rng.integers(0, 80, 30), c + rng.integers(0, 80, 30)
        i, j = passages.window_pairs(a, c, z, 20)
        want = {(x, y) for x in range(30) for y in range(x) if c[x] != c[y] and max(a[x], a[y]) <= min(c[x], c[y]) and max(c[x], c[y]) <= min(z[x], z[y]) and min(z[x], z[y]) - max(a[x], a[y]) + 1 >= 20}
        got = [(max(x, y), min(x, y)) for x, y in zip(i.tolist(), j.tolist())]
        assert len(got) == len(set(got)) and set(got) == want


def test_one_id_with_two_texts_is_one_document(spark):
    p = prose(70, 80)
    df = spark.createDataFrame([(1, "a " + p), (1, "b " + prose(71, 90)), (2, p)], "doc_id bigint, text string")
    assert {r.doc_id for r in passages.passages(df, Scratch(spark)).collect()} == {1, 2}


def test_passage_edge_cases(spark, edge, empty):
    got = {r.doc_id for r in passages.passages(edge, Scratch(spark)).collect()}
    assert got == {6, 9, 13, 14}
    assert passages.passages(empty, Scratch(spark)).count() == 0


def test_texts_that_repeat_themselves(spark):
    line = prose(9, 30) + " "
    got = {r.doc_id for r in passages.passages(docs_of(spark, [line * 6, line * 6, prose(10, 200)]), Scratch(spark)).collect()}
    assert got == {0, 1}


def test_compact_windows_against_brute_force():
    def brute(h, least):
        seen = set()
        for c in range(len(h)):
            a = b = c
            while a and h[a - 1] >= h[c]:
                a -= 1
            while b < len(h) - 1 and h[b + 1] >= h[c]:
                b += 1
            if b - a + 1 >= least:
                seen.add((a, next(i for i in range(a, b + 1) if h[i] == h[c]), b))
        return seen

    rng = np.random.default_rng(1)
    for k in range(200):
        n = rng.integers(0, 60, 4)
        h = rng.integers(1, (4, 40, 2**60)[k % 3], n.sum()).astype(np.uint64)
        begin = np.concatenate([[0], np.cumsum(n)])
        got = [*zip(*passages.compact_windows(h, begin, 7))]
        want = {(d, *w) for d in range(4) for w in brute(h[begin[d] : begin[d + 1]].tolist(), 7)}
        assert len(got) == len(set(got)) and set(got) == want
