import random
import re
from collections import Counter, defaultdict

from evidra.llm import components, exact_dedup, near_dedup
from evidra.llm.common import Scratch, frequent

from .conftest import docs_of, prose


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def last(x):
    return (x is None, x or 0)


def test_exact_copies_against_brute_force(spark, edge, edge_rows):
    got = exact_dedup.copies(edge, Scratch(spark), counters=3).collect()
    groups = defaultdict(list)
    for r in edge_rows:
        groups[norm(r[1])].append(r[0])
    assert len(got) == len(edge_rows)
    want = Counter((d, min(ids, key=last), len(ids)) for ids in groups.values() for d in ids)
    assert Counter((r.id, r.keep_id, r.group_size) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)


def test_exact_keep_first(spark, edge, edge_rows, empty):
    got = exact_dedup.keep_first(edge, counters=2)
    assert got.columns == edge.columns
    assert Counter(norm(r.text) for r in got.collect()) == Counter({norm(r[1]): 1 for r in edge_rows})
    assert exact_dedup.keep_first(empty).count() == 0
    assert exact_dedup.copies(empty, Scratch(spark)).count() == 0


def test_frequent_finds_every_heavy_key(spark):
    rows = [("a",)] * 500 + [("b",)] * 200 + [(str(i),) for i in range(700)] + [(None,)] * 50
    random.Random(1).shuffle(rows)
    got = {r.k: r.at_least for r in frequent(spark.createDataFrame(rows, "k string").repartition(5), "k", 8).collect()}
    assert got["a"] >= 500 - 1400 / 9 and "b" in got and len(got) <= 8
    assert frequent(spark.createDataFrame([], "k string"), "k").count() == 0


def test_components(spark):
    r = random.Random(3)
    links = [(str(r.randrange(300)), str(r.randrange(300))) for _ in range(200)] + [(str(i), str(i + 1)) for i in range(1000, 1040)] + [("5", "5")]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {x.node: x.root for x in components.components(spark.createDataFrame(links, "a string, b string"), Scratch(spark)).collect()}
    moved = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in moved}
    assert components.components(spark.createDataFrame([], "a string, b string"), Scratch(spark)).count() == 0


def shingles(t, width):
    w = (t or "").encode().lower().split()
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def brute(rows, width, similarity):
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * n >= similarity * (len(sets[i]) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i in range(len(rows)):
        least[find(i)].append(rows[i][0])
    return Counter((rows[i][0], len(sets[i]), min(least[find(i)], key=last)) for i in range(len(rows)))


def near_texts():
    r, out = random.Random(5), []
    for g in range(12):
        base = prose(100 + g, 120).split()
        out.append(" ".join(base))
        for _ in range(r.choice([0, 1, 2, 40])):
            w = list(base)
            for _ in range(r.randrange(1, 9)):
                w[r.randrange(len(w))] = f"new{r.randrange(999)}"
            out.append(" ".join(w))
    return out


def test_near_groups_against_brute_force(spark):
    texts = near_texts()
    for width in (2, 5):
        got = near_dedup.groups(docs_of(spark, texts), Scratch(spark), width=width)
        assert Counter((r.id, r.n, r.component_id) for r in got.collect()) == brute(list(enumerate(texts)), width, 80)


def test_near_links_of_a_large_groups_fringe(spark):
    r, base = random.Random(11), [f"w{i}" for i in range(200)]
    texts = []
    for d in range(2000):
        w = list(base)
        for i in r.sample(range(200), round(200 * r.uniform(0.03, 0.12))):
            w[i] = f"d{d}x{i}"
        texts.append(" ".join(w))
    got = near_dedup.groups(docs_of(spark, texts), Scratch(spark), width=1)
    assert Counter((x.id, x.n, x.component_id) for x in got.collect()) == brute(list(enumerate(texts)), 1, 80)


def test_near_edge_cases(spark, edge, edge_rows, empty):
    got = near_dedup.groups(edge, Scratch(spark), width=2).collect()
    want = brute([(r[0], r[1]) for r in edge_rows], 2, 80)
    assert Counter((r.id, r.n, r.component_id) for r in got if r.n) == Counter({k: v for k, v in want.items() if k[1]})
    assert all(r.component_id == r.id for r in got if not r.n)
    assert near_dedup.groups(empty, Scratch(spark)).count() == 0


def test_near_keep_one(spark, edge, edge_rows, empty):
    got = near_dedup.keep_one(edge, width=2)
    assert got.columns == edge.columns
    rows = got.collect()
    with_words = [r for r in rows if shingles(r.text, 2)]
    want = brute([(r[0], r[1]) for r in edge_rows], 2, 80)
    assert sorted(last(r.doc_id) for r in with_words) == sorted({last(k[2]) for k in want if k[1]})
    assert len(rows) - len(with_words) == sum(not shingles(r[1], 2) for r in edge_rows)
    assert near_dedup.keep_one(empty).count() == 0
