"""Mixing sources to target weights by soft membership, with DataFrame functions only.

A document belongs to every domain (by default the languages) with a probability. A labelled table
classifies: MARKERS words a domain, found on at most SAMPLE labelled documents of it, are looked up in
every text; the two domains with the most of them, each with the number's power of two, are its cell;
the labelled documents of a cell give its posteriors, smoothed towards the shares of all. A rate then
says how often a document is to be seen: projected gradient steps minimise the squared distance of
the domains' expected tokens to their targets, by their own size, plus RIDGE times that of the rates
to 1, under rates >= 0. Documents of a cell have equal posteriors, hence equal gradients and rates:
tokens are summed by cell first, and a step reads as many rows as there are cells, at most
4 * (12 * domains) ** 2, however many documents there are. A step moves every cell against its
posteriors' mean of a pull per domain and sets negative rates to 0; the pull is the gradient scaled by
the Gram matrix of the cells whose rate is positive, and halved until the objective falls enough. Steps
end when no domain's gradient exceeds TOLERANCE of all tokens; if they do not, an error is raised.
fit() gives each domain's target and what the rates reach.

Defined results: a null text is an empty one, with 0 tokens; texts without markers share a cell; a
null label teaches nothing; without labels there is no domain and every rate is 1; more than DOMAINS
domains are an error; targets are normalised, of domains without tokens left out, and default to the
shares to the power EXPONENT; repeated rows share their fate; an empty table gives an empty one; mix()
keeps all other columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import SPACES, Scratch, fresh, sized

MARKERS, SAMPLE, SMOOTHING, RIDGE, TOLERANCE, STEPS, EXPONENT, SEED = 40, 1000, 2.0, 1e-4, 1e-9, 200, 0.7, 23
#: The most domains: the driver holds their square in numbers, and a text is compared with the markers of each.
DOMAINS = 64


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACES), lambda w: w != "")


def markers(docs: DataFrame, domain: str, id_col: str, text_col: str) -> dict[str, list[str]]:
    """The words of each domain whose share of its documents exceeds that in the others most."""
    known = docs.where(F.col(domain).isNotNull())
    sizes = {r[0]: r[1] for r in known.groupBy(domain).count().limit(DOMAINS + 1).collect()}
    if not sizes:
        return {}
    if len(sizes) > DOMAINS:
        raise ValueError(f"{domain} has more than {DOMAINS} values")
    cells = 1 << 20
    cut = F.create_map(*(x for d, n in sizes.items() for x in (F.lit(d), F.lit(min(cells, -(-cells * SAMPLE // n))))))
    drawn = known.where(F.pmod(F.xxhash64(id_col, F.lit(SEED)), F.lit(cells)) < cut[F.col(domain)])
    seen = drawn.select(F.col(domain).alias("d"), F.explode(F.array_distinct(words(F.col(text_col)))).alias("w")).groupBy("d", "w").agg(F.count("*").alias("n"))
    total = Window.partitionBy("w")
    size = F.create_map(*(x for d, n in sizes.items() for x in (F.lit(d), F.lit(float(min(n, SAMPLE))))))
    seen = seen.withColumn("share", F.col("n") / size[F.col("d")]).withColumn("others", F.sum("share").over(total) - F.col("share"))
    best = seen.withColumn("nth", F.row_number().over(Window.partitionBy("d").orderBy(F.desc(F.col("share") - F.col("others")), "w"))).where(F.col("nth") <= MARKERS)
    out: dict[str, list[str]] = {d: [] for d in sorted(sizes)}
    for r in best.select("d", "w", "nth").orderBy("d", "nth").collect():
        out[r.d].append(r.w)
    return out


def cell(text_words: Column, marks: dict[str, list[str]]) -> Column:
    """The two domains with the most markers in the text, each with its number's power of two."""
    every = F.array(*(F.lit(w) for w in sorted({w for ws in marks.values() for w in ws})))
    hits = F.array_intersect(text_words, every)
    power = lambda n: F.when(n > 0, F.floor(F.log2(n)).cast("int") + 1).otherwise(0)
    each = F.sort_array(F.array(*(F.struct(F.size(F.array_intersect(hits, F.array(*map(F.lit, ws)))).alias("n"), F.lit(-i).alias("d")) for i, ws in enumerate(marks.values()))), asc=False)
    top = lambda k: F.when(F.size(each) > k, F.concat_ws(":", -F.get(each, F.lit(k))["d"], power(F.get(each, F.lit(k))["n"]))).otherwise("-")
    return F.concat_ws("/", top(0), top(1))


def _features(docs: DataFrame, marks: dict[str, list[str]], text_col: str, w: str, tokens: str, c: str) -> DataFrame:
    df = docs.withColumn(w, words(F.col(text_col)))
    return df.withColumn(tokens, F.size(w).cast("long")).withColumn(c, cell(F.col(w), marks)).drop(w)


def cells(docs: DataFrame, scratch: Scratch, domain: str, id_col: str, text_col: str) -> tuple[dict[str, list[str]], DataFrame]:
    """The markers of each domain that has any, and by cell: tokens and p, the posteriors in the markers' order."""
    marks = {d: ws for d, ws in markers(docs, domain, id_col, text_col).items() if ws}
    if not marks:
        return {}, docs.sparkSession.createDataFrame([], "cell string, tokens bigint, p array<double>")
    names = list(marks)
    seen = _features(docs.select(F.col(text_col).alias("text"), F.col(domain).alias("label")), marks, "text", "w", "tokens", "cell")
    by_cell = seen.groupBy("cell").agg(F.sum("tokens").alias("tokens"), F.count("label").alias("known"), *(F.count_if(F.col("label") == d).alias(f"n{i}") for i, d in enumerate(names)))
    by_cell = scratch.save(by_cell, "counts")
    every = by_cell.agg(F.sum("known"), *(F.sum(f"n{i}") for i in range(len(names)))).head()
    prior = [(x or 0) / max(1, every[0] or 0) for x in every[1:]]
    p = F.array(*((F.col(f"n{i}") + F.lit(SMOOTHING * q)) / (F.col("known") + F.lit(SMOOTHING * sum(prior) or 1.0)) for i, q in enumerate(prior)))
    return marks, scratch.save(by_cell.select("cell", "tokens", p.alias("p")), "cells")


def _rate(pulls: list[float]) -> Column:
    """A cell's rate when its domains were pulled this much in all."""
    return F.greatest(F.lit(0.0), 1 - sum((F.col("p")[k] * F.lit(v) for k, v in enumerate(pulls)), F.lit(0.0)))


def _solve(a: list[list[float]], b: list[float]) -> list[float]:
    """x with a x = b, for a positive definite a, by elimination."""
    n, rows = len(b), [[*r, v] for r, v in zip(a, b)]
    for i in range(n):
        for j in range(i + 1, n):
            f = rows[j][i] / rows[i][i]
            rows[j] = [x - f * y for x, y in zip(rows[j], rows[i])]
    x = [0.0] * n
    for i in reversed(range(n)):
        x[i] = (rows[i][n] - sum(rows[i][j] * x[j] for j in range(i + 1, n))) / rows[i][i]
    return x


def fit(by_cell: DataFrame, names: list[str], targets: dict[str, float] | None = None) -> tuple[list[float], dict[str, tuple[float, float]]]:
    """The pulls whose rates (_rate) are the least squares solution, and each domain's (target, reached) share of the tokens.

    With y the pulls, the rates max(0, 1 - p y) minimise the objective where the gradient
    target - reached + RIDGE * size * y of its dual is 0; the dual decides whether a step is short enough.
    """
    k = range(len(names))
    tokens, p = F.col("tokens").cast("double"), [F.col("p")[i] for i in k]
    size = [float(x or 0) for x in by_cell.agg(*(F.sum(tokens * p[i]) for i in k)).head()]
    total = sum(size)
    want = [(s**EXPONENT if targets is None else float(targets.get(d, 0.0))) if s > 0 else 0.0 for d, s in zip(names, size)]
    aim = [total * w / (sum(want) or 1.0) for w in want]
    if total <= 0 or not any(want):
        return [0.0 for _ in k], {d: (0.0, 0.0) for d in names}
    weight = [RIDGE * (s if s > 0 else 1.0) for s in size]
    pairs = [(i, j) for i in k for j in k if j <= i]

    def look(y: list[float]) -> tuple[float, list[float], list[list[float]]]:
        r = _rate(y)
        on = F.when(r > 0, tokens).otherwise(0.0)
        got = [float(x or 0) for x in by_cell.agg(F.sum(tokens * r * r), *(F.sum(tokens * r * p[i]) for i in k), *(F.sum(on * p[i] * p[j]) for i, j in pairs)).head()]
        gram = [[0.0 for _ in k] for _ in k]
        for (i, j), v in zip(pairs, got[1 + len(names) :]):
            gram[i][j] = gram[j][i] = v
        for i in k:
            gram[i][i] += weight[i]
        value = got[0] / 2 + sum(a * v + w * v * v / 2 for a, v, w in zip(aim, y, weight))
        return value, got[1 : 1 + len(names)], gram

    y = [0.0 for _ in k]
    value, reached, gram = look(y)
    for _ in range(STEPS):
        slope = [a - m + w * v for a, m, w, v in zip(aim, reached, weight, y)]
        if max(map(abs, slope)) <= TOLERANCE * total:
            return y, {d: (a / total, m / total) for d, a, m in zip(names, aim, reached)}
        step, part = _solve(gram, slope), 1.0
        while True:
            trial = [v - part * s for v, s in zip(y, step)]
            now = look(trial)
            if now[0] <= value - 1e-4 * part * sum(a * b for a, b in zip(slope, step)) + 1e-13 * abs(value) or part < 1e-9:
                break
            part /= 2
        y, (value, reached, gram) = trial, now
    raise RuntimeError("the rates did not settle")


def rates(docs: DataFrame, scratch: Scratch, targets: dict[str, float] | None = None, domain: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> tuple[dict[str, list[str]], DataFrame]:
    """The markers, and by cell: tokens, posteriors (array, in the markers' order) and rate."""
    marks, by_cell = cells(docs, scratch, domain, id_col, text_col)
    if not marks:
        return {}, by_cell.withColumn("rate", F.lit(1.0))
    return marks, by_cell.withColumn("rate", _rate(fit(by_cell, list(marks), targets)[0]))


def memberships(docs: DataFrame, scratch: Scratch, targets: dict[str, float] | None = None, domain: str = "lang", id_col: str = "doc_id", text_col: str = "text", tokens: str = "tokens", posterior: str = "posterior", rate: str = "rate", copies: str = "copies") -> DataFrame:
    """docs with tokens, posterior (map of domains), rate and copies (the rate, rounded up or down by a hash of the id and text)."""
    marks, by_cell = rates(docs, scratch, targets, domain, id_col, text_col)
    w, c = fresh(docs, "words", "cell_of")
    if not marks:
        out = docs.withColumn(tokens, F.size(words(F.col(text_col))).cast("long")).withColumn(posterior, F.create_map().cast("map<string,double>")).withColumn(rate, F.lit(1.0))
    else:
        side = by_cell.select(F.col("cell").alias(c), F.map_from_arrays(F.array(*map(F.lit, marks)), F.col("p")).alias(posterior), F.col("rate").alias(rate))
        out = _features(docs, marks, text_col, w, tokens, c).join(sized(side, 100 + 40 * len(marks)), c, "left").drop(c)
    u = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.col(text_col), F.lit(SEED)), 11) / F.lit(float(2**53))
    return out.withColumn(copies, F.floor(F.col(rate) + u).cast("int"))


def mix(docs: DataFrame, targets: dict[str, float] | None = None, domain: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document as often as its copies say, columns unchanged."""
    names = fresh(docs, "tokens", "posterior", "rate", "copies", "nth")
    out = memberships(docs, Scratch(docs.sparkSession), targets, domain, id_col, text_col, *names[:4])
    return out.where(F.col(names[3]) > 0).withColumn(names[4], F.explode(F.sequence(F.lit(1), F.col(names[3])))).drop(*names)
