"""Document fingerprints: a Merkle tree over sections, paragraphs and sentences, with DataFrame functions only.

Sections end at an empty line, paragraphs at a line feed, sentences after `.`, `!` or `?` and a
space; no character is lost. A leaf is the SHA-256 of its sentence, a node that of its children's
digests, each level with a letter of its own in front; the root is the fingerprint. Equal roots mean
equal texts. nodes has a 64-bit hash of every node: what two trees don't share is where they differ.

Defined results: a null text is an empty one (one empty leaf); repeated rows are rows of their own;
in document order ids come first, null ids last, and equal ids go by text; after the last document
comes the first, so a single one follows itself; an empty table gives an empty one; other columns are
left out. Documents are neighbours within id ranges of about ROWS rows; the first of each range is
also laid at the end of the range before it, so no task sees more than its range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows in a range of ids, and the most ranges, whose bounds the driver holds.
ROWS, RANGES = 1000, 20_000


def _node(letter: str, children: Column) -> Column:
    return F.sha2(F.concat(F.lit(letter), F.array_join(children, "")), 256)


def levels(text: Column) -> Column:
    """The leaves' digests as an array (section) of arrays (paragraph) of arrays."""
    leaf = lambda s: F.sha2(F.concat(F.lit("l"), s), 256)
    paragraph = lambda p: F.transform(F.split(p, r"(?<=[.!?] )"), leaf)
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n\n"), lambda s: F.transform(F.split(s, "\n"), paragraph))


def with_tree(df: DataFrame, text: str, root: str, nodes: str) -> DataFrame:
    """df with the root and the nodes of the column's trees; each level is computed once."""
    a, b, c = f"__{root}_leaves", f"__{root}_paragraphs", f"__{root}_sections"
    df = df.withColumn(a, levels(F.col(text)))
    df = df.withColumn(b, F.transform(a, lambda s: F.transform(s, lambda p: _node("p", p))))
    df = df.withColumn(c, F.transform(b, lambda s: _node("s", s)))
    df = df.withColumn(root, _node("r", F.col(c)))
    every = F.concat(F.array(root), c, F.flatten(b), F.flatten(F.flatten(a)))
    return df.withColumn(nodes, F.array_distinct(F.transform(every, lambda h: F.xxhash64(h)))).drop(a, b, c)


def likeness(a: Column, b: Column) -> Column:
    """Shared nodes by the nodes of the larger tree: 1 for equal texts only."""
    return F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.size(b))


def differing(a: Column, b: Column) -> Column:
    """The nodes of a that b lacks: the branches that lead to its edits."""
    return F.array_except(a, b)


def _bucket(value: Column, bounds: list) -> Column:
    """How many bounds lie below value, by a two-step search; null goes with the last."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    parts = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    below = lambda xs: F.size(F.filter(xs, lambda x: x < value))
    row = F.greatest(below(F.array(*(F.lit(p[0]) for p in parts))), F.lit(1))
    there = F.element_at(F.array(*(F.array(*map(F.lit, p)) for p in parts)), row)
    return F.when(value.isNull(), F.lit(len(bounds))).otherwise((row - 1) * step + below(there))


def neighbours(docs: DataFrame, id_col: str, text_col: str, rows: int = ROWS) -> DataFrame:
    """id, text, root, nodes and those of the next document, by ascending id."""
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = docs.count()
    k = min(RANGES, n // rows)
    bounds = sorted(set(docs.agg(F.percentile_approx(id_col, [(i + 1) / (k + 1) for i in range(k)], max(10_000, 4 * k)).alias("q")).head()["q"] or [])) if k else []
    # Each bound is an id of the table and belongs to the range it ends, so only what lies above the last may be empty.
    if bounds and not n == 0 and docs.where((F.col(id_col) > bounds[-1]) | F.col(id_col).isNull()).isEmpty():
        bounds.pop()
    ranges = len(bounds) + 1
    src = src.withColumn("range", _bucket(F.col("id"), bounds))
    first = src.groupBy("range").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text")).alias("f"))
    laid = first.select("f.id", "f.text", ((F.col("range") + ranges - 1) % ranges).alias("range"), F.lit(True).alias("end"))
    both = with_tree(src.withColumn("end", F.lit(False)).unionByName(laid), "text", "root", "nodes")
    w = Window.partitionBy("range").orderBy("end", F.asc_nulls_last("id"), "text")
    ahead = {f"next_{c}": F.lead(c).over(w) for c in ("text", "root", "nodes")}
    return both.select("id", "text", "root", "nodes", "end", *(v.alias(k) for k, v in ahead.items())).where(~F.col("end")).drop("end")


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's fingerprint, that of its edited text (the second half taken from the next document's start) and likenesses."""
    near = neighbours(docs, id_col, text_col)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    df = near.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half)))
    df = with_tree(df.drop("next_text"), "edited", "edited_root", "edited_nodes")
    return df.select(
        F.col("id").alias("doc_id"), n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), F.col("root").alias("fingerprint"), F.col("edited_root").alias("edited_fingerprint"),
        likeness(F.col("nodes"), F.col("edited_nodes")).alias("near_edited"), likeness(F.col("nodes"), F.col("next_nodes")).alias("near_next"))
