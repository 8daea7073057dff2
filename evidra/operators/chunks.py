"""Bounded chunks, line fragments, excerpts and numbered references for model requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PACKED = "session_id {kind}, chunk_index int, chunk_window int, first int, last int, size int, over_budget boolean, record_ids array<string>"


def record_size(*cols: str) -> Column:
    """The one size function: code points of the compact JSON of these columns."""
    return F.length(F.to_json(F.struct(*cols)))


def windows_of(sizes: list[int], budget: int, overlap: int, base: int = 2) -> list[tuple[int, int, int]]:
    """(start, end, size) of greedy contiguous windows: as many rows as fit, at least one; the next starts `overlap` rows before the end."""
    ends, total, start = [], [0], 0
    for s in sizes:
        total.append(total[-1] + s + 1)
    out = []
    while start < len(sizes):
        end = start + 1
        while end < len(sizes) and base + total[end + 1] - total[start] - 1 <= budget:
            end += 1
        out.append((start, end, base + total[end] - total[start] - 1))
        if end == len(sizes):
            break
        start = max(end - overlap, start + 1)
    return out or ends


def pack_chunks(records: DataFrame, budget: int = 24_000, overlap: int = 2) -> DataFrame:
    """A row per chunk of each session's records (session_id, id, ord, size). Only ids, orders and sizes are gathered, by session."""
    def run(key, t):
        import pyarrow as pa

        t = t.sort_by("ord")
        ids, orders = t.column("id").to_pylist(), t.column("ord").to_pylist()
        rows = [{"session_id": key[0].as_py(), "chunk_index": i, "chunk_window": b - a, "first": orders[a], "last": orders[b - 1], "size": n, "over_budget": n > budget, "record_ids": ids[a:b]} for i, (a, b, n) in enumerate(windows_of(t.column("size").to_pylist(), budget, overlap))]
        return pa.Table.from_pylist(rows, schema=pa.schema([("session_id", t.schema.field("session_id").type), *((n, pa.int32()) for n in ("chunk_index", "chunk_window", "first", "last", "size")), ("over_budget", pa.bool_()), ("record_ids", pa.list_(pa.string()))]))

    kind = records.schema["session_id"].dataType.simpleString()
    return records.select("session_id", "id", F.col("ord").cast("int").alias("ord"), F.col("size").cast("int").alias("size")).groupBy("session_id").applyInArrow(run, PACKED.format(kind=kind))


def line_parts(text: str, most: int) -> list[tuple[int, int, str]]:
    """(first line, last line, part): greedy by code points, cut only after lines; a longer line stays whole."""
    parts, held, size, first = [], [], 0, 1
    for n, line in enumerate(text.splitlines(keepends=True), 1):
        if held and size + len(line) > most:
            parts.append((first, n - 1, "".join(held)))
            held, size, first = [], 0, n
        held.append(line)
        size += len(line)
    return [*parts, (first, first + len(held) - 1, "".join(held))] if held else parts


def fragments(records: DataFrame, most: int, field: str = "text") -> DataFrame:
    """Rows whose field is longer than `most` as fragments (id parent#fragment-n), others as they are."""
    shape = "array<struct<first:int,last:int,part:string>>"

    @F.pandas_udf(shape)
    def cut(text):
        import pandas as pd

        return pd.Series([[{"first": a, "last": b, "part": p} for a, b, p in line_parts(t or "", most)] for t in text])

    long = records.where(F.length(field) > most).withColumn("__parts", cut(field))
    count = F.size("__parts")
    keep = [c for c in records.columns if c not in ("id", field)]
    out = long.select(*keep, F.col("id").alias("parent_id"), count.alias("__n"), F.posexplode("__parts").alias("__i", "__p"))
    out = out.select(*keep, F.concat("parent_id", F.lit("#fragment-"), (F.col("__i") + 1).cast("string")).alias("id"), F.col("__p.part").alias(field), "parent_id", F.struct(F.lit(field).alias("field"), F.col("__p.first").alias("first_line"), F.col("__p.last").alias("last_line"), (F.col("__i") + 1).alias("index"), F.col("__n").alias("count"), (F.col("__n") == 1).alias("complete_record")).alias("fragment"))
    whole = records.where((F.length(field) <= most) | F.col(field).isNull()).select(*keep, "id", field, F.lit(None).cast("string").alias("parent_id"), F.lit(None).cast(out.schema["fragment"].dataType).alias("fragment"))
    return out.unionByName(whole)


def chunk_identity(df: DataFrame, *cols: str) -> DataFrame:
    """df with identity (hash of the evidence columns) and duplicate_of, the first id of the same identity."""
    w = Window.partitionBy("identity").orderBy("id")
    out = df.withColumn("identity", F.sha2(F.to_json(F.struct(*cols)), 256))
    return out.withColumn("duplicate_of", F.when(F.row_number().over(w) > 1, F.first("id").over(w)))


def body_dedup(rows: DataFrame, keys: list[str], order: str, body: str) -> DataFrame:
    """The first of equal bodies keeps its text, later ones point to it."""
    w = Window.partitionBy(*keys, F.sha2(F.coalesce(body, F.lit("")), 256)).orderBy(order, "id")
    later = (F.row_number().over(w) > 1) & F.col(body).isNotNull()
    return rows.withColumn("same_as", F.when(later, F.first("id").over(w))).withColumn(body, F.when(F.col("same_as").isNull(), F.col(body)))


def local_references(sources: DataFrame, keys: list[str], prefix: str = "资料") -> DataFrame:
    """(keys, source, ref): sources numbered by least order, then id; one number each."""
    s = sources.groupBy(*keys, "source").agg(F.min("ord").alias("ord"))
    return s.withColumn("ref", F.concat(F.lit(prefix), F.row_number().over(Window.partitionBy(*keys).orderBy("ord", "source")).cast("string"))).drop("ord")


def restore_references(cited: DataFrame, refs: DataFrame, keys: list[str], unknown: str = "<unknown source>") -> DataFrame:
    """cited (keys, ref) with its source; what was never handed out becomes a source that no check admits."""
    return cited.join(refs, [*keys, "ref"], "left").withColumn("source", F.coalesce("source", F.lit(unknown)))


def excerpt(text: Column, pattern: str, least: int = 4000, pad: int = 1) -> Column:
    """Long texts cut to the lines that match and `pad` lines around them, with ... where lines are left out; null without a match."""
    lines = F.split(text, "\n")
    hits = F.transform(lines, lambda x: x.rlike(pattern))
    near = F.transform(lines, lambda x, i: F.exists(F.slice(hits, F.greatest(i - pad + 1, F.lit(1)), F.least(i, F.lit(pad)) + pad + 1), lambda h: h))
    kept = F.zip_with(lines, near, lambda x, k: F.when(k, x))
    joined = F.array_join(kept, "\n", "\u0001")
    cut = F.regexp_replace(joined, "(?:\u0001\n?)+", "...\n")
    return F.when(F.length(text) <= least, text).when(F.exists(hits, lambda h: h), F.regexp_replace(cut, "\n$", ""))


def budget_projection(padded: Column, bare: Column, target: int, most: int, reserve: int = 4500) -> Column:
    """struct(padding, budget): the padded payload if it fits the target or the limit, else the bare one, else null."""
    fit = lambda n: F.when(n + reserve <= target, target).when(n + reserve <= most, most)
    return F.when(fit(padded).isNotNull(), F.struct(F.lit(1).alias("padding"), fit(padded).alias("budget"))).when(fit(bare).isNotNull(), F.struct(F.lit(0).alias("padding"), fit(bare).alias("budget")))


def evidence_projection(records: DataFrame, cited: DataFrame, padding: int = 1) -> DataFrame:
    """Cited records (session_id, source; parents count), records at cited orders and `padding` neighbours by place."""
    from .joins import pad_hits, source_aliases

    rec = records if "parent_id" in records.columns else records.withColumn("parent_id", F.lit(None).cast("string"))
    hit = source_aliases(rec).join(cited.select("session_id", F.col("source").alias("alias")).distinct(), ["session_id", "alias"], "left_semi").select("session_id", F.col("material").alias("id")).distinct().withColumn("__hit", F.lit(True))
    marked = records.join(hit, ["session_id", "id"], "left").withColumn("__hit", F.coalesce("__hit", F.lit(False)))
    return pad_hits(marked, ["session_id"], "ord", F.col("__hit"), padding).drop("__hit")
