"""Exact dedup with a heavy-hitter split.

Texts are equal when identical after each run of ASCII white space became one space; a null text is
an empty one. Misra-Gries finds the digests that many rows share; their groups are counted exactly
(partial sums only cross the network), and the winners, at most `counters` rows, are broadcast, so
no task ever gathers a large group. What is left is grouped by an ordinary shuffle.

Defined results: of equal texts the smallest doc_id stays, null ids last; of repeated rows (same id
and text) one stays; an empty table gives an empty one; other columns, of any names, pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, Scratch, frequent, fresh, sized

#: Misra-Gries counters: a digest of more than 1/1025 of the rows is always handled map-side.
COUNTERS = 1024


def normal_text(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normal_text(text), 256))


def copies(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """A row per document: id, digest, keep_id, group_size, kept."""
    rows = scratch.save(docs.select(F.col(id_col).alias("id"), digest(F.col(text_col)).alias("digest")), "digests")
    often = scratch.save(frequent(rows, "digest", counters).select("digest"), "frequent")
    group = (F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
    heavy = scratch.save(rows.join(F.broadcast(often), "digest").groupBy("digest").agg(*group), "heavy")
    light = rows.join(F.broadcast(often), "digest", "left_anti")
    out = light.join(light.groupBy("digest").agg(*group), "digest").unionByName(rows.join(F.broadcast(heavy), "digest"))
    out = scratch.save(out.withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id"))), "copies")
    tied = out.where("kept").groupBy("digest").count().where("count > 1")
    if not tied.isEmpty():  # rows repeated with their ids: one of them stays
        first = out.where("kept").groupBy("digest", "id", "keep_id", "group_size").count().select("digest", "id", "keep_id", "group_size", F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))).alias("nth"))
        out = out.where(~F.col("kept")).unionByName(first.withColumn("kept", F.col("nth") == 1).drop("nth"))
    return out


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The documents with one of each group of equal texts, all columns kept."""
    scratch = Scratch(docs.sparkSession)
    found = copies(docs, scratch, id_col, text_col, counters)
    pairs = scratch.save(found.groupBy("id", "digest").agg(F.max("kept").alias("stays"), F.count("*").alias("n")).where("not stays or n > 1"), "pairs")
    i, d, key = fresh(docs, "gone_id", "gone_digest", "text_digest")
    keyed = docs.withColumn(key, digest(F.col(text_col)))

    def match(which: str, how: str) -> DataFrame:
        side = sized(pairs.where(which).select(F.col("id").alias(i), F.col("digest").alias(d)), 64)
        return keyed.join(side, keyed[id_col].eqNullSafe(side[i]) & (keyed[key] == side[d]), how)

    if pairs.where("stays").isEmpty():
        return match("not stays", "left_anti").drop(key)
    once = match("stays", "left_semi").dropDuplicates([id_col, key])
    return match("true", "left_anti").unionByName(once).drop(key)
