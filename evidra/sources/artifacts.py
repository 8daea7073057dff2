"""Artifacts of a run: create-only tables, pooled evidence, receipts and resumption."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_new(df: DataFrame, path: str) -> None:
    """Writes the table; an existing one is an error."""
    df.write.mode("errorifexists").parquet(path)


def save_pooled(df: DataFrame, path: str, keys: list[str]) -> None:
    """Rows are written once each to a pool, by the hash of their canonical JSON; a bridge names them by the keys."""
    body = [c for c in df.columns if c not in keys]
    named = df.withColumn("evidence", F.sha2(F.to_json(F.struct(*sorted(body)), {"ignoreNullFields": "false"}), 256))
    save_new(named.select(*keys, "evidence"), f"{path}/bridge")
    save_new(named.select("evidence", *body).dropDuplicates(["evidence"]), f"{path}/pool")


def load_pooled(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/bridge").join(spark.read.parquet(f"{path}/pool"), "evidence").drop("evidence")


def receipt(records: DataFrame) -> DataFrame:
    """Counts by kind and role, last order and a hash of all rows by session."""
    one = F.sha2(F.to_json(F.struct(*sorted(records.columns))), 256)
    return records.groupBy("session_id").agg(
        F.count("*").alias("records"), F.max("ord").alias("cutoff"), *(F.count_if(F.col("kind") == k).alias(k) for k in ("message", "call", "result", "observation", "patch")),
        *(F.count_if(F.col("role") == r).alias(r) for r in ("user", "assistant")), F.sha2(F.array_join(F.array_sort(F.collect_list(one)), ""), 256).alias("sha256"))


def convert(records: DataFrame, path: str) -> DataFrame:
    """Writes normalized records, reads them back, requires equality and gives the receipt."""
    save_new(records, path)
    back = records.sparkSession.read.parquet(path)
    if not (records.exceptAll(back).isEmpty() and back.exceptAll(records).isEmpty()):
        raise ValueError("records changed on the way")
    return receipt(back)


def left_to_do(chunks: DataFrame, done: DataFrame, identity: str = "identity") -> DataFrame:
    """Chunks without a saved result, failures counting as results."""
    return chunks.join(done.select(identity).distinct(), identity, "left_anti")


def package_files(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """manifest (name, sha256) with ok: whether the file of the name under the path has this hash; names must stay inside."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.regexp_replace("path", r"^.*?" + path.rstrip("/").split("/")[-1] + "/", "")
    files = f.select(name.alias("name"), F.sha2("content", 256).alias("found"))
    inside = ~F.col("name").rlike(r"(^|/)\.\.(/|$)|^/|(^|/)\.git(/|$)")
    return manifest.join(files, "name", "left").select("name", "sha256", F.coalesce(inside & (F.col("found") == F.col("sha256")), F.lit(False)).alias("ok"))
