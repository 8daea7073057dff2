"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

Words and signs, and pairs of neighbours, are hashed into 2**BITS buckets. Two smoothed bag models
are counted over all rows: raw text (every document) and target text (documents labelled good). A
document's log weight is the log of its likelihood under the target model less that under the raw
one, summed over its n-grams: its importance weight. Its key is the log weight by a temperature (1 is
plain sampling) plus Gumbel noise drawn from its id; the k largest keys are a sample without
replacement in proportion to the weights. k is a parameter; if it is not given, as large a share of the
rows is drawn as has quality 1 among the labels, which must then be a fair sample. Raw counts are brought
to the target's total before both are smoothed by the same SMOOTHING, so what is rare in both says nothing.

Labels come from at most LABELS rows (those of the smallest hash of their id); all counts, weights
and the sample cover every row. The driver and the tasks hold the 2**BITS bucket counts, never more;
a task's counts are shuffled in CHUNKS parts and added up part by part.

Defined results: a null text is an empty one; without n-grams the weight is 0; without good labels
everything is kept; labels with nulls are skipped, of several labels of an id the
smallest holds; equal keys go by a hash of the id, and rows equal in both share their fate; an empty
table gives an empty one; other columns pass through keep() and are left out of scores().
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import Scratch, fresh, sized

BITS, CHUNKS, SMOOTHING, LABELS, TEMPERATURE, SEED = 18, 256, 10.0, 200_000, 1.0, 17


def _grams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of each n-gram."""
    starts, ends, first = W.split(data, bounds, W.KIND)
    h = W.hashes(data, starts, ends)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    same = row[:-1] == row[1:]
    pairs = W.mix(h[:-1][same] * W._BASE + h[1:][same])
    return np.concatenate([h, pairs]) >> np.uint64(64 - BITS), np.concatenate([row, row[:-1][same]])


def labelled(labels: DataFrame, limit: int = LABELS) -> DataFrame:
    """(label_id, good) of at most `limit` ids: good is 1 for quality 1 that is not toxic, 0 for quality 0, else -1."""
    good = F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).when(F.col("quality") == 0, 0).otherwise(-1)
    rows = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("label_id")).agg(F.min(good).alias("good"))
    return rows.orderBy(F.xxhash64("label_id"), "label_id").limit(limit)


def counts(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """N-grams by bucket in all rows and in those with good = 1. docs: text, good."""

    def run(batches):
        import pyarrow as pa

        raw, target = np.zeros((2, 1 << BITS), np.int64)
        for b in batches:
            good = b.column(1).fill_null(-1).to_numpy(zero_copy_only=False) == 1
            for lo, hi, data, bounds in W.texts(b.column(0)):
                bucket, row = _grams(data, bounds)
                raw += np.bincount(bucket.view(np.int64), minlength=1 << BITS)
                target += np.bincount(bucket.view(np.int64)[good[lo:hi][row]], minlength=1 << BITS)
        flat = lambda a: pa.array([part.tobytes() for part in a.reshape(CHUNKS, -1)], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(range(CHUNKS), pa.int32()), flat(raw), flat(target)], names)

    def add(batches):
        import pyarrow as pa

        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i, *both in zip(*(c.to_pylist() for c in b.columns)):
                sums[i] = sums.get(i, 0) + np.stack([np.frombuffer(x, np.int64) for x in both])
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), *(pa.array([s[k].tobytes() for s in sums.values()], pa.binary()) for k in (0, 1))], names)

    names, shape = ["chunk", "raw", "target"], "chunk int, raw binary, target binary"
    each = docs.select("text", "good").mapInArrow(run, shape)
    raw, target = np.zeros((2, CHUNKS, (1 << BITS) // CHUNKS))
    for r in each.repartition("chunk").mapInArrow(add, shape).collect():
        raw[r.chunk] += np.frombuffer(r.raw, np.int64)
        target[r.chunk] += np.frombuffer(r.target, np.int64)
    return raw.reshape(-1), target.reshape(-1)


def log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """By bucket, the log of its probability under the target model less that under the raw one."""
    return np.log((target + SMOOTHING) / (raw * (target.sum() / max(1.0, raw.sum())) + SMOOTHING)).astype(np.float32)


def weights(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """docs (id, text, good) as id, text_hash, log_weight."""
    table = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            out = np.zeros(b.num_rows)
            for lo, hi, data, bounds in W.texts(b.column(1)):
                bucket, row = _grams(data, bounds)
                out[lo:hi] = np.bincount(row, table.value[bucket], hi - lo)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(out)], ["id", "text_hash", "log_weight"])

    return docs.select("id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(run, "id bigint, text_hash bigint, log_weight double")


def gumbel(id_col: Column, seed: int = SEED) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(id_col, F.lit(seed)), 11) + F.lit(0.5)) / F.lit(float(2**53))
    return -F.log(-F.log(u))


def kth_largest(df: DataFrame, col: str, k: int, most: int = 5000) -> tuple[float, int]:
    """The k-th largest value, and how many rows lie above it; by histograms of 1024 bins over ever smaller ranges."""
    lo, hi = df.agg(F.min(col), F.max(col)).head()
    above, part = 0, df
    while True:
        n = part.count()
        if n <= most or lo == hi:
            break
        width = (hi - lo) / 1024
        cell = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)), F.lit(1023)) if width > 0 else F.lit(0)
        bins = {r[0]: r[1:] for r in part.groupBy(cell.alias("cell")).agg(F.count("*"), F.min(col), F.max(col)).collect()}
        for c in sorted(bins, reverse=True):
            size, a, b = bins[c]
            if above + size >= k:
                lo, hi = a, b
                break
            above += size
        part = df.where(F.col(col).between(lo, hi))
    if lo == hi:
        return lo, above
    values = sorted((r[0] for r in part.select(col).collect()), reverse=True)
    v = values[k - above - 1]
    return v, above + sum(x > v for x in values)


def scores(docs: DataFrame, labels: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", k: int | None = None, temperature: float = TEMPERATURE, seed: int = SEED) -> DataFrame:
    """id, text_hash, log_weight, key, kept of each row."""
    known = scratch.save(labelled(labels), "labels")
    n_labels, n_good = known.agg(F.count("*"), F.count_if(F.col("good") != 0)).head()
    side = F.broadcast(known)  # at most LABELS rows
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    src = src.join(side, src.id == side.label_id, "left").select("id", "text", "good")
    raw, target = counts(src)
    rows = scratch.save(weights(src, log_ratio(raw, target) if target.any() else np.zeros_like(raw, np.float32)), "weights")
    rows = rows.withColumn("key", F.col("log_weight") / F.lit(temperature) + gumbel(F.col("id"), seed)).withColumn("tie", F.xxhash64("id", F.lit(seed + 1)).cast("double"))
    n = rows.count()
    if k is None:
        k = round(n * n_good / n_labels) if target.any() else n
    if k >= n or not n:
        kept = F.lit(True)
    elif k <= 0:
        kept = F.lit(False)
    else:
        v, above = kth_largest(rows, "key", k)
        same = rows.where(F.col("key") == F.lit(v))
        kept = (F.col("key") > F.lit(v)) | ((F.col("key") == F.lit(v)) & (F.col("tie") >= F.lit(kth_largest(same, "tie", k - above)[0])))
    return rows.select("id", "text_hash", "log_weight", "key", kept.alias("kept"))


def keep(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int | None = None, temperature: float = TEMPERATURE) -> DataFrame:
    """The sampled rows, all columns kept."""
    scratch = Scratch(docs.sparkSession)
    found = scratch.save(scores(docs, labels, scratch, id_col, text_col, k, temperature), "scores")
    i, h = fresh(docs, "gone_id", "gone_hash")
    gone = sized(found.where(~F.col("kept")).select(F.col("id").alias(i), F.col("text_hash").alias(h)), 64)
    return docs.join(gone, docs[id_col].cast("long").eqNullSafe(gone[i]) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == gone[h]), "left_anti")
