"""What the operators of this package share: scratch tables, size-checked joins, frequent keys."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import ready

#: The six ASCII white-space characters, as a Java and RE2 character class.
SPACES = r"[\x20\x09-\x0D]+"
#: A join side of at most so many bytes may be broadcast; beyond it the join shuffles.
BROADCAST_BYTES = 48 << 20
#: Frees the shuffle files of a query when it ends, not when the driver happens to collect garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of rows that go to a Python worker at once, unless the session says; Spark's own bound is 10,000 rows, of any length.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir; a local one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="evidra-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


class Scratch:
    """Tables written to the shared folder, which cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession):
        ready(spark)
        if spark.conf.get(BATCH_BYTES[0], None) is None:
            spark.conf.set(BATCH_BYTES[0], str(BATCH_BYTES[1]))
        self.spark = spark
        self.root = f"{scratch_root(spark)}/evidra-{uuid.uuid4().hex}"
        atexit.register(self.drop)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        held = self.spark.conf.get(FREE_SHUFFLES, "false")
        self.spark.conf.set(FREE_SHUFFLES, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.set(FREE_SHUFFLES, held)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Deletes the named tables, or all."""
        jvm = self.spark.sparkContext._jvm
        if jvm is None:
            return
        for path in [f"{self.root}/{n}" for n in names] or [self.root]:
            try:
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
            except Exception:  # noqa: BLE001  the session may have ended
                return


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sized(df: DataFrame, row_bytes: int, rows: int | None = None) -> DataFrame:
    """df, marked for broadcast if its counted rows take at most BROADCAST_BYTES."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n * row_bytes <= BROADCAST_BYTES else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that df doesn't have, in any case of letters."""
    have, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in have:
            n = f"_{n}"
        have.add(n.lower())
        out.append(n)
    return out


def frequent(df: DataFrame, key: str, k: int = 1024) -> DataFrame:
    """Misra-Gries: at most k keys (key, at_least), among them each that more than 1/(k+1) of the rows have.

    Each task keeps k counters; summaries add up, and the k largest sums are taken. The sums lie below
    the true counts by at most rows/(k+1), so a key over that bound stays positive and is found.
    Nulls are not counted.
    """
    kind = df.schema[key].dataType.simpleString()

    def count(batches):
        import pyarrow as pa

        held: Counter = Counter()
        for b in batches:
            held.update(x for x in b.column(0).to_pylist() if x is not None)
            if len(held) > k:
                cut = sorted(held.values(), reverse=True)[k]
                held = Counter({x: n - cut for x, n in held.items() if n > cut})
        yield pa.RecordBatch.from_pydict({key: list(held), "at_least": list(held.values())}, schema=pa.schema([(key, {"binary": pa.binary(), "string": pa.string(), "bigint": pa.int64()}[kind]), ("at_least", pa.int64())]))

    parts = df.select(key).mapInArrow(count, f"`{key}` {kind}, at_least bigint")
    return parts.groupBy(key).agg(F.sum("at_least").alias("at_least")).orderBy(F.desc("at_least"), key).limit(k)
