"""Streaming forms: file replay with keyed state, and micro-batch replenishment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.versions import VERSION, Replay

STATE = "made int, last int, files map<string,struct<version:string,status:string,content:string>>"


def replay_stream(records: DataFrame) -> DataFrame:
    """The versions that `operators.versions.replay` gives, from a stream of records.

    State by session: the version counter, the last order and each file's latest version. A record
    whose order is not after the last one is an error, not late data.
    """
    need = ["session_id", "id", "ord", "kind", "workspace", "path", "content", "complete", "success", "changes"]

    def step(key, frames, state):
        import pandas as pd

        made, last, files = state.get if state.exists else (0, 0, {})
        r = Replay({p: tuple(v) for p, v in dict(files or {}).items()}, made)
        rows = pd.concat(list(frames)).sort_values("ord")
        out = []
        for rec in rows.astype(object).where(rows.notna(), None).to_dict("records"):
            if rec["ord"] <= last:
                raise ValueError(f"order {rec['ord']} of {key[0]} is not after {last}")
            last = int(rec["ord"])
            out += [{"session_id": key[0]} | v for v in r.take(rec)]
        state.update((r.made, last, r.state))
        names = [c.strip().split(" ")[0] for c in VERSION.split(",")]
        yield pd.DataFrame(out, columns=names)

    rows = records.where(F.col("kind").isin("observation", "patch")).select(*need)
    return rows.groupBy("session_id").applyInPandasWithState(step, VERSION, STATE, "append", "NoTimeout")


def replenish_stream(candidates: DataFrame, sink: str, checkpoint: str, limits: dict[str, int], choose):
    """Selects from all outcomes so far after every micro-batch: outcomes are appended by batch id, the selection is written anew.

    A batch that is run again overwrites its own outcomes, so a restart changes nothing.
    """
    def each(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{sink}/outcomes/part={epoch}")
        outcomes = spark.read.parquet(f"{sink}/outcomes")
        choose(outcomes, limits).write.mode("overwrite").parquet(f"{sink}/selected")

    return candidates.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)


def stage_counts_stream(events: DataFrame, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Events by window and type, with a watermark for late rows."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"))
