"""Host-memory samples as a stream: folded maxima, and stop / release decisions per run."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SAMPLE = "user_id BIGINT, event_type STRING, value DOUBLE"


def folded(samples: DataFrame) -> DataFrame:
    """Peak and failed probes per run; a failed probe never raises a peak."""
    bad = F.col("event_type") == "error"
    return samples.groupBy("user_id").agg(F.max(F.when(~bad, F.col("value"))).alias("peak"), F.count_if(bad).alias("failed"))


def fold_to_table(spark: SparkSession, source: str, sink: str, checkpoint: str | None = None) -> DataFrame:
    """Run the stream over what source holds now; a batch writes the runs that it changed, under its own id."""
    stream = spark.readStream.schema(SAMPLE).option("maxFilesPerTrigger", 64).json(source)

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={batch_id:09d}")

    q = (folded(stream).writeStream.outputMode("update").foreachBatch(put)
         .option("checkpointLocation", checkpoint or f"{sink}-state").trigger(availableNow=True).start())
    q.awaitTermination()
    latest = F.max_by(F.struct("peak", "failed"), "batch").alias("last")
    return spark.read.parquet(sink).groupBy("user_id").agg(latest).select("user_id", "last.*")


def decide(samples: DataFrame, stop_below: float, relief_below: float, period: float) -> DataFrame:
    """Stream of (run, ts, value) to (run, ts, action). Stop wins over release, a release comes at
    most once per period, a null value is a failed probe and changes nothing. State is one number
    per run: the time of its last release."""

    def act(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values("ts")
        out = []
        for ts, value in zip(rows["ts"], rows["value"]):
            if pd.isna(value):
                out.append("probe_failed")
            elif value < stop_below:
                out.append("stop")
            elif value < relief_below and (last is None or ts - last >= period):
                last = ts
                out.append("release")
            else:
                out.append("none")
        if last is not None:
            state.update((last,))
        yield pd.DataFrame({"run": key[0], "ts": rows["ts"], "action": out})

    return samples.groupBy("run").applyInPandasWithState(
        act, "run BIGINT, ts DOUBLE, action STRING", "last DOUBLE", "append", "NoTimeout")


def admission(df: DataFrame, start_below: dict[str, float]) -> DataFrame:
    """Reasons a run must not start: every named reading below its limit; nulls are not checked."""
    checks = [F.when(F.col(c) < limit, F.lit(c)) for c, limit in start_below.items()]
    return df.withColumn("problems", F.array_compact(F.array(*checks)))


def headroom(df: DataFrame, run: str, ts: str, value: str, need: float, deadline: float) -> DataFrame:
    """First sample per run at or above ``need`` within ``deadline`` of the run's start, else null."""
    start = df.groupBy(run).agg(F.min(ts).alias("__start"))
    j = df.join(start, run)
    ok = (F.col(value) >= need) & (F.col(ts) - F.col("__start") <= deadline)
    return j.groupBy(run).agg(F.min(F.when(ok, F.col(ts))).alias("ready_at"))
