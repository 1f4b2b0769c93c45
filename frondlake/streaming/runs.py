"""Guarded runs: decisions per sample and one status row per run, in batches that carry the state on.

A batch is decided by joins and ordered operators, so the backlog of one run is cut into blocks like
any other hot key. The state between batches is a table of the runs that changed, keyed by run; a
batch that is repeated after a failure reads the state before it and writes the same rows again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frondlake.operators.ordered import attach, pair_period
from frondlake.session import durable

SAMPLE = "run BIGINT, ts DOUBLE, seq BIGINT, value DOUBLE, scope STRING, own_scope STRING, memory DOUBLE, oom BIGINT"
STATE = ("run BIGINT, peak DOUBLE, oom BIGINT, failed BIGINT, releases BIGINT, last_release DOUBLE, stop_at DOUBLE, stop_seq BIGINT, "
         "seen_at DOUBLE, seen_seq BIGINT, dedicated BOOLEAN")


@dataclass
class Limits:
    """``value`` below stop ends the run; below relief it releases, at most once per period."""

    stop: float
    relief: float
    period: float


def dedicated(scope: Column, own: Column) -> Column:
    """A scope of the run's own: readable, and not the one the guard lives in."""
    return scope.isNotNull() & ~scope.eqNullSafe(own)


def _not_after(at: str, seq: str) -> Column:
    """The sample lies at or before (at, seq); samples without a time or number sort first."""
    return F.struct("ts", "seq") <= F.struct(F.col(at), F.col(seq))


def _known(state: DataFrame | None, spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE) if state is None else state.select(*[c.split()[0] for c in STATE.split(", ")])


def decide(samples: DataFrame, limits: Limits, state: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(samples with ``action``, states of the runs that changed). Samples are SAMPLE rows, one per run, ts
    and seq; state holds at most one STATE row a run.

    Actions: ``ended`` after the run's stop, ``late`` at or before what an earlier batch saw last,
    ``probe_failed`` for a null value, ``stop`` (the first value below stop), ``release``, ``none``.
    A stop wins over a release; a failed probe or a late sample decides nothing. ``peak`` and ``oom``
    are maxima over samples taken in a scope of the run's own; shared scopes are gated out, failed
    probes and late samples are not. Samples after the stop are not part of the run and fold nothing.
    A null run is a run of its own. An empty batch decides and changes nothing."""
    spark = samples.sparkSession
    known = _known(state, spark)
    touched = attach(known, samples.select("run").distinct(), ["run"], "left_semi")
    held = touched.select("run", *[F.col(c).alias("__" + c) for c in ("last_release", "stop_at", "stop_seq", "seen_at", "seen_seq")])
    rows = attach(samples, held, ["run"])
    ended = F.coalesce(F.col("__stop_seq").isNotNull() & ~_not_after("__stop_at", "__stop_seq"), F.lit(False))
    late = F.coalesce(F.col("__seen_seq").isNotNull() & _not_after("__seen_at", "__seen_seq"), F.lit(False))
    rows = durable(rows.withColumn("__ended", ended).withColumn("__late", late))

    live = rows.filter("not __ended and not __late and value is not null")
    stops = live.filter(F.col("value") < limits.stop).groupBy("run").agg(F.min(F.struct("ts", "seq")).alias("__stop"))
    rows = attach(rows, stops, ["run"])
    past = F.coalesce(F.col("__ended") | (F.struct("ts", "seq") > F.col("__stop")), F.lit(False))
    rows = durable(rows.withColumn("__past", F.col("__ended") | past))

    wanted = rows.filter(~F.col("__past") & ~F.col("__late") & (F.col("value") >= limits.stop) & (F.col("value") < limits.relief)
                         & F.coalesce(F.col("ts") - F.col("__last_release") >= limits.period, F.lit(True)) & F.col("ts").isNotNull())
    first = durable(wanted.groupBy("run", "ts").agg(F.min("seq").alias("seq")))
    kept = pair_period(first, ["run"], "ts", limits.period).select("run", "ts", "seq", F.lit(True).alias("__release"))
    rows = attach(rows, kept, ["run", "ts", "seq"])
    action = (F.when(F.col("__past"), "ended").when(F.col("__late"), "late").when(F.col("value").isNull(), "probe_failed")
              .when(F.struct("ts", "seq") == F.col("__stop"), "stop").when(F.col("__release"), "release").otherwise("none"))
    decided = durable(rows.withColumn("action", action).select(*samples.columns, "action"))
    return decided, folded(decided, touched)


def folded(decided: DataFrame, before: DataFrame) -> DataFrame:
    """States after decided samples, of the runs whose state differs from ``before``."""
    inside = decided.filter("action <> 'ended'")
    own = dedicated(F.col("scope"), F.col("own_scope"))
    is_ = lambda name: F.col("action") == name
    now = inside.groupBy("run").agg(
        F.max(F.when(own, F.col("memory"))).alias("peak"), F.max(F.when(own, F.col("oom"))).alias("oom"),
        F.count_if(is_("probe_failed")).alias("failed"), F.count_if(is_("release")).alias("releases"),
        F.max(F.when(is_("release"), F.col("ts"))).alias("last_release"), F.max(F.when(is_("stop"), F.struct("ts", "seq"))).alias("stop"),
        F.max(F.struct(F.struct("ts", "seq").alias("at"), own.alias("own"))).alias("seen"))
    new = now.select("run", "peak", "oom", "failed", "releases", "last_release", F.col("stop.ts").alias("stop_at"), F.col("stop.seq").alias("stop_seq"),
                     F.col("seen.at.ts").alias("seen_at"), F.col("seen.at.seq").alias("seen_seq"), F.col("seen.own").alias("dedicated"))
    old = before.select("run", F.struct(*[c for c in before.columns if c != "run"]).alias("o"))
    both = attach(new, old, ["run"])
    later = F.col("o").isNull() | (F.struct("seen_at", "seen_seq") > F.struct("o.seen_at", "o.seen_seq"))
    both = both.withColumn("__later", F.coalesce(later, F.lit(True)))
    state = both.select(
        "run", F.greatest("peak", "o.peak").alias("peak"), F.greatest("oom", "o.oom").alias("oom"),
        (F.col("failed") + F.coalesce("o.failed", F.lit(0))).alias("failed"), (F.col("releases") + F.coalesce("o.releases", F.lit(0))).alias("releases"),
        F.greatest("last_release", "o.last_release").alias("last_release"),
        F.coalesce("stop_at", "o.stop_at").alias("stop_at"), F.coalesce("stop_seq", "o.stop_seq").alias("stop_seq"),
        *[F.when(F.col("__later"), F.col(c)).otherwise(F.col("o." + c)).alias(c) for c in ("seen_at", "seen_seq", "dedicated")], "o")
    fields = [c for c in state.columns if c not in ("run", "o")]
    return state.filter(~F.struct(*fields).eqNullSafe(F.struct(*["o." + c for c in fields])) | F.col("o").isNull()).drop("o")


class GuardTable:
    """Decisions and states of a stream of samples under one folder: ``actions/batch=N`` holds the
    decided samples of a batch, ``state/whole=0/batch=N`` the runs it changed; every ``whole`` batches
    all states are written together, so a reader looks at few versions."""

    def __init__(self, spark: SparkSession, folder: str, limits: Limits, whole: int = 64):
        self.spark, self.folder, self.limits, self.whole = spark, folder, limits, whole

    def _versions(self, name: str, schema: str) -> DataFrame:
        """Rows of a table of batches; empty before the first batch."""
        empty = self.spark.createDataFrame([], schema)
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return empty
        return self.spark.read.schema(schema).option("basePath", f"{self.folder}/{name}").parquet(f"{self.folder}/{name}")

    def state(self, before: int | None = None) -> DataFrame:
        """The last state of each run, or that before a batch."""
        rows = self._versions("state", STATE + ", whole INT, batch BIGINT")
        if before is not None:
            rows = rows.filter(F.col("batch") < before)
        base = rows.filter("whole = 1").agg(F.coalesce(F.max("batch"), F.lit(-1)).alias("b")).first()["b"]
        rows = rows.filter((F.col("batch") > base) | ((F.col("batch") == base) & (F.col("whole") == 1)))
        fields = [c for c in rows.columns if c not in ("run", "whole", "batch")]
        return rows.groupBy("run").agg(F.max_by(F.struct(*fields), "batch").alias("s")).select("run", "s.*")

    def actions(self) -> DataFrame:
        return self._versions("actions", SAMPLE + ", action STRING, batch BIGINT")

    def put(self, batch: DataFrame, batch_id: int) -> None:
        before = self.state(batch_id)
        decided, changed = decide(batch, self.limits, before)
        decided.write.mode("overwrite").parquet(f"{self.folder}/actions/batch={batch_id}")
        changed.write.mode("overwrite").parquet(f"{self.folder}/state/whole=0/batch={batch_id}")
        if (batch_id + 1) % self.whole == 0:
            self.state(batch_id + 1).write.mode("overwrite").parquet(f"{self.folder}/state/whole=1/batch={batch_id}")

    def follow(self, source: str, files: int = 64) -> None:
        """Take the JSON sample files that source holds now, at most ``files`` a batch, from where the
        last call ended."""
        stream = self.spark.readStream.schema(SAMPLE).option("maxFilesPerTrigger", files).json(source)
        (stream.writeStream.foreachBatch(self.put).option("checkpointLocation", f"{self.folder}/progress")
         .trigger(availableNow=True).start().awaitTermination())
