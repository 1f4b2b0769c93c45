import numpy as np
from pyspark.sql import functions as F

from frondlake.streaming.runs import SAMPLE, GuardTable, Limits, decide

LIMITS = Limits(stop=5.0, relief=100.0, period=10.0)


def replay(rows):
    """One run after the other, sample by sample."""
    actions, states = {}, {}
    for run, ts, seq, value, scope, own, memory, oom in sorted(rows, key=lambda r: (r[1], r[2])):
        s = states.setdefault(run, {"peak": None, "oom": None, "failed": 0, "releases": 0, "last": None, "stop": None, "own": None})
        if s["stop"] is not None:
            actions[run, seq] = "ended"
            continue
        s["own"] = scope is not None and scope != own
        if s["own"]:
            for name, v in (("peak", memory), ("oom", oom)):
                s[name] = v if s[name] is None else s[name] if v is None else max(s[name], v)
        act = "none"
        if value is None:
            act = "probe_failed"
            s["failed"] += 1
        elif value < 5:
            act, s["stop"] = "stop", ts
        elif value < 100 and (s["last"] is None or ts - s["last"] >= 10):
            act, s["last"] = "release", ts
            s["releases"] += 1
        actions[run, seq] = act
    return actions, {k: tuple(s[n] for n in ("peak", "oom", "failed", "releases", "last", "stop", "own")) for k, s in states.items()}


def made(n, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for seq in range(n):
        run = None if seq % 29 == 0 else int(rng.integers(0, 3)) if seq % 2 else 7
        own = None if seq % 31 == 0 else "guard"
        rows.append((run, float(seq // 2), seq, None if seq % 11 == 0 else float(rng.choice([1.0, 50.0, 500.0], p=[0.01, 0.6, 0.39])),
                     [None, "guard", "run"][int(rng.integers(0, 3))], own, float(rng.integers(0, 99)), int(rng.integers(0, 4))))
    return rows


def states(df):
    return {r.run: (r.peak, r.oom, r.failed, r.releases, r.last_release, r.stop_at, r.dedicated) for r in df.collect()}


def test_batch_against_a_replay(spark):
    rows = made(300, 5)
    decided, changed = decide(spark.createDataFrame(rows, SAMPLE).withColumn("note", F.lit("x")), LIMITS)
    actions, want = replay(rows)
    assert {(r.run, r.seq): r.action for r in decided.collect()} == actions and states(changed) == want
    assert {"release", "none", "probe_failed", "stop", "ended"} <= set(actions.values())
    decided, changed = decide(spark.createDataFrame([], SAMPLE), LIMITS)
    assert decided.count() == 0 and changed.count() == 0


def test_stream_agrees_with_the_batch_and_writes_changed_runs_only(spark, tmp_path):
    rows = made(240, 8)
    rows[151] = (1, 75.25, 151, 2.0, "run", "guard", 5.0, 1)
    guard = GuardTable(spark, str(tmp_path / "out"), LIMITS, whole=2)
    assert guard.state().count() == 0
    for part in (rows[:100], rows[100:180], rows[180:]):
        spark.createDataFrame(part, SAMPLE).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        guard.follow(str(tmp_path / "in"))
    actions, want = replay(rows)
    assert {(r.run, r.seq): r.action for r in guard.actions().collect()} == actions and states(guard.state()) == want
    # a fourth batch: one new run, one late sample of a run still on, one of an ended run
    ended = next(k for k, v in want.items() if v[5] is not None)
    going = [k for k, v in want.items() if v[5] is None]
    more = [(99, 500.0, 900, 50.0, "run", "guard", 7.0, 0), (ended, 500.0, 901, 50.0, "run", "guard", 1e6, 0)] + [
        (k, 0.0, -1, 1.0, "run", "guard", 1e5, 9) for k in going[:1]]
    spark.createDataFrame(more, SAMPLE).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    guard.follow(str(tmp_path / "in"))
    last = {r.seq: r.action for r in guard.actions().filter("batch = 3").collect()}
    assert last == {900: "release", 901: "ended"} | ({-1: "late"} if going else {})
    written = spark.read.parquet(str(tmp_path / "out/state/whole=0/batch=3"))
    assert {r.run for r in written.collect()} == {99, *going[:1]}
    assert states(guard.state())[ended] == want[ended]
    # a batch repeated after a failure gives the same rows
    before = states(guard.state())
    guard.put(spark.createDataFrame(more, SAMPLE), 3)
    assert states(guard.state()) == before
