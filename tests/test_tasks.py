"""Keyed joins and groups run in as many tasks as their rows need, whatever the session's partitions are."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from frondlake import session
from frondlake.operators import contracts as K
from frondlake.operators import relations as R


def fullest(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


@pytest.fixture()
def small_tasks(monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 100, raising=False)


def test_orphans_and_duplicates_in_bounded_tasks(spark, small_tasks):
    child = spark.range(3000).select((F.col("id") % 1500).alias("k"), (F.col("id") % 3).alias("part"))
    parent = spark.range(0, 3000, 2).select(F.col("id").alias("p")).union(spark.range(10).select("id"))
    lost = R.orphans(child, parent, "k", "p")
    assert sorted(r["k"] for r in lost.collect()) == sorted(2 * list(range(11, 1500, 2)))
    assert fullest(lost) < 200
    twice = R.duplicates(child, ["k", "part"])
    assert sorted((r["k"], r["n"]) for r in twice.collect()) == [(k, 2) for k in range(1500)]
    assert fullest(twice) < 200


def test_hot_and_missing_keys_of_orphans(spark, small_tasks):
    child = spark.createDataFrame([(1,)] * 500 + [(2,)] * 500 + [(None,)] * 3, "k int")
    parent = spark.createDataFrame([(2,), (2,), (None,)], "p int")
    assert sorted(((r["k"], r["count"]) for r in R.orphans(child, parent, "k", "p").groupBy("k").count().collect()), key=str) == [(1, 500), (None, 3)]


def test_referential_violations_in_bounded_tasks(spark, sf_dir, monkeypatch):
    want = sorted(map(tuple, E.queries()["referential_violations"](spark, sf_dir).collect()))
    monkeypatch.setattr(session, "TASK_ROWS", 100, raising=False)
    got = E.queries()["referential_violations"](spark, sf_dir)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 1000
    assert fullest(got) < 300


def test_group_faults_in_bounded_tasks(spark, small_tasks):
    members = spark.range(3000).select((F.col("id") % 1000).alias("group"), F.when(F.col("id") % 1000 < 500, "same").otherwise("pair").alias("kind"),
                                       (F.col("id") % 1000 + F.col("id") / 1000).cast("long").alias("member"))
    known = spark.range(900).select(F.col("id").alias("member")).union(spark.range(5).select("id"))
    found = K.group_faults(members, known, ("same", "pair"), "pair", "same")
    want = [(g, "shared_member") for g in range(500)] + [(g, "not_a_pair") for g in range(500, 1000)] + [(g, "unknown_member") for g in range(898, 1000)]
    assert sorted(map(tuple, found.collect())) == sorted(want)
    assert fullest(found) < 200


def test_hot_members_and_missing_groups(spark, small_tasks):
    members = spark.createDataFrame([(g, "same", 1) for g in range(400)] + [(None, "same", 2), (7, "same", 2), (8, "same", None), (9, "same", None)],
                                    "`group` int, kind string, member int")
    known = spark.createDataFrame([(1,), (1,), (None,)], "member int")
    found = sorted(map(tuple, K.group_faults(members, known, ("same",), "pair", "same").collect()), key=str)
    few = [(g, "too_few") for g in [None, *range(7), *range(10, 400)]]
    assert found == sorted([(g, "shared_member") for g in range(400)] + few + [(g, "unknown_member") for g in (None, 7, 8, 9)], key=str)


def test_leaf_groups_joins_in_bounded_tasks(spark, sf_dir, monkeypatch):
    want = sorted(map(tuple, E.queries()["leaf_groups"](spark, sf_dir).collect()))
    seen = []
    plain = K.group_faults
    monkeypatch.setattr(session, "TASK_ROWS", 100, raising=False)
    monkeypatch.setattr(K, "group_faults", lambda m, *a: seen.append(m) or plain(m, *a))
    assert sorted(map(tuple, E.queries()["leaf_groups"](spark, sf_dir).collect())) == want and len(want) > 3
    assert fullest(seen[0]) < 250
