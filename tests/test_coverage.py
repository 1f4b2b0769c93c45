"""Coverage merge: a fold that covers and touches, one that only covers, one that only touches."""

from frondlake.operators.relations import merge_by_coverage


def test_merge_by_coverage(spark):
    # leaf 0 is split: photos 1-2 see its items as instance 0 and 1, photo 3 sees half of it as 2;
    # leaf 9 lies behind it in photos 1-2 (covered, far away)
    whole, half, far = list(range(0, 60)), list(range(60, 90)), list(range(100, 130))
    inst = {0: (1, whole + half[:25]), 1: (2, whole + half[:24]), 2: (3, half), 3: (4, half), 4: (5, far), 5: (1, far[:3]), 6: (6, whole), 7: (7, half)}
    cluster = {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 0, 6: 0, 7: 2}
    rows = [(i, p, g) for i, (p, items) in inst.items() for g in items]
    visible = [(p, g) for p in (1, 2) for g in whole + half + far] + [(p, g) for p in (3, 4) for g in half] + [(5, g) for g in far]
    place = [(g, g * 0.01, 0.0, 0.0) for g in whole + half] + [(g, g * 0.01, 50.0, 0.0) for g in far]
    got, folds = merge_by_coverage(
        spark.createDataFrame(rows, "instance long, photo long, item long"), spark.createDataFrame(visible, "photo long, item long"),
        spark.createDataFrame(list(cluster.items()), "instance long, cluster long"), spark.createDataFrame(place, "id long, x double, y double, z double"),
        0.5, 0.6, 0.5)
    assert folds == [(0, 2)]
    assert {r["instance"]: r["cluster"] for r in got.collect()} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 4, 5: 0, 6: 0, 7: 0}
