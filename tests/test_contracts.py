"""Cameras and record contracts on small hand-made tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from frondlake.functions import columns as C
from frondlake.operators import cameras as K
from frondlake.operators import contracts as R


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_camera_table_names_the_first_broken_rule(spark):
    schema = "set int, model string, fl_x double, fl_y double, cx double, cy double, w int, h int, k1 double, k2 double"
    base = (500.0, 500.0, 320.0, 240.0, 640, 480)
    models = frame(spark, [(1, "OPENCV", *base, 0.1, 0.0), (2, "FISHEYE", *base, 0.0, 0.0), (3, "OPENCV", *base, None, 0.2),
                           (4, "PINHOLE", -1.0, *base[1:], 0.0, None), (5, "PINHOLE", float("nan"), *base[1:], 0.0, 0.0)], schema)
    frames = frame(spark, [("a", 1, None), ("b", 2, None), ("c", 3, None), ("d", 4, None), ("e", 9, None), ("f", 1, 501.0), ("g", 1, 500.0), ("h", 1, None),
                           ("i", 5, None)], "frame string, set int, fl_x double")
    names = frame(spark, [(f, f"{f}.jpg") for f in "abcdefgi"], "frame string, name string")
    got = {r["frame"]: r["status"] for r in K.camera_table(models, frames, names).collect()}
    assert got == {"a": "ok", "b": "model", "c": "distortion", "d": "intrinsics", "e": "no_model", "f": "own_intrinsics", "g": "ok", "h": "unnamed", "i": "intrinsics"}


def test_undistort_inverts_distort_and_refuses(spark):
    k = {"k1": 0.1, "k2": -0.02, "p1": 0.001, "p2": -0.002}
    pts = frame(spark, [(i, i / 20 - 0.25, 0.2 - i / 30) for i in range(10)], "id int, x double, y double")
    bent = pts.select("id", "x", "y", *[c.alias(n) for c, n in zip(C.distort(F.col("x"), F.col("y"), k), "uv")])
    for r in bent.withColumn("s", K.undistort(F.col("u"), F.col("v"), k)).collect():
        assert abs(r["s"]["x"] - r["x"]) < 1e-9 and abs(r["s"]["y"] - r["y"]) < 1e-9
    wild = frame(spark, [(2.0, 2.0), (None, 0.1)], "u double, v double")
    assert [r[0] for r in wild.select(K.undistort(F.col("u"), F.col("v"), {"k1": -0.9})).collect()] == [None, None]


def test_pose_is_a_rotation_also_for_a_vertical_gaze(spark):
    df = frame(spark, [(1.0, 2.0, 3.0, 0.0, 0.0, -2.0), (0.0, 0.0, 0.0, 1.0, 1.0, 0.5), (1.0, 1.0, 1.0, 0.0, 0.0, 0.0)], "x double, y double, z double, a double, b double, c double")
    got = [r[0] for r in df.select(K.pose([F.col(c) for c in "xyz"], [F.col(c) for c in "abc"])).collect()]
    assert got[2] is None
    for m, gaze in zip(got[:2], ([0, 0, -2.0], [1, 1, 0.5])):
        m = np.array(m).reshape(4, 4)
        assert np.allclose(m[:3, :3].T @ m[:3, :3], np.eye(3)) and math.isclose(np.linalg.det(m[:3, :3]), 1)
        assert np.allclose(m[:3, 2], -np.array(gaze) / np.linalg.norm(gaze))


def test_ray_passes_through_its_pixel(spark):
    turn = [[0.6, -0.8, 0.0], [0.8, 0.6, 0.0], [0.0, 0.0, 1.0]]
    lens = {"fl_x": 500.0, "fl_y": 510.0, "cx": 320.0, "cy": 240.0, "k1": 0.1, "p1": 0.001}
    df = frame(spark, [(100.0, 50.0), (320.0, 240.0)], "u double, v double")
    for r in df.select("u", "v", K.ray(F.col("u"), F.col("v"), lens, turn).alias("d")).collect():
        c = np.array(turn) @ np.array(r["d"])
        x, y = c[0] / c[2], c[1] / c[2]
        r2 = x * x + y * y
        assert abs(500 * (x * (1 + 0.1 * r2) + 0.002 * x * y) + 320 - r["u"]) < 1e-6
        assert abs(510 * (y * (1 + 0.1 * r2) + 0.001 * (r2 + 2 * y * y)) + 240 - r["v"]) < 1e-6


def test_click_faults(spark):
    images = frame(spark, [("a", 10.0, 10.0), ("a", 10.0, 10.0), ("b", 0.0, 5.0), (None, 1.0, 1.0)], "name string, width double, height double")
    points = frame(spark, [("a", "p", 0.0, 10.0), ("a", "q", 1.0, 11.0), ("a", "q", 1.0, 1.0), ("a", " r", 1.0, 1.0), ("a", "s", float("nan"), 1.0), ("z", "t", 1.0, 1.0),
                           ("b", "u", 1.0, 1.0), ("a", None, 1.0, 1.0), ("a", "v", None, 1.0)], "image string, label string, x double, y double")
    assert rows(R.click_faults(images, points)) == sorted([
        ("a", None, "repeated_image"), ("b", None, "bad_size"), (None, None, "unnamed_image"), ("a", "q", "repeated_label"), ("a", "q", "outside"),
        ("a", " r", "bad_label"), ("a", "s", "not_finite"), ("z", "t", "unknown_image"), ("b", "u", "unknown_image"), ("a", None, "bad_label"), ("a", "v", "not_finite")], key=repr)


def test_captures_hidden_links_and_nested(spark):
    folders = frame(spark, [("c/one/images", False), ("c/one/deep/two/images", False), ("c/.old/three/images", False), ("c/linked", True), ("c/linked/four/images", False),
                            ("c/five/images", True), ("c/six/raw", None), ("images", False)], "path string, link boolean")
    assert rows(R.captures(folders)) == [("c/one", None), ("c/one/deep/two", "c/one")]
    assert R.captures(folders.limit(0)).count() == 0


def test_detached(spark):
    sizes = frame(spark, [("a", 100), ("b", 95), ("c", 10), ("d", 10), ("e", 10)], "cluster string, size long")
    got = rows(R.detached(sizes, frame(spark, [("c",), ("c",)], "cluster string"), frame(spark, [("d",), ("d",)], "cluster string"), 0.9))
    assert got == [("a", 100, 0, "large"), ("b", 95, 0, "large"), ("c", 10, 0, "used"), ("d", 10, 2, "overlaps"), ("e", 10, 0, "detached")]


def test_leaf_ends(spark):
    leaves = frame(spark, [(i, leaf, x0 + i % 10 / 10, 0.0, 0.0) for leaf, x0, first in (("l", 0.0, 0), ("m", 10.0, 10), ("n", 50.0, 20)) for i in range(first, first + (10 if leaf != "n" else 2))],
                   "id long, leaf string, x double, y double, z double")
    tips = frame(spark, [(100, -0.05, 0.0, 0.0)], "id long, x double, y double, z double")
    net = frame(spark, [(200, 1.0, 0.0, 0.0), (201, 12.0, 0.0, 0.0)], "id long, x double, y double, z double")
    got = {r["leaf"]: (r["base"], r["node"], round(r["distance"], 6), r["rule"]) for r in R.leaf_ends(leaves, tips, net, 0.1, 5).collect()}
    assert got == {"l": (0, 100, 0.05, "tip"), "m": (19, 201, 1.1, "nearest")}


def test_group_faults(spark):
    m = frame(spark, [("g", "same", 1), ("g", "same", 2), ("h", "same", 2), ("h", "same", 9), ("i", "pair", 1), ("i", "pair", 1), ("j", "odd", 3), ("j", "odd", 4), ("k", "pair", 3), ("k", "pair", 4)],
              '`group` string, kind string, member int')
    known = frame(spark, [(i,) for i in (1, 2, 3, 4)], "member int")
    assert rows(R.group_faults(m, known, ("same", "pair"), "pair", "same")) == sorted([
        ("g", "shared_member"), ("h", "shared_member"), ("h", "unknown_member"), ("i", "repeated_member"), ("i", "too_few"), ("j", "kind")], key=repr)


def test_document_differences_and_references(spark):
    a = frame(spark, [(1, "x"), (2, None), (3, "y"), (5, None)], "k int, v string")
    b = frame(spark, [(1, "x"), (2, None), (3, "z"), (4, "w")], "k int, v string")
    assert rows(R.document_differences(a, b, "k")) == [(1, "same"), (2, "same"), (3, "changed"), (4, "missing"), (5, "surplus")]
    refs = frame(spark, [(1, "a", "d"), (2, "a", "e"), (3, "b", "d"), (4, None, None)], "owner int, target string, digest string")
    assert rows(R.reference_status(refs, frame(spark, [("a", "d")], "target string, digest string"))) == [(1, "a", "ok"), (2, "a", "changed"), (3, "b", "missing"), (4, None, "missing")]


@pytest.mark.parametrize("links,want", [([], []), ([(1, 2), (2, 3)], []), ([(1, 1)], [1]), ([(1, 2), (2, 3), (3, 4), (4, 2), (5, 1), (6, None)], [2, 3, 4]),
                                        ([(i, (i + 1) % 40) for i in range(40)] + [(100, 0)], list(range(40)))])
def test_cycle_members(spark, links, want):
    assert [r[0] for r in rows(R.cycle_members(frame(spark, links, "id long, to long")))] == sorted(want, key=lambda v: repr((v,)))


def test_labels(spark):
    labels = frame(spark, [("tape_5cm",), ("tape_5.0cm",), ("tape_7.5cm",), ("tape_7.5cm",), ("tape_xcm",), ("leaf1_base",), ("leaf1_tip",), ("a_b_tip",), ("tape_1_tip",), ("_tip",), (None,)], "label string")
    assert rows(R.graduations(labels)) == [("tape_5.0cm", 5.0, True), ("tape_5cm", 5.0, True), ("tape_7.5cm", 7.5, False)]
    assert rows(R.end_pairs(labels)) == [("a_b", None, "a_b_tip"), ("leaf1", "leaf1_base", "leaf1_tip")]


def test_anchor_and_sample(spark):
    df = frame(spark, [(i, "g", float(i), 0.0, 0.0) for i in range(5)] + [(9, "h", 1.0, 1.0, 1.0)], "id long, g string, x double, y double, z double")
    assert rows(R.anchors(df, "g")) == [("g", 2, 5), ("h", 9, 1)]
    once, again = rows(R.seeded_sample(df, 3, 1, "id")), rows(R.seeded_sample(df.repartition(4), 3, 1, "id"))
    assert once == again and len(once) == 3


def test_completed_match(spark):
    jobs = frame(spark, [(1, "a", 1, "completed", True, "s"), (2, "a", 2, "failed", True, "s"), (3, "b", 1, "completed", True, "t"), (4, "c", 1, "completed", None, "s"), (5, "d", 1, "completed", True, "s"),
                         (6, "f", 1, "completed", True, None)], "job int, capture string, seq int, status string, verified boolean, settings string")
    caps = frame(spark, [(c, "s" if c != "f" else None) for c in "abcdef"], "capture string, settings string")
    recorded = frame(spark, [(1, "x"), (1, "y"), (5, "x"), (5, "old")], "job int, input string")
    current = frame(spark, [("a", "x"), ("a", "y"), ("d", "x"), ("d", "n1"), ("d", "n2")], "capture string, input string")
    assert rows(R.completed_match(jobs, caps, recorded, current)) == sorted([
        ("a", 1, "completed"), ("b", None, "settings"), ("c", None, "unverified"), ("d", None, "images +2 -1"), ("e", None, "none"), ("f", 6, "completed")], key=repr)


def test_exports_reload(spark):
    leaves = frame(spark, [("l1", 5, "s1"), ("l2", 5, None), ("l3", 0, None), ("l4", 5, "s4"), ("l5", 5, "s5"), ("l6", 5, "s1"), ("l7", 5, "s9")], "leaf string, points long, stalk string")
    stalks = frame(spark, [("s1", "l1", "j1", 1.0, 2.0, 3.0), ("s4", "l4", "j9", 1.0, 2.0, 3.0), ("s5", "l5", "j1", 1.0, 2.5, 3.0)], "stalk string, leaf string, joint string, x double, y double, z double")
    joints = frame(spark, [("j1", 1.0, 2.0, 3.0)], "joint string, x double, y double, z double")
    out = R.leaf_exports(leaves, stalks, joints).union(frame(spark, [("l8", "not json")], "leaf string, document string"))
    assert dict(rows(R.reload_faults(out))) == {"l1": "ok", "l2": "ok", "l3": "count", "l4": "attachment_missing", "l5": "off_attachment", "l6": "other_petiole",
                                                "l7": "attachment_without_petiole", "l8": "unreadable"}


def test_assign_detached(spark):
    plants = frame(spark, [(1, 0.0, 10.0, 0.0, 50.0), (2, 8.0, 10.0, 0.0, 50.0), (3, 100.0, 2.0, 0.0, 10.0)], "plant int, at double, radius double, low double, high double")
    clusters = frame(spark, [("a", -4.0, 20.0), ("b", 4.0, 20.0), ("c", 101.0, 14.0), ("d", 101.0, 15.5), ("e", 500.0, 1.0), ("f", None, 1.0), ("g", 98.95, 5.0)], "cluster string, at double, height double")
    assert rows(R.assign_detached(clusters, plants, 0.5, 0.55, 5.0)) == [("a", 1), ("b", None), ("c", 3), ("d", None), ("e", None), ("f", None), ("g", None)]
    assert rows(R.assign_detached(clusters, plants.limit(0), 0.5, 0.55, 5.0)) == [(c, None) for c in "abcdefg"]
