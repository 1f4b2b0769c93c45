"""Binary and text sources against bytes built by hand."""

import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from frondlake.sources import binary as B
from frondlake.sources import text as X

DTYPE = np.dtype([(n, "<f4") for n in ("x", "y", "z", "nx", "f_dc_0", "f_dc_1", "f_dc_2", "opacity", "scale_0", "scale_1", "scale_2")] + [("flag", "u1")])


def write_ply(path, rows, declared=None, extra=b""):
    names = {"f4": "float", "u1": "uchar"}
    head = ["ply", "format binary_little_endian 1.0", "comment made by hand", f"element vertex {declared or len(rows)}"]
    head += [f"property {names[DTYPE[n].str[1:]]} {n}" for n in DTYPE.names] + ["end_header"]
    path.write_bytes(("\n".join(head) + "\n").encode() + rows.tobytes() + extra)


@pytest.fixture()
def cloud():
    rng = np.random.default_rng(1)
    rows = np.zeros(200, DTYPE)
    for n in DTYPE.names[:-1]:
        rows[n] = rng.normal(size=200)
    rows["flag"] = np.arange(200)
    return rows


def load(spark, path, **options):
    B.register(spark)
    return spark.read.format("splat_ply").options(path=str(path), **options).load()


def test_ply_reads_ranges_in_row_order(spark, tmp_path, cloud):
    write_ply(tmp_path / "a.ply", cloud)
    df = load(spark, tmp_path / "a.ply", mode="FAILFAST", rowsPerPartition=64, rowsPerBatch=10)
    assert df.rdd.getNumPartitions() == 4
    got = df.orderBy("row_id").toPandas()
    assert got["row_id"].tolist() == list(range(200))
    assert (got["x"].to_numpy() == cloud["x"]).all() and got["flag"].tolist() == list(range(200))
    assert dict(df.dtypes)["flag"] == "smallint"


def test_ply_short_body(spark, tmp_path, cloud):
    write_ply(tmp_path / "a.ply", cloud, declared=250)
    assert load(spark, tmp_path / "a.ply").count() == 200
    assert B.PlyHeader(str(tmp_path / "a.ply"), False).declared == 250
    with pytest.raises(Exception, match="extra or missing bytes"):
        load(spark, tmp_path / "a.ply", mode="FAILFAST").count()


def test_ply_strict_refusals(spark, tmp_path, cloud):
    write_ply(tmp_path / "t.ply", cloud, extra=b"zz")
    with pytest.raises(Exception, match="extra or missing"):
        load(spark, tmp_path / "t.ply", mode="FAILFAST").count()
    cloud["opacity"][3] = np.nan
    write_ply(tmp_path / "n.ply", cloud)
    with pytest.raises(Exception, match="non-finite opacity"):
        load(spark, tmp_path / "n.ply", mode="FAILFAST").count()


def test_ply_write_and_read_back(spark, tmp_path, cloud):
    write_ply(tmp_path / "a.ply", cloud)
    df = load(spark, tmp_path / "a.ply").filter("x > 0").drop("flag")
    out = tmp_path / "out"
    df.repartitionByRange(3, "row_id").sortWithinPartitions("row_id").write.format("splat_ply").option("path", str(out)).mode("append").save()
    assert len(list(out.glob("part-*.ply"))) == 3 and not list(out.glob(".*"))
    back = load(spark, out, mode="FAILFAST")
    keep = cloud[cloud["x"] > 0]
    got = back.orderBy("row_id").toPandas()
    assert (got["y"].to_numpy() == keep["y"]).all()
    a, b = df.drop("row_id"), back.drop("row_id")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    with pytest.raises(Exception, match="already holds"):
        df.write.format("splat_ply").option("path", str(out)).mode("append").save()


def test_colmap_models(spark, tmp_path):
    points = struct.pack("<Q", 2)
    for pid, track in ((7, [(1, 0), (2, 5)]), (9, [])):
        points += struct.pack("<Q3d3BdQ", pid, 1.0, 2.0, pid * 1.0, 10, 20, 30, 0.5, len(track)) + b"".join(struct.pack("<ii", *t) for t in track)
    (tmp_path / "points3D.bin").write_bytes(points)
    images = struct.pack("<Q", 1) + struct.pack("<i7di", 3, 1, 0, 0, 0, .1, .2, .3, 1) + b"a_01.jpg\0" + struct.pack("<Q", 2) + struct.pack("<ddq", 5, 6, 7) + struct.pack("<ddq", 8, 9, -1)
    (tmp_path / "images.bin").write_bytes(images)
    (tmp_path / "cameras.bin").write_bytes(struct.pack("<Q", 1) + struct.pack("<iiQQ", 1, 4, 640, 480) + struct.pack("<8d", *range(8)))
    B.register(spark)
    p = spark.read.format("colmap_points").option("path", str(tmp_path)).load().orderBy("point_id").collect()
    assert [r["point_id"] for r in p] == [7, 9] and [tuple(t) for t in p[0]["track"]] == [(1, 0), (2, 5)] and p[1]["track"] == []
    i = spark.read.format("colmap_images").option("path", str(tmp_path)).load().first()
    assert i["name"] == "a_01.jpg" and i["keypoints"][1]["point_id"] == -1
    c = spark.read.format("colmap_cameras").option("path", str(tmp_path)).load().first()
    assert c["model"] == "OPENCV" and c["params"] == [float(x) for x in range(8)]
    (tmp_path / "points3D.bin").write_bytes(points + b"x")
    with pytest.raises(Exception, match="trailing bytes"):
        spark.read.format("colmap_points").option("path", str(tmp_path)).load().count()


def png(pixels, filters):
    h, w = pixels.shape
    raw, above = b"", np.zeros(w, int)
    for y in range(h):
        line = pixels[y].astype(int)
        left = np.concatenate([[0], line[:-1]])
        corner = np.concatenate([[0], above[:-1]])
        kind = filters[y % len(filters)]
        if kind == 4:
            p = left + above - corner
            pa, pb, pc = abs(p - left), abs(p - above), abs(p - corner)
            guess = np.where((pa <= pb) & (pa <= pc), left, np.where(pb <= pc, above, corner))
        else:
            guess = [0 * line, left, above, (left + above) // 2][kind]
        raw += bytes([kind]) + ((line - guess) % 256).astype(np.uint8).tobytes()
        above = line

    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_masks_and_sizes(spark, tmp_path):
    rng = np.random.default_rng(2)
    mask = (rng.random((13, 17)) > 0.5).astype(np.uint8) * 200
    (tmp_path / "m.png").write_bytes(png(mask, [0, 1, 2, 3, 4]))
    (tmp_path / "p.jpg").write_bytes(b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc2\x00\x0b\x08\x00\x30\x00\x40\x01\x01\x11\x00")
    df = X.listing(spark, str(tmp_path), content=True)
    got = {r["name"]: r for r in df.select("name", X.png_size(F.col("content")).alias("png"), X.jpeg_size("content").alias("jpg")).collect()}
    assert tuple(got["m.png"]["png"]) == (17, 13) and got["p.jpg"]["png"] is None and tuple(got["p.jpg"]["jpg"]) == (64, 48)


def test_settings_jobs_poses_logs(spark, tmp_path):
    (tmp_path / "ini").mkdir()
    (tmp_path / "ini" / "a.ini").write_text("# top\n[run]\nName = x\nsteps: 30000\n\n[eval]\n; no\nmode = all\n")
    got = {(r["section"], r["key"]): r["value"] for r in X.settings(spark, str(tmp_path / "ini")).collect()}
    assert got == {("run", "name"): "x", ("run", "steps"): "30000", ("eval", "mode"): "all"}
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "1.json").write_text(json.dumps({"kind": "job", "id": "a", "progress": {"schema_version": 2}}, indent=1))
    (tmp_path / "j" / "2.json").write_text(json.dumps({"kind": "job", "id": "b"}))
    (tmp_path / "j" / "3.json").write_text(json.dumps({"kind": "capture", "id": "c"}))
    assert {(r["id"], r["schema_version"]) for r in X.jobs(spark, str(tmp_path / "j")).collect()} == {("a", 2), ("b", 0)}
    (tmp_path / "t.json").write_text(json.dumps({"frames": [{"file_path": "im/f_012.png", "transform_matrix": [[1, 0, 0, 0]] * 4, "colmap_im_id": 3}]}, indent=1))
    r = X.poses(spark, str(tmp_path / "t.json")).first()
    assert r["frame_id"] == 12 and r["transform_matrix"][3][0] == 1.0
    (tmp_path / "l1.csv").write_text("run_id,a\nr1,1\nr2,2\n")
    (tmp_path / "l2.csv").write_text("run_id,a,b\nr1,3,z\n")
    got = {r["run_id"]: (r["a"], r["b"]) for r in X.run_log(spark, [str(tmp_path / "l1.csv"), str(tmp_path / "l2.csv")]).collect()}
    assert got == {"r1": ("3", "z"), "r2": ("2", None)}


def test_probe_lines_and_frame_csv(spark, tmp_path):
    df = spark.createDataFrame([("r", 0, "﻿{\"ram\": 1}"), ("r", 1, "noise"), ("r", 2, "{\"ram\": 5}"), ("r", 3, "tail")], "run string, pos int, t string")
    assert X.probe_lines(df, "run", "pos", "t", "ram int").first()["ram"] == 5
    (tmp_path / "f.csv").write_text("filename,output_grid_seconds\nb.png,1.5\na.png,0.5\n")
    assert {(r["filename"], r["seconds"]) for r in X.frame_csv(spark, str(tmp_path / "f.csv"), "c").collect()} == {("a.png", 0.5), ("b.png", 1.5)}
    (tmp_path / "g.csv").write_text("filename\nb.png\na.png\n")
    assert {(r["filename"], r["seconds"]) for r in X.frame_csv(spark, str(tmp_path / "g.csv"), "c").collect()} == {("a.png", 0.0), ("b.png", 1.0)}
