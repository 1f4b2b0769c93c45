"""Records of varying length: ranges, decoding, pruning, damage."""

import struct

import numpy as np
import pytest

from frondlake.sources import binary, models

SHORT = "point_id bigint, track array<struct<image_id:int,point2d_idx:int>>"


def point(i, track):
    return struct.pack("<Q3d3BdQ", i, i * 0.5, -i, 7.25, i % 256, 2, 3, i / 8, len(track)) + np.array(track, "<i4").reshape(-1, 2).tobytes()


def image(i, name, keys):
    return struct.pack("<i7di", i, *[i + j / 4 for j in range(7)], 9) + name.encode() + b"\0" + struct.pack("<Q", len(keys)) + b"".join(struct.pack("<2dq", *k) for k in keys)


@pytest.fixture(scope="module")
def model(tmp_path_factory):
    path = tmp_path_factory.mktemp("model")
    rng = np.random.default_rng(1)
    tracks = {i: [(int(a), int(b)) for a, b in rng.integers(0, 99, (int(rng.integers(0, 40)) if i != 50 else 60_000, 2))] for i in range(400)}
    keys = {i: [(float(a), float(b), int(c)) for a, b, c in rng.integers(-5, 99, (int(rng.integers(0, 30)), 3))] for i in range(150)}
    (path / "points3D.bin").write_bytes(struct.pack("<Q", 400) + b"".join(point(i, t) for i, t in tracks.items()))
    (path / "images.bin").write_bytes(struct.pack("<Q", 150) + b"".join(image(i, f"é/{i}" * (i % 3), k) for i, k in keys.items()))
    return path, tracks, keys


@pytest.mark.parametrize("batch", [1 << 20, 700])
def test_one_file_by_several_tasks(spark, model, monkeypatch, batch):
    path, tracks, keys = model
    parts = models.ranges(str(path / "points3D.bin"), models.POINTS, 16_000)
    assert len(parts) >= 4 and sum(p.rows for p in parts) == 400 and parts[0].start == 8
    assert all(a.end == b.start for a, b in zip(parts, parts[1:]))
    monkeypatch.setattr(models, "BATCH", batch)
    monkeypatch.setattr(models, "READ", 4096)
    schema = models.T.StructType.fromDDL(SHORT) if hasattr(models.T.StructType, "fromDDL") else models.T._parse_datatype_string(SHORT)
    reader = models.RecordReader({"path": str(path), "bytesPerPartition": "16000"}, schema, models.POINTS)
    got = {r["point_id"]: [(t["image_id"], t["point2d_idx"]) for t in r["track"]] for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()}
    assert got == tracks


def test_offset_pass_keeps_a_block_in_place(model):
    path, tracks, _ = model
    name = str(path / "points3D.bin")
    records = models.Records(name, models.POINTS, 8, (path / "points3D.bin").stat().st_size)
    sizes, blocks = [], set()
    while (size := records.skip()) is not None:
        sizes.append(size)
        blocks.add(id(records.held))
        kept = records.held  # noqa: F841 held, so that no two blocks share an id
    assert sizes == [len(point(i, t)) for i, t in tracks.items()]
    # all records before and after the long one lie in a block each; none is copied for a record
    assert len(blocks) <= 3


def test_columns_and_pruning(spark, model):
    path, tracks, keys = model
    binary.register(spark)
    df = spark.read.format("colmap_points").option("path", str(path)).option("bytesPerPartition", 20_000).load()
    assert df.rdd.getNumPartitions() >= 4
    r = df.filter("point_id = 7").first()
    assert (r.x, r.y, r.z, r.r, r.g, r.b, r.error) == (3.5, -7.0, 7.25, 7, 2, 3, 0.875) and [tuple(t) for t in r.track] == tracks[7]
    i = {r.image_id: r for r in spark.read.format("colmap_images").option("path", str(path)).option("bytesPerPartition", 9000).load().collect()}
    assert len(i) == 150 and all([tuple(k) for k in i[n].keypoints] == keys[n] and i[n].name == f"é/{n}" * (n % 3) for n in keys)
    assert i[4].qvec == [4.0, 4.25, 4.5, 4.75] and i[4].tvec == [5.0, 5.25, 5.5] and i[4].camera_id == 9
    few = spark.read.format("colmap_images").option("path", str(path)).schema("name string, image_id int").load()
    assert few.columns == ["name", "image_id"] and few.count() == 150


def test_written_models_read_back(spark, model, tmp_path):
    path, _, _ = model
    for kind in ("colmap_points", "colmap_images"):
        df = spark.read.format(kind).option("path", str(path)).load()
        df.repartition(3).write.format(kind).option("path", f"{tmp_path}/{kind}").mode("append").save()
        back = spark.read.format(kind).option("path", f"{tmp_path}/{kind}").option("bytesPerPartition", 30_000).load()
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
        with pytest.raises(Exception, match="already holds"):
            df.write.format(kind).option("path", f"{tmp_path}/{kind}").mode("append").save()


@pytest.mark.parametrize("step", [1 << 20, 100])
def test_damaged_files_are_refused(spark, tmp_path, step):
    whole = struct.pack("<Q", 3) + b"".join(point(i, [(1, 2)] * i) for i in range(3))
    for k, (data, why) in enumerate([(whole[:-5], "truncated"), (whole + b"x", "trailing"), (struct.pack("<Q", 4) + whole[8:], "truncated"), (b"abc", "truncated")]):
        folder = tmp_path / str(k)
        folder.mkdir()
        (folder / "points3D.bin").write_bytes(data)
        reader = models.RecordReader({"path": str(folder), "bytesPerPartition": str(step)}, models.T.StructType([]), models.POINTS)
        with pytest.raises(ValueError, match=why):
            [list(reader.read(p)) for p in reader.partitions()]
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "points3D.bin").write_bytes(struct.pack("<Q", 0))
    assert models.RecordReader({"path": str(empty)}, models.T.StructType([]), models.POINTS).partitions() == []
