import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from frondlake.sources import derivative as D
from tests.test_sources import DTYPE, load, write_ply


@pytest.fixture()
def source(tmp_path):
    rng = np.random.default_rng(4)
    # any bytes at all, not-a-number payloads and negative zeros among them
    rows = np.frombuffer(rng.integers(0, 256, 300 * DTYPE.itemsize, dtype=np.uint8).tobytes(), DTYPE)
    write_ply(tmp_path / "in.ply", rows)
    text = (tmp_path / "in.ply").read_bytes()
    (tmp_path / "in.ply").write_bytes(text.replace(b"element vertex 300\n", b"element vertex 300\r\n"))
    return tmp_path / "in.ply", rows


def test_rows_keep_their_bytes(spark, tmp_path, source):
    path, rows = source
    ids = [0, 3, 4, 77, 299]
    got = D.write_derivative(spark, str(path), spark.createDataFrame([(i,) for i in reversed(ids)], "row_id int").withColumn("record", F.lit(1)), str(tmp_path / "out")).collect()
    parts = sorted((tmp_path / "out").glob("*.ply"))
    assert {r.relative: r.sha256 for r in got} == {p.name: hashlib.sha256(p.read_bytes()).hexdigest() for p in parts}
    head = path.read_bytes().split(b"end_header\n")[0]
    body = b""
    for p in parts:
        data = p.read_bytes()
        at = data.index(b"end_header\n") + 11
        n = (len(data) - at) // DTYPE.itemsize
        assert data[:at] == head.replace(b"vertex 300", b"vertex %d" % n) + b"end_header\n"
        body += data[at:]
    assert body == rows[ids].tobytes()
    changed = D.records(spark, str(tmp_path / "out")).withColumn("record", F.when(F.col("row_id") == 2, F.lit(b"x")).otherwise(F.col("record")))
    kept = D.records(spark, str(path)).filter(F.col("row_id").isin(ids))
    assert [tuple(r) for r in D.differing(kept, changed).collect()] == [(3, 4)]
    assert D.differing(kept, changed.filter("row_id < 2")).count() == 3


@pytest.mark.parametrize("ids", [[1, 1], [300], [-1], [None]])
def test_wrong_rows_are_refused(spark, tmp_path, source, ids):
    with pytest.raises(ValueError, match="asked for"):
        D.write_derivative(spark, str(source[0]), spark.createDataFrame([(i,) for i in ids], "row_id int"), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_no_rows_and_a_short_source(spark, tmp_path, source):
    none = spark.createDataFrame([], "row_id int")
    assert D.write_derivative(spark, str(source[0]), none, str(tmp_path / "out")).count() == 0
    write_ply(tmp_path / "short.ply", source[1], declared=400)
    assert load(spark, tmp_path / "short.ply").select("row_id").count() == 300
    short = load(spark, tmp_path / "short.ply").sparkSession.read.format("splat_ply").option("path", str(tmp_path / "short.ply")).schema("row_id bigint, short boolean").load()
    assert short.filter("short").count() == 300
    with pytest.raises(Exception, match="fewer rows"):
        D.records(spark, str(tmp_path / "short.ply")).collect()
