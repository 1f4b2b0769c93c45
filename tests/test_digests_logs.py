"""Streamed digests, logs with changing headers, sampled pair counts."""

import hashlib
import tracemalloc

import numpy as np
import pytest

from frondlake.operators import spatial as S
from frondlake.sources import text as X
from frondlake.sources.digests import DigestReader


def test_digests_stream_in_chunks(spark, tmp_path):
    (tmp_path / "a").mkdir()
    data = {"a/one.bin": np.random.default_rng(1).bytes(3_000_000), "a/two.txt": b"", "three": b"x" * 5000, ".hidden": b"no"}
    for name, content in data.items():
        (tmp_path / name).write_bytes(content)
    got = {r.relative: (r.length, r.sha256) for r in X.manifest(spark, str(tmp_path), 1000).collect()}
    assert got == {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in data.items() if n != ".hidden"}
    one = X.manifest(spark, str(tmp_path / "three")).first()
    assert (one.name, one.relative, one.length) == ("three", "three", 5000)
    before = X.tree_digest(spark, str(tmp_path)).first()
    (tmp_path / "three").write_bytes(b"y" * 5000)
    after = X.tree_digest(spark, str(tmp_path)).first()
    assert (before.files, before.bytes) == (after.files, after.bytes) == (3, 3_005_000) and before.sha256 != after.sha256
    # a file far larger than the chunk: memory stays at a few chunks
    big = tmp_path / "a" / "big"
    with big.open("wb") as f:
        f.truncate(64 << 20)
    reader = DigestReader({"path": str(big), "chunk": str(1 << 16)}, ["length", "sha256"])
    tracemalloc.start()
    (batch,) = reader.read(reader.partitions()[0])
    assert batch.to_pylist()[0]["length"] == 64 << 20 and tracemalloc.get_traced_memory()[1] < 2 << 20
    tracemalloc.stop()
    with pytest.raises(Exception, match="absent"):
        X.manifest(spark, str(tmp_path / "absent")).collect()


def test_three_headers_in_one_file(spark, tmp_path):
    (tmp_path / "log.csv").write_text('lost,row\nrun_id,a,b\nr1,1,2\nr2,"x, y",4\nrun_id,b,c\nr3,5,6\nr1,7,8\n\nrun_id,a,d,b\nr4,\x009,,10,surplus\nr5,11\n')
    (tmp_path / "new.csv").write_text("run_id,e\nr2,12\n")
    df = X.evolving_log(spark, [str(tmp_path / "log.csv"), str(tmp_path / "new.csv")], widest=8)
    assert df.columns == ["run_id", "a", "b", "c", "d", "e"]
    got = {r.run_id: tuple(r)[1:] for r in df.collect()}
    assert got == {"r1": (None, "7", "8", None, None), "r2": (None, None, None, None, "12"), "r3": (None, "5", "6", None, None),
                   "r4": ("9", "10", None, None, None), "r5": ("11", None, None, None, None)}


def test_sampled_pairs_on_clusters(spark):
    rng = np.random.default_rng(2)
    p = np.concatenate([rng.normal(c, s, (n, 3)) for c, s, n in ((0, 0.1, 1500), (2, 0.3, 1500), (5, 1.0, 1000))])
    df = spark.createDataFrame([(i, *map(float, q)) for i, q in enumerate(p)], "id long, x double, y double, z double")
    d = np.linalg.norm(p[:, None] - p, axis=2)
    exact = int((np.triu(d <= 0.2, 1)).sum())
    likely, error = S.sampled_pairs(df, 0.2)
    assert 0.9 <= likely / exact <= 1.1 and 0 < error < 0.2 * exact and abs(likely - exact) < 2 * error
    assert S.sampled_pairs(df, 0.2, probes=4000) == (exact, 0.0)
    assert S.sampled_pairs(df.limit(1), 1.0) == (0.0, 0.0)
