import struct

from frondlake.sources.images import image_sizes


def test_sizes_from_few_bytes(spark, tmp_path):
    png = b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + b"IHDR" + struct.pack(">II", 640, 480) + b"\x08\x02\0\0\0"
    app = b"\xff\xe1" + struct.pack(">H", 60_002) + b"\xff\xc0" * 30_000
    frame = b"\xff\xc2" + struct.pack(">HBHH", 11, 8, 300, 200)
    files = {"a.png": png, "b.jpg": b"\xff\xd8" + app + b"\xff" + frame + b"rest", "cut.jpg": b"\xff\xd8" + app + frame[:6], "none.jpg": b"\xff\xd8\xff\xd9",
             "short.png": png[:20], "text.txt": b"hello", "empty.jpg": b"", "bad.jpg": b"\xff\xd8\x00\x01\x02\x03"}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    with open(tmp_path / "huge.png", "wb") as f:
        f.write(png)
        f.truncate(3 << 30)
    df = image_sizes(spark, str(tmp_path), 2)
    got = {r["name"]: (r["width"], r["height"], r["length"]) for r in df.collect()}
    sizes = {"a.png": (640, 480), "b.jpg": (200, 300)}
    assert got == {n: (*sizes.get(n, (None, None)), len(d)) for n, d in files.items()} | {"huge.png": (640, 480, 3 << 30)}
    assert df.select("name").count() == 9
    (tmp_path / "no").mkdir()
    assert image_sizes(spark, str(tmp_path / "no")).count() == 0
