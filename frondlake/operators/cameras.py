"""Cameras as columns: intrinsics tables with their rules, rays through pixels, frames and poses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frondlake.functions import columns as C

#: fixed values: the camera models whose parameters are understood
MODELS = ("OPENCV", "PINHOLE", "SIMPLE_PINHOLE", "SIMPLE_RADIAL", "RADIAL")
#: what a frame may not set differently from its model
SHARED = ("fl_x", "fl_y", "cx", "cy", "w", "h", "k1")
#: distortion that projection does not know
UNKNOWN = ("k2", "k3", "k4", "p1", "p2")
#: fixed-point steps, and the redistortion error above which a pixel has no ray
STEPS, CLOSE = 200, 1e-10


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once: a one-element array gives it a name."""
    return F.transform(F.array(value), body)[0]


def _any(rules: list[Column]) -> Column:
    return F.coalesce(F.array_max(F.array(*[F.coalesce(r, F.lit(False)) for r in rules])), F.lit(False))


def camera_table(models: DataFrame, frames: DataFrame, names: DataFrame) -> DataFrame:
    """One row per frame: (frame, name, SHARED..., status) from models(set, model, SHARED, UNKNOWN),
    frames(frame, set and, where the frame sets them itself, columns of those names) and
    names(frame, name). ``status`` is ok or the first rule the frame breaks: no_model, model,
    distortion, own_intrinsics, intrinsics (not finite, or a focal length not above 0), unnamed.
    Nothing is dropped; the caller keeps or refuses."""
    own = [c for c in (*SHARED, *UNKNOWN) if c in frames.columns]
    mine = frames.select("frame", "set", *[F.col(c).alias(f"own_{c}") for c in own])
    j = mine.join(models.withColumn("__known", F.lit(True)), "set", "left").join(names.select("frame", "name"), "frame", "left")
    bent = [F.col(c) != 0 for c in UNKNOWN if c in models.columns] + [F.col(f"own_{c}") != 0 for c in own if c in UNKNOWN]
    differs = [F.col(f"own_{c}") != F.coalesce(F.col(c), F.lit(0)) for c in own if c in SHARED]
    broken = [F.col(c).isNull() | F.isnan(F.col(c).cast("double")) | (F.abs(F.col(c).cast("double")) == float("inf")) for c in SHARED if c != "k1"]
    status = F.when(F.col("__known").isNull(), "no_model").when(~F.col("model").isin(*MODELS), "model").when(_any(bent), "distortion") \
        .when(_any(differs), "own_intrinsics").when(_any([*broken, F.col("fl_x") <= 0, F.col("fl_y") <= 0]), "intrinsics") \
        .when(F.col("name").isNull(), "unnamed").otherwise("ok")
    return j.select("frame", "name", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) if c == "k1" else F.col(c) for c in SHARED], status.alias("status"))


def undistort(x: Column, y: Column, k: dict[str, float], steps: int = STEPS) -> Column:
    """struct(x, y) of undistorted normalised coordinates by fixed-point steps inside the JVM; null
    where distorting the result again misses the input by more than CLOSE, or the input is null."""
    def step(s, _):
        dx, dy = C.distort(s["x"], s["y"], {"p1": k.get("p1", 0.0), "p2": k.get("p2", 0.0)})
        r2 = s["x"] * s["x"] + s["y"] * s["y"]
        radial = 1 + r2 * (k.get("k1", 0.0) + r2 * (k.get("k2", 0.0) + r2 * k.get("k3", 0.0)))
        return F.struct(F.try_divide(x - (dx - s["x"]), radial).alias("x"), F.try_divide(y - (dy - s["y"]), radial).alias("y"))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.struct(x.alias("x"), y.alias("y")), step)

    def proved(s):
        bx, by = C.distort(s["x"], s["y"], k)
        return F.when(F.greatest(F.abs(bx - x), F.abs(by - y)) <= CLOSE, s)

    return _let(found, proved)


def ray(u: Column, v: Column, camera: dict[str, float], rotation) -> Column:
    """struct(x, y, z): unit direction in world coordinates of the pixel (u, v) of a camera with
    fl_x, fl_y, cx, cy and distortion, and ``rotation`` from world to camera; null without a ray."""
    flat = undistort((u - camera["cx"]) / camera["fl_x"], (v - camera["cy"]) / camera["fl_y"], camera)

    def turned(s):
        out = [s["x"] * float(rotation[0][j]) + s["y"] * float(rotation[1][j]) + float(rotation[2][j]) for j in range(3)]
        size = C.length(out)
        return F.when(s.isNotNull(), F.struct(*[(c / size).alias(n) for c, n in zip(out, "xyz")]))

    return _let(flat, turned)


def to_saved_frame(xyz: list[Column], transform, scale: float) -> list[Column]:
    """scale * (R p + t) of a saved 3 x 4 transform: the translation is scaled too."""
    return [(C.dot([F.lit(float(v)) for v in row[:3]], xyz) + float(row[3])) * float(scale) for row in transform]


def pose(position: list[Column], gaze: list[Column], parallel: float = 1e-8) -> Column:
    """Camera-to-world matrix as an array of 16, row by row: the third axis looks against the gaze,
    the first is level (z is up; y where the gaze is vertical). Null for a gaze of no length."""
    def unit(v: list[Column]) -> Column:
        return _let(F.struct(*[c.alias(n) for c, n in zip(v, "xyz")]), lambda s: _let(C.length([s[n] for n in "xyz"]), lambda d: F.struct(
            *[F.try_divide(s[n], d).alias(n) for n in "xyz"])))

    def rows(back: Column) -> Column:
        b = [back[n] for n in "xyz"]
        level, other = C.cross([F.lit(0.0), F.lit(0.0), F.lit(1.0)], b), C.cross([F.lit(0.0), F.lit(1.0), F.lit(0.0)], b)
        side = _let(C.length(level) >= parallel, lambda ok: F.when(ok, unit(level)).otherwise(unit(other)))

        def filled(right: Column) -> Column:
            r = [right[n] for n in "xyz"]
            up = C.cross(b, r)
            return F.array(*[c for i in range(3) for c in (r[i], up[i], b[i], position[i])], *[F.lit(v) for v in (0.0, 0.0, 0.0, 1.0)])

        return _let(side, filled)

    return F.when(C.length(gaze) > 0, _let(unit([-g for g in gaze]), rows))
