"""Robust fits whose sums and counts Spark does; only small matrices are solved locally."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frondlake.operators.ordered import HOT_ROWS, Ordered, ordered
from frondlake.session import durable

AXES = ("x", "y", "z")
MOMENTS = [(a, b) for i, a in enumerate(AXES) for b in AXES[i:]]


def moments(points: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, mean, scatter matrix) in one pass."""
    r = points.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in AXES],
                   *[F.covar_pop(a, b).alias(a + b) for a, b in MOMENTS]).first()
    n = r["n"]
    if not n:
        return 0, np.zeros(3), np.zeros((3, 3))
    s = np.array([[r[a + b] if a + b in r else r[b + a] for b in AXES] for a in AXES]) * n
    return n, np.array([r[c] for c in AXES]), s


def plane_through(points: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Least-squares (normal, centre, rows): the direction of least scatter."""
    n, centre, s = moments(points)
    return np.linalg.eigh(s)[1][:, 0], centre, n


def line_through(points: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    n, centre, s = moments(points)
    return np.linalg.eigh(s)[1][:, 2], centre, n


def off_plane(normal, centre) -> Column:
    """Signed distance from a plane."""
    return sum((F.lit(float(k)) * (F.col(c) - F.lit(float(o))) for k, c, o in zip(normal[1:], AXES[1:], centre[1:])),
               F.lit(float(normal[0])) * (F.col("x") - F.lit(float(centre[0]))))


def ransac_plane(points: DataFrame, tolerance: float, trials: int, seed: int, min_inliers: int = 3,
                 reselect: bool = False, hot_rows: int = HOT_ROWS):
    """Three-point consensus plane over the distinct coordinates, refined on its inliers.

    Trial triples are row numbers in coordinate order, drawn from a seeded generator that needs the
    row count alone; three rows per trial are looked up, and every partition counts the inliers of
    all trial planes over its own rows. Returns (normal, centre, inliers DataFrame), or
    (None, None, inliers) below min_inliers. ``reselect`` takes the inliers of the refined plane
    and refits once more."""
    # cutting the order into blocks looks at the distinct coordinates several times
    distinct = durable(points.select(*AXES).distinct())
    n = distinct.count()
    spots = durable(ordered(distinct, [], list(AXES), Ordered(rank="rn"), hot_rows, n))
    if n < 3:
        return None, None, spots.limit(0).select(*AXES)
    rng = np.random.default_rng(seed)
    triples = np.array([rng.choice(n, 3, replace=False) for _ in range(trials)])
    wanted = spots.sparkSession.createDataFrame(pd.DataFrame({"rn": np.unique(triples) + 1}))
    # at most three rows per trial come back
    found = {r["rn"] - 1: (r["x"], r["y"], r["z"]) for r in spots.join(F.broadcast(wanted), "rn").collect()}
    picks = np.array([[found[i] for i in t] for t in triples.tolist()])
    normals = np.cross(picks[:, 1] - picks[:, 0], picks[:, 2] - picks[:, 0])
    size = np.linalg.norm(normals, axis=1)
    valid = np.flatnonzero(size >= 1e-10)
    if not len(valid):
        return None, None, spots.limit(0).select(*AXES)
    normals, anchors = normals[valid] / size[valid, None], picks[valid, 0]

    def tally(batches):
        total = np.zeros(len(valid), np.int64)
        for pdf in batches:
            rows = pdf.to_numpy()
            for at in range(0, len(rows), 4096):
                part = rows[at:at + 4096]
                for t in range(len(valid)):
                    total[t] += int((np.abs((part - anchors[t]) @ normals[t]) < tolerance).sum())
        yield pd.DataFrame({"trial": np.arange(len(valid)), "n": total})

    counts = spots.select(*AXES).mapInPandas(tally, "trial bigint, n bigint").groupBy("trial").agg(F.sum("n").alias("n"))
    best = counts.agg(F.min_by("trial", F.struct((-F.col("n")).alias("n"), "trial"))).first()[0]
    inliers = spots.select(*AXES).filter(F.abs(off_plane(normals[best], anchors[best])) < tolerance)
    normal, centre, k = plane_through(inliers)
    if k < min_inliers:
        return None, None, inliers
    if reselect:
        inliers = spots.select(*AXES).filter(F.abs(off_plane(normal, centre)) < tolerance)
        normal, centre, k = plane_through(inliers)
    return normal, centre, inliers


@dataclass(frozen=True)
class GroundLimits:
    """Which rows may be ground and what a fit must reach."""

    min_hits: int
    hit_share: float
    radius: float
    tolerance: float
    trials: int
    seed: int
    min_rows: int
    min_inliers: int


@dataclass(frozen=True)
class GroundFit:
    """A fitted plane, or the first rule it broke (``rows``, ``inliers`` or ``side``)."""

    rows: int
    broken: str | None = None
    normal: np.ndarray | None = None
    centre: np.ndarray | None = None
    offset: float | None = None
    inliers: DataFrame | None = None
    same_rows: bool = False


def ground_plane(points: DataFrame, base, toward, limits: GroundLimits) -> GroundFit:
    """Plane of the rows of points(x, y, z, hits, seen) voted ground within a radius of ``base``, its
    normal on the side of ``toward``; ``offset`` is the base's height above it."""
    base, toward = np.asarray(base, float), np.asarray(toward, float)
    away = sum(((F.col(c) - F.lit(float(b))) ** 2 for c, b in zip(AXES, base)), F.lit(0.0))
    voted = (F.col("hits") >= limits.min_hits) & (F.try_divide("hits", "seen") >= limits.hit_share)
    near = durable(points.filter(voted & (away < limits.radius ** 2)).select(*AXES).distinct())
    rows = near.count()
    if rows < limits.min_rows:
        return GroundFit(rows, "rows")
    normal, centre, inliers = ransac_plane(near, limits.tolerance, limits.trials, limits.seed, limits.min_inliers)
    if normal is None:
        return GroundFit(rows, "inliers")
    side = float(np.sign((toward - base) @ normal))
    return GroundFit(rows, None if side else "side", side * normal, centre, side * float((base - centre) @ normal), inliers)


def settle_ground(points: DataFrame, base_along, toward, up, limits: GroundLimits, rounds: int) -> Iterator[GroundFit]:
    """The fits of successive rounds, each with the base that ``base_along`` gives for the normal before
    it; ends with a broken fit, with one whose inliers are those before it, or after ``rounds``. Sets
    of inliers are compared by their count and the sum of their row hashes."""
    mark = None
    for _ in range(rounds):
        fit = ground_plane(points, base_along(up), toward, limits)
        if fit.broken:
            yield fit
            return
        last, mark = mark, tuple(fit.inliers.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*AXES).cast("decimal(38,0)"))).first())
        yield replace(fit, same_rows=mark == last)
        if mark == last:
            return
        up = fit.normal


def up_direction(spark: SparkSession, candidates, apart: float) -> DataFrame:
    """(place, source, x, y, z, use, angle, apart): candidate directions (source, vector or None) in order
    of trust. The first one that exists is used; the others only show by how many degrees they differ
    and whether that is more than ``apart``."""
    rows = [(i, s, *(map(float, v) if v is not None else (None,) * 3)) for i, (s, v) in enumerate(candidates)]
    df = spark.createDataFrame(rows, "place int, source string, x double, y double, z double")
    first = df.filter("x is not null").agg(F.min_by(F.struct("place", *AXES), "place").alias("u"))
    j = df.crossJoin(first)  # one row
    size = lambda p: F.sqrt(sum((F.col(p + c) * F.col(p + c) for c in AXES), F.lit(0.0)))
    cos = sum((F.col(c) * F.col(f"u.{c}") for c in AXES), F.lit(0.0)) / size("") / size("u.")
    j = j.withColumn("angle", F.when(F.col("x").isNotNull(), F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cos))))))
    return j.select("place", "source", *AXES, F.coalesce(F.col("place") == F.col("u.place"), F.lit(False)).alias("use"), "angle",
                    F.when(F.col("x").isNotNull(), F.col("angle") > apart).alias("apart")).orderBy("place")


def _solve3(a: dict[str, Column], r: list[Column]) -> list[Column]:
    """Cramer's rule for a symmetric 3 x 3 system."""
    xx, xy, xz, yy, yz, zz = (a[k] for k in ("xx", "xy", "xz", "yy", "yz", "zz"))
    c = {"xx": yy * zz - yz * yz, "xy": xz * yz - xy * zz, "xz": xy * yz - xz * yy,
         "yy": xx * zz - xz * xz, "yz": xy * xz - xx * yz, "zz": xx * yy - xy * xy}
    det = xx * c["xx"] + xy * c["xy"] + xz * c["xz"]
    return [F.try_divide(c["xx"] * r[0] + c["xy"] * r[1] + c["xz"] * r[2], det),
            F.try_divide(c["xy"] * r[0] + c["yy"] * r[1] + c["yz"] * r[2], det),
            F.try_divide(c["xz"] * r[0] + c["yz"] * r[1] + c["zz"] * r[2], det)]


def triangulate(obs: DataFrame, rounds: int = 5) -> DataFrame:
    """(label, x, y, z, views, rms) from obs(label, u, v, f, cx, cy, r00..r22, t0..t2).

    The start is the linear solution, the refinement Gauss-Newton on the pixel residual. Both need
    nothing but sums per label, so a label with very many views is still only aggregated."""
    cam = [[F.col(f"r{i}{j}") for j in range(3)] for i in range(3)]
    t = [F.col(f"t{i}") for i in range(3)]
    nu, nv = (F.col("u") - F.col("cx")) / F.col("f"), (F.col("v") - F.col("cy")) / F.col("f")
    rows = [[cam[0][j] - nu * cam[2][j] for j in range(3)] + [nu * t[2] - t[0]],
            [cam[1][j] - nv * cam[2][j] for j in range(3)] + [nv * t[2] - t[1]]]

    def normal(df: DataFrame, lines, extra=()) -> DataFrame:
        sums = [F.sum(sum((l[i] * l[j] for l in lines[1:]), lines[0][i] * lines[0][j])).alias(AXES[i] + AXES[j])
                for i in range(3) for j in range(i, 3)]
        sums += [F.sum(sum((l[i] * l[3] for l in lines[1:]), lines[0][i] * lines[0][3])).alias(f"q{i}") for i in range(3)]
        return df.groupBy("label").agg(F.count(F.lit(1)).alias("views"), *sums, *extra)

    def solved(df: DataFrame) -> list[Column]:
        return _solve3({a + b: F.col(a + b) for a, b in MOMENTS}, [F.col(f"q{i}") for i in range(3)])

    start = normal(obs, rows)
    est = durable(start.filter("views >= 2").select("label", "views", *[c.alias(n) for c, n in zip(solved(start), AXES)]))
    p = [sum((cam[i][j] * F.col(AXES[j]) for j in range(1, 3)), cam[i][0] * F.col("x")) + t[i] for i in range(3)]
    f, iz = F.col("f"), 1 / p[2]
    du = F.col("u") - (f * p[0] * iz + F.col("cx"))
    dv = F.col("v") - (f * p[1] * iz + F.col("cy"))
    jac = [[f * iz * (cam[0][j] - p[0] * iz * cam[2][j]) for j in range(3)] + [du],
           [f * iz * (cam[1][j] - p[1] * iz * cam[2][j]) for j in range(3)] + [dv]]
    for _ in range(rounds):
        step = normal(obs.join(est.select("label", *AXES), "label"), jac).drop("views")
        moved = solved(step)
        step = step.select("label", *[c.alias(f"d{n}") for c, n in zip(moved, AXES)])
        est = durable(est.join(step, "label").select("label", "views", *[(F.col(n) + F.coalesce(f"d{n}", F.lit(0.0))).alias(n) for n in AXES]))
    rms = obs.join(est.select("label", *AXES), "label").groupBy("label").agg(F.sqrt(F.avg(du * du + dv * dv)).alias("rms"))
    return est.join(rms, "label").select("label", *AXES, "views", "rms")


def leave_one_out(df: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """Regression slope of y on x per key, and per row the slope without that row, from the key's
    sums less the row's own share. Sums are taken about the key's mean to keep the digits."""
    mean = df.groupBy(key).agg(F.avg(x).alias("mx"), F.avg(y).alias("my"))
    c = df.join(mean, key).withColumn("px", F.col(x) - F.col("mx")).withColumn("py", F.col(y) - F.col("my"))
    s = c.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("px") * F.col("px")).alias("sxx"), F.sum(F.col("px") * F.col("py")).alias("sxy"))
    j = c.join(s, key)
    k = F.col("n") / (F.col("n") - 1)
    without = F.try_divide(F.col("sxy") - k * F.col("px") * F.col("py"), F.col("sxx") - k * F.col("px") * F.col("px"))
    return j.select(*df.columns, F.try_divide(F.col("sxy"), F.col("sxx")).alias("slope"), without.alias("slope_without"))
