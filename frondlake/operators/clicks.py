"""Points in space from clicked pixels: damped refinement over several views, and for a click in a
single view a local surface through the points seen around it.

Observations are rows of a label with their pixel and the columns of their camera: focal length f,
centre cx, cy, rotation r00 to r22 and translation t0 to t2 from world to camera, pixels undistorted.
Everything per label comes from aggregates over its rows; only 3 x 3 matrices are solved locally."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from frondlake.functions import columns as C
from frondlake.operators.fits import AXES, MOMENTS, _solve3, triangulate
from frondlake.operators.ordered import HOT_ROWS, Ordered, ordered, quantiles
from frondlake.session import durable

CAMERA = ["f", "cx", "cy", *[f"r{i}{j}" for i in range(3) for j in range(3)], "t0", "t1", "t2"]


@dataclass(frozen=True)
class ClickLimits:
    """Thresholds in pixels, degrees and shares of the depth; ``trials`` consensus planes a label."""

    max_reprojection: float = 4.0
    min_angle: float = 2.0
    sigma: float = 1.0
    radius: float = 40.0
    max_radius: float = 160.0
    min_support: int = 4
    min_plane: int = 8
    min_inliers: int = 5
    tolerance: float = 0.005
    trials: int = 500
    seed: int = 0
    min_share: float = 0.6
    max_incidence: float = 80.0
    max_spread: float = 0.02


def in_camera(xyz: list[Column]) -> list[Column]:
    return [C.dot([F.col(f"r{i}{j}") for j in range(3)], xyz) + F.col(f"t{i}") for i in range(3)]


def centre() -> list[Column]:
    """Place of the camera, -R' t."""
    return [-C.dot([F.col(f"r{i}{j}") for i in range(3)], [F.col(f"t{i}") for i in range(3)]) for j in range(3)]


def pixel_ray() -> list[Column]:
    """Unit direction of the pixel (u, v) in the world."""
    flat = [(F.col("u") - F.col("cx")) / F.col("f"), (F.col("v") - F.col("cy")) / F.col("f"), F.lit(1.0)]
    size = C.length(flat)
    return [C.dot([F.col(f"r{i}{j}") for i in range(3)], flat) / size for j in range(3)]


def _equations(obs: DataFrame, at: DataFrame) -> DataFrame:
    """(label, cost, normal matrix, gradient) of the squared pixel residuals at at(label, x, y, z)."""
    p = in_camera([F.col(c) for c in AXES])
    f, iz = F.col("f"), 1 / p[2]
    off = [f * p[i] * iz + F.col(c) - F.col(s) for i, c, s in ((0, "cx", "u"), (1, "cy", "v"))]
    jac = [[f * iz * (F.col(f"r{i}{j}") - p[i] * iz * F.col(f"r2{j}")) for j in range(3)] for i in range(2)]
    rows = obs.join(at.select("label", *AXES), "label")
    return rows.groupBy("label").agg(
        F.sum(off[0] * off[0] + off[1] * off[1]).alias("cost"),
        *[F.sum(jac[0][i] * jac[0][j] + jac[1][i] * jac[1][j]).alias(AXES[i] + AXES[j]) for i in range(3) for j in range(i, 3)],
        *[F.sum(jac[0][i] * off[0] + jac[1][i] * off[1]).alias(f"g{i}") for i in range(3)])


_STATE = ["cost", *[a + b for a, b in MOMENTS], "g0", "g1", "g2"]


def refine(obs: DataFrame, start: DataFrame, rounds: int = 80) -> DataFrame:
    """(label, x, y, z, cost, normal matrix, gradient, converged) from start(label, x, y, z): damped
    least squares on the pixel residuals. A step that raises the cost is rejected: the point and its
    equations stay, the damping grows tenfold; an accepted one divides it by ten. A label is done when
    its step or gain is negligible, or no damping helps; only labels still moving go on. Labels left
    after ``rounds`` evaluations are not converged."""
    now = durable(start.select("label", *AXES).join(_equations(obs, start), "label").withColumn("damping", F.lit(1e-3)))
    ended = None
    for _ in range(rounds):
        h = {a + b: F.col(a + b) + (F.col("damping") * (F.col(a + b) + 1e-12) if a == b else F.lit(0.0)) for a, b in MOMENTS}
        step = [-s for s in _solve3(h, [F.col(f"g{i}") for i in range(3)])]
        tried = durable(now.select("*", *[s.alias(f"s{c}") for s, c in zip(step, AXES)]))
        there = tried.select("label", *[(F.col(c) + F.col(f"s{c}")).alias(c) for c in AXES])
        new = _equations(obs, there).select("label", *[F.col(c).alias(f"n_{c}") for c in _STATE])
        fine = (F.abs(F.col("n_cost")) < float("inf")) & (F.col("n_cost") <= F.col("cost"))
        size, way = C.length([F.col(c) for c in AXES]), C.length([F.col(f"s{c}") for c in AXES])
        still = (way < F.greatest(F.lit(1.0), size) * 1e-12) | (F.col("cost") - F.col("n_cost") < F.greatest(F.col("cost"), F.lit(1e-30)) * 1e-14)
        j = tried.join(new, "label", "left").withColumn("fine", F.coalesce(fine, F.lit(False)))
        j = durable(j.select(
            "label", *[F.when(F.col("fine"), F.col(c) + F.col(f"s{c}")).otherwise(F.col(c)).alias(c) for c in AXES],
            *[F.when(F.col("fine"), F.col(f"n_{c}")).otherwise(F.col(c)).alias(c) for c in _STATE],
            F.when(F.col("fine"), F.greatest(F.col("damping") / 10, F.lit(1e-12))).otherwise(F.col("damping") * 10).alias("damping"),
            F.when(F.col("fine"), still).otherwise(F.col("damping") * 10 > 1e12).alias("converged")))
        done = j.filter("converged")
        ended = done if ended is None else ended.unionByName(done)
        now = j.filter("not converged").drop("converged")
        if now.isEmpty():
            break
    return ended.unionByName(now.withColumn("converged", F.lit(False))).drop("damping")


def widest_angle(rays: DataFrame) -> DataFrame:
    """(label, angle): the largest angle in degrees between two of a label's unit rays(label, x, y, z), from their chord.

    The two rays of the widest pair both lie far from the mean: at least as far as the best chord known
    (from the ray farthest from the mean to the ray farthest from that one) exceeds the farthest ray's
    distance. Only rays beyond that bound meet, not all of a label."""
    rays = durable(rays.select("label", *AXES).distinct())

    def gap(a: str, b: str) -> Column:
        return C.length([F.col(f"{a}{c}") - F.col(f"{b}{c}") for c in AXES])

    mean = rays.groupBy("label").agg(*[F.avg(c).alias(f"m{c}") for c in AXES])
    off = rays.join(mean, "label").withColumn("off", gap("", "m"))
    far = off.groupBy("label").agg(F.max(F.struct("off", *AXES)).alias("e")).select("label", F.col("e.off").alias("reach"), *[F.col(f"e.{c}").alias(f"e{c}") for c in AXES])
    known = rays.join(far, "label").groupBy("label", "reach").agg(F.max(gap("", "e")).alias("chord"))
    outer = durable(off.join(known, "label").filter(F.col("off") >= (F.col("chord") - F.col("reach")) * (1 - 1e-9)).select("label", *AXES))
    pairs = outer.join(outer.select("label", *[F.col(c).alias(f"o{c}") for c in AXES]), "label")
    chord = pairs.groupBy("label").agg(F.max(gap("", "o")).alias("chord"))
    return chord.select("label", F.degrees(2 * F.asin(F.least(F.col("chord") / 2, F.lit(1.0)))).alias("angle"))


def multi_view(obs: DataFrame, limits: ClickLimits = ClickLimits()) -> DataFrame:
    """(label, status, flags, x, y, z, views, max_residual, angle, sigma) for labels with two views or more.

    ``refused`` where the point lies behind a camera; ``flagged`` with a reason for a residual above, or
    an angle below its limit, or a refinement without end. sigma is the root of the trace of
    limits.sigma^2 (J'J)^-1."""
    start = triangulate(obs, 0).select("label", *AXES, "views")
    found = durable(refine(obs, start))
    seen = obs.join(found.select("label", *AXES), "label")
    p = in_camera([F.col(c) for c in AXES])
    miss = C.length([F.col("f") * p[0] / p[2] + F.col("cx") - F.col("u"), F.col("f") * p[1] / p[2] + F.col("cy") - F.col("v"), F.lit(0.0)])
    to = [F.col(c) - m for c, m in zip(AXES, centre())]
    seen = durable(seen.select("label", miss.alias("miss"), p[2].alias("depth"), *[(t / C.length(to)).alias(f"d{c}") for c, t in zip(AXES, to)]))
    worst = seen.groupBy("label").agg(F.max("miss").alias("max_residual"), F.min("depth").alias("depth"))
    angle = widest_angle(seen.select("label", *[F.col(f"d{c}").alias(c) for c in AXES]))
    j = found.join(start.select("label", "views"), "label").join(worst, "label").join(angle, "label")
    unit = [[F.lit(float(i == k)) for i in range(3)] for k in range(3)]
    h = {a + b: F.col(a + b) for a, b in MOMENTS}
    trace = sum((_solve3(h, unit[k])[k] for k in (1, 2)), _solve3(h, unit[0])[0])
    flags = F.array_compact(F.array(F.when(F.col("max_residual") > limits.max_reprojection, "residual"), F.when(F.col("angle") < limits.min_angle, "angle"),
                                    F.when(~F.col("converged"), "not_converged")))
    behind = ~(F.col("depth") > 0)
    status = F.when(behind, "refused").when(F.size("flags") > 0, "flagged").otherwise("ok")
    return j.withColumn("flags", F.when(behind, F.array(F.lit("behind_camera"))).otherwise(flags)).select(
        "label", status.alias("status"), "flags", *AXES, F.col("views").cast("long").alias("views"), "max_residual", "angle", (F.sqrt(trace) * limits.sigma).alias("sigma"))


def growing_support(clicks: DataFrame, support: DataFrame, radius: float, most: float, enough: int) -> tuple[DataFrame, DataFrame]:
    """(rows, radii): rows(label, point, x, y, z) of support(view, point, u, v, x, y, z) around each click,
    and radii(label, radius, n). A click is settled at the first radius, doubled from ``radius`` and never
    above ``most``, with ``enough`` points, or at the last one. Pixels meet in cells as wide as the radius;
    a round joins only the clicks not settled before."""
    live, r, rows, radii = durable(clicks.select("label", "view", "u", "v")), radius, None, None
    while True:
        cells = support.select("*", F.floor(F.col("u") / r).alias("cu"), F.floor(F.col("v") / r).alias("cv"))
        around = live.select("label", "view", F.col("u").alias("pu"), F.col("v").alias("pv"))
        for c, p in (("cu", "pu"), ("cv", "pv")):
            around = around.select("*", F.explode(F.expr(f"sequence(cast(floor({p} / {r!r}) as bigint) - 1, cast(floor({p} / {r!r}) as bigint) + 1)")).alias(c))
        gap = F.sqrt((F.col("u") - F.col("pu")) * (F.col("u") - F.col("pu")) + (F.col("v") - F.col("pv")) * (F.col("v") - F.col("pv")))
        near = durable(around.join(cells, ["view", "cu", "cv"]).filter(gap <= r).select("label", "point", *AXES))
        n = live.join(near.groupBy("label").agg(F.count(F.lit(1)).alias("n")), "label", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        last = 2 * r > most
        settled = durable(n.filter((F.col("n") >= enough) | F.lit(last)).select("label", F.lit(r).alias("radius"), "n"))
        mine = near.join(settled.select("label"), "label", "left_semi")
        rows, radii = (mine, settled) if rows is None else (rows.unionByName(mine), radii.unionByName(settled))
        live = live.join(settled.select("label"), "label", "left_anti")
        if last or live.isEmpty():
            return rows, radii
        r *= 2


def _planes(moments: DataFrame) -> DataFrame:
    """Adds the direction of least scatter nx, ny, nz and its variance ``least`` to rows of a covariance."""
    names = moments.columns

    def run(batches):
        for b in batches:
            m = {a + c: b.column(names.index(a + c)).to_numpy(zero_copy_only=False) for a, c in MOMENTS}
            s = np.array([[m.get(a + c, m.get(c + a)) for c in AXES] for a in AXES]).transpose(2, 0, 1)
            value, vector = np.linalg.eigh(s) if len(s) else (np.zeros((0, 3)), np.zeros((0, 3, 3)))
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(np.ascontiguousarray(vector[:, i, 0])) for i in range(3)],
                                              pa.array(np.ascontiguousarray(np.maximum(value[:, 0], 0)))], names=[*names, "nx", "ny", "nz", "least"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in moments.schema.fields)
    return moments.mapInArrow(run, ddl + ", nx double, ny double, nz double, least double")


def _moments(rows: DataFrame) -> DataFrame:
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("inliers"), *[F.avg(c).alias(f"c{c}") for c in AXES],
                                     *[F.covar_pop(a, b).alias(a + b) for a, b in MOMENTS])


def _near_plane(normal: list[Column], at: list[Column]) -> Column:
    return F.abs(C.dot(normal, [F.col(c) - a for c, a in zip(AXES, at)])) < F.col("tol")


def consensus_planes(rows: DataFrame, trials: int, seed: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(label, inliers, centre cx.., normal nx.., least) for rows(label, point, x, y, z, tol): of ``trials``
    planes through three rows of the label the one with most rows nearer than tol, refitted to them,
    and once more to the rows near the refitted one. Triples are drawn by a hash of seed, label, trial;
    trial planes meet the label's rows in a join that is counted at once. Labels whose triples are all
    in line, or with fewer than three inliers, are left out."""
    ranked = durable(ordered(rows, ["label"], ["point"], Ordered(rank="rn", totals={"of": F.lit(1)}), hot_rows))
    draws = ranked.filter("rn = 1 and of >= 3").select("label", "of", F.explode(F.sequence(F.lit(0), F.lit(trials - 1))).alias("trial"))
    pick = [F.pmod(F.xxhash64(F.lit(seed), "label", "trial", F.lit(j)), F.col("of") - j) for j in range(3)]
    # three different places: each draw steps over those before it
    draws = draws.select("label", "trial", pick[0].alias("a"), pick[1].alias("b"), pick[2].alias("c"))
    draws = draws.withColumn("b", F.col("b") + (F.col("b") >= F.col("a")).cast("int"))
    low, high = F.least("a", "b"), F.greatest("a", "b")
    third = F.col("c") + (F.col("c") >= low).cast("int")
    draws = draws.withColumn("c", third + (third >= high).cast("int"))
    three = draws.select("label", "trial", F.posexplode(F.array("a", "b", "c")).alias("k", "rn")).withColumn("rn", F.col("rn") + 1)
    at = three.join(ranked.select("label", "rn", *AXES), ["label", "rn"]).groupBy("label", "trial").agg(
        *[F.max(F.when(F.col("k") == k, F.col(c))).alias(f"p{k}{c}") for k in range(3) for c in AXES])
    normal = C.cross(*[[F.col(f"p{k}{c}") - F.col(f"p0{c}") for c in AXES] for k in (1, 2)])
    size = C.length(normal)
    tried = durable(at.select("label", "trial", *[F.col(f"p0{c}").alias(f"a{c}") for c in AXES], *[n.alias(f"t{c}") for n, c in zip(normal, AXES)], size.alias("s"))
                    .filter("s >= 1e-15").select("label", "trial", *[f"a{c}" for c in AXES], *[(F.col(f"t{c}") / F.col("s")).alias(f"t{c}") for c in AXES]))
    rows = durable(rows)
    way, spot = [F.col(f"t{c}") for c in AXES], [F.col(f"a{c}") for c in AXES]
    votes = tried.join(rows, "label").filter(_near_plane(way, spot)).groupBy("label", "trial").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy("label").agg(F.max(F.struct("n", (-F.col("trial")).alias("t"))).alias("m")).filter("m.n >= 3").select("label", (-F.col("m.t")).alias("trial"))
    first = rows.join(tried.join(best, ["label", "trial"]), "label").filter(_near_plane(way, spot)).select("label", *AXES)
    plane = durable(_planes(_moments(first)))
    again = rows.join(plane.select("label", *[f"c{c}" for c in AXES], *[f"n{c}" for c in AXES]), "label") \
        .filter(_near_plane([F.col(f"n{c}") for c in AXES], [F.col(f"c{c}") for c in AXES])).select("label", *AXES)
    refit = durable(_planes(_moments(again)).filter("inliers >= 3"))
    return refit.unionByName(plane.join(refit.select("label"), "label", "left_anti").select(*refit.columns))


#: clicks that meet the support around their tile in one task
TILE_CLICKS = 8_000

#: what a click's support gives: points within the radius, median depth and spread, consensus plane with its depths
FOUND = ["label", "n", "zmed", "spread", "inliers", "least", *[f"q{a}" for a in AXES], *[f"n{a}" for a in AXES], "z_low", "z_high"]


def _plane_of(xyz: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Centre, direction of least scatter and its variance."""
    mid = xyz.mean(0)
    value, vector = np.linalg.eigh((xyz - mid).T @ (xyz - mid) / len(xyz))
    return mid, vector[:, 0], max(float(value[0]), 0.0)


def _consensus(xyz: np.ndarray, tol: float, draws: np.ndarray):
    """consensus_planes for one click's rows in the order of their points; draws(trial, 3) are its hashes."""
    of = len(xyz)
    a, b, c = (draws[:, j] % (of - j) for j in range(3))
    b = b + (b >= a)
    low, high = np.minimum(a, b), np.maximum(a, b)
    c = c + (c >= low)
    c = c + (c >= high)
    way = np.cross(xyz[b] - xyz[a], xyz[c] - xyz[a])
    size = np.sqrt((way * way).sum(1))
    fit = size >= 1e-15
    if not fit.any():
        return None
    way, at = way[fit] / size[fit, None], xyz[a[fit]]
    step = max(1, (1 << 20) // of)
    votes = np.concatenate([(np.abs((xyz[None] - at[i:i + step, None]) @ way[i:i + step, :, None])[..., 0] < tol).sum(1) for i in range(0, len(way), step)])
    best = int(np.argmax(votes))
    if votes[best] < 3:
        return None
    mine = xyz[np.abs((xyz - at[best]) @ way[best]) < tol]
    mid, normal, least = _plane_of(mine)
    again = xyz[np.abs((xyz - mid) @ normal) < tol]
    if len(again) < 3:
        return len(mine), least, mid, normal
    mid, normal, least = _plane_of(again)
    return len(again), least, mid, normal


def _support_of(limits: ClickLimits, r: float, last: bool, kind: pa.DataType):
    schema = pa.schema([("label", kind), ("n", pa.int64()), *[(c, pa.int64() if c == "inliers" else pa.float64()) for c in FOUND[2:]]])

    def run(clicks: pa.Table, near: pa.Table) -> pa.Table:
        """FOUND of each click of a tile. Its pairs with the points are never written; a click that is not settled has its count only."""
        near = near.sort_by([("point", "ascending")])
        u, v, *xyz = (near.column(c).to_numpy() for c in ("u", "v", *AXES))
        place = np.ascontiguousarray(np.array(xyz).T)
        mine = {c: clicks.column(c).to_numpy() for c in ("u", "v", "r20", "r21", "r22", "t2")}
        rows = []
        for i, label in enumerate(clicks.column("label").to_pylist()):
            du, dv = u - mine["u"][i], v - mine["v"][i]
            inside = np.flatnonzero(np.sqrt(du * du + dv * dv) <= r)
            row = dict.fromkeys(FOUND) | {"label": label, "n": len(inside)}
            rows.append(row)
            if not last and len(inside) < limits.min_plane:
                continue
            p = place[inside]
            z = p[:, 1] * mine["r21"][i] + p[:, 2] * mine["r22"][i] + p[:, 0] * mine["r20"][i] + mine["t2"][i]
            known = z[np.isfinite(z)]
            if len(inside) < limits.min_support or not len(known):
                continue
            row["zmed"] = float(np.median(known))
            row["spread"] = float(np.median(np.abs(known - row["zmed"]))) * 1.4826
            if len(inside) < max(limits.min_plane, 3):
                continue
            tol = row["zmed"] * limits.tolerance
            plane = _consensus(p, tol, clicks.column("draws")[i].values.to_numpy().reshape(-1, 3))
            if plane:
                row["inliers"], row["least"], mid, normal = plane
                row |= {f"q{a}": float(m) for a, m in zip(AXES, mid)} | {f"n{a}": float(w) for a, w in zip(AXES, normal)}
                on = z[np.abs((p - mid) @ normal) < tol]
                if len(on):
                    row["z_low"], row["z_high"] = float(on.min()), float(on.max())
        return pa.Table.from_pylist(rows, schema)

    return run


def _tiles(clicks: DataFrame, support: DataFrame, r: float, hot_rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clicks, support, crowded): clicks with their tile of four radii and, in full tiles, a share of them; support
    rows in every such share within reach, and the labels whose tile has more than ``hot_rows`` of them."""
    side = 4 * r
    home = clicks.select("*", F.floor(F.col("u") / side).alias("cu"), F.floor(F.col("v") / side).alias("cv"))
    # a hair more than the radius, so that rounding at a tile's edge leaves no point out
    reach = r * (1 + 1e-9)
    spread = support.filter((F.abs("u") < float("inf")) & (F.abs("v") < float("inf")))
    for c, p in (("cu", "u"), ("cv", "v")):
        slack = F.lit(reach) + F.abs(p) * 1e-12
        spread = spread.withColumn(c, F.explode(F.sequence(F.floor((F.col(p) - slack) / side), F.floor((F.col(p) + slack) / side))))
    at = ["view", "cu", "cv"]
    shares = home.groupBy(*at).agg(F.ceil(F.count(F.lit(1)) / F.lit(TILE_CLICKS)).cast("int").alias("shares"))
    full = spread.groupBy(*at).agg(F.count(F.lit(1)).alias("rows"))
    tiles = durable(shares.join(full, at, "left").select(*at, "shares", (F.coalesce("rows", F.lit(0)) > hot_rows).alias("crowded")))
    home = home.join(tiles, at)
    crowded = home.filter("crowded").select("label")
    home = home.filter("not crowded").withColumn("share", F.pmod(F.xxhash64("label"), F.col("shares")).cast("int")).drop("shares", "crowded")
    spread = spread.join(tiles.filter("not crowded").select(*at, F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share")), at)
    return home, spread, crowded


def tile_surfaces(clicks: DataFrame, support: DataFrame, limits: ClickLimits, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(found, crowded): FOUND and the radius of clicks(label, view, u, v, r20, r21, r22, t2), as growing_support, the
    medians and consensus_planes have them, and the labels left to those since more than ``hot_rows`` points are near.

    The points of a view that a click may need meet it in a tile as wide as four radii and every number of
    the click is taken there, so what is shuffled grows with clicks and points, not with their pairs."""
    draw = F.transform(F.sequence(F.lit(0), F.lit(limits.trials - 1)), lambda t: F.array(*[F.xxhash64(F.lit(limits.seed), "label", t, F.lit(j)) for j in range(3)]))
    kind = to_arrow_type(clicks.schema["label"].dataType)
    out = ", ".join([f"label {clicks.schema['label'].dataType.simpleString()}", "n long", *[f"{c} {'long' if c == 'inliers' else 'double'}" for c in FOUND[2:]]])
    live, r, found, crowded = clicks, limits.radius, None, None
    at = ["view", "cu", "cv", "share"]
    while True:
        last = 2 * r > limits.max_radius
        home, near, full = _tiles(live, support, r, hot_rows)
        home = home.withColumn("draws", F.flatten(draw))
        met = durable(home.groupBy(*at).cogroup(near.groupBy(*at)).applyInArrow(_support_of(limits, r, last, kind), out))
        settled = met.filter((F.col("n") >= limits.min_plane) | F.lit(last)).withColumn("radius", F.lit(r))
        found, crowded = (settled, full) if found is None else (found.unionByName(settled), crowded.unionByName(full))
        live = durable(live.join(met.filter(F.col("n") < limits.min_plane).select("label"), "label", "left_semi"))
        if last or live.isEmpty():
            return found, durable(crowded)
        r *= 2


def _joined_surfaces(c: DataFrame, support: DataFrame, limits: ClickLimits, hot_rows: int) -> DataFrame:
    """FOUND and the radius of clicks with crowded surroundings, every step a join or an aggregate of its own."""
    near, radii = growing_support(c, support, limits.radius, limits.max_radius, limits.min_plane)
    near, radii = durable(near.join(c.select("label", "r20", "r21", "r22", "t2"), "label").select(
        "label", "point", *AXES, (C.dot([F.col(f"r2{j}") for j in range(3)], [F.col(a) for a in AXES]) + F.col("t2")).alias("z_in"))), durable(radii)
    enough = radii.filter(F.col("n") >= limits.min_support).select("label")
    mid = durable(quantiles(near.join(enough, "label", "left_semi"), ["label"], {"z": F.col("z_in")}, {"p50": 0.5}, hot_rows))
    off = near.join(mid, "label").select("label", F.abs(F.col("z_in") - F.col("z_p50")).alias("off"))
    mid = durable(mid.join(quantiles(off, ["label"], {"off": F.col("off")}, {"p50": 0.5}, hot_rows), "label")
                  .select("label", F.col("z_p50").alias("zmed"), (F.col("off_p50") * 1.4826).alias("spread")))
    able = radii.filter(F.col("n") >= limits.min_plane).join(mid, "label").select("label", (F.col("zmed") * limits.tolerance).alias("tol"))
    rows = near.join(able, "label")
    planes = consensus_planes(rows.select("label", "point", *AXES, "tol"), limits.trials, limits.seed, hot_rows)
    # the centre of a plane must not meet the camera columns cx, cy
    planes = durable(planes.select("label", "inliers", "least", *[F.col(f"c{a}").alias(f"q{a}") for a in AXES], *[f"n{a}" for a in AXES]))
    p_at, p_n = [F.col(f"q{a}") for a in AXES], [F.col(f"n{a}") for a in AXES]
    ends = rows.join(planes, "label").filter(_near_plane(p_n, p_at)).groupBy("label").agg(F.min("z_in").alias("z_low"), F.max("z_in").alias("z_high"))
    return radii.join(mid, "label", "left").join(planes, "label", "left").join(ends, "label", "left").select(*FOUND, "radius")


def local_surface(clicks: DataFrame, support: DataFrame, limits: ClickLimits = ClickLimits(), hot_rows: int = HOT_ROWS) -> DataFrame:
    """(label, status, flags, submethod, x, y, z, depth, radius, support, inliers, sigma) for clicks in one view.

    The ray of the click meets a consensus plane through the support points around it (submethod
    ``plane``), or stops at their median depth where there are too few for a plane, too few inliers, or
    the plane is seen too flat (``median``). A column ``offset`` of clicks lifts the plane toward the
    camera. sigma is the spread along the ray. Fewer than limits.min_support points, or a plane behind
    the camera, refuse the click."""
    c = clicks if "offset" in clicks.columns else clicks.withColumn("offset", F.lit(0.0))
    c = durable(c.select("label", "view", "u", "v", F.col("offset").cast("double").alias("offset"), *CAMERA))
    found, crowded = tile_surfaces(c.select("label", "view", "u", "v", "r20", "r21", "r22", "t2"), support, limits, hot_rows)
    if not crowded.isEmpty():
        # a click that grew into a crowded tile starts again there, at the first radius
        found = found.unionByName(_joined_surfaces(c.join(crowded, "label", "left_semi"), support, limits, hot_rows))
    # a click without a finite pixel lies in no tile
    most = limits.radius
    while 2 * most <= limits.max_radius:
        most *= 2
    j = c.join(durable(found), "label", "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("radius", F.coalesce("radius", F.lit(most)))
    p_at, p_n = [F.col(f"q{a}") for a in AXES], [F.col(f"n{a}") for a in AXES]
    ray, home = pixel_ray(), centre()
    j = durable(j.select("*", *[r.alias(f"d{a}") for r, a in zip(ray, AXES)], *[h.alias(f"o{a}") for h, a in zip(home, AXES)]))
    d, o = [F.col(f"d{a}") for a in AXES], [F.col(f"o{a}") for a in AXES]
    cos = F.abs(C.dot(p_n, d))
    side = F.when(C.dot(p_n, [a - b for a, b in zip(o, p_at)]) < 0, -1.0).otherwise(1.0)
    j = j.select("*", cos.alias("cos"), side.alias("side"), F.degrees(F.acos(F.least(F.lit(1.0), cos))).alias("incidence"))
    lean = C.dot(p_n, d) * F.col("side")
    hit = C.dot(p_n, [b - a for a, b in zip(o, p_at)]) * F.col("side")
    j = j.select("*", F.try_divide(hit, lean).alias("bare"), F.try_divide(hit + F.col("offset"), lean).alias("along"), C.dot([F.col(f"r2{i}") for i in range(3)], d).alias("zray"))
    t2 = C.dot([F.col(f"r2{i}") for i in range(3)], o) + F.col("t2")
    few = F.col("inliers") < limits.min_inliers
    planar = F.col("inliers").isNotNull() & ~few & (F.col("incidence") <= limits.max_incidence)
    j = j.withColumn("plane", F.coalesce(planar, F.lit(False))).withColumn("bare_z", t2 + F.col("bare") * F.col("zray"))
    far = F.when(F.col("plane"), F.col("along")).otherwise(F.try_divide(F.col("zmed"), F.col("zray")) - F.col("offset"))
    j = j.withColumn("far", far).withColumn("depth", t2 + F.col("far") * F.col("zray"))
    wanted = F.col("n") >= limits.min_plane
    why = F.when(F.col("n") < limits.min_support, "support").when(F.col("plane") & ((F.col("depth") <= 0) | (F.col("bare_z") <= 0)), "behind_camera")
    flags = F.array_compact(F.array(
        F.when(wanted & F.col("inliers").isNull(), "no_plane"), F.when(wanted & few, "few_inliers"),
        F.when(~few & (F.col("inliers") / F.col("n") < limits.min_share), "mixed_surfaces"),
        F.when(~few & (F.col("incidence") > limits.max_incidence), "grazing"),
        F.when(F.col("plane") & ~F.col("bare_z").between(F.col("z_low"), F.col("z_high")), "outside_depths"),
        F.when(~F.col("plane") & (F.col("offset") != 0), "offset_along_ray"),
        F.when(~F.col("plane") & (F.col("spread") / F.col("zmed") > limits.max_spread), "depth_spread")))
    rms = F.sqrt(F.col("least") * F.col("inliers") / (F.col("inliers") - 3))
    sigma = F.when(F.col("plane"), rms * F.sqrt(1 + F.lit(3.0) / F.col("inliers")) / F.greatest(F.col("cos"), F.lit(1e-12))) \
        .otherwise(F.col("spread") / F.greatest(F.col("zray"), F.lit(1e-12)))
    ok = F.col("why").isNull()
    j = j.withColumn("why", why).withColumn("flags", flags)
    return j.select("label", F.when(~ok, "refused").when(F.size("flags") > 0, "flagged").otherwise("ok").alias("status"),
                    F.when(ok, F.col("flags")).otherwise(F.array("why")).alias("flags"), F.when(ok, F.when(F.col("plane"), "plane").otherwise("median")).alias("submethod"),
                    *[F.when(ok, a + F.col("far") * b).alias(n) for a, b, n in zip(o, d, AXES)], F.when(ok, F.col("depth")).alias("depth"), "radius",
                    F.col("n").alias("support"), "inliers", F.when(ok, sigma).alias("sigma"))


def solve_clicks(obs: DataFrame, support: DataFrame, limits: ClickLimits = ClickLimits(), hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per label of obs(label, view, u, v, camera columns): labels seen in two views or more are
    triangulated (``multi-view``), the others meet their local surface (``single-view``). Two clicks of
    a label in one view are refused as ``repeated_view``; columns a method lacks are null."""
    obs = durable(obs)
    size = durable(obs.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("view").alias("views")))
    many = obs.join(size.filter("n >= 2 and n = views").select("label"), "label", "left_semi")
    one = obs.join(size.filter("n = 1").select("label"), "label", "left_semi")
    odd = size.filter("n <> views").select("label", F.lit("multi-view").alias("method"), F.lit("refused").alias("status"), F.array(F.lit("repeated_view")).alias("flags"))
    parts = [multi_view(many, limits).withColumn("method", F.lit("multi-view")), local_surface(one, support, limits, hot_rows).withColumn("method", F.lit("single-view")), odd]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
