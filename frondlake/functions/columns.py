"""Column builders shared by the plans. All stay inside JVM code generation."""

from __future__ import annotations

import math

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# fixed values
SH_C0 = 0.28209479177387814
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png")
MASK_SUFFIXES = (".png",)


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def finite_or_null(c: Column) -> Column:
    return F.when(finite(c), c)


def clip(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def sigmoid(c: Column) -> Column:
    """Opacity of a logit; the logit is clipped to +-500 so exp stays finite."""
    return 1 / (1 + F.exp(-clip(c.cast("double"), -500.0, 500.0)))


def dc_to_rgb(c: Column) -> Column:
    return clip(0.5 + F.lit(SH_C0) * c.cast("double"), 0.0, 1.0)


def middle_size(a: Column, b: Column, c: Column) -> Column:
    """Median of the three axis sizes given as log scales."""
    a, b, c = (F.exp(x.cast("double")) for x in (a, b, c))
    return F.greatest(F.least(a, b), F.least(F.greatest(a, b), c))


def greenness(r: Column, g: Column, b: Column) -> Column:
    return g - F.greatest(r, b)


def saturation(r: Column, g: Column, b: Column) -> Column:
    return F.greatest(r, g, b) - F.least(r, g, b)


def luminance(r: Column, g: Column, b: Column) -> Column:
    return 0.2126 * r + 0.7152 * g + 0.0722 * b


def affine(xyz: list[Column], rotation, origin, scale: float) -> list[Column]:
    """scale * R (p - o), as three linear expressions."""
    moved = [c - F.lit(float(o)) for c, o in zip(xyz, origin)]
    return [F.lit(float(scale)) * sum((F.lit(float(r)) * m for r, m in zip(row[1:], moved[1:])),
                                      F.lit(float(row[0])) * moved[0]) for row in rotation]


def quat_multiply(a: list[Column], b: list[Column]) -> list[Column]:
    """Hamilton product of (w, x, y, z) quaternions."""
    aw, ax, ay, az = a
    bw, bx, by, bz = b
    return [aw * bw - ax * bx - ay * by - az * bz, aw * bx + ax * bw + ay * bz - az * by,
            aw * by - ax * bz + ay * bw + az * bx, aw * bz + ax * by - ay * bx + az * bw]


def quat_to_matrix(q: list[Column]) -> list[list[Column]]:
    n = F.sqrt(sum((c * c for c in q[1:]), q[0] * q[0]))
    w, x, y, z = (c / n for c in q)
    return [[1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)],
            [2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)],
            [2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)]]


def matrix_to_quat(m: list[list[Column]]) -> list[Column]:
    """Unit quaternion with w >= 0: the largest of the four squared components is taken first."""
    t = m[0][0] + m[1][1] + m[2][2]
    sq = [1 + t, 1 + 2 * m[0][0] - t, 1 + 2 * m[1][1] - t, 1 + 2 * m[2][2] - t]
    cross = {(0, 1): m[2][1] - m[1][2], (0, 2): m[0][2] - m[2][0], (0, 3): m[1][0] - m[0][1],
             (1, 2): m[1][0] + m[0][1], (1, 3): m[0][2] + m[2][0], (2, 3): m[2][1] + m[1][2]}

    def given(i):
        big = F.sqrt(sq[i]) / 2
        parts = [big if j == i else cross[min(i, j), max(i, j)] / (4 * big) for j in range(4)]
        flip = F.when(parts[0] < 0, -1.0).otherwise(1.0)
        return F.array(*[p * flip for p in parts])

    best = F.greatest(*sq)
    chosen = F.when(sq[0] > 1, given(0)).when(best == sq[1], given(1)).when(best == sq[2], given(2)).otherwise(given(3))
    return [F.get(chosen, i) for i in range(4)]


def covariance(log_scales: list[Column], q: list[Column]) -> list[list[Column]]:
    """R diag(exp(s))^2 R^T of a Gaussian."""
    r, s2 = quat_to_matrix(q), [F.exp(2 * c) for c in log_scales]
    return [[r[i][0] * s2[0] * r[j][0] + r[i][1] * s2[1] * r[j][1] + r[i][2] * s2[2] * r[j][2]
             for j in range(3)] for i in range(3)]


def sh_basis(x, y, z, degree: int, lib=F):
    """Real spherical harmonics up to ``degree`` at a unit direction, bands in order m = -l..l.

    Built from the associated Legendre recurrence with the z part kept polynomial and
    (x + iy)^m expanded step by step. Works on Columns and on NumPy arrays."""
    cos, sin = [1.0 + 0.0 * x], [0.0 * x]
    for _ in range(degree):
        c, s = cos[-1], sin[-1]
        cos.append(x * c - y * s)
        sin.append(x * s + y * c)
    legendre = {}
    for m in range(degree + 1):
        legendre[m, m] = math.prod(range(1, 2 * m, 2)) + 0.0 * z
        for l in range(m + 1, degree + 1):
            prev = legendre.get((l - 2, m), 0.0)
            legendre[l, m] = ((2 * l - 1) * z * legendre[l - 1, m] - (l + m - 1) * prev) / (l - m)
    out = []
    for l in range(degree + 1):
        for m in range(-l, l + 1):
            a = abs(m)
            norm = math.sqrt((2 * l + 1) / (4 * math.pi) * math.factorial(l - a) / math.factorial(l + a))
            norm *= (1.0 if m == 0 else math.sqrt(2.0)) * (-1.0) ** a
            turn = cos[a] if m >= 0 else sin[a]
            out.append(norm * legendre[l, a] * turn)
    return out


def dot(a: list[Column], b: list[Column]) -> Column:
    return sum((x * y for x, y in zip(a[1:], b[1:])), a[0] * b[0])


def cross(a: list[Column], b: list[Column]) -> list[Column]:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def length(a: list[Column]) -> Column:
    return F.sqrt(dot(a, a))


def angle_deg(a: list[Column], b: list[Column]) -> Column:
    return F.degrees(F.acos(clip(dot(a, b) / (length(a) * length(b)), -1.0, 1.0)))


def distort(x: Column, y: Column, k: dict[str, float]) -> tuple[Column, Column]:
    """OpenCV radial and tangential distortion of normalised coordinates."""
    r2 = x * x + y * y
    radial = 1 + r2 * (k.get("k1", 0.0) + r2 * (k.get("k2", 0.0) + r2 * k.get("k3", 0.0)))
    p1, p2 = k.get("p1", 0.0), k.get("p2", 0.0)
    return (x * radial + 2 * p1 * x * y + p2 * (r2 + 2 * x * x),
            y * radial + p1 * (r2 + 2 * y * y) + 2 * p2 * x * y)


def smoothstep(c: Column) -> Column:
    t = clip(c, 0.0, 1.0)
    return t * t * (3 - 2 * t)


def iou(tp: Column, fp: Column, fn: Column) -> Column:
    """1 when both masks are empty."""
    return F.coalesce(F.try_divide(tp.cast("double"), tp + fp + fn), F.lit(1.0))


def dice(tp: Column, fp: Column, fn: Column) -> Column:
    return F.coalesce(F.try_divide(2.0 * tp, 2 * tp + fp + fn), F.lit(1.0))


def psnr(mse: Column) -> Column:
    return F.when(mse == 0, float("inf")).otherwise(-10 * F.log10(mse))


def slug(c: Column) -> Column:
    """Kebab-case id of a path."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def safe_filename(c: Column) -> Column:
    """A plain name: no separator, no control character, not hidden, not . or .."""
    return c.rlike(r"^[^./\\\x00-\x1f][^/\\\x00-\x1f]*$")


def within_path(path: Column, root: Column) -> Column:
    return (path == root) | F.startswith(path, F.concat(root, F.lit("/")))


def size_bytes(c: Column) -> Column:
    """Bytes of a size text with an optional K, M, G or T suffix; null when it is not one."""
    number = F.regexp_extract(F.trim(c), r"^(\d+)\s*([KMGTkmgt]?)$", 1)
    unit = F.upper(F.regexp_extract(F.trim(c), r"^(\d+)\s*([KMGTkmgt]?)$", 2))
    power = F.when(unit == "K", 1 << 10).when(unit == "M", 1 << 20).when(unit == "G", 1 << 30) \
        .when(unit == "T", 1 << 40).otherwise(1)
    return number.try_cast("bigint") * power


def cpu_list(c: Column) -> Column:
    """Sorted distinct cpu numbers of a list such as 0-2,5."""
    part = F.transform(F.split(c, ","), lambda p: F.split(F.trim(p), "-"))
    runs = F.transform(part, lambda p: F.sequence(F.get(p, F.lit(0)).cast("int"), F.get(p, F.size(p) - 1).cast("int")))
    return F.array_sort(F.array_distinct(F.flatten(runs)))


def extension(c: Column) -> Column:
    """Lower-case extension with its dot, from a bare or dotted spelling."""
    t = F.lower(F.trim(c))
    return F.when(F.startswith(t, F.lit(".")), t).otherwise(F.concat(F.lit("."), t))


def suffix_of(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))


def elapsed(seconds: Column) -> Column:
    s = F.round(seconds).cast("bigint")
    h, m, r = F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60))
    return F.when(h > 0, F.format_string("%dh%02dm%02ds", h, m, r)).when(m > 0, F.format_string("%dm%02ds", m, r)) \
        .otherwise(F.format_string("%ds", r))


def truth(c: Column) -> Column:
    """Boolean of a settings text, null when it is neither."""
    t = F.lower(F.trim(c))
    return F.when(t.isin("1", "true", "yes", "on"), True).when(t.isin("0", "false", "no", "off"), False)


def eval_token(mode: Column, fraction: Column, interval: Column) -> Column:
    percent = F.regexp_replace(F.regexp_replace(F.format_string("%.4f", fraction * 100), r"\.?0+$", ""), r"\.", "p")
    return F.when(mode == "fraction", F.concat(F.lit("evalfrac"), percent)) \
        .when(mode == "interval", F.concat(F.lit("evalint"), interval.cast("string"))).otherwise(F.concat(F.lit("eval"), mode))


def base26(n: Column) -> Column:
    """a, b, ..., z, aa, ab, ..., zz, aaa, ... for 0, 1, ...; 14 letters name every bigint."""
    start = F.struct(n.cast("long").alias("left"), F.lit("").alias("name"))

    def letter(acc, _):
        left = acc["left"]
        more = F.struct((F.floor(left / 26).cast("long") - 1).alias("left"), F.concat(F.chr(F.lit(97) + F.pmod(left, F.lit(26))), acc["name"]).alias("name"))
        return F.when(left < 0, acc).otherwise(more)

    return F.aggregate(F.sequence(F.lit(1), F.lit(14)), start, letter, lambda acc: acc["name"])


def padded(n: Column, width: int) -> Column:
    """A whole number with leading zeros up to width; longer numbers keep all their digits."""
    digits = n.cast("string")
    return F.concat(F.repeat(F.lit("0"), F.greatest(F.lit(0), F.lit(width) - F.length(digits))), digits)


def register(spark: SparkSession) -> None:
    """SQL functions of the same meaning, inlined by the optimizer."""
    for text in (
        "sigmoid(v DOUBLE) RETURNS DOUBLE RETURN 1 / (1 + exp(-greatest(-500D, least(500D, v))))",
        f"dc_to_rgb(v DOUBLE) RETURNS DOUBLE RETURN greatest(0D, least(1D, 0.5D + {SH_C0}D * v))",
        "iou(tp BIGINT, fp BIGINT, fn BIGINT) RETURNS DOUBLE RETURN coalesce(try_divide(CAST(tp AS DOUBLE), tp + fp + fn), 1D)",
        "dice(tp BIGINT, fp BIGINT, fn BIGINT) RETURNS DOUBLE RETURN coalesce(try_divide(2D * tp, 2 * tp + fp + fn), 1D)",
        "slug(p STRING) RETURNS STRING RETURN regexp_replace(regexp_replace(lower(p), '[^a-z0-9]+', '-'), '^-+|-+$', '')",
        "edge_key(a BIGINT, b BIGINT) RETURNS STRING RETURN concat_ws('-', least(a, b), greatest(a, b))",
    ):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {text}")
