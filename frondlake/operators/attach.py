"""Attachment of points to a curve at a given angle: a bracketed root search on every segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frondlake.functions import columns as C
from frondlake.operators.ordered import HOT_ROWS, Ordered, ordered

AXES = ("x", "y", "z")
#: parts of a segment that are looked at for a change of sign, and halvings of such a part
PARTS, HALVINGS = 32, 56


def stem_segments(nodes: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(plant, segment, x, y, z, bx.., tx.., ux.., arc, length) of nodes(plant, i, x, y, z) in order of i:
    both ends, the unit tangents there (central differences, one-sided at the ends of the curve), the arc
    at the start and the length. Every plant's last node starts no segment."""
    around = ordered(nodes.select("plant", "i", *AXES), ["plant"], ["i"], Ordered(
        lags={f"p{c}": F.col(c) for c in AXES}, leads={f"b{c}": F.col(c) for c in AXES}), hot_rows)
    way = [F.coalesce(f"b{c}", c) - F.coalesce(f"p{c}", c) for c in AXES]
    length = F.coalesce(C.length([F.col(f"b{c}") - F.col(c) for c in AXES]), F.lit(0.0))
    node = around.select("plant", "i", *AXES, *[f"b{c}" for c in AXES], length.alias("length"), *[(w / C.length(way)).alias(f"t{c}") for w, c in zip(way, AXES)])
    runs = ordered(node, ["plant"], ["i"], Ordered(sums={"upto": F.col("length")}, leads={f"u{c}": F.col(f"t{c}") for c in AXES}), hot_rows)
    return runs.filter("bx is not null").select("plant", F.col("i").alias("segment"), *AXES, *[f"{p}{c}" for p in "btu" for c in AXES],
                                                (F.col("upto") - F.col("length")).alias("arc"), "length")


def reference_angles(anchors: DataFrame, known: DataFrame) -> DataFrame:
    """anchors(plant, id, arc, ...) plus ``angle``: the mean angle of the two of known(plant, leaf, arc, angle),
    of the anchor's plant, that lie nearest along the curve, ties to the smaller leaf; null with fewer than two.
    The two are kept by one aggregate, so no list of a plant's leaves is ever built."""
    near = F.struct(F.abs(F.col("k.arc") - F.col("a.arc")).alias("off"), F.col("k.leaf").alias("leaf"), F.col("k.angle").alias("angle"))
    met = anchors.select("plant", "id", "arc").alias("a").join(known.alias("k"), "plant").select("plant", "id", near.alias("n"))
    first = met.groupBy("plant", "id").agg(F.min("n").alias("one"))
    second = met.join(first, ["plant", "id"]).filter("n > one").groupBy("plant", "id", "one").agg(F.min("n").alias("two"))
    return anchors.join(second.select("plant", "id", ((F.col("one.angle") + F.col("two.angle")) / 2).alias("angle")), ["plant", "id"], "left")


def _angle(t: Column) -> Column:
    """Between the way from the curve at t to the anchor and the tangent there, both from columns of a row."""
    to = [F.col(f"a{c}") - (F.col(c) + t * (F.col(f"b{c}") - F.col(c))) for c in AXES]
    along = [(1 - t) * F.col(f"t{c}") + t * F.col(f"u{c}") for c in AXES]
    cos = F.try_divide(C.dot(to, along), C.length(to) * C.length(along))
    return F.acos(C.clip(cos, -1.0, 1.0))


def attach(anchors: DataFrame, segments: DataFrame, exact: float = 1e-9) -> DataFrame:
    """(plant, id, segment, fraction, arc, shift, achieved, residual): for anchors(plant, id, x, y, z, arc,
    angle) the place on the curve of their plant from which they are seen at ``angle`` to the tangent,
    and of several the one nearest to ``arc`` along the curve, then in the smaller segment; null columns
    where there is none, or no angle.

    Each segment is a row that looks at PARTS + 1 places and keeps the parts over which the residual
    changes sign; each of these is halved HALVINGS times inside the row. Places where the residual is
    zero at a part's end count too. Segments without length have no tangent and hold no place."""
    named = anchors.select("plant", "id", *[F.col(c).alias(f"a{c}") for c in AXES], F.col("arc").alias("want"), "angle")
    rows = named.filter("angle is not null").join(segments, "plant")
    grid = F.transform(F.sequence(F.lit(0), F.lit(PARTS)), lambda i: i / float(PARTS))
    looked = rows.withColumn("off", F.transform(grid, lambda t: _angle(t) - F.col("angle")))
    part = F.sequence(F.lit(0), F.lit(PARTS - 1))
    crossing = F.filter(part, lambda i: F.get("off", i) * F.get("off", i + 1) < 0)
    touching = F.filter(F.sequence(F.lit(0), F.lit(PARTS)), lambda i: F.abs(F.get("off", i)) < exact / 10)
    spans = F.concat(F.transform(crossing, lambda i: F.struct((i / float(PARTS)).alias("lo"), ((i + 1) / float(PARTS)).alias("hi"), F.get("off", i).alias("f"))),
                     F.transform(touching, lambda i: F.struct((i / float(PARTS)).alias("lo"), (i / float(PARTS)).alias("hi"), F.get("off", i).alias("f"))))
    bracket = looked.withColumn("s", F.explode(spans)).drop("off")

    def halve(s: Column, _: Column) -> Column:
        mid = (s["lo"] + s["hi"]) / 2
        same = (_angle(mid) - F.col("angle")) * s["f"] > 0
        return F.struct(F.when(same, mid).otherwise(s["lo"]).alias("lo"), F.when(same, s["hi"]).otherwise(mid).alias("hi"), s["f"].alias("f"))

    found = bracket.withColumn("s", F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), F.col("s"), halve))
    found = found.withColumn("t", (F.col("s.lo") + F.col("s.hi")) / 2)
    found = found.withColumn("achieved", _angle(F.col("t"))).withColumn("at", F.col("arc") + F.col("t") * F.col("length"))
    good = found.withColumn("residual", F.abs(F.col("achieved") - F.col("angle"))).filter(F.col("residual") < exact)
    best = good.groupBy("plant", "id").agg(F.min(F.struct(F.abs(F.col("at") - F.col("want")).alias("shift"), "segment", F.col("t").alias("fraction"), F.col("at").alias("arc"),
                                                          "achieved", "residual")).alias("m"))
    return anchors.select("plant", "id").join(best, ["plant", "id"], "left").select(
        "plant", "id", *[F.col(f"m.{c}").alias(c) for c in ("segment", "fraction", "arc", "shift", "achieved", "residual")])
