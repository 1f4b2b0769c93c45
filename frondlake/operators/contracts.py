"""Contracts between record tables: what breaks a rule becomes a row, nothing is dropped silently."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frondlake.operators.spatial import nearest
from frondlake.session import durable, in_tasks

#: label forms: a tape graduation in cm, and the two ends of a leaf
TAPE = r"^tape_([0-9]+(?:[.][0-9]+)?)cm$"
ENDS = r"^(.+)_(base|tip)$"


def click_faults(images: DataFrame, points: DataFrame) -> DataFrame:
    """(image, label, fault): every rule that images(name, width, height) and points(image, label, x, y)
    break: unnamed_image, repeated_image, bad_size, bad_label, unknown_image, repeated_label, not_finite, outside."""
    sized = images.groupBy("name").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.when((F.col("width") > 0) & (F.col("height") > 0), F.struct("width", "height"))).alias("size"))
    blank = F.coalesce(F.trim("name"), F.lit("")) == ""
    about = sized.select(F.col("name").alias("image"), F.lit(None).cast("string").alias("label"), F.explode(F.filter(F.array(
        F.when(blank, "unnamed_image"), F.when((F.col("n") > 1) & ~blank, "repeated_image"), F.when(F.col("size").isNull(), "bad_size")),
        lambda c: c.isNotNull())).alias("fault"))
    bad_label = F.coalesce((F.col("label") == "") | (F.trim("label") != F.col("label")), F.lit(True))
    known = points.join(sized.select(F.col("name").alias("image"), "size"), "image", "left")

    def finite(c: str) -> Column:
        return F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))

    within = F.col("x").between(0, F.col("size.width")) & F.col("y").between(0, F.col("size.height"))
    sound = finite("x") & finite("y")
    clicks = known.groupBy("image", "label").agg(F.count(F.lit(1)).alias("times"), F.bool_or(F.col("size").isNotNull()).alias("placed"),
                                                 F.bool_or(~sound).alias("wild"), F.bool_or(sound & ~within).alias("off"))
    named = F.when(bad_label, F.array(F.lit("bad_label"))).when(~F.col("placed"), F.array(F.lit("unknown_image"))).otherwise(F.filter(F.array(
        F.when(F.col("times") > 1, "repeated_label"), F.when(F.col("wild"), "not_finite"), F.when(F.col("off"), "outside")),
        lambda c: c.isNotNull()))
    return about.union(clicks.select("image", "label", F.explode(named).alias("fault")))


def captures(folders: DataFrame, marker: str = "images") -> DataFrame:
    """(capture, inside) of folders(path, link): folders that hold a folder ``marker``. Hidden folders, links
    and what lies below either are not searched. ``inside`` is the innermost capture around
    it, which makes a collection ambiguous; null for a sound one."""
    parts = F.split("path", "/")
    ways = folders.select("path", "link", parts.alias("parts"))
    closed = ways.filter("coalesce(link, false)").select(F.col("path").alias("up")).distinct()
    seen = ways.filter(~F.exists("parts", lambda p: p.startswith(".")) & ~F.coalesce("link", F.lit(False)) & (F.element_at("parts", -1) == marker))

    def above(col: str, own: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(col) - own), lambda i: F.array_join(F.slice(col, F.lit(1), i), "/"))

    shut = seen.select("path", F.explode(above("parts", 0)).alias("up")).join(closed, "up", "left_semi").select("path")
    found = durable(seen.join(shut.distinct(), "path", "left_anti").filter(F.size("parts") > 1)
                    .select(F.array_join(F.slice("parts", F.lit(1), F.size("parts") - 1), "/").alias("capture")).distinct())
    chain = found.withColumn("parts", F.split("capture", "/")).filter(F.size("parts") > 1).select("capture", F.explode(above("parts", 1)).alias("up"))
    outer = chain.join(found.select(F.col("capture").alias("up")), "up", "left_semi").groupBy("capture").agg(F.max_by("up", F.length("up")).alias("inside"))
    return found.join(outer, "capture", "left")


def detached(sizes: DataFrame, used: DataFrame, taken: DataFrame, share: float) -> DataFrame:
    """(cluster, size, overlap, status) for sizes(cluster, size): used when a plant names it, large from
    ``share`` of the largest cluster on, overlaps when rows of a plant fall into it, else detached.
    used(cluster); taken(cluster): one row per shared row."""
    top = sizes.agg(F.max("size").alias("top"))
    hits = taken.groupBy("cluster").agg(F.count(F.lit(1)).alias("overlap"))
    j = sizes.join(used.select("cluster").distinct().withColumn("named", F.lit(True)), "cluster", "left") \
        .join(hits, "cluster", "left").crossJoin(F.broadcast(top))
    status = F.when(F.col("named"), "used").when(F.col("size") >= share * F.col("top"), "large") \
        .when(F.col("overlap") > 0, "overlaps").otherwise("detached")
    return j.select("cluster", "size", F.coalesce("overlap", F.lit(0)).cast("long").alias("overlap"), status.alias("status"))


def leaf_ends(leaves: DataFrame, tips: DataFrame, network: DataFrame, gap: float, least: int = 20) -> DataFrame:
    """(leaf, points, base, node, distance, rule) per leaf of leaves(id, leaf, x, y, z) with at least
    ``least`` points: the tip closest to any of its points where that is under ``gap`` (rule tip), else
    the closest network point (rule nearest); base is the leaf's point there. Ties: smaller ids."""
    enough = leaves.groupBy("leaf").agg(F.count(F.lit(1)).alias("points")).filter(F.col("points") >= least)
    mine = durable(leaves.join(enough.select("leaf"), "leaf", "left_semi"))

    def best(to: DataFrame, name: str) -> DataFrame:
        near = nearest(mine.select("id", "x", "y", "z"), to).join(mine.select("id", "leaf"), "id")
        return near.groupBy("leaf").agg(F.min(F.struct("distance", F.col("neighbour").alias("node"), F.col("id").alias("base"))).alias(name))

    j = enough.join(best(tips, "t"), "leaf", "left").join(best(network, "q"), "leaf", "left")
    at_tip = F.coalesce(F.col("t.distance") < gap, F.lit(False))
    pick = F.when(at_tip, F.col("t")).otherwise(F.col("q"))
    return j.withColumn("p", pick).select("leaf", "points", "p.base", "p.node", "p.distance", F.when(at_tip, "tip").otherwise("nearest").alias("rule"))


def group_faults(members: DataFrame, known: DataFrame, kinds: tuple[str, ...], pair: str, exclusive: str) -> DataFrame:
    """(group, fault) of members(group, kind, member): kind not in ``kinds``, repeated_member, too_few, not_a_pair
    (kind ``pair`` has two), unknown_member, shared_member (in two groups of kind ``exclusive``). Members that come
    by group are grouped where they are; they are written once, and meet known ones and owners unsorted, by member."""
    one = durable(members.groupBy("group", "kind", "member").agg(F.count(F.lit(1)).alias("times")))
    rows = max(one.count(), known.count())
    there = in_tasks(known.select("member"), rows, "member").distinct().withColumn("__known", F.lit(True))
    # a group is in ``one`` once for a kind and member
    held = in_tasks(one.filter(F.col("kind") == exclusive).select("member", "group"), rows, "member")
    owners = held.groupBy("member").agg(F.count("group").alias("owners")).filter("owners > 1")
    mark = in_tasks(one, rows, "member").join(there.hint("shuffle_hash"), "member", "left").join(owners.hint("shuffle_hash"), "member", "left")
    g = in_tasks(mark, rows, "group").groupBy("group").agg(
        F.sum("times").alias("listed"), F.count(F.lit(1)).alias("distinct"), F.count_if(F.col("__known").isNull()).alias("unknown"),
        F.count_if((F.col("kind") == exclusive) & F.col("owners").isNotNull()).alias("shared"), F.min("kind").alias("kind"), F.max("kind").alias("other"))
    ok = F.coalesce(F.col("kind").isin(*kinds) & (F.col("kind") == F.col("other")), F.lit(False))
    return g.select("group", F.explode(F.filter(F.array(
        F.when(~ok, "kind"), F.when(F.col("listed") > F.col("distinct"), "repeated_member"), F.when(F.col("distinct") < 2, "too_few"),
        F.when((F.col("kind") == pair) & (F.col("listed") != 2), "not_a_pair"), F.when(F.col("unknown") > 0, "unknown_member"),
        F.when(F.col("shared") > 0, "shared_member")), lambda c: c.isNotNull())).alias("fault"))


def document_differences(stored: DataFrame, rebuilt: DataFrame, key: str) -> DataFrame:
    """(key, state) of two tables with the same columns and one row per key: missing from the stored
    one, surplus in it, changed in any column (nulls are values), or same."""
    rest = [c for c in stored.columns if c != key]
    a = stored.select(key, F.struct(*rest).alias("a"))
    b = rebuilt.select(key, F.struct(*rest).alias("b"))
    state = F.when(F.col("a").isNull(), "missing").when(F.col("b").isNull(), "surplus") \
        .when(F.col("a").eqNullSafe(F.col("b")), "same").otherwise("changed")
    return a.join(b, key, "full_outer").select(key, state.alias("state"))


def cycle_members(links: DataFrame) -> DataFrame:
    """(id) of every vertex on a cycle of links(id, to), at most one link per id. Pointers are doubled
    until they reach further than there are links: what they then point at lies on a cycle."""
    jump = durable(links.filter("to is not null").select("id", "to"))
    reach, count = 1, jump.count()
    while reach <= count:
        on = jump.select(F.col("id").alias("to"), F.col("to").alias("far"))
        jump = durable(jump.join(on, "to").select("id", F.col("far").alias("to")))
        reach *= 2
    return jump.select(F.col("to").alias("id")).distinct()


def graduations(labels: DataFrame) -> DataFrame:
    """(label, cm, repeated) of the labels that name a tape graduation; ``repeated`` marks a graduation
    that two different labels name."""
    n = F.regexp_extract("label", TAPE, 1)
    marks = labels.select("label", F.when(n != "", n.cast("double")).alias("cm")).filter("cm is not null").distinct()
    names = marks.groupBy("cm").agg(F.count(F.lit(1)).alias("names"))
    return marks.join(names, "cm").select("label", "cm", (F.col("names") > 1).alias("repeated"))


def end_pairs(labels: DataFrame) -> DataFrame:
    """(leaf, base, tip): labels of the form leaf_base and leaf_tip by leaf, tape labels left out."""
    leaf, end = F.regexp_extract("label", ENDS, 1), F.regexp_extract("label", ENDS, 2)
    named = labels.select("label", leaf.alias("leaf"), end.alias("end")).filter("end <> '' and not startswith(label, 'tape_')")
    return named.groupBy("leaf").agg(*[F.min(F.when(F.col("end") == e, F.col("label"))).alias(e) for e in ("base", "tip")])


def anchors(sample: DataFrame, group: str, axes: tuple[str, ...] = ("x", "y", "z"), order: str = "id") -> DataFrame:
    """(group, anchor, count): the sample row closest to its group's mean, the first in ``order`` on a tie."""
    mean = sample.groupBy(group).agg(*[F.avg(c).alias(f"m_{c}") for c in axes], F.count(F.lit(1)).alias("points"))
    off = sum(((F.col(c) - F.col(f"m_{c}")) * (F.col(c) - F.col(f"m_{c}")) for c in axes[1:]),
              (F.col(axes[0]) - F.col(f"m_{axes[0]}")) * (F.col(axes[0]) - F.col(f"m_{axes[0]}")))
    j = sample.join(mean, group).withColumn("__off", off)
    return j.groupBy(group).agg(F.min(F.struct("__off", order)).alias("s"), F.first("points").alias("points")) \
        .select(group, F.col(f"s.{order}").alias("anchor"), "points")


def seeded_sample(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """n rows drawn by the smallest digests of seed and key: the same rows on every run and layout.
    Each task keeps its own n smallest, so the whole table is never ordered."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(n)


def completed_match(jobs: DataFrame, captures_: DataFrame, recorded: DataFrame, current: DataFrame) -> DataFrame:
    """(capture, job, reason): the newest job that proves a capture complete with today's settings and
    inputs, or no job and the newest job's reason. jobs(job, capture, seq, status, verified, settings),
    captures_(capture, settings), recorded(job, input), current(capture, input). Reasons in order: status,
    unverified, settings, images (+added -removed); none without a job."""
    before = recorded.select("job", "input").distinct()
    now = current.select("capture", "input").distinct()
    owned = before.join(jobs.select("job", "capture"), "job")
    common = owned.join(now, ["capture", "input"]).groupBy("job").agg(F.count(F.lit(1)).alias("common"))
    had = before.groupBy("job").agg(F.count(F.lit(1)).alias("had"))
    has = now.groupBy("capture").agg(F.count(F.lit(1)).alias("has"))
    j = jobs.withColumnRenamed("settings", "then").join(captures_.select("capture", "settings"), "capture") \
        .join(common, "job", "left").join(had, "job", "left").join(has, "capture", "left").na.fill(0, ["common", "had", "has"])
    added, removed = F.col("has") - F.col("common"), F.col("had") - F.col("common")
    reason = F.when(~F.col("status").eqNullSafe(F.lit("completed")), "status").when(~F.coalesce("verified", F.lit(False)), "unverified") \
        .when(~F.col("then").eqNullSafe(F.col("settings")), "settings") \
        .when((added > 0) | (removed > 0), F.concat(F.lit("images +"), added.cast("string"), F.lit(" -"), removed.cast("string")))
    judged = j.withColumn("reason", reason)
    out = judged.groupBy("capture").agg(F.max(F.when(F.col("reason").isNull(), F.struct("seq", "job"))).alias("good"),
                                        F.max(F.struct("seq", "job", "reason")).alias("newest"))
    return captures_.select("capture").join(out, "capture", "left").select(
        "capture", F.col("good.job").alias("job"),
        F.when(F.col("newest").isNull(), "none").when(F.col("good").isNotNull(), "completed").otherwise(F.col("newest.reason")).alias("reason"))


def leaf_exports(leaves: DataFrame, stalks: DataFrame, joints: DataFrame) -> DataFrame:
    """(leaf, document): one JSON export per leaf of leaves(leaf, points, stalk), with its stalk of stalks(stalk,
    leaf, joint, x, y, z: first vertex) and the joint of joints(joint, x, y, z) where it has them."""
    s = stalks.select("stalk", F.struct("stalk", "leaf", "joint", "x", "y", "z").alias("petiole"), F.col("joint").alias("__j"))
    a = joints.select(F.col("joint").alias("__j"), F.struct("joint", "x", "y", "z").alias("attachment"))
    j = leaves.join(s, "stalk", "left").join(a, "__j", "left")
    return j.select("leaf", F.to_json(F.struct(F.struct("leaf", "points", "stalk").alias("row"), "petiole", "attachment")).alias("document"))


def reload_faults(exports: DataFrame, near: float = 1e-9) -> DataFrame:
    """(leaf, fault) of exports(leaf, document) read back: unreadable, identity, count, attachment_without_petiole,
    other_petiole, attachment_missing, off_attachment, or ok."""
    spot = "x: double, y: double, z: double"
    form = f"row struct<leaf: string, points: bigint, stalk: string>, petiole struct<stalk: string, leaf: string, joint: string, {spot}>, attachment struct<joint: string, {spot}>"
    d = exports.select("leaf", F.from_json("document", form).alias("d"))
    p, a = F.col("d.petiole"), F.col("d.attachment")
    off = F.greatest(*[F.abs(p[c] - a[c]) for c in "xyz"]) > near
    fault = F.when(F.col("d.row").isNull(), "unreadable").when(~F.col("d.row.leaf").eqNullSafe(F.col("leaf")), "identity") \
        .when(F.coalesce(F.col("d.row.points"), F.lit(0)) < 1, "count") \
        .when(p.isNull() & (a.isNotNull() | F.col("d.row.stalk").isNotNull()), "attachment_without_petiole") \
        .when(p.isNotNull() & ~(p["stalk"].eqNullSafe(F.col("d.row.stalk")) & p["leaf"].eqNullSafe(F.col("leaf"))), "other_petiole") \
        .when(p.isNotNull() & ~a["joint"].eqNullSafe(p["joint"]), "attachment_missing").when(F.coalesce(off, F.lit(False)), "off_attachment").otherwise("ok")
    return d.select("leaf", fault.alias("fault"))


def reference_status(references: DataFrame, known: DataFrame) -> DataFrame:
    """(owner, target, status) of references(owner, target, digest) against known(target, digest): missing,
    changed (another digest than the one cited), or ok."""
    k = known.select("target", F.col("digest").alias("now"), F.lit(True).alias("__known"))
    status = F.when(F.col("__known").isNull(), "missing").when(~F.col("digest").eqNullSafe(F.col("now")), "changed").otherwise("ok")
    return references.join(k, "target", "left").select("owner", "target", status.alias("status"))


def assign_detached(clusters: DataFrame, plants: DataFrame, accept: float, clear: float, slack: float) -> DataFrame:
    """(cluster, plant) for clusters(cluster, at, height) and plants(plant, at, radius, low, high): the plant within
    ``accept`` radii whose height range, widened by ``slack``, holds the cluster, when no other plant is within
    ``clear`` (not below ``accept``) radii; else null. A plant meets only the clusters in the cells that its reach touches."""
    widest = plants.agg(F.max("radius")).first()[0]
    if not widest:
        return clusters.select("cluster", F.lit(None).cast(plants.schema["plant"].dataType).alias("plant"))
    width = 2.0 * clear * float(widest)
    reach = F.col("radius") * (clear * (1 + 1e-9))
    cells = plants.select("plant", F.col("at").alias("m"), "radius", "low", "high", F.explode(F.sequence(
        F.floor((F.col("at") - reach) / width), F.floor((F.col("at") + reach) / width))).alias("cell"))
    near = clusters.withColumn("cell", F.floor(F.col("at") / width)).join(cells, "cell").withColumn("ratio", F.abs(F.col("at") - F.col("m")) / F.col("radius"))
    good = (F.col("ratio") <= accept) & F.col("height").between(F.col("low") - slack, F.col("high") + slack)
    found = near.filter(F.col("ratio") < clear).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.min(F.when(good, F.col("plant"))).alias("plant"))
    return clusters.select("cluster").join(found.filter("n = 1").select("cluster", "plant"), "cluster", "left")
