"""Mixing sources to target weights by balanced sampling with the cube method."""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frondlake.llm.common import bounded, column, spare
from frondlake.operators.ordered import Ordered, ordered
from frondlake.session import durable

#: documents of a first flight, and blocks whose leftovers fly together afterwards
BLOCK, FAN = 2048, 512
#: units that the landing rounds together (2 to this power ways)
LAND = 10
EPS = 1e-9
_UNIT = "doc_id long, mix long, size long, stratum string, block int, p double, open boolean"


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator, until: int = 2) -> np.ndarray:
    """Move the probabilities within the null space of two constraints, the number of documents and
    of tokens, until few (``until``, and those no other unit can balance) stay fractional. Units come in decreasing size. Each step drives
    the largest fractional unit and lets all others give way with the least change that keeps both
    totals; the sign is drawn so that every expectation stays. Large documents are settled while many
    others can still balance them, so what is left over is small."""
    p = p.copy()
    scale = max(1.0, float(size.mean())) if len(size) else 1.0
    act = np.flatnonzero((p > EPS) & (p < 1 - EPS))
    s = size[act] / scale
    while len(act) > max(2, until):
        n, s1, s2 = len(act) - 1, s[1:].sum(), (s[1:] ** 2).sum()
        spread = n * s2 - s1 * s1
        u = np.empty(len(act))
        u[0] = 1.0
        if spread > 1e-9 * max(1.0, n * s2):
            b = (n * s[0] - s1) / spread
            u[1:] = -((1 - b * s1) / n + b * s[1:])
        elif abs(s[0] - s[1]) <= 1e-9 * max(1.0, s[0]):
            u[1:] = -1.0 / n
        else:  # the others are of one size and cannot balance this one: it is left over
            act, s = act[1:], s[1:]
            continue
        x = p[act]
        with np.errstate(divide="ignore", invalid="ignore"):
            to_one, to_zero = (1 - x) / np.abs(u), x / np.abs(u)
        up = np.where(u > 0, to_one, to_zero)[u != 0].min()
        down = np.where(u > 0, to_zero, to_one)[u != 0].min()
        x = x + (up if rng.random() * (up + down) < down else -down) * u
        x[x <= EPS] = 0.0
        x[x >= 1 - EPS] = 1.0
        p[act] = x
        left = (x > 0) & (x < 1)
        act, s = act[left], s[left]
    return p


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Round the few units a source has left, of all ways the one whose tokens come closest; a
    document too many or too few counts as a fiftieth of a mean document's tokens."""
    p = p.copy()
    act = np.flatnonzero((p > 0) & (p < 1))
    if len(act):
        ways = np.array(list(product((0.0, 1.0), repeat=len(act))))
        miss = np.abs(ways @ size[act] - p[act] @ size[act]) + np.abs(ways.sum(1) - p[act].sum()) * size[act].mean() / 50
        p[act] = ways[int(np.argmin(miss))]
    return p


def _fly(seed: int, last: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "mix", "doc_id"], ascending=[False, True, True], kind="stable", ignore_index=True)
        rng = np.random.default_rng([seed, int(last), int(pdf["block"][0]), *pdf["stratum"][0].encode()])
        size = pdf["size"].to_numpy(float)
        p = flight(pdf["p"].to_numpy(float), size, rng, LAND if last else 2)
        if last:
            p = landing(p, size)
        return pdf.assign(p=p, open=(p > 0) & (p < 1))

    return run


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """sizes(stratum, source_size) plus ``target``: strata by code point, null last, weigh ``weights``
    in turn and share ``share`` of all sizes; none goes above ``most`` times its own size, and what it
    cannot take goes to the others by weight, again until none is above."""
    keyed = sizes.withColumn("last", F.col("stratum") == "")
    place = ordered(keyed, [], ["last", "stratum"], Ordered(rank="__place")).withColumn("__place", F.col("__place") - 1)
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("__place", F.lit(len(weights))) + 1).cast("int"))
    table = durable(place.select("stratum", "source_size", w.cast("double").alias("weight")))
    total = float(table.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = None, -1
    while True:  # a source that is full stays full as the level rises, so this ends
        full = F.lit(False) if level is None else F.col("source_size") * most <= F.col("weight") * level
        n, taken, open_ = table.agg(F.count_if(full), F.sum(F.when(full, F.col("source_size") * most).otherwise(0.0)),
                                    F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if n == capped:
            break
        capped = n
        level = (total - (taken or 0.0)) / open_ if open_ else 0.0
    return table.select("stratum", "source_size", F.when(F.col("source_size") * most <= F.col("weight") * F.lit(level), F.col("source_size") * most)
                        .otherwise(F.col("weight") * F.lit(level)).alias("target"))


def mix_documents(docs: DataFrame, row_id: Column, source: Column, size: Column, mix: Column, weights: tuple[int, ...] = (3, 1, 2),
                  share: float = 1.5, most: float = 2.0, seed: int = 7) -> DataFrame:
    """(doc_id, mix, size, source, source_size, target, copies): how often the mix takes each document.

    A source's documents are all taken floor(target / size) times, and its remainder is the inclusion
    probability of one more copy. The cube method draws that sample: blocks of a source fly side by
    side, their last fractional units meet in wider blocks, and each source lands what remains, so
    its tokens miss the target by about the size of its smallest documents. Draws depend on the rows
    alone, so reruns agree. Copies never exceed ceil(most).

    A null source is the last source; a null text has size 0 and adds nothing; repeated rows are
    units of their own; an empty table gives no rows."""
    slim = durable(docs.select(row_id.cast("long").alias("doc_id"), mix.alias("mix"), size.cast("long").alias("size"),
                               F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("")).alias("stratum")))
    sizes = slim.groupBy("stratum").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    targets = durable(source_targets(sizes.select("stratum", "source_size"), weights, share, most)
                      .join(sizes.select("stratum", "rows"), "stratum")
                      .withColumn("rate", F.when(F.col("source_size") > 0, F.least(F.lit(most), F.col("target") / F.col("source_size"))).otherwise(0.0))
                      .withColumn("whole", F.floor(F.col("rate") + EPS).cast("int"))
                      .withColumn("p", F.greatest(F.lit(0.0), F.col("rate") - F.col("whole")))
                      .withColumn("blocks", F.ceil(F.col("rows") / BLOCK).cast("int")))
    blocks = targets.agg(F.max("blocks")).first()[0] or 1
    units = slim.join(targets.select("stratum", "p", "blocks"), "stratum") \
        .withColumn("block", F.pmod(F.xxhash64("mix", F.lit(seed)), F.col("blocks")).cast("int"))
    fractional = F.col("p") > EPS
    done = [units.filter(~fractional).select("doc_id", "mix", "size", "stratum", F.lit(0.0).alias("p"))]
    live = units.filter(fractional).select("doc_id", "mix", "size", "stratum", "block", "p", F.lit(True).alias("open"))
    while True:
        last = blocks == 1
        flown = durable(live.groupBy("stratum", "block").applyInPandas(_fly(seed, last), _UNIT))
        done.append(flown.filter("not open").select("doc_id", "mix", "size", "stratum", "p"))
        if last:
            break
        blocks = -(-blocks // FAN)
        live = flown.filter("open").withColumn("block", F.expr(f"cast(block div {FAN} as int)"))
    taken = done[0]
    for part in done[1:]:
        taken = taken.union(part)
    return taken.join(targets.select("stratum", "source_size", "target", "whole"), "stratum").select(
        "doc_id", "mix", "size", F.expr("nullif(stratum, '')").substr(2, 1 << 30).alias("source"), "source_size", "target",
        (F.col("whole") + F.round("p")).cast("int").alias("copies"))


def words_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def mix_corpus(docs: DataFrame, **options) -> DataFrame:
    """The documents table mixed by source, sizes in words."""
    i, t = column(docs, "doc_id"), column(docs, "text")
    return mix_documents(docs, i, column(docs, "source"), words_of(t), F.xxhash64(i.cast("long"), t), **options)


def take(docs: DataFrame, **options) -> DataFrame:
    """docs with each row as often as the mix takes it, all columns unchanged. Rows of one id and text
    share their copies evenly, the first of them one more each."""
    mixed = mix_corpus(docs, **options)
    key, copies, at = spare(docs, "__mix", "__copies", "__at")
    drawn = durable(mixed.groupBy(F.col("mix").alias(key)).agg(F.sum("copies").cast("int").alias(copies), F.count("*").alias(at)))
    keyed = docs.withColumn(key, F.xxhash64(column(docs, "doc_id").cast("long"), column(docs, "text")))
    joined = keyed.join(bounded(drawn), key)
    single = joined.filter(F.col(at) == 1)
    if not drawn.filter(F.col(at) > 1).isEmpty():
        rank = F.row_number().over(Window.partitionBy(key).orderBy(key)) - 1
        shared = joined.filter(F.col(at) > 1).withColumn(copies, F.floor((F.col(copies) + F.col(at) - 1 - rank) / F.col(at)).cast("int"))
        single = single.unionByName(shared)
    times = F.explode(F.array_repeat(F.lit(1), F.col(copies)))
    return single.filter(F.col(copies) > 0).withColumn(copies, times).drop(key, copies, at)
