"""Prefix trie of conversations; totals of all its subtrees by parallel tree contraction.

A node is a sequence of turns, named by a digest of them, so equal beginnings of different
conversations are one node. Totals come from contraction in join rounds: *compress* replaces every
unary chain by an edge to its end (pointers double), *rake* folds the leaves into their parents.
What is left has at most half the nodes, so rounds are logarithmic in any shape of tree; then the
contracted chains are re-expanded, last round first."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frondlake.llm.common import column
from frondlake.operators.ordered import HOT_ROWS, Ordered, ordered
from frondlake.session import durable

#: turns whose digests meet in one window; longer sequences get levels of blocks
BLOCK = 64
#: ids in a piece of a list of ids, and pieces of a list that are put together inside the JVM
PIECE, PIECES = 4096, 64
ROOT = "0" * 32


def _digest(*parts: Column) -> Column:
    return F.substring(F.sha2(F.concat(*parts), 256), 1, 32)


def prefixes(items: DataFrame, longest: int, block: int = BLOCK) -> DataFrame:
    """items(seq, i, digest, ...) plus ``prefix``, the digest of the items 0 to i of seq, and ``prev``,
    that of the items before i (null for i = 0). i counts from 0 without holes, below ``longest``.

    Windows never hold more than ``block`` items: the digests of whole blocks are a sequence of their
    own, whose prefixes are found the same way and joined back, so a key may hold any number of rows."""
    run = Window.partitionBy("seq", "b").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = items.withColumn("b", F.expr(f"i div {block}")).withColumn("run", F.collect_list("digest").over(run))
    rows = rows.select(*items.columns, "b", _digest(F.concat_ws("", "run")).alias("upto"),
                       F.when(F.size("run") > 1, _digest(F.concat_ws("", F.slice("run", 1, F.size("run") - 1)))).alias("before"))
    if longest <= block:
        return rows.select(*items.columns, _digest(F.col("upto")).alias("prefix"), _digest(F.col("before")).alias("prev"))
    rows = durable(rows)
    whole = rows.filter(f"i % {block} = {block - 1}").select("seq", F.col("b").alias("i"), F.col("upto").alias("digest"))
    above = prefixes(whole, -(-longest // block), block).select(
        "seq", (F.col("i") + 1).alias("b"), F.col("prefix").alias("e"), _digest(F.coalesce("prev", F.lit("")), F.col("digest")).alias("end"))
    e = F.coalesce("e", F.lit(""))
    return rows.join(above, ["seq", "b"], "left").select(
        *items.columns, _digest(e, F.col("upto")).alias("prefix"), F.coalesce(_digest(e, F.col("before")), F.col("end")).alias("prev"))


def _compress(unary: DataFrame, sums: list[str]) -> DataFrame:
    """unary(v, t, parent, sums), t being the only child of v, with t moved to the first node below that
    is not unary, the sums over all nodes passed, and ``head``: whether v's parent is not unary.

    Pointers double: each join doubles the way gone. Both sides of every join have unique keys, since
    a row leaves the left side as soon as its way has ended."""
    sources, targets = unary.select(F.col("v").alias("t"), F.lit(True).alias("inner")), unary.select(F.col("t").alias("v"), F.lit(True).alias("under"))
    rows = durable(unary.join(sources, "t", "left").join(targets, "v", "left").select(
        "v", "t", "parent", *sums, F.col("inner").isNotNull().alias("open"), F.col("under").isNull().alias("head")))
    ended, rows = rows.filter("not open"), rows.filter("open")
    while not rows.isEmpty():
        right = ended.unionByName(rows).select(F.col("v").alias("t"), F.col("t").alias("far"), F.col("open").alias("on"), *[F.col(s).alias(f"r_{s}") for s in sums])
        step = durable(rows.join(right, "t").select("v", F.col("far").alias("t"), "parent", *[(F.col(s) + F.col(f"r_{s}")).alias(s) for s in sums],
                                                    F.col("on").alias("open"), "head"))
        ended, rows = ended.unionByName(step.filter("not open")), step.filter("open")
    return ended.drop("open")


def subtree_totals(tree: DataFrame, sums: list[str]) -> DataFrame:
    """(id, sums): for each node of tree(id, parent, sums) the sums over its subtree, itself included.
    A null parent marks a root; there may be several. Every parent must be a node."""
    live = tree.select("id", "parent", *sums)
    known: DataFrame | None = None
    chains = []
    while True:
        kids = live.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("k"), F.min(live["id"]).alias("only"))
        live = durable(live.join(kids, "id", "left").withColumn("k", F.coalesce("k", F.lit(0))))
        unary = live.filter("k = 1").select(F.col("id").alias("v"), F.col("only").alias("t"), "parent", *sums)
        rest = live.filter("k <> 1").drop("only")
        if unary.isEmpty():
            rest = rest.select("*", *[F.lit(0).cast("long").alias(f"up_{s}") for s in sums])
        else:
            chain = _compress(unary, sums)
            chains.append(chain)
            # the end of a chain hangs below the parent of its head and brings the chain's sums along
            moved = chain.filter("head").select(F.col("t").alias("id"), F.col("parent").alias("over"), F.lit(True).alias("moved"),
                                                *[F.col(s).alias(f"up_{s}") for s in sums])
            rest = durable(rest.join(moved, "id", "left").select(
                "id", F.when(F.col("moved"), F.col("over")).otherwise(F.col("parent")).alias("parent"), "k", *sums,
                *[F.coalesce(f"up_{s}", F.lit(0)).alias(f"up_{s}") for s in sums]))
        leaf = rest.filter("k = 0").select("id", *sums)
        known = leaf if known is None else known.unionByName(leaf)
        own = [(F.when(F.col("k") == 0, F.col(s)).otherwise(0) + F.col(f"up_{s}")) for s in sums]
        gain = rest.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(*[F.sum(c).alias(f"g_{s}") for c, s in zip(own, sums)])
        live = rest.filter("k > 1")
        if live.isEmpty():
            break
        live = live.join(gain, "id", "left").select("id", "parent", *[(F.col(s) + F.coalesce(f"g_{s}", F.lit(0))).alias(s) for s in sums])
    for chain in reversed(chains):
        below = known.select(F.col("id").alias("t"), *[F.col(s).alias(f"b_{s}") for s in sums])
        known = known.unionByName(durable(chain.join(below, "t").select(F.col("v").alias("id"), *[(F.col(s) + F.col(f"b_{s}")).alias(s) for s in sums])))
    return known


def _hash_runs(batches):
    """sha256 of the comma-joined pieces of each id; rows come sorted by (id, chunk)."""
    schema = pa.schema([("id", pa.string()), ("ends_sha256", pa.string())])
    at, state = None, None
    for b in batches:
        done = []
        for i, piece in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if i == at:
                state.update(b"," + piece.encode())
            else:
                if at is not None:
                    done.append((at, state.hexdigest()))
                at, state = i, hashlib.sha256(piece.encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[j] for d in done], pa.string()) for j in (0, 1)], schema=schema)
    if at is not None:
        yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([state.hexdigest()])], schema=schema)


def id_list_digests(ends: DataFrame, piece: int = PIECE, pieces: int = PIECES) -> DataFrame:
    """(id, ends_sha256): SHA-256 of the ascending, comma-joined decimal members of ends(id, member).

    Members of a range of ``piece`` numbers make one string first, so no list grows with a hot id.
    Lists of few pieces are hashed in the JVM; longer ones stream, piece by piece in order, through one
    hash: SHA-256 of one string has no parallel form, and only its 32-byte state is held."""
    cut = durable(ends.groupBy("id", F.expr(f"member div {piece}").alias("chunk")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("member")), lambda x: x.cast("string")), ",").alias("piece")))
    count = cut.groupBy("id").agg(F.count("*").alias("n"))
    many = durable(count.filter(F.col("n") > pieces).select("id"))
    few, none = cut, many.isEmpty()
    if not none:
        few = cut.join(many, "id", "left_anti")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "piece"))), lambda x: x["piece"]), ",")
    out = few.groupBy("id").agg(F.sha2(text, 256).alias("ends_sha256"))
    if none:
        return out
    long = cut.join(many, "id", "left_semi").repartition("id").sortWithinPartitions("id", "chunk").select("id", "piece")
    return out.unionByName(long.mapInArrow(_hash_runs, "id string, ends_sha256 string"))


def rebuilt_turns(conversations: DataFrame, group: int = 100, heads: int = 6, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(turns, convs): turns(seq, i, digest, chars, last) of every rebuilt conversation and convs(seq, n),
    n its number of turns. Conversation c starts with the first h turns of c - c % group and goes on
    with its own after its first h, h = crc32 of c in decimal modulo ``heads``."""
    c = {n: column(conversations, n) for n in ("conv_id", "turn", "role", "text")}
    role, text = F.coalesce(c["role"], F.lit("")), F.coalesce(c["text"], F.lit(""))
    rows = conversations.select(c["conv_id"].cast("long").alias("seq"), c["turn"].cast("long").alias("turn"),
                                _digest(F.length(role).cast("string"), F.lit(":"), role, text).alias("digest"),
                                F.length(text).cast("long").alias("chars")).filter("seq is not null")
    placed = durable(ordered(rows, ["seq"], ["turn", "digest"], Ordered(rank="pos", totals={"n": F.lit(1)}), hot_rows).drop("turn"))
    cut = F.crc32(F.col("seq").cast("string").cast("binary")) % heads
    first = F.when(F.col("pos") < heads, F.struct("pos", "digest", "chars"))
    known = placed.groupBy("seq").agg(F.array_sort(F.collect_list(first)).alias("lead"), F.max("n").alias("own"))
    base = known.select(F.col("seq").alias("base"), "lead")
    convs = known.select("seq", "own", cut.cast("int").alias("h"), (F.col("seq") - F.col("seq") % group).alias("base")).join(base, "base", "left")
    convs = convs.withColumn("lead", F.coalesce(F.expr("slice(lead, 1, h)"), F.array().cast(known.schema["lead"].dataType)))
    convs = durable(convs.select("seq", "h", "lead", (F.size("lead") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n")))
    led = convs.select("seq", "n", F.posexplode("lead").alias("i", "x")).select(
        "seq", F.col("i").cast("long").alias("i"), "x.digest", "x.chars", "n")
    rest = placed.drop("n").filter(F.col("pos") > cut).join(convs.select("seq", "n", (F.size("lead") - F.col("h")).alias("shift")), "seq") \
        .select("seq", (F.col("pos") - 1 + F.col("shift")).alias("i"), "digest", "chars", "n")
    turns = led.unionByName(rest).withColumn("last", F.col("i") == F.col("n") - 1).drop("n")
    return turns, convs.select("seq", "n")


def conversation_trie(conversations: DataFrame, group: int = 100, heads: int = 6, hot_rows: int = HOT_ROWS, block: int = BLOCK,
                      piece: int = PIECE, pieces: int = PIECES) -> DataFrame:
    """One row per distinct beginning of the rebuilt conversations (see rebuilt_turns): (conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), the root being depth 0.

    Turns are ordered by turn, nulls first, equal turns by a digest of role and text; repeated rows are
    turns of their own. Null role or text counts as empty; rows without conv_id take no part; an empty
    table gives no rows; other columns are ignored. Texts leave their row as a digest and a length, so
    their size does not matter. A conversation may hold any share of the rows: positions come from
    blocks of its turns, prefixes from levels of ``block`` turns, and pointers replace walks."""
    turns, convs = rebuilt_turns(conversations, group, heads, hot_rows)
    convs = durable(convs)
    longest = convs.agg(F.max("n")).first()[0] or 0
    hung = prefixes(turns, longest, block)
    members = durable(hung.select(F.col("prefix").alias("id"), F.coalesce("prev", F.lit(ROOT)).alias("parent"), (F.col("i") + 1).alias("depth"),
                                  "seq", "chars", "last"))
    tops = convs.select(F.lit(ROOT).alias("id"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"), "seq",
                        F.lit(0).cast("long").alias("chars"), (F.col("n") == 0).alias("last"))
    every = members.unionByName(tops)
    nodes = durable(every.groupBy("id").agg(F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("seq").alias("conv_id"),
                                            F.count("*").alias("n_convs"), F.min("chars").alias("chars")))
    kids = nodes.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
    nodes = durable(nodes.join(kids, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    weights = nodes.select("id", "parent", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
                           ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"))
    totals = subtree_totals(weights, ["n_leaves", "saved_tokens"])
    ends = id_list_digests(every.filter("last").select("id", F.col("seq").alias("member")), piece, pieces)
    over = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(totals, "id").join(ends, "id", "left").join(over, "parent", "left")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", empty).alias("ends_sha256"))
