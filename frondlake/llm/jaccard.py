"""N-gram Jaccard join: rare-first prefix filtering, each candidate pair verified once.

Texts move once, to batches. Batches send their distinct shingle hashes (48 bits, packed) to hash
ranges, which return the document frequency of those that more than one set holds; that fixes one
rare-first order for all documents. Of a set only the shared shingles of its prefix become index rows.
A pair is a candidate where an index row of both passes the length, positional and suffix filters.

Groups of near copies would pair with each other without end, so pairs are made in two rounds: every
index list first joins its members to one hub, the one with the fewest rarer shingles; then only lists
that still touch more than one component pair members of different components. Nothing that could
link two components is left untried, and a list that one component covers is done. That finds the
components, which is all that ``keep_one`` needs.

The whole join (``jaccard_pairs``, ``jaccard_links``) then compares all sets of a component with each other: every
link lies inside one. Components of more than BLOCK sets are cut into blocks and each two blocks meet in a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frondlake.llm.common import Words, batch_count, bounded, column, inside, mix, ngrams, pack, spare, text_bytes, unpack
from frondlake.operators.graph import connected_components
from frondlake.session import durable

BUCKETS = 32
#: sets of one component that a task compares with as many others; shingles that it looks at together
BLOCK, WIDE = 512, 4096
_SEED = 0x9E3779B97F4A7C15
_SENT = pa.schema([("range", pa.int32()), ("batch", pa.int32()), ("keys", pa.binary()), ("n", pa.binary())])
_BACK = pa.schema([("batch", pa.int32()), ("keys", pa.binary()), ("n", pa.binary())])
_SETS = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("batch", pa.int32()), ("n", pa.int64()), ("key", pa.int64()), ("alone", pa.int64()),
                   ("prefix", pa.int32()), ("tokens", pa.list_(pa.int64())), ("spread", pa.list_(pa.int8()))])
_SETS_DDL = "doc_id long, row_key long, batch int, n long, key long, alone long, prefix int, tokens array<long>, spread array<byte>"


class _Sets:
    """Distinct shingles of each text, sorted within the text, and a digest of each set."""

    def __init__(self, t: pa.Table, k: int):
        words = Words(t.column("text"), lower=True)
        whole = np.flatnonzero(inside(words.doc, k))
        hashes, docs = [ngrams(words.hash, k)[whole]] if len(whole) else [], [words.doc[whole]] if len(whole) else []
        for c in range(1, k):  # fewer words than a shingle: the whole sequence is the only one
            few = np.flatnonzero(words.count == c)
            if len(few):
                h = sum(words.hash[words.first[few] + j] * np.uint64(pow(_SEED, j + 1, 1 << 64)) for j in range(c))
                hashes.append(mix(h + np.uint64(c)))
                docs.append(few)
        sh = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        doc = np.concatenate(docs) if docs else np.zeros(0, np.int64)
        order = np.lexsort((sh, doc))
        sh, doc = sh[order], doc[order]
        new = np.ones(len(sh), bool)
        new[1:] = (sh[1:] != sh[:-1]) | (doc[1:] != doc[:-1])
        self.sh, self.doc = sh[new], doc[new]
        self.first = np.searchsorted(self.doc, np.arange(words.n + 1))
        self.n = np.diff(self.first)
        run = np.append(np.uint64(0), np.cumsum(mix(self.sh ^ np.uint64(_SEED)), dtype=np.uint64))
        self.key = mix(run[self.first[1:]] - run[self.first[:-1]] + self.n.astype(np.uint64))
        _, lead = np.unique(self.key, return_index=True)
        self.lead = np.zeros(words.n, bool)
        self.lead[lead] = True
        self.lead &= self.n > 0


def _send(k: int, ranges: int):
    def run(t: pa.Table) -> pa.Table:
        s = _Sets(t, k)
        key, n = np.unique(s.sh[s.lead[s.doc]] >> np.uint64(16), return_counts=True)
        at = ((key >> np.uint64(16)) * np.uint64(ranges)) >> np.uint64(32)
        cuts = np.searchsorted(at, np.arange(ranges + 1, dtype=np.uint64))
        batch = t.column("batch")[0].as_py()
        rows = [(r, batch, pack(key[a:b], True), pack(n[a:b])) for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if a < b]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), _SENT)], schema=_SENT) if rows else _SENT.empty_table()

    return run


def _frequencies(t: pa.Table) -> pa.Table:
    parts = [unpack(b, True) for b in t.column("keys").to_pylist()]
    counts = [unpack(b) for b in t.column("n").to_pylist()]
    key, back = np.unique(np.concatenate(parts), return_inverse=True)
    total = np.zeros(len(key), np.uint64)
    np.add.at(total, back, np.concatenate(counts))
    rows, at = [], 0
    for b, p in zip(t.column("batch").to_pylist(), parts):
        df = total[back[at:at + len(p)]]
        at += len(p)
        shared = df > 1
        if shared.any():
            rows.append((b, pack(p[shared], True), pack(df[shared])))
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), _BACK)], schema=_BACK) if rows else _BACK.empty_table()


def _index(k: int, num: int, den: int):
    def run(docs: pa.Table, back: pa.Table) -> pa.Table:
        s = _Sets(docs, k)
        keys = np.concatenate([np.zeros(0, np.uint64), *(unpack(b, True) for b in back.column("keys").to_pylist())])
        df = np.concatenate([np.zeros(0, np.uint64), *(unpack(b) for b in back.column("n").to_pylist())])
        order = np.argsort(keys)
        keys, df = keys[order], df[order]
        mine = np.flatnonzero(s.lead[s.doc])
        if len(keys):
            key = s.sh[mine] >> np.uint64(16)
            spot = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            shared = keys[spot] == key
            mine, freq = mine[shared], df[spot[shared]]
        else:
            mine, freq = mine[:0], df[:0]
        doc, sh = s.doc[mine], s.sh[mine]
        order = np.lexsort((sh, freq, doc))
        doc, sh = doc[order], sh[order]
        first = np.searchsorted(doc, np.arange(len(s.n) + 1))
        held = np.diff(first)
        alone = s.n - held  # shingles of no other set come first in the order
        prefix = np.clip(s.n - -(-num * s.n // den) + 1 - alone, 0, held)
        spread = np.zeros((len(s.n), BUCKETS), np.int64)
        np.add.at(spread, (doc, (sh % np.uint64(BUCKETS)).astype(np.int64)), 1)
        spread = np.minimum(spread, 127).astype(np.int8)
        use = prefix > 0
        tokens = sh.view(np.int64)
        return pa.table([
            docs.column("doc_id").combine_chunks(), docs.column("row_key").combine_chunks(), docs.column("batch").combine_chunks(), s.n.astype(np.int64), s.key.view(np.int64),
            alone.astype(np.int64), prefix.astype(np.int32),
            pa.array([tokens[first[d]:first[d + 1]] if use[d] else None for d in range(len(s.n))], pa.list_(pa.int64())),
            pa.array([spread[d] if use[d] else None for d in range(len(s.n))], pa.list_(pa.int8()))], schema=_SETS)

    return run


def _filters(num: int, den: int, a: str, b: str) -> Column:
    """Length, positional and suffix filter of two index rows of one shingle. ``spread`` counts the
    shared shingles in BUCKETS parts of the order's universe: sets differ in a part by at least the
    difference of the counts, and shingles of no other set always differ."""
    n = f"({a}.n + {b}.n)"
    need = f"(({num} * {n} + {den + num - 1}) div {den + num})"
    differ = f"aggregate(zip_with({a}.spread, {b}.spread, (x, y) -> abs(cast(x as int) - cast(y as int))), 0, (s, v) -> s + v)"
    return F.expr(f"{num} * greatest({a}.n, {b}.n) <= {den} * least({a}.n, {b}.n)"
                  f" and 1 + least({a}.n - {a}.pos, {b}.n - {b}.pos) - 1 >= {need}"
                  f" and {a}.alone + {b}.alone + {differ} <= {n} - 2 * {need}")


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) of the pairs whose sets are similar enough; pairs carry the batches their sets lie in."""
    def side(x: str) -> DataFrame:
        return sets.select(F.col("key").alias(x), F.col("batch").alias(f"{x}_batch"), F.col("tokens").alias(f"{x}_t"), F.col("n").alias(f"{x}_n"))

    both = pairs.join(side("a"), ["a", "a_batch"]).join(side("b"), ["b", "b_batch"])
    common = "size(array_intersect(a_t, b_t))"
    return both.filter(F.expr(f"{den} * {common} >= {num} * (a_n + b_n - {common})")).select("a", "b")


def _pairs(left: DataFrame, right: DataFrame, on: Column) -> DataFrame:
    first = F.col("l.key") < F.col("r.key")
    pick = lambda c, x, y: F.when(first, F.col(f"{x}.{c}")).otherwise(F.col(f"{y}.{c}"))
    return left.alias("l").join(right.alias("r"), on).select(
        pick("key", "l", "r").alias("a"), pick("batch", "l", "r").alias("a_batch"),
        pick("key", "r", "l").alias("b"), pick("batch", "r", "l").alias("b_batch")).distinct()


def _common(tokens: np.ndarray, owner: np.ndarray, m: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many shingles each left set shares with each right one, of m sets. Shingles that many sets hold
    are counted by matrix products, rare ones by listing their holders."""
    out = np.zeros((len(left), len(right)), np.float64)
    _, code, df = np.unique(tokens, return_inverse=True, return_counts=True)
    many = (df > 1) & (df * 16 >= m)
    place = np.cumsum(many) - 1
    use = many[code]
    at, who = place[code[use]], owner[use]
    order = np.argsort(at, kind="stable")
    at, who = at[order], who[order]
    for lo in range(0, int(many.sum()), WIDE):
        x, y = np.searchsorted(at, (lo, lo + WIDE))
        held = np.zeros((m, WIDE), np.float32)
        held[who[x:y], at[x:y] - lo] = 1
        out += held[left] @ held[right].T
    use = ((df > 1) & ~many)[code]
    at, who = code[use], owner[use]
    order = np.argsort(at, kind="stable")
    at, who = at[order], who[order]
    row, col = np.full(m, -1), np.full(m, -1)
    row[left], col[right] = np.arange(len(left)), np.arange(len(right))
    first, size = np.searchsorted(at, at), df[at]
    done = np.append(0, np.cumsum(size))
    lo = 0
    while lo < len(at):
        hi = max(lo + 1, int(np.searchsorted(done, done[lo] + (1 << 22), "right")) - 1)
        n = size[lo:hi]
        other = who[np.repeat(first[lo:hi] - (done[lo:hi] - done[lo]), n) + np.arange(n.sum())]
        r, c = row[np.repeat(who[lo:hi], n)], col[other]
        ok = (r >= 0) & (c >= 0)
        out += np.bincount(r[ok] * len(right) + c[ok], minlength=out.size).reshape(out.shape)
        lo = hi
    return out.astype(np.int64)


_NEAR = pa.schema([("key", pa.int64()), ("near", pa.int64())])
_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("common", pa.int64())])


def _joined(num: int, den: int, pairs: bool):
    """The links between the sets of two blocks of each component: the pairs, or per set the rows at their other ends."""

    def run(t: pa.Table) -> pa.Table:
        root, key, n, copies, own = (t.column(c).to_numpy() for c in ("root", "key", "n", "copies", "own"))
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        lists = t.column("tokens").combine_chunks()
        lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
        values, cuts = lists.values.to_numpy(), lists.offsets.to_numpy()
        order = np.argsort(root, kind="stable")
        found = []
        for mine in np.split(order, np.flatnonzero(np.diff(root[order])) + 1):
            tokens = np.concatenate([values[cuts[x]:cuts[x + 1]] for x in mine])
            owner = np.repeat(np.arange(len(mine)), cuts[mine + 1] - cuts[mine])
            left, right = np.flatnonzero(own[mine] == i), np.flatnonzero(own[mine] == j)
            if not len(left) or not len(right):
                continue
            common = _common(tokens, owner, len(mine), left, right)
            left, right = mine[left], mine[right]
            close = den * common >= num * (n[left][:, None] + n[right][None, :] - common)
            close &= key[left][:, None] != key[right][None, :]
            if pairs:
                x, y = np.nonzero(close & (key[left][:, None] < key[right][None, :]) if i == j else close)
                a, b = key[left[x]], key[right[y]]
                found.append((np.minimum(a, b), np.maximum(a, b), common[x, y]))
            else:
                found.append((key[left], close @ copies[right]))
                if i != j:
                    found.append((key[right], close.T @ copies[left]))
        kind = _PAIRS if pairs else _NEAR
        return pa.table([pa.array(np.concatenate(c), f.type) for c, f in zip(zip(*found), kind)], schema=kind) if found else kind.empty_table()

    return run


def _links(filled: DataFrame, groups: DataFrame, whole: DataFrame, batches: int, num: int, den: int, pairs: bool) -> DataFrame:
    """All links between different sets, as ``_joined`` gives them."""
    large = durable(whole.groupBy("root").agg(F.count("*").alias("of")).filter(F.col("of") > BLOCK)
                    .select("root", F.ceil(F.col("of") / BLOCK).cast("int").alias("blocks")))
    # the narrow side is made ready first, so that the shingles move once, to their cells
    members = durable(groups.join(whole, "key").join(bounded(large), "root", "left")
                      .select("key", "batch", "root", "copies", F.coalesce("blocks", F.lit(1)).alias("blocks")))
    cut = filled.filter("tokens is not null").select("key", "batch", "n", "tokens").join(bounded(members), ["key", "batch"])
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    dealt = cut.withColumn("own", own).select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        # small components share a task
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("root"), F.lit(batches))).otherwise(F.col("root")).alias("bin"),
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "root", "key", "n", "copies", "own", "tokens")
    made = "a long, b long, common long" if pairs else "key long, near long"
    return dealt.groupBy("bin", "i", "j").applyInArrow(_joined(num, den, pairs), made)


def _components(docs: DataFrame, k: int, num: int, den: int, id_col: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """(rows, one row per set, (set, root) of the sets that link with another, number of batches)."""
    batches = batch_count(text_bytes(docs, text))
    i, t = column(docs, id_col).cast("long"), column(docs, text)
    base = docs.select(i.alias("doc_id"), t.alias("text"), F.xxhash64(i, t).alias("row_key")) \
        .withColumn("batch", F.pmod("row_key", F.lit(batches)).cast("int"))
    by = base.groupBy("batch")
    sent = by.applyInArrow(_send(k, batches), "range int, batch int, keys binary, n binary")
    back = sent.groupBy("range").applyInArrow(_frequencies, "batch int, keys binary, n binary")
    rows = durable(by.cogroup(back.groupBy("batch")).applyInArrow(_index(k, num, den), _SETS_DDL))
    filled = rows.filter("n > 0")
    groups = filled.groupBy("key").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"), F.min(F.when(F.col("tokens").isNotNull(), F.col("batch"))).alias("batch"))
    sets = rows.filter("tokens is not null")
    one = sets.select("key", "batch", "n", "alone", "spread", F.slice("tokens", F.lit(1), "prefix").alias("lead")) \
        .join(groups.select("key", "batch"), ["key", "batch"])
    index = durable(one.select("key", "batch", "n", "alone", "spread", F.posexplode("lead").alias("pos", "token"))
                    .withColumn("pos", F.col("pos") + F.col("alone")))
    row = F.struct("pos", "n", "key", "batch", "alone", "spread")
    hubs = index.groupBy("token").agg(F.min(row).alias("hub"), F.count("*").alias("of")).filter("of > 1").select("token", "hub.*")
    meet = F.col("l.token") == F.col("r.token")
    close = _filters(num, den, "l", "r")
    links = durable(_verified(_pairs(index, hubs, meet & (F.col("l.key") != F.col("r.key")) & close), sets, num, den))
    stars = connected_components(links)
    named = durable(index.join(stars.select(F.col("id").alias("key"), "component"), "key", "left")
                    .withColumn("component", F.coalesce("component", "key")))
    split = named.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("token")
    open_ = named.join(split, "token", "left_semi")
    more = _verified(_pairs(open_, open_, meet & (F.col("l.component") < F.col("r.component")) & close), sets, num, den)
    ends = durable(links.union(more))
    whole = connected_components(ends).select(F.col("id").alias("key"), F.col("component").alias("root"))
    return rows, groups, whole, batches


def jaccard_classes(docs: DataFrame, k: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id", text: str = "text", links: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_key, row_key): one row per row of docs. Two documents link when
    den * |intersection| >= num * |union| of their sets of distinct k-word shingles (A-Z lower-cased,
    words between ASCII white space; fewer than k words: the whole sequence is the one shingle). The
    component is named by its smallest document id.

    Null, empty and blank texts have no shingle and link with nothing, each its own component (of a
    null id: null). Rows of one set are one vertex, so copies never pair. Null ids are members but
    never name a component with other ids. Sets are recognised by a 64-bit digest; class_key is that of one set
    of the component, null without shingles; row_key is a hash of id and text; an empty table gives no rows.
    With ``links`` there is also n_links: how many other rows link with the row, those of equal sets included."""
    rows, groups, whole, batches = _components(docs, k, num, den, id_col, text)
    filled = rows.filter("n > 0")
    named_groups = groups.select("key", "least", "copies").join(whole, "key", "left").withColumn("root", F.coalesce("root", "key"))
    # written, so that the join of a very large component is between two shuffles and can be split
    smallest = durable(named_groups.groupBy("root").agg(F.min("least").alias("component_id")))
    of = named_groups.join(smallest, "root")
    if links:
        near = _links(filled, groups, whole, batches, num, den, False).groupBy("key").agg(F.sum("near").alias("near"))
        of = of.join(near, "key", "left").withColumn("n_links", F.col("copies") - 1 + F.coalesce("near", F.lit(0)))
    more = ["n_links"] if links else []
    linked = filled.join(of.select("key", "component_id", "root", *more), "key") \
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("root").alias("class_key"), "row_key", *more)
    lone = rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("class_key"), "row_key",
                                     *[F.lit(0).cast("long").alias(c) for c in more])
    return linked.union(lone)


def jaccard_links(docs: DataFrame, k: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links), one row per row of docs: ``jaccard_classes`` with the whole join."""
    return jaccard_classes(docs, k, num, den, id_col, text, links=True).select("doc_id", "n_shingles", "component_id", "n_links")


def jaccard_pairs(docs: DataFrame, k: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """((a, b, common), (key, doc_id)): every link between different sets, a < b, with the shingles they share, and the
    rows of each set. Rows of one set all link with each other and are not listed as pairs."""
    rows, groups, whole, batches = _components(docs, k, num, den, id_col, text)
    filled = rows.filter("n > 0")
    return _links(filled, groups, whole, batches, num, den, True), filled.select("key", "doc_id")


def keep_one(docs: DataFrame, k: int, num: int, den: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """docs, all columns unchanged, with one document of each component of ``jaccard_classes``: the one
    of the smallest id (null ids last, ties by a hash of the text). Documents without shingles stay.
    Of rows equal in id and text one stays."""
    (key,) = spare(docs, "row_key")
    classes = durable(jaccard_classes(docs, k, num, den, id_col, text).filter("class_key is not null"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key"))
    lead = classes.groupBy("class_key").agg(first["row_key"].alias("lead"))
    seen = classes.groupBy("class_key", "row_key").agg(F.count("*").alias("n")).join(lead, "class_key")
    gone = durable(seen.filter("row_key <> lead").select(F.col("row_key").alias(key)).distinct())
    keyed = docs.withColumn(key, F.xxhash64(column(docs, id_col).cast("long"), column(docs, text)))
    left = keyed.join(bounded(gone), key, "left_anti")
    again = durable(seen.filter("row_key = lead and n > 1").select(F.col("row_key").alias(key)).distinct())
    if again.isEmpty():
        return left.drop(key)
    again = bounded(again)
    return left.join(again, key, "left_anti").drop(key).unionByName(left.join(again, key, "left_semi").dropDuplicates([key]).drop(key))
