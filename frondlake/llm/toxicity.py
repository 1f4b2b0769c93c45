"""Toxic documents: a learned lexicon trie, Levenshtein automata over it, and context windows."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frondlake.llm.common import Words, column, inside, mix, ngrams, pieces, spare
from frondlake.session import durable

#: letters, digits and non-ASCII bytes make words
_SEPARATORS = bytes(c for c in range(128) if not chr(c).isalnum())
SHORTEST, LONGEST = 4, 8
#: words around a hit that are read for its context
WINDOW = 6
#: fixed values: marks that open or close a quotation
QUOTES = '"“”„‟«»‹›'
#: fixed values: words that report speech or speak about words; words that address somebody
REPORTS = frozenset("said says say wrote writes called calls quote quoted quoting quotes word words term terms insult insults slur slurs "
                    "dit disait mot mots terme citation sagte sagt schrieb wort zitat nannte dijo dice palabra cita llamado".split())
ADDRESS = frozenset("you your yours youre u ur du dich dir dein tu te toi ton vous votre usted tus ti".split())
#: misspelled hits that are evidence of their own kind
MANY = 3
#: kinds of evidence, strongest first, and what is assumed of each before labels are counted
KINDS = ("exact", "near_many", "near", "exact_quoted", "near_quoted", "none")
PRIOR = {"exact": 0.9, "near_many": 0.6, "near": 0.4, "exact_quoted": 0.3, "near_quoted": 0.1, "none": 0.03}


def _plain_marks(data: np.ndarray) -> np.ndarray:
    """General punctuation and Latin-1 signs become blanks, so quotation marks end words."""
    three = np.flatnonzero((data[:-2] == 0xE2) & ((data[1:-1] == 0x80) | (data[1:-1] == 0x81))) if len(data) > 2 else np.zeros(0, int)
    two = np.flatnonzero((data[:-1] == 0xC2) & (data[1:] < 0xC0)) if len(data) > 1 else np.zeros(0, int)
    for off in range(3):
        data[three + off] = 32
    for off in range(2):
        data[two + off] = 32
    return data


def _edits(term: bytes) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Matcher:
    """The product of the lexicon's trie with a Levenshtein automaton of each word's tolerance, as one
    deterministic table: it runs over all words of a batch at once, a byte of each a step, and drops
    the words that can no longer match. Stems match words that begin with them, without edits."""

    def __init__(self, words: list[bytes], stems: list[bytes]):
        letters = sorted({b for t in (*words, *stems) for b in t})
        self.cls = np.full(256, len(letters), np.int32)
        for i, b in enumerate(letters):
            self.cls[b] = i
            if 97 <= b <= 122:
                self.cls[b - 32] = i
        code = {b: i for i, b in enumerate(letters)}
        # trie: (children, accepted here with so many edits allowed or -1, stem ends here); a node's
        # allowance is the widest of the terms below it
        kids, accept, stem = [{}], [-1], [False]
        for t, is_stem in [(w, False) for w in words] + [(s, True) for s in stems]:
            v = 0
            for b in t:
                if code[b] not in kids[v]:
                    kids[v][code[b]] = len(kids)
                    kids.append({})
                    accept.append(-1)
                    stem.append(False)
                v = kids[v][code[b]]
            if is_stem:
                stem[v] = True
            else:
                accept[v] = max(accept[v], _edits(t))
        allow = accept[:]
        for v in range(len(kids) - 1, -1, -1):
            allow[v] = max([allow[v], *(allow[c] for c in kids[v].values()), *(0 for c in kids[v].values())])
            if stem[v]:
                allow[v] = max(allow[v], 0)

        def closed(items: dict[int, int]) -> frozenset:
            """Nodes with the fewest edits spent, letters of the trie skipped at one edit each."""
            todo = list(items.items())
            while todo:
                v, e = todo.pop()
                for c in kids[v].values():
                    if e + 1 <= allow[c] and items.get(c, 99) > e + 1:
                        items[c] = e + 1
                        todo.append((c, e + 1))
            return frozenset(items.items())

        start = closed({0: 0})
        ids, rows, self.verdict = {frozenset(): 0, start: 1, "stem": 2}, [], []
        queue = [frozenset(), start, "stem"]
        n = len(letters) + 1
        for state in queue:
            if state == "stem":
                rows.append([2] * n)
                self.verdict.append(2)
                continue
            spent = [e for v, e in state if 0 <= e <= accept[v]]
            self.verdict.append(0 if not spent else 2 if min(spent) == 0 else 1)
            row = []
            for c in range(n):
                items: dict[int, int] = {}
                to_stem = False
                for v, e in state:
                    if e < allow[v]:
                        items[v] = min(items.get(v, 99), e + 1)  # an extra letter in the text
                    for k, w in kids[v].items():
                        cost = e + (k != c)
                        if cost <= allow[w]:
                            items[w] = min(items.get(w, 99), cost)
                            to_stem |= stem[w] and cost == 0
                nxt = "stem" if to_stem else closed(items)
                if nxt not in ids:
                    ids[nxt] = len(queue)
                    queue.append(nxt)
                row.append(ids[nxt])
            rows.append(row)
        self.table = np.array(rows, np.int32)
        self.verdict = np.array(self.verdict, np.int8)

    def run(self, words: Words) -> np.ndarray:
        """Per word: 0 no match, 1 within its edits, 2 exact or with a stem."""
        out = np.zeros(len(words.starts), np.int8)
        live, state, j = np.arange(len(words.starts)), np.ones(len(words.starts), np.int32), 0
        size = words.ends - words.starts
        while len(live):
            state = self.table[state, self.cls[words.data[words.starts[live] + j]]]
            j += 1
            over = (size[live] == j) | (state == 2)
            out[live[over]] = self.verdict[state[over]]
            go = ~over & (state != 0)
            live, state = live[go], state[go]
        return out


@dataclass
class Model:
    words: list[bytes] = field(default_factory=list)
    stems: list[bytes] = field(default_factory=list)
    rates: dict[str, float] = field(default_factory=lambda: dict(PRIOR))

    def matcher(self) -> Matcher:
        return Matcher(self.words, self.stems)


def _quoted(words: Words, i: int) -> bool:
    """Whether the window around word i quotes it rather than says it."""
    d = words.doc[i]
    lo, hi = max(words.first[d], i - WINDOW), min(words.first[d] + words.count[d], i + WINDOW + 1) - 1
    a, b = words.offsets[d] if lo == words.first[d] else words.starts[lo], words.offsets[d + 1] if hi == words.first[d] + words.count[d] - 1 else words.ends[hi]
    before, after = (words.raw[x:y].tobytes().decode("utf-8", "replace") for x, y in ((a, words.starts[i]), (words.ends[i], b)))
    near = set(re.findall(r"\w+", f"{before} {after}".lower()))
    marks = any(q in before for q in QUOTES) and any(q in after for q in QUOTES)
    return marks + bool(near & REPORTS) - bool(near & ADDRESS) >= 1


def _evidence(texts, matcher: Matcher) -> tuple[list[str], np.ndarray]:
    """The strongest kind of evidence of each text, and its hits of that kind."""
    words = Words(texts, separators=_SEPARATORS, hashes=False, clean=_plain_marks)
    words.raw = _raw(texts)
    verdict = matcher.run(words)
    found = [Counter() for _ in range(words.n)]
    for i in np.flatnonzero(verdict):
        kind = "exact" if verdict[i] == 2 else "near"
        found[words.doc[i]][kind + "_quoted" * _quoted(words, i)] += 1
    for c in found:
        if c["near"] >= MANY:
            c["near_many"] = c["near"]
    kinds = [next((k for k in KINDS if c[k]), "none") for c in found]
    return kinds, np.array([c[k] for c, k in zip(found, kinds)])


def _raw(texts) -> np.ndarray:
    return Words(texts, separators=b"", hashes=False).data


def _score(kind: str, hits: int, rates: dict[str, float]) -> float:
    """The kind's rate, moved by more hits of it towards its side of one half and never across."""
    r, more = rates[kind], 1 - 0.5 ** max(0, hits - 1)
    return r + (1 - r) * more / 2 if r >= 0.5 else r + (0.5 - r) * more / 4


def _terms(text: str) -> set[str]:
    """Words (closed by a blank) and their beginnings."""
    out = set()
    for w in set(re.findall(r"[^\W_]+", text.lower())):
        out.add(w + " ")
        out.update(w[:n] for n in range(SHORTEST, min(LONGEST, len(w)) + 1))
    return out


def _count_terms(wanted: frozenset | None):
    def run(batches):
        for part in (p for b in batches for p in pieces(b, 0, 256 << 10)):  # a count of many texts is large
            count: Counter = Counter()
            for t in part.column(0).to_pylist():
                terms = _terms(t)
                count.update(terms if wanted is None else terms & wanted)
            yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], ["term", "n"])

    return run


def _sketch(batches):
    """Four minimum hashes of three-word shingles: near copies share one of them."""
    for b in batches:
        for part in pieces(b, 1):
            w = Words(part.column(1), lower=True)
            grams, ok = ngrams(w.hash, 3), inside(w.doc, 3)
            doc, grams = w.doc[:len(ok)][ok], grams[ok]
            lows = []
            for j in range(4):
                low = np.full(w.n, np.iinfo(np.uint64).max, np.uint64)
                np.minimum.at(low, doc, mix(grams + np.uint64(j * 7919 + 1)))
                none = low == np.iinfo(np.uint64).max  # too few words: a value of its own
                low[none] = mix(part.column(0).to_numpy(zero_copy_only=False).view(np.uint64)[none] + np.uint64(j))
                lows.append(low.view(np.int64))
            yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, lows)], ["key", "m0", "m1", "m2", "m3"])


def choose_terms(pos: dict[str, int], neg: dict[str, int], support: int, precise: float) -> tuple[list[str], list[str]]:
    """(words, stems) by descent in the trie of beginnings: the first beginning that is precise enough
    is taken, drawn out as long as it loses nearly no document; it is a word where one word alone
    accounts for it. A beginning that is not precise is left for its longer ones."""
    kids: dict[str, list[str]] = {}
    for t in pos:
        up = t[:-1] if len(t) > SHORTEST or t.endswith(" ") else ""
        if t.endswith(" ") and not SHORTEST <= len(up) <= LONGEST:
            up = up[:LONGEST] if len(up) > LONGEST else ""
        kids.setdefault(up, []).append(t)
    words, stems, todo = [], [], sorted(kids.get("", []))
    while todo:
        t = todo.pop()
        if pos[t] < support:
            continue
        if pos[t] < precise * (pos[t] + neg.get(t, 0)):
            todo += kids.get(t, [])
            continue
        while not t.endswith(" "):
            longer = max(kids.get(t, []), key=lambda k: (pos[k], k.endswith(" "), k), default=None)
            if longer is None or pos[longer] < 0.98 * pos[t]:
                break
            t = longer
        (words if t.endswith(" ") else stems).append(t.rstrip(" "))
    return sorted(words), sorted(stems)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = 20_000, precise: float = 0.9, share: float = 0.01,
        id_col: str = "doc_id", text: str = "text", seed: int = 5) -> Model:
    """Learn the lexicon and the rates of the kinds of evidence from labelled documents.

    ``rows`` bounds the sample (drawn by a hash of the id, so about that many). Rows whose
    crc32(id) mod 5 is 0 are never learned from. Of near copies one is kept, so that the words of one
    copied document do not pass for toxic. A term must occur in ``share`` of the toxic documents (6 at
    least), and ``precise`` of the documents that hold it must be toxic. Without labels the model has
    no terms and the prior rates."""
    i = column(labels, id_col).cast("long")
    known = labels.select(i.alias("__i"), column(labels, label).alias("__y")).filter("__i is not null and __y is not null") \
        .filter(F.pmod(F.crc32(F.col("__i").cast("string").cast("binary")), F.lit(5)) != 0).groupBy("__i").agg(F.max("__y").alias("y"))
    n = known.count()
    cut = min(1.0, rows / max(n, 1))
    some = known.filter(F.pmod(F.xxhash64(F.lit(seed), "__i"), F.lit(1 << 30)) < int(cut * (1 << 30)))
    t = column(docs, text)
    train = durable(docs.select(column(docs, id_col).cast("long").alias("__i"), t.alias("text")).filter(F.length("text") > 0)
                    .join(F.broadcast(some), "__i").select(F.xxhash64("__i", "text").alias("key"), "text", "y"))
    sketch = durable(train.select("key", "text").mapInArrow(_sketch, "key long, m0 long, m1 long, m2 long, m3 long").distinct())
    low = sketch.select("key", F.posexplode(F.array("m0", "m1", "m2", "m3")).alias("j", "m"))
    later = low.join(low.groupBy("j", "m").agg(F.min("key").alias("lead")), ["j", "m"]).filter("key > lead").select("key").distinct()
    train = durable(train.dropDuplicates(["key"]).join(later, "key", "left_anti"))
    toxic, clean = train.filter("y = 1"), train.filter("y <> 1")
    support = max(6, int(share * toxic.count()))
    counts = lambda df, wanted: {r["term"]: r["n"] for r in df.select("text").mapInArrow(_count_terms(wanted), "term string, n long")
                                 .groupBy("term").agg(F.sum("n").alias("n")).filter(F.col("n") >= (support if wanted is None else 1)).collect()}
    pos = counts(toxic, None)
    neg = counts(clean, frozenset(pos)) if pos else {}
    words, stems = choose_terms(pos, neg, support, precise)
    model = Model([w.encode() for w in words], [s.encode() for s in stems])
    matcher = model.matcher()

    def kinds(batches):
        for b in batches:
            for part in pieces(b, 0):
                yield pa.RecordBatch.from_arrays([pa.array(_evidence(part.column(0), matcher)[0], pa.string()), part.column(1).cast(pa.int32())], ["kind", "y"])

    seen = {r["kind"]: (r["n"], r["p"]) for r in train.select("text", F.col("y").cast("int").alias("y")).mapInArrow(kinds, "kind string, y int")
            .groupBy("kind").agg(F.count("*").alias("n"), F.sum("y").alias("p")).collect()}
    for kind in KINDS:
        total, yes = seen.get(kind, (0, 0))
        model.rates[kind] = (yes + 2 * PRIOR[kind]) / (total + 2)
    return model


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, evidence, hits), one row per row: one pass, no shuffle. Null and empty texts
    have no evidence and score like any text without a hit; ids are carried, never used."""
    matcher, rates = model.matcher(), model.rates

    def run(batches):
        for b in batches:
            for part in pieces(b, 1):
                kinds, hits = _evidence(part.column(1), matcher)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([_score(k, h, rates) for k, h in zip(kinds, hits)], pa.float64()), pa.array(kinds, pa.string()),
                     pa.array(hits, pa.int64())], ["doc_id", "score", "evidence", "hits"])

    return docs.select(column(docs, id_col).cast("long").alias("doc_id"), column(docs, text).alias("text")) \
        .mapInArrow(run, "doc_id long, score double, evidence string, hits long")


def keep_clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of docs, all columns unchanged, that score under one half."""
    matcher, rates = model.matcher(), model.rates
    (extra,) = spare(docs, "__t")

    def run(batches):
        for b in batches:
            for part in pieces(b, b.num_columns - 1):
                kinds, hits = _evidence(part.column(part.num_columns - 1), matcher)
                good = pa.array([_score(k, h, rates) < 0.5 for k, h in zip(kinds, hits)], pa.bool_())
                yield part.select(range(part.num_columns - 1)).filter(good)

    return docs.select("*", column(docs, text).alias(extra)).mapInArrow(run, docs.schema)


def toxic_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence, hits) of every document."""
    return scored(docs, fit(docs, labels)).select(
        "doc_id", (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence", "hits")
