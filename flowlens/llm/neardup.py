"""Near-duplicate documents by DartMinHash, banding, and exact checks.

A document is the weighted set of its runs of five words, weighted by their number. Darts are
thrown at the plane of weight and rank: the weight axis of each element is cut into dyadic
regions, and hashed exponential gaps give the ranks of the darts in a region in ascending
order, the same in every document that holds the element. A dart counts if its weight
coordinate is below the element's weight in this document. Each dart hits one of ``COORDINATES``,
and every coordinate keeps its earliest dart; documents whose plane was too small to fill them
all throw on, with a plane twice as long. A document of n elements needs about n + k ln k darts.

Two documents agree in a coordinate with the probability of their weighted Jaccard similarity.
Bands of coordinates give candidates, which are checked exactly (similarity >= 0.8). To lose no
link and list no group's pairs, documents are first merged by equal weighted sets; a bucket
compares its members to one pivot; and pairs inside a class already found need no check. What
then remains open (buckets that span classes) is compared in bounded blocks until nothing is.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import mapped, staged, texts_of

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 32, 8
COORDINATES = BANDS * ROWS
#: Darts expected in the first plane: k ln k + 2k.
DARTS = COORDINATES * (np.log(COORDINATES) + 2)
#: Members of an open bucket that meet its others at once, and the others that one task holds.
BLOCK, PART = 128, 256
MAX_WORDS = 100_000
TEXTS_KEPT = 64

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)


def stepped(n: int) -> np.uint64:
    return _U(n * int(_STEP) % (1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """The SplitMix64 finaliser: 64 well mixed bits from 64 (its constants are fixed)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """(0, 1) from the upper 53 bits."""
    return ((x >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53


class Words:
    """Hashes of words, remembered up to a bound."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, words: list[str]) -> list[int]:
        if len(self.known) > MAX_WORDS:
            self.known.clear()
        known = self.known
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        return [known[w] for w in words]


def shingles(texts: list[str], words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle, weight) of every distinct shingle, ordered by text.

    Words are lower case, cut at white space; a text of one to four words has one shingle, of
    all its words, and a text without words has none.
    """
    parts = [words(t.lower().split()) for t in texts]
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    flat = np.fromiter((h for p in parts for h in p), dtype=np.uint64, count=int(sizes.sum()))
    powers = np.array([mixed(np.array([i + 1], dtype=np.uint64) * _STEP)[0] | _U(1)
                       for i in range(WORDS)])
    start = np.cumsum(sizes) - sizes
    runs = np.where(sizes >= WORDS, sizes - WORDS + 1, (sizes > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(texts)), runs)
    at = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs) + start[doc]
    total = np.zeros(len(at), dtype=np.uint64)
    for i in range(WORDS):
        inside = i < sizes[doc]
        total += np.where(inside, flat[np.minimum(at + i, max(len(flat) - 1, 0))]
                          if len(flat) else _U(0), _U(0)) * powers[i]
    total = mixed(total + np.minimum(sizes[doc], WORDS).astype(np.uint64))
    order = np.lexsort((total, doc))
    doc, total = doc[order], total[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (total[1:] != total[:-1])
    first = np.flatnonzero(new)
    return doc[first], total[first], np.diff(np.append(first, len(doc))).astype(np.float64)


def throw(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int,
          k: int = COORDINATES) -> np.ndarray:
    """Signatures (documents by coordinates) of weighted sets; zero rows for empty ones."""
    out = np.zeros((n_docs, k), dtype=np.uint64)
    mass = np.bincount(doc, weight, n_docs)
    reach = np.divide(k * (np.log(k) + 2), mass, out=np.zeros(n_docs), where=mass > 0)
    todo = np.flatnonzero(mass > 0)
    while len(todo):
        chosen = np.isin(doc, todo)
        place = np.full(n_docs, -1)
        place[todo] = np.arange(len(todo))
        d, s, c = place[doc[chosen]], element[chosen], weight[chosen]
        signature, least = _plane(d, s, c, reach[todo], len(todo), k)
        full = np.isfinite(least).all(1)
        out[todo[full]] = signature[full]
        todo = todo[~full]
        reach[todo] *= 2
    return out


def _plane(doc, element, weight, reach, n_docs, k):
    """The earliest dart of every coordinate with a rank below ``reach``."""
    least = np.full(n_docs * k, np.inf)
    signature = np.zeros(n_docs * k, dtype=np.uint64)
    region, low = 0, 0.0
    while True:
        inside = weight > low
        if not inside.any():
            break
        width = 1.0 if region == 0 else low
        d, c = doc[inside], weight[inside]
        base = mixed(element[inside] + stepped(region))
        rank, far = np.zeros(len(d)), reach[d]
        dart = 0
        while len(d):
            dart += 1
            h = mixed(base + stepped(dart))
            rank = rank - np.log(uniform(h)) / width
            near = rank <= far
            d, c, base, rank, far, h = d[near], c[near], base[near], rank[near], far[near], h[near]
            second = mixed(h ^ _STEP)
            hit = np.ones(len(d), bool) if not len(d) else (low + width * uniform(second) < c)
            where = d[hit] * k + (second[hit] & _U(0x7FF)).astype(np.int64) % k
            np.minimum.at(least, where, rank[hit])
            won = least[where] == rank[hit]
            signature[where[won]] = h[hit][won]
        low = low + width
        region += 1
    return signature.reshape(n_docs, k), least.reshape(n_docs, k)


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, a, b, weight, bands``: a digest of the weighted set, its weight and band keys.

    Rows with a null id and texts without a word are left out; null text counts as empty.
    """
    memory: list[Words] = []

    def run(batch):
        if not memory:
            memory.append(Words())
        texts = texts_of(batch.column(1))
        doc, element, weight = shingles(texts, memory[0])
        n = len(texts)
        signature = throw(doc, element, weight, n)
        mass = np.bincount(doc, weight, n)
        digest = np.zeros((2, n), dtype=np.uint64)
        for i in range(2):
            part = mixed(element + stepped(i + 1)) * weight.astype(np.uint64)
            np.add.at(digest[i], doc, part)
        keys = np.zeros((n, BANDS), dtype=np.uint64)
        by_band = signature.reshape(n, BANDS, ROWS)
        for r in range(ROWS):
            keys = mixed(keys * _U(31) + by_band[:, :, r] + _STEP)
        keys = mixed(keys + np.arange(BANDS, dtype=np.uint64) * _STEP).view(np.int64)
        return {"doc_id": batch.column(0), "a": digest[0].view(np.int64),
                "b": digest[1].view(np.int64), "weight": mass, "bands": list(keys)}

    rows = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    return mapped(rows, "doc_id long, a long, b long, weight double, bands array<long>",
                  run).where(F.col("weight") > 0)


def similarity(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two sorted weighted sets."""
    _, i, j = np.intersect1d(left[0], right[0], assume_unique=True, return_indices=True)
    common = np.minimum(left[1][i], right[1][j]).sum()
    return float(common / (left[1].sum() + right[1].sum() - common))


def checked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (``lo``, ``hi``) whose exact similarity reaches the bound.

    ``texts`` is read twice and should be a written table. Both joins are plain, so a document
    that meets very many others is split by the skew handling of the join.
    """
    t = texts.select(F.col("doc_id").alias("lo"), F.col("text").alias("lo_text"))
    u = texts.select(F.col("doc_id").alias("hi"), F.col("text").alias("hi_text"))
    rows = pairs.select("lo", "hi").join(u, "hi").join(t, "lo")

    def run(batches):
        words, known = Words(), {}

        def of(key, text):
            if key not in known:
                if len(known) >= TEXTS_KEPT:
                    known.pop(next(iter(known)))
                known[key] = shingles([text or ""], words)[1:]
            return known[key]

        for batch in batches:
            good = [similarity(of(a, s), of(b, t)) >= SIMILARITY
                    for a, s, b, t in zip(batch.lo, batch.lo_text, batch.hi, batch.hi_text)]
            yield batch.loc[np.array(good, dtype=bool), ["lo", "hi"]]

    return rows.mapInPandas(run, "lo long, hi long")


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: the least node of each connected part, for all nodes on ``edges`` (lo, hi).

    Large-star and small-star rounds; every round is written to the shared folder.
    """
    def told(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()

    now = staged(edges.select("lo", "hi").distinct(), "edges")
    before = told(now)
    while before[0]:
        both = now.union(now.select("hi", "lo")).toDF("u", "v")
        # large star: larger neighbours move to the least one
        least = staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = (both.join(least, "u").where(F.col("v") > F.col("u")).select("v", "m")
                 .where(F.col("v") != F.col("m")))
        large = staged(large.distinct().toDF("v", "u"), "large")  # u below v
        # small star: a node and its smaller neighbours move to the least of them
        low = staged(large.groupBy("v").agg(F.min("u").alias("m")), "low")
        small = large.join(low, "v").select(F.col("u").alias("x"), "m").union(
            low.select("v", "m")).where(F.col("x") != F.col("m"))
        now = staged(small.distinct().select(F.col("m").alias("lo"), F.col("x").alias("hi")),
                     "edges")
        after = told(now)
        if after == before:
            break
        before = after
    ends = now.select(F.col("hi").alias("node"), F.col("lo").alias("label"))
    return ends.union(now.select("lo", "lo").distinct())


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after ``links`` (lo, hi) join classes: only the graph of classes is walked."""
    ends = _labelled(_labelled(links, labels, "lo", "x"), labels, "hi", "y")
    between = ends.select(F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi"))
    between = staged(between.where(F.col("lo") != F.col("hi")).distinct(), "between")
    if between.isEmpty():
        return labels
    parts = staged(components(between), "parts")
    moved = _labelled(labels, parts, "label", "to").select("node", F.col("to").alias("label"))
    alone = parts.join(labels.select("node"), "node", "left_anti").select("node", "label")
    return staged(moved.union(alone), "labels")


def _labelled(df: DataFrame, labels: DataFrame, column: str, out: str) -> DataFrame:
    """Add the class of ``column``; a node on no edge is a class of its own."""
    named = labels.select(F.col("node").alias(column), F.col("label").alias(out))
    return df.join(named, column, "left").withColumn(out, F.coalesce(out, column))


def fitting(x: str, y: str) -> Column:
    """Whether two weights allow the similarity: it is at most their ratio."""
    return F.least(x, y) / F.greatest(x, y) >= SIMILARITY - 1e-9


def link(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Membership (``doc_id, node``) and classes of nodes (``node, label``).

    A node stands for all documents of one weighted set; its id is their least ``doc_id``.
    """
    made = staged(sketches(docs), "sketches")
    nodes = staged(made.groupBy("a", "b").agg(
        F.min(F.struct("doc_id", "weight", "bands")).alias("m")).select(
        "a", "b", F.col("m.doc_id").alias("node"), "m.weight", "m.bands"), "nodes")
    member = made.select("doc_id", "a", "b").join(nodes.select("a", "b", "node"), ["a", "b"])
    member = staged(member.groupBy("doc_id").agg(F.min("node").alias("node")), "members")

    # the members of buckets, and how many others each meets over all its buckets
    entries = nodes.select("node", "weight", F.explode("bands").alias("band"))
    shared = staged(entries.groupBy("band").agg(F.count("*").alias("n")).where(F.col("n") > 1),
                    "shared")
    met = staged(entries.join(shared, "band"), "met")
    centre = staged(met.groupBy("node").agg(F.sum("n").alias("centre")), "centre")
    met = staged(met.join(centre, "node").select("band", "node", "weight", "centre"), "met")
    # the pivot is the member that meets most: of copies with edits, most often the text they share
    pivots = staged(met.groupBy("band").agg(F.max(F.struct(
        "centre", (-F.col("node")).alias("m"), "weight")).alias("p")).select(
        "band", (-F.col("p.m")).alias("pivot"), F.col("p.weight").alias("pivot_weight")), "pivots")
    buckets = staged(met.join(pivots, "band").where(F.col("node") != F.col("pivot")), "buckets")
    pairs = staged(buckets.where(fitting("weight", "pivot_weight")).groupBy("pivot", "node").agg(
        F.count("*").alias("n")), "pairs")
    texts = staged(docs.select("doc_id", "text").join(centre.select(F.col("node").alias("doc_id")),
                                                      "doc_id", "left_semi"), "texts")

    # each node with the pivot it meets most, then only pairs between classes
    best = pairs.groupBy("node").agg(F.max(F.struct("n", (-F.col("pivot")).alias("m"))).alias("b"))
    best = staged(best.select((-F.col("b.m")).alias("pivot"), "node"), "best")
    links = checked(best.select(F.least("pivot", "node").alias("lo"),
                                F.greatest("pivot", "node").alias("hi")), texts)
    labels = staged(components(links), "labels")
    rest = pairs.select("pivot", "node").join(best, ["pivot", "node"], "left_anti")
    rest = _labelled(_labelled(rest, labels, "pivot", "x"), labels, "node", "y")
    rest = staged(rest.where(F.col("x") != F.col("y")).select(
        F.least("pivot", "node").alias("lo"), F.greatest("pivot", "node").alias("hi")).distinct(),
        "rest")
    labels = merged(labels, checked(rest, texts))
    return member, _closed(buckets.select("band", "node", "weight"), labels, texts)


def _closed(members: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    """Compare what is left of buckets that span classes, until no open pair is left.

    ``members`` have met the pivot of their bucket. In each round, of an open bucket, up to
    ``BLOCK`` members outside its largest class meet all its members of other classes, and
    leave. The members are split into parts, to each of which the heads are copied; a part
    gives at most one link for each head and class, so no pairs are listed.
    """
    def told():  # columns of their own for each use
        return texts.select(F.col("doc_id").alias("node"), F.col("text").alias("text"))

    while True:
        named = _labelled(members, labels, "node", "label")
        spans = named.groupBy("band").agg(F.min("label").alias("l0"), F.max("label").alias("l1"),
                                          F.count("*").alias("n"))
        spans = staged(spans.where(F.col("l0") != F.col("l1")).select(
            "band", F.expr(f"CAST((n - 1) div {PART} + 1 AS int)").alias("parts")), "spans")
        members = staged(named.join(spans, "band"), "open")
        if members.isEmpty():
            return labels
        largest = members.groupBy("band", "label").agg(F.count("*").alias("n")).groupBy("band").agg(
            F.max(F.struct("n", "label")).alias("t")).select("band", F.col("t.label").alias("most"))
        rank = F.row_number().over(Window.partitionBy("band").orderBy("node"))
        heads = members.join(staged(largest, "largest"), "band").where(
            F.col("label") != F.col("most")).withColumn("r", rank).where(F.col("r") <= BLOCK)
        heads = staged(heads.select("band", "node", "weight", "label", "parts"), "heads")
        rows = members.join(told(), "node").select(
            "band", F.pmod(F.xxhash64("node"), "parts").cast("int").alias("part"),
            "node", "weight", "label", "text")
        copies = heads.join(told(), "node").select(
            "band", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
            "node", "weight", "label", "text")
        links = rows.groupBy("band", "part").cogroup(copies.groupBy("band", "part")).applyInPandas(
            _meet, "lo long, hi long")
        labels = merged(labels, staged(links.distinct(), "links"))
        members = members.join(heads.select("band", "node"), ["band", "node"], "left_anti").select(
            "band", "node", "weight")


def _meet(rows: pd.DataFrame, heads: pd.DataFrame) -> pd.DataFrame:
    """Links of the heads to members of other classes: the first found for each class."""
    words, out = Words(), []

    def parsed(df):
        return [(n, w, c, shingles([t or ""], words)[1:])
                for n, w, c, t in zip(df.node, df.weight, df.label, df.text)]

    members = parsed(rows) if len(heads) else []
    for node, weight, label, own in parsed(heads):
        linked = {label}
        for other, mass, cls, theirs in members:
            if cls not in linked and min(weight, mass) >= (SIMILARITY - 1e-9) * max(weight, mass) \
                    and similarity(own, theirs) >= SIMILARITY:
                linked.add(cls)
                out.append((min(node, other), max(node, other)))
    return pd.DataFrame(out, columns=["lo", "hi"], dtype="int64")


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, kept``: a row for each row of ``docs``.

    ``class_id`` is the least id of the class. Rows that share an id are one document. Null ids
    and texts without a word take no part: their class is their own id. Other columns are left
    out; no rows give none.
    """
    member, labels = link(docs)
    named = staged(_labelled(member, labels, "node", "class_id").select("doc_id", "class_id"),
                   "classes")
    rows = docs.select("doc_id").join(named, "doc_id", "left")
    return rows.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id")).withColumn(
        "kept", F.col("class_id").eqNullSafe(F.col("doc_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class, the one of the least id; columns as they are.

    Of rows that share an id one stays; rows with a null id all stay.
    """
    member, labels = link(docs)
    gone = _labelled(member, labels, "node", "class_id").where(
        F.col("class_id") != F.col("doc_id")).select("doc_id")
    gone = staged(gone, "gone")
    known = docs.where(F.col("doc_id").isNotNull()).join(gone, "doc_id", "left_anti")
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text")))
    known = known.withColumn("_nth", nth).where(F.col("_nth") == 1).select(docs.columns)
    return known.union(docs.where(F.col("doc_id").isNull()))
