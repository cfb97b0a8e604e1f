"""Nearest neighbours by balanced posting lists, checked by bounds.

Centroids are fitted to a bounded sample, with a price on crowded ones so that lists come out
even. Every row goes to its nearest centroid, and a row near a border also to other centroids
that are hardly farther.
A query is answered in two rounds. The first finds centroids by a beam search over a neighbour
graph held in memory, whose size is bounded by ``MAX_LISTS``, and reads the lists of the nearest
ones. The score of rank ``k`` there is a floor for the true one, so the second round reads every
other list whose rows could reach it, by the list's greatest distance, angle and length. Nothing
depends on how well lists or beam fit the table but the share of it that is read. Short lists
share a group, long ones and large groups of queries are split, so a very common vector is spread
over many tasks.

Largest inner product becomes least distance by one more component that gives every row
the same length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import staged

#: Sampled rows for fitting, rows wished in a list, and the bounds of the number of lists.
SAMPLE, LIST_ROWS, MAX_LISTS = 16_384, 200, 2_048
ROUNDS, PRICE = 12, 0.15
#: Copies of a row at most, and how much farther than the nearest a copy's centroid may be.
COPIES, COPY_RATIO = 4, 1.005
#: Rows the first round reads at least, and the width of its beam.
READ_ROWS, WIDTH = 400, 64
#: Neighbours in the graph, and rows and queries that meet in one group.
DEGREE, GROUP_ROWS, GROUP_QUERIES = 16, 8_192, 4_096
NEAREST = 20
#: Rows whose distances to all centroids are held at a time, and scores held at a time.
BLOCK_ROWS, BLOCK_SCORES = 1_024, 1 << 18
#: Slack of the bounds for rounding, as a share of the lengths, and of an angle.
SLACK, ANGLE_SLACK = 1e-9, 1e-7


@dataclass
class Index:
    """Centroids with one added component, their graph, and where a search starts."""

    centroids: np.ndarray | None = None
    graph: np.ndarray | None = None
    entries: np.ndarray | None = None
    longest: float = 0.0

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest - (x * x).sum(1), 0))
        return np.hstack([x, rest[:, None]])

    def search(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and squared distances of about the ``width`` nearest centroids, nearest first."""
        n, c = len(x), self.centroids
        width = min(width, len(c))
        square = (c * c).sum(1)
        own = (x * x).sum(1)[:, None]

        def distance(ids):
            return own + square[ids] - 2 * np.einsum("nd,nkd->nk", x, c[ids])

        d0 = own + square[self.entries] - 2 * x @ c[self.entries].T
        first = np.argsort(d0, axis=1)[:, :width]
        ids, dist = self.entries[first], np.take_along_axis(d0, first, 1)
        if ids.shape[1] < width:
            pad = width - ids.shape[1]
            ids = np.pad(ids, ((0, 0), (0, pad)), constant_values=-1)
            dist = np.pad(dist, ((0, 0), (0, pad)), constant_values=np.inf)
        done = ids < 0
        rows = np.arange(n)
        while not done.all():
            open_ = np.where(done, np.inf, dist)
            pick = open_.argmin(1)
            live = np.isfinite(open_[rows, pick])
            done[rows, pick] = True
            near = self.graph[np.maximum(ids[rows, pick], 0)]
            known = (near[:, :, None] == ids[:, None, :]).any(2) | ~live[:, None]
            far = np.where(known, np.inf, distance(near))
            ids, dist = np.hstack([ids, np.where(known, -1, near)]), np.hstack([dist, far])
            done = np.hstack([done, known])
            order = np.argsort(dist, axis=1, kind="stable")[:, :width]
            ids, dist, done = (np.take_along_axis(a, order, 1) for a in (ids, dist, done))
            done |= ids < 0
        return ids, np.maximum(dist, 0)

    def homes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs: the nearest list first, then for a row near a border the others there."""
        rows, lists = [np.zeros(0, int)], [np.zeros(0, int)]
        for at, d in distances(self.lifted(x), self.centroids):
            ids = np.argpartition(d, min(COPIES, d.shape[1]) - 1, axis=1)[:, :COPIES]
            dist = np.take_along_axis(d, ids, 1)
            order = np.argsort(dist, axis=1, kind="stable")
            ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
            good = dist <= COPY_RATIO ** 2 * dist[:, :1] + 1e-12
            good[:, 0] = True
            rows.append(at + np.nonzero(good)[0])
            lists.append(ids[good])
        return np.concatenate(rows), np.concatenate(lists)

    def spreads(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distance and angle of rows to the centroids of their lists, and the rows' lengths."""
        c = self.centroids[lists, :-1]
        length, long = np.sqrt((x * x).sum(1)), np.sqrt((c * c).sum(1))
        cosine = (x * c).sum(1) / np.maximum(length * long, 1e-300)
        angle = np.where(long > 0, np.arccos(np.clip(cosine, -1, 1)), np.pi)
        return np.sqrt(((x - c) ** 2).sum(1)), angle, length

    def probe(self, q: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        """For each query the nearest lists found, as many as hold enough rows."""
        ids, _ = self.search(np.hstack([q, np.zeros((len(q), 1))]), WIDTH)
        found = np.where(ids >= 0, sizes[np.maximum(ids, 0)], 0)
        before = np.cumsum(found, axis=1) - found
        return [i[g] for i, g in zip(ids, (found > 0) & (before < READ_ROWS))]

    def reachable(self, q: np.ndarray, floor: np.ndarray, bounds: Bounds) -> np.ndarray:
        """Which lists (columns) could hold a row whose product with a query reaches its floor.

        A product is at most that with the centroid plus the query's length times the greatest
        distance, and at most both lengths times the cosine of the least angle.
        """
        c = self.centroids[:, :-1]
        mine, long = np.sqrt((q * q).sum(1))[:, None], np.sqrt((c * c).sum(1))
        product = q @ c.T
        ball = product + mine * bounds.distance
        cosine = product / np.maximum(mine * long, 1e-300)
        angle = np.where(long > 0, np.arccos(np.clip(cosine, -1, 1)), 0) - bounds.angle - ANGLE_SLACK
        cone = np.maximum(np.cos(np.clip(angle, 0, np.pi)), 0) * mine * bounds.length
        most = np.minimum(ball, cone) + SLACK * mine * np.maximum(bounds.length, long)
        return (most >= floor[:, None]) & bounds.used


@dataclass
class Bounds:
    """For each list the greatest distance and angle to its centroid and the greatest length.

    Only of the rows whose nearest list it is; ``used`` tells whether there are any.
    """

    distance: np.ndarray
    angle: np.ndarray
    length: np.ndarray
    used: np.ndarray


def distances(x: np.ndarray, c: np.ndarray):
    """Squared distances to all centroids, for some rows at a time, with the first one's number."""
    square = (c * c).sum(1)
    for at in range(0, len(x), BLOCK_ROWS):
        part = x[at:at + BLOCK_ROWS]
        yield at, np.maximum((part * part).sum(1)[:, None] + square - 2 * part @ c.T, 0)


def fit(sample: np.ndarray, lists: int, longest: float, seed: int = 5) -> Index:
    """Balanced centroids of a sample, ``lists`` at most: crowded ones cost more, so border rows move on."""
    x = Index(longest=longest).lifted(sample)
    rng = np.random.default_rng(seed)
    kinds = np.unique(x, axis=0)  # copies make no lists of their own
    lists = min(lists, len(kinds))
    c = kinds[rng.choice(len(kinds), lists, replace=False)]
    price, wished = np.zeros(lists), len(x) / lists
    for _ in range(ROUNDS):
        own, least = np.zeros(len(x), int), np.zeros(len(x))
        for at, d in distances(x, c):
            some = (d + price).argmin(1)
            own[at:at + len(d)], least[at:at + len(d)] = some, d[np.arange(len(d)), some]
        count = np.bincount(own, minlength=lists)
        scale = float(least.mean())
        price += PRICE * scale * (np.minimum(count / wished, 4) - 1) / 2
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None],
                     kinds[rng.choice(len(kinds), lists)])
    gaps = (c * c).sum(1)[:, None] + (c * c).sum(1) - 2 * c @ c.T
    np.fill_diagonal(gaps, np.inf)
    near = np.argsort(gaps, axis=1)[:, :min(DEGREE, lists - 1)]
    ring = np.roll(np.arange(lists), 1)[:, None]  # keeps the graph in one piece
    ring = np.where((near == ring).any(1, keepdims=True), np.arange(lists)[:, None], ring)
    graph = np.hstack([near, ring]) if lists > 1 else np.zeros((1, 1), int)
    entries = rng.choice(lists, min(lists, max(512, lists // 4)), replace=False)
    return Index(c, graph, entries, longest)


def grouped(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First group and number of groups of each list: small lists share one, large ones are split."""
    first, blocks = np.zeros(len(sizes), dtype=int), np.maximum(1, -(-sizes // GROUP_ROWS))
    group, rows = 0, 0
    for i, n in enumerate(sizes):
        if blocks[i] > 1 or rows + n > GROUP_ROWS:
            group, rows = group + (rows > 0), 0
        first[i] = group
        if blocks[i] > 1:
            group += blocks[i]
        else:
            rows += n
    return first, blocks


def usable(vectors: DataFrame) -> tuple[DataFrame, float, int]:
    """Rows that take part, the greatest squared length, and their number.

    Left out are vectors that are null, zero, hold a null or non-finite component, or do not
    have the most frequent dimension.
    """
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    square = F.aggregate(x, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    rows = vectors.select("vec_id", "embedding").where(
        x.isNotNull() & F.col("vec_id").isNotNull()).where(~bad).where(square > 0)
    kinds = rows.groupBy(F.size(x).alias("d")).agg(
        F.count("*").alias("n"), F.max(square).alias("top")).collect()
    if not kinds:
        return rows, 0.0, 0
    best = max(kinds, key=lambda r: (r["n"], r["d"]))
    return rows.where(F.size(x) == best["d"]), best["top"], best["n"]


def _matrix(column) -> np.ndarray:
    return np.array(column.to_list(), dtype=np.float64)


def few_copies(ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of rows with equal vectors the ``k + 1`` smallest ids: no query can have more of them."""
    _, kind = np.unique(np.ascontiguousarray(x).view(f"V{x.itemsize * x.shape[1]}").ravel(),
                        return_inverse=True)
    rows = pd.DataFrame({"kind": kind, "id": ids}).sort_values("id").drop_duplicates()
    rows = rows[rows.groupby("kind").cumcount() <= k]
    return rows["id"].to_numpy(), x[rows.index.to_numpy()]


def nearest(vectors: DataFrame, every: int = 20, k: int = NEAREST) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of largest inner product.

    Queries are the rows whose ``vec_id`` is divisible by ``every``; a row is no neighbour of
    its own id, and rows that share an id count once, with the best score. Scores are sums of
    double products in one order, so equal vectors tie exactly, and ties go to the smaller id.
    No usable rows give none; other columns are left out.
    """
    spark = vectors.sparkSession
    rows, longest, n = usable(vectors)
    schema = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], schema)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()
    lists = max(1, min(MAX_LISTS, n // LIST_ROWS, len(sample) // 4))
    index = spark.sparkContext.broadcast(fit(_matrix(sample["embedding"]), lists, longest))
    lists = len(index.value.centroids)
    kind = rows.schema["embedding"].dataType.simpleString()

    def deal(batches):
        for batch in batches:
            if len(batch):
                x = _matrix(batch["embedding"])
                at, home = index.value.homes(x)
                distance, angle, length = index.value.spreads(x[at], home)
                yield batch.iloc[at].assign(list=home, home=np.diff(at, prepend=-1) > 0,
                                            distance=distance, angle=angle, length=length)

    measures = [F.max(F.when(F.col("home"), F.col(c))).alias(c)
                for c in ("distance", "angle", "length")]
    posted = staged(rows.mapInPandas(
        deal, f"vec_id long, embedding {kind}, list int, home boolean, distance double, "
              "angle double, length double"), "lists")
    told = posted.groupBy("list").agg(F.count("*").alias("n"), *measures).toPandas().set_index(
        "list").reindex(range(lists))
    sizes = told["n"].fillna(0).to_numpy(int)
    first, blocks = grouped(sizes)
    far, wide_, long = (told[c].fillna(-1.0).to_numpy() for c in ("distance", "angle", "length"))
    bounds = Bounds(far, wide_, long, far >= 0)
    places = spark.createDataFrame(
        [(i, int(a), int(b)) for i, (a, b) in enumerate(zip(first, blocks))],
        "list int, _first int, _blocks int")

    def probe(batches):
        for batch in batches:
            if len(batch):
                found = index.value.probe(_matrix(batch["embedding"]), sizes)
                yield pd.DataFrame({"query_id": batch["vec_id"], "embedding": batch["embedding"],
                                    "lists": found})

    def more(batches):
        for batch in batches:
            for at in range(0, len(batch), BLOCK_ROWS):
                part = batch.iloc[at:at + BLOCK_ROWS]
                open_ = index.value.reachable(_matrix(part["embedding"]),
                                              part["floor"].to_numpy(float), bounds)
                read = part["lists"].str.len().to_numpy()
                open_[np.repeat(np.arange(len(part)), read), np.concatenate(part["lists"].tolist())] = False
                yield part.assign(lists=[np.nonzero(o)[0] for o in open_])

    def ask(batches):
        """A query's lists by the group they are in."""
        for batch in batches:
            for start in range(0, len(batch), BLOCK_ROWS):
                part = batch.iloc[start:start + BLOCK_ROWS]
                at = np.repeat(np.arange(len(part)), part["lists"].str.len().to_numpy())
                if not len(at):
                    continue
                found = np.concatenate(part["lists"].tolist()).astype(int)
                wide = np.repeat(np.arange(len(at)), blocks[found])
                nth = np.arange(len(wide)) - np.searchsorted(wide, wide)
                pairs = pd.DataFrame({"at": at[wide], "group": first[found][wide] + nth,
                                      "lists": found[wide]})
                said = pairs.groupby(["at", "group"])["lists"].agg(list).reset_index()
                whose = part.iloc[said["at"]]
                yield pd.DataFrame({
                    "query_id": whose["query_id"].to_numpy(),
                    "embedding": whose["embedding"].to_numpy(), "floor": whose["floor"].to_numpy(),
                    "group": said["group"], "lists": said["lists"]})

    def score(rows_, queries):
        """The best of one group of lists for the queries that read any of them."""
        out = [pd.DataFrame({"q": [], "vec_id": [], "score": []})]
        q = _matrix(queries["embedding"]) if len(queries) else None
        names, floor = queries["query_id"].to_numpy(), queries["floor"].to_numpy(float)
        reads = queries["lists"].explode() if len(queries) else pd.Series(dtype=int)
        readers = {k: v.to_numpy() for k, v in
                   pd.Series(np.arange(len(queries)).repeat(queries["lists"].str.len())
                             if len(queries) else []).groupby(reads.to_numpy())}
        for name, part in rows_.groupby("list"):
            mine = readers.get(name, np.zeros(0, int))
            if not len(mine):
                continue
            ids, x = few_copies(part["vec_id"].to_numpy(), _matrix(part["embedding"]), k)
            best = k if len(np.unique(ids)) == len(ids) else len(ids)
            kth, top = max(0, len(ids) - best), np.sqrt((x * x).sum(1).max())
            step = max(16, BLOCK_SCORES // len(ids))
            for at in range(0, len(mine), step):
                some = mine[at:at + step]
                s = q[some] @ x.T
                s[names[some][:, None] == ids] = -np.inf
                least = np.maximum(np.partition(s, kth, axis=1)[:, kth], floor[some])
                # the product's rounding may differ from that of the exact sum
                slack = SLACK * top * np.sqrt((q[some] ** 2).sum(1))
                i, j = np.nonzero((s >= (least - slack)[:, None]) & (s > -np.inf))
                out.append(pd.DataFrame({"q": some[i], "vec_id": ids[j],
                                         "score": (x[j] * q[some[i]]).sum(1)}))
        found = pd.concat(out).sort_values(
            ["q", "score", "vec_id"], ascending=[True, False, True]).drop_duplicates(["q", "vec_id"])
        top = found[found.groupby("q").cumcount() < k]
        return pd.DataFrame({"query_id": names[top["q"].to_numpy(int)], "vec_id": top["vec_id"],
                             "score": top["score"]})

    def scored(posted: DataFrame, queries: DataFrame, name: str) -> DataFrame:
        asked = staged(queries.mapInPandas(
            ask, f"query_id long, embedding {kind}, floor double, group int, lists array<int>"), name)
        most = asked.groupBy("group").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        turns = most // GROUP_QUERIES + 1
        left = posted.join(F.broadcast(places), "list").select(
            "vec_id", "embedding", "list",
            (F.col("_first") + F.pmod(F.xxhash64("vec_id"), "_blocks")).cast("int").alias("group"),
            F.explode(F.sequence(F.lit(0), F.lit(turns - 1))).alias("turn"))
        right = asked.withColumn("turn", F.pmod(F.xxhash64("query_id"), F.lit(turns)).cast("int"))
        keys = ["group", "turn"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
            score, "query_id long, vec_id long, score double")

    def ranked(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        once = found.repartition("query_id").groupBy("query_id", "vec_id").agg(
            F.max("score").alias("score"))
        return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    probed = staged(rows.where(F.col("vec_id") % every == 0).mapInPandas(
        probe, f"query_id long, embedding {kind}, lists array<int>"), "probed")
    none = F.lit(float("-inf"))
    near = staged(ranked(scored(posted, probed.withColumn("floor", none), "asked")), "near")
    floors = near.where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    checked = probed.join(floors, "query_id", "left").withColumn(
        "floor", F.coalesce("floor", none)).select("query_id", "embedding", "lists", "floor")
    # every row is at home in one list, so copies need not be read again
    others = scored(posted.where("home"), checked.mapInPandas(
        more, f"query_id long, embedding {kind}, lists array<int>, floor double"), "checked")
    return ranked(near.drop("rank").unionByName(others)).select(
        "query_id", "rank", "vec_id", "score")
