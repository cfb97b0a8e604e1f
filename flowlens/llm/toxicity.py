"""Toxicity by a classifier chain.

Categories are learned one after another. Each is a logistic model over words and word
beginnings that a document holds; a later category also gets the probabilities of the earlier
ones. In training those are out-of-fold: every labelled document is scored by a model that has
not seen it, so the later model learns from what it will meet. In scoring they come from the
models of the whole sample.

Models are fitted on at most ``SAMPLE`` labelled documents (a documented bound, chosen by a hash
of the id); scoring reads every whole text once, without a shuffle.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import in_batches, mapped, staged, texts_of, trim

#: Labelled documents used for fitting, folds, and hash buckets of the features.
SAMPLE, FOLDS, BUCKETS = 30_000, 5, 1 << 20
#: Features kept for each category, and documents that a feature must occur in.
FEATURES, LEAST_DOCS = 800, 4
#: How much more frequent in the category a feature must be, and its least likelihood gain.
LIFT, LEAST_GAIN = 6, 6
#: Lengths of the word beginnings that count as features next to the word itself.
BEGINNINGS = (4, 5, 6)
#: Weight of the squared coefficients against the summed loss, and steps of a fit.
RIDGE, STEPS = 0.05, 60
THRESHOLD = 0.5
MAX_WORDS = 100_000
#: Rows of a fit whose columns are widened at a time.
BLOCK = 2_048
EDGES = ".,;:!?\"'()[]{}<>*#%&-_/\\|«»„“”‘’…"


def word_features(word: str) -> tuple[int, ...]:
    """Buckets of a word and its beginnings, without punctuation at its ends."""
    core = word.strip(EDGES)
    if not core:
        return ()
    parts = [core, *(f"{core[:n]}*" for n in BEGINNINGS if len(core) >= n)]
    return tuple(zlib.crc32(p.encode()) % BUCKETS for p in parts)


class Features:
    """Features of texts, with the words of a worker remembered up to a bound."""

    def __init__(self, keep: dict[int, int] | None = None):
        self.keep, self.known = keep, {}

    def _word(self, word: str) -> tuple[int, ...]:
        if len(self.known) >= MAX_WORDS:
            self.known.clear()
        found = word_features(word)
        if self.keep is not None:
            found = tuple(self.keep[b] for b in found if b in self.keep)
        self.known[word] = found
        return found

    def of(self, text: str) -> list[int]:
        known, out = self.known, set()
        for word in set(text.lower().split()):
            found = known.get(word)
            if found is None:
                found = self._word(word)
            if found:
                out.update(found)
        return sorted(out)


@dataclass
class Chain:
    """Bucket to column, and for each category: bias, column weights, weights of earlier ones."""

    categories: list[str]
    columns: dict[int, int]
    models: list[np.ndarray]

    def probabilities(self, rows: list[list[int]]) -> np.ndarray:
        width, out = len(self.columns), np.zeros((len(rows), len(self.models)))
        for at, row in enumerate(rows):
            for k, w in enumerate(self.models):
                z = w[0] + w[1 + np.array(row, dtype=int)].sum() + w[1 + width:] @ out[at, :k]
                out[at, k] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out


def logistic(rows: list, extra: np.ndarray, y: np.ndarray, width: int) -> np.ndarray:
    """``logistic_flat`` of rows given as a list of lists of columns."""
    sizes = np.array([len(r) for r in rows], dtype=np.int64)
    columns = np.concatenate([np.asarray(r, dtype=np.int64) for r in rows]) if sizes.sum() else \
        np.zeros(0, np.int64)
    return logistic_flat(columns, sizes, extra, y, width)


def logistic_flat(columns: np.ndarray, sizes: np.ndarray, extra: np.ndarray, y: np.ndarray,
                  width: int) -> np.ndarray:
    """Bias, weights of ``width`` present-or-not columns, weights of the columns of ``extra``.

    Row after row, ``columns`` lists the present ones and ``sizes`` their number. L-BFGS on the
    log loss with a ridge on all but the bias. Of one class only, the bias says its smoothed
    share and nothing else counts.
    """
    n = len(y)
    w = np.zeros(1 + width + extra.shape[1])
    if not n or y.min() == y.max():
        share = (y.sum() + 0.5) / (n + 1)
        w[0] = np.log(share / (1 - share)) - (3 if share < 0.5 or not n else -3)
        return w
    ends = np.append(0, np.cumsum(sizes))
    blocks = [(at, min(n, at + BLOCK)) for at in range(0, n, BLOCK)]

    def part(a, b):
        """The columns of some rows, and the row of each."""
        return columns[ends[a]:ends[b]].astype(np.int64), np.repeat(np.arange(b - a), sizes[a:b])

    def loss(w):
        z = w[0] + extra @ w[1 + width:]
        for a, b in blocks:
            at, owner = part(a, b)
            z[a:b] += np.bincount(owner, w[1 + at], b - a)
        value = np.logaddexp(0, z).sum() - z[y > 0].sum() + RIDGE / 2 * (w[1:] ** 2).sum()
        off = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        slope = np.concatenate([[off.sum()], np.zeros(width), extra.T @ off])
        for a, b in blocks:
            at, owner = part(a, b)
            slope[1:1 + width] += np.bincount(at, off[a:b][owner], width)
        slope[1:] += RIDGE * w[1:]
        return value, slope

    value, slope = loss(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        step, alphas = -slope, []
        for s, d in reversed(past):
            alphas.append((s @ step) / (s @ d))
            step = step - alphas[-1] * d
        if past:
            s, d = past[-1]
            step = step * (s @ d) / (d @ d)
        else:
            step = step / max(1.0, np.abs(slope).max())
        for (s, d), a in zip(past, reversed(alphas)):
            step = step + s * (a - (d @ step) / (s @ d))
        size, fall = 1.0, slope @ step
        if fall > -1e-9:
            break
        while size > 1e-6:
            new, new_slope = loss(w + size * step)
            if new <= value + 1e-4 * size * fall:
                break
            size /= 2
        else:
            break
        s, d = size * step, new_slope - slope
        if s @ d > 1e-12:
            past = [*past[-7:], (s, d)]
        w, value, slope = w + s, new, new_slope
    return w


def labelled(docs: DataFrame, labels: DataFrame, categories: dict[str, object]) -> DataFrame:
    """``doc_id, fold, y, buckets`` of the sample; rows with a null id or label take no part."""
    usable = labels.select("doc_id", *[c.cast("int").alias(n) for n, c in categories.items()])
    usable = usable.dropna().groupBy("doc_id").agg(
        F.array(*[F.max(n) for n in categories]).alias("y"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).cast("int")
                    .alias("fold"), "y", "text"))

    def run(batch):
        features = Features()
        return {"doc_id": batch.column(0), "fold": batch.column(1), "y": batch.column(2),
                "buckets": [features.of(t) for t in texts_of(batch.column(3))]}

    found = mapped(rows, "doc_id long, fold int, y array<int>, buckets array<int>", run)
    # of documents with the same features and labels one stays
    same = F.xxhash64("y", "buckets")
    return staged(found.withColumn("_same", same).dropDuplicates(["_same"]).drop("_same"), "labelled")


def chosen_columns(sample: DataFrame, n_categories: int) -> dict[int, int]:
    """The buckets whose presence speaks most for each category (likelihood ratio)."""
    def count(batches):
        total = np.zeros((n_categories + 1, BUCKETS), dtype=np.int32)
        for batch in batches:
            for y, buckets in zip(batch.column("y").to_pylist(), batch.column("buckets")):
                buckets = buckets.values.to_numpy()
                total[0, buckets] += 1
                for k, v in enumerate(y):
                    if v:
                        total[k + 1, buckets] += 1
        at = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(total[:, at].T.tolist(), type=pa.list_(pa.int64()))],
            names=["bucket", "n"])

    seen = in_batches(sample.select("y", "buckets"), count, "bucket long, n array<long>")
    seen = seen.groupBy("bucket").agg(
        *[F.sum(F.get("n", F.lit(k))).alias(f"n{k}") for k in range(n_categories + 1)]
    ).where(F.col("n0") >= LEAST_DOCS)
    totals = sample.agg(F.count("*"), *[F.sum(F.get("y", F.lit(k)))
                                        for k in range(n_categories)]).first()
    kept: dict[int, int] = {}
    for k in range(n_categories):
        all_, yes = float(totals[0]), float(totals[k + 1] or 0)
        n, a = F.col("n0"), F.col(f"n{k + 1}")

        def term(x, expected):
            return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)

        if not 0 < yes < all_:
            continue
        gain = sum((term(x, row * side) for x, row, side in (
            (a, n, yes / all_), (n - a, n, 1 - yes / all_),
            (yes - a, all_ - n, yes / all_), (all_ - yes - n + a, all_ - n, 1 - yes / all_))),
            F.lit(0.0))
        signs = a * (all_ - yes) > LIFT * (n - a) * yes
        best = (seen.where(signs).select("bucket", gain.alias("gain"))
                .where(F.col("gain") >= LEAST_GAIN).orderBy(F.desc("gain"), "bucket")
                .limit(FEATURES))
        for r in best.collect():
            kept.setdefault(r["bucket"], len(kept))
    return kept


def _trainer(k: int, width: int):
    """Fits category ``k`` without the fold ``turn`` and scores that fold; -1 holds out none."""
    def train(turn: tuple, table: pa.Table) -> pa.Table:
        held = turn[0].as_py()
        table = table.combine_chunks().sort_by("doc_id")
        fold = table["fold"].to_numpy()
        extra = _flat(table["earlier"])[0].astype(float).reshape(len(fold), k)
        y = _flat(table["y"])[0].reshape(len(fold), -1)[:, k].astype(float)
        columns, sizes = _flat(table["row"])
        docs = table["doc_id"]
        del table
        known = fold != held
        inside = np.repeat(known, sizes)
        w = logistic_flat(columns[inside], sizes[known], extra[known], y[known], width)
        if held < 0:
            out = [[-1], [0.0], [w.tolist()]]
        else:
            owner = np.repeat(np.arange(int((~known).sum())), sizes[~known])
            z = w[0] + np.bincount(owner, w[1 + columns[~inside]], int((~known).sum()))
            p = 1 / (1 + np.exp(-np.clip(z + extra[~known] @ w[1 + width:], -30, 30)))
            out = [docs.filter(pa.array(~known)), p, [None] * len(p)]
        trim()
        return pa.table([pa.chunked_array([x], t) if isinstance(x, list) else x for x, t in
                         zip(out, (pa.int64(), pa.float64(), pa.list_(pa.float64())))],
                        names=["doc_id", "p", "w"])

    return train


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists in one array, and the size of each list."""
    lists = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return (lists.flatten().to_numpy(zero_copy_only=False),
            np.diff(lists.offsets.to_numpy()).astype(np.int64))


def fit(docs: DataFrame, labels: DataFrame, categories: dict[str, object]) -> Chain:
    """Fit the chain. ``categories`` maps names to 0/1 columns of ``labels``, in chain order."""
    sample = labelled(docs, labels, categories)
    columns = chosen_columns(sample, len(categories))
    width, names = len(columns), list(categories)

    def narrow(batch):
        return {"doc_id": batch.column(0), "fold": batch.column(1), "y": batch.column(2),
                "earlier": [[]] * batch.num_rows,
                "row": [[columns[b] for b in row if b in columns]
                        for row in batch.column(3).to_pylist()]}

    rows = mapped(sample.select("doc_id", "fold", "y", "buckets"), "doc_id long, fold int, "
                  "y array<int>, earlier array<double>, row array<int>", narrow)
    models: list[np.ndarray] = []
    for k in range(len(names)):
        last = k == len(names) - 1
        turns = [-1] if last else [-1, *range(FOLDS)]

        # every group is the bounded sample
        fitted = (rows.withColumn("turn", F.explode(F.array(*map(F.lit, turns))))
                  .groupBy("turn").applyInArrow(_trainer(k, width), "doc_id long, p double, w array<double>"))
        fitted = staged(fitted, "fitted")
        got = fitted.where(F.col("w").isNotNull()).select("w").first()
        models.append(np.array(got["w"]) if got else
                      logistic([], np.zeros((0, k)), np.zeros(0), width))
        if not last:
            p = fitted.where(F.col("w").isNull()).select("doc_id", "p")
            rows = rows.join(p, "doc_id").withColumn(
                "earlier", F.array_append("earlier", F.col("p"))).drop("p")
    return Chain(names, columns, models)


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """``doc_id`` and the probability of each category (``p_`` and its name), row by row.

    Null and empty texts hold no features; repeated rows and null ids stay; other columns are
    left out.
    """
    names = [f"p_{c}" for c in chain.categories]

    def run(batch):
        nonlocal features
        if features is None:
            features = Features(chain.columns)
        p = chain.probabilities([features.of(t) for t in texts_of(batch.column(1))])
        return {"doc_id": batch.column(0)} | {n: p[:, k] for k, n in enumerate(names)}

    features: Features | None = None
    schema = ", ".join(["doc_id long", *(f"`{n}` double" for n in names)])
    return mapped(docs.select("doc_id", "text"), schema, run)


def default_categories() -> dict[str, object]:
    """Low quality first, since junk looks unlike insults; then toxic."""
    return {"low_quality": (F.col("quality") == 0), "toxic": (F.col("toxic") == 1)}


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, p_low_quality, p_toxic, toxic`` for every row of ``docs``."""
    chain = fit(docs, labels, default_categories())
    return score(docs, chain).withColumn("toxic", F.col("p_toxic") >= THRESHOLD)


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the toxic ones, with their columns as they are."""
    chain = fit(docs, labels, default_categories())
    schema = docs.schema
    text_at = docs.columns.index("text")
    features: Features | None = None

    def run(batches):
        nonlocal features
        if features is None:
            features = Features(chain.columns)
        for batch in batches:
            p = chain.probabilities([features.of(t) for t in texts_of(batch.column(text_at))])
            yield batch.filter(pa.array(p[:, -1] < THRESHOLD))

    return in_batches(docs, run, schema)
