"""Periodic runs of words: maximal stretches that repeat with one period, found exactly.

Short periods are found by scanning every lag directly. Beyond them, scales of growing k share
the work. A scale looks for periods q with 2k/3 <= q <= k through hashes of k words in a row.
Inside a run of period q (at least three periods long) these hashes repeat at distance q and at
no smaller one, and so do the minima of windows of k/3 hashes: at least one minimum and its
equal q further lie inside the run. Each pair of neighbouring equal minimizers therefore seeds
one period, and the words around it are compared until they differ. Minimizers only propose;
words decide. The texts of a slice are searched together, with a word of its own between them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import mapped, texts_of

LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Periods below this are scanned lag by lag.
FIRST_SCALE = 24
_SHORT = FIRST_SCALE * 2 // 3
_MULTIPLIER = 0x9E3779B97F4A7C15
WORDS = regex.compile(r"[^\x20\x09-\x0D]+").findall


def least_length(period: int) -> int:
    return max(LEAST_WORDS, LEAST_PERIODS * period)


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of True."""
    edges = np.flatnonzero(np.diff(equal.view(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2]


def short_runs(words: np.ndarray, limit: int = _SHORT) -> list[tuple[int, int, int]]:
    """``(start, end, period)`` of the stretches of every lag below ``limit``."""
    found = []
    for q in range(1, min(limit, len(words) // LEAST_PERIODS + 1)):
        starts, ends = _stretches(words[q:] == words[:-q])
        long = ends - starts + q >= least_length(q)
        found += [(int(s), int(e) + q, q) for s, e in zip(starts[long], ends[long])]
    return found


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over every window of ``width``, by doubling."""
    size = 1
    while size * 2 <= width:
        values = pick(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return pick(values[:-rest], values[rest:]) if rest else values


def window_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """A polynomial hash (mod 2**64) of every k words in a row; words are mixed by ``codes``."""
    n = len(codes)
    base = np.uint64(_MULTIPLIER)
    inverse = np.uint64(pow(_MULTIPLIER, -1, 1 << 64))
    up = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n - 1, base)]))
    down = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n - 1, inverse)]))
    total = np.concatenate([[np.uint64(0)], np.cumsum(codes * up, dtype=np.uint64)])
    out = (total[k:] - total[:-k]) * down[:n - k + 1]
    out ^= out >> np.uint64(29)  # the low bits alone are weak, and minima compare high ones
    return out * base


def minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the least hash of some window of ``width``, all ties included."""
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    least = _slide(hashes, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)  # no window there
    return np.flatnonzero(_slide(np.concatenate([edge, least, edge]), width, np.maximum) == hashes)


def _grown(words: np.ndarray, i: int, q: int) -> tuple[int, int]:
    """The stretch around i in which each word equals the one q further; words differ outside."""
    lo, step = i, 64
    while lo > 0:
        a = max(0, lo - step)
        differ = np.flatnonzero(words[a:lo] != words[a + q:lo + q])
        if len(differ):
            lo = a + int(differ[-1]) + 1
            break
        lo, step = a, step * 2
    hi, step, top = i, 64, len(words) - q
    while hi < top:
        b = min(top, hi + step)
        differ = np.flatnonzero(words[hi:b] != words[hi + q:b + q])
        if len(differ):
            hi += int(differ[0])
            break
        hi, step = b, step * 2
    return lo, hi + q


def scale_runs(words: np.ndarray, codes: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Runs whose period lies between 2k/3 and k, from equal minimizers at that distance."""
    if len(words) < max(k + k // 3, 2 * k):
        return []
    hashes = window_hashes(codes, k)
    at = minimizers(hashes, k // 3)
    order = at[np.argsort(hashes[at], kind="stable")]
    gaps = np.diff(order)
    near = (hashes[order[1:]] == hashes[order[:-1]]) & (gaps >= k * 2 // 3) & (gaps <= k)
    seeds, lags = order[:-1][near], gaps[near]
    found, done = [], {}
    for j in np.lexsort((seeds, lags)).tolist():
        i, q = int(seeds[j]), int(lags[j])
        if i < done.get(q, 0):
            continue
        start, end = _grown(words, i, q)
        done[q] = max(end - q, i + 1)
        if end - start >= least_length(q):
            found.append((start, end, q))
    return found


def find_runs(ids: list[np.ndarray], codes: np.ndarray) -> Iterator[list[tuple[int, int, int]]]:
    """For each text, ``(start, length, period)`` of its runs, by start, then period.

    ``ids`` holds the word numbers of each text and ``codes`` a random 64-bit number
    for each, and for the end of each text.
    Of stretches with equal bounds the one of the smallest period stays: at three periods or
    more, a smaller period of the same stretch divides the larger.
    """
    runs: list[dict[tuple[int, int], int]] = [{} for _ in ids]
    k, group = 0, [i for i, x in enumerate(ids) if len(x) >= LEAST_WORDS]
    while group:
        sizes = np.array([len(ids[i]) + 1 for i in group])
        starts = np.concatenate([[0], np.cumsum(sizes)])
        words = np.concatenate([np.append(ids[i], -1 - g) for g, i in enumerate(group)])
        if not k:
            found = short_runs(words)
        else:
            mixed = codes[words]  # the words between texts count down from -1
            found = scale_runs(words, mixed, k)
        owner = np.searchsorted(starts, [f[0] for f in found], side="right") - 1
        for (start, end, q), g in zip(found, owner.tolist()):
            key = (start - int(starts[g]), end - start)
            kept = runs[group[g]]
            kept[key] = min(q, kept.get(key, q))
        k = k + k // 2 if k else FIRST_SCALE
        group = [i for i in group if len(ids[i]) >= LEAST_PERIODS * (k * 2 // 3)]
    for kept in runs:
        yield sorted(((s, n, q) for (s, n), q in kept.items()), key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: all but those that a run repeats after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def collapse(docs: DataFrame, prepare: Callable[[object, list[str]], list[str]] | None = None,
             ) -> DataFrame:
    """``doc_id, n_words, runs`` (array of start, length, period) ``, collapsed`` for every row.

    ``prepare`` (id, words in, words out) edits the words before the search. ``collapsed`` holds
    the kept words, joined by one space. Null and empty texts have no words, no runs and an
    empty ``collapsed``; repeated rows and null ids stay as they are; other columns are left
    out. Row-local: no shuffle, so a frequent text or a long one is no hot key.
    """
    run_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def run(batch):
        keys = batch.column(0).to_pylist()
        texts = [WORDS(t) for t in texts_of(batch.column(1))]
        if prepare:
            texts = [prepare(k, w) for k, w in zip(keys, texts)]
        number: dict[str, int] = {}
        ids = [np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
               for words in texts]
        codes = np.random.default_rng(7).integers(  # one more for the word that ends each text
            0, 1 << 64, len(number) + len(texts), dtype=np.uint64)
        runs, collapsed = [], []
        for words, found in zip(texts, find_runs(ids, codes)):
            runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
            if found:
                words = [w for w, keep in zip(words, kept_words(len(words), found)) if keep]
            collapsed.append(" ".join(words))
        return {"doc_id": batch.column(0), "n_words": [len(w) for w in texts],
                "runs": pa.array(runs, type=run_type), "collapsed": collapsed}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(docs.select("doc_id", "text"), f"doc_id {kind}, n_words bigint, "
                  "runs array<struct<start:bigint,length:bigint,period:bigint>>, "
                  "collapsed string", run)


def strongest(runs: Column) -> Column:
    """The run of the greatest length/period, compared exactly; ties by start, then period."""
    def better(best, r):
        left, right = r.length * best.period, best.length * r.period
        return F.when(best.isNull() | (left > right) | (
            (left == right) & (F.struct(r.start, r.period) < F.struct(best.start, best.period))),
            r).otherwise(best)

    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, better)
