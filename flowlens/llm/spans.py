"""Substring dedup by sliding spans of sentences and of words.

Two kinds of runs are hashed. Every run of at least ``SENTENCES`` consecutive sentences, extended
until it holds ``WORDS`` words, is one. Sentences end at a line end or after ``.``, ``!`` or ``?``
and white space; one of more than ``LONG`` words counts as several, cut every ``PART`` words, so
a long sentence that is repeated as a whole has several parts.

The other kind finds passages that start or end inside a sentence, and those with other line ends:
every ``STRETCH`` consecutive words from an anchor on. A word is an anchor if the hash of it and
the next word is the least among any ``NEAR`` words in a row that hold it. Anchors depend on the
words around them only, wherever a sentence or the text began, so any ``PASSAGE`` words in a row
hold the same stretch in each copy.

Runs are joined globally by hash; the first one, by document id and place, stays, and every part
of a text that any later one covers is removed. Parts are sentences, cut where a stretch starts
or ends.

First places are found by an aggregate that combines before the shuffle, and runs are joined to
those that occur again, so a very common passage is split by the skew handling of the join.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import in_batches, mapped, staged, texts_of

SENTENCES, WORDS = 3, 16
LONG, PART = 20, 12
PASSAGE, NEAR = 50, 20
STRETCH = PASSAGE - NEAR + 1
#: Names that do not clash with columns of documents.
GONE, GONE_SPANS = "_spans_gone", "_spans_of_gone"

_END = re.compile(r"[.!?]+\s+|\n\s*")
_WORD = re.compile(r"\S+\s*")
#: Which code points are white space; the last is U+3000.
_BLANK = np.array([chr(c).isspace() for c in range(0x3002)])


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _sentences(text: str) -> list[tuple[int, int, str, int]]:
    """(start, end, words in lower case, their number) of each sentence; together the whole text."""
    out, at = [], 0
    for m in [*_END.finditer(text), None]:
        end = m.end() if m else len(text)
        words = text[at:end].lower().split()
        if len(words) <= LONG:
            if end > at:
                out.append((at, end, " ".join(words), len(words)))
        else:
            starts = [w.start() + at for w in _WORD.finditer(text[at:end])][::PART]
            starts[0] = at
            for a, b, k in zip(starts, [*starts[1:], end], range(0, len(words), PART)):
                part = words[k:k + PART]
                out.append((a, b, " ".join(part), len(part)))
        at = end
    return out


def _over(x: np.ndarray, of, n: int) -> np.ndarray:
    """``of``, minimum or maximum, of any ``n`` values in a row."""
    k = 1
    while 2 * k <= n:
        x = of(x[:-k], x[k:])
        k *= 2
    return of(x[:k - n], x[n - k:]) if k < n else x


def anchors(words: np.ndarray) -> np.ndarray:
    """Places of the words, given by their hashes, that are anchors."""
    if len(words) <= NEAR:
        return np.empty(0, dtype=np.int64)
    pair = words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:]
    pair = (pair ^ (pair >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    least = np.pad(_over(pair, np.minimum, NEAR), NEAR - 1)
    return np.flatnonzero(_over(least, np.maximum, NEAR) == pair)


def stretches(text: str) -> list[tuple[int, int, int]]:
    """(hash, start, end) of the stretch from each anchor that has ``STRETCH`` words after it."""
    words = text.lower().split()
    if len(words) < STRETCH:
        return []
    own = {w: xxhash.xxh3_64_intdigest(w) for w in set(words)}
    hashes = np.array([own[w] for w in words], dtype=np.uint64)
    found = anchors(hashes)
    found = found[found + STRETCH <= len(words)]
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = _BLANK[np.minimum(points, len(_BLANK) - 1)]
    starts = np.flatnonzero(~blank & np.append(True, blank[:-1]))
    starts = np.append(starts, len(text))
    return [(_signed(xxhash.xxh3_64_intdigest(hashes[k:k + STRETCH].tobytes(), seed=1)), a, b)
            for k, a, b in zip(found.tolist(), starts[found].tolist(),
                               starts[found + STRETCH].tolist())]


def _edges(text: str, full: list, words: list) -> list[int]:
    """Where parts start, and the end of the text."""
    return sorted({len(text), *(s[0] for s in full), *(x for w in words for x in w[1:])})


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of each part, a sentence or a piece of one; together the whole text."""
    edges = _edges(text, _sentences(text), stretches(text))
    return list(zip(edges, edges[1:]))


def runs(text: str) -> list[tuple[int, int, int]]:
    """(hash, first part, last part) of every run; sentences without words are passed over."""
    every, words = _sentences(text), stretches(text)
    place = {x: k for k, x in enumerate(_edges(text, every, words))}
    full = [s for s in every if s[3]]
    upto = [0]
    for s in full:
        upto.append(upto[-1] + s[3])
    out = []
    for k in range(len(full) - SENTENCES + 1):
        last = max(k + SENTENCES, bisect_left(upto, upto[k] + WORDS))
        if last > len(full):
            break
        told = "\n".join([f[2] for f in full[k:last]])
        out.append((_signed(xxhash.xxh3_64_intdigest(told)), place[full[k][0]],
                    place[full[last - 1][1]] - 1))
    out.extend((h, place[a], place[b] - 1) for h, a, b in words)
    return out


def all_runs(docs: DataFrame) -> DataFrame:
    """``h, doc_id, i, j`` of every run of every whole text; null ids are left out."""
    def per_slice(batch):
        h, doc_id, i, j = array("q"), array("q"), array("i"), array("i")
        for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
            found = runs(text)
            doc_id.extend(repeat(doc, len(found)))
            for run in found:
                h.append(run[0])
                i.append(run[1])
                j.append(run[2])
        return {"h": np.frombuffer(h, np.int64), "doc_id": np.frombuffer(doc_id, np.int64),
                "i": np.frombuffer(i, np.int32), "j": np.frombuffer(j, np.int32)}

    rows = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    return mapped(rows, "h long, doc_id long, i int, j int", per_slice)


def repeated(docs: DataFrame) -> DataFrame:
    """``doc_id, cuts``: the runs to remove, (first, last) part, of documents that have any."""
    found = staged(all_runs(docs), "runs")
    first = found.groupBy("h").agg(F.min(F.struct("doc_id", "i")).alias("first"),
                                   F.count("*").alias("n"))
    first = staged(first.where("n > 1").select(
        "h", F.col("first.doc_id").alias("d0"), F.col("first.i").alias("i0")), "repeated")
    again = found.join(first, "h").where((F.col("doc_id") != F.col("d0"))
                                         | (F.col("i") != F.col("i0")))
    return again.groupBy("doc_id").agg(F.collect_set(F.struct("i", "j")).alias("cuts"))


def _rest(text: str, cuts: list[dict]) -> tuple[str, int, list[dict]]:
    """The text without the parts that a cut covers, their number, and the spans removed."""
    parts = sentences(text)
    gone = set()
    for cut in cuts:
        gone.update(range(cut["i"], cut["j"] + 1))
    kept = "".join([text[s[0]:s[1]] for i, s in enumerate(parts) if i not in gone])
    spans: list[dict] = []
    for i in sorted(gone):
        a, b = parts[i][:2]
        if spans and spans[-1]["end"] == a:
            spans[-1]["end"] = b
        else:
            spans.append({"start": a, "end": b})
    return kept, len(gone), spans


def dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, text, n_removed, removed``: every row of ``docs`` with its remaining text.

    ``removed`` lists the spans (code points, end exclusive) of the text as it was. Rows that
    share an id are one document. Null ids take no part; null text stays null; a text without
    repeated runs stays as it is, to the character; other columns are left out.
    """
    out = _cleaned(docs.select("doc_id", "text"), repeated(docs))
    return out.withColumnsRenamed({GONE: "n_removed", GONE_SPANS: "removed"})


def _cleaned(docs: DataFrame, cuts: DataFrame) -> DataFrame:
    """All columns of ``docs``, with the new text, and what was removed."""
    named = cuts.select(F.col("doc_id").alias("_id"), F.col("cuts").alias("_cuts"))
    rows = docs.join(named, F.col("doc_id") == F.col("_id"), "left").drop("_id")
    names = docs.columns
    text_at, cuts_at = names.index("text"), len(names)
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            texts, n, removed = [], [], []
            for text, cut in zip(batch.column(text_at).to_pylist(),
                                 batch.column(cuts_at).to_pylist()):
                new = _rest(text, cut) if text and cut else (text, 0, [])
                texts.append(new[0])
                n.append(new[1])
                removed.append(new[2])
            columns = [batch.column(k) for k in range(len(names))]
            columns[text_at] = pa.array(texts, type=columns[text_at].type)
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n, pa.int64()), pa.array(removed, spans)],
                names=[*names, GONE, GONE_SPANS])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema),
                        f"{GONE} long, {GONE_SPANS} array<struct<start:bigint,end:bigint>>"])
    return in_batches(rows, run, schema)


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated spans removed; ``n_chars`` follows the text.

    A document of which nothing but white space remains goes; one that was blank before stays.
    """
    out = _cleaned(docs, repeated(docs))
    out = out.where((F.col(GONE) == 0) | (F.trim(F.regexp_replace("text", r"\s+", " ")) != ""))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(GONE) > 0, F.char_length("text").cast(
            "long")).otherwise(F.col("n_chars")))
    return out.select(docs.columns)
