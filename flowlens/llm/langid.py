"""Language identification by a bidirectional gated recurrent network over bytes.

Each byte of a text is read by two recurrent networks, one from each side, and a softmax over
both states labels its position. A document's probabilities are the mean log-probability of its
positions, normalised. Texts are read whole, in blocks that each network enters some bytes
early, so a batch of blocks of any texts runs in step.

Training is numpy backpropagation through time on blocks of a bounded sample of labelled
documents; one Spark task fits, and the fitted arrays (some 60 kB) go to every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowlens.llm.common import mapped, staged, texts_of

#: Bound of the fit: documents of each language, languages, and training blocks of a document.
DOCS_PER_LANG, MAX_LANGS, BLOCKS_PER_DOC = 300, 200, 4
#: Documents in the sample over all languages.
MAX_SAMPLE = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 8, 4, 128, 0.02, 1e-5
#: Labelled bytes of a block, and how many bytes before and after it are read as well.
BLOCK, CONTEXT = 224, 16
SPAN = BLOCK + 2 * CONTEXT
#: Stands for "no byte here".
PAD = 256
UNDETERMINED = "und"
#: Blocks that a worker runs in step.
STEP_BLOCKS = 2048
HAS_LETTER = regex.compile(r"\p{L}").search


def blocks(raw: bytes) -> np.ndarray:
    """``(blocks, SPAN)`` bytes of one text; every byte is labelled by one block."""
    n = max(1, -(-len(raw) // BLOCK))
    padded = np.full(n * BLOCK + 2 * CONTEXT, PAD, np.int16)
    padded[CONTEXT:CONTEXT + len(raw)] = np.frombuffer(raw, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, SPAN)[::BLOCK]


class Direction:
    """A gated recurrent layer: z, r = s(e + hU), n = tanh(e + r * hU), h = z h + (1 - z) n.

    ``table`` holds what each byte adds, ``u`` the recurrent weights, gates side by side. The
    logistic function is written by tanh, so that one call serves both gates.
    """

    def __init__(self, table: np.ndarray, u: np.ndarray):
        self.table, self.u, self.size = table, u, u.shape[0]

    def step(self, h: np.ndarray, byte: np.ndarray, there: np.ndarray) -> tuple:
        k = self.size
        e, a = self.table.take(byte, axis=0), h @ self.u
        gates = np.tanh(0.5 * (e[:, :2 * k] + a[:, :2 * k]))
        gates *= 0.5
        gates += 0.5
        z, r = gates[:, :k], gates[:, k:]
        n = np.tanh(e[:, 2 * k:] + r * a[:, 2 * k:])
        new = n + z * (h - n)
        new *= there  # the state is empty outside the text
        return new, z, r, n, a[:, 2 * k:]

    def back(self, dh: np.ndarray, h: np.ndarray, z, r, n, c, byte, there, d_table, d_u) -> np.ndarray:
        """Adds the slopes of one step and returns those of the state before it."""
        dh = dh * there
        dn = dh * (1 - z) * (1 - n * n)
        da = np.concatenate([dh * (h - n) * z * (1 - z), dn * c * r * (1 - r), dn * r], axis=1)
        de = da.copy()
        de[:, 2 * self.size:] = dn
        hot = np.zeros((len(byte), PAD + 1), np.float32)
        hot[np.arange(len(byte)), byte] = 1
        d_table += hot.T @ de
        d_u += h.T @ da
        return dh * z + da @ self.u.T


@dataclass
class Network:
    """``langs`` and the arrays: (table, u) of each direction, output weights and bias."""

    langs: list[str]
    arrays: list[np.ndarray]

    @classmethod
    def fresh(cls, langs: list[str], seed: int = 5) -> Network:
        r, k = np.random.default_rng(seed), HIDDEN

        def some(shape, scale):
            return (r.standard_normal(shape) * scale).astype(np.float32)

        return cls(langs, [some((PAD + 1, 3 * k), 0.3), some((k, 3 * k), 0.5 / np.sqrt(k)),
                           some((PAD + 1, 3 * k), 0.3), some((k, 3 * k), 0.5 / np.sqrt(k)),
                           some((2 * k, len(langs)), 0.1), np.zeros(len(langs), np.float32)])

    def directions(self) -> list[Direction]:
        return [Direction(*self.arrays[:2]), Direction(*self.arrays[2:4])]

    def label(self, x: np.ndarray) -> np.ndarray:
        """``(blocks, langs)``: log-probabilities summed over the labelled bytes of each block."""
        x = np.ascontiguousarray(x.T)  # by step
        there = (x != PAD).astype(np.float32)[:, :, None]
        forth, back = self.directions()
        w, k = self.arrays[4], HIDDEN
        logits = np.empty((SPAN, x.shape[1], len(self.langs)), np.float32)
        h = np.zeros((x.shape[1], k), np.float32)
        for t in range(CONTEXT + BLOCK):
            h = forth.step(h, x[t], there[t])[0]
            if t >= CONTEXT:
                np.matmul(h, w[:k], out=logits[t])
        total = np.zeros((x.shape[1], len(self.langs)), np.float64)
        h = np.zeros_like(h)
        for t in range(SPAN - 1, CONTEXT - 1, -1):
            h = back.step(h, x[t], there[t])[0]
            if t < CONTEXT + BLOCK:
                z = logits[t] + h @ w[k:] + self.arrays[5]
                z -= z.max(axis=1, keepdims=True)
                z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
                total += z * there[t]
        return total

    def slopes(self, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss of the labelled bytes and its gradient, by backpropagation through time."""
        x = np.ascontiguousarray(x.T)
        there = (x != PAD).astype(np.float32)[:, :, None]
        k, n = HIDDEN, x.shape[1]
        w, bias = self.arrays[4:]
        pasts, states = [], []
        for direction, order in zip(self.directions(), (range(SPAN), range(SPAN - 1, -1, -1))):
            h, past, after = np.zeros((n, k), np.float32), {}, np.zeros((SPAN, n, k), np.float32)
            for t in order:
                new, *kept = direction.step(h, x[t], there[t])
                past[t] = (h, *kept)
                h = after[t] = new
            pasts.append(past)
            states.append(after)
        both = np.concatenate(states, axis=2)
        logits = both @ w + bias
        logits -= logits.max(axis=2, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=2, keepdims=True)
        counted = there[:, :, 0].copy()
        counted[:CONTEXT] = counted[CONTEXT + BLOCK:] = 0
        share = counted / max(1.0, counted.sum())
        rows = np.arange(n)
        loss = float(-(np.log(p[:, rows, y] + 1e-9) * share).sum())
        p[:, rows, y] -= 1
        p *= share[:, :, None]
        out = [np.zeros_like(a) for a in self.arrays]
        out[4] += both.reshape(-1, 2 * k).T @ p.reshape(-1, p.shape[2])
        out[5] += p.sum(axis=(0, 1))
        d_both = p @ w.T
        orders = (range(SPAN - 1, -1, -1), range(SPAN))
        for side, (direction, order) in enumerate(zip(self.directions(), orders)):
            dh = np.zeros((n, k), np.float32)
            for t in order:
                h, z, r, c, a = pasts[side][t]
                dh = direction.back(dh + d_both[t, :, side * k:(side + 1) * k], h, z, r, c, a,
                                    x[t], there[t], out[2 * side], out[2 * side + 1])
        return loss, out


def train(x: np.ndarray, y: np.ndarray, langs: list[str], epochs: int = EPOCHS,
          seed: int = 5) -> Network:
    """Adam over shuffled batches, with a rate that falls to a tenth; the order is seeded."""
    net, r = Network.fresh(langs, seed), np.random.default_rng(seed)
    first, second = ([np.zeros_like(a) for a in net.arrays] for _ in range(2))
    steps, done = max(1, epochs * -(-len(x) // BATCH)), 0
    for _ in range(epochs):
        for at in np.array_split(r.permutation(len(x)), max(1, -(-len(x) // BATCH))):
            _, slopes = net.slopes(x[at], y[at])
            norm = np.sqrt(sum(float((s * s).sum()) for s in slopes))
            done += 1
            rate = RATE * (1 - 0.9 * done / steps)
            for a, m, v, s in zip(net.arrays, first, second, slopes):
                s = s * min(1.0, 1.0 / max(norm, 1e-9)) + DECAY * a
                m += 0.1 * (s - m)
                v += 0.01 * (s * s - v)
                a -= rate * (m / (1 - 0.9 ** done)) / (np.sqrt(v / (1 - 0.99 ** done)) + 1e-8)
    return net


def sample_of(docs: DataFrame, usable: Column, docs_per_lang: int = DOCS_PER_LANG) -> DataFrame:
    """``lang, h, doc_id, text`` of the fit: of each of the ``MAX_LANGS`` most frequent languages
    the documents of least hash, as many as ``docs_per_lang`` and ``MAX_SAMPLE`` allow.

    Rows without text or language take no part. The rank within a language is limited before
    the shuffle, so a frequent language sends each task's few least hashes only.
    """
    known = docs.where(usable & F.col("lang").isNotNull() & (F.length("text") > 0)).select(
        "doc_id", "text", "lang", F.xxhash64("doc_id", "text").alias("h"))
    langs = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGS)
    names = sorted(r["lang"] for r in langs.collect())
    each = min(docs_per_lang, MAX_SAMPLE // max(1, len(names)))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = (known.where(F.col("lang").isin(names)).select("lang", "h", place.alias("n"))
              .where(F.col("n") <= each).select("lang", "h").distinct())
    return known.join(F.broadcast(chosen), ["lang", "h"]).dropDuplicates(["lang", "h"])


def _train_group(epochs: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["lang", "h"], kind="stable")
        langs = sorted(set(rows["lang"]))
        number = {name: i for i, name in enumerate(langs)}
        x = np.array([np.frombuffer(b, np.int16) for b in rows["block"]])
        net = train(x, rows["lang"].map(number).to_numpy(), langs, epochs)
        return pd.DataFrame({"langs": [langs], "arrays": [[a.ravel().tolist() for a in net.arrays]]})

    return run


def fit(docs: DataFrame, usable: Column, docs_per_lang: int = DOCS_PER_LANG,
        epochs: int = EPOCHS) -> Network | None:
    """A network fitted on the usable rows of ``docs``; None if no row is usable.

    Blocks are drawn by a seeded hash from the whole of each sampled text. The group that
    trains is the bounded sample.
    """
    def cut(batch):
        out = {"lang": [], "h": [], "block": []}
        for text, lang, h in zip(texts_of(batch.column(0)), *(batch.column(i).to_pylist()
                                                               for i in (1, 2))):
            found, r = blocks(text.encode()), np.random.default_rng(h % (1 << 63))
            for i in sorted(r.permutation(len(found))[:BLOCKS_PER_DOC].tolist()):
                out["lang"].append(lang)
                out["h"].append(int(r.integers(1 << 62)))
                out["block"].append(np.ascontiguousarray(found[i]).tobytes())
        return out

    rows = sample_of(docs, usable, docs_per_lang).select("text", "lang", "h")
    sample = mapped(rows, "lang string, h bigint, block binary", cut) \
        .withColumn("all", F.lit(True))
    fitted = staged(sample.groupBy("all").applyInPandas(
        _train_group(epochs), "langs array<string>, arrays array<array<float>>"), "langid").first()
    if fitted is None:
        return None
    shapes = [a.shape for a in Network.fresh(list(fitted["langs"])).arrays]
    return Network(list(fitted["langs"]), [np.array(a, np.float32).reshape(s)
                                           for a, s in zip(fitted["arrays"], shapes)])


def _label_texts(net: Network, texts: list[str]) -> Iterator[np.ndarray]:
    """Summed log-probabilities of each text, over blocks of all texts in step."""
    owners, parts, waiting = [], [], 0
    total = np.zeros((len(texts), len(net.langs)))

    def run():
        np.add.at(total, np.concatenate(owners), net.label(np.concatenate(parts)))

    for i, text in enumerate(texts):
        found = blocks(text.encode())
        for at in range(0, len(found), STEP_BLOCKS):
            part = found[at:at + STEP_BLOCKS]
            owners.append(np.full(len(part), i))
            parts.append(part)
            waiting += len(part)
            if waiting >= STEP_BLOCKS:
                run()
                owners, parts, waiting = [], [], 0
    if waiting:
        run()
    return total


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """``doc_id, lang_pred, score``: the likeliest language and its pooled probability.

    ``und`` with score 0 if the text is null, has no letter, or nothing could be learned.
    Repeated rows and null ids stay; other columns are left out; no shuffle.
    """
    def run(batch):
        texts = texts_of(batch.column(1))
        at = [i for i, t in enumerate(texts) if net and HAS_LETTER(t)]
        langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if at:
            total = _label_texts(net, [texts[i] for i in at])
            sizes = np.array([len(texts[i].encode()) for i in at])
            mean = total / sizes[:, None]
            p = np.exp(mean - mean.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            for i, row in zip(at, p):
                langs[i], scores[i] = net.langs[int(row.argmax())], round(float(row.max()), 6)
        return {"doc_id": batch.column(0), "lang_pred": langs, "score": scores}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(docs.select("doc_id", "text"),
                  f"doc_id {kind}, lang_pred string, score double", run)
