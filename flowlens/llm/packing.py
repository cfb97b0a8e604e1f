"""Best-fit packing by the configuration linear program over the length histogram.

The histogram has at most ``capacity`` entries whatever the corpus, so planning is bounded and
runs on the driver; everything that grows with the documents stays in Spark.

1. ``pieces`` tokenises whole texts in one pass and keeps a short row for each piece.
2. ``plan`` solves min sum x_c over configurations c (multisets of lengths that fit a sequence)
   that cover the histogram: multiplicative weights hold a price for each length. One table of
   the knapsack dynamic program prices, for every length, the best configuration that holds it;
   those near the highest price are used, which lowers the prices of their lengths, until every
   length is covered. Whole copies are taken first; the fractions that remain are walked through
   in order and give a copy each time their running sum passes a whole number, as long as its
   pieces are there. The program is solved again for what is left; its last pieces go best fit,
   longest first, in groups of equal sequences.
3. ``assign`` ranks the pieces of each length, in salted parts, and hands rank ranges to
   configurations. All pieces of one length are alike to the plan, so no search is left.
"""

from __future__ import annotations

import bisect
import json
import zlib
from collections import Counter

import numpy as np
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import mapped, staged, texts_of

CAPACITY = 2048
#: Most steps of the multiplicative weights, and the rate at which coverage lowers a price.
STEPS, RATE = 150, 0.1
#: Configurations this close to the highest price are used in a step; the steps end when the
#: cover is this close to the lower bound.
SLACK, GAP = 0.002, 0.002
#: Times the program is solved for what rounding left, and the share of the pieces below which
#: best fit ends the plan.
ROUNDS, LEFT = 8, 0.05
#: Pieces of one length that are ranked together.
RANK_ROWS = 5_000

_ENCODINGS: dict[tuple[str, str], tiktoken.Encoding] = {}


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabulary files spell bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """Encoder for a byte-level BPE vocabulary in the JSON form of ``tokenizers``.

    Token ids of such a vocabulary are merge ranks, so the ids equal those of that library
    (held by tests), which needs about six times the CPU time. As there, a text is split at the
    vocabulary's added tokens, which get their own ids.
    """
    key = (path, pattern)
    if key not in _ENCODINGS:
        letters = _byte_letters()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = {x["content"]: x["id"] for x in spec.get("added_tokens", ())}
        ranks = {bytes(letters[c] for c in token): i
                 for token, i in spec["model"]["vocab"].items() if token not in special}
        _ENCODINGS[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks,
                                            special_tokens=special)
    return _ENCODINGS[key]


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and end of each piece of ``n`` tokens; only the first may be short."""
    first = n % capacity or capacity
    if n <= capacity:
        return [(0, n)]
    return [(0, first), *((at, at + capacity) for at in range(first, n, capacity))]


def pieces(docs: DataFrame, tokenizer_path: str, pattern: str, capacity: int = CAPACITY,
           end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """A row for each piece: ``doc_id, piece, start, length, ids_crc32`` (``ids`` on request).

    A document is its ids and ``end_id``. Null text counts as empty, so it has one token;
    repeated rows give repeated pieces; other columns are left out.
    """
    def run(batch):
        enc = encoding(tokenizer_path, pattern)
        out: dict[str, list] = {name: [] for name in
                                ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
        for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
            ids = np.append(enc.encode_to_numpy(text, allowed_special="all"), end_id).astype("<u4")
            for k, (a, b) in enumerate(cuts(len(ids), capacity)):
                for name, value in (("doc_id", doc), ("piece", k), ("start", a), ("length", b - a),
                                    ("ids_crc32", zlib.crc32(ids[a:b].tobytes()))):
                    out[name].append(value)
                if with_ids:
                    out["ids"].append(ids[a:b].astype("i4"))
        return out

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return mapped(docs.select("doc_id", "text"), schema + ", ids array<int>" * with_ids, run)


def knapsack(prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The highest total price within each size, and the last length put in for it (0: none)."""
    value, last = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=int)
    lengths = np.flatnonzero(np.isfinite(prices) & (np.arange(len(prices)) > 0))
    of = prices[lengths]
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for size in range(1, capacity + 1):
        value[size] = value[size - 1]
        if upto[size]:
            total = of[:upto[size]] + value[size - lengths[:upto[size]]]
            k = int(np.argmax(total))
            if total[k] > value[size]:
                value[size], last[size] = total[k], lengths[k]
    return value, last


def read_off(last: np.ndarray, size: int) -> Counter:
    """Lengths, with their numbers, of the best configuration within ``size``."""
    found: Counter = Counter()
    while size > 0:
        if last[size]:
            found[int(last[size])] += 1
            size -= last[size]
        else:
            size -= 1
    return found


def best_configuration(prices: np.ndarray, capacity: int) -> dict[int, int]:
    """Lengths, with their numbers, of the highest total price that fit (knapsack by size)."""
    return dict(read_off(knapsack(prices, capacity)[1], capacity))


def fractional(histogram: dict[int, int], capacity: int, steps: int = STEPS,
               rate: float = RATE) -> tuple[dict[tuple, float], float]:
    """A solution of the program by multiplicative weights, and a lower bound on its optimum.

    Each step uses the configurations of nearly the highest price, one for each length at most,
    until one of the lengths is covered once more; a price falls with the exponential of its
    length's coverage. It ends after ``steps``, or when all is covered at ``GAP`` above the bound.
    """
    need = np.zeros(capacity + 1)
    for length, n in histogram.items():
        need[length] = n
    volume = np.arange(capacity + 1) / capacity
    covered, used, bound = np.zeros(capacity + 1), Counter(), float((need * volume).sum())
    present = np.flatnonzero(need)
    total = 0.0
    for _ in range(steps):
        level = covered - (covered[present].min() if len(present) else 0.0)
        prices = np.where(need > 0, volume * np.exp(-rate * level), -np.inf)
        value, last = knapsack(prices, capacity)
        worth = value[capacity]
        if not worth > 0:
            break
        bound = max(bound, float(prices[present] @ need[present]) / worth)
        near = present[prices[present] + value[capacity - present] >= (1 - SLACK) * worth]
        batch = {}
        for k in near.tolist():
            found = read_off(last, capacity - k)
            found[k] += 1
            batch[tuple(sorted(found.items(), reverse=True))] = min(
                need[i] / n for i, n in found.items())
        more = np.zeros(capacity + 1)
        for c, step in batch.items():
            for k, n in c:
                more[k] += step * n / need[k]
        scale = 1 / more.max()
        for c, step in batch.items():
            used[c] += step * scale
            total += step * scale
        covered += more * scale
        least = covered[present].min()
        if least > 0 and total / least <= (1 + GAP) * bound:
            break
    scaled = {c: x / max(1.0, max(covered[k] for k, _ in c)) for c, x in used.items()}
    return scaled, bound


def plan(histogram: dict[int, int], capacity: int = CAPACITY,
         steps: int = STEPS) -> list[tuple[int, list[int]]]:
    """(number of sequences, lengths in each), which together use every piece exactly once.

    Never more sequences than best fit alone: should rounding ever cost one, earlier rounds of
    the program end the plan, and at last none.
    """
    rest = {k: n for k, n in histogram.items() if n}
    full = rest.pop(capacity, 0)
    out = [(full, [capacity])] if full else []
    if not rest:
        return out
    placed, plans = [], [best_fit(rest, capacity)]
    enough = LEFT * sum(rest.values())
    for _ in range(ROUNDS):
        taken = rounded(fractional(rest, capacity, steps)[0], rest)
        if not taken:
            break
        for copies, lengths in taken:
            for k, n in Counter(lengths).items():
                rest[k] -= copies * n
        rest = {k: n for k, n in rest.items() if n}
        placed = placed + taken
        plans.append(placed + best_fit(rest, capacity))
        if sum(rest.values()) <= enough:
            break
    return out + min(reversed(plans), key=lambda p: sum(n for n, _ in p))


def rounded(solution: dict[tuple, float], histogram: dict[int, int]) -> list[tuple[int, list[int]]]:
    """Whole copies of configurations, of which the histogram holds every piece."""
    rest, out, run = dict(histogram), [], 0.0
    order = sorted(solution.items(), key=lambda e: -e[1])
    for whole in (True, False):
        for configuration, x in order:
            if whole:
                copies = int(x)
            else:
                copies, run = int(run + x % 1), (run + x % 1) % 1
            copies = min([copies, *(rest[k] // n for k, n in configuration)])
            if copies:
                out.append((copies, [k for k, n in configuration for _ in range(n)]))
                for k, n in configuration:
                    rest[k] -= copies * n
    return out


def best_fit(rest: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Best fit, longest first; equal sequences are kept as one group with a number."""
    spaces: list[int] = []  # the free spaces of open sequences, ascending
    groups: dict[int, list[list]] = {}
    done = []

    def put(count: int, lengths: list[int], free: int) -> None:
        if not free:
            done.append((count, lengths))
            return
        if free not in groups:
            bisect.insort(spaces, free)
        groups.setdefault(free, []).append([count, lengths])

    for length in sorted((k for k, n in rest.items() if n), reverse=True):
        left = rest[length]
        while left:
            at = bisect.bisect_left(spaces, length)
            if at == len(spaces):
                each = capacity // length
                if left >= each:
                    put(left // each, [length] * each, capacity - each * length)
                if left % each:
                    put(1, [length] * (left % each), capacity - left % each * length)
                break
            free = spaces[at]
            count, lengths = groups[free].pop()
            if not groups[free]:
                del groups[free]
                spaces.pop(at)
            take = min(left, count)
            if take < count:
                put(count - take, lengths, free)
            put(take, [*lengths, length], free - length)
            left -= take
    return done + [(n, lengths) for group in groups.values() for n, lengths in group]


def rank_ranges(patterns: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end, first sequence, pieces in a sequence, first offset)."""
    taken: Counter = Counter()
    base, out = 0, []
    for copies, lengths in patterns:
        offset = 0
        for length, each in sorted(Counter(lengths).items(), reverse=True):
            out.append((length, taken[length], taken[length] + copies * each, base, each, offset))
            taken[length] += copies * each
            offset += each * length
        base += copies
    return out


def assign(pieces_: DataFrame, capacity: int = CAPACITY, steps: int = STEPS) -> DataFrame:
    """``pieces_`` (with ``doc_id, piece, length`` and any more) plus ``sequence_id, offset``.

    ``pieces_`` is read twice, so it should be a written table. The plan has at most
    ``steps`` + some ``capacity`` patterns; it is the only broadcast. No pieces give no rows.
    """
    spark = pieces_.sparkSession
    histogram = {r["length"]: r["n"] for r in
                 pieces_.groupBy("length").agg(F.count("*").alias("n")).collect()}
    ranges = spark.createDataFrame(
        rank_ranges(plan(histogram, capacity, steps)),
        "_length long, _lo long, _hi long, _base long, _each long, _first long")
    parts = spark.createDataFrame([(k, n // RANK_ROWS + 1) for k, n in histogram.items()],
                                  "length long, _parts long")
    dealt = (pieces_.join(F.broadcast(parts), "length")
             .withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece", "start"), "_parts")))
    sizes = dealt.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    before = sizes.select("length", "_part", (F.sum("_n").over(
        Window.partitionBy("length").orderBy("_part")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("length", "_part").orderBy("doc_id", "piece"))
    ranked = (dealt.withColumn("_inside", inside - 1).join(before, ["length", "_part"])
              .withColumn("_rank", F.col("_before") + F.col("_inside")))
    at = F.col("_rank") - F.col("_lo")
    return (ranked.join(F.broadcast(ranges), (F.col("length") == F.col("_length"))
                        & (F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi")))
            .select(*pieces_.columns,
                    (F.col("_base") + F.floor(at / F.col("_each"))).alias("sequence_id"),
                    (F.col("_first") + at % F.col("_each") * F.col("length")).alias("offset")))


def pack(docs: DataFrame, tokenizer_path: str, pattern: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for all documents."""
    return assign(staged(pieces(docs, tokenizer_path, pattern, capacity), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, input_ids, doc_lengths`` of pieces that carry ``ids``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return (packed.groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id", F.flatten("parts.ids").alias("input_ids"),
                    F.transform("parts.ids", F.size).alias("doc_lengths")))
