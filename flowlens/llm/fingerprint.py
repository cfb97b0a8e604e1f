"""Document fingerprints by one-permutation MinHash, by DataFrame operations only.

Each run of five words is hashed once. The upper bits of the hash choose one of 256 bins, and a
bin keeps its least hash. An empty bin borrows from another by optimal densification: its
own sequence of hashed attempts, the same in every document, is followed to the first bin that
is not empty. (After ``ATTEMPTS`` of them the least hash of (bin, candidate) over the filled
bins decides, which is as uniform and always ends.) Four bits of a hash of the kept value and the
bin are packed into a hex digit. Equal values thus still agree, and different ones agree by chance in
1/16 of the bins, in each bin anew even where borrowing fills many bins with one value; the
likeness takes this share out again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORDS = 5
BIN_BITS, CODE_BITS, ATTEMPTS = 8, 4, 8
BINS = 1 << BIN_BITS
#: Rows of neighbouring ids that are paired with their successors in one group. Group bounds are
#: found in three levels of ``FAN``; beyond ``FAN**3`` groups (524 million rows) groups grow.
GROUP_ROWS, FAN = 2_000, 64
LEAST = -(1 << 63)


def _bin(value: Column) -> Column:
    return (F.shiftright(value, 64 - BIN_BITS) + BINS // 2).cast("int")


def with_codes(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: 256 codes of the text, or no codes if it has no word.

    Words are lower case, cut at white space; a text of one to four words is one shingle.
    """
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    df = df.withColumn("_w", F.transform(words, lambda w: F.xxhash64(w)))
    n = F.size("_w")
    runs = F.transform(F.sequence(F.lit(0), n - WORDS),
                       lambda i: F.xxhash64(*[F.get("_w", i + k) for k in range(WORDS)]))
    shingles = F.when(n >= WORDS, runs).when(n > 0, F.array(F.xxhash64("_w"))).otherwise(
        F.array().cast("array<bigint>"))
    df = df.withColumn("_h", F.sort_array(shingles)).drop("_w")
    least = F.filter("_h", lambda h, i: (i == 0) | (_bin(h) != _bin(F.get("_h", i - 1))))
    df = df.withColumn("_f", least).drop("_h")
    # the bins in order, with nulls for the empty ones between them
    def gap(upto, after):
        return F.array_repeat(F.lit(None).cast("bigint"), upto - after - 1)

    filled = F.transform("_f", lambda h, i: F.concat(
        gap(_bin(h), F.when(i > 0, _bin(F.get("_f", i - 1))).otherwise(-1)), F.array(h)))
    df = df.withColumn("_d", F.concat(
        F.flatten(filled), gap(F.lit(BINS), F.coalesce(_bin(F.get("_f", F.size("_f") - 1)),
                                                       F.lit(-1)))))
    def borrowed(b):
        tries = [F.get("_d", F.pmod(F.xxhash64(b, F.lit(k)), F.lit(BINS)).cast("int"))
                 for k in range(1, ATTEMPTS + 1)]
        rest = F.array_min(F.transform("_f", lambda h: F.struct(
            F.xxhash64(b, _bin(h)).alias("order"), h.alias("h"))))["h"]
        return [*tries, rest]

    low = F.lit((1 << CODE_BITS) - 1)
    codes = F.transform("_d", lambda h, b: F.xxhash64(F.coalesce(h, *borrowed(b)), b)
                        .bitwiseAND(low).cast("int"))
    return df.withColumn(out, F.when(F.size("_f") > 0, codes).otherwise(
        F.array().cast("array<int>"))).drop("_f", "_d")


def packed(codes: Column) -> Column:
    """A hex digit for each code; the empty string if there are none."""
    digits = F.array(*[F.lit(f"{i:x}") for i in range(1 << CODE_BITS)])
    return F.array_join(F.transform(codes, lambda c: F.get(digits, c)), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles, 0 to 1; two texts without words are alike."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / BINS
    chance = 1 / (1 << CODE_BITS)
    full = (F.size(a) > 0) & (F.size(b) > 0)
    return (F.when(full, F.greatest(F.lit(0.0), (same - chance) / (1 - chance)))
             .when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(F.lit(0.0)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of every whole text (null: empty); other columns are left out."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_t"))
    return with_codes(rows, "_t", "_c").select("doc_id", packed(F.col("_c")).alias("fingerprint"))


def _longs(values: list[int]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<bigint>")


def _passed(values: Column, key: Column) -> Column:
    return F.size(F.filter(values, lambda b: b <= key))


def group_of(rows: DataFrame, bounds: list[int]) -> DataFrame:
    """Add ``_g``, the number of sorted ``bounds`` up to ``_k``: blocks first, then inside them."""
    levels = [bounds]
    while len(levels[-1]) > FAN:
        levels.append(levels[-1][FAN - 1::FAN])  # the last bound of each full block
    rows = rows.withColumn("_g", F.lit(0))
    for level in reversed(levels):
        inside = F.slice(_longs(level), F.col("_g") * FAN + 1, FAN)
        rows = rows.withColumn("_g", F.col("_g") * FAN + _passed(inside, F.col("_k")))
    return rows


def _bounds(ids: DataFrame, groups: int) -> list[int]:
    """At most ``groups`` approximate quantiles of ``_k`` (all rows), and the least key before them."""
    if groups < 2:
        return [LEAST]
    shares = F.array(*[F.lit(i / groups) for i in range(1, groups)])
    found = ids.agg(F.percentile_approx("_k", shares, 10 * groups)).first()[0]
    return sorted({LEAST, *found})


def _grouped(docs: DataFrame) -> DataFrame:
    """Rows in groups of neighbouring ids; the first of the next group ends each group as a guest.

    Only group bounds, a count and the first row's id of each group are gathered. Null ids
    come first. An id of very many rows (or null) starts a group of its own, which is split
    by ranges of the hash that orders its rows; equal rows of one id stay together.
    """
    ids = docs.select(F.coalesce("doc_id", F.lit(LEAST)).alias("_k"))
    groups = min(FAN ** 3, ids.count() // GROUP_ROWS + 1)
    bounds = _bounds(ids, groups)
    sizes = group_of(ids.groupBy("_k").count(), bounds).groupBy("_g").agg(
        F.min("_k").alias("first"), F.min_by("count", "_k").alias("n")).collect()
    spark = docs.sparkSession
    split = [(r["_g"], r["first"], r["n"] // GROUP_ROWS + 1) for r in sizes
             if r["n"] > 2 * GROUP_ROWS]
    heavy = F.broadcast(spark.createDataFrame(split, "_g int, _first long, _parts long"))
    tie = F.xxhash64(F.coalesce("text", F.lit(""))) if split else F.lit(0)
    rows = group_of(docs.select("doc_id", F.coalesce("doc_id", F.lit(LEAST)).alias("_k"),
                                F.coalesce("text", F.lit("")).alias("_t"), tie.alias("_x")), bounds)
    if split:
        part = F.floor((F.col("_x").cast("double") / float(1 << 64) + 0.5) * F.col("_parts"))
        part = F.least(F.greatest(part, F.lit(0)), F.col("_parts") - 1)
        rows = rows.join(heavy, "_g", "left").withColumn("_s", F.coalesce(
            F.when(F.col("_k") == F.col("_first"), part), F.col("_parts"), F.lit(0)).cast("long"))
    else:
        rows = rows.withColumn("_s", F.lit(0).cast("long"))
    firsts = sorted((r["_g"], r["_s"], *r["at"]) for r in rows.groupBy("_g", "_s").agg(
        F.min(F.struct("_k", "_x")).alias("at")).collect()) if split else \
        sorted((r["_g"], 0, r["first"], 0) for r in sizes)
    guests = spark.createDataFrame(
        [(k, x, *firsts[i - 1][:2]) for i, (_, _, k, x) in enumerate(firsts)],
        "_k long, _x long, _to long, _part long")
    own = F.struct(F.col("_g").cast("long").alias("_g"), "_s", F.lit(0).alias("guest"))
    seats = F.filter(F.array(own, F.when(F.col("_to").isNotNull(), F.struct(
        F.col("_to").alias("_g"), F.col("_part").alias("_s"), F.lit(1).alias("guest")))),
        lambda s: s.isNotNull())
    return (rows.withColumn("_x", F.col("_x").cast("long"))
            .join(F.broadcast(guests), ["_k", "_x"], "left")
            .select("doc_id", "_k", "_t", F.explode(seats).alias("_seat"))
            .select("doc_id", "_k", "_t", "_seat._g", "_seat._s", "_seat.guest",
                    F.xxhash64("_t").alias("_tie")))


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of an edited one, and their likenesses.

    The edited text has its last quarter (in code points, rounded down) replaced by as many code
    points of the next document by ascending ``doc_id``, after the last: the first. Null text
    counts as empty, null ids come first, rows that share an id go by a hash of the text; no
    rows give none. Texts are shuffled once.
    """
    order = Window.partitionBy("_g", "_s").orderBy("guest", "_k", "_tie")
    rows = _grouped(docs).withColumn("_n", F.char_length("_t").cast("long"))
    rows = rows.withColumn("_next", F.lead("_t").over(order))
    quarter = F.floor(F.col("_n") / 4)
    rows = rows.withColumn("_e", F.concat(
        F.substr("_t", F.lit(1), (F.col("_n") - quarter).cast("int")),
        F.substr(F.coalesce("_next", F.lit("")), F.lit(1), quarter.cast("int")))).drop("_next")
    rows = with_codes(with_codes(rows, "_t", "_a"), "_e", "_b")
    rows = rows.select("doc_id", "_k", "_g", "_s", "guest", "_tie", "_n", "_a", "_b",
                       F.sha2(F.col("_e").cast("binary"), 256).alias("edited_sha256"))
    rows = rows.withColumn("_c", F.lead("_a").over(order)).where(F.col("guest") == 0)
    return rows.select(
        "doc_id", F.col("_n").alias("n_chars"), "edited_sha256",
        packed(F.col("_a")).alias("fingerprint"), packed(F.col("_b")).alias("edited_fingerprint"),
        likeness(F.col("_a"), F.col("_b")).alias("near_edited"),
        likeness(F.col("_a"), F.col("_c")).alias("near_next"))
