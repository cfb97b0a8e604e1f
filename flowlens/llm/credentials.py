"""Secret scans that link the parts of multipart credentials, by DataFrame operations only.

Every pattern is marked in the whole text with a control character, and the lengths of the cut
pieces are summed up to code point positions. Strong findings (assignments, access ids, hex
runs) are reported as they are. Weak candidates say little alone: a bare 40-character secret is
reported only near an access id, and an endpoint only near an access id and a secret.
Nearness is an interval join inside the document: gap of at most ``SCOPE`` code points. The
spans of a row are sorted, and one pass from each side carries the nearest complement along;
pairs are never listed, and no text leaves its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK, STAND_IN = "\u0001", "\u0002"
SCOPE = 300
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
#: Pattern, and the length that a match (of an assignment: its value) must reach, in report order.
STRONG = {"assign": (ASSIGN, 12), "access": (r"AKIA[A-Z0-9]+", 18), "hex": (r"[0-9a-f]{16,}", 16)}
WEAK = {"secret": (r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])", 40),
        "endpoint": (r"""https?://[^\s"'<>\x01]+""", 10)}
KINDS = {**STRONG, **WEAK}
REDACTED = "[SECRET]"
SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"


def _marked(text: Column, kind: str) -> Column:
    """The text cut at the matches of one kind: outside, match, outside, ..."""
    return F.split(F.regexp_replace(text, KINDS[kind][0], f"{MARK}$0{MARK}"), MARK, -1)


def _hits(cut: Column, kind: str) -> Column:
    """The findings of one kind: the odd pieces that pass, placed by the lengths before them."""
    pattern, least = KINDS[kind]

    def told(p):
        ok = F.char_length(F.regexp_extract(p, pattern, 2) if kind == "assign" else p) >= least
        if kind == "secret":
            ok = ok & p.rlike("[0-9]") & p.rlike("[a-z]") & p.rlike("[A-Z]")
        return ok

    def step(done, p):
        end = done.at + F.char_length(p)
        span = F.struct(done.at.alias("start"), F.lit(list(KINDS).index(kind)).alias("kind"),
                        end.alias("end"))
        return F.struct(end.alias("at"), (~done.inside).alias("inside"),
                        F.when(done.inside & told(p), F.array_append(done.out, span))
                        .otherwise(done.out).alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(False).alias("inside"),
                     F.array().cast(SPANS).alias("out"))
    return F.when(F.size(cut) > 1, F.aggregate(cut, start, step, lambda done: done.out)
                  ).otherwise(F.array().cast(SPANS))


def _before(spans: Column, is_part, value, pick) -> Column:
    """For each span, ``pick`` over ``value`` of the parts before it (null if none)."""
    def step(done, s):
        known = F.when(is_part(s), pick(F.coalesce(done.at, value(s)), value(s))).otherwise(done.at)
        return F.struct(known.alias("at"), F.array_append(done.out, done.at).alias("out"))

    start = F.struct(F.lit(None).cast("long").alias("at"),
                     F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(spans, start, step, lambda done: done.out)


def _near(rows: DataFrame, name: str, is_part) -> DataFrame:
    """Adds to each of ``_spans`` whether a part lies at most ``SCOPE`` code points away."""
    rows = rows.withColumns({
        "_last": _before(F.col("_spans"), is_part, lambda s: s.end, F.greatest),
        "_next": F.reverse(_before(F.reverse("_spans"), is_part, lambda s: s.start, F.least))})

    def flag(s, i):
        return s.withField(name, F.coalesce(s.start - F.get("_last", i) <= SCOPE, F.lit(False))
                           | F.coalesce(F.get("_next", i) - s.end <= SCOPE, F.lit(False)))

    return rows.withColumn("_spans", F.transform("_spans", flag)).drop("_last", "_next")


def found(docs: DataFrame, kept: Column) -> DataFrame:
    """``kept`` and ``findings`` of every row: strong spans, and weak ones near their complements.

    ``findings`` is an array of (start, kind, end, name), sorted; positions are code points,
    ``end`` exclusive. All is done inside the row, so no text is shuffled.
    """
    order = {name: i for i, name in enumerate(KINDS)}
    text = F.translate(F.coalesce("text", F.lit("")), MARK, STAND_IN)
    rows = docs.select(kept.alias("_kept"), text.alias("_t"))
    rows = rows.select("_kept", *[_marked(F.col("_t"), kind).alias(f"_{kind}") for kind in KINDS])
    rows = rows.select("_kept", F.sort_array(F.concat(
        *[_hits(F.col(f"_{kind}"), kind) for kind in KINDS])).alias("_spans"))
    rows = _near(rows, "by_access", lambda s: s.kind == order["access"])

    def told(s):
        return (s.kind == order["secret"]) & s.by_access

    rows = _near(rows, "by_secret", lambda s: told(s) | (s.kind == order["assign"]))
    keep = F.filter("_spans", lambda s: (s.kind < len(STRONG)) | told(s) | (
        (s.kind == order["endpoint"]) & s.by_access & s.by_secret))
    names = F.array(*map(F.lit, KINDS))
    return rows.select(F.col("_kept").alias("kept"), F.transform(keep, lambda s: F.struct(
        s.start.alias("start"), s.kind.alias("kind"), s.end.alias("end"),
        F.element_at(names, s.kind + 1).alias("name"))).alias("findings"))


def scan(docs: DataFrame) -> DataFrame:
    """A row for each document: ``doc_id, findings, n_linked`` and the counts of strong kinds.

    Null text counts as empty; repeated rows are scanned one by one; no rows give none; other
    columns are left out.
    """
    def count(test):
        return F.size(F.filter("findings", test)).cast("long")

    def of(kind):
        return lambda f: f.kind == kind

    return found(docs, F.col("doc_id")).select(
        F.col("kept").alias("doc_id"), "findings",
        *[count(of(i)).alias(f"n_{k}") for i, k in enumerate(STRONG)],
        count(lambda f: f.kind >= len(STRONG)).alias("n_linked"))


def _listed(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(
        ":", f["name"], f["start"].cast("string"), f["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    strong = F.filter("findings", lambda f: f.kind < len(STRONG))
    return scan(docs).select(
        "doc_id", *[f"n_{k}" for k in STRONG], F.sha2(_listed(strong), 256).alias("base_sha256"),
        _listed(F.col("findings")).alias("spans"), "n_linked")


def merged(findings: Column) -> Column:
    """Disjoint spans that cover the findings, in order."""
    def add(done, f):
        last = F.element_at(done, -1)
        touches = (F.size(done) > 0) & (f.start <= F.try_element_at(done, F.lit(-1)).end)
        wider = F.struct(last.start.alias("start"), F.greatest(last.end, f.end).alias("end"))
        return F.when(touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider))
                      ).otherwise(F.concat(done, F.array(F.struct(f.start, f.end))))

    return F.aggregate(findings, F.array().cast("array<struct<start:bigint,end:bigint>>"), add)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every reported span replaced by ``[SECRET]``; ``n_chars`` follows the text.

    Rows without findings stay as they are, null texts too.
    """
    rows = found(docs, F.struct(*docs.columns)).select(
        "kept", merged(F.col("findings")).alias("cuts"))
    text, cuts = F.col("kept.text"), F.col("cuts")

    def piece(cut, i):
        at = F.when(i > 0, F.get(cuts, i - 1).end).otherwise(F.lit(0))
        return F.concat(F.substr(text, at + 1, cut.start - at), F.lit(REDACTED))

    rest = F.substr(text, F.element_at(cuts, -1).end + 1)
    clean = F.when(F.size(cuts) > 0, F.concat(
        F.array_join(F.transform(cuts, piece), ""), rest)).otherwise(text)
    out = rows.select("kept", "cuts", clean.alias("clean"))
    counted = F.when(F.size("cuts") > 0, F.char_length("clean").cast("long")
                     ).otherwise(F.col("kept.n_chars")) if "n_chars" in docs.columns else None
    new = {"text": F.col("clean"), "n_chars": counted}
    return out.select(*[new.get(c, F.col(f"kept.`{c}`")).alias(c) for c in docs.columns])
