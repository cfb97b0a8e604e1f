"""Fill-in-middle transformation of whole texts, cut by one repeated capture.

The text is matched once as ``(unit)*``. The matcher keeps every repetition of the group, so the
ends of the captures are the offsets of all units: their number is n, and a cut after c units
lies at the end of capture c. Nothing is counted or searched piece by piece.

The seed, the number and a hash of the id decide form and cuts, so a row gets the same output
wherever and whenever it is made. A text that holds a sentinel stays plain: the output of the
other forms can therefore be taken apart at the sentinels without doubt.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import mapped, texts_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: One code point.
CODE_POINT = "."


@dataclass(frozen=True)
class Rule:
    """``seed`` varies the cuts; of 100 rows ``plain`` stay as they are, of 100 others ``spm``
    put the suffix first. ``unit`` is a pattern whose repetitions make up any text."""

    seed: str = "1"
    plain: int = 10
    spm: int = 20
    unit: str = CODE_POINT

    def __post_init__(self):
        object.__setattr__(self, "_match", regex.compile(f"({self.unit})*", regex.DOTALL).fullmatch)

    def ends(self, text: str) -> list[int]:
        """The offset after each unit."""
        match = self._match(text)
        if match is None:
            raise ValueError(f"the pattern {self.unit} does not make up every text")
        return match.ends(1)

    def numbers(self, key: str) -> tuple[int, ...]:
        digest = hashlib.sha256(f"{self.seed}:{key}".encode()).digest()
        return tuple(int.from_bytes(digest[i:i + 4]) for i in range(0, 16, 4))

    def apply(self, key: str, text: str) -> tuple[int, str, int | None, int | None, str]:
        """Number of units, form, code points of prefix and of middle, and the output."""
        ends = self.ends(text)
        n, (h1, h2, h3, h4) = len(ends), self.numbers(key)
        if not text or h3 % 100 >= 100 - self.plain or any(
                s in text for s in (PREFIX, SUFFIX, MIDDLE)):
            return n, "plain", None, None, text
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        a, b = (ends[c - 1] if c else 0 for c in (a, b))
        head, body, tail = text[:a], text[a:b], text[b:]
        if h4 % 100 < self.spm:
            return n, "spm", a, b - a, f"{SUFFIX}{tail}{PREFIX}{head}{MIDDLE}{body}"
        return n, "psm", a, b - a, f"{PREFIX}{head}{SUFFIX}{tail}{MIDDLE}{body}"


def transform(docs: DataFrame, rule: Rule | None = None) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for every row; no shuffle.

    Null and empty texts give ``plain`` with n 0 and an empty output. A null id hashes as the
    empty string. Repeated rows give equal rows; other columns are left out. Memory grows with
    the units of one text (about 60 bytes each), never with the batch.
    """
    rule = rule or Rule()

    def run(batch):
        keys = batch.column(0).to_pylist()
        rows = [rule.apply("" if k is None else str(k), t)
                for k, t in zip(keys, texts_of(batch.column(1)))]
        names = ("n", "form", "prefix_chars", "middle_chars", "output")
        return {"doc_id": batch.column(0)} | dict(zip(names, map(list, zip(*rows))))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(docs.select("doc_id", "text"), f"doc_id {kind}, n bigint, form string, "
                  "prefix_chars bigint, middle_chars bigint, output string", run)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of, by its sentinels."""
    split_at = F.when(form == "spm", PREFIX).otherwise(SUFFIX)
    front, middle = (F.split_part(output, F.lit(MIDDLE), F.lit(i)) for i in (1, 2))
    first, second = (F.split_part(front, split_at, F.lit(i)) for i in (1, 2))
    first = F.substring(first, len(PREFIX) + 1, 1 << 30)  # the leading sentinel goes
    return F.when(form == "plain", output).when(form == "spm", F.concat(second, middle, first)) \
            .otherwise(F.concat(first, middle, second))
