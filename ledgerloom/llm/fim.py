"""Fill-in-middle transformation on a rope.

A text becomes a rope: leaves of at most ``LEAF`` units, each with its numbers of units, code
points and bytes, under nodes that hold the sums of theirs. It is split at two unit ranks, and
the three subtrees are put together again in another order with sentinels between them. The
output is turned back by splitting its own rope at the places of the sentinels. A split walks
down one path and shares all subtrees beside it, so no text is copied before it is written.

Each row is judged by itself from its text and doc_id, so the transformation is a map without a
shuffle; a row holds one text and its rope.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import raw_texts, sliced, table

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Texts of 100 that are transformed, and of these the ones with the suffix first.
RATE, SPM = 50, 80
LEAF = 256
_UNIT = re.compile(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
_UNITS = re.compile(rb"(?:[\x20\x09-\x0D]*[^\x20\x09-\x0D]+){1,%d}|[\x20\x09-\x0D]+" % LEAF)
_LATER_BYTES = bytes(range(0x80, 0xC0))


def _points(data: bytes) -> int:
    return len(data.translate(None, _LATER_BYTES))


@dataclass(frozen=True, slots=True)
class Rope:
    """A leaf has ``data``; a node has both sides and the sums of their counts."""

    units: int
    points: int
    size: int
    data: bytes | None = None
    left: Rope | None = None
    right: Rope | None = None

    @staticmethod
    def leaf(data: bytes, units: int | None = None) -> Rope:
        return Rope(len(_UNIT.findall(data)) if units is None else units, _points(data), len(data), data)

    @staticmethod
    def of(text: bytes) -> Rope:
        """A balanced rope whose leaves begin and end with whole units."""
        row = [Rope.leaf(m.group()) for m in _UNITS.finditer(text)] or [EMPTY]
        while len(row) > 1:
            row = [row[i].joined(row[i + 1]) if i + 1 < len(row) else row[i] for i in range(0, len(row), 2)]
        return row[0]

    def joined(self, other: Rope) -> Rope:
        if not self.size or not other.size:
            return self if self.size else other
        return Rope(self.units + other.units, self.points + other.points, self.size + other.size, None, self, other)

    def split(self, rank: int) -> tuple[Rope, Rope]:
        """The first ``rank`` units, and the rest."""
        return self._split(rank, "units", _unit_end)

    def split_bytes(self, rank: int) -> tuple[Rope, Rope]:
        return self._split(rank, "size", lambda data, n: n)

    def _split(self, rank: int, measure: str, end) -> tuple[Rope, Rope]:
        before, after, at = [], [], self
        while True:
            if rank <= 0:
                after.append(at)
                break
            if rank >= getattr(at, measure):
                before.append(at)
                break
            if at.data is not None:
                cut = end(at.data, rank)
                before.append(Rope.leaf(at.data[:cut]))
                after.append(Rope.leaf(at.data[cut:]))
                break
            held = getattr(at.left, measure)
            if rank < held:
                after.append(at.right)
                at = at.left
            else:
                before.append(at.left)
                at, rank = at.right, rank - held
        low, high = EMPTY, EMPTY
        for part in reversed(before):
            low = part.joined(low)
        for part in reversed(after):
            high = high.joined(part)
        return low, high

    def leaves(self) -> Iterator[bytes]:
        stack = [self]
        while stack:
            at = stack.pop()
            if at.data is None:
                stack += [at.right, at.left]
            else:
                yield at.data

    def text(self) -> bytes:
        return b"".join(self.leaves())


EMPTY = Rope(0, 0, 0, b"")


def _unit_end(data: bytes, rank: int) -> int:
    for n, m in enumerate(_UNIT.finditer(data), 1):
        if n == rank:
            return m.end()
    return len(data)


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers of 32 bits that depend on the seed and the doc_id; a null one has no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def transformed(doc_id: int | None, text: bytes, rate: int = RATE, spm: int = SPM, seed: int = 42) -> tuple[int, str, bytes, int | None, int | None]:
    """(units, form, output, code points of the prefix, of the middle)."""
    rope = Rope.of(text)
    h = draws(doc_id, seed)
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= rate:
        return rope.units, "plain", text, None, None
    cuts = sorted(x % (rope.units + 1) for x in h[:2])
    head, suffix = rope.split(cuts[1])
    prefix, middle = head.split(cuts[0])
    p, s, m = (Rope.leaf(x, 0) for x in (PREFIX, SUFFIX, MIDDLE))
    form, parts = ("spm", (s, suffix, p, prefix, m, middle)) if h[3] % 100 < spm else ("psm", (p, prefix, s, suffix, m, middle))
    out = EMPTY
    for part in parts:
        out = out.joined(part)
    return rope.units, form, out.text(), prefix.points, middle.points


def restored(output: bytes, form: str) -> bytes:
    """The text that ``output`` was made of: its rope is split at the sentinels."""
    if form == "plain":
        return output
    first, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    at, last = output.index(second), output.index(MIDDLE)
    rope, middle = Rope.of(output).split_bytes(last)
    _, middle = middle.split_bytes(len(MIDDLE))
    one, two = rope.split_bytes(at)
    _, one = one.split_bytes(len(first))
    _, two = two.split_bytes(len(second))
    prefix, suffix = (two, one) if form == "spm" else (one, two)
    return prefix.joined(middle).joined(suffix).text()


_ADDED = [("n", "long"), ("form", "string"), ("prefix_chars", "long"), ("middle_chars", "long")]


def fill_in_middle(docs: DataFrame, rate: int = RATE, spm: int = SPM, seed: int = 42) -> DataFrame:
    """doc_id, output, n, form, prefix_chars and middle_chars for each row of ``docs`` (doc_id, text).

    ``rate`` of 100 texts are transformed, ``spm`` of 100 of those have the suffix first; which
    ones follows from the seed and doc_id alone, so that rows with one doc_id and repeated rows
    are treated alike. Null text is empty; empty texts and those that hold a sentinel stay
    plain. A null doc_id draws as the empty one. Other columns are ignored.
    """

    def run(batches):
        for batch in sliced(batches, 500):
            out = [transformed(i, t or b"", rate, spm, seed) for i, t in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1)))]
            columns = list(zip(*out)) or [()] * 5
            n, form, output, prefix, middle = (pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.int64())))
            yield pa.RecordBatch.from_arrays([batch.column(0), output.cast(pa.string()), n, form, prefix, middle], names=["doc_id", "output", *(k for k, _ in _ADDED)])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, ", ".join(["doc_id long, output string", *(f"{k} {t}" for k, t in _ADDED)]))


def restore(found: DataFrame) -> DataFrame:
    """``found`` (output, form and others) with ``restored``, the exact text that each output was made of."""
    @F.pandas_udf("string")
    def back(output: pd.Series, form: pd.Series) -> pd.Series:
        return pd.Series([restored(o.encode(), f).decode() for o, f in zip(output, form)], dtype=object)

    return found.withColumn("restored", back("output", "form"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = restore(fill_in_middle(table(spark, sf_dir, "documents")))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
cut AS (SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units FROM d),
drawn AS (SELECT *, CAST(len(units) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
                 CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM cut),
placed AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                       WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, array_to_string(units[1:a], '') AS pre, array_to_string(units[a + 1:b], '') AS mid, array_to_string(units[b + 1:], '') AS suf FROM placed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
