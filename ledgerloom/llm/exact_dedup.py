"""Exact deduplication by composable polynomial fingerprints.

A text is normalised, cut into chunks, and each chunk gets a polynomial hash under two
primes. Two hashes combine by shifting the left one by the length of the right one,
``h(a + b) = h(a) * base ** len(b) + h(b)``, so that chunks of a huge document may be
hashed apart and in any grouping: those of a text of more than ``LONG_CHUNKS`` chunks are
spread over tasks, and their hashes meet in an aggregate. Rows are grouped by (fingerprint, length); the members
of every group of two or more are then compared chunk by chunk: a task compares each chunk
with the first one it has seen under its (fingerprint, length, chunk number) and passes on
only chunks that differ, and Spark counts the different contents of each. Where
fingerprints collide, the group is split by whole text.

Shuffled are (doc_id, fingerprint, length, digest) rows, the chunks of long texts, the texts
whose fingerprint repeats (a bounded bitmap leaves most others behind; beyond what it can tell
apart, more texts reach the exact join) and one copy per task of the repeated chunks. A hot
group costs one partial aggregate row per task, and the last join runs between two written
tables, where adaptive execution splits skewed partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, present, raw_texts, sliced, table

PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1442695041)
CHUNK_BYTES = 1 << 18
LONG_CHUNKS = 16
_BLANKS = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


def normalise(text: bytes | None) -> bytes:
    """One space for each run of ASCII white space; nothing is trimmed; null is empty."""
    out = (text or b"").translate(_BLANKS)
    while b"  " in out:
        out = out.replace(b"  ", b" ")
    return out


def chunks(text: bytes, size: int) -> Iterator[bytes]:
    """An empty text has one empty chunk."""
    for start in range(0, max(len(text), 1), size):
        yield text[start : start + size]


class Fingerprints:
    """Hashes under ``primes``; fewer or smaller primes serve tests of collisions."""

    def __init__(self, primes: tuple[int, ...] = PRIMES, bases: tuple[int, ...] = BASES, size: int = CHUNK_BYTES):
        self.primes, self.bases, self.size = primes, bases, size
        self.powers: list[np.ndarray] = []
        for prime, base in zip(primes, bases):
            row = np.ones(1, np.uint64)
            while len(row) < size:
                row = np.concatenate([row, row * np.uint64(pow(base, len(row), prime)) % np.uint64(prime)])
            self.powers.append(np.ascontiguousarray(row[:size][::-1]))

    def chunk(self, data: bytes) -> tuple[tuple[int, ...], int]:
        """(hash under each prime, length); bytes count from 1, so leading zeros matter."""
        values = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
        return tuple(int(np.dot(values, row[self.size - len(values) :]) % np.uint64(prime)) for row, prime in zip(self.powers, self.primes)), len(data)

    def combine(self, left: tuple[tuple[int, ...], int], right: tuple[tuple[int, ...], int]) -> tuple[tuple[int, ...], int]:
        shifted = tuple((a * pow(base, right[1], prime) + b) % prime for a, b, base, prime in zip(left[0], right[0], self.bases, self.primes))
        return shifted, left[1] + right[1]

    def of(self, text: bytes) -> tuple[int, int]:
        """(fingerprint as one signed 64-bit number, length in bytes)."""
        return self.whole(map(self.chunk, chunks(text, self.size)))

    def whole(self, parts: Iterable[tuple[tuple[int, ...], int]]) -> tuple[int, int]:
        """As ``of``, from the hashes of all chunks in order."""
        hashes, length = reduce(self.combine, parts)
        return reduce(lambda acc, x: acc << 31 | x, hashes), length


_MADE: dict[tuple, Fingerprints] = {}


def _fingerprints(*args) -> Fingerprints:
    if args not in _MADE:
        _MADE[args] = Fingerprints(*args)
    return _MADE[args]


DIGESTS = "doc_id long, fp long, n_bytes long, text_sha256 string"


def digests(docs: DataFrame, primes=PRIMES, bases=BASES, size: int = CHUNK_BYTES, with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``; ``with_text`` adds the normalised text, and hashes each text in its row's task."""

    def run(batches):
        prints = _fingerprints(primes, bases, size)
        for batch in sliced(batches, 2000):
            texts = [normalise(x) for x in raw_texts(batch.column(1))]
            marks = [prints.of(x) for x in texts]
            out = {"doc_id": batch.column(0), "fp": pa.array([m[0] for m in marks], pa.int64()), "n_bytes": pa.array([m[1] for m in marks], pa.int64()), "text_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string())}
            if with_text:
                out["text"] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_pydict(out)

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if with_text:
        return docs.mapInArrow(run, DIGESTS + ", text string")
    long = F.coalesce(F.octet_length("text"), F.lit(0)) > LONG_CHUNKS * size
    return docs.filter(~long).mapInArrow(run, DIGESTS).unionByName(_digests_by_chunk(docs.filter(long), primes, bases, size))


def _digests_by_chunk(docs: DataFrame, primes, bases, size: int) -> DataFrame:
    """As ``digests``; the chunks of a text are hashed in many tasks."""

    def cut(batches):
        for batch in sliced(batches, 1):
            text = normalise(raw_texts(batch.column(2))[0])
            sha = hashlib.sha256(text).hexdigest()
            for no, chunk in enumerate(chunks(text, size)):
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([sha]), pa.array([no], pa.int64()), pa.array([chunk], pa.binary())], names=["row", "doc_id", "text_sha256", "no", "chunk"])

    def hashed(batches):
        prints = _fingerprints(primes, bases, size)
        for batch in batches:
            parts = [prints.chunk(x) for x in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array([list(h) for h, _ in parts], pa.list_(pa.int64())), pa.array([n for _, n in parts], pa.int64())], names=["row", "doc_id", "text_sha256", "no", "hashes", "n"])

    def joined(batches):
        prints = _fingerprints(primes, bases, size)
        for batch in batches:
            marks = [prints.whole((tuple(x["hashes"]), x["n"]) for x in parts) for parts in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([m[0] for m in marks], pa.int64()), pa.array([m[1] for m in marks], pa.int64()), batch.column(1)], names=["doc_id", "fp", "n_bytes", "text_sha256"])

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    pieces = numbered.mapInArrow(cut, "row long, doc_id long, text_sha256 string, no long, chunk binary").repartition("row", "no")
    marks = pieces.mapInArrow(hashed, "row long, doc_id long, text_sha256 string, no long, hashes array<long>, n long")
    parts = F.sort_array(F.collect_list(F.struct("no", "hashes", "n"))).alias("parts")  # a few numbers for each chunk
    return marks.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("text_sha256").alias("text_sha256"), parts).select("doc_id", "text_sha256", "parts").mapInArrow(joined, DIGESTS)


def _differing_chunks(docs: DataFrame, primes, bases, size: int) -> DataFrame:
    """(fp, n_bytes, chunk_no, chunk): in each slice the first chunk under a key and those that differ from it."""

    def run(batches):
        prints = _fingerprints(primes, bases, size)
        for batch in sliced(batches, 2000):
            first: dict[tuple[int, int, int], bytes] = {}
            found: set[tuple[int, int, int, bytes]] = set()
            for raw in raw_texts(batch.column(0)):
                text = normalise(raw)
                mark = prints.of(text)
                for no, chunk in enumerate(chunks(text, size)):
                    if first.setdefault((*mark, no), chunk) != chunk:
                        found.add((*mark, no, chunk))
            found.update((*k, v) for k, v in first.items())
            rows = list(zip(*found)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["fp", "n_bytes", "chunk_no", "chunk"])

    return docs.select("text").mapInArrow(run, "fp long, n_bytes long, chunk_no long, chunk binary")


def exact_dedup(spark: SparkSession, docs: DataFrame, primes=PRIMES, bases=BASES, size: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of ``docs`` (doc_id, text).

    Null text is empty. The smallest doc_id of a group stays; nulls count as the largest,
    and a group without any doc_id has a null keep_id. Repeated rows with the doc_id that
    stays are all marked kept, as nothing tells them apart. Other columns are ignored.
    """
    scratch = Scratch(spark, "exact-dedup")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = scratch.cut(digests(docs, primes, bases, size), "digests")
    key = ["fp", "n_bytes"]
    groups = scratch.cut(rows.groupBy(*key).agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).filter("group_size > 1"), "groups")
    repeated = rows.join(groups, key, "left_semi").select("doc_id").distinct()
    repeated = scratch.cut(repeated, "repeated")
    texts = present(docs, "doc_id", repeated).alias("d").join(repeated.alias("r"), F.expr("d.doc_id <=> r.doc_id"), "left_semi")
    differing = scratch.cut(_differing_chunks(texts, primes, bases, size).distinct().groupBy(*key, "chunk_no").agg(F.count(F.lit(1)).alias("contents")).filter("contents > 1").select(*key).distinct(), "collisions")
    plain = rows
    split = None
    if not differing.isEmpty():  # equal fingerprints of different texts: group these rows by text
        plain = rows.join(differing, key, "left_anti")
        clashing = rows.join(differing, key, "left_semi").select("doc_id").distinct()
        whole = digests(docs.join(clashing, docs.doc_id.eqNullSafe(clashing.doc_id), "left_semi"), primes, bases, size, with_text=True).join(differing, key, "left_semi")
        whole = scratch.cut(whole, "clashing")
        classes = scratch.cut(whole.groupBy("text").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "classes")
        split = whole.join(classes, "text").select("doc_id", "keep_id", "group_size", "text_sha256")
    out = plain.join(groups, key, "left").select("doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), "text_sha256")
    if split is not None:
        out = out.unionByName(split)
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, table(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM t
"""
