"""Benchmark decontamination with one Aho-Corasick automaton.

Texts are normalised to words joined by single spaces. Every window of ``window``
consecutive words of a benchmark item becomes a pattern with a space at either end, so
that it matches whole words only; an item of fewer words is one window. Each text is
scanned once, and offsets of matches are mapped to words and to the original text.

The benchmark is the stated small side. It is read to the driver in blocks of at most
``block_bytes`` of text, and each block gets one automaton that is broadcast, so what is
broadcast has a fixed bound however large the benchmark is; most benchmarks are one block.
Documents are never shuffled for one block; for several, hits are merged by document.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, raw_texts, table

WINDOW = 10
BLOCK_BYTES = 4 << 20
#: ASCII letters to lower case, other ASCII characters but digits to spaces.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


def windows(item: list[bytes], size: int) -> set[bytes]:
    return {b" %b " % b" ".join(item[i : i + size]) for i in range(max(1, len(item) - size + 1))} if item else set()


def automaton(items: list[tuple[object, bytes | None]], size: int) -> ahocorasick.Automaton | None:
    """A pattern's value: its number of words and the numbers of the items that hold it."""
    held: dict[bytes, set[int]] = {}
    for no, (_, text) in enumerate(items):
        for pattern in windows(words(text), size):
            held.setdefault(pattern, set()).add(no)
    if not held:
        return None
    out = ahocorasick.Automaton()
    for pattern, nos in held.items():
        out.add_word(pattern.decode("latin-1"), (pattern.count(b" ") - 1, tuple(nos)))
    out.make_automaton()
    return out


def scan(found: ahocorasick.Automaton | None, text: bytes | None) -> tuple[int, list[tuple[int, int]], set[int]]:
    """(words, merged ranges of hit words, numbers of items found)."""
    held = words(text)
    if found is None or not held:
        return len(held), [], set()
    flat = b" %b " % b" ".join(held)
    ranges: list[tuple[int, int]] = []
    items: set[int] = set()
    at = last = 0
    for end, (n, nos) in found.iter(flat.decode("latin-1")):
        at += flat.count(b" ", last, end + 1)  # spaces up to the match's last one
        last = end + 1
        stop = at - 1
        items.update(nos)
        start = stop - n
        while ranges and ranges[-1][1] >= start:
            start = min(start, ranges.pop()[0])
        ranges.append((start, stop))
    return len(held), ranges, items


def spans(text: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of words as code-point offsets of the original text."""
    places = [m.span() for m in _WORD.finditer(text)] if ranges else []
    return [(len(text[: places[a][0]].decode()), len(text[: places[b - 1][1]].decode())) for a, b in ranges]


_LOADED: dict[str, ahocorasick.Automaton | None] = {}


def _load(key: str, sent: Broadcast, size: int) -> ahocorasick.Automaton | None:
    """A worker builds the automaton of a block once, and holds one at a time."""
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = automaton(sent.value, size)
    return _LOADED[key]


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[tuple[list[tuple[object, bytes]], bool]]:
    """Items in blocks, and whether a block is the last; the driver holds one block and one fetched partition at a time."""
    block: list[tuple[object, bytes]] = []
    held = 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).filter("item_id IS NOT NULL AND text IS NOT NULL").toLocalIterator():
        data = row.text.encode()
        if block and held + len(data) > block_bytes:
            yield block, False
            block, held = [], 0
        block.append((row.item_id, data))
        held += len(data)
    yield block, True


PAIRS_DDL = "array<struct<start: bigint, stop: bigint>>"


def _as_pairs(rows: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"start": a, "stop": b} for a, b in r] for r in rows], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))


HITS = "{}n_words long, hits array<struct<start: long, stop: long>>, spans array<struct<start: long, stop: long>>, items array<string>"


def _scanned(docs: DataFrame, sent: Broadcast, size: int, with_spans: bool) -> DataFrame:
    key = uuid.uuid4().hex
    position = docs.columns.index("text")

    def run(batches):
        found, names = _load(key, sent, size), [x for x, _ in sent.value]
        for batch in batches:
            texts = raw_texts(batch.column(position))
            got = [scan(found, x) for x in texts]
            extra = [
                pa.array([g[0] for g in got], pa.int64()),
                _as_pairs([g[1] for g in got]),
                _as_pairs([spans(t, g[1]) if with_spans and g[1] else [] for t, g in zip(texts, got)]),
                pa.array([sorted(names[i] for i in g[2]) for g in got], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns) if i != position), *extra], names=[*(c for c in batch.schema.names if c != "text"), "n_words", "hits", "spans", "items"])

    kept = [f for f in docs.schema.fields if f.name != "text"]
    return docs.mapInArrow(run, HITS.format("".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)))


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, with_spans: bool = True, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, items, spans, of each row of ``docs`` (doc_id, text).

    Null or empty texts have no words and no hits; null items or items without words never
    occur; an item listed twice counts once. ``spans`` are code-point ranges of the original
    text, one for each run of hit words. Rows with a repeated or null doc_id stay rows of
    their own. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scratch = parts = texts = None
    for block, last in _blocks(benchmark, block_bytes):
        sent = spark.sparkContext.broadcast(block)
        if parts is None and last:
            found = _scanned(docs, sent, window, with_spans)
            merged = found.withColumn("n_hit", F.expr("aggregate(hits, 0L, (acc, x) -> acc + x.stop - x.start)"))
            return merged.select("doc_id", "n_words", "n_hit", F.array_distinct("items").alias("items"), "spans")
        if parts is None:
            scratch, parts = Scratch(spark, "decontaminate"), []
            texts = docs = scratch.cut(docs.withColumn("row", F.monotonically_increasing_id()), "rows")
        parts.append(scratch.cut(_scanned(docs, sent, window, False), "block"))
        sent.destroy()  # its result is written
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    all_of = lambda c: F.array_sort(F.flatten(F.collect_list(c)))  # noqa: E731  one row for each block
    one = found.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), all_of("hits").alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    # Ranges of different blocks that overlap or touch become one before they are mapped to the text.
    merge = "aggregate(hits, cast(array() as array<struct<start: bigint, stop: bigint>>), (acc, x) -> CASE WHEN size(acc) > 0 AND x.start <= element_at(acc, -1).stop THEN concat(slice(acc, 1, size(acc) - 1), array(named_struct('start', element_at(acc, -1).start, 'stop', greatest(element_at(acc, -1).stop, x.stop)))) ELSE concat(acc, array(named_struct('start', x.start, 'stop', x.stop))) END)"
    one = scratch.cut(one.withColumn("hits", F.expr(merge)), "merged")
    placed = texts.select("row", "text").join(one.filter("size(hits) > 0").select("row", "hits"), "row") if with_spans else texts.select("row", "text").limit(0).withColumn("hits", F.lit(None).cast(PAIRS_DDL))
    out = one.join(placed.mapInArrow(_placed, f"row long, spans {PAIRS_DDL}"), "row", "left").withColumn("spans", F.coalesce("spans", F.expr(f"CAST(array() AS {PAIRS_DDL})")))
    return out.select("doc_id", "n_words", F.expr("aggregate(hits, 0L, (acc, x) -> acc + x.stop - x.start)").alias("n_hit"), "items", "spans")


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [spans(t, [(x["start"], x["stop"]) for x in hits]) for t, hits in zip(raw_texts(batch.column(1)), batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), _as_pairs(found)], names=["row", "spans"])


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no window of the benchmark."""
    for block, _ in _blocks(benchmark, BLOCK_BYTES):
        docs = _without(docs, spark.sparkContext.broadcast(block), window)
    return docs


def _without(docs: DataFrame, sent: Broadcast, window: int) -> DataFrame:
    position = docs.columns.index("text")
    key = uuid.uuid4().hex

    def run(batches):
        found = _load(key, sent, window)
        for batch in batches:
            yield batch.filter(pa.array([not scan(found, x)[1] for x in raw_texts(batch.column(position))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), with_spans=False)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP3_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
bi AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS win FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bi)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT DISTINCT doc_id, n, i, item_id FROM dw JOIN bw USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM m)) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN it ON d.doc_id = it.doc_id
"""
