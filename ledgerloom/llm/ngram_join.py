"""N-gram Jaccard self-join with filters of several global orders.

A document is the set of its distinct word shingles, as 64-bit hashes; documents of one
set are one node. Of two sets with Jaccard similarity t or more, the first
``n - ceil(t * n) + 1`` shingles under *any* order of all shingles share one. Three orders
are used: rarest first, and by hash, ascending and descending. The first order's prefixes
are the index that deals candidates, and a candidate must share prefix shingles under the
other two as well before its sets are fetched and compared exactly. A shared shingle's places
in both orders bound what the sets can have in common, which leaves most pairs out at once.
A set's prefix also tells what it lacks: a hash below its last one that it does not hold. The
shingles that each set of a candidate has and the other lacks under the two hash orders must
not outnumber those that the sizes of both leave it beside the common ones.

Before a pair is made at all, the parities of both sets (how many of their shingles, odd or
even, fall in each of ``PARITIES`` places by hash) are compared in the join of their bucket:
each place in which they differ holds a shingle that one set lacks, so that sets which differ
in more places than their sizes admit shingles are no link. Group members that share most of
their prefixes, but have changed in more places than the threshold admits, are told apart so.

The first order puts shingles known to be frequent last, by their number. Which ones are
known is no matter for the result, since any order is right; so the list is bounded
(``FREQUENT``) and can be broadcast at any size of the input. Documents that are undecided
after a first round are indexed again under their shingles' exact rarity among them.

Candidates of large groups are not all listed: see ``linking``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words
from .common import IdFilter, Scratch, absent, present, raw_texts, sliced, table
from .linking import by_exact_rarity, link_in_buckets

SHINGLE_WORDS = 4
PERCENT = 85
#: Shingles of which the number is known, at most; 16 bytes each are broadcast.
FREQUENT = 1 << 17
#: Shingles that a task counts together before it passes on those that it met again.
COUNTED = 1 << 21
#: Places of a set's parities, 64 to a column.
PARITIES = 256
PARITY = tuple(f"parity{i}" for i in range(PARITIES // 64))


def shingles(texts: list[bytes | None], size: int) -> list[np.ndarray]:
    """Each text's distinct shingles' hashes, ascending; with fewer words than ``size`` all words are one shingle."""
    out: list[np.ndarray] = []
    base = np.uint64(words.BASES[0])
    for group in words.groups([(t or b"").translate(words.FOLD) for t in texts]):
        if len(group) == 1 and len(group[0]) + 1 > words.PART_BYTES:
            held = np.concatenate([words.hashes(part, *words.places(part)) for part in words.parts(group[0])])
            bounds = np.array([0, len(held)])
        else:
            data = b" ".join(group)
            starts, ends = words.places(data)
            held = words.hashes(data, starts, ends)
            bounds = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in group)]))
        whole = held[: max(0, len(held) - size + 1)].copy()
        for i in range(1, size):
            whole = whole * base + held[i : i + len(whole)]
        whole = words.mixed(whole, size)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= size:
                out.append(np.unique(whole[a : b - size + 1]))
            elif b > a:
                one = held[a : a + 1]
                for i in range(a + 1, b):
                    one = one * base + held[i : i + 1]
                out.append(words.mixed(one, b - a))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def prefix_length(n: int, percent: int) -> int:
    return n - (n * percent + 99) // 100 + 1 if n else 0


def _batches(docs: DataFrame, run, schema: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def frequent_shingles(docs: DataFrame, size: int, most: int) -> np.ndarray:
    """Frequent shingles, the less frequent first, over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()
        total = 0

        def counted() -> pa.RecordBatch:
            ids, n = np.unique(np.concatenate(held) if held else np.zeros(0, np.uint64), return_counts=True)
            again = n > 1
            return pa.RecordBatch.from_arrays([pa.array(ids[again].view(np.int64)), pa.array(n[again].astype(np.int64))], names=["shingle", "n"])

        for batch in sliced(batches, 500):
            for found in shingles(raw_texts(batch.column(1)), size):
                mark = xxhash.xxh3_64_intdigest(found.tobytes())
                if mark not in seen:  # copies do not make a shingle frequent
                    seen.add(mark)
                    held.append(found)
                    total += len(held[-1])
            if total >= COUNTED:
                yield counted()
                held, seen, total = [], set(), 0
        yield counted()

    counts = _batches(docs, run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "shingle").limit(most).toArrow()  # bounded by ``most``
    return top.column(0).to_numpy().astype(np.int64).view(np.uint64)[::-1]


def _lists(rows: list[np.ndarray], kind) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*rows, np.zeros(0, kind)]).astype(kind, copy=False)))


ROWS = "row long, doc_id long, h1 long, h2 long, n long, fp1 long, fp2 long, rare array<long>, second array<int>, third array<int>, " + ", ".join(f"{c} long" for c in PARITY)


def _set_marks(found: list[np.ndarray]) -> np.ndarray:
    """128-bit fingerprints of sets, as two signed columns."""
    marks = [xxhash.xxh3_128_intdigest(one.tobytes()) for one in found]
    return np.array([(m >> 64, m & words.MASK) for m in marks], np.uint64).reshape(-1, 2).view(np.int64)


def parities(found: list[np.ndarray]) -> np.ndarray:
    """A row of ``PARITIES`` bits for each set, as signed columns of 64."""
    place = words.mixed(np.concatenate([*found, np.zeros(0, np.uint64)]), 5) % np.uint64(PARITIES)
    of = np.repeat(np.arange(len(found)), [len(one) for one in found]) if found else np.zeros(0, np.int64)
    odd = np.bincount(of * PARITIES + place.astype(np.int64), minlength=len(found) * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8).reshape(len(found), PARITIES), axis=1).view(np.int64)


def parities_admit(percent: int, x: str, y: str) -> str:
    """Condition on two sets (names of their columns follow ``x`` and ``y``): they differ in no more places than a link has shingles in one set only."""
    differ = " + ".join(f"bit_count({x}{c} ^ {y}{c})" for c in PARITY)
    return f"({differ}) * {100 + percent} <= {100 - percent} * ({x}n + {y}n)"


def prefixes(docs: DataFrame, frequent: np.ndarray, size: int, percent: int) -> DataFrame:
    """Of each row: a number, hashes of its text, set size, fingerprint of the set, and its prefixes under three orders.

    The prefixes under the second and third order, the least and the greatest hashes, are cut
    to their first 31 bits: equal shingles stay equal and order is kept, so no pair is lost.
    """
    order = np.argsort(frequent)
    sent = docs.sparkSession.sparkContext.broadcast((frequent[order], order.astype(np.int64) + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, ranks = sent.value
        for batch in sliced(batches, 500):
            found = shingles(raw_texts(batch.column(4)), size)
            flat = np.concatenate([*found, np.zeros(0, np.uint64)])
            rank = np.zeros(len(flat), np.int64)
            if len(known) and len(flat):
                at = np.minimum(np.searchsorted(known, flat), len(known) - 1)
                rank = np.where(known[at] == flat, ranks[at], 0)
            rare, start = [], 0
            others: list[list[np.ndarray]] = [[], []]
            for one in found:
                own = rank[start : start + len(one)]
                start += len(one)
                p = prefix_length(len(one), percent)
                rare.append((one[np.argsort(own, kind="stable")[:p]] if own.any() else one[:p]).view(np.int64))
                keys = (words.mixed(one, 1) >> np.uint64(33)).astype(np.int32)
                others[0].append(np.partition(keys, p - 1)[:p] if p else keys)
                others[1].append(np.partition(keys, len(keys) - p)[len(keys) - p :] if p else keys)
            fp, odd = _set_marks(found), parities(found)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(list(map(len, found)), pa.int64()), pa.array(fp[:, 0]), pa.array(fp[:, 1]), _lists(rare, np.int64), *(_lists(x, np.int32) for x in others), *(pa.array(odd[:, i]) for i in range(len(PARITY)))], names=["row", "doc_id", "h1", "h2", "n", "fp1", "fp2", "rare", "second", "third", *PARITY])

    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "h1", "h2", "text").mapInArrow(run, ROWS)


def postings(nodes: DataFrame, percent: int, wanted: IdFilter) -> DataFrame:
    """(bucket, id, n, most, weight, parities) of the prefix shingles in the filter: with one at place k in common, sets can't share more than the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2000):
            flat = batch.column(2).flatten()
            kept = np.flatnonzero(wanted.mask(batch.column(3).flatten()))
            lengths = batch.column(2).value_lengths().to_numpy()
            of = np.repeat(np.arange(len(lengths)), lengths)[kept]
            place = kept - np.repeat(np.cumsum(lengths) - lengths, lengths)[kept]
            n = batch.column(1).to_numpy()[of]
            yield pa.RecordBatch.from_arrays([flat.take(pa.array(kept)), pa.array(batch.column(0).to_numpy()[of]), pa.array(n), pa.array((100 + percent) * (n - place) // percent - n), *(batch.column(i).take(pa.array(of)) for i in range(4, batch.num_columns))], names=["bucket", "id", "n", "most", "weight", *PARITY])

    positions = F.transform("rare", lambda x: IdFilter.position(x))
    return nodes.select("row", "n", "rare", positions.alias("at"), "weight", *PARITY).mapInArrow(run, "bucket long, id long, n long, most long, weight long, " + ", ".join(f"{c} long" for c in PARITY))


def lacking(pairs: DataFrame, percent: int) -> DataFrame:
    """``pairs`` without those in which a set has more shingles that the other lacks than a Jaccard similarity of ``percent`` admits.

    For x of a and b: its size n_x, its least and greatest hashes least_x and most_x, and the
    last of each, up_to_x and down_to_x. What lies before a set's last hash is known whole.
    """
    common = f"({percent} * (n_a + n_b) + {99 + percent}) div {100 + percent}"
    below, above = (f"array_except(filter({{x}}, v -> v {sign} {{last}}), {{y}})" for sign in "<>")
    own = "size(array_union({}, {})) <= n_{} - {}"
    for x, y in ("ab", "ba"):
        one = below.format(x=f"least_{x}", y=f"least_{y}", last=f"up_to_{y}")
        two = above.format(x=f"most_{x}", y=f"most_{y}", last=f"down_to_{y}")
        pairs = pairs.filter(own.format(one, two, x, common))
    return pairs


def whole_sets(docs: DataFrame, wanted: IdFilter, size: int) -> DataFrame:
    """(doc_id, fp1, fp2, shingles) of the rows whose doc_id passes the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2000):
            for part in sliced([batch.filter(wanted.mask(batch.column(2)))], 200):
                found = shingles(raw_texts(part.column(1)), size)
                fp = _set_marks(found)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp[:, 0]), pa.array(fp[:, 1]), _lists([x.view(np.int64) for x in found], np.int64)], names=["doc_id", "fp1", "fp2", "shingles"])

    return docs.select("doc_id", "text", IdFilter.position(F.col("doc_id")).alias("at")).mapInArrow(run, "doc_id long, fp1 long, fp2 long, shingles array<long>")


def _judged(scratch: Scratch, docs: DataFrame, size: int, percent: int, frequent: int) -> DataFrame:
    """doc_id, h1, h2, n, class, least, members of each row: its text's hashes, its component, that one's least doc_id and number of rows."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = docs.withColumns(text_marks(F.col("text")))
    rows = scratch.cut(prefixes(marked, frequent_shingles(docs, size, frequent), size, percent), "prefixes")
    key = ["fp1", "fp2", "n"]
    named = rows.filter("doc_id IS NOT NULL AND n > 0")
    # A set's node is the number of its first row.
    sets = scratch.cut(named.groupBy(*key).agg(F.min(F.struct("row", "doc_id")).alias("first"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("weight")).select(F.col("first.row").alias("id"), F.col("first.doc_id").alias("doc_id"), *key, "least", "weight"), "sets")
    # Rows of repeated sets: the first has its set's weight, the others are copies and have 0. The rest is told from them without a shuffle.
    again = named.select("row", *key).join(sets.filter("weight > 1").select("id", *key, "weight"), key)
    again = scratch.cut(again.select("row", F.when(F.col("row") == F.col("id"), F.col("weight")).otherwise(0).alias("weight")), "repeated")
    wide, rowids = named.select("row", "n", "rare", "second", "third", *PARITY), again.select("row")
    weighed = present(wide, "row", rowids).join(again, "row", "left").withColumn("weight", F.coalesce("weight", F.lit(1).cast("long"))).filter("weight > 0")
    nodes = scratch.cut(absent(wide, "row", rowids).withColumn("weight", F.lit(1).cast("long")).unionByName(weighed), "nodes")
    shared = nodes.select(F.explode("rare").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("nodes")).filter("nodes > 1").select("id")
    shared = scratch.cut(shared, "shared")
    met = scratch.cut(postings(nodes, percent, IdFilter.of(shared)).join(shared.withColumnRenamed("id", "bucket"), "bucket"), "met")

    def sets_of(ids: DataFrame) -> DataFrame:
        mark = ["doc_id", "fp1", "fp2"]
        wanted = scratch.cut(sets.join(ids, "id", "left_semi").select("id", *mark), "wanted")
        held = whole_sets(docs, IdFilter.of(wanted.select(F.col("doc_id").alias("id"))), size).join(wanted, mark)
        # A mark has one id; grouped by the join's own key, the sets are not shuffled again.
        held = held.groupBy(*mark).agg(F.first("id").alias("id"), F.first("shingles").alias("shingles")).select("id", "shingles")
        held = scratch.cut(held, "whole-sets")
        scratch.drop(wanted)
        return held

    def verify(pairs: DataFrame) -> DataFrame:
        """Pairs that share prefix shingles under the other two orders as well, lack few of each other's, and share enough of all."""
        pairs = scratch.cut(pairs, "pairs")
        asked = scratch.cut(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "asked")
        some = present(nodes.select("row", "n", "second", "third"), "row", asked).select("*", F.array_max("second").alias("up_to"), F.array_min("third").alias("down_to"))
        names = {"row": "", "n": "n_", "second": "least_", "third": "most_", "up_to": "up_to_", "down_to": "down_to_"}
        one, two = (some.select(*(F.col(c).alias(f"{name}{x}") for c, name in names.items())) for x in "ab")
        met = pairs.join(one, "a").join(two, "b").filter("arrays_overlap(least_a, least_b) AND arrays_overlap(most_a, most_b)")
        kept = scratch.cut(lacking(met, percent).select("a", "b"), "candidates")
        held = sets_of(kept.select(F.explode(F.array("a", "b")).alias("id")).distinct())
        one, two = (held.select(F.col("id").alias(x), F.col("shingles").alias(f"s{x}")) for x in "ab")
        common = F.size(F.array_intersect("sa", "sb"))
        links = kept.join(one, "a").join(two, "b").filter(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b")
        links = scratch.cut(links, "links")
        scratch.drop(pairs, asked, kept, held)
        return links

    linked = link_in_buckets(scratch, met, verify, lambda items: by_exact_rarity(scratch, sets_of(items.select("id")), items, percent), marks=PARITY, near=lambda x, y: parities_admit(percent, x, y))
    scratch.drop(met, nodes, shared)
    of = sets.join(linked, "id", "left").select(*key, "least", "weight", F.coalesce("component", "id").alias("class"))
    wide = of.join(linked.select(F.col("component").alias("class")).distinct(), "class", "left_semi").groupBy("class").agg(F.min("least").alias("least_doc"), F.sum("weight").alias("rows"))
    of = of.join(wide, "class", "left").select(*key, "class", F.coalesce("least_doc", "least").alias("least"), F.coalesce("rows", "weight").alias("members"))
    of = scratch.cut(of, "classes")
    return rows.select("row", "doc_id", "h1", "h2", *key).join(of, key, "left").select("doc_id", "h1", "h2", "n", F.when(F.col("doc_id").isNotNull(), F.col("class")).alias("class"), F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("least"), F.when(F.col("doc_id").isNotNull(), F.col("members")).alias("members"))


def text_marks(text: Column) -> dict[str, Column]:
    """128 bits that tell texts apart."""
    return {"h1": F.xxhash64(text), "h2": F.xxhash64(F.lit(1), text)}


def ngram_components(spark: SparkSession, docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of ``docs`` (doc_id, text).

    Null and empty texts have no shingles and are linked with nothing: their component is
    their doc_id. A row without doc_id is linked with nothing and has a null component. Rows
    that repeat a doc_id stay rows of their own, each judged by its own text. A text of any
    length is one row's work. Other columns are ignored; an empty table gives an empty result.
    """
    found = _judged(Scratch(spark, "ngram-join"), docs, size, percent, frequent)
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.col("least").alias("component_id"))


def one_of_each(spark: SparkSession, docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, but for those with a row of a smaller (doc_id, hash of the text) in their component.

    Rows without doc_id and texts without words stay. Rows with the same doc_id and the same
    text are one document: all stay or all go. Rows that share a doc_id only are judged apart.
    """
    scratch = Scratch(spark, "ngram-gone")
    found = _judged(scratch, docs, size, percent, FREQUENT).filter("members > 1").select("class", F.struct("doc_id", "h1", "h2").alias("mark"))
    found = scratch.cut(found, "grouped")
    kept = found.groupBy("class").agg(F.min("mark").alias("first"))
    gone = found.join(kept, "class").filter("mark <> first").select(*(F.col(f"mark.{c}").alias(f"_gone_{c}") for c in ("doc_id", "h1", "h2"))).distinct()
    gone = scratch.cut(gone, "gone")
    keyed = docs.withColumn("_gone_key", F.col("doc_id").cast("long"))
    ids = gone.select("_gone_doc_id")
    maybe = present(keyed, "_gone_key", ids)
    marks = text_marks(maybe["text"].cast("string"))
    same = (maybe["_gone_key"] == gone["_gone_doc_id"]) & (marks["h1"] == gone["_gone_h1"]) & (marks["h2"] == gone["_gone_h2"])
    return absent(keyed, "_gone_key", ids).unionByName(maybe.join(gone, same, "left_anti")).select(*docs.columns)


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(spark, table(spark, sf_dir, "documents"))


#: Candidates share one of the rarest shingles that any order's prefix must hold; components by a recursive walk.
OP5_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, list_aggregate(w[i:i + least(len(w), 4) - 1], 'string_agg', ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM w WHERE len(w) > 0)),
s AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
df AS (SELECT g, count(*) AS df FROM g GROUP BY g),
r AS (SELECT doc_id, g, n, row_number() OVER (PARTITION BY doc_id ORDER BY df, g) AS k FROM g JOIN df USING (g) JOIN s USING (doc_id)),
p AS (SELECT doc_id, g, n FROM r WHERE k <= n - (n * 85 + 99) // 100 + 1),
c AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb FROM p a JOIN p b ON a.g = b.g AND a.doc_id < b.doc_id),
l AS (SELECT a, b FROM (SELECT a, b, na, nb, count(*) AS i FROM c JOIN g x ON x.doc_id = a JOIN g y ON y.doc_id = b AND y.g = x.g GROUP BY a, b, na, nb) WHERE 100 * i >= 85 * (na + nb - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
walk AS (SELECT doc_id AS id, doc_id AS root FROM s UNION SELECT e.b, walk.root FROM walk JOIN e ON e.a = walk.id),
m AS (SELECT id, min(root) AS component_id FROM walk GROUP BY id)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id
FROM w LEFT JOIN s ON s.doc_id = w.doc_id LEFT JOIN m ON m.id = w.doc_id
"""
