"""Hard negatives by k-means inverted lists with stored centroid radii.

Components are quantised to integers, so that scores are exact. Every row is put on the list
of its nearest centroid; a list stores the largest distance of its rows from the centroid. By
Cauchy-Schwarz the score of anchor ``a`` with any row of a list lies within ``|a| * radius``
of its score with the centroid. An anchor visits lists by upper bound, skips those whose bounds
lie outside its window of scores, and stops where the bound falls strictly below its kth score.

Lists are dealt into bins of bounded size; a long one is spread over several. A task holds one
bin's rows and reads the anchors that visit it one batch after another (rows and anchors are
one dataset, dealt by bin and sorted so that a bin's rows come first), so a bin meets
every anchor once, as a product of two matrices, and nothing is paired row by row. A search has
two passes: the first visits each anchor's ``SEEDS`` lists of the largest bounds; their kth
score is what later lists are held against. Positives are searched first; their scores give
the negatives' windows, all of an anchor's windows in one visit.

Only the centroids are fitted on a sample (``SAMPLE`` rows at most, those with the smallest
hashes); every row is on a list and the bounds are true for any centroids, so recall is exact.
Broadcast are at most ``MOST_LISTS`` centroids with their radii.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, sliced, table

EVERY = 50
POSITIVES = 5
NEGATIVES = 3
#: Bounds of the window of negative scores, in hundredths of the positive's score.
WINDOW = (50, 95)
MOST_LISTS = 2048
SAMPLE = 1 << 16
ROUNDS = 4
SEEDS = 4
#: Rows of a bin.
BIN_ROWS = 1 << 15
#: Anchors that meet a list's rows together, and rows of a list that do.
TOGETHER, BLOCK = 256, 2048
LAST = (1 << 63) - 1
FIRST = -(1 << 62)


def prepared(rows: DataFrame) -> DataFrame:
    """(vec_id, label, q) of ``rows`` (vec_id, embedding, label) that take part, with planted labels and integer components."""
    whole = F.col("label").isNotNull() & F.col("embedding").isNotNull()
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    vec, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    rows = rows.filter(whole).filter(F.coalesce(finite, F.lit(False)))
    return rows.select(vec.alias("vec_id"), F.when(vec % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("q"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of ``width`` components; what a shorter one lacks is 0."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: in floating point where every partial sum fits, else as long."""
    most = math.sqrt(float((a.astype(float) ** 2).sum(1).max(initial=0)) * float((b.astype(float) ** 2).sum(1).max(initial=0)))
    if most < 2**23:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if most < 2**52:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if most >= 2**62:
        raise ArithmeticError("an inner product of these vectors does not fit into a long")
    return a @ b.T


class Lists:
    """Centroids and radii of the inverted lists."""

    def __init__(self, centroids: np.ndarray, radii: np.ndarray | None = None):
        self.centroids, self.radii = centroids, radii

    def nearest(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's list and its distance from the centroid."""
        x, norms = q.astype(float), (self.centroids**2).sum(1)
        at = np.concatenate([(norms - 2 * (part @ self.centroids.T)).argmin(1) for part in np.array_split(x, max(1, len(x) // 1024))])
        return at, np.sqrt(((x - self.centroids[at]) ** 2).sum(1))

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest score of each anchor with each list; an empty list has none."""
        x = q.astype(float)
        middle = x @ self.centroids.T
        reach = np.sqrt((x**2).sum(1))[:, None] * np.maximum(self.radii, 0)
        reach += 1e-9 * (np.abs(middle) + reach) + 1e-6  # what rounding may take off
        return np.where(self.radii < 0, np.inf, middle - reach), np.where(self.radii < 0, -np.inf, middle + reach)


def _fitted(scratch: Scratch, rows: DataFrame, count: int, width: int, seed: int) -> np.ndarray:
    """Centroids by Lloyd's rounds over the sample; their sums are made by Spark, a row for each list and task."""
    n = min(MOST_LISTS, max(1, math.isqrt(count)))
    mark = F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(1 << 30))
    some = scratch.cut(rows.filter(mark < F.lit(math.ceil((1 << 30) * min(1.0, SAMPLE / count)))).select("q", mark.alias("mark")), "sample")
    start = some.orderBy("mark", "q").limit(n).select("q").collect() or rows.limit(1).select("q").collect()
    centroids = np.zeros((len(start), width))
    for i, row in enumerate(start):
        centroids[i, : len(row.q)] = row.q
    for _ in range(ROUNDS):
        sent = scratch.spark.sparkContext.broadcast(centroids)

        def sums(batches, sent=sent):
            lists = Lists(sent.value)
            total, held = np.zeros_like(lists.centroids), np.zeros(len(lists.centroids), np.int64)
            for batch in batches:
                q = _matrix(batch.column(0), width)
                at, _ = lists.nearest(q)
                held += np.bincount(at, minlength=len(held))
                order = np.argsort(at, kind="stable")
                first = np.flatnonzero(np.r_[True, at[order][1:] != at[order][:-1]]) if len(at) else at
                total[at[order][first]] += np.add.reduceat(q[order], first) if len(at) else 0
            some = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(list(total[some]), pa.list_(pa.float64())), pa.array(held[some])], names=["list", "total", "n"])

        parts = some.select("q").mapInArrow(sums, "list long, total array<double>, n long")
        added = F.aggregate(F.collect_list("total"), F.array_repeat(F.lit(0.0), width), lambda acc, x: F.zip_with(acc, x, lambda a, b: a + b))
        for row in parts.groupBy("list").agg(added.alias("total"), F.sum("n").alias("n")).collect():
            centroids[row.list] = np.array(row.total) / row.n
    return centroids


#: What a task reads: rows of a bin (``anchor`` false), then the anchors that visit it, each with the first score of its windows.
_DEALT = "bin long, anchor boolean, uid long, vec_id long, label long, q array<long>, list long, floors array<long>, tops array<long>, lows array<long>, seeds boolean"


class Search:
    """The index over ``rows`` (uid, vec_id, label, q), and searches in it."""

    def __init__(self, scratch: Scratch, rows: DataFrame, seed: int = 42):
        self.scratch = scratch
        head = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("q")).alias("width")).first()
        self.count, self.width = head.n, max(1, head.width or 0)
        self.n_bins = max(1, -(-self.count // BIN_ROWS))
        if not self.count:
            return
        centroids = _fitted(scratch, rows, self.count, self.width, seed)
        width, sent = self.width, scratch.spark.sparkContext.broadcast(Lists(centroids))

        def put(batches):
            for batch in batches:
                at, far = sent.value.nearest(_matrix(batch.column(3), width))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64()), pa.array(far, pa.float64())], names=["uid", "vec_id", "label", "q", "list", "far"])

        listed = scratch.cut(rows.select("uid", "vec_id", "label", "q").mapInArrow(put, "uid long, vec_id long, label long, q array<long>, list long, far double"), "lists")
        sizes = listed.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()  # a row for each list
        radii = np.full(len(centroids), -1.0)
        # A list's parts go to neighbouring bins; bins are filled in the order of the lists.
        bins: dict[int, tuple[int, int]] = {}
        filled = 0
        for row in sorted(sizes):
            radii[row.list] = row.far
            bins[row.list] = (filled // BIN_ROWS, (filled + row.n - 1) // BIN_ROWS)
            filled += row.n
        dealt = scratch.spark.createDataFrame([(k, *v) for k, v in bins.items()], "list long, first long, last long")
        bin_ = F.col("first") + F.pmod(F.xxhash64("uid"), F.col("last") - F.col("first") + 1)
        self.rows = listed.join(F.broadcast(dealt), "list").select("uid", "vec_id", "label", "q", "list", bin_.alias("bin"))
        self.bins = np.array([bins.get(i, (0, -1)) for i in range(len(centroids))])
        self.lists = scratch.spark.sparkContext.broadcast((Lists(centroids, radii), self.bins))

    def _visits(self, anchors: DataFrame, seeds: bool) -> DataFrame:
        """A row for each anchor and bin with a list that it visits: the seeds, or all others that its floors leave."""
        width, sent = self.width, self.lists

        def run(batches):
            lists, bins = sent.value
            for batch in sliced(batches, TOGETHER):
                q = _matrix(batch.column(3), width)
                open_ = _wanted(lists, q, *(_ragged(batch.column(i)) for i in (4, 5, 6)), seeds)
                i, k = np.nonzero(open_)
                n = bins[k, 1] - bins[k, 0] + 1
                i, b = np.repeat(i, n), np.repeat(bins[k, 0], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                pairs = np.unique(np.stack([i, b]), axis=1) if len(i) else np.zeros((2, 0), np.int64)
                held = batch.take(pa.array(pairs[0]))
                none = pa.nulls(len(held), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(pairs[1], pa.int64()), pa.array(np.ones(len(held), bool)), *held.columns[:4], none, *held.columns[4:7], pa.array(np.full(len(held), seeds))], names=[c.split()[0] for c in _DEALT.split(", ")])

        return anchors.select("uid", "vec_id", "label", "q", "floors", "tops", "lows").mapInArrow(run, _DEALT)

    def _pass(self, anchors: DataFrame, k: int, same: bool, seeds: bool) -> DataFrame:
        """(anchor, at, score, id): the best ``k`` rows of each bin for each window of each anchor."""
        width, sent = self.width, self.lists
        none = F.lit(None).cast("array<long>")
        held = self.rows.select("bin", F.lit(False).alias("anchor"), "uid", "vec_id", "label", "q", "list", none.alias("floors"), none.alias("tops"), none.alias("lows"), F.lit(seeds).alias("seeds"))
        dealt = held.unionByName(self._visits(anchors, seeds)).repartition(self.n_bins, "bin").sortWithinPartitions("bin", "anchor", "list", F.asc_nulls_last("vec_id"))

        def run(batches):
            lists, _ = sent.value
            now, parts, bin_ = None, [], None
            for batch in _by_bin(batches):
                at, anchor = batch.column(0)[0].as_py(), batch.column(1)[0].as_py()
                if at != now:
                    now, parts, bin_ = at, [], None
                if not anchor:
                    parts.append(batch)
                elif parts:
                    bin_ = bin_ or _Bin(parts, width)
                    for start in range(0, batch.num_rows, TOGETHER):
                        yield from bin_.best(lists, batch.slice(start, TOGETHER), k, same, seeds)

        return dealt.mapInArrow(run, "anchor long, at int, score long, id long")

    def best(self, anchors: DataFrame, k: int, same: bool) -> DataFrame:
        """(anchor, at, score, id, rank): for each window of each of ``anchors`` (uid, vec_id, label, q, floors, tops, lows) the first ``k`` rows of the same label or of others."""
        order = Window.partitionBy("anchor", "at").orderBy(F.desc("score"), F.asc_nulls_last("id"))

        def first(found: DataFrame) -> DataFrame:  # a bin gives k rows for each window at most
            return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

        seeds = self.scratch.cut(first(self._pass(anchors, k, same, True)).drop("rank"), "seeds")
        kth = seeds.groupBy("anchor", "at").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).filter(F.col("n") == k)
        kth = kth.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("at", "least"))).alias("least"))
        floors = F.transform("floors", lambda x, i: F.greatest(x, F.coalesce(F.col("least")[i.cast("int")], x)))
        later = anchors.join(kth, anchors.uid == kth.anchor, "left").withColumn("floors", floors).drop("anchor", "least")
        return first(seeds.unionByName(self._pass(later, k, same, False)))


def _ragged(column: pa.Array) -> np.ndarray:
    """Lists of one length as a matrix; shorter ones repeat an empty window."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.full((len(lengths), int(lengths.max(initial=0))), LAST)
    out[np.arange(out.shape[1]) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _wanted(lists: Lists, q: np.ndarray, floors: np.ndarray, tops: np.ndarray, lows: np.ndarray, seeds: bool) -> np.ndarray:
    """Which lists each anchor visits in this pass; seeds are told by the windows alone, so that both passes agree on them."""
    least, most = lists.bounds(q)
    top = np.where(lows == LAST, FIRST, tops).max(1)
    open_ = (most >= lows.min(1)[:, None]) & (least <= top[:, None])
    order = np.argsort(np.where(open_, -most, np.inf), axis=1, kind="stable")[:, :SEEDS]
    first = np.zeros_like(open_)
    np.put_along_axis(first, order, True, axis=1)
    first &= open_
    return first if seeds else open_ & ~first & (most >= floors.min(1)[:, None])


def _by_bin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut where the bin changes and where its anchors begin."""
    for batch in batches:
        bins, anchor = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        edges = np.flatnonzero((bins[1:] != bins[:-1]) | (anchor[1:] != anchor[:-1])) + 1
        for start, end in zip([0, *edges], [*edges, batch.num_rows]):
            if end > start:
                yield batch.slice(start, end - start)


class _Bin:
    """One bin's rows, list by list, each in the order of vec_id with nulls last."""

    def __init__(self, parts: list[pa.RecordBatch], width: int):
        self.q = np.concatenate([_matrix(p.column(5), width) for p in parts])
        self.uid, self.label, self.list = (np.concatenate([p.column(i).to_numpy(zero_copy_only=False) for p in parts]) for i in (2, 4, 6))
        ids = [p.column(3) for p in parts]
        self.id = np.concatenate([c.fill_null(LAST).to_numpy() for c in ids])
        self.null = np.concatenate([c.is_null().to_numpy(zero_copy_only=False) for c in ids])
        edges = np.r_[0, np.flatnonzero(self.list[1:] != self.list[:-1]) + 1, len(self.list)]
        self.blocks = [(int(self.list[a]), i, min(i + BLOCK, b)) for a, b in zip(edges[:-1], edges[1:]) for i in range(a, b, BLOCK)]

    def best(self, lists: Lists, anchors: pa.RecordBatch, k: int, same: bool, seeds: bool) -> Iterator[pa.RecordBatch]:
        q = _matrix(anchors.column(5), self.q.shape[1])
        uid, label = (anchors.column(i).to_numpy(zero_copy_only=False) for i in (2, 4))
        floors, tops, lows = (_ragged(anchors.column(i)) for i in (7, 8, 9))
        floors = np.where(lows == LAST, LAST, floors)
        wanted, (_, most) = _wanted(lists, q, floors, tops, lows, seeds), lists.bounds(q)
        found = [[np.zeros((0, 3), np.int64)] for _ in range(floors.shape[1])]
        for name, start, end in sorted(self.blocks, key=lambda b: -most[:, b[0]].max()):
            visitors = np.flatnonzero(wanted[:, name] & (most[:, name] >= floors.min(1)))
            if not len(visitors):
                continue
            scores = products(q[visitors], self.q[start:end])
            fits = (label[visitors, None] == self.label[None, start:end]) == same
            fits &= uid[visitors, None] != self.uid[None, start:end]
            for w in range(floors.shape[1]):
                floor = floors[visitors, w]
                held = np.where(fits & (scores >= floor[:, None]) & (scores <= tops[visitors, w][:, None]), scores, FIRST)
                if held.shape[1] >= k:
                    kth = np.partition(held, held.shape[1] - k, axis=1)[:, held.shape[1] - k]
                    floors[visitors, w] = floor = np.maximum(floor, kth)
                    held = np.where(held >= floor[:, None], held, FIRST)
                i, j = np.nonzero(held > FIRST)
                if len(i):
                    found[w].append(_first(np.stack([visitors[i], held[i, j], start + j], axis=1), self, k))
        for w, parts in enumerate(found):
            rows = _first(np.concatenate(parts), self, k)
            ids = pa.array(self.id[rows[:, 2]], mask=self.null[rows[:, 2]])
            yield pa.RecordBatch.from_arrays([pa.array(uid[rows[:, 0]]), pa.array(np.full(len(rows), w), pa.int32()), pa.array(rows[:, 1]), ids], names=["anchor", "at", "score", "id"])


def _first(rows: np.ndarray, held: _Bin, k: int) -> np.ndarray:
    """The first ``k`` of (anchor, score, row) for each anchor: higher scores, then smaller ids."""
    rows = rows[np.lexsort((held.null[rows[:, 2]], held.id[rows[:, 2]], -rows[:, 1], rows[:, 0]))]
    new = np.r_[True, rows[1:, 0] != rows[:-1, 0]] if len(rows) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    return rows[np.arange(len(rows)) - np.repeat(starts, np.diff(np.r_[starts, len(rows)])) < k]


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(spark: SparkSession, rows: DataFrame, seed: int = 42) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of ``rows`` (vec_id, embedding, label).

    Rows with a null label, vector or component and those with a component that is not finite
    take no part. A row without vec_id is no anchor, and comes last among equal scores. Rows
    with one vec_id are rows of their own: a repeated anchor returns its rows as often. Vectors
    of different lengths are compared as if the shorter one had further components of 0; an
    inner product that does not fit into a long is an error. An anchor without another row of
    its label, and a positive without a negative in its window, return nothing. Other columns
    are ignored.
    """
    scratch = Scratch(spark, "hard-negatives")
    taking = scratch.cut(prepared(rows).withColumn("uid", F.monotonically_increasing_id()), "rows")
    index = Search(scratch, taking, seed)
    if not index.count:
        return spark.createDataFrame([], RESULT)
    anchors = taking.filter(F.col("vec_id") % EVERY == 0)
    whole = lambda n: F.array(F.lit(n).cast("long"))
    near = index.best(anchors.select("uid", "vec_id", "label", "q", whole(FIRST + 1).alias("floors"), whole(LAST - 1).alias("tops"), whole(FIRST + 1).alias("lows")), POSITIVES, True)
    near = scratch.cut(near.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), "rank"), "positives")

    def bound(percent: int, up: bool) -> Column:
        """The least score whose hundredfold reaches ``percent`` times the positive's, or the largest that doesn't pass it."""
        product = F.col("p.positive_score").cast("decimal(38,0)") * percent
        return (F.ceil(product / 100) if up else F.floor(product / 100)).cast("long")

    windows = near.alias("p").groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("p.rank", bound(WINDOW[0], True).alias("low"), bound(WINDOW[1], False).alias("top")))).alias("w"))
    wide = anchors.join(windows, anchors.uid == windows.anchor).select("uid", "vec_id", "label", "q", F.col("w.low").alias("floors"), F.col("w.top").alias("tops"), F.col("w.low").alias("lows"))
    far = index.best(wide, NEGATIVES, False).alias("n")
    found = far.join(near.alias("p"), F.expr("n.anchor = p.anchor AND n.at = p.rank - 1")).join(anchors.select("uid", "vec_id").alias("a"), F.expr("n.anchor = a.uid"))
    return found.select(F.col("a.vec_id").alias("anchor_id"), "positive_id", F.col("n.rank").cast("int").alias("rank"), F.col("n.id").alias("negative_id"), "positive_score", F.col("n.score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(spark, table(spark, sf_dir, "embeddings"))


OP11_SQL = """
WITH held AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM held a JOIN held b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), negatives AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 3
"""
