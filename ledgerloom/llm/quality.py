"""Quality classifier: random Fourier features of document statistics, ridge, isotonic calibration.

Statistics of each text are computed once and written. Random Fourier features of the
standardised statistics approximate a Gaussian kernel; each task sums its part of the normal
equations and Spark adds the parts, so what reaches the driver is one matrix of fixed size.
Ridge scores of the labelled rows are counted in fixed bins, and pooling adjacent violators
over the bins gives the calibration.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, raw_texts, sliced, table
from .language_id import fold_of

FOURIER = 192
WIDTH = 3.0
RIDGE = 1.0
SEED = 20
BINS = 1000
CUT = 0.3
STATISTICS = ("log_bytes", "lower", "upper", "digit", "blank", "stop", "symbol", "bar", "bang", "high", "log_words", "word_bytes", "short_words", "distinct", "top_word", "repeated_next", "distinct_pairs", "log_lines", "distinct_lines", "line_bytes", "plain_words", "capital_words")
_N = len(STATISTICS)
_BYTE = np.zeros((256, 9))
for _i, _chars in enumerate((range(97, 123), range(65, 91), range(48, 58), (9, 10, 11, 12, 13, 32), b".,;:?", b"#$%&*@^~_=+<>\\/", b"|", b"!", range(128, 256))):
    _BYTE[list(_chars), _i] = 1


def statistics(text: bytes | None) -> np.ndarray:
    """All zero for a null or empty text; ratios are of bytes, words or lines."""
    text = text or b""
    out = np.zeros(_N)
    size = len(text)
    if not size:
        return out
    out[0] = np.log1p(size)
    out[1:10] = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _BYTE / size
    words = text.split()
    n = len(words)
    out[10] = np.log1p(n)
    if n:
        counts = Counter(words)
        out[11] = min(40.0, sum(map(len, words)) / n)
        out[12] = sum(k for w, k in counts.items() if len(w) <= 3) / n
        out[13] = len(counts) / n**0.8
        out[14] = max(counts.values()) / n
        out[15] = sum(map(bytes.__eq__, words, words[1:])) / n
        out[16] = len(set(zip(words, words[1:]))) / n
        out[20] = sum(k for w, k in counts.items() if w.isalpha() or w[-1:] in b".,") / n
        out[21] = sum(k for w, k in counts.items() if w.isupper()) / n
    lines = text.split(b"\n")
    out[17] = np.log1p(len(lines))
    out[18] = len(set(lines)) / len(lines)
    out[19] = np.log1p(size / len(lines))
    return out


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, stats) of each row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2000):
            rows = np.array([statistics(x) for x in raw_texts(batch.column(2))]).reshape(-1, _N)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), _N).cast(pa.list_(pa.float64()))], names=["doc_id", "held_out", "stats"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold_of("doc_id", 5) == 0).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, stats array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, _N)


class Model:
    def __init__(self, mean, spread, weights, knots, values, fourier: int = FOURIER, width: float = WIDTH, seed: int = SEED):
        self.mean, self.spread, self.weights, self.knots, self.values = mean, spread, weights, knots, values
        rng = np.random.default_rng(seed)
        self.directions = rng.normal(size=(_N, fourier)) / width
        self.phases = rng.uniform(0, 2 * np.pi, fourier)

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.spread, -5, 5)
        waves = np.sqrt(2 / len(self.phases)) * np.cos(z @ self.directions + self.phases)
        return np.hstack([np.ones((len(z), 1)), z, waves])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.values), 0, 1)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pools adjacent violators; (knots, values), non-decreasing. ``x`` ascends, ``y`` are means of weight ``w``."""
    pools: list[list[float]] = []
    for a, b, c in zip(x, y, w):
        pools.append([b, c, a, a])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            b2, c2, _, hi = pools.pop()
            b1, c1, lo, _ = pools.pop()
            pools.append([(b1 * c1 + b2 * c2) / (c1 + c2), c1 + c2, lo, hi])
    knots = np.array([p for pool in pools for p in (pool[2], pool[3])])
    return knots, np.repeat([pool[0] for pool in pools], 2)


def fit(rows: DataFrame) -> Model:
    """From (stats, y) with y 0 or 1; without rows every score is 0.5."""
    sums = rows.select(F.posexplode("stats").alias("i", "v")).groupBy("i").agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("spread")).collect()  # one row for each statistic
    mean, spread = np.zeros(_N), np.ones(_N)
    for r in sums:
        mean[r.i], spread[r.i] = r["mean"], max(r["spread"], 1e-3)
    model = Model(mean, spread, np.zeros(1 + _N + FOURIER), np.zeros(1), np.full(1, 0.5))
    if not sums:
        return model
    size = 1 + _N + FOURIER

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in sliced(batches, 4000):
            x = model.features(_matrix(batch.column(0)))
            total += x.T @ np.column_stack([x, batch.column(1).to_numpy()])
        i, j = np.triu_indices(size, 0, size + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "v"])

    got = rows.select("stats", F.col("y").cast("double")).mapInArrow(parts, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()  # size * (size + 1) / 2 rows
    full = np.zeros((size, size + 1))
    full[got.column(0).to_numpy(), got.column(1).to_numpy()] = got.column(2).to_numpy()
    gram = np.triu(full[:, :size]) + np.triu(full[:, :size], 1).T
    penalty = np.full(size, RIDGE)
    penalty[0] = 0
    model.weights = np.linalg.solve(gram + np.diag(penalty) + 1e-9 * np.eye(size), full[:, size])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.clip(np.floor(model.raw(_matrix(batch.column(0))) * BINS), -BINS, 2 * BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column(1)], names=["bin", "y"])

    bins = rows.select("stats", F.col("y").cast("double").alias("y")).mapInArrow(binned, "bin int, y double").groupBy("bin").agg(F.avg("y").alias("y"), F.count("y").alias("n")).orderBy("bin").collect()  # at most 3 * BINS rows
    model.knots, model.values = isotonic(np.array([(r.bin + 0.5) / BINS for r in bins]), np.array([r.y for r in bins]), np.array([r.n for r in bins], float))
    return model


def scored(rows: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(model.score(_matrix(batch.column(2))))], names=["doc_id", "held_out", "score"])

    return rows.select("doc_id", "held_out", "stats").mapInArrow(run, "doc_id long, held_out boolean, score double").withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def quality_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs`` (doc_id, text).

    Learns from labels (doc_id, quality) of rows that are not in fold 0 of 5. Labels other
    than 0 and 1 and null ones are left out; of several for one doc_id the mean counts. Null
    and empty texts are scored by statistics that are all 0. Other columns are ignored.
    """
    rows = Scratch(spark, "quality").cut(with_statistics(docs), "statistics")
    known = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg(F.col("quality").cast("double")).alias("y"))
    train = Scratch(spark, "quality").cut(rows.filter("NOT held_out").join(known, "doc_id").select("stats", "y"), "labelled")
    return scored(rows, fit(train))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
