"""What the operators share: table reading, written intermediate tables and Arrow helpers.

An intermediate result that is read more than once is written as Parquet below the
folder named by ``spark.checkpoint.dir`` and read again. That cuts the lineage, survives
a lost executor, and gives later joins plain scans on both sides, so that adaptive
execution may split their skewed partitions.
"""

from __future__ import annotations

import atexit
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import delete, shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Written intermediate tables of one operator run.

    ``cut`` writes a table and reads it back; ``drop`` removes one that is used up. What
    the returned DataFrame still reads stays until the Python process ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._serial = 0
        atexit.register(self._end)

    def _end(self) -> None:
        try:
            delete(self.spark, self.root)
        except Exception:  # the session has ended before the process
            return

    def path(self, label: str) -> str:
        self._serial += 1
        return f"{self.root}/{self._serial:03d}-{label}"

    def cut(self, df: DataFrame, label: str, partition_by: str | None = None, codec: str = "zstd", hashes: bool = False) -> DataFrame:
        """``hashes``: most of the table are hashes, which no dictionary and no compression makes smaller."""
        path = self.path(label)
        writer = df.write.mode("overwrite").option("compression", "lz4_raw" if hashes else codec).option("parquet.enable.dictionary", str(not hashes).lower())
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back._scratch_path = path
        return back

    def drop(self, *frames: DataFrame) -> None:
        for frame in frames:
            delete(self.spark, frame._scratch_path)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of ended jobs now; else they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def raw_texts(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    return column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()


def sliced(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what a task holds beside its input stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


class IdFilter:
    """A set of ids as bits of their hashes, to leave most other rows behind before a shuffle.

    It holds every id it was made of and may hold others, so an exact semi-join follows. Its
    size does not depend on the ids: the bits come to the driver as at most ``BITS / 2 ** 15``
    bitmaps of 4 kB, and are broadcast.
    """

    BITS = 1 << 25

    def __init__(self, sent):
        self.sent = sent

    @classmethod
    def of(cls, ids: DataFrame) -> IdFilter:
        """``ids``: one column ``id`` of longs; nulls are left out."""
        marks = ids.filter("id IS NOT NULL").select((cls.position("id") + 1).alias("at")).selectExpr("bitmap_bucket_number(at) AS bucket", "bitmap_bit_position(at) AS bit")
        bits = np.zeros(cls.BITS // 8, np.uint8)
        for row in marks.groupBy("bucket").agg(F.expr("bitmap_construct_agg(bit)").alias("bits")).collect():
            bits[(row.bucket - 1) * 4096 : row.bucket * 4096] = np.frombuffer(row.bits, np.uint8)
        return cls(ids.sparkSession.sparkContext.broadcast(bits))

    @classmethod
    def position(cls, column: str | Column) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(cls.BITS))

    def mask(self, positions: pa.Array) -> pa.Array:
        at = positions.to_numpy(zero_copy_only=False)
        return pa.array((self.sent.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool))


def _words(ids: DataFrame) -> DataFrame:
    """A bitmap of ``ids`` as words ``_present_bits`` and their places ``_present_word``: at most ``BITS / 64`` rows whatever the number of ids, so that the broadcast has a fixed bound."""
    return ids.select(_split(ids.columns[0]).alias("_present_at")).groupBy(F.col("_present_at.word").alias("_present_word")).agg(F.expr("bit_or(shiftleft(1L, _present_at.bit))").alias("_present_bits"))


def _split(column: str) -> Column:
    """The word of a bitmap that a column falls in, and its place there."""
    at = IdFilter.position(F.col(column))
    return F.struct(F.shiftright(at, 6).cast("int").alias("word"), at.bitwiseAND(F.lit(63)).cast("int").alias("bit"))


_WORD = "_present_at.word = _present_word"
_BIT = "shiftrightunsigned(coalesce(_present_bits, 0L), _present_at.bit) & 1L"


def present(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``column`` is not in the one column of longs of ``ids``; an exact join follows.

    As ``IdFilter`` in DataFrame operations. The bit is asked in the join, so that no other row leaves it.
    """
    return rows.withColumn("_present_at", _split(column)).join(F.broadcast(_words(ids)), F.expr(f"{_WORD} AND {_BIT} = 1L"), "left_semi").select(*rows.columns)


def absent(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows that ``present`` leaves out."""
    return rows.withColumn("_present_at", _split(column)).join(F.broadcast(_words(ids)), F.expr(f"{_WORD} AND {_BIT} = 1L"), "left_anti").select(*rows.columns)
