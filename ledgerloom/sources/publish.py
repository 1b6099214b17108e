"""Sinks: tables that are never overwritten by accident, batches that appear whole, and an audit trail.

A batch is written to a staging folder, recounted from the footers of its files, moved to its
place and becomes current by a pointer: a small file with the next version number, which only
one of several loads can create. A failed or overtaken load leaves the current batch in place;
loading the same batch again does nothing; a batch of another identity replaces a current one
only when told to. Events of the audit table are appended and never changed.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import delete

EVENT = "batch_id string, batch_key string, layer string, table_name string, status string, rows long, message string, step long"
AUDIT = EVENT + ", at timestamp"


class LoadRefused(RuntimeError):
    """A load that would replace a batch it was not told to replace, or that another load overtook."""


def _fs(spark: SparkSession, path: str):
    """The path and its file system, which may be any that Spark reads."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _fs(spark, path)
    return fs.exists(at)


def _move(spark: SparkSession, source: str, target: str) -> None:
    at, fs = _fs(spark, target)
    fs.mkdirs(at.getParent())
    if fs.exists(at) or not fs.rename(_fs(spark, source)[0], at):
        raise FileExistsError(f"{target} already exists or can't be made")


def run_id(*parts: str) -> str:
    """The same parts always give the same id."""
    return str(uuid.uuid5(uuid.NAMESPACE_URL, "|".join(parts)))


def write_once(df: DataFrame, path: str, overwrite: bool = False) -> int:
    """Writes zstd Parquet and returns the rows counted in what was written; an existing table is an error unless told otherwise.

    The table is written beside its place and moved there when it is whole, so that a failed
    write leaves what was there, and readers never see a part of it.
    """
    spark = df.sparkSession
    if not overwrite and exists(spark, path):
        raise FileExistsError(f"{path} already exists")
    parent, _, name = path.rstrip("/").rpartition("/")
    staged = f"{parent}/_staged-{uuid.uuid4().hex}-{name}"
    try:
        df.write.option("compression", "zstd").parquet(staged)
        rows = spark.read.schema(df.schema).parquet(staged).count()
        old = None
        if exists(spark, path):
            old = f"{parent}/_old-{uuid.uuid4().hex}-{name}"
            _move(spark, path, old)
        try:
            _move(spark, staged, path)
        except Exception:
            if old:
                _move(spark, old, path)
            raise
        if old:
            delete(spark, old)
        return rows
    finally:
        delete(spark, staged)


def silver_path(root: str, table: str, period: str, snapshot: str) -> str:
    """A folder for each period and snapshot; both are columns of the table too, so it is no partition column."""
    return f"{root}/{table}/source_period={period}/snapshot_date={snapshot}"


def quarantine_path(root: str, rule: str, run: str, table: str) -> str:
    return f"{root}/quarantine/{rule}/ingestion_run_id={run}/{table}"


def write_json(payload: Mapping, path: str | Path) -> None:
    """By way of a file beside it, so that no reader sees half of it."""
    part = Path(path).with_suffix(".part")
    part.write_text(json.dumps(payload, indent=2, sort_keys=True, ensure_ascii=False, default=str) + "\n", encoding="utf-8")
    part.replace(path)


def _event(spark: SparkSession, root: str, batch: str, key: str, layer: str, table: str, status: str, rows: int | None, step: int, message: str = "") -> None:
    row = spark.createDataFrame([(batch, key, layer, table, status, rows, message[:4000], step)], EVENT)
    row.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{root}/audit")


def audit(spark: SparkSession, root: str) -> DataFrame:
    """The last event of each batch and table; of events of one time the later step counts."""
    try:
        events = spark.read.schema(AUDIT).parquet(f"{root}/audit")
    except Exception as gone:
        if "PATH_NOT_FOUND" not in str(gone):
            raise
        return spark.createDataFrame([], AUDIT)
    last = F.max_by(F.struct("status", "rows", "message", "step", "at"), F.struct("step", "at"))
    return events.groupBy("batch_id", "batch_key", "layer", "table_name").agg(last.alias("e")).select("batch_id", "batch_key", "layer", "table_name", "e.*")


def _version(spark: SparkSession, root: str) -> tuple[int, str | None, str | None]:
    """(version, batch, its key) of the current pointer; version 0 before the first load."""
    at, fs = _fs(spark, f"{root}/current")
    if not fs.exists(at):
        return 0, None, None
    last = max((f.getPath().getName() for f in fs.listStatus(at) if f.getPath().getName().startswith("v")), default=None)
    if last is None:
        return 0, None, None
    row = spark.read.json(f"{root}/current/{last}", schema="batch string, key string").first()
    return int(last[1:]), row.batch, row.key


def _point(spark: SparkSession, root: str, version: int, batch: str, key: str) -> None:
    """Makes ``version`` the current one; fails if another load has made it. The pointer appears whole, by way of a file of its own."""
    target, fs = _fs(spark, f"{root}/current/v{version:012d}")
    fs.mkdirs(target.getParent())
    claim, _ = _fs(spark, f"{root}/current/_claim-{version:012d}")
    try:
        fs.create(claim, False).close()  # only one can create it
    except Exception as taken:
        raise LoadRefused(f"another load has made version {version} of {root}") from taken
    part, _ = _fs(spark, f"{root}/current/_part-{batch}")
    out = fs.create(part, True)
    out.write(bytearray(json.dumps({"batch": batch, "key": key}).encode()))
    out.close()
    if not fs.rename(part, target):
        raise LoadRefused(f"version {version} of {root} can't be made")


def current_batch(spark: SparkSession, root: str) -> str | None:
    return _version(spark, root)[1]


Tables = Mapping[str, DataFrame]


def load(spark: SparkSession, root: str, tables: Tables | Mapping[str, Tables], identity: Mapping[str, str], replace: bool = False) -> tuple[str, str]:
    """Loads a batch: (batch id, LOADED or SKIPPED_IDEMPOTENT). ``tables`` may be grouped by layer.

    The current batch is not loaded again if its identity and rows are the same. A current batch of another
    identity is replaced only with ``replace``. Whatever fails is an event of the audit and leaves
    the current batch as it is.
    """
    layers: dict[str, Tables] = dict(tables) if tables and all(isinstance(v, Mapping) for v in tables.values()) else {"": tables}  # type: ignore[assignment,dict-item]
    key = hashlib.sha256(json.dumps(dict(identity), sort_keys=True).encode()).hexdigest()
    version, held, held_key = _version(spark, root)
    if held is not None and held_key == key:
        found = audited(spark, root, held).collect()
        same = {(r.layer, r.table_name) for r in found} == {(layer, t) for layer, part in layers.items() for t in part}
        if same and all(r.status == "SUCCEEDED" and r.rows == r.physical_rows for r in found):
            return held, "SKIPPED_IDEMPOTENT"
    batch = uuid.uuid4().hex
    _event(spark, root, batch, key, "", "", "STARTED", None, 0)
    staged = f"{root}/_staged-{batch}"
    try:
        if held is not None and held_key != key and not replace:
            raise LoadRefused(f"{root} holds another snapshot, batch {held}; it is replaced only when told to")
        total = 0
        for layer, part in layers.items():
            for name, df in part.items():
                rows = write_once(df, _table_path(staged, layer, name))
                total += rows
                _event(spark, root, batch, key, layer, name, "SUCCEEDED", rows, 1)
        _move(spark, staged, f"{root}/batches/{batch}")
        _point(spark, root, version + 1, batch, key)
    except Exception as error:
        _event(spark, root, batch, key, "", "", "FAILED", None, 2, str(error))
        delete(spark, staged)
        delete(spark, f"{root}/batches/{batch}")
        raise
    _event(spark, root, batch, key, "", "", "SUCCEEDED", total, 2)
    return batch, "LOADED"


def _table_path(folder: str, layer: str, table: str) -> str:
    return "/".join(x for x in (folder, layer, table) if x)


def audited(spark: SparkSession, root: str, batch: str) -> DataFrame:
    """layer, table_name, status, rows, physical_rows of each table of a batch: what the audit says, and what the footers of its files say; null without files."""
    events = audit(spark, root).filter((F.col("batch_id") == batch) & (F.col("table_name") != "")).select("layer", "table_name", "status", "rows")
    counts = []
    for r in events.collect():  # one for each table
        path = _table_path(f"{root}/batches/{batch}", r.layer, r.table_name)
        try:
            n = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("physical_rows"))
        except Exception as gone:
            if "PATH_NOT_FOUND" not in str(gone) and "UNABLE_TO_INFER_SCHEMA" not in str(gone):
                raise
            n = spark.range(1).select(F.lit(None).cast("long").alias("physical_rows"))
        counts.append(n.select(F.lit(r.layer).alias("_l"), F.lit(r.table_name).alias("_t"), "physical_rows"))
    if not counts:
        return events.withColumn("physical_rows", F.lit(None).cast("long"))
    side = reduce(DataFrame.unionByName, counts)
    return events.join(side, (F.col("layer") == F.col("_l")) & (F.col("table_name") == F.col("_t")), "left").drop("_l", "_t")


def read_current(spark: SparkSession, root: str, table: str, layer: str = "") -> DataFrame:
    batch = current_batch(spark, root)
    if batch is None:
        raise FileNotFoundError(f"{root} has no loaded batch")
    return spark.read.parquet(_table_path(f"{root}/batches/{batch}", layer, table))
