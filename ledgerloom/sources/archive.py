"""Raw archives: ZIP files of CSV members, read as text tables with their source row numbers.

Spark has no ZIP codec. Members are unpacked by tasks, each as a stream, to a folder of the
caller's choice; archive and folder are where driver and executors see them. From there on Spark reads them. Encodings are probed
with an incremental decoder, so that a character cut by the end of the probe is no error.
"""

from __future__ import annotations

import codecs
import hashlib
import io
import os
import shutil
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path, PurePosixPath

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import exprs as X
from ledgerloom.session import ship

from .split_csv import ROW_NUMBER, read_split_csv

PROBE_BYTES = 1 << 16


def sha256_file(path: str | Path) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def sha256_text(path: str | Path) -> str:
    """Of the text with its line ends as LF."""
    return hashlib.sha256(Path(path).read_bytes().replace(b"\r\n", b"\n").replace(b"\r", b"\n")).hexdigest()


def sha256_member(archive: str | Path, suffix: str) -> tuple[str, str, int]:
    """(name, digest, size) of the single member with the suffix."""
    with zipfile.ZipFile(archive) as z:
        found = [m for m in z.infolist() if m.filename.lower().endswith(suffix.lower())]
        if len(found) != 1:
            raise ValueError(f"{len(found)} members end with {suffix}; one is needed")
        with z.open(found[0]) as f:
            digest = hashlib.sha256()
            while block := f.read(1 << 20):
                digest.update(block)
        return found[0].filename, digest.hexdigest(), found[0].file_size


def encoding_of(probe: bytes) -> str:
    """utf-8-sig, utf-8 or cp1252."""
    if probe.startswith(codecs.BOM_UTF8):
        return "utf-8-sig"
    try:
        codecs.getincrementaldecoder("utf-8")().decode(probe, final=False)
        return "utf-8"
    except UnicodeDecodeError:
        return "cp1252"


def members(archive: str | Path) -> dict[str, str]:
    """Base name to member of the CSV members. A base name twice is an error."""
    out: dict[str, str] = {}
    with zipfile.ZipFile(archive) as z:
        for member in sorted(m.filename for m in z.infolist()):
            name = PurePosixPath(member).name
            if not name.lower().endswith(".csv"):
                continue
            if name in out:
                raise ValueError(f"{name} is twice in the archive")
            out[name] = member
    return out


def unpack_member(archive: str, member: str, target: str) -> str:
    """Unpacks one member as UTF-8 and returns the encoding found. The file appears whole, however often a task is tried."""
    Path(target).parent.mkdir(parents=True, exist_ok=True)
    part = f"{target}.{uuid.uuid4().hex}"
    with zipfile.ZipFile(archive) as z:
        with z.open(member) as f:
            encoding = encoding_of(f.read(PROBE_BYTES))
        with z.open(member) as f, open(part, "w", encoding="utf-8", newline="") as to:
            shutil.copyfileobj(io.TextIOWrapper(f, encoding, newline=""), to)
    os.replace(part, target)
    return encoding


def unpack(archive: str | Path, folder: str | Path, spark: SparkSession | None = None) -> dict[str, tuple[str, str]]:
    """Unpacks the CSV members as UTF-8: base name to (path, encoding found). With ``spark`` each member has a task of its own."""
    found = [(name, member, str(Path(folder).resolve() / name)) for name, member in members(archive).items()]
    Path(folder).mkdir(parents=True, exist_ok=True)
    source = str(Path(archive).resolve())
    if spark is None or not found:
        return {name: (target, unpack_member(source, member, target)) for name, member, target in found}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                name, member, target = found[i]
                yield pa.RecordBatch.from_pydict({"name": [name], "target": [target], "encoding": [unpack_member(source, member, target)]})

    rows = ship(spark).range(0, len(found), 1, len(found)).mapInArrow(run, "name string, target string, encoding string").collect()  # one for each member
    return {r.name: (r.target, r.encoding) for r in sorted(rows)}


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, missing tokens as null, and ``source_row_number`` from 1 in file order.

    A file whose cells may hold line ends is one input split, so the running id of its only
    partition is the position in the file.
    """
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    cells = (X.missing_to_null(F.col(f"`{c}`")).alias(c) for c in rows.columns)
    return rows.select(*cells, (F.monotonically_increasing_id() + 1).alias(ROW_NUMBER))


def read_archive(spark: SparkSession, archive: str | Path, folder: str | Path) -> dict[str, DataFrame]:
    """The members as text tables. Files of more than one split are read by many tasks, with the same rows and numbers."""
    split = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    held = unpack(archive, folder, spark)
    return {name: (read_split_csv if os.path.getsize(path) > split else read_csv)(spark, path) for name, (path, _) in held.items()}


def file_url(base: str, source: str, file_format: str, year: int, month: int, language: str | None = None) -> str:
    """Address of a monthly file; arguments are checked before it is built."""
    if source not in ("seace_v2", "seace_v3") or file_format not in ("csv", "xlsx", "json", "sha"):
        raise ValueError("unknown source or format")
    if not 1 <= month <= 12 or year < 2000:
        raise ValueError("no such month")
    if language not in (None, "es") or (language and file_format in ("json", "sha")):
        raise ValueError("a language goes with csv and xlsx only, and is es")
    return "/".join([base.rstrip("/"), source, file_format, str(year), f"{month:02d}", *([language] if language else [])])
