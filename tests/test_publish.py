"""Batches appear whole or not at all, one at a time, and are held against their files."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import governed as G
from ledgerloom.sources import publish as P

ONE, TWO = {"period": "2026-07"}, {"period": "2026-08"}


def test_layers_pointer_and_replacement(spark, tmp_path):
    root = str(tmp_path / "dw")
    tables = {"stg": {"a": spark.range(3)}, "dw": {"a": spark.range(4), "empty": spark.range(0)}}
    batch, state = P.load(spark, root, tables, ONE)
    assert state == "LOADED" and P.read_current(spark, root, "a", "dw").count() == 4
    assert P.load(spark, root, tables, ONE) == (batch, "SKIPPED_IDEMPOTENT")
    with pytest.raises(P.LoadRefused, match="another snapshot"):
        P.load(spark, root, tables, TWO)
    assert P.current_batch(spark, root) == batch
    other, _ = P.load(spark, root, {"stg": {"a": spark.range(9)}, "dw": tables["dw"]}, TWO, replace=True)
    assert other != batch and P.current_batch(spark, root) == other and P.read_current(spark, root, "a", "stg").count() == 9
    assert {r.status for r in P.audit(spark, root).filter("table_name = ''").collect()} == {"SUCCEEDED", "FAILED"}
    assert not [x for x in os.listdir(root) if x.startswith("_staged")]


def test_a_failed_load_leaves_the_batch(spark, tmp_path):
    root = str(tmp_path / "dw")
    batch, _ = P.load(spark, root, {"a": spark.range(3), "b": spark.range(2)}, ONE)
    bad = spark.range(3).select(F.raise_error(F.lit("no")).alias("x"))
    with pytest.raises(Exception, match="no"):
        P.load(spark, root, {"a": spark.range(5), "b": bad}, TWO, replace=True)
    assert P.current_batch(spark, root) == batch and os.listdir(f"{root}/batches") == [batch]


def test_an_overtaken_load_is_refused(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "dw")
    first, _ = P.load(spark, root, {"a": spark.range(3)}, ONE)
    real, other = P._move, []

    def late(s, source, target):
        real(s, source, target)
        if "/batches/" in target and not other:
            other.append(None)
            other.append(P.load(s, root, {"a": s.range(7)}, TWO, replace=True)[0])

    monkeypatch.setattr(P, "_move", late)
    with pytest.raises(P.LoadRefused, match="another load"):
        P.load(spark, root, {"a": spark.range(5)}, {"period": "2026-09"}, replace=True)
    assert P.current_batch(spark, root) == other[1] != first and P.read_current(spark, root, "a").count() == 7


def test_audit_against_files(spark, tmp_path):
    root = str(tmp_path / "dw")
    batch, _ = P.load(spark, root, {"stg": {"a": spark.range(8, numPartitions=2)}, "dw": {"b": spark.range(2), "c": spark.range(1)}}, ONE)
    assert {(r.layer, r.table_name, r.rows, r.physical_rows) for r in P.audited(spark, root, batch).collect()} == {("stg", "a", 8, 8), ("dw", "b", 2, 2), ("dw", "c", 1, 1)}
    folder = f"{root}/batches/{batch}/stg/a"
    os.remove(f"{folder}/{next(x for x in sorted(os.listdir(folder)) if x.endswith('.parquet'))}")
    found = P.audited(spark, root, batch)
    assert {r.table_name: r.physical_rows for r in found.collect()}["a"] == 4
    assert {r.layer: (r.tables, r.rows, r.physical_rows, r.deviations) for r in G.audit_by_layer(found).collect()} == {"stg": (1, 8, 4, 1), "dw": (2, 3, 3, 0)}
    assert P.load(spark, root, {"stg": {"a": spark.range(8)}, "dw": {"b": spark.range(2), "c": spark.range(1)}}, ONE)[1] == "LOADED"


def test_write_once_keeps_what_was_there(spark, tmp_path):
    path = str(tmp_path / "t" / "one")
    assert P.write_once(spark.range(3), path) == 3
    with pytest.raises(FileExistsError):
        P.write_once(spark.range(4), path)
    with pytest.raises(Exception, match="no"):
        P.write_once(spark.range(3).select(F.raise_error(F.lit("no")).alias("id")), path, overwrite=True)
    assert spark.read.parquet(path).count() == 3 and P.write_once(spark.range(4), path, overwrite=True) == 4
    assert os.listdir(tmp_path / "t") == ["one"]
