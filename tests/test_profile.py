"""Exact profiles: columns, inferred types, grains, whole archives."""

from __future__ import annotations

import pytest

from ledgerloom.operators import profile as PF
from ledgerloom.sources.scratch import shared_dir


def rows(df, key):
    return {r[key]: r for r in df.collect()}


def test_many_columns_without_expand(spark):
    n = 50
    df = spark.range(300).selectExpr("id", *(f"CASE WHEN id % {i + 2} = 0 THEN NULL ELSE cast(id % {i + 1} AS string) END AS `c.{i}`" for i in range(n)))
    found = PF.column_profile(df)
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()
    got = rows(found, "column_name")
    data = df.collect()
    for i in range(n):
        values = [r[f"c.{i}"] for r in data]
        r = got[f"c.{i}"]
        assert (r.n_rows, r.null_count, r.non_null_count, r.distinct_count) == (300, values.count(None), 300 - values.count(None), len(set(values) - {None}))


def test_inferred_types(spark):
    df = spark.createDataFrame([("1", "1.5", "true", "2026-07-01", "x", None, 3), ("-2", "2", "False", "2026-07-01T10:00:00Z", "1", None, 4), (None, "1e3", None, None, "", None, None)], "a string, b string, c string, d string, e string, f string, g int")
    assert {k: r.inferred_type for k, r in rows(PF.column_profile(df, typed=True), "column_name").items()} == {"a": "integer", "b": "decimal", "c": "boolean", "d": "datetime", "e": "string", "f": None, "g": None}
    assert [(r.n_rows, r.distinct_count) for r in PF.column_profile(df.limit(0), ["a"]).collect()] == [(0, 0)]


def test_archive_profile(spark):
    """Three records, two of them equal and without buyer; two parties."""
    records = spark.createDataFrame([("ocds-1", "b", "x", 1), ("ocds-2", None, "y", 2), ("ocds-2", None, "y", 2)], "ocid string, buyer string, t string, n int")
    parties = spark.createDataFrame([("ocds-1", "p"), ("ocds-2", "q")], "ocid string, p string")
    tables = {"records.csv": records, "parties.csv": parties}
    total = PF.archive_profile(tables, "records.csv", "ocid").first()
    assert (total.tables, total.n_rows, total.cells, total.null_cells, total.additional_rows, total.empty_rows, total.missing_parent_keys) == (2, 5, 16, 2, 1, 0, 0)
    key = PF.key_profile(records, ["ocid"]).first()
    assert (key.duplicate_count, key.distinct_count, key.is_unique_and_complete) == (1, 2, False)
    assert rows(PF.column_profile(records), "column_name")["buyer"].null_count == 2
    more = {**tables, "parties.csv": parties.union(spark.createDataFrame([("zz", "r"), (None, "s")], parties.schema))}
    assert [tuple(r) for r in PF.missing_parents(more, "records.csv", "ocid").collect()] == [("parties.csv", 3, 1)]
    grains = rows(PF.grain_profiles(more, {"records.csv": ["ocid"], "parties.csv": ["ocid", "gone"], "absent.csv": ["x"]}), "table_name")
    assert (grains["records.csv"].duplicate_grain_rows, grains["records.csv"].holds, grains["parties.csv"].has_columns, grains["parties.csv"].holds) == (1, False, False, False)


def test_an_empty_table_shows_no_grain(spark):
    empty = spark.createDataFrame([], "ocid string")
    assert tuple(PF.grain_profiles({"t": empty}, {"t": ["ocid"]}).first()) == ("t", "ocid", True, 0, 0, 0, False)


def test_equal_rows_with_nulls_in_other_places(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", None), (None, None)], "x string, y string")
    assert tuple(PF.table_profile(df).first()) == (4, 2, 5, 1, 1)


def test_missing_tables_are_named(spark):
    root = f"{shared_dir(spark)}/profile-tables"
    spark.range(3).write.mode("overwrite").parquet(f"{root}/one")
    assert PF.read_tables(spark, root, ["one"])["one"].count() == 3
    with pytest.raises(FileNotFoundError, match="lacks three, two"):
        PF.read_tables(spark, root, ["one", "two", "three"])
