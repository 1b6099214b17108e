"""Profiles of columns, keys, grains and whole archives, exact at any number of columns.

Cells become (column, value) pairs, of which each task counts the different ones before they
are shuffled as 128-bit hashes; so the shuffle holds each different value of a column once for
each task, and no row is copied for each distinct count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import exprs as X

from . import relational as R

#: Types that text may have, the narrowest first; a column has the first that all its values have.
KINDS = ("integer", "decimal", "boolean", "datetime", "string")
_INTEGER, _DECIMAL = r"^\s*[+-]?[0-9]+\s*$", r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _fits(c: Column) -> dict[str, Column]:
    """Whether a text is of a kind. Every text is a string."""
    return {"integer": c.rlike(_INTEGER), "decimal": c.rlike(_DECIMAL), "boolean": F.lower(F.trim(c)).isin("true", "false"), "datetime": F.try_to_timestamp(c).isNotNull() & c.rlike(r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}"), "string": F.lit(True)}


def _pairs(df: DataFrame, columns: Sequence[str], typed: bool) -> DataFrame:
    """(at, hash, n, one flag for each kind): each column's different values with how often they occur; null has no hash."""
    q = lambda c: F.col(f"`{c}`")
    hashed = lambda c: F.when(q(c).isNotNull(), F.struct(F.xxhash64(q(c)).alias("a"), F.xxhash64(F.lit(1), q(c)).alias("b")))
    text = {c for c, kind in df.dtypes if kind == "string"}

    def kinds(c: str) -> Column:
        fits = _fits(q(c)) if typed and c in text else {}
        return F.struct(*(F.when(q(c).isNotNull(), fits.get(k, F.lit(None)).cast("boolean")).alias(k) for k in KINDS))

    cells = F.array(*(F.struct(F.lit(i).alias("at"), hashed(c).alias("hash"), kinds(c).alias("kind")) for i, c in enumerate(columns)))
    long = df.select(F.explode(cells).alias("cell")).select("cell.*")
    # Equal values are of equal kinds, so any of their flags serves.
    return long.groupBy("at", "hash").agg(F.count(F.lit(1)).alias("n"), *(F.max(f"kind.{k}").alias(k) for k in KINDS))


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, typed: bool = False) -> DataFrame:
    """Per column: rows, nulls, non-nulls, exact distinct values and the percentage of nulls.

    ``typed`` adds inferred_type for columns of text: the narrowest of ``KINDS`` that all values
    have, null if there is no value. An empty table has a row of zeros for each column.
    """
    names = list(columns or df.columns)
    pairs, held = _pairs(df, names, typed), F.col("hash").isNotNull()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    each = pairs.groupBy("at").agg(total(F.col("n")).alias("n_rows"), total(F.when(~held, F.col("n"))).alias("null_count"), F.count_if(held).alias("distinct_count"), *(F.min(k).alias(k) for k in KINDS))
    columns_ = df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(names)], "at int, column_name string")
    out = columns_.join(each, "at", "left").fillna(0, ["n_rows", "null_count", "distinct_count"])
    n, nulls = F.col("n_rows"), F.col("null_count")
    found = [(n - nulls).alias("non_null_count"), "distinct_count", X.percentage(nulls, n).alias("null_pct")]
    kind = F.coalesce(*(F.when(F.col(k), k) for k in KINDS)).alias("inferred_type")
    return out.select("column_name", "n_rows", "null_count", *found, *([kind] if typed else []))


def key_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per candidate key: nulls, distinct values, repeated non-null values, and whether it is unique and complete."""
    repeated = F.col("non_null_count") - F.col("distinct_count")
    return column_profile(df, columns).select("column_name", "n_rows", "null_count", "distinct_count", repeated.alias("duplicate_count"), ((repeated == 0) & (F.col("null_count") == 0)).alias("is_unique_and_complete"))


def table_profile(df: DataFrame) -> DataFrame:
    """One row: rows, columns, null cells, rows beyond the first of equal ones, rows without any value."""
    nulls = reduce(lambda a, b: a + b, (F.col(f"`{c}`").isNull().cast("int") for c in df.columns))
    # Rows are counted as hashes; a null differs from its neighbour's null.
    cells = [x for c in df.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    same = df.select(nulls.alias("nulls"), F.xxhash64(*cells).alias("a"), F.xxhash64(F.lit(1), *cells).alias("b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.max("nulls").alias("nulls"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    n = F.col("n")
    return same.agg(total(n).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"), total(n * F.col("nulls")).alias("null_cells"), total(F.when(F.col("nulls") == len(df.columns), n)).alias("empty_rows"), total(n - 1).alias("additional_rows"))


def grain_profiles(tables: Mapping[str, DataFrame], grains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per table with a declared grain: its columns, whether all are there, rows, rows with a null, rows beyond the first of each grain, and whether it holds, which an empty table doesn't show."""
    parts = []
    for name, grain in grains.items():
        if name not in tables:
            continue
        there = all(c in tables[name].columns for c in grain)
        counts = R.grain_metrics(tables[name], [f"`{c}`" for c in grain]) if there else tables[name].agg(F.count(F.lit(1)).alias("n_rows"), F.lit(None).cast("bigint").alias("null_grain_rows"), F.lit(None).cast("bigint").alias("duplicate_grain_rows"))
        holds = F.coalesce((F.col("n_rows") > 0) & (F.col("null_grain_rows") == 0) & (F.col("duplicate_grain_rows") == 0), F.lit(False))
        parts.append(counts.select(F.lit(name).alias("table_name"), F.lit(", ".join(grain)).alias("grain"), F.lit(there).alias("has_columns"), "n_rows", "null_grain_rows", "duplicate_grain_rows", holds.alias("holds")))
    return reduce(DataFrame.unionByName, parts)


def table_profiles(tables: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, (table_profile(df).select(F.lit(name).alias("table_name"), "*") for name, df in tables.items()))


def missing_parents(tables: Mapping[str, DataFrame], root: str, key: str) -> DataFrame:
    """Per table that has the key beside the root: its different keys, and those that the root lacks. One pass over the keys of all tables."""
    keyed = {n: df for n, df in tables.items() if n != root and key in df.columns}
    if root not in tables or not keyed:
        return next(iter(tables.values())).sparkSession.createDataFrame([], "table_name string, distinct_keys long, missing_keys long")
    keys = [df.select(F.lit(n).alias("table_name"), F.col(f"`{key}`").alias("_key")) for n, df in {root: tables[root], **keyed}.items()]
    pairs = reduce(DataFrame.unionByName, keys).filter("_key IS NOT NULL").distinct()
    each = pairs.groupBy("_key").agg(F.collect_set("table_name").alias("_in"))  # no more than there are tables
    rows = each.select(F.array_contains("_in", root).alias("_known"), F.explode("_in").alias("table_name")).filter(F.col("table_name") != root)
    return rows.groupBy("table_name").agg(F.count(F.lit(1)).alias("distinct_keys"), F.count_if(~F.col("_known")).alias("missing_keys"))


def archive_profile(tables: Mapping[str, DataFrame], root: str, key: str) -> DataFrame:
    """One row of totals: tables, rows, cells, null cells, repeated rows, empty rows, keys without a parent, summed over the tables that lack them."""
    sums = table_profiles(tables).agg(F.count(F.lit(1)).alias("tables"), *(F.sum(c).cast("bigint").alias(a) for a, c in {"n_rows": F.col("n_rows"), "cells": F.col("n_rows") * F.col("n_columns"), "null_cells": F.col("null_cells"), "additional_rows": F.col("additional_rows"), "empty_rows": F.col("empty_rows")}.items()))
    return sums.join(missing_parents(tables, root, key).agg(F.coalesce(F.sum("missing_keys"), F.lit(0)).cast("bigint").alias("missing_parent_keys")))  # both sides are one row


def read_tables(spark: SparkSession, root: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """The named typed tables below ``root``; all that are missing are named in the error."""
    held, gone = {}, []
    for name in names:
        try:
            held[name] = spark.read.parquet(f"{root}/{name}")
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
                raise
            gone.append(name)
    if gone:
        raise FileNotFoundError(f"{root} lacks {', '.join(sorted(gone))}")
    return held
