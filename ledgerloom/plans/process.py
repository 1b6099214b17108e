"""The procurement process: its dimension, its fact, and what other facts take from it.

A process is one row for each natural key. Facts of lower grains inherit its keys by a guarded
many-to-one join; categories come in two kinds, an item's own and the standard one of its
additional classifications.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import exprs as X
from ledgerloom.operators import relational as R

from .warehouse import PERIOD


@dataclass(frozen=True)
class Process:
    """Columns of a process table."""

    key: str
    buyer: str
    method: str
    details: str
    published: str
    amount: str
    currency: str
    item_amount: str
    declared: str
    zero_flag: str | None = None
    #: Result name of further date keys, and their columns.
    dates: Mapping[str, str] = None  # type: ignore[assignment]
    #: Result name of further amounts, and their columns.
    amounts: Mapping[str, str] = None  # type: ignore[assignment]


def dim_process(processes: DataFrame, natural: str, attributes: Mapping[str, str], key: str = "process_key") -> DataFrame:
    """One row for each process with its attributes (result name: column), in the order of the natural key as text, and the unknown member."""
    columns = [F.col(natural).cast("string").alias("natural_id"), *(F.col(c).alias(a) for a, c in attributes.items()), F.col(PERIOD).alias("first_period"), F.col(PERIOD).alias("last_period")]
    dim = R.dimension_keys(R.asserted_unique(processes.select(*columns), ["natural_id"], "a process occurs twice"), ["natural_id"], key)
    return R.with_unknown(dim, key, {"natural_id": X.UNKNOWN})


def known_method(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(X.UNKNOWN))


def process_context(processes: DataFrame, spec: Process, process: DataFrame, buyers: DataFrame, methods: DataFrame) -> DataFrame:
    """Natural key, process_key, buyer_key, method_key and the date key of publication: what facts of lower grains inherit."""
    rows = processes.select(spec.key, F.col(spec.key).cast("string").alias("_natural"), F.col(spec.buyer).alias("_buyer"), known_method(spec.method).alias("_method"), known_method(spec.details).alias("_details"), X.date_key(F.col(spec.published)).alias("published_date_key"))
    rows = R.lookup_key(rows, process, {"_natural": "natural_id"}, "process_key")
    rows = R.lookup_key(rows, buyers, {"_buyer": "source_party_id"}, "buyer_key")
    rows = R.lookup_key(rows, methods, {"_method": "method", "_details": "details"}, "method_key")
    return rows.select(spec.key, "process_key", "buyer_key", "method_key", "published_date_key")


def inherited(df: DataFrame, context: DataFrame, key: str) -> DataFrame:
    """``df`` with the process's keys; a row of no known process gets the unknown members."""
    names = [c for c in context.columns if c != key]
    return R.join_to_one(df, context, [key]).fillna(0, names)


def category_keys(items: DataFrame, additional: DataFrame, categories: DataFrame, grain: Sequence[str], own: tuple[str, str], standard: tuple[str, str]) -> DataFrame:
    """``items`` with category_key, standard_category_key and whether the standard one is missing.

    ``own`` and ``standard`` are columns of scheme and code; an item has one additional
    classification at most.
    """
    side = additional.select(*grain, F.col(standard[0]).alias("_scheme"), F.col(standard[1]).alias("_code"))
    out = R.join_one_to_one(items, side, list(grain))
    out = R.lookup_key(out, categories, {own[0]: "scheme", own[1]: "code"}, "category_key")
    out = R.lookup_key(out, categories, {"_scheme": "scheme", "_code": "code"}, "category_key", "standard_category_key")
    return out.withColumn("dq_standard_category_missing", F.col("standard_category_key") == 0).drop("_scheme", "_code")


def fact_process(processes: DataFrame, items: DataFrame, tenderers: DataFrame, context: DataFrame, currencies: DataFrame, spec: Process, key: str = "process_fact_key") -> DataFrame:
    """One row for each process: keys, amounts, declared and observed tenderers, and the header held against its items."""
    dates, amounts = spec.dates or {}, spec.amounts or {}
    kept = [spec.key, F.col(spec.amount).alias("amount"), F.col(spec.currency).alias("_currency"), F.col(spec.declared).alias("tenderer_count_declared")]
    kept += [X.date_key(F.col(c)).alias(a) for a, c in dates.items()] + [F.col(c).alias(a) for a, c in amounts.items()]
    kept.append((F.coalesce(F.col(spec.zero_flag), F.lit(False)) if spec.zero_flag else X.is_zero(F.col(spec.amount))).alias("dq_value_is_zero"))
    out = R.child_sums(processes.select(*kept), items.select(spec.key, F.col(spec.item_amount).alias("_item_amount")), [spec.key], "amount", "_item_amount")
    observed = tenderers.groupBy(spec.key).agg(F.count(F.lit(1)).alias("tenderer_count_observed"))
    out = out.join(observed, spec.key, "left").fillna(0, ["tenderer_count_observed"])
    out = out.withColumn("dq_tenderer_count_matches", F.coalesce(F.col("tenderer_count_declared") == F.col("tenderer_count_observed"), F.lit(False)))
    out = R.lookup_key(inherited(out, context, spec.key), currencies, {"_currency": "code"}, "currency_key").withColumn("process_count", F.lit(1))
    return R.dense_keys(out.drop("_currency"), [spec.key], key)
