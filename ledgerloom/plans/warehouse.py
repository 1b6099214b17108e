"""Star schema: conformed dimensions, grain-safe facts and factless bridges.

Builders are parameterised by column names, so that one item builder serves tenders, awards and
contracts. Dimensions hold an unknown member with key 0; a fact's lookup that misses gets it.
Amounts of headers and items are kept apart and compared, never forced to agree; amounts
belong to a supplier only where there is exactly one; rates are never invented.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import exprs as X
from ledgerloom.operators import relational as R

PERIOD = "source_period"


def dim_date(spark: SparkSession, observed: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """Every local day between the first and the last of the observed times, and the unknown member."""
    days = reduce(DataFrame.unionByName, (df.select(F.from_utc_timestamp(F.col(c).cast("timestamp"), X.LOCAL_ZONE).cast("date").alias("day")) for df, c in zip(observed, columns)))
    span = days.agg(F.min("day").alias("a"), F.max("day").alias("z")).filter("a IS NOT NULL")
    full = span.select(F.explode(F.sequence("a", "z")).alias("full_date"))
    dim = full.select(F.date_format("full_date", "yyyyMMdd").cast("int").alias("date_key"), "full_date", *(c.alias(n) for n, c in X.calendar_columns(F.col("full_date")).items()))
    return R.with_unknown(dim, "date_key", {})


def dim_party(parties: DataFrame, roles: str, pattern: str, key: str, natural: str, attributes: Mapping[str, str]) -> DataFrame:
    """Parties in a role: each attribute's canonical value, the number of names and whether they conflict, first and last period."""
    rows = parties.filter(X.role_matches(F.col(roles), pattern) & F.col(natural).isNotNull())
    first = next(iter(attributes.values()))
    out = rows.groupBy(natural).agg(F.count_distinct(first).alias("name_variant_count"), F.min(PERIOD).alias("first_period"), F.max(PERIOD).alias("last_period"))
    out = out.withColumn("dq_name_conflict", F.col("name_variant_count") > 1)
    for alias, column in attributes.items():
        out = out.join(R.canonical_by_key(rows, [natural], column, alias), natural, "left")
    dim = R.dense_keys(out.withColumnRenamed(natural, "source_party_id"), ["source_party_id"], key)
    return R.with_unknown(dim, key, {"source_party_id": X.UNKNOWN, next(iter(attributes)): X.UNKNOWN, "name_variant_count": 0, "dq_name_conflict": False})


def dim_category(observed: Sequence[tuple[DataFrame, str, str, str]]) -> DataFrame:
    """From (table, scheme, code, description): one row for each scheme and code. Rows flagged as missing, or without scheme or code, fold into key 0."""
    code, text, scheme = X.UNCLASSIFIED
    parts = []
    for df, s, c, d in observed:
        missing = F.coalesce(F.col("dq_classification_was_missing"), F.lit(False)) | F.col(s).isNull() | F.col(c).isNull()
        pick = lambda column, token: F.when(missing, token).otherwise(F.col(column))  # noqa: B023, E731
        parts.append(df.select(pick(s, scheme).alias("scheme"), pick(c, code).alias("code"), pick(d, text).alias("description"), PERIOD))
    union = reduce(DataFrame.unionByName, parts)
    keys = ["scheme", "code"]
    counts = union.groupBy(*keys).agg(F.count_distinct("description").alias("description_variant_count"), F.min(PERIOD).alias("first_period"), F.max(PERIOD).alias("last_period"))
    counts = counts.join(R.canonical_by_key(union, keys, "description", "description"), keys, "left").withColumn("dq_description_conflict", F.col("description_variant_count") > 1)
    known = R.dimension_keys(counts.filter((F.col("scheme") != scheme) | (F.col("code") != code)), keys, "category_key")
    return R.with_unknown(known, "category_key", {"scheme": scheme, "code": code, "description": text, "description_variant_count": 1, "dq_description_conflict": False})


def dim_method(processes: DataFrame, method: str, details: str) -> DataFrame:
    """Pairs of method and details, without the pair of which both are unknown."""
    pairs = processes.select(F.coalesce(F.col(method), F.lit(X.UNKNOWN)).alias("method"), F.coalesce(F.col(details), F.lit(X.UNKNOWN)).alias("details"), PERIOD)
    pairs = pairs.filter((F.col("method") != X.UNKNOWN) | (F.col("details") != X.UNKNOWN))
    found = pairs.groupBy("method", "details").agg(F.min(PERIOD).alias("first_period"), F.max(PERIOD).alias("last_period"))
    return R.with_unknown(R.dimension_keys(found, ["method", "details"], "method_key"), "method_key", {"method": X.UNKNOWN, "details": X.UNKNOWN})


def dim_of_union(observed: Sequence[tuple[DataFrame, Mapping[str, str]]], natural: Sequence[str], key: str, name: str | None = None) -> DataFrame:
    """Currencies and units: values of several tables united under common names; rows without a natural key are left out."""
    union = reduce(DataFrame.unionByName, (df.select(*(F.col(c).alias(a) for a, c in columns.items()), PERIOD) for df, columns in observed)).dropna(subset=list(natural))
    out = union.groupBy(*natural).agg(F.min(PERIOD).alias("first_period"), F.max(PERIOD).alias("last_period"))
    if name:
        out = out.join(R.canonical_by_key(union, list(natural), name, name), list(natural), "left")
    return R.with_unknown(R.dimension_keys(out, list(natural), key), key, dict.fromkeys(natural, X.UNKNOWN))


@dataclass(frozen=True)
class Header:
    """Columns of an award or a contract, with those of its items, suppliers and rates."""

    keys: Sequence[str]
    amount: str
    currency: str
    date: str
    item_amount: str
    supplier: str
    rate: str = "rate"


def fact_header(headers: DataFrame, items: DataFrame, bridge: DataFrame, rates: DataFrame, suppliers: DataFrame, currencies: DataFrame, spec: Header, key: str) -> DataFrame:
    """One row for each header: keys, amounts, attribution, conversion and reconciliation with its items."""
    keys = list(spec.keys)
    out = R.child_sums(headers, items, keys, spec.amount, spec.item_amount)
    out = out.join(R.single_supplier(bridge, keys, spec.supplier), keys, "left").withColumn("supplier_count", F.coalesce("supplier_count", F.lit(0)))
    out = R.join_to_one(out, rates.select(*keys, F.col(spec.rate).alias("_source_rate")), keys)
    out = out.withColumn("exchange_rate", X.rate_for(F.col(spec.currency), F.col("_source_rate")))
    out = out.withColumn("amount_pen", X.converted(F.col(spec.amount), F.col("exchange_rate"))).withColumn("dq_conversion_available", F.col("amount_pen").isNotNull())
    out = R.lookup_key(out, suppliers, {"attributed_supplier": "source_party_id"}, "supplier_key", "attributed_supplier_key")
    out = out.withColumn("attributed_supplier_key", F.when(F.col("attributed_supplier").isNull(), 0).otherwise(F.col("attributed_supplier_key")))
    out = out.withColumn("dq_supplier_amount_attributable", F.col("attributed_supplier_key") != 0)
    out = R.lookup_key(out, currencies, {spec.currency: "code"}, "currency_key").withColumn("date_key", X.date_key(F.col(spec.date)))
    return R.dense_keys(out.drop("_source_rate", "attributed_supplier", "is_attributable"), keys, key)


def fact_item(items: DataFrame, parents: DataFrame, categories: DataFrame, parent_keys: Sequence[str], grain: Sequence[str], scheme: str, code: str, key: str, inherited: Sequence[str] = ("attributed_supplier_key", "dq_supplier_amount_attributable")) -> DataFrame:
    """One row for each item: its category, and what it inherits from its header. An item flagged as unclassified has category 0, whatever its code."""
    out = items.join(parents.select(*parent_keys, *inherited), list(parent_keys), "left")
    out = R.lookup_key(out, categories, {scheme: "scheme", code: "code"}, "category_key")
    out = out.withColumn("category_key", F.when(F.coalesce(F.col("dq_classification_was_missing"), F.lit(False)), 0).otherwise(F.col("category_key")))
    return R.dense_keys(out.withColumn("item_count", F.lit(1)), list(grain), key)


def bridge(pairs: DataFrame, parents: DataFrame, suppliers: DataFrame, on: Sequence[str], parent_key: str, supplier: str) -> DataFrame:
    """Participation without money: a row for each pair of parent and supplier."""
    found = R.join_to_one(pairs.select(*on, supplier).distinct(), parents.select(*on, parent_key), list(on), "inner")
    return R.lookup_key(found, suppliers, {supplier: "source_party_id"}, "supplier_key").select(parent_key, "supplier_key").distinct()


def check_warehouse(dimensions: Mapping[str, tuple[DataFrame, str]], bridges: Mapping[str, DataFrame]) -> DataFrame:
    """rule_id, subject, violations: one unknown member in each dimension, no money and no unresolved key in bridges."""
    parts = [df.agg(F.abs(F.count_if(F.col(key) == 0) - 1).cast("bigint").alias("violations")).select(F.lit("WH-UNKNOWN").alias("rule_id"), F.lit(name).alias("subject"), "violations") for name, (df, key) in dimensions.items()]
    for name, df in bridges.items():
        money = sum("amount" in c for c in df.columns)
        parts.append(df.agg((F.count_if(F.col("supplier_key") == 0) + money).cast("bigint").alias("violations")).select(F.lit("WH-BRIDGE").alias("rule_id"), F.lit(name).alias("subject"), "violations"))
    return reduce(DataFrame.unionByName, parts)
