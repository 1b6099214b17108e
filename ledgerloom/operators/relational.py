"""Relational building blocks: guarded joins, lookups, canonical values, keys, grains and orphans.

DataFrames in, DataFrames out; only ``dense_keys`` runs jobs of its own. Joins carry no
broadcast hints but on a row for each partition: the sides that are dimensions are small by
their statistics, and adaptive execution broadcasts them when they are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import exprs as X
from ledgerloom.sources.scratch import written


def asserted_unique(df: DataFrame, keys: Sequence[str], message: str) -> DataFrame:
    """``df`` whose evaluation raises if a key occurs twice; nulls are equal to each other.

    An aggregate with partial sums: a key of very many rows, such as null, is counted by each
    task before it meets in one row, and the result is dealt by the keys for the join after it.
    """
    # Columns are held one by one: where all are numbers, flags or times, the aggregate hashes and sorts nothing.
    rest = [F.any_value(F.col(f"`{c}`")).alias(c) for c in df.columns if c not in keys]
    one = df.groupBy(*(F.col(f"`{k}`") for k in keys)).agg(F.count(F.lit(1)).alias("_rows_of_key"), *rest)
    one = one.filter(F.coalesce(F.assert_true(F.col("_rows_of_key") == 1, message).isNull(), F.lit(True)))
    return one.select(*(F.col(f"`{c}`") for c in df.columns))


def join_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str], kind: str = "left") -> DataFrame:
    """Many to one: ``right`` is unique on ``keys``, or the query raises."""
    return left.join(asserted_unique(right, keys, f"join is not many-to-one on {', '.join(keys)}"), list(keys), kind)


def join_one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str], kind: str = "left") -> DataFrame:
    return join_to_one(asserted_unique(left, keys, f"join is not one-to-one on {', '.join(keys)}"), right, keys, kind)


def lookup_key(df: DataFrame, dim: DataFrame, on: Mapping[str, str], key: str, alias: str | None = None) -> DataFrame:
    """Adds the dimension's surrogate key: columns of ``df`` (keys of ``on``) equal those of ``dim``, null equals null, a miss is 0.

    The dimension has each natural key once, or the query raises, so that no row of ``df`` is multiplied.
    """
    side = dim.select(F.col(key).alias("_key"), *(F.col(d).alias(f"_on{i}") for i, d in enumerate(on.values())))
    side = asserted_unique(side, [f"_on{i}" for i in range(len(on))], f"a dimension repeats {', '.join(on.values())}")
    condition = None
    for i, c in enumerate(on):
        one = df[c].eqNullSafe(side[f"_on{i}"])
        condition = one if condition is None else condition & one
    return df.join(side, condition, "left").withColumn(alias or key, F.coalesce("_key", F.lit(0))).select(*df.columns, alias or key)


def canonical_by_key(df: DataFrame, keys: Sequence[str], value: str, alias: str, folded: bool = True) -> DataFrame:
    """The most frequent value of each key; ties go to the smallest folded text, then the smallest value. Null values and keys don't count."""
    counts = df.filter(~X.any_null(F.col(c) for c in (*keys, value))).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    text = X.folded(F.col(value).cast("string")) if folded else F.lower(F.col(value).cast("string"))
    counts = counts.withColumn("_text", text)
    return counts.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("_n"), "_text", value)).alias(alias))


def canonical_values(df: DataFrame, keys: Sequence[str], values: Mapping[str, str], weight: str | None = None) -> DataFrame:
    """The keys with the canonical value of each column (result name: column), as ``canonical_by_key`` finds it.

    All columns go through one grouping as (keys, column, value), whatever their number. Keys
    with a null are left out; a column without a value is null. A row counts once, or as
    often as its ``weight`` says.
    """
    types, times = dict(df.dtypes), F.col(weight) if weight else F.lit(1)
    cells = F.array(*(F.struct(F.lit(alias).alias("_name"), F.col(c).cast("string").alias("_value")) for alias, c in values.items()))
    long = df.dropna(subset=list(keys)).select(*keys, times.alias("_times"), F.explode(cells).alias("_cell")).select(*keys, "_times", "_cell._name", "_cell._value")
    counts = long.groupBy(*keys, "_name", "_value").agg(F.sum("_times").alias("_n")).withColumn("_text", X.folded("_value"))
    first = F.min_by("_value", F.when(F.col("_value").isNotNull(), F.struct(-F.col("_n"), "_text", "_value")))
    each = counts.groupBy(*keys, "_name").agg(first.alias("_value"))
    return each.groupBy(*keys).agg(*(F.max(F.when(F.col("_name") == alias, F.col("_value"))).cast(types[c]).alias(alias) for alias, c in values.items()))


def dense_keys(df: DataFrame, order: Sequence[str], key: str) -> DataFrame:
    """Surrogate keys 1..n in the order of the columns, nulls last, without one task for all rows.

    Rows are sorted over ranges and written once, each with its range and its place in it;
    the counts of the ranges, one row for each, give the offsets. Both read the same written
    rows, so that a row's range can't change between them. Rows equal in ``order`` get keys
    in no fixed order.
    """
    spark = df.sparkSession
    parted = df.repartitionByRange(*(F.col(c).asc_nulls_last() for c in order)).sortWithinPartitions(*(F.col(c).asc_nulls_last() for c in order))
    # The number counts the rows of a partition in its low 33 bits, after the partition's number.
    numbered = written(parted.withColumn("_numbered", F.monotonically_increasing_id()))
    part, row = F.shiftright("_numbered", 33), F.col("_numbered").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size")).collect()  # a row for each partition
    offsets, total = [], 0
    for size in sorted(sizes):
        offsets.append((size._part, total))
        total += size._size
    held = spark.createDataFrame(offsets, "_part long, _offset long")
    return numbered.join(F.broadcast(held), part == F.col("_part")).select((F.col("_offset") + row).cast("bigint").alias(key), *df.columns)


def dimension_keys(df: DataFrame, order: Sequence[str], key: str) -> DataFrame:
    """As ``dense_keys`` with keys of 32 bits, for dimensions."""
    return dense_keys(df, order, key).withColumn(key, F.col(key).cast("int"))


def with_unknown(dim: DataFrame, key: str, values: Mapping[str, object]) -> DataFrame:
    """Adds the unknown member with key 0; attributes not named are null."""
    row = [0 if f.name == key else values.get(f.name) for f in dim.schema.fields]
    unknown = dim.sparkSession.range(1).select(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, dim.schema.fields)))
    return unknown.unionByName(dim)


def orphans(child: DataFrame, parent: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Child rows with a complete key that no parent row has."""
    parents = parent.select(*(F.col(p).alias(c) for c, p in keys.items())).distinct()
    return child.dropna(subset=list(keys)).join(parents, list(keys), "left_anti")


def grain_metrics(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, rows with a null in the grain, rows beyond the first of each grain (nulls group together)."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    null = X.any_null(F.col(c) for c in keys)
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce(F.sum(F.when(null, F.col("n")).otherwise(0)), F.lit(0)).cast("bigint").alias("null_grain_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_grain_rows"),
    )


def cardinality(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: parents, rows, least, median and most rows for a parent, parents with several."""
    groups = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.count(F.lit(1)).alias("parents"), F.sum("n").cast("bigint").alias("n_rows"), F.min("n").alias("least"), F.median("n").cast("double").alias("median"), F.max("n").alias("most"), F.count_if(F.col("n") > 1).alias("multi_row_parents"))


def exact_duplicates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: rows, rows beyond the first of each group of equal ones, and rows in such groups."""
    groups = df.groupBy(*(columns or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("additional_rows"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)), F.lit(0)).cast("bigint").alias("affected_rows"))


def split_duplicates(df: DataFrame, columns: Sequence[str], order: str) -> tuple[DataFrame, DataFrame]:
    """(first row of each group of equal ones, the others): exactly one row of each group is the first.

    The first has the smallest ``order``, a null being the last; of rows with one order the
    smallest by their other columns comes first, and of fully equal rows one. Rows are counted
    before they are compared, so that a group of very many copies is one row for each task.
    """
    rest = [c for c in df.columns if c not in columns]
    q = lambda c: F.col(f"`{c}`")
    place = F.struct(q(order).isNull().alias("_last"), q(order).alias("_order"), *(q(c).alias(f"_c{i}") for i, c in enumerate(rest)))
    counted = df.groupBy(*map(q, df.columns)).agg(F.count(F.lit(1)).alias("_n")).withColumn("_place", place)
    first = counted.groupBy(*(q(c).alias(f"_d{i}") for i, c in enumerate(columns))).agg(F.min("_place").alias("_first"))
    condition = F.lit(True)
    for i, c in enumerate(columns):
        condition = condition & counted[f"`{c}`"].eqNullSafe(first[f"_d{i}"])
    both = counted.join(first, condition).withColumn("_is_first", F.col("_place").eqNullSafe(F.col("_first")))
    others = both.withColumn("_n", F.col("_n") - F.col("_is_first").cast("int")).filter("_n > 0").withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_n").cast("int"))))
    return both.filter("_is_first").select(*map(q, df.columns)), others.select(*map(q, df.columns))


def child_sums(parent: DataFrame, child: DataFrame, keys: Sequence[str], header: str, amount: str) -> DataFrame:
    """``parent`` with the sum and number of its child amounts, the difference to the header and whether they agree."""
    sums = child.groupBy(*keys).agg(F.sum(F.col(amount).cast(X.MONEY)).cast(X.MONEY).alias("item_sum"), F.count(F.lit(1)).alias("item_count"))
    out = parent.join(sums, list(keys), "left").withColumn("item_count", F.coalesce("item_count", F.lit(0)).cast("bigint"))
    out = out.withColumn("header_item_difference", X.difference(F.col(header), F.col("item_sum")))
    return out.withColumn("is_reconciled", X.within(F.col("header_item_difference")))


def single_supplier(bridge: DataFrame, keys: Sequence[str], supplier: str) -> DataFrame:
    """Per parent: the number of suppliers, and the supplier if there is exactly one, else null."""
    groups = bridge.dropna(subset=[*keys, supplier]).groupBy(*keys).agg(F.count_distinct(supplier).alias("supplier_count"), F.max(supplier).alias("_one"))
    only = F.col("supplier_count") == 1
    return groups.select(*keys, "supplier_count", F.when(only, F.col("_one")).alias("attributed_supplier"), only.alias("is_attributable"))


def currency_totals(df: DataFrame, currency: str, amount: str, **labels: str) -> DataFrame:
    """Per currency: rows, non-null amounts and their exact sum; blank currencies are the governed token."""
    named = df.select(X.governed(F.col(currency)).alias("currency_code"), F.col(amount).cast("decimal(38,4)").alias("amount"))
    out = named.groupBy("currency_code").agg(F.count(F.lit(1)).alias("row_count"), F.count("amount").alias("non_null_count"), F.sum("amount").cast("decimal(38,4)").alias("total_amount"))
    return out.select(*(F.lit(v).alias(k) for k, v in labels.items()), *out.columns)


def rate_coverage(parents: DataFrame, rates: DataFrame, keys: Sequence[str], currency: str, home: str = "PEN") -> DataFrame:
    """One row: different foreign parents, those with and without a rate, and rates of no foreign parent."""
    foreign = parents.filter((F.col(currency) != home) & ~X.any_null(F.col(k) for k in keys)).select(*keys).distinct()
    known = rates.dropna(subset=list(keys)).select(*keys).distinct().withColumn("_rate", F.lit(True))
    both = foreign.withColumn("_foreign", F.lit(True)).join(known, list(keys), "full")
    return both.agg(F.count("_foreign").alias("foreign_rows"), F.count_if(F.col("_foreign") & F.col("_rate")).alias("with_rate"), F.count_if(F.col("_foreign") & F.col("_rate").isNull()).alias("without_rate"), F.count_if(F.col("_foreign").isNull()).alias("unused_rates"))


def reconciled(actual: DataFrame, expected: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Two-sided comparison on ``keys``, where null equals null: actual and expected values, and PASS or FAIL; a side without a row fails."""
    a = actual.select(*(F.col(k).alias(f"_a_{k}") for k in keys), *(F.col(v).alias(f"actual_{v}") for v in values), F.lit(True).alias("_a"))
    e = expected.select(*(F.col(k).alias(f"_e_{k}") for k in keys), *(F.col(v).alias(f"expected_{v}") for v in values), F.lit(True).alias("_e"))
    condition, same = F.lit(True), F.col("_a").isNotNull() & F.col("_e").isNotNull()
    for k in keys:
        condition = condition & a[f"_a_{k}"].eqNullSafe(e[f"_e_{k}"])
    for v in values:
        same = same & F.col(f"actual_{v}").eqNullSafe(F.col(f"expected_{v}"))
    out = a.join(e, condition, "full").withColumn("status", F.when(same, "PASS").otherwise("FAIL"))
    sides = [F.coalesce(f"_a_{k}", f"_e_{k}").alias(k) for k in keys]
    return out.select(*sides, *(f"actual_{v}" for v in values), *(f"expected_{v}" for v in values), "status")
