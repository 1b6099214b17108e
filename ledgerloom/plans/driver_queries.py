"""The engine's operators over the driver's tables, one registered query each.

The tables are TPC-H-like and hold no nulls, so queries derive what an operator needs: a
priority of ``4-NOT SPECIFIED`` is a missing classification, a nation has a currency, and only
some currencies have a rate. Money is cast to decimals before it is summed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import exprs as X
from ledgerloom.operators import quality as Q
from ledgerloom.operators import profile as PF
from ledgerloom.operators import relational as R
from ledgerloom.plans import process as P
from ledgerloom.plans import validation as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(name: str, scale: int = 4) -> Column:
    return F.col(name).cast(f"decimal(18,{scale})")


def currency(key: Column) -> Column:
    return F.when(key % 3 == 0, "PEN").when(key % 3 == 1, "USD").otherwise("EUR")


def priority() -> Column:
    return F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED"))


def orders_with_currency(spark: SparkSession, d: str) -> DataFrame:
    """Each order with its customer's nation and that nation's currency; one nation in three pays in PEN."""
    customers = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return table(spark, d, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).withColumn("currency_code", currency(F.col("c_nationkey")))


#: DuckDB twin of ``orders_with_currency``.
_OC = "oc AS (SELECT o.*, c_nationkey, CASE WHEN c_nationkey % 3 = 0 THEN 'PEN' WHEN c_nationkey % 3 = 1 THEN 'USD' ELSE 'EUR' END AS currency_code FROM orders o JOIN customer ON o_custkey = c_custkey)"


@query("""
WITH s AS (SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DECIMAL(38,14)) AS item_sum, count(*) AS n FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,4)) AS header_amount, CAST(item_sum AS DECIMAL(18,4)) AS item_sum, coalesce(n, 0) AS item_count,
       CAST(CAST(o_totalprice AS DECIMAL(18,4)) - item_sum AS DECIMAL(18,4)) AS header_item_difference, coalesce(abs(CAST(o_totalprice AS DECIMAL(18,4)) - item_sum) <= 0.01, false) AS is_reconciled
FROM orders LEFT JOIN s ON l_orderkey = o_orderkey""")
def q_header_item_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """Header totals against the sums of their items."""
    orders = table(spark, d, "orders").select("o_orderkey", money("o_totalprice").alias("header_amount"))
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), money("l_extendedprice").alias("amount"))
    out = R.child_sums(orders, items, ["o_orderkey"], "header_amount", "amount")
    return out.withColumn("item_sum", money("item_sum")).withColumn("header_item_difference", money("header_item_difference"))


@query("""
SELECT o_orderkey, coalesce(n, 0) AS supplier_count, CASE WHEN n = 1 THEN s END AS attributed_supplier, coalesce(n = 1, false) AS is_attributable
FROM orders LEFT JOIN (SELECT l_orderkey, count(DISTINCT l_suppkey) AS n, max(l_suppkey) AS s FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""")
def q_supplier_attribution(spark: SparkSession, d: str) -> DataFrame:
    """An order's amount belongs to a supplier only where there is exactly one."""
    one = R.single_supplier(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey"), ["o_orderkey"], "l_suppkey")
    out = table(spark, d, "orders").select("o_orderkey").join(one, "o_orderkey", "left")
    return out.select("o_orderkey", F.coalesce("supplier_count", F.lit(0)).cast("bigint").alias("supplier_count"), "attributed_supplier", F.coalesce("is_attributable", F.lit(False)).alias("is_attributable"))


@query("""
WITH a AS (SELECT l_orderkey AS k, CASE WHEN count(DISTINCT l_suppkey) = 1 THEN max(l_suppkey) END AS s FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, count(*) AS items, count_if(s IS NOT NULL) AS inherited, count_if(s IS NOT NULL AND s <> l_suppkey) AS contradictions FROM lineitem JOIN a ON k = l_orderkey GROUP BY l_orderkey""")
def q_attribution_inheritance(spark: SparkSession, d: str) -> DataFrame:
    """Items inherit the attribution of their header and never contradict it."""
    items = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    joined = items.join(R.single_supplier(items, ["l_orderkey"], "l_suppkey"), "l_orderkey")
    has = F.col("attributed_supplier").isNotNull()
    return joined.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("items"), F.count_if(has).alias("inherited"), F.count_if(has & (F.col("attributed_supplier") != F.col("l_suppkey"))).alias("contradictions"))


@query(f"""
WITH {_OC}, r AS (SELECT *, CAST(CASE currency_code WHEN 'PEN' THEN 1 WHEN 'USD' THEN 3.75 END AS DECIMAL(18,4)) AS rate FROM oc)
SELECT o_orderkey, currency_code, rate, CAST(CAST(o_totalprice AS DECIMAL(18,4)) * rate AS DECIMAL(38,8)) AS amount_pen, rate IS NOT NULL AS conversion_available FROM r""")
def q_pen_conversion(spark: SparkSession, d: str) -> DataFrame:
    """Home currency at rate 1, known rates applied, unknown ones never invented."""
    rates = spark.createDataFrame([("USD", "3.75")], "currency_code string, source_rate string").withColumn("source_rate", F.col("source_rate").cast("decimal(18,14)"))
    out = R.join_to_one(orders_with_currency(spark, d), rates, ["currency_code"]).withColumn("rate", X.rate_for(F.col("currency_code"), F.col("source_rate")))
    amount = X.converted(money("o_totalprice"), F.col("rate"))
    return out.select("o_orderkey", "currency_code", money("rate").alias("rate"), amount.cast("decimal(38,8)").alias("amount_pen"), amount.isNotNull().alias("conversion_available"))


@query(f"WITH {_OC} SELECT 'orders' AS control, currency_code, count(*) AS row_count, count(o_totalprice) AS non_null_count, CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DECIMAL(38,4)) AS total_amount FROM oc GROUP BY currency_code")
def q_currency_control_totals(spark: SparkSession, d: str) -> DataFrame:
    """Rows, amounts and exact sums for each currency."""
    rows = orders_with_currency(spark, d).select("currency_code", money("o_totalprice").alias("amount"))
    return R.currency_totals(rows, "currency_code", "amount", control="orders")


@query(f"""
WITH {_OC}, f AS (SELECT DISTINCT o_orderkey FROM oc WHERE currency_code <> 'PEN'), r AS (SELECT DISTINCT o_orderkey FROM oc WHERE currency_code = 'USD' AND o_orderkey % 5 <> 0)
SELECT (SELECT count(*) FROM f) AS foreign_rows, (SELECT count(*) FROM f SEMI JOIN r USING (o_orderkey)) AS with_rate, (SELECT count(*) FROM f ANTI JOIN r USING (o_orderkey)) AS without_rate, (SELECT count(*) FROM r ANTI JOIN f USING (o_orderkey)) AS unused_rates""")
def q_fx_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Foreign orders with and without a rate."""
    orders = orders_with_currency(spark, d).select("o_orderkey", "currency_code")
    return R.rate_coverage(orders, orders.filter("currency_code = 'USD' AND o_orderkey % 5 <> 0"), ["o_orderkey"], "currency_code")


@query("SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS null_grain_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_grain_rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)")
def q_grain_metrics(spark: SparkSession, d: str) -> DataFrame:
    return R.grain_metrics(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


@query("SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS additional_rows, CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS affected_rows FROM (SELECT count(*) AS n FROM documents GROUP BY text)")
def q_exact_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return R.exact_duplicates(table(spark, d, "documents").select("text"))


@query("SELECT min(doc_id) AS doc_id, any_value(n_chars) AS n_chars FROM documents GROUP BY text")
def q_dedup_keep_first(spark: SparkSession, d: str) -> DataFrame:
    """Of rows with equal text the first stays."""
    return R.split_duplicates(table(spark, d, "documents"), ["text"], "doc_id")[0].select("doc_id", "n_chars")


@query("SELECT doc_id, 'DQ-DUP-001' AS rule_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents) WHERE k > 1")
def q_quarantine_rows(spark: SparkSession, d: str) -> DataFrame:
    """The other rows go to quarantine under the rule that rejected them."""
    return R.split_duplicates(table(spark, d, "documents"), ["text"], "doc_id")[1].select("doc_id", F.lit("DQ-DUP-001").alias("rule_id"))


@query("SELECT p_brand, p_type AS canonical_type FROM (SELECT p_brand, p_type, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, lower(p_type), p_type) AS k FROM part GROUP BY p_brand, p_type) WHERE k = 1")
def q_canonical_mode(spark: SparkSession, d: str) -> DataFrame:
    """The most frequent type of each brand, ties by folded text."""
    return R.canonical_by_key(table(spark, d, "part").select("p_brand", "p_type"), ["p_brand"], "p_type", "canonical_type")


@query("SELECT p_name, count(DISTINCT p_type) AS variants, min(p_type) AS first_type, max(p_type) AS last_type, count(DISTINCT p_type) > 1 AS has_conflict FROM part GROUP BY p_name")
def q_name_variants(spark: SparkSession, d: str) -> DataFrame:
    n = F.count_distinct("p_type")
    return table(spark, d, "part").groupBy("p_name").agg(n.alias("variants"), F.min("p_type").alias("first_type"), F.max("p_type").alias("last_type"), (n > 1).alias("has_conflict"))


_MONTHS = "['enero','febrero','marzo','abril','mayo','junio','julio','agosto','septiembre','octubre','noviembre','diciembre']"
_DAYS = "['lunes','martes','miércoles','jueves','viernes','sábado','domingo']"


@query(f"""
WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS z FROM orders), d AS (SELECT CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS full_date FROM b)
SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date, CAST(year(full_date) AS INTEGER) AS year_number, CAST((month(full_date) - 1) // 6 + 1 AS INTEGER) AS semester_number, CAST(quarter(full_date) AS INTEGER) AS quarter_number, CAST(month(full_date) AS INTEGER) AS month_number, {_MONTHS}[month(full_date)] AS month_name, strftime(full_date, '%Y-%m') AS year_month, CAST(day(full_date) AS INTEGER) AS day_number, CAST(isodow(full_date) AS INTEGER) AS iso_weekday, {_DAYS}[isodow(full_date)] AS weekday_name, isodow(full_date) >= 6 AS is_weekend FROM d
UNION ALL SELECT 0, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL""")
def q_dim_calendar(spark: SparkSession, d: str) -> DataFrame:
    """A continuous calendar over the observed dates, with the unknown member."""
    bounds = table(spark, d, "orders").agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("z"))
    days = bounds.select(F.explode(F.sequence("a", "z")).alias("full_date"))
    dim = days.select(F.date_format("full_date", "yyyyMMdd").cast("int").alias("date_key"), "full_date", *(c.alias(n) for n, c in X.calendar_columns(F.col("full_date")).items()))
    return R.with_unknown(dim, "date_key", {})


@query("SELECT CAST(date_diff('day', min(o), max(o)) + 1 AS INTEGER) AS expected_days, count(DISTINCT o) AS observed_days, date_diff('day', min(o), max(o)) + 1 = count(DISTINCT o) AS is_continuous FROM (SELECT CAST(o_orderdate AS DATE) AS o FROM orders)")
def q_calendar_continuity(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    span = F.datediff(F.max(day), F.min(day)) + 1
    return table(spark, d, "orders").agg(span.alias("expected_days"), F.count_distinct(day).alias("observed_days"), (span == F.count_distinct(day)).alias("is_continuous"))


@query("SELECT event_id, CAST(strftime(ts - INTERVAL 5 HOUR, '%Y%m%d') AS INTEGER) AS date_key FROM events")
def q_date_key_lima(spark: SparkSession, d: str) -> DataFrame:
    """UTC times to local date keys: three in the morning belongs to the day before."""
    return table(spark, d, "events").select("event_id", X.date_key(F.col("ts")).alias("date_key"))


@query("SELECT CAST(row_number() OVER (ORDER BY c_name) AS BIGINT) AS customer_key, c_custkey, c_name FROM customer UNION ALL SELECT 0, NULL, '__UNKNOWN__'")
def q_dense_dim_unknown(spark: SparkSession, d: str) -> DataFrame:
    """Dense surrogate keys in natural-key order and the unknown member."""
    dim = R.dense_keys(table(spark, d, "customer").select("c_custkey", "c_name"), ["c_name"], "customer_key")
    return R.with_unknown(dim, "customer_key", {"c_name": X.UNKNOWN})


@query("""
WITH dim AS (SELECT row_number() OVER (ORDER BY s_suppkey) AS supplier_key, s_suppkey FROM supplier WHERE s_acctbal > 0)
SELECT l_orderkey, count(*) AS items, count_if(supplier_key IS NULL) AS unresolved, CAST(sum(coalesce(supplier_key, 0)) AS BIGINT) AS key_sum FROM lineitem LEFT JOIN dim ON s_suppkey = l_suppkey GROUP BY l_orderkey""")
def q_lookup_miss_zero(spark: SparkSession, d: str) -> DataFrame:
    """A key that the dimension lacks resolves to the unknown member."""
    dim = R.dense_keys(table(spark, d, "supplier").filter("s_acctbal > 0").select("s_suppkey"), ["s_suppkey"], "supplier_key")
    found = R.lookup_key(table(spark, d, "lineitem").select("l_orderkey", "l_suppkey"), dim, {"l_suppkey": "s_suppkey"}, "supplier_key")
    return found.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("items"), F.count_if(F.col("supplier_key") == 0).alias("unresolved"), F.sum("supplier_key").cast("bigint").alias("key_sum"))


@query("""
WITH o AS (SELECT o_orderkey, o_orderstatus AS status, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority FROM orders), dim AS (SELECT row_number() OVER (ORDER BY status, priority NULLS LAST) AS method_key, * FROM (SELECT DISTINCT status, priority FROM o WHERE status <> 'P'))
SELECT o_orderkey, CAST(coalesce(method_key, 0) AS INTEGER) AS method_key FROM o LEFT JOIN dim ON o.status IS NOT DISTINCT FROM dim.status AND o.priority IS NOT DISTINCT FROM dim.priority""")
def q_null_safe_lookup(spark: SparkSession, d: str) -> DataFrame:
    """A composite lookup in which null equals null."""
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), priority().alias("priority"))
    dim = R.dimension_keys(orders.filter("status <> 'P'").select("status", "priority").distinct(), ["status", "priority"], "method_key")
    return R.lookup_key(orders, dim, {"status": "status", "priority": "priority"}, "method_key").select("o_orderkey", "method_key")


@query("SELECT o_orderkey, o_custkey FROM orders ANTI JOIN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) c ON c_custkey = o_custkey")
def q_fk_orphans(spark: SparkSession, d: str) -> DataFrame:
    parents = table(spark, d, "customer").filter("c_acctbal >= 0").select("c_custkey")
    return R.orphans(table(spark, d, "orders").select("o_orderkey", "o_custkey"), parents, {"o_custkey": "c_custkey"})


@query("SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_keys FROM lineitem ANTI JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F') o ON o_orderkey = l_orderkey")
def q_root_references(spark: SparkSession, d: str) -> DataFrame:
    """Items whose order the root table lacks: rows and different keys."""
    missing = R.orphans(table(spark, d, "lineitem").select("l_orderkey"), table(spark, d, "orders").filter("o_orderstatus <> 'F'"), {"l_orderkey": "o_orderkey"})
    return missing.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("l_orderkey").alias("n_keys"))


def _rules(name: str, sql: str, rules: Callable[[SparkSession, str], tuple[dict[str, DataFrame], list[dict]]]) -> None:
    """Registers one query that evaluates rules: rule_id, invalid_rows, rows_evaluated, passed."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        tables, catalog = rules(spark, d)
        return Q.evaluate(spark, tables, catalog).select("rule_id", "invalid_rows", "rows_evaluated", "passed")

    run.__name__ = name
    QUERIES[name], SQL[name] = run, sql


def _rule_sql(rule_id: str, invalid: str, evaluated: str, source: str, passed: str = "i = 0") -> str:
    return f"SELECT '{rule_id}' AS rule_id, CAST(i AS BIGINT) AS invalid_rows, CAST(e AS BIGINT) AS rows_evaluated, {passed} AS passed FROM (SELECT {invalid} AS i, {evaluated} AS e FROM {source})"


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").withColumn("priority", priority())


_O = "(SELECT *, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority FROM orders)"
_rules("q_numeric_min", _rule_sql("DQ-NUM-001", "count_if(c_acctbal < 0)", "count(*)", "customer"), lambda s, d: ({"customer": table(s, d, "customer")}, [{"id": "DQ-NUM-001", "type": "numeric_min", "table": "customer", "column": "c_acctbal", "minimum": 0, "inclusive": True, "allow_nulls": False, "threshold": {"max_invalid_count": 0}, "severity": "warning"}]))
_rules("q_ordered_dates", _rule_sql("DQ-DAT-002", "count_if(o_orderdate > l_shipdate)", "count(*)", "lineitem JOIN orders ON o_orderkey = l_orderkey"), lambda s, d: ({"items": table(s, d, "lineitem").join(table(s, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_orderdate").cast("string").alias("start"), F.col("l_shipdate").cast("string").alias("end"))}, [{"id": "DQ-DAT-002", "type": "ordered_datetimes", "table": "items", "start": "start", "end": "end", "threshold": {"max_invalid_count": 0}, "severity": "warning"}]))
_rules("q_parseable_datetime", _rule_sql("DQ-DAT-001", "count_if(event_id % 7 = 0)", "count(*)", "events"), lambda s, d: ({"events": table(s, d, "events").select(F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("no date "), F.col("event_id").cast("string"))).otherwise(F.col("ts").cast("string")).alias("ts"))}, [{"id": "DQ-DAT-001", "type": "parseable_datetime", "table": "events", "columns": ["ts"], "threshold": {"max_invalid_count": 0}, "severity": "error"}]))
_rules("q_conditional_not_null", _rule_sql("DQ-COND-001", "count_if(priority IS NULL)", "count(*)", f"{_O} WHERE o_orderstatus <> 'O'"), lambda s, d: ({"orders": _orders(s, d).withColumn("closed", F.nullif("o_orderstatus", F.lit("O")))}, [{"id": "DQ-COND-001", "type": "conditional_not_null", "table": "orders", "condition": "closed", "required": "priority", "threshold": {"max_invalid_count": 0}, "severity": "error"}]))
_rules("q_not_null", _rule_sql("DQ-NULL-001", "count_if(priority IS NULL)", "count(*)", _O, "i * 100.0 / e <= 25"), lambda s, d: ({"orders": _orders(s, d)}, [{"id": "DQ-NULL-001", "type": "not_null", "table": "orders", "columns": ["o_custkey", "priority"], "threshold": {"max_invalid_pct": 25}, "severity": "error"}]))
_rules("q_min_coverage", _rule_sql("DQ-COV-001", "count_if(priority IS NULL)", "count(*)", _O, "(e - i) * 100.0 / e >= 75"), lambda s, d: ({"orders": _orders(s, d)}, [{"id": "DQ-COV-001", "type": "minimum_coverage", "table": "orders", "column": "priority", "threshold": {"min_coverage_pct": 75}, "severity": "info"}]))


@query(r"SELECT s_suppkey, CASE WHEN s_nationkey % 2 = 0 THEN regexp_full_match(trim(CASE WHEN s_suppkey % 3 = 0 THEN 'L' || lpad(CAST(s_suppkey AS VARCHAR), 10, '0') ELSE lpad(CAST(s_suppkey AS VARCHAR), 11, '2') END), '[0-9]{11}') END AS ruc_format_valid FROM supplier")
def q_identifier_format(spark: SparkSession, d: str) -> DataFrame:
    """Tri-state identifier check: null where the scheme does not apply."""
    key = F.col("s_suppkey").cast("string")
    identifier = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("L"), F.lpad(key, 10, "0"))).otherwise(F.lpad(key, 11, "2"))
    scheme = F.when(F.col("s_nationkey") % 2 == 0, "pe-ruc").otherwise("PE-CONSUCODE")
    return table(spark, d, "supplier").select("s_suppkey", X.ruc_flag(scheme, identifier).alias("ruc_format_valid"))


@query(f"SELECT o_orderkey, coalesce(priority, '__UNCLASSIFIED__') AS priority, priority IS NULL AS classification_was_missing FROM {_O}")
def q_classification_fill(spark: SparkSession, d: str) -> DataFrame:
    return _orders(spark, d).select("o_orderkey", F.coalesce("priority", F.lit(X.UNCLASSIFIED[0])).alias("priority"), F.col("priority").isNull().alias("classification_was_missing"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows, count_if(l_discount = 0) AS zero_discounts, count_if(l_tax IS NOT NULL) AS taxes FROM lineitem GROUP BY l_orderkey, l_linenumber")
def q_zero_flag(spark: SparkSession, d: str) -> DataFrame:
    flags = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", X.is_zero(F.col("l_discount")).alias("zero"), F.col("l_tax").isNotNull().alias("there"))
    return flags.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("zero").alias("zero_discounts"), F.count_if("there").alias("taxes"))


@query(f"""
WITH u AS (SELECT 'BRAND' AS scheme, p_brand AS code, p_type AS description FROM part UNION ALL SELECT CASE WHEN priority IS NULL THEN 'UNKNOWN' ELSE 'PRIORITY' END, coalesce(priority, '__UNCLASSIFIED__'), coalesce(o_orderstatus, 'Sin clasificar') FROM {_O}),
m AS (SELECT scheme, code, description, row_number() OVER (PARTITION BY scheme, code ORDER BY count(*) DESC, lower(description), description) AS k FROM u GROUP BY scheme, code, description),
c AS (SELECT scheme, code, count(*) AS observations, count(DISTINCT description) AS variants FROM u GROUP BY scheme, code),
k AS (SELECT scheme, code, CASE WHEN scheme = 'UNKNOWN' THEN 0 ELSE row_number() OVER (PARTITION BY scheme = 'UNKNOWN' ORDER BY scheme, code) END AS category_key FROM c)
SELECT CAST(category_key AS INTEGER) AS category_key, scheme, code, description AS canonical_description, observations, variants FROM c JOIN k USING (scheme, code) JOIN m USING (scheme, code) WHERE m.k = 1""")
def q_category_union_dim(spark: SparkSession, d: str) -> DataFrame:
    """Categories of several sources united, with the modal description; missing ones fold into key 0."""
    missing = F.col("priority").isNull()
    one = table(spark, d, "part").select(F.lit("BRAND").alias("scheme"), F.col("p_brand").alias("code"), F.col("p_type").alias("description"))
    two = _orders(spark, d).select(F.when(missing, "UNKNOWN").otherwise("PRIORITY").alias("scheme"), F.coalesce("priority", F.lit(X.UNCLASSIFIED[0])).alias("code"), F.col("o_orderstatus").alias("description"))
    union = one.unionByName(two)
    keys = ["scheme", "code"]
    counts = union.groupBy(*keys).agg(F.count(F.lit(1)).alias("observations"), F.count_distinct("description").alias("variants"))
    known = R.dimension_keys(counts.filter("scheme <> 'UNKNOWN'"), keys, "category_key")
    unknown = counts.filter("scheme = 'UNKNOWN'").withColumn("category_key", F.lit(0))
    return known.unionByName(unknown).join(R.canonical_by_key(union, keys, "description", "canonical_description"), keys).select("category_key", *keys, "canonical_description", "observations", "variants")


@query("SELECT count(*) AS parents, CAST(sum(n) AS BIGINT) AS n_rows, min(n) AS least, CAST(median(n) AS DOUBLE) AS median, max(n) AS most, count_if(n > 1) AS multi_row_parents FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)")
def q_cardinality_stats(spark: SparkSession, d: str) -> DataFrame:
    return R.cardinality(table(spark, d, "lineitem").select("l_orderkey"), ["l_orderkey"])


_PROFILE = "SELECT '{0}' AS column_name, count(*) AS n_rows, count(*) - count({0}) AS null_count, count({0}) AS non_null_count, count(DISTINCT {0}) AS distinct_count, round(CASE WHEN count(*) > 0 THEN (count(*) - count({0})) * 100.0 / count(*) ELSE 0 END, 4) AS null_pct FROM {1}"


@query(" UNION ALL ".join(_PROFILE.format(c, _O) for c in ("o_custkey", "o_orderstatus", "priority")))
def q_column_profile(spark: SparkSession, d: str) -> DataFrame:
    """Nulls and distinct values of columns, in one pass."""
    return PF.column_profile(_orders(spark, d), ["o_custkey", "o_orderstatus", "priority"])


@query("SELECT 'c_custkey' AS column_name, count(*) AS n_rows, count(*) - count(c_custkey) AS null_count, count(DISTINCT c_custkey) AS distinct_count, count(c_custkey) - count(DISTINCT c_custkey) AS duplicate_count, count(*) = count(DISTINCT c_custkey) AS is_unique_and_complete FROM customer UNION ALL SELECT 'c_nationkey', count(*), count(*) - count(c_nationkey), count(DISTINCT c_nationkey), count(c_nationkey) - count(DISTINCT c_nationkey), count(*) = count(DISTINCT c_nationkey) FROM customer")
def q_key_profile(spark: SparkSession, d: str) -> DataFrame:
    return PF.key_profile(table(spark, d, "customer"), ["c_custkey", "c_nationkey"])


@query("""
WITH b AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem), n AS (SELECT l_orderkey, count(*) AS bridge_count FROM b GROUP BY l_orderkey), f AS (SELECT o_orderkey, (SELECT count(DISTINCT l_suppkey) FROM lineitem WHERE l_orderkey = o_orderkey) AS observed_count FROM orders)
SELECT o_orderkey, observed_count, coalesce(bridge_count, 0) AS bridge_count, observed_count = coalesce(bridge_count, 0) AS matches FROM f LEFT JOIN n ON l_orderkey = o_orderkey""")
def q_bridge_counts(spark: SparkSession, d: str) -> DataFrame:
    """Supplier counts on the fact against rows of the factless bridge."""
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey")
    bridge = items.distinct().groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("bridge_count"))
    observed = R.single_supplier(items, ["o_orderkey"], "l_suppkey").select("o_orderkey", F.col("supplier_count").alias("observed_count"))
    out = table(spark, d, "orders").select("o_orderkey").join(observed, "o_orderkey", "left").join(bridge, "o_orderkey", "left").fillna(0)
    return out.withColumn("matches", F.col("observed_count") == F.col("bridge_count"))


@query("""
WITH s AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS item_sum FROM lineitem GROUP BY l_orderkey), j AS (SELECT CAST(o_totalprice AS DECIMAL(18,4)) AS h, item_sum AS i, abs(CAST(o_totalprice AS DECIMAL(18,4)) - item_sum) AS x FROM orders LEFT JOIN s ON l_orderkey = o_orderkey)
SELECT count(*) AS parents, count(h) AS with_header, count(i) AS with_items, count(x) AS comparable, count_if(x = 0) AS exact, count_if(x <= 0.01) AS within_tolerance, count_if(x > 0.01) AS above_tolerance, CAST(max(x) AS DECIMAL(18,4)) AS max_difference FROM j""")
def q_amount_recon_summary(spark: SparkSession, d: str) -> DataFrame:
    gap = F.abs("header_item_difference")
    return q_header_item_reconcile(spark, d).agg(F.count(F.lit(1)).alias("parents"), F.count("header_amount").alias("with_header"), F.count("item_sum").alias("with_items"), F.count(gap).alias("comparable"), F.count_if(gap == 0).alias("exact"), F.count_if("is_reconciled").alias("within_tolerance"), F.count_if(gap > F.lit(X.TOLERANCE).cast("decimal(10,4)")).alias("above_tolerance"), F.max(gap).cast("decimal(18,4)").alias("max_difference"))


@query(f"WITH {_OC} SELECT o_orderstatus, string_agg(DISTINCT currency_code, ';' ORDER BY currency_code) AS currencies FROM oc GROUP BY o_orderstatus")
def q_currency_set(spark: SparkSession, d: str) -> DataFrame:
    return orders_with_currency(spark, d).groupBy("o_orderstatus").agg(X.joined_set(F.col("currency_code")).alias("currencies"))


_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@query("SELECT t AS table_name, a AS actual_n, e AS expected_n, CASE WHEN a = e THEN 'PASS' ELSE 'FAIL' END AS status FROM (" + " UNION ALL ".join(f"SELECT '{t}' AS t, (SELECT count(*) FROM {t}) AS a, {'CAST(5 AS BIGINT)' if t == 'region' else 'CAST(26 AS BIGINT)' if t == 'nation' else f'(SELECT count(*) FROM {t})'} AS e" for t in _TABLES) + ")")
def q_row_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    """Counted rows against expected ones, both ways; one expectation is wrong on purpose."""
    counts = None
    for t in _TABLES:
        one = table(spark, d, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n")
        counts = one if counts is None else counts.unionByName(one)
    expected = counts.withColumn("n", F.when(F.col("table_name") == "region", F.lit(5)).when(F.col("table_name") == "nation", F.lit(26)).otherwise(F.col("n")).cast("bigint"))
    return R.reconciled(counts, expected, ["table_name"], ["n"])


@query("WITH w AS (SELECT row_number() OVER (ORDER BY n_name) AS k FROM nation UNION ALL SELECT 0), b AS (SELECT row_number() OVER (ORDER BY r_name) AS k FROM region) SELECT 2 AS dimensions, CAST((SELECT abs(count_if(k = 0) - 1) FROM w) + (SELECT abs(count_if(k = 0) - 1) FROM b) AS BIGINT) AS deviations")
def q_unknown_members(spark: SparkSession, d: str) -> DataFrame:
    """Every dimension has exactly one member 0; the second one here lacks it."""
    whole = R.with_unknown(R.dimension_keys(table(spark, d, "nation").select("n_name"), ["n_name"], "k"), "k", {"n_name": X.UNKNOWN})
    bare = R.dimension_keys(table(spark, d, "region").select("r_name"), ["r_name"], "k")
    zeros = whole.agg(F.count_if(F.col("k") == 0).alias("n")).unionByName(bare.agg(F.count_if(F.col("k") == 0).alias("n")))
    return zeros.agg(F.count(F.lit(1)).cast("int").alias("dimensions"), F.sum(F.abs(F.col("n") - 1)).cast("bigint").alias("deviations"))


@query("SELECT party, count(*) AS n FROM (SELECT 'customer' AS party, c_acctbal AS a FROM customer UNION ALL SELECT 'supplier', s_acctbal FROM supplier) WHERE a < 0 GROUP BY party")
def q_negative_amounts(spark: SparkSession, d: str) -> DataFrame:
    one = table(spark, d, "customer").select(F.lit("customer").alias("party"), F.col("c_acctbal").alias("a"))
    two = table(spark, d, "supplier").select(F.lit("supplier"), F.col("s_acctbal"))
    return one.union(two).filter("a < 0").groupBy("party").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH r AS (SELECT 'DQ-NUM-001' AS rule_id, 'warning' AS severity, (SELECT count(*) FROM customer WHERE c_acctbal < 0) AS i UNION ALL SELECT 'DQ-REF-001', 'error', (SELECT count(*) FROM orders ANTI JOIN customer ON c_custkey = o_custkey) UNION ALL SELECT 'DQ-GRAIN-001', 'info', (SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)))
SELECT count(*) AS rules, count_if(i = 0) AS passed, count_if(i > 0) AS failed, CASE WHEN count_if(i > 0 AND severity IN ('critical', 'error')) > 0 THEN 'BLOCKED' WHEN count_if(i > 0 AND severity = 'warning') > 0 THEN 'PASS_WITH_WARNINGS' ELSE 'PASS' END AS status FROM r""")
def q_gate_status(spark: SparkSession, d: str) -> DataFrame:
    """Rule results rolled up into one status."""
    tables = {t: table(spark, d, t) for t in ("customer", "orders", "lineitem")}
    none = {"max_invalid_count": 0}
    catalog = [
        {"id": "DQ-NUM-001", "type": "numeric_min", "table": "customer", "column": "c_acctbal", "minimum": 0, "inclusive": True, "allow_nulls": False, "threshold": none, "severity": "warning"},
        {"id": "DQ-REF-001", "type": "foreign_keys", "relationships": [{"child": "orders", "parent": "customer", "keys": {"o_custkey": "c_custkey"}}], "threshold": none, "severity": "error"},
        {"id": "DQ-GRAIN-001", "type": "candidate_grains", "grains": {"lineitem": ["l_orderkey", "l_linenumber"]}, "threshold": none, "severity": "info"},
    ]
    return Q.roll_up(Q.evaluate(spark, tables, catalog))


_SPEC = P.Process("o_orderkey", "o_custkey", "o_orderstatus", "priority", "o_orderdate", "amount", "currency_code", "item_amount", "declared", dates={"record_date_key": "o_orderdate"})


def _processes(spark: SparkSession, d: str) -> DataFrame:
    """Orders as processes of one period: a customer buys, and the status and priority are the method."""
    return orders_with_currency(spark, d).select("o_orderkey", "o_custkey", "o_orderstatus", priority().alias("priority"), "o_orderdate", money("o_totalprice").alias("amount"), "currency_code", F.lit(2).alias("declared"), F.lit("2026-07").alias("source_period"))


def _context(spark: SparkSession, d: str) -> DataFrame:
    processes = _processes(spark, d)
    dim = P.dim_process(processes.filter("o_orderkey % 10 <> 0"), "o_orderkey", {})
    buyers = R.dimension_keys(table(spark, d, "customer").filter("c_acctbal >= 0").select(F.col("c_custkey").alias("source_party_id")), ["source_party_id"], "buyer_key")
    methods = R.dimension_keys(processes.select(F.col("o_orderstatus").alias("method"), P.known_method("priority").alias("details")).distinct(), ["method", "details"], "method_key")
    return P.process_context(processes, _SPEC, dim, buyers, methods)


#: DuckDB twin of ``_context``; dates are local, five hours behind UTC.
_CTX = f"""{_OC}, pr AS (SELECT *, o_orderstatus AS m, coalesce(nullif(o_orderpriority, '4-NOT SPECIFIED'), '__UNKNOWN__') AS de FROM oc),
dp AS (SELECT o_orderkey AS k, row_number() OVER (ORDER BY CAST(o_orderkey AS VARCHAR)) AS process_key FROM orders WHERE o_orderkey % 10 <> 0),
db AS (SELECT c_custkey AS k, row_number() OVER (ORDER BY c_custkey) AS buyer_key FROM customer WHERE c_acctbal >= 0),
dm AS (SELECT m, de, row_number() OVER (ORDER BY m, de) AS method_key FROM (SELECT DISTINCT m, de FROM pr)),
ctx AS (SELECT o_orderkey, CAST(coalesce(process_key, 0) AS INTEGER) AS process_key, CAST(coalesce(buyer_key, 0) AS INTEGER) AS buyer_key, CAST(coalesce(method_key, 0) AS INTEGER) AS method_key,
       CAST(strftime(CAST(o_orderdate AS TIMESTAMP) - INTERVAL 5 HOUR, '%Y%m%d') AS INTEGER) AS published_date_key
       FROM pr LEFT JOIN dp ON dp.k = o_orderkey LEFT JOIN db ON db.k = o_custkey LEFT JOIN dm USING (m, de))"""


@query(f"WITH {_CTX} SELECT * FROM ctx")
def q_process_context(spark: SparkSession, d: str) -> DataFrame:
    """The keys that facts of lower grains inherit from their process."""
    return _context(spark, d)


@query("SELECT CAST(row_number() OVER (ORDER BY CAST(o_orderkey AS VARCHAR)) AS INTEGER) AS process_key, CAST(o_orderkey AS VARCHAR) AS natural_id, o_orderstatus AS status, '2026-07' AS first_period, '2026-07' AS last_period FROM orders WHERE o_orderkey % 10 <> 0 UNION ALL SELECT 0, '__UNKNOWN__', NULL, NULL, NULL")
def q_dim_process(spark: SparkSession, d: str) -> DataFrame:
    """One row for each process, and the unknown member."""
    return P.dim_process(_processes(spark, d).filter("o_orderkey % 10 <> 0"), "o_orderkey", {"status": "o_orderstatus"})


@query(f"""
WITH {_CTX}, s AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS item_sum, count(*) AS n, count(DISTINCT l_suppkey) AS t FROM lineitem GROUP BY l_orderkey)
SELECT row_number() OVER (ORDER BY o_orderkey) AS process_fact_key, o_orderkey, process_key, buyer_key, method_key, published_date_key, published_date_key AS record_date_key, CASE currency_code WHEN 'PEN' THEN 1 WHEN 'USD' THEN 2 ELSE 0 END AS currency_key, CAST(o_totalprice AS DECIMAL(18,4)) AS amount, CAST(item_sum AS DECIMAL(18,4)) AS item_sum, coalesce(n, 0) AS item_count, CAST(CAST(o_totalprice AS DECIMAL(18,4)) - item_sum AS DECIMAL(18,4)) AS header_item_difference,
       coalesce(abs(CAST(o_totalprice AS DECIMAL(18,4)) - item_sum) <= 0.01, false) AS is_reconciled, 2 AS tenderer_count_declared, coalesce(t, 0) AS tenderer_count_observed, coalesce(t, 0) = 2 AS dq_tenderer_count_matches, CAST(o_totalprice AS DECIMAL(18,4)) = 0 AS dq_value_is_zero, 1 AS process_count
FROM pr JOIN ctx USING (o_orderkey) LEFT JOIN s ON l_orderkey = o_orderkey""")
def q_fact_process(spark: SparkSession, d: str) -> DataFrame:
    """The process fact: keys, amounts, declared and observed tenderers, header against items."""
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), money("l_extendedprice").alias("item_amount"), "l_suppkey")
    currencies = spark.createDataFrame([(1, "PEN"), (2, "USD")], "currency_key int, code string")
    fact = P.fact_process(_processes(spark, d), items, items.select("o_orderkey", "l_suppkey").distinct(), _context(spark, d), currencies, _SPEC)
    return fact.withColumns({c: money(c) for c in ("amount", "item_sum", "header_item_difference")})


@query("""
WITH dim AS (SELECT row_number() OVER (ORDER BY scheme, code) AS k, * FROM (SELECT DISTINCT 'BRAND' AS scheme, p_brand AS code FROM part WHERE p_size > 5 UNION SELECT DISTINCT 'TYPE', p_type FROM part WHERE p_size > 10))
SELECT p_partkey, CAST(coalesce(a.k, 0) AS INTEGER) AS category_key, CAST(coalesce(b.k, 0) AS INTEGER) AS standard_category_key, b.k IS NULL AS dq_standard_category_missing
FROM part LEFT JOIN dim a ON a.scheme = 'BRAND' AND a.code = p_brand LEFT JOIN dim b ON b.scheme = 'TYPE' AND b.code = p_type AND p_partkey % 3 <> 0""")
def q_category_keys(spark: SparkSession, d: str) -> DataFrame:
    """An item's own category and the standard one of its additional classification; a third of the items has none."""
    parts = table(spark, d, "part")
    known = parts.filter("p_size > 5").select(F.lit("BRAND").alias("scheme"), F.col("p_brand").alias("code")).union(parts.filter("p_size > 10").select(F.lit("TYPE"), F.col("p_type"))).distinct()
    dim = R.dimension_keys(known, ["scheme", "code"], "category_key")
    items = parts.select("p_partkey", F.lit("BRAND").alias("own_scheme"), F.col("p_brand").alias("own_code"))
    more = parts.filter("p_partkey % 3 <> 0").select("p_partkey", F.lit("TYPE").alias("more_scheme"), F.col("p_type").alias("more_code"))
    out = P.category_keys(items, more, dim, ["p_partkey"], ("own_scheme", "own_code"), ("more_scheme", "more_code"))
    return out.select("p_partkey", "category_key", "standard_category_key", "dq_standard_category_missing")


@query(f"""
WITH {_OC}, r AS (SELECT *, CASE WHEN o_orderkey % 7 = 0 AND currency_code = 'PEN' THEN 2 WHEN currency_code = 'PEN' THEN 1 WHEN currency_code = 'USD' THEN CASE WHEN o_orderkey % 11 = 0 THEN -1 ELSE 3.75 END END AS rate FROM oc)
SELECT 'WH-HOME' AS rule_id, 'FAIL' AS status, (SELECT count(*) FROM r WHERE currency_code = 'PEN' AND rate <> 1) AS violations
UNION ALL SELECT 'WH-POSITIVE', 'FAIL', (SELECT count(*) FROM r WHERE rate <= 0) UNION ALL SELECT 'WH-INVENTED', 'FAIL', (SELECT count(*) FROM r WHERE rate IS NULL AND o_orderkey % 13 = 0)
UNION ALL SELECT 'WH-ABSENT', 'FAIL', (SELECT count(*) FROM r WHERE rate IS NOT NULL AND o_orderkey % 9 = 0)
UNION ALL SELECT 'WH-PRODUCT', 'FAIL', (SELECT count(*) FROM r WHERE rate IS NOT NULL AND o_orderkey % 17 = 0 AND o_orderkey % 9 <> 0)
UNION ALL SELECT 'WH-FLAG', 'FAIL', (SELECT count(*) FROM r WHERE (rate IS NOT NULL) <> (rate IS NOT NULL AND o_orderkey % 9 <> 0 OR rate IS NULL AND o_orderkey % 13 = 0))""")
def q_conversion_rules(spark: SparkSession, d: str) -> DataFrame:
    """Seeded faults of rates and conversions, each counted by its rule."""
    rate = F.when((F.col("currency_code") == "PEN") & (F.col("o_orderkey") % 7 == 0), 2.0).when(F.col("currency_code") == "PEN", 1.0).when(F.col("currency_code") == "USD", F.when(F.col("o_orderkey") % 11 == 0, -1.0).otherwise(3.75)).cast("decimal(18,14)")
    fact = orders_with_currency(spark, d).select("o_orderkey", "currency_code", money("o_totalprice").alias("amount"), rate.alias("rate"))
    right = X.converted(F.col("amount"), F.col("rate"))
    stored = F.when(F.col("rate").isNull() & (F.col("o_orderkey") % 13 == 0), F.col("amount")).when(F.col("o_orderkey") % 9 == 0, None).when(F.col("o_orderkey") % 17 == 0, right + 1).otherwise(right).cast(X.MONEY)
    stored = fact.withColumn("amount_pen", stored).withColumn("available", F.col("amount_pen").isNotNull())
    found = V.conversion_rules(stored, "WH", "amount", "rate", "amount_pen", "currency_code", "available")
    return V.classified(found).select("rule_id", "status", "violations")


@query("""
WITH s AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS i FROM lineitem GROUP BY l_orderkey), j AS (SELECT o_orderkey AS k, CAST(o_totalprice AS DECIMAL(18,4)) AS h, i FROM orders LEFT JOIN s ON l_orderkey = o_orderkey),
r AS (SELECT 'critical' AS severity, (SELECT count(*) FROM j WHERE k % 19 = 0) AS v UNION ALL SELECT 'critical', 0 UNION ALL SELECT 'warning', (SELECT count(*) FROM j WHERE abs(h - i) > 0.01))
SELECT count(*) AS rules, count_if(v = 0) AS passed, count_if(v > 0 AND severity = 'warning') AS warned, count_if(v > 0 AND severity <> 'warning') AS failed, CASE WHEN count_if(v > 0 AND severity <> 'warning') > 0 THEN 'FAIL' WHEN count_if(v > 0) > 0 THEN 'PASS_WITH_WARNINGS' ELSE 'PASS' END AS status FROM r""")
def q_warehouse_status(spark: SparkSession, d: str) -> DataFrame:
    """Rules over headers and items rolled up; stored differences of some orders are wrong on purpose."""
    fact = q_header_item_reconcile(spark, d)
    wrong = F.when(F.col("o_orderkey") % 19 == 0, F.coalesce(F.col("header_item_difference"), F.lit(0)) + 1).otherwise(F.col("header_item_difference"))
    return V.overall(V.reconciliation_rules(fact.withColumn("header_item_difference", wrong), "WH", "header_amount", "item_sum", "header_item_difference", "is_reconciled"))


@query(f"""
WITH {_OC}, a AS (SELECT currency_code, CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DECIMAL(38,4)) AS total FROM oc GROUP BY currency_code), b AS (SELECT currency_code, CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DECIMAL(38,4)) AS total FROM oc WHERE o_orderstatus <> 'P' OR currency_code <> 'EUR' GROUP BY currency_code)
SELECT currency_code, a.total AS raw_total, b.total AS typed_total, a.total AS stage_total, CASE WHEN a.total = b.total THEN 'PASS' ELSE 'FAIL' END AS status FROM a LEFT JOIN b USING (currency_code)""")
def q_layer_totals(spark: SparkSession, d: str) -> DataFrame:
    """Control totals of three layers for each currency; the typed layer lacks some rows on purpose."""
    rows = orders_with_currency(spark, d).select("currency_code", "o_orderstatus", money("o_totalprice").alias("amount"))
    total = lambda df: R.currency_totals(df, "currency_code", "amount").withColumnRenamed("total_amount", "total")
    layers = {"raw": total(rows), "typed": total(rows.filter("o_orderstatus <> 'P' OR currency_code <> 'EUR'")), "stage": total(rows)}
    return V.reconciled_layers(layers, ["currency_code"], "total", ["raw", "typed", "stage"])


@query(f"WITH {_OC} SELECT currency_code, count(*) AS n_rows, count_if(nullif(o_orderpriority, '4-NOT SPECIFIED') IS NOT NULL) AS flagged, round(count_if(nullif(o_orderpriority, '4-NOT SPECIFIED') IS NOT NULL) * 100.0 / count(*), 4) AS coverage_pct FROM oc GROUP BY currency_code")
def q_flag_coverage(spark: SparkSession, d: str) -> DataFrame:
    return V.flag_coverage(orders_with_currency(spark, d).withColumn("known", priority().isNotNull()), ["currency_code"], "known")


@query("SELECT CASE WHEN coalesce(n, 0) = 0 THEN '0' WHEN n = 1 THEN '1' ELSE '>1' END AS children, count(*) AS parents FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey GROUP BY 1")
def q_participation(spark: SparkSession, d: str) -> DataFrame:
    """Customers with no order, with one and with several."""
    return V.participation(table(spark, d, "customer").select(F.col("c_custkey").alias("k")), table(spark, d, "orders").select(F.col("o_custkey").alias("k")), ["k"])


@query("SELECT source, count(*) AS rows_in, count_if(k = 1) AS rows_kept, count_if(k > 1) AS rows_quarantined, 'PASS' AS status FROM (SELECT source, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents) GROUP BY source")
def q_rows_conserved(spark: SparkSession, d: str) -> DataFrame:
    """Each source's rows are kept or in quarantine; none is lost."""
    docs = table(spark, d, "documents").select("doc_id", "source", "text")
    kept, others = R.split_duplicates(docs, ["text"], "doc_id")
    n = lambda df: df.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return V.conserved(n(docs), n(kept), n(others), ["source"])
