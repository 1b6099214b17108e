from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import exprs as X
from ledgerloom.operators import quality as Q
from ledgerloom.operators import profile as PF
from ledgerloom.operators import relational as R


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


def test_trim_and_missing_tokens(spark):
    df = spark.createDataFrame([("  a\t",), ("NA",), (" ",), (None,)], "c string")
    got = [r[0] for r in df.select(X.u_trim(X.missing_to_null(F.col("c")))).collect()]
    assert got == ["a", None, "", None]


def test_strict_casts(spark):
    df = spark.createDataFrame([("2.0",), ("1e3",), ("1.5",), ("x",), (None,)], "c string")
    assert [r[0] for r in df.select(X.strict_integer(F.col("c"))).collect()] == [2, 1000, None, None, None]
    df = spark.createDataFrame([("1.12345678901234",), ("1.123456789012345",), ("1.10000000000000000",), ("NaN",), ("7",)], "c string")
    assert [r[0] for r in df.select(X.strict_decimal(F.col("c"))).collect()] == [Decimal("1.12345678901234"), None, Decimal("1.1"), None, Decimal("7")]
    df = spark.createDataFrame([("TRUE",), ("0",), ("yes",)], "c string")
    assert [r[0] for r in df.select(X.strict_boolean(F.col("c"))).collect()] == [True, False, None]


def test_identifier_flag_is_tri_state_and_anchored(spark):
    df = spark.createDataFrame([("PE-RUC", "20123456789"), ("pe-ruc", "1234567"), ("PE-CONSUCODE", "ABC123"), ("PE-RUC", None), (None, "20123456789")], "s string, i string")
    assert [r[0] for r in df.select(X.ruc_flag(F.col("s"), F.col("i"))).collect()] == [True, False, None, False, None]
    assert spark.range(1).select(F.regexp_like(F.lit("20123456789\n"), F.lit(r"\A[0-9]{11}\z"))).first()[0] is False


def test_local_date_key(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2026-07-01 03:00:00' AS t UNION ALL SELECT CAST(NULL AS TIMESTAMP_NTZ)")
    assert [r[0] for r in df.select(X.date_key(F.col("t"))).collect()] == [20260630, 0]


def test_conversion_never_invents_a_rate(spark):
    df = spark.createDataFrame([("PEN", "10", None), ("USD", "10", "3.75"), ("EUR", "10", None)], "c string, a string, r string")
    rate = X.rate_for(F.col("c"), F.col("r").cast("decimal(18,14)"))
    got = df.select(X.converted(F.col("a").cast("decimal(38,14)"), rate)).collect()
    assert [r[0] for r in got] == [Decimal("10"), Decimal("37.5"), None]


def test_snake_names():
    assert X.snake_name("compiledRelease/tender/items/0/totalValue/amount") == "compiled_release_tender_items_total_value_amount"
    assert X.snake_name("a/0/0/b") == "a_0_b"
    assert X.snake_name("x/0/a") == "x_a" and X.snake_name("x/1/a") == "x_1_a" and X.snake_name("x/10/0") == "x_10_0"
    assert X.snake_name("buyerRUC/amount_PEN") == "buyer_ruc_amount_pen" and X.snake_name("date2Published") == "date2_published"
    with pytest.raises(ValueError):
        X.snake_names(["some/value", "some_value"])
    with pytest.raises(ValueError):
        X.snake_name("//")


def test_canonical_value_and_order(spark):
    df = spark.createDataFrame([("A", "Beta"), ("A", "Beta"), ("A", "Alfa"), ("B", "Zulu"), ("B", "Árbol"), (None, "x"), ("C", None)], "k string, v string")
    assert rows(R.canonical_by_key(df, ["k"], "v", "c")) == [("A", "Beta"), ("B", "Árbol")]
    assert sorted(["Zulu", "Árbol", "Ñandu", "Nube"], key=X.fold_text) == ["Árbol", "Nube", "Ñandu", "Zulu"]


def test_header_item_difference(spark):
    head = spark.createDataFrame([("p1", "100"), ("p2", "5"), ("p3", None)], "k string, a string").withColumn("a", F.col("a").cast(X.MONEY))
    items = spark.createDataFrame([("p1", "40"), ("p1", "55"), ("p3", "1")], "k string, v string")
    got = {r.k: (r.item_sum, r.header_item_difference, r.is_reconciled, r.item_count) for r in R.child_sums(head, items, ["k"], "a", "v").collect()}
    assert got["p1"] == (Decimal("95"), Decimal("5"), False, 2)
    assert got["p2"] == (None, None, False, 0)
    assert got["p3"][1:] == (None, False, 1)


def test_grain_duplicates_and_split(spark):
    df = spark.createDataFrame([("p1", "a1", 1), ("p1", "a1", 2), ("p2", None, 3), ("p2", None, 4)], "p string, a string, n int")
    assert rows(R.grain_metrics(df, ["p", "a"])) == [(4, 2, 2)]
    kept, gone = R.split_duplicates(df, ["p", "a"], "n")
    assert rows(kept, "n") == [(1,), (3,)] and rows(gone, "n") == [(2,), (4,)]
    assert rows(R.exact_duplicates(df, ["p", "a"])) == [(4, 2, 4)]


def test_guarded_join_raises(spark):
    left, right = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(1, 2), (1, 3)], "k int, v int")
    with pytest.raises(Exception, match="many-to-one"):
        R.join_to_one(left, right, ["k"]).collect()


def test_lookup_null_matches_null_and_miss_is_zero(spark):
    dim = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "key int, m string, d string")
    df = spark.createDataFrame([("a", None), ("b", "x"), ("b", None)], "m string, d string")
    assert rows(R.lookup_key(df, dim, {"m": "m", "d": "d"}, "key")) == [("a", None, 1), ("b", "x", 2), ("b", None, 0)]


def test_growing_dimensions_are_not_numbered_in_one_window(spark, monkeypatch):
    from ledgerloom.plans import driver_queries, warehouse

    def refused(*args):
        raise AssertionError("all rows meet in one window")

    monkeypatch.setattr(R, "dimension_keys", refused)
    tables = {"supplier": spark.createDataFrame([(i, float(i % 3)) for i in range(30)], "s_suppkey long, s_acctbal double"), "lineitem": spark.createDataFrame([(i // 2, i) for i in range(40)], "l_orderkey long, l_suppkey long")}
    monkeypatch.setattr(driver_queries, "table", lambda spark, d, name: tables[name])
    keys = {s: k for k, s in enumerate((i for i in range(30) if i % 3), 1)}
    got = {r.l_orderkey: (r["items"], r.unresolved, r.key_sum) for r in driver_queries.q_lookup_miss_zero(spark, "").collect()}
    assert got == {o: (2, sum(s not in keys for s in (2 * o, 2 * o + 1)), keys.get(2 * o, 0) + keys.get(2 * o + 1, 0)) for o in range(20)}
    parties = spark.createDataFrame([(f"p{i:02}", "buyer", f"n{i}", "2026-07") for i in range(30)], f"id string, roles string, name string, {warehouse.PERIOD} string")
    dim = warehouse.dim_party(parties, "roles", "buyer", "party_key", "id", {"name": "name"})
    assert sorted((r.party_key, r.source_party_id) for r in dim.collect() if r.party_key) == [(i + 1, f"p{i:02}") for i in range(30)]


def test_dense_keys_are_ordered_and_gapless(spark):
    df = spark.createDataFrame([(f"n{(i * 37) % 101:03d}",) for i in range(101)] + [(None,)], "n string").repartition(7)
    got = sorted(((r.k, r.n) for r in R.dense_keys(df, ["n"], "k").collect()))
    assert [k for k, _ in got] == list(range(1, 103)) and [n for _, n in got] == [f"n{i:03d}" for i in range(101)] + [None]
    assert R.with_unknown(df.withColumn("k", F.lit(1)), "k", {"n": "?"}).filter("k = 0").count() == 1


def test_rate_coverage_and_reconciliation(spark):
    parents = spark.createDataFrame([("p1", "USD"), ("p2", "EUR"), ("p3", "PEN")], "k string, c string")
    rates = spark.createDataFrame([("p1",)], "k string")
    assert rows(R.rate_coverage(parents, rates, ["k"], "c")) == [(2, 1, 1, 0)]
    a, e = spark.createDataFrame([("t", 9)], "t string, n long"), spark.createDataFrame([("t", 10), ("u", 1)], "t string, n long")
    assert rows(R.reconciled(a, e, ["t"], ["n"]), "t", "status") == [("t", "FAIL"), ("u", "FAIL")]


def test_currency_totals(spark):
    df = spark.createDataFrame([("PEN", "10.10"), ("PEN", "2.20"), ("USD", "3"), (None, None), (" ", None)], "c string, a string")
    got = rows(R.currency_totals(df, "c", "a"))
    assert got == [("PEN", 2, 2, Decimal("12.3000")), ("USD", 1, 1, Decimal("3.0000")), ("__UNKNOWN__", 2, 0, None)]


RULES = [
    ({"id": "DQ-TAB-001", "type": "required_tables", "tables": ["records", "gone"]}, 1, 2),
    ({"id": "DQ-COL-001", "type": "required_columns", "table": "records", "columns": ["id", "gone"]}, 1, 2),
    ({"id": "DQ-NUL-001", "type": "not_null", "table": "records", "columns": ["id", "value"]}, 1, 4),
    ({"id": "DQ-GRN-001", "type": "candidate_grains", "grains": {"records": ["id"]}}, 1, 4),
    ({"id": "DQ-DUP-001", "type": "exact_duplicates", "table": "records"}, 1, 4),
    ({"id": "DQ-ROOT-001", "type": "root_references", "root": "records", "key": "id", "children": ["children"]}, 1, 2),
    ({"id": "DQ-FK-001", "type": "foreign_keys", "relationships": [{"child": "children", "parent": "records", "keys": {"id": "id"}}]}, 1, 2),
    ({"id": "DQ-NUM-001", "type": "numeric_min", "table": "records", "column": "value", "minimum": 0, "allow_nulls": False}, 2, 4),
    ({"id": "DQ-DAT-001", "type": "parseable_datetime", "table": "children", "columns": ["start", "end"]}, 1, 5),
    ({"id": "DQ-DAT-002", "type": "ordered_datetimes", "table": "children", "start": "start", "end": "end"}, 1, 2),
    ({"id": "DQ-CON-001", "type": "conditional_not_null", "table": "children", "condition": "start", "required": "id"}, 1, 3),
    ({"id": "DQ-RUC-001", "type": "peru_ruc", "table": "children", "scheme_column": "scheme", "identifier_column": "ruc"}, 1, 2),
    ({"id": "DQ-CLS-001", "type": "classification_completeness", "table": "children", "columns": ["id", "scheme"]}, 1, 3),
    ({"id": "DQ-COV-001", "type": "minimum_coverage", "table": "records", "column": "value"}, 1, 4),
    ({"id": "DQ-GONE-001", "type": "not_null", "table": "nowhere", "columns": ["x"]}, 1, 0),
]


@pytest.fixture(scope="module")
def results(spark):
    tables = {
        "records": spark.createDataFrame([("p1", "10"), ("p1", "10"), ("p2", "-1"), ("p3", None)], "id string, value string"),
        "children": spark.createDataFrame([("p1", "2026-07-01", "2026-06-01", "PE-RUC", "20123456789"), ("p9", "20260701", "2026-08-01", "PE-RUC", "1"), (None, "no date", None, "X", "1")], "id string, start string, end string, scheme string, ruc string"),
    }
    catalog = [{**r, "severity": "error", "threshold": {"max_invalid_count": 0}} for r, _, _ in RULES]
    return {r.rule_id: r for r in Q.evaluate(spark, tables, catalog).collect()}


@pytest.mark.parametrize("rule,invalid,evaluated", RULES, ids=[r["type"] for r, _, _ in RULES])
def test_rule_types(results, rule, invalid, evaluated):
    got = results[rule["id"]]
    assert (got.invalid_rows, got.rows_evaluated, got.passed) == (invalid, evaluated, False)


def test_thresholds_lint_and_roll_up(spark):
    base = {"type": "not_null", "table": "t", "columns": ["x"]}
    tables = {"t": spark.createDataFrame([(1,), (2,), (3,), (None,)], "x int")}
    run = lambda *limits: Q.evaluate(spark, tables, [{**base, "id": f"DQ-X-00{i}", "severity": s, "threshold": t} for i, (s, t) in enumerate(limits)])
    assert [r.passed for r in run(("info", {"max_invalid_pct": 25}), ("info", {"min_coverage_pct": 75, "max_invalid_count": 0})).collect()] == [True, False]
    status = lambda *s: Q.roll_up(run(*((x, {"max_invalid_count": 0}) for x in s))).first().status
    assert [status("info"), status("warning", "info"), status("critical", "warning")] == ["PASS", "PASS_WITH_WARNINGS", "BLOCKED"]
    assert len(Q.lint([{"id": "bad", "type": "?", "severity": "?", "threshold": {}}])) == 4
    with pytest.raises(ValueError):
        Q.evaluate(spark, tables, [{**base, "id": "bad", "severity": "info", "threshold": {"max_invalid_count": 0}}])


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (2, "b")], "k int, v string")
    assert rows(PF.column_profile(df, ["k", "v"])) == [("k", 4, 0, 4, 2, 0.0), ("v", 4, 1, 3, 2, 25.0)]
    assert rows(PF.key_profile(df, ["v"])) == [("v", 4, 1, 2, 1, False)]
    assert rows(PF.table_profile(df)) == [(4, 2, 1, 0, 1)]


def test_dense_keys_keep_every_row_of_a_wide_table(spark, tmp_path):
    n = 120_000
    wide = spark.range(n, numPartitions=7).select(F.when(F.col("id") % 50_000 != 0, F.pmod(F.xxhash64("id"), F.lit(1 << 40))).alias("k"), "id", *(F.sha2(F.concat(F.lit(i), F.col("id").cast("string")), 256).alias(f"c{i}") for i in range(6)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        R.dense_keys(wide, ["k", "id"], "key").write.parquet(str(tmp_path / "keys"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    got = spark.read.parquet(str(tmp_path / "keys"))
    assert got.agg(F.count(F.lit(1)), F.count_distinct("key"), F.min("key"), F.max("key"), F.count_distinct("id")).first() == (n, n, 1, n, n)
    head = [r.k for r in got.orderBy("key").limit(500).select("k").collect()]
    assert head == sorted(head) and all(r.k is None for r in got.filter(f"key > {n - 3}").collect())
    assert R.dense_keys(wide.limit(0), ["k"], "key").count() == 0


def test_split_duplicates_with_null_order(spark):
    df = spark.createDataFrame([("a", None), ("a", 2), ("b", None), ("c", 1), ("c", 3)], "x string, n int")
    first, others = R.split_duplicates(df, ["x"], "n")
    assert rows(first) == [("a", 2), ("b", None), ("c", 1)]
    assert rows(others) == [("a", None), ("c", 3)]


def test_why_identifiers_are_invalid(spark):
    rows = [("PE-RUC", " 20100000001 "), ("pe-ruc", "2010000000x"), (" PE-RUC", "123"), ("PE-RUC", None), ("DNI", "1"), (None, "2"), ("PE-RUC", "201000000011")]
    got = Q.identifier_breakdown(spark.createDataFrame(rows, "scheme string, id string"), "scheme", "id")
    assert got.columns == ["rows_evaluated", "format_invalid_rows", "invalid_length_rows", "non_digit_rows_with_length_11"]
    assert tuple(got.first()) == (5, 4, 3, 1)
    assert tuple(Q.identifier_breakdown(spark.createDataFrame([], "scheme string, id string"), "scheme", "id").first()) == (0, 0, 0, 0)
