"""The process and its context, and the warehouse rules: each finds the violations that are seeded, and only those."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import relational as R
from ledgerloom.plans import process as P
from ledgerloom.plans import validation as V

SPEC = P.Process("ocid", "buyer", "method", "details", "published", "amount", "currency", "item_amount", "declared")
PROCESSES = "ocid string, buyer string, method string, details string, published timestamp, amount decimal(38,14), currency string, declared int, source_period string"


def processes(spark):
    day = "2026-07-01 03:00:00"
    rows = [("o2", "b1", "open", None, day, "10", "PEN", 1), ("o1", "b9", "open", "x", None, None, "USD", 0), ("o3", None, None, None, day, "0", None, None)]
    return spark.createDataFrame([(*r, "2026-07") for r in rows], PROCESSES.replace("timestamp", "string").replace("decimal(38,14)", "string")).withColumn("published", F.col("published").cast("timestamp")).withColumn("amount", F.col("amount").cast("decimal(38,14)"))


def context(spark, table):
    buyers = R.with_unknown(spark.createDataFrame([(1, "b1")], "buyer_key int, source_party_id string"), "buyer_key", {})
    methods = spark.createDataFrame([(1, "open", "__UNKNOWN__"), (2, "open", "x")], "method_key int, method string, details string")
    return P.process_context(table, SPEC, P.dim_process(table, "ocid", {}), buyers, methods)


def test_process_dimension_and_context(spark):
    table = processes(spark)
    dim = {r.natural_id: r.process_key for r in P.dim_process(table, "ocid", {"how": "method"}).collect()}
    assert dim == {"__UNKNOWN__": 0, "o1": 1, "o2": 2, "o3": 3}
    got = {r.ocid: tuple(r)[1:] for r in context(spark, table).collect()}
    assert got == {"o1": (1, 0, 2, 0), "o2": (2, 1, 1, 20260630), "o3": (3, 0, 0, 20260630)}
    rows = P.inherited(spark.createDataFrame([("o1", 5), ("zz", 6)], "ocid string, x int"), context(spark, table), "ocid").collect()
    assert {r.ocid: r.process_key for r in rows} == {"o1": 1, "zz": 0}
    with pytest.raises(Exception, match="twice"):
        P.dim_process(table.union(table), "ocid", {}).collect()


def test_process_fact(spark):
    table = processes(spark)
    items = spark.createDataFrame([("o2", Decimal("4")), ("o2", Decimal("6.005"))], "ocid string, item_amount decimal(38,14)")
    tenderers = spark.createDataFrame([("o2",), ("o3",)], "ocid string")
    currencies = spark.createDataFrame([(1, "PEN")], "currency_key int, code string")
    got = {r.ocid: r for r in P.fact_process(table, items, tenderers, context(spark, table), currencies, SPEC).collect()}
    assert [got[k].process_fact_key for k in ("o1", "o2", "o3")] == [1, 2, 3]
    assert got["o2"].is_reconciled and got["o2"].dq_tenderer_count_matches and got["o2"].currency_key == 1
    assert not got["o1"].is_reconciled and got["o1"].dq_tenderer_count_matches and not got["o3"].dq_tenderer_count_matches
    assert got["o3"].dq_value_is_zero and not got["o1"].dq_value_is_zero and got["o1"].currency_key == 0


def test_category_keys(spark):
    items = spark.createDataFrame([(1, "A", "1"), (2, "A", "9"), (3, "A", "1")], "id int, s string, c string")
    more = spark.createDataFrame([(1, "S", "7"), (2, "S", "8")], "id int, ms string, mc string")
    dim = spark.createDataFrame([(4, "A", "1"), (5, "S", "7")], "category_key int, scheme string, code string")
    got = {r.id: (r.category_key, r.standard_category_key, r.dq_standard_category_missing) for r in P.category_keys(items, more, dim, ["id"], ("s", "c"), ("ms", "mc")).collect()}
    assert got == {1: (4, 5, False), 2: (0, 0, True), 3: (4, 0, True)}
    with pytest.raises(Exception, match="one-to-one|many-to-one"):
        P.category_keys(items, more.union(more), dim, ["id"], ("s", "c"), ("ms", "mc")).collect()


def test_rules_find_what_is_seeded(spark):
    fact = spark.createDataFrame([(1, 1, "r1"), (1, 0, "r1"), (None, 2, None), (4, 9, "r1")], "id int, k int, run string")
    parents = spark.createDataFrame([(0,), (1,), (2,)], "k int")
    found = V.rules([
        V.grain_rule(fact, "GRAIN", ["id"]),
        V.reference_rule(fact, parents, "REF", {"k": "k"}),
        V.resolved_rule(fact, "KNOWN", ["k"]),
        V.lineage_rule(fact, "LINEAGE", ["run"]),
        V.rule(fact, "NONE", "critical", F.col("k") > 100),
    ])
    assert {r.rule_id: (r.violations, r.status) for r in V.classified(found).collect()} == {"GRAIN": (2, "FAIL"), "REF": (1, "FAIL"), "KNOWN": (1, "WARN"), "LINEAGE": (1, "FAIL"), "NONE": (0, "PASS")}
    assert tuple(V.overall(found).first()) == (5, 1, 1, 3, "FAIL")
    assert V.overall(found.filter("rule_id IN ('KNOWN', 'NONE')")).first().status == "PASS_WITH_WARNINGS"
    assert V.overall(found.filter("rule_id = 'NONE'")).first().status == "PASS"


def test_layers_and_conservation(spark):
    layer = lambda *rows: spark.createDataFrame(rows, "t string, n int")
    found = V.reconciled_layers({"raw": layer(("a", 5), ("b", 3)), "stage": layer(("a", 5), ("c", 1)), "audit": layer(("a", 5), ("b", 3), ("c", 1))}, ["t"], "n", ["raw", "stage", "audit"])
    assert {r.t: r.status for r in found.collect()} == {"a": "PASS", "b": "FAIL", "c": "FAIL"}
    kept = V.conserved(layer(("a", 5), ("b", 3)), layer(("a", 4), ("b", 3)), layer(("a", 1), ("c", 2)), ["t"])
    assert {r.t: r.status for r in kept.collect()} == {"a": "PASS", "b": "PASS", "c": "FAIL"}
    share = V.flag_coverage(spark.createDataFrame([("a", True), ("a", False), ("a", None)], "t string, f boolean"), ["t"], "f").first()
    assert (share.n_rows, share.flagged, share.coverage_pct) == (3, 1, 33.3333)
