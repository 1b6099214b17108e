"""The governed rules over the warehouse of the synthetic archive: a seeded violation for each is found, and only there."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import relational as R
from ledgerloom.plans import build as B
from ledgerloom.plans import governed as G
from ledgerloom.plans import validation as V

AUDIT = "layer string, table_name string, status string, rows long, physical_rows long"


def audit(spark, silver, warehouse):
    rows = [("stg", n, "SUCCEEDED", df.count()) for n, df in silver.items()] + [("dw", n, "SUCCEEDED", df.count()) for n, df in warehouse.tables.items()]
    return spark.createDataFrame([(*r, r[3]) for r in rows], AUDIT)


@pytest.fixture(scope="module")
def whole(spark, built):
    run, silver, warehouse, _ = built
    return silver, warehouse, {"ingestion_run_id": run.run_id, "source_period": "2026-07"}, audit(spark, silver, warehouse)


def changed(warehouse, **tables):
    return B.Warehouse({**warehouse.tables, **{n: f(warehouse.tables[n]) for n, f in tables.items()}})


def failures(found):
    return {r.rule_id: r.violations for r in found.collect() if r.status == "FAIL"}


def test_all_rules_of_a_right_warehouse(whole):
    _, warehouse, identity, audited = whole
    found = {r.rule_id: r for r in G.evaluate(warehouse, identity, audited).collect()}
    assert set(found) == {*G.CRITICAL, *G.WARNINGS} and len(G.CRITICAL) + len(G.WARNINGS) == 38
    assert {k for k, r in found.items() if r.status == "FAIL"} == set()
    assert {k: r.violations for k, r in found.items() if r.status == "WARN"} == {"SQL-WARN-001": 1, "SQL-WARN-005": 2, "SQL-WARN-006": 2, "SQL-WARN-007": 2, "SQL-WARN-008": 1, "SQL-WARN-009": 2, "SQL-WARN-011": 1}
    assert found["SQL-REF-001"].detail.startswith("55 foreign keys")


def when(rows, **values):
    """Sets columns in the rows of a condition."""
    return lambda df: df.withColumns({c: F.when(F.expr(rows), F.lit(v).cast(df.schema[c].dataType)).otherwise(F.col(c)) for c, v in values.items()})


SEEDED = {
    "SQL-DIM-001": {"dim_unit": lambda df: df.union(df.filter("unit_key = 0"))},
    "SQL-DIM-002": {"dim_date": lambda df: df.filter("date_key <> 20260705")},
    "SQL-GRAIN-003": {"fact_award": lambda df: df.union(df.filter("award_fact_key = 3"))},
    "SQL-REF-001": {"fact_tender_item": when("tender_item_fact_key = 1", unit_key=99)},
    "SQL-REF-002": {"fact_contract": when("contract_id = 'C2'", award_id="zz")},
    "SQL-LINEAGE-001": {"fact_award_item": when("award_id = 'A1'", ingestion_run_id="other")},
    "SQL-BRIDGE-001": {"bridge_award_supplier": lambda df: df.withColumn("total_amount", F.lit(1))},
    "SQL-BUS-001": {"fact_procurement_process": when("process_key = 1", tenderer_count_observed=5)},
    "SQL-BUS-002": {"bridge_award_supplier": lambda df: df.filter("NOT (award_id = 'A2' AND supplier_key = 2)")},
    "SQL-BUS-003": {"fact_award": when("award_id = 'A2'", dq_supplier_amount_attributable=True)},
    "SQL-BUS-004": {"fact_award_item": when("award_id = 'A2'", attributed_supplier_key=1)},
    "SQL-BUS-005": {"fact_contract": when("contract_id = 'C2'", attributed_supplier_key=1)},
    "SQL-BUS-006": {"fact_contract_item": when("true", attributed_supplier_key=2)},
    "SQL-CALC-001": {"fact_contract": when("contract_id = 'C1'", contract_amount_pen_calculated=None)},
    "SQL-CALC-002": {"fact_contract": when("contract_id = 'C1'", contract_item_amount_sum_original=Decimal(90))},
    "SQL-CALC-003": {"fact_award_item": when("award_id = 'A2'", dq_standard_category_missing=False)},
    "SQL-CALC-004": {"fact_procurement_process": when("process_key = 2", dq_tender_value_is_zero=False)},
}


@pytest.mark.parametrize("group", [("SQL-DIM-001", "SQL-DIM-002", "SQL-LINEAGE-001", "SQL-CALC-001", "SQL-BUS-001"), ("SQL-REF-001", "SQL-BRIDGE-001", "SQL-BUS-003", "SQL-CALC-002", "SQL-CALC-003"), ("SQL-REF-002", "SQL-BUS-006", "SQL-CALC-004")])
def test_seeded_violations(whole, group):
    """Several faults in tables that don't touch each other are seeded at once."""
    _, warehouse, identity, audited = whole
    tables = {n: f for rule in group for n, f in SEEDED[rule].items()}
    assert len(tables) == len(group)
    got = failures(G.evaluate(changed(warehouse, **tables), identity, audited))
    further = {"SQL-CALC-001": {"SQL-CALC-002"}}
    assert set(group) <= set(got) and set(got) <= set(group) | {"SQL-BUS-005", "SQL-BUS-004"} | set().union(*further.values())


@pytest.mark.parametrize("rule", ["SQL-BUS-002", "SQL-BUS-004", "SQL-BUS-005"])
def test_seeded_attribution(whole, rule):
    assert [r.violations for r in V.rules(G.attribution_rules(changed(whole[1], **SEEDED[rule]).tables)).filter(F.col("rule_id") == rule).collect()] == [1]


def test_audit_rules(spark, whole):
    _, warehouse, identity, audited = whole
    wrong = audited.withColumn("physical_rows", F.when(F.col("table_name") == "dim_unit", 0).otherwise(F.col("physical_rows"))).withColumn("status", F.when(F.col("table_name") == "award", "FAILED").otherwise(F.col("status")))
    got = failures(G.evaluate(warehouse, identity, wrong))
    assert got == {"SQL-AUDIT-001": 1, "SQL-AUDIT-002": 1}
    assert failures(G.evaluate(warehouse, identity, audited.limit(0))) == {"SQL-BATCH-001": 1}


def test_references_count_rows_by_relation(spark):
    child = spark.createDataFrame([(1, "a", 7), (2, "a", None), (2, "b", 8), (None, "a", 7), (9, "c", 8)], "p int, q string, r int")
    tables = {"child": child, "parent": spark.createDataFrame([(1, "a", 7), (2, "b", 9)], "x long, y string, z int")}
    links = {"one": ("child", "parent", {"p": "x"}), "two": ("child", "parent", {"p": "x", "q": "y"}), "three": ("child", "parent", {"r": "z"}), "self": ("child", "child", {"r": "p"})}
    got = {r.relation: (r.rows_evaluated, r.orphans) for r in G.references(tables, links).collect()}
    assert got == {"one": (4, 1), "two": (4, 2), "three": (4, 2), "self": (4, 4)}
    plan = G.references(tables, links)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 4
    assert {r["check"]: r.violations for r in G.predicates(tables, {"a": ("child", "p > 1"), "b": ("parent", "z > 7"), "c": ("child", "r = 7 OR r = 8")}).collect()} == {"a": 1, "b": 1, "c": 0}


def test_layers(spark, whole):
    silver, warehouse, _, audited = whole
    controls = G.financial_controls(silver, warehouse).collect()
    assert len({r.control for r in controls}) == 7 and {r.status for r in controls} == {"PASS"}
    assert {(r.control, r.currency_code) for r in controls} >= {("budget", "__UNKNOWN__"), ("tender_item", "USD")}
    found = G.reconciled_rows(silver, warehouse, audited).collect()
    assert len(found) == 38 and {r.status for r in found} == {"PASS"}, [r for r in found if r.status != "PASS"]
    fewer = G.financial_controls(silver, changed(warehouse, fact_award=lambda df: df.filter("award_id <> 'A2'"))).filter("status = 'FAIL'").collect()
    assert [(r.control, r.currency_code, r.actual_row_count, r.expected_row_count) for r in fewer] == [("award", "USD", None, 1)]
    broken = audited.filter("table_name <> 'award'").withColumn("rows", F.when(F.col("table_name") == "dim_date", 1).otherwise(F.col("rows")))
    assert {r.table_name for r in G.reconciled_rows(silver, warehouse, broken).filter("status = 'FAIL'").collect()} == {"award", "dim_date"}


RESULT = "rule_id string, severity string, violations long, detail string"


def test_catalog_and_results_must_agree(spark):
    known = spark.createDataFrame([("A", "critical"), ("B", "warning")], "rule_id string, severity string")
    results = lambda *ids: spark.createDataFrame([(i, "info", n, "") for i, n in ids], RESULT)
    got = {r.rule_id: (r.severity, r.status) for r in V.against_catalog(results(("A", 1), ("B", 1)), known).collect()}
    assert got == {"A": ("critical", "FAIL"), "B": ("warning", "WARN")}
    for ids, why in (((("A", 0),), "B has no result"), ((("A", 0), ("B", 0), ("C", 0)), "C is not governed"), ((("A", 0), ("A", 0), ("B", 0)), "A is there twice")):
        with pytest.raises(Exception, match=why):
            V.against_catalog(results(*ids), known).collect()


def test_rules_see_what_is_absent(spark):
    fact = spark.createDataFrame([("PEN", "10", "1", None, False), ("USD", "10", "2", None, True), ("USD", "10", None, None, False), ("PEN", None, "1", None, False)], "cur string, a string, r string, c string, f boolean").select("cur", F.col("a").cast("decimal(38,14)").alias("a"), F.col("r").cast("decimal(18,14)").alias("r"), F.col("c").cast("decimal(38,14)").alias("c"), "f")
    got = {r.rule_id: r.violations for r in V.conversion_rules(fact, "W", "a", "r", "c", "cur", "f").collect()}
    assert got == {"W-HOME": 0, "W-POSITIVE": 0, "W-INVENTED": 0, "W-ABSENT": 2, "W-PRODUCT": 0, "W-FLAG": 1}
    heads = spark.createDataFrame([(1, "10", "9", "1", False), (None, "5", "5", "0", True), (3, "5", None, None, False)], "k int, h string, s string, d string, f boolean").select("k", *(F.col(c).cast("decimal(38,14)").alias(c) for c in "hsd"), "f")
    items = spark.createDataFrame([(1, "4"), (1, "4"), (None, "5"), (3, "5")], "k int, x string")
    got = {r.rule_id: r.violations for r in V.reconciliation_rules(heads, "H", "h", "s", "d", "f", items, ["k"], "x").collect()}
    assert got == {"H-SUM": 2, "H-DIFFERENCE": 2, "H-FLAG": 1, "H-MISMATCH": 2}


def test_null_keys_ties_and_repeated_members(spark):
    one = spark.createDataFrame([("a", 1), (None, 2)], "k string, n long")
    assert {(r.k, r.status) for r in R.reconciled(one, one, ["k"], ["n"]).collect()} == {("a", "PASS"), (None, "PASS")}
    assert {(r.k, r.status) for r in V.conserved(one, one, one.limit(0), ["k"]).collect()} == {("a", "PASS"), (None, "PASS")}
    dim = spark.createDataFrame([(1, "a"), (2, "a")], "key int, m string")
    with pytest.raises(Exception, match="repeats m"):
        R.lookup_key(spark.createDataFrame([("a",)], "m string"), dim, {"m": "m"}, "key").collect()
    rows = spark.createDataFrame([("x", 1, "p"), ("x", 1, "o"), ("x", 1, "o"), ("y", None, "q"), ("y", None, "q"), ("z", None, "r"), ("z", 4, "s")], "c string, o int, v string")
    kept, others = R.split_duplicates(rows, ["c"], "o")
    assert sorted(map(tuple, kept.collect()), key=str) == [("x", 1, "o"), ("y", None, "q"), ("z", 4, "s")]
    assert sorted(map(tuple, others.collect()), key=str) == [("x", 1, "o"), ("x", 1, "p"), ("y", None, "q"), ("z", None, "r")]
