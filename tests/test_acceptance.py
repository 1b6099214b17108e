"""Acceptance of the synthetic archive's warehouse, right and with faults seeded."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import acceptance as A
from ledgerloom.plans import build as B
from ledgerloom.plans import governed as G

from .test_governed import audit, changed, when


@pytest.fixture(scope="module")
def loaded(spark, built):
    run, silver, warehouse, _ = built
    audited = audit(spark, silver, warehouse)
    recorded = {r.layer: r.rows for r in G.audit_by_layer(audited).collect()}
    return silver, warehouse, {"ingestion_run_id": run.run_id, "source_period": "2026-07"}, audited, recorded


def test_a_right_warehouse(loaded):
    got = A.accept(*loaded)
    row = got.verdict.first()
    bad = got.checks.filter("status NOT IN ('PASS', 'WARN')").collect()
    assert (row.status, row.promotion_eligible, row.failed, row.warned) == ("PASS_WITH_WARNINGS", True, 0, 7), bad
    assert (got.exit_code(), got.exit_code(strict=True)) == (0, 2)
    parts = {r.part: r["count"] for r in got.checks.groupBy("part").count().collect()}
    assert (parts["rules"], parts["rows"], parts["recorded"], parts["warnings"]) == (38, 38, 2, 9) and parts["identity"] == 2 * (len(loaded[0]) + 8)


def test_faults_block_it(spark, loaded):
    silver, warehouse, identity, audited, recorded = loaded
    other = {**silver, "award": when(f"{B.AWARDS}id = 'A1'", ingestion_run_id="other")(silver["award"])}
    # A warning that the warehouse no longer gives, a batch of another size, and a row of another run.
    fewer = changed(warehouse, fact_contract=when("true", dq_final_value_available=True))
    got = A.accept(other, fewer, identity, audited, {**recorded, "dw": 1})
    assert {(r.part, r.check_id) for r in got.checks.filter("status NOT IN ('PASS', 'WARN')").collect()} == {("identity", "stg.award.ingestion_run_id"), ("recorded", "dw"), ("warnings", "SQL-WARN-009")}
    row = got.verdict.first()
    assert (row.status, row.promotion_eligible, row.rules_failed, row.reconciliations_failed, got.exit_code()) == ("BLOCKED", False, 0, 3, 1)


def test_typed_warnings_see_conflicts(loaded):
    silver = loaded[0]
    before = {r.rule_id: r.n for r in A.typed_warnings(silver).collect()}
    assert before == {"SQL-WARN-001": 1, "SQL-WARN-002": 0, "SQL-WARN-003": 0, "SQL-WARN-004": 0, "SQL-WARN-005": 2, "SQL-WARN-006": 2, "SQL-WARN-007": 2, "SQL-WARN-008": 1, "SQL-WARN-009": 2}
    party = silver["party"]
    named = party.filter(F.col(B.PARTIES + "roles").rlike("supplier")).limit(1).withColumn(B.PARTIES + "identifier_legal_name", F.lit("another name"))
    items = silver["tender_item"].withColumn(B.TENDER + "items_classification_description", F.lit("another text"))
    after = {r.rule_id: r.n for r in A.typed_warnings({**silver, "party": party.union(named), "tender_item": silver["tender_item"].union(items), "tenderer": silver["tenderer"].limit(0)}).collect()}
    assert after["SQL-WARN-002"] == 1 and after["SQL-WARN-003"] >= 1 and after["SQL-WARN-004"] >= 1


def test_verdicts(spark):
    checks = lambda *s: spark.createDataFrame([("rules", str(i), x, "") for i, x in enumerate(s)], "part string, check_id string, status string, detail string")
    status = lambda *s: A.verdict(checks(*s)).first().status
    assert [status("PASS"), status("PASS", "WARN"), status("WARN", "FAIL"), status(None), status()] == ["PASS", "PASS_WITH_WARNINGS", "BLOCKED", "BLOCKED", "BLOCKED"]
    tables = {"a": spark.createDataFrame([("r", "p"), (None, "p")], "ingestion_run_id string, source_period string"), "b": spark.createDataFrame([], "ingestion_run_id string, source_period string")}
    got = {(r.table_name, r.column_name): (r.n_rows, r.other_rows, r.status) for r in A.identity_checks(tables, {"ingestion_run_id": "r", "source_period": "p"}).collect()}
    assert got == {("a", "ingestion_run_id"): (2, 1, "FAIL"), ("a", "source_period"): (2, 0, "PASS"), ("b", "ingestion_run_id"): (0, 0, "PASS"), ("b", "source_period"): (0, 0, "PASS")}
