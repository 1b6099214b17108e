"""The model's contract and its fit to the typed tables of the synthetic archive."""

from __future__ import annotations

import copy
import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import build as B
from ledgerloom.plans import model as M

CATALOG = {"award": {"ocid", "award_id", "amount"}, "award_supplier": {"ocid", "supplier"}}
MODEL = {
    "model": {"architecture": "fact_constellation", "unknown_surrogate_key": 0},
    "dimensions": {"dim_process": {"surrogate_key": "process_key", "natural_key": ["ocid"], "scd_type": 1, "mappings": {"ocid": {"source_ref": "award.ocid"}}}},
    "facts": {"fact_award": {"source_table": "award", "grain_columns": ["ocid", "award_id"], "foreign_keys": {"process_key": "dim_process"}, "measures": {"amount": {"aggregation": "sum", "additivity": "within_currency"}}}},
    "bridges": {"bridge_award_supplier": {"source_table": "award_supplier", "grain_columns": ["ocid"], "foreign_keys": {"process_key": "dim_process"}, "measures": {"n": {"aggregation": "sum", "additivity": "additive"}}, "prohibited_measures": ["amount"]}},
    "quality_gates": [{"gate_id": g} for g in M.GATES],
}
SHAPE = {"dimensions": 1, "facts": 1, "bridges": 1}


def wrong(change):
    model = copy.deepcopy(MODEL)
    change(model)
    return "; ".join(M.lint(model, CATALOG, {"within_currency", "additive"}, SHAPE))


def test_lint():
    assert wrong(lambda m: None) == ""
    fact, dim, bridge = (lambda m: m["facts"]["fact_award"]), (lambda m: m["dimensions"]["dim_process"]), (lambda m: m["bridges"]["bridge_award_supplier"])
    assert "Unknown Silver column award.gone" in wrong(lambda m: dim(m)["mappings"].update(x=[{"source_ref": "award.gone"}]))
    assert "prohibit monetary propagation" in wrong(lambda m: bridge(m).update(prohibited_measures=[]))
    assert "unknown source table" in wrong(lambda m: fact(m).update(source_table="zz"))
    assert "unknown grain columns ['y']" in wrong(lambda m: fact(m).update(grain_columns=["ocid", "y"]))
    assert "points to its process" in wrong(lambda m: fact(m).update(foreign_keys={"x_key": "dim_process"}))
    assert "known dimensions" in wrong(lambda m: fact(m).update(foreign_keys={"process_key": "dim_zz"}))
    assert "aggregation" in wrong(lambda m: fact(m)["measures"]["amount"].update(aggregation="max")) and "unknown additivity" in wrong(lambda m: fact(m)["measures"]["amount"].update(additivity="?"))
    assert "SCD" in wrong(lambda m: dim(m).update(scd_type=3)) and "natural key" in wrong(lambda m: dim(m).pop("natural_key")) and "surrogate key" in wrong(lambda m: dim(m).pop("surrogate_key"))
    assert "occurs twice" in wrong(lambda m: m["facts"].update(dim_process=fact(m))) and "snake" in wrong(lambda m: m["facts"].update(Fact=fact(m)))
    assert "is 0" in wrong(lambda m: m["model"].update(unknown_surrogate_key=-1)) and "fact_constellation" in wrong(lambda m: m["model"].pop("architecture")) and "id of its own" in wrong(lambda m: m["quality_gates"].append({"gate_id": M.GATES[0]}))
    assert "there are 1, not 8" in "; ".join(M.lint(MODEL, CATALOG))


def test_readers(tmp_path):
    (tmp_path / "m.json").write_text(json.dumps(MODEL))
    assert M.read_contract(tmp_path / "m.json") == MODEL
    (tmp_path / "l.json").write_text("[1]")
    with pytest.raises(ValueError, match="no mapping"):
        M.read_contract(tmp_path / "l.json")
    assert M.source_period("2026-07") == (2026, 7)
    for text in ("2026-13", "2026-7", "2026-07\n", "x"):
        with pytest.raises(ValueError):
            M.source_period(text)


def test_metrics_and_gates(built):
    silver = built[1]
    found = M.metrics(silver)
    got = {(r.metric_group, r.subject, r.metric): int(r.value) for r in found.collect()}
    assert [got["amounts", "tender", m] for m in ("parent_rows", "comparable_rows", "mismatches_over_0_01", "largest_difference")] == [2, 2, 2, 40]
    assert [got["attribution", "award", m] for m in ("without_supplier", "with_one_supplier", "with_several_suppliers", "most_suppliers")] == [1, 1, 1, 2] and got["attribution", "contract", "with_supplier"] == 2
    assert [got["rates", "award", m] for m in ("foreign_rows", "with_rate", "without_rate", "unused_rates")] == [1, 0, 1, 1] and got["rates", "tender_item", "with_rate"] == 1
    assert (got["references", "buyer_to_party", "orphan_keys"], got["references", "contract_to_award", "orphan_keys"]) == (1, 0)
    assert (got["warnings", "supplier", "name_conflicts"], got["warnings", "tenderer", "count_differences"], got["cardinality", "tender_item_classification", "most"]) == (0, 0, 1)
    gates = {r.gate_id: (r.status, r.violations) for r in M.gates(found).collect()}
    assert gates == {"DM-GRAIN-001": ("PASS", 0), "DM-REF-001": ("FAIL", 1), "DM-CAT-001": ("PASS", 0), "DM-SUP-001": ("PASS", 0), "DM-AMT-001": ("FAIL", 2), "DM-RATE-001": ("PASS", 0)}
    twice = {**silver, "tender_item_classification": silver["tender_item_classification"].union(silver["tender_item_classification"]), "award": silver["award"].union(silver["award"].filter(F.col(B.AWARDS + "id") == "A2"))}
    bad = {r.gate_id: r.violations for r in M.gates(M.metrics(twice)).filter("status = 'FAIL'").collect()}
    assert (bad["DM-GRAIN-001"], bad["DM-CAT-001"]) == (1, 1)
