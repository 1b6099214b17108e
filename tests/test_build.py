"""From a synthetic archive of all 22 tables to every dimension, fact and bridge."""

from __future__ import annotations

import csv
import io
import zipfile
from decimal import Decimal

from ledgerloom.operators import relational as R
from ledgerloom.plans import build as B
from ledgerloom.plans import ocds
from ledgerloom.plans import silver_run as SR

R_, TEN, AWA, CON, PAR = "compiledRelease/", "compiledRelease/tender/", "compiledRelease/awards/0/", "compiledRelease/contracts/0/", "compiledRelease/parties/0/"


def item(prefix, n, **more):
    base = {"id": n, "position": "1", "description": f"item {n}", "status": "active", "statusDetails": "", "classification/id": "44", "classification/description": "Útil", "classification/scheme": "CUBSO", "unit/scheme": "U", "unit/id": "EA", "unit/name": "Each", "quantity": "2", "totalValue/amount": "40.00", "totalValue/currency": "PEN", "totalValue/currency_name": "Sol"}
    return {prefix + "items/0/" + k: v for k, v in {**base, **more}.items()}


def more_class(prefix, n, code):
    p = prefix + "items/0/"
    return {p + "id": n, p + "additionalClassifications/0/id": code, p + "additionalClassifications/0/description": f"class {code}", p + "additionalClassifications/0/scheme": "UNSPSC"}


def rate(prefix, currency, value):
    return {prefix + "exchangeRates/0/currency": currency, prefix + "exchangeRates/0/rate": value}


def party(ocid, n, roles, name, legal, scheme="PE-RUC", number="20100000001"):
    return {"ocid": ocid, PAR + "id": n, PAR + "roles": roles, PAR + "name": name, PAR + "identifier/scheme": scheme, PAR + "identifier/id": number, PAR + "identifier/legalName": legal, PAR + "address/department": "LIMA", PAR + "address/region": "LIMA", PAR + "address/locality": "X", PAR + "address/countryName": "PERU"}


def process(ocid, buyer, amount, declared, currency="PEN"):
    return {"ocid": ocid, R_ + "id": f"r-{ocid}", R_ + "date": "2026-07-02T03:00:00Z", R_ + "publishedDate": "2026-07-03T12:00:00Z", R_ + "initiationType": "tender", R_ + "buyer/id": buyer, R_ + "dataSegmentation/id": "s", R_ + "dataSegmentation/criteria": "c", TEN + "id": f"t-{ocid}", TEN + "title": "title", TEN + "description": "", TEN + "mainProcurementCategory": "goods", TEN + "additionalProcurementCategories": "", TEN + "procurementMethod": "open", TEN + "procurementMethodDetails": "", TEN + "datePublished": "2026-07-01T15:00:00Z", TEN + "tenderPeriod/startDate": "2026-07-01T15:00:00Z", TEN + "tenderPeriod/endDate": "", TEN + "enquiryPeriod/startDate": "", TEN + "enquiryPeriod/endDate": "", TEN + "numberOfTenderers": declared, TEN + "value/amount": amount, TEN + "value/amount_PEN": amount, TEN + "value/currency": currency, TEN + "value/currency_name": "Sol" if currency == "PEN" else "Dollar", R_ + "planning/budget/amount/amount": "", R_ + "planning/budget/amount/currency": "", R_ + "planning/budget/amount/currency_name": ""}


def award(ocid, n, amount, currency="PEN"):
    return {"ocid": ocid, AWA + "id": n, AWA + "date": "2026-07-10T12:00:00Z", AWA + "value/amount": amount, AWA + "value/currency": currency, AWA + "value/currency_name": "Sol" if currency == "PEN" else "Dollar"}


def contract(ocid, n, award_id, amount):
    return {"ocid": ocid, CON + "id": n, CON + "awardID": award_id, CON + "title": "t", CON + "description": "d", CON + "value/amount": amount, CON + "value/currency": "PEN", CON + "value/currency_name": "Sol", CON + "dateSigned": "2026-07-20T12:00:00Z", CON + "period/startDate": "", CON + "period/endDate": "", CON + "period/durationInDays": "30", CON + "implementation/endDate": "", CON + "implementation/finalValue/amount": ""}


TABLES = {
    "records.csv": [process("o1", "B1", "100.00", "2"), process("o2", "B9", "0.00", "")],
    "releases.csv": [{"ocid": "o1", "releases/0/details/id": "1", "releases/0/date": "2026-07-01T00:00:00Z"}],
    "com_sources.csv": [{"ocid": "o1", R_ + "sources/0/id": "s"}],
    "com_parties.csv": [party("o1", "B1", "buyer", "Buyer", "BUYER SA"), party("o1", "S1", "tenderer;supplier", "Beta", "BETA"), party("o2", "S1", "tenderer", "Beta", "BETA"), party("o2", "S2", "supplier", "Zulu", "ZULU", number="2010"), party("o2", "B1", "buyer", "Buyer", "Buyer S.A."), party("o1", "S2", "supplier", "Árbol", "ZULU", number="2010")],
    "com_par_additionalIdentifiers.csv": [{"ocid": "o1", PAR + "id": "B1", PAR + "additionalIdentifiers/0/id": "20555555555", PAR + "additionalIdentifiers/0/scheme": "PE-RUC"}, {"ocid": "o1", PAR + "id": "B1", PAR + "additionalIdentifiers/0/id": "9", PAR + "additionalIdentifiers/0/scheme": "PE-CE"}],
    "com_ten_tenderers.csv": [{"ocid": "o1", TEN + "tenderers/0/id": x} for x in ("S1", "S2")],
    "com_ten_documents.csv": [{"ocid": "o1", TEN + "documents/0/id": "d"}],
    "com_ten_items.csv": [{"ocid": "o1", **item(TEN, "1")}, {"ocid": "o1", **item(TEN, "2", **{"totalValue/amount": "55.00", "classification/id": "", "classification/scheme": "", "classification/description": ""})}, {"ocid": "o2", **item(TEN, "1", **{"totalValue/currency": "USD", "totalValue/currency_name": "Dollar", "unit/id": ""})}],
    "com_ten_ite_additionalClassific.csv": [{"ocid": "o1", **more_class(TEN, "1", "7")}],
    "com_ten_ite_tot_exchangeRates.csv": [{"ocid": "o2", TEN + "items/0/id": "1", **rate(TEN + "items/0/totalValue/", "USD", "3.75")}] * 2,
    "com_awards.csv": [award("o1", "A1", "90.00"), award("o1", "A2", "10.00", "USD"), award("o2", "A1", "5.00")],
    "com_awa_suppliers.csv": [{"ocid": o, AWA + "id": a, AWA + "suppliers/0/id": s} for o, a, s in (("o1", "A1", "S1"), ("o1", "A2", "S1"), ("o1", "A2", "S2"))],
    "com_awa_items.csv": [{"ocid": "o1", AWA + "id": "A1", **item(AWA, "1", **{"totalValue/amount": "90.00"})}, {"ocid": "o1", AWA + "id": "A2", **item(AWA, "1")}],
    "com_awa_ite_additionalClassific.csv": [{"ocid": "o1", AWA + "id": "A1", **more_class(AWA, "1", "7")}],
    "com_awa_ite_tot_exchangeRates.csv": [{"ocid": "o1", AWA + "id": "A9", AWA + "items/0/id": "1", **rate(AWA + "items/0/totalValue/", "USD", "3.7")}],
    "com_awa_val_exchangeRates.csv": [{"ocid": "o1", AWA + "id": "A9", **rate(AWA + "value/", "USD", "3.7")}],
    "com_contracts.csv": [contract("o1", "C1", "A1", "90.00"), contract("o1", "C2", "A2", "10.00")],
    "com_con_documents.csv": [{"ocid": "o1", CON + "id": "C1", CON + "documents/0/id": "d"}],
    "com_con_items.csv": [{"ocid": "o1", CON + "id": "C1", **item(CON, "1", **{"totalValue/amount": "89.50"})}],
    "com_con_ite_additionalClassific.csv": [{"ocid": "o1", CON + "id": "C1", **more_class(CON, "1", "8")}],
    "com_con_ite_tot_exchangeRates.csv": [{"ocid": "o1", CON + "id": "C9", CON + "items/0/id": "1", **rate(CON + "items/0/totalValue/", "USD", "3.7")}],
    "com_con_val_exchangeRates.csv": [{"ocid": "o1", CON + "id": "C9", **rate(CON + "value/", "USD", "3.7")}],
}


def text(rows):
    out = io.StringIO()
    writer = csv.DictWriter(out, list(rows[0]))
    writer.writeheader()
    writer.writerows(rows)
    return out.getvalue()


def make(spark, folder):
    """(archive run, typed tables, warehouse, failed checks), for the fixture that the tests share."""
    with zipfile.ZipFile(folder / "raw.zip", "w") as z:
        for name, rows in TABLES.items():
            z.writestr(name, text(rows))
    run = SR.run_archive(spark, str(folder / "raw.zip"), str(folder / "u"), str(folder / "s"), ocds.CONTRACTS, "src", "2026-07", "2026-07-31", "cfg")
    silver = {t.output: t.silver for t in run.tables.values()}
    warehouse, failed = B.dry_run(silver)
    return run, silver, warehouse, failed


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_archive_to_warehouse(built):
    run, silver, warehouse, failed = built
    assert run.status == "PASS_WITH_WARNINGS"
    assert list(warehouse.tables) == [n for n, t in B.TABLES.items() if t.kind != "context"] and len(warehouse.tables) == 16
    assert {r.rule_id for r in failed.collect()} == set()
    counts = {r.table_name: r.n for r in warehouse.row_counts().collect()}
    assert {k: v for k, v in counts.items() if k[:3] != "dim"} == {"fact_procurement_process": 2, "fact_tender_item": 3, "fact_award": 3, "fact_award_item": 2, "fact_contract": 2, "fact_contract_item": 1, "bridge_process_tenderer": 2, "bridge_award_supplier": 3}
    for name, source in B.SOURCES.items():
        assert warehouse.tables[name].columns[-9:] == list(B.LINEAGE)
        assert {r.source_row_number for r in warehouse.tables[name].collect()} == {r.source_row_number for r in silver[source].collect()}


def test_dimensions(built):
    t = built[2].tables
    buyer = by(t["dim_buyer"], "source_party_id")["B1"]
    assert (buyer.buyer_key, buyer.alternate_ruc, buyer.legal_name, buyer.name_variant_count, buyer.dq_name_conflict) == (1, "20555555555", "Buyer S.A.", 2, True)
    suppliers = by(t["dim_supplier"], "source_party_id")
    assert (suppliers["S2"].display_name, suppliers["S2"].dq_ruc_format_valid, suppliers["S1"].dq_ruc_format_valid) == ("Árbol", False, True)
    assert sorted(r.supplier_key for r in suppliers.values()) == [0, 1, 2]
    assert {r.currency_code: r.currency_name for r in t["dim_currency"].collect()} == {"__UNKNOWN__": "Desconocido", "PEN": "Sol", "USD": "Dollar"}
    assert {(r.classification_scheme, r.classification_code) for r in t["dim_category"].collect()} == {("UNKNOWN", "__UNCLASSIFIED__"), ("CUBSO", "44"), ("UNSPSC", "7"), ("UNSPSC", "8")}
    assert t["dim_date"].count() == 21  # 30 June to 20 July in local time would be 20 days; the unknown member is one more
    assert [(r.procurement_method, r.procurement_method_details) for r in t["dim_procurement_method"].filter("procurement_method_key = 1").collect()] == [("open", "__UNKNOWN__")]


def test_facts(built):
    t = built[2].tables
    process = by(t["fact_procurement_process"], "procurement_process_fact_key")
    one, two = process[1], process[2]
    assert (one.tender_item_amount_sum_original, one.tender_amount_difference_original, one.dq_tender_amount_reconciled_0_01) == (Decimal("95"), Decimal("5"), False)
    assert (one.buyer_key, two.buyer_key, one.tenderer_count_observed, one.dq_tenderer_count_matches_observed, two.dq_tender_value_is_zero, two.dq_tenderer_count_matches_observed) == (1, 0, 2, True, True, False)
    assert (one.tender_published_date_key, one.record_date_key, one.tender_period_end_date_key) == (20260701, 20260701, 0)
    award = by(t["fact_award"], "award_fact_key")
    assert [(award[i].award_id, award[i].supplier_count, award[i].attributed_supplier_key, award[i].dq_supplier_amount_attributable) for i in (1, 2, 3)] == [("A1", 1, 1, True), ("A2", 2, 0, False), ("A1", 0, 0, False)]
    assert [(award[i].conversion_rate_to_pen, award[i].dq_pen_conversion_available, award[i].dq_award_amount_reconciled_0_01) for i in (1, 2)] == [(Decimal(1), True, True), (None, False, False)]
    contract = by(t["fact_contract"], "contract_id")
    assert [(contract[c].attributed_supplier_key, contract[c].buyer_key, contract[c].procurement_method_key) for c in ("C1", "C2")] == [(1, 1, 1), (0, 1, 1)]
    assert contract["C1"].contract_amount_difference_original == Decimal("0.5") and contract["C2"].contract_item_amount_sum_original is None
    item = t["fact_contract_item"].first()
    assert (item.attributed_supplier_key, item.dq_supplier_amount_attributable, item.contract_signed_date_key, item.buyer_key, item.unit_key) == (1, True, 20260720, 1, 1)
    tender = by(t["fact_tender_item"], "tender_item_fact_key")
    assert [(tender[i].primary_category_key == 0, tender[i].dq_classification_was_missing, tender[i].dq_standard_category_missing) for i in (1, 2, 3)] == [(False, False, False), (True, True, True), (False, False, True)]
    assert (tender[3].total_amount_pen_calculated, tender[3].unit_key, tender[1].tender_published_date_key) == (Decimal("150"), 0, 20260701)
    assert {(r.award_id, r.attributed_supplier_key) for r in t["fact_award_item"].collect()} == {("A1", 1), ("A2", 0)}


def test_only_what_a_table_needs(built, monkeypatch):
    silver, seen = built[1], []
    real = {n: t.build for n, t in B.TABLES.items()}
    monkeypatch.setattr(B, "TABLES", {n: B.Table(t.kind, lambda f, n=n: seen.append(n) or real[n](f), t.needs) for n, t in B.TABLES.items()})
    out = B.build(silver, ["fact_award"])
    assert sorted(out.tables) == ["dim_buyer", "dim_currency", "dim_process", "dim_procurement_method", "dim_supplier", "fact_award"]
    assert sorted(seen) == sorted([*out.tables, "process_context", "attribution"]) and out.tables["fact_award"].count() == 3


def test_checks_find_a_broken_build(built):
    silver, warehouse = built[1], built[2]
    tables = {**warehouse.tables, "fact_award": warehouse.tables["fact_award"].limit(2), "dim_unit": warehouse.tables["dim_unit"].filter("unit_key <> 0")}
    tables["bridge_award_supplier"] = tables["bridge_award_supplier"].withColumn("amount", tables["bridge_award_supplier"].supplier_key)
    found = {(r.rule_id, r.subject) for r in B.check_build(B.Warehouse(tables), silver).filter("violations > 0").collect()}
    assert found == {("WH-ROWS", "fact_award"), ("WH-UNKNOWN", "dim_unit"), ("WH-BRIDGE", "bridge_award_supplier")}


def test_canonical_values_are_those_of_one_column(spark):
    rows = spark.createDataFrame([("a", "Beta", 1), ("a", "Beta", None), ("a", "Alfa", 2), ("b", "Zulu", None), ("b", "Árbol", None), (None, "x", 1)], "k string, v string, n int")
    got = by(R.canonical_values(rows, ["k"], {"name": "v", "num": "n"}), "k")
    assert {k: (r.name, r.num) for k, r in got.items()} == {"a": ("Beta", 1), "b": ("Árbol", None)}
    assert {r.k: r.name for r in R.canonical_by_key(rows, ["k"], "v", "name").collect()} == {k: r.name for k, r in got.items()}
