"""The archive-level run: metrics gathered while writing, row identities, comparisons, status."""

from __future__ import annotations

import zipfile
from dataclasses import replace

import pytest

from ledgerloom.plans import silver as S
from ledgerloom.plans import silver_run as SR
from ledgerloom.sources import archive as A

CODE = "items/0/classification/"
ITEMS = S.Contract(grain=["id"], quarantine_duplicates=True, classification=S.Classification(CODE + "id", CODE + "description", CODE + "scheme"))
CONTRACTS = {
    "items.csv": ("item", ITEMS),
    "parties.csv": ("party", S.Contract(grain=["id", "scheme"], identifier=("scheme", "id", "dq_ruc_format_valid"))),
    "records.csv": ("process", S.Contract(grain=["ocid"], zero_flag=("value/amount", "dq_zero"), present_flag=("final", "dq_there"))),
}
ITEM_ROWS = f"id,{CODE}id,{CODE}description,{CODE}scheme\n1,,,\n2,x, padded ,s\n1,,,\n2,x,padded,s\n3,y,,s\n"


def archive(path, items=ITEM_ROWS, more=()):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("items.csv", items)
        z.writestr("parties.csv", "id,scheme\n20100000001,PE-RUC\n2010,pe-ruc\n,PE-RUC\n77,OTHER\n")
        z.writestr("records.csv", "ocid,value/amount,final\na,0.00,\nb,1.5,2\nb,0,\n,3,4\n")
        for name in more:
            z.writestr(name, "x\n1\n")
    return str(path)


def run(spark, tmp_path, path, contracts=CONTRACTS, overwrite=False):
    return SR.run_archive(spark, path, str(tmp_path / "unpacked"), str(tmp_path / "silver"), contracts, "src", "2026-07", "2026-07-31", "cfg", overwrite)


def test_metrics_comparison_and_status(spark, tmp_path):
    out = run(spark, tmp_path, archive(tmp_path / "a.zip"))
    m = {r.source_table: r for r in out.metrics.collect()}
    items = m["items.csv"]
    assert (items.raw_rows, items.silver_rows, items.quarantine_rows, items.trimmed_cells) == (5, 3, 2, 1)
    assert (items.additional_duplicate_rows_before, items.additional_duplicate_rows_after, items.duplicate_grain_rows_before, items.duplicate_grain_rows_after) == (2, 0, 2, 0)
    assert (items.incomplete_classification_rows_before, items.classification_rows_normalized, items.incomplete_classification_rows_after) == (2, 2, 0)
    parties, records = m["parties.csv"], m["records.csv"]
    assert (parties.null_grain_rows_before, parties.null_grain_rows_after, parties.identifier_invalid_rows) == (1, 1, 2)
    assert (records.duplicate_grain_rows_before, records.duplicate_grain_rows_after, records.null_grain_rows_after, records.zero_amount_rows, records.final_value_missing_rows) == (1, 1, 1, 2, 2)
    for r in m.values():
        assert r.raw_rows == r.silver_rows + r.quarantine_rows
        assert out.tables[r.source_table].silver.count() == r.silver_rows and len(out.tables[r.source_table].silver.columns) == r.columns_silver
    assert {r.rule_id: (r.before, r.after) for r in out.comparison.collect()} == {"DQ-UNIQ-001": (5, 3), "DQ-DUP-001": (2, 0), "DQ-ID-001": (2, 2), "DQ-CAT-001": (2, 0), "DQ-FIT-001": (2, 2), "DQ-BIZ-001": (2, 2)}
    assert out.status == "BLOCKED"  # the records' grain repeats
    assert [(r.source_row_number, r.rule_id) for r in out.tables["items.csv"].quarantine.orderBy(A.ROW_NUMBER).collect()] == [(3, "DQ-DUP-001"), (4, "DQ-DUP-001")]
    lineage = out.tables["items.csv"].silver.columns[-9:]
    assert lineage == ["source_id", "source_period", "snapshot_date", "ingestion_run_id", "source_file_name", "source_file_sha256", "source_table_name", "source_row_number", "loaded_at_utc"]
    assert {(r.ingestion_run_id, str(r.snapshot_date)) for t in out.tables.values() for r in t.silver.collect()} == {(out.run_id, "2026-07-31")}


def test_statuses_and_run_ids(spark, tmp_path):
    clean = "id,{0}id,{0}description,{0}scheme\n1,a,b,c\n".format(CODE)
    only = {"items.csv": CONTRACTS["items.csv"], "parties.csv": ("party", S.Contract()), "records.csv": ("process", S.Contract())}
    first = run(spark, tmp_path / "1", archive(tmp_path / "a.zip", clean), only)
    assert first.status == "PASS"
    again = run(spark, tmp_path / "2", str(tmp_path / "a.zip"), {**only, "parties.csv": ("party", replace(CONTRACTS["parties.csv"][1], grain=()))})
    assert again.status == "PASS_WITH_WARNINGS" and again.run_id == first.run_id
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        run(spark, tmp_path / "1", str(tmp_path / "a.zip"), only)
    assert run(spark, tmp_path / "1", str(tmp_path / "a.zip"), only, overwrite=True).metrics.filter("silver_rows = 1").count() == 1


def test_other_tables_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match=r"lacks \['gone.csv'\] and holds \['more.csv'\]"):
        run(spark, tmp_path, archive(tmp_path / "a.zip", more=["more.csv"]), {**CONTRACTS, "gone.csv": ("gone", S.Contract())})
    assert not (tmp_path / "silver").exists()


def test_equal_rows_with_nulls_in_other_places_differ(spark):
    raw = spark.createDataFrame([("a", None, 1), (None, "a", 2), ("a", None, 3), (None, None, 4), (None, None, 5)], f"x string, y string, {A.ROW_NUMBER} long")
    from ledgerloom.sources.scratch import shared_dir

    root = f"{shared_dir(spark)}/nulls"
    got = SR.run_table(raw, "t.csv", "t", S.Contract(quarantine_duplicates=True), f"{root}/s", f"{root}/q")
    assert sorted(r[A.ROW_NUMBER] for r in got.silver.collect()) == [1, 2, 4]
    assert sorted(r[A.ROW_NUMBER] for r in got.quarantine.collect()) == [3, 5]
