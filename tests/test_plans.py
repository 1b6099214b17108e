from __future__ import annotations

import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import exprs as X
from ledgerloom.plans import silver as S
from ledgerloom.plans import warehouse as W
from ledgerloom.sources import archive as A
from ledgerloom.sources import publish as P


@pytest.fixture
def archive(tmp_path):
    path = tmp_path / "raw.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("x/items.csv", "id,items/0/classification/id,items/0/classification/description,items/0/classification/scheme,value/amount\n1,,,,0\n2,44120000,Útiles,UNSPSC,2.50\n1,,,,0\n4,NA,x,y,\n")
        z.writestr("y/parties.csv", 'id,name\n1,"two\nlines"\n'.encode("cp1252"))
    return path


def contract():
    p = "items/0/classification/"
    return S.Contract(grain=["id"], integers=frozenset(["id"]), quarantine_duplicates=True, classification=S.Classification(p + "id", p + "description", p + "scheme"), zero_flag=("value/amount", "dq_zero"), present_flag=("value/amount", "dq_there"), lineage={"source_period": "2026-07"})


def test_archive_to_silver(spark, archive, tmp_path):
    tables = A.read_archive(spark, archive, tmp_path / "unpacked")
    assert sorted(tables) == ["items.csv", "parties.csv"]
    assert [tuple(r) for r in tables["parties.csv"].collect()] == [("1", "two\nlines", 1)]
    out = S.transform(tables["items.csv"], contract())
    got = {r.source_row_number: r for r in out.silver.collect()}
    assert sorted(got) == [1, 2, 4]
    assert (got[1].id, got[1].items_classification_id, got[1].items_classification_description, got[1].items_classification_scheme) == (1, *X.UNCLASSIFIED)
    assert got[2].value_amount == Decimal("2.5") and got[2].items_classification_description == "Útiles"
    assert [(got[i].dq_classification_was_missing, got[i].dq_zero, got[i].dq_there) for i in (1, 2, 4)] == [(True, True, True), (False, False, True), (True, False, False)]
    assert [(r.source_row_number, r.rule_id) for r in out.quarantine.collect()] == [(3, "DQ-DUP-001")]
    m = out.metrics.first()
    assert (m.rows_in, m.rows_kept, m.rows_quarantined, m.duplicate_grain_rows_before, m.duplicate_grain_rows_after, m.classifications_filled) == (4, 3, 1, 1, 0, 2)


def test_members_are_unpacked_by_tasks(spark, archive, tmp_path, monkeypatch):
    here = A.unpack(archive, tmp_path / "here")

    def refused(*args, **kwargs):
        raise AssertionError("the driver unpacks a member")

    monkeypatch.setattr(zipfile.ZipFile, "open", refused)
    tables = A.read_archive(spark, archive, tmp_path / "there")
    assert tables["parties.csv"].count() == 1 and tables["items.csv"].count() == 4
    for name, (path, encoding) in A.unpack(archive, tmp_path / "there", spark).items():
        assert open(path, "rb").read() == open(here[name][0], "rb").read() and encoding == here[name][1]
    assert sorted(x.name for x in (tmp_path / "there").iterdir()) == sorted(here)


def test_untypable_cell_raises(spark):
    raw = spark.createDataFrame([("1.5", 1)], f"id string, {A.ROW_NUMBER} long")
    with pytest.raises(Exception, match="is no integer"):
        S.transform(raw, S.Contract(integers=frozenset(["id"]))).silver.collect()


def test_archive_guards(archive, tmp_path):
    with zipfile.ZipFile(archive, "a") as z:
        z.writestr("z/items.csv", "id\n")
    with pytest.raises(ValueError, match="twice"):
        A.unpack(archive, tmp_path / "u")
    assert A.encoding_of("é".encode() * 9) == "utf-8" and A.encoding_of("é".encode()[:1]) == "utf-8" and A.encoding_of("é".encode("cp1252") + b" ") == "cp1252"
    one, two = tmp_path / "a", tmp_path / "b"
    one.write_bytes(b"x\r\ny\n"), two.write_bytes(b"x\ny\n")
    assert A.sha256_text(one) == A.sha256_text(two) and A.sha256_file(one) != A.sha256_file(two)
    with pytest.raises(ValueError):
        A.file_url("https://host", "seace_v3", "json", 2026, 7, "es")
    assert A.file_url("https://host/", "seace_v3", "csv", 2026, 7, "es") == "https://host/seace_v3/csv/2026/07/es"


def test_publish_is_idempotent_and_never_overwrites(spark, tmp_path):
    root, df = str(tmp_path / "dw"), spark.range(3)
    assert P.write_once(df, f"{root}/one") == 3
    with pytest.raises(Exception, match="(?i)exists"):
        P.write_once(df, f"{root}/one")
    assert P.current_batch(spark, root) is None
    batch, state = P.load(spark, root, {"t": df}, {"period": "2026-07"})
    assert state == "LOADED" and P.load(spark, root, {"t": df}, {"period": "2026-07"}) == (batch, "SKIPPED_IDEMPOTENT")
    with pytest.raises(Exception):
        P.load(spark, root, {"t": df.select(F.raise_error(F.lit("no")).alias("x"))}, {"period": "2026-08"})
    assert P.current_batch(spark, root) == batch and P.read_current(spark, root, "t").count() == 3
    assert {r.status for r in P.audit(spark, root).filter("table_name = ''").collect()} == {"SUCCEEDED", "FAILED"}
    assert P.run_id("a", "b") == P.run_id("a", "b") != P.run_id("a", "c")


def test_warehouse(spark):
    party = spark.createDataFrame([("s1", "Uno", "supplier;tenderer"), ("s1", "UNO", "supplier"), ("s1", "Uno", "supplier"), ("s2", "Dos", "tenderer"), ("b1", "Comprador", "buyer"), (None, "x", "supplier")], "id string, name string, roles string").withColumn("source_period", F.lit("2026-07"))
    suppliers = W.dim_party(party, "roles", "tenderer|supplier", "supplier_key", "id", {"name": "name"})
    assert sorted((r.supplier_key, r.source_party_id, r.name, r.dq_name_conflict) for r in suppliers.collect()) == [(0, X.UNKNOWN, X.UNKNOWN, False), (1, "s1", "Uno", True), (2, "s2", "Dos", False)]
    award = spark.createDataFrame([("a1", "10.00", "USD", "2026-07-01 03:00:00"), ("a2", "20.00", "PEN", None), ("a3", None, "EUR", None)], "award string, amount string, cur string, at string").select("award", F.col("amount").cast(X.MONEY).alias("amount"), "cur", F.to_timestamp("at").alias("at")).withColumn("source_period", F.lit("2026-07"))
    pairs = spark.createDataFrame([("a1", "s1"), ("a2", "s1"), ("a2", "s2")], "award string, supplier string")
    rates = spark.createDataFrame([("a1", "3.75")], "award string, rate string")
    items = spark.createDataFrame([("a1", "i1", "4", "UNSPSC", "1", False), ("a1", "i2", "6", "UNKNOWN", "__UNCLASSIFIED__", True), ("a2", "i1", "18", "UNSPSC", "1", True)], "award string, item string, total string, scheme string, code string, dq_classification_was_missing boolean").withColumn("source_period", F.lit("2026-07")).withColumn("text", F.lit("t"))
    currencies = W.dim_of_union([(award, {"code": "cur"})], ["code"], "currency_key")
    fact = W.fact_header(award, items.withColumnRenamed("total", "item_total"), pairs, rates, suppliers, currencies, W.Header(["award"], "amount", "cur", "at", "item_total", "supplier"), "award_key")
    got = {r.award: r for r in fact.collect()}
    assert (got["a1"].award_key, got["a1"].amount_pen, got["a1"].attributed_supplier_key, got["a1"].is_reconciled, got["a1"].date_key) == (1, Decimal("37.5"), 1, True, 20260630)
    assert (got["a2"].amount_pen, got["a2"].supplier_count, got["a2"].attributed_supplier_key, got["a2"].dq_supplier_amount_attributable, got["a2"].is_reconciled) == (Decimal("20"), 2, 0, False, False)
    assert (got["a3"].amount_pen, got["a3"].supplier_count, got["a3"].item_count) == (None, 0, 0)
    categories = W.dim_category([(items, "scheme", "code", "text")])
    assert sorted((r.category_key, r.scheme, r.code) for r in categories.collect()) == [(0, "UNKNOWN", "__UNCLASSIFIED__"), (1, "UNSPSC", "1")]
    lines = {(r.award, r.item): r for r in W.fact_item(items, fact, categories, ["award"], ["award", "item"], "scheme", "code", "item_key").collect()}
    assert [lines[k].category_key for k in sorted(lines)] == [1, 0, 0] and [lines[k].attributed_supplier_key for k in sorted(lines)] == [1, 1, 0]
    link = W.bridge(pairs, fact, suppliers, ["award"], "award_key", "supplier")
    assert sorted(map(tuple, link.collect())) == [(1, 1), (2, 1), (2, 2)]
    checks = W.check_warehouse({"supplier": (suppliers, "supplier_key"), "currency": (currencies, "currency_key")}, {"award_supplier": link, "bad": link.withColumn("amount", F.lit(1))})
    assert {(r.subject, r.violations) for r in checks.collect()} == {("supplier", 0), ("currency", 0), ("award_supplier", 0), ("bad", 1)}
    dates = W.dim_date(spark, [award], ["at"])
    assert sorted(r.date_key for r in dates.collect()) == [0, 20260630]
    assert dates.filter("date_key > 0").first().month_name == "junio"
    methods = W.dim_method(spark.createDataFrame([("open", None, "p"), (None, None, "p")], "m string, d string, source_period string"), "m", "d")
    assert sorted((r.method_key, r.method, r.details) for r in methods.collect()) == [(0, X.UNKNOWN, X.UNKNOWN), (1, "open", X.UNKNOWN)]
