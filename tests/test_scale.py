"""What keeps the warehouse's cost in proportion to its input: what is made once, and what is neither sorted nor grouped."""

from __future__ import annotations

import pytest

from ledgerloom.operators import relational as R
from ledgerloom.plans import build as B
from ledgerloom.plans import governed as G
from ledgerloom.plans import warehouse_queries as WQ

from .oracle import SF, THERE


@pytest.mark.skipif(not THERE, reason="the driver's tables are not here")
def test_lines_are_made_once_for_all_typed_tables(spark):
    """Before, each of twelve typed tables joined the lines with orders and parts anew."""
    silver = WQ._silver(spark, SF)
    for name in ("award_item", "contract_item_classification", "tender_item_exchange_rate", "award", "contract"):
        plan = silver[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan, name


def test_facts_neither_count_nor_sort_their_wide_rows(built):
    """Before, whole rows went through an aggregate that sorts; now the grains do, and the rows join them."""
    silver, warehouse = built[1], built[2]
    contexts = {n: B.written(B.TABLES[n].build({**silver, **warehouse.tables})) for n in ("process_context", "attribution")}
    for fact in ("fact_award", "fact_contract", "fact_award_item", "fact_contract_item", "fact_tender_item"):
        plan = B.TABLES[fact].build({**silver, **warehouse.tables, **contexts})._jdf.queryExecution().optimizedPlan().toString()
        assert not [x for x in plan.split("\n") if ("Aggregate" in x or "RepartitionByExpression" in x or "Sort" in x) and "source_file_sha256" in x], fact


def test_weights_count_as_rows_do(spark):
    rows = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), ("a", "x", 1), ("b", None, 9)], "k string, v string, n int")
    assert {r.k: r.v for r in R.canonical_values(rows, ["k"], {"v": "v"}, "n").collect()} == {"a": "y", "b": None}


@pytest.mark.parametrize("grain", [("p1", "a1"), ("p1", None)])
def test_a_grain_that_is_there_twice_stops_the_build(spark, grain):
    t = {"award": spark.createDataFrame([grain, grain, ("p2", None)], "ocid string, a string"), "rates": spark.createDataFrame([("p1", "a1", 2)], "ocid string, a string, r int")}
    with pytest.raises(Exception, match="one-to-one"):
        B._grains(t, "award", ["ocid", "a"], "key", "rates", "r").collect()
    once = {**t, "award": t["award"].distinct()}
    got = B._with_grains(once["award"], B._grains(once, "award", ["ocid", "a"], "key", "rates", "r"), ["ocid", "a"]).collect()
    assert sorted(r.key for r in got) == [1, 2] and [r._rate for r in got if r.a] == [2] * (grain[1] is not None)


def test_references_meet_in_one_grouping_of_numbers(spark):
    """Before, keys were grouped twice, and the second time into lists, which sorts them."""
    tables = {"c": spark.createDataFrame([(1, 2), (1, None), (5, 5)], "p int, q int"), "d": spark.createDataFrame([(2,), (2,)], "p int"), "o": spark.createDataFrame([(1,), (2,)], "x int")}
    links = {"one": ("c", "o", {"p": "x"}), "two": ("c", "o", {"q": "x"}), "three": ("d", "o", {"p": "x"}), "four": ("o", "d", {"x": "p"})}
    found = G.references(tables, links)
    got = {r.relation: (r.rows_evaluated, r.orphans, r.orphan_keys) for r in found.collect()}
    assert got == {"one": (3, 1, 1), "two": (2, 1, 1), "three": (2, 0, 0), "four": (2, 1, 1)}
    assert "collect_list" not in found._jdf.queryExecution().optimizedPlan().toString()
    nothing = {n: df.limit(0) for n, df in tables.items()}
    assert {r.relation: r.rows_evaluated for r in G.references(nothing, links).collect()} == dict.fromkeys(links, 0)


def test_a_fact_of_some_columns_has_all_rows_and_needs_no_more(built, monkeypatch):
    """Before, a fact was numbered and written whole, with its lineage, for the three or five columns that the warnings read."""
    silver, whole = built[1], built[2]
    sorted_by, keys = [], R.dense_keys
    monkeypatch.setattr(R, "dense_keys", lambda df, order, key: sorted_by.append(key) or keys(df, order, key))
    narrow = B.build(silver, list(G.WARNED), G.WARNED)
    assert not [x for x in sorted_by if "fact" in x]
    for fact, columns in G.WARNED.items():
        got = narrow.tables[fact]
        assert got.columns == list(columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, whole.tables[fact].select(*columns).collect())), fact
