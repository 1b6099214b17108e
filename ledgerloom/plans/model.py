"""The dimensional model: a lint of its contract, and how well it fits the typed tables.

``metrics`` measures a model over the typed tables as one long table (metric_group, subject,
metric, value), and ``gates`` decides over that table; neither needs a built warehouse.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping
from datetime import date
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import exprs as X
from ledgerloom.operators import relational as R

from . import build as B
from . import governed as G

# Vocabularies of the model contract, its numbers of objects and its gates.
SCD_TYPES = (0, 1, 2)
AGGREGATIONS = ("sum", "average", "none")
SHAPE = {"dimensions": 8, "facts": 6, "bridges": 2}
GATES = ("DM-GRAIN-001", "DM-REF-001", "DM-CAT-001", "DM-SUP-001", "DM-AMT-001", "DM-RATE-001")
_NAME = re.compile(r"[a-z][a-z0-9]*(_[a-z0-9]+)*")


def read_contract(path: str | Path) -> dict:
    """A mapping from a JSON file, or from YAML where a reader of it is installed."""
    text = Path(path).read_text(encoding="utf-8")
    if Path(path).suffix.lower() in (".yml", ".yaml"):
        import yaml  # an optional package

        found = yaml.safe_load(text)
    else:
        found = json.loads(text)
    if not isinstance(found, dict):
        raise ValueError(f"{path} holds no mapping")
    return found


def source_period(text: str) -> tuple[int, int]:
    """(year, month) of a text such as 2026-07; an error if there is no such month."""
    if not re.fullmatch(r"[0-9]{4}-[0-9]{2}", text):
        raise ValueError(f"{text!r} is no period such as 2026-07")
    try:
        day = date.fromisoformat(f"{text}-01")
    except ValueError as wrong:
        raise ValueError(f"{text!r} names no valid month") from wrong
    return day.year, day.month


def _refs(node: object, at: str = "") -> Iterator[tuple[str, str]]:
    """(place, table.column) of every source_ref, at any depth."""
    if isinstance(node, Mapping):
        for k, v in node.items():
            if k == "source_ref":
                yield at, str(v)
            else:
                yield from _refs(v, f"{at}.{k}" if at else str(k))
    elif isinstance(node, list):
        for i, v in enumerate(node):
            yield from _refs(v, f"{at}[{i}]")


def lint(model: Mapping, catalog: Mapping[str, set[str]], additivity: set[str] | None = None, shape: Mapping[str, int] | None = None) -> list[str]:
    """What is wrong with a model contract, all of it; empty if nothing is. ``catalog`` holds the columns of each typed table."""
    wrong = []
    head = model.get("model") or {}
    if head.get("architecture") != "fact_constellation":
        wrong.append("model: the architecture is fact_constellation")
    if head.get("unknown_surrogate_key") != 0:
        wrong.append("model: the unknown surrogate key is 0")
    parts = {kind: model.get(kind) or {} for kind in SHAPE}
    names = [n for kind in SHAPE for n in parts[kind]]
    wrong += [f"{n}: the name occurs twice" for n in sorted({n for n in names if names.count(n) > 1})]
    wrong += [f"{n}: a name is lower snake case" for n in names if not _NAME.fullmatch(n)]
    wrong += [f"{kind}: there are {len(parts[kind])}, not {n}" for kind, n in (SHAPE if shape is None else shape).items() if len(parts[kind]) != n]
    keys = [d.get("surrogate_key") for d in parts["dimensions"].values()]
    for name, d in parts["dimensions"].items():
        if not isinstance(d.get("surrogate_key"), str) or not _NAME.fullmatch(d["surrogate_key"]):
            wrong.append(f"{name}: it has no surrogate key")
        elif keys.count(d["surrogate_key"]) > 1:
            wrong.append(f"{name}: another dimension has the surrogate key {d['surrogate_key']}")
        if not d.get("natural_key"):
            wrong.append(f"{name}: it has no natural key")
        if d.get("scd_type") not in SCD_TYPES:
            wrong.append(f"{name}: its SCD type is none of {SCD_TYPES}")
    for kind in ("facts", "bridges"):
        for name, o in parts[kind].items():
            table = o.get("source_table")
            if table not in catalog:
                wrong.append(f"{name}: unknown source table {table}")
            gone = sorted(set(o.get("grain_columns") or []) - catalog.get(table, set()))
            if not o.get("grain_columns") or gone:
                wrong.append(f"{name}: unknown grain columns {gone}" if gone else f"{name}: it has no grain")
            links = o.get("foreign_keys") or {}
            if not links or set(links.values()) - set(parts["dimensions"]):
                wrong.append(f"{name}: its foreign keys point to known dimensions")
            if kind == "facts" and "process_key" not in links:
                wrong.append(f"{name}: a fact points to its process")
            if not o.get("measures"):
                wrong.append(f"{name}: it has no measures")
            for m, how in (o.get("measures") or {}).items():
                if not _NAME.fullmatch(m) or how.get("aggregation") not in AGGREGATIONS:
                    wrong.append(f"{name}.{m}: an aggregation is one of {AGGREGATIONS}")
                if additivity is not None and how.get("additivity") not in additivity:
                    wrong.append(f"{name}.{m}: unknown additivity {how.get('additivity')}")
            if kind == "bridges" and not o.get("prohibited_measures"):
                wrong.append(f"{name}: a bridge must prohibit monetary propagation")
    for at, ref in _refs(model):
        table, _, column = ref.partition(".")
        if column not in catalog.get(table, set()):
            wrong.append(f"{at}: Unknown Silver column {ref}")
    gates = [g.get("gate_id") for g in model.get("quality_gates") or []]
    if not gates or len(gates) != len(set(gates)):
        wrong.append("quality_gates: each has an id of its own")
    return wrong


GRAINS = {
    "fact_procurement_process": ["ocid"], "fact_tender_item": ["ocid", B.TENDER + "items_id"], "fact_award": ["ocid", B.AWARDS + "id"], "fact_award_item": ["ocid", B.AWARDS + "id", B.AWARDS + "items_id"],
    "fact_contract": ["ocid", B.CONTRACTS + "id"], "fact_contract_item": ["ocid", B.CONTRACTS + "id", B.CONTRACTS + "items_id"],
    "bridge_process_tenderer": ["ocid", B.TENDER + "tenderers_id"], "bridge_award_supplier": ["ocid", B.AWARDS + "id", B.AWARDS + "suppliers_id"],
}
_PARTY = ("ocid", B.PARTIES + "id")
#: References between typed tables, told by the different keys that are not found.
LINKS = {
    "buyer_to_party": ("procurement_process", "party", dict(zip(("ocid", B.CR + "buyer_id"), _PARTY))),
    "tenderer_to_party": ("tenderer", "party", dict(zip(("ocid", B.TENDER + "tenderers_id"), _PARTY))),
    "award_supplier_to_party": ("award_supplier", "party", dict(zip(("ocid", B.AWARDS + "suppliers_id"), _PARTY))),
    "contract_to_award": ("contract", "award", {"ocid": "ocid", B.CONTRACTS + "award_id": B.AWARDS + "id"}),
}
#: Header and items: (subject, header, items, keys, header amount, item amount).
AMOUNTS = (
    ("tender", "procurement_process", "tender_item", ["ocid"], B.TENDER + "value_amount", B.TENDER + "items_total_value_amount"),
    ("award", "award", "award_item", ["ocid", B.AWARDS + "id"], B.AWARDS + "value_amount", B.AWARDS + "items_total_value_amount"),
    ("contract", "contract", "contract_item", ["ocid", B.CONTRACTS + "id"], B.CONTRACTS + "value_amount", B.CONTRACTS + "items_total_value_amount"),
)
#: Amounts with rates: (typed table, keys, currency, rates, rate).
RATES = (
    *((t, GRAINS[f"fact_{t}"], p + "total_value_currency", f"{t}_exchange_rate", p + "total_value_exchange_rates_rate") for t, p in B.ITEMS.items()),
    ("award", GRAINS["fact_award"], B.AWARDS + "value_currency", "award_value_exchange_rate", B.AWARDS + "value_exchange_rates_rate"),
    ("contract", GRAINS["fact_contract"], B.CONTRACTS + "value_currency", "contract_value_exchange_rate", B.CONTRACTS + "value_exchange_rates_rate"),
)


def _long(row: DataFrame, group: str, subject: str) -> DataFrame:
    """One row of counts as (metric_group, subject, metric, value)."""
    cells = F.array(*(F.struct(F.lit(group).alias("metric_group"), F.lit(subject).alias("subject"), F.lit(c).alias("metric"), F.coalesce(F.col(c), F.lit(0)).cast("decimal(38,4)").alias("value")) for c in row.columns))
    return row.select(F.inline(cells))


def _amounts(t: Mapping[str, DataFrame], subject: str, header: str, items: str, keys: list[str], amount: str, item_amount: str) -> DataFrame:
    rows = R.child_sums(t[header].select(*keys, F.col(amount).alias("_amount")), t[items].select(*keys, F.col(item_amount).alias("_item")), keys, "_amount", "_item")
    off = F.abs(F.col("header_item_difference"))
    n = F.count(F.lit(1))
    return _long(rows.agg(n.alias("parent_rows"), F.count("header_item_difference").alias("comparable_rows"), F.count_if(off == 0).alias("exact"), F.count_if("is_reconciled").alias("within_0_01"), F.count_if(off > F.lit(X.TOLERANCE).cast("decimal(10,4)")).alias("mismatches_over_0_01"), F.max(off).alias("largest_difference")), "amounts", subject)


def _attribution(t: Mapping[str, DataFrame]) -> DataFrame:
    keys = ["ocid", B.AWARDS + "id"]
    counts = t["award_supplier"].groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    rows = t["award"].select(*keys).join(counts, keys, "left").select(F.coalesce("_n", F.lit(0)).alias("n"))
    one = rows.agg(F.count_if(F.col("n") == 0).alias("without_supplier"), F.count_if(F.col("n") == 1).alias("with_one_supplier"), F.count_if(F.col("n") > 1).alias("with_several_suppliers"), F.max("n").alias("most_suppliers"))
    award_id = B.CONTRACTS + "award_id"
    named = t["contract"].select("ocid", F.col(award_id).alias(B.AWARDS + "id")).dropna().join(counts, keys, "left_semi")
    return _long(one, "attribution", "award").unionByName(_long(named.agg(F.count(F.lit(1)).alias("with_supplier")), "attribution", "contract"))


def _rates(t: Mapping[str, DataFrame], subject: str, keys: list[str], currency: str, rates: str, rate: str) -> DataFrame:
    """As ``rate_coverage``; a rate under a parent in home currency, or under none, would be an unsupported conversion only if one were made of it."""
    return _long(R.rate_coverage(t[subject].select(*keys, F.col(currency).alias("_c")), t[rates].filter(F.col(rate).isNotNull()), keys, "_c"), "rates", subject)


def metrics(t: Mapping[str, DataFrame]) -> DataFrame:
    """metric_group, subject, metric, value: grains, references, cardinalities, attribution, amounts, rates and warnings of the typed tables."""
    parts = [_long(R.grain_metrics(t[B.SOURCES[name]], grain), "grain", name) for name, grain in GRAINS.items()]
    found = G.references(t, LINKS)
    parts.append(found.select(F.lit("references").alias("metric_group"), F.col("relation").alias("subject"), F.lit("orphan_keys").alias("metric"), F.col("orphan_keys").cast("decimal(38,4)").alias("value")))
    parts += [_long(R.cardinality(t[f"{name}_classification"], GRAINS[f"fact_{name}"]).drop("median"), "cardinality", f"{name}_classification") for name in B.ITEMS]
    parts.append(_attribution(t))
    parts += [_amounts(t, *spec) for spec in AMOUNTS]
    parts += [_rates(t, *(spec[0], spec[1], spec[2], spec[3], spec[4])) for spec in RATES]
    names = t["party"].filter(X.role_matches(F.col(B.PARTIES + "roles"), "tenderer|supplier")).groupBy(B.PARTIES + "id").agg(F.count_distinct(B.PARTIES + "identifier_legal_name").alias("n"))
    parts.append(_long(names.agg(F.count_if(F.col("n") > 1).alias("name_conflicts")), "warnings", "supplier"))
    observed = t["tenderer"].groupBy("ocid").agg(F.count(F.lit(1)).alias("_observed"))
    declared = t["procurement_process"].select("ocid", F.col(B.TENDER + "number_of_tenderers").alias("_declared")).dropna().join(observed, "ocid")  # both are known
    parts.append(_long(declared.agg(F.count_if(F.col("_declared") != F.col("_observed")).alias("count_differences")), "warnings", "tenderer"))
    return reduce(DataFrame.unionByName, parts)


def gates(found: DataFrame) -> DataFrame:
    """gate_id, status, violations of the six gates, from ``metrics``.

    Attribution invents nothing as long as no amount is given to one of several suppliers, and
    conversion nothing as long as no rate is applied where none is known; both hold by the way the
    facts are built, so that what the gates count there is what the metrics would show against it.
    """
    value = lambda group, names: F.coalesce(F.sum(F.when((F.col("metric_group") == group) & F.col("metric").isin(*names), F.col("value"))), F.lit(0))
    most = F.coalesce(F.max(F.when((F.col("metric_group") == "cardinality") & (F.col("metric") == "most"), F.col("value"))), F.lit(0))
    awards = F.col("metric_group") == "attribution"
    several = F.sum(F.when(awards & F.col("metric").isin("without_supplier", "with_one_supplier", "with_several_suppliers"), F.col("value")))
    rows = F.sum(F.when((F.col("metric_group") == "amounts") & (F.col("subject") == "award") & (F.col("metric") == "parent_rows"), F.col("value")))
    counts = {
        "DM-GRAIN-001": value("grain", ["null_grain_rows", "duplicate_grain_rows"]),
        "DM-REF-001": value("references", ["orphan_keys"]),
        "DM-CAT-001": F.greatest(most - 1, F.lit(0)),
        "DM-SUP-001": F.abs(F.coalesce(several, F.lit(0)) - F.coalesce(rows, F.lit(0))),
        "DM-AMT-001": value("amounts", ["parent_rows"]) - value("amounts", ["comparable_rows"]),
        "DM-RATE-001": value("rates", ["foreign_rows"]) - value("rates", ["with_rate"]) - value("rates", ["without_rate"]),
    }
    row = found.agg(*(c.cast("bigint").alias(g) for g, c in counts.items()))
    return row.select(F.inline(F.array(*(F.struct(F.lit(g).alias("gate_id"), F.when(F.col(f"`{g}`") == 0, "PASS").otherwise("FAIL").alias("status"), F.col(f"`{g}`").alias("violations")) for g in GATES))))
