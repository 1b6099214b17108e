"""The constellation from typed tables: eight dimensions, six facts and two bridges.

A table says which others it needs; ``build`` orders them, writes each once and hands what was
written to all that need it, so that a dimension is computed once however many facts look it
up. Facts and bridges keep the nine lineage columns of the row that they are made of, and
dimensions the first and last period and one run that observed them. Items and headers inherit the keys of their
process; awards, their items, and contracts by way of ``award_id`` inherit the one supplier, where there is one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import exprs as X
from ledgerloom.operators import relational as R
from ledgerloom.sources.scratch import held, written

from . import warehouse as W
from .validation import rules

# Names of typed tables, columns and results that are the contract of the data.
LINEAGE = ("source_id", "source_period", "snapshot_date", "ingestion_run_id", "source_file_name", "source_file_sha256", "source_table_name", "source_row_number", "loaded_at_utc")
CR = "compiled_release_"
TENDER, AWARDS, CONTRACTS, PARTIES = CR + "tender_", CR + "awards_", CR + "contracts_", CR + "parties_"
ITEMS = {"tender_item": TENDER + "items_", "award_item": AWARDS + "items_", "contract_item": CONTRACTS + "items_"}
#: (table, start of its currency columns)
CURRENCIES = (
    ("procurement_process", TENDER + "value_currency"),
    ("procurement_process", CR + "planning_budget_amount_currency"),
    ("tender_item", TENDER + "items_total_value_currency"),
    ("award", AWARDS + "value_currency"),
    ("award_item", AWARDS + "items_total_value_currency"),
    ("contract", CONTRACTS + "value_currency"),
    ("contract_item", CONTRACTS + "items_total_value_currency"),
)
NOBODY = "Desconocido"


def _observed(rows: DataFrame, keys: Sequence[str], **more: Column) -> DataFrame:
    return rows.groupBy(*keys).agg(F.min("source_period").alias("first_observed_period"), F.max("source_period").alias("last_observed_period"), F.max("ingestion_run_id").alias("canonical_ingestion_run_id"), *(c.alias(n) for n, c in more.items()))


Frames = Mapping[str, DataFrame]


def _distinct(rows: DataFrame) -> DataFrame:
    """The different rows with their number ``_n``, written: what is found in few keys of very many rows is found in these."""
    return written(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n")))


def dim_date(t: Frames) -> DataFrame:
    """All local days from the first to the last time of processes, awards and contracts."""
    found = [(t[name], c) for name in ("procurement_process", "award", "contract") for c, kind in t[name].dtypes if kind == "timestamp" and c != "loaded_at_utc"]
    return W.dim_date(t["procurement_process"].sparkSession, [df for df, _ in found], [c for _, c in found])


def dim_process(t: Frames) -> DataFrame:
    names = {
        "compiled_release_id": CR + "id", "tender_id": TENDER + "id", "tender_title": TENDER + "title", "tender_description": TENDER + "description",
        "initiation_type": CR + "initiation_type", "main_procurement_category": TENDER + "main_procurement_category", "additional_procurement_categories": TENDER + "additional_procurement_categories",
        "data_segmentation_id": CR + "data_segmentation_id", "data_segmentation_criteria": CR + "data_segmentation_criteria",
        "first_observed_period": "source_period", "last_observed_period": "source_period", "canonical_ingestion_run_id": "ingestion_run_id",
    }
    rows = t["procurement_process"].select("ocid", *(F.col(c).alias(n) for n, c in names.items()))
    return R.with_unknown(R.dimension_keys(R.asserted_unique(rows, ["ocid"], "a process occurs twice"), ["ocid"], "process_key"), "process_key", {"ocid": X.UNKNOWN})


def _dim_party(rows: DataFrame, key: str, more: Mapping[str, str]) -> DataFrame:
    natural, legal = PARTIES + "id", PARTIES + "identifier_legal_name"
    values = {"identifier_scheme": PARTIES + "identifier_scheme", "identifier_id": PARTIES + "identifier_id", "display_name": PARTIES + "name", "legal_name": legal, "country_name_raw": PARTIES + "address_country_name", **more}
    rows = rows.filter(F.col(natural).isNotNull())
    seen = _observed(rows, [natural], name_variant_count=F.count_distinct(legal)).withColumn("dq_name_conflict", F.col("name_variant_count") > 1)
    found = seen.drop("canonical_ingestion_run_id").join(R.canonical_values(rows, [natural], {**values, "canonical_ingestion_run_id": "ingestion_run_id"}), natural, "left")
    unknown = {"source_party_id": X.UNKNOWN, "display_name": NOBODY, "legal_name": NOBODY, "name_variant_count": 0, "dq_name_conflict": False}
    return R.with_unknown(R.dimension_keys(found.withColumnRenamed(natural, "source_party_id"), ["source_party_id"], key), key, unknown)


def dim_buyer(t: Frames) -> DataFrame:
    """Parties in the role of a buyer, with their alternate identifier of the home scheme."""
    rows = t["party"].filter(X.role_matches(F.col(PARTIES + "roles"), "buyer"))
    more = t["party_additional_identifier"].filter(F.col(PARTIES + "additional_identifiers_scheme") == "PE-RUC")
    more = more.select("ocid", PARTIES + "id", F.col(PARTIES + "additional_identifiers_id").alias("alternate_ruc"))
    rows = R.join_one_to_one(rows, more, ["ocid", PARTIES + "id"])
    places = {"alternate_ruc": "alternate_ruc", "department_name_raw": PARTIES + "address_department", "province_name_raw": PARTIES + "address_region", "locality_name_raw": PARTIES + "address_locality"}
    return _dim_party(rows, "buyer_key", places)


def dim_supplier(t: Frames) -> DataFrame:
    rows = t["party"].filter(X.role_matches(F.col(PARTIES + "roles"), "tenderer|supplier"))
    return _dim_party(rows, "supplier_key", {"dq_ruc_format_valid": "dq_ruc_format_valid"})


def dim_category(t: Frames) -> DataFrame:
    """Own and additional classifications of all items; what is missing or unclassified is member 0."""
    code, text, scheme = X.UNCLASSIFIED
    parts = []
    for table, prefix in ITEMS.items():
        for name, part in ((table, prefix + "classification_"), (f"{table}_classification", prefix + "additional_classifications_")):
            s, c, d = (F.col(part + x) for x in ("scheme", "id", "description"))
            missing = F.coalesce(F.col("dq_classification_was_missing"), F.lit(False)) | s.isNull() | c.isNull()
            pick = lambda column, token: F.when(missing, token).otherwise(column)  # noqa: B023, E731
            parts.append(t[name].select(pick(s, scheme).alias("classification_scheme"), pick(c, code).alias("classification_code"), pick(d, text).alias("description"), "source_period", "ingestion_run_id"))
    rows, keys = _distinct(reduce(DataFrame.unionByName, parts)), ["classification_scheme", "classification_code"]
    seen = _observed(rows, keys, description_variant_count=F.count_distinct("description")).withColumn("dq_description_conflict", F.col("description_variant_count") > 1)
    found = seen.join(R.canonical_values(rows, keys, {"classification_description": "description"}, "_n"), keys, "left")
    known = R.dimension_keys(found.filter((F.col(keys[0]) != scheme) | (F.col(keys[1]) != code)), keys, "category_key")
    return R.with_unknown(known, "category_key", {keys[0]: scheme, keys[1]: code, "classification_description": text, "description_variant_count": 1, "dq_description_conflict": False})


METHOD = [TENDER + "procurement_method", TENDER + "procurement_method_details"]


def _method(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(X.UNKNOWN))


def dim_procurement_method(t: Frames) -> DataFrame:
    rows = t["procurement_process"].select(_method(METHOD[0]).alias("procurement_method"), _method(METHOD[1]).alias("procurement_method_details"), "source_period", "ingestion_run_id")
    keys = ["procurement_method", "procurement_method_details"]
    found = _observed(rows.filter(reduce(lambda a, b: a | b, (F.col(k) != X.UNKNOWN for k in keys))), keys)
    return R.with_unknown(R.dimension_keys(found, keys, "procurement_method_key"), "procurement_method_key", dict.fromkeys(keys, X.UNKNOWN))


def _of_union(parts: Iterable[DataFrame], keys: Sequence[str], name: str, key: str) -> DataFrame:
    rows = _distinct(reduce(DataFrame.unionByName, parts).dropna(subset=list(keys)))
    found = _observed(rows, keys).join(R.canonical_values(rows, keys, {name: name}, "_n"), list(keys), "left")
    return R.with_unknown(R.dimension_keys(found, keys, key), key, {**dict.fromkeys(keys, X.UNKNOWN), name: NOBODY})


def dim_currency(t: Frames) -> DataFrame:
    parts = (t[table].select(F.col(c).alias("currency_code"), F.col(f"{c}_name").alias("currency_name"), "source_period", "ingestion_run_id") for table, c in CURRENCIES)
    return _of_union(parts, ["currency_code"], "currency_name", "currency_key")


def dim_unit(t: Frames) -> DataFrame:
    parts = (t[table].select(F.col(p + "unit_scheme").alias("unit_scheme"), F.col(p + "unit_id").alias("unit_code"), F.col(p + "unit_name").alias("unit_name"), "source_period", "ingestion_run_id") for table, p in ITEMS.items())
    return _of_union(parts, ["unit_scheme", "unit_code"], "unit_name", "unit_key")


def process_context(t: Frames) -> DataFrame:
    """ocid with the keys that all facts of lower grains take from their process."""
    rows = t["procurement_process"].select("ocid", F.col(CR + "buyer_id").alias("_buyer"), *(_method(c).alias(f"_m{i}") for i, c in enumerate(METHOD)), X.date_key(F.col(TENDER + "date_published")).alias("tender_published_date_key"))
    rows = R.lookup_key(rows, t["dim_process"], {"ocid": "ocid"}, "process_key")
    rows = R.lookup_key(rows, t["dim_buyer"], {"_buyer": "source_party_id"}, "buyer_key")
    rows = R.lookup_key(rows, t["dim_procurement_method"], {"_m0": "procurement_method", "_m1": "procurement_method_details"}, "procurement_method_key")
    return rows.drop("_buyer", "_m0", "_m1")


ATTRIBUTED = ("attributed_supplier_key", "dq_supplier_amount_attributable")


def attribution(t: Frames) -> DataFrame:
    """For each award: how many supplier rows it has, and the key of its only supplier where there is one, else 0."""
    rows = t["award_supplier"].select("ocid", F.col(AWARDS + "id").alias("award_id"), F.col(AWARDS + "suppliers_id").alias("_supplier")).dropna(subset=["ocid", "award_id"])
    # Suppliers are looked up before they are grouped: the most of a number needs no sort.
    rows = R.lookup_key(rows, t["dim_supplier"], {"_supplier": "source_party_id"}, "supplier_key")
    found = rows.groupBy("ocid", "award_id").agg(F.count(F.lit(1)).alias("supplier_count"), F.max("supplier_key").alias("supplier_key"))
    found = found.withColumn("supplier_key", F.when(F.col("supplier_count") == 1, F.col("supplier_key")).otherwise(0))
    return found.select("ocid", "award_id", "supplier_count", F.col("supplier_key").alias(ATTRIBUTED[0]), (F.col("supplier_key") != 0).alias(ATTRIBUTED[1]))


def _inherited(rows: DataFrame, t: Frames) -> DataFrame:
    context = t["process_context"]
    return R.join_to_one(rows, context, ["ocid"]).fillna(0, [c for c in context.columns if c != "ocid"])


def _attributed(rows: DataFrame, t: Frames, award_id: str) -> DataFrame:
    side = t["attribution"].withColumnRenamed("award_id", award_id)
    return R.join_to_one(rows, side, ["ocid", award_id]).fillna(0, ["supplier_count", ATTRIBUTED[0]]).fillna(False, [ATTRIBUTED[1]])


def _numbered(rows: DataFrame, grain: Sequence[str], key: str, keyed: bool) -> DataFrame:
    return R.dense_keys(rows, grain, key) if keyed else rows.withColumn(key, F.lit(None).cast("bigint"))


def _grains(t: Frames, table: str, grain: Sequence[str], key: str, rates: str, rate: str, keyed: bool = True) -> DataFrame:
    """The grains of a typed table, each once or the build raises, with their number in order and their ``_rate``.

    A fact's numbers, rates and sums meet in these rows, which are narrow; the wide rows of
    its table are neither counted nor sorted and join them once, see ``_with_grains``.
    """
    each = R.asserted_unique(t[table].select(*grain), grain, f"join is not one-to-one on {', '.join(grain)}")
    return R.join_to_one(_numbered(each, grain, key, keyed), t[rates].select(*grain, F.col(rate).alias("_rate")), grain)


def _with_grains(rows: DataFrame, grains: DataFrame, grain: Sequence[str]) -> DataFrame:
    """``rows`` with the further columns of their grain; null equals null."""
    side = grains.select(*(F.col(k).alias(f"_g{i}") for i, k in enumerate(grain)), *(c for c in grains.columns if c not in grain))
    same = reduce(lambda a, b: a & b, (rows[k].eqNullSafe(side[f"_g{i}"]) for i, k in enumerate(grain)))
    return rows.join(side, same).drop(*(f"_g{i}" for i in range(len(grain))))


def _in_home_currency(rows: DataFrame, t: Frames, currency: str, amount: str, result: str) -> DataFrame:
    """Adds currency_key, conversion_rate_to_pen, the amount converted at ``_rate`` and whether there is one."""
    rows = R.lookup_key(rows, t["dim_currency"], {currency: "currency_code"}, "currency_key")
    rows = rows.withColumn("conversion_rate_to_pen", X.rate_for(F.col(currency), F.col("_rate")))
    rows = rows.withColumn(result, X.converted(F.col(amount), F.col("conversion_rate_to_pen")))
    return rows.withColumn("dq_pen_conversion_available", F.col(result).isNotNull())


def _with_sums(rows: DataFrame, items: DataFrame, grain: Sequence[str], item_amount: str, stem: str) -> DataFrame:
    """Adds the sum of the items' amounts."""
    sums = items.groupBy(*grain).agg(F.sum(F.col(item_amount).cast(X.MONEY)).cast(X.MONEY).alias(f"{stem}_item_amount_sum_original")).dropna(subset=list(grain))
    return rows.join(sums, list(grain), "left")


def _compared(rows: DataFrame, amount: str, stem: str) -> DataFrame:
    """Adds the difference of the header to the sum of its items and whether they agree."""
    rows = rows.withColumn(f"{stem}_amount_difference_original", X.difference(F.col(amount), F.col(f"{stem}_item_amount_sum_original")))
    return rows.withColumn(f"dq_{stem}_amount_reconciled_0_01", X.within(F.col(f"{stem}_amount_difference_original")))


def _keyed(rows: DataFrame, grain: Sequence[str], key: str, columns: Sequence[str | Column], keyed: bool = True) -> DataFrame:
    """Numbered in the order of the grain and cut to the fact's columns, lineage last."""
    return _cut(_numbered(rows, grain, key, keyed), key, columns)


def _cut(rows: DataFrame, key: str, columns: Sequence[str | Column]) -> DataFrame:
    return rows.select(F.col(key).cast("bigint").alias(key), *columns, *LINEAGE)


def fact_procurement_process(t: Frames, keyed: bool = True) -> DataFrame:
    rows = _inherited(t["procurement_process"], t)
    currencies = {"tender_currency_key": TENDER + "value_currency", "budget_currency_key": CR + "planning_budget_amount_currency"}
    for alias, c in currencies.items():
        rows = R.lookup_key(rows, t["dim_currency"], {c: "currency_code"}, "currency_key", alias)
    dates = {"record_date_key": CR + "date", "published_date_key": CR + "published_date", **{f"{x}_date_key": f"{TENDER}{p}_{x.rpartition('_')[2]}_date" for x, p in (("tender_period_start", "tender_period"), ("tender_period_end", "tender_period"), ("enquiry_period_start", "enquiry_period"), ("enquiry_period_end", "enquiry_period"))}}
    observed = t["tenderer"].groupBy("ocid").agg(F.count(F.lit(1)).alias("tenderer_count_observed"))
    rows = rows.join(observed, "ocid", "left").fillna(0, ["tenderer_count_observed"])
    rows = _compared(_with_sums(rows, t["tender_item"], ["ocid"], TENDER + "items_total_value_amount", "tender"), TENDER + "value_amount", "tender")
    declared = F.col(TENDER + "number_of_tenderers")
    columns = [
        "process_key", "buyer_key", "procurement_method_key", *currencies, "tender_published_date_key", *(X.date_key(F.col(c)).alias(a) for a, c in dates.items()), F.lit(1).alias("process_count"),
        F.col(CR + "planning_budget_amount_amount").alias("planning_budget_amount_original"), F.col(TENDER + "value_amount").alias("tender_amount_original"), F.col(TENDER + "value_amount_pen").alias("tender_amount_pen_published"),
        declared.alias("tenderer_count_declared"), "tenderer_count_observed", "tender_item_amount_sum_original", "tender_amount_difference_original",
        F.coalesce("dq_tender_value_is_zero", F.lit(False)).alias("dq_tender_value_is_zero"), F.coalesce(declared == F.col("tenderer_count_observed"), F.lit(False)).alias("dq_tenderer_count_matches_observed"), "dq_tender_amount_reconciled_0_01",
    ]
    return _keyed(rows, ["ocid"], "procurement_process_fact_key", columns, keyed)


def fact_award(t: Frames, keyed: bool = True) -> DataFrame:
    grain, amount = ["ocid", AWARDS + "id"], AWARDS + "value_amount"
    grains = _grains(t, "award", grain, "award_fact_key", "award_value_exchange_rate", AWARDS + "value_exchange_rates_rate", keyed)
    grains = _attributed(_with_sums(grains, t["award_item"], grain, AWARDS + "items_total_value_amount", "award"), t, AWARDS + "id")
    rows = _with_grains(_inherited(t["award"], t), grains, grain)
    rows = _compared(_in_home_currency(rows, t, AWARDS + "value_currency", amount, "award_amount_pen_calculated"), amount, "award")
    columns = [
        "process_key", "buyer_key", "procurement_method_key", ATTRIBUTED[0], "currency_key", X.date_key(F.col(AWARDS + "date")).alias("award_date_key"), F.col(AWARDS + "id").alias("award_id"), F.lit(1).alias("award_count"),
        F.col(amount).alias("award_amount_original"), "conversion_rate_to_pen", "award_amount_pen_calculated", "supplier_count", "award_item_amount_sum_original", "award_amount_difference_original",
        ATTRIBUTED[1], "dq_pen_conversion_available", "dq_award_amount_reconciled_0_01",
    ]
    return _cut(rows, "award_fact_key", columns)


def fact_contract(t: Frames, keyed: bool = True) -> DataFrame:
    grain, amount = ["ocid", CONTRACTS + "id"], CONTRACTS + "value_amount"
    grains = _grains(t, "contract", grain, "contract_fact_key", "contract_value_exchange_rate", CONTRACTS + "value_exchange_rates_rate", keyed)
    grains = _with_sums(grains, t["contract_item"], grain, CONTRACTS + "items_total_value_amount", "contract")
    rows = _with_grains(_attributed(_inherited(t["contract"], t), t, CONTRACTS + "award_id"), grains, grain)
    rows = _compared(_in_home_currency(rows, t, CONTRACTS + "value_currency", amount, "contract_amount_pen_calculated"), amount, "contract")
    dates = {"contract_signed_date_key": "date_signed", "contract_period_start_date_key": "period_start_date", "contract_period_end_date_key": "period_end_date", "implementation_end_date_key": "implementation_end_date"}
    columns = [
        "process_key", "buyer_key", "procurement_method_key", ATTRIBUTED[0], "currency_key", *(X.date_key(F.col(CONTRACTS + c)).alias(a) for a, c in dates.items()),
        F.col(CONTRACTS + "id").alias("contract_id"), F.col(CONTRACTS + "award_id").alias("award_id"), F.col(CONTRACTS + "title").alias("contract_title"), F.col(CONTRACTS + "description").alias("contract_description"), F.lit(1).alias("contract_count"),
        F.col(amount).alias("contract_amount_original"), "conversion_rate_to_pen", "contract_amount_pen_calculated", F.col(CONTRACTS + "period_duration_in_days").alias("contract_duration_days"),
        F.col(CONTRACTS + "implementation_final_value_amount").alias("final_value_original"), "contract_item_amount_sum_original", "contract_amount_difference_original",
        F.coalesce("dq_final_value_available", F.lit(False)).alias("dq_final_value_available"), ATTRIBUTED[1], "dq_pen_conversion_available", "dq_contract_amount_reconciled_0_01",
    ]
    return _cut(rows, "contract_fact_key", columns)


def _fact_item(t: Frames, table: str, parent_id: str | None, prepared: Callable[[DataFrame], DataFrame], columns: Sequence[str | Column], tail: Sequence[str], key: str, keyed: bool) -> DataFrame:
    prefix = ITEMS[table]
    grain = ["ocid", *([parent_id] if parent_id else []), prefix + "id"]
    amount, category = prefix + "total_value_amount", ("classification_scheme", "classification_code")
    grains = _grains(t, table, grain, key, f"{table}_exchange_rate", prefix + "total_value_exchange_rates_rate", keyed)
    more = t[f"{table}_classification"].select(*grain, *(F.col(prefix + f"additional_classifications_{c}").alias(f"_{c}") for c in ("scheme", "id")))
    more = R.lookup_key(more, t["dim_category"], dict(zip(("_scheme", "_id"), category)), "category_key", "standard_category_key").drop("_scheme", "_id")
    grains = R.join_to_one(grains, more, grain).fillna(0, ["standard_category_key"])
    rows = _with_grains(prepared(_inherited(t[table], t)), grains, grain)
    rows = _in_home_currency(rows, t, prefix + "total_value_currency", amount, "total_amount_pen_calculated")
    rows = R.lookup_key(rows, t["dim_category"], dict(zip((prefix + "classification_scheme", prefix + "classification_id"), category)), "category_key", "primary_category_key")
    rows = R.lookup_key(rows, t["dim_unit"], {prefix + "unit_scheme": "unit_scheme", prefix + "unit_id": "unit_code"}, "unit_key")
    missing = F.coalesce("dq_classification_was_missing", F.lit(False))
    out = [
        "process_key", "buyer_key", *columns[:1], "primary_category_key", "standard_category_key", "unit_key", "currency_key", *columns[1:], *(F.col(prefix + c).alias(f"item_{c}") for c in ("position", "description", "status", "status_details")),
        F.lit(1).alias(f"{table}_count"), F.col(prefix + "quantity").alias("quantity"), F.col(amount).alias("total_amount_original"), "conversion_rate_to_pen", "total_amount_pen_calculated",
        missing.alias("dq_classification_was_missing"), (F.col("standard_category_key") == 0).alias("dq_standard_category_missing"), *tail, "dq_pen_conversion_available",
    ]
    return _cut(rows, key, out)


def fact_tender_item(t: Frames, keyed: bool = True) -> DataFrame:
    columns = ["procurement_method_key", "tender_published_date_key", F.col(TENDER + "items_id").alias("tender_item_id")]
    return _fact_item(t, "tender_item", None, lambda rows: rows, columns, [], "tender_item_fact_key", keyed)


def fact_award_item(t: Frames, keyed: bool = True) -> DataFrame:
    parents = t["award"].select("ocid", AWARDS + "id", F.col(AWARDS + "date").alias("_date"))
    columns = [ATTRIBUTED[0], X.date_key(F.col("_date")).alias("award_date_key"), F.col(AWARDS + "id").alias("award_id"), F.col(AWARDS + "items_id").alias("award_item_id")]
    return _fact_item(t, "award_item", AWARDS + "id", lambda rows: R.join_to_one(_attributed(rows, t, AWARDS + "id"), parents, ["ocid", AWARDS + "id"]), columns, [ATTRIBUTED[1]], "award_item_fact_key", keyed)


def fact_contract_item(t: Frames, keyed: bool = True) -> DataFrame:
    """Items of contracts; their supplier is that of the award which the contract names."""
    parents = t["contract"].select("ocid", CONTRACTS + "id", F.col(CONTRACTS + "award_id").alias("_award_id"), F.col(CONTRACTS + "date_signed").alias("_date"))
    parents = _attributed(parents, t, "_award_id").select("ocid", CONTRACTS + "id", "_date", *ATTRIBUTED)
    columns = [ATTRIBUTED[0], X.date_key(F.col("_date")).alias("contract_signed_date_key"), F.col(CONTRACTS + "id").alias("contract_id"), F.col(CONTRACTS + "items_id").alias("contract_item_id")]
    prepared = lambda rows: R.join_to_one(rows, parents, ["ocid", CONTRACTS + "id"]).fillna(0, ATTRIBUTED[:1]).fillna(False, ATTRIBUTED[1:])
    return _fact_item(t, "contract_item", CONTRACTS + "id", prepared, columns, [ATTRIBUTED[1]], "contract_item_fact_key", keyed)


def _bridge(t: Frames, table: str, supplier: str, grain: Sequence[str], columns: Sequence[Column], key: str) -> DataFrame:
    rows = R.lookup_key(t[table], t["dim_process"], {"ocid": "ocid"}, "process_key")
    rows = R.lookup_key(rows, t["dim_supplier"], {supplier: "source_party_id"}, "supplier_key")
    return _keyed(rows, grain, key, ["process_key", "supplier_key", *columns, F.lit(1).alias("participation_count")])


def bridge_process_tenderer(t: Frames) -> DataFrame:
    supplier = TENDER + "tenderers_id"
    return _bridge(t, "tenderer", supplier, ["ocid", supplier], [], "process_tenderer_bridge_key")


def bridge_award_supplier(t: Frames) -> DataFrame:
    supplier = AWARDS + "suppliers_id"
    return _bridge(t, "award_supplier", supplier, ["ocid", AWARDS + "id", supplier], [F.col(AWARDS + "id").alias("award_id")], "award_supplier_bridge_key")


@dataclass(frozen=True)
class Table:
    """How a table is built, and from which other built tables."""

    kind: str
    build: Callable[..., DataFrame]
    needs: tuple[str, ...] = ()


_LOOKED_UP = ("process_context", "dim_currency", "dim_category", "dim_unit")
#: In the order in which they are loaded; contexts are shared parts and no tables of the warehouse.
TABLES: dict[str, Table] = {
    "dim_date": Table("dimension", dim_date),
    "dim_process": Table("dimension", dim_process),
    "dim_buyer": Table("dimension", dim_buyer),
    "dim_supplier": Table("dimension", dim_supplier),
    "dim_category": Table("dimension", dim_category),
    "dim_procurement_method": Table("dimension", dim_procurement_method),
    "dim_currency": Table("dimension", dim_currency),
    "dim_unit": Table("dimension", dim_unit),
    "process_context": Table("context", process_context, ("dim_process", "dim_buyer", "dim_procurement_method")),
    "attribution": Table("context", attribution, ("dim_supplier",)),
    "fact_procurement_process": Table("fact", fact_procurement_process, ("process_context", "dim_currency")),
    "fact_tender_item": Table("fact", fact_tender_item, _LOOKED_UP),
    "fact_award": Table("fact", fact_award, ("process_context", "attribution", "dim_currency")),
    "fact_award_item": Table("fact", fact_award_item, (*_LOOKED_UP, "attribution")),
    "fact_contract": Table("fact", fact_contract, ("process_context", "attribution", "dim_currency")),
    "fact_contract_item": Table("fact", fact_contract_item, (*_LOOKED_UP, "attribution")),
    "bridge_process_tenderer": Table("bridge", bridge_process_tenderer, ("dim_process", "dim_supplier")),
    "bridge_award_supplier": Table("bridge", bridge_award_supplier, ("dim_process", "dim_supplier")),
}


@dataclass(frozen=True)
class Warehouse:
    tables: dict[str, DataFrame]

    def of(self, kind: str) -> dict[str, DataFrame]:
        return {name: df for name, df in self.tables.items() if TABLES[name].kind == kind}

    def row_counts(self) -> DataFrame:
        """table_name, n."""
        parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in self.tables.items()]
        return reduce(DataFrame.unionByName, parts)


def build(silver: Mapping[str, DataFrame], only: Sequence[str] | None = None, columns: Mapping[str, Sequence[str]] | None = None) -> Warehouse:
    """The warehouse from the typed tables, or the named tables of it with all that they need.

    ``columns`` names facts of which no more than some columns are wanted, with these: what the
    others alone need is neither computed nor written, and a fact whose number is not wanted
    is not sorted. All its rows are there.
    """
    columns = columns or {}
    wanted, stack = set(), list(only or TABLES)
    while stack:
        name = stack.pop()
        if name not in wanted:
            wanted.add(name)
            stack += TABLES[name].needs
    frames: dict[str, DataFrame] = dict(silver)
    for name in TopologicalSorter({n: TABLES[n].needs for n in TABLES if n in wanted}).static_order():
        if name in columns:
            key = f"{name.removeprefix('fact_')}_fact_key"
            frames[name] = held(TABLES[name].build(frames, key in columns[name]).select(*columns[name]))
        else:
            frames[name] = held(TABLES[name].build(frames))
    return Warehouse({n: frames[n] for n in TABLES if n in wanted and TABLES[n].kind != "context"})


#: Fact or bridge, and the typed table of which it has a row for each row.
SOURCES = {
    "fact_procurement_process": "procurement_process", "fact_tender_item": "tender_item", "fact_award": "award", "fact_award_item": "award_item",
    "fact_contract": "contract", "fact_contract_item": "contract_item", "bridge_process_tenderer": "tenderer", "bridge_award_supplier": "award_supplier",
}
SURROGATES = {"dim_date": "date_key", "dim_process": "process_key", "dim_buyer": "buyer_key", "dim_supplier": "supplier_key", "dim_category": "category_key", "dim_procurement_method": "procurement_method_key", "dim_currency": "currency_key", "dim_unit": "unit_key"}


def check_build(built: Warehouse, silver: Mapping[str, DataFrame]) -> DataFrame:
    """rule_id, subject, violations of a whole build: its tables, rows against their typed tables, member 0, bridges' keys and columns."""
    spark = next(iter(silver.values())).sparkSession
    names = [n for n in TABLES if TABLES[n].kind != "context"]
    parts = [spark.range(1).select(F.lit("WH-TABLES").alias("rule_id"), F.lit("all").alias("subject"), F.lit(len(set(names) ^ set(built.tables)) + (list(built.tables) != [n for n in names if n in built.tables])).cast("bigint").alias("violations"))]
    counted = built.row_counts()
    expected = reduce(DataFrame.unionByName, (silver[s].agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, s in SOURCES.items()))
    compared = R.reconciled(counted.filter(F.col("table_name").isin(*SOURCES)), expected, ["table_name"], ["n"])
    parts.append(compared.select(F.lit("WH-ROWS").alias("rule_id"), F.col("table_name").alias("subject"), (F.col("status") != "PASS").cast("bigint").alias("violations")))
    dims = {n: (df, SURROGATES[n]) for n, df in built.of("dimension").items()}
    return rules([*parts, W.check_warehouse(dims, built.of("bridge"))])


def dry_run(silver: Mapping[str, DataFrame]) -> tuple[Warehouse, DataFrame]:
    """Builds and checks without publishing anything: the warehouse, and the checks that did not pass."""
    built = build(silver)
    return built, check_build(built, silver).filter("violations > 0")
