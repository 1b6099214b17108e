"""The governed rules of a built warehouse, and its layers held against each other.

``references`` evaluates all foreign keys in one pass: each table is read once and gives the
keys that it owns and those that it points to; they meet as (key set, key) pairs, counted by
each task before they do. ``evaluate`` runs every rule of ``CATALOG`` over a warehouse; the results are
classified by the catalog, which must be complete.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import exprs as X
from ledgerloom.operators import relational as R

from . import build as B
from . import validation as V
from . import warehouse as W

# Identifiers of the governed rules.
CRITICAL = (
    "SQL-BATCH-001", "SQL-AUDIT-001", "SQL-AUDIT-002", "SQL-DIM-001", "SQL-DIM-002", *(f"SQL-GRAIN-00{i}" for i in range(1, 9)), "SQL-REF-001", "SQL-REF-002",
    "SQL-LINEAGE-001", "SQL-BRIDGE-001", *(f"SQL-BUS-00{i}" for i in range(1, 7)), *(f"SQL-CALC-00{i}" for i in range(1, 5)),
)
WARNINGS = tuple(f"SQL-WARN-{i:03d}" for i in range(1, 12))
GRAINS = {
    "fact_procurement_process": ["process_key"], "fact_tender_item": ["process_key", "tender_item_id"], "fact_award": ["process_key", "award_id"],
    "fact_award_item": ["process_key", "award_id", "award_item_id"], "fact_contract": ["process_key", "contract_id"], "fact_contract_item": ["process_key", "contract_id", "contract_item_id"],
    "bridge_process_tenderer": ["process_key", "supplier_key"], "bridge_award_supplier": ["process_key", "award_id", "supplier_key"],
}
#: End of a key's name, and the dimension that it points to.
ROLES = {"date_key": "dim_date", "currency_key": "dim_currency", "category_key": "dim_category", "supplier_key": "dim_supplier", "process_key": "dim_process", "buyer_key": "dim_buyer", "procurement_method_key": "dim_procurement_method", "unit_key": "dim_unit"}
#: Converted amounts: (fact, amount, converted).
CONVERTED = (
    ("fact_tender_item", "total_amount_original", "total_amount_pen_calculated"),
    ("fact_award", "award_amount_original", "award_amount_pen_calculated"),
    ("fact_award_item", "total_amount_original", "total_amount_pen_calculated"),
    ("fact_contract", "contract_amount_original", "contract_amount_pen_calculated"),
    ("fact_contract_item", "total_amount_original", "total_amount_pen_calculated"),
)
#: Headers: (stem, fact, its items, keys).
HEADERS = (("tender", "fact_procurement_process", "fact_tender_item", ["process_key"]), ("award", "fact_award", "fact_award_item", ["process_key", "award_id"]), ("contract", "fact_contract", "fact_contract_item", ["process_key", "contract_id"]))
#: Controls of amounts: (name, typed table, its currency, its amount, fact, the fact's currency key, the fact's amount).
CONTROLS = (
    ("tender", "procurement_process", B.TENDER + "value_currency", B.TENDER + "value_amount", "fact_procurement_process", "tender_currency_key", "tender_amount_original"),
    ("budget", "procurement_process", B.CR + "planning_budget_amount_currency", B.CR + "planning_budget_amount_amount", "fact_procurement_process", "budget_currency_key", "planning_budget_amount_original"),
    *((t, t, p + "total_value_currency", p + "total_value_amount", f"fact_{t}", "currency_key", "total_amount_original") for t, p in B.ITEMS.items()),
    ("award", "award", B.AWARDS + "value_currency", B.AWARDS + "value_amount", "fact_award", "currency_key", "award_amount_original"),
    ("contract", "contract", B.CONTRACTS + "value_currency", B.CONTRACTS + "value_amount", "fact_contract", "currency_key", "contract_amount_original"),
)


def catalog(spark: SparkSession) -> DataFrame:
    """rule_id, severity of every governed rule."""
    return spark.createDataFrame([(r, "critical") for r in CRITICAL] + [(r, "warning") for r in WARNINGS], "rule_id string, severity string")


def relations(tables: Mapping[str, DataFrame]) -> dict[str, tuple[str, str, dict[str, str]]]:
    """The foreign keys of facts and bridges by the roles of their columns: name to (child, parent, child column to parent column)."""
    out = {}
    for name, df in tables.items():
        for column in df.columns if B.TABLES[name].kind != "dimension" else ():
            for end in sorted(ROLES, key=len, reverse=True):
                if column == end or column.endswith(f"_{end}"):
                    out[f"{name}.{column}"] = (name, ROLES[end], {column: B.SURROGATES[ROLES[end]]})
                    break
    return out


def references(tables: Mapping[str, DataFrame], links: Mapping[str, tuple[str, str, Mapping[str, str]]]) -> DataFrame:
    """relation, rows_evaluated, orphans (rows), orphan_keys (different ones): for each relation (child, parent, child column to parent column).

    Rows with a null in the key are not evaluated. Every table is read once, as owner of keys
    and as child; its pairs are counted by each task before they meet, so a key of very many rows is a row for each task.
    """
    sets = {key: i for i, key in enumerate(dict.fromkeys((parent, tuple(keys.values())) for _, parent, keys in links.values()))}
    # A relation has a place among those of its key set, so that a key needs a number for each place and no list.
    places: dict[str, tuple[int, int]] = {}
    for relation, (_, parent, keys) in links.items():
        of = sets[parent, tuple(keys.values())]
        places[relation] = (of, sum(o == of for o, _ in places.values()))
    parts = []

    def pair(key_set: int, place: int | None, columns: Sequence[str]) -> Column:
        cells = [F.col(f"`{c}`").cast("string") for c in columns]
        return F.when(~X.any_null(cells), F.struct(F.lit(key_set).alias("key_set"), F.lit(place).cast("int").alias("place"), F.xxhash64(*cells).alias("a"), F.xxhash64(F.lit(1), *cells).alias("b")))

    for name, df in tables.items():
        pairs = [pair(of, None, columns) for (parent, columns), of in sets.items() if parent == name]
        pairs += [pair(*places[relation], list(keys)) for relation, (child, _, keys) in links.items() if child == name]
        if pairs:
            parts.append(df.select(F.explode(F.array(*pairs)).alias("p")).filter("p IS NOT NULL").select("p.*"))
    held = range(max((place for _, place in places.values()), default=-1) + 1)
    each = reduce(DataFrame.unionByName, parts).groupBy("key_set", "a", "b").agg(F.max(F.col("place").isNull()).alias("owned"), *(F.count_if(F.col("place") == i).alias(f"n{i}") for i in held))
    lost = ~F.col("owned")
    sums = each.groupBy("key_set").agg(*(c.alias(f"{n}{i}") for i in held for n, c in (("rows", F.sum(f"n{i}")), ("orphans", F.sum(F.when(lost, F.col(f"n{i}")).otherwise(0))), ("keys", F.count_if(lost & (F.col(f"n{i}") > 0))))))
    cells = [F.struct(F.lit(relation).alias("relation"), F.lit(of).alias("of"), *(F.col(f"{n}{i}").alias(c) for n, c in (("rows", "rows_evaluated"), ("orphans", "orphans"), ("keys", "orphan_keys")))) for relation, (of, i) in places.items()]
    rows = sums.select("key_set", F.inline(F.array(*cells))).filter("key_set = of").drop("key_set", "of")
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame([(r,) for r in links], "relation string").join(rows, "relation", "left").fillna(0, ["rows_evaluated", "orphans", "orphan_keys"])


def predicates(tables: Mapping[str, DataFrame], checks: Mapping[str, tuple[str, str]]) -> DataFrame:
    """check, violations: rows for which a predicate (table, SQL) is false; unknown passes, as a CHECK constraint does. One aggregate for each table."""
    parts = []
    for name in dict.fromkeys(t for t, _ in checks.values()):
        own = {c: sql for c, (t, sql) in checks.items() if t == name}
        row = tables[name].agg(*(F.count_if(~F.expr(sql)).alias(f"c{i}") for i, sql in enumerate(own.values())))
        parts.append(row.select(F.inline(F.array(*(F.struct(F.lit(c).alias("check"), F.col(f"c{i}").alias("violations")) for i, c in enumerate(own))))))
    return reduce(DataFrame.unionByName, parts)


#: The nine physical CHECK constraints in the warehouse's own names.
CHECKS = {
    "date_semester": ("dim_date", "semester_number BETWEEN 1 AND 2"),
    "date_quarter": ("dim_date", "quarter_number BETWEEN 1 AND 4"),
    "date_month": ("dim_date", "month_number BETWEEN 1 AND 12"),
    "date_weekday": ("dim_date", "iso_weekday BETWEEN 1 AND 7"),
    "process_count": ("fact_procurement_process", "process_count = 1"),
    "award_count": ("fact_award", "award_count = 1 AND supplier_count >= 0"),
    "contract_count": ("fact_contract", "contract_count = 1"),
    "tenderer_participation": ("bridge_process_tenderer", "participation_count = 1"),
    "supplier_participation": ("bridge_award_supplier", "participation_count = 1"),
}


def _total(rows: DataFrame, column: str, rule_id: str, severity: str = "critical", detail: str = "") -> DataFrame:
    n = F.coalesce(F.sum(column), F.lit(0)).cast("bigint").alias("violations")
    return rows.agg(n).select(F.lit(rule_id).alias("rule_id"), F.lit(severity).alias("severity"), "violations", F.lit(detail).alias("detail"))


def _sum_of(parts: Sequence[DataFrame], rule_id: str, severity: str = "critical", detail: str = "") -> DataFrame:
    """Several rules' critical violations as one rule's."""
    return _total(V.rules(parts).filter(F.col("severity") == severity), "violations", rule_id, severity, detail)


def _unequal(left: DataFrame, right: DataFrame, keys: Sequence[str], pairs: Mapping[str, tuple[str, object]], rule_id: str, kind: str = "left", detail: str = "") -> DataFrame:
    """Rows of ``left`` (or of both sides) whose columns are not those of ``right`` under the same keys; absent ones count as the given value."""
    side = right.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), *(F.col(c).alias(f"_v{i}") for i, (c, _) in enumerate(pairs.values())))
    same = reduce(lambda a, b: a & b, (left[k].eqNullSafe(side[f"_k{i}"]) for i, k in enumerate(keys)))
    wrong = reduce(lambda a, b: a | b, (~F.coalesce(left[c], F.lit(absent)).eqNullSafe(F.coalesce(side[f"_v{i}"], F.lit(absent))) for i, (c, (_, absent)) in enumerate(pairs.items())))
    return V.rule(left.join(side, same, kind), rule_id, "critical", wrong, detail)


def _counted(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def attribution_rules(t: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Participations are those counted in the facts; a supplier is attributed just where there is one, and inherited unchanged."""
    award, contract, (key, flag) = t["fact_award"], t["fact_contract"], B.ATTRIBUTED
    one = (F.col("supplier_count") == 1) & (F.col(key) != 0)
    inherited = {key: (key, 0), flag: (flag, False)}
    return [
        _unequal(t["fact_procurement_process"], _counted(t["bridge_process_tenderer"], ["process_key"]), ["process_key"], {"tenderer_count_observed": ("n", 0)}, "SQL-BUS-001", "full"),
        _unequal(award, _counted(t["bridge_award_supplier"], ["process_key", "award_id"]), ["process_key", "award_id"], {"supplier_count": ("n", 0)}, "SQL-BUS-002", "full"),
        V.rule(award, "SQL-BUS-003", "critical", ~F.col(flag).eqNullSafe(one) | ((F.col(key) != 0) & (F.col("supplier_count") != 1))),
        _unequal(t["fact_award_item"], award, ["process_key", "award_id"], inherited, "SQL-BUS-004"),
        _unequal(contract, award, ["process_key", "award_id"], inherited, "SQL-BUS-005"),
        _unequal(t["fact_contract_item"], contract, ["process_key", "contract_id"], inherited, "SQL-BUS-006"),
    ]


def _with_code(fact: DataFrame, currencies: DataFrame, key: str = "currency_key") -> DataFrame:
    return fact.join(currencies.select(F.col("currency_key").alias("_key"), F.col("currency_code").alias("_code")), F.col(key) == F.col("_key"))


def calculation_rules(t: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Conversions, sums, differences and flags can be calculated again from what they are made of."""
    conversions = [V.conversion_rules(_with_code(t[f], t["dim_currency"]), f, amount, "conversion_rate_to_pen", pen, "_code", "dq_pen_conversion_available") for f, amount, pen in CONVERTED]
    sums = [V.reconciliation_rules(t[fact], stem, f"{stem}_amount_original", f"{stem}_item_amount_sum_original", f"{stem}_amount_difference_original", f"dq_{stem}_amount_reconciled_0_01", t[items], keys, "total_amount_original") for stem, fact, items, keys in HEADERS]
    flags = {"dq_classification_was_missing": "primary_category_key", "dq_standard_category_missing": "standard_category_key"}
    return [
        _sum_of(conversions, "SQL-CALC-001"),
        _sum_of(sums, "SQL-CALC-002"),
        _sum_of([V.category_flag_rule(t[f"fact_{name}"], name, flags) for name in B.ITEMS], "SQL-CALC-003"),
        V.zero_flag_rule(t["fact_procurement_process"], "SQL-CALC-004", "dq_tender_value_is_zero", "tender_amount_original"),
    ]


#: What ``warning_rules`` reads of the facts.
WARNED = {
    "fact_procurement_process": ("tenderer_count_declared", "tenderer_count_observed", "tender_amount_original", "dq_tender_value_is_zero", "dq_tender_amount_reconciled_0_01"),
    "fact_award": ("currency_key", "award_amount_original", "dq_pen_conversion_available", "dq_award_amount_reconciled_0_01"),
    "fact_contract": ("currency_key", "contract_amount_original", "dq_pen_conversion_available", "dq_contract_amount_reconciled_0_01", "dq_final_value_available"),
    **dict.fromkeys(("fact_tender_item", "fact_award_item", "fact_contract_item"), ("currency_key", "total_amount_original", "dq_pen_conversion_available")),
}


def warning_rules(t: Mapping[str, DataFrame]) -> list[DataFrame]:
    amounts = [(f, a) for f, a, _ in CONVERTED] + [("fact_procurement_process", "tender_amount_original")]
    foreign = [V.rule(_with_code(t[f], t["dim_currency"]), f, "warning", (F.col("_code") != "PEN") & F.col(a).isNotNull() & ~F.col("dq_pen_conversion_available")) for f, a, _ in CONVERTED]
    return [
        V.member_rule(t["dim_supplier"], "SQL-WARN-001", "supplier_key", ~F.col("dq_ruc_format_valid"), "identifier format"),
        V.member_rule(t["dim_supplier"], "SQL-WARN-002", "supplier_key", F.col("dq_name_conflict"), "several names"),
        V.member_rule(t["dim_category"], "SQL-WARN-003", "category_key", F.col("dq_description_conflict"), "several descriptions"),
        V.count_rule(t["fact_procurement_process"], "SQL-WARN-004", "tenderer_count_declared", "tenderer_count_observed"),
        *(V.rule(t[fact], f"SQL-WARN-00{i}", "warning", ~F.col(f"dq_{stem}_amount_reconciled_0_01"), f"{stem} header against items") for i, (stem, fact, _, _) in enumerate(HEADERS, 5)),
        _sum_of(foreign, "SQL-WARN-008", "warning", "foreign amounts without a rate"),
        V.rule(t["fact_contract"], "SQL-WARN-009", "warning", ~F.col("dq_final_value_available"), "no final value"),
        _sum_of([V.rule(t[f], f, "warning", F.col(a) < 0) for f, a in amounts], "SQL-WARN-010", "warning", "negative amounts"),
        V.rule(t["fact_procurement_process"], "SQL-WARN-011", "warning", F.col("dq_tender_value_is_zero"), "tenders of zero"),
    ]


def calendar_rule(dates: DataFrame, rule_id: str = "SQL-DIM-002") -> DataFrame:
    """Keys and attributes follow from the date, and no day between the first and the last is missing."""
    known = dates.filter("date_key <> 0")
    wrong = ~F.date_format("full_date", "yyyyMMdd").cast("int").eqNullSafe(F.col("date_key"))
    for name, value in X.calendar_columns(F.col("full_date")).items():
        wrong = wrong | ~F.col(name).eqNullSafe(value)
    gap = F.abs(F.coalesce(F.date_diff(F.max("full_date"), F.min("full_date")) + 1, F.lit(0)) - F.count_distinct("full_date"))
    return known.agg((F.count_if(wrong) + gap).cast("bigint").alias("violations")).select(F.lit(rule_id).alias("rule_id"), F.lit("critical").alias("severity"), "violations", F.lit("calendar").alias("detail"))


def lineage_identity_rule(tables: Mapping[str, DataFrame], identity: Mapping[str, object], rule_id: str = "SQL-LINEAGE-001") -> DataFrame:
    """Rows of facts and bridges whose lineage is not the batch's, or not complete."""
    wrong = reduce(lambda a, b: a | b, (~F.col(c).eqNullSafe(F.lit(v)) for c, v in identity.items()), X.any_null(F.col(c) for c in B.LINEAGE))
    return _sum_of([V.rule(df, name, "critical", wrong) for name, df in tables.items()], rule_id, detail=", ".join(identity))


def evaluate(built: B.Warehouse, identity: Mapping[str, object], audit: DataFrame) -> DataFrame:
    """rule_id, violations, detail, severity, status of every governed rule.

    ``identity`` holds lineage columns that all rows of the batch share. ``audit`` has a row
    (table_name, status, rows, physical_rows) for each table of the batch, see ``publish.audited``.
    """
    t = built.tables
    links = relations(t)
    linked = _total(references(t, links), "orphans", "SQL-REF-001")
    checked = _total(predicates(t, CHECKS), "violations", "SQL-REF-001")
    dims = {n: (df, B.SURROGATES[n]) for n, df in built.of("dimension").items()}
    checks = W.check_warehouse(dims, built.of("bridge")).groupBy("rule_id").agg(F.sum("violations").alias("violations"))
    rows = [
        audit.agg(F.when(F.count(F.lit(1)) > 0, 0).otherwise(1).cast("bigint").alias("violations")).select(F.lit("SQL-BATCH-001").alias("rule_id"), F.lit("critical").alias("severity"), "violations", F.lit("a batch was loaded").alias("detail")),
        V.rule(audit, "SQL-AUDIT-001", "critical", ~F.col("status").eqNullSafe(F.lit("SUCCEEDED")), "tables loaded"),
        V.rule(audit, "SQL-AUDIT-002", "critical", ~F.col("rows").eqNullSafe(F.col("physical_rows")), "rows in files are those of the audit"),
        _total(checks.filter("rule_id = 'WH-UNKNOWN'"), "violations", "SQL-DIM-001", detail="one member 0"),
        calendar_rule(t["dim_date"]),
        *(V.grain_rule(t[name], f"SQL-GRAIN-00{i}", grain) for i, (name, grain) in enumerate(GRAINS.items(), 1)),
        _total(V.rules([linked, checked]), "violations", "SQL-REF-001", detail=f"{len(links)} foreign keys and {len(CHECKS)} checks"),
        V.reference_rule(t["fact_contract"], t["fact_award"], "SQL-REF-002", {"process_key": "process_key", "award_id": "award_id"}),
        lineage_identity_rule({**built.of("fact"), **built.of("bridge")}, identity),
        _total(checks.filter("rule_id = 'WH-BRIDGE'"), "violations", "SQL-BRIDGE-001", detail="no money and no unresolved key in bridges"),
        *attribution_rules(t), *calculation_rules(t), *warning_rules(t),
    ]
    return V.against_catalog(V.rules(rows), catalog(audit.sparkSession))


def _control_totals(parts: Sequence[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """control, currency_code, row_count, non_null_count, total_amount; blank and unknown currencies are one."""
    return reduce(DataFrame.unionByName, (R.currency_totals(df, currency, amount, control=name) for name, df, currency, amount in parts))


def financial_controls(silver: Mapping[str, DataFrame], built: B.Warehouse) -> DataFrame:
    """Seven controls by currency, in the typed tables and in the warehouse, and whether they agree exactly."""
    t = built.tables
    typed = _control_totals([(name, silver[table], currency, amount) for name, table, currency, amount, *_ in CONTROLS])
    facts = _control_totals([(name, _with_code(t[fact], t["dim_currency"], key), "_code", amount) for name, *_, fact, key, amount in CONTROLS])
    return R.reconciled(facts, typed, ["control", "currency_code"], ["row_count", "non_null_count", "total_amount"])


def expected_counts(silver: Mapping[str, DataFrame]) -> DataFrame:
    """layer, table_name, n: what a warehouse of these typed tables holds in its two layers.

    Facts and bridges have a row for each typed row; a dimension has its different natural keys
    and member 0, which is one of them where unclassified rows exist; the calendar has its days.
    """
    n = lambda df, layer, name, more=0: df.agg((F.count(F.lit(1)) + more).alias("n")).select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "n")
    parts = [n(df, "stg", name) for name, df in silver.items()] + [n(silver[s], "dw", name) for name, s in B.SOURCES.items()]
    party, process = silver["party"], silver["procurement_process"]
    roles = {"dim_buyer": "buyer", "dim_supplier": "tenderer|supplier"}
    parts += [n(party.filter(X.role_matches(F.col(B.PARTIES + "roles"), pattern)).select(B.PARTIES + "id").dropna().distinct(), "dw", name, 1) for name, pattern in roles.items()]
    parts.append(n(process, "dw", "dim_process", 1))
    methods = process.select(*(F.coalesce(F.col(c), F.lit(X.UNKNOWN)).alias(f"m{i}") for i, c in enumerate(B.METHOD))).distinct().filter(f"m0 <> '{X.UNKNOWN}' OR m1 <> '{X.UNKNOWN}'")
    parts.append(n(methods, "dw", "dim_procurement_method", 1))
    parts.append(n(reduce(DataFrame.union, (silver[t].select(c) for t, c in B.CURRENCIES)).dropna().distinct(), "dw", "dim_currency", 1))
    parts.append(n(reduce(DataFrame.union, (silver[t].select(p + "unit_scheme", p + "unit_id") for t, p in B.ITEMS.items())).dropna().distinct(), "dw", "dim_unit", 1))
    codes = []
    for table, prefix in B.ITEMS.items():
        for name, part in ((table, prefix + "classification_"), (f"{table}_classification", prefix + "additional_classifications_")):
            codes.append(silver[name].filter(~F.coalesce("dq_classification_was_missing", F.lit(False))).select(part + "scheme", part + "id"))
    code, _, scheme = X.UNCLASSIFIED
    known = reduce(DataFrame.union, codes).toDF("s", "c").dropna().distinct().filter((F.col("s") != scheme) | (F.col("c") != code))
    parts.append(n(known, "dw", "dim_category", 1))
    days = B.dim_date(silver)
    parts.append(n(days, "dw", "dim_date"))
    return reduce(DataFrame.unionByName, parts)


def reconciled_rows(silver: Mapping[str, DataFrame], built: B.Warehouse, audit: DataFrame) -> DataFrame:
    """layer, table_name, actual_n, expected_n, audited_n, physical_n, audit_status, status: four counts of each table, and a load that succeeded."""
    n = lambda df, layer, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "n")
    actual = reduce(DataFrame.unionByName, [n(df, "stg", name) for name, df in silver.items()] + [n(df, "dw", name) for name, df in built.tables.items()])
    both = R.reconciled(actual, expected_counts(silver), ["layer", "table_name"], ["n"])
    side = audit.select(F.col("layer").alias("_l"), F.col("table_name").alias("_t"), F.col("rows").alias("audited_n"), F.col("physical_rows").alias("physical_n"), F.col("status").alias("audit_status"))
    out = both.join(side, both.layer.eqNullSafe(side["_l"]) & both.table_name.eqNullSafe(side["_t"]), "full")
    same = (F.col("status") == "PASS") & F.col("audited_n").eqNullSafe(F.col("actual_n")) & F.col("physical_n").eqNullSafe(F.col("actual_n")) & F.col("audit_status").eqNullSafe(F.lit("SUCCEEDED"))
    return out.select(F.coalesce("layer", "_l").alias("layer"), F.coalesce("table_name", "_t").alias("table_name"), "actual_n", "expected_n", "audited_n", "physical_n", "audit_status", F.when(F.coalesce(same, F.lit(False)), "PASS").otherwise("FAIL").alias("status"))


def audit_by_layer(audit: DataFrame) -> DataFrame:
    """layer, tables, rows, physical_rows, deviations: the audit rolled up."""
    off = ~F.col("rows").eqNullSafe(F.col("physical_rows")) | ~F.col("status").eqNullSafe(F.lit("SUCCEEDED"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
    return audit.groupBy("layer").agg(F.count(F.lit(1)).alias("tables"), total("rows"), total("physical_rows"), F.count_if(off).alias("deviations"))
