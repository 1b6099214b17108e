"""Acceptance of a loaded warehouse: every kind of check in one table, and one verdict over it.

The governed rules, the rows of each table, the controls of amounts, the identity of the batch
and the warnings that the typed tables give by themselves are rows (part, check_id, status,
detail) of one table. Warnings never stand in the way of a warehouse; anything else that fails does.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import exprs as X
from ledgerloom.operators import relational as R
from ledgerloom.sources.scratch import written

from . import build as B
from . import governed as G
from . import model as M

#: Warnings whose number follows from the typed tables alone.
COMPARED = tuple(f"SQL-WARN-00{i}" for i in range(1, 10))
#: Lineage columns that all rows of a batch share.
IDENTITY = ("source_id", "source_period", "snapshot_date", "ingestion_run_id")
_SUPPLIERS = "tenderer|supplier"


def _number(rows: DataFrame, rule_id: str, counted: Column) -> DataFrame:
    n = F.count_if(F.coalesce(counted, F.lit(False))).cast("bigint")
    return rows.agg(n.alias("n")).select(F.lit(rule_id).alias("rule_id"), "n")


def _without_rate(t: Mapping[str, DataFrame], table: str, keys: Sequence[str], currency: str, rates: str, rate: str, amount: str) -> DataFrame:
    """``_off``: an amount in a foreign currency, or in none, that no rate converts."""
    side = t[rates].select(*keys, F.col(rate).alias("_rate"))
    rows = t[table].select(*keys, F.col(currency).alias("_code"), F.col(amount).alias("_amount")).join(side, list(keys), "left")
    foreign = F.coalesce(F.col("_code"), F.lit(X.UNKNOWN)) != "PEN"
    return rows.select((foreign & F.col("_amount").isNotNull() & X.rate_for(F.col("_code"), F.col("_rate")).isNull()).alias("_off"))


def typed_warnings(t: Mapping[str, DataFrame], held: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """rule_id, n: the nine warnings counted from the typed tables, without any table of the warehouse.

    A header disagrees with its items unless it is shown to agree, so one without an amount or without items does.
    Each count is ``held``, so that it can be made before the next one is begun.
    """
    party = B.PARTIES
    each = t["party"].filter(X.role_matches(F.col(party + "roles"), _SUPPLIERS) & F.col(party + "id").isNotNull()).groupBy(party + "id")
    valid = F.col("dq_ruc_format_valid")
    suppliers = each.agg(F.count_if(valid).alias("_valid"), F.count_if(~valid).alias("_invalid"), F.count_distinct(party + "identifier_legal_name").alias("_names"))
    codes = []
    for table, prefix in B.ITEMS.items():
        for name, part in ((table, prefix + "classification_"), (f"{table}_classification", prefix + "additional_classifications_")):
            codes.append(t[name].filter(~F.coalesce("dq_classification_was_missing", F.lit(False))).select(*(F.col(part + c).alias(c) for c in ("scheme", "id", "description"))))
    code, _, scheme = X.UNCLASSIFIED
    known = reduce(DataFrame.unionByName, codes).dropna(subset=["scheme", "id"]).filter((F.col("scheme") != scheme) | (F.col("id") != code))
    texts = known.groupBy("scheme", "id").agg(F.count_distinct("description").alias("_texts"))
    observed = t["tenderer"].groupBy("ocid").agg(F.count(F.lit(1)).alias("_observed"))
    declared = t["procurement_process"].select("ocid", F.col(B.TENDER + "number_of_tenderers").alias("_declared")).join(observed, "ocid", "left")
    parts = [
        _number(suppliers, "SQL-WARN-001", (F.col("_invalid") > 0) & (F.col("_invalid") >= F.col("_valid"))),  # a tie is invalid, as in the canonical value
        _number(suppliers, "SQL-WARN-002", F.col("_names") > 1),
        _number(texts, "SQL-WARN-003", F.col("_texts") > 1),
        _number(declared, "SQL-WARN-004", F.col("_declared") != F.coalesce("_observed", F.lit(0))),
    ]
    for rule_id, (_, header, items, keys, amount, item_amount) in zip(COMPARED[4:7], M.AMOUNTS):
        sums = t[items].groupBy(*keys).agg(F.sum(F.col(item_amount).cast(X.MONEY)).alias("_sum"))
        rows = t[header].select(*keys, F.col(amount).alias("_amount")).join(sums, list(keys), "left")
        agree = F.abs(F.col("_amount") - F.col("_sum")) <= F.lit(X.TOLERANCE).cast("decimal(10,4)")
        parts.append(_number(rows, rule_id, ~F.coalesce(agree, F.lit(False))))
    amounts = {**{name: prefix + "total_value_amount" for name, prefix in B.ITEMS.items()}, "award": B.AWARDS + "value_amount", "contract": B.CONTRACTS + "value_amount"}
    foreign = reduce(DataFrame.unionByName, (held(_number(_without_rate(t, *spec, amounts[spec[0]]), "SQL-WARN-008", F.col("_off"))) for spec in M.RATES))
    parts.append(foreign.groupBy("rule_id").agg(F.sum("n").alias("n")))
    parts.append(_number(t["contract"], "SQL-WARN-009", ~F.coalesce("dq_final_value_available", F.lit(False))))
    return reduce(DataFrame.unionByName, map(held, parts))


def reconciled_warnings(results: DataFrame, typed: DataFrame) -> DataFrame:
    """rule_id, actual_n, expected_n, status: warnings of the warehouse (rule_id, violations) against ``typed_warnings``."""
    actual = results.filter(F.col("rule_id").isin(*COMPARED)).select("rule_id", F.col("violations").alias("n"))
    return R.reconciled(actual, typed, ["rule_id"], ["n"])


def identity_checks(tables: Mapping[str, DataFrame], identity: Mapping[str, object]) -> DataFrame:
    """table_name, column_name, n_rows, other_rows, status: rows of each table whose lineage is not the batch's.

    Each table is read once, for all columns of the identity; a null is another value.
    """
    names = list(identity)
    parts = []
    for table, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("_n"), *(F.count_if(~F.col(c).cast("string").eqNullSafe(F.lit(str(identity[c])))).alias(f"_o{i}") for i, c in enumerate(names)))
        cells = F.array(*(F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.col("_n").alias("n_rows"), F.col(f"_o{i}").alias("other_rows")) for i, c in enumerate(names)))
        parts.append(row.select(F.inline(cells)))
    return reduce(DataFrame.unionByName, parts).withColumn("status", F.when(F.col("other_rows") == 0, "PASS").otherwise("FAIL"))


def recorded_checks(audit: DataFrame, recorded: Mapping[str, int]) -> DataFrame:
    """layer, actual_n, expected_n, status: rows of each layer by the audit, and those that the load has reported."""
    spark = audit.sparkSession
    actual = G.audit_by_layer(audit).select("layer", F.col("rows").alias("n"))
    return R.reconciled(actual, spark.createDataFrame(list(recorded.items()), "layer string, n long"), ["layer"], ["n"])


def _checks(part: str, df: DataFrame, names: Sequence[str], detail: Sequence[str]) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    told = F.concat_ws(", ", *(F.concat(F.lit(f"{c}="), text(c)) for c in detail))
    return df.select(F.lit(part).alias("part"), F.concat_ws(".", *map(text, names)).alias("check_id"), "status", told.alias("detail"))


def verdict(checks: DataFrame) -> DataFrame:
    """One row: checks, passed, warned, failed, rules_failed, reconciliations_failed, promotion_eligible, status (PASS, PASS_WITH_WARNINGS or BLOCKED).

    A table without checks is BLOCKED: nothing speaks for it.
    """
    n = lambda *s: F.count_if(F.col("status").isin(*s))
    failed, rules = ~F.coalesce(F.col("status").isin("PASS", "WARN"), F.lit(False)), F.col("part") == "rules"
    blocked = (F.count_if(failed) > 0) | (F.count(F.lit(1)) == 0)
    status = F.when(blocked, "BLOCKED").when(n("WARN") > 0, "PASS_WITH_WARNINGS").otherwise("PASS")
    return checks.agg(F.count(F.lit(1)).alias("checks"), n("PASS").alias("passed"), n("WARN").alias("warned"), F.count_if(failed).alias("failed"), F.count_if(failed & rules).alias("rules_failed"), F.count_if(failed & ~rules).alias("reconciliations_failed"), (~blocked).alias("promotion_eligible"), status.alias("status"))


@dataclass(frozen=True)
class Acceptance:
    checks: DataFrame
    verdict: DataFrame

    def exit_code(self, strict: bool = False) -> int:
        """0, or 1 for a blocked warehouse, or with ``strict`` 2 for one with warnings."""
        status = self.verdict.first().status
        return 1 if status == "BLOCKED" else 2 if strict and status == "PASS_WITH_WARNINGS" else 0


def accept(silver: Mapping[str, DataFrame], built: B.Warehouse, identity: Mapping[str, object], audit: DataFrame, recorded: Mapping[str, int]) -> Acceptance:
    """All checks of a loaded warehouse, each evaluated once and written, and the verdict.

    ``identity`` has the values of ``IDENTITY`` or some of them, ``audit`` a row for each table
    of the batch as ``publish.audited`` gives it, ``recorded`` the rows of each layer that the load reported.
    """
    rules = written(G.evaluate(built, identity, audit))
    lineage = {**{f"stg.{n}": df for n, df in silver.items()}, **{f"dw.{n}": df for n, df in {**built.of("fact"), **built.of("bridge")}.items()}}
    parts = [
        _checks("rules", rules, ["rule_id"], ["violations"]),
        _checks("rows", G.reconciled_rows(silver, built, audit), ["layer", "table_name"], ["actual_n", "expected_n", "audited_n", "physical_n", "audit_status"]),
        _checks("controls", G.financial_controls(silver, built), ["control", "currency_code"], ["actual_row_count", "expected_row_count", "actual_total_amount", "expected_total_amount"]),
        _checks("identity", identity_checks(lineage, identity), ["table_name", "column_name"], ["n_rows", "other_rows"]),
        _checks("recorded", recorded_checks(audit, recorded), ["layer"], ["actual_n", "expected_n"]),
        _checks("warnings", reconciled_warnings(rules, typed_warnings(silver)), ["rule_id"], ["actual_n", "expected_n"]),
    ]
    checks = written(reduce(DataFrame.unionByName, parts))
    return Acceptance(checks, verdict(checks))
