"""Declarative data-quality rules: each becomes a one-row aggregate, all rules one DataFrame.

A rule is a mapping with ``id``, ``type``, ``severity``, ``threshold`` and what its type needs.
Missing tables and columns count as violations, one each; they never raise.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import exprs as X
from ledgerloom.operators import relational as R

Tables = Mapping[str, DataFrame]
SEVERITIES = ("critical", "error", "warning", "info")
THRESHOLDS = ("max_invalid_count", "max_invalid_pct", "min_coverage_pct")


def _counts(df: DataFrame, invalid: Column, evaluated: Column | None = None) -> DataFrame:
    n = F.count(F.lit(1)) if evaluated is None else F.count_if(evaluated)
    return df.agg(F.count_if(F.coalesce(invalid, F.lit(False))).cast("bigint").alias("invalid_rows"), n.cast("bigint").alias("rows_evaluated"))


def _fixed(spark: SparkSession, invalid: int, evaluated: int) -> DataFrame:
    return spark.range(1).select(F.lit(invalid).cast("bigint").alias("invalid_rows"), F.lit(evaluated).cast("bigint").alias("rows_evaluated"))


def _added(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).agg(F.sum("invalid_rows").alias("invalid_rows"), F.sum("rows_evaluated").alias("rows_evaluated"))


def _not_null(spark: SparkSession, tables: Tables, rule: Mapping) -> DataFrame:
    return _counts(tables[rule["table"]], X.any_null(F.col(c) for c in rule["columns"]))


def _grains(spark: SparkSession, tables: Tables, rule: Mapping) -> DataFrame:
    parts = [R.grain_metrics(tables[t].select(*keys), keys).select((F.col("null_grain_rows") + F.col("duplicate_grain_rows")).alias("invalid_rows"), F.col("n_rows").alias("rows_evaluated")) for t, keys in rule["grains"].items() if t in tables]
    gone = [t for t in rule["grains"] if t not in tables]
    return _added([*parts, _fixed(spark, len(gone), 0)])


def _exact_duplicates(spark: SparkSession, tables: Tables, rule: Mapping) -> DataFrame:
    return R.exact_duplicates(tables[rule["table"]]).select(F.col("additional_rows").alias("invalid_rows"), F.col("n_rows").alias("rows_evaluated"))


def _root_references(spark: SparkSession, tables: Tables, rule: Mapping) -> DataFrame:
    root, key = tables[rule["root"]], rule["key"]
    parts = []
    for child in rule["children"]:
        rows = tables[child].filter(F.col(key).isNotNull()).select(key)
        missing = R.orphans(rows, root, {key: key}).agg(F.count(F.lit(1)).alias("invalid_rows"), F.lit(0).cast("bigint").alias("rows_evaluated"))
        parts += [missing, rows.agg(F.lit(0).cast("bigint").alias("invalid_rows"), F.count(F.lit(1)).alias("rows_evaluated"))]
    return _added(parts)


def _foreign_keys(spark: SparkSession, tables: Tables, rule: Mapping) -> DataFrame:
    parts = []
    for link in rule["relationships"]:
        rows = tables[link["child"]].dropna(subset=list(link["keys"])).select(*link["keys"])
        missing = R.orphans(rows, tables[link["parent"]], link["keys"]).agg(F.count(F.lit(1)).alias("invalid_rows"), F.lit(0).cast("bigint").alias("rows_evaluated"))
        parts += [missing, rows.agg(F.lit(0).cast("bigint").alias("invalid_rows"), F.count(F.lit(1)).alias("rows_evaluated"))]
    return _added(parts)


def _numeric_min(spark: SparkSession, tables: Tables, rule: Mapping) -> DataFrame:
    cell = F.col(rule["column"])
    value = cell.try_cast("double")
    low = value < rule["minimum"] if rule.get("inclusive", True) else value <= rule["minimum"]
    null = F.lit(not rule.get("allow_nulls", True)) & cell.isNull()
    return _counts(tables[rule["table"]], F.when(cell.isNull(), null).otherwise(value.isNull() | F.isnan(value) | low))


def _parseable(spark: SparkSession, tables: Tables, rule: Mapping) -> DataFrame:
    cells = tables[rule["table"]].select(F.explode(F.array(*(F.col(c).cast("string") for c in rule["columns"]))).alias("cell"))
    return _counts(cells.filter("cell IS NOT NULL"), X.parsed_timestamp(F.col("cell")).isNull())


def _ordered(spark: SparkSession, tables: Tables, rule: Mapping) -> DataFrame:
    start, end = (X.parsed_timestamp(F.col(rule[x])) for x in ("start", "end"))
    return _counts(tables[rule["table"]], start > end, start.isNotNull() & end.isNotNull())


def _conditional(spark: SparkSession, tables: Tables, rule: Mapping) -> DataFrame:
    there = F.col(rule["condition"]).isNotNull()
    return _counts(tables[rule["table"]], there & F.col(rule["required"]).isNull(), there)


def _identifier(spark: SparkSession, tables: Tables, rule: Mapping) -> DataFrame:
    flag = X.ruc_flag(F.col(rule["scheme_column"]), F.col(rule["identifier_column"]), rule.get("scheme", "PE-RUC"))
    return _counts(tables[rule["table"]], ~flag, flag.isNotNull())


def identifier_breakdown(df: DataFrame, scheme_column: str, identifier_column: str, scheme: str = "PE-RUC") -> DataFrame:
    """One row: rows of the scheme, those with an invalid identifier, of these with another length than 11, and with 11 characters that are not all digits.

    Lengths are of the trimmed text; an absent identifier has length 0.
    """
    flag = X.ruc_flag(F.col(scheme_column), F.col(identifier_column), scheme)
    eleven = F.length(F.coalesce(X.u_trim(F.col(identifier_column)), F.lit(""))) == 11
    counts = {"rows_evaluated": flag.isNotNull(), "format_invalid_rows": ~flag, "invalid_length_rows": ~flag & ~eleven, "non_digit_rows_with_length_11": ~flag & eleven}
    return df.agg(*(F.count_if(F.coalesce(c, F.lit(False))).cast("bigint").alias(n) for n, c in counts.items()))


def _coverage(spark: SparkSession, tables: Tables, rule: Mapping) -> DataFrame:
    return _counts(tables[rule["table"]], F.col(rule["column"]).isNull())


def _required_tables(spark: SparkSession, tables: Tables, rule: Mapping) -> DataFrame:
    return _fixed(spark, sum(t not in tables for t in rule["tables"]), len(rule["tables"]))


def _required_columns(spark: SparkSession, tables: Tables, rule: Mapping) -> DataFrame:
    held = tables[rule["table"]].columns if rule["table"] in tables else []
    return _fixed(spark, sum(c not in held for c in rule["columns"]), len(rule["columns"]))


Evaluator = Callable[[SparkSession, Tables, Mapping], DataFrame]
#: By type: how to evaluate, and the (table, column) pairs that a rule needs.
EVALUATORS: dict[str, tuple[Evaluator, Callable[[Mapping], list[tuple[str, str]]]]] = {
    "required_tables": (_required_tables, lambda r: []),
    "required_columns": (_required_columns, lambda r: []),
    "not_null": (_not_null, lambda r: [(r["table"], c) for c in r["columns"]]),
    "candidate_grains": (_grains, lambda r: []),
    "exact_duplicates": (_exact_duplicates, lambda r: [(r["table"], "")]),
    "root_references": (_root_references, lambda r: [(t, r["key"]) for t in (r["root"], *r["children"])]),
    "foreign_keys": (_foreign_keys, lambda r: [x for link in r["relationships"] for c, p in link["keys"].items() for x in ((link["child"], c), (link["parent"], p))]),
    "numeric_min": (_numeric_min, lambda r: [(r["table"], r["column"])]),
    "parseable_datetime": (_parseable, lambda r: [(r["table"], c) for c in r["columns"]]),
    "ordered_datetimes": (_ordered, lambda r: [(r["table"], r["start"]), (r["table"], r["end"])]),
    "conditional_not_null": (_conditional, lambda r: [(r["table"], r["condition"]), (r["table"], r["required"])]),
    "peru_ruc": (_identifier, lambda r: [(r["table"], r["scheme_column"]), (r["table"], r["identifier_column"])]),
    "classification_completeness": (_not_null, lambda r: [(r["table"], c) for c in r["columns"]]),
    "minimum_coverage": (_coverage, lambda r: [(r["table"], r["column"])]),
}


def lint(catalog: Sequence[Mapping]) -> list[str]:
    """What is wrong with a catalog; empty if nothing is."""
    wrong = []
    ids = [str(r.get("id")) for r in catalog]
    wrong += [f"{i}: the id occurs twice" for i in sorted({i for i in ids if ids.count(i) > 1})]
    for rule in catalog:
        name = rule.get("id")
        if not re.fullmatch(r"DQ-[A-Z]+-[0-9]{3}", str(name)):
            wrong.append(f"{name}: an id looks like DQ-NAME-001")
        if rule.get("type") not in EVALUATORS:
            wrong.append(f"{name}: unknown type {rule.get('type')}")
        if rule.get("severity") not in SEVERITIES:
            wrong.append(f"{name}: unknown severity {rule.get('severity')}")
        if not rule.get("threshold") or set(rule["threshold"]) - set(THRESHOLDS):
            wrong.append(f"{name}: a threshold has {', '.join(THRESHOLDS)}")
    return wrong


def _passed(threshold: Mapping) -> Column:
    """All limits hold. An empty table has nothing invalid and full coverage."""
    invalid, n = F.col("invalid_rows"), F.col("rows_evaluated")
    tests = {
        "max_invalid_count": lambda x: invalid <= x,
        "max_invalid_pct": lambda x: X.percentage(invalid, n) <= x,
        "min_coverage_pct": lambda x: F.when(n > 0, 100 - X.percentage(invalid, n)).otherwise(100.0) >= x,
    }
    return reduce(lambda a, b: a & b, (tests[k](v) for k, v in threshold.items()), F.lit(True))


def evaluate(spark: SparkSession, tables: Tables, catalog: Sequence[Mapping]) -> DataFrame:
    """rule_id, type, severity, invalid_rows, rows_evaluated, invalid_pct, passed: one row for each rule."""
    if wrong := lint(catalog):
        raise ValueError("; ".join(wrong))
    out = []
    for rule in catalog:
        run, needs = EVALUATORS[rule["type"]]
        gone = [(t, c) for t, c in needs(rule) if t not in tables or (c and c not in tables[t].columns)]
        counts = _fixed(spark, len(gone), 0) if gone else run(spark, tables, rule)
        passed = F.lit(False) if gone else _passed(rule["threshold"])
        out.append(counts.select(F.lit(rule["id"]).alias("rule_id"), F.lit(rule["type"]).alias("type"), F.lit(rule["severity"]).alias("severity"), "invalid_rows", "rows_evaluated", X.percentage(F.col("invalid_rows"), F.col("rows_evaluated")).alias("invalid_pct"), passed.alias("passed")))
    return reduce(DataFrame.unionByName, out)


def roll_up(results: DataFrame) -> DataFrame:
    """One row: rules, passed, failed, status. Failed rules of severity info never change the status."""
    blocking = F.count_if(~F.col("passed") & F.col("severity").isin("critical", "error"))
    warning = F.count_if(~F.col("passed") & (F.col("severity") == "warning"))
    status = F.when(blocking > 0, "BLOCKED").when(warning > 0, "PASS_WITH_WARNINGS").otherwise("PASS")
    return results.agg(F.count(F.lit(1)).alias("rules"), F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"), status.alias("status"))
