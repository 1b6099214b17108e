"""Rules over a built warehouse, and reconciliation of its layers.

Each rule is a one-row aggregate (rule_id, severity, violations, detail); all rules are one
DataFrame. A rule of severity ``critical`` fails the warehouse, one of ``warning`` does not.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import exprs as X
from ledgerloom.operators import relational as R


def rule(df: DataFrame, rule_id: str, severity: str, violated: Column, detail: str = "") -> DataFrame:
    """Rows of ``df`` for which ``violated`` is true; null is no violation."""
    n = F.count_if(F.coalesce(violated, F.lit(False))).cast("bigint").alias("violations")
    return df.agg(n).select(F.lit(rule_id).alias("rule_id"), F.lit(severity).alias("severity"), "violations", F.lit(detail).alias("detail"))


def rules(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def grain_rule(df: DataFrame, rule_id: str, grain: Sequence[str], severity: str = "critical") -> DataFrame:
    """Rows with a null in the grain and rows beyond the first of each grain."""
    n = F.col("null_grain_rows") + F.col("duplicate_grain_rows")
    return R.grain_metrics(df, grain).select(F.lit(rule_id).alias("rule_id"), F.lit(severity).alias("severity"), n.alias("violations"), F.lit(", ".join(grain)).alias("detail"))


def reference_rule(child: DataFrame, parent: DataFrame, rule_id: str, keys: Mapping[str, str], severity: str = "critical") -> DataFrame:
    """Child rows whose key no parent has."""
    return rule(R.orphans(child, parent, keys), rule_id, severity, F.lit(True), ", ".join(f"{c} -> {p}" for c, p in keys.items()))


def resolved_rule(df: DataFrame, rule_id: str, keys: Sequence[str], severity: str = "warning") -> DataFrame:
    """Rows that point to an unknown member or to none."""
    return rule(df, rule_id, severity, reduce(lambda a, b: a | b, (F.coalesce(F.col(k), F.lit(0)) == 0 for k in keys)), ", ".join(keys))


def lineage_rule(df: DataFrame, rule_id: str, columns: Sequence[str], severity: str = "critical") -> DataFrame:
    """Rows without a complete lineage."""
    return rule(df, rule_id, severity, X.any_null(F.col(c) for c in columns), ", ".join(columns))


def conversion_rules(fact: DataFrame, prefix: str, amount: str, rate: str, converted: str, currency: str, available: str | None = None, home: str = "PEN") -> DataFrame:
    """Home currency has rate 1, a rate is positive, a conversion is there just where amount and rate are, and it is their product.

    With a flag ``available`` it too must say just where amount and rate are there.
    """
    product = X.converted(F.col(amount), F.col(rate))
    could = F.col(amount).isNotNull() & F.col(rate).isNotNull()
    parts = [
        rule(fact, f"{prefix}-HOME", "critical", (F.col(currency) == home) & ~F.col(rate).eqNullSafe(F.lit(1).cast("decimal(18,14)"))),
        rule(fact, f"{prefix}-POSITIVE", "critical", F.col(rate) <= 0),
        rule(fact, f"{prefix}-INVENTED", "critical", ~could & F.col(converted).isNotNull()),
        rule(fact, f"{prefix}-ABSENT", "critical", could & F.col(converted).isNull()),
        rule(fact, f"{prefix}-PRODUCT", "critical", could & (X.difference(F.col(converted), product) != 0)),
    ]
    if available:
        parts.append(rule(fact, f"{prefix}-FLAG", "critical", ~F.col(available).eqNullSafe(could)))
    return rules(parts)


def reconciliation_rules(fact: DataFrame, prefix: str, header: str, item_sum: str, difference: str, flag: str, child: DataFrame | None = None, keys: Sequence[str] = (), child_amount: str | None = None) -> DataFrame:
    """The stored sum is that of the child rows, the difference is header less items, the flag follows from it; headers that disagree are warnings.

    ``child`` with ``keys`` and ``child_amount`` is summed anew, null keys equal to each other,
    and the difference and flag are held against the new sum; without it the stored sum is taken as given.
    """
    if child is None:
        again, parts = fact.withColumn("_sum", F.col(item_sum)), []
    else:
        sums = child.groupBy(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys))).agg(F.sum(F.col(child_amount).cast(X.MONEY)).cast(X.MONEY).alias("_sum"))
        same = reduce(lambda a, b: a & b, (fact[k].eqNullSafe(sums[f"_k{i}"]) for i, k in enumerate(keys)))
        again = fact.join(sums, same, "left")
        parts = [rule(again, f"{prefix}-SUM", "critical", ~F.col(item_sum).eqNullSafe(F.col("_sum")))]
    expected = X.difference(F.col(header), F.col("_sum"))
    return rules([
        *parts,
        rule(again, f"{prefix}-DIFFERENCE", "critical", ~F.col(difference).eqNullSafe(expected)),
        rule(again, f"{prefix}-FLAG", "critical", ~F.col(flag).eqNullSafe(X.within(expected))),
        rule(again, f"{prefix}-MISMATCH", "warning", ~F.col(flag) & F.col(header).isNotNull() & F.col("_sum").isNotNull()),
    ])


def category_flag_rule(items: DataFrame, rule_id: str, pairs: Mapping[str, str]) -> DataFrame:
    """A flag (first of each pair) is set just where its category key is 0."""
    wrong = reduce(lambda a, b: a | b, (~F.col(flag).eqNullSafe(F.col(key) == 0) for flag, key in pairs.items()))
    return rule(items, rule_id, "critical", wrong, ", ".join(f"{f} = ({k} is 0)" for f, k in pairs.items()))


def zero_flag_rule(fact: DataFrame, rule_id: str, flag: str, amount: str) -> DataFrame:
    return rule(fact, rule_id, "critical", ~F.col(flag).eqNullSafe(X.is_zero(F.col(amount))), f"{flag} = ({amount} is 0)")


def member_rule(dim: DataFrame, rule_id: str, key: str, wrong: Column, detail: str = "") -> DataFrame:
    """Known members of a dimension for which ``wrong`` holds: invalid identifiers, conflicting names or descriptions."""
    return rule(dim, rule_id, "warning", (F.col(key) != 0) & wrong, detail)


def count_rule(fact: DataFrame, rule_id: str, declared: str, observed: str) -> DataFrame:
    """Declared numbers that are not the observed ones; where none is declared there is nothing to compare."""
    return rule(fact, rule_id, "warning", F.col(declared).isNotNull() & (F.col(declared) != F.coalesce(F.col(observed), F.lit(0))), f"{declared} = {observed}")


class ContractError(ValueError):
    """Results that are not those of the catalog."""


def against_catalog(results: DataFrame, catalog: DataFrame) -> DataFrame:
    """Results (rule_id, violations, ...) with the catalog's columns (rule_id, severity, ...) and a status.

    The plan raises when it runs if a governed rule has no result, a result no rule, or an id
    comes twice on either side: both sides are counted by id, and every id must be there once in each.
    """
    names = [c for c in results.columns if c != "rule_id"]
    side = lambda df, n: df.groupBy("rule_id").agg(F.count(F.lit(1)).alias(n), F.any_value(F.struct(*(c for c in df.columns if c != "rule_id"))).alias(f"{n}_row"))
    r, c = side(results.drop("severity"), "found"), side(catalog, "governed")
    both = r.join(c.withColumnRenamed("rule_id", "_id"), F.col("rule_id").eqNullSafe(F.col("_id")), "full")
    rule_id = F.coalesce("rule_id", "_id", F.lit("null"))
    problem = F.when(F.col("found").isNull(), "has no result").when(F.col("governed").isNull(), "is not governed").when((F.col("found") > 1) | (F.col("governed") > 1), "is there twice")
    checked = both.filter(F.when(problem.isNull(), True).otherwise(F.raise_error(F.concat(rule_id, F.lit(" "), problem)).cast("boolean")))
    kept = [n for n in names if n != "severity"]
    out = checked.select("rule_id", *(F.col(f"found_row.{n}") for n in kept), *(F.col(f"governed_row.{n}") for n in catalog.columns if n != "rule_id"))
    return classified(out)


def classified(results: DataFrame) -> DataFrame:
    """``results`` with a status: PASS without violations, else WARN for warnings and FAIL for all other severities."""
    status = F.when(F.col("violations") == 0, "PASS").when(F.col("severity") == "warning", "WARN").otherwise("FAIL")
    return results.withColumn("status", status)


def overall(results: DataFrame) -> DataFrame:
    """One row: rules, passed, warned, failed, status of the warehouse."""
    by = {s: F.count_if(F.col("status") == s) for s in ("PASS", "WARN", "FAIL")}
    status = F.when(by["FAIL"] > 0, "FAIL").when(by["WARN"] > 0, "PASS_WITH_WARNINGS").otherwise("PASS")
    return classified(results).agg(F.count(F.lit(1)).alias("rules"), by["PASS"].alias("passed"), by["WARN"].alias("warned"), by["FAIL"].alias("failed"), status.alias("status"))


def reconciled_layers(counts: Mapping[str, DataFrame], keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """``value`` of each key in every layer, and PASS where all layers have it and agree, else FAIL.

    ``counts`` holds a table (keys, value) for each layer, such as raw, typed, stage and audit;
    layers are joined in ``order`` and no key of any is lost.
    """
    parts = [counts[layer].select(*keys, F.lit(layer).alias("_layer"), F.col(value).cast("decimal(38,4)").alias("_value")) for layer in order]
    rows = reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(*(F.max(F.when(F.col("_layer") == layer, F.col("_value"))).alias(f"{layer}_{value}") for layer in order), F.count_distinct(F.col("_layer")).alias("_layers"), F.count_distinct("_value").alias("_values"), F.count("_value").alias("_held"))
    same = (F.col("_layers") == len(order)) & (F.col("_held") == len(order)) & (F.col("_values") == 1)
    return rows.withColumn("status", F.when(same, "PASS").otherwise("FAIL")).drop("_layers", "_values", "_held")


def conserved(raw: DataFrame, kept: DataFrame, quarantined: DataFrame, keys: Sequence[str], value: str = "n") -> DataFrame:
    """Rows of each table in, kept and in quarantine, and whether none is lost; null keys are equal to each other."""
    sides = ("rows_in", "rows_kept", "rows_quarantined")
    parts = [df.select(*keys, *((F.col(value) if s == side else F.lit(0)).cast("long").alias(s) for s in sides)) for df, side in zip((raw, kept, quarantined), sides)]
    out = reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(*(F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in sides))
    return out.withColumn("status", F.when(F.col("rows_in") == F.col("rows_kept") + F.col("rows_quarantined"), "PASS").otherwise("FAIL"))


def flag_coverage(df: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Per key: rows, rows with the flag, and their share in percent."""
    n = F.count(F.lit(1))
    return df.groupBy(*keys).agg(n.alias("n_rows"), F.count_if(flag).alias("flagged"), X.percentage(F.count_if(flag), n).alias("coverage_pct"))


def participation(parents: DataFrame, children: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Parents with no child, with one and with several."""
    counts = children.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    bucket = F.when(F.coalesce("_n", F.lit(0)) == 0, "0").when(F.col("_n") == 1, "1").otherwise(">1")
    return parents.select(*keys).join(counts, list(keys), "left").groupBy(bucket.alias("children")).agg(F.count(F.lit(1)).alias("parents"))
