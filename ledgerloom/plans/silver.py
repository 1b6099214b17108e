"""Raw to typed: trimming, treatments, quarantine, strict typing, flags and lineage of one table.

One lazy plan for each table, and one aggregate for its metrics. A contract says which columns
have which kind and which treatments apply; nothing is repaired that a treatment does not name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import exprs as X
from ledgerloom.operators import relational as R
from ledgerloom.sources.archive import ROW_NUMBER

KINDS = {"string": "string", "integer": "bigint", "boolean": "boolean", "decimal": X.MONEY, "datetime": "timestamp", "date": "date"}


@dataclass(frozen=True)
class Classification:
    """Columns of a code, its description and its scheme, which are filled where they are null."""

    code: str
    description: str
    scheme: str


@dataclass(frozen=True)
class Contract:
    """How the columns of a raw table are typed and which treatments it gets. Names are those of the raw table."""

    grain: Sequence[str] = ()
    integers: frozenset[str] = frozenset()
    booleans: frozenset[str] = frozenset()
    datetimes: frozenset[str] = frozenset()
    datetime_suffixes: tuple[str, ...] = ("/date", "/datePublished", "/dateModified", "/dateSigned", "/startDate", "/endDate")
    decimal_suffixes: tuple[str, ...] = ("/amount", "/amount_PEN", "/quantity", "/rate")
    quarantine_duplicates: bool = False
    classification: Classification | None = None
    #: (scheme column, identifier column, flag)
    identifier: tuple[str, str, str] | None = None
    #: (amount column, flag)
    zero_flag: tuple[str, str] | None = None
    present_flag: tuple[str, str] | None = None
    lineage: Mapping[str, str] = field(default_factory=dict)

    def kind(self, column: str) -> str:
        if column in self.integers:
            return "integer"
        if column in self.booleans:
            return "boolean"
        if column in self.datetimes or column.endswith(self.datetime_suffixes):
            return "datetime"
        return "decimal" if column.endswith(self.decimal_suffixes) else "string"


@dataclass(frozen=True)
class Result:
    silver: DataFrame
    quarantine: DataFrame
    #: One row of metrics.
    metrics: DataFrame


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _trimmed(raw: DataFrame) -> tuple[DataFrame, Column]:
    """``raw`` with trimmed cells, and how many cells of a raw row that changes."""
    columns = [c for c in raw.columns if c != ROW_NUMBER]
    changed = reduce(lambda a, b: a + b, (F.coalesce((_q(c) != X.u_trim(_q(c))).cast("long"), F.lit(0)) for c in columns), F.lit(0).cast("long"))
    return raw.select(*(X.u_trim(_q(c)).alias(c) for c in columns), ROW_NUMBER), changed


def _treated(kept: DataFrame, contract: Contract) -> tuple[DataFrame, dict[str, Column]]:
    """``kept`` with filled classifications, and the flags of the treatments."""
    flags: dict[str, Column] = {}
    if part := contract.classification:
        cells = (part.code, part.description, part.scheme)
        kept = kept.withColumn("_missing", X.any_null(map(_q, cells)))
        for cell, token in zip(cells, X.UNCLASSIFIED):
            kept = kept.withColumn(cell, F.coalesce(_q(cell), F.lit(token)))
        flags["dq_classification_was_missing"] = F.col("_missing")
    if contract.identifier:
        scheme, identifier, name = contract.identifier
        flags[name] = X.ruc_flag(_q(scheme), _q(identifier))
    if contract.zero_flag:
        flags[contract.zero_flag[1]] = X.is_zero(_q(contract.zero_flag[0]).try_cast(X.MONEY))
    if contract.present_flag:
        flags[contract.present_flag[1]] = _q(contract.present_flag[0]).isNotNull()
    return kept, flags


def _typed(column: str, contract: Contract, name: str) -> Column:
    """The cell in its kind; the plan raises where that can't be done."""
    kind = contract.kind(column)
    value = X.STRICT[kind](_q(column))
    if kind != "string":
        wrong = _q(column).isNotNull() & (_q(column) != "") & value.isNull()
        value = F.when(wrong, F.raise_error(F.concat(F.lit(f"{column} is no {kind}: "), _q(column))).cast(KINDS[kind])).otherwise(value)
    return value.cast(KINDS[kind]).alias(name)


def _lineage(contract: Contract, loaded: Column) -> list[Column]:
    return [*(F.lit(v).alias(k) for k, v in contract.lineage.items()), F.col(ROW_NUMBER), loaded.alias("loaded_at_utc")]


def _outputs(kept: DataFrame, rejected: DataFrame, contract: Contract, rule: str, loaded: Column) -> tuple[DataFrame, DataFrame]:
    columns = [c for c in kept.columns if c != ROW_NUMBER]
    names = X.snake_names(columns)
    filled, flags = _treated(kept, contract)
    lineage = _lineage(contract, loaded)
    silver = filled.select(*(_typed(c, contract, names[c]) for c in columns), *(c.alias(n) for n, c in flags.items()), *lineage)
    return silver, rejected.select(*(_q(c).alias(names[c]) for c in columns), F.lit(rule).alias("rule_id"), F.lit("exact duplicate").alias("reason"), *lineage)


def transform(raw: DataFrame, contract: Contract, rule: str = "DQ-DUP-001") -> Result:
    """``raw`` has text columns and ``source_row_number``. Cells that can't be typed raise when the plan runs.

    Lineage columns come last: the contract's, then the row number and the load time.
    """
    columns = [c for c in raw.columns if c != ROW_NUMBER]
    trimmed, changed = _trimmed(raw)
    kept, rejected = R.split_duplicates(trimmed, columns, ROW_NUMBER) if contract.quarantine_duplicates else (trimmed, trimmed.limit(0))
    silver, quarantine = _outputs(kept, rejected, contract, rule, F.current_timestamp())
    filled, _ = _treated(kept, contract)
    before = R.grain_metrics(trimmed, list(contract.grain)) if contract.grain else None
    counts = raw.agg(F.count(F.lit(1)).alias("rows_in"), F.coalesce(F.sum(changed), F.lit(0)).alias("trimmed_cells"))
    after = filled.agg(F.count(F.lit(1)).alias("rows_kept"), F.count_if(F.col("_missing") if contract.classification else F.lit(False)).alias("classifications_filled"))
    metrics = counts.join(after).withColumn("rows_quarantined", F.col("rows_in") - F.col("rows_kept"))  # each side is one row
    if before is not None:
        metrics = metrics.join(before.select("null_grain_rows", F.col("duplicate_grain_rows").alias("duplicate_grain_rows_before")))
        metrics = metrics.join(R.grain_metrics(kept, list(contract.grain)).select(F.col("duplicate_grain_rows").alias("duplicate_grain_rows_after")))
    return Result(silver, quarantine, metrics)
