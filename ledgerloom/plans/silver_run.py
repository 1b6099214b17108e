"""A whole archive from raw to typed tables: every table written once, with its metrics.

The cells of a raw table are read and trimmed once and kept as Parquet together with a hash of
their row; the counts of that pass are observed while it writes. Duplicates are found on the
narrow columns of that table, and the counts of the typed rows are observed while those are
written. Observed counts belong to the writing stage, so that a task that runs again counts once.

A table is *blocked* by what may not be there after the treatments: repeated rows, rows with an
incomplete or repeated grain, incomplete classifications. Flagged identifiers, amounts of zero
and missing final values are warnings.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import exprs as X
from ledgerloom.sources import archive as A
from ledgerloom.sources import publish as P
from ledgerloom.sources.scratch import written

from .silver import Contract, _outputs, _q, _treated, _trimmed

RULE = "DQ-DUP-001"
BLOCKING = ("additional_duplicate_rows_after", "null_grain_rows_after", "duplicate_grain_rows_after", "incomplete_classification_rows_after")
WARNING = ("identifier_invalid_rows", "zero_amount_rows", "final_value_missing_rows")
METRICS = ("raw_rows", "silver_rows", "quarantine_rows", "trimmed_cells", "additional_duplicate_rows_before", "additional_duplicate_rows_after", "null_grain_rows_before", "null_grain_rows_after", "duplicate_grain_rows_before", "duplicate_grain_rows_after", "incomplete_classification_rows_before", "incomplete_classification_rows_after", "classification_rows_normalized", *WARNING, "columns_raw", "columns_silver")
#: Rule, metric, and the table metrics that it sums before and after.
COMPARED = (
    ("DQ-UNIQ-001", "candidate_grain_violations", ("null_grain_rows_before", "duplicate_grain_rows_before"), ("null_grain_rows_after", "duplicate_grain_rows_after")),
    ("DQ-DUP-001", "additional_duplicate_rows", ("additional_duplicate_rows_before",), ("additional_duplicate_rows_after",)),
    ("DQ-ID-001", "identifier_invalid_rows", ("identifier_invalid_rows",), ("identifier_invalid_rows",)),
    ("DQ-CAT-001", "incomplete_classification_rows", ("incomplete_classification_rows_before",), ("incomplete_classification_rows_after",)),
    ("DQ-FIT-001", "final_value_missing_rows", ("final_value_missing_rows",), ("final_value_missing_rows",)),
    ("DQ-BIZ-001", "zero_amount_rows", ("zero_amount_rows",), ("zero_amount_rows",)),
)


def _row_hash(columns: list[str]) -> Column:
    """128 bits of a row; a null differs from every text and from its neighbour's null."""
    cells = [x for c in columns for x in (_q(c), _q(c).isNull())]
    return F.struct(F.xxhash64(F.lit(1), *cells).alias("a"), F.xxhash64(F.lit(2), *cells).alias("b"))


def _observed(df: DataFrame, what: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, *(c.cast("long").alias(n) for n, c in what.items())), seen


def _counts(rows: DataFrame) -> dict[str, int]:
    """Of (_same, _grain, _null): rows, and those beyond the first of equal rows and of equal grains, before and after equal rows are one."""
    same = rows.groupBy("_same", "_grain", "_null").agg(F.count(F.lit(1)).alias("n"))
    grains = same.groupBy("_grain", "_null").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("different"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    n, d, null = F.col("n"), F.col("different"), F.col("_null")
    row = grains.agg(
        total(n - d).alias("repeated"),
        total(F.when(null, n)).alias("null_before"), total(F.when(null, d)).alias("null_after"),
        total(n - 1).alias("grain_before"), total(d - 1).alias("grain_after"),
    ).first()
    return row.asDict()


@dataclass(frozen=True)
class TableRun:
    name: str
    output: str
    silver: DataFrame
    quarantine: DataFrame
    metrics: dict[str, int]


def run_table(raw: DataFrame, name: str, output: str, contract: Contract, path: str, quarantine_path: str, loaded: Column | None = None, overwrite: bool = False) -> TableRun:
    """Writes one table's typed and quarantined rows and returns them with the metrics.

    ``raw`` has text columns and ``source_row_number``, which no two rows share; the first row
    of equal ones stays. Raises where a cell can't be typed, and where what was written is not
    what was read.
    """
    loaded = F.current_timestamp() if loaded is None else loaded
    trimmed, changed = _trimmed(raw)
    columns = [c for c in trimmed.columns if c != A.ROW_NUMBER]
    seen, first_seen = _observed(raw, {"raw_rows": F.count(F.lit(1)), "trimmed_cells": F.coalesce(F.sum(changed), F.lit(0))})
    trimmed, _ = _trimmed(seen)
    grain = list(contract.grain) or columns
    kept = written(trimmed.select("*", _row_hash(columns).alias("_same"), _row_hash(grain).alias("_grain"), X.any_null(map(_q, grain)).alias("_null")))
    m = {**first_seen.get}
    counts = _counts(kept)
    repeated = counts["repeated"]
    rejected = kept.limit(0)
    if contract.quarantine_duplicates and repeated:
        first = kept.groupBy("_same").agg(F.min(A.ROW_NUMBER).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_same", "_first")
        marked = kept.join(first, "_same", "left")
        late = F.coalesce(F.col(A.ROW_NUMBER) > F.col("_first"), F.lit(False))
        kept, rejected = marked.filter(~late), marked.filter(late)
    plain = [*columns, A.ROW_NUMBER]
    kept, rejected = kept.select(*map(_q, plain)), rejected.select(*map(_q, plain))
    silver, quarantine = _outputs(kept, rejected, contract, RULE, loaded)
    names = X.snake_names(columns)
    part = contract.classification
    cells = [names[c] for c in (part.code, part.description, part.scheme)] if part else []
    what = {"silver_rows": F.count(F.lit(1))}
    if part:
        what |= {"classification_rows_normalized": F.count_if("dq_classification_was_missing"), "incomplete_classification_rows_after": F.count_if(X.any_null(map(F.col, cells)))}
    if contract.identifier:
        what["identifier_invalid_rows"] = F.count_if(~F.col(contract.identifier[2]))
    if contract.zero_flag:
        what["zero_amount_rows"] = F.count_if(F.col(contract.zero_flag[1]))
    if contract.present_flag:
        what["final_value_missing_rows"] = F.count_if(~F.col(contract.present_flag[1]))
    silver, seen = _observed(silver, what)
    rows = P.write_once(silver, path, overwrite)
    m = dict.fromkeys(METRICS, 0) | m | seen.get
    treated = contract.quarantine_duplicates
    dropped = P.write_once(quarantine, quarantine_path, overwrite) if treated else 0
    if (rows, rows + dropped) != (m["silver_rows"], m["raw_rows"]):
        raise ValueError(f"{name}: {m['raw_rows']} rows in, {rows} kept and {dropped} in quarantine")
    m |= {
        "quarantine_rows": dropped,
        "additional_duplicate_rows_before": repeated, "additional_duplicate_rows_after": 0 if treated else repeated,
        "null_grain_rows_before": counts["null_before"] if contract.grain else 0, "null_grain_rows_after": (counts["null_after" if treated else "null_before"]) if contract.grain else 0,
        "duplicate_grain_rows_before": counts["grain_before"] if contract.grain else 0, "duplicate_grain_rows_after": (counts["grain_after" if treated else "grain_before"]) if contract.grain else 0,
        "incomplete_classification_rows_before": m["classification_rows_normalized"],
        "columns_raw": len(columns), "columns_silver": len(silver.columns),
    }
    spark = raw.sparkSession
    return TableRun(name, output, spark.read.parquet(path), spark.read.parquet(quarantine_path) if treated else quarantine, {k: m[k] for k in METRICS})


def metrics_table(spark: SparkSession, runs: Mapping[str, TableRun]) -> DataFrame:
    """A row for each table: source_table, output_table and ``METRICS``."""
    schema = "source_table string, output_table string, " + ", ".join(f"{m} long" for m in METRICS)
    return spark.createDataFrame([(r.name, r.output, *(r.metrics[m] for m in METRICS)) for r in runs.values()], schema)


def quality_comparison(metrics: DataFrame) -> DataFrame:
    """rule_id, metric, before, after: the six governed sums over all tables, from a row of metrics for each."""
    total = lambda names: sum((F.coalesce(F.sum(n), F.lit(0)) for n in names), F.lit(0)).cast("long")
    rows = [F.struct(F.lit(rule).alias("rule_id"), F.lit(metric).alias("metric"), total(before).alias("before"), total(after).alias("after")) for rule, metric, before, after in COMPARED]
    return metrics.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def gate(metrics: DataFrame) -> DataFrame:
    """One row: the blocking and warning sums, promotion_eligible, and BLOCKED, PASS_WITH_WARNINGS or PASS."""
    sums = metrics.agg(*(F.coalesce(F.sum(m), F.lit(0)).cast("long").alias(m) for m in (*BLOCKING, *WARNING)))
    blocked, warned = (sum((F.col(m) for m in names), F.lit(0)) > 0 for names in (BLOCKING, WARNING))
    status = F.when(blocked, "BLOCKED").when(warned, "PASS_WITH_WARNINGS").otherwise("PASS")
    return sums.withColumn("promotion_eligible", ~blocked).withColumn("status", status)


@dataclass(frozen=True)
class ArchiveRun:
    run_id: str
    tables: dict[str, TableRun]
    metrics: DataFrame
    comparison: DataFrame
    status: str


def run_archive(spark: SparkSession, archive: str, folder: str, root: str, contracts: Mapping[str, tuple[str, Contract]], source_id: str, period: str, snapshot: str, config_digest: str, overwrite: bool = False) -> ArchiveRun:
    """From the archive to typed tables below ``root``; ``contracts`` names each member's output table and contract.

    The same archive, configuration and snapshot have the same run id. An archive that lacks a
    table of the contracts, or holds another one, is refused before anything is written.
    """
    digest = A.sha256_file(archive)
    run = P.run_id(source_id, period, snapshot, digest, config_digest)
    raw = A.read_archive(spark, archive, folder)
    missing, unknown = sorted(set(contracts) - set(raw)), sorted(set(raw) - set(contracts))
    if missing or unknown:
        raise ValueError(f"the archive lacks {missing} and holds {unknown} beside the contracts")
    loaded = F.lit(spark.range(1).select(F.current_timestamp()).first()[0])
    held: dict[str, TableRun] = {}
    for name, (output, contract) in contracts.items():
        lineage = {"source_id": source_id, "source_period": period, "snapshot_date": date.fromisoformat(snapshot), "ingestion_run_id": run, "source_file_name": str(archive).rpartition("/")[2], "source_file_sha256": digest, "source_table_name": name}
        own = replace(contract, lineage={**contract.lineage, **lineage})
        held[name] = run_table(raw[name], name, output, own, P.silver_path(root, output, period, snapshot), P.quarantine_path(root, RULE, run, output), loaded, overwrite)
    metrics = metrics_table(spark, held)
    return ArchiveRun(run, held, metrics, quality_comparison(metrics), gate(metrics).first().status)
