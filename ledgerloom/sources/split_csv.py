"""CSV files whose cells may hold line ends, read by many tasks, with the row numbers of one.

Line by line a file can be split anywhere; whether a line begins a record depends on the number
of quotes before it in the file, of which only the parity matters. So a first pass gives each
block its parity and how many records begin in it for either parity before it: a row for each
block. Their prefix sums, taken on the driver, are each block's own parity and first row number.
The second pass puts lines together to records; those that cross blocks leave it in parts,
which meet in a small group. Records are then parsed by Spark's CSV expression.

A quote is doubled within a quoted cell and stands nowhere else, as the format demands. A file
that ends within a quoted cell breaks that rule and is an error.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import exprs as X
from ledgerloom.session import ship

ROW_NUMBER = "source_row_number"
_OPTIONS = {"escape": '"', "multiLine": "true", "mode": "FAILFAST"}


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array]]:
    """(block's first byte, lines) in file order, cut where the block changes."""
    for batch in batches:
        at = batch.column(1).to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(at[1:] != at[:-1]) + 1
        for start, end in zip([0, *edges], [*edges, batch.num_rows]):
            if end > start:
                yield int(at[start]), batch.column(0).slice(start, end - start)


def _parities(lines: pa.Array, parity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(parity of the quotes before each line, whether it is blank, parity after the last)."""
    after = (np.cumsum(pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)) + parity) & 1
    blank = pc.is_in(lines, pa.array(["", "\r"])).to_numpy(zero_copy_only=False)
    return np.r_[parity, after[:-1]], blank, int(after[-1])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list[int]] = {}
    for block, lines in _blocks(batches):
        parity, even, odd = held.get(block, (0, 0, 0))
        before, blank, parity = _parities(lines, parity)
        held[block] = [parity, even + int(((before == 0) & ~blank).sum()), odd + int(((before == 1) & ~blank).sum())]
    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), *(pa.array([v[i] for v in held.values()], pa.int64()) for i in range(3))], names=["block", "parity", "even", "odd"])


def _assembled(first: Mapping[int, tuple[int, int]]):
    """Lines to (number, part, text, whole); a part is the first byte of the block it comes from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parity, number = None, 0, 0
        pending: list[str] = []
        opened = True  # whether the pending lines begin in this block

        def out(rows):
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.bool_()))], names=["number", "part", "text", "whole"])

        def closed(complete: bool) -> list[tuple]:
            return [(number - 1, now, "\n".join(pending), complete and opened)] if pending else []

        for block, lines in _blocks(batches):
            rows: list[tuple] = []
            if block != now:
                rows += closed(parity == 0)
                now, pending = block, []
                parity, number = first[block]
                opened = parity == 0
            before, blank, parity = _parities(lines, parity)
            texts = lines.to_pylist()
            starts = np.flatnonzero((before == 0) & ~blank)
            inner = np.flatnonzero((before == 1))
            alone = np.diff(np.r_[starts, len(texts)]) == 1 if len(starts) else np.zeros(0, bool)
            if not len(inner) and alone.all() and not pending and len(starts):  # no cell holds a line end here
                rows += [(number + i, now, texts[j], True) for i, j in enumerate(starts[:-1])]
                number += len(starts)
                pending, opened = [texts[starts[-1]]], True
            else:
                for text, b, empty in zip(texts, before, blank):
                    if b == 0 and not empty:
                        rows += closed(True)
                        pending, opened = [text], True
                        number += 1
                    elif b == 1:
                        pending.append(text)
            if rows:
                yield out(rows)
        if rows := closed(parity == 0):
            yield out(rows)

    return run


def records(spark: SparkSession, path: str) -> DataFrame:
    """(number, text) of the records of a file, the header being number 0; blank lines between records are none."""
    lines = ship(spark).read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_block_start").alias("block"))
    counted = sorted(lines.mapInArrow(_counted, "block long, parity long, even long, odd long").collect())  # a row for each block
    first, parity, number = {}, 0, 0
    for row in counted:
        first[row.block] = (parity, number)
        number += row.odd if parity else row.even
        parity ^= row.parity
    if parity:
        raise ValueError(f"{path} ends within a quoted cell")
    found = lines.mapInArrow(_assembled(first), "number long, part long, text string, whole boolean")
    crossing = found.filter("NOT whole").groupBy("number").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "text"))), lambda x: x["text"]), "\n").alias("text"))
    rows = found.filter("whole").select("number", "text").unionByName(crossing)
    return rows.select("number", F.regexp_replace("text", r"\r\z", "").alias("text"))


def read_split_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, missing tokens as null, and ``source_row_number`` from 1 in file order, whatever the number of tasks."""
    rows = records(spark, path)
    head = rows.filter("number = 0").first()
    if head is None:
        raise ValueError(f"{path} has no header")
    names = _header(head.text)
    schema = ", ".join(f"_c{i} STRING" for i in range(len(names)))
    cells = rows.filter("number > 0").select("number", F.from_csv("text", schema, _OPTIONS).alias("r"))
    return cells.select(*(X.missing_to_null(F.col(f"r._c{i}")).alias(c) for i, c in enumerate(names)), F.col("number").alias(ROW_NUMBER))


def _header(text: str) -> list[str]:
    """The cells of the header record, each once."""
    names = next(csv.reader(io.StringIO(text, newline="")))
    if len(set(names)) != len(names):
        raise ValueError("the header repeats a name")
    return names
