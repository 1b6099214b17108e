"""A CSV file read in many blocks against Python's reader."""

from __future__ import annotations

import csv
import random

import pytest

from ledgerloom.functions import exprs as X
from ledgerloom.sources import archive as A
from ledgerloom.sources import split_csv as C


def write(path, rows, end="\n"):
    with open(path, "w", encoding="utf-8", newline="") as f:
        csv.writer(f, lineterminator=end).writerows(rows)


def expected(path):
    with open(path, encoding="utf-8", newline="") as f:
        rows = [r for r in csv.reader(f) if r]
    return [tuple(None if x in X.MISSING_TOKENS else x for x in r) + (i,) for i, r in enumerate(rows[1:], 1)]


@pytest.fixture
def small_blocks(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_rows_and_numbers(spark, tmp_path, small_blocks, end):
    rng = random.Random(7)
    cell = lambda: rng.choice(["a", "", "é,x", 'say "so"', "two\nlines", "NA", " pad ", "x" * rng.randint(1, 40), "\n", 'q"\n"q', "日本\r\nend"])
    rows = [["id", "some\ntext", 'a "name"', "a.b"]] + [[str(i), cell(), cell(), cell()] for i in range(400)]
    rows[200] = ["long", "line\n" * 700, "", "z"]  # crosses several blocks
    path = str(tmp_path / "t.csv")
    write(path, rows, end)
    got = C.read_split_csv(spark, path)
    assert got.columns == [*rows[0], A.ROW_NUMBER]
    assert spark.read.text(path).rdd.getNumPartitions() > 20
    assert sorted(map(tuple, got.collect()), key=lambda r: r[-1]) == expected(path)


def test_edges(spark, tmp_path, small_blocks):
    path = tmp_path / "t.csv"
    for text in ("a,b\n", "a,b", "a,b\n1,2", "a,b\n\n1,2\n\n\n3,4\n", '"a",b\n"1\n",2\n'):
        path.write_text(text)
        assert sorted(map(tuple, C.read_split_csv(spark, str(path)).collect()), key=lambda r: r[-1]) == expected(path)
    path.write_text('a,b\n1,"2\n')
    with pytest.raises(ValueError, match="within a quoted cell"):
        C.read_split_csv(spark, str(path))
    path.write_text("a,a\n1,2\n")
    with pytest.raises(ValueError, match="repeats"):
        C.read_split_csv(spark, str(path))
    path.write_text("")
    with pytest.raises(ValueError, match="no header"):
        C.read_split_csv(spark, str(path))


def test_same_as_one_task(spark, tmp_path):
    rows = [["id", "t"]] + [[str(i), "two\nlines" if i % 3 else "None"] for i in range(50)]
    path = str(tmp_path / "t.csv")
    write(path, rows)
    assert sorted(map(tuple, C.read_split_csv(spark, path).collect())) == sorted(map(tuple, A.read_csv(spark, path).collect()))
