"""The pipeline's stages one by one on the smallest tables, and the registered queries."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from ledgerloom.llm import decontaminate, ngram_join
from ledgerloom.llm.common import Scratch

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(Scratch(spark, "test").cut(stage(spark, kept[-1], SF), name))
        assert kept[-1].columns == columns
    ids = [{r.doc_id for r in df.select("doc_id").collect()} for df in kept]
    assert all(b <= a for a, b in zip(ids, ids[1:]))
    assert not kept[1].filter("text IS NULL OR NOT text RLIKE '[A-Za-z]'").count()
    classes = ngram_join.ngram_components(spark, kept[1], 5, 80).collect()
    assert ids[2] == {r.component_id for r in classes}
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert ids[3] == {r.doc_id for r in decontaminate.contamination(spark, kept[2], bench).filter("n_hit = 0").collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    clean = {r.doc_id for r in labels.filter("quality = 1 AND toxic = 0").collect()}
    lost = (ids[3] & clean) - ids[4]
    assert len(lost) <= 0.02 * len(ids[3] & clean)
    out = corpus_pipeline.STAGES[-1][1](spark, kept[-1], SF).collect()
    rows = sorted((r.doc_id, r.start, r.n_tokens) for r in out)
    assert {r[0] for r in rows} == ids[4] and rows[0][1] == 0
    assert all(a[1] + a[2] == b[1] for a, b in zip(rows, rows[1:]))


def test_all_numbered_queries_are_registered():
    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)} and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", ["op1_url_filter", "op2_fuzzy_lines", "op6_html_extract", "op7_mixing"])
def test_queries_keep_every_row(spark, name):
    table, key = ("pages", "page_id") if name in ("op1_url_filter", "op6_html_extract") else ("documents", "doc_id")
    got = __spark_entry__.queries()[name](spark, SF).select(key)
    assert sorted(got.collect()) == sorted(spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect())


def test_stages_keep_the_columns_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", *(F.lit(c).alias(c) for c in ("score", "shares", "lang_pred", "rate", "n_tokens", "posteriors", "_copies", "h1", "class", "n_words", "_gone_key", "_present_at", "_present_word", "_present_bits", "item_id")), F.lit("a.b").alias("a.b"))
    extra = [(None, None), (None, "one text without an id that stays"), (7, "a text of its own under a repeated id")]
    rows = spark.createDataFrame(extra, "doc_id long, text string").select("doc_id", "text", F.lit("en").alias("lang"), *(F.lit(c).alias(c) for c in docs.columns[3:]))
    kept = docs.unionByName(rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = Scratch(spark, "test").cut(stage(spark, kept, SF), name)
        assert kept.columns == docs.columns
    assert all(r[c] == c for r in kept.collect() for c in docs.columns[3:])
    texts = {r.text for r in kept.collect()}
    assert None not in texts and {t for _, t in extra[1:]} <= texts


def test_stages_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_stages_of_long_texts_ties_and_repeated_rows(spark):
    """A text of some MB passes whole, of equal texts the smallest doc_id stays, and an equal row is judged as its twin."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    words = sorted({w for r in docs.filter("lang = 'en'").limit(40).collect() for w in (r.text or "").split()})
    draw = random.Random(3)
    long = " ".join(draw.choices(words, k=400_000))
    tied = " ".join(draw.choices(words, k=300))
    assert len(long) > 2_000_000
    first = docs.agg(F.max("doc_id")).first()[0] + 1
    rows = [(first, long), (first + 3, tied), (first + 1, tied), (first + 2, tied), (first + 4, long + " end"), (first + 1, tied)]
    kept = docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en")))
    added = lambda df: sorted((r.doc_id, r.text) for r in df.filter(F.col("doc_id") >= first).collect())
    stages = dict(corpus_pipeline.STAGES)
    kept = Scratch(spark, "test").cut(stages["language_id"](spark, kept, SF), "language")
    assert added(kept) == sorted(rows)
    kept = Scratch(spark, "test").cut(stages["ngram_jaccard_join"](spark, kept, SF), "join")
    assert added(kept) == [(first, long), (first + 1, tied), (first + 1, tied)]  # equal rows are one document
    kept = Scratch(spark, "test").cut(stages["benchmark_decontamination"](spark, kept, SF), "benchmark")
    assert [r[0] for r in added(kept)] == [first, first + 1, first + 1]
    mixed = Scratch(spark, "test").cut(stages["mixing"](spark, kept, SF), "mixing")
    assert set(added(mixed)) <= set(added(kept)) and mixed.columns == kept.columns
    out = {r.doc_id: r.n_tokens for r in stages["token_output"](spark, kept, SF).filter(F.col("doc_id") >= first).collect()}
    assert out[first] >= 400_000 and 300 <= out[first + 1] < 3000


def test_run_is_its_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = sorted((r.start, r.n_tokens) for r in got.collect())
    assert rows[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(rows, rows[1:]))
