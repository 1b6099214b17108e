"""Decontamination against brute force, and token files as exact round trips."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import decontaminate as D
from ledgerloom.llm import token_output as T

DOCS = "doc_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text, items, size):
    words = WORD.findall((text or "").translate(FOLD))
    hit, found = set(), set()
    for name, item in items:
        w = WORD.findall((item or "").translate(FOLD))
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            for j in range(len(words) - n + 1):
                if words[j : j + n] == w[i : i + n]:
                    hit.update(range(j, j + n))
                    found.add(str(name))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_decontamination(spark, block_bytes):
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "B", "c1", "é", "dd", "É"])
    items = [(i, " ".join(word() for _ in range(rng.randint(1, 9)))) for i in range(8)] + [(50, None), (51, "--"), (3, "zz zz")]
    texts = [" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(60)] + [None, "", "...", "x-zz. ZZ", "azz zz"]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).withColumn("items", F.lit(1)).withColumn("block", F.lit("x"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in D.contamination(spark, docs, bench, window=4, block_bytes=block_bytes).collect()}
    for i, text in enumerate(texts):
        assert (got[i].n_words, got[i].n_hit, sorted(got[i]["items"])) == brute(text, items, 4), text
        for span in got[i].spans:
            assert WORD.findall(text[span.start : span.stop].translate(FOLD))
        assert sum(len(WORD.findall(text[s.start : s.stop].translate(FOLD))) for s in got[i].spans) == got[i].n_hit
    kept = D.decontaminate(spark, docs, bench, window=4)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i in got if not got[i].n_hit}
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contamination(spark, docs, none).filter("n_hit > 0").count() == 0 and D.decontaminate(spark, docs, none).count() == len(texts)


TEXTS = ["Hello world", None, "", "½ a½b", "<|endoftext|> X <|ENDOFTEXT|> y", "É́ Á \x1c x\x1cy it 's it's 12½ ", "d'été Éléphant ÀÉ×÷ ªº µ ß ẞ _a_b", "ＡＢ①② 3x", "漢字 テスト", "w " * 3000, "the,*** the### The"]


def test_words_are_exact():
    path = public_tokenizers.path(T.TOKENIZER)
    known = Tokenizer.from_file(path)
    got = T.WordIds(path).of([t if t is None else t.encode() for t in TEXTS])
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [known.encode(t or "", add_special_tokens=False).ids for t in TEXTS]


def test_token_files_round_trip(spark, tmp_path):
    known = Tokenizer.from_file(public_tokenizers.path(T.TOKENIZER))
    rows = [(100 - 3 * i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (7, "twice"), (7, "again")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("n", F.lit(1)).repartition(3)
    T.write_tokens(spark, docs, str(tmp_path / "t"), block_tokens=500, partitions=3)
    ids = {}
    for d, t in rows:
        ids.setdefault(d, []).append([*known.encode(t or "", add_special_tokens=False).ids, T.END_ID])
    order = [x for d in sorted(ids, key=lambda d: (d is not None, d)) for x in sorted(ids[d], key=lambda x: np.array(x, "<u2").tobytes())]
    starts = np.cumsum([0, *map(len, order)])
    want = sorted((int(s), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for s, x in zip(starts, order))
    got = T.read_digests(spark, str(tmp_path / "t")).collect()
    assert sorted((r.start, r.n_tokens, r.ids_crc32) for r in got) == want
    pieces = {}
    for r in T.read_pieces(spark, str(tmp_path / "t"), with_ids=True).collect():
        pieces.setdefault((r.part, r.no), {})[r.at] = r.ids
    assert sorted(sum((p[a] for a in sorted(p)), []) for p in pieces.values()) == sorted(order)
    T.write_tokens(spark, spark.createDataFrame([], DOCS), str(tmp_path / "e"))
    assert T.read_digests(spark, str(tmp_path / "e")).count() == 0


def test_coder_and_checkpoints():
    rng = np.random.default_rng(1)
    ids = (rng.zipf(1.4, 5000) % 900).astype("<u2")
    values, n = np.unique(ids, return_counts=True)
    coder = T.Coder(T.frequencies(dict(zip(values.tolist(), n.tolist()))))
    got = coder.encode(ids, lanes=16, every=50)
    assert (coder.decode(len(ids), got["states"], got["stream"], 16) == ids).all()
    assert got["marks"]
    for step, at, states in got["marks"]:
        assert (coder.decode(len(ids), states, got["stream"], 16, first=step, at=at) == ids[step * 16 :]).all()
    left, right = b"some bytes", b"and others"
    assert T.crc32_combine(zlib.crc32(left), zlib.crc32(right), len(right)) == zlib.crc32(left + right)
    assert sum(T.frequencies({1: 1, 2: 10**9}).values()) == 1 << T.SCALE_BITS


def test_one_block_of_the_benchmark_is_held_at_a_time(spark, monkeypatch):
    fetched, scanned = [], []
    blocks, one = D._blocks, D._scanned

    def counted(*args):
        for block in blocks(*args):
            fetched.append(1)
            yield block

    def seen(*args):
        scanned.append(len(fetched))
        return one(*args)

    monkeypatch.setattr(D, "_blocks", counted)
    monkeypatch.setattr(D, "_scanned", seen)
    bench = spark.createDataFrame([(i, f"word{i} a{i} b{i} c{i}") for i in range(4)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"x word{i} a{i} b{i} c{i} y") for i in range(5)], DOCS)
    got = {r.doc_id: r.n_hit for r in D.contamination(spark, docs, bench, window=4, block_bytes=1).collect()}
    assert got == {0: 4, 1: 4, 2: 4, 3: 4, 4: 0} and scanned == [1, 2, 3, 4]


def test_a_damaged_block_is_noticed(spark, tmp_path):
    T.write_tokens(spark, spark.createDataFrame([(1, "some words here")], DOCS), str(tmp_path / "t"))
    rows = spark.read.schema(T.BLOCKS_DDL).parquet(str(tmp_path / "t/blocks"))
    rows.withColumn("crc32", F.col("crc32") + 1).write.parquet(str(tmp_path / "b/blocks"))
    spark.read.parquet(str(tmp_path / "t/table")).write.parquet(str(tmp_path / "b/table"))
    with pytest.raises(Exception, match="checksum"):
        T.read_pieces(spark, str(tmp_path / "b")).collect()


def test_spans_do_not_depend_on_blocks(spark):
    docs = spark.createDataFrame([(1, "a b -- c d x a b"), (1, "c d"), (None, "É a b c"), (2, None)], "doc_id long, text string").withColumn("hits", F.lit(1))
    items = spark.createDataFrame([(1, "a b"), (2, "c d"), (3, "b c d")], "item_id long, text string")
    found = [D.contamination(spark, docs, items, window=2, block_bytes=n).collect() for n in (1 << 20, 4)]
    one, many = (sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r.items), tuple(map(tuple, r.spans))) for r in rows), key=repr) for rows in found)
    assert one == many and (1, 7, 6, ("1", "2", "3"), ((0, 10), (13, 16))) in one
