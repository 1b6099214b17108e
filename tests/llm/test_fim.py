"""The fill-in-middle transformation against plain slicing, and its inverse."""

from __future__ import annotations

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, rate, spm):
    text = text or ""
    units = UNIT.findall(text)
    h = fim.draws(doc_id, 42)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", text, None, None
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return len(units), "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return len(units), "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


@settings(max_examples=300, deadline=None)
@given(st.integers(-5, 10**12), st.text(alphabet="a é日\t\n\x0b<P>SM.", max_size=60), st.sampled_from([0, 50, 100]))
def test_forms(doc_id, text, spm):
    n, form, out, p, m = fim.transformed(doc_id, text.encode(), 100, spm)
    assert (n, form, out.decode(), p, m) == brute(doc_id, text, 100, spm)
    assert fim.restored(out, form) == text.encode()


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 1500), st.integers(0, 9))
def test_splits_keep_counts(rank, seed):
    rng = random.Random(seed)
    text = "".join(rng.choice(["ab", " ", "\n\n", "é", "日本 "]) for _ in range(2500))
    units = UNIT.findall(text)
    rope = fim.Rope.of(text.encode())
    assert (rope.units, rope.points, rope.size) == (len(units), len(text), len(text.encode()))
    left, right = rope.split(rank)
    assert (left.text().decode(), right.text().decode()) == ("".join(units[:rank]), "".join(units[rank:]))
    assert (left.units, right.units, left.points) == (len(units[:rank]), len(units[rank:]), sum(map(len, units[:rank])))


def test_white_space_at_the_end_is_one_unit():
    for text in ("", " ", "a ", " a", "a" * 5000, " \t" * 4000, "w " * 3000, "w " * fim.LEAF, " w" * fim.LEAF + "\n"):
        assert fim.Rope.of(text.encode()).units == len(UNIT.findall(text))


@pytest.mark.parametrize("rate", [50, 100])
def test_query_rows(spark, rate):
    rng = random.Random(1)
    long = " ".join(f"wörd{i}" for i in range(200_000))
    rows = [(i, "".join(rng.choice(["a", " ", "é", "\n", "日"]) for _ in range(rng.randint(0, 80)))) for i in range(60)]
    rows += [(None, "no id"), (None, None), (3, None), (3, "one id"), (3, "one id"), (77, "a <P> b c d"), (78, long), (79, long)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, form string")
    got = fim.restore(fim.fill_in_middle(docs, rate=rate)).collect()
    assert sorted(((r.doc_id, r.n, r.form, r.output, r.prefix_chars, r.middle_chars) for r in got), key=str) == sorted(((i, b[0], b[1], b[2], b[3], b[4]) for i, t in rows for b in [brute(i, t, rate, 80)]), key=str)
    assert sorted(r.restored for r in got) == sorted(t or "" for _, t in rows)
    assert fim.restore(fim.fill_in_middle(docs.limit(0))).collect() == []
