"""Held-out accuracy of the models, their algebra against direct solutions, and odd rows."""

from __future__ import annotations

import math
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import language_id as L
from ledgerloom.llm import mixing as M
from ledgerloom.llm import quality as Q
from ledgerloom.llm.common import Scratch

SF = "/root/testdata/sf0.001"
PARTS = {"aa": ["bana", "ra", "to", "ki", "lu"], "bb": ["schr", "icht", "ung", "en", "der"], "cc": ["ção", "ões", "ar", "lhe", "mente"]}


def corpus(rng, n=240):
    rows = []
    for i in range(n):
        lang = sorted(PARTS)[i % 3]
        rows.append((i, " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 60))), lang))
    return rows


def test_language_identification(spark):
    rng = random.Random(1)
    rows = corpus(rng) + [(900, None, "aa"), (901, "", None), (902, "12 !!", "bb"), (903, "x", None), (904, "日本語", None), (None, "bana bana rato", None)]
    half = " ".join(t for _, t, lang in rows[:30] if lang == "aa") + " " + " ".join(t for _, t, lang in rows[:30] if lang == "bb")
    rows.append((905, half, None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    got = {r.doc_id: r for r in L.identify(docs, L.learned(docs)).collect()}
    assert len(got) == len(rows)
    held = [r for r in rows[:240] if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert held and sum(got[i].lang_pred == lang for i, _, lang in held) >= 0.98 * len(held)
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (900, 901, 902))
    assert got[903].lang_pred != "und" and got[904].lang_pred != "und" and all(0 <= r.score <= 1 for r in got.values())
    mixed = {s["lang"]: s["share"] for s in got[905].shares}
    assert set(mixed) == {"aa", "bb"} and 0.3 < mixed["aa"] < 0.7
    assert [s["lang"] for s in got[0].shares] == ["aa"]


def plain_mixture(model, text):
    """Expectation maximisation of one text in plain loops, for every size of the set, and the penalised choice."""
    found = L.grams(text).tolist()
    rows = [[math.exp(float(x)) for x in model.logp[g]] for g in found]
    k = len(model.languages)

    def em(shares):
        for _ in range(L.EM_STEPS):
            sums = [0.0] * k
            for row in rows:
                total = sum(s * p for s, p in zip(shares, row))
                for j in range(k):
                    sums[j] += shares[j] * row[j] / total
            shares = [s / len(rows) for s in sums]
        return shares, sum(math.log(sum(s * p for s, p in zip(shares, row))) for row in rows)

    whole, fit = em([1 / k] * k)
    order = sorted(range(k), key=lambda j: (-whole[j], j))
    price = L.PENALTY * math.log(len(rows) + 1)
    tried = [(fit - k * price, whole)]
    for m in range(k - 1, 0, -1):
        shares, fit = em([1 / m if j in order[:m] else 0.0 for j in range(k)])
        tried.append((fit - m * price, shares))
    chosen = max(tried, key=lambda x: x[0])[1]
    first = max(range(k), key=lambda j: (chosen[j], -j))
    return model.languages[first], whole[first], {model.languages[j]: chosen[j] for j in range(k) if chosen[j] > 0}


def test_mixtures_are_those_of_plain_expectation_maximisation(spark):
    rng = random.Random(7)
    parts = {**PARTS, "dd": ["ना", "की", "था", "लो"], "ee": ["bana", "schr", "ção", "lu", "der"]}
    word = lambda lang: "".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3)))
    known = [(i, " ".join(word(lang) for _ in range(40)), lang) for i in range(60) for lang in [sorted(parts)[i % 5]]]
    model = L.learned(spark.createDataFrame(known, "doc_id long, text string, lang string"))
    texts = [" ".join(word(lang) for lang in langs for _ in range(n)) for langs in ("a", "b", "ab", "abc", "abcde", "ce", "de") for langs in [[2 * c for c in langs]] for n in (1, 4, 30)]
    got = model.mixtures([None, *texts, "12", "x"])
    assert got[0] == got[-2] == ("und", 0.0, [])
    for text, (lang, score, shares) in zip([*texts, "x"], [*got[1:-2], got[-1]]):
        want_lang, want_score, want = plain_mixture(model, text)
        assert dict(shares).keys() == want.keys() and all(abs(s - want[a]) < 1e-6 for a, s in shares), text
        assert abs(score - want_score) < 1e-6 and (lang == want_lang or abs(want[lang] - want[want_lang]) < 1e-9)
    assert {len(g[2]) for g in got[1:-2]} >= {1, 2}


def test_registered_languages_are_those_of_plain_expectation_maximisation(spark):
    """The registered query over the smallest tables, held against the plain loops for every document."""
    if not os.path.isdir(SF):
        pytest.skip("the driver's tables are not here")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model, got = L.learned(docs), {r.doc_id: r for r in L.op8_language_id(spark, SF).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        if not r.text or not L.has_letter(r.text):
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        lang, score, _ = plain_mixture(model, r.text)
        assert got[r.doc_id].lang_pred == lang and abs(got[r.doc_id].score - score) < 1e-6
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_language_model_of_nothing(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in L.identify(docs, L.learned(docs)).collect()] == ["und"]


def test_quality(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        good = i % 4 > 0
        words = [rng.choice(["the", "house", "and", "river", "of", "light", "stone", "is"]) + ("" if good else rng.choice(["###", "$$", "!!"])) for _ in range(rng.randint(20, 200))]
        rows.append((i, " ".join(words)))
        labels.append((i, int(good)))
    rows += [(None, "the river"), (1000, None), (1001, ""), (1002, "x" * 200_000)]
    labels += [(0, None), (None, 1), (1, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("quality", F.lit("clash")).withColumn("stats", F.lit(0))
    out = Q.quality_scores(spark, docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    got = {r.doc_id: r for r in out}
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out for i in held) and sum(got[i].predicted == int(i % 4 > 0) for i in held) >= 0.95 * len(held)
    none = Q.quality_scores(spark, docs, spark.createDataFrame([], "doc_id long, quality int")).select("score").distinct().collect()
    assert [r.score for r in none] == [0.5]


def test_normal_equations_are_the_direct_ridge_solution(spark):
    rng = np.random.default_rng(0)
    stats = rng.normal(size=(300, len(Q.STATISTICS)))
    y = (stats[:, 0] > 0).astype(float)
    rows = spark.createDataFrame([(s.tolist(), float(v)) for s, v in zip(stats, y)], "stats array<double>, y double").repartition(5)
    model = Q.fit(rows)
    x = model.features(stats)
    penalty = np.eye(x.shape[1])
    penalty[0, 0] = 0
    assert np.allclose(model.weights, np.linalg.solve(x.T @ x + Q.RIDGE * penalty + 1e-9 * np.eye(len(penalty)), x.T @ y), atol=1e-6)


def test_isotonic():
    knots, values = Q.isotonic(np.array([0.0, 1, 2, 3]), np.array([0.0, 0.9, 0.1, 1.0]), np.array([1.0, 1, 3, 1]))
    assert np.allclose(values, [0, 0, 0.3, 0.3, 1, 1]) and list(knots) == [0, 0, 1, 2, 3, 3]


def test_random_features_approximate_the_kernel():
    model = Q.Model(np.zeros(len(Q.STATISTICS)), np.ones(len(Q.STATISTICS)), None, None, None, fourier=20_000)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(6, len(Q.STATISTICS)))
    waves = model.features(x)[:, 1 + len(Q.STATISTICS) :]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * Q.WIDTH**2))
    assert np.abs(waves @ waves.T - exact).max() < 0.04


def mixed_corpus(spark):
    rng = random.Random(6)
    words = {"clean": ["river", "stone", "light"], "junk": ["###", "$$$"], "toxic": ["vile", "scum"]}
    rows = [(i, " ".join(rng.choice(words[d]) for _ in range(rng.randint(5, 60)))) for i, d in enumerate(rng.choices(["clean", "junk", "toxic"], [6, 3, 1], k=300))]
    labels = [(i, d) for i, t in rows[:150] for d, w in words.items() if t.split()[0] in w]
    rows += [(None, None), (500, ""), (501, "river " * 40_000), (3, "river stone")]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("rate", F.lit("clash")).withColumn("domain", F.lit(0)), spark.createDataFrame(labels, "doc_id long, domain string")


def test_mixing_meets_its_targets(spark):
    docs, labels = mixed_corpus(spark)
    found, model = M.mix(spark, docs, labels, {"clean": 0.5, "junk": 0.3, "toxic": 0.2})
    rows = found.collect()
    assert len(rows) == docs.count() and model.domains == ["clean", "junk", "toxic"] and all(r.rate >= 0 for r in rows)
    n = np.array([r.n_tokens for r in rows], float)
    p, rate = np.array([r.posteriors for r in rows]), np.array([r.rate for r in rows])
    assert [r.n_tokens for r in rows] == [len((r.text or "").split()) for r in rows] and np.allclose(p.sum(1), 1)
    shares = (rate * n) @ p / n.sum()
    assert np.allclose(shares, [0.5, 0.3, 0.2], atol=0.01)
    # The same steps in NumPy.
    history = M.fit_rates(Scratch(spark, "t"), found.select("n_tokens", "posteriors"), [0.5 * n.sum(), 0.3 * n.sum(), 0.2 * n.sum()])
    r = np.ones(len(n))
    for residuals in history:
        r = np.maximum(0, r - (p @ np.array(residuals) + M.PULL * (r - 1)) / (1 + M.PULL))
    assert np.allclose(np.sort(r), np.sort(rate), atol=1e-6)
    copies = M.apply_rates(found)
    assert abs(copies.count() - rate.sum()) < 4 * np.sqrt(len(rate))


def test_mixing_with_an_anchor_keeps_clean_text(spark):
    docs, labels = mixed_corpus(spark)
    docs = docs.filter("doc_id <> 501")  # its clean tokens outweigh all others
    found, model = M.mix(spark, docs, labels, {"clean": 0.9, "junk": 0.06, "toxic": 0.04}, anchor="clean", high=1.0)
    rows = found.collect()
    assert all(r.rate == 1.0 for r in rows if r.posteriors[0] > 0.99) and all(r.rate <= 1 for r in rows)
    kept = M.apply_rates(found)
    assert kept.count() < len(rows)
    assert {r.doc_id for r in rows if r.posteriors[0] > 0.99} <= {r.doc_id for r in kept.collect()}


def test_mixing_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    found, _ = M.mix(spark, docs, spark.createDataFrame([], "doc_id long, domain string"))
    assert found.count() == 0 and M.apply_rates(found).count() == 0


def test_label_domains(spark):
    rows = [(1, 1, 0), (2, 0, 0), (3, 1, 1), (4, None, 0), (None, 1, 0), (1, 1, 0)]
    got = M.label_domains(spark.createDataFrame(rows, "doc_id long, quality int, toxic int")).collect()
    assert {(r.doc_id, r.domain) for r in got} == {(1, "clean"), (2, "junk"), (3, "toxic")}


def test_number_signs_are_no_letters():
    assert [L.has_letter(x) for x in ("½", "²³", "Ⅷ", "_ 12 ٣", "x½", "ß", "語", "")] == [False, False, False, False, True, True, True, False]
    model = L.Model(["de"], np.zeros((L.GRAMS, 1), np.float32))
    assert [m[0] for m in model.mixtures(["½", "²³", "Ⅷ", None, "", "a"])] == ["und"] * 5 + ["de"]
