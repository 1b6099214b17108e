"""Soft-membership mixing, in DataFrame expressions only.

A naive Bayes classifier over hashed words learns from labelled rows, and gives each
document its posteriors over domains. Document rates r >= 0 are then fitted by projected
gradient so that the expected tokens of each domain, sum of r * tokens * posterior, match
the targets in the least-squares sense. Residuals are weighted by the domains' shares, which
puts all curvatures in (0, 1], so few steps suffice.

The model is two numbers for each word bucket and domain, inlined as literal arrays, so
scoring is one pass without a shuffle. A gradient step is one aggregate over a written table
of a few numbers a document; the rates are a function of the past residuals, one number for
each domain and step, and are never collected.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table

BUCKETS = 1 << 14
#: Labelled rows that the classifier learns from, at most: those of the smallest hashes of their ids.
LABELLED = 20_000
#: Words that count in full; the evidence of longer texts is scaled down to so many, which keeps posteriors soft.
EVIDENCE = 120
SMOOTHING = 0.5
PULL = 1e-3
#: Gradient steps at most, steps between two writings of the rates, and the residual, relative to a domain's tokens, that ends the fit.
STEPS = 30
NESTED = 6
TOLERANCE = 1e-3
#: Target shares of tokens in the registered query: domains are read off ``labels``.
TARGETS = {"clean": 0.9, "junk": 0.08, "toxic": 0.02}


def words_of(text: Column) -> Column:
    """Words between blanks and line ends; a null or blank text has none."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), "\t\n\r\u000b\u000c", "     "), " "), lambda w: w != "")


def bucket_of(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) from ``labels`` (doc_id, quality, toxic): toxic, else junk or clean. Rows with a null are left out."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "junk").otherwise("clean")
    return labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(domain).alias("domain"))


class Classifier:
    """Domains in alphabetic order, the log prior of each, and each bucket's log-likelihood in each, less that in the first domain."""

    def __init__(self, domains: list[str], priors: list[float], weights: list[list[float]]):
        self.domains, self.priors, self.weights = domains, priors, weights

    @classmethod
    def fit(cls, docs: DataFrame, labelled: DataFrame, domains: list[str], most: int = LABELLED) -> Classifier:
        """Labels of other domains are left out; a domain without labelled words has the flat likelihood."""
        domains = sorted(domains)
        sample = labelled.filter(F.col("domain").isin(domains)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")  # at most ``most`` rows are sent
        rows = known.select("domain", F.explode(words_of(F.col("text"))).alias("word")).groupBy("domain", bucket_of(F.col("word")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
        sizes = dict.fromkeys(domains, 0)
        sizes |= {r.domain: r["count"] for r in sample.groupBy("domain").count().collect()}
        counts = {d: [SMOOTHING] * BUCKETS for d in domains}
        for r in rows.collect():  # at most BUCKETS rows for each domain
            counts[r.domain][r.bucket] += r.n
        logs = []
        for d in domains:
            total = math.log(sum(counts[d]))
            logs.append([math.log(x) - total for x in counts[d]])
        whole = sum(sizes.values())
        priors = [math.log((sizes[d] + 1) / (whole + len(domains))) for d in domains]
        return cls(domains, priors, [[round(a - b, 5) for a, b in zip(row, logs[0])] for row in logs])

    def with_posteriors(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """``docs`` with n_tokens (words) and posteriors (array, in the order of ``domains``)."""

        def evidence(weights: list[float]) -> Column:
            held = F.from_json(F.lit(json.dumps(weights)), "array<double>")
            return F.aggregate("_buckets", F.lit(0.0), lambda acc, b: acc + F.get(held, b))

        out = docs.withColumn("_buckets", F.transform(words_of(F.col(text)), bucket_of)).withColumn("n_tokens", F.size("_buckets").cast("long"))
        scale = F.lit(float(EVIDENCE)) / F.greatest(F.col("n_tokens"), F.lit(EVIDENCE))
        scores = [F.lit(self.priors[0])]
        scores += [F.lit(prior) + scale * evidence(row) for prior, row in list(zip(self.priors, self.weights))[1:]]
        out = out.withColumn("_scores", F.array(*scores))
        out = out.withColumn("_raised", F.transform("_scores", lambda s: F.exp(s - F.array_max("_scores"))))
        whole = F.aggregate("_raised", F.lit(0.0), lambda acc, x: acc + x)
        return out.withColumn("posteriors", F.transform("_raised", lambda x: x / whole)).drop("_buckets", "_scores", "_raised")


def rate_of(history: list[list[float]], low: float, high: float | None) -> Column:
    """The rate after the steps whose weighted residuals are ``history``, from posteriors; it begins at 1."""
    start = F.lit(float(min(max(1.0, low), high if high is not None else 1.0)))
    if not history:
        return start
    steps = F.from_json(F.lit(json.dumps(history)), "array<array<double>>")

    def step(rate: Column, residuals: Column) -> Column:
        slope = F.aggregate(F.zip_with("posteriors", residuals, lambda p, r: p * r), F.lit(0.0), lambda acc, x: acc + x)
        moved = F.greatest(F.lit(float(low)), rate - (slope + F.lit(PULL) * (rate - 1)) / F.lit(1 + PULL))
        return moved if high is None else F.least(F.lit(float(high)), moved)

    return F.aggregate(steps, start, step)


def _step(rate: Column, residuals: list[float], low: float, high: float | None) -> Column:
    """One gradient step on written columns p0, p1, ...; it names ``rate`` once, so steps nest."""
    k = 1 / (1 + PULL)
    moved = rate * F.lit(k) + F.lit(PULL * k)
    for i, residual in enumerate(residuals):
        moved = moved - F.col(f"p{i}") * F.lit(residual * k)
    moved = F.greatest(F.lit(float(low)), moved)
    return moved if high is None else F.least(F.lit(float(high)), moved)


def fit_rates(scratch: Scratch, rows: DataFrame, targets: list[float], low: float = 0.0, high: float | None = None, steps: int = STEPS) -> list[list[float]]:
    """History for ``rate_of`` from ``rows`` (n_tokens, posteriors): ``targets`` are tokens of each domain.

    A step is one aggregate over the written rates; they are written anew every few steps. A
    domain without any mass can't be reached and is left out of the fit; a table without
    tokens needs no step.
    """
    k = len(targets)
    start = rate_of([], low, high).alias("rate")
    held = scratch.cut(rows.select("n_tokens", *(F.col("posteriors")[i].alias(f"p{i}") for i in range(k)), start), "rates")

    def totals(rate: Column) -> list[float]:
        weighed = held.select((rate * F.col("n_tokens")).alias("w"), *(f"p{i}" for i in range(k)))
        return [x or 0.0 for x in weighed.agg(*(F.sum(F.col("w") * F.col(f"p{i}")) for i in range(k))).first()]

    mass = totals(F.lit(1.0))
    whole = sum(mass)
    history: list[list[float]] = []
    since, last = 0, None
    while whole and len(history) < steps:
        rate = F.col("rate")
        for residuals in history[since:]:
            rate = _step(rate, residuals, low, high)
        if len(history) - since == NESTED:
            old = held
            held = scratch.cut(held.withColumn("rate", rate), "rates")
            scratch.drop(old)
            since, rate = len(history), F.col("rate")
        got = totals(rate)
        residuals = [(g - t) / m if m > 1e-9 * whole else 0.0 for g, t, m in zip(got, targets, mass)]
        if max(map(abs, residuals)) < TOLERANCE or (last is not None and max(abs(a - b) for a, b in zip(got, last)) < 1e-6 * whole):
            break
        history.append([round(x, 9) for x in residuals])
        last = got
    return history


def mix(spark: SparkSession, docs: DataFrame, labelled: DataFrame, weights: Mapping[str, float] = TARGETS, anchor: str | None = None, low: float = 0.0, high: float | None = None) -> tuple[DataFrame, Classifier]:
    """``docs`` with n_tokens, posteriors and rate beside its own columns, and the classifier.

    ``labelled`` is (doc_id, domain). ``weights`` are the domains' shares of the expected
    tokens; their total is that of the documents, or, with an ``anchor`` domain, such that
    the anchor's target is a twentieth above what it has. Null and empty texts have no
    tokens; their rate follows from the priors alone. An empty table gives an empty result.
    Columns of ``docs`` named n_tokens, posteriors or rate are replaced.
    """
    scratch = Scratch(spark, "mixing")
    model = Classifier.fit(docs, labelled, list(weights))
    rows = scratch.cut(model.with_posteriors(docs.select("text")).select("n_tokens", "posteriors"), "posteriors")
    shares = [weights[d] / sum(weights.values()) for d in model.domains]
    whole = rows.agg(F.sum("n_tokens")).first()[0] or 0
    if anchor is not None:
        i = model.domains.index(anchor)
        held = rows.agg(F.sum(F.col("n_tokens") * F.col("posteriors")[i])).first()[0] or 0.0
        whole = 1.05 * held / shares[i]
    history = fit_rates(scratch, rows, [s * whole for s in shares], low, high)
    return model.with_posteriors(docs.drop("n_tokens", "posteriors", "rate")).withColumn("rate", rate_of(history, low, high)), model


def apply_rates(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Each row of ``docs`` (with ``rate``) floor(rate) times, and once more for a part of the ids that is the rest of the rate."""
    part = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("mixing")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = (F.floor("rate") + (part < F.col("rate") - F.floor("rate")).cast("int")).cast("int")
    # Written before it is filtered: a filter would be pushed below the scoring, and score each row many times.
    counted = Scratch(docs.sparkSession, "mixing").cut(docs.withColumn("_copies", copies), "copies")
    return counted.filter("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copies", "_copy")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, model = mix(spark, docs, label_domains(table(spark, sf_dir, "labels")))
    best = F.array_position("posteriors", F.array_max("posteriors")).cast("int")
    named = [F.col("posteriors")[i].alias(f"p_{d}") for i, d in enumerate(model.domains)]
    return found.select("doc_id", "n_tokens", *named, F.element_at(F.array(*map(F.lit, model.domains)), best).alias("domain"), "rate")
