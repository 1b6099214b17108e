"""From raw documents to token files: five stages over the training-data operators.

Each stage works on all rows that the one before it kept and its decisions take effect. All
but the last return the columns of the documents they were given, whatever their names; the
last returns the digests read back from the written token files.

In every stage rows that repeat a doc_id are judged apart, each by its own text, and repeated
rows alike; an empty table gives an empty one; texts are processed whole at any length. Null
and empty texts, and texts without a letter, are rejected by the first stage; a later stage
that meets them keeps them. Rows without doc_id are judged like others, but take part in no
near-duplicate group. Ties go to the smaller doc_id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import Scratch, table
from ledgerloom.llm.decontaminate import decontaminate
from ledgerloom.llm.language_id import UNKNOWN, identify, learned
from ledgerloom.llm.mixing import apply_rates, label_domains, mix
from ledgerloom.llm.ngram_join import one_of_each
from ledgerloom.llm.token_output import read_digests, write_tokens
from ledgerloom.session import ship

#: A document whose strongest language holds less than this share of the mixture is rejected.
LEAST_SHARE = 0.35
#: Shares of tokens by domain; the fit only thins out domains that hold more beside clean text.
DOMAIN_SHARES = {"clean": 0.93, "junk": 0.05, "toxic": 0.02}


#: Columns that the operators read; all others pass under private names, so that none clashes with what an operator adds.
READ = ("doc_id", "text", "lang")


def _private(docs: DataFrame) -> dict[str, str]:
    return {c: f"_own_{i}" for i, c in enumerate(docs.columns) if c not in READ}


def _aside(docs: DataFrame) -> DataFrame:
    return docs.withColumnsRenamed(_private(docs))


def _back(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` under their own names."""
    names = _private(docs)
    return found.select(*(F.col(names.get(c, c)).alias(c) for c in docs.columns))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter, null texts, and mixtures in which no language holds its share."""
    found = identify(_aside(docs), learned(docs))
    return _back(found.filter((found.lang_pred != UNKNOWN) & (found.score >= LEAST_SHARE)), docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: five-word shingles, similarity of 0.8 or more."""
    return _back(one_of_each(spark, _aside(docs), size=5, percent=80), docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item, or all words of a shorter one, go."""
    return _back(decontaminate(spark, _aside(docs), table(spark, sf_dir, "benchmark")), docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rates between 0 and 1 bring junk and toxic text down to their shares; clean text has rate 1 and stays."""
    found, _ = mix(spark, _aside(docs), label_domains(table(spark, sf_dir, "labels")), DOMAIN_SHARES, anchor="clean", high=1.0)
    return _back(apply_rates(found), docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and returns doc_id, start, n_tokens and ids_crc32 as read back from them."""
    path = Scratch(spark, "pipeline-tokens").path("tokens")
    write_tokens(spark, docs, path)
    return read_digests(spark, path)


def _shipped(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    return lambda spark, docs, sf_dir: stage(ship(spark), docs, sf_dir)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", _shipped(language_id)),
    ("ngram_jaccard_join", _shipped(ngram_jaccard_join)),
    ("benchmark_decontamination", _shipped(benchmark_decontamination)),
    ("mixing", _shipped(mixing)),
    ("token_output", _shipped(token_output)),
]

#: Language ID and mixing learn models, which SQL can't express; the tests hold stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
