"""Language ID by multilingual mixture inference.

Each language is a multinomial over byte trigrams of lower-cased letters and other signs
outside ASCII, counted by the tasks and summed by Spark. A text is taken as a mixture of languages: expectation
maximisation fits the shares for the language set of every size (the strongest of the
mixture of all), and the set with the best penalised likelihood is selected. EM runs on a
batch of texts at once, over the distinct trigrams of each.

The model's size depends on the alphabet of trigrams and the number of languages alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sliced, table

#: Classes of bytes: 0 no letter, 1 to 26 letters, 27 to 90 continuation bytes, then lead bytes by script.
CLASSES = 96
GRAMS = CLASSES**3
SMOOTHING = 0.2
EM_STEPS = 10
#: Log-likelihood that one more language of the set must gain, in multiples of the log of the text's trigrams.
PENALTY = 3.0
BATCH_TEXTS = 256
UNKNOWN = "und"
_WORD_SIGN = re.compile(r"[^\W\d_]")
_CLASS = np.zeros(256, np.int64)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[0x80:0xC0] = np.arange(27, 91)
_CLASS[0xC0:0x100] = [91] * 16 + [92] * 8 + [93] * 8 + [94] * 16 + [95] * 16


def has_letter(text: str) -> bool:
    """Whether a character is of a Unicode category of letters; number signs such as one half are not."""
    return any(m[0].isalpha() for m in _WORD_SIGN.finditer(text))


def grams(text: str) -> np.ndarray:
    """Codes of the trigrams around each ASCII letter and each byte of a sign outside ASCII; a text's ends count as no letters."""
    c = _CLASS[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)]
    mid = c[1:-1]
    return ((c[:-2] * CLASSES + mid) * CLASSES + c[2:])[mid > 0]


def fold_of(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % folds, F.lit(0))


class Model:
    """Languages in alphabetic order, and the log-probability of each trigram in each."""

    def __init__(self, languages: list[str], logp: np.ndarray):
        self.languages, self.logp = languages, logp

    @classmethod
    def fit(cls, docs: DataFrame) -> Model:
        """From (text, lang) without nulls; a language without a letter in its texts is left out."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts: dict[str, np.ndarray] = {}
            for batch in batches:
                for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    ids, n = np.unique(grams(text), return_counts=True)
                    if lang not in counts:
                        counts[lang] = np.zeros(GRAMS, np.int64)
                    counts[lang][ids] += n
            for lang, held in counts.items():
                ids = np.flatnonzero(held)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(ids), pa.string()), pa.array(ids.astype(np.int32)), pa.array(held[ids])], names=["lang", "gram", "n"])

        found = docs.select(F.col("text").cast("string"), F.col("lang").cast("string")).mapInArrow(run, "lang string, gram int, n long")
        got = found.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()  # bounded: trigrams times languages
        names = np.array(got.column(0).to_pylist(), object)
        languages = sorted(set(names.tolist()))
        logp = np.zeros((len(languages), GRAMS), np.float64)
        for i, lang in enumerate(languages):
            at = names == lang
            logp[i, got.column(1).to_numpy()[at]] = got.column(2).to_numpy()[at]
        seen = max(1, int((logp.sum(0) > 0).sum()))
        logp += SMOOTHING
        logp /= logp.sum(1, keepdims=True) - SMOOTHING * (GRAMS - seen)
        return cls(languages, np.log(logp).T.astype(np.float32).copy())

    def mixtures(self, texts: list[str | None]) -> list[tuple[str, float, list[tuple[str, float]]]]:
        """(language, score, selected languages with their shares) of each text."""
        out: list = [(UNKNOWN, 0.0, [])] * len(texts)
        if not self.languages:
            return out
        found, counts, places = [], [], []
        for i, text in enumerate(texts):
            if text and has_letter(text):
                ids, n = np.unique(grams(text), return_counts=True)
                if len(ids):
                    found.append(ids)
                    counts.append(n)
                    places.append(i)
        if not places:
            return out
        starts = np.cumsum([0, *map(len, found)])[:-1]
        sizes = np.array([len(x) for x in found])
        n = np.concatenate(counts).astype(np.float64)
        logp = self.logp[np.concatenate(found)].astype(np.float64)
        top = logp.max(1)
        p = np.exp(logp - top[:, None])
        total = np.add.reduceat(n, starts)
        base = np.add.reduceat(n * top, starts)
        k = len(self.languages)

        def em(shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            for _ in range(EM_STEPS):
                mix = p * np.repeat(shares, sizes, 0)
                mix *= (n / np.maximum(mix.sum(1), 1e-300))[:, None]
                shares = np.add.reduceat(mix, starts) / total[:, None]
            mix = np.einsum("ij,ij->i", p, np.repeat(shares, sizes, 0))
            return shares, base + np.add.reduceat(n * np.log(np.maximum(mix, 1e-300)), starts)

        full, fit = em(np.full((len(places), k), 1 / k))
        order = np.argsort(-full, axis=1, kind="stable")
        best, best_fit = full, fit - PENALTY * k * np.log(total + 1)
        rank = np.argsort(order, axis=1)
        for m in range(k - 1, 0, -1):
            some, fit = em(np.where(rank < m, 1 / m, 0.0))
            fit = fit - PENALTY * m * np.log(total + 1)
            better = fit > best_fit
            best, best_fit = np.where(better[:, None], some, best), np.maximum(fit, best_fit)
        for i, chosen, whole in zip(places, best, full):
            first = int(np.argmax(chosen))
            kept = sorted(((self.languages[j], float(chosen[j])) for j in np.flatnonzero(chosen > 0)), key=lambda x: (-x[1], x[0]))
            out[i] = (self.languages[first], float(min(1.0, whole[first])), kept)
        return out


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and shares (selected languages) beside its own columns.

    Null texts and texts without a letter are ``und`` with score 0 and no shares. The score
    is the language's share in the mixture of all languages. Columns of these names that
    ``docs`` has already are replaced.
    """
    docs = docs.drop("lang_pred", "score", "shares")
    position = docs.columns.index(text)
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.logp))
    shares = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Model(*sent.value)
        for batch in sliced(batches, BATCH_TEXTS):
            got = held.mixtures(batch.column(position).to_pylist())
            extra = [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array([[{"lang": a, "share": b} for a, b in g[2]] for g in got], shares)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "lang_pred", "score", "shares"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, lang_pred string, score double, shares array<struct<lang: string, share: double>>")


def learned(docs: DataFrame) -> Model:
    """From the rows with a language and a text that are not in fold 2 of 4."""
    return Model.fit(docs.filter((fold_of("doc_id", 4) != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learned(docs)
    found = identify(docs.select("doc_id", (fold_of("doc_id", 4) == 2).alias("held_out"), F.col("text").cast("string").alias("text")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")
