"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.llm.arrow import add_columns, read_table, remainder

ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
_MAYBE_LETTER = re.compile(r"[^\W\d_]")
_FACTORS = np.array([2654435761, 2246822519, 3266489917], np.uint32)


def has_letter(text: str | None) -> bool:
    if not text:
        return False
    found = _MAYBE_LETTER.search(text)
    return found is not None and (found[0].isalpha() or any(map(str.isalpha, text)))


def ngram_buckets(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the buckets of all n-grams (lower-cased) of whole texts, text by text, and
    how many each text has; no n-gram crosses texts."""
    lower = [(t or "").lower() for t in texts]
    chars = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t) for t in lower], np.int64)
    ends = np.cumsum(lengths)
    for order in ORDERS:
        n = max(0, len(chars) - order + 1)
        h = np.full(n, order * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for k in range(order):
            h = (h ^ chars[k: n + k]) * _FACTORS[k]
            h ^= h >> np.uint32(15)
        whole = np.ones(len(chars), bool)
        for k in range(1, order):                # the last places of a text begin none
            whole[np.maximum(ends - k, 0)[lengths >= k]] = False
        yield (h >> np.uint32(32 - BUCKETS.bit_length() + 1))[whole[:n]], np.maximum(lengths - order + 1, 0)


@dataclass
class LanguageModel:
    languages: list[str]
    log_prior: np.ndarray       # by language
    log_prob: np.ndarray        # bucket x language

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The likeliest language and its posterior probability; ``und`` with 0 where nothing can be said."""
        total = np.tile(self.log_prior, (len(texts), 1))
        if self.languages:
            for bucket, count in ngram_buckets(texts):
                some = np.flatnonzero(count)
                if len(some):                    # only the rows of the matrix that occur
                    total[some] += np.add.reduceat(self.log_prob[bucket], (np.cumsum(count) - count)[some], axis=0, dtype=np.float64)
        sure = np.array([has_letter(t) for t in texts], bool) & bool(self.languages)
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        best = total.argmax(1)
        posterior = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        return [self.languages[b] if s else "und" for b, s in zip(best, sure)], np.where(sure, posterior, 0.0)


def train(docs: DataFrame, smoothing: float = 0.5) -> LanguageModel:
    """Learn from all rows of ``docs`` (text, lang) with a language.

    Each task adds its rows' n-gram counts up and sends one row per language and
    bucket it saw; the sums, 32,768 numbers per language, come to the driver.  Null
    texts count for the prior only; other columns are not read.  No rows: a model that answers ``und``.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}        # the last number: rows

        def rows() -> Iterator[pa.RecordBatch]:
            for name, counts in held.items():
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], names=["lang", "bucket", "n"])
            held.clear()

        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1)
            for name in sorted(set(names)):
                mine = pa.array([i for i, x in enumerate(names) if x == name])
                counts = held.setdefault(name, np.zeros(BUCKETS + 1, np.int64))
                counts[BUCKETS] += len(mine)
                for k in range(0, len(mine), 256):
                    for bucket, _ in ngram_buckets(texts.take(mine[k: k + 256]).to_pylist()):
                        counts[:BUCKETS] += np.bincount(bucket, minlength=BUCKETS)
            if len(held) > 64:                   # many languages: bounded memory
                yield from rows()
        yield from rows()

    labelled = docs.where("lang is not null").select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    sums = labelled.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(sums["lang"].unique())
    table = np.zeros((BUCKETS + 1, len(languages)))
    table[sums["bucket"].to_numpy(np.int64), np.searchsorted(languages, sums["lang"].to_numpy(object).astype(str)) if languages else []] = sums["n"].to_numpy(np.float64)
    counts = table[:BUCKETS] + smoothing
    prior = table[BUCKETS] / max(table[BUCKETS].sum(), 1)
    return LanguageModel(languages, np.log(np.maximum(prior, 1e-300)), np.log(counts / counts.sum(0)).astype(np.float32))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` plus lang_pred and lang_score (0 to 1) from every whole text.

    Null texts and texts without a letter get ``und`` and 0; equal scores go to the
    language first in order; repeated rows score alike; columns with these names are
    replaced; an empty table gives no rows.  The model has 32,768 numbers per language.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def predict(texts: pa.Array) -> list[pa.Array]:
        names, score = sent.value.predict(texts.to_pylist())
        return [pa.array(names, pa.string()), pa.array(score, pa.float64())]

    return add_columns(docs, "lang_pred string, lang_score double", predict, text, slice_bytes=1 << 20)


def training_rows(docs: DataFrame) -> DataFrame:
    """The rows a query may learn from: crc32(doc_id as text) mod 3 is not 1."""
    return docs.where(remainder("doc_id", 3) != 1)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learnt from two thirds of them."""
    docs = read_table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), train(training_rows(docs)))
    return found.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
