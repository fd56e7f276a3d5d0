"""Log-bilinear language model: trained by noise-contrastive estimation on all training rows, normalised scores.

Tokens are lower-cased words and one end per document.  The model predicts a token's
class from the classes of the three tokens before it; a class is one of the 64 most
frequent words, the end, or the words whose last two bytes hash alike.  Inside a class
a word has its smoothed share of the class's training tokens, so the probabilities
of all words and one unknown word per class add up to one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.llm.arrow import Scratch, read_table, remainder, row_slices, text_buffer
from marketframe.llm.textscan import NOT_SPACE, mixed, scan_words, word_hashes

#: Words with a class of their own, hashed classes of the others, and the class of the end.
OWN, TAILS = 64, 190
END = OWN + TAILS
CLASSES = END + 1
CONTEXT, WIDTH, NOISE, BATCH = 3, 16, 64, 4096
#: Words whose counts go to every task; the others' counts are joined.
FREQUENT = 1 << 18
_SLICE = 1 << 21


def tail_class(folded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashed class of words by their last two bytes, from 0 on."""
    last = folded[ends - 1].astype(np.uint64)
    second = np.where(ends - starts > 1, folded[np.maximum(ends - 2, 0)], 0).astype(np.uint64)
    return (mixed(last << np.uint64(8) | second) % np.uint64(TAILS)).astype(np.int64)


@dataclass
class Vocabulary:
    """What every task knows of the corpus: the most frequent words with their training counts, the words
    with classes of their own, and for each hashed class its training tokens and distinct words."""

    hashes: np.ndarray          # sorted
    counts: np.ndarray
    own: np.ndarray             # sorted hashes of words with a class of their own
    own_counts: np.ndarray
    tail_tokens: np.ndarray
    tail_words: np.ndarray
    ends: int
    tokens: int                 # N
    words: int                  # V

    def classes(self, h: np.ndarray, tail: np.ndarray) -> np.ndarray:
        out = OWN + tail
        if len(self.own):
            slot = np.minimum(np.searchsorted(self.own, h), len(self.own) - 1)
            out = np.where(self.own[slot] == h, slot, out)
        return out

    def noise(self) -> np.ndarray:
        """Smoothed shares of the classes."""
        n = np.full(CLASSES, 0.5)
        n[: len(self.own_counts)] += self.own_counts
        n[OWN:END] += self.tail_tokens
        n[END] += self.ends
        return n / n.sum()


class LogBilinear:
    """q = sum of context vectors times a matrix per position; a class scores q . Q + b."""

    def __init__(self, noise: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.noise = noise
        self.p = {"R": rng.normal(0, 0.1, (CLASSES, WIDTH)), "C": np.stack([np.eye(WIDTH) * 0.5 ** j for j in range(CONTEXT)]),
                  "Q": rng.normal(0, 0.1, (CLASSES, WIDTH)), "b": np.log(noise)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)]).astype(np.float64)

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for k in sorted(self.p):
            n = self.p[k].size
            self.p[k] = flat[at: at + n].reshape(self.p[k].shape).astype(np.float32)
            at += n

    def train(self, context: np.ndarray, target: np.ndarray, rng: np.random.Generator, squares: dict, rate: float = 0.1) -> None:
        """One pass of Adagrad over tokens.  A batch shares its noise words, so that all is matrix products."""
        log_kq = np.log(NOISE * self.noise).astype(np.float32)
        drawn = rng.choice(CLASSES, (len(target) // BATCH + 1, NOISE), p=self.noise)
        column = np.arange(WIDTH)

        def by_class(c: np.ndarray, x: np.ndarray) -> np.ndarray:
            return np.bincount((c[:, None] * WIDTH + column).ravel(), x.ravel(), CLASSES * WIDTH).reshape(CLASSES, WIDTH)

        for i in range(0, len(target), BATCH):
            c, w, x = context[i: i + BATCH], target[i: i + BATCH], drawn[i // BATCH]
            R, C, Q, b = self.p["R"], self.p["C"], self.p["Q"], self.p["b"]
            tables = R @ C                                           # position, class, width
            q = tables[0][c[:, 0]]
            for j in range(1, CONTEXT):
                q += tables[j][c[:, j]]
            of_word, of_noise = Q[w], Q[x]
            n = np.float32(len(w))
            d_true = (1 / (1 + np.exp(np.clip(np.einsum("td,td->t", q, of_word) + b[w] - log_kq[w], -30, 30))) / n).astype(np.float32)
            d_noise = -1 / (1 + np.exp(np.clip(log_kq[x] - b[x] - q @ of_noise.T, -30, 30))) / n
            d_q = d_true[:, None] * of_word + d_noise @ of_noise
            grad_Q = by_class(w, d_true[:, None] * q)
            np.add.at(grad_Q, x, d_noise.T @ q)
            d_tables = np.stack([by_class(c[:, j], d_q) for j in range(CONTEXT)])
            grads = {"R": (d_tables @ C.transpose(0, 2, 1)).sum(0), "C": R.T @ d_tables, "Q": grad_Q, "b": np.bincount(w, d_true, CLASSES) + np.bincount(x, d_noise.sum(0), CLASSES)}
            for k, g in grads.items():
                squares[k] += g * g
                self.p[k] += (rate * g / np.sqrt(squares[k] + 1e-8)).astype(np.float32)

    def log10_probability(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Normalised, over all classes, for each token."""
        tables = self.p["R"] @ self.p["C"]
        tables = np.concatenate([tables, np.zeros((CONTEXT, CLASSES, 1), np.float32)], axis=2)
        tables[0, :, WIDTH] = 1                                      # meets the bias
        output = np.concatenate([self.p["Q"], self.p["b"][:, None]], axis=1).T.copy()
        longest = np.sqrt((output ** 2).sum(0)).max()
        out, size = np.empty(len(target), np.float64), 1024
        for i in range(0, len(target), size):
            c, w = context[i: i + size], target[i: i + size]
            q = tables[0][c[:, 0]]
            for j in range(1, CONTEXT):
                q += tables[j][c[:, j]]
            s = q @ output
            if np.sqrt((q * q).sum(1).max()) * longest > 80:         # else no exponential overflows
                s -= s.max(1, keepdims=True)
            picked = s[np.arange(len(w)), w]
            out[i: i + size] = picked - np.log(np.exp(s, out=s).sum(1))
        return out / np.log(10)


def sequences(classes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts, targets and rows of all tokens: each text's words, then its end; before a text stand ends."""
    rows = len(first) - 1
    sizes = np.diff(first) + 1
    begin = np.cumsum(sizes) - sizes
    target = np.full(int(sizes.sum()), END, np.int64)
    row = np.repeat(np.arange(rows), sizes)
    place = np.arange(len(target)) - begin[row]
    target[place < sizes[row] - 1] = classes
    context = np.full((len(target), CONTEXT), END, np.int64)
    for j in range(CONTEXT):
        there = np.flatnonzero(place > j)
        context[there, j] = target[there - j - 1]
    return context, target, row


def _scanned(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For slices of rows [i, j): word hashes, hashed classes and first words."""
    _, offsets = text_buffer(texts)
    for i, j in row_slices(offsets, _SLICE):
        data, own = text_buffer(texts.slice(i, j - i))
        folded, starts, ends, first = scan_words(data, own, NOT_SPACE)
        yield i, j, word_hashes(folded, starts, ends), tail_class(folded, starts, ends), first


def word_counts(rows: DataFrame) -> DataFrame:
    """h, tail, learnt (training tokens) and n (all tokens) of every distinct word of ``rows`` (train, text)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 4), np.int64)

        def summed(x: np.ndarray) -> np.ndarray:
            x = x[np.argsort(x[:, 0], kind="stable")]
            begin = np.flatnonzero(np.concatenate([[True], x[1:, 0] != x[:-1, 0]])) if len(x) else np.zeros(0, np.int64)
            if not len(x):
                return x
            return np.concatenate([x[begin, :2], np.add.reduceat(x[:, 2:], begin, axis=0)], axis=1)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held[:, 0]), pa.array(held[:, 1], pa.int16()), pa.array(held[:, 2]), pa.array(held[:, 3])], names=["h", "tail", "learnt", "n"])

        for batch in batches:
            train = np.array(batch.column(0).to_pylist(), bool)
            for i, j, h, tail, first in _scanned(batch.column(1)):
                unique, at, inverse = np.unique(h, return_index=True, return_inverse=True)
                learnt = np.bincount(inverse, np.repeat(train[i:j], np.diff(first)), len(unique)).astype(np.int64)
                held = np.concatenate([held, np.stack([unique.view(np.int64), tail[at], learnt, np.bincount(inverse, minlength=len(unique))], 1)])
                if len(held) > 1 << 21:
                    held = summed(held)
                    if len(held) > 1 << 20:      # bounded memory: what follows is counted anew
                        yield out()
                        held = held[:0]
        held = summed(held)
        yield out()

    return rows.select("train", "text").mapInArrow(count, "h long, tail short, learnt long, n long").groupBy("h", "tail").agg(F.sum("learnt").alias("learnt"), F.sum("n").alias("n"))


def _least_count(counts: DataFrame, most: int) -> float:
    """A count that at most ``most`` words reach, found on a scale of 64 steps to each doubling."""
    step = F.floor(F.log2("n") * 64).cast("int")
    bins = sorted(((r.step, r.words) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()), reverse=True)
    total, least = 0, float("inf")
    for at, words in bins:
        total += words
        if total > most:
            break
        least = 2 ** (at / 64) * (1 - 1e-12)
    return least


def learn_vocabulary(rows: DataFrame, counts: DataFrame) -> Vocabulary:
    ends = rows.where("train").count()
    top = counts.where(F.col("n") >= _least_count(counts, FREQUENT)).select("h", "learnt").toPandas()
    own = counts.where("learnt > 0").orderBy(F.desc("learnt"), "h").limit(OWN).toPandas()
    tails = counts.where("learnt > 0").join(F.broadcast(counts.sparkSession.createDataFrame([(int(x),) for x in own["h"]], "h long")), "h", "left_anti")
    tails = tails.groupBy("tail").agg(F.sum("learnt").alias("tokens"), F.count("*").alias("words")).toPandas()
    tokens, words = np.zeros(TAILS, np.int64), np.zeros(TAILS, np.int64)
    tokens[tails["tail"].to_numpy(np.int64)], words[tails["tail"].to_numpy(np.int64)] = tails["tokens"], tails["words"]

    def by_hash(frame) -> tuple[np.ndarray, np.ndarray]:
        h = frame["h"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(h)
        return h[order], frame["learnt"].to_numpy(np.int64)[order]

    hashes, learnt = by_hash(pd.concat([top, own[["h", "learnt"]]]).drop_duplicates("h"))
    own_hashes, own_counts = by_hash(own)
    return Vocabulary(hashes, learnt, own_hashes, own_counts, tokens, words, ends, int(tokens.sum() + own_counts.sum()) + ends, int(words.sum()) + len(own) + (ends > 0))


def train_model(rows: DataFrame, vocabulary: Vocabulary, rounds: int = 2, seed: int = 5) -> LogBilinear:
    """Every training text is learnt from once: in each round the tasks start from the same parameters, each
    trains on its share of that round's rows, and the parameters are averaged, weighted by tokens."""
    model = LogBilinear(vocabulary.noise(), seed)
    spark = rows.sparkSession
    for turn in range(rounds):
        sent = spark.sparkContext.broadcast((vocabulary.own, model))

        def learn(batches: Iterator[pa.RecordBatch], sent=sent, turn=turn) -> Iterator[pa.RecordBatch]:
            own, start = sent.value
            local = LogBilinear(start.noise)
            local.load(start.flat())
            finder = Vocabulary(own, own, own, own, own, own, 0, 0, 0)
            rng = np.random.default_rng([seed, turn, TaskContext.get().partitionId()])
            squares, seen = {k: np.full(v.shape, 1e-6) for k, v in local.p.items()}, 0
            for batch in batches:
                for _, _, h, tail, first in _scanned(batch.column(0)):
                    context, target, _ = sequences(finder.classes(h, tail), first)
                    order = rng.permutation(len(target))
                    local.train(context[order], target[order], rng, squares)
                    seen += len(target)
            if seen:
                flat = local.flat()
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat * seen), pa.array(np.full(len(flat), seen), pa.int64())], names=["slot", "v", "n"])

        share = rows.where("train").where(F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(rounds)) == turn).select("text")
        got = share.mapInArrow(learn, "slot int, v double, n long").groupBy("slot").agg((F.sum("v") / F.sum("n")).alias("v")).toPandas()
        if len(got):
            flat = model.flat()
            flat[got["slot"].to_numpy(np.int64)] = got["v"].to_numpy(np.float64)
            model.load(flat)
    return model


def score_texts(docs: DataFrame, train) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score (log10) of every whole text of ``docs``,
    learning from the rows where the Column ``train`` is true.

    Null and empty texts are their end alone; repeated rows are scored (and learnt) each; a row whose
    ``train`` is null is not learnt from; other columns are not read; an empty table gives
    no rows.  Words are compared by 64-bit hash.  The counts of the most frequent
    words, 2^18 at most, go to every task; only rarer words meet their counts in a join, one row per text
    and word, and only sums come back to the texts.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm-scores")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counts = scratch.store(word_counts(rows), "counts")
    vocabulary = learn_vocabulary(rows, counts)
    sent = spark.sparkContext.broadcast((vocabulary, train_model(rows, vocabulary)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, model = sent.value
        inside = np.log10(v.tail_tokens + 0.5 * (v.tail_words + 1))
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            for i, j, h, tail, first in _scanned(batch.column("text")):
                classes = v.classes(h, tail)
                context, target, row = sequences(classes, first)
                slot = np.minimum(np.searchsorted(v.hashes, h), max(len(v.hashes) - 1, 0))
                frequent = v.hashes[slot] == h if len(v.hashes) else np.zeros(len(h), bool)
                c = np.where(frequent, v.counts[slot], 0) if len(v.hashes) else np.zeros(len(h), np.int64)
                word_row = np.repeat(np.arange(j - i), np.diff(first))
                log_c = np.where(frequent, np.log10(c + 0.5), 0.0)
                add = lambda r, x: np.bincount(r, x, j - i)
                base = add(word_row, log_c) + np.log10(v.ends + 0.5)
                tails = classes >= OWN
                own = add(row, model.log10_probability(context, target)) + add(word_row[tails], log_c[tails] - inside[classes[tails] - OWN])
                known = add(word_row, c > 0).astype(np.int64) + (v.ends > 0)
                keys = number + np.arange(j - i)
                number += j - i
                words = np.diff(first)
                nothing = pa.nulls(j - i, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column("doc_id").slice(i, j - i), nothing, pa.array(words + 1), pa.array(known), pa.array(base), pa.array(own)], names=names)
                # a word with a class of its own is among the frequent ones, so the others add alike to both scores
                rare, at = np.unique(np.stack([word_row[~frequent], h[~frequent].view(np.int64)], 1), axis=0, return_counts=True) if (~frequent).any() else (np.zeros((0, 2), np.int64), np.zeros(0, np.int64))
                n, empty = len(rare), pa.nulls(len(rare), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(keys[rare[:, 0]]), pa.nulls(n, pa.int64()), pa.array(rare[:, 1]), pa.array(at, pa.int64()), pa.nulls(n, pa.int64()), empty, empty], names=names)

    names = ["key", "doc_id", "h", "n", "known", "base", "own"]
    made = scratch.store(rows.select("doc_id", "text").mapInArrow(score, "key long, doc_id long, h long, n long, known long, base double, own double"), "scored")
    rare = made.where("h is not null").select("h", "key", "n").join(counts.select("h", "learnt"), "h")
    rest = rare.groupBy("key").agg(F.sum(F.col("n") * F.log10(F.col("learnt") + 0.5)).alias("more"), F.sum(F.when(F.col("learnt") > 0, F.col("n")).otherwise(0)).alias("more_known"))
    out = made.where("h is null").join(rest, "key", "left")
    more, per_token = F.coalesce("more", F.lit(0.0)), float(np.log10(vocabulary.tokens + 0.5 * (vocabulary.words + 1)))
    return out.select("doc_id", F.col("n").alias("n_tokens"), (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
                      (F.col("base") + more - F.col("n") * F.lit(per_token)).alias("base_score"), (F.col("own") + more).alias("score"))


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities of every document, learnt from four fifths of them."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_texts(docs, remainder("doc_id", 5) != 1)
    return scored.select("doc_id", (remainder("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
