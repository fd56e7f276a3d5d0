"""Language-model scores: counts and base against plain Python, normalisation, held-out gain."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from marketframe.llm.arrow import text_buffer
from marketframe.llm.lm_scores import CLASSES, CONTEXT, END, OWN, LogBilinear, learn_vocabulary, op5_lm_scores, score_texts, sequences, tail_class, train_model, word_counts
from marketframe.llm.textscan import NOT_SPACE, scan_words, word_hashes

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def plain(docs, train):
    counts = Counter(t for (_, text), learn in zip(docs, train) if learn for t in tokens(text))
    total, words = sum(counts.values()), len(counts)
    out = []
    for _, text in docs:
        ts = tokens(text)
        out.append((len(ts), sum(counts[t] > 0 for t in ts), total, sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (words + 1))) for t in ts)))
    return out


def test_op5_against_plain_counts(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = {r.doc_id: r for r in op5_lm_scores(spark, SMALL).collect()}
    held = [zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in docs]
    assert len(got) == len(docs)
    for (d, _), h, (n, known, total, base) in zip(docs, held, plain(docs, [not h for h in held])):
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, n, known, total)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base)) and r.score < 0
    assert sum(got[d].score for (d, _), h in zip(docs, held) if h) > sum(got[d].base_score for (d, _), h in zip(docs, held) if h)


def test_context_and_classes():
    context, target, row = sequences(np.array([3, 4, 5]), np.array([0, 2, 2, 3]))
    assert target.tolist() == [3, 4, END, END, 5, END] and row.tolist() == [0, 0, 0, 1, 2, 2]
    assert context[:3].tolist() == [[END, END, END], [3, END, END], [4, 3, END]] and context[5].tolist() == [5, END, END]


def test_training_lowers_the_loss_and_probabilities_are_normalised():
    rng = np.random.default_rng(0)
    target = np.tile(np.array([1, 2, 3, 4, 70, 90]), 4000)
    target[rng.random(len(target)) < 0.1] = 5
    context, target, _ = sequences(target, np.array([0, len(target)]))
    noise = np.bincount(target, minlength=CLASSES) + 0.5
    model = LogBilinear(noise / noise.sum())
    before = model.log10_probability(context, target).mean()
    for _ in range(3):
        model.train(context, target, rng, {k: np.full(v.shape, 1e-6) for k, v in model.p.items()})
    assert model.log10_probability(context, target).mean() > before / 2
    same = np.repeat(context[:1], CLASSES, axis=0)
    assert abs((10 ** model.log10_probability(same, np.arange(CLASSES))).sum() - 1) < 1e-4
    other = LogBilinear(model.noise, seed=9)
    other.load(model.flat())
    assert np.allclose(other.log10_probability(context[:50], target[:50]), model.log10_probability(context[:50], target[:50]))


def test_scores_equal_the_definition(spark):
    """Class probabilities of the trained model times the word's share of its class, for every text."""
    docs = [(1, "the cat sat on the mat " * 5), (2, "the dog sat"), (3, "Unseen words here the"), (4, ""), (5, None), (6, "x" * 70_000), (2, "the dog sat"), (None, "the end")]
    frame = spark.createDataFrame([(d, t, 1.0) for d, t in docs], "doc_id long, text string, score double").repartition(2)
    train = F.col("doc_id") != 3
    got = score_texts(frame, train).collect()
    learnt = [d is not None and d != 3 for d, _ in docs]
    expected = plain(docs, learnt)
    rows = frame.select(F.coalesce(train, F.lit(False)).alias("train"), F.coalesce("text", F.lit("")).alias("text"))
    counts = word_counts(rows)
    v = learn_vocabulary(rows, counts)
    model = train_model(rows, v)
    count_of = {r.h: r.learnt for r in counts.collect()}
    for (d, text), (n, known, total, base) in zip(docs, expected):
        r = next(r for r in got if r.doc_id == d)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total) and abs(r.base_score - base) < 1e-6 * max(1, abs(base))
        folded, s, e, first = scan_words(*text_buffer(pa.array([text or ""])), NOT_SPACE)
        h = word_hashes(folded, s, e)
        classes = v.classes(h, tail_class(folded, s, e))
        total_log = model.log10_probability(*sequences(classes, first)[:2]).sum()
        for x, c in zip(h.view(np.int64).tolist(), classes.tolist()):
            if c >= OWN:
                total_log += math.log10((count_of[x] + 0.5) / (v.tail_tokens[c - OWN] + 0.5 * (v.tail_words[c - OWN] + 1)))
        assert abs(r.score - total_log) < 0.02 * max(1, abs(total_log))      # tasks may be dealt otherwise in training
    assert len(got) == len(docs) and CONTEXT == 3


def test_rare_words_meet_their_counts_in_the_join(spark, monkeypatch):
    from marketframe.llm import lm_scores
    docs = [(i, " ".join(f"w{j}" for j in range(i % 7, 90, 1 + i % 3))) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    whole = {r.doc_id: r for r in score_texts(frame, F.col("doc_id") % 4 != 1).collect()}
    monkeypatch.setattr(lm_scores, "FREQUENT", 70)
    few = {r.doc_id: r for r in score_texts(frame, F.col("doc_id") % 4 != 1).collect()}
    for d, r in whole.items():
        assert r.n_known == few[d].n_known and abs(r.base_score - few[d].base_score) < 1e-9 and abs(r.score - few[d].score) < 1e-6


def test_empty_and_nothing_to_learn(spark):
    frame = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert score_texts(frame.limit(0), F.lit(True)).count() == 0
    got = {r.doc_id: r for r in score_texts(frame, F.lit(False)).collect()}
    assert (got[1].n_tokens, got[1].n_known, got[1].train_tokens, got[1].base_score) == (3, 0, 0, 0.0) and math.isfinite(got[2].score)
