"""Quality network: gradients, whole-text scores and held-out accuracy."""

import zlib

import numpy as np
import pyarrow as pa

from marketframe.llm.arrow import text_buffer
from marketframe.llm.quality import (BLOCK, CHUNK, CHUNK_STEP, STRIDE, WIDTH, Constant, QualityNetwork, _sigmoid, chunk_count, op6_quality,
                                     sampled_chunks, score_quality, train)

SF = "/root/testdata/sf0.01"


def plain_units(network, text):
    """Every chunk of a text by the definition, window by window."""
    w, n = network.weights, int(chunk_count(np.array(max(1, -(-len(text) // BLOCK)))))
    padded = np.frombuffer(text + bytes(n * CHUNK + CHUNK + WIDTH), np.uint8)
    out = []
    for c in range(n):
        begin = c * CHUNK_STEP * BLOCK
        places = range(begin, begin + CHUNK, STRIDE)
        pooled = np.max([w["embed"][padded[p: p + WIDTH]].ravel() @ w["filters"] for p in places], axis=0)
        hidden = np.tanh(np.maximum(pooled + w["bias"], 0) @ w["hidden"] + w["hidden_bias"])
        out.append(float(_sigmoid(hidden @ w["unit"] + w["unit_bias"])[0]))
    return np.array(out)


def test_scores_follow_the_definition_over_whole_texts():
    network = QualityNetwork.fresh(3)
    texts = ["", None, "a", "words and words " * 3, "x" * 64, "y" * 65, "Zz é" * 200, "long text " * 700 + "!!!"]
    got = network.score(*text_buffer(pa.array(texts)))
    for t, p in zip(texts, got):
        u, top = plain_units(network, (t or "").encode()), network.weights["top"]
        assert abs(p - _sigmoid(top[0] * u.mean() + top[1] * u.max() + top[2])) < 1e-4
    assert len(network.score(*text_buffer(pa.array([], pa.string())))) == 0


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    network = QualityNetwork.fresh(2)
    network.weights = {k: v.astype(np.float64) for k, v in network.weights.items()}
    chunks = rng.integers(97, 123, (5, CHUNK + WIDTH)).astype(np.uint8)
    doc, label = np.array([0, 0, 1, 2, 2]), np.array([1.0, 0.0, 1.0])

    def loss():
        w, total = network.weights, 0.0
        units = np.array([plain_units_of_chunk(network, c) for c in chunks])
        for d in range(3):
            u = units[doc == d]
            p = _sigmoid(w["top"][0] * u.mean() + w["top"][1] * u.max() + w["top"][2])
            total -= label[d] * np.log(p) + (1 - label[d]) * np.log(1 - p)
        return total / 3

    got = network.gradients(chunks, doc, label)
    for name, w in network.weights.items():
        flat = w.reshape(-1)
        where = np.argmax(np.abs(got[name].reshape(-1)))
        kept, e = flat[where], 1e-5
        flat[where] = kept + e
        up = loss()
        flat[where] = kept - e
        down = loss()
        flat[where] = kept
        assert abs((up - down) / (2 * e) - got[name].reshape(-1)[where]) < 2e-4 + 0.02 * abs(got[name].reshape(-1)[where]), name


def plain_units_of_chunk(network, chunk):
    w = network.weights
    pooled = np.max([w["embed"][chunk[p: p + WIDTH]].ravel() @ w["filters"] for p in range(0, CHUNK, STRIDE)], axis=0)
    hidden = np.tanh(np.maximum(pooled + w["bias"], 0) @ w["hidden"] + w["hidden_bias"])
    return float(_sigmoid(hidden @ w["unit"] + w["unit_bias"])[0])


def test_sampled_chunks():
    text = bytes(range(33, 120)) * 30
    cut = sampled_chunks(text, 4)
    assert len(cut) == 4 * (CHUNK + WIDTH) and cut[: CHUNK + WIDTH] == text[: CHUNK + WIDTH]
    assert len(sampled_chunks(b"", 4)) == CHUNK + WIDTH


def test_op6_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op6_quality(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in held) >= 0.9 * len(held)


def test_edges(spark):
    docs = spark.createDataFrame([(1, "good words", "x"), (2, None, "x"), (2, None, "x"), (None, "z" * 50_000, None)], "doc_id long, text string, quality_score string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert train(docs, none) == Constant(1.0)
    assert [r.quality_score for r in score_quality(docs, Constant(0.25)).collect()] == [0.25] * 4
    one_sided = spark.createDataFrame([(1, 1), (2, None), (None, 0), (3, 5)], "doc_id long, quality int")
    assert train(docs, one_sided) == Constant(1.0)
    absent = spark.createDataFrame([(1, 1), (77, 0)], "doc_id long, quality int")
    assert train(docs, absent) == Constant(2 / 3)
    model = train(docs, spark.createDataFrame([(1, 1), (1, 1), (2, 0)], "doc_id long, quality int"), steps=3)
    assert isinstance(model, QualityNetwork)
    got = score_quality(docs, model)
    assert got.columns == ["doc_id", "text", "quality_score"] and len({r.quality_score for r in got.collect()}) == 3
    assert score_quality(docs.limit(0), model).count() == 0


def test_training_sees_the_chunks_that_scoring_sees(spark, monkeypatch):
    """Every chunk of a long labelled text reaches the fit, and the slices of the gradients change nothing."""
    rng = np.random.default_rng(4)
    texts = ["", "a", "x" * 256, "y" * 257] + ["".join(map(chr, rng.integers(97, 123, n))) for n in (900, 5000, 14_000)]
    seen = {}

    def fit(self, documents, labels, *rest):
        seen.update(documents=documents, labels=labels)

    monkeypatch.setattr(QualityNetwork, "fit", fit)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    train(docs, spark.createDataFrame([(i, i % 2) for i in range(len(texts))], "doc_id long, quality int"))
    network = QualityNetwork.fresh(3)
    for text, chunks in zip(texts, seen["documents"]):
        units = np.array([plain_units_of_chunk(network, c) for c in chunks])
        assert len(units) == chunk_count(np.array(max(1, -(-len(text) // BLOCK))))
        assert np.abs(units - plain_units(network, text.encode())).max() < 1e-6
    chunks, doc = np.concatenate(seen["documents"]), np.repeat(np.arange(len(texts)), [len(c) for c in seen["documents"]])
    whole, parts = (network.gradients(chunks, doc, seen["labels"].astype(np.float64), size) for size in (1 << 20, 7))
    for name, g in whole.items():
        assert np.abs(g - parts[name]).max() <= 1e-5 + 1e-4 * np.abs(g).max(), name
