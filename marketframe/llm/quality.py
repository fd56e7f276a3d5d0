"""Quality classifier: a byte-level convolutional network in numpy over the whole text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.llm.arrow import add_columns, read_table, remainder, text_buffer

#: Bytes a filter sees, bytes between its places, bytes of a pooling block, blocks of a chunk and between chunks.
WIDTH, STRIDE, BLOCK, CHUNK_BLOCKS, CHUNK_STEP = 8, 2, 64, 4, 3
FILTERS, EMBEDDING, HIDDEN = 24, 8, 12
CHUNK = BLOCK * CHUNK_BLOCKS
THRESHOLD = 0.7


def chunk_count(blocks: np.ndarray) -> np.ndarray:
    """Chunks of 4 blocks, each sharing one with the next, that cover so many blocks."""
    return np.maximum(1, -(-(blocks - 1) // CHUNK_STEP))


def block_layout(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after the other, each filled up with zeros to whole blocks (one at least) and
    followed by a block of zeros, so that no filter sees two texts; blocks of each text."""
    lengths = np.diff(offsets)
    blocks = np.maximum(1, -(-lengths // BLOCK))
    begin = (np.cumsum(blocks + 1) - blocks - 1) * BLOCK
    out = np.zeros(int((blocks + 1).sum()) * BLOCK + WIDTH, np.uint8)
    out[np.repeat(begin - offsets[:-1], lengths) + np.arange(len(data))] = data
    return out, blocks


def sampled_chunks(text: bytes, most: int) -> bytes:
    """Up to ``most`` chunks spread evenly over a text, each with the overhang of the filters."""
    blocks = max(1, -(-len(text) // BLOCK))
    n = int(chunk_count(np.array(blocks)))
    padded = text + bytes((n * CHUNK_STEP + CHUNK_BLOCKS) * BLOCK + WIDTH - len(text))
    picks = sorted({i * (n - 1) // max(1, min(most, n) - 1) for i in range(min(most, n))})
    return b"".join(padded[c * CHUNK_STEP * BLOCK:][: CHUNK + WIDTH] for c in picks)


def all_chunks(text: bytes) -> np.ndarray:
    """Every chunk of a text, a row each, as ``score`` sees them."""
    return np.frombuffer(sampled_chunks(text, len(text) + 1), np.uint8).reshape(-1, CHUNK + WIDTH)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


@dataclass
class QualityNetwork:
    """Embedded bytes, filters, max-pooling over a chunk, a hidden layer and one unit per chunk; mean and maximum of
    the chunks' units make the document's logit.  ``shift`` carries the labels' natural shares."""

    weights: dict[str, np.ndarray]
    shift: float = 0.0

    @classmethod
    def fresh(cls, seed: int) -> "QualityNetwork":
        rng = np.random.default_rng(seed)
        draw = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
        return cls({"embed": draw(0.5, 256, EMBEDDING), "filters": draw((WIDTH * EMBEDDING) ** -0.5, WIDTH * EMBEDDING, FILTERS), "bias": np.zeros(FILTERS, np.float32),
                    "hidden": draw(FILTERS ** -0.5, FILTERS, HIDDEN), "hidden_bias": np.zeros(HIDDEN, np.float32), "unit": draw(HIDDEN ** -0.5, HIDDEN), "unit_bias": np.zeros(1, np.float32), "top": np.array([2.0, 2.0, -2.0], np.float32)})

    def gradients(self, chunks: np.ndarray, doc: np.ndarray, label: np.ndarray, size: int = 1024) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy of documents with these chunks (rows of bytes, document by document).

        The chunks pass in slices of ``size``: first their maxima and units, then, with each
        document's mean and maximum known, their gradients."""
        w, n = self.weights, len(label)
        places = np.arange(0, CHUNK, STRIDE)[:, None] + np.arange(WIDTH)
        best, pooled = np.empty((len(chunks), FILTERS), np.int64), np.empty((len(chunks), FILTERS), w["filters"].dtype)
        for i in range(0, len(chunks), size):
            part = chunks[i: i + size]
            response = w["embed"][part[:, places]].reshape(len(part), len(places), -1) @ w["filters"]
            best[i: i + size] = response.argmax(1)
            pooled[i: i + size] = np.take_along_axis(response, best[i: i + size, None], 1)[:, 0] + w["bias"]
        active = np.maximum(pooled, 0)
        hidden = np.tanh(active @ w["hidden"] + w["hidden_bias"])
        unit = _sigmoid(hidden @ w["unit"] + w["unit_bias"])
        per_doc = np.bincount(doc, minlength=n)
        mean = np.bincount(doc, unit, n) / per_doc
        order = np.lexsort((unit, doc))
        highest = order[np.cumsum(per_doc) - 1]
        p = _sigmoid(w["top"][0] * mean + w["top"][1] * unit[highest] + w["top"][2])
        d_logit = (p - label) / n
        out = {"top": np.array([d_logit @ mean, d_logit @ unit[highest], d_logit.sum()], np.float32)}
        d_unit = (d_logit * w["top"][0] / per_doc)[doc]
        d_unit[highest] += d_logit * w["top"][1]
        d_unit = (d_unit * unit * (1 - unit)).astype(np.float32)
        out["unit"], out["unit_bias"] = hidden.T @ d_unit, d_unit.sum(keepdims=True)
        d_hidden = d_unit[:, None] * w["unit"] * (1 - hidden * hidden)
        out["hidden"], out["hidden_bias"] = active.T @ d_hidden, d_hidden.sum(0)
        d_pooled = (d_hidden @ w["hidden"].T) * (pooled > 0)
        out["bias"] = d_pooled.sum(0)
        out["filters"], out["embed"] = np.zeros_like(w["filters"]), np.zeros_like(w["embed"])
        for i in range(0, len(chunks), size):
            part, d_part = chunks[i: i + size], d_pooled[i: i + size]
            bytes_seen = part[np.arange(len(part))[:, None, None], places[best[i: i + size]]]     # chunk, filter, window
            at_best = w["embed"][bytes_seen].reshape(len(part), FILTERS, -1)
            out["filters"] += np.einsum("cf,cfx->xf", d_part, at_best)
            d_seen = (d_part[:, :, None] * w["filters"].T).reshape(-1, EMBEDDING)
            for e in range(EMBEDDING):
                out["embed"][:, e] += np.bincount(bytes_seen.ravel(), d_seen[:, e], 256)
        return out

    def fit(self, documents: list[np.ndarray], labels: np.ndarray, steps: int, batch: int, seed: int) -> None:
        """Adam on batches with as many documents of either label."""
        rng, w = np.random.default_rng(seed), self.weights
        groups = [np.flatnonzero(labels == k) for k in (0, 1)]
        first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
        for t in range(1, steps + 1):
            picks = np.concatenate([rng.choice(g, batch // 2) for g in groups])
            chunks = [documents[i] for i in picks]
            got = self.gradients(np.concatenate(chunks), np.repeat(np.arange(batch), [len(c) for c in chunks]), labels[picks].astype(np.float64))
            rate = 0.01 * min(1, 2 * (1 - t / (steps + 1)))
            for k, g in got.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                w[k] -= (rate * (first[k] / (1 - 0.9 ** t)) / (np.sqrt(second[k] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each text, from all its bytes."""
        w = self.weights
        laid, blocks = block_layout(data, offsets)
        n_blocks = int((blocks + 1).sum())
        # a filter's response is a sum over its bytes: one table of 256 rows per byte of the window
        tables = np.einsum("be,wef->wbf", w["embed"], w["filters"].reshape(WIDTH, EMBEDDING, FILTERS)).astype(np.float32)
        pooled = np.empty((n_blocks, FILTERS), np.float32)
        for i in range(0, n_blocks, 1024):
            j = min(n_blocks, i + 1024)
            part = laid[i * BLOCK: j * BLOCK + WIDTH]
            size = (j - i) * BLOCK
            response = tables[0][part[0: size: STRIDE]]
            for k in range(1, WIDTH):
                response += tables[k][part[k: size + k: STRIDE]]
            pooled[i:j] = response.reshape(j - i, BLOCK // STRIDE, FILTERS).max(1)
        chunks = chunk_count(blocks)
        doc = np.repeat(np.arange(len(blocks)), chunks)
        number = np.arange(len(doc)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        first = np.cumsum(blocks + 1) - blocks - 1
        begin, end = np.repeat(first, chunks) + CHUNK_STEP * number, np.repeat(first + blocks, chunks)
        nothing = tables[:, 0].sum(0)                # the response to zeros, past the text's end
        top = pooled[begin]
        for k in range(1, CHUNK_BLOCKS):
            top = np.maximum(top, np.where((begin + k < end)[:, None], pooled[np.minimum(begin + k, end - 1)], nothing))
        hidden = np.tanh(np.maximum(top + w["bias"], 0) @ w["hidden"] + w["hidden_bias"])
        unit = _sigmoid(hidden @ w["unit"] + w["unit_bias"])
        mean = np.bincount(doc, unit, len(blocks)) / chunks
        highest = np.maximum.reduceat(unit, np.cumsum(chunks) - chunks) if len(blocks) else mean
        return _sigmoid(w["top"][0] * mean + w["top"][1] * highest + w["top"][2] + self.shift)


@dataclass
class Constant:
    """Where a label is missing there is nothing to learn: every text gets label 1's share."""

    share: float

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return np.full(len(offsets) - 1, self.share)


def train(docs: DataFrame, labels: DataFrame, per_label: int = 1500, steps: int = 600, batch: int = 32, seed: int = 7) -> QualityNetwork | Constant:
    """Learn ``quality`` (0 or 1) of ``labels`` (doc_id, quality) from the texts of ``docs``.

    The network is fitted on the driver on a bounded sample: of each label the
    ``per_label`` rows whose id hashes lowest, each with all chunks of its text, so that
    a text has the same mean and maximum here as in scoring.  The sampled texts are held
    on the driver.  Its prior is the share of the labels over all rows.
    Rows without a 0 or 1, and ids without a document, teach nothing; of an id labelled
    twice each label counts.  Without rows of both labels every text scores label 1's
    share, 1 if there are none.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("quality in (0, 1) and doc_id is not null")
    counts = {r.quality: r.n for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    zeros, ones = counts.get(0, 0), counts.get(1, 0)
    if not zeros or not ones:
        return Constant((ones + 1) / (zeros + ones + 1))
    sample = None
    for k in (0, 1):
        part = known.where(F.col("quality") == k).orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(per_label)
        sample = part if sample is None else sample.unionAll(part)

    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
            .join(F.broadcast(sample), "doc_id")                     # 2 * per_label ids
            .select("doc_id", "quality", "text").collect())
    rows.sort(key=lambda r: (r.doc_id, r.quality, r.text))
    targets = np.array([r.quality for r in rows])
    if len(set(targets.tolist())) < 2:
        return Constant((ones + 1) / (zeros + ones + 1))
    network = QualityNetwork.fresh(seed)
    network.fit([all_chunks(r.text.encode()) for r in rows], targets, steps, batch, seed)
    network.shift = float(np.log(ones / zeros))
    return network


def score_quality(docs: DataFrame, model: QualityNetwork | Constant, text: str = "text") -> DataFrame:
    """``docs`` plus quality_score (0 to 1, higher: label 1 likelier) of every whole text.

    Null and empty texts score as one empty chunk; repeated rows score alike; a column
    with this name is replaced; an empty table gives no rows.  The network is a few
    thousand numbers; documents are not shuffled.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return add_columns(docs, "quality_score double", lambda texts: [pa.array(sent.value.score(*text_buffer(texts)), pa.float64())], text)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from labels outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2)
    scored = score_quality(docs, train(docs, labels))
    return scored.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), F.col("quality_score").alias("score"),
                         F.when(F.col("quality_score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
