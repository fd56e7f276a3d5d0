"""Near-duplicate documents: improved consistent weighted sampling over TF-IDF shingles."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.llm.arrow import Scratch, read_table, row_slices, text_buffer
from marketframe.llm.graph import components
from marketframe.llm.textscan import mixed, scan_words, shingle_hashes, word_hashes

SHINGLE, SIMILARITY = 5, 0.8
#: Samples are cut into bands; texts that agree on a whole band are candidates.  At similarity 0.8
#: a pair shares no band once in 1,600 times, at 0.85 once in 40,000.
BANDS, ROWS = 14, 4
#: Left-over pairs whose samples agree less often are not verified.  At similarity 0.8 that misses 1 in 10^8.
AGREEMENT = 0.5
#: Hashed buckets of the document frequencies: a fixed table whatever the corpus.
DF_BUCKETS = 1 << 18
#: How much rarity adds to a shingle's weight at most; small, so that the similarity of texts in a
#: large group of copies, whose shared shingles are common, stays near that of the plain shingles.
IDF_SHARE = 0.2
#: Entries of the table of random draws that shingles are hashed to.
DRAWS = 1 << 14
BLOCK = 1024
_SLICE = 1 << 20
_BITS = np.uint64(50)


@dataclass
class Shingles:
    """Distinct shingles of up to 2^13 texts: hashes of 50 bits, sorted within each row, how often each
    occurs, and the first of each row (rows + 1)."""

    hashes: np.ndarray
    times: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> "Shingles":
        folded, starts, ends, first = scan_words(data, offsets)
        h, at = shingle_hashes(word_hashes(folded, starts, ends), first, SHINGLE)
        row = np.repeat(np.arange(len(at) - 1, dtype=np.uint64), np.diff(at))
        keys = np.sort(row << _BITS | h >> np.uint64(64 - int(_BITS)))
        begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        keys, times = keys[begin], np.diff(np.append(begin, len(keys)))
        return cls(keys & ((np.uint64(1) << _BITS) - np.uint64(1)), times, np.searchsorted(keys >> _BITS, np.arange(len(at), dtype=np.uint64)))

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def _df_bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> (_BITS - np.uint64(DF_BUCKETS.bit_length() - 1))).astype(np.int64)


@dataclass
class Weights:
    """Weight of a shingle in a text: (1 + ln times) * (1 + IDF_SHARE * idf), idf from 0 to 1."""

    idf: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray, documents: int) -> "Weights":
        """``counts``: texts by bucket; what other shingles bring to a bucket on average is taken off."""
        noise = counts.sum() / len(counts)
        frequency = np.maximum(0.0, (counts - noise) * len(counts) / (len(counts) - 1))
        return cls((np.log1p(documents / (1.0 + frequency)) / np.log1p(max(documents, 1))).clip(0, 1).astype(np.float32))

    def __call__(self, s: Shingles) -> np.ndarray:
        return (1 + np.log(s.times)) * (1 + IDF_SHARE * self.idf[_df_bucket(s.hashes)].astype(np.float64))


class Sampler:
    """Consistent weighted samples: with r, c ~ Gamma(2, 1) and b ~ U(0, 1) drawn per shingle and sample,
    t = floor(ln w / r + b), ln a = ln c - r (t - b) - r, and the shingle of the least a with its t is the
    sample; two texts agree on one with the probability of their weighted Jaccard similarity."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        n = BANDS * ROWS
        self.r = rng.gamma(2, 1, DRAWS).astype(np.float32)
        self.log_c = np.log(rng.gamma(2, 1, DRAWS)).astype(np.float32)
        self.b = rng.random(DRAWS).astype(np.float32)
        self.inverse_r = (1 / self.r).astype(np.float32)
        self.spread = rng.integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1)

    def __call__(self, s: Shingles, weights: np.ndarray) -> np.ndarray:
        """64-bit samples, a row per text with shingles."""
        log_w = np.log(weights).astype(np.float32)
        rows = np.flatnonzero(np.diff(s.first))
        begin = s.first[:-1][rows]
        out = np.empty((len(rows), BANDS * ROWS), np.uint64)
        if not len(rows):
            return out
        dense = np.repeat(np.arange(len(rows)), np.diff(s.first)[rows])
        shift = np.uint64(64 - DRAWS.bit_length() + 1)
        for k, odd in enumerate(self.spread):
            draw = (s.hashes * odd) >> shift
            r, b = self.r[draw], self.b[draw]
            t = np.floor(log_w * self.inverse_r[draw] + b)
            log_a = self.log_c[draw] - r * (t - b + np.float32(1))
            least = np.minimum.reduceat(log_a, begin)
            at = np.flatnonzero(log_a == least[dense])
            at = at[np.concatenate([[True], np.diff(dense[at]) != 0])]           # of ties, the smallest hash
            out[:, k] = mixed(s.hashes[at] ^ t[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    keys = np.empty((len(samples), BANDS), np.uint64)
    for band in range(BANDS):
        h = np.full(len(samples), band + 1, np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            h = mixed(h * np.uint64(31) + samples[:, k])
        keys[:, band] = h
    return keys.view(np.int64)


def weighted_jaccard(a: Shingles, wa: np.ndarray, b: Shingles, wb: np.ndarray) -> np.ndarray:
    """Row by row: sum of the smaller weights over sum of the larger; 0 where both are empty."""
    n = len(a.first) - 1
    keys = np.concatenate([s.row.astype(np.uint64) << _BITS | s.hashes for s in (a, b)])
    w = np.concatenate([wa, wb])
    order = np.argsort(keys, kind="stable")
    keys, w = keys[order], w[order]
    row = (keys >> _BITS).astype(np.int64)
    same = np.flatnonzero(keys[1:] == keys[:-1])
    both = np.bincount(row[same], np.minimum(w[same], w[same + 1]), n)
    return both / np.maximum(np.bincount(row, w, n) - both, 1e-300)


def learn_weights(docs: DataFrame) -> Weights:
    """Document frequencies over every whole text, in 2^18 hashed buckets: each task sends one row per bucket it saw."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(DF_BUCKETS + 1, np.int64)                                # the last: texts with words
        for batch in batches:
            _, offsets = text_buffer(batch.column(0))
            for i, j in row_slices(offsets, _SLICE):
                s = Shingles.of(*text_buffer(batch.column(0).slice(i, j - i)))
                held[:DF_BUCKETS] += np.bincount(_df_bucket(s.hashes), minlength=DF_BUCKETS)
                held[DF_BUCKETS] += np.count_nonzero(np.diff(s.first))
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(held[at], pa.int64())], names=["bucket", "n"])

    sums = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(DF_BUCKETS + 1, np.int64)
    table[sums["bucket"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    return Weights.of(table[:DF_BUCKETS].astype(np.float64), int(table[DF_BUCKETS]))


def _signatures(rows: DataFrame, weights) -> DataFrame:
    """doc_id, copy, bands and sketch (a byte of each sample) of every text with words."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for batch in batches:
            _, offsets = text_buffer(batch.column("text"))
            for i, j in row_slices(offsets, _SLICE):
                part = batch.slice(i, j - i)
                s = Shingles.of(*text_buffer(part.column("text")))
                samples = sampler(s, weights.value(s))
                kept = part.take(pa.array(np.flatnonzero(np.diff(s.first))))
                yield pa.RecordBatch.from_arrays([
                    kept.column("doc_id"), kept.column("copy"),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(samples) + 1) * BANDS, pa.int32()), pa.array(band_keys(samples).ravel(), pa.int64())),
                    pa.array([x.tobytes() for x in (samples & np.uint64(255)).astype(np.uint8)], pa.binary())], names=["doc_id", "copy", "bands", "sketch"])

    return rows.mapInArrow(sign, "doc_id long, copy string, bands array<long>, sketch binary")


def _verified(pairs: DataFrame, texts: DataFrame, weights, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts have at least this weighted Jaccard similarity."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(text_buffer(batch.column("text_a"))[1]) + np.diff(text_buffer(batch.column("text_b"))[1])
            for i, j in row_slices(np.concatenate([[0], np.cumsum(sizes)]), _SLICE):
                part = batch.slice(i, j - i)
                a, b = (Shingles.of(*text_buffer(part.column(c))) for c in ("text_a", "text_b"))
                like = weighted_jaccard(a, weights.value(a), b, weights.value(b)) >= similarity
                yield part.select(["a", "b"]).filter(pa.array(like))

    with_b = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    both = with_b.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long").distinct()


class _Roots:
    """Components inside a block, merged as links are found."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def of(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            x = y
        return x

    def merge(self, x: int, y: int) -> None:
        self.up[max(x, y)] = min(x, y)


def _block_links(key: int, left: list[tuple], right: list[tuple], weights: Weights, similarity: float) -> list[tuple[int, int]]:
    """Links that join components, between rows (node, root, sketch, bands, text) of two sides of a band.

    A pair counts in the first band it shares.  For each left row the right rows of
    other components whose sketches agree often enough are verified, the likeliest
    first; once a link joins a component, its other rows need no test.
    """
    rows = [*left, *right]
    s = Shingles.of(*text_buffer(pa.array([r[4] for r in rows], pa.large_string())))
    w = weights(s)
    total = np.bincount(s.row, w, len(rows))
    sketch = np.array([np.frombuffer(r[2], np.uint8) for r in right])
    bands = np.array([r[3] for r in right])
    node = np.array([r[0] for r in right])
    samples = sketch.shape[1]
    least = min(AGREEMENT, similarity - 4 * (similarity * (1 - similarity) / samples) ** 0.5)
    roots, links = _Roots(), []
    for i, (n, root, mine, own_bands, _) in enumerate(left):
        alike = (sketch == np.frombuffer(mine, np.uint8)).mean(1)
        shared = bands == np.array(own_bands)
        first = shared.argmax(1) == own_bands.index(key)
        chosen = np.flatnonzero((alike >= least) & first & (node != n))
        chosen = chosen[np.argsort(-alike[chosen], kind="stable")]
        h, hw = s.hashes[s.first[i]: s.first[i + 1]], w[s.first[i]: s.first[i + 1]]
        for k in range(0, len(chosen), 64):
            part = [c for c in chosen[k: k + 64].tolist() if roots.of(right[c][1]) != roots.of(root)]
            if not part:
                continue
            begin, end = s.first[:-1][len(left) + np.array(part)], s.first[1:][len(left) + np.array(part)]
            at = np.concatenate([np.arange(a, b) for a, b in zip(begin, end)])
            of = np.repeat(np.arange(len(part)), end - begin)
            slot = np.minimum(np.searchsorted(h, s.hashes[at]), len(h) - 1)
            both = np.bincount(of, np.where(h[slot] == s.hashes[at], np.minimum(hw[slot], w[at]), 0.0), len(part))
            like = both / (total[i] + total[len(left) + np.array(part)] - both)
            for c in np.flatnonzero(like >= similarity).tolist():
                x, y = roots.of(root), roots.of(right[part[c]][1])
                if x != y:
                    roots.merge(x, y)
                    links.append((min(n, right[part[c]][0]), max(n, right[part[c]][0])))
    return links


def _left_over(members: DataFrame, weights, similarity: float) -> DataFrame:
    """Links (a, b) between members of one band that are of different components.

    ``members``: key, node, root, sketch, bands, text.  In every band the rows outside its
    largest component are compared with all rows of the band, in blocks of about
    1,024 by 1,024; only links leave a block.
    """
    by_root = members.groupBy("key", "root").agg(F.count("*").alias("n"))
    bands = by_root.groupBy("key").agg(F.sum("n").alias("n"), F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("main_n")).where("n > main_n")
    bands = bands.select("key", "main", F.ceil(F.col("n") / BLOCK).cast("int").alias("all_blocks"), F.ceil((F.col("n") - F.col("main_n")) / BLOCK).cast("int").alias("rest_blocks"))
    rows = members.join(bands, "key").withColumn("slot", F.pmod(F.xxhash64("node"), F.lit(1 << 30)))
    what = ["node", "root", "sketch", "bands", "text"]
    rest = rows.where("root != main").select("key", (F.col("slot") % F.col("rest_blocks")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("all_blocks") - 1)).alias("j"), F.lit(True).alias("rest"), *what)
    full = rows.select("key", F.explode(F.sequence(F.lit(0), F.col("rest_blocks") - 1)).alias("i"), (F.col("slot") % F.col("all_blocks")).cast("int").alias("j"), F.lit(False).alias("rest"), *what)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def found() -> pa.RecordBatch:
            left, right = [r[1:] for r in held if r[0]], [r[1:] for r in held if not r[0]]
            links = _block_links(key[0], left, right, weights.value, similarity) if left and right else []
            return pa.RecordBatch.from_arrays([pa.array([x[c] for x in links], pa.int64()) for c in (0, 1)], names=["a", "b"])

        for batch in batches:
            for k, i, j, *row in zip(*[batch.column(c).to_pylist() for c in ("key", "i", "j", "rest", *what)]):
                if (k, i, j) != key:
                    yield found()
                    held, key = [], (k, i, j)
                held.append(row)
        yield found()

    dealt = rest.unionAll(full).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (the smallest doc_id of the class) and kept (doc_id = class_id), one row per row of ``docs``.

    Texts are of one class if a chain of links leads from one to the other; two texts
    link if they are the same or if the weighted Jaccard similarity of their shingles
    of five words (one of all words in a shorter text) is at least ``similarity``.
    Null texts are empty; empty texts are copies of each other, and texts without words
    link to their copies alone.  Rows with the same doc_id are one document and share a
    class.  A row without doc_id takes the class of an identical text that has one, else
    its class is null and it is kept.  Other columns are not read; an empty table gives no rows.

    Copies meet by their digest and only the first goes on.  In every band its members are
    tested against its head.  Where that leaves a band with members of different
    components, these are compared too, so no pair of the band is left out but those
    already in one component (and those of whose 56 samples less than half agree, or
    less than four standard deviations below a lower ``similarity``).  Nothing is collected but the 2^18 document frequencies.
    """
    scratch = Scratch(docs.sparkSession, "near-duplicates")
    stored = scratch.store
    sent = docs.sparkSession.sparkContext.broadcast(learn_weights(docs))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("copy", F.md5("text"))
    ids = stored(rows.select("doc_id", "copy"), "ids")
    copies = ids.groupBy("copy").agg(F.min("doc_id").alias("node"))
    signed = _signatures(rows.where("doc_id is not null"), sent)
    nodes = stored(signed.groupBy("copy").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "nodes")

    banded = nodes.select(F.explode("bands").alias("key"), "node")
    counts = banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(banded.join(counts, "key"), "shared")            # members of bands that several texts have
    # the head of a band is the member that meets most texts in all its bands: of copies, the text they were made from
    met = shared.groupBy("node").agg(F.sum("n").alias("met"))
    heads = shared.join(met, "node").groupBy("key").agg(F.max_by("node", F.struct(F.col("met"), -F.col("node"))).alias("head"))
    tested = shared.join(heads, "key").where("node != head").select(F.least("head", "node").alias("a"), F.greatest("head", "node").alias("b"))
    tested = stored(tested.distinct(), "pairs")

    wanted = nodes.select("copy", F.col("node").alias("doc_id")).join(shared.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
    texts = stored(rows.join(wanted, ["copy", "doc_id"], "left_semi").select("doc_id", "copy", "text"), "texts")
    links = stored(_verified(tested, texts, sent, similarity), "links")
    roots = components(links, scratch)

    # bands of two are done; in the others, what is not yet of one component
    open_bands = shared.where("n > 2").join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    unlike = open_bands.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("key")
    mixed_bands = stored(open_bands.join(unlike, "key", "left_semi").dropDuplicates(["key", "node"]), "mixed")
    # an id may stand for several texts: those that are in the band, each with its own sketch and bands
    members = mixed_bands.join(nodes, "node").where("array_contains(bands, key)").join(texts.select("copy", "text").dropDuplicates(["copy"]), "copy").drop("copy")
    more = _left_over(stored(members, "members"), sent, similarity)
    # rows of one id are one document, whatever their texts
    repeated = ids.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    same_id = ids.join(repeated, "doc_id", "left_semi").join(copies, "copy").where("doc_id != node").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    added = stored(more.unionAll(same_id), "links")
    if not added.isEmpty():
        roots = components(added.unionAll(roots.where("node != root").select(F.col("root").alias("a"), F.col("node").alias("b"))), scratch)
    scratch.clear(ids, roots)
    classes = copies.join(roots, "node", "left").select("copy", F.coalesce("root", "node").alias("class_id"))
    return ids.join(classes, "copy").select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def deduplicated(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class of near-duplicates: one row of its smallest doc_id.

    Of several rows with that id the one whose text has the smallest digest stays, of equal texts the one whose columns
    (maps aside) have the smallest hash.  A row without doc_id stays only if no row with one has its text, and
    then once per text.  Columns of any names pass through.
    """
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"),
                       F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("copy"), F.xxhash64(*hashed).alias("tie"))
    kept = near_duplicates(docs, similarity).where("kept and doc_id is not null").select(F.col("doc_id").alias("id")).distinct()
    with_id = rows.join(kept, "id", "left_semi").groupBy("id").agg(F.min_by("row", F.struct("copy", "tie")).alias("row"))
    known = rows.where("id is not null").select("copy").distinct()
    alone = rows.where("id is null").join(known, "copy", "left_anti").groupBy("copy").agg(F.min_by("row", "tie").alias("row"))
    return with_id.select("row.*").unionByName(alone.select("row.*"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates of every document."""
    return near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
