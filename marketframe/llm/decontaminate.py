"""Benchmark passages in documents: an FM-index per shard of documents, searched for the benchmark's windows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.llm.arrow import read_table, row_slices, text_buffer
from marketframe.llm.fm_index import FMIndex
from marketframe.llm.textscan import scan_words, word_hashes

WINDOW = 10
#: Words of an indexed segment: bounds the rounds of suffix sorting.
SEGMENT = 64


@dataclass
class Windows:
    """The distinct windows of a block of benchmark items; words are numbered from 1 on."""

    vocabulary: np.ndarray              # sorted word hashes
    by_length: dict[int, np.ndarray]    # windows of each length, a row each
    items: dict[int, list[list[str | None]]]   # for each of them, the items that have it

    @classmethod
    def of(cls, ids: list[str | None], texts: list[str | None], size: int) -> "Windows":
        data, offsets = text_buffer(pa.array(texts, pa.string()))
        folded, starts, ends, first = scan_words(data, offsets)
        vocabulary, numbers = np.unique(word_hashes(folded, starts, ends), return_inverse=True)
        found: dict[tuple, set[str | None]] = {}
        for k, item in enumerate(ids):
            words = (numbers[first[k]: first[k + 1]] + 1).tolist()
            for i in range(max(len(words) - size + 1, min(1, len(words)))):
                found.setdefault(tuple(words[i: i + size]), set()).add(item)
        by_length, items = {}, {}
        for length in sorted({len(w) for w in found}):
            mine = [w for w in found if len(w) == length]
            by_length[length] = np.array(mine, np.int64)
            items[length] = [list(found[w]) for w in mine]
        return cls(vocabulary, by_length, items)


def _segments(known: np.ndarray, row_of: np.ndarray, shortest: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Word places laid out for indexing, -1 after each segment: runs of known words of one row that could
    hold a window, in overlapping segments such that any window lies whole in one."""
    n = len(known)
    flag = known > 0
    joined = np.zeros(n + 1, bool)
    joined[1:n] = flag[1:] & flag[:-1] & (row_of[1:] == row_of[:-1])
    begin = np.flatnonzero(flag & ~joined[:n])
    end = np.flatnonzero(flag & ~joined[1:]) + 1
    enough = end - begin >= shortest
    begin, end = begin[enough], end[enough]
    step = SEGMENT - (longest - 1) if longest < SEGMENT // 2 else SEGMENT
    width = step + longest - 1
    pieces = np.maximum(1, -(-(end - begin - (longest - 1)) // step))
    start = np.repeat(begin, pieces) + step * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    length = np.minimum(np.repeat(end, pieces) - start, width) + 1           # with its end mark
    total = np.cumsum(length)
    places = np.repeat(start, length) + np.arange(length.sum()) - np.repeat(total - length, length)
    places[total - 1] = -1
    return places, start


def occurrences(hashes: np.ndarray, first: np.ndarray, windows: Windows) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, window numbers, word places) of all occurrences of the windows in a shard's words."""
    if not len(hashes) or not windows.by_length:
        return
    slot = np.minimum(np.searchsorted(windows.vocabulary, hashes), len(windows.vocabulary) - 1)
    known = np.where(windows.vocabulary[slot] == hashes, slot + 1, 0)
    row_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    places, _ = _segments(known, row_of, min(windows.by_length), max(windows.by_length))
    if not len(places):
        return
    index = FMIndex(np.where(places >= 0, known[np.maximum(places, 0)], 0))
    for length, patterns in windows.by_length.items():
        low, high = index.count(patterns)
        times = high - low
        rows = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        yield length, np.repeat(np.arange(len(patterns)), times), places[index.locate(rows)]


def _merged(marks: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs [from, to) of marked words, broken between rows."""
    before = np.concatenate([[False], marks[:-1]])
    after = np.concatenate([marks[1:], [False]])
    edges = first[(first > 0) & (first < len(marks))]
    before[edges] = False
    after[edges - 1] = False
    return np.flatnonzero(marks & ~before), np.flatnonzero(marks & ~after) + 1


def _without(text: bytes, spans: list[tuple[int, int]]) -> str:
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]]).decode()


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, clean: bool = False, block_bytes: int = 8 << 20, shard_bytes: int = 2 << 20) -> DataFrame:
    """Find every passage of ``benchmark`` (item_id, text) in every whole text of ``docs``.

    Words are runs of digits, ASCII letters and non-ASCII characters, A-Z lower-cased,
    compared by 64-bit hash.  A window is ``size`` consecutive words of an item, or a
    whole shorter item.  Returns per row ``doc`` (a struct of all columns of ``docs``
    but text, so no name can clash), ``text`` (with ``clean``, without the merged spans),
    ``n_words``, ``spans`` (merged hit words, from and to) and ``items`` (item_ids as
    strings, sorted; items without an id are one null, last).  Null and empty texts have no words and stay as they are; repeated
    rows are searched alike; an empty benchmark hits nothing; an empty table gives no rows.

    Documents are not shuffled: each task indexes its rows in shards of about
    ``shard_bytes`` (a longer text is a shard of its own).  The benchmark goes to the
    tasks in blocks of about ``block_bytes`` of items, one pass each.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text") + F.coalesce(F.octet_length("item_id"), F.lit(0)))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    out = docs.select(F.struct(*others).alias("doc") if others else F.struct(F.lit(0).alias("_")).alias("doc"), F.col("text").cast("string").alias("text"),
                      F.lit(0).cast("long").alias("n_words"), F.array().cast("array<struct<from:long,to:long>>").alias("spans"), F.array().cast("array<string>").alias("items"))
    schema = out.schema
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()      # about block_bytes
        sent = spark.sparkContext.broadcast(Windows.of([r.item_id for r in rows], [r.text for r in rows], size))
        last = clean and block == blocks - 1

        def search(batches: Iterator[pa.RecordBatch], sent=sent, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, offsets = text_buffer(batch.column("text"))
                for i, j in row_slices(offsets, shard_bytes):
                    yield _search_shard(batch.slice(i, j - i), sent.value, last)

        out = out.mapInArrow(search, schema)
    return out


def _search_shard(batch: pa.RecordBatch, windows: Windows, clean: bool) -> pa.RecordBatch:
    data, offsets = text_buffer(batch.column("text"))
    folded, starts, ends, first = scan_words(data, offsets)
    n, rows = len(starts), batch.num_rows
    change = np.zeros(n + 1, np.int64)
    found = [set(x) for x in batch.column("items").to_pylist()]
    for k, earlier in enumerate(batch.column("spans").to_pylist()):
        for s in earlier:
            change[first[k] + s["from"]] += 1
            change[first[k] + s["to"]] -= 1
    for length, window, place in occurrences(word_hashes(folded, starts, ends), first, windows):
        np.add.at(change, place, 1)
        np.add.at(change, place + length, -1)
        row = np.searchsorted(first, place, side="right") - 1
        for r, w in np.unique(np.stack([row, window], 1), axis=0).tolist():
            found[r].update(windows.items[length][w])
    begin, end = _merged(np.cumsum(change[:n]) > 0, first)
    row = np.searchsorted(first, begin, side="right") - 1
    spans: list[list[dict]] = [[] for _ in range(rows)]
    cuts: dict[int, list[tuple[int, int]]] = {}
    for r, a, b in zip(row.tolist(), begin.tolist(), end.tolist()):
        spans[r].append({"from": a - int(first[r]), "to": b - int(first[r])})
        cuts.setdefault(r, []).append((int(starts[a] - offsets[r]), int(ends[b - 1] - offsets[r])))
    text = batch.column("text")
    if clean and cuts:
        text = pa.array([_without(t.encode(), cuts[r]) if r in cuts else t for r, t in enumerate(text.to_pylist())], text.type)
    new = {"text": text, "n_words": pa.array(np.diff(first), pa.int64()), "spans": pa.array(spans, batch.schema.field("spans").type),
           "items": pa.array([sorted(x, key=lambda item: (item is None, item)) for x in found], batch.schema.field("items").type)}
    return pa.RecordBatch.from_arrays([new.get(name, batch.column(name)) for name in batch.schema.names], schema=batch.schema)


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with the benchmark's passages cut out of the texts; other columns, and texts without hits, stay."""
    hits = benchmark_hits(docs, benchmark, clean=True)
    return hits.select(*[F.col("text").alias("text") if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside an occurrence of a 10-word window of the benchmark."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = benchmark_hits(docs, read_table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
    return hits.select(F.col("doc.doc_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP8_SQL = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS phrase
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
place AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS phrase
          FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, (SELECT DISTINCT size FROM win) WHERE len(w) >= size)),
hit AS (SELECT p.doc_id, p.i, p.size, w.item_id FROM place p JOIN win w ON p.phrase = w.phrase AND p.size = w.size),
covered AS (SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS spot FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(n.ids, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN covered c USING (doc_id) LEFT JOIN named n USING (doc_id)
"""
