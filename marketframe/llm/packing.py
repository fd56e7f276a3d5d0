"""Best-fit-decreasing packing of token ids into fixed windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.llm.arrow import read_table
from marketframe.llm.token_ids import encoder

PIECE_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_PIECE_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                          ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


class CapacityTree:
    """Open windows by remaining capacity: a segment tree over the capacities 0..size counts the
    windows below each node, so the tightest window that still fits is found in log(size) steps."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(size + 1)]

    def _add(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, capacity: int, window: int) -> None:
        self.windows[capacity].append(window)
        self._add(capacity, 1)

    def take_tightest(self, least: int) -> tuple[int, int] | None:
        """Remove and return (capacity, window) of the smallest capacity that is at least ``least``."""
        node, count = least + self.leaves, self.count
        while not count[node]:
            while node & 1:                      # a right child: its subtree and all to the left are done
                node >>= 1
            if not node:
                return None
            node += 1                            # the sibling holds the next larger capacities
            if node & (node - 1) == 0:           # past the last leaf of this level
                return None
        while node < self.leaves:
            node <<= 1
            if not count[node]:
                node += 1
        capacity = node - self.leaves
        self._add(capacity, -1)
        return capacity, self.windows[capacity].pop()


def best_fit_decreasing(lengths: list[int], size: int) -> list[tuple[int, int, int]]:
    """(item, window, offset) for items of at most ``size``: longest first, each into the open
    window it fills best, else into a new one; equal lengths keep their order."""
    tree, out, windows = CapacityTree(size), [], 0
    for i in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        found = tree.take_tightest(lengths[i])
        if found is None:
            found = (size, windows)
            windows += 1
        capacity, window = found
        out.append((i, window, size - capacity))
        if capacity > lengths[i]:
            tree.put(capacity - lengths[i], window)
    return out


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, window: int = 2048, pool_ids: int = 1 << 22) -> DataFrame:
    """Pack every whole text (null: empty), its ids followed by ``end_id``, into windows.

    A document is first cut into full windows; what remains is packed best-fit
    decreasing together with the remainders around it.  Each task packs its own
    rows in pools of ``pool_ids`` ids, which bounds its memory; nothing is
    shuffled, and a repeated task gives the same pieces.  Returns one row per
    piece: ids as little-endian unsigned 32-bit, sequence_id unique over the
    table, offset gapless from 0.  An empty text is one piece of ``end_id``;
    repeated rows and null doc_ids are packed like any other; other columns are
    not read; an empty table gives no rows.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, end = encoder(vocabulary), np.array([end_id], "<u4").tobytes()
        next_id, pool, pooled = TaskContext.get().partitionId() << 36, [], 0

        def rows(pieces: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*pieces), _PIECE_ARROW)], schema=_PIECE_ARROW)

        def emptied() -> Iterator[pa.RecordBatch]:
            nonlocal next_id, pool, pooled
            placed = best_fit_decreasing([len(p[2]) // 4 for p in pool], window)
            for k in range(0, len(placed), 2048):
                yield rows([(pool[i][0], pool[i][1], len(pool[i][2]) // 4, pool[i][2], pool[i][3], next_id + w, at) for i, w, at in placed[k: k + 2048]])
            next_id += 1 + max((w for _, w, _ in placed), default=-1)
            pool, pooled = [], 0

        for batch in batches:
            names = batch.column(0).to_pylist()
            for k in range(0, len(names), 256):
                full = []
                for name, coded in zip(names[k: k + 256], tok.encode(batch.column(1).slice(k, 256).to_pylist())):
                    ids = coded + end
                    n = len(ids) // 4
                    for at in range(0, n - window + 1, window):
                        full.append((name, at, window, ids[4 * at: 4 * (at + window)], n, next_id, 0))
                        next_id += 1
                    if rest := n % window:
                        pool.append((name, n - rest, ids[4 * (n - rest):], n))
                        pooled += rest
                if full:
                    yield rows(full)
                if pooled >= pool_ids:
                    yield from emptied()
        if pool:
            yield from emptied()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(pack, PIECE_SCHEMA)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of at most 2,048 ids of the 49k word vocabulary."""
    import public_tokenizers
    pieces = pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
