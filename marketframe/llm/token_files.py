"""Token-id files in document order, coded with Simple-8b.

File format: a folder of Parquet files, each row one segment of whole documents:
``part`` and ``segment`` order the segments, ``start_in_part`` counts the part's
ids before it, ``doc_ids`` and ``doc_lengths`` list its documents, ``words`` and
``escapes`` hold the coded ids, ``word_at`` and ``escape_at`` where each block of
8,192 ids begins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketframe.llm import simple8b
from marketframe.llm.arrow import read_table, shared_path
from marketframe.llm.token_ids import encoder

SEGMENT_SCHEMA = ("part int, segment long, start_in_part long, n_ids long, doc_ids array<long>, doc_lengths array<long>, "
                  "words binary, escapes binary, word_at array<int>, escape_at array<int>")
_SEGMENT_ARROW = pa.schema([("part", pa.int32()), ("segment", pa.int64()), ("start_in_part", pa.int64()), ("n_ids", pa.int64()),
                            ("doc_ids", pa.list_(pa.int64())), ("doc_lengths", pa.list_(pa.int64())), ("words", pa.binary()),
                            ("escapes", pa.binary()), ("word_at", pa.list_(pa.int32())), ("escape_at", pa.list_(pa.int32()))])
_DOC_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int, segment_ids: int = 1 << 17) -> None:
    """Encode every whole text (null: empty) plus ``end_id`` and write the ids in ascending doc_id order.

    Rows are dealt by ranges of doc_id (null ids first) and sorted within; repeated
    ids are ordered by their text's hash.  A segment closes at the document that
    fills ``segment_ids``, so a longer document is a segment of its own.  Other
    columns of ``docs`` are not read.  An empty table gives an empty folder of files.
    """
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tok, end = TaskContext.get().partitionId(), encoder(vocabulary), np.array([end_id], "<u4").tobytes()
        segment = start = 0
        ids, doc_ids, lengths, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            words, escapes, word_at, escape_at = simple8b.encode(np.frombuffer(b"".join(ids), "<u4"))
            row = [part, segment, start, held, list(doc_ids), list(lengths), words, escapes, word_at, escape_at]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _SEGMENT_ARROW)], schema=_SEGMENT_ARROW)

        for batch in batches:
            names = batch.column(0).to_pylist()
            for k in range(0, len(names), 256):
                texts = batch.column(1).slice(k, 256).to_pylist()
                for name, coded in zip(names[k: k + 256], tok.encode(texts)):
                    ids.append(coded + end)
                    doc_ids.append(name)
                    lengths.append(len(coded) // 4 + 1)
                    held += lengths[-1]
                    if held >= segment_ids:
                        yield close()
                        segment, start, held = segment + 1, start + held, 0
                        ids, doc_ids, lengths = [], [], []
        if doc_ids:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange(F.col("doc_id").asc()).sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(code, SEGMENT_SCHEMA).write.option("compression", "zstd").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Decode files written by :func:`write_token_files`: doc_id, start (ids of all documents before it) and
    ids (little-endian unsigned 32-bit).  Only one number per part, its ids, is summed over the whole."""
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)     # one row per written part
    starts = parts.select("part", F.coalesce(F.sum("part_ids").over(before), F.lit(0)).alias("part_start"))

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = simple8b.decode(row["words"], row["escapes"], row["word_at"], row["escape_at"], row["n_ids"]).astype("<u4").tobytes()
                lengths = np.array(row["doc_lengths"], np.int64)
                ends = np.cumsum(lengths)
                begins = ends - lengths
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()), pa.array(begins + row["start_in_part"] + row["part_start"], pa.int64()),
                    pa.array([ids[4 * a: 4 * b] for a, b in zip(begins.tolist(), ends.tolist())], pa.binary())], schema=_DOC_ARROW)

    return (segments.join(F.broadcast(starts), "part")      # as many rows as written parts, whatever the table's size
            .mapInArrow(expand, "doc_id long, start long, ids binary"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the 50k byte-level vocabulary, written to token files and read back from them."""
    import public_tokenizers
    path = shared_path(spark, "token-files")
    write_token_files(read_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_token_files(spark, path).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
