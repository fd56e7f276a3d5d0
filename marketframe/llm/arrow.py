"""Arrow batches as flat numpy arrays, and small frame helpers shared by the operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from marketframe.session import checkpoint_dir


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes (UTF-8 of a string) and row offsets (rows + 1) of a string or binary column; a null row is empty."""
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    column = pc.fill_null(column.cast(pa.large_binary() if binary else pa.large_string()), b"" if binary else "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    o = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    d = np.frombuffer(data, np.uint8)[o[0]: o[-1]] if data is not None else np.zeros(0, np.uint8)
    return d, o - o[0]


def row_slices(offsets: np.ndarray, most_bytes: int, most_rows: int = 1 << 13) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most_bytes`` of text and at most ``most_rows`` rows; a longer text has a range of its own."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most_bytes, side="right")) - 1
        j = min(n, max(j, i + 1), i + most_rows)
        yield i, j
        i = j


def add_columns(docs: DataFrame, fields: str, make: Callable[[pa.Array], list[pa.Array]], text: str = "text", slice_bytes: int = 4 << 20, cast: str = "string") -> DataFrame:
    """``docs`` plus the columns ``fields`` (a schema string), made from the text column by ``make``
    for about ``slice_bytes`` of text at a time (``cast`` to binary: of bytes).  Other columns pass through in a struct, so no name
    clashes inside; a column of ``docs`` named like a new one is replaced."""
    added = T.StructType.fromDDL(fields)
    others = [c for c in docs.columns if c != text]
    packed = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]).alias("row"),
                         F.col(f"`{text}`").cast(cast).alias("text"))
    schema = T.StructType([*packed.schema.fields, T.StructField("made", added)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(added)
        for batch in batches:
            _, offsets = text_buffer(batch.column("text"))
            for i, j in row_slices(offsets, slice_bytes):
                part = batch.slice(i, j - i)
                made = pa.StructArray.from_arrays([a.cast(f.type) for a, f in zip(make(part.column("text")), arrow)], fields=list(arrow))
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=["row", "text", "made"])

    out, new = packed.mapInArrow(run, schema), added.fieldNames()
    source = {c: F.col(f"row.c{i}") for i, c in enumerate(others)} | {text: F.col("text")}
    return out.select(*[source[c].alias(c) for c in docs.columns if c not in new], *[F.col(f"made.`{c}`").alias(c) for c in new])


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "llm", f"{name}-{uuid.uuid4().hex}")


class Scratch:
    """Intermediate tables of one job in the shared folder.

    ``store`` writes a table once and reads it back: lineage ends there, and a lost
    executor costs a re-read, not a re-computation.  ``drop`` deletes tables that are
    no longer read, ``clear`` all but those of the frames it is given.
    """

    def __init__(self, spark: SparkSession, job: str):
        self.spark, self.root, self.paths = spark, shared_path(spark, job), {}

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{len(self.paths)}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        return out

    def drop(self, *frames: DataFrame) -> None:
        for f in frames:
            path, kept = self.paths[id(f)]
            self.paths[id(f)] = ("", kept)
            if path:
                p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def clear(self, *keep: DataFrame) -> None:
        self.drop(*[f for _, f in list(self.paths.values()) if all(f is not k for k in keep)])


def remainder(id_column: str, modulus: int):
    """crc32 of the id's text, modulo: the fold of a document (null id: null)."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % modulus


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
