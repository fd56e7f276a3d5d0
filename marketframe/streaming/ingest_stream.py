"""T1 stream_ingest: landed vendor files -> published observations, exactly once per file.

Structured Streaming tracks which landed files were processed in its checkpoint.
Each micro-batch is written in one commit (W12) that also records the number of the
batch under the id of the stream, which its checkpoint keeps, so a batch replayed after a
crash finds itself applied and changes nothing.  A stream with a new checkpoint has a
new id: it reads all that has landed and upserts what differs.  Landed rows are appended, so
the bytes that a batch writes there follow its own rows; of the published table only the
partitions in which a batch changes something are written.
"""

from __future__ import annotations

import datetime as dt
import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe import schemas as S
from marketframe.operators.writes import append_failures
from marketframe.plans.ingest import BY_FIELD_YEAR, ingest_rows
from marketframe.plans.vendor import vendor_to_observations
from marketframe.sources.scans import VENDOR_PRICES
from marketframe.sources.sinks import (_create, _read_text, commit, exists, intermediates, materialize, read_manifest, read_partitions, read_table,
                                       stage_append, stage_upsert)

#: The landing may be split by pull (``pull=.../`` folders); rows of one pull and ticker are one window.
LANDED = T.StructType([*VENDOR_PRICES.fields, T.StructField("pull", T.StringType())])
LANDED_KEY = ["pull", "ticker", "date"]


def stream_ingest(spark: SparkSession, landing: str, root: str, checkpoint: str, identifiers: DataFrame,
                  fields: list[str] | None = None, files_per_batch: int = 100, table: str = "observations", name: str = "vendor"):
    """Start the stream (``availableNow``: drain what has landed, then stop).

    Landed rows are kept in ``<table>_landed``, so a pull window whose rows come in
    several files is converted as one whole (C10): its first row is dropped once.
    Vendor ids are mapped through ``identifiers``; rows with an unknown id or without a
    value go to ``<table>_failures`` and never replace a good value (C18).
    """
    fields = fields or ["close", "totret"]

    def apply(batch: DataFrame, batch_id: int) -> None:
        stream = f"{name}-{json.loads(_read_text(spark, f'{checkpoint}/metadata'))['id']}"
        if read_manifest(spark, root)["applied"].get(stream, -1) >= batch_id:
            return
        attempted = _first_attempt(spark, f"{root}/_attempts/{stream}-{batch_id}")
        with intermediates(spark):
            commit(spark, root, staged(batch, attempted), {stream: batch_id})

    def staged(batch: DataFrame, attempted: dt.datetime) -> list:
        values = [c for c in LANDED.fieldNames() if c not in LANDED_KEY]
        rows = batch.withColumn("pull", F.coalesce("pull", F.lit("")))
        rows = rows.groupBy(*LANDED_KEY).agg(F.max(F.struct(*values)).alias("v")).select(*LANDED_KEY, "v.*")     # of repeated rows the largest
        rows = materialize(rows, "landed")
        order = F.lit(read_manifest(spark, root)["commit"] + 1).cast("long")                                     # later commits win
        landed = stage_append(rows.withColumn("landed", order), root, f"{table}_landed", ["pull"])
        whole, old = rows, read_partitions(spark, root, f"{table}_landed", landed)
        if old is not None:                                                                                      # earlier rows of the same windows
            old = old.join(rows.select("pull", "ticker").distinct(), ["pull", "ticker"], "left_semi").join(rows, LANDED_KEY, "left_anti")
            last = old.groupBy(*LANDED_KEY).agg(F.max(F.struct("landed", *values)).alias("v"))
            whole = whole.unionByName(last.select(*LANDED_KEY, *[F.col(f"v.{c}").alias(c) for c in values]))
        long = vendor_to_observations(whole, fields, by=["pull", "ticker"])
        good, failed = ingest_rows(identifiers, long, spark.createDataFrame([], "ticker string, field string"))
        failures = append_failures(spark.createDataFrame([], S.INGEST_FAILURES), failed, attempted)
        return [landed, stage_upsert(good, root, table, S.OBS_KEY, BY_FIELD_YEAR, "seq"), stage_append(failures, root, f"{table}_failures")]

    return (spark.readStream.schema(LANDED).option("maxFilesPerTrigger", files_per_batch)
            .parquet(landing).writeStream.foreachBatch(apply)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _first_attempt(spark: SparkSession, path: str) -> dt.datetime:
    """When a batch was first tried; kept in a file, so a later attempt gives the same time."""
    if not exists(spark, path):
        try:
            _create(spark, path, dt.datetime.now(dt.UTC).isoformat())
        except Py4JJavaError:
            if not exists(spark, path):
                raise
    return dt.datetime.fromisoformat(_read_text(spark, path))


def run_to_end(spark: SparkSession, landing: str, root: str, checkpoint: str, identifiers: DataFrame, **kw) -> DataFrame:
    """Run ``stream_ingest`` until the landing is drained; return the published table."""
    q = stream_ingest(spark, landing, root, checkpoint, identifiers, **kw)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return read_table(spark, root, kw.get("table", "observations"))
