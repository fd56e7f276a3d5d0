"""Update schedule: A7 agg_ordered_array, N11 batches, C13 to_update, C14 get_iid_mapping,
C15 check_updates, C16 stale_report (A11, X15)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.functions.expressions import expr_days_stale
from marketframe.operators.relational import join_left_mapping
from marketframe.operators.windows import assign_batches
from marketframe.sources.scans import validate_source


def agg_ordered_array(df: DataFrame, keys: list, col: str, out: str | None = None) -> DataFrame:
    """Sorted array of ``col`` per key (use only where a group is bounded,
    e.g. the fields of one ticker)."""
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(col)).alias(out or col))


def to_update(updates: DataFrame, identifiers: DataFrame, instruments: DataFrame,
              frequency: str = "daily", source: str = "YAHOO", batch_size: int = 5,
              sources: DataFrame | None = None) -> DataFrame:
    """Pull plan: (asset class, sorted field set) -> sorted tickers, cut into
    batches of ``batch_size`` (N11) so no array grows with the universe.

    Output: asset_class, field_set (array), batch, tickers (array, sorted).  With
    ``sources``, a source that is not among them is an error.
    """
    if sources is not None:
        validate_source(sources, source)
    ids = identifiers.where(F.col("source") == source).select("instrument_id", F.col("ext_id").alias("ticker"))
    inst = instruments.select("instrument_id", "asset_class")
    u = updates.where((F.col("source") == source) & (F.col("frequency") == frequency)).select("instrument_id", "field")
    per_ticker = agg_ordered_array(u.join(ids, "instrument_id").join(inst, "instrument_id"),
                                   ["asset_class", "ticker"], "field", "field_set")
    batched = assign_batches(per_ticker.withColumn("fs_key", F.array_join("field_set", ",")),
                             ["asset_class", "fs_key"], ["ticker"], batch_size)
    return (batched
            .groupBy("asset_class", "fs_key", "batch")
            .agg(F.first("field_set").alias("field_set"), F.sort_array(F.collect_list("ticker")).alias("tickers"))
            .select("asset_class", "field_set", "batch", "tickers"))


def get_iid_mapping(requested: DataFrame, identifiers: DataFrame, source: str,
                    sources: DataFrame | None = None) -> DataFrame:
    """C14: external id -> internal id for one source; unknown ids map to null.  With
    ``sources``, a source that is not among them is an error."""
    if sources is not None:
        validate_source(sources, source)
    return join_left_mapping(requested, identifiers, source)


def check_updates(updates: DataFrame, instruments: DataFrame, cutoff) -> DataFrame:
    """Schedule rows whose last update is on or before ``cutoff``."""
    return (instruments.select("instrument_id", "name")
            .join(updates.where(F.col("last_update") <= F.lit(cutoff)), "instrument_id")
            .select("instrument_id", "name", "field", "last_update"))


def agg_fields_per_stale(stale: DataFrame) -> DataFrame:
    """Sorted fields per (instrument, name, last_update) — bounded by the field count."""
    return agg_ordered_array(stale, ["instrument_id", "name", "last_update"], "field", "fields")


def stale_report(updates: DataFrame, instruments: DataFrame, cutoff, as_of) -> DataFrame:
    """One report line per stale instrument with its fields and age in days."""
    g = agg_fields_per_stale(check_updates(updates, instruments, cutoff))
    days = expr_days_stale(F.col("last_update"), as_of)
    line = F.format_string("- %s (%s), field(s): %s. Last updated %s (%d days ago)", F.col("name"),
                           F.col("instrument_id"), F.array_join("fields", ", "),
                           F.col("last_update").cast("string"), days)
    return g.select("instrument_id", "name", "last_update", "fields", days.alias("days_stale"), line.alias("line"))
