"""Data-quality checks D1-D8: each returns the violating rows (empty = pass).

They stand in for the constraints a database would enforce; Parquet enforces
none.  All are aggregates, anti joins or one window, so they run distributed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def check_primary_key(df: DataFrame, key: list) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Values of a unique column that occur more than once (nulls ignored)."""
    return check_primary_key(df.where(F.col(col).isNotNull()), [col])


def check_foreign_key(child: DataFrame, parent: DataFrame, on: list, parent_on: list | None = None) -> DataFrame:
    """D3: child rows whose (non-null) key has no parent."""
    p = parent.select(*[F.col(a).alias(b) for a, b in zip(parent_on or on, on)]).distinct()
    c = child.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on]))
    return c.join(p, on, "left_anti")


def check_not_null(df: DataFrame, cols: list) -> DataFrame:
    """Rows with a null (or NaN, for floating columns) in a required column."""
    types = dict(df.dtypes)
    bad = [F.col(c).isNull() | F.isnan(c) if types[c] in ("double", "float") else F.col(c).isNull() for c in cols]
    return df.where(reduce(lambda a, b: a | b, bad))


def check_date_order(ranges: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Ranges whose start is not before their end."""
    return ranges.where(~(F.col(start) < F.col(end)))


def check_no_overlap(ranges: DataFrame, key: str = "instrument_id", start: str = "start_date",
                     end: str = "end_date") -> DataFrame:
    """Half-open ranges overlapping an earlier range of the same key.

    The running max of earlier ends (not just the previous row's end) also
    catches a range contained in an older, longer one.
    """
    w = (Window.partitionBy(key).orderBy(start, end)
         .rowsBetween(Window.unboundedPreceding, -1))
    return (ranges.withColumn("prior_end", F.max(end).over(w))
            .where(F.col("prior_end") > F.col(start)))


def check_enum(df: DataFrame, col: str, allowed: list) -> DataFrame:
    """Rows whose value is not in the allowed set."""
    return df.where(F.col(col).isNull() | ~F.col(col).isin(allowed))


def check_vendor_completeness(requested: DataFrame, vendor: DataFrame, key: str = "ticker",
                              value_cols: list | None = None) -> DataFrame:
    """Requested tickers with no valid (non-null, non-NaN) value, or absent from the answer."""
    cols = value_cols or [c for c, t in vendor.dtypes if t in ("double", "float") or t.startswith("decimal")]
    types = dict(vendor.dtypes)
    valid = reduce(lambda a, b: a | b,
                   [F.col(c).isNotNull() & (~F.isnan(c) if types[c] in ("double", "float") else F.lit(True))
                    for c in cols])
    counts = vendor.groupBy(key).agg(F.count_if(valid).alias("n_valid"))
    return (requested.select(key).distinct().join(counts, key, "left")
            .where(F.coalesce(F.col("n_valid"), F.lit(0)) == 0)
            .select(key, F.when(F.col("n_valid").isNull(), "absent").otherwise("no valid value").alias("reason")))
