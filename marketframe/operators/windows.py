"""Window operators N2, N4-N6, N8, N9, N11 and the gap-filling calendar expand.

All windows are partitioned by an entity key (code, instrument, portfolio ×
instrument) and ordered by date, so one partition holds one entity's history:
bounded by the number of calendar days, never by the size of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _w(keys, order):
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, (str, Column)) else list(order)
    return Window.partitionBy(*keys).orderBy(*order)


def lag_ratio(df: DataFrame, keys, order, col: str, out: str = "change") -> DataFrame:
    """Value divided by the previous observed value of the same key (double)."""
    prev = F.lag(F.col(col)).over(_w(keys, order))
    return df.withColumn(out, F.try_divide(F.col(col).cast("double"), prev.cast("double")))


def running_sum(df: DataFrame, keys, order, col: str, out: str | None = None) -> DataFrame:
    """Cumulative sum; default RANGE frame, so rows with equal order value are peers."""
    return df.withColumn(out or col, F.sum(col).over(_w(keys, order)))


def running_count_groups(df: DataFrame, keys, order, col: str, out: str = "grp") -> DataFrame:
    """Running count of non-null ``col``; constant across a gap, so it names the gap group."""
    return df.withColumn(out, F.count(col).over(_w(keys, order)))


def ffill(df: DataFrame, keys, order, col: str, out: str | None = None) -> DataFrame:
    """Forward fill; null before the first value of the partition.

    Same result as first_value over (key, running-count group) when the order
    column is unique within a key, in one window instead of two.
    """
    w = _w(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out or col, F.last(col, ignorenulls=True).over(w))


def pct_change(df: DataFrame, keys, order, col: str, out: str = "pct_change") -> DataFrame:
    """V / previous row - 1, without filling gaps; null on the first row or a zero divisor."""
    prev = F.lag(F.col(col)).over(_w(keys, order))
    return df.withColumn(out, F.try_divide(F.col(col).cast("double"), prev.cast("double")) - F.lit(1.0))


def drop_first_row(df: DataFrame, keys, order) -> DataFrame:
    """Drop the first row of every key."""
    rn = F.row_number().over(_w(keys, order))
    return df.withColumn("_rn", rn).where(F.col("_rn") > 1).drop("_rn")


def dense_index(df: DataFrame, keys, order, out: str = "idx", n_ranges: int | None = None) -> DataFrame:
    """0-based position of each row within its group in ``order`` order (unique within the group),
    without pulling a group into one task.

    The rows are range-partitioned on (group, order) and written once, tagged with
    their slice.  Rows and slice counts both come from that table, so they fit
    whatever bounds were sampled and whichever task is repeated.  Each slice numbers
    its rows; the counts of the slices before it are its offset.
    """
    from marketframe.sources.sinks import materialize
    keys, order = ([c] if isinstance(c, str) else list(c) for c in (keys, order))
    ranges = (df.repartitionByRange(n_ranges, *keys, *order) if n_ranges else df.repartitionByRange(*keys, *order))
    sliced = materialize(ranges.withColumn("_slice", F.spark_partition_id()), "slices")
    local = sliced.withColumn("_rn", F.row_number().over(_w(["_slice", *keys], order)) - 1)
    counts = sliced.groupBy("_slice", *keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("_slice").alias("_of"), *[F.col(k).alias(f"_of_{k}") for k in keys],
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    same = [local["_slice"] == offsets["_of"], *[local[k].eqNullSafe(offsets[f"_of_{k}"]) for k in keys]]
    return local.join(offsets, same).withColumn(out, F.col("_off") + F.col("_rn")).select(*df.columns, out)


def assign_batches(df: DataFrame, keys, order, size: int, out: str = "batch") -> DataFrame:
    """Number the rows of each group by ``order`` and cut them into batches of ``size``."""
    return dense_index(df, keys, order, "_pos").withColumn(out, F.floor(F.col("_pos") / size).cast("int")).drop("_pos")


def reverse_cumprod(df: DataFrame, keys, order_col: str, col: str, out: str) -> DataFrame:
    """Product of ``col`` over the rows strictly after each row (zeros and nulls count as 1)."""
    factor = F.when(F.col(col).isNull() | (F.col(col) == 0), F.lit(1.0)).otherwise(F.col(col).cast("double"))
    w = (Window.partitionBy(*([keys] if isinstance(keys, str) else keys)).orderBy(F.col(order_col).desc())
         .rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn(out, F.coalesce(F.product(factor).over(w), F.lit(1.0)))


def fill_calendar(df: DataFrame, key: str, date_col: str, carry: list[str], gap_defaults: dict,
                  lo: Column, hi: Column) -> DataFrame:
    """Expand sparse observations to one row per key and day between ``lo`` and ``hi``.

    Each observed row is exploded over the days until the next observation
    (``lead``), carrying its columns forward; columns in ``gap_defaults`` take
    the given value on the filled days.  Days before a key's first observation
    get nulls.  This replaces the spine ⨯ facts cross join with one window and
    one ``explode``, so the dense output is produced where the rows already are.
    """
    w = Window.partitionBy(key).orderBy(date_col)
    nxt = F.lead(date_col).over(w)
    first = F.lag(date_col).over(w).isNull()
    start = F.when(first & (F.col(date_col) > lo), lo).otherwise(F.col(date_col))
    stop = F.coalesce(F.date_sub(nxt, 1), hi)
    staged = df.select(key, F.col(date_col).alias("_obs"), *carry,
                       F.sequence(start, stop).alias("_days"))
    out = staged.select(key, "_obs", *carry, F.explode("_days").alias(date_col))
    cols = [key, date_col]
    for c in carry:
        observed = F.col(date_col) >= F.col("_obs")
        if c in gap_defaults:
            cols.append(F.when(F.col(date_col) == F.col("_obs"), F.col(c))
                        .otherwise(F.lit(gap_defaults[c])).alias(c))
        else:
            cols.append(F.when(observed, F.col(c)).alias(c))
    return out.select(*cols)
