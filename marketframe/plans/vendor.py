"""Vendor landings to observations: N7 reverse_cumprod_splits, C10 vendor_to_observations,
C11 lseg_to_observations, C12 (see fx), C20 pull_outcome, C23 vendor_price_check."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.functions.expressions import expr_relative_gap
from marketframe.operators.relational import filter_not_null, unpivot_columns
from marketframe.operators.windows import drop_first_row, pct_change, reverse_cumprod

# Scale of each field and the vendor column it is built from.
FIELD_SCALE = {"close": Decimal("1"), "totret": Decimal("0.01")}


def reverse_cumprod_splits(vendor: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``split_mult`` = product of the split factors strictly after each row, per ticker."""
    return reverse_cumprod(vendor, by or ["ticker"], "date", "stock_splits", "split_mult")


def vendor_to_observations(vendor: DataFrame, fields: list[str], source: str = "YAHOO", by: list[str] | None = None) -> DataFrame:
    """Landed daily rows (ticker, date, close, adj_close, stock_splits) to long
    (identifier, field, date, source, value, scale) rows, and ``seq`` if they have one.

    ``close`` is the split-adjusted close times later split factors (raw
    close); ``totret`` is the percent change of the adjusted close, and when it
    is asked for, each ticker's first row is dropped (for every field).  All
    tickers go through one window job instead of a loop per ticker.  ``by`` names the
    columns of one pull window (default: the ticker).
    """
    by = by or ["ticker"]
    v = filter_not_null(vendor, ["close", "adj_close"], how="all")
    if "close" in fields:
        v = reverse_cumprod_splits(v, by).withColumn("raw_close", F.col("close") * F.col("split_mult"))
    if "totret" in fields:
        v = pct_change(v, by, "date", "adj_close", out="totret").withColumn("totret", F.col("totret") * 100)
        v = drop_first_row(v, by, "date")
    seq = ["seq"] if "seq" in vendor.columns else []
    wide = v.select(F.col("ticker").alias("identifier"), "date", *seq,
                    *[F.col("raw_close" if f == "close" else f).alias(f) for f in fields])
    long = unpivot_columns(wide, ["identifier", "date", *seq], fields, "field", "value")
    scale = F.create_map(*[F.lit(x) for kv in FIELD_SCALE.items() for x in kv])
    return long.select("identifier", "field", "date", F.lit(source).alias("source"), "value",
                       scale[F.col("field")].alias("scale"), *seq)


def lseg_to_observations(wide: DataFrame, field: str, id_col: str = "date", source: str = "LSEG") -> DataFrame:
    """C11: wide frame (date + one column per RIC) to long rows, nulls dropped."""
    values = [c for c in wide.columns if c != id_col]
    long = unpivot_columns(wide, [id_col], values, "identifier", "value", dropna=True)
    return long.select(F.col(id_col).alias("date"), "identifier", F.lit(source).alias("source"),
                       F.lit(field).alias("field"), F.lit(FIELD_SCALE[field]).alias("scale"), "value")


def pull_outcome(requested: DataFrame, received: DataFrame, fields: list[str], source: str = "YAHOO",
                 threshold: float = 0.10, message: str = "no data returned"):
    """C20: failed tickers × fields with an error text, and a one-row summary.

    Fields are exploded from a literal array (no cross join).  Severity is
    ``error`` below ``threshold`` failed, else ``critical``.
    """
    req = requested.select(F.col(requested.columns[0]).alias("ticker")).distinct()
    got = received.select(F.col(received.columns[0]).alias("ticker")).distinct()
    failed = req.join(got, "ticker", "left_anti")
    rows = failed.select("ticker", F.explode(F.array(*[F.lit(f) for f in fields])).alias("field"),
                         F.lit(source).alias("source"), F.lit(message).alias("error_message"))
    flagged = req.join(got.withColumn("_hit", F.lit(True)), "ticker", "left")
    counts = flagged.agg(F.count(F.lit(1)).alias("n_requested"), F.count_if(F.col("_hit").isNull()).alias("n_failed"))
    share = F.try_divide(F.col("n_failed").cast("double"), F.col("n_requested").cast("double"))
    summary = counts.select("n_requested", "n_failed", (share * 100).alias("pct_failed"),
                            F.when(F.col("n_failed") == 0, "ok").when(share < threshold, "error")
                            .otherwise("critical").alias("severity"))
    return rows, summary


def vendor_price_check(a: DataFrame, b: DataFrame, on: list | str = "instrument_id", on_date=None,
                       tolerance: float = 0.005) -> DataFrame:
    """Closes of two vendors side by side; keep pairs with a missing side or a
    relative gap above ``tolerance`` (gap = |a - b| / a).  ``on_date`` limits the
    check to one day; by default every common day is checked."""
    keys = [on] if isinstance(on, str) else list(on)
    if on_date is not None:
        a = a.where(F.col("date") == F.lit(on_date))
        b = b.where(F.col("date") == F.lit(on_date))
    j = (a.select(*keys, "date", F.col("value").alias("value_a"))
         .join(b.select(*keys, "date", F.col("value").alias("value_b")), keys + ["date"], "full_outer"))
    gap = expr_relative_gap(F.col("value_a"), F.col("value_b"))
    return (j.withColumn("gap", gap)
            .where(F.col("value_a").isNull() | F.col("value_b").isNull() | F.col("gap").isNull()
                   | (F.col("gap") > F.lit(tolerance))))
