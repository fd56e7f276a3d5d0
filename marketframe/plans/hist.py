"""C17 get_hist, R4 pivot_history, U2 missing tickers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.operators.relational import filter_between, filter_in_list
from marketframe.operators.windows import dense_index
from marketframe.operators.writes import RowsError, raise_on_rows


class MissingTickersError(RowsError):
    pass


def _requested(spark, tickers, name="ticker") -> DataFrame:
    if isinstance(tickers, DataFrame):
        return tickers.select(F.col(tickers.columns[0]).alias(name))
    return spark.createDataFrame([(t,) for t in tickers], f"{name} string")


def get_hist(ts_usd: DataFrame, tickers, fields, sdate, edate) -> DataFrame:
    """C17: USD history (ticker, field, date, value) for tickers, fields and inclusive dates.

    ``tickers`` is a list (a predicate) or a one-column DataFrame (a semi join);
    filters are plain predicates, so they reach the Parquet scan of a stored
    ``time_series_usd`` snapshot.
    """
    df = ts_usd.select(F.col("internal_ticker").alias("ticker"), "field", "date", "value")
    df = filter_in_list(df, "ticker", tickers)
    df = filter_in_list(df, "field", fields)
    df = filter_between(df, "date", sdate, edate)
    return df.orderBy("date", "ticker", "field")


def missing_tickers(spark, hist: DataFrame, tickers) -> DataFrame:
    """Requested tickers that have no row in ``hist``."""
    req = _requested(spark, tickers).distinct()
    return req.join(hist.select("ticker").distinct(), "ticker", "left_anti")


def get_hist_checked(ts_usd, tickers, fields, sdate, edate, wide: bool = False) -> DataFrame:
    """``get_hist`` as a user calls it: raises if any ticker has no data (the error's ``rows``
    lists all of them), and gives the wide frame when asked for (``tickers`` a list then)."""
    hist = get_hist(ts_usd, tickers, fields, sdate, edate)
    raise_on_rows(missing_tickers(ts_usd.sparkSession, hist, tickers), MissingTickersError, "no data for tickers")
    return pivot_history(hist, tickers, fields) if wide else hist


def pivot_history(hist: DataFrame, tickers: list[str], fields: list[str]) -> DataFrame:
    """Long to wide, one column ``ticker_field`` for each of the requested tickers and
    fields, in that order: the mean of duplicates, all null where there is no value.

    One grouped aggregate per column over rows filtered to the request, so the
    width is what was asked for and no job is needed to find the columns.
    """
    asked = hist.where(F.col("ticker").isin(list(tickers)) & F.col("field").isin(list(fields)))
    return asked.groupBy("date").agg(*[
        F.avg(F.when((F.col("ticker") == t) & (F.col("field") == f), F.col("value"))).alias(f"{t}_{f}") for t in tickers for f in fields])


def pivot_history_pages(hist: DataFrame, tickers: DataFrame, fields: list[str], size: int = 4) -> DataFrame:
    """R4 for any number of tickers: one row per date and page of ``size`` tickers.

    ``tickers`` (one column, not null) are ranked by name; a ticker's page is its rank
    divided by ``size``, its slot the remainder.  Columns: ``date``, ``page`` and, slot by
    slot, ``ticker_<slot>`` and ``<field>_<slot>`` (the mean of duplicates).  A page has a
    row for a date on which one of its tickers has a value of ``fields``; the ticker of a
    slot without one is null there.
    """
    asked = _requested(hist.sparkSession, tickers).distinct().withColumn("_all", F.lit(0))
    ranked = dense_index(asked, "_all", "ticker", "_rank").select("ticker", F.floor(F.col("_rank") / size).cast("long").alias("page"), (F.col("_rank") % size).cast("int").alias("_slot"))
    found = hist.where(F.col("field").isin(list(fields))).join(ranked, "ticker")
    return found.groupBy("date", "page").agg(*[c for k in range(size) for c in [
        F.max(F.when(F.col("_slot") == k, F.col("ticker"))).alias(f"ticker_{k}"),
        *[F.avg(F.when((F.col("_slot") == k) & (F.col("field") == f), F.col("value"))).alias(f"{f}_{k}") for f in fields]]])
