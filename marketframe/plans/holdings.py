"""Portfolio holdings: A1 agg_activity_daily, A2 agg_cash_daily, A5/C5 trading days,
C6 portfolio_holdings."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketframe import schemas as S
from marketframe.functions.expressions import expr_cast_date

KEY = ["pf_id", "instrument_id"]
HOLDING = [*KEY, "date", "units", "close_usd"]


def agg_activity_daily(activity: DataFrame) -> DataFrame:
    """A1: net units per portfolio, UTC day and instrument over open/close/split rows."""
    return (activity.where(F.col("type").isin(S.POSITION_TYPES))
            .groupBy("pf_id", expr_cast_date(F.col("ts")).alias("date"), "instrument_id")
            .agg(F.sum("units").alias("units")))


def agg_cash_daily(activity: DataFrame, units: DataFrame) -> DataFrame:
    """A2: all cash flows per portfolio and day as units of the USD instrument."""
    usd_id = units.where(F.col("code") == S.USD_CODE).select("instrument_id").scalar()
    return (activity.groupBy("pf_id", expr_cast_date(F.col("ts")).alias("date"))
            .agg(F.sum("cashflow_usd").alias("units"))
            .select("pf_id", "date", usd_id.alias("instrument_id"), "units"))


def combined_activity(activity: DataFrame, units: DataFrame) -> DataFrame:
    """U1 of positions and cash, re-aggregated per key so a key appears once (fixes
    double counting when a position and cash share a key)."""
    both = agg_activity_daily(activity).unionByName(agg_cash_daily(activity, units))
    return both.groupBy("pf_id", "date", "instrument_id").agg(F.sum("units").alias("units"))


def agg_count_distinct_having(ts_usd: DataFrame, combined: DataFrame, ratio=Decimal("0.5")) -> DataFrame:
    """A5: dates on which strictly more than ``ratio`` of all held instruments have a close.

    Exact ``count(DISTINCT)`` per date against a scalar threshold; the held set
    is a semi join, the bounds are scalar subqueries (no cross join).
    """
    held = combined.select("instrument_id").where(F.col("instrument_id").isNotNull()).distinct()
    n_held = combined.select(F.count_distinct("instrument_id")).scalar()
    lo = combined.select(F.min("date")).scalar()
    # The upper bound of the calendar, max(ts_usd.date), holds for every ts_usd row.
    priced = (ts_usd.where((F.col("field") == "close") & (F.col("date") >= lo))
              .select("instrument_id", "date")
              .join(held, "instrument_id", "left_semi"))
    return (priced.groupBy("date").agg(F.count_distinct("instrument_id").alias("n_priced"))
            .where(F.col("n_priced") > n_held * F.lit(Decimal(str(ratio)))))


def trading_days(ts_usd: DataFrame, combined: DataFrame, ratio=Decimal("0.5")) -> DataFrame:
    """The trading-day calendar (one row per date)."""
    return agg_count_distinct_having(ts_usd, combined, ratio).select("date")


def index_days(days: DataFrame) -> DataFrame:
    """Trading days with their 0-based position (``td_idx``), numbered without a single-task window."""
    from marketframe.operators.windows import dense_index
    return dense_index(days.select("date").withColumn("_g", F.lit(0)), ["_g"], ["date"], out="td_idx").drop("_g")


def next_trading_index(indexed: DataFrame) -> DataFrame:
    """Every calendar day up to the last trading day -> index of the first trading
    day on or after it.  Built by exploding each gap between consecutive trading
    days (equi self-join on the index), so its size is the calendar's."""
    prev = indexed.select((F.col("td_idx") + 1).alias("td_idx"), F.col("date").alias("prev_date"))
    j = indexed.join(prev, "td_idx", "left")
    start = F.coalesce(F.date_add("prev_date", 1), F.col("date"))
    return j.select(F.explode(F.sequence(start, F.col("date"))).alias("cal_date"), "td_idx")


def _placed(spans: DataFrame, indexed: DataFrame) -> DataFrame:
    """Spans with the indexes ``_first`` and ``_last`` of their trading days, [from_date, to_date) (to_date null: to the
    last day), by an equi-join of both ends with the calendar; spans without a trading day drop out."""
    lo, hi = indexed.select(F.min("date")).scalar(), indexed.select(F.max("date")).scalar()
    last = indexed.select(F.max("td_idx")).scalar()
    lookup = next_trading_index(indexed)
    begin = lookup.select(F.col("cal_date").alias("_from"), F.col("td_idx").alias("_first"))
    end = lookup.select(F.col("cal_date").alias("_to"), F.col("td_idx").alias("_stop"))
    # a span that ends on or before the first trading day has no day; one that ends after the last has them all
    open_end = F.col("to_date").isNull() | (F.col("to_date") > hi)
    placed = (spans.where(F.col("to_date").isNull() | (F.col("to_date") > lo))
              .withColumn("_from", F.greatest(F.col("from_date"), lo)).withColumn("_to", F.when(~open_end, F.col("to_date")))
              .join(begin, "_from").join(end, "_to", "left"))
    return (placed.withColumn("_last", F.coalesce(F.col("_stop") - 1, last)).where(F.col("_first") <= F.col("_last"))
            .drop("_from", "_to", "_stop", "from_date", "to_date"))


def _on_days(spans: DataFrame, days: DataFrame) -> DataFrame:
    """One row per trading day in [from_date, to_date) of each span (to_date null: to the last day).

    Both ends become indexes of trading days, the index range is exploded, and an equi-join
    turns indexes back into dates: exactly the output rows are made.
    """
    indexed = index_days(days)
    exploded = _placed(spans, indexed).withColumn("td_idx", F.explode(F.sequence("_first", "_last")))
    return exploded.join(indexed, "td_idx").drop("_first", "_last", "td_idx")


def position_spine(combined: DataFrame, days: DataFrame) -> DataFrame:
    """Every (portfolio, instrument) on every trading day from its first activity on."""
    pairs = combined.groupBy(*KEY).agg(F.min("date").alias("from_date")).withColumn("to_date", F.lit(None).cast("date"))
    return _on_days(pairs, days).select(*KEY, "date")


def portfolio_holdings(activity: DataFrame, ts_usd: DataFrame, units: DataFrame,
                       eps=S.HOLDING_EPS, ratio=Decimal("0.5"), long_only: bool = True,
                       combined: DataFrame | None = None, days: DataFrame | None = None) -> DataFrame:
    """Units held per portfolio, instrument and trading day, with the USD close
    forward filled over the rows kept.

    The running sum is taken over activity rows only; the next activity ends a
    balance, so each is an interval of days.  Intervals not above ``eps`` go, and
    only the others are exploded to trading days: closed positions cost nothing.
    Activity off the trading calendar (weekend deposits) counts from the next
    trading day on.  Closes are filled by balances (:func:`_held`).
    """
    combined = combined if combined is not None else combined_activity(activity, units)
    days = days if days is not None else trading_days(ts_usd, combined, ratio)
    return _held(combined, ts_usd, days, eps, long_only)


def _held(combined: DataFrame, ts_usd: DataFrame, days: DataFrame, eps, long_only: bool) -> DataFrame:
    """Units of every balance above ``eps`` on each of its trading days, with the filled close.

    Closes are looked up by trading-day index in one array an instrument, so only balances and arrays are
    shuffled, never the days of a balance.  A day takes the last close of its balance up to it; before the first of
    these, that at the end of the balance before (``_carry``).
    """
    from marketframe.sources.sinks import materialize
    w = Window.partitionBy(*KEY).orderBy("date")
    balances = combined.select(*KEY, F.col("date").alias("from_date"), F.sum("units").over(w).alias("units"), F.lead("date").over(w).alias("to_date"))
    size = F.col("units") if long_only else F.abs(F.col("units"))
    indexed = index_days(days)
    spans = _placed(balances.where(size > F.lit(Decimal(str(eps)))), indexed)
    closes = materialize(_closes_by_index(ts_usd, indexed), "closes").hint("shuffle_hash")

    def at(index: str):
        place = F.col(index) - F.col("_base")
        return F.when(place >= 0, F.get("_closes", place.cast("int")))

    ended = spans.join(closes, "instrument_id", "left").withColumn("_close", at("_last"))
    ended = ended.withColumn("_end", F.when(F.col("_close.at") >= F.col("_first"), F.col("_close.price"))).drop("_close", "_closes", "_base")
    before = Window.partitionBy(*KEY).orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    carried = ended.withColumn("_carry", F.last("_end", ignorenulls=True).over(before)).drop("_end")
    on_days = carried.join(closes, "instrument_id", "left").withColumn("td_idx", F.explode(F.sequence("_first", "_last"))).withColumn("_close", at("td_idx"))
    filled = F.when(F.col("_close.at") >= F.col("_first"), F.col("_close.price")).otherwise(F.col("_carry"))
    rows = on_days.select(*KEY, "units", "td_idx", filled.alias("_filled"), F.col("_close.more").alias("_more"))
    one = F.array(F.struct(F.lit(None).cast(ts_usd.schema["value"].dataType).alias("value")))
    each = rows.select(*KEY, "units", "td_idx", "_filled", F.explode(F.coalesce("_more", one)).alias("_own"))
    return each.withColumn("close_usd", F.coalesce("_own.value", "_filled")).join(F.broadcast(indexed), "td_idx").select(*HOLDING)


def _with_closes(held: DataFrame, ts_usd: DataFrame) -> DataFrame:
    """Held rows by day with their filled close, for rows that were not made of balances: a join and a window of all days."""
    prices = ts_usd.where(F.col("field") == "close").select("instrument_id", "date", F.col("value").alias("price"))
    # ids share their first letters, so sorting by them compares whole texts: prices are hashed instead
    fill = Window.partitionBy(*KEY).orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return held.join(prices.hint("shuffle_hash"), ["instrument_id", "date"], "left").withColumn("close_usd", F.last("price", ignorenulls=True).over(fill))


def _closes_by_index(ts_usd: DataFrame, indexed: DataFrame) -> DataFrame:
    """One row per instrument: ``_closes[i]`` is the last close up to trading day ``_base`` + i: its price, the index
    ``at`` of its own day, and all prices of this day if it has several rows (``more``).  Bounded by the calendar."""
    last = indexed.select(F.max("td_idx")).scalar()
    close = ts_usd.where((F.col("field") == "close") & F.col("instrument_id").isNotNull())
    w = Window.partitionBy("instrument_id").orderBy("td_idx")
    upto, same_day = w.rowsBetween(Window.unboundedPreceding, Window.currentRow), w.rangeBetween(Window.currentRow, Window.currentRow)
    own = F.when(F.col("value").isNotNull(), F.struct(F.col("td_idx").alias("at"), F.col("value").alias("price")))
    stretches = (close.join(F.broadcast(indexed), "date")
                 .select("instrument_id", "td_idx", F.lead("td_idx").over(w).alias("_next"), F.last(own, ignorenulls=True).over(upto).alias("_last"),
                         F.collect_list(F.struct("value")).over(same_day).alias("more"))
                 .where(F.col("_next").isNull() | (F.col("_next") > F.col("td_idx")))
                 .select("instrument_id", "td_idx", "_last.at", "_last.price", F.when(F.size("more") > 1, F.col("more")).alias("more"),
                         F.coalesce(F.col("_next") - 1, last).alias("_until")))
    filled = stretches.withColumn("i", F.explode(F.sequence("td_idx", "_until")))
    each = F.struct("i", "at", "price", F.when(F.col("i") == F.col("td_idx"), F.col("more")).alias("more"))
    return filled.groupBy("instrument_id").agg(F.min("i").alias("_base"), F.sort_array(F.collect_list(each)).alias("_closes"))


def last_closes(holdings: DataFrame) -> DataFrame:
    """The filled close of the last holding row of each portfolio and instrument: pf_id, instrument_id, date, close_usd."""
    return (holdings.groupBy(*KEY).agg(F.max(F.struct("date", "close_usd")).alias("r"))
            .select(*KEY, F.col("r.date").alias("date"), F.col("r.close_usd").alias("close_usd")))


def holdings_since(start: dt.date, before: DataFrame, combined: DataFrame, ts_usd: DataFrame, days: DataFrame,
                   eps=S.HOLDING_EPS, long_only: bool = True) -> DataFrame:
    """C6 from ``start`` on, equal to the rows that :func:`portfolio_holdings` has there.

    What lies before ``start`` comes in as state: the ledger as one opening balance a pair (an aggregate without a
    window) and prices as the last filled close of each pair (``before``, as by :func:`last_closes`).  Prices and
    trading days before ``start`` are not read; the window and the explode see the later ones alone.
    """
    units = combined.schema["units"].dataType
    opening = (combined.where(F.col("date") < F.lit(start)).groupBy(*KEY).agg(F.sum("units").cast(units).alias("units"))
               .withColumn("date", F.lit(start - dt.timedelta(days=1))))
    later = combined.where(F.col("date") >= F.lit(start)).select(*KEY, "units", "date")
    since = F.col("date") >= F.lit(start)
    filled = _held(opening.unionByName(later), ts_usd.where(since), days.where(since), eps, long_only)
    carried = before.select(*KEY, F.col("close_usd").alias("_carried"))
    return filled.join(carried, KEY, "left").withColumn("close_usd", F.coalesce("close_usd", "_carried")).select(*HOLDING)
