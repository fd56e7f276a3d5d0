"""FX calendar: C1 units_ts, C12 fx_midpoint, C19 synthetic_usd, C21 seed_units."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe import schemas as S
from marketframe.functions.expressions import expr_pipette, expr_prefix
from marketframe.operators.windows import fill_calendar, lag_ratio


def fx_base(canonical: DataFrame, units: DataFrame) -> DataFrame:
    """Scaled close of every unit code (J3: several codes may share one instrument)."""
    u = units.select("instrument_id", "code", "scale")
    return (canonical.where(F.col("field") == "close")
            .join(u, "instrument_id")
            .select("code", "date", (F.col("value") * F.col("scale")).cast(S.FX_VALUE).alias("value")))


def fx_observations(observations: DataFrame, units: DataFrame) -> DataFrame:
    """Close observations of instruments that carry a unit, before canonicalising.

    Canonicalisation groups by instrument, so filtering instruments first is
    exact and keeps the priority aggregate to the (small) FX slice.
    """
    ids = units.select("instrument_id").distinct()
    return observations.where(F.col("field") == "close").join(ids, "instrument_id", "left_semi")


def units_ts(canonical: DataFrame, units: DataFrame, stage: bool = True) -> DataFrame:
    """Daily value per unit code, forward filled, with day-over-day change.

    ``change`` is the ratio to the previous *observed* value; it is 1 on filled
    days and on a code's first day.  Days run from the first to the last date
    of any code; before a code's first value, ``value`` is null.  The base
    (codes × observed days, small) is written once so that the calendar bounds
    do not recompute the canonical aggregate.
    """
    base = fx_base(canonical, units)
    if stage:
        from marketframe.sources.sinks import materialize
        base = materialize(base, "fx_base")
    with_change = lag_ratio(base, "code", "date", "value", out="change")
    lo = base.select(F.min("date")).scalar()
    hi = base.select(F.max("date")).scalar()
    filled = fill_calendar(with_change, "code", "date", ["value", "change"], {"change": 1.0}, lo, hi)
    return filled.select("code", "date", "value", F.coalesce("change", F.lit(1.0)).alias("change"))


def synthetic_usd(observations: DataFrame, fx_instrument_id: str) -> DataFrame:
    """A constant USD close on every date the reference currency has data, unless present."""
    usd = (observations.where(F.col("instrument_id") == fx_instrument_id).select("date").distinct()
           .select(F.lit(S.USD_INSTRUMENT_ID).alias("instrument_id"), F.lit("close").alias("field"), "date",
                   F.lit("system").alias("source"), F.lit(S.USD_PIPETTES).cast(S.VALUE).alias("value")))
    return usd.join(observations.select(*S.OBS_KEY), S.OBS_KEY, "left_anti")


def seed_units(instruments: DataFrame, subunits: DataFrame | None = None) -> DataFrame:
    """One pipette unit per currency instrument (code = first three ticker letters),
    plus sub-units (``code, scale, parent code``) attached to their parent's instrument."""
    cur = (instruments.where(F.col("asset_class") == "currency")
           .select(expr_prefix(F.col("internal_ticker"), 3).alias("code"),
                   F.lit(S.CURRENCY_SCALE).cast(S.UNIT_SCALE).alias("scale"), "instrument_id"))
    if subunits is None:
        return cur
    sub = (subunits.join(cur.select(F.col("code").alias("parent"), "instrument_id"), "parent")
           .select("code", F.col("scale").cast(S.UNIT_SCALE).alias("scale"), "instrument_id"))
    return cur.unionByName(sub)


def fx_midpoint(quotes: DataFrame) -> DataFrame:
    """Mid of bid and inverted ask in pipettes; falls back to bid, then ask.

    Input ``code, date, bid, ask`` where ``ask`` is quoted inverted.  Output is
    long (code, date, value) rows; a day with neither quote yields no row.
    """
    bid = expr_pipette(F.col("bid"), invert=False)
    ask = expr_pipette(F.col("ask"), invert=True)
    mid = F.coalesce((bid + ask) / 2, bid, ask)
    return (quotes.select("code", "date", F.round(mid, 5).alias("value"))
            .where(F.col("value").isNotNull()))


def units_ts_incremental(current: DataFrame, canonical_since: DataFrame, units: DataFrame, since) -> tuple:
    """C1 refresh after a re-pull: recompute only days from ``start`` on.

    ``canonical_since`` holds the canonical rows dated on or after ``since``
    (observations changed only there).  ``start`` is ``since``, or the day
    after the stored calendar's end when new data extends it.  Each code's
    stored value on ``start - 1`` (the last observed value, forward filled)
    is the anchor for both the fill and the day-over-day change, so the
    result equals a full refresh.  Codes new in the batch also get their
    null rows before ``start``.  Returns ``(units_ts, start)``; ``since``
    must be after the calendar's first day (else refresh in full).
    """
    lo = current.select(F.min("date")).scalar()
    old_hi = current.select(F.max("date")).scalar()
    start = F.least(F.lit(since).cast("date"), F.date_add(old_hi, 1))
    base = fx_base(canonical_since, units).where(F.col("date") >= start)
    anchor = current.where(F.col("date") == F.date_sub(start, 1)).select("code", "date", "value")
    rows = anchor.unionByName(base)
    hi = F.greatest(old_hi, base.select(F.max("date")).scalar())
    hi = F.coalesce(hi, old_hi)
    with_change = lag_ratio(rows, "code", "date", "value", out="change")
    filled = fill_calendar(with_change, "code", "date", ["value", "change"], {"change": 1.0},
                           F.date_sub(start, 1), hi)
    fresh = (filled.where(F.col("date") >= start)
             .select("code", "date", "value", F.coalesce("change", F.lit(1.0)).alias("change")))
    new_codes = base.select("code").distinct().join(current.select("code").distinct(), "code", "left_anti")
    head = new_codes.select("code", F.explode(F.sequence(lo, F.date_sub(start, 1))).alias("date"),
                            F.lit(None).cast(S.FX_VALUE).alias("value"), F.lit(1.0).alias("change"))
    kept = current.where(F.col("date") < start).select("code", "date", "value", "change")
    return kept.unionByName(head).unionByName(fresh), start
