"""USD series: J8 effective-dated join, C2-C4 time_series_usd, C22 backfill_instrument_units."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe import schemas as S
from marketframe.functions.expressions import expr_prefix, expr_round_money


def join_effective_range(facts: DataFrame, ranges: DataFrame, key: str = "instrument_id",
                         date_col: str = "date", start_col: str = "start_date",
                         end_col: str = "end_date") -> DataFrame:
    """Attach the range row valid on each fact's date, ``start <= date < end``.

    Equi-join on ``key`` with the half-open range as a residual; ranges are one
    row per (instrument, period), so after the size check they are broadcast
    and the fact side is never shuffled.  Overlapping ranges would multiply
    rows; ``check_no_overlap`` (D6) guards that.
    """
    r = ranges.withColumnRenamed(key, "_range_key")
    cond = ((F.col(key) == F.col("_range_key")) & (F.col(date_col) >= F.col(start_col))
            & (F.col(date_col) < F.col(end_col)))
    return facts.join(r, cond).drop("_range_key")


def _range_states(probes: DataFrame, r: DataFrame, payload: list[str], start_col: str, end_col: str) -> DataFrame:
    """For each key and day on which a range starts or ends, or that is probed: how many ranges are valid
    from then on (``n``) and, of a single one, its columns (``row``).

    Running sums over the starts (+) and ends (-): of ones they count the valid ranges, of range numbers they
    name the range wherever the count is one.
    """
    edges = (r.select("_k", F.col(start_col).alias("_at"), F.lit(1).alias("_n"), F.col("_id"))
             .unionByName(r.select("_k", F.col(end_col).alias("_at"), F.lit(-1).alias("_n"), (-F.col("_id")).alias("_id")))
             .unionByName(probes.select("_k", "_at", F.lit(0).alias("_n"), F.lit(0).alias("_id"))))
    upto = Window.partitionBy("_k").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    states = (edges.groupBy("_k", "_at").agg(F.sum("_n").alias("_n"), F.sum("_id").alias("_id"))
              .select("_k", "_at", F.sum("_n").over(upto).alias("_n"), F.sum("_id").over(upto).alias("_id")))
    single = F.when(F.col("_n") == 1, F.col("_id"))
    rows = r.select(F.col("_k").alias("_rk"), F.col("_id").cast("long").alias("_rid"), F.struct(*payload).alias("_row"))
    return (states.join(rows, (F.col("_k") == F.col("_rk")) & (single == F.col("_rid")), "left")
            .select("_k", "_at", F.struct(F.col("_n").alias("n"), F.col("_row").alias("row")).alias("_state")))


def attach_effective_range(facts: DataFrame, ranges: DataFrame, key: str = "instrument_id", date_col: str = "date",
                           start_col: str = "start_date", end_col: str = "end_date", bucket: str = "year") -> DataFrame:
    """J8 for many ranges per key: the range valid on each fact's date, ``start <= date < end``, in one ordered pass.

    A join with the range as a residual compares each fact with all ranges of its key.  Here the ranges are first cut
    into spans in which the same ranges are valid; then facts and span starts are read in order of the day, and each
    fact takes the last span before it: the cost grows with facts plus ranges.  The pass is split by key and ``bucket``
    (``year``, ``quarter``, ``month`` or ``week``), so a key with a third of all facts is many tasks' work; the span that is
    valid as a bucket begins is carried into it.

    Facts in one range get its columns; facts in several stay one row with null range columns and a
    ``range_error``; facts in none, or with a null key or date, drop out.  Empty or reversed ranges and those with a
    null bound match nothing.  Names of range columns must differ from those of facts.
    """
    payload = [c for c in ranges.columns if c != key]
    clash = (set(payload) | {"range_error"}) & set(facts.columns)
    if clash:
        raise ValueError(f"columns of facts and ranges clash: {sorted(clash)}")
    numbered = F.row_number().over(Window.partitionBy(key).orderBy(start_col, end_col))     # equal ranges are never single
    r = (ranges.where(F.col(key).isNotNull() & (F.col(start_col) < F.col(end_col)))
         .select("*", F.col(key).alias("_k"), numbered.alias("_id")))
    f = facts.where(F.col(key).isNotNull() & F.col(date_col).isNotNull())
    day, begin = F.col(date_col).cast("date"), lambda c: F.trunc(c, bucket)
    probes = f.select(F.col(key).alias("_k"), begin(day).alias("_at")).distinct()
    spans = _range_states(probes, r, payload, start_col, end_col)
    timeline = (spans.select("_k", begin("_at").alias("_b"), "_at", F.lit(0).alias("_kind"), "_state", F.lit(None).alias("_fact"))
                .unionByName(f.select(F.col(key).alias("_k"), begin(day).alias("_b"), day.alias("_at"), F.lit(1).alias("_kind"),
                                      F.lit(None).alias("_state"), F.struct(*facts.columns).alias("_fact"))))
    upto = Window.partitionBy("_k", "_b").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = timeline.withColumn("_state", F.last("_state", ignorenulls=True).over(upto)).where((F.col("_kind") == 1) & (F.col("_state.n") > 0))
    many = F.when(F.col("_state.n") > 1, F.concat(F.col("_state.n").cast("string"), F.lit(" ranges are valid on this day")))
    return found.select(*[F.col("_fact")[c].alias(c) for c in facts.columns],
                        *[F.col("_state.row")[c].alias(c) for c in payload], many.alias("range_error"))


def _usd_frame(canonical, instruments, fields, instrument_units, units_ts):
    inst = instruments.select("instrument_id", "internal_ticker", "asset_class")
    # a row per field: shuffled by field, all observations would meet in as many tasks as there are fields
    fld = F.broadcast(fields.select(F.col("name").alias("field"), "fx_conversion"))
    iu = instrument_units.select("instrument_id", F.col("unit").alias("code"), "start_date", "end_date")
    o = canonical.join(inst, "instrument_id").join(fld, "field")
    o = join_effective_range(o, iu)
    u = units_ts.select("code", "date", F.col("value").alias("fx_value"), F.col("change").alias("fx_change"))
    return o.join(u, ["code", "date"])


def time_series_usd(canonical: DataFrame, instruments: DataFrame, fields: DataFrame,
                    instrument_units: DataFrame, units: DataFrame, units_ts: DataFrame,
                    fx_return_mode: str = "reference") -> DataFrame:
    """C4: every canonical value in USD, rounded to 5 places.

    Currencies use their own unit scale (unit looked up by the first three
    letters of the ticker, J12); ``change`` fields are multiplied by the FX
    change and all others by the FX value of the unit valid on that date.
    Observations off the FX calendar drop out (inner join, kept as in the
    reference).  ``fx_return_mode="compound"`` compounds a percent return with
    the FX change instead of multiplying.
    """
    f = _usd_frame(canonical, instruments, fields, instrument_units, units_ts)
    scale = units.select(F.col("code").alias("ccy_code"), F.col("scale").alias("ccy_scale"))
    f = f.join(scale, expr_prefix(f["internal_ticker"], 3) == scale["ccy_code"], "left")
    v = F.col("value")
    by_scale = expr_round_money(v * F.col("ccy_scale"))
    if fx_return_mode == "compound":
        chg = ((F.lit(1.0) + v.cast("double") / 100) * F.col("fx_change") - 1) * 100
    else:
        chg = v.cast("double") * F.col("fx_change")
    by_change = expr_round_money(chg)
    by_value = expr_round_money(v * F.col("fx_value"))
    value = (F.when(F.col("asset_class") == "currency", by_scale)
             .when(F.col("fx_conversion") == "change", by_change)
             .otherwise(by_value))
    return f.select("instrument_id", "internal_ticker", "field", "date", value.alias("value"))


def time_series_usd_dated(canonical, instruments, fields, instrument_units, units_ts) -> DataFrame:
    """Effective-dated units, no currency rule, unrounded."""
    f = _usd_frame(canonical, instruments, fields, instrument_units, units_ts)
    exact = T.DecimalType(38, 13)
    value = (F.when(F.col("fx_conversion") == "change",
                    (F.col("value").cast("double") * F.col("fx_change")).cast(exact))
             .otherwise((F.col("value") * F.col("fx_value")).cast(exact)))
    return f.select("instrument_id", "internal_ticker", "field", "date", value.alias("value"))


def time_series_usd_static(canonical, instrument_unit, fields, units_ts) -> DataFrame:
    """One fixed unit per instrument (``instrument_id, unit``), no date ranges."""
    ranges = instrument_unit.select("instrument_id", "unit", F.lit(S.DEFAULT_START).alias("start_date"),
                                    F.lit(S.OPEN_END).alias("end_date"))
    inst = instrument_unit.select("instrument_id", F.col("instrument_id").alias("internal_ticker"),
                                  F.lit("any").alias("asset_class"))
    if "internal_ticker" in instrument_unit.columns:
        inst = instrument_unit.select("instrument_id", "internal_ticker", F.lit("any").alias("asset_class"))
    return time_series_usd_dated(canonical, inst, fields, ranges, units_ts)


def backfill_instrument_units(instrument_unit: DataFrame, observations: DataFrame) -> DataFrame:
    """One open-ended range per instrument, starting at its first observation
    (1900-01-01 when it has none).  ``instrument_unit`` has ``instrument_id, unit``."""
    first = observations.groupBy("instrument_id").agg(F.min("date").alias("first_date"))
    return (instrument_unit.join(first, "instrument_id", "left")
            .select("instrument_id", expr_prefix(F.col("unit"), 3).alias("unit"),
                    F.coalesce("first_date", F.lit(S.DEFAULT_START)).alias("start_date"),
                    F.lit(S.OPEN_END).alias("end_date")))


def time_series_usd_incremental(current: DataFrame, canonical_since: DataFrame, instruments: DataFrame,
                                fields: DataFrame, instrument_units: DataFrame, units: DataFrame,
                                units_ts: DataFrame, start) -> DataFrame:
    """C4 refresh after a re-pull: rows dated before ``start`` are kept, the rest
    are recomputed from ``canonical_since`` (canonical rows on or after
    ``start``) and the refreshed FX series.  Exact as long as dimensions and
    older observations did not change (they would call for a full refresh)."""
    fresh = time_series_usd(canonical_since.where(F.col("date") >= start), instruments, fields, instrument_units,
                            units, units_ts.where(F.col("date") >= start))
    kept = current.where(F.col("date") < start).select(*fresh.columns)
    return kept.unionByName(fresh)
