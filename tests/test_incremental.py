"""Incremental refresh of the stored views equals a full refresh."""
import datetime as dt

from pyspark.sql import functions as F

from marketframe.operators.canonical import canonical_obs
from marketframe.operators.writes import upsert_observations
from marketframe.plans import fx, usd


def _rows(df, cols, places=9):
    out = []
    for r in df.select(*cols).collect():
        out.append(tuple(round(float(x), places) if isinstance(x, (float,)) or hasattr(x, "as_tuple") else x
                         for x in r))
    return sorted(out, key=lambda t: tuple(str(x) for x in t))


def test_incremental_refresh_matches_full(model):
    md = model
    old_can = canonical_obs(md.observations, md.sources)
    old_uts = fx.units_ts(canonical_obs(fx.fx_observations(md.observations, md.units), md.sources), md.units)
    old_ts = usd.time_series_usd(old_can, md.instruments, md.fields, md.instrument_units, md.units, old_uts)
    batch = md.upsert_batch
    since = batch.select(F.min("date")).first()[0]
    new_obs = upsert_observations(md.observations, batch, "seq")
    new_can = canonical_obs(new_obs, md.sources)

    full_uts = fx.units_ts(canonical_obs(fx.fx_observations(new_obs, md.units), md.sources), md.units)
    full_ts = usd.time_series_usd(new_can, md.instruments, md.fields, md.instrument_units, md.units, full_uts)

    recent = new_obs.where(F.col("date") >= F.lit(since))
    inc_uts, start = fx.units_ts_incremental(old_uts, canonical_obs(fx.fx_observations(recent, md.units), md.sources),
                                             md.units, since)
    recent_all = new_obs.where(F.col("date") >= start)
    inc_ts = usd.time_series_usd_incremental(old_ts, canonical_obs(recent_all, md.sources), md.instruments,
                                             md.fields, md.instrument_units, md.units, inc_uts, start)
    cols_u = ["code", "date", "value", "change"]
    assert _rows(inc_uts, cols_u) == _rows(full_uts, cols_u)
    cols_t = ["instrument_id", "field", "date", "value"]
    assert _rows(inc_ts, cols_t) == _rows(full_ts, cols_t)
    assert since > dt.date(2001, 6, 30)


def test_daily_run_second_run_is_incremental_and_stable(spark, model):
    import os
    import uuid

    from marketframe.plans.ingest import daily_run
    from marketframe.session import checkpoint_dir
    from marketframe.sources.sinks import current_version, read_manifest
    root = os.path.join(checkpoint_dir(spark), "tests", f"daily-{uuid.uuid4().hex}")
    vendor = model.vendor_prices
    as_of = vendor.select(F.max("date")).first()[0]
    cols = ["instrument_id", "field", "date", "value"]
    big = ("observations", "time_series_usd")
    parts = lambda: {t: read_manifest(spark, root)["tables"][t]["parts"] for t in big}
    a = _rows(daily_run(model, vendor, as_of, root)["time_series_usd"], cols)
    v, first = current_version(spark, root, "time_series_usd"), parts()
    second = daily_run(model, vendor, as_of, root)["time_series_usd"]     # same landing again: no field-year is written
    assert parts() == first and current_version(spark, root, "time_series_usd") == v
    assert _rows(second, cols) == a


def _state_is_full(spark, model, root):
    """The published portfolio state equals one computed in full from the published series."""
    from marketframe.plans.holdings import combined_activity, portfolio_holdings, trading_days
    from marketframe.plans.nav import agg_nav, portfolio_nav_returns
    from marketframe.plans.refresh import is_anchored
    from marketframe.sources.sinks import read_manifest, read_table
    assert is_anchored(read_manifest(spark, root))
    ts = read_table(spark, root, "time_series_usd")
    combined = combined_activity(model.activity, model.units)
    days = trading_days(ts, combined)
    full = portfolio_holdings(model.activity, ts, model.units, combined=combined, days=days)
    stored = read_table(spark, root, "portfolio_holdings")
    assert _rows(read_table(spark, root, "portfolio_days"), ["date"]) == _rows(days, ["date"])
    cols = ["pf_id", "instrument_id", "date", "units", "close_usd"]
    assert _rows(stored, cols) == _rows(full, cols)
    assert _rows(read_table(spark, root, "portfolio_nav"), ["pf_id", "date", "nav"]) == _rows(agg_nav(full), ["pf_id", "date", "nav"])
    last = {}
    for r in full.collect():
        key = (r.pf_id, r.instrument_id, r.date.year)
        last[key] = max(last.get(key, r.date), r.date)
    assert {(r.pf_id, r.instrument_id, r.date.year): r.date for r in read_table(spark, root, "portfolio_positions").collect()} == last
    key = ["instrument_id", "field", "date", "source", "value"]
    wanted = set(_rows(portfolio_nav_returns(full, model.activity), key))
    assert wanted and wanted <= set(_rows(read_table(spark, root, "observations").where("source = 'system'"), key))


def test_portfolios_are_refreshed_from_the_first_changed_day(spark, model):
    import copy
    import os
    import uuid

    from marketframe.plans.ingest import daily_run
    from marketframe.session import checkpoint_dir
    from marketframe.sources.sinks import commit, read_manifest, read_table, stage_upsert
    root = os.path.join(checkpoint_dir(spark), "tests", f"daily-{uuid.uuid4().hex}")
    vendor = model.vendor_prices
    as_of = vendor.select(F.max("date")).first()[0]
    state = ["portfolio_holdings", "portfolio_positions", "portfolio_nav", "portfolio_ledger"]
    tables = lambda: read_manifest(spark, root)["tables"]
    year = lambda key: int(key.split("=")[-1])
    daily_run(model, vendor, as_of, root)
    _state_is_full(spark, model, root)
    before = tables()

    daily_run(model, vendor, as_of, root)                    # nothing new: no state is written
    assert {t: tables()[t] for t in [*state, "portfolio_days"]} == {t: before[t] for t in [*state, "portfolio_days"]}

    # one close of the pull window is corrected
    window = as_of - dt.timedelta(days=20)
    held = read_table(spark, root, "portfolio_holdings").select("instrument_id").distinct()
    tickers = model.identifiers.where("source = 'YAHOO'").join(held, "instrument_id", "left_semi").select(F.col("ext_id").alias("ticker"))
    hit = vendor.where((F.col("date") >= F.lit(window)) & (F.col("date") < F.lit(as_of))).join(tickers, "ticker", "left_semi").orderBy("date", "ticker").first()
    fixed = (F.col("ticker") == hit.ticker) & (F.col("date") == F.lit(hit.date))
    corrected = vendor.withColumn("close", F.when(fixed, F.col("close") * 2).otherwise(F.col("close"))).withColumn(
        "adj_close", F.when(fixed, F.col("adj_close") * 2).otherwise(F.col("adj_close")))
    # and a trade leaves the ledger: the years before it stay
    middle = model.activity.select(F.percentile_approx("ts", 0.5)).first()[0]
    later = copy.copy(model)
    trade = model.activity.where((F.col("type") == "open") & (F.col("ts") >= F.lit(middle))).orderBy("ts", "pf_id", "instrument_id").first()
    later.activity = model.activity.where(~((F.col("ts") == F.lit(trade.ts)) & (F.col("pf_id") == trade.pf_id) & (F.col("type") == "open")))
    daily_run(later, corrected, as_of, root)
    _state_is_full(spark, later, root)
    for t in state:
        old, new = before[t]["parts"], tables()[t]["parts"]
        assert all(new[k] == f for k, f in old.items() if year(k) < trade.ts.year), t
        assert any(new.get(k) != f for k, f in old.items() if year(k) >= trade.ts.year), t

    # another job writes the series: the state is no longer its own, and is made in full
    commit(spark, root, [stage_upsert(read_table(spark, root, "time_series_usd").where("field = 'close'").limit(1).withColumn("value", F.col("value") + 1),
                                      root, "time_series_usd", ["instrument_id", "field", "date"], ["field", "year(date)"])])
    daily_run(later, corrected, as_of, root)
    _state_is_full(spark, later, root)


class Small:
    """One currency and two equities; one equity is scheduled for closes alone."""

    def __init__(self, spark, model):
        from marketframe import schemas as S
        day = dt.date(2023, 12, 1)
        frame = spark.createDataFrame
        self.sources, self.fields, self.activity = model.sources, model.fields, model.activity.limit(0)
        self.instruments = frame([("CUR1", "Euro", "currency", "EURUSD"), ("EQU1", "One", "equity", "ONE"), ("EQU2", "Two", "equity", "TWO"),
                                  (S.USD_INSTRUMENT_ID, "Dollar", "currency", "USDUSD")], S.INSTRUMENTS)
        self.identifiers = frame([("CUR1", "YAHOO", "EUR=X"), ("EQU1", "YAHOO", "ONE"), ("EQU2", "YAHOO", "TWO")], S.IDENTIFIERS)
        self.updates = frame([("CUR1", "close", "YAHOO", "daily", day), ("EQU1", "close", "YAHOO", "daily", day), ("EQU2", "close", "YAHOO", "daily", day),
                              ("EQU2", "totret", "YAHOO", "daily", day)], S.UPDATES)
        scale = "cast(0.00001 as decimal(10,7)) as scale"
        self.units = frame([("EUR", "CUR1"), ("USD", S.USD_INSTRUMENT_ID)], "code string, instrument_id string").selectExpr("code", scale, "instrument_id")
        self.instrument_units = self.instruments.select("instrument_id", F.lit("USD").alias("unit"), F.lit(S.DEFAULT_START).alias("start_date"), F.lit(S.OPEN_END).alias("end_date"))
        self.observations = frame([], S.OBSERVATIONS)


def test_daily_run_currencies_windows_and_scheduled_fields(spark, model):
    import os
    import uuid

    from marketframe import schemas as S
    from marketframe.plans.ingest import daily_run
    from marketframe.session import checkpoint_dir
    root = os.path.join(checkpoint_dir(spark), "tests", f"daily-{uuid.uuid4().hex}")
    as_of = dt.date(2024, 2, 1)
    start = as_of - dt.timedelta(days=30)
    days = [start - dt.timedelta(days=1), start, start + dt.timedelta(days=1), as_of]
    rows = [(t, d, v + i, v + i, 0.0, 1) for t, v in (("EUR=X", 0.5), ("ONE", 10.0), ("TWO", 20.0)) for i, d in enumerate(days)]
    rows += [("ONE", start, 77.0, 77.0, 0.0, 2)]         # the later row of a key wins, though smaller ones come first
    vendor = spark.createDataFrame(rows, "ticker string, date date, close double, adj_close double, stock_splits double, seq int")
    vendor = vendor.where("not (ticker = 'ONE' and seq = 1 and date = date'2024-01-02')").unionByName(
        spark.createDataFrame([("ONE", start, 99.0, 99.0, 0.0, 1)], vendor.schema))
    out = daily_run(Small(spark, model), vendor, as_of, root)
    got = {(r.instrument_id, r.field, r.date): float(r.value) for r in out["observations"].collect()}
    assert got[("CUR1", "close", days[1])] == round(1e5 / 1.5, 5) and got[(S.USD_INSTRUMENT_ID, "close", days[1])] == 100000.0
    assert got[("EQU1", "close", days[1])] == 77.0 and ("EQU1", "totret", days[2]) not in got      # closes alone: first close kept
    assert ("EQU2", "close", days[0]) not in got and ("EQU2", "close", days[1]) in got and ("EQU2", "totret", days[1]) in got
    assert not any(d in (days[0], as_of) for _, _, d in got)                                         # window: start kept, end exclusive
    assert out["ingest_failures"].count() == 0
