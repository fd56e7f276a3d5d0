"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` plus the DuckDB
oracle SQL of each.  Final numbers are DOUBLE rounded on both sides (5 places,
10 for FX values and ratios); dates are DATE."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.plans import oracle
from marketframe.plans.model import Model

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle_body: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle_body is not None:
            ORACLE[name] = oracle.sql(oracle_body)
        return fn
    return deco


def dbl(c, places: int = 5):
    return F.round(F.col(c).cast("double"), places).alias(c) if isinstance(c, str) else c


# sf_dir -> folder of staged base tables (set by the bench; queries then read stored Parquet).
STAGED: dict[str, str] = {}


def m(spark, sf_dir) -> Model:
    if sf_dir in STAGED:
        from marketframe.plans.model import StoredModel
        return StoredModel(spark, sf_dir, STAGED[sf_dir])
    return Model(spark, sf_dir)


# ============================================================ core slice
@register("canonical_obs", """
    SELECT instrument_id, field, date, ROUND(CAST(value AS DOUBLE), 5) AS value FROM v_canonical""")
def q_canonical_obs(spark, sf_dir):
    return m(spark, sf_dir).canonical.select("instrument_id", "field", "date", dbl("value"))


@register("units_ts", """
    SELECT code, date, ROUND(CAST(value AS DOUBLE), 10) AS value, ROUND(change, 10) AS change FROM v_units_ts""")
def q_units_ts(spark, sf_dir):
    return m(spark, sf_dir).refresh_units_ts().select("code", "date", dbl("value", 10), dbl("change", 10))


@register("time_series_usd", """
    SELECT instrument_id, internal_ticker, field, date, ROUND(CAST(value AS DOUBLE), 5) AS value FROM v_ts_usd""")
def q_time_series_usd(spark, sf_dir):
    return m(spark, sf_dir).refresh_ts_usd().select("instrument_id", "internal_ticker", "field", "date", dbl("value"))


HIST_FROM, HIST_TO = dt.date(1990, 1, 1), dt.date(2030, 12, 31)


@register("get_hist", """
    SELECT internal_ticker AS ticker, field, date, ROUND(CAST(value AS DOUBLE), 5) AS value
    FROM v_ts_usd
    WHERE internal_ticker IN (SELECT internal_ticker FROM m_instruments WHERE asset_class = 'equity')
      AND field IN ('close', 'totret') AND date BETWEEN DATE '1990-01-01' AND DATE '2030-12-31'""")
def q_get_hist(spark, sf_dir):
    from marketframe.plans.hist import get_hist
    md = m(spark, sf_dir)
    h = get_hist(md.ts_usd, md.equity_tickers(), ["close", "totret"], HIST_FROM, HIST_TO)
    return h.select("ticker", "field", "date", dbl("value"))


# ============================================================ portfolio chain
def _combined(md):
    return md.combined


@register("agg_activity_daily", """
    SELECT pf_id, date, instrument_id, ROUND(CAST(units AS DOUBLE), 5) AS units FROM v_activity_daily""")
def q_agg_activity_daily(spark, sf_dir):
    from marketframe.plans.holdings import agg_activity_daily
    return agg_activity_daily(m(spark, sf_dir).activity).select("pf_id", "date", "instrument_id", dbl("units"))


@register("agg_cash_daily", """
    SELECT pf_id, date, instrument_id, ROUND(CAST(units AS DOUBLE), 5) AS units FROM v_cash_daily""")
def q_agg_cash_daily(spark, sf_dir):
    from marketframe.plans.holdings import agg_cash_daily
    md = m(spark, sf_dir)
    return agg_cash_daily(md.activity, md.units).select("pf_id", "date", "instrument_id", dbl("units"))


@register("union_all", """
    SELECT pf_id, date, instrument_id, ROUND(CAST(units AS DOUBLE), 5) AS units
    FROM (SELECT * FROM v_activity_daily UNION ALL SELECT * FROM v_cash_daily)""")
def q_union_all(spark, sf_dir):
    from marketframe.operators.relational import union_all
    from marketframe.plans.holdings import agg_activity_daily, agg_cash_daily
    md = m(spark, sf_dir)
    u = union_all(agg_activity_daily(md.activity), agg_cash_daily(md.activity, md.units))
    return u.select("pf_id", "date", "instrument_id", dbl("units"))


@register("agg_count_distinct_having", "SELECT date, n_priced FROM v_priced_days")
def q_agg_count_distinct_having(spark, sf_dir):
    from marketframe.plans.holdings import agg_count_distinct_having
    md = m(spark, sf_dir)
    return agg_count_distinct_having(md.ts_usd, _combined(md))


@register("trading_days", "SELECT date FROM v_trading_days")
def q_trading_days(spark, sf_dir):
    from marketframe.plans.holdings import trading_days
    md = m(spark, sf_dir)
    return trading_days(md.ts_usd, _combined(md))


@register("portfolio_holdings", """
    SELECT pf_id, instrument_id, date, ROUND(CAST(units AS DOUBLE), 5) AS units,
           ROUND(CAST(close_usd AS DOUBLE), 5) AS close_usd FROM v_holdings""")
def q_portfolio_holdings(spark, sf_dir):
    return m(spark, sf_dir).holdings.select("pf_id", "instrument_id", "date", dbl("units"), dbl("close_usd"))


@register("agg_nav", "SELECT pf_id, date, ROUND(CAST(nav AS DOUBLE), 5) AS nav FROM v_nav")
def q_agg_nav(spark, sf_dir):
    from marketframe.plans.nav import agg_nav
    return agg_nav(m(spark, sf_dir).holdings).select("pf_id", "date", dbl("nav"))


@register("agg_external_flows", "SELECT pf_id, date, ROUND(CAST(cashflow AS DOUBLE), 5) AS cashflow FROM v_cash_adj")
def q_agg_external_flows(spark, sf_dir):
    from marketframe.plans.nav import agg_external_flows
    return agg_external_flows(m(spark, sf_dir).activity).select("pf_id", "date", dbl("cashflow"))


@register("join_asof_forward", """
    SELECT pf_id, nav_date, ROUND(CAST(cashflow AS DOUBLE), 5) AS cashflow FROM v_flow_at_nav""")
def q_join_asof_forward(spark, sf_dir):
    from marketframe.plans.nav import agg_external_flows, agg_nav, join_asof_forward
    md = m(spark, sf_dir)
    j = join_asof_forward(agg_external_flows(md.activity), agg_nav(md.holdings))
    return j.select("pf_id", "nav_date", dbl("cashflow"))


@register("lag_return", """
    SELECT pf_id, date, ROUND(CAST(nav AS DOUBLE), 5) AS nav, ROUND(CAST(cashflow AS DOUBLE), 5) AS cashflow,
           ROUND(totret, 4) AS totret FROM v_nav_joined""")
def q_lag_return(spark, sf_dir):
    from marketframe.plans.nav import agg_external_flows, join_asof_forward, lag_return
    md = m(spark, sf_dir)
    nav = md.nav
    r = lag_return(nav, join_asof_forward(agg_external_flows(md.activity), nav))
    return r.select("pf_id", "date", dbl("nav"), dbl("cashflow"), dbl("totret", 4))


@register("portfolio_nav_returns", """
    SELECT instrument_id, field, date, source, CAST(value AS DOUBLE) AS value FROM v_nav_returns""")
def q_portfolio_nav_returns(spark, sf_dir):
    return m(spark, sf_dir).nav_returns.select("instrument_id", "field", "date", "source", dbl("value"))


ANCHOR = dt.date(1996, 1, 1)      # a day inside the ledger: the queries below compute only what follows it


@register("holdings_since", """
    SELECT pf_id, instrument_id, date, ROUND(CAST(units AS DOUBLE), 5) AS units,
           ROUND(CAST(close_usd AS DOUBLE), 5) AS close_usd FROM v_holdings WHERE date >= DATE '1996-01-01'""")
def q_holdings_since(spark, sf_dir):
    from marketframe.plans.holdings import holdings_since, last_closes
    md = m(spark, sf_dir)
    before = last_closes(md.holdings.where(F.col("date") < F.lit(ANCHOR)))
    h = holdings_since(ANCHOR, before, _combined(md), md.ts_usd, md.trading_days)
    return h.select("pf_id", "instrument_id", "date", dbl("units"), dbl("close_usd"))


@register("nav_returns_since", """
    SELECT instrument_id, field, date, source, CAST(value AS DOUBLE) AS value FROM v_nav_returns WHERE date >= DATE '1996-01-01'""")
def q_nav_returns_since(spark, sf_dir):
    from marketframe.plans.nav import agg_external_flows, last_navs, nav_returns_since
    md = m(spark, sf_dir)
    nav = md.nav
    before = last_navs(nav.where(F.col("date") < F.lit(ANCHOR)))
    r = nav_returns_since(nav.where(F.col("date") >= F.lit(ANCHOR)), agg_external_flows(md.activity), before)
    return r.select("instrument_id", "field", "date", "source", dbl("value"))


@register("refresh_portfolios", """
    SELECT instrument_id, field, date, source, CAST(value AS DOUBLE) AS value FROM v_refreshed""")
def q_refresh_portfolios(spark, sf_dir):
    from marketframe.plans.nav import refresh_portfolios
    md = m(spark, sf_dir)
    return refresh_portfolios(md.observations, md.holdings, md.activity).select(
        "instrument_id", "field", "date", "source", dbl("value"))


# ============================================================ writes
@register("upsert_observations", """
    SELECT instrument_id, field, date, source, CAST(value AS DOUBLE) AS value FROM v_upserted""")
def q_upsert_observations(spark, sf_dir):
    from marketframe.operators.writes import upsert_observations
    md = m(spark, sf_dir)
    return upsert_observations(md.observations, md.upsert_batch, "seq").select(
        "instrument_id", "field", "date", "source", dbl("value"))


from marketframe.plans import catalog_ops  # noqa: E402,F401  (registers its queries)
from marketframe.plans import catalog_plans  # noqa: E402,F401
