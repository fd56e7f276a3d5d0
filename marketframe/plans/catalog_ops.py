"""Registered queries for the single operators of SURVEY §2 (P, J, A, N, O, U, R, X)
and the composites around the vendor, schedule and statement chains."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from marketframe.operators import relational as R
from marketframe.operators import windows as N
from marketframe.plans.catalog import dbl, m, register
from marketframe.sources.driver_tables import AS_OF

CUTOFF = dt.date(2001, 10, 20)


# ============================================================ P: projections and filters
@register("project_literals", """
    SELECT instrument_id, date, ROUND(CAST(value AS DOUBLE), 5) AS value, CAST(0.00001 AS DOUBLE) AS unit_scale,
           'LSEG' AS vendor FROM m_fx_obs""")
def q_project_literals(spark, sf_dir):
    df = R.project_literals(m(spark, sf_dir).fx_observations, {"unit_scale": 0.00001, "vendor": "LSEG"},
                            keep={"instrument_id": "instrument_id", "date": "date", "value": "value"})
    return df.select("instrument_id", "date", dbl("value"), "unit_scale", "vendor")


@register("project_reorder", """
    SELECT date, ticker AS identifier, ROUND(close, 5) AS close, ROUND(adj_close, 5) AS adjusted FROM m_vendor_prices""")
def q_project_reorder(spark, sf_dir):
    df = R.project_reorder(m(spark, sf_dir).vendor_prices, {"ticker": "identifier", "adj_close": "adjusted"},
                           ["date", "identifier", "close", "adjusted"])
    return df.select("date", "identifier", dbl("close"), dbl("adjusted"))


@register("filter_not_null", """
    SELECT code, date, ROUND(bid, 10) AS bid, ROUND(ask, 10) AS ask FROM m_fx_quotes
    WHERE bid IS NOT NULL AND ask IS NOT NULL""")
def q_filter_not_null(spark, sf_dir):
    df = R.filter_not_null(m(spark, sf_dir).fx_quotes, ["bid", "ask"], how="any")
    return df.select("code", "date", dbl("bid", 10), dbl("ask", 10))


@register("filter_in_list", """
    SELECT pf_id, type, ts, instrument_id, CAST(units AS DOUBLE) AS units FROM m_activity
    WHERE type IN ('open', 'close', 'split')""")
def q_filter_in_list(spark, sf_dir):
    df = R.filter_in_list(m(spark, sf_dir).activity, "type", ["open", "close", "split"])
    return df.select("pf_id", "type", "ts", "instrument_id", F.col("units").cast("double").alias("units"))


@register("filter_between", """
    SELECT instrument_id, field, date, CAST(value AS DOUBLE) AS value FROM v_ts_usd
    WHERE date BETWEEN DATE '1998-01-01' AND DATE '1999-12-31'""")
def q_filter_between(spark, sf_dir):
    df = R.filter_between(m(spark, sf_dir).ts_usd, "date", dt.date(1998, 1, 1), dt.date(1999, 12, 31))
    return df.select("instrument_id", "field", "date", dbl("value"))


@register("filter_cutoff", "SELECT * FROM m_updates WHERE last_update <= DATE '2001-10-20'")
def q_filter_cutoff(spark, sf_dir):
    return R.filter_cutoff(m(spark, sf_dir).updates, "last_update", CUTOFF)


@register("filter_epsilon", """
    SELECT pf_id, date, instrument_id, ROUND(CAST(units AS DOUBLE), 5) AS units FROM v_combined WHERE units > 0.00001""")
def q_filter_epsilon(spark, sf_dir):
    df = R.filter_epsilon(m(spark, sf_dir).combined, "units", "0.00001")
    return df.select("pf_id", "date", "instrument_id", dbl("units"))


@register("case_expr", """
    SELECT pf_id, type, ts, CASE WHEN type IN ('withdrawal', 'open') THEN -1 WHEN type = 'close' THEN 1 ELSE 0 END
           AS cash_sign FROM m_activity""")
def q_case_expr(spark, sf_dir):
    a = m(spark, sf_dir).activity
    sign = R.case_expr([(F.col("type").isin("withdrawal", "open"), -1), (F.col("type") == "close", 1)], 0)
    return a.select("pf_id", "type", "ts", sign.alias("cash_sign"))


@register("coalesce_default", """
    SELECT pf_id, type, ts, COALESCE(position_id, 'none') AS position_id,
           CAST(COALESCE(units, 0) AS DOUBLE) AS units FROM m_activity""")
def q_coalesce_default(spark, sf_dir):
    a = R.coalesce_default(m(spark, sf_dir).activity, {"position_id": "none", "units": 0})
    return a.select("pf_id", "type", "ts", "position_id", F.col("units").cast("double").alias("units"))


@register("replace_blank_null", "SELECT row_no, NULLIF(trim(substr(details, 10)), '') AS tail FROM m_statement")
def q_replace_blank_null(spark, sf_dir):
    s = m(spark, sf_dir).statement.select("row_no", F.col("details").substr(F.lit(10), F.length("details")).alias("tail"))
    return R.replace_blank_null(s, ["tail"])


@register("in_subquery", """
    SELECT instrument_id, field, date, CAST(value AS DOUBLE) AS value FROM v_ts_usd
    WHERE instrument_id IN (SELECT instrument_id FROM v_combined)""")
def q_in_subquery(spark, sf_dir):
    md = m(spark, sf_dir)
    return R.in_subquery(md.ts_usd, "instrument_id", md.combined, "instrument_id").select(
        "instrument_id", "field", "date", dbl("value"))


@register("scalar_bounds", """
    SELECT instrument_id, field, date, source, (SELECT min(date) FROM m_fx_obs) AS fx_first,
           (SELECT max(date) FROM m_fx_obs) AS fx_last FROM m_eq_obs""")
def q_scalar_bounds(spark, sf_dir):
    md = m(spark, sf_dir)
    e = md.equity_observations.select("instrument_id", "field", "date", "source")
    fxo = md.fx_observations
    return R.scalar_bounds(e, {"fx_first": (fxo, F.min("date")), "fx_last": (fxo, F.max("date"))})


# ============================================================ J: joins
@register("join_inner_equi", """
    SELECT o.instrument_id, i.internal_ticker, i.asset_class, o.field, o.date, CAST(o.value AS DOUBLE) AS value
    FROM v_canonical o JOIN m_instruments i ON o.instrument_id = i.instrument_id""")
def q_join_inner_equi(spark, sf_dir):
    md = m(spark, sf_dir)
    j = R.join_inner_equi(md.canonical, md.instruments.select("instrument_id", "internal_ticker", "asset_class"),
                          "instrument_id")
    return j.select("instrument_id", "internal_ticker", "asset_class", "field", "date", dbl("value"))


@register("join_using", """
    SELECT instrument_id, u.field, u.frequency, u.last_update, d.source AS id_source, d.ext_id, i.name, i.asset_class
    FROM m_updates u JOIN m_identifiers d USING (instrument_id) JOIN m_instruments i USING (instrument_id)""")
def q_join_using(spark, sf_dir):
    md = m(spark, sf_dir)
    return R.join_using(md.updates.select("instrument_id", "field", "frequency", "last_update"),
                        md.identifiers.withColumnRenamed("source", "id_source"),
                        md.instruments.select("instrument_id", "name", "asset_class"))


@register("join_many_to_many_units", """
    SELECT code, date, ROUND(CAST(value AS DOUBLE), 10) AS value FROM v_fx_base""")
def q_join_many_to_many_units(spark, sf_dir):
    md = m(spark, sf_dir)
    j = R.join_many_to_many_units(md.canonical.where(F.col("field") == "close"), md.units)
    return j.select("code", "date", F.round((F.col("value") * F.col("scale")).cast("double"), 10).alias("value"))


@register("join_left_fill", """
    SELECT c.date, CAST(u.value AS DOUBLE) AS usd_value FROM v_calendar c LEFT JOIN m_usd_obs u ON c.date = u.date""")
def q_join_left_fill(spark, sf_dir):
    md = m(spark, sf_dir)
    from marketframe.plans.fx import fx_base
    spine = R.calendar_spine(fx_base(md.canonical, md.units))
    return R.join_left_fill(spine, md.usd_observations.select("date", F.col("value").cast("double").alias("usd_value")),
                            "date")


_PAIR_SPINE = """(SELECT p.pf_id, p.instrument_id, t.date
    FROM (SELECT pf_id, instrument_id, MIN(date) AS first_date FROM v_combined GROUP BY pf_id, instrument_id) p
    JOIN v_trading_days t ON t.date >= p.first_date)"""


@register("join_cross_spine", f"SELECT * FROM {_PAIR_SPINE}")
def q_join_cross_spine(spark, sf_dir):
    from marketframe.plans.holdings import position_spine
    md = m(spark, sf_dir)
    return position_spine(md.combined, md.trading_days).select("pf_id", "instrument_id", "date")


@register("join_full_outer", f"""
    SELECT COALESCE(s.pf_id, c.pf_id) AS pf_id, COALESCE(s.instrument_id, c.instrument_id) AS instrument_id,
           COALESCE(s.date, c.date) AS date, ROUND(CAST(COALESCE(c.units, 0) AS DOUBLE), 5) AS units
    FROM {_PAIR_SPINE} s FULL OUTER JOIN v_combined c
      ON s.pf_id = c.pf_id AND s.date = c.date AND s.instrument_id = c.instrument_id""")
def q_join_full_outer(spark, sf_dir):
    from marketframe.plans.holdings import position_spine
    md = m(spark, sf_dir)
    spine = position_spine(md.combined, md.trading_days)
    j = R.join_full_outer(spine, md.combined, ["pf_id", "instrument_id", "date"], {"units": 0})
    return j.select("pf_id", "instrument_id", "date", dbl("units"))


@register("join_effective_range", """
    SELECT o.instrument_id, o.field, o.date, iu.unit, CAST(o.value AS DOUBLE) AS value
    FROM v_canonical o JOIN m_instrument_units iu ON iu.instrument_id = o.instrument_id
     AND o.date >= iu.start_date AND o.date < iu.end_date""")
def q_join_effective_range(spark, sf_dir):
    from marketframe.plans.usd import join_effective_range
    md = m(spark, sf_dir)
    j = join_effective_range(md.canonical, md.instrument_units)
    return j.select("instrument_id", "field", "date", "unit", dbl("value"))


# a month's first close holds for 35 days: at the start of a month two may hold, which is an error row
_QUOTES = """SELECT instrument_id, MIN(date) AS start_date, CAST(MIN(date) + INTERVAL 35 DAY AS DATE) AS end_date,
    CAST(ARG_MIN(value, date) AS DOUBLE) AS quote FROM v_canonical WHERE field = 'close'
    GROUP BY instrument_id, DATE_TRUNC('month', date)"""


@register("attach_effective_range", """
    SELECT pf_id, position_id, type, ts, instrument_id, units, CASE WHEN n = 1 THEN quote END AS quote,
           CASE WHEN n = 1 THEN quoted END AS quoted, CASE WHEN n > 1 THEN n || ' ranges are valid on this day' END AS range_error
    FROM (SELECT t.pf_id, t.position_id, t.type, t.ts, t.instrument_id, ROUND(CAST(t.units AS DOUBLE), 4) AS units,
                 (SELECT COUNT(*) FROM q WHERE q.instrument_id = t.instrument_id
                  AND CAST(t.ts AS DATE) >= q.start_date AND CAST(t.ts AS DATE) < q.end_date) AS n,
                 (SELECT MIN(quote) FROM q WHERE q.instrument_id = t.instrument_id
                  AND CAST(t.ts AS DATE) >= q.start_date AND CAST(t.ts AS DATE) < q.end_date) AS quote,
                 (SELECT MIN(start_date) FROM q WHERE q.instrument_id = t.instrument_id
                  AND CAST(t.ts AS DATE) >= q.start_date AND CAST(t.ts AS DATE) < q.end_date) AS quoted
          FROM m_activity t) WHERE n > 0""".replace("FROM q WHERE", f"FROM ({_QUOTES}) q WHERE"))
def q_attach_effective_range(spark, sf_dir):
    from marketframe.plans.usd import attach_effective_range
    md = m(spark, sf_dir)
    quotes = (md.canonical.where(F.col("field") == "close").groupBy("instrument_id", F.trunc("date", "month"))
              .agg(F.min("date").alias("quoted"), F.min_by("value", "date").alias("quote"))
              .select("instrument_id", "quoted", F.date_add("quoted", 35).alias("until"), "quote"))
    trades = md.activity.select("pf_id", "position_id", "type", "ts", "instrument_id", dbl("units", 4))
    j = attach_effective_range(trades, quotes, date_col="ts", start_col="quoted", end_col="until")
    return j.select("pf_id", "position_id", "type", "ts", "instrument_id", "units", F.col("quote").cast("double").alias("quote"),
                    "quoted", "range_error")


@register("join_semi", """
    SELECT instrument_id, asset_class FROM m_instruments i
    WHERE EXISTS (SELECT 1 FROM m_observations o WHERE o.instrument_id = i.instrument_id)""")
def q_join_semi(spark, sf_dir):
    md = m(spark, sf_dir)
    return R.join_semi(md.instruments.select("instrument_id", "asset_class"), md.observations, "instrument_id")


@register("join_anti", """
    SELECT instrument_id, asset_class FROM m_instruments i
    WHERE NOT EXISTS (SELECT 1 FROM m_observations o WHERE o.instrument_id = i.instrument_id)""")
def q_join_anti(spark, sf_dir):
    md = m(spark, sf_dir)
    return R.join_anti(md.instruments.select("instrument_id", "asset_class"), md.observations, "instrument_id")


@register("join_correlated_scalar", """
    SELECT instrument_id, internal_ticker,
           CAST((SELECT scale FROM m_units WHERE code = substr(i.internal_ticker, 1, 3)) AS DOUBLE) AS unit_scale
    FROM m_instruments i""")
def q_join_correlated_scalar(spark, sf_dir):
    md = m(spark, sf_dir)
    j = R.join_correlated_scalar(md.instruments.select("instrument_id", "internal_ticker"), md.units)
    return j.select("instrument_id", "internal_ticker", F.col("unit_scale").cast("double").alias("unit_scale"))


@register("join_dict_lookup", """
    SELECT instrument_id, exchange, CASE exchange WHEN 'NYS' THEN 'New York Stock Exchange' WHEN 'NSQ' THEN 'NASDAQ'
        WHEN 'LSE' THEN 'London Stock Exchange' WHEN 'PAR' THEN 'Euronext Paris' WHEN 'GER' THEN 'Deutsche Börse (Frankfurt)' END AS exchange_name
    FROM m_staging_equities""")
def q_join_dict_lookup(spark, sf_dir):
    from marketframe.functions.ids import EXCHANGE_CODE_TO_NAME
    e = m(spark, sf_dir).staging_equities.select("instrument_id", "exchange")
    return R.join_dict_lookup(e, "exchange", EXCHANGE_CODE_TO_NAME, "exchange_name")


# ============================================================ A: simple aggregates
@register("agg_min_max", """
    SELECT instrument_id, MIN(date) AS min_date, MAX(date) AS max_date FROM m_observations GROUP BY instrument_id""")
def q_agg_min_max(spark, sf_dir):
    return R.agg_min_max(m(spark, sf_dir).observations, "instrument_id")


@register("agg_row_counts", """
    SELECT 'instruments' AS table_name, COUNT(*) AS n_rows FROM m_instruments
    UNION ALL SELECT 'identifiers', COUNT(*) FROM m_identifiers
    UNION ALL SELECT 'units', COUNT(*) FROM m_units
    UNION ALL SELECT 'instrument_units', COUNT(*) FROM m_instrument_units
    UNION ALL SELECT 'observations', COUNT(*) FROM m_observations
    UNION ALL SELECT 'updates', COUNT(*) FROM m_updates
    UNION ALL SELECT 'portfolio_activity', COUNT(*) FROM m_activity""")
def q_agg_row_counts(spark, sf_dir):
    md = m(spark, sf_dir)
    return R.agg_row_counts({"instruments": md.instruments, "identifiers": md.identifiers, "units": md.units,
                             "instrument_units": md.instrument_units, "observations": md.observations,
                             "updates": md.updates, "portfolio_activity": md.activity})


@register("agg_duplicates", """
    SELECT instrument_id, field, date, COUNT(*) AS n FROM m_observations GROUP BY 1, 2, 3 HAVING COUNT(*) > 1""")
def q_agg_duplicates(spark, sf_dir):
    return R.agg_duplicates(m(spark, sf_dir).observations, ["instrument_id", "field", "date"])


@register("distinct_rows", "SELECT DISTINCT instrument_id, field FROM m_observations")
def q_distinct_rows(spark, sf_dir):
    return R.distinct_rows(m(spark, sf_dir).observations, ["instrument_id", "field"])


@register("agg_null_counts", """
    SELECT 'value' AS column_name, COUNT(*) FILTER (WHERE value IS NULL) AS n_null FROM v_units_ts
    UNION ALL SELECT 'change', COUNT(*) FILTER (WHERE change IS NULL) FROM v_units_ts""")
def q_agg_null_counts(spark, sf_dir):
    return R.agg_null_counts(m(spark, sf_dir).units_ts, ["value", "change"])


# ============================================================ O: order and limit
@register("order_by_date", """
    SELECT date, internal_ticker, field, CAST(value AS DOUBLE) AS value FROM v_ts_usd ORDER BY date""")
def q_order_by_date(spark, sf_dir):
    ts = m(spark, sf_dir).ts_usd.select("date", "internal_ticker", "field", dbl("value"))
    return R.order_by_date(ts, "internal_ticker", "field")


@register("first_by_order", "SELECT MIN(date) AS first_date FROM m_observations")
def q_first_by_order(spark, sf_dir):
    return R.first_by_order(m(spark, sf_dir).observations, "date")


@register("preview_limit", "SELECT * FROM m_instruments ORDER BY instrument_id LIMIT 10")
def q_preview_limit(spark, sf_dir):
    return R.preview_limit(m(spark, sf_dir).instruments, ["instrument_id"], 10)


# ============================================================ U: set operations
@register("set_difference_missing", """
    SELECT DISTINCT internal_ticker FROM m_instruments
    WHERE internal_ticker NOT IN (SELECT internal_ticker FROM v_ts_usd)""")
def q_set_difference_missing(spark, sf_dir):
    md = m(spark, sf_dir)
    return R.set_difference_missing(md.instruments, md.ts_usd, "internal_ticker")


@register("set_union_ids", """
    SELECT ticker FROM m_vendor_prices UNION SELECT ext_id FROM m_identifiers WHERE source = 'YAHOO'""")
def q_set_union_ids(spark, sf_dir):
    md = m(spark, sf_dir)
    ids = md.identifiers.where(F.col("source") == "YAHOO").select(F.col("ext_id").alias("ticker"))
    return R.set_union_ids(md.vendor_prices, ids, "ticker")


# ============================================================ R: reshape
@register("unpivot_columns", """
    SELECT ticker, date, field, ROUND(value, 5) AS value FROM (
        SELECT ticker, date, 'close' AS field, close AS value FROM m_vendor_prices
        UNION ALL SELECT ticker, date, 'adj_close', adj_close FROM m_vendor_prices)""")
def q_unpivot_columns(spark, sf_dir):
    u = R.unpivot_columns(m(spark, sf_dir).vendor_prices, ["ticker", "date"], ["close", "adj_close"], "field", "value")
    return u.select("ticker", "date", "field", dbl("value"))


@register("unpivot_lateral_values", """
    SELECT instrument_id, 'gics_code' AS field, gics_code AS value FROM m_staging_equities
    UNION ALL SELECT instrument_id, 'country_hq', country_hq FROM m_staging_equities
    UNION ALL SELECT instrument_id, 'exchange', exchange FROM m_staging_equities""")
def q_unpivot_lateral_values(spark, sf_dir):
    from marketframe.plans.seed import unpivot_lateral_values
    return unpivot_lateral_values(m(spark, sf_dir).staging_equities)


@register("unpivot_identifiers", """
    SELECT instrument_id, 'ISIN' AS source, isin AS ext_id FROM m_staging_equities WHERE isin IS NOT NULL
    UNION ALL SELECT instrument_id, 'LSEG', ric FROM m_staging_equities WHERE ric IS NOT NULL
    UNION ALL SELECT instrument_id, 'YAHOO', yfinance_ticker FROM m_staging_equities WHERE yfinance_ticker IS NOT NULL
    UNION ALL SELECT instrument_id, 'ETORO', CAST(etoro_iid AS VARCHAR) FROM m_staging_equities WHERE etoro_iid IS NOT NULL""")
def q_unpivot_identifiers(spark, sf_dir):
    from marketframe.plans.seed import unpivot_identifiers
    return unpivot_identifiers(m(spark, sf_dir).staging_equities)


@register("unnest_array", """
    SELECT ticker, field FROM (SELECT internal_ticker AS ticker, ['close', 'totret'] AS fields FROM m_instruments),
    unnest(fields) t(field)""")
def q_unnest_array(spark, sf_dir):
    i = m(spark, sf_dir).instruments.select(F.col("internal_ticker").alias("ticker"),
                                             F.array(F.lit("close"), F.lit("totret")).alias("field"))
    return R.unnest_array(i, "field")


@register("calendar_spine", "SELECT date FROM v_calendar")
def q_calendar_spine(spark, sf_dir):
    from marketframe.plans.fx import fx_base
    md = m(spark, sf_dir)
    return R.calendar_spine(fx_base(md.canonical, md.units))


PIVOT_FIELDS = ["close", "totret"]
PIVOT_PAGE = 4


#: The wide history of every equity: tickers in pages of four, since a table can't have a column for each.
PIVOT_SQL = (f"SELECT date, r // {PIVOT_PAGE} AS page, " + ", ".join(
    f"max(CASE WHEN r % {PIVOT_PAGE} = {k} THEN internal_ticker END) AS ticker_{k}, "
    + ", ".join(f"round(avg(CASE WHEN r % {PIVOT_PAGE} = {k} AND field = '{f}' THEN CAST(value AS DOUBLE) END), 5) AS {f}_{k}" for f in PIVOT_FIELDS) for k in range(PIVOT_PAGE))
    + """ FROM v_ts_usd JOIN (SELECT internal_ticker, row_number() OVER (ORDER BY internal_ticker) - 1 AS r
                              FROM (SELECT DISTINCT internal_ticker FROM m_instruments WHERE asset_class = 'equity')) USING (internal_ticker)
    WHERE field IN ('close', 'totret') GROUP BY date, page""")


@register("pivot_history", PIVOT_SQL)
@register("pivot_history_pages", PIVOT_SQL)
def q_pivot_history_pages(spark, sf_dir):
    """The wide history of every equity, a page of tickers a row."""
    from marketframe.plans.hist import get_hist, pivot_history_pages
    md = m(spark, sf_dir)
    h = get_hist(md.ts_usd, md.equity_tickers(), PIVOT_FIELDS, None, None).withColumn("value", F.col("value").cast("double"))
    wide = pivot_history_pages(h, md.equity_tickers(), PIVOT_FIELDS, PIVOT_PAGE)
    return wide.select(*[F.round(c, 5).alias(c) if c.split("_")[0] in PIVOT_FIELDS else F.col(c) for c in wide.columns])


# ============================================================ N: windows
@register("lag_ratio", """
    SELECT b.code, b.date, round(CAST(b.value AS DOUBLE), 10) AS value, round(CAST(b.value AS DOUBLE) / CAST(p.value AS DOUBLE), 10) AS change
    FROM v_fx_base b ASOF LEFT JOIN v_fx_base p ON p.code = b.code AND b.date > p.date""")
def q_lag_ratio(spark, sf_dir):
    from marketframe.plans.fx import fx_base
    md = m(spark, sf_dir)
    r = N.lag_ratio(fx_base(md.canonical, md.units), "code", "date", "value")
    return r.select("code", "date", dbl("value", 10), dbl("change", 10))


@register("running_sum", """
    SELECT pf_id, instrument_id, date,
           ROUND(CAST(SUM(units) OVER (PARTITION BY pf_id, instrument_id ORDER BY date) AS DOUBLE), 5) AS units
    FROM v_combined""")
def q_running_sum(spark, sf_dir):
    r = N.running_sum(m(spark, sf_dir).combined, ["pf_id", "instrument_id"], "date", "units")
    return r.select("pf_id", "instrument_id", "date", dbl("units"))


@register("running_count_groups", """
    SELECT instrument_id, date, COUNT(value) OVER (PARTITION BY instrument_id ORDER BY date) AS grp
    FROM v_ts_usd WHERE field = 'close'""")
def q_running_count_groups(spark, sf_dir):
    ts = m(spark, sf_dir).ts_usd.where(F.col("field") == "close").select("instrument_id", "date", "value")
    return N.running_count_groups(ts, "instrument_id", "date", "value").select("instrument_id", "date", "grp")


@register("ffill", """
    SELECT instrument_id, field, date,
           CAST(FIRST_VALUE(value) OVER (PARTITION BY instrument_id, field, grp ORDER BY date) AS DOUBLE) AS value
    FROM (SELECT *, COUNT(value) OVER (PARTITION BY instrument_id, field ORDER BY date) AS grp FROM v_ts_usd)""")
def q_ffill(spark, sf_dir):
    ts = m(spark, sf_dir).ts_usd.select("instrument_id", "field", "date", "value")
    return N.ffill(ts, ["instrument_id", "field"], "date", "value").select("instrument_id", "field", "date",
                                                                          dbl("value"))


@register("reverse_cumprod_splits", """
    SELECT ticker, date, COALESCE(product(CASE WHEN stock_splits IS NULL OR stock_splits = 0 THEN 1.0 ELSE stock_splits END)
           OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 1.0) AS split_mult
    FROM m_vendor_prices""")
def q_reverse_cumprod_splits(spark, sf_dir):
    from marketframe.plans.vendor import reverse_cumprod_splits
    return reverse_cumprod_splits(m(spark, sf_dir).vendor_prices).select("ticker", "date", "split_mult")


@register("pct_change", """
    SELECT ticker, date, ROUND(adj_close / LAG(adj_close) OVER (PARTITION BY ticker ORDER BY date) - 1, 10) AS pct_change
    FROM m_vendor_prices""")
def q_pct_change(spark, sf_dir):
    r = N.pct_change(m(spark, sf_dir).vendor_prices, "ticker", "date", "adj_close")
    return r.select("ticker", "date", dbl("pct_change", 10))


@register("drop_first_row", """
    SELECT ticker, date FROM (SELECT ticker, date, ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY date) AS rn
                              FROM m_vendor_prices) WHERE rn > 1""")
def q_drop_first_row(spark, sf_dir):
    return N.drop_first_row(m(spark, sf_dir).vendor_prices, "ticker", "date").select("ticker", "date")


# ============================================================ X: scalar expressions
@register("expr_round_money", """
    SELECT instrument_id, field, date, CAST(ROUND(value * CAST(0.333333 AS DECIMAL(6,6)), 5) AS DOUBLE) AS value
    FROM v_canonical""")
def q_expr_round_money(spark, sf_dir):
    from marketframe.functions.expressions import expr_round_money
    c = m(spark, sf_dir).canonical
    return c.select("instrument_id", "field", "date",
                    expr_round_money(F.col("value") * F.lit(Decimal("0.333333"))).cast("double").alias("value"))


@register("expr_cast_date", "SELECT pf_id, type, CAST(ts AS DATE) AS date FROM m_activity")
def q_expr_cast_date(spark, sf_dir):
    from marketframe.functions.expressions import expr_cast_date
    return m(spark, sf_dir).activity.select("pf_id", "type", expr_cast_date(F.col("ts")).alias("date"))


@register("expr_prefix", "SELECT instrument_id, substr(internal_ticker, 1, 3) AS prefix FROM m_instruments")
def q_expr_prefix(spark, sf_dir):
    from marketframe.functions.expressions import expr_prefix
    return m(spark, sf_dir).instruments.select("instrument_id", expr_prefix(F.col("internal_ticker"), 3).alias("prefix"))


@register("expr_pipette", """
    SELECT code, date, ROUND(CASE WHEN bid IS NOT NULL AND NOT isnan(bid) AND bid != 0 THEN bid * 100000.0 END, 5) AS bid_pip,
           ROUND(CASE WHEN ask IS NOT NULL AND NOT isnan(ask) AND ask != 0 THEN 1.0 / ask * 100000.0 END, 5) AS ask_pip
    FROM m_fx_quotes""")
def q_expr_pipette(spark, sf_dir):
    from marketframe.functions.expressions import expr_pipette
    q = m(spark, sf_dir).fx_quotes
    return q.select("code", "date", F.round(expr_pipette(F.col("bid")), 5).alias("bid_pip"),
                    F.round(expr_pipette(F.col("ask"), invert=True), 5).alias("ask_pip"))


_LSEG_YAHOO = """(SELECT instrument_id, date, source, value FROM m_observations
                  WHERE field = 'close' AND source IN ('LSEG', 'YAHOO'))"""


@register("expr_relative_gap", f"""
    SELECT a.instrument_id, a.date, ROUND(abs(CAST(a.value AS DOUBLE) - CAST(b.value AS DOUBLE)) / CAST(a.value AS DOUBLE), 10) AS gap
    FROM {_LSEG_YAHOO} a JOIN {_LSEG_YAHOO} b ON a.instrument_id = b.instrument_id AND a.date = b.date
    WHERE a.source = 'LSEG' AND b.source = 'YAHOO'""")
def q_expr_relative_gap(spark, sf_dir):
    from marketframe.functions.expressions import expr_relative_gap
    o = m(spark, sf_dir).observations.where(F.col("field") == "close")
    a = o.where(F.col("source") == "LSEG").select("instrument_id", "date", F.col("value").alias("a"))
    b = o.where(F.col("source") == "YAHOO").select("instrument_id", "date", F.col("value").alias("b"))
    j = a.join(b, ["instrument_id", "date"])
    return j.select("instrument_id", "date", F.round(expr_relative_gap(F.col("a"), F.col("b")), 10).alias("gap"))


@register("expr_ticker_code", """
    SELECT ric, substr(replace(split_part(ric, '.', 1), '-', ''), 1, 4) AS code FROM m_rics""")
def q_expr_ticker_code(spark, sf_dir):
    from marketframe.functions.ids import expr_ticker_code
    return m(spark, sf_dir).rics.select("ric", expr_ticker_code(F.col("ric")).alias("code"))


@register("expr_ric_to_yahoo", """
    SELECT r.ric, COALESCE(o.yahoo, split_part(r.ric, '.', 1) || COALESCE(CASE '.' || split_part(r.ric, '.', -1)
        WHEN '.N' THEN '' WHEN '.O' THEN '' WHEN '.OQ' THEN '' WHEN '.K' THEN '' WHEN '.A' THEN ''
        WHEN '.L' THEN '.L' WHEN '.DE' THEN '.DE' WHEN '.AS' THEN '.AS' WHEN '.PA' THEN '.PA' WHEN '.BR' THEN '.BR'
        WHEN '.MC' THEN '.MC' WHEN '.MI' THEN '.MI' WHEN '.CO' THEN '.CO' WHEN '.HE' THEN '.HE' WHEN '.S' THEN '.ST'
        WHEN '.SW' THEN '.SW' WHEN '.TO' THEN '.TO' END, '')) AS yahoo_ticker
    FROM m_rics r LEFT JOIN m_ric_overrides o ON r.ric = o.ric""")
def q_expr_ric_to_yahoo(spark, sf_dir):
    from marketframe.functions.ids import ric_to_yahoo
    md = m(spark, sf_dir)
    return ric_to_yahoo(md.rics.select("ric"), "ric", md.ric_overrides)


@register("expr_statement_symbol", """
    SELECT row_no, replace(split_part(details, '/', 1), '.RTH', '') AS symbol,
           (string_split(trim(details), ' '))[-1] AS note FROM m_statement""")
def q_expr_statement_symbol(spark, sf_dir):
    from marketframe.functions.expressions import expr_split_note, expr_statement_symbol
    s = m(spark, sf_dir).statement
    return s.select("row_no", expr_statement_symbol(F.col("details")).alias("symbol"),
                    expr_split_note(F.col("details")).alias("note"))


@register("expr_split_ratio", """
    SELECT row_no, CASE WHEN len(string_split(note, ':')) = 2
           THEN TRY_CAST(string_split(note, ':')[1] AS DOUBLE) / TRY_CAST(string_split(note, ':')[2] AS DOUBLE) END AS ratio
    FROM (SELECT row_no, (string_split(trim(details), ' '))[-1] AS note FROM m_statement WHERE type = 'corp action: Split')""")
def q_expr_split_ratio(spark, sf_dir):
    from marketframe.functions.expressions import expr_split_note, expr_split_ratio
    s = m(spark, sf_dir).statement.where(F.col("type") == "corp action: Split")
    return s.select("row_no", expr_split_ratio(expr_split_note(F.col("details"))).alias("ratio"))


@register("expr_sign_rules", """
    SELECT row_no, t AS type, round(units * CASE t WHEN 'close' THEN -1 ELSE 1 END, 5) AS units,
           round(amount * CASE t WHEN 'open' THEN -1 ELSE 1 END - coalesce(fee, 0), 5) AS cashflow_usd
    FROM (SELECT *, CASE type WHEN 'Open Position' THEN 'open' WHEN 'Position closed' THEN 'close'
                      WHEN 'Deposit' THEN 'deposit' ELSE 'other' END AS t, CASE WHEN row_no % 3 = 0 THEN abs(units) / 10 END AS fee FROM m_statement)""")
def q_expr_sign_rules(spark, sf_dir):
    from marketframe.functions.expressions import expr_sign_rules
    t = (F.when(F.col("type") == "Open Position", "open").when(F.col("type") == "Position closed", "close")
         .when(F.col("type") == "Deposit", "deposit").otherwise("other"))
    s = m(spark, sf_dir).statement.withColumn("t", t).withColumn("fee", F.when(F.col("row_no") % 3 == 0, F.abs(F.col("units")) / 10))
    units, cash = expr_sign_rules(F.col("t"), F.col("units"), F.col("amount"), F.col("fee"))
    return s.select("row_no", F.col("t").alias("type"), F.round(units, 5).alias("units"), F.round(cash, 5).alias("cashflow_usd"))


_LUHN = """(list_sum(list_transform(range(length(d)), lambda k:
              CASE WHEN k % 2 = 1 THEN (CAST(substr(d, length(d) - k, 1) AS INTEGER) * 2)
                                        - CASE WHEN CAST(substr(d, length(d) - k, 1) AS INTEGER) * 2 > 9 THEN 9 ELSE 0 END
                   ELSE CAST(substr(d, length(d) - k, 1) AS INTEGER) END)) % 10 = 0)"""
_EXPAND = """array_to_string(list_transform(string_split(x, ''),
              lambda c: CASE WHEN regexp_matches(c, '^[A-Z]$') THEN CAST(ascii(c) - 55 AS VARCHAR) ELSE c END), '')"""


@register("valid_isin", f"""
    SELECT x AS ext_id, COALESCE(regexp_matches(x, '^[A-Z]{{2}}[A-Z0-9]{{9}}[0-9]$') AND {_LUHN}, false) AS valid
    FROM (SELECT ext_id AS x, {_EXPAND} AS d FROM m_identifiers WHERE source = 'ISIN')""")
def q_valid_isin(spark, sf_dir):
    from marketframe.functions.ids import valid_isin
    ids = m(spark, sf_dir).identifiers.where(F.col("source") == "ISIN")
    return ids.select("ext_id", valid_isin(F.col("ext_id")).alias("valid"))


@register("create_instrument_id", f"""
    SELECT yfinance_ticker, isin,
           CASE WHEN ok THEN 'EQU' || rpad(upper(code), 4, 'X') || rpad(upper(isin), 13, 'X') END AS new_id,
           CASE WHEN NOT (length(code) BETWEEN 1 AND 4 AND regexp_matches(code, '^[A-Za-z0-9]+$'))
                THEN 'code must be 1-4 alphanumerical characters'
                WHEN NOT ok THEN 'invalid hash input' END AS error
    FROM (SELECT *, COALESCE(regexp_matches(x, '^[A-Z]{{2}}[A-Z0-9]{{9}}[0-9]$') AND {_LUHN}, false)
                    AND length(code) BETWEEN 1 AND 4 AND regexp_matches(code, '^[A-Za-z0-9]+$') AS ok
          FROM (SELECT *, isin AS x, {_EXPAND.replace('(x,', '(isin,')} AS d,
                       substr(replace(split_part(yfinance_ticker, '.', 1), '-', ''), 1, 4) AS code
                FROM m_staging_equities))""")
def q_create_instrument_id(spark, sf_dir):
    from marketframe.functions.ids import create_instrument_id, expr_ticker_code, instrument_id_error
    e = m(spark, sf_dir).staging_equities
    code = expr_ticker_code(F.col("yfinance_ticker"))
    return e.select("yfinance_ticker", "isin",
                    create_instrument_id(F.lit("equity"), code, F.col("isin")).alias("new_id"),
                    instrument_id_error(F.lit("equity"), code, F.col("isin")).alias("error"))


@register("hex_hash", "SELECT instrument_id, upper(substr(md5(upper(name)), 1, 13)) AS hash FROM m_instruments")
def q_hex_hash(spark, sf_dir):
    from marketframe.functions.ids import hex_hash
    i = m(spark, sf_dir).instruments
    return i.select("instrument_id", hex_hash(F.upper(F.col("name")), 13).alias("hash"))


_DATE_TEXT = """(SELECT event_id, ts, CASE event_id % 6
        WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
        WHEN 1 THEN strftime(ts, '%d/%m/%Y %H:%M:%S')
        WHEN 2 THEN strftime(ts, '%B ') || CAST(day(ts) AS VARCHAR)
                    || CASE WHEN day(ts) IN (1, 21, 31) THEN 'st' WHEN day(ts) IN (2, 22) THEN 'nd'
                            WHEN day(ts) IN (3, 23) THEN 'rd' ELSE 'th' END || strftime(ts, ' %Y')
        WHEN 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
        WHEN 4 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.250+01:00'
        ELSE 'on ' || strftime(ts, '%A') END AS txt FROM events)"""


@register("normalise_dates", f"""
    SELECT 't' || event_id AS id, txt AS given,
           CASE event_id % 6 WHEN 2 THEN date_trunc('day', ts) WHEN 4 THEN date_trunc('second', ts) + INTERVAL 250 MILLISECOND - INTERVAL 1 HOUR
                WHEN 5 THEN NULL ELSE date_trunc('second', ts) END AS parsed,
           CASE WHEN event_id % 6 = 5 THEN 'unreadable date: ' || txt END AS parsed_error
    FROM {_DATE_TEXT}
    UNION ALL
    SELECT 'n' || event_id, CAST((event_id - 500) * 86400 AS VARCHAR), TIMESTAMP '1970-01-01' + INTERVAL (event_id - 500) DAY, NULL FROM events
    UNION ALL
    SELECT 'd' || event_id, CAST(event_id AS VARCHAR) || '.5', TIMESTAMP '1970-01-01' + INTERVAL (event_id * 1000 + 500) MILLISECOND, NULL FROM events""")
def q_normalise_dates(spark, sf_dir):
    """Text in six forms, and whole and broken seconds, each column by its type."""
    from marketframe.functions.ids import with_timestamps
    ev = m(spark, sf_dir).raw("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    d, kind = F.dayofmonth("ts"), F.col("event_id") % 6
    suffix = (F.when(d.isin(1, 21, 31), "st").when(d.isin(2, 22), "nd").when(d.isin(3, 23), "rd").otherwise("th"))
    txt = (F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).when(kind == 1, F.date_format("ts", "dd/MM/yyyy HH:mm:ss"))
           .when(kind == 2, F.concat(F.date_format("ts", "MMMM "), d.cast("string"), suffix, F.date_format("ts", " yyyy")))
           .when(kind == 3, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
           .when(kind == 4, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".250+01:00")))
           .otherwise(F.concat(F.lit("on "), F.date_format("ts", "EEEE"))))
    def part(mark, value, shown=None):
        rows = with_timestamps(ev.select("event_id", value.alias("x")), "x", dayfirst=True)
        return rows.select(F.concat(F.lit(mark), F.col("event_id").cast("string")).alias("id"), (shown if shown is not None else F.col("x").cast("string")).alias("given"),
                           "parsed", "parsed_error")
    return (part("t", txt).unionByName(part("n", (F.col("event_id") - 500) * 86400))
            .unionByName(part("d", F.col("event_id") + 0.5, F.concat(F.col("event_id").cast("string"), F.lit(".5")))))


@register("expr_to_numeric", """
    SELECT event_id, TRY_CAST(trim(CASE event_id % 3 WHEN 0 THEN CAST(CAST(value AS DECIMAL(19,5)) AS VARCHAR)
        WHEN 1 THEN props ELSE '  ' || CAST(user_id AS VARCHAR) END) AS DECIMAL(19,5)) AS num FROM events""")
def q_expr_to_numeric(spark, sf_dir):
    from marketframe.functions.expressions import expr_to_numeric
    ev = m(spark, sf_dir).raw("events")
    txt = (F.when(F.col("event_id") % 3 == 0, F.col("value").cast("decimal(19,5)").cast("string"))
           .when(F.col("event_id") % 3 == 1, F.col("props"))
           .otherwise(F.concat(F.lit("  "), F.col("user_id").cast("string"))))
    return ev.select("event_id", expr_to_numeric(txt).alias("num"))


@register("expr_days_stale", """
    SELECT instrument_id, field, date_diff('day', last_update, DATE '2001-12-01') AS days_stale FROM m_updates""")
def q_expr_days_stale(spark, sf_dir):
    from marketframe.functions.expressions import expr_days_stale
    u = m(spark, sf_dir).updates
    return u.select("instrument_id", "field", expr_days_stale(F.col("last_update"), AS_OF).alias("days_stale"))


@register("agg_row_mean", """
    SELECT code, date, ROUND(CASE WHEN (bid IS NOT NULL)::INT + (ask IS NOT NULL)::INT > 0
        THEN (COALESCE(bid, 0.0) + COALESCE(1.0 / ask, 0.0)) / ((bid IS NOT NULL)::INT + (ask IS NOT NULL)::INT) END, 10) AS mean
    FROM m_fx_quotes""")
def q_agg_row_mean(spark, sf_dir):
    q = m(spark, sf_dir).fx_quotes.withColumn("ask_direct", F.lit(1.0) / F.col("ask"))
    return R.agg_row_mean(q, ["bid", "ask_direct"]).select("code", "date", dbl("mean", 10))
