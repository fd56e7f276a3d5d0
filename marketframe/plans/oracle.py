"""DuckDB oracle SQL for the registered queries.

The driver registers its Parquet tables as views; these CTEs rebuild the
model tables from them with the same rules as ``sources.driver_tables`` and
then derive every view from its definition in another way than the Spark code:
``arg_min`` for priorities, as-of joins for fills, previous values and flows,
balances joined to trading days for holdings.  So they check it independently.
``sql(body)`` prepends the CTEs the body needs, in dependency order.
"""

from __future__ import annotations

import re


def _id(prefix: str, expr: str, width: int = 17) -> str:
    return f"('{prefix}' || lpad(CAST({expr} AS VARCHAR), {width}, '0'))"


def _code(expr: str) -> str:
    return f"('C' || lpad(CAST({expr} AS VARCHAR), 2, '0'))"


def _week(expr: str) -> str:
    return f"CAST(date_trunc('week', {expr}) AS DATE)"


CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body


# ------------------------------------------------------------------ adapter tables
cte("m_sources", "SELECT * FROM (VALUES ('system', 0), ('LSEG', 1), ('YAHOO', 2), ('ETORO', 3), "
                 "('ISIN', 100)) t(name, priority)")
cte("m_fields", "SELECT * FROM (VALUES ('close', CAST(1 AS DECIMAL(12,4)), 'value'), "
                "('totret', CAST(0.01 AS DECIMAL(12,4)), 'change')) t(name, scale, fx_conversion)")
cte("m_portfolios", f"""
    SELECT {_id('PFX', 'k')} AS instrument_id, 'Portfolio ' || CAST(k AS VARCHAR) AS name,
           'portfolio' AS asset_class, 'PF' || CAST(k AS VARCHAR) AS internal_ticker
    FROM (SELECT DISTINCT o_custkey % 4 AS k FROM orders)""")
cte("m_instruments", f"""
    SELECT {_id('EQU', 's_suppkey')} AS instrument_id, s_name AS name, 'equity' AS asset_class,
           s_name AS internal_ticker FROM supplier
    UNION ALL
    SELECT {_id('CUR', 'n_nationkey')}, n_name, 'currency', {_code('n_nationkey')} || 'USD' FROM nation
    UNION ALL
    SELECT 'CURUSDXUSDXXXXXXXXXX', 'United States Dollar', 'currency', 'USDUSD'
    UNION ALL
    SELECT * FROM m_portfolios""")
cte("m_units", f"""
    SELECT {_code('n_nationkey')} AS code, CAST(0.00001 AS DECIMAL(10,7)) AS scale,
           {_id('CUR', 'n_nationkey')} AS instrument_id FROM nation
    UNION ALL SELECT 'USD', CAST(0.00001 AS DECIMAL(10,7)), 'CURUSDXUSDXXXXXXXXXX'
    UNION ALL SELECT 'c01', CAST(0.0000001 AS DECIMAL(10,7)), {_id('CUR', 'n_nationkey')}
              FROM nation WHERE n_nationkey = 1""")
cte("m_instrument_units", f"""
    SELECT {_id('EQU', 's_suppkey')} AS instrument_id,
           CASE WHEN s_suppkey % 7 = 0 THEN 'c01' ELSE {_code('s_nationkey')} END AS unit,
           DATE '1900-01-01' AS start_date,
           CASE WHEN s_suppkey % 10 = 3 THEN DATE '1998-06-01' ELSE DATE '9999-12-31' END AS end_date
    FROM supplier
    UNION ALL
    SELECT {_id('EQU', 's_suppkey')}, 'USD', DATE '1998-06-01', DATE '9999-12-31'
    FROM supplier WHERE s_suppkey % 10 = 3
    UNION ALL
    SELECT instrument_id, 'USD', DATE '1900-01-01', DATE '9999-12-31'
    FROM m_instruments WHERE asset_class IN ('currency', 'portfolio')""")
cte("m_identifiers", f"""
    SELECT {_id('EQU', 's_suppkey')} AS instrument_id, 'LSEG' AS source, 'R' || CAST(s_suppkey AS VARCHAR) AS ext_id FROM supplier
    UNION ALL SELECT {_id('EQU', 's_suppkey')}, 'YAHOO', 'Y' || CAST(s_suppkey AS VARCHAR) FROM supplier
    UNION ALL SELECT {_id('EQU', 's_suppkey')}, 'ETORO', CAST(s_suppkey AS VARCHAR) FROM supplier
    UNION ALL SELECT {_id('EQU', 's_suppkey')}, 'ISIN',
                     'US' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') || CAST(s_suppkey % 10 AS VARCHAR) FROM supplier
    UNION ALL SELECT {_id('CUR', 'n_nationkey')}, 'YAHOO', 'X' || CAST(n_nationkey AS VARCHAR) FROM nation""")
cte("m_eq_obs", f"""
    SELECT {_id('EQU', 'l_suppkey')} AS instrument_id,
           CASE WHEN l_linestatus = 'O' THEN 'close' ELSE 'totret' END AS field,
           {_week('l_shipdate')} AS date,
           CASE l_returnflag WHEN 'A' THEN 'LSEG' WHEN 'N' THEN 'YAHOO' ELSE 'ETORO' END AS source,
           CAST(max(CASE WHEN l_linestatus = 'O' THEN l_extendedprice
                         ELSE 100 * (l_discount - l_tax) END) AS DECIMAL(19,5)) AS value
    FROM lineitem GROUP BY 1, 2, 3, 4""")
cte("m_fx_obs", f"""
    SELECT {_id('CUR', 'c_nationkey')} AS instrument_id, 'close' AS field, {_week('o_orderdate')} AS date,
           'LSEG' AS source, CAST(max(o_totalprice) AS DECIMAL(19,5)) AS value
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4""")
cte("m_usd_obs", f"""
    SELECT 'CURUSDXUSDXXXXXXXXXX' AS instrument_id, 'close' AS field, date, 'system' AS source,
           CAST(100000 AS DECIMAL(19,5)) AS value
    FROM (SELECT DISTINCT date FROM m_fx_obs WHERE instrument_id = {_id('CUR', '0')})""")
cte("m_observations", "SELECT * FROM m_eq_obs UNION ALL SELECT * FROM m_fx_obs UNION ALL SELECT * FROM m_usd_obs")
cte("m_activity", f"""
    SELECT {_id('PFX', 'o_custkey % 4')} AS pf_id, typ AS type, 'etoro' AS broker,
           CAST(l_shipdate AS TIMESTAMP) AS ts,
           CASE WHEN typ IN ('open', 'close') THEN CAST(l_orderkey AS VARCHAR) END AS position_id,
           CASE WHEN typ IN ('open', 'close') THEN {_id('EQU', 'l_suppkey')} END AS instrument_id,
           CASE WHEN typ = 'open' THEN CAST(l_quantity AS DECIMAL(28,8))
                WHEN typ = 'close' THEN -CAST(l_quantity AS DECIMAL(28,8)) END AS units,
           CAST(l_tax AS DECIMAL(28,8)) AS fee,
           CASE WHEN typ IN ('withdrawal', 'open') THEN -CAST(l_extendedprice AS DECIMAL(28,8))
                ELSE CAST(l_extendedprice AS DECIMAL(28,8)) END AS cashflow_usd,
           CAST(NULL AS VARCHAR) AS notes
    FROM (SELECT *, (['deposit', 'withdrawal', 'dividend', 'interest', 'open', 'open', 'close'])[l_linenumber] AS typ
          FROM lineitem) li JOIN orders ON l_orderkey = o_orderkey""")
cte("m_updates", f"""
    SELECT {_id('EQU', 's_suppkey')} AS instrument_id, f.field, 'YAHOO' AS source,
           CASE WHEN s_suppkey % 11 = 0 THEN 'weekly' ELSE 'daily' END AS frequency,
           CAST(DATE '2001-10-01' + CAST(s_suppkey % 60 AS INTEGER) AS DATE) AS last_update
    FROM supplier JOIN (VALUES ('close'), ('totret')) f(field)
      ON f.field = 'close' OR s_suppkey % 3 = 0
    UNION ALL
    SELECT {_id('CUR', 'n_nationkey')}, 'close', 'YAHOO', 'daily', DATE '2001-11-20' FROM nation""")
cte("m_upsert_batch", f"""
    SELECT instrument_id, field, date, source, CAST(value + 1 AS DECIMAL(19,5)) AS value, 1 AS seq
    FROM m_observations WHERE date >= DATE '2001-07-01'
    UNION ALL
    SELECT instrument_id, field, CAST(date + 1 AS DATE), source, value, 1
    FROM m_observations WHERE date >= DATE '2001-07-01'
    UNION ALL
    SELECT instrument_id, field, date, source, CAST(value + 2 AS DECIMAL(19,5)), 2
    FROM m_observations WHERE date >= DATE '2001-07-01' AND instrument_id = {_id('EQU', '0')}""")
cte("m_vendor_prices", """
    SELECT CASE WHEN user_id % 10 = 3 THEN 'X' || CAST(user_id % 25 AS VARCHAR) ELSE 'Y' || CAST(user_id * 2 AS VARCHAR) END AS ticker,
           CAST(ts AS DATE) AS date,
           max(value) AS close, min(value) AS adj_close,
           CASE WHEN bool_or(event_type = 'signup') THEN 2.0 ELSE 0.0 END AS stock_splits
    FROM events GROUP BY 1, 2""")
cte("m_fx_quotes", f"""
    SELECT {_code('c_nationkey')} AS code, {_week('o_orderdate')} AS date,
           min(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) / 1e5 AS bid,
           1e5 / max(o_totalprice) AS ask
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""")
cte("m_statement", """
    SELECT CAST(ts AS TIMESTAMP) AS date,
           CASE event_type WHEN 'signup' THEN 'Deposit' WHEN 'purchase' THEN 'Open Position'
                WHEN 'click' THEN 'Position closed' WHEN 'view' THEN 'Commission'
                ELSE 'corp action: Split' END AS type,
           'SYM' || CAST(user_id % 20 AS VARCHAR) || '/USD' || CASE WHEN event_type <> 'error' THEN ''
                WHEN event_id % 6 = 0 THEN ' 0:1' WHEN event_id % 6 = 1 THEN ' x' ELSE ' 2:1' END AS details,
           value AS units, value * 10 AS amount, CASE WHEN user_id % 10 <> 7 THEN CAST(user_id AS VARCHAR) END AS position_id, event_id AS row_no
    FROM events""")

cte("m_attributes", f"""
    SELECT {_id('EQU', 's_suppkey')} AS instrument_id, 'country_hq' AS field, n_name AS value
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    UNION ALL
    SELECT {_id('EQU', 's_suppkey')}, 'region', r_name
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
cte("m_rics", f"""
    SELECT {_id('EQU', 's_suppkey')} AS instrument_id,
           'R' || CAST(s_suppkey AS VARCHAR) || (['.N', '.O', '.L', '.DE', '.PA', '.S', '.XX', ''])[s_suppkey % 8 + 1] AS ric
    FROM supplier""")
cte("m_ric_overrides", """
    SELECT ric, 'OVR' || split_part(ric, '.', 1) AS yahoo FROM m_rics
    WHERE CAST(substr(instrument_id, 4, 17) AS BIGINT) % 25 = 0""")
cte("m_symbol_candidates", """
    SELECT 'SYM' || CAST(s_suppkey % 20 AS VARCHAR) AS lookup, CAST(0 AS BIGINT) AS pos,
           'SYM' || CAST(s_suppkey % 20 AS VARCHAR) || '.INT' AS symbol_full, true AS is_internal,
           -1 - s_suppkey AS instrument_key
    FROM supplier WHERE s_suppkey < 20
    UNION ALL
    SELECT 'SYM' || CAST(s_suppkey % 20 AS VARCHAR), CAST(floor(s_suppkey / 20) + 1 AS BIGINT),
           'SYM' || CAST(s_suppkey % 20 AS VARCHAR), false, s_suppkey
    FROM supplier""")

cte("m_staging_equities", f"""
    SELECT r.instrument_id, s_name AS name,
           'US' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') || CAST(s_suppkey % 10 AS VARCHAR) AS isin,
           'Y' || CAST(s_suppkey AS VARCHAR) AS yfinance_ticker, CAST(s_suppkey AS INTEGER) AS etoro_iid, r.ric,
           (['NYS', 'NSQ', 'LSE', 'PAR', 'GER', 'XXX'])[s_suppkey % 6 + 1] AS exchange,
           n_name AS country_hq, {_code('s_nationkey')} AS currency,
           CASE WHEN s_suppkey % 9 != 0 THEN CAST(CAST(floor(abs(s_acctbal)) % 100 AS INTEGER) AS VARCHAR) END AS gics_code
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    JOIN m_rics r ON r.instrument_id = {_id('EQU', 's_suppkey')}""")
cte("m_staging_observations", """
    SELECT e.date,
           CASE WHEN e.source = 'LSEG' THEN r.ric
                WHEN e.source = 'YAHOO' THEN 'Y' || CAST(CAST(substr(e.instrument_id, 4, 17) AS BIGINT) AS VARCHAR)
                ELSE CAST(CAST(substr(e.instrument_id, 4, 17) AS BIGINT) AS VARCHAR) END AS identifier,
           e.source, e.field,
           CAST(CASE WHEN e.field = 'close' THEN 1 ELSE 0.01 END AS DECIMAL(12,4)) AS scale,
           CASE WHEN e.value != 0 THEN e.value END AS value
    FROM m_eq_obs e JOIN m_rics r ON e.instrument_id = r.instrument_id""")

# ------------------------------------------------------------------ derived views, from their definitions
def chain(s: str, obs: str) -> None:
    """All views that follow from an observations relation, their names ending in ``s``."""
    # The value of the source that comes first by priority, then by name
    cte(f"v_canonical{s}", f"""
        SELECT instrument_id, field, date,
               arg_min(value, lpad(CAST(coalesce(priority, 2147483647) AS VARCHAR), 10, '0') || source) AS value
        FROM {obs} JOIN m_sources ON source = name GROUP BY ALL""")
    cte(f"v_fx_base{s}", f"""
        SELECT code, date, CAST(value * scale AS DECIMAL(22,12)) AS value
        FROM m_units JOIN v_canonical{s} USING (instrument_id) WHERE field = 'close'""")
    cte(f"v_calendar{s}", f"""
        SELECT CAST(unnest(range(CAST(min(date) AS TIMESTAMP), CAST(max(date) AS TIMESTAMP) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS date
        FROM v_fx_base{s}""")
    # On each day the latest observation, and on its own day its ratio to the one before
    cte(f"v_fx_step{s}", f"""
        SELECT b.code, b.date, b.value, coalesce(CAST(b.value AS DOUBLE) / CAST(p.value AS DOUBLE), 1.0) AS step
        FROM v_fx_base{s} b ASOF LEFT JOIN v_fx_base{s} p ON p.code = b.code AND b.date > p.date""")
    cte(f"v_units_ts{s}", f"""
        SELECT d.code, d.date, b.value, CASE WHEN b.date = d.date THEN b.step ELSE 1.0 END AS change
        FROM (SELECT code, date FROM v_calendar{s}, (SELECT code FROM v_fx_base{s} GROUP BY code)) d
        ASOF LEFT JOIN v_fx_step{s} b ON b.code = d.code AND d.date >= b.date""")
    # C4: one rate per rule; a currency's scale belongs to the first three letters of its ticker
    cte(f"v_dated{s}", f"""
        SELECT o.*, i.internal_ticker, i.asset_class, f.fx_conversion, u.value AS rate, u.change
        FROM v_canonical{s} o, m_instruments i, m_fields f, m_instrument_units r, v_units_ts{s} u
        WHERE i.instrument_id = o.instrument_id AND f.name = o.field AND r.instrument_id = o.instrument_id
          AND r.start_date <= o.date AND o.date < r.end_date AND u.code = r.unit AND u.date = o.date""")
    cte(f"v_ts_usd{s}", f"""
        SELECT instrument_id, internal_ticker, field, date, CAST(round(value * scale, 5) AS DECIMAL(19,5)) AS value
        FROM v_dated{s} LEFT JOIN (SELECT code, scale FROM m_units) ON code = left(internal_ticker, 3) WHERE asset_class = 'currency'
        UNION ALL
        SELECT instrument_id, internal_ticker, field, date, CAST(round(CAST(value AS DOUBLE) * change, 5) AS DECIMAL(19,5))
        FROM v_dated{s} WHERE asset_class <> 'currency' AND fx_conversion = 'change'
        UNION ALL
        SELECT instrument_id, internal_ticker, field, date, CAST(round(value * rate, 5) AS DECIMAL(19,5))
        FROM v_dated{s} WHERE asset_class <> 'currency' AND fx_conversion IS DISTINCT FROM 'change'""")
    # Days on which more than half of everything ever held has a close
    cte(f"v_priced_days{s}", f"""
        SELECT date, count(*) AS n_priced
        FROM (SELECT DISTINCT date, instrument_id FROM v_ts_usd{s} SEMI JOIN v_held USING (instrument_id) WHERE field = 'close')
        GROUP BY date HAVING 2 * count(*) > (SELECT count(*) FROM v_held) AND date >= (SELECT min(date) FROM v_combined)""")
    cte(f"v_trading_days{s}", f"SELECT date FROM v_priced_days{s}")
    # A balance lasts until the next activity of its pair
    cte(f"v_position{s}", f"""
        SELECT pf_id, instrument_id, d.date, balance AS units, t.value AS price
        FROM v_balance b JOIN v_trading_days{s} d ON d.date >= b.since AND d.date < b.until
        LEFT JOIN (SELECT instrument_id, date, value FROM v_ts_usd{s} WHERE field = 'close') t USING (instrument_id, date)
        WHERE balance > 0.00001""")
    cte(f"v_holdings{s}", f"""
        SELECT h.pf_id, h.instrument_id, h.date, h.units, p.price AS close_usd
        FROM v_position{s} h ASOF LEFT JOIN (SELECT * FROM v_position{s} WHERE price IS NOT NULL) p
          ON p.pf_id = h.pf_id AND p.instrument_id = h.instrument_id AND h.date >= p.date""")
    cte(f"v_nav{s}", f"SELECT pf_id, date, sum(units * close_usd) AS nav FROM v_holdings{s} GROUP BY ALL")
    # A flow counts on the first NAV date from its day on
    cte(f"v_flow_at_nav{s}", f"""
        SELECT f.pf_id, n.date AS nav_date, sum(f.cashflow) AS cashflow
        FROM v_cash_adj f ASOF JOIN v_nav{s} n ON n.pf_id = f.pf_id AND f.date <= n.date GROUP BY ALL""")
    cte(f"v_nav_joined{s}", f"""
        SELECT n.pf_id, n.date, n.nav, coalesce(f.cashflow, 0) AS cashflow,
               100 * (CAST(n.nav - coalesce(f.cashflow, 0) AS DOUBLE) / CAST(p.nav AS DOUBLE) - 1) AS totret
        FROM v_nav{s} n ASOF LEFT JOIN v_nav{s} p ON p.pf_id = n.pf_id AND n.date > p.date
        LEFT JOIN v_flow_at_nav{s} f ON f.pf_id = n.pf_id AND f.nav_date = n.date""")
    cte(f"v_nav_returns{s}", f"""
        SELECT pf_id AS instrument_id, field, date, 'system' AS source, value
        FROM (SELECT pf_id, date, CAST(round(nav, 5) AS DECIMAL(19,5)) AS close, CAST(round(totret, 5) AS DECIMAL(19,5)) AS totret FROM v_nav_joined{s})
        UNPIVOT (value FOR field IN (close, totret))""")


# the ledger does not depend on prices
cte("v_flows", """
    SELECT pf_id, CAST(ts AS DATE) AS date, instrument_id, type, units, cashflow_usd FROM m_activity""")
cte("v_activity_daily", """
    SELECT pf_id, date, instrument_id, sum(units) AS units FROM v_flows
    WHERE list_contains(['open', 'close', 'split'], type) GROUP BY ALL""")
cte("v_cash_daily", """
    SELECT pf_id, date, any_value(usd.instrument_id) AS instrument_id, sum(cashflow_usd) AS units
    FROM v_flows, (SELECT instrument_id FROM m_units WHERE code = 'USD') usd GROUP BY pf_id, date""")
cte("v_combined", "SELECT pf_id, date, instrument_id, sum(units) AS units FROM (FROM v_activity_daily UNION ALL FROM v_cash_daily) GROUP BY ALL")
cte("v_held", "SELECT instrument_id FROM v_combined WHERE instrument_id IS NOT NULL GROUP BY instrument_id")
cte("v_balance", """
    SELECT pf_id, instrument_id, date AS since, sum(units) OVER pair AS balance,
           coalesce(lead(date) OVER pair, DATE '9999-12-31') AS until
    FROM v_combined WINDOW pair AS (PARTITION BY pf_id, instrument_id ORDER BY date)""")
cte("v_cash_adj", """
    SELECT pf_id, date, sum(cashflow_usd) AS cashflow FROM v_flows WHERE type IN ('deposit', 'withdrawal') GROUP BY ALL""")
chain("", "m_observations")


def merged(old: str, new: str, rank: str = "1") -> str:
    """Of all rows of a key the last; ``new`` ones (by ``rank``, then value) after ``old`` ones."""
    key = "instrument_id, field, date, source"
    return f"""SELECT {key}, arg_max(value, {{'r': r, 'v': value}}) AS value
        FROM (SELECT {key}, value, 0 AS r FROM {old} UNION ALL SELECT {key}, value, {rank} FROM {new}) GROUP BY ALL"""


cte("v_upserted", merged("m_observations", "m_upsert_batch", "seq"))
cte("v_refreshed", merged("m_observations", "v_nav_returns"))


_NAME = re.compile(r"\b([mv]_[a-z_0-9]+)\b")


def sql(body: str) -> str:
    """Prefix ``body`` with the CTEs it (transitively) names, dependencies first."""
    order: list[str] = []

    def visit(name: str, stack=()):
        if name in order or name not in CTES:
            return
        for dep in _NAME.findall(CTES[name]):
            if dep != name and dep not in stack:
                visit(dep, stack + (name,))
        order.append(name)

    for n in _NAME.findall(body):
        visit(n)
    if not order:
        return body.strip()
    withs = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in order)
    return f"WITH RECURSIVE {withs}\n{body.strip()}"
