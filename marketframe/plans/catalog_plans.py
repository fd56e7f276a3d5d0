"""Registered queries for composites (C), writes (W), sources (S), checks (D) and the stream."""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from marketframe import schemas as S
from marketframe.operators import quality as Q
from marketframe.operators import writes as W
from marketframe.plans import oracle
from marketframe.plans.catalog import dbl, m, register
from marketframe.session import checkpoint_dir
from marketframe.sources.driver_tables import AS_OF

AS_OF_TS = dt.datetime(2001, 12, 1)
STALE_CUTOFF = AS_OF - dt.timedelta(days=5)
STATEMENT_PF = "PFXSTATEMENTXXXXXXXX"


def scratch(spark, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "scratch", f"{name}-{uuid.uuid4().hex}")


# ------------------------------------------------------------------ oracle CTEs for this module
oracle.cte("v_stmt_fees", """
    SELECT CAST(date AS DATE) AS dd, position_id, abs(SUM(amount)) AS fee FROM m_statement
    WHERE type IN ('SDRT', 'Commission') AND position_id IS NOT NULL GROUP BY 1, 2""")
oracle.cte("v_stmt_typed", """
    SELECT s.date AS ts, t.ledger AS type, s.position_id, s.row_no, f.fee,
           CASE WHEN t.ledger = 'close' THEN -s.units ELSE s.units END AS units,
           CASE WHEN t.ledger = 'open' THEN -s.amount ELSE s.amount END - COALESCE(f.fee, 0) AS cashflow_usd,
           CASE WHEN t.ledger = 'split' THEN (string_split(trim(s.details), ' '))[-1] END AS notes,
           CASE WHEN t.ledger != 'deposit' THEN replace(split_part(s.details, '/', 1), '.RTH', '') END AS symbol
    FROM m_statement s
    JOIN (VALUES ('Open Position', 'open'), ('Position closed', 'close'), ('Deposit', 'deposit'),
                 ('Withdrawal', 'withdrawal'), ('Dividend', 'dividend'), ('Interest Payment', 'interest'),
                 ('corp action: Split', 'split')) t(stype, ledger) ON s.type = t.stype
    LEFT JOIN v_stmt_fees f ON CAST(s.date AS DATE) = f.dd AND s.position_id = f.position_id""")
oracle.cte("v_symbol_pick", """
    SELECT lookup, arg_min(instrument_key, pos) AS instrument_key FROM m_symbol_candidates
    WHERE NOT is_internal GROUP BY lookup""")
oracle.cte("v_symbol_map", """
    SELECT c.lookup AS symbol, i.instrument_id FROM v_symbol_pick c
    LEFT JOIN m_identifiers i ON i.source = 'ETORO' AND i.ext_id = CAST(c.instrument_key AS VARCHAR)""")
oracle.cte("v_stmt_seq", """
    SELECT s.*, mp.instrument_id, CASE WHEN s.type = 'split' AND r.ratio > 0 THEN r.ratio END AS mult,
           ROW_NUMBER() OVER (PARTITION BY s.position_id ORDER BY s.ts, s.row_no) AS k
    FROM v_stmt_typed s LEFT JOIN v_symbol_map mp ON s.symbol = mp.symbol
    LEFT JOIN (SELECT DISTINCT notes, CASE WHEN len(string_split(notes, ':')) = 2 THEN TRY_CAST(string_split(notes, ':')[1] AS DOUBLE)
                                           / TRY_CAST(string_split(notes, ':')[2] AS DOUBLE) END AS ratio FROM v_stmt_typed) r ON r.notes = s.notes""")
# the holding of a position, event by event
oracle.cte("v_split_fold", """
    SELECT position_id, k, CASE WHEN type IN ('open', 'close') THEN units ELSE 0.0 END AS hold, CAST(0 AS DOUBLE) AS held
    FROM v_stmt_seq WHERE k = 1 AND position_id IS NOT NULL
    UNION ALL
    SELECT s.position_id, s.k, CASE WHEN s.type IN ('open', 'close') THEN f.hold + s.units ELSE f.hold * coalesce(s.mult, 1.0) END, f.hold
    FROM v_split_fold f JOIN v_stmt_seq s ON s.position_id = f.position_id AND s.k = f.k + 1""")
oracle.cte("v_ledger", """
    SELECT s.ts, s.type, s.position_id, s.instrument_id,
           CASE WHEN s.type = 'split' THEN coalesce(f.held, 0.0) * (s.mult - 1) ELSE s.units END AS units,
           s.fee, s.cashflow_usd, s.notes, s.row_no,
           CASE WHEN s.type = 'split' AND s.mult IS NULL THEN 'unusable split ratio: ' || coalesce(s.notes, 'none') END AS split_error
    FROM v_stmt_seq s LEFT JOIN v_split_fold f ON s.position_id = f.position_id AND s.k = f.k""")
oracle.cte("v_plan_fields", """
    WITH due AS (SELECT instrument_id, array_to_string(list_sort(list(field)), ',') AS field_set
                 FROM m_updates WHERE (source, frequency) = ('YAHOO', 'daily') GROUP BY instrument_id)
    SELECT asset_class, ext_id AS ticker, field_set
    FROM m_identifiers NATURAL JOIN due NATURAL JOIN (SELECT instrument_id, asset_class FROM m_instruments) WHERE source = 'YAHOO'""")
oracle.cte("v_plan_batches", """
    SELECT asset_class, field_set, unnest(all_tickers) AS ticker, CAST((unnest(range(len(all_tickers)))) // 5 AS INTEGER) AS batch
    FROM (SELECT asset_class, field_set, list_sort(list(ticker)) AS all_tickers FROM v_plan_fields GROUP BY ALL)""")
oracle.cte("v_plan_requested", "SELECT DISTINCT ticker, unnest(string_split(field_set, ',')) AS field FROM v_plan_fields")
oracle.cte("v_failed_pull", "SELECT DISTINCT ticker, field FROM v_plan_requested ANTI JOIN m_vendor_prices USING (ticker)")
oracle.cte("v_vendor_obs", """
    SELECT * FROM (
        SELECT ticker AS identifier, 'close' AS field, date, 'YAHOO' AS source, raw_close AS value, 1.0 AS scale, rn FROM x
        UNION ALL
        SELECT ticker, 'totret', date, 'YAHOO', totret, 0.01, rn FROM x)
    WHERE rn > 1""".replace("FROM x", """FROM (
        SELECT ticker, date,
               close * COALESCE(product(CASE WHEN stock_splits IS NULL OR stock_splits = 0 THEN 1.0 ELSE stock_splits END)
                   OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 1.0) AS raw_close,
               (adj_close / LAG(adj_close) OVER (PARTITION BY ticker ORDER BY date) - 1) * 100 AS totret,
               ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY date) AS rn
        FROM m_vendor_prices WHERE close IS NOT NULL OR adj_close IS NOT NULL)"""))


# ============================================================ USD variants, FX helpers
@register("time_series_usd_static", """
    SELECT o.instrument_id, i.internal_ticker, o.field, o.date,
           CAST(CASE WHEN f.fx_conversion = 'change' THEN ROUND(CAST(o.value AS DOUBLE) * u.change, 5)
                     ELSE ROUND(o.value * u.value, 5) END AS DOUBLE) AS value
    FROM v_canonical o JOIN m_instruments i ON o.instrument_id = i.instrument_id
    JOIN m_fields f ON o.field = f.name
    JOIN (SELECT instrument_id, unit FROM m_instrument_units WHERE start_date = DATE '1900-01-01') iu
      ON iu.instrument_id = o.instrument_id
    JOIN v_units_ts u ON u.code = iu.unit AND u.date = o.date""")
def q_time_series_usd_static(spark, sf_dir):
    from marketframe.plans.usd import time_series_usd_static
    md = m(spark, sf_dir)
    iu = (md.instrument_units.where(F.col("start_date") == F.lit(S.DEFAULT_START)).select("instrument_id", "unit")
          .join(md.instruments.select("instrument_id", "internal_ticker"), "instrument_id"))
    return time_series_usd_static(md.canonical, iu, md.fields, md.units_ts).select(
        "instrument_id", "internal_ticker", "field", "date", F.round("value", 5).cast("double").alias("value"))


@register("time_series_usd_dated", """
    SELECT o.instrument_id, i.internal_ticker, o.field, o.date,
           CAST(CASE WHEN f.fx_conversion = 'change' THEN ROUND(CAST(o.value AS DOUBLE) * u.change, 5)
                     ELSE ROUND(o.value * u.value, 5) END AS DOUBLE) AS value
    FROM v_canonical o JOIN m_instruments i ON o.instrument_id = i.instrument_id
    JOIN m_fields f ON o.field = f.name
    JOIN m_instrument_units iu ON iu.instrument_id = o.instrument_id AND o.date >= iu.start_date AND o.date < iu.end_date
    JOIN v_units_ts u ON u.code = iu.unit AND u.date = o.date""")
def q_time_series_usd_dated(spark, sf_dir):
    from marketframe.plans.usd import time_series_usd_dated
    md = m(spark, sf_dir)
    return time_series_usd_dated(md.canonical, md.instruments, md.fields, md.instrument_units, md.units_ts).select(
        "instrument_id", "internal_ticker", "field", "date", F.round("value", 5).cast("double").alias("value"))


@register("fx_midpoint", """
    SELECT code, date, value FROM (
        SELECT code, date, ROUND(COALESCE((b + a) / 2, b, a), 5) AS value FROM (
            SELECT code, date,
                   CASE WHEN bid IS NOT NULL AND NOT isnan(bid) AND bid != 0 THEN bid * 100000.0 END AS b,
                   CASE WHEN ask IS NOT NULL AND NOT isnan(ask) AND ask != 0 THEN 1.0 / ask * 100000.0 END AS a
            FROM m_fx_quotes))
    WHERE value IS NOT NULL""")
def q_fx_midpoint(spark, sf_dir):
    from marketframe.plans.fx import fx_midpoint
    return fx_midpoint(m(spark, sf_dir).fx_quotes)


@register("synthetic_usd", """
    SELECT instrument_id, field, date, source, CAST(value AS DOUBLE) AS value FROM m_usd_obs""")
def q_synthetic_usd(spark, sf_dir):
    from marketframe.plans.fx import synthetic_usd
    md = m(spark, sf_dir)
    obs = md.equity_observations.unionByName(md.fx_observations)
    return synthetic_usd(obs, "CUR" + "0" * 17).select(
        "instrument_id", "field", "date", "source", dbl("value"))


@register("seed_units", """
    SELECT substr(internal_ticker, 1, 3) AS code, CAST(0.00001 AS DOUBLE) AS scale, instrument_id
    FROM m_instruments WHERE asset_class = 'currency'
    UNION ALL
    SELECT 'c01', CAST(0.0000001 AS DOUBLE), instrument_id FROM m_instruments WHERE internal_ticker = 'C01USD'""")
def q_seed_units(spark, sf_dir):
    from marketframe.plans.fx import seed_units
    md = m(spark, sf_dir)
    subunits = (md.raw("nation").where(F.col("n_nationkey") == 1)
                .select(F.lit("c01").alias("code"), F.lit(S.SUBUNIT_SCALE).alias("scale"),
                        F.lit("C01").alias("parent")))
    u = seed_units(md.instruments, subunits)
    return u.select("code", F.col("scale").cast("double").alias("scale"), "instrument_id")


@register("backfill_instrument_units", """
    SELECT e.instrument_id, substr(e.currency, 1, 3) AS unit, COALESCE(f.first_date, DATE '1900-01-01') AS start_date,
           DATE '9999-12-31' AS end_date
    FROM m_staging_equities e
    LEFT JOIN (SELECT instrument_id, MIN(date) AS first_date FROM m_observations GROUP BY instrument_id) f
      ON f.instrument_id = e.instrument_id""")
def q_backfill_instrument_units(spark, sf_dir):
    from marketframe.plans.usd import backfill_instrument_units
    md = m(spark, sf_dir)
    return backfill_instrument_units(md.staging_equities.select("instrument_id", F.col("currency").alias("unit")),
                                     md.observations)


# ============================================================ vendor chain
@register("vendor_to_observations", """
    SELECT identifier, field, date, source, ROUND(value, 5) AS value, CAST(scale AS DOUBLE) AS scale FROM v_vendor_obs""")
def q_vendor_to_observations(spark, sf_dir):
    from marketframe.plans.vendor import vendor_to_observations
    v = vendor_to_observations(m(spark, sf_dir).vendor_prices, ["close", "totret"])
    return v.select("identifier", "field", "date", "source", dbl("value"), F.col("scale").cast("double").alias("scale"))


@register("lseg_to_observations", """
    SELECT date, code AS identifier, 'LSEG' AS source, 'close' AS field, CAST(1 AS DOUBLE) AS scale,
           ROUND(bid, 10) AS value FROM m_fx_quotes WHERE bid IS NOT NULL""")
def q_lseg_to_observations(spark, sf_dir):
    from marketframe.plans.vendor import lseg_to_observations
    q = m(spark, sf_dir).fx_quotes
    wide = q.groupBy("date").pivot("code").agg(F.first("bid"))
    out = lseg_to_observations(wide, "close")
    return out.select("date", "identifier", "source", "field", F.col("scale").cast("double").alias("scale"),
                      dbl("value", 10))


@register("pull_outcome", """
    SELECT ticker, unnest(['close', 'totret']) AS field, 'YAHOO' AS source, 'no data returned' AS error_message
    FROM (SELECT DISTINCT ticker FROM v_failed_pull)""")
def q_pull_outcome(spark, sf_dir):
    from marketframe.plans.schedule import to_update
    from marketframe.plans.vendor import pull_outcome
    md = m(spark, sf_dir)
    requested = to_update(md.updates, md.identifiers, md.instruments).select(F.explode("tickers").alias("ticker"))
    rows, _ = pull_outcome(requested, md.vendor_prices.select("ticker"), ["close", "totret"])
    return rows


@register("pull_outcome_summary", """
    SELECT n_requested, n_failed, n_failed * 100.0 / n_requested AS pct_failed,
           CASE WHEN n_failed = 0 THEN 'ok' WHEN n_failed * 1.0 / n_requested < 0.1 THEN 'error' ELSE 'critical' END
           AS severity
    FROM (SELECT (SELECT count(DISTINCT ticker) FROM v_plan_requested) AS n_requested, (SELECT count(DISTINCT ticker) FROM v_failed_pull) AS n_failed)""")
def q_pull_outcome_summary(spark, sf_dir):
    from marketframe.plans.schedule import to_update
    from marketframe.plans.vendor import pull_outcome
    md = m(spark, sf_dir)
    requested = to_update(md.updates, md.identifiers, md.instruments).select(F.explode("tickers").alias("ticker"))
    _, summary = pull_outcome(requested, md.vendor_prices.select("ticker"), ["close", "totret"])
    return summary


@register("vendor_price_check", """
    SELECT COALESCE(a.instrument_id, b.instrument_id) AS instrument_id, COALESCE(a.date, b.date) AS date,
           CAST(a.value AS DOUBLE) AS value_a, CAST(b.value AS DOUBLE) AS value_b,
           ROUND(abs(CAST(a.value AS DOUBLE) - CAST(b.value AS DOUBLE)) / CAST(a.value AS DOUBLE), 10) AS gap
    FROM (SELECT * FROM m_observations WHERE field = 'close' AND source = 'LSEG') a
    FULL OUTER JOIN (SELECT * FROM m_observations WHERE field = 'close' AND source = 'YAHOO') b
      ON a.instrument_id = b.instrument_id AND a.date = b.date
    WHERE a.value IS NULL OR b.value IS NULL
       OR abs(CAST(a.value AS DOUBLE) - CAST(b.value AS DOUBLE)) / CAST(a.value AS DOUBLE) > 0.005""")
def q_vendor_price_check(spark, sf_dir):
    from marketframe.plans.vendor import vendor_price_check
    o = m(spark, sf_dir).observations.where(F.col("field") == "close")
    r = vendor_price_check(o.where(F.col("source") == "LSEG"), o.where(F.col("source") == "YAHOO"))
    return r.select("instrument_id", "date", dbl("value_a"), dbl("value_b"), dbl("gap", 10))


_PRICE_DAY = dt.date(1998, 6, 1)


@register("vendor_price_check_on_date", """
    SELECT instrument_id, date, any_value(value_a) AS value_a, any_value(value_b) AS value_b,
           round(abs(any_value(value_a) - any_value(value_b)) / any_value(value_a), 10) AS gap
    FROM (SELECT instrument_id, date, CASE WHEN source = 'LSEG' THEN CAST(value AS DOUBLE) END AS value_a, CASE WHEN source = 'YAHOO' THEN CAST(value AS DOUBLE) END AS value_b
          FROM m_observations WHERE field = 'close' AND source IN ('LSEG', 'YAHOO') AND date = DATE '1998-06-01')
    GROUP BY ALL HAVING gap IS NULL OR gap > 0.005""")
def q_vendor_price_check_on_date(spark, sf_dir):
    from marketframe.plans.vendor import vendor_price_check
    o = m(spark, sf_dir).observations.where(F.col("field") == "close")
    r = vendor_price_check(o.where(F.col("source") == "LSEG"), o.where(F.col("source") == "YAHOO"), on_date=_PRICE_DAY)
    return r.select("instrument_id", "date", dbl("value_a"), dbl("value_b"), dbl("gap", 10))


@register("check_vendor_completeness", """
    SELECT ext_id AS ticker, CASE WHEN n IS NULL THEN 'absent' ELSE 'no valid value' END AS reason
    FROM (SELECT ext_id FROM m_identifiers WHERE source = 'YAHOO') r
    LEFT JOIN (SELECT ticker, count(CASE WHEN ticker NOT LIKE '%4' THEN close END) AS n FROM m_vendor_prices GROUP BY ticker) v ON v.ticker = r.ext_id
    WHERE coalesce(n, 0) = 0""")
def q_check_vendor_completeness(spark, sf_dir):
    """All scheduled tickers against all landed rows; tickers ending in 4 are answered without values."""
    md = m(spark, sf_dir)
    req = md.identifiers.where(F.col("source") == "YAHOO").select(F.col("ext_id").alias("ticker"))
    landed = md.vendor_prices.select("ticker", F.when(~F.col("ticker").endswith("4"), F.col("close")).alias("close"))
    return Q.check_vendor_completeness(req, landed, "ticker", ["close"])


# ============================================================ schedule
@register("agg_ordered_array", "SELECT asset_class, ticker, field_set FROM v_plan_fields")
def q_agg_ordered_array(spark, sf_dir):
    from marketframe.plans.schedule import agg_ordered_array
    md = m(spark, sf_dir)
    ids = md.identifiers.where(F.col("source") == "YAHOO").select("instrument_id", F.col("ext_id").alias("ticker"))
    u = md.updates.where((F.col("source") == "YAHOO") & (F.col("frequency") == "daily"))
    j = u.join(ids, "instrument_id").join(md.instruments.select("instrument_id", "asset_class"), "instrument_id")
    a = agg_ordered_array(j, ["asset_class", "ticker"], "field", "field_set")
    return a.select("asset_class", "ticker", F.array_join("field_set", ",").alias("field_set"))


@register("assign_batches", "SELECT asset_class, field_set, ticker, batch FROM v_plan_batches")
def q_assign_batches(spark, sf_dir):
    from marketframe.operators.windows import assign_batches
    return assign_batches(q_agg_ordered_array(spark, sf_dir), ["asset_class", "field_set"], ["ticker"], 5)


@register("to_update", """
    SELECT asset_class, field_set, batch, string_agg(ticker, ',' ORDER BY ticker) AS tickers
    FROM v_plan_batches GROUP BY asset_class, field_set, batch""")
def q_to_update(spark, sf_dir):
    from marketframe.plans.schedule import to_update
    md = m(spark, sf_dir)
    p = to_update(md.updates, md.identifiers, md.instruments, "daily", "YAHOO", batch_size=5, sources=md.sources)
    return p.select("asset_class", F.array_join("field_set", ",").alias("field_set"), "batch",
                    F.array_join("tickers", ",").alias("tickers"))


@register("get_iid_mapping", """
    SELECT ext_id, instrument_id FROM m_identifiers WHERE source = 'YAHOO'
    UNION ALL
    SELECT DISTINCT ticker, NULL FROM m_vendor_prices WHERE ticker NOT IN (SELECT ext_id FROM m_identifiers WHERE source = 'YAHOO')""")
def q_get_iid_mapping(spark, sf_dir):
    from marketframe.plans.schedule import get_iid_mapping
    md = m(spark, sf_dir)
    req = md.vendor_prices.select(F.col("ticker").alias("ext_id")).union(
        md.identifiers.where(F.col("source") == "YAHOO").select("ext_id")).distinct()
    return get_iid_mapping(req, md.identifiers, "YAHOO", md.sources)


@register("join_left_mapping", """
    SELECT r.ext_id, i.instrument_id FROM (SELECT DISTINCT ticker AS ext_id FROM m_vendor_prices) r
    LEFT JOIN m_identifiers i ON r.ext_id = i.ext_id AND i.source = 'YAHOO'""")
def q_join_left_mapping(spark, sf_dir):
    from marketframe.operators.relational import join_left_mapping
    md = m(spark, sf_dir)
    return join_left_mapping(md.vendor_prices.select("ticker").distinct(), md.identifiers, "YAHOO")


@register("check_updates", """
    SELECT instrument_id, (SELECT name FROM m_instruments n WHERE n.instrument_id = d.instrument_id) AS name, field, last_update
    FROM m_updates d WHERE date_diff('day', last_update, DATE '2001-10-25') >= 0""")
def q_check_updates(spark, sf_dir):
    from marketframe.plans.schedule import check_updates
    md = m(spark, sf_dir)
    return check_updates(md.updates, md.instruments, dt.date(2001, 10, 25))


_STALE = """(SELECT instrument_id, name, last_update, list_sort(list(field)) AS field_list, array_to_string(list_sort(list(field)), ',') AS fields
             FROM m_updates NATURAL JOIN (SELECT instrument_id, name FROM m_instruments)
             WHERE date_diff('day', last_update, DATE '2001-12-01') >= 5 GROUP BY ALL)"""


@register("agg_fields_per_stale", f"SELECT instrument_id, name, last_update, fields FROM {_STALE}")
def q_agg_fields_per_stale(spark, sf_dir):
    from marketframe.plans.schedule import agg_fields_per_stale, check_updates
    md = m(spark, sf_dir)
    a = agg_fields_per_stale(check_updates(md.updates, md.instruments, STALE_CUTOFF))
    return a.select("instrument_id", "name", "last_update", F.array_join("fields", ",").alias("fields"))


@register("stale_report", f"""
    SELECT instrument_id, name, last_update, fields, date_diff('day', last_update, DATE '2001-12-01') AS days_stale,
           printf('- %s (%s), field(s): %s. Last updated %s (%d days ago)', name, instrument_id,
                  array_to_string(field_list, ', '), strftime(last_update, '%Y-%m-%d'),
                  date_diff('day', last_update, DATE '2001-12-01')) AS line
    FROM {_STALE}""")
def q_stale_report(spark, sf_dir):
    from marketframe.plans.schedule import stale_report
    md = m(spark, sf_dir)
    r = stale_report(md.updates, md.instruments, STALE_CUTOFF, AS_OF)
    return r.select("instrument_id", "name", "last_update", F.array_join("fields", ",").alias("fields"),
                    "days_stale", "line")


# ============================================================ broker statement
@register("agg_fee_by_position", "SELECT dd, position_id, ROUND(fee, 5) AS fee FROM v_stmt_fees")
def q_agg_fee_by_position(spark, sf_dir):
    from marketframe.plans.statement import agg_fee_by_position
    return agg_fee_by_position(m(spark, sf_dir).statement).select("dd", "position_id", dbl("fee"))


_LOOKUPS = """(SELECT DISTINCT replace(split_part(details, '/', 1), '.RTH', '') AS lookup FROM m_statement WHERE type != 'Deposit'
               UNION ALL SELECT 'NONE' || n_nationkey FROM nation)"""


def _register_search(name: str, mode: str, condition: str, fallback: bool) -> None:
    """C25 in one mode; some lookups have no answer and, with a second key, find one by it."""
    second = "'SYM' || CAST(length(l.lookup) + 2 AS VARCHAR)"
    picked = f"(SELECT lookup, arg_min(instrument_key, pos) AS k FROM m_symbol_candidates WHERE {condition} GROUP BY lookup)"

    @register(name, f"""
        SELECT lookup, k AS instrument_key, CASE WHEN k IS NULL THEN 'No instrument found for ' || lookup END AS error
        FROM (SELECT l.lookup, {'coalesce(p.k, q.k)' if fallback else 'p.k'} AS k FROM {_LOOKUPS} l
              LEFT JOIN {picked} p ON p.lookup = l.lookup LEFT JOIN {picked} q ON q.lookup = {second})""")
    def query(spark, sf_dir):
        from marketframe.functions.expressions import expr_statement_symbol
        from marketframe.plans.statement import resolve_symbol
        md = m(spark, sf_dir)
        named = md.statement.where(F.col("type") != "Deposit").select(expr_statement_symbol(F.col("details")).alias("lookup")).distinct()
        lookups = named.unionByName(md.raw("nation").select(F.concat(F.lit("NONE"), F.col("n_nationkey").cast("string")).alias("lookup")))
        lookups = lookups.withColumn("second", F.concat(F.lit("SYM"), (F.length("lookup") + 2).cast("string")))
        return resolve_symbol(lookups, md.symbol_candidates, mode, "second" if fallback else None).select("lookup", "instrument_key", "error")


_register_search("resolve_symbol", "ignore_internal", "NOT is_internal", False)
_register_search("resolve_symbol_strict", "strict", "symbol_full = lookup", False)
_register_search("resolve_symbol_first", "first", "true", False)
_register_search("resolve_symbol_second_key", "ignore_internal", "NOT is_internal", True)


@register("units_before_split", """
    WITH RECURSIVE ev AS (
        SELECT o_custkey AS position_id, l_shipdate AS ts, l_orderkey * 10 + l_linenumber AS row_no,
               CASE WHEN l_linenumber = 7 THEN 'split' ELSE 'open' END AS type, CAST(l_quantity AS DOUBLE) AS units,
               CASE l_returnflag WHEN 'A' THEN 4.0 WHEN 'N' THEN 2.0 END AS mult FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    seq AS (SELECT *, row_number() OVER (PARTITION BY position_id ORDER BY ts, row_no) AS k FROM ev),
    fold AS (SELECT position_id, k, CASE WHEN type = 'open' THEN units ELSE 0.0 END AS hold, CAST(0 AS DOUBLE) AS held FROM seq WHERE k = 1
             UNION ALL
             SELECT s.position_id, s.k, CASE WHEN s.type = 'open' THEN f.hold + s.units ELSE f.hold * coalesce(s.mult, 1.0) END, f.hold
             FROM fold f JOIN seq s ON s.position_id = f.position_id AND s.k = f.k + 1)
    SELECT s.row_no, s.type, s.position_id, round(CASE WHEN s.type = 'split' THEN f.held * (s.mult - 1) ELSE s.units END, 5) AS units,
           s.type = 'split' AND s.mult IS NULL AS flagged
    FROM seq s JOIN fold f ON f.position_id = s.position_id AND f.k = s.k""")
def q_units_before_split(spark, sf_dir):
    """Positions of their own: a customer's order lines, every seventh line a split of 4:1, 2:1 or a zero ratio."""
    from marketframe.plans.statement import units_before_split
    md = m(spark, sf_dir)
    li = md.raw("lineitem").join(md.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    split = F.col("l_linenumber") == 7
    ledger = li.select(F.col("o_custkey").alias("position_id"), F.col("l_shipdate").alias("ts"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_no"),
                       F.when(split, "split").otherwise("open").alias("type"), F.col("l_quantity").cast("double").alias("units"),
                       F.when(split, F.when(F.col("l_returnflag") == "A", "4:1").when(F.col("l_returnflag") == "N", "2:1").otherwise("0:1")).alias("notes"))
    out = units_before_split(ledger)
    return out.select("row_no", "type", "position_id", dbl("units"), F.col("split_error").isNotNull().alias("flagged"))


@register("convert_statement", """
    SELECT ts, type, position_id, instrument_id, ROUND(units, 5) AS units, ROUND(fee, 5) AS fee,
           ROUND(cashflow_usd, 5) AS cashflow_usd, notes, row_no, split_error FROM v_ledger""")
def q_convert_statement(spark, sf_dir):
    from marketframe.plans.statement import convert_statement
    md = m(spark, sf_dir)
    c = convert_statement(md.statement, md.symbol_candidates, md.identifiers)
    return c.select("ts", "type", "position_id", "instrument_id", dbl("units"), dbl("fee"), dbl("cashflow_usd"),
                    "notes", "row_no", "split_error")


# ============================================================ writes
@register("seed_updates", """
    SELECT DISTINCT instrument_id, field, 'YAHOO' AS source, 'weekly' AS frequency, DATE '2001-12-01' AS last_update
    FROM m_observations""")
def q_seed_updates(spark, sf_dir):
    return W.seed_updates(m(spark, sf_dir).observations, "YAHOO", "weekly", AS_OF)


@register("insert_ignore_updates", """
    SELECT * FROM m_updates
    UNION ALL
    SELECT b.instrument_id, b.field, 'YAHOO', 'weekly', DATE '2001-12-01'
    FROM (SELECT DISTINCT instrument_id, field FROM m_observations) b
    WHERE NOT EXISTS (SELECT 1 FROM m_updates u WHERE u.instrument_id = b.instrument_id AND u.field = b.field
                                                AND u.source = 'YAHOO')""")
def q_insert_ignore_updates(spark, sf_dir):
    md = m(spark, sf_dir)
    return W.insert_ignore_updates(md.updates, W.seed_updates(md.observations, "YAHOO", "weekly", AS_OF), AS_OF)


@register("insert_strict_instruments", """
    SELECT 'instrument' AS kind, instrument_id, name AS text, NULL AS start_date, NULL AS end_date FROM m_instruments
    UNION ALL
    SELECT 'unit', instrument_id, unit, start_date, end_date FROM m_instrument_units""")
def q_insert_strict_instruments(spark, sf_dir):
    """Portfolios inserted with their unit: both tables that the insert writes."""
    md = m(spark, sf_dir)
    new = md.portfolios.withColumn("unit", F.lit(S.USD_CODE))
    old_units = md.instrument_units.join(md.portfolios.select("instrument_id"), "instrument_id", "left_anti")
    inst, units = W.insert_strict_instruments(md.instruments.where(F.col("asset_class") != "portfolio"), new, old_units)
    none = F.lit(None).cast("date")
    return (inst.select(F.lit("instrument").alias("kind"), "instrument_id", F.col("name").alias("text"), none.alias("start_date"), none.alias("end_date"))
            .unionByName(units.select(F.lit("unit").alias("kind"), "instrument_id", F.col("unit").alias("text"), "start_date", "end_date")))


@register("insert_strict_attributes", "SELECT * FROM m_attributes")
def q_insert_strict_attributes(spark, sf_dir):
    a = m(spark, sf_dir).attributes
    return W.insert_strict_attributes(a.where(F.col("field") == "country_hq"), a.where(F.col("field") == "region"))


@register("insert_strict_identifiers", "SELECT * FROM m_identifiers")
def q_insert_strict_identifiers(spark, sf_dir):
    i = m(spark, sf_dir).identifiers
    return W.insert_strict_identifiers(i.where(F.col("source") != "ISIN"), i.where(F.col("source") == "ISIN"))


@register("append_failures", """
    SELECT i.instrument_id, f.field, 'YAHOO' AS source, TIMESTAMP '2001-12-01 00:00:00' AS error_timestamp,
           'no data returned' AS error_message
    FROM (SELECT DISTINCT ticker, unnest(['close', 'totret']) AS field FROM v_failed_pull) f
    LEFT JOIN m_identifiers i ON i.source = 'YAHOO' AND i.ext_id = f.ticker""")
def q_append_failures(spark, sf_dir):
    from marketframe.plans.schedule import get_iid_mapping, to_update
    from marketframe.plans.vendor import pull_outcome
    md = m(spark, sf_dir)
    requested = to_update(md.updates, md.identifiers, md.instruments).select(F.explode("tickers").alias("ticker"))
    rows, _ = pull_outcome(requested, md.vendor_prices.select("ticker"), ["close", "totret"])
    ids = get_iid_mapping(rows.select("ticker").distinct(), md.identifiers, "YAHOO").withColumnRenamed("ext_id", "ticker")
    batch = rows.join(ids, "ticker", "left")
    return W.append_failures(spark.createDataFrame([], S.INGEST_FAILURES), batch, AS_OF_TS)


@register("touch_updates", """
    SELECT u.instrument_id, u.field, u.source, u.frequency,
           CASE WHEN b.instrument_id IS NOT NULL THEN DATE '2001-12-01' ELSE u.last_update END AS last_update
    FROM m_updates u LEFT JOIN (SELECT DISTINCT instrument_id, field, source FROM m_upsert_batch) b
      ON u.instrument_id = b.instrument_id AND u.field = b.field AND u.source = b.source""")
def q_touch_updates(spark, sf_dir):
    md = m(spark, sf_dir)
    return W.touch_updates(md.updates, md.upsert_batch, AS_OF)


@register("update_from_join", """
    SELECT i.instrument_id, i.name, i.asset_class,
           CASE WHEN d.instrument_id IS NOT NULL THEN d.ext_id ELSE i.internal_ticker END AS internal_ticker
    FROM m_instruments i LEFT JOIN (SELECT * FROM m_identifiers WHERE source = 'YAHOO') d
      ON i.instrument_id = d.instrument_id""")
def q_update_from_join(spark, sf_dir):
    md = m(spark, sf_dir)
    ids = md.identifiers.where(F.col("source") == "YAHOO")
    return W.update_from_join(md.instruments, ids, ["instrument_id"], "internal_ticker", "ext_id")


@register("seed_from_staging", """
    SELECT 'instruments' AS part, instrument_id, 'equity' AS a, name AS b, currency AS c, NULL AS date, NULL AS value FROM m_staging_equities
    UNION ALL
    SELECT 'identifiers', instrument_id, source, ext_id, NULL, NULL, NULL
    FROM (SELECT instrument_id, unnest(['ISIN', 'LSEG', 'YAHOO', 'ETORO']) AS source,
                 unnest([isin, ric, yfinance_ticker, CAST(etoro_iid AS VARCHAR)]) AS ext_id FROM m_staging_equities) WHERE ext_id IS NOT NULL
    UNION ALL
    SELECT 'attributes', instrument_id, unnest(['gics_code', 'country_hq', 'exchange']), unnest([gics_code, country_hq, exchange]), NULL, NULL, NULL FROM m_staging_equities
    UNION ALL
    SELECT 'observations', instrument_id, o.field, o.source, CAST(CAST(o.scale AS DOUBLE) AS VARCHAR), o.date, CAST(o.value AS DOUBLE)
    FROM m_staging_observations o JOIN m_staging_equities e
      ON o.identifier = CASE o.source WHEN 'LSEG' THEN e.ric WHEN 'YAHOO' THEN e.yfinance_ticker END WHERE o.value IS NOT NULL""")
def q_seed_from_staging(spark, sf_dir):
    """All four outputs of the seed, stacked."""
    from marketframe.plans.seed import seed_from_staging
    md = m(spark, sf_dir)
    out = seed_from_staging(md.staging_equities, md.staging_observations)
    no_date, no_value, none = F.lit(None).cast("date").alias("date"), F.lit(None).cast("double").alias("value"), F.lit(None).cast("string").alias("c")
    def part(name, *cols):
        return out[name].select(F.lit(name).alias("part"), "instrument_id", *cols)
    return (part("instruments", F.col("asset_class").alias("a"), F.col("name").alias("b"), F.col("unit").alias("c"), no_date, no_value)
            .unionByName(part("identifiers", F.col("source").alias("a"), F.col("ext_id").alias("b"), none, no_date, no_value))
            .unionByName(part("attributes", F.col("field").alias("a"), F.col("value").alias("b"), none, no_date, no_value))
            .unionByName(part("observations", F.col("field").alias("a"), F.col("source").alias("b"), F.col("scale").cast("double").cast("string").alias("c"), "date", dbl("value"))))


@register("append_activity", f"""
    SELECT pf_id, type, ts, position_id, instrument_id, ROUND(CAST(units AS DOUBLE), 4) AS units,
           ROUND(CAST(cashflow_usd AS DOUBLE), 4) AS cashflow_usd FROM m_activity
    UNION ALL
    SELECT '{STATEMENT_PF}', type, ts, position_id, instrument_id,
           ROUND(CAST(CAST(units AS DECIMAL(28,8)) AS DOUBLE), 4), ROUND(CAST(CAST(cashflow_usd AS DECIMAL(28,8)) AS DOUBLE), 4)
    FROM v_ledger""")
def q_append_activity(spark, sf_dir):
    from marketframe.plans.statement import convert_statement
    md = m(spark, sf_dir)
    led = convert_statement(md.statement, md.symbol_candidates, md.identifiers)
    batch = led.select(F.lit(STATEMENT_PF).alias("pf_id"), "type", F.lit("etoro").alias("broker"), "ts",
                       "position_id", "instrument_id", F.col("units").cast(S.QTY).alias("units"),
                       F.col("fee").cast(S.QTY).alias("fee"), F.col("cashflow_usd").cast(S.QTY).alias("cashflow_usd"),
                       "notes")
    nxt = W.append_activity(md.activity, batch, md.instruments)
    return nxt.select("pf_id", "type", "ts", "position_id", "instrument_id", dbl("units", 4), dbl("cashflow_usd", 4))


@register("dry_run", """
    SELECT CASE WHEN o.instrument_id IS NULL THEN 'insert' WHEN o.value = b.value THEN 'unchanged' ELSE 'update' END
           AS action, COUNT(*) AS n_rows
    FROM (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY instrument_id, field, date, source
                                                      ORDER BY seq DESC, value DESC) AS rn FROM m_upsert_batch)
          WHERE rn = 1) b
    LEFT JOIN m_observations o ON o.instrument_id = b.instrument_id AND o.field = b.field AND o.date = b.date
                              AND o.source = b.source
    GROUP BY 1""")
def q_dry_run(spark, sf_dir):
    md = m(spark, sf_dir)
    return W.dry_run(md.observations, md.upsert_batch)


@register("publish_snapshot", """
    SELECT instrument_id, field, date, CAST(value AS DOUBLE) AS value FROM v_canonical""")
def q_publish_snapshot(spark, sf_dir):
    from marketframe.sources.sinks import publish_snapshot, read_snapshot
    root = scratch(spark, "snapshots")
    publish_snapshot(m(spark, sf_dir).canonical, root, "canonical_obs", partition_by=["field", "year(date)"])
    return read_snapshot(spark, root, "canonical_obs").select("instrument_id", "field", "date", dbl("value"))


@register("write_csv", """
    SELECT code, date, ROUND(CAST(value AS DOUBLE), 10) AS value, ROUND(change, 10) AS change FROM v_units_ts""")
def q_write_csv(spark, sf_dir):
    from marketframe.sources.sinks import write_csv
    path = scratch(spark, "units_ts_csv")
    write_csv(m(spark, sf_dir).units_ts, path)
    schema = "code string, date date, value decimal(22,12), change double"
    back = spark.read.schema(schema).option("header", True).csv(path)
    return back.select("code", "date", dbl("value", 10), dbl("change", 10))


# ============================================================ sources
@register("scan_equities_csv", "SELECT * FROM m_staging_equities")
def q_scan_equities_csv(spark, sf_dir):
    from marketframe.sources.scans import scan_equities_csv
    path = scratch(spark, "equities_csv")
    m(spark, sf_dir).staging_equities.write.option("header", True).csv(path)
    return scan_equities_csv(spark, path)


@register("scan_observations_csv", """
    SELECT date, identifier, source, field, CAST(scale AS DOUBLE) AS scale, CAST(value AS DOUBLE) AS value
    FROM m_staging_observations""")
def q_scan_observations_csv(spark, sf_dir):
    from marketframe.sources.scans import scan_observations_csv
    path = scratch(spark, "observations_csv")
    m(spark, sf_dir).staging_observations.write.option("header", True).csv(path)
    return scan_observations_csv(spark, path).select("date", "identifier", "source", "field",
                                                     F.col("scale").cast("double").alias("scale"), dbl("value"))


@register("scan_wide_history_csv", """
    SELECT date, code, ROUND(bid, 10) AS value FROM m_fx_quotes WHERE bid IS NOT NULL""")
def q_scan_wide_history_csv(spark, sf_dir):
    from marketframe.sources.driver_tables import nation_code
    from marketframe.sources.scans import scan_wide_history_csv
    md = m(spark, sf_dir)
    codes = sorted(r.code for r in md.raw("nation").select(nation_code("n_nationkey").alias("code")).collect())
    path = scratch(spark, "wide_csv")
    md.fx_quotes.groupBy("date").pivot("code", codes).agg(F.first("bid")).write.option("header", True).csv(path)
    return scan_wide_history_csv(spark, path, codes).select("date", "code", dbl("value", 10))


@register("scan_broker_statement", """
    SELECT date_trunc('second', date) AS date, type, details, ROUND(amount, 5) AS amount, ROUND(units, 5) AS units,
           position_id, row_no FROM m_statement""")
def q_scan_broker_statement(spark, sf_dir):
    from marketframe.sources.scans import scan_broker_statement
    s = m(spark, sf_dir).statement
    path = scratch(spark, "statement_csv")
    (s.select(F.col("date").alias("Date"), F.col("type").alias("Type"), F.col("details").alias("Details"),
              F.col("amount").alias("Amount"), F.col("units").alias("Units / Contracts"),
              F.col("position_id").alias("Position ID"), "row_no")
     .write.option("header", True).option("nullValue", "-").option("timestampFormat", "dd/MM/yyyy HH:mm:ss").csv(path))
    return scan_broker_statement(spark, path).select("date", "type", "details", dbl("amount"), dbl("units"),
                                                     "position_id", "row_no")


@register("scan_trade_history_json", """
    SELECT round(value * 2, 5) AS netProfit, round(value + 1, 5) AS closeRate, date_trunc('second', ts) + INTERVAL 1 HOUR AS closeTimestamp, event_id AS positionId,
           user_id AS instrumentId, event_type = 'purchase' AS isBuy, CAST(event_id % 5 AS INTEGER) AS leverage, round(value, 5) AS openRate,
           date_trunc('second', ts) AS openTimestamp, CASE WHEN event_id % 3 > 0 THEN round(value / 2, 5) END AS stopLossRate,
           round(value * 3, 5) AS takeProfitRate, event_id % 2 = 0 AS trailingStopLoss, event_id + 7 AS orderId, user_id + 9 AS socialTradeId,
           CASE WHEN event_id % 4 > 0 THEN event_id - 1 END AS parentPositionId, round(value * 10, 5) AS investment, round(value * 9, 5) AS initialInvestment,
           round(value / 100, 5) AS fees, round(value * 4, 5) AS units FROM events""")
def q_scan_trade_history_json(spark, sf_dir):
    """All 19 fields of the landed documents; some are absent in some documents."""
    from marketframe.sources.scans import scan_trade_history_json
    v, n, user = F.col("value"), F.col("event_id"), F.col("user_id")
    def stamp(c):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    ts = F.col("ts").cast("timestamp")
    fields = {"netProfit": v * 2, "closeRate": v + 1, "closeTimestamp": stamp(ts + F.expr("INTERVAL 1 HOUR")), "positionId": n, "instrumentId": user,
              "isBuy": F.col("event_type") == "purchase", "leverage": (n % 5).cast("int"), "openRate": v, "openTimestamp": stamp(ts),
              "stopLossRate": F.when(n % 3 > 0, v / 2), "takeProfitRate": v * 3, "trailingStopLoss": n % 2 == 0, "orderId": n + 7, "socialTradeId": user + 9,
              "parentPositionId": F.when(n % 4 > 0, n - 1), "investment": v * 10, "initialInvestment": v * 9, "fees": v / 100, "units": v * 4}
    path = scratch(spark, "trades_json")
    m(spark, sf_dir).raw("events").select(*[c.alias(k) for k, c in fields.items()]).write.json(path)
    t = scan_trade_history_json(spark, path)
    return t.select(*[dbl(c) if k == "double" else F.col(c) for c, k in t.dtypes])


@register("scan_vendor_prices", """
    SELECT ticker, date, ROUND(close, 5) AS close, ROUND(adj_close, 5) AS adj_close, stock_splits FROM m_vendor_prices""")
def q_scan_vendor_prices(spark, sf_dir):
    from marketframe.sources.scans import scan_vendor_prices
    path = scratch(spark, "vendor_landing")
    m(spark, sf_dir).vendor_prices.write.partitionBy("date").parquet(path)
    v = scan_vendor_prices(spark, path, ["close", "totret"], dt.date(1990, 1, 1), dt.date(2100, 1, 1))
    return v.select("ticker", "date", dbl("close"), dbl("adj_close"), "stock_splits")


@register("table_scan_params", """
    SELECT internal_ticker AS ticker, field, date, CAST(value AS DOUBLE) AS value FROM v_ts_usd
    WHERE internal_ticker IN (SELECT internal_ticker FROM m_instruments WHERE asset_class = 'equity')
      AND field IN ('close', 'totret') AND date BETWEEN DATE '1990-01-01' AND DATE '2030-12-31'""")
def q_table_scan_params(spark, sf_dir):
    from marketframe.sources.scans import table_scan_params
    md = m(spark, sf_dir)
    df = table_scan_params(spark, "usd_ts",
                           {"field_1": "close", "field_2": "totret", "first_day": dt.date(1990, 1, 1),
                            "last_day": dt.date(2030, 12, 31)},
                           {"series": md.ts_usd, "tickers": md.equity_tickers()})
    return df.select("ticker", "field", "date", dbl("value"))


@register("list_sources", "SELECT name, (SELECT count(*) FROM m_observations o WHERE o.source = s.name) AS n_rows FROM m_sources s WHERE name IN (SELECT source FROM m_observations)")
def q_list_sources(spark, sf_dir):
    """The valid sources that have observations, and how many."""
    from marketframe.sources.scans import list_sources
    md = m(spark, sf_dir)
    counts = md.observations.groupBy(F.col("source").alias("name")).agg(F.count("*").alias("n_rows"))
    return list_sources(md.sources).join(counts, "name")


# ============================================================ data-quality checks
@register("check_primary_key", """
    SELECT instrument_id, field, date, COUNT(*) AS n FROM m_observations GROUP BY 1, 2, 3 HAVING COUNT(*) > 1""")
def q_check_primary_key(spark, sf_dir):
    return Q.check_primary_key(m(spark, sf_dir).observations, ["instrument_id", "field", "date"])


@register("check_unique", """
    SELECT substr(internal_ticker, 1, 3) AS prefix, COUNT(*) AS n FROM m_instruments
    GROUP BY 1 HAVING COUNT(*) > 1""")
def q_check_unique(spark, sf_dir):
    i = m(spark, sf_dir).instruments.select(F.substring("internal_ticker", 1, 3).alias("prefix"))
    return Q.check_unique(i, "prefix")


@register("check_foreign_key", """
    SELECT instrument_id, field, date, source FROM m_upsert_batch WHERE instrument_id IN (SELECT instrument_id FROM m_instruments WHERE instrument_id LIKE 'EQU%7')""")
def q_check_foreign_key(spark, sf_dir):
    """The batch against an instrument table from which the equities with ids ending in 7 are missing."""
    md = m(spark, sf_dir)
    batch = md.upsert_batch.select("instrument_id", "field", "date", "source")
    parents = md.instruments.where(~F.col("instrument_id").rlike("^EQU.*7$"))
    return Q.check_foreign_key(batch, parents, ["instrument_id"])


@register("check_not_null", """
    SELECT instrument_id, field, date FROM v_ts_usd WHERE value IS NULL""")
def q_check_not_null(spark, sf_dir):
    return Q.check_not_null(m(spark, sf_dir).ts_usd, ["value"]).select("instrument_id", "field", "date")


@register("check_date_order", """
    SELECT instrument_id, 'USD' AS unit, DATE '1998-06-01' AS start_date, start_date + CAST(len(unit) * 35000 AS INTEGER) AS end_date
    FROM m_instrument_units WHERE unit = 'c01' AND start_date + CAST(len(unit) * 35000 AS INTEGER) <= DATE '1998-06-01'
    UNION ALL SELECT instrument_id, 'USD', DATE '2050-01-01', DATE '2050-01-01' FROM m_instrument_units WHERE unit = 'c01'""")
def q_check_date_order(spark, sf_dir):
    """Ranges as stored plus, for each sub-unit instrument, an edit that is empty and one whose end may come first."""
    iu = m(spark, sf_dir).instrument_units
    sub = iu.where(F.col("unit") == "c01")
    empty = sub.select("instrument_id", F.lit("USD").alias("unit"), F.lit(dt.date(2050, 1, 1)).alias("start_date"), F.lit(dt.date(2050, 1, 1)).alias("end_date"))
    turned = sub.select("instrument_id", F.lit("USD").alias("unit"), F.lit(dt.date(1998, 6, 1)).alias("start_date"), F.date_add("start_date", F.length("unit") * 35000).alias("end_date"))
    return Q.check_date_order(iu.unionByName(empty).unionByName(turned))


@register("check_no_overlap", """
    SELECT instrument_id, unit, start_date, end_date, prior_end FROM (
        SELECT *, MAX(end_date) OVER (PARTITION BY instrument_id ORDER BY start_date, end_date
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_end
        FROM (SELECT * FROM m_instrument_units
              UNION ALL SELECT instrument_id, 'USD', DATE '1999-01-01', DATE '1999-02-01'
              FROM m_instrument_units WHERE unit = 'c01'))
    WHERE prior_end > start_date""")
def q_check_no_overlap(spark, sf_dir):
    iu = m(spark, sf_dir).instrument_units
    # Ranges as stored plus one contained range per sub-unit instrument (an edit that must be caught).
    edits = iu.where(F.col("unit") == "c01").select("instrument_id", F.lit("USD").alias("unit"),
                                                    F.lit(dt.date(1999, 1, 1)).alias("start_date"),
                                                    F.lit(dt.date(1999, 2, 1)).alias("end_date"))
    return Q.check_no_overlap(iu.unionByName(edits))


@register("check_enum", """
    SELECT pf_id, type, ts FROM (SELECT pf_id, CASE WHEN type = 'dividend' AND fee > 0.05 THEN upper(type) WHEN type = 'interest' AND fee = 0 THEN NULL ELSE type END AS type, ts FROM m_activity)
    WHERE type IS NULL OR type = 'DIVIDEND'""")
def q_check_enum(spark, sf_dir):
    """The ledger, some of whose types were edited to text outside the allowed set."""
    a = m(spark, sf_dir).activity
    typ = (F.when((F.col("type") == "dividend") & (F.col("fee") > 0.05), F.upper("type"))
           .when((F.col("type") == "interest") & (F.col("fee") == 0), F.lit(None)).otherwise(F.col("type")))
    return Q.check_enum(a.select("pf_id", typ.alias("type"), "ts"), "type", S.TRANSACTION_TYPES)


# ============================================================ history as a user reads it
HIST_CHECKED_SQL = """
    SELECT internal_ticker AS ticker, field, date, ROUND(CAST(value AS DOUBLE), 5) AS value FROM v_ts_usd
    WHERE internal_ticker IN (SELECT internal_ticker FROM m_instruments WHERE asset_class = 'equity')
      AND field IN ('close', 'totret') AND date BETWEEN DATE '1990-01-01' AND DATE '2030-12-31'"""


@register("get_hist_checked", HIST_CHECKED_SQL)
@register("get_hist_checked_all", HIST_CHECKED_SQL)
def q_get_hist_checked_all(spark, sf_dir):
    """The checked history of every equity that has one in these days."""
    from marketframe.plans.catalog import HIST_FROM, HIST_TO
    from marketframe.plans.hist import get_hist_checked
    md = m(spark, sf_dir)
    fields = ["close", "totret"]
    seen = md.ts_usd.where(F.col("field").isin(fields) & F.col("date").between(HIST_FROM, HIST_TO)).select("internal_ticker")
    asked = md.equity_tickers().join(seen, "internal_ticker", "left_semi")
    h = get_hist_checked(md.ts_usd, asked, fields, HIST_FROM, HIST_TO)
    return h.select("ticker", "field", "date", dbl("value"))


# ============================================================ ingest, daily run, stream
oracle.cte("v_ingest_good", """
    SELECT instrument_id, field, date, b.source, CAST(value AS DECIMAL(19,5)) AS value
    FROM v_vendor_obs b JOIN m_identifiers i ON i.source = 'YAHOO' AND i.ext_id = b.identifier AND i.instrument_id LIKE 'EQU%'
    WHERE value IS NOT NULL AND NOT isnan(value)""")
# one group of the schedule: the inverted quotes of currencies, in pipettes, and a USD row a day
oracle.cte("v_ingest_currency", """
    WITH q AS (SELECT instrument_id, date, CAST(1.0 / close * 100000.0 AS DECIMAL(19,5)) AS value
               FROM m_vendor_prices JOIN m_identifiers i ON i.source = 'YAHOO' AND ext_id = ticker
               WHERE instrument_id LIKE 'CUR%' AND close <> 0 AND (close IS NOT NULL OR adj_close IS NOT NULL))
    SELECT instrument_id, 'close' AS field, date, 'YAHOO' AS source, value FROM q
    UNION ALL SELECT DISTINCT 'CURUSDXUSDXXXXXXXXXX', 'close', date, 'system', CAST(100000 AS DECIMAL(19,5)) FROM q""")
oracle.cte("v_ingested", oracle.merged("m_observations", "v_ingest_good"))
oracle.cte("v_ingested_currency", oracle.merged("m_observations", "v_ingest_currency"))


def _equity_pull(md, fields):
    from marketframe.plans.vendor import vendor_to_observations
    equity = md.vendor_prices.where(~F.col("ticker").startswith("X"))
    asked = equity.select("ticker").distinct().select("ticker", F.explode(F.array(*[F.lit(f) for f in fields])).alias("field"))
    return vendor_to_observations(equity, fields), asked


@register("ingest_batch", "SELECT instrument_id, field, date, source, CAST(value AS DOUBLE) AS value FROM v_ingested")
def q_ingest_batch(spark, sf_dir):
    from marketframe.plans.ingest import ingest_batch
    md = m(spark, sf_dir)
    batch, asked = _equity_pull(md, ["close", "totret"])
    out = ingest_batch(md.observations, md.updates, spark.createDataFrame([], S.INGEST_FAILURES), md.identifiers, batch, asked, AS_OF)
    return out["observations"].select("instrument_id", "field", "date", "source", dbl("value"))


@register("ingest_batch_currency", "SELECT instrument_id, field, date, source, CAST(value AS DOUBLE) AS value FROM v_ingested_currency")
def q_ingest_batch_currency(spark, sf_dir):
    """The currency group: quotes without splits, closes only."""
    from marketframe.plans.ingest import ingest_batch
    from marketframe.plans.vendor import vendor_to_observations
    md = m(spark, sf_dir)
    rows = md.vendor_prices.where(F.col("ticker").startswith("X")).withColumn("stock_splits", F.lit(0.0))
    asked = rows.select("ticker", F.lit("close").alias("field")).distinct()
    out = ingest_batch(md.observations, md.updates, spark.createDataFrame([], S.INGEST_FAILURES), md.identifiers,
                       vendor_to_observations(rows, ["close"]), asked, AS_OF, "currency")
    return out["observations"].select("instrument_id", "field", "date", "source", dbl("value"))


@register("ingest_failures", """
    SELECT NULL AS instrument_id, field, source, 'unknown identifier ' || identifier AS error_message
    FROM v_vendor_obs WHERE identifier NOT LIKE 'X%' AND identifier NOT IN (SELECT ext_id FROM m_identifiers WHERE source = 'YAHOO')
    UNION ALL
    SELECT i.instrument_id, b.field, b.source, 'missing or NaN value'
    FROM v_vendor_obs b JOIN m_identifiers i ON i.source = 'YAHOO' AND i.ext_id = b.identifier
    WHERE identifier NOT LIKE 'X%' AND coalesce(isnan(b.value), true)
    UNION ALL
    SELECT instrument_id, unnest(['close', 'totret']), 'YAHOO', 'no data returned'
    FROM m_identifiers WHERE source = 'YAHOO' AND instrument_id LIKE 'EQU%' AND ext_id NOT IN (SELECT identifier FROM v_vendor_obs)""")
def q_ingest_failures(spark, sf_dir):
    """Failures of a pull of all equities: unknown ids, missing values, and silent tickers."""
    from marketframe.plans.ingest import ingest_batch
    md = m(spark, sf_dir)
    batch, asked = _equity_pull(md, ["close", "totret"])
    known = md.identifiers.where((F.col("source") == "YAHOO") & F.col("instrument_id").startswith("EQU")).select(F.col("ext_id").alias("ticker"))
    asked = known.select("ticker", F.explode(F.array(F.lit("close"), F.lit("totret"))).alias("field"))
    out = ingest_batch(md.observations, md.updates, spark.createDataFrame([], S.INGEST_FAILURES), md.identifiers, batch, asked, AS_OF)
    return out["ingest_failures"].select("instrument_id", "field", "source", "error_message")


# the daily job, step by step: window, conversion, ingest, series, portfolios, series again
oracle.cte("v_d_day", "SELECT max(date) AS today FROM m_vendor_prices")
oracle.cte("v_d_landed", """
    SELECT v.*, p.asset_class, p.field_set LIKE '%totret%' AS returns
    FROM m_vendor_prices v JOIN v_plan_fields p USING (ticker), v_d_day
    WHERE date < today AND date >= today - CASE WHEN p.field_set LIKE '%totret%' THEN 31 ELSE 30 END AND (close IS NOT NULL OR adj_close IS NOT NULL)""")
oracle.cte("v_d_wide", """
    SELECT ticker, asset_class, returns, date, row_number() OVER pull AS place,
           close * coalesce(product(CASE WHEN stock_splits <> 0 THEN stock_splits ELSE 1.0 END)
                            OVER (PARTITION BY ticker ORDER BY date DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1.0) AS raw,
           (adj_close / lag(adj_close) OVER pull - 1) * 100 AS ret
    FROM v_d_landed WINDOW pull AS (PARTITION BY ticker ORDER BY date)""")
oracle.cte("v_d_rows", """
    SELECT instrument_id, 'close' AS field, date, 'YAHOO' AS source,
           CAST(CASE WHEN asset_class = 'currency' THEN 1.0 / CASE WHEN raw <> 0 THEN raw END * 100000.0 ELSE raw END AS DECIMAL(19,5)) AS value
    FROM v_d_wide JOIN m_identifiers i ON i.source = 'YAHOO' AND ext_id = ticker WHERE NOT returns OR place > 1
    UNION ALL
    SELECT instrument_id, 'totret', date, 'YAHOO', CAST(ret AS DECIMAL(19,5))
    FROM v_d_wide JOIN m_identifiers i ON i.source = 'YAHOO' AND ext_id = ticker WHERE returns AND place > 1""")
oracle.cte("v_d_good", """
    SELECT * FROM v_d_rows WHERE value IS NOT NULL
    UNION ALL SELECT DISTINCT 'CURUSDXUSDXXXXXXXXXX', 'close', date, 'system', CAST(100000 AS DECIMAL(19,5)) FROM v_d_rows WHERE instrument_id LIKE 'CUR%' AND value IS NOT NULL""")
oracle.cte("v_d_obs", oracle.merged("m_observations", "v_d_good"))
oracle.chain("_d", "v_d_obs")
oracle.cte("v_d_obs_nav", oracle.merged("v_d_obs", "v_nav_returns_d"))
oracle.chain("_dd", "v_d_obs_nav")


def _daily(spark, sf_dir) -> dict:
    from marketframe.plans.ingest import daily_run
    md = m(spark, sf_dir)
    vendor = md.vendor_prices
    as_of = vendor.select(F.max("date")).first()[0] or AS_OF
    return daily_run(md, vendor, as_of, scratch(spark, "daily"))


@register("daily_run", """
    SELECT 'observation' AS kind, instrument_id, field, date, source, CAST(value AS DOUBLE) AS value FROM v_d_obs_nav
    UNION ALL
    SELECT 'usd', instrument_id, field, date, 'usd', CAST(value AS DOUBLE) FROM v_ts_usd_dd""")
def q_daily_run(spark, sf_dir):
    """Whole daily job over the model tables: plan, pull of the scheduled fields in their windows, ingest with the
    currency group, FX and USD refresh, portfolio NAV, second USD refresh.  The published observations and USD series."""
    out = _daily(spark, sf_dir)
    obs = out["observations"].select(F.lit("observation").alias("kind"), "instrument_id", "field", "date", "source", dbl("value"))
    return obs.unionByName(out["time_series_usd"].select(F.lit("usd").alias("kind"), "instrument_id", "field", "date", F.lit("usd").alias("source"), dbl("value")))


@register("daily_run_failures", """
    SELECT instrument_id, field, 'no data returned' AS error_message
    FROM v_plan_requested JOIN m_identifiers i ON i.source = 'YAHOO' AND ext_id = ticker WHERE NOT EXISTS (SELECT 1 FROM v_d_wide w WHERE w.ticker = v_plan_requested.ticker AND (NOT returns OR place > 1))
    UNION ALL SELECT instrument_id, field, 'missing or NaN value' FROM v_d_rows WHERE value IS NULL""")
def q_daily_run_failures(spark, sf_dir):
    """What the daily job logs: scheduled fields of silent tickers, and rows without a value."""
    return _daily(spark, sf_dir)["ingest_failures"].select("instrument_id", "field", "error_message")


@register("stream_ingest", """
    SELECT instrument_id, b.field, b.date, b.source, CAST(CAST(b.value AS DECIMAL(19,5)) AS DOUBLE) AS value
    FROM v_vendor_obs b JOIN m_identifiers i ON i.source = 'YAHOO' AND i.ext_id = b.identifier WHERE b.value IS NOT NULL AND NOT isnan(b.value)""")
def q_stream_ingest(spark, sf_dir):
    """Vendor rows landed in files that cut across the tickers' windows, two files a micro-batch."""
    from marketframe.streaming.ingest_stream import run_to_end
    md, landing = m(spark, sf_dir), scratch(spark, "landing")
    md.vendor_prices.repartition(4, "date").write.parquet(landing)
    out = run_to_end(spark, landing, scratch(spark, "stream_root"), scratch(spark, "stream_ckpt"), md.identifiers, files_per_batch=2)
    return out.select("instrument_id", "field", "date", "source", dbl("value"))
