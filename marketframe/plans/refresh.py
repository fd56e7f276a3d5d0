"""Anchored refresh of stored portfolios (C6-C8): only what lies after the first changed day is computed and written."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe import schemas as S
from marketframe.operators.canonical import canonical_obs
from marketframe.operators.writes import upsert_observations
from marketframe.plans import usd
from marketframe.plans.holdings import combined_activity, holdings_since, last_closes, trading_days
from marketframe.plans.ingest import BY_FIELD_YEAR
from marketframe.plans.nav import agg_external_flows, agg_nav, last_navs, nav_returns_since
from marketframe.sources.sinks import (BY_YEAR, commit, materialize, read_manifest, read_table, read_years, stage_since, stage_snapshot,
                                       stage_upsert)

#: Published state: the ledger by day, trading days, holdings, the last holding of each pair and year, and NAVs.
STATE = ["portfolio_ledger", "portfolio_days", "portfolio_holdings", "portfolio_positions", "portfolio_nav"]
#: Under this name a commit keeps the version of ``time_series_usd`` that the state was made from.
APPLIED = "portfolios"


def ledger_days(activity: DataFrame, units: DataFrame) -> DataFrame:
    """All that portfolios take from the ledger, by day: units by instrument, cash among them, and external flows."""
    held = combined_activity(activity, units).select("pf_id", "date", F.lit("units").alias("kind"), "instrument_id", F.col("units").alias("amount"))
    flows = agg_external_flows(activity).select("pf_id", "date", F.lit("flow").alias("kind"), F.lit(None).cast("string").alias("instrument_id"),
                                                F.col("cashflow").alias("amount"))
    return held.unionByName(flows)


def differences(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that only one of two tables has (or has more often): one aggregation, combined before its shuffle."""
    both = new.withColumn("_n", F.lit(1)).unionByName(old.select(*new.columns).withColumn("_n", F.lit(-1)))
    return both.groupBy(*new.columns).agg(F.sum("_n").alias("_n")).where("_n <> 0").drop("_n")


def first_day(rows: DataFrame) -> dt.date | None:
    return rows.select(F.min("date")).first()[0]


def first_price_change(fresh: DataFrame, stored: DataFrame) -> dt.date | None:
    """The first day of a close in ``fresh`` that ``stored`` doesn't have as it is."""
    columns = ["instrument_id", "date", "value"]
    since = F.lit(first_day(fresh))
    a, b = (t.where((F.col("field") == "close") & (F.col("date") >= since)).select(*columns) for t in (fresh, stored))
    there = b.select(*[F.col(c).alias(f"_{c}") for c in columns])
    return first_day(a.join(there, [a[c].eqNullSafe(F.col(f"_{c}")) for c in columns], "left_anti"))


def is_anchored(manifest: dict) -> bool:
    """Whether the published state was made from the published USD series."""
    tables = manifest["tables"]
    return all(t in tables for t in STATE) and manifest["applied"].get(APPLIED) == tables["time_series_usd"]["version"]


def _days(ts: DataFrame, ledger: DataFrame, combined: DataFrame, root: str, since: dt.date) -> DataFrame:
    """Trading days now; those before ``since`` as stored while the same instruments are held, for they depend on these and prices alone."""
    spark = ts.sparkSession
    held = [t.where("kind = 'units'").select("instrument_id").distinct() for t in (read_table(spark, root, "portfolio_ledger"), ledger)]
    if not differences(*held).isEmpty():
        return trading_days(ts, combined)
    older = read_table(spark, root, "portfolio_days").where(F.col("date") < F.lit(since))
    return older.unionByName(trading_days(ts.where(F.col("date") >= F.lit(since)), combined))


def refresh_stored(model, root: str, units_ts: DataFrame, prices_since: dt.date | None, anchored: bool) -> dt.date | None:
    """C8 on published tables: holdings, NAVs, NAV observations and their USD rows from the first changed day on, in one commit.

    ``anchored``: the state agreed with the USD series before this job changed closes from ``prices_since`` on (None: none
    changed); else all days are computed.  The first changed day is the earliest of that, of a change in the ledger, and
    of a change in the trading days (another number of held instruments moves them).  State before it is kept as it is:
    opening balances come from the ledger, carried closes from the last holdings, the first return from the last NAV.
    Returns that day; None if nothing has changed.
    """
    spark = units_ts.sparkSession
    ts = read_table(spark, root, "time_series_usd")
    version = read_manifest(spark, root)["tables"]["time_series_usd"]["version"]
    ledger = materialize(ledger_days(model.activity, model.units), "ledger")
    combined = ledger.where("kind = 'units'").select("pf_id", "date", "instrument_id", F.col("amount").alias("units"))
    flows = ledger.where("kind = 'flow'").select("pf_id", "date", F.col("amount").alias("cashflow"))
    if anchored:
        since = min(filter(None, [prices_since, first_day(differences(read_table(spark, root, "portfolio_ledger"), ledger))]), default=None)
        if since is None:
            commit(spark, root, [], {APPLIED: version})
            return None
        days = materialize(_days(ts, ledger, combined, root, since), "trading_days")
        start = min(filter(None, [since, first_day(differences(read_table(spark, root, "portfolio_days"), days))]))
    else:
        days = materialize(trading_days(ts, combined), "trading_days")
        start = first_day(ledger) or S.DEFAULT_START
    new_year = dt.date(start.year, 1, 1)
    if anchored:
        this_year = read_years(spark, root, "portfolio_holdings", start.year, start.year).where(F.col("date") < F.lit(start))
        carried = last_closes(last_closes(this_year).unionByName(read_years(spark, root, "portfolio_positions", 0, start.year - 1)))
        navs = last_navs(read_years(spark, root, "portfolio_nav", 0, start.year).where(F.col("date") < F.lit(start)))
    else:
        this_year = combined.limit(0).withColumn("close_usd", F.lit(None).cast(S.VALUE))
        carried, navs = last_closes(this_year), last_navs(agg_nav(this_year))
    held = materialize(holdings_since(start, carried, combined, ts, days), "holdings")
    nav = materialize(agg_nav(held), "nav_days")
    rows = materialize(nav_returns_since(nav, flows, navs), "nav")
    by_year = this_year.unionByName(held).groupBy("pf_id", "instrument_id", F.year("date").alias("_y"))
    positions = by_year.agg(F.max(F.struct("date", "close_usd")).alias("r")).select("pf_id", "instrument_id", "r.date", "r.close_usd")

    owners = model.activity.select(F.col("pf_id").alias("instrument_id")).distinct()
    observed = read_table(spark, root, "observations").where(F.col("date") >= F.lit(start)).join(owners, "instrument_id", "left_semi")
    priced = usd.time_series_usd(canonical_obs(upsert_observations(observed, rows, None), model.sources), model.instruments, model.fields,
                                 model.instrument_units, model.units, units_ts.where(F.col("date") >= F.lit(start)))
    series = stage_upsert(priced, root, "time_series_usd", S.CANONICAL_KEY, BY_FIELD_YEAR)
    staged = [stage_upsert(rows, root, "observations", S.OBS_KEY, BY_FIELD_YEAR), series, stage_snapshot(days, root, "portfolio_days")]
    for table, part, since in (("portfolio_ledger", ledger.where(F.col("date") >= F.lit(start)), start), ("portfolio_holdings", held, start),
                               ("portfolio_positions", positions, new_year), ("portfolio_nav", nav, start)):
        staged.append(stage_since(part, root, table, since) if anchored else stage_snapshot(part, root, table, BY_YEAR))
    commit(spark, root, staged, {APPLIED: version + bool(series.parts)})
    return start
