"""NAV and returns: A3 agg_nav, A4 agg_external_flows, J9 join_asof_forward,
N3 lag_return, C7 portfolio_nav_returns, C8 refresh_portfolios."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketframe import schemas as S
from marketframe.functions.expressions import expr_cast_date, expr_round_money


def agg_nav(holdings: DataFrame) -> DataFrame:
    """A3: NAV per portfolio and date = sum(units × close); null prices are skipped,
    so the NAV is null only when every price of that day is null."""
    return holdings.groupBy("pf_id", "date").agg(F.sum(F.col("units") * F.col("close_usd")).alias("nav"))


def agg_external_flows(activity: DataFrame) -> DataFrame:
    """A4: deposits and withdrawals per portfolio and UTC day."""
    return (activity.where(F.col("type").isin(S.EXTERNAL_FLOW_TYPES))
            .groupBy("pf_id", expr_cast_date(F.col("ts")).alias("date"))
            .agg(F.sum("cashflow_usd").alias("cashflow")))


def join_asof_forward(flows: DataFrame, nav: DataFrame) -> DataFrame:
    """Move each flow to the first NAV date on or after it (per portfolio) and
    sum the flows that land on one NAV date.

    Union of both sides, then ``min(nav_date)`` over the rows at or after each
    flow in date order (NAV rows sort before flows of the same day).  Flows
    after the last NAV date get no NAV date and drop out.  Both inputs are
    already one row per portfolio and day, so a portfolio's window is bounded
    by the calendar, not by the ledger size.
    """
    n = nav.select("pf_id", "date", F.lit(0).alias("kind"), F.col("date").alias("nav_date"),
                   F.lit(None).cast(S.QTY).alias("cashflow"))
    f = flows.select("pf_id", "date", F.lit(1).alias("kind"), F.lit(None).cast("date").alias("nav_date"),
                     F.col("cashflow").cast(S.QTY).alias("cashflow"))
    w = (Window.partitionBy("pf_id").orderBy(F.col("date").desc(), F.col("kind"))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    mapped = (n.unionByName(f).withColumn("target", F.min("nav_date").over(w))
              .where((F.col("kind") == 1) & F.col("target").isNotNull()))
    return mapped.groupBy("pf_id", F.col("target").alias("nav_date")).agg(F.sum("cashflow").alias("cashflow"))


def lag_return(nav: DataFrame, flows_at_nav: DataFrame) -> DataFrame:
    """Flow-adjusted percent return ((nav - flows) / previous nav - 1) × 100."""
    j = nav.join(flows_at_nav.withColumnRenamed("nav_date", "date"), ["pf_id", "date"], "left")
    j = j.withColumn("cashflow", F.coalesce(F.col("cashflow"), F.lit(0).cast(S.QTY)))
    prev = F.lag("nav").over(Window.partitionBy("pf_id").orderBy("date"))
    ret = (F.try_divide((F.col("nav") - F.col("cashflow")).cast("double"), prev.cast("double")) - 1) * 100
    return j.withColumn("totret", ret)


def portfolio_nav_returns(holdings: DataFrame, activity: DataFrame) -> DataFrame:
    """NAV (``close``) and flow-adjusted return (``totret``) as observation rows
    of source ``system``, rounded to 5 places; null values are dropped."""
    from marketframe.sources.sinks import materialize
    nav = materialize(agg_nav(holdings), "nav_days")       # read twice, a row per portfolio and day
    flows = join_asof_forward(agg_external_flows(activity), nav)
    return _nav_rows(lag_return(nav, flows))


def _nav_rows(returns: DataFrame) -> DataFrame:
    """NAV and return of each portfolio and date as observation rows."""
    long = returns.select(F.col("pf_id").alias("instrument_id"), "date",
                          F.explode(F.array(F.struct(F.lit("close").alias("field"),
                                                     expr_round_money(F.col("nav")).alias("value")),
                                            F.struct(F.lit("totret").alias("field"),
                                                     expr_round_money(F.col("totret")).alias("value")))).alias("r"))
    return (long.select("instrument_id", "r.field", "date", F.lit("system").alias("source"), "r.value")
            .where(F.col("value").isNotNull()))


def last_navs(nav: DataFrame) -> DataFrame:
    """The last NAV row of each portfolio, a null NAV too: pf_id, date, nav."""
    return (nav.groupBy("pf_id").agg(F.max(F.struct("date", "nav")).alias("r"))
            .select("pf_id", F.col("r.date").alias("date"), F.col("r.nav").alias("nav")))


def nav_returns_since(nav: DataFrame, flows: DataFrame, before: DataFrame) -> DataFrame:
    """C7 for the NAV rows of ``nav``, given the last NAV row of each portfolio before them (``before``, :func:`last_navs`).

    ``before`` gives the first return its divisor, and tells which flows have landed on a NAV date already:
    those up to its date.  Later ones land in ``nav`` or nowhere yet, so the rows equal :func:`portfolio_nav_returns`.
    """
    anchor = before.select("pf_id", F.col("date").alias("_landed"))
    open_flows = flows.join(anchor, "pf_id", "left").where(F.col("_landed").isNull() | (F.col("date") > F.col("_landed"))).drop("_landed")
    chained = nav.withColumn("_new", F.lit(True)).unionByName(before.select("pf_id", "date", "nav", F.lit(False).alias("_new")))
    return _nav_rows(lag_return(chained, join_asof_forward(open_flows, nav)).where("_new"))


def refresh_portfolios(observations: DataFrame, holdings: DataFrame, activity: DataFrame) -> DataFrame:
    """Observations with the portfolio rows upserted (vendor corrections style)."""
    from marketframe.operators.writes import upsert_observations
    from marketframe.sources.sinks import materialize
    # written once: the rows are read twice, and while their files are small the observations need no shuffle to meet them
    return upsert_observations(observations, materialize(portfolio_nav_returns(holdings, activity), "nav"))
