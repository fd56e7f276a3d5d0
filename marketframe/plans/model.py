"""Derived views over the model tables, each a lazy DataFrame (``canonical_obs``,
``units_ts``, ``time_series_usd``, holdings, NAV ...).  Registered queries and
the bench build on these, so every query starts from the Parquet scans."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.operators.canonical import canonical_obs
from marketframe.plans import fx, usd
from marketframe.sources.driver_tables import ModelTables
from marketframe.sources.sinks import exists, materialize


class Model(ModelTables):
    """Derived views over model tables built from the driver tables."""

    @cached_property
    def canonical(self) -> DataFrame:
        return canonical_obs(self.observations, self.sources)

    # units_ts and time_series_usd are stored views (refreshed in full): a
    # refresh writes them to the shared checkpoint folder and reads them back.
    def refresh_units_ts(self) -> DataFrame:
        fx_canonical = canonical_obs(fx.fx_observations(self.observations, self.units), self.sources)
        return materialize(fx.units_ts(fx_canonical, self.units), "units_ts")

    def refresh_ts_usd(self) -> DataFrame:
        return materialize(usd.time_series_usd(self.canonical, self.instruments, self.fields,
                                               self.instrument_units, self.units, self.units_ts),
                           "time_series_usd", partition_by=["field"])

    @cached_property
    def units_ts(self) -> DataFrame:
        return self.refresh_units_ts()

    @cached_property
    def ts_usd(self) -> DataFrame:
        return self.refresh_ts_usd()

    @cached_property
    def combined(self) -> DataFrame:
        from marketframe.plans.holdings import combined_activity
        return materialize(combined_activity(self.activity, self.units), "combined")

    @cached_property
    def trading_days(self) -> DataFrame:
        from marketframe.plans.holdings import trading_days
        return materialize(trading_days(self.ts_usd, self.combined), "trading_days")

    @cached_property
    def holdings(self) -> DataFrame:
        from marketframe.plans.holdings import portfolio_holdings
        return portfolio_holdings(self.activity, self.ts_usd, self.units, combined=self.combined, days=self.trading_days)

    @cached_property
    def nav(self) -> DataFrame:
        """Written once, as it is small and read twice; holdings are only read for it, so they are not written."""
        from marketframe.plans.nav import agg_nav
        return materialize(agg_nav(self.holdings), "nav_days")

    @cached_property
    def nav_returns(self) -> DataFrame:
        from marketframe.plans.nav import portfolio_nav_returns
        return portfolio_nav_returns(self.holdings, self.activity)

    def equity_tickers(self) -> DataFrame:
        return self.instruments.where(F.col("asset_class") == "equity").select("internal_ticker")


# Base tables a deployment keeps as stored Parquet tables.
BASE_TABLES = ["sources", "fields", "instruments", "portfolios", "units", "instrument_units", "identifiers",
               "observations", "equity_observations", "fx_observations", "usd_observations", "activity",
               "updates", "upsert_batch", "vendor_prices", "fx_quotes", "statement", "attributes", "rics",
               "ric_overrides", "symbol_candidates", "staging_equities", "staging_observations"]
# Physical layout: partition column and clustering inside files (min/max skipping).
LAYOUT = {"observations": (["field"], ["instrument_id", "date"]),
          "activity": ([], ["pf_id", "ts"]),
          "vendor_prices": ([], ["ticker", "date"])}


VIEW_TABLES = {"units_ts": "units_ts_view", "ts_usd": "time_series_usd_view"}


def stage_base_tables(spark, sf_dir: str, root: str, with_views: bool = False) -> None:
    """Write the model base tables once as Parquet under ``root`` (what a
    deployment stores), with observations partitioned by field and clustered by
    (instrument, date)."""
    src = Model(spark, sf_dir)
    for name in BASE_TABLES:
        df = getattr(src, name)
        part, cluster = LAYOUT.get(name, ([], []))
        if cluster:
            df = df.repartition(*(part or cluster[:1])).sortWithinPartitions(*cluster)
        w = df.write.mode("overwrite")
        if part:
            w = w.partitionBy(*part)
        w.parquet(f"{root}/{name}")
    if with_views:
        # The stored views as the daily refresh leaves them.
        stored = StoredModel(spark, sf_dir, root)
        stored.refresh_units_ts().write.mode("overwrite").parquet(f"{root}/{VIEW_TABLES['units_ts']}")
        stored = StoredModel(spark, sf_dir, root)
        (stored.refresh_ts_usd().write.mode("overwrite").partitionBy("field")
         .parquet(f"{root}/{VIEW_TABLES['ts_usd']}"))


class StoredModel(Model):
    """Same derived views, reading the base tables from stored Parquet."""

    def __init__(self, spark, sf_dir: str, root: str):
        super().__init__(spark, sf_dir)
        self.root = root
        for name in BASE_TABLES:
            self.__dict__[name] = spark.read.parquet(f"{root}/{name}")
        # Stored views, when staged, are what downstream queries read; refresh_* still rebuilds them.
        for attr, folder in VIEW_TABLES.items():
            if exists(spark, f"{root}/{folder}"):        # else they are refreshed on first use
                self.__dict__[attr] = spark.read.parquet(f"{root}/{folder}")
