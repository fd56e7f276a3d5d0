"""Stand-in model tables derived from the driver's TPC-H-style Parquet tables.

Each property returns rows in the schema a job expects and does none of the
jobs' work: it only relabels driver rows (keys become instrument ids, week
buckets become dates, and so on).  The jobs themselves never rely on how these
rows were made.  Every table is a lazy DataFrame over the Parquet scans, so
filters and column pruning still reach the files.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe import schemas as S

AS_OF = dt.date(2001, 12, 1)          # "today" of the schedule fixtures
UPSERT_FROM = dt.date(2001, 7, 1)     # start of the re-pulled window in the upsert batch
UNIT_SWITCH = dt.date(1998, 6, 1)     # date on which some equities switch to USD


def week(c) -> Column:
    """Monday of the ISO week of a timestamp, as DATE."""
    return F.trunc(F.col(c).cast("date"), "week")


def padded(prefix: str, key, width: int = 17) -> Column:
    return F.concat(F.lit(prefix), F.lpad(F.col(key).cast("string") if isinstance(key, str) else key.cast("string"), width, "0"))


def nation_code(key) -> Column:
    return F.concat(F.lit("C"), F.lpad(F.col(key).cast("string"), 2, "0"))


class ModelTables:
    """Lazy model tables over ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ----------------------------------------------------------- dimensions
    @cached_property
    def sources(self) -> DataFrame:
        return self.spark.createDataFrame(S.SEED_SOURCES, S.SOURCES)

    @cached_property
    def fields(self) -> DataFrame:
        from decimal import Decimal
        return self.spark.createDataFrame([(n, Decimal(s), m) for n, s, m in S.SEED_FIELDS], S.FIELDS)

    @cached_property
    def instruments(self) -> DataFrame:
        sup = self.raw("supplier")
        eq = sup.select(padded("EQU", "s_suppkey").alias("instrument_id"), F.col("s_name").alias("name"),
                        F.lit("equity").alias("asset_class"), F.col("s_name").alias("internal_ticker"))
        nat = self.raw("nation")
        cur = nat.select(padded("CUR", "n_nationkey").alias("instrument_id"), F.col("n_name").alias("name"),
                         F.lit("currency").alias("asset_class"),
                         F.concat(nation_code("n_nationkey"), F.lit("USD")).alias("internal_ticker"))
        usd = self.spark.createDataFrame(
            [(S.USD_INSTRUMENT_ID, "United States Dollar", "currency", S.USD_TICKER)], S.INSTRUMENTS)
        return eq.unionByName(cur).unionByName(usd).unionByName(self.portfolios)

    @cached_property
    def portfolios(self) -> DataFrame:
        k = (F.col("o_custkey") % 4)
        return (self.raw("orders").select(k.alias("k")).distinct()
                .select(padded("PFX", "k").alias("instrument_id"),
                        F.concat(F.lit("Portfolio "), F.col("k").cast("string")).alias("name"),
                        F.lit("portfolio").alias("asset_class"),
                        F.concat(F.lit("PF"), F.col("k").cast("string")).alias("internal_ticker")))

    @cached_property
    def units(self) -> DataFrame:
        nat = self.raw("nation")
        cur = nat.select(nation_code("n_nationkey").alias("code"),
                         F.lit(S.CURRENCY_SCALE).cast(S.UNIT_SCALE).alias("scale"),
                         padded("CUR", "n_nationkey").alias("instrument_id"))
        usd = self.spark.range(1).select(F.lit(S.USD_CODE).alias("code"),
                                          F.lit(S.CURRENCY_SCALE).cast(S.UNIT_SCALE).alias("scale"),
                                          F.lit(S.USD_INSTRUMENT_ID).alias("instrument_id"))
        sub = (nat.where(F.col("n_nationkey") == 1)
               .select(F.lit("c01").alias("code"), F.lit(S.SUBUNIT_SCALE).cast(S.UNIT_SCALE).alias("scale"),
                       padded("CUR", "n_nationkey").alias("instrument_id")))
        return cur.unionByName(usd).unionByName(sub)

    @cached_property
    def instrument_units(self) -> DataFrame:
        sup = self.raw("supplier")
        first_unit = (F.when(F.col("s_suppkey") % 7 == 0, F.lit("c01"))
                      .otherwise(nation_code("s_nationkey")))
        switches = F.col("s_suppkey") % 10 == 3
        lo, sw, hi = F.lit(S.DEFAULT_START), F.lit(UNIT_SWITCH), F.lit(S.OPEN_END)
        eq_id = padded("EQU", "s_suppkey")
        first = sup.select(eq_id.alias("instrument_id"), first_unit.alias("unit"), lo.alias("start_date"),
                           F.when(switches, sw).otherwise(hi).alias("end_date"))
        second = sup.where(switches).select(eq_id.alias("instrument_id"), F.lit(S.USD_CODE).alias("unit"),
                                            sw.alias("start_date"), hi.alias("end_date"))
        in_usd = (self.instruments.where(F.col("asset_class").isin("currency", "portfolio"))
                  .select("instrument_id", F.lit(S.USD_CODE).alias("unit"), lo.alias("start_date"),
                          hi.alias("end_date")))
        return first.unionByName(second).unionByName(in_usd)

    @cached_property
    def identifiers(self) -> DataFrame:
        sup = self.raw("supplier")
        key = F.col("s_suppkey").cast("string")
        isin = F.concat(F.lit("US"), F.lpad(key, 9, "0"), (F.col("s_suppkey") % 10).cast("string"))
        return sup.select(padded("EQU", "s_suppkey").alias("instrument_id"),
                          F.explode(F.array(
                              F.struct(F.lit("LSEG").alias("source"), F.concat(F.lit("R"), key).alias("ext_id")),
                              F.struct(F.lit("YAHOO").alias("source"), F.concat(F.lit("Y"), key).alias("ext_id")),
                              F.struct(F.lit("ETORO").alias("source"), key.alias("ext_id")),
                              F.struct(F.lit("ISIN").alias("source"), isin.alias("ext_id")))).alias("i")
                          ).select("instrument_id", "i.source", "i.ext_id").unionByName(
            self.raw("nation").select(padded("CUR", "n_nationkey").alias("instrument_id"), F.lit("YAHOO").alias("source"),
                                      F.concat(F.lit("X"), F.col("n_nationkey").cast("string")).alias("ext_id")))

    # ----------------------------------------------------------------- facts
    @cached_property
    def equity_observations(self) -> DataFrame:
        li = self.raw("lineitem")
        field = F.when(F.col("l_linestatus") == "O", "close").otherwise("totret")
        source = (F.when(F.col("l_returnflag") == "A", "LSEG")
                  .when(F.col("l_returnflag") == "N", "YAHOO").otherwise("ETORO"))
        raw = F.when(F.col("l_linestatus") == "O", F.col("l_extendedprice")).otherwise(
            100 * (F.col("l_discount") - F.col("l_tax")))
        # grouped by the short key, which names an instrument as its id does; ids are made for groups only
        return (li.select("l_suppkey", field.alias("field"), week("l_shipdate").alias("date"), source.alias("source"), raw.alias("v"))
                .groupBy("l_suppkey", "field", "date", "source").agg(F.max("v").alias("v"))
                .select(padded("EQU", "l_suppkey").alias("instrument_id"), "field", "date", "source", F.col("v").cast(S.VALUE).alias("value")))

    @cached_property
    def fx_observations(self) -> DataFrame:
        o = self.raw("orders").select("o_custkey", "o_orderdate", "o_totalprice")
        c = self.raw("customer").select("c_custkey", "c_nationkey")
        return (o.join(c, o.o_custkey == c.c_custkey)
                .groupBy("c_nationkey", week("o_orderdate").alias("date")).agg(F.max("o_totalprice").alias("v"))
                .select(padded("CUR", "c_nationkey").alias("instrument_id"), F.lit("close").alias("field"), "date",
                        F.lit("LSEG").alias("source"), F.col("v").cast(S.VALUE).alias("value")))

    @cached_property
    def usd_observations(self) -> DataFrame:
        nation0 = padded("CUR", F.lit(0))
        return (self.fx_observations.where(F.col("instrument_id") == nation0).select("date").distinct()
                .select(F.lit(S.USD_INSTRUMENT_ID).alias("instrument_id"), F.lit("close").alias("field"),
                        "date", F.lit("system").alias("source"),
                        F.lit(S.USD_PIPETTES).cast(S.VALUE).alias("value")))

    @cached_property
    def observations(self) -> DataFrame:
        return (self.equity_observations.unionByName(self.fx_observations)
                .unionByName(self.usd_observations))

    @cached_property
    def activity(self) -> DataFrame:
        li = self.raw("lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity",
                                         "l_extendedprice", "l_tax", "l_shipdate")
        o = self.raw("orders").select("o_orderkey", "o_custkey")
        types = F.array(*[F.lit(t) for t in
                          ["deposit", "withdrawal", "dividend", "interest", "open", "open", "close"]])
        typ = F.element_at(types, F.col("l_linenumber"))
        is_pos = typ.isin("open", "close")
        qty = F.col("l_quantity").cast(S.QTY)
        cash = F.col("l_extendedprice").cast(S.QTY)
        return (li.join(o, li.l_orderkey == o.o_orderkey)
                .select(padded("PFX", F.col("o_custkey") % 4).alias("pf_id"), typ.alias("type"),
                        F.lit("etoro").alias("broker"), F.col("l_shipdate").cast("timestamp").alias("ts"),
                        F.when(is_pos, F.col("l_orderkey").cast("string")).alias("position_id"),
                        F.when(is_pos, padded("EQU", "l_suppkey")).alias("instrument_id"),
                        F.when(typ == "open", qty).when(typ == "close", -qty).alias("units"),
                        F.col("l_tax").cast(S.QTY).alias("fee"),
                        F.when(typ.isin("withdrawal", "open"), -cash).otherwise(cash).alias("cashflow_usd"),
                        F.lit(None).cast("string").alias("notes")))

    @cached_property
    def updates(self) -> DataFrame:
        sup = self.raw("supplier")
        k = F.col("s_suppkey")
        fields = F.when(k % 3 == 0, F.array(F.lit("close"), F.lit("totret"))).otherwise(F.array(F.lit("close")))
        return sup.select(padded("EQU", "s_suppkey").alias("instrument_id"),
                          F.explode(fields).alias("field"), F.lit("YAHOO").alias("source"),
                          F.when(k % 11 == 0, "weekly").otherwise("daily").alias("frequency"),
                          F.date_add(F.lit(dt.date(2001, 10, 1)), (k % 60).cast("int")).alias("last_update")).unionByName(
            self.raw("nation").select(padded("CUR", "n_nationkey").alias("instrument_id"), F.lit("close").alias("field"),
                                      F.lit("YAHOO").alias("source"), F.lit("daily").alias("frequency"),
                                      F.lit(dt.date(2001, 11, 20)).alias("last_update")))

    @cached_property
    def upsert_batch(self) -> DataFrame:
        """Re-pulled window: corrections, new keys and a key sent twice (``seq`` orders them)."""
        recent = self.observations.where(F.col("date") >= F.lit(UPSERT_FROM))
        corrected = recent.select(*S.OBS_KEY, (F.col("value") + 1).cast(S.VALUE).alias("value"),
                                  F.lit(1).alias("seq"))
        new_keys = recent.select("instrument_id", "field", F.date_add("date", 1).alias("date"), "source",
                                 "value", F.lit(1).alias("seq"))
        twice = (recent.where(F.col("instrument_id") == padded("EQU", F.lit(0)))
                 .select(*S.OBS_KEY, (F.col("value") + 2).cast(S.VALUE).alias("value"), F.lit(2).alias("seq")))
        return corrected.unionByName(new_keys).unionByName(twice)

    # ------------------------------------------------------- vendor landings
    @cached_property
    def vendor_prices(self) -> DataFrame:
        ev = self.raw("events")
        # Landed tickers are Y<2·user>: some scheduled tickers get no rows (failed pulls),
        # and some landed tickers map to no instrument (unknown identifiers).
        # One user in ten stands for a currency ticker X<nation>.
        user = F.col("user_id")
        ticker = (F.when(user % 10 == 3, F.concat(F.lit("X"), (user % 25).cast("string")))
                  .otherwise(F.concat(F.lit("Y"), (user * 2).cast("string"))))
        return (ev.groupBy(ticker.alias("ticker"),
                           F.to_date("ts").alias("date"))
                .agg(F.max("value").alias("close"), F.min("value").alias("adj_close"),
                     F.when(F.max((F.col("event_type") == "signup").cast("int")) == 1, F.lit(2.0))
                     .otherwise(F.lit(0.0)).alias("stock_splits")))

    @cached_property
    def fx_quotes(self) -> DataFrame:
        o = self.raw("orders").select("o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus")
        c = self.raw("customer").select("c_custkey", "c_nationkey")
        return (o.join(c, o.o_custkey == c.c_custkey)
                .groupBy(nation_code("c_nationkey").alias("code"), week("o_orderdate").alias("date"))
                .agg((F.min(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))) / 1e5).alias("bid"),
                     (F.lit(1e5) / F.max("o_totalprice")).alias("ask")))

    @cached_property
    def statement(self) -> DataFrame:
        """Broker statement rows: Date, Type, Details, Amount, Units, Position ID."""
        ev = self.raw("events")
        et = F.col("event_type")
        typ = (F.when(et == "signup", "Deposit").when(et == "purchase", "Open Position")
               .when(et == "click", "Position closed").when(et == "view", "Commission")
               .otherwise("corp action: Split"))
        details = F.concat(F.lit("SYM"), (F.col("user_id") % 20).cast("string"), F.lit("/USD"),
                           F.when(et != "error", F.lit("")).when(F.col("event_id") % 6 == 0, F.lit(" 0:1"))
                           .when(F.col("event_id") % 6 == 1, F.lit(" x")).otherwise(F.lit(" 2:1")))
        return ev.select(F.col("ts").cast("timestamp").alias("date"), typ.alias("type"), details.alias("details"),
                         F.col("value").alias("units"), (F.col("value") * 10).alias("amount"),
                         F.when(F.col("user_id") % 10 != 7, F.col("user_id").cast("string")).alias("position_id"),
                         F.col("event_id").alias("row_no"))

    @cached_property
    def attributes(self) -> DataFrame:
        """Two text attributes per equity: home nation and its region."""
        sup = self.raw("supplier").select("s_suppkey", "s_nationkey")
        nat = self.raw("nation")
        reg = self.raw("region")
        j = sup.join(nat, sup.s_nationkey == nat.n_nationkey).join(reg, F.col("n_regionkey") == F.col("r_regionkey"))
        return j.select(padded("EQU", "s_suppkey").alias("instrument_id"),
                        F.explode(F.array(F.struct(F.lit("country_hq").alias("field"), F.col("n_name").alias("value")),
                                          F.struct(F.lit("region").alias("field"), F.col("r_name").alias("value")))
                                  ).alias("a")).select("instrument_id", "a.field", "a.value")

    @cached_property
    def rics(self) -> DataFrame:
        """A RIC per equity: LSEG id plus an exchange suffix chosen by key."""
        suffixes = F.array(*[F.lit(x) for x in [".N", ".O", ".L", ".DE", ".PA", ".S", ".XX", ""]])
        k = F.col("s_suppkey")
        return self.raw("supplier").select(
            padded("EQU", "s_suppkey").alias("instrument_id"),
            F.concat(F.lit("R"), k.cast("string"), F.element_at(suffixes, (k % 8 + 1).cast("int"))).alias("ric"))

    @cached_property
    def ric_overrides(self) -> DataFrame:
        """Hand overrides (ric, yahoo) for every 25th equity."""
        return (self.rics.where(F.substring("instrument_id", 4, 17).cast("long") % 25 == 0)
                .select("ric", F.concat(F.lit("OVR"), F.substring_index("ric", ".", 1)).alias("yahoo")))

    @cached_property
    def symbol_candidates(self) -> DataFrame:
        """Landed broker search answers: per symbol an internal listing first, then real ones."""
        k = F.col("s_suppkey")
        lookup = F.concat(F.lit("SYM"), (k % 20).cast("string"))
        sup = self.raw("supplier")
        internal = sup.where(k < 20).select(lookup.alias("lookup"), F.lit(0).cast("long").alias("pos"),
                                            F.concat(lookup, F.lit(".INT")).alias("symbol_full"),
                                            F.lit(True).alias("is_internal"), (-1 - k).alias("instrument_key"))
        real = sup.select(lookup.alias("lookup"), (F.floor(k / 20) + 1).cast("long").alias("pos"),
                          lookup.alias("symbol_full"), F.lit(False).alias("is_internal"), k.alias("instrument_key"))
        return internal.unionByName(real)

    @cached_property
    def staging_equities(self) -> DataFrame:
        """Equities CSV staging rows (10 declared columns)."""
        sup = self.raw("supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
        nat = self.raw("nation").select("n_nationkey", "n_name")
        k = F.col("s_suppkey")
        exch = F.element_at(F.array(*[F.lit(x) for x in ["NYS", "NSQ", "LSE", "PAR", "GER", "XXX"]]),
                            (k % 6 + 1).cast("int"))
        isin = F.concat(F.lit("US"), F.lpad(k.cast("string"), 9, "0"), (k % 10).cast("string"))
        return (sup.join(nat, sup.s_nationkey == nat.n_nationkey).join(self.rics.withColumnRenamed("instrument_id", "iid"),
                                                                        F.col("iid") == padded("EQU", "s_suppkey"))
                .select(F.col("iid").alias("instrument_id"), F.col("s_name").alias("name"), isin.alias("isin"),
                        F.concat(F.lit("Y"), k.cast("string")).alias("yfinance_ticker"),
                        k.cast("int").alias("etoro_iid"), "ric", exch.alias("exchange"),
                        F.col("n_name").alias("country_hq"), nation_code("s_nationkey").alias("currency"),
                        F.when(k % 9 != 0, (F.floor(F.abs(F.col("s_acctbal"))) % 100).cast("int").cast("string"))
                        .alias("gics_code")))

    @cached_property
    def staging_observations(self) -> DataFrame:
        """Observations CSV staging rows: vendor identifiers instead of instrument ids."""
        e = self.equity_observations
        r = self.rics
        key = F.substring("instrument_id", 4, 17).cast("long").cast("string")
        ident = (F.when(F.col("source") == "LSEG", F.col("ric"))
                 .when(F.col("source") == "YAHOO", F.concat(F.lit("Y"), key)).otherwise(key))
        scale = F.when(F.col("field") == "close", F.lit(1)).otherwise(F.lit(0.01)).cast("decimal(12,4)")
        return (e.join(r, "instrument_id")
                .select("date", ident.alias("identifier"), "source", "field", scale.alias("scale"),
                        F.when(F.col("value") != 0, F.col("value")).alias("value")))

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)
