"""Sources S1-S8: typed scans with declared schemas (never ``inferSchema``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STAGING_EQUITIES = T.StructType([
    T.StructField("instrument_id", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("isin", T.StringType()), T.StructField("yfinance_ticker", T.StringType()),
    T.StructField("etoro_iid", T.IntegerType()), T.StructField("ric", T.StringType()),
    T.StructField("exchange", T.StringType()), T.StructField("country_hq", T.StringType()),
    T.StructField("currency", T.StringType()), T.StructField("gics_code", T.StringType())])
STAGING_OBSERVATIONS = T.StructType([
    T.StructField("date", T.DateType()), T.StructField("identifier", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("field", T.StringType()),
    T.StructField("scale", T.DecimalType(12, 4)), T.StructField("value", T.DecimalType(19, 5))])
STATEMENT = T.StructType([
    T.StructField("Date", T.TimestampType()), T.StructField("Type", T.StringType()),
    T.StructField("Details", T.StringType()), T.StructField("Amount", T.DoubleType()),
    T.StructField("Units / Contracts", T.DoubleType()), T.StructField("Position ID", T.StringType()),
    T.StructField("row_no", T.LongType())])
# Fields of a landed broker trade-history document.
TRADE_HISTORY = T.StructType([
    T.StructField("netProfit", T.DoubleType()), T.StructField("closeRate", T.DoubleType()),
    T.StructField("closeTimestamp", T.TimestampType()), T.StructField("positionId", T.LongType()),
    T.StructField("instrumentId", T.LongType()), T.StructField("isBuy", T.BooleanType()),
    T.StructField("leverage", T.IntegerType()), T.StructField("openRate", T.DoubleType()),
    T.StructField("openTimestamp", T.TimestampType()), T.StructField("stopLossRate", T.DoubleType()),
    T.StructField("takeProfitRate", T.DoubleType()), T.StructField("trailingStopLoss", T.BooleanType()),
    T.StructField("orderId", T.LongType()), T.StructField("socialTradeId", T.LongType()),
    T.StructField("parentPositionId", T.LongType()), T.StructField("investment", T.DoubleType()),
    T.StructField("initialInvestment", T.DoubleType()), T.StructField("fees", T.DoubleType()),
    T.StructField("units", T.DoubleType())])
VENDOR_PRICES = T.StructType([
    T.StructField("ticker", T.StringType()), T.StructField("date", T.DateType()),
    T.StructField("close", T.DoubleType()), T.StructField("adj_close", T.DoubleType()),
    T.StructField("stock_splits", T.DoubleType())])


def _csv(spark: SparkSession, schema: T.StructType, **opts):
    r = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
    for k, v in opts.items():
        r = r.option(k, v)
    return r


def scan_equities_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV of equities, 10 declared columns; malformed rows fail the job."""
    return _csv(spark, STAGING_EQUITIES).csv(path)


def scan_observations_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV of long observations, 6 declared columns."""
    return _csv(spark, STAGING_OBSERVATIONS, dateFormat="yyyy-MM-dd").csv(path)


def scan_wide_history_csv(spark: SparkSession, path: str, codes: list[str], var: str = "code",
                          val: str = "value") -> DataFrame:
    """S3: CSV with a date column and one column per currency code, read and
    unpivoted at once to (date, code, value); empty cells are dropped."""
    schema = T.StructType([T.StructField("date", T.DateType())] +
                          [T.StructField(c, T.DoubleType()) for c in codes])
    wide = _csv(spark, schema, dateFormat="yyyy-MM-dd").csv(path)
    return wide.unpivot(["date"], codes, var, val).where(F.col(val).isNotNull())


def scan_broker_statement(spark: SparkSession, path: str) -> DataFrame:
    """Statement sheet exported to CSV: ``-`` is null, dates ``dd/MM/yyyy HH:mm:ss``,
    position id kept as text.  Columns are renamed to snake case."""
    df = _csv(spark, STATEMENT, nullValue="-", timestampFormat="dd/MM/yyyy HH:mm:ss").csv(path)
    return df.select(F.col("Date").alias("date"), F.col("Type").alias("type"), F.col("Details").alias("details"),
                     F.col("Amount").alias("amount"), F.col("`Units / Contracts`").alias("units"),
                     F.col("`Position ID`").alias("position_id"), "row_no")


def scan_trade_history_json(spark: SparkSession, path: str) -> DataFrame:
    """Typed scan of landed trade-history documents (19 fields)."""
    return spark.read.schema(TRADE_HISTORY).option("mode", "FAILFAST").json(path)


def scan_vendor_prices(spark: SparkSession, path: str, fields: list[str], sdate, edate) -> DataFrame:
    """Landed vendor rows in ``[sdate, edate)``; the start moves back one day
    when ``totret`` is asked for (its first row is dropped later).  The date
    predicate reaches the Parquet scan (and partition pruning when the landing
    is partitioned by date)."""
    start = sdate - dt.timedelta(days=1) if "totret" in fields else sdate
    return (spark.read.schema(VENDOR_PRICES).parquet(path)
            .where((F.col("date") >= F.lit(start)) & (F.col("date") < F.lit(edate))))


# Named read queries: values are ``:param`` markers, tables are names in braces.  Fields are
# asked for one by one, so that the predicate reaches the scan.
NAMED_QUERIES = {
    "usd_ts": """
        WITH asked AS (SELECT DISTINCT internal_ticker FROM {tickers})
        SELECT s.internal_ticker AS ticker, s.field, s.date, s.value
        FROM {series} s LEFT SEMI JOIN asked a ON a.internal_ticker = s.internal_ticker
        WHERE s.field IN (:field_1, :field_2) AND s.date >= :first_day AND s.date <= :last_day""",
    "stale_rows": """
        SELECT due.instrument_id, names.name, due.field, due.last_update
        FROM (SELECT instrument_id, field, last_update FROM {updates} WHERE last_update <= :cutoff) due
        JOIN {instruments} names ON names.instrument_id = due.instrument_id""",
}


def table_scan_params(spark: SparkSession, name: str, params: dict, identifiers: dict) -> DataFrame:
    """Run a named query with bound values and tables.

    ``identifiers`` maps a marker to a DataFrame; Spark binds the values, never
    spliced, and keeps the DataFrames' views for the call only.
    """
    return spark.sql(NAMED_QUERIES[name], args=dict(params), **identifiers)


class UnknownSourceError(ValueError):
    pass


def list_sources(sources: DataFrame) -> DataFrame:
    """Valid source names."""
    return sources.select("name").distinct()


def validate_source(sources: DataFrame, source: str) -> str:
    """Reject a source name that is not in ``sources`` (one tiny lookup)."""
    if sources.where(F.col("name") == source).limit(1).count() == 0:
        raise UnknownSourceError(f"Unsupported source: {source}")
    return source
