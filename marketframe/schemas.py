"""Fixed schemas of the model tables and the seed values they start with."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

VALUE = T.DecimalType(19, 5)        # observation values
FX_VALUE = T.DecimalType(22, 12)    # scaled FX value; keeps products at scale 13
FIELD_SCALE = T.DecimalType(12, 4)
UNIT_SCALE = T.DecimalType(10, 7)
QTY = T.DecimalType(28, 8)          # units, fees, cash flows (fractional shares)


def _s(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


INSTRUMENTS = _s(("instrument_id", T.StringType(), False), ("name", T.StringType(), False),
                 ("asset_class", T.StringType(), False), ("internal_ticker", T.StringType(), False))
IDENTIFIERS = _s(("instrument_id", T.StringType(), False), ("source", T.StringType(), False),
                 ("ext_id", T.StringType(), False))
ATTRIBUTES = _s(("instrument_id", T.StringType(), False), ("field", T.StringType(), False),
                ("value", T.StringType(), False))
SOURCES = _s(("name", T.StringType(), False), ("priority", T.IntegerType(), True))
FIELDS = _s(("name", T.StringType(), False), ("scale", FIELD_SCALE, False),
            ("fx_conversion", T.StringType(), True))
UNITS = _s(("code", T.StringType(), False), ("scale", UNIT_SCALE, False),
           ("instrument_id", T.StringType(), True))
INSTRUMENT_UNITS = _s(("instrument_id", T.StringType(), False), ("unit", T.StringType(), False),
                      ("start_date", T.DateType(), False), ("end_date", T.DateType(), False))
OBSERVATIONS = _s(("instrument_id", T.StringType(), False), ("field", T.StringType(), False),
                  ("date", T.DateType(), False), ("source", T.StringType(), False),
                  ("value", VALUE, False))
UPDATES = _s(("instrument_id", T.StringType(), False), ("field", T.StringType(), False),
             ("source", T.StringType(), False), ("frequency", T.StringType(), False),
             ("last_update", T.DateType(), False))
INGEST_FAILURES = _s(("instrument_id", T.StringType(), False), ("field", T.StringType(), False),
                     ("source", T.StringType(), False), ("error_timestamp", T.TimestampType(), False),
                     ("error_message", T.StringType(), True))
PORTFOLIO_ACTIVITY = _s(("pf_id", T.StringType(), False), ("type", T.StringType(), False),
                        ("broker", T.StringType(), False), ("ts", T.TimestampType(), False),
                        ("position_id", T.StringType(), True), ("instrument_id", T.StringType(), True),
                        ("units", QTY, True), ("fee", QTY, True), ("cashflow_usd", QTY, True),
                        ("notes", T.StringType(), True))

# Primary keys (used by writes and by the quality checks).
OBS_KEY = ["instrument_id", "field", "date", "source"]
CANONICAL_KEY = ["instrument_id", "field", "date"]
UPDATES_KEY = ["instrument_id", "field", "source"]

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# ---------------------------------------------------------------------------
# Source priorities (lower number wins).
SEED_SOURCES = [("system", 0), ("LSEG", 1), ("YAHOO", 2), ("ETORO", 3), ("ISIN", 100)]
# Fields: name, scale, FX conversion mode.
SEED_FIELDS = [("close", "1", "value"), ("totret", "0.01", "change")]
# The USD instrument, quoted in pipettes, and its unit.
USD_INSTRUMENT_ID = "CURUSDXUSDXXXXXXXXXX"
USD_TICKER = "USDUSD"
USD_CODE = "USD"
USD_PIPETTES = 100000
CURRENCY_SCALE = "0.00001"     # currencies are stored as pipettes
SUBUNIT_SCALE = "0.0000001"    # pence-style sub-unit of a currency
# Transaction types of the portfolio ledger.
TRANSACTION_TYPES = ["open", "close", "deposit", "withdrawal", "dividend", "interest", "split"]
POSITION_TYPES = ["open", "close", "split"]
EXTERNAL_FLOW_TYPES = ["deposit", "withdrawal"]
# Open end of an effective-dated range and the default start.
OPEN_END = dt.date(9999, 12, 31)
DEFAULT_START = dt.date(1900, 1, 1)
# Holdings below this many units are treated as closed.
HOLDING_EPS = "0.00001"
