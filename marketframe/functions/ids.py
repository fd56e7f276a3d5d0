"""Identifier and text column functions: X6 expr_ticker_code, X7 expr_ric_to_yahoo,
X11 valid_isin, X12 create_instrument_id, X13 hex_hash, X14 normalise_dates.

All are built-in Spark expressions (no Python UDF): they run inside
whole-stage codegen next to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# ---------------------------------------------------------------------------
# Internal asset-class codes (first three characters of an instrument id).
ASSET_CLASSES = {"equity": "EQU", "equity_etf": "ETF", "index": "IND", "currency": "CUR", "portfolio": "PFX"}
# ISIN format: two letters, nine alphanumerics, one check digit.
ISIN_PATTERN = r"^[A-Z]{2}[A-Z0-9]{9}[0-9]$"
# Exchange suffix of a RIC -> suffix of the Yahoo ticker (unknown -> '').
RIC_TO_YAHOO_SUFFIX = {
    ".N": "", ".O": "", ".OQ": "", ".K": "", ".A": "",
    ".L": ".L", ".DE": ".DE", ".AS": ".AS", ".PA": ".PA", ".BR": ".BR", ".MC": ".MC", ".MI": ".MI",
    ".CO": ".CO", ".HE": ".HE", ".S": ".ST", ".SW": ".SW", ".TO": ".TO",
}
# Exchange code -> exchange name.
EXCHANGE_CODE_TO_NAME = {
    "NYS": "New York Stock Exchange", "NYQ": "New York Stock Exchange", "NSM": "NASDAQ", "NSQ": "NASDAQ",
    "NMS": "NASDAQ", "BAT": "BATS Exchange", "LSE": "London Stock Exchange", "BRU": "Euronext Brussels",
    "PAR": "Euronext Paris", "AEX": "Euronext Amsterdam", "GER": "Deutsche Börse (Frankfurt)",
    "MCE": "Bolsa de Madrid", "MIL": "Borsa Italiana (Milan)", "CPH": "Nasdaq Copenhagen",
    "TOR": "Toronto Stock Exchange", "HEX": "Nasdaq Helsinki", "VTX": "SIX Swiss Exchange",
}
# Ordinal day suffixes stripped before parsing ("15th" -> "15").
ORDINAL_SUFFIX = r"(\d+)(st|nd|rd|th)\b"


def _map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def expr_ticker_code(t: Column) -> Column:
    """Part before the first ``.``, dashes removed, first four characters."""
    return F.substring(F.regexp_replace(F.substring_index(t, ".", 1), "-", ""), 1, 4)


def expr_ric_to_yahoo(ric: Column) -> Column:
    """X7 (rule part): RIC root plus the mapped exchange suffix; unknown suffix -> ''."""
    root = F.substring_index(ric, ".", 1)
    suffix = F.concat(F.lit("."), F.substring_index(ric, ".", -1))
    return F.concat(root, F.coalesce(_map(RIC_TO_YAHOO_SUFFIX)[suffix], F.lit("")))


def ric_to_yahoo(df: DataFrame, ric_col: str, overrides: DataFrame | None = None,
                 out: str = "yahoo_ticker") -> DataFrame:
    """Yahoo ticker per RIC; an exact override (``ric, yahoo``) wins over the rule."""
    rule = expr_ric_to_yahoo(F.col(ric_col))
    if overrides is None:
        return df.withColumn(out, rule)
    o = overrides.select(F.col(overrides.columns[0]).alias("_ric"),
                         F.col(overrides.columns[1]).alias("_ovr")).dropDuplicates(["_ric"])
    return (df.join(o, F.col(ric_col) == F.col("_ric"), "left")
            .withColumn(out, F.coalesce(F.col("_ovr"), rule)).drop("_ric", "_ovr"))


def isin_digits(x: Column) -> Column:
    """ISIN with letters expanded to 10..35, as one digit string."""
    chars = F.split(x, "")
    return F.array_join(F.transform(chars, lambda c: F.when(c.rlike("^[A-Z]$"), (F.ascii(c) - 55).cast("string"))
                                    .otherwise(c)), "")


def valid_isin(x: Column) -> Column:
    """X11: format check plus Luhn checksum over the expanded digits (false for null)."""
    fmt = F.coalesce(x.rlike(ISIN_PATTERN), F.lit(False))
    return fmt & F.coalesce(F.call_function("luhn_check", isin_digits(x)), F.lit(False))


def hex_hash(name: Column, n: int = 13) -> Column:
    """Upper-cased first ``n`` hex digits of the MD5 of ``name``."""
    return F.upper(F.substring(F.md5(name), 1, n))


def instrument_id_error(asset_class: Column, code: Column, hash_on: Column) -> Column:
    """Reason why ``create_instrument_id`` gives null (null when valid)."""
    ac = F.lower(F.trim(asset_class))
    known = _map(ASSET_CLASSES)[ac].isNotNull()
    code_ok = (F.length(code) >= 1) & (F.length(code) <= 4) & code.rlike("^[A-Za-z0-9]+$")
    hash_ok = (F.when(ac.isin("equity", "equity_etf"), valid_isin(hash_on))
               .when(ac == "currency", (F.length(hash_on) == 3) & hash_on.rlike("^[A-Za-z]+$"))
               .when(ac == "portfolio", hash_on.isNotNull())
               .otherwise(F.lit(False)))
    return (F.when(~F.coalesce(known, F.lit(False)), F.lit("unsupported asset class"))
            .when(~F.coalesce(code_ok, F.lit(False)), F.lit("code must be 1-4 alphanumerical characters"))
            .when(~F.coalesce(hash_ok, F.lit(False)), F.lit("invalid hash input"))
            .otherwise(F.lit(None).cast("string")))


def create_instrument_id(asset_class: Column, code: Column, hash_on: Column) -> Column:
    """Class code (3) + code padded with X (4) + hash part (13); null when invalid.

    Hash part: the ISIN (equity, ETF) or the quote currency (currency),
    right-padded with X; an MD5 prefix of the upper-cased name (portfolio).
    """
    ac = F.lower(F.trim(asset_class))
    hash_part = (F.when(ac == "portfolio", hex_hash(F.upper(hash_on), 13))
                 .otherwise(F.rpad(F.upper(hash_on), 13, "X")))
    iid = F.concat(_map(ASSET_CLASSES)[ac], F.rpad(F.upper(code), 4, "X"), hash_part)
    return F.when(instrument_id_error(asset_class, code, hash_on).isNull(), iid)


# Formats tried in order for text dates (month-first or day-first variants).
_COMMON_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd",
                   "yyyy/MM/dd", "yyyyMMdd", "d MMMM yyyy", "d MMM yyyy", "MMMM d yyyy", "MMM d yyyy",
                   "MMMM d, yyyy", "MMM d, yyyy", "d MMMM, yyyy"]
_DAY_FIRST = ["dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy", "d/M/yyyy", "dd-MM-yyyy", "dd.MM.yyyy"]
_MONTH_FIRST = ["MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy", "M/d/yyyy", "MM-dd-yyyy"]


def normalise_dates(x: Column, dayfirst: bool = False, numeric: bool = False) -> Column:
    """Text or unix seconds to a timestamp; null when nothing parses.

    ``numeric`` says that the column is a number: unix seconds, of any size and
    sign.  Text is never taken for seconds: it is parsed as ISO (with any zone and
    fraction of a second), else ordinal suffixes are stripped and a fixed list
    of formats is tried (``try_to_timestamp`` never raises).
    """
    if numeric:
        v = x.cast("double")
        return F.when(~F.isnan(v) & (F.abs(v) < F.lit(9e12)), F.timestamp_seconds(v))
    s = F.trim(x.cast("string"))
    iso = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}"), s.try_cast("timestamp"))
    plain = F.regexp_replace(s, ORDINAL_SUFFIX, "$1")
    fmts = (_DAY_FIRST + _MONTH_FIRST if dayfirst else _MONTH_FIRST + _DAY_FIRST) + _COMMON_FORMATS
    return F.coalesce(iso, *[F.try_to_timestamp(plain, F.lit(f)) for f in fmts])


def with_timestamps(df: DataFrame, col: str, out: str = "parsed", dayfirst: bool = False) -> DataFrame:
    """X14 by the type of ``col``, plus ``<out>_error``: why a value that is there gives no timestamp."""
    kind = df.schema[col].dataType.typeName()
    number = kind in ("byte", "short", "integer", "long", "float", "double") or kind.startswith("decimal")
    parsed = F.col(col).cast("timestamp") if kind in ("timestamp", "date") else normalise_dates(F.col(col), dayfirst, number)
    return (df.withColumn(out, parsed).withColumn(
        f"{out}_error", F.when(F.col(col).isNotNull() & F.col(out).isNull(), F.concat(F.lit("unreadable date: "), F.col(col).cast("string")))))
