"""Scalar column expressions X1-X5, X8-X10, X15, X16 (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketframe import schemas as S


def expr_round_money(x: Column) -> Column:
    """Round half away from zero to 5 places, typed decimal(19,5)."""
    return F.round(x, 5).cast(S.VALUE)


def expr_cast_date(ts: Column) -> Column:
    """Timestamp to its (session time zone, UTC) day."""
    return F.to_date(ts)


def expr_prefix(x: Column, n: int = 3) -> Column:
    """First ``n`` characters (``x::varchar(n)``)."""
    return F.substring(x, 1, n)


def expr_pipette(quote: Column, invert: bool = False) -> Column:
    """Quote (or its inverse) times 1e5, as double; null, zero and NaN give null."""
    q = quote.cast("double")
    ok = q.isNotNull() & ~F.isnan(q) & (q != 0)
    v = (F.lit(1.0) / q if invert else q) * F.lit(100000.0)
    return F.when(ok, v)


def expr_relative_gap(a: Column, b: Column) -> Column:
    """abs(a - b) / a (null if a is zero or null)."""
    return F.try_divide(F.abs(a.cast("double") - b.cast("double")), a.cast("double"))


def expr_statement_symbol(details: Column) -> Column:
    """Symbol of a statement line: part before ``/`` with ``.RTH`` removed."""
    return F.regexp_replace(F.substring_index(details, "/", 1), r"\.RTH", "")


def expr_split_note(details: Column) -> Column:
    """Split ratio text of a statement line: last space-separated token."""
    return F.element_at(F.split(F.trim(details), " "), -1)


def expr_split_ratio(note: Column) -> Column:
    """``a:b`` to a / b (double); malformed text gives null."""
    parts = F.split(note, ":")
    num = F.element_at(parts, 1).try_cast("double")
    den = F.element_at(parts, 2).try_cast("double")
    return F.when(F.size(parts) == 2, F.try_divide(num, den))


def expr_sign_rules(typ: Column, units: Column, amount: Column, fee: Column):
    """Ledger signs: closes negate units, opens negate the amount, and the fee (a
    positive number, none: 0) is taken off the cash flow. Returns (units, cashflow)."""
    u = F.when(typ == "close", -units).otherwise(units)
    cash = F.when(typ == "open", -amount).otherwise(amount) - F.coalesce(fee, F.lit(0.0))
    return u, cash


def expr_days_stale(last_update: Column, as_of) -> Column:
    """Whole days since the last update."""
    return F.datediff(F.lit(as_of) if not isinstance(as_of, Column) else as_of, last_update)


def expr_to_numeric(x: Column, dtype: str = "decimal(19,5)") -> Column:
    """Text to number; text that does not parse becomes null."""
    return F.trim(x).try_cast(dtype)
