"""Broker statement to ledger rows: A10 agg_fee_by_position, C25 resolve_symbol,
N10 units_before_split, C9 convert_statement."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketframe.functions.expressions import expr_sign_rules, expr_split_note, expr_split_ratio, expr_statement_symbol

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# ---------------------------------------------------------------------------
# Statement row types that are fees of a position.
FEE_TYPES = ["SDRT", "Commission"]
# Statement type -> ledger transaction type (unmapped rows are dropped).
STATEMENT_TYPES_MAP = {
    "Open Position": "open",
    "Position closed": "close",
    "Deposit": "deposit",
    "Withdrawal": "withdrawal",
    "Dividend": "dividend",
    "Interest Payment": "interest",
    "corp action: Split": "split",
}


def agg_fee_by_position(statement: DataFrame) -> DataFrame:
    """A10: absolute sum of fee rows per (UTC day, position); null positions form no group."""
    return (statement.where(F.col("type").isin(FEE_TYPES) & F.col("position_id").isNotNull())
            .groupBy(F.to_date("date").alias("dd"), "position_id")
            .agg(F.abs(F.sum("amount")).alias("fee")))


def resolve_symbol(lookups: DataFrame, candidates: DataFrame, mode: str = "ignore_internal",
                   fallback_col: str | None = None, key_col: str = "instrument_key") -> DataFrame:
    """Pick one landed search candidate per lookup.

    ``candidates``: lookup, pos (rank in the search answer), symbol_full,
    is_internal, ``key_col``.  Modes: ``strict`` (exact symbol match),
    ``ignore_internal`` (first non-internal), ``first``.  A lookup with no
    pick tries ``fallback_col``; none at all gives an ``error`` text.
    The pick is ``min(struct(pos, key))``: an aggregate, no sort.
    """
    c = candidates
    if mode == "strict":
        c = c.where(F.col("symbol_full") == F.col("lookup"))
    elif mode == "ignore_internal":
        c = c.where(~F.col("is_internal"))
    picked = (c.groupBy("lookup").agg(F.min(F.struct("pos", key_col)).alias("_p"))
              .select("lookup", F.col(f"_p.{key_col}").alias(key_col)))
    out = lookups.join(picked, "lookup", "left")
    if fallback_col:
        alt = picked.select(F.col("lookup").alias(fallback_col), F.col(key_col).alias("_alt"))
        out = out.join(alt, fallback_col, "left").withColumn(key_col, F.coalesce(key_col, "_alt")).drop("_alt")
    return out.withColumn("error", F.when(F.col(key_col).isNull(),
                                          F.concat(F.lit("No instrument found for "), F.col("lookup"))))


def _split_holdings(ledger: DataFrame, key: str, order: list) -> DataFrame:
    """N10 for rows of positions that have a split: ``_held``, the units held just before each row.

    With M the running product of split multipliers, the holding after any
    event is M * sum(units / M) over the trades up to it, so two window sums give
    every split's holding, including earlier splits, without a per-row loop.
    """
    trade = F.when(F.col("type").isin("open", "close"), F.col("units").cast("double")).otherwise(F.lit(0.0))
    base = Window.partitionBy(key).orderBy(*order)
    upto = base.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = base.rowsBetween(Window.unboundedPreceding, -1)
    staged = ledger.withColumn("_c", F.try_divide(trade, F.product(F.coalesce("_ratio", F.lit(1.0))).over(upto)))
    product = F.coalesce(F.product(F.coalesce("_ratio", F.lit(1.0))).over(before), F.lit(1.0))
    return (staged.withColumn("_held", product * F.coalesce(F.sum("_c").over(before), F.lit(0.0))).drop("_c"))


def units_before_split(ledger: DataFrame, key: str = "position_id", order: list | None = None) -> DataFrame:
    """Replace each split row's units by the adjustment
    ``units held just before the split x (multiplier - 1)``.

    ``notes`` holds the ratio text ``a:b``.  A ratio that is malformed, zero or
    negative adjusts nothing: the row's units become null, ``split_error`` says
    why, and the holding goes on as before.  Only rows of positions with a split are
    windowed; all others, rows without a position among them, pass by.  A split
    without a position has no holding to adjust (0 units).
    """
    order = order or ["ts", "row_no"]
    is_split = F.col("type") == "split"
    ratio = F.when(is_split, expr_split_ratio(F.col("notes")))
    rows = ledger.withColumn("_ratio", F.when(ratio > 0, ratio))
    split = rows.where(is_split & F.col(key).isNotNull()).select(key).distinct()
    known = rows.where(F.col(key).isNotNull())
    windowed = _split_holdings(known.join(split, key, "left_semi"), key, order)
    others = known.join(split, key, "left_anti").unionByName(rows.where(F.col(key).isNull())).withColumn("_held", F.lit(0.0))
    out = windowed.unionByName(others)
    bad = is_split & F.col("_ratio").isNull()
    return (out.withColumn("units", F.when(is_split, F.col("_held") * (F.col("_ratio") - 1)).otherwise(F.col("units").cast("double")))
            .withColumn("split_error", F.when(bad, F.concat(F.lit("unusable split ratio: "), F.coalesce("notes", F.lit("none")))))
            .drop("_ratio", "_held"))


def _with_fees(statement: DataFrame, fee_allocation: str) -> DataFrame:
    """The fee of a day and position on each of its rows (or its first); rows without a position have none."""
    day = F.to_date("date")
    known = statement.where(F.col("position_id").isNotNull()).withColumn("dd", day)
    known = known.join(agg_fee_by_position(statement), ["dd", "position_id"], "left")
    if fee_allocation == "first":
        first = F.row_number().over(Window.partitionBy("dd", "position_id").orderBy("date", "row_no")) == 1
        known = known.withColumn("fee", F.when(first, F.col("fee")))
    loose = statement.where(F.col("position_id").isNull()).withColumn("fee", F.lit(None).cast("double"))
    return known.drop("dd").unionByName(loose)


def convert_statement(statement: DataFrame, candidates: DataFrame, identifiers: DataFrame,
                      fee_allocation: str = "all", source: str = "ETORO") -> DataFrame:
    """Broker statement rows to ledger rows
    (ts, type, position_id, instrument_id, units, fee, cashflow_usd, notes, row_no, split_error).

    Fees of a day and position are attached to every row of that day and
    position (``fee_allocation="first"``: only to its first row); the type is
    mapped and unmapped rows dropped; signs follow X10; split rows carry the
    ratio in ``notes`` and their units become the adjustment (N10).
    Symbols are resolved through landed search candidates and the broker's
    identifiers.
    """
    s = _with_fees(statement, fee_allocation)
    tmap = F.create_map(*[F.lit(x) for kv in STATEMENT_TYPES_MAP.items() for x in kv])
    s = s.withColumn("type", tmap[F.col("type")]).where(F.col("type").isNotNull())
    units, cash = expr_sign_rules(F.col("type"), F.col("units"), F.col("amount"), F.col("fee"))
    s = s.select(F.col("date").alias("ts"), "type", "position_id", "row_no", "fee", units.alias("units"), cash.alias("cashflow_usd"),
                 F.when(F.col("type") == "split", expr_split_note(F.col("details"))).alias("notes"),
                 F.when(F.col("type") != "deposit", expr_statement_symbol(F.col("details"))).alias("symbol"))
    symbols = s.select(F.col("symbol").alias("lookup")).where(F.col("lookup").isNotNull()).distinct()
    resolved = resolve_symbol(symbols, candidates, "ignore_internal").select(
        F.col("lookup").alias("symbol"), F.col("instrument_key").cast("string").alias("ext_id"))
    ids = identifiers.where(F.col("source") == source).select("ext_id", "instrument_id")
    mapping = resolved.join(ids, "ext_id", "left").select("symbol", "instrument_id").dropDuplicates(["symbol"])
    # rows without a symbol would all meet in one task: they have nothing to look up
    named = s.where(F.col("symbol").isNotNull()).join(mapping, "symbol", "left")
    s = named.unionByName(s.where(F.col("symbol").isNull()).withColumn("instrument_id", F.lit(None).cast("string")))
    return units_before_split(s).select("ts", "type", "position_id", "instrument_id", "units", "fee", "cashflow_usd",
                                        "notes", "row_no", "split_error")
