"""Table writes as pure functions ``(current, batch) -> next``.

Parquet has no MERGE/UPDATE and an overwrite cannot read its own target, so
each write computes the next state as a DataFrame; ``sources.sinks`` publishes
it.  At scale the big table is only touched where the batch lands:
``sinks.stage_upsert`` reads only the partitions the batch changes, merges
them with these functions and writes just those anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe import schemas as S


class RowsError(ValueError):
    """An error about rows: ``rows`` is the DataFrame of all of them, the message shows a few and their number."""

    rows: DataFrame


class DuplicateKeyError(RowsError):
    pass


class CheckError(RowsError):
    pass


def raise_on_rows(rows: DataFrame, error: type[RowsError], what: str, shown: int = 20) -> None:
    """Raise ``error`` if there are any ``rows``."""
    n = rows.count()
    if n:
        e = error(f"{what}: {n} rows, of which {[tuple(r) for r in rows.take(shown)]}")
        e.rows = rows
        raise e


def latest_per_key(batch: DataFrame, key: list, seq_col: str = "seq", value_cols: list | None = None) -> DataFrame:
    """Keep the last row per key of a batch (highest ``seq_col``; ties by the values).

    ``max(struct(seq, values))`` is map-side combinable: no sort of the batch.
    """
    vals = value_cols or [c for c in batch.columns if c not in key and c != seq_col]
    best = F.max(F.struct(F.col(seq_col).alias("_seq"), *[F.col(c) for c in vals])).alias("_b")
    return batch.groupBy(*key).agg(best).select(*key, *[F.col(f"_b.{c}").alias(c) for c in vals])


def upsert_observations(current: DataFrame, batch: DataFrame, seq_col: str | None = "seq",
                        key: list = S.OBS_KEY) -> DataFrame:
    """Insert new keys, overwrite the value of existing ones; last batch row wins."""
    if seq_col and seq_col in batch.columns:
        batch = latest_per_key(batch, key, seq_col, [c for c in current.columns if c not in key])
    batch = batch.select(*current.columns)
    return current.join(batch.select(*key), key, "left_anti").unionByName(batch)


def insert_ignore_updates(current: DataFrame, batch: DataFrame, as_of) -> DataFrame:
    """Register schedule rows dated ``as_of``; an existing key keeps its row."""
    rows = (batch.groupBy(*S.UPDATES_KEY).agg(F.min("frequency").alias("frequency"))
            .withColumn("last_update", F.lit(as_of).cast("date")))
    return current.unionByName(rows.join(current.select(*S.UPDATES_KEY), S.UPDATES_KEY, "left_anti")
                               .select(*current.columns))


def strict_conflicts(current: DataFrame, batch: DataFrame, key: list) -> DataFrame:
    """Keys of ``batch`` that exist in ``current`` or occur twice in the batch."""
    clash = batch.select(*key).join(current.select(*key), key, "left_semi").withColumn("reason", F.lit("exists"))
    twice = (batch.groupBy(*key).count().where(F.col("count") > 1).select(*key)
             .withColumn("reason", F.lit("duplicate in batch")))
    return clash.unionByName(twice)


def insert_strict(current: DataFrame, batch: DataFrame, keys: list[list], check: bool = True) -> DataFrame:
    """Plain insert that fails on any duplicate of any unique ``keys``."""
    if check:
        for key in keys:
            raise_on_rows(strict_conflicts(current, batch, key), DuplicateKeyError, f"duplicate {key}")
    return current.unionByName(batch.select(*current.columns))


def insert_strict_instruments(current: DataFrame, batch: DataFrame, current_units: DataFrame,
                              start=S.DEFAULT_START, check: bool = True) -> tuple[DataFrame, DataFrame]:
    """Insert instruments (unique id, name, ticker) of ``batch``, which carries their ``unit``,
    and the first ``instrument_units`` row of each.  Returns ``(instruments, instrument_units)``."""
    nxt = insert_strict(current, batch, [["instrument_id"], ["name"], ["internal_ticker"]], check)
    first = batch.select("instrument_id", "unit", F.lit(start).cast("date").alias("start_date"),
                         F.lit(S.OPEN_END).alias("end_date"))
    return nxt, current_units.unionByName(first)


def insert_strict_attributes(current: DataFrame, batch: DataFrame, check: bool = True) -> DataFrame:
    """Insert attributes, unique on (instrument_id, field)."""
    return insert_strict(current, batch, [["instrument_id", "field"]], check)


def insert_strict_identifiers(current: DataFrame, batch: DataFrame, check: bool = True) -> DataFrame:
    """Insert identifiers, unique on (instrument_id, source)."""
    if "external_id" in batch.columns and "ext_id" not in batch.columns:
        batch = batch.withColumnRenamed("external_id", "ext_id")
    return insert_strict(current, batch, [["instrument_id", "source"]], check)


def append_failures(current: DataFrame, batch: DataFrame, as_of) -> DataFrame:
    """Append failed pulls stamped with ``as_of``."""
    rows = batch.select("instrument_id", "field", "source", F.lit(as_of).cast("timestamp").alias("error_timestamp"),
                        F.col("error_message").cast("string"))
    return current.unionByName(rows)


def touch_updates(current: DataFrame, batch: DataFrame, as_of) -> DataFrame:
    """``last_update = as_of`` for the schedule keys present in the batch; others unchanged."""
    hit = batch.select(*S.UPDATES_KEY).distinct().withColumn("_hit", F.lit(True))
    return (current.join(hit, S.UPDATES_KEY, "left")
            .withColumn("last_update", F.when(F.col("_hit"), F.lit(as_of).cast("date"))
                        .otherwise(F.col("last_update")))
            .drop("_hit").select(*current.columns))


def update_from_join(target: DataFrame, other: DataFrame, on: list, set_col: str, from_col: str) -> DataFrame:
    """``UPDATE target SET set_col = other.from_col FROM other WHERE keys match``."""
    o = other.select(*on, F.col(from_col).alias("_new"), F.lit(True).alias("_hit")).dropDuplicates(on)
    return (target.join(o, on, "left")
            .withColumn(set_col, F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(set_col)))
            .select(*target.columns))


def seed_updates(observations: DataFrame, source: str, frequency: str, as_of) -> DataFrame:
    """One schedule row per distinct (instrument, field) of the observations."""
    return (observations.select("instrument_id", "field").distinct()
            .select("instrument_id", "field", F.lit(source).alias("source"), F.lit(frequency).alias("frequency"),
                    F.lit(as_of).cast("date").alias("last_update")))


def append_activity(current: DataFrame, batch: DataFrame, instruments: DataFrame | None = None,
                    check: bool = True) -> DataFrame:
    """Append ledger rows after the enum, not-null and foreign-key checks."""
    if check:
        from marketframe.operators import quality as Q
        probes = [Q.check_enum(batch, "type", S.TRANSACTION_TYPES),
                  Q.check_not_null(batch, ["pf_id", "type", "broker", "ts"])]
        if instruments is not None:
            ids = instruments.select("instrument_id")
            probes.append(Q.check_foreign_key(batch.where(F.col("instrument_id").isNotNull()), ids,
                                              ["instrument_id"]))
        for p in probes:
            raise_on_rows(p, CheckError, "ledger batch violates a check")
    return current.unionByName(batch.select(*current.columns))


def dry_run(current: DataFrame, batch: DataFrame, key: list = S.OBS_KEY, mode: str = "upsert",
            seq_col: str | None = "seq") -> DataFrame:
    """What a write would do, per action, without publishing anything.

    ``upsert``: insert / update / unchanged; ``ignore``: insert / ignore.
    """
    if seq_col and seq_col in batch.columns:
        batch = latest_per_key(batch, key, seq_col, ["value"])
    cur = current.select(*key, F.col("value").alias("_old"), F.lit(True).alias("_hit")) if mode == "upsert" \
        else current.select(*key, F.lit(True).alias("_hit"))
    j = batch.join(cur, key, "left")
    if mode == "upsert":
        action = (F.when(F.col("_hit").isNull(), "insert")
                  .when(F.col("_old").eqNullSafe(F.col("value")), "unchanged").otherwise("update"))
    else:
        action = F.when(F.col("_hit").isNull(), "insert").otherwise("ignore")
    return j.groupBy(action.alias("action")).agg(F.count(F.lit(1)).alias("n_rows"))
