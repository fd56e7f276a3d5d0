"""Set-based daily ingest: C18 ingest_batch, C24 daily_run.

One job per step for all tickers at once, replacing the per-ticker loop and
row-by-row upserts.  Every write goes through commits (W12): a failed run
resumes from published tables, and a lost executor re-reads files.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe import schemas as S
from marketframe.functions.expressions import expr_pipette
from marketframe.operators.writes import append_failures, touch_updates, upsert_observations
from marketframe.plans.schedule import get_iid_mapping
from marketframe.plans.vendor import vendor_to_observations

#: Partitions of the observations and of the USD series, as SQL expressions.
BY_FIELD_YEAR = ["field", "year(date)"]


def ingest_rows(identifiers: DataFrame, batch: DataFrame, requested: DataFrame, transform: str = "normal",
                source: str = "YAHOO") -> tuple[DataFrame, DataFrame]:
    """Observations to load (with ``seq``) and failures of one pull.

    ``batch``: identifier, field, date, source, value (vendor long rows), and ``seq``,
    the landed order, by which the last row of a key wins.  ``requested``: ticker and
    field as scheduled.  Rows with an unknown identifier or a missing or NaN value
    fail; so do the requested fields of tickers without any row.  ``transform="currency"``
    stores the inverted quote in pipettes and adds the constant USD row of each date.
    """
    if "seq" not in batch.columns:
        batch = batch.withColumn("seq", F.lit(0))
    ids = batch.select("identifier").union(requested.select(F.col("ticker").alias("identifier"))).distinct()
    mapping = get_iid_mapping(ids, identifiers, source).withColumnRenamed("ext_id", "identifier").dropDuplicates(["identifier"])
    v = F.col("value").cast("double")
    mapped = batch.join(mapping, "identifier", "left").withColumn("value", expr_pipette(v, invert=True) if transform == "currency" else v)
    bad_value = F.col("value").isNull() | F.isnan("value")
    good = (mapped.where(F.col("instrument_id").isNotNull() & ~bad_value)
            .select(*S.OBS_KEY, F.col("value").cast(S.VALUE).alias("value"), F.col("seq").cast("long").alias("seq")))
    if transform == "currency":
        usd = (good.select("date").distinct()
               .select(F.lit(S.USD_INSTRUMENT_ID).alias("instrument_id"), F.lit("close").alias("field"), "date", F.lit("system").alias("source"),
                       F.lit(S.USD_PIPETTES).cast(S.VALUE).alias("value"), F.lit(0).cast("long").alias("seq")))
        good = good.unionByName(usd)
    unknown = mapped.where(F.col("instrument_id").isNull()).select(
        F.lit(None).cast("string").alias("instrument_id"), "field", "source", F.concat(F.lit("unknown identifier "), F.col("identifier")).alias("error_message"))
    missing = mapped.where(F.col("instrument_id").isNotNull() & bad_value).select(
        "instrument_id", "field", "source", F.lit("missing or NaN value").alias("error_message"))
    absent = requested.join(batch.select(F.col("identifier").alias("ticker")).distinct(), "ticker", "left_anti").distinct()
    silent = absent.join(mapping.withColumnRenamed("identifier", "ticker"), "ticker", "left").select(
        "instrument_id", "field", F.lit(source).alias("source"), F.lit("no data returned").alias("error_message"))
    return good, unknown.unionByName(missing).unionByName(silent)


def _midnight(day):
    return dt.datetime.combine(day, dt.time()) if isinstance(day, dt.date) and not isinstance(day, dt.datetime) else day


def ingest_batch(observations: DataFrame, updates: DataFrame, failures: DataFrame, identifiers: DataFrame,
                 batch: DataFrame, requested: DataFrame, as_of, transform: str = "normal", source: str = "YAHOO") -> dict[str, DataFrame]:
    """The next ``observations``, ``updates`` and ``ingest_failures`` after one pull (see :func:`ingest_rows`)."""
    good, failed = ingest_rows(identifiers, batch, requested, transform, source)
    return {"observations": upsert_observations(observations, good, "seq"), "updates": touch_updates(updates, good, as_of),
            "ingest_failures": append_failures(failures, failed, _midnight(as_of))}


def pull_window(vendor: DataFrame, requested: DataFrame, as_of: dt.date, window_days: int = 30):
    """Landed rows of the scheduled tickers in the pull window, by asset class and field set.

    ``requested``: ticker, asset_class, field_set.  Yields (asset class is currency, fields,
    rows, tickers and their scheduled fields).  The window ends before ``as_of`` and starts
    ``window_days`` earlier, one day more where ``totret`` needs a first row.  There are as
    many groups as asset classes times field sets, a few.
    """
    groups = requested.select((F.col("asset_class") == "currency").alias("currency"), "field_set").distinct().collect()
    for g in sorted(groups, key=lambda r: (not r.currency, r.field_set)):
        fields = list(g.field_set)
        mine = requested.where(((F.col("asset_class") == "currency") == F.lit(g.currency))
                               & (F.array_join("field_set", ",") == F.lit(",".join(fields)))).select("ticker").distinct()
        start = as_of - dt.timedelta(days=window_days + ("totret" in fields))
        rows = vendor.where((F.col("date") >= F.lit(start)) & (F.col("date") < F.lit(as_of))).join(mine, "ticker", "left_semi")
        yield g.currency, fields, rows, mine.select("ticker", F.explode(F.array(*[F.lit(f) for f in fields])).alias("field"))


def daily_run(model, vendor: DataFrame, as_of: dt.date, root: str, window_days: int = 30,
              stale_days: int = 5) -> dict:
    """Plan -> pull landing -> ingest -> FX refresh -> USD refresh -> portfolios
    -> USD refresh -> stale report, every stored table published by commits.

    ``model`` provides the dimensions and, on a first run, the tables; later runs on
    the same ``root`` continue from its published tables.  ``vendor`` is the landed
    vendor rows (ticker, date, close, adj_close, stock_splits; ``seq`` if keys repeat).
    Each group of the schedule is pulled with its own fields and window; currencies are
    inverted into pipettes and bring USD rows.  Observations, and on later runs the USD
    series, are upserted: only the field-years that have new or other rows are written, so a
    second run of the same day writes none of them.  Portfolios are computed from the first changed close, ledger row or
    trading day on (``plans.refresh``), in full only where the stored state was not made from the stored series.  A job that writes the same parts meanwhile ends one
    of the two with :class:`~marketframe.sources.sinks.CommitConflict`.  Intermediate tables are deleted at the end, and
    data that only commits before the last ten name.  Returns the published DataFrames by name.
    """
    from marketframe.sources.sinks import expire, intermediates, read_table
    spark = vendor.sparkSession
    with intermediates(spark):
        _run_day(model, vendor, as_of, root, window_days, stale_days)
    expire(spark, root)
    return {n: read_table(spark, root, n) for n in ("observations", "updates", "units_ts", "time_series_usd", "stale_report", "ingest_failures")}


def _run_day(model, vendor: DataFrame, as_of: dt.date, root: str, window_days: int, stale_days: int) -> None:
    """The steps of :func:`daily_run`, each published by a commit."""
    from functools import reduce

    from marketframe.operators.canonical import canonical_obs
    from marketframe.plans import fx, usd
    from marketframe.plans.refresh import first_price_change, is_anchored, refresh_stored
    from marketframe.plans.schedule import stale_report, to_update
    from marketframe.sources.sinks import (commit, materialize, publish_snapshot, publish_tables, read_manifest, read_table,
                                           stage_append, stage_snapshot, stage_upsert)

    spark = vendor.sparkSession
    manifest = read_manifest(spark, root)
    known = manifest["tables"]
    if "observations" not in known:
        publish_tables({"observations": model.observations, "updates": model.updates,
                        "ingest_failures": spark.createDataFrame([], S.INGEST_FAILURES)}, root, {"observations": BY_FIELD_YEAR})

    plan = to_update(model.updates, model.identifiers, model.instruments, sources=model.sources)
    requested = materialize(plan.select("asset_class", "field_set", F.explode("tickers").alias("ticker")), "requested")
    pulled = []
    for currency, fields, rows, asked in pull_window(vendor, requested, as_of, window_days):
        pulled.append(ingest_rows(model.identifiers, vendor_to_observations(rows, fields), asked, "currency" if currency else "normal"))
    if pulled:
        good = materialize(reduce(DataFrame.unionByName, [g for g, _ in pulled]), "pulled")
        failed = reduce(DataFrame.unionByName, [f for _, f in pulled])
        stamped = append_failures(spark.createDataFrame([], S.INGEST_FAILURES), failed, _midnight(as_of))
        touched = touch_updates(read_table(spark, root, "updates"), good, as_of)
        # the three ingest outputs switch together
        commit(spark, root, [stage_upsert(good, root, "observations", S.OBS_KEY, BY_FIELD_YEAR, "seq"),
                             stage_snapshot(touched, root, "updates", version=read_manifest(spark, root)["tables"]["updates"]["version"]), stage_append(stamped, root, "ingest_failures")])
        changed_since = good.select(F.min("date")).first()[0]
    else:
        changed_since = None
    obs = read_table(spark, root, "observations")

    # FX and USD: from the re-pulled window on where views exist and reach back before it, else in full
    first_day = read_table(spark, root, "units_ts").select(F.min("date")).first()[0] if "units_ts" in known else None
    if first_day is not None and changed_since is not None and changed_since > first_day:
        recent = obs.where(F.col("date") >= F.lit(changed_since))
        uts, start = fx.units_ts_incremental(read_table(spark, root, "units_ts"),
                                             canonical_obs(fx.fx_observations(recent, model.units), model.sources), model.units, changed_since)
        uts = materialize(uts, "units_ts_refresh")
        start = uts.select(start).first()[0]
        fresh = materialize(usd.time_series_usd(canonical_obs(obs.where(F.col("date") >= F.lit(start)), model.sources), model.instruments, model.fields,
                                                model.instrument_units, model.units, uts.where(F.col("date") >= F.lit(start))), "usd_refresh")
        anchored, prices_since = is_anchored(manifest), first_price_change(fresh, read_table(spark, root, "time_series_usd"))
        commit(spark, root, [stage_snapshot(uts, root, "units_ts"), stage_upsert(fresh, root, "time_series_usd", S.CANONICAL_KEY, BY_FIELD_YEAR)])
    else:
        uts = materialize(fx.units_ts(canonical_obs(fx.fx_observations(obs, model.units), model.sources), model.units), "units_ts_refresh")
        full = usd.time_series_usd(canonical_obs(obs, model.sources), model.instruments, model.fields, model.instrument_units, model.units, uts)
        publish_tables({"units_ts": uts, "time_series_usd": full}, root, {"time_series_usd": BY_FIELD_YEAR})
        anchored, prices_since = False, None
    refresh_stored(model, root, read_table(spark, root, "units_ts"), prices_since, anchored)
    report = stale_report(read_table(spark, root, "updates"), model.instruments, as_of - dt.timedelta(days=stale_days), as_of)
    publish_snapshot(report, root, "stale_report")
