"""N1 canonical_obs: one value per (instrument, field, date) by source priority."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketframe.schemas import CANONICAL_KEY

NULL_PRIORITY = 2 ** 31 - 1   # NULLS LAST


def source_rank(sources: DataFrame) -> DataFrame:
    """One long per source ordering by (priority nulls last, name).

    Names only need ranking among sources of equal priority, so the window is
    partitioned by priority (no single-partition exchange).
    """
    prio = F.coalesce(F.col("priority"), F.lit(NULL_PRIORITY)).cast("long")
    name_rank = F.dense_rank().over(Window.partitionBy(prio).orderBy("name")).cast("long")
    return sources.select(F.col("name").alias("source"), (prio * F.lit(1 << 32) + name_rank).alias("rank"))


def canonical_obs(observations: DataFrame, sources: DataFrame) -> DataFrame:
    """Keep, per key, the row whose source has the lowest priority number.

    Observations with a source missing from ``sources`` are dropped (inner join).
    Equal priorities are broken by source name.  ``min_by(value, rank)`` with
    a single long rank runs as a hash aggregate with map-side combining: no
    sort of the observations, one shuffle on the key.  The ranks, a row per source,
    are broadcast: shuffled by source, all observations would meet in as many tasks
    as there are sources.
    """
    ranks = F.broadcast(source_rank(sources))
    return (observations.join(ranks, "source")
            .groupBy(*CANONICAL_KEY)
            .agg(F.min_by("value", "rank").alias("value")))
