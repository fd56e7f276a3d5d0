"""Initial load from staging: W9 seed_from_staging with R2/R3 unpivots, C21/C22 helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.operators.relational import unpivot_stack


def unpivot_lateral_values(equities: DataFrame) -> DataFrame:
    """R2: three attributes per equity as rows, nulls kept (``stack``)."""
    return unpivot_stack(equities, ["instrument_id"],
                         [("gics_code", "gics_code"), ("country_hq", "country_hq"), ("exchange", "exchange")],
                         "field", "value")


def unpivot_identifiers(wide: DataFrame) -> DataFrame:
    """Wide identifier columns to (instrument_id, source, ext_id); nulls dropped,
    the integer broker id cast to text."""
    return unpivot_stack(wide, ["instrument_id"],
                         [("ISIN", "isin"), ("LSEG", "ric"), ("YAHOO", "yfinance_ticker"), ("ETORO", "etoro_iid")],
                         "source", "ext_id", dropna=True)


def seed_from_staging(equities: DataFrame, observations: DataFrame) -> dict[str, DataFrame]:
    """Instruments, identifiers, attributes and observations from the staging
    rows.  Observations are mapped to instrument ids by two source-specific
    joins (LSEG by RIC, YAHOO by Yahoo ticker); null values and other sources
    are not loaded."""
    instruments = equities.select("instrument_id", "name", F.lit("equity").alias("asset_class"),
                                  F.col("currency").alias("unit"))
    identifiers = unpivot_identifiers(equities)
    attributes = unpivot_lateral_values(equities)
    obs = observations.where(F.col("value").isNotNull())
    by_ric = (obs.where(F.col("source") == "LSEG")
              .join(equities.select(F.col("ric").alias("identifier"), "instrument_id"), "identifier"))
    by_yahoo = (obs.where(F.col("source") == "YAHOO")
                .join(equities.select(F.col("yfinance_ticker").alias("identifier"), "instrument_id"), "identifier"))
    cols = ["instrument_id", "field", "date", "source", "value", "scale"]
    return {"instruments": instruments, "identifiers": identifiers, "attributes": attributes,
            "observations": by_ric.select(*cols).unionByName(by_yahoo.select(*cols))}
