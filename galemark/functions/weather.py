"""Weather expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from galemark import fixed_values as fv
from galemark.functions import bands


def feels_like(temperature: Column, wind: Column) -> Column:
    """T - 0.55 (1 - 0.16 wind)(T - 14.1); null where either is null."""
    # The four constants.
    return temperature - (F.lit(0.55) * (1 - F.lit(0.16) * wind)) * (temperature - 14.1)


def wind_category(wind: Column) -> Column:
    """Wind class; a missing wind speed falls in the last class."""
    return bands.below(wind, fv.WIND_BANDS, fv.WIND_ABOVE)


def weather_anomaly(temperature: Column, precipitation: Column, wind: Column) -> Column:
    """First anomaly that applies, else Normal; a missing value triggers none."""
    windy = wind >= fv.HIGH_WIND
    wet = precipitation > fv.HEAVY_PRECIPITATION
    extreme = ~temperature.between(fv.COLD, fv.HOT)
    return F.coalesce(
        F.when(windy, fv.ANOMALY_WIND),
        F.when(wet, fv.ANOMALY_PRECIPITATION),
        F.when(extreme, fv.ANOMALY_TEMPERATURE),
        F.lit(fv.NORMAL),
    )
