"""Air-quality expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from galemark import fixed_values as fv
from galemark.functions import bands


def _per_pollutant(pollutant: Column, branches: dict[str, Column]) -> Column:
    chain = F
    for name, branch in branches.items():
        chain = chain.when(pollutant == name, branch)
    return chain


def aqi_category(pollutant: Column, value: Column) -> Column:
    """Air class by pollutant; a known pollutant without a value falls in the worst class."""
    *lower, worst = fv.AIR_CLASSES
    branches = {
        name: bands.up_to(value, zip(bounds, lower), worst)
        for name, bounds in fv.AIR_BOUNDS.items()
    }
    return _per_pollutant(pollutant, branches).otherwise(F.lit(fv.NOT_CLASSIFIED))


def pollution_spike(value: Column) -> Column:
    """Whether the value exceeds the spike limit, whatever its unit; null is no spike."""
    return F.coalesce(value > fv.SPIKE_ABOVE, F.lit(False))


def health_risk_level(category: Column) -> Column:
    """0 (Good) to 4 (Very Unhealthy); -1 where not classified."""
    classes = F.array(*(F.lit(c) for c in fv.AIR_CLASSES))
    return F.coalesce(F.array_position(classes, category).cast("int"), F.lit(0)) - 1


def aqi_score(pollutant: Column, value: Column) -> Column:
    """Index from 0, linear inside each class (our definition, after the public EPA formula).

    The index rises linearly from the previous class's top index to this class's; in the last
    class the slope goes on.  Negative values count as 0, unknown pollutants and missing values give null.
    """
    clipped = F.greatest(value, F.lit(0.0))
    branches = {}
    for name, bounds in fv.AIR_BOUNDS.items():
        tops = [float(b) for b in (*bounds, fv.INDEX_TOPS[name])]
        chain = F
        low, base = 0.0, 0.0
        for top, index in zip(tops, fv.INDEX_STEPS):
            linear = F.lit(base) + (clipped - low) * (index - base) / (top - low)
            chain = chain.when(clipped <= top, linear)
            low, base = top, float(index)
        branches[name] = F.when(value.isNotNull(), chain.otherwise(linear))
    return _per_pollutant(pollutant, branches)
