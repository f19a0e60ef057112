"""Class labels from ordered bounds."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def below(value: Column, bands: Iterable[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first bound that `value` is below; null and larger values get `otherwise`."""
    return _first(((value < bound, label) for bound, label in bands), otherwise)


def up_to(value: Column, bands: Iterable[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first bound that `value` does not exceed; null counts as exceeding all."""
    return _first(((value <= bound, label) for bound, label in bands), otherwise)


def at_least(value: Column, bands: Iterable[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first bound (from high to low) that `value` reaches; null stays null."""
    reached = _first(((value >= bound, label) for bound, label in bands), otherwise)
    return F.when(value.isNotNull(), reached)


def _first(cases: Iterable[tuple[Column, str]], otherwise: str) -> Column:
    chain = F
    for test, label in cases:
        chain = chain.when(test, F.lit(label))
    return chain.otherwise(F.lit(otherwise))
