"""Post, sentiment and classifier expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from galemark import fixed_values as fv


def engagement_score(upvotes: Column) -> Column:
    """Weighted upvotes; null where unknown."""
    return upvotes * F.lit(fv.UPVOTE_WEIGHT)


def _grown(logits: Column) -> Column:
    """exp(z - max) of every logit.

    The maximum is paired with the elements; inside the lambda it would be found anew for each.
    """
    peak = F.array_repeat(F.array_max(logits), F.size(logits))
    return F.zip_with(logits, peak, lambda z, p: F.exp(z.cast("double") - p.cast("double")))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def softmax(logits: Column) -> Column:
    """Class probabilities of an array of logits."""
    grown = _grown(logits)
    total = F.array_repeat(_total(grown), F.size(logits))
    return F.zip_with(grown, total, lambda e, t: e / t)


def winning_probability(logits: Column) -> Column:
    """The largest class probability."""
    return F.lit(1.0) / _total(_grown(logits))


def winning_class(logits: Column, labels: Sequence[str]) -> Column:
    """Label of the largest logit; the first one wins a tie."""
    names = F.array(*(F.lit(label) for label in labels))
    place = F.array_position(logits, F.array_max(logits)).cast("int")
    return F.try_element_at(names, place)


def display_label(label: Column) -> Column:
    """Display text of a sentiment label; other labels are shown as they are."""
    pairs = [F.lit(x) for pair in fv.LABEL_TEXT.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.initcap(label)), label)
