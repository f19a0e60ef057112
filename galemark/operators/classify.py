"""Text classification: a user's model in batches, the decision in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from galemark.functions.social import winning_class, winning_probability
from galemark.functions.text import normalize_text
from galemark.operators.windows import agreed_per_key


def decide(scored: DataFrame, labels: Sequence[str], logits: str = "logits") -> DataFrame:
    """Add sentiment_label and sentiment_score (the winning probability) from class logits."""
    return scored.withColumns({
        "sentiment_label": winning_class(F.col(logits), labels),
        "sentiment_score": winning_probability(F.col(logits)),
    })


def score_text(
    df: DataFrame,
    text: str,
    load_model: Callable[[], Callable[[list[str]], Sequence[Sequence[float]]]],
    labels: Sequence[str],
) -> DataFrame:
    """Classify column `text` with a user's model.

    `load_model` runs once per task and returns a function from a list of texts to their logits;
    cutting the text to the model's length is the model's business.
    """
    schema = StructType([*df.schema.fields, StructField("logits", ArrayType(DoubleType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for batch in batches:
            if model is None:
                model = load_model()
            texts = batch[text].fillna("").tolist()
            logits = [list(map(float, row)) for row in model(texts)] if texts else []
            yield batch.assign(logits=logits)

    return decide(df.mapInPandas(run, schema), labels)


def training_set(
    posts: DataFrame, labels: DataFrame, key: str = "post_id", text: str = "text"
) -> DataFrame:
    """Labelled texts without repeats: of equal normalized texts the one with the smallest key.

    Keys whose labels contradict each other are left out.
    Texts are grouped by digest and length, and each map task keeps one row per text, so a text with
    many copies costs no more than the others.
    """
    rest = [c for c in labels.columns if c != key]
    found = posts.select(key, F.col(text).alias("text")).join(agreed_per_key(labels, key), key)
    labelled = found.withColumn("text", normalize_text(F.col("text")))
    kept = labelled.groupBy(
        F.sha2("text", 256).alias("digest"), F.length("text").alias("size")
    ).agg(F.min_by(F.struct(key, "text", *rest), F.col(key)).alias("row"))
    return kept.select("row.*")
