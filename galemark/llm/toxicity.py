"""Toxicity by a factorization machine over hashed terms.

A text is the set of its hashed terms: words without case, and the beginnings of words, which inflected
forms share.  A linear model adds up what each term says; a factorization machine also weighs each pair
of terms by the inner product of two short learnt vectors, so that an insult can count for more next to
a mentioned group than alone.  Terms that labelled texts of one kind hold clearly more often than those
of the other make the model's features, up to a fixed number.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import FMClassifier
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from galemark.llm import wordhash
from galemark.llm.common import column, save, ship, table

#: Hash buckets of terms, and the bytes of the word beginnings that are terms too.
BUCKETS, BEGINNINGS = 1 << 20, (4, 5, 6)
#: At most so many labelled documents are learnt from (those of smallest id hash), and features kept.
TRAIN_DOCUMENTS, FEATURES = 30_000, 4096
#: A feature stands in so many learnt texts at least, and its shares in toxic and other texts differ by
#: so many standard deviations.
MIN_TEXTS, CLEAR = 5, 5.0
#: Length of the vectors of terms; rounds, step and shrinkage of their fit.
FACTORS, ROUNDS, STEP, SHRINK = 4, 200, 0.05, 1e-3
#: Parts that the learnt texts' terms are fitted in, however many files the tables have: every round of the
#: fit is a job over them (of one stage up to 5 parts), and TRAIN_DOCUMENTS bounds what they hold.
PARTS = 4
#: A score from which a text is called toxic.
CUT = 0.7
_GAP = wordhash.byte_set(b for b in range(128) if not chr(b).isalnum())


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all terms of a string column, and the row of each; repeats stay."""
    data, starts, ends, hashes, first = wordhash.words_of(texts, wordhash.LOWER, _GAP)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    buckets, rows = [hashes % np.uint64(BUCKETS)], [row]
    padded = np.append(data, np.zeros(max(BEGINNINGS), np.uint8))
    begun = np.zeros(len(starts), np.uint64)
    for i in range(max(BEGINNINGS)):
        begun = begun * np.uint64(0x9E3779B97F4A7C15) + wordhash.LOWER[padded[starts + i]]
        if i + 1 in BEGINNINGS:
            longer = np.flatnonzero(ends - starts > i + 1)
            buckets.append(wordhash.mix(begun[longer] + np.uint64(i + 1)) % np.uint64(BUCKETS))
            rows.append(row[longer])
    return np.concatenate(buckets).astype(np.int64), np.concatenate(rows)


def _distinct(bucket: np.ndarray, row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    held = np.unique(row * size + bucket)
    return held % size, held // size


def held_out(doc_id: Column) -> Column:
    """Whether labels of a document are kept from learning; those without an id have none."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


class FactorizationMachine:
    """place: the feature of each bucket, -1 for none; constant, weights and vectors of the features."""

    def __init__(self, place: np.ndarray, constant: float, weights: np.ndarray, vectors: np.ndarray):
        self.place, self.constant, self.weights, self.vectors = place, constant, weights, vectors

    def logits(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Of every row: what single terms give, with the constant, and what pairs of terms add."""
        bucket, row = terms(texts)
        feature = self.place[bucket].astype(np.int64)
        feature, row = _distinct(feature[feature >= 0], row[feature >= 0], max(len(self.weights), 1))
        single = np.full(len(texts), self.constant)
        pairs = np.zeros(len(texts))
        if len(feature):
            single += np.bincount(row, self.weights[feature], len(texts))
            for vector in self.vectors.T:
                # All pairs of a row: half of the squared sum less the squares.
                pairs += np.bincount(row, vector[feature], len(texts)) ** 2
                pairs -= np.bincount(row, vector[feature] ** 2, len(texts))
        return single, pairs / 2

    def scored(self, docs: DataFrame) -> DataFrame:
        """(doc_id, held_out, single, pairs, score) of docs (doc_id, held_out, text)."""
        model = ship(docs.sparkSession).sparkContext.broadcast(self)

        def score(batches):
            for batch in batches:
                for part in wordhash.slices(batch, "text"):
                    single, pairs = model.value.logits(part.column("text"))
                    with np.errstate(over="ignore"):
                        chance = 1 / (1 + np.exp(-(single + pairs)))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id"), part.column("held_out"), *map(pa.array, (single, pairs, chance))],
                        ["doc_id", "held_out", "single", "pairs", "score"],
                    )

        return docs.select("doc_id", "held_out", "text").mapInArrow(
            score, "doc_id long, held_out boolean, single double, pairs double, score double"
        )


def _learnt(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(text, toxic) of the labelled documents that may be learnt from, `most` ids at most."""
    known = (
        labels.select(column(labels, "doc_id", "long").alias("doc_id"), column(labels, "toxic", "int").alias("toxic"))
        .dropna().filter(~held_out(F.col("doc_id"))).groupBy("doc_id")
        .agg(F.min(F.col("toxic") == 1).alias("toxic"), F.max(F.col("toxic") == 1).alias("any"))
        .filter(F.col("toxic") == F.col("any"))
        .select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    )
    chosen = save(known.orderBy(F.xxhash64("id"), "id").limit(most), "labelled")
    # `most` ids and labels at most: safe to send to every task.
    return docs.join(F.broadcast(chosen), docs["doc_id"] == F.col("id")).select("text", "toxic")


def _choose(texts: DataFrame, features: int) -> tuple[np.ndarray, int, int]:
    """The buckets that tell toxic texts from others, most telling first, and how many texts are so and not."""

    def count(batches):
        counts, rows = np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for part in wordhash.slices(batch, "text"):
                toxic = part.column("toxic").to_numpy()
                rows += np.bincount(toxic, minlength=2)
                bucket, row = _distinct(*terms(part.column("text")), BUCKETS)
                for label in (0, 1):
                    counts[label] += np.bincount(bucket[toxic[row] == label], minlength=BUCKETS)
        used = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), *(pa.array(np.append(c[used], n)) for c, n in zip(counts, rows))],
            ["bucket", "other", "toxic"],
        )

    counted = save(
        texts.mapInArrow(count, "bucket long, other long, toxic long")
        .groupBy("bucket").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic")),
        "term-texts",
    )
    whole = counted.filter("bucket = -1").first()
    if whole is None or not whole.other or not whole.toxic:
        return np.zeros(0, np.int64), *((whole.other, whole.toxic) if whole else (0, 0))
    share = (F.col("other") + F.col("toxic")) / (whole.other + whole.toxic)
    spread = F.sqrt(share * (1 - share) * (1 / whole.other + 1 / whole.toxic))
    apart = F.abs(F.col("toxic") / whole.toxic - F.col("other") / whole.other) / spread
    found = (
        counted.filter((F.col("bucket") >= 0) & (F.col("other") + F.col("toxic") >= MIN_TEXTS) & (spread > 0))
        .withColumn("apart", apart).filter(F.col("apart") >= CLEAR).orderBy(F.desc("apart"), "bucket").limit(features)
    )
    return np.array([r.bucket for r in found.select("bucket").collect()], np.int64), whole.other, whole.toxic


def fit(
    docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCUMENTS, features: int = FEATURES, factors: int = FACTORS,
) -> FactorizationMachine:
    """The model of docs (doc_id, text) and the labels that may be learnt from.

    Labels of held-out ids, nulls and ids with different labels teach nothing.  Without labels of both
    kinds, or without a telling term, every text scores the share of toxic labels (0 without labels).
    """
    ship(docs.sparkSession)
    texts = _learnt(docs, labels, most)
    buckets, other, toxic = _choose(texts, features)
    place = np.full(BUCKETS, -1, np.int32)
    place[buckets] = np.arange(len(buckets))
    if not len(buckets):
        share = toxic / max(other + toxic, 1)
        constant = math.log(share / (1 - share)) if 0 < share < 1 else math.copysign(30.0, share - 0.5)
        return FactorizationMachine(place, constant, np.zeros(0), np.zeros((0, factors)))
    places, size = docs.sparkSession.sparkContext.broadcast(place), len(buckets)

    def sets(batches):
        for batch in batches:
            for part in wordhash.slices(batch, "text"):
                bucket, row = terms(part.column("text"))
                feature = places.value[bucket].astype(np.int64)
                feature, row = _distinct(feature[feature >= 0], row[feature >= 0], size)
                at = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("toxic").cast(pa.float64()), pa.ListArray.from_arrays(at, feature)],
                    ["label", "terms"],
                )

    vector = F.udf(lambda held: Vectors.sparse(size, held, [1.0] * len(held)), VectorUDT())
    examples = save(
        texts.mapInArrow(sets, "label double, terms array<long>").repartition(PARTS, "terms")
        .select("label", vector("terms").alias("features")),
        "examples",
    )
    machine = FMClassifier(
        factorSize=factors, maxIter=ROUNDS, stepSize=STEP, regParam=SHRINK, initStd=0.01, tol=1e-9, seed=11,
    ).fit(examples)
    return FactorizationMachine(
        place, machine.intercept, machine.linear.toArray(), machine.factors.toArray().reshape(size, factors)
    )


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted, single, pairs), one row per row of docs.

    score is the chance of label 1 that the factorization machine gives, from the text alone; single
    and pairs are the parts of its log odds that single terms, with the constant, and pairs of terms
    make up.  Null, empty and word-less texts hold no term and score by the constant.  Repeated rows
    score alike; an empty table gives no rows.
    """
    docs = docs.select(
        column(docs, "doc_id", "long").alias("doc_id"),
        F.coalesce(column(docs, "text", "string"), F.lit("")).alias("text"),
    ).withColumn("held_out", held_out(F.col("doc_id")))
    scored = fit(docs, labels, **options).scored(docs)
    return scored.select(
        "doc_id", "held_out", "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "single", "pairs"
    )


def op11_toxicity_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
