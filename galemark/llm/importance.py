"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

The raw models count hashed n-grams of all documents, the target models those of documents that
labels call good.  There are two families of n-grams: words without case and punctuation, and pairs
of neighbouring words' shapes (kinds of their first and last characters).  A document's log weight is
the sum over its grams of both families of the log ratio of their target to their raw frequency, each
smoothed by one occurrence.  Adding Gumbel noise and keeping the k largest draws k documents without
replacement by their weights.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from galemark.llm import wordhash
from galemark.llm.common import column, save, ship, table, text_key

#: Hash buckets of the word and of the shape model: their size in memory, whatever the corpus.
BUCKETS = (1 << 18, 1 << 14)
#: At most so many labelled good documents make the target models: those of smallest id hash.
TARGET_DOCUMENTS = 20_000
#: Gram weights are whole multiples of 1 / SCALE, so sums do not depend on their order.
SCALE = 1 << 20
#: Log weights are told apart by 1 / FINE of their size (of 1, near 0) when k is calibrated.
FINE = 64

_CLASS = np.array(
    [1 if b > 127 else 2 if chr(b).isdigit() else 3 if chr(b).isupper() else 4 if chr(b).islower() else 5 + b
     for b in range(256)], np.uint64,
)


def _grams(texts: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of both families: the buckets of all grams of a string column, and the row of each."""
    data, starts, ends, hashes, first = wordhash.words_of(texts, wordhash.BARE)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    last, before = data[ends - 1], data[np.maximum(ends - 2, starts)]
    shape = (_CLASS[data[starts]] << np.uint64(16)) | (_CLASS[before] << np.uint64(8)) | _CLASS[last]
    pairs = wordhash.runs(wordhash.mix(shape), 2)
    inside = row[1:] == row[:-1] if len(row) else np.zeros(0, bool)
    grams = [hashes, pairs[inside]]
    buckets = [(g % np.uint64(n)).astype(np.int64) for g, n in zip(grams, BUCKETS)]
    return buckets, [row, row[1:][inside]]


class Resampler:
    """A fitted model: gram weights, and the cut that selects k rows."""

    def __init__(self, weights: list[np.ndarray]):
        self.weights, self.cut = weights, -math.inf

    def scored(self, docs: DataFrame, keep: list[str]) -> DataFrame:
        """`keep` columns of docs, the log weight of a row, null for a text without words, and its draw.

        The Gumbel noise in the draw is a hash of id and text, so another run draws alike.
        """
        weights = ship(docs.sparkSession).sparkContext.broadcast(self.weights)

        def score(batches):
            for batch in batches:
                for part in wordhash.slices(batch, "text"):
                    total = np.zeros(part.num_rows, np.int64)
                    families = list(zip(*_grams(part.column("text")), weights.value))
                    for grams, row, weight in families:
                        np.add.at(total, row, weight[grams])
                    none = np.bincount(families[0][1], minlength=part.num_rows) == 0
                    yield pa.RecordBatch.from_arrays(
                        [part.column(c) for c in [*keep, "noise"]] + [pa.array(total / SCALE, mask=none)],
                        [*keep, "noise", "log_weight"],
                    )

        share = F.shiftrightunsigned(F.xxhash64("doc_id", text_key(F.col("text"))), 12)
        source = docs.withColumn("noise", -F.log(-F.log((share + F.lit(0.5)) / F.lit(2.0**52))))
        kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
        rows = source.select(*dict.fromkeys([*keep, "text", "noise"])).mapInArrow(
            score, f"{kinds}, noise double, log_weight double"
        )
        return rows.select(*keep, "log_weight", (F.col("log_weight") + F.col("noise")).alias("draw"))


def fit(
    docs: DataFrame, labels: DataFrame, target_documents: int = TARGET_DOCUMENTS,
) -> tuple[Resampler, DataFrame, DataFrame]:
    """The model of docs (doc_id, text), the scores of all rows, and the held-out labels (doc_id, good).

    A document is good if all its labels have quality 1 and toxic 0, bad if one has not; labels with
    nulls say nothing.  Without a good labelled document every weight is 0.
    """
    ship(docs.sparkSession)
    known = (
        labels.select(
            column(labels, "doc_id", "long").alias("doc_id"), column(labels, "quality", "int").alias("quality"),
            column(labels, "toxic", "int").alias("toxic"),
        )
        .dropna()
        .groupBy("doc_id").agg(F.min(((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")).alias("good"))
    )
    # Half of the labels make the models, the rest calibrates them; which half is a hash of the id.
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    chosen = known.filter((F.col("good") == 1) & half).orderBy(F.xxhash64("doc_id"), "doc_id").limit(target_documents)
    chosen = save(chosen.select(F.col("doc_id").alias("target_id"), F.lit(1).alias("target")), "target")
    # At most target_documents ids: safe to send to every task.
    marked = docs.join(F.broadcast(chosen), docs["doc_id"] == F.col("target_id"), "left").select(
        "text", F.coalesce("target", F.lit(0)).alias("target")
    )
    model = Resampler(_weights(marked))
    scores = save(model.scored(docs.select("doc_id", "text"), ["doc_id"]), "scores")
    return model, scores, known.filter(~half)


def _weights(marked: DataFrame) -> list[np.ndarray]:
    """Gram weights of both families from texts marked as target (1) or not (0)."""

    def count(batches):
        counts = [np.zeros((2, n), np.int64) for n in BUCKETS]
        for batch in batches:
            for part in wordhash.slices(batch, "text"):
                target = part.column("target").to_numpy() == 1
                for all_counts, grams, row in zip(counts, *_grams(part.column("text"))):
                    all_counts[0] += np.bincount(grams, minlength=all_counts.shape[1])
                    all_counts[1] += np.bincount(grams[target[row]], minlength=all_counts.shape[1])
        for family, (raw, wanted) in enumerate(counts):
            used = np.flatnonzero(raw)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(used), family)), pa.array(used), pa.array(raw[used]), pa.array(wanted[used]),
            ], ["family", "bucket", "raw", "target"])

    counted = (
        marked.mapInArrow(count, "family long, bucket long, raw long, target long")
        .groupBy("family", "bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    )
    raw, target = [np.zeros(n) for n in BUCKETS], [np.zeros(n) for n in BUCKETS]
    for f, b, r, t in counted.toLocalIterator():  # sum(BUCKETS) rows at most
        raw[f][b], target[f][b] = r, t
    weights = []
    for r, t in zip(raw, target):
        if not t.sum():
            weights.append(np.zeros(len(r), np.int64))
            continue
        weights.append(np.round(np.log((t + 1) / (r / r.sum() * t.sum() + 1)) * SCALE).astype(np.int64))
    return weights


def calibrated_size(scores: DataFrame, held: DataFrame) -> int:
    """k: how many rows weigh at least as much as the cut that best parts good labels from bad ones.

    Only held-out labels count.  The cut gets most of them right; ties take the smallest cut.  Without
    good or without bad ones every row that has words is wanted.
    """
    w = F.col("log_weight")
    # Bins as wide as their weights are large: a few thousand, however long the texts.
    place = F.floor(F.signum(w) * F.log1p(F.abs(w)) * FINE)
    bins = (
        scores.join(held, "doc_id").dropna(subset=["log_weight"])
        .groupBy(place.alias("bin"))
        .agg(F.min(w).alias("low"), F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"))
        .orderBy("bin").collect()
    )
    good, bad = sum(b.good for b in bins), sum(b.bad for b in bins)
    cut, best, below_good, below_bad = -math.inf, 0, 0, 0
    if good and bad:
        for b in bins:
            gain = below_bad - below_good
            if gain > best:
                cut, best = b.low, gain
            below_good, below_bad = below_good + b.good, below_bad + b.bad
    return scores.filter(w >= F.lit(cut)).count()


def kth_largest(scores: DataFrame, k: int) -> float:
    """The k-th largest draw, found by counting by ever finer ranges; nothing is sorted or gathered."""
    if k < 1:
        return math.inf
    low, high, n = scores.agg(F.min("draw"), F.max("draw"), F.count("draw")).first()
    if n <= k:
        return -math.inf
    above = 0
    while True:
        width = (high - low) / 4096
        if width <= 0 or low + width == low:
            return high
        place = F.least(F.floor((F.col("draw") - low) / width), F.lit(4095))
        inside = scores.filter(F.col("draw").between(low, high))
        rows = inside.groupBy(place.alias("p")).agg(F.count("*").alias("n"), F.min("draw").alias("a"), F.max("draw").alias("b"))
        for p in sorted(rows.collect(), key=lambda r: -r.p):  # 4096 rows at most
            if above + p.n >= k:
                low, high = p.a, p.b
                break
            above += p.n
        if p.n == 1 or low == high:
            return low


def resample(
    docs: DataFrame, labels: DataFrame, k: int | None = None, target_documents: int = TARGET_DOCUMENTS,
) -> tuple[Resampler, DataFrame]:
    """The model with its cut, and one row per selected input row: doc_id, log_weight, draw.

    k rows are drawn, by default as many as `calibrated_size` finds good; rows that tie with the
    k-th draw (repeats of one row) are all kept.  A row without words is never drawn.  An empty
    table gives no rows.
    """
    docs = docs.select(
        column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text")
    )
    model, scores, held = fit(docs, labels, target_documents)
    k = calibrated_size(scores, held) if k is None else k
    model.cut = kth_largest(scores, k)
    return model, scores.filter(F.col("draw") >= F.lit(model.cut))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that `resample` selects, with their columns as they are."""
    model, _ = resample(docs, labels, **options)
    # Scored again in one pass instead of moving every text through a join; the score of a row
    # is a sum of whole numbers and so the same again.
    packed = docs.select(
        column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text"),
        F.struct(*(docs[c] for c in docs.columns)).alias("row"),
    )
    kept = model.scored(packed, ["row"]).filter(F.col("draw") >= F.lit(model.cut))
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))[1]
