"""Substring dedup by seed and extend.

Seeds are winnowed anchors: of the `seed`-word sequences inside a window of `window` words, the one
of smallest hash.  Equal windows have equal anchors at equal places, so a window can only be
repeated if its anchor is.  A run is the stretch of windows that share one anchor occurrence: the
anchor extended to both sides as far as it stays the anchor.  Runs that agree as a whole match in
all their windows; runs that differ are compared window by window, that is, by how far the match
extends to the left and right of the anchor.  Occurrences are counted, never paired, so a passage
that is everywhere costs a row per occurrence.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from galemark.llm import wordhash
from galemark.llm.common import bitmap, column, in_bitmap, save, ship, table, text_key

WINDOW = 35
SEED = 12


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, seed: int = SEED, texts: bool = False,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256 (and kept_text with `texts`).

    Every word goes that is covered by a window of `window` words whose word sequence starts at any
    other place too, in the same document or another.  Words are compared as they are.  Texts
    shorter than a window, empty and null ones lose nothing; a row that stands twice is removed
    twice, as its windows repeat.  An empty table gives no rows.  A window is compared by two 64-bit
    hashes, its own and its anchor's.
    """
    if not 0 < seed <= window or window - seed > 62:
        raise ValueError("seed must be from 1 to window, and window - seed at most 62")
    ship(docs.sparkSession)
    text = column(docs, text_column, "string")
    docs = docs.select(
        column(docs, id_column, "long").alias("doc_id"), text_key(text).alias("key"), text.alias("text")
    )
    marks = _marks(_repeated_runs(docs, window, seed))
    return _without(docs, marks, window, texts)


def _runs_of(texts: pa.Array, window: int, seed: int):
    """Runs of a string column: row, first window, number of windows, anchor; and all window hashes."""
    _, _, _, hashes, first = wordhash.words_of(texts)
    seeds, whole = wordhash.runs(hashes, seed), wordhash.runs(hashes, window)
    if not len(whole):
        none = np.zeros(0, np.int64)
        return none, none, none, none, whole, first
    # Smallest hash of each window with its leftmost place, compared by 32 bits, then by place.
    least = (seeds & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(seeds), dtype=np.uint64)
    span = reach = window - seed + 1
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if reach > width:
        least = np.minimum(least[: len(least) - (reach - width)], least[reach - width :])
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # A window belongs to the row in which it starts, if it ends there too.
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    inside = np.flatnonzero(np.arange(len(whole)) + window <= first[1:][row[: len(whole)]])
    if not len(inside):
        none = np.zeros(0, np.int64)
        return none, none, none, none, whole, first
    at = place[inside]
    new = np.r_[True, (at[1:] != at[:-1]) | (row[inside][1:] != row[inside][:-1])]
    begin = inside[new]
    size = np.diff(np.r_[np.flatnonzero(new), len(inside)])
    return row[begin], begin, size, seeds[at[new]].view(np.int64), whole, first


def _repeated_runs(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """Runs whose anchor may occur more than once, with the hashes of their windows."""

    def anchors(batches):
        for batch in batches:
            for part in wordhash.slices(batch, "text"):
                anchor = _runs_of(part.column("text"), window, seed)[3]
                found, times = np.unique(anchor, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(times)], ["anchor", "times"])

    counted = docs.select("text").mapInArrow(anchors, "anchor long, times long").groupBy("anchor")
    repeated = counted.agg(F.sum("times").alias("times")).filter("times > 1")
    # A bitmap of fixed size keeps most other runs out of the shuffles; what it lets through
    # in error finds no match.
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(repeated, "anchor"))

    def runs(batches):
        for batch in batches:
            for part in wordhash.slices(batch, "text"):
                row, begin, size, anchor, whole, first = _runs_of(part.column("text"), window, seed)
                good = in_bitmap(wanted.value, anchor)
                row, begin, size, anchor = row[good], begin[good], size[good], anchor[good]
                whole = whole.view(np.int64)
                offsets = np.r_[0, np.cumsum(size)].astype(np.int32)
                inner = np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], size)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(row)), part.column("key").take(pa.array(row)),
                    pa.array(begin - first[row]), pa.array(anchor),
                    pa.array(whole[begin]), pa.array(whole[begin + size - 1] if len(begin) else begin),
                    pa.array(size.astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(whole[inner])),
                ], ["doc_id", "key", "at", "anchor", "head", "tail", "size", "windows"])

    return save(
        docs.mapInArrow(
            runs, "doc_id long, key long, at long, anchor long, head long, tail long, size int, windows array<long>"
        ),
        "runs",
    )


#: What tells a run's words: its anchor, its first and last window, and the number of windows.
RUN = ["anchor", "head", "tail", "size"]


def _marks(runs: DataFrame) -> DataFrame:
    """(doc_id, key, marks): marks are the starts of repeated windows, as an offset and a bit mask."""
    kinds = save(runs.groupBy(*RUN).agg(F.count("*").alias("times"), F.first("windows").alias("windows")), "kinds")
    full = F.expr("shiftleft(1L, size) - 1")
    whole = kinds.filter("times > 1").select(*RUN, full.alias("mask"))
    # Runs that occur once may share some of their windows with other runs of the same anchor.
    several = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("anchor")
    each = save(
        kinds.join(several, "anchor").select(*RUN, "times", F.posexplode("windows").alias("offset", "hash")), "each"
    )
    counted = each.groupBy("anchor", "hash").agg(F.sum("times").alias("all")).filter("all > 1")
    partly = (
        each.filter("times = 1").join(counted, ["anchor", "hash"])
        .groupBy(*RUN).agg(F.sum(F.expr("shiftleft(1L, offset)")).alias("mask"))
    )
    marked = whole.union(partly)
    return (
        runs.select("doc_id", "key", "at", *RUN).join(marked, RUN)
        .groupBy("doc_id", "key").agg(F.collect_list(F.struct("at", "mask")).alias("marks"))
    )


def _without(docs: DataFrame, marks: DataFrame, window: int, texts: bool) -> DataFrame:
    marks = marks.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "marks")
    rows = docs.join(marks, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left")

    def clean(batches):
        for batch in batches:
            for part in wordhash.slices(batch, "text"):
                out = []
                for text, found in zip(part.column("text"), part.column("marks")):
                    body = text.as_buffer().to_pybytes() if text.is_valid else b""
                    every = body.split()
                    gone = 0
                    if found.is_valid:
                        values = found.values.flatten()
                        keep = _kept(len(every), values[0].to_numpy(), values[1].to_numpy(), window)
                        gone = len(every) - int(keep.sum())
                    kept = b" ".join(compress(every, keep.tolist()) if gone else every)
                    out.append((len(every), gone, hashlib.sha256(kept).hexdigest(), kept.decode() if texts else None))
                n, gone, digest, kept = zip(*out)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                    pa.array(digest, pa.string()), *([pa.array(kept, pa.string())] if texts else []),
                ], names)

    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * texts
    kind = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * texts
    return rows.select("doc_id", "text", "marks").mapInArrow(clean, kind)


def _kept(n: int, at: np.ndarray, mask: np.ndarray, window: int) -> np.ndarray:
    """Which of n words no marked window covers."""
    bits = (mask[:, None] >> np.arange(63)) & 1 == 1
    starts = (at[:, None] + np.arange(63))[bits]
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return np.cumsum(change[:-1]) == 0


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
