"""Best-fit packing under conflicts: bins in order of residual, with source and cluster bitmaps."""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from galemark.llm.common import column, n_words, save, ship, table, text_key, words

#: Words that a bin holds, and about how many pieces are packed together in one group.
CAPACITY, GROUP = 4096, 2048


def pack(
    pieces: list[tuple[int, int, int]], capacity: int,
) -> list[tuple[int, int]]:
    """(bin, place) of each piece (size, source, cluster), placed in the given order.

    A piece goes to the tightest bin that holds neither its source nor its cluster; -1 as a source
    or cluster conflicts with nothing.  Bins are ordered by what is left in them; the search starts
    at the first that fits and goes on to its successor until one is compatible.  Full bins leave
    the order.
    """
    order: list[tuple[int, int]] = []  # (left, bin)
    sources: list[int] = []  # bitmaps
    clusters: list[int] = []
    count: list[int] = []
    out = []
    for size, source, cluster in pieces:
        source_bit = 1 << source if source >= 0 else 0
        cluster_bit = 1 << cluster if cluster >= 0 else 0
        at = bisect_left(order, (size, -1))
        while at < len(order) and (sources[order[at][1]] & source_bit or clusters[order[at][1]] & cluster_bit):
            at += 1
        if at < len(order):
            left, chosen = order.pop(at)
        else:
            left, chosen = capacity, len(count)
            sources.append(0)
            clusters.append(0)
            count.append(0)
        sources[chosen] |= source_bit
        clusters[chosen] |= cluster_bit
        out.append((chosen, count[chosen]))
        count[chosen] += 1
        if left > size:
            insort(order, (left - size, chosen))
    return out


def best_fit(
    docs: DataFrame, capacity: int = CAPACITY, group: int = GROUP, cluster: Column | None = None,
    id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
) -> DataFrame:
    """One row per piece of a document: bin (string), place in it, doc_id, piece, n_words, source.

    A document longer than a bin is cut into pieces of `capacity` words, of which full ones fill a
    bin each; nothing is left out, and a document without words is one piece of size 0.  No bin
    holds two documents of one source or of one duplicate cluster; by default a cluster is equal
    lower-case words.  A null source conflicts with nothing.  Pieces are dealt by hash to groups of
    about `group`, packed each in one task, longest first, ties by doc_id and piece (nulls first);
    a source or cluster of any size spreads evenly over the groups.  Repeated rows are packed each,
    in different bins.  An empty table gives no rows.
    """
    ship(docs.sparkSession)
    text = column(docs, text_column, "string")
    normal = F.array_join(words(F.lower(text)), " ") if cluster is None else cluster.cast("string")
    rows = save(
        docs.select(
            column(docs, id_column, "long").alias("doc_id"), column(docs, source_column, "string").alias("source"),
            n_words(text).alias("total"), F.xxhash64(normal).alias("cluster"), text_key(text).alias("key"),
        ),
        "sizes",
    )
    # A full piece fills a bin alone; only what is left over is packed.
    full = F.floor(F.col("total") / capacity)
    rest = F.col("total") - full * capacity
    each = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(full - F.when(rest == 0, 1).otherwise(0), F.lit(0)))).alias("piece"))
    size = F.least(F.col("total") - F.col("piece") * capacity, F.lit(capacity))
    each = each.withColumn("n_words", size)
    # Repeated rows have equal pieces: a running number tells their bins apart.
    copy = F.row_number().over(Window.partitionBy("doc_id", "key", "piece").orderBy("source", "cluster"))
    name = F.concat_ws("-", F.lit("full"), F.hex(F.xxhash64("doc_id", "key", "piece")), copy.cast("string"))
    alone = each.filter(F.col("n_words") == capacity).select(
        name.alias("bin"), F.lit(0).cast("long").alias("place"),
        "doc_id", "piece", "n_words", "source",
    )
    left = each.filter(F.col("n_words") < capacity)
    groups = max(1, -(-rows.count() // group))
    left = left.withColumn("group", F.pmod(F.xxhash64("doc_id", "key", F.lit("pack")), F.lit(groups)))

    def packed(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["n_words", "doc_id", "key", "piece"], ascending=[False, True, True, True], na_position="first")
        source = pd.factorize(frame["source"])[0]  # null: -1
        clusters = pd.factorize(frame["cluster"])[0]
        found = pack(list(zip(frame["n_words"].tolist(), source.tolist(), clusters.tolist())), capacity)
        number = frame["group"].iloc[0]
        return frame.assign(
            bin=[f"{number}-{b}" for b, _ in found], place=[p for _, p in found],
        )[["bin", "place", "doc_id", "piece", "n_words", "source"]]

    kind = "bin string, place long, doc_id long, piece long, n_words long, source string"
    return left.groupBy("group").applyInPandas(packed, kind).union(alone)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit(table(spark, sf_dir, "documents"))
