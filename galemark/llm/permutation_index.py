"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order, nearest first, and posted to the inverted files
of these only, with the pivot's place.  A query reads the files of its own nearest pivots and ranks the
vectors by footrule distance, in which a pivot that a vector has not posted stands at the place after
the last; the best share of each shard is ranked again by the true measure.  With a, b = m - place of
a pivot (0 where not posted), the footrule is the sum of |a - b| = a + b - 2 min(a, b), and the sums of a
and of b are the same for all: so adding up min(a, b) over the postings read ranks by footrule.

The nearest by inner product need not have a like order of pivots where vectors differ in length.  So
indexed vectors and pivots get one more component that makes them all as long as the longest, which
queries have as 0: inner products of queries stay what they are, and among vectors of one length the
largest is the nearest.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from galemark.llm.common import column, save, ship, table

#: Pivots; those of them that a vector is posted to and a query reads; vectors of a shard, and queries
#: that visit it at once.
PIVOTS, POSTED, SHARD = 512, 48, 8192
#: Of n vectors, RERANK * n ** 0.75 are ranked by the true measure, dealt over the shards by size.
RERANK = 1.5


def usable(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, v): vectors of doubles without nulls, non-finite components or only zeros.

    Of several lengths only the most frequent takes part (of those the longest).  Rows without an id
    take no part; equal rows count once.
    """
    v = column(vectors, vector_column, "array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & (x > -math.inf) & (x < math.inf))
    rows = vectors.select(column(vectors, id_column, "long").alias("vec_id"), v.alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0))
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    length = lengths.n if lengths else 0
    return rows.filter(F.size("v") == length).dropDuplicates(["vec_id", "v"])


def choose_pivots(rows: DataFrame, n: int) -> np.ndarray:
    """n different vectors of smallest hash: a bounded sample, which a hot vector cannot fill."""
    chosen = (
        rows.groupBy(F.xxhash64("v").alias("h")).agg(F.min_by("v", "vec_id").alias("v")).orderBy("h").limit(n).collect()
    )
    return np.array([r.v for r in chosen])


def nearest(
    vectors: DataFrame, every: int = 20, k: int = 20, pivots: int = PIVOTS, posted: int = POSTED,
    shard: int = SHARD, rerank: float = RERANK, id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: k nearest by inner product of every query's vector.

    Queries are the vectors whose id is divisible by `every`; rows of the query's own id are no
    candidates.  Ties go to the smaller vec_id.  Fewer candidates give fewer rows; without usable
    vectors there are none.  See `usable` for what takes part.
    """
    spark = ship(vectors.sparkSession)
    rows = save(usable(vectors, id_column, vector_column), "vectors")
    kind = "query_id long, rank int, vec_id long, score double"
    n = rows.count()
    if not n:
        return spark.createDataFrame([], kind)
    n_queries = rows.filter(F.col("vec_id") % every == 0).count()
    shards, blocks = max(1, -(-n // shard)), max(1, -(-n_queries // shard))
    longest = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0]
    chosen = choose_pivots(rows, pivots)

    def rest(values):
        """The component that makes vectors as long as the longest; scaled, so that no square overflows."""
        scale = math.sqrt(longest) if 0 < longest < math.inf else 1.0
        return scale * np.sqrt(np.maximum(longest / scale**2 - ((values / scale) ** 2).sum(axis=1), 0.0))

    pivot = spark.sparkContext.broadcast((chosen, rest(chosen)))
    share = min(1.0, rerank * n**0.75 / n)

    def permute(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, -1)
            # The nearest pivots in order; ties by pivot.
            near, longer = pivot.value
            product = values @ near.T
            orders = []
            for likeness in (product + rest(values)[:, None] * longer, product):
                order = np.argsort(-likeness, axis=1, kind="stable")[:, :posted].astype(np.int16)
                orders.append(pa.array([x.tobytes() for x in order], pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([x.tobytes() for x in values], pa.binary()), *orders],
                ["vec_id", "v", "near", "asked"],
            )

    index = save(rows.mapInArrow(permute, "vec_id long, v binary, near binary, asked binary"), "index")
    # Shards are visited by whole blocks of queries, so a vector is sent once per `shard` queries.
    files = index.drop("asked").withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards))).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    asked = (
        index.filter(F.col("vec_id") % every == 0).drop("near").withColumnRenamed("asked", "near")
        .withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit("query")), F.lit(blocks)).cast("int"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    )

    def search(posts: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(posts) and len(queries):
            posts = posts.sort_values("vec_id")
            ids = posts["vec_id"].to_numpy()
            values = np.frombuffer(b"".join(posts["v"]), np.float64).reshape(len(ids), -1)
            near = np.frombuffer(b"".join(posts["near"]), np.int16).reshape(len(ids), -1)
            last = near.shape[1]
            # The files one after another: by pivot, then by vector; `weight` is `last` less the place.
            by_pivot = np.argsort(near, axis=None, kind="stable")
            vector, weight = by_pivot // last, (last - by_pivot % last).astype(np.float64)
            begin = np.searchsorted(near.ravel()[by_pivot], np.arange(near.max() + 2))
            most = min(len(ids), max(4 * k, math.ceil(share * len(ids))))
            for query_id, v, own in zip(queries["vec_id"], queries["v"], queries["near"]):
                read = [(slice(begin[p], begin[p + 1]), last - i) for i, p in enumerate(np.frombuffer(own, np.int16)) if p + 1 < len(begin)]
                common = np.bincount(
                    np.concatenate([vector[at] for at, _ in read]) if read else np.zeros(0, np.int64),
                    np.concatenate([np.minimum(weight[at], w) for at, w in read]) if read else None, len(ids),
                ).astype(np.int64)
                # The lowest footrule, then the smallest id; ids are in order.
                key = (-common << 32) | np.arange(len(ids))
                key[ids == query_id] = np.iinfo(np.int64).max
                best = np.argpartition(key, most - 1)[:most]
                best = best[ids[best] != query_id]
                score = values[best] @ np.frombuffer(v, np.float64)
                top = np.lexsort((ids[best], -score))[:k]
                out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[best][top], "score": score[top]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    found = (
        files.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block"))
        .applyInPandas(search, "query_id long, vec_id long, score double")
    )
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", place.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)


def op6_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
