"""MinHash near-duplicates: bottom-k sketches, inverted lists, union-sketch filter, exact Jaccard.

1. Every text becomes its set of hashed word shingles; texts with equal sets are one class, named by
   its smallest doc_id.  Exact copies meet there, in a partial aggregate, and go no further.
2. The sketch of a class is the `k` smallest values of the one hash function.  Two sets of Jaccard
   similarity 0.8 or more share about 0.8 * k of their sketches' values, and at least half of them
   but for a chance below 1e-7 (sets of at most k shingles are their own sketch: no chance at all).
   So two such sketches must meet among the k / 2 + 1 values of each that fewest classes hold
   (whole small sets: among the last 20 %, and some more where a partner may have been cut to k
   values), and only those are posted to inverted lists.  Of these, a value that no other class of a
   fitting size holds is not posted either: nothing that it could meet can be linked.
3. A list compares its members with a few of them, its hubs, first.  A pair goes on if sizes allow
   the similarity and the union sketch estimates at least half; those sets are read again, whole,
   and compared exactly.  What is linked then needs no more comparison within its component.
4. Pairs without a hub, in lists that hold such members of different components, are compared in a
   second pass, so no link is lost: lists of one hub make a bucket, buckets are cut into blocks of bounded size, and a task
   compares two blocks by one matrix product.  It returns, by sketches, members that have a likely
   partner, then, with their whole sets, a forest of exact links: never a row per pair.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from galemark.llm import wordhash
from galemark.llm.common import bitmap, column, in_bitmap, save, ship, table
from galemark.llm.components import components

#: Values kept of each set.
K = 64
#: Members of an inverted list that all others are compared with first.
HUBS = 4
#: Members of a block of the second pass.
BLOCK = 1024
#: Bands of set sizes, a bit of a long each; the last one has all larger sizes.
BANDS = 62


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, lower: bool = True, k: int = K, hubs: int = HUBS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 * |A & B| >= percent * |A | B| for their sets of `words`-word
    shingles; a text of fewer words is one shingle, a text without words has none and is linked with
    nothing.  component_id is the smallest doc_id that links reach.  Rows that share a doc_id are one
    node, with the links of both; each gets its own row.  Rows without a doc_id are linked with
    nothing, have no component and stay.  An empty table gives no rows.  `lower` compares A-Z as a-z.
    """
    ship(docs.sparkSession)
    docs = docs.select(
        column(docs, id_column, "long").alias("doc_id"), column(docs, text_column, "string").alias("text")
    )
    sets = _sets(docs, words, lower, k)
    rows = save(sets.select("doc_id", "n", "s1", "s2", "sketch"), "sketches")
    classes = save(
        rows.filter("n > 0 AND doc_id IS NOT NULL")
        .groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("id"), F.first("sketch").alias("sketch")),
        "classes",
    )
    posts = save(_posts(classes, percent, k), "posts")
    lists = save(_lists(posts, hubs), "lists")
    listed = save(posts.join(lists, "value"), "listed")
    near = _hub_links(listed, classes, docs, words, lower, percent, k)
    found = save(components(near), "components")
    rest = _block_links(listed, found, classes, docs, words, lower, percent, k)
    found = save(components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(rest)), "components")
    return _answer(rows, classes, found)


def _sets(docs: DataFrame, words: int, lower: bool, k: int) -> DataFrame:
    def scan(batches):
        for batch in batches:
            for part in wordhash.slices(batch, "text"):
                n, s1, s2, sketch = [], [], [], []
                for values in shingle_sets(part.column("text"), words, lower):
                    n.append(len(values))
                    s1.append(int(values.sum(dtype=np.uint64)))
                    s2.append(int(wordhash.mix(values ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)))
                    sketch.append(values[:k].tobytes())
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(n, pa.int64()),
                    pa.array(np.array(s1, np.uint64).view(np.int64)),
                    pa.array(np.array(s2, np.uint64).view(np.int64)), pa.array(sketch, pa.binary()),
                ], ["doc_id", "n", "s1", "s2", "sketch"])

    return docs.mapInArrow(scan, "doc_id long, n long, s1 long, s2 long, sketch binary")


def shingle_sets(texts: pa.Array, words: int, lower: bool):
    """The sorted distinct shingle hashes of each text."""
    _, _, _, hashes, first = wordhash.words_of(texts, wordhash.LOWER if lower else wordhash.EXACT)
    shingles = wordhash.runs(hashes, words)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= words:
            yield np.unique(shingles[a : b - words + 1])
        else:
            yield wordhash.runs(hashes[a:b], int(b - a)) if b > a else np.zeros(0, np.uint64)


def _exploded(classes: DataFrame) -> DataFrame:
    def values(batches):
        for batch in batches:
            body = batch.column("sketch")
            size = np.array([len(x) // 8 for x in body.to_pylist()], np.int64)
            joined = b"".join(body.to_pylist())
            yield pa.RecordBatch.from_arrays([
                pa.array(np.frombuffer(joined, np.int64)),
                pa.array(np.repeat(batch.column("id").to_numpy(), size)),
                pa.array(np.repeat(batch.column("n").to_numpy(), size)),
            ], ["value", "id", "n"])

    return classes.select("id", "n", "sketch").mapInArrow(values, "value long, id long, n long")


def _posts(classes: DataFrame, percent: int, k: int) -> DataFrame:
    """(value, id, n): the inverted lists, of values that more than one class of a fitting size holds."""
    # Sizes that allow the similarity are in one band or in two next to each other.
    width = max(math.log(100 / percent), 0.05) * 1.0001
    band = F.least(F.floor(F.log("n") / width), F.lit(BANDS - 1)).cast("int")
    values = _exploded(classes).withColumn("band", F.call_function("shiftleft", F.lit(1).cast("long"), band))
    held = values.groupBy("value").agg(F.count("*").alias("held"), F.bit_or("band").alias("bands")).filter("held > 1")
    near = F.col("band").bitwiseOR(F.shiftleft("band", 1)).bitwiseOR(F.shiftright("band", 1))
    # Every holder has a band of its own, and none is next to this one's.
    alone = (F.bit_count("bands") == F.col("held")) & (F.col("bands").bitwiseAND(near) == F.col("band"))
    # Dealt by class before they are listed: the few values of a class in a task make no list worth a partial one.
    kept = values.join(held, "value").select("id", "n", "held", "value", alone.alias("alone")).repartition("id", "n")
    # The rarest values come first: those that no other class holds, which the join has dropped,
    # then by the number of holders.
    size = F.least(F.col("n"), F.lit(k))
    # A whole set shares ceil(p n) values with a partner that is whole too.  Of a partner that is cut to
    # k values, of at most floor(n / p), up to floor(n / p) - k of the shared ones are not in its sketch.
    shared = F.least(F.ceil(F.col("n") * percent / 100), F.col("n") + k - F.floor(F.col("n") * 100 / percent))
    need = F.when(F.col("n") <= k, F.col("n") - shared + 1).otherwise(F.lit(k // 2 + 1))
    ranked = (
        kept.groupBy("id", "n")
        .agg(F.sort_array(F.collect_list(F.struct("held", "value", "alone"))).alias("v"))
        .select("id", "n", F.slice("v", 1, F.greatest(need - (size - F.size("v")), F.lit(0)).cast("int")).alias("v"))
    )
    return ranked.select("id", "n", F.explode("v").alias("v")).filter("NOT v.alone").select("v.value", "id", "n")


def _hub_links(listed, classes, docs, words, lower, percent, k) -> DataFrame:
    """(a, b), a < b: links between the hubs of a list and its members."""
    sizes = 100 * F.least("l.n", "n") >= percent * F.greatest("l.n", "n")
    pairs = (
        listed.select("id", "n", F.explode("met").alias("l"))
        .filter((F.col("l.id") != F.col("id")) & sizes)
        .select(F.least("l.id", "id").alias("a"), F.greatest("l.id", "id").alias("b"))
        .distinct()
    )
    likely = save(_likely(pairs, classes, k), "likely")
    return save(_exact(likely, docs, words, lower, percent), "near")


def _block_links(listed, found, classes, docs, words, lower, percent, k) -> DataFrame:
    """(a, b): a forest of the links between different components of the first pass."""
    # Hubs have met all members of their lists, so only the other members are left to compare.
    others = listed.filter(~F.array_contains("met", F.struct("id", "n"))).select(
        "value", F.col("met")[0]["id"].alias("hub"), "id", "n"
    )
    member = save(
        others.join(found.withColumnRenamed("node", "id"), "id", "left")
        .select("value", "hub", "id", "n", F.coalesce("component", "id").alias("c")),
        "others",
    )
    several = member.groupBy("value").agg(F.min("c").alias("x"), F.max("c").alias("y")).filter("x <> y").select("value")
    bucket = save(member.join(several, "value").select("hub", "id", "n", "c").distinct(), "open")

    sketches = classes.select("id", F.col("sketch").alias("body"))
    likely = _blocks(bucket, sketches, percent, k, exact=False).select("hub", F.col("a").alias("id")).distinct()
    likely = save(bucket.join(likely, ["hub", "id"]), "active")
    sets = _whole_sets(likely.select("id").distinct(), docs, words, lower)
    return save(_blocks(likely, sets, percent, k, exact=True).select("a", "b").distinct(), "rest")


def _blocks(rows: DataFrame, bodies: DataFrame, percent: int, k: int, exact: bool) -> DataFrame:
    """(hub, a, b) from buckets (hub, id, n, c) and bodies (id, body), compared block by block.

    Bodies are sketches, or sets if `exact`.  Of sets, (a, b) are links that join components; of
    sketches, a is a member that may have a partner in another component.
    """
    blocks = rows.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    # Blocks are numbered before the bodies come in, so these are dealt out once only.
    dealt = (
        rows.join(blocks, "hub").withColumn("own", own).join(bodies, "id")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    )
    key = ["hub", "i", "j"]
    sorted_rows = dealt.select(*key, "own", "id", "n", "c", "body").repartition(*key).sortWithinPartitions(*key, "own", "id")

    def compare(batches):
        held = None
        for batch in batches:
            now = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch]).combine_chunks()
            h, i, j = (now.column(c).to_numpy() for c in key)
            change = np.flatnonzero((h[1:] != h[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            edges = np.r_[0, change]
            held = now.slice(edges[-1]) if len(h) else None  # the last group may go on
            yield from grouped(now, edges)
        if held is not None and held.num_rows:
            yield from grouped(held, np.array([0, held.num_rows]))

    def grouped(now, edges):
        out = []
        own, ids, n, c, i, j, h = (now.column(x).to_numpy() for x in ("own", "id", "n", "c", "i", "j", "hub"))
        body = now.column("body")
        for start, end in zip(edges[:-1], edges[1:]):
            at = slice(start, end)
            if (c[at] == c[start]).all():
                continue
            part = body.slice(start, end - start)
            values = [np.frombuffer(x.as_buffer(), np.uint64) for x in part]
            left, right = np.flatnonzero(own[at] == i[start]), np.flatnonzero(own[at] == j[start])
            common = _common(values, left, right)
            x, y = n[at][left][:, None], n[at][right][None, :]
            if exact:
                good = 100 * common >= percent * (x + y - common)
            else:
                # Half of the union sketch, which has min(k, larger set) values at least.
                least = np.minimum(k, np.maximum(x, y)) / 2
                good = (common >= least) & (100 * np.minimum(x, y) >= percent * np.maximum(x, y))
            good &= c[at][left][:, None] != c[at][right][None, :]
            p, q = np.nonzero(good)
            if exact:
                out += [(h[start], ids[at][a], ids[at][b]) for a, b in _forest(left[p], right[q], c[at])]
            else:
                out += [(h[start], a, a) for a in np.unique(ids[at][np.r_[left[p], right[q]]])]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*out)], ["hub", "a", "b"])

    return sorted_rows.mapInArrow(compare, "hub long, a long, b long")


def _common(values: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of two lists of sets, by products of 0/1 matrices of bounded width."""
    size = np.array([len(v) for v in values])
    every, code, times = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(values)), size)
    shared = times > 1
    number = np.cumsum(shared) - 1
    row, code = row[shared[code]], number[code[shared[code]]]
    total = np.zeros((len(left), len(right)), np.int64)
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    for begin in range(0, int(shared.sum()), 4096):
        a, b = np.searchsorted(code, [begin, begin + 4096])
        matrix = np.zeros((len(values), 4096), np.float32)
        matrix[row[a:b], code[a:b] - begin] = 1
        matrix = matrix[:, : min(4096, int(shared.sum()) - begin)]
        total += (matrix[left] @ matrix[right].T).astype(np.int64)
    return total


def _forest(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> list[tuple[int, int]]:
    """Those of the links (a, b) that join two components c, one after another."""
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = root(int(c[x])), root(int(c[y]))
        if p != q:
            parent[p] = q
            out.append((x, y))
    return out


def _lists(posts: DataFrame, hubs: int) -> DataFrame:
    """(value, met) of each list of several members: up to `hubs` of them (id, n), by rising hash.

    They are the members of smallest hash in each of `hubs` parts of the list.  The same members win in
    all lists that they share, so pairs repeat instead of adding up.  A part is a partial minimum,
    however long the list is.
    """
    order = F.struct(F.xxhash64("id").alias("h"), "id", "n")
    part = F.pmod(F.shiftright(F.xxhash64("id"), 7), F.lit(hubs))
    best = [F.min(F.when(part == i, order)).alias(f"m{i}") for i in range(hubs)]
    several = posts.groupBy("value").agg(F.count("*").alias("members"), *best).filter("members > 1")
    met = F.sort_array(F.array_compact(F.array(*(f"m{i}" for i in range(hubs)))))
    return several.select("value", F.transform(met, lambda m: F.struct(m["id"].alias("id"), m["n"].alias("n"))).alias("met"))


def _likely(pairs: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """Pairs whose union sketch puts the similarity at a half or more."""
    # Rows of one id that stand for several classes join with each.
    sketch = classes.select("id", "sketch")
    both = (
        pairs.join(sketch.select(F.col("id").alias("a"), F.col("sketch").alias("x")), "a")
        .join(sketch.select(F.col("id").alias("b"), F.col("sketch").alias("y")), "b")
    )

    def estimate(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                every, times = np.unique(np.concatenate([u, v]), return_counts=True)
                if len(u) >= k or len(v) >= k:
                    every, times = every[:k], times[:k]
                good.append(2 * int((times == 2).sum()) >= len(every))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(estimate, "a long, b long").distinct()


def _whole_sets(ids: DataFrame, docs: DataFrame, words: int, lower: bool) -> DataFrame:
    """(id, body): the whole sets of the texts of some documents, read again."""
    # A bitmap of fixed size keeps most texts out; the join below is exact.
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(ids, "id"))

    def scan(batches):
        for batch in batches:
            batch = batch.filter(pa.array(in_bitmap(wanted.value, batch.column("doc_id").to_numpy())))
            for part in wordhash.slices(batch, "text"):
                body = [v.tobytes() for v in shingle_sets(part.column("text"), words, lower)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(body, pa.binary())], ["id", "body"])

    sets = docs.filter(F.col("doc_id").isNotNull()).mapInArrow(scan, "id long, body binary")
    sets = sets.join(ids, "id", "left_semi").groupBy("id", F.xxhash64("body").alias("h")).agg(F.first("body").alias("body"))
    return save(sets.select("id", "body"), "sets")


def _exact(pairs: DataFrame, docs: DataFrame, words: int, lower: bool, percent: int) -> DataFrame:
    """Pairs that reach the similarity, by the whole sets of both texts."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = _whole_sets(ids, docs, words, lower)
    both = (
        pairs.join(sets.select(F.col("id").alias("a"), F.col("body").alias("x")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("body").alias("y")), "b")
    )

    def compare(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                u, v = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both_n = len(np.intersect1d(u, v, assume_unique=True))
                good.append(100 * both_n >= percent * (len(u) + len(v) - both_n) > 0)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long").distinct()


def _answer(rows: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    # A class may hold ids of other classes (rows that share a doc_id): members point to the class's
    # id, and where such ids differ, the graph of ids and classes is closed once more.
    member = rows.filter("n > 0 AND doc_id IS NOT NULL").join(classes.select("s1", "s2", "n", "id"), ["s1", "s2", "n"])
    member = member.select("doc_id", "id").distinct()
    twice = member.groupBy("doc_id").agg(F.count("*").alias("k")).filter("k > 1").limit(1).count()
    if twice:
        found = save(
            components(
                member.select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
                .union(found.select("node", "component"))
            ),
            "components",
        )
        label = found.select(F.col("node").alias("doc_id"), "component")
    else:
        label = (
            member.join(found.withColumnRenamed("node", "id"), "id", "left")
            .select("doc_id", F.coalesce("component", "id").alias("component"))
        )
    out = rows.select("doc_id", F.col("n").alias("n_shingles")).join(label, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The documents without those that a document of smaller id in their component stands for.

    Five-word shingles, similarity 0.8.  Columns stay as they are.  Of rows that share doc_id and
    component all stay, as they are one node.
    """
    gone = near_duplicates(docs).filter("NOT kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == F.col("__gone"), "left_anti")


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=2)
