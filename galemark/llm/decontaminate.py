"""Benchmark decontamination: size-partitioned MinHash containment search, exact verification.

An item's shingles are few and a document's many, so their Jaccard similarity says little; what
counts is containment, the share of the item's shingles that the document holds.  Items are
partitioned by size, by powers of two, and each partition has its own sketch size: one more value
than the items of that partition may miss.  A document that holds enough of an item therefore holds
one of its smallest hash values at least: the search over whole documents loses nothing, and exact
counting of all shingles decides.  Built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from galemark.llm.common import column, free_name, save, table, text_key, words

#: Words of a shingle, and the share of an item's shingles that makes a document contaminated.
WORDS, CONTAINED = 5, 0.8


def word_runs(text: Column, sizes: list[int]) -> Column:
    """Hashes of all runs of some numbers of lower-case words of a text, with repeats."""
    # The array of word hashes is bound to a lambda variable, so that it is made once per text.
    def runs(h: Column, n: int) -> Column:
        run = lambda i: F.xxhash64(*(h[i + j] for j in range(n)))
        return F.when(F.size(h) >= n, F.transform(F.sequence(F.lit(0), F.size(h) - n), run)).otherwise(
            F.array().cast("array<bigint>")
        )

    hashes = F.transform(words(F.lower(text)), lambda w: F.xxhash64(w))
    return F.flatten(F.transform(F.array(hashes), lambda h: F.concat(*(runs(h, n) for n in sizes))))


def _item_sets(items: DataFrame, n: int) -> tuple[DataFrame, list[int]]:
    """(item, item_id, shingle) of all items, and the numbers of words that their shingles have."""
    text = column(items, "text", "string")
    rows = items.select(column(items, "item_id", "long").alias("item_id"), text.alias("text")).withColumns({
        # A null id is an id of its own, and texts under one id are items of their own.
        "item": F.xxhash64(F.col("item_id").isNull(), "item_id", text_key(F.col("text"))),
        "size": F.least(F.size(words(F.col("text"))), F.lit(n)),
    }).filter("size > 0")
    rows = save(rows, "item-texts")
    sizes = sorted({n} | {r["size"] for r in rows.select("size").distinct().collect()})  # n rows at most
    by_size = F.coalesce(*(F.when(F.col("size") == k, word_runs(F.col("text"), [k])) for k in sizes))
    return save(rows.select("item", "item_id", F.explode(by_size).alias("shingle")).distinct(), "items"), sizes


def contaminated(
    docs: DataFrame, items: DataFrame, n: int = WORDS, contained: float = CONTAINED,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(doc_id, key, item_id, n_item, n_shared, containment) for every item that a document contains.

    Shingles are n lower-case words; an item's are distinct.  An item of fewer words is one shingle of
    all of them, which a document holds if these words follow one another in it.  Every text is an item
    of its own, also under a null id or one that other texts have; the same text under the same id is
    one item.  Null items and those without words are found nowhere.  Rows that repeat a document (same
    id and text) give its finding once.  Empty tables give no rows.
    """
    text = column(docs, text_column, "string")
    docs = docs.select(
        column(docs, id_column, "long").alias("doc_id"), text_key(text).alias("key"), text.alias("text")
    )
    sets, lengths = _item_sets(items, n)
    sizes = sets.groupBy("item", "item_id").agg(F.count("*").alias("n_item"))
    # Of items with up to 2 ** p shingles a document may miss (1 - contained) of those.
    most = F.pow(F.lit(2.0), F.ceil(F.log2("n_item")))
    values = F.floor(most * (1 - contained) + 1e-9).cast("int") + 1
    sketch = save(
        sets.groupBy("item").agg(F.sort_array(F.collect_list("shingle")).alias("all"))
        .join(sizes.drop("item_id"), "item")
        .select("item", F.explode(F.slice("all", F.lit(1), values)).alias("shingle")),
        "item-sketches",
    )
    runs = word_runs(F.col("text"), lengths)
    found = save(
        docs.select("doc_id", "key", F.explode(runs).alias("shingle"))
        .join(sketch, "shingle").select("doc_id", "key", "item").distinct(),
        "candidates",
    )
    wanted = found.select(F.col("doc_id").alias("d"), F.col("key").alias("k")).distinct()
    again = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left_semi")
    held = (
        again.select("doc_id", "key", F.explode(F.array_distinct(runs)).alias("shingle"))
        .join(sets.select("item", "shingle"), "shingle").distinct()
    )
    shared = held.groupBy("doc_id", "key", "item").agg(F.count("*").alias("n_shared"))
    return (
        shared.join(sizes, "item")
        .filter(F.col("n_shared") >= F.col("n_item") * contained - 1e-9)
        .select("doc_id", "key", "item_id", "n_item", "n_shared", (F.col("n_shared") / F.col("n_item")).alias("containment"))
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that contain no item, with their columns as they are."""
    doc, key = free_name(docs, "doc"), free_name(docs, "key")
    found = contaminated(docs, items, **options).select(F.col("doc_id").alias(doc), F.col("key").alias(key))
    found = save(found.distinct(), "contaminated")
    same = column(docs, "doc_id", "long").eqNullSafe(found[doc]) & (text_key(column(docs, "text", "string")) == found[key])
    return docs.join(found, same, "left_anti")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("key")


def _sql_words(source: str, columns: str) -> str:
    return f"""SELECT DISTINCT {columns}, list_filter(regexp_split_to_array(lower(text), '[\\x20\\x09-\\x0D]+'),
              lambda x: x <> '') AS w FROM {source} WHERE text IS NOT NULL"""


OP10_SQL = f"""
WITH d0 AS ({_sql_words("documents", "doc_id, text")}
), b0 AS (SELECT *, row_number() OVER () AS item, least(len(w), {WORDS}) AS size FROM (
          {_sql_words("benchmark", "item_id, text")}) WHERE len(w) > 0
), b AS (
  SELECT DISTINCT item, item_id, size, array_to_string(w[i : i + size - 1], ' ') AS shingle
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM b0)
), d AS (
  SELECT DISTINCT doc_id, size, array_to_string(w[i : i + size - 1], ' ') AS shingle
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d0, (SELECT DISTINCT size FROM b0))
), n AS (SELECT item, item_id, count(*) AS n_item FROM b GROUP BY ALL
), s AS (SELECT doc_id, item, count(*) AS n_shared FROM d JOIN b USING (size, shingle) GROUP BY ALL)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
FROM s JOIN n USING (item) WHERE n_shared >= n_item * {CONTAINED}
"""
