"""Line dedup by distinct-site spread: HyperLogLog sketches per line, exact counts near the threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from galemark.llm.common import column, free_name, save, table, text_key

#: A line on so many distinct sites is boilerplate.
MIN_SITES = 10
#: Relative standard deviation asked of a sketch, and how many of them are "near" the threshold.
SKETCH_ERROR, NEAR = 0.14, 5


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(h1, h2, doc_id, key, line_no): the lines on min_sites sites or more, with their first occurrence.

    `lines` has the columns of `_lines`.  Sketches merge in partial aggregates, so a line that is
    everywhere is one row per task.  A sketch decides where it is clearly above the threshold; the
    other lines' sites are counted exactly, as sites that share registers make a sketch too low.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "key", "line_no")).alias("first")
    spread = save(
        lines.groupBy("h1", "h2")
        .agg(F.count("*").alias("times"), F.approx_count_distinct("site", SKETCH_ERROR).alias("sites"), first)
        .filter(F.col("times") >= min_sites),
        "spread",
    )
    margin = NEAR * SKETCH_ERROR
    # Too many sites for the sketch to be wrong: sure.  All others: counted.
    sure = spread.filter(F.col("sites") * (1 - margin) >= min_sites)
    near = spread.filter(F.col("sites") * (1 - margin) < min_sites)
    exact = (
        lines.select("h1", "h2", "site").join(near.select("h1", "h2"), ["h1", "h2"])
        .distinct().groupBy("h1", "h2").agg(F.count("site").alias("exact")).filter(F.col("exact") >= min_sites)
    )
    columns = ["h1", "h2", "first.doc_id", "first.key", "first.line_no"]
    return sure.select(*columns).union(near.join(exact, ["h1", "h2"]).select(*columns))


def _lines(docs: DataFrame) -> DataFrame:
    """The lines of all texts, trimmed, without empty ones: as two hashes, with site and place."""
    text = F.coalesce(F.col("text"), F.lit(""))
    each = docs.select("doc_id", "key", "site", F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    each = each.withColumn("line", F.regexp_replace("line", r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", ""))
    return each.filter("line <> ''").select(
        F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(8), "line").alias("h2"), "site", "doc_id", "key", "line_no"
    )


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, site: str = "source") -> DataFrame:
    """docs with boilerplate lines taken out of `text`, and a column `__removed`: how many went.

    A line counts without the white space at its ends; empty lines are left alone.  A line on
    min_sites or more distinct sites goes everywhere but at its first occurrence (smallest doc_id,
    rows without one last; then first line), so that no content is lost whole.  A null site is no
    site; a null or empty text stays as it is.  Rows that share doc_id and text are alike: if one
    has the first occurrence, so has the other.  All other columns stay as they are.
    """
    text = column(docs, "text", "string")
    doc, key, gone = (free_name(docs, name) for name in ("doc", "key", "gone"))
    inner = docs.select(
        column(docs, "doc_id", "long").alias("doc_id"), text_key(text).alias("key"),
        column(docs, site, "string").alias("site"), text.alias("text"),
    )
    lines = _lines(inner)
    spread = save(boilerplate(lines, min_sites), "boilerplate")
    found = (
        lines.join(
            spread.select("h1", "h2", F.col("doc_id").alias("d"), F.col("key").alias("k"), F.col("line_no").alias("l")),
            ["h1", "h2"],
        )
        .filter(~(F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")) & (F.col("line_no") == F.col("l"))))
        .groupBy(F.col("doc_id").alias(doc), F.col("key").alias(key))
        .agg(F.collect_set("line_no").alias(gone))
    )
    joined = docs.join(found, column(docs, "doc_id", "long").eqNullSafe(found[doc]) & (text_key(text) == found[key]), "left")
    kept = F.array_join(
        F.filter(F.split(text, "\n"), lambda line, no: ~F.array_contains(found[gone], no)), "\n"
    )
    cleaned = F.when(found[gone].isNull(), text).otherwise(kept)
    removed = F.when(found[gone].isNull(), F.lit(0)).otherwise(F.size(found[gone])).cast("long")
    return joined.select(
        *(cleaned.alias(c) if c == "text" else docs[c] for c in docs.columns), removed.alias("__removed")
    )


def without_boilerplate(docs: DataFrame, **options) -> DataFrame:
    """`remove_boilerplate` as a filter: columns as they are, documents left without any text dropped.

    A document that had no text before stays.
    """
    cleaned = remove_boilerplate(docs, **options)
    emptied = (F.col("__removed") > 0) & F.coalesce(F.col("text").rlike(r"^[\x20\x09-\x0D]*$"), F.lit(True))
    return cleaned.filter(~emptied).drop("__removed")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_removed, n_chars_kept, and the SHA-256 of the text that is left."""
    docs = table(spark, sf_dir, "documents")
    cleaned = remove_boilerplate(docs)
    text = F.coalesce(F.col("text"), F.lit(""))
    return cleaned.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("__removed").alias("n_removed"),
        F.length(text).cast("long").alias("n_chars_kept"), F.sha2(F.encode(text, "UTF-8"), 256).alias("kept_sha256"),
    )


OP8_SQL = f"""
WITH lines AS (
  SELECT doc_id, source, line_no, line AS raw, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line
  FROM (
    SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(0, len(string_split(coalesce(text, ''), chr(10))))) AS line_no
    FROM documents
  )
), spread AS (
  SELECT line, min(doc_id) AS first_doc FROM lines WHERE line <> ''
  GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}
), marked AS (
  SELECT l.*, s.line IS NOT NULL AND NOT (
    l.doc_id = s.first_doc
    AND l.line_no = min(l.line_no) OVER (PARTITION BY l.doc_id, l.line)) AS gone
  FROM lines l LEFT JOIN spread s ON l.line = s.line
), kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(raw, chr(10) ORDER BY line_no) FILTER (NOT gone), '') AS text
  FROM marked GROUP BY doc_id
)
SELECT doc_id, n_removed, length(text) AS n_chars_kept, sha256(text) AS kept_sha256 FROM kept
"""
