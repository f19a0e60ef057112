"""Phrase collocations by Rabin-Karp fingerprints.

Prefix polynomials give the 64-bit fingerprint of every n-gram of a slice of texts by two look-ups.
Fingerprints are counted first, without texts: words, then pairs of frequent words, then longer
n-grams all of whose pairs are frequent, each behind a bitmap of fixed size.  A fingerprint's count is
at least that of each phrase that has it, so no frequent phrase is lost.  The last scan takes the
occurrences whose fingerprint is frequent, as are those of their parts, compares their words within the
slice, and only there makes phrases, with count and a pointer to an occurrence; counting those by text undoes
all collisions.  A task of that scan adds its phrases up before it writes them, and there is a task per core.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from galemark.llm import wordhash
from galemark.llm.common import bitmap, column, in_bitmap, save, ship, small_batches, table

#: Words of the longest phrase, occurrences of a frequent one, rows of the report per language.
LONGEST, MIN_COUNT, TOP = 5, 100, 2000
#: A phrase in a longer one goes if the longer has this share of its occurrences, in percent.
ABSORBED = 100
#: Bytes of text that are worked on at once, and that Spark sends to a Python worker at once.
SLICE, SENT = 1 << 20, 4 << 20
#: Fingerprints that a task holds to count them, and rows that it sends to Spark at once.
PRINTS, ROWS = 1 << 20, 1 << 16
#: Bytes of phrases that a task of the last scan holds to add them up.
HELD = 32 << 20
_PIECE = wordhash.byte_set([*b".,;:!?", *range(0x0A, 0x0E)])
_GAP = _PIECE | wordhash.byte_set([0x20, 0x09])


class Words:
    """The words of a batch (doc_id, lang, text): hashes that also say the language, pieces, places."""

    def __init__(self, batch: pa.RecordBatch):
        self.batch = batch
        self.data, self.starts, self.ends, hashes, first = wordhash.words_of(
            batch.column("text"), wordhash.LOWER, _GAP, between=0x0A
        )
        self.row = np.repeat(np.arange(batch.num_rows), np.diff(first))
        langs = pc.dictionary_encode(batch.column("lang"))
        self.langs = langs.dictionary
        self.lang = langs.indices.to_numpy()[self.row]
        salts = [int.from_bytes(blake2b(x.encode(), digest_size=8).digest(), "little") for x in self.langs.to_pylist()]
        self.hashes = wordhash.mix(hashes ^ np.array(salts, np.uint64)[self.lang])
        breaks = np.zeros(len(self.data) + 1, np.int32)
        np.cumsum(_PIECE[self.data], out=breaks[1:])
        # Words of one piece have equally many piece ends before them.
        self.piece = breaks[self.starts]

    def grams(self, size: int, frequent: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints and first words of the n-grams within pieces; if given, with frequent parts only.

        Parts are the words of a pair, the pairs of a longer n-gram.
        """
        if size == 1:
            return self.hashes, np.arange(len(self.hashes))
        prints = wordhash.runs(self.hashes, size)
        inside = self.piece[: len(prints)] == self.piece[size - 1 :]
        if frequent is not None and len(prints):
            width = min(size - 1, 2)
            parts = self.hashes if width == 1 else wordhash.runs(self.hashes, 2)
            known = in_bitmap(frequent, parts.view(np.int64))
            for i in range(size - width + 1):
                inside &= known[i : i + len(prints)]
        at = np.flatnonzero(inside)
        return prints[at], at


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        column(docs, "doc_id", "long").alias("doc_id"),
        F.coalesce(column(docs, "lang", "string"), F.lit("und")).alias("lang"),
        F.coalesce(column(docs, "text", "string"), F.lit("")).alias("text"),
    )


def _prints(batches, sizes: range, frequent: np.ndarray | None, most: int, held: int):
    """(print, n) of the n-grams of all batches, counted over `held` of them, `most` bytes of text at a time."""
    prints, n = [], 0
    for batch in batches:
        for part in wordhash.slices(batch, "text", most):
            found = Words(part)
            for size in sizes:
                prints.append(found.grams(size, frequent)[0])
                n += len(prints[-1])
            # Nothing of a part but its fingerprints is kept while the next is read.
            del part, found
            if n >= held:
                yield from _count(prints)
                n = 0
        del batch
    yield from _count(prints)


def _count(prints: list[np.ndarray]):
    """(print, n) of the fingerprints in a list, which is emptied."""
    if not prints:
        return
    every = np.concatenate(prints)
    prints.clear()
    every, n = np.unique(every, return_counts=True)
    for at in range(0, len(every), ROWS):
        some = slice(at, at + ROWS)
        yield pa.RecordBatch.from_arrays([pa.array(every[some].view(np.int64)), pa.array(n[some])], ["print", "n"])


def _counted(docs: DataFrame, sizes: range, frequent: np.ndarray | None, min_count: int) -> DataFrame:
    """Fingerprints of n-grams of some sizes that occur at least min_count times, with their counts."""
    spark = docs.sparkSession
    parts = spark.sparkContext.broadcast(frequent)
    most, held = SLICE, PRINTS

    def count(batches):
        yield from _prints(batches, sizes, parts.value, most, held)

    counts = docs.mapInArrow(count, "print long, n long").groupBy("print").agg(F.sum("n").alias("n"))
    with small_batches(spark, SENT):
        return save(counts.filter(F.col("n") >= min_count).select("print"), "fingerprints")


def _phrases(part: pa.RecordBatch, longest: int, frequent: np.ndarray):
    """(lang, phrase, n, doc_id) of the n-grams with a frequent fingerprint, and (lang, null, words).

    The two parts that lack the last or the first word occur no less often, so theirs are frequent too.
    """
    found = Words(part)
    # A null id is the pointer only where there is no other.
    nobody = np.iinfo(np.int64).max
    ids = part.column("doc_id").fill_null(nobody).to_numpy()
    # Equal words get equal numbers, told by their bytes; so do equal n-grams, word by word.
    low = found.data.copy()
    capital = (low >= 65) & (low <= 90)
    low[capital] += 32
    length = found.ends - found.starts
    offsets = np.zeros(len(length) + 1, np.int64)
    np.cumsum(length, out=offsets[1:])
    mark = np.zeros(len(low) + 1, np.int8)
    mark[found.starts] += 1
    mark[found.ends] -= 1
    body = low[np.cumsum(mark[:-1], dtype=np.int8).view(bool)]
    text = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(body)]
    ).dictionary_encode()
    word, vocabulary = text.indices.to_numpy().astype(np.int64), text.dictionary.cast(pa.large_string())
    total = np.bincount(found.lang, minlength=len(found.langs))
    yield pa.RecordBatch.from_arrays(
        [found.langs, pa.nulls(len(total), pa.string()), pa.array(total), pa.nulls(len(total), pa.int64())],
        ["lang", "phrase", "n", "doc_id"],
    )
    for size in range(1, longest + 1):
        prints, at = found.grams(size, None)
        known = in_bitmap(frequent, prints.view(np.int64))
        if size > 1:
            known &= begins[at] & begins[at + 1]
        at = at[known]
        if not len(at):
            break
        begins = np.zeros(len(word), bool)
        begins[at] = True
        same = found.lang[at].astype(np.int64)
        for i in range(size):
            _, same = np.unique(same * len(vocabulary) + word[at + i], return_inverse=True)
        order = np.argsort(same, kind="stable")
        first = np.flatnonzero(np.diff(same[order], prepend=-1))
        one = at[order[first]]
        pointer = np.minimum.reduceat(ids[found.row[at[order]]], first)
        words = [vocabulary.take(pa.array(word[one + i])) for i in range(size)]
        yield pa.RecordBatch.from_arrays(
            [
                found.langs.take(pa.array(found.lang[one])),
                (pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string())) if size > 1 else words[0])
                .cast(pa.string()),
                pa.array(np.diff(first, append=len(order))),
                pa.array(pointer, mask=pointer == nobody),
            ],
            ["lang", "phrase", "n", "doc_id"],
        )


def _added(parts: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    """Rows of `_phrases` with one row per language and phrase."""
    if not parts:
        return []
    sums = pa.Table.from_batches(parts).group_by(["lang", "phrase"], use_threads=False).aggregate([("n", "sum"), ("doc_id", "min")])
    sums = sums.select(["lang", "phrase", "n_sum", "doc_id_min"]).rename_columns(["lang", "phrase", "n", "doc_id"])
    parts.clear()
    pa.default_memory_pool().release_unused()
    return sums.to_batches(max_chunksize=ROWS)


def _written(batches, longest: int, frequent: np.ndarray):
    """`_phrases` of all batches, added up as far as HELD allows; what cannot be added up goes as it is."""
    parts, size = [], 0
    for batch in batches:
        for part in wordhash.slices(batch, "text", SLICE):
            for rows in _phrases(part, longest, frequent):
                parts.append(rows)
                size += rows.nbytes
            if size > HELD:
                parts = _added(parts)
                size = sum(rows.nbytes for rows in parts)
                if size > HELD // 4 * 3:
                    yield from parts
                    parts, size = [], 0
    yield from _added(parts)


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, phrase, n, doc_id): every phrase of 1 to `longest` words that occurs min_count times.

    A row without a phrase has the number of all words of the language.  doc_id is the smallest of a
    document that holds the phrase.  See `collocations` for words and pieces.
    """
    spark = ship(docs.sparkSession)
    docs = _texts(docs)
    words = _counted(docs, range(1, 2), None, min_count)
    found = [words]
    if longest > 1:
        found.append(_counted(docs, range(2, 3), bitmap(words, "print"), min_count))
    if longest > 2:
        found.append(_counted(docs, range(3, longest + 1), bitmap(found[1], "print"), min_count))
    prints = found[0]
    for more in found[1:]:
        prints = prints.union(more)
    frequent = spark.sparkContext.broadcast(bitmap(prints, "print"))

    def write(batches):
        yield from _written(batches, longest, frequent.value)

    # Each task writes a phrase at least once, so files and row groups do not make tasks of their own here.
    cores = spark.sparkContext.defaultParallelism
    written = docs.coalesce(cores).mapInArrow(write, "lang string, phrase string, n long, doc_id long")
    counts = written.groupBy("lang", "phrase").agg(F.sum("n").alias("n"), F.min("doc_id").alias("doc_id"))
    with small_batches(spark, SENT):
        return save(counts.filter(F.col("phrase").isNull() | (F.col("n") >= min_count)), "phrases")


def _whole(value: Column, digits: int) -> Column:
    return value.cast(f"decimal({digits},0)")


def collocations(
    docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, top: int = TOP, absorbed: int = ABSORBED,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, doc_id): phrases whose words belong together.

    Texts are lower-cased (A-Z), cut at `.,;:!?` and \\x0A-\\x0D into pieces and these at spaces and tabs
    into words; everything is counted per language, null being `und`.  Phrases of 2 words and more that
    occur min_count times score floor(1000 a n / (l r)): a, l and r are the occurrences of phrase, first
    part and rest at the cut that scores lowest (ties: the first), n all words of the language.  A
    phrase inside a longer one that has `absorbed` percent of its occurrences is left out.  The `top`
    highest scores per language are ranked, ties by a, then by the phrase's bytes.  doc_id points to a
    document with the phrase (the smallest id; null if only rows without one hold it).  Repeated rows count each; null and
    empty texts hold nothing, and an empty table gives no rows.
    """
    counts = frequent_phrases(docs, longest, min_count)
    totals = counts.filter("phrase IS NULL").select("lang", F.col("n").alias("all_words"))
    phrases = counts.filter("phrase IS NOT NULL").withColumn("words", F.split("phrase", " "))
    candidates = phrases.filter(F.size("words") > 1).select("lang", "phrase", "words", F.col("n").alias("a"), "doc_id")
    # A phrase in a longer one is in one that is longer by a word, and that occurs no less often.
    longer = candidates.filter(F.size("words") > 2)
    size = F.size("words") - 1
    inner = longer.select(
        "lang", F.explode(F.array(F.slice("words", F.lit(1), size), F.slice("words", F.lit(2), size))).alias("inner"),
        F.col("a").alias("longer"),
    ).groupBy("lang", F.array_join("inner", " ").alias("phrase")).agg(F.max("longer").alias("longer"))
    left_out = candidates.join(inner, ["lang", "phrase"]).filter(F.col("longer") * 100 >= F.col("a") * absorbed)
    left_out = left_out.select("lang", "phrase")
    part = phrases.select("lang", F.col("phrase").alias("part"), F.col("n").alias("times"))
    cuts = (
        candidates.join(left_out, ["lang", "phrase"], "left_anti")
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
        .withColumn("left", F.array_join(F.slice("words", F.lit(1), F.col("k")), " "))
        .withColumn("right", F.array_join(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")), " "))
        .drop("words")
        .join(part.toDF("lang", "left", "l"), ["lang", "left"]).join(part.toDF("lang", "right", "r"), ["lang", "right"])
        .join(totals.withColumnRenamed("all_words", "n"), "lang")
    )
    over = _whole(F.col("a") * 1000, 19) * _whole(F.col("n"), 18)
    score = F.call_function("div", over, _whole(F.col("l"), 18) * _whole(F.col("r"), 18))
    best = cuts.groupBy("lang", "phrase").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r", "a", "n", "doc_id")).alias("cut")
    ).select("lang", "phrase", "cut.*")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = best.withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "doc_id")


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def collocation_sql(min_count: int = MIN_COUNT, top: int = TOP) -> str:
    return rf"""
WITH p AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (SELECT doc_id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
), t AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM w GROUP BY lang
), i AS (SELECT doc_id, lang, w, unnest(range(1, len(w) + 1)) AS i FROM w
), g AS (SELECT doc_id, lang, w, i, unnest(range(1, {LONGEST} + 1)) AS size FROM i
), f AS (
  SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase, count(*)::HUGEINT AS a, min(doc_id) AS doc_id
  FROM g WHERE i + size - 1 <= len(w) GROUP BY ALL HAVING count(*) >= {min_count}
), c AS (
  SELECT lang, phrase, size, a, doc_id, unnest(range(1, size)) AS k, string_split(phrase, ' ') AS s FROM f WHERE size > 1
), e AS (
  SELECT c.lang, c.phrase, c.size, c.a, c.doc_id, k, x.a AS l, y.a AS r, n, 1000 * c.a * n // (x.a * y.a) AS score
  FROM c JOIN t USING (lang)
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(s[1 : k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(s[k + 1 : c.size], ' ')
), m AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), x AS (
  SELECT m.* FROM m WHERE NOT EXISTS (
    SELECT 1 FROM f WHERE f.lang = m.lang AND f.size > m.size AND 100 * f.a >= {ABSORBED} * m.a
      AND contains(' ' || f.phrase || ' ', ' ' || m.phrase || ' '))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score, doc_id
FROM x QUALIFY rank <= {top}
"""


OP13_SQL = collocation_sql()
