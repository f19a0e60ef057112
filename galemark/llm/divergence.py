"""Source divergence audit by chunk factorization.

Texts are cut at white space into chunks, and each task counts the chunks of its documents.  A chunk
that is common stands in very many documents, but is tokenized once: the distinct chunks of a slice of
text are taken apart into terms, and what is known of a chunk goes to its terms.  What is shuffled is
a row per distinct term and slice of text, never a row per word, and rows of one term are added up as they
come in order: only terms that enough documents hold are written, next to their counts.

How many documents hold a term cannot be added up from its chunks, as one document may hold several
of them.  But only whether there are enough matters: all documents of a chunk that stands in one or
two are known by their smallest and largest number, and a chunk of three settles its terms.  A document
is in one slice, so slices do add up.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from galemark.llm import wordhash
from galemark.llm.common import column, save, ship, table

#: A term is a run of ASCII letters and characters beyond ASCII; only A-Z are lower-cased.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Documents of a language that must hold a term, parts that shares are counted in, ranks of terms.
MIN_DOCUMENTS, UNIT, RANKS = 3, 1_000_000_000, 200
#: Bytes of text whose chunks are counted together, and the terms and sources of one block of pairs.
SLICE, TERM_BLOCK, SOURCE_BLOCK = 20 << 20, 8192, 256
_WORD = (~wordhash.byte_set([0x20, *range(0x09, 0x0E)])).astype(np.int8)
#: TERM by bytes: every byte of a character beyond ASCII is one from 0x80.
_LETTER = wordhash.byte_set([*UPPER.encode(), *LOWER.encode(), *range(0x80, 0x100)]).astype(np.int8)
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[list(UPPER.encode())] = list(LOWER.encode())


def _runs(texts: pa.Array, members: np.ndarray, lower: bool = False) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The runs of member bytes in a string column, told apart by their bytes, and the row of each."""
    data, offsets = wordhash.bytes_of(texts)
    inside = np.zeros(len(data) + 2, np.int8)
    np.take(members, data, out=inside[1:-1])
    body = data[inside[1:-1].view(bool)]
    if lower:
        body = _LOWERED[body]
    # A run begins where a byte of one follows a gap or a row's end, and ends likewise.
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before, here = inside[:-1].view(bool), inside[1:].view(bool)
    starts = np.flatnonzero(here & (~before | cut))
    ends = np.flatnonzero(before & (~here | cut))
    row = np.searchsorted(offsets, starts, "right") - 1
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=at[1:])
    runs = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(body))
    return runs.dictionary_encode(), row


def count_chunks(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(lang, chunk, docs, low, high, sources, counts) of a batch (number, lang, source, text).

    docs counts documents, low and high are the least and greatest number of these; counts are the
    chunk's occurrences in each of the sources.
    """
    lang, source = (pc.dictionary_encode(batch.column(c)) for c in ("lang", "source"))
    number = batch.column("number").to_numpy()
    # Documents of one language and source next to each other.
    order = np.lexsort((source.indices.to_numpy(), lang.indices.to_numpy()))
    number, lang_of, source_of = number[order], lang.indices.to_numpy()[order], source.indices.to_numpy()[order]
    chunks, row = _runs(batch.column("text").take(pa.array(order)), _WORD)
    rows = max(len(number), 1)
    held, n = np.unique(chunks.indices.to_numpy().astype(np.int64) * rows + row, return_counts=True)
    chunk, row = held // rows, held % rows
    new = np.ones(len(held), bool)
    new[1:] = (chunk[1:] != chunk[:-1]) | (lang_of[row[1:]] != lang_of[row[:-1]])
    at = np.flatnonzero(new)
    new[1:] |= source_of[row[1:]] != source_of[row[:-1]]
    per_source = np.flatnonzero(new)
    lists = np.append(np.searchsorted(per_source, at), len(per_source)).astype(np.int32)
    total = np.add.reduceat(n, per_source) if len(at) else n
    number = number[row]
    return pa.RecordBatch.from_arrays(
        [
            lang.dictionary.take(pa.array(lang_of[row[at]])), chunks.dictionary.take(pa.array(chunk[at])).cast(pa.string()),
            pa.array(np.diff(at, append=len(held))),
            *(pa.array(f.reduceat(number, at) if len(at) else number) for f in (np.minimum, np.maximum)),
            pa.ListArray.from_arrays(lists, source.dictionary.take(pa.array(source_of[row[per_source]]))),
            pa.ListArray.from_arrays(lists, total),
        ],
        ["lang", "chunk", "docs", "low", "high", "sources", "counts"],
    )


def _by_source(group: np.ndarray, source: pa.DictionaryArray, n: np.ndarray, groups: int) -> tuple[pa.Array, pa.Array]:
    """Of entries in any order, for each group 0 .. groups - 1 the lists of its sources and of their sums of n."""
    names = max(len(source.dictionary), 1)
    key = group * names + source.indices.to_numpy()
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    at = np.flatnonzero(np.diff(key, prepend=-1))
    lists = pa.array(np.searchsorted(key[at], np.arange(groups + 1) * names), pa.int32())
    sums = np.add.reduceat(n, at) if len(at) else n
    found = source.dictionary.take(pa.array(key[at] % names))
    return pa.ListArray.from_arrays(lists, found), pa.ListArray.from_arrays(lists, sums)


def _spread(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges first .. first + size - 1: the range of each place, and the places, one range after another."""
    of = np.repeat(np.arange(len(size)), size)
    return of, np.arange(len(of)) + (first - (np.cumsum(size) - size))[of]


def terms_of_chunks(counted: pa.RecordBatch) -> pa.RecordBatch:
    """(lang, term, docs, sources, counts) of the rows of `count_chunks`; each distinct chunk is taken apart once.

    docs counts the documents that hold a term, exactly up to two of them; of more it is a bound from 3 up.
    """
    lang, chunk = (pc.dictionary_encode(counted.column(c)) for c in ("lang", "chunk"))
    terms, of = _runs(chunk.dictionary, _LETTER, lower=True)
    per_chunk = np.searchsorted(of, np.arange(len(chunk.dictionary) + 1))
    code = chunk.indices.to_numpy()
    row, place = _spread(per_chunk[code], np.diff(per_chunk)[code])
    distinct = max(len(terms.dictionary), 1)
    key = lang.indices.to_numpy()[row] * np.int64(distinct) + terms.indices.to_numpy()[place]
    held, group = np.unique(key, return_inverse=True)
    docs = counted.column("docs").to_numpy()
    most = np.zeros(len(held), np.int64)
    np.maximum.at(most, group, docs[row])
    # All documents of terms whose chunks stand in one or two of them.
    few = most[group] < 3
    numbers, ends = np.unique(
        np.concatenate([counted.column(c).to_numpy()[row[few]] for c in ("low", "high")]), return_inverse=True
    )
    known = np.unique(np.tile(group[few], 2) * np.int64(max(len(numbers), 1)) + ends) // max(len(numbers), 1)
    docs = np.maximum(most, np.bincount(known, minlength=len(held)))
    lists = counted.column("sources")
    entry, at = _spread(lists.offsets.to_numpy()[row].astype(np.int64), lists.value_lengths().to_numpy()[row])
    sources = pc.dictionary_encode(lists.values).take(pa.array(at))
    found = _by_source(group[entry], sources, counted.column("counts").values.to_numpy()[at], len(held))
    return pa.RecordBatch.from_arrays(
        [lang.dictionary.take(pa.array(held // distinct)), terms.dictionary.take(pa.array(held % distinct)).cast(pa.string()),
         pa.array(docs), *found],
        ["lang", "term", "docs", "sources", "counts"],
    )


def _terms_of_slices(docs: DataFrame) -> DataFrame:
    """(lang, term, docs, sources, counts): a row per slice of text, language and term."""

    def joined(parts):
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    def count(batches):
        waiting, size = [], 0
        for batch in batches:
            for part in wordhash.slices(batch, "text", SLICE):
                if waiting and size + part.nbytes > SLICE:
                    yield terms_of_chunks(count_chunks(joined(waiting)))
                    waiting, size = [], 0
                waiting.append(part)
                size += part.nbytes
        if waiting:
            yield terms_of_chunks(count_chunks(joined(waiting)))

    kind = "lang string, term string, docs long, sources array<string>, counts array<long>"
    return docs.withColumn("number", F.monotonically_increasing_id()).mapInArrow(count, kind)


def merge_terms(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Rows (lang, term, docs, sources, counts), of which those of one term follow each other, as one row per term."""
    new = np.ones(rows.num_rows, bool)
    for name in ("lang", "term"):
        codes = pc.dictionary_encode(rows.column(name)).indices.to_numpy()
        new[1:] = codes[1:] != codes[:-1] if name == "lang" else new[1:] | (codes[1:] != codes[:-1])
    at = np.flatnonzero(new)
    group = (np.cumsum(new) - 1)[pc.list_parent_indices(rows.column("sources")).to_numpy()]
    sources = pc.dictionary_encode(rows.column("sources").flatten())
    found = _by_source(group, sources, rows.column("counts").flatten().to_numpy(), len(at))
    docs = np.add.reduceat(rows.column("docs").to_numpy(), at) if len(at) else rows.column("docs")
    first = pa.array(at)
    return pa.RecordBatch.from_arrays(
        [rows.column("lang").take(first), rows.column("term").take(first), pa.array(docs), *found], rows.schema.names
    )


def term_counts(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Of docs (lang, source, text): (lang, source, term, count, lang_count, first) of the kept terms.

    A term is kept in a language if at least min_documents (3 at most) rows of it hold the term.
    lang_count is the sum of count over the sources; first is 1 in one row of each lang and term, else 0.
    """
    if min_documents > 3:
        raise ValueError("the documents of a chunk are known one by one up to two of them")
    ship(docs.sparkSession)

    def kept(merged):
        merged = merged.filter(pc.greater_equal(merged.column("docs"), min_documents))
        of = pc.list_parent_indices(merged.column("counts"))
        first = np.diff(of.to_numpy(), prepend=-1) > 0
        n = merged.column("counts").flatten()
        total = np.add.reduceat(n.to_numpy(), np.flatnonzero(first)) if len(n) else n.to_numpy()
        return pa.RecordBatch.from_arrays(
            [merged.column("lang").take(of), merged.column("sources").flatten(), merged.column("term").take(of), n,
             pa.array(total).take(of), pa.array(first.astype(np.int64))],
            ["lang", "source", "term", "count", "lang_count", "first"],
        )

    def add_up(batches):
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if last is not None:
                batch = pa.Table.from_batches([last, batch.cast(last.schema)]).combine_chunks().to_batches()[0]
            merged = merge_terms(batch)
            last = merged.slice(merged.num_rows - 1)  # its term may go on in the next batch
            yield kept(merged.slice(0, merged.num_rows - 1))
        if last is not None:
            yield kept(last)

    # A term that is everywhere is one row per slice of text and language.
    in_order = _terms_of_slices(docs).repartition("term").sortWithinPartitions("term", "lang")
    kind = "lang string, source string, term string, count long, lang_count long, first long"
    return save(in_order.mapInArrow(add_up, kind), "kept-counts")


def _share(count: Column, total: Column, terms: Column, unit: int) -> Column:
    """1 + floor(unit * (count + 1) / (total + terms)), exactly; null without terms."""
    top = F.lit(unit).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)")
    under = F.nullif(total + terms, F.lit(0)).cast("decimal(19,0)")
    return F.call_function("div", top, under) + 1


def _gain(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), F.nullif(q, F.lit(0)))


def _pair_sums(frame: pd.DataFrame) -> pd.DataFrame:
    """Sums over the terms of a block for all ordered pairs of sources of two source blocks."""
    lang, a, b = frame["lang"].iloc[0], frame["a"].iloc[0], frame["b"].iloc[0]
    alone = frame["term"].isna().to_numpy()
    sources = frame[alone].drop_duplicates("source").sort_values("source")
    names = pd.Index(sources["source"])
    rows = frame[~alone]
    term, distinct = pd.factorize(rows["term"])
    share = np.repeat(sources["empty"].to_numpy(np.int64)[:, None], max(len(distinct), 1), axis=1)[:, : len(distinct)]
    share[names.get_indexer(rows["source"]), term] = rows["p"].to_numpy(np.int64)
    block = sources["block"].to_numpy()
    out = []
    for i in range(len(names)):
        partner = np.flatnonzero(block == (b if block[i] == a else a)) if a != b else np.arange(len(names))
        partner = partner[partner != i]
        gap = share[partner] - share[i]
        value = (gap * gap // share[i]).sum(axis=1) if len(distinct) else np.zeros(len(partner), np.int64)
        out.append(pd.DataFrame({"source": names[partner], "item": names[i], "value": value}))
    empty = pd.DataFrame({"source": [], "item": [], "value": []}).astype({"value": "int64"})
    return pd.concat(out or [empty]).assign(lang=lang, seen=len(distinct))[["lang", "source", "item", "value", "seen"]]


def _pairs(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of all ordered pairs of sources of a language.

    `counts` (lang, source, term, p), `groups` (lang, source, terms, sources, empty).  A task has the
    terms of one hash block and two hash blocks of sources, as a table of shares; terms that
    neither source holds are added at the end, as all of them have the same shares.
    """
    blocks = F.ceil(F.col("sources") / SOURCE_BLOCK)
    groups = groups.withColumn("block", F.pmod(F.xxhash64("source"), blocks))
    partner = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other")
    term_blocks = F.greatest(F.ceil(F.col("terms") / TERM_BLOCK), F.lit(1).cast("long"))
    shared = ["lang", "source", "block", "empty"]
    alone = groups.select(*shared, "sources", "terms", partner).select(
        *shared, "other", F.explode(F.sequence(F.lit(0).cast("long"), term_blocks - 1)).alias("part"),
        F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("p"),
    )
    full = counts.join(groups, ["lang", "source"]).select(
        *shared, partner, F.pmod(F.xxhash64("term"), term_blocks).alias("part"), "term", "p"
    )
    both = alone.union(full).withColumns({"a": F.least("block", "other"), "b": F.greatest("block", "other")})
    sums = both.groupBy("lang", "part", "a", "b").applyInPandas(
        _pair_sums, "lang string, source string, item string, value long, seen long"
    )
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    mine = groups.select("lang", "source", "terms", F.col("empty").alias("p"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("empty").alias("q"))
    rest = (F.col("terms") - F.col("seen")) * _gain(F.col("p"), F.col("q"))
    return sums.join(mine, ["lang", "source"]).join(other, ["lang", "item"]).select(
        "lang", "source", "item", (F.col("value") + F.coalesce(rest, F.lit(0))).alias("value")
    )


def divergence(
    docs: DataFrame, min_documents: int = MIN_DOCUMENTS, unit: int = UNIT, ranks: int = RANKS,
) -> DataFrame:
    """(lang, source, part, item, value, rank): how far the sources of a language differ, and in what.

    A group is a language and a source that occur together; null is ''.  Kept terms of a language
    stand in at least min_documents of its rows (every row is a document, repeated or not).  A kept
    term's share p in a group or language is 1 + floor(unit * (count + 1) / (N + V)) with N the
    occurrences of all V kept terms there; the gain of p over q is floor((p - q) ** 2 / q).  Part
    `pair` has the other sources of the language (a language with one source has none) by the sum of
    gains over all kept terms, 0 without any; part `term` the first `ranks` terms that the group has
    and uses more than its language.  Ranks go by falling value, then by the bytes of the item.  Null and
    empty texts have no terms but their group counts; an empty table gives no rows.  All arithmetic is
    in whole numbers.
    """
    docs = docs.select(
        *(F.coalesce(column(docs, c, "string"), F.lit("")).alias(c) for c in ("lang", "source", "text"))
    )
    counts = term_counts(docs, min_documents)
    langs = counts.groupBy("lang").agg(F.sum("first").alias("terms"), F.sum("count").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    there = docs.select("lang", "source").distinct()
    sources = there.groupBy("lang").agg(F.count("*").alias("sources"))
    zero = F.lit(0).cast("long")
    groups = (
        there.join(sources, "lang").join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
        .fillna(0, ["terms", "lang_total", "total"])
        .withColumn("empty", F.coalesce(_share(zero, F.col("total"), F.col("terms"), unit), zero))
    )
    groups = save(groups, "groups")
    shares = counts.join(groups, ["lang", "source"]).select(
        "lang", "source", "term",
        _share(F.col("count"), F.col("total"), F.col("terms"), unit).alias("p"),
        _share(F.col("lang_count"), F.col("lang_total"), F.col("terms"), unit).alias("q"),
    )
    pairs = _pairs(shares.select("lang", "source", "term", "p"), groups.drop("lang_total", "total"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    order = F.row_number().over(by_value).alias("rank")
    terms = shares.filter(F.col("p") > F.col("q")).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        _gain(F.col("p"), F.col("q")).alias("value"),
    )
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    return pairs.select("*", order).union(terms.select("*", order).filter(F.col("rank") <= ranks))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


OP12_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text FROM documents
), o AS (SELECT lang, source, doc_id, unnest(regexp_extract_all(text, '{TERM}')) AS term FROM d
), k AS (SELECT lang, term, count(*)::HUGEINT AS c FROM o GROUP BY ALL HAVING count(DISTINCT doc_id) >= {MIN_DOCUMENTS}
), l AS (SELECT lang, count(*)::HUGEINT AS v, sum(c)::HUGEINT AS n FROM k GROUP BY ALL
), g AS (SELECT DISTINCT lang, source FROM d
), c AS (
  SELECT g.lang, g.source, k.term, count(o.term)::HUGEINT AS c, any_value(k.c) AS lc
  FROM g JOIN k USING (lang) LEFT JOIN o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term GROUP BY ALL
), t AS (SELECT lang, source, sum(c)::HUGEINT AS n FROM c GROUP BY ALL
), s AS (
  SELECT lang, source, term, c, 1 + {UNIT} * (c + 1) // (t.n + v) AS p, 1 + {UNIT} * (lc + 1) // (l.n + v) AS q
  FROM c JOIN l USING (lang) JOIN t USING (lang, source)
), x AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
  FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM s WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM r QUALIFY part = 'pair' OR rank <= {RANKS}
"""
