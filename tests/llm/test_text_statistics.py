"""Toxicity machine, source divergence and collocations against brute force and planted rows."""

import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from galemark.llm import collocations, common, divergence, toxicity, wordhash
from tests.compare import check, connect
from tests.llm.test_operators import FOLDER

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
KIND = "doc_id long, lang string, source string, text string, n long, term string, chunk string, number long, print long"


def frame(spark, rows):
    """(doc_id, lang, source, text) with columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, 5, "t", "c", 9, 3) for r in rows], KIND)


def random_rows(seed, n=60):
    draw = np.random.default_rng(seed)
    vocabulary = ["Red", "blue-green", "x.y,z", "éa", "É", "sea", "a1b", "salt;", "wind!", "rain?", "42", "sea,", "(sea)"]
    weights = 1 / np.arange(1, len(vocabulary) + 1)
    rows = []
    for i in range(n):
        words = draw.choice(vocabulary, draw.integers(0, 40), p=weights / weights.sum())
        gaps = draw.choice([" ", "  ", "\t", "\n", " \x0b"], len(words))
        rows.append((i, ["en", "de", None, ""][draw.integers(0, 4)], ["s1", "s2", "S3", None][draw.integers(0, 4)],
                     "".join(w + g for w, g in zip(words, gaps))))
    return rows


AWKWARD = [
    (1, None, None, None), (2, "en", "s1", ""), (3, "en", "only", None), (4, "xx", "a", "one"), (5, "xx", "b", "One two"),
    (5, "xx", "b", "One two"), (None, "xx", "b", "one."), (7, "yy", "lonely", "aa aa aa"), (8, "yy", "lonely", "aa"),
    (9, "yy", "lonely", "Aa,aa"), (10, "zz", "p", "lone"), (11, "zz", "q", "word"), (12, "de", "s9", "und-und " * 20_000),
    (13, "de", "s8", "z" * 100_000), (14, "de", "s8", "\x00a\x00 \x7fb\x7f 𝒳y ä"),
]


def brute_divergence(rows, min_documents=3, unit=10**9, ranks=200):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    counts, documents, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = term.findall((text or "").translate(AZ))
        counts[lang, source].update(found)
        documents[lang].update(set(found))
    out = set()

    def shares(count, terms):
        total = sum(count[t] for t in terms)
        return {t: 1 + unit * (count[t] + 1) // (total + len(terms)) for t in terms}

    for lang, source in groups:
        terms = sorted(t for t, n in documents[lang].items() if n >= min_documents)
        whole = Counter()
        for g, c in counts.items():
            if g[0] == lang:
                whole.update(c)
        p, q = shares(counts[lang, source], terms), shares(whole, terms)
        pairs = []
        for other in (s for l, s in groups if l == lang and s != source):
            o = shares(counts[lang, other], terms)
            pairs.append((-sum((p[t] - o[t]) ** 2 // o[t] for t in terms), other.encode()))
        gains = [(-((p[t] - q[t]) ** 2 // q[t]), t.encode()) for t in terms if counts[lang, source][t] and p[t] > q[t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(gains)[:ranks])):
            out |= {(lang, source, part, i.decode(), -v, n) for n, (v, i) in enumerate(found, 1)}
    return out


@pytest.mark.parametrize("rows", [AWKWARD, random_rows(1), random_rows(2, 300), []])
def test_divergence_equals_brute_force(spark, monkeypatch, rows):
    # Small blocks: several of them for terms, sources and slices.
    monkeypatch.setattr(divergence, "TERM_BLOCK", 3)
    monkeypatch.setattr(divergence, "SOURCE_BLOCK", 2)
    got = [tuple(r) for r in divergence.divergence(frame(spark, rows), ranks=4).collect()]
    want = brute_divergence(rows, ranks=4)
    assert len(got) == len(want) and set(got) == want


def test_chunks_are_counted_alike_in_any_slices(spark):
    batch = pa.RecordBatch.from_pylist([
        {"number": i, "lang": "en", "source": "ab"[i % 2], "text": t} for i, t in enumerate(["x y x", "", "x\ty", "y", "x"])
    ])
    found = divergence.count_chunks(batch).to_pylist()
    assert {(r["chunk"], r["docs"], r["low"], r["high"], *r["sources"], *r["counts"]) for r in found} == {
        ("x", 3, 0, 4, "a", 4), ("y", 3, 0, 3, "a", "b", 2, 1)
    }
    with pytest.raises(ValueError):
        divergence.term_counts(frame(spark, []), 4)


@pytest.mark.parametrize("rows", [AWKWARD, random_rows(3, 120)])
def test_divergence_of_small_slices_and_batches(spark, monkeypatch, rows):
    # Rows of one term come from many slices and go on in the next batch.
    monkeypatch.setattr(divergence, "SLICE", 40)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(name, "2")
    try:
        got = [tuple(r) for r in divergence.divergence(frame(spark, rows), ranks=4).collect()]
    finally:
        spark.conf.unset(name)
    want = brute_divergence(rows, ranks=4)
    assert len(got) == len(want) and set(got) == want


def test_a_slice_hands_on_a_row_per_term_not_per_chunk(spark):
    rows = [(i, "en", "ab"[i % 2], f"Salt; (salt) x{i % 2}salt, salt-n{i} 42") for i in range(4)]
    found = divergence._terms_of_slices(frame(spark, rows).coalesce(1)).collect()
    got = {r.term: (r.docs, dict(zip(r.sources, r.counts))) for r in found}
    assert len(found) == len(got) and {t: s for t, (_, s) in got.items()} == {
        "salt": {"a": 8, "b": 8}, "x": {"a": 2, "b": 2}, "n": {"a": 2, "b": 2},
    }
    assert got["salt"][0] >= 3 and got["x"][0] >= 3 and got["n"][0] >= 3  # n: one document in each of four chunks
    two = divergence._terms_of_slices(frame(spark, rows[:2]).coalesce(1)).collect()
    assert {r.term: r.docs for r in two} == {"salt": 2, "x": 2, "n": 2}
    one = divergence._terms_of_slices(frame(spark, [(1, "en", "a", "n-1 n-2 n-3 n n")]).coalesce(1)).collect()
    assert [(r.term, r.docs, r.counts) for r in one] == [("n", 1, [5])]


def brute_collocations(rows, longest, min_count, top, absorbed):
    counts, totals, where = defaultdict(Counter), Counter(), {}
    for doc, lang, _, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(AZ)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    gram = tuple(words[i : i + n])
                    counts[lang][gram] += 1
                    if doc is not None:
                        where[lang, gram] = min(where.get((lang, gram), doc), doc)
    out = set()
    for lang, found in counts.items():
        frequent = {g: a for g, a in found.items() if a >= min_count}
        ranked = []
        for g, a in frequent.items():
            if len(g) < 2 or any(
                len(h) > len(g) and 100 * b >= absorbed * a and any(h[i : i + len(g)] == g for i in range(len(h)))
                for h, b in frequent.items()
            ):
                continue
            score, k = min((1000 * a * totals[lang] // (found[g[:k]] * found[g[k:]]), k) for k in range(1, len(g)))
            ranked.append((-score, -a, " ".join(g).encode(), found[g[:k]], found[g[k:]], where.get((lang, g))))
        for rank, (s, a, phrase, left, right, doc) in enumerate(sorted(ranked, key=lambda x: x[:3])[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, totals[lang], -s, doc))
    return out


@pytest.mark.parametrize("rows", [AWKWARD[:11] + AWKWARD[12:], random_rows(3), random_rows(4, 300), []])
@pytest.mark.parametrize("min_count, absorbed, longest", [(3, 100, 5), (6, 80, 3)])
def test_collocations_equal_brute_force(spark, monkeypatch, rows, min_count, absorbed, longest):
    monkeypatch.setattr(collocations, "SLICE", 500)
    found = collocations.collocations(frame(spark, rows), longest, min_count, 12, absorbed).collect()
    want = brute_collocations(rows, longest, min_count, 12, absorbed)
    assert len(found) == len(want) and {tuple(r) for r in found} == want


def test_colliding_fingerprints_are_told_apart_by_text(spark, monkeypatch):
    # Fingerprints of three bits: nearly everything collides.
    whole = collocations.Words

    class Few(whole):
        def grams(self, size, frequent):
            prints, at = super().grams(size, None)
            return prints & np.uint64(7), at

    monkeypatch.setattr(collocations, "Words", Few)
    rows = random_rows(5, 40)
    want = brute_collocations(rows, 3, 4, 50, 100)
    batches = pa.RecordBatch.from_pylist([
        {"doc_id": i, "lang": "und" if lang is None else lang, "text": text} for i, lang, _, text in rows
    ])
    bits = np.full(1 << 23, 255, np.uint8)
    counts = Counter()
    for part in collocations._phrases(batches, 3, bits):
        for r in part.to_pylist():
            if r["phrase"] is not None:
                counts[r["lang"], r["phrase"]] += r["n"]
    assert want and all(counts[lang, phrase] == a for lang, _, phrase, a, *_ in want)


def test_a_task_writes_each_phrase_once(monkeypatch):
    monkeypatch.setattr(collocations, "SLICE", 400)
    rows = random_rows(6, 200) + [(None, "en", "s", "only here, only here")]
    batches = [pa.RecordBatch.from_pylist([
        {"doc_id": i, "lang": "und" if lang is None else lang, "text": text} for i, lang, _, text in part
    ]) for part in (rows[:90], rows[90:])]
    bits = np.full(1 << 23, 255, np.uint8)
    slices = [r for b in batches for s in wordhash.slices(b, "text", 400) for p in collocations._phrases(s, 5, bits) for r in p.to_pylist()]
    want, where = Counter(), {}
    for r in slices:
        at = r["lang"], r["phrase"]
        want[at] += r["n"]
        where[at] = min((d for d in (where.get(at), r["doc_id"]) if d is not None), default=None)
    got = [r for b in collocations._written(iter(batches), 5, bits) for r in b.to_pylist()]
    assert len(got) == len(want) < len(slices) / 2
    assert all(want[r["lang"], r["phrase"]] == r["n"] and where[r["lang"], r["phrase"]] == r["doc_id"] for r in got)
    # With less room the rows come in several parts, and their sums stay.
    monkeypatch.setattr(collocations, "HELD", 2000)
    sums = Counter()
    for b in collocations._written(iter(batches), 5, bits):
        for r in b.to_pylist():
            sums[r["lang"], r["phrase"]] += r["n"]
    assert sums == want


def test_fingerprints_are_counted_in_little_memory():
    draw = np.random.default_rng(8)
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(draw.choice(words, 200)) for _ in range(6000)]
    batch = pa.RecordBatch.from_pylist([{"doc_id": i, "lang": "en", "text": text} for i, text in enumerate(texts)])
    want = Counter()
    for text in texts:
        want.update(zip(text.split(" "), text.split(" ")[1:]))

    def pairs(most=collocations.SLICE, held=collocations.PRINTS):
        return collocations._prints(iter([batch]), range(2, 3), None, most, held)

    # 127 MB when 4 MB of text were worked on at once; nearly all of it is temporary.
    wordhash._powers.clear()
    tracemalloc.start()
    assert 0 < max(b.num_rows for b in pairs()) <= collocations.ROWS
    assert tracemalloc.get_traced_memory()[1] < 90 << 20
    tracemalloc.stop()
    for found in (pairs(), pairs(50_000, 30_000)):
        counts = Counter()
        for b in found:
            for r in b.to_pylist():
                counts[r["print"]] += r["n"]
        assert sorted(counts.values()) == sorted(want.values())
    assert list(collocations._prints(iter([]), range(1, 2), None, 10, 10)) == []


def test_workers_get_small_batches_while_phrases_are_counted(spark, monkeypatch):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, sent, whole = spark.conf.get(name), [], collocations.save

    def save(df, kind):
        sent.append(int(spark.conf.get(name).rstrip("b")))
        return whole(df, kind)

    monkeypatch.setattr(collocations, "save", save)
    collocations.frequent_phrases(frame(spark, random_rows(9, 20)), 3, 2)
    assert len(sent) == 4 and max(sent) <= 4 << 20
    assert spark.conf.get(name) == before
    # The setting holds for what is sent: rows of 50 KB, 6 MB in all.
    texts = spark.range(120, numPartitions=1).select(F.repeat(F.lit("abcde"), 10_000).alias("text"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows]})

    with common.small_batches(spark, 1 << 20):
        got = [r.rows for r in texts.mapInArrow(sizes, "rows long").collect()]
    assert sum(got) == 120 and max(got) <= 25
    with pytest.raises(ValueError), common.small_batches(spark, 1 << 20):
        raise ValueError
    assert spark.conf.get(name) == before


def test_phrases_with_a_rare_part_are_not_written():
    batch = pa.RecordBatch.from_pylist([{"doc_id": 1, "lang": "en", "text": "a b c a b c a b"}])
    bits = np.full(1 << 23, 255, np.uint8)
    rare = int(collocations.Words(batch).grams(2, None)[0][1]) & ((1 << 26) - 1)  # "b c"
    bits[rare >> 3] ^= np.uint8(1 << (rare & 7))
    got = {r["phrase"] for p in collocations._phrases(batch, 5, bits) for r in p.to_pylist()}
    assert got == {None, "a", "b", "c", "a b", "c a", "c a b"}


def planted(n=1500, seed=7):
    """Toxic only where an insult meets a group; either alone is harmless, so are other words."""
    draw = np.random.default_rng(seed)
    rows, labels = [], []
    for i in range(n):
        words = list(draw.choice([f"word{x}" for x in range(40)], 12))
        insult, group = (draw.random(2) < 0.5).tolist()
        words += ["vermin"] * insult + ["islanders"] * group
        draw.shuffle(words)
        rows.append((i, "en", "s", " ".join(words)))
        labels.append((i, 1, int(insult and group)))
    return rows, labels


def test_pairs_of_terms_tell_what_single_terms_cannot(spark):
    rows, labels = planted()
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(frame(spark, rows), known).join(known.drop("quality"), "doc_id").filter("held_out").collect()
    assert len(got) > 400
    assert np.mean([r.predicted == r.toxic for r in got]) > 0.99
    # No cut of the single terms' part does as well: insult alone and group alone add up to the pair.
    with_both = [r.pairs for r in got if r.toxic]
    without = [r.pairs for r in got if not r.toxic]
    assert np.median(with_both) > np.max(without)


def test_machine_equals_the_sum_over_all_pairs():
    draw = np.random.default_rng(3)
    place = np.full(toxicity.BUCKETS, -1, np.int32)
    texts = pa.array(["Alpha beta, gamma!", "", None, "beta beta alphabet", "zeta"])
    bucket, row = toxicity.terms(texts)
    known = np.unique(bucket)[::2]
    place[known] = np.arange(len(known))
    model = toxicity.FactorizationMachine(place, 0.25, draw.normal(size=len(known)), draw.normal(size=(len(known), 3)))
    single, pairs = model.logits(texts)
    for i in range(len(texts)):
        held = sorted({place[b] for b, r in zip(bucket, row) if r == i and place[b] >= 0})
        assert single[i] == pytest.approx(0.25 + sum(model.weights[j] for j in held))
        want = sum(model.vectors[j] @ model.vectors[k] for j in held for k in held if j < k)
        assert pairs[i] == pytest.approx(want, abs=1e-9)


def test_terms_are_words_and_beginnings():
    bucket, row = toxicity.terms(pa.array(["Idiot", "(idiot)", "idiotic", "idio"]))
    held = [set(bucket[row == i]) for i in range(4)]
    assert held[0] == held[1] and len(held[0]) == 2 and len(held[2]) == 4 and len(held[3]) == 1
    assert len(held[0] & held[2]) == 1


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    rows, labels = planted(300)
    kind = "doc_id long, quality int, toxic int"
    flipped = [(i, 0, t) for i, _, t in labels]
    held = {r.doc_id for r in frame(spark, rows).filter(toxicity.held_out(F.col("doc_id"))).collect()}
    assert held == {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    flipped = [(i, q, 1 - t if i in held else t) for i, q, t in flipped]
    moved = [(i, "de", f"other{i}", t) for i, _, _, t in rows]
    a = toxicity.toxicity(frame(spark, rows), spark.createDataFrame(labels, kind)).collect()
    b = toxicity.toxicity(frame(spark, moved), spark.createDataFrame(flipped, kind)).collect()
    assert {r.doc_id: round(r.score, 9) for r in a} == {r.doc_id: round(r.score, 9) for r in b}


@pytest.mark.parametrize("labels, score", [([], 0.0), ([(1, 1, 1), (2, 1, 1)], 1.0), ([(2, 1, 0), (None, 1, 1), (3, 1, None)], 0.0)])
def test_toxicity_without_both_kinds(spark, labels, score):
    rows = [(1, "en", "s", None), (2, "en", "s", ""), (None, "en", "s", "a b"), (4, "en", "s", "x " * 50_000), (4, "en", "s", "y")]
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(frame(spark, rows), known).collect()
    assert len(got) == 5 and all(abs(r.score - score) < 1e-9 and r.predicted == round(score) for r in got)
    assert toxicity.toxicity(frame(spark, []), known).count() == 0


@pytest.mark.parametrize("name", ["op12_source_divergence", "op13_phrase_collocations"])
def test_queries_equal_sql(spark, name):
    good, note = check(spark, connect(FOLDER), FOLDER, name, entry.queries()[name], entry.oracle_sql()[name])
    assert good, note
