"""The training-data operators against brute force, on small tables with awkward rows."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from galemark.llm import common, decontaminate, importance, line_dedup, near_dup, packing, permutation_index, pii, secrets, substring, warc, wordhash
from galemark.llm.components import components
from galemark.llm.spans import spans
from tests.compare import check, connect

FOLDER = "/root/testdata/sf0.001"
KIND = "doc_id long, text string, lang string, source string, n_chars long, n long, kept string, value int"
WORD = re.compile(r"[^\x20\x09-\x0d]+")


def docs(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", s, 0, 7, "x", 1) for i, t, s in rows], KIND)


AWKWARD = [
    (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "one", "a"), (5, "one", "b"), (6, "One", None),
    (None, "one", "a"), (8, "a b c d e f g", "a"), (8, "a b c d e f g", "a"), (9, "A b C d e f g", "b"),
    (10, "und " * 300, "c"), (11, "und " * 90, "c"), (12, "é ñ x \x0b y", "c"),
    (13, " ".join(f"w{i}" for i in range(30_000)), "d"), (14, " ".join(f"w{i}" for i in range(29_990)), "e"),
]


def brute_components(rows, n, lower=True):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets, parent = {}, {}
    for i, text, _ in rows:
        w = WORD.findall((text or "").translate(table))
        sets[i] = frozenset(zip(*(w[j:] for j in range(n)))) if len(w) >= n else frozenset([tuple(w)] if w else [])
        parent[i] = i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = [i for i in sets if i is not None]
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return {i: (len(sets[i]), root(i)) for i in ids}


def near_copies(seed, groups=6, size=25, length=60, edits=6):
    draw = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        base = [f"g{g}w{x}" for x in draw.integers(0, 50, length)]
        for _ in range(size):
            own = list(base)
            for at in draw.integers(0, length, draw.integers(0, edits)):
                own[at] = f"e{draw.integers(0, 1000)}"
            rows.append((len(rows) * 3 % 1000, " ".join(own), "s"))
    return rows


@pytest.mark.parametrize("rows", [AWKWARD, near_copies(1), near_copies(2, 2, 60, 150, 30)])
@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, rows, n):
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    got = near_dup.near_duplicates(docs(spark, rows), words=n, hubs=1).collect()
    want = brute_components(rows, n)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)


def test_near_duplicates_meet_across_the_sketch_size(spark):
    # Texts alone with their extensions: n words of their own are n - 1 pairs, 60-66 against 72-82.
    sizes = [(n, m) for n in range(60, 67) for m in range(72, 83) if 100 * n >= 80 * m]
    rows = []
    for g, (n, m) in enumerate(sizes * 3):
        words = [f"g{g}w{x}" for x in range(m + 1)]
        rows += [(2 * g, " ".join(words[: n + 1]), "s"), (2 * g + 1, " ".join(words), "s")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(docs(spark, rows), words=2).collect()}
    assert got == {i + j: (s, i) for i, pair in zip(range(0, len(rows), 2), sizes * 3) for j, s in enumerate(pair)}


def test_near_duplicates_of_all_sizes_meet(spark):
    # Texts and their longest extensions that are still linked: sizes at the edge of what is allowed.
    rows, want = [], {}
    for g, n in enumerate([*range(4, 60), *range(100, 2000, 61)]):
        words = [f"g{g}w{x}" for x in range(n * 5 // 4 + 1)]
        rows += [(2 * g, " ".join(words[: n + 1]), "s"), (2 * g + 1, " ".join(words), "s")]
        want |= {2 * g: (n, 2 * g), 2 * g + 1: (n * 5 // 4, 2 * g)}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(docs(spark, rows), words=2).collect()}
    assert got == want


def test_values_without_a_holder_of_fitting_size_are_not_posted(spark):
    def posts(*sizes):
        sets = [np.sort(np.r_[np.uint64(0), np.arange(1, n, dtype=np.uint64) + np.uint64(1000 * i)]) for i, n in enumerate(sizes)]
        rows = [(i, len(v), bytearray(v.tobytes())) for i, v in enumerate(sets)]
        classes = spark.createDataFrame(rows, "id long, n long, sketch binary")
        return {(r.value, r.id, r.n) for r in near_dup._posts(classes, 80, 64).collect()}

    # One value in common, and it is the last of all to be posted: sets of one value post it.
    assert posts(1, 1) == {(0, 0, 1), (0, 1, 1)}
    assert posts(1, 2) == set() and posts(1, 60) == set()


def test_lists_of_one_member_are_left_out(spark):
    posts = spark.createDataFrame([(1, 10, 5), (2, 10, 5), (2, 11, 6), *((3, i, 7) for i in range(20, 40))], "value long, id long, n long")
    lists = {r.value: {m.id for m in r.met} for r in near_dup._lists(posts, 2).collect()}
    assert lists.keys() == {2, 3} and lists[2] <= {10, 11} and len(lists[3]) == 2


def test_near_duplicates_of_nothing(spark):
    assert near_dup.near_duplicates(docs(spark, [])).count() == 0
    assert near_dup.drop_near_duplicates(docs(spark, AWKWARD)).columns == docs(spark, []).columns


def test_components_equal_union_find(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 150), (150, 180)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 150: 150, 180: 150, 200: 150}


def brute_repeats(rows, window):
    parts = [WORD.findall(t or "") for _, t, _ in rows]
    seen = Counter(tuple(w[i : i + window]) for w in parts for i in range(len(w) - window + 1))
    out = []
    for (i, _, _), w in zip(rows, parts):
        gone = set()
        for at in range(len(w) - window + 1):
            if seen[tuple(w[at : at + window])] > 1:
                gone.update(range(at, at + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("window, seed", [(35, 12), (5, 2), (4, 4)])
def test_substring_dedup_equals_brute_force(spark, window, seed):
    draw = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{x}" for x in draw.integers(0, 4, draw.integers(0, 60))), "s") for i in range(60)]
    rows = [*AWKWARD[:13], *rows, (70, "p q " * 40, "s"), (71, "x " * 44, "s"), (72, "x " * 34, "s")]
    got = substring.remove_repeats(docs(spark, rows), window, seed).collect()
    assert Counter(tuple(r) for r in got) == brute_repeats(rows, window)
    assert substring.remove_repeats(docs(spark, []), window, seed).count() == 0


def test_words_and_runs_do_not_depend_on_blocks(monkeypatch):
    import pyarrow as pa

    texts = pa.array(["a bb  ccc", None, "", "bb ccc", "x" * 5000 + " bb ccc"])
    whole = wordhash.words_of(texts)
    monkeypatch.setattr(wordhash, "BLOCK", 16)
    cut = wordhash.words_of(texts)
    assert all((a == b).all() for a, b in zip(whole, cut))
    pairs = wordhash.runs(whole[3], 2)
    assert list(whole[4]) == [0, 3, 3, 3, 5, 8] and pairs[1] == pairs[3] == pairs[6]


def test_bitmap_holds_exactly_the_buckets(spark):
    values = [-5, 0, 1, 2**40 + 3, -(2**63)]
    bits = common.bitmap(spark.createDataFrame([(v,) for v in values], "h long"), "h", 1 << 16)
    every = np.array([*values, 6, 9, 2**41])
    assert list(common.in_bitmap(bits, every)) == [True] * 5 + [False] * 2 + [True]


def base_secrets(text):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        out += [(m.start(), 0, m.end(), "assign")] if len(m[2]) >= 6 else []
    for number, (kind, pattern, least) in enumerate((("access", "AKIA[A-Z0-9]+", 20), ("hex", "[0-9a-f]+", 24))):
        out += [(m.start(), number + 1, m.end(), kind) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return sorted(out)


SECRETS = [
    "", None, "password=abc secret=token =abcdefgh", "é😀 TOKEN: 'abcdef' x" + "0a" * 12, "AKIA" + "A1" * 8 + " AKIAX AKIAAKIA" + "B" * 12,
    "f" * 23 + " " + "f" * 24, "api_key=\"a.b-c/d+e=\" apikey : zzzzzz", "user=alice " + "Ab1" * 12, "Ab1" * 12, "user=alice nothing",
    "https://x.example/y AKIA" + "Z" * 16 + " token=abcdef", "https://x.example/y", "user=alice " + "z " * 300 + "Ab1" * 12,
]


def test_secrets_equal_base_rules_and_link_complements(spark):
    rows = [(i, t, "s") for i, t in enumerate(SECRETS)] + [(0, "", "s"), (None, "token=abcdef", "s")]
    got = secrets.credentials(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    text = {i: t or "" for i, t, _ in rows}
    for r in got:
        want = base_secrets(text[r.doc_id])
        line = ",".join(f"{k}:{a}:{e}" for a, _, e, k in want)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest(), (r, line)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[3] == k for s in want) for k in ("assign", "access", "hex")]
        assert {x for x in line.split(",") if x} <= set(r.spans.split(","))
    linked = {r.doc_id: r.n_linked for r in got}
    assert [linked[i] for i in (7, 8, 9, 10, 11, 12)] == [2, 0, 0, 1, 0, 0]
    assert secrets.credentials(docs(spark, [])).count() == 0


def linked_by_all_pairs(text, scope):
    """Weak spans and credentials by comparing every part with every other."""
    found = base_secrets(text)
    for number, kind, pattern in ((3, "endpoint", secrets.ENDPOINT), (4, "identifier", secrets.IDENTIFIER), (5, "key", secrets.KEY)):
        for m in re.finditer(pattern, text):
            if kind != "key" or all(re.search(c, m[0]) for c in ("[0-9]", "[a-z]", "[A-Z]")):
                found.append((m.start(), number, m.end(), kind))
    role, gap = secrets.KINDS, lambda a, b: max(0, b[0] - a[2], a[0] - b[2])
    more, whole = [], []
    for a in sorted(found):
        near = {r: min([(gap(a, b), *b) for b in found if role[b[3]] == r != role[a[3]] and gap(a, b) <= scope], default=None)
                for r in ("secret", "identity", "place")}
        covered = any(b[3] in secrets.BASE and b[3] != a[3] and b[0] < a[2] and a[0] < b[2] for b in found)
        if {"key": not covered and (near["identity"] or near["place"]), "identifier": near["secret"],
                "endpoint": near["secret"] and near["identity"]}.get(a[3]):
            more.append(a)
        if role[a[3]] == "secret" and not (a[3] == "key" and covered) and (near["identity"] or near["place"]):
            parts = [a] + [p[1:] for p in (near["identity"], near["place"]) if p]
            whole.append("+".join(f"{k}:{s}:{e}" for s, _, e, k in parts))
    every = sorted(more + base_secrets(text))
    return len(more), ",".join(f"{k}:{s}:{e}" for s, _, e, k in every), ",".join(whole)


@pytest.mark.parametrize("scope", [0, 7, 200])
def test_credentials_equal_all_pairs(spark, scope):
    draw, pieces = random.Random(scope), (
        "user=alice", "login: bob@x.y", "password=abcdefgh", "AKIA" + "Q7" * 9, "0f" * 13, "Ab1" * 12, "token=" + "Zz9" * 15,
        "https://h.example/p?token=abcdef1", "https://h/" + "p" * 450, "word", "é😀 ", " " * 6, "x" * 90, "\n",
    )
    texts = ["".join(draw.choice(pieces) + " " * draw.randint(0, 9) for _ in range(draw.randint(0, 40))) for _ in range(60)]
    rows = [(i, t, "s") for i, t in enumerate(texts + SECRETS)]
    rows += [rows[3], (None, texts[4], "s"), (None, texts[5], "s")]
    got = sorted((r.spans, r.n_linked, r.credentials) for r in secrets.credentials(docs(spark, rows), scope).collect())
    want = [linked_by_all_pairs(t or "", scope) for _, t, _ in rows]
    assert got == sorted((every, n, whole) for n, every, whole in want)
    assert sum(n for n, _, _ in want) > 5


def base_pii(text):
    rules = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m, d: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m, d: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m, d: 13 <= len(d) <= 19 and sum(
            (v - 9 if v > 9 else v) for v in (int(c) * (1 + i % 2) for i, c in enumerate(d[::-1]))) % 10 == 0),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m, d: 9 <= len(d) <= 15),
    )
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in rules for m in re.finditer(p, text) if ok(m[0], re.sub("[^0-9]", "", m[0]))]


PII = [
    "", None, "a@b.c_d@e.f", "x..y@z-.q a@b a@b..c", "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.255 9999999999999.1.1.1", "😀 +1 (743) 555-3824. +12",
    "4785380592391140 4111-1111 1111 1111 4111111111111111", "1" * 40, "4" + "  1" * 20, "@" * 50 + "a.b", "a." * 4000 + "@x", "a@" + "b." * 3000 + "c",
]


def test_pii_equals_base_rules(spark):
    rows = [(i, t, "s") for i, t in enumerate(PII * 8)] + [(0, "", "s"), (None, "q@r.s", "s")]
    got = pii.find(docs(spark, rows), sample=200).collect()
    assert len(got) == len(rows)
    text = {i: t or "" for i, t, _ in rows}
    for r in got:
        want = base_pii(text[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (r, want)
        assert r.spans.startswith(",".join(want))
    assert pii.find(docs(spark, [])).count() == 0


def test_pii_selects_planted_loose_cases(spark):
    draw = np.random.default_rng(8)
    number = lambda n: "".join(map(str, draw.integers(0, 10, n)))
    rows, forms = [], ("+1 ({}) 555-{}", "+1 ({})555-{}", "+1 {} 555-{}", "+1-{}-555-{}", "+1 ({}) 555 {}", "+1 {}.555.{}")
    for i in range(400):
        phone, host = forms[i % 6].format(number(3), number(4)), f"n{number(3)}"
        rows.append((i, f"see {phone} or {host}@example{number(2)}.com and id {number(9)} here", "s"))
    loose = {1000 + i: f"+1 ({number(3)})/555-{number(4)}" if i % 2 else f"n{number(3)} (at) example{number(2)} (dot) com" for i in range(16)}
    rows += [(i, f"see {span} here", "s") for i, span in loose.items()]
    got = {r.doc_id: r for r in pii.find(docs(spark, rows)).collect()}
    # Written-out addresses; the numbers with a format of their own are not selected.
    for i, span in loose.items():
        if i % 2 == 0:
            assert (got[i].n_more, got[i].spans) == (1, f"like_spoken:4:{4 + len(span)}")
    assert not any(got[i].n_more for i in range(400))  # numbers without a rule that look like nothing


def test_pii_learns_from_every_span(spark, monkeypatch):
    # 60 addresses, a card and 6 numbers in each; a number that holds the card says nothing, nor do repeated rows.
    rows = [
        (i, " ".join(f"n{i}x{j}@h{j % 7}.org" for j in range(60)) + f" id {i + 10**8};" * 6 + " 4111111111111111/5", "s")
        for i in range(100)
    ]
    seen = []

    class Spy(pii.GBTClassifier):
        def fit(self, data):
            weight = self.getOrDefault("weightCol") if self.isDefined("weightCol") else None
            seen.extend(data.groupBy("label").agg(F.sum(weight) if weight else F.count("*")).collect())
            return super().fit(data)

    monkeypatch.setattr(pii, "GBTClassifier", Spy)
    pii.find(docs(spark, rows + rows[:30])).collect()
    learnt = dict(map(tuple, seen))
    assert abs(learnt[1.0] - 6100 / 2) < 200 and abs(learnt[0.0] - 600 / 2) < 60


def vectors(n, dims=16, seed=5):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, dims)).astype(np.float32)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_neighbours_recall_and_ties(spark):
    x = vectors(600)
    x[100:160] = x[40]  # a vector that many rows share
    rows = [(i, [float(v) for v in x[i]]) for i in range(600)]
    odd = [(None, rows[0][1]), (601, None), (602, [0.0] * 16), (603, [float("nan")] * 16), (604, [None] * 16), (605, [1.0]), rows[0]]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    got = {}
    for r in permutation_index.nearest(frame, shard=256).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == list(range(0, 600, 20))
    y, hits = x.astype(float), 0
    for q, found in got.items():
        score = y @ y[q]
        order = [i for i in np.lexsort((np.arange(600), -score)) if i != q][:20]
        assert [f[0] for f in sorted(found)] == list(range(1, 21))
        assert all(abs(score[v] - s) < 1e-12 for _, v, s in found)
        hits += len({v for _, v, _ in found} & set(order))
    assert hits / (20 * len(got)) >= 0.9
    assert [v for _, v, _ in sorted(got[40])] == list(range(100, 120))
    assert permutation_index.nearest(frame.limit(0)).count() == 0


@pytest.mark.parametrize("spread", [0.3, 1.0])
def test_neighbours_recall_with_varied_lengths(spark, spread):
    x = vectors(4000, 32, 11).astype(float) * np.random.default_rng(12).lognormal(0, spread, 4000)[:, None]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in permutation_index.nearest(frame).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q, found in got.items():
        score = x @ x[q]
        hits += len(found & set([i for i in np.argsort(-score, kind="stable") if i != q][:20]))
    assert len(got) == 200 and hits / (20 * len(got)) >= 0.9


@pytest.mark.parametrize("posted, shard", [(5, 64), (40, 512)])
def test_postings_rank_by_footrule(spark, posted, shard):
    x = vectors(300, 8, 3).astype(float)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = permutation_index.usable(frame)
    pivots = permutation_index.choose_pivots(rows, 40)
    place = np.argsort(np.argsort(-(x @ pivots.T), axis=1, kind="stable"), axis=1)
    cut = np.minimum(place, posted)
    # Nothing but the footrule decides who is ranked again: 8 candidates of each shard, 2 answers.
    got = {}
    for r in permutation_index.nearest(frame, k=2, pivots=40, posted=posted, shard=shard, rerank=0.0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    home = np.array([r[0] for r in frame.orderBy("vec_id").select(
        F.pmod(F.xxhash64("vec_id"), F.lit(-(-300 // shard)))).collect()])
    for q, found in got.items():
        distance, score = np.abs(cut - cut[q]).sum(axis=1), x @ x[q]
        chosen = []
        for h in set(home):
            # A query takes one of the candidates' seats in its own shard if it is among them.
            inside = sorted((distance[i] if i != q else 10**9, i) for i in np.flatnonzero(home == h))[:8]
            chosen += [i for _, i in inside if i != q]
        assert [v for _, v in sorted(found)] == sorted(chosen, key=lambda i: (-score[i], i))[:2]
    assert len(got) == 15


def test_many_matches_are_placed_as_few_are(spark):
    texts = ["".join(f"x{'é' * (i % 3)} AKIA{'B' * (16 + i % 5)}{i % 10} " for i in range(n)) for n in (1, 255, 256, 257, 1500)]
    frame = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    for r in frame.select("i", spans(F.col("t"), secrets.ACCESS, lambda m, _: ~m.endswith("7")).alias("s")).collect():
        want = [(m.start(), m.end(), m[0]) for m in re.finditer(secrets.ACCESS, texts[r.i]) if not m[0].endswith("7")]
        assert [tuple(x) for x in r.s] == want


def test_packing_is_tight_and_free_of_conflicts(spark):
    draw = np.random.default_rng(6)
    rows = [(i, "w " * int(n), f"s{draw.integers(0, 4)}") for i, n in enumerate(draw.integers(0, 250, 120))]
    rows += [(500, None, None), (501, "v " * 950, "s0"), (502, "v " * 300, "s1"), (3, rows[3][1], rows[3][2])]
    got = packing.best_fit(docs(spark, rows), capacity=300, group=40).collect()
    assert Counter((r.doc_id, r.n_words) for r in got if r.doc_id == 501) == Counter({(501, 300): 3, (501, 50): 1})
    total = Counter()
    for r in got:
        total[r.doc_id] += r.n_words
    assert total == Counter({i: (1 + (i == 3)) * len((t or "").split()) for i, t, _ in rows})
    bins = {}
    for r in got:
        bins.setdefault(r.bin, []).append(r)
    for held in bins.values():
        named = [r.source for r in held if r.source is not None]
        assert sum(r.n_words for r in held) <= 300 and len(named) == len(set(named))
        assert sorted(r.place for r in held) == list(range(len(held)))
    assert packing.best_fit(docs(spark, [])).count() == 0


def test_pack_takes_the_tightest_compatible_bin():
    pieces = [(70, 0, 0), (60, 1, 1), (30, 0, 2), (30, 2, 1), (10, 3, 3)]
    # 30 of source 0 does not fit beside 70 of source 0, the tightest; so it goes to the next.
    assert packing.pack(pieces, 100) == [(0, 0), (1, 0), (1, 1), (0, 1), (1, 2)]


def test_lines_on_many_sites_stay_once(spark):
    rows = [(100 + i, f"own {i}\nshared\n\n  shared  ", f"s{i}") for i in range(12)]
    rows += [(120, "shared", None), (121, "few\nown", "s1"), *AWKWARD]
    frame = docs(spark, rows)
    got = {r.doc_id: r for r in line_dedup.remove_boilerplate(frame, min_sites=12).collect() if r.doc_id is not None}
    assert got[100].text == "own 0\nshared\n" and got[100]["__removed"] == 1
    assert got[105].text == "own 5\n" and got[120].text == "" and got[121].text == "few\nown"
    assert line_dedup.remove_boilerplate(frame, min_sites=12).count() == len(rows)
    kept = line_dedup.without_boilerplate(frame, min_sites=12)
    assert kept.columns == frame.columns and kept.filter("doc_id = 120").count() == 0
    assert kept.filter("doc_id in (1, 2)").count() == 2
    assert line_dedup.remove_boilerplate(docs(spark, [])).count() == 0


def test_spread_near_the_threshold_is_exact(spark):
    rows = [(100 * k + i, f"line {k}", f"site{i}") for k in range(1, 60) for i in range(k)]
    got = line_dedup.boilerplate(line_dedup._lines(docs(spark, rows).withColumn("key", F.lit(0).cast("long")).withColumnRenamed("source", "site")), 20)
    assert got.count() == 40


def test_sites_that_share_a_register_are_counted(spark):
    # Sites whose hashes start with the same six bits share one of a sketch's 64 registers.
    names = spark.range(4000).select(F.concat(F.lit("site"), "id").alias("site")).filter(F.shiftrightunsigned(F.xxhash64("site"), 58) == 0)
    rows = [(i, "shared\nown " + str(i), r.site) for i, r in enumerate(names.orderBy("site").limit(10).collect())]
    got = line_dedup.remove_boilerplate(docs(spark, rows)).collect()
    assert sorted((r.doc_id, r["__removed"]) for r in got) == [(i, int(i > 0)) for i in range(10)]


def test_contamination_equals_containment(spark):
    item = [f"q{i}" for i in range(30)]
    items = spark.createDataFrame([(1, " ".join(item)), (2, "too short"), (3, None), (None, "a b c d e f"), (4, " ".join(item[:6]))], "item_id long, text string")
    rows = [*AWKWARD, (30, "x " * 9000 + " ".join(item).upper() + " y" * 9000, "s"), (31, " ".join(item[:25]), "s"), (32, " ".join(item[:24]), "s"), (31, " ".join(item[:25]), "s")]
    got = decontaminate.contaminated(docs(spark, rows), items).collect()
    assert Counter((r.doc_id, r.item_id, r.n_shared) for r in got) == Counter([
        (30, 1, 26), (31, 1, 21), (30, 4, 2), (31, 4, 2), (32, 4, 2), (8, None, 2), (9, None, 2),
    ])
    kept = decontaminate.drop_contaminated(docs(spark, rows), items)
    assert kept.count() == len(AWKWARD) - 3 and kept.columns == docs(spark, []).columns
    assert decontaminate.contaminated(docs(spark, []), items).count() == 0
    assert decontaminate.contaminated(docs(spark, rows), items.limit(0)).count() == 0


def brute_contamination(rows, items, n=5, contained=0.8):
    out = Counter()
    for i, text in set(items):
        words = (text or "").lower().split()
        size = min(len(words), n)
        wanted = {tuple(words[j : j + size]) for j in range(len(words) - size + 1)} if size else set()
        for doc, body in {(d, t) for d, t, _ in rows}:
            held = (body or "").lower().split()
            shared = wanted & {tuple(held[j : j + size]) for j in range(len(held) - size + 1)}
            if wanted and len(shared) >= contained * len(wanted) - 1e-9:
                out[doc, i, len(wanted), len(shared)] += 1
    return out


def test_every_item_is_searched(spark):
    long = " ".join(f"q{i}" for i in range(12))
    items = [(1, "alpha beta gamma delta"), (1, long), (1, " ".join(f"z{i}" for i in range(20))), (None, "Omega"),
             (None, long), (None, None), (7, ""), (8, "x y z"), (8, "x y z"), (9, "one two three four five")]
    rows = [(1, "say ALPHA beta gamma delta now", "a"), (2, "alpha beta delta gamma", "a"), (3, long + " tail", "b"),
            (4, "omega", None), (None, "x y z", "a"), (6, "x y", "a"), (7, None, "a"), (8, "one two three four five", "b"),
            (9, "z0 " + long, "b"), (9, "z0 " + long, "b"), (10, " ".join(f"z{i}" for i in range(16)), "c")]
    frame = docs(spark, rows).withColumn("doc", F.lit(1)).withColumn("key", F.lit(1)).withColumn("gone", F.lit(1))
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit("own"))
    got = Counter(tuple(r)[:1] + tuple(r)[2:5] for r in decontaminate.contaminated(frame, table).collect())
    assert got == brute_contamination(rows, items) and len(got) == 8
    kept = decontaminate.drop_contaminated(frame, table)
    assert kept.columns == frame.columns and sorted(r.doc_id for r in kept.collect()) == [2, 6, 7, 10]
    assert line_dedup.remove_boilerplate(frame).columns == [*frame.columns, "__removed"]


def test_full_pieces_of_repeated_rows_have_bins_of_their_own(spark):
    rows = [(1, "w " * 700, "a"), (1, "w " * 700, "a"), (1, "w " * 700, "b"), (None, "v " * 600, None), (None, "v " * 600, None)]
    got = packing.best_fit(docs(spark, rows), capacity=300).collect()
    held = Counter()
    for r in got:
        held[r.bin] += r.n_words
    assert max(held.values()) <= 300 and sum(held.values()) == 3 * 700 + 2 * 600


def test_pack_equals_trying_all_bins():
    draw = np.random.default_rng(9)
    pieces = [(int(n), int(s), int(c)) for n, s, c in zip(
        np.sort(draw.integers(1, 90, 400))[::-1], draw.integers(-1, 12, 400), draw.integers(-1, 60, 400))]
    bins, want = [], []
    for size, source, cluster in pieces:
        fits = [
            (left, b) for b, (left, held) in enumerate(bins) if left >= size
            and all((source < 0 or source != s) and (cluster < 0 or cluster != c) for _, s, c in held)
        ]
        b = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([100, []])
        want.append((b, len(bins[b][1])))
        bins[b][0] -= size
        bins[b][1].append((size, source, cluster))
    assert packing.pack(pieces, 100) == want


def test_warc_round_trip(spark):
    page = "<p>" + "é" * 60 + "\r\n\r\nWARC/1.1\r\n</p>"
    rows = [(3, "http://a/ x", page, 1), (1, None, page, 1), (2, "u", "short", 1), (4, "u", "short", 1), (5, "u", None, 1), (5, "u", None, 1), (None, "n", page, 1)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, type int")
    path = common.new_path(spark, "warc")
    warc.write_archives(frame, path)
    got = warc.assemble(warc.read_archives(spark, path)).collect()
    assert len(got) == len(rows) and all(r.request is not None and len(r.metadata) == 1 for r in got)
    found = Counter((r.page_id, r.record_type, r.response.refers_to, r.response.payload_bytes, r.response.payload) for r in got)
    size = len(page.encode())
    assert found == Counter([
        (1, "response", None, size, page), (3, "revisit", 1, size, None), (None, "revisit", 1, size, None),
        (2, "response", None, 5, "short"), (4, "response", None, 5, "short"), (5, "response", None, 0, ""), (5, "response", None, 0, ""),
    ])
    assert all(r.response.payload_digest == r.response.stated_digest for r in got)


def test_resampling_separates_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    source, labels = common.table(spark, folder, "documents"), common.table(spark, folder, "labels")
    kept = {r.doc_id for r in importance.resample(source, labels)[1].collect()}
    bad = {r.doc_id for r in labels.filter("quality = 0").collect()}
    good = {r.doc_id for r in labels.filter("quality = 1 AND toxic = 0").collect()}
    assert len(bad & kept) <= 0.1 * len(bad) and len(good & kept) >= 0.95 * len(good)
    assert {r.doc_id for r in importance.keep_good(source, labels).collect()} == kept


def test_resampling_draws_k_and_awkward_rows(spark):
    labels = spark.createDataFrame([(8, 1, 0), (8, 1, 1), (4, 1, 0), (None, 1, 0), (13, None, 0)], "doc_id long, quality int, toxic int")
    frame = docs(spark, AWKWARD)
    drawn = importance.resample(frame, labels, k=3)[1].collect()
    assert 3 <= len(drawn) <= 4 and all(r.log_weight is not None for r in drawn)
    assert importance.keep_good(frame, labels).count() == 12  # all that have words
    assert importance.keep_good(docs(spark, []), labels).count() == 0
    assert importance.resample(frame, labels.limit(0))[1].count() == 12


def test_resampling_equals_brute_force(spark):
    """Log weights as sums of log ratios of smoothed frequencies, gram by gram; the k largest draws."""
    draw = np.random.default_rng(4)
    pool = [*"a bb Cc dd, 7 eé (f) GG ..".split(), "h-i"]
    rows = [(i, " ".join(draw.choice(pool, draw.integers(0, 30))), "s") for i in range(60)] + [(60, None, "s"), (7, "a bb", "s")]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(61)], "doc_id long, quality int, toxic int")
    model, scores, held = importance.fit(docs(spark, rows), labels)
    target = {i for i in range(61) if i % 3 > 0} - {r.doc_id for r in held.collect()}
    grams = [[b.tolist() for b in importance._grams(pa.array([text or ""]))[0]] for _, text, _ in rows]
    want = [0.0] * len(rows)
    for family in (0, 1):
        raw, good = Counter(), Counter()
        for (doc_id, _, _), both in zip(rows, grams):
            raw.update(both[family])
            good.update(both[family] if doc_id in target else [])
        share = sum(good.values()) / sum(raw.values())
        for i, both in enumerate(grams):
            want[i] += sum(math.log((good[g] + 1) / (raw[g] * share + 1)) for g in both[family])
    found = scores.collect()
    assert sorted(r.doc_id for r in found) == sorted(r[0] for r in rows)
    expected = sorted((doc_id, w) for (doc_id, _, _), both, w in zip(rows, grams, want) if both[0])
    weighed = sorted((r.doc_id, r.log_weight) for r in found if r.log_weight is not None)
    assert [i for i, _ in weighed] == [i for i, _ in expected]
    assert np.allclose([w for _, w in weighed], [w for _, w in expected], atol=1e-4)
    draws = sorted((r.draw for r in found if r.draw is not None), reverse=True)
    noise = np.array([r.draw - r.log_weight for r in found if r.draw is not None])
    assert abs(noise.mean() - 0.577) < 0.6 and 0.7 < noise.std() < 2
    kept = importance.resample(docs(spark, rows), labels, k=20)[1].collect()
    assert sorted((r.draw for r in kept), reverse=True) == draws[:20]


def test_kth_largest_equals_sorting(spark):
    draw = np.random.default_rng(9).gumbel(size=500).round(2).tolist()
    frame = spark.createDataFrame([(d,) for d in draw] + [(None,)], "draw double")
    for k in (1, 2, 100, 499):
        assert importance.kth_largest(frame, k) == sorted(draw, reverse=True)[k - 1]


@pytest.mark.parametrize("name", ["op8_line_dedup", "op9_warc_transactions", "op10_benchmark_decontamination"])
def test_queries_equal_sql(spark, name):
    good, note = check(spark, connect(FOLDER), FOLDER, name, entry.queries()[name], entry.oracle_sql()[name])
    assert good, note


@pytest.mark.parametrize("name", ["op4_secret_linking", "op5_pii_boosting", "op10_benchmark_decontamination"])
def test_native_queries_have_no_python(spark, name):
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def test_pipeline_stages_keep_the_columns(spark):
    import corpus_pipeline

    frame = common.table(spark, FOLDER, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "minhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = common.save(stage(spark, frame, FOLDER), name)
        assert after.columns == frame.columns and 0 < after.count() <= frame.count()
        frame = after
    packed = corpus_pipeline.STAGES[-1][1](spark, frame, FOLDER)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in frame.collect()}
