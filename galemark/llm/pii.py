"""Personal data by candidate gradient boosting, in built-in expressions and Spark's boosted trees.

Base patterns with check rules (Luhn digits, number ranges, digit counts) always count.  Besides, loose
generators propose overlapping spans; boosted trees score each proposal by its format and its context,
and a threshold per generator, calibrated on held-out proposals, selects further ones.  The trees learn
from one half of all of the corpus's own spans, the other half calibrates: those that pass a base rule, whichever
generator proposes them, against those that do not and touch none that does.  Spans of equal features are one
row with their number as weight.  The loose generators also propose what base
patterns match, so their share of base spans at a score is known.  No feature is a check rule itself, so a
card number with a wrong digit still looks like one; addresses are compared as written with @ and dots.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from galemark.llm.common import column, save, table, text_key
from galemark.llm.spans import spans, written

#: A run of local characters is tried once, from its start or from where the last match ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Loose generators: addresses, written out or not, and numbers with any separators.
SPOKEN = (
    r"(?i)[A-Za-z0-9._%+-]{1,64}+(?:"
    r"\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,64}+(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{1,64}+)++"
    r"|@[A-Za-z0-9-]{1,64}+(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]{1,64}+)++)"
)
NUMBER = r"[(+]?[0-9](?:[\x20()./-]{0,2}[0-9]){6,}+"

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "spoken", "number")
#: Characters of context on either side.
CONTEXT = 24
#: Rounds and depth of the trees.
ROUNDS, DEPTH = 8, 3
#: Precision that the calibrated threshold must have on held-out proposals.
PRECISION = 0.95
#: Least share of the training spans in a leaf, so that a few loose cases do not get a leaf of their own.
LEAF = 0.02


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits has a valid Luhn check digit."""
    n = F.length(number)
    values = F.transform(
        F.sequence(F.lit(1), n), lambda i: F.substring(number, i, F.lit(1)).cast("int") * (1 + (n - i) % 2)
    )
    total = F.aggregate(values, F.lit(0), lambda s, v: s + F.when(v > 9, v - 9).otherwise(v))
    return (n > 0) & (total % 10 == 0)


def valid_ip(match: Column) -> Column:
    parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.lpad(p, 3, "0") <= "255"))


def valid(kind: Column, match: Column) -> Column:
    number = digits(match)
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", valid_ip(match))
        .when(kind == "card", F.length(number).between(13, 19) & luhn(F.substring(number, 1, 19)))
        .when(kind == "phone", F.length(number).between(9, 15))
        .otherwise(F.lit(False))
    )


def _proposals(docs: DataFrame) -> DataFrame:
    """All matches of all generators with their context; and one row of kind "row" per input row."""
    patterns = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE, SPOKEN, NUMBER)))
    # A card is 13 digits at least, and shorter runs are no proposals: they go as they are found.
    keep = {"card": lambda m, _: F.length(m) >= 7}

    def matches(number: int, kind: str) -> Column:
        return F.transform(spans(F.col("text"), patterns[kind], keep.get(kind)), lambda s: F.struct(
            F.lit(number).alias("number"), s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"),
            s["text"].alias("match"),
        ))

    found = F.concat(*(matches(i, k) for i, k in enumerate(KINDS)))
    row = F.struct(
        F.lit(-1).alias("number"), F.lit(-1).cast("bigint").alias("start"), F.lit(-1).cast("bigint").alias("end"),
        F.lit("row").alias("kind"), F.lit("").alias("match"),
    )
    each = docs.select("doc_id", "key", "text", F.explode(F.concat(F.array(row), found)).alias("p"))
    begin = F.greatest(F.col("p.start") - CONTEXT, F.lit(0))
    return each.select(
        "doc_id", "key", "p.*",
        F.when(F.col("p.start") >= 0, F.substring("text", (begin + 1).cast("int"), (F.col("p.start") - begin).cast("int"))).alias("before"),
        F.when(F.col("p.start") >= 0, F.substring("text", (F.col("p.end") + 1).cast("int"), F.lit(CONTEXT))).alias("after"),
    )


def _features() -> dict[str, Column]:
    """Format and context of a proposal as numbers; none is a check rule."""
    before, after = F.lower("before"), F.col("after")
    m = F.regexp_replace(F.regexp_replace("match", r"(?i)\x20?[(\[]at[)\]]\x20?", "@"), r"(?i)\x20?[(\[]dot[)\]]\x20?", ".")
    count = lambda chars: (F.length(m) - F.length(F.translate(m, chars, ""))).cast("double")
    word = lambda pattern: before.rlike(pattern).cast("double")
    return {
        "length": F.length(m).cast("double"), "digits": F.length(digits(m)).cast("double"),
        "dots": count("."), "hyphens": count("-"), "blanks": count(" "), "brackets": count("()"), "ats": count("@"),
        "plus": m.startswith("+").cast("double"), "letters": F.length(F.regexp_replace(m, "[^A-Za-z]", "")).cast("double"),
        "glued_before": before.rlike("[a-z0-9_]$").cast("double"), "glued_after": after.rlike("^[A-Za-z0-9_]").cast("double"),
        "phone_word": word("phone|tel|call|fax|mobil"), "card_word": word("card|visa|credit|iban|account"),
        "net_word": word("host|server|addr|ip"), "mail_word": word("mail|contact"),
        "other_word": word("order|invoice|version|date|page|token|secret|key|isbn"),
    }


def find(docs: DataFrame, sample: int | None = None, precision: float = PRECISION, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, n_more, base_sha256, spans.

    Counts and hash are those of base spans.  `spans` adds proposals that the trees select, as
    like_<generator>; one inside a base span is part of that, one inside a longer one is part of
    that one, one of several generators counts for the first.  Without both kinds of proposals to learn from nothing is added, nor where base spans are
    less than `precision` of the held-out proposals that score as high.  All proposals are learnt from or held out; a caller
    may bound them to the `sample` of smallest hash.  A null text is empty; a text without spans has the hash of the empty
    string.  Repeated rows give a row each.  An empty table gives no rows.
    """
    text = column(docs, text_column, "string")
    docs = docs.select(
        column(docs, id_column, "long").alias("doc_id"), text_key(text).alias("key"), F.coalesce(text, F.lit("")).alias("text")
    )
    found = _proposals(docs).withColumn("base", valid(F.col("kind"), F.col("match")))
    found = save(found.select("*", *(c.alias(f"f_{k}") for k, c in _features().items())), "proposals")
    scored = _selected(found, sample, precision)
    one = F.struct("number", "start", "end", "kind")
    rows = scored.groupBy("doc_id", "key").agg(
        F.sum((F.col("kind") == "row").cast("int")).cast("int").alias("times"),
        F.sort_array(F.collect_set(F.when(F.col("base"), one))).alias("strong"),
        F.sort_array(F.collect_set(F.when(F.col("more"), F.struct("number", "start", "end", F.concat(F.lit("like_"), "kind").alias("kind"))))).alias("more"),
    )
    # A base span next to a proposal: both lists are in order, and a text has few of either.
    inside = lambda s: F.exists("strong", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    again = lambda s: F.exists("more", lambda o: (
        (o["start"] <= s["start"]) & (s["end"] <= o["end"])
        & ((o["start"] < s["start"]) | (s["end"] < o["end"]) | (o["number"] < s["number"]))
    ))
    rows = rows.withColumn("more", F.filter("more", lambda s: ~inside(s) & ~again(s)))
    count = lambda kind: F.size(F.filter("strong", lambda s: s["kind"] == kind)).cast("long")
    return rows.select(
        F.explode(F.sequence(F.lit(1), F.col("times"))).alias("_"), "doc_id", *(count(k).alias(f"n_{k}") for k in BASE),
        F.size("more").cast("long").alias("n_more"),
        F.sha2(F.encode(written(F.col("strong")), "UTF-8"), 256).alias("base_sha256"),
        written(F.concat("strong", "more")).alias("spans"),
    ).drop("_")


def _selected(found: DataFrame, sample: int | None, precision: float) -> DataFrame:
    """Proposals with `more`: selected by the trees, beside the base spans."""
    names = [c for c in found.columns if c.startswith("f_")]
    # One row per span, right if any generator's rule holds for it.
    each = found.filter("kind <> 'row'").groupBy("doc_id", "key", "start", "end").agg(
        F.max(F.col("base").cast("double")).alias("label"), F.sort_array(F.collect_set("kind")).alias("kinds"),
        *(F.first(c).alias(c) for c in names),
    ).withColumn("place", F.xxhash64("doc_id", "key", "start", "end"))
    # What overlaps a base span could not be added, so it says nothing: of the base spans that begin before it
    # ends, one ends after it begins.  Base spans stand at their start, others at their end and before those.
    right = F.col("label") == 1
    along = Window.partitionBy("doc_id", "key").orderBy(F.when(right, F.col("start")).otherwise(F.col("end")), "label")
    reach = F.max(F.when(right, F.col("end"))).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    each = each.withColumn("free", right | F.coalesce(reach <= F.col("start"), F.lit(True)))
    if sample is not None:
        each = each.orderBy("place", "doc_id").limit(sample)
    vectors = each.filter("free").groupBy(F.expr("place % 2 = 0").alias("learnt"), "label", "kinds", *names).agg(
        F.count("*").cast("double").alias("n")
    )
    vectors = save(vectors.sortWithinPartitions("label", "kinds", *names), "vectors")
    train, held = vectors.filter("learnt"), vectors.filter("NOT learnt")
    labels = {r.label: r.n for r in train.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    if len(labels) < 2:
        return found.withColumn("more", F.lit(False))
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    spans_learnt = sum(labels.values())
    leaf = max(1, int(LEAF * spans_learnt)) - 0.5  # a whole number of spans, whatever is rounded
    trees = GBTClassifier(
        maxIter=ROUNDS, maxDepth=DEPTH, minWeightFractionPerNode=leaf / spans_learnt, weightCol="n", seed=1,
    ).fit(assembler.transform(train))

    def score(rows: DataFrame) -> DataFrame:
        scored = trees.transform(assembler.transform(rows))
        return scored.withColumn("p", vector_to_array("probability")[1])

    # Per generator, blocks (right, all, lowest score) from the highest score down, merged until the share of
    # right ones falls from block to block; the last block with enough of them has the cut.
    bins = score(held).withColumn("kind", F.explode("kinds")).groupBy("kind", F.round("p", 3).alias("p"))
    blocks: dict[str, list[tuple[float, float, float]]] = {}
    for r in bins.agg(F.sum(F.col("label") * F.col("n")).alias("right"), F.sum("n").alias("n")).orderBy(F.desc("p")).collect():
        of_kind = blocks.setdefault(r.kind, [])
        of_kind.append((r.right, r.n, r.p))
        while len(of_kind) > 1 and of_kind[-1][0] * of_kind[-2][1] >= of_kind[-2][0] * of_kind[-1][1]:
            right, n, p = of_kind.pop()
            of_kind[-1] = (of_kind[-1][0] + right, of_kind[-1][1] + n, p)
    cuts = {kind: min((p for right, n, p in b if right >= precision * n), default=2.0) for kind, b in blocks.items()}
    cut = F.lit(2.0)
    for kind, p in cuts.items():
        cut = F.when(F.col("kind") == kind, F.lit(p)).otherwise(cut)
    return score(found.fillna(0.0, names)).withColumn(
        "more", (F.col("kind") != "row") & ~F.col("base") & (F.round("p", 3) >= cut)
    )


def op5_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
