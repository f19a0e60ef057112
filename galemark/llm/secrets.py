"""Secret scan with multipart credential linking, in built-in expressions.

Strong patterns are secrets by themselves.  Weak parts (a user name, a key-like string, an endpoint)
are reported only where complementary parts stand within one scope of them.  Parts are joined as
intervals: a part, widened by the scope, meets another in the slice of the text in which the later of
their begins lies, so a pair is made once, and a part is paired only with what fits into its scope.
Each secret with what it meets nearest is one credential.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from galemark.llm.common import column, save, table, text_key
from galemark.llm.spans import kind_of, spans, written

#: Characters between parts that can belong together.
SCOPE = 200

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run is matched whole, so asking for its length at once finds the same runs.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
ENDPOINT = r"""https?://[^\x20\x09-\x0D"'<>]+"""
IDENTIFIER = r"""(?i)(?<![A-Za-z0-9_])(?:user(?:_?name)?|login|client_?id|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}+"""
KEY = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{32,}+={0,2}"

BASE = ("assign", "access", "hex")
#: Kinds in order; the role that each plays in a credential.
KINDS = {"assign": "secret", "access": "identity", "hex": "secret", "endpoint": "place", "identifier": "identity", "key": "secret"}
_PART = ("doc_id", "key", "start", "number", "end", "kind")


def parts_of(text: Column) -> Column:
    """All strong spans and weak candidates of a text."""
    mixed = lambda m, _: m.rlike("[0-9]") & m.rlike("[a-z]") & m.rlike("[A-Z]")
    found = {
        "assign": spans(text, ASSIGN, lambda _, value: F.length(value) >= 6, 2),
        "access": spans(text, ACCESS), "hex": spans(text, HEX), "endpoint": spans(text, ENDPOINT),
        "identifier": spans(text, IDENTIFIER), "key": spans(text, KEY, mixed),
    }
    return F.concat(*(kind_of(found[k], k, i) for i, k in enumerate(KINDS)))


def _role(kind: str) -> Column:
    found = F.lit(None).cast("string")
    for k, role in KINDS.items():
        found = F.when(F.col(kind) == k, F.lit(role)).otherwise(found)
    return found


def linked(parts: DataFrame, scope: int) -> DataFrame:
    """The parts (doc_id, key, start, number, end, kind) with what they meet within `scope`.

    Adds near_secret, near_identity and near_place (whether such a part is near), `covered` (a strong
    part overlaps) and the nearest identity and place (of equally near ones the first).
    """
    # Both sides lie in all slices that they touch; a pair counts in one of them.
    part_of = lambda at: F.floor(at / F.lit(scope + 1))
    left = parts.withColumn("role", _role("kind")).withColumn(
        "slice", F.explode(F.sequence(part_of(F.col("start") - scope), part_of(F.col("end") + scope)))
    )
    other = parts.filter(F.col("kind").isin(*KINDS)).select(
        F.col("doc_id").alias("o_doc"), F.col("key").alias("o_key"), F.col("start").alias("o_start"), F.col("number").alias("o_number"),
        F.col("end").alias("o_end"), F.col("kind").alias("o_kind"), _role("kind").alias("o_role"),
        F.explode(F.sequence(part_of(F.col("start")), part_of(F.col("end")))).alias("o_slice"),
    )
    strong = F.col("o_kind").isin(*BASE)
    meets = (
        F.col("doc_id").eqNullSafe(F.col("o_doc")) & (F.col("key") == F.col("o_key")) & (F.col("slice") == F.col("o_slice"))
        & (F.col("o_start") - F.col("end") <= scope) & (F.col("start") - F.col("o_end") <= scope)
        & (F.col("slice") == part_of(F.greatest(F.col("start") - scope, F.col("o_start"))))
        & ((F.col("role") != F.col("o_role")) | ((F.col("kind") == "key") & strong))
    )
    gap = F.greatest(F.lit(0), F.col("o_start") - F.col("end"), F.col("start") - F.col("o_end"))
    one = F.struct(
        gap.alias("gap"), F.col("o_start").alias("start"), F.col("o_number").alias("number"), F.col("o_end").alias("end"), F.col("o_kind").alias("kind")
    )
    near = lambda role: (F.col("role") != F.col("o_role")) & (F.col("o_role") == role)
    yes = lambda test, name: F.coalesce(F.bool_or(test), F.lit(False)).alias(name)
    overlaps = strong & (F.col("o_start") < F.col("end")) & (F.col("start") < F.col("o_end")) & (F.col("o_kind") != F.col("kind"))
    return left.join(other, meets, "left").groupBy(*_PART, "times").agg(
        *(yes(near(role), f"near_{role}") for role in ("secret", "identity", "place")), yes(overlaps, "covered"),
        *(F.min(F.when(near(role), one)).alias(role) for role in ("identity", "place")),
    )


def credentials(docs: DataFrame, scope: int = SCOPE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, n_linked, base_sha256, spans, credentials.

    Strong spans are assign (a value of 6 characters or more given to a secret name), access and hex.
    A key-like string is reported if an identity or an endpoint is within `scope` characters, an
    identifier if a secret is, an endpoint if both are; a key-like string inside a strong span is
    part of that.  `credentials` are the secrets that have an identity or an endpoint within the scope,
    by place: secret+identity+endpoint, each as kind:start:end, the nearest of a role (of equally near
    ones the first), comma-joined; a missing part is left out.  A null text is empty; a text without
    spans has the hash of the empty string.  Repeated rows give a row each.  An empty table gives no rows.
    """
    text = F.coalesce(column(docs, text_column, "string"), F.lit(""))
    marker = F.struct(
        F.lit(-1).cast("bigint").alias("start"), F.lit(-1).alias("number"), F.lit(-1).cast("bigint").alias("end"), F.lit("row").alias("kind")
    )
    each = docs.select(
        column(docs, id_column, "long").alias("doc_id"), text_key(column(docs, text_column, "string")).alias("key"),
        F.explode(F.concat(F.array(marker), parts_of(text))).alias("part"),
    ).select("doc_id", "key", "part.*")
    # Repeated rows have the same parts and are joined once.  Written, as both sides of the join read it.
    parts = save(each.groupBy(*_PART).agg(F.count("*").alias("times")), "parts")

    kind = F.col("kind")
    weak = (
        F.when(kind == "key", ~F.col("covered") & (F.col("near_identity") | F.col("near_place")))
        .when(kind == "identifier", F.col("near_secret"))
        .when(kind == "endpoint", F.col("near_secret") & F.col("near_identity"))
    )
    base = kind.isin(*BASE)
    secret = kind.isin("assign", "hex") | ((kind == "key") & ~F.col("covered"))
    one = F.struct("start", "number", "end", "kind")
    whole = F.struct("start", "number", F.concat_ws(
        "+", *(F.when(p["start"].isNotNull(), F.concat_ws(":", p["kind"], p["start"], p["end"])) for p in (one, F.col("identity"), F.col("place")))
    ).alias("line"))
    rows = linked(parts, scope).groupBy("doc_id", "key").agg(
        F.max(F.when(kind == "row", F.col("times"))).cast("int").alias("times"),
        F.sort_array(F.collect_list(F.when(base, one))).alias("strong"),
        F.sort_array(F.collect_list(F.when(base | weak, one))).alias("every"),
        F.sort_array(F.collect_list(F.when(secret & (F.col("near_identity") | F.col("near_place")), whole))).alias("whole"),
    )
    count = lambda kind: F.size(F.filter("strong", lambda s: s["kind"] == kind)).cast("long")
    return rows.select(
        F.explode(F.sequence(F.lit(1), F.col("times"))).alias("_"), "doc_id",
        *(count(k).alias(f"n_{k}") for k in BASE),
        (F.size("every") - F.size("strong")).cast("long").alias("n_linked"),
        F.sha2(F.encode(written(F.col("strong")), "UTF-8"), 256).alias("base_sha256"), written(F.col("every")).alias("spans"),
        F.array_join("whole.line", ",").alias("credentials"),
    ).drop("_")


def op4_secret_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials(table(spark, sf_dir, "documents"))
