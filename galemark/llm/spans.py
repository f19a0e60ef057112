"""Places of regular-expression matches in a text, with built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

SPAN = "array<struct<start:bigint,end:bigint,text:string>>"
#: Matches that are placed one after another; an array grows by copying, so longer lists go block by block.
BLOCK = 256


def spans(text: Column, pattern: str, valid: Callable[[Column, Column], Column] | None = None, group: int = 0) -> Column:
    """Leftmost non-overlapping matches of a pattern: start and end in code points, and the match.

    `valid(match, group)` drops matches after they are found, without a second try.  The pattern must
    not match nothing.  Matches and what lies between them come from the same left-to-right search, so
    their lengths add up to the places; texts without a match are searched once only.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast(SPAN)

    def placed(matches: Column) -> Column:
        inner = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
        each = F.arrays_zip(matches.alias("m"), inner.alias("g"), F.split(text, pattern, -1).alias("gap"))

        return _bound(each, lambda e: _bound(_blocks(e), lambda blocks: _bound(_begins(blocks), lambda begins: F.flatten(
            F.transform(blocks, lambda block, i: F.aggregate(
                block, F.struct(begins[i].alias("at"), none.alias("found")), step, lambda s: s["found"]
            ))
        ))))

    def step(seen: Column, x: Column) -> Column:
        start = seen["at"] + F.length(x["gap"])
        end = start + F.length(x["m"])
        good = valid(x["m"], x["g"]) if valid else F.lit(True)
        one = F.array(F.struct(start.alias("start"), end.alias("end"), x["m"].alias("text")))
        return F.struct(
            F.coalesce(end, start).alias("at"),
            F.when(F.coalesce(x["m"].isNotNull() & good, F.lit(False)), F.concat(seen["found"], one))
            .otherwise(seen["found"]).alias("found"),
        )

    # Bound to a lambda variable, so that the first search is not repeated.
    return F.flatten(F.transform(F.array(found), lambda m: F.when(F.size(m) > 0, placed(m)).otherwise(none)))


def _bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of an array as a lambda variable, so that it is worked out once."""
    return F.flatten(F.transform(F.array(value), then))


def _blocks(each: Column) -> Column:
    last = F.floor((F.size(each) - 1) / BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(each, i * BLOCK + 1, F.lit(BLOCK)))


def _begins(blocks: Column) -> Column:
    """Where each block begins in the text."""
    long = lambda block: F.aggregate(
        block, F.lit(0).cast("bigint"), lambda n, x: n + F.length(x["gap"]) + F.coalesce(F.length(x["m"]), F.lit(0))
    )
    zero = F.array(F.lit(0).cast("bigint"))
    return F.aggregate(F.transform(blocks, long), zero, lambda at, n: F.concat(at, F.array(F.element_at(at, -1) + n)))


def kind_of(found: Column, kind: str, number: int) -> Column:
    """Spans as (start, number, end, kind): sorting them sorts by place, then by the order of kinds."""
    return F.transform(
        found,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(number).alias("number"), s["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


def written(found: Column) -> Column:
    """Spans with kind, start and end as text: kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
