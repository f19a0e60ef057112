"""Text expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# Whitespace is what Unicode calls so and the four ASCII separators.
_BLANK = r"\s\x1c-\x1f"
_BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        "
    "        　"
)


def normalize_text(text: Column) -> Column:
    """Lower-case ASCII letters, digits and whitespace of `text`, without links; null gives ''.

    Links are the runs that begin with http or www (case-sensitive, also inside a word).  Inner
    whitespace is kept as it is.
    """
    unlinked = F.regexp_replace(text, f"(?U)(?:http|www)[^{_BLANK}]+", "")
    plain = F.lower(F.regexp_replace(unlinked, f"(?U)[^a-zA-Z0-9{_BLANK}]+", ""))
    return F.coalesce(F.btrim(plain, F.lit(_BLANKS)), F.lit(""))


def tidy(text: Column) -> Column:
    """Lower case without surrounding blanks."""
    return F.lower(F.trim(text))


def city_name(text: Column) -> Column:
    """Comparable city: the part before the first comma, tidied ('Boston, USA' -> 'boston')."""
    return tidy(F.split_part(text, F.lit(","), F.lit(1)))


def city_literal(city: str) -> str:
    """`city_name` for a parameter."""
    return city.split(",")[0].strip().lower()


def mentions(text: Column, word: str) -> Column:
    """Whether lower-cased `text` contains `word`."""
    return F.lower(text).contains(word.lower())


def mentions_any(texts: Sequence[Column], words: Sequence[str]) -> Column:
    """Whether any of `texts` contains any of `words`, ignoring case; null text contains none."""
    tests = [F.coalesce(mentions(t, w), F.lit(False)) for t in texts for w in words]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def words_in(lowered: Column) -> Column:
    """The words of lower-case text: runs of letters, digits and underscores; null gives []."""
    return F.split(F.coalesce(lowered, F.lit("")), r"[^\p{L}\p{Nd}_]+")


def terms_in(lowered: Column, terms: Sequence[str], words: Column | None = None) -> Column:
    """The `terms` that stand as whole words in lower-case text, in order; null gives [].

    Of terms that overlap in the text the one that begins first counts, then the longest, so "west
    roxbury" does not name "Roxbury".  The words of the text (`words`, if known) are looked up in one
    pass; only a text that has all words of some term of several words is searched for places.
    """
    named = {t.lower(): t for t in reversed(terms)}
    names = F.create_map(*(F.lit(x) for pair in named.items() for x in pair))
    wanted = F.array(*(F.lit(t) for t in dict.fromkeys(t.lower() for t in terms)))
    parts = {t: re.findall(r"\w+", t) for t in named}
    several = [p for t, p in parts.items() if p != [t]]
    known = F.array(*(F.lit(w) for w in dict.fromkeys(w for p in parts.values() for w in p)))

    def found(held: Column) -> Column:
        if not several:
            return held
        longest = sorted(named, key=lambda t: (-len(t), t))
        pattern = r"\b(" + "|".join(map(re.escape, longest)) + r")\b"
        placed = F.regexp_extract_all(F.coalesce(lowered, F.lit("")), F.lit(pattern), 1)
        possible = reduce(lambda a, b: a | b, (
            reduce(lambda a, b: a & b, (F.array_contains(held, w) for w in p), F.lit(True)) for p in several
        ))
        return F.when(possible, placed).otherwise(held)

    # Bound to a lambda variable, so that the words are looked up once.
    held = F.array(F.array_intersect(known, words_in(lowered) if words is None else words))
    hits = F.flatten(F.transform(held, lambda h: F.array_intersect(wanted, found(h))))
    return F.transform(hits, lambda t: F.element_at(names, t))


def hashtags(text: Column) -> Column:
    """Whitespace-separated tokens that begin with '#', in order, repeats kept; null gives []."""
    tokens = F.split(F.coalesce(text, F.lit("")), f"(?U)[{_BLANK}]+")
    return F.filter(tokens, lambda token: token.startswith("#"))


def parent_id(link: Column) -> Column:
    """The second '_'-separated part of a link id ('t3_ab' -> 'ab'); null where there is none."""
    return F.try_element_at(F.split(link, "_"), F.lit(2))


def lower_each(values: Column) -> Column:
    """Every element in lower case."""
    return F.transform(values, F.lower)
