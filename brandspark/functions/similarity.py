"""Token and trigram similarity as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import words

#: Words that carry no meaning in a score, and in a word pattern.
SCORE_STOP = (
    "the a an of and for on inc inc. llc ltd ltd. co co. corp corporation company limited".split()
)
PATTERN_STOP = (
    "the a an of and for on behalf in to by inc inc. llc ltd ltd. co co. corp corp. corporation company limited group holdings et al al. "
    "gmbh sa s.a. srl plc pty pte pte."
).split()


def _bare(w: Column) -> Column:
    return F.regexp_replace(w, r"^[.,;]+|[.,;]+$", "")


def meaningful_tokens(c: Column) -> Column:
    long = F.filter(words(F.coalesce(c, F.lit(""))), lambda w: F.length(w) > 1)
    return F.array_except(F.array_distinct(F.transform(long, lambda w: _bare(F.lower(w)))), F.array(*[F.lit(x) for x in SCORE_STOP]))


def token_score(q: Column, c: Column) -> Column:
    """Share of the tokens ``q`` that ``c`` has; 0 without any."""
    return F.when(F.size(q) > 0, F.size(F.array_intersect(q, c)) / F.size(q)).otherwise(F.lit(0.0))


def match_score(query: Column, candidate: Column) -> Column:
    return token_score(meaningful_tokens(query), meaningful_tokens(candidate))


def pattern_words(c: Column) -> Column:
    """The first three meaningful words, without the signs at their ends; empty without any."""
    long = F.filter(words(c), lambda w: F.length(w) > 1)
    stop = F.array(*[F.lit(x) for x in PATTERN_STOP])
    own = F.filter(long, lambda w: ~F.array_contains(stop, _bare(F.lower(w))))
    return F.transform(F.slice(F.when(F.size(own) > 0, own).otherwise(long), 1, 3), _bare)


def word_boundary_pattern(c: Column) -> Column:
    """A pattern of the first three meaningful words, each bounded by word edges; null without any."""
    chosen = pattern_words(c)
    quote = lambda w: F.concat(F.lit(r"\Q"), F.replace(w, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    edge = F.transform(chosen, lambda w: F.concat(F.lit(r"(?<!\w)(?=\w)"), quote(w), F.lit(r"(?<=\w)(?!\w)")))
    return F.when(F.size(chosen) > 0, F.concat(F.lit("(?isU)"), F.array_join(edge, ".*")))


def trigrams(c: Column) -> Column:
    """Distinct trigrams of the lower-cased words, each padded with two spaces before and one behind."""
    parts = F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"(?U)[^\p{L}\p{N}]+"), lambda w: w != "")
    padded = F.transform(parts, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    grams = F.transform(padded, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3))))
    return F.array_distinct(F.flatten(grams))


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_union(a, b))
    return F.when(both > 0, F.size(F.array_intersect(a, b)) / both).otherwise(F.lit(0.0))


def trigram_similarity(a: Column, b: Column) -> Column:
    return jaccard(trigrams(a), trigrams(b))


def inner_grams(c: Column, n: int = 3) -> Column:
    """Lower-case runs of n characters of a string as it is: any string that contains it has all of them."""
    s = F.lower(c)
    m = F.length(s) - (n - 1)
    return F.array_distinct(F.when(m > 0, F.transform(F.sequence(F.lit(1), F.greatest(m, F.lit(1))), lambda i: F.substring(s, i, F.lit(n)))).otherwise(F.array().cast("array<string>")))
