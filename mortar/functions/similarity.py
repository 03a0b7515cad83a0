"""Jaro-Winkler similarity as a column expression.

Matching window ``max(len) // 2 - 1``, transpositions halved with integer
division, Winkler boost ``prefix * 0.1 * (1 - jaro)`` for a common prefix of
up to 4 characters, applied when the Jaro similarity exceeds 0.7; an empty
string scores 0. Works on characters (code points).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the Winkler variant.
PREFIX_WEIGHT = 0.1
PREFIX_MAX = 4
BOOST_THRESHOLD = 0.7
# Overwrites a character that is taken: no character (U+FFFF is none in any text).
TAKEN = "\uffff"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _chars(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def _matched(a: Column, b: Column, b_text: Column) -> Column:
    """Places in ``b`` taken by the characters of ``a`` in turn, each the first free one in the window.

    A taken place is overwritten in the text, so the next search is one ``locate``.
    """
    window = F.greatest(F.floor(F.greatest(F.size(a), F.size(b)) / 2) - 1, F.lit(0)).cast("int")
    start = F.struct(b_text.alias("rest"), F.expr("cast(array() as array<int>)").alias("taken"))

    def take(acc: Column, i: Column, w: Column) -> Column:
        low = F.greatest(i - w, F.lit(0))
        near = F.substring(acc["rest"], low + 1, F.least(i + w, F.size(b) - 1) - low + 1)
        return _let(
            F.call_function("locate", F.get(a, i), near),
            lambda at: F.when(
                at > 0,
                F.struct(
                    F.overlay(acc["rest"], F.lit(TAKEN), low + at, F.lit(1)).alias("rest"),
                    F.concat(acc["taken"], F.array(low + at - 1)).alias("taken"),
                ),
            ).otherwise(acc),
        )

    each = F.sequence(F.lit(0), F.size(a) - 1)
    return _let(window, lambda w: F.aggregate(each, start, lambda acc, i: take(acc, i, w), lambda acc: acc["taken"]))


def _jaro(a: Column, b: Column, b_text: Column) -> Column:
    """Of two non-empty lists of characters; both ways of matching take as many, in the order of either side."""

    def similarity(in_b: Column) -> Column:
        m = F.size(in_b).cast("double")
        # the characters of a that found a place are those in b, in a's order
        of_a = F.transform(in_b, lambda j: F.get(b, j))
        of_b = F.transform(F.array_sort(in_b), lambda j: F.get(b, j))
        moved = F.size(F.filter(F.zip_with(of_a, of_b, lambda x, y: x != y), lambda x: x))
        halved = F.floor(moved / 2).cast("double")
        total = m / F.size(a) + m / F.size(b) + (m - halved) / m
        return F.when(F.size(in_b) == 0, F.lit(0.0)).otherwise(total / F.lit(3.0))

    return _let(_matched(a, b, b_text), similarity)


def jaro_winkler(a: Column, b: Column) -> Column:
    """0.0 to 1.0; NULL in, NULL out."""

    def boosted(x: Column, y: Column, sim: Column) -> Column:
        prefix = F.lit(PREFIX_MAX)
        for i in reversed(range(PREFIX_MAX)):
            same = F.coalesce(F.get(x, F.lit(i)) == F.get(y, F.lit(i)), F.lit(False))
            prefix = F.when(~same, F.lit(i)).otherwise(prefix)
        return F.when(sim > BOOST_THRESHOLD, sim + prefix * F.lit(PREFIX_WEIGHT) * (F.lit(1.0) - sim)).otherwise(sim)

    compared = _let(_chars(a), lambda x: _let(_chars(b), lambda y: _let(_jaro(x, y, b), lambda sim: boosted(x, y, sim))))
    return (
        F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
        .when((a == "") | (b == ""), F.lit(0.0))
        .when(a == b, F.lit(1.0))
        .otherwise(compared)
    )


def similarity_score(a: Column, b: Column) -> Column:
    """0..100 integer score (floor of 100 x Jaro-Winkler); NULL in, NULL out."""
    return F.floor(F.lit(100.0) * jaro_winkler(a, b)).cast("int")
