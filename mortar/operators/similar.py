"""Similarity join of strings: every pair whose Jaro-Winkler score exceeds a threshold.

No pair is formed unless the two strings can reach the threshold. Matched characters are at
most the characters that both strings hold, so with ``c`` shared characters (with repeats),
lengths ``n`` and ``m``, and ``p`` equal first characters (4 at most)

    jaro <= (c / n + c / m + 1) / 3,    score <= jaro + p * 0.1 * (1 - jaro)

and a score over the threshold needs a least jaro, hence a least ``c`` and a least ratio of the
lengths. A string is taken as the set of its characters numbered by occurrence (``e1``, ``e2``),
ordered from rare to frequent. If two such sets share ``c`` of them, the rarest shared one
stands among the first ``n - c + 1`` of the one and ``m - c + 1`` of the other. Those are the
index: strings meet under (length class, length class, character), and a pair counts only where
it meets under its rarest shared character, so each is found once and nothing is deduplicated.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import BOOST_THRESHOLD, PREFIX_MAX, PREFIX_WEIGHT, similarity_score
from ..sources.sinks import materialize

#: Guards the ceilings below against the last bits of doubles; a lower bound that is too low only costs time.
EPS = 1e-9
#: The most frequent characters that are ranked by their counts; rarer ones go by their code.
RANKED = 256
#: Lengths in [2^k, 2^(k+1)) are one class.
CLASSES = 31
#: Strings of the left side that meet one copy of a key's right side.
KEY_ROWS = 10_000


def least_jaro(threshold: int, prefix: int = PREFIX_MAX) -> float:
    """The jaro similarity that a score over ``threshold`` needs at least, with ``prefix`` equal first characters."""
    least = (threshold + 1) / 100
    if least <= BOOST_THRESHOLD:
        return least
    weight = PREFIX_WEIGHT * prefix
    return max(BOOST_THRESHOLD, (least - weight) / (1 - weight))


def least_ratio(jaro: float) -> float:
    """Of the shorter to the longer length: all its characters shared, ``1 + n / m + 1 >= 3 * jaro``."""
    return max(0.0, 3 * jaro - 2)


def least_shared(jaro: Column | float, n: Column, m: Column) -> Column:
    """Characters that two strings of these lengths must share."""
    needed = (F.lit(3.0) * jaro - 1) * n * m / (n + m)
    return F.greatest(F.lit(1), F.ceil(needed - EPS)).cast("int")


def numbered_characters(text: Column) -> Column:
    """The characters of a text in order, numbered by occurrence: a set."""
    chars = F.array_sort(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)))
    numbered = lambda c: F.transform(c, lambda x, i: F.concat(x, (i - F.array_position(c, x) + 2).cast("string")))
    return F.element_at(F.transform(F.array(chars), numbered), 1)


def length_class(n: Column) -> Column:
    return F.length(F.bin(n.cast("long"))) - 1


@dataclasses.dataclass
class Side:
    """Distinct non-empty strings: (text, n, tokens), tokens from rare to frequent."""

    rows: DataFrame

    def index(self, jaro: float, own: str, other: str) -> DataFrame:
        """(own, other, token, text, n, tokens): the keys under which a string can meet a partner."""
        n, ratio = F.col("n"), least_ratio(jaro)

        def key(k: Column) -> Column:
            low = F.call_function("shiftleft", F.lit(1).cast("long"), k)
            high = low * 2 - 1
            nearest = F.greatest(low, F.ceil(n * ratio - EPS))
            shared = least_shared(jaro, n, nearest)
            possible = (nearest <= high) & (nearest * ratio <= n + EPS) & (shared <= n) & (shared <= high)
            return F.struct(k.alias("k"), (n - shared + 1).alias("take"), possible.alias("possible"))

        classes = F.filter(F.transform(F.sequence(F.lit(0), F.lit(CLASSES - 1)), key), lambda x: x["possible"])
        each = self.rows.select("*", length_class(n).alias(own), F.explode(classes).alias("_c"))
        return each.select(own, F.col("_c.k").alias(other), F.explode(F.slice("tokens", F.lit(1), F.col("_c.take"))).alias("token"), "text", "n", "tokens")


def _distinct(df: DataFrame, column: str) -> DataFrame:
    text = F.col(column).cast("string")
    return df.select(text.alias("text")).where(text != "").distinct().withColumn("n", F.length("text"))


def sides(left: DataFrame, a: str, right: DataFrame, b: str, threshold: int) -> tuple[Side, Side]:
    """The distinct strings of both columns that have a length for which a partner can exist, with ordered tokens."""
    ratio = least_ratio(least_jaro(threshold))
    x, y = _distinct(left, a), _distinct(right, b)
    bounds = y.agg(F.min("n"), F.max("n")).first()
    if bounds[0] is not None:
        # a text far longer than any of the other side is not looked at, whatever it holds
        x = x.where((F.col("n") >= bounds[0] * ratio - EPS) & (F.col("n") * ratio <= bounds[1] + EPS))
    # strings are narrow but dear to index: dealt out evenly, whatever their bytes
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = materialize(x.repartition(parts).withColumn("tokens", numbered_characters(F.col("text"))), "similar-left")
    y = materialize(y.withColumn("tokens", numbered_characters(F.col("text"))), "similar-right")
    tokens = x.select(F.explode("tokens").alias("t")).unionAll(y.select(F.explode("tokens").alias("t")))
    often = [r["t"] for r in tokens.groupBy("t").count().orderBy(F.desc("count"), "t").limit(RANKED).collect()]
    # rank 0 for what isn't among them; the most frequent comes last
    ranks = F.map_from_arrays(F.lit(often[::-1]), F.lit(list(range(1, len(often) + 1)))) if often else None
    rank = (lambda t: F.coalesce(F.try_element_at(ranks, t), F.lit(0))) if often else (lambda t: F.lit(0))
    ordered = F.array_sort(F.transform("tokens", lambda t: F.struct(rank(t).alias("r"), t.alias("t"))))
    by_rank = F.transform(ordered, lambda s: s["t"])
    return Side(x.withColumn("tokens", by_rank)), Side(y.withColumn("tokens", by_rank))


def candidates(left: DataFrame, a: str, right: DataFrame, b: str, threshold: int) -> DataFrame:
    """(a, b): pairs that pass the bounds, each once; a superset of those over the threshold.

    A key that many strings of the left side share is cut: they are dealt over so many salts
    that each has about ``KEY_ROWS``, and the key's strings of the right side are copied to them.
    """
    jaro = least_jaro(threshold)
    x, y = sides(left, a, right, b, threshold)
    keys, copied = ["ka", "kb", "token"], ["text", "n", "tokens"]
    ix, iy = x.index(jaro, "ka", "kb"), y.index(jaro, "kb", "ka")
    sizes = ix.groupBy(*keys).count().join(iy.select(*keys).distinct(), keys)
    salts = materialize(sizes.select(*keys, F.ceil(F.col("count") / KEY_ROWS).cast("int").alias("salts")), "similar-keys")
    named = lambda df, s: df.select(*keys, "salt", *[F.col(c).alias(f"{c}_{s}") for c in copied])
    dealt = named(ix.join(salts, keys).withColumn("salt", F.pmod(F.xxhash64("text"), F.col("salts")).cast("int")), "a")
    spread = named(iy.join(salts, keys).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))), "b")
    met = dealt.join(spread, [*keys, "salt"])
    shared = F.array_intersect("tokens_a", "tokens_b")
    needed = F.lit(least_jaro(threshold, 0))
    for p in range(1, PREFIX_MAX + 1):
        same = F.substring("text_a", 1, p) == F.substring("text_b", 1, p)
        needed = F.when(same, F.lit(least_jaro(threshold, p))).otherwise(needed)
    enough = F.size(shared) >= least_shared(needed, F.col("n_a"), F.col("n_b"))
    found = met.where((F.element_at(shared, 1) == F.col("token")) & enough)
    return found.select(F.col("text_a").alias(a), F.col("text_b").alias(b))


def similar_pairs(left: DataFrame, a: str, right: DataFrame, b: str, threshold: int, score: str = "score") -> DataFrame:
    """(a, b, score): every pair of distinct values whose ``similarity_score`` exceeds ``threshold`` (0 to 99).

    NULL and empty strings match nothing. Repeated values are one. ``a`` and ``b`` must be
    different names.
    """
    if not 0 <= threshold <= 99 or a == b:
        raise ValueError("threshold must be from 0 to 99 and the columns' names must differ")
    pairs = candidates(left, a, right, b, threshold)
    scored = F.filter(F.array(similarity_score(F.col(a), F.col(b))), lambda s: s > threshold)
    return pairs.select(a, b, F.explode(scored).alias(score))
