"""Exact dedup by skew-safe combining of salted digest groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, explode_salts, free_name, salt_of, salts_seen, text_or_empty

SALTS = 32
RESULT = ("keep_id", "group_size", "kept", "text_digest")


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise=ascii_lower,
    digest=_digest,
    salts: int = SALTS,
    result: tuple[str, str, str, str] = RESULT,
) -> DataFrame:
    """Mark, among rows of equal text, the one with the largest id.

    Three combining steps, each of which compares whole texts, as the text is a
    grouping key beside its digest:

    1. inside a task (Spark's partial aggregation) equal texts of one salt become one row;
    2. the salted digest groups (digest, salt, text) of all tasks are merged, so copies of a
       hot text meet in ``salts`` places instead of one;
    3. the winners of the salts, at most ``salts`` rows a text, are combined globally.

    The decision goes back to the rows over (digest, salt), again salted, and only narrow
    rows travel there. That join goes by the digest; should two texts ever share one, the
    job stops with an error instead of mixing them.

    Returns every column of ``docs`` but those named like a result column, plus ``keep_id``,
    ``group_size`` (long), ``kept`` and ``text_digest`` (of the normalised text), or what
    ``result`` calls them.
    Defined results: a null text counts as empty and equals the empty text; a null id is
    smaller than any other; of rows that repeat the winning id with an equal text one is
    kept; an empty table gives an empty result; no other column of ``docs`` is looked at.
    """
    names = [c for c in docs.columns if c not in result]
    carried = [f"_c{i}" for i in range(len(names))]
    hashable = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    rows = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(names, carried)],
        F.col(f"`{id_col}`").alias("_id"),
        F.xxhash64(*hashable).alias("_tie"),
        normalise(text_or_empty(F.col(f"`{text_col}`"))).alias("_text"),
    )
    # coalesce: without nulls the joins below need no filter that works the digest out again
    rows = rows.withColumn("_digest", F.coalesce(digest(F.col("_text")), F.lit("")))
    rows = rows.withColumn("_salt", F.coalesce(salt_of([F.col("_id")], salts), F.lit(0)))
    merged = rows.groupBy("_digest", "_salt", "_text").agg(F.max("_id").alias("_top"), F.count(F.lit(1)).alias("_n"))
    winners = (
        merged.repartition("_digest")
        .groupBy("_digest", "_text")
        .agg(F.max("_top").alias("keep_id"), F.sum("_n").alias("group_size"), salts_seen(F.col("_salt"), salts).alias("_salts"))
    )
    classes = (
        winners.groupBy("_digest")
        .agg(
            F.count(F.lit(1)).alias("_classes"),
            F.max("keep_id").alias("keep_id"),
            F.max("group_size").alias("group_size"),
            F.bit_or("_salts").alias("_salts"),
        )
        .select(
            "_digest",
            "keep_id",
            "group_size",
            # the join goes by the salt, so no choice of columns leaves the guard out
            explode_salts(
                F.when(F.col("_classes") == 1, F.col("_salts")).otherwise(
                    F.raise_error(F.concat(F.lit("two texts share the digest "), F.col("_digest"))).cast("long")
                ),
                salts,
            ).alias("_salt"),
        )
    )
    decided = rows.drop("_text").join(classes, ["_digest", "_salt"])
    top = F.col("_id").eqNullSafe(F.col("keep_id"))
    first = F.row_number().over(Window.partitionBy("_digest", "_salt", "_id").orderBy("_tie"))
    return decided.withColumn("kept", top & (first == 1)).select(
        *[F.col(n).alias(c) for c, n in zip(names, carried)],
        *[F.col(n).alias(c) for c, n in zip(result, ("keep_id", "group_size", "kept", "_digest"))],
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise=ascii_lower, digest=_digest) -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with the columns they have."""
    result = tuple(free_name(docs, f"_{n}") for n in RESULT)
    return exact_dedup(docs, id_col, text_col, normalise, digest, result=result).where(F.col(result[2])).drop(*result)
