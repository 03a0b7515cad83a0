"""Semi-structured and text operators: JSON export rows to typed rows, JSON
lists to rows, and branded / unbranded classification of search terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import round_half_up
from ..functions.similarity import similarity_score
from ..sources.sinks import materialize

# Search-console export row: {"keys": [...], "clicks", "impressions", "ctr", "position"}.
# Numbers are read as text and cast, so 3 and "3" are the same, as in the reference's casts.
SEARCH_ROW = T.StructType(
    [
        T.StructField("keys", T.ArrayType(T.StringType())),
        T.StructField("clicks", T.StringType()),
        T.StructField("impressions", T.StringType()),
        T.StructField("ctr", T.StringType()),
        T.StructField("position", T.StringType()),
    ]
)
SEARCH_DOC = T.StructType([T.StructField("rows", T.ArrayType(SEARCH_ROW))])

# Position buckets and classification labels / threshold.
POSITION_BUCKETS = [(3, "Top 3"), (10, "Top 10"), (20, "Top 20")]
POSITION_OTHER = "Below 20"
BRANDED, UNBRANDED = "Branded", "Unbranded"
BRAND_THRESHOLD = 70
DOMAIN_AFFIXES = r"^www\.|\.com$"


def explode_json_rows(df: DataFrame, json_col: str, keep: list[str]) -> DataFrame:
    """``lateral flatten(parse_json(c):rows)``: one row per element (inner:
    NULL documents and those without rows produce none). A malformed document
    fails the query, as ``parse_json`` does; ``malformed_json`` tells them
    beforehand."""
    doc = F.from_json(F.col(json_col), SEARCH_DOC, {"mode": "FAILFAST"})
    return df.select(*keep, F.explode(doc["rows"]).alias("_row"))


def malformed_json(json_col: str) -> Column:
    """Whether a document is there but is not a JSON object with rows of the expected shape."""
    marked = T.StructType([*SEARCH_DOC.fields, T.StructField("_bad", T.StringType())])
    doc = F.from_json(F.col(json_col), marked, {"columnNameOfCorruptRecord": "_bad"})
    return F.col(json_col).isNotNull() & (doc.isNull() | doc["_bad"].isNotNull())


def json_double(c: Column) -> Column:
    """JSON number, also as a string, to double; text that is no number fails."""
    return c.cast("double")


def json_int(c: Column) -> Column:
    """JSON number to integer, rounding like a warehouse ``::integer`` cast."""
    return F.round(json_double(c)).cast("int")


def explode_json_list(df: DataFrame, json_col: str, out: str) -> DataFrame:
    """JSON list column to one trimmed string per element (inner unnest:
    NULL, empty or malformed lists produce no rows)."""
    items = F.explode(F.from_json(F.col(json_col), T.ArrayType(T.StringType())))
    return df.select("*", items.alias("_mortar_v")).withColumn(out, F.trim("_mortar_v")).drop("_mortar_v")


def position_bucket(position: Column) -> Column:
    expr = None
    for limit, label in POSITION_BUCKETS:
        expr = F.when(position <= limit, label) if expr is None else expr.when(position <= limit, label)
    return expr.otherwise(POSITION_OTHER)


def brand_of_domain(domain: Column) -> Column:
    """``lower(regexp_replace(domain, '^www\\.|\\.com$', ''))``."""
    return F.lower(F.regexp_replace(domain, DOMAIN_AFFIXES, ""))


def brand_scores(df: DataFrame, term: str, domain: str) -> DataFrame:
    """The dictionary of ``classify_terms``: (term, domain, n, score), a row for each distinct pair.

    Rows are counted by pair before any shuffle, so only distinct pairs move and
    are scored; they are dealt out evenly first, as scoring is the costly part.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = df.groupBy(F.col(term).alias("term"), F.col(domain).alias("domain")).agg(F.count(F.lit(1)).alias("n")).repartition(parts)
    return pairs.withColumn("score", similarity_score(F.lower("term"), brand_of_domain(F.col("domain"))).cast("long"))


#: A pair is hot when it holds more than this share of all rows, so there are fewer than its inverse.
HOT_SHARE = 0.001
#: A dictionary of so many bytes of text at most goes to all rows as it is.
SMALL_BYTES = 8 << 20


def classify_terms(df: DataFrame, term: str, domain: str, threshold: int = BRAND_THRESHOLD) -> DataFrame:
    """Add ``brand_similarity_score`` (0..100) and ``search_type``.

    A term is Branded when its Jaro-Winkler score against the domain's brand
    exceeds ``threshold``. Each distinct (term, domain) is scored once
    (``brand_scores``, written to the shared folder) and its score returns to
    the rows. A dictionary of up to ``SMALL_BYTES``, measured as it is written, is
    broadcast, and no row moves. A larger one is joined by pair, but for hot
    pairs: there are at most 1 / ``HOT_SHARE`` of them, which are broadcast, while their
    rows are spread over keys that match nothing.
    """
    seen = Observation()
    size = F.coalesce(F.octet_length("term"), F.lit(0)) + F.coalesce(F.octet_length("domain"), F.lit(0)) + 24
    watched = brand_scores(df, term, domain).observe(seen, F.sum("n").alias("n"), F.sum(size).alias("bytes"))
    scores = materialize(watched, "brand-scores").select(F.col("term").alias("_t"), F.col("domain").alias("_d"), F.col("n").alias("_n"), F.col("score").alias("_score"))
    same = F.col(term).eqNullSafe(F.col("_t")) & F.col(domain).eqNullSafe(F.col("_d"))
    if (seen.get["bytes"] or 0) <= SMALL_BYTES:
        score = F.col("_score")
        found = df.join(F.broadcast(scores), same, "left")
    else:
        most = seen.get["n"] * HOT_SHARE
        hot = scores.where(F.col("_n") > most).select("_t", "_d", F.col("_score").alias("_hot"), F.lit(True).alias("_is_hot"))
        cold = scores.where(F.col("_n") <= most).select("_t", "_d", F.col("_score").alias("_cold"), F.lit(-1).cast("long").alias("_s"))
        marked = df.join(F.broadcast(hot), same, "left").drop("_t", "_d")
        spread = marked.withColumn("_spread", F.when(F.col("_is_hot"), F.monotonically_increasing_id()).otherwise(-1))
        found = spread.join(cold, same & (F.col("_spread") == F.col("_s")), "left")
        score = F.coalesce("_hot", "_cold")
    scored = found.select(*df.columns, score.alias("brand_similarity_score"))
    return scored.withColumn("search_type", F.when(F.col("brand_similarity_score") > threshold, BRANDED).otherwise(UNBRANDED))


def search_rows(stg_export: DataFrame) -> DataFrame:
    """Typed search rows of the export documents (first key as the term)."""
    keep = ["restaurant_id", "domain", "updated_at", "created_at", "status"]
    rows = explode_json_rows(stg_export, "data", keep)
    r = F.col("_row")
    return rows.select(
        *keep,
        F.try_element_at(r["keys"], F.lit(1)).alias("search_term"),
        json_int(r["clicks"]).alias("clicks"),
        json_int(r["impressions"]).alias("impressions"),
        json_double(r["ctr"]).alias("ctr"),
        json_double(r["position"]).alias("position"),
    )


def search_terms(stg_export: DataFrame) -> DataFrame:
    """int_gsc_search_terms: rounded metrics, flags, bucket and classification."""
    out = search_rows(stg_export).select(
        "restaurant_id",
        "domain",
        "updated_at",
        "created_at",
        "status",
        "search_term",
        "clicks",
        "impressions",
        round_half_up("ctr", 2).alias("ctr"),
        round_half_up("position", 2).alias("avg_position"),
        F.coalesce(F.col("clicks") > 0, F.lit(False)).alias("has_clicks"),
        position_bucket(F.col("position")).alias("position_bucket"),
    )
    classified = classify_terms(out, "search_term", "domain")
    return classified.select(*out.columns, "search_type", "brand_similarity_score")
