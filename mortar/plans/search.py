"""Search-console marts: staged exports, classified search terms, metrics
per restaurant (overall / branded / unbranded, wide) and per cuisine.

Averages and medians of 2-decimal metrics are computed on integer
hundredths, so rounding is exact and independent of summation order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import round_ratio, round_ratio_units
from ..operators.similar import similar_pairs
from ..operators.text import BRAND_THRESHOLD, BRANDED, UNBRANDED, brand_of_domain, explode_json_list, search_terms as _search_terms
from ..sources.sinks import materialize

OVERALL = "Overall"
TYPES = [OVERALL, BRANDED, UNBRANDED]
# Metric names, their output aliases and which are rounded means.
METRICS = [
    "unique_search_terms", "total_clicks", "total_impressions",
    "avg_ctr", "avg_position", "median_ctr", "median_position",
    "clicks_top_3", "clicks_top_10", "clicks_top_20",
    "terms_top_3", "terms_top_10", "terms_top_20",
]
ALIASES = {"unique_search_terms": "unique_terms", "total_clicks": "clicks", "total_impressions": "impressions"}
MEANS = ["avg_ctr", "avg_position", "median_ctr", "median_position"]
SUMS = [m for m in METRICS if m not in MEANS]
TOP = [3, 10, 20]
# Share columns: (metric, output name), as branded / unbranded over overall.
SHARES = [("total_clicks", "clicks"), ("total_impressions", "impressions"), ("unique_search_terms", "search_terms")]


def wide(t: str, m: str) -> str:
    return f"{t.lower()}_{ALIASES.get(m, m)}"


def _shares() -> list[Column]:
    """round(type metric::float / nullif(overall metric, 0), 2)."""
    return [
        round_ratio(wide(ty, m), wide(OVERALL, m), 2).alias(f"{ty.lower()}_{name}_pct")
        for m, name in SHARES
        for ty in (BRANDED, UNBRANDED)
    ]


def _units(c: Column | str) -> Column:
    """A 2-decimal double as integer hundredths."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col * 100).cast("long")


def _mean_units(total: Column, n: Column) -> Column:
    """round(avg, 2) in hundredths, from a sum of hundredths and a count."""
    return F.when(n > 0, round_ratio_units(total, n * 100, 2))


def _median_units(m: Column) -> Column:
    """round(median, 2) in hundredths; m is a median of hundredths (x or x.5)."""
    return F.when(m.isNotNull(), (F.signum(m) * F.floor(F.abs(m) + 0.5)).cast("long"))


# --------------------------------------------------------------------------- staging


def stg_search_export(export: DataFrame) -> DataFrame:
    return export.select(
        "restaurant_id",
        "domain",
        F.col("_updated_at").alias("updated_at"),
        F.col("_created_at").alias("created_at"),
        "status",
        "data",
    )


def stg_cuisines(cuisines: DataFrame) -> DataFrame:
    return cuisines.select("restaurant_id", "cuisines")


def search_terms(stg_export: DataFrame) -> DataFrame:
    return _search_terms(stg_export)


# --------------------------------------------------------------------------- other brands


def other_brand_terms(terms: DataFrame, threshold: int = BRAND_THRESHOLD) -> DataFrame:
    """Where searches for another restaurant's brand turn up a restaurant.

    One row per (restaurant_id, domain, search_term) and other domain whose brand the
    term resembles: (.., other_domain, brand_similarity_score, n_rows, clicks, impressions).
    All brands of the table are compared with all terms, by a similarity join of
    the distinct strings (``similar_pairs``). Sums ignore NULLs; a NULL term
    matches nothing; a restaurant without a domain is met by every brand.
    """
    asked = terms.groupBy("restaurant_id", "domain", "search_term").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("clicks").cast("long").alias("clicks"), F.sum("impressions").cast("long").alias("impressions")
    )
    asked = materialize(asked.withColumn("_term", F.lower("search_term")), "asked-terms")
    brands = asked.select(F.col("domain").alias("other_domain"), brand_of_domain(F.col("domain")).alias("_brand")).distinct()
    pairs = similar_pairs(asked, "_term", brands, "_brand", threshold, score="brand_similarity_score")
    met = asked.join(pairs.join(brands, "_brand"), "_term").where(~F.col("domain").eqNullSafe(F.col("other_domain")))
    return met.select(
        "restaurant_id", "domain", "search_term", "other_domain", F.col("brand_similarity_score").cast("long").alias("brand_similarity_score"),
        "n_rows", "clicks", "impressions",
    )


# --------------------------------------------------------------------------- restaurant metrics


def term_metrics(terms: DataFrame) -> DataFrame:
    """Metrics per (restaurant_id, domain, search_type), means in hundredths."""
    pos_u = _units("avg_position")
    ctr_u = _units("ctr")
    t = terms.select("restaurant_id", "domain", "search_type", "search_term", "clicks", "impressions",
                     ctr_u.alias("_ctr"), pos_u.alias("_pos"))
    aggs = [
        F.count_distinct("search_term").alias("unique_search_terms"),
        F.sum("clicks").cast("long").alias("total_clicks"),
        F.sum("impressions").cast("long").alias("total_impressions"),
        _mean_units(F.sum("_ctr"), F.count("_ctr")).alias("avg_ctr"),
        _mean_units(F.sum("_pos"), F.count("_pos")).alias("avg_position"),
        _median_units(F.median("_ctr")).alias("median_ctr"),
        _median_units(F.median("_pos")).alias("median_position"),
        *[F.sum(F.when(F.col("_pos") <= n * 100, F.col("clicks")).otherwise(0)).cast("long").alias(f"clicks_top_{n}") for n in TOP],
        *[F.count(F.when(F.col("_pos") <= n * 100, 1)).alias(f"terms_top_{n}") for n in TOP],
    ]
    return t.groupBy("restaurant_id", "domain", "search_type").agg(*aggs)


_KEYS = ["restaurant_id", "domain"]


def _with_overall(per_type: DataFrame) -> DataFrame:
    """Per (restaurant, domain): the per-type rows as a list (at most one per
    search type, so bounded) and the Overall values (sums of the sums,
    unweighted means of the rounded means, in hundredths)."""
    detail = F.struct(F.col("search_type"), *[F.col(m) for m in METRICS])
    return per_type.groupBy(*_KEYS).agg(
        F.collect_list(detail).alias("_rows"),
        *[F.sum(m).cast("long").alias(f"_o_{m}") for m in SUMS],
        *[_mean_units(F.sum(m), F.count(m)).alias(f"_o_{m}") for m in MEANS],
    )


def _overall_struct() -> Column:
    return F.struct(F.lit(OVERALL).alias("search_type"), *[F.col(f"_o_{m}").alias(m) for m in METRICS])


def _pick(rows: str, ty: str) -> Column:
    """The row of type ``ty`` from a short list of per-type structs (or NULL)."""
    return F.try_element_at(F.filter(rows, lambda r: r["search_type"] == ty), F.lit(1))


def metrics_with_overall(per_type: DataFrame) -> DataFrame:
    """Detail rows plus one 'Overall' row per (restaurant, domain), as the
    reference's UNION ALL does; means stay in hundredths.

    One aggregation makes both (``_with_overall``); the list plus the
    Overall row are exploded, so the per-type table is computed once
    instead of once per UNION ALL branch.
    """
    g = _with_overall(per_type)
    rows = g.select(*_KEYS, F.explode(F.concat(F.col("_rows"), F.array(_overall_struct()))).alias("_r"))
    return rows.select(*_KEYS, "_r.search_type", *[F.col(f"_r.{m}").alias(m) for m in METRICS])


def _wide_columns(struct_of: dict[str, str]) -> list[Column]:
    """Wide output columns from one struct column per type; means to doubles."""
    out = []
    for ty in TYPES:
        for m in METRICS:
            v = f"{struct_of[ty]}.{m}"
            out.append(F.expr(f"{v} / 100.0D as {wide(ty, m)}" if m in MEANS else f"cast({v} as bigint) as {wide(ty, m)}"))
    return out


def restaurant_metrics(terms: DataFrame, cuisines: DataFrame) -> DataFrame:
    """gsc_restaurant_metrics: one row per (restaurant, domain), 13 metrics x
    3 types, share columns, cuisines.

    Overall, Branded and Unbranded come from one aggregation over the small
    per-type table (two rows per restaurant at most) instead of a UNION ALL
    followed by a pivot.
    """
    g = _with_overall(term_metrics(terms))
    # Pivot by field access on the per-type structs: one small aggregation
    # (13 overall values and a bounded list) instead of 39 conditional ones.
    typed = g.select(
        *_KEYS, _overall_struct().alias("_o"), _pick("_rows", BRANDED).alias("_b"), _pick("_rows", UNBRANDED).alias("_u")
    )
    wide_df = typed.select(*_KEYS, *_wide_columns({OVERALL: "_o", BRANDED: "_b", UNBRANDED: "_u"}))
    c = cuisines.select("restaurant_id", "cuisines")
    return wide_df.join(c, "restaurant_id", "left").select(
        "restaurant_id", "domain", "cuisines", *[wide(ty, m) for ty in TYPES for m in METRICS], *_shares()
    )


# --------------------------------------------------------------------------- cuisine metrics


def cuisine_unnest(rest: DataFrame) -> DataFrame:
    """Restaurant metrics x cuisines (inner unnest of the JSON list, trimmed)."""
    return explode_json_list(rest, "cuisines", "cuisine")


def cuisine_metrics(rest: DataFrame) -> DataFrame:
    """gsc_cuisine_metrics: restaurant metrics re-aggregated per cuisine.

    The reference builds three aggregates (overall, branded, unbranded) over
    the same unnested rows and joins them on cuisine. Here the rows are
    turned long (one per type) and aggregated once per (cuisine, type); the
    at most three rows per cuisine are then pivoted by field access.
    """
    u = cuisine_unnest(rest)
    # Long form: one row per (restaurant, cuisine, type), means in hundredths.
    per_type = F.array(
        *[
            F.struct(
                F.lit(ty).alias("search_type"),
                *[(_units(wide(ty, m)) if m in MEANS else F.col(wide(ty, m))).alias(m) for m in METRICS],
            )
            for ty in TYPES
        ]
    )
    long = u.select("cuisine", "restaurant_id", F.explode(per_type).alias("_t")).select(
        "cuisine", "restaurant_id", "_t.*"
    )
    by_type = long.groupBy("cuisine", "search_type").agg(
        F.count_distinct("restaurant_id").alias("restaurant_count"),
        *[F.sum(m).cast("long").alias(m) for m in SUMS],
        *[_mean_units(F.sum(m), F.count(m)).alias(m) for m in MEANS],
    )
    # At most three rows per cuisine: collected and picked by type.
    g = by_type.groupBy("cuisine").agg(
        F.max("restaurant_count").alias("restaurant_count"),
        F.collect_list(F.struct("search_type", *METRICS)).alias("_rows"),
    )
    known = F.col("cuisine").isNotNull()
    typed = g.select(
        "cuisine",
        "restaurant_count",
        _pick("_rows", OVERALL).alias("_o"),
        # A NULL cuisine cannot match the reference's join of the per-type aggregates.
        F.when(known, _pick("_rows", BRANDED)).alias("_b"),
        F.when(known, _pick("_rows", UNBRANDED)).alias("_u"),
    )
    wide_df = typed.select("cuisine", "restaurant_count", *_wide_columns({OVERALL: "_o", BRANDED: "_b", UNBRANDED: "_u"}))
    return wide_df.select("*", *_shares())


def means_to_doubles(df: DataFrame) -> DataFrame:
    """Per-type metrics with the hundredths of the mean columns as doubles."""
    return df.select(*[(F.col(c) / F.lit(100.0)).alias(c) if c in MEANS else F.col(c) for c in df.columns])
