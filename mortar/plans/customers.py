"""SaaS customer health: daily metrics per (customer, day) and the enriched
customer table with the latest day's metrics.

The reference computes three aggregates per customer-day (subscriptions
active on the day, same-day logins, tickets created up to the day) with
range joins and joins them back to the customer x day spine. Here all three
become event streams (``operators.temporal``) summed in one aggregation and
one per-customer window. Narrow rows are dealt by customer once, over as many
tasks as the input needs, and counted where they are alike; the aggregation and
the window follow without a shuffle. A per-day table whose size is bounded
by the spine length is broadcast.

Semantics kept from the reference (see SURVEY 2.16):
- ``total_tickets_to_date`` counts the customer's days so far (``tickets="literal"``);
  ``tickets="cumulative"`` counts tickets created so far.
- Login look-backs only see the day's own logins (``logins="literal"``):
  ``*_last_3m`` is the day's login rows, ``*_prev_3m`` 0. ``logins="trailing"``
  counts login rows over true [d-90, d] and [d-180, d-91] windows, for unique
  users too, as both branches of the reference count rows; ``logins="distinct"``
  counts those windows' distinct users.
- ``lag(.., 90)`` is by rows of the dense spine; the lag sees NULL arr.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import pct_change_units, round_ratio, round_ratio_units, surrogate_key, true_or_false
from ..operators.rank import group_min_max, latest_per_key
from ..operators.temporal import (
    counted_by_entity,
    crowded_classes,
    distinct_active_counts,
    distinct_active_events,
    emit_events,
    entity_days,
    entity_first_days,
    explode_segments,
    interval_specs,
    parts_for,
    point_spec,
    running_segments,
    split_segments,
    sums_and_distinct_events,
)
from ..session import path_exists, qualified_path, remove_path, replace_path, scratch_path, settings
from ..sources.sinks import clustered_table, materialize, stored_folders, write_folders
from ..sources.fixtures import TICKET_CATEGORIES, USER_TYPES

SPINE_START = "2023-01-01"
SPINE_END = "2024-12-31"  # exclusive, as the reference's date spine

KEY = "customer_id"
LAG_DAYS = 90


def _cat(c: str) -> str:
    return c.replace(" ", "_")


def customer_dates(customers: DataFrame, start: str = SPINE_START, end: str = SPINE_END) -> DataFrame:
    """(customer_id, date) for each spine day on or after acquisition."""
    return entity_days(customers, KEY, "acquisition_date", start, end)


# --------------------------------------------------------------------------- event families


def _subscription_events(subs: DataFrame, dealt, start: str, end: str) -> list[DataFrame]:
    rows = subs.where(F.col(KEY).isNotNull()).select(
        KEY, "product_id", F.to_date("start_date").alias("_start"), F.to_date("end_date").alias("_end"), "arr"
    )
    subs = dealt(
        rows,
        ["product_id", "_start", "_end"],
        [F.count("arr").alias("_n"), F.coalesce(F.sum(F.col("arr").cast("long")), F.lit(0)).alias("_arr")],
    )
    hi = F.date_add("_end", 1)  # active through end_date; NULL end = open
    values = {"s_n": F.col("_n"), "s_arr": F.col("_arr")}
    # lag(.., 90) over the dense spine = the same events 90 days later.
    return [sums_and_distinct_events(subs, KEY, "product_id", F.col("_start"), hi, values, start, end, "products", LAG_DAYS)]


def _ticket_events(tickets: DataFrame, dealt, start: str, end: str, mode: str) -> list[DataFrame]:
    status = F.col("status")
    # open on d  <=>  created <= d and (status != 'closed' or closed is null or closed > d)
    ends = ~(status.isNotNull() & (status != "closed")) & F.col("closed_date").isNotNull()
    resolved = (status == "closed") & F.col("closed_date").isNotNull() & F.col("created_date").isNotNull()
    days = [F.to_date("created_date").alias("_created"), F.to_date("closed_date").alias("_closed")]
    rows = tickets.where(F.col(KEY).isNotNull()).select(
        KEY, "ticket_category", *days, ends.alias("_ends"), true_or_false(resolved).alias("_resolved")
    )
    tickets = dealt(rows, rows.columns[1:], [F.count(F.lit(1)).alias("_n")])
    created, closed, n = F.col("_created"), F.col("_closed"), F.col("_n")
    hi = F.when(F.col("_ends"), closed)
    opened = {"open": n, **{f"open_{_cat(c)}": F.when(F.col("ticket_category") == c, n).otherwise(0) for c in TICKET_CATEGORIES}}
    specs = [
        *interval_specs(created, hi, opened, start, end),
        *interval_specs(F.date_add(created, 14), hi, {"open14": n}, start, end),
        point_spec(
            F.greatest(created, closed), {"res_days": F.datediff(closed, created) * n, "res_cnt": n}, start, end, F.col("_resolved")
        ),
    ]
    if mode == "cumulative":
        specs.append(point_spec(created, {"tix": n}, start, end, created.isNotNull()))
    elif mode != "literal":
        raise ValueError(f"unknown tickets mode {mode!r}")
    return [emit_events(tickets, KEY, specs)]


def _login_events(logins: DataFrame, dealt, start: str, end: str, mode: str) -> list[DataFrame]:
    if mode not in ("literal", "trailing", "distinct"):
        raise ValueError(f"unknown logins mode {mode!r}")
    day = F.to_date("login_timestamp")
    last = F.date_sub(F.lit(end).cast("date"), 1)
    in_spine = (F.col("day") >= F.lit(start).cast("date")) & (F.col("day") <= last)
    ut = F.col("user_type")
    # a NULL customer's logins match no customer in the reference's join
    rows = logins.select(KEY, day.alias("day"), "user_id", "user_type").where(F.col(KEY).isNotNull())
    per_user = dealt(
        rows.where(in_spine if mode == "literal" else F.col("day").isNotNull()),
        ["day", "user_id"],
        [F.count(F.lit(1)).alias("_rows"), *[F.sum((ut == t).cast("long")).alias(f"_{t}") for t in USER_TYPES]],
    )
    has_user = F.col("user_id").isNotNull()
    n = F.col("_rows")
    point = {
        "num_logins": F.when(has_user, n).otherwise(0),
        "num_unique_users": has_user,
        **{f"{t}_logins": F.col(f"_{t}") for t in USER_TYPES},
        **{f"{t}_unique_users": has_user & (F.col(f"_{t}") > 0) for t in USER_TYPES},
        "login_rows": n,
    }
    d = F.col("day")
    specs = [(d, in_spine, point)]
    if mode != "literal":
        specs += [
            point_spec(d, {"last3": n}, start, end),
            point_spec(F.date_add(d, 91), {"last3": -n, "prev3": n}, start, end),
            point_spec(F.date_add(d, 181), {"prev3": -n}, start, end),
        ]
    events = [emit_events(per_user, KEY, specs)]
    if mode == "distinct":
        # a login covers 91 days of the one window, then 90 of the other; a user's overlapping ones count once
        spans = {"users3": (d, F.date_add(d, 91)), "prev_users3": (F.date_add(d, 91), F.date_add(d, 181))}
        events.append(distinct_active_counts(per_user, KEY, "user_id", spans, start, end))
    return events


_SUB_RUNNING = ["s_n", "s_arr", "products", "s_n_lag", "s_arr_lag", "products_lag"]
_TIX_RUNNING = ["open", *[f"open_{_cat(c)}" for c in TICKET_CATEGORIES], "open14", "res_days", "res_cnt"]
_LOGIN_POINT = [
    "num_logins",
    "num_unique_users",
    *[f"{t}_{m}" for t in USER_TYPES for m in ("logins", "unique_users")],
    "login_rows",
]


def daily_segments(
    customers: DataFrame,
    subscriptions: DataFrame | None = None,
    logins: DataFrame | None = None,
    tickets: DataFrame | None = None,
    start: str = SPINE_START,
    end: str = SPINE_END,
    tickets_mode: str = "literal",
    logins_mode: str = "literal",
    parts: int | None = None,
    only: DataFrame | None = None,
) -> DataFrame:
    """Daily state as segments: rows of (customer_id, _lo, _hi) over which
    every metric is constant (see ``operators.temporal.running_segments``).

    Segments are cut at the event day (where same-day login counts apply)
    and at first_day + 90 (from where the 90-row lag exists), so per-day
    values are a plain explode of a segment.

    Narrow rows are dealt by customer, once, over ``parts`` tasks (by default as many as the input
    needs, which counts it), where those that are alike are counted; a customer with very many
    has them counted before, so a task gets a bounded number. All that follows needs no shuffle.
    ``only``, a table of distinct ids ``_k``, limits the work to these customers.
    """
    parts = parts or parts_for(customers, subscriptions, logins, tickets)
    crowded = crowded_classes(KEY, subscriptions, logins, tickets) if parts > 1 else []
    named = None if only is None else only.repartition(parts, "_k")

    def dealt(rows: DataFrame, by: list[str], counts: list) -> DataFrame:
        df = counted_by_entity(rows, KEY, by, counts, parts, crowded)
        return df if named is None else df.join(named, F.col(KEY) == F.col("_k"), "left_semi")

    firsts = entity_first_days(customers, KEY, "acquisition_date", start, end)
    if only is not None:  # customers without an id are one customer too
        firsts = firsts.join(only, F.col(KEY).eqNullSafe(F.col("_k")), "left_semi")
    firsts = firsts.repartition(parts, KEY)
    events, running, point = [], [], []
    if subscriptions is not None:
        events += _subscription_events(subscriptions, dealt, start, end)
        running += _SUB_RUNNING
    if tickets is not None:
        events += _ticket_events(tickets, dealt, start, end, tickets_mode)
        running += _TIX_RUNNING + (["tix"] if tickets_mode == "cumulative" else [])
    if logins is not None:
        events += _login_events(logins, dealt, start, end, logins_mode)
        point += _LOGIN_POINT
        running += ["last3", "prev3"] if logins_mode != "literal" else []
        running += ["users3", "prev_users3"] if logins_mode == "distinct" else []
    sparse = running_segments(firsts, KEY, events, running, point, end=end)
    seg = split_segments(sparse, F.date_add("first_day", LAG_DAYS))
    seg = seg.select(
        *[c for c in seg.columns if c not in point and c != "day"],
        *[F.expr(f"case when _pt then {p} end as {p}") for p in point],
    )
    if subscriptions is not None:
        # On the dense spine a lag of 90 rows exists exactly from first_day + 90.
        has_lag = F.col("_after")
        seg = (
            seg.withColumn("arr_raw", F.when(F.col("s_n") > 0, F.col("s_arr")))
            .withColumn("products_90d_ago", F.when(has_lag, F.col("products_lag")))
            .withColumn("arr_90d_ago", F.when(has_lag & (F.col("s_n_lag") > 0), F.col("s_arr_lag")))
        )
    return seg


def daily_state(customers: DataFrame, *args, store: str | None = None, **kw) -> DataFrame:
    """Raw daily state per (customer_id, date) for the given event families; ``store`` names a scratch copy of its segments."""
    seg = daily_segments(customers, *args, **kw)
    dense = explode_segments(materialize(seg, store) if store else seg)
    # The grid is dense from first_day: the row number is a date difference.
    return dense.withColumn("day_number", (F.datediff("date", "first_day") + 1).cast("long"))


def product_sets(
    customers: DataFrame, subscriptions: DataFrame, start: str = SPINE_START, end: str = SPINE_END
) -> DataFrame:
    """``array_agg(distinct product_id)`` per (customer_id, date) of active
    subscriptions, sorted; days without a product have an empty array.

    Coverage per (customer, product) is merged into non-overlapping on/off
    intervals first (transition events), and only those intervals are
    exploded onto spine days from the customer's first day: the rows made are
    exactly the elements of the output arrays, with no range join. The
    customer's days themselves join in as rows without a product, so one
    aggregation gives the whole grain.
    """
    firsts = entity_first_days(customers, KEY, "acquisition_date", start, end)
    lo = F.to_date("start_date")
    hi = F.date_add(F.to_date("end_date"), 1)
    trans = distinct_active_events(subscriptions, KEY, "product_id", lo, hi, start, end, out="_d", item_out="product_id")
    last = F.date_sub(F.lit(end).cast("date"), 1)
    w = Window.partitionBy(KEY, "product_id").orderBy("day")
    spans = (
        trans.withColumn("_off", F.lead("day").over(w))
        .where(F.col("_d") > 0)
        .select(KEY, "product_id", F.col("day").alias("_on"), F.coalesce(F.date_sub("_off", 1), last).alias("_last"))
    )
    spans = spans.join(firsts, KEY, "inner").select(
        KEY, "product_id", F.greatest("_on", "first_day").alias("_a"), F.col("_last").alias("_b")
    ).where(F.col("_a") <= F.col("_b"))
    days = spans.select(KEY, "product_id", F.explode(F.sequence("_a", "_b")).alias("date"))
    grid = customer_dates(customers, start, end).select(KEY, F.lit(None).cast("string").alias("product_id"), "date")
    days = days.unionByName(grid)
    return days.groupBy(KEY, "date").agg(F.sort_array(F.collect_set("product_id")).alias("product_ids"))


# --------------------------------------------------------------------------- stage outputs


def active_subscriptions(customers: DataFrame, subscriptions: DataFrame, **kw) -> DataFrame:
    """The reference's daily_subscription_metrics (without the unused product_ids)."""
    s = daily_state(customers, subscriptions=subscriptions, **kw)
    return s.select(
        KEY,
        "date",
        F.col("products").alias("num_products"),
        F.col("arr_raw").alias("total_arr"),
        (F.col("arr_raw") / F.lit(12.0)).alias("total_mrr"),
        F.col("products_90d_ago").alias("num_products_90d_ago"),
        F.col("arr_90d_ago").alias("total_arr_90d_ago"),
        (F.col("arr_90d_ago") / F.lit(12.0)).alias("total_mrr_90d_ago"),
    )


def daily_logins(customers: DataFrame, logins: DataFrame, logins_mode: str = "literal", **kw) -> DataFrame:
    """The reference's daily_login_metrics (NULL look-backs where it has no rows)."""
    s = daily_state(customers, logins=logins, logins_mode=logins_mode, **kw)
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in _LOGIN_POINT[:-1]]
    if logins_mode != "literal":
        last, prev = F.nullif(F.col("last3"), F.lit(0)), F.nullif(F.col("prev3"), F.lit(0))
    else:
        last, prev = F.col("login_rows"), F.lit(None).cast("long")
    users, prev_users = last, prev
    if logins_mode == "distinct":
        users, prev_users = F.nullif(F.col("users3"), F.lit(0)), F.nullif(F.col("prev_users3"), F.lit(0))
    return s.select(
        KEY,
        "date",
        *counts,
        last.alias("num_logins_last_3m"),
        prev.alias("num_logins_prev_3m"),
        users.alias("num_unique_users_last_3m"),
        prev_users.alias("num_unique_users_prev_3m"),
    )


def open_tickets_daily(customers: DataFrame, tickets: DataFrame, tickets_mode: str = "literal", **kw) -> DataFrame:
    """The reference's daily_ticket_metrics."""
    s = daily_state(customers, tickets=tickets, tickets_mode=tickets_mode, **kw)
    total = F.col("tix") if tickets_mode == "cumulative" else F.col("day_number")
    return s.select(
        KEY,
        "date",
        total.cast("long").alias("total_tickets_to_date"),
        F.col("open").alias("open_tickets"),
        *[F.col(f"open_{_cat(c)}").alias(f"open_{_cat(c)}_tickets") for c in TICKET_CATEGORIES],
        F.col("open14").alias("tickets_open_14plus_days"),
        F.when(F.col("res_cnt") > 0, F.col("res_days") / F.col("res_cnt")).alias("avg_days_to_resolution"),
    )


# --------------------------------------------------------------------------- full table

DAILY_COLUMNS = [
    "record_key", "customer_id", "date", "num_products", "total_arr", "total_mrr",
    "pct_change_products_90d", "pct_change_arr_90d", "pct_change_mrr_90d",
    "num_logins", "num_unique_users",
    *[f"{t}_{m}" for t in USER_TYPES for m in ("logins", "unique_users")],
    "num_logins_last_3m", "num_unique_users_last_3m", "num_logins_prev_3m", "num_unique_users_prev_3m",
    "pct_change_logins_3m", "pct_change_unique_users_3m",
    "total_tickets_to_date", "open_tickets", *[f"open_{_cat(c)}_tickets" for c in TICKET_CATEGORIES],
    "tickets_open_14plus_days", "avg_days_to_resolution",
    "is_logins_declining", "is_unique_users_declining", "has_high_aging_tickets",
    "customer_risk_score_raw", "customer_risk_score",
]


def metric_segments(
    customers: DataFrame,
    subscriptions: DataFrame,
    logins: DataFrame,
    tickets: DataFrame,
    start: str = SPINE_START,
    end: str = SPINE_END,
    tickets_mode: str = "literal",
    logins_mode: str = "literal",
    parts: int | None = None,
    only: DataFrame | None = None,
) -> DataFrame:
    """Every column of the daily table that depends on the customer alone, as segments of constant days."""
    s = daily_segments(customers, subscriptions, logins, tickets, start, end, tickets_mode, logins_mode, parts, only)
    z = F.lit(0)

    def c0(name):
        return F.expr(f"cast(coalesce({name}, 0) as bigint)")

    if logins_mode != "literal":
        last3, prev3 = c0("last3"), c0("prev3")
    else:
        last3, prev3 = c0("login_rows"), F.lit(0).cast("long")
    users, prev_users, users_change = "_last3", "_prev3", "_p_logins"
    if logins_mode == "distinct":
        s = s.select("*", c0("users3").alias("_users3"), c0("prev_users3").alias("_prev_users3"))
        s = s.select("*", pct_change_units("_users3", "_prev_users3").alias("_p_users"))
        users, prev_users, users_change = "_users3", "_prev_users3", "_p_users"
    # Every value below is constant over a segment, so it is computed once
    # per segment, not once per day. Stepwise projections keep each
    # intermediate a column of its own (no re-expansion inside the score).
    s = s.select("*", last3.alias("_last3"), prev3.alias("_prev3"))
    s = s.select(
        "*",
        # Percent changes in hundredths (exact); mrr = arr / 12 has the same ratio.
        pct_change_units("products", "products_90d_ago").alias("_p_products"),
        pct_change_units("arr_raw", "arr_90d_ago").alias("_p_arr"),
        pct_change_units("_last3", "_prev3").alias("_p_logins"),
        (F.col("open_bug") + F.col("open_incident") + F.col("open14")).alias("_critical"),
    )
    s = s.select(
        "*",
        (
            F.coalesce(F.col("_p_products"), z)
            + F.coalesce(F.col("_p_arr"), z)
            + F.coalesce(F.col("_p_logins"), z)
            + F.coalesce(F.col(users_change), z)
        ).alias("_p_sum"),
    )
    open_ = F.col("open")
    # raw = round(-p_sum/100 + critical/open, 2), computed on integers
    s = s.select(
        "*",
        F.when(open_ == 0, -F.col("_p_sum"))
        .otherwise(round_ratio_units(-F.col("_p_sum") * open_ + F.col("_critical") * 100, open_ * 100, 2))
        .alias("_raw_units"),
    )
    p_logins = F.col("_p_logins")
    seg = s.select(
        KEY,
        "first_day",
        "_lo",
        "_hi",
        F.col("products").cast("long").alias("num_products"),
        F.coalesce(F.col("arr_raw"), z).cast("long").alias("total_arr"),
        F.coalesce(F.col("arr_raw") / F.lit(12.0), F.lit(0.0)).alias("total_mrr"),
        (F.col("_p_products") / F.lit(100.0)).alias("pct_change_products_90d"),
        (F.col("_p_arr") / F.lit(100.0)).alias("pct_change_arr_90d"),
        (F.col("_p_arr") / F.lit(100.0)).alias("pct_change_mrr_90d"),
        *[c0(c).alias(c) for c in _LOGIN_POINT[:-1]],
        F.col("_last3").alias("num_logins_last_3m"),
        F.col(users).alias("num_unique_users_last_3m"),
        F.col("_prev3").alias("num_logins_prev_3m"),
        F.col(prev_users).alias("num_unique_users_prev_3m"),
        (p_logins / F.lit(100.0)).alias("pct_change_logins_3m"),
        (F.col(users_change) / F.lit(100.0)).alias("pct_change_unique_users_3m"),
        (F.col("tix").cast("long") if tickets_mode == "cumulative" else F.lit(None).cast("long")).alias("_tix"),
        open_.cast("long").alias("open_tickets"),
        *[F.expr(f"cast(open_{_cat(c)} as bigint) as open_{_cat(c)}_tickets") for c in TICKET_CATEGORIES],
        F.col("open14").cast("long").alias("tickets_open_14plus_days"),
        F.when(F.col("res_cnt") > 0, round_ratio("res_days", "res_cnt", 1)).otherwise(F.lit(0.0)).alias(
            "avg_days_to_resolution"
        ),
        true_or_false(p_logins < 0).alias("is_logins_declining"),
        true_or_false(F.col(users_change) < 0).alias("is_unique_users_declining"),
        true_or_false(F.col("open14") > 3).alias("has_high_aging_tickets"),
        "_raw_units",
    )
    return seg


def daily_metrics(
    customers: DataFrame,
    subscriptions: DataFrame,
    logins: DataFrame,
    tickets: DataFrame,
    start: str = SPINE_START,
    end: str = SPINE_END,
    tickets_mode: str = "literal",
    logins_mode: str = "literal",
    latest_only: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """customer_daily_metrics: 36 columns per (customer, day).

    ``latest_only`` returns only each customer's latest day (what
    ``customers_enriched`` reads): the latest segment per customer is taken
    before the explode, so only one day per customer is produced. ``buckets``
    keeps the rows dealt by customer over so many: the stored segments are a
    table clustered by customer, and days made of them stay in their bucket's task,
    so aggregations on the customer (and on more columns) need no exchange.
    """
    seg = metric_segments(customers, subscriptions, logins, tickets, start, end, tickets_mode, logins_mode, buckets)
    if latest_only:
        # Every customer's grid runs to the last spine day, so each latest day
        # is that day and the latest segments carry every score of it: the
        # per-day bounds need no other segment. Exactly one segment of a customer
        # ends there: a narrow filter, no aggregation.
        last = F.date_sub(F.lit(end).cast("date"), 1)
        seg = seg.where(F.col("_hi") == last).withColumn("_lo", F.col("_hi"))
    # Read twice (per-day bounds, then the rows): written once to shared
    # storage instead of being recomputed.
    if buckets:
        return daily_rows(clustered_table(seg, "daily_metrics_clustered", [KEY], ["_lo"], buckets, dealt=True), tickets_mode)
    return daily_rows(materialize(seg, "daily_metrics_latest" if latest_only else "daily_metrics_segments"), tickets_mode)


def daily_rows(seg: DataFrame, tickets_mode: str = "literal") -> DataFrame:
    """The daily table from stored segments: one row a day, with the scores that compare a day's customers."""
    # Min-max per day over narrow (date, score) rows: at most (end - start) groups.
    bounds = group_min_max(
        seg.select(F.explode(F.sequence("_lo", "_hi")).alias("date"), "_raw_units"), ["date"], "_raw_units"
    )
    spread = F.col("_mortar_max") - F.col("_mortar_min")
    score = F.when(spread == 0, F.lit(50.0)).otherwise(
        round_ratio((F.col("_raw_units") - F.col("_mortar_min")) * 100, spread, 2)
    )
    # The ticket table is joined on the id, which a NULL id never matches: 0.
    day_number = F.when(F.col(KEY).isNotNull(), F.datediff("date", "first_day") + 1).otherwise(0).cast("long")
    return (
        explode_segments(seg)
        # One row a spine day, whatever the input. Spark's estimate of it grows with the
        # segments and would have every day's row shuffled and sorted instead.
        .join(F.broadcast(bounds), "date", "inner")
        .withColumn("record_key", surrogate_key(KEY, "date"))
        .withColumn("total_tickets_to_date", F.when(F.col(KEY).isNotNull(), F.coalesce("_tix", day_number)).otherwise(0) if tickets_mode == "cumulative" else day_number)
        .withColumn("customer_risk_score_raw", F.col("_raw_units") / F.lit(100.0))
        .withColumn("customer_risk_score", score)
        .select(*DAILY_COLUMNS)
    )


# --------------------------------------------------------------------------- kept up to date

#: Folders that stored segments are divided in, by a hash of the customer.
BUCKETS = 64

#: While stored segments are written: shuffle files go when the write that made them ends, not when the driver happens
#: to collect its garbage.
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def refresh_segments(path: str, changed: DataFrame, customers: DataFrame, *inputs: DataFrame, buckets: int = BUCKETS, **modes) -> int:
    """Work out anew the stored segments of the ``changed`` customers (a table with their ids); returns the folders written.

    A customer's segments depend on that customer's rows alone, so what any new, late or
    corrected input changes is the customers it names. Inputs are cut to these by a semi
    join; folders without one of them are neither read nor written, and in the others the
    customers that didn't change are carried over. ``daily_rows`` of the store equals
    ``daily_metrics`` of all inputs, as only per-day bounds span customers. The first call,
    with all customers, builds the store.

    Rows are dealt by customer over a power of two of tasks. A folder is the remainder of
    the hash that Spark deals by and that its bucketed files go by, so with as many folders or
    more tasks each task writes few of them, segments need no shuffle, and neither do those
    carried over, as a folder is read by one task. A task then holds the changed ids of a folder:
    give more ``buckets`` for very many customers, always as many. New folders are written aside,
    below ``path``, and then put in place of the old ones. Shuffle files and the list of
    ids go as soon as they were used, so refreshes that follow one another don't add up on disk.
    """
    spark = customers.sparkSession
    path = qualified_path(spark, path)
    listed = scratch_path(spark, "changed-customers")
    try:
        with settings(spark, _WRITING):
            names = materialize(changed.select(F.col(KEY).alias("_k")).distinct(), "changed-customers", path=listed)
            return _refresh(path, names, buckets, modes, customers, *inputs)
    finally:
        remove_path(spark, listed)


def _refresh(path: str, names: DataFrame, buckets: int, modes: dict, customers: DataFrame, *inputs: DataFrame) -> int:
    spark = customers.sparkSession
    bucket = lambda c: F.pmod(F.hash(c), F.lit(buckets)).cast("int")
    touched = sorted(r[0] for r in names.select(bucket("_k").alias("b")).distinct().collect())  # at most ``buckets``
    if not touched:
        return 0
    parts = max(1 << (parts_for(customers, *inputs) - 1).bit_length(), buckets)
    seg = metric_segments(customers, *inputs, parts=parts, only=names, **modes).withColumn("bucket", bucket(KEY))
    aside = f"{path}/_new-{uuid.uuid4().hex}"
    if path_exists(spark, path):
        with stored_folders(spark, path, seg.schema, "bucket", KEY, buckets) as stored:
            dealt = names.repartition(buckets, "_k").hint("shuffle_hash")
            kept = stored.where(F.col("bucket").isin(touched)).join(dealt, F.col(KEY) == F.col("_k"), "left_anti")
            if not names.where(F.col("_k").isNull()).isEmpty():
                kept = kept.where(F.col(KEY).isNotNull())
            write_folders(seg.unionByName(kept), aside, "bucket", KEY, buckets)
    else:
        write_folders(seg, aside, "bucket", KEY, buckets)
    for b in touched:  # a customer that has no days any more leaves no row; a folder that is empty now goes
        replace_path(spark, f"{aside}/bucket={b}", f"{path}/bucket={b}")
    remove_path(spark, aside)
    return len(touched)


def stored_daily_metrics(spark: SparkSession, path: str, tickets_mode: str = "literal") -> DataFrame:
    """The daily table of the segments stored at ``path``."""
    return daily_rows(spark.read.parquet(path).drop("bucket"), tickets_mode)


# --------------------------------------------------------------------------- enriched

ENRICHED_METRICS = [c for c in DAILY_COLUMNS if c not in ("record_key", "customer_id", "date")]


def customers_enriched(customers: DataFrame, daily: DataFrame, as_of: str | None = None, is_latest: bool = False) -> DataFrame:
    """Customers with their latest day's metrics and day counts.

    ``as_of`` replaces the reference's ``current_date()`` (default: today).
    ``is_latest`` says that ``daily`` has one row per customer already
    (``daily_metrics(latest_only=True)``).
    """
    latest = daily.select(KEY, "date", *ENRICHED_METRICS)
    if not is_latest:
        latest = latest_per_key(latest, [KEY], ["date"])
    today = F.lit(as_of).cast("date") if as_of else F.current_date()
    joined = customers.join(latest, KEY, "left")
    return joined.select(
        KEY,
        "acquisition_date",
        "region",
        "industry",
        F.col("date").alias("last_metrics_date"),
        *ENRICHED_METRICS,
        F.datediff(today, F.col("acquisition_date")).cast("long").alias("days_since_acquisition"),
        F.datediff(today, F.col("date")).cast("long").alias("days_since_last_activity"),
    )
