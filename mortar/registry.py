"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver tables in ``sf_dir`` (through the fixture
derivations) and runs over all of their rows.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date as dt_date
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans import customers as saas
from .plans import orders as shop
from .plans import data_tests as dt
from .plans import history, monitoring, search
from .operators.checks import run_checks
from .operators.compare import compare_all_columns, compare_relations
from .operators.diff import diff_tables
from .operators.rank import latest_per_key
from .operators.temporal import parts_for
from .session import scratch_path
from .sources.sinks import clustered_table, materialize
from .sources import fixtures as fx
from .sources import generate as gen
from .sources.tables import Sources

Query = Callable[[SparkSession, str], DataFrame]


def _src(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(spark, sf_dir)


# --------------------------------------------------------------------------- shop


def q_stg_customers(spark, sf_dir):
    return shop.stg_customers(fx.shop_customers(_src(spark, sf_dir)))


def q_stg_orders(spark, sf_dir):
    return shop.stg_orders(fx.shop_orders(_src(spark, sf_dir)))


def q_stg_payments(spark, sf_dir):
    return shop.stg_payments(fx.stripe_payments(_src(spark, sf_dir)))


def q_fct_orders(spark, sf_dir):
    s = _src(spark, sf_dir)
    return shop.fct_orders(shop.stg_orders(fx.shop_orders(s)), shop.stg_payments(fx.stripe_payments(s)))


def q_order_status_pivot(spark, sf_dir):
    return shop.order_status_pivot(shop.stg_orders(fx.shop_orders(_src(spark, sf_dir))))


def q_dim_customers(spark, sf_dir):
    s = _src(spark, sf_dir)
    return shop.dim_customers(
        shop.stg_customers(fx.shop_customers(s)),
        shop.stg_orders(fx.shop_orders(s)),
        shop.stg_payments(fx.stripe_payments(s)),
    )


def q_customer_orders(spark, sf_dir):
    s = _src(spark, sf_dir)
    return shop.customer_orders(fx.shop_orders(s), fx.stripe_payments(s), fx.shop_customers(s))


# --------------------------------------------------------------------------- generators


def _n_customers(s: Sources) -> int:
    # One scalar for the generators' customer-id range (Parquet metadata count).
    return s["customer"].count()


def q_gen_customers(spark, sf_dir):
    s = _src(spark, sf_dir)
    rows = s["customer"].select((F.col("c_custkey") + 1).alias("t"))
    return gen.gen_customers(rows, "t")


def q_gen_subscriptions(spark, sf_dir):
    s = _src(spark, sf_dir)
    rows = s["orders"].select((F.col("o_orderkey") + 1).alias("t"))
    return gen.gen_subscriptions(rows, "t", _n_customers(s))


def q_gen_login_events(spark, sf_dir):
    s = _src(spark, sf_dir)
    rows = s["events"].select((F.col("event_id") + 1).alias("t"))
    return gen.gen_login_events(rows, "t", _n_customers(s))


def q_gen_support_tickets(spark, sf_dir):
    s = _src(spark, sf_dir)
    rows = s["orders"].select((F.col("o_orderkey") + 1).alias("t"))
    return gen.gen_support_tickets(rows, "t", _n_customers(s))


# --------------------------------------------------------------------------- SaaS

AS_OF = "2026-01-01"  # stands in for current_date() so results are repeatable


def _saas(spark, sf_dir):
    s = _src(spark, sf_dir)
    return (
        fx.saas_customers(s),
        fx.saas_subscriptions(s),
        fx.saas_login_events(s),
        fx.saas_support_tickets(s),
    )


def q_saas_customers(spark, sf_dir):
    return fx.saas_customers(_src(spark, sf_dir))


def q_saas_subscriptions(spark, sf_dir):
    return fx.saas_subscriptions(_src(spark, sf_dir))


def q_saas_login_events(spark, sf_dir):
    return fx.saas_login_events(_src(spark, sf_dir))


def q_saas_support_tickets(spark, sf_dir):
    return fx.saas_support_tickets(_src(spark, sf_dir))


def q_customer_dates(spark, sf_dir):
    return saas.customer_dates(fx.saas_customers(_src(spark, sf_dir)))


def q_active_subscriptions(spark, sf_dir):
    c, subs, _, _ = _saas(spark, sf_dir)
    return saas.active_subscriptions(c, subs)


def q_product_sets(spark, sf_dir):
    c, subs, _, _ = _saas(spark, sf_dir)
    return saas.product_sets(c, subs)


def q_daily_logins(spark, sf_dir):
    c, _, logins, _ = _saas(spark, sf_dir)
    return saas.daily_logins(c, logins)


def q_daily_logins_trailing(spark, sf_dir):
    c, _, logins, _ = _saas(spark, sf_dir)
    return saas.daily_logins(c, logins, logins_mode="trailing")


def q_daily_logins_distinct(spark, sf_dir):
    c, _, logins, _ = _saas(spark, sf_dir)
    return saas.daily_logins(c, logins, logins_mode="distinct")


def q_daily_metrics_distinct(spark, sf_dir):
    """The daily table with the look-backs as meant: rows and distinct users of 90 days."""
    return saas.daily_metrics(*_saas(spark, sf_dir), logins_mode="distinct")


def q_open_tickets_daily(spark, sf_dir):
    c, _, _, t = _saas(spark, sf_dir)
    return saas.open_tickets_daily(c, t)


def q_open_tickets_cumulative(spark, sf_dir):
    c, _, _, t = _saas(spark, sf_dir)
    return saas.open_tickets_daily(c, t, tickets_mode="cumulative")


def q_daily_metrics(spark, sf_dir):
    return saas.daily_metrics(*_saas(spark, sf_dir))


def q_customers_enriched(spark, sf_dir):
    c, subs, logins, t = _saas(spark, sf_dir)
    return saas.customers_enriched(c, saas.daily_metrics(c, subs, logins, t, latest_only=True), as_of=AS_OF, is_latest=True)


def q_daily_metrics_refreshed(spark, sf_dir):
    """The daily table kept up to date: built before some tickets and logins came, then refreshed for their customers."""
    c, subs, logins, tickets = _saas(spark, sf_dir)
    path = scratch_path(spark, "daily-segments")
    late_login, late_ticket = F.crc32("user_id") % 10 == 3, F.crc32("ticket_id") % 10 == 3
    saas.refresh_segments(path, c, c, subs, logins.where(~late_login), tickets.where(~late_ticket))
    changed = logins.where(late_login).select("customer_id").unionByName(tickets.where(late_ticket).select("customer_id"))
    saas.refresh_segments(path, changed, c, subs, logins, tickets)
    return saas.stored_daily_metrics(spark, path)


def q_customers_enriched_clustered(spark, sf_dir):
    """Customers with their latest day, from a daily table stored in buckets of customers.

    The table is stored as segments of equal days; its rows are made of them in their bucket's task.
    """
    c, *inputs = _saas(spark, sf_dir)
    buckets = parts_for(c, *inputs)
    daily = saas.daily_metrics(c, *inputs, buckets=buckets)
    c = clustered_table(c, "customers_clustered", ["customer_id"], buckets=buckets)
    return saas.customers_enriched(c, daily, as_of=AS_OF)


def q_latest_tickets(spark, sf_dir):
    """Each customer's latest ticket; of those created at the same time, the one with the greatest id."""
    return latest_per_key(fx.saas_support_tickets(_src(spark, sf_dir)), ["customer_id"], ["created_date"])


# --------------------------------------------------------------------------- search


def _terms(spark, sf_dir):
    return search.search_terms(search.stg_search_export(fx.search_export(_src(spark, sf_dir))))


def q_stg_search_export(spark, sf_dir):
    return search.stg_search_export(fx.search_export(_src(spark, sf_dir)))


def q_stg_cuisines(spark, sf_dir):
    return search.stg_cuisines(fx.cuisine_export(_src(spark, sf_dir)))


def q_search_terms(spark, sf_dir):
    return _terms(spark, sf_dir)


def q_other_brand_terms(spark, sf_dir):
    """Search terms of the exports against the brands of all other restaurants."""
    return search.other_brand_terms(_terms(spark, sf_dir))


def q_other_brand_titles(spark, sf_dir):
    """Titles of web pages against the names of all other sites."""
    return search.other_brand_terms(fx.site_searches(_src(spark, sf_dir)))


def q_search_term_metrics(spark, sf_dir):
    m = search.metrics_with_overall(search.term_metrics(_terms(spark, sf_dir)))
    return search.means_to_doubles(m)


def q_restaurant_metrics(spark, sf_dir):
    s = _src(spark, sf_dir)
    return search.restaurant_metrics(_terms(spark, sf_dir), search.stg_cuisines(fx.cuisine_export(s)))


def q_cuisine_metrics(spark, sf_dir):
    return search.cuisine_metrics(q_restaurant_metrics(spark, sf_dir))


# --------------------------------------------------------------------------- audits


_AUDIT_TICKET_COLS = [
    "customer_id", "date", "total_tickets_to_date", "open_tickets", "open_bug_tickets", "open_incident_tickets",
    "open_question_tickets", "open_feature_request_tickets", "tickets_open_14plus_days",
]


def _ticket_plans(spark, sf_dir, store=None):
    """The ticket columns from the tickets-only plan and from the full daily plan, both dealt by customer over as many tasks."""
    c, subs, logins, t = _saas(spark, sf_dir)
    parts = parts_for(c, subs, logins, t)
    alone = saas.open_tickets_daily(c, t, parts=parts, store=store).select(*_AUDIT_TICKET_COLS)
    full = saas.daily_metrics(c, subs, logins, t, buckets=parts).select(*_AUDIT_TICKET_COLS)
    return alone, full


def q_audit_open_tickets(spark, sf_dir):
    """Row-set comparison of the two plans: they differ for a NULL customer, whom the full plan's joins never match."""
    return compare_relations(*_ticket_plans(spark, sf_dir))


def q_audit_open_tickets_columns(spark, sf_dir):
    """Column-by-column comparison of the two plans on (customer_id, date)."""
    return compare_all_columns(*_ticket_plans(spark, sf_dir), ["customer_id", "date"])


def q_diff_open_tickets(spark, sf_dir):
    """The rows in which the two ticket plans differ: those of NULL customers.

    Both are read from their stored segments. A customer's days lie in one leaf, so a task sums them before any shuffle.
    """
    return diff_tables(*_ticket_plans(spark, sf_dir, store="ticket-segments"), ["customer_id"])


def q_diff_order_status(spark, sf_dir):
    """Orders whose status by header and by lines differ, or that only one side has."""
    headers, lines = (materialize(df.drop("first_date"), f"status-{n}") for n, df in enumerate(_order_sides(spark, sf_dir)))
    return diff_tables(headers, lines, ["order_id"])


def _order_sides(spark, sf_dir):
    """Order status and first date from the order headers and from their lines, of all orders and lines.

    Some orders have no line, and the status of the lines need not be that of the header.
    """
    s = _src(spark, sf_dir)
    headers = s["orders"].select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").cast("date").alias("first_date"))
    lines = s["lineitem"].groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.min("l_linestatus").alias("_low"), F.max("l_linestatus").alias("_high"), F.min(F.col("l_shipdate").cast("date")).alias("first_date")
    )
    status = F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise("P")
    return headers, lines.select("order_id", status.alias("status"), "first_date")


def q_audit_order_status(spark, sf_dir):
    """Row-set comparison of order status by header and by lines."""
    headers, lines = _order_sides(spark, sf_dir)
    return compare_relations(headers, lines, exclude=["first_date"])


def q_audit_order_status_columns(spark, sf_dir):
    """Column comparison of order headers and lines."""
    return compare_all_columns(*_order_sides(spark, sf_dir), ["order_id"])


# --------------------------------------------------------------------------- history and monitoring

_CHANGES = ("restaurant_id", "day", "seq", "cuisines")
HISTORY_START, HISTORY_END, SNAPSHOT_DAY = "1992-01-01", "1999-01-01", "1995-06-30"
MONITORED = ["total_arr", "num_logins", "open_tickets", "customer_risk_score"]


def q_cuisine_validity(spark, sf_dir):
    return history.validity_ranges(fx.cuisine_changes(_src(spark, sf_dir)), *_CHANGES)


def q_cuisine_daily(spark, sf_dir):
    return history.daily_grain(q_cuisine_validity(spark, sf_dir), "restaurant_id", "cuisines", HISTORY_START, HISTORY_END)


def q_cuisine_snapshot(spark, sf_dir):
    """One day's snapshot, written partitioned by its date and read back through a view."""
    taken = history.snapshot(fx.cuisine_changes(_src(spark, sf_dir)), *_CHANGES, as_of=SNAPSHOT_DAY)
    return materialize(materialize(taken, "cuisine_snapshot", partition_by=["snapshot_date"]), "cuisine_snapshot_view", kind="view")


def q_cuisine_sales_daily(spark, sf_dir):
    """Orders by day and the cuisines that their restaurant had on that day."""
    s = _src(spark, sf_dir)
    ranges = history.validity_ranges(fx.cuisine_changes(s), *_CHANGES)
    sold = history.value_on_day(fx.restaurant_sales(s), "day", ranges, "restaurant_id", "cuisines")
    return sold.groupBy("day", "cuisines").agg(
        F.count(F.lit(1)).alias("n_orders"), F.count_distinct("restaurant_id").alias("n_restaurants"), F.sum("cents").cast("long").alias("cents")
    )


#: Month ends of a year, and the one whose snapshot is taken again.
SNAPSHOT_DAYS = [str(d) for d in (dt_date(1996, m + 1, 1) - timedelta(days=1) for m in range(1, 12))]
RERUN_DAY = "1996-06-30"


def _late(seq: Column) -> Column:
    """Whether a change event comes in after the snapshots were taken."""
    return seq % 7 == 3


def q_cuisine_snapshots(spark, sf_dir):
    """A growing table of month-end snapshots, a day at a time; then one day anew, with the events that came late.

    Every event is read; a late one is seen by the rerun day alone, as the other days stay as written.
    """
    events = fx.cuisine_changes(_src(spark, sf_dir))
    path = scratch_path(spark, "cuisine-snapshots")
    taken = lambda known, day: history.write_snapshots(history.snapshot(known, *_CHANGES, as_of=day), path, [day])
    for day in SNAPSHOT_DAYS:
        taken(events.where(~_late(F.col("seq"))), day)
    taken(events, RERUN_DAY)
    return spark.read.parquet(path).select("snapshot_date", "restaurant_id", "cuisines")


def q_cuisine_validity_merged(spark, sf_dir):
    """Validity ranges kept in a table, from three batches of events that are out of order."""
    events = fx.cuisine_changes(_src(spark, sf_dir))
    path = scratch_path(spark, "cuisine-ranges")
    for batch in range(3):
        history.merge_changes(path, events.where(F.pmod("seq", F.lit(3)) == batch), *_CHANGES)
    return history.read_ranges(spark, path, "restaurant_id", "cuisines")


def q_daily_metrics_monitor(spark, sf_dir):
    return monitoring.metrics_by_day(q_daily_metrics(spark, sf_dir), "date", MONITORED)


def q_daily_metrics_sketch(spark, sf_dir):
    """Quantiles of days, weeks and four weeks from one stored sketch a day."""
    return monitoring.sketched_quantiles(q_daily_metrics(spark, sf_dir), "date", MONITORED)


def q_daily_metrics_anomalies(spark, sf_dir):
    """Robust scores of each day's figures against the four weeks before."""
    return monitoring.anomalies(q_daily_metrics_monitor(spark, sf_dir), "date", "metric", monitoring.FIGURES)


# --------------------------------------------------------------------------- data tests


def q_tests_saas_customers(spark, sf_dir):
    return run_checks(fx.saas_customers(_src(spark, sf_dir)), dt.saas_customers_tests())


def q_tests_subscriptions(spark, sf_dir):
    c, subs, _, _ = _saas(spark, sf_dir)
    return run_checks(subs, dt.subscriptions_tests(c))


def q_tests_login_events(spark, sf_dir):
    c, _, logins, _ = _saas(spark, sf_dir)
    return run_checks(logins, dt.login_events_tests(c))


def q_tests_support_tickets(spark, sf_dir):
    c, _, _, t = _saas(spark, sf_dir)
    return run_checks(t, dt.support_tickets_tests(c))


def q_tests_daily_metrics(spark, sf_dir):
    # read from the stored segments for each test: rows and their keys are not written
    return run_checks(q_daily_metrics(spark, sf_dir).select("record_key", "customer_risk_score"), dt.daily_metrics_tests())


def q_tests_customers_enriched(spark, sf_dir):
    c = fx.saas_customers(_src(spark, sf_dir))
    enriched = materialize(q_customers_enriched(spark, sf_dir), "customers_enriched")
    return run_checks(enriched, dt.customers_enriched_tests(c))


def q_tests_search_export(spark, sf_dir):
    return run_checks(q_stg_search_export(spark, sf_dir), dt.search_export_tests())


def q_tests_cuisines(spark, sf_dir):
    return run_checks(q_stg_cuisines(spark, sf_dir), dt.cuisines_tests())


def q_tests_search_terms(spark, sf_dir):
    return run_checks(q_search_terms(spark, sf_dir), dt.search_terms_tests())


def q_tests_restaurant_metrics(spark, sf_dir):
    return run_checks(q_restaurant_metrics(spark, sf_dir), dt.restaurant_metrics_tests())


def q_tests_cuisine_metrics(spark, sf_dir):
    # one run of the pipeline, not one for each test
    cuisines = materialize(q_cuisine_metrics(spark, sf_dir).select("cuisine"), "cuisine_metrics")
    return run_checks(cuisines, dt.cuisine_metrics_tests())


QUERIES: dict[str, Query] = {
    "stg_customers": q_stg_customers,
    "stg_orders": q_stg_orders,
    "stg_payments": q_stg_payments,
    "fct_orders": q_fct_orders,
    "order_status_pivot": q_order_status_pivot,
    "dim_customers": q_dim_customers,
    "customer_orders": q_customer_orders,
    "gen_customers": q_gen_customers,
    "gen_subscriptions": q_gen_subscriptions,
    "gen_login_events": q_gen_login_events,
    "gen_support_tickets": q_gen_support_tickets,
    "saas_customers": q_saas_customers,
    "saas_subscriptions": q_saas_subscriptions,
    "saas_login_events": q_saas_login_events,
    "saas_support_tickets": q_saas_support_tickets,
    "customer_dates": q_customer_dates,
    "active_subscriptions": q_active_subscriptions,
    "product_sets": q_product_sets,
    "daily_logins": q_daily_logins,
    "daily_logins_trailing": q_daily_logins_trailing,
    "daily_logins_distinct": q_daily_logins_distinct,
    "daily_metrics_distinct": q_daily_metrics_distinct,
    "open_tickets_daily": q_open_tickets_daily,
    "open_tickets_cumulative": q_open_tickets_cumulative,
    "daily_metrics": q_daily_metrics,
    "daily_metrics_refreshed": q_daily_metrics_refreshed,
    "customers_enriched": q_customers_enriched,
    "customers_enriched_clustered": q_customers_enriched_clustered,
    "latest_tickets": q_latest_tickets,
    "stg_search_export": q_stg_search_export,
    "stg_cuisines": q_stg_cuisines,
    "search_terms": q_search_terms,
    "search_term_metrics": q_search_term_metrics,
    "other_brand_terms": q_other_brand_terms,
    "other_brand_titles": q_other_brand_titles,
    "restaurant_metrics": q_restaurant_metrics,
    "cuisine_metrics": q_cuisine_metrics,
    "audit_open_tickets": q_audit_open_tickets,
    "audit_open_tickets_columns": q_audit_open_tickets_columns,
    "audit_order_status": q_audit_order_status,
    "audit_order_status_columns": q_audit_order_status_columns,
    "diff_open_tickets": q_diff_open_tickets,
    "diff_order_status": q_diff_order_status,
    "cuisine_validity": q_cuisine_validity,
    "cuisine_daily": q_cuisine_daily,
    "cuisine_snapshot": q_cuisine_snapshot,
    "cuisine_snapshots": q_cuisine_snapshots,
    "cuisine_validity_merged": q_cuisine_validity_merged,
    "cuisine_sales_daily": q_cuisine_sales_daily,
    "daily_metrics_monitor": q_daily_metrics_monitor,
    "daily_metrics_sketch": q_daily_metrics_sketch,
    "daily_metrics_anomalies": q_daily_metrics_anomalies,
    "tests_saas_customers": q_tests_saas_customers,
    "tests_subscriptions": q_tests_subscriptions,
    "tests_login_events": q_tests_login_events,
    "tests_support_tickets": q_tests_support_tickets,
    "tests_daily_metrics": q_tests_daily_metrics,
    "tests_customers_enriched": q_tests_customers_enriched,
    "tests_search_export": q_tests_search_export,
    "tests_cuisines": q_tests_cuisines,
    "tests_search_terms": q_tests_search_terms,
    "tests_restaurant_metrics": q_tests_restaurant_metrics,
    "tests_cuisine_metrics": q_tests_cuisine_metrics,
}
