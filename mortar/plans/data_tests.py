"""The reference's declared data tests, per model, as ``Tests`` specs.

Two declarations in the reference repeat the ``expression`` key (">= 0" and
"<= 100") so a YAML reader keeps only the last; the stated intent is a
0..100 range, and both bounds are checked here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.checks import Tests
from ..sources.fixtures import ARR_VALUES, INDUSTRIES, REGIONS, TICKET_CATEGORIES, TICKET_STATUSES, USER_TYPES


def saas_customers_tests() -> Tests:
    return Tests(
        not_null=["customer_id", "acquisition_date", "region", "industry"],
        unique=["customer_id"],
        accepted={"region": REGIONS, "industry": INDUSTRIES},
    )


def subscriptions_tests(customers: DataFrame) -> Tests:
    return Tests(
        not_null=["customer_id", "product_id", "quantity", "start_date", "arr"],
        relationships={"customer_id": (customers, "customer_id")},
        expressions={
            "quantity > 0": ("quantity", F.col("quantity") > 0),
            "arr in (999, 1999, 4999)": ("arr", F.col("arr").isin(ARR_VALUES)),
        },
    )


def login_events_tests(customers: DataFrame) -> Tests:
    return Tests(
        not_null=["user_id", "customer_id", "user_type", "login_timestamp"],
        relationships={"customer_id": (customers, "customer_id")},
        accepted={"user_type": USER_TYPES},
    )


def support_tickets_tests(customers: DataFrame) -> Tests:
    return Tests(
        not_null=["ticket_id", "customer_id", "status", "created_date", "ticket_category"],
        unique=["ticket_id"],
        relationships={"customer_id": (customers, "customer_id")},
        accepted={"status": TICKET_STATUSES, "ticket_category": TICKET_CATEGORIES},
    )


def _score_range() -> dict:
    s = F.col("customer_risk_score")
    return {">= 0": ("customer_risk_score", s >= 0), "<= 100": ("customer_risk_score", s <= 100)}


def daily_metrics_tests() -> Tests:
    return Tests(not_null=["record_key"], unique_by_hash=["record_key"], expressions=_score_range())


def customers_enriched_tests(customers: DataFrame) -> Tests:
    return Tests(
        not_null=["customer_id", "acquisition_date", "region", "industry"],
        unique=["customer_id"],
        relationships={"customer_id": (customers, "customer_id")},
        accepted={"region": REGIONS, "industry": INDUSTRIES},
        expressions={
            **_score_range(),
            "days_since_last_activity >= 0": ("days_since_last_activity", F.col("days_since_last_activity") >= 0),
        },
    )


def search_export_tests() -> Tests:
    return Tests(not_null=["restaurant_id"])


def cuisines_tests() -> Tests:
    return Tests(not_null=["restaurant_id"], unique=["restaurant_id"])


def search_terms_tests() -> Tests:
    return Tests(not_null=["restaurant_id"])


def restaurant_metrics_tests() -> Tests:
    return Tests(not_null=["restaurant_id"], unique=["restaurant_id"])


def cuisine_metrics_tests() -> Tests:
    return Tests(not_null=["cuisine"], unique=["cuisine"])


def example_tests() -> Tests:
    return Tests(not_null=["id"], unique=["id"])
