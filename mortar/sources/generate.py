"""Generators: literal rows, row ranges and deterministic random attributes.

``F.rand`` depends on partitioning, so a re-run (or a recomputed partition
after an executor loss) would draw different values. Draws here are a hash
of (row id, salt): the same row always gets the same value, on any cluster
layout. ``md5`` is used because DuckDB has the same function, which lets the
oracle reproduce every draw.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import coded_id


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """``select 1 as id union all select null as id``-style inline rows."""
    return spark.createDataFrame(list(rows), schema)


def generate_rows(spark: SparkSession, n: int, name: str = "t", parts: int | None = None) -> DataFrame:
    """Rows 1..n (``unnest(generate_array(1, n))``), split over ``parts`` tasks."""
    return spark.range(1, n + 1, numPartitions=parts).withColumnRenamed("id", name)


def rand_uniform(row_id: Column, salt: int) -> Column:
    """A uniform draw in [0, 1) from (row id, salt): 32 bits of md5."""
    h = F.md5(F.concat(row_id.cast("string"), F.lit(f":{salt}")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def rand_int(row_id: Column, salt: int, n: int) -> Column:
    """``floor(rand() * n)``: an integer in [0, n)."""
    return F.floor(rand_uniform(row_id, salt) * n).cast("long")


def rand_choice(row_id: Column, salt: int, odds: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """``case when rand() < p1 then v1 when rand() < p2 then v2 ... else v end``.

    Each branch draws anew, as in the reference, so the odds are chained:
    branch k wins with probability p_k times the product of (1 - p_j), j < k.
    """
    expr = None
    for i, (p, v) in enumerate(odds):
        cond = rand_uniform(row_id, salt + i) < p
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    return expr.otherwise(otherwise)


def add_days(start: str, days: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), days.cast("int"))


def add_minutes(start: str, minutes: Column) -> Column:
    base = F.lit(f"{start} 00:00:00").cast("timestamp_ntz")
    return base + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"))


# --------------------------------------------------------------------------- reference generators
# Fixed values of the reference generators (odds as written there).
REGION_ODDS = [(0.25, "east"), (0.5, "west"), (0.75, "north")]
REGION_ELSE = "south"
INDUSTRY_ODDS = [(0.33, "technology"), (0.66, "banking")]
INDUSTRY_ELSE = "retail"
USER_TYPE_ODDS = [(0.1, "admin"), (0.4, "advanced")]
USER_TYPE_ELSE = "standard"
STATUS_ODDS = [(0.2, "open"), (0.3, "on-hold")]
STATUS_ELSE = "closed"
CATEGORY_ODDS = [(0.3, "bug"), (0.5, "incident"), (0.8, "question")]
CATEGORY_ELSE = "feature request"


def gen_customers(rows: DataFrame, id_col: str, n_customers: int = 1000) -> DataFrame:
    """The customers generator, one customer per input row (id = row number)."""
    i = F.col(id_col)
    return rows.select(
        coded_id("cust", i).alias("customer_id"),
        add_days("2023-01-01", rand_int(i, 1, 1000)).alias("acquisition_date"),
        rand_choice(i, 10, REGION_ODDS, REGION_ELSE).alias("region"),
        rand_choice(i, 20, INDUSTRY_ODDS, INDUSTRY_ELSE).alias("industry"),
    )


def gen_subscriptions(rows: DataFrame, id_col: str, n_customers: int = 1000) -> DataFrame:
    """The subscriptions generator; rows with end_date <= start_date dropped."""
    i = F.col(id_col)
    arr = (
        F.when(rand_int(i, 7, 3) == 0, 999).when(rand_int(i, 8, 3) == 1, 1999).otherwise(4999)
    )
    subs = rows.select(
        coded_id("cust", rand_int(i, 1, n_customers) + 1).alias("customer_id"),
        coded_id("prod", rand_int(i, 2, 50) + 1, 4).alias("product_id"),
        (rand_int(i, 3, 5) + 1).cast("int").alias("quantity"),
        add_days("2023-01-01", rand_int(i, 4, 1000)).alias("start_date"),
        F.date_add(add_days("2023-01-01", rand_int(i, 5, 1000)), (rand_int(i, 6, 730) + 30).cast("int")).alias("end_date"),
        arr.cast("int").alias("arr"),
    )
    return subs.where(F.col("end_date") > F.col("start_date"))


def gen_login_events(rows: DataFrame, id_col: str, n_customers: int = 1000, n_users: int = 2000) -> DataFrame:
    i = F.col(id_col)
    return rows.select(
        coded_id("user", rand_int(i, 1, n_users) + 1).alias("user_id"),
        coded_id("cust", rand_int(i, 2, n_customers) + 1).alias("customer_id"),
        rand_choice(i, 10, USER_TYPE_ODDS, USER_TYPE_ELSE).alias("user_type"),
        add_minutes("2023-01-01", rand_int(i, 3, 1000000)).alias("login_timestamp"),
    )


def gen_support_tickets(rows: DataFrame, id_col: str, n_customers: int = 1000) -> DataFrame:
    i = F.col(id_col)
    created = add_minutes("2023-01-01", rand_int(i, 2, 1000000))
    status = rand_choice(i, 10, STATUS_ODDS, STATUS_ELSE)
    closed = F.when(
        status == "closed", created + F.make_dt_interval(F.lit(0), F.lit(0), (rand_int(i, 3, 10080) + 60).cast("int"))
    )
    return rows.select(
        coded_id("ticket", i).alias("ticket_id"),
        coded_id("cust", rand_int(i, 1, n_customers) + 1).alias("customer_id"),
        status.alias("status"),
        created.alias("created_date"),
        rand_choice(i, 20, CATEGORY_ODDS, CATEGORY_ELSE).alias("ticket_category"),
        closed.alias("closed_date"),
    )
