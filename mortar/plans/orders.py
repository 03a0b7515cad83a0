"""Shop marts: staging views, fct_orders, the status pivot, dim_customers and
customer_orders.

Money is summed as whole numbers of its smallest unit and divided once, at
the output, so sums do not depend on the order rows arrive in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import cents_to_dollars
from ..operators.rank import global_row_number, prefix_scan
from ..operators.shape import pivot_count_distinct
from ..sources.fixtures import ORDER_STATUSES


# --------------------------------------------------------------------------- staging


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.select(F.col("id").alias("customer_id"), "first_name", "last_name")


def stg_orders(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("id").alias("order_id"), F.col("user_id").alias("customer_id"), "order_date", "status")


def stg_payments(payments: DataFrame) -> DataFrame:
    return payments.select(
        F.col("id").alias("payment_id"),
        F.col("orderid").alias("order_id"),
        F.col("paymentmethod").alias("payment_method"),
        F.col("status").alias("payment_status"),
        cents_to_dollars("amount", 4).alias("payment_amount"),
        F.col("created").alias("payment_date"),
    )


# --------------------------------------------------------------------------- marts


# Payments are summed as whole ten-thousandths, the places that staging keeps: exact in any order.
UNITS = 10_000


def _payment_totals(stg_pay: DataFrame) -> DataFrame:
    """Exact payment total per order, in ten-thousandths (pre-aggregated before any join)."""
    return stg_pay.groupBy("order_id").agg(F.sum(F.round(F.col("payment_amount") * UNITS).cast("long")).alias("_units"))


def fct_orders(stg_ord: DataFrame, stg_pay: DataFrame) -> DataFrame:
    """(customer_id, order_id, amount): all payments, NULL when an order has none."""
    totals = _payment_totals(stg_pay)
    joined = stg_ord.select("customer_id", "order_id").join(totals, "order_id", "left")
    # The reference groups by (customer_id, order_id); order ids can repeat,
    # so the per-order totals are summed again per group.
    return joined.groupBy("customer_id", "order_id").agg((F.sum("_units") / F.lit(float(UNITS))).alias("amount"))


def order_status_pivot(stg_ord: DataFrame) -> DataFrame:
    """One count-distinct column per status, by (customer_id, order_date)."""
    return pivot_count_distinct(
        stg_ord, ["customer_id", "order_date"], "status", ORDER_STATUSES, "order_id", suffix="_orders"
    )


def dim_customers(stg_cust: DataFrame, stg_ord: DataFrame, stg_pay: DataFrame) -> DataFrame:
    """Customer with first/last order date, order count and lifetime value.

    The reference aggregates orders and fct_orders separately and joins both
    to customers. Both are per-customer aggregates of the same orders, so one
    ``groupBy`` computes them together: one exchange instead of two plus a
    join, and partial aggregation absorbs a hot customer.
    """
    totals = _payment_totals(stg_pay)
    per_order = stg_ord.select("customer_id", "order_id", "order_date").join(totals, "order_id", "left")
    stats = per_order.groupBy("customer_id").agg(
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("most_recent_order_date"),
        F.count("order_id").alias("number_of_orders"),
        F.sum("_units").alias("_ltv"),
    )
    return stg_cust.join(stats, "customer_id", "left").select(
        "customer_id",
        "first_name",
        "last_name",
        "first_order_date",
        "most_recent_order_date",
        F.coalesce(F.col("number_of_orders"), F.lit(0)).cast("long").alias("number_of_orders"),
        (F.coalesce("_ltv", F.lit(0)) / F.lit(float(UNITS))).alias("lifetime_value"),
    )


def customer_side(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """What an order takes from its customer, a row for each row of ``customers``.

    Names, first order date, how often the id occurs (``_same``) and which of these rows it
    is (``_which``): a repeated customer id multiplies its orders, as in the reference's join.
    """
    first = orders.where(F.col("user_id").isNotNull()).groupBy(F.col("user_id").alias("_cid")).agg(F.min("order_date").alias("fdos"))
    same = Window.partitionBy("_cid")
    named = customers.select(
        F.col("id").alias("_cid"), F.col("first_name").alias("customer_first_name"), F.col("last_name").alias("customer_last_name")
    ).where(F.col("_cid").isNotNull())
    named = named.withColumn("_same", F.count(F.lit(1)).over(same)).withColumn(
        "_which", F.row_number().over(same.orderBy("customer_first_name", "customer_last_name"))
    )
    return named.join(first, "_cid", "left")


def paid_orders(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with their non-failed payment total and date; ``_dup`` tells rows of one order id apart."""
    pay = (
        payments.where(F.col("status") != "fail")
        .groupBy(F.col("orderid").alias("order_id"))
        .agg(F.max("created").alias("payment_finalized_date"), F.sum("amount").alias("_paid_cents"))
    )
    o = orders.select(
        F.col("id").alias("order_id"),
        F.col("user_id").alias("customer_id"),
        F.col("order_date").alias("order_placed_at"),
        F.col("status").alias("order_status"),
    )
    # the window's exchange on order_id serves the join as well
    dup = F.row_number().over(Window.partitionBy("order_id").orderBy("customer_id", "order_placed_at", "order_status"))
    return o.withColumn("_dup", dup).join(pay, "order_id", "left")


def customer_orders(orders: DataFrame, payments: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with global and per-customer sequence numbers, new/return flag
    and the running customer lifetime value, ordered by order_id.

    The reference sums, for each order, the payments of all earlier orders of
    the customer with a triangular self join (all pairs within a customer).
    Here it is a running sum in order_id order (``prefix_scan``), equal for
    distinct order ids and linear per customer. The scan and its checkpoint
    see narrow rows only; what it finds goes back to the orders by their id,
    null ids included: an order without an id has no payments and a NULL
    lifetime value, as in the reference's left joins, and comes last, as the
    oracle sorts. The customer's columns come by one join. For a customer id that occurs m times the reference's joins give m
    rows an order and m * m times the payments; so does this.
    """
    paid = paid_orders(orders, payments)
    by_id = F.asc_nulls_last("order_id")
    scanned = prefix_scan(
        paid.select("order_id", "_dup", "customer_id", "_paid_cents"),
        ["customer_id"],
        [by_id, "_dup"],
        sums={"_clv_cents": "_paid_cents"},
        row_number="_seq",
    ).select(F.col("order_id").alias("_oid"), F.col("_dup").alias("_odup"), "_seq", "_clv_cents")
    wide = paid.join(scanned, F.col("order_id").eqNullSafe(F.col("_oid")) & (F.col("_dup") == F.col("_odup"))).join(
        customer_side(orders, customers), F.col("customer_id") == F.col("_cid"), "left"
    )
    same = F.coalesce("_same", F.lit(1))
    rows = wide.select(
        "order_id",
        "customer_id",
        "order_placed_at",
        "order_status",
        (F.col("_paid_cents") / F.lit(100.0)).alias("total_amount_paid"),
        "payment_finalized_date",
        "customer_first_name",
        "customer_last_name",
        ((F.col("_seq") - 1) * same + F.coalesce("_which", F.lit(1))).cast("long").alias("customer_sales_seq"),
        F.when(F.col("fdos") == F.col("order_placed_at"), "new").otherwise("return").alias("nvsr"),
        # The reference's self join matches no row for a NULL customer or order.
        F.when(F.col("customer_id").isNotNull() & F.col("order_id").isNotNull(), F.col("_clv_cents") * same * same / F.lit(100.0)).alias("customer_lifetime_value"),
        "fdos",
    )
    numbered = global_row_number(rows, [by_id, "customer_sales_seq"], out="transaction_seq")
    # The rows are range-partitioned by order_id (in key order), so sorting
    # inside partitions gives the global order without a further exchange.
    return numbered.sortWithinPartitions(by_id, "customer_sales_seq")
