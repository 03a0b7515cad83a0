"""Reference input tables derived from the driver tables.

The reference reads source tables that live outside its checkout (shop
orders and payments, generated SaaS tables, search-console exports). Each
function below derives one of them from the driver's TPC-H-like tables,
deterministically and over *all* rows, so the work grows with the data.
The same derivations are written in SQL in ``mortar.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import add_days, add_minutes, coded_id
from .tables import Sources

# Fixed values (the reference's status / category vocabularies).
ORDER_STATUSES = ["placed", "shipped", "returned", "completed", "return_pending"]
PAYMENT_METHODS = ["credit_card", "coupon", "bank_transfer", "gift_card"]
REGIONS = ["east", "west", "north", "south"]
INDUSTRIES = ["technology", "banking", "retail"]
USER_TYPES = ["admin", "advanced", "standard"]
TICKET_STATUSES = ["open", "on-hold", "closed"]
TICKET_CATEGORIES = ["bug", "incident", "question", "feature request"]
ARR_VALUES = [999, 1999, 4999]

SAAS_EPOCH = "2023-01-01"


def _pick(index: Column, values: list[str]) -> Column:
    """values[index] for a small fixed list, as a CASE chain."""
    expr = F.when(index == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], start=1):
        expr = expr.when(index == i, F.lit(v))
    return expr


# --------------------------------------------------------------------------- shop


def shop_customers(src: Sources) -> DataFrame:
    """customers(id, first_name, last_name)."""
    c = src["customer"]
    return c.select(
        F.col("c_custkey").alias("id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
    )


def shop_orders(src: Sources) -> DataFrame:
    """orders(id, user_id, order_date, status)."""
    o = src["orders"]
    k = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "O", "placed")
        .when(F.col("o_orderstatus") == "P", "shipped")
        .when(k % 5 == 0, "returned")
        .when(k % 7 == 0, "return_pending")
        .otherwise("completed")
    )
    return o.select(
        k.alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        status.alias("status"),
    )


def stripe_payments(src: Sources) -> DataFrame:
    """payments(id, orderid, paymentmethod, status, amount, created); amount in cents."""
    li = src["lineitem"]
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    pid = F.concat_ws(
        "-",
        F.col("l_orderkey").cast("string"),
        F.col("l_linenumber").cast("string"),
        F.col("l_partkey").cast("string"),
        F.col("l_suppkey").cast("string"),
        (F.col("l_extendedprice") * 100).cast("long").cast("string"),
    )
    fail = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    return li.select(
        pid.alias("id"),
        F.col("l_orderkey").alias("orderid"),
        _pick(F.col("l_suppkey") % 4, PAYMENT_METHODS).alias("paymentmethod"),
        F.when(fail, "fail").otherwise("success").alias("status"),
        cents.alias("amount"),
        F.col("l_shipdate").cast("date").alias("created"),
    )


# --------------------------------------------------------------------------- SaaS


def saas_customers(src: Sources) -> DataFrame:
    """customers(customer_id, acquisition_date, region, industry).

    Some rows have no id or no acquisition date.
    """
    c = src["customer"]
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    industry = (
        F.when(seg.isin("BUILDING", "MACHINERY"), "technology").when(seg == "AUTOMOBILE", "banking").otherwise("retail")
    )
    return c.select(
        F.when(k % 97 != 5, coded_id("cust", k + 1)).alias("customer_id"),
        F.when(k % 89 != 7, add_days(SAAS_EPOCH, (k * 37) % 1000)).alias("acquisition_date"),
        _pick(F.col("c_nationkey") % 4, REGIONS).alias("region"),
        industry.alias("industry"),
    )


def saas_subscriptions(src: Sources) -> DataFrame:
    """subscriptions(customer_id, product_id, quantity, start_date, end_date, arr).

    One subscription per order; like the reference model, only rows with
    ``end_date > start_date`` are kept, and some whose start is unknown. Some
    have no product or customer, a quantity of 0 or an arr off the list.
    """
    o = src["orders"]
    k = F.col("o_orderkey")
    prio = F.col("o_orderpriority")
    arr = F.when(k % 73 == 6, 1234).when(prio == "1-URGENT", 999).when(prio == "2-HIGH", 1999).otherwise(4999)
    start = F.when(k % 83 != 3, add_days(SAAS_EPOCH, (k * 7919) % 1000))
    end = add_days(SAAS_EPOCH, (k * 104729) % 1000 + 30 + (k * 31) % 730)
    subs = o.select(
        F.when(k % 103 != 8, coded_id("cust", F.col("o_custkey") + 1)).alias("customer_id"),
        F.when(k % 79 != 4, coded_id("prod", k % 50 + 1, 4)).alias("product_id"),
        F.when(k % 71 == 9, 0).otherwise(k % 5 + 1).cast("int").alias("quantity"),
        start.alias("start_date"),
        end.alias("end_date"),
        arr.cast("int").alias("arr"),
    )
    return subs.where((F.col("end_date") > F.col("start_date")) | F.col("start_date").isNull())


def saas_login_events(src: Sources) -> DataFrame:
    """login_events(user_id, customer_id, user_type, login_timestamp).

    Some rows have no customer, no timestamp or a type off the list.
    """
    e = src["events"]
    et, n = F.col("event_type"), F.col("event_id")
    user_type = (
        F.when(n % 67 == 10, "guest").when(et == "signup", "admin").when(et.isin("purchase", "click"), "advanced").otherwise("standard")
    )
    minutes = F.lit(-365 * 24 * 60) + (F.col("event_id") % 23) * (30 * 24 * 60)
    return e.select(
        coded_id("user", F.col("event_id") % 2000 + 1).alias("user_id"),
        F.when(n % 61 != 11, coded_id("cust", F.col("user_id") + 1)).alias("customer_id"),
        user_type.alias("user_type"),
        F.when(n % 59 != 12, add_minutes(F.col("ts"), minutes)).alias("login_timestamp"),
    )


def saas_support_tickets(src: Sources) -> DataFrame:
    """support_tickets(ticket_id, customer_id, status, created_date, ticket_category, closed_date).

    Some rows repeat an id, have a status off the list, an unknown creation
    date, no customer, or one that doesn't exist.
    """
    o = src["orders"]
    k = F.col("o_orderkey")
    st = F.col("o_orderstatus")
    status = F.when(k % 53 == 13, "lost").when(st == "O", "open").when(st == "P", "on-hold").otherwise("closed")
    prio = F.col("o_orderpriority")
    category = (
        F.when(prio == "1-URGENT", "incident")
        .when(prio == "2-HIGH", "bug")
        .when(prio == "3-MEDIUM", "feature request")
        .otherwise("question")
    )
    base = F.lit(f"{SAAS_EPOCH} 00:00:00").cast("timestamp_ntz")
    created = add_minutes(base, (k * 7919) % 1000000)
    closed = F.when(status == "closed", add_minutes(created, 60 + (k * 31) % 10080))
    customer = F.when(k % 47 == 14, F.lit("custnone")).when(k % 43 != 15, coded_id("cust", F.col("o_custkey") + 1))
    return o.select(
        coded_id("ticket", F.when(k % 41 == 16, k).otherwise(k + 1)).alias("ticket_id"),
        customer.alias("customer_id"),
        status.alias("status"),
        F.when(k % 37 != 17, created).alias("created_date"),
        category.alias("ticket_category"),
        closed.alias("closed_date"),
    )


# --------------------------------------------------------------------------- search export

EXPORT_CHUNK = 400  # parts per export document at most (bounded JSON size)


def _fixed(n: Column, decimals: int) -> Column:
    """Non-negative integer n / 10**decimals as decimal text."""
    scale = 10**decimals
    whole = ((n - n % scale) / scale).cast("long")
    return F.concat(whole.cast("string"), F.lit("."), F.lpad((n % scale).cast("string"), decimals, "0"))


def search_export(src: Sources) -> DataFrame:
    """Search exports (restaurant_id, domain, _updated_at, _created_at, status, data).

    One restaurant per part brand; each export document carries the search
    rows of up to EXPORT_CHUNK consecutive parts of that brand. Some rows have
    their clicks as a JSON string.
    """
    p = src["part"]
    k = F.col("p_partkey")
    brand = F.lower(F.regexp_replace("p_brand", "#", ""))
    term = (
        F.when(k % 3 == 0, F.concat(brand, F.lit(" "), F.split_part("p_name", F.lit(" "), F.lit(1))))
        .when(k % 7 == 0, F.lower(F.regexp_replace("p_brand", "#", " ")))
        .otherwise(F.col("p_name"))
    )
    clicks = (k * 13) % 40
    impressions = F.col("p_size").cast("long") * 10 + 40
    ctr_bp = ((clicks * 20000 + impressions) - (clicks * 20000 + impressions) % (impressions * 2)) / (impressions * 2)
    position = (k * 7) % 300 + 10
    fragment = F.concat(
        F.lit('{"keys":["'), term, F.lit('"],"clicks":'),
        F.when(k % 11 == 3, F.concat(F.lit('"'), clicks.cast("string"), F.lit('"'))).otherwise(clicks.cast("string")),
        F.lit(',"impressions":'), impressions.cast("string"),
        F.lit(',"ctr":'), _fixed(ctr_bp.cast("long"), 4),
        F.lit(',"position":'), _fixed(position, 1), F.lit("}"),
    )
    chunk = ((k - k % EXPORT_CHUNK) / EXPORT_CHUNK).cast("long")
    rows = p.select(
        F.split_part("p_brand", F.lit("#"), F.lit(2)).cast("int").alias("restaurant_id"),
        F.concat(F.lit("www."), brand, F.lit(".com")).alias("domain"),
        chunk.alias("chunk"),
        F.struct(k.alias("k"), fragment.alias("f")).alias("frag"),
    )
    docs = rows.groupBy("restaurant_id", "domain", "chunk").agg(F.array_sort(F.collect_list("frag")).alias("frags"))
    created = F.lit("2024-06-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.col("chunk").cast("int"), F.lit(0), F.lit(0)
    )
    return docs.select(
        "restaurant_id",
        "domain",
        (created + F.make_dt_interval(F.lit(0), F.lit(6))).alias("_updated_at"),
        created.alias("_created_at"),
        F.lit("success").alias("status"),
        F.concat(
            F.lit('{"rows":['), F.array_join(F.transform("frags", lambda x: x["f"]), ","), F.lit("]}")
        ).alias("data"),
    )


def site_searches(src: Sources) -> DataFrame:
    """Search rows (restaurant_id, domain, search_term, clicks, impressions): one for each web page.

    A site is a restaurant whose domain is www.name.com, the name being its host without
    ``.example`` and what follows; a page was found by the first two words of
    its title, ASCII letters only.
    """
    p = src["pages"]
    letters = F.regexp_replace(F.regexp_extract("html", "<title>(.*?)</title>", 1), "[^A-Za-z ]", "")
    words = F.split(F.trim(F.regexp_replace(F.lower(letters), " +", " ")), " ")
    name = F.regexp_extract("url", r"^[a-z]+://([^/]+)\.example\.", 1)
    return p.select(
        F.substring(F.md5(name.cast("binary")), 1, 8).alias("restaurant_id"),
        F.concat(F.lit("www."), name, F.lit(".com")).alias("domain"),
        F.array_join(F.slice(words, 1, 2), " ").alias("search_term"),
        (F.col("page_id") % 40).cast("long").alias("clicks"),
        F.length("html").cast("long").alias("impressions"),
    )


def cuisine_changes(src: Sources) -> DataFrame:
    """Change events (restaurant_id, day, seq, cuisines): one for each order; ``seq`` orders those of a day."""
    o = src["orders"]
    k = F.col("o_orderkey")
    n = (k * 31 + F.length("o_orderpriority")) % 5
    cuisines = (
        F.when(n == 0, F.lit('["Italian"]')).when(n == 1, F.lit('["Thai"]')).when(n == 2, F.lit('["Mexican","Thai"]')).when(n == 3, F.lit("[]"))
    )
    return o.select(
        (F.col("o_custkey") % 40 + 10).cast("int").alias("restaurant_id"), F.col("o_orderdate").cast("date").alias("day"), k.alias("seq"), cuisines.alias("cuisines")
    )


def restaurant_sales(src: Sources) -> DataFrame:
    """Sales (restaurant_id, day, cents): one for each order, also before a restaurant's first change and of some without one."""
    o = src["orders"]
    return o.select(
        (F.col("o_custkey") % 43 + 10).cast("int").alias("restaurant_id"),
        F.date_sub(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 30).cast("int")).alias("day"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"),
    )


def cuisine_export(src: Sources) -> DataFrame:
    """Cuisines (restaurant_id, cuisines JSON list), one row per brand."""
    p = src["part"]
    brands = p.select(F.split_part("p_brand", F.lit("#"), F.lit(2)).cast("int").alias("restaurant_id")).distinct()
    n = F.col("restaurant_id")
    cuisines = (
        F.when(n % 5 == 0, F.lit(None).cast("string"))
        .when(n % 3 == 0, F.lit('["Italian"," Thai "]'))
        .when(n % 7 == 0, F.lit("[]"))
        .otherwise(F.lit('["Mexican"]'))
    )
    return brands.select("restaurant_id", cuisines.alias("cuisines"))
