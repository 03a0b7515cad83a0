"""Hand-made edge rows: Spark operators against the literal-form oracle SQL
(run by DuckDB on the same rows), plus operator-level unit tests."""

import datetime as dt
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

from mortar import oracle
from mortar.operators import checks, text
from mortar.plans import customers as saas
from mortar.plans import examples, orders as shop, search
from mortar.verify import compare

D = dt.date
TS = dt.datetime


def _duck_tables(spark, tables: dict) -> duckdb.DuckDBPyConnection:
    """Write each Spark DataFrame to Parquet and expose it to DuckDB."""
    root = tempfile.mkdtemp(prefix="mortar-edge-")
    con = duckdb.connect()
    for name, df in tables.items():
        path = f"{root}/{name}"
        df.write.mode("overwrite").parquet(path)
        con.execute(f"create view {name} as select * from read_parquet('{path}/*.parquet')")
    return con


# --------------------------------------------------------------------------- SaaS


@pytest.fixture(scope="module")
def saas_tables(spark):
    customers = spark.createDataFrame(
        [
            ("cust000001", D(2023, 3, 1), "east", "technology"),
            ("cust000001", D(2023, 6, 1), "east", "technology"),  # repeated id, later date
            ("cust000002", D(2025, 1, 5), "west", "retail"),  # acquired after the spine: no days
            ("cust000003", D(2022, 12, 1), "north", "banking"),  # acquired before the spine
            (None, D(2024, 6, 1), "north", "banking"),  # no id: days, but nothing joins
            ("cust000004", None, "north", "banking"),  # no acquisition date: no days
        ],
        "customer_id string, acquisition_date date, region string, industry string",
    )
    subs = spark.createDataFrame(
        [
            ("cust000001", "prod0001", 1, D(2023, 2, 1), None, 999),  # open-ended
            ("cust000001", "prod0001", 2, D(2023, 3, 10), D(2023, 4, 10), 1999),  # same product, overlapping
            ("cust000001", "prod0002", 1, D(2023, 5, 1), D(2023, 5, 1), 4999),  # one day
            ("cust000001", "prod0003", 1, D(2023, 6, 1), D(2023, 7, 1), None),  # NULL arr
            ("cust000003", "prod0004", 1, D(2022, 1, 1), D(2023, 1, 15), 999),  # ends early in the spine
            ("cust000003", "prod0004", 1, D(2024, 12, 1), D(2025, 3, 1), 999),  # ends after the spine
            ("cust000009", "prod0001", 1, D(2023, 1, 1), D(2024, 1, 1), 999),  # unknown customer
            ("cust000001", "prod0009", 1, None, D(2024, 1, 1), 999),  # no start: never active
            (None, "prod0001", 1, D(2023, 1, 1), D(2024, 12, 1), 999),  # no customer
        ],
        "customer_id string, product_id string, quantity int, start_date date, end_date date, arr int",
    )
    logins = spark.createDataFrame(
        [
            ("user000001", "cust000001", "admin", TS(2023, 3, 5, 10)),
            ("user000001", "cust000001", "admin", TS(2023, 3, 5, 11)),  # same user, same day
            ("user000001", "cust000001", "standard", TS(2023, 3, 5, 12)),  # same user, other type
            (None, "cust000001", "advanced", TS(2023, 3, 5, 13)),  # no user id
            ("user000002", "cust000001", "advanced", TS(2023, 2, 1, 9)),  # before acquisition
            ("user000003", "cust000003", "standard", TS(2024, 12, 30, 23)),  # last spine day
            ("user000003", "cust000003", "standard", TS(2023, 6, 30, 1)),
        ],
        "user_id string, customer_id string, user_type string, login_timestamp timestamp_ntz",
    )
    tickets = spark.createDataFrame(
        [
            ("t1", "cust000001", "closed", TS(2023, 3, 2, 8), "bug", TS(2023, 3, 2, 17)),  # closed same day
            ("t2", "cust000001", "open", TS(2023, 3, 3, 8), "incident", None),  # open forever
            ("t3", "cust000001", "closed", TS(2023, 3, 4, 8), "question", TS(2023, 3, 24, 8)),  # 20 days
            ("t4", "cust000001", "on-hold", TS(2023, 3, 5, 8), "feature request", TS(2023, 3, 6, 8)),  # not closed
            ("t5", "cust000001", "closed", TS(2023, 1, 10, 8), "bug", TS(2023, 3, 20, 8)),  # before acquisition
            ("t6", "cust000003", "closed", TS(2023, 5, 1, 8), "bug", TS(2025, 2, 1, 8)),  # closes after the spine
            ("t7", "cust000001", "open", None, "bug", None),  # no creation date: never open
            ("t8", None, "open", TS(2024, 7, 1, 8), "bug", None),  # no customer
            *[(f"a{i}", "cust000003", "open", TS(2023, 1, 1 + i, 8), "bug", None) for i in range(5)],  # aging
        ],
        "ticket_id string, customer_id string, status string, created_date timestamp_ntz, "
        "ticket_category string, closed_date timestamp_ntz",
    )
    tables = {
        "saas_customers": customers,
        "saas_subscriptions": subs,
        "saas_login_events": logins,
        "saas_support_tickets": tickets,
    }
    return tables, _duck_tables(spark, tables)


def test_daily_metrics_edge_rows(saas_tables):
    t, con = saas_tables
    args = (t["saas_customers"], t["saas_subscriptions"], t["saas_login_events"], t["saas_support_tickets"])
    df = saas.daily_metrics(*args)
    sql = oracle.saas_on_tables(oracle._DAILY + "select * from final")
    res = compare(df, sql, con)
    assert res["exact"], res
    # The customer acquired after the spine has no daily rows.
    assert df.where(F.col("customer_id") == "cust000002").count() == 0


@pytest.mark.parametrize("mode", ["literal", "cumulative"])
def test_open_tickets_edge_rows(saas_tables, mode):
    t, con = saas_tables
    df = saas.open_tickets_daily(t["saas_customers"], t["saas_support_tickets"], tickets_mode=mode)
    total = oracle.LITERAL_TOTAL if mode == "literal" else oracle.CUMULATIVE_TOTAL
    sql = oracle.saas_on_tables(oracle._ticket_metrics(total) + oracle.TICKETS_SELECT)
    res = compare(df, sql, con)
    assert res["exact"], res


def test_active_subscriptions_edge_rows(saas_tables):
    t, con = saas_tables
    df = saas.active_subscriptions(t["saas_customers"], t["saas_subscriptions"])
    sql = oracle.saas_on_tables(oracle.SUB_METRICS + """select customer_id, date, cast(num_products as bigint) as num_products,
  cast(total_arr as bigint) as total_arr, total_mrr, cast(num_products_90d_ago as bigint) as num_products_90d_ago,
  cast(total_arr_90d_ago as bigint) as total_arr_90d_ago, total_mrr_90d_ago from daily_subscription_metrics""")
    res = compare(df, sql, con)
    assert res["exact"], res
    one = df.where((F.col("customer_id") == "cust000001") & (F.col("date") == D(2023, 3, 15))).first()
    assert one["num_products"] == 1  # two overlapping prod0001 subscriptions count once
    assert one["total_arr"] == 999 + 1999
    nul = df.where((F.col("customer_id") == "cust000001") & (F.col("date") == D(2023, 6, 15))).first()
    assert nul["num_products"] == 2  # prod0001 (open) + prod0003 (NULL arr)


def test_customers_enriched_edge_rows(saas_tables):
    t, _ = saas_tables
    daily = saas.daily_metrics(t["saas_customers"], t["saas_subscriptions"], t["saas_login_events"], t["saas_support_tickets"])
    enriched = saas.customers_enriched(t["saas_customers"].dropDuplicates(["customer_id"]), daily, as_of="2026-01-01")
    rows = {r["customer_id"]: r for r in enriched.collect()}
    assert rows["cust000002"]["last_metrics_date"] is None  # no daily rows -> NULL metrics
    assert rows["cust000001"]["last_metrics_date"] == D(2024, 12, 30)
    assert rows["cust000003"]["days_since_last_activity"] == (D(2026, 1, 1) - D(2024, 12, 30)).days


def test_flat_day_scores_fifty(spark):
    customers = spark.createDataFrame([("c1", D(2024, 12, 1), "east", "retail")],
                                      "customer_id string, acquisition_date date, region string, industry string")
    empty_subs = spark.createDataFrame([], "customer_id string, product_id string, quantity int, start_date date, end_date date, arr int")
    empty_logins = spark.createDataFrame([], "user_id string, customer_id string, user_type string, login_timestamp timestamp_ntz")
    empty_tix = spark.createDataFrame([], "ticket_id string, customer_id string, status string, created_date timestamp_ntz, ticket_category string, closed_date timestamp_ntz")
    df = saas.daily_metrics(customers, empty_subs, empty_logins, empty_tix)
    scores = {r[0] for r in df.select("customer_risk_score").collect()}
    assert scores == {50.0}
    assert df.count() == 30


# --------------------------------------------------------------------------- shop


def test_customer_orders_edge_rows(spark):
    customers = spark.createDataFrame([(1, "A", "One"), (2, "B", "Two")], "id long, first_name string, last_name string")
    orders = spark.createDataFrame(
        [
            (10, 1, D(2020, 1, 1), "completed"),
            (11, 1, D(2020, 1, 1), "placed"),  # two orders on the first date: both 'new'
            (12, 1, D(2020, 2, 1), "returned"),
            (13, None, D(2020, 3, 1), "placed"),  # NULL customer
            (14, 7, D(2020, 3, 2), "placed"),  # unknown customer
        ],
        "id long, user_id long, order_date date, status string",
    )
    payments = spark.createDataFrame(
        [
            ("p1", 10, "coupon", "success", 1000, D(2020, 1, 2)),
            ("p2", 10, "coupon", "fail", 500, D(2020, 1, 3)),  # dropped
            ("p3", 11, "coupon", None, 700, D(2020, 1, 2)),  # NULL status: dropped by <> 'fail'
            ("p4", 12, "gift_card", "success", 250, D(2020, 2, 2)),
            ("p5", 13, "gift_card", "success", 100, D(2020, 3, 2)),
        ],
        "id string, orderid long, paymentmethod string, status string, amount long, created date",
    )
    con = _duck_tables(spark, {"shop_customers": customers, "shop_orders": orders, "stripe_payments": payments})
    df = shop.customer_orders(orders, payments, customers)
    res = compare(df, oracle.shop_on_tables(oracle.CUSTOMER_ORDERS), con)
    assert res["exact"], res
    rows = {r["order_id"]: r for r in shop.customer_orders(orders, payments, customers).collect()}
    assert rows[10]["nvsr"] == rows[11]["nvsr"] == "new"
    assert rows[13]["customer_lifetime_value"] is None
    assert [rows[k]["transaction_seq"] for k in sorted(rows)] == [1, 2, 3, 4, 5]
    # rows come out in order_id order (range partitions in key order)
    ordered = [r["order_id"] for r in shop.customer_orders(orders, payments, customers).collect()]
    assert ordered == sorted(ordered)
    # dim_customers and the status pivot on the same rows
    stg_o, stg_p, stg_c = shop.stg_orders(orders), shop.stg_payments(payments), shop.stg_customers(customers)
    res = compare(shop.dim_customers(stg_c, stg_o, stg_p), oracle.shop_on_tables(oracle.DIM_CUSTOMERS), con)
    assert res["exact"], res
    piv = {(r["customer_id"], r["order_date"]): r for r in shop.order_status_pivot(stg_o).collect()}
    assert piv[(1, D(2020, 1, 1))]["shipped_orders"] == 0  # absent status -> 0, not NULL
    assert piv[(1, D(2020, 1, 1))]["placed_orders"] == 1


# --------------------------------------------------------------------------- search


def _doc(rows):
    return '{"rows":[' + ",".join(rows) + "]}"


def test_search_edge_rows(spark):
    row = '{{"keys":["{t}"],"clicks":{c},"impressions":{i},"ctr":{r},"position":{p}}}'
    export = spark.createDataFrame(
        [
            (1, "www.brand1.com", TS(2024, 1, 1), TS(2024, 1, 1), "ok", _doc([
                row.format(t="brand1 pizza", c=3, i=50, r=0.06, p=2.995),
                row.format(t="cheap pizza", c=0, i=40, r=0.0, p=12.5),
                row.format(t="brand1", c=5, i=10, r=0.5, p=1.005),
            ])),
            (2, "www.unknown.com", TS(2024, 1, 1), TS(2024, 1, 1), "ok", _doc([  # no branded term
                row.format(t="tacos near me", c=1, i=20, r=0.05, p=25.0),
                row.format(t="tacos", c=2, i=20, r=0.1, p=9.5),
            ])),
            (3, "wwwxfooxcom", TS(2024, 1, 1), TS(2024, 1, 1), "ok", _doc([
                row.format(t="wwwxfooxcom", c=1, i=10, r=0.1, p=3.0),
            ])),
        ],
        "restaurant_id int, domain string, _updated_at timestamp_ntz, _created_at timestamp_ntz, status string, data string",
    )
    cuisines = spark.createDataFrame(
        [(1, '["Italian"," Thai "]'), (2, "[]"), (3, '["Italian"]')], "restaurant_id int, cuisines string"
    )
    con = _duck_tables(spark, {"search_export": export, "cuisine_export": cuisines})
    terms = search.search_terms(search.stg_search_export(export))
    res = compare(terms, oracle.search_on_tables("select * from terms"), con)
    assert res["exact"], res
    rest = search.restaurant_metrics(terms, search.stg_cuisines(cuisines))
    res = compare(rest, oracle.search_on_tables("select * from final"), con)
    assert res["exact"], res
    r2 = rest.where("restaurant_id = 2").first()
    assert r2["branded_clicks"] is None and r2["branded_clicks_pct"] is None
    cm = search.cuisine_metrics(rest)
    assert {r["cuisine"] for r in cm.collect()} == {"Italian", "Thai"}  # trimmed; empty list drops


EXPORT = "restaurant_id int, domain string, _updated_at timestamp_ntz, _created_at timestamp_ntz, status string, data string"


def test_malformed_json_fails_and_can_be_told_beforehand(spark):
    export = spark.createDataFrame(
        [
            (1, "www.a.com", None, None, "ok", "{not json"),
            (2, "www.b.com", None, None, "ok", None),
            (3, "www.c.com", None, None, "ok", '{"rows":[{"keys":[],"clicks":1,"impressions":2,"ctr":0.5,"position":1}]}'),
            (4, "www.d.com", None, None, "ok", '{"rows":[{"keys":["x"],"clicks":"3","impressions":"2","ctr":"0.5","position":"1.25"}]}'),
            (5, "www.e.com", None, None, "ok", '{"other":1}'),
        ],
        EXPORT,
    )
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        search.search_terms(search.stg_search_export(export)).collect()
    bad = export.where(text.malformed_json("data"))
    assert [r["restaurant_id"] for r in bad.collect()] == [1]
    good = export.where(~text.malformed_json("data"))
    terms = sorted(search.search_terms(search.stg_search_export(good)).collect(), key=lambda r: r["restaurant_id"])
    assert [r["restaurant_id"] for r in terms] == [3, 4]
    assert terms[0]["search_term"] is None  # keys[0] of an empty list
    assert terms[0]["search_type"] == "Unbranded" and terms[0]["brand_similarity_score"] is None
    assert (terms[1]["clicks"], terms[1]["impressions"], terms[1]["ctr"], terms[1]["avg_position"]) == (3, 2, 0.5, 1.25)


# --------------------------------------------------------------------------- examples and checks


def test_example_models_and_checks(spark):
    first = examples.first_model(spark)
    second = examples.second_model(first)
    assert [r["id"] for r in second.collect()] == [1]
    summary = {(r["test"], r["column_name"]): r["failures"]
               for r in checks.run_checks(first, checks.Tests(not_null=["id"], unique=["id"])).collect()}
    assert summary[("not_null", "id")] == 1  # the NULL id is reported, as designed
    assert summary[("unique", "id")] == 0
    assert checks.check_not_null(first, "id").count() == 1


def test_repeated_customer_multiplies_orders_as_the_joins_do(spark):
    customers = spark.createDataFrame([(1, "A", "One"), (1, "A", "One"), (2, "B", "Two")], "id long, first_name string, last_name string")
    orders = spark.createDataFrame(
        [(10, 1, D(2020, 1, 1), "completed"), (11, 2, D(2020, 1, 1), "placed"), (12, 1, D(2020, 2, 1), "returned")],
        "id long, user_id long, order_date date, status string",
    )
    payments = spark.createDataFrame(
        [("p1", 10, "coupon", "success", 1000, D(2020, 1, 2)), ("p2", 12, "coupon", "success", 50, D(2020, 1, 2))],
        "id string, orderid long, paymentmethod string, status string, amount long, created date",
    )
    con = _duck_tables(spark, {"shop_customers": customers, "shop_orders": orders, "stripe_payments": payments})
    got = shop.customer_orders(orders, payments, customers)
    seqs = ["transaction_seq", "customer_sales_seq"]
    # the two rows of an order are equal but for their numbers, which may be dealt either way
    sql = oracle.shop_on_tables(oracle.CUSTOMER_ORDERS)
    res = compare(got.drop(*seqs), f"select * exclude ({', '.join(seqs)}) from ({sql}) t", con)
    assert res["exact"] and res["spark_rows"] == 5, res
    for s in seqs:
        res = compare(got.select("order_id", s), f"select order_id, {s} from ({sql}) t", con)
        assert res["exact"], res


def test_ratios_are_exact_above_doubles(spark):
    from mortar.functions.columns import cents_to_dollars, idiv, round_ratio_units

    big = (1 << 53) + 1
    row = spark.createDataFrame([(big, 1)], "a long, b long").select(
        idiv(F.col("a"), F.col("b")).alias("q"),
        round_ratio_units(F.col("a") - 1, F.col("a") - 1, 2).alias("r"),
        cents_to_dollars(F.lit(1999), 4).alias("d"),
        cents_to_dollars(F.lit(1999), 1).alias("e"),
    ).first()
    assert (row["q"], row["r"], row["d"], row["e"]) == (big, 100, 19.99, 20.0)


def test_compare_tells_differing_missing_and_null_rows(spark):
    from mortar.operators.compare import compare_all_columns, compare_relations

    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None), (4, "z")], "id int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "w"), (3, None), (5, "z")], "id int, v string")
    counts = {(r["in_a"], r["in_b"]): r["count"] for r in compare_relations(a, b).collect()}
    assert counts == {(True, True): 2, (True, False): 2, (False, True): 2}
    r = compare_all_columns(a, b, ["id"]).first()
    assert (r["perfect_match"], r["null_in_both"], r["conflicting"], r["missing_from_a"], r["missing_from_b"]) == (1, 1, 1, 1, 1)


def test_every_kind_of_check_counts_failures(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", -1), (None, "q", None), (3, "q", 2)], "id int, kind string, n int")
    parent = spark.createDataFrame([(1,)], "pid int")
    spec = checks.Tests(
        not_null=["id"], unique=["id"], accepted={"kind": ["a", "b"]}, expressions={"n > 0": ("n", F.col("n") > 0)}, relationships={"id": (parent, "pid")}
    )
    got = {(r["test"], r["column_name"]): r["failures"] for r in checks.run_checks(df, spec).collect()}
    assert got == {("not_null", "id"): 1, ("unique", "id"): 1, ("accepted_values", "kind"): 1, ("n > 0", "n"): 1, ("relationships", "id"): 1}


def test_customer_orders_keeps_orders_without_an_id(spark):
    customers = spark.createDataFrame([(1, "A", "One"), (2, "B", "Two")], "id long, first_name string, last_name string")
    rows = [
        (10, 1, D(2020, 1, 1), "completed"),
        (0, 1, D(2020, 1, 3), "placed"),
        (None, 1, D(2019, 12, 1), "placed"),  # the customer's first date, and the last number
        (12, 2, D(2020, 2, 1), "returned"),
    ]
    more = [(None, 1, D(2020, 1, 5), "placed"), (None, 2, D(2020, 1, 5), None), (None, None, None, None), (None, 7, D(2020, 1, 5), "placed")]
    payments = spark.createDataFrame(
        [("p1", 10, "coupon", "success", 1000, D(2020, 1, 2)), ("p2", None, "coupon", "success", 70, D(2020, 1, 2)), ("p3", 12, "coupon", "success", 50, D(2020, 1, 2))],
        "id string, orderid long, paymentmethod string, status string, amount long, created date",
    )
    sql = oracle.shop_on_tables(oracle.CUSTOMER_ORDERS)
    seqs = ["transaction_seq", "customer_sales_seq"]
    for given, free in ((rows, []), (rows + more, seqs)):  # several orders without an id may be numbered either way
        orders = spark.createDataFrame(given, "id long, user_id long, order_date date, status string")
        con = _duck_tables(spark, {"shop_customers": customers, "shop_orders": orders, "stripe_payments": payments})
        got = shop.customer_orders(orders, payments, customers)
        res = compare(got.drop(*free), f"select * exclude ({', '.join(free)}) from ({sql}) t" if free else sql, con)
        assert res["exact"] and res["spark_rows"] == len(given), res
        found = got.collect()
        assert sorted(r["transaction_seq"] for r in found) == list(range(1, len(given) + 1))
        assert [r["order_id"] for r in found] == [0, 10, 12] + [None] * (len(given) - 3)
        assert sorted(r["customer_sales_seq"] for r in found if r["customer_id"] == 1) == list(range(1, sum(r[1] == 1 for r in given) + 1))
