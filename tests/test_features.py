"""The feature table on a small shop where every row forces one trap."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import CUSTOMERS, EXPECTED_FEATURES, ORDERS, PAYMENTS, REVIEWS, feature_rows, shop_tables
from pyspark.sql import functions as F

from winback import ShopTables, build_features, churn_rate_report, generate_churn_labels
from winback.functions import whole_days
from winback.operators import features as feature_module
from winback.operators.features import logistics_features, monetary_features, review_features


def test_features_of_the_small_shop(shop, hot_or_even):
    df = build_features(shop)
    assert df.columns == [
        "customer_unique_id", "frequency", "avg_delivery_days", "monetary_value", "avg_installments",
        "avg_review_score", "is_churn", "recency", "has_review",
    ]
    assert feature_rows(df) == EXPECTED_FEATURES


def test_features_with_labels_made_elsewhere(shop):
    labels = generate_churn_labels(shop.orders, shop.customers)
    assert feature_rows(build_features(shop, labels)) == EXPECTED_FEATURES


def test_labels_that_leave_people_out_drop_them_before_means(shop):
    labels = generate_churn_labels(shop.orders, shop.customers).filter("customer_unique_id != 'U7'")
    rows = feature_rows(build_features(shop, labels))
    assert "U7" not in rows
    # known and state-filled days: U1 6.5, U2 -1, U6 2.75
    assert rows["U3"][1] == pytest.approx((6.5 - 1 + 2.75) / 3)


def test_states_too_many_to_broadcast(spark, shop):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = build_features(shop)
        assert "Broadcast" not in plan_of(df)
        assert feature_rows(df) == EXPECTED_FEATURES
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("partitions", [1, 7, 50])
def test_row_order_and_partitions_do_not_matter(spark, partitions):
    tables = shop_tables(spark, CUSTOMERS[::-1], ORDERS[::-1], PAYMENTS[::-1], REVIEWS[::-1])
    spread = ShopTables(**{name: getattr(tables, name).repartition(partitions) for name in tables.found()})
    assert feature_rows(build_features(spread)) == EXPECTED_FEATURES


def test_repeated_rows_multiply_like_joins_do(spark, hot_or_even):
    """Two copies of an order and of a customer account count four times, payments included."""
    tables = shop_tables(spark, CUSTOMERS + [CUSTOMERS[0]], ORDERS + [ORDERS[0]])
    row = feature_rows(build_features(tables))["U1"]
    assert row[0] == 4 + 1
    assert row[2] == 4 * 150 + 30
    assert row[3] == pytest.approx((4 * (1 + 3) + 5) / (4 * 2 + 1))


def test_null_keys_never_match_but_nameless_accounts_count_for_the_snapshot(spark, hot_or_even):
    customers = CUSTOMERS + [("c20", None, "SP"), (None, "U20", "SP")]
    orders = ORDERS + [
        (None, "c8", "delivered", "2018-05-03 00:00:00", "2018-05-05 00:00:00"),
        ("o20", "c20", "delivered", "2018-08-01 12:00:00", None),
        ("o21", None, "delivered", "2019-05-01 12:00:00", None),
    ]
    payments = PAYMENTS + [(None, "9", "9000")]
    rows = feature_rows(build_features(shop_tables(spark, customers, orders, payments)))
    assert rows.keys() == EXPECTED_FEATURES.keys()
    # the order without an id is no order, but its delivery counts; its null id meets no payment
    assert rows["U7"][:3] == (1, 11.0, 75.0)
    # the nameless account moved the snapshot by eleven days, the order of no account did not
    assert rows["U3"][7] == 11


def test_state_comes_from_the_earliest_order(shop):
    states = {r["customer_unique_id"]: r["customer_state"] for r in logistics_features(shop.orders, shop.customers).collect()}
    assert states["U1"] == "SP"


def test_single_branches_match_the_feature_table(shop, hot_or_even):
    spend = {r[0]: (r[1], r[2]) for r in monetary_features(shop.payments, shop.orders, shop.customers).collect()}
    assert spend == {"U1": (180.0, 3.0), "U2": (10.0, 1.0), "U3": (500.0, 10.0), "U4": (0.0, 1.0), "U7": (75.0, 1.5)}
    stars = {r[0]: r[1] for r in review_features(shop.reviews, shop.orders, shop.customers).collect()}
    assert stars == {"U1": 3.0, "U2": 4.0, "U4": 2.0, "U7": 5.0}


def test_labels(shop):
    rows = {r["customer_unique_id"]: r for r in generate_churn_labels(shop.orders, shop.customers).collect()}
    assert rows.keys() == EXPECTED_FEATURES.keys()
    assert {person: (row["is_churn"], row["recency"]) for person, row in rows.items()} == {
        person: values[6:] for person, values in EXPECTED_FEATURES.items()
    }
    assert rows["U3"]["last_order_date"] == dt.datetime(2018, 7, 21, 12)


def test_churn_report(shop):
    labels = generate_churn_labels(shop.orders, shop.customers)
    assert churn_rate_report(labels).first().asDict() == {
        "snapshot_date": dt.date(2018, 7, 21),
        "people": 6,
        "churn_rate": pytest.approx(1 / 6),
    }


def test_as_of_moves_the_snapshot_and_hides_later_orders(shop):
    as_of = dt.datetime(2018, 5, 1)
    rows = feature_rows(build_features(shop, as_of=as_of))
    assert rows.keys() == {"U1", "U2", "U4", "U6"}
    assert rows["U1"][0] == 1 and rows["U6"][7] == 0


def test_empty_shop(spark, shop):
    nothing = ShopTables(
        customers=shop.customers, orders=shop.orders.limit(0), payments=shop.payments, reviews=shop.reviews
    )
    assert build_features(nothing).count() == 0
    labels = generate_churn_labels(nothing.orders, nothing.customers)
    assert churn_rate_report(labels).first().asDict() == {"snapshot_date": None, "people": 0, "churn_rate": None}


def test_missing_tables_are_named(shop):
    with pytest.raises(ValueError, match="payments, reviews"):
        build_features(ShopTables(customers=shop.customers, orders=shop.orders))


@pytest.mark.parametrize(
    ("start", "end", "days"),
    [
        ("2018-01-01 23:00:00", "2018-01-02 01:00:00", 0),
        ("2018-01-02 01:00:00", "2018-01-01 23:00:00", -1),
        ("2018-01-02 00:00:00", "2018-01-01 00:00:00", -1),
        ("2018-01-02 00:00:00.000001", "2018-01-01 00:00:00", -2),
        ("2018-01-01 00:00:00", "2018-01-03 23:59:59.999999", 2),
        (None, "2018-01-03 00:00:00", None),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_whole_days(spark, start, end, days, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(start, end)], "a string, b string")
        moments = df.select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
        assert moments.select(whole_days(F.col("a"), F.col("b"))).first()[0] == days
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_snapshot_is_free_of_time_zones(spark, shop):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        assert feature_rows(build_features(shop)) == EXPECTED_FEATURES
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rollup_scans_each_table_once_and_never_windows(spark):
    from winback import load_warehouse

    tables = load_warehouse(spark, "/root/testdata/sf0.001")
    plan = plan_of(
        feature_module.person_rollup(tables.orders, tables.customers, tables.payments, tables.reviews)
    )
    for name in ("orders", "customer", "lineitem", "events"):
        assert plan.count(f"sf0.001/{name}.parquet") == 1, name
    assert "Window" not in plan and "Cartesian" not in plan and "BroadcastNestedLoop" not in plan
    assert "EqualTo(o_orderstatus,F)" in plan
    assert "l_discount" not in plan
