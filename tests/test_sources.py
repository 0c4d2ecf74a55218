"""CSV quirks, parquet round trip, lead list sink."""

from __future__ import annotations

import csv
import datetime as dt
import logging

import pytest
from conftest import EXPECTED_FEATURES, CUSTOMERS, ORDERS, PAYMENTS, REVIEWS, feature_rows

from pyspark.sql import functions as F

from winback import build_features, load_and_clean_data, load_tables, save_tables, write_leads
from winback.operators import leads
from winback.plans import registry
from winback.sources import csv_rejects


def write_csv(path, header, rows):
    with open(path, "w", newline="") as handle:
        writer = csv.writer(handle)
        writer.writerow(header)
        writer.writerows([["" if value is None else value for value in row] for row in rows])


@pytest.fixture
def csv_shop(tmp_path):
    write_csv(
        tmp_path / "shop_customers_dataset.csv",
        ["customer_state", "customer_city", "customer_id", "customer_unique_id"],
        [(state, "x", account, person) for account, person, state in CUSTOMERS],
    )
    write_csv(
        tmp_path / "shop_orders_dataset.csv",
        [
            "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
            "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
        ],
        [(a, b, c, bought, bought, "NaN", arrived, "2018-02-30 00:00:00") for a, b, c, bought, arrived in ORDERS],
    )
    write_csv(
        tmp_path / "shop_order_payments_dataset.csv",
        ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
        [(order, 1, "card", n, "NA" if value is None else value) for order, n, value in PAYMENTS],
    )
    write_csv(
        tmp_path / "shop_order_reviews_dataset.csv",
        ["review_id", "order_id", "review_score", "review_comment_message"],
        [("r", order, score, 'two\nlines, "quoted"\n') for order, score in REVIEWS]
        + [("r", "o5", "null", "no score"), ("r", "o8", "n/a", "")],
    )
    return tmp_path


def test_features_from_csv(spark, csv_shop):
    tables = load_and_clean_data(spark, str(csv_shop))
    assert tables.found() == ["customers", "orders", "payments", "reviews"]
    assert tables.reviews.count() == len(REVIEWS) + 2
    assert feature_rows(build_features(tables)) == EXPECTED_FEATURES


def test_dates_and_missing_tokens(spark, csv_shop):
    orders = {row["order_id"]: row for row in load_and_clean_data(spark, str(csv_shop)).orders.collect()}
    assert "o7" not in orders
    assert orders["o6"]["order_delivered_customer_date"] is None
    assert orders["o1"]["order_delivered_customer_date"] == dt.datetime(2018, 1, 5, 9)
    assert {row["order_estimated_delivery_date"] for row in orders.values()} == {None}
    assert {row["order_delivered_carrier_date"] for row in orders.values()} == {None}


def test_missing_file_warns_and_leaves_the_table_out(spark, csv_shop, caplog):
    with caplog.at_level(logging.WARNING):
        tables = load_and_clean_data(spark, str(csv_shop), files={"payments": "nothing.csv"})
    assert tables.payments is None and tables.geolocation is None
    assert "payments" in caplog.text
    with pytest.raises(ValueError, match="payments"):
        build_features(tables)


def test_parts_may_order_their_columns_differently(spark, csv_shop):
    rows = [("RJ", "c99", "y", "U99", "z"), ("SP", "c98", "y", "U98", "z")]
    write_csv(csv_shop / "more_customers_dataset.csv", ["customer_state", "customer_id", "customer_city", "customer_unique_id", "zip"], rows)
    got = {row["customer_id"]: (row["customer_unique_id"], row["customer_state"]) for row in load_and_clean_data(spark, str(csv_shop)).customers.collect()}
    assert got["c99"] == ("U99", "RJ") and got["c98"] == ("U98", "SP") and got["c1"] == ("U1", "SP")
    assert len(got) == len(CUSTOMERS) + 2


def test_a_part_without_a_column_is_an_error(spark, csv_shop):
    write_csv(csv_shop / "more_customers_dataset.csv", ["customer_id", "customer_unique_id"], [("c99", "U99")])
    with pytest.raises(ValueError, match="more_customers_dataset.csv has no column customer_state"):
        load_and_clean_data(spark, str(csv_shop))


def test_compressed_and_empty_parts(spark, csv_shop):
    import gzip

    with gzip.open(csv_shop / "zipped_customers_dataset.csv.gz", "wt") as handle:
        handle.write("customer_unique_id,customer_id,customer_state\nU97,c97,MG\n")
    (csv_shop / "none_customers_dataset.csv").write_text("")
    tables = load_and_clean_data(spark, str(csv_shop), files={"customers": "*_customers_dataset.csv*"})
    assert tables.customers.count() == len(CUSTOMERS) + 1
    assert tables.customers.filter("customer_id = 'c97'").first()["customer_unique_id"] == "U97"


def test_rejects_name_file_reason_and_text(spark, csv_shop):
    path = csv_shop / "late_order_payments_dataset.csv"
    path.write_text("order_id,payment_installments,payment_value\no1,1,12.5\no2,1.5d,7\no3,1,2,3\no4,NA,n/a\no5,two,three\n")
    found = csv_rejects(spark, str(csv_shop)).filter("table = 'payments'").collect()
    assert {row["file"].rsplit("/", 1)[1] for row in found} == {path.name}
    assert sorted((row["reason"], row["text"]) for row in found) == [
        ("malformed line", "o3,1,2,3"),
        ("no number: payment_installments", "1.5d"),
        ("no number: payment_installments", "two"),
        ("no number: payment_value", "three"),
    ]
    dates = csv_rejects(spark, str(csv_shop)).filter("table = 'orders'").groupBy("reason").count().collect()
    assert dict(dates) == {"no date: order_estimated_delivery_date": len(ORDERS), "no date: order_delivered_customer_date": 1}
    # the same lines are still read as far as they go
    payments = load_and_clean_data(spark, str(csv_shop)).payments.filter("order_id in ('o2', 'o5')").collect()
    assert any(row["payment_installments"] is None and row["payment_value"] == 7 for row in payments)
    assert csv_rejects(spark, str(csv_shop / "nothing")).count() == 0


def test_only_whole_dates_and_numbers_are_read(spark):
    from winback.functions import known_number, safe_timestamp

    texts = ["2018-05-01", "2018-05-01 10:00:00", "2018-05-01T10:00:00.5", "2018", "2018-05", "2018-05-01 10:00:00+03:00", "2018-05-01 10:00:00Z", "10:00:00", " 2018-05-01 "]
    df = spark.createDataFrame([(text,) for text in texts], "text string")
    got = [row[0] for row in df.select(safe_timestamp(F.col("text"))).collect()]
    day = dt.datetime(2018, 5, 1)
    assert got == [day, day.replace(hour=10), day.replace(hour=10, microsecond=500_000), None, None, None, None, None, day]
    numbers = ["1", "-1.5", "+.5", "2.", "1e3", "1.5d", "2f", "0x1f", "1_000", "1,5", "nan", " 7 ", "inf"]
    df = spark.createDataFrame([(text,) for text in numbers], "text string")
    got = [row[0] for row in df.select(known_number(F.col("text"))).collect()]
    assert got == [1, -1.5, 0.5, 2, 1000, None, None, None, None, None, None, 7, float("inf")]


def test_positions_and_a_list_that_is_replaced_whole(spark, tmp_path):
    rows = [(f"U{at:03}", (at * 37 % 101) / 10) for at in range(200)]
    listed = spark.createDataFrame(rows, "customer_unique_id string, churn_probability double").repartition(7)
    expected = sorted(rows, key=lambda row: (-row[1], row[0]))
    got = leads.with_position(listed).collect()
    assert sorted((row["position"], row["customer_unique_id"]) for row in got) == [(at, person) for at, (person, _) in enumerate(expected, 1)]
    assert leads.with_position(listed.limit(0)).count() == 0
    path = str(tmp_path / "list")
    write_leads(leads.with_position(listed), path)
    broken = listed.withColumn("churn_probability", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        write_leads(broken, path)
    assert spark.read.parquet(path).count() == 200
    write_leads(listed.limit(3), path + "/", "csv")
    assert [entry.name for entry in tmp_path.iterdir()] == ["list"] and spark.read.csv(path, header=True).count() == 3


def test_empty_folder(spark, tmp_path):
    assert load_and_clean_data(spark, str(tmp_path)).found() == []


def test_geolocation_is_read_when_present(spark, csv_shop):
    write_csv(csv_shop / "shop_geolocation_dataset.csv", ["geolocation_state"], [("SP",)])
    assert load_and_clean_data(spark, str(csv_shop)).geolocation.count() == 1


def test_parquet_round_trip(spark, csv_shop, tmp_path):
    save_tables(load_and_clean_data(spark, str(csv_shop)), str(tmp_path / "converted"))
    tables = load_tables(spark, str(tmp_path / "converted"))
    assert tables.found() == ["customers", "orders", "payments", "reviews"]
    assert feature_rows(build_features(tables)) == EXPECTED_FEATURES


def test_lead_list_sink(spark, tmp_path):
    leads = spark.createDataFrame([("U1", 0.9), ("U2", 0.8)], "customer_unique_id string, churn_probability double")
    write_leads(leads, str(tmp_path / "csv"), "csv", single_file=True)
    (part,) = list((tmp_path / "csv").glob("part-*.csv"))
    assert part.read_text().splitlines() == ["customer_unique_id,churn_probability", "U1,0.9", "U2,0.8"]
    write_leads(leads, str(tmp_path / "parquet"))
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == 2


def test_broken_payments_are_written_by_many_tasks(spark, tmp_path):
    registry._broken_payments(spark.range(600).withColumnRenamed("id", "order_id").repartition(3), str(tmp_path))
    files = sorted(tmp_path.glob("shop2_order_payments_dataset.csv/part-*.csv"))
    lines = [file.read_text().splitlines() for file in files]
    assert len(files) == 3 and {first for first, *_ in lines} == {"order_id,payment_installments,payment_value"}
    assert {line for _, *rest in lines for line in rest} == {
        f"{n},1,{['x12', '12,ab', 'NA'][n % 3]}" for n in range(0, 600, 2)
    }
    counts = csv_rejects(spark, str(tmp_path)).groupBy("reason").count().collect()
    assert {tuple(row) for row in counts} == {("malformed line", 200), ("no number: payment_value", 200)}
