"""One row per person: frequency, delivery time, spend, instalments, review score.

Everything that is summed is summed as early as possible: payments and reviews per order,
orders per account, accounts per person. Each step combines inside the tasks before it
shuffles, so a busy order, account or person travels as one row per task. Means are kept as
sum and count until the end, which leaves them weighted by payment and review rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winback.functions import moment, ratio, whole_days
from winback.operators.joins import join_to_unique
from winback.operators.labels import DEFAULT_THRESHOLD_DAYS, PERSON, label_people, orders_until
from winback.operators.reuse import checkpointed, measured
from winback.sources.schemas import ShopTables

FEATURES = [
    "frequency",
    "avg_delivery_days",
    "monetary_value",
    "avg_installments",
    "avg_review_score",
    "has_review",
]
NEUTRAL_REVIEW = 3.0

LEDGER_SUMS = ["payment_rows", "paid", "installment_sum", "installment_rows", "review_rows", "score_sum", "score_rows"]
ORDER_SUMS = ["frequency", "delivery_sum", "delivery_rows"]


def order_ledger(payments: DataFrame | None, reviews: DataFrame | None) -> DataFrame:
    """Payments and reviews summed per order, in one shuffle for both tables."""
    nothing = F.lit(None).cast("double")

    def rows(table: DataFrame, kind: str, value: Column, installments: Column, score: Column) -> DataFrame:
        return table.filter(F.col("order_id").isNotNull()).select(
            "order_id",
            F.lit(kind).alias("kind"),
            value.cast("double").alias("value"),
            installments.cast("double").alias("installments"),
            score.cast("double").alias("score"),
        )

    parts = []
    if payments is not None:
        parts.append(rows(payments, "payment", F.col("payment_value"), F.col("payment_installments"), nothing))
    if reviews is not None:
        parts.append(rows(reviews, "review", nothing, nothing, F.col("review_score")))
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("order_id")
        .agg(
            F.count(F.when(F.col("kind") == "payment", 1)).alias("payment_rows"),
            F.sum("value").alias("paid"),
            F.sum("installments").alias("installment_sum"),
            F.count("installments").alias("installment_rows"),
            F.count(F.when(F.col("kind") == "review", 1)).alias("review_rows"),
            F.sum("score").alias("score_sum"),
            F.count("score").alias("score_rows"),
        )
    )


def order_facts(orders: DataFrame, *carried: str) -> DataFrame:
    """Orders of known accounts with their delivery days (may be negative), and the columns to be carried along."""
    return orders.filter(F.col("customer_id").isNotNull()).select(
        "order_id",
        "customer_id",
        "order_purchase_timestamp",
        whole_days(F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")).alias("delivery_days"),
        *carried,
    )


def _account_columns(sums: Sequence[str], suffix: str = "", inside: Column | None = None) -> list[Column]:
    """Sums and dates per account, of all rows or of those ``inside``."""

    def chosen(name: str) -> Column:
        return F.col(name) if inside is None else F.when(inside, F.col(name))

    return [
        F.count(chosen("order_id")).alias(f"frequency{suffix}"),
        F.sum(chosen("delivery_days")).alias(f"delivery_sum{suffix}"),
        F.count(chosen("delivery_days")).alias(f"delivery_rows{suffix}"),
        F.min(chosen("order_purchase_timestamp")).alias(f"first_order_date{suffix}"),
        F.max(chosen("order_purchase_timestamp")).alias(f"last_order_date{suffix}"),
        *[F.sum(chosen(name)).alias(f"{name}{suffix}") for name in sums],
    ]


def _origin(suffix: str = "") -> Column:
    """The account as a candidate for the person's state; null where it has none."""
    first = F.col(f"first_order_date{suffix}")
    origin = F.struct(first.isNull().alias("undated"), first.alias("first_order_date"), "customer_id", "customer_state")
    return F.when(F.col("customer_state").isNotNull(), origin)


def _owned_accounts(
    orders: DataFrame,
    customers: DataFrame,
    payments: DataFrame | None,
    reviews: DataFrame | None,
    columns: Callable[[list[str]], list[Column]],
) -> tuple[DataFrame, list[str]]:
    """Accounts with an order, their person and state, and what ``columns`` sums of their orders; and the ledger's names."""
    facts, sums = order_facts(orders), []
    if payments is not None or reviews is not None:
        facts, sums = join_to_unique(facts, order_ledger(payments, reviews), "order_id"), LEDGER_SUMS
    accounts = facts.groupBy("customer_id").agg(*columns(sums))
    owners = customers.filter(F.col("customer_id").isNotNull()).select("customer_id", PERSON, "customer_state")
    return join_to_unique(owners, accounts, "customer_id", "inner"), sums


def person_partials(
    orders: DataFrame,
    customers: DataFrame,
    payments: DataFrame | None = None,
    reviews: DataFrame | None = None,
) -> DataFrame:
    """Sums, counts and dates per person from these orders; one null person for nameless accounts.

    Every column adds up across disjoint sets of orders (see :func:`merge_people`). ``origin``
    is the account the state is taken from: the one with the earliest order, the smallest
    account id on equal dates, among accounts that have a state.
    """
    owned, sums = _owned_accounts(orders, customers, payments, reviews, _account_columns)
    return merge_people(owned.withColumn("origin", _origin()), sums)


def merge_people(partials: DataFrame, sums: Sequence[str] = LEDGER_SUMS) -> DataFrame:
    """Add up partial rows of the same person."""
    return partials.groupBy(PERSON).agg(
        *[F.sum(name).alias(name) for name in [*ORDER_SUMS, *sums]],
        F.max("last_order_date").alias("last_order_date"),
        F.min("origin").alias("origin"),
    )


def person_rollup(
    orders: DataFrame,
    customers: DataFrame,
    payments: DataFrame | None = None,
    reviews: DataFrame | None = None,
) -> DataFrame:
    """:func:`person_partials` with the state read off."""
    people = person_partials(orders, customers, payments, reviews)
    return people.withColumn("customer_state", F.col("origin.customer_state")).drop("origin")


def person_averages(people: DataFrame) -> DataFrame:
    """Turn sums and counts into the unfilled features."""
    return people.select(
        PERSON,
        "customer_state",
        "last_order_date",
        "frequency",
        ratio(F.col("delivery_sum"), F.col("delivery_rows")).alias("avg_delivery_days"),
        F.col("paid").alias("monetary_value"),
        ratio(F.col("installment_sum"), F.col("installment_rows")).alias("avg_installments"),
        ratio(F.col("score_sum"), F.col("score_rows")).alias("avg_review_score"),
    )


def _named(people: DataFrame) -> DataFrame:
    return people.filter(F.col(PERSON).isNotNull())


def logistics_features(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """(person, frequency, avg_delivery_days, customer_state) before any filling."""
    return _named(person_rollup(orders, customers)).select(
        PERSON,
        "frequency",
        ratio(F.col("delivery_sum"), F.col("delivery_rows")).alias("avg_delivery_days"),
        "customer_state",
    )


def monetary_features(payments: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """(person, monetary_value, avg_installments) for people with a payment row."""
    people = _named(person_rollup(orders, customers, payments=payments))
    return people.filter(F.col("payment_rows") > 0).select(
        PERSON,
        F.coalesce("paid", F.lit(0.0)).alias("monetary_value"),
        ratio(F.col("installment_sum"), F.col("installment_rows")).alias("avg_installments"),
    )


def review_features(reviews: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """(person, avg_review_score) for people with a review row."""
    people = _named(person_rollup(orders, customers, reviews=reviews))
    return people.filter(F.col("review_rows") > 0).select(
        PERSON, ratio(F.col("score_sum"), F.col("score_rows")).alias("avg_review_score")
    )


def state_delivery_means(logistics: DataFrame) -> DataFrame:
    """Per known state the unweighted mean over people, one-time buyers included."""
    return (
        logistics.filter(F.col("customer_state").isNotNull())
        .groupBy("customer_state")
        .agg(F.count(F.lit(1)).alias("people"), F.avg("avg_delivery_days").alias("state_delivery_days"))
    )


@dataclass(frozen=True)
class StateSummary:
    """What filling and labelling need to know about all people."""

    means: DataFrame
    overall_days: float | None
    newest_order: dt.datetime | None


def state_summary(people: DataFrame) -> StateSummary:
    """One grouped pass over the people, then one row of totals.

    A row without a person counts for the newest order only; people without a state have no
    state mean. The overall mean is the one after the state fill: it follows from the
    per-state sums, since each gap of a state adds that state's mean.
    """
    named = F.col(PERSON).isNotNull()
    days = F.when(named, F.col("avg_delivery_days"))
    state_mean = F.col("state_delivery_days")
    filled = F.when(state_mean.isNotNull(), F.col("people")).otherwise(F.col("known"))
    gaps = F.coalesce((F.col("people") - F.col("known")) * state_mean, F.lit(0.0))
    states, totals = measured(
        people.groupBy("customer_state").agg(
            F.max("last_order_date").alias("newest"),
            F.sum(days).alias("day_sum"),
            F.count(days).alias("known"),
            F.count(F.when(named, 1)).alias("people"),
            F.when(F.col("customer_state").isNotNull(), F.avg(days)).alias("state_delivery_days"),
        ),
        F.max("newest").alias("newest"),
        F.try_divide(F.sum(F.coalesce("day_sum", F.lit(0.0)) + gaps), F.sum(filled).cast("double")).alias("overall"),
    )
    means = states.filter(F.col("customer_state").isNotNull()).select("customer_state", "state_delivery_days")
    return StateSummary(means, totals["overall"], totals["newest"])


def impute(people: DataFrame, summary: StateSummary) -> DataFrame:
    """Fill gaps: delivery days from the state, then from everyone; flag and fill reviews; zero spend.

    Means are taken over all people, before any train/test split.
    """
    overall = F.lit(summary.overall_days).cast("double")
    return (
        people.join(summary.means, "customer_state", "left")
        .withColumn("avg_delivery_days", F.coalesce("avg_delivery_days", "state_delivery_days", overall))
        .withColumn("has_review", F.col("avg_review_score").isNotNull().cast("int"))
        .withColumn("avg_review_score", F.coalesce("avg_review_score", F.lit(NEUTRAL_REVIEW)))
        .withColumn("monetary_value", F.coalesce("monetary_value", F.lit(0.0)))
        .withColumn("avg_installments", F.coalesce("avg_installments", F.lit(0.0)))
        .drop("customer_state", "state_delivery_days")
    )


def people_table(tables: ShopTables, as_of: dt.datetime | None = None) -> DataFrame:
    """Unfilled features, state and last order per person, computed once and stored.

    Includes the null person, who counts for the snapshot only.
    """
    orders, customers, payments, reviews = tables.require("orders", "customers", "payments", "reviews")
    rollup = person_rollup(orders_until(orders, as_of), customers, payments, reviews)
    return person_averages(checkpointed(rollup.drop("payment_rows", "review_rows")))


def people_then_and_now(tables: ShopTables, as_of: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """:func:`people_table` of the orders up to ``as_of`` and of all orders, from one rollup that is stored once."""
    orders, customers, payments, reviews = tables.require("orders", "customers", "payments", "reviews")
    then = "_then"
    early = F.coalesce(F.col("order_purchase_timestamp") <= moment(as_of), F.lit(False))

    def columns(sums: list[str]) -> list[Column]:
        return [*_account_columns(sums), *_account_columns(sums, then, early), F.max(early).alias("known_then")]

    owned, sums = _owned_accounts(orders, customers, payments, reviews, columns)
    origins = {"origin": _origin(), f"origin{then}": F.when(F.col("known_then"), _origin(then))}
    names = [*ORDER_SUMS, *sums]
    wide = owned.withColumns(origins).groupBy(PERSON).agg(
        F.max("known_then").alias("known_then"),
        *[F.sum(f"{name}{suffix}").alias(f"{name}{suffix}") for suffix in ("", then) for name in names],
        *[F.max(f"last_order_date{suffix}").alias(f"last_order_date{suffix}") for suffix in ("", then)],
        *[F.min(f"origin{suffix}")["customer_state"].alias(f"customer_state{suffix}") for suffix in ("", then)],
    )
    stored = checkpointed(wide.drop(*[f"{name}{suffix}" for suffix in ("", then) for name in ("payment_rows", "review_rows")]))
    kept = [name for name in stored.columns if not name.endswith(then) and name != PERSON]
    earlier = stored.filter("known_then").select(PERSON, *[F.col(f"{name}{then}").alias(name) for name in kept])
    return person_averages(earlier), person_averages(stored.select(PERSON, *kept))


def labels_of(people: DataFrame, summary: StateSummary, threshold_days: int = DEFAULT_THRESHOLD_DAYS) -> DataFrame:
    """The people with recency and is_churn, without another pass over the orders."""
    return label_people(_named(people), moment(summary.newest_order), threshold_days)


def _finished(labelled: DataFrame, summary: StateSummary) -> DataFrame:
    return impute(labelled, summary).select(PERSON, *FEATURES[:-1], "is_churn", "recency", "has_review")


def features_of(people: DataFrame, summary: StateSummary, threshold_days: int = DEFAULT_THRESHOLD_DAYS) -> DataFrame:
    """The feature table of stored people."""
    return _finished(labels_of(people, summary, threshold_days), summary)


def build_features(
    tables: ShopTables,
    labels: DataFrame | None = None,
    threshold_days: int = DEFAULT_THRESHOLD_DAYS,
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """The feature table.

    Without ``labels`` they come from the same pass over the orders; labels made elsewhere are
    joined on the person, and people they leave out disappear before any mean is taken.
    """
    people = people_table(tables, as_of)
    if labels is None:
        return features_of(people, state_summary(people), threshold_days)
    labelled = people.join(labels.select(PERSON, "is_churn", "recency"), PERSON)
    return _finished(labelled, state_summary(labelled))
