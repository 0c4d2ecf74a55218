"""Score people again as soon as something becomes known about them.

Orders, customers, payments and reviews arrive as four streams, in any order and some rows more than once. Two streaming queries
keep what has to be remembered in Spark's state store, so that a micro-batch looks up the keys it brings and reads no history:

1. ``person_increments``: repeated rows are dropped by key. Orders wait under their account until its customer is known,
   payments and reviews under their order id until such an order is known; orders stay known for those that come late. What
   comes out adds up: one row of sums per order, payment or review, with the person it belongs to.
2. ``keep_scores``: the increments are summed per person. Each micro-batch gives the new totals of the people it touched; these
   are scored with the fitted parameters and published.

State lies in RocksDB with bounded memory, so an executor holds as much of it as its disk does (``STATE_STORE``).

``lateness`` bounds the state by the time rows were received: amounts wait that long for their order and increments for their
customer, an order is remembered that long, repeats are noticed that long. Without it everything is remembered and nothing is lost.
Orders, payments and reviews without an order id are left out, and so are accounts without a person.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from winback.functions import logistic, risk_tier
from winback.operators.features import (
    FEATURES,
    StateSummary,
    features_of,
    impute,
    merge_people,
    order_facts,
    people_table,
    person_averages,
    state_summary,
)
from winback.operators.labels import PERSON
from winback.operators.prepare import SCALED, RobustScale, repeat_buyers, split_and_scale
from winback.operators.reuse import checkpointed
from winback.session import ensure_checkpoint_dir
from winback.sources import ShopTables, load_warehouse
from winback.sources.snapshots import PublishedTable, make_folder
from winback.streaming.deliveries import EVERY_MINUTE

MERGE_EVERY = 50
#: the time a row was received; a stream without it counts its rows as received when they are read
RECEIVED = "received_at"
#: what a row of amounts is
ORDER, PAYMENT, REVIEW = 0, 1, 2
#: where the queries keep their state, unless the session names a provider; a store on the heap limits it to the executors' memory
PROVIDER, ROCKSDB = "spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.stateStore.rocksdb"
STATE_STORE = {
    PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{ROCKSDB}.changelogCheckpointing.enabled": "true",
    f"{ROCKSDB}.boundedMemoryUsage": "true",
    # per executor; Spark allows half of it
    f"{ROCKSDB}.maxMemoryUsageMB": "1000",
    # counting rows reads each key before it is written
    f"{ROCKSDB}.trackTotalNumberOfRows": "false",
    # a join keeps its tables in one store per partition, not in four
    "spark.sql.streaming.join.stateFormatVersion": "3",
}
#: more of it for a run that takes what is there and ends: its stores go with their tasks, else they hold the memory that the next run needs
ENDING = {"spark.sql.streaming.stateStore.unloadOnCommit": "true"}
#: for runs that bring much each: they store their state as files; a log of the changes would be repeated whole by the next run
BULK = {f"{ROCKSDB}.changelogCheckpointing.enabled": "false"}
#: how many partitions state has; by default one per core that the executors have at the first start, and no more than a shuffle has.
#: It stays as it was at the first start: name it where executors come later.
SHUFFLE_PARTITIONS, STATE_PARTITIONS, LEAST_STATE_PARTITIONS = "spark.sql.shuffle.partitions", "spark.winback.state.partitions", 8


@dataclass(frozen=True)
class ScoringModel:
    """What a batch run leaves behind for scoring: fill values, scaling, and the score itself."""

    summary: StateSummary
    scaler: RobustScale
    add_score: Callable[[DataFrame], DataFrame]

    def score(self, people: DataFrame) -> DataFrame:
        """Features, probability and tier of repeat buyers among merged person rows."""
        averages = person_averages(people.withColumn("customer_state", F.col("origin.customer_state")))
        ready = repeat_buyers(impute(averages, self.summary))
        scored = self.add_score(self.scaler.transform(ready))
        return scored.select(PERSON, *FEATURES, "churn_probability").withColumn(
            "risk_tier", risk_tier(F.col("churn_probability"))
        )


def linear_score(weights: Mapping[str, float], intercept: float, places: int = 6) -> Callable[[DataFrame], DataFrame]:
    """Score with the stored coefficients of a linear model."""

    def add(frame: DataFrame) -> DataFrame:
        return frame.withColumn("churn_probability", F.round(logistic(weights, intercept, SCALED), places))

    return add


# --- what becomes known, per person -----------------------------------------------------------


@dataclass(frozen=True)
class ShopStreams:
    """The four streams of a shop.

    ``payment_key`` and ``review_key`` name the column that, with the order id, tells a payment or review from a repeat
    of it; without one the source is trusted to send each row once.
    """

    customers: DataFrame
    orders: DataFrame
    payments: DataFrame
    reviews: DataFrame
    payment_key: str | None = None
    review_key: str | None = None


def _received(stream: DataFrame, lateness: str | None) -> DataFrame:
    """The stream with its time of receipt and, if state is bounded, the watermark on it."""
    if RECEIVED not in stream.columns:
        stream = stream.withColumn(RECEIVED, F.current_timestamp())
    timed = stream.withColumn(RECEIVED, F.col(RECEIVED).cast("timestamp"))
    return timed.withWatermark(RECEIVED, lateness) if lateness else timed


def _once(stream: DataFrame, keys: list[str], lateness: str | None) -> DataFrame:
    return stream.dropDuplicatesWithinWatermark(keys) if lateness else stream.dropDuplicates(keys)


def amounts(streams: ShopStreams, lateness: str | None = None) -> DataFrame:
    """Payments, reviews and the orders themselves as narrow rows of one form: order_id, received_at, kind, paid or score, instalments.

    All of them are told from repeats in one step, by order id, kind and key.
    """
    parts = (
        (PAYMENT, streams.payments, streams.payment_key, F.col("payment_value"), F.col("payment_installments")),
        (REVIEW, streams.reviews, streams.review_key, F.col("review_score"), F.lit(None)),
        (ORDER, streams.orders, "order_id", F.lit(None), F.lit(None)),
    )
    keyed, trusted, keys = [], [], []
    for kind, stream, key, amount, installments in parts:
        timed = _received(stream, lateness).filter(F.col("order_id").isNotNull())
        values = [F.lit(kind).alias("kind"), amount.cast("double").alias("amount"), installments.cast("double").alias("installments")]
        if key in (None, "order_id"):
            (keyed if key else trusted).append(timed.select("order_id", RECEIVED, *values))
        else:
            keys.append(f"key_{kind}")
            keyed.append(timed.select("order_id", RECEIVED, *values, F.col(key).alias(keys[-1])))
    rows = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), keyed)
    return reduce(DataFrame.unionByName, [_once(rows, ["order_id", "kind", *keys], lateness).drop(*keys), *trusted])


def _near(lateness: str | None, earliest: str, latest: str, both_ways: bool = False, spans: int = 1) -> Column:
    """``latest`` was received at most ``spans`` times ``lateness`` after ``earliest``; the condition that lets Spark forget rows."""
    if lateness is None:
        return F.lit(True)
    span = F.expr(f"INTERVAL {lateness}") * spans
    soon = F.col(latest) <= F.col(earliest) + span
    return soon & (F.col(earliest) <= F.col(latest) + span) if both_ways else soon


def person_increments(streams: ShopStreams, lateness: str | None = None) -> DataFrame:
    """A stream of rows that add up to the person sums of :func:`person_partials`, each given once all it needs is known.

    Orders meet their customer first, so that what waits for a customer are orders and not each payment and review of theirs. An
    order also comes as a row of its own among the amounts, so that orders with their customer are made once and not per use.
    """
    orders = _once(_received(streams.orders, lateness).filter(F.col("order_id").isNotNull()), ["order_id"], lateness)
    facts = order_facts(orders.withColumn("order_received", F.col(RECEIVED)), "order_received")
    known = _received(streams.customers, lateness).filter(F.col("customer_id").isNotNull() & F.col(PERSON).isNotNull())
    owners = _once(known, ["customer_id"], lateness).select(
        F.col("customer_id").alias("account"), PERSON, "customer_state", F.col(RECEIVED).alias("customer_received")
    )
    # an amount may come one span after its order and wait one more for the customer
    owned = facts.join(
        owners, (F.col("customer_id") == F.col("account")) & _near(lateness, "order_received", "customer_received", spans=2)
    )
    # orders go on with one time that the watermark is about, their own
    owned = owned.withColumn("customer_received", F.timestamp_micros(F.unix_micros("customer_received")))
    late = amounts(streams, lateness).withColumnRenamed("order_id", "of_order").join(
        owned.drop("account"),
        (F.col("of_order") == F.col("order_id"))
        & _near(lateness, "order_received", RECEIVED, both_ways=True)
        & _near(lateness, RECEIVED, "customer_received"),
    )
    is_order, is_payment, is_review = (F.col("kind") == kind for kind in (ORDER, PAYMENT, REVIEW))
    order_date, days = F.when(is_order, F.col("order_purchase_timestamp")), F.when(is_order, F.col("delivery_days")).cast("bigint")
    paid, score = F.when(is_payment, F.col("amount")), F.when(is_review, F.col("amount"))
    origin = F.struct(order_date.isNull().alias("undated"), order_date.alias("first_order_date"), "customer_id", "customer_state")
    return late.select(
        PERSON,
        is_order.cast("bigint").alias("frequency"),
        days.alias("delivery_sum"),
        days.isNotNull().cast("bigint").alias("delivery_rows"),
        is_payment.cast("bigint").alias("payment_rows"),
        paid.alias("paid"),
        F.col("installments").alias("installment_sum"),
        F.col("installments").isNotNull().cast("bigint").alias("installment_rows"),
        is_review.cast("bigint").alias("review_rows"),
        score.alias("score_sum"),
        score.isNotNull().cast("bigint").alias("score_rows"),
        order_date.alias("last_order_date"),
        F.when(is_order & F.col("customer_state").isNotNull(), origin).alias("origin"),
    )


# --- the two queries --------------------------------------------------------------------------


def state_partitions(spark: SparkSession) -> int:
    """Each partition of each store is opened and written in every micro-batch, so there are no more than can be worked on at once."""
    named = spark.conf.get(STATE_PARTITIONS, None)
    if named:
        return int(named)
    return min(int(spark.conf.get(SHUFFLE_PARTITIONS)), max(spark.sparkContext.defaultParallelism, LEAST_STATE_PARTITIONS))


def _started(spark: SparkSession, writer: DataStreamWriter, bulk: bool, trigger: Mapping[str, object]) -> StreamingQuery:
    """Start the query with STATE_STORE; a query keeps the settings it was started with."""
    own = {}
    if not spark.conf.get(PROVIDER, None):
        ending = trigger.get("availableNow") or trigger.get("once")
        store = {**STATE_STORE, **(ENDING if ending else {}), **(BULK if bulk else {})}
        own = {key: value for key, value in store.items() if spark.conf.get(key, None) is None}
    own[SHUFFLE_PARTITIONS] = str(state_partitions(spark))
    before = {key: spark.conf.get(key, None) for key in own}
    for key, value in own.items():
        spark.conf.set(key, value)
    try:
        return writer.trigger(**trigger).start()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def keep_increments(increments: DataFrame, store: str, bulk: bool = False, **trigger) -> StreamingQuery:
    """Append a stream of :func:`person_increments` to ``store``; the file sink commits each micro-batch once."""
    writer = increments.writeStream.outputMode("append").format("parquet").option("path", f"{store}/increments")
    writer = writer.option("checkpointLocation", f"{store}/increments-progress")
    return _started(increments.sparkSession, writer, bulk, trigger or EVERY_MINUTE)


def keep_scores(
    spark: SparkSession,
    schema: StructType,
    model: ScoringModel,
    store: str,
    merge_every: int = MERGE_EVERY,
    grace_seconds: float = 24 * 3600.0,
    bulk: bool = False,
    **trigger,
) -> StreamingQuery:
    """Sum the stored increments per person and publish the scores of the people each micro-batch touches."""
    make_folder(spark, f"{store}/increments")
    increments = spark.readStream.schema(schema).parquet(f"{store}/increments")
    scores = PublishedTable(spark, f"{store}/scores", grace_seconds)

    def publish(batch: DataFrame, batch_id: int) -> None:
        scored = model.score(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        scores.append(scored, batch_id, newest_scores, merge_every)

    writer = merge_people(increments).writeStream.outputMode("update").foreachBatch(publish)
    return _started(spark, writer.option("checkpointLocation", f"{store}/scores-progress"), bulk, trigger or EVERY_MINUTE)


def score_shop(
    streams: ShopStreams,
    model: ScoringModel,
    store: str,
    lateness: str | None = "60 days",
    merge_every: int = MERGE_EVERY,
    bulk: bool = False,
    **trigger,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Start both queries on ``store``: the one that keeps increments and the one that scores.

    With ``availableNow`` the first is awaited before the second starts, so that all rows at hand are scored. ``bulk`` is for
    runs that bring much each and are started anew for it.
    """
    increments = person_increments(streams, lateness)
    first = keep_increments(increments, store, bulk, **trigger)
    if trigger.get("availableNow"):
        first.awaitTermination()
    return first, keep_scores(streams.orders.sparkSession, increments.schema, model, store, merge_every, bulk=bulk, **trigger)


def newest_scores(scores: DataFrame) -> DataFrame:
    """Of each person the score of the newest micro-batch."""
    kept = [name for name in scores.columns if name != PERSON]
    newest = F.max_by(F.struct(*kept), "batch_id").alias("newest")
    return scores.groupBy(PERSON).agg(newest).select(PERSON, *[F.col(f"newest.{name}") for name in kept])


def latest_scores(spark: SparkSession, store: str) -> DataFrame:
    """The newest score of every person, as published."""
    return newest_scores(PublishedTable(spark, f"{store}/scores").read()).drop("batch_id")


# --- a replay ---------------------------------------------------------------------------------


def arrivals(tables: ShopTables, batches: int) -> list[dict[str, DataFrame]]:
    """What arrives in each of ``batches`` turns, and in one more turn of repeats.

    Orders are dealt to turns by their id, payments and reviews regardless of it, so that a third or so come before their
    order and as many after it; every other customer is known only in the last turn.
    """
    order, last = F.col("order_id").cast("bigint"), batches - 1
    turns = {
        "customers": F.when(F.col("customer_id").cast("bigint") % 2 == 0, 0).otherwise(last),
        "orders": F.pmod(order, F.lit(batches)),
        "payments": F.pmod(order + F.col("payment_sequential"), F.lit(batches)),
        "reviews": F.pmod(order * 2 + 1, F.lit(batches)),
    }
    rows = [{name: getattr(tables, name).filter(turn == at) for name, turn in turns.items()} for at in range(batches)]
    again = {name: getattr(tables, name).filter(F.xxhash64(*getattr(tables, name).columns) % 3 == 0) for name in turns}
    return [*rows, again]


def replay_scoring(
    spark: SparkSession, folder: str, weights: Mapping[str, float], intercept: float, batches: int = 3
) -> DataFrame:
    """Fit on the stored tables, stream them in turns with late and repeated rows, return the newest scores.

    The queries stop after each turn and go on from their checkpoints.
    """
    tables = load_warehouse(spark, folder)
    work = f"{ensure_checkpoint_dir(spark)}/scoring-{uuid.uuid4().hex}"
    # payments without a number of their own get one, so that repeats can be told from equal payments
    numbered = W.partitionBy("order_id").orderBy("payment_installments", "payment_value")
    payments = tables.payments.withColumn("payment_sequential", F.row_number().over(numbered))
    with ThreadPoolExecutor() as side:
        stored = side.submit(payments.write.parquet, f"{work}/payments")
        people = people_table(tables)
        summary = state_summary(people)
        ready = split_and_scale(checkpointed(features_of(people, summary)))
        stored.result()
    model = ScoringModel(summary, ready.scaler, linear_score(weights, intercept))
    tables = replace(tables, payments=spark.read.parquet(f"{work}/payments"))
    running = ()
    for turn in arrivals(tables, batches):
        # the rows of a turn arrive while those of the one before are still being scored
        with ThreadPoolExecutor() as side:
            list(side.map(lambda name: turn[name].write.mode("append").parquet(f"{work}/incoming/{name}"), turn))  # noqa: B023
        for query in running:
            query.awaitTermination()
        incoming = {name: spark.readStream.schema(rows.schema).parquet(f"{work}/incoming/{name}") for name, rows in turn.items()}
        streams = ShopStreams(**incoming, payment_key="payment_sequential", review_key="review_score")
        running = score_shop(streams, model, f"{work}/store", lateness=None, merge_every=batches, bulk=True, availableNow=True)
    for query in running:
        query.awaitTermination()
    return latest_scores(spark, f"{work}/store").select(PERSON, "frequency", "churn_probability", "risk_tier")
