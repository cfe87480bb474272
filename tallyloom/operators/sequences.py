"""Purchase sequences: one state per order, the orders that follow, transition and three-step counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import stored

STATE_ITEMS = 3


def order_sequences(df: DataFrame, customer: str, order_key: str, date: str, level: str) -> DataFrame:
    """One state per (customer, order, date): its first three distinct items in order, joined by ' + '.

    An order's distinct items are shuffled once; its first three are then chosen by a window that keeps three rows.
    """
    keys = ["customer_name", "order_id", "order_date"]
    items = (
        df.select(
            F.col(customer).alias(keys[0]), F.col(order_key).alias(keys[1]), F.col(date).alias(keys[2]), F.col(level).alias("item")
        )
        .na.drop()
        .distinct()
    )
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("item"))
    return (
        items.withColumn("_place", place)
        .where(F.col("_place") <= STATE_ITEMS)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list("item")).alias("_items"))  # at most three
        .select(*keys, F.concat_ws(" + ", "_items").alias("state"))
    )


def next_step(sequences: DataFrame) -> DataFrame:
    """Each order with the customer's next two states (NULL at the end).

    Orders are dealt out in ranges of (customer, date, order), so a customer with most of the orders, even on one day,
    is split.  Successors are found inside a range; the last two orders of a customer in a range find theirs among the
    first and last two of each range.
    """
    ranged = sequences.repartitionByRange("customer_name", "order_date", "order_id")
    ranged = stored(ranged.withColumn("_range", F.spark_partition_id()), "order_ranges")
    own = Window.partitionBy("customer_name", "_range").orderBy("order_date", "order_id")
    placed = ranged.select(
        "*",
        F.row_number().over(own).alias("_at"),
        F.count("*").over(Window.partitionBy("customer_name", "_range")).alias("_n"),
        F.lead("state", 1).over(own).alias("step_2"),
        F.lead("state", 2).over(own).alias("step_3"),
    )
    is_tail = F.col("_at") > F.col("_n") - 2
    columns = ["customer_name", "order_date", "order_id", F.col("state").alias("step_1"), "step_2", "step_3"]
    inner = placed.where(~is_tail).select(*columns)
    along = Window.partitionBy("customer_name").orderBy("order_date", "order_id")  # four orders a range at most
    edges = placed.where(is_tail | (F.col("_at") <= 2)).select(
        "customer_name",
        "order_date",
        "order_id",
        "state",
        is_tail.alias("_tail"),
        F.lead("state", 1).over(along).alias("step_2"),
        F.lead("state", 2).over(along).alias("step_3"),
    )
    return inner.unionByName(edges.where("_tail").select(*columns))


def transitions(steps: DataFrame) -> DataFrame:
    """From-to counts and the probability of the next state given the current one."""
    pairs = (
        steps.where(F.col("step_2").isNotNull())
        .groupBy(F.col("step_1").alias("from"), F.col("step_2").alias("to"))
        .agg(F.count("*").alias("times_seen"))
    )
    return transition_probability(pairs, "from", "times_seen")


def transition_probability(pairs: DataFrame, state: str, count: str) -> DataFrame:
    """Each count over the total of its state, over all pairs (before any top-n cut)."""
    totals = pairs.groupBy(state).agg(F.sum(count).alias("_total"))
    return pairs.join(totals, state).select(
        *pairs.columns, (F.col(count) / F.col("_total")).alias("probability_next")
    )


def three_step_patterns(steps: DataFrame) -> DataFrame:
    """Counts of three consecutive states."""
    return (
        steps.where(F.col("step_3").isNotNull())
        .groupBy("step_1", "step_2", "step_3")
        .agg(F.count("*").alias("times_seen"))
    )
