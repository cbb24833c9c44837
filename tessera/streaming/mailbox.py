"""Streams: windowed counts with late data, retries and expiry as state, priority mailboxes."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
RETRY_SCHEMA = "user_id bigint, event_id bigint, attempts bigint, fate string"


def message_stream(spark: SparkSession, path: str, schema: str = MESSAGE_SCHEMA, files_per_batch: int = 1) -> DataFrame:
    """Message files as a stream, a few at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def windowed_counts(messages: DataFrame, window: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Messages per window and type; rows later than ``delay`` are dropped with the state they belong to."""
    return (
        messages.withWatermark("ts", delay)
        .groupBy(F.window("ts", window).alias("w"), "event_type")
        .agg(F.count("*").alias("n"), F.sum("value").alias("total"))
        .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "event_type", "n", "total")
    )


def first_deliveries(messages: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Messages without repeated deliveries of one id within the delay."""
    return messages.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])


def retries(messages: DataFrame, most: int = 3) -> DataFrame:
    """Each failed message with its number of attempts by receiver: ``retry`` below ``most``, else ``dead``.

    The counts are kept as state per receiver over all batches: a map from
    message to attempts, of which dead ones are dropped.
    """

    def run(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        ids, counts = state.get if state.exists else ([], [])
        known = dict(zip(ids, counts))
        rows = []
        for pdf in batches:
            for event in pdf.sort_values(["ts", "event_id"])["event_id"]:
                n = known[event] = known.get(event, 0) + 1
                rows.append((key[0], event, n, "retry" if n < most else "dead"))
                if n >= most:
                    del known[event]
        state.update((list(known), list(known.values())))
        yield pd.DataFrame(rows, columns=["user_id", "event_id", "attempts", "fate"])

    return messages.groupBy("user_id").applyInPandasWithState(run, RETRY_SCHEMA, "ids array<bigint>, counts array<bigint>", "append", "NoTimeout")


def deliver(batch: DataFrame, priority: dict[str, int], other: int = 10) -> DataFrame:
    """A batch in the order of delivery for each receiver: (user_id, place, event_id). Order holds within one batch only."""
    from pyspark.sql import Window

    rank = F.lit(other)
    for k, v in priority.items():
        rank = F.when(F.col("event_type") == k, v).otherwise(rank)
    place = F.row_number().over(Window.partitionBy("user_id").orderBy(rank, "ts", "event_id"))
    return batch.select("user_id", place.alias("place"), "event_id")


def start_mailbox(messages: DataFrame, path: str, checkpoint: str, priority: dict[str, int]):
    """Write each batch in delivery order to ``path``; a batch that is run again replaces itself."""

    def sink(batch: DataFrame, epoch: int) -> None:
        deliver(batch, priority).write.mode("overwrite").parquet(f"{path}/batch={epoch}")

    return messages.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).start()
