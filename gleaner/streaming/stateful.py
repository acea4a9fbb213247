"""Streams of messages with bounded state: first copies within a watermark, and newest crawls of edited messages.

Both keep a few bytes for each key in the state store of the checkpoint, for as long as a delay in event
time (`crawled_at`) says, and go on from there after a restart. What comes later than the watermark is
dropped and counted (`Progress.late`); the message table itself, which any batch can be merged into, has
no such bound. Rows without channel, id or time of crawl have no place in either and fall away.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources.scans import page_messages, typed_messages
from .ingest import PAGES, small_batches
from .message_table import KEYS, MessageTable


def landed_messages(spark: SparkSession, landing: str, files_per_trigger: int) -> DataFrame:
    """The messages of the pages that land in a folder, as a stream."""
    pages = spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_per_trigger).parquet(landing)
    return typed_messages(page_messages(pages))


def keyed(messages: DataFrame) -> DataFrame:
    return messages.where(F.col("channel").isNotNull() & F.col("message_id").isNotNull() & F.col("crawled_at").isNotNull())


def first_copies(messages: DataFrame, delay: str) -> DataFrame:
    """The first copy of each message to arrive; a key is forgotten once the watermark is `delay` beyond its copy."""
    return keyed(messages).withWatermark("crawled_at", delay).dropDuplicatesWithinWatermark(KEYS)


def newest_crawls(messages: DataFrame, delay: str, keep: str) -> DataFrame:
    """Each message that is as new as its newest crawl so far, or newer, once a batch.

    The state of a key is the time of its newest crawl. A timer drops it once the watermark is `keep`
    beyond that time; as later batches drop anything older than that watermark, a forgotten key can't be
    overwritten by an older crawl, in whatever order crawls arrive.
    """
    columns = messages.columns
    rows = keyed(messages).withWatermark("crawled_at", delay)
    rows = rows.withColumn("_micros", F.unix_micros("crawled_at")).withColumn("_until", F.unix_millis(F.col("crawled_at") + F.expr(f"interval {keep}")))
    order = ["_micros", "position", "raw_source"]

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        best = None
        for batch in batches:
            both = batch if best is None else pd.concat([best, batch])
            best = both.sort_values(order, ascending=[False, True, True], kind="stable").iloc[:1]
        newest, until = int(best["_micros"].iloc[0]), int(best["_until"].iloc[0])
        if not state.exists or newest >= state.get[0]:
            state.update((newest,))
            state.setTimeoutTimestamp(max(until, state.getCurrentWatermarkMs() + 1))
            yield best[columns]
        else:
            state.setTimeoutTimestamp(max(state.get[0] // 1000 + until - newest // 1000, state.getCurrentWatermarkMs() + 1))

    return rows.groupBy(*KEYS).applyInPandasWithState(run, messages.schema, "newest long", "append", GroupStateTimeout.EventTimeTimeout)


def ingest_first_copies(spark: SparkSession, landing: str, target: str, checkpoint: str, delay: str, files_per_trigger: int = 100) -> None:
    """Writes the first copy of each message that has landed to the folder `target`, and ends."""
    rows = first_copies(landed_messages(spark, landing, files_per_trigger), delay)
    with small_batches(spark):
        rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def ingest_newest_crawls(spark: SparkSession, landing: str, table: str, checkpoint: str, delay: str, keep: str, files_per_trigger: int = 100) -> None:
    """Merges into a message table only what is news to it: new messages, and newer crawls of known ones."""
    target = MessageTable(spark, table)
    rows = newest_crawls(landed_messages(spark, landing, files_per_trigger), delay, keep)
    with small_batches(spark):
        rows.writeStream.foreachBatch(lambda batch, n: target.merge(batch, n)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
