"""Incremental ingest of landed pages into a keyed message table, safe to replay."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.keyed import require_empty
from ..sources.scans import page_messages, typed_messages
from .message_table import KEYS, MessageTable

PAGES = "page_url string, channel string, html string, crawled_at timestamp"


class Progress(StreamingQueryListener):
    """Keeps the last numbers of each query: batches ended, rows read, late and repeated rows that its state has dropped, rows of state, and the names of those that have ended."""

    def __init__(self) -> None:
        self.batches: dict[str, int] = {}
        self.rows: dict[str, int] = {}
        self.late: dict[str, int] = {}
        self.repeated: dict[str, int] = {}
        self.state: dict[str, int] = {}
        self.ended: dict[str, str | None] = {}

    def onQueryStarted(self, event) -> None:
        for numbers in (self.batches, self.rows, self.late, self.repeated, self.state):
            numbers[str(event.runId)] = 0

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        self.batches[run] = max(self.batches.get(run, 0), event.progress.batchId + 1)
        self.rows[run] = self.rows.get(run, 0) + event.progress.numInputRows
        operators = event.progress.stateOperators
        self.late[run] = self.late.get(run, 0) + sum(x.numRowsDroppedByWatermark for x in operators)
        self.repeated[run] = self.repeated.get(run, 0) + sum(x.customMetrics.get("numDroppedDuplicateRows", 0) for x in operators)
        self.state[run] = sum(x.numRowsTotal for x in operators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)] = event.exception


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Bounds Arrow batches of the streams that start inside by 200 rows and 4 MB, as rows hold whole pages; bounds that the session has of its own stay."""
    bounds = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "200"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", str(4 << 20))}
    changed = {k: spark.conf.get(k) for k, (usual, _) in bounds.items() if spark.conf.get(k) == usual}
    try:
        for k in changed:
            spark.conf.set(k, bounds[k][1])
        yield
    finally:
        for k, usual in changed.items():
            spark.conf.set(k, usual)


def batch_counters(batch: DataFrame, known: DataFrame | None) -> DataFrame:
    """messages, links, duplicates and known of one batch, in one row."""
    flags = batch.select(*KEYS, F.size("repository_links").alias("n"))
    if known is not None:
        flags = flags.join(known.select(*KEYS, F.lit(1).alias("k")), KEYS, "left")
    else:
        flags = flags.withColumn("k", F.lit(None).cast("int"))
    each = flags.groupBy(*KEYS).agg(F.count("*").alias("copies"), F.max("n").alias("n"), F.max("k").alias("k"))
    return each.agg(F.count("*").alias("messages"), F.coalesce(F.sum("n"), F.lit(0)).alias("links"), F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"), F.count("k").alias("known"))


def ingest(spark: SparkSession, landing: str, table: str, checkpoint: str, counters: list | None = None, files_per_trigger: int = 100, keep_versions: int = 10) -> None:
    """Reads all pages that have landed, batch by batch, merges them, and ends; counters of each batch are added to the list."""
    target = MessageTable(spark, table)

    def one(batch: DataFrame, batch_id: int) -> None:
        found = target.merge(typed_messages(page_messages(batch)), batch_id)
        if counters is not None and found is not None:
            counters.append(found | {"batch": batch_id})
        target.remove_old(keep_versions)

    source = spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_per_trigger).parquet(landing)
    with small_batches(spark):
        source.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def reparsed(messages: DataFrame, strict: bool = True) -> DataFrame:
    """Messages with links read again from their raw source; fails the job if one isn't found there again, or, if not `strict`, marks it."""
    pages = messages.select(F.concat(F.lit("https://t.me/s/"), "channel").alias("page_url"), "channel", F.col("raw_source").alias("html"), F.col("message_id").alias("wanted"))
    again = typed_messages(page_messages(pages)).select("channel", "message_id", F.col("external_links").alias("new_external"), F.col("repository_links").alias("new_repository"))
    again = again.dropDuplicates(KEYS).withColumn("found", F.lit(True))
    if strict:
        require_empty(messages.select(*KEYS).join(again, KEYS, "left_anti"), "messages not found again in their source")
    joined = messages.join(again, KEYS, "left").withColumn("external_links", F.coalesce("new_external", "external_links")).withColumn("repository_links", F.coalesce("new_repository", "repository_links"))
    return joined.withColumn("found", F.coalesce("found", F.lit(False))).drop("new_external", "new_repository")
