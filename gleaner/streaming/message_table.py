"""A keyed table of messages as a log: buckets by ranges of ids, a part for each batch, merged when read.

A bucket is a channel and the message ids that share their upper bits; one that is found to hold more
than `rows_each` rows is split at lower bits, so that buckets follow the ids that there are. A batch writes its own rows
alone, as one more part of each bucket that it touches, and reads no more of the table than the keys of
these buckets, for its counters. Readers take of each key the newest crawl, and of equal ones the later batch. A
bucket of more than `most_parts` parts, or of twice `rows_each` rows with those that they replace, is
written anew as one when a batch touches it, so that the rows written over time stay in proportion to
those that came.

A manifest of all buckets, written last, makes a batch visible wholly or not at all. A batch that was
killed before has no manifest: it is written again from the manifest before it. A batch that has one is
done, and nothing happens if it comes again. One writer at a time is assumed, as a stream has.

Rows without channel or id have no key and fall away. Of equal keys in a batch the newest crawl is kept,
there the first on the page; rows without a time of crawl are older than any. An empty batch makes a
version with the rows of the one before.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.keyed import latest_per_key
from ..operators.similarity import small_or_shuffled
from ..sources import files

KEYS = ["channel", "message_id"]
MANIFEST = "channel string, level int, prefix long, bucket string, n_rows long, parts array<string>"
COUNTERS = ["messages", "links", "duplicates", "known"]
#: The bits of an id below which a channel's first buckets tell nothing apart: one for ids from 0 upwards, one for those below.
ROOT = 63


def first_in_batch(messages: DataFrame) -> DataFrame:
    """One row a message: the newest crawl's, and there the first on the page."""
    return latest_per_key(messages, KEYS, [F.desc("crawled_at"), F.asc("position"), F.asc("raw_source")])


def bucket_name() -> Column:
    return F.concat_ws("-", F.md5("channel"), F.col("level").cast("string"), F.col("prefix").cast("string"))


def named(rows: DataFrame) -> DataFrame:
    """Rows with a `level`, and the prefix and name of their bucket."""
    return rows.withColumn("prefix", F.expr("shiftright(message_id, level)")).withColumn("bucket", bucket_name())


def split_level(level: int, rows: int, low: int, high: int, rows_each: int) -> int:
    """The level of buckets that would hold half of `rows_each` rows to all of them, if ids were even from `low` to `high`."""
    width = (high - low + 1) * rows_each / rows
    return max(0, min(level - 1, math.floor(math.log2(width)) if width >= 1 else 0))


class MessageTable:
    """The table at `path`; see above."""

    def __init__(self, spark: SparkSession, path: str, rows_each: int = 1_000_000, most_parts: int = 8):
        self.spark, self.path, self.rows_each, self.most_parts = spark, path.rstrip("/"), rows_each, most_parts

    def versions(self) -> list[int]:
        """Batches that are wholly written, in order; removed ones aren't among them."""
        found = sorted(int(n) for n in files.names(self.spark, f"{self.path}/manifests") if n.isdigit())
        return [v for v in found if files.exists(self.spark, f"{self.path}/manifests/{v}/_SUCCESS")]

    def version(self, below: int | None = None) -> int | None:
        return max((v for v in self.versions() if below is None or v < below), default=None)

    def buckets(self, version: int | None) -> DataFrame:
        """The manifest of a version: a row for each bucket, its parts, and how many rows they have at most."""
        if version is None:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).json(f"{self.path}/manifests/{version}")

    def _files(self, rows: list) -> list[str]:
        return [f"{self.path}/{part}/bucket={r['bucket']}" for r in rows for part in r["parts"]]

    def _merged(self, rows: list) -> DataFrame:
        """The rows of buckets, as stored: those of one part as they are, of others the newest of each key."""
        single, several = (self._files([r for r in rows if (len(r["parts"]) > 1) is many]) for many in (False, True))
        found = [self.spark.read.parquet(*single)] if single else []
        if several:
            found.append(latest_per_key(self.spark.read.parquet(*several), KEYS, [F.desc("crawled_at"), F.desc("_batch")]))
        return found[0] if len(found) == 1 else found[0].unionByName(found[1])

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version, the newest if none is named; None if there are none."""
        at = self.version() if version is None else version
        rows = self.buckets(at).where(F.size("parts") > 0).select("bucket", "parts").collect()  # a row for about `rows_each` messages
        return self._merged(rows).drop("_batch", "level", "prefix") if rows else None

    def routed(self, rows: DataFrame, buckets: DataFrame) -> DataFrame:
        """Rows with the bucket of their key: the narrowest of those that hold it, or the channel's first."""
        found = F.lit(ROOT)
        names = []
        for level in sorted((r["level"] for r in buckets.select("level").distinct().collect()), reverse=True):  # 64 at most, few in practice
            name = f"_at{level}"
            there = small_or_shuffled(buckets.where(F.col("level") == level).select("channel", F.col("prefix").alias("_prefix"), F.lit(level).alias(name)))
            rows = rows.withColumn("_prefix", F.shiftright("message_id", level)).join(there, ["channel", "_prefix"], "left").drop("_prefix")
            found = F.coalesce(F.col(name), found)
            names.append(name)
        return named(rows.withColumn("level", found).drop(*names))

    def merge(self, batch: DataFrame, batch_id: int) -> dict[str, int] | None:
        """Adds a batch and returns its counters; None if the table has it already.

        Counters are those of the rows as they are written: messages, their links, further copies of
        them in the batch, and how many the table knew before.
        """
        if files.exists(self.spark, f"{self.path}/manifests/{batch_id}/_SUCCESS"):
            return None
        before = self.buckets(self.version(below=batch_id))
        same = Window.partitionBy(*KEYS)
        links = F.size("repository_links") if "repository_links" in batch.columns else F.lit(0)
        rows = batch.where(F.col("channel").isNotNull() & F.col("message_id").isNotNull())
        rows = first_in_batch(rows.withColumn("_copies", F.count("*").over(same)).withColumn("_links", F.max(links).over(same)))
        incoming = f"{self.path}/incoming/{batch_id}"
        self.routed(rows, before).write.mode("overwrite").parquet(incoming)
        rows = self.spark.read.parquet(incoming)
        touched = rows.groupBy("channel", "level", "prefix", "bucket").agg(F.count("*").alias("n"))
        touched = touched.join(before.select("bucket", "n_rows", "parts"), "bucket", "left").collect()  # buckets of one batch
        counters = self._add(rows, [r for r in touched if r["parts"]], batch_id) if touched else dict.fromkeys(COUNTERS, 0)
        now = [(r["channel"], r["level"], r["prefix"], r["bucket"], r["n"] + (r["n_rows"] or 0), [*(r["parts"] or []), f"data/{batch_id}"]) for r in touched]
        due = [r for r in now if len(r[5]) > self.most_parts or r[4] > 2 * self.rows_each]
        if due:
            due_names = {r[3] for r in due}
            now = [r for r in now if r[3] not in due_names] + self._written_anew(due, batch_id)
        changed = self.spark.createDataFrame(now, MANIFEST)
        manifest = before.join(changed.select("bucket"), "bucket", "left_anti").select(changed.columns).unionByName(changed)
        manifest.repartition(1 + len(now) // 100_000).write.mode("overwrite").json(f"{self.path}/manifests/{batch_id}")
        files.remove(self.spark, incoming)
        return counters

    def _add(self, rows: DataFrame, held: list, batch_id: int) -> dict[str, int]:
        """Writes the rows of a batch as a part of their buckets, and counts them on the way."""
        if held:
            known = self.spark.read.parquet(*self._files(held)).select(*KEYS).distinct().withColumn("_known", F.lit(1))
            rows = rows.join(known, KEYS, "left")
        else:
            rows = rows.withColumn("_known", F.lit(None).cast("int"))
        seen = Observation()
        counts = [F.count(F.lit(1)).alias("messages"), F.sum("_links").alias("links"), F.sum(F.col("_copies") - 1).alias("duplicates"), F.count("_known").alias("known")]
        # Counted behind the sort, as the ranges of the sort are found by reading the rows once more.
        counted = self._in_order(rows.withColumn("_batch", F.lit(batch_id).cast("long"))).observe(seen, *counts)
        self._write(counted.drop("_known", "_copies", "_links"), f"data/{batch_id}")
        return {k: int(seen.get[k] or 0) for k in COUNTERS}

    def _in_order(self, rows: DataFrame) -> DataFrame:
        """Rows by bucket and id; a bucket of many rows is several tasks' work."""
        return rows.repartitionByRange("bucket", "message_id").sortWithinPartitions("bucket", "message_id")

    def _write(self, rows: DataFrame, part: str) -> None:
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{part}")

    def _written_anew(self, due: list[tuple], batch_id: int) -> list[tuple]:
        """Merges the parts of buckets into one each, splits those that are too large, and returns the rows of the manifest."""
        rows = [dict(zip(("channel", "level", "prefix", "bucket", "n_rows", "parts"), r, strict=True)) for r in due]
        merged = self._merged(rows)
        sizes = named(merged).groupBy("bucket").agg(F.count("*").alias("n"), F.min("message_id").alias("low"), F.max("message_id").alias("high")).collect()
        level = {r["bucket"]: r["level"] for r in rows}
        to = [(r["bucket"], split_level(level[r["bucket"]], r["n"], r["low"], r["high"], self.rows_each) if r["n"] > self.rows_each and level[r["bucket"]] else level[r["bucket"]]) for r in sizes]
        target = self.spark.createDataFrame(to, "bucket string, _level int")  # buckets of one batch
        moved = named(named(merged).join(F.broadcast(target), "bucket").withColumn("level", F.col("_level")).drop("_level"))
        self._write(self._in_order(moved), f"merged/{batch_id}")
        written = self.spark.read.parquet(f"{self.path}/merged/{batch_id}").groupBy("channel", "level", "prefix", "bucket").agg(F.count("*").alias("n")).collect()
        found = [(r["channel"], r["level"], r["prefix"], r["bucket"], r["n"], [f"merged/{batch_id}"]) for r in written]
        names = {r[3] for r in found}
        return found + [(r["channel"], r["level"], r["prefix"], r["bucket"], 0, []) for r in rows if r["bucket"] not in names]  # split ones take ids that no narrower one holds

    def remove_old(self, keep: int = 2) -> None:
        """Removes manifests but for the last `keep`, and the parts that only they name."""
        versions = self.versions()
        last, old = versions[-keep:], versions[:-keep]
        used: set[str] = set()
        for v in last:
            used |= set(self._files(self.buckets(v).where(F.size("parts") > 0).select("bucket", "parts").collect()))
        for v in old:
            files.remove(self.spark, f"{self.path}/manifests/{v}")
        for kind in ("data", "merged"):
            for v in files.names(self.spark, f"{self.path}/{kind}"):
                folder = f"{self.path}/{kind}/{v}"
                if last and v.isdigit() and int(v) <= last[-1]:
                    held = [f"{folder}/{b}" for b in files.names(self.spark, folder) if b.startswith("bucket=")]
                    for path in held if any(p in used for p in held) else [folder]:
                        if path not in used:
                            files.remove(self.spark, path)
