"""Helpers that several corpus operators share: scratch tables, batches, ordering, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows up to which a table of a few longs may be broadcast (about 16 MB); larger ones are shuffled.
BROADCAST_ROWS = 1_000_000
#: Bytes of an Arrow batch, about; a longer row stands alone.
BATCH_BYTES = 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares; where none is set, a temporary one if Spark runs in one process, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def columns(df: DataFrame) -> list[Column]:
    """The columns of a table, whatever their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def free_name(df: DataFrame, wanted: str) -> str:
    """A name that no column of `df` has, in any letter case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def staged(df: DataFrame) -> DataFrame:
    """Writes a table in the shared folder and reads it again: short lineage, and nothing kept on one executor."""
    path = f"{shared_dir(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by BATCH_BYTES where the session has Spark's own bound, so that long texts don't gather in one."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) in (None, "67108864b"):
        spark.conf.set(key, str(BATCH_BYTES))


def small_or_shuffled(table: DataFrame, rows: int | None = None) -> DataFrame:
    """Hints a broadcast if the staged table has at most BROADCAST_ROWS rows; else Spark shuffles both sides."""
    return F.broadcast(table) if (table.count() if rows is None else rows) <= BROADCAST_ROWS else table


def mapped_rows(df: DataFrame, run) -> DataFrame:
    """`mapInArrow` with the columns that came, also where their names have dots, which it can't take."""
    names = [c if c.isidentifier() else free_name(df, f"_column{i}") for i, c in enumerate(df.columns)]
    plain = df.toDF(*names)
    return plain.mapInArrow(run, plain.schema).toDF(*df.columns)


def join_hot(left: DataFrame, right: DataFrame, key: str, rows: str, rows_of_left: int, how: str = "left") -> DataFrame:
    """Left or inner join with a staged table of unique keys that states how many `rows` of `left` each has.

    Keys with so many rows that no more than BROADCAST_ROWS such keys can exist (at least 1,000) are
    broadcast, so that no task gets all rows of one key; the others are shuffled.
    """
    if (n := right.count()) <= BROADCAST_ROWS:
        return left.join(small_or_shuffled(right, n), key, how)
    least = max(1000, rows_of_left // BROADCAST_ROWS)
    hot = F.broadcast(right.where(F.col(rows) > least))  # at most BROADCAST_ROWS, by the choice of `least`
    cold = left.join(hot.select(key), key, "left_anti").join(right.where(F.col(rows) <= least), key, how)
    return left.join(hot, key).unionByName(cold)


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that the texts of each have about `limit` bytes; one longer text stands alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [x or "" for x in batch.column(column).to_pylist()]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) over an array of uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def order_buckets(df: DataFrame, key: str, rows_each: int = 2000) -> tuple[DataFrame, Column, int]:
    """Cuts ascending values of `key` into ranges of about `rows_each` rows.

    Returns the input, a column with the number of the range (0 first; nulls in 0), and how many
    ranges there are. The cuts are literals, so that each evaluation agrees; there are at most 65,536,
    looked up in two steps of 256.
    """
    n = df.count()
    parts = max(1, min(1 << 16, n // rows_each))
    cuts: list = []
    if parts > 1:
        share = [i / parts for i in range(1, parts)]
        cuts = sorted(set(df.agg(F.percentile_approx(key, share, max(10_000, 4 * parts)).alias("c")).first()["c"] or []))
    if not cuts:
        return df, F.lit(0), 1

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(F.col(key) <= F.lit(cuts[mid]), search(low, mid)).otherwise(search(mid + 1, high))

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda c: c < F.col(key)))

    if len(cuts) <= 64:
        found = search(0, len(cuts))
    elif len(cuts) <= 256:  # one nested expression would be too large to compile
        found = below(F.array(*map(F.lit, cuts)))
    else:
        lots = [cuts[i : i + 256] for i in range(0, len(cuts), 256)]
        lot = F.least(below(F.array(*[F.lit(x[-1]) for x in lots])), F.lit(len(lots) - 1))
        found = F.get(F.transform(F.array(lot), lambda i: i * 256 + below(F.get(F.array(*[F.array(*map(F.lit, x)) for x in lots]), i))), F.lit(0))
    return df, F.when(F.col(key).isNull(), F.lit(0)).otherwise(found).cast("int"), len(cuts) + 1


def components(edges: DataFrame) -> DataFrame:
    """Smallest id reachable from each id: (id, component), for edges (a, b) of longs.

    Alternates large-star and small-star steps over staged tables until nothing changes. Of a hot id only
    the minimum is aggregated, and what joins it is dealt by `join_hot`.
    """
    spark = edges.sparkSession
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:  # each turn that changes something brings ids nearer to their smallest
        n = now.count()
        if not n:
            return spark.createDataFrame([], "id long, component long")
        both = now.union(now.select("b", "a"))
        low = staged(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count("*").alias("n")))
        large = join_hot(both, low, "a", "n", 2 * n, "inner").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(large.where("a <> b").union(low.where("m < a").select("a", F.col("m").alias("b"))).distinct())
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = staged(down.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")))
        small = join_hot(down, low, "a", "n", 2 * n, "inner").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        now = staged(small.where("a <> b").distinct())
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    named = now.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "id")
    roots = now.select(F.col("b").alias("id")).distinct().join(named.select("id"), "id", "left_anti")
    return named.union(roots.select("id", F.col("id").alias("component")))


def running_total(df: DataFrame, part: str, value: str) -> DataFrame:
    """Sums `value` over all earlier parts; one row for each part, of which there are 65,536 at most."""
    totals = df.groupBy(part).agg(F.sum(value).alias("total"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(part, F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"))
