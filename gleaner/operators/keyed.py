"""Keyed tables: latest rows, upserts, merges, prunes and versioned writes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .similarity import staged


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key, the first in `order`, which should end in something unique."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= n)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], rules: dict[str, str] | None = None) -> DataFrame:
    """Rows of `new` replace those of `old` by key; rules say otherwise for a column: keep, min, max or add.

    Both sides have one row a key and the same columns. A null in `new` replaces under the default rule.
    """
    rules = rules or {}
    only_old, only_new = F.col("b._new").isNull(), F.col("a._old").isNull()
    joined = old.withColumn("_old", F.lit(1)).alias("a").join(new.withColumn("_new", F.lit(1)).alias("b"), keys, "full_outer")

    def value(c: str) -> Column:
        x, y = F.col(f"a.{c}"), F.col(f"b.{c}")
        both = {"keep": F.coalesce(x, y), "min": F.least(x, y), "max": F.greatest(x, y), "add": F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0))}.get(rules.get(c, ""), y)
        return F.when(only_old, x).when(only_new, y).otherwise(both).alias(c)

    return joined.select(*keys, *[value(c) for c in old.columns if c not in keys])


def later_wins(first: DataFrame, *others: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of all tables, of each key those of the last table that has it; scores don't matter."""
    every = reduce(lambda x, y: x.unionByName(y), [t.withColumn("_from", F.lit(i)) for i, t in enumerate([first, *others])])
    return latest_per_key(every, keys, [F.desc("_from")]).drop("_from")


def ordered_union(parts: list[DataFrame], key: str, rank: str) -> DataFrame:
    """Different keys of all parts, each with the section and rank of its first place."""
    every = reduce(lambda x, y: x.unionByName(y), [p.select(key, F.struct(F.lit(i).alias("section"), F.col(rank).alias("rank")).alias("place")) for i, p in enumerate(parts)])
    return every.groupBy(key).agg(F.min("place").alias("place")).select(key, "place.section", "place.rank")


def pruned(df: DataFrame, keep: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(keep.select(*keys).distinct(), keys, "left_semi")


def stale(df: DataFrame, keep: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(keep.select(*keys).distinct(), keys, "left_anti")


def flagged(df: DataFrame, chosen: DataFrame, key: str, flag: str) -> DataFrame:
    """All rows, with whether their key was chosen."""
    marks = chosen.select(key).distinct().withColumn(flag, F.lit(True))
    return df.drop(flag).join(marks, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def changed(old: DataFrame, new: DataFrame, keys: list[str], print_: str = "fingerprint") -> DataFrame:
    """New rows with `state`: NEW, CHANGED or SAME, by the stored fingerprint."""
    stored = old.select(*keys, F.col(print_).alias("_stored"), F.lit(True).alias("_known"))
    state = F.when(F.col("_known").isNull(), "NEW").when(~F.equal_null(F.col("_stored"), F.col(print_)), "CHANGED").otherwise("SAME")
    return new.join(stored, keys, "left").withColumn("state", state).drop("_stored", "_known")


def reset_changed(stored: DataFrame, new: DataFrame, keys: list[str], print_: str = "fingerprint") -> DataFrame:
    """New rows with the stored status and error; a changed fingerprint sets the status to PENDING and clears the error; null for rows not stored."""
    held = stored.select(*keys, F.col(print_).alias("_stored"), F.col("status").alias("_status"), F.col("error").alias("_error"), F.lit(True).alias("_known"))
    rows = new.join(held, keys, "left")
    other = F.col("_known") & ~F.equal_null(F.col("_stored"), F.col(print_))
    rows = rows.withColumn("status", F.when(other, "PENDING").otherwise(F.col("_status"))).withColumn("error", F.when(~other, F.col("_error")))
    return rows.drop("_stored", "_status", "_error", "_known")


def numbered(df: DataFrame, *keys: str, name: str = "number") -> DataFrame:
    """Numbers rows from 0 in ascending order of keys: sorted in ranges, which are counted, so that no task gets all rows."""
    rows = staged(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()))
    parts = rows.groupBy("_part").agg(F.count("*").alias("n"), F.min("_at").alias("_first"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a range
    parts = parts.select("_part", "_first", before.alias("_before"))
    return rows.join(F.broadcast(parts), "_part").withColumn(name, F.col("_before") + F.col("_at") - F.col("_first")).drop("_part", "_at", "_first", "_before")


def write_report(sections: DataFrame, path: str) -> None:
    """Sections of a report as lines of JSON, nulls kept."""
    sections.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A report that an earlier stage has written."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def fingerprint(*columns: Column) -> Column:
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def write_version(df: DataFrame, path: str, version: str) -> None:
    """Writes rows of one version; those of other versions stay."""
    df.withColumn("version", F.lit(version)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def require_empty(violations: DataFrame, what: str) -> None:
    """Fails the job if there is a violation."""
    found = violations.take(3)
    if found:
        raise ValueError(f"{what}: {[r.asDict() for r in found]}")


def leaders(ranked: DataFrame, key: str, wanted: list[str], n: int) -> DataFrame:
    """(key, found, enough) of each wanted value of a key, also of those without a row: how many rows of the ranking it has, and whether they are `n`."""
    counts = ranked.groupBy(key).agg(F.count("*").alias("found"))
    every = ranked.sparkSession.createDataFrame([(w,) for w in wanted], f"{key} string")
    return every.join(counts, key, "left").select(key, F.coalesce("found", F.lit(0)).alias("found"), (F.coalesce("found", F.lit(0)) >= n).alias("enough"))


def require_leaders(ranked: DataFrame, keys: list[str], n: int, what: str, wanted: list[str] | None = None) -> DataFrame:
    """The rows of a ranking; fails the job if a key has fewer than `n`: a key of the ranking, or, of one column, any of the values that are `wanted`."""
    found = leaders(ranked, keys[0], wanted, n) if wanted is not None else ranked.groupBy(*keys).agg(F.count("*").alias("found"))
    require_empty(found.where(F.col("found") < n), f"{what} requires {n} results")
    return ranked


def match_by_either_key(rows: DataFrame, known: DataFrame, first: list[str], second: list[str], id_: str) -> DataFrame:
    """Rows with the id of the known row that shares the `first` keys, else the `second`; null where neither matches.

    Two equi-joins, as a join on either key would compare all pairs.
    """
    a = known.groupBy(*first).agg(F.min(id_).alias("_first"))
    b = known.groupBy(*second).agg(F.min(id_).alias("_second"))
    return rows.join(a, first, "left").join(b, second, "left").withColumn(id_, F.coalesce("_first", "_second")).drop("_first", "_second")
