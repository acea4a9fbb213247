"""Set-similarity self join inside groups, exact, by prefix filtering, and what a greedy pick keeps of it."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Sets of a group that share a token, above which the sets are compared in blocks, and how large these are.
HOT_SETS, BLOCK_SETS = 4_000, 1_000
#: Upper bits of a token by which tokens are counted for their order, and pairs that one task compares by their signatures.
COUNTED_BITS, TASK_PAIRS = 21, 4_000_000


def shared(spark: SparkSession) -> str:
    """The folder that the cluster names as spark.checkpoint.dir; where none is set, the warehouse of a session of one process."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return (found or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def staged(df: DataFrame) -> DataFrame:
    """Writes a table in the shared folder and reads it again."""
    spark = df.sparkSession
    path = f"{shared(spark)}/staged/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_or_shuffled(table: DataFrame, most: int = 1_000_000) -> DataFrame:
    """Hints a broadcast of a staged table of a few longs a row if it has at most `most` rows."""
    return F.broadcast(table) if table.count() <= most else table


def blocked(indexed: DataFrame, per_cent: int, block_sets: int) -> tuple[DataFrame, DataFrame]:
    """Rows of (grp, head, size, token), dealt for a join of each side with the other: with a `key` of two blocks.

    Sets of one token are cut into classes of size, of which only neighbours can have similar sets, and
    a class into blocks. Each pair of blocks that can match is one key, of at most about twice
    `block_sets` rows; a set is sent to each pair that its block is in, on the left or on the right.
    """
    width = math.log(100 / per_cent) * 1.0001  # a little wider, so that rounding never parts similar sizes by two
    rows = indexed.withColumn("class", F.floor(F.log("size") / width).cast("int"))
    counts = rows.groupBy("grp", "token", "class").agg(F.ceil(F.count("*") / F.lit(block_sets)).cast("int").alias("blocks"))
    counts = counts.groupBy("grp", "token").agg(F.map_from_entries(F.collect_list(F.struct("class", "blocks"))).alias("blocks"))  # a few classes a token
    rows = rows.join(small_or_shuffled(staged(counts)), ["grp", "token"]).withColumn("block", F.pmod(F.xxhash64("head", F.lit(3)), F.col("blocks")[F.col("class")]).cast("int"))

    def upto(n: Column) -> Column:
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def keys(first: Column, other: Column, i: Column, j: Column) -> Column:
        return F.struct(first.alias("c"), i.alias("i"), other.alias("d"), j.alias("j"))

    own, c = F.col("block"), F.col("class")
    after, before = (F.coalesce(F.try_element_at("blocks", c + n), F.lit(0)) for n in (1, -1))
    left = F.concat(F.transform(F.sequence(own, F.col("blocks")[c] - 1), lambda j: keys(c, c, own, j)), F.transform(upto(after), lambda j: keys(c, c + 1, own, j)))
    right = F.concat(F.transform(F.sequence(F.lit(0), own), lambda i: keys(c, c, i, own)), F.transform(upto(before), lambda i: keys(c - 1, c, i, own)))
    return tuple(rows.select(*indexed.columns, F.explode(k).alias("key")) for k in (left, right))


def candidates(indexed: DataFrame, per_cent: int, hot_sets: int, block_sets: int) -> DataFrame:
    """(grp, x, y), x < y: pairs of heads that share an indexed token and can be similar by their sizes and the token's places."""
    a, b = F.col("a.size"), F.col("b.size")
    need = F.ceil(F.lit(per_cent) * (a + b) / (100 + per_cent))
    within = (100 * F.least(a, b) >= per_cent * F.greatest(a, b)) & (F.least(a - F.col("a.at"), b - F.col("b.at")) >= need)
    together = (F.col("a.grp") == F.col("b.grp")) & (F.col("a.token") == F.col("b.token")) & within
    before = F.col("a.head") < F.col("b.head")
    pair = [F.col("a.grp").alias("grp"), F.least("a.head", "b.head").alias("x"), F.greatest("a.head", "b.head").alias("y")]
    may_be = indexed.where(F.col("upto") > hot_sets) if "upto" in indexed.columns else indexed
    indexed = indexed.select("grp", "head", "size", "at", "token")
    often = staged(may_be.groupBy("grp", "token").agg(F.count("*").alias("n")).where(F.col("n") > hot_sets).select("grp", "token"))
    n = often.count()
    rare = indexed.join(F.broadcast(often) if n <= 1_000_000 else often, ["grp", "token"], "left_anti") if n else indexed
    found = rare.alias("a").join(rare.alias("b"), together & before).select(*pair)
    if n:
        left, right = blocked(indexed.join(F.broadcast(often) if n <= 1_000_000 else often, ["grp", "token"]), per_cent, block_sets)
        one_block = (F.col("a.key.c") == F.col("a.key.d")) & (F.col("a.key.i") == F.col("a.key.j"))
        found = found.union(left.alias("a").join(right.alias("b"), together & (F.col("a.key") == F.col("b.key")) & (before | ~one_block)).select(*pair))
    return found.distinct()


def pieces(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of batches with about `most` tokens, each with all its tokens, their rows in the slice, and the sizes of its sets."""
    for batch in batches:
        sizes = pc.list_value_length(batch.column("set")).to_numpy(zero_copy_only=False).astype(np.int64)
        lot = (np.cumsum(sizes) - 1) // most
        cuts = [0, *(np.flatnonzero(np.diff(lot)) + 1).tolist(), len(sizes)]
        for start, end in zip(cuts, cuts[1:], strict=False):
            if end > start:
                part, own = batch.slice(start, end - start), sizes[start:end]
                yield part, part.column("set").flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.repeat(np.arange(len(own)), own), own


def token_levels(heads: DataFrame) -> np.ndarray:
    """How many sets have tokens of the same upper bits, in eighths of a power of two, rounded up: 2**COUNTED_BITS bytes at any size."""
    lot = 1 << 14

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTED_BITS, np.int64)
        for _, tokens, _, _ in pieces(batches):
            total += np.bincount((tokens >> np.uint64(64 - COUNTED_BITS)).astype(np.int64), minlength=len(total))
        found = np.flatnonzero(total)
        for start in range(0, len(found), 1 << 18):
            part = found[start : start + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], ["bucket", "n"])

    def packed(rows: pa.Table) -> pa.Table:
        levels, at = np.zeros(lot, np.uint8), rows.column("bucket").to_numpy()
        levels[at % lot] = np.minimum(np.ceil(8 * np.log2(rows.column("n").to_numpy()) - 1e-9), 255)
        return pa.table({"lot": pa.array([int(at[0]) // lot], pa.int32()), "levels": pa.array([levels.tobytes()], pa.binary())})

    counts = heads.select("set").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    levels = np.zeros(1 << COUNTED_BITS, np.uint8)
    for r in counts.groupBy(F.expr(f"bucket div {lot}")).applyInArrow(packed, "lot int, levels binary").collect():  # bounded by COUNTED_BITS
        levels[r["lot"] * lot : (r["lot"] + 1) * lot] = np.frombuffer(r["levels"], np.uint8)
    return levels


def prefixes(heads: DataFrame, per_cent: int) -> DataFrame:
    """(grp, head, size, at, token, upto): the first tokens of each set in the order of their counts, of which two similar sets share one.

    `upto` bounds how many sets have the token; a token that only one can have finds nothing and is left out.
    """
    levels = token_levels(heads)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, tokens, row, sizes in pieces(batches):
            level = levels[(tokens >> np.uint64(64 - COUNTED_BITS)).astype(np.int64)]
            order = np.lexsort((tokens, level, row))
            place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            kept = np.flatnonzero((place < (sizes - (per_cent * sizes + 99) // 100 + 1)[row]) & (level[order] > 0))
            own = pa.array(row[kept])
            numbers = [pa.array(sizes[row[kept]].astype(np.int32)), pa.array(place[kept].astype(np.int32)), pa.array(tokens[order[kept]].view(np.int64)), pa.array(np.ceil(2.0 ** (level[order[kept]] / 8)).astype(np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column("grp").take(own), batch.column("head").take(own), *numbers], ["grp", "head", "size", "at", "token", "upto"])

    kinds = {c: heads.schema[c].dataType.simpleString() for c in ("grp", "head")}
    return heads.select("grp", "head", "set").mapInArrow(run, f"grp {kinds['grp']}, head {kinds['head']}, size int, at int, token long, upto long")


def signature_words(sizes: np.ndarray) -> np.ndarray:
    """Words of 64 bits of the signatures of sets: a power of two, of two bits for each token at least."""
    return np.int64(1) << np.ceil(np.log2(np.maximum(1, sizes / 32))).astype(np.int64)


def signatures(heads: DataFrame) -> DataFrame:
    """(head, size, signature): bit i of a signature says if a set has an odd number of tokens whose lower bits are i."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, tokens, row, sizes in pieces(batches):
            bits = 64 * signature_words(sizes)
            ends = np.cumsum(bits)
            at = (ends - bits)[row] + (tokens & (bits - 1).astype(np.uint64)[row]).astype(np.int64)
            odd = np.packbits((np.bincount(at, minlength=ends[-1]) & 1).astype(np.uint8), bitorder="little")
            offsets = pa.array(np.append(0, ends // 8).astype(np.int32))
            binary = pa.Array.from_buffers(pa.binary(), len(sizes), [None, offsets.buffers()[1], pa.py_buffer(odd)])
            yield pa.RecordBatch.from_arrays([batch.column("head"), pa.array(sizes.astype(np.int32)), binary], ["head", "size", "signature"])

    return heads.select("head", "set").mapInArrow(run, f"head {heads.schema['head'].dataType.simpleString()}, size int, signature binary")


def may_be_similar(x: np.ndarray, y: np.ndarray, sizes: np.ndarray, signed: list[bytes], per_cent: int) -> np.ndarray:
    """Which pairs of sets (places x, y) can be similar: bits that differ are tokens that only one of two sets has, at least."""
    words = signature_words(sizes)
    table, place = {}, np.zeros(len(sizes), np.int64)
    for w in np.unique(words).tolist():
        own = np.flatnonzero(words == w)
        place[own] = np.arange(len(own))
        table[w] = np.frombuffer(b"".join(signed[i] for i in own), np.uint64).reshape(-1, w)
    x, y = np.where(words[x] <= words[y], x, y), np.where(words[x] <= words[y], y, x)
    out = np.zeros(len(x), bool)
    kind = words[x] * (1 << 32) + words[y]
    for k in np.unique(kind).tolist():
        few, many = k >> 32, k & ((1 << 32) - 1)
        own = np.flatnonzero(kind == k)
        for part in np.array_split(own, 1 + len(own) * many // (1 << 20)):
            folded = np.bitwise_xor.reduce(table[many][place[y[part]]].reshape(-1, many // few, few), axis=1)
            differ = np.bitwise_count(table[few][place[x[part]]] ^ folded).sum(axis=1, dtype=np.int64)
            both = sizes[x[part]] + sizes[y[part]]
            out[part] = (both - differ) * (100 + per_cent) >= 2 * per_cent * both
    return out


def by_signatures(pairs: DataFrame, heads: DataFrame, per_cent: int, task_pairs: int) -> DataFrame:
    """The pairs (grp, x, y) whose signatures leave them possible.

    Heads are dealt into blocks, and each pair of blocks is compared in one task: so a signature is sent once
    for each block, and not once for each pair, and a task has about `task_pairs` pairs.
    """
    n = pairs.count()
    if not n:
        return pairs
    blocks = max(4, math.ceil(math.sqrt(2 * n / task_pairs)))

    def block(c: str) -> Column:
        return F.pmod(F.xxhash64(c, F.lit(5)), F.lit(blocks)).cast("int")

    left = pairs.withColumn("i", F.least(block("x"), block("y"))).withColumn("j", F.greatest(block("x"), block("y")))
    own = block("head")
    others = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda k: F.struct(F.least(own, k).alias("i"), F.greatest(own, k).alias("j")))
    right = staged(signatures(heads)).select("head", "size", "signature", F.explode(others).alias("key")).select("key.i", "key.j", "head", "size", "signature")
    schema = pairs.schema

    def run(met: pa.Table, known: pa.Table) -> pa.Table:
        if not met.num_rows:
            return met.select(["grp", "x", "y"])
        ids = known.column("head").combine_chunks()
        x, y = (pc.index_in(met.column(c).combine_chunks(), value_set=ids).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("x", "y"))
        sizes = known.column("size").to_numpy().astype(np.int64)
        return met.select(["grp", "x", "y"]).filter(pa.array(may_be_similar(x, y, sizes, known.column("signature").to_pylist(), per_cent)))

    return left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(run, schema)


def similar_pairs(df: DataFrame, id_: str, group: str, tokens: str, per_cent: int = 62, hot_sets: int = HOT_SETS, block_sets: int = BLOCK_SETS, task_pairs: int = TASK_PAIRS) -> DataFrame:
    """(group, a, b, similarity) of the pairs a < b of one group whose Jaccard similarity is at least per_cent / 100.

    Tokens are 64-bit hashes, in an order of how many rows have them or others of the same upper bits, rare
    ones first. Two sets that are similar enough share one of their first n - ceil(per_cent * n / 100) + 1
    tokens; where that token stands bounds what they can still share. Sets of a token that more than
    `hot_sets` have are compared in blocks. Pairs that meet are compared by signatures of their sets, a
    few bits a token; the sets are sent only for pairs that are left, and decide. Equal sets count as one
    class, expanded at the end by its members only: a copy is similar to all that its class's smallest id is
    similar to, without a pair of its own. Sets are written once, and ids are unique.
    """
    hashed = F.array_sort(F.array_distinct(F.transform(tokens, lambda t: F.xxhash64(t))))
    rows = df.select(F.col(id_).alias("id"), F.col(group).alias("grp"), hashed.alias("set")).where((F.size("set") > 0) & F.col("grp").isNotNull())
    rows = staged(rows.withColumns({"h": F.xxhash64("set"), "k": F.xxhash64(F.lit(7), "set")}))  # 128 bits that stand for the set
    several = rows.groupBy("grp", "h", "k").agg(F.min("id").alias("head"), F.count("*").alias("members")).where("members > 1")
    copies = staged(rows.select("id", "grp", "h", "k").join(several, ["grp", "h", "k"]).where("id <> head").select("grp", "head", "id"))
    heads = rows.select("id", "grp", "set").join(small_or_shuffled(copies.select("id")), "id", "left_anti").withColumnRenamed("id", "head")
    pairs = staged(candidates(staged(prefixes(heads, per_cent)), per_cent, hot_sets, block_sets))
    pairs = staged(by_signatures(pairs, heads, per_cent, task_pairs))
    wanted = small_or_shuffled(staged(pairs.select(F.col("x").alias("head")).union(pairs.select("y")).distinct()))
    sets = staged(heads.join(wanted, "head", "left_semi").select("grp", "head", "set"))
    checked = pairs.join(sets.select("grp", F.col("head").alias("x"), F.col("set").alias("sx")), ["grp", "x"]).join(sets.select("grp", F.col("head").alias("y"), F.col("set").alias("sy")), ["grp", "y"])
    both = F.size(F.array_intersect("sx", "sy"))
    checked = checked.withColumn("similarity", both / (F.size("sx") + F.size("sy") - both)).where(F.col("similarity") >= per_cent / 100)
    same = copies.select("grp", F.col("head").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("similarity"))
    other = checked.select("grp", F.col("x").alias("a"), F.col("y").alias("b"), "similarity")
    return other.union(same).withColumnRenamed("grp", "group")


def greedy_independent(ranked: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, taken) for rows (id, rank) visited by rank, each taken unless it has an edge (a, b) to one taken before.

    A row is taken if each of its terms holds; at first there is a term for each better neighbour, that it
    isn't taken. In rounds, terms of decided rows are settled, and rows that have one term left become
    another name of its row, or of its opposite: chains of them are followed by doubling steps to their
    root, which then stands in all terms. So a chain of n rows takes log2(n) steps, and a row whose
    terms say both that a root is taken and that it isn't is decided without it. The same answer as the
    visit one by one.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    ranks = ranked.select(F.col("id").alias("b"), F.col("rank").alias("brank"))
    better = both.join(ranked.select(F.col("id").alias("a"), F.col("rank").alias("arank")), "a").join(ranks, "b").where("brank < arank")
    terms = staged(better.select("a", "b", F.lit(False).alias("same")))  # the term holds if b is taken (same), or isn't
    values = terms.select(F.col("b").alias("id")).distinct().join(terms.select(F.col("a").alias("id")).distinct(), "id", "left_anti").select("id", F.lit(True).alias("taken"))
    decided, names = [staged(values)], []
    while not terms.isEmpty():
        settled = staged(terms.join(decided[-1].select(F.col("id").alias("b"), "taken"), "b", "left").withColumn("holds", F.col("taken") == F.col("same")))
        state = settled.groupBy("a").agg(F.coalesce(F.bool_and("holds"), F.lit(True)).alias("taken"), F.count_if(F.col("holds").isNull()).alias("n"), F.count_if(~F.col("holds")).alias("failed"))
        now = state.where("failed > 0 or n = 0").select(F.col("a").alias("id"), "taken")
        one = state.where("failed = 0 and n = 1").select("a")
        left = settled.where("holds is null").join(now.select(F.col("id").alias("a")), "a", "left_anti").select("a", "b", "same")
        alias = staged(left.join(one, "a").select(F.col("a").alias("id"), F.col("b").alias("root"), "same"))
        left = left.join(one, "a", "left_anti")
        if not alias.isEmpty():
            alias = followed(alias)
            names.append(alias)
            root = alias.select(F.col("id").alias("b"), "root", F.col("same").alias("as_root"))
            left = left.join(root, "b", "left").select("a", F.coalesce("root", "b").alias("b"), F.coalesce(F.col("same") == F.col("as_root"), F.col("same")).alias("same")).distinct()
            left = staged(left)
            torn = left.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").select(F.col("a").alias("id")).distinct()
            now = now.union(torn.withColumn("taken", F.lit(False)))
            left = left.join(torn.select(F.col("id").alias("a")), "a", "left_anti")
        decided.append(staged(now))
        terms = staged(left)
    for alias in reversed(names):  # a root is decided later than its names, or is a later name itself
        known = reduce(DataFrame.union, decided)
        decided.append(staged(alias.join(known.withColumnRenamed("id", "root"), "root").select("id", (F.col("taken") == F.col("same")).alias("taken"))))
    known = reduce(DataFrame.union, decided)
    return ranked.select("id").join(known, "id", "left").select("id", F.coalesce("taken", F.lit(True)).alias("taken"))


def followed(alias: DataFrame) -> DataFrame:
    """(id, root, same) with roots that aren't names themselves, by doubling steps."""
    while True:
        on = alias.select(F.col("id").alias("root"), F.col("root").alias("further"), F.col("same").alias("then"))
        step = staged(alias.join(on, "root", "left").select("id", F.coalesce("further", "root").alias("root"), F.coalesce(F.col("same") == F.col("then"), F.col("same")).alias("same"), F.col("further").isNotNull().alias("moved")))
        alias = step.drop("moved")
        if step.where("moved").isEmpty():
            return alias
