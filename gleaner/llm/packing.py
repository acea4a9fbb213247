"""Conflict-constrained best-fit packing of documents into bins of a fixed capacity.

Documents go, longest first, to the bin with the least room that still holds them and with which they
don't conflict: bins stand by their room, each carries a bitmap of sources that it has enough of and a
bitmap of duplicate clusters that it has, and the search goes on to the next larger room until it finds
a compatible bin, or opens one. A document longer than the capacity fills bins of its own and its rest
is packed like any other.

Rows are dealt by a hash over shards of about `shard_rows` rows, which are packed one by one; only ids,
lengths, sources and clusters go there. The hash takes in the number of a row among equal ones, so that
repeated rows are spread like any others, and the same rows are packed alike whatever the partitions. Null or negative lengths count as 0 and such documents still
get a place; null sources are one source; a null cluster conflicts with nothing. Repeated rows are each
packed (and, sharing a cluster, never together). Of bins with equal room, the one that got there first
is taken; of documents of equal length, the smallest id goes first. An empty table gives no rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA = "doc_id long, piece int, shard int, bin long, start long, n_tokens long"


class Bins:
    """Open bins by room; `find` gives the tightest compatible one."""

    def __init__(self, capacity: int, max_per_source: int):
        self.capacity, self.most = capacity, max_per_source
        self.rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.any = 0  # bit r: some bin has room r
        self.room: list[int] = []
        self.sources: list[int] = []  # bit s: enough of source s
        self.clusters: list[int] = []
        self.counts: list[dict[int, int]] = []

    def find(self, size: int, source: int, cluster: int) -> int:
        left = self.any >> size
        at = size
        while left:
            step = (left & -left).bit_length() - 1
            at += step
            for b in self.rooms[at]:
                if not (self.sources[b] >> source) & 1 and (cluster < 0 or not (self.clusters[b] >> cluster) & 1):
                    return b
            left >>= step + 1
            at += 1
        return -1

    def put(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """The bin and the place in it."""
        b = self.find(size, source, cluster)
        if b < 0:
            b = len(self.room)
            self.room.append(self.capacity)
            self.sources.append(0)
            self.clusters.append(0)
            self.counts.append({})
        else:
            old = self.rooms[self.room[b]]
            old.remove(b)
            if not old:
                self.any &= ~(1 << self.room[b])
        start = self.capacity - self.room[b]
        self.room[b] -= size
        self.rooms[self.room[b]].append(b)
        self.any |= 1 << self.room[b]
        self.counts[b][source] = n = self.counts[b].get(source, 0) + 1
        if n >= self.most:
            self.sources[b] |= 1 << source
        if cluster >= 0:
            self.clusters[b] |= 1 << cluster
        return b, start


def pack_rows(rows: list[tuple], capacity: int, max_per_source: int) -> list[tuple[int, int, int, int, int]]:
    """(row, piece, bin, start, size) for rows of (size, source number, cluster number or -1) in the order to pack."""
    bins, out, solid = Bins(capacity, max_per_source), [], []
    for i, (size, source, cluster) in enumerate(rows):
        pieces, rest = divmod(size, capacity)
        solid += [(i, k, capacity) for k in range(pieces)]
        if rest or not pieces:
            b, start = bins.put(rest, source, cluster)
            out.append((i, pieces, b, start, rest))
    full = len(bins.room)
    return out + [(i, k, full + n, 0, size) for n, (i, k, size) in enumerate(solid)]


def best_fit(documents: DataFrame, length: Column, cluster: Column, capacity: int = 4096, max_per_source: int = 4, shard_rows: int = 4096) -> DataFrame:
    """(doc_id, piece, shard, bin, start, n_tokens) of every piece of every document."""
    rows = documents.select("doc_id", F.greatest(F.coalesce(length.cast("long"), F.lit(0)), F.lit(0)).alias("size"), F.coalesce("source", F.lit("")).alias("source"), cluster.cast("long").alias("cluster"))
    shards = max(1, -(-documents.select("doc_id").count() // shard_rows))
    # Repeated rows are counted and numbered, so that their shards are the same however the table is cut.
    rows = rows.groupBy("doc_id", "size", "source", "cluster").agg(F.count("*").alias("copies"))
    rows = rows.withColumn("number", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies")
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", "size", "number"), F.lit(shards)).cast("int"))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "doc_id", "source", "cluster"], ascending=[False, True, True, True], kind="stable", na_position="first").reset_index(drop=True)
        source = pd.factorize(group["source"])[0].tolist()
        repeated = group["cluster"].where(group["cluster"].duplicated(keep=False))
        clusters = pd.factorize(repeated)[0].tolist()  # -1: none, or its only document here
        out = pd.DataFrame(pack_rows(list(zip(group["size"].tolist(), source, clusters, strict=True)), capacity, max_per_source), columns=["row", "piece", "bin", "start", "n_tokens"])
        out["doc_id"], out["shard"] = group["doc_id"].to_numpy()[out["row"]], group["shard"].iloc[0]
        return out[["doc_id", "piece", "shard", "bin", "start", "n_tokens"]]

    return rows.groupBy("shard").applyInPandas(pack, SCHEMA)
