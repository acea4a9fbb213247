"""Alignment of the tokens of two tokenizers over the same bytes, and counts of the token pairs that they make.

Both sides cut the same bytes, a space and the text. Per Arrow batch, the tokens of each side stand in a
frame with the byte at which they start; `merge_asof`, keyed by document, finds for each token start the
token of the other side that covers it. Two tokens overlap if the later one starts within the other, so
both directions together give all overlaps, and places where tokens of both sides end cut groups.

Null and empty texts have no tokens, nor have texts whose tokens don't give back their bytes on either
side. Repeated rows, and rows of one id or of none, are documents of their own. Texts are read whole; a
batch holds about a megabyte of them, or one longer text. Ties of counts all are best. An empty table
gives no rows; columns other than `doc_id` and `text` aren't looked at. `token_pairs` bounds the Arrow
batches of the session, unless it has a bound of its own.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_letters
from .common import BROADCAST_ROWS, by_bytes, small_batches, staged, texts

PAIRS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, codes binary, times binary"
#: Different pairs that a task counts before it hands its counts on.
PAIRS_HELD = 2_000_000


class ByteLevel:
    """A byte-level BPE file; strings of special tokens are plain text."""

    def __init__(self, path: str):
        import tiktoken
        from public_tokenizers import PATTERN

        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        vocab = data["model"]["vocab"]
        back = {letter: b for b, letter in enumerate(byte_letters())}
        special = {t["content"] for t in data["added_tokens"]}
        ranks = {bytes(map(back.__getitem__, name)): i for name, i in vocab.items() if name not in special}
        merges = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        order = [vocab[a + b] for a, b in merges]
        if order != sorted(order):
            raise ValueError(f"the ids of {path} don't follow the order of its merges")
        self.size = max([*vocab.values(), *(t["id"] for t in data["added_tokens"])]) + 1
        self.bytes = [b""] * self.size
        for token, i in ranks.items():
            self.bytes[i] = token
        self.library = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encoded(self, many: list[str]) -> list[list[int]]:
        return [self.library.encode_ordinary(" " + x) for x in many]


class Pieces:
    """A piece model, which puts the space in front of a text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.library.get_piece_size()
        names = [self.library.id_to_piece(i) for i in range(self.size)]
        self.bytes = [bytes([int(x[3:5], 16)]) if self.library.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)]

    def encoded(self, many: list[str]) -> list[list[int]]:
        return self.library.encode(many, num_threads=1)


@lru_cache(4)
def tokenizer(path: str) -> ByteLevel | Pieces:
    """One for each path, or name of a public file, and worker: a byte-level file if it is JSON, a piece model otherwise."""
    if not os.path.isabs(path):
        import public_tokenizers

        path = public_tokenizers.path(path)
    return ByteLevel(path) if path.endswith(".json") else Pieces(path)


def code_type(size_a: int, size_b: int) -> str:
    """The number type of a pair's code, `a * size_b + b`."""
    return "<u4" if size_a * size_b <= 1 << 32 else "<u8"


class Side:
    """The tokens of the texts of a batch on one side: ids, document and the bytes at which each starts and ends."""

    def __init__(self, ids: list[list[int]], lengths: np.ndarray):
        self.counts = np.array([len(x) for x in ids], np.int64)
        self.ids = np.fromiter(chain.from_iterable(ids), np.int64, int(self.counts.sum()))
        self.doc = np.repeat(np.arange(len(ids)), self.counts)
        self.end = np.cumsum(lengths[self.ids])
        self.start = self.end - lengths[self.ids]

    def covering(self, other: Side) -> np.ndarray:
        """For each token, the place of the token of the other side that covers its start."""
        own = pd.DataFrame({"doc": self.doc, "at": self.start})
        theirs = pd.DataFrame({"doc": other.doc, "at": other.start, "place": np.arange(len(other.ids))})
        return pd.merge_asof(own, theirs, on="at", by="doc")["place"].to_numpy(np.int64)


class Aligner:
    """Aligns batches of texts under two tokenizers."""

    def __init__(self, a: ByteLevel | Pieces, b: ByteLevel | Pieces):
        self.a, self.b = a, b
        self.lengths = [np.array([len(x) for x in t.bytes], np.int64) for t in (a, b)]
        size = max(a.size, b.size)
        self.names = np.array([f"{i}{sign}" for sign in (",", "|", ";", "") for i in range(size)], object)
        self.type = np.dtype(code_type(a.size, b.size))

    def ids(self, many: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides; none for texts that are empty or that the tokens of a side don't give back."""
        found = [t.encoded(many) for t in (self.a, self.b)]
        for i, x in enumerate(many):
            raw = b" " + x.encode()
            if not x or any(b"".join(map(t.bytes.__getitem__, ids[i])) != raw for t, ids in zip((self.a, self.b), found, strict=True)):
                found[0][i] = found[1][i] = []
        return found[0], found[1]

    def aligned(self, many: list[str]) -> dict[str, pa.Array]:
        """For each text its numbers of tokens, groups and links, its groups, and the codes of its different links and how often each occurs."""
        found = self.ids(many)
        a, b = (Side(ids, lengths) for ids, lengths in zip(found, self.lengths, strict=True))
        over, under = a.covering(b), b.covering(a)
        later = a.start[under] < b.start  # where both start together, the other direction has the link
        doc = np.concatenate([a.doc, b.doc[later]])
        codes = np.concatenate([a.ids * self.b.size + b.ids[over], a.ids[under[later]] * self.b.size + b.ids[later]])
        ends = np.intersect1d(a.end, b.end, assume_unique=True)
        group_a, group_b = np.searchsorted(ends, a.end), np.searchsorted(ends, b.end)
        n, one = len(many), self.a.size * self.b.size
        linked, times = np.unique(doc * one + codes, return_counts=True)
        cuts = np.searchsorted(linked, np.arange(n + 1) * one)
        linked, times = (linked % one).astype(self.type), times.astype("<u4")
        return {
            "n_a": pa.array(a.counts), "n_b": pa.array(b.counts),
            "n_groups": pa.array(np.bincount(b.doc[np.isin(b.end, ends, assume_unique=True)], minlength=n).astype(np.int64)),
            "n_links": pa.array(np.bincount(doc, minlength=n).astype(np.int64)),
            "groups": pa.array(self.written(a, b, group_a, group_b, len(ends)), pa.string()),
            "codes": pa.array([linked[i:j].tobytes() for i, j in zip(cuts, cuts[1:])], pa.binary()),
            "times": pa.array([times[i:j].tobytes() for i, j in zip(cuts, cuts[1:])], pa.binary()),
        }

    def written(self, a: Side, b: Side, group_a: np.ndarray, group_b: np.ndarray, groups: int) -> list[str]:
        """The groups of each text, as `a1,a2|b1;a3|b2,b3`."""
        in_a, in_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        before_b, to_a = np.cumsum(in_b) - in_b, np.cumsum(in_a)
        place_a = np.arange(len(a.ids)) + before_b[group_a]
        place_b = np.arange(len(b.ids)) + to_a[group_b]
        size = len(self.names) // 4
        sign = np.zeros(len(a.ids) + len(b.ids), np.int64)
        ids = np.empty(len(sign), np.int64)
        ids[place_a], ids[place_b] = a.ids, b.ids
        last_a, last_b = np.append(group_a[1:] != group_a[:-1], True)[: len(group_a)], np.append(group_b[1:] != group_b[:-1], True)[: len(group_b)]
        sign[place_a[last_a]], sign[place_b[last_b]] = 1, 2
        ends = np.cumsum(a.counts + b.counts)
        sign[ends[a.counts > 0] - 1] = 3
        parts = self.names[sign * size + ids].tolist()
        return ["".join(parts[i:j]) for i, j in zip([0, *ends[:-1].tolist()], ends.tolist())]


def token_pairs(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, codes, times) of every document.

    `groups` has the ids of both sides, `a1,a2|b1;a3|b2,b3`; `codes` has the different linked pairs in
    ascending order, as `a * size_b + b` in the type of `code_type`, and `times` how often each occurs.
    """
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(tokenizer(path_a), tokenizer(path_b))
        for batch in by_bytes(batches, "text", 1 << 20):
            found = aligner.aligned(texts(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *found.values()], ["doc_id", *found])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PAIRS)


def pair_counts(pairs: DataFrame, size_a: int, size_b: int) -> DataFrame:
    """(code, n_documents, best): in how many documents each pair is linked, and whether no pair of its A id is in more; staged."""
    kind = np.dtype(code_type(size_a, size_b))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0

        def summed() -> tuple[np.ndarray, np.ndarray]:
            codes, back = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
            return codes, np.bincount(back, np.concatenate([n for _, n in held]), len(codes)).astype(np.int64)

        def out(codes: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int64)), pa.array(sums)], ["code", "n"])

        for batch in by_bytes(batches, "codes", 4 << 20):
            codes, n = np.unique(np.frombuffer(b"".join(batch.column("codes").to_pylist()), kind), return_counts=True)
            held.append((codes, n.astype(np.int64)))
            waiting += len(codes)
            if waiting > PAIRS_HELD:
                held = [summed()]
                waiting = len(held[0][0])
                if waiting > PAIRS_HELD // 2:
                    yield out(*held[0])
                    held, waiting = [], 0
        if held:
            yield out(*summed())

    counted = staged(pairs.select("codes").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n_documents")))
    first = F.expr(f"code div {size_b}")
    most = counted.groupBy(first.alias("a")).agg(F.max("n_documents").alias("most"))  # a row for each id of A at most
    named = counted.withColumn("a", first).join(F.broadcast(most), "a")
    return staged(named.select("code", "n_documents", (F.col("n_documents") == F.col("most")).alias("best")))


def with_pair_counts(pairs: DataFrame, counts: DataFrame, size_a: int, size_b: int, most: int = BROADCAST_ROWS) -> DataFrame:
    """Staged `pairs` with n_best, links whose pair is the commonest of its A id, and count_sum, over the links of each document.

    The commonest pairs, `most` at most, are looked up in the tasks; links of the others are rows that
    are joined with their counts. The pairs that are looked up are all that at least 2^k documents
    hold, for the smallest k that keeps to the bound; so no key of the join has more than 2^k rows.
    """
    level = F.floor(F.log2("n_documents")).cast("int")
    levels = sorted(((r["level"], r["n"]) for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()), reverse=True)  # 63 rows at most
    least, held = 63, 0
    for k, n in levels:
        if held + n > most:
            break
        least, held = k, held + n
    common = counts.where(level >= least).orderBy("code").toPandas()  # bounded by `most`
    cold = held < sum(n for _, n in levels)
    kind = np.dtype(code_type(size_a, size_b))
    table = pairs.sparkSession.sparkContext.broadcast(tuple(common[c].to_numpy(t) for c, t in (("code", np.int64), ("n_documents", np.int64), ("best", bool))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n_documents, best = table.value
        for batch in by_bytes(batches, "codes", 4 << 20):
            raw = [x or b"" for x in batch.column("codes").to_pylist()]
            codes = np.frombuffer(b"".join(raw), kind).astype(np.int64)
            times = np.frombuffer(b"".join(x or b"" for x in batch.column("times").to_pylist()), "<u4").astype(np.int64)
            ends = np.append(0, np.cumsum([len(x) // kind.itemsize for x in raw]))
            place = np.minimum(np.searchsorted(known, codes), max(len(known) - 1, 0))
            hit = known[place] == codes if len(known) else np.zeros(len(codes), bool)
            place = place[hit]
            sums = [np.zeros(len(codes) + 1, np.int64) for _ in range(2)]
            sums[0][1:][hit], sums[1][1:][hit] = times[hit] * best[place], times[hit] * n_documents[place]
            columns = [pa.array(np.diff(np.cumsum(s)[ends])) for s in sums]
            rest = [pa.array([x[i:j][~hit[i:j]] for i, j in zip(ends, ends[1:])], pa.list_(pa.int64())) for x in (codes, times)] if cold else []
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keys), *columns, *rest], [*keys, *("n_best", "count_sum", "rest", "rest_times")[: 2 + len(rest)]])

    keys = [c for c in pairs.columns if c not in ("codes", "times")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema if f.name in keys) + ", n_best long, count_sum long"
    if not cold:
        return pairs.mapInArrow(run, schema)
    # The number is written with its row, so that it stays the same however often later stages run.
    keys = [*keys, "row"]
    schema = schema.replace(", n_best", ", row long, n_best", 1) + ", rest array<long>, rest_times array<long>"
    found = staged(pairs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(run, schema))
    links = found.select("row", F.explode(F.arrays_zip("rest", "rest_times")).alias("x")).select("row", F.col("x.rest").alias("code"), F.col("x.rest_times").alias("times"))
    links = links.join(counts.where(level < least), "code")
    sums = links.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n_documents")).alias("more_sum"))
    rows = found.drop("rest", "rest_times").join(sums, "row", "left")
    return rows.withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0))).withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).drop("row", "more_best", "more_sum")
