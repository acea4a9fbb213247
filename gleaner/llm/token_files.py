"""Token-id files by fixed-width bit packing.

A file holds the ids of many documents in ascending order of doc_id, each id in the fewest bits that
the vocabulary needs, in blocks of a fixed number of ids. An index of its documents and a table of
block offsets follow the header, so that a reader unpacks any document, block, or range of ids,
without the others, by numpy alone.

    bytes 0-3    b"FWB2"
    4            bits an id
    5-8          ids a block
    9-16         number of ids
    17-24        number of blocks, n
    25-32        number of documents, d
    33-40        number of documents without a doc_id, which stand first
    41-48        place of the file in the order of all files: the number of its range of doc_id ...
    49-56        ... and its number in that range
    57-          d doc_ids (signed) and d lengths in ids, 8 bytes each;
                 n + 1 offsets of blocks from the end of this table, 8 bytes each; then the blocks

All numbers are little-endian and, but for doc_ids, unsigned; ids follow each other from the lowest bit
of each byte. Spark writes each file (a line end follows its last block) into one folder of any store
that it can reach, and reads them back as binary files. Null and empty texts give a document that has
the end id alone; repeated rows are written as often as they come, those of one doc_id in the order of
their texts' hashes; null ids stand first; an empty table gives an empty folder; other columns are not
read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import OddWords, WordCache, byte_letters, encoded_pieces, vocabulary_path
from .common import by_bytes, order_buckets, running_total, shared_dir, small_batches, small_or_shuffled, staged, texts

MAGIC, HEADER, BLOCK = b"FWB2", struct.Struct("<4sBIQQQQQQ"), 4096
#: Ids packed or unpacked at once, a multiple of 8.
CHUNK = 1 << 17


def bits_for(vocabulary_size: int) -> int:
    return max(1, int(vocabulary_size - 1).bit_length())


def packed_bits(ids: np.ndarray, bits: int) -> bytes:
    """Eight ids at a time fill `bits` bytes; each byte takes its bits from the ids that reach into it. CHUNK ids are in work at once."""
    done = []
    for at in range(0, len(ids), CHUNK):
        part = ids[at : at + CHUNK]
        groups = np.zeros(-(-len(part) // 8) * 8, np.uint64)
        groups[: len(part)] = part
        groups, out = groups.reshape(-1, 8), np.zeros((len(groups) // 8, bits), np.uint8)
        for i in range(8):
            for byte in range(i * bits // 8, ((i + 1) * bits - 1) // 8 + 1):
                shift = byte * 8 - i * bits
                moved = groups[:, i] >> np.uint64(shift) if shift >= 0 else groups[:, i] << np.uint64(-shift)
                out[:, byte] |= (moved & np.uint64(255)).astype(np.uint8)
        done.append(out.tobytes())
    return b"".join(done)


def unpacked_bits(raw: np.ndarray, bits: int, count: int) -> np.ndarray:
    found = np.empty(count, "<u4")
    for at in range(0, count, CHUNK):
        n = min(CHUNK, count - at)
        part = raw[at * bits // 8 : (at + CHUNK) * bits // 8]
        padded = np.zeros(-(-n // 8) * bits, np.uint8)
        padded[: min(len(part), len(padded))] = part[: len(padded)]
        cells, out = padded.reshape(-1, bits), np.zeros((len(padded) // bits, 8), np.uint64)
        for i in range(8):
            for byte in range(i * bits // 8, ((i + 1) * bits - 1) // 8 + 1):
                shift, cell = byte * 8 - i * bits, cells[:, byte].astype(np.uint64)
                out[:, i] |= cell << np.uint64(shift) if shift >= 0 else cell >> np.uint64(-shift)
        found[at : at + n] = out.ravel()[:n] & np.uint64((1 << bits) - 1)
    return found


def pack(ids: np.ndarray, bits: int, block: int = BLOCK, docs: list[int | None] = (), sizes: list[int] = (), place: tuple[int, int] = (0, 0)) -> bytes:
    """The bytes of one file; `block` is a multiple of 8, and documents without an id stand first."""
    ids = np.ascontiguousarray(ids, "<u4")
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    whole, each = -(-len(ids) // block), block * bits // 8
    body = packed_bits(ids, bits)[: -(-len(ids) * bits // 8)]
    offsets = np.minimum(np.arange(whole + 1, dtype="<u8") * np.uint64(each), np.uint64(len(body)))
    nulls = sum(d is None for d in docs)
    index = np.array([d or 0 for d in docs], "<i8").tobytes() + np.array(sizes, "<u8").tobytes()
    return HEADER.pack(MAGIC, bits, block, len(ids), whole, len(docs), nulls, *place) + index + offsets.astype("<u8").tobytes() + body


def header(data: bytes) -> tuple[int, int, int]:
    """Range and number of a file, and how many ids it has."""
    fields = HEADER.unpack_from(data)
    return fields[7], fields[8], fields[3]


class PackedIds:
    """Random access to the documents and ids of one file."""

    def __init__(self, data: bytes):
        magic, self.bits, self.block, self.n, blocks, n_docs, nulls, *place = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token-id file")
        self.place, at = tuple(place), HEADER.size
        self.docs = [None] * nulls + np.frombuffer(data, "<i8", n_docs, at)[nulls:].tolist()
        self.ends = np.cumsum(np.frombuffer(data, "<u8", n_docs, at + 8 * n_docs).astype(np.int64))
        at += 16 * n_docs
        self.offsets = np.frombuffer(data, "<u8", blocks + 1, at).astype(np.int64)
        self.body = np.frombuffer(data, np.uint8, offset=at + 8 * (blocks + 1))

    def read_block(self, i: int) -> np.ndarray:
        return unpacked_bits(self.body[self.offsets[i] : self.offsets[i + 1]], self.bits, min(self.block, self.n - i * self.block))

    def read(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        stop = self.n if stop is None else min(stop, self.n)
        if start >= stop:
            return np.zeros(0, "<u4")
        first, last = start // self.block, (stop - 1) // self.block
        raw = self.body[self.offsets[first] : self.offsets[last + 1]]  # blocks follow each other, so that they unpack together
        ids = unpacked_bits(raw, self.bits, min((last + 1) * self.block, self.n) - first * self.block)
        return ids[start - first * self.block : stop - first * self.block]

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document, by the blocks that hold it alone."""
        return self.read(int(self.ends[i - 1]) if i else 0, int(self.ends[i]))


class LibraryVocabulary:
    """Encodes different pieces by the tokenizers library, which gets them normalised and cut already."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        suffix = self.library.model.end_of_word_suffix or ""
        names = self.library.get_vocab(with_added_tokens=True)
        self.size = max(names.values()) + 1
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for x, i in names.items() if x.endswith(suffix)]] = True
        self.letters = {b: x for b, x in enumerate(byte_letters()) if b != 32}
        self.library.normalizer, self.library.pre_tokenizer = None, pre_tokenizers.WhitespaceSplit()
        self.odd = OddWords(path)

    def encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words without white space, one after another, and how many each has."""
        return encoded_pieces(words, self.merged, self.odd)

    def merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """A call for thousands of pieces: each ends with the token that carries the suffix."""

        def encoded(lot: list[bytes]) -> np.ndarray:
            letters = b" ".join(lot).decode("latin-1").translate(self.letters)
            return np.array(self.library.encode_batch_fast([letters], add_special_tokens=False)[0].ids, np.int64)

        lots = [encoded(pieces[i : i + 4000]) for i in range(0, len(pieces), 4000)]
        flat = np.concatenate(lots) if lots else np.zeros(0, np.int64)
        ends = np.flatnonzero(self.ends[flat])
        if len(ends) != len(pieces):  # a piece that the library cuts otherwise: one by one
            lots = [encoded([x]) for x in pieces]
            return np.concatenate(lots), np.array([len(x) for x in lots], np.int64)
        return flat, np.diff(np.append(-1, ends))


@lru_cache(2)
def library_cache(path: str) -> tuple[WordCache, int]:
    found = LibraryVocabulary(path)
    return WordCache(found.encoded, found.special), found.size


def write_token_files(documents: DataFrame, path: str | None = None, end_id: int = 1, file_ids: int = 1 << 21, folder: str | None = None) -> str:
    """Encodes documents, appends `end_id` to each, and writes files in ascending order of doc_id.

    Returns the folder, a new one in the shared folder unless it is given. A file is closed once it
    holds `file_ids` ids.
    """
    small_batches(documents.sparkSession)
    source, bucket, parts = order_buckets(documents.select("doc_id", "text"), "doc_id", 4000)
    ordered = source.withColumn("bucket", bucket).repartition(parts, "bucket").sortWithinPartitions("bucket", "doc_id", F.xxhash64("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, size = library_cache(vocabulary_path(path))
        bits, parts, docs, sizes, seqs, now, total = bits_for(max(size, end_id + 1)), [], [], [], {}, None, 0

        def file() -> pa.RecordBatch:
            seqs[now] = seqs.get(now, -1) + 1
            data = pack(np.concatenate(parts), bits, docs=docs, sizes=sizes, place=(now, seqs[now]))
            for held in (parts, docs, sizes):
                held.clear()
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])

        for batch in by_bytes(batches, "text"):
            flat, lengths = cache.ids(texts(batch))
            ends = np.cumsum(lengths + 1)
            ids = np.full(int(ends[-1]), end_id, np.int32)
            own = np.ones(len(ids), bool)
            own[ends - 1] = False
            ids[own] = flat
            begin = end = 0  # ids of this batch from `begin` on aren't in a part yet
            for at, doc, n in zip(batch.column("bucket").to_pylist(), batch.column("doc_id").to_pylist(), (lengths + 1).tolist(), strict=True):
                if docs and (at != now or total >= file_ids):
                    parts.append(ids[begin:end])
                    yield file()
                    begin, total = end, 0
                now, end, total = at, end + n, total + n
                docs.append(doc)
                sizes.append(n)
            parts.append(ids[begin:end])
        if docs:
            yield file()

    folder = folder or f"{shared_dir(documents.sparkSession)}/token_files/{uuid.uuid4().hex}"
    files = ordered.mapInArrow(write, "data binary")
    files.select(F.col("data").cast("string")).write.option("maxRecordsPerFile", 1).text(folder)  # the text writer takes bytes as they are
    return folder


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, ids) of each document: start counts the ids of all documents before it."""
    return _read(spark, folder, "ids array<long>", lambda ids: [pa.array([x.tolist() for x in ids], pa.list_(pa.int64()))], ["ids"])


def token_checksums(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, read back from the files."""
    return _read(spark, folder, "n_tokens long, ids_crc32 long", lambda ids: [pa.array([len(x) for x in ids], pa.int64()), pa.array([zlib.crc32(np.ascontiguousarray(x, "<u4")) for x in ids], pa.int64())], ["n_tokens", "ids_crc32"])


def _read(spark: SparkSession, folder: str, schema: str, columns, names: list[str]) -> DataFrame:
    small_batches(spark)
    files = spark.read.format("binaryFile").load(folder).where("length > 0").select("path", "content")

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [header(x.as_buffer()) for x in batch.column("content")]
            yield pa.RecordBatch.from_arrays([batch.column("path"), *(pa.array([f[i] for f in found], pa.int64()) for i in range(3))], ["path", "bucket", "seq", "n_tokens"])

    places = staged(files.mapInArrow(heads, "path string, bucket long, seq long, n_tokens long"))
    before = running_total(places, "bucket", "n_tokens")
    inside = Window.partitionBy("bucket").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = places.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    starts = starts.join(before, "bucket").select("path", (F.col("inside") + F.col("before")).alias("at"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, at in zip(batch.column("content"), batch.column("at").to_pylist(), strict=True):
                held = PackedIds(data.as_buffer())
                ids, begins = held.read(), np.append(0, held.ends[:-1])
                parts = [ids[a:b] for a, b in zip(begins.tolist(), held.ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(held.docs, pa.int64()), pa.array(begins + at, pa.int64()), *columns(parts)], ["doc_id", "start", *names])

    # One row of numbers a file: broadcast while they are few, so that the files themselves aren't shuffled.
    rows = files.join(small_or_shuffled(starts, places.count()), "path").select("content", "at")
    return rows.mapInArrow(read, f"doc_id long, start long, {schema}")
