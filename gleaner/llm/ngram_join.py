"""N-gram Jaccard join by universe partition and the pigeonhole principle; exact.

A document is the set of its distinct k-word shingles. Two sets link when their Jaccard similarity is
at least a threshold t. If a <= b are the sizes of a pair that links, the sets differ in at most
a * (1 - t) / t tokens. Sizes fall into bands; in a band whose largest smaller size is a, at most H
tokens differ. A hash cuts the universe of tokens into segments, which carry H + 1 + R units together:

* a plain segment is worth one unit, for if two sets differ there, they differ in one token or more;
  its content is indexed by one key;
* a neighbourhood segment is worth two: it is indexed by its content and by its content without each
  one of its tokens, so that sets without a common key there differ in two tokens or more.

Units that tell nothing are lost: an empty plain segment loses 1, a neighbourhood segment of 0 or 1
tokens 2 or 1, and a key that more than `heavy` documents share may be passed over. A set that has lost
no more than R units still shares a key that isn't passed over with every set it links with. Sets that
lost more are compared with each other only (both of a pair must have lost them): they keep their heavy
keys, and sets that have too many empty segments are cut again under another seed. A cost model
chooses R and how many segments get neighbourhoods in each band: keys to store against chance pairs.

Keys of few documents give candidate pairs, at most heavy * (heavy - 1) / 2 a key. A set with s spare
units left can lose no more than the others, so that a pair that links shares keys of s + 1 units at
least (s of either set); pairs that share fewer go before any text is sent. Documents that keep heavy keys are gathered to clusters, cut into blocks, and blocks
compared by matrix products, so that no pair is written there either. Each candidate is verified on the
sets themselves, which are made anew from the texts (64-bit hashes of shingles, which for one pair agree
wrongly with odds near 1e-13).

Null texts count as empty; empty sets link with nothing. Documents with equal sets are one class, of
which the smallest id takes part. Rows of one id and different texts are one node, with the links of all
its texts; repeated rows count once and each comes back. Rows with null ids take no part in links and
come back with null component. Other columns aren't read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from math import erfc, exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_bytes, columns, components, join_hot, mixed, small_batches, small_or_shuffled, staged, texts

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
SEEDS = 4
#: For the cost of an allocation: the share of tokens that unrelated sets hold in common, and what such a pair costs in keys.
COMMON, PAIR_COST = 0.3, 80
#: Documents of a block of a cluster, and shingles, about.
BLOCK, BLOCK_SHINGLES = 512, 1 << 20


@lru_cache(1)
def letter_table() -> np.ndarray:
    """Random numbers for each place of a word (64 in turn) and byte."""
    return np.random.default_rng(2024).integers(0, 1 << 63, (64, 256), np.uint64) * np.uint64(2) + np.uint64(1)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word: a sum of random numbers by place and byte, mixed with the length."""
    if not words:
        return np.zeros(0, np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    raw, starts = np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes) - sizes
    place = np.arange(len(raw)) - np.repeat(starts, sizes)
    parts = letter_table()[place & 63, raw]
    if len(raw) and place.max() > 63:
        parts = parts * (np.uint64(2) * (place >> 6).astype(np.uint64) + np.uint64(1))
    return mixed(np.add.reduceat(parts, starts) + sizes.astype(np.uint64) * GOLDEN)


def shingle_sets(many: list[str], k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the k-word shingles of each text; fewer words are one shingle."""
    split = [x.encode().lower().split() for x in many]
    hashes = word_hashes([w for x in split for w in x])
    out, at = [], 0
    factors = mixed(np.arange(1, k + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1)
    for words in split:
        own = hashes[at : at + len(words)]
        at += len(words)
        width = min(k, len(own))
        if not width:
            out.append(own)
            continue
        n = len(own) - width + 1
        total = np.full(n, width, np.uint64) * GOLDEN
        for i in range(width):
            total = total + own[i : i + n] * factors[i]
        out.append(np.unique(mixed(total)))
    return out


class Band:
    """Segments of one band of sizes: low <= smaller size < high."""

    def __init__(self, number: int, low: int, high: int, per_cent: int):
        self.number, self.low, self.high = number, low, high
        self.limit = (high - 1) * 100 // per_cent  # largest size that can take part
        self.differ = (high - 1) * (100 - per_cent) // per_cent
        best = None
        spares = {1, 2, 3, 4, 6, 8, *(int(self.differ * f) for f in (0.02, 0.04, 0.06, 0.1, 0.15, 0.25))} - {0}
        for share in (0.0, 0.25, 0.5, 1.0):
            for spare in sorted(spares):
                units = self.differ + 1 + spare
                pairs = int(units // 2 * share)
                segments = units - pairs
                odds, size = exp(-low / segments), sqrt(low * high) / segments
                lost = (segments - pairs) * odds + pairs * (2 * odds + low / segments * odds)
                over = 0.5 * erfc((spare - 1.5 - lost) / sqrt(2 * lost + 0.2))  # how many sets lose more than is spare
                keys = (segments - pairs + pairs * (1 + size)) * (1 + 3 * over)
                chance = (segments - pairs) * COMMON**size + pairs * (COMMON**size + size * COMMON ** max(size - 1, 0))
                cost = keys + PAIR_COST * chance
                if best is None or cost < best[0]:
                    best = (cost, spare, pairs, segments)
        _, self.spare, self.pairs, self.segments = best


@lru_cache(4)
def bands(per_cent: int, largest: int = 1 << 34) -> list[Band]:
    """Bands from the smallest size at which unequal sets can link; each is 1.3 times as large as the one before."""
    out, low = [], max(1, -(-per_cent // (100 - per_cent)))
    while low <= largest:
        high = max(low + 1, int(low * 1.3))
        out.append(Band(len(out), low, high, per_cent))
        low = high
    return out


def set_keys(tokens: np.ndarray, per_cent: int) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(group, spare units left, keys, units of each key) for each band and seed the set takes part in."""
    n, out = len(tokens), []
    for band in bands(per_cent):
        if band.low > n:
            break
        if n > band.limit:
            continue
        for seed in range(SEEDS + 1):
            group = band.number * (SEEDS + 1) + seed
            salt = mixed(np.array([group + 1], np.uint64) * GOLDEN)[0]
            if seed == SEEDS:  # lost too much under every seed: one key for all such sets of the band
                out.append((group, -1, np.array([salt]), np.ones(1, np.int64)))
                break
            h = mixed(tokens ^ salt)
            where = ((h >> np.uint64(32)) * np.uint64(band.segments) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(where, kind="stable")
            where, value = where[order], mixed(h[order] + GOLDEN)
            starts = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
            filled, sizes = where[starts], np.diff(np.append(starts, n))
            sums = np.add.reduceat(value, starts)
            double = filled < band.pairs
            lost = (band.segments - band.pairs) - int((~double).sum()) + 2 * (band.pairs - int(double.sum())) + int((sizes[double] == 1).sum())
            keys, units = [mixed(sums + mixed(filled.astype(np.uint64) + salt))], [np.where(double, 2, 1)]
            if double.any():
                wide = np.repeat(double & (sizes > 1), sizes)
                near = (np.repeat(sums, sizes) - value)[wide]
                keys.append(mixed(near + mixed(where[wide].astype(np.uint64) + salt)))
                units.append(np.full(len(near), 2))
            out.append((group, band.spare - lost, np.concatenate(keys), np.concatenate(units)))
            if lost <= band.spare:
                break
    return out


def set_table(documents: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, print, row): the size of each set, a 128-bit fingerprint, null for empty sets, and a hash of the text; staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            sets = shingle_sets(texts(batch), k)
            prints = [blake2b(s, digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary()), batch.column("row")], ["doc_id", "n_shingles", "print", "row"])

    rows = documents.select("doc_id", "text", F.xxhash64("text").alias("row"))
    return staged(rows.mapInArrow(run, "doc_id long, n_shingles long, print binary, row long"))


def key_table(documents: DataFrame, k: int, per_cent: int) -> DataFrame:
    """(key, id, tag) of every segment key; tag = (group * 2^16 + spare + 2^15) * 4 + units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", 1 << 20):
            keys, ids, tags = [], [], []
            for doc, tokens in zip(batch.column("doc_id").to_pylist(), shingle_sets(texts(batch), k), strict=True):
                for group, spare, own, units in set_keys(tokens, per_cent):
                    keys.append(own)
                    ids.append(np.full(len(own), doc, np.int64))
                    tags.append((group * 65536 + max(-32768, min(spare, 32767)) + 32768) * 4 + units)
            if keys:
                columns = [np.concatenate(x).view(np.int64) if x is keys else np.concatenate(x) for x in (keys, ids, tags)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["key", "id", "tag"])

    return documents.select("doc_id", "text").mapInArrow(run, "key long, id long, tag long")


def shared_keys(keys: DataFrame) -> DataFrame:
    """(key, id, tag, n) of the keys that two documents or more have; staged."""
    return staged(keys.withColumn("n", F.count("*").over(Window.partitionBy("key"))).where("n > 1"))


def candidate_pairs(few: DataFrame) -> DataFrame:
    """(a, b) with a < b of the sets (key, id, group, spare, lost, units) that share keys enough in one group.

    Of a pair that links, the keys in common carry more units than either set has to spare, less those of
    heavy keys in common. Such keys count for `lost` units of each set at most; and where both sets have
    lost more than they can spare, heavy keys in common would put both into one cluster, in which they are
    compared anyway. A segment that is equal in both counts once for each of its keys, which lets pairs
    through and holds none back.
    """
    left = few.select("key", "group", F.col("id").alias("a"), "spare", "lost", "units")
    right = few.select("key", F.col("id").alias("b"), F.col("spare").alias("spare_b"), F.col("lost").alias("lost_b"))
    left_over = F.greatest(F.col("spare") - F.col("lost"), F.col("spare_b") - F.col("lost_b"))
    need = F.when(left_over >= 0, left_over).otherwise(F.greatest("spare", "spare_b")) + 1
    both = left.join(right, "key").where("a < b").groupBy("a", "b", "group").agg(F.sum("units").alias("shared"), F.max(need).alias("need"))
    return both.where("shared >= need").select("a", "b").distinct()


def verified(documents: DataFrame, pairs: DataFrame, k: int, per_cent: int) -> DataFrame:
    """The staged pairs (a, b) that link. Each text goes to the pairs of it; one with many pairs is dealt out by salt."""
    ids = staged(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    rows = staged_texts(documents, ids)
    fans = staged(pairs.groupBy("a").agg(F.count("*").alias("fan")))
    dealt = join_hot(pairs, fans, "a", "fan", pairs.count(), "inner").withColumn("salt", F.pmod(F.xxhash64("b"), F.ceil(F.col("fan") / 64)).cast("int"))
    centres = fans.select("a", F.explode(F.sequence(F.lit(0), F.ceil(F.col("fan") / 64).cast("int") - 1)).alias("salt"))
    ones = centres.join(rows, centres.a == rows.doc_id).select("a", "salt", F.lit(0).alias("other"), F.lit(None).cast("long").alias("b"), "text")
    others = dealt.join(rows, dealt.b == rows.doc_id).select("a", "salt", F.lit(1).alias("other"), "b", "text")
    sorted_ = ones.union(others).repartition("a", "salt").sortWithinPartitions("a", "salt", "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, centre_sets = None, []
        for batch in by_bytes(batches, "text"):
            found_a, found_b = [], []
            sets = shingle_sets(texts(batch), k)
            for a, salt, other, b, own in zip(*(batch.column(c).to_pylist() for c in ("a", "salt", "other", "b")), sets, strict=True):
                if (a, salt) != now:
                    now, centre_sets = (a, salt), []
                if not other:
                    centre_sets.append(own)
                elif any(linked(centre, own, per_cent) for centre in centre_sets):
                    found_a.append(a)
                    found_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], ["a", "b"])

    return staged(sorted_.mapInArrow(run, "a long, b long").distinct())


def linked(a: np.ndarray, b: np.ndarray, per_cent: int) -> bool:
    low, high = sorted((len(a), len(b)))
    if not low or 100 * low < per_cent * high:
        return False
    joined = np.concatenate([a, b])
    joined.sort(kind="stable")
    both = int((joined[1:] == joined[:-1]).sum())
    return 100 * both >= per_cent * (low + high - both)


def staged_texts(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text) of the wanted ids, read once."""
    return documents.select("doc_id", "text").join(small_or_shuffled(ids), "doc_id", "left_semi")


def block_links(documents: DataFrame, clusters: DataFrame, k: int, per_cent: int) -> tuple[DataFrame, DataFrame]:
    """Links within clusters (id, component, n_shingles): edges (a, b) that span the links, and (id, n) links of each id.

    A cluster is cut into blocks of about BLOCK documents and BLOCK_SHINGLES shingles by a hash of the id.
    Each pair of blocks is one task's row group, of two blocks at most; products of token matrices give
    all intersections there.
    """
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int")
    sizes = staged(clusters.groupBy("component").agg(F.count("*").alias("members"), F.least(blocks, F.count("*").cast("int")).alias("blocks")))
    member = join_hot(clusters, sizes, "component", "members", clusters.count(), "inner").withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), F.col("blocks")).cast("int"))
    member = member.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    member = member.select("id", "component", "block", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"))
    rows = staged_texts(documents, staged(clusters.select(F.col("id").alias("doc_id"))))
    found = member.join(rows, member.id == rows.doc_id).select("component", "i", "j", "block", "id", "text")
    sorted_ = found.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "id")

    def compare(i: int, j: int, blocks: list[int], ids: list[int], sets: list[np.ndarray]) -> Iterator[tuple[int, int, int, int]]:
        """(id, links, a, b): degrees, and edges of a spanning forest."""
        n = len(ids)
        counts = np.array([len(s) for s in sets], np.int64)
        values, codes = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(n), counts)
        often = np.bincount(codes, minlength=len(values))
        keep = often[codes] > 1
        names = np.cumsum(often > 1) - 1
        owner, codes = owner[keep], names[codes[keep]]
        left = np.flatnonzero(np.array(blocks) == i)
        right = np.flatnonzero(np.array(blocks) == j)
        both = np.zeros((len(left), len(right)), np.float32)
        place = np.empty(n, np.int64)
        step = 4096
        order = np.argsort(codes, kind="stable")
        owner, codes = owner[order], codes[order]
        cuts = np.searchsorted(codes, np.arange(0, int(codes[-1]) + 1 + step if len(codes) else 0, step))
        for c, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            matrix = np.zeros((n, step), np.float32)
            matrix[owner[a:b], codes[a:b] - c * step] = 1
            both += matrix[left] @ matrix[right].T
        union = counts[left][:, None] + counts[right][None, :] - both
        hit = 100 * both >= per_cent * union
        if i == j:
            np.fill_diagonal(hit, False)
        degree = np.zeros(n, np.int64)
        np.add.at(degree, left, hit.sum(axis=1))
        if i != j:
            np.add.at(degree, right, hit.sum(axis=0))
        place = list(range(n))

        def top(x: int) -> int:
            while place[x] != x:
                place[x] = place[place[x]]
                x = place[x]
            return x

        for r, row in enumerate(hit):
            for c in np.flatnonzero(row).tolist():
                a, b = top(int(left[r])), top(int(right[c]))
                if a != b:
                    place[max(a, b)] = min(a, b)
                    yield ids[left[r]], 0, ids[left[r]], ids[right[c]]
        for x in np.flatnonzero(degree).tolist():
            yield ids[x], int(degree[x]), ids[x], ids[x]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blocks, ids, sets = None, [], [], []

        def result() -> pa.RecordBatch:
            rows = list(compare(now[1], now[2], blocks, ids, sets)) if ids else []
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(4)], ["id", "n", "a", "b"])

        for batch in by_bytes(batches, "text"):
            for *key, block, id_, own in zip(*(batch.column(c).to_pylist() for c in ("component", "i", "j", "block", "id")), shingle_sets(texts(batch), k), strict=True):
                if key != now:
                    if now:
                        yield result()
                    now, blocks, ids, sets = key, [], [], []
                blocks.append(block)
                ids.append(id_)
                sets.append(own)
        if now:
            yield result()

    out = staged(sorted_.mapInArrow(run, "id long, n long, a long, b long"))
    return out.where("a <> b").select("a", "b"), out.where("n > 0").groupBy("id").agg(F.sum("n").alias("n"))


def jaccard_components(documents: DataFrame, k: int = 5, per_cent: int = 80, heavy: int = 16) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every row.

    component_id is the smallest doc_id that links lead to; n_links counts the different texts (classes
    of equal sets) that the document's set links with.
    """
    small_batches(documents.sparkSession)
    sizes = set_table(documents, k)
    n_rows = sizes.count()
    classes = sizes.where("doc_id is not null and print is not null")
    # An id of several texts is one node: it is joined with the head of each.
    several = staged(classes.groupBy("doc_id").agg((F.min("print") != F.max("print")).alias("several")).where("several").select("doc_id"))
    heads = staged(classes.groupBy("print").agg(F.min("doc_id").alias("head"), F.max("doc_id").alias("last"), F.count("*").alias("n")).where("head <> last").drop("last"))
    members = join_hot(classes, heads, "print", "n", n_rows, "inner")
    copies = staged(members.where("doc_id <> head").select("doc_id", "row").distinct())
    ties = members.join(small_or_shuffled(several), "doc_id", "left_semi").where("doc_id <> head").select(F.col("doc_id").alias("a"), F.col("head").alias("b"))
    known = documents.select("doc_id", "text", F.xxhash64("text").alias("row")).where("doc_id is not null and text is not null")
    rows = known.join(small_or_shuffled(copies), ["doc_id", "row"], "left_anti").select("doc_id", "text")

    keys = shared_keys(key_table(rows, k, per_cent))
    group, spare, units = F.shiftright("tag", 18), F.pmod(F.shiftright("tag", 2), F.lit(65536)) - 32768, F.col("tag").bitwiseAND(3)
    keys = keys.select("key", "id", group.cast("int").alias("group"), spare.cast("int").alias("spare"), units.cast("int").alias("units"), "n")
    lean = F.col("n") <= heavy
    lost = staged(keys.where(~lean).groupBy("id", "group").agg(F.sum("units").alias("lost"), F.max("spare").alias("spare")))
    over = lost.where("lost > spare").select("id", "group")
    kept = staged(keys.where(~lean).join(small_or_shuffled(staged(over)), ["id", "group"], "left_semi").select("key", "id"))
    held = staged(kept.groupBy("key").agg(F.min("id").alias("star"), F.count("*").alias("m")).where("m > 1"))
    stars = join_hot(kept, held, "key", "m", kept.count(), "inner").select(F.col("id").alias("a"), F.col("star").alias("b")).distinct()
    clusters = components(stars)
    length = classes.groupBy(F.col("doc_id").alias("id")).agg(F.max("n_shingles").alias("n_shingles"))
    clusters = staged(clusters.join(length, "id"))

    few = keys.where(lean).join(small_or_shuffled(lost.select("id", "group", "lost")), ["id", "group"], "left")
    few = few.select("key", "id", "group", "spare", F.coalesce("lost", F.lit(0)).alias("lost"), "units")
    pairs = staged(candidate_pairs(few))
    names = small_or_shuffled(clusters.select("id", "component"))
    pairs = pairs.join(names.select(F.col("id").alias("a"), F.col("component").alias("ca")), "a", "left").join(names.select(F.col("id").alias("b"), F.col("component").alias("cb")), "b", "left")
    pairs = staged(pairs.where("ca is null or cb is null or ca <> cb").select("a", "b"))  # others are compared in their cluster

    links = verified(rows, pairs, k, per_cent)
    edges, degrees = block_links(rows, clusters, k, per_cent)
    found = components(links.union(edges).union(ties))
    counted = links.select(F.col("a").alias("id")).union(links.select("b")).groupBy("id").agg(F.count("*").alias("n")).union(degrees).groupBy("id").agg(F.sum("n").alias("n_links"))
    facts = staged(found.join(counted, "id", "full_outer").withColumn("lone", F.lit(True)))
    named = heads.join(facts.drop("lone"), heads["head"] == facts["id"], "left").select("print", "head", "n", F.coalesce("component", "head").alias("of_class"), F.col("n_links").alias("links_of_class"))
    named = join_hot(sizes.drop("row"), staged(named), "print", "n", n_rows)
    # Rows of a class of one look for their own id; the flag keeps the others, which don't, from one key.
    named = named.withColumn("id", F.col("doc_id")).withColumn("lone", F.col("head").isNull()).join(small_or_shuffled(facts), ["id", "lone"], "left")
    known = F.col("doc_id").isNotNull()
    component, n_links = F.coalesce("of_class", "component", "doc_id"), F.coalesce("links_of_class", "n_links", F.lit(0))
    return named.select("doc_id", "n_shingles", F.when(known, component).alias("component_id"), F.when(known, n_links).otherwise(0).alias("n_links"))


def without_near_duplicates(documents: DataFrame, k: int = 5, per_cent: int = 80) -> DataFrame:
    """One row of each component, that of its smallest id (of rows with one id, any one); rows with null ids stay."""
    found = staged(jaccard_components(documents, k, per_cent).where("doc_id is not null").select("doc_id", (F.col("component_id") != F.col("doc_id")).alias("drop")))
    touched = staged(found.groupBy("doc_id").agg(F.bool_or("drop").alias("drop"), F.count("*").alias("n")).where("drop or n > 1"))
    again = staged(touched.where("not drop").select("doc_id"))
    rows = documents.join(small_or_shuffled(touched.select("doc_id")), "doc_id", "left_anti").select(columns(documents))
    if again.isEmpty():
        return rows
    return rows.union(documents.join(small_or_shuffled(again), "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(columns(documents)))
