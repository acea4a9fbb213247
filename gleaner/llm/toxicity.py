"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features are rates of one text: hits of a short fixed lexicon and of words and word beginnings that the
labelled rows show to be typical, their nearness to second-person words, capitals, punctuation and
obfuscated spelling. The typical words are learned from two folds, of at most about `sample_rows`
labelled rows each, the trees from two others, all chosen by a hash of the id (the bound is a parameter);
rows of the held-out fold never take part. The calibration is fitted across: trees of all parts but one
give the margins of that part, near copies being in one part, and isotonic steps over all these margins, at any number of rows, turn
the margin of the final trees into the score. Every row of the input is scored over its whole text, and
neither id, language, source nor label enters a score.

Null and empty texts have features of 0 and a score. A document with several labels counts as toxic if
one says so, and its rows are learned from as often as it is repeated. Without labels of both kinds, or
without documents, the score is the share of toxic labels (0 if none); an empty table gives no rows.
`fit` bounds Arrow batches for the rest of the session, unless it has a bound of its own.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, mapped_rows, small_batches, small_or_shuffled, staged, texts

# Plain insults, second-person words, and signs that stand for letters.
LEXICON = frozenset("idiot idiots moron morons stupid loser losers pathetic worthless scum trash garbage disgusting clown dumb fool jerk filth filthy vermin hate kill die ugly retard bastard creep".split())
SECOND = frozenset("you your yours yourself youre u ur ya du dich dir dein deine ihr euch euer sie tu te toi ton ta tes vous votre vos usted ustedes ti tus vosotros".split())
SIGNS = str.maketrans("0134578@$!", "oieastbasi")
SHARES = ["fixed", "typical", "begins", "weight", "second", "capitals", "signs", "exclaim", "spelled", "repeats"]
FEATURES = [*SHARES, "near_second", "strongest", "hits", "length"]
PREFIXES = (4, 5, 6)


def forms(word: str) -> tuple[str, str]:
    """A word's letters in lower case, and the same with signs read as letters."""
    low = word.lower().strip(".,;:!?\"'()[]{}…«»")
    return low, re.sub(r"[^\w]|_", "", low.translate(SIGNS)) if low and not low.isalpha() else low


class WordFacts(dict):
    """Numbers words, and keeps one row of facts for each in a flat array; emptied beyond `limit` words or `most_chars` of them."""

    def __init__(self, typical: dict[str, float], limit: int = 200_000, most_chars: int = 8 << 20):
        self.typical, self.limit, self.most_chars, self.chars, self.new = typical, limit, most_chars, 0, []
        self.table = np.zeros((1 << 14, len(SHARES)), np.float32)

    def __missing__(self, word: str) -> int:
        low, read = forms(word)
        odd = low != read and any(c.isalpha() for c in low)
        known = self.typical.get(low) or self.typical.get(read) or 0.0
        begins = max((self.typical.get(f"{read[:n]}-", 0.0) for n in PREFIXES if len(read) >= n), default=0.0)
        letters = sum(c.isalpha() for c in word)
        caps = sum(c.isupper() for c in word)
        self.new.append((float(low in LEXICON or read in LEXICON), float(known > 0), float(begins > 0), max(known, begins), float(read in SECOND), float(caps > 1 and caps == letters), float(len(word) - letters), float(word.count("!")), float(odd), float(bool(re.search(r"(\w)\1\1", low)))))
        self[word] = n = len(self)
        self.chars += len(word)
        return n

    def gather(self) -> None:
        """Moves the rows of new words to the array."""
        used = len(self) - len(self.new)
        if len(self) > len(self.table):
            self.table = np.concatenate([self.table[:used], np.zeros((max(used, len(self.new)), len(SHARES)), np.float32)])
        if self.new:
            self.table[used : len(self)] = self.new
            self.new = []

    def features(self, many: list[str]) -> np.ndarray:
        """A row of FEATURES for each text."""
        if len(self) > self.limit or self.chars > self.most_chars:
            self.clear()
            self.chars = 0
        split = [x.split() for x in many]
        counts = np.array([len(x) for x in split], np.int64)
        codes = np.fromiter((self[w] for x in split for w in x), np.int64, int(counts.sum()))
        out = np.zeros((len(many), len(FEATURES)))
        if not len(codes):
            return out
        self.gather()
        facts = self.table[codes]
        full = np.flatnonzero(counts)
        starts = (np.cumsum(counts) - counts)[full]
        out[full, : len(SHARES)] = np.add.reduceat(facts, starts, axis=0, dtype=np.float64) / counts[full, None]
        hit = (facts[:, 0] + facts[:, 1] + facts[:, 2]) > 0
        before = np.append(0, np.cumsum(facts[:, 4]))
        text_start = np.repeat(starts, counts[full])
        text_end = np.repeat(starts + counts[full], counts[full])
        place = np.arange(len(codes))
        near = before[np.minimum(place + 6, text_end)] - before[np.maximum(place - 5, text_start)] > 0
        k = len(SHARES)
        out[full, k] = np.add.reduceat((near & hit).astype(np.float64), starts) / counts[full]
        out[full, k + 1] = np.maximum.reduceat(facts[:, 3], starts)
        out[full, k + 2] = np.minimum(np.add.reduceat(hit.astype(np.float64), starts), 20)
        out[full, k + 3] = np.log1p(counts[full])
        return out


class Boosted:
    """Trees of depth 3 by second-order boosting of the log loss over binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 60, rate: float = 0.2, depth: int = 3, least: float = 1.0):
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 33)[1:-1])) for j in range(x.shape[1])]
        share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
        self.base, self.rate, self.trees = float(np.log(share / (1 - share))), rate, []
        bins, margin = self.binned(x), np.full(len(y), self.base)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-margin))
            tree = self.grow(bins, p - y, np.maximum(p * (1 - p), 1e-6), depth, least)
            self.trees.append(tree)
            margin += rate * self.follow(tree, bins)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(self.cuts)], axis=1)

    def grow(self, bins: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, least: float):
        own, weight = g.sum(), h.sum()
        leaf = -own / (weight + 1.0)
        if depth == 0 or len(g) < 4:
            return leaf
        best = (1e-6, None, None)
        for j in range(bins.shape[1]):
            gl = np.cumsum(np.bincount(bins[:, j], g, len(self.cuts[j]) + 1))[:-1]
            hl = np.cumsum(np.bincount(bins[:, j], h, len(self.cuts[j]) + 1))[:-1]
            if not len(gl):
                continue
            gain = gl**2 / (hl + 1) + (own - gl) ** 2 / (weight - hl + 1) - own**2 / (weight + 1)
            gain[(hl < least) | (weight - hl < least)] = 0
            if gain.max() > best[0]:
                best = (gain.max(), j, int(gain.argmax()))
        if best[1] is None:
            return leaf
        left = bins[:, best[1]] <= best[2]
        return best[1], best[2], self.grow(bins[left], g[left], h[left], depth - 1, least), self.grow(bins[~left], g[~left], h[~left], depth - 1, least)

    def follow(self, tree, bins: np.ndarray) -> np.ndarray:
        if not isinstance(tree, tuple):
            return np.full(len(bins), tree)
        left = bins[:, tree[0]] <= tree[1]
        out = np.empty(len(bins))
        out[left], out[~left] = self.follow(tree[2], bins[left]), self.follow(tree[3], bins[~left])
        return out

    def margin(self, x: np.ndarray) -> np.ndarray:
        bins, total = self.binned(x), np.full(len(x), self.base)
        for tree in self.trees:
            total += self.rate * self.follow(tree, bins)
        return total


class Isotonic:
    """Rising steps by pooling of adjacent violators, read between their middles."""

    def __init__(self, margin: np.ndarray, y: np.ndarray):
        pools: list[list[float]] = []
        for m, v in sorted(zip(margin.tolist(), y.tolist(), strict=True)):
            pools.append([v, 1.0, m])
            while len(pools) > 1 and (pools[-2][0] >= pools[-1][0] or pools[-2][2] / pools[-2][1] == pools[-1][2] / pools[-1][1]):
                v2, n2, m2 = pools.pop()
                v1, n1, m1 = pools[-1]
                pools[-1] = [(v1 * n1 + v2 * n2) / (n1 + n2), n1 + n2, m1 + m2]
        self.x, self.y = np.array([m / n for _, n, m in pools]), np.array([v for v, _, _ in pools])

    def __call__(self, margin: np.ndarray) -> np.ndarray:
        return np.interp(margin, self.x, self.y)


class Model:
    def __init__(self, typical: dict[str, float], trees: Boosted | None, steps: Isotonic | None, share: float):  # trees and steps are both there or not
        self.typical, self.trees, self.steps, self.share = typical, trees, steps, share

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.share)
        margin = self.trees.margin(x)
        steps = self.steps(margin)
        # A little of the plain score keeps the order within a step, but never moves a score over one half.
        mixed = np.clip(0.998 * steps + 0.002 / (1 + np.exp(-margin)), 0, 1)
        return np.where(steps >= 0.5, np.maximum(mixed, 0.5), np.minimum(mixed, np.nextafter(0.5, 0)))


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5))


def training_rows(documents: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """(fold, toxic, text) of labelled rows outside the held-out fold, about `sample_rows` a fold at most."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.withColumn("fold", F.when(fold(F.col("doc_id")).isin(1, 2), 1).otherwise(fold(F.col("doc_id"))).cast("int")).where("fold <> 0")
    share = min(1.0, 4 * sample_rows / max(1, known.count()))
    known = staged(known.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20)) < int(share * (1 << 20))))
    return documents.select("doc_id", "text").join(small_or_shuffled(known), "doc_id").select("fold", "toxic", "text")


def typical_words(rows: DataFrame, least: int, most: int, log_odds: float) -> dict[str, float]:
    """Words, and beginnings (marked by a hyphen), with the logarithm of how much oftener toxic texts hold them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[int]] = {}

        def counts() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array([x[0] for x in found.values()], pa.int64()), pa.array([x[1] for x in found.values()], pa.int64())], ["word", "clean", "toxic"])
            found.clear()
            return out

        for batch in by_bytes(batches, "text", 1 << 18):
            for toxic, text in zip(batch.column("toxic").to_pylist(), texts(batch), strict=True):
                words = {read for w in set(text.split()) for read in forms(w) if read}
                for w in words | {f"{w[:n]}-" for w in words for n in PREFIXES if len(w) >= n} | {""}:
                    found.setdefault(w, [0, 0])[toxic > 0] += 1
            if len(found) > 100_000:  # partial counts, so that memory stays bounded
                yield counts()
        yield counts()

    counted = rows.select("toxic", "text").mapInArrow(count, "word string, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counted = staged(counted.where((F.col("toxic") >= least) | (F.col("word") == "")))
    all_ = counted.where("word = ''").first()
    if not all_ or not all_["toxic"] or not all_["clean"]:
        return {}
    odds = F.log((F.col("toxic") + 0.5) / (all_["toxic"] + 1.0)) - F.log((F.col("clean") + 0.5) / (all_["clean"] + 1.0))
    top = counted.where("word <> ''").select("word", odds.alias("odds")).where(F.col("odds") >= log_odds).orderBy(F.desc("odds"), "word").limit(most)
    return {r["word"]: r["odds"] for r in top.collect()}


def fit(documents: DataFrame, labels: DataFrame, sample_rows: int = 10_000, least: int = 4, most_words: int = 4000, log_odds: float = 2.3) -> Model:
    """Learns typical words from some folds of labelled rows, trees and calibration from the others."""
    small_batches(documents.sparkSession)
    rows = training_rows(documents, labels, sample_rows)
    typical = typical_words(rows.where("fold = 1"), least, most_words, log_odds)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        facts = WordFacts(typical)
        for batch in by_bytes(batches, "text", 1 << 20):
            x = facts.features(texts(batch))
            columns = [batch.column("fold"), pa.array([int(t > 0) for t in batch.column("toxic").to_pylist()], pa.int32()), pa.array(x.tolist(), pa.list_(pa.float64())), pa.array([least_shingle(t) for t in texts(batch)], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["fold", "toxic", "x", "cluster"])

    found = rows.where("fold <> 1").mapInArrow(measure, "fold int, toxic int, x array<double>, cluster long").toPandas()  # bounded by sample_rows
    found = found.assign(key=found["x"].map(tuple)).sort_values(["fold", "key", "toxic", "cluster"])
    x, y = np.array(found["x"].tolist(), float).reshape(len(found), len(FEATURES)), found["toxic"].to_numpy(float)
    share = float(y.mean()) if len(y) else 0.0
    if len(set(y)) < 2:
        return Model(typical, None, None, share)
    return Model(typical, Boosted(x, y), Isotonic(crossed_margins(x, y, found["cluster"].to_numpy()), y), share)


def least_shingle(text: str) -> int:
    """The smallest hash of five words in a row; copies share it, and near copies of similarity 0.8 do in four of five cases."""
    words = text.split()
    return min((zlib.crc32(" ".join(words[i : i + 5]).encode()) for i in range(max(1, len(words) - 4))))


def crossed_margins(x: np.ndarray, y: np.ndarray, cluster: np.ndarray, parts: int = 3) -> np.ndarray:
    """The margin of each row by trees that didn't learn from its part; copies of a text, and nearly all near copies, are in one part.

    Clusters with toxic rows are dealt over the parts first. Where there is only one cluster, its rows
    get the margins of trees of their own.
    """
    ids, place = np.unique(cluster, return_inverse=True)
    order = np.lexsort((ids, np.bincount(place, y) == 0))
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    part = rank[place] % parts
    if len(ids) == 1:
        return Boosted(x, y).margin(x)
    out = np.empty(len(y))
    for p in np.unique(part):
        out[part == p] = Boosted(x[part != p], y[part != p]).margin(x[part == p])
    return out


def score_batches(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    facts = WordFacts(model.typical)
    for batch in by_bytes(batches, "text", 1 << 20):
        yield batch, model.scores(facts.features(texts(batch)))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every document."""
    held = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, scores in score_batches(batches, held.value):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def without_toxic(documents: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The rows that score below `limit`, with all their columns as they are."""
    held = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, scores in score_batches(batches, held.value):
            yield batch.filter(pa.array(scores < limit))

    return mapped_rows(documents, run)
