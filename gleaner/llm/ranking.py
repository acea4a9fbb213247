"""Quality scores by Bradley-Terry pairwise ranking over dense features of texts.

Features are measured over whole texts: kinds of letters and signs, lengths of words, and how often
words, runs of three words and lines repeat. A labelled good document is preferred to a labelled bad one;
the weights of the features are those under which the differences of two documents' features make the
preferences likeliest (logistic loss with a small ridge, by Newton's method). Each document of the larger
label meets a few of the other, dealt by chance. The threshold is a quantile of the scores of labelled
rows that took no part in the fit: as many of them pass as are labelled good. The score is the logistic
function of the distance to that threshold, such that the threshold itself scores `at`.

Every labelled row outside the held-out fold is learned from, at any number of them: two folds give the
weights, the third the threshold. Rows are dealt to blocks by a hash of the id, each of some rows of the
larger label and, where the other is rare, of repeated rows of that; documents meet within a block. Each of
Newton's steps is a pass that sums slopes and second derivatives over all blocks, exactly, so that the
order of rows and partitions changes nothing. The quantile is exact too, by counts of its digits.

Every row is scored, and neither id, language, source nor label enters a score. Null texts, empty ones,
and others without a word score 0. A document with several labels is bad if one says so; of rows with one
id, the one whose features come first in order is learned from. Texts that are equal score equally. Without
labels of both kinds every score is the share of good labels, 0 without any; an empty table gives no rows.
Columns other than `doc_id` and `text` (and `quality` of the labels) aren't looked at. `measured`, `score`
and what learns bound the Arrow batches of the session, unless it has a bound of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, mapped_rows, mixed, small_batches, staged, texts

# Kinds of characters, and signs of ordinary prose.
SPACE, LOWER, UPPER, LETTER, DIGIT, MARK, SIGN = range(7)
MARKS = ".,;:!?'\"-()…–—«»¿¡„“”‘’"
ENDS = ".!?…"
#: Code points that are looked up; those above count as letters.
LOOKED_UP = 0x3000
BY_SIGNS = ["upper", "digits", "marks", "signs", "bars", "shouts"]
BY_WORDS = ["long", "short", "capitals", "ended", "signed", "no_letters", "doubled", "again", "commonest", "runs_again"]
BY_LINES = ["lines_again", "lines_per_word"]
FEATURES = [*BY_SIGNS, *BY_WORDS, *BY_LINES, "word_length", "words"]


@lru_cache(1)
def characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point that is looked up: its kind, its lower case, and bits for a bar, a shout, an end of a sentence."""
    kinds, lower, special = np.full(LOOKED_UP + 1, LETTER, np.uint8), np.arange(LOOKED_UP + 1, dtype=np.uint64), np.zeros(LOOKED_UP + 1, np.uint8)
    for c in range(LOOKED_UP):
        x = chr(c)
        kinds[c] = SPACE if x.isspace() else LOWER if x.islower() else UPPER if x.isupper() else LETTER if x.isalpha() else DIGIT if x.isdigit() else MARK if x in MARKS else SIGN
        lower[c] = ord(x.lower()) if len(x.lower()) == 1 else c
        special[c] = (x == "|") + 2 * (x == "!") + 4 * (x in ENDS)
    return kinds, lower, special


def features(many: list[str]) -> np.ndarray:
    """A row of FEATURES for each text, each number from 0 upwards."""
    n, out = len(many), np.zeros((len(many), len(FEATURES)))
    sizes = np.array([len(x) + 1 for x in many], np.int64)
    points = np.frombuffer("".join(x + "\n" for x in many).encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds, lower, special = characters()
    looked = np.minimum(points, LOOKED_UP)
    kind, bits = kinds[looked], special[looked]
    full = kind != SPACE
    starts = np.flatnonzero(full & ~np.append(False, full[:-1]))
    if not len(starts):
        return out
    ends = np.flatnonzero(full & ~np.append(full[1:], False)) + 1
    length = ends - starts
    doc = np.repeat(np.arange(n), sizes)
    own = doc[starts]
    words = np.bincount(own, minlength=n)

    def by_doc(where: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.bincount(rows[where], minlength=n)

    def in_words(flag: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(flag))
        return total[ends] - total[starts]

    def different(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many different keys each document has, and how often its commonest one occurs."""
        found, first, count = np.unique(mixed(keys ^ mixed(rows.astype(np.uint64) + np.uint64(1))), return_index=True, return_counts=True)
        most = np.zeros(n, np.int64)
        np.maximum.at(most, rows[first], count)
        return np.bincount(rows[first], minlength=n), most

    chars = np.maximum(by_doc(full, doc), 1)
    for i, flag in enumerate([kind == UPPER, kind == DIGIT, kind == MARK, kind == SIGN, (bits & 1) > 0, (bits & 2) > 0]):
        out[:, i] = by_doc(flag, doc) / chars
    # A word's key sums mixed letters and places, a line's those of its words.
    place = np.arange(len(points)) - np.repeat(np.append(starts, len(points)), np.diff(np.append(np.append(0, starts[1:]), [len(points)] * 2)))[: len(points)]
    letters = np.where(points < LOOKED_UP, lower[looked], points.astype(np.uint64))
    keys = np.add.reduceat(np.where(full, mixed(letters + (place.astype(np.uint64) << np.uint64(32))), np.uint64(0)), starts)
    count, upper, signs = in_words(np.isin(kind, (LOWER, UPPER, LETTER))), in_words(kind == UPPER), in_words(kind == SIGN)
    same = np.append(False, keys[1:] == keys[:-1]) & np.append(False, own[1:] == own[:-1])
    for i, flag in enumerate([length > 14, length <= 3, (upper == count) & (upper > 1), (bits[ends - 1] & 4) > 0, signs > 0, count == 0, same]):
        out[:, len(BY_SIGNS) + i] = by_doc(flag, own) / np.maximum(words, 1)
    at = len(BY_SIGNS) + 7
    found, most = different(keys, own)
    out[:, at] = (words - found) / np.maximum(words, 1)
    out[:, at + 1] = most / np.maximum(words, 1)
    inside = np.flatnonzero(own[2:] == own[:-2]) if len(own) > 2 else np.zeros(0, np.int64)
    runs = mixed(keys[inside]) + mixed(keys[inside + 1] + np.uint64(1)) * np.uint64(3) + mixed(keys[inside + 2] + np.uint64(2)) * np.uint64(5)
    all_runs = np.bincount(own[inside], minlength=n)
    out[:, at + 2] = (all_runs - different(runs, own[inside])[0]) / np.maximum(all_runs, 1)
    breaks = np.cumsum(points == 10)[starts]
    heads = np.flatnonzero(np.append(True, breaks[1:] != breaks[:-1]))
    nth = np.arange(len(keys)) - np.repeat(heads, np.diff(np.append(heads, len(keys))))
    lines = np.add.reduceat(mixed(keys + (nth.astype(np.uint64) << np.uint64(40))), heads)
    all_lines = np.bincount(own[heads], minlength=n)
    out[:, at + 3] = (all_lines - different(lines, own[heads])[0]) / np.maximum(all_lines, 1)
    out[:, at + 4] = all_lines / np.maximum(words, 1)
    out[:, :-2] = np.log1p(50 * out[:, :-2])
    out[:, -2] = np.log1p(np.bincount(own, length, n) / np.maximum(words, 1))
    out[:, -1] = np.log1p(words)
    return out


class Model:
    """Weights of standardised features, the threshold of the scores, and what the threshold scores."""

    def __init__(self, middle: np.ndarray, scale: np.ndarray, weights: np.ndarray, threshold: float, at: float, share: float):
        self.middle, self.scale, self.weights, self.threshold, self.at, self.share = middle, scale, weights, threshold, at, share

    def strength(self, x: np.ndarray) -> np.ndarray:
        """The logarithm of a document's strength; differences are the log-odds of being preferred."""
        return (self.standard(x) * self.weights).sum(axis=1)  # row by row: neighbours in a batch don't change the rounding

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.middle) / self.scale, -8, 8)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(x), self.share)
        above = self.strength(x) - self.threshold
        score = 1 / (1 + np.exp(-np.clip(above + np.log(self.at / (1 - self.at)), -700, 700)))
        score = np.where(above >= 0, np.maximum(score, self.at), np.minimum(score, np.nextafter(self.at, 0)))
        return np.where(x[:, -1] > 0, score, 0.0)


def preference_pairs(good: np.ndarray, bad: np.ndarray, partners: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of preferred and other documents: each of the larger side meets `partners` of the other, every row of which is met."""
    larger, smaller = (good, bad) if len(good) >= len(bad) else (bad, good)
    chance = np.random.default_rng(0)
    one = np.tile(larger, partners)
    other = np.concatenate([chance.permutation(smaller) for _ in range(len(one) // len(smaller) + 1)])[: len(one)]
    return (one, other) if larger is good else (other, one)


def pair_sums(differences: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Of rows of differences under the weights `w`: their number, loss, slope and second derivatives, each summed."""
    reach = differences @ w
    p = 1 / (1 + np.exp(np.clip(reach, -700, 700)))  # the chance of the other
    curve = (differences * (p * (1 - p))[:, None]).T @ differences
    return np.concatenate([[len(reach), np.logaddexp(0, -reach).sum()], -(differences * p[:, None]).sum(axis=0), curve.ravel()])


def newton(sums: Callable[[np.ndarray], np.ndarray], d: int, ridge: float, steps: int = 50) -> np.ndarray:
    """The `d` weights of least mean loss; `sums` gives the `pair_sums` of all pairs under some weights, in one pass."""

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        n, loss, rest = (total := sums(w))[0], total[1], total[2:]
        return loss / n + ridge * (w @ w) / 2, rest[:d] / n + ridge * w, rest[d:].reshape(d, d) / n + ridge * np.eye(d)

    w = np.zeros(d)
    now, slope, curve = at(w)
    for _ in range(steps):
        step, size = np.linalg.solve(curve, slope), 1.0
        if slope @ step < 1e-10:  # the rest of the way is one step, of less loss than that
            return w - step
        found = at(w - step)
        while found[0] > now and size > 1e-6:
            size /= 2
            found = at(w - size * step)
        if found[0] > now:
            return w
        w = w - size * step
        now, slope, curve = found
    return w


def bradley_terry(differences: np.ndarray, ridge: float, steps: int = 50) -> np.ndarray:
    """The weights under which rows of differences, preferred less other, are likeliest."""
    return newton(lambda w: pair_sums(differences, w), differences.shape[1], ridge, steps)


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))


def measured(documents: DataFrame) -> DataFrame:
    """(doc_id, x): the features of every row."""
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", 1 << 20):
            x = features(texts(batch))
            ends = pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], ["doc_id", "x"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, x array<double>")


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of features as rows."""
    return (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten().to_numpy().reshape(-1, len(FEATURES))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, apart, good, x) of every labelled document outside the held-out fold; those `apart` are of the third fold."""
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg((F.min("quality") > 0).alias("good"))
    known = known.withColumn("fold", fold(F.col("doc_id"))).where("fold <> 2").select("doc_id", (F.col("fold") == 3).alias("apart"), "good")
    return rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("x").alias("x")).join(known, "doc_id").select("doc_id", "apart", "good", "x")


def exact_sums(rows: DataFrame, part: Callable[[pa.RecordBatch], Iterator[list[int]]]) -> np.ndarray:
    """The sums, by place, of what `part` gives, in units of 2 ** -32: whole numbers, so that no order of rows or batches matters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[int] = []
        for batch in batches:
            for numbers in part(batch):
                total = [a + b for a, b in zip(total, numbers, strict=True)] if total else numbers
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([Decimal(v) for v in total], pa.decimal128(38, 0))], ["place", "total"])

    found = rows.mapInArrow(run, "place int, total decimal(38,0)").groupBy("place").agg(F.sum("total").alias("total"))
    return np.array([int(r["total"]) / 2**32 for r in sorted(found.collect())])  # as many as `part` gives


def spread(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of each feature, in two passes."""

    def mean(number: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        def part(batch: pa.RecordBatch) -> Iterator[list[int]]:
            yield [batch.num_rows << 32, *np.rint(number(matrix(batch.column("x"))) * 2.0**32).astype(np.int64).sum(axis=0).tolist()]

        total = exact_sums(rows.select("x"), part)
        return total[1:] / total[0]

    middle = mean(lambda x: x)
    return middle, np.sqrt(mean(lambda x: (x - middle) ** 2))


def dealt(rows: DataFrame, n_good: int, n_bad: int, model: Model, rows_each: int, least: int = 100) -> DataFrame:
    """(good, bad) of blocks of about `rows_each` rows of the larger label: their standardised features, as matrices.

    Rows of the other label are in one block each, or in so many that a block has about `least` of them; where there
    are fewer in all, each block has all.
    """
    blocks = max(1, max(n_good, n_bad) // rows_each)
    copies = min(blocks, -(-blocks * least // min(n_good, n_bad)))
    mine = F.when(F.col("good") == F.lit(n_good < n_bad), F.lit(copies - 1)).otherwise(F.lit(0))
    first = F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(blocks))
    places = F.transform(F.sequence(F.lit(0), mine), lambda i: F.pmod(first + i, F.lit(blocks)))

    def block(table: pa.Table) -> pa.Table:
        x, good = matrix(table.column("x")), table.column("good").to_numpy()
        order = np.lexsort(x.T)
        z, good = model.standard(x[order]), good[order]
        return pa.table({"good": pa.array([z[good].tobytes()], pa.binary()), "bad": pa.array([z[~good].tobytes()], pa.binary())})

    return rows.select(F.explode(places).alias("block"), "good", "x").groupBy("block").applyInArrow(block, "good binary, bad binary")


def weighed(blocks: DataFrame, d: int, partners: int, ridge: float) -> np.ndarray:
    """The weights under which the preferences within all blocks are likeliest."""

    def sums(w: np.ndarray) -> np.ndarray:
        def part(batch: pa.RecordBatch) -> Iterator[list[int]]:
            for raw in zip(batch.column("good").to_pylist(), batch.column("bad").to_pylist(), strict=True):
                good, bad = (np.frombuffer(b).reshape(-1, d) for b in raw)
                if len(good) and len(bad):
                    better, worse = preference_pairs(np.arange(len(good)), np.arange(len(bad)), partners)
                    yield [int(v) for v in np.rint(pair_sums(good[better] - bad[worse], w) * 2.0**32).tolist()]

        return exact_sums(blocks, part)

    return newton(sums, d, ridge)


def neighbours(rows: DataFrame, model: Model, k: int) -> tuple[float, float]:
    """The strengths at places `k` - 1 and `k` in ascending order of all rows, counted from 0: exact, by counts of 16 bits at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = model.strength(matrix(batch.column("x"))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bits ^ ((bits >> 63) & np.int64((1 << 63) - 1)))], ["key"])  # whole numbers in the same order

    keys = staged(rows.select("x").mapInArrow(run, "key long"))
    low, below, inside = 0, 0, keys
    for shift in (48, 32, 16, 0):
        counts = inside.groupBy(F.shiftright("key", shift).alias("part")).count().collect()  # 65,536 at most
        for low, n in sorted(map(tuple, counts)):
            if below + n >= k:
                break
            below += n
        inside = keys.where(F.shiftright("key", shift) == low)
    high = low if below + n > k else keys.where(F.col("key") > low).agg(F.min("key")).first()[0]
    bits = np.array([low, high], np.int64)
    return tuple((bits ^ ((bits >> 63) & np.int64((1 << 63) - 1))).view(np.float64).tolist())


def fit(documents: DataFrame, labels: DataFrame, at: float = 0.7, partners: int = 4, ridge: float = 1e-4, rows_each: int = 2000) -> Model:
    """Learns weights from two folds of labelled rows, the threshold from the third."""
    return fit_measured(measured(documents), labels, at, partners, ridge, rows_each)


def fit_measured(measured_rows: DataFrame, labels: DataFrame, at: float = 0.7, partners: int = 4, ridge: float = 1e-4, rows_each: int = 2000) -> Model:
    """`fit` from the features of documents; in steps over tables as `learned` does it in memory."""
    small_batches(measured_rows.sparkSession)
    rows = staged(labelled(measured_rows, labels))
    counts = {(r["apart"], r["good"]): r["count"] for r in rows.groupBy("apart", "good").count().collect()}

    def number(good: bool, of: tuple[bool, ...]) -> int:
        return sum(counts.get((a, good), 0) for a in of)

    n_good, n_bad = (number(good, (False, True)) for good in (True, False))
    share = n_good / (n_good + n_bad) if counts else 0.0
    if share in (0.0, 1.0):
        return Model(np.zeros(0), np.ones(0), np.zeros(0), 0.0, at, share)
    folds = {a: (a,) if (a, True) in counts and (a, False) in counts else (False, True) for a in (False, True)}
    taught, judged = (rows.where(F.col("apart").isin(*folds[a])) for a in (False, True))
    middle, scale = spread(taught)
    model = Model(middle, np.where(scale > 1e-9, scale, 1.0), np.zeros(len(middle)), 0.0, at, share)
    blocks = staged(dealt(taught, number(True, folds[False]), number(False, folds[False]), model, rows_each))
    model.weights = weighed(blocks, len(middle), partners, ridge)
    model.threshold = sum(neighbours(judged, model, number(False, folds[True]))) / 2  # the quantile of the share of bad labels
    return model


def learned(x: np.ndarray, good: np.ndarray, apart: np.ndarray, at: float, partners: int, ridge: float) -> Model:
    """A model of rows of features in memory; those `apart` set the threshold, or all if they don't have both labels."""
    share = float(good.mean()) if len(good) else 0.0
    if share in (0.0, 1.0):
        return Model(np.zeros(0), np.ones(0), np.zeros(0), 0.0, at, share)
    taught = ~apart if len(set(good[~apart])) == 2 else np.ones(len(good), bool)
    middle, scale = x[taught].mean(axis=0), x[taught].std(axis=0)
    model = Model(middle, np.where(scale > 1e-9, scale, 1.0), np.zeros(x.shape[1]), 0.0, at, share)
    rows = np.flatnonzero(taught)
    better, worse = preference_pairs(rows[good[rows]], rows[~good[rows]], partners)
    z = np.clip((x - model.middle) / model.scale, -8, 8)
    model.weights = bradley_terry(z[better] - z[worse], ridge)
    judged = apart if len(set(good[apart])) == 2 else np.ones(len(good), bool)
    strengths = np.sort(model.strength(x[judged]))
    k = int((~good[judged]).sum())  # the quantile of the share of bad labels
    model.threshold = float(strengths[k - 1] + strengths[k]) / 2
    return model


def score_batches(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in by_bytes(batches, "text", 1 << 20):
        yield batch, model.scores(features(texts(batch)))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every document."""
    return score_measured(measured(documents), model)


def score_measured(rows: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.scores(matrix(batch.column("x"))), pa.float64())], ["doc_id", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double")


def without_poor(documents: DataFrame, model: Model) -> DataFrame:
    """The rows that score at the threshold or above, with all their columns as they are."""
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, scores in score_batches(batches, model):
            yield batch.filter(pa.array(scores >= model.at))

    return mapped_rows(documents, run)
