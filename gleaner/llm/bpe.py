"""BPE encoding and decoding in batched numpy merge rounds.

Texts are cut at white space. A cache holds the ids of words seen before; new words of a batch are
normalised, cut into pieces, and merged together: the symbols of all pieces stand in one flat array,
and each round finds the pair of lowest rank of every piece by binary search over sorted pair keys.

Null and empty texts have no ids. Repeated rows are encoded alike; further columns are not looked at.
The strings of special tokens in a text become their ids, as the vocabulary's own library does. Words
with code points on which versions of Unicode differ are normalised and cut by that library.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import by_bytes, texts

# White space and pieces as the tokenizer file states them.
SPACE = "\t-\r \x85\xa0  -     　"
PIECES = rf"\n|'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACE}\p{{L}}\p{{N}}]+"
#: The same for texts of code points up to 255, for Python's faster re.
PIECES_LATIN = "\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿA-ZÀ-ÖØ-Þ]+|[0-9²³¹¼½¾]|[^\t-\r \x85\xa0a-zªµºß-öø-ÿA-ZÀ-ÖØ-Þ0-9²³¹¼½¾]+"
NEVER = np.int64(1 << 40)


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = (b for b in range(256) if b not in set(shown))
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class Vocabulary:
    """Vocabulary and merges of a byte-level BPE file whose last letters of a word carry a suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        ids, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.size = max([*ids.values(), *self.special.values()]) + 1
        self.names = [""] * self.size
        for name, i in [*ids.items(), *self.special.items()]:
            self.names[i] = name
        letters = byte_letters()
        self.inner = np.array([ids[x] for x in letters], np.int64)
        self.last = np.array([ids[x + suffix] for x in letters], np.int64)
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        into = np.array([ids[a + b] for a, b in pairs], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.into = keys[order], order.astype(np.int64), into[order]
        # If no merge of a token ranks before one that makes it, all places of the lowest pair may merge at once.
        made = np.full(self.size, -1, np.int64)
        np.maximum.at(made, into, np.arange(len(into)))
        self.at_once = bool((np.maximum(made[left], made[right]) < np.arange(len(into))).all())
        self.odd = OddWords(path)

    def merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after another, and how many each has."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        symbols, ends = self.inner[raw], np.cumsum(sizes)
        symbols[ends - 1] = self.last[raw[ends - 1]]
        owner = np.repeat(np.arange(len(pieces)), sizes)
        done_symbols, done_owner = [], []
        while len(symbols):
            pair = symbols[:-1] * self.size + symbols[1:]
            place = np.searchsorted(self.keys, pair)
            place[place == len(self.keys)] = 0
            found = (self.keys[place] == pair) & (owner[:-1] == owner[1:])
            rank = np.append(np.where(found, self.ranks[place], NEVER), NEVER)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lowest = np.minimum.reduceat(rank, starts)
            counts = np.diff(np.append(starts, len(symbols)))
            lowest = np.repeat(lowest, counts)
            over = lowest == NEVER
            done_symbols.append(symbols[over])
            done_owner.append(owner[over])
            hit = (rank == lowest) & ~over
            at = np.flatnonzero(hit)
            if self.at_once:  # of a run such as aaa, every second place
                run = np.flatnonzero(np.append(True, np.diff(at) != 1)[: len(at)])
                nth = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
                at = at[nth % 2 == 0]
            else:
                at = at[np.append(True, owner[at[1:]] != owner[at[:-1]])[: len(at)]]
            symbols[at] = self.into[place[at]]
            keep = ~over
            keep[at + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        owner, flat = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (done_owner, done_symbols))
        order = np.argsort(owner, kind="stable")
        return flat[order], np.bincount(owner, minlength=len(pieces))

    def encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words without white space, one after another, and how many each has."""
        return encoded_pieces(words, self.merged, self.odd)


@lru_cache(1)
def odd_letters() -> re.Pattern:
    """Code points that versions of Unicode class or order differently: unassigned ones, and marks beyond the common ones."""
    odd = [c for c in range(0x370, 0x110000) if unicodedata.category(chr(c)) in ("Cn", "Mn")]
    starts = [c for c, before in zip(odd, [-1, *odd], strict=False) if c != before + 1]
    ends = [c for c, after in zip(odd, [*odd[1:], -1], strict=True) if after != c + 1]
    return re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends, strict=True)) + "]")


class OddWords:
    """Normalises and cuts the few words with such code points by the vocabulary's own library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        self.normalizer, self.cutter = library.normalizer, library.pre_tokenizer
        self.bytes = {x: b for b, x in enumerate(byte_letters())}

    def __call__(self, word: str) -> list[bytes]:
        return [bytes(map(self.bytes.__getitem__, piece)) for piece, _ in self.cutter.pre_tokenize_str(self.normalizer.normalize_str(word))]


def encoded_pieces(words: list[str], encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], odd_pieces: Callable[[str], list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Normalises words, cuts them into pieces, and encodes each different piece once."""
    bulk = "\n".join(words)
    latin = bulk.isascii() or max(bulk) <= "\xff"
    if not latin:
        odd = np.array([bool(odd_letters().search(w)) for w in words]) if odd_letters().search(bulk) else np.zeros(0, bool)
        if odd.any():
            flat, sizes = encoded_pieces([w for w, o in zip(words, odd.tolist(), strict=True) if not o], encode, odd_pieces)
            cut = [odd_pieces(w) for w, o in zip(words, odd.tolist(), strict=True) if o]
            own, lengths = encode([x for pieces in cut for x in pieces])
            parts = np.array([len(x) for x in cut], np.int64)
            own_sizes = np.diff(np.append(0, np.append(0, np.cumsum(lengths))[np.cumsum(parts)]))
            sizes = np.concatenate([sizes, own_sizes])
            order = np.empty(len(words), np.int64)
            order[np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])] = np.arange(len(words))
            return gathered(np.concatenate([flat, own]), np.cumsum(sizes) - sizes, sizes, order)
        bulk = unicodedata.normalize("NFC", bulk).replace("Σ", "σ")
    bulk = bulk.lower()
    latin = latin or bulk.isascii()
    found = re.findall(PIECES_LATIN, bulk) if latin else regex.findall(PIECES, bulk)
    index = Numbers()
    codes = np.fromiter(map(index.__getitem__, found), np.int64, len(found))
    line = index.get("\n", -1)
    breaks = np.flatnonzero(codes == line)
    word = np.zeros(len(codes), np.int64)
    word[breaks] = 1
    word = np.cumsum(word)
    word, codes = np.delete(word, breaks), np.delete(codes, breaks)
    names = list(index)
    if line >= 0:
        names.pop(line)
        codes = codes - (codes > line)
    flat, sizes = encode([x.encode() for x in names])
    ids, lengths = gathered(flat, np.cumsum(sizes) - sizes, sizes, codes)
    return ids, np.bincount(word, weights=lengths, minlength=len(words)).astype(np.int64)


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices of `flat` that `codes` names, one after another, and their lengths."""
    lengths = sizes[codes]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(starts[codes] - (ends - lengths), lengths)], lengths


class Numbers(dict):
    """Numbers new keys as they come."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


class WordCache:
    """Ids of words seen before.

    Beyond `limit` words, or `most_chars` code points of them, only words that came again stay, the
    most frequent half at most, so that memory is bounded by bytes and frequent words are encoded once.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], special: dict[str, int], limit: int = 500_000, most_chars: int = 16 << 20):
        self.encode, self.special, self.limit, self.most_chars = encode, special, limit, most_chars
        self.cut = re.compile("|".join(map(re.escape, special))) if special else None
        self.clear()

    def clear(self) -> None:
        self.index = Numbers((x, i) for i, x in enumerate(self.special))
        self.flat, self.used, self.chars = np.zeros(1 << 16, np.int32), len(self.special), 0
        self.flat[: self.used] = list(self.special.values())
        self.starts = np.arange(self.used, dtype=np.int64)
        self.sizes = np.ones(self.used, np.int64)
        self.seen = np.zeros(self.used, np.int64)

    def trim(self) -> None:
        """Forgets words that came once, and of the others all but the most frequent."""
        first = len(self.special)
        stay = first + np.flatnonzero(self.seen[first:] > 1)
        stay = np.sort(stay[np.argsort(-self.seen[stay], kind="stable")][: self.limit // 2])
        words = list(self.index)
        kept, flat, starts, sizes = [words[i] for i in stay.tolist()], self.flat, self.starts, self.sizes
        self.clear()
        if sum(map(len, kept)) > self.most_chars // 2:
            return
        for word in kept:
            self.index[word]
        self.add(kept, *gathered(flat, starts, sizes, stay))

    def add(self, words: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
        """Stores the ids of words that have got their numbers."""
        if self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(max(len(flat), self.used), np.int32)])
        self.flat[self.used : self.used + len(flat)] = flat
        self.starts = np.concatenate([self.starts, self.used + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.seen = np.concatenate([self.seen, np.zeros(len(words), np.int64)])
        self.used += len(flat)
        self.chars += sum(map(len, words))

    def words(self, text: str) -> list[str]:
        if self.cut and "<" in text:
            text = self.cut.sub(lambda m: f" {m[0]} ", text)
        if re.search("[\x1c-\x1f]", text):  # str.split takes these for white space
            return [x for x in re.split(f"[{SPACE}]+", text) if x]
        return text.split()

    def ids(self, many: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each has."""
        if len(self.index) > self.limit or self.chars > self.most_chars:
            self.trim()
        known, codes, counts = len(self.index), [], []
        for text in many:
            found = self.words(text)
            counts.append(len(found))
            codes.append(np.fromiter(map(self.index.__getitem__, found), np.int64, len(found)))
        if len(self.index) > known:
            new = list(islice(reversed(self.index), len(self.index) - known))[::-1]
            self.add(new, *self.encode(new))
        codes = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        self.seen += np.bincount(codes, minlength=len(self.seen))
        flat, lengths = gathered(self.flat, self.starts, self.sizes, codes)
        ends = np.append(0, np.cumsum(lengths))[np.append(0, np.cumsum(counts)).astype(np.int64)]
        return flat, np.diff(ends)


def vocabulary_path(path: str | None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(2)
def word_cache(path: str) -> WordCache:
    found = vocabulary(path)
    return WordCache(found.encoded, found.special)


def encode_batches(batches: Iterator[pa.RecordBatch], path: str | None = None) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (doc_id, ids)."""
    cache = word_cache(vocabulary_path(path))
    for batch in by_bytes(batches, "text"):
        flat, sizes = cache.ids(texts(batch))
        offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))], ["doc_id", "ids"])


def decode_batches(batches: Iterator[pa.RecordBatch], path: str | None = None) -> Iterator[pa.RecordBatch]:
    """(doc_id, ids) to (doc_id, ids, decoded): the names of the tokens, joined by spaces, special ones too."""
    names = vocabulary(vocabulary_path(path)).names
    for batch in batches:
        ids = batch.column("ids")
        flat, ends = ids.flatten().to_numpy(), np.append(0, np.cumsum(np.diff(ids.offsets.to_numpy())))
        decoded = [" ".join(map(names.__getitem__, flat[a:b].tolist())) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])


def encode(documents: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) of every document's whole text."""
    return documents.select("doc_id", "text").mapInArrow(lambda it: encode_batches(it, path), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, decoded) of every row of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in decode_batches(batches, path):
            yield batch.select(["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded string")


def round_trip_digests(documents: DataFrame, path: str | None = None) -> DataFrame:
    """Encodes and decodes in one pass and keeps digests of both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in decode_batches(encode_batches(batches, path), path):
            ids = batch.column("ids")
            flat, sizes = ids.flatten().to_numpy().astype("<u4"), np.diff(ids.offsets.to_numpy())
            ends = np.append(0, np.cumsum(sizes)).tolist()
            digests = [hashlib.sha256(flat[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            decoded = [hashlib.sha256(x.encode()).hexdigest() for x in batch.column("decoded").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests), pa.array(decoded)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
