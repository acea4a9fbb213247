"""Alignment of two tokenizers against a comparison of all byte ranges, token by token."""

import hashlib
import random
from bisect import bisect_left
from collections import Counter
from functools import lru_cache
from itertools import accumulate

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

pytest.importorskip("gleaner.llm.alignment")
from gleaner.llm import alignment, bpe, queries
from gleaner.llm.common import staged

NAMES = ("byte_bpe_50k.json", "piece_bpe_32k.model")
SIZES = (50257, 32000)
SF = "/root/testdata/sf0.001"
ODD = ["", None, " ", "a", "  two  spaces ", "\n\nline\tand\r\n", "<s>x</s> <unk> <0x41>", "<|endoftext|>", "▁mark", "ﬁ ｆｕｌｌ é é", "😀👍🏽 ok", "nul\0nul", "aaaa" * 50, "​zero", "Straße größer ñandú", "日本語のテキスト", "x" * 3000]


@lru_cache(1)
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path(NAMES[0]))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(NAMES[1]))


LETTERS = {x: i for i, x in enumerate(bpe.byte_letters())}


def plain_tokens(text):
    """Ids and byte ranges of both sides by the libraries themselves."""
    none = ([], []), ([], [])
    if not text:
        return none
    a, b = libraries()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    parts_a = [bytes(LETTERS[c] for c in a.id_to_token(i)) for i in ids_a]
    parts_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if not b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
        return none
    return [(ids, [(e - len(p), e) for p, e in zip(parts, accumulate(map(len, parts)), strict=True)]) for ids, parts in ((ids_a, parts_a), (ids_b, parts_b))]


def plain_rows(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, digest) of each text."""
    each, count = [], Counter()
    for text in texts:
        (a, at_a), (b, at_b) = plain_tokens(text)
        links, first = [], 0
        for i, (start, end) in enumerate(at_a):
            while at_b[first][1] <= start:
                first += 1
            k = first
            while k < len(b) and at_b[k][0] < end:
                links.append((a[i], b[k]))
                k += 1
        ends = sorted({e for _, e in at_a} & {e for _, e in at_b})
        sides = [[[] for _ in ends] for _ in range(2)]
        for side, ids, at in ((sides[0], a, at_a), (sides[1], b, at_b)):
            for token, (_, end) in zip(ids, at, strict=True):
                side[bisect_left(ends, end)].append(str(token))
        groups = [",".join(x) + "|" + ",".join(y) for x, y in zip(*sides, strict=True)]
        each.append((a, b, groups, links))
        count.update(set(links))
    most = Counter()
    for (i, _), n in count.items():
        most[i] = max(most[i], n)
    return [(len(a), len(b), len(g), len(x), sum(count[p] == most[p[0]] for p in x), sum(count[p] for p in x), hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for a, b, g, x in each]


def found_rows(pairs, counts, **bounds):
    rows = alignment.with_pair_counts(pairs, counts, *SIZES, **bounds).collect()
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, hashlib.sha256(r.groups.encode()).hexdigest() if r.n_a else "") for r in rows}


def random_text(chance):
    words = ["the", "Token", "größe", "naïve", "12345", "don't", "  ", "\n", "😀", "foo_bar", "▁", "ÀÉ", "xyzzyqq", "…", "日本", "é", ".,;", "\t\t"]
    return " ".join(chance.choice(words) for _ in range(chance.randrange(1, 30))) + chance.choice(["", " ", "\n"])


def test_ranges_and_counts_equal_a_comparison_token_by_token(spark):
    chance = random.Random(5)
    texts = ODD + [random_text(chance) for _ in range(150)] + ["the same text, twice"] * 2
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pairs = staged(alignment.token_pairs(documents, *NAMES))
    counts = alignment.pair_counts(pairs, *SIZES)
    wanted = dict(enumerate(plain_rows(texts)))
    assert found_rows(pairs, counts) == wanted
    assert wanted[texts.index("▁mark")] == (0, 0, 0, 0, 0, 0, "")
    for most in (0, 7, 100):  # counts that are joined, beside those that are looked up
        assert found_rows(pairs, counts, most=most) == wanted


def test_counts_are_handed_on_in_parts(spark, monkeypatch):
    documents = spark.createDataFrame([(i, random_text(random.Random(i))) for i in range(40)], "doc_id long, text string")
    pairs = staged(alignment.token_pairs(documents, *NAMES))
    whole = sorted(map(tuple, alignment.pair_counts(pairs, *SIZES).collect()))
    held = alignment.PAIRS_HELD
    try:
        alignment.PAIRS_HELD = 3
        assert sorted(map(tuple, alignment.pair_counts(pairs.repartition(3), *SIZES).collect())) == whole
    finally:
        alignment.PAIRS_HELD = held
    assert sum(n for _, n, _ in whole) and max(n for _, n, _ in whole) > 5


def test_query_equals_the_plain_comparison(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    wanted = dict(zip([r.doc_id for r in rows], plain_rows([r.text for r in rows]), strict=True))
    got = queries.QUERIES["op11_alignment"](spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got.collect()} == wanted


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, codes string")
    pairs = staged(alignment.token_pairs(empty, *NAMES))
    assert alignment.with_pair_counts(pairs, alignment.pair_counts(pairs, *SIZES), *SIZES).count() == 0
    rows = spark.createDataFrame([(None, "a b", 1, "x"), (None, "a b", 2, "y"), (3, None, 3, "z")], "doc_id long, text string, n_a int, codes string")
    pairs = staged(alignment.token_pairs(rows, *NAMES))
    for most in (0, 10):
        got = sorted(alignment.with_pair_counts(pairs, alignment.pair_counts(pairs, *SIZES), *SIZES, most=most).select("n_a", "n_links", "count_sum").collect())
        assert got == [(0, 0, 0), (2, 2, 4), (2, 2, 4)]


def test_code_type_grows_with_the_vocabularies():
    assert alignment.code_type(*SIZES) == "<u4" and alignment.code_type(1 << 17, 1 << 16) == "<u8"
