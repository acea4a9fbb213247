"""Pairwise ranking: features counted one by one, weights at the optimum, held-out accuracy, odd rows."""

import collections
import random
import zlib

import numpy as np
import pytest

pytest.importorskip("gleaner.llm.ranking")
from gleaner.llm import queries, ranking

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def plain_features(text):
    """The same features, counted word by word."""
    words, chars = text.split(), [c for c in text if not c.isspace()]
    if not words:
        return [0.0] * len(ranking.FEATURES)

    def sign(c):
        return not (c.isalpha() or c.isdigit() or c in ranking.MARKS) and ord(c) < ranking.LOOKED_UP

    def lowered(w):
        return "".join(c.lower() if len(c.lower()) == 1 else c for c in w)

    low = [lowered(w) for w in words]
    runs = list(zip(low, low[1:], low[2:], strict=False))
    lines = [x.split() for x in text.split("\n") if x.split()]
    folded = [tuple(map(lowered, x)) for x in lines]
    capital = [sum(c.isupper() for c in w) for w in words]
    letters = [sum(c.isalpha() or ord(c) >= ranking.LOOKED_UP or c.islower() or c.isupper() for c in w) for w in words]
    shares = [sum(c.isupper() for c in chars), sum(c.isdigit() and not c.isalpha() for c in chars), sum(c in ranking.MARKS for c in chars), sum(map(sign, chars)), chars.count("|"), chars.count("!")]
    by_word = [
        sum(len(w) > 14 for w in words), sum(len(w) <= 3 for w in words), sum(u == k and u > 1 for u, k in zip(capital, letters, strict=True)), sum(w[-1] in ranking.ENDS for w in words), sum(any(map(sign, w)) for w in words),
        sum(not k for k in letters), sum(a == b for a, b in zip(low, low[1:], strict=False)), len(low) - len(set(low)), max(collections.Counter(low).values()),
    ]
    rates = [x / len(chars) for x in shares] + [x / len(words) for x in by_word] + [(len(runs) - len(set(runs))) / max(len(runs), 1), (len(lines) - len(set(folded))) / len(lines), len(lines) / len(words)]
    return [np.log1p(50 * x) for x in rates] + [np.log1p(sum(map(len, words)) / len(words)), np.log1p(len(words))]


def test_features_equal_plain_counts():
    chance = random.Random(2)
    bits = ["The", "the", "AND", "x", "über", "STRASSE", "don't", "###", "a|b", "12", "1,5", "wow!!", "end.", "…", "日本", "😀", "\n", "\n\n", "\t", "pneumonoultramicroscopic", "¿qué?", "$$$", "İ"]
    many = ["", " \n ", "one", "one\n", "a a a", *(" ".join(chance.choice(bits) for _ in range(chance.randrange(1, 60))) for _ in range(200)), ""]
    got = ranking.features(many)
    for text, row in zip(many, got, strict=True):
        assert np.allclose(row, plain_features(text)), text
    alone = np.concatenate([ranking.features([x]) for x in many])
    assert np.array_equal(alone, got)  # neighbours in a batch change nothing


def test_weights_are_those_of_the_likeliest_preferences():
    chance = np.random.default_rng(4)
    x = chance.normal(size=(400, 3))
    wanted = np.array([2.0, -1.0, 0.0])
    a, b = chance.integers(0, 400, 6000), chance.integers(0, 400, 6000)
    won = chance.random(6000) < 1 / (1 + np.exp(-(x[a] - x[b]) @ wanted))
    differences = np.where(won[:, None], x[a] - x[b], x[b] - x[a])
    w = ranking.bradley_terry(differences, 1e-6)
    assert np.abs(w - wanted).max() < 0.2
    p = 1 / (1 + np.exp(differences @ w))
    assert np.abs(-(differences * p[:, None]).mean(axis=0) + 1e-6 * w).max() < 1e-6


def test_pairs_meet_every_row():
    good, bad = np.arange(10), np.arange(10, 13)
    better, worse = ranking.preference_pairs(good, bad, 4)
    assert len(better) == 40 and collections.Counter(better.tolist()) == dict.fromkeys(range(10), 4) and set(worse.tolist()) == {10, 11, 12}
    worse, better = ranking.preference_pairs(bad, good, 4)
    assert set(worse.tolist()) == {10, 11, 12} and set(better.tolist()) == set(range(10))


def test_threshold_passes_as_many_as_are_good():
    chance = np.random.default_rng(6)
    good = chance.random(900) < 0.8
    x = np.stack([chance.normal(size=900) + 3 * good, chance.normal(size=900), np.ones(900)], axis=1)
    apart = np.arange(900) % 3 == 0
    model = ranking.learned(x, good, apart, 0.7, 4, 1e-4)
    scores = model.scores(x)
    assert (scores[apart] >= 0.7).sum() == good[apart].sum() and ((scores >= 0.7) == good).mean() > 0.85
    order = np.argsort(model.strength(x))
    assert (np.diff(scores[order]) >= 0).all() and scores.min() >= 0 and scores.max() <= 1


def test_every_labelled_row_is_learned_from(spark):
    chance = np.random.default_rng(8)
    n = 46_000
    good = chance.random(n) < 0.7
    fold = np.array([zlib.crc32(str(i).encode()) % 4 for i in range(n)])
    many = [" ".join(("Bad##" if not g and chance.random() < 0.2 else "word") + "x" * int(k) + "1" * int(k * k % 11) for k in chance.integers(0, 40, chance.integers(5, 20))) for g in good]
    documents = spark.createDataFrame([(i, t) for i, t in enumerate(many)], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, int(g)) for i, g in enumerate(good)], "doc_id long, quality int")
    model = ranking.fit(documents, labels)
    x, taught, judged = ranking.features(many), fold < 2, fold == 3
    assert (fold != 2).sum() > 34_000 and np.allclose(model.middle, x[taught].mean(axis=0), atol=1e-8) and np.allclose(model.scale, np.maximum(x[taught].std(axis=0), 1 - x.any(axis=0)), atol=1e-6)
    strengths, k = np.sort(model.strength(x[judged])), int((~good[judged]).sum())
    assert model.threshold == (strengths[k - 1] + strengths[k]) / 2 and strengths[k - 1] < strengths[k]
    assert (model.scores(x[judged]) >= 0.7).sum() == good[judged].sum()
    # In one block the tables give what the rows give in memory; blocks of 2,000 give nearly the same.
    order = np.lexsort(x.T)
    order = order[fold[order] != 2]
    wanted = ranking.learned(x[order], good[order], fold[order] == 3, 0.7, 4, 1e-4)
    one = ranking.fit(documents, labels, rows_each=n)
    assert np.allclose(one.weights, wanted.weights, atol=1e-6) and abs(one.threshold - wanted.threshold) < 1e-5
    assert np.corrcoef(model.strength(x), wanted.strength(x))[0, 1] > 0.999


def test_blocks_hold_every_row_and_share_rare_ones(spark):
    chance = np.random.default_rng(9)
    d = len(ranking.FEATURES)
    x = chance.random((3000, d))
    model = ranking.Model(np.zeros(d), np.ones(d), np.zeros(d), 0.0, 0.7, 0.5)
    for bad, wanted in ((3, 15 * 3), (1200, 1500)):
        rows = spark.createDataFrame([(i, i >= bad, row) for i, row in enumerate(x.tolist())], "doc_id long, good boolean, x array<double>")
        blocks = [tuple(np.frombuffer(b).reshape(-1, d) for b in r) for r in ranking.dealt(rows, 3000 - bad, bad, model, (3000 - bad) // 15).collect()]
        assert len(blocks) == 15 and all(len(g) and len(b) for g, b in blocks)
        assert sorted(np.concatenate([g for g, _ in blocks]).tolist()) == sorted(x[bad:].tolist())
        shared = collections.Counter(map(tuple, np.concatenate([b for _, b in blocks]).tolist()))
        assert set(shared) == set(map(tuple, x[:bad].tolist())) and wanted <= shared.total() < 2 * wanted + bad


def test_quantile_is_exact(spark):
    chance = np.random.default_rng(10)
    d = len(ranking.FEATURES)
    x = np.round(chance.normal(size=(500, d)), 1)
    x[100:300] = x[7]
    weights = np.where(np.arange(d) < 2, 1.0, 0.0)
    model = ranking.Model(np.zeros(d), np.ones(d), weights, 0.0, 0.7, 0.5)
    strengths = np.sort(model.strength(x))
    rows = spark.createDataFrame([(row,) for row in x.tolist()], "x array<double>")
    same = int(np.searchsorted(strengths, model.strength(x[7:8])[0]))
    for k in (1, same, same + 1, same + 200, 499):
        assert ranking.neighbours(rows, model, k) == (strengths[k - 1], strengths[k])


def test_held_out_accuracy(spark):
    got = queries.QUERIES["op12_quality_ranking"](spark, LARGER).toPandas().set_index("doc_id")
    documents = spark.read.parquet(f"{LARGER}/documents.parquet")
    assert len(got) == documents.count() and got["score"].between(0, 1).all() and ((got["score"] >= 0.7) == (got["predicted"] == 1)).all()
    assert all(held == (zlib.crc32(str(i).encode()) % 4 == 2) for i, held in got["held_out"].items())
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").toPandas().set_index("doc_id").join(got)
    held = labels[labels["held_out"]]
    assert len(held) > 60 and (held["predicted"] == held["quality"]).mean() > 0.97


def test_held_out_labels_and_other_columns_change_nothing(spark):
    documents, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    first = ranking.score(documents, ranking.fit(documents, labels)).toPandas().sort_values("doc_id")
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(string(doc_id) AS binary)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    other = documents.selectExpr("doc_id", "text", "'xx' AS lang", "'y' AS source", "1 AS score", "'a' AS fold", "2 AS good", "3 AS quality").repartition(5)
    again = ranking.score(other, ranking.fit(other, turned.repartition(3))).toPandas().sort_values("doc_id")
    assert first["doc_id"].tolist() == again["doc_id"].tolist() and np.array_equal(first["score"], again["score"])


def test_odd_rows_and_labels(spark):
    schema = "doc_id long, text string, score string, x int"
    rows = [(1, "A good text with words.", "s", 1), (2, "BAD ### BAD ### BAD ###", None, 2), (3, None, None, 3), (4, "", None, 4), (None, "no id", None, 5), (1, "A good text with words.", "s", 1), (5, "long " * 100_000, None, 6)]
    documents = spark.createDataFrame(rows, schema)
    for labels, wanted in (([], 0.0), ([(1, 1)], 1.0), ([(1, None), (None, 1), (77, 0)], 0.0)):
        model = ranking.fit(documents, spark.createDataFrame(labels, "doc_id long, quality int"))
        assert {r.score for r in ranking.score(documents, model).collect()} == {wanted}
    labels = spark.createDataFrame([(i, q) for i in (1, 2, 3, 5) for q in ((1,) if i == 1 else (0, 1))], "doc_id long, quality int")
    model = ranking.fit(documents, labels)
    got = [(r.doc_id, r.score) for r in ranking.score(documents, model).collect()]
    scores = dict(got)
    assert len(got) == 7 and scores[3] == scores[4] == 0 and scores[1] > scores[2] and len({s for i, s in got if i == 1}) == 1
    kept = ranking.without_poor(documents, model)
    assert kept.columns == documents.columns and {r.doc_id for r in kept.collect()} == {i for i, s in got if s >= 0.7}
    assert ranking.score(documents.limit(0), ranking.fit(documents.limit(0), labels)).count() == 0
