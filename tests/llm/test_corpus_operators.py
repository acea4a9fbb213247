"""Operators over the whole corpus against brute force: Jaccard join, toxicity, packing, pipeline."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("gleaner.llm.queries")
from gleaner.llm import common, ngram_join, packing, queries, toxicity

SF = "/root/testdata/sf0.001"


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + min(k, len(words))]) for i in range(max(1, len(words) - k + 1))}


def brute(rows, k, per_cent):
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = {}
    by = {}
    for n, (i, s) in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(n)
    pairs = {(a, b) for v in by.values() for j, b in enumerate(v) for a in v[:j]} if sum(len(v) ** 2 for v in by.values()) < 4e6 else {(a, b) for b in range(len(sets)) for a in range(b)}
    for a, b in pairs:
        (i, s), (j, t) = sets[a], sets[b]
        if s and t and 100 * len(s & t) >= per_cent * len(s | t):
            x, y = find(i), find(j)
            parent[max(x, y)] = min(x, y)
            if s != t:
                links.setdefault(i, set()).add(frozenset(t))
                links.setdefault(j, set()).add(frozenset(s))
    return sorted((i, len(s), find(i), len(links.get(i, ()))) for i, s in sets)


def result(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id", "n_links").collect()))


def near_copies(rnd, groups, most):
    rows = []
    for g in range(groups):
        base = [f"g{g}w{rnd.randint(0, 400)}" for _ in range(rnd.choice([3, 5, 8, 12, 20, 40, 90, 200]))]
        for _ in range(rnd.randint(1, most)):
            words = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 5])):
                words[rnd.randrange(len(words))] = f"e{rnd.randint(0, 10**6)}"
            rows.append(" ".join(words[: len(words) - rnd.choice([0, 0, 0, 1, 3])]))
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("k,per_cent,heavy,groups,most", [(4, 85, 16, 60, 12), (5, 80, 3, 40, 20), (1, 80, 4, 30, 10)])
def test_jaccard_join(spark, k, per_cent, heavy, groups, most):
    rows = near_copies(random.Random(heavy), groups, most)
    shared = " ".join(f"s{i}" for i in range(30))  # a passage that many unrelated texts hold
    rows += [(5000 + i, " ".join(f"u{i}v{j}" for j in range(25)) + " " + shared) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as id", "1 as key", "2 as component")
    assert result(ngram_join.jaccard_components(df, k, per_cent, heavy)) == brute(rows, k, per_cent)


def test_jaccard_join_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rows = near_copies(random.Random(9), 2, 90)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(ngram_join.jaccard_components(df, 4, 85, 4)) == brute(rows, 4, 85)


def test_jaccard_join_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted(map(tuple, docs.select("doc_id", "text").collect()))
    assert result(queries.op2_ngram_join(spark, SF)) == brute(rows, 4, 85)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (4, "A  b"), (4, "A  b"), (None, "a b"), (5, "x " * 30000)], "doc_id long, text string")
    got = ngram_join.jaccard_components(odd, 4, 85).collect()
    assert len(got) == 7 and {(r["doc_id"], r["component_id"]) for r in got} == {(1, 1), (2, 2), (3, 3), (4, 3), (None, None), (5, 5)}
    assert ngram_join.jaccard_components(odd.limit(0)).count() == 0
    assert ngram_join.without_near_duplicates(odd).count() == 5
    # One id with two texts: one is a copy of a smaller id's, the other has a near copy of its own; and a row twice.
    near = [f"n{i}" for i in range(40)]
    rows = [(1, "p q r s t u"), (2, "p q r s t u"), (2, " ".join(near)), (3, " ".join([*near, "more"])), (4, "w x y z"), (4, "w x y z")]
    twice = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as `a.b`", "2 as row", "3 as `drop`")
    assert {(r["doc_id"], r["component_id"]) for r in ngram_join.jaccard_components(twice, 4, 85).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4)}
    left = ngram_join.without_near_duplicates(twice, 4, 85)
    assert left.schema == twice.schema and sorted(r["doc_id"] for r in left.collect()) == [1, 4]


@pytest.mark.parametrize("per_cent", [80, 85])
def test_pigeonhole_keys_lose_no_pair(per_cent):
    """Any two sets that link share a key under their own allocation, whatever spare units they have left."""
    rnd = np.random.default_rng(per_cent)
    for n in [4, 5, 6, 7, 9, 13, 20, 33, 60, 147, 600, 2500]:
        for _ in range(30):
            base = rnd.integers(0, 1 << 63, n, np.uint64)
            drop = int(n * (100 - per_cent) / 100)
            a = np.unique(base[int(rnd.integers(0, drop + 1)) :])
            add = rnd.integers(0, 1 << 63, int(rnd.integers(0, drop + 1)), np.uint64)
            b = np.unique(np.concatenate([base, add]))
            if ngram_join.linked(a, b, per_cent) and len(a) != len(b):
                ka, kb = ({int(x) for _, _, keys, _ in ngram_join.set_keys(s, per_cent) for x in keys} for s in (a, b))
                assert ka & kb


def test_components(spark):
    rnd = random.Random(4)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r["id"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def naive_best_fit(rows, capacity, most):
    bins, out = [], []
    for i, (size, source, cluster) in enumerate(rows):
        rest = size % capacity
        if not rest and size:
            continue
        fits = [b for b in bins if b[0] >= rest and b[1].count(source) < most and (cluster < 0 or cluster not in b[2])]
        room = min((b[0] for b in fits), default=None)
        b = next((b for b in fits if b[0] == room), None)
        if b is None:
            bins.append(b := [capacity, [], set()])
        b[0] -= rest
        b[1].append(source)
        b[2].add(cluster)
        out.append((i, b[0]))
    return out, sorted(b[0] for b in bins)


def test_best_fit_is_tightest(spark):
    rnd = random.Random(3)
    rows = sorted(((rnd.choice([rnd.randint(0, 60), rnd.randint(0, 250)]), rnd.randint(0, 3), rnd.choice([-1, -1, rnd.randint(0, 5)])) for _ in range(400)), reverse=True)
    got = packing.pack_rows(rows, 100, 3)
    room = {}
    for i, piece, b, start, size in got:
        assert start + size <= 100 and room.get(b, 0) == start
        room[b] = start + size
    whole, rooms = naive_best_fit(rows, 100, 3)
    solid = sum(size // 100 for size, _, _ in rows)
    assert sorted(100 - x for x in room.values()) == sorted(rooms + [0] * solid)
    members = {}
    for i, _, b, _, _ in got:
        members.setdefault(b, []).append(rows[i])
    for m in members.values():
        clusters = [c for _, _, c in m if c >= 0]
        assert len(clusters) == len(set(clusters)) and max([s for _, s, _ in m].count(s) for s in range(4)) <= 3


def test_packing_spreads_repeated_rows(spark):
    from pyspark.sql import functions as F

    rows = spark.range(0, 3000, 1, 8).selectExpr("7 as doc_id", "'s' as source", "10 as size")
    packed = packing.best_fit(rows, F.col("size"), F.lit(None).cast("long"), capacity=100, max_per_source=20, shard_rows=200)
    sizes = [r["count"] for r in packed.groupBy("shard").count().collect()]
    assert sum(sizes) == 3000 and len(sizes) >= 14 and max(sizes) < 300


def test_packing_tables(spark):
    got = queries.op8_packing(spark, SF)
    words = {r["doc_id"]: len((r["text"] or "").split()) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sums = {r["doc_id"]: r["n"] for r in got.groupBy("doc_id").agg({"n_tokens": "sum"}).withColumnRenamed("sum(n_tokens)", "n").collect()}
    assert sums == words
    odd = spark.createDataFrame([(1, None, None, None), (None, "a", -5, 1), (2, "a", 10, 1), (2, "a", 10, 1), (3, "b", 9000, 2)], "doc_id long, source string, size long, shard long")
    from pyspark.sql import functions as F

    packed = packing.best_fit(odd, F.col("size"), F.col("shard"))
    assert packed.count() == 7 and packing.best_fit(odd.limit(0), F.col("size"), F.col("shard")).count() == 0


def test_toxicity(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op5_toxicity(spark, sf).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([a == b for a, b in held]) >= 0.95
    model = toxicity.fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    assert model.steps is not None and len(model.steps.x) >= 2  # calibrated on small tables too
    odd = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "you idiot", "x"), (3, "w " * 50000, "x"), (3, "w", "x")], "doc_id long, text string, score string")
    none = toxicity.fit(odd, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert toxicity.score(odd, none).count() == 5 and toxicity.without_toxic(odd, none).count() == 5
    assert toxicity.without_toxic(odd, none).schema == odd.schema


def plain_features(text, typical):
    """Features of one text, word by word."""
    words = text.split()
    if not words:
        return [0.0] * len(toxicity.FEATURES)
    rows = []
    for w in words:
        low, read = toxicity.forms(w)
        odd = low != read and any(c.isalpha() for c in low)
        known = typical.get(low) or typical.get(read) or 0.0
        begins = max([typical.get(read[:n] + "-", 0.0) for n in toxicity.PREFIXES if len(read) >= n], default=0.0)
        letters = sum(map(str.isalpha, w))
        rows.append({
            "fixed": low in toxicity.LEXICON or read in toxicity.LEXICON, "typical": known > 0, "begins": begins > 0, "weight": max(known, begins), "second": read in toxicity.SECOND,
            "capitals": letters > 1 and letters == sum(map(str.isupper, w)), "signs": len(w) - letters, "exclaim": w.count("!"), "spelled": odd, "repeats": any(a == b == c and (a.isalnum() or a == "_") for a, b, c in zip(low, low[1:], low[2:], strict=False)),
        })
    n = len(words)
    hits = [r["fixed"] or r["typical"] or r["begins"] for r in rows]
    near = [h and any(r["second"] for r in rows[max(0, i - 5) : i + 6]) for i, h in enumerate(hits)]
    return [float(sum(r[f] for r in rows)) / n for f in toxicity.SHARES] + [sum(near) / n, max(r["weight"] for r in rows), min(sum(hits), 20), np.log1p(n)]


def test_toxicity_features_and_trees():
    rnd, typical = random.Random(8), {"foo": 2.5, "idio-": 3.0, "bar": 4.0}
    pool = ["you", "IDIOT", "1d10t", "idiotic", "foo", "Foo!", "bar,", "sooo", "b@r", "word", "UND", "du", "!!!", "a.b", "héé", "Sie", "x_y_z"]
    many = [" ".join(rnd.choice(pool) for _ in range(rnd.choice([0, 1, 3, 30, 80]))) for _ in range(120)]
    facts = toxicity.WordFacts(typical, limit=9)
    got = np.concatenate([facts.features(many[i : i + 7]) for i in range(0, len(many), 7)])
    assert np.allclose(got, [plain_features(t, typical) for t in many], atol=1e-6)

    x = np.array([[rnd.randint(0, 6), rnd.random(), 0.0] for _ in range(150)])
    y = np.array([float(a > 3 and b > 0.4 or rnd.random() < 0.1) for a, b, _ in x])
    trees = toxicity.Boosted(x, y, rounds=1, depth=1)
    p = y.mean()
    g, h = p - y, np.full(len(y), p * (1 - p))

    def leaf(own):
        return -g[own].sum() / (h[own].sum() + 1)

    def gain(own):
        return g[own].sum() ** 2 / (h[own].sum() + 1)

    splits = []
    for j in range(3):  # every cut between bins, tried one by one
        for cut in trees.cuts[j]:
            left = x[:, j] <= cut
            if h[left].sum() >= 1 and h[~left].sum() >= 1:
                splits.append((gain(left) + gain(~left), j, cut))
    _, j, cut = max(splits)
    left = x[:, j] <= cut
    want = np.log(p / (1 - p)) + 0.2 * np.where(left, leaf(left), leaf(~left))
    assert np.allclose(trees.margin(x), want)


@pytest.mark.parametrize("n", [8, 60, 600])
def test_toxicity_is_calibrated_at_any_size(n):
    rnd = np.random.default_rng(n)
    x = rnd.random((n, len(toxicity.FEATURES)))
    y = (rnd.random(n) < x[:, 0]).astype(float)
    y[:2] = 0, 1
    model = toxicity.Model({}, toxicity.Boosted(x, y), toxicity.Isotonic(toxicity.crossed_margins(x, y, np.arange(n)), y), 0.5)
    margin, scores = model.trees.margin(x), model.scores(x)
    order = np.argsort(margin, kind="stable")
    assert (np.diff(scores[order]) >= -1e-12).all() and ((scores >= 0.5) == (model.steps(margin) >= 0.5)).all() and abs(scores - model.steps(margin)).max() <= 0.002
    flip = toxicity.Model({}, model.trees, lambda m: np.full(len(m), 0.505), 0.5)
    assert (flip.scores(x) >= 0.5).all()


def test_small_batches(spark):
    """Batches of long texts stay near the bound, and every row arrives; a bound of the session's own stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        common.small_batches(spark)
        rows = spark.range(0, 120, 1, 1).selectExpr("id", "repeat('word ', 40000) AS text")
        sizes = rows.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64()), pa.array([b.nbytes], pa.int64())], ["n", "size"]) for b in batches), "n long, size long").collect()
        assert sum(r["n"] for r in sizes) == 120 and max(r["size"] for r in sizes) <= 2 * common.BATCH_BYTES
        spark.conf.set(key, "1000000")
        common.small_batches(spark)
        assert spark.conf.get(key).startswith("1000000")
    finally:
        spark.conf.set(key, before)


def test_isotonic_rises():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=400)
    y = (rnd.random(400) < 1 / (1 + np.exp(-2 * x))).astype(float)
    steps = toxicity.Isotonic(x, y)
    assert (np.diff(steps.y) > 0).all() and abs(steps(x).mean() - y.mean()) < 0.05


def test_pipeline_stages_on_odd_rows(spark):
    """Nulls, empty and very long texts, repeated rows, clashing names, and an empty table through every stage."""
    import corpus_pipeline

    words = " ".join(f"word{i}" for i in range(60))
    key = "password = abcdefghijkl1234"
    rows = [(1, words, "en", "s", len(words)), (1, words, "en", "s", len(words)), (2, words + " more", None, None, None), (3, None, "en", "s", None), (4, "", "en", "s", 0), (None, words + " other words", "en", "s", 5), (5, " ".join(f"long{i}" for i in range(40_000)), "en", "s", 9), (6, f"é {key} end", "en", "s", 7), (7, f"é {key} end", "en", "s", None)]
    extra = "'q' as quality, 1 as kept, 2 as _k1, 3 as id, 4 as component, 5 as `a.b`, 6 as row, 7 as size, 8 as shard, 9 as score, 10 as spans"
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", *extra.split(", "))
    kept = {"quality rules": [None, 1, 1, 2, 5], "toxicity": None, "n-gram Jaccard join": [None, 1, 3, 4, 5, 6], "secret scans": None}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, SF)
        assert out.schema == df.schema and stage(spark, df.limit(0), SF).count() == 0
        ids = sorted((r["doc_id"] for r in out.select("doc_id").collect()), key=lambda x: (x is not None, x))
        assert ids == (kept[name] or sorted((r[0] for r in rows), key=lambda x: (x is not None, x))), name
        if name == "secret scans":
            got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
            assert got[6] == ("é [assign] end", 14) and got[7] == ("é [assign] end", None) and got[1] == (words, len(words)) and got[3] == (None, None)
    packed = corpus_pipeline.packing_stage(spark, df, SF)
    assert {r["doc_id"] for r in packed.collect()} == {r[0] for r in rows} and corpus_pipeline.packing_stage(spark, df.limit(0), SF).count() == 0
    sums = packed.groupBy("doc_id").sum("n_tokens").collect()
    assert {r["doc_id"]: r[1] for r in sums} == {None: 62, 1: 120, 2: 61, 3: 0, 4: 0, 5: 40_000, 6: 5, 7: 5}


def test_toxicity_stage_drops_what_scores_high(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    left = [r["doc_id"] for r in corpus_pipeline.toxicity_stage(spark, docs, SF).select("doc_id").collect()]
    assert sorted(left) == sorted(i for i, s in scores.items() if s < 0.5) and len(left) < len(scores)


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = common.staged(stage(spark, kept, SF))
        assert after.columns == docs.columns and after.count() <= kept.count()
        kept = after
    rows = sorted(map(tuple, kept.select("doc_id", "text").collect()))
    assert all(i == c for i, _, c, _ in brute(rows, 5, 80))
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in packed} == {i for i, _ in rows}
    room, bins = {}, {}
    for r in sorted(packed, key=lambda r: (r["shard"], r["bin"], r["start"])):
        at = (r["shard"], r["bin"])
        assert r["start"] == room.get(at, 0) and r["start"] + r["n_tokens"] <= 4096
        room[at] = r["start"] + r["n_tokens"]
        bins.setdefault(at, []).append(r["doc_id"])
    sources = {r["doc_id"]: r["source"] for r in kept.collect()}
    plain = {i: " ".join((t or "").lower().split()) for i, t in rows}
    for members in bins.values():
        texts = [plain[i] for i in members]
        assert len(set(texts)) == len(texts) and max([sources[i] for i in members].count(sources[j]) for j in members) <= 4


def test_packing_is_the_same_on_any_partitions(spark):
    from pyspark.sql import functions as F

    rows = [(i % 900, "s%d" % (i % 7), i % 50 if i % 3 else None, (i % 900) * 37 % 130) for i in range(1500)]  # many rows are repeated
    df = spark.createDataFrame(rows, "doc_id long, source string, cluster long, size int")
    pack = lambda d: sorted(map(tuple, packing.best_fit(d, F.col("size"), F.col("cluster"), capacity=100, shard_rows=100).collect()))
    first = pack(df.coalesce(1))
    assert first == pack(df.repartition(7)) == pack(df.orderBy(F.desc("size"))) and len({r[0] for r in first}) == 900


def test_calibration_parts_keep_copies_together():
    """Rows of one cluster get margins of trees that saw none of them: labels by cluster alone can't be learned."""
    rnd = np.random.default_rng(3)
    cluster = np.repeat(np.arange(60), 5)
    x = rnd.random((60, 2))[cluster] + rnd.random((300, 2)) * 1e-4
    y = (rnd.random(60) < 0.5).astype(float)[cluster]
    share = lambda m: ((m > 0) == (y > 0)).mean()
    together, apart = toxicity.crossed_margins(x, y, cluster), toxicity.crossed_margins(x, y, np.arange(300))
    assert share(apart) > 0.9 and share(together) < 0.7
    assert np.array_equal(toxicity.crossed_margins(x, y, np.zeros(300, int)), toxicity.Boosted(x, y).margin(x))
    base = "one two three four five six seven eight nine ten " * 4
    assert toxicity.least_shingle(base) == toxicity.least_shingle(base + "one more word") and isinstance(toxicity.least_shingle(""), int)
