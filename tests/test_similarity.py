"""Similar pairs through blocks of hot tokens, and the greedy pick with contracted chains, against plain visits."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from gleaner.operators import shortlist, similarity


def plain_pairs(rows, per_cent=62):
    out = set()
    for (i, g, x), (j, h, y) in itertools.combinations(rows, 2):
        if g == h and x and y and 100 * len(set(x) & set(y)) >= per_cent * len(set(x) | set(y)):
            out.add((min(i, j), max(i, j)))
    return out


def closure(pairs, rows):
    """Pairs with those of equal sets expanded to their smallest id alone, as the join returns them."""
    head = {}
    for i, g, x in sorted(rows):
        head.setdefault((g, frozenset(x)), i)
    heads = set(head.values())
    own = {i: head[g, frozenset(x)] for i, g, x in rows if x}
    return {p for p in pairs if set(p) <= heads} | {(own[i], i) for i in own if own[i] != i}


@pytest.mark.parametrize("hot_sets,block_sets", [(5, 3), (40, 10), (10**6, 10)])
def test_hot_tokens_in_blocks(spark, hot_sets, block_sets):
    rnd = random.Random(hot_sets)
    rows = [(i, rnd.choice("pq"), sorted(rnd.sample(range(14), rnd.choice([1, 2, 3, 3, 4, 5, 9])))) for i in range(260)] + [(500, "p", []), (501, "p", list(range(60))), (502, "p", list(range(55)))]
    df = spark.createDataFrame([(i, g, [f"t{k}" for k in x]) for i, g, x in rows], "id long, grp string, tokens array<string>")
    got = {(r["a"], r["b"]) for r in similarity.similar_pairs(df, "id", "grp", "tokens", hot_sets=hot_sets, block_sets=block_sets).collect()}
    assert got == closure(plain_pairs(rows), rows) and (501, 502) in got and len(got) > 100


def test_blocks_of_a_token_that_all_sets_have(spark):
    """One token in every set of a group: keys of about equal size, and each pair of neighbouring sizes meets in one."""
    indexed = spark.range(3000).selectExpr("'g' as grp", "id as head", "cast(2 + id % 3 as int) as size", "0 as at", "7L as token")
    left, right = similarity.blocked(indexed, 62, 100)
    sides = [x.groupBy("key").agg(F.count("*").alias("n")).collect() for x in (left, right)]
    for counts in sides:
        sizes = sorted(r["n"] for r in counts)
        assert len(sizes) > 100 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    met = left.alias("a").join(right.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a.head") != F.col("b.head"))).select(F.least("a.head", "b.head").alias("x"), F.greatest("a.head", "b.head").alias("y"), "a.key")
    per_pair = met.groupBy("x", "y").agg(F.countDistinct("key").alias("n"))
    assert per_pair.agg(F.max("n")).first()[0] == 1
    close = per_pair.join(indexed.select(F.col("head").alias("x"), F.col("size").alias("sx")), "x").join(indexed.select(F.col("head").alias("y"), F.col("size").alias("sy")), "y").where("100 * least(sx, sy) >= 62 * greatest(sx, sy)")
    n = [1000, 1000, 1000]  # of sizes 2, 3, 4: 2 and 3, 3 and 4 are close enough, 2 and 4 aren't
    assert close.count() == sum(k * (k - 1) // 2 for k in n) + 2 * 1000 * 1000


@pytest.mark.parametrize("task_pairs", [30, 10**6])
def test_sets_are_sent_for_likely_pairs_alone(spark, monkeypatch, task_pairs):
    """3,000 pairs meet by a rare token; signatures leave little more than the similar ones, for which sets are read."""
    rnd = random.Random(3)
    rows = [(i, "g", sorted({f"rare{i % 20}", *(f"w{k}" for k in rnd.sample(range(3000), rnd.choice([12, 50, 130, 300])))})) for i in range(600)]
    rows += [(1000 + i, "g", [*x[1 + i % 3 :], f"own{i}"]) for i, (_, _, x) in enumerate(rows[:40])] + [(2000 + i, "g", x) for i, (_, _, x) in enumerate(rows[:5])]
    df = spark.createDataFrame(rows, "id long, grp string, tokens array<string>")
    sent, real = [], similarity.staged
    monkeypatch.setattr(similarity, "staged", lambda t: (lambda out: (sent.append(out), out)[1])(real(t)))
    got = {(r["a"], r["b"]) for r in similarity.similar_pairs(df, "id", "grp", "tokens", **({} if task_pairs > 1000 else {"task_pairs": task_pairs})).collect()}
    assert got == closure(plain_pairs(rows), rows) and len(got) >= 45
    with_sets = [t for t in sent if "set" in t.columns]
    assert with_sets[0].count() == len(rows) and sum(t.count() for t in with_sets[1:]) <= 3 * len({i for p in got for i in p})


def visit(ranks, edges):
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    taken = {}
    for i in sorted(ranks, key=ranks.get):
        taken[i] = not any(taken.get(j) for j in near.get(i, ()) if ranks.get(j, 1 << 60) < ranks[i])
    return taken


def picked(spark, ranks, edges):
    ranked = spark.createDataFrame(list(ranks.items()), "id long, rank long")
    return dict(map(tuple, similarity.greedy_independent(ranked, spark.createDataFrame(edges, "a long, b long")).collect()))


@pytest.mark.parametrize("seed", range(6))
def test_greedy_pick_equals_the_visit_one_by_one(spark, seed):
    rnd = random.Random(seed)
    n = rnd.choice([6, 12, 40])
    ranks = dict(zip(range(n), rnd.sample(range(1000), n), strict=True))
    edges = [tuple(rnd.sample(range(n), 2)) for _ in range(rnd.choice([n // 2, n, 3 * n]))]
    order = sorted(ranks, key=ranks.get)
    edges += [(order[i], order[i + 1]) for i in range(n // 2, n - 1)] + [(order[i], order[i + 2]) for i in range(0, n - 2, 3)] + edges[:2]
    assert picked(spark, ranks, edges) == visit(ranks, edges)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    """100,000 rows, each near the one before: every other is taken, in steps that grow with the logarithm."""
    written = []
    real = similarity.staged
    monkeypatch.setattr(similarity, "staged", lambda df: written.append(1) or real(df))
    followed = []
    step = similarity.followed
    monkeypatch.setattr(similarity, "followed", lambda df: followed.append(len(written)) or step(df))
    ranked = spark.range(100_000).selectExpr("id", "id as rank")
    edges = spark.range(99_999).selectExpr("id as a", "id + 1 as b")
    got = similarity.greedy_independent(ranked, edges)
    assert got.where("taken = (id % 2 = 0)").count() == 100_000
    assert len(written) <= 30 and len(followed) <= 2  # about 17 doubling steps, and a few tables around them


def test_chains_that_meet(spark):
    """Two chains of 400 end in one row, which has a term of each; from it a third goes on."""
    for odd in (0, 1):
        first, second = list(range(0, 400)), list(range(1000, 1400 + odd))
        third = list(range(5000, 5300))
        edges = [*zip(first, first[1:], strict=False), *zip(second, second[1:], strict=False), *zip(third, third[1:], strict=False), (first[-1], third[0]), (second[-1], third[0])]
        ranks = {i: i for i in (*first, *second, *third)}
        assert picked(spark, ranks, edges) == visit(ranks, edges)
    assert picked(spark, {1: 1, 2: 1, 3: 2}, [(1, 2), (2, 3)]) == visit({1: 1, 2: 1, 3: 2}, [(1, 2), (2, 3)])
    assert picked(spark, {1: 1}, []) == {1: True} and picked(spark, {}, []) == {}


def test_lists_in_one_scan(spark, tmp_path):
    rnd = random.Random(8)
    rows = [(i, rnd.choice([None, *range(20)]), rnd.choice([None, 1.5, 2.5, -1.0])) for i in range(3000)]
    spark.createDataFrame(rows, "id long, a int, b double").repartition(5).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    lists = {"first": ("a is not null", ["a DESC", "id"], 40), "second": ("true", ["b", "a DESC", "id"], 90), "third": ("id % 2 = 0 and a > 100", ["id"], 5), "ids": ("id % 3 = 0", ["id DESC"], 7)}
    low = lambda x: (x is not None, x or 0)  # noqa: E731  nulls first
    down = lambda x: (x is None, -(x or 0))  # noqa: E731  nulls last
    want = {
        "first": sorted((r for r in rows if r[1] is not None), key=lambda r: (down(r[1]), r[0]))[:40], "second": sorted(rows, key=lambda r: (low(r[2]), down(r[1]), r[0]))[:90],
        "third": [], "ids": sorted((r for r in rows if r[0] % 3 == 0), key=lambda r: -r[0])[:7],
    }
    found = shortlist.top_lists(df, lists, "id")
    plan = found._jdf.queryExecution().executedPlan().toString()  # before it has run, when it is one plan
    assert sorted(map(tuple, found.collect())) == sorted((n, p + 1, r[0]) for n, x in want.items() for p, r in enumerate(x))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "WindowGroupLimit" in plan.split("Exchange")[1]
    assert shortlist.top_lists(df.limit(0), lists, "id").count() == 0


def test_shortlist_sorts_rows_without_their_tokens(spark, monkeypatch):
    """Only similar_pairs writes tokens, as hashes; the ranked rows have none."""
    written, real = [], shortlist.staged
    monkeypatch.setattr(shortlist, "staged", lambda df: written.append(df.columns) or real(df))
    rows = [(i, f"r{i}", "A", i % 7, i % 9, [f"t{i % 5}{k}" for k in range(5)]) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, repository string, grp string, bundle int, score int, tokens array<string>")
    targets = spark.createDataFrame([("A", 0, 1, 4)], "grp string, ordinal int, minimum int, maximum int")
    selected, near = shortlist.diversity_shortlist(df, 4, 62, targets)
    assert selected.count() == 4 and written and not any("tokens" in c for c in written)


def test_shortlist_sends_and_tokenizes_texts_of_visited_rows_alone(spark, monkeypatch, tmp_path):
    """Of 4,000 texts that a join with another table would send, the best rows of a group are cut out before it, and before tokens."""
    monkeypatch.setattr(shortlist, "VISITED", 20)
    rows = [(i, f"r{i % 7}", "AB"[i % 2], i % 7, i % 9, " ".join(f"t{(i * k) % 97}" for k in range(1, 9))) for i in range(4000)]
    spark.createDataFrame(rows, "id long, repository string, grp string, bundle int, score int, text string").write.parquet(f"{tmp_path}/t")
    spark.range(4000).write.parquet(f"{tmp_path}/other")
    joined = spark.read.parquet(f"{tmp_path}/t").join(spark.read.parquet(f"{tmp_path}/other").hint("merge"), "id", "left")
    df = joined.select("id", "repository", "grp", "bundle", "score", F.split("text", " ").alias("tokens"))
    plans, real = [], shortlist.with_sets
    monkeypatch.setattr(shortlist, "with_sets", lambda *a: (lambda out: (plans.append(out._jdf.queryExecution().executedPlan().toString()), out)[1])(real(*a)))
    targets = spark.createDataFrame([("A", 0, 1, 4), ("B", 1, 2, 5)], "grp string, ordinal int, minimum int, maximum int")
    selected, _ = shortlist.diversity_shortlist(df, 9, 62, targets)
    assert selected.count() == 9 and plans
    for plan in plans:
        sent = [part for part in plan.split("Exchange hashpartitioning")[1:] if "text" in part.split("FileScan")[1]]
        assert sent and all("LeftSemi" in part.split("FileScan")[0] for part in sent)
        assert 0 < plan.index("xxhash64") < plan.index("LeftSemi")
