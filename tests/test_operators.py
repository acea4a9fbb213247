import random

import pytest
from pyspark.sql import functions as F

from gleaner.operators import keyed, shortlist, similarity
from gleaner.sources import scans
from gleaner.streaming import ingest


def test_upsert_and_later_wins(spark):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (4, None, 1)], "k int, v string, n int")
    new = spark.createDataFrame([(2, "c", 1), (3, "d", 2), (4, None, None)], "k int, v string, n int")
    got = sorted(map(tuple, keyed.upsert(old, new, ["k"], {"n": "max"}).collect()))
    assert got == [(1, "a", 5), (2, "c", 6), (3, "d", 2), (4, None, 1)]
    assert sorted(map(tuple, keyed.later_wins(old, new, keys=["k"]).select("k", "v").collect())) == [(1, "a"), (2, "c"), (3, "d"), (4, None)]
    assert keyed.upsert(old.limit(0), new.limit(0), ["k"]).count() == 0
    assert {r["k"]: r["f"] for r in keyed.flagged(old, new, "k", "f").collect()} == {1: False, 2: True, 4: True}
    with pytest.raises(ValueError):
        keyed.require_empty(old, "rows")


def test_versions(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "k int")
    keyed.write_version(df, str(tmp_path), "v1")
    keyed.write_version(df.union(df), str(tmp_path), "v2")
    keyed.write_version(df, str(tmp_path), "v2")
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path)).select("k", "version").collect())) == [(1, "v1"), (1, "v2")]


def test_changes_and_either_key(spark):
    old = spark.createDataFrame([(1, "x"), (2, None)], "k int, fingerprint string")
    new = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, fingerprint string")
    assert {r["k"]: r["state"] for r in keyed.changed(old, new, ["k"]).collect()} == {1: "SAME", 2: "CHANGED", 3: "NEW"}
    known = spark.createDataFrame([("a", 1, 10), ("b", 2, 20)], "name string, api int, id int")
    rows = spark.createDataFrame([("a", 2), ("c", 2), ("c", 9)], "name string, api int")
    assert sorted((r["name"], r["api"], r["id"] or 0) for r in keyed.match_by_either_key(rows, known, ["name"], ["api"], "id").collect()) == [("a", 2, 10), ("c", 2, 20), ("c", 9, 0)]


def greedy(rows, targets, limit, per_cent):
    """The visit one by one: floors group by group, then all, with ceilings and likeness."""
    ranked = sorted(rows, key=lambda r: (-r["score"], -r["bundle"], r["repository"], r["id"]))
    chosen, near, counts = [], {}, {}

    def visit(r):
        low_high = targets.get(r["grp"])
        if r in chosen or len(chosen) >= limit or low_high and counts.get(r["grp"], 0) >= low_high[1]:
            return
        a = set(r["tokens"])
        for other in chosen:
            b = set(other["tokens"])
            if other["grp"] == r["grp"] and a and b and 100 * len(a & b) >= per_cent * len(a | b):
                near.setdefault(r["id"], other["id"])
                return
        chosen.append(r)
        counts[r["grp"]] = counts.get(r["grp"], 0) + 1

    for group, (low, _) in targets.items():
        for r in ranked:
            if r["grp"] == group:
                if counts.get(group, 0) >= low:
                    break
                visit(r)
    for r in ranked:
        visit(r)
    return {r["id"] for r in chosen}, near


@pytest.mark.parametrize("seed,limit", [(1, 12), (2, 25), (3, 60)])
def test_shortlist_is_the_greedy_visit(spark, seed, limit):
    rnd = random.Random(seed)
    targets = {"A": (3, 5), "B": (2, 9), "C": (0, 2)}
    rows = []
    for i in range(70):
        base = rnd.randint(0, 14)
        tokens = [f"t{base}x{j}" for j in range(rnd.choice([0, 3, 8, 9]))] + ([f"own{i}"] if rnd.random() < 0.5 else [])
        rows.append({"id": i, "repository": f"r{rnd.randint(0, 9)}", "grp": rnd.choice("ABCD"), "bundle": rnd.randint(0, 3), "score": rnd.randint(0, 9), "tokens": tokens})
    df = spark.createDataFrame(rows, "id long, repository string, grp string, bundle int, score int, tokens array<string>")
    dim = spark.createDataFrame([(g, i, low, high) for i, (g, (low, high)) in enumerate(targets.items())], "grp string, ordinal int, minimum int, maximum int")
    selected, near = shortlist.diversity_shortlist(df, limit, 62, dim)
    want, want_near = greedy(rows, targets, limit, 62)
    assert {r["id"] for r in selected.collect()} == want
    assert {r["id"]: r["similar_to"] for r in near.collect()} == want_near


@pytest.mark.parametrize("visited", [2, 500])
def test_shortlist_of_copies_is_the_greedy_visit(spark, monkeypatch, visited):
    """A copy is like all that its text is like, whichever of the copies ranks best; groups of many copies take rounds."""
    monkeypatch.setattr(shortlist, "VISITED", visited)
    rnd = random.Random(visited)
    texts = [[f"w{k}" for k in rnd.sample(range(40), 12)] for _ in range(4)]
    texts += [x[:-1] for x in texts] + [[*x, "more"] for x in texts] + [[], ["one"]]
    rows = [{"id": i, "repository": f"r{i % 5}", "grp": rnd.choice("ABC"), "bundle": 0, "score": rnd.randint(0, 40), "tokens": rnd.choice(texts)} for i in range(120)]
    same = [f"t{i}" for i in range(9)]
    rows += [{"id": 500 + i, "repository": "r", "grp": "D", "bundle": 0, "score": score, "tokens": tokens} for i, (score, tokens) in enumerate([(1, same), (9, same), (8, same), (7, same[:8]), (6, ["x"])])]
    targets = {"A": (2, 6), "B": (1, 3), "D": (1, 4)}
    df = spark.createDataFrame(rows, "id long, repository string, grp string, bundle int, score int, tokens array<string>")
    dim = spark.createDataFrame([(g, i, low, high) for i, (g, (low, high)) in enumerate(targets.items())], "grp string, ordinal int, minimum int, maximum int")
    selected, near = shortlist.diversity_shortlist(df, 60, 62, dim)
    want, want_near = greedy(rows, targets, 60, 62)
    assert {501, 504} == {i for i in want if i >= 500} and {want_near[i] for i in (500, 502, 503)} == {501}
    assert {r["id"] for r in selected.collect()} == want
    assert {r["id"]: r["similar_to"] for r in near.collect()} == want_near


def test_similar_pairs(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice("xy"), [f"w{rnd.randint(0, 12)}" for _ in range(rnd.randint(0, 9))]) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, grp string, tokens array<string>")
    got = {(r["a"], r["b"]) for r in similarity.similar_pairs(df, "id", "grp", "tokens").collect()}
    heads = {}
    for i, g, t in rows:
        heads.setdefault((g, frozenset(t)), i)
    want = {(heads[g, frozenset(t)], i) for i, g, t in rows if t and heads[g, frozenset(t)] != i}
    keys = sorted((i, k) for k, i in heads.items())
    want |= {(i, j) for i, (g, s) in keys for j, (h, t) in keys if i < j and g == h and s and t and len(s & t) / len(s | t) >= 0.62}
    assert got == want


def test_quota_selection(spark):
    rows = [(i, ["CRM"] if i < 15 else ["SURVEY", "CRM"] if i < 20 else ["NONE"], 100 - i) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, categories array<string>, discovery int")
    got = {r["id"]: r["target"] for r in shortlist.quota_selection(df, [F.desc("discovery"), F.asc("id")], limit=30).collect()}
    assert len(got) == 30 and {i for i, t in got.items() if t == 1} == set(range(10)) and {i for i, t in got.items() if t == 12} == set(range(15, 20))
    assert {i for i, t in got.items() if t == 0} == {*range(10, 15), *range(20, 30)}


PAGE = """<div class="js-widget_message tgme_widget_message" data-post="Chan/3095"><div class="tgme_widget_message_text js-message_text">Look&nbsp;<a href="https://example.org/?q=1#frag">here</a> <b>bold</b>
<a href="https://GitHub.com/Own/Repo.git">r</a><br>https://github.com/own/repo/issues/1</div><span class="tgme_widget_message_views">4.03K</span><a class="tgme_widget_message_date"><time datetime="2025-01-01T00:00:00+00:00"></time></a></div>
<article data-post="chan/3096" data-views="1.2K"><p class="js-message_text">two</p><span class="tgme_widget_message_edited"><time datetime="2025-01-02T04:00:00Z"></time></span><time datetime="2025-01-02T03:00:00Z"></time></article>
<div data-post="other/1"><div class="js-message_text">no</div></div><div data-post="chan/3095"><div class="js-message_text">again</div></div><div data-post="chan/x"></div>"""


def test_page_messages(spark):
    pages = spark.createDataFrame([("https://t.me/s/chan", "chan", PAGE), ("u", "chan", None), ("v", "chan", "<p>empty")], "page_url string, channel string, html string")
    got = {r["message_id"]: r for r in scans.typed_messages(scans.page_messages(pages)).collect()}
    assert set(got) == {3095, 3096}
    first, second = got[3095], got[3096]
    assert first["views"] == 4030 and first["repository_links"] == ["https://github.com/own/repo"] and first["external_links"][0] == "https://example.org/?q=1" and first["text"].startswith("Look here bold")
    assert second["views"] == 1200 and second["text"] == "two" and second["edited_at"] is not None and second["edited_at"] != second["published_at"]
    again = ingest.reparsed(scans.typed_messages(scans.page_messages(pages)))
    assert all(r["found"] for r in again.collect()) and {r["message_id"]: r["repository_links"] for r in again.collect()}[3095] == ["https://github.com/own/repo"]


def test_stream_replay(spark, tmp_path):
    def land(name, text, when):
        html = f'<div data-post="chan/1"><div class="js-message_text">{text}</div></div><div data-post="chan/{when}"><div class="js-message_text">m</div></div>'
        row = spark.createDataFrame([("https://t.me/s/chan", "chan", html, f"2025-01-{when:02d}")], "page_url string, channel string, html string, d string")
        row.selectExpr("page_url", "channel", "html", "cast(d as timestamp) as crawled_at").coalesce(1).write.mode("append").parquet(f"{tmp_path}/landing")

    counters = []
    run = lambda: ingest.ingest(spark, f"{tmp_path}/landing", f"{tmp_path}/table", f"{tmp_path}/check", counters, 1)
    land("a", "old", 5)
    run()
    land("b", "edited", 9)
    land("c", "older page", 3)
    run()
    table = ingest.MessageTable(spark, f"{tmp_path}/table")
    got = {r["message_id"]: r["text"] for r in table.read().collect()}
    assert got == {1: "edited", 5: "m", 9: "m", 3: "m"} and sum(c["messages"] for c in counters) == 6 and sum(c["known"] for c in counters) == 2
    run()  # nothing new
    assert table.read().count() == 4
    before = sorted(map(str, table.read().select("message_id", "text", "crawled_at").collect()))
    page = spark.read.parquet(f"{tmp_path}/landing").where("html like '%older page%'")
    batch = scans.typed_messages(scans.page_messages(page)).withColumn("crawled_at", F.lit("2025-01-03").cast("timestamp"))
    table.merge(batch, table.version())  # the last batch again
    assert sorted(map(str, table.read().select("message_id", "text", "crawled_at").collect())) == before


def test_message_table_rewrites_touched_buckets_only(spark, tmp_path):
    def batch(ids, text, day):
        rows = [("chan", i, 0, text, "raw", day) for i in ids]
        df = spark.createDataFrame(rows, "channel string, message_id long, position int, text string, raw_source string, d string")
        return df.withColumn("crawled_at", F.col("d").cast("timestamp")).drop("d")

    table, want = ingest.MessageTable(spark, str(tmp_path), rows_each=8), {}
    for n, ids in enumerate([range(100), [5], [], [5, 200], range(90, 120)]):
        table.merge(batch(ids, f"v{n}", f"2025-01-{n + 1:02d}"), n)
        want |= {i: f"v{n}" for i in ids}
        assert {r["message_id"]: r["text"] for r in table.read().collect()} == want
    held = {len(list((tmp_path / "data" / str(v)).glob("bucket=*"))) for v in (1, 2)}
    assert held == {0, 1} and table.read(0).count() == 100
    table.merge(batch([5], "late", "2024-01-01"), 5)  # an older crawl changes nothing
    assert {r["message_id"]: r["text"] for r in table.read().collect()} == want


def test_progress_listener(spark, tmp_path):
    import time

    spark.range(10).selectExpr("cast(id as string) as page_url", "'chan' as channel", "'<p>' as html", "timestamp'2025-01-01' as crawled_at").repartition(3).write.parquet(f"{tmp_path}/landing")
    progress = ingest.Progress()
    spark.streams.addListener(progress)
    try:
        ingest.ingest(spark, f"{tmp_path}/landing", f"{tmp_path}/table", f"{tmp_path}/check", files_per_trigger=1)
        for _ in range(50):
            if progress.ended:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(progress)
    assert list(progress.batches.values()) == [3] and list(progress.rows.values()) == [10] and list(progress.ended.values()) == [None]


def test_reparse_fails_for_lost_messages(spark):
    rows = spark.createDataFrame([("chan", 1, '<div data-post="chan/1"></div>', [], []), ("chan", 2, "<p>", ["old"], [])], "channel string, message_id long, raw_source string, external_links array<string>, repository_links array<string>")
    with pytest.raises(ValueError, match="not found again"):
        ingest.reparsed(rows)
    assert {r["message_id"]: (r["found"], r["external_links"]) for r in ingest.reparsed(rows, strict=False).collect()} == {1: (True, []), 2: (False, ["old"])}


def test_numbers_tables_and_leaders(spark, tmp_path):
    rnd = random.Random(4)
    keys = [(rnd.randint(0, 50), i) for i in range(500)]
    rnd.shuffle(keys)
    df = spark.createDataFrame(keys, "a int, b int").repartition(7)
    got = {(r["a"], r["b"]): r["number"] for r in keyed.numbered(df, "a", "b").collect()}
    assert got == {k: n for n, k in enumerate(sorted(keys))} and keyed.numbered(df.limit(0), "a").count() == 0
    keyed.replace_table(df, str(tmp_path / "t"))
    keyed.replace_table(df.limit(3), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    top = keyed.top_per_key(df, ["a"], [F.col("b")], 2)
    assert keyed.require_leaders(top, ["a"], 1, "audit") is top
    with pytest.raises(ValueError, match="requires 900"):
        keyed.require_leaders(top, ["a"], 900, "audit")
    crm = spark.createDataFrame([("CRM", i) for i in range(3)] + [("POS", 1)], "category string, id int")
    assert keyed.require_leaders(crm.where("category = 'CRM'"), ["category"], 3, "audit", ["CRM"]).count() == 3
    for wanted in (["CRM", "LMS"], ["POS"]):  # one has no row at all, one too few
        with pytest.raises(ValueError, match="requires 3"):
            keyed.require_leaders(crm, ["category"], 3, "audit", wanted)
    assert sorted(map(tuple, keyed.leaders(crm, "category", ["CRM", "LMS", "POS"], 3).collect())) == [("CRM", 3, True), ("LMS", 0, False), ("POS", 1, False)]


def test_reset_of_changed_rows(spark):
    stored = spark.createDataFrame([(1, "x", "COMPLETED", None), (2, "y", "FAILED", "e"), (3, None, "FAILED", "f")], "k int, fingerprint string, status string, error string")
    new = spark.createDataFrame([(1, "x"), (2, "other"), (3, None), (4, "z")], "k int, fingerprint string")
    assert sorted((r["k"], r["status"], r["error"]) for r in keyed.reset_changed(stored, new, ["k"]).collect()) == [(1, "COMPLETED", None), (2, "PENDING", None), (3, "FAILED", "f"), (4, None, None)]


def test_landed_records(spark, tmp_path):
    good = '{"id":1,"name":"a","owner":{"login":"o"},"created_at":"2024-01-01T00:00:00Z","updated_at":"2024-01-01T00:00:00Z","further":1}'
    spark.createDataFrame([(good,), ('{"id":2,"na',)], "value string").coalesce(1).write.text(str(tmp_path / "r"))
    rows = scans.repository_records(spark, str(tmp_path / "r"))
    assert sorted((r["id"] or 0, r["_corrupt"]) for r in rows.collect() if r["_corrupt"] is None) == [(1, None)] and [r["_corrupt"] for r in rows.collect() if r["_corrupt"]] == ['{"id":2,"na']
    now = F.lit("2024-01-11").cast("timestamp")
    assert scans.mapped_metadata(rows.where("_corrupt is null"), now).first()["repository_age_days"] == 10
    bad = rows.where("_corrupt is null").withColumn("created_at", F.lit("no date"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        scans.mapped_metadata(bad, now).collect()
    answers = spark.createDataFrame([("CRM", "q", '{"total_count":2,"items":[{"id":1,"name":"a"},{"id":2}]}'), ("POS", "p", "broken"), ("LMS", "l", None)], "category string, query_text string, response string")
    assert sorted((r["category"], r["id"]) for r in scans.search_hits(answers).collect()) == [("CRM", 1), ("CRM", 2)]


def test_selected_tree(spark):
    paths = ["README.md", "/etc/passwd", "a/../README.md", "src/x.ts", "db/migrations/1.sql", "deep/a/package.json", ".env.local", "seed.ts", "demo/x.bin"] + [f"p{i}/package.json" for i in range(300)]
    tree = spark.createDataFrame([(1, p, 1, i) for i, p in enumerate(paths)], "repository_id int, path string, size int, position int")
    got = {r["path"]: r["with_content"] for r in scans.selected_tree(tree).collect()}
    assert len(got) == 240 and sum(got.values()) == 24 and got["README.md"] and got[".env.local"] and not got["deep/a/package.json"] and got["db/migrations/1.sql"] is False
    assert not {"/etc/passwd", "a/../README.md", "src/x.ts"} & set(got) and "seed.ts" in got and "demo/x.bin" in got


def test_files_are_cut_by_depth_and_path(spark):
    files = spark.range(3000).selectExpr("1 as repository_id", "concat(repeat('d/', cast(id % 3 as int)), 'f', lpad(id, 5, '0')) as path", "1 as size", "'c' as content")
    got = [r["path"] for r in scans.repository_files(files, 50).orderBy("file_rank").collect()]
    assert got == sorted((r["path"] for r in files.collect()), key=lambda p: (p.count("/"), p))[:50]
