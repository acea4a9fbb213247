"""The message table as a log: what a batch touches, killed batches, splits, merged parts, removal, and the bounded and stateful streams."""

import random

import pytest
from pyspark.sql import functions as F

from gleaner.sources import files
from gleaner.streaming import ingest
from gleaner.streaming.message_table import MessageTable, split_level

SCHEMA = "channel string, message_id long, position int, text string, raw_source string, d string, repository_links array<string>"


def batch(spark, rows, day="2025-01-01"):
    """Rows (channel, id, text) or (channel, id, text, day, links)."""
    full = [(r[0], r[1], n, r[2], f"raw{n}", r[3] if len(r) > 3 else day, r[4] if len(r) > 4 else ["x"]) for n, r in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).withColumn("crawled_at", F.col("d").cast("timestamp")).drop("d")


def content(table, version=None):
    found = table.read(version)
    return {} if found is None else {(r["channel"], r["message_id"]): r["text"] for r in found.collect()}


def parts_of(table, version):
    return {r["bucket"]: set(r["parts"]) for r in table.buckets(version).collect()}


def test_few_messages_touch_few_buckets_of_a_large_table(spark, tmp_path):
    table = MessageTable(spark, str(tmp_path), rows_each=500)
    many = spark.range(40_000).selectExpr("'chan' as channel", "id as message_id", "0 as position", "'first' as text", "'raw' as raw_source", "array('x') as repository_links", "timestamp'2025-01-01' as crawled_at")
    table.merge(many, 0)
    assert 80 <= len(parts_of(table, 0)) <= 200 and table.read().count() == 40_000
    again = spark.range(39_700, 40_200).selectExpr("'chan' as channel", "id as message_id", "0 as position", "'second' as text", "'raw' as raw_source", "array('x') as repository_links", "timestamp'2025-01-02' as crawled_at")
    counters = table.merge(again, 1)
    assert counters == {"messages": 500, "links": 500, "duplicates": 0, "known": 300}
    before, after = parts_of(table, 0), parts_of(table, 1)
    touched = {b for b in after if after[b] != before.get(b)}
    assert len(touched) <= 4 and all(after[b] == before[b] for b in before if b not in touched)
    assert table.read().count() == 40_200 and table.read().where("text = 'second'").count() == 500 and table.read(0).count() == 40_000


@pytest.mark.parametrize("seed", range(3))
def test_random_batches_equal_a_plain_dictionary(spark, tmp_path, seed):
    chance = random.Random(seed)
    table, want = MessageTable(spark, str(tmp_path), rows_each=chance.choice([5, 20, 100]), most_parts=chance.choice([1, 2, 4])), {}
    for number in range(8):
        rows = []
        for _ in range(chance.choice([0, 1, 30, 60])):
            key = (chance.choice(["a", "b", "ü c"]), chance.choice([chance.randrange(40), chance.randrange(10**6), 10**17 + chance.randrange(50), -chance.randrange(1, 5)]))
            rows.append((*key, f"{number}-{len(rows)}", f"2025-01-{chance.randrange(1, 28):02d}", ["l"] * chance.randrange(3)))
        known = {k for k in want}
        counters = table.merge(batch(spark, rows), number * 3)
        newest = {}
        for n, (c, i, text, day, _) in enumerate(rows):
            if (c, i) not in newest or day > newest[c, i][0]:
                newest[c, i] = (day, text, n)
        for key, (day, text, _) in newest.items():
            if key not in want or day >= want[key][0]:
                want[key] = (day, text)
        most = {}
        for c, i, _, _, links in rows:
            most[c, i] = max(most.get((c, i), 0), len(links))
        assert counters == {"messages": len(newest), "links": sum(most.values()), "duplicates": len(rows) - len(newest), "known": len(known & set(newest))}
        assert content(table) == {k: t for k, (_, t) in want.items()}
    sizes = [r["n_rows"] for r in table.buckets(table.version()).where("level > 0").collect()]
    assert sum(sizes) >= len(want)


def test_counters_equal_those_of_a_plain_aggregation(spark, tmp_path):
    table = MessageTable(spark, str(tmp_path))
    first = batch(spark, [("a", i % 7, "t", "2025-01-01", ["x"] * (i % 3)) for i in range(20)])
    second = batch(spark, [("a", i, "u", "2025-01-02", ["y"] * i) for i in (3, 3, 9, 10)])
    assert table.merge(first, 0) == ingest.batch_counters(first, None).first().asDict()
    known = table.read()
    assert table.merge(second, 1) == ingest.batch_counters(second, known).first().asDict()


def test_a_killed_batch_is_written_again_to_the_same_rows(spark, tmp_path, monkeypatch):
    rows = [("a", i, "one") for i in range(30)]
    later = [("a", i, "two", "2025-01-02") for i in range(20, 60)]
    whole = MessageTable(spark, f"{tmp_path}/whole", rows_each=10, most_parts=1)
    killed = MessageTable(spark, f"{tmp_path}/killed", rows_each=10, most_parts=1)
    for table in (whole, killed):
        table.merge(batch(spark, rows), 0)
    whole.merge(batch(spark, later), 1)
    for step in ("_add", "_written_anew"):  # dies after that step, before the manifest
        real = getattr(MessageTable, step)

        def dies(self, *a, real=real):
            real(self, *a)
            raise RuntimeError("killed")

        monkeypatch.setattr(MessageTable, step, dies)
        with pytest.raises(RuntimeError, match="killed"):
            killed.merge(batch(spark, later), 1)
        monkeypatch.setattr(MessageTable, step, real)
        assert killed.version() == 0 and content(killed) == {("a", i): "one" for i in range(30)}
    assert killed.merge(batch(spark, later), 1)["known"] == 10
    assert content(killed) == content(whole) and parts_of(killed, 1) == parts_of(whole, 1)
    assert killed.merge(batch(spark, [("a", 1, "three", "2026-01-01")]), 1) is None and content(killed) == content(whole)


def test_parts_are_merged_and_old_ones_removed(spark, tmp_path):
    table = MessageTable(spark, str(tmp_path), most_parts=3)
    for n in range(7):
        table.merge(batch(spark, [("a", 1, f"v{n}", f"2025-01-0{n + 1}"), ("a", 10 + n, "own")]), n)
        assert all(len(p) <= 3 for p in parts_of(table, n).values())
    want = content(table)
    assert want[("a", 1)] == "v6" and len(want) == 8
    files.remove(spark, f"{tmp_path}/data/99")  # nothing there
    table.remove_old(2)
    assert content(table) == want and table.versions() == [5, 6] and content(table, 5)[("a", 1)] == "v5"
    used = set().union(*parts_of(table, 5).values(), *parts_of(table, 6).values())
    kept = {f"{kind}/{v}" for kind in ("data", "merged") for v in files.names(spark, f"{tmp_path}/{kind}")}
    assert kept == used
    assert table.merge(batch(spark, [("a", 1, "v7", "2025-02-01")]), 7) == {"messages": 1, "links": 1, "duplicates": 0, "known": 1}


def test_rows_without_keys_or_times(spark, tmp_path):
    table = MessageTable(spark, str(tmp_path))
    assert table.read() is None and table.version() is None
    assert table.merge(batch(spark, [(None, 1, "x"), ("a", None, "y")]), 0) == {"messages": 0, "links": 0, "duplicates": 0, "known": 0}
    assert table.read() is None and table.version() == 0
    table.merge(batch(spark, [("a", 1, "untimed", None), ("a", 2, "untimed", None)]), 1)
    table.merge(batch(spark, [("a", 1, "timed"), ("a", 2, "again", None)]), 2)
    table.merge(batch(spark, [("a", 1, "late", None)]), 3)
    assert content(table) == {("a", 1): "timed", ("a", 2): "again"}


def test_split_levels():
    assert split_level(63, 1000, 0, 999, 100) == 6 and split_level(63, 1000, 5, 5, 100) == 0 and split_level(3, 1000, 0, 10**9, 100) == 2
