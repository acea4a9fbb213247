"""Streams with state: equal to the keyed merge, restarted from their checkpoints, late rows counted, state given up."""

import random
import time

import pytest

from gleaner.streaming import ingest, stateful
from gleaner.streaming.message_table import MessageTable


@pytest.fixture
def progress(spark):
    listener = ingest.Progress()
    spark.streams.addListener(listener)
    yield listener
    spark.streams.removeListener(listener)


def ended(progress, n):
    for _ in range(100):
        if len(progress.ended) == n:
            break
        time.sleep(0.1)
    assert len(progress.ended) == n and not any(progress.ended.values())


def land(spark, folder, rows):
    """One file of pages: (id, text, day of the crawl, hour)."""
    pages = [("https://t.me/s/chan", "chan", f'<div data-post="chan/{i}"><div class="js-message_text">{text}</div></div>', f"2025-01-{day:02d} {hour:02d}:00:00") for i, text, day, hour in rows]
    df = spark.createDataFrame(pages, "page_url string, channel string, html string, d string").selectExpr("page_url", "channel", "html", "cast(d as timestamp) as crawled_at")
    df.coalesce(1).write.mode("append").parquet(folder)
    time.sleep(0.02)  # files are read in the order of their times


def test_first_copies_within_the_watermark(spark, tmp_path, progress):
    folder, target, check = f"{tmp_path}/landing", f"{tmp_path}/out", f"{tmp_path}/check"
    table = MessageTable(spark, f"{tmp_path}/table")
    lots = [[(i, f"t{i}", 1, i) for i in range(10)], [(i, f"t{i}", 2, 0) for i in range(5, 15)], [(2, "t2", 2, 1), (20, "t20", 2, 2), (20, "t20", 2, 2)]]
    for n, rows in enumerate(lots):  # each is a run of its own, which goes on from the checkpoint
        land(spark, folder, rows)
        stateful.ingest_first_copies(spark, folder, target, check, "3 days", 1)
        ended(progress, n + 1)
    ingest.ingest(spark, folder, table.path, f"{tmp_path}/other", files_per_trigger=1)
    got = [(r["message_id"], r["text"]) for r in spark.read.parquet(target).collect()]
    assert len(got) == len(set(got)) == 16 and set(got) == {(r["message_id"], r["text"]) for r in table.read().collect()}
    assert sum(progress.repeated.values()) == 5 + 1 + 1 and sum(progress.late.values()) == 0
    land(spark, folder, [(50, "t50", 20, 0)])  # moves the watermark, and gives up what is older
    land(spark, folder, [(51, "t51", 20, 0)])
    land(spark, folder, [(3, "t3", 3, 0), (60, "t60", 4, 0), (50, "t50", 20, 1)])  # two are late
    stateful.ingest_first_copies(spark, folder, target, check, "3 days", 1)
    ended(progress, 5)
    last = list(progress.late)[-1]
    assert progress.late[last] == 2 and progress.repeated[last] == 1 and progress.state[last] == 2
    assert spark.read.parquet(target).count() == 18


@pytest.mark.parametrize("seed", range(2))
def test_newest_crawl_wins_in_any_order(spark, tmp_path, progress, seed):
    chance = random.Random(seed)
    folder, table, plain = f"{tmp_path}/landing", MessageTable(spark, f"{tmp_path}/table"), MessageTable(spark, f"{tmp_path}/plain")
    crawls = [(i, f"text {i} of {day}-{hour}", day, hour) for i in range(8) for day, hour in {(chance.randrange(1, 9), chance.randrange(24)) for _ in range(5)}]
    chance.shuffle(crawls)
    want = {}
    for i, text, day, hour in crawls:
        want[i] = max(want.get(i, ((0, 0), "")), ((day, hour), text))
    for n in range(0, len(crawls), 10):  # a restart after each
        land(spark, folder, crawls[n : n + 10])
        stateful.ingest_newest_crawls(spark, folder, table.path, f"{tmp_path}/check", "30 days", "40 days", 1)
    ingest.ingest(spark, folder, plain.path, f"{tmp_path}/other", files_per_trigger=1)
    got = {r["message_id"]: r["text"] for r in table.read().collect()}
    assert got == {i: text for i, (_, text) in want.items()} == {r["message_id"]: r["text"] for r in plain.read().collect()}
    written = sum(r["n_rows"] for r in table.buckets(table.version()).collect())
    assert written < len(crawls)  # older crawls never reach the table


def test_state_is_given_up_by_a_timer(spark, tmp_path, progress):
    folder, table = f"{tmp_path}/landing", MessageTable(spark, f"{tmp_path}/table")
    run = lambda: stateful.ingest_newest_crawls(spark, folder, table.path, f"{tmp_path}/check", "1 day", "2 days", 1)
    land(spark, folder, [(i, "first", 1, 0) for i in range(6)])
    run()
    ended(progress, 1)
    assert list(progress.state.values())[-1] == 6
    land(spark, folder, [(0, "second", 2, 0)])  # its timer is set anew
    land(spark, folder, [(9, "other", 4, 1)])  # the watermark goes to the third
    land(spark, folder, [(10, "other", 4, 1)])  # it holds for late rows from the batch after this one
    land(spark, folder, [(1, "too late", 2, 5), (0, "old but known", 3, 5), (0, "older", 3, 4)])
    run()
    ended(progress, 2)
    last = list(progress.state)[-1]
    assert progress.late[last] == 1 and progress.state[last] == 3  # 0, 9 and 10; the timers of the others have fired
    got = {r["message_id"]: r["text"] for r in table.read().collect()}
    assert got == {0: "old but known", **{i: "first" for i in range(1, 6)}, 9: "other", 10: "other"}


@pytest.mark.parametrize("way", ["ingest", "newest"])
def test_streams_hold_few_pages_in_a_batch(spark, tmp_path, monkeypatch, way):
    """Arrow batches of a stream are bounded by rows and bytes, and the session is left as it was."""
    keys = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"]
    before, seen, real = [spark.conf.get(k) for k in keys], [], MessageTable.merge
    monkeypatch.setattr(MessageTable, "merge", lambda self, batch, n: seen.append([batch.sparkSession.conf.get(k) for k in keys]) or real(self, batch, n))
    folder, table = f"{tmp_path}/landing", f"{tmp_path}/table"
    land(spark, folder, [(i, f"t{i}", 1, 0) for i in range(450)])
    if way == "ingest":
        ingest.ingest(spark, folder, table, f"{tmp_path}/check")
    else:
        stateful.ingest_newest_crawls(spark, folder, table, f"{tmp_path}/check", "1 day", "2 days")
    assert seen and all(int(rows) <= 200 and int(size) <= 4 << 20 for rows, size in seen)
    assert [spark.conf.get(k) for k in keys] == before and MessageTable(spark, table).read().count() == 450
