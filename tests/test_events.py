"""Event-time operators: windows, sessions, interval joins, deduplication, late rows."""

from datetime import datetime, timedelta

import pytest
from conftest import plan, rows

from weir.streaming import (
    await_all,
    deduplicate_within,
    dropped_rows,
    end_folder,
    interval_join,
    mark_end,
    read_file_stream,
    session_aggregate,
    window_aggregate,
    with_end,
    write_split_late,
    write_stream,
)

SCHEMA = "k string, t timestamp, v long"
START = datetime(2024, 5, 1)


def at(minutes: float) -> datetime:
    return START + timedelta(minutes=minutes)


@pytest.fixture
def inbox(spark, tmp_path):
    """A folder, and a function that drops one more file of (k, minutes, v) into it."""
    folder = str(tmp_path / "inbox")
    spark.createDataFrame([], SCHEMA).write.parquet(folder)

    def drop(*lot):
        data = [(k, None if m is None else at(m), v) for k, m, v in lot]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)

    return folder, drop


class Run:
    """A stateful stream that is started again for each lot, from one checkpoint."""

    def __init__(self, spark, tmp_path, folder, operator, files=None):
        self.spark, self.path, self.checkpoint = spark, str(tmp_path / "out"), str(tmp_path / "checkpoint")
        self.stream = read_file_stream(spark, folder, SCHEMA, max_files_per_trigger=files)
        self.marks = end_folder(spark)
        self.out = operator(with_end(self.stream, self.marks))
        self.queries = []

    def go(self):
        query = write_stream(self.out, self.path, checkpoint=self.checkpoint, trigger="once")
        await_all([query])
        self.queries.append(query)
        return self.rows()

    def end(self):
        mark_end(self.spark, self.stream, self.marks, "t", "2100-01-01")
        return self.go()

    def rows(self):
        return rows(self.spark.read.schema(self.out.schema).parquet(self.path))

    def state(self):
        return self.queries[-1].lastProgress["stateOperators"][0]["numRowsTotal"]


def by_ten_minutes(df):
    return window_aggregate(df, "t", "10 minutes", {"n": "count(1)", "v": "sum"}, delay="5 minutes", group_by=["k"])


def test_windows_close_behind_the_watermark(spark, tmp_path, inbox):
    folder, drop = inbox
    run = Run(spark, tmp_path, folder, by_ten_minutes)
    drop(("a", 1, 5), ("a", 9, 7), ("b", 2, 1))
    assert run.go() == []  # the watermark stands at 4
    drop(("a", 14, 1), ("a", 8, 1))  # out of order, in time
    assert run.go() == []
    drop(("a", 21, 1))
    assert run.go() == [(at(0), at(10), "a", 3, 13), (at(0), at(10), "b", 1, 1)]
    drop(("a", 3, 100), ("a", 22, 1))  # behind the watermark of 16
    run.go()
    assert sum(map(dropped_rows, run.queries)) == 1
    assert run.end() == sorted(
        [(at(0), at(10), "a", 3, 13), (at(0), at(10), "b", 1, 1), (at(10), at(20), "a", 1, 1), (at(20), at(30), "a", 2, 2)],
        key=lambda r: tuple(map(repr, r)),
    )
    assert run.state() == 0


def test_state_of_windows_stays_flat(spark, tmp_path, inbox):
    folder, drop = inbox
    for lot in range(20):
        drop(*[(k, 10 * lot + m, 1) for k in "abc" for m in (0, 4, 9)])
    run = Run(spark, tmp_path, folder, by_ten_minutes, files=1)
    run.go()
    progress = [p for p in run.queries[-1].recentProgress if p["numInputRows"]]
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in progress]
    assert len(sizes) >= 20
    assert max(sizes) <= 9  # three windows of three keys, however long it runs
    assert len(run.end()) == 60


def test_sliding_windows_equal_the_batch(spark, tmp_path, inbox):
    folder, drop = inbox

    def sliding(df):
        return window_aggregate(df, "t", "10 minutes", {"n": "count(1)"}, delay="1 hour", slide="5 minutes")

    run = Run(spark, tmp_path, folder, sliding)
    for lot in range(3):
        drop(*[("a", 7 * lot + m, 1) for m in range(0, 12, 3)])
        run.go()
    batch = sliding(spark.read.schema(SCHEMA).parquet(folder))
    assert run.end() == rows(batch)
    assert {r[1] - r[0] for r in run.rows()} == {timedelta(minutes=10)}


def test_late_rows_merge_sessions(spark, tmp_path, inbox):
    folder, drop = inbox

    def sessions(df):
        return session_aggregate(df, "t", "10 minutes", {"n": "count(1)"}, delay="30 minutes", group_by=["k"])

    run = Run(spark, tmp_path, folder, sessions)
    drop(("a", 0, 1), ("a", 16, 1), ("b", 3, 1))
    run.go()
    drop(("a", 8, 1))  # closes the gap
    run.go()
    drop(("a", 60, 1))
    assert run.go() == [(at(0), at(26), "a", 3), (at(3), at(13), "b", 1)]
    assert run.end()[-1] == (at(60), at(70), "a", 1)


def test_sessions_of_a_hot_key_are_merged_before_the_shuffle(spark, inbox):
    folder, drop = inbox
    drop(*[("a", m, 1) for m in range(50)])
    stream = spark.read.schema(SCHEMA).parquet(folder)
    done = session_aggregate(stream, "t", "10 minutes", {"n": "count(1)"}, delay="1 hour", group_by=["k"])
    assert rows(done) == [(at(0), at(59), "a", 50)]
    assert spark.conf.get("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition") == "true"


def views_and_buys(df, how):
    end = ["_end"] if "_end" in df.columns else []
    views = df.filter("v = 1" + " or _end" * len(end)).select("k", "t", *end)
    buys = df.filter("v = 2" + " or _end" * len(end)).withColumnRenamed("t", "bought").select("k", "bought", *end)
    return interval_join(views, buys, ["k"], "t", "bought", "60 minutes", delay="10 minutes", how=how)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join_of_streams(spark, tmp_path, inbox, how):
    folder, drop = inbox
    run = Run(spark, tmp_path, folder, lambda df: views_and_buys(df, how))
    drop(("a", 0, 1), ("b", 5, 1), ("a", 30, 2), ("c", 1, 1), ("c", 61.5, 2), (None, 7, 1), (None, 8, 2))
    first = run.go()
    assert first == [("a", at(0), at(30))]
    drop(("b", 65, 2), ("d", 200, 1), ("d", 200, 2))
    second = run.go()
    matched = [("a", at(0), at(30)), ("b", at(5), at(65)), ("d", at(200), at(200))]
    alone = [("c", at(1), None), (None, at(7), None)] if how == "left" else []
    assert second == sorted([*matched, *alone], key=lambda r: tuple(map(repr, r)))
    state = run.state()
    for lot in range(4):
        drop(("e", 400 + 200 * lot, 1), ("f", 400 + 200 * lot, 2))
        run.go()
        assert run.state() == state
    batch = views_and_buys(spark.read.schema(SCHEMA).parquet(folder), how)
    assert run.end() == rows(batch)
    assert "NestedLoop" not in plan(batch) and "Cartesian" not in plan(batch)


def test_interval_join_refuses_what_it_cannot_do(spark):
    one = spark.createDataFrame([], "k string, t timestamp, x int")
    two = spark.createDataFrame([], "k string, u timestamp, x int")
    with pytest.raises(ValueError, match="columns on both sides"):
        interval_join(one, two, ["k"], "t", "u", "1 hour", delay="1 hour")
    with pytest.raises(ValueError, match="inner or left"):
        interval_join(one, two.drop("x"), ["k"], "t", "u", "1 hour", delay="1 hour", how="full")


def test_duplicates_leave_once_also_after_a_restart(spark, tmp_path, inbox):
    folder, drop = inbox
    run = Run(spark, tmp_path, folder, lambda df: deduplicate_within(df, ["k"], "t", delay="20 minutes"))
    drop(("a", 0, 1), ("a", 0, 1), ("b", 4, 1))
    assert [r[0] for r in run.go()] == ["a", "b"]
    drop(("a", 3, 1), ("c", 6, 1))  # replayed within the delay, in a new run
    assert [r[0] for r in run.go()] == ["a", "b", "c"]
    drop(("z", 100, 1))
    run.go()
    drop(("a", 101, 1))  # forgotten by now
    assert [r[0] for r in run.go()] == ["a", "a", "b", "c", "z"]
    assert run.state() <= 2
    batch = deduplicate_within(spark.read.schema(SCHEMA).parquet(folder), ["k"], "t", delay="20 minutes")
    assert sorted(r[0] for r in batch.collect()) == ["a", "b", "c", "z"]


def test_late_rows_are_kept_apart(spark, tmp_path, inbox):
    folder, drop = inbox
    on_time, late, checkpoint = (str(tmp_path / name) for name in ("on_time", "late", "checkpoint"))
    lots = [
        [("a", 0, 1), ("b", 50, 2)],
        [("c", 39, 3), ("d", 40, 4), ("e", 90, 5), ("f", None, 6)],
        [("g", 45, 7)],
        [("h", 79.9, 8), ("i", 80, 9)],
    ]
    for lot in lots:
        drop(*lot)
        stream = read_file_stream(spark, folder, SCHEMA)
        await_all([write_split_late(stream, "t", "10 minutes", on_time, late, checkpoint=checkpoint, trigger="once")])
    kept, lost = (spark.read.schema(SCHEMA + ", batch int").parquet(p) for p in (on_time, late))
    assert sorted(r.k for r in kept.collect()) == ["a", "b", "d", "e", "f", "i"]
    assert sorted((r.k, r.batch) for r in lost.collect()) == [("c", 1), ("g", 2), ("h", 3)]
    # windows over the rows on time lose none of them
    again = Run(spark, tmp_path / "again", on_time + "/*", lambda df: window_aggregate(df, "t", "10 minutes", {"n": "count(1)"}, delay="10 minutes"))
    assert sum(r[2] for r in again.end()) == kept.filter("t is not null").count()
    assert dropped_rows(again.queries[0]) == 0
    with pytest.raises(ValueError, match="batch frame"):
        write_split_late(kept, "t", "1 hour", on_time, late, checkpoint=checkpoint)


def test_a_batch_that_runs_again_leaves_the_same_rows(spark, tmp_path, inbox):
    """A run that dies between the sinks and its commit is repeated on the same rows."""
    import shutil

    folder, drop = inbox
    on_time, late, checkpoint = (str(tmp_path / name) for name in ("on_time", "late", "checkpoint"))

    def go():
        stream = read_file_stream(spark, folder, SCHEMA)
        await_all([write_split_late(stream, "t", "10 minutes", on_time, late, checkpoint=checkpoint, trigger="once")])
        return [rows(spark.read.schema(SCHEMA + ", batch int").parquet(p)) for p in (on_time, late)]

    drop(("a", 0, 1), ("b", 50, 2))
    go()
    drop(("c", 39, 3), ("e", 90, 5))
    before = go()
    shutil.rmtree(tmp_path / "checkpoint" / "commits" )
    assert go() == before
