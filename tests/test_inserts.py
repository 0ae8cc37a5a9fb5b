"""Inserts of new keys: isolation, repeats after a failure, and reading only touched ranges."""

import datetime as dt
import random
import threading

import pytest

from tidemark.sources import commits, inserts
from tidemark.sources.inserts import InsertTable, insert_new, read_inserted, touched
from tidemark.sources.shared import fresh_path

SCHEMA = "k int, v string"


def rows_of(spark, target):
    return sorted((tuple(r) for r in read_inserted(spark, target).collect()), key=str)


def test_first_writes_repeats_and_empty_inserts(spark):
    target = fresh_path(spark, "t")
    assert insert_new(spark.createDataFrame([], SCHEMA), target, ["k"]) == 0
    assert rows_of(spark, target) == []
    assert insert_new(spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "n")], SCHEMA), target, ["k"]) == 3
    assert insert_new(spark.createDataFrame([(2, "x"), (None, "m"), (3, "c")], SCHEMA), target, ["k"]) == 1
    assert insert_new(spark.createDataFrame([(2, "y")], SCHEMA), target, ["k"]) == 0
    assert rows_of(spark, target) == sorted([(1, "a"), (2, "b"), (None, "n"), (3, "c")], key=str)
    turned = spark.createDataFrame([("d", 4)], "v string, k int")
    assert insert_new(turned, target, ["k"]) == 1 and (4, "d") in rows_of(spark, target)
    with pytest.raises(ValueError):
        insert_new(spark.createDataFrame([(1, 2)], "k int, w int"), target, ["k"])


def test_files_that_were_there_before_count(spark):
    target = fresh_path(spark, "t")
    spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA).write.parquet(target)
    assert insert_new(spark.createDataFrame([(2, "x"), (3, "c")], SCHEMA), target, ["k"]) == 1
    assert insert_new(spark.createDataFrame([(1, "x"), (3, "y")], SCHEMA), target, ["k"]) == 0
    assert rows_of(spark, target) == [(1, "a"), (2, "b"), (3, "c")]


@pytest.mark.parametrize("at", ["commit", "write"])
def test_a_failed_insert_shows_nothing_and_can_be_repeated(spark, monkeypatch, at):
    target = fresh_path(spark, "t")

    def dies(*_, **__):
        raise OSError("lost")

    for rows in ([(1, "a"), (2, "b")], [(2, "x"), (3, "c")]):
        df = spark.createDataFrame(rows, SCHEMA)
        with monkeypatch.context() as m:
            if at == "commit":
                m.setattr(commits, "append", dies)
            else:
                m.setattr(inserts, "_boxes", dies)
            with pytest.raises(OSError):
                insert_new(df, target, ["k"])
        insert_new(df, target, ["k"])
    assert rows_of(spark, target) == [(1, "a"), (2, "b"), (3, "c")]
    assert len(commits.children(spark, f"{target}/_batches")) == 2  # what failed is gone


def test_what_a_killed_insert_leaves_is_not_read_and_can_be_removed(spark):
    target = fresh_path(spark, "t")
    insert_new(spark.createDataFrame([(1, "a")], SCHEMA), target, ["k"])
    spark.createDataFrame([(9, "z")], SCHEMA).write.parquet(f"{target}/_batches/dead")
    assert rows_of(spark, target) == [(1, "a")]
    table = InsertTable(spark, target)
    assert table.clean_up() == [] and table.clean_up(older_than=-5) == ["dead"]
    assert rows_of(spark, target) == [(1, "a")]


def test_overlapping_inserts_leave_each_key_once(spark):
    target = fresh_path(spark, "t")
    added, errors = [], []
    start = threading.Barrier(4)

    def work(n):
        df = spark.createDataFrame([(k, f"w{n}") for k in range(n * 10, n * 10 + 40)], SCHEMA)
        start.wait()
        try:
            added.append(insert_new(df, target, ["k"]))
        except Exception as err:  # noqa: BLE001 - shown by the assertion below
            errors.append(err)

    threads = [threading.Thread(target=work, args=(n,)) for n in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and sum(added) == 70
    assert [k for k, _ in sorted(rows_of(spark, target))] == list(range(70))


def test_a_commit_between_look_and_entry_is_compared_again(spark, monkeypatch):
    target = fresh_path(spark, "t")
    real, done = commits.append, []

    def late(session, log, number, entry):
        if not done:
            done.append(1)
            insert_new(spark.createDataFrame([(1, "other"), (2, "other")], SCHEMA), target, ["k"])
        return real(session, log, number, entry)

    with monkeypatch.context() as m:
        m.setattr(commits, "append", late)
        assert insert_new(spark.createDataFrame([(2, "mine"), (3, "mine")], SCHEMA), target, ["k"]) == 1
    assert rows_of(spark, target) == [(1, "other"), (2, "other"), (3, "mine")]


def test_only_touched_files_are_opened(spark):
    target = fresh_path(spark, "t")
    day = dt.date(2024, 1, 1)

    def block(first):
        return spark.createDataFrame(
            [(f"E{e}", day + dt.timedelta(days=first + d), 1) for e in range(5) for d in range(10)],
            "e string, d date, x int",
        )

    for first in range(0, 100, 10):
        assert insert_new(block(first), target, ["e", "d"]) == 50
    table = InsertTable(spark, target)
    asked = [[["E0", "E4"], ["2024-01-05", "2024-01-14"]]]
    known = table.known_keys(["e", "d"], asked)
    batches = {f.split("/_batches/")[1].split("/")[0] for f in known.inputFiles()}
    assert len(batches) == 2 and len(table.entries()) == 10
    assert known.columns == ["e", "d"] and "x:int" not in known._jdf.queryExecution().executedPlan().toString()
    assert table.known_keys(["e", "d"], [[["E0", "E4"], ["2030-01-01", "2030-01-02"]]]) is None
    assert insert_new(block(95), target, ["e", "d"]) == 25


def test_touched_equals_comparing_all(spark):
    rng = random.Random(1)

    def box():
        a, b = rng.randrange(50), rng.randrange(50)
        first = [a, a + rng.randrange(6)] if rng.random() < 0.8 else None
        return [first, [b, b + rng.randrange(20)] if rng.random() < 0.8 else None]

    for _ in range(300):
        files = [(str(i), box()) for i in range(rng.randrange(12))]
        asked = [box() for _ in range(rng.randrange(8))]
        plain = [n for n, f in files if any(not inserts._disjoint(f, b) for b in asked)]
        assert touched(files, asked) == plain
