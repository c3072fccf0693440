"""The commit log of landed files: crashes, merging, concurrent writers and readers."""

import os

import pytest
from pyspark.sql import functions as F
from test_streaming import pairs, records, some_events

from retailloom.sources import manifest
from retailloom.streaming import landing


def batches(spark, target, numbers, run="run-a", size=6):
    for b in numbers:
        landing.append_once(records(some_events(spark, size, start=b * size)), b, target, run, repeats=False)


def data_files(target):
    return [os.path.join(d, n) for d, _, names in os.walk(f"{target}/data") for n in names if n.endswith(".parquet")]


def test_a_write_that_is_never_committed_is_never_read(spark, path, monkeypatch):
    target, real = path("landing"), manifest.commit
    batches(spark, target, [0])
    monkeypatch.setattr(manifest, "commit", lambda *a: (_ for _ in ()).throw(OSError("crashed before the commit")))
    with pytest.raises(OSError):
        batches(spark, target, [1])
    assert landing.landed(spark, target).count() == 6 and landing.consumed(spark, target, "run-a") == 6
    left = len(data_files(target))
    monkeypatch.setattr(manifest, "commit", real)
    batches(spark, target, [1])
    got = pairs(landing.landed(spark, target))
    assert len(got) == 12 == len(set(got)) and landing.consumed(spark, target, "run-a") == 12
    assert landing.sweep(spark, target) == 0  # too young to be told from a write that is under way
    assert landing.sweep(spark, target, -60) > 0 and len(data_files(target)) < 2 * left
    assert landing.sweep(spark, target, -60) == 0 and landing.landed(spark, target).count() == 12


def test_a_batch_retried_after_its_commit_writes_nothing(spark, path):
    target = path("landing")
    batches(spark, target, [0, 1])
    files, version = data_files(target), manifest.read_state(spark, target).version
    batches(spark, target, [1, 0])
    assert data_files(target) == files and manifest.read_state(spark, target).version == version


def test_merging_keeps_every_row_and_every_batch(spark, path):
    target = path("landing")
    batches(spark, target, range(5))
    batches(spark, target, [0], run="run-b", size=3)
    rows, before = sorted(map(tuple, landing._everything(spark, target).collect()), key=repr), landing.seen(spark, target).collect()
    assert landing.compact(spark, target) > 2
    assert sorted(map(tuple, landing._everything(spark, target).collect()), key=repr) == rows
    assert sorted(landing.seen(spark, target).collect()) == sorted(before)
    assert len(manifest.read_state(spark, target).of("rows")) == 1 and landing.compact(spark, target) == 0
    assert landing.progress(spark, target).count() == 6
    again = records(some_events(spark, 6))
    landing.append_once(again, 1, target, "run-b", against=F.col("run") != "run-b")
    assert len(set(pairs(landing.landed(spark, target)))) == 30


def test_readers_see_each_offset_once_before_during_and_after_a_merge(spark, path, monkeypatch):
    target, real = path("landing"), manifest.commit
    batches(spark, target, range(4))
    opened = landing.landed(spark, target)
    during = []

    def commit(*a):
        during.append(pairs(landing.landed(spark, target)))  # merged files are written, nothing is committed
        return real(*a)

    monkeypatch.setattr(manifest, "commit", commit)
    landing.compact(spark, target)
    landing.clean(spark, target)
    expected = pairs(landing.landed(spark, target))
    assert len(expected) == 24 == len(set(expected))
    assert during == [expected] and pairs(opened) == expected


def test_a_crash_while_merging_changes_nothing(spark, path, monkeypatch):
    target = path("landing")
    batches(spark, target, range(3))
    before = manifest.read_state(spark, target)
    monkeypatch.setattr(manifest, "commit", lambda *a: (_ for _ in ()).throw(OSError("crashed")))
    with pytest.raises(OSError):
        landing.compact(spark, target)
    assert manifest.read_state(spark, target) == before and landing.landed(spark, target).count() == 18


def test_two_merges_of_the_same_files_count_once(spark, path, monkeypatch):
    target, real, nested = path("landing"), manifest.commit, []
    batches(spark, target, range(3))

    def commit(*a):
        if not nested:
            nested.append(True)
            assert landing.compact(spark, target) > 0  # the faster one
        return real(*a)

    monkeypatch.setattr(manifest, "commit", commit)
    assert landing.compact(spark, target) == 0
    got = pairs(landing.landed(spark, target))
    assert len(got) == 18 == len(set(got))


def test_writers_that_meet_at_a_version_both_commit(spark, path):
    target, met = path("landing"), []

    def change(state):
        if not met:
            met.append(True)
            manifest.commit(spark, target, lambda s: {"add": {"rows": {"b": 1}}})
        return {"add": {"rows": {"a": 1}}}

    assert manifest.commit(spark, target, change).of("rows") == ["a", "b"]
    assert manifest.read_state(spark, target).version == 1
    with pytest.raises(manifest.CommitConflict):
        manifest.put(spark, f"{target}/_log/{1:020d}.json", "{}")


def test_many_batches_leave_few_files_and_a_short_log(spark, path):
    target, one = path("landing"), some_events(spark, 3)
    for b in range(100):
        landing.append_once(records(one), b, target, "run-a", repeats=False) if b < 2 else manifest.commit(
            spark, target, lambda s, b=b: {"add": {"rows": {f"x{b}": 1}}, "drop": {"rows": [f"x{b - 1}"] if b > 2 else []}, "runs": {"run-a": {"batch": b, "records": b}}})
    names = os.listdir(f"{target}/_log")
    assert len([n for n in names if n.endswith(".json") and not n.startswith(".")]) <= 2 * manifest.FULL_EVERY + 3
    state = manifest.read_state(spark, target)
    assert state.version == 99 and "x99" in state.files["rows"] and "x98" not in state.files["rows"] and state.runs["run-a"]["batch"] == 99


def test_a_stream_of_many_batches_stays_in_few_files(spark, path):
    from retailloom.sources import topics

    for start in range(0, 18 * 3, 3):
        records(some_events(spark, 3, start=start)).coalesce(1).write.mode("append").parquet(path("topic"))
    query = landing.land_stream(topics.read_record_files(spark, path("topic"), 1), path("landing"), path("checkpoint"), guard="none", compact_every=4)
    query.awaitTermination()
    state = manifest.read_state(spark, path("landing"))
    assert state.runs[query.id]["batch"] == 17 and len(state.of("rows")) <= 4 * 3 + 1 and len(state.of("seen")) <= 4 + 1
    got = pairs(landing.landed(spark, path("landing")))
    assert len(got) == 54 == len(set(got))
    rate = landing.run_progress(spark, path("landing")).first()
    assert (rate.batches, rate.input_rows) == (18, 54) and rate.rows_per_second > 0
    assert landing.progress(spark, path("landing")).where("rows_per_second is null or started_at is null").count() == 0


def test_readers_list_no_data_folders(spark, path, monkeypatch):
    target = path("landing")
    batches(spark, target, range(2))
    asked = []
    monkeypatch.setattr(manifest, "_names", lambda s, folder, real=manifest._names: (asked.append(folder), real(s, folder))[1])
    monkeypatch.setattr(manifest, "listed", lambda *a: pytest.fail("a data folder was listed"))
    assert landing.landed(spark, target).count() == 12
    assert set(asked) == {f"{target}/_log"}
