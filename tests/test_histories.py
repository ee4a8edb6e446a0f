"""History tables with an open partition."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from touchline.session import scratch_path
from touchline.sources import histories

STATE = "league BIGINT, team BIGINT, points INT, form STRING"
KEYS, CHECKED = ["league", "team"], ["points", "form"]
D = [dt.date(2025, 1, d) for d in range(1, 9)]


def load(spark, path, day, rows):
    return histories.load_history(spark.createDataFrame(rows, STATE), path, KEYS, CHECKED, day)


def content(spark, path):
    rows = histories.read_history(spark, path, spark.createDataFrame([], STATE).schema)
    return {(r.league, r.team, r.points, r.form, r.valid_from, r.valid_to, r.is_current) for r in rows.collect()}


def files(spark, path):
    return set(spark.read.parquet(path).inputFiles())


def brute(days):
    """Versions of each key by walking through the snapshots."""
    open_, closed = {}, set()
    for day, rows in days:
        for league, team, *state in rows:
            old = open_.get((league, team))
            if old is not None and old[0] == state:
                continue
            if old is not None and old[1] < day:
                closed.add((league, team, *old[0], old[1], day, False))
            open_[league, team] = (state, day)
    return closed | {(*k, *state, since, None, True) for k, (state, since) in open_.items()}


def test_versions_open_and_close(spark):
    path = scratch_path(spark, "history")
    days = [
        (D[0], [(1, 1, 3, "W"), (1, 2, 0, None), (None, 3, 1, "D")]),
        (D[1], [(1, 1, 6, "WW"), (1, 2, 0, None), (None, 3, 1, "D"), (2, 9, 0, "L")]),
        (D[2], [(1, 1, 6, "WW"), (None, 3, 2, "DD")]),  # a key that is missing stays open
    ]
    for day, rows in days:
        assert load(spark, path, day, rows)
    assert content(spark, path) == brute(days)


def test_unchanged_snapshot_writes_nothing_and_old_partitions_stay(spark):
    path = scratch_path(spark, "history")
    load(spark, path, D[0], [(1, 1, 3, "W"), (1, 2, 0, "L")])
    load(spark, path, D[1], [(1, 1, 4, "D")])
    before = files(spark, path)
    assert not load(spark, path, D[2], [(1, 1, 4, "D"), (1, 2, 0, "L")])
    assert files(spark, path) == before
    load(spark, path, D[3], [(1, 1, 7, "W")])
    closed = {f for f in before if "is_current=false" in f}
    assert closed and closed <= files(spark, path)


def test_failed_load_is_repaired_by_the_next_run(spark, monkeypatch):
    path = scratch_path(spark, "history")
    days = [(D[0], [(1, 1, 3, "W"), (1, 2, 0, "L")]), (D[1], [(1, 1, 6, "WW"), (1, 2, 1, "LD")])]
    load(spark, path, *days[0])

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(histories, "overwrite_partitions", fail)
        with pytest.raises(OSError):
            load(spark, path, *days[1])
    load(spark, path, *days[1])
    assert content(spark, path) == brute(days)


def test_same_day_is_corrected_and_the_past_is_not_rewritten(spark):
    path = scratch_path(spark, "history")
    days = [(D[0], [(1, 1, 3, "W")]), (D[2], [(1, 1, 6, "WW")]), (D[2], [(1, 1, 4, "WD")])]
    for day, rows in days:
        load(spark, path, day, rows)
    assert content(spark, path) == brute(days)
    with pytest.raises(ValueError):
        load(spark, path, D[1], [(1, 1, 9, "X")])
    with pytest.raises(ValueError):
        load(spark, path, D[3], [(1, 1, 9, "X"), (1, 1, 8, "Y")])
    assert content(spark, path) == brute(days)


def test_empty_snapshots(spark):
    path = scratch_path(spark, "history")
    load(spark, path, D[0], [(1, 1, 3, "W")])
    assert not load(spark, path, D[1], [])
    assert content(spark, path) == {(1, 1, 3, "W", D[0], None, True)}


def test_state_on_a_day_reads_few_partitions(spark):
    path = scratch_path(spark, "history")
    for i in range(5):
        load(spark, path, D[i], [(1, 1, i, "W"), (1, 2, 0, "L")])
    rows = histories.read_history(spark, path, spark.createDataFrame([], STATE).schema)
    for i in range(5):
        found = histories.state_on(rows, D[i])
        assert {(r.team, r.points) for r in found.collect()} == {(1, i), (2, 0)}
    late = histories.state_on(rows, D[4]).select(F.input_file_name().alias("f")).distinct().collect()
    assert all("is_current=true" in r.f for r in late)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(st.integers(0, 4), st.integers(0, 2), min_size=1), min_size=2, max_size=4))
def test_histories_equal_a_walk_through_the_snapshots(spark, snapshots):
    path = scratch_path(spark, "history")
    days = [(D[i], [(1, team, points, "W" * points) for team, points in rows.items()]) for i, rows in enumerate(snapshots)]
    for day, rows in days:
        load(spark, path, day, rows)
    assert content(spark, path) == brute(days)
