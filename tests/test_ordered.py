"""Ordered operators: the hot-key path must equal the plain window."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from touchline.operators.form import days_since_last, rolling_form
from touchline.operators.history import scd2_from_log
from touchline.operators.ordered import (
    Skew,
    asof_join,
    dedup_latest,
    global_row_number,
    hot_keys,
    latest_snapshot,
    top_k_per_group,
    with_chunks,
)

TINY = Skew(rows_per_chunk=7, fine_width=16)


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def matches(spark, seed, days=20, n=200, hot_day=False):
    """Team 1 holds most rows; with ``hot_day`` most of them fall on one day."""
    rng = random.Random(seed)
    start = dt.date(2024, 1, 1)
    data = []
    for i in range(n):
        team = 1 if rng.random() < 0.7 else rng.choice([2, 3, None])
        day = start + dt.timedelta(days=3 if hot_day and rng.random() < 0.8 else rng.randrange(days))
        data.append((team, i, day, rng.choice("WDL"), rng.randrange(5), rng.randrange(5), rng.random() < 0.5))
    return spark.createDataFrame(
        data,
        "team_id BIGINT, fixture_id BIGINT, match_date DATE, outcome STRING, goals_for INT, goals_against INT, is_home BOOLEAN",
    )


@pytest.mark.parametrize("hot_day", [False, True])
@pytest.mark.parametrize("as_of", ["after", "before"])
def test_rolling_form_split_equals_plain(spark, hot_day, as_of):
    df = matches(spark, 1, hot_day=hot_day)
    assert hot_keys(df, ["team_id"], TINY) is not None
    split = rolling_form(df, 5, as_of, skew=TINY)
    plain = rolling_form(df, 5, as_of, skew=None)
    assert rows_of(split) == rows_of(plain)
    total = F.col("wins_last_5") + F.col("draws_last_5") + F.col("losses_last_5")
    assert split.filter((total != F.col("games_last_5")) | (F.col("games_last_5") > 5)).isEmpty()


def test_chunks_are_bounded_and_ordered(spark):
    df = matches(spark, 2, n=400, hot_day=True)
    chunked = with_chunks(df, ["team_id"], ["match_date", "fixture_id"], TINY)
    sizes = chunked.filter("_chunk is not null").groupBy("team_id", "_chunk").count()
    # At most one bound of whole days or id ranges plus the piece that crosses it.
    assert sizes.agg(F.max("count")).first()[0] <= TINY.rows_per_chunk + TINY.fine_width
    rows = chunked.filter("team_id = 1").orderBy("match_date", "fixture_id").select("_chunk").collect()
    labels = [tuple(r._chunk) for r in rows]
    assert labels == sorted(labels)


def test_by_venue_and_first_match(spark):
    df = matches(spark, 3)
    assert rows_of(rolling_form(df, 5, "before", by_venue=True, skew=TINY)) == rows_of(
        rolling_form(df, 5, "before", by_venue=True, skew=None)
    )
    first = rolling_form(df, 5, "before", skew=None).filter("games_last_5 = 0")
    assert first.filter("wins_last_5 <> 0 or form_string <> ''").isEmpty()
    assert first.count() == df.select("team_id").distinct().count()


def test_rest_days(spark):
    rows = [(1, 1, dt.date(2024, 1, 1)), (1, 2, dt.date(2024, 1, 4)), (1, 3, dt.date(2024, 2, 1))]
    df = spark.createDataFrame(rows, "team_id INT, fixture_id INT, match_date DATE")
    got = {r.fixture_id: r.rest_days for r in days_since_last(df).collect()}
    assert got == {1: None, 2: 3, 3: 28}


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("hot_day", [False, True])
def test_asof_split_equals_brute_force(spark, strict, hot_day):
    left = matches(spark, 4, n=150, hot_day=hot_day).select("team_id", "fixture_id", "match_date")
    right = matches(spark, 5, n=150, hot_day=hot_day).select(
        "team_id", F.col("match_date").alias("at"), F.col("fixture_id").alias("rid"), F.col("goals_for").alias("v")
    )
    want = {}
    rights = right.collect()
    for row in left.collect():
        before = [
            r for r in rights
            if r.team_id == row.team_id and (r["at"] < row.match_date or (not strict and r["at"] == row.match_date))
        ]
        best = max(before, key=lambda r: (r["at"], r.rid), default=None)
        want[row.fixture_id] = (best and best.v, best and best.rid, best and best["at"])
    for skew in (TINY, None):
        out = asof_join(left, right, ["team_id"], "match_date", "at", ["v", "rid"], ["rid"], strict, "seen", skew)
        assert {r.fixture_id: (r.v, r.rid, r.seen) for r in out.collect()} == want


def test_asof_with_timestamps(spark):
    base = matches(spark, 6, n=150, hot_day=True)
    ts = (F.col("match_date").cast("timestamp") + F.make_dt_interval(secs=F.col("fixture_id") % 50)).alias("ts")
    left = base.select("team_id", "fixture_id", ts)
    right = base.select("team_id", F.col("fixture_id").alias("rid"), ts).filter("rid % 3 = 0")
    args = (["team_id"], "ts", "ts", ["rid"], ["rid"])
    assert rows_of(asof_join(left, right, *args, skew=TINY)) == rows_of(asof_join(left, right, *args, skew=None))


def test_scd2_split_equals_plain(spark):
    log = matches(spark, 7, hot_day=True).select("team_id", "match_date", "fixture_id", "outcome")
    args = (["team_id"], ["outcome"], ["match_date", "fixture_id"])
    split = scd2_from_log(log, *args, skew=TINY)
    assert rows_of(split) == rows_of(scd2_from_log(log, *args, skew=None))
    assert split.groupBy("team_id").agg(F.count_if("is_current").alias("n")).filter("n <> 1").isEmpty()
    by_team = {}
    for row in split.orderBy("team_id", "match_date", "fixture_id").collect():
        by_team.setdefault(row.team_id, []).append((row.valid_from, row.valid_to))
    for spans in by_team.values():
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False)) and spans[-1][1] is None


def test_dedup_latest_ties_are_deterministic(spark):
    rows = [(1, "2024-01-01", "b1", "x"), (1, "2024-01-01", "b1", "y"), (2, "2024-01-01", "b1", "z"), (2, "2024-01-02", "b0", "w")]
    df = spark.createDataFrame(rows, "k INT, ts STRING, batch STRING, v STRING")
    once = rows_of(dedup_latest(df, ["k"], ["ts", "batch"]))
    again = rows_of(dedup_latest(df.orderBy(F.desc("v")).repartition(3), ["k"], ["ts", "batch"]))
    assert once == again and len(once) == 2
    assert dedup_latest(df, ["k"], ["ts"]).filter("k = 2").first().v == "w"


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5)), min_size=1, max_size=20))
def test_dedup_latest_is_the_maximum(spark, rows):
    df = spark.createDataFrame(rows, "k INT, ts INT")
    got = {r.k: r.ts for r in dedup_latest(df, ["k"], ["ts"]).collect()}
    assert got == {k: max(t for j, t in rows if j == k) for k, _ in rows}


def test_dedup_and_top_k_use_the_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 5).alias("k"), F.col("id").alias("v"))
    for out in (dedup_latest(df, ["k"], ["v"]), top_k_per_group(df, ["k"], [F.desc("v")], 3)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("WindowGroupLimit") == 2


def test_global_row_number(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 5003).alias("k"))
    numbered = global_row_number(df, ["k"]).orderBy("k").collect()
    assert [r.row_no for r in numbered] == list(range(1, 1001))


@pytest.mark.parametrize("hot", [0.0, 0.9, 1.0])
def test_global_row_number_with_one_hot_first_key(spark, hot):
    df = spark.range(2000).select(F.when(F.col("id") % 100 < hot * 100, 7).otherwise(F.col("id") % 11).alias("k"), "id")
    df = df.withColumn("id", F.when(F.col("id") != 5, F.col("id")))
    rows = global_row_number(df.repartition(5), ["k", "id"]).orderBy("row_no").collect()
    assert [r.row_no for r in rows] == list(range(1, 2001))
    assert [(r.k, r.id) for r in rows] == sorted(((r.k, r.id) for r in rows), key=lambda x: (x[0], x[1] is not None, x[1] or 0))


def test_latest_snapshot_keeps_all_rows(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 6), (1, 2, 7), (2, 1, 8)], "k INT, ts INT, v INT")
    assert sorted(r.v for r in latest_snapshot(df, ["k"], "ts").collect()) == [6, 7, 8]


def test_typed_loads_shuffle_records_and_not_their_unfolded_rows(spark):
    """Records of a key meet before their arrays are unfolded, so every unfolding is above the only shuffle."""
    from touchline.plans import silver

    raw = spark.createDataFrame(
        [], "payload STRING, params STRING, _ingestion_ts TIMESTAMP, _batch_id STRING"
    )
    for load, unfolded in ((silver.odds_long, ("_bet", "_price")), (silver.lineups, ("e",))):
        plan = load(raw)._jdf.queryExecution().sparkPlan().toString()
        prepared = load(raw)._jdf.queryExecution().executedPlan().toString()
        assert prepared.count("Exchange ") == 1, (load.__name__, plan)
        below = prepared[prepared.index("Exchange ") :]
        assert not [name for name in unfolded if f"[{name}#" in below.replace(", [", "[")], load.__name__


def test_requests_are_read_once_and_player_rows_sorted_once(spark):
    """The key filter does not read the request a second time; rows of a player meet before they are sorted."""
    from touchline.plans import silver

    when, player = dt.datetime(2024, 5, 1), '{"team":{"id":1},"players":[{"player":{"id":7},"statistics":[{"goals":{"total":%d}}]}]}'
    landed = [
        (player % 1, '{"fixture":"5"}', when, "b1"),
        (player % 2, '{"fixture":"5"}', when + dt.timedelta(days=1), "b1"),
        (player % 3, '{"fixture":"six"}', when, "b1"),
        (player % 4, None, when, "b1"),
        ("{", '{"fixture":"5"}', when, "b1"),
        ('{"team":{"id":1},"players":[{"player":{"id":8}}]}', '{"fixture":5}', when, "b1"),
    ]
    raw = spark.createDataFrame(landed, "payload STRING, params STRING, _ingestion_ts TIMESTAMP, _batch_id STRING")
    kept = silver.player_stats(raw).select("fixture_id", "team_id", "player_id", "goals").collect()
    assert sorted(map(tuple, kept)) == [(5, 1, 7, 2), (5, 1, 8, None)]
    for load in (silver.statistics, silver.events, silver.lineups, silver.player_stats, silver.api_predictions):
        plan = load(raw)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("get_json_object(") == 1, load.__name__
    plan = silver.player_stats(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.count("Exchange ") == 1
