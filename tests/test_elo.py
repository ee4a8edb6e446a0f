"""Ratings against a plain fold, resumed runs, slabs, and levels of a day."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from touchline.operators import elo

SCHEMA = (
    "fixture_id BIGINT, league_id BIGINT, season INT, match_date DATE, home_team_id BIGINT, away_team_id BIGINT,"
    " goals_home INT, goals_away INT, result STRING, k DOUBLE"
)


def season_rows(seed=1, days=60, teams=6, pools=3):
    """Each team plays once per day at most; two seasons."""
    rng, rows, fixture = random.Random(seed), [], 0
    for day in range(days):
        for pool in range(pools):
            order = list(range(teams))
            rng.shuffle(order)
            for a, b in zip(order[::2], order[1::2], strict=True):
                h, w = rng.randrange(4), rng.randrange(4)
                label = "H" if h > w else "D" if h == w else "A"
                fixture += 1
                season = 2024 if day < days // 2 else 2025
                played = rng.random() < 0.9
                rows.append(
                    (fixture, pool, season, dt.date(2024, 6, 1) + dt.timedelta(days=day * 6), pool * 10 + a, pool * 10 + b,
                     h if played else None, w if played else None, label if played else None, rng.choice([20.0, 30.0, 40.0]))
                )
    return rows


def plain(rows, k=None):
    ratings, seasons, out = {}, {}, {}
    for fixture, _, season, day, home, away, h, w, label, row_k in sorted(rows, key=lambda r: (r[3], r[0])):
        if label is None:
            continue
        for team in (home, away):
            if team not in ratings:
                ratings[team] = 1500.0
            elif seasons[team] < season:
                ratings[team] = 1500 + 0.9 * (ratings[team] - 1500)
            seasons[team] = season
        expected = 1 / (1 + 10 ** ((ratings[away] - ratings[home] - 100) / 400))
        gain = (row_k if k else 20) * ({"H": 1, "D": 0.5, "A": 0}[label] - expected) * math.log(abs(h - w) + 1)
        before = (ratings[home], ratings[away])
        ratings[home] += gain
        ratings[away] -= gain
        out[fixture] = (*before, ratings[home], ratings[away])
    return out, ratings


def values(df):
    return {r.fixture_id: (r.home_before, r.away_before, r.home_after, r.away_after) for r in df.collect()}


def close(a, b):
    return a.keys() == b.keys() and all(math.isclose(x, y, abs_tol=1e-9) for k in a for x, y in zip(a[k], b[k], strict=True))


@pytest.fixture(scope="module")
def rows():
    return season_rows()


def test_equals_plain_fold(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert close(values(elo.elo_ratings(df)), plain(rows)[0])
    assert close(values(elo.elo_ratings(df, k="k")), plain(rows, "k")[0])


def test_resume_gives_the_same(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    cut = F.lit(dt.date(2024, 9, 1))
    first = elo.elo_ratings(df.filter(F.col("match_date") < cut))
    second = elo.elo_ratings(df.filter(F.col("match_date") >= cut), init=elo.current_ratings(first))
    assert close(values(first) | values(second), plain(rows)[0])


def test_by_period_gives_the_same(spark, rows):
    path = elo.elo_by_period(spark.createDataFrame(rows, SCHEMA))
    assert close(values(spark.read.parquet(path)), plain(rows)[0])


@pytest.mark.parametrize("rows_per_task", [1, 37, 100_000])
def test_slabs_of_any_size_give_the_same(spark, rows, rows_per_task):
    few = rows if rows_per_task > 1 else rows[:24]
    rated = elo.elo_ratings(spark.createDataFrame(few, SCHEMA), rows_per_task=rows_per_task)
    assert close(values(rated), plain(few)[0])
    most = len({r.rsplit("/", 2)[1] for r in rated.inputFiles()})
    played = [sum(r[1] == pool and r[8] is not None for r in few) for pool in range(3)]
    assert most == -(-max(played) // rows_per_task)


def test_long_histories_have_a_bounded_number_of_slabs(spark, rows):
    """Slabs run one after another: with one match each, their number followed the length of the history."""
    long = [(r[0], 0, *r[2:]) for r in rows if r[8] is not None][:200]
    rated = elo.elo_ratings(spark.createDataFrame(long, SCHEMA), rows_per_task=1)
    assert close(values(rated), plain(long)[0])
    assert len({r.rsplit("/", 2)[1] for r in rated.inputFiles()}) == 50  # four matches each


def test_no_matches(spark):
    assert elo.elo_ratings(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_by_level_gives_the_same(spark, rows):
    """Days on which teams play several times, pools mixed."""
    few = [(*r[:3], dt.date(2024, 6, 1 + i // 30), *r[4:]) for i, r in enumerate(rows[:90])]
    path = elo.elo_by_level(spark.createDataFrame(few, SCHEMA))
    assert close(values(spark.read.parquet(path)), plain(few)[0])


def test_levels_are_the_longest_chains(spark, rows):
    few = [(*r[:3], dt.date(2024, 6, 1), *r[4:]) for r in rows[:80]]
    matches = spark.createDataFrame(few, SCHEMA).withColumn("pool", F.col("league_id"))
    got = {r.fixture_id: r.level for r in elo.day_levels(matches).collect()}
    last, want = {}, {}
    for fixture, _, _, _, home, away, *_ in sorted(few):
        want[fixture] = last[home] = last[away] = 1 + max(last.get(home, 0), last.get(away, 0))
    assert got == want and max(want.values()) > 5


def test_draw_moves_nothing_unless_a_minimum_margin_is_set(spark):
    row = (1, 1, 2024, dt.date(2024, 1, 1), 1, 2, 1, 1, "D", 20.0)
    df = spark.createDataFrame([row], SCHEMA)
    still = elo.elo_ratings(df).first()
    assert still.home_before == still.home_after == 1500.0
    moved = elo.elo_ratings(df, rule=elo.EloRule(min_margin=1)).first()
    assert moved.home_after < 1500 < moved.away_after


def test_violations(spark, rows):
    rated = elo.elo_ratings(spark.createDataFrame(rows, SCHEMA))
    assert elo.elo_violations(rated).isEmpty()
    broken = rated.withColumn("home_after", F.when(F.col("fixture_id") == min(plain(rows)[0]), 3000.0).otherwise(F.col("home_after")))
    assert elo.elo_violations(broken).first().reason == "out_of_range"


def test_stream_resumes_and_marks_late_matches(spark):
    """Landings in order equal the batch; a match of an earlier day is rated as it comes."""
    from touchline.session import scratch_path
    from touchline.streaming import live

    schema = (
        "league_id BIGINT, fixture_id BIGINT, match_date DATE, season INT, home_team_id BIGINT, away_team_id BIGINT,"
        " goals_home INT, goals_away INT, result STRING"
    )
    days = [dt.date(2024, 8, 1) + dt.timedelta(days=i) for i in range(6)]
    played = [(pool, 10 * i + pool, days[i], 2024, i % 3, (i + 1) % 3, i % 4, (i * pool) % 3, "x") for i in range(6) for pool in (1, 2)]
    root = scratch_path(spark, "rate")
    landings = [played[4:8], played[8:], played[:2]]
    for rows in landings:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{root}/in")
        live.run_to_table(elo.elo_stream(live.raw_stream(spark, f"{root}/in", schema)), f"{root}/out", f"{root}/checkpoint")
    columns = ["fixture_id", "home_before", "away_before", "home_after", "away_after"]
    found = spark.read.parquet(f"{root}/out")
    on_time = {tuple(r) for r in found.filter("NOT late").select(columns).collect()}
    batch = elo.elo_ratings(spark.createDataFrame(played[4:], schema)).select(columns)
    assert on_time == {tuple(r) for r in batch.collect()}
    assert {r.fixture_id for r in found.filter("late").collect()} == {1, 2}
