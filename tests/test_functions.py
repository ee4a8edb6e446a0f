"""Column functions and flattening, with the edge cases of the feeds."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from touchline.functions import columns as fn
from touchline.operators import flatten
from touchline.plans import silver
from touchline.schemas import RAW, STATISTICS


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


@pytest.mark.parametrize(
    ("home", "away", "status", "label"),
    [(2, 1, "FT", "H"), (1, 1, "FT", "D"), (0, 1, "FT", "A"), (None, 1, "FT", None), (1, None, "FT", None),
     (None, None, "FT", None), (2, 1, "NS", None), (2, 1, "AET", None), (2, 1, "PEN", None), (2, 1, None, None)],
)
def test_outcome_label(spark, home, away, status, label):
    row = spark.createDataFrame([(home, away, status)], "h INT, a INT, s STRING")
    assert row.select(fn.outcome_label(F.col("h"), F.col("a"), F.col("s"))).first()[0] == label


def test_outcome_label_wider_statuses(spark):
    row = spark.createDataFrame([(2, 1, "AET")], "h INT, a INT, s STRING")
    assert row.select(fn.outcome_label(F.col("h"), F.col("a"), F.col("s"), ("FT", "AET"))).first()[0] == "H"


def test_local_day_and_instant_differ_across_midnight(spark):
    text = F.lit("2025-04-05T23:30:00-03:00")
    row = one(spark, day=fn.local_day(text), at=fn.instant(text).cast("string"))
    assert row.day == dt.date(2025, 4, 5) and row.at == "2025-04-06 02:30:00"


def test_casts_never_raise(spark):
    row = one(
        spark,
        a=fn.safe_cast(F.lit("x"), "int"),
        b=fn.safe_cast(F.lit("3.0"), "int"),
        c=fn.percent_number(F.lit("57%")),
        d=fn.pct(F.lit("45%")),
        e=fn.local_day(F.lit("never")),
        f=fn.percent_number(F.lit(None).cast("string")),
    )
    assert (row.a, row.b, row.c, row.d, row.e, row.f) == (None, 3, 57.0, 0.45, None, None)


@pytest.mark.parametrize(("p", "band"), [(0.56, "high"), (0.55, "medium"), (0.41, "medium"), (0.40, "low"), (None, None)])
def test_confidence_band(spark, p, band):
    row = spark.createDataFrame([(p,)], "p DOUBLE")
    assert row.select(fn.confidence_band(F.col("p"), F.col("p"))).first()[0] == band


def test_argmax_tie_takes_the_first(spark):
    row = one(spark, v=fn.argmax_label({"H": F.lit(0.4), "D": F.lit(0.2), "A": F.lit(0.4)}))
    assert row.v == "H"


def test_implied_probs_sum_to_one(spark):
    probs = fn.implied_probs({"h": F.lit(1.8), "d": F.lit(3.5), "a": F.lit(4.4)})
    row = one(spark, **probs)
    assert abs(row.h + row.d + row.a - 1) < 1e-12 and row.h > row.d > row.a


def test_surrogate_key_marks_nulls(spark):
    df = spark.createDataFrame([(None, "x"), ("x", None), ("x", "x")], "a STRING, b STRING")
    keys = [r[0] for r in df.select(fn.surrogate_key(F.col("a"), F.col("b"))).collect()]
    assert len(set(keys)) == 3


def test_mask_rules(spark):
    row = one(spark, a=fn.mask(F.lit("Maria"), "initial"), b=fn.mask(F.lit("Maria"), "null"), c=fn.mask(F.lit("Maria"), "hash"))
    assert row.a == "M***" and row.b is None and len(row.c) == 64
    with pytest.raises(ValueError):
        fn.mask(F.lit("x"), "other")


def raw(spark, *payloads, params=None, ts=None, batch="b"):
    at = dt.datetime(2025, 1, 2)
    rows = [
        (p if isinstance(p, str) or p is None else json.dumps(p), "/e", json.dumps(params) if params else None,
         at.date(), (ts[i] if ts else at), batch, "/e")
        for i, p in enumerate(payloads)
    ]
    return spark.createDataFrame(rows, RAW)


def test_statistics_edge_cases(spark):
    def stats(*pairs):
        return {"team": {"id": 7}, "statistics": [{"type": t, "value": v} for t, v in pairs]}

    typed = silver.statistics(
        raw(
            spark,
            stats(("Ball Possession", "57%"), ("Fouls", 11), ("Red Cards", None), ("Fouls", 99), ("expected_goals", "1.25")),
            params={"fixture": "100"},
        )
    ).first()
    assert (typed.fixture_id, typed.team_id, typed.ball_possession, typed.fouls) == (100, 7, 57.0, 11)
    assert typed.red_cards is None and typed.offsides is None and typed.expected_goals == 1.25


def test_statistics_without_array(spark):
    typed = silver.statistics(raw(spark, {"team": {"id": 7}}, params={"fixture": "1"})).first()
    assert typed.total_shots is None


def test_fixture_minimal_malformed_and_versions(spark):
    early, late = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2)
    done = {"fixture": {"id": 100, "status": {"short": "FT"}}, "goals": {"home": 2, "away": 0}}
    df = raw(spark, {"fixture": {"id": 100}}, done, "{broken", {"fixture": {}}, None, ts=[early, late, late, late, late])
    rows = silver.fixtures(df).collect()
    assert [(r.fixture_id, r.status, r.result) for r in rows] == [(100, "FT", "H")]


def test_same_feed_landed_twice_gives_one_row(spark):
    record = {"fixture": {"id": 5, "date": "2025-04-05T23:30:00-03:00"}}
    rows = silver.fixtures(raw(spark, record, record)).collect()
    assert len(rows) == 1 and rows[0].match_date == dt.date(2025, 4, 5)


def test_two_cards_in_one_minute_stay_two_events(spark):
    def card(player):
        return {"time": {"elapsed": 30, "extra": None}, "team": {"id": 1}, "player": {"id": player}, "type": "Card", "detail": "Yellow Card"}

    rows = silver.events(raw(spark, card(1), card(2), card(None), card(None), params={"fixture": "9"})).collect()
    assert sorted((r.player_id or 0) for r in rows) == [0, 1, 2]


def test_odds_empty_levels_are_dropped_by_key(spark):
    long = silver.odds_long(
        raw(
            spark,
            {"fixture": {"id": 1}, "bookmakers": []},
            {"fixture": {"id": 2}, "bookmakers": [{"id": 3, "name": "b", "bets": [{"id": 1, "values": [{"value": "Home", "odd": "1.0"}]}]}]},
        )
    )
    assert [(r.fixture_id, r.outcome, r.odd) for r in long.collect()] == [(2, "Home", 1.0)]
    wide = silver.stg_odds(silver.odds_wide(long))
    assert wide.isEmpty()


def test_match_date_comes_from_fixtures(spark):
    fixtures = spark.createDataFrame([(9, dt.date(2025, 3, 1))], "fixture_id BIGINT, match_date DATE")
    rows = spark.createDataFrame([(9, 1), (10, 1)], "fixture_id BIGINT, team_id BIGINT")
    got = {r.fixture_id: r.match_date for r in silver.with_match_date(rows, fixtures).collect()}
    assert got == {9: dt.date(2025, 3, 1), 10: None}


def test_payload_is_parsed_once(spark):
    plan = silver.fixtures(raw(spark, {"fixture": {"id": 1}}))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    parsed = flatten.parse_payload(raw(spark, {"team": {"id": 1}}), STATISTICS).filter("rec.team.id is not null")
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1


def test_split_valid(spark):
    df = spark.createDataFrame([(1, "a", None), (None, "b", None), (2, None, "{x")], "k INT, v STRING, bad STRING")
    ok, rejected = flatten.split_valid(df, ["k", "v"], "bad")
    assert ok.count() == 1
    assert sorted(r._reject_reason for r in rejected.collect()) == ["malformed", "null_k"]


def test_event_classes(spark):
    df = spark.createDataFrame(
        [("Goal", "Own Goal"), ("Goal", "Penalty"), ("Goal", "Missed Penalty"), ("Card", "Red Card"), ("Card", None), ("subst", "x"), ("Var", None), ("x", None)],
        "t STRING, d STRING",
    )
    got = [r[0] for r in df.select(fn.event_class(F.col("t"), F.col("d"))).collect()]
    assert got == ["own_goal", "goal", "missed_penalty", "red_card", "yellow_card", "substitution", "var", "other"]
