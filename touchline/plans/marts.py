"""Feature, form, strength and dimension marts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.columns import argmax_label, confidence_band, pair_key
from touchline.operators.aggregates import (
    head_to_head,
    injury_features,
    odds_consensus,
    pair_rows,
    standings_table,
    team_season_stats,
)
from touchline.operators.elo import EloRule, current_ratings, elo_ratings, team_ratings
from touchline.operators.flatten import to_team_rows
from touchline.operators.form import form_at_end, rolling_form
from touchline.operators.joins import flag_pairs, left_join_all
from touchline.operators.ordered import asof_join, join_safe, with_lookback
from touchline.session import stored

FORM = ("wins_last_5", "draws_last_5", "losses_last_5", "goals_scored_avg_5", "goals_conceded_avg_5", "points_last_5")
H2H = ("h2h_total_games", "h2h_home_wins", "h2h_draws", "h2h_away_wins", "h2h_home_goals_avg", "h2h_away_goals_avg")


def played_rows(fixtures: DataFrame) -> DataFrame:
    """Team rows of finished matches."""
    return to_team_rows(fixtures.filter(F.col("result").isNotNull()))


def team_form(fixtures: DataFrame, rated: DataFrame | None = None, n: int = 5) -> DataFrame:
    """Form of each team after each match, with its rating when ``rated`` is given."""
    return _with_ratings(rolling_form(played_rows(fixtures), n, "after"), rated)


def newest_form(fixtures: DataFrame, rated: DataFrame | None = None, n: int = 5, within: tuple[str, ...] = ()) -> DataFrame:
    """The last row of :func:`team_form` of each team, or of each team and value of ``within``."""
    return _with_ratings(form_at_end(played_rows(fixtures), n, within=within), rated)


def _with_ratings(form: DataFrame, rated: DataFrame | None) -> DataFrame:
    form = form.withColumn("reference_date", F.col("match_date"))
    if rated is None:
        return form
    ratings = team_ratings(rated).select("fixture_id", "team_id", "elo_after")
    return form.join(ratings, ["fixture_id", "team_id"], "left").withColumn(
        "elo_rating", F.round("elo_after").cast("int")
    )


def team_strength(fixtures: DataFrame, rule: EloRule = EloRule()) -> DataFrame:
    """Current rating per pool and team."""
    return current_ratings(elo_ratings(fixtures, rule=rule))


def standings_on(played: DataFrame, day: dt.date) -> DataFrame:
    """Every season's table after the matches up to ``day``: position, points and the form of the last match.

    ``played`` is :func:`team_form`, one row per team and played match.
    """
    known = played.filter(F.col("match_date") <= F.lit(day))
    last = F.max(F.struct("match_date", "fixture_id", "form_string")).getField("form_string").alias("form")
    form = known.groupBy("league_id", "season", "team_id").agg(last)
    table = standings_table(team_season_stats(known))
    return table.join(form, ["league_id", "season", "team_id"]).select("league_id", "season", "team_id", "position", "points", "form")


def meeting_features(fixtures: DataFrame, n: int = 10) -> DataFrame:
    """Record of the pair over its last ``n`` meetings strictly before each fixture, seen from its home side."""
    sums = ("a_win", "draw", "b_win", "a_goals", "b_goals")

    def total(c: str):
        return lambda w: F.sum(c).over(w.rowsBetween(-(n - 1), 0))

    running = with_lookback(
        pair_rows(fixtures),
        ["league_id", "team_a", "team_b"],
        ("match_date", "fixture_id"),
        n,
        {
            "_games": lambda w: F.count(F.lit(1)).over(w.rowsBetween(-(n - 1), 0)),
            **{f"_{c}": total(c) for c in sums},
        },
        sums,
    )
    low, high = pair_key(F.col("home_team_id"), F.col("away_team_id"))
    asked = fixtures.select(
        "fixture_id",
        "league_id",
        "match_date",
        low.alias("team_a"),
        high.alias("team_b"),
        (F.col("home_team_id") <= F.col("away_team_id")).alias("_straight"),
    )
    found = asof_join(
        asked,
        running.withColumnRenamed("fixture_id", "_meeting"),
        ["league_id", "team_a", "team_b"],
        "match_date",
        "match_date",
        ["_games", *[f"_{c}" for c in sums]],
        ["_meeting"],
        matched_ts="h2h_source_date",
    )

    def pick(a: str, b: str) -> Column:
        return F.when(F.col("_straight"), F.col(a)).otherwise(F.col(b))

    games = F.nullif("_games", F.lit(0))
    return found.select(
        "fixture_id",
        F.coalesce("_games", F.lit(0)).cast("int").alias("h2h_total_games"),
        F.coalesce(pick("_a_win", "_b_win"), F.lit(0)).cast("int").alias("h2h_home_wins"),
        F.coalesce("_draw", F.lit(0)).cast("int").alias("h2h_draws"),
        F.coalesce(pick("_b_win", "_a_win"), F.lit(0)).cast("int").alias("h2h_away_wins"),
        F.try_divide(pick("_a_goals", "_b_goals"), games).alias("h2h_home_goals_avg"),
        F.try_divide(pick("_b_goals", "_a_goals"), games).alias("h2h_away_goals_avg"),
        "h2h_source_date",
    )


def side_features(fixtures: DataFrame, state: DataFrame, standings: DataFrame) -> DataFrame:
    """Form, rating, rest days, venue form and standing of each team strictly before each day it plays, by side.

    One row per league, team, side and day: matches of one team on one day have the same past, so it is looked up once.
    ``state`` has :func:`team_form` with ratings, all rows or the last one of each team and day.
    """
    asked = to_team_rows(fixtures).select("league_id", "team_id", "is_home", "match_date").distinct()
    known = state.select("team_id", "match_date", F.col("fixture_id").alias("_match"), *FORM, "elo_after")
    found = asof_join(
        asked, known, ["team_id"], "match_date", "match_date", [*FORM, "elo_after"], ["_match"], matched_ts="form_source_date"
    )
    venue = form_at_end(played_rows(fixtures), 5, ("team_id", "is_home"), ("match_date",)).select(
        "team_id", "is_home", "match_date", F.col("fixture_id").alias("_match"), F.col("wins_last_5").alias("venue_wins_last_5")
    )
    found = asof_join(
        found, venue, ["team_id", "is_home"], "match_date", "match_date", ["venue_wins_last_5"], ["_match"]
    )
    found = asof_join(
        found,
        standings,
        ["league_id", "team_id"],
        "match_date",
        "_snapshot_date",
        ["position", "points"],
        ["season"],
        matched_ts="standing_source_date",
    )
    counts = ["venue_wins_last_5", *[c for c in FORM if "avg" not in c]]
    return found.withColumns(
        {
            **{c: F.coalesce(F.col(c), F.lit(0)) for c in counts},
            "elo_rating": F.round(F.coalesce("elo_after", F.lit(EloRule().start))).cast("int"),
            "days_since_last_match": F.date_diff("match_date", "form_source_date"),
        }
    ).drop("elo_after")


def with_sides(rows: DataFrame, sides: DataFrame) -> DataFrame:
    """Matches with the :func:`side_features` of both teams."""
    names = {"days_since_last_match": "days_since_last_match_{side}", "venue_wins_last_5": "{side}_{side}_wins_last_5"}
    keys = ("league_id", "team_id", "is_home", "match_date")
    for side in ("home", "away"):
        own = sides.filter(F.col("is_home") == F.lit(side == "home")).select(
            "league_id",
            F.col("team_id").alias(f"{side}_team_id"),
            "match_date",
            *[F.col(c).alias(names.get(c, "{side}_" + c).format(side=side)) for c in sides.columns if c not in keys],
        )
        rows = join_safe(rows, own, ["league_id", f"{side}_team_id", "match_date"], "left")
    return rows.withColumns(
        {f"{short}_diff": F.col(f"home_{c}") - F.col(f"away_{c}") for short, c in (("elo", "elo_rating"), ("position", "position"))}
    )


def injury_lists(injuries: DataFrame, key: DataFrame) -> DataFrame:
    """Injured players and injured key players per fixture, an entry for each of its teams."""
    counts = injury_features(injuries, key)
    entry = F.struct("team_id", "injuries_count", "key_players_out")
    return counts.groupBy("fixture_id").agg(F.collect_list(entry).alias("_injured"))


def _injured(side: str, name: str) -> Column:
    own = F.filter("_injured", lambda e: e["team_id"] == F.col(f"{side}_team_id"))
    return F.coalesce(F.get(own, F.lit(0))[name], F.lit(0)).alias(f"{side}_{name}")


def with_context(rows: DataFrame, derbies: DataFrame, leagues: DataFrame) -> DataFrame:
    """Add ``is_derby`` and ``is_cup_match``."""
    kinds = leagues.select("league_id", F.lower("league_type").alias("_type")).distinct()
    flagged = flag_pairs(rows, derbies, "home_team_id", "away_team_id").join(kinds, "league_id", "left")
    return flagged.withColumn("is_cup_match", F.coalesce(F.col("_type") == "cup", F.lit(False))).drop("_type")


def match_context(fixtures: DataFrame, derbies: DataFrame, leagues: DataFrame) -> DataFrame:
    """``is_derby`` and ``is_cup_match`` per fixture."""
    rows = fixtures.select("fixture_id", "league_id", "home_team_id", "away_team_id")
    return with_context(rows, derbies, leagues).select("fixture_id", "is_derby", "is_cup_match")


def match_features(
    fixtures: DataFrame,
    state: DataFrame,
    odds: DataFrame,
    standings: DataFrame,
    injuries: DataFrame,
    key: DataFrame,
    api: DataFrame,
    derbies: DataFrame,
    leagues: DataFrame,
) -> DataFrame:
    """One row per fixture with every feature known before the match, and the result as target.

    What a team brings is stored by team and day and joined once per side; sets keyed by ``fixture_id`` share one
    partitioning.
    """
    consensus = odds_consensus(odds).select(
        "fixture_id", "odd_home_avg", "odd_draw_avg", "odd_away_avg", "odd_home_max", "odd_away_max"
    )
    external = api.select(
        "fixture_id",
        F.col("pred_home_pct").alias("api_pred_home_pct"),
        F.col("pred_draw_pct").alias("api_pred_draw_pct"),
        F.col("pred_away_pct").alias("api_pred_away_pct"),
    )
    base = fixtures.select(
        "fixture_id", "league_id", "season", "round", "match_date", "home_team_id", "away_team_id", "result"
    )
    sides = stored(side_features(fixtures, state, standings), "sides")
    joined = left_join_all(
        with_context(with_sides(base, sides), derbies, leagues),
        ["fixture_id"],
        meeting_features(fixtures),
        consensus,
        injury_lists(injuries, key),
        external,
    )

    def both(*names: str) -> list[str]:
        return [n.format(side=side) for side in ("home", "away") for n in names]

    return joined.select(
        *base.columns,
        *both(*["{side}_" + c for c in FORM], "{side}_elo_rating", "days_since_last_match_{side}", "{side}_form_source_date"),
        "elo_diff",
        *both("{side}_{side}_wins_last_5"),
        *H2H,
        "h2h_source_date",
        *consensus.columns[1:],
        *both("{side}_position", "{side}_points", "{side}_standing_source_date"),
        "position_diff",
        *[_injured(side, name) for side in ("home", "away") for name in ("injuries_count", "key_players_out")],
        *external.columns[1:],
        "is_derby",
        "is_cup_match",
        F.greatest(
            "home_form_source_date",
            "away_form_source_date",
            "h2h_source_date",
            "home_standing_source_date",
            "away_standing_source_date",
        ).alias("max_source_date"),
    )


def prediction_rows(scored: DataFrame, version: str | Column, at: Column) -> DataFrame:
    """Stored form of scored fixtures: label, confidence band, version and time."""
    probs: Mapping[str, Column] = {"H": F.col("prob_home_win"), "D": F.col("prob_draw"), "A": F.col("prob_away_win")}
    return scored.withColumns(
        {
            "predicted_result": argmax_label(probs),
            "confidence": confidence_band(*probs.values()),
            "model_version": F.lit(version) if isinstance(version, str) else version,
            "generated_at": at,
        }
    )


def document_rows(predictions: DataFrame, fixtures: DataFrame, rated: DataFrame, odds: DataFrame) -> DataFrame:
    """What a prediction's document tells: newest form and rating of both teams, their last five meetings, mean prices."""
    form = newest_form(fixtures)
    state = form.select("team_id", F.col("form_string").alias("form")).join(
        current_ratings(rated).select("team_id", F.round("rating").cast("int").alias("elo")), "team_id", "full"
    )
    rows = predictions
    for side in ("home", "away"):
        named = state.select(F.col("team_id").alias(f"{side}_team_id"), *[F.col(n).alias(f"{side}_{n}") for n in ("form", "elo")])
        rows = rows.join(named, f"{side}_team_id", "left")
    meetings = head_to_head(fixtures, 5).select(
        "league_id", "home_team_id", "away_team_id", F.col("home_wins").alias("h2h_wins"),
        F.col("draws").alias("h2h_draws"), F.col("away_wins").alias("h2h_losses"),
    )
    prices = odds_consensus(odds).select("fixture_id", *[F.col(f"odd_{o}_avg").alias(f"odd_{o}") for o in ("home", "draw", "away")])
    named = {f"{side}_team_name": F.concat(F.lit("Team "), f"{side}_team_id") for side in ("home", "away")}
    return (
        rows.join(meetings, ["league_id", "home_team_id", "away_team_id"], "left")
        .join(prices, "fixture_id", "left")
        .withColumns({"league_name": F.concat(F.lit("League "), "league_id"), **named})
    )


def dim_teams(teams: DataFrame) -> DataFrame:
    return teams.select(
        "team_id", "team_name", "team_code", "country", "founded", "logo_url", "venue_name", "venue_city", "venue_capacity"
    )


def dim_leagues(leagues: DataFrame) -> DataFrame:
    return leagues.select("league_id", "league_name", "league_type", "country", "logo_url", "flag_url", "season")


def dim_players(players: DataFrame) -> DataFrame:
    return players.select("player_id", "season", "player_name", "position", "nationality", "team_id")
