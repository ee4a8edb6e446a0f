"""Payload schemas, feed registry and table specs.

Entity ids are BIGINT throughout: the row counts this is built for do not fit 32 bits.
"""

from __future__ import annotations

from dataclasses import dataclass

RAW = (
    "payload STRING, endpoint STRING, params STRING, _ingestion_date DATE, _ingestion_ts TIMESTAMP, "
    "_batch_id STRING, _source_endpoint STRING"
)

# The payloads of the feeds, field by field as they come.
FIXTURE = (
    "fixture STRUCT<id: BIGINT, date: STRING, referee: STRING, status: STRUCT<short: STRING>,"
    " venue: STRUCT<name: STRING>>,"
    " league STRUCT<id: BIGINT, name: STRING, season: INT, round: STRING>,"
    " teams STRUCT<home: STRUCT<id: BIGINT, name: STRING>, away: STRUCT<id: BIGINT, name: STRING>>,"
    " goals STRUCT<home: INT, away: INT>"
)
STATISTICS = "team STRUCT<id: BIGINT>, statistics ARRAY<STRUCT<type: STRING, value: STRING>>"
EVENTS = (
    "time STRUCT<elapsed: INT, extra: INT>, team STRUCT<id: BIGINT>,"
    " player STRUCT<id: BIGINT, name: STRING>, type STRING, detail STRING"
)
ODDS = (
    "fixture STRUCT<id: BIGINT>, bookmakers ARRAY<STRUCT<id: BIGINT, name: STRING,"
    " bets: ARRAY<STRUCT<id: BIGINT, name: STRING, values: ARRAY<STRUCT<value: STRING, odd: STRING>>>>>>"
)
STANDINGS = (
    "league STRUCT<id: BIGINT, name: STRING, season: INT, standings: ARRAY<ARRAY<STRUCT<"
    "rank: INT, team: STRUCT<id: BIGINT, name: STRING>, points: INT, goalsDiff: INT, group: STRING,"
    " form: STRING, status: STRING, description: STRING,"
    " all: STRUCT<played: INT, win: INT, draw: INT, lose: INT, goals: STRUCT<`for`: INT, against: INT>>>>>>"
)
INJURIES = (
    "player STRUCT<id: BIGINT, name: STRING, type: STRING, reason: STRING>, team STRUCT<id: BIGINT>,"
    " fixture STRUCT<id: BIGINT, date: STRING>, league STRUCT<id: BIGINT, season: INT>"
)
LINEUPS = (
    "team STRUCT<id: BIGINT>, formation STRING,"
    " startXI ARRAY<STRUCT<player: STRUCT<id: BIGINT, name: STRING, number: INT, pos: STRING>>>,"
    " substitutes ARRAY<STRUCT<player: STRUCT<id: BIGINT, name: STRING, number: INT, pos: STRING>>>"
)
PLAYER_STATS = (
    "team STRUCT<id: BIGINT>, players ARRAY<STRUCT<player: STRUCT<id: BIGINT, name: STRING>,"
    " statistics: ARRAY<STRUCT<games: STRUCT<minutes: INT, rating: STRING>,"
    " goals: STRUCT<total: INT, assists: INT>, shots: STRUCT<total: INT, `on`: INT>,"
    " passes: STRUCT<total: INT, key: INT, accuracy: STRING>, tackles: STRUCT<total: INT, interceptions: INT>,"
    " duels: STRUCT<total: INT, won: INT>, dribbles: STRUCT<success: INT>,"
    " fouls: STRUCT<drawn: INT, committed: INT>, cards: STRUCT<yellow: INT, red: INT>>>>>"
)
TEAMS = (
    "team STRUCT<id: BIGINT, name: STRING, code: STRING, country: STRING, founded: INT, logo: STRING>,"
    " venue STRUCT<name: STRING, city: STRING, capacity: INT>"
)
LEAGUES = (
    "league STRUCT<id: BIGINT, name: STRING, type: STRING, logo: STRING>,"
    " country STRUCT<name: STRING, code: STRING, flag: STRING>,"
    " seasons ARRAY<STRUCT<year: INT, start: STRING, `end`: STRING, coverage: STRUCT<"
    "fixtures: STRUCT<events: BOOLEAN, lineups: BOOLEAN, statistics_fixtures: BOOLEAN>,"
    " standings: BOOLEAN, players: BOOLEAN, predictions: BOOLEAN, odds: BOOLEAN>>>"
)
PLAYERS = (
    "player STRUCT<id: BIGINT, name: STRING, firstname: STRING, lastname: STRING, age: INT,"
    " birth: STRUCT<date: STRING>, nationality: STRING, height: STRING, weight: STRING, photo: STRING>,"
    " statistics ARRAY<STRUCT<team: STRUCT<id: BIGINT>, league: STRUCT<season: INT>,"
    " games: STRUCT<position: STRING>>>"
)
TRANSFERS = (
    "player STRUCT<id: BIGINT, name: STRING>, transfers ARRAY<STRUCT<date: STRING, type: STRING,"
    " teams: STRUCT<`in`: STRUCT<id: BIGINT, name: STRING>, `out`: STRUCT<id: BIGINT, name: STRING>>>>"
)
API_PREDICTIONS = (
    "predictions STRUCT<winner: STRUCT<id: BIGINT, name: STRING, comment: STRING>, advice: STRING,"
    " under_over: STRING, goals: STRUCT<home: STRING, away: STRING>,"
    " percent: STRUCT<home: STRING, draw: STRING, away: STRING>>"
)

# Statistic names as they appear in the feed, and their column and type.
STATISTIC_COLUMNS = {
    "Shots on Goal": ("shots_on_goal", "int"),
    "Shots off Goal": ("shots_off_goal", "int"),
    "Total Shots": ("total_shots", "int"),
    "Blocked Shots": ("blocked_shots", "int"),
    "Shots insidebox": ("shots_inside_box", "int"),
    "Shots outsidebox": ("shots_outside_box", "int"),
    "Fouls": ("fouls", "int"),
    "Corner Kicks": ("corner_kicks", "int"),
    "Offsides": ("offsides", "int"),
    "Ball Possession": ("ball_possession", "double"),
    "Yellow Cards": ("yellow_cards", "int"),
    "Red Cards": ("red_cards", "int"),
    "Goalkeeper Saves": ("goalkeeper_saves", "int"),
    "Total passes": ("total_passes", "int"),
    "Passes accurate": ("passes_accurate", "int"),
    "Passes %": ("passes_pct", "double"),
    "expected_goals": ("expected_goals", "double"),
}

# Match-winner, over/under and both-score markets.
MARKETS = {1: "Match Winner", 5: "Goals Over/Under", 8: "Both Teams Score"}
OUTCOME_COLUMNS = {"Home": "odd_home", "Draw": "odd_draw", "Away": "odd_away"}
EXTRA_OUTCOME_COLUMNS = {
    "Over 2.5": "odd_over25",
    "Under 2.5": "odd_under25",
    "Yes": "odd_btts_yes",
    "No": "odd_btts_no",
}

# The market that each outcome belongs to.
OUTCOME_MARKETS = [(1, "Home"), (1, "Draw"), (1, "Away"), (5, "Over 2.5"), (5, "Under 2.5"), (8, "Yes"), (8, "No")]

# The model's input columns.
FEATURES = [
    "home_wins_last_5", "home_draws_last_5", "home_losses_last_5",
    "home_goals_scored_avg_5", "home_goals_conceded_avg_5",
    "away_wins_last_5", "away_draws_last_5", "away_losses_last_5",
    "away_goals_scored_avg_5", "away_goals_conceded_avg_5",
    "home_elo_rating", "away_elo_rating", "elo_diff",
    "h2h_home_wins", "h2h_draws", "h2h_away_wins",
    "odd_home_avg", "odd_draw_avg", "odd_away_avg",
    "home_position", "away_position", "position_diff",
    "home_injuries_count", "away_injuries_count",
    "api_pred_home_pct", "api_pred_draw_pct", "api_pred_away_pct",
    "is_derby", "days_since_last_match_home", "days_since_last_match_away",
]


@dataclass(frozen=True)
class Feed:
    """One raw feed: request path, payload schema and how requests are keyed."""

    endpoint: str
    schema: str
    per: str


FEEDS = {
    "leagues": Feed("/leagues", LEAGUES, "league"),
    "fixtures": Feed("/fixtures", FIXTURE, "league"),
    "statistics": Feed("/fixtures/statistics", STATISTICS, "fixture"),
    "events": Feed("/fixtures/events", EVENTS, "fixture"),
    "lineups": Feed("/fixtures/lineups", LINEUPS, "fixture"),
    "players_stats": Feed("/fixtures/players", PLAYER_STATS, "fixture"),
    "odds": Feed("/odds", ODDS, "fixture"),
    "standings": Feed("/standings", STANDINGS, "league"),
    "injuries": Feed("/injuries", INJURIES, "league"),
    "predictions": Feed("/predictions", API_PREDICTIONS, "fixture"),
    "teams": Feed("/teams", TEAMS, "league"),
    "players": Feed("/players", PLAYERS, "league"),
    "transfers": Feed("/transfers", TRANSFERS, "team"),
}


# Where a record of the feed has its id. The other feeds take theirs from the request.
RECORD_IDS = {
    "leagues": "$.league.id",
    "fixtures": "$.fixture.id",
    "injuries": "$.player.id",
    "teams": "$.team.id",
    "players": "$.player.id",
    "transfers": "$.player.id",
}


@dataclass(frozen=True)
class Table:
    """Keys, partition column and clustering columns of a typed table."""

    layer: str
    keys: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    retention_days: int = 60


TABLES = {
    "fixtures": Table("silver", ("fixture_id",), ("match_date",), ("fixture_id", "league_id")),
    "match_statistics": Table("silver", ("fixture_id", "team_id"), ("match_date",), ("fixture_id", "team_id")),
    "match_events": Table(
        "silver",
        ("fixture_id", "team_id", "time_elapsed", "time_extra", "event_type", "event_detail", "player_id"),
        ("match_date",),
        ("fixture_id", "team_id"),
    ),
    "odds_long": Table(
        "silver",
        ("fixture_id", "bookmaker_id", "bet_id", "outcome"),
        ("match_date",),
        ("fixture_id", "bookmaker_id"),
    ),
    "odds_wide": Table("silver", ("fixture_id", "bookmaker_id"), ("match_date",), ("fixture_id", "bookmaker_id")),
    "standings": Table("silver", ("league_id", "season", "team_id"), (), ("league_id", "season")),
    "injuries": Table("silver", ("player_id", "fixture_id"), ("match_date",), ("team_id", "player_id")),
    "lineups": Table("silver", ("fixture_id", "team_id", "player_id"), ("match_date",), ("fixture_id", "team_id")),
    "player_stats": Table("silver", ("fixture_id", "player_id", "team_id"), ("match_date",), ("player_id", "fixture_id")),
    "api_predictions": Table("silver", ("fixture_id",), ("match_date",), ("fixture_id",)),
    "teams": Table("silver", ("team_id",), (), ("team_id",)),
    "leagues": Table("silver", ("league_id", "season"), (), ("league_id",)),
    "players": Table("silver", ("player_id", "season"), (), ("player_id",)),
    "transfers": Table("silver", ("player_id", "transfer_date", "to_team_id"), (), ("player_id",)),
    "match_features": Table("gold", ("fixture_id",), ("season",), ("fixture_id", "league_id"), 90),
    "match_predictions": Table("gold", ("fixture_id",), ("match_date",), ("fixture_id", "model_version"), 90),
    "team_form": Table("gold", ("team_id", "league_id", "season", "reference_date"), ("season",), ("team_id",), 90),
    "head_to_head": Table("gold", ("home_team_id", "away_team_id", "league_id"), (), ("home_team_id",), 90),
    "league_summary": Table("gold", ("league_id", "season"), ("season",), ("league_id",), 90),
    "dim_teams": Table("gold", ("team_id",), (), ("team_id",), 90),
    "dim_leagues": Table("gold", ("league_id", "season"), (), ("league_id",), 90),
    "dim_players": Table("gold", ("player_id", "season"), ("season",), ("player_id",), 90),
}
