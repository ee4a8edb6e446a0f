"""Raw rows to typed tables: parse once, flatten, label, keep the latest version per key."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions.columns import (
    instant,
    local_day,
    outcome_label,
    pct,
    percent_number,
    safe_cast,
)
from touchline.operators.flatten import explode_path, flatten_json, parse_payload, pivot_kv, pivot_static, require_keys
from touchline.operators.ordered import dedup_latest
from touchline.schemas import EXTRA_OUTCOME_COLUMNS, OUTCOME_COLUMNS, OUTCOME_MARKETS, STATISTIC_COLUMNS, TABLES

LANDED = ("_ingestion_ts", "_batch_id")


def request_fixture() -> Column:
    """Fixture id of the request that returned a record."""
    return F.get_json_object("params", "$.fixture").try_cast("bigint")


def _requested(raw: DataFrame, schema: str) -> DataFrame:
    """Parsed records with the ``fixture_id`` of their request.

    Read once, in a one-element explode like the record: the key filter would otherwise be pushed down to the raw rows and
    read it there a second time.
    """
    return parse_payload(raw, schema).withColumn("fixture_id", F.explode(F.array(request_fixture())))


def _latest(
    df: DataFrame, keys: Sequence[str], tiebreak: Sequence[str] | None = None, required: int | None = None
) -> DataFrame:
    """Latest landed row per key; rows with a NULL among the first ``required`` keys (default all) are dropped.

    The landing time stays, so that a later load of an older version can be told from a newer one.
    """
    return dedup_latest(require_keys(df, keys[:required]), keys, LANDED, tiebreak).drop("_batch_id")


def _gathered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of one key in one task; those with a NULL key are dropped.

    The key is the table's or part of it, so rows are compared without another shuffle and sorted once, after it. Records
    are dealt before their arrays are unfolded where that moves less. It is for keys that have few versions.
    """
    return require_keys(df, keys).repartition(*keys)


def fixtures(raw: DataFrame, finished: Iterable[str] = ("FT",)) -> DataFrame:
    flat = flatten_json(
        raw,
        schemas.FIXTURE,
        {
            "fixture_id": "fixture.id",
            "league_id": "league.id",
            "league_name": "league.name",
            "season": "league.season",
            "match_date": local_day(F.col("rec.fixture.date")),
            "match_ts": instant(F.col("rec.fixture.date")),
            "home_team_id": "teams.home.id",
            "home_team_name": "teams.home.name",
            "away_team_id": "teams.away.id",
            "away_team_name": "teams.away.name",
            "goals_home": "goals.home",
            "goals_away": "goals.away",
            "status": "fixture.status.short",
            "round": "league.round",
            "venue": "fixture.venue.name",
            "referee": "fixture.referee",
        },
        LANDED,
    )
    label = outcome_label(F.col("goals_home"), F.col("goals_away"), F.col("status"), finished)
    return _latest(flat.withColumn("result", label), TABLES["fixtures"].keys)


def with_match_date(df: DataFrame, fixtures: DataFrame) -> DataFrame:
    """Match day taken from the fixtures table: the other feeds do not carry it."""
    return df.join(fixtures.select("fixture_id", "match_date"), "fixture_id", "left")


def statistics(raw: DataFrame) -> DataFrame:
    rows = _requested(raw, schemas.STATISTICS).select(
        "fixture_id",
        F.col("rec.team.id").alias("team_id"),
        *LANDED,
        F.col("rec.statistics").alias("stats"),
    )
    # The array is unfolded after the latest version is known, so old versions are never pivoted.
    return pivot_kv(_latest(rows, TABLES["match_statistics"].keys), "stats", STATISTIC_COLUMNS)


def events(raw: DataFrame) -> DataFrame:
    rows = _requested(raw, schemas.EVENTS).select(
        "fixture_id",
        F.col("rec.team.id").alias("team_id"),
        F.col("rec.player.id").alias("player_id"),
        F.col("rec.player.name").alias("player_name"),
        F.col("rec.type").alias("event_type"),
        F.col("rec.detail").alias("event_detail"),
        F.col("rec.time.elapsed").alias("time_elapsed"),
        F.col("rec.time.extra").alias("time_extra"),
        *LANDED,
    )
    # Player, extra time and detail may be NULL: they take part in the key null-safely.
    return _latest(rows, TABLES["match_events"].keys, required=2)


def odds_long(raw: DataFrame, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """One row per fixture, bookmaker, market and outcome: the latest quote."""
    books = explode_path(
        parse_payload(raw, schemas.ODDS),
        [("rec.bookmakers", "_book")],
        {
            "fixture_id": "rec.fixture.id",
            "bookmaker_id": "_book.id",
            "_book": "_book",
            **{c: c for c in LANDED},
        },
    )
    rows = explode_path(
        _gathered(books, ["fixture_id", "bookmaker_id"]),
        [("_book.bets", "_bet"), ("_bet.values", "_price")],
        {
            "fixture_id": "fixture_id",
            "bookmaker_id": "bookmaker_id",
            "bookmaker_name": "_book.name",
            "bet_id": "_bet.id",
            "bet_name": "_bet.name",
            "outcome": "_price.value",
            "odd": "_price.odd",
            **{c: c for c in LANDED},
        },
    )
    typed = rows.withColumn("odd", safe_cast(F.col("odd"), "double"))
    return _latest(typed, TABLES["odds_long"].keys, tiebreak)


def odds_wide(long: DataFrame) -> DataFrame:
    """One row per fixture and bookmaker with the match-winner, over/under and both-score prices.

    Outcomes count in their own market only: others use the same names.
    """
    own = F.struct("bet_id", "outcome")
    rows = long.withColumn("_price_of", F.when(own.isin(*[F.struct(F.lit(b).cast("bigint"), F.lit(o)) for b, o in OUTCOME_MARKETS]), F.col("outcome")))
    return pivot_static(
        rows,
        ["fixture_id", "bookmaker_id"],
        "_price_of",
        {**OUTCOME_COLUMNS, **EXTRA_OUTCOME_COLUMNS},
        "odd",
        [F.max("bookmaker_name").alias("bookmaker_name")],
    )


def standings(raw: DataFrame) -> DataFrame:
    keep = {
        "league_id": "rec.league.id",
        "season": "rec.league.season",
        "team_id": "_row.team.id",
        "team_name": "_row.team.name",
        "position": "_row.rank",
        "played": "_row.all.played",
        "wins": "_row.all.win",
        "draws": "_row.all.draw",
        "losses": "_row.all.lose",
        "goals_for": "_row.all.goals.for",
        "goals_against": "_row.all.goals.against",
        "goal_diff": "_row.goalsDiff",
        "points": "_row.points",
        "form": "_row.form",
        "group": "_row.group",
        "status": "_row.status",
        "description": "_row.description",
        "_snapshot_date": "_ingestion_date",
        **{c: c for c in LANDED},
    }
    rows = explode_path(parse_payload(raw, schemas.STANDINGS), [("rec.league.standings", "_row")], keep)
    return _latest(rows, TABLES["standings"].keys)


def injuries(raw: DataFrame, tiebreak: Sequence[str] | None = None) -> DataFrame:
    flat = flatten_json(
        raw,
        schemas.INJURIES,
        {
            "fixture_id": "fixture.id",
            "league_id": "league.id",
            "season": "league.season",
            "team_id": "team.id",
            "player_id": "player.id",
            "player_name": "player.name",
            "injury_type": "player.type",
            "injury_reason": "player.reason",
            "match_date": local_day(F.col("rec.fixture.date")),
        },
        LANDED,
    )
    return _latest(flat, TABLES["injuries"].keys, tiebreak)


def lineups(raw: DataFrame) -> DataFrame:
    """One row per listed player; starters and substitutes are exploded as one tagged array."""

    def tagged(path: str, is_starter: bool) -> Column:
        return F.transform(
            F.coalesce(F.col(path), F.array()),
            lambda e: F.struct(e["player"].alias("p"), F.lit(is_starter).alias("is_starter")),
        )

    records = _requested(raw, schemas.LINEUPS).select(
        "fixture_id", F.col("rec.team.id").alias("team_id"), "rec", *LANDED
    )
    listed = _gathered(records, ["fixture_id", "team_id"]).select(
        "fixture_id",
        "team_id",
        F.col("rec.formation").alias("formation"),
        F.explode(F.concat(tagged("rec.startXI", True), tagged("rec.substitutes", False))).alias("e"),
        *LANDED,
    )
    rows = listed.select(
        "fixture_id",
        "team_id",
        "formation",
        F.col("e.p.id").alias("player_id"),
        F.col("e.p.name").alias("player_name"),
        F.col("e.p.number").alias("player_number"),
        F.col("e.p.pos").alias("player_position"),
        F.col("e.is_starter").alias("is_starter"),
        *LANDED,
    )
    return _latest(rows, ("fixture_id", "team_id", "player_id"))


def player_stats(raw: DataFrame, tiebreak: Sequence[str] | None = None) -> DataFrame:
    entry = {
        "minutes_played": "games.minutes",
        "goals": "goals.total",
        "assists": "goals.assists",
        "shots_total": "shots.total",
        "shots_on": "shots.on",
        "passes_total": "passes.total",
        "passes_key": "passes.key",
        "tackles": "tackles.total",
        "interceptions": "tackles.interceptions",
        "duels_won": "duels.won",
        "duels_total": "duels.total",
        "dribbles_won": "dribbles.success",
        "fouls_committed": "fouls.committed",
        "fouls_drawn": "fouls.drawn",
        "yellow_cards": "cards.yellow",
        "red_cards": "cards.red",
    }
    rows = explode_path(
        _requested(raw, schemas.PLAYER_STATS),
        [("rec.players", "_p"), ("_p.statistics", "_s")],
        {
            "fixture_id": "fixture_id",
            "team_id": "rec.team.id",
            "player_id": "_p.player.id",
            "player_name": "_p.player.name",
            "rating": "_s.games.rating",
            "passes_accuracy": "_s.passes.accuracy",
            **{name: f"_s.{path}" for name, path in entry.items()},
            **{c: c for c in LANDED},
        },
    ).withColumns(
        {
            "rating": F.col("rating").try_cast("double"),
            "passes_accuracy": percent_number(F.col("passes_accuracy")),
        }
    )
    keys = TABLES["player_stats"].keys
    return _latest(_gathered(rows, keys), keys, tiebreak)


def teams(raw: DataFrame) -> DataFrame:
    flat = flatten_json(
        raw,
        schemas.TEAMS,
        {
            "team_id": "team.id",
            "team_name": "team.name",
            "team_code": "team.code",
            "country": "team.country",
            "founded": "team.founded",
            "logo_url": "team.logo",
            "venue_name": "venue.name",
            "venue_city": "venue.city",
            "venue_capacity": "venue.capacity",
        },
        LANDED,
    )
    return _latest(flat, ("team_id",))


def leagues(raw: DataFrame) -> DataFrame:
    """One row per league and season with its coverage flags."""
    flags = {
        "has_standings": "standings",
        "has_events": "fixtures.events",
        "has_lineups": "fixtures.lineups",
        "has_statistics": "fixtures.statistics_fixtures",
        "has_players": "players",
        "has_predictions": "predictions",
        "has_odds": "odds",
    }
    rows = explode_path(
        parse_payload(raw, schemas.LEAGUES),
        [("rec.seasons", "_s")],
        {
            "league_id": "rec.league.id",
            "league_name": "rec.league.name",
            "league_type": "rec.league.type",
            "country": "rec.country.name",
            "country_code": "rec.country.code",
            "logo_url": "rec.league.logo",
            "flag_url": "rec.country.flag",
            "season": "_s.year",
            "season_start": "_s.start",
            "season_end": "_s.end",
            **{name: f"_s.coverage.{path}" for name, path in flags.items()},
            **{c: c for c in LANDED},
        },
    ).withColumns({c: local_day(F.col(c)) for c in ("season_start", "season_end")})
    return _latest(rows, ("league_id", "season"))


def players(raw: DataFrame) -> DataFrame:
    rows = explode_path(
        parse_payload(raw, schemas.PLAYERS),
        [("rec.statistics", "_s")],
        {
            "player_id": "rec.player.id",
            "player_name": "rec.player.name",
            "firstname": "rec.player.firstname",
            "lastname": "rec.player.lastname",
            "age": "rec.player.age",
            "birth_date": "rec.player.birth.date",
            "nationality": "rec.player.nationality",
            "height": "rec.player.height",
            "weight": "rec.player.weight",
            "photo_url": "rec.player.photo",
            "team_id": "_s.team.id",
            "season": "_s.league.season",
            "position": "_s.games.position",
            **{c: c for c in LANDED},
        },
    ).withColumn("birth_date", local_day(F.col("birth_date")))
    return _latest(rows, ("player_id", "season"))


def transfers(raw: DataFrame) -> DataFrame:
    rows = explode_path(
        parse_payload(raw, schemas.TRANSFERS),
        [("rec.transfers", "_t")],
        {
            "player_id": "rec.player.id",
            "player_name": "rec.player.name",
            "from_team_id": "_t.teams.out.id",
            "from_team_name": "_t.teams.out.name",
            "to_team_id": "_t.teams.in.id",
            "to_team_name": "_t.teams.in.name",
            "transfer_date": "_t.date",
            "transfer_type": "_t.type",
            **{c: c for c in LANDED},
        },
        outer=False,
    ).withColumn("transfer_date", local_day(F.col("transfer_date")))
    return _latest(rows, ("player_id", "transfer_date", "to_team_id"), required=1)


def api_predictions(raw: DataFrame) -> DataFrame:
    rows = _requested(raw, schemas.API_PREDICTIONS).select(
        "fixture_id",
        F.col("rec.predictions.winner.id").alias("pred_winner_id"),
        F.col("rec.predictions.winner.name").alias("pred_winner_name"),
        F.col("rec.predictions.winner.comment").alias("pred_winner_comment"),
        F.col("rec.predictions.percent.home").alias("pred_home_pct"),
        F.col("rec.predictions.percent.draw").alias("pred_draw_pct"),
        F.col("rec.predictions.percent.away").alias("pred_away_pct"),
        F.col("rec.predictions.advice").alias("pred_advice"),
        F.col("rec.predictions.under_over").alias("pred_under_over"),
        F.col("rec.predictions.goals.home").alias("pred_goals_home"),
        F.col("rec.predictions.goals.away").alias("pred_goals_away"),
        *LANDED,
    )
    return _latest(rows, ("fixture_id",))


# Staging views over the typed tables.


def stg_fixtures(df: DataFrame, statuses: Iterable[str] = ("FT", "NS", "AET", "PEN")) -> DataFrame:
    return df.filter(F.col("status").isin(*statuses))


def stg_statistics(df: DataFrame) -> DataFrame:
    """Missing statistics become 0."""
    return df.fillna(0, [name for name, _ in STATISTIC_COLUMNS.values()])


def stg_events(df: DataFrame) -> DataFrame:
    from touchline.functions.columns import event_class

    return df.withColumn("event_class", event_class(F.col("event_type"), F.col("event_detail")))


def stg_odds(df: DataFrame, columns: Sequence[str] = tuple(OUTCOME_COLUMNS.values())) -> DataFrame:
    """Rows whose prices are all above 1 (a missing price passes)."""
    for c in columns:
        df = df.filter(F.col(c).isNull() | (F.col(c) > 1.0))
    return df


def stg_injuries(df: DataFrame, season: int, as_of: Column) -> DataFrame:
    """Injuries of the season whose match is still ahead."""
    return df.filter((F.col("season") == season) & (F.col("match_date") >= as_of))


def stg_players(df: DataFrame, season: int) -> DataFrame:
    return df.filter(F.col("season") == season)


def stg_api_predictions(df: DataFrame) -> DataFrame:
    return df.withColumns({c: pct(F.col(c)) for c in ("pred_home_pct", "pred_draw_pct", "pred_away_pct")})
