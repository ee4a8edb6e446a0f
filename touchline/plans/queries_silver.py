"""Queries over raw and typed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.functions.columns import argmax_label, confidence_band, surrogate_key
from touchline.operators import flatten
from touchline.operators.joins import apply_aliases
from touchline.operators.ordered import dedup_latest
from touchline.plans import silver, testbed
from touchline.plans.catalog import Query, query
from touchline.plans.sqltext import FX, LINES, PREDS, QUOTES, SEASONS, TEAMS, with_
from touchline.schemas import FIXTURE, STATISTIC_COLUMNS

c = F.col


def typed_query(name: str, sql: str):
    """Register a query over a whole typed table, without its landing time."""

    def add(fn: Query) -> Query:
        query(name, sql)(lambda spark, sf: fn(spark, sf).drop("_ingestion_ts"))
        return fn

    return add

_FIXTURE_SQL = """
SELECT fixture_id, league_id, 'League ' || league_id AS league_name, season, match_date,
  CAST(epoch(CAST(match_date AS TIMESTAMP)) AS BIGINT) + 95400 AS match_epoch,
  home_team_id, 'Team ' || home_team_id AS home_team_name, away_team_id, 'Team ' || away_team_id AS away_team_name,
  goals_home, goals_away, status, 'Round ' || round AS round, 'Ground ' || home_team_id AS venue,
  CASE WHEN fixture_id%3=0 THEN 'Referee ' || (seed%40) END AS referee,
  CASE WHEN status='FT' THEN CASE WHEN goals_home>goals_away THEN 'H' WHEN goals_home=goals_away THEN 'D' ELSE 'A' END END AS result
FROM mt"""


@typed_query("silver_fixtures", with_(FX, body=_FIXTURE_SQL))
def silver_fixtures(spark, sf):
    typed = silver.fixtures(testbed.raw_fixtures(spark, sf))
    return typed.withColumn("match_epoch", F.unix_timestamp("match_ts")).drop("match_ts")


@query(
    "flatten_fixtures",
    with_(
        FX,
        body="""SELECT fixture_id, league_id, v AS version_day,
  CASE WHEN v=1 THEN 'NS' ELSE status END AS status, CASE WHEN v=2 THEN goals_home END AS goals_home,
  CASE WHEN v=2 THEN goals_away END AS goals_away FROM mt, (VALUES (1),(2)) t(v)""",
    ),
)
def flatten_fixtures(spark, sf):
    flat = flatten.flatten_json(
        testbed.raw_fixtures(spark, sf),
        FIXTURE,
        {
            "fixture_id": "fixture.id",
            "league_id": "league.id",
            "status": "fixture.status.short",
            "goals_home": "goals.home",
            "goals_away": "goals.away",
            "day": F.to_date(c("rec.fixture.date")),
        },
        ["_ingestion_date"],
    )
    return flat.withColumn("version_day", F.date_diff("_ingestion_date", "day")).drop("day", "_ingestion_date")


@query("outcome_label", with_(FX, body="SELECT result, count(*) AS n FROM fx GROUP BY result"))
def outcome_counts(spark, sf):
    return silver.fixtures(testbed.raw_fixtures(spark, sf)).groupBy("result").agg(F.count(F.lit(1)).alias("n"))


@query(
    "dedup_latest_odds",
    with_(
        QUOTES,
        body="""SELECT fixture_id, bookmaker_id, outcome, odd, day FROM q QUALIFY row_number() OVER (
  PARTITION BY fixture_id, bookmaker_id, outcome ORDER BY day DESC, odd DESC)=1""",
    ),
)
def dedup_latest_odds(spark, sf):
    rows = testbed.quotes(spark, sf).select("fixture_id", "bookmaker_id", "outcome", "odd", "day")
    return dedup_latest(rows, ["fixture_id", "bookmaker_id", "outcome"], ["day"], ["odd"])


@query(
    "reject_null_keys",
    """SELECT event_id, user_id, CAST(json_extract(props,'$.k') AS INTEGER) AS k FROM events
WHERE CAST(json_extract(props,'$.k') AS INTEGER) % 3 <> 0""",
)
def reject_null_keys(spark, sf):
    k = F.get_json_object("props", "$.k").try_cast("int")
    rows = testbed.table(spark, sf, "events").select("event_id", "user_id", F.when(k % 3 != 0, k).alias("k"))
    return flatten.require_keys(rows, ["event_id", "k"])


@query(
    "split_valid",
    """SELECT CASE WHEN event_id%5=0 THEN 'malformed' WHEN event_id%7=0 THEN 'null_k' ELSE 'accepted' END AS reason,
  count(*) AS n FROM events GROUP BY 1""",
)
def split_valid(spark, sf):
    """Every fifth record is cut short and every seventh lacks its key."""
    text = (
        F.when(c("event_id") % 5 == 0, F.concat(F.lit('{"k": '), c("user_id").cast("string")))
        .when(c("event_id") % 7 == 0, F.lit("{}"))
        .otherwise(c("props"))
    )
    parsed = (
        testbed.table(spark, sf, "events")
        .select("event_id", text.alias("payload"))
        .withColumn("rec", F.from_json("payload", "k INT, _bad STRING", {"columnNameOfCorruptRecord": "_bad"}))
        .select("event_id", "rec.k", "rec._bad")
    )
    accepted, rejected = flatten.split_valid(parsed, ["event_id", "k"], "_bad")
    reasons = accepted.select(F.lit("accepted").alias("reason")).unionByName(
        rejected.select(c("_reject_reason").alias("reason"))
    )
    return reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "surrogate_key",
    with_(
        TEAMS,
        body="""SELECT fixture_id, team_id, md5(fixture_id || '#' || team_id || '#' || coalesce(outcome,'∅')) AS row_key
FROM tr""",
    ),
)
def surrogate(spark, sf):
    rows = flatten.to_team_rows(testbed.fixtures(spark, sf))
    return rows.select(
        "fixture_id", "team_id", surrogate_key(c("fixture_id"), c("team_id"), c("outcome")).alias("row_key")
    )


@query(
    "alias_names",
    """SELECT c_custkey, CASE WHEN c_custkey%2=0 THEN 'Nation ' || n_nationkey ELSE 'Club ' || c_custkey END AS team_name
FROM customer JOIN nation ON c_nationkey=n_nationkey""",
)
def alias_names(spark, sf):
    nations = testbed.table(spark, sf, "nation").select(c("n_nationkey").alias("c_nationkey"), "n_name")
    named = (
        testbed.table(spark, sf, "customer")
        .join(nations, "c_nationkey")
        .select(
            "c_custkey",
            F.when(c("c_custkey") % 2 == 0, c("n_name"))
            .otherwise(F.concat(F.lit("Club "), c("c_custkey")))
            .alias("team_name"),
        )
    )
    return apply_aliases(named, testbed.aliases(spark, sf), "team_name")


@query(
    "mask_columns",
    """SELECT c_custkey, sha256(c_name) AS c_name, substr(c_mktsegment,1,1) || '***' AS c_mktsegment,
  CAST(NULL AS VARCHAR) AS c_acctbal FROM customer""",
)
def mask_columns(spark, sf):
    rows = testbed.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    return flatten.mask_columns(rows, {"c_name": "hash", "c_mktsegment": "initial", "c_acctbal": "null"})


# --- statistics -----------------------------------------------------------------------------------


def _statistics_sql(zero: bool) -> str:
    parts = []
    for j, (name, (column, type_)) in enumerate(STATISTIC_COLUMNS.items()):
        base = f"(fixture_id*{j + 3} + team_id*7)%20"
        if name in ("Ball Possession", "Passes %"):
            value = f"CAST({base}+30 AS DOUBLE)"
        elif name == "expected_goals":
            value = f"CAST('1.' || ({base}+10) AS DOUBLE)"
        elif name == "Red Cards":
            value = f"CASE WHEN fixture_id%3<>0 THEN CAST({base} AS INTEGER) END"
        elif name == "Offsides":
            value = f"CASE WHEN fixture_id%5<>0 THEN CAST({base} AS INTEGER) END"
        else:
            value = f"CAST({base} AS INTEGER)"
        parts.append(f"{'coalesce(' + value + ', 0)' if zero else value} AS {column}")
    return f"SELECT fixture_id, team_id, {', '.join(parts)} FROM pr"


@typed_query("stats_pivot_kv", with_(TEAMS, body=_statistics_sql(False)))
def stats_pivot_kv(spark, sf):
    return silver.statistics(testbed.raw_statistics(spark, sf))


@typed_query("stg_statistics", with_(TEAMS, body=_statistics_sql(True)))
def stg_statistics(spark, sf):
    return silver.stg_statistics(silver.statistics(testbed.raw_statistics(spark, sf)))


_STATISTICS = with_(TEAMS, body=f"SELECT s.*, pr.match_date FROM ({_statistics_sql(False)}) s JOIN pr USING (fixture_id, team_id)")


@query("silver_statistics", _STATISTICS)
@query("silver_statistics_all", _STATISTICS)
def silver_statistics(spark, sf):
    """All statistics of the table, with the match date; registered under an earlier name too."""
    typed = silver.with_match_date(silver.statistics(testbed.raw_statistics(spark, sf)), testbed.fixtures(spark, sf))
    return typed.select("fixture_id", "team_id", "match_date", *[column for column, _ in STATISTIC_COLUMNS.values()])


# --- events ---------------------------------------------------------------------------------------

_EVENTS = """
ev AS (
  SELECT fixture_id, match_date, CASE WHEN i%2=1 THEN home_team_id ELSE away_team_id END AS team_id,
    CASE WHEN fixture_id%7<>0 THEN (fixture_id*3+i)%500 END AS player_id,
    CASE (fixture_id+i)%4 WHEN 0 THEN 'Goal' WHEN 1 THEN 'Card' WHEN 2 THEN 'subst' ELSE 'Var' END AS event_type,
    CASE (fixture_id+i)%4 WHEN 0 THEN CASE WHEN fixture_id%5=0 THEN 'Own Goal' ELSE 'Normal Goal' END
      WHEN 1 THEN CASE WHEN fixture_id%3=0 THEN 'Red Card' ELSE 'Yellow Card' END
      WHEN 2 THEN 'Substitution 1' END AS event_detail,
    CAST((fixture_id*7+i*13)%90+1 AS INTEGER) AS time_elapsed,
    CASE WHEN i=2 THEN CAST(i AS INTEGER) END AS time_extra
  FROM mt, (VALUES (1),(2),(3)) t(i) WHERE status='FT' AND i<=fixture_id%4)"""


@typed_query("events_explode", with_(FX, _EVENTS, body="SELECT * FROM ev"))
def events_explode(spark, sf):
    typed = silver.events(testbed.raw_events(spark, sf)).drop("player_name")
    return silver.with_match_date(typed, testbed.fixtures(spark, sf))


@query(
    "stg_events",
    with_(
        FX,
        _EVENTS,
        body="""SELECT event_class, count(*) AS n FROM (SELECT CASE WHEN event_detail='Own Goal' THEN 'own_goal'
  WHEN event_type='Goal' THEN 'goal' WHEN event_detail='Red Card' THEN 'red_card' WHEN event_type='Card' THEN 'yellow_card'
  WHEN event_type='subst' THEN 'substitution' ELSE 'var' END AS event_class FROM ev) GROUP BY 1""",
    ),
)
def stg_events(spark, sf):
    rows = silver.stg_events(silver.events(testbed.raw_events(spark, sf)))
    return rows.groupBy("event_class").agg(F.count(F.lit(1)).alias("n"))


# --- odds -----------------------------------------------------------------------------------------

_LONG = """
ol AS (
  SELECT fixture_id, bookmaker_id, 'Book ' || bookmaker_id AS bookmaker_name, bet_id, 'Match Winner' AS bet_name,
    outcome, odd, day FROM q
  UNION ALL
  SELECT fixture_id, bookmaker_id, 'Book ' || bookmaker_id, 5, 'Goals Over/Under', o,
    CAST(l_suppkey%200+110 AS DOUBLE)/CAST(100 AS DOUBLE), day FROM q, (VALUES ('Over 2.5'),('Under 2.5')) t(o)
  UNION ALL
  SELECT fixture_id, bookmaker_id, 'Book ' || bookmaker_id, 13, 'First Half Winner', outcome,
    CAST(l_suppkey%300+1200 AS DOUBLE)/CAST(100 AS DOUBLE), day FROM q),
od AS (
  SELECT * EXCLUDE (day) FROM ol QUALIFY row_number() OVER (
    PARTITION BY fixture_id, bookmaker_id, bet_id, outcome ORDER BY day DESC, odd DESC)=1)"""


@query("odds_explode_long", with_(QUOTES, _LONG, body="SELECT * FROM od"))
def odds_explode_long(spark, sf):
    return silver.odds_long(testbed.raw_odds(spark, sf), ["odd"]).drop("_ingestion_ts")


_WIDE = """
wd AS (SELECT fixture_id, bookmaker_id, max(bookmaker_name) AS bookmaker_name,
  max(CASE WHEN bet_id=1 AND outcome='Home' THEN odd END) AS odd_home, max(CASE WHEN bet_id=1 AND outcome='Draw' THEN odd END) AS odd_draw,
  max(CASE WHEN bet_id=1 AND outcome='Away' THEN odd END) AS odd_away, max(CASE WHEN bet_id=5 AND outcome='Over 2.5' THEN odd END) AS odd_over25,
  max(CASE WHEN bet_id=5 AND outcome='Under 2.5' THEN odd END) AS odd_under25, CAST(NULL AS DOUBLE) AS odd_btts_yes,
  CAST(NULL AS DOUBLE) AS odd_btts_no FROM od GROUP BY fixture_id, bookmaker_id)"""


@query("odds_pivot_wide", with_(QUOTES, _LONG, _WIDE, body="SELECT * FROM wd"))
def odds_pivot_wide(spark, sf):
    return silver.odds_wide(silver.odds_long(testbed.raw_odds(spark, sf), ["odd"]))


@query(
    "silver_odds",
    with_(FX, QUOTES, _LONG, _WIDE, body="SELECT wd.*, match_date FROM wd LEFT JOIN fx USING (fixture_id)"),
)
def silver_odds(spark, sf):
    wide = silver.odds_wide(silver.odds_long(testbed.raw_odds(spark, sf), ["odd"]))
    return silver.with_match_date(wide, testbed.fixtures(spark, sf))


@query(
    "stg_odds",
    with_(
        QUOTES,
        body="""SELECT fixture_id, bookmaker_id, odd_home-0.5 AS odd_home, odd_draw, odd_away FROM (
  SELECT fixture_id, bookmaker_id, CAST(odd_home AS DOUBLE) AS odd_home, odd_draw, odd_away FROM ow)
WHERE odd_home IS NULL OR odd_home-0.5 > 1.0""",
    ),
)
def stg_odds(spark, sf):
    rows = testbed.odds_wide(spark, sf).withColumn("odd_home", c("odd_home") - 0.5)
    return silver.stg_odds(rows)


# --- standings, teams, leagues, players -----------------------------------------------------------


@typed_query(
    "standings_explode",
    with_(
        TEAMS,
        SEASONS,
        body="""SELECT league_id, season, team_id, 'Team ' || team_id AS team_name, position, played, wins, draws, losses,
  goals_for, goals_against, goal_diff, points, CASE WHEN position<=10 THEN 'A' ELSE 'B' END AS "group", _snapshot_date FROM st""",
    ),
)
def standings_explode(spark, sf):
    return silver.standings(testbed.raw_standings(spark, sf)).drop("form", "status", "description")


@typed_query(
    "silver_injuries",
    with_(
        FX,
        LINES,
        body="""SELECT fixture_id, league_id, season, team_id, player_id, 'Player ' || player_id AS player_name,
  CASE WHEN player_id%2=0 THEN 'Missing Fixture' ELSE 'Questionable' END AS injury_type,
  CASE WHEN player_id%3=0 THEN 'Knee Injury' ELSE 'Suspended' END AS injury_reason, match_date FROM inj""",
    ),
)
def silver_injuries(spark, sf):
    return silver.injuries(testbed.raw_injuries(spark, sf), ["team_id"])


@query(
    "stg_injuries",
    with_(
        FX,
        LINES,
        body="""SELECT fixture_id, team_id, player_id, match_date FROM inj
WHERE season=1998 AND match_date >= DATE '1998-06-01'""",
    ),
)
def stg_injuries(spark, sf):
    typed = silver.injuries(testbed.raw_injuries(spark, sf), ["team_id"])
    active = silver.stg_injuries(typed, 1998, F.make_date(F.lit(1998), F.lit(6), F.lit(1)))
    return active.select("fixture_id", "team_id", "player_id", "match_date")


@typed_query(
    "silver_lineups",
    with_(
        TEAMS,
        body="""SELECT fixture_id, team_id, CASE WHEN fixture_id%2=0 THEN '4-3-3' ELSE '4-4-2' END AS formation,
  team_id*100+(fixture_id+i)%25 AS player_id, 'Player ' || (team_id*100+(fixture_id+i)%25) AS player_name,
  CAST(i+1 AS INTEGER) AS player_number,
  CASE WHEN i=0 THEN 'G' WHEN i<=4 THEN 'D' WHEN i<=8 THEN 'M' ELSE 'F' END AS player_position, i<=10 AS is_starter
FROM pr, range(14) t(i)""",
    ),
)
def silver_lineups(spark, sf):
    return silver.lineups(testbed.raw_lineups(spark, sf))


@query(
    "silver_player_stats",
    with_(
        FX,
        LINES,
        body="""SELECT fixture_id, team_id, player_id, 'Player ' || player_id AS player_name, quantity+40 AS minutes_played,
  CAST(l_suppkey%50+50 AS DOUBLE)/CAST(10 AS DOUBLE) AS rating, l_linenumber%3 AS goals,
  CAST(l_partkey%2 AS INTEGER) AS assists, CAST(l_partkey%9 AS INTEGER) AS shots_total,
  CAST(l_partkey%100 AS DOUBLE) AS passes_accuracy, CAST(l_suppkey%7 AS INTEGER) AS tackles,
  l_linenumber%2 AS yellow_cards, 0 AS red_cards
FROM ln QUALIFY row_number() OVER (PARTITION BY fixture_id, player_id, team_id
  ORDER BY day DESC, quantity DESC, l_suppkey%50 DESC, l_linenumber%3 DESC, l_partkey%2 DESC, l_partkey%9 DESC,
    l_partkey%100 DESC, l_suppkey%7 DESC, l_linenumber%2 DESC)=1""",
    ),
)
def silver_player_stats(spark, sf):
    ties = ["minutes_played", "rating", "goals", "assists", "shots_total", "passes_accuracy", "tackles", "yellow_cards"]
    return silver.player_stats(testbed.raw_player_stats(spark, sf), ties).select(
        "fixture_id", "team_id", "player_id", "player_name", "minutes_played", "rating", "goals", "assists",
        "shots_total", "passes_accuracy", "tackles", "yellow_cards", "red_cards",
    )


_TEAMS_SQL = """SELECT DISTINCT home_team_id AS team_id, 'Team ' || home_team_id AS team_name, 'T' || home_team_id AS team_code,
  'Country ' || league_id AS country, CAST(home_team_id%120+1890 AS INTEGER) AS founded, CAST(NULL AS VARCHAR) AS logo_url,
  'Ground ' || home_team_id AS venue_name, 'City ' || (home_team_id%50) AS venue_city,
  CAST(home_team_id*37%80000 AS INTEGER) AS venue_capacity FROM mt"""


@typed_query("silver_teams", with_(FX, body=_TEAMS_SQL))
def silver_teams(spark, sf):
    return silver.teams(testbed.raw_teams(spark, sf))


_SEASON_ROWS = """
ls AS (SELECT DISTINCT league_id, y AS season FROM (
  SELECT league_id, season AS y FROM mt UNION ALL SELECT league_id, season-1 FROM mt)),
lg AS (
  SELECT league_id, 'League ' || league_id AS league_name, CASE WHEN league_id=4 THEN 'Cup' ELSE 'League' END AS league_type,
    'Country ' || league_id AS country, 'C' || league_id AS country_code, season, make_date(season,1,1) AS season_start,
    make_date(season,12,31) AS season_end, season%2=0 AS has_events, true AS has_lineups,
    (season+league_id)%3<>0 AS has_statistics, true AS has_standings, league_id%2=0 AS has_players,
    false AS has_predictions, (season+league_id)%2=0 AS has_odds FROM ls)"""


@typed_query("silver_leagues", with_(FX, _SEASON_ROWS, body="SELECT * FROM lg"))
def silver_leagues(spark, sf):
    return silver.leagues(testbed.raw_leagues(spark, sf)).drop("logo_url", "flag_url")


@query(
    "coverage_latest",
    with_(
        FX,
        body="""SELECT fixture_id, season%2=0 AS has_events, (season+league_id)%2=0 AS has_odds FROM mt""",
    ),
)
def coverage_latest(spark, sf):
    """Coverage of the last season entry of each landed league record, one record per match."""
    from touchline.schemas import LEAGUES
    from touchline.sources.landing import latest_coverage

    raw = testbed.raw_leagues(spark, sf).select("payload")
    keyed = testbed.fixtures(spark, sf).select("fixture_id", "league_id", "season")
    parsed = flatten.parse_payload(raw, LEAGUES).select("rec.league.id", "rec.seasons")
    covered = latest_coverage(parsed).select(
        c("id").alias("league_id"),
        F.try_element_at("seasons", F.lit(-1))["year"].alias("season"),
        c("coverage.fixtures.events").alias("has_events"),
        c("coverage.odds").alias("has_odds"),
    )
    return keyed.join(covered.distinct(), ["league_id", "season"]).select("fixture_id", "has_events", "has_odds")


_PLAYERS = """
pl AS (
  SELECT p_partkey AS player_id, p_name AS player_name, 'First ' || (p_partkey%97) AS firstname, p_brand AS lastname,
    CAST(p_partkey%20+17 AS INTEGER) AS age, make_date(p_partkey%20+1980, 5, 17) AS birth_date, p_type AS nationality,
    (p_size+150) || ' cm' AS height, CAST(NULL AS VARCHAR) AS weight, CAST(NULL AS VARCHAR) AS photo_url,
    p_partkey%5*100+(p_partkey+s)%20 AS team_id, CAST(s AS INTEGER) AS season,
    CASE WHEN p_partkey%2=0 THEN 'Attacker' ELSE 'Defender' END AS position
  FROM part, (VALUES (2000),(2001)) t(s))"""


@typed_query("silver_players", with_(_PLAYERS, body="SELECT * FROM pl"))
def silver_players(spark, sf):
    return silver.players(testbed.raw_players(spark, sf))


@typed_query("stg_players", with_(_PLAYERS, body="SELECT * FROM pl WHERE season=2001"))
def stg_players(spark, sf):
    return silver.stg_players(silver.players(testbed.raw_players(spark, sf)), 2001)


@typed_query(
    "silver_transfers",
    """SELECT DISTINCT o_custkey AS player_id, 'Player ' || o_custkey AS player_name,
  o_custkey%5*100+o_orderkey%20 AS to_team_id, 'Team ' || (o_custkey%5*100+o_orderkey%20) AS to_team_name,
  o_custkey%5*100+(o_orderkey+7)%20 AS from_team_id, 'Team ' || (o_custkey%5*100+(o_orderkey+7)%20) AS from_team_name,
  CAST(o_orderdate AS DATE) AS transfer_date, CASE WHEN o_orderkey%2=0 THEN 'Loan' ELSE 'Free' END AS transfer_type
FROM orders""",
)
def silver_transfers(spark, sf):
    return silver.transfers(testbed.raw_transfers(spark, sf))


_API = """SELECT fixture_id, home_team_id AS pred_winner_id, 'Team ' || home_team_id AS pred_winner_name,
  {h} AS pred_home_pct, {d} AS pred_draw_pct, {a} AS pred_away_pct, 'Double chance' AS pred_advice FROM mt"""


@query(
    "silver_api_predictions",
    with_(
        FX,
        body=_API.format(
            h="(fixture_id*13%60) || '%'", d="(fixture_id*7%40) || '%'", a="(fixture_id*11%50) || '%'"
        ),
    ),
)
def silver_api_predictions(spark, sf):
    return silver.api_predictions(testbed.raw_api_predictions(spark, sf)).select(
        "fixture_id", "pred_winner_id", "pred_winner_name", "pred_home_pct", "pred_draw_pct", "pred_away_pct", "pred_advice"
    )


@query(
    "stg_api_predictions",
    with_(
        FX,
        body=_API.format(
            **{k: f"CAST(fixture_id*{m}%{n} AS DOUBLE)/CAST(100 AS DOUBLE)" for k, m, n in (("h", 13, 60), ("d", 7, 40), ("a", 11, 50))}
        ),
    ),
)
def stg_api_predictions(spark, sf):
    return silver.stg_api_predictions(silver_api_predictions(spark, sf))


@query("stg_fixtures", with_(FX, body="SELECT fixture_id, status, result FROM fx WHERE status IN ('FT','NS','AET','PEN')"))
def stg_fixtures(spark, sf):
    return silver.stg_fixtures(testbed.fixtures(spark, sf)).select("fixture_id", "status", "result")


@query(
    "team_rows",
    with_(
        TEAMS,
        body="""SELECT fixture_id, team_id, opponent_id, is_home, goals_for, goals_against, outcome, match_date FROM tr""",
    ),
)
def team_rows(spark, sf):
    return flatten.to_team_rows(testbed.fixtures(spark, sf)).select(
        "fixture_id", "team_id", "opponent_id", "is_home", "goals_for", "goals_against", "outcome", "match_date"
    )


@query("confidence_band", with_(FX, PREDS, body="SELECT fixture_id, confidence FROM p"))
def confidence(spark, sf):
    probs = [c("prob_home_win"), c("prob_draw"), c("prob_away_win")]
    return testbed.predictions(spark, sf).select("fixture_id", confidence_band(*probs).alias("confidence"))


@query("argmax_label", with_(FX, PREDS, body="SELECT fixture_id, predicted_result FROM p"))
def argmax(spark, sf):
    probs = {"H": c("prob_home_win"), "D": c("prob_draw"), "A": c("prob_away_win")}
    return testbed.predictions(spark, sf).select("fixture_id", argmax_label(probs).alias("predicted_result"))


@query(
    "split_by_target",
    with_(FX, body="SELECT CASE WHEN result IS NULL THEN 'predict' ELSE 'train' END AS part, count(*) AS n FROM fx GROUP BY 1"),
)
def split_by_target(spark, sf):
    from touchline.plans.model import split_by_target as split

    train, predict = split(testbed.fixtures(spark, sf), "result")
    parts = train.select(F.lit("train").alias("part")).unionByName(predict.select(F.lit("predict").alias("part")))
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
