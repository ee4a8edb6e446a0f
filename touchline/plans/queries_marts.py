"""Queries over forms, joins, aggregates and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.operators import aggregates, elo, flatten, form, history, joins
from touchline.operators.ordered import DEFAULT_SKEW, asof_join, latest_snapshot
from touchline.plans import marts, testbed
from touchline.plans.catalog import query
from touchline.plans.sqltext import FX, LINES, PREDS, QUOTES, SEASONS, TEAMS, with_
from touchline.session import stored

c = F.col

WINDOW_AFTER = "OVER (PARTITION BY team_id ORDER BY match_date, fixture_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"
WINDOW_BEFORE = "OVER (PARTITION BY team_id ORDER BY match_date, fixture_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)"


def _form_columns(window: str) -> str:
    def total(label: str) -> str:
        return f"CAST(coalesce(sum(CASE WHEN outcome='{label}' THEN 1 ELSE 0 END) {window}, 0) AS INTEGER)"

    return f"""{total('W')} AS wins_last_5, {total('D')} AS draws_last_5, {total('L')} AS losses_last_5,
  round(avg(goals_for) {window}, 6) AS goals_scored_avg_5, round(avg(goals_against) {window}, 6) AS goals_conceded_avg_5,
  CAST(coalesce(sum(CASE outcome WHEN 'W' THEN 3 WHEN 'D' THEN 1 ELSE 0 END) {window}, 0) AS INTEGER) AS points_last_5"""


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


FORM_OUT = ["fixture_id", "team_id", *marts.FORM]


@query("team_form", with_(TEAMS, body=f"SELECT fixture_id, team_id, {_form_columns(WINDOW_AFTER)} FROM pr"))
def team_form(spark, sf):
    rows = form.rolling_form(marts.played_rows(testbed.fixtures(spark, sf)), 5, "after")
    return _rounded(rows, "goals_scored_avg_5", "goals_conceded_avg_5").select(*FORM_OUT)


@query("team_form_before", with_(TEAMS, body=f"SELECT fixture_id, team_id, {_form_columns(WINDOW_BEFORE)} FROM pr"))
def team_form_before(spark, sf):
    rows = form.rolling_form(marts.played_rows(testbed.fixtures(spark, sf)), 5, "before", skew=DEFAULT_SKEW)
    return _rounded(rows, "goals_scored_avg_5", "goals_conceded_avg_5").select(*FORM_OUT)


@query(
    "form_string",
    with_(TEAMS, body=f"SELECT fixture_id, team_id, string_agg(outcome, '') {WINDOW_AFTER} AS form_string FROM pr"),
)
def form_string(spark, sf):
    rows = form.rolling_form(marts.played_rows(testbed.fixtures(spark, sf)), 5, "after")
    return rows.select("fixture_id", "team_id", "form_string")


@query(
    "venue_form",
    with_(
        TEAMS,
        body=f"SELECT fixture_id, team_id, is_home, {_form_columns(WINDOW_AFTER.replace('team_id ', 'team_id, is_home '))} FROM pr",
    ),
)
def venue_form(spark, sf):
    rows = form.rolling_form(marts.played_rows(testbed.fixtures(spark, sf)), 5, "after", by_venue=True)
    return _rounded(rows, "goals_scored_avg_5", "goals_conceded_avg_5").select(*FORM_OUT, "is_home")


@query(
    "rest_days",
    with_(
        TEAMS,
        body="""SELECT fixture_id, team_id, CAST(date_diff('day', lag(match_date) OVER (PARTITION BY team_id
  ORDER BY match_date, fixture_id), match_date) AS INTEGER) AS rest_days FROM pr""",
    ),
)
def rest_days(spark, sf):
    rows = form.days_since_last(marts.played_rows(testbed.fixtures(spark, sf)))
    return rows.select("fixture_id", "team_id", "rest_days")


@query(
    "odds_movement",
    with_(
        QUOTES,
        body="""SELECT fixture_id, bookmaker_id, outcome, quote_id, odd, lag(odd) OVER w AS previous_odd,
  round(odd - lag(odd) OVER w, 6) AS odd_change, first_value(odd) OVER full_w AS opening_odd,
  last_value(odd) OVER full_w AS closing_odd FROM (
    SELECT *, l_partkey*1000000+l_suppkey*100+l_linenumber AS quote_id FROM q)
WINDOW w AS (PARTITION BY fixture_id, bookmaker_id, outcome ORDER BY day, quote_id),
  full_w AS (PARTITION BY fixture_id, bookmaker_id, outcome ORDER BY day, quote_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    ),
)
def odds_movement(spark, sf):
    quote_id = c("l_partkey") * 1000000 + c("l_suppkey") * 100 + c("l_linenumber")
    rows = testbed.quotes(spark, sf).select(
        "fixture_id", "bookmaker_id", "outcome", "odd", c("day").alias("ts"), quote_id.alias("quote_id")
    )
    return form.odds_movement(rows, skew=DEFAULT_SKEW).drop("ts").withColumn("odd_change", F.round("odd_change", 6))


# --- ratings --------------------------------------------------------------------------------------

_ELO = """
n AS MATERIALIZED (
  SELECT league_id AS pool, row_number() OVER (PARTITION BY league_id ORDER BY match_date, fixture_id) AS i, fixture_id,
    season, home_team_id%100 AS h, away_team_id%100 AS a, goals_home, goals_away FROM fx WHERE result IS NOT NULL),
e AS (
  SELECT r_regionkey AS pool, CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS fixture_id,
    list_transform(range(20), lambda x: CAST(1500 AS DOUBLE)) AS r, list_transform(range(20), lambda x: CAST(NULL AS INTEGER)) AS s,
    CAST(0 AS DOUBLE) AS hb, CAST(0 AS DOUBLE) AS ab, CAST(0 AS DOUBLE) AS g FROM region
  UNION ALL
  SELECT pool, i, fixture_id,
    list_transform(range(20), lambda x: CASE WHEN x=h THEN hb+g WHEN x=a THEN ab-g ELSE r[x+1] END),
    list_transform(range(20), lambda x: CASE WHEN x=h OR x=a THEN season ELSE s[x+1] END), hb, ab, g
  FROM (
    SELECT *, CAST(20 AS DOUBLE)*((CASE WHEN goals_home>goals_away THEN CAST(1 AS DOUBLE) WHEN goals_home=goals_away THEN 0.5 ELSE 0 END)
        - 1/(1+pow(CAST(10 AS DOUBLE), (ab-hb-100)/400)))*ln(abs(goals_home-goals_away)+CAST(1 AS DOUBLE)) AS g
    FROM (
      SELECT e.pool, n.i, n.fixture_id, n.season, h, a, goals_home, goals_away, e.r, e.s,
        1500+(e.r[h+1]-1500)*pow(CAST(0.9 AS DOUBLE), greatest(n.season-coalesce(e.s[h+1], n.season), 0)) AS hb,
        1500+(e.r[a+1]-1500)*pow(CAST(0.9 AS DOUBLE), greatest(n.season-coalesce(e.s[a+1], n.season), 0)) AS ab
      FROM e JOIN n ON n.pool=e.pool AND n.i=e.i+1)))"""


_RATED = with_(
    FX,
    _ELO,
    body="""SELECT fixture_id, round(hb,4) AS home_before, round(ab,4) AS away_before, round(hb+g,4) AS home_after,
  round(ab-g,4) AS away_after FROM e WHERE i>0""",
)


def _rated(rows):
    return rows.select(
        "fixture_id", *[F.round(n, 4).alias(n) for n in ("home_before", "away_before", "home_after", "away_after")]
    )


@query("elo_ratings", _RATED)
def elo_ratings(spark, sf):
    return _rated(elo.elo_ratings(testbed.fixtures(spark, sf)))


@query("elo_by_period", _RATED)
def elo_by_period(spark, sf):
    """Year by year over stored states: the same values."""
    fixtures = stored(testbed.fixtures(spark, sf), "fixtures")
    return _rated(spark.read.parquet(elo.elo_by_period(fixtures)))


@query("elo_by_rows", _RATED)
def elo_by_rows(spark, sf):
    """Slabs of 500 matches of a pool, wider ones where 64 of them do not hold the history: the same values."""
    return _rated(elo.elo_ratings(testbed.fixtures(spark, sf), rows_per_task=500))


_CURRENT = """
cr AS (
  SELECT pool*100+x AS team_id, round(r[x+1],4) AS rating FROM (
    SELECT * FROM e WHERE i>0 QUALIFY row_number() OVER (PARTITION BY pool ORDER BY i DESC)=1), range(20) t(x)
  WHERE s[x+1] IS NOT NULL)"""


@query("team_strength", with_(FX, _ELO, _CURRENT, body="SELECT * FROM cr"))
def team_strength(spark, sf):
    return marts.team_strength(testbed.fixtures(spark, sf)).select("team_id", F.round("rating", 4).alias("rating"))


@query("elo_resumed", with_(FX, _ELO, _CURRENT, body="SELECT * FROM cr"))
def elo_resumed(spark, sf):
    """Two runs, the second resuming from the ratings of the first, end where one run ends."""
    fixtures = testbed.fixtures(spark, sf)
    cut = F.make_date(F.lit(1998), F.lit(7), F.lit(1))
    first = elo.current_ratings(elo.elo_ratings(fixtures.filter(c("match_date") < cut)))
    second = elo.current_ratings(elo.elo_ratings(fixtures.filter(c("match_date") >= cut), init=first))
    kept = first.join(second, ["pool", "team_id"], "left_anti").unionByName(second)
    return kept.select("team_id", F.round("rating", 4).alias("rating"))


# --- aggregates -----------------------------------------------------------------------------------


@query(
    "odds_consensus",
    with_(
        QUOTES,
        body="""SELECT fixture_id, bookmakers, round(ha,6) AS odd_home_avg, hm AS odd_home_median, hx AS odd_home_max,
  hn AS odd_home_min, round(da,6) AS odd_draw_avg, round(aa,6) AS odd_away_avg, dm AS odd_draw_median, am AS odd_away_median,
  round((1/ha)/(1/ha+1/da+1/aa),6) AS implied_home FROM (
  SELECT fixture_id, count(DISTINCT bookmaker_id) AS bookmakers, avg(odd_home) AS ha, round(median(odd_home),6) AS hm,
    max(odd_home) AS hx, min(odd_home) AS hn, avg(odd_draw) AS da, avg(odd_away) AS aa, round(median(odd_draw),6) AS dm,
    round(median(odd_away),6) AS am FROM ow GROUP BY fixture_id)""",
    ),
)
def odds_consensus(spark, sf):
    rows = aggregates.odds_consensus(testbed.odds_wide(spark, sf))
    names = ["odd_home_avg", "odd_draw_avg", "odd_away_avg", "odd_home_median", "odd_draw_median", "odd_away_median", "implied_home"]
    return _rounded(rows, *names).select("fixture_id", "bookmakers", "odd_home_max", "odd_home_min", *names)


@query(
    "odds_consensus_any_price",
    with_(
        QUOTES,
        body="""SELECT fixture_id, round(avg(p), 4) AS odd_home_avg, round(median(p), 4) AS odd_home_median, max(p) AS odd_home_max, min(p) AS odd_home_min
FROM (SELECT fixture_id, odd_home*4321.0987 AS p FROM ow) GROUP BY fixture_id""",
    ),
)
def odds_consensus_any_price(spark, sf):
    """Prices with many decimals, and of 10,000 and above."""
    wide = testbed.odds_wide(spark, sf).withColumn("odd_home", c("odd_home") * F.lit(4321.0987))
    rows = aggregates.odds_consensus(wide).withColumns({n: F.round(n, 4) for n in ("odd_home_avg", "odd_home_median")})
    return rows.select("fixture_id", "odd_home_avg", "odd_home_median", "odd_home_max", "odd_home_min")


@query(
    "implied_probs",
    with_(
        QUOTES,
        body="""SELECT fixture_id, bookmaker_id, round((1/odd_home)/t,6) AS p_home, round((1/odd_draw)/t,6) AS p_draw,
  round((1/odd_away)/t,6) AS p_away FROM (SELECT *, 1/odd_home+1/odd_draw+1/odd_away AS t FROM ow) WHERE t IS NOT NULL""",
    ),
)
def implied_probs(spark, sf):
    from touchline.functions.columns import implied_probs as probs

    columns = probs({o: c(f"odd_{o}") for o in ("home", "draw", "away")})
    rows = testbed.odds_wide(spark, sf).dropna(subset=["odd_home", "odd_draw", "odd_away"])
    return rows.select("fixture_id", "bookmaker_id", *[F.round(p, 6).alias(f"p_{o}") for o, p in columns.items()])


_PAIRS = """
m AS (
  SELECT league_id, fixture_id, match_date, least(home_team_id,away_team_id) AS team_a, greatest(home_team_id,away_team_id) AS team_b,
    CAST((home_team_id<away_team_id AND result='H') OR (home_team_id>away_team_id AND result='A') AS INTEGER) AS a_win,
    CAST(result='D' AS INTEGER) AS draw,
    CAST((home_team_id<away_team_id AND result='A') OR (home_team_id>away_team_id AND result='H') AS INTEGER) AS b_win,
    CASE WHEN home_team_id<away_team_id THEN goals_home ELSE goals_away END AS a_goals,
    CASE WHEN home_team_id<away_team_id THEN goals_away ELSE goals_home END AS b_goals FROM fx WHERE result IS NOT NULL)"""


def _head_to_head_sql(n: int | None) -> str:
    last = "" if n is None else f"QUALIFY row_number() OVER (PARTITION BY league_id,team_a,team_b ORDER BY match_date DESC, fixture_id DESC)<={n}"
    return with_(
        FX,
        _PAIRS,
        f"""
g AS (SELECT league_id, team_a, team_b, CAST(count(*) AS INTEGER) AS total_matches, CAST(sum(a_win) AS INTEGER) AS aw,
  CAST(sum(draw) AS INTEGER) AS draws, CAST(sum(b_win) AS INTEGER) AS bw, round(avg(a_goals),6) AS ag, round(avg(b_goals),6) AS bg
  FROM (SELECT * FROM m {last}) GROUP BY ALL)""",
        body="""SELECT league_id, team_a AS home_team_id, team_b AS away_team_id, total_matches, aw AS home_wins, draws,
  bw AS away_wins, ag AS home_goals_avg, bg AS away_goals_avg FROM g
UNION ALL SELECT league_id, team_b, team_a, total_matches, bw, draws, aw, bg, ag FROM g""",
    )


@query("head_to_head", _head_to_head_sql(10))
def head_to_head(spark, sf):
    return _rounded(aggregates.head_to_head(testbed.fixtures(spark, sf), 10), "home_goals_avg", "away_goals_avg")


@query("head_to_head_all_time", _head_to_head_sql(None))
def head_to_head_all_time(spark, sf):
    return _rounded(aggregates.head_to_head(testbed.fixtures(spark, sf), None), "home_goals_avg", "away_goals_avg")


def _share_sql(label: str) -> str:
    return f"round(sum(CASE WHEN result='{label}' THEN 100 ELSE 0 END)/nullif(count(result),0),6)"


@query(
    "league_summary",
    with_(
        FX,
        body=f"""SELECT league_id, season, CAST(count(*) AS INTEGER) AS total_matches, CAST(count(result) AS INTEGER) AS matches_played,
  CAST(count(*)-count(result) AS INTEGER) AS matches_pending, {_share_sql('H')} AS home_win_pct, {_share_sql('D')} AS draw_pct,
  {_share_sql('A')} AS away_win_pct, round(avg(goals_home+goals_away) FILTER (WHERE result IS NOT NULL),6) AS avg_goals
FROM fx GROUP BY league_id, season""",
    ),
)
def league_summary(spark, sf):
    rows = aggregates.league_summary(testbed.fixtures(spark, sf))
    return _rounded(rows, "home_win_pct", "draw_pct", "away_win_pct", "avg_goals")


@query(
    "round_summary",
    with_(
        FX,
        body="""SELECT league_id, season, round, count(result) AS matches_played, CAST(sum(goals_home+goals_away) AS BIGINT) AS goals,
  round(avg(goals_home+goals_away),6) AS avg_goals, count(*) FILTER (WHERE result='H') AS home_wins,
  count(*) FILTER (WHERE result='D') AS draws, count(*) FILTER (WHERE result='A') AS away_wins
FROM fx GROUP BY league_id, season, round""",
    ),
)
def round_summary(spark, sf):
    return _rounded(aggregates.round_summary(testbed.fixtures(spark, sf)), "avg_goals")


@query("team_season_stats", with_(TEAMS, SEASONS, body="SELECT * FROM ss"))
def team_season_stats(spark, sf):
    return aggregates.team_season_stats(flatten.to_team_rows(testbed.fixtures(spark, sf)))


_IMPACT = """
av AS (SELECT season, team_id, count(DISTINCT fixture_id)*90 AS available FROM ps GROUP BY ALL),
pi AS (
  SELECT season, team_id, player_id, CAST(sum(goals) AS BIGINT) AS goals, CAST(sum(assists) AS BIGINT) AS assists,
    CAST(sum(minutes_played) AS BIGINT) AS minutes, avg(rating) AS rating_avg FROM ps GROUP BY ALL)"""


@query(
    "player_impact",
    with_(
        FX,
        LINES,
        _IMPACT,
        body="""SELECT season, team_id, player_id, goals, assists, minutes, round(rating_avg,6) AS rating_avg,
  round(goals*90/minutes,6) AS goals_per_90, round(assists*90/minutes,6) AS assists_per_90,
  round(minutes*100/available,6) AS minutes_played_pct FROM pi JOIN av USING (season, team_id)""",
    ),
)
def player_impact(spark, sf):
    rows = aggregates.player_impact(testbed.player_stats(spark, sf))
    return _rounded(rows, "rating_avg", "goals_per_90", "assists_per_90", "minutes_played_pct")


_KEY = """
kp AS (
  SELECT season, team_id, player_id, goals, assists, CAST(row_number() OVER (PARTITION BY season, team_id
    ORDER BY goals+assists DESC, minutes DESC, player_id) AS INTEGER) AS rank FROM pi QUALIFY rank<=5)"""


@query("key_players", with_(FX, LINES, _IMPACT, _KEY, body="SELECT * FROM kp"))
def key_players(spark, sf):
    impact = aggregates.player_impact(testbed.player_stats(spark, sf))
    return aggregates.key_players(impact).select("season", "team_id", "player_id", "goals", "assists", "rank")


@query(
    "injury_counts",
    with_(
        FX,
        LINES,
        body="SELECT fixture_id, team_id, CAST(count(DISTINCT player_id) AS INTEGER) AS injuries_count FROM inj GROUP BY ALL",
    ),
)
def injury_counts(spark, sf):
    return aggregates.injury_counts(testbed.injuries(spark, sf))


_INJURED = """
ik AS (
  SELECT inj.fixture_id, inj.team_id, CAST(count(DISTINCT inj.player_id) AS INTEGER) AS injuries_count,
    CAST(count(DISTINCT CASE WHEN kp.player_id IS NOT NULL THEN inj.player_id END) AS INTEGER) AS key_players_out
  FROM inj LEFT JOIN kp USING (season, team_id, player_id) GROUP BY ALL)"""


@query("injury_features", with_(FX, LINES, _IMPACT, _KEY, _INJURED, body="SELECT * FROM ik"))
def injury_features(spark, sf):
    key = aggregates.key_players(aggregates.player_impact(testbed.player_stats(spark, sf)))
    return aggregates.injury_features(testbed.injuries(spark, sf), key)


@query(
    "quota_status",
    """SELECT day, requests, remaining, quota, round((quota-remaining)*100/quota,2) AS used_pct,
  CASE WHEN remaining<=0 THEN 'exhausted' WHEN (quota-remaining)*100/quota>=95 THEN 'critical'
    WHEN (quota-remaining)*100/quota>=80 THEN 'warning' ELSE 'ok' END AS status
FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS requests, min(CAST(json_extract(props,'$.k') AS INTEGER)) AS remaining,
  1000 AS quota FROM events GROUP BY 1)""",
)
def quota_status(spark, sf):
    return aggregates.quota_status(testbed.request_log(spark, sf))


@query(
    "duplicate_report",
    with_(
        QUOTES,
        body="""SELECT 'odds' AS table_name, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, CAST(sum(n)-count(*) AS BIGINT) AS duplicates
FROM (SELECT count(*) AS n FROM q GROUP BY fixture_id, bookmaker_id, outcome)""",
    ),
)
def duplicate_report(spark, sf):
    return aggregates.duplicate_report(testbed.quotes(spark, sf), ["fixture_id", "bookmaker_id", "outcome"], "odds")


# --- joins ----------------------------------------------------------------------------------------

_ASOF_FORM = f"""
fa AS (SELECT fixture_id AS source_fixture, team_id, match_date, {_form_columns(WINDOW_AFTER)} FROM pr),
fl AS (SELECT * FROM fa QUALIFY row_number() OVER (PARTITION BY team_id, match_date ORDER BY source_fixture DESC)=1),
af AS (
  SELECT t.fixture_id, t.team_id, t.is_home, t.match_date, fl.* EXCLUDE (team_id, match_date), fl.match_date AS source_date
  FROM tr t ASOF LEFT JOIN fl ON fl.team_id=t.team_id AND t.match_date>fl.match_date)"""


@query(
    "asof_form",
    with_(TEAMS, _ASOF_FORM, body="SELECT fixture_id, team_id, wins_last_5, points_last_5, source_fixture, source_date FROM af"),
)
def asof_form(spark, sf):
    fixtures = testbed.fixtures(spark, sf)
    state = marts.team_form(fixtures).select(
        "team_id", "match_date", c("fixture_id").alias("source_fixture"), "wins_last_5", "points_last_5"
    )
    asked = flatten.to_team_rows(fixtures).select("fixture_id", "team_id", "match_date")
    return asof_join(
        asked,
        state,
        ["team_id"],
        "match_date",
        "match_date",
        ["wins_last_5", "points_last_5", "source_fixture"],
        ["source_fixture"],
        matched_ts="source_date",
    ).drop("match_date")


@query(
    "asof_non_strict",
    with_(
        TEAMS,
        _ASOF_FORM,
        body="""SELECT t.fixture_id, t.team_id, fl.source_fixture FROM tr t ASOF LEFT JOIN fl
  ON fl.team_id=t.team_id AND t.match_date>=fl.match_date""",
    ),
)
def asof_non_strict(spark, sf):
    fixtures = testbed.fixtures(spark, sf)
    played = marts.played_rows(fixtures).select("team_id", "match_date", c("fixture_id").alias("source_fixture"))
    asked = flatten.to_team_rows(fixtures).select("fixture_id", "team_id", "match_date")
    return asof_join(
        asked, played, ["team_id"], "match_date", "match_date", ["source_fixture"], ["source_fixture"], strict=False,
        skew=DEFAULT_SKEW,
    ).drop("match_date")


@query(
    "orphans",
    with_(FX, QUOTES, body="SELECT count(*) AS n, count(DISTINCT q.fixture_id) AS n_fixtures FROM q ANTI JOIN (SELECT * FROM fx WHERE result IS NOT NULL) f USING (fixture_id)"),
)
def orphans(spark, sf):
    finished = testbed.fixtures(spark, sf).filter(c("result").isNotNull())
    lost = joins.orphans(testbed.quotes(spark, sf), finished, ["fixture_id"])
    return lost.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("fixture_id").alias("n_fixtures"))


@query(
    "restrict_to",
    with_(FX, QUOTES, body="SELECT fixture_id, bookmaker_id, outcome, odd FROM q SEMI JOIN (SELECT * FROM fx WHERE league_id=2) f USING (fixture_id)"),
)
def restrict_to(spark, sf):
    asked = testbed.fixtures(spark, sf).filter(c("league_id") == 2)
    rows = testbed.quotes(spark, sf).select("fixture_id", "bookmaker_id", "outcome", "odd")
    return joins.restrict_to(rows, asked, ["fixture_id"])


@query(
    "home_away_join",
    with_(
        TEAMS,
        SEASONS,
        body="""SELECT fixture_id, h.position AS home_position, a.position AS away_position, h.position-a.position AS position_diff
FROM fx LEFT JOIN st h ON h.season=fx.season AND h.team_id=home_team_id
  LEFT JOIN st a ON a.season=fx.season AND a.team_id=away_team_id""",
    ),
)
def home_away_join(spark, sf):
    fixtures = testbed.fixtures(spark, sf).select("fixture_id", "season", "home_team_id", "away_team_id")
    table = testbed.season_standings(spark, sf).select("team_id", "season", "position")
    joined = joins.join_home_away(fixtures, table, ["season"], ["position"], ["position"])
    return joined.select("fixture_id", "home_position", "away_position", "position_diff")


_DERBY = """
db AS (
  SELECT DISTINCT CAST(n_regionkey AS BIGINT)*100+n_nationkey%19 AS a, CAST(n_regionkey AS BIGINT)*100+n_nationkey%19+1 AS b FROM nation)"""


@query(
    "derby_flag",
    with_(
        FX,
        _DERBY,
        body="""SELECT fixture_id, db.a IS NOT NULL AS is_derby FROM fx
LEFT JOIN db ON least(home_team_id,away_team_id)=db.a AND greatest(home_team_id,away_team_id)=db.b""",
    ),
)
def derby_flag(spark, sf):
    flagged = joins.flag_pairs(testbed.fixtures(spark, sf), testbed.derbies(spark, sf), "home_team_id", "away_team_id")
    return flagged.select("fixture_id", "is_derby")


@query(
    "match_context",
    with_(
        FX,
        _DERBY,
        body="""SELECT fixture_id, db.a IS NOT NULL AS is_derby, league_id=4 AS is_cup_match FROM fx
LEFT JOIN db ON least(home_team_id,away_team_id)=db.a AND greatest(home_team_id,away_team_id)=db.b""",
    ),
)
def match_context(spark, sf):
    return marts.match_context(testbed.fixtures(spark, sf), testbed.derbies(spark, sf), testbed.league_types(spark, sf))


@query(
    "latest_snapshot",
    with_(
        TEAMS,
        SEASONS,
        body="""SELECT league_id, season, team_id, position FROM st
QUALIFY rank() OVER (PARTITION BY league_id ORDER BY _snapshot_date DESC)=1""",
    ),
)
def latest_snapshot_query(spark, sf):
    rows = latest_snapshot(testbed.season_standings(spark, sf), ["league_id"], "_snapshot_date")
    return rows.select("league_id", "season", "team_id", "position")


# --- change history -------------------------------------------------------------------------------


@query(
    "scd2_from_log",
    with_(
        TEAMS,
        """
lo AS (SELECT team_id, match_date, fixture_id, outcome, lag(outcome) OVER w AS po, row_number() OVER w AS rn FROM pr
  WINDOW w AS (PARTITION BY team_id ORDER BY match_date, fixture_id))""",
        body="""SELECT team_id, fixture_id, outcome, match_date AS valid_from,
  lead(match_date) OVER (PARTITION BY team_id ORDER BY match_date, fixture_id) AS valid_to,
  lead(match_date) OVER (PARTITION BY team_id ORDER BY match_date, fixture_id) IS NULL AS is_current
FROM lo WHERE rn=1 OR po IS DISTINCT FROM outcome""",
    ),
)
def scd2_from_log(spark, sf):
    log = marts.played_rows(testbed.fixtures(spark, sf)).select("team_id", "match_date", "fixture_id", "outcome")
    return history.scd2_from_log(log, ["team_id"], ["outcome"], ["match_date", "fixture_id"], DEFAULT_SKEW).drop("match_date")


@query(
    "scd2_standings",
    with_(
        TEAMS,
        SEASONS,
        body="""SELECT team_id, season, position, points, _snapshot_date AS valid_from, lead(_snapshot_date) OVER w AS valid_to,
  lead(_snapshot_date) OVER w IS NULL AS is_current FROM (
    SELECT * FROM st QUALIFY row_number() OVER (PARTITION BY team_id ORDER BY season)=1
      OR position IS DISTINCT FROM lag(position) OVER (PARTITION BY team_id ORDER BY season)
      OR points IS DISTINCT FROM lag(points) OVER (PARTITION BY team_id ORDER BY season))
WINDOW w AS (PARTITION BY team_id ORDER BY season)""",
    ),
)
def scd2_standings(spark, sf):
    log = testbed.season_standings(spark, sf).select("team_id", "season", "position", "points", "_snapshot_date")
    return history.scd2_from_log(
        log, ["team_id"], ["position", "points"], ["_snapshot_date", "season"]
    ).drop("_snapshot_date")


def _season_end(season: int):
    return F.make_date(F.lit(season), F.lit(12), F.lit(31))


@query(
    "scd2_apply",
    with_(
        TEAMS,
        SEASONS,
        """
sn AS (SELECT team_id, season, position, points, lag((position, points)) OVER (PARTITION BY team_id ORDER BY season) AS old FROM st),
ch AS (SELECT team_id, season, position, points FROM sn WHERE old IS NULL OR old <> (position, points))""",
        body="""SELECT team_id, position, points, make_date(season, 12, 31) AS valid_from,
  make_date(lead(season) OVER w, 12, 31) AS valid_to, lead(season) OVER w IS NULL AS is_current
FROM ch WINDOW w AS (PARTITION BY team_id ORDER BY season)""",
    ),
)
def scd2_apply(spark, sf):
    """The standings of every season applied in order to a stored history."""
    table = stored(testbed.season_standings(spark, sf).select("season", "team_id", "position", "points"), "standings")
    kept = None
    for season in sorted(r.season for r in table.select("season").distinct().collect()):
        snapshot = table.filter(c("season") == season).drop("season")
        if kept is None:
            day = _season_end(season).alias("valid_from")
            kept = snapshot.select("*", day, F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"))
        else:
            kept = history.scd2_apply(kept, snapshot, ["team_id"], ["position", "points"], _season_end(season))
        kept = stored(kept, "standings-history")
    return kept


@query(
    "scd2_strength",
    with_(
        FX,
        _ELO,
        """
tg AS (SELECT pool*100+h_or_a AS team_id, fixture_id, rating FROM (
    SELECT e.pool, e.fixture_id, n.h AS h_or_a, round(hb+g) AS rating FROM e JOIN n ON n.pool=e.pool AND n.i=e.i WHERE e.i>0
    UNION ALL SELECT e.pool, e.fixture_id, n.a, round(ab-g) FROM e JOIN n ON n.pool=e.pool AND n.i=e.i WHERE e.i>0)),
td AS (SELECT tg.*, match_date, lag(rating) OVER w AS pr, row_number() OVER w AS rn FROM tg JOIN fx USING (fixture_id)
  WINDOW w AS (PARTITION BY team_id ORDER BY match_date, fixture_id))""",
        body="""SELECT team_id, fixture_id, CAST(rating AS INTEGER) AS elo_rating, match_date AS valid_from,
  lead(match_date) OVER (PARTITION BY team_id ORDER BY match_date, fixture_id) AS valid_to
FROM td WHERE rn=1 OR pr<>rating""",
    ),
)
def scd2_strength(spark, sf):
    rated = elo.team_ratings(elo.elo_ratings(testbed.fixtures(spark, sf)))
    log = rated.select("team_id", "match_date", "fixture_id", F.round("elo_after").cast("int").alias("elo_rating"))
    return history.scd2_from_log(log, ["team_id"], ["elo_rating"], ["match_date", "fixture_id"]).drop(
        "match_date", "is_current"
    )


# --- feature mart ---------------------------------------------------------------------------------


def feature_mart(spark, sf):
    """The mart over stored inputs: fixtures and line items with their match are read several times."""
    fixtures = stored(testbed.fixtures(spark, sf), "fixtures")
    state = marts.newest_form(fixtures, elo.elo_ratings(fixtures), within=("match_date",))
    lines = testbed.line_rows(spark, sf, fixtures)
    read = [n for n in lines.columns if n not in ("day", "status", "result", "round", "home_team_id", "away_team_id", "goals_home", "goals_away")]
    lines = stored(lines.select(*read), "lines")
    key = aggregates.key_players(aggregates.player_impact(testbed.player_stats(spark, sf, lines)))
    return marts.match_features(
        fixtures,
        state,
        testbed.odds_wide(spark, sf),
        testbed.season_standings(spark, sf, fixtures),
        testbed.injuries(spark, sf, lines),
        key,
        testbed.api_predictions(spark, sf, fixtures),
        testbed.derbies(spark, sf),
        testbed.league_types(spark, sf),
    )


_FEATURES_SQL = with_(
    TEAMS,
    SEASONS,
    QUOTES,
    LINES,
    _IMPACT,
    _KEY,
    _INJURED,
    _DERBY,
    _PAIRS,
    _ELO,
    _ASOF_FORM,
    f"""
vf AS (SELECT team_id, is_home, match_date, fixture_id, CAST(sum(CASE WHEN outcome='W' THEN 1 ELSE 0 END) OVER (
    PARTITION BY team_id, is_home ORDER BY match_date, fixture_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS INTEGER) AS w FROM pr),
vl AS (SELECT * FROM vf QUALIFY row_number() OVER (PARTITION BY team_id, is_home, match_date ORDER BY fixture_id DESC)=1),
va AS (SELECT t.fixture_id, t.is_home, coalesce(vl.w,0) AS w FROM tr t
    ASOF LEFT JOIN vl ON vl.team_id=t.team_id AND vl.is_home=t.is_home AND t.match_date>vl.match_date),
er AS (SELECT e.fixture_id, e.pool*100+n.h AS team_id, hb+g AS rating FROM e JOIN n ON n.pool=e.pool AND n.i=e.i WHERE e.i>0
    UNION ALL SELECT e.fixture_id, e.pool*100+n.a, ab-g FROM e JOIN n ON n.pool=e.pool AND n.i=e.i WHERE e.i>0),
ts AS (SELECT af.*, CAST(round(coalesce(er.rating,1500)) AS INTEGER) AS elo_rating,
    CAST(date_diff('day', source_date, match_date) AS INTEGER) AS rest
    FROM af LEFT JOIN er ON er.fixture_id=af.source_fixture AND er.team_id=af.team_id),
mm AS (SELECT league_id, team_a, team_b, match_date, fixture_id, CAST(count(*) OVER w AS INTEGER) AS g, CAST(sum(a_win) OVER w AS INTEGER) AS aw,
    CAST(sum(draw) OVER w AS INTEGER) AS d, CAST(sum(b_win) OVER w AS INTEGER) AS bw, sum(a_goals) OVER w AS ag, sum(b_goals) OVER w AS bg FROM m
    WINDOW w AS (PARTITION BY league_id, team_a, team_b ORDER BY match_date, fixture_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)),
ml AS (SELECT * FROM mm QUALIFY row_number() OVER (PARTITION BY league_id, team_a, team_b, match_date ORDER BY fixture_id DESC)=1),
mh AS (SELECT f.fixture_id, f.home_team_id<=f.away_team_id AS straight, ml.* EXCLUDE (fixture_id, match_date), ml.match_date AS source_date
    FROM (SELECT *, least(home_team_id,away_team_id) AS lo, greatest(home_team_id,away_team_id) AS hi FROM fx) f
    ASOF LEFT JOIN ml ON ml.league_id=f.league_id AND ml.team_a=f.lo AND ml.team_b=f.hi AND f.match_date>ml.match_date),
oc AS (SELECT fixture_id, avg(odd_home) AS oh, avg(odd_draw) AS odr, avg(odd_away) AS oa, max(odd_home) AS ohm, max(odd_away) AS oam FROM ow GROUP BY 1),
sf AS (SELECT t.fixture_id, t.is_home, st.position, st.points, st._snapshot_date AS source_date FROM tr t
    ASOF LEFT JOIN st ON st.league_id=t.league_id AND st.team_id=t.team_id AND t.match_date>st._snapshot_date)""",
    body="""SELECT fx.fixture_id, fx.league_id, fx.season, fx.round, fx.match_date, fx.home_team_id, fx.away_team_id, fx.result,
  coalesce(h.wins_last_5,0) AS home_wins_last_5, coalesce(h.draws_last_5,0) AS home_draws_last_5, coalesce(h.losses_last_5,0) AS home_losses_last_5,
  h.goals_scored_avg_5 AS home_goals_scored_avg_5, h.goals_conceded_avg_5 AS home_goals_conceded_avg_5, coalesce(h.points_last_5,0) AS home_points_last_5,
  coalesce(a.wins_last_5,0) AS away_wins_last_5, coalesce(a.draws_last_5,0) AS away_draws_last_5, coalesce(a.losses_last_5,0) AS away_losses_last_5,
  a.goals_scored_avg_5 AS away_goals_scored_avg_5, a.goals_conceded_avg_5 AS away_goals_conceded_avg_5, coalesce(a.points_last_5,0) AS away_points_last_5,
  vh.w AS home_home_wins_last_5, vv.w AS away_away_wins_last_5,
  h.elo_rating AS home_elo_rating, a.elo_rating AS away_elo_rating, h.elo_rating-a.elo_rating AS elo_diff,
  h.rest AS days_since_last_match_home, a.rest AS days_since_last_match_away,
  h.source_date AS home_form_source_date, a.source_date AS away_form_source_date,
  coalesce(mh.g,0) AS h2h_total_games, coalesce(CASE WHEN straight THEN aw ELSE bw END,0) AS h2h_home_wins, coalesce(d,0) AS h2h_draws,
  coalesce(CASE WHEN straight THEN bw ELSE aw END,0) AS h2h_away_wins,
  round(CASE WHEN straight THEN ag ELSE bg END/mh.g,6) AS h2h_home_goals_avg, round(CASE WHEN straight THEN bg ELSE ag END/mh.g,6) AS h2h_away_goals_avg,
  mh.source_date AS h2h_source_date,
  round(oh,6) AS odd_home_avg, round(odr,6) AS odd_draw_avg, round(oa,6) AS odd_away_avg, ohm AS odd_home_max, oam AS odd_away_max,
  sh.position AS home_position, sa.position AS away_position, sh.position-sa.position AS position_diff,
  sh.points AS home_points, sa.points AS away_points,
  sh.source_date AS home_standing_source_date, sa.source_date AS away_standing_source_date,
  coalesce(ih.injuries_count,0) AS home_injuries_count, coalesce(ia.injuries_count,0) AS away_injuries_count,
  coalesce(ih.key_players_out,0) AS home_key_players_out, coalesce(ia.key_players_out,0) AS away_key_players_out,
  CAST(fx.fixture_id*13%60 AS DOUBLE)/CAST(100 AS DOUBLE) AS api_pred_home_pct, CAST(fx.fixture_id*7%40 AS DOUBLE)/CAST(100 AS DOUBLE) AS api_pred_draw_pct,
  CAST(fx.fixture_id*11%50 AS DOUBLE)/CAST(100 AS DOUBLE) AS api_pred_away_pct,
  db.a IS NOT NULL AS is_derby, fx.league_id=4 AS is_cup_match,
  greatest(h.source_date, a.source_date, mh.source_date, sh.source_date, sa.source_date) AS max_source_date
FROM fx JOIN ts h ON h.fixture_id=fx.fixture_id AND h.is_home JOIN ts a ON a.fixture_id=fx.fixture_id AND NOT a.is_home
JOIN va vh ON vh.fixture_id=fx.fixture_id AND vh.is_home JOIN va vv ON vv.fixture_id=fx.fixture_id AND NOT vv.is_home
JOIN mh ON mh.fixture_id=fx.fixture_id LEFT JOIN oc ON oc.fixture_id=fx.fixture_id
JOIN sf sh ON sh.fixture_id=fx.fixture_id AND sh.is_home JOIN sf sa ON sa.fixture_id=fx.fixture_id AND NOT sa.is_home
LEFT JOIN ik ih ON ih.fixture_id=fx.fixture_id AND ih.team_id=fx.home_team_id
LEFT JOIN ik ia ON ia.fixture_id=fx.fixture_id AND ia.team_id=fx.away_team_id
LEFT JOIN db ON least(fx.home_team_id,fx.away_team_id)=db.a AND greatest(fx.home_team_id,fx.away_team_id)=db.b""",
)


@query("match_features", _FEATURES_SQL)
def match_features(spark, sf):
    names = [
        "home_goals_scored_avg_5", "home_goals_conceded_avg_5", "away_goals_scored_avg_5", "away_goals_conceded_avg_5",
        "h2h_home_goals_avg", "h2h_away_goals_avg", "odd_home_avg", "odd_draw_avg", "odd_away_avg",
    ]
    return _rounded(feature_mart(spark, sf), *names)


@query(
    "dim_teams",
    with_(
        FX,
        body="""SELECT DISTINCT home_team_id AS team_id, 'Team ' || home_team_id AS team_name, 'T' || home_team_id AS team_code,
  'Country ' || league_id AS country, CAST(home_team_id%120+1890 AS INTEGER) AS founded, CAST(NULL AS VARCHAR) AS logo_url,
  'Ground ' || home_team_id AS venue_name, 'City ' || (home_team_id%50) AS venue_city,
  CAST(home_team_id*37%80000 AS INTEGER) AS venue_capacity FROM mt""",
    ),
)
def dim_teams(spark, sf):
    from touchline.plans import silver

    return marts.dim_teams(silver.teams(testbed.raw_teams(spark, sf)))


@query(
    "dim_leagues",
    with_(
        FX,
        body="""SELECT DISTINCT league_id, 'League ' || league_id AS league_name, CASE WHEN league_id=4 THEN 'Cup' ELSE 'League' END AS league_type,
  'Country ' || league_id AS country, CAST(NULL AS VARCHAR) AS logo_url, CAST(NULL AS VARCHAR) AS flag_url, y AS season
FROM (SELECT league_id, season AS y FROM mt UNION ALL SELECT league_id, season-1 FROM mt)""",
    ),
)
def dim_leagues(spark, sf):
    from touchline.plans import silver

    return marts.dim_leagues(silver.leagues(testbed.raw_leagues(spark, sf)))


@query(
    "dim_players",
    """SELECT p_partkey AS player_id, CAST(s AS INTEGER) AS season, p_name AS player_name,
  CASE WHEN p_partkey%2=0 THEN 'Attacker' ELSE 'Defender' END AS position, p_type AS nationality,
  p_partkey%5*100+(p_partkey+s)%20 AS team_id FROM part, (VALUES (2000),(2001)) t(s)""",
)
def dim_players(spark, sf):
    from touchline.plans import silver

    return marts.dim_players(silver.players(testbed.raw_players(spark, sf)))


@query(
    "fct_match_predictions",
    with_(
        FX,
        PREDS,
        body="SELECT fixture_id, league_id, season, match_date, prob_home_win, prob_draw, prob_away_win, predicted_result, confidence, model_version FROM p",
    ),
)
def fct_match_predictions(spark, sf):
    scored = testbed.predictions(spark, sf).drop("predicted_result", "confidence", "home_team_id", "away_team_id", "round")
    return marts.prediction_rows(scored, c("model_version"), F.current_timestamp()).drop("generated_at")


@query(
    "fct_team_form",
    with_(
        TEAMS,
        _ELO,
        f"""
er AS (SELECT e.fixture_id, e.pool*100+n.h AS team_id, hb+g AS rating FROM e JOIN n ON n.pool=e.pool AND n.i=e.i WHERE e.i>0
    UNION ALL SELECT e.fixture_id, e.pool*100+n.a, ab-g FROM e JOIN n ON n.pool=e.pool AND n.i=e.i WHERE e.i>0)""",
        body=f"""SELECT pr.fixture_id, pr.team_id, league_id, season, match_date AS reference_date,
  CAST(sum(CASE outcome WHEN 'W' THEN 3 WHEN 'D' THEN 1 ELSE 0 END) {WINDOW_AFTER.replace('team_id', 'pr.team_id').replace('fixture_id', 'pr.fixture_id')} AS INTEGER) AS points_last_5,
  CAST(round(rating) AS INTEGER) AS elo_rating FROM pr LEFT JOIN er ON er.fixture_id=pr.fixture_id AND er.team_id=pr.team_id""",
    ),
)
def fct_team_form(spark, sf):
    fixtures = testbed.fixtures(spark, sf)
    return marts.team_form(fixtures, elo.elo_ratings(fixtures)).select(
        "fixture_id", "team_id", "league_id", "season", "reference_date", "points_last_5", "elo_rating"
    )
