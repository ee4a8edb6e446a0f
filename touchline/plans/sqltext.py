"""SQL form of the test data, for the oracle queries."""

FX = """
mt AS (
  SELECT o_orderkey AS fixture_id, o_custkey AS seed, CAST(n_regionkey AS BIGINT) AS league_id,
    CAST(year(o_orderdate) AS INTEGER) AS season, CAST(month(o_orderdate) AS INTEGER) AS round,
    CAST(o_orderdate AS DATE) AS match_date,
    CASE o_orderstatus WHEN 'F' THEN 'FT' WHEN 'O' THEN 'NS' ELSE 'PST' END AS status,
    CAST(n_regionkey AS BIGINT)*100 + o_custkey%20 AS home_team_id,
    CAST(n_regionkey AS BIGINT)*100 + (o_custkey%20 + 1 + o_orderkey%19)%20 AS away_team_id,
    CASE WHEN o_orderstatus='F' THEN CAST((o_orderkey*7+o_custkey)%5 AS INTEGER) END AS goals_home,
    CASE WHEN o_orderstatus='F' THEN CAST((o_orderkey*3+o_custkey*2)%4 AS INTEGER) END AS goals_away
  FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey),
fx AS (
  SELECT * EXCLUDE (seed), CASE WHEN status='FT' THEN
    CASE WHEN goals_home>goals_away THEN 'H' WHEN goals_home=goals_away THEN 'D' ELSE 'A' END END AS result
  FROM mt)"""

TEAMS = (
    FX
    + """,
tr AS (
  SELECT fixture_id, league_id, season, round, match_date, status, result, home_team_id AS team_id,
    away_team_id AS opponent_id, true AS is_home, goals_home AS goals_for, goals_away AS goals_against,
    CASE result WHEN 'H' THEN 'W' WHEN 'A' THEN 'L' WHEN 'D' THEN 'D' END AS outcome FROM fx
  UNION ALL
  SELECT fixture_id, league_id, season, round, match_date, status, result, away_team_id, home_team_id, false,
    goals_away, goals_home, CASE result WHEN 'A' THEN 'W' WHEN 'H' THEN 'L' WHEN 'D' THEN 'D' END FROM fx),
pr AS (SELECT * FROM tr WHERE outcome IS NOT NULL)"""
)

QUOTES = """
q AS (
  SELECT l_orderkey AS fixture_id, l_suppkey%10 AS bookmaker_id, CAST(1 AS BIGINT) AS bet_id,
    CASE l_linenumber%3 WHEN 0 THEN 'Home' WHEN 1 THEN 'Draw' ELSE 'Away' END AS outcome,
    CAST(l_partkey%900 + 101 AS DOUBLE)/CAST(100 AS DOUBLE) AS odd, CAST(l_shipdate AS DATE) AS day,
    l_partkey, l_suppkey, l_linenumber
  FROM lineitem),
ow AS (
  SELECT fixture_id, bookmaker_id, max(CASE WHEN outcome='Home' THEN odd END) AS odd_home,
    max(CASE WHEN outcome='Draw' THEN odd END) AS odd_draw, max(CASE WHEN outcome='Away' THEN odd END) AS odd_away
  FROM q GROUP BY ALL)"""

LINES = """
ln AS (
  SELECT l_orderkey AS fixture_id, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS INTEGER) AS quantity,
    l_returnflag, CAST(l_shipdate AS DATE) AS day, league_id, season, match_date,
    CASE WHEN l_linenumber%2=0 THEN home_team_id ELSE away_team_id END AS team_id,
    (CASE WHEN l_linenumber%2=0 THEN home_team_id ELSE away_team_id END)*100 + l_partkey%25 AS player_id
  FROM lineitem JOIN fx ON l_orderkey=fixture_id),
ps AS (
  SELECT fixture_id, season, team_id, player_id, quantity+40 AS minutes_played, l_linenumber%3 AS goals,
    CAST(l_partkey%2 AS INTEGER) AS assists, CAST(l_suppkey%50+50 AS DOUBLE)/CAST(10 AS DOUBLE) AS rating FROM ln),
inj AS (
  SELECT DISTINCT fixture_id, league_id, season, team_id, player_id, match_date FROM ln WHERE l_returnflag='R')"""

PREDS = """
pw AS (
  SELECT *, fixture_id*13%60+20 AS wh, seed*7%30+10 AS wd, (fixture_id*11+seed)%50+20 AS wa FROM mt),
pp AS (
  SELECT fixture_id, league_id, season, round, match_date, home_team_id, away_team_id,
    CAST(wh*10000//(wh+wd+wa) AS DOUBLE)/CAST(10000 AS DOUBLE) AS prob_home_win,
    CAST(wd*10000//(wh+wd+wa) AS DOUBLE)/CAST(10000 AS DOUBLE) AS prob_draw,
    CAST(wa*10000//(wh+wd+wa) AS DOUBLE)/CAST(10000 AS DOUBLE) AS prob_away_win,
    'v' || (fixture_id%2+1) AS model_version FROM pw),
p AS (
  SELECT *, CASE WHEN prob_home_win>=prob_draw AND prob_home_win>=prob_away_win THEN 'H'
      WHEN prob_draw>=prob_away_win THEN 'D' ELSE 'A' END AS predicted_result,
    CASE WHEN greatest(prob_home_win,prob_draw,prob_away_win)>0.55 THEN 'high'
      WHEN greatest(prob_home_win,prob_draw,prob_away_win)>0.40 THEN 'medium' ELSE 'low' END AS confidence
  FROM pp),
rp AS (
  SELECT p.*, fx.result AS actual_result, p.predicted_result=fx.result AS was_correct
  FROM p LEFT JOIN fx USING (fixture_id))"""

SEASONS = """
ss AS (
  SELECT league_id, season, team_id, CAST(count(*) AS INTEGER) AS played,
    CAST(sum(CASE WHEN outcome='W' THEN 1 ELSE 0 END) AS INTEGER) AS wins,
    CAST(sum(CASE WHEN outcome='D' THEN 1 ELSE 0 END) AS INTEGER) AS draws,
    CAST(sum(CASE WHEN outcome='L' THEN 1 ELSE 0 END) AS INTEGER) AS losses,
    CAST(sum(goals_for) AS INTEGER) AS goals_for, CAST(sum(goals_against) AS INTEGER) AS goals_against,
    CAST(sum(CASE outcome WHEN 'W' THEN 3 WHEN 'D' THEN 1 ELSE 0 END) AS INTEGER) AS points,
    CAST(sum(goals_for)-sum(goals_against) AS INTEGER) AS goal_diff
  FROM pr GROUP BY league_id, season, team_id),
st AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY league_id, season
      ORDER BY points DESC, goal_diff DESC, goals_for DESC, team_id) AS INTEGER) AS position,
    make_date(season, 12, 31) AS _snapshot_date FROM ss)"""


def with_(*parts: str, body: str) -> str:
    return "WITH RECURSIVE " + ",".join(parts) + "\n" + body
