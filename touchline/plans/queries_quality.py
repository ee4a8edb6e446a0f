"""Queries over data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.operators import elo, form, history, joins, quality
from touchline.plans import marts, testbed
from touchline.plans.catalog import query
from touchline.plans.queries_marts import feature_mart
from touchline.plans.sqltext import FX, PREDS, QUOTES, TEAMS, with_
from touchline.session import stored

c = F.col


def _as_of():
    return F.lit("2024-01-31 16:00:00").cast("timestamp")


@query("dq_round_counts", with_(FX, body="SELECT league_id, season, round, count(*) AS n_matches, 40 AS expected_matches FROM fx GROUP BY ALL HAVING count(*)<>40"))
def dq_round_counts(spark, sf):
    expected = testbed.league_types(spark, sf).select("league_id", F.lit(40).alias("expected_matches"))
    return quality.incomplete_rounds(testbed.fixtures(spark, sf), expected)


@query("dq_odds_range", with_(QUOTES, body="SELECT fixture_id, bookmaker_id, odd_home, odd_draw, odd_away FROM ow WHERE NOT (odd_home BETWEEN 1.5 AND 9.5) OR NOT (odd_draw BETWEEN 1.5 AND 9.5) OR NOT (odd_away BETWEEN 1.5 AND 9.5)"))
def dq_odds_range(spark, sf):
    """Narrower bounds than the default, so that there are rows to find."""
    return quality.odds_out_of_range(testbed.odds_wide(spark, sf), ["odd_home", "odd_draw", "odd_away"], 1.5, 9.5)


@query("dq_probability_sum", with_(FX, PREDS, body="""SELECT fixture_id, round(h+prob_draw+prob_away_win,6) AS prob_sum FROM (
SELECT *, CASE WHEN fixture_id%10=0 THEN prob_home_win+0.06 ELSE prob_home_win END AS h FROM p) WHERE h+prob_draw+prob_away_win NOT BETWEEN 0.95 AND 1.05"""))
def dq_probability_sum(spark, sf):
    shifted = testbed.predictions(spark, sf).withColumn(
        "prob_home_win", F.when(c("fixture_id") % 10 == 0, c("prob_home_win") + 0.06).otherwise(c("prob_home_win"))
    )
    return quality.probability_sum_off(shifted).select("fixture_id", F.round("prob_sum", 6).alias("prob_sum"))


@query("dq_freshness", """SELECT 'events' AS table_name, round((epoch(TIMESTAMP '2024-01-31 16:00:00')-floor(epoch(max(ts))))/3600,4) AS age_hours,
CASE WHEN (epoch(TIMESTAMP '2024-01-31 16:00:00')-floor(epoch(max(ts))))/3600>24 THEN 'error' WHEN (epoch(TIMESTAMP '2024-01-31 16:00:00')-floor(epoch(max(ts))))/3600>12 THEN 'warn' ELSE 'ok' END AS status FROM events""")
def dq_freshness(spark, sf):
    rows = testbed.table(spark, sf, "events")
    return quality.freshness(rows, "ts", _as_of(), "events").withColumn("age_hours", F.round("age_hours", 4))


@query("dq_source_freshness", """SELECT n AS table_name, CASE WHEN a>24 THEN 'error' WHEN a>12 THEN 'warn' ELSE 'ok' END AS status FROM (
SELECT 'orders' AS n, (epoch(TIMESTAMP '2024-01-31 16:00:00')-epoch(max(o_orderdate)))/3600 AS a FROM orders
UNION ALL SELECT 'lineitem', (epoch(TIMESTAMP '2024-01-31 16:00:00')-epoch(max(l_shipdate)))/3600 FROM lineitem
UNION ALL SELECT 'events', (epoch(TIMESTAMP '2024-01-31 16:00:00')-floor(epoch(max(ts))))/3600 FROM events)""")
def dq_source_freshness(spark, sf):
    out = None
    for name, ts in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts")):
        row = quality.freshness(testbed.table(spark, sf, name), ts, _as_of(), name).select("table_name", "status")
        out = row if out is None else out.unionByName(row)
    return out


@query("dq_column_checks", with_(FX, body="""SELECT n AS check_name, CAST(v AS BIGINT) AS violations, r AS n_rows FROM (
SELECT 'not_null:fixture_id' AS n, count(*) FILTER (WHERE fixture_id IS NULL) AS v, count(*) AS r FROM fx
UNION ALL SELECT 'not_null:result', count(*) FILTER (WHERE result IS NULL), count(*) FROM fx
UNION ALL SELECT 'accepted:status', count(*) FILTER (WHERE status NOT IN ('FT','NS')), count(*) FROM fx
UNION ALL SELECT 'between:goals_home', count(*) FILTER (WHERE goals_home NOT BETWEEN 0 AND 3), count(*) FROM fx)"""))
def dq_column_checks(spark, sf):
    return quality.column_checks(
        testbed.fixtures(spark, sf), ["fixture_id", "result"], {"status": ["FT", "NS"]}, {"goals_home": (0, 3)}
    )


@query("dq_unique", with_(QUOTES, body="SELECT fixture_id, bookmaker_id, outcome, count(*) AS n FROM q GROUP BY ALL HAVING count(*)>1"))
def dq_unique(spark, sf):
    return quality.duplicated_keys(testbed.quotes(spark, sf), ["fixture_id", "bookmaker_id", "outcome"])


@query("dq_leakage", with_(TEAMS, body="SELECT fixture_id, team_id FROM pr"))
def dq_leakage(spark, sf):
    """The form that includes the row's own match leaks in every row; the form before it in none but same-day rows."""
    leaky = form.rolling_form(marts.played_rows(testbed.fixtures(spark, sf)), 5, "after")
    return quality.leaking_rows(leaky, ["max_source_date"]).select("fixture_id", "team_id")


_SOURCES = (
    "home_form_source_date", "away_form_source_date", "h2h_source_date", "home_standing_source_date", "away_standing_source_date",
)


@query("dq_leakage_features", with_(FX, body="SELECT fixture_id, CAST(fixture_id%13 AS INTEGER) AS leak FROM fx WHERE fixture_id%13<5"))
def dq_leakage_features(spark, sf):
    """Each source date of the feature mart is planted as the match's own day for a thirteenth of the matches; all others
    must be earlier, so exactly the planted ones leak."""
    mart = feature_mart(spark, sf).select("fixture_id", "match_date", *_SOURCES)
    planted = mart.withColumns(
        {n: F.when(c("fixture_id") % 13 == i, c("match_date")).otherwise(c(n)) for i, n in enumerate(_SOURCES)}
    )
    return quality.leaking_rows(planted, _SOURCES).select("fixture_id", (c("fixture_id") % 13).cast("int").alias("leak"))


@query(
    "dq_elo_range",
    with_(
        TEAMS,
        body="""SELECT fixture_id, CASE fixture_id%7 WHEN 0 THEN 'out_of_range' ELSE 'not_zero_sum' END AS reason FROM fx
  WHERE result IS NOT NULL AND fixture_id%7 IN (0, 1) UNION ALL
SELECT fixture_id, 'debut_rating' FROM (SELECT * FROM pr QUALIFY row_number() OVER (PARTITION BY league_id, team_id
  ORDER BY match_date, fixture_id)=1) WHERE fixture_id%7=2""",
    ),
)
def dq_elo_range(spark, sf):
    """Planted by the match's number: a rating out of range, a gain that the other side does not lose, a new team off the
    start value (its ratings after the match move along, so nothing else is wrong)."""
    rated = stored(elo.elo_ratings(testbed.fixtures(spark, sf)), "rated")
    kind, shift = c("fixture_id") % 7, F.when(c("fixture_id") % 7 == 2, 10.0).otherwise(0.0)
    home = F.when(kind == 0, 2500.0).when(kind == 1, c("home_after") + 1.0).otherwise(c("home_after") + shift)
    moved = {n: c(n) + shift for n in ("home_before", "away_before", "away_after")}
    return elo.elo_violations(rated.withColumns({**moved, "home_after": home}))


@query("dq_orphans", with_(FX, QUOTES, body="SELECT fixture_id, bookmaker_id, outcome, odd, day FROM q ANTI JOIN (SELECT * FROM fx WHERE status='FT') f USING (fixture_id)"))
def dq_orphans(spark, sf):
    finished = testbed.fixtures(spark, sf).filter(c("status") == "FT")
    rows = testbed.quotes(spark, sf).select("fixture_id", "bookmaker_id", "outcome", "odd", "day")
    return joins.orphans(rows, finished, ["fixture_id"])


@query("dq_form", with_(TEAMS, body="SELECT fixture_id, team_id FROM pr WHERE fixture_id%11=0"))
def dq_form(spark, sf):
    """Every eleventh match is given one win too many."""
    rows = form.rolling_form(marts.played_rows(testbed.fixtures(spark, sf)), 5, "after")
    broken = rows.withColumn("wins_last_5", c("wins_last_5") + (c("fixture_id") % 11 == 0).cast("int"))
    return quality.form_inconsistent(broken).select("fixture_id", "team_id")


@query("dq_row_counts", "SELECT 'orders' AS table_name, count(*) AS n_rows, count(*) FILTER (WHERE o_custkey IS NULL) AS null_keys FROM orders UNION ALL SELECT 'lineitem', count(*), count(*) FILTER (WHERE l_orderkey IS NULL) FROM lineitem UNION ALL SELECT 'events', count(*), count(*) FILTER (WHERE user_id IS NULL) FROM events")
def dq_row_counts(spark, sf):
    out = None
    for name, key in (("orders", "o_custkey"), ("lineitem", "l_orderkey"), ("events", "user_id")):
        row = testbed.table(spark, sf, name).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.count_if(c(key).isNull()).alias("null_keys")
        )
        out = row if out is None else out.unionByName(row)
    return out


@query("schema_drift", """SELECT * FROM (SELECT 'o_orderpriority' AS column_name,'string' AS actual_type,NULL AS expected_type,'extra' AS drift, count(o_orderpriority) AS filled FROM orders
UNION ALL SELECT 'o_clerk',NULL,'string','missing', NULL UNION ALL SELECT 'o_orderkey','bigint','int','retyped', count(o_orderkey) FROM orders)""")
def schema_drift(spark, sf):
    expected = {
        "o_orderkey": "int",
        "o_custkey": "bigint",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
        "o_clerk": "string",
    }
    return quality.schema_drift(testbed.table(spark, sf, "orders"), expected)


@query(
    "dq_scd2",
    with_(
        TEAMS,
        """
lg AS (SELECT team_id, outcome, lag(outcome) OVER w AS before FROM pr WINDOW w AS (PARTITION BY team_id ORDER BY match_date, fixture_id)),
iv AS (SELECT team_id, count(*) AS n FROM lg WHERE before IS NULL OR before<>outcome GROUP BY team_id)""",
        body="""SELECT team_id, CASE WHEN team_id%4=0 THEN n ELSE 1 END AS current_rows, CASE WHEN team_id%4=1 THEN n-1 ELSE 0 END AS reversed_rows
FROM iv WHERE n>1 AND team_id%4<2""",
    ),
)
def dq_scd2(spark, sf):
    """Planted by team: all intervals current, or closed the day before they open."""
    log = marts.played_rows(testbed.fixtures(spark, sf)).select("team_id", "match_date", "fixture_id", "outcome")
    kept = history.scd2_from_log(log, ["team_id"], ["outcome"], ["match_date", "fixture_id"])
    broken = kept.withColumns({
        "is_current": c("is_current") | (c("team_id") % 4 == 0),
        "valid_to": F.when((c("team_id") % 4 == 1) & c("valid_to").isNotNull(), F.date_sub("valid_from", 1)).otherwise(c("valid_to")),
    })
    return history.scd2_violations(broken, ["team_id"])


@query(
    "quality_report",
    with_(FX, QUOTES, PREDS, body="""SELECT n AS check_name, v AS violations, CASE WHEN v=0 THEN 'pass' ELSE 'fail' END AS status FROM (
SELECT 'odds_range' AS n, count(*) AS v FROM ow WHERE NOT (odd_home BETWEEN 1.01 AND 9.0) OR NOT (odd_draw BETWEEN 1.01 AND 9.0) OR NOT (odd_away BETWEEN 1.01 AND 9.0)
UNION ALL SELECT 'probability_sum', count(*) FROM p WHERE prob_home_win+prob_draw+prob_away_win NOT BETWEEN 0.95 AND 1.05
UNION ALL SELECT 'orphan_odds', count(*) FROM q ANTI JOIN fx USING (fixture_id)
UNION ALL SELECT 'duplicate_odds', count(*) FROM (SELECT 1 FROM q GROUP BY fixture_id, bookmaker_id, outcome HAVING count(*)>1))"""),
)
def quality_report(spark, sf):
    quotes = testbed.quotes(spark, sf)
    return quality.run_checks(
        {
            "odds_range": quality.odds_out_of_range(
                testbed.odds_wide(spark, sf), ["odd_home", "odd_draw", "odd_away"], 1.01, 9.0
            ),
            "probability_sum": quality.probability_sum_off(testbed.predictions(spark, sf)),
            "orphan_odds": joins.orphans(quotes, testbed.fixtures(spark, sf), ["fixture_id"]),
            "duplicate_odds": quality.duplicated_keys(quotes, ["fixture_id", "bookmaker_id", "outcome"]),
        }
    )
