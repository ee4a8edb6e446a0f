"""Queries over predictions, the model and the served tables."""

from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from touchline.operators import aggregates, elo, metrics
from touchline.plans import marts, model, serving, testbed
from touchline.plans.catalog import query
from touchline.plans.queries_marts import _CURRENT as CURRENT
from touchline.plans.queries_marts import _ELO as ELO
from touchline.plans.queries_marts import _FEATURES_SQL as FEATURES_SQL
from touchline.plans.queries_marts import _PAIRS as PAIRS
from touchline.plans.queries_marts import _rounded as rounded
from touchline.plans.queries_marts import feature_mart
from touchline.plans.sqltext import FX, PREDS, QUOTES, SEASONS, TEAMS, with_
from touchline.schemas import FEATURES
from touchline.session import shared_root, stored
from touchline.sources.tables import table_exists

c = F.col

_DAY = "DATE '1998-06-15'"


def _day():
    return F.make_date(F.lit(1998), F.lit(6), F.lit(15))


def _resolved(spark, sf):
    return metrics.resolve_predictions(testbed.predictions(spark, sf), testbed.fixtures(spark, sf))


@query("resolve_predictions", with_(FX, PREDS, body="SELECT fixture_id, predicted_result, actual_result, was_correct FROM rp"))
def resolve_predictions(spark, sf):
    return _resolved(spark, sf).select("fixture_id", "predicted_result", "actual_result", "was_correct")


_AUC = """
sc AS (
  SELECT model_version, 'H' AS label, prob_home_win AS score, CAST(actual_result='H' AS INTEGER) AS hit FROM rp WHERE actual_result IS NOT NULL
  UNION ALL SELECT model_version, 'D', prob_draw, CAST(actual_result='D' AS INTEGER) FROM rp WHERE actual_result IS NOT NULL
  UNION ALL SELECT model_version, 'A', prob_away_win, CAST(actual_result='A' AS INTEGER) FROM rp WHERE actual_result IS NOT NULL),
rk AS (SELECT *, rank() OVER (PARTITION BY model_version, label ORDER BY score)
    + (count(*) OVER (PARTITION BY model_version, label, score)-1)/2 AS r FROM sc),
au AS (SELECT model_version, label, sum(hit) AS p, sum(1-hit) AS n, (sum(r*hit)-sum(hit)*(sum(hit)+1)/2)/(sum(hit)*sum(1-hit)) AS auc
  FROM rk GROUP BY ALL)"""

_METRICS = """
pm AS (
  SELECT model_version, count(*) AS total_predictions, count(*) FILTER (WHERE was_correct) AS correct_predictions,
    round(avg(CAST(was_correct AS DOUBLE)),6) AS accuracy,
    round(avg(-ln(CASE actual_result WHEN 'H' THEN prob_home_win WHEN 'D' THEN prob_draw ELSE prob_away_win END)),6) AS log_loss,
    round(avg(pow(prob_home_win-CAST(actual_result='H' AS INTEGER),2)),6) AS brier_home,
    round(avg(pow(prob_draw-CAST(actual_result='D' AS INTEGER),2)),6) AS brier_draw,
    round(avg(pow(prob_away_win-CAST(actual_result='A' AS INTEGER),2)),6) AS brier_away
  FROM rp WHERE actual_result IS NOT NULL GROUP BY model_version),
mp AS (SELECT pm.*, roc_auc FROM pm JOIN (SELECT model_version, round(avg(auc),6) AS roc_auc FROM au GROUP BY 1) USING (model_version))"""


def _performance(spark, sf):
    rows = metrics.model_performance(_resolved(spark, sf))
    names = ["accuracy", "log_loss", "brier_home", "brier_draw", "brier_away", "roc_auc"]
    return rows.withColumns({n: F.round(n, 6) for n in names})


@query("model_performance", with_(FX, PREDS, _AUC, _METRICS, body="SELECT * FROM mp"))
def model_performance(spark, sf):
    return _performance(spark, sf)


@query("auc_by_class", with_(FX, PREDS, _AUC, body="SELECT model_version, label, round(auc,6) AS auc FROM au"))
def auc_by_class(spark, sf):
    done = _resolved(spark, sf).filter(c("actual_result").isNotNull())
    return metrics.auc_by_class(done).withColumn("auc", F.round("auc", 6))


@query(
    "auc_exact_scores",
    with_(FX, PREDS, "rq AS (SELECT * REPLACE (prob_home_win*fixture_id/(fixture_id+0.123456789) AS prob_home_win) FROM rp)", _AUC.replace("FROM rp", "FROM rq"),
          body="SELECT model_version, label, round(auc,9) AS auc FROM au"),
)
def auc_exact_scores(spark, sf):
    """Scores that differ from the fifth decimal on."""
    done = _resolved(spark, sf).filter(c("actual_result").isNotNull())
    finer = done.withColumn("prob_home_win", c("prob_home_win") * c("fixture_id") / (c("fixture_id") + F.lit(0.123456789)))
    return metrics.auc_by_class(finer).withColumn("auc", F.round("auc", 9))


@query(
    "confusion_matrix",
    with_(FX, PREDS, body="""SELECT model_version, actual_result, count(*) FILTER (WHERE predicted_result='H') AS predicted_h,
  count(*) FILTER (WHERE predicted_result='D') AS predicted_d, count(*) FILTER (WHERE predicted_result='A') AS predicted_a
FROM rp WHERE actual_result IS NOT NULL GROUP BY ALL"""),
)
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(_resolved(spark, sf))


@query(
    "round_predictions",
    with_(FX, PREDS, body="""SELECT league_id, season, round, count(*) AS predictions, count(*) FILTER (WHERE predicted_result='H') AS home_picks,
  count(*) FILTER (WHERE predicted_result='D') AS draw_picks, count(*) FILTER (WHERE predicted_result='A') AS away_picks,
  count(*) FILTER (WHERE confidence='high') AS high_confidence, round(avg(greatest(prob_home_win,prob_draw,prob_away_win)),10) AS avg_top_prob,
  min(match_date) AS first_match, max(match_date) AS last_match FROM p GROUP BY ALL"""),
)
def round_predictions(spark, sf):
    return aggregates.round_predictions(testbed.predictions(spark, sf)).withColumn("avg_top_prob", F.round("avg_top_prob", 10))


@query(
    "accuracy_trend",
    with_(FX, PREDS, body="""SELECT model_version, month, predictions, correct, round(correct/predictions,6) AS accuracy,
  round(sum(correct) OVER w/sum(predictions) OVER w,6) AS cumulative_accuracy FROM (
  SELECT model_version, CAST(date_trunc('month', match_date) AS DATE) AS month, count(*) AS predictions,
    count(*) FILTER (WHERE was_correct) AS correct FROM rp WHERE was_correct IS NOT NULL GROUP BY 1,2)
WINDOW w AS (PARTITION BY model_version ORDER BY month ROWS UNBOUNDED PRECEDING)"""),
)
def accuracy_trend(spark, sf):
    rows = metrics.accuracy_trend(_resolved(spark, sf))
    return rows.withColumns({n: F.round(n, 6) for n in ("accuracy", "cumulative_accuracy")})


_DRIFT = """SELECT o.model_version, overall_n, overall_accuracy, recent_n, recent_accuracy,
  overall_accuracy-recent_accuracy>0.1 AS drifted FROM (
  SELECT model_version, count(*) AS overall_n, round(avg(CAST(was_correct AS DOUBLE)),6) AS overall_accuracy
  FROM rp WHERE was_correct IS NOT NULL GROUP BY 1) o JOIN (
  SELECT model_version, count(*) AS recent_n, round(avg(CAST(was_correct AS DOUBLE)),6) AS recent_accuracy FROM (
    SELECT * FROM rp WHERE was_correct IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY model_version ORDER BY match_date DESC, fixture_id DESC)<=50) GROUP BY 1) r USING (model_version)"""


@query("drift_check", with_(FX, PREDS, body=_DRIFT))
def drift_check(spark, sf):
    rows = metrics.drift_check(_resolved(spark, sf))
    return rows.withColumns({n: F.round(n, 6) for n in ("overall_accuracy", "recent_accuracy")})


@query(
    "compare_models",
    with_(FX, PREDS, _AUC, _METRICS, body="""SELECT model_version, log_loss, (SELECT log_loss FROM mp WHERE model_version='v1') AS current_log_loss,
  log_loss<(SELECT log_loss FROM mp WHERE model_version='v1') AS should_promote FROM mp WHERE model_version='v2'"""),
)
def compare_models(spark, sf):
    rows = _performance(spark, sf).select("model_version", "log_loss")
    return metrics.compare_models(rows.filter("model_version = 'v2'"), rows.filter("model_version = 'v1'"))


@query(
    "model_register",
    with_(FX, PREDS, _AUC, _METRICS, """
dc AS (SELECT (SELECT log_loss FROM mp WHERE model_version='v2')<(SELECT log_loss FROM mp WHERE model_version='v1') AS promoted)""",
          body="SELECT model_version, log_loss, accuracy, CASE WHEN model_version='v1' THEN NOT promoted ELSE promoted END AS is_active FROM mp, dc"),
)
def model_register(spark, sf):
    """v1 is registered and active; v2 is added and takes over if its log loss is lower."""
    rows = _performance(spark, sf).select("model_version", "log_loss", "accuracy")
    first = rows.filter("model_version = 'v1'")
    second = rows.filter("model_version = 'v2'")
    decided = metrics.compare_models(second, first)
    return metrics.register_models(first.withColumn("is_active", F.lit(True)), second, decided)


@query(
    "time_split",
    with_(FX, body="""SELECT part, count(*) AS n, min(match_date) AS first_day, max(match_date) AS last_day FROM (
  SELECT match_date, CASE WHEN (rank() OVER (ORDER BY match_date)-1)/count(*) OVER ()>=0.8 THEN 'validation' ELSE 'train' END AS part
  FROM fx WHERE result IS NOT NULL) GROUP BY part"""),
)
def time_split(spark, sf):
    known, _ = model.split_by_target(testbed.fixtures(spark, sf))
    parts = model.time_split(known, 0.2)
    return parts.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.min("match_date").alias("first_day"), F.max("match_date").alias("last_day")
    )


@query(
    "expanding_folds",
    with_(FX, body="""SELECT fold, count(*) AS n, min(match_date) AS first_day FROM (
  SELECT match_date, CAST(least(floor((rank() OVER (ORDER BY match_date)-1)/count(*) OVER ()*4),3) AS INTEGER) AS fold
  FROM fx WHERE result IS NOT NULL) GROUP BY fold"""),
)
def expanding_folds(spark, sf):
    known, _ = model.split_by_target(testbed.fixtures(spark, sf))
    return model.with_fold(known, 3).groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.min("match_date").alias("first_day"))


# The planned full-size run: all base models, most trees and rounds, three expanding folds.
_SIZES = model.StackSizes()


def _stack(spark, sf, parts=()):
    """The stack trained on the older four fifths of the matches, the feature rows, and its scores of the ``parts`` asked for:
    ``validation`` (the newest fifth) and ``open``.

    Saved under the shared folder: whichever query comes first fits it, the others load it. Scores of a part are stored by
    the first query that reads them.
    """
    path = f"{shared_root(spark)}/models/{zlib.crc32(sf.encode()):08x}-{model.sizes_key(_SIZES)}"
    if not table_exists(spark, f"{path}/parts"):
        # Of the mart's columns only those of the model are written.
        model.feature_rows(feature_mart(spark, sf)).write.mode("overwrite").parquet(f"{path}/features")
        known, unknown = model.split_by_target(spark.read.parquet(f"{path}/features"))
        split = model.time_split(known, 0.2).unionByName(unknown.withColumn("part", F.lit("open")))
        split.write.mode("overwrite").parquet(f"{path}/rows")
        rows = spark.read.parquet(f"{path}/rows")
        fitted = model.train_stack(rows.filter("part = 'train'").drop("part"), _SIZES)
        model.save_stack(spark, fitted, path)
        # After the stack, so that scores are always those of the stack beside them.
        _store_scores(spark, fitted, rows, path, parts)
    rows, stack = spark.read.parquet(f"{path}/rows"), model.load_stack(spark, path)
    _store_scores(spark, stack, rows, path, [p for p in parts if not table_exists(spark, f"{path}/scores/{p}/_SUCCESS")])
    return stack, rows, spark.read.parquet(*[f"{path}/scores/{p}" for p in parts]) if parts else None


def _store_scores(spark, stack, rows, path, parts):
    for part in parts:
        scored = model.score(stack, rows.filter(c("part") == part).drop("part"))
        marts.prediction_rows(scored, "v1", F.current_timestamp()).write.mode("overwrite").parquet(f"{path}/scores/{part}")


def _measured(resolved):
    return metrics.model_performance(
        resolved.withColumn("actual_result", c("result")).withColumn("was_correct", c("predicted_result") == c("result"))
    )


def _evaluated(rows, scores):
    """The stack against the shares of the results in its training rows, both on the newest fifth."""
    newest = scores.filter("result IS NOT NULL")
    shares = rows.filter("part = 'train'").agg(*[F.avg((c("result") == r).cast("double")).alias(n) for r, n in zip("HDA", model.PROB_COLUMNS)])
    # One row, so that each of its columns is a scalar.
    base = newest.withColumns({n: shares.select(n).scalar() for n in model.PROB_COLUMNS})
    incumbent = marts.prediction_rows(base.drop("predicted_result", "confidence", "model_version", "generated_at"), "v0", F.current_timestamp())
    return metrics.compare_models(_measured(newest), _measured(incumbent))


@query("stacking_predict")
def stacking_predict(spark, sf):
    """Open fixtures scored by the stored stack, loaded again."""
    stack, rows, _ = _stack(spark, sf)
    scored = model.score(stack, rows.filter("part = 'open'").drop("part"))
    return marts.prediction_rows(scored, "v1", F.current_timestamp()).drop("generated_at", "result")


@query("feature_importance")
def feature_importance(spark, sf):
    stack, _, _ = _stack(spark, sf)
    return model.feature_importance(spark, stack)


@query("model_evaluation")
def model_evaluation(spark, sf):
    """Measured on the newest fifth, compared with the incumbent that always answers the shares of the past."""
    _, rows, scores = _stack(spark, sf, ["validation"])
    return _evaluated(rows, scores)


@query(
    "model_facts",
    with_(FX, """
k AS (SELECT *, (rank() OVER (ORDER BY match_date)-1)/count(*) OVER ()>=0.8 AS newest FROM fx WHERE result IS NOT NULL),
s AS (SELECT result, count(*)::DOUBLE/sum(count(*)) OVER () AS share FROM k WHERE NOT newest GROUP BY result)""",
    body="""SELECT (SELECT count(*) FROM fx WHERE result IS NULL) AS open_scored, (SELECT count(*) FROM k WHERE newest) AS newest_scored,
  CAST(0 AS BIGINT) AS sums_off, CAST(0 AS BIGINT) AS labels_off, CAST(0 AS BIGINT) AS loaded_differs, CAST(30 AS BIGINT) AS importances,
  CAST(1 AS DOUBLE) AS importance_sum, true AS log_loss_equal, true AS accuracy_equal, true AS promotion_right,
  round((SELECT -avg(ln(share)) FROM k JOIN s USING (result) WHERE newest), 6) AS incumbent_log_loss""",
    ),
)
def model_facts(spark, sf):
    """What can be checked of the stored stack: one row per open match, probabilities that sum to one, the label of the
    largest, the same scores after loading, metrics recomputed in SQL from the stored scores, the promotion decision."""
    stack, rows, scores = _stack(spark, sf, ["validation", "open"])
    probs = [c(n) for n in model.PROB_COLUMNS]
    largest = F.greatest(*probs)
    label = F.when(probs[0] == largest, "H").when(probs[1] == largest, "D").otherwise("A")
    counted = scores.agg(
        F.count_if(c("result").isNull()).alias("open_scored"), F.count_if(c("result").isNotNull()).alias("newest_scored"),
        F.count_if(F.abs(probs[0] + probs[1] + probs[2] - 1.0) > 1e-9).alias("sums_off"),
        F.count_if(c("predicted_result") != label).alias("labels_off"),
    )
    again = model.score(stack, rows.filter("part <> 'train'").drop("part")).select("fixture_id", probs[0].alias("_p"))
    loaded = scores.join(again, "fixture_id", "left").agg(
        F.count_if(c("_p").isNull() | (F.abs(c("_p") - probs[0]) > 1e-9)).alias("loaded_differs")
    )
    weights = model.feature_importance(spark, stack).agg(
        F.count_distinct("feature").alias("importances"), F.round(F.sum("importance"), 6).alias("importance_sum")
    )
    scores.filter("result IS NOT NULL").createOrReplaceTempView("stored_scores")
    by_sql = spark.sql("""SELECT avg(-ln(greatest(CASE result WHEN 'H' THEN prob_home_win WHEN 'D' THEN prob_draw ELSE prob_away_win END, 1e-15))) AS _loss,
      avg(CAST(predicted_result = result AS DOUBLE)) AS _hits FROM stored_scores""")
    decided = _evaluated(rows, scores).select(
        "log_loss", "accuracy", c("current_log_loss").alias("_incumbent"), "should_promote"
    )
    one = counted.withColumn("_one", F.lit(1))
    for part in (loaded, weights, by_sql, decided):
        one = one.join(part.withColumn("_one", F.lit(1)), "_one")  # one row each
    return one.select(
        "open_scored", "newest_scored", "sums_off", "labels_off", "loaded_differs", "importances", "importance_sum",
        (F.abs(c("log_loss") - c("_loss")) < 1e-6).alias("log_loss_equal"), (F.abs(c("accuracy") - c("_hits")) < 1e-6).alias("accuracy_equal"),
        (c("should_promote") == (c("_loss") < c("_incumbent"))).alias("promotion_right"), F.round("_incumbent", 6).alias("incumbent_log_loss"),
    )


_LOADED = f"""SELECT fixture_id, CASE result WHEN 'H' THEN CAST(0 AS DOUBLE) WHEN 'D' THEN 1 WHEN 'A' THEN 2 END AS label,
  result IS NOT NULL AS is_train, {", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in FEATURES)} FROM ({FEATURES_SQL})"""


@query("feature_load", _LOADED)
@query("feature_load_all", _LOADED)
def feature_load(spark, sf):
    """All features of the stored mart; registered under an earlier name too."""
    rows = model.feature_rows(stored(feature_mart(spark, sf), "features"))
    averages = [n for n in FEATURES if n.endswith(("_avg", "_avg_5"))]
    return rounded(rows, *averages).select("fixture_id", "label", c("result").isNotNull().alias("is_train"), *FEATURES)


# --- served tables --------------------------------------------------------------------------------

_COLS = "fixture_id, league_id, season, round, match_date, predicted_result, confidence, model_version"


def _served(df):
    return df.select(*[n.strip() for n in _COLS.split(",")])


@query("serve_prediction_by_fixture", with_(FX, PREDS, body=f"SELECT {_COLS} FROM p WHERE fixture_id=42"))
def serve_prediction_by_fixture(spark, sf):
    return _served(serving.prediction_by_fixture(testbed.predictions(spark, sf), 42))


@query(
    "serve_league_next_round",
    with_(FX, PREDS, body=f"""SELECT {_COLS} FROM p WHERE league_id=1 AND match_date>={_DAY} AND (season, round) = (
  SELECT (season, round) FROM p WHERE league_id=1 AND match_date>={_DAY} ORDER BY match_date, season, round LIMIT 1)"""),
)
def serve_league_next_round(spark, sf):
    return _served(serving.next_round(testbed.predictions(spark, sf), 1, _day()))


@query("serve_today", with_(FX, PREDS, body=f"SELECT {_COLS} FROM p WHERE match_date={_DAY}"))
def serve_today(spark, sf):
    return _served(serving.on_day(testbed.predictions(spark, sf), _day()))


@query(
    "upcoming_fixtures",
    with_(FX, PREDS, body=f"""SELECT fixture_id, match_date, status, fixture_id IN (SELECT fixture_id FROM p WHERE confidence<>'low') AS has_prediction
FROM fx WHERE match_date>={_DAY} AND result IS NULL"""),
)
def upcoming_fixtures(spark, sf):
    known = testbed.predictions(spark, sf).filter(c("confidence") != "low")
    rows = serving.upcoming(testbed.fixtures(spark, sf), known, _day())
    return rows.select("fixture_id", "match_date", "status", "has_prediction")


@query(
    "serve_standings",
    with_(TEAMS, SEASONS, body="SELECT league_id, season, team_id, position, points, goal_diff FROM st WHERE league_id=1 AND season=1999"),
)
def serve_standings(spark, sf):
    rows = serving.standings(testbed.season_standings(spark, sf), 1, 1999)
    return rows.select("league_id", "season", "team_id", "position", "points", "goal_diff")


@query(
    "serve_team_form",
    with_(TEAMS, body="""SELECT team_id, fixture_id, match_date, form_string FROM (SELECT *, string_agg(outcome, '') OVER (
  PARTITION BY team_id ORDER BY match_date, fixture_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS form_string FROM pr WHERE team_id=105)
ORDER BY match_date DESC, fixture_id DESC LIMIT 1"""),
)
def serve_team_form(spark, sf):
    # Only the team's own matches are read into the windows.
    mine = testbed.fixtures(spark, sf).filter((c("home_team_id") == 105) | (c("away_team_id") == 105))
    return serving.team_form(marts.team_form(mine), 105).select("team_id", "fixture_id", "match_date", "form_string")


@query("serve_model_metrics", with_(FX, PREDS, _AUC, _METRICS, body="SELECT model_version, log_loss, accuracy, roc_auc, total_predictions FROM mp"))
def serve_model_metrics(spark, sf):
    return _performance(spark, sf).select("model_version", "log_loss", "accuracy", "roc_auc", "total_predictions")


@query(
    "serve_history",
    with_(FX, PREDS, body="SELECT fixture_id, match_date, model_version, predicted_result, actual_result, was_correct FROM rp WHERE actual_result IS NOT NULL"),
)
def serve_history(spark, sf):
    return serving.history(_resolved(spark, sf))


@query("serve_latest_predictions", with_(FX, PREDS, body=f"SELECT {_COLS} FROM p ORDER BY match_date DESC, fixture_id DESC LIMIT 25"))
def serve_latest_predictions(spark, sf):
    return _served(serving.latest_predictions(testbed.predictions(spark, sf), 25))


@query(
    "serve_next_matches",
    with_(FX, body=f"SELECT fixture_id, match_date, status FROM fx WHERE match_date>={_DAY} AND result IS NULL ORDER BY match_date, fixture_id LIMIT 10"),
)
def serve_next_matches(spark, sf):
    return serving.next_matches(testbed.fixtures(spark, sf), _day(), 10).select("fixture_id", "match_date", "status")


_DOCUMENT = """
fs AS (SELECT team_id, match_date, fixture_id, string_agg(outcome, '') OVER (PARTITION BY team_id ORDER BY match_date, fixture_id
    ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS form FROM pr),
lf AS (SELECT * FROM fs QUALIFY row_number() OVER (PARTITION BY team_id ORDER BY match_date DESC, fixture_id DESC)=1)"""


@query(
    "prediction_document",
    with_(TEAMS, PREDS, QUOTES, ELO, CURRENT, PAIRS, _DOCUMENT, """
hh AS (SELECT league_id, team_a, team_b, sum(a_win) AS aw, sum(draw) AS d, sum(b_win) AS bw FROM (SELECT * FROM m
  QUALIFY row_number() OVER (PARTITION BY league_id, team_a, team_b ORDER BY match_date DESC, fixture_id DESC)<=5) GROUP BY ALL),
oc AS (SELECT fixture_id, avg(odd_home) AS oh FROM ow GROUP BY 1)""",
    body="""SELECT p.fixture_id, p.confidence, p.prob_home_win AS home_win, h.form AS home_form, a.form AS away_form,
  'League ' || p.league_id AS league, CAST(p.match_date AS VARCHAR) AS match_date, CAST(round(rh.rating) AS INTEGER) AS home_elo,
  CAST(round(ra.rating) AS INTEGER) AS away_elo, CASE WHEN p.home_team_id<=p.away_team_id THEN aw ELSE bw END || 'W ' || d || 'D ' ||
  CASE WHEN p.home_team_id<=p.away_team_id THEN bw ELSE aw END || 'L' AS record, round(oh, 4) AS odd_home FROM p
LEFT JOIN lf h ON h.team_id=p.home_team_id LEFT JOIN lf a ON a.team_id=p.away_team_id
LEFT JOIN cr rh ON rh.team_id=p.home_team_id LEFT JOIN cr ra ON ra.team_id=p.away_team_id
LEFT JOIN hh ON hh.league_id=p.league_id AND hh.team_a=least(p.home_team_id, p.away_team_id) AND hh.team_b=greatest(p.home_team_id, p.away_team_id)
LEFT JOIN oc ON oc.fixture_id=p.fixture_id""",
    ),
)
def prediction_document(spark, sf):
    """Documents for every prediction with form, current ratings, last five meetings and mean prices, read back by path."""
    fixtures = stored(testbed.fixtures(spark, sf), "fixtures")
    rated = elo.elo_ratings(fixtures)
    documents = serving.prediction_document(
        marts.document_rows(testbed.predictions(spark, sf), fixtures, rated, testbed.odds_wide(spark, sf))
    )

    def field(path: str):
        return F.get_json_object("document", path)

    return documents.select(
        "fixture_id",
        field("$.prediction.confidence").alias("confidence"),
        field("$.prediction.home_win").cast("double").alias("home_win"),
        field("$.context.home_form").alias("home_form"),
        field("$.context.away_form").alias("away_form"),
        field("$.league").alias("league"),
        field("$.match_date").alias("match_date"),
        field("$.context.home_elo").cast("int").alias("home_elo"),
        field("$.context.away_elo").cast("int").alias("away_elo"),
        field("$.context.h2h_last_5").alias("record"),
        F.round(field("$.context.market_odds.home").cast("double"), 4).alias("odd_home"),
    )


@query(
    "h2h_text",
    with_(FX, body="""SELECT least(home_team_id,away_team_id) AS team_a, greatest(home_team_id,away_team_id) AS team_b,
  sum(CAST((home_team_id<away_team_id AND result='H') OR (home_team_id>away_team_id AND result='A') AS INTEGER)) || 'W ' ||
  sum(CAST(result='D' AS INTEGER)) || 'D ' ||
  sum(CAST((home_team_id<away_team_id AND result='A') OR (home_team_id>away_team_id AND result='H') AS INTEGER)) || 'L' AS record
FROM (SELECT * FROM fx WHERE result IS NOT NULL QUALIFY row_number() OVER (PARTITION BY league_id, least(home_team_id,away_team_id),
  greatest(home_team_id,away_team_id) ORDER BY match_date DESC, fixture_id DESC)<=5) GROUP BY ALL"""),
)
def h2h_text(spark, sf):
    from touchline.functions.columns import record_text

    record = aggregates.head_to_head(testbed.fixtures(spark, sf), 5).filter(c("home_team_id") < c("away_team_id"))
    return record.select(
        c("home_team_id").alias("team_a"),
        c("away_team_id").alias("team_b"),
        record_text(c("home_wins"), c("draws"), c("away_wins")).alias("record"),
    )
