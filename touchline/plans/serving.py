"""Read queries over the published tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.columns import record_text


def prediction_by_fixture(predictions: DataFrame, fixture_id: int) -> DataFrame:
    return predictions.filter(F.col("fixture_id") == fixture_id)


def next_round(predictions: DataFrame, league_id: int, as_of: Column) -> DataFrame:
    """Predictions of a league's next round: the round of its first match day from ``as_of`` on."""
    ahead = predictions.filter((F.col("league_id") == league_id) & (F.col("match_date") >= as_of))
    first = ahead.groupBy("season", "round").agg(F.min("match_date").alias("_first"))
    chosen = first.orderBy("_first", "season", "round").limit(1).select("season", "round")
    return ahead.join(chosen, ["season", "round"], "left_semi")


def on_day(predictions: DataFrame, day: Column) -> DataFrame:
    return predictions.filter(F.col("match_date") == day)


def upcoming(fixtures: DataFrame, predictions: DataFrame, as_of: Column) -> DataFrame:
    """Open fixtures from ``as_of`` on with ``has_prediction``."""
    known = predictions.select("fixture_id", F.lit(True).alias("_has")).distinct()
    ahead = fixtures.filter((F.col("match_date") >= as_of) & F.col("result").isNull())
    return ahead.join(known, "fixture_id", "left").withColumn("has_prediction", F.coalesce("_has", F.lit(False))).drop(
        "_has"
    )


def standings(table: DataFrame, league_id: int, season: int) -> DataFrame:
    return table.filter((F.col("league_id") == league_id) & (F.col("season") == season)).orderBy("position")


def team_form(form: DataFrame, team_id: int) -> DataFrame:
    """Latest form row of a team: one partially aggregated maximum."""
    rows = form.filter(F.col("team_id") == team_id)
    last = F.max(F.struct("match_date", "fixture_id", F.struct(*[c for c in rows.columns]).alias("row")))
    return rows.agg(last.alias("m")).filter(F.col("m").isNotNull()).select("m.row.*")


def latest_predictions(predictions: DataFrame, n: int) -> DataFrame:
    """The ``n`` predictions of the latest match days: every task keeps n rows before they meet."""
    return predictions.orderBy(F.desc("match_date"), F.desc("fixture_id")).limit(n)


def next_matches(fixtures: DataFrame, as_of: Column, n: int) -> DataFrame:
    """The next ``n`` open matches from ``as_of`` on."""
    ahead = fixtures.filter((F.col("match_date") >= as_of) & F.col("result").isNull())
    return ahead.orderBy("match_date", "fixture_id").limit(n)


def history(resolved: DataFrame, n: int | None = None) -> DataFrame:
    """Past predictions with the actual result, newest first; the newest ``n`` if given."""
    rows = (
        resolved.filter(F.col("actual_result").isNotNull())
        .select("fixture_id", "match_date", "model_version", "predicted_result", "actual_result", "was_correct")
        .orderBy(F.desc("match_date"), F.desc("fixture_id"))
    )
    return rows if n is None else rows.limit(n)


def prediction_document(rows: DataFrame) -> DataFrame:
    """Nested JSON document per prediction."""
    document = F.struct(
        "fixture_id",
        F.col("league_name").alias("league"),
        F.col("match_date").cast("string").alias("match_date"),
        F.col("home_team_name").alias("home_team"),
        F.col("away_team_name").alias("away_team"),
        F.struct(
            F.col("prob_home_win").alias("home_win"),
            F.col("prob_draw").alias("draw"),
            F.col("prob_away_win").alias("away_win"),
            "confidence",
            "model_version",
        ).alias("prediction"),
        F.struct(
            "home_form",
            "away_form",
            "home_elo",
            "away_elo",
            record_text(F.col("h2h_wins"), F.col("h2h_draws"), F.col("h2h_losses")).alias("h2h_last_5"),
            F.struct(
                F.col("odd_home").alias("home"), F.col("odd_draw").alias("draw"), F.col("odd_away").alias("away")
            ).alias("market_odds"),
        ).alias("context"),
    )
    return rows.select("fixture_id", F.to_json(document).alias("document"))
