"""Match aggregates. Every one starts with a map-side partial aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.columns import implied_probs, pair_key, points
from touchline.operators.ordered import top_k_per_group


def _share(label: str) -> Column:
    played = F.count("result")
    return F.try_divide(F.sum(F.when(F.col("result") == label, 100.0).otherwise(0.0)), played)


def odds_consensus(odds_wide: DataFrame, outcomes: Sequence[str] = ("home", "draw", "away")) -> DataFrame:
    """avg / median / max / min per outcome, number of books and implied probabilities per fixture.

    ``odds_wide`` has one row per fixture and bookmaker, so the exact median holds as many prices as there are books.
    """
    aggs: list[Column] = [F.count("bookmaker_id").alias("bookmakers")]
    for o in outcomes:
        price = F.col(f"odd_{o}")
        aggs += [
            F.avg(price).alias(f"odd_{o}_avg"),
            F.median(price).alias(f"odd_{o}_median"),
            F.max(price).alias(f"odd_{o}_max"),
            F.min(price).alias(f"odd_{o}_min"),
        ]
    probs = implied_probs({o: F.col(f"odd_{o}_avg") for o in outcomes})
    return odds_wide.groupBy("fixture_id").agg(*aggs).withColumns({f"implied_{o}": p for o, p in probs.items()})


def both_ways(record: DataFrame) -> DataFrame:
    """One row per unordered pair (``a_*`` / ``b_*``) to one row per orientation."""

    def view(h: str, a: str) -> Column:
        return F.struct(
            F.col(f"team_{h}").alias("home_team_id"),
            F.col(f"team_{a}").alias("away_team_id"),
            F.col("total_matches"),
            F.col(f"{h}_wins").alias("home_wins"),
            F.col("draws"),
            F.col(f"{a}_wins").alias("away_wins"),
            F.col(f"{h}_goals_avg").alias("home_goals_avg"),
            F.col(f"{a}_goals_avg").alias("away_goals_avg"),
        )

    fixed = ("team_a", "team_b", "total_matches", "draws", "a_wins", "b_wins", "a_goals_avg", "b_goals_avg")
    return record.select(*[c for c in record.columns if c not in fixed], F.inline(F.array(view("a", "b"), view("b", "a"))))


def pair_rows(fixtures: DataFrame) -> DataFrame:
    """Finished matches seen from the lower team id: ``team_a, team_b, a_win, draw, b_win, a_goals, b_goals``."""
    low, high = pair_key(F.col("home_team_id"), F.col("away_team_id"))
    straight = F.col("home_team_id") <= F.col("away_team_id")
    a_label = F.when(straight, F.lit("H")).otherwise(F.lit("A"))
    return fixtures.filter(F.col("result").isNotNull()).select(
        "league_id",
        "fixture_id",
        "match_date",
        low.alias("team_a"),
        high.alias("team_b"),
        (F.col("result") == a_label).cast("int").alias("a_win"),
        (F.col("result") == "D").cast("int").alias("draw"),
        ((F.col("result") != a_label) & (F.col("result") != "D")).cast("int").alias("b_win"),
        F.when(straight, F.col("goals_home")).otherwise(F.col("goals_away")).alias("a_goals"),
        F.when(straight, F.col("goals_away")).otherwise(F.col("goals_home")).alias("b_goals"),
    )


def head_to_head(fixtures: DataFrame, n: int | None = 10) -> DataFrame:
    """Record of each pair over its last ``n`` meetings (None: all), one row per orientation."""
    meetings = pair_rows(fixtures)
    keys = ["league_id", "team_a", "team_b"]
    if n is not None:
        meetings = top_k_per_group(meetings, keys, [F.desc("match_date"), F.desc("fixture_id")], n)
    record = meetings.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("int").alias("total_matches"),
        F.sum("a_win").cast("int").alias("a_wins"),
        F.sum("draw").cast("int").alias("draws"),
        F.sum("b_win").cast("int").alias("b_wins"),
        F.avg("a_goals").alias("a_goals_avg"),
        F.avg("b_goals").alias("b_goals_avg"),
    )
    return both_ways(record)


def league_summary(fixtures: DataFrame, by: Sequence[str] = ("league_id", "season")) -> DataFrame:
    """Total / played / pending matches, H / D / A percentages and average goals."""
    return fixtures.groupBy(*by).agg(
        F.count(F.lit(1)).cast("int").alias("total_matches"),
        F.count("result").cast("int").alias("matches_played"),
        (F.count(F.lit(1)) - F.count("result")).cast("int").alias("matches_pending"),
        _share("H").alias("home_win_pct"),
        _share("D").alias("draw_pct"),
        _share("A").alias("away_win_pct"),
        F.avg(F.when(F.col("result").isNotNull(), F.col("goals_home") + F.col("goals_away"))).alias("avg_goals"),
    )


def round_summary(fixtures: DataFrame) -> DataFrame:
    """Goals, mean goals and result distribution per league, season and round."""
    goals = F.when(F.col("result").isNotNull(), F.col("goals_home") + F.col("goals_away"))
    return fixtures.groupBy("league_id", "season", "round").agg(
        F.count("result").alias("matches_played"),
        F.sum(goals).alias("goals"),
        F.avg(goals).alias("avg_goals"),
        F.count_if(F.col("result") == "H").alias("home_wins"),
        F.count_if(F.col("result") == "D").alias("draws"),
        F.count_if(F.col("result") == "A").alias("away_wins"),
    )


def team_season_stats(team_rows: DataFrame) -> DataFrame:
    """Season totals per team over played matches."""
    return (
        team_rows.filter(F.col("outcome").isNotNull())
        .groupBy("league_id", "season", "team_id")
        .agg(
            F.count(F.lit(1)).cast("int").alias("played"),
            F.count_if(F.col("outcome") == "W").cast("int").alias("wins"),
            F.count_if(F.col("outcome") == "D").cast("int").alias("draws"),
            F.count_if(F.col("outcome") == "L").cast("int").alias("losses"),
            F.sum("goals_for").cast("int").alias("goals_for"),
            F.sum("goals_against").cast("int").alias("goals_against"),
            F.sum(points(F.col("outcome"))).cast("int").alias("points"),
        )
        .withColumn("goal_diff", F.col("goals_for") - F.col("goals_against"))
    )


def player_impact(player_stats: DataFrame, by: Sequence[str] = ("season", "team_id", "player_id")) -> DataFrame:
    """Goals and assists per 90 minutes, mean rating and share of the team's playing time.

    The team's available time is 90 minutes for each match in which it fielded anyone.
    """
    per_player = player_stats.groupBy(*by).agg(
        F.sum("goals").alias("goals"),
        F.sum("assists").alias("assists"),
        F.sum("minutes_played").alias("minutes"),
        F.avg("rating").alias("rating_avg"),
    )
    team_keys = [c for c in by if c != "player_id"]
    team = player_stats.groupBy(*team_keys).agg((F.count_distinct("fixture_id") * 90).alias("_available"))
    return (
        per_player.join(team, team_keys)
        .withColumns(
            {
                "goals_per_90": F.try_divide(F.col("goals") * 90.0, F.nullif("minutes", F.lit(0))),
                "assists_per_90": F.try_divide(F.col("assists") * 90.0, F.nullif("minutes", F.lit(0))),
                "minutes_played_pct": F.try_divide(F.col("minutes") * 100.0, F.col("_available")),
            }
        )
        .drop("_available")
    )


def key_players(impact: DataFrame, k: int = 5, by: Sequence[str] = ("season", "team_id")) -> DataFrame:
    """Top ``k`` players per team by goals + assists (ties: more minutes, then lower id)."""
    order = [F.desc(F.col("goals") + F.col("assists")), F.desc("minutes"), F.asc("player_id")]
    return top_k_per_group(impact, by, order, k)


def injury_counts(injuries: DataFrame) -> DataFrame:
    """Distinct injured players per fixture and team."""
    return injuries.groupBy("fixture_id", "team_id").agg(
        F.count_distinct("player_id").cast("int").alias("injuries_count")
    )


def injury_features(injuries: DataFrame, key: DataFrame) -> DataFrame:
    """Injured players and injured key players per fixture and team.

    ``key`` lists the key players by ``season, team_id, player_id``.
    """
    listed = key.select("season", "team_id", "player_id", F.lit(1).alias("_key"))
    # One row per player first: two distinct counts side by side would send every row twice.
    return (
        injuries.join(listed, ["season", "team_id", "player_id"], "left")
        .groupBy("fixture_id", "team_id", "player_id")
        .agg(F.max("_key").alias("_key"))
        .groupBy("fixture_id", "team_id")
        .agg(
            F.count("player_id").cast("int").alias("injuries_count"),
            F.count(F.when(F.col("_key") == 1, F.col("player_id"))).cast("int").alias("key_players_out"),
        )
    )


def quota_status(request_log: DataFrame, day: str = "day") -> DataFrame:
    """Quota use per day from a log with ``remaining`` and ``quota`` columns.

    exhausted at 0 left, critical from 95 % used, warning from 80 %, else ok.
    """
    used = F.try_divide((F.col("quota") - F.col("remaining")) * 100.0, F.col("quota"))
    return (
        request_log.groupBy(day)
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.min("remaining").alias("remaining"),
            F.max("quota").alias("quota"),
        )
        .withColumn("used_pct", F.round(used, 2))
        .withColumn(
            "status",
            F.when(F.col("remaining") <= 0, "exhausted").when(used >= 95, "critical").when(used >= 80, "warning").otherwise(
                "ok"
            ),
        )
    )


def duplicate_report(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """Rows, distinct keys and surplus rows of a table (pre-aggregated by key)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
    ).withColumn("duplicates", F.col("n_rows") - F.col("n_keys"))


def round_predictions(predictions: DataFrame) -> DataFrame:
    """Predictions summarised per league, season and round."""
    top = F.greatest("prob_home_win", "prob_draw", "prob_away_win")
    return predictions.groupBy("league_id", "season", "round").agg(
        F.count(F.lit(1)).alias("predictions"),
        F.count_if(F.col("predicted_result") == "H").alias("home_picks"),
        F.count_if(F.col("predicted_result") == "D").alias("draw_picks"),
        F.count_if(F.col("predicted_result") == "A").alias("away_picks"),
        F.count_if(F.col("confidence") == "high").alias("high_confidence"),
        F.avg(top).alias("avg_top_prob"),
        F.min("match_date").alias("first_match"),
        F.max("match_date").alias("last_match"),
    )


def standings_table(season_stats: DataFrame) -> DataFrame:
    """League positions by points, goal difference, goals scored, then team id.

    Ranks one row per team of a league season, never match rows.
    """
    from pyspark.sql import Window

    order = Window.partitionBy("league_id", "season").orderBy(
        F.desc("points"), F.desc("goal_diff"), F.desc("goals_for"), F.asc("team_id")
    )
    return season_stats.withColumn("position", F.row_number().over(order))
