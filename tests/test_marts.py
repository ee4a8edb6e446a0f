"""Aggregates, marts, history, metrics and the model on small literal tables."""

import datetime as dt
import random
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from touchline.functions.columns import implied_probs
from touchline.operators import aggregates, history, joins, metrics
from touchline.operators.flatten import to_team_rows
from touchline.plans import marts, model, serving
from touchline.session import scratch_path

FIXTURES = (
    "fixture_id BIGINT, league_id BIGINT, season INT, round INT, match_date DATE, home_team_id BIGINT, away_team_id BIGINT,"
    " goals_home INT, goals_away INT, result STRING"
)


def day(n):
    return dt.date(2025, 1, 1) + dt.timedelta(days=n)


def game(i, n, home, away, h=None, w=None):
    label = None if h is None else "H" if h > w else "D" if h == w else "A"
    return (i, 1, 2025, n, day(n), home, away, h, w, label)


def test_team_rows_and_season_table(spark):
    df = spark.createDataFrame([game(1, 0, 1, 2, 2, 0), game(2, 1, 2, 1, 1, 1), game(3, 2, 1, 2)], FIXTURES)
    rows = to_team_rows(df)
    assert rows.count() == 6 and rows.filter("outcome is null").count() == 2
    table = {r.team_id: r for r in aggregates.standings_table(aggregates.team_season_stats(rows)).collect()}
    assert (table[1].points, table[1].position, table[2].points, table[2].goal_diff) == (4, 1, 1, -2)


def test_head_to_head_merges_reversed_pairs(spark):
    df = spark.createDataFrame([game(1, 0, 1, 2, 2, 0), game(2, 1, 2, 1, 3, 0), game(3, 2, 1, 2, 1, 1), game(4, 3, 1, 2)], FIXTURES)
    got = {(r.home_team_id, r.away_team_id): (r.total_matches, r.home_wins, r.draws, r.away_wins, r.home_goals_avg) for r in aggregates.head_to_head(df).collect()}
    assert got == {(1, 2): (3, 1, 1, 1, 1.0), (2, 1): (3, 1, 1, 1, 4 / 3)}
    last = aggregates.head_to_head(df, 1).filter("home_team_id = 1").first()
    assert (last.total_matches, last.draws) == (1, 1)


def test_meeting_features_use_only_the_past(spark):
    df = spark.createDataFrame([game(1, 0, 1, 2, 2, 0), game(2, 5, 2, 1, 3, 0), game(3, 9, 1, 2)], FIXTURES)
    got = {r.fixture_id: (r.h2h_total_games, r.h2h_home_wins, r.h2h_away_wins) for r in marts.meeting_features(df).collect()}
    assert got == {1: (0, 0, 0), 2: (1, 0, 1), 3: (2, 1, 1)}


def test_league_summary_and_round(spark):
    df = spark.createDataFrame([game(1, 0, 1, 2, 2, 0), game(2, 0, 3, 4, 1, 1), game(3, 0, 5, 6)], FIXTURES)
    row = aggregates.league_summary(df).first()
    assert (row.total_matches, row.matches_played, row.matches_pending, row.home_win_pct, row.avg_goals) == (3, 2, 1, 50.0, 2.0)
    open_ = aggregates.league_summary(df.filter("result is null")).first()
    assert open_.home_win_pct is None and open_.avg_goals is None
    assert aggregates.round_summary(df).first().goals == 4


def test_consensus_uses_the_exact_median(spark):
    rows = [(1, 1, 1.0, 3.0, 4.0), (1, 2, 2.0, 3.0, None)]
    df = spark.createDataFrame(rows, "fixture_id INT, bookmaker_id INT, odd_home DOUBLE, odd_draw DOUBLE, odd_away DOUBLE")
    row = aggregates.odds_consensus(df).first()
    assert (row.odd_home_median, row.odd_home_avg, row.odd_away_max, row.bookmakers) == (1.5, 1.5, 4.0, 2)
    assert abs(row.implied_home + row.implied_draw + row.implied_away - 1) < 1e-12


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(*[st.floats(1.01, 100)] * 3), min_size=1, max_size=20))
def test_implied_probabilities_sum_to_one(spark, odds):
    df = spark.createDataFrame(odds, "h DOUBLE, d DOUBLE, a DOUBLE")
    probs = implied_probs({c: F.col(c) for c in "hda"})
    total = probs["h"] + probs["d"] + probs["a"]
    assert df.filter(F.abs(total - 1) > 1e-9).isEmpty()


def test_player_impact_without_minutes(spark):
    df = spark.createDataFrame([(1, 2025, 1, 9, 0, 1, 0, 7.0), (1, 2025, 1, 8, 45, 1, 1, None)], "fixture_id INT, season INT, team_id INT, player_id INT, minutes_played INT, goals INT, assists INT, rating DOUBLE")
    got = {r.player_id: (r.goals_per_90, r.assists_per_90, r.minutes_played_pct) for r in aggregates.player_impact(df).collect()}
    assert got == {9: (None, None, 0.0), 8: (2.0, 2.0, 50.0)}


@pytest.mark.parametrize(("left", "status"), [(0, "exhausted"), (50, "critical"), (200, "warning"), (201, "ok"), (None, "ok")])
def test_quota_status(spark, left, status):
    log = spark.createDataFrame([(day(0), left, 1000)], "day DATE, remaining INT, quota INT")
    assert aggregates.quota_status(log).first().status == status


def test_derby_flag_is_order_free_and_unique(spark):
    fixtures = spark.createDataFrame([(1, 1, 2), (2, 2, 1), (3, 1, 3)], "fixture_id INT, h INT, a INT")
    pairs = spark.createDataFrame([(2, 1), (1, 2)], "team_a INT, team_b INT")
    got = {r.fixture_id: r.is_derby for r in joins.flag_pairs(fixtures, pairs, "h", "a").collect()}
    assert got == {1: True, 2: True, 3: False}


def test_scd2_apply(spark):
    schema = "team_id INT, points INT, valid_from DATE, valid_to DATE, is_current BOOLEAN"
    start = spark.createDataFrame([(1, 5, day(0), None, True), (2, None, day(0), None, True), (3, 7, day(0), None, True)], schema)
    snap = spark.createDataFrame([(1, 8), (2, None), (4, 1)], "team_id INT, points INT")
    out = history.scd2_apply(start, snap, ["team_id"], ["points"], F.lit(day(5)))
    got = sorted((r.team_id, r.points, r.valid_to, r.is_current) for r in out.fillna(-1, ["points"]).collect() if r)
    assert got == [(1, 5, day(5), False), (1, 8, None, True), (2, -1, None, True), (3, 7, None, True), (4, 1, None, True)] or got == sorted(
        [(1, 5, day(5), False), (1, 8, None, True), (2, -1, None, True), (3, 7, None, True), (4, 1, None, True)], key=str
    )
    again = history.scd2_apply(out, snap, ["team_id"], ["points"], F.lit(day(9)))
    assert again.exceptAll(out).isEmpty() and again.count() == out.count()
    assert history.scd2_violations(again, ["team_id"]).isEmpty()


def predictions(spark, n=300, seed=3):
    rng, rows = random.Random(seed), []
    for i in range(n):
        p = sorted(rng.random() for _ in range(2))
        probs = [round(x, 4) for x in (p[0], p[1] - p[0], 1 - p[1])]
        pick = "HDA"[max(range(3), key=lambda j: probs[j])]
        rows.append((i, f"v{i % 2}", day(i), *probs, pick, rng.choice("HDA")))
    return spark.createDataFrame(
        rows,
        "fixture_id INT, model_version STRING, match_date DATE, prob_home_win DOUBLE, prob_draw DOUBLE, prob_away_win DOUBLE,"
        " predicted_result STRING, actual_result STRING",
    ).withColumn("was_correct", F.col("predicted_result") == F.col("actual_result"))


def test_auc_equals_pairwise_count(spark):
    df = predictions(spark)
    rows = df.collect()
    for r in metrics.auc_by_class(df).collect():
        col = metrics.PROBS[r.label]
        pos = [x[col] for x in rows if x.model_version == r.model_version and x.actual_result == r.label]
        neg = [x[col] for x in rows if x.model_version == r.model_version and x.actual_result != r.label]
        want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
        assert abs(r.auc - want) < 1e-9


def test_drift_and_trend(spark):
    df = predictions(spark)
    drifted = metrics.drift_check(
        df.withColumn("was_correct", F.col("fixture_id") < 200), n=50, tolerance=0.1
    )
    assert all(r.drifted and r.recent_accuracy == 0 for r in drifted.collect())
    trend = metrics.accuracy_trend(df).orderBy("month").collect()
    last = {r.model_version: r.cumulative_accuracy for r in trend}
    want = {r.model_version: r.a for r in df.groupBy("model_version").agg(F.avg(F.col("was_correct").cast("int")).alias("a")).collect()}
    assert all(abs(last[k] - want[k]) < 1e-12 for k in want)


def test_promotion_and_register(spark):
    schema = "model_version STRING, log_loss DOUBLE"
    none = spark.createDataFrame([], schema)
    first = spark.createDataFrame([("v1", 1.0)], schema)
    worse, better = (spark.createDataFrame([("v2", x)], schema) for x in (1.1, 0.9))
    assert metrics.compare_models(first, none).first().should_promote
    register = first.withColumn("is_active", F.lit(True))
    for candidate, active in ((worse, "v1"), (better, "v2")):
        decided = metrics.compare_models(candidate, first)
        rows = metrics.register_models(register, candidate, decided).collect()
        assert [r.model_version for r in rows if r.is_active] == [active] and len(rows) == 2


def test_time_split_never_cuts_a_day(spark):
    df = spark.createDataFrame([(i, day(i // 7)) for i in range(100)], "k INT, match_date DATE")
    parts = model.time_split(df, 0.2)
    span = {r.part: (r.a, r.b) for r in parts.groupBy("part").agg(F.min("match_date").alias("a"), F.max("match_date").alias("b")).collect()}
    assert span["train"][1] < span["validation"][0]
    folds = model.with_fold(df, 3).groupBy("fold").agg(F.min("match_date").alias("a"), F.max("match_date").alias("b")).orderBy("fold").collect()
    assert [r.fold for r in folds] == [0, 1, 2, 3] and all(x.b < y.a for x, y in zip(folds, folds[1:], strict=False))


def test_stack_learns_and_probabilities_sum_to_one(spark):
    rng, rows = random.Random(5), []
    for i in range(240):
        x = rng.gauss(0, 1)
        label = "H" if x > 0.4 else "A" if x < -0.4 else "D"
        rows.append((i, day(i), label, x, None if i % 9 == 0 else rng.random()))
    df = spark.createDataFrame(rows, "fixture_id INT, match_date DATE, result STRING, a DOUBLE, b DOUBLE").repartition(2)
    sizes = model.StackSizes(trees=5, tree_depth=3, boost_rounds=2, boost_depth=2, second_boost_depth=2, folds=1)
    stack = model.train_stack(model.feature_rows(df.filter("fixture_id < 200"), ["a", "b"]), sizes, ["a", "b"])
    scored = marts.prediction_rows(
        model.score(stack, model.feature_rows(df.filter("fixture_id >= 200"), ["a", "b"])), "v1", F.current_timestamp()
    ).cache()
    total = F.col("prob_home_win") + F.col("prob_draw") + F.col("prob_away_win")
    assert scored.count() == 40 and scored.filter(F.abs(total - 1) > 1e-9).isEmpty()
    assert scored.filter("predicted_result = result").count() > 25
    importance = {r.feature: r.importance for r in model.feature_importance(spark, stack).collect()}
    assert importance["a"] > importance["b"]


def _forest_rows(spark, n=400):
    rng = random.Random(9)
    rows = [(float(rng.randrange(3)), [rng.gauss(0, 1), float(rng.randrange(4)), rng.random()], i % 5 == 0) for i in range(n)]
    return spark.createDataFrame(rows, "label DOUBLE, x ARRAY<DOUBLE>, newest BOOLEAN").select(
        "label", array_to_vector("x").alias("features"), "newest"
    )


def test_forest_is_scored_as_by_its_own_transform(spark):
    """Blocks of trees over dense, sparse and missing values: the probabilities are equal bit by bit, also after loading."""
    rows, nan = _forest_rows(spark).drop("newest"), float("nan")
    odd = [Vectors.sparse(3, {0: 0.5}), Vectors.dense(0.0, nan, 0.25), Vectors.dense(nan, nan, nan), Vectors.dense(1e300, -1e300, 0.0)]
    asked = rows.unionByName(spark.createDataFrame([(0.0, v) for v in odd], ["label", "features"]))
    blocks = [RandomForestClassifier(numTrees=n, maxDepth=6, seed=n).fit(rows) for n in (7, 4)]
    path = scratch_path(spark, "block")
    blocks[1].write().save(path)
    loaded = RandomForestClassificationModel.load(path)
    for models in (blocks, [blocks[0], loaded], blocks[1:]):
        out = asked
        for i, m in enumerate(models):
            out = m.setProbabilityCol(f"p{i}").setRawPredictionCol(f"r{i}").setPredictionCol(f"l{i}").transform(out)
        for r in model._probabilities(models, out, "q").collect():
            assert r.q == [sum(r[f"p{i}"][k] for i in range(len(models))) / len(models) for k in range(3)]


def test_a_block_scores_the_held_out_rows_once_and_rows_keep_their_nodes(spark, monkeypatch):
    """Each block alone was scored before with all blocks before it; what is grown is the same."""
    scored, fitted, probabilities, fit = [], [], model._probabilities, RandomForestClassifier.fit

    def seen(models, df, name):
        scored.append(len(models))
        return probabilities(models, df, name)

    def grown(self, rows):
        fitted.append(self.getCacheNodeIds())
        return fit(self, rows)

    monkeypatch.setattr(model, "_probabilities", seen)
    monkeypatch.setattr(RandomForestClassifier, "fit", grown)
    rows = _forest_rows(spark).coalesce(1)
    sizes = model.StackSizes(trees=12, tree_depth=4, block=4, tolerance=-10.0)  # no block ends it
    blocks = model.grow_forest(rows, sizes)
    assert scored == [1, 1, 1] and fitted == [True] * 3 and [m.getNumTrees for m in blocks] == [4, 4, 4]
    monkeypatch.undo()
    plain = RandomForestClassifier(numTrees=4, maxDepth=4, seed=7).fit(rows.filter("NOT newest"))
    assert plain.toDebugString.split("\n", 1)[1] == blocks[0].toDebugString.split("\n", 1)[1]
    assert [m.getNumTrees for m in model.grow_forest(rows, replace(sizes, tolerance=0.9))] == [4, 4]
    assert len(model.grow_forest(rows.filter("NOT newest"), sizes)) == 1  # nothing measures the loss


def test_serving(spark):
    df = spark.createDataFrame([game(1, 0, 1, 2, 2, 0), game(2, 5, 1, 2), game(3, 6, 3, 4), game(4, 9, 5, 6)], FIXTURES)
    preds = df.filter("fixture_id <> 4").drop("result")
    assert {r.fixture_id: r.has_prediction for r in serving.upcoming(df, preds, F.lit(day(1))).collect()} == {2: True, 3: True, 4: False}
    assert [r.fixture_id for r in serving.next_round(preds, 1, F.lit(day(1))).collect()] == [2]
    assert serving.next_round(preds, 7, F.lit(day(1))).isEmpty()
    form = marts.team_form(df)
    assert serving.team_form(form, 1).first().form_string == "W" and serving.team_form(form, 99).isEmpty()


def _crowded(spark, n=240):
    """Several matches of a team on one day, some of them open."""
    rng, rows = random.Random(11), []
    for i in range(n):
        home, away = rng.sample(range(1, 6), 2)
        played = i % 5 > 0
        rows.append(game(i, i // 12, home, away, rng.randrange(4) if played else None, rng.randrange(4) if played else None))
    return spark.createDataFrame(rows, FIXTURES)


def test_newest_form_is_the_last_row_of_each_team_and_day(spark):
    df = _crowded(spark)
    whole = marts.team_form(df).toPandas().sort_values(["match_date", "fixture_id"])
    for within, keys in (((), ["team_id"]), (("match_date",), ["team_id", "match_date"])):
        newest = marts.newest_form(df, within=within).toPandas()
        want = whole.groupby(keys).tail(1)
        by = ["team_id", "fixture_id"]
        assert newest[whole.columns].sort_values(by).values.tolist() == want.sort_values(by).values.tolist()


def test_side_features_have_one_row_per_team_and_day(spark):
    """Matches of one team on one day have one past, looked up once and strictly before the day."""
    df = _crowded(spark)
    state = marts.newest_form(df, within=("match_date",)).withColumn("elo_after", F.lit(1500.0))
    standings = spark.createDataFrame([(1, 3, 2025, 4, 7, day(4))], "league_id BIGINT, team_id BIGINT, season INT, position INT, points INT, _snapshot_date DATE")
    sides = marts.side_features(df, state, standings)
    assert sides.groupBy("team_id", "is_home", "match_date").count().filter("count > 1").isEmpty()
    assert sides.filter("form_source_date >= match_date OR standing_source_date >= match_date").isEmpty()
    base = df.select("fixture_id", "league_id", "match_date", "home_team_id", "away_team_id")
    got = {r.fixture_id: r for r in marts.with_sides(base, sides).collect()}
    played = [r for r in to_team_rows(df).collect() if r.outcome is not None]
    assert len(got) == 240
    for row in got.values():
        for side in ("home", "away"):
            team = row[f"{side}_team_id"]
            past = sorted((r.match_date, r.fixture_id, r.outcome) for r in played if r.team_id == team and r.match_date < row.match_date)[-5:]
            assert row[f"{side}_wins_last_5"] == [p[2] for p in past].count("W")
            own = sorted((r.match_date, r.fixture_id, r.outcome) for r in played if r.team_id == team and r.match_date < row.match_date and r.is_home == (side == "home"))[-5:]
            assert row[f"{side}_{side}_wins_last_5"] == [p[2] for p in own].count("W")
            assert row[f"{side}_position"] == (4 if team == 3 and row.match_date > day(4) else None)


def test_injury_counts_send_each_row_once(spark):
    key = spark.createDataFrame([(2025, 1, 7)], "season INT, team_id INT, player_id INT")
    hurt = spark.createDataFrame([(1, 2025, 1, 7), (1, 2025, 1, 7), (1, 2025, 1, 8), (1, 2025, 1, None), (2, 2025, 1, None)], "fixture_id INT, season INT, team_id INT, player_id INT")
    rows = aggregates.injury_features(hurt, key)
    assert sorted(tuple(r) for r in rows.collect()) == [(1, 1, 2, 1), (2, 1, 0, 0)]
    assert "Expand" not in rows._jdf.queryExecution().executedPlan().toString()
