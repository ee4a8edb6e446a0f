"""Match ratings: an ordered fold with state shared by all teams of a pool.

A rating depends on both teams' previous ratings in a non-linear way, so the matches of a few teams are a chain that no
window or aggregate can express. What can be bounded is the part of the chain in one task, and what can run side by side
is everything that shares no team:

* :func:`elo_ratings` cuts every pool into slabs of ``rows_per_task`` consecutive matches. All pools run in parallel
  within a slab; the ratings after it are a written table that the next slab starts from, so a lost executor costs its slabs
  only. Slabs follow one another, a job each, so a history has at most ``MOST_SLABS`` of them: a longer one has wider slabs.
  A task's rows are sorted by Spark, which spills, and fold batch by batch, so its memory does not follow the slab's width.
* :func:`elo_by_level` rates all matches of one day and level in one distributed join, over all pools and inside them. A
  match's level is the longest chain of that day's matches before it through its two teams. It is for pools with so many
  teams that one task should not even hold a slab of them.
* :func:`elo_stream` keeps the ratings as state of a stream, so matches are rated as they land.
* ``init`` resumes from stored ratings, so a daily run folds only the new matches; :func:`elo_by_period` takes calendar
  periods for slabs.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from touchline.operators.ordered import global_row_number
from touchline.session import scratch_path, stored

RATINGS = (
    "pool BIGINT, fixture_id BIGINT, match_date DATE, season INT, home_team_id BIGINT, away_team_id BIGINT,"
    " home_before DOUBLE, away_before DOUBLE, home_after DOUBLE, away_after DOUBLE"
)
MATCH_COLUMNS = (
    "pool", "fixture_id", "match_date", "season", "home_team_id", "away_team_id", "goals_home", "goals_away", "k",
    "is_state", "rating",
)
STATE = "pool BIGINT, team_id BIGINT, rating DOUBLE, season INT"
# Slabs are folded one after another, so their number is a number of jobs in a row.
MOST_SLABS = 64


@dataclass(frozen=True)
class EloRule:
    """Fixed values of the rating rule; ``min_margin`` > 1 would let draws move ratings."""

    start: float = 1500.0
    k: float = 20.0
    home_advantage: float = 100.0
    scale: float = 400.0
    carry_over: float = 0.9
    min_margin: int = 0

    def change(self, home: float, away: float, goals_home: int, goals_away: int, k: float) -> float:
        """Points the home side gains (the away side loses the same)."""
        expected = 1.0 / (1.0 + 10.0 ** ((away - home - self.home_advantage) / self.scale))
        actual = 1.0 if goals_home > goals_away else 0.5 if goals_home == goals_away else 0.0
        margin = max(abs(goals_home - goals_away), self.min_margin)
        return k * (actual - expected) * math.log(margin + 1.0)

    def opening(self, rating: float, last_season: int, season: int) -> float:
        """Rating pulled towards the start value once per season begun since the last match."""
        return self.start + (rating - self.start) * self.carry_over ** max(season - last_season, 0)


def _fold(rule: EloRule, batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    pool: int | None = None
    ratings: dict[int, tuple[float, int]] = {}
    for batch in batches:
        rated = []
        for row_pool, fixture, day, season, home, away, goals_home, goals_away, k, is_state, stored in zip(
            *(batch[c].tolist() for c in MATCH_COLUMNS), strict=True
        ):
            if row_pool != pool:
                pool, ratings = row_pool, {}
            if is_state:
                ratings[home] = (stored, season)
                continue
            before = [rule.opening(*ratings.get(team, (rule.start, season)), season) for team in (home, away)]
            gain = rule.change(*before, goals_home, goals_away, k)
            ratings[home] = (before[0] + gain, season)
            ratings[away] = (before[1] - gain, season)
            rated.append((pool, fixture, day, season, home, away, *before, before[0] + gain, before[1] - gain))
        yield pd.DataFrame(rated, columns=[part.split()[0] for part in RATINGS.split(",")])


def _matches(fixtures: DataFrame, pool: str, rule: EloRule, k: str | None) -> DataFrame:
    return fixtures.filter(F.col("result").isNotNull()).select(
        F.col(pool).cast("bigint").alias("pool"),
        F.col("fixture_id").cast("bigint"),
        "match_date",
        F.col("season").cast("int"),
        F.col("home_team_id").cast("bigint"),
        F.col("away_team_id").cast("bigint"),
        F.col("goals_home").cast("int"),
        F.col("goals_away").cast("int"),
        (F.lit(rule.k) if k is None else F.col(k)).cast("double").alias("k"),
    )


def _fold_slab(matches: DataFrame, rule: EloRule, init: DataFrame | None) -> DataFrame:
    """Rated matches of one slab, a task per pool."""
    rows = matches.withColumns({"is_state": F.lit(False), "rating": F.lit(None).cast("double")})
    if init is not None:
        known = init.select(
            "pool", F.col("team_id").alias("home_team_id"), "rating", "season", F.lit(True).alias("is_state")
        )
        rows = rows.unionByName(
            known.withColumns({"goals_home": F.lit(0), "goals_away": F.lit(0)}), allowMissingColumns=True
        )
    # Filled so that pandas keeps integer columns integer in batches with state rows.
    rows = rows.fillna({"fixture_id": -1, "away_team_id": -1}).select(*MATCH_COLUMNS)
    ordered = rows.repartition("pool").sortWithinPartitions("pool", F.desc("is_state"), "match_date", "fixture_id")
    return ordered.mapInPandas(lambda batches: _fold(rule, batches), RATINGS)


def _fold_slabs(matches: DataFrame, rule: EloRule, init: DataFrame | None, path: str) -> str:
    """Rate ``matches`` slab by slab (column ``_slab``, ordered like the matches); the path of the rated ones.

    Matches are stored once by slab, so a step reads its own folder. A slab's matches and the ratings after it are written
    tables; ratings before a slab hold only the pools that go on. Only the numbers of the slabs reach the driver.
    """
    spark = matches.sparkSession
    matches.write.partitionBy("_slab").parquet(f"{path}/played")
    matches = spark.read.schema(matches.schema).parquet(f"{path}/played")
    slabs = [row[0] for row in matches.select("_slab").distinct().orderBy("_slab").toLocalIterator()]
    state = init
    for number, slab in enumerate(slabs):
        part = matches.filter(F.col("_slab") == F.lit(slab)).drop("_slab")
        rated = _fold_slab(part, rule, state if state is None else state.join(part.select("pool").distinct(), "pool", "left_semi"))
        rated.write.parquet(f"{path}/matches/slab={number}")
        if number + 1 < len(slabs):
            state = _after(state, spark.read.schema(RATINGS).parquet(f"{path}/matches/slab={number}"), f"{path}/state/{number}")
    if not slabs:
        spark.createDataFrame([], RATINGS).write.parquet(f"{path}/matches/slab=0")
    return f"{path}/matches"


def _after(state: DataFrame | None, rated: DataFrame, path: str) -> DataFrame:
    """Ratings per team after ``rated``, written to ``path``."""
    fresh = current_ratings(rated)
    merged = fresh if state is None else state.join(fresh, ["pool", "team_id"], "left_anti").unionByName(fresh)
    merged.write.parquet(path)
    return rated.sparkSession.read.schema(STATE).parquet(path)


def elo_ratings(
    fixtures: DataFrame,
    pool: str = "league_id",
    rule: EloRule = EloRule(),
    k: str | None = None,
    init: DataFrame | None = None,
    rows_per_task: int = 100_000,
) -> DataFrame:
    """Ratings before and after each finished match, in (match_date, fixture_id) order per pool.

    ``k`` names a column with the per-match K factor. ``init`` holds ``pool, team_id, rating, season``. A task folds
    ``rows_per_task`` matches, numbered over range partitions, or a share of the longest pool that makes ``MOST_SLABS`` slabs
    where that is more.
    """
    numbered = global_row_number(_matches(fixtures, pool, rule, k), ["pool", "match_date", "fixture_id"], "_no")
    first = numbered.groupBy("pool").agg(F.min("_no").alias("_first"), F.count(F.lit(1)).alias("_n"))
    longest = first.agg(F.max("_n")).first()[0] or 0
    width = max(rows_per_task, -(-longest // MOST_SLABS))
    slab = F.floor((F.col("_no") - F.col("_first")) / F.lit(width))
    # Null-safe, as matches without a pool are a pool.
    numbered = numbered.join(first.withColumnRenamed("pool", "_pool"), F.col("pool").eqNullSafe(F.col("_pool")))
    cut = numbered.withColumn("_slab", slab).drop("_no", "_first", "_n", "_pool")
    path = _fold_slabs(cut, rule, init, scratch_path(fixtures.sparkSession, "elo"))
    return fixtures.sparkSession.read.schema(RATINGS).parquet(path)


STREAM_STATE = "teams ARRAY<BIGINT>, ratings ARRAY<DOUBLE>, seasons ARRAY<INT>, last_day INT, last_fixture BIGINT"


def elo_stream(fixtures: DataFrame, pool: str = "league_id", rule: EloRule = EloRule(), k: str | None = None) -> DataFrame:
    """The same ratings over a stream of fixtures, with ``late``; each pool's ratings are state kept in the checkpoint.

    A trigger's matches of a pool are folded in (match_date, fixture_id) order, so landings in order of time give the
    ratings of :func:`elo_ratings`, however often the stream is stopped. A match that arrives after a later one of its pool
    was rated is rated as it comes and marked ``late``. State holds one rating per team; what a trigger reads bounds the rows
    of a task.
    """

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        teams, ratings, seasons, *last = state.get if state.exists else ([], [], [], -1, -1)
        known = pd.DataFrame({c: [0] * len(teams) for c in MATCH_COLUMNS}).assign(
            pool=key[0], home_team_id=list(teams), rating=list(ratings), season=list(seasons), is_state=True
        )
        rows = pd.concat(frames).sort_values(["match_date", "fixture_id"]).assign(pool=key[0], is_state=False, rating=0.0)
        *_, rated = _fold(rule, [known, rows])
        newest = dict(zip(teams, zip(ratings, seasons, strict=True), strict=True))
        for home, away, after_home, after_away, season in zip(
            *(rated[c].tolist() for c in ("home_team_id", "away_team_id", "home_after", "away_after", "season")), strict=True
        ):
            newest[home], newest[away] = (after_home, season), (after_away, season)
        places = [(day.toordinal(), fixture) for day, fixture in zip(rated["match_date"], rated["fixture_id"].tolist(), strict=True)]
        day, fixture = max(tuple(last), places[-1])
        values = list(newest.values())
        state.update((list(newest), [v[0] for v in values], [v[1] for v in values], day, fixture))
        yield rated.assign(late=[place < tuple(last) for place in places])

    matches = _matches(fixtures, pool, rule, k).filter("match_date IS NOT NULL")
    return matches.groupBy("pool").applyInPandasWithState(
        fold, f"{RATINGS}, late BOOLEAN", STREAM_STATE, "append", GroupStateTimeout.NoTimeout
    )


def team_ratings(rated: DataFrame) -> DataFrame:
    """Two rows per rated match: ``team_id, elo_before, elo_after``."""
    sides = F.array(
        F.struct(
            F.col("home_team_id").alias("team_id"),
            F.col("home_before").alias("elo_before"),
            F.col("home_after").alias("elo_after"),
        ),
        F.struct(
            F.col("away_team_id").alias("team_id"),
            F.col("away_before").alias("elo_before"),
            F.col("away_after").alias("elo_after"),
        ),
    )
    return rated.select("pool", "fixture_id", "match_date", "season", F.inline(sides))


def current_ratings(rated: DataFrame) -> DataFrame:
    """Latest rating per pool and team, usable as ``init`` of the next run."""
    last = F.max(F.struct("match_date", "fixture_id", "season", "elo_after"))
    return (
        team_ratings(rated)
        .groupBy("pool", "team_id")
        .agg(last.alias("_last"))
        .select("pool", "team_id", F.col("_last.elo_after").alias("rating"), F.col("_last.season").alias("season"))
    )


def elo_by_period(
    fixtures: DataFrame,
    pool: str = "league_id",
    rule: EloRule = EloRule(),
    k: str | None = None,
    period: str = "year",
    path: str | None = None,
) -> str:
    """The same ratings with calendar periods for slabs; the path of the rated matches."""
    matches = _matches(fixtures, pool, rule, k).withColumn("_slab", F.trunc("match_date", period))
    return _fold_slabs(matches, rule, None, path or scratch_path(fixtures.sparkSession, "elo"))


def day_levels(matches: DataFrame, order: Sequence[str] = ("fixture_id",)) -> DataFrame:
    """Add ``level``: one more than the longest chain of the same day's earlier matches that share a team.

    A team's n-th match of a day has level n at least. Levels then rise until every match stands above the ones before it;
    the number of rounds follows the most matches of a team in one day.
    """
    sides = matches.select("pool", "match_date", *order, F.explode(F.array("home_team_id", "away_team_id")).alias("team"))
    along = Window.partitionBy("pool", "match_date", "team").orderBy(*order)
    seen = sides.withColumns({"n": F.row_number().over(along), "before": F.lag(order[-1]).over(along)})
    per_match = seen.groupBy("pool", "match_date", *order).agg(F.max("n").alias("level"), F.collect_set("before").alias("before"))
    levels = stored(per_match, "levels")
    while True:
        asked = levels.filter(F.size("before") > 0).select("pool", "match_date", *order, F.explode("before").alias("_b"))
        known = levels.select("pool", "match_date", F.col(order[-1]).alias("_b"), F.col("level").alias("_l"))
        least = asked.join(known, ["pool", "match_date", "_b"]).groupBy("pool", "match_date", *order).agg((F.max("_l") + 1).alias("_least"))
        raised = levels.join(least, ["pool", "match_date", *order], "left")
        if raised.filter(F.col("_least") > F.col("level")).isEmpty():
            break
        higher = F.greatest("level", F.coalesce("_least", F.lit(0)))
        levels = stored(raised.withColumn("level", higher).drop("_least"), "levels")
    return matches.join(levels.drop("before"), ["pool", "match_date", *order])


def elo_by_level(
    fixtures: DataFrame,
    pool: str = "league_id",
    rule: EloRule = EloRule(),
    k: str | None = None,
    path: str | None = None,
) -> str:
    """The same ratings with one distributed join per match day and level; the path of the rated matches.

    Matches of one level share no team, so they are rated side by side, whatever their pool. Rated matches are appended to
    the returned table path and the team states go to a fresh folder per step, so a lost executor costs one step at
    most. The only rows on the driver are the distinct days and levels.
    """
    spark = fixtures.sparkSession
    path = path or scratch_path(spark, "elo")
    matches = day_levels(stored(_matches(fixtures, pool, rule, k).filter("match_date IS NOT NULL"), "matches"))
    matches.write.partitionBy("match_date", "level").parquet(f"{path}/played")
    matches = spark.read.schema(matches.schema).parquet(f"{path}/played")
    steps = matches.select("match_date", "level").distinct().orderBy("match_date", "level").toLocalIterator()
    state = spark.createDataFrame([], STATE)
    for number, (day, level) in enumerate(tuple(row) for row in steps):
        rated = matches.filter((F.col("match_date") == F.lit(day)) & (F.col("level") == level))
        for side in ("home", "away"):
            known = state.select(
                "pool",
                F.col("team_id").alias(f"{side}_team_id"),
                F.col("rating").alias(f"_{side}"),
                F.col("season").alias(f"_{side}_season"),
            )
            rated = rated.join(known, ["pool", f"{side}_team_id"], "left").withColumn(
                f"{side}_before", _opening(rule, F.col(f"_{side}"), F.col(f"_{side}_season"))
            )
        rated = (
            rated.withColumn("_gain", _change(rule))
            .withColumns(
                {
                    "home_after": F.col("home_before") + F.col("_gain"),
                    "away_after": F.col("away_before") - F.col("_gain"),
                }
            )
            .select(*[part.split()[0] for part in RATINGS.split(",")])
        )
        rated.write.parquet(f"{path}/matches/step={number}")
        state = _after(state, spark.read.schema(RATINGS).parquet(f"{path}/matches/step={number}"), f"{path}/state/{number}")
    return f"{path}/matches"


def _opening(rule: EloRule, rating: Column, last_season: Column) -> Column:
    """:meth:`EloRule.opening` as an expression; the start value for a team without a rating."""
    begun = F.greatest(F.col("season") - last_season, F.lit(0))
    return F.coalesce(rule.start + (rating - rule.start) * F.pow(F.lit(rule.carry_over), begun), F.lit(rule.start))


def _change(rule: EloRule) -> Column:
    """:meth:`EloRule.change` as an expression over the columns of a match."""
    gap = F.col("away_before") - F.col("home_before") - rule.home_advantage
    expected = 1.0 / (1.0 + F.pow(F.lit(10.0), gap / rule.scale))
    goals = F.col("goals_home") - F.col("goals_away")
    actual = F.when(goals > 0, 1.0).when(goals == 0, 0.5).otherwise(0.0)
    margin = F.greatest(F.abs(goals), F.lit(rule.min_margin))
    return F.col("k") * (actual - expected) * F.ln(margin + 1.0)


def elo_violations(rated: DataFrame, rule: EloRule = EloRule(), low: float = 800.0, high: float = 2200.0) -> DataFrame:
    """Rated matches outside the plausible range, not zero-sum, or with a new team off the start value."""
    first = Window.partitionBy("pool", "team_id").orderBy("match_date", "fixture_id")
    debut = (
        team_ratings(rated)
        .withColumn("_rn", F.row_number().over(first))
        .filter("_rn = 1")
        .filter(F.col("elo_before") != rule.start)
        .select("fixture_id", F.lit("debut_rating").alias("reason"))
    )
    checks = rated.select(
        "fixture_id",
        F.when(~F.col("home_after").between(low, high) | ~F.col("away_after").between(low, high), F.lit("out_of_range"))
        .when(
            F.abs(F.col("home_after") - F.col("home_before") + F.col("away_after") - F.col("away_before")) > 1e-6,
            F.lit("not_zero_sum"),
        )
        .alias("reason"),
    ).filter(F.col("reason").isNotNull())
    return checks.unionByName(debut)
