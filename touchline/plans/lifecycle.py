"""The table lifecycle: raw batches not loaded yet, typed, latest per key, upserted, audited."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from touchline.operators.aggregates import head_to_head, league_summary
from touchline.operators.elo import elo_ratings
from touchline.operators.flatten import stamp
from touchline.plans import marts, serving, silver
from touchline.schemas import FEEDS, RAW, TABLES
from touchline.session import stored
from touchline.sources.histories import load_history
from touchline.sources.landing import mark_raw, scan_since, split_raw
from touchline.sources.tables import (
    append_table,
    expire_partitions,
    layout_job,
    overwrite_partitions,
    publish,
    run_step,
    table_exists,
    upsert_table,
)

Transform = Callable[[DataFrame], DataFrame]

# Typed table -> feed and transform. Fixtures come first: the others take their match day from it.
LOADS: dict[str, tuple[str, Transform]] = {
    "fixtures": ("fixtures", silver.fixtures),
    "match_statistics": ("statistics", silver.statistics),
    "match_events": ("events", silver.events),
    "odds_long": ("odds", silver.odds_long),
    "standings": ("standings", silver.standings),
    "injuries": ("injuries", silver.injuries),
    "lineups": ("lineups", silver.lineups),
    "player_stats": ("players_stats", silver.player_stats),
    "api_predictions": ("predictions", silver.api_predictions),
    "teams": ("teams", silver.teams),
    "leagues": ("leagues", silver.leagues),
    "players": ("players", silver.players),
    "transfers": ("transfers", silver.transfers),
}


def land(rows: DataFrame, root: str, feed: str) -> None:
    """Append raw rows to the feed's date-partitioned raw table."""
    append_table(rows, f"{root}/bronze/{feed}", ["_ingestion_date"])


BATCH = ("_ingestion_date", "_ingestion_ts", "_batch_id")
BATCHES = "table_name STRING, _ingestion_date DATE, _ingestion_ts TIMESTAMP, _batch_id STRING"


def pending(spark: SparkSession, root: str, name: str, raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw rows of the batches that a table has not loaded, and those batches (day, landing time and batch id).

    Batches are compared and not clocks, so rows that land late or for an earlier day are read. Only the days of the new
    batches are scanned; the driver gets as many days as the raw table has directories.
    """
    batches = raw.select(*BATCH).distinct()
    if table_exists(spark, f"{root}/batches"):
        done = spark.read.schema(BATCHES).parquet(f"{root}/batches").filter(F.col("table_name") == name)
        batches = batches.join(done.select(*BATCH), [*BATCH], "left_anti")
    batches = stored(batches, "pending")
    days = [r[0] for r in batches.select("_ingestion_date").distinct().toLocalIterator()]
    rows = raw.filter(F.col("_ingestion_date").isin(days))
    return rows.join(batches, [*BATCH], "left_semi"), batches


def load_table(
    spark: SparkSession, root: str, name: str, run_id: str, since: dt.date | None = None, partitioned: bool = True
) -> dict:
    """One load of a typed table; returns its rows and status, and appends an audit row.

    Reads the batches not loaded before, or every raw row from ``since`` on. Rows that cannot be used go to
    ``rejects/<feed>`` with a reason. The batches are noted after the write, so a failed load reads them again.

    A record is parsed once, for its reject reason and for the typed row; rejects are counted on the way, and only where
    there are some are the raw rows read for them again.
    """
    feed, transform = LOADS[name]
    spec, path = TABLES[name], f"{root}/silver/{name}"
    raw, batches = spark.read.schema(RAW).parquet(f"{root}/bronze/{feed}"), None
    if since is None:
        raw, batches = pending(spark, root, name, raw)
    else:
        raw = scan_since(raw, since)

    rejected, kept = Observation(), Observation()

    def typed(rows: DataFrame) -> DataFrame:
        marked = mark_raw(rows, feed).observe(rejected, F.count("_reject_reason").alias("n"))
        out = transform(marked.filter("_reject_reason IS NULL").drop("_reject_reason"))
        if "match_date" in spec.partition_by and "match_date" not in out.columns:
            out = silver.with_match_date(out, spark.read.parquet(f"{root}/silver/fixtures"))
        return stamp(out, run_id)

    def write(rows: DataFrame) -> None:
        rows = rows.observe(kept, F.count(F.lit(1)).alias("n"))
        upsert_table(rows, path, spec.keys, spec.partition_by if partitioned else (), version="_ingestion_ts")
        # Where no row is typed the planner may leave out the part that counts rejects.
        some = not kept.get["n"] or rejected.get["n"]
        bad = split_raw(raw if some else raw.limit(0), feed)[1]
        append_table(bad.withColumn("_run_id", F.lit(run_id)), f"{root}/rejects/{feed}")

    done = run_step(spark, f"load_{name}", run_id, raw, typed, write, f"{root}/audit")
    if batches is not None:
        batches.select(F.lit(name).alias("table_name"), *BATCH).write.mode("append").parquet(f"{root}/batches")
    return done


def load_all(
    spark: SparkSession, root: str, run_id: str, since: dt.date | None = None, partitioned: bool = True
) -> dict[str, dict]:
    """Every typed table whose raw feed has landed, fixtures first."""
    return {
        name: load_table(spark, root, name, run_id, since, partitioned)
        for name, (feed, _) in LOADS.items()
        if table_exists(spark, f"{root}/bronze/{feed}")
    }


def build_marts(spark: SparkSession, root: str, run_id: str) -> None:
    """Season marts from the typed fixtures; whole partitions are replaced, so a rerun changes nothing."""
    fixtures = spark.read.parquet(f"{root}/silver/fixtures")
    overwrite_partitions(stamp(league_summary(fixtures), run_id), f"{root}/gold/league_summary", ["season"])
    form = marts.team_form(fixtures, elo_ratings(fixtures))
    columns = ["fixture_id", "team_id", "league_id", "season", "reference_date", *marts.FORM, "form_string", "elo_rating"]
    overwrite_partitions(stamp(form.select(*columns), run_id), f"{root}/gold/team_form", ["season"])
    upsert_table(stamp(head_to_head(fixtures), run_id), f"{root}/gold/head_to_head", TABLES["head_to_head"].keys)


def publish_all(spark: SparkSession, root: str, standings: DataFrame, predictions: DataFrame, as_of: Column) -> None:
    """The four served tables, upserted by key, and the history of predictions, appended.

    A served row replaces the one before it; the history keeps every version with its time.
    """
    fixtures = spark.read.parquet(f"{root}/silver/fixtures")
    served = {
        "match_predictions": (predictions, ["fixture_id"]),
        "league_standings": (standings, ["league_id", "season", "team_id"]),
        "team_form": (marts.newest_form(fixtures), ["team_id"]),
        "upcoming_fixtures": (serving.upcoming(fixtures, predictions, as_of), ["fixture_id"]),
    }
    for name, (rows, keys) in served.items():
        publish(rows, f"{root}/serving", name, keys)
    append_table(predictions, f"{root}/serving/historical_predictions")


def keep_history(
    spark: SparkSession, root: str, as_of: dt.date, standings: DataFrame | None = None, strength: DataFrame | None = None
) -> dict[str, bool]:
    """Load the day's standings and ratings into their history tables; returns which of them changed."""
    given = {
        "standings": (standings, ["league_id", "season", "team_id"], ["position", "points", "form"]),
        "team_strength": (strength, ["pool", "team_id"], ["elo_rating"]),
    }
    if strength is not None:
        given["team_strength"] = (strength.withColumn("elo_rating", F.round("rating").cast("int")), *given["team_strength"][1:])
    return {
        name: load_history(rows, f"{root}/history/{name}", keys, checked, as_of)
        for name, (rows, keys, checked) in given.items()
        if rows is not None
    }


def expire_tables(spark: SparkSession, root: str, today: dt.date) -> dict[str, int]:
    """Drop partitions of typed and mart tables older than each spec's ``retention_days``; returns how many went.

    A season ends with its year. Tables without a date or season partition are kept whole.
    """
    gone = {}
    for name, spec in TABLES.items():
        path = f"{root}/{spec.layer}/{name}"
        if spec.partition_by in (("match_date",), ("season",)) and table_exists(spark, path):
            last_day = F.make_date("season", F.lit(12), F.lit(31)) if spec.partition_by == ("season",) else F.col("match_date")
            gone[name] = expire_partitions(spark, path, spec.partition_by[0], spec.retention_days, today, last_day)
    return gone


def layout_all(spark: SparkSession, root: str, out_root: str, file_bytes: int = 512 << 20) -> DataFrame:
    """Cluster every registered table that exists; the list comes from the table specs."""
    listed = {
        name: (f"{root}/{spec.layer}/{name}", spec.cluster_by, spec.partition_by) for name, spec in TABLES.items()
    }
    return layout_job(spark, listed, out_root, file_bytes)


def expire_raw(spark: SparkSession, root: str, today: dt.date, days: int = 30) -> dict[str, int]:
    """Drop raw partitions older than ``days`` per landed feed; returns how many went."""
    return {
        feed: expire_partitions(spark, f"{root}/bronze/{feed}", "_ingestion_date", days, today)
        for feed in FEEDS
        if table_exists(spark, f"{root}/bronze/{feed}")
    }
