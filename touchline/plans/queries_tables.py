"""Queries over landing, tables, layout and streams. Tables are written below the shared folder."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.operators import elo, ordered, quality
from touchline.operators.flatten import parse_payload
from touchline.plans import lifecycle, marts, queries_marts, queries_silver, silver, testbed  # noqa: F401  their SQL counts the typed rows
from touchline.plans.catalog import ORACLES, query
from touchline.plans.sqltext import FX, PREDS, QUOTES, SEASONS, TEAMS, with_
from touchline.schemas import FEEDS
from touchline.session import scratch_path, stored
from touchline.sources import histories, landing, tables
from touchline.streaming import live

c = F.col

_STANDING_COLUMNS = (
    "fixture_id", "league_id", "season", "team_id", "match_date", "outcome", "goals_for", "goals_against", "form_string",
)


@query(
    "scan_since",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '2000-01-01'",
)
def scan_since(spark, sf):
    path = scratch_path(spark, "scan")
    rows = testbed.table(spark, sf, "orders").select("o_orderkey", F.trunc(c("o_orderdate").cast("date"), "year").alias("year"), c("o_orderdate").cast("date").alias("day"))
    tables.append_table(rows, path, ["year"])
    return landing.scan_since(spark.read.parquet(path), dt.date(2000, 1, 1), "year").select("o_orderkey", "day")


@query("high_water_mark", "SELECT max(CAST(ts AS DATE)) AS mark, CAST(count(*) AS BIGINT) AS rows_since FROM events WHERE CAST(ts AS DATE)=(SELECT max(CAST(ts AS DATE)) FROM events)")
def high_water_mark(spark, sf):
    rows = testbed.table(spark, sf, "events").withColumn("day", c("ts").cast("date"))
    mark = landing.high_water_mark(rows, "day")
    return landing.scan_since(rows, mark, "day").agg(F.max("day").alias("mark"), F.count(F.lit(1)).alias("rows_since"))


@query(
    "no_data_status",
    """SELECT CAST(y AS INTEGER) AS year, CASE WHEN n>0 THEN 'success' ELSE 'no_data' END AS status, n AS rows_affected
FROM (SELECT y, (SELECT count(*) FROM orders WHERE year(o_orderdate)=y) AS n FROM range(1994, 2004) t(y))""",
)
def no_data_status(spark, sf):
    """One load per year; years without orders end as no_data."""
    rows, done = testbed.table(spark, sf, "orders"), []
    for year in range(1994, 2004):
        mine = rows.filter(F.year("o_orderdate") == year)
        out = tables.run_step(spark, f"y{year}", "r1", mine, lambda d: d, lambda d: d.write.parquet(scratch_path(spark, "year")))
        done.append((year, out["status"], out["rows_affected"]))
    return spark.createDataFrame(done, "year INT, status STRING, rows_affected BIGINT")


def _envelopes(spark, sf):
    """One response body per order, holding one record per item of the order's key digits (1 to 3)."""
    record = F.struct(
        F.struct(c("fixture_id").alias("id"), F.lit(None).cast("string").alias("date")).alias("fixture"),
        F.struct(c("season")).alias("league"),
    )
    records = F.transform(F.sequence(F.lit(1), (c("fixture_id") % 3 + 1).cast("int")), lambda _: record)
    body = F.to_json(
        F.struct(F.struct(c("league_id").cast("string").alias("league")).alias("parameters"), records.alias("response"))
    )
    return testbed.fixtures(spark, sf).select(body.alias("body"))


@query(
    "land_raw",
    with_(
        FX,
        body="""SELECT fixture_id, season, CAST(league_id AS VARCHAR) AS league, '/fixtures' AS endpoint, count(*) AS n
FROM fx, range(3) t(i) WHERE i<=fixture_id%3 GROUP BY ALL""",
    ),
)
def land_raw(spark, sf):
    raw = landing.land_raw(_envelopes(spark, sf), "fixtures", "b1", at=F.lit("2025-01-01").cast("timestamp"))
    return (
        raw.select(
            F.get_json_object("payload", "$.fixture.id").cast("bigint").alias("fixture_id"),
            F.get_json_object("payload", "$.league.season").cast("int").alias("season"),
            F.get_json_object("params", "$.league").alias("league"),
            "endpoint",
        )
        .groupBy("fixture_id", "season", "league", "endpoint")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("land_files", "SELECT o_orderkey, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL")
def land_files(spark, sf):
    """Records written as CSV files and landed again."""
    path = scratch_path(spark, "csv")
    testbed.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus").write.option("header", True).csv(path)
    bodies = landing.read_bodies(spark, path, "csv", "o_orderkey BIGINT, o_orderstatus STRING")
    raw = landing.land_raw(bodies, "fixtures", "b1", shape="record")
    return (
        raw.select(F.from_json("payload", "o_orderkey BIGINT, o_orderstatus STRING").alias("r"))
        .groupBy("r.o_orderkey", "r.o_orderstatus")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "land_feeds",
    with_(
        TEAMS,
        body="""SELECT * FROM (SELECT '/fixtures' AS endpoint, 2*count(*) AS n FROM fx
UNION ALL SELECT '/fixtures/statistics', count(*) FROM pr
UNION ALL SELECT '/fixtures/events', CAST(sum((fixture_id%4)*(fixture_id%2+1)) AS BIGINT) FROM fx WHERE status='FT'
UNION ALL SELECT '/fixtures/lineups', count(*) FROM pr
UNION ALL SELECT '/fixtures/players', count(*) FROM lineitem JOIN fx ON l_orderkey=fixture_id
UNION ALL SELECT '/odds', count(*) FROM lineitem
UNION ALL SELECT '/standings', count(*) FROM (SELECT DISTINCT league_id, season FROM pr)
UNION ALL SELECT '/injuries', count(*) FROM lineitem JOIN fx ON l_orderkey=fixture_id WHERE l_returnflag='R'
UNION ALL SELECT '/predictions', count(*) FROM fx UNION ALL SELECT '/teams', count(*) FROM fx
UNION ALL SELECT '/leagues', count(*) FROM fx UNION ALL SELECT '/players', count(*) FROM part
UNION ALL SELECT '/transfers', count(*) FROM orders)""",
    ),
)
def land_feeds(spark, sf):
    """Records per feed that parse by the feed's schema."""
    sources = {
        "leagues": testbed.raw_leagues,
        "fixtures": testbed.raw_fixtures,
        "statistics": testbed.raw_statistics,
        "events": testbed.raw_events,
        "lineups": testbed.raw_lineups,
        "players_stats": testbed.raw_player_stats,
        "odds": testbed.raw_odds,
        "standings": testbed.raw_standings,
        "injuries": testbed.raw_injuries,
        "predictions": testbed.raw_api_predictions,
        "teams": testbed.raw_teams,
        "players": testbed.raw_players,
        "transfers": testbed.raw_transfers,
    }
    out = None
    for feed, make in sources.items():
        parsed = parse_payload(make(spark, sf).select("endpoint", "payload"), FEEDS[feed].schema)
        usable = [c("rec").getField(f.name).isNotNull() for f in parsed.schema["rec"].dataType]
        counts = parsed.filter(reduce(lambda a, b: a | b, usable)).groupBy("endpoint").agg(F.count(F.lit(1)).alias("n"))
        out = counts if out is None else out.unionByName(counts)
    return out


@query(
    "plan_requests",
    with_(FX, QUOTES, body="""SELECT fixture_id, b AS bet_id FROM fx, (VALUES (1),(5),(8)) t(b)
WHERE status='NS' AND NOT (b=1 AND fixture_id IN (SELECT fixture_id FROM q))"""),
)
def plan_requests(spark, sf):
    open_ = testbed.fixtures(spark, sf).filter(c("status") == "NS")
    have = testbed.quotes(spark, sf).select("fixture_id", c("bet_id").cast("int").alias("bet_id"))
    return landing.plan_requests(open_, already=have)


@query(
    "batch_keys",
    with_(FX, body="""SELECT batch_no, count(*) AS n_keys, string_agg(CAST(fixture_id AS VARCHAR), '-' ORDER BY fixture_id) AS ids FROM (
SELECT fixture_id, (row_number() OVER (ORDER BY fixture_id)-1)//20 AS batch_no FROM fx WHERE status='NS') GROUP BY batch_no"""),
)
def batch_keys(spark, sf):
    return landing.batch_keys(testbed.fixtures(spark, sf).filter(c("status") == "NS"), "fixture_id")


@query(
    "batch_sparse_keys",
    with_(FX, body="""SELECT batch_no, count(*) AS n_keys, string_agg(CAST(k AS VARCHAR), '-' ORDER BY k) AS ids FROM (
SELECT fixture_id*10000019 AS k, (row_number() OVER (ORDER BY fixture_id)-1)//20 AS batch_no FROM fx) GROUP BY batch_no"""),
)
def batch_sparse_keys(spark, sf):
    keys = testbed.fixtures(spark, sf).select((c("fixture_id") * 10000019).alias("k"))
    return landing.batch_keys(keys, "k")


@query("number_rows", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderstatus, o_orderkey) AS row_no FROM orders")
def number_rows(spark, sf):
    """A first order column of few values, each of which holds a large part of all rows."""
    rows = testbed.table(spark, sf, "orders").select("o_orderstatus", "o_orderkey")
    return ordered.global_row_number(rows, ["o_orderstatus", "o_orderkey"]).drop("o_orderstatus")


@query("date_window", with_(FX, body="SELECT fixture_id, match_date FROM fx WHERE match_date BETWEEN DATE '1998-03-01' AND DATE '1998-03-31'"))
def date_window(spark, sf):
    window = landing.date_window("backfill", dt.date(1998, 3, 1), dt.date(1998, 3, 31))
    return landing.in_window(testbed.fixtures(spark, sf), window).select("fixture_id", "match_date")


@query("read_seed", "SELECT CAST(r_regionkey AS INTEGER) AS league_id, r_name AS league_name, count(*) AS teams FROM region JOIN nation ON n_regionkey=r_regionkey JOIN customer ON c_nationkey=n_nationkey GROUP BY ALL")
def read_seed(spark, sf):
    path = scratch_path(spark, "seed")
    testbed.table(spark, sf, "region").write.option("header", True).csv(path)
    seed = landing.read_seed(spark, path, "league_id INT, league_name STRING")
    nations = testbed.table(spark, sf, "nation").select("n_nationkey", c("n_regionkey").alias("league_id"))
    clubs = testbed.table(spark, sf, "customer").join(nations, c("c_nationkey") == c("n_nationkey"))
    return clubs.join(seed, "league_id").groupBy("league_id", "league_name").agg(F.count(F.lit(1)).alias("teams"))


# --- tables ---------------------------------------------------------------------------------------


@query("append_history", "SELECT user_id, 2*count(*) AS n FROM events GROUP BY user_id")
def append_history(spark, sf):
    path = scratch_path(spark, "history")
    rows = testbed.table(spark, sf, "events").select("user_id", "event_id", F.trunc(c("ts").cast("date"), "month").alias("month"))
    for _ in range(2):
        tables.append_history(rows, path, ["month"])
    return spark.read.parquet(path).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))



@query(
    "upsert_fixtures",
    with_(FX, body="""SELECT fixture_id, CASE WHEN fixture_id%3=0 THEN 'NEW' ELSE status END AS status, season FROM fx
UNION ALL SELECT fixture_id+1000000000, 'NEW', season FROM fx WHERE fixture_id%3=0"""),
)
def upsert_fixtures(spark, sf):
    """Every third fixture is updated, and as many new ones arrive."""
    target = testbed.fixtures(spark, sf).select("fixture_id", "status", "season")
    changed = target.filter(c("fixture_id") % 3 == 0).withColumn("status", F.lit("NEW"))
    new = changed.withColumn("fixture_id", c("fixture_id") + 1000000000)
    return tables.upsert(target, changed.unionByName(new), ["fixture_id"])


@query(
    "upsert_table_moved",
    with_(FX, body="""SELECT fixture_id, CASE WHEN status='PST' THEN season+1 ELSE season END AS season, CASE WHEN status='PST' THEN 'NS' ELSE status END AS status FROM fx"""),
)
def upsert_table_moved(spark, sf):
    """Postponed matches move to the next season's partition; no old copy may stay. Loaded twice."""
    path = scratch_path(spark, "moved")
    rows = testbed.fixtures(spark, sf).select("fixture_id", "status", "season")
    tables.upsert_table(rows, path, ["fixture_id"], ["season"])
    moved = rows.filter(c("status") == "PST").withColumns({"season": c("season") + 1, "status": F.lit("NS")})
    for _ in range(2):
        tables.upsert_table(moved, path, ["fixture_id"], ["season"])
    return spark.read.parquet(path).select("fixture_id", "season", "status")


@query(
    "upsert_text_partition",
    """SELECT o_orderkey, lpad(CAST((o_custkey+CASE WHEN o_orderkey%7=0 THEN 1 ELSE 0 END)%9 AS VARCHAR), 3, '0') || '/' ||
  o_orderstatus || ' x' AS code, lpad(CAST(CASE WHEN o_orderkey%7=0 THEN 8 ELSE 7 END AS VARCHAR), 3, '0') AS number FROM orders""",
)
def upsert_text_partition(spark, sf):
    """Rows move between partitions whose names need escaping or look like numbers; no old copy may stay."""
    path, schema = scratch_path(spark, "text"), "o_orderkey BIGINT, code STRING, number STRING"

    def at(step, number):
        code = F.concat(F.lpad(((c("o_custkey") + step) % 9).cast("string"), 3, "0"), F.lit("/"), "o_orderstatus", F.lit(" x"))
        return c("o_orderkey"), code.alias("code"), F.lit(number).alias("number")

    orders = testbed.table(spark, sf, "orders")
    tables.upsert_table(orders.select(*at(0, "007")), path, ["o_orderkey"], ["number", "code"])
    tables.upsert_table(orders.filter("o_orderkey % 7 = 0").select(*at(1, "008")), path, ["o_orderkey"], ["number", "code"])
    return spark.read.schema(schema).parquet(path).select("o_orderkey", "code", "number")


@query(
    "upsert_wider_target",
    with_(FX, body="""SELECT fixture_id, season, CASE WHEN fixture_id%3=0 THEN 'NEW' ELSE status END AS status, round,
  CASE WHEN fixture_id%3=0 THEN 'b' END AS added FROM fx
UNION ALL SELECT fixture_id+1000000000, season, 'NEW', NULL, 'b' FROM fx WHERE fixture_id%3=0"""),
)
def upsert_wider_target(spark, sf):
    """The source lacks a column of the target, which stays, and brings a new one."""
    path = scratch_path(spark, "wider")
    target = testbed.fixtures(spark, sf).select("fixture_id", "season", "status", "round")
    tables.upsert_table(target, path, ["fixture_id"], ["season"])
    changed = target.filter("fixture_id % 3 = 0").select("fixture_id", "season", F.lit("NEW").alias("status"), F.lit("b").alias("added"))
    new = changed.withColumn("fixture_id", c("fixture_id") + 1000000000)
    tables.upsert_table(changed.unionByName(new), path, ["fixture_id"], ["season"])
    return spark.read.option("mergeSchema", "true").parquet(path).select("fixture_id", "season", "status", "round", "added")


@query(
    "upsert_older_version",
    with_(FX, body="SELECT fixture_id, CASE WHEN fixture_id%2=0 THEN season ELSE season+1 END AS season, CASE WHEN fixture_id%2=0 THEN 5 ELSE 3 END AS version FROM fx"),
)
def upsert_older_version(spark, sf):
    """Even fixtures are at version 5 and odd ones at 2; a load of version 3 replaces the odd ones only."""
    path = scratch_path(spark, "older")
    rows = testbed.fixtures(spark, sf).select("fixture_id", "season", F.when(c("fixture_id") % 2 == 0, 5).otherwise(2).alias("version"))
    tables.upsert_table(rows, path, ["fixture_id"], ["season"], version="version")
    late = rows.withColumns({"season": c("season") + 1, "version": F.lit(3)})
    tables.upsert_table(late, path, ["fixture_id"], ["season"], version="version")
    return spark.read.parquet(path).select("fixture_id", "season", "version")


@query("upsert_duplicate_source", with_(FX, body="SELECT fixture_id, status, true AS rejected FROM fx"))
def upsert_duplicate_source(spark, sf):
    """A source with two rows for one key is rejected and the table stays as it was."""
    path = scratch_path(spark, "twice")
    rows = testbed.fixtures(spark, sf).select("fixture_id", "status")
    tables.upsert_table(rows, path, ["fixture_id"])
    rejected = False
    try:
        tables.upsert_table(rows.withColumn("status", F.explode(F.array(F.lit("A"), F.lit("B")))), path, ["fixture_id"])
    except ValueError:
        rejected = True
    return spark.read.parquet(path).select("fixture_id", "status", F.lit(rejected).alias("rejected"))


@query(
    "overwrite_partitions",
    with_(FX, body="""SELECT fixture_id, season, CASE WHEN season=1999 THEN 'REDONE' ELSE status END AS status FROM fx WHERE season<>1999 OR fixture_id%2=0"""),
)
def overwrite_partitions(spark, sf):
    path = scratch_path(spark, "overwrite")
    rows = testbed.fixtures(spark, sf).select("fixture_id", "status", "season")
    tables.overwrite_partitions(rows, path, ["season"])
    redone = rows.filter((c("season") == 1999) & (c("fixture_id") % 2 == 0)).withColumn("status", F.lit("REDONE"))
    tables.overwrite_partitions(redone, path, ["season"])
    return spark.read.parquet(path).select("fixture_id", "season", "status")


@query("expire_partitions", "SELECT event_id, CAST(ts AS DATE) AS day FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-11'")
def expire_partitions(spark, sf):
    path = scratch_path(spark, "expire")
    rows = testbed.table(spark, sf, "events").select("event_id", c("ts").cast("date").alias("day"))
    tables.append_table(rows, path, ["day"])
    tables.expire_partitions(spark, path, "day", 30, dt.date(2024, 2, 10))
    return spark.read.parquet(path).select("event_id", "day")


@query("publish_predictions", with_(FX, PREDS, body="SELECT fixture_id, predicted_result, model_version FROM p"))
def publish_predictions(spark, sf):
    root = scratch_path(spark, "serving")
    rows = testbed.predictions(spark, sf).select("fixture_id", "predicted_result", "model_version", "season")
    for version in (rows.withColumn("predicted_result", F.lit("?")), rows):
        tables.publish(version, root, "match_predictions", ["fixture_id"], ["season"])
    return spark.read.parquet(f"{root}/match_predictions").drop("season")


@query("zorder_compact", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL")
def zorder_compact(spark, sf):
    """The rewritten table holds the same rows."""
    path, out = scratch_path(spark, "flat"), scratch_path(spark, "zorder")
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    testbed.table(spark, sf, "lineitem").select(*keys).write.parquet(path)
    tables.compact_table(spark, path, out, ["l_orderkey", "l_partkey"], file_bytes=128 << 10)
    return spark.read.parquet(out).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@query(
    "layout_job",
    """SELECT 'lineitem' AS table_name, 'success' AS status, count(*) AS n_rows FROM lineitem
UNION ALL SELECT 'orders', 'success', count(*) FROM orders UNION ALL SELECT 'absent', 'skipped', NULL""",
)
def layout_job(spark, sf):
    """Listed tables rewritten, with the rows read back from the new files."""
    out, listed = scratch_path(spark, "layout"), {
        "lineitem": (f"{sf}/lineitem.parquet", ["l_orderkey", "l_suppkey"]),
        "orders": (f"{sf}/orders.parquet", ["o_orderkey"]),
        "absent": (f"{sf}/absent.parquet", ["x"]),
    }
    report = tables.layout_job(spark, listed, out).drop("message")
    counts = [
        spark.read.parquet(f"{out}/{name}").agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        for name in ("lineitem", "orders")
    ]
    return report.join(counts[0].unionByName(counts[1]), "table_name", "left")


@query(
    "audit_summary",
    """SELECT 'run-' || (user_id%50) AS run_id, count(*) AS steps, count(*) FILTER (WHERE event_type='error') AS failed_steps,
  CAST(sum(CAST(json_extract(props,'$.k') AS INTEGER)) AS BIGINT) AS rows_affected, CAST(sum(event_id%1000) AS BIGINT) AS duration_ms
FROM events GROUP BY 1""",
)
def audit_summary(spark, sf):
    log = testbed.table(spark, sf, "events").select(
        F.concat(F.lit("run-"), c("user_id") % 50).alias("run_id"),
        F.when(c("event_type") == "error", "failed").otherwise("success").alias("status"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("rows_affected"),
        (c("event_id") % 1000).alias("duration_ms"),
    )
    return tables.audit_summary(log)


@query("run_step_audit", with_(FX, body="SELECT 'load_fixtures' AS step, 'success' AS status, count(*) AS rows_affected FROM fx"))
def run_step_audit(spark, sf):
    """A landed load counted while it is written, and its audit row."""
    root = scratch_path(spark, "step")
    tables.run_step(
        spark,
        "load_fixtures",
        "r1",
        testbed.raw_fixtures(spark, sf),
        silver.fixtures,
        lambda d: tables.upsert_table(d, f"{root}/fixtures", ["fixture_id"], ["season"]),
        f"{root}/audit",
    )
    return spark.read.parquet(f"{root}/audit").select("step", "status", "rows_affected")


@query(
    "dedup_tables",
    with_(QUOTES, body="""SELECT 'odds' AS table_name, count(*) AS kept, CAST(sum(n)-count(*) AS BIGINT) AS removed
  FROM (SELECT count(*) AS n FROM q GROUP BY fixture_id, bookmaker_id, outcome)
UNION ALL SELECT 'injuries', count(*), CAST(sum(n)-count(*) AS BIGINT) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey)"""),
)
def dedup_tables(spark, sf):
    """Each listed table keeps its latest row per key by load time."""
    lines = testbed.table(spark, sf, "lineitem").withColumnRenamed("l_shipdate", "_loaded_at")
    kept, report = quality.dedup_tables({
        "odds": (testbed.quotes(spark, sf).withColumnRenamed("day", "_loaded_at"), ["fixture_id", "bookmaker_id", "outcome"], ["_loaded_at"]),
        "injuries": (lines, ["l_orderkey", "l_partkey"], ["_loaded_at"]),
    })
    counts = [rows.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("kept")) for n, rows in kept.items()]
    return report.drop("kept").join(counts[0].unionByName(counts[1]), "table_name")


_RAW = {
    "fixtures": testbed.raw_fixtures,
    "statistics": testbed.raw_statistics,
    "events": testbed.raw_events,
    "odds": testbed.raw_odds,
    "standings": testbed.raw_standings,
    "injuries": testbed.raw_injuries,
}


_BUILT = ("fixtures", "match_statistics", "match_events", "odds_long", "standings", "injuries")

_OTHER = {
    "lineups": ("lineups", testbed.raw_lineups),
    "player_stats": ("players_stats", testbed.raw_player_stats),
    "api_predictions": ("predictions", testbed.raw_api_predictions),
    "teams": ("teams", testbed.raw_teams),
    "leagues": ("leagues", testbed.raw_leagues),
    "players": ("players", testbed.raw_players),
    "transfers": ("transfers", testbed.raw_transfers),
}


@query(
    "load_and_build_tables",
    with_(
        TEAMS,
        QUOTES,
        body="""SELECT 'fixtures' AS table_name, count(*) AS n_rows FROM fx
UNION ALL SELECT 'match_statistics', count(*) FROM pr
UNION ALL SELECT 'match_events', CAST(sum(fixture_id%4) AS BIGINT) FROM fx WHERE status='FT'
UNION ALL SELECT 'odds_long', 2*(SELECT count(*) FROM (SELECT DISTINCT fixture_id, bookmaker_id, outcome FROM q))
  + 2*(SELECT count(*) FROM (SELECT DISTINCT fixture_id, bookmaker_id FROM q))
UNION ALL SELECT 'standings', count(*) FROM (SELECT DISTINCT league_id, season, team_id FROM pr)
UNION ALL SELECT 'injuries', count(*) FROM (SELECT DISTINCT fixture_id, CASE WHEN l_linenumber%2=0 THEN home_team_id ELSE away_team_id END, l_partkey%25
  FROM lineitem JOIN fx ON l_orderkey=fixture_id WHERE l_returnflag='R')
UNION ALL SELECT 'league_summary', count(*) FROM (SELECT DISTINCT league_id, season FROM fx)
UNION ALL SELECT 'team_form', count(*) FROM pr
UNION ALL SELECT 'head_to_head', 2*count(*) FROM (SELECT DISTINCT league_id, least(home_team_id,away_team_id), greatest(home_team_id,away_team_id) FROM fx WHERE result IS NOT NULL)""",
    ),
)
def load_and_build_tables(spark, sf):
    """Raw feeds landed, every typed table loaded, one of them again, marts built; rows per table.

    Unpartitioned here: the test data has a handful of rows for each of 2,400 days.
    """
    root = scratch_path(spark, "lifecycle")
    for feed, make in _RAW.items():
        tables.append_table(make(spark, sf), f"{root}/bronze/{feed}")
    lifecycle.load_all(spark, root, "r1", partitioned=False)
    lifecycle.load_table(spark, root, "match_events", "r2", dt.date(1990, 1, 1), partitioned=False)
    lifecycle.build_marts(spark, root, "r2")
    out = None
    for layer, name in [*[("silver", n) for n in _BUILT], *[("gold", n) for n in ("league_summary", "team_form", "head_to_head")]]:
        counts = spark.read.parquet(f"{root}/{layer}/{name}").agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows")
        )
        out = counts if out is None else out.unionByName(counts)
    return out


def _typed_rows(name: str, typed: str) -> str:
    """Rows of a typed table, counted by the SQL of its own query."""
    return f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM ({ORACLES[typed]})"


@query(
    "load_other_feeds",
    " UNION ALL ".join(_typed_rows(n, f"silver_{n}") for n in ("lineups", "player_stats", "api_predictions", "teams", "leagues", "players", "transfers")),
)
def load_other_feeds(spark, sf):
    """Lineups, player statistics, predictions and the four reference feeds, landed and loaded twice; rows per table.

    Unpartitioned like ``load_and_build_tables``: the test data has a handful of rows for each of 2,400 days."""
    root = scratch_path(spark, "feeds")
    testbed.fixtures(spark, sf).select("fixture_id", "match_date").write.parquet(f"{root}/silver/fixtures")
    out = None
    for name, (feed, make) in _OTHER.items():
        tables.append_table(make(spark, sf), f"{root}/bronze/{feed}")
        for run in ("r1", "r2"):  # the second finds no unread batch
            lifecycle.load_table(spark, root, name, run, partitioned=False)
        counts = spark.read.parquet(f"{root}/silver/{name}").agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        out = counts if out is None else out.unionByName(counts)
    return out


@query(
    "publish_serving",
    with_(TEAMS, SEASONS, PREDS, body="""SELECT 'match_predictions' AS table_name, count(*) AS n_rows, CAST(sum(fixture_id) AS BIGINT) AS key_sum FROM p
UNION ALL SELECT 'historical_predictions', 2*count(*), CAST(2*sum(fixture_id) AS BIGINT) FROM p
UNION ALL SELECT 'league_standings', count(*), CAST(sum(team_id*1000+position*10+season%10) AS BIGINT) FROM st
UNION ALL SELECT 'team_form', count(*), CAST(sum(fixture_id) AS BIGINT) FROM (SELECT * FROM pr QUALIFY row_number() OVER (PARTITION BY team_id ORDER BY match_date DESC, fixture_id DESC)=1)
UNION ALL SELECT 'upcoming_fixtures', count(*), CAST(sum(fixture_id) AS BIGINT) FROM fx WHERE match_date>=DATE '1998-06-15' AND result IS NULL"""),
)
def publish_serving(spark, sf):
    """Published twice: served tables hold one row per key, the history both versions."""
    root, day = scratch_path(spark, "serving"), F.make_date(F.lit(1998), F.lit(6), F.lit(15))
    testbed.fixtures(spark, sf).write.parquet(f"{root}/silver/fixtures")
    standings = testbed.season_standings(spark, sf)
    for version in ("v1", "v2"):
        lifecycle.publish_all(spark, root, standings, testbed.predictions(spark, sf).withColumn("model_version", F.lit(version)), day)
    keys = {
        "match_predictions": c("fixture_id"), "historical_predictions": c("fixture_id"), "team_form": c("fixture_id"),
        "upcoming_fixtures": c("fixture_id"), "league_standings": c("team_id") * 1000 + c("position") * 10 + c("season") % 10,
    }
    out = None
    for name, key in keys.items():
        row = spark.read.parquet(f"{root}/serving/{name}").agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.sum(key.cast("bigint")).alias("key_sum")
        )
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "expire_tables",
    with_(FX, body="""SELECT 'fixtures' AS table_name, count(*) AS left_rows FROM fx WHERE match_date >= DATE '1998-03-31' - 60
UNION ALL SELECT 'league_summary', count(*) FROM (SELECT DISTINCT league_id, season FROM fx WHERE make_date(season, 12, 31) >= DATE '1998-03-31' - 90)"""),
)
def expire_tables(spark, sf):
    """Typed tables keep 60 days and marts 90, by their specs: days older go, and seasons that ended before that."""
    root = scratch_path(spark, "expiry")
    fixtures = testbed.fixtures(spark, sf)
    tables.append_table(fixtures.select("fixture_id", "match_date"), f"{root}/silver/fixtures", ["match_date"])
    tables.append_table(fixtures.select("league_id", "season").distinct(), f"{root}/gold/league_summary", ["season"])
    lifecycle.expire_tables(spark, root, dt.date(1998, 3, 31))
    out = None
    for layer, name in (("silver", "fixtures"), ("gold", "league_summary")):
        row = spark.read.parquet(f"{root}/{layer}/{name}").agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("left_rows"))
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "table_statistics",
    """SELECT 'o_orderkey' AS column_name, count(*) AS n_rows, count(*)-count(o_orderkey) AS n_nulls, true AS distinct_close, CAST(min(o_orderkey) AS VARCHAR) AS min, CAST(max(o_orderkey) AS VARCHAR) AS max FROM orders
UNION ALL SELECT 'o_custkey', count(*), count(*)-count(o_custkey), true, CAST(min(o_custkey) AS VARCHAR), CAST(max(o_custkey) AS VARCHAR) FROM orders
UNION ALL SELECT 'o_orderstatus', count(*), count(*)-count(o_orderstatus), true, NULL, NULL FROM orders""",
)
def table_statistics(spark, sf):
    """A stored table analysed, its statistics read back from the catalog; distinct counts are sketches, so they are only
    held to a tenth of the exact ones."""
    columns = ["o_orderkey", "o_custkey", "o_orderstatus"]
    rows = testbed.table(spark, sf, "orders").select(*columns)
    name = f"statistics_{uuid.uuid4().hex[:8]}"
    rows.write.option("path", scratch_path(spark, "statistics")).saveAsTable(name)
    tables.analyze_table(spark, name, columns)
    found = tables.table_statistics(spark, name, columns)
    spark.sql(f"DROP TABLE {name}")
    exact = rows.select(*[F.count_distinct(n).alias(n) for n in columns])
    exact = exact.select(F.inline(F.array(*[F.struct(F.lit(n).alias("column_name"), c(n).alias("exact")) for n in columns])))
    return found.join(exact, "column_name").select(
        "column_name", "n_rows", "n_nulls", (F.abs(c("n_distinct") - c("exact")) <= c("exact") * 0.1).alias("distinct_close"), "min", "max"
    )


@query("load_late_rows", with_(FX, body="SELECT fixture_id, status, season FROM fx"))
def load_late_rows(spark, sf):
    """Even fixtures land after the odd ones were loaded, for the same days; the next load reads them."""
    root, raw = scratch_path(spark, "late"), testbed.raw_fixtures(spark, sf)
    odd = F.get_json_object("payload", "$.fixture.id").cast("bigint") % 2
    for number, batch in ((1, "b1"), (0, "b2")):
        tables.append_table(raw.filter(odd == number).withColumn("_batch_id", F.lit(batch)), f"{root}/bronze/fixtures")
        lifecycle.load_table(spark, root, "fixtures", batch)
    return spark.read.parquet(f"{root}/silver/fixtures").select("fixture_id", "status", "season")


@query(
    "load_rejects",
    with_(FX, body="""SELECT CASE WHEN fixture_id%5=0 THEN 'malformed' WHEN fixture_id%7=0 THEN 'no_fields' ELSE 'null_key' END AS reason,
  2*count(*) AS n FROM fx WHERE fixture_id%5=0 OR fixture_id%7=0 OR fixture_id%11=0 GROUP BY 1
UNION ALL SELECT 'loaded', count(*) FROM fx WHERE fixture_id%5<>0 AND fixture_id%7<>0 AND fixture_id%11<>0"""),
)
def load_rejects(spark, sf):
    """Raw rows cut short, of another shape and without an id end in the reject table; the others are loaded."""
    root, key = scratch_path(spark, "rejects"), F.get_json_object("payload", "$.fixture.id").cast("bigint")
    raw = testbed.raw_fixtures(spark, sf).withColumn("k", key)
    broken = (
        F.when(c("k") % 5 == 0, F.substring("payload", 1, 40))
        .when(c("k") % 7 == 0, F.lit('{"other": 1}'))
        .when(c("k") % 11 == 0, F.regexp_replace("payload", '"id":[0-9]+,"date"', '"id":null,"date"'))
        .otherwise(c("payload"))
    )
    tables.append_table(raw.withColumn("payload", broken).drop("k"), f"{root}/bronze/fixtures")
    lifecycle.load_table(spark, root, "fixtures", "r1")
    rejects = spark.read.parquet(f"{root}/rejects/fixtures").groupBy(c("_reject_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    loaded = spark.read.parquet(f"{root}/silver/fixtures").agg(F.lit("loaded").alias("reason"), F.count(F.lit(1)).alias("n"))
    return rejects.unionByName(loaded)


# --- kept histories -------------------------------------------------------------------------------

_SNAPSHOT_DAYS = (dt.date(1993, 6, 30), dt.date(1993, 9, 30), dt.date(1996, 12, 31), dt.date(1998, 7, 31))
_STANDINGS_KEPT = "league_id BIGINT, season INT, team_id BIGINT, position INT, points INT, form STRING"
_DAYS = "dy AS (SELECT unnest([" + ", ".join(f"DATE '{d}'" for d in _SNAPSHOT_DAYS) + "]) AS day)"


def _versions(keys: str, checked: str) -> str:
    """Intervals of the snapshots in ``sd``: a version begins where a checked column differs from the snapshot before."""
    differs = " OR ".join(f"{n} IS DISTINCT FROM lag({n}) OVER w" for n in checked.split(", "))
    return f"""SELECT {keys}, {checked}, day AS valid_from, lead(day) OVER w AS valid_to, lead(day) OVER w IS NULL AS is_current
FROM (SELECT * FROM sd WINDOW w AS (PARTITION BY {keys} ORDER BY day) QUALIFY row_number() OVER w = 1 OR {differs})
WINDOW w AS (PARTITION BY {keys} ORDER BY day)"""


@query(
    "standings_history",
    with_(
        TEAMS,
        _DAYS,
        """
fo AS (SELECT *, string_agg(outcome, '') OVER (PARTITION BY team_id ORDER BY match_date, fixture_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS f FROM pr),
sn AS (SELECT day, league_id, season, team_id, arg_max(f, (match_date, fixture_id)) AS form, sum(goals_for) AS gf, sum(goals_for)-sum(goals_against) AS gd,
  CAST(sum(CASE outcome WHEN 'W' THEN 3 WHEN 'D' THEN 1 ELSE 0 END) AS INTEGER) AS points FROM fo JOIN dy ON match_date<=day GROUP BY ALL),
sd AS (SELECT *, CAST(row_number() OVER (PARTITION BY day, league_id, season ORDER BY points DESC, gd DESC, gf DESC, team_id) AS INTEGER) AS position FROM sn)""",
        body=_versions("league_id, season, team_id", "position, points, form"),
    ),
)
def standings_history(spark, sf):
    """Tables of every season as known on four days, kept in the history table; the last day is loaded twice."""
    root, rows = scratch_path(spark, "history"), marts.team_form(testbed.fixtures(spark, sf))
    rows = stored(rows.select(*_STANDING_COLUMNS), "played")
    for day in (*_SNAPSHOT_DAYS, _SNAPSHOT_DAYS[-1]):
        lifecycle.keep_history(spark, root, day, standings=marts.standings_on(rows, day))
    return histories.read_history(spark, f"{root}/history/standings", T.StructType.fromDDL(_STANDINGS_KEPT))


@query(
    "strength_history",
    with_(
        FX,
        queries_marts._ELO,
        _DAYS,
        """
tg AS (SELECT pool*100+x AS team_id, fixture_id, rating FROM (
    SELECT e.pool, e.fixture_id, n.h AS x, round(hb+g) AS rating FROM e JOIN n ON n.pool=e.pool AND n.i=e.i WHERE e.i>0
    UNION ALL SELECT e.pool, e.fixture_id, n.a, round(ab-g) FROM e JOIN n ON n.pool=e.pool AND n.i=e.i WHERE e.i>0)),
sd AS (SELECT day, team_id, CAST(arg_max(rating, (match_date, fixture_id)) AS INTEGER) AS elo_rating
  FROM tg JOIN fx USING (fixture_id) JOIN dy ON match_date<=day GROUP BY ALL)""",
        body=_versions("team_id", "elo_rating"),
    ),
)
def strength_history(spark, sf):
    """Ratings as known on four days, kept in the history table."""
    root, rated = scratch_path(spark, "history"), elo.elo_ratings(testbed.fixtures(spark, sf))
    for day in _SNAPSHOT_DAYS:
        strength = elo.current_ratings(rated.filter(c("match_date") <= F.lit(day)))
        lifecycle.keep_history(spark, root, day, strength=strength)
    kept = T.StructType.fromDDL("pool BIGINT, team_id BIGINT, elo_rating INT")
    return histories.read_history(spark, f"{root}/history/team_strength", kept).drop("pool")


# --- streams --------------------------------------------------------------------------------------


@query("stream_upsert", with_(FX, body="SELECT fixture_id, status, result, season FROM fx"))
def stream_upsert(spark, sf):
    """Each landing of every fixture arrives in a micro-batch of its own, the newest first; the final state remains.

    The stream is stopped after each landing and goes on from its checkpoint, so a landing may be any number of files."""
    root = scratch_path(spark, "stream")
    raw = testbed.raw_fixtures(spark, sf)
    landing_no = F.date_diff("_ingestion_date", F.to_date(F.get_json_object("payload", "$.fixture.date")))

    def transform(batch):
        return silver.fixtures(batch).select("fixture_id", "status", "result", "season", "match_ts", "_ingestion_ts")

    for number in (2, 1):
        raw.filter(landing_no == number).write.mode("append").parquet(f"{root}/raw")
        live.stream_upsert(
            live.raw_stream(spark, f"{root}/raw"), transform, f"{root}/fixtures", ["fixture_id"], f"{root}/checkpoint",
            ["season"], "_ingestion_ts",
        ).awaitTermination()
    return spark.read.parquet(f"{root}/fixtures").select("fixture_id", "status", "result", "season")


@query("stream_ratings", queries_marts._RATED)
def stream_ratings(spark, sf):
    """Matches arrive in three landings; the stream is stopped after each and goes on from its checkpoint."""
    root, fixtures = scratch_path(spark, "stream-ratings"), testbed.fixtures(spark, sf)
    cuts = [dt.date(1900, 1, 1), dt.date(1994, 7, 1), dt.date(1996, 7, 1), dt.date(2100, 1, 1)]
    for begin, end in zip(cuts, cuts[1:], strict=False):
        fixtures.filter((c("match_date") >= F.lit(begin)) & (c("match_date") < F.lit(end))).write.mode("append").parquet(f"{root}/landed")
        stream = live.raw_stream(spark, f"{root}/landed", fixtures.schema)
        live.run_to_table(elo.elo_stream(stream), f"{root}/rated", f"{root}/checkpoint")
    return queries_marts._rated(spark.read.parquet(f"{root}/rated").filter(~c("late")))


def _event_stream(spark, sf, root):
    rows = testbed.table(spark, sf, "events").select("event_id", "user_id", c("ts").cast("timestamp").alias("ts"), "event_type", "value")
    rows.write.parquet(f"{root}/events")
    return spark.readStream.schema(rows.schema).parquet(f"{root}/events")


@query("stream_dedup", "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_dedup(spark, sf):
    """Every event arrives twice; one copy per id goes through."""
    root = scratch_path(spark, "stream-dedup")
    stream = _event_stream(spark, sf, root)
    twice = stream.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    live.run_to_table(live.stream_dedup(twice, ["event_id"], "ts", "40 days"), f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "stream_odds_windows",
    """SELECT CAST(floor(epoch(ts)/3600) AS BIGINT)*3600 AS window_epoch, event_type, arg_max(value, (ts, event_id)) AS last_odd,
  min(value) AS min_odd, max(value) AS max_odd, round(avg(value),4) AS avg_odd, count(*) AS quotes FROM events
WHERE floor(epoch(ts)/3600)*3600+3600 <= (SELECT max(epoch(ts)) FROM events) - 600
GROUP BY 1, 2""",
)
def stream_odds_windows(spark, sf):
    """Hourly price windows over the event stream; windows still open at the end are not emitted."""
    root = scratch_path(spark, "stream-odds")
    stream = _event_stream(spark, sf, root)
    windows = live.odds_windows(stream, ["event_type"], "ts", "value", "1 hour", "10 minutes", ["event_id"])
    live.run_to_table(windows, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out").select(
        F.unix_timestamp("window_start").alias("window_epoch"),
        "event_type",
        "last_odd",
        "min_odd",
        "max_odd",
        F.round("avg_odd", 4).alias("avg_odd"),
        "quotes",
    )


@query(
    "odds_windows_batch",
    """SELECT CAST(floor(epoch(ts)/300) AS BIGINT)*300 AS window_epoch, event_type, arg_max(value, (ts, event_id)) AS last_odd,
  min(value) AS min_odd, max(value) AS max_odd, count(*) AS quotes FROM events GROUP BY 1, 2""",
)
def odds_windows_batch(spark, sf):
    rows = testbed.table(spark, sf, "events").select("event_id", c("ts").cast("timestamp").alias("ts"), "event_type", "value")
    return live.odds_windows(rows, ["event_type"], "ts", "value", order=["event_id"]).select(
        F.unix_timestamp("window_start").alias("window_epoch"), "event_type", "last_odd", "min_odd", "max_odd", "quotes"
    )
