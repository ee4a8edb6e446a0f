"""Landing of raw records and planning of requests."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators.flatten import parse_payload
from touchline.operators.ordered import global_row_number
from touchline.schemas import FEEDS, MARKETS, RECORD_IDS


def land_raw(
    bodies: DataFrame,
    feed: str,
    batch_id: str,
    shape: str = "envelope",
    at: Column | None = None,
    body: str = "body",
) -> DataFrame:
    """Response bodies to raw rows: one JSON string per record plus load metadata.

    ``shape="envelope"``: the body is ``{"parameters": …, "response": [records]}``; the parameters
    are kept beside every record, because some records carry no id of their own.
    ``shape="record"``: the body is one record.
    """
    spec = FEEDS[feed]
    at = F.current_timestamp() if at is None else at
    if shape == "envelope":
        parsed = parse_payload(bodies.select(body), "parameters STRING, response ARRAY<STRING>", body)
        # A body without a response list is kept as it came, so that the load can reject it with a reason.
        records = F.coalesce(F.col("rec.response"), F.array(F.col(body)))
        rows = parsed.select(F.col("rec.parameters").alias("params"), F.explode(records).alias("payload"))
    elif shape == "record":
        rows = bodies.select(F.lit(None).cast("string").alias("params"), F.col(body).alias("payload"))
    else:
        raise ValueError(f"unknown shape {shape!r}")
    return rows.select(
        "payload",
        F.lit(spec.endpoint).alias("endpoint"),
        "params",
        at.cast("date").alias("_ingestion_date"),
        at.alias("_ingestion_ts"),
        F.lit(batch_id).alias("_batch_id"),
        F.lit(spec.endpoint).alias("_source_endpoint"),
    )


def mark_raw(raw: DataFrame, feed: str) -> DataFrame:
    """Raw rows with their parsed ``rec`` and ``_reject_reason``, NULL where a load can use the row: malformed JSON, a record
    with none of the feed's fields, or one without the feed's id.

    A usable row is parsed once: only where that parse failed, or found no id, is the text searched again.
    """
    spec = FEEDS[feed]
    strict = {"columnNameOfCorruptRecord": "_unparsed", "allowNonNumericNumbers": "false"}
    record = F.from_json("payload", f"{spec.schema}, _unparsed STRING", strict)
    parsed = raw.withColumn("rec", F.explode(F.array(record)))
    fields = [f.name for f in parsed.schema["rec"].dataType if f.name != "_unparsed"]
    empty = reduce(lambda a, b: a & b, [F.col("rec").getField(f).isNull() for f in fields])
    failed = F.col("rec").isNull() | F.col("rec._unparsed").isNotNull()
    id_path = RECORD_IDS.get(feed)
    missing = F.lit(False)
    if id_path:
        # An id of another type than the schema's is no missing one.
        missing = F.col(f"rec{id_path[1:]}").isNull() & F.get_json_object("payload", id_path).isNull()
    reason = (
        F.when(failed & F.get_json_object("payload", "$").isNull(), "malformed")
        .when(F.col("rec").isNotNull() & empty, "no_fields")
        .when(missing, "null_key")
    )
    return parsed.withColumn("_reject_reason", reason)


def split_raw(raw: DataFrame, feed: str) -> tuple[DataFrame, DataFrame]:
    """Raw rows that a load can use, and the others with ``_reject_reason``, see :func:`mark_raw`."""
    marked = mark_raw(raw, feed).drop("rec")
    return marked.filter("_reject_reason IS NULL").drop("_reject_reason"), marked.filter("_reject_reason IS NOT NULL")


def read_bodies(spark: SparkSession, path: str, format: str = "json", schema: str | None = None) -> DataFrame:
    """Landed files as a ``body`` column.

    ``json``: one response per file. ``jsonl``: one per line. ``csv`` and ``parquet``: one record per
    row, turned into JSON (use ``shape="record"``).
    """
    if format in ("json", "jsonl"):
        return spark.read.text(path, wholetext=format == "json").withColumnRenamed("value", "body")
    reader = spark.read if schema is None else spark.read.schema(schema)
    if format == "csv":
        rows = reader.option("header", True).csv(path)
    elif format == "parquet":
        rows = reader.parquet(path)
    else:
        raise ValueError(f"unknown format {format!r}")
    return rows.select(F.to_json(F.struct("*")).alias("body"))


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A lookup table from CSV with a declared schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def scan_since(df: DataFrame, since: dt.date | Column | None = None, column: str = "_ingestion_date") -> DataFrame:
    """Rows from ``since`` on: a typed comparison on the bare partition column, so it prunes."""
    if since is None:
        return df
    bound = since if isinstance(since, Column) else F.lit(since)
    return df.filter(F.col(column) >= bound)


def high_water_mark(df: DataFrame, column: str = "_ingestion_date") -> dt.date | None:
    """Newest value of ``column`` in the target, or None when it is empty."""
    return df.agg(F.max(column)).first()[0]


def date_window(
    mode: str, start: dt.date | None = None, end: dt.date | None = None, today: dt.date | None = None
) -> tuple[dt.date, dt.date]:
    """incremental: yesterday to today; backfill: both bounds required."""
    if mode == "incremental":
        today = today or dt.datetime.now(dt.UTC).date()
        return today - dt.timedelta(days=1), today
    if mode == "backfill":
        if start is None or end is None:
            raise ValueError("backfill needs both start and end")
        if start > end:
            raise ValueError("start is after end")
        return start, end
    raise ValueError(f"unknown mode {mode!r}")


def in_window(df: DataFrame, window: tuple[dt.date, dt.date], column: str = "match_date") -> DataFrame:
    """Rows of a closed date window."""
    return df.filter(F.col(column).between(*[F.lit(d) for d in window]))


def plan_requests(
    fixtures: DataFrame, markets: Sequence[int] = tuple(MARKETS), already: DataFrame | None = None
) -> DataFrame:
    """One request per fixture and market, without those ``already(fixture_id, bet_id)`` landed.

    The markets are a literal array, so the product needs no join.
    """
    wanted = fixtures.select("fixture_id", F.explode(F.array(*[F.lit(m) for m in markets])).alias("bet_id"))
    return wanted if already is None else wanted.join(already, ["fixture_id", "bet_id"], "left_anti")


def batch_keys(df: DataFrame, key: str, size: int = 20, sep: str = "-") -> DataFrame:
    """Distinct integer keys packed into full batches of ``size``: ``batch_no, n_keys, ids``.

    Numbered over range partitions, so neither the sort nor a batch grows with the table, and sparse keys make no more
    ranges than dense ones.
    """
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    return (
        global_row_number(keys, [key])
        .groupBy(F.floor((F.col("row_no") - 1) / F.lit(size)).cast("bigint").alias("batch_no"))
        .agg(F.count(F.lit(1)).alias("n_keys"), F.sort_array(F.collect_list(key)).alias("_ids"))
        .select("batch_no", "n_keys", F.array_join("_ids", sep).alias("ids"))
    )


def latest_coverage(leagues: DataFrame, seasons: str = "seasons") -> DataFrame:
    """Coverage struct of the last listed season (NULL when there is none)."""
    return leagues.withColumn("coverage", F.try_element_at(seasons, F.lit(-1))["coverage"])
