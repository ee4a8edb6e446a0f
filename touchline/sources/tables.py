"""Parquet tables: append, upsert, overwrite, expiry, layout and audit."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.session import drop_stored, stored


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, location = _path(spark, path)
    return fs.exists(location) and len(fs.listStatus(location)) > 0


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append; rows of one partition value are spread over several tasks only as AQE sees fit."""
    _write(df, path, partition_by, "append")


append_history = append_table


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace exactly the partitions that occur in ``df``."""
    _write(df, path, partition_by, "overwrite")


def _write(df: DataFrame, path: str, partition_by: Sequence[str], mode: str) -> None:
    # REBALANCE gathers each partition value into few files and splits a skewed one.
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def _same(a: str, b: str, cols: Sequence[str], null_safe: bool = True) -> Column:
    """Equality of ``cols`` between two aliased frames."""
    pairs = [(F.col(f"{a}.{c}"), F.col(f"{b}.{c}")) for c in cols]
    return reduce(lambda x, y: x & y, [left.eqNullSafe(right) if null_safe else left == right for left, right in pairs])


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """Target rows without a match, plus all source rows. The source must be unique by key."""
    t, s = target.alias("t"), source.select(*keys).alias("s")
    return t.join(s, _same("t", "s", keys, null_safe), "left_anti").unionByName(source)


def reject_duplicates(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise when two rows share a key: which of them should win is not defined.

    Keys are compared only where their hashes are not distinct.
    """
    hashes = source.groupBy(F.xxhash64(*keys)).agg(F.count(F.lit(1)).alias("_n"))
    if hashes.filter("_n > 1").isEmpty():
        return
    twice = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys).take(1)
    if twice:
        raise ValueError(f"the source has several rows for key {twice[0].asDict()}")


def _read_as(path: str, source: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The target with the source's partition types (no guessing from directory names) and the columns of both."""
    spark = source.sparkSession
    known = spark.read.parquet(path).schema
    kinds = {f.name: source.schema[f.name].dataType if f.name in partition_by else f.dataType for f in known}
    kinds |= {f.name: f.dataType for f in source.schema if f.name not in kinds}
    return spark.read.schema(T.StructType([T.StructField(n, k) for n, k in kinds.items()])).parquet(path)


def upsert_table(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    null_safe: bool = True,
    version: str | None = None,
    within: Column | None = None,
) -> None:
    """Upsert into a parquet table; the first load creates it.

    Only the touched partitions are rewritten: those of the source rows and those where matched rows live now, so a row
    whose partition value changes leaves no old copy. Two source rows with one key are rejected. Columns that only the
    target has keep their values in updated rows and are NULL in new ones; columns that only the source has are added.
    ``version`` names a column by which an older source row never replaces a newer target row. ``within`` is a predicate
    on partition columns that bounds where the source's keys can live; without it the keys of the whole target are read.

    The merged rows are staged in the shared folder before anything is replaced, and running the same source again gives
    the same table. Spark writes an empty text as a NULL partition. A table without partitions is replaced as a whole:
    should that write fail, the staged copy is what to restore.
    """
    spark = source.sparkSession
    source = stored(source, "upsert-source")
    reject_duplicates(source, keys)
    if not table_exists(spark, path):
        if partition_by or not _moved(spark, source, path):
            _write(source, path, partition_by, "overwrite")
            drop_stored(source)
        return
    target = _read_as(path, source, partition_by)
    near = target if within is None else target.filter(within)
    kept = [c for c in target.columns if c not in source.columns]
    old = near.withColumn("_file", F.col("_metadata.file_path")).alias("t")
    old = old.join(source.select(*keys).alias("s"), _same("t", "s", keys, null_safe), "left_semi")
    wanted = dict.fromkeys([*keys, *partition_by, *kept, *([version] if version else []), "_file"])
    old = stored(old.select(*wanted), "upsert-matched")
    rows = source.alias("s").join(
        old.select(*keys, *kept, *([F.col(version).alias("_version")] if version else [])).alias("o"),
        _same("s", "o", keys, null_safe), "left",
    )
    if version:
        rows = rows.filter(F.col("_version").isNull() | (F.col(f"s.{version}") >= F.col("_version")))
    fresh = rows.select(
        *[(F.col(f"o.{c}") if c in kept else F.col(f"s.{c}")).cast(target.schema[c].dataType).alias(c) for c in target.columns]
    )
    if not partition_by:
        done = [_replace(spark, upsert(target, fresh, keys, null_safe), path, ())]
    else:
        # Partition values are as many as the table's directories, which the driver lists anyway; as
        # literals they prune the scan of the target.
        touched = _partition_values(old.select(*partition_by).unionByName(source.select(*partition_by)), partition_by)
        merged = upsert(target.filter(_one_of(touched, partition_by)), fresh, keys, null_safe)
        left = _directories(old, partition_by)
        done = [_replace(spark, merged, path, partition_by)]
        filled = _partition_values(done[0], partition_by)
        _delete(spark, [d for value, d in left if value not in filled])
    for copy in (source, old, *done):
        drop_stored(copy)


def _moved(spark: SparkSession, staged: DataFrame, path: str) -> bool:
    """Whether the files of a stored frame became the table ``path``, which has none yet: a rename within one file system."""
    files = staged.inputFiles()
    if not files:
        return False
    source = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(files[0].rsplit("/", 1)[0]))
    (fs, target), home = _path(spark, path), source.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getUri().toString() != home.getUri().toString():
        return False
    fs.delete(target, True)  # an empty directory would take the files' directory in
    fs.mkdirs(target.getParent())
    return bool(fs.rename(source, target))


def _directories(rows: DataFrame, partition_by: Sequence[str]) -> list[tuple[tuple, str]]:
    """Partition values and the directories that hold them, as the files say (``_file``)."""
    folder = F.regexp_replace("_file", "/[^/]*$", "").alias("_dir")
    return [(tuple(r)[:-1], r["_dir"]) for r in rows.select(*partition_by, folder).distinct().toLocalIterator()]


def _delete(spark: SparkSession, directories: Sequence[str]) -> int:
    """Delete directories given as URIs; returns how many went."""
    gone = 0
    for uri in directories:
        location = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
        gone += bool(location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True))
    return gone


def _partition_values(df: DataFrame, partition_by: Sequence[str]) -> set[tuple]:
    return {tuple(row) for row in df.select(*partition_by).distinct().toLocalIterator()}


def _one_of(values: set[tuple], cols: Sequence[str]) -> Column:
    """Predicate on partition columns that Spark evaluates while listing files."""
    known = [v for v in values if None not in v]
    if len(cols) == 1:
        out = F.col(cols[0]).isin([v[0] for v in known])
    else:
        out = F.lit(False)
        for value in known:
            out = out | reduce(lambda a, b: a & b, [F.col(c) == F.lit(x) for c, x in zip(cols, value, strict=True)])
    for value in values - set(known):
        out = out | reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(x)) for c, x in zip(cols, value, strict=True)])
    return out


def _replace(spark: SparkSession, rows: DataFrame, path: str, partition_by: Sequence[str]) -> DataFrame:
    staged = stored(rows, "upsert-merged")
    _write(staged, path, partition_by, "overwrite")
    return staged


def expired(df: DataFrame, column: str, days: int, today: dt.date) -> DataFrame:
    """Rows older than ``days``."""
    return df.filter(F.col(column) < F.lit(today - dt.timedelta(days=days)))


def expire_partitions(
    spark: SparkSession, path: str, column: str, days: int, today: dt.date, last_day: Column | None = None
) -> int:
    """Drop whole partitions older than ``days``; returns how many went. Reads no data columns.

    ``last_day`` is the last day of a partition where ``column`` is no date itself.
    """
    table = spark.read.parquet(path).withColumn("_day", F.col(column) if last_day is None else last_day)
    old = expired(table.withColumn("_file", F.col("_metadata.file_path")), "_day", days, today)
    return _delete(spark, [directory for _, directory in _directories(old, [column])])


def publish(df: DataFrame, root: str, name: str, keys: Sequence[str], partition_by: Sequence[str] = ()) -> None:
    """Upsert into a served table under ``root``; large ones should be partitioned, so that only touched
    partitions are rewritten."""
    upsert_table(df, f"{root}/{name}", keys, partition_by)


def compact_table(
    spark: SparkSession,
    path: str,
    out: str,
    cluster_by: Sequence[str],
    partition_by: Sequence[str] = (),
    file_bytes: int = 512 << 20,
) -> None:
    """Rewrite a table range-partitioned and sorted by ``cluster_by`` (at most four columns) into files of about
    ``file_bytes``, so that file and row-group statistics skip. A partitioned table keeps its partition columns.

    A row hash is the last range column, so rows that share one key can fill several files.
    """
    if not 1 <= len(cluster_by) <= 4:
        raise ValueError("between one and four clustering columns")
    fs, location = _path(spark, path)
    files = max(1, -(-fs.getContentSummary(location).getLength() // file_bytes))
    rows = spark.read.parquet(path)
    order = [*partition_by, *cluster_by]
    spread = rows.withColumn("_h", F.xxhash64(*rows.columns)).repartitionByRange(files, *order, "_h")
    writer = spread.sortWithinPartitions(*order).drop("_h").write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(out)


def layout_job(spark: SparkSession, tables: dict[str, tuple], out_root: str, file_bytes: int = 512 << 20) -> DataFrame:
    """Compact each listed table (``name -> (path, clustering columns[, partition columns])``).

    Missing tables are skipped. Returns ``table_name, status, message``.
    """
    report = []
    for name, (path, cols, *partition_by) in tables.items():
        if not table_exists(spark, path):
            report.append((name, "skipped", "missing"))
            continue
        try:
            compact_table(spark, path, f"{out_root}/{name}", cols, partition_by[0] if partition_by else (), file_bytes)
            report.append((name, "success", ""))
        except Exception as error:  # noqa: BLE001  one failing table must not stop the list
            report.append((name, "failed", str(error).splitlines()[0]))
    return spark.createDataFrame(report, "table_name STRING, status STRING, message STRING")


def analyze_table(spark: SparkSession, name: str, cols: Sequence[str]) -> None:
    """Refresh table and column statistics of a catalog table."""
    def quoted(part: str) -> str:
        return "`" + part.replace("`", "``") + "`"

    table = ".".join(map(quoted, name.split(".")))
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(map(quoted, cols))}")


STATISTICS = "column_name STRING, n_rows BIGINT, n_nulls BIGINT, n_distinct BIGINT, min STRING, max STRING"


def table_statistics(spark: SparkSession, name: str, cols: Sequence[str]) -> DataFrame:
    """What the catalog knows of each column after :func:`analyze_table`: one row per column.

    The cost-based optimiser reads the same figures. Minimum and maximum are as the catalog prints them; text has none.
    """
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Statistics'").first()
    found = re.search(r"(\d+) rows", described.data_type if described else "")
    rows = []
    for column in cols:
        facts = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name} `{column}`").collect()}
        facts = {k: None if v in (None, "NULL") else v for k, v in facts.items()}
        number = lambda k: None if facts.get(k) is None else int(facts[k])  # noqa: B023, E731
        rows.append((column, int(found[1]) if found else None, number("num_nulls"), number("distinct_count"), facts.get("min"), facts.get("max")))
    return spark.createDataFrame(rows, STATISTICS)


AUDIT = (
    "run_id STRING, step STRING, version STRING, status STRING, rows_affected BIGINT, duration_ms BIGINT,"
    " error_message STRING, started_at TIMESTAMP, finished_at TIMESTAMP, metadata STRING"
)


def audit_summary(log: DataFrame) -> DataFrame:
    """Per run: steps, failures, total rows, total duration."""
    return log.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("steps"),
        F.count_if(F.col("status") == "failed").alias("failed_steps"),
        F.sum("rows_affected").alias("rows_affected"),
        F.sum("duration_ms").alias("duration_ms"),
    )


def run_step(
    spark: SparkSession,
    step: str,
    run_id: str,
    rows: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    write: Callable[[DataFrame], None],
    audit_path: str | None = None,
    version: str = "1",
) -> dict:
    """Transform and write once, counting the written rows on the way; empty input gives ``no_data``."""
    from pyspark.sql import Observation

    started = dt.datetime.now(dt.UTC)
    status, count, error = "success", 0, None
    try:
        if rows.isEmpty():
            status = "no_data"
        else:
            seen = Observation(f"{step}-{run_id}")
            write(transform(rows).observe(seen, F.count(F.lit(1)).alias("n")))
            count = seen.get["n"]
    except Exception as failure:
        status, error = "failed", str(failure).splitlines()[0]
        raise
    finally:
        if audit_path:
            ended = dt.datetime.now(dt.UTC)
            millis = int((ended - started).total_seconds() * 1000)
            row = (run_id, step, version, status, count, millis, error, started, ended, None)
            spark.createDataFrame([row], AUDIT).write.mode("append").parquet(audit_path)
    return {"rows_affected": count, "status": status}
