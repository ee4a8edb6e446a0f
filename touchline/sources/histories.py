"""History tables (validity intervals) whose open versions live in a partition of their own.

A table is partitioned by ``is_current`` and ``valid_to``. A snapshot is compared with the open partition only, so its cost
follows the number of keys and not the length of the history: closed versions go to the partition of the day that closed
them, the open partition is rewritten, and closed partitions of other days are neither read nor written. A snapshot that
changes nothing writes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.operators.ordered import join_safe
from touchline.session import drop_stored, stored
from touchline.sources.tables import overwrite_partitions, reject_duplicates, table_exists, upsert, upsert_table

PARTITIONS = ("is_current", "valid_to")


def read_history(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    """All versions; ``columns`` are the types of keys and checked columns."""
    validity = [("valid_from", T.DateType()), ("is_current", T.BooleanType()), ("valid_to", T.DateType())]
    fields = [T.StructField(f.name, f.dataType) for f in columns] + [T.StructField(n, t) for n, t in validity]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def state_on(history: DataFrame, day: dt.date) -> DataFrame:
    """The versions valid on ``day``; the days that closed them prune the partitions."""
    return history.filter((F.col("valid_from") <= F.lit(day)) & (F.col("is_current") | (F.col("valid_to") > F.lit(day))))


def load_history(
    snapshot: DataFrame, path: str, keys: Sequence[str], check_cols: Sequence[str], as_of: dt.date
) -> bool:
    """Apply one snapshot of the day ``as_of``; returns whether anything was written.

    Keys missing from the snapshot stay open and NULL keys are equal; two rows with one key are rejected. A version that
    began on the same day is corrected in place, so no interval is empty; one that began later makes the load fail, as the
    past is not rewritten. Closed versions are written before the open partition and by key and start, so a load that
    failed half way is repaired by running it again.
    """
    spark, day = snapshot.sparkSession, F.lit(as_of)
    fresh = stored(snapshot.select(*keys, *check_cols), "history-snapshot")
    reject_duplicates(fresh, keys)
    versions = fresh.withColumns(
        {"valid_from": day, "is_current": F.lit(True), "valid_to": F.lit(None).cast("date")}
    )
    if not table_exists(spark, path):
        overwrite_partitions(versions, path, PARTITIONS)
        drop_stored(fresh)
        return True
    state = F.struct(*check_cols)
    current = read_history(spark, path, fresh.schema).filter("is_current")
    known = current.select(*keys, state.alias("_old"), F.col("valid_from").alias("_since"))
    compared = join_safe(versions, known, keys, "left")
    changed = stored(compared.filter(F.col("_since").isNull() | ~state.eqNullSafe(F.col("_old"))), "history-changed")
    try:
        if changed.isEmpty():
            return False
        if not changed.filter(F.col("_since") > day).isEmpty():
            raise ValueError(f"the snapshot of {as_of} would change versions that began later")
        closed = changed.filter(F.col("_since") < day).select(
            *keys, "_old.*", F.col("_since").alias("valid_from"), F.lit(False).alias("is_current"), day.alias("valid_to")
        )
        if not closed.isEmpty():
            same_day = ~F.col("is_current") & (F.col("valid_to") == day)
            upsert_table(closed, path, [*keys, "valid_from"], PARTITIONS, within=same_day)
        opened = stored(upsert(current, changed.select(*current.columns), keys), "history-open")
        overwrite_partitions(opened, path, PARTITIONS)
        drop_stored(opened)
        return True
    finally:
        drop_stored(changed)
        drop_stored(fresh)
