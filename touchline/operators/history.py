"""Change history with validity intervals (slowly changing dimension, type 2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.ordered import Skew, join_safe, with_lookback
from touchline.session import stored

VALIDITY = ("valid_from", "valid_to", "is_current")


def scd2_apply(
    history: DataFrame, snapshot: DataFrame, keys: Sequence[str], check_cols: Sequence[str], as_of: Column
) -> DataFrame:
    """Apply one key-unique snapshot to a history: close changed rows, open new ones.

    Keys missing from the snapshot stay open; NULL keys are equal. Only the current rows take part in the join, which has
    at most one match per key on either side.
    """
    current = history.filter("is_current")
    closed = history.filter(~F.col("is_current"))
    fresh = snapshot.select(*keys, F.struct(*check_cols).alias("_new"))
    compared = join_safe(current, fresh, keys, "left").withColumn(
        "_changed", F.col("_new").isNotNull() & ~F.struct(*check_cols).eqNullSafe(F.col("_new"))
    )
    kept = compared.withColumns(
        {
            "valid_to": F.when(F.col("_changed"), as_of).otherwise(F.col("valid_to")),
            "is_current": ~F.col("_changed"),
        }
    ).select(*history.columns)
    same = current.select(*keys, F.struct(*check_cols).alias("_old"))
    opened = (
        join_safe(snapshot, same, keys, "left")
        .filter(F.col("_old").isNull() | ~F.struct(*check_cols).eqNullSafe(F.col("_old")))
        .select(
            *[c for c in history.columns if c not in VALIDITY],
            as_of.alias("valid_from"),
            F.lit(None).cast(history.schema["valid_to"].dataType).alias("valid_to"),
            F.lit(True).alias("is_current"),
        )
    )
    return closed.unionByName(kept).unionByName(opened)


def scd2_from_log(
    log: DataFrame,
    keys: Sequence[str],
    check_cols: Sequence[str],
    order: Sequence[str],
    skew: Skew | None = None,
) -> DataFrame:
    """Rebuild the intervals from a full log of observations.

    Rows equal to their predecessor are dropped; each remaining row is valid from its own time until
    the next one. Both passes look one row back or ahead, so a hot key is spread.
    ``order`` must be total within a key; its first column gives the validity times.
    """
    rows = log.withColumn("_state", F.struct(*check_cols))
    marked = with_lookback(
        rows,
        keys,
        order,
        1,
        {
            "_changed": lambda w: (F.row_number().over(w) == 1) | ~F.lag("_state").over(w).eqNullSafe(F.col("_state")),
        },
        ["_state"],
        skew=skew,
    )
    changes = marked.filter("_changed").drop("_changed", "_state")
    if skew is not None:
        changes = stored(changes, "changes")  # the second pass would repeat the first one's counts
    bounded = with_lookback(
        changes, keys, order, 1, {"valid_to": lambda w: F.lag(order[0]).over(w)}, [], descending=True, skew=skew
    )
    return bounded.withColumns({"valid_from": F.col(order[0]), "is_current": F.col("valid_to").isNull()})


def scd2_violations(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one current row or with reversed intervals."""
    return (
        history.groupBy(*keys)
        .agg(
            F.count_if("is_current").alias("current_rows"),
            F.count_if(F.col("valid_to") < F.col("valid_from")).alias("reversed_rows"),
        )
        .filter((F.col("current_rows") > 1) | (F.col("reversed_rows") > 0))
    )
