"""Joins. No side is broadcast by hint: Spark broadcasts only below its size threshold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.columns import pair_key


def restrict_to(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    return df.join(keys.select(*on), [*on], "left_semi")


def orphans(child: DataFrame, parent: DataFrame, on: Sequence[str]) -> DataFrame:
    """Child rows without a parent."""
    return child.join(parent.select(*on), [*on], "left_anti")


def join_home_away(
    fixtures: DataFrame, dim: DataFrame, on: Sequence[str], cols: Sequence[str], diff: Sequence[str] = ()
) -> DataFrame:
    """Join ``dim`` once per side with prefixed columns; ``diff`` adds home minus away.

    ``dim`` is keyed by ``team_id`` plus the ``on`` columns that it shares with ``fixtures``.
    """
    out = fixtures
    for side in ("home", "away"):
        renamed = dim.select(
            F.col("team_id").alias(f"{side}_team_id"), *on, *[F.col(c).alias(f"{side}_{c}") for c in cols]
        )
        out = out.join(renamed, [f"{side}_team_id", *on], "left")
    return out.withColumns({f"{c}_diff": F.col(f"home_{c}") - F.col(f"away_{c}") for c in diff})


def flag_pairs(df: DataFrame, pairs: DataFrame, a: str, b: str, name: str = "is_derby") -> DataFrame:
    """True where the unordered pair (a, b) is listed in ``pairs(team_a, team_b)``."""
    low, high = pair_key(F.col(a), F.col(b))
    listed_low, listed_high = pair_key(F.col("team_a"), F.col("team_b"))
    listed = pairs.select(listed_low.alias("_low"), listed_high.alias("_high"), F.lit(True).alias("_hit")).distinct()
    return (
        df.withColumns({"_low": low, "_high": high})
        .join(listed, ["_low", "_high"], "left")
        .withColumn(name, F.coalesce("_hit", F.lit(False)))
        .drop("_low", "_high", "_hit")
    )


def apply_aliases(df: DataFrame, aliases: DataFrame, column: str) -> DataFrame:
    """Replace ``column`` by ``common_name`` where ``aliases(alias_name, common_name)`` lists it."""
    known = aliases.select(F.col("alias_name").alias(column), "common_name").dropDuplicates([column])
    return (
        df.join(known, column, "left")
        .withColumn(column, F.coalesce("common_name", F.col(column)))
        .drop("common_name")
    )


def left_join_all(base: DataFrame, on: Sequence[str], *others: DataFrame) -> DataFrame:
    """Left joins on one shared key: the base is partitioned on it once."""
    for other in others:
        base = base.join(other, [*on], "left")
    return base


def side_columns(rows: DataFrame, key: str, cols: Sequence[str], names: dict[str, str] | None = None) -> DataFrame:
    """Team rows back to one row per match with ``home_*`` and ``away_*`` columns."""
    names = names or {}

    def pick(side: str, c: str) -> Column:
        flag = F.col("is_home") if side == "home" else ~F.col("is_home")
        template = names.get(c, "{side}_" + c)
        return F.max(F.when(flag, F.col(c))).alias(template.format(side=side))

    return rows.groupBy(key).agg(*[pick(side, c) for side in ("home", "away") for c in cols])
