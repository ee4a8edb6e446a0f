"""Data-quality checks: each returns the violating rows; ``summarise`` turns them into one row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.ordered import dedup_latest


def outside(df: DataFrame, columns: Sequence[str], low: float, high: float) -> DataFrame:
    """Rows with any of ``columns`` outside [low, high]; NULL passes."""
    bad = F.lit(False)
    for c in columns:
        bad = bad | F.coalesce(~F.col(c).between(low, high), F.lit(False))
    return df.filter(bad)


def odds_out_of_range(odds: DataFrame, columns: Sequence[str], low: float = 1.01, high: float = 100.0) -> DataFrame:
    return outside(odds, columns, low, high)


def probability_sum_off(
    predictions: DataFrame,
    columns: Sequence[str] = ("prob_home_win", "prob_draw", "prob_away_win"),
    low: float = 0.95,
    high: float = 1.05,
) -> DataFrame:
    """Rows whose probabilities do not sum to about one (a NULL counts as a violation)."""
    total = sum([F.col(c) for c in columns[1:]], F.col(columns[0]))
    return predictions.withColumn("prob_sum", total).filter(
        F.col("prob_sum").isNull() | ~F.col("prob_sum").between(low, high)
    )


def incomplete_rounds(
    fixtures: DataFrame, expected: DataFrame, by: Sequence[str] = ("league_id", "season", "round")
) -> DataFrame:
    """Rounds whose number of matches differs from ``expected(league_id, expected_matches)``."""
    found = fixtures.groupBy(*by).agg(F.count(F.lit(1)).alias("n_matches"))
    return found.join(expected, "league_id").filter(F.col("n_matches") != F.col("expected_matches"))


def freshness(df: DataFrame, ts: str, as_of: Column, table: str, warn_hours: int = 12, error_hours: int = 24) -> DataFrame:
    """Newest row and its age in hours with status ok / warn / error (empty table: error)."""
    age = (F.unix_timestamp(as_of) - F.unix_timestamp(F.col("newest").cast("timestamp"))) / 3600.0
    return (
        df.agg(F.max(ts).alias("newest"))
        .withColumn("age_hours", age)
        .select(
            F.lit(table).alias("table_name"),
            "age_hours",
            F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), F.lit("error"))
            .when(F.col("age_hours") > warn_hours, F.lit("warn"))
            .otherwise(F.lit("ok"))
            .alias("status"),
        )
    )


def column_checks(
    df: DataFrame,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence[str]] | None = None,
    between: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Violations per check in a single pass over the table: ``check_name, violations, n_rows``."""
    tests: dict[str, Column] = {f"not_null:{c}": F.col(c).isNull() for c in not_null}
    tests |= {f"accepted:{c}": ~F.col(c).isin(*values) for c, values in (accepted or {}).items()}
    tests |= {f"between:{c}": ~F.col(c).between(low, high) for c, (low, high) in (between or {}).items()}
    names = list(tests)
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(tests[name]).alias(f"c{i}") for i, name in enumerate(names)]
    )
    rows = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"c{i}").alias("violations")) for i, n in enumerate(names)])
    return counts.select(F.inline(rows), "n_rows")


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def leaking_rows(features: DataFrame, source_dates: Sequence[str], match_date: str = "match_date") -> DataFrame:
    """Feature rows built from data at or after the match date."""
    late = F.lit(False)
    for c in source_dates:
        late = late | F.coalesce(F.col(c) >= F.col(match_date), F.lit(False))
    return features.filter(late)


def form_inconsistent(form: DataFrame, n: int = 5) -> DataFrame:
    """Rows where wins + draws + losses differ from the games, or the window is longer than ``n``."""
    total = F.col(f"wins_last_{n}") + F.col(f"draws_last_{n}") + F.col(f"losses_last_{n}")
    return form.filter((total != F.col(f"games_last_{n}")) | (F.col(f"games_last_{n}") > n))


def schema_drift(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """missing / extra / retyped columns against a name -> type map, and how many rows fill each of them."""
    actual = dict(df.dtypes)
    drifted = [
        (name, actual.get(name), expected.get(name), "missing" if name not in actual else "extra" if name not in expected else "retyped")
        for name in dict.fromkeys([*actual, *expected])
        if actual.get(name) != expected.get(name)
    ]
    schema = "column_name STRING, actual_type STRING, expected_type STRING, drift STRING"
    report = df.sparkSession.createDataFrame(drifted, schema)
    present = [name for name, have, _, _ in drifted if have]
    if not present:
        return report.withColumn("filled", F.lit(None).cast("bigint"))
    counts = df.agg(*[F.count(name).alias(name) for name in present])
    filled = counts.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("filled")) for n in present]))
    )
    return report.join(filled, "column_name", "left")


def summarise(name: str, violations: DataFrame) -> DataFrame:
    """One summary row of a check."""
    return violations.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(name).alias("check_name"),
        "violations",
        F.when(F.col("violations") == 0, "pass").otherwise("fail").alias("status"),
    )


def run_checks(checks: Mapping[str, DataFrame]) -> DataFrame:
    """Summary rows of several checks."""
    rows = [summarise(name, violations) for name, violations in checks.items()]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def dedup_tables(tables: Mapping[str, tuple[DataFrame, Sequence[str], Sequence[str]]]) -> tuple[dict[str, DataFrame], DataFrame]:
    """The latest row per key of each listed table (``name -> (rows, keys, order)``), and a report with ``table_name``,
    ``kept`` and ``removed`` rows."""
    kept, reports = {}, []
    for name, (rows, keys, order) in tables.items():
        kept[name] = dedup_latest(rows, keys, order)
        # Counted by key, so that no row but its key is shuffled a second time.
        sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        reports.append(
            sizes.agg(
                F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("kept"),
                F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("removed"),
            )
        )
    return kept, reduce(DataFrame.unionByName, reports)
