"""Rolling form, rest days and price movement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.columns import points
from touchline.operators.ordered import Skew, top_k_per_group, with_lookback

MATCH_ORDER = ("match_date", "fixture_id")


def rolling_form(
    team_rows: DataFrame,
    n: int = 5,
    as_of: str = "after",
    by: Sequence[str] = ("team_id",),
    by_venue: bool = False,
    order: Sequence[str] = MATCH_ORDER,
    skew: Skew | None = None,
) -> DataFrame:
    """Results of the last ``n`` played matches of each team.

    ``as_of="after"`` includes the row's own match, ``"before"`` uses only earlier matches. Adds
    ``wins_last_n``, ``draws_last_n``, ``losses_last_n``, ``goals_scored_avg_n``,
    ``goals_conceded_avg_n``, ``points_last_n``, ``games_last_n``, ``form_string`` (oldest first) and
    ``max_source_date``. With ``by_venue`` home and away matches are counted apart.
    """
    first, last = {"after": (-(n - 1), 0), "before": (-n, -1)}[as_of]
    keys = [*by, "is_home"] if by_venue else [*by]

    def over(agg: Column, w) -> Column:
        return agg.over(w.rowsBetween(first, last))

    def count_of(label: str):
        return lambda w: F.coalesce(over(F.sum(F.when(F.col("outcome") == label, 1).otherwise(0)), w), F.lit(0)).cast(
            "int"
        )

    columns = {
        f"wins_last_{n}": count_of("W"),
        f"draws_last_{n}": count_of("D"),
        f"losses_last_{n}": count_of("L"),
        f"goals_scored_avg_{n}": lambda w: over(F.avg("goals_for"), w),
        f"goals_conceded_avg_{n}": lambda w: over(F.avg("goals_against"), w),
        f"points_last_{n}": lambda w: F.coalesce(over(F.sum(points(F.col("outcome"))), w), F.lit(0)).cast("int"),
        f"games_last_{n}": lambda w: over(F.count(F.lit(1)), w).cast("int"),
        "form_string": lambda w: F.array_join(over(F.collect_list("outcome"), w), ""),
        "max_source_date": lambda w: over(F.max(order[0]), w),
    }
    return with_lookback(team_rows, keys, order, n, columns, ["outcome", "goals_for", "goals_against"], skew=skew)


def form_at_end(
    team_rows: DataFrame,
    n: int = 5,
    by: Sequence[str] = ("team_id",),
    within: Sequence[str] = (),
    order: Sequence[str] = MATCH_ORDER,
) -> DataFrame:
    """:func:`rolling_form` after the last match of each key, or of each key and value of ``within``.

    ``within`` are first columns of ``order``. Such a row looks at the last ``n`` rows of its group and of earlier groups
    only, so no other row is windowed.
    """
    newest = [F.col(c).desc_nulls_last() for c in order]
    recent = top_k_per_group(team_rows, [*by, *within], newest, n, "_from_end")
    return rolling_form(recent, n, "after", by, order=order).filter("_from_end = 1").drop("_from_end")


def days_since_last(
    team_rows: DataFrame,
    by: Sequence[str] = ("team_id",),
    order: Sequence[str] = MATCH_ORDER,
    name: str = "rest_days",
    skew: Skew | None = None,
) -> DataFrame:
    """Days since the key's previous row; NULL for its first."""
    return with_lookback(
        team_rows, by, order, 1, {name: lambda w: F.date_diff(F.col(order[0]), F.lag(order[0]).over(w))}, [], skew=skew
    )


def odds_movement(
    quotes: DataFrame,
    by: Sequence[str] = ("fixture_id", "bookmaker_id", "outcome"),
    order: Sequence[str] = ("ts", "quote_id"),
    price: str = "odd",
    skew: Skew | None = None,
) -> DataFrame:
    """Previous price and change of each quote, and the opening price of its series.

    The opening price is a per-key minimum by order, so it comes from a partial aggregate.
    """
    moved = with_lookback(quotes, by, order, 1, {"previous_odd": lambda w: F.lag(price).over(w)}, [price], skew=skew)
    bounds = quotes.groupBy(*by).agg(
        F.min(F.struct(*order, price)).getField(price).alias("opening_odd"),
        F.max(F.struct(*order, price)).getField(price).alias("closing_odd"),
    )
    return moved.join(bounds, [*by]).withColumn("odd_change", F.col(price) - F.col("previous_odd"))
