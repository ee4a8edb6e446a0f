"""Column expressions. All of them stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_cast(col: Column, type_: str) -> Column:
    """Cast that yields NULL on bad input, whatever the ANSI setting."""
    if type_ in ("int", "bigint"):
        return F.coalesce(col.try_cast(type_), col.try_cast("double").try_cast(type_))
    return col.try_cast(type_)


def local_day(text: Column) -> Column:
    """Calendar day as written in an ISO text; the offset does not move it."""
    return text.try_cast("date")


def instant(text: Column) -> Column:
    """Point in time of an ISO text, offset applied."""
    return text.try_cast("timestamp")


def percent_number(text: Column) -> Column:
    """``'57%'`` or ``'57'`` to 57.0; only texts with a sign go through the pattern."""
    stripped = F.regexp_replace(F.trim(text), "%$", "").try_cast("double")
    return F.when(F.contains(text, F.lit("%")), stripped).otherwise(text.try_cast("double"))


def pct(text: Column) -> Column:
    """``'45%'`` to 0.45."""
    return percent_number(text) / F.lit(100.0)


def outcome_label(
    home: Column, away: Column, status: Column | None = None, finished: Iterable[str] = ("FT",)
) -> Column:
    """H / D / A of a finished match; NULL when unfinished or a score is missing."""
    label = F.when(home > away, F.lit("H")).when(home == away, F.lit("D")).when(home < away, F.lit("A"))
    return label if status is None else F.when(status.isin(*finished), label)


def confidence_band(*probabilities: Column, high: float = 0.55, medium: float = 0.40) -> Column:
    """high / medium / low by the largest probability; both bounds are exclusive."""
    top = F.greatest(*probabilities) if len(probabilities) > 1 else probabilities[0]
    return F.when(top > high, F.lit("high")).when(top > medium, F.lit("medium")).when(top.isNotNull(), F.lit("low"))


def argmax_label(options: Mapping[str, Column]) -> Column:
    """Label of the largest value; the first option wins a tie, NULL when all are NULL."""
    top = F.greatest(*options.values())
    picked = None
    for label, col in options.items():
        picked = F.when(col == top, F.lit(label)) if picked is None else picked.when(col == top, F.lit(label))
    return picked


def implied_probs(odds: Mapping[str, Column]) -> dict[str, Column]:
    """1/odd per outcome, scaled so that they sum to 1 (the margin is removed)."""
    inverse = {name: F.try_divide(F.lit(1.0), odd) for name, odd in odds.items()}
    total = sum(list(inverse.values())[1:], next(iter(inverse.values())))
    return {name: value / total for name, value in inverse.items()}


def surrogate_key(*cols: Column) -> Column:
    """md5 of the joined key columns; NULL is marked so that (NULL, x) and (x, NULL) differ."""
    return F.md5(F.concat_ws("#", *[F.coalesce(c.cast("string"), F.lit("∅")) for c in cols]))


def pair_key(a: Column, b: Column) -> tuple[Column, Column]:
    """Order-free key of two ids."""
    return F.least(a, b), F.greatest(a, b)


def record_text(wins: Column, draws: Column, losses: Column) -> Column:
    """Record as text, e.g. ``2W 1D 2L``; NULL without one."""
    known = wins.isNotNull() & draws.isNotNull() & losses.isNotNull()
    return F.when(known, F.format_string("%dW %dD %dL", wins, draws, losses))


def points(label: Column, win: str = "W", draw: str = "D") -> Column:
    """3 / 1 / 0 points."""
    return F.when(label == win, F.lit(3)).when(label == draw, F.lit(1)).otherwise(F.lit(0))


def event_class(event_type: Column, detail: Column) -> Column:
    """One of goal, own_goal, missed_penalty, yellow_card, red_card, substitution, var, other."""
    kind, text = F.lower(event_type), F.lower(F.coalesce(detail, F.lit("")))
    return (
        F.when((kind == "goal") & text.contains("own"), F.lit("own_goal"))
        .when((kind == "goal") & text.contains("missed"), F.lit("missed_penalty"))
        .when(kind == "goal", F.lit("goal"))
        .when((kind == "card") & text.contains("red"), F.lit("red_card"))
        .when(kind == "card", F.lit("yellow_card"))
        .when(kind.isin("subst", "substitution"), F.lit("substitution"))
        .when(kind == "var", F.lit("var"))
        .otherwise(F.lit("other"))
    )


def mask(col: Column, rule: str) -> Column:
    """``hash``: sha-256; ``initial``: first letter and stars; ``null``: removed."""
    text = col.cast("string")
    if rule == "hash":
        return F.sha2(text, 256)
    if rule == "initial":
        return F.concat(F.substring(text, 1, 1), F.lit("***"))
    if rule == "null":
        return F.lit(None).cast("string")
    raise ValueError(f"unknown mask rule {rule!r}")
