"""Parsing, flattening, exploding and pivoting of nested records."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.columns import percent_number

Source = str | Column


def _column(source: Source) -> Column:
    return F.col(source) if isinstance(source, str) else source


def parse_payload(df: DataFrame, schema: str, payload: str = "payload", path: str | None = None) -> DataFrame:
    """Add ``rec``: the payload parsed once by an explicit schema (all-NULL when malformed).

    Rows that bring their ``rec`` keep it. The parse sits in a one-element explode, which keeps later filters on parsed fields from being
    pushed below it: pushed down, they would parse every payload a second time.
    """
    if "rec" in df.columns:
        return df
    text = F.get_json_object(payload, path) if path else F.col(payload)
    return df.select("*", F.explode(F.array(F.from_json(text, schema))).alias("rec"))


def flatten_json(
    df: DataFrame, schema: str, mapping: Mapping[str, Source], keep: Sequence[str] = (), payload: str = "payload"
) -> DataFrame:
    """One typed row per payload: ``mapping`` is output name -> path below ``rec`` or expression."""
    parsed = parse_payload(df, schema, payload)
    fields = [
        (F.col(f"rec.{source}") if isinstance(source, str) else source).alias(name) for name, source in mapping.items()
    ]
    return parsed.select(*fields, *keep)


def require_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Drop rows with a NULL key."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def reject_reason(keys: Sequence[str], corrupt: str | None = None) -> Column:
    """Why a row is unusable, or NULL: ``malformed`` first, else the first NULL key."""
    reason = F.when(F.col(corrupt).isNotNull(), F.lit("malformed")) if corrupt else F.when(F.lit(False), F.lit(""))
    for key in keys:
        reason = reason.when(F.col(key).isNull(), F.lit(f"null_{key}"))
    return reason


def split_valid(df: DataFrame, keys: Sequence[str], corrupt: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Usable rows, and the rejected rows with ``_reject_reason``."""
    marked = df.withColumn("_reject_reason", reject_reason(keys, corrupt))
    accepted = marked.filter(F.col("_reject_reason").isNull()).drop("_reject_reason")
    return accepted, marked.filter(F.col("_reject_reason").isNotNull())


def explode_path(
    df: DataFrame, levels: Sequence[tuple[str, str]], keep: Mapping[str, str], outer: bool = True
) -> DataFrame:
    """Explode nested arrays level by level.

    ``levels`` are (array path, alias); a path may start with an earlier alias. ``keep`` maps output
    names to paths over the input columns and aliases. An array of arrays is flattened first.
    Only the referenced struct fields survive column pruning.
    """
    generator = F.explode_outer if outer else F.explode
    for path, alias in levels:
        array = F.col(path)
        is_nested = df.select(array.alias("a")).schema["a"].dataType.simpleString().startswith("array<array<")
        df = df.withColumn(alias, generator(F.flatten(array) if is_nested else array))
    return df.select(*[F.col(path).alias(name) for name, path in keep.items()])


def pivot_kv(
    df: DataFrame,
    array: str,
    mapping: Mapping[str, tuple[str, str]],
    key: str = "type",
    value: str = "value",
) -> DataFrame:
    """Key/value array to columns: first entry of each key, percent sign stripped, cast without error.

    Row-local, so there is no shuffle; looked up by position rather than by a lambda per key, so it
    stays inside generated code. ``mapping`` is key -> (column, type).
    """
    keys, values = F.col(f"{array}.{key}"), F.col(f"{array}.{value}")

    def entry(name: str, type_: str) -> Column:
        # A missing key has position 0, hence index -1, hence NULL.
        number = percent_number(F.get(values, F.array_position(keys, name).cast("int") - 1))
        return number if type_ == "double" else number.try_cast(type_)

    picked = [entry(name, type_).alias(column) for name, (column, type_) in mapping.items()]
    return df.select(*[c for c in df.columns if c != array], *picked)


def pivot_static(
    df: DataFrame, keys: Sequence[str], on: str, mapping: Mapping[str, str], value: str, extra: Sequence[Column] = ()
) -> DataFrame:
    """Rows to columns with a known value list: one partially aggregated pass, no discovery job."""
    picked = [F.max(F.when(F.col(on) == key, F.col(value))).alias(column) for key, column in mapping.items()]
    return df.groupBy(*keys).agg(*picked, *extra)


TEAM_ROW = ("team_id", "opponent_id", "is_home", "goals_for", "goals_against", "outcome")


def to_team_rows(fixtures: DataFrame) -> DataFrame:
    """Two rows per match, one from each side (W / D / L from the team's view); a single scan."""

    def side(team: str, opponent: str, scored: str, conceded: str, is_home: bool) -> Column:
        win, loss = ("H", "A") if is_home else ("A", "H")
        label = F.when(F.col("result") == win, "W").when(F.col("result") == loss, "L").when(
            F.col("result") == "D", "D"
        )
        return F.struct(
            F.col(team).alias("team_id"),
            F.col(opponent).alias("opponent_id"),
            F.lit(is_home).alias("is_home"),
            F.col(scored).alias("goals_for"),
            F.col(conceded).alias("goals_against"),
            label.alias("outcome"),
        )

    both = F.array(
        side("home_team_id", "away_team_id", "goals_home", "goals_away", True),
        side("away_team_id", "home_team_id", "goals_away", "goals_home", False),
    )
    carried = [c for c in fixtures.columns if c not in ("home_team_id", "away_team_id", "goals_home", "goals_away")]
    return fixtures.select(*carried, F.inline(both))


def stamp(df: DataFrame, batch_id: str, at: Column | None = None) -> DataFrame:
    """Add ``_loaded_at`` and ``_batch_id``."""
    return df.withColumns({"_loaded_at": F.current_timestamp() if at is None else at, "_batch_id": F.lit(batch_id)})


def mask_columns(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Replace personal fields; see :func:`touchline.functions.columns.mask` for the rules."""
    from touchline.functions.columns import mask

    return df.withColumns({name: mask(F.col(name), rule) for name, rule in rules.items()})
