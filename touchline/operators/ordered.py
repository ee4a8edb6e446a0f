"""Ordered operators that keep one hot key from landing in one task.

A window puts every row of a key into one task. With a :class:`Skew` the rows of every hot key are cut
into consecutive chunks of bounded size, each chunk receives as seed rows exactly the earlier rows it
needs, and the window runs per (key, chunk). Which keys are hot is a partially aggregated table inside
the same plan, as long as it needs to be: nothing is counted while the plan is built, nothing is
collected, and the planner picks the joins. Without one they are a plain window: one shuffle. That is
the default, for keys that are bounded by nature: a team plays once a day at most, so its rows follow the
calendar and not the size of the table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.session import stored


@dataclass(frozen=True)
class Skew:
    """When a key is hot and how it is cut.

    A key is hot above ``rows_per_chunk`` rows. ``fine_width`` is the range of the second (integer) order
    column that is never split.
    """

    rows_per_chunk: int = 4_000_000
    fine_width: int = 1 << 20


DEFAULT_SKEW = Skew()


def join_safe(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str) -> DataFrame:
    """Equi-join on ``cols`` that also matches NULL keys."""
    keyed = right.select(
        *[F.col(c).alias(f"_j_{c}") for c in cols], *[F.col(c) for c in right.columns if c not in cols]
    )
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_j_{c}")) for c in cols])
    return left.join(keyed, same, how).drop(*[f"_j_{c}" for c in cols])


def hot_keys(df: DataFrame, by: Sequence[str], skew: Skew) -> DataFrame:
    """The hot keys as a table."""
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.filter(F.col("_n") > skew.rows_per_chunk).select(*by)


def _before(by: Sequence[str], order: str) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def hot_days(df: DataFrame, by: Sequence[str], hot: DataFrame, day: str, skew: Skew) -> DataFrame:
    """Days of hot keys with the first day of their chunk (``_label``), and how many parts a big day needs.

    Consecutive days share a chunk until it holds ``rows_per_chunk`` rows; the day that crosses the
    bound closes the chunk, so a chunk without a big day stays below twice the bound.
    """
    cells = join_safe(df.select(*by, day), hot, by, "left_semi").groupBy(*by, day).agg(F.count(F.lit(1)).alias("_n"))
    group = F.floor(F.coalesce(F.sum("_n").over(_before(by, day)), F.lit(0)) / skew.rows_per_chunk)
    label = F.min(day).over(Window.partitionBy(*by, "_g"))
    sized = cells.withColumn("_g", group).withColumn("_label", label)
    parts = F.when(F.col("_n") > skew.rows_per_chunk, F.ceil(F.col("_n") / skew.rows_per_chunk)).otherwise(F.lit(0))
    return sized.select(*by, day, "_label", parts.cast("bigint").alias("_parts"))


def _chunk_of(day: str, sub: Column) -> Column:
    """Chunk as an orderable struct; NULL for rows of keys that are not hot."""
    big = F.col("_parts") > 0
    return F.when(
        F.col("_parts").isNotNull(),
        F.struct(
            F.col("_label").alias("first_day"),
            F.when(big, F.col(day)).otherwise(F.col("_label")).alias("day"),
            F.when(big, sub).otherwise(F.lit(0)).cast("bigint").alias("part"),
        ),
    )


def with_chunks(df: DataFrame, by: Sequence[str], order: Sequence[str], skew: Skew) -> DataFrame:
    """Rows with ``_chunk``, NULL for keys that are not hot.

    A day of one key above the bound is cut further: by second when the order column is a timestamp,
    else by ranges of the second order column when that is an integer.
    """
    hot = hot_keys(df, by, skew)
    rows = df.withColumn("_day", F.col(order[0]).cast("date"))
    rows = join_safe(rows, hot_days(rows, by, hot, "_day", skew), [*by, "_day"], "left")
    kinds = [df.schema[c].dataType for c in order[:2]]
    if isinstance(kinds[0], T.TimestampType | T.TimestampNTZType):
        fine = F.unix_seconds(F.col(order[0]).cast("timestamp"))
    elif len(kinds) > 1 and isinstance(kinds[1], T.IntegralType):
        fine = F.floor(F.col(order[1]) / F.lit(skew.fine_width))
    else:
        return rows.withColumn("_chunk", _chunk_of("_day", F.lit(0))).drop("_day", "_label", "_parts")
    rows = rows.withColumn("_fine", F.when(F.col("_parts") > 0, fine))
    cells = (
        rows.filter(F.col("_parts") > 0).groupBy(*by, "_day", "_fine").agg(F.count(F.lit(1)).alias("_n"))
    )
    part = F.floor(F.coalesce(F.sum("_n").over(_before([*by, "_day"], "_fine")), F.lit(0)) / skew.rows_per_chunk)
    cut = cells.select(*by, "_day", "_fine", part.alias("_part"))
    rows = join_safe(rows, cut, [*by, "_day", "_fine"], "left")
    return rows.withColumn("_chunk", _chunk_of("_day", F.col("_part"))).drop(
        "_day", "_label", "_parts", "_fine", "_part"
    )


def _directed(cols: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first() for c in cols]


def dedup_latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """Latest row per key by ``order`` (descending). Ties fall to ``tiebreak`` columns, else to a row hash.

    The row_number = 1 shape becomes a window group limit, so a hot key sends one row per map task.
    """
    ties = [F.col(c).desc_nulls_last() for c in tiebreak] if tiebreak else [F.xxhash64(*df.columns).desc()]
    w = Window.partitionBy(*keys).orderBy(*_directed(order, True), *ties)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def top_k_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """First ``k`` rows per group; pruned to k rows per map task before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def latest_snapshot(df: DataFrame, by: Sequence[str], ts: str) -> DataFrame:
    """All rows of the newest snapshot per group.

    A partially aggregated maximum joined back, so a large snapshot of one group stays distributed.
    """
    newest = df.groupBy(*by).agg(F.max(ts).alias(ts))
    return df.join(newest, [*by, ts], "left_semi")


def with_lookback(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    n: int,
    columns: Mapping[str, Callable[[WindowSpec], Column]],
    needs: Sequence[str],
    descending: bool = False,
    skew: Skew | None = None,
) -> DataFrame:
    """Add window columns that look at most ``n`` rows back along ``order`` within each key.

    ``columns`` maps an output name to a function of the ordered window spec. ``needs`` are the
    columns those functions read. ``order`` must be total within a key and start with a date or
    timestamp. With ``descending`` the order is reversed, so looking back means looking ahead in time.
    """
    if skew is None:
        plain = Window.partitionBy(*by).orderBy(*_directed(order, descending))
        return df.withColumns({name: make(plain) for name, make in columns.items()})
    base = with_chunks(df, by, order, skew)
    fields = [c for c in dict.fromkeys([*order, *needs]) if c not in by]
    nearest = Window.partitionBy(*by, "_chunk").orderBy(*_directed(order, not descending))
    tails = (
        base.filter(F.col("_chunk").isNotNull())
        .withColumn("_rn", F.row_number().over(nearest))
        .filter(F.col("_rn") <= n)
        .select(*by, "_chunk", "_rn", F.struct(*fields).alias("_row"))
    )
    along = Window.partitionBy(*by).orderBy(*_directed(["_chunk"], descending), F.desc("_rn"))
    seeds = (
        tails.withColumns(
            {
                "_first": ~F.lag("_chunk").over(along).eqNullSafe(F.col("_chunk")),
                "_before": F.collect_list("_row").over(along.rowsBetween(-n, -1)),
            }
        )
        .filter("_first")
        .select(*by, "_chunk", F.inline("_before"))
        .withColumn("_seed", F.lit(True))
    )
    both = base.withColumn("_seed", F.lit(False)).unionByName(seeds, allowMissingColumns=True)
    spec = Window.partitionBy(*by, "_chunk").orderBy(*_directed(order, descending))
    return (
        both.withColumns({name: make(spec) for name, make in columns.items()})
        .filter(~F.col("_seed"))
        .drop("_seed", "_chunk")
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_ts: str,
    right_ts: str,
    values: Sequence[str],
    tiebreak: Sequence[str] = (),
    strict: bool = True,
    matched_ts: str | None = None,
    skew: Skew | None = None,
) -> DataFrame:
    """Left rows with the ``values`` of the latest right row of the same key before them.

    ``strict`` excludes equal times. Among right rows of one time the largest ``tiebreak`` wins.
    Union and forward fill; no range self-join. ``matched_ts`` names a column for the time of the
    matched row.
    """
    payload = F.struct(F.col(right_ts).alias("_at"), *[F.col(c) for c in values])
    ties = [f"_t{i}" for i in range(len(tiebreak))]
    left_side, right_side = (0, 1) if strict else (1, 0)
    events = right.filter(F.col(right_ts).isNotNull()).select(
        *by,
        F.col(right_ts).alias("_ts"),
        *[F.col(c).alias(t) for c, t in zip(tiebreak, ties, strict=True)],
        payload.alias("_pay"),
        F.lit(right_side).alias("_side"),
    )
    rows = left.select(
        *by, F.col(left_ts).alias("_ts"), F.struct(*left.columns).alias("_left"), F.lit(left_side).alias("_side")
    )
    merged = rows.unionByName(events, allowMissingColumns=True)
    keys = [*by]
    if skew is not None:
        merged, keys = _asof_chunks(merged, by, hot_keys(merged, by, skew), ties, strict, skew), [*by, "_chunk"]
    spec = (
        Window.partitionBy(*keys)
        .orderBy((F.col("_side") >= 0).asc(), F.col("_ts").asc_nulls_first(), "_side", *ties)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    filled = merged.withColumn("_found", F.last("_pay", ignorenulls=True).over(spec)).filter(
        F.col("_left").isNotNull()
    )
    out = [F.col(f"_found.{c}").alias(c) for c in values]
    if matched_ts is not None:
        out.append(F.col("_found._at").alias(matched_ts))
    return filled.select("_left.*", *out)


def _asof_chunks(
    merged: DataFrame, by: Sequence[str], hot: DataFrame, ties: Sequence[str], strict: bool, skew: Skew
) -> DataFrame:
    """Union rows with ``_chunk``, and for each chunk of a hot key the latest right row before it.

    Left rows do not depend on each other, so those of a big day are spread by hash. The right rows of
    that day form a part of their own after (strict) or before the left rows: only its winner, found by
    a partial aggregate, goes on to other chunks. With timestamps a big day is cut by second instead.
    """
    rows = merged.withColumn("_day", F.col("_ts").cast("date"))
    rows = join_safe(rows, hot_days(rows, by, hot, "_day", skew), [*by, "_day"], "left")
    is_left = F.col("_left").isNotNull()
    if isinstance(merged.schema["_ts"].dataType, T.DateType):
        spread = F.pmod(F.xxhash64("_left"), F.greatest(F.col("_parts"), F.lit(1)))
        sub = F.when(is_left, spread).otherwise(F.col("_parts") if strict else F.lit(-1))
        carry_only = ~is_left & (F.coalesce(F.col("_parts"), F.lit(0)) > 0)
    else:
        sub = F.unix_seconds(F.col("_ts").cast("timestamp"))
        carry_only = F.lit(False)
    chunked = rows.withColumns({"_chunk": _chunk_of("_day", sub), "_carry_only": carry_only}).drop(
        "_day", "_label", "_parts"
    )
    latest = F.max(F.struct("_ts", *ties, "_pay")).getField("_pay")
    in_hot = F.col("_chunk").isNotNull()
    tails = chunked.filter(in_hot & ~is_left).groupBy(*by, "_chunk").agg(latest.alias("_pay")).withColumn("_mark", F.lit(1))
    wanted = chunked.filter(in_hot & is_left).select(*by, "_chunk").distinct().withColumn("_mark", F.lit(0))
    along = Window.partitionBy(*by).orderBy("_chunk", "_mark").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        tails.unionByName(wanted, allowMissingColumns=True)
        .withColumn("_carried", F.last("_pay", ignorenulls=True).over(along))
        .filter((F.col("_mark") == 0) & F.col("_carried").isNotNull())
        .select(*by, "_chunk", F.col("_carried").alias("_pay"), F.lit(-1).alias("_side"))
    )
    return chunked.filter(~F.col("_carry_only")).drop("_carry_only").unionByName(carried, allowMissingColumns=True)


def global_row_number(df: DataFrame, order: Sequence[str], name: str = "row_no") -> DataFrame:
    """Dense 1..N numbering over the whole table, in ``order`` (a total order), without a single-task sort.

    Rows are range-partitioned on the full order, so a first column with few values or one hot value is cut by the next
    ones. Each task sorts its range and stores every row with its range and its place in it; only the counts per range
    meet in one task.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(ranged.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    # The identifier holds the partition above bit 33 and the row's place in it below.
    placed = placed.withColumns({"_range": F.shiftright("_place", 33), "_place": F.col("_place").bitwiseAND((1 << 33) - 1)})
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.join(offsets, "_range")
        .withColumn(name, F.col("_offset") + F.col("_place") + 1)
        .drop("_range", "_place", "_offset")
    )
