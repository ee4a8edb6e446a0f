"""Line deduplication: suffixes of line-id sequences ordered by distributed prefix doubling.

Every document is the sequence of its lines that are not blank. Lines that occur once break a sequence; the others get
ids in sorted order. Prefix doubling then ranks all positions by their next 1, 2, 4 … lines: the rank of a longer window
is the order of the pair (rank here, rank one window further on). Ranks come from a range sort of the distinct pairs, so
they sort like the suffixes, and suffixes with a common prefix of some length are an interval of the suffix array. Two
overlapping ranked windows name the interval of any length. A window that occurs once leaves (it cannot be part of a
repeat), so later rounds work on repeats only.

A run of lines is deleted where it occurs again and has at least ``min_words`` words, from one line on. Maximal runs need
not be spelled out: their union is that of their shortest windows of ``min_words`` words, one from every line on and one up
to every line. A line of a maximal run lies in the window up to it or, near the run's start, in the window from its first
line on, and both repeat wherever the run does. Those windows have at most ``min_words`` lines, so doubling ends at that
depth: intervals of longer common prefixes are nested in these and delete nothing more.

In each interval the first position by (``doc_id``, line) is the original; the windows of all others are deleted. Where a
window overlaps its own original in one document, the original's lines stay.

Blank lines are never deleted and do not interrupt a run. Defined cases: a null text stays null and has no lines; an
empty text has none; a null ``doc_id`` sorts first; rows that repeat id and text are one document and get equal results;
of other rows with one id the order is by text hash; an empty table gives no rows; extra columns pass through
``drop_repeated_lines`` whatever their names, but for ``removed_lines``, which the result has itself: a column of that name
is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import let, staged
from touchline.operators.ordered import join_safe

POSITION = ["__doc", "__text", "__line"]
MIN_WORDS = 10


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _not_blank(line: Column) -> Column:
    return line.rlike(r"\S")


def _keys(docs: DataFrame) -> list[Column]:
    return [F.col("doc_id").alias("__doc"), F.xxhash64("text").alias("__text")]


def _ranked(rows: DataFrame, keys: list[str], name: str, *others: str) -> DataFrame:
    """Positions whose ``keys`` occur at least twice, with ``rank``: increasing in the order of ``keys``.

    Counts are aggregated before the shuffle; ids of a range-sorted table increase with it, and the table is written so
    that they are given once.
    """
    repeated = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(*keys)
    ordered = repeated.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranks = staged(ordered.withColumn("rank", F.monotonically_increasing_id()), f"{name}-ranks")
    return staged(rows.join(ranks, keys).select(*POSITION, "rank", *others), f"{name}-positions")


def _window_sizes(words: Column, i: Column, min_words: int) -> tuple[Column, Column]:
    """Lines of the shortest window of ``min_words`` words from line ``i`` on, and up to it (null: none).

    The second is null too where the window is the shortest from its own first line on.
    """
    at = lambda k: F.coalesce(F.get(words, k), F.lit(0))
    on = up = at(i)
    starts, ends = [], []
    for n in range(1, min_words + 1):
        starts.append(F.when(on >= min_words, F.lit(n)))
        ends.append(F.when(up >= min_words, F.when(up - at(i) >= min_words, F.lit(n)).otherwise(F.lit(0))))
        on = on + at(i + n)
        up = up + F.when(i >= n, at(i - n)).otherwise(F.lit(0))
    return F.coalesce(*starts), F.nullif(F.coalesce(*ends), F.lit(0))


def _line_rows(docs: DataFrame, min_words: int) -> DataFrame:
    """One row per line that is not blank: position, two hashes that name it, window sizes, whether it is short."""

    def row(line: Column, i: Column, words: Column) -> Column:
        from_here, up_to_here = _window_sizes(words, i, min_words)
        return F.struct(
            i.alias("__line"), F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"),
            from_here.alias("from_here"), up_to_here.alias("up_to_here"), (F.get(words, i) < min_words).alias("short"),
        )

    def rows(lines: Column) -> Column:
        count = F.transform(lines, lambda x: F.size(F.array_remove(F.split(x, r"\s+"), "")))
        return let(count, lambda words: F.transform(lines, lambda x, i: row(x, i, words)))

    listed = let(F.filter(_lines(F.col("text")), _not_blank), rows)
    return docs.select(*_keys(docs), F.inline(listed))


def repeated_windows(docs: DataFrame, min_words: int) -> DataFrame:
    """``__doc``, ``__text``, ``__line``, ``n`` (lines) and the interval (``n``, ``ra``, ``rb``) of every shortest window
    of ``min_words`` words whose lines occur again."""
    lines = staged(_line_rows(docs, min_words), "lines")
    now = _ranked(lines, ["a", "b"], "lines", "from_here", "short")
    single = now.where("from_here = 1").select(*POSITION, F.lit(1).alias("n"), F.col("rank").alias("ra"), F.lit(0).cast("long").alias("rb"))
    both = F.array(
        F.struct(F.col("__line"), F.col("from_here").alias("n")),
        F.struct((F.col("__line") - F.col("up_to_here") + 1).alias("__line"), F.col("up_to_here").alias("n")),
    )
    asked = lines.where("from_here > 1 OR up_to_here > 1").select("__doc", "__text", F.inline(both)).where("n > 1")
    found, width = single, 1
    while 2 * width <= min_words:
        ahead = Window.partitionBy("__doc", "__text").orderBy("__line").rangeBetween(width, width)
        spread = now.repartition("__doc", "__text").dropDuplicates(POSITION)
        pairs = spread.select(
            *POSITION, F.col("rank").alias("a"), F.max("rank").over(ahead).alias("b"), (F.col("short") | F.max("short").over(ahead)).alias("short")
        )
        width *= 2
        # A window of several lines has none but its last or first that is not short.
        now = _ranked(pairs.where("b IS NOT NULL AND short"), ["a", "b"], f"windows-{width}", "short")
        known = now.select(*POSITION, F.col("rank").alias("ra"))
        tail = now.select("__doc", "__text", F.col("__line").alias("__tail"), F.col("rank").alias("rb"))
        here = asked.where((F.col("n") >= width) & (F.col("n") < 2 * width)).withColumn("__tail", F.col("__line") + F.col("n") - width)
        here = join_safe(join_safe(here, known, POSITION, "inner"), tail, ["__doc", "__text", "__tail"], "inner")
        found = found.unionByName(here.select(*POSITION, "n", "ra", "rb"))
    return staged(found, "windows")


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Per document with deletions: ``__doc``, ``__text`` and ``removed``, the ordered numbers of its deleted lines."""
    windows = repeated_windows(docs, min_words)
    interval = ["n", "ra", "rb"]
    # Written, so that the join below shuffles both sides for itself and the planner can split an interval that many share.
    first = staged(windows.groupBy(*interval).agg(F.min(F.struct(*POSITION)).alias("first")), "first-copies")
    later = windows.join(first, interval).where(F.struct(*POSITION) > F.col("first"))
    covered = later.select(
        "__doc", "__text", "first", "n", F.explode(F.sequence(F.col("__line"), F.col("__line") + (F.col("n") - 1))).alias("line")
    )
    original = (
        F.col("first.__doc").eqNullSafe(F.col("__doc"))
        & (F.col("first.__text") == F.col("__text"))
        & (F.col("line") < F.col("first.__line") + F.col("n"))
    )
    return covered.where(~original).groupBy("__doc", "__text").agg(F.sort_array(F.collect_set("line")).alias("removed"))


def _rest(text: Column, removed: Column) -> Column:
    """The text without the lines at ordinals ``removed`` among its lines that are not blank."""

    def of(lines: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(lines) - 1)
        filled = F.filter(every, lambda i: _not_blank(F.get(lines, i)))
        gone = let(filled, lambda f: F.transform(removed, lambda i: F.get(f, i)))
        return F.transform(F.array_except(every, gone), lambda i: F.get(lines, i))

    return F.array_join(let(_lines(text), of), "\n")


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` with the shortened ``text`` and ``removed_lines``, the deleted ordinals (null where none)."""
    removed = staged(repeated_lines(docs.select("doc_id", "text"), min_words), "removed-lines").withColumnRenamed("removed", "__removed")
    # The caller's columns travel in one struct, so that no name of theirs meets one of the operator's.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), *_keys(docs))
    same = rows["__doc"].eqNullSafe(removed["__doc"]) & (rows["__text"] == removed["__text"])
    # One plan at every size: the texts are shuffled once, whether few or many documents lose lines.
    joined = rows.join(removed.hint("merge"), same, "left").select("__row", "__removed")
    text = F.when(F.col("__removed").isNull(), F.col("__row.text")).otherwise(_rest(F.col("__row.text"), F.col("__removed")))
    others = [F.col(f"__row.`{c}`").alias(c) for c in docs.columns if c not in ("text", "removed_lines")]
    return joined.select(*others, text.alias("text"), F.col("__removed").alias("removed_lines"))


def line_report(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id``, ``n_lines`` (not blank), ``n_removed``, ``n_runs`` (maximal deleted runs) and the text that is left."""
    removed = F.coalesce(F.col("removed_lines"), F.array().cast("array<int>"))
    runs = let(removed, lambda r: F.filter(r, lambda x, i: (i == 0) | (x != F.get(r, i - 1) + 1)))
    left = F.filter(_lines(F.col("text")), _not_blank)
    rows = drop_repeated_lines(docs.select("doc_id", "text"), min_words)
    return rows.select(
        "doc_id", (F.coalesce(F.size(left), F.lit(0)) + F.size(removed)).cast("long").alias("n_lines"),
        F.size(removed).cast("long").alias("n_removed"), F.size(runs).cast("long").alias("n_runs"), "text",
    )
