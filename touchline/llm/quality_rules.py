"""Quality rules: a decision list learned from labelled statistics.

``text_statistics`` computes per-document counts inside one row (no explode, no shuffle). ``learn_rules`` is sequential
covering: a rule is grown by adding the threshold condition with the best information gain on the grow rows, then pruned
from its end on the held-out rows, kept while it is precise enough there, and the rows it covers are removed before the
next rule. Each step is one aggregation over the labelled statistics, which come back as counts per feature and
candidate threshold. The result is an ordered list of conjunctions and becomes one CASE expression.

Learning uses at most ``max_labelled`` labelled documents, chosen by hash when there are more (a documented bound on the
classifier's sample; statistics and decisions cover every document).

Defined cases: a null text has no words and fails; without usable labels, or when none is of the bad class, the list is
empty and only the base rule decides; null labels and labels of unknown documents are ignored; a document labelled
twice counts once and as good if any label says so; repeated rows get equal verdicts; a null ``doc_id`` is judged by its
text like any other; extra columns pass through ``keep_good`` and are ignored elsewhere.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import let, staged, text_or_empty

#: Fixed by the contract of the operator.
SPACE = r"\x20\x09-\x0D"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
LEAST_WORDS = 10
REPEAT_PERCENT = 20

FEATURES = (
    "f_word_length", "f_symbols", "f_dup_lines", "f_repeat_words", "f_distinct_words", "f_upper", "f_marks", "f_digits",
    "f_words",
)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")


def _windows(words: Column) -> Column:
    """A 64-bit hash of each five-word window, in order."""
    n = F.size(words)
    starts = F.when(n >= WINDOW, F.sequence(F.lit(1), n - (WINDOW - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, WINDOW)))


def _covered(windows: Column) -> Column:
    """Words inside windows that occur at least twice: sort windows by hash, keep positions whose neighbour is equal,
    then add up the union of their ranges."""

    def positions(ranked: Column) -> Column:
        twice = F.filter(
            ranked,
            lambda e, i: ((i > 0) & (e["h"] == F.get(ranked, i - 1)["h"])) | (e["h"] == F.get(ranked, i + 1)["h"]),
        )
        return F.sort_array(F.transform(twice, lambda e: e["p"]))

    def union(at: Column) -> Column:
        steps = F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    ranked = F.sort_array(F.transform(windows, lambda h, p: F.struct(h.alias("h"), p.alias("p"))))
    return F.when(
        F.size(windows) > F.size(F.array_distinct(windows)), let(ranked, lambda r: let(positions(r), union))
    ).otherwise(F.lit(0))


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def text_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """Columns ``keep`` and, per row: ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed`` and the features of the learned list."""
    text = text_or_empty()

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
            let(_windows(words), _covered).cast("long").alias("n_repeat_words"),
        )

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    rows = docs.select(
        *[F.col(f"`{k}`") for k in keep],
        let(_words(text), of_words).alias("__w"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        let(lines, lambda x: F.size(x)).cast("long").alias("__lines"),
        (F.char_length(text) - _count(text, f"[{SPACE}]")).cast("long").alias("word_chars"),
        _count(text, SYMBOLS).alias("n_symbols"),
        _count(text, r"\p{Lu}").alias("__upper"),
        _count(text, r"[!?^~=+{}\[\]\\/_]").alias("__marks"),
        _count(text, "[0-9]").alias("__digits"),
    )
    n, chars = F.col("__w.n_words"), F.greatest(F.col("word_chars"), F.lit(1))
    many = F.greatest(n, F.lit(1))
    failed = (n < LEAST_WORDS) | (100 * F.col("__w.n_repeat_words") > REPEAT_PERCENT * n)
    return rows.select(
        *[F.col(f"`{k}`") for k in keep],
        n.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", F.col("__w.n_repeat_words").alias("n_repeat_words"),
        failed.alias("base_failed"),
        (F.col("word_chars") / many).alias("f_word_length"),
        (F.col("n_symbols") / many).alias("f_symbols"),
        (F.col("n_dup_lines") / F.greatest(F.col("__lines"), F.lit(1))).alias("f_dup_lines"),
        (F.col("__w.n_repeat_words") / many).alias("f_repeat_words"),
        (F.col("__w.n_distinct") / many).alias("f_distinct_words"),
        (F.col("__upper") / chars).alias("f_upper"),
        (F.col("__marks") / many).alias("f_marks"),
        (F.col("__digits") / chars).alias("f_digits"),
        n.cast("double").alias("f_words"),
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def sql(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold!r}D"


@dataclass
class Rule:
    """A conjunction that marks documents as bad, with its counts on the held-out rows."""

    conditions: list[Condition] = field(default_factory=list)
    bad: int = 0
    good: int = 0

    def sql(self) -> str:
        return " AND ".join(f"({c.sql()})" for c in self.conditions) or "true"


def decision_list(rules: list[Rule]) -> Column:
    """The ordered list as one conditional expression: the number of the first rule that fires, else null."""
    if not rules:
        return F.lit(None).cast("int")
    return F.expr("CASE " + " ".join(f"WHEN {r.sql()} THEN {i}" for i, r in enumerate(rules)) + " END")


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    import math

    if p <= 0:
        return float("-inf")
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def _cuts(rows: DataFrame, n_cuts: int) -> dict[str, list[float]]:
    """Candidate thresholds per feature: quantiles of the bad rows, where the boundary must lie, and of all rows."""
    fractions = [i / n_cuts for i in range(n_cuts + 1)]
    both = rows.agg(
        *[F.percentile_approx(f, fractions).alias(f) for f in FEATURES],
        *[F.percentile_approx(F.when(F.col("bad") == 1, F.col(f)), fractions).alias(f"b_{f}") for f in FEATURES],
    ).first()
    return {f: sorted({*(both[f] or []), *(both[f"b_{f}"] or [])}) for f in FEATURES}


def _tables(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[str, dict[int, tuple[int, int]]]:
    """Bad and good rows per feature and interval of its thresholds, in one aggregation."""
    places = F.array(*[
        F.struct(F.lit(f).alias("f"), F.expr(f"size(filter(array({', '.join(f'{x!r}D' for x in cuts[f])}), x -> x <= {f}))").alias("at"))
        for f in FEATURES if cuts[f]
    ])
    counted = rows.select(F.explode(places).alias("x"), "bad").groupBy("x.f", "x.at").agg(F.sum("bad").alias("p"), F.count(F.lit(1)).alias("n"))
    out: dict[str, dict[int, tuple[int, int]]] = {}
    for r in counted.collect():  # at most features x thresholds rows
        out.setdefault(r["f"], {})[r["at"]] = (r["p"], r["n"] - r["p"])
    return out


def _best(tables, cuts, p0: float, n0: float) -> tuple[float, Condition] | None:
    best = None
    for f, table in tables.items():
        total_p, total_n = sum(x[0] for x in table.values()), sum(x[1] for x in table.values())
        below_p = below_n = 0
        for i, cut in enumerate(cuts[f]):
            p, n = table.get(i, (0, 0))
            below_p, below_n = below_p + p, below_n + n
            for above, (pp, nn) in ((False, (below_p, below_n)), (True, (total_p - below_p, total_n - below_n))):
                gain = _gain(pp, nn, p0, n0)
                if best is None or gain > best[0] + 1e-9:
                    best = (gain, Condition(f, above, cut))
    return best


def _counts(rows: DataFrame, rule: Rule) -> list[tuple[int, int]]:
    """Bad and good rows covered by each prefix of the rule's conditions, in one aggregation."""
    parts = [Rule(rule.conditions[: i + 1]).sql() for i in range(len(rule.conditions))]
    r = rows.agg(*[F.sum(F.expr(f"CAST(({s}) AND bad = {b} AS BIGINT)")).alias(f"c{i}_{b}") for i, s in enumerate(parts) for b in (1, 0)]).first()
    return [(r[f"c{i}_1"] or 0, r[f"c{i}_0"] or 0) for i in range(len(parts))]


def learn_rules(
    labelled: DataFrame, max_rules: int = 12, max_conditions: int = 4, n_cuts: int = 32, least_precision: float = 0.98,
    least_support: int = 3,
) -> list[Rule]:
    """``labelled``: the features, ``bad`` 0/1 and ``grow`` (true for rows that grow rules, false for those that prune).

    A rule enters the list when at least ``least_precision`` of the held-out rows that it covers are bad.
    """
    grow, prune = labelled.where("grow"), labelled.where("NOT grow")
    rules: list[Rule] = []
    for _ in range(max_rules):
        left = " AND ".join(["true", *[f"NOT ({r.sql()})" for r in rules]])
        rest, held = grow.where(left), prune.where(left)
        r = rest.agg(F.sum("bad").alias("p"), F.count(F.lit(1)).alias("n")).first()
        p, n = r["p"] or 0, (r["n"] or 0) - (r["p"] or 0)
        if p < least_support:
            break
        rule = Rule()
        while n > 0 and len(rule.conditions) < max_conditions:
            inside = rest.where(rule.sql())
            cuts = _cuts(inside, n_cuts)
            found = _best(_tables(inside, cuts), cuts, p, n)
            if found is None or found[0] <= 1e-9:
                break
            rule.conditions.append(found[1])
            p, n = _counts(rest, rule)[-1]
        if not rule.conditions:
            break
        covered = _counts(held, rule)
        worth = [(a - b) / (a + b) if a + b else -1.0 for a, b in covered]
        size = max(range(len(worth)), key=lambda i: (worth[i], -i)) + 1  # the shortest prefix with the best worth
        rule = Rule(rule.conditions[:size], *covered[size - 1])
        if rule.bad < least_support or rule.bad < least_precision * (rule.bad + rule.good):
            break
        rules.append(rule)
    return rules


def labelled_statistics(stats: DataFrame, labels: DataFrame, max_labelled: int = 200_000, seed: int = 7) -> DataFrame:
    """Features with ``bad`` and ``grow`` for at most about ``max_labelled`` labelled documents, two thirds to grow on.

    Documents whose base rule fails are decided already and do not train.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg((1 - F.max("quality")).alias("bad"))
    rows = known.count()
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1_000_000))
    if rows > max_labelled:
        known = known.where(place < int(1_000_000 * max_labelled / rows))
    split = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed + 1)), F.lit(3)) < 2
    return stats.where("NOT base_failed").join(known, "doc_id").select("bad", split.alias("grow"), *FEATURES)


def judge(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",), **learning) -> tuple[DataFrame, list[Rule]]:
    """Statistics with ``kept`` and ``rule`` (number of the rule that rejects) for every row, and the learned list."""
    keep = tuple(dict.fromkeys(("doc_id", *keep)))
    stats = staged(text_statistics(docs, *keep), "text-statistics")
    rules = learn_rules(staged(labelled_statistics(stats, labels), "labelled-statistics"), **learning)
    fired = decision_list(rules)
    return stats.withColumn("rule", fired).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()), rules


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows, _ = judge(docs, labels)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    # The caller's columns travel in one struct, so that no name of theirs meets one of the operator's.
    whole = F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("__row")
    rows, _ = judge(docs.select("doc_id", "text", whole), labels, keep=("__row",))
    return rows.where("kept").select("__row.*")
