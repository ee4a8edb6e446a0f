"""Mixing to target weights with soft membership.

A classifier fitted on the labelled table gives every document a posterior over domains; nonnegative rates are then
fitted so that the expected token total of each domain, sum of rate x tokens x posterior, meets its target. Documents share
a rate by cells of a grid over the posteriors; one distributed aggregation returns the cells' exact token sums, and
accelerated projected gradient steps on the weighted squared residuals run over these, to the end. Steps move a rate by
its posteriors only (gradient in the metric of token counts), hence the rates of long and short documents of one kind are
equal. The residual of every domain is part of the result: a target out of reach shows there.

The classifier is naive Bayes over the presence and absence of words, kept to the ``n_terms`` terms that mark a domain most, and
three marks of text shape. It is fitted on at most about ``max_labelled`` labelled documents, chosen by hash (documented bounds); its
table is small and becomes part of the plan. Posteriors, totals and rates cover every row.

Rates become whole copies by seeded hash: the integer part, and one more with the probability of the rest.

Defined cases: a null or empty text has no tokens and the prior as posterior, its rate moves like others; without usable
labels every posterior is uniform; a domain without any expected tokens is left out of the fit, one
with too few misses its target and leaves the others theirs; null
labels are ignored, of several labels for one id toxic wins over low over clean; null and repeated ids are documents like
others, equal rows get equal rates; an empty table gives no rows; extra columns pass through ``mix``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import let, staged, text_or_empty

DOMAINS = ("clean", "low", "toxic")
#: Within reach of a classifier that leaves every clean document some doubt: smaller shares would be met by a few documents.
WEIGHTS = {"clean": 0.95, "low": 0.03, "toxic": 0.02}
WORD_BREAK = r"[^\p{L}\p{N}']+"


def _words(text: Column) -> Column:
    """Words in lower case; an empty one may stand at either end and is no term."""
    return F.split(F.lower(text), WORD_BREAK)


def _marks(text: Column, words: Column, distinct: Column) -> Column:
    """Marks of shape that count as terms (no word starts with ``#``)."""
    n = F.size(words)
    marks = (
        ("#symbols", F.regexp_count(text, F.lit(r"[#*$%&|<>!=_~^]")) > 0.2 * n),
        ("#capitals", F.regexp_count(text, F.lit(r"\p{Lu}")) > 0.4 * F.char_length(text)),
        ("#repeats", F.size(distinct) < 0.3 * n),
    )
    return F.filter(F.array(*[F.when(test, F.lit(name)) for name, test in marks]), lambda x: x.isNotNull())


def _terms(text: Column) -> Column:
    """The distinct words and marks of a text."""

    def of(words: Column) -> Column:
        return let(F.array_distinct(words), lambda d: F.concat(d, _marks(text, words, d)))

    return F.filter(let(_words(text), of), lambda t: t != "")


@dataclass(frozen=True)
class DomainModel:
    """Per domain the log score of a document with none of the terms, and what the presence of each term adds."""

    domains: tuple[str, ...]
    start: tuple[float, ...]
    terms: dict[str, tuple[float, ...]]

    def posteriors(self, text: Column) -> Column:
        """An array of posteriors in the order of ``domains``."""
        start = F.array(*[F.lit(float(p)) for p in self.start])
        scores = start
        if self.terms:
            names = sorted(self.terms)
            known = F.array(*[F.lit(t) for t in names])
            weights = F.array(*[F.array(*[F.lit(float(x)) for x in self.terms[t]]) for t in names])
            table = F.map_from_arrays(known, weights)
            scores = F.aggregate(F.array_intersect(_terms(text), known), start, lambda a, t: F.zip_with(a, F.element_at(table, t), lambda x, y: x + y))

        def softmax(s: Column) -> Column:
            top = F.array_max(s)
            return let(
                F.transform(s, lambda x: F.exp(x - top)),
                lambda e: F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y)),
            )

        return let(scores, softmax)


def fit_domains(
    docs: DataFrame, labels: DataFrame, n_terms: int = 512, max_labelled: int = 20_000, least_documents: int = 5,
    least_surprise: float = 4.0, least_lift: float = 2.0, seed: int = 3,
) -> DomainModel:
    """The classifier from ``labels`` (``doc_id``, ``quality``, ``toxic``): toxic, else low (quality 0), else clean."""
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0)
    usable = labels.where("doc_id IS NOT NULL AND (quality IN (0, 1) OR toxic = 1)")
    known = usable.groupBy("doc_id").agg(F.max(domain).alias("domain"))
    rows = known.count()
    if rows > max_labelled:
        share = int(1_000_000 * max_labelled / rows)
        known = known.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1_000_000)) < share)
    known = staged(known, "labelled-domains")
    # At most about max_labelled rows of 12 bytes.
    labelled = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(known), "doc_id")
    labelled = staged(labelled.select("domain", _terms(F.col("text")).alias("terms")), "labelled-terms")
    size = {r["domain"]: r["n"] for r in labelled.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    k = range(len(DOMAINS))
    total = sum(size.values())
    if not total:
        return DomainModel(DOMAINS, tuple(0.0 for _ in k), {})
    priors = tuple(math.log((size.get(i, 0) + 0.5) / (total + 0.5 * len(DOMAINS))) for i in k)
    counted = labelled.select("domain", F.explode("terms").alias("term")).groupBy("term").agg(
        *[F.sum(F.when(F.col("domain") == i, 1).otherwise(0)).alias(f"n{i}") for i in k]
    )
    overall = (sum(F.col(f"n{i}") for i in k) + 0.5) / (total + 1.0)
    weights, absences, telling = [], [], F.lit(0.0)
    for i in k:
        n = size.get(i, 0)
        surprise = (F.col(f"n{i}") - n * overall) / F.sqrt(n * overall + 0.5)
        share = (F.col(f"n{i}") + 10.0 * overall) / (n + 10.0)  # shrunk towards all documents
        # Chosen are terms that mark some domain: more than chance explains, and by a clear factor. Common words lack here
        # and there for other reasons (another language), and their absences would add up.
        real = (surprise > least_surprise) & (share > least_lift * overall)
        telling = telling + F.when(real, surprise * surprise).otherwise(0.0)
        absences.append(F.log((1.0 - share) / (1.0 - overall)))
        weights.append(F.log(share / overall) - absences[-1])
    chosen = counted.where(" + ".join(f"n{i}" for i in k) + f" >= {least_documents}").select(
        "term", telling.alias("telling"), *[w.alias(f"w{i}") for i, w in enumerate(weights)], *[x.alias(f"a{i}") for i, x in enumerate(absences)]
    ).where("telling > 0").orderBy(F.desc("telling"), "term").limit(n_terms).collect()
    start = tuple(priors[i] + sum(r[f"a{i}"] for r in chosen) for i in k)
    return DomainModel(DOMAINS, start, {r["term"]: tuple(r[f"w{i}"] for i in k) for r in chosen})


@dataclass(frozen=True)
class RateFit:
    """Rates of the cells of a grid over the posteriors, and by how much each domain misses its target (a share of it)."""

    grid: int
    rates: dict[int, float]
    misses: list[float]

    def rate(self, posteriors: Column) -> Column:
        if not self.rates:
            return F.lit(1.0)
        cells = [self.rates.get(cell, 1.0) for cell in range((self.grid + 1) ** (len(self.misses) - 1))]
        return F.element_at(F.array(*[F.lit(float(x)) for x in cells]), _cell(posteriors, len(self.misses), self.grid) + 1)


def _cell(posteriors: Column, k: int, grid: int) -> Column:
    """The cell of the grid over all posteriors but the first, which follows from the others."""
    cell = F.lit(0)
    for i in range(1, k):
        cell = cell + F.round(F.get(posteriors, F.lit(i)) * grid).cast("int") * (grid + 1) ** (i - 1)
    return cell


def fit_rates(
    rows: DataFrame, weights: list[float], total: float | None = None, grid: int = 32, most_steps: int = 100_000, tolerance: float = 1e-6
) -> RateFit:
    """``rows``: ``n_tokens`` and ``posteriors``. ``total``: tokens wanted in all (as many as there are, if not given).

    Documents of one cell of the grid have one rate. One distributed aggregation returns every cell's tokens per domain,
    which are exact sums of posteriors, so the fit meets the targets of the documents and not of cell centres; at most
    ``(grid + 1)`` to the power of the domains less one rows reach the driver, and a step costs no scan. Accelerated
    projected gradient steps start at rate one and end when every domain is within ``tolerance`` of its own target, or the
    rates stand still at the least-squares optimum of targets out of reach.
    """
    k = range(len(weights))
    p = [F.get("posteriors", F.lit(i)) for i in k]
    cells = rows.where("n_tokens > 0").groupBy(_cell(F.col("posteriors"), len(weights), grid).alias("cell"))
    summed = cells.agg(F.sum(F.col("n_tokens").cast("double")).alias("t"), *[F.sum(F.col("n_tokens") * p[i]).alias(f"s{i}") for i in k])
    found = sorted(summed.collect(), key=lambda r: r["cell"])
    if not found:
        return RateFit(grid, {}, [0.0 for _ in k])
    tokens = np.array([r["t"] for r in found])
    sums = np.array([[r[f"s{i}"] for i in k] for r in found])
    means = sums / tokens[:, None]
    want = np.array(weights) * (total or tokens.sum())
    gram = sums.T @ means
    reach = np.diag(gram)
    # A domain weighs by its target, or by what moving it takes where that is more, so that the problem is well scaled. A
    # domain without tokens is left out.
    scale = np.where(reach > 0, 1.0 / np.maximum(np.maximum(reach, want), 1e-300), 0.0)
    root = np.sqrt(scale)
    largest = np.linalg.eigvalsh(root[:, None] * gram * root[None]).max() or 1.0
    rate = ahead = np.ones(len(found))
    pace = 1.0
    for _ in range(most_steps):
        fresh = np.maximum(0.0, ahead - means @ (scale * (sums.T @ ahead - want)) / largest)
        if (tokens * (ahead - fresh) * (fresh - rate)).sum() > 0:  # the momentum points uphill: start it anew
            pace, ahead = 1.0, fresh
        else:
            following = (1.0 + math.sqrt(1.0 + 4.0 * pace * pace)) / 2.0
            ahead, pace = fresh + (pace - 1.0) / following * (fresh - rate), following
        moved, rate = np.abs(fresh - rate).max(), fresh
        miss = np.where(scale > 0, sums.T @ rate - want, 0.0) / np.where(want > 0, want, want.sum())
        if np.abs(miss).max() < tolerance or moved < 1e-12:
            break
    return RateFit(grid, {r["cell"]: float(x) for r, x in zip(found, rate, strict=True)}, miss.tolist())


def _columns(docs: DataFrame, labels: DataFrame) -> tuple[DomainModel, Column, Column]:
    """The classifier, a column of tokens (white-space words) and one of posteriors."""
    model, text = fit_domains(docs, labels), text_or_empty()
    return model, F.regexp_count(text, F.lit(r"\S+")).cast("long"), model.posteriors(text)


def _key(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))


def _copies(rate: str, key: Column) -> Column:
    whole = F.floor(rate)
    chance = F.pmod(key, F.lit(1 << 30)) / float(1 << 30)
    return (whole + F.when(chance < F.col(rate) - whole, 1).otherwise(0)).cast("int")


def mixing_report(docs: DataFrame, labels: DataFrame, weights: dict[str, float] = WEIGHTS, total: float | None = None, seed: int = 5) -> DataFrame:
    """``doc_id``, ``n_tokens`` (white-space words), a posterior per domain, ``rate`` and ``copies`` for every row, and by how
    much each domain's expected tokens miss their target (a share of it; the same in every row)."""
    model, tokens, posteriors = _columns(docs, labels)
    rows = staged(docs.select("doc_id", _key(seed).alias("key"), tokens.alias("n_tokens"), posteriors.alias("posteriors")), "posteriors")
    fit = fit_rates(rows, [weights[d] for d in model.domains], total)
    rated = rows.withColumn("rate", fit.rate(F.col("posteriors")))
    return rated.select(
        "doc_id", "n_tokens", *[F.get("posteriors", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(model.domains)],
        "rate", _copies("rate", F.col("key")).alias("copies"),
        *[F.lit(float(miss)).alias(f"miss_{d}") for d, miss in zip(model.domains, fit.misses, strict=True)],
    )


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float] = WEIGHTS, total: float | None = None, seed: int = 5) -> DataFrame:
    """The rows of ``docs``, each as often as its rate says, with all columns."""
    model, tokens, posteriors = _columns(docs, labels)
    rows = staged(docs.select(tokens.alias("n_tokens"), posteriors.alias("posteriors")), "posteriors")
    fit = fit_rates(rows, [weights[d] for d in model.domains], total)
    # The rate is bound by name and sits in a one-element explode: else the optimiser would put the posteriors into every
    # step of the fold, and the rate a second time into the filter on it.
    rated = docs.select("*", F.explode(F.array(let(posteriors, fit.rate))).alias("__rate"))
    copies = rated.withColumn("__copies", _copies("__rate", _key(seed))).where("__copies > 0")
    return copies.withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)
