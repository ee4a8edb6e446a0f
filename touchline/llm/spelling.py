"""Spelling variants: words one edit apart, found in a reduced alphabet and verified on the original strings.

Words are counted over all texts. Letters are hashed to ``k`` symbols, so a word becomes a reduced word and many words share
one. For every distinct reduced word its full one-edit neighbourhood over the ``k`` symbols is generated (each place deleted,
replaced by each symbol, each symbol inserted at each place; a letter replaced by one of its own symbol leaves the reduced
word as it is), joined with the reduced vocabulary, and the words on both sides are compared letter by letter.

An edit leaves either the first or the last letters in place. Reduced words therefore carry an anchor: edits behind the
first ``a`` letters are looked up under those letters, edits within them under the last ``a``, where ``a`` is less than half
of the least length. Every edit is generated once, and a frequent reduced word is spread over its anchors.

``k`` follows the vocabulary: the smallest for which the cells (anchors times reduced words of mean length) are as many as
the words, so that words per cell do not grow with the table. The letter hash is the one of a few seeds that spreads the
letters of this vocabulary best. Both change costs only, never the result.

A word's form is its most frequent near word if that is ``ratio`` times as frequent. Counts grow by that factor along a
chain of forms, so chains are short and doubling the step a known number of times reaches every root.

Defined cases: a null or empty text has no words; a null ``doc_id`` counts as an empty one where ids enter the word's hash;
repeated rows count again; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import staged, text_or_empty

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0123456789"
SEEDS = 256


def words_of(docs: DataFrame, least_chars: int, every: int) -> DataFrame:
    """``word`` of every run of letters with at least ``least_chars`` code points.

    Where ``every`` divides the crc32 of ``<doc_id>:<run>``, the run loses the code point at that number modulo its length
    (``every`` 0: none does).
    """
    found = F.regexp_extract_all(text_or_empty(), F.lit(f"[A-Za-zÀ-ÿ]{{{least_chars},}}"), F.lit(0))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key")
    runs = docs.select(key, F.explode(found).alias("run")).select("key", F.translate("run", UPPER, LOWER).alias("run"))
    if not every:
        return runs.select(F.col("run").alias("word"))
    hashed = runs.select("run", F.crc32(F.concat_ws(":", "key", "run").cast("binary")).alias("h"))
    place = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), place), F.substring(F.col("run"), place + 2, F.char_length("run")))
    word = F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).where(F.char_length("word") >= least_chars)


def choose_alphabet(words: DataFrame, anchor: int) -> tuple[str, str]:
    """Letters of the vocabulary and the symbol of each: as many symbols as the vocabulary needs."""
    letters = {r[0]: r[1] for r in words.select(F.explode(F.split("word", "")).alias("c")).groupBy("c").count().collect() if r[0]}
    size, total = words.count(), sum(letters.values())
    if not size:
        return "", ""
    anchors = words.select(F.substring("word", 1, anchor)).distinct().count()
    spare = max(1.0, total / size - anchor)
    k = min(len(SYMBOLS), max(2, math.ceil(max(1.0, size / anchors) ** (1 / spare))))

    def load(seed: int) -> list[int]:
        out = [0] * k
        for c, n in letters.items():
            out[zlib.crc32(f"{seed}{c}".encode()) % k] += n
        return out

    best = min(range(SEEDS), key=lambda s: sum(x * x for x in load(s)))
    names = sorted(letters)
    return "".join(names), "".join(SYMBOLS[zlib.crc32(f"{best}{c}".encode()) % k] for c in names)


def _edits(word: Column, first: Column, last: Column, symbols: str) -> Column:
    """Distinct results of one edit at the places ``first`` to ``last``, insertions before them (from 1)."""
    before = lambda i: F.substring(word, F.lit(1), i - 1)
    after = lambda i: F.substring(word, i, F.char_length(word))
    places = F.filter(F.sequence(first, last), lambda i: i <= F.char_length(word))
    deleted = F.transform(places, lambda i: F.concat(before(i), after(i + 1)))
    replaced = lambda s: F.transform(places, lambda i: F.concat(before(i), F.lit(s), after(i + 1)))
    inserted = lambda s: F.transform(F.sequence(first, last), lambda i: F.concat(before(i), F.lit(s), after(i)))
    return F.array_distinct(F.concat(deleted, *map(replaced, symbols), *map(inserted, symbols)))


def near_pairs(words: DataFrame, least_chars: int) -> DataFrame:
    """``word``, ``near``, ``near_n`` for all pairs of ``words`` (``word``, ``n``) one edit apart, in both directions."""
    anchor = (least_chars - 1) // 2
    letters, symbols = choose_alphabet(words, anchor)
    used = "".join(sorted(set(symbols))) or "a"
    reduced = words.select("word", "n", F.translate("word", letters, symbols).alias("reduced"))
    sides = F.explode(F.array(*(
        F.struct(F.lit(side).alias("side"), part.alias("anchor"))
        for side, part in enumerate((F.substring("word", 1, anchor), F.substring("word", -anchor, anchor)))
    ))).alias("at")
    cell = lambda r: F.xxhash64("side", "anchor", r).alias("cell")
    placed = reduced.select("word", "n", "reduced", sides).select("word", "n", "reduced", "at.*")
    members = staged(placed.select(cell("reduced"), "side", "anchor", "reduced", "word", "n"), "cells")
    cells = members.select("cell", "side", "anchor", "reduced").dropDuplicates(["cell"])
    tail = _edits(F.col("reduced"), F.lit(anchor + 1), F.char_length("reduced") + 1, used)
    head = _edits(F.col("reduced"), F.lit(1), F.lit(anchor), used)
    around = cells.select(
        F.col("cell").alias("from"), "side", "anchor", F.explode(F.when(F.col("side") == 0, tail).otherwise(head)).alias("to")
    )
    links = around.select("from", cell("to")).join(cells.select("cell"), "cell", "left_semi")
    # The cell's words on one side, then on the other; only verified pairs leave the last join.
    left = links.join(members.select(F.col("cell").alias("from"), "side", "word"), "from").select("cell", "side", "word")
    both = left.join(members.select("cell", F.col("word").alias("near"), F.col("n").alias("near_n")), "cell")
    apart = F.levenshtein("word", "near", 1) == 1
    other = F.substring("word", 1, anchor) != F.substring("near", 1, anchor)
    return both.where(apart & ((F.col("side") == 0) | other)).select("word", "near", "near_n")


def variant_groups(
    docs: DataFrame, least_chars: int = 7, least_n: int = 2, ratio: int = 10, every: int = 31
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for every word that occurs ``least_n`` times."""
    counted = words_of(docs, least_chars, every).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    words = staged(counted.where(F.col("n") >= least_n), "words")
    pairs = near_pairs(words, least_chars)
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("near_n"), "near")).alias("best"))
    enough = -F.col("best.col1") >= ratio * F.col("n")
    found = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.col1")).alias("form_n"),
    )
    found = staged(found, "forms")
    most = found.agg(F.max("n")).first()[0] or 1
    hops = math.floor(math.log(most, ratio)) + 1  # n grows by the ratio with every hop
    steps = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(hops + 1))):
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = staged(steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return found.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
