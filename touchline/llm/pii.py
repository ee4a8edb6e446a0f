"""Personal data: patterns for direct identifiers, and terms that give a protected entity away.

Base spans (email, ip, card, phone) are found by pattern. Every value found is a protected entity. The corpus tells which
terms disclose it: with N documents, p(e) the share that hold e, p(t) the share that hold term t and p(t, e) the share that
hold both, the information that t gives about e is PMI(t, e) = log p(t, e) / (p(t) p(e)), and what there is to know is
IC(e) = -log p(e). A term discloses e when PMI(t, e) >= ``disclosed`` x IC(e), at any support: personal data mostly stands in
one text only. p(t) is smoothed by ``smoothing`` documents more than were seen, so a term met once tells a little less than
one that stands with e many times. A term is any word outside the base spans. Every occurrence of a disclosing term in any
text becomes a span of kind ``term``, with or without an identifier in that text, save where a base span covers it.
``sanitise`` replaces identifiers by their kind, generalises disclosing terms to their shape and removes those from
``removed`` x IC(e) on.

Word counts cover all words of all documents; they are aggregated by word hash before they are shuffled. A term of a text
can disclose only an entity of that text, so its count bounds which terms are paired at all: the bound follows from the
threshold and drops no pair above it. Disclosing terms are looked up in all texts by a bitmap of fixed size first, then by
a join, which takes out what the bitmap let through in vain. Entities and terms are kept as hashes.

Defined cases: a null text counts as empty and has no spans (``sanitise`` leaves it null); repeated rows and null ids are
documents like others; rows that repeat id and text get equal spans; an empty table gives no rows; extra columns are
ignored, and pass through ``sanitise``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import staged, text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: Fixed patterns. A digit run starts an address only at its first digit, which changes no match and keeps long runs linear.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\W_]+")
WORD_BREAK = r"[^\p{L}\p{N}]+"
#: Bits of the bitmap of disclosing terms (4 MB), in buckets of Spark's bitmap functions.
BITS, BUCKET_BITS = 1 << 25, 1 << 15
FOUND = (
    "doc_id long, text_key long, n_email long, n_ip long, n_card long, n_phone long, base string, base_sha256 string, "
    "entities array<string>, terms array<string>"
)
PLACES = "doc_id long, text_key long, word long, start int, stop int"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            last = found.end()
        at = text.find("@", max(at + 1, last))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _luhn(digits: str) -> bool:
    doubled = [d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2])]
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end (code points, end exclusive), by kind and start."""
    spans = [("email", a, b) for a, b in _emails(text)]
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            spans.append(("card", *m.span()))
    if "+" in text:
        spans += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return spans


def _entities(text: str, spans: list[tuple[str, int, int]]) -> list[str]:
    """Hashes of the different values found."""
    values = {f"{kind}:{text[a:b].lower() if kind == 'email' else _digits(text[a:b])}" for kind, a, b in spans}
    return sorted(hashlib.blake2b(v.encode(), digest_size=12).hexdigest() for v in values)


def _words(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int]]:
    """Lower-case word, start and end of every word that no span covers in part."""
    inside, at = sorted((a, b) for _, a, b in spans), 0
    ends = 0  # the furthest end of the spans that start before the word's end
    for m in WORD.finditer(text):
        while at < len(inside) and inside[at][0] < m.end():
            ends = max(ends, inside[at][1])
            at += 1
        if m.start() >= ends:
            yield m[0].lower(), m.start(), m.end()


def find_base(docs: DataFrame) -> DataFrame:
    """Base spans of every row; of rows that have some, the entities and the different words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                spans = base_spans(text)
                base = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
                count = [sum(k == kind for k, _, _ in spans) for kind in KINDS]
                terms = sorted({w for w, _, _ in _words(text, spans)}) if spans else []
                rows.append((*count, base, hashlib.sha256(base.encode()).hexdigest(), _entities(text, spans), terms))
            out = pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base", "base_sha256", "entities", "terms"])
            out.insert(0, "text_key", batch["text_key"].array)
            out.insert(0, "doc_id", batch["doc_id"].array)
            yield out

    text = text_or_empty()
    found = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_key"), text.alias("text")).mapInPandas(run, FOUND)
    return found.withColumn("terms", F.transform("terms", lambda t: F.xxhash64(t)))


def _distinct_words(text: Column) -> Column:
    """The different words in lower case, as :func:`_words` has them."""
    return F.array_distinct(F.transform(F.filter(F.split(text, WORD_BREAK), lambda w: w != ""), F.lower))


def _word_counts(docs: DataFrame) -> DataFrame:
    """Documents per word hash, over all words of all documents."""
    hashed = F.transform(_distinct_words(text_or_empty()), lambda w: F.xxhash64(w))
    return docs.select(F.explode(hashed).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n_term"))


def disclosing_terms(docs: DataFrame, found: DataFrame, disclosed: float = 0.9, removed: float = 0.98, smoothing: float = 0.1) -> DataFrame:
    """``word`` (hash) and ``drop`` (remove rather than generalise) of the terms above the disclosure threshold of an entity."""
    total = float(max(found.count(), 1))
    # Equal texts hold equal entities and terms: one row for each text, with the documents that have it.
    per_text = found.where(F.size("entities") > 0).groupBy("text_key").agg(
        F.count(F.lit(1)).alias("n"), F.any_value("entities").alias("entities"), F.any_value("terms").alias("terms")
    )
    per_text = staged(per_text, "entity-texts")
    entities = per_text.select("text_key", "n", F.explode("entities").alias("entity"))
    held = staged(entities.groupBy("entity").agg(F.sum("n").alias("n_entity")), "entities")
    known = staged(entities.join(held, "entity").where(F.col("n_entity") < total), "known-entities")
    # told >= disclosed x known means n_both / (n_term + smoothing) >= (n_entity / total) ** (1 - disclosed), and n_both is
    # n_entity at most; a margin covers rounding.
    most = known.groupBy("text_key").agg(F.max("n_entity").alias("most"))
    bound = F.col("most") * F.pow(total / F.col("most"), F.lit(1.0 - disclosed)) * (1 + 1e-9)
    words = per_text.join(most, "text_key").select("text_key", "n", bound.alias("bound"), F.explode("terms").alias("word"))
    seen = staged(words.select("word").distinct(), "entity-words")
    counts = staged(seen.join(_word_counts(docs), "word", "left"), "word-counts")
    rare = words.join(counts, "word").where(F.coalesce("n_term", F.lit(0)) <= F.col("bound"))
    rare = staged(rare.select("text_key", "word", "n_term"), "rare-words")
    pairs = rare.join(known, "text_key").groupBy("entity", "word").agg(
        F.sum("n").alias("n_both"), F.max("n_term").alias("n_term"), F.max("n_entity").alias("n_entity")
    )
    n_term = F.greatest(F.coalesce("n_term", "n_both"), F.col("n_both"))
    known_by = F.log(F.lit(total) / F.col("n_entity"))
    told = F.log(F.col("n_both") / (n_term + smoothing)) + known_by
    return pairs.where(told >= disclosed * known_by).groupBy("word").agg(F.max(told >= removed * known_by).alias("drop"))


def _bit(word: Column) -> Column:
    return F.pmod(word, F.lit(BITS))


def _bitmap(words: DataFrame) -> np.ndarray:
    """The bits of all words; its size does not depend on them."""
    bit = words.select(_bit(F.col("word")).alias("bit")).distinct()
    rows = bit.groupBy(F.floor(F.col("bit") / BUCKET_BITS).alias("bucket")).agg(
        F.bitmap_construct_agg(F.pmod(F.col("bit"), F.lit(BUCKET_BITS))).alias("bits")
    )
    out = np.zeros((BITS // BUCKET_BITS, BUCKET_BITS // 8), dtype=np.uint8)
    for row in rows.toLocalIterator():
        out[row["bucket"]] = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
    return out.reshape(-1)


def _places(docs: DataFrame, telling: DataFrame) -> DataFrame:
    """Place and ``drop`` of every occurrence of a disclosing term outside base spans, in all texts."""
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(telling))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = shared.value
        for batch in batches:
            rows = []
            for doc_id, key, text, words, hashes in batch.itertuples(index=False, name=None):
                at = np.asarray(hashes, dtype=np.int64)
                bit = at % BITS
                hit = np.flatnonzero(bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)
                if len(hit):
                    wanted = {words[i]: int(at[i]) for i in hit}
                    rows += [(doc_id, key, wanted[w], a, b) for w, a, b in _words(text, base_spans(text)) if w in wanted]
            out = pd.DataFrame(rows, columns=["doc_id", "text_key", "word", "start", "stop"])
            yield out.astype({"doc_id": "Int64"})

    text = text_or_empty()
    words = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_key"), text.alias("text"), _distinct_words(text).alias("words"))
    hashed = words.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    return staged(hashed.mapInPandas(run, PLACES), "term-places").join(telling, "word")


def find_spans(docs: DataFrame, disclosed: float = 0.9) -> DataFrame:
    """Counts, ``base_sha256`` and ``spans`` of every row; ``term_spans`` with the terms' places and what to do with them."""
    found = staged(find_base(docs), "base-spans")
    telling = staged(disclosing_terms(docs, found, disclosed), "disclosing-terms")
    marked = _places(docs, telling).groupBy("doc_id", "text_key", "start", "stop").agg(F.max("drop").alias("drop"))
    marked = marked.groupBy(F.col("doc_id").alias("__doc"), F.col("text_key").alias("__key")).agg(
        F.sort_array(F.collect_list(F.struct("start", "stop", "drop"))).alias("term_spans")
    )
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_key") == F.col("__key"))
    rows = found.drop("entities", "terms").join(staged(marked, "term-spans"), same, "left").drop("__doc", "__key")
    terms = F.coalesce(F.transform("term_spans", lambda t: F.concat_ws(":", F.lit("term"), t["start"], t["stop"])), F.array().cast("array<string>"))
    spans = F.array_join(F.concat(F.filter(F.split("base", ","), lambda x: x != ""), terms), ",")
    return rows.withColumn("spans", spans)


def spans_report(docs: DataFrame) -> DataFrame:
    return find_spans(docs).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def _shape(word: str) -> str:
    if word.isdigit():
        return "[NUMBER]"
    return "[NAME]" if word[:1].isupper() else "[TERM]"


def masked(text: str, base: list[tuple[str, int, int]], terms: list[tuple[int, int, bool]]) -> str:
    """The text with identifiers replaced by kind and terms generalised or removed; overlapping spans become one."""
    marks = [(a, b, f"[{k.upper()}]") for k, a, b in base] + [(a, b, "" if drop else _shape(text[a:b])) for a, b, drop in terms]
    out, at = [], 0
    for a, b, label in sorted(marks, key=lambda m: (m[0], -m[1])):
        if a >= at:
            out += [text[at:a], label]
        at = max(at, b)
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, disclosed: float = 0.9) -> DataFrame:
    """The rows of ``docs`` with ``text`` sanitised and all other columns as they are."""
    spans = find_spans(docs, disclosed).where("spans <> ''").select(F.col("doc_id").alias("__doc"), F.col("text_key").alias("__key"), "base", "term_spans")
    spans = staged(spans.dropDuplicates(["__doc", "__key"]), "spans")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__doc")) & (F.xxhash64(text_or_empty()) == F.col("__key"))
    joined = docs.join(spans.withColumnRenamed("base", "__base").withColumnRenamed("term_spans", "__terms"), same, "left")

    @F.pandas_udf("string")
    def mask(text: pd.Series, base: pd.Series, terms: pd.Series) -> pd.Series:
        def one(t, b, m):
            found = [(k, int(x), int(y)) for k, x, y in (s.split(":") for s in b.split(",") if s)]
            return masked(t, found, [(r["start"], r["stop"], r["drop"]) for r in (m if m is not None else [])])

        return pd.Series([one(*x) for x in zip(text, base, terms, strict=True)], dtype=object)

    clean = joined.where("__base IS NULL")
    dirty = joined.where("__base IS NOT NULL").withColumn("text", mask("text", "__base", "__terms"))
    return clean.unionByName(dirty).select(*docs.columns)
