"""Importance resampling towards a target distribution, with a head-tail vocabulary of hashed features.

Features of a text are its words and its pairs of neighbouring words, hashed by crc32 into buckets. The same totals for
all documents and for the target give every bucket a gain, the logarithm of its two smoothed shares; a document's weight
is the mean gain of its features, a seeded Gumbel draw makes its score, and the highest scores are drawn.

* Head: a word or pair is frequent if it holds a fixed share of all words, so the head has at most one over that share
  entries, whatever the size of the tables. It is found in one pass: blocks of words report what holds the share within
  them, and the sums of these reports decide. What is frequent overall is frequent in some block; what is not found costs
  time only, as every bucket is exact either way. Frequent words are broadcast with the state that crc32 has after them,
  frequent pairs with their bucket.
* Tail: any other word takes its crc directly; any other pair goes on from the state of its first word. Both kinds count
  in the same exact totals.

Buckets of all features are written once (two bytes each) and read for the totals and again for the weights. Ranks come
from a numbering over range partitions, so no task sorts the table.

Defined cases: a null or empty text has no features, weight 0 and is never drawn; a null ``doc_id`` draws as the empty id
and sorts first; repeated rows are documents of their own, ties of score and id go to the fewer features; an empty target
or table leaves the smoothing counts alone; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import staged
from touchline.operators.ordered import global_row_number

#: Bytes of words: digits, letters in lower case, and all bytes of characters beyond ASCII; any other byte is a space.
_WORD = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD else 32 for b in range(256))
HEAD_SHARE = 1 / 32_768
BLOCK_WORDS, MEMO_WORDS = 1 << 20, 500_000


@dataclass
class Head:
    """Frequent words with their crc states, and keys (first x words + second) and buckets of frequent pairs."""

    words: list[bytes] = field(default_factory=list)
    states: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint32))
    pair_keys: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    pair_buckets: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint16))


def split_words(text: str | None) -> list[bytes]:
    return text.encode().translate(_TABLE).split() if text else []


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Slices of the batches, of about ``BLOCK_WORDS`` words, with the words of each text."""
    for batch in batches:
        start, held, words = 0, 0, []
        for i, text in enumerate(batch.column("text").to_pylist()):
            words.append(split_words(text))
            held += len(words[-1])
            if held >= BLOCK_WORDS:
                yield batch.slice(start, i + 1 - start), words
                start, held, words = i + 1, 0, []
        if words:
            yield batch.slice(start), words


def _pairs(sizes: np.ndarray) -> np.ndarray:
    """Places of words that have a next word in their text."""
    inner = np.ones(int(sizes.sum()), bool)
    inner[(np.cumsum(sizes) - 1)[sizes > 0]] = False
    return np.flatnonzero(inner)


def find_head(texts: DataFrame, share: float, n_buckets: int) -> Head:
    """The head of ``texts`` (column ``text``); at most ``2 / share`` rows reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[bytes] = []
        inner: list[np.ndarray] = []
        held = 0

        def report() -> pa.RecordBatch:
            nonlocal pending, inner, held
            least = share * len(pending)
            found = Counter(pending)
            first, second, n = [b""], [None], [len(pending)]  # the empty word: all words
            for word, k in found.items():
                if k >= least:
                    first.append(word), second.append(None), n.append(k)
            frequent = {w: i for i, w in enumerate(first)}
            names = first.copy()
            ids = np.fromiter((frequent.get(w, 0) for w in pending), np.int64, held)
            at = np.concatenate(inner)
            keys = ids[at] * len(names) + ids[at + 1]
            keys, counts = np.unique(keys[(ids[at] > 0) & (ids[at + 1] > 0)], return_counts=True)
            for key, k in zip(keys[counts >= least].tolist(), counts[counts >= least].tolist(), strict=True):
                first.append(names[key // len(names)]), second.append(names[key % len(names)]), n.append(k)
            pending, inner, held = [], [], 0
            columns = [pa.array(first, pa.binary()), pa.array(second, pa.binary()), pa.array(n, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["a", "b", "n"])

        for _, words in _blocks(batches):
            inner.append(_pairs(np.array([len(w) for w in words], np.int64)) + held)
            pending.extend(itertools.chain.from_iterable(words))
            held = len(pending)
            if held >= BLOCK_WORDS:
                yield report()
        if held:
            yield report()

    counted = texts.select("text").mapInArrow(count, "a binary, b binary, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    counted = staged(counted, "head-counts")
    everything = F.lit(b"").cast("binary")
    total = counted.where(F.col("a") == everything).agg(F.sum("n")).first()[0] or 0
    rows = counted.where((F.col("a") != everything) & (F.col("n") >= share * total)).collect()
    words = sorted(bytes(r.a) for r in rows if r.b is None)
    number = {w: i for i, w in enumerate(words)}
    states = np.array([zlib.crc32(w) for w in words], np.uint32)
    pairs = sorted((number[bytes(r.a)] * len(words) + number[bytes(r.b)], bytes(r.b)) for r in rows if r.b is not None)
    buckets = [zlib.crc32(b" " + b, int(states[key // len(words)])) % n_buckets for key, b in pairs]
    return Head(words, states, np.array([k for k, _ in pairs], np.int64), np.array(buckets, np.uint16))


class Hasher:
    """Buckets of all features of a block of texts."""

    def __init__(self, head: Head, n_buckets: int):
        self.head, self.n_buckets = head, n_buckets
        self._reset()

    def _reset(self) -> None:
        self.number = {w: i for i, w in enumerate(self.head.words)}
        self.names, self.states = list(self.head.words), self.head.states.tolist()

    def buckets(self, words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of all texts one after another (words, then pairs) and the number of features of each text."""
        if len(self.names) > MEMO_WORDS + len(self.head.words):
            self._reset()
        number = self.number
        for word in set().union(*words).difference(number):
            number[word] = len(self.names)
            self.names.append(word)
            self.states.append(zlib.crc32(word))
        sizes = np.array([len(w) for w in words], np.int64)
        ids = np.fromiter(map(number.__getitem__, itertools.chain.from_iterable(words)), np.int64, int(sizes.sum()))
        at = _pairs(sizes)
        pair = self._pair_buckets(ids[at], ids[at + 1])
        single = (np.array(self.states, np.uint32) % np.uint32(self.n_buckets)).astype(np.uint16)[ids]
        n_pairs = np.maximum(sizes - 1, 0)
        owner = np.concatenate([np.repeat(np.arange(len(words)), sizes), np.repeat(np.arange(len(words)), n_pairs)])
        return np.concatenate([single, pair])[np.argsort(owner, kind="stable")], sizes + n_pairs

    def _pair_buckets(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        out, n, keys = np.empty(len(first), np.uint16), len(self.head.words), self.head.pair_keys
        tail = np.ones(len(first), bool)
        if len(keys):
            key = np.where((first < n) & (second < n), first * n + second, -1)
            place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            tail = keys[place] != key
            out[~tail] = self.head.pair_buckets[place[~tail]]
        rest, back = np.unique(first[tail] * (1 << 32) + second[tail], return_inverse=True)
        names, states, crc = self.names, self.states, zlib.crc32
        found = [crc(b" " + names[k & 0xFFFFFFFF], states[k >> 32]) for k in rest.tolist()]
        out[tail] = (np.array(found, np.uint32) % np.uint32(self.n_buckets)).astype(np.uint16)[back]
        return out


def features(texts: DataFrame, head: Head, n_buckets: int) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``buckets`` (little-endian 16-bit numbers) of every row."""
    shared = texts.sparkSession.sparkContext.broadcast(head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(shared.value, n_buckets)
        for part, words in _blocks(batches):
            found, counts = hasher.buckets(words)
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64) * 2
            data = found.astype("<u2").tobytes()
            packed = pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data)])
            n_words = pa.array([len(w) for w in words], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), n_words, pa.array(counts), packed.cast(pa.binary())], names=["doc_id", "n_words", "n_features", "buckets"])

    return texts.mapInArrow(run, "doc_id long, n_words long, n_features long, buckets binary")


def bucket_totals(rows: DataFrame, n_buckets: int) -> np.ndarray:
    """Occurrences of every bucket; one row per bucket reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for x in batch.column("buckets"):
                totals += np.bincount(np.frombuffer(x.as_buffer(), "<u2"), minlength=n_buckets)
        at = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(totals[at])], names=["bucket", "n"])

    out = np.zeros(n_buckets, np.int64)
    counted = rows.select("buckets").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in counted.collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of the smoothed shares' ratio, rounded down."""
    n = len(source)
    ratio = (target + 1.0) * (source.sum() + float(n)) / ((source + 1.0) * (target.sum() + float(n)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``weight``, the mean gain rounded down."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [int(gain[np.frombuffer(x.as_buffer(), "<u2")].sum()) for x in batch.column("buckets")]
            counts = batch.column("n_features").to_pylist()
            weight = pa.array([s // n if n else 0 for s, n in zip(sums, counts, strict=True)], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "n_words", "n_features")), weight], names=["doc_id", "n_words", "n_features", "weight"])

    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def _draw(seed: int) -> Column:
    """Thousandths of a Gumbel variate seeded by the row's id, rounded down."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, n_buckets: int = 10_000, seed: int = 7
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` of every document and the ``rank`` of those drawn."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    wanted = target.select(F.lit(None).cast("long").alias("doc_id"), "text")
    head = find_head(rows, HEAD_SHARE, n_buckets)
    source = staged(features(rows, head, n_buckets), "features")
    gain = gains(bucket_totals(source, n_buckets), bucket_totals(features(wanted, head, n_buckets), n_buckets))
    scored = weigh(source, gain).withColumn("score", F.col("weight") + _draw(seed))
    able = F.col("n_words") >= least_words
    # Documents that cannot be drawn sort last.
    numbered = global_row_number(scored.withColumns({"_short": ~able, "_down": -F.col("score")}), ["_short", "_down", "doc_id", "n_features"])
    drawn = percent * source.where(able).count() // 100
    rank = F.when(~F.col("_short") & (F.col("row_no") <= drawn), F.col("row_no"))
    return numbered.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))
