"""Byte-level BPE by tree concatenation.

A long text is cut into halves until no part is longer than ``segment`` code points, wherever the cuts fall. The parts are
rows of their own, so that Spark encodes the halves of one text in parallel tasks; their ids are then joined up the tree.
A join encodes a window around the cut again and grows it until the new ids begin with the left side's id and end with
the right side's id at the window's ends (or the window reaches a text's end). That is exact: a sequence of ids is the
encoding of its bytes if every two neighbours are the encoding of theirs, and those two checks leave no new neighbours.

Windows begin and end where the tokenizer's pattern cannot change its mind: between a word and white space after it, or
inside a word but not before an apostrophe (contractions look ahead). They reach at least as far as the longest added
token on either side, so a special string that was cut is found again. Equal long texts are cut and encoded once.

Parts are encoded by a byte-pair library from the vocabulary of the tokenizer's file. Accepted are files with a byte-level
pre-tokenizer with its pattern and no prefix space, no normaliser, no dropout, merges in the order of their ids and special
strings without white space; any other file is refused. Padding, truncation and added special tokens play no part.

Defined cases: a null text counts as empty and has no ids; special strings inside a text are single ids, as by the
library's default; rows with null or repeated ids are encoded like others; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import byte_characters, text_or_empty

#: Characters that the tokenizer's pattern takes as white space (Unicode White_Space).
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: The standard pattern of byte-level tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK_CHARS = 1 << 20
#: Code points of a part: less than a tenth of a second of work, below which dealing parts out costs more than it saves.
SEGMENT = 65_536
LEAST_WINDOW = 16


class TreeEncoder:
    """Ids of texts, and of neighbouring texts together by growing windows."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pattern = spec["model"], spec.get("pre_tokenizer") or {}
        added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        plain = model["type"] == "BPE" and not (spec.get("normalizer") or model.get("dropout") or model.get("ignore_merges"))
        if not (plain and pattern.get("type") == "ByteLevel" and pattern.get("use_regex", True) and not pattern.get("add_prefix_space")):
            raise ValueError("not a byte-level tokenizer with the standard pattern")
        if any(set(s) & set(SPACE) for s in added):
            raise ValueError("a special string must not hold white space")
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if merged != sorted(set(merged)):
            raise ValueError("merges must be in the order of their ids")
        value = {c: b for b, c in byte_characters().items()}
        ranks = {bytes(value[c] for c in token): i for token, i in model["vocab"].items()}
        self.encoding = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
        self.least = max([LEAST_WINDOW, *(len(s.encode()) + 3 for s in added)])
        self.bytes_of = [b""] * (max([*ranks.values(), *added.values()]) + 1)
        for b, i in [*ranks.items(), *((s.encode(), i) for s, i in added.items())]:
            self.bytes_of[i] = b

    def encode(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, allowed_special="all").astype(np.int32)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")

    def _left(self, ids: np.ndarray, size: int) -> tuple[int, bytes]:
        """The last place with at least ``size`` bytes after it where a window may begin, and the bytes from there."""
        tail, at = b"", len(ids)
        while at:
            at -= 1
            tail = self.bytes_of[ids[at]] + tail
            if len(tail) >= size and self._may_begin(self.bytes_of[ids[at - 1]] if at else b"", tail):
                break
        return at, tail

    @staticmethod
    def _may_begin(before: bytes, tail: bytes) -> bool:
        head = tail[:4].decode("utf-8", "ignore")
        if not head or 0x80 <= tail[0] < 0xC0:
            return False
        if head[0] not in SPACE:
            return head[0] != "'"
        return before[-1:].isalnum() and before.isascii()  # white space after a word: always a boundary

    def _right(self, ids: np.ndarray, size: int) -> tuple[int, bytes]:
        """The first place with at least ``size`` bytes before it where a window may end, and the bytes up to there."""
        parts, held = [], 0
        for at, i in enumerate(ids.tolist(), 1):
            parts.append(self.bytes_of[i])
            held += len(parts[-1])
            if held >= size:
                head = b"".join(parts)
                if at == len(ids) or self._may_end(head, self.bytes_of[ids[at]]):
                    return at, head
        return len(ids), b"".join(parts)

    @staticmethod
    def _may_end(head: bytes, after: bytes) -> bool:
        if 0x80 <= after[0] < 0xC0:
            return False
        last = head[-4:].decode("utf-8", "ignore")
        return bool(last) and last[-1] not in SPACE

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ids of two neighbouring texts together."""
        if not len(left) or not len(right):
            return left if len(left) else right
        size = self.least
        while True:
            (i, tail), (j, head) = self._left(left, size), self._right(right, size)
            middle = self.encode((tail + head).decode())
            agree = (i == 0 or middle[0] == left[i]) and (j == len(right) or middle[-1] == right[j - 1])
            if agree:
                return np.concatenate([left[:i], middle, right[j:]])
            size *= 2

    def join_all(self, parts: list[np.ndarray]) -> np.ndarray:
        """Neighbours are joined in pairs, level by level."""
        while len(parts) > 1:
            parts = [self.join(*parts[k : k + 2]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
        return parts[0] if parts else np.empty(0, np.int32)


_ENCODERS: dict[str, TreeEncoder] = {}


def _encoder(path: str) -> TreeEncoder:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = TreeEncoder(path)
    return _ENCODERS[path]


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive blocks of about a megabyte of text."""
    start = 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and size < BLOCK_CHARS:
            size, stop = size + len(texts[stop]), stop + 1
        yield start, stop
        start = stop


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    bounds = np.cumsum([0, *map(len, ids)])
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int32), *ids])))


def _encoded(rows: DataFrame, tokenizer: str) -> DataFrame:
    """``rows`` with their last column, ``text``, replaced by ``ids``."""
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "ids array<int>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in _blocks(texts):
                columns = [batch.column(f.name).slice(a, b - a) for f in kept]
                yield pa.RecordBatch.from_arrays([*columns, _lists([encoder.encode(t) for t in texts[a:b]])], names=[*(f.name for f in kept), "ids"])

    return rows.mapInArrow(run, schema)


def _halves(text: Column, segment: int) -> Column:
    """The parts of a text after halving it until none is longer than ``segment``."""
    size = F.char_length(text)
    parts = F.pow(F.lit(2.0), F.ceil(F.log2(size / F.lit(float(segment))))).cast("long")
    bound = lambda i: F.floor(i * size / parts).cast("int")
    return F.transform(
        F.sequence(F.lit(0).cast("long"), parts - 1), lambda i: F.substring(text, bound(i) + 1, bound(i + 1) - bound(i))
    )


def encode(docs: DataFrame, tokenizer: str, segment: int = SEGMENT) -> DataFrame:
    """``doc_id`` and ``ids`` of every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    short = _encoded(rows.where(F.char_length("text") <= segment), tokenizer)
    key = [F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b"), F.octet_length("text").alias("c")]
    long = rows.where(F.char_length("text") > segment).select("doc_id", *key, "text")
    parts = long.select("a", "b", "c", F.posexplode(_halves(F.col("text"), segment)).alias("at", "text"))
    leaves = _encoded(parts.dropDuplicates(["a", "b", "c", "at"]), tokenizer)

    def up(group: pd.DataFrame) -> pd.DataFrame:
        ids = group.sort_values("at")["ids"].tolist()
        joined = _encoder(tokenizer).join_all([np.asarray(x, np.int32) for x in ids])
        return pd.DataFrame({"a": group["a"].iloc[:1], "b": group["b"].iloc[:1], "c": group["c"].iloc[:1], "ids": [joined]})

    trees = leaves.groupBy("a", "b", "c").applyInPandas(up, "a long, b long, c int, ids array<int>")
    return short.unionByName(long.select("doc_id", "a", "b", "c").join(trees, ["a", "b", "c"]).select("doc_id", "ids"))


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``text``, the decoded ids (special tokens included); null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            ids = batch.column("ids")
            values, bounds = ids.values.to_numpy(), ids.offsets.to_numpy()
            texts = [encoder.decode(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            text = pa.array(texts, pa.string(), mask=ids.is_null().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, text], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def tree_report(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the digests of the ids and of the text decoded from them."""
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decode(encode(docs, tokenizer), tokenizer).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
