"""Exact token counts of every prefix, by dynamic programming.

A text falls into units: a run of white space with the word after it. The tokenizer's pattern never joins the two sides
of a boundary between a non-space and a space, so the count of a prefix is the count of the whole units before it (a
running sum, kept per document) plus the count of a prefix of one unit. Inside a unit the counts of all prefixes come from
the recurrence of byte-pair encoding: the encoding of s[:e] ends in the one token t for which the encoding of s[:e-|t|] ends
in a token that stays apart from t, so count[e] = count[e-|t|] + 1. Truncation and budget questions are answered from these
tables without encoding the text again. The library encodes each distinct unit once per worker (a bounded memo).

Defined cases: a null text counts as empty and has no tokens; special strings inside a text are single tokens, as by the
library's default; a cut inside a unit that holds a special string falls on a token boundary; repeated rows and null ids
are reported like others; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import byte_characters, text_or_empty

#: Characters that the tokenizer's pattern takes as white space (Unicode White_Space).
SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
UNIT = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
LEADING = re.compile(f"[{SPACE}]*")
MEMO_ENTRIES, MEMO_CHARS = 400_000, 48


class PrefixCounter:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.bytes = byte_characters()
        self.vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.longest = max(map(len, self.vocabulary), default=1)
        self.memo: dict[str, int] = {}
        self.apart: dict[tuple[str, str], bool] = {}

    def unit_counts(self, texts: list[str]) -> list[tuple[list[str], list[int]]]:
        """Per text its units and their token counts."""
        split = [UNIT.findall(t) for t in texts]
        if len(self.memo) > MEMO_ENTRIES:
            self.memo = {}
        memo = self.memo
        missing = list(set().union(*split).difference(memo))
        memo.update(zip(missing, map(len, self.tokenizer.encode_batch_fast(missing, add_special_tokens=False)), strict=True))
        out = [(units, list(map(memo.__getitem__, units))) for units in split]
        for unit in missing:
            if len(unit) > MEMO_CHARS:
                del memo[unit]
        return out

    def _stay_apart(self, a: str, b: str) -> bool:
        found = self.apart.get((a, b))
        if found is None:
            if len(self.apart) > MEMO_ENTRIES:
                self.apart = {}
            found = self.apart[a, b] = [t.value for t in self.tokenizer.model.tokenize(a + b)] == [a, b]
        return found

    def piece_prefixes(self, piece: str) -> list[int]:
        """Counts of all byte prefixes of one pre-token (in stand-in characters), from 0 on."""
        count, last = [0], [""]
        for end in range(1, len(piece) + 1):
            for start in range(max(0, end - self.longest), end):
                token = piece[start:end]
                if token in self.vocabulary and count[start] >= 0 and (start == 0 or self._stay_apart(last[start], token)):
                    count.append(count[start] + 1)
                    last.append(token)
                    break
            else:
                count.append(-1)
                last.append("")
        return count

    def unit_prefixes(self, unit: str) -> list[int]:
        """Counts of the prefixes of one unit by code points, from the empty one on."""
        space = LEADING.match(unit).end()
        out, at = self._by_characters(unit[:space]), 0  # white space alone is one pre-token
        for _, (start, end) in self.tokenizer.pre_tokenizer.pre_tokenize_str(unit):
            part = unit[start:end]
            inner = self._by_characters(part)
            if part in ("'re", "'ve", "'ll"):
                inner[2] = 2  # a cut contraction is a mark and a letter
            out += [at + inner[k] for k in range(1, len(part) + 1) if start + k > space]
            at += inner[-1]
        return out

    def _by_characters(self, part: str) -> list[int]:
        counts = self.piece_prefixes("".join(self.bytes[b] for b in part.encode()))
        ends = [0, *accumulate(len(c.encode()) for c in part)]
        return [counts[e] for e in ends]

    def cut(self, units: list[str], counts: list[int], budget: int) -> int:
        """Code points of the longest prefix with at most ``budget`` tokens."""
        total = chars = 0
        for unit, n in zip(units, counts, strict=True):
            if total + n > budget:
                break
            total, chars = total + n, chars + len(unit)
        else:
            return chars
        left = budget - total
        if any(s in unit for s in self.special):
            ends = [b for _, b in self.tokenizer.encode(unit, add_special_tokens=False).offsets]
            return chars + (ends[left - 1] if left else 0)
        inner = self.unit_prefixes(unit)
        return chars + max(k for k, n in enumerate(inner) if n <= left)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512, with_prefixes: bool = False) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` and ``cut_chars``: code points of the longest prefix within
    ``limit`` tokens. ``with_prefixes`` adds ``unit_ends`` and ``unit_counts``: the running sums that answer any budget."""
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, cut_chars long"
    schema += ", unit_ends array<long>, unit_counts array<long>" if with_prefixes else ""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = PrefixCounter(tokenizer)
        for batch in batches:
            texts, start = batch["text"].tolist(), 0
            while start < len(texts):  # about a megabyte of text at a time
                stop, size = start, 0
                while stop < len(texts) and size < 1 << 20:
                    size, stop = size + len(texts[stop]), stop + 1
                part = batch.iloc[start:stop]
                found = counter.unit_counts(texts[start:stop])
                totals = [sum(n) for _, n in found]
                cuts = [counter.cut(u, n, limit) if t > limit else len(x) for (u, n), t, x in zip(found, totals, texts[start:stop], strict=True)]
                out = pd.DataFrame({
                    "doc_id": part["doc_id"].array, "n_bytes": part["n_bytes"].array, "n_tokens": totals,
                    "over_limit": [t > limit for t in totals], "cut_chars": cuts,
                })
                if with_prefixes:
                    out["unit_ends"] = [list(accumulate(map(len, u))) for u, _ in found]
                    out["unit_counts"] = [list(accumulate(n)) for _, n in found]
                yield out
                start = stop

    rows = docs.select(F.col("doc_id").cast("long"), F.octet_length(text_or_empty()).cast("long").alias("n_bytes"), text_or_empty().alias("text"))
    return rows.mapInPandas(run, schema)
