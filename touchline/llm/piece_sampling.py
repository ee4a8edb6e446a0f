"""Sampled SentencePiece segmentations: forward filtering, backward sampling over the piece lattice.

The model's pieces with Zipf weights by their rank (the file has ranks, not probabilities), to the power ``alpha``, define
a distribution over all segmentations of a text; alpha 0 makes every piece equally likely, a large alpha leaves the best
segmentation. A forward pass sums the weights of all paths to each position; a backward pass draws the pieces from the
end. No piece crosses the start of a run of spaces or a line end (nor, in most models, the line between a word and other
signs), so the lattice of a text is a chain of small lattices and the forward pass is done once per distinct part. Each
place of a part gets an alias table over the pieces that end there: a draw is one lookup and one comparison. The draws are
made for all parts of a block of documents at once.

Draws depend on the seed, the row key and the position only, so the same row gets the same pieces in any batch,
partition or rerun. Characters outside the vocabulary become byte pieces, as does a literal marker character, so decoding
gives back every text exactly.

Defined cases: a null text has null ids; an empty text has no ids; rows with equal key and text get equal ids; a null key
counts as key 0; very long parts without spaces take one linear pass; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
TABLE_PARTS = 200_000
#: A byte piece is taken only where no other piece fits.
BYTE_WEIGHT = 1e-12
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
BLOCK_CHARS = 2 << 20


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shift-multiply rounds)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def part_pattern(pieces: Iterable[str]) -> re.Pattern:
    """What cuts a text into parts that no piece crosses: words, other signs (both with the spaces before them), line ends.

    A word character that some piece joins with another sign counts as such a sign, as do the characters joined with it.
    """
    joined = {p for x in pieces for p in zip(x.lstrip(" "), x.lstrip(" ")[1:])}
    signs: set[str] = set()
    while True:
        kind = {c: bool(re.match(r"\w", c)) and c not in signs for pair in joined for c in pair}
        more = {c for pair in joined for c in pair if kind[pair[0]] != kind[pair[1]] and kind[c]}
        if not more:
            break
        signs |= more
    listed = "".join(map(re.escape, sorted(signs)))
    other = rf"(?:[^\w \n]|[{listed}])" if listed else r"[^\w \n]"
    return re.compile(rf" *[^\W{listed}]+| *{other}+| +|\n")


def _order(keys: np.ndarray) -> np.ndarray:
    """Stable order of nonnegative keys, 16 bits at a time (such sorts need no comparison)."""
    order = np.argsort((keys & 0xFFFF).astype(np.uint16), kind="stable")
    high = keys >> 16
    while high.any():
        order = order[np.argsort((high & 0xFFFF).astype(np.uint16)[order], kind="stable")]
        high = high >> 16
    return order


def _extended(table: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``more`` behind the ``used`` rows of a table that grows by doubling."""
    if used + len(more) > len(table):
        larger = np.empty((max(2 * len(table), used + len(more)), table.shape[1]), table.dtype)
        larger[:used] = table[:used]
        table = larger
    table[used : used + len(more)] = more
    return table


def alias_tables(shares: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An alias table for every run of ``counts`` consecutive shares that sum to one.

    An entry drawn uniformly stays where a 32-bit draw is at most its threshold, else its alias is taken. Runs of one length
    are done together: the smallest open share is filled up from the largest one, once for every entry but the last.
    """
    threshold = np.full(len(shares), 0xFFFFFFFF, np.uint32)
    alias, firsts = np.arange(len(shares)), np.cumsum(counts) - counts
    for n in np.unique(counts[counts > 1]).tolist():
        base = firsts[counts == n]
        left = shares[base[:, None] + np.arange(n)] * n
        low, high, lines = left.copy(), left.copy(), np.arange(len(base))
        for _ in range(n - 1):
            small = low.argmin(axis=1)
            low[lines, small], high[lines, small] = np.inf, -np.inf
            large, own = high.argmax(axis=1), left[lines, small]
            threshold[base + small] = np.clip(np.rint(own * 2.0**32) - 1, 0, 0xFFFFFFFF).astype(np.uint32)
            alias[base + small] = base + large
            rest = left[lines, large] - (1.0 - own)
            left[lines, large] = low[lines, large] = high[lines, large] = rest
    return threshold, alias


class PieceLattice:
    """Pieces of a model file and the sampling tables of the parts met so far."""

    def __init__(self, model: str, alpha: float = 1.0):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        normal = [i for i in range(sp.vocab_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        ranked = sorted(normal, key=lambda i: (-sp.get_score(i), i))
        self.pieces: dict[str, tuple[int, float]] = {}
        self.bytes_of: list[bytes] = [b""] * sp.vocab_size()
        for rank, i in enumerate(ranked):
            piece = sp.id_to_piece(i).replace(MARK, " ")
            if " " in piece.lstrip(" ") or "\n" in piece:
                raise ValueError("a piece crosses a word boundary")
            self.pieces[piece] = (i, (1.0 / (rank + 1.0)) ** alpha)
            self.bytes_of[i] = piece.encode()
        self.part = part_pattern(self.pieces)
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        for b, i in enumerate(self.byte_ids):
            self.bytes_of[i] = bytes([b])
        self._make_trie()
        self._reset()

    def _reset(self) -> None:
        self.last_row: dict[str, int] = {}
        self.n_rows = 0
        #: Per row its first entry and their number; per entry threshold, code and row before, and those of its alias.
        self.rows, self.entries, self.n_entries = np.empty((0, 2), np.int32), np.empty((0, 5), np.int32), 0
        self.fallback: dict[str, int] = {}

    def _make_trie(self) -> None:
        """Edges of the prefix tree of all pieces as sorted keys (node x characters + character class)."""
        nodes = {p[:k]: None for p in self.pieces for k in range(1, len(p) + 1)}
        number = {"": 0} | {prefix: i + 1 for i, prefix in enumerate(nodes)}
        self.chars = np.array(sorted({ord(c) for p in self.pieces for c in p}), np.int64)
        classes = {chr(c): i for i, c in enumerate(self.chars.tolist())}
        edges = sorted((number[p[:-1]] * len(self.chars) + classes[p[-1]], number[p]) for p in nodes)
        self.edge_key, self.edge_to = np.array([e[0] for e in edges]), np.array([e[1] for e in edges])
        self.node_code = np.full(len(number), -1, np.int32)
        self.node_weight = np.zeros(len(number))
        for piece, (i, weight) in self.pieces.items():
            self.node_code[number[piece]], self.node_weight[number[piece]] = i, np.log(weight)

    def _occurrences(self, chars: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """Start, length, code and log weight of every piece at every place; ``ends``: where the part of a place ends."""
        known = np.minimum(np.searchsorted(self.chars, chars), len(self.chars) - 1)
        classes = np.where(self.chars[known] == chars, known, -1)
        found: list[list[np.ndarray]] = [[], [], [], []]
        at, node, length = np.arange(len(chars)), np.zeros(len(chars), np.int64), 0
        single = np.zeros(len(chars), bool)
        while len(at):
            inside = (at + length) < ends[at]
            at, node = at[inside], node[inside]
            char = classes[at + length]
            key = node * len(self.chars) + char
            edge = np.minimum(np.searchsorted(self.edge_key, key), len(self.edge_key) - 1)
            hit = (self.edge_key[edge] == key) & (char >= 0)
            at, node, length = at[hit], self.edge_to[edge[hit]], length + 1
            code = self.node_code[node]
            whole = code >= 0
            for out, x in zip(found, (at[whole], np.full(int(whole.sum()), length), code[whole], self.node_weight[node[whole]])):
                out.append(x)
            if length == 1:
                single[at[whole]] = True
        rest = np.flatnonzero(~single)
        for char in np.unique(chars[rest]).tolist():
            self.fallback.setdefault(chr(char), len(self.fallback))
        codes = np.array([-1 - self.fallback[chr(c)] for c in chars[rest].tolist()], np.int32)
        for out, x in zip(found, (rest, np.ones(len(rest), np.int64), codes, np.full(len(rest), np.log(BYTE_WEIGHT)))):
            out.append(x)
        return [np.concatenate(x) for x in found]

    def _add(self, parts: list[str]) -> None:
        """Forward pass over new parts, all at once, position by position.

        Position k of a part is one row. An entry of a row is a piece that ends there: its share of the row's paths, its
        code, and the row where it starts (-1 at the part's beginning). Shares become an alias table per row.
        """
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        first = np.cumsum(sizes) - sizes
        chars = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32).astype(np.int64)
        part = np.repeat(np.arange(len(parts)), sizes)
        start, length, code, weight = self._occurrences(chars, (first + sizes)[part])
        end = start + length
        by_end = _order(end)
        start, end, code, weight = start[by_end], end[by_end], code[by_end], weight[by_end]
        inside = part[start]
        row, from_row = end + inside, start + inside  # every part has one row more than characters
        position = end - first[inside]
        by_position = _order(position)
        total, shares = np.zeros(len(chars) + len(parts)), np.empty(len(row))
        bounds = np.flatnonzero(np.diff(position[by_position], prepend=-1))
        for a, b in zip(bounds, np.append(bounds[1:], len(row)), strict=True):
            at = by_position[a:b]
            value, rows = total[from_row[at]] + weight[at], row[at]
            group = np.flatnonzero(np.diff(rows, prepend=-1))
            count = np.diff(np.append(group, b - a))
            most = np.maximum.reduceat(value, group)
            share = np.exp(value - np.repeat(most, count))
            sums = np.add.reduceat(share, group)
            total[rows[group]] = most + np.log(sums)
            shares[at] = share / np.repeat(sums, count)
        before = np.where(start == first[inside], -1, from_row + self.n_rows)
        counts = np.bincount(row, minlength=len(chars) + len(parts))
        firsts = np.cumsum(counts) - counts + self.n_entries
        threshold, alias = alias_tables(shares, counts)
        fresh = np.empty((len(row), 5), np.int32)
        fresh[:, 0], fresh[:, 1], fresh[:, 2] = threshold.view(np.int32), code, before
        fresh[:, 3:] = fresh[alias, 1:3]
        self.rows = _extended(self.rows, self.n_rows, np.stack([firsts, counts], axis=1))
        self.entries = _extended(self.entries, self.n_entries, fresh)
        self.n_entries += len(fresh)
        last = self.n_rows + first + sizes + np.arange(len(parts))
        self.last_row.update(zip(parts, last.tolist(), strict=True))
        self.n_rows += len(chars) + len(parts)

    def rows_of(self, parts: list[str]) -> np.ndarray:
        """The last row of each part, after a forward pass over those not met before."""
        if len(self.last_row) > TABLE_PARTS:
            self._reset()
        new = list(set(parts).difference(self.last_row))
        if new:
            self._add(new)
        return np.fromiter(map(self.last_row.__getitem__, parts), np.int64, len(parts))

    def encode(self, texts: list[str | None], keys: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the bounds of each text in them."""
        split = [self.part.findall(" " + t) if t else [] for t in texts]
        sizes = np.array([len(p) for p in split], np.int64)
        row = self.rows_of([p for parts in split for p in parts])
        with np.errstate(over="ignore"):
            key = _mix(np.asarray(keys).astype(np.int64).view(np.uint64) ^ _mix(np.array([seed], np.uint64)))
            place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            key = _mix(np.repeat(key, sizes) + (place.astype(np.uint64) + np.uint64(1)) * _GOLDEN)
            drawn, active, step = [], np.arange(len(row)), 0
            while len(active):
                draw = _mix(key[active] + np.uint64(step) * _GOLDEN)
                of_row = self.rows[row[active]]
                at = ((draw >> np.uint64(32)) * of_row[:, 1].astype(np.uint64)) >> np.uint64(32)
                entry = self.entries[of_row[:, 0] + at.astype(np.int64)]
                own = (draw & np.uint64(0xFFFFFFFF)).astype(np.uint32) <= entry[:, 0].view(np.uint32)
                drawn.append((active, np.where(own, entry[:, 1], entry[:, 3])))
                row[active] = before = np.where(own, entry[:, 2], entry[:, 4])
                active, step = active[before >= 0], step + 1
        chars = list(self.fallback)
        encoded = [c.encode() for c in chars]
        widths = np.array([len(b) for b in encoded] or [0], np.int64)
        table = np.zeros((max(1, len(chars)), 4), np.int32)
        for i, b in enumerate(encoded):
            table[i, : len(b)] = [self.byte_ids[x] for x in b]
        total = np.zeros(len(row), np.int64)
        for at, code in drawn:
            total[at] += np.where(code < 0, widths[np.where(code < 0, -1 - code, 0)], 1)
        ends = np.cumsum(total)
        ids, cursor = np.zeros(int(ends[-1]) if len(ends) else 0, np.int32), ends.copy()
        for at, code in drawn:
            plain = code >= 0
            cursor[at] -= np.where(plain, 1, widths[np.where(plain, 0, -1 - code)])
            ids[cursor[at[plain]]] = code[plain]
            for b in range(4):
                wide = ~plain & (widths[np.where(plain, 0, -1 - code)] > b)
                if not wide.any():
                    break
                ids[cursor[at[wide]] + b] = table[-1 - code[wide], b]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]
        return ids, bounds

    def decode(self, ids: np.ndarray) -> str:
        """The text of a list of ids."""
        table = self.bytes_of
        return b"".join([table[i] for i in ids.tolist()])[1:].decode()


_LATTICES: dict[tuple[str, float], PieceLattice] = {}


def _lattice(model: str, alpha: float = 1.0) -> PieceLattice:
    """One lattice per worker process, with the tables of the parts that earlier tasks met."""
    if (model, alpha) not in _LATTICES:
        _LATTICES.clear()
        _LATTICES[model, alpha] = PieceLattice(model, alpha)
    return _LATTICES[model, alpha]


def sample_pieces(docs: DataFrame, model: str, seed: int = 11, alpha: float = 1.0) -> DataFrame:
    """``doc_id``, ``ids``, ``n_ids`` and ``lossless`` (the decoded ids equal the text) for every row of ``docs``."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("n_ids", pa.int64()), ("lossless", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _lattice(model, alpha)
        for batch in batches:
            texts, keys = batch.column("text").to_pylist(), batch.column("doc_id")
            numbers, start = keys.fill_null(0).to_numpy(zero_copy_only=False), 0
            while start < len(texts):  # a few megabytes of text at a time
                stop, size = start, 0
                while stop < len(texts) and size < BLOCK_CHARS:
                    size, stop = size + len(texts[stop] or ""), stop + 1
                block = texts[start:stop]
                ids, bounds = lattice.encode(block, numbers[start:stop], seed)
                same = [t is None or lattice.decode(ids[a:b]) == t for t, a, b in zip(block, bounds[:-1], bounds[1:])]
                null = pa.array([t is None for t in block])
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids), mask=null)
                counts = pa.array(np.diff(bounds))
                yield pa.RecordBatch.from_arrays([keys.slice(start, stop - start), lists, counts, pa.array(same)], schema=schema)
                start = stop

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id long, ids array<int>, n_ids long, lossless boolean")


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id`` and ``text`` of encoded rows (``doc_id``, ``ids``); null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _lattice(model)
        for batch in batches:
            texts = [None if x is None else lattice.decode(np.array(x, np.int32)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")
