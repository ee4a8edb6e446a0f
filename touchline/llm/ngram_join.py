"""Similarity join on word n-grams: MinHash banding, pairs verified on the full n-gram sets.

1. Every document becomes its set of word n-grams (64-bit hashes), a MinHash signature cut into bands, and a key of the
   set. Documents with equal sets are one vertex, so copies are never paired.
2. Vertices are shuffled on band hashes. Buckets that hold the same vertices in several bands are kept once. A large
   bucket is cut into blocks and its block pairs become units of bounded size, so no task holds a whole hot bucket and
   pairs never become rows.
3. Each unit verifies its pairs on the full sets. A pair counts in the first band where both agree, so it counts once.
   A unit returns per vertex the number of its links and one edge to the root of its group in the unit.
4. Groups are the connected components of these edges (alternating star contraction, tables staged between rounds).

``choose_bands`` picks the number of bands for a target recall at the threshold; recall is higher above it.

Words are what Unicode white space separates, compared as they are. Defined cases: a text of fewer than ``n`` words has
one n-gram, all its words; a text without words (or null) has none, is a copy of other such texts and links to nothing;
rows with null or repeated ids are documents like others; an empty table gives no rows; extra columns are ignored by
``link_documents`` and passed through by ``one_of_each_group``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import staged, text_or_empty

MEMO_WORDS = 300_000
BLOCK_ROWS, BLOCK_GRAMS = 1024, 1_500_000


@lru_cache(4)
def _multipliers(count: int) -> np.ndarray:
    """Odd seeded multipliers; a longer table begins like a shorter one."""
    drawn = np.random.default_rng(20240601).integers(0, 1 << 63, max(1024, count), dtype=np.uint64)
    return drawn * np.uint64(2) + np.uint64(1)


_MULTIPLIERS = _multipliers(1024)


def choose_bands(threshold: float, recall: float, rows: int = 5) -> tuple[int, int]:
    """Bands and rows per band so that a pair at the threshold shares a band with probability ``recall`` or more."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)), rows


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        import xxhash

        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


class Shingler:
    def __init__(self, n: int):
        self.n, self.memo = n, _WordHashes()

    def grams(self, text: str) -> np.ndarray:
        """The sorted distinct n-gram hashes of a text."""
        words = text.split()
        if not words:
            return np.empty(0, np.uint64)
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        hashes = np.fromiter(map(self.memo.__getitem__, words), np.uint64, len(words))
        size = min(self.n, len(words))
        many = len(words) - size + 1
        total = np.full(many, size, np.uint64)
        for j in range(size):
            total += hashes[j : j + many] * _MULTIPLIERS[j]
        return np.unique(_mix(total))

    @staticmethod
    def key(grams: np.ndarray) -> bytes:
        """128 bits that name the set."""
        two = (np.add.reduce(_mix(grams ^ _MULTIPLIERS[8])), np.bitwise_xor.reduce(_mix(grams ^ _MULTIPLIERS[9])))
        return np.array(two, "<u8").tobytes()


def signature(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes of a set of n-grams."""
    count = bands * rows
    least = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    table = _multipliers(16 + 2 * count)  # as long as the bands need
    a, c = table[16 : 16 + count, None], table[16 + count : 16 + 2 * count, None]
    for i in range(0, len(grams), 1024):
        np.minimum(least, ((grams[None, i : i + 1024] ^ c) * a).min(axis=1), out=least)
    folded = (least.reshape(bands, rows) * _MULTIPLIERS[None, :rows]).sum(axis=1, dtype=np.uint64)
    return _mix(folded + np.arange(bands, dtype=np.uint64))


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """``doc_id``, ``set_key``, ``n_grams``, ``bands`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for batch in batches:
            keys, sizes, hashes = [], [], []
            for text in batch.column("text"):
                grams = shingler.grams(text.as_py())
                keys.append(shingler.key(grams))
                sizes.append(len(grams))
                hashes.append(signature(grams, bands, rows).view(np.int64) if len(grams) else [])
            arrays = [batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(hashes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "set_key", "n_grams", "bands"])

    chosen = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return chosen.mapInArrow(run, "doc_id long, set_key binary, n_grams long, bands array<long>")


def _gram_sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """``set_key`` and ``grams`` of the vertices in ``wanted`` (``set_key``, ``rep_id``), each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for batch in batches:
            keys, sets = [], []
            for text, want in zip(batch.column("text"), batch.column("want").to_pylist(), strict=True):
                grams = shingler.grams(text.as_py())
                if shingler.key(grams) == want:  # rows may repeat an id with another text
                    keys.append(want)
                    sets.append(grams.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], names=["set_key", "grams"])

    texts = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    same = F.col("doc_id").eqNullSafe(F.col("rep_id"))
    # One plan at every size: the texts are shuffled once, whether few or many documents are candidates.
    chosen = texts.join(wanted.select("rep_id", F.col("set_key").alias("want")).hint("merge"), same).select("text", "want")
    return chosen.mapInArrow(run, "set_key binary, grams array<long>")


def _verified(rows: list[dict], unit: tuple, threshold: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Linked pairs of one unit as two index arrays."""
    band, _, i, j = unit
    side = np.array([r["block"] for r in rows])
    left = np.flatnonzero(side == i)
    right = left if i == j else np.flatnonzero(side == j)
    if not len(left) or not len(right):
        return None
    sizes = np.array([len(r["grams"]) for r in rows], np.int64)
    open_ = np.triu(np.ones((len(left), len(right)), bool), 1) if i == j else np.ones((len(left), len(right)), bool)
    small, large = np.minimum.outer(sizes[left], sizes[right]), np.maximum.outer(sizes[left], sizes[right])
    open_ &= small >= threshold * large - 1e-9
    if band:
        bands = np.array([r["bands"] for r in rows], np.int64)
        for b in range(band):
            open_ &= bands[left, b][:, None] != bands[right, b][None, :]
    a, b = np.nonzero(open_)
    if not len(a):
        return None
    if len(a) <= 2 * (len(left) + len(right)):
        common = np.array([len(np.intersect1d(rows[left[x]]["grams"], rows[right[y]]["grams"], True)) for x, y in zip(a, b, strict=True)])
    else:
        use_left, use_right = np.unique(a), np.unique(b)
        common = _common(rows, left[use_left], right[use_right])[np.searchsorted(use_left, a), np.searchsorted(use_right, b)]
    union = sizes[left[a]] + sizes[right[b]] - common
    hit = common >= threshold * union - 1e-9
    return left[a[hit]], right[b[hit]]


def _common(rows: list[dict], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of all intersections between two lists of sets, by products of 0/1 matrices over their shared n-grams."""
    used = np.union1d(left, right)
    flat = np.concatenate([rows[r]["grams"] for r in used])
    owner = np.repeat(np.arange(len(used)), [len(rows[r]["grams"]) for r in used])
    _, place, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[place] > 1  # an n-gram of one set is in no intersection
    column = np.cumsum(count > 1)[place[shared]] - 1
    owner, width = owner[shared], int((count > 1).sum())
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((len(left), len(right)), np.float32)
    at_left, at_right = np.searchsorted(used, left), np.searchsorted(used, right)
    step = max(64, (8 << 20) // len(used))
    for start in range(0, width, step):
        a, b = np.searchsorted(column, [start, start + step])
        part = np.zeros((len(used), step), np.float32)
        part[owner[a:b], column[a:b] - start] = 1
        out += part[at_left] @ part[at_right].T
    return out.astype(np.int64)


def _links(unit: tuple, rows: list[dict], threshold: float) -> list[tuple[bytes, bytes, int, int]]:
    """Per linked vertex: key, root key of its group in this unit, links, linked documents."""
    found = _verified(rows, unit, threshold)
    if found is None or not len(found[0]):
        return []
    a, b = found
    parent = list(range(len(rows)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    copies = np.array([r["copies"] for r in rows], np.int64)
    links = np.bincount(a, minlength=len(rows)) + np.bincount(b, minlength=len(rows))
    docs = np.bincount(a, copies[b], len(rows)) + np.bincount(b, copies[a], len(rows))
    return [(rows[x]["set_key"], rows[root(x)]["set_key"], int(links[x]), int(docs[x])) for x in np.flatnonzero(links)]


def _verify(units: DataFrame, threshold: float) -> DataFrame:
    names = ["set_key", "root_key", "links", "linked_docs"]
    types = [pa.binary(), pa.binary(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, rows, out = None, [], []
        for batch in batches:
            columns = {n: batch.column(n) for n in ("band", "hash", "i", "j", "block", "set_key", "copies", "bands", "grams")}
            for k in range(batch.num_rows):
                mine = tuple(columns[n][k].as_py() for n in ("band", "hash", "i", "j"))
                if mine != unit:
                    if len(rows) > 1:
                        out += _links(unit, rows, threshold)
                    unit, rows = mine, []
                rows.append({
                    "block": columns["block"][k].as_py(), "set_key": columns["set_key"][k].as_py(), "copies": columns["copies"][k].as_py(),
                    "bands": columns["bands"][k].values.to_numpy(), "grams": columns["grams"][k].values.to_numpy().copy().view(np.uint64),
                })
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
                out = []
        if len(rows) > 1:
            out += _links(unit, rows, threshold)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return units.mapInArrow(run, "set_key binary, root_key binary, links long, linked_docs long")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``root`` (the least node it is connected to) for every node of ``edges`` (``a``, ``b``).

    Alternating star contraction: each round connects the larger neighbours of a node to its least neighbour, then the
    smaller ones; rounds grow with the logarithm of the longest chain. Minima are aggregated before they are joined back.
    """
    apart = edges.where("a <> b")
    now = staged(apart.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = None
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written, so that the join shuffles both sides for itself and the planner can split a node with many neighbours.
        least = staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        far = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        far = staged(far.where("u <> v").distinct(), "edges")
        least = far.groupBy("u").agg(F.min("v").alias("m"))
        near = far.join(least, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("x"))
        now = staged(near.select("x.u", F.col("x.m").alias("v")).where("u <> v").distinct(), "edges")
        seen = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = seen
    raise RuntimeError("components did not settle")


def link_documents(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9999) -> DataFrame:
    """One row per document: ``doc_id``; ``class_id``, the least id of the documents it is connected to by links or equal
    n-gram sets; ``copy_id``, the least id with an equal set; ``n_copies`` with that set; ``n_links``: other sets that are
    similar at ``threshold`` or more; ``n_linked_docs``: documents with such sets."""
    bands, rows = choose_bands(threshold, recall)
    signed = staged(signatures(docs, n, bands, rows), "signatures")
    vertices = staged(
        signed.groupBy("set_key").agg(
            F.min("doc_id").alias("rep_id"), F.count(F.lit(1)).alias("copies"), F.max("n_grams").alias("n_grams"),
            F.max(F.struct("bands"))["bands"].alias("bands"),
        ), "vertices",
    )
    placed = vertices.where("n_grams > 0").select("set_key", "n_grams", F.posexplode("bands").alias("band", "hash"))
    buckets = placed.groupBy("band", "hash").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n_grams").alias("grams"),
        F.bit_xor(F.xxhash64("set_key")).alias("x"), F.bit_xor(F.xxhash64("set_key", F.lit(1))).alias("y"),
    ).where("size > 1")
    buckets = buckets.groupBy("size", "grams", "x", "y").agg(F.min(F.struct("band", "hash")).alias("b"))
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK_ROWS), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("int")
    members = staged(
        placed.join(buckets.select("b.band", "b.hash", blocks.alias("blocks")), ["band", "hash"]).select(
            "band", "hash", "set_key", "blocks", F.pmod(F.xxhash64("set_key", F.lit(2)), F.col("blocks")).cast("int").alias("block")
        ), "members",
    )
    wanted = vertices.join(members.select("set_key").distinct(), "set_key", "left_semi").select("set_key", "rep_id")
    sets = staged(_gram_sets(docs, wanted, n).dropDuplicates(["set_key"]), "gram-sets")
    sets = sets.join(vertices.select("set_key", "copies", "bands"), "set_key")
    other = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = other.select("band", "hash", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "set_key")
    units = units.join(sets, "set_key").repartition("band", "hash", "i", "j").sortWithinPartitions("band", "hash", "i", "j")
    links = staged(_verify(units, threshold), "links")
    roots = components(links.select(F.col("set_key").alias("a"), F.col("root_key").alias("b")))
    counts = links.groupBy("set_key").agg(F.sum("links").alias("n_links"), F.sum("linked_docs").alias("n_linked_docs"))
    labelled = vertices.select("set_key", "rep_id", "copies").join(counts, "set_key", "left").join(
        roots.withColumnRenamed("node", "set_key"), "set_key", "left"
    ).withColumn("root", F.coalesce("root", "set_key"))
    labelled = staged(labelled, "labelled")
    least = labelled.groupBy("root").agg(F.min("rep_id").alias("class_id"))
    labelled = staged(labelled.join(least, "root"), "classes")
    return signed.select("doc_id", "set_key").join(labelled, "set_key").select(
        "doc_id", "class_id", F.col("rep_id").alias("copy_id"), F.col("copies").alias("n_copies"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_linked_docs", F.lit(0)).alias("n_linked_docs"),
    )


def one_of_each_group(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9999) -> DataFrame:
    """The rows of ``docs`` whose id is the least of their group, with all columns.

    Rows that share an id stay or go together; of such rows that are equal in every column one stays.
    """
    linked = link_documents(docs, n, threshold, recall)
    ids = linked.groupBy(F.col("doc_id").alias("__id")).agg(
        F.max(F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("__rep"), F.count(F.lit(1)).alias("__n")
    )
    ids = staged(ids.where("NOT __rep OR __n > 1"), "removed")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))
    marked = docs.join(ids.hint("merge"), same, "left")
    once = marked.where("__rep IS NULL")
    repeated = marked.where("__rep").dropDuplicates(docs.columns)
    return once.unionByName(repeated).select(*[F.col(f"`{c}`") for c in docs.columns])
