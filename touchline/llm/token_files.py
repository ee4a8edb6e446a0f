"""Token-id files: a concatenated id array per file with Elias-Fano coded document boundaries.

Documents are range-partitioned by ``doc_id``; each task encodes its range in order and writes files of bounded size:
a header, the boundaries of its documents in the id array, the document ids (both Elias-Fano, no 64-bit tables) and the
ids as 16- or 32-bit integers. A task writes under a name of its own and then renames, so a task that runs again after
a lost executor replaces its files by equal ones. ``read_files`` reads them through Spark's binary reader; global offsets
come from a running sum over one manifest row per file.

Encoding equals the library's on the whole text: the tokenizer's pattern drops white space and no token crosses it, so
a text is the concatenation of its chunks between spaces and line ends, and the parts of a chunk that its pattern tells
apart are encoded by the library once per task (bounded memos).

Defined cases: a null text counts as empty and has the end id only; a null ``doc_id`` sorts first; repeated rows are
separate documents, ordered by text; an empty table writes no file and gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.common import byte_characters, staged, text_or_empty
from touchline.llm.elias_fano import EliasFano
from touchline.session import scratch_path

MAGIC = b"TLTOKEN1"
_HEAD = "<8sqqqqB"  # magic, documents, documents without id, ids, first document id, bytes per id
MANIFEST = "file string, part int, seq int, n_docs long, n_ids long"
MEMO_ENTRIES, MEMO_CHARS = 400_000, 48


#: Printable ASCII and the letters of Latin-1: unchanged by NFC, with one lower case. White space, other scripts, signs
#: and special strings take the library's full path.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
#: The tokenizer's own pattern over those characters in lower case.
PRE_TOKEN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


class ChunkEncoder:
    """Ids of whole texts as little-endian 16-bit bytes: a memo of chunks over the library's encoder.

    A new chunk of plain characters is cut by the tokenizer's pattern and only pre-tokens not met before go to the
    library's model; any other new chunk goes through the library whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("this encoder stores 16-bit ids")
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.stand_in = byte_characters()
        self.chunks: dict[str, bytes] = {"": b""}
        self.pre_tokens: dict[str, bytes] = {}

    def _plain(self, chunk: str) -> bytes:
        known, out = self.pre_tokens, []
        for piece in PRE_TOKEN.findall(chunk.lower()):
            found = known.get(piece)
            if found is None:
                name = piece if piece.isascii() else "".join([self.stand_in[b] for b in piece.encode()])
                ids = [t.id for t in self.model.tokenize(name)]
                found = known[piece] = struct.pack(f"<{len(ids)}H", *ids)
            out.append(found)
        return b"".join(out)

    def encode(self, texts: list[str]) -> list[bytes]:
        chunked = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self.chunks) > MEMO_ENTRIES:
            self.chunks = {"": b""}
        if len(self.pre_tokens) > MEMO_ENTRIES:
            self.pre_tokens = {}
        memo, odd = self.chunks, []
        missing = set().union(*chunked).difference(memo)
        for chunk in missing:
            if PLAIN.fullmatch(chunk) and not ("<" in chunk and any(s in chunk for s in self.special)):
                memo[chunk] = self._plain(chunk)
            else:
                odd.append(chunk)
        for chunk, e in zip(odd, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False), strict=True):
            memo[chunk] = struct.pack(f"<{len(e.ids)}H", *e.ids)
        out = [b"".join(map(memo.__getitem__, chunks)) for chunks in chunked]
        for chunk in missing:
            if len(chunk) > MEMO_CHARS:
                del memo[chunk]
        return out


def pack_file(doc_ids: list[int | None], parts: list[bytes]) -> bytes:
    """One file of documents in ascending order, null ids first; ``parts`` are their ids as 16-bit bytes."""
    known = np.array([d for d in doc_ids if d is not None], dtype=np.int64)
    first = int(known[0]) if len(known) else 0
    ends = np.cumsum([0, *[len(p) // 2 for p in parts]])
    head = struct.pack(_HEAD, MAGIC, len(doc_ids), len(doc_ids) - len(known), int(ends[-1]), first, 2)
    shifted = (known.astype(np.uint64) - np.uint64(first & 0xFFFFFFFFFFFFFFFF)) if len(known) else known
    return b"".join([head, EliasFano.of(ends).to_bytes(), EliasFano.of(shifted).to_bytes(), *parts])


class TokenFile:
    """A file's documents: boundaries and ids by position, without unpacking the rest."""

    def __init__(self, data: bytes):
        magic, self.n_docs, self.n_null, self.n_ids, self.first, width = struct.unpack_from(_HEAD, data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.bounds, at = EliasFano.from_bytes(data, struct.calcsize(_HEAD))
        self.keys, at = EliasFano.from_bytes(data, at)
        self.ids = np.frombuffer(data, "<u2" if width == 2 else "<u4", self.n_ids, at)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.bounds.select(i) : self.bounds.select(i + 1)]

    def doc_ids(self) -> list[int | None]:
        known = (self.keys.all() + np.uint64(self.first & 0xFFFFFFFFFFFFFFFF)).astype(np.int64)
        return [None] * self.n_null + known.tolist()


def _writer(folder: str, tokenizer: str, end_id: int, file_ids: int):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        from pyspark import TaskContext

        store, root = fs.FileSystem.from_uri(folder)
        encoder, end = ChunkEncoder(tokenizer), struct.pack("<H", end_id)
        part = TaskContext.get().partitionId()
        keys: list[int | None] = []
        parts: list[bytes] = []
        held = seq = 0

        def flush() -> pd.DataFrame:
            nonlocal keys, parts, held, seq
            name = f"part-{part:06d}-{seq:05d}.tokens"
            draft = f"{root}/_{uuid.uuid4().hex}"
            with store.open_output_stream(draft) as out:
                out.write(pack_file(keys, parts))
            store.move(draft, f"{root}/{name}")
            row = pd.DataFrame([[name, part, seq, len(keys), held]], columns=["file", "part", "seq", "n_docs", "n_ids"])
            keys, parts, held, seq = [], [], 0, seq + 1
            return row

        for batch in batches:
            texts, ids = batch["text"].tolist(), batch["doc_id"].tolist()
            start = 0
            while start < len(texts):  # about a megabyte of text at a time
                stop, size = start, 0
                while stop < len(texts) and size < 1 << 20:
                    size, stop = size + len(texts[stop]), stop + 1
                for key, found in zip(ids[start:stop], encoder.encode(texts[start:stop]), strict=True):
                    keys.append(None if pd.isna(key) else int(key))
                    parts.append(found + end)
                    held += len(found) // 2 + 1
                    if held >= file_ids:
                        yield flush()
                start = stop
        if keys:
            yield flush()

    return write


def write_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, file_ids: int = 4 << 20, task_bytes: int = 24 << 20
) -> DataFrame:
    """Encode and write all documents; the manifest has one row per file, with ``start``: ids in the files before it."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    ordered = rows.repartitionByRange(max(1, -(-size // task_bytes)), "doc_id").sortWithinPartitions("doc_id", "text")
    manifest = staged(ordered.mapInPandas(_writer(folder, tokenizer, end_id, file_ids), MANIFEST), "token-manifest")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` of every document, from the files."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["file"], batch["content"], strict=True):
                f = TokenFile(content)
                bounds = f.bounds.all().astype(np.int64)
                crcs = [zlib.crc32(f.ids[a:b].astype("<u4").tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pd.DataFrame({
                    "file": name, "doc_id": pd.array(f.doc_ids(), dtype="Int64"), "at": bounds[:-1],
                    "n_tokens": np.diff(bounds), "ids_crc32": np.array(crcs, dtype=np.int64),
                })

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tokens").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    found = files.mapInPandas(unpack, "file string, doc_id long, at long, n_tokens long, ids_crc32 long")
    return found.join(manifest.select("file", "start"), "file").select(
        "doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_report(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Files written under the shared folder and their documents read back."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-files")
    manifest = staged(write_files(docs, folder, tokenizer), "token-starts")
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_files(spark, folder, manifest)
