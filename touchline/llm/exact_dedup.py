"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest. A batch is reduced to one candidate per digest (partial aggregation
first, so a text that holds a third of all rows is one row per task before the shuffle), candidates already indexed are
removed by a sort-merge anti-join that does not shuffle the index, and the rest is appended. An interrupted batch can be
run again: what it had appended is found in the index and wins as before.

Texts are equal when identical after lower-casing A-Z only. Defined cases: a null text counts as empty; of equal texts in
a batch the largest ``doc_id`` stays, a null ``doc_id`` ranks below every number; rows that repeat both ``doc_id`` and text
are one document (each row reports the same decision; ``distinct_documents`` returns one of them); an empty table gives an
empty result; columns besides ``doc_id`` and ``text`` are ignored or passed through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import fresh_name, staged, text_or_empty
from touchline.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; texts without other characters take the faster built-in."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def text_digest(name: str = "text") -> Column:
    """SHA-256 of the normalised text as 32 bytes."""
    return F.unhex(F.sha2(F.encode(ascii_lower(text_or_empty(name)), "UTF-8"), 256))


class DigestIndex:
    """Digests seen so far: ``digest`` BINARY, ``keep_id`` BIGINT, ``group_size`` BIGINT (rows of the batch that added it).

    ``path`` makes it last beyond the session: opening the same path again finds the same index. ``n_buckets`` is fixed
    when the index is made; choose about one bucket per two million digests expected (``buckets_for``).
    """

    def __init__(self, spark: SparkSession, path: str, n_buckets: int, name: str | None = None):
        self.spark, self.path, self.n_buckets, self.name = spark, path, n_buckets, name or fresh_name("digest_index")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{self.name}` (digest BINARY, keep_id BIGINT, group_size BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {n_buckets} BUCKETS LOCATION '{path}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, digests: DataFrame) -> None:
        """Append the digests of a batch (``digest``, ``doc_id``) that the index does not have."""
        best = digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        new = best.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        new = new.repartition(self.n_buckets, "digest").select("digest", "keep_id", "group_size")
        new.write.bucketBy(self.n_buckets, "digest").sortBy("digest").mode("append").option("path", self.path).saveAsTable(self.name)
        self.spark.catalog.refreshTable(self.name)


def buckets_for(rows: int, per_bucket: int = 2_000_000) -> int:
    return max(8, -(-rows // per_bucket))


def decide(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` for every row of ``docs``; the index grows."""
    spark = docs.sparkSession
    digests = staged(docs.select("doc_id", text_digest().alias("digest")), "digests")
    if index is None:
        index = DigestIndex(spark, scratch_path(spark, "digest-index"), buckets_for(digests.count()))
    index.add(digests)
    # Many rows of one text meet one index row here. Both sides are shuffled by the planner, so that it can split a hot
    # digest; the bucketed scan would pin it to one task.
    known = spark.read.schema(index.rows().schema).parquet(index.path)
    out = digests.join(known.hint("merge"), "digest")
    return out.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def distinct_documents(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one row per distinct text.

    Only the dropped ids travel back to the texts; rows that repeat a kept ``doc_id`` and text are reduced apart.
    """
    decisions = staged(decide(docs, index), "decisions").withColumnRenamed("doc_id", "__id")
    counts = decisions.groupBy("text_sha256", "__id", "kept").agg(F.count(F.lit(1)).alias("__n"))
    removed = staged(counts.where("NOT kept OR __n > 1").withColumnRenamed("kept", "__kept"), "removed")
    # The caller's columns travel in one struct, so that no name of theirs meets one of the operator's.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    rows = docs.select(row, F.lower(F.hex(text_digest())).alias("__sha"), F.col("doc_id").alias("__doc"))
    same = (F.col("__sha") == F.col("text_sha256")) & F.col("__doc").eqNullSafe(F.col("__id"))
    # One plan at every size: the texts are shuffled once, whether few or many rows go.
    marked = rows.join(removed.hint("merge"), same, "left")
    once = marked.where("__kept IS NULL")
    repeated = marked.where("__kept").dropDuplicates(["__sha"])
    return once.unionByName(repeated).select("__row.*")
