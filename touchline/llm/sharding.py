"""Global shuffle of documents into shards: a two-pass external shuffle.

Pass one scatters whole rows into memory-sized buckets by a seeded hash over all columns, so that neither a common text
nor a repeated key meets in one bucket. Pass two shuffles each bucket in memory (the built-in array ``shuffle`` is a
Fisher-Yates shuffle) and writes it. The global position of a row is the bucket's offset plus its place in the bucket;
shards are equal consecutive ranges of positions, so their row counts differ by one at most (law ``rows``), slots have no
gaps, and a bucket is written to one or two shards, not to all.

Bucket sizes are counted before the texts move; the offsets are a running sum over one row per bucket. The rows of
a bucket are ordered by hash before they are shuffled and the generator is seeded per partition, so one seed and one
partition count give one result.

Defined cases: a null text has no bytes and stays null; null ids and repeated rows are placed like others; rows equal in
every column share a bucket; an empty table gives no rows; extra columns are written with the texts, but for those named
``shard`` and ``slot``, which the result has itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.llm.common import staged, text_or_empty
from touchline.session import scratch_path

ROW_BYTES = 16


def row_size(name: str = "text") -> Column:
    """UTF-8 bytes of the text plus a fixed cost per row."""
    return F.coalesce(F.octet_length(name), F.lit(0)).cast("long") + F.lit(ROW_BYTES)


def _hash(docs: DataFrame, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *[F.col(f"`{n}`") for n in docs.columns])


def shard_documents(
    docs: DataFrame, path: str, n_shards: int = 40, seed: int = 42, bucket_bytes: int = 16 << 20
) -> DataFrame:
    """Write ``docs`` to ``path`` in folders ``shard=…`` with a column ``slot``; returns what was written.

    ``bucket_bytes``: texts that one task holds while it shuffles them.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(row_size())).first()[0] or 0
    n_buckets = max(1, -(-total // bucket_bytes))
    bucket = F.pmod(_hash(docs, seed), F.lit(n_buckets)).cast("int")
    sizes = staged(docs.groupBy(bucket.alias("__bucket")).agg(F.count(F.lit(1)).alias("__n")), "bucket-sizes")
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged(
        sizes.select("__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")), "bucket-offsets"
    )
    row = F.struct(_hash(docs, seed + 1).alias("__order"), *[F.col(f"`{n}`") for n in docs.columns])
    # The bucket is the partition: hashing its number again would put several buckets into one task.
    scattered = docs.select(bucket.alias("__bucket"), row.alias("__row")).repartitionById(int(n_buckets), "__bucket")
    held = scattered.sortWithinPartitions("__bucket", "__row.__order").groupBy("__bucket").agg(F.collect_list("__row").alias("__rows"))
    dealt = held.join(offsets, "__bucket").select("__offset", F.posexplode(F.shuffle("__rows", F.lit(seed))).alias("__place", "__row"))
    rows = max(1, sizes.agg(F.sum("__n")).first()[0] or 0)
    dealt = dealt.withColumn("__at", F.col("__offset") + F.col("__place"))
    dealt = dealt.withColumn("shard", F.expr(f"CAST(__at * {n_shards} DIV {rows} AS INT)"))
    out = dealt.select(
        *[F.col(f"__row.`{n}`").alias(n) for n in docs.columns if n not in ("shard", "slot")],
        "shard",
        F.expr(f"__at - (CAST(shard AS BIGINT) * {rows} + {n_shards - 1}) DIV {n_shards}").alias("slot"),
    )
    out.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    return read_shards(spark, path, out)


def read_shards(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path)


def shard_report(docs: DataFrame, n_shards: int = 40, seed: int = 42) -> DataFrame:
    """Shards written under the shared folder and their digest columns read back from the files."""
    written = shard_documents(docs.select("doc_id", "text"), scratch_path(docs.sparkSession, "shards"), n_shards, seed)
    return written.select(
        "doc_id", row_size().alias("size"), F.crc32(F.encode(text_or_empty(), "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
