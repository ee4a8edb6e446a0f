"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import scratch_path

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """The place of a public tokenizer file; operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows written once under the shared folder and read back, so that later jobs do not run the plan again and a
    lost executor costs only its own tasks."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` with ``value`` computed once per row (a name for an intermediate array)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def byte_characters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 stays, the rest moves up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(moved)}
