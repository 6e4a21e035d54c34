"""What the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Broadcast only tables measured to hold no more rows and bytes (as JSON text) than this.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64_000_000


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def held_out() -> Column:
    """Whether a document may not be learnt from: crc32 of its id as text is divisible by 5. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def document_key() -> tuple[Column, Column]:
    """128 bits that tell documents apart by id and text; rows equal in both are one document."""
    return (
        F.xxhash64(F.col("doc_id"), whole_text()).alias("key"),
        F.xxhash64(F.lit("second"), F.col("doc_id"), whole_text()).alias("key2"),
    )


KEY = ["key", "key2"]


def keyed(docs: DataFrame) -> DataFrame:
    """``row``, all columns of ``docs`` in one, with the key; no column of ``docs`` can clash with others."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *document_key())


def field(name: str) -> Column:
    return F.col(f"row.`{name}`")


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast if it is measured to be small; otherwise the planner chooses.

    Few rows may still be large, as arrays and words can have any length, so bytes count as well.
    """
    if df.count() > rows:
        return df
    held = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0]
    return F.broadcast(df) if (held or 0) <= size else df


def sample_ids(ids: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` of the distinct ``doc_id`` of ``ids``, those of least hash.

    A threshold from their number thins them before they are ordered, so no task gathers more than a
    small multiple of ``rows``.
    """
    ids = ids.select("doc_id").where("doc_id is not null").distinct().withColumn("at", F.xxhash64(F.lit("sample"), "doc_id"))
    count = ids.count()
    if count > 2 * rows:
        share = 1.2 * (rows + 1000) / count
        ids = ids.where(F.col("at") < int(-(2.0**63) + min(1.0, share) * 2.0**64 * 0.999999))
    return ids.orderBy("at", "doc_id").limit(rows).select("doc_id")
