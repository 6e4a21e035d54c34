"""Near-duplicates by SimHash: fingerprints that differ in few bits share a block, and blocks are joined."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mandiscope.llm.common import KEY, document_key, field, keyed, whole_text
from mandiscope.llm.components import components
from mandiscope.session import written

#: A block with more fingerprints than this is linked through shared one-bit neighbours instead of pairs.
PAIRED = 64


def text_fingerprint(text: str, width: int = 3, seed: int = 42) -> int:
    """Signed 64-bit majority of the hashes of all word shingles, repeats included; 0 if there is no word."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    count = max(1, len(words) - width + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:count]
    digest = xxhash.xxh64_intdigest
    last = ends[min(width, len(words)) - 1 :]
    hashes = np.fromiter((digest(joined[i:j], seed) for i, j in zip(starts.tolist(), last.tolist())), np.uint64, count)
    ones = np.zeros(64, np.int64)
    for at in range(0, count, 1 << 14):
        part = hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > count, bitorder="little")
    return int(bits.view(np.int64)[0])


@F.pandas_udf(T.LongType())
def fingerprint(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([text_fingerprint(t) for t in batch], dtype="int64")


def _blocks(radius: int, parts: int) -> list[tuple[int, list[int]]]:
    """Masks over ``parts`` equal parts of 64 bits: any two fingerprints within ``radius`` agree under one of them.

    ``radius`` differing bits touch at most as many parts, so the other parts agree whole. Returns each mask (signed)
    with the bits outside it.
    """
    size = 64 // parts
    found = []
    for kept in combinations(range(parts), parts - radius):
        inside = {bit for p in kept for bit in range(p * size, (p + 1) * size if p < parts - 1 else 64)}
        mask = sum(1 << b for b in inside)
        found.append((mask - (1 << 64) if mask >> 63 else mask, [b for b in range(64) if b not in inside]))
    return found


def links(fingerprints: DataFrame, parts: int = 4) -> DataFrame:
    """Links ``a``, ``b`` between distinct ``fp`` that connect exactly those within two bits of each other.

    Blocks of up to ``PAIRED`` fingerprints are joined and every pair is verified. In a larger block every
    fingerprint is tied to the least one that shares a value one bit away: two fingerprints are within two bits
    if and only if they share such a value, so this gives the same components from a number of rows in proportion.
    """
    masks = _blocks(2, parts)
    keyed = F.array(*[F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(m)).alias("value")) for i, (m, _) in enumerate(masks)])
    rows = fingerprints.select("fp", F.explode(keyed).alias("k")).select("fp", "k.block", "k.value")
    shared = rows.groupBy("block", "value").agg(F.count("*").alias("n")).where("n > 1")
    rows = written(rows.join(shared, ["block", "value"]))
    few = rows.where(F.col("n") <= PAIRED)
    other = few.select("block", "value", F.col("fp").alias("b"))
    pairs = few.withColumnRenamed("fp", "a").join(other, ["block", "value"]).where("a < b").select("a", "b")
    flips = F.element_at(F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(1 << b if b < 63 else -(1 << 63)) for b in free]) for _, free in masks]), F.col("block") + 1)
    near = rows.where(F.col("n") > PAIRED).select("fp", "block", F.explode(F.transform(flips, lambda x: F.col("fp").bitwiseXOR(x))).alias("value"))
    least = near.groupBy("block", "value").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1")
    stars = near.join(least, ["block", "value"]).where("fp <> b").select(F.col("fp").alias("a"), "b")
    return pairs.union(stars).where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fp`` (long) and ``component_id``, the smallest id reachable.

    Fingerprints take words between ASCII white space with A-Z lowered, in shingles of three; texts of fewer words
    count as one shingle and texts without words (null, empty, blank) get fingerprint zero and are linked like any
    other. Rows that repeat an id or a text link like any others. A component whose ids are all null has the
    component null. An empty table gives no rows. Other columns are ignored.
    """
    return _linked(docs).select("doc_id", "fp", "component_id")


def _linked(docs: DataFrame, *more: Column) -> DataFrame:
    prints = written(docs.select("doc_id", *more, fingerprint(whole_text()).alias("fp")))
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(first.select("fp")))
    rooted = first.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    # Written first, so that no aggregate stands between the rows' exchange and their join: a hot value can be split.
    told = written(rooted.join(least, "root").select("fp", "root", "component_id"))
    return prints.join(told, "fp")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row with an id of each component, that of least (id, text hash); all columns stay.

    Rows are told apart by id and text, so an id that repeats with other texts loses only what is near a kept row. Of
    rows equal in both one stays, any one if other columns differ. Rows without an id stay.
    """
    rows = written(_linked(docs, *document_key()).where("doc_id is not null").select("root", "doc_id", *KEY))
    at = F.struct("doc_id", *KEY)
    first = written(rows.groupBy("root").agg(F.min(at).alias("first")))
    gone = rows.join(first, "root").where(at != F.col("first")).select(*KEY).distinct()
    again = written(rows.groupBy(*KEY).agg(F.count("*").alias("n")).where("n > 1").select(*KEY))
    left = keyed(docs).join(gone, KEY, "left_anti")
    if not again.isEmpty():
        left = left.join(again, KEY, "left_anti").unionByName(left.join(again, KEY, "left_semi").dropDuplicates(KEY))
    return left.select(*[field(c).alias(c) for c in docs.columns])


def hexadecimal(column: str = "fp"):
    return F.lpad(F.lower(F.hex(column)), 16, "0")
