"""Products in hash buckets, merged on read, with a manifest that is swapped as a whole.

Layout below the table's folder::

    data/v=<version>/bucket=<b>/part-*.parquet     rows as some write made them; never changed
    manifest/<version>.json                        which of these folders make up the table

A row lies in the bucket of its key's hash. A write puts its rows into a new version, as changes beside the base rows of
the buckets they touch, and then its manifest; a bucket whose changes exceed ``COMPACT`` of its base is written anew
from both, the others keep their files. A reader takes the newest manifest and keeps to its files, so it sees one version while others
write. Of two writers of one version the second fails and starts over. The manifest is as long as there are buckets.
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mandiscope.operators.relational import latest_by_key
from mandiscope.sources import files

#: Share of its base rows that a bucket's changes may reach before it is written anew.
COMPACT = 0.25


class Conflict(RuntimeError):
    """Another writer made the version first."""


class Manifest(NamedTuple):
    """``base`` has the version of each bucket's base rows, ``changes`` those of its changes in order, ``rows`` their numbers."""

    version: int
    buckets: int
    key: str
    order: list[str]
    schema: dict
    base: dict[str, int]
    changes: dict[str, list[int]]
    rows: dict[str, list[int]]


def bucket_of(key: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest | None:
    """The manifest of a version, else the newest; ``None`` for no table."""
    found = [int(n.removesuffix(".json")) for n in files.names(spark, f"{path}/manifest") if n.endswith(".json") and not n.startswith(("_", "."))]
    if not found:
        return None
    return Manifest(**json.loads(files.read_text(spark, f"{path}/manifest/{max(found) if version is None else version:012d}.json")))


def _commit(spark: SparkSession, path: str, new: Manifest) -> None:
    draft = f"{path}/manifest/_{uuid.uuid4().hex}"
    files.write_text(spark, draft, json.dumps(new._asdict()))
    if not files.move(spark, draft, f"{path}/manifest/{new.version:012d}.json"):
        files.delete(spark, draft)
        raise Conflict(f"version {new.version} of {path} exists")


def _write(rows: DataFrame, path: str, version: int, buckets: int, key: str) -> dict[str, int]:
    """Write rows to their buckets under a version; returns the number of rows per bucket."""
    dealt = rows.withColumn("bucket", bucket_of(key, buckets)).repartition(min(buckets, 200), "bucket")
    dealt.sortWithinPartitions("bucket", key).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/data/v={version}")
    spark = rows.sparkSession
    if not files.names(spark, f"{path}/data/v={version}") or not [n for n in files.names(spark, f"{path}/data/v={version}") if n.startswith("bucket=")]:
        return {}
    # Counts come from the files' footers, one row per bucket.
    counts = spark.read.parquet(f"{path}/data/v={version}").groupBy("bucket").agg(F.count("*").alias("n")).collect()
    return {str(r.bucket): r.n for r in counts}


def create(rows: DataFrame, path: str, key: str = "product_id", order: tuple[str, ...] = ("scraped_at",), buckets: int = 64) -> Manifest:
    """A new table of the latest row per key."""
    held = _write(latest_by_key(rows, key, order), path, 1, buckets, key)
    new = Manifest(1, buckets, key, list(order), rows.schema.jsonValue(), {b: 1 for b in held}, {}, {b: [n] for b, n in held.items()})
    _commit(rows.sparkSession, path, new)
    return new


def _read(spark: SparkSession, path: str, table: Manifest, places: dict[str, list[int]]) -> DataFrame:
    """Rows of the given versions of buckets, with ``v`` and ``bucket``."""
    schema = T.StructType([*T.StructType.fromJson(table.schema).fields, T.StructField("v", T.IntegerType()), T.StructField("bucket", T.IntegerType())])
    folders = sorted(f"{path}/data/v={v}/bucket={b}" for b, versions in places.items() for v in versions)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders)


def read(spark: SparkSession, path: str, version: int | None = None, keys: list | None = None) -> DataFrame:
    """The table as one version has it, the newest unless given.

    Buckets without changes are scanned as they are. In the others the base rows whose key has a change are left out,
    and the latest change of each key is added, so only changes are grouped. ``keys`` reads their buckets only.
    """
    table = manifest(spark, path, version)
    if table is None:
        raise FileNotFoundError(path)
    wanted = set(table.base) | set(table.changes)
    if keys is not None:
        kind = T.StructType.fromJson(table.schema)[table.key].dataType
        asked = spark.createDataFrame([(k,) for k in keys], T.StructType([T.StructField(table.key, kind)]))
        wanted &= {str(r.b) for r in asked.select(bucket_of(table.key, table.buckets).alias("b")).distinct().collect()}
    whole = _read(spark, path, table, {b: [v] for b, v in table.base.items() if b in wanted and b not in table.changes})
    rows = whole.drop("v", "bucket")
    mixed = [b for b in wanted if b in table.changes]
    if mixed:
        rows = rows.unionByName(_merged(spark, path, table, mixed))
    return rows.where(F.col(table.key).isin(list(keys))) if keys is not None else rows


def _merged(spark: SparkSession, path: str, table: Manifest, buckets: list[str]) -> DataFrame:
    base = _read(spark, path, table, {b: [table.base[b]] for b in buckets if b in table.base})
    changes = _read(spark, path, table, {b: table.changes[b] for b in buckets})
    latest = latest_by_key(changes, table.key, ["v", *table.order])
    untouched = base.join(changes.select(table.key).distinct(), table.key, "left_anti")
    return untouched.unionByName(latest).drop("v", "bucket")


def upsert(rows: DataFrame, path: str) -> Manifest:
    """Insert or replace rows by key; of equal keys in ``rows`` the latest wins. Returns the manifest written.

    Reads the buckets it writes anew and no others, and writes the buckets of its own keys.
    """
    spark = rows.sparkSession
    old = manifest(spark, path)
    if old is None:
        raise FileNotFoundError(path)
    names = T.StructType.fromJson(old.schema).fieldNames()
    version = old.version + 1
    held = _write(latest_by_key(rows.select(*names), old.key, old.order), path, version, old.buckets, old.key)
    base, changes, counts = dict(old.base), {b: list(v) for b, v in old.changes.items()}, {b: list(n) for b, n in old.rows.items()}
    for b, n in held.items():
        changes.setdefault(b, []).append(version)
        counts.setdefault(b, [0]).append(n)
    new = old._replace(version=version, base=base, changes=changes, rows=counts)
    full = [b for b in held if sum(counts[b][1:]) > COMPACT * counts[b][0]]
    if full:
        # Versions are even for changes and odd for rewritten buckets, so neither overwrites the other.
        packed = version + 1
        merged = _write(_merged(spark, path, new, full), path, packed, old.buckets, old.key)
        for b in full:
            base[b], counts[b] = packed, [merged[b]]
            del changes[b]
        new = new._replace(version=packed)
    _commit(spark, path, new)
    return new


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Drop manifests but the newest ``keep`` and the folders none of these name; returns the folders dropped."""
    found = [n for n in files.names(spark, f"{path}/manifest") if n.endswith(".json")]
    for name in found[:-keep]:
        files.delete(spark, f"{path}/manifest/{name}")
    kept = [manifest(spark, path, int(n.removesuffix(".json"))) for n in found[-keep:]]
    named = {(v, b) for m in kept for b, v in m.base.items()} | {(v, b) for m in kept for b, versions in m.changes.items() for v in versions}
    newest = max((m.version for m in kept), default=0)
    gone = []
    for folder in files.names(spark, f"{path}/data"):
        # A version above the newest belongs to a write under way.
        if folder.startswith("v=") and int(folder[2:]) <= newest:
            for bucket in files.names(spark, f"{path}/data/{folder}"):
                if bucket.startswith("bucket=") and (int(folder[2:]), bucket[7:]) not in named:
                    gone.append(f"{folder}/{bucket}")
                    files.delete(spark, f"{path}/data/{gone[-1]}")
    return gone
