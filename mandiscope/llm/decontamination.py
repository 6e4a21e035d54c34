"""Benchmark passages in documents: SimHash of item-sized windows, Hamming blocks, exact verification.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mandiscope.llm.common import KEY, bounded, document_key, keyed, whole_text
from mandiscope.session import written

WIDTH = 5
SIMILARITY = 0.8
#: Fingerprints are compared up to so many differing bits. At a similarity of 0.8 some 10 of 64 bits differ with a
#: deviation of 3, so about one pair in a thousand at the very threshold is farther away.
RADIUS = 19
PARTS = 4


def words(text: Column) -> Column:
    """Lower-case words: runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingles(tokens: Column, width: Column | int = WIDTH) -> Column:
    """Hash of every run of ``width`` words in order; empty if there are fewer."""
    width = F.lit(width) if isinstance(width, int) else width
    last = F.size(tokens) - width + 1
    every = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(tokens, i, width)))
    return F.when((last > 0) & (width > 0), every).otherwise(F.array().cast("array<bigint>"))


def weighted_fingerprint(hashes: Column) -> Column:
    """64 bits; each is the majority over the shingles, weighted by their number of occurrences."""
    def bit(b: Column) -> Column:
        votes = F.aggregate(hashes, F.lit(0).cast("bigint"), lambda a, h: a + F.getbit(h, b))
        return F.when(votes * 2 > F.size(hashes), F.call_function("shiftleft", F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint"))

    bits = F.transform(F.sequence(F.lit(0), F.lit(63)), bit)
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda a, x: a.bitwiseOR(x))


def _numbered(hashes: Column) -> Column:
    """The same hashes with repeats told apart, so that sets of them compare as bags."""
    repeated = F.transform(hashes, lambda h, i: F.xxhash64(h, F.size(F.filter(F.slice(hashes, F.lit(1), i), lambda x: x == h))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.transform(hashes, lambda h: F.xxhash64(h, F.lit(0)))).otherwise(repeated)


def _items(benchmark: DataFrame) -> DataFrame:
    """Items with at least one word: shingles of five words, or of all words if there are fewer."""
    tokens = benchmark.where("item_id is not null").select("item_id", words(whole_text()).alias("words")).withColumn("n", F.size("words"))
    tokens = tokens.where("n > 0").withColumn("width", F.least(F.lit(WIDTH), "n"))
    return tokens.withColumn("hashes", shingles(F.col("words"), F.col("width"))).drop("words").dropDuplicates(["item_id", "hashes"])


def windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Item-sized windows of documents that can be similar to an item: key, ``start`` (word from 0), ``n`` words, ``width``.

    A window without a shingle of the item has similarity zero, so windows are laid where a shingle of a document
    equals one of an item, aligned at it, and kept inside the document.
    """
    found = None
    anchors = items.select("width", "n", F.posexplode("hashes").alias("offset", "h")).distinct()
    for width in sorted(r[0] for r in items.select("width").distinct().collect()):
        own = bounded(anchors.where(F.col("width") == width).drop("width"))
        places = (
            docs.select(*document_key(), words(whole_text()).alias("words"))
            .select(*KEY, F.size("words").alias("size"), F.posexplode(shingles(F.col("words"), width)).alias("place", "h"))
            .join(own, "h")
        )
        start = F.greatest(F.lit(0), F.least(F.col("place") - F.col("offset"), F.col("size") - F.col("n")))
        laid = places.select(*KEY, start.alias("start"), F.least("n", "size").alias("n"), F.lit(width).alias("width"))
        found = laid if found is None else found.union(laid)
    return found.distinct()


def _near(prints: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs of window and item fingerprints within ``RADIUS`` bits.

    64 bits fall into four parts. Of ``RADIUS`` differing bits some part holds a quarter at most, so every value that
    close to a part of an item is indexed, and equal parts find each pair within the radius.
    """
    size = 64 // PARTS
    near = RADIUS // PARTS

    def part(fp: str, p: int) -> Column:
        return F.shiftrightunsigned(fp, p * size).bitwiseAND(F.lit((1 << size) - 1)).alias("value")

    masks = ",".join(str(x) for x in range(1 << size) if x.bit_count() <= near)
    flips = F.split(F.lit(masks), ",").cast("array<bigint>")
    parts = F.array(*[F.struct(F.lit(p).alias("part"), part("item_fp", p)) for p in range(PARTS)])
    index = (
        items.select("item_fp").distinct().select("item_fp", F.explode(parts).alias("k"))
        .select("item_fp", "k", F.explode(flips).alias("flip"))
        .select("item_fp", "k.part", F.col("k.value").bitwiseXOR(F.col("flip")).alias("value"))
    )
    own = F.array(*[F.struct(F.lit(p).alias("part"), part("fp", p)) for p in range(PARTS)])
    probes = prints.select("fp").distinct().select("fp", F.explode(own).alias("k")).select("fp", "k.part", "k.value")
    # The planner takes the index for as small as the items, but it has thousands of values for each.
    found = probes.join(index.hint("merge"), ["part", "value"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS)
    return found.select("fp", "item_fp").distinct()


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document (key) with benchmark passages: ``items``, a sorted array of (item_id, similarity)."""
    items = written(_items(benchmark).withColumn("item_fp", weighted_fingerprint(F.col("hashes"))))
    if not items.head(1):
        spark = docs.sparkSession
        return spark.createDataFrame([], "key bigint, key2 bigint, items array<struct<item_id:bigint,similarity:double>>")
    laid = written(windows(docs, items).groupBy(*KEY).agg(F.collect_list(F.struct("start", "n", "width")).alias("windows")))
    texts = docs.select(*document_key(), whole_text().alias("text")).join(bounded(laid), KEY).dropDuplicates(KEY)
    cut = (
        texts.select(*KEY, words(F.col("text")).alias("words"), "windows")
        .select(*KEY, F.explode(F.transform("windows", lambda w: F.struct(w["width"].alias("width"), F.slice("words", w["start"] + 1, w["n"]).alias("words")))).alias("w"))
        .select(*KEY, "w.width", shingles(F.col("w.words"), F.col("w.width")).alias("own"))
    )
    prints = written(cut.withColumn("fp", weighted_fingerprint(F.col("own"))))
    pairs = prints.join(_near(prints, items), "fp").join(items.select("item_id", "item_fp", "width", "hashes"), ["item_fp", "width"])
    common = F.size(F.array_intersect(_numbered(F.col("own")), _numbered(F.col("hashes"))))
    similarity = common / (F.size("own") + F.size("hashes") - common)
    found = pairs.select(*KEY, "item_id", similarity.alias("similarity")).where(F.col("similarity") >= SIMILARITY)
    best = found.groupBy(*KEY, "item_id").agg(F.max("similarity").alias("similarity"))
    return best.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("item_id", "similarity"))).alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``contaminated``, ``n_items``, ``item_ids`` and the best ``similarity``.

    A document is contaminated if a window of as many words as an item (the whole document if it is shorter) has a
    weighted similarity of 0.8 or more to it: shingles of five words, weighted by occurrence, smaller weights over
    larger ones. Items of fewer words are one shingle; items and texts without words (null, empty) match nothing. Items
    without an id are left out, repeated items count once, equal texts are contaminated alike. Without documents there
    are no rows, without items no contaminated ones. Other columns are ignored.
    """
    found = leaks(docs, benchmark)
    return docs.select("doc_id", *document_key()).join(found, KEY, "left").select(
        "doc_id",
        F.col("items").isNotNull().alias("contaminated"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce(F.array_join(F.transform("items", lambda i: i["item_id"].cast("string")), ","), F.lit("")).alias("item_ids"),
        F.coalesce(F.array_max(F.transform("items", lambda i: i["similarity"])), F.lit(0.0)).alias("similarity"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated documents; all columns stay."""
    found = bounded(written(leaks(docs, benchmark).select(*KEY)))
    return keyed(docs).join(found, KEY, "left_anti").select("row.*")
