"""Mix sources to target weights: capped water-filling of epochs, then seeded whole and fractional repetitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mandiscope.llm.common import bounded, whole_text
from mandiscope.session import written

#: Weights dealt to the sources in order, again and again.
WEIGHTS = 3, 1, 2
#: Words of the mix, times those of all documents.
SHARE = 1.5
#: Times that a source, and so a document, may be repeated.
EPOCHS = 2
SEED = "mix"
#: Bits of the place of a document in the seeded order of its source, and those looked at in one pass.
PLACE_BITS, PASS_BITS = 60, 12
#: Copies of a source's row if the sources are too many to broadcast, so that a hot source meets its documents in many tasks.
COPIES = 16

MIXING_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS place
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        ([3, 1, 2])[(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT]::DOUBLE AS weight
    FROM sized GROUP BY source
), filling AS (
    SELECT *, 2.0::DOUBLE * source_size AS cap,
        1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER lower, 0) AS room,
        sum(weight) OVER () - coalesce(sum(weight) OVER lower, 0) AS shared
    FROM sources
    WINDOW lower AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
    SELECT arg_min(room, shared) AS room, min(shared) AS shared FROM filling f
    WHERE NOT EXISTS (SELECT 1 FROM filling g WHERE g.shared > f.shared AND g.weight * g.room <= g.cap * g.shared)
), targets AS (
    SELECT source, source_size,
        CASE WHEN weight * level.room > cap * level.shared THEN cap ELSE (weight * level.room) / level.shared END AS target
    FROM sources JOIN filling USING (source, source_size, weight), level
    WHERE source IS NOT NULL
    UNION ALL
    SELECT NULL, source_size,
        CASE WHEN weight * level.room > cap * level.shared THEN cap ELSE (weight * level.room) / level.shared END
    FROM filling, level WHERE source IS NULL
), ordered AS (
    SELECT s.doc_id, s.size, t.source_size, t.target, floor(t.target / nullif(t.source_size, 0)) AS whole,
        coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
    coalesce(size * (whole + CASE WHEN 2 * before + size <= 2 * (target - whole * source_size) THEN 1 ELSE 0 END), 0)::BIGINT AS taken
FROM ordered
"""


def word_count(column: str = "text") -> Column:
    """Number of words between ASCII white space; null and blank texts have none."""
    return F.regexp_count(whole_text(column), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def numbered(values: DataFrame, column: str) -> DataFrame:
    """``values`` with ``rank`` from 0 in ascending order of ``column``, null last.

    Range partitions are numbered within and moved by the counts of those before, so no task orders all rows.
    """
    spark = values.sparkSession
    order = F.col(column).asc_nulls_last()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(values.repartitionByRange(parts, order).withColumn("part", F.spark_partition_id()))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = dealt.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("part").orderBy(order))
    # One row for each range partition.
    return dealt.withColumn("within", within).join(F.broadcast(counts), "part").withColumn("rank", F.col("within") + F.col("before") - 1).drop("part", "within", "before")


def water_fill(sources: DataFrame, share: float = SHARE, epochs: float = EPOCHS) -> DataFrame:
    """``sources`` (``source_size``, ``weight``) with ``target``: ``share`` of all sizes, dealt by weight under the cap.

    Each round clamps the sources whose part exceeds ``epochs`` times their size and deals what is left to the others
    by weight. The level only rises, so a round needs no more than the sums over the clamped sources; the rounds end
    when no further source is above. If ``share`` is not below ``epochs``, every source meets its cap.
    """
    weight, cap = F.col("weight").cast("double"), F.lit(float(epochs)) * F.col("source_size")
    size, weights = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum(weight), F.lit(0.0))).first()
    room, shared, clamped = share * size, weights, 0
    while True:
        above = weight * F.lit(room) > cap * F.lit(shared)
        many, full, taken = sources.where(above).agg(F.count("*"), F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum(weight), F.lit(0.0))).first()
        if many <= clamped or not shared:
            break
        clamped, room, shared = many, share * size - epochs * full, weights - taken
    level = (weight * F.lit(room)) / F.lit(shared) if shared else cap
    return sources.withColumn("target", F.when(above, cap).otherwise(level) if shared else cap)


def _beside(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with the columns of their source; ``sources`` is broadcast if small, else repeated for salted rows."""
    other = sources.withColumnRenamed("source", "its")
    small = bounded(other)
    match = F.col("source").eqNullSafe(F.col("its"))
    if small is other:
        small = other.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
        return rows.withColumn("dealt", F.pmod("row", F.lit(COPIES)).cast("int")).join(small, match & (F.col("dealt") == F.col("salt"))).drop("its", "salt", "dealt")
    return rows.join(small, match).drop("its")


def _digits() -> list[Column]:
    """Digits of a document's place, then of its row, from the most significant."""
    mask = (1 << PASS_BITS) - 1
    return [
        F.shiftright(column, shift).bitwiseAND(F.lit(mask))
        for column, bits in (("place", PLACE_BITS), ("row", PLACE_BITS + PASS_BITS))
        for shift in range(bits - PASS_BITS, -1, -PASS_BITS)
    ]


def _thresholds(rows: DataFrame, wanted: DataFrame) -> tuple[DataFrame, int]:
    """Where in the seeded order of each source its fractional repetition ends.

    ``wanted`` has ``source`` and ``need``, words to take in that order. Each pass sums the words by the next digit of
    the documents at the border and goes on in the one digit where the sum exceeds ``need``, until every border
    is a single document. Returns ``source``, ``need``, ``before`` (words before the border) and ``path`` (its digits),
    and the number of digits.
    """
    border = wanted.select("source", "need", F.lit(0).cast("long").alias("before"), F.array().cast("array<long>").alias("path"))
    digits = _digits()
    for depth, digit in enumerate(digits):
        inside = _beside(rows, border).where(F.array(*digits[:depth]).cast("array<long>") == F.col("path"))
        sums = inside.groupBy("source", digit.alias("digit")).agg(
            F.sum("size").alias("words"), F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("need", "before", "path")]
        )
        order = Window.partitionBy("source").orderBy("digit")
        running = F.col("before") + F.sum("words").over(order)
        over = sums.withColumn("after", running).where(F.col("after") > F.col("need"))
        first = over.withColumn("least", F.min("digit").over(Window.partitionBy("source"))).where(F.col("digit") == F.col("least"))
        border = written(first.select("source", "need", (F.col("after") - F.col("words")).alias("before"), F.array_append("path", F.col("digit")).alias("path"), "n"))
        if (border.agg(F.max("n")).first()[0] or 0) <= 1:
            break
    return border.drop("n"), depth + 1


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``size`` (words), ``source_size``, ``target`` of its source and ``taken``.

    Sources in code-point order, null last, get ``weights`` in turn; ``water_fill`` gives their targets. A document
    is repeated ``floor(target / source_size)`` times whole; the fraction left is filled by whole documents in the
    order of the MD5 of ``seed``, id and text, each of which is taken if the middle of its words lies before the end.
    So a source misses its target by at most half of one document, no document is taken more than ``epochs`` times,
    and the result depends on nothing but the rows.

    Null texts have size 0, as have blank ones; a source of such documents has the target 0. A null id counts as
    empty text in the order. Rows equal in id, text and source are ordered by a row number that is written once; they
    are alike, so reruns give the same rows. An empty table gives no rows. Other columns are ignored.
    """
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), whole_text())
    place = F.conv(F.substring(F.md5(text.cast("binary")), 1, PLACE_BITS // 4), 16, 10).cast("long")
    rows = written(docs.select("doc_id", "source", word_count().alias("size"), place.alias("place"), F.monotonically_increasing_id().alias("row")))
    sources = numbered(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "source")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    sources = written(water_fill(sources.withColumn("weight", turn), share, epochs))
    whole = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long")
    need = F.col("target") - F.col("whole") * F.col("source_size")
    sources = sources.withColumn("whole", whole).withColumn("need", need)
    border, depth = _thresholds(rows, sources.where("need > 0"))
    found = sources.select("source", "source_size", "target", "whole", "need").join(
        border.select(F.col("source").alias("its"), "before", "path"), F.col("source").eqNullSafe(F.col("its")), "left"
    )
    at = F.array(*_digits()[:depth]).cast("array<long>")
    extra = (F.col("need") > 0) & F.when(F.col("path").isNull() | (at < F.col("path")), True).otherwise(
        (at == F.col("path")) & (2 * F.col("before") + F.col("size") <= 2 * F.col("need"))
    )
    joined = _beside(rows, written(found.drop("its")))
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * (F.col("whole") + extra.cast("long"))).alias("taken"))
