"""Document fingerprints that subtract: invertible Bloom lookup tables of paragraph digests.

Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mandiscope.llm.common import whole_text
from mandiscope.session import written

#: Cells of a table: three thirds, and each digest has one cell in every third.
THIRD = 8
CELLS = 3 * THIRD
ROUNDS = 8
#: Digests a block of a larger table is laid out for at the first retry.
LOAD = 6
RETRIES = 8

_CELLS = "array<struct<n:int,key:bigint,check:bigint>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _check(key: Column) -> Column:
    return F.xxhash64(F.lit("check"), key)


def _cell(digest: Column, third: Column) -> Column:
    """Number of the digest's cell in a third, counted from 0 over the table."""
    return third * THIRD + F.call_function("shiftright", digest, third * 8 + 7).bitwiseAND(F.lit(THIRD - 1)).cast("int")


def digests(text: Column) -> Column:
    """The set of digests of the paragraphs: the lines of ``text`` that are not blank."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.trim(line) != "")
    return F.array_distinct(F.transform(lines, lambda line: F.xxhash64(line)))


def _xor(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a.bitwiseXOR(x))


def table(items: Column) -> Column:
    """The cells of a set of digests: number, exclusive or of the digests, exclusive or of their checks."""

    def cell(c: Column) -> Column:
        third = F.floor(c / THIRD).cast("int")
        hits = F.filter(items, lambda d: _cell(d, third) == c)
        return _let(hits, lambda h: F.struct(F.size(h).alias("n"), _xor(h).alias("key"), _xor(F.transform(h, _check)).alias("check")))

    return F.transform(F.sequence(F.lit(0), F.lit(CELLS - 1)), cell).cast(_CELLS)


def subtract(left: Column, right: Column) -> Column:
    """Cells of the difference: what both have cancels out."""
    return F.zip_with(
        left,
        right,
        lambda a, b: F.struct(
            (a["n"] - b["n"]).alias("n"), a["key"].bitwiseXOR(b["key"]).alias("key"), a["check"].bitwiseXOR(b["check"]).alias("check")
        ),
    ).cast(_CELLS)


def peel(cells: Column) -> Column:
    """Struct of the cells that remain and ``found``, the recovered (n, key): n is 1 if only the left side has the digest, else -1.

    A cell with one digest gives it away; taking it out of its other cells may leave them with one.
    """

    def step(state: Column, _: Column) -> Column:
        pure = F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (c["check"] == _check(c["key"])))
        single = F.array_distinct(F.transform(pure, lambda c: F.struct(c["n"].alias("n"), c["key"].alias("key"))))

        def taken(keys: Column) -> Column:
            def without(c: Column, i: Column) -> Column:
                third = F.floor(i / THIRD).cast("int")
                hits = F.filter(keys, lambda k: _cell(k["key"], third) == i)
                return _let(
                    hits,
                    lambda h: F.when(F.size(h) == 0, c).otherwise(
                        F.struct(
                            (c["n"] - F.aggregate(h, F.lit(0), lambda a, k: a + k["n"])).alias("n"),
                            c["key"].bitwiseXOR(_xor(F.transform(h, lambda k: k["key"]))).alias("key"),
                            c["check"].bitwiseXOR(_xor(F.transform(h, lambda k: _check(k["key"])))).alias("check"),
                        )
                    ),
                )

            return F.when(F.size(keys) == 0, state).otherwise(
                F.struct(F.transform(state["cells"], without).alias("cells"), F.concat(state["found"], keys).alias("found"))
            )

        return _let(single, taken)

    start = F.struct(cells.alias("cells"), F.array().cast("array<struct<n:int,key:bigint>>").alias("found"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def _empty(cells: Column) -> Column:
    return F.forall(cells, lambda c: (c["n"] == 0) & (c["key"] == 0) & (c["check"] == 0))


def fingerprint(cells: Column) -> Column:
    """The table as text: number, key and check of each cell in hexadecimal, nothing for an empty cell."""
    return F.array_join(
        F.transform(
            cells,
            lambda c: F.when((c["n"] == 0) & (c["key"] == 0) & (c["check"] == 0), F.lit("")).otherwise(
                F.concat_ws(":", F.lower(F.hex(c["n"])), F.lower(F.hex(c["key"])), F.lower(F.hex(c["check"])))
            ),
        ),
        ",",
    )


def _peeled(pairs: DataFrame, by: list[str]) -> DataFrame:
    """Subtract the tables of ``x`` and ``y`` and peel: ``ok``, and ``differ``, the number of digests recovered."""
    state = pairs.withColumn("p", peel(subtract(table(F.col("x")), table(F.col("y")))))
    return state.select(*by, _empty(F.col("p.cells")).alias("ok"), F.size("p.found").cast("long").alias("differ"))


def differences(pairs: DataFrame) -> DataFrame:
    """Number of digests that only one of ``x`` and ``y`` has, by peeling: columns ``pair``, ``pair2``, ``differ``.

    ``pairs`` has ``pair``, ``pair2`` (which tell pairs apart) and two arrays of digests. Pairs whose difference does
    not fit the table are tried again in larger ones: tables of as many blocks as the sizes of the two sets ask for,
    then twice as many, and so on. Blocks are rows of their own, so the work is in proportion to the digests however
    long a document is. What ``RETRIES`` tables can't resolve is compared digest by digest.
    """
    by = ["pair", "pair2"]
    tried = written(_peeled(pairs, by))
    done = tried.where("ok").drop("ok")
    failed = tried.where("not ok").select(*by)
    for retry in range(RETRIES):
        if not failed.head(1):
            return done
        blocks = (F.ceil((F.size("x") + F.size("y")) / LOAD) * (1 << retry)).cast("int")
        sides = F.concat(
            F.transform("x", lambda d: F.struct(d.alias("d"), F.lit(1).alias("side"))),
            F.transform("y", lambda d: F.struct(d.alias("d"), F.lit(-1).alias("side"))),
        )
        rows = pairs.join(failed, by).select(*by, blocks.alias("blocks"), F.explode(sides).alias("s"))
        # Cells within a block come from other bits, renewed at each retry.
        renewed = F.xxhash64(F.lit(retry), F.col("s.d"))
        block = F.pmod(F.xxhash64(F.lit(f"block{retry}"), F.col("s.d")), F.col("blocks"))
        split = rows.select(*by, block.alias("block"), "s.side", renewed.alias("d"))
        sets = split.groupBy(*by, "block").agg(
            F.collect_list(F.when(F.col("side") > 0, F.col("d"))).alias("x"), F.collect_list(F.when(F.col("side") < 0, F.col("d"))).alias("y")
        )
        result = _peeled(sets, by).groupBy(*by).agg(F.min("ok").alias("ok"), F.sum("differ").alias("differ"))
        tried = written(result)
        done = done.union(tried.where("ok").drop("ok"))
        failed = tried.where("not ok").select(*by)
    exact = F.size(F.array_except("x", "y")) + F.size(F.array_except("y", "x"))
    return done.union(pairs.join(failed, by).select(*by, exact.cast("long").alias("differ")))


def _bounds(docs: DataFrame, parts: int) -> list[int]:
    """Ascending ids, all of them present, that divide the ids into about equal parts; the last is the largest id."""
    shares = [k / parts for k in range(1, parts + 1)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 20 * parts).alias("ids"), F.max("doc_id").alias("top")).first()
    return sorted({*(found["ids"] or []), *([] if found["top"] is None else [found["top"]])})


def _part(bounds: list[int]) -> Column:
    """Number of bounds below the id, by binary search; 0 for a null id."""
    step = 1 << max(len(bounds).bit_length() - 1, 0)
    steps = [step >> k for k in range(step.bit_length())]
    known = F.array(*[F.lit(b).cast("bigint") for b in bounds])
    return F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda low, s: F.when(F.get(known, low + s - 1) < F.col("doc_id"), low + s).otherwise(low),
    )


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` (null as empty) and ``next``, the text of the next row in descending order of id.

    Rows of equal id follow by text, rows without an id come last, and after the last comes the first. Ids are dealt
    out in ranges; the row at the top of a range is repeated below the range above, which makes each range complete,
    so every text moves once and no task orders all rows.
    """
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(docs, parts)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    part = _part(bounds) if bounds else F.lit(0)
    top = F.lit(bounds[-1] if bounds else None).cast("bigint")
    is_bound = F.col("doc_id") == F.get(F.array(*[F.lit(b).cast("bigint") for b in bounds]), F.col("part")) if bounds else F.lit(False)
    copies = F.array_compact(
        F.array(
            F.struct(F.col("part").alias("part"), F.lit(0).alias("copy")),
            F.when(is_bound & (F.col("part") < len(bounds) - 1), F.struct((F.col("part") + 1).alias("part"), F.lit(1).alias("copy"))),
            F.when(F.col("doc_id") == top, F.struct(F.lit(0).alias("part"), F.lit(2).alias("copy"))),
        )
    )
    dealt = rows.withColumn("part", part).withColumn("c", F.explode(copies)).select("doc_id", "text", "c.part", "c.copy")
    order = Window.partitionBy("part").orderBy(F.col("copy") == 2, F.desc_nulls_last("doc_id"), "text")
    first = F.first("text").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    following = F.coalesce(F.lead("text").over(order), first)
    return dealt.select("doc_id", "text", "copy", following.alias("next")).where("copy = 0").drop("copy")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``, comparing each text with an edited version and with the next text.

    The edited text has the last half (rounded down) of its code points replaced by the first as many of the next text
    in descending order of id, or all of it. Columns: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next`` (shared paragraphs over all paragraphs, 1 for two texts without
    any), ``n_paragraphs`` and ``n_edited_paragraphs``.

    A null text is empty and has an empty table. Rows of equal id follow by text; rows without an id come last. An
    empty table gives no rows; a single row is its own next. Equal texts have equal fingerprints. Other columns are ignored.
    """
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next", F.lit(1), half))
    base = with_next(docs).select("doc_id", n.cast("long").alias("n_chars"), "text", "next", edited.alias("edited"))
    base = written(
        base.select(
            "doc_id",
            "n_chars",
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            digests(F.col("text")).alias("a"),
            digests(F.col("edited")).alias("b"),
            digests(F.col("next")).alias("c"),
        )
    )

    def pair(x: str, y: str) -> list[Column]:
        return [F.xxhash64(x, F.lit("-"), y), F.xxhash64(F.lit("second"), x, F.lit("-"), y)]

    both = F.array(*[F.struct(pair("a", y)[0].alias("pair"), pair("a", y)[1].alias("pair2"), F.col("a").alias("x"), F.col(y).alias("y")) for y in "bc"])
    pairs = base.select(F.explode(both).alias("p")).select("p.*").dropDuplicates(["pair", "pair2"])
    found = differences(pairs)
    out = base
    for y, name in (("b", "near_edited"), ("c", "near_next")):
        own = found.select(F.col("pair").alias(f"{y}1"), F.col("pair2").alias(f"{y}2"), F.col("differ").alias(f"{y}n"))
        out = out.withColumns(dict(zip((f"{y}1", f"{y}2"), pair("a", y)))).join(own, [f"{y}1", f"{y}2"])
        size = F.size("a") + F.size(y)
        near = F.when(size == 0, 1.0).otherwise((size - F.col(f"{y}n")) / (size + F.col(f"{y}n")))
        out = out.withColumn(name, near).drop(f"{y}1", f"{y}2", f"{y}n")
        if y == "c":
            out = out.drop("c")
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(table(F.col("a"))).alias("fingerprint"),
        fingerprint(table(F.col("b"))).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        F.size("a").cast("long").alias("n_paragraphs"),
        F.size("b").cast("long").alias("n_edited_paragraphs"),
    )
