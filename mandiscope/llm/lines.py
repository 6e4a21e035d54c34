"""De-duplication of lines by overlapping windows of three."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mandiscope.llm.common import KEY, document_key, field, keyed, whole_text
from mandiscope.session import written

WINDOW = 3


def repeated_windows(docs: DataFrame) -> DataFrame:
    """Documents with a window of three consecutive lines that occurred before: their key and ``covered``, line numbers from 0.

    Lines are compared without surrounding blanks. The first occurrence is the one of least (id, text hash, line).
    Every later one is repeated, also within a document. Windows of blank lines only are not counted.
    """
    trimmed = F.transform(F.split(whole_text(), "\n", -1), lambda line: F.trim(line))
    hashed = F.transform(
        F.sequence(F.lit(1), F.size("lines") - (WINDOW - 1)),
        lambda i: F.struct(
            (i - 1).alias("line"),
            F.xxhash64(F.slice("lines", i, WINDOW)).alias("h"),
            F.xxhash64(F.lit("second"), F.slice("lines", i, WINDOW)).alias("h2"),
            (F.concat_ws("", F.slice("lines", i, WINDOW)) == "").alias("blank"),
        ),
    )
    windows = (
        docs.select("doc_id", *document_key(), trimmed.alias("lines"))
        .where(F.size("lines") >= WINDOW)
        .select("doc_id", *KEY, F.explode(hashed).alias("w"))
        .select("doc_id", *KEY, "w.*")
        .where("not blank")
        .drop("blank")
        .withColumn("at", F.struct("doc_id", *KEY, "line"))
    )
    # Written first: only repeated windows are left, and the rows of a very common one can be split at the join.
    first = written(windows.groupBy("h", "h2").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    later = windows.select("h", "h2", "at").join(first, ["h", "h2"]).where(~F.col("at").eqNullSafe(F.col("first")))
    lines = F.array_distinct(F.flatten(F.transform(F.collect_list("at.line"), lambda i: F.sequence(i, i + (WINDOW - 1)))))
    return later.groupBy(*[F.col(f"at.{k}").alias(k) for k in KEY]).agg(F.array_sort(lines).alias("covered"))


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with every line covered by a repeated window removed, and the counts ``n_lines``, ``n_removed_lines``.

    The covered positions of overlapping windows merge. All columns stay; ``text`` holds what is left, ``n_chars`` its
    length if there is such a column; columns named like the counts are replaced. Texts without a repeated window are
    unchanged (null stays null), a text of which nothing is left becomes empty, texts of fewer than three lines are
    never touched. Rows equal in id and text count as one document, so a repeated row is not its own repetition. Null
    ids come first in the order of occurrence. An empty table gives no rows.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed_lines")]
    joined = keyed(docs).join(repeated_windows(docs), KEY, "left")
    lines = F.split(F.coalesce(field("text"), F.lit("")), "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "covered")
    left = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    text = F.when(F.col("covered").isNull(), field("text")).otherwise(left)
    out = joined.select(
        *[text.alias(c) if c == "text" else field(c) for c in names],
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("covered"), F.lit(0)).cast("long").alias("n_removed_lines"),
    )
    if "n_chars" in names:
        changed = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("n_removed_lines") > 0, changed).otherwise(F.col("n_chars")))
    return out


#: The kept text and counts, stated in SQL. Line windows are compared as text.
LINES_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), w AS (
  SELECT r, doc_id, unnest(range(0, len(lines) - 2)) AS line, list_transform(lines, lambda x: trim(x, ' ')) AS t FROM d WHERE len(lines) >= 3
), k AS (
  SELECT r, doc_id, line, list_aggregate(t[line + 1 : line + 3], 'string_agg', chr(10)) AS body FROM w
), o AS (
  SELECT r, line, row_number() OVER (PARTITION BY body ORDER BY doc_id, line) AS n FROM k WHERE trim(replace(body, chr(10), ''), ' ') <> ''
), c AS (
  SELECT r, list(DISTINCT line + j) AS covered FROM o, (SELECT unnest([0, 1, 2]) AS j) WHERE n > 1 GROUP BY r
)
SELECT doc_id, len(lines) AS n_lines, coalesce(len(covered), 0) AS n_removed_lines,
  sha256(coalesce(array_to_string(list_transform(list_filter(range(0, len(lines)), lambda i: NOT list_contains(coalesce(covered, []), i)),
    lambda i: lines[i + 1]), chr(10)), '')) AS kept_sha256
FROM d LEFT JOIN c USING (r)
"""
