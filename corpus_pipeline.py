"""Clean, de-duplicate and pack `documents` for training; each stage reads what the one before it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mandiscope.llm import decontamination, lines, packing, simhash, toxicity
from mandiscope.llm.common import load
from mandiscope.session import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, load(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.drop_repeated_lines(docs).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark),
    ("best_fit_packing", pack),
]

#: SQL can state neither the fitted classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the table `documents`, each written to the shared folder before the next reads it.

    Null, empty and blank texts are clean, have no lines to drop, share fingerprint zero, so one of them with an id stays,
    and are packed as the end token alone. Rows without an id stay in every stage. A row that is repeated whole is scored and
    cut like one, and one of its copies with an id stays. Long texts are read whole; columns besides `doc_id`
    and `text` are carried to the last stage under any name. An empty table gives no rows.
    """
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
