"""The operators as named queries over whole tables, with SQL where it can state the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mandiscope.llm import decontamination, fingerprints, language, lines, mixing, packing, periodic, pii, secrets, simhash, spelling, substrings, toxicity
from mandiscope.llm.common import load


def op1_paragraph_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_fingerprints(load(spark, folder, "documents"))


def op2_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_digest(load(spark, folder, "documents"))


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secrets_digest(load(spark, folder, "documents"))


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination(load(spark, folder, "documents"), load(spark, folder, "benchmark"))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(load(spark, folder, "documents"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(load(spark, folder, "documents"), load(spark, folder, "labels"))


def op7_repeated_substrings(spark: SparkSession, folder: str) -> DataFrame:
    kept = substrings.remove_repeats(load(spark, folder, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.language(load(spark, folder, "documents"))


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = lines.drop_repeated_lines(load(spark, folder, "documents"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_lines", "n_removed_lines", digest)


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(load(spark, folder, "documents"))
    return found.select("doc_id", simhash.hexadecimal().alias("fingerprint"), "component_id")


def op11_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(load(spark, folder, "documents"))


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(load(spark, folder, "documents"), spelling.misspelt)


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic.periodic_digest(load(spark, folder, "documents"))


QUERIES = {
    "op1_paragraph_fingerprints": (op1_paragraph_fingerprints, None),
    "op2_personal_data": (op2_personal_data, None),
    "op3_secrets": (op3_secrets, secrets.SECRETS_SQL),
    "op4_decontamination": (op4_decontamination, None),
    "op5_packing": (op5_packing, None),
    "op6_toxicity": (op6_toxicity, None),
    "op7_repeated_substrings": (op7_repeated_substrings, substrings.REPEATS_SQL),
    "op8_language": (op8_language, None),
    "op9_line_dedup": (op9_line_dedup, lines.LINES_SQL),
    "op10_simhash": (op10_simhash, None),
    "op11_mixing": (op11_mixing, mixing.MIXING_SQL),
    "op12_spelling": (op12_spelling, spelling.SPELLING_SQL),
    "op13_periodic_runs": (op13_periodic_runs, periodic.PERIODIC_SQL),
}
