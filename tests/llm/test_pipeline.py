"""The pipeline against its operators, and its queries against their SQL."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check import compare, connect
from mandiscope.llm import decontamination, lines, packing, simhash, toxicity
from mandiscope.llm.common import load
from mandiscope.llm.queries import QUERIES


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_sql(spark, folder, name):
    run, sql = QUERIES[name]
    assert compare(run(spark, folder).toPandas(), connect(folder).execute(sql).df()) == ""


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


def test_pipeline(spark, folder):
    docs, labels, benchmark = (load(spark, folder, t) for t in ("documents", "labels", "benchmark"))
    scores = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, labels).collect()}
    kept = docs.where(docs.doc_id.isin([i for i, p in scores.items() if not p]))
    kept = lines.drop_repeated_lines(kept).select(docs.columns)
    first = {r.doc_id for r in simhash.near_duplicates(kept).collect() if r.doc_id == r.component_id}
    kept = kept.where(kept.doc_id.isin(list(first)))
    leaked = {r.doc_id for r in decontamination.contamination(kept, benchmark).collect() if r.contaminated}
    kept = kept.where(~kept.doc_id.isin(list(leaked)))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    want = sorted(map(tuple, packing.token_pieces(kept).select(columns).collect()))
    made = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, made.select(columns).collect())) == want and leaked
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity"


ODD = [
    (1, "the first text has some words of its own and goes on for a while here"),
    (1, "the first text has some words of its own and goes on for a while here"),
    (2, "another text under an id that repeats with other words in it today"),
    (2, "a third text that is told apart by its words although the id is the same"),
    (3, None),
    (4, ""),
    (5, " \n\t"),
    (None, "a text without any id that says this and that to whoever may read"),
    (None, "a text without any id that says this and that to whoever may read"),
    (None, None),
    (6, " ".join(f"w{k}x{k * k % 101}" for k in range(9_000))),
    (7, "before it ITEM and after it"),
    (1 << 60 | 1, "large ids beside null ones keep all of their digits in each of the stages"),
]
ITEM = "seven wise owls look on from an old tree at night and say nothing of it to anyone else around"
CLASHING = "row", "key", "fp", "score", "root", "piece", "part", "item_ids", "covered", "predicted"


def test_pipeline_of_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in CLASHING)
    rows = [(i, t and t.replace("ITEM", ITEM), None, "s", None, *range(len(CLASHING))) for i, t in ODD]
    labels = [(i, 1, 0) for i in (1, 2, None)] + [(99, 0, 1)]
    for at, held in (("odd", rows), ("none", [])):
        folder = tmp_path / at
        spark.createDataFrame(held, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = load(spark, str(tmp_path / "odd"), "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, str(tmp_path / "odd"))
        assert made.columns == docs.columns, name
    ids = sorted((r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path / "odd")).where("piece = 0").collect()), key=lambda i: (i is None, i or 0))
    assert ids == [1, 2, 2, 3, 6, 1 << 60 | 1, None, None, None]
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
