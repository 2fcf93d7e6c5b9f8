"""The pipeline's stages on odd rows."""

from __future__ import annotations

import corpus_pipeline
from storeglass.llm.common import stored
from tests.conftest import ROOT
from tests.llm.test_operators import prose

SCHEMA = "doc_id long, text string, lang string, source string, kept string, n_words string, component_id string, start string"


def row(doc_id, text, lang="en", source="a"):
    return doc_id, text, lang, source, "kept", "words", None, "start"


def through(spark, docs, folder):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, folder), "odd")
        assert after.columns == docs.columns and after.dtypes == docs.dtypes, name
        docs = after
        yield {(r["doc_id"], r["text"]) for r in after.collect()}, after


def test_odd_rows_go_through_every_stage(spark):
    first, second, third = prose(1, 60), prose(2, 60), prose(3, 60)
    long = prose(5, 40_000)
    rows = [row(1, first), row(1, first), row(2, first), row(3, None), row(4, ""), row(5, " \n\t "), row(6, "too short"),
            row(7, second, None, None), row(7, third, None), row(8, long), row(None, prose(4, 60))]
    stages = list(through(spark, spark.createDataFrame(rows, SCHEMA), ROOT))
    quality, near, cut, clean = (kept for kept, _ in stages)
    # Quality: no text, empty and short texts fail the base rule; a null id, lang or source doesn't.
    assert quality == {(1, first), (2, first), (7, second), (7, third), (8, long), (None, prose(4, 60))}
    # Near duplicates: the copy under a larger id goes, different texts under one id stay.
    assert near == quality - {(2, first)}
    assert {doc for doc, _ in clean} == {doc for doc, _ in near} and {text for _, text in cut} >= {second, third, long}
    pieces = corpus_pipeline.STAGES[-1][1](spark, stages[-1][1], ROOT).collect()
    assert {r["doc_id"] for r in pieces} == {1, 7, 8, None}
    assert all(r["length"] > 0 for r in pieces)


def test_empty_tables(spark, tmp_path):
    spark.read.parquet(f"{ROOT}/benchmark.parquet").limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    none = spark.createDataFrame([], SCHEMA)
    none.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
