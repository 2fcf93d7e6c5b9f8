"""The pipeline, stage by stage, against a plain version of each stage on the same input."""

from __future__ import annotations

import duckdb

import corpus_pipeline
from storeglass.llm import decontaminate, oracles
from storeglass.llm.common import stored
from tests.conftest import ROOT
from tests.llm import brute
from tests.llm.test_operators import check_pieces


def plain_stages(texts, benchmark):
    """Texts after each stage, by brute force."""
    base = duckdb.connect()
    base.execute(f"CREATE VIEW documents AS SELECT * FROM '{ROOT}/documents.parquet'")
    kept = base.execute(
        f"WITH {oracles.counts_sql()}, {oracles.verdict_sql()} SELECT doc_id FROM judged WHERE kept").fetchall()
    texts = {k: texts[k] for (k,) in kept}
    yield texts
    groups = brute.components(texts, 5, 80)
    texts = {k: t for k, t in texts.items() if groups[k] == k}
    yield texts
    cut = {}
    for k, (data, covered) in brute.cut(texts).items():
        left = bytes(b for b, c in zip(data, covered, strict=True) if not c)
        if left.strip() or not any(covered):
            cut[k] = left.decode("utf-8", "ignore")
    yield cut
    items = [decontaminate.normal(t) for t in benchmark]

    def contained(text):
        whole = decontaminate.normal(text)
        for item in items:
            errors = len(item) // decontaminate.CHARS_PER_ERROR
            if any(item[a:b] in whole for a, b in decontaminate.pieces(len(item), errors)):
                if brute.edit_distance_within(item, whole) <= errors:
                    return True
        return False

    yield {k: t for k, t in cut.items() if not contained(t)}


def test_stages(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    benchmark = [r["text"] for r in spark.read.parquet(f"{ROOT}/benchmark.parquet").collect()]
    for (name, stage), expected in zip(corpus_pipeline.STAGES, plain_stages(texts, benchmark)):
        after = stored(stage(spark, docs, ROOT), "stage")
        assert after.columns == docs.columns and after.dtypes == docs.dtypes, name
        assert {r["doc_id"]: r["text"] for r in after.collect()} == expected, name
        docs = after
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, ROOT).collect()
    check_pieces(rows, expected, 1024)
    whole = corpus_pipeline.run(spark, ROOT)
    columns = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(str, whole.select(columns).collect())) == sorted(str(r) for r in packed(spark, rows, columns))


def packed(spark, rows, columns):
    return spark.createDataFrame(rows).select(columns).collect()
