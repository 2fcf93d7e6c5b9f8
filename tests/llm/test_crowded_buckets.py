"""Operator 8 with crowded fingerprint buckets: the same rows, and flags copied in proportion to the corpus."""

import pytest
from pyspark.sql import functions as F

from storeglass.llm import substrings
from tests.llm.test_operators import check_cut, prose


def with_boilerplate(n):
    """Texts of their own; two thirds share a passage, a few are whole copies."""
    shared = prose(3, 40)
    texts = {k: f"{prose(100 + k, 20 + k % 50)} {shared if k % 3 else ''} {prose(900 + k, 30)}" for k in range(n)}
    return texts | {n + k: texts[k] for k in range(5)}


@pytest.mark.parametrize("crowded", [20, 300])
def test_crowded_buckets_give_the_same_rows(spark, monkeypatch, crowded):
    monkeypatch.setattr(substrings, "CROWDED", crowded)
    monkeypatch.setattr(substrings, "PACK", 2_000)
    texts = with_boilerplate(60)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check_cut({r["doc_id"]: r for r in substrings.deduplicate(docs).collect()}, texts)


def test_flags_are_copied_in_proportion(spark, monkeypatch):
    texts = with_boilerplate(300)
    texts |= {1000 + k: f"{prose(100 + k, 20 + k % 50)} {prose(5000 + k, 30)}" for k in range(300)}
    heads = spark.createDataFrame([(k, 0, t.encode()) for k, t in texts.items()], "doc_id long, tag int, text binary")
    monkeypatch.setattr(substrings, "PER_TASK", 2_000)
    size = lambda rows: rows.agg(F.sum(F.length("prints"))).first()[0]
    for buckets in (32, 500, 5_000):
        flags = substrings.flagged(substrings.packed_prints(heads, buckets, False), buckets).cache()
        total = flags.agg(F.sum("n")).first()[0]
        assert total == sum(len(substrings.chosen(substrings.np.frombuffer(t.encode(), "u1"))[0]) for t in texts.values())
        monkeypatch.setattr(substrings, "CROWDED", -(-4 * total // buckets))
        dealt = substrings.dealt_flags(flags)
        assert dealt.count() - flags.count() <= buckets / 4
        assert size(flags) <= size(dealt) <= 2 * size(flags)
        # A fingerprint of two thirds of the documents makes its bucket crowded, if there are many buckets.
        assert buckets < 500 or dealt.groupBy("bucket").count().filter("count > 1").count() > 0
        flags.unpersist()
