"""The lasting search index against searches that count words anew."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from storeglass.plans.search import search_products
from storeglass.plans.search_index import SearchIndex

DOCS = "product_id long, name string, description string, tags array<string>, category string, brand string, price double"


def made(n: int, seed: int = 1):
    draw = random.Random(seed)
    words = [f"w{int(draw.paretovariate(0.8)) % 200}" for _ in range(400)]
    text = lambda low, high: " ".join(draw.choices(words, k=draw.randrange(low, high)))
    rows = [(k, text(0, 5), text(0, 40), [text(1, 2) for _ in range(draw.randrange(3))], draw.choice("ab"), draw.choice("xyz"),
             float(draw.randrange(100))) for k in range(n)]
    rows[3] = (3, None, None, None, None, None, None)
    return rows


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    """An index that came about in three updates, the last of which replaces products."""
    rows = made(600)
    index = SearchIndex(spark, str(tmp_path_factory.mktemp("index")), block=16, shard_blocks=8, buckets=8)
    stale = [(r[0], "w1 w1 w1", "stale words only", ["stale"], "a", "x", 1.0) for r in rows[::5]]
    for part in (rows[:300], stale, rows[300:] + rows[:300:5] + rows[300::5]):
        index.update(spark.createDataFrame(part, DOCS))
    return index, spark.createDataFrame(rows, DOCS)


def shown(df):
    return [(r["product_id"], r["relevance_score"], r["total_count"]) for r in df.collect()]


@pytest.mark.parametrize("options", [
    {"q": "w1"}, {"q": "w2 w7 w11"}, {"q": "W1 w1, w3"}, {"q": "w1 w2", "page": 3, "size": 7}, {"q": "absent w5"}, {"q": "absent"},
    {"q": "w1 w3", "category": "a", "min_price": 20.0, "max_price": 70.0}, {"q": "w4", "brand": "z", "page": 2, "size": 5},
    {"q": "w1", "category": "none"}, {"q": "..."}, {"q": "", "brand": "x"}, {"q": ""}, {"q": "stale"}, {"q": "w1", "page": 500},
])
def test_same_as_a_scan(index, options):
    index, docs = index
    assert shown(index.search(**options)) == shown(search_products(docs, **options))


def files_read(df) -> int:
    """Files that the scans of an executed plan read."""
    df.collect()
    leaves, n = df._jdf.queryExecution().executedPlan().collectLeaves(), 0
    for k in range(leaves.size()):
        metric = leaves.apply(k).metrics().get("numFiles")
        n += metric.get().value() if metric.isDefined() else 0
    return n


def test_reads_its_terms_files_only(index):
    index, _ = index
    versions = index.versions()
    everything = files_read(index._read("postings", versions))
    one = files_read(index.postings(["w7"], versions))
    assert 0 < one <= everything / 4  # one bucket of eight


def test_blocks_that_cannot_win_are_not_scored(spark, tmp_path):
    index = SearchIndex(spark, str(tmp_path / "i"), block=16, shard_blocks=8, buckets=4)
    rows = [(k, "plain", "gold " * (9 if k in (37, 38) else 1) + "dust " * 20, [], "a", "x", 1.0) for k in range(320)]
    index.update(spark.createDataFrame(rows, DOCS))
    found = shown(index.search("gold", size=2))
    assert [f[0] for f in found] == [37, 38] and found[0][2] == 320
    assert index.scored_blocks.count() == 1  # of twenty


def test_an_update_that_fails_is_not_seen(index, spark, monkeypatch):
    index, docs = index
    before, versions = shown(index.search("w1 w9")), index.versions()
    for table in ("postings", "figures"):
        with monkeypatch.context() as m:
            m.setattr(index.tables[table], "_commit", lambda manifest: (_ for _ in ()).throw(OSError("killed")))
            with pytest.raises(OSError):
                index.update(spark.createDataFrame([(5, "w1 w9 w1 w9", "w1", ["w9"], "a", "x", 1.0)], DOCS))
        assert index.versions() == versions and shown(index.search("w1 w9")) == before
    # An update of another shard does not bring in what the failed one left.
    index.update(docs.filter(F.col("product_id") == 599))
    assert shown(index.search("w1 w9")) == before
    index.vacuum(keep=1)
    assert shown(index.search("w1 w9")) == before


def test_one_shard_is_written_for_one_product(index, spark):
    index, docs = index
    before = index.tables["postings"].manifest(index.versions()["postings"])["entries"]
    index.update(docs.filter(F.col("product_id") == 130))
    after = index.tables["postings"].manifest(index.versions()["postings"])["entries"]
    assert {e["values"][0] for k, e in after.items() if e != before.get(k)} == {"1"}


def test_empty_index(spark, tmp_path):
    index = SearchIndex(spark, str(tmp_path / "i"))
    index.update(spark.createDataFrame([], DOCS))
    assert index.versions() is None
    index.update(spark.createDataFrame([(1, None, "", [], None, None, None)], DOCS))
    assert shown(index.search("word")) == [] and shown(index.search("")) == [(1, 1.0, 1)]


def test_words_are_counted_and_listed_where_their_block_is(spark):
    """Texts are brought together by block; no shuffle carries single words."""
    from storeglass.plans.search_index import postings_of

    docs = spark.createDataFrame(made(50), DOCS).selectExpr("*", "product_id div 16 AS block", "product_id div 128 AS shard")
    plan = postings_of(docs, 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "REPARTITION_BY_COL" in plan


def test_files_of_a_shard_do_not_grow_with_tasks(spark, tmp_path):
    """One file for each block at most, whatever the number of tasks that bring products."""
    index = SearchIndex(spark, str(tmp_path), block=64, shard_blocks=2, buckets=2)
    for _ in range(2):
        index.update(spark.createDataFrame(made(512), DOCS).repartition(12))
    files = index._read("docs", index.versions()).inputFiles()
    assert len(files) <= 8
