"""Product search: BM25 per field, best field wins, filters and paging."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from storeglass.functions.exprs import all_of, count_if
from storeglass.operators.lookup import enrich_rows
from storeglass.operators.materialize import materialize

# Term saturation and length normalisation of BM25 (Robertson & Zaragoza 2009), boosts of the fields.
K1, B = 1.2, 0.75
FIELD_BOOSTS = {"name": 2.0, "description": 1.0, "tags": 1.0}
NOT_A_WORD = r"[^\p{L}\p{N}]+"


def tokens(column) -> Column:
    return F.filter(F.split(F.lower(column), NOT_A_WORD), lambda w: w != "")


def query_terms(q: str) -> list[str]:
    """Distinct lower-case words of the query (the query text is small; documents never come to the driver)."""
    return list(dict.fromkeys(w for w in re.split(r"[\W_]+", q.lower()) if w))


def search_products(
    docs: DataFrame, q: str = "", category: str | None = None, brand: str | None = None,
    min_price: float | None = None, max_price: float | None = None, page: int = 1, size: int = 20,
) -> DataFrame:
    """One page of products by relevance, with the number of all hits.

    Texts are split into words once: what is kept per product is only its field lengths and the counts of the query
    terms, written once. Document frequencies and scores come from that slim table; postings are never exploded or
    shuffled, and only the shown products are fetched again. Without a query every product matches with score 1.
    """
    wanted = all_of(
        None if not category else F.col("category") == F.lit(category),
        None if not brand else F.col("brand") == F.lit(brand),
        None if min_price is None else F.col("price") >= F.lit(min_price),
        None if max_price is None else F.col("price") <= F.lit(max_price),
    )
    columns, terms = docs.columns, query_terms(q)
    best_first = [F.desc("relevance_score"), F.asc("product_id")]
    if not q:
        found = docs.filter(wanted)
        hits = found.select(*columns, F.lit(1.0).alias("relevance_score"), found.agg(F.count("*")).scalar().alias("total_count"))
        return hits.orderBy(*best_first).offset((page - 1) * size).limit(size)
    if not terms:
        return docs.filter(F.lit(False)).select(
            *columns, F.lit(0.0).alias("relevance_score"), F.lit(0).cast("bigint").alias("total_count"))
    slim = materialize(_count_terms(docs.withColumn("_wanted", wanted), terms).select(
        "product_id", "_wanted", *(f"_{f}_{part}" for f in FIELD_BOOSTS for part in ("len", "tf"))))
    lengths = lambda f: F.when(F.col(f"_{f}_len") > 0, F.col(f"_{f}_len"))
    stats = slim.agg(F.struct(
        *(F.avg(lengths(f)).alias(f"{f}_len") for f in FIELD_BOOSTS),
        *(F.count(lengths(f)).alias(f"{f}_docs") for f in FIELD_BOOSTS),
        *(count_if(F.col(f"_{f}_tf")[i] > 0).alias(f"{f}_df{i}") for f in FIELD_BOOSTS for i in range(len(terms))),
        count_if(F.col("_wanted") & _any_term()).alias("hits"),
    ).alias("stats")).scalar()
    fields = [_field_score(f, len(terms)) * F.lit(boost) for f, boost in FIELD_BOOSTS.items()]
    shown = (
        slim.filter(F.col("_wanted") & _any_term()).withColumn("_stats", stats)
        .select("product_id", F.greatest(*fields).alias("relevance_score"), F.col("_stats.hits").alias("total_count"))
        .orderBy(*best_first).offset((page - 1) * size).limit(size)
    )
    return enrich_rows(shown, docs, "product_id", size).select(*columns, "relevance_score", "total_count").orderBy(*best_first)


def field_text(field: str) -> Column:
    return F.concat_ws(" ", field) if field == "tags" else F.coalesce(F.col(field), F.lit(""))


def _count_terms(docs: DataFrame, terms: list[str]) -> DataFrame:
    """Per field the number of words and how often each query term occurs.

    The counts are one array per field: an array built by a function is evaluated once per row, where a struct of
    separate counts would be taken apart and its word splitting repeated for every use.
    """
    split = docs.withColumns({f"_{f}_words": tokens(field_text(f)) for f in FIELD_BOOSTS})
    wanted = F.array(*map(F.lit, terms))
    counts = {f"_{f}_len": F.size(f"_{f}_words") for f in FIELD_BOOSTS} | {
        f"_{f}_tf": F.transform(wanted, _occurrences(f"_{f}_words")) for f in FIELD_BOOSTS}
    return split.withColumns(counts).drop(*(f"_{f}_words" for f in FIELD_BOOSTS))


def _occurrences(words: str):
    return lambda term: F.size(F.filter(words, lambda w: w == term))


def _any_term() -> Column:
    return reduce(Column.__or__, (F.exists(f"_{f}_tf", lambda n: n > 0) for f in FIELD_BOOSTS))


def _field_score(field: str, n_terms: int) -> Column:
    length = F.col(f"_{field}_len") / F.col(f"_stats.{field}_len")
    score = F.lit(0.0)
    for i in range(n_terms):
        tf, df = F.col(f"_{field}_tf")[i], F.col(f"_stats.{field}_df{i}")
        idf = F.log(1 + (F.col(f"_stats.{field}_docs") - df + 0.5) / (df + 0.5))
        score = score + F.when(tf > 0, idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length))).otherwise(F.lit(0.0))
    return score
