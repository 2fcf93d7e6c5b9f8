"""Toxicity (operator 3) and language (operator 5): sampling, training and scoring on Spark.

Both fit a model of `subwords` on a bounded sample of labelled rows, the `per_class` rows of each label whose hashed
ids come first (a documented parameter; repeatable, and spread over all sources), and score every whole text in Arrow
batches. The model is a table of embeddings (op5: 34 MB, op3: 4 MB, fixed by BITS) and a softmax of a few figures per
label; every task reads it as a broadcast variable. Nothing is shuffled to score.

Rules for odd rows: a null or empty text gets the model's score of no evidence (language: `und`, score 0); rows with a
null label or doc_id teach nothing, and a null doc_id is scored and counts as not held out; a doc_id with several
labels teaches each of them; with no labelled row at all, or one label only, every score is 0.5 (toxicity) or every
language is the only one known (`und` if none), with score 0; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from storeglass.llm import subwords
from storeglass.llm.common import texts

#: Rows per label that the models are fitted on.
TOXIC_PER_CLASS = 2500
LANGUAGE_PER_CLASS = 400
#: Languages that have LANGUAGE_PER_CLASS rows each; more of them share as many rows in all.
LANGUAGES = 100
UNKNOWN = "und"
#: Decision point of the toxicity score, and the least calibrated probability of an accepted language.
TOXIC_FROM = 0.7
ACCEPTED_FROM = 0.6


def remainder(doc_id: Column, by: int) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(by)), F.lit(-1))


def sample(docs: DataFrame, labelled: DataFrame, labels: list, per_class: int, others: bool = False) -> list[tuple[str, object]]:
    """(text, label) of the first `per_class` ids of each label by hash, in an order that mixes the labels.

    The ids are cut label by label within tasks (top rows of an order), without the texts. At most per_class ids a label
    are broadcast to fetch the texts, and these texts alone reach the driver. `others` adds the labels that are not
    listed; they are ranked together, so none of them may be frequent.
    """
    at = F.xxhash64("doc_id")
    tops = [labelled.filter(F.col("label") == k).distinct().orderBy(at, "doc_id").limit(per_class) for k in labels]
    if others:
        rank = F.row_number().over(Window.partitionBy("label").orderBy(at, "doc_id"))
        rare = labelled.filter(~F.col("label").isin(labels)).distinct().withColumn("rank", rank)
        tops.append(rare.filter(F.col("rank") <= per_class).drop("rank"))
    if not tops:
        return []
    chosen = F.broadcast(reduce(DataFrame.unionByName, tops))
    rows = texts(docs).filter("text IS NOT NULL").join(chosen, "doc_id").withColumn("at", at).toArrow().to_pylist()
    return [(r["text"], r["label"]) for r in sorted(rows, key=lambda r: (r["at"], r["doc_id"], str(r["label"]), r["text"]))]


def fit(rows: list[tuple[str, object]], train: Callable):
    """A model by `train`, or None if the rows have fewer than two labels."""
    if len({label for _, label in rows}) < 2:
        return None
    return train([text for text, _ in rows], [label for _, label in rows])


def scored(docs: DataFrame, model, answer: Callable, schema: str, types: list[pa.Field]) -> DataFrame:
    """doc_id and `answer(model, text)` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            answers = [answer(known, text.as_py()) for text in batch.column(1)]
            columns = [batch.column(0)] + [
                pa.array([a[k] for a in answers], field.type) for k, field in enumerate(types)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id"] + [field.name for field in types])

    return texts(docs).mapInArrow(run, "doc_id long, " + schema)


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = TOXIC_PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted. Rows with crc32(doc_id) mod 3 = 1 teach nothing."""
    teaching = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    teaching = teaching.filter((remainder(F.col("doc_id"), 3) != 1) & F.col("label").isin(0, 1))
    rows = sample(docs, teaching, [0, 1], per_class)
    model = fit(rows, subwords.train_words)
    if model is None:
        out = texts(docs).select("doc_id", F.lit(0.5).alias("score"))
    else:
        out = scored(
            docs, model, lambda known, text: (known.probability(text),), "score double", [pa.field("score", pa.float64())])
    return out.select(
        "doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def language(docs: DataFrame, per_class: int = LANGUAGE_PER_CLASS, accepted_from: float = ACCEPTED_FROM) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted. Rows with crc32(doc_id) mod 5 = 0 teach nothing.

    `score` is the calibrated probability of the predicted language; `accepted` is false where it is below
    `accepted_from`, so that a caller can treat the text as of no known language.
    """
    labelled = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("label")
    ).filter((remainder(F.col("doc_id"), 5) != 0) & F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    counts = labelled.groupBy("label").count().orderBy(F.desc("count"), "label").collect()
    common = sorted(row["label"] for row in counts[:LANGUAGES])
    share = max(min(per_class, per_class * LANGUAGES // max(len(counts), 1)), 1)
    rows = sample(docs, labelled, common, share, len(counts) > LANGUAGES)
    model = fit(rows, subwords.train)
    only = next(iter({label for _, label in rows}), UNKNOWN)

    def answer(known: subwords.Model, text: str | None) -> tuple[str, float]:
        if not any(map(str.isalpha, text or "")):
            return UNKNOWN, 0.0
        p = known.probabilities(text)
        best = int(p.argmax())
        return known.classes[best], float(p[best])

    if model is None:
        lettered = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
        out = texts(docs).select(
            "doc_id", F.when(lettered, F.lit(only)).otherwise(F.lit(UNKNOWN)).alias("lang_pred"), F.lit(0.0).alias("score"))
    else:
        out = scored(docs, model, answer, "lang_pred string, score double",
                     [pa.field("lang_pred", pa.string()), pa.field("score", pa.float64())])
    return out.select(
        "doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score",
        (F.col("score") >= accepted_from).alias("accepted"))
