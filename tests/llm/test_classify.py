"""More languages than have a full sample."""

from __future__ import annotations

import random

import numpy as np

from storeglass.llm import classify


def test_rare_languages_are_learned(spark, monkeypatch):
    monkeypatch.setattr(classify, "LANGUAGES", 2)
    rows = []
    for k, letters in enumerate(["abcde", "fghij", "klmno", "pqrst", "uvwxy"]):
        draw = random.Random(k)
        words = ["".join(draw.choice(letters) for _ in range(5)) for _ in range(40)]
        rows += [(1000 * k + i, " ".join(draw.choices(words, k=60)), f"l{k}") for i in range(90 - 10 * k)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    lang = {doc_id: name for doc_id, _, name in rows}
    held = [r for r in classify.language(docs, per_class=50).collect() if r["held_out"]]
    for name in sorted(set(lang.values())):
        assert np.mean([r["lang_pred"] == name for r in held if lang[r["doc_id"]] == name]) > 0.9, name
    labelled = docs.select("doc_id", docs["lang"].alias("label"))
    taken = classify.sample(docs, labelled, ["l0", "l1"], 20, others=True)
    assert {name: sum(label == name for _, label in taken) for name in set(lang.values())} == dict.fromkeys(set(lang.values()), 20)
