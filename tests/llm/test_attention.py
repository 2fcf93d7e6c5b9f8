"""Quality by attention over passages: the forward pass against plain loops, slopes, odd rows, held-out rows."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest

from storeglass.llm import attention

TEXTS = [
    "One two three.", "", None, "  \n ", "word " * 200, "Große Übung | 12 & 7\nnext line $$$ a a b", "x" * 3000, "a\n\nb\t c  ",
    " ".join(f"w{k % 37}" for k in range(500)),
]


def plain_rows(text: str) -> list[np.ndarray]:
    """Passages of one text by loops over its words (for texts without leading or trailing space)."""
    data = text.encode() + b"\n"
    words, spaces = [], b" \t\n\r\x0b\x0c"
    for k, c in enumerate(data):
        if c not in spaces and (k == 0 or data[k - 1] in spaces):
            words.append(k)
    rows = []
    for low in range(0, len(words), attention.WORDS):
        part = words[low : low + attention.WORDS]
        end = words[low + attention.WORDS] if low + attention.WORDS < len(words) else len(data)
        body = data[part[0] : end]
        tokens = body.split()
        kinds = [
            "s" if c in spaces else "u" if 65 <= c <= 90 else "l" if 97 <= c <= 122 else "d" if 48 <= c <= 57 else "h" if c > 127 else "m"
            for c in body]
        lone = sum(len(t) == 1 and kinds_of == "m" for t, kinds_of in (
            (t, "m" if not (chr(t[0]).isalnum() and t[0] < 128) and t[0] < 128 else "-") for t in tokens))
        n, m = len(body), len(tokens)
        figures = [
            kinds.count("u") / n, kinds.count("l") / n, kinds.count("d") / n, kinds.count("m") / n, kinds.count("h") / n,
            body.count(b"\n") / m, m / attention.WORDS, sum(map(kinds.count, "ulh")) / m / 10,
            sum(a == b for a, b in zip(tokens, tokens[1:], strict=False)) / m, len(set(tokens)) / m, lone / m]
        pairs = np.zeros(1 << attention.BITS)
        for k in range(part[0], end):
            following = data[k + 1] if k + 1 < len(data) else 10
            pairs[((data[k] << 8 | following) * 0x9E3779B1 % 2**32) >> (32 - attention.BITS)] += 1
        rows.append(np.append(figures, 4 * np.sqrt(pairs / n)))
    return rows


def small_model(seed: int = 1) -> attention.Model:
    draw = np.random.default_rng(seed)
    inputs = len(plain_rows("a b")[0])
    shape = lambda *s: draw.normal(size=s).astype(np.float32) / 3
    return attention.Model(shape(inputs, 5), shape(5), shape(5, 4), shape(5, 4), 3 * shape(4), 3 * shape(5), shape(1), 1.7)


def plain_score(model: attention.Model, text: str | None) -> float:
    hs, weights = [], []
    for row in plain_rows((text or "").strip()):
        h = [math.tanh(sum(x * w for x, w in zip(row, column, strict=True)) + o)
             for column, o in zip(model.encoder.T, model.offset, strict=True)]
        gates = [math.tanh(np.dot(h, v)) / (1 + math.exp(-np.dot(h, u))) for v, u in zip(model.v.T, model.u.T, strict=True)]
        hs.append(h)
        weights.append(math.exp(np.dot(gates, model.w)))
    z = sum((np.array(h) * w / sum(weights) for h, w in zip(hs, weights, strict=True)), np.zeros(len(model.output)))
    return float(model.scale * (z @ model.output + model.bias[0]))


@pytest.mark.parametrize("chunk", [1 << 20, 900])
def test_forward_pass(monkeypatch, chunk):
    monkeypatch.setattr(attention, "CHUNK", chunk)
    texts = [t for t in TEXTS if t is None or len(t) < chunk]
    model, got = small_model(), []
    for h, bag, n in attention.bags(texts, model):
        got += model.logits(h, bag, n).tolist()
    assert np.allclose(got, [plain_score(model, t) for t in texts], atol=1e-4)


def test_texts_beyond_a_chunk_are_read_whole(monkeypatch):
    long = " ".join(f"w{k}" for k in range(3000))
    monkeypatch.setattr(attention, "CHUNK", 500)
    assert b" ".join(attention.portions(long.encode())) == long.encode()
    assert b"".join(attention.portions(b"y" * 1700)) == b"y" * 1700
    [(h, bag, n)] = list(attention.bags([long], small_model()))
    assert n == 1 and set(bag.tolist()) == {0} and len(h) >= 3000 // attention.WORDS


def test_weights_are_shares():
    model = small_model()
    rows, bag = attention.passages([b"a b c " * 100, b"only", b"d e " * 60])
    weights = model.attention(model.encoded(rows), bag, 3)
    assert np.allclose(np.bincount(bag, weights), 1) and (weights > 0).all()


def test_one_bad_passage_is_found():
    """Labels of whole texts teach which passages count: one of ten is junk in the texts with label 0."""
    draw = np.random.default_rng(3)
    words = ["".join(draw.choice(list("abcdefgh"), 5)) for _ in range(80)]
    texts, labels = [], []
    for k in range(400):
        passages = [list(draw.choice(words, attention.WORDS)) for _ in range(10)]
        if k % 2:
            passages[draw.integers(10)] = ["#" + w + "%%" for w in draw.choice(words, attention.WORDS)]
        texts.append(" ".join(w for p in passages for w in p))
        labels.append(1 - k % 2)
    model = attention.train(texts[:300], labels[:300])
    [(h, bag, n)] = list(attention.bags(texts[300:], model))
    right = (model.logits(h, bag, n) > 0) == (np.array(labels[300:]) == 1)
    assert right.mean() > 0.97
    weights = model.attention(h, bag, n)
    rows, _ = attention.passages([t.encode() for t in texts[300:]])
    junk = rows[:, 3] > 0.1
    assert junk.sum() == 50 and weights[junk].mean() > 2 * weights[~junk].mean()


def documents(spark, sf):
    return (spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet") for name in ("documents", "labels"))


def test_held_out_rows(spark):
    docs, labels = documents(spark, "sf0.01")
    rows = {r["doc_id"]: r for r in attention.quality(docs, labels).collect()}
    assert len(rows) == docs.count()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows.values())
    held = [(truth[k], r["predicted"]) for k, r in rows.items() if r["held_out"] and k in truth]
    assert np.mean([t == p for t, p in held]) > 0.93 and np.mean([p for t, p in held if t]) > 0.97


def test_odd_rows(spark):
    docs, labels = documents(spark, "sf0.001")
    odd = [(d, t, "x", 5.0, 3) for d, t in [(None, "no id"), (-1, None), (-2, ""), (-3, " \n "), (-3, "twice"), (-3, "twice"), (-4, "z " * 300_000)]]
    odd = spark.createDataFrame(odd, "doc_id long, text string, quality string, score double, held_out int")
    both = docs.unionByName(odd, allowMissingColumns=True)
    more = labels.unionByName(spark.createDataFrame(
        [(None, 1, 0), (-3, None, 0), (-3, 1, 1), (-3, 0, 1), (-4, 7, 0)], labels.schema))
    rows = attention.quality(both, more).collect()
    assert len(rows) == docs.count() + 7
    empty = [r["score"] for r in rows if r["n_passages"] == 0]
    assert len(empty) >= 3 and len(set(empty)) == 1
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [False]
    assert [r["n_passages"] for r in rows if r["doc_id"] == -4] == [300_000 // attention.WORDS]


def test_without_labels(spark):
    docs, labels = documents(spark, "sf0.001")
    assert {r["score"] for r in attention.quality(docs, labels.limit(0)).collect()} == {0.5}
    assert {r["score"] for r in attention.quality(docs, labels.filter("quality = 1")).collect()} == {0.5}
    assert attention.quality(docs.limit(0), labels).collect() == []
