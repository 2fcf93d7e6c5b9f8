"""Quality by attention-based multiple-instance learning (operator 12): a text is a bag of passages, and only bags have labels.

Every passage (WORDS consecutive words) is encoded: figures of its bytes and words, and its byte pairs hashed to
2^BITS shares, go through one layer. A gate weighs each passage against the others of its text (softmax over the text
of w * (tanh(V h) * sigmoid(U h))), and the weighted sum of the encodings gives the text's logit. Encoder, gate and
output are learned together in numpy, by gradient steps through the whole chain, from the labels of documents alone.

The model is fitted on a bounded sample: the `per_class` labelled rows of each label whose hashed ids come first, of
these only texts of at most LONGEST bytes, and as many as make up BYTES_PER_CLASS. It is about 100 kB, whatever the
data. Scoring reads every passage of every text in Arrow batches, in portions of about CHUNK bytes; nothing is shuffled.

Rules for odd rows: a text without a word (null, empty, white space) has no passage and gets the score of an empty sum;
rows with a null label or doc_id teach nothing; a null doc_id is scored and counts as not held out; repeated rows are
scored once each, and a doc_id with both labels teaches both; with fewer than two labels every score is 0.5; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from storeglass.llm.classify import remainder
from storeglass.llm.common import texts, tidy

#: Bounds of the training sample.
PER_CLASS, LONGEST, BYTES_PER_CLASS = 1500, 1 << 18, 6 << 20
#: Decision point of the score.
KEPT_FROM = 0.3
WORDS = 48
BITS = 9
CHUNK = 1 << 20
_FIGURES = 11


def portions(data: bytes) -> list[bytes]:
    """A text in portions of at most CHUNK bytes, cut at white space if there is any; passages don't cross the cuts."""
    out = []
    while len(data) > CHUNK:
        cut = max(data.rfind(space, 0, CHUNK) for space in (b" ", b"\n", b"\t"))
        cut = cut if cut > 0 else CHUNK
        out.append(data[:cut].strip())
        data = data[cut:]
    return [*out, data.strip()]


def passages(parts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(rows of passages, number of the part that each belongs to) of stripped parts with a word each, all at once."""
    data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    starts = np.flatnonzero(~space & np.append(True, space[:-1]))
    if not len(starts):
        return np.zeros((0, _FIGURES + (1 << BITS)), np.float32), np.zeros(0, np.int64)
    ends = np.cumsum([len(part) + 1 for part in parts])
    owner = np.searchsorted(ends, starts, side="right")
    first = np.append(True, owner[1:] != owner[:-1])
    index = np.arange(len(starts)) - np.maximum.accumulate(np.where(first, np.arange(len(starts)), 0))
    opens = index % WORDS == 0
    passage = np.cumsum(opens) - 1  # of each word
    n = int(passage[-1]) + 1
    word = np.cumsum(np.bincount(starts, minlength=len(data))) - 1
    low = int(starts[0])
    word, data, space = word[low:], data[low:], space[low:]
    of = passage[word]
    count = lambda chosen: np.bincount(of[chosen], minlength=n)
    size, words = np.bincount(of, minlength=n), np.bincount(passage, minlength=n)
    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    digit, high = (data >= 48) & (data <= 57), data >= 128
    letters, marks = upper | lower | high, ~(upper | lower | high | digit | space)
    # Words as numbers: a sum over their bytes, each weighed by its place.
    place = np.arange(len(data)) - (starts[word] - low)
    weighed = np.where(space, 0, (data.astype(np.uint64) + 1) * _weights(place))
    key = np.add.reduceat(weighed, starts - low)
    same = np.append(False, key[1:] == key[:-1]) & ~opens
    order = np.lexsort((key, passage))
    fresh = np.append(True, (key[order][1:] != key[order][:-1]) | (passage[order][1:] != passage[order][:-1]))
    distinct = np.bincount(passage[order][fresh], minlength=n)
    after = np.append(data[1:], np.uint8(10))
    after[ends[ends > low] - 1 - low] = 10  # whatever part stands next
    alone = marks & np.append(True, space[:-1]) & np.append(space[1:], True)
    figures = np.stack([
        count(upper) / size, count(lower) / size, count(digit) / size, count(marks) / size, count(high) / size,
        count(data == 10) / words, words / WORDS, count(letters) / words / 10, np.bincount(passage[same], minlength=n) / words,
        distinct / words, count(alone) / words], axis=1)
    pair = ((data.astype(np.uint32) << np.uint32(8) | after) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    shares = np.bincount((of << BITS) + pair, minlength=n << BITS).reshape(n, -1) / size[:, None]
    return np.concatenate([figures, 4 * np.sqrt(shares)], axis=1, dtype=np.float32), owner[opens]


def _weights(place: np.ndarray) -> np.ndarray:
    """Odd 64-bit weights of places in a word."""
    mixed = (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) | np.uint64(1)


def sums(rows: np.ndarray, bag: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows per bag; `bag` ascends."""
    edges = np.searchsorted(bag, np.arange(n + 1))
    total = np.concatenate([np.zeros((1, *rows.shape[1:])), np.cumsum(rows, axis=0, dtype=np.float64)])
    return total[edges[1:]] - total[edges[:-1]]


@dataclass(frozen=True)
class Model:
    """encoder (with offset), gate (v, u, w), output (with offset) and the scale of its logit."""

    encoder: np.ndarray
    offset: np.ndarray
    v: np.ndarray
    u: np.ndarray
    w: np.ndarray
    output: np.ndarray
    bias: np.ndarray
    scale: float = 1.0

    def encoded(self, rows: np.ndarray) -> np.ndarray:
        return np.tanh(rows @ self.encoder + self.offset)

    def attention(self, h: np.ndarray, bag: np.ndarray, n: int) -> np.ndarray:
        """Weights of the passages, which add up to 1 in each bag. The gate is bounded, so no exponent overflows."""
        e = np.exp((np.tanh(h @ self.v) / (1 + np.exp(-h @ self.u))) @ self.w)
        return e / sums(e, bag, n)[bag]

    def logits(self, h: np.ndarray, bag: np.ndarray, n: int) -> np.ndarray:
        z = sums(self.attention(h, bag, n)[:, None] * h, bag, n)
        return self.scale * (z @ self.output + self.bias)


def bags(items: Sequence[str | None], model: Model | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(rows or encodings of passages, bag of each, number of bags) for consecutive texts, about CHUNK bytes together."""
    made, owners, held, parts, part_of, n = [], [], 0, [], [], 0

    def encode() -> None:
        rows, part = passages(parts)
        made.append(rows if model is None else model.encoded(rows))
        owners.append(np.array(part_of, np.int64)[part])
        parts.clear()
        part_of.clear()

    for text in items:
        for part in filter(None, portions((text or "").encode())):
            parts.append(part)
            part_of.append(n)
            held += len(part) + 64
            if held >= CHUNK:
                encode()
                held = 0
        n += 1
        if made and not parts:
            yield np.concatenate(made), np.concatenate(owners), n
            made, owners, n = [], [], 0
    if n:
        encode()
        yield np.concatenate(made), np.concatenate(owners), n


def train(
    items: Sequence[str], labels: Sequence[int], width: int = 24, gate: int = 12, epochs: int = 14, steps: int = 600,
    batch: int = 48, rate: float = 0.004, decay: float = 1e-4, drop: float = 0.2, hold: int = 5, seed: int = 7,
) -> Model:
    """Adam over all parameters, for `epochs` rounds and at least `steps` steps. Both labels weigh the same. `drop` is
    the share of inputs left out at random in a step.
    Every `hold`-th text is kept from this and sets the scale of the logits (calibration)."""
    random = np.random.default_rng(seed)
    y = np.asarray(labels, np.float64)
    rows, owner, n = [], [], 0
    for part, bag, more in bags(items):
        rows.append(part)
        owner.append(bag + n)
        n += more
    rows, owner = np.concatenate(rows), np.concatenate(owner)
    edges = np.searchsorted(owner, np.arange(n + 1))
    few = n < 20 * hold
    fit = np.array([k for k in range(n) if few or k % hold])
    inputs = rows.shape[1]
    names = ["encoder", "offset", "v", "u", "w", "output", "bias"]
    p = [random.normal(size=(inputs, width)) / np.sqrt(inputs), np.zeros(width), random.normal(size=(width, gate)) / np.sqrt(width),
         random.normal(size=(width, gate)) / np.sqrt(width), random.normal(size=gate) / np.sqrt(gate),
         random.normal(size=width) / np.sqrt(width), np.zeros(1)]
    p = [x.astype(np.float32) for x in p]
    mean, square, step = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p], 0
    epochs = max(epochs, -(-steps * batch // max(len(fit), 1)))
    weigh = {c: len(fit) / 2 / max((y[fit] == c).sum(), 1) for c in (0, 1)}
    for epoch in range(epochs):
        order = random.permutation(fit)
        for low in range(0, len(order), batch):
            chosen = np.sort(order[low : low + batch])
            at = np.concatenate([np.arange(edges[k], edges[k + 1]) for k in chosen])
            bag = np.repeat(np.arange(len(chosen)), edges[chosen + 1] - edges[chosen])
            x = rows[at] * ((random.random(inputs) >= drop) / (1 - drop)).astype(np.float32)
            model = Model(*p)
            h = model.encoded(x)
            t, s = np.tanh(h @ model.v), 1 / (1 + np.exp(-h @ model.u))
            a = model.attention(h, bag, len(chosen))[:, None]
            z = sums(a * h, bag, len(chosen))
            out = 1 / (1 + np.exp(-np.clip(z @ model.output + model.bias, -30, 30)))
            truth = y[chosen]
            error = (out - truth) * np.where(truth == 1, weigh[1], weigh[0]) / len(chosen)
            pull = (error[:, None] * model.output)[bag]
            along = (h * pull).sum(axis=1, keepdims=True)
            e = a * (along - sums(a * along, bag, len(chosen))[bag])
            g = e * model.w
            dt, ds = g * s * (1 - t**2), g * t * s * (1 - s)
            dh = (a * pull + dt @ model.v.T + ds @ model.u.T) * (1 - h**2)
            slopes = [x.T @ dh, dh.sum(axis=0), h.T @ dt, h.T @ ds, ((t * s) * e).sum(axis=0), z.T @ error, error.sum(keepdims=True)]
            step += 1
            speed = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, slope in enumerate(slopes):
                slope = slope.astype(np.float32) + decay * p[k]
                mean[k] += 0.1 * (slope - mean[k])
                square[k] += 0.001 * (slope**2 - square[k])
                p[k] = p[k] - (speed * mean[k] / (np.sqrt(square[k]) + 1e-8)).astype(np.float32)
    model = Model(**dict(zip(names, p, strict=True)))
    held = fit if few else np.arange(0, n, hold)
    z = model.logits(model.encoded(rows), owner, n)[held]
    sign = np.where(y[held] == 1, 1, -1)
    loss = lambda scale: np.logaddexp(0, -sign * scale * z).mean()
    scale = min((2.0 ** (k / 4) for k in range(-12, 9)), key=loss)
    return Model(**dict(zip(names, p, strict=True)), scale=scale)


def sample(docs: DataFrame, teaching: DataFrame, per_class: int) -> list[tuple[str, int]]:
    """(text, label) of the bounded sample, in an order that mixes the labels. Ids are cut to the first ones within
    tasks, without the texts; the byte bound is a running sum over at most `per_class` rows a label."""
    at = F.xxhash64("doc_id")
    tops = [teaching.filter(F.col("label") == k).distinct().orderBy(at, "doc_id").limit(per_class) for k in (0, 1)]
    size = F.octet_length("text")
    rows = texts(docs).filter(F.col("text").isNotNull() & (size <= LONGEST)).join(
        F.broadcast(reduce(DataFrame.unionByName, tops)), "doc_id").withColumn("at", at)
    running = Window.partitionBy("label").orderBy("at", "doc_id", "text").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("bytes", F.sum(size).over(running)).filter(F.col("bytes") <= BYTES_PER_CLASS).toArrow().to_pylist()
    return [(r["text"], r["label"]) for r in sorted(rows, key=lambda r: (r["at"], r["doc_id"], r["label"], r["text"]))]


def quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages. Rows with crc32(doc_id) mod 5 = 0 teach nothing."""
    held_out = remainder(F.col("doc_id"), 5) == 0
    teaching = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    rows = sample(docs, teaching.filter(~held_out & F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)), per_class)
    known = train(*zip(*rows, strict=True)) if len({label for _, label in rows}) == 2 else None
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            low = 0
            for h, bag, n in bags((text.as_py() for text in batch.column(1)), model):
                score = np.full(n, 0.5) if model is None else 1 / (1 + np.exp(-np.clip(model.logits(h, bag, n), -50, 50)))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(low, n), pa.array(np.round(score, 6)), pa.array(np.bincount(bag, minlength=n))],
                    names=["doc_id", "score", "n_passages"])
                low += n

    return texts(docs).mapInArrow(tidy(run), "doc_id long, score double, n_passages long").select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= KEPT_FROM).cast("int").alias("predicted"), "n_passages")
