"""Averaged hashed subword embeddings with a linear softmax, trained in numpy: the models of operators 3 and 5.

A text is lower-cased and its white space made single spaces. Its features are the byte n-grams of MIN to MAX bytes
inside words, the space on either side counted in; each is hashed to a bucket with an embedding. The mean of the
embeddings goes through a linear softmax. Embeddings and softmax are trained together by minibatch gradient descent.
Words that were never seen share the n-grams, hence the vectors, of those they resemble.

`train` averages over a text, which suits what shows everywhere in it (its language). `train_words` averages over a word
and judges a text by its strongest words, which suits what shows in a few words of a long text (an insult).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

MIN, MAX = 3, 6
BITS = 20
#: Bytes looked at together, so that a text of any length needs bounded memory.
CHUNK = 1 << 20


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def grams(text: str | None, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, word) numbers of all n-grams of a text, in chunks. Words count from 0 in their order."""
    data = np.frombuffer(f" {normal(text)} ".encode(), np.uint8)
    before = 0
    for low in range(0, len(data), CHUNK):
        part = data[low : low + CHUNK + MAX - 1]
        spaces = np.cumsum(part == 32, dtype=np.int64) + before
        values = part.astype(np.uint32)
        hashed = values.copy()
        buckets, words = [], []
        for n in range(2, MAX + 1):
            if len(part) < n:
                break
            hashed = hashed[: len(part) - n + 1] * np.uint32(0x01000193) + values[n - 1 :]
            if n >= MIN:
                inside = (spaces[n - 2 : len(part) - 1] == spaces[: len(part) - n + 1])[:CHUNK]
                mixed = (hashed[:CHUNK][inside] ^ np.uint32(n)) * np.uint32(0x9E3779B1)
                mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA6B)
                buckets.append((mixed >> np.uint32(32 - bits)).astype(np.int32))
                words.append(spaces[: len(inside)][inside] - 1)
        before = int(spaces[min(CHUNK, len(part)) - 1])
        if buckets:
            yield np.concatenate(buckets), np.concatenate(words)


def bag(text: str | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares."""
    parts = [buckets for buckets, _ in grams(text, bits)]
    buckets, n = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.int32), return_counts=True)
    return buckets, (n / max(n.sum(), 1)).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """`table` has the embedding of each bucket, `weights` and `bias` the softmax over their mean. The table's size is
    fixed by BITS and the width of the embeddings; only the softmax has a column for each class."""

    classes: tuple
    table: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    scale: float
    bits: int

    def logits(self, text: str | None) -> np.ndarray:
        total, n = np.zeros(self.table.shape[1]), 0
        for buckets, _ in grams(text, self.bits):
            total += self.table[buckets].sum(axis=0, dtype=np.float64)
            n += len(buckets)
        return self.scale * (total / max(n, 1) @ self.weights + self.bias)

    def probabilities(self, text: str | None) -> np.ndarray:
        z = self.logits(text)
        e = np.exp(z - z.max())
        return e / e.sum()


def train(
    texts: Sequence[str], labels: Sequence, epochs: int = 6, width: int = 8, rate: float = 0.3, batch: int = 32,
    bits: int = BITS, seed: int = 7, drop: float = 0.4, hold: int = 5, least: int = 4,
) -> Model:
    """Fits the model; every `hold`-th text only sets the scale of the logits (calibration), the others the weights.

    `drop` is the share of buckets left out at random each time a text is seen, so that no single one decides. Buckets
    found in fewer than `least` texts have no say: they would only tell the texts of the sample apart. Every label
    weighs the same as a whole.
    """
    random = np.random.default_rng(seed)
    classes = tuple(sorted(set(labels)))
    y = np.array([classes.index(label) for label in labels])
    bags = [bag(text, bits) for text in texts]
    fit = [k for k in range(len(bags)) if k % hold or len(bags) < 10 * hold]
    found = np.zeros(1 << bits, np.int32)
    for k in fit:
        found[bags[k][0]] += 1
    telling = found >= (least if len(fit) >= 10 * least else 1)
    bags = [(b[telling[b]], share[telling[b]]) for b, share in bags]
    weigh = len(fit) / len(classes) / np.maximum(np.bincount(y[fit], minlength=len(classes)), 1)
    table = np.zeros((1 << bits, width), np.float32)
    weights = random.normal(size=(width, len(classes))).astype(np.float32)
    bias = np.zeros(len(classes), np.float32)
    seen_table, seen_weights, seen_bias = np.zeros(1 << bits, np.float32), 1e-8, 1e-8
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = random.permutation(fit)
        for low in range(0, len(order), batch):
            chosen = order[low : low + batch]
            kept = [random.random(len(bags[k][0])) >= drop for k in chosen]
            sizes = np.array([m.sum() for m in kept])
            share = np.concatenate([bags[k][1][m] for k, m in zip(chosen, kept, strict=True)]) / np.float32(1 - drop)
            buckets, place = np.unique(
                np.concatenate([bags[k][0][m] for k, m in zip(chosen, kept, strict=True)]), return_inverse=True)
            doc = np.repeat(np.arange(len(chosen)), sizes)
            rows = table[buckets]
            means = np.stack([np.bincount(doc, rows[place, j] * share, len(chosen)) for j in range(width)], axis=1)
            z = means @ weights + bias
            e = np.exp(z - z.max(axis=1, keepdims=True))
            error = e / e.sum(axis=1, keepdims=True)
            error[np.arange(len(chosen)), y[chosen]] -= 1
            error *= (weigh[y[chosen]] / len(chosen))[:, None]
            sums = np.stack([np.bincount(place, share * error[doc, c], len(buckets)) for c in range(len(classes))], axis=1)
            slope = sums @ weights.T
            seen_table[buckets] += (slope**2).mean(axis=1)
            table[buckets] = rows - (step * slope / np.sqrt(seen_table[buckets, None] + 1e-12)).astype(np.float32)
            slope = means.T @ error
            seen_weights += (slope**2).mean()
            weights -= (0.1 * step * slope / np.sqrt(seen_weights)).astype(np.float32)
            slope = error.sum(axis=0)
            seen_bias += (slope**2).mean()
            bias -= (0.1 * step * slope / np.sqrt(seen_bias)).astype(np.float32)
    model = Model(classes, table, weights, bias, 1.0, bits)
    checked = [k for k in range(len(bags)) if k not in set(fit)] or fit
    logits = np.array([model.logits(texts[k]) for k in checked])

    def loss(scale: float) -> float:
        z = scale * logits
        top = z.max(axis=1)
        return float((np.log(np.exp(z - top[:, None]).sum(axis=1)) + top - z[np.arange(len(checked)), y[checked]]).mean())

    scale = min((2.0 ** (k / 4) for k in range(-16, 17)), key=loss)
    return Model(classes, table, weights, bias, scale, bits)


@dataclass(frozen=True)
class WordModel:
    """`table` has each bucket's logit; a word's logit is their mean. A text's logit is linear in a few figures of its
    words' logits."""

    table: np.ndarray
    weights: np.ndarray
    bits: int

    def word_logits(self, text: str | None) -> np.ndarray:
        sums, counts = np.zeros(0), np.zeros(0)
        for buckets, words in grams(text, self.bits):
            grown = int(words.max(initial=-1)) + 1
            if grown > len(sums):
                sums, counts = (np.append(x, np.zeros(grown - len(x))) for x in (sums, counts))
            sums += np.bincount(words, self.table[buckets], len(sums))
            counts += np.bincount(words, minlength=len(sums))
        return sums / np.maximum(counts, 1)

    def figures(self, text: str | None) -> np.ndarray:
        """Mean of the one, two and four strongest words, shares of words beyond three levels, and a constant."""
        logits = self.word_logits(text)
        if not len(logits):
            return np.append(np.zeros(6), 1.0)
        top = np.sort(np.partition(logits, -4)[-4:] if len(logits) > 4 else logits)[::-1]
        shares = [np.sqrt((logits > level).mean()) * 10 for level in (1.5, 2.5, 3.5)]
        return np.array([top[0], top[:2].mean(), top.mean(), *shares, 1.0])

    def probability(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.figures(text) @ self.weights, -50, 50))))


def train_words(
    texts: Sequence[str], labels: Sequence[int], epochs: int = 8, width: int = 8, rate: float = 0.7, batch: int = 4096,
    bits: int = BITS, seed: int = 7, hold: int = 4, negatives: float = 3.0,
) -> WordModel:
    """Labels are 0 and 1 and belong to texts; each distinct word stands for the texts it occurs in.

    A word's target is its share of texts with label 1, both labels weighing the same; its own weight grows with the
    root of the number of texts. Every `hold`-th text is kept from this and fits the text's logit instead (logistic
    regression, `negatives` times as much weight on label 0 as on 1).
    """
    random = np.random.default_rng(seed)
    y = np.asarray(labels)
    few = len(texts) < 20 * hold
    fit = [k for k in range(len(texts)) if few or k % hold]
    held = fit if few else [k for k in range(len(texts)) if not k % hold]
    occurs: tuple[Counter, Counter] = (Counter(), Counter())
    for k in fit:
        occurs[y[k]].update(set(normal(texts[k]).split(" ")) - {""})
    words = sorted(occurs[0].keys() | occurs[1].keys())
    each = [0.5 / max(int((y[fit] == c).sum()), 1) for c in (0, 1)]
    share = [np.array([occurs[c][word] for word in words]) * each[c] for c in (0, 1)]
    target = share[1] / (share[0] + share[1])
    weight = np.sqrt((share[0] + share[1]) / min(each))
    parts = list(grams(" ".join(words), bits))
    buckets, owner = [], []
    for part, numbers in parts:
        buckets.append(part)
        owner.append(numbers)
    buckets = np.concatenate(buckets) if buckets else np.zeros(0, np.int32)
    owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
    order = np.argsort(owner, kind="stable")
    buckets, starts = buckets[order], np.searchsorted(owner[order], np.arange(len(words) + 1))
    table = np.zeros((1 << bits, width), np.float32)
    softmax = random.normal(size=width).astype(np.float32)  # the difference of the two classes' weights
    bias, seen = 0.0, np.full(1 << bits, 1e-8, np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        mixed = random.permutation(len(words))
        for low in range(0, len(mixed), batch):
            chosen = np.sort(mixed[low : low + batch])
            sizes = starts[chosen + 1] - starts[chosen]
            at = np.repeat(starts[chosen] - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(sizes.sum())
            word = np.repeat(np.arange(len(chosen)), sizes)
            part = (1 / np.maximum(sizes, 1))[word]
            rows, place = np.unique(buckets[at], return_inverse=True)
            mean = np.bincount(word, (table[rows] @ softmax)[place] * part, len(chosen))
            error = (1 / (1 + np.exp(-(mean + bias))) - target[chosen]) * weight[chosen] / batch
            pull = np.bincount(place, part * error[word], len(rows))
            turn = (table[rows] * pull[:, None]).sum(axis=0)
            slope = pull[:, None] * softmax
            seen[rows] += (slope**2).mean(axis=1)
            table[rows] -= (step * slope / np.sqrt(seen[rows])[:, None]).astype(np.float32)
            softmax -= (0.01 * step * turn / (np.abs(turn).max() + 1e-9)).astype(np.float32)
            bias -= 0.1 * step * float(error.sum())
    model = WordModel(table @ softmax, np.zeros(7), bits)
    figures = np.array([model.figures(texts[k]) for k in held])
    truth = y[held]
    balance = np.where(truth == 1, 1 / max((truth == 1).sum(), 1), negatives / max((truth == 0).sum(), 1)) * len(held) / 4
    weights = np.zeros(figures.shape[1])
    for _ in range(30):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(figures @ weights, -30, 30)))
        slope = figures.T @ (balance * (p - truth)) + 0.1 * weights
        bend = (figures * (balance * p * (1 - p))[:, None]).T @ figures + 0.1 * np.eye(len(weights))
        weights -= np.linalg.solve(bend, slope)
    return WordModel(model.table, weights, bits)
