"""Spelling variants by search schemes on bidirectional FM-indexes (operator 13).

The vocabulary (words of at least LETTERS code points that occur at least LEAST times) is searched for words that differ
by exactly one inserted, deleted or replaced code point. One error leaves a half of the word whole, so each word is
looked up twice: its first half is matched exactly and the rest extended to the right with one error, and its second
half is matched exactly and the rest extended to the left with one error. The index knows words by their delimiters:
a match runs from delimiter to delimiter.

Both words of such a pair share the exact half together with the side it is on. So the vocabulary is dealt by (side,
half): a word asks under its own two halves and is listed under the halves that words one code point shorter, as long
or longer may ask with (at most four). A shard is the listed words of some halves, at most about CAP of them, with one
index over all; the words that ask are streamed past it. A half with more listed words than CAP is dealt by hash over
several shards, each seeing the asking words in blocks of as many; this is a stated query set against all rows, in
blocks, for that half alone. Nothing but the list of such halves is broadcast: each has CAP rows or more, so their
number is checked as any broadcast is and a shuffled join takes its place beyond the bound.

Rules for odd rows: a null or empty text has no words; a null doc_id deletes nothing from its words (its crc32 is null);
repeated rows count once each; a run of any length is a word, only time and memory grow with it; equal counts are
settled by code-point order; an empty table, or no word that is frequent enough, gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from storeglass.llm.common import small_or_not, stored, texts, tidy

#: Least code points and least occurrences of a word; a word's form has at least TIMES as many occurrences.
LETTERS, LEAST, TIMES = 5, 3, 2
#: Every EVERY-th pair of document and run, by hash, has a code point deleted.
EVERY = 97
#: Listed words of a shard, about, and words looked up together in a task.
CAP, BATCH = 50_000, 20_000
#: Ranks between two stored rows of symbol counts.
STEP = 32
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, letters: int = LETTERS, least: int = LEAST, every: int = EVERY) -> DataFrame:
    """word, n. Runs are counted per word within tasks first; nothing of a text is shuffled but its words' counts."""
    run = F.col("run")
    plain = F.length(run) == F.octet_length(run)  # lower() is exact and fast for ASCII, and would touch more beyond
    runs = texts(docs).select("doc_id", F.explode(F.split("text", "[^A-Za-z\\u00C0-\\u00FF]+")).alias("run")).filter(run != "")
    runs = runs.select("doc_id", F.when(plain, F.lower(run)).otherwise(F.translate(run, _UPPER, _LOWER)).alias("run"))
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
    words = runs.select(F.when(h % every == 0, cut).otherwise(run).alias("word"))
    return words.filter(F.length("word") >= letters).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


class Bidirectional:
    """FM-indexes of distinct sorted words and of the same words reversed; symbol 0 is the delimiter.

    A match is three numbers: `low`, the first rank of the suffixes that begin with the matched string, `mirror`, the
    same for the reversed string among the reversed words, and `size`, their number. The text is read as a ring; its
    last delimiter, which the first follows, ranks 0, and a delimiter before a word ranks as that word does, from 1.
    """

    def __init__(self, words: list[str]):
        letters = [np.array(list(word), "U1") for word in words]
        self.alphabet = np.unique(np.concatenate(letters)) if words else np.zeros(0, "U1")
        codes = [self.coded(x) for x in letters]
        self.sigma, self.n_words = len(self.alphabet) + 1, len(words)
        self.length = sum(map(len, codes)) + len(codes) + 1
        self.starts, *self.forward = self._index(codes)
        _, *self.backward = self._index(sorted((code[::-1] for code in codes), key=np.ndarray.tolist))

    def coded(self, letters: np.ndarray) -> np.ndarray:
        """Symbols of letters; one that no word has becomes `sigma`, which matches nothing."""
        at = np.minimum(np.searchsorted(self.alphabet, letters), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == letters, at + 1, len(self.alphabet) + 1)

    def _index(self, codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First rank of each symbol; the symbols before the suffixes of `$w1$w2...$` in order, and, for every STEP-th
        rank, how many symbols below each one come before it. Suffixes are sorted by doubling the length looked at."""
        closes = np.cumsum([0] + [len(code) + 1 for code in codes])
        text = np.zeros(self.length, np.int64)
        for start, code in zip(closes[:-1], codes, strict=True):
            text[start + 1 : start + 1 + len(code)] = code
        rank = text + len(closes)
        rank[closes] = np.roll(np.arange(len(closes)), -1)
        base, width = self.length + self.sigma + len(closes), 1
        while True:
            ahead = np.zeros(self.length, np.int64)
            ahead[: max(self.length - width, 0)] = rank[width:]
            ahead[closes] = 0  # a delimiter is told apart by its rank
            key = rank * base + ahead
            suffixes = np.argsort(key, kind="stable")
            fresh = np.append(0, np.cumsum(np.diff(key[suffixes]) != 0))
            rank[suffixes] = fresh
            if fresh[-1] == self.length - 1:
                break
            width *= 2
        before = text[suffixes - 1]
        rows = -(-(self.length + 1) // STEP)
        padded = np.full(rows * STEP, self.sigma, np.uint8 if self.sigma < 255 else np.uint16)
        padded[: self.length] = before
        each = np.bincount(np.arange(self.length) // STEP * (self.sigma + 1) + before, minlength=rows * (self.sigma + 1))
        passed = np.zeros((rows + 1, self.sigma + 1), np.int64)
        np.cumsum(each.reshape(rows, -1), axis=0, out=passed[1:])
        below = np.zeros((rows, self.sigma + 2), np.int32)
        np.cumsum(passed[:-1], axis=1, out=below[:, 1:])
        return np.searchsorted(np.sort(text), np.arange(self.sigma + 1)), padded.reshape(rows, STEP), below

    def extended(self, low, mirror, size, symbol, right: bool):
        """Matches with one more symbol on the right or left; a size of 0 means that there are none."""
        (symbols, below), at = (self.backward, mirror) if right else (self.forward, low)
        known = symbol < self.sigma
        c = np.where(known, symbol, 0)
        lower, counts = [], []
        for place in (at, at + size):
            row, rest = place // STEP, (place % STEP)[:, None]
            near = symbols[row]
            inside = np.arange(STEP) < rest
            lower.append(below[row, c] + ((near < c[:, None]) & inside).sum(axis=1))
            counts.append(below[row, c + 1] - below[row, c] + ((near == c[:, None]) & inside).sum(axis=1))
        size = np.where(known, counts[1] - counts[0], 0)
        here, there = self.starts[c] + counts[0], (low if right else mirror) + lower[1] - lower[0]
        return (there, here, size) if right else (here, there, size)

    def children(self, low, mirror, size, right: bool):
        """All matches with one more symbol: (parent, symbol, low, mirror, size)."""
        (symbols, below), at = (self.backward, mirror) if right else (self.forward, low)
        counts = []
        for place in (at, at + size):
            row, rest = place // STEP, (place % STEP)[:, None]
            n = np.diff(below[row], axis=1).astype(np.int64)
            inside = np.nonzero(np.arange(STEP) < rest)
            np.add.at(n, (inside[0], symbols[row][inside]), 1)
            counts.append(n[:, : self.sigma])
        sizes = counts[1] - counts[0]
        parent, symbol = np.nonzero(sizes)
        here = self.starts[symbol] + counts[0][parent, symbol]
        there = (low if right else mirror)[parent] + (np.cumsum(sizes, axis=1) - sizes)[parent, symbol]
        return (parent, symbol, there, here, sizes[parent, symbol]) if right else (parent, symbol, here, there, sizes[parent, symbol])


def search(index: Bidirectional, asking: list[str], right: bool) -> tuple[np.ndarray, np.ndarray]:
    """(asking word, index word) numbers of words that differ by one code point beyond the exact half.

    To the right: delimiter and first half are matched exactly, then the second half and the closing delimiter with
    one error. To the left it is the mirror image. All words advance together, by one symbol of the index a round;
    `at` is how many symbols of the pattern are behind a match.
    """
    if not asking or not index.n_words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lengths = np.array([len(word) for word in asking])
    patterns = np.zeros((len(asking), lengths.max() + 3), np.int64)
    flat = index.coded(np.array(list("".join(asking)), "U1"))
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    owner = np.repeat(np.arange(len(asking)), lengths)
    patterns[owner, 1 + (place if right else lengths[owner] - 1 - place)] = flat
    whole, ends = 1 + (lengths // 2 if right else lengths - lengths // 2), lengths + 2
    q, at = np.arange(len(asking)), np.zeros(len(asking), np.int64)
    erred, low, mirror = np.zeros(len(asking), bool), np.zeros(len(asking), np.int64), np.zeros(len(asking), np.int64)
    size = np.full(len(asking), index.length)
    found = []
    while len(q):
        symbol, skipped = patterns[q, at], patterns[q, at + 1]
        free = np.flatnonzero(~erred & (at >= whole[q]))
        grown = [(q, at + 1, erred, *index.extended(low, mirror, size, symbol, right))]
        # The pattern's symbol is missing in the word of the index; in a run of equal ones, the last.
        less = free[(symbol[free] != 0) & (symbol[free] != skipped[free])]
        grown.append((q[less], at[less] + 2, np.ones(len(less), bool),
                      *index.extended(low[less], mirror[less], size[less], skipped[less], right)))
        parent, other, *state = index.children(low[free], mirror[free], size[free], right)
        parent = free[parent]
        odd = (other != 0) & (other != symbol[parent])
        for kept, step in ((odd, 0), (odd & (symbol[parent] != 0), 1)):  # one symbol more, or another one
            grown.append((q[parent[kept]], at[parent[kept]] + step, np.ones(kept.sum(), bool), *(x[kept] for x in state)))
        q, at, erred, low, mirror, size = (np.concatenate(x) for x in zip(*grown, strict=True))
        done = (at >= ends[q]) & (size > 0)
        found.append((q[done & erred], low[done & erred] - 1))
        on = (at < ends[q]) & (size > 0)
        q, at, erred, low, mirror, size = (x[on] for x in (q, at, erred, low, mirror, size))
    q, word = (np.concatenate(x) for x in zip(*found, strict=True))
    pairs = np.unique(q * index.n_words + word)
    return pairs // index.n_words, pairs % index.n_words


def dealt(words: DataFrame, letters: int, cap: int) -> DataFrame:
    """word, n, side (0: first half exact), asks, and the shard (bucket, part, turn) that a row belongs to."""
    length = F.length("word")
    asked_by = F.sequence(F.greatest(length - 1, F.lit(letters)), length + 1)
    first = F.array_distinct(F.transform(asked_by, lambda m: F.floor(m / 2).cast("int")))
    last = F.array_distinct(F.transform(asked_by, lambda m: m - F.floor(m / 2).cast("int")))
    head = lambda k: F.substr("word", F.lit(1), k)
    tail = lambda k: F.substr("word", length - k + 1, k)
    half = F.floor(length / 2).cast("int")
    entry = lambda side, asks, key: F.struct(
        F.lit(side).alias("side"), F.lit(asks).alias("asks"), key.alias("half"))
    entries = F.concat(
        F.transform(first, lambda k: entry(0, False, head(k))), F.transform(last, lambda k: entry(1, False, tail(k))),
        F.array(entry(0, True, head(half)), entry(1, True, tail(length - half))))
    rows = words.select("word", "n", F.explode(entries).alias("e")).select("word", "n", "e.*")
    sizes = stored(rows.filter(~F.col("asks")).groupBy("side", "half").agg(F.count("*").alias("listed")), "halves")
    buckets = -(-(sizes.agg(F.sum("listed")).first()[0] or 1) // cap)
    crowded = small_or_not(stored(
        sizes.filter(F.col("listed") > cap).select("side", "half", F.ceil(F.col("listed") / cap).cast("int").alias("parts")), "crowded"))
    rows = rows.join(crowded, ["side", "half"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    return rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "word", "n", "side", "asks", F.pmod(F.xxhash64("side", "half"), F.lit(buckets)).alias("bucket"),
        F.when(F.col("asks"), F.col("other")).otherwise(own).alias("part"),
        F.when(F.col("asks"), own).otherwise(F.col("other")).alias("turn"))


def near_words(words: DataFrame, letters: int = LETTERS, cap: int = CAP) -> DataFrame:
    """word, near, n_of_near: both directions of all pairs of words that differ by one code point; a pair may repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, listed, counts, index, asking = None, [], [], None, []

        def answers() -> pa.RecordBatch:
            q, found = search(index, asking, right=shard[0] == 0)
            return pa.RecordBatch.from_arrays([
                pa.array(np.array(asking, object)[q], pa.string()), pa.array(np.array(listed, object)[found], pa.string()),
                pa.array(np.array(counts, np.int64)[found])], names=["word", "near", "n_of_near"])

        for batch in batches:
            for *key, asks, word, n in zip(*(batch.column(c).to_pylist() for c in range(7)), strict=True):
                if key != shard:
                    if asking:
                        yield answers()
                    shard, listed, counts, index, asking = key, [], [], None, []
                if not asks:  # these come first, in order; a word with two halves in the bucket comes twice
                    if not listed or listed[-1] != word:
                        listed.append(word)
                        counts.append(n)
                    continue
                if index is None:
                    index = Bidirectional(listed)
                asking.append(word)
                if len(asking) >= BATCH:
                    yield answers()
                    asking = []
        if asking:
            yield answers()

    shard = ["side", "bucket", "part", "turn"]
    rows = dealt(words, letters, cap).select(*shard, "asks", "word", "n")
    return rows.repartition(*shard).sortWithinPartitions(*shard, "asks", "word").mapInArrow(
        tidy(run), "word string, near string, n_of_near long")


def roots(links: DataFrame) -> DataFrame:
    """word, root: links (word, at) followed to their ends, twice as far each round. A form has at least TIMES as many
    occurrences as its word, so chains are short and never closed."""
    while True:
        ahead = links.select(F.col("word").alias("at"), F.col("at").alias("root"))
        links = stored(links.join(ahead, "at").select(
            "word", F.col("root").alias("at"), (F.col("root") != F.col("at")).alias("moved")), "roots")
        if links.filter("moved").isEmpty():
            return links.select("word", F.col("at").alias("root"))


def group_variants(
    docs: DataFrame, letters: int = LETTERS, least: int = LEAST, every: int = EVERY, times: int = TIMES, cap: int = CAP
) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row per word of the vocabulary."""
    words = stored(vocabulary(docs, letters, least, every), "words")
    pairs = near_words(words, letters, cap).groupBy("word", "near").agg(F.max("n_of_near").alias("m"))
    best = pairs.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "near")).alias("best"))
    enough = -F.col("best.less") >= times * F.col("n")
    found = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")), "forms")
    ends = roots(found.select("word", F.coalesce("form", "word").alias("at")))
    return found.join(ends, "word").select("word", "form", "root", "n", "n_near", "form_n")
