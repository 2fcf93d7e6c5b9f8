"""Spelling variants against plain loops."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from storeglass.llm import variants


def plain_words(rows, every=97):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{doc_id}:{word}".encode())
            if doc_id is not None and h % every == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            n[word] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(rows, every=97):
    words = plain_words(rows, every)
    form, out = {}, {}
    for w, n in words.items():
        close = [x for x in words if near(w, x)]
        best = min(close, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
        out[w] = len(close)
    rows = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n, out[w], words.get(form[w])))
    return sorted(rows)


def found(spark, rows, **options):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, word string, n int").repartition(3)
    return sorted(tuple(r) for r in variants.group_variants(docs, **options).collect())


def made(seed: int, letters: str, n_words: int, n_docs: int):
    draw = random.Random(seed)
    words = ["".join(draw.choices(letters, k=draw.choice([3, 4, 5, 5, 6, 6, 7, 8, 12]))) for _ in range(n_words)]
    words += [w[:k] + draw.choice(letters) + w[k + draw.randrange(2) :] for w in words for k in (draw.randrange(len(w) + 1),)]
    return [(k, " ".join(draw.choices(words, k=draw.randrange(120)))) for k in range(n_docs)]


ODD = [
    (1, None), (2, ""), (3, "!!! 123"), (None, "naïve naïve naïve naive naive naive naive naive naive"), (4, "NAÏVE ÀÉÎÕÜ×÷ " * 3),
    (5, "aaaaa aaaaaa aaaaaaa " * 4), (5, "aaaaa aaaaab " * 9), (6, "Hello hello HELLO hallo hallo hallo hell hello\nhello"),
    (7, "x" * 4000 + " " + "x" * 4001), (8, "x" * 4000 + " " + "x" * 4001), (9, "x" * 4000 + " " + "x" * 4001), (10, "hello_world's e-mail " * 5),
]


@pytest.mark.parametrize("cap", [1, 3, 50_000])
def test_odd_rows(spark, cap):
    assert found(spark, ODD, cap=cap) == plain(ODD)


@pytest.mark.parametrize("letters,cap,every", [("ab", 20, 7), ("abcdéÿ", 50_000, 3), ("abcdefghijklmnop", 100, 97)])
def test_random_words(spark, letters, cap, every):
    rows = made(len(letters), letters, 120, 60)
    assert found(spark, rows, cap=cap, every=every) == plain(rows, every)


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert found(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_matches_are_ranks_of_both_indexes():
    """Matching in any order of directions gives the same intervals, and a whole word its own rank."""
    import numpy as np

    words = sorted({"banana", "bandana", "anna", "nab", "ban"})
    index = variants.Bidirectional(words)
    for number, word in enumerate(words):
        symbols = [0, *index.coded(np.array(list(word), "U1")), 0]
        for middle in range(len(symbols)):
            state = (np.zeros(1, np.int64), np.zeros(1, np.int64), np.array([index.length]))
            for right, part in ((True, symbols[middle:]), (False, symbols[:middle][::-1])):
                for symbol in part:
                    state = index.extended(*state, np.array([symbol]), right)
            assert [int(x[0]) for x in state] == [number + 1, sorted(w[::-1] for w in words).index(word[::-1]) + 1, 1]
