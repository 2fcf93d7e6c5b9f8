"""Near duplicates where rows share a doc_id: no text is lost, whatever the ids."""

from __future__ import annotations

import random

import pytest

from storeglass.llm import neardup


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefghij", k=5)) for _ in range(n))


A, B, C = (prose(k, 80) for k in (1, 2, 3))


def plain(rows, words, least):
    """(doc_id, text) rows by loops: sizes, components by row, smallest ids."""
    def shingles(text):
        w = (text or "").lower().split()
        return {tuple(w[k : k + words]) for k in range(max(len(w) - words + 1, 1))} if w else set()

    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            same = rows[i] == rows[j]
            near = sets[i] and 100 * len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j])
            if rows[i][0] is not None and rows[j][0] is not None and (same or near):
                label = [label[j] if x == label[i] else x for x in label]
    low = {x: min((r[0] for r, y in zip(rows, label, strict=True) if y == x and r[0] is not None), default=None) for x in label}
    return [(r[0], len(s), low[x]) for r, s, x in zip(rows, sets, label, strict=True)], label


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1.0) for d, t in rows], "doc_id long, text string, component string, _place double").repartition(3)


CASES = [
    [(1, A), (2, B), (9, A), (9, B), (9, C)],
    [(9, A), (9, C), (3, B)],
    [(5, A), (5, A), (5, A), (4, None), (4, ""), (4, None), (None, A), (None, A), (7, B + " more"), (7, B), (6, B)],
    [(2, A), (2, A + " end"), (1, C), (3, C), (3, B)],
]


@pytest.mark.parametrize("rows", CASES)
def test_every_row_has_its_own_set_and_links(spark, rows):
    want, label = plain(rows, 5, 80)
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in neardup.groups(frame(spark, rows), 5, 80).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = [(r["doc_id"], r["text"]) for r in neardup.filter_documents(frame(spark, rows)).collect()]
    assert set(kept) <= set(rows)
    # One row of each component, the one of the smallest id; rows without an id stay.
    components = {x: [r for r, y in zip(rows, label, strict=True) if y == x] for x in label}
    want_ids = sorted((min(d for d, _ in members) if members[0][0] is not None else None for members in components.values()), key=repr)
    assert sorted((d for d, _ in kept), key=repr) == want_ids
    for members in components.values():
        assert len([k for k in kept if k in members]) >= 1


def test_columns_pass(spark):
    docs = frame(spark, CASES[0])
    assert neardup.filter_documents(docs).columns == docs.columns


def test_no_text_is_lost_at_random(spark):
    draw = random.Random(4)
    texts = [prose(100 + k, 60) for k in range(12)]
    rows = [(draw.randrange(15), draw.choice(texts) + draw.choice(["", "", " x"])) for _ in range(60)]
    want, _ = plain(rows, 5, 80)
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in neardup.groups(frame(spark, rows), 5, 80).collect()]
    assert sorted(got) == sorted(want)
    left = [r["text"] for r in neardup.filter_documents(frame(spark, rows)).collect()]
    # A text without its ending is 55 of 56 shingles alike: each of the twelve survives in one form.
    assert sorted(t.removesuffix(" x") for t in left) == sorted({t.removesuffix(" x") for _, t in rows})
