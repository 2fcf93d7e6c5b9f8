"""Benchmark decontamination by pigeonhole edit matching (operator 1).

Texts and test items are lower-cased and their white space made single spaces. An item of m characters may occur with k
= m // CHARS_PER_ERROR edits. It is cut into k + 1 pieces: an occurrence with at most k edits leaves one piece intact,
so looking up all pieces exactly (one Aho-Corasick pass over a text) finds every occurrence. Each hit says where the
item would lie; the text around it is verified with Myers' bit-parallel edit distance, overlapping places once.

Items travel to the tasks as broadcast blocks of at most BLOCK_CHARS characters; more blocks mean more passes over the
documents, not larger tasks. Documents are never shuffled.

Items shorter than SHORTEST are looked for exactly and as whole words: no letter or digit may stand next to them.

Odd rows: null and empty items are not searched for; items without an id are, and found under null; null and empty texts
contain nothing; an item given twice is found under each of its ids, a document row given twice gives its finding twice;
null doc_ids are kept; empty tables give an empty result; other columns are ignored by `find`, passed through by
`filter_documents`.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from storeglass.llm.common import texts

CHARS_PER_ERROR = 20
#: Characters from which an item may occur with edits and inside words.
SHORTEST = 20
BLOCK_CHARS = 8_000_000
_FOUND = "doc_id long, item_id long, distance long, max_distance long, n_places long"


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(length: int, errors: int) -> list[tuple[int, int]]:
    """Ends of errors + 1 pieces of nearly equal length."""
    cuts = [length * k // (errors + 1) for k in range(errors + 2)]
    return list(zip(cuts, cuts[1:]))


def best_distance(pattern_bits: dict[str, int], length: int, text: str) -> int:
    """Smallest edit distance between the pattern and any part of the text (Myers 1999, one word of any length)."""
    top, ones = 1 << (length - 1), (1 << length) - 1
    rises, falls, distance = ones, 0, length
    best = distance
    for char in text:
        match = pattern_bits.get(char, 0)
        vertical = match | falls
        horizontal = (((match & rises) + rises) ^ rises) | match
        up = falls | (~(horizontal | rises) & ones)
        down = rises & horizontal
        if up & top:
            distance += 1
        elif down & top:
            distance -= 1
        # The first row stays 0: an occurrence may begin anywhere.
        up, down = (up << 1) & ones, (down << 1) & ones
        rises, falls = down | (~(vertical | up) & ones), up & vertical
        best = min(best, distance)
    return best


class Items:
    """Test items ready to be searched for."""

    def __init__(self, items: list[tuple[int | None, str]], chars_per_error: int):
        import ahocorasick

        self.items, by_piece = [], defaultdict(list)
        for item_id, text in items:
            errors = len(text) // chars_per_error if len(text) >= SHORTEST else 0
            bits: dict[str, int] = defaultdict(int)
            for at, char in enumerate(text):
                bits[char] |= 1 << at
            for start, end in pieces(len(text), errors):
                by_piece[text[start:end]].append((len(self.items), start, end - start))
            self.items.append((item_id, len(text), errors, dict(bits)))
        self.lookup = ahocorasick.Automaton()
        for piece, places in by_piece.items():
            self.lookup.add_word(piece, places)
        self.lookup.make_automaton()

    def find(self, text: str | None) -> list[tuple[int | None, int, int, int]]:
        """(item_id, smallest distance, largest allowed one, number of separate places)."""
        whole, spans = normal(text), defaultdict(list)
        if not len(self.lookup):
            return []
        for end, places in self.lookup.iter(whole):
            for item, start, length in places:
                first = end + 1 - length - start
                if self.items[item][1] >= SHORTEST or not (
                        whole[max(first - 1, 0) : first].isalnum() or whole[end + 1 : end + 2].isalnum()):
                    spans[item].append(first)
        found = []
        for item, starts in sorted(spans.items()):
            item_id, length, errors, bits = self.items[item]
            distances, low, high = [], None, None
            for start in sorted(set(starts)) + [None]:
                if low is not None and (start is None or start - errors > high):
                    distances.append(best_distance(bits, length, whole[max(low, 0) : high]))
                    low = None
                if start is not None:
                    low = start - errors if low is None else low
                    high = start + length + errors
            good = [d for d in distances if d <= errors]
            if good:
                found.append((item_id, min(good), errors, len(good)))
        return found


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int | None, str]]]:
    """Normalised items in blocks of about `block_chars` characters; one block at a time is on the driver."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = rows.filter("text IS NOT NULL")
    chars = rows.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    count = -(-chars // block_chars) or 1
    for k in range(count):
        part = rows if count == 1 else rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)
        items = [(row["item_id"], normal(row["text"])) for row in part.collect()]
        yield sorted((x for x in items if x[1]), key=lambda x: (x[0] is None, x[0] or 0, x[1]))


@lru_cache(maxsize=2)
def _ready(block) -> Items:
    """Built once per Python worker and broadcast."""
    return Items(*block.value)


def find(docs: DataFrame, benchmark: DataFrame, chars_per_error: int = CHARS_PER_ERROR) -> DataFrame:
    """One row per document and item that it contains."""
    context, out = docs.sparkSession.sparkContext, None
    for block in blocks(benchmark):
        shared = context.broadcast((block, chars_per_error))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = _ready(shared)
            for batch in batches:
                rows = [(doc_id, *hit) for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)
                        for hit in items.find(text.as_py())]
                names = ("doc_id", "item_id", "distance", "max_distance", "n_places")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[k] for row in rows], pa.int64()) for k in range(5)], names=names)

        part = texts(docs).mapInArrow(search, _FOUND)
        out = part if out is None else out.unionByName(part)
    return out


def filter_documents(docs: DataFrame, benchmark: DataFrame, chars_per_error: int = CHARS_PER_ERROR) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    context, at = docs.sparkSession.sparkContext, docs.columns.index("text")
    for block in blocks(benchmark):
        shared = context.broadcast((block, chars_per_error))

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = _ready(shared)
            for batch in batches:
                yield batch.filter(pa.array([not items.find(text.as_py()) for text in batch.column(at)], pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
