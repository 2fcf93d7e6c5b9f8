"""Packing by histogram: shortest pack first over the lengths, longest length first (operator 4).

Documents become token pieces in one pass over the texts. From then on only the histogram of piece lengths (at most
`size` rows) is seen by the driver: it is packed into patterns with counts, and every piece finds its place by its
rank among the pieces of its length. No text or id list is shuffled.

Rules for odd rows: a null or empty text is the single end id; a row with a null doc_id is packed like any other and
keeps the null; repeated rows are packed once each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from storeglass.llm.common import stored, texts
from storeglass.llm.tokens import encoder, vocabulary
from storeglass.operators.ranking import global_positions

SIZE = 1024
END_ID = 0
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_PLACED = _PIECES + ", sequence_id long, offset long"


def token_pieces(docs: DataFrame, size: int = SIZE, vocab: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most `size` ids, cut every `size` ids from the start of a document (`end_id` closes it)."""
    vocab = vocab or vocabulary()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocab)
        for batch in batches:
            out = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py()), end_id).astype("<u4")
                for start in range(0, len(ids), size):
                    piece = ids[start : start + size]
                    for key, value in zip(out, (doc_id, start, len(piece), zlib.crc32(piece), len(ids)), strict=True):
                        out[key].append(value)
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in out.items()})

    return texts(docs).mapInArrow(cut, _PIECES)


def shortest_pack_first(histogram: Mapping[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in their order) and how many packs follow each.

    Lengths are placed longest first; each goes to the open packs with the most room left, as many at a time as the
    pattern has packs. Every step uses up a length or a pattern, so the number of steps does not depend on the number
    of pieces.
    """
    room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length in sorted((k for k, n in histogram.items() if n), reverse=True):
        left = histogram[length]
        while left:
            most = max(room, default=-1)
            if most < length:
                pattern, packs, most = (), left, size
            else:
                pattern, packs = room[most].pop()
                if not room[most]:
                    del room[most]
            used = min(packs, left)
            if packs > used:
                room.setdefault(most, []).append((pattern, packs - used))
            room.setdefault(most - length, []).append(((*pattern, length), used))
            left -= used
    return sorted((x for same in room.values() for x in same), reverse=True)


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, packs, first sequence, offset), ordered by length: the places of all pieces in order of length."""
    rows, sequence = [], 0
    for pattern, packs in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, packs, sequence, offset))
            offset += length
        sequence += packs
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, start, length, ...), which should be a stored table.

    Pieces get their position in the order of (length, doc_id, start) by range partitions; the slots are laid out in
    the same order of length, so a position names exactly one slot.
    """
    histogram = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = slots(shortest_pack_first(histogram, size))
    ends = np.cumsum(places[:, 1])  # a few thousand patterns at most, whatever the number of pieces

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.asarray(batch.column("_at")) - 1
            slot = np.searchsorted(ends, at, side="right")
            rank = at - (ends[slot] - places[slot, 1])
            columns = batch.columns[:-1] + [pa.array(places[slot, 2] + rank), pa.array(places[slot, 3])]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1] + ["sequence_id", "offset"])

    order = [F.col("length").asc(), F.col("doc_id").asc_nulls_first(), F.col("start").asc()]
    return global_positions(pieces, order, "_at").mapInArrow(place, _PLACED)


def pack_documents(docs: DataFrame, size: int = SIZE, vocab: str | None = None) -> DataFrame:
    """One row per piece of every document with its place in a sequence."""
    return pack(stored(token_pieces(docs, size, vocab), "pieces"), size)
