"""Packed token matrices: best fit decreasing with a segment tree over capacities (operator 9).

Every task packs the pieces of its own documents, window by window: a window holds up to `window` ids, its pieces are
sorted by length and each goes to the fullest row that still has room. No shuffle is needed, and a window's last rows
are the only ones that stay open, so padding falls with the window. Documents longer than a row are cut every `size`
ids and lose nothing. A lost executor repeats its tasks and gets the same rows.

Rules for odd rows: a null or empty text is the single end id; null doc_ids are kept; repeated rows are packed once
each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from storeglass.llm.common import texts
from storeglass.llm.tokens import encoder, vocabulary

SIZE = 1024
WINDOW = 1 << 21
_SCHEMA = pa.schema([
    ("row_id", pa.int64()), ("n_ids", pa.int64()), ("input_ids", pa.binary()), ("ids_crc32", pa.int64()),
    ("cu_seqlens", pa.list_(pa.int32())), ("position_starts", pa.list_(pa.int64())), ("doc_ids", pa.list_(pa.int64())),
])
#: input_ids: little-endian unsigned 16-bit ids, padded with `pad_id` to `size`. cu_seqlens: ends of the segments from
#: 0 on. Positions restart at each segment: position_starts has the position, within its document, of the first id.
SCHEMA = (
    "row_id long, n_ids long, input_ids binary, ids_crc32 long, cu_seqlens array<int>, position_starts array<long>, "
    "doc_ids array<long>"
)


class Capacities:
    """Open rows by free room, in a segment tree whose leaves count the rows of each room."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = room + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Removes and returns (room, row) with the smallest room >= least."""
        node = least + self.leaves
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        while node:
            self.count[node] -= 1
            node >>= 1
        return room, self.rows[room].pop()


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Rows of piece numbers: longest piece first, each into the fullest row with room for it."""
    open_rows, rows = Capacities(size), []
    for piece in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        found = open_rows.take(lengths[piece])
        room, row = found or (size, len(rows))
        if found is None:
            rows.append([])
        rows[row].append(piece)
        if room > lengths[piece]:
            open_rows.add(room - lengths[piece], row)
    return rows


def pack_matrices(
    docs: DataFrame, size: int = SIZE, vocab: str | None = None, end_id: int = 0, pad_id: int = 0, window: int = WINDOW
) -> DataFrame:
    """One row per packed row of ids. The vocabulary must have fewer than 65,536 ids."""
    vocab = vocab or vocabulary()

    def fill(pieces: list[tuple[int | None, int, np.ndarray]], first: int) -> pa.RecordBatch:
        out = {name: [] for name in _SCHEMA.names}
        for number, members in enumerate(best_fit([len(p[2]) for p in pieces], size)):
            chosen = [pieces[k] for k in members]
            ends = np.cumsum([0] + [len(ids) for _, _, ids in chosen])
            row = np.full(size, pad_id, "<u2")
            row[: ends[-1]] = np.concatenate([ids for _, _, ids in chosen])
            values = (first + number, int(ends[-1]), row.tobytes(), zlib.crc32(row.tobytes()), ends.tolist(),
                      [start for _, start, _ in chosen], [doc for doc, _, _ in chosen])
            for name, value in zip(out, values, strict=True):
                out[name].append(value)
        return pa.RecordBatch.from_pydict(out, schema=_SCHEMA)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocab)
        number = TaskContext.get().partitionId() << 40
        pieces, held = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py()), end_id).astype("<u2")
                pieces += [(doc_id, start, ids[start : start + size]) for start in range(0, len(ids), size)]
                held += len(ids)
                if held >= window:
                    filled = fill(pieces, number)
                    number, pieces, held = number + len(filled), [], 0
                    yield filled
        if pieces:
            yield fill(pieces, number)

    return texts(docs).mapInArrow(pack, SCHEMA)


def position_ids(cu_seqlens: list[int], size: int = SIZE) -> np.ndarray:
    """Positions of one row that restart at 0 with each segment, the padding counted as one more segment."""
    edges = np.append(np.asarray(cu_seqlens), size)
    starts = np.repeat(edges[:-1], np.diff(edges))
    return np.arange(size) - starts
