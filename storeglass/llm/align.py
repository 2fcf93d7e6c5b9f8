"""Cross-tokenizer alignment by interval coalescing (operator 11).

A text is encoded by two public vocabularies, A (byte-level) and B (pieces with byte fallback, which puts a space in
front), and every token becomes an interval of bytes. The intervals of a block of documents are sorted together by
their starts; the running maximum of their ends shows where a group breaks (a start that reaches it), and within the
groups every A token is linked with the B tokens whose intervals overlap its own.

How many documents hold a pair of ids linked is a statistic of the whole corpus. A task therefore cuts its documents
into blocks of about BLOCK tokens and writes each block once: a row of figures per document, the document's pairs as
numbers into the block's list of distinct pairs, and that list with its document counts. Only (block, pair, count) is
shuffled by pair, so a pair that occurs everywhere costs one row a block; the best count per A id is taken over its B
ids (at most as many as B has ids). The totals return to their blocks, where numpy adds them up per document. No step
holds more than a block or the pairs of one A id, and nothing is broadcast.

Rules for odd rows: a null or empty text, or one that either vocabulary doesn't give back byte by byte, has no tokens:
zeros and an empty groups_sha256. A row counts as a document, so repeated rows are counted and returned once each; a
null doc_id stays null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from storeglass.llm.common import stored, texts, tidy
from storeglass.llm.tokens import vocabulary

#: Tokens of both kinds after which a block is closed; a longer document is a block of its own.
BLOCK = 1 << 20
_BLOCK = (
    "block long, doc_ids array<long>, figures binary, digests array<string>, owners binary, places binary, times binary, "
    "pairs array<long>, n_docs array<int>"
)
_RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


class Coding:
    """Ids of one vocabulary: `encode` gives an array of them; the bytes of each id, and their lengths."""

    def __init__(self, encode, tokens: Sequence[bytes]):
        self.encode, self.tokens = encode, tokens
        self.lengths = np.array([len(t) for t in tokens], np.int64)

    def whole(self, ids: np.ndarray, data: bytes) -> bool:
        return b"".join(map(self.tokens.__getitem__, ids.tolist())) == data


@lru_cache(maxsize=4)
def byte_coding(path: str) -> Coding:
    """space + text by a byte-level vocabulary in its rank form; strings of special tokens are plain text."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    coding = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return Coding(lambda text: coding.encode_to_numpy(" " + text, disallowed_special=()), tokens)


@lru_cache(maxsize=4)
def piece_coding(path: str) -> Coding:
    """text by a piece vocabulary that puts a space (U+2581) in front and falls back to bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = [
        bytes([int(piece[3:5], 16)]) if model.is_byte(k) else piece.replace("▁", " ").encode()
        for k, piece in enumerate(map(model.id_to_piece, range(model.get_piece_size())))
    ]
    return Coding(lambda text: np.array(model.encode(text, num_threads=1), np.uint32), tokens)


def encoded(batches: Iterator[pa.RecordBatch], a: Coding, b: Coding) -> Iterator[tuple[int | None, np.ndarray, np.ndarray]]:
    """doc_id, A ids and B ids of every row of (doc_id, text)."""
    none = np.zeros(0, np.uint32)
    for batch in batches:
        for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text, ids_a, ids_b = value.as_py(), none, none
            if text:
                data = b" " + text.encode()
                ids_a, ids_b = a.encode(text), b.encode(text)
                if not (a.whole(ids_a, data) and b.whole(ids_b, data)):
                    ids_a, ids_b = none, none
            yield doc_id, ids_a, ids_b


def coalesce(starts_a: np.ndarray, ends_a: np.ndarray, starts_b: np.ndarray, ends_b: np.ndarray):
    """Groups and links of two lists of intervals, each sorted and without overlaps of its own.

    Returns the order of all intervals (A first, numbered through) by start, A before B at equal starts; the group of
    each in that order, from 0; and the links as two arrays (A number, B number).
    """
    starts, ends = np.concatenate([starts_a, starts_b]), np.concatenate([ends_a, ends_b])
    kind = np.repeat(np.array([0, 1], np.int8), [len(starts_a), len(starts_b)])
    order = np.lexsort((kind, starts))
    reached = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order][1:] >= reached[:-1]
    first = np.searchsorted(ends_b, starts_a, side="right")
    past = np.searchsorted(starts_b, ends_a, side="left")
    n = np.maximum(past - first, 0)
    a = np.repeat(np.arange(len(starts_a)), n)
    b = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    return order, np.cumsum(breaks) - 1, a, b


@lru_cache(maxsize=4)
def decimals(n: int) -> np.ndarray:
    """The numbers below n in decimal, padded by zero bytes, followed by a comma, then the same with `|` and with `;`."""
    return np.array([f"{k}{sign}".encode() for sign in ",|;" for k in range(n)], f"S{len(str(n)) + 1}")


def written_groups(ids: np.ndarray, kinds: np.ndarray, groups: np.ndarray, documents: np.ndarray, n_docs: int) -> list[str]:
    """SHA-256 of `a1,a2|b1;a3|b2,b3` per document; `documents` ascends over the tokens in their order.

    Within a group the A ids come first. Every id is written with the sign that follows it, and the sign after a
    document's last id is left out.
    """
    order = np.lexsort((kinds, groups))  # stable: tokens of a kind keep their order
    ids, kinds, groups, documents = ids[order], kinds[order], groups[order], documents[order]
    closes = np.append(groups[1:] != groups[:-1], True)
    turns = np.append(kinds[1:] != kinds[:-1], True) & ~closes
    size = 1 << int(ids.max(initial=0)).bit_length()
    signed = decimals(size)
    raw = signed[ids + size * (turns + 2 * closes)].view(np.uint8).reshape(len(ids), signed.itemsize)
    used = raw != 0
    ends = np.cumsum(np.bincount(documents, used.sum(axis=1), n_docs)).astype(np.int64)
    data = raw[used].tobytes()
    out, low = [], 0
    for end in ends.tolist():
        out.append(hashlib.sha256(data[low : end - 1]).hexdigest() if end > low else "")
        low = end
    return out


def aligned(block: int, rows: list[tuple[int | None, np.ndarray, np.ndarray]], a: Coding, b: Coding) -> pa.RecordBatch:
    """One row for a block of documents (doc_id, A ids, B ids)."""
    n_a, n_b = (np.array([len(row[k]) for row in rows], np.int64) for k in (1, 2))
    ids_a, ids_b = (np.concatenate([row[k] for row in rows]).astype(np.int64) for k in (1, 2))
    ends_a, ends_b = np.cumsum(a.lengths[ids_a]), np.cumsum(b.lengths[ids_b])
    order, groups, from_a, to_b = coalesce(ends_a - a.lengths[ids_a], ends_a, ends_b - b.lengths[ids_b], ends_b)
    doc = np.arange(len(rows))
    doc_a, doc_b = np.repeat(doc, n_a), np.repeat(doc, n_b)
    ids, doc_of = np.concatenate([ids_a, ids_b])[order], np.concatenate([doc_a, doc_b])[order]
    kinds = (order >= len(ids_a)).astype(np.int8)
    digests = written_groups(ids, kinds, groups, doc_of, len(rows))
    heads = np.append(True, groups[1:] != groups[:-1]) if len(groups) else np.zeros(0, bool)
    n_groups = np.bincount(doc_of[heads], minlength=len(rows))
    linked = doc_a[from_a]
    n_links = np.bincount(linked, minlength=len(rows))
    pairs, place = np.unique(ids_a[from_a] << 32 | ids_b[to_b], return_inverse=True)
    held, times = np.unique(linked * max(len(pairs), 1) + place, return_counts=True)
    owners, places = held // max(len(pairs), 1), held % max(len(pairs), 1)
    figures = np.stack([n_a, n_b, n_groups, n_links], axis=1).astype("<i8")
    return pa.RecordBatch.from_arrays([
        pa.array([block], pa.int64()), pa.array([[row[0] for row in rows]], pa.list_(pa.int64())),
        pa.array([figures.tobytes()]), pa.array([digests], pa.list_(pa.string())),
        pa.array([owners.astype("<u4").tobytes()]), pa.array([places.astype("<u4").tobytes()]),
        pa.array([times.astype("<u4").tobytes()]), pa.array([pairs], pa.list_(pa.int64())),
        pa.array([np.bincount(places, minlength=len(pairs))], pa.list_(pa.int32())),
    ], names=[field.split()[0] for field in _BLOCK.split(", ")])


def blocks(docs: DataFrame, byte_vocab: str, piece_vocab: str, size: int) -> DataFrame:
    """Rows of `aligned`: every document of the table is in one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_coding(byte_vocab), piece_coding(piece_vocab)
        number = TaskContext.get().partitionId() << 32
        rows, held = [], 0
        for row in encoded(batches, a, b):
            rows.append(row)
            held += len(row[1]) + len(row[2]) + 1
            if held >= size:
                yield aligned(number, rows, a, b)
                number, rows, held = number + 1, [], 0
        if rows:
            yield aligned(number, rows, a, b)

    return texts(docs).mapInArrow(tidy(run), _BLOCK)


def groups(docs: DataFrame, byte_vocab: str | None = None, piece_vocab: str | None = None) -> DataFrame:
    """doc_id, group_no (from 0), start and end in the bytes of space + text, a_ids, b_ids: every group of every document."""
    byte_vocab = byte_vocab or vocabulary("byte_bpe_50k.tiktoken")
    piece_vocab = piece_vocab or vocabulary("piece_bpe_32k.model")
    names = ["doc_id", "group_no", "start", "end", "a_ids", "b_ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_coding(byte_vocab), piece_coding(piece_vocab)
        for doc_id, ids_a, ids_b in encoded(batches, a, b):
            if not len(ids_a):
                continue
            ends_a, ends_b = np.cumsum(a.lengths[ids_a]), np.cumsum(b.lengths[ids_b])
            order, group, _, _ = coalesce(ends_a - a.lengths[ids_a], ends_a, ends_b - b.lengths[ids_b], ends_b)
            cut = [np.flatnonzero(np.diff(group[np.argsort(order)][part], prepend=-1)) for part in (
                slice(0, len(ids_a)), slice(len(ids_a), None))]
            ends = np.append(ends_a[cut[0][1:] - 1], ends_a[-1])
            lists = [pa.ListArray.from_arrays(pa.array(np.append(at, len(ids)), pa.int32()), pa.array(ids.astype(np.int32)))
                     for at, ids in zip(cut, (ids_a, ids_b), strict=True)]
            columns = [pa.array([doc_id] * len(ends), pa.int64()), pa.array(np.arange(len(ends))),
                       pa.array(np.append(0, ends[:-1])), pa.array(ends), *lists]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return texts(docs).mapInArrow(
        tidy(run), "doc_id long, group_no long, start long, end long, a_ids array<int>, b_ids array<int>")


def pair_counts(held: DataFrame) -> DataFrame:
    """a, b, n (documents that hold the pair linked), best (n is the highest of the A id)."""
    pairs = held.select(F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("n_docs").alias("n"))))
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("a", F.shiftright("pair", 32))
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))
    return counts.join(highest, "a").select(
        "a", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b"), "n", (F.col("n") == F.col("highest")).alias("best"), "pair")


def add_up(block: pa.Table, totals: pa.Table) -> pa.Table:
    """The documents of one block with the totals of its pairs (pair, n, best)."""
    row = {name: block.column(name)[0] for name in block.column_names}
    array = lambda name, kind: np.frombuffer(row[name].as_py(), kind)
    pairs = np.asarray(row["pairs"].values)
    figures = array("figures", "<i8").reshape(-1, 4)
    owners, places, times = (array(name, "<u4").astype(np.int64) for name in ("owners", "places", "times"))
    n, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
    if totals.num_rows:
        at = np.searchsorted(pairs, totals.column("pair").to_numpy())
        n[at], best[at] = totals.column("n").to_numpy(), totals.column("best").to_numpy()
    sums, bests = np.zeros(len(figures), np.int64), np.zeros(len(figures), np.int64)
    np.add.at(sums, owners, n[places] * times)
    np.add.at(bests, owners, best[places] * times)
    columns = [row["doc_ids"].values] + [pa.array(figures[:, k]) for k in range(4)] + [
        pa.array(bests), pa.array(sums), row["digests"].values]
    return pa.Table.from_arrays(columns, names=[field.split()[0] for field in _RESULT.split(", ")])


def align(
    docs: DataFrame, byte_vocab: str | None = None, piece_vocab: str | None = None, size: int = BLOCK
) -> DataFrame:
    """One row per document: tokens, groups and links of its alignment, and how its links rank in the corpus."""
    byte_vocab = byte_vocab or vocabulary("byte_bpe_50k.tiktoken")
    piece_vocab = piece_vocab or vocabulary("piece_bpe_32k.model")
    held = stored(blocks(docs, byte_vocab, piece_vocab, size), "aligned")
    totals = pair_counts(held).select("pair", "n", "best")
    wanted = held.select(F.col("block").alias("for_block"), F.explode("pairs").alias("pair")).join(totals, "pair")
    ready = held.drop("n_docs").groupBy("block").cogroup(wanted.groupBy("for_block"))
    return ready.applyInArrow(add_up, _RESULT)
