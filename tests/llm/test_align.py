"""Cross-tokenizer alignment against a plain version over the JSON form of the byte-level vocabulary."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from storeglass.llm import align
from storeglass.llm.tokens import vocabulary

ODD = [
    (1, "The cat sat.\n\nThe  cats   sat, naïve café."), (1, "a second row of the same id"), (2, None), (3, ""), (None, "no id, two words"),
    (4, "<|endoftext|> <s> </s> <0x41> <unk>"), (5, "a▁b is not given back"), (6, "日本語のテキスト 😀😀 ｆｕｌｌ"), (7, " "), (8, "\x00\t\r\n"),
    (9, "word " * 3000), (10, "The cat sat.\n\nThe  cats   sat, naïve café."), (11, "ﬁ ligature é é"), (12, "x" * 5000),
]


def plain(rows):
    """All documents by loops over tokens and bytes."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    byte = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    byte.encode_special_tokens = True
    piece = SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    shown = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or 174 <= c]
    shown += [c for c in range(256) if c not in shown]
    letters = {chr(c) if 33 <= c <= 126 or 161 <= c <= 172 or 174 <= c else chr(256 + k - 188): c for k, c in enumerate(shown)}
    docs = []
    for doc_id, text in rows:
        a = b = []
        if text:
            a = [(k, bytes(letters[c] for c in byte.id_to_token(k))) for k in byte.encode(" " + text, add_special_tokens=False).ids]
            b = [(k, bytes([int(piece.id_to_piece(k)[3:5], 16)]) if piece.is_byte(k) else piece.id_to_piece(k).replace("▁", " ").encode())
                 for k in piece.encode(text)]
            if not b"".join(t for _, t in a) == b"".join(t for _, t in b) == b" " + text.encode():
                a = b = []
        spans = []
        for tokens in (a, b):
            at, out = 0, []
            for k, t in tokens:
                out.append((at, at + len(t), k))
                at += len(t)
            spans.append(out)
        cuts = sorted({end for _, end, _ in spans[0]} & {end for _, end, _ in spans[1]})
        written, low, ia, ib, links = [], 0, 0, 0, []
        for cut in cuts:
            group = []
            for out, start in ((spans[0], ia), (spans[1], ib)):
                stop = start
                while stop < len(out) and out[stop][1] <= cut:
                    stop += 1
                group.append(out[start:stop])
            ia, ib, low = ia + len(group[0]), ib + len(group[1]), cut
            links += [(x[2], y[2]) for x in group[0] for y in group[1] if x[0] < y[1] and y[0] < x[1]]
            written.append("|".join(",".join(str(x[2]) for x in part) for part in group))
        docs.append((doc_id, len(a), len(b), len(cuts), links, ";".join(written)))
    held = Counter(pair for doc in docs for pair in set(doc[4]))
    top = {}
    for (x, _), n in held.items():
        top[x] = max(top.get(x, 0), n)
    return [
        (doc_id, n_a, n_b, n_groups, len(links), sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links),
         hashlib.sha256(written.encode()).hexdigest() if n_a else "")
        for doc_id, n_a, n_b, n_groups, links, written in docs
    ]


def same(spark, rows, **options):
    docs = spark.createDataFrame([(d, t, "x", 7) for d, t in rows], "doc_id long, text string, block string, pair int").repartition(3)
    found = [tuple(r) for r in align.align(docs, **options).collect()]
    assert sorted(found, key=repr) == sorted(plain(rows), key=repr)
    return docs


@pytest.mark.parametrize("size", [1, 40, 1 << 20])
def test_odd_rows(spark, size):
    same(spark, ODD, size=size)


def test_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    same(spark, [tuple(r) for r in rows])


def test_random_texts(spark):
    draw = random.Random(5)
    signs = list("abcdefgh  \n\té☃ß日😀.,!0123456789'") + ["the ", "ing", "<s>", " ", "　"]
    same(spark, [(k, "".join(draw.choices(signs, k=draw.randrange(60)))) for k in range(300)], size=500)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert align.align(docs).collect() == []
    assert align.groups(docs).collect() == []


def test_groups_give_the_text_back(spark):
    docs = same(spark, ODD)
    text = {d: t for d, t in ODD if d not in (1, None)}
    a, b = align.byte_coding(vocabulary()), align.piece_coding(vocabulary("piece_bpe_32k.model"))
    rows = sorted(align.groups(docs).filter("doc_id > 1").collect(), key=lambda r: (r["doc_id"], r["group_no"]))
    for doc_id in {r["doc_id"] for r in rows}:
        data, at = b" " + text[doc_id].encode(), 0
        for r in (r for r in rows if r["doc_id"] == doc_id):
            assert r["start"] == at
            for coding, ids in ((a, r["a_ids"]), (b, r["b_ids"])):
                assert b"".join(coding.tokens[k] for k in ids) == data[r["start"] : r["end"]]
            at = r["end"]
        assert at == len(data)


def test_coalesce_with_gaps():
    """Intervals that don't tile: groups break at gaps, and what only touches isn't linked."""
    import numpy as np

    order, group, a, b = align.coalesce(np.array([0, 5, 9]), np.array([4, 8, 12]), np.array([2, 8, 20]), np.array([6, 9, 21]))
    assert group.tolist() == [0, 0, 0, 1, 2, 3] and order.tolist() == [0, 3, 1, 4, 2, 5]
    assert list(zip(a.tolist(), b.tolist(), strict=True)) == [(0, 0), (1, 0)]
