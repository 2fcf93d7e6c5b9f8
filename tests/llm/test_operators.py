"""The operators against plain versions, on the smallest tables and on hand-made rows."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from storeglass.llm import (
    binary, classify, decontaminate, licenses, neardup, oracles, packing, quality, registry, substrings, suffixes, urls)
from storeglass.llm.tokens import END_OF_TEXT, encoder, vocabulary
from tests.conftest import ROOT
from tests.llm import brute

WORDS = [a + b for a in "ba de fi go ku la me no pi ru sa te vo".split() for b in "n r s t l".split()]


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(WORDS) for _ in range(n))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{ROOT}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {row["doc_id"]: row["text"] for row in docs.collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empties, blanks, a long text, repeated rows and ids, and columns named like those inside the operators."""
    long = prose(1, 20_000)
    rows = [(0, None, None, None, 0), (1, "", "en", "a", 0), (2, " \n\t ", "en", None, 4), (3, long, "en", "a", 1),
            (4, long, "en", "a", 1), (5, prose(2, 60), "fr", "b", 1), (5, prose(2, 60), "fr", "b", 1),
            (5, prose(3, 60), "fr", "b", 1), (None, prose(2, 60), "fr", "b", 1), (6, "one", "de", "b", 3),
            (7, "12 34 !?", "de", "b", 8), (8, "x" * 30_000, "de", "b", 1), (9, "x" * 30_000 + "y", "de", "b", 1)]
    clash = ("_row", "n", "tag", "h", "first", "node", "kept", "label", "score", "start", "length", "sig", "_text", "place")
    return frame(spark, rows).select("*", *[F.lit(7).alias(c) for c in clash])


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


# -- 1


def test_edit_matching(spark):
    items = spark.createDataFrame(
        [(1, prose(10, 12)), (2, prose(11, 9)), (3, "short"), (4, None), (5, prose(11, 9))], "item_id long, text string")
    one, two = prose(10, 12), prose(11, 9)
    edited = one[:20] + "QQ" + one[23:60] + one[61:]
    rows = [(1, f"{prose(1, 50)} {one.upper()}\n{prose(2, 40)}"), (2, prose(3, 90)), (3, f"{prose(4, 5)} {edited} {prose(5, 5)}"),
            (4, two), (5, None), (6, f"{two} {prose(8, 30)} {two}"), (7, two[: len(two) // 2]), (None, two)]
    found = {(r["doc_id"], r["item_id"]): r for r in decontaminate.find(
        spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    for doc_id, text in rows:
        for item_id, item in ((1, one), (2, two), (5, two)):
            distance = brute.edit_distance_within(decontaminate.normal(item), decontaminate.normal(text))
            allowed = len(item) // decontaminate.CHARS_PER_ERROR
            assert ((doc_id, item_id) in found) == (distance <= allowed), (doc_id, item_id, distance)
            if distance <= allowed:
                assert found[doc_id, item_id]["distance"] == distance
    assert found[6, 2]["n_places"] == 2
    clean = decontaminate.filter_documents(spark.createDataFrame(rows, "doc_id long, text string"), items)
    assert sorted(r["doc_id"] for r in clean.collect()) == [2, 5, 7]


def test_myers_is_exact():
    draw = random.Random(5)
    for _ in range(200):
        pattern = "".join(draw.choice("abc") for _ in range(draw.randint(1, 70)))
        text = "".join(draw.choice("abc") for _ in range(draw.randint(0, 90)))
        bits = {c: sum(1 << k for k, x in enumerate(pattern) if x == c) for c in set(pattern)}
        assert decontaminate.best_distance(bits, len(pattern), text) == brute.edit_distance_within(pattern, text)


def test_blocks_of_items(spark, monkeypatch):
    items = spark.createDataFrame([(k, prose(50 + k, 12)) for k in range(20)], "item_id long, text string")
    docs = spark.createDataFrame([(k, prose(50 + k, 12)) for k in range(25)], "doc_id long, text string")
    blocks = list(decontaminate.blocks(items, 400))
    assert len(blocks) > 2 and sorted(i for b in blocks for i, _ in b) == list(range(20))
    assert sorted(r["doc_id"] for r in decontaminate.find(docs, items).collect()) == list(range(20))


# -- 2


def copies(n=40):
    """Groups of exact and near copies, of different sizes and distances, among unrelated texts."""
    out, draw = [], random.Random(3)
    for group in range(12):
        base = prose(100 + group, 80).split()
        for _ in range(1 + group % 5):
            edited = list(base)
            for _ in range(draw.choice([0, 1, 2, 3, 6])):
                edited[draw.randrange(len(edited))] = draw.choice(WORDS)
            out.append(" ".join(edited))
    base = prose(999, 60).split()
    for k in range(n):  # a group that is larger than a small node
        edited = list(base)
        edited[k % 60] = "q" * (k % 7)
        out.append(" ".join(edited))
    draw.shuffle(out)
    return {k: t for k, t in enumerate(out + ["", None, "a b", "a b", "A B", "a"])}


@pytest.mark.parametrize(("small", "block", "n"), [(48, 512, 40), (4, 8, 60)])
def test_near_duplicates(spark, monkeypatch, small, block, n):
    monkeypatch.setattr(neardup, "SMALL", small)
    monkeypatch.setattr(neardup, "BLOCK", block)
    texts = copies(n)
    docs = spark.createDataFrame([(k, t) for k, t in texts.items()], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in neardup.groups(docs, 3, 85).collect()}
    expected = brute.components(texts, 3, 85)
    assert {k: r["component_id"] for k, r in rows.items()} == expected
    assert all(r["n_shingles"] == len(brute.shingles(texts[k], 3)) for k, r in rows.items())
    assert all(r["kept"] == (k == expected[k]) for k, r in rows.items())


def test_near_duplicates_of_documents(spark, texts):
    rows = registry.op2_chosen_path(spark, ROOT).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == brute.components(texts, 3, 85)


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101)], "a long, b long")
    labels = {r["doc_id"]: r["label"] for r in neardup.components(links).collect()}
    assert labels == {**{k: 0 for k in range(1, 61)}, 101: 100}


# -- 3, 5


def test_toxicity_learns_from_its_fold_only(spark):
    rows, labels = [], []
    for k in range(1500):
        toxic = k % 4 == 0
        words = prose(k, 80).split()
        if toxic:
            for at in (7, 23, 61):
                words[at] = random.Random(k + at).choice(["gruzzle", "gruzzling", "bloptard", "snarvik"]) + random.Random(k).choice(["", "s", "er"])
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic)))
    docs = spark.createDataFrame([*rows, (5000, None), (None, "gruzzles bloptard")], "doc_id long, text string")
    scored = classify.toxicity(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(scored) == 1502
    for r in scored:
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    held = [r for r in scored if r["held_out"] and r["doc_id"] < 1500]
    right = [r["predicted"] == (r["doc_id"] % 4 == 0) for r in held]
    assert len(held) > 400 and np.mean(right) > 0.97
    # Labels of the held-out fold change nothing.
    turned = [(k, q, 1 - t if zlib.crc32(str(k).encode()) % 3 == 1 else t) for k, q, t in labels]
    again = classify.toxicity(docs, spark.createDataFrame(turned, "doc_id long, quality int, toxic int")).collect()
    assert sorted(map(str, again)) == sorted(map(str, scored))


def test_language(spark, docs):
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = classify.language(docs).collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.95


def test_labels_that_teach_nothing(spark, odd, none):
    no_labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in classify.toxicity(odd, no_labels).collect()} == {0.5}
    assert classify.toxicity(none, no_labels).count() == 0
    assert classify.language(none).count() == 0
    by_row = [(r["doc_id"], r["lang_pred"]) for r in classify.language(odd).collect()]
    assert len(by_row) == odd.count()
    assert {lang for doc_id, lang in by_row if doc_id in (0, 1, 2, 7)} == {"und"}


# -- 4, 9


def test_ids_are_those_of_the_tokenizer(texts):
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    encode = encoder(vocabulary())
    for text in [*list(texts.values())[:60], f"a {END_OF_TEXT}b {END_OF_TEXT}", "  \n\n x  ", "日本語 ١٢٣ 😀", "don't WE'LL"]:
        assert encode(text).tolist() == known.encode(text, add_special_tokens=False).ids


def check_pieces(rows, texts, size):
    encode, by_doc, by_sequence = encoder(vocabulary()), {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for doc_id, pieces in by_doc.items():
        ids, at = [*encode(texts[doc_id]).tolist(), 0], 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            part = np.array(ids[at : at + r["length"]], "<u4")
            assert (r["start"], r["ids_crc32"], r["doc_tokens"]) == (at, zlib.crc32(part.tobytes()), len(ids))
            at += r["length"]
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size


def test_packing(spark, docs, texts):
    rows = packing.pack_documents(docs).collect()
    check_pieces(rows, texts, 1024)
    assert sum(r["length"] for r in rows) > 0.97 * 1024 * len({r["sequence_id"] for r in rows})


def test_shortest_pack_first():
    patterns = packing.shortest_pack_first({6: 3, 5: 2, 4: 4, 2: 1, 10: 1}, 10)
    placed = {}
    for pattern, n in patterns:
        assert sum(pattern) <= 10
        for length in pattern:
            placed[length] = placed.get(length, 0) + n
    assert placed == {6: 3, 5: 2, 4: 4, 2: 1, 10: 1}


def test_matrices(spark, docs, texts):
    rows = binary.pack_matrices(docs).collect()
    encode, parts = encoder(vocabulary()), {}
    for r in rows:
        ids = np.frombuffer(r["input_ids"], "<u2")
        assert len(ids) == 1024 and zlib.crc32(r["input_ids"]) == r["ids_crc32"] and r["cu_seqlens"][-1] == r["n_ids"]
        for k, doc_id in enumerate(r["doc_ids"]):
            parts.setdefault(doc_id, []).append((r["position_starts"][k], ids[r["cu_seqlens"][k] : r["cu_seqlens"][k + 1]].tolist()))
        positions = binary.position_ids(r["cu_seqlens"])
        assert all(positions[start] == 0 for start in r["cu_seqlens"] if start < 1024) and len(positions) == 1024
    assert {d: [i for _, p in sorted(x) for i in p] for d, x in parts.items()} == {d: [*encode(t).tolist(), 0] for d, t in texts.items()}
    assert len({r["row_id"] for r in rows}) == len(rows)


def test_best_fit_takes_the_fullest_row_that_fits():
    draw = random.Random(2)
    lengths = [draw.randint(1, 32) for _ in range(300)]
    rooms, expected = [], []
    for k in sorted(range(300), key=lambda k: (-lengths[k], k)):
        fits = [r for r in range(len(rooms)) if rooms[r] >= lengths[k]]
        least = min((rooms[r] for r in fits), default=None)
        if least is None:
            rooms.append(32 - lengths[k])
        else:
            rooms[[r for r in fits if rooms[r] == least][0]] -= lengths[k]
        expected = sorted(rooms)
    rows = binary.best_fit(lengths, 32)
    assert sorted(k for row in rows for k in row) == list(range(300))
    assert sorted(32 - sum(lengths[k] for k in row) for row in rows) == expected


# -- 6, 10: against SQL


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_sql(spark, name):
    base = duckdb.connect()
    base.execute(f"CREATE VIEW documents AS SELECT * FROM '{ROOT}/documents.parquet'")
    expected = base.execute(oracles.oracle_sql()[name])
    columns = [c[0] for c in expected.description]
    wanted = sorted(map(repr, expected.fetchall()))
    got = sorted(repr(tuple(r)) for r in registry.queries()[name](spark, ROOT).select(*columns).collect())
    assert got == wanted


def test_licenses(spark):
    gpl = licenses.TEMPLATES["GPL"]
    rows = [(1, f"{prose(1, 30)}\n{gpl.upper()}!!\n{prose(2, 9)}"), (2, gpl.replace("3.0", "2.0")), (3, prose(4, 30)), (4, None),
            (5, ""), (6, "Released under"), (None, gpl), (8, licenses.TEMPLATES["MIT permission"].replace(", ", ",\n"))]
    found = {(r["doc_id"], r["line_no"]): (r["template"], r["dice_percent"])
             for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {(1, 2): ("GPL", 100), (2, 1): ("GPL", found[2, 1][1]), (None, 1): ("GPL", 100), (8, 0): ("MIT permission", 100)}


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_wrapped_licenses(spark, name):
    words = licenses.TEMPLATES[name].split()
    half = len(words) // 2
    wrapped = f"/*\n * {' '.join(words[:half])}\n * {' '.join(words[half:])}\n */\n"
    short = [" ".join(words[k : k + 3]) for k in range(0, len(words), 3)]
    rows = [(1, wrapped + prose(1, 200)), (2, f"{prose(2, 90)}\n# " + "\n# ".join(short) + f"\n{prose(3, 90)}"),
            (3, f"{prose(4, 90)} {' '.join(words)} {prose(5, 90)}"), (4, f"{prose(6, 9)}\n\n{' '.join(words)}\n{prose(7, 90)}"),
            (5, wrapped + prose(8, 200) + "\n" + wrapped)]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    starts = sorted((r["doc_id"], r["line_no"]) for r in found if r["template"] == name)
    # The second line of the shortest notice is enough by itself.
    second = 1 if name == "CC-BY-NC-4.0" else 0
    assert starts == [(1, 2 + second), (2, 2), (3, 1), (4, 3), (5, 2 + second), (5, 7 + second)]


def test_license_runs(spark):
    draw, texts, names = random.Random(9), {}, sorted(licenses.TEMPLATES)
    for k in range(80):
        words = prose(k, draw.choice([0, 3, 40])).split()
        for _ in range(draw.randint(1, 4)):
            notice = licenses.TEMPLATES[draw.choice(names)].split()
            for _ in range(draw.choice([0, 0, 1, 2, 4])):
                notice[draw.randrange(len(notice))] = draw.choice(["", "the", "license", "zorn"])
            words += notice[draw.choice([0, 0, 1, 2]) :] + prose(k, draw.choice([0, 1, 30])).split()
        texts[k] = " ".join(words)
    rows = [(k, text.replace(" ", "\n")) for k, text in texts.items()]  # no line has two words
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    whole = {(r["doc_id"], r["template"]) for r in found if r["line_no"] == 0}
    expected = [(k, name, n, shared) for k, text in texts.items()
                for _, _, name, n, shared in brute.license_runs(text, licenses.TEMPLATES, licenses.LEAST) if (k, name) not in whole]
    got = [(r["doc_id"], r["template"], r["n_bigrams"], r["n_shared"]) for r in found if r["line_no"] > 0]
    assert sorted(got) == sorted(expected) and len(got) > 100


def test_thresholds_follow_their_group(spark):
    plain = [(k, prose(k, 40), "en", "plain", 1) for k in range(300)]
    signs = [(1000 + k, " # | ".join(prose(k, 40).split()), "en", "tables", 1) for k in range(300)]
    strange = [(5000, " # | ".join(prose(7000, 40).split()), "en", "plain", 1)]
    kept = {r["doc_id"] for r in quality.filter_documents(frame(spark, plain + signs + strange)).collect()}
    assert kept == {k for k, *_ in plain + signs}


# -- 7


def test_urls(spark):
    rows = [(1, "https://a.example.org/es/1"), (2, "http://EXAMPLE.org/en/12?x=/es/"), (3, "http://b.org/x"), (4, "http://x.com/fr/3"),
            (5, "http://x.com/de/3#f"), (6, None), (7, "no scheme"), (8, "http://notexample.org/es/1"), (9, "http://x.org"),
            (10, "http://x.net/a/b?c"), (11, "http://org/"), (12, "x://Y.COM:80/de/1"), (12, "x://Y.COM:80/de/1")]
    out = {r["page_id"]: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    expected = {
        1: ("a.example.org", "/es/1", "example.org/es/", "block"), 2: ("example.org", "/en/12", "example.org/en/1", "block"),
        3: ("b.org", "/x", "org/", "allow"), 4: ("x.com", "/fr/3", "com/fr/", "allow"), 5: ("x.com", "/de/3", "com/de/", "block"),
        6: ("", "", None, "allow"), 7: ("", "", None, "allow"), 8: ("notexample.org", "/es/1", "org/", "allow"),
        9: ("x.org", "", None, "allow"), 10: ("x.net", "/a/b", None, "allow"), 11: ("org", "/", "org/", "allow"),
        12: ("y.com:80", "/de/1", None, "allow")}
    assert {k: (r["host"], r["path"], r["rule"], r["verdict"]) for k, r in out.items()} == expected
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


@pytest.mark.parametrize("root", [ROOT, "/root/testdata/sf0.01"])
def test_urls_of_pages(spark, root):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{root}/pages.parquet").collect()}
    expected = brute.url_verdicts(pages, urls.RULES, urls.MAX_BRANCHES, urls.DEVIATION, urls.PRIOR, urls.REJECT_FROM)
    rows = registry.op7_path_templates(spark, root).collect()
    assert len(rows) == len(pages)
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"], r["template"]) for r in rows} == expected


def test_templates_of_blocked_neighbours_are_rejected(spark):
    rules = [("block", "s.com", "/bad/1"), ("allow", "s.com", "/good/1")]
    rows = [(k, f"http://s.com/bad/1{k}") for k in range(100)] + [(200 + k, f"http://s.com/good/1{k}") for k in range(100)]
    rows += [(500, "http://s.com/bad/77"), (501, "http://s.com/good/77"), (502, "http://s.com/else/7")]
    out = {r["page_id"]: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert [out[k]["verdict"] for k in (500, 501, 502)] == ["block", "allow", "allow"]
    assert [out[k]["template"] for k in (500, 501, 502)] == ["/bad/#", "/good/#", "/*/#"]
    many = [(k, f"http://v.com/{''.join(chr(97 + int(c)) for c in str(k))}/x") for k in range(100)]
    wild = {r["template"] for r in urls.judge(spark.createDataFrame(many, "page_id long, url string")).collect()}
    assert wild == {"/*/x"}


# -- 8


def check_cut(rows, texts):
    for doc_id, (data, covered) in brute.cut(texts).items():
        kept = bytes(b for b, c in zip(data, covered, strict=True) if not c)
        spans = sum(1 for k, c in enumerate(covered) if c and (not k or not covered[k - 1]))
        r = rows[doc_id]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (
            len(data), sum(covered), spans, hashlib.sha256(kept).hexdigest()), doc_id


@pytest.mark.parametrize("hot", [substrings.HOT, 2_000])
def test_substrings(spark, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT", hot)
    passage, texts = prose(70, 30), copies()
    texts = {3 * k: t for k, t in texts.items()}
    for k in range(30):
        texts[1 + 3 * k] = f"{prose(200 + k, k)} {passage[k % 5 : len(passage) - k]} {prose(300 + k, k)}"
    texts |= {2: "é" * 60, 5: "é" * 61, 8: "é" * 24, 11: "ab" * 200, 14: "ab" * 26, 17: "z" * 49, 20: "z" * 49}
    docs = spark.createDataFrame([(k, t) for k, t in texts.items()], "doc_id long, text string")
    check_cut({r["doc_id"]: r for r in substrings.deduplicate(docs).collect()}, texts)


def test_suffix_order():
    draw = np.random.default_rng(4)
    for n, letters in ((1, 2), (2, 1), (200, 1), (500, 2), (2000, 3), (2000, 250)):
        data = draw.integers(1, letters + 1, n).astype(np.uint8)
        raw, w = data.tobytes(), suffixes.words(data)
        order = suffixes.suffix_order(data, w)
        depth = suffixes.DEPTH
        assert [raw[k : k + depth] for k in order] == [raw[k : k + depth] for k in sorted(range(n), key=lambda k: raw[k:])]
        shared = suffixes.common_prefixes(order, w)
        for k in range(1, n):
            a, b = raw[order[k] :][:50], raw[order[k - 1] :][:50]
            assert shared[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


# -- odd rows


def test_odd_rows(spark, odd, none):
    n = odd.count()
    items = spark.createDataFrame([(1, prose(2, 60)), (None, "x"), (2, None)], "item_id long, text string")
    assert {r["doc_id"] for r in decontaminate.find(odd, items).collect()} == {5, None}
    clean = decontaminate.filter_documents(odd, items)
    assert clean.columns == odd.columns and clean.count() == n - 3
    rows = neardup.groups(odd, 3, 85).collect()
    assert len(rows) == n and {r["component_id"] for r in rows if r["doc_id"] in (3, 4)} == {3}
    kept = neardup.filter_documents(odd)
    assert kept.columns == odd.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == sorted("0 1 2 3 5 5 6 7 8 9 None".split())
    assert len(packing.pack_documents(odd).filter("start = 0").collect()) == n
    assert sum(len([p for p in r["position_starts"] if p == 0]) for r in binary.pack_matrices(odd).collect()) == n
    assert licenses.scan(odd).count() == 0
    judged = quality.assess(odd)
    assert judged.count() == n and judged.filter("doc_id in (0, 1, 2, 6, 7) AND kept").count() == 0
    assert quality.filter_documents(odd).columns == odd.columns
    out = [(r["doc_id"], r["n_removed"]) for r in substrings.deduplicate(odd).collect()]
    assert len(out) == n and (4, len(prose(1, 20_000))) in out and (3, 0) in out and (9, 30_000) in out and (None, 0) in out
    cut = substrings.cut_documents(odd)
    assert cut.columns == odd.columns and {r["doc_id"]: r["text"] for r in cut.collect()}.get(9) is not None
    for make in (lambda: decontaminate.find(none, items), lambda: decontaminate.find(odd, items.limit(0)), lambda: neardup.groups(none, 3, 85),
                 lambda: neardup.filter_documents(none), lambda: packing.pack_documents(none), lambda: binary.pack_matrices(none),
                 lambda: licenses.scan(none), lambda: quality.assess(none), lambda: quality.filter_documents(none),
                 lambda: substrings.deduplicate(none), lambda: substrings.cut_documents(none)):
        assert make().count() == 0
