"""Near duplicates by a chosen-path set similarity join (operator 2).

A document is the set of its word shingles; two documents are linked if their Jaccard similarity reaches a threshold,
and a group is what links connect. Links are found as follows.

1. One pass over the texts gives each document's set size, a fingerprint of its set and COORDINATES minwise tokens.
   Documents with the same set become one representative: groups of copies cost one row each from then on.
2. TREES independent trees branch the representatives: in a node, the tokens chosen by the node's path (one, and in a
   share of the nodes a second, so that a pair at the threshold keeps about one common child per level) send a document
   to a child per token. Nodes with one document end. A pair at the threshold is missed by one tree with a chance of
   about 0.13 at the first level and 0.4 at the fourth; TREES trees together, which share the
   coordinates with each other and with the filter in 4, miss it with about 9e-6 and 3.6e-4 (at 0.8: 4e-6 and 1.1e-3).
3. In every node that has become small, or that is still large at the last level, all documents are held against one
   pivot, the smallest id. In a group of near copies of any size that links nearly everyone with a linear number of
   comparisons.
4. What is not yet known to be connected is compared exhaustively: in small nodes pair by pair, after the minwise
   tokens have ruled out what is far below the threshold; in large nodes (one for all nodes with the same pivot) the
   documents outside the pivot's group against all, block by block, where a product of two incidence matrices gives
   all intersections at once and each block reports what it connects, a row per document at most.
5. Every link is confirmed on the full sets, which are built for the documents in question only.
6. Components are found by rounds of hashed minimum labels over stored tables.

No group is collected: rows per task are nodes of at most SMALL documents, or blocks of at most BLOCK.

Odd rows: null and empty texts have the empty set, size 0, and are linked with nothing; rows with a null doc_id are
linked with nothing and kept (component_id null); rows that share a doc_id are documents of their own, each with its own
set, links and row in the result, and the smallest doc_id of its component; an empty table gives an empty result; other
columns are ignored by `groups` and passed through by `filter_documents`, which keeps one row of each component, and one
of rows that are the same in doc_id and text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from storeglass.llm.common import small_or_not, stored, texts, tidy

COORDINATES = 64
TREES = 10
LEVELS = 4
SMALL = 48
BLOCK = 256
#: Share of minwise tokens, below the threshold by so many standard deviations, at which a pair is ruled out.
DEVIATIONS = 4.5


class WordHashes(dict):
    """64-bit hash of each word; forgets what it knows when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `words` words; fewer words make one run, none make no run.

    Bytes are lower-cased and split, which touches A-Z and the white space 0x20, 0x09-0x0D only.
    """
    found = (text or "").encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    values = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    n = max(len(values) - words + 1, 1)
    mixed = np.zeros(n, np.uint64)
    for k in range(min(words, len(values))):
        mixed = (mixed ^ values[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    if len(values) < words:
        mixed ^= np.uint64(len(values))
    return np.unique(mixed)


_ORDERS = np.random.default_rng(11).integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minwise(tokens: np.ndarray) -> np.ndarray:
    """For each coordinate, the 32-bit hash of the token that is smallest under the coordinate's order."""
    out = np.full(COORDINATES, 0xFFFFFFFF, np.uint64)
    for low in range(0, len(tokens), 2048):
        hashed = tokens[low : low + 2048, None] * _ORDERS >> np.uint64(32)
        np.minimum(out, hashed.min(axis=0), out=out)
    return out.astype(np.uint32)


def mix(*parts) -> np.ndarray:
    """64-bit hash of numbers or arrays of numbers."""
    value = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for part in parts:
            value = (value ^ np.asarray(part).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            value = (value ^ (value >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
            value = value ^ (value >> np.uint64(29))
    return value


def signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


class Join:
    """Shingle length, threshold (least / out_of) and what follows from them; sent to the tasks."""

    def __init__(self, words: int, least: int, out_of: int):
        self.words, self.least, self.out_of = words, least, out_of
        share = least / out_of
        deviation = (share * (1 - share) / COORDINATES) ** 0.5
        self.matches = int(COORDINATES * max(share - DEVIATIONS * deviation, 0))
        self.second = 1 / share - 1  # share of nodes with a second token: 1 / share children on average

    def alike(self, sig: np.ndarray, n: np.ndarray, sig2: np.ndarray, n2: np.ndarray) -> np.ndarray:
        """Which pairs (row of the first, row of the second) may reach the threshold."""
        fits = self.out_of * np.minimum(n[:, None], n2) >= self.least * np.maximum(n[:, None], n2)
        rows, columns = np.nonzero(fits)
        close = np.zeros(len(rows), bool)
        for low in range(0, len(rows), 65_536):
            part = slice(low, low + 65_536)
            close[part] = (sig[rows[part]] == sig2[columns[part]]).sum(axis=1) >= self.matches
        return np.stack([rows[close], columns[close]])

    # -- passes over texts

    def measured(self, docs: DataFrame) -> DataFrame:
        """doc_id, n, fingerprint (two longs), sig of every row; sets themselves are not kept."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes = WordHashes()
            for batch in batches:
                n, f1, f2, sigs = [], [], [], []
                for text in batch.column(1):
                    tokens = shingle_set(text.as_py(), self.words, hashes)
                    n.append(len(tokens))
                    f1.append(int(np.add.reduce(mix(tokens, 1)).view(np.int64)))
                    f2.append(int(np.add.reduce(mix(tokens, 2)).view(np.int64)))
                    sigs.append(minwise(tokens).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()),
                     pa.array(sigs, pa.binary())], names=["doc_id", "n", "f1", "f2", "sig"])

        return texts(docs).mapInArrow(tidy(run), "doc_id long, n long, f1 long, f2 long, sig binary")

    def sets(self, docs: DataFrame, ids: DataFrame) -> DataFrame:
        """doc_id and full set of the documents in `ids` (stored)."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes = WordHashes()
            for batch in batches:
                sets = [shingle_set(text.as_py(), self.words, hashes).tobytes() for text in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["doc_id", "tokens"])

        return texts(docs).join(small_or_not(ids), "doc_id", "left_semi").mapInArrow(tidy(run), "doc_id long, tokens binary")

    # -- trees

    def children(self, path: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, child) for every token that a path chooses of a row's signature."""
        first = (mix(path, 3) % np.uint64(COORDINATES)).astype(int)
        further = np.nonzero(mix(path, 5) < np.uint64(int(self.second * 2.0**64)))[0]
        other = ((first[further] + 1 + (mix(path[further], 7) % np.uint64(COORDINATES - 1)).astype(int)) % COORDINATES)
        rows = np.append(np.arange(len(path)), further)
        chosen = np.append(first, other)
        return rows, mix(path[rows], chosen, sig[rows, chosen])

    def roots(self, reps: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, sig = np.asarray(batch.column(0)), signatures(batch.column(1))
                for tree in range(TREES):
                    rows, nodes = self.children(np.full(len(ids), mix(tree, 13)), sig)
                    yield pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), pa.array(ids[rows])], names=["node", "doc_id"])

        return reps.select("doc_id", "sig").mapInArrow(tidy(run), "node long, doc_id long")

    def branch(self, rows: DataFrame) -> DataFrame:
        """The next level of (node, doc_id, sig)."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = np.asarray(batch.column(1))
                at, nodes = self.children(np.asarray(batch.column(0)).view(np.uint64), signatures(batch.column(2)))
                yield pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), pa.array(ids[at])], names=["node", "doc_id"])

        return rows.select("node", "doc_id", "sig").mapInArrow(tidy(run), "node long, doc_id long")

    def nodes(self, reps: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(node, doc_id) of the small nodes, and (pivot, doc_id) of those still large at the last level."""
        rows, small = self.roots(reps), None
        for level in range(LEVELS):
            rows = stored(rows, "level")
            sizes = stored(rows.groupBy("node").agg(F.count("*").alias("size"), F.min("doc_id").alias("pivot"))
                           .filter("size > 1"), "sizes")
            held = stored(rows.join(small_or_not(sizes), "node"), "held")
            ended = held.filter(F.col("size") <= SMALL).select("node", "doc_id")
            small = ended if small is None else small.unionByName(ended)
            large = held.filter(F.col("size") > SMALL)
            if level + 1 < LEVELS:
                rows = self.branch(large.join(reps.select("doc_id", "sig"), "doc_id"))
        return small, stored(large.select("pivot", "doc_id").distinct(), "large")

    # -- candidates

    def groupwise(self, rows: DataFrame, keys: list[str], pairs_of) -> DataFrame:
        """Pairs (a, b, star) of groups of bounded size, which are told apart by sorting the partitions. `rows` has the
        keys, doc_id, n, a binary column and side."""
        spread = rows.repartition(*keys).sortWithinPartitions(*keys)
        width = len(keys)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []

            def flush(table: pa.Table) -> pa.RecordBatch:
                key = np.stack([table.column(k).to_numpy() for k in range(width)])
                ids, n, side = (table.column(width + k).to_numpy() for k in (0, 1, 3))
                payload = table.column(width + 2)
                cuts = np.append(np.nonzero((key[:, 1:] != key[:, :-1]).any(axis=0))[0] + 1, len(ids))
                out, low = [], 0
                for high in cuts:
                    found = pairs_of(self, ids[low:high], n[low:high], payload.slice(low, high - low), side[low:high])
                    if len(found):
                        out.append(found)
                    low = high
                a, b, star = np.concatenate(out).T if out else np.zeros((3, 0), np.int64)
                return pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(b), pa.array(star == 1)], names=["a", "b", "star"])

            for batch in batches:
                # All but the batch's last group is complete.
                table = pa.Table.from_batches([*held, batch]).combine_chunks()
                key = np.stack([table.column(k).to_numpy() for k in range(width)])
                last = int(np.argmax((key == key[:, -1:]).all(axis=0)))
                if last:
                    yield flush(table.slice(0, last).combine_chunks())
                held = table.slice(last).to_batches()
            if held:
                yield flush(pa.Table.from_batches(held).combine_chunks())

        found = spread.mapInArrow(tidy(run), "a long, b long, star boolean")
        return found.groupBy("a", "b").agg(F.max("star").alias("star"))

    def confirmed(self, pairs: DataFrame, docs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full sets reach the threshold."""
        ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
        sets = stored(self.sets(docs, ids).dropDuplicates(["doc_id"]), "sets")
        first = sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("tokens_a"))
        second = sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("tokens_b"))
        both = pairs.select("a", "b").join(second, "b").join(first, "a").select("a", "b", "tokens_a", "tokens_b")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = []
                for x, y in zip(batch.column(2), batch.column(3), strict=True):
                    x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    good.append(self.out_of * shared >= self.least * (len(x) + len(y) - shared))
                yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

        return both.mapInArrow(tidy(run), "a long, b long")

    def labels(self, docs: DataFrame, reps: DataFrame) -> DataFrame:
        """(doc_id, label) of the representatives that are linked with a smaller one; label is the group's smallest."""
        small, large = self.nodes(reps)
        with_sig = reps.select("doc_id", "n", "sig")
        inner = self.groupwise(
            small.join(with_sig, "doc_id").select("node", "doc_id", "n", "sig", F.lit(0).alias("side")), ["node"], pairs_in_node)
        pivots = with_sig.select(F.col("doc_id").alias("pivot"), F.col("n").alias("pn"), F.col("sig").alias("psig"))
        stars = large.filter("doc_id > pivot").join(with_sig, "doc_id").join(pivots, "pivot")
        pairs = stored(inner.unionByName(self.likely(stars)).groupBy("a", "b").agg(F.max("star").alias("star")), "pairs")
        links = stored(self.confirmed(pairs.filter("star"), docs), "links")
        known = components(links)
        further = self.confirmed(stored(unjoined(pairs.filter("NOT star"), known), "further"), docs)
        outside = self.outside(large, known, docs)
        if outside is not None:
            further = further.unionByName(
                self.groupwise(outside, ["node", "part", "other"], links_of_sides).select("a", "b"))
        further = stored(further, "links")
        return known if further.isEmpty() else components(stored(links.unionByName(further), "links"))

    def likely(self, stars: DataFrame) -> DataFrame:
        """Pairs with a pivot that the minwise tokens do not rule out."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                a, b, n, pn = (np.asarray(batch.column(k)) for k in range(4))
                fits = self.out_of * np.minimum(n, pn) >= self.least * np.maximum(n, pn)
                close = (signatures(batch.column(4)) == signatures(batch.column(5))).sum(axis=1) >= self.matches
                good = fits & close
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[good]), pa.array(b[good]), pa.array(np.ones(good.sum(), bool))], names=["a", "b", "star"])

        return stars.select(F.col("pivot").alias("a"), F.col("doc_id").alias("b"), "n", "pn", "sig", "psig").mapInArrow(
            tidy(run), "a long, b long, star boolean")

    def outside(self, large: DataFrame, known: DataFrame, docs: DataFrame) -> DataFrame | None:
        """Blocks that hold the documents of large nodes which are not in their pivot's group against all of the node.

        Both sides are dealt into blocks of about BLOCK documents with their full sets; a block pair is a group (node,
        part, other).
        """
        of = small_or_not(known)
        named = large.join(of, "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))
        pivot = of.select(F.col("doc_id").alias("pivot"), F.col("label").alias("pivot_label"))
        named = stored(named.join(pivot, "pivot", "left").select(
            F.col("pivot").alias("node"), "doc_id", (F.col("label") != F.coalesce("pivot_label", "pivot")).alias("out")), "named")
        counts = stored(named.groupBy("node").agg(
            F.count("*").alias("size"), F.count(F.when(F.col("out"), 1)).alias("n_out")).filter("n_out > 0"), "outside")
        if counts.isEmpty():
            return None
        named = named.join(small_or_not(counts), "node")
        ids = stored(named.select("doc_id").distinct(), "ids")
        sets = stored(self.sets(docs, ids).dropDuplicates(["doc_id"]), "sets")
        named = stored(named.join(sets, "doc_id"), "outside")
        parts, others = F.ceil(F.col("n_out") / BLOCK), F.ceil(F.col("size") / BLOCK)
        place = lambda n: F.pmod(F.xxhash64("doc_id"), n)
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
        show = ["doc_id", (F.length("tokens") / 8).cast("long").alias("n"), "tokens"]
        left = named.filter("out").select("node", place(parts).alias("part"), every(others).alias("other"), *show, F.lit(1).alias("side"))
        right = named.select("node", every(parts).alias("part"), place(others).alias("other"), *show, F.lit(2).alias("side"))
        return left.unionByName(right)


def pairs_in_node(join: Join, ids: np.ndarray, n: np.ndarray, payload: pa.ChunkedArray, side: np.ndarray) -> np.ndarray:
    """All candidate pairs of a small node; `star` marks those with the smallest partner of the larger id."""
    order = np.argsort(ids)
    ids, n, sig = ids[order], n[order], signatures(payload)[order]
    rows, columns = join.alike(sig, n, sig, n)
    rows, columns = rows[rows < columns], columns[rows < columns]
    seen: set[int] = set()
    star = [0 if c in seen or seen.add(c) else 1 for c in columns.tolist()]  # rows ascend
    return np.stack([ids[rows], ids[columns], np.array(star, np.int64)], axis=1)


def links_of_sides(join: Join, ids: np.ndarray, n: np.ndarray, payload: pa.ChunkedArray, side: np.ndarray) -> np.ndarray:
    """What the links between two blocks connect: (smallest document of the connected ones, document).

    Intersections are sums over tokens of the product of two 0/1 matrices, taken for some columns at a time; tokens of
    one document only have no part in them.
    """
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in payload]
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    tokens, column, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.nonzero(uses > 1)[0]
    number = np.full(len(tokens), -1)
    number[shared] = np.arange(len(shared))
    column = number[column]
    owner, column = owner[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    one, two = np.nonzero(side == 1)[0], np.nonzero(side == 2)[0]
    common = np.zeros((len(one), len(two)), np.float32)
    for low in range(0, len(shared), 4096):
        a, b = np.searchsorted(column, [low, low + 4096])
        present = np.zeros((len(ids), 4096), np.float32)
        present[owner[a:b], column[a:b] - low] = 1
        common += present[one] @ present[two].T
    linked = join.out_of * common >= join.least * (n[one][:, None] + n[two] - common)
    far = np.iinfo(np.int64).max
    left, right, before = ids[one], ids[two], None
    while before is None or (left != before[0]).any() or (right != before[1]).any():
        before = left, right
        left = np.minimum(left, np.where(linked, right, far).min(axis=1, initial=far))
        right = np.minimum(right, np.where(linked, left[:, None], far).min(axis=0, initial=far))
    b, a = np.append(ids[one], ids[two]), np.append(left, right)
    return np.stack([a, b, np.zeros(len(a), np.int64)], axis=1)[a != b]


def unjoined(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs whose ends are in different groups so far."""
    of = small_or_not(known)
    label = lambda side: of.select(F.col("doc_id").alias(side), F.col("label").alias(f"label_{side}"))
    named = pairs.select("a", "b").join(label("a"), "a", "left").join(label("b"), "b", "left")
    return named.filter(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(doc_id, label) for every document that is linked with a smaller one, directly or through others.

    Large-star and small-star steps (Kiveris et al. 2014) until the edges are stars; each step is a grouping and a join.
    """
    edges = links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).filter("v <> m").distinct()
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("m").alias("v"), F.col("v").alias("m")))
        least = both.groupBy("v").agg(F.least(F.min("m"), F.col("v")).alias("low"))
        edges = both.join(least, "v").filter("m > v").select(F.col("m").alias("v"), F.col("low").alias("m")).unionByName(
            least.filter("low < v").select("v", F.col("low").alias("m"))).distinct()
        least = edges.groupBy("v").agg(F.min("m").alias("low"))
        edges = stored(edges.join(least, "v").filter("m > low").select(F.col("m").alias("v"), F.col("low").alias("m")).unionByName(
            least.select("v", F.col("low").alias("m"))).filter("v <> m").distinct(), "edges")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)")).alias("s")).first()
        if now == before:
            return edges.select(F.col("v").alias("doc_id"), F.col("m").alias("label"))
        before = now


def distinct_groups(docs: DataFrame, words: int, least: int, out_of: int) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document of a table in which a doc_id stands for one text."""
    join = Join(words, least, out_of)
    rows = stored(join.measured(docs), "measured")
    best = F.min(F.struct("f1", "f2", "n", "sig")).alias("best")
    unique = rows.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(best).select("doc_id", "best.*")
    copies = stored(
        unique.filter("n > 0").groupBy("f1", "f2").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
        .filter("copies > 1").drop("copies"), "copies")
    named = stored(
        unique.join(small_or_not(copies), ["f1", "f2"], "left").withColumn("first", F.coalesce("first", "doc_id")), "named")
    reps = stored(named.filter("n > 0 AND first = doc_id").select("doc_id", "n", "sig"), "reps")
    labels = join.labels(docs, reps).select(F.col("doc_id").alias("first"), "label")
    known = named.join(small_or_not(labels), "first", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "first").alias("component_id"))
    nameless = rows.filter("doc_id IS NULL").select(
        "doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return known.unionByName(nameless).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def repeated_ids(docs: DataFrame) -> DataFrame:
    """The doc_ids that several rows have (one pass over the ids)."""
    return stored(texts(docs).filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select(
        F.col("doc_id").alias("_again")), "again")


def keyed(docs: DataFrame, again: DataFrame) -> DataFrame:
    """docs with _key: doc_id, or a hash of doc_id and text where the doc_id is repeated; null without a doc_id."""
    doc_id, text = docs["doc_id"].cast("long"), docs["text"]
    return docs.join(small_or_not(again), doc_id == F.col("_again"), "left").withColumn(
        "_key", F.when(F.col("_again").isNotNull(), F.xxhash64(doc_id, text.isNull(), text)).otherwise(doc_id))


def keyed_groups(rows: DataFrame, words: int, least: int, out_of: int) -> DataFrame:
    """_key, doc_id, n_shingles, component (a key) of the distinct keys of `keyed` rows."""
    found = distinct_groups(rows.filter("_key IS NOT NULL").select(F.col("_key").alias("doc_id"), "text"), words, least, out_of)
    found = stored(found.select(F.col("doc_id").alias("_key"), "n_shingles", F.col("component_id").alias("component")), "keyed")
    return rows.filter("_key IS NOT NULL").select("_key", F.col("doc_id").cast("long").alias("doc_id")).distinct().join(found, "_key")


def groups(docs: DataFrame, words: int, least: int, out_of: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    again = repeated_ids(docs)
    if again.isEmpty():
        return distinct_groups(docs, words, least, out_of)
    rows = keyed(texts(docs), again)
    named = stored(keyed_groups(rows, words, least, out_of), "named")
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    known = rows.filter("_key IS NOT NULL").select("_key").join(named, "_key").join(smallest, "component").select(
        "doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
    return known.unionByName(distinct_groups(rows.filter("_key IS NULL").select("doc_id", "text"), words, least, out_of))


def filter_documents(docs: DataFrame, words: int = 5, least: int = 80, out_of: int = 100) -> DataFrame:
    """The documents that are kept, with all their columns: of each component the row with the smallest doc_id."""
    again = repeated_ids(docs)
    if again.isEmpty():
        found = distinct_groups(docs, words, least, out_of)
        dropped = stored(found.filter("NOT kept").select(F.col("doc_id").alias("_dropped")), "dropped")
        return docs.join(small_or_not(dropped), docs["doc_id"] == F.col("_dropped"), "left_anti")
    rows = keyed(docs, again)
    named = stored(keyed_groups(rows.select("doc_id", "text", "_key"), words, least, out_of), "named")
    first = named.groupBy("component").agg(F.min(F.struct("doc_id", "_key"))["_key"].alias("_first"))
    dropped = stored(named.join(first, "component").filter("_key <> _first").select(F.col("_key").alias("_dropped")), "dropped")
    kept = rows.join(small_or_not(dropped), F.col("_key") == F.col("_dropped"), "left_anti")
    # Rows of one key have the same doc_id and text; the first of an order over all columns stays.
    same = Window.partitionBy("_key").orderBy(F.xxhash64(*(rows[c] for c in docs.columns)))
    once = kept.filter("_again IS NOT NULL").withColumn("_place", F.row_number().over(same)).filter("_place = 1")
    return kept.filter("_again IS NULL").select(*docs.columns).unionByName(once.select(*docs.columns))
