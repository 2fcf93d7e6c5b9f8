"""Exact substring deduplication with suffix arrays (operator 8).

A byte goes if a WIDTH-byte string over it also starts in a document with a smaller doc_id. One suffix array of a corpus
fits no task, and most of a corpus repeats nothing; so the suffix arrays get just what may repeat:

1. Copies of a whole text are found by its hash and are resolved at once; only the first of them goes on.
2. Fingerprints: of every WIDTH - GRAM + 1 consecutive grams of GRAM bytes the one with the smallest hash is chosen (winnowing),
   so any common string of WIDTH bytes has a chosen gram in common. They travel in packed columns by hash bucket, each
   task's copies of a fingerprint being merged first. Those in two or more documents are flagged, with the smallest
   document that has them: their source.
3. A second pass looks the flagged fingerprints up in every document. Only buckets that the first pass counted as crowded
   are dealt over several tasks, each with the bucket's flags: one more copy for every CROWDED fingerprints of such a
   bucket, so that the copies of flags grow with the corpus and no faster. The text around them is cut out as segments, which
   meet in a block per source: all documents that may share a string over a fingerprint have it there.
4. In a block, suffixes are sorted in two stages (see `suffixes`), adjacent common prefixes give the strings that occur
   repeatedly, and starts in a document other than the smallest are removed. Blocks share buffers, large ones are dealt
   over several tasks, each of which gets the source's segments; strings that such a task leaves open are settled by
   their hash across tasks, of 128 bits like that of whole copies.
5. Removed runs are joined with their documents.

Tasks hold one buffer or one hash bucket. Texts are shuffled once (both joins of texts share the exchange).

Odd rows: a null text is empty; rows with a null doc_id neither lose nor cause anything; rows of one doc_id are equal in
rank, so none removes from another, and each is returned; an empty table gives an empty result; other columns are
ignored by `deduplicate` and passed through by `cut_documents`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from storeglass.llm.common import small_or_not, stored, tidy
from storeglass.llm.neardup import mix
from storeglass.llm.suffixes import SEPARATOR, WIDTH, repeats, spans

GRAM = 24
#: Bytes of text whose fingerprints are packed together, bytes of text per hash bucket, bytes of a suffix buffer, and
#: bytes of segments from which a block is dealt over several tasks.
PACK, PER_BUCKET, BUFFER, HOT = 4 << 20, 12 << 20, 1 << 20, 8 << 20
#: Fingerprints that a task looks up for one bucket (over four times what PER_BUCKET bytes have on average, so that only
#: fingerprints found very often make a bucket crowded), and buckets per partition where the session has fewer partitions.
CROWDED, PER_TASK = 4_000_000, 4
_CHUNK = 1 << 20


def chosen(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """48-bit hashes of the chosen grams of a text and their positions. Texts shorter than WIDTH have none."""
    hashes, places = [], []
    window = WIDTH - GRAM + 1
    for low in range(0, max(len(data) - WIDTH + 1, 0), _CHUNK):
        part = data[low : low + _CHUNK + WIDTH - 1].astype(np.uint64)
        if len(part) < WIDTH:
            break
        h = polynomials(part)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB) >> np.uint64(16)
        least = sliding(h, window, np.minimum)
        # A gram is chosen if it is the least of some window over it, that is, the largest such least equals it.
        room = np.zeros(window - 1, np.uint64)
        most = sliding(np.concatenate([room, least, room]), window, np.maximum)
        at = np.nonzero(most == h)[0]
        hashes.append(h[at])
        places.append(at + low)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes, places = np.concatenate(hashes), np.concatenate(places)
    once = np.append(True, np.diff(places) > 0) if len(data) <= _CHUNK + WIDTH - 1 else first_of(places)
    return hashes[once], places[once]


def polynomials(values: np.ndarray) -> np.ndarray:
    """Polynomial hash of every GRAM consecutive values, put together from those of 1, 2, 4, ... values."""
    power, factor, size, out, have = values, 0x9E3779B97F4A7C15, 1, None, 0
    while size <= GRAM:
        if GRAM & size:
            out = power if out is None else out[: len(power) - have] * np.uint64(factor) + power[have:]
            have += size
        power = power[:-size] * np.uint64(factor) + power[size:]
        factor, size = factor * factor % (1 << 64), 2 * size
    return out


def first_of(places: np.ndarray) -> np.ndarray:
    """Chunks overlap, so that a gram may be chosen in two of them."""
    return np.unique(places, return_index=True)[1]


def sliding(values: np.ndarray, window: int, best) -> np.ndarray:
    """Minimum or maximum of every `window` consecutive values, by doubling."""
    span, out = 1, values
    while 2 * span <= window:
        out = best(out[:-span], out[span:])
        span *= 2
    rest = window - span
    return best(out[:-rest], out[rest:]) if rest else out


def six(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unsix(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8").astype(np.uint64)


def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list]]:
    """(doc_id, tag, bytes) lists of about PACK bytes, 30,000 documents at most."""
    ids, tags, data, held = [], [], [], 0
    for batch in batches:
        for doc_id, tag, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            ids.append(doc_id)
            tags.append(tag)
            data.append(np.frombuffer(text.as_buffer(), np.uint8))
            held += len(data[-1])
            if held >= PACK or len(ids) >= 30_000:
                yield ids, tags, data
                ids, tags, data, held = [], [], [], 0
    if ids:
        yield ids, tags, data


def packed_prints(heads: DataFrame, buckets: int, places: bool) -> DataFrame:
    """(bucket, prints, docs, places, ids, tags, n): columns of n fingerprints. Without `places` each fingerprint comes
    once per pack, with its smallest document and, in the top bit of `docs`, whether the pack has it in another one too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, tags, data in packs(batches):
            found = [chosen(d) for d in data]
            prints = np.concatenate([h for h, _ in found])
            ranks = np.argsort(np.argsort(np.array(ids, np.int64), kind="stable"), kind="stable")
            docs = np.repeat(np.arange(len(ids)), [len(h) for h, _ in found])
            at = np.concatenate([p for _, p in found])
            times = np.ones(len(prints), np.int64)
            if not places:
                order = np.lexsort((ranks[docs], prints))
                prints, docs = prints[order], docs[order]
                starts = np.nonzero(np.append(True, prints[1:] != prints[:-1]))[0] if len(prints) else np.zeros(0, int)
                ends = np.append(starts[1:], len(prints)) - 1 if len(prints) else starts
                own = np.array(ids, np.int64)
                several = own[docs[starts]] != own[docs[ends]]
                prints, docs, at = prints[starts], docs[starts] | (several.astype(np.int64) << 15), at[:0]
                times = ends - starts + 1
            bucket = (prints % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            cuts = np.nonzero(np.diff(bucket, prepend=-1))[0]
            rows = []
            for low, high in zip(cuts, np.append(cuts, len(bucket))[1:], strict=True):
                part = order[low:high]
                used, doc = np.unique(docs[part] & 0x7FFF, return_inverse=True)
                rows.append((int(bucket[low]), six(prints[part]), (doc | (docs[part] & 0x8000)).astype("<u2").tobytes(),
                             at[part].astype("<u4").tobytes() if places else b"",
                             np.array(ids, "<i8")[used].tobytes(), np.array(tags, "<i4")[used].tobytes() if places else b"",
                             int(times[part].sum())))
                if len(rows) == 64:
                    yield pa.RecordBatch.from_pylist([dict(zip(_PACKED.names, r, strict=True)) for r in rows], _PACKED)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(_PACKED.names, r, strict=True)) for r in rows], _PACKED)

    return heads.mapInArrow(tidy(run), "bucket long, prints binary, docs binary, places binary, ids binary, tags binary, n long")


_PACKED = pa.schema([("bucket", pa.int64())] + [(k, pa.binary()) for k in ("prints", "docs", "places", "ids", "tags")] + [("n", pa.int64())])


def by_bucket(rows: DataFrame, buckets: int, *key: str) -> DataFrame:
    """Rows dealt by key: over the session's partitions, or one for every PER_TASK buckets where those are more."""
    parts = -(-buckets // PER_TASK)
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, *key) if parts > usual else rows.repartition(*key)


def flagged(packed: DataFrame, buckets: int) -> DataFrame:
    """(bucket, prints, sources, n): the fingerprints of a bucket that two documents have, ascending, with their source,
    and how many fingerprints the bucket has in all documents."""

    def merge(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        prints, docs, several = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((docs, prints))
        prints, docs, several = prints[order], docs[order], several[order]
        starts = np.nonzero(np.append(True, prints[1:] != prints[:-1]))[0]
        most = np.maximum.reduceat(docs, starts)
        return prints[starts], docs[starts], np.logical_or.reduceat(several, starts) | (most > docs[starts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held, rows, times = None, [], 0, 0

        def result() -> Iterator[pa.RecordBatch]:
            if held:
                prints, docs, several = merge(held)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket], pa.int64()), pa.array([prints[several].tobytes()], pa.binary()),
                     pa.array([docs[several].tobytes()], pa.binary()), pa.array([times], pa.int64())],
                    names=["bucket", "prints", "sources", "n"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != bucket:
                    yield from result()
                    bucket, held, rows, times = row["bucket"], [], 0, 0
                times += row["n"]
                doc = np.frombuffer(row["docs"], "<u2")
                held.append((unsix(row["prints"]), np.frombuffer(row["ids"], "<i8")[doc & 0x7FFF], doc >= 0x8000))
                rows += len(doc)
                if rows > 4_000_000:  # what repeats within the bucket is merged before it grows further
                    held = [merge(held)]
                    rows = -len(held[0][0])
        yield from result()

    spread = by_bucket(packed.select("bucket", "prints", "docs", "ids", "n"), buckets, "bucket").sortWithinPartitions("bucket")
    return spread.mapInArrow(tidy(run), "bucket long, prints binary, sources binary, n long")


def dealt_flags(flags: DataFrame) -> DataFrame:
    """A row of flags per task of its bucket (salt): one, and another for every CROWDED fingerprints to be looked up."""
    salts = F.floor(F.col("n") / CROWDED).cast("int")
    return flags.select("bucket", "prints", "sources", F.explode(F.sequence(F.lit(0), salts)).alias("salt"))


def lookups(packed: DataFrame, flags: DataFrame, buckets: int) -> DataFrame:
    """(doc_id, tag, place, source) of every flagged fingerprint of every document."""
    crowded = stored(flags.filter(F.col("n") >= CROWDED).select(
        "bucket", (1 + F.floor(F.col("n") / CROWDED)).cast("int").alias("salts")), "crowded")
    packed = packed.join(small_or_not(crowded), "bucket", "left")
    salted = dealt_flags(flags).select("bucket", "salt", F.lit(0).alias("kind"),
                          "prints", F.col("sources").alias("docs"), *[F.lit(b"").alias(k) for k in ("places", "ids", "tags")])
    rows = packed.select("bucket", F.pmod(F.xxhash64("ids"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt"), F.lit(1).alias("kind"),
                         "prints", "docs", "places", "ids", "tags")
    key = ["bucket", "salt"]
    spread = by_bucket(salted.unionByName(rows), buckets, *key).sortWithinPartitions(*key, "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, known, sources = None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    at, known = (row["bucket"], row["salt"]), np.frombuffer(row["prints"], np.uint64)
                    sources = np.frombuffer(row["docs"], np.int64)
                    continue
                if at != (row["bucket"], row["salt"]) or not len(known):
                    continue
                prints = unsix(row["prints"])
                found = np.minimum(np.searchsorted(known, prints), len(known) - 1)
                hit = known[found] == prints
                doc = np.frombuffer(row["docs"], "<u2")[hit]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(row["ids"], "<i8")[doc]), pa.array(np.frombuffer(row["tags"], "<i4")[doc]),
                     pa.array(np.frombuffer(row["places"], "<u4")[hit].astype(np.int64)), pa.array(sources[found[hit]])],
                    names=["doc_id", "tag", "place", "source"])

    return spread.mapInArrow(tidy(run), "doc_id long, tag int, place long, source long")


def segments(located: DataFrame) -> DataFrame:
    """(source, doc_id, tag, start, bytes): the text around a document's flagged fingerprints, by source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, tag, text, found in zip(*(batch.column(k) for k in range(4)), strict=True):
                data = text.as_buffer()
                pairs = found.values.flatten()
                place, source = (np.asarray(x) for x in pairs)
                order = np.lexsort((place, source))
                place, source = place[order], source[order]
                reach = WIDTH - GRAM
                cut = np.nonzero((np.diff(source) != 0) | (np.diff(place) > reach + WIDTH))[0]
                firsts, lasts = np.append(0, cut + 1), np.append(cut, len(place) - 1)
                for a, b in zip(firsts, lasts, strict=True):
                    low, high = max(int(place[a]) - reach, 0), min(int(place[b]) + WIDTH, len(data))
                    out.append((int(source[a]), doc_id.as_py(), tag.as_py(), low, data[low:high].to_pybytes()))
                if len(out) > 4096:
                    yield pa.RecordBatch.from_pylist([dict(zip(_SEGMENTS.names, r, strict=True)) for r in out], _SEGMENTS)
                    out = []
            yield pa.RecordBatch.from_pylist([dict(zip(_SEGMENTS.names, r, strict=True)) for r in out], _SEGMENTS)

    return located.mapInArrow(tidy(run), "source long, doc_id long, tag int, start long, part binary")


_SEGMENTS = pa.schema([("source", pa.int64()), ("doc_id", pa.int64()), ("tag", pa.int32()), ("start", pa.int64()), ("part", pa.binary())])


def repeated(dealt: DataFrame) -> DataFrame:
    """(doc_id, tag, start, stop, open, open2): removed runs, and in hot blocks the open strings by their hash of 128 bits.

    A partition is worked off in buffers that never part a block; documents of a buffer that meet by chance only show
    further true repeats.
    """
    spread = dealt.repartition("source", "salt").sortWithinPartitions("source", "salt")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, key = 0, None

        def result() -> pa.RecordBatch:
            size = sum(len(r[4]) + 1 for r in rows)
            data = np.full(size, SEPARATOR, np.uint8)
            ends, low = [], 0
            for r in rows:
                data[low : low + len(r[4])] = np.frombuffer(r[4], np.uint8)
                low += len(r[4]) + 1
                ends.append(low - 1)
            ends = np.array(ends)
            source, docs, starts = (np.array([r[k] for r in rows], np.int64) for k in (0, 1, 3))
            tags, hot = np.array([r[2] for r in rows], np.int32), np.array([r[5] for r in rows], bool)
            found, fits, w = repeats(data, ends, docs)
            shift = starts - (np.append(-1, ends[:-1]) + 1)  # from buffer to document
            begin, stop = spans(np.nonzero(found)[0])
            owner = np.searchsorted(ends, begin)
            open_at = np.nonzero(fits & ~found & np.repeat(hot & (docs != source), np.diff(np.append(-1, ends))))[0]
            open_owner = np.searchsorted(ends, open_at)
            words = [w[open_at + k] for k in range(0, 48, 8)] + [w[open_at + 48] >> np.uint64(48)]
            none, plain = np.zeros(len(begin), np.int64), np.arange(len(begin) + len(open_at)) < len(begin)
            hashed = [pa.array(np.append(none, mix(*seed, *words).view(np.int64)), mask=plain) for seed in ((), (1,))]
            who = np.append(owner, open_owner)
            return pa.RecordBatch.from_arrays(
                [pa.array(docs[who]), pa.array(tags[who]), pa.array(np.append(begin, open_at) + shift[who]),
                 pa.array(np.append(stop, open_at + WIDTH) + shift[who]), *hashed],
                names=["doc_id", "tag", "start", "stop", "open", "open2"])

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                if rows and size >= BUFFER and row[0:1] + row[6:7] != key:
                    yield result()
                    rows, size = [], 0
                key = row[0:1] + row[6:7]
                rows.append(row)
                size += len(row[4]) + 1
        if rows:
            yield result()

    return spread.select("source", "doc_id", "tag", "start", "part", "hot", "salt").mapInArrow(
        tidy(run), "doc_id long, tag int, start long, stop long, open long, open2 long")


def dealt_blocks(parts: DataFrame) -> DataFrame:
    """Adds hot and salt: blocks of more than HOT bytes are dealt by document, the source's own segments to all."""
    sizes = parts.groupBy("source").agg(F.sum(F.length("part")).alias("bytes")).filter(F.col("bytes") > HOT)
    large = stored(sizes.select("source", F.ceil(F.col("bytes") / HOT).cast("int").alias("salts")), "hot")
    named = parts.join(small_or_not(large), "source", "left")
    own = F.sequence(F.lit(0), F.col("salts") - 1)
    salt = F.when(F.col("salts").isNull(), F.array(F.lit(0))).when(F.col("doc_id") == F.col("source"), own).otherwise(
        F.array(F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int")))
    return named.select("source", "doc_id", "tag", "start", "part", F.col("salts").isNotNull().alias("hot"), F.explode(salt).alias("salt"))


def removed_runs(texts: DataFrame) -> DataFrame:
    """(doc_id, tag, runs): removed runs of every document that has any; `texts` is (doc_id, tag, text: binary, head)."""
    heads = texts.filter("head").select("doc_id", "tag", "text")
    total = heads.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    buckets = max(32, -(-total // PER_BUCKET))
    flags = stored(flagged(packed_prints(heads, buckets, False), buckets), "flags")
    found = stored(lookups(packed_prints(heads, buckets, True), flags, buckets), "found")
    key = ["doc_id", "tag"]
    places = found.groupBy(*key).agg(F.collect_list(F.struct("place", "source")).alias("found"))
    parts = stored(segments(heads.join(places, key).select(*key, "text", "found")), "segments")
    seen = stored(repeated(dealt_blocks(parts)), "repeats")
    left = seen.filter("open IS NOT NULL")
    hashes = ["open", "open2"]
    first = left.groupBy(*hashes).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    across = left.join(first.drop("last"), hashes).filter("doc_id > first")
    runs = seen.filter("open IS NULL").select(*key, "start", "stop").unionByName(across.select(*key, "start", "stop"))
    return stored(runs.groupBy(*key).agg(F.collect_list(F.struct("start", "stop")).alias("runs")), "runs")


def prepared(docs: DataFrame, *others) -> DataFrame:
    """doc_id, tag (tells rows of one doc_id apart), text as bytes, head (first of its copies), copy (a later one)."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.hash(text).alias("tag"),
                       F.encode(text, "UTF-8").alias("text"), F.xxhash64(text).alias("h"),
                       F.xxhash64(F.lit(1), text).alias("h2"), *others)
    slim = rows.filter("doc_id IS NOT NULL").groupBy("h", "h2", F.length("text").alias("size")).agg(
        F.min("doc_id").alias("first"), F.count("*").alias("n"))
    copies = stored(slim.filter("n > 1").select("h", "h2", "size", "first"), "copies")
    named = rows.withColumn("size", F.length("text")).join(small_or_not(copies), ["h", "h2", "size"], "left")
    known = F.col("doc_id").isNotNull()
    return named.select(
        "doc_id", "tag", "text", (known & F.coalesce(F.col("first") == F.col("doc_id"), F.lit(True))).alias("head"),
        (known & F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False))).alias("copy"), *[c for c in named.columns if c == "_row"])


def remaining(data: bytes, runs: list[tuple[int, int]], copy: bool) -> tuple[bytes, int, int]:
    """The bytes that stay, the number of removed bytes, the number of maximal removed runs."""
    if copy and len(data) >= WIDTH:
        return b"", len(data), 1
    kept, at, removed, count = [], 0, 0, 0
    last = -1
    for start, stop in sorted(runs):
        if start > last:
            kept.append(data[max(at, 0) : start])
            count += 1
        removed += max(stop - max(start, at), 0)
        last = at = max(at, stop)
    kept.append(data[at:])
    return b"".join(kept), removed, count


def deduplicate(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    rows = prepared(docs)
    joined = rows.join(removed_runs(rows), ["doc_id", "tag"], "left").select("doc_id", "text", "runs", "copy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256")}
            for text, runs, copy in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                data = text.as_py()
                kept, removed, count = remaining(data, [(r["start"], r["stop"]) for r in runs or ()], copy)
                for k, v in zip(out, (len(data), removed, count, hashlib.sha256(kept).hexdigest()), strict=True):
                    out[k].append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(v, pa.string() if k == "kept_sha256" else pa.int64()) for k, v in out.items()]],
                names=["doc_id", *out])

    return joined.mapInArrow(tidy(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cut_documents(docs: DataFrame) -> DataFrame:
    """All columns of the documents, with the repeated bytes taken out of `text` (half characters at the cuts too) and
    documents of which nothing is left gone. n_chars, where there is such a column, follows the text."""
    rows = prepared(docs, F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("_row"))
    joined = rows.join(removed_runs(rows), ["doc_id", "tag"], "left").select("text", "runs", "copy", "_row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, runs, copy in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = text.as_py()
                kept, removed, _ = remaining(data, [(r["start"], r["stop"]) for r in runs or ()], copy)
                out.append(None if removed and not kept.strip() else kept.decode("utf-8", "ignore"))
            texts = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays([texts, batch.column(3)], names=["text", "_row"]).filter(texts.is_valid())

    schema = f"text string, _row {joined.schema['_row'].dataType.simpleString()}"
    cut = joined.mapInArrow(tidy(run), schema)
    columns = [F.col("text") if c == "text" else F.length("text").cast(t).alias(c) if c == "n_chars" else F.col(f"_row.{c}").alias(c)
               for c, t in docs.dtypes]
    return cut.select(*columns)
