"""Quality rules with thresholds that follow the data (operator 10). Built-in functions only.

Every document gets counts of its whole text. A fixed base rule removes texts that are too short or repeat themselves.
The other rules have no fixed cutoffs: for each language and source, quantile sketches of three measures are kept, and
a document fails that lies far outside the middle half of its own group.

The sketch is a log-linear histogram over whole numbers: values below 64 have a bucket each, larger ones share a bucket
with those that agree in their six leading bits, so a quantile is low by 1/32 at most. Sketches merge by adding counts:
within tasks before the shuffle, and from (language, source) to language to everything, which serves as the fallback
of groups with fewer than `min_docs` documents. A group has a few hundred buckets, whatever its size.

Odd rows: a null text has no words and fails the base rule; a null lang or source is a group of its own; repeated rows
count each; an empty table gives an empty result; other columns pass through `filter_documents` untouched, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from storeglass.llm.common import SPACES, small_or_not, stored

#: Base rule.
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: Adaptive rules: distance from the quartiles in interquartile ranges, the least distance per measure, and the number
#: of documents from which a group's own sketch is used.
SPREAD = 4
MIN_DOCS = 200
#: Measures per document: symbols per 1000 words, code points per 100 words, repeated lines per 1000 lines.
LEAST_DISTANCE = {"symbols": 150, "width": 200, "dup_lines": 350}
_SKETCH_BITS = 6


def counts(text: Column) -> dict[str, Column]:
    """The count columns of a text (null: none); `words` has to be dropped by the caller."""
    whole = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(whole, SPACES), lambda w: w != "")
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    return {
        "_words": words,
        "word_chars": F.length(F.regexp_replace(whole, SPACES, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(whole, "[^#*$%&|<>]+", "")).cast("long"),
        "_lines": lines,
    }


def _window_hashes(words: Column) -> tuple[Column, Column]:
    """One 64-bit hash for each run of WINDOW words, over the column `_hashes`, and that column. Two different windows
    of one text share it with a chance of about n^2 / 2^65."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(
        F.size(words) >= WINDOW,
        F.transform(
            F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)),
            lambda at: F.xxhash64(*[F.element_at(F.col("_hashes"), (at + k).cast("int")) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>")), hashes


def _covered(windows: Column) -> Column:
    """Words inside windows that occur at least twice: hashes are sorted with their places, the places of equal
    neighbours sorted again, and every place adds the words that the next one does not cover."""
    pairs = F.sort_array(F.transform(windows, lambda h, at: F.struct(h.alias("h"), at.alias("at"))))

    def twice(sorted_pairs: Column) -> Column:
        def same(at: Column, step: int) -> Column:
            other = F.get(sorted_pairs, (at + step).cast("int"))
            return F.coalesce(other["h"] == F.get(sorted_pairs, at.cast("int"))["h"], F.lit(False))

        kept = F.filter(sorted_pairs, lambda p, at: same(at, -1) | same(at, 1))
        return F.sort_array(F.transform(kept, lambda p: p["at"]))

    # The arrays are bound by one-element transforms, so that each is built once.
    places = F.get(F.transform(F.array(pairs), twice), 0)
    return F.aggregate(
        places,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda got, at: F.struct(
            (got["n"] + F.least(F.lit(WINDOW), at - got["last"])).cast("long").alias("n"), at.alias("last")),
        lambda got: got["n"],
    )


def with_counts(rows: DataFrame, text: str) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words and base_failed."""
    keep = rows.columns
    step = rows.select("*", *[c.alias(name) for name, c in counts(F.col(text)).items()])
    step = step.select(
        *keep, "word_chars", "n_symbols", "_words",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    )
    windows, hashes = _window_hashes(F.col("_words"))
    step = step.withColumn("_hashes", hashes).withColumn("_windows", windows)
    repeat_words = F.when(F.size(F.array_distinct("_windows")) == F.size("_windows"), F.lit(0).cast("long")).otherwise(
        _covered(F.col("_windows")))
    found = F.struct(
        F.size("_words").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        repeat_words.alias("n_repeat_words"))
    # Exploding an array of one keeps filters above, and with them copies of these expressions, out of what lies below.
    step = step.select(*keep, F.explode(F.array(found)).alias("_found")).select(*keep, "_found.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return step.withColumn("base_failed", failed)


def measures() -> dict[str, Column]:
    """Whole-number measures that the adaptive rules look at."""
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    per = lambda n, of, scale: F.floor(n * scale / of).cast("long")
    return {
        "symbols": per(F.col("n_symbols"), words, 1000),
        "width": per(F.col("word_chars"), words, 100),
        "dup_lines": per(F.col("n_dup_lines"), lines, 1000),
    }


def bucket(value: Column) -> Column:
    """Lower bound of the sketch bucket of a whole number."""
    shift = F.greatest(F.length(F.bin(value)) - _SKETCH_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(counted: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n) of the documents that pass the base rule."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(name).alias("measure"), bucket(value).alias("bucket")) for name, value in measures().items()]))
    return (
        counted.filter(~F.col("base_failed")).select("lang", "source", pairs.alias("_m"))
        .groupBy("lang", "source", "_m.measure", "_m.bucket").agg(F.count("*").alias("n"))
    )


def _quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """q1 and q3 per keys and measure out of a sketch: the first bucket whose running count reaches the rank."""
    merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "measure")
    ranked = merged.select(
        *keys, "measure", "bucket", F.sum("n").over(group).alias("docs"),
        F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
    )
    reach = lambda part: F.min(F.when(4 * F.col("upto") >= part * F.col("docs"), F.col("bucket")))
    return ranked.groupBy(*keys, "measure").agg(
        F.max("docs").alias("docs"), reach(1).alias("q1"), reach(3).alias("q3"))


def thresholds(sketch: DataFrame, spread: int = SPREAD, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per (lang, source): low_<measure> and high_<measure>."""
    every = _quartiles(sketch, []).select("measure", F.col("q1").alias("e1"), F.col("q3").alias("e3"))
    lang = _quartiles(sketch, ["lang"]).select(
        F.col("lang").alias("_lang"), F.col("measure").alias("_measure"), F.col("docs").alias("l_docs"),
        F.col("q1").alias("l1"), F.col("q3").alias("l3"))
    own = _quartiles(sketch, ["lang", "source"])
    joined = own.join(lang, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("measure") == F.col("_measure"))).join(
        F.broadcast(every), "measure")  # three rows
    pick = lambda k: (
        F.when(F.col("docs") >= min_docs, F.col(f"q{k}")).when(F.col("l_docs") >= min_docs, F.col(f"l{k}"))
        .otherwise(F.col(f"e{k}")))
    at = joined.select("lang", "source", "measure", pick(1).alias("q1"), pick(3).alias("q3"))
    for_measure = lambda value, name: F.max(F.when(F.col("measure") == name, value))
    columns = []
    for name, least in LEAST_DISTANCE.items():
        far = F.greatest(spread * (F.col("q3") - F.col("q1")), F.lit(least))
        columns += [for_measure(F.col("q1") - far, name).alias(f"low_{name}"),
                    for_measure(F.col("q3") + far, name).alias(f"high_{name}")]
    return at.groupBy("lang", "source").agg(*columns)


def judge(counted: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds `kept`. `limits` is a stored table with a row per (lang, source): it is broadcast if its row count allows,
    otherwise the join is shuffled and left to adaptive skew splitting."""
    limits = small_or_not(limits.select(
        F.col("lang").alias("_lang"), F.col("source").alias("_source"), *[c for c in limits.columns if "_" in c]))
    met = counted.join(
        limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    inside = F.lit(True)
    for name, value in measures().items():
        inside = inside & value.between(F.col(f"low_{name}"), F.col(f"high_{name}"))
    return met.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))


def assess(docs: DataFrame) -> DataFrame:
    """Counts and verdict of every document; texts are read once, only the counts are stored and joined."""
    typed = docs.select(
        F.col("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        F.col("text").cast("string").alias("_text"))
    counted = stored(with_counts(typed, "_text").drop("_text"), "counts")
    limits = stored(thresholds(sketches(counted)), "limits")
    return judge(counted, limits).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns. Each text is counted once: rows that pass the base rule are
    stored with their counts beside them, the sketches read the counts only, and the verdict is joined to the stored rows."""
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("_row"), docs["lang"].cast("string").alias("lang"),
        docs["source"].cast("string").alias("source"), docs["text"].cast("string").alias("_text"))
    passed = stored(with_counts(rows, "_text").drop("_text").filter(~F.col("base_failed")), "passed")
    limits = stored(thresholds(sketches(passed)), "limits")
    return judge(passed, limits).filter("kept").select("_row.*")
