"""A lasting inverted index for product search: postings in blocks with their best scores, written by increments.

Products are numbered into blocks of BLOCK ids and shards of SHARD_BLOCKS blocks. Three versioned tables stand under one
list of versions (`head`), which is committed last, so that a search always sees texts, postings and figures that belong
together:

- `docs`: the products, by shard
- `postings`: a row per term, field and block, by shard and bucket of the term, sorted by term: product ids, how often the
  term occurs in each, the field's length in each, and `edge`, the least length per number of occurrences
- `figures`: documents and words per field, by shard

An increment touches the shards of its products: their texts are merged, and only these shards are indexed again.

A search reads the files of its terms' buckets. Whatever the mean length of a field is by then, `edge` gives the highest
score that a block can reach, exactly. The blocks that may score highest are scored first; the score of the last wanted
place among their products is a bound, and no block that can't reach it is scored at all. Rows and scores are those
of `search.search_products`, which counts words anew for each search.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from storeglass.functions.exprs import all_of
from storeglass.operators.materialize import materialize
from storeglass.plans.search import B, FIELD_BOOSTS, K1, field_text, query_terms, tokens
from storeglass.sources.versions import VersionedTable

#: Products per block, blocks per shard, buckets of terms per shard.
BLOCK, SHARD_BLOCKS, TERM_BUCKETS = 1024, 64, 16


def term_bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def postings_of(docs: DataFrame, buckets: int = TERM_BUCKETS) -> DataFrame:
    """Postings of products with their block and shard. A group is one term and field of one block: at most a block's
    products, however common the term is. A block's products are brought together as texts, which are far smaller than
    their words with ids; words are then counted and listed where they are."""
    fields = F.array(*(F.struct(F.lit(f).alias("field"), tokens(field_text(f)).alias("words")) for f in FIELD_BOOSTS))
    words = docs.repartition("shard", "block").select("shard", "block", "product_id", F.explode(fields).alias("f")).select(
        "shard", "block", "product_id", "f.field", F.size("f.words").alias("length"), F.explode("f.words").alias("term"))
    counts = words.groupBy("shard", "block", "product_id", "field", "length", "term").agg(F.count("*").cast("int").alias("tf"))
    entries = counts.groupBy("shard", "block", "term", "field").agg(
        F.array_sort(F.collect_list(F.struct("product_id", "tf", "length"))).alias("entries"))
    part = lambda name: F.transform("entries", lambda e: e[name])
    least = lambda tf: F.array_min(F.transform(F.filter("entries", lambda e: e["tf"] == tf), lambda e: e["length"]))
    edge = F.transform(F.array_distinct(part("tf")), lambda tf: F.struct(tf.alias("tf"), least(tf).alias("length")))
    return entries.select(
        "shard", term_bucket(F.col("term"), buckets).alias("term_bucket"), "term", "field", "block",
        F.size("entries").alias("n"), part("product_id").alias("product_ids"), part("tf").alias("tfs"),
        part("length").alias("lengths"), edge.alias("edge"))


def figures_of(docs: DataFrame) -> DataFrame:
    """Documents with words, and words, per field and shard."""
    sizes = {f: F.size(tokens(field_text(f))) for f in FIELD_BOOSTS}
    fields = F.array(*(F.struct(F.lit(f).alias("field"), n.alias("n")) for f, n in sizes.items()))
    return docs.select("shard", F.explode(fields).alias("f")).filter("f.n > 0").groupBy("shard", "f.field").agg(
        F.count("*").alias("docs"), F.sum("f.n").alias("words"))


class SearchIndex:
    def __init__(self, spark: SparkSession, path: str, block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS,
                 buckets: int = TERM_BUCKETS):
        """`block`, `shard_blocks` and `buckets` belong to the stored index and must stay the same."""
        self.spark, self.block, self.shard_blocks, self.buckets = spark, block, shard_blocks, buckets
        self.head = VersionedTable(spark, f"{path}/head")
        self.tables = {name: VersionedTable(spark, f"{path}/{name}") for name in ("docs", "postings", "figures")}

    # --- writing -----------------------------------------------------------------------------------------------------

    def update(self, docs: DataFrame) -> None:
        """Adds products, or replaces those with the same product_id. Repeating an update changes nothing."""
        placed = docs.withColumn("block", F.expr(f"product_id div {self.block}")).withColumn(
            "shard", F.expr(f"block div {self.shard_blocks}")).withColumn("_at", F.lit(0))
        shards = [row["shard"] for row in placed.select("shard").distinct().collect()]  # one per folder to be written
        if not shards:
            return
        # What an update that failed half-way wrote is not in the head's versions, so it is not built on.
        base = self.versions() or {}
        now = {"docs": self.tables["docs"].upsert(
            placed, ["shard", "block", "product_id"], "_at", ["shard"], base.get("docs"), together=["shard", "block"])}
        merged, touched = self.tables["docs"].read(now["docs"], {"shard": shards}), [(shard,) for shard in shards]
        postings = postings_of(merged, self.buckets).repartition("shard", "term_bucket").sortWithinPartitions(
            "shard", "term_bucket", "term", "field", "block")
        for name, rows, partitions in (("postings", postings, ["shard", "term_bucket"]), ("figures", figures_of(merged), ["shard"])):
            now[name] = self.tables[name].replace_partitions(rows, partitions, 1, touched, base.get(name))
        self.head.replace(self.spark.createDataFrame([tuple(now.values())], ", ".join(f"{name} long" for name in now)).coalesce(1))

    def vacuum(self, keep: int = 2) -> None:
        """Removes what only heads before the last `keep` refer to, and what unfinished updates left."""
        heads = [self.versions(v) for v in self.head.versions()[-keep:]]
        self.head.vacuum(keep)
        for name, table in self.tables.items():
            table.vacuum(named={head[name] for head in heads})

    # --- reading -----------------------------------------------------------------------------------------------------

    def versions(self, head: int | None = None) -> dict[str, int] | None:
        """The versions of the three tables that belong together; None before the first update."""
        found = self.head.read(head)
        return None if found is None else found.first().asDict()

    def _read(self, name: str, versions, where: dict | None = None) -> DataFrame:
        return self.tables[name].read(versions[name], where)

    def postings(self, terms: list[str], versions) -> DataFrame:
        """The postings of some terms: only their buckets' files, in these only row groups that may hold them."""
        asked = self.spark.range(1).select(
            F.explode(F.array(*map(F.lit, terms))).alias("term")).select(term_bucket(F.col("term"), self.buckets).alias("b"))
        buckets = {row["b"] for row in asked.collect()}  # as many as the query has words
        number = F.array_position(F.array(*map(F.lit, terms)), F.col("term")).cast("int") - 1
        return self._read("postings", versions, {"term_bucket": buckets}).filter(F.col("term").isin(terms)).withColumn("i", number)

    def search(
        self, q: str = "", category: str | None = None, brand: str | None = None, min_price: float | None = None,
        max_price: float | None = None, page: int = 1, size: int = 20,
    ) -> DataFrame:
        """One page by relevance, with the number of all hits; as `search.search_products`."""
        versions = self.versions()
        docs = self._read("docs", versions)
        columns = [c for c in docs.columns if c not in ("block", "shard", "_at")]
        filters = [
            None if not category else F.col("category") == F.lit(category), None if not brand else F.col("brand") == F.lit(brand),
            None if min_price is None else F.col("price") >= F.lit(min_price),
            None if max_price is None else F.col("price") <= F.lit(max_price)]
        wanted = docs.filter(all_of(*filters)) if any(f is not None for f in filters) else None
        best_first = [F.desc("relevance_score"), F.asc("product_id")]
        terms = query_terms(q)
        if not q:
            found = docs if wanted is None else wanted
            return found.select(*columns, F.lit(1.0).alias("relevance_score"), found.agg(F.count("*")).scalar().alias(
                "total_count")).orderBy(*best_first).offset((page - 1) * size).limit(size)
        nothing = docs.filter(F.lit(False)).select(
            *columns, F.lit(0.0).alias("relevance_score"), F.lit(0).cast("bigint").alias("total_count"))
        if not terms:
            return nothing
        postings = self.postings(terms, versions)
        weights = self._weights(postings, versions)
        bounds = materialize(self._bounds(postings, weights, len(terms)))  # a row per block that has a term
        shown = self._best(postings, bounds, weights, wanted, len(terms), page * size)
        if shown is None:
            return nothing
        chosen = shown.orderBy(*best_first).offset((page - 1) * size).limit(size)
        shards = [row["shard"] for row in chosen.select(F.expr(f"block div {self.shard_blocks}").alias("shard")).distinct().collect()]
        texts = self._read("docs", versions, {"shard": shards})  # at most a page's shards
        total = self._total(postings, wanted)
        return texts.join(F.broadcast(chosen.drop("block")), "product_id").select(
            *columns, "relevance_score", total.scalar().alias("total_count")).orderBy(*best_first)

    def _weights(self, postings: DataFrame, versions) -> dict[tuple[str, int], tuple[float, float]]:
        """(inverse document frequency, mean length) per field and term number: a few figures a query."""
        per_field = {r["field"]: r for r in self._read("figures", versions).groupBy("field").agg(
            F.sum("docs").alias("docs"), F.sum("words").alias("words")).collect()}
        counts = postings.groupBy("field", "i").agg(F.sum("n").alias("df"))
        total = F.element_at(F.create_map(*(F.lit(x) for f, r in per_field.items() for x in (f, r["docs"]))), F.col("field"))
        idf = F.log(1 + (total - F.col("df") + 0.5) / (F.col("df") + 0.5))
        return {(r["field"], r["i"]): (r["idf"], per_field[r["field"]]["words"] / per_field[r["field"]]["docs"])
                for r in counts.select("field", "i", idf.alias("idf")).collect()} if per_field else {}

    def _score(self, value, weights, n_terms: int) -> Column:
        """Best field's sum over terms, in the order of the terms, of `value(field, i, mean length)` weighed by idf."""
        sums = []
        for field, boost in FIELD_BOOSTS.items():
            score = F.lit(0.0)
            for i in range(n_terms):
                if (field, i) in weights:
                    idf, mean = weights[field, i]
                    score = score + F.coalesce(value(field, i, mean, F.lit(idf)), F.lit(0.0))
            sums.append(score * F.lit(boost))
        return F.greatest(*sums)

    def _bounds(self, postings: DataFrame, weights, n_terms: int) -> DataFrame:
        """block, bound: the highest score that a product of the block can have. Sums are taken in the order in which
        scores are, and rounding keeps order, so no product exceeds the bound even in the last digit."""
        slots = [(f, i) for f, i in weights]
        edges = postings.groupBy("block").agg(*(
            F.first(F.when((F.col("field") == f) & (F.col("i") == i), F.col("edge")), ignorenulls=True).alias(f"_{f}_{i}")
            for f, i in slots), F.sum("n").alias("n"))
        best = lambda f, i, mean, idf: F.array_max(F.transform(
            f"_{f}_{i}", lambda e: _saturated(e["tf"], e["length"], mean, idf)))
        return edges.select("block", self._score(best, weights, n_terms).alias("bound"))

    def _scored(self, postings: DataFrame, blocks: DataFrame, weights, wanted: DataFrame | None, n_terms: int) -> DataFrame:
        """block, product_id, relevance_score of all products of these blocks that have a term and are wanted."""
        rows = postings.join(blocks, "block").select("block", "field", "i", F.explode(
            F.arrays_zip("product_ids", "tfs", "lengths")).alias("e")).select("block", "field", "i", "e.*")
        here = lambda f, i, name: F.max(F.when((F.col("field") == f) & (F.col("i") == i), F.col(name)))
        counts = rows.groupBy("block", F.col("product_ids").alias("product_id")).agg(
            *(here(f, i, name).alias(f"_{f}_{i}_{name}") for f, i in weights for name in ("tfs", "lengths")))
        value = lambda f, i, mean, idf: _saturated(F.col(f"_{f}_{i}_tfs"), F.col(f"_{f}_{i}_lengths"), mean, idf)
        scored = counts.select("block", "product_id", self._score(value, weights, n_terms).alias("relevance_score"))
        return scored if wanted is None else scored.join(wanted.select("product_id"), "product_id", "left_semi")

    def _best(self, postings, bounds, weights, wanted, n_terms: int, k: int) -> DataFrame | None:
        """At least the k best products; None if no block has a term."""
        first = [row["bound"] for row in bounds.orderBy(F.desc("bound"), "block").limit(k).select("bound").collect()]
        if not first:
            return None
        # Every block has a product with a term, so that k blocks give k products where nothing is filtered.
        top = bounds.filter(F.col("bound") >= F.lit(first[-1])).select("block")
        scores = self._scored(postings, top, weights, wanted, n_terms)
        last = scores.orderBy(F.desc("relevance_score")).limit(k).agg(F.count("*").alias("n"), F.min("relevance_score").alias("s")).first()
        least = last["s"] if last["n"] == k else 0.0
        self.scored_blocks = bounds.filter(F.col("bound") >= F.lit(least)).select("block")
        return self._scored(postings, self.scored_blocks, weights, wanted, n_terms)

    def _total(self, postings: DataFrame, wanted: DataFrame | None) -> DataFrame:
        """Number of hits, counted block by block from the lists of ids; a filter's ids meet them by block."""
        ids = postings.groupBy("block").agg(F.array_distinct(F.flatten(F.collect_list("product_ids"))).alias("ids"))
        if wanted is None:
            return ids.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0)).cast("bigint"))
        allowed = wanted.groupBy("block").agg(F.collect_list("product_id").alias("allowed"))
        return ids.join(allowed, "block").agg(F.coalesce(F.sum(F.size(F.array_intersect("ids", "allowed"))), F.lit(0)).cast("bigint"))


def _saturated(tf: Column, length: Column, mean: float, idf: Column) -> Column:
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * (length / F.lit(mean))))
