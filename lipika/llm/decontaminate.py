"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

A short item in a long document has a tiny Jaccard similarity, so items, not documents, are
sketched, and containment is searched. Items are partitioned by the size of their shingle
set (powers of two); each partition has its own sketch size ``k``: the ``k`` least hashes
of an item (bottom-k MinHash). With ``k = floor((1 - t) * largest size in the partition) + 1``
a document that holds the share ``t`` of an item's shingles lacks fewer than ``k`` of them, so
it holds one of the sketch: the search misses nothing. What it proposes is verified by
counting the item's shingles in the document's full set.

Only DataFrame functions. The sketches, hash by hash, are broadcast and meet each document's
shingles where the document is read, so neither texts nor unfiltered shingles are shuffled.
What is broadcast is counted before: a benchmark beyond ``PAIR_BOUND`` or ``SHINGLE_BOUND``
is searched in several passes of the same plan, each over a part of the items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lipika.llm._common import bound, columns_of, fresh, stored, table

SHINGLE, PERCENT = 5, 80
#: What a broadcast may hold: pairs of a sketch hash and an item, shingles of items, digests of documents that leak.
PAIR_BOUND, SHINGLE_BOUND, LEAK_BOUND = 1 << 20, 1 << 22, 1 << 20


def words(text: Column) -> Column:
    """Lower-cased runs of letters, marks and digits; null has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def shingle_hashes(w: Column, n: int) -> Column:
    """Hashes of all ``n``-word shingles in order, repeats included; fewer words: the whole as one; none: empty."""

    def hashes(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(n)]))
        whole = F.array(F.xxhash64(F.lit("short"), F.array_join(w, " ")))
        return F.when(F.size(w) >= n, each).when(F.size(w) > 0, whole).otherwise(F.array().cast("array<bigint>"))

    return bound(w, hashes)


def _needed(size: Column, percent: int) -> Column:
    return F.ceil(size * percent / 100).cast("int")


def item_sketches(items: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``item_id, shingles, need, sketch`` of every item that has words; equal rows once."""
    sets = items.select("item_id", F.array_sort(F.array_distinct(shingle_hashes(words(F.col("text")), shingle))).alias("shingles")).where(F.size("shingles") > 0).distinct()
    largest = F.pow(F.lit(2), F.ceil(F.log2(F.size("shingles").cast("double"))))
    k = F.least(F.size("shingles"), F.floor(largest * (100 - percent) / 100).cast("int") + 1)
    return sets.select("item_id", "shingles", _needed(F.size("shingles"), percent).alias("need"), F.slice("shingles", F.lit(1), k).alias("sketch"))


def _leaks(docs: DataFrame, key: list[str], items: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``key, item_id, n_item, n_common`` of every verified pair, once."""
    own = stored(item_sketches(items, shingle, percent).withColumn("nth", F.monotonically_increasing_id()), "items")
    pairs, shingles = own.agg(F.coalesce(F.sum(F.size("sketch")), F.lit(0)), F.coalesce(F.sum(F.size("shingles")), F.lit(0))).first()
    passes = max(1, -(-pairs // PAIR_BOUND), -(-shingles // SHINGLE_BOUND))
    rows = docs.select(*key, shingle_hashes(words(F.col("text")), shingle).alias("shingles"))
    found = None
    for p in range(passes):
        part = own if passes == 1 else own.where(F.pmod(F.xxhash64("nth"), F.lit(passes)) == p)
        by_hash = F.broadcast(part.select("nth", F.explode("sketch").alias("h")))
        sets = F.broadcast(part.select("nth", "item_id", F.col("shingles").alias("item"), "need"))
        met = rows.withColumn("h", F.explode("shingles")).join(by_hash, "h").join(sets, "nth")
        met = met.withColumn("n_common", F.size(F.array_intersect("shingles", "item"))).where("n_common >= need").select(*key, "item_id", F.size("item").alias("n_item"), "n_common")
        found = met if found is None else found.unionByName(met)
    return found.groupBy(*key, "item_id").agg(F.max("n_item").cast("long").alias("n_item"), F.max("n_common").cast("long").alias("n_common"))


def leaks(self, docs: DataFrame, key: list[str]) -> DataFrame:
        """``key, item_id, n_item, n_common`` of every verified pair, once."""
        if not self.fits:
            return self._joined(docs, key)
        by_hash = self.items.select("item_id", F.col("shingles").alias("item"), "need", F.explode("sketch").alias("h"))
        pairs = self.touched(docs, key).join(F.broadcast(by_hash) if self.small else by_hash, "h")
        pairs = pairs.withColumn("n_common", F.size(F.array_intersect("item", "shingles"))).where("n_common >= need")
        return pairs.groupBy(*key, "item_id").agg(F.max(F.size("item")).cast("long").alias("n_item"), F.max("n_common").cast("long").alias("n_common"))


def leaks(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds.

    Returns ``doc_id, item_id, n_item, n_common``: the item's distinct shingles and how many
    of them the document has, where that is ``percent`` of a hundred or more. Cases: null and
    empty texts and items hold and are nothing; an item or document of fewer than ``shingle``
    words is one shingle, its whole sequence; rows that repeat an id come back as one pair
    with the larger counts; null ids are kept as null. Empty tables give no rows. Only the
    named columns are read.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return _leaks(rows, ["doc_id"], items.select("item_id", "text"), shingle, percent)


def without_leaks(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that hold no item; columns unchanged.

    A row's own text decides, whatever its doc_id. Digests of the texts that leak are stored and
    counted; up to ``LEAK_BOUND`` they are broadcast and no text is shuffled, beyond it Spark joins
    by shuffle.
    """
    names = fresh(docs, "text_h1", "text_h2")
    digests = [F.xxhash64(F.col("text")), F.xxhash64(F.lit(1), F.col("text"))]
    rows = docs.select(*[d.alias(n) for d, n in zip(digests, names, strict=True)], F.col("text").cast("string").alias("text"))
    bad = stored(_leaks(rows, names, items.select("item_id", "text"), shingle, percent).select(*names).distinct(), "leaks")
    few = bad.count() <= LEAK_BOUND
    same = (digests[0] == bad[names[0]]) & (digests[1] == bad[names[1]])
    return docs.join(F.broadcast(bad) if few else bad, same, "left_anti").select(*columns_of(docs))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in all documents, five-word shingles, containment 0.8 or more."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _sets_sql(name: str, id_: str) -> str:
    return f"""SELECT DISTINCT {id_}, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN ['short ' || array_to_string(w, ' ')] ELSE [] END) AS sh
  FROM (SELECT {id_}, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM {name})"""


OP7_SQL = f"""
WITH d AS ({_sets_sql("documents", "doc_id")}), i AS ({_sets_sql("benchmark", "item_id")}),
n AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id),
c AS (SELECT doc_id, item_id, count(*) AS n_common FROM d JOIN i USING (sh) GROUP BY ALL)
SELECT doc_id, item_id, n_item, n_common FROM c JOIN n USING (item_id) WHERE 100 * n_common >= 80 * n_item
"""

QUERIES = {"op7_decontaminate": op7_decontaminate}
ORACLES = {"op7_decontaminate": OP7_SQL}
