"""Mixing sources to target weights.

Every document gets a hash-random key, of its id and its text, so rows that share an id spread
too. Keys are uniform, so cutting the key space into ranges is a range sort whose pieces are
equally large within any source, a hot one too; more rows, more ranges. Token counts are summed
per range, prefix sums run over the ranges of a source, and only then over the documents inside
one range; each source is cut at its exact budget.
A budget above the source's size repeats whole epochs first.

Everything is built-in DataFrame code. The largest sort in one task is one range of one source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lipika.llm._common import columns_of, few, fresh, stored, table

#: Rows of one range of the key space, about; ranges are hexadecimal digits of the key. The result doesn't depend on it.
RANGE_ROWS = 50_000
SEED = "mix-1"
MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of maximal runs of anything but ASCII white space; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Budget of every source: ``sizes`` has one row ``(source, source_size)`` for each.

    Sources by code point, null last, weigh 1, 2, 3, repeating. A target stops at
    ``max_epochs`` times the source's size; the excess goes to the others by weight until
    none is above. Sources that stop are those with the least limit per weight, so one
    ordered pass finds them: a source stops if its share of what the earlier ones leave
    exceeds its limit. Sums are integers and one division makes the target.
    """
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("nth") % len(weights)).cast("int") + 1).cast("long")
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("nth", F.row_number().over(by_name) - 1).withColumn("weight", w).withColumn("cap", F.col("source_size") * max_epochs)
    order = W.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("nth").asc())
    everything = W.partitionBy()
    shares = (
        ranked.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("cap_before", F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("cap"))
        .withColumn("weight_before", F.sum("weight").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("weight"))
        .withColumn("stops", (F.col("total") - F.col("cap_before")) * F.col("weight") >= F.col("cap") * (F.col("all_weight") - F.col("weight_before")))
    )
    left = F.col("total") - F.coalesce(F.sum(F.when(F.col("stops"), F.col("cap"))).over(everything), F.lit(0))
    open_weight = F.sum(F.when(~F.col("stops"), F.col("weight"))).over(everything)
    return shares.select(
        "source",
        "source_size",
        "weight",
        F.when(F.col("stops"), F.col("cap").cast("double")).otherwise((left * F.col("weight")).cast("double") / open_weight).alias("target"),
    )


def row_key(seed: str) -> Column:
    """The hash-random key of a row, by its doc_id and text."""
    return F.md5(F.concat_ws("/", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))))


def mix(docs: DataFrame, size: Column, seed: str = SEED, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``size``, ``source_size``, ``target`` and ``taken`` to ``doc_id``, ``source`` and ``key`` of every row.

    ``taken`` is the number of words the mix takes of the document, repeats counted: whole
    epochs, plus, in key order, what still fits the budget; the last document is cut at a
    word, so a source's sum is its target rounded down. Ties of the key are equal rows: they are
    ordered by doc_id and size, and then by their place in the task; a row without text
    has size 0 and takes 0; null doc_ids and null sources are kept (null is a source of its
    own, the last). An empty table gives no rows. Of ``docs``, doc_id, source, text and what
    ``size`` needs are read, in one scan; keys and sizes are stored.
    """
    rows = stored(docs.select("doc_id", "source", size.alias("size"), row_key(seed).alias("key")), "mix")
    digits = max(1, math.ceil(math.log(max(rows.count(), 1) / RANGE_ROWS, 16)))
    rows = rows.withColumn("piece", F.substring("key", 1, min(digits, 32)))
    pieces = rows.groupBy("source", "piece").agg(F.sum("size").alias("piece_size"))
    targets = source_targets(pieces.groupBy("source").agg(F.sum("piece_size").alias("source_size")), weights, max_epochs)
    before = W.partitionBy("source").orderBy("piece").rowsBetween(W.unboundedPreceding, W.currentRow)
    offsets = (
        pieces.withColumn("before", F.sum("piece_size").over(before) - F.col("piece_size"))
        .withColumnRenamed("source", "s")
        .join(targets, F.col("s").eqNullSafe(F.col("source")))
        .select("s", F.col("piece").alias("p"), "before", "source_size", "target")
    )
    inside = W.partitionBy("source", "piece").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = rows.withColumn("within", F.sum("size").over(inside) - F.col("size")).join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("piece") == F.col("p")))
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = budget - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before") - F.col("within")))
    return placed.select("doc_id", "source", "key", "size", "source_size", "target", (epochs * F.col("size") + part).cast("long").alias("taken"))


def source_cuts(taken: DataFrame) -> DataFrame:
    """Where the mix cuts each source, one row for each: ``source, epochs, cut, n_full, rest``.

    Rows of a smaller key than ``cut`` give one epoch more than ``epochs``; of the equal rows at
    the cut ``n_full`` do, and one gives ``rest`` words; without a ``cut`` none does.
    """
    epochs = F.when(F.col("source_size") > 0, F.floor(F.floor("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int")
    rows = taken.withColumn("epochs", epochs).withColumn("part", F.col("taken") - F.col("epochs") * F.col("size"))
    whole, part = F.col("part") == F.col("size"), F.col("part")
    by_key = rows.where(part > 0).groupBy("source", "key").agg(F.count_if(whole).alias("n_full"), F.coalesce(F.max(F.when(~whole, part)), F.lit(0)).alias("rest"))
    last = by_key.groupBy(F.col("source").alias("s")).agg(F.max(F.struct("key", "n_full", "rest")).alias("last"))
    sources = rows.groupBy("source").agg(F.max("epochs").alias("epochs"))
    return sources.join(last, F.col("source").eqNullSafe(F.col("s")), "left").select("source", "epochs", F.col("last.key").alias("cut"), F.col("last.n_full").alias("n_full"), F.col("last.rest").cast("int").alias("rest"))


def mixed_documents(docs: DataFrame, seed: str = SEED, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix as rows with the columns of ``docs``: a document is repeated for every epoch that takes it.

    Texts come whole, but for each source's one document at the cut, of which the words up to
    the budget come (white space between them unchanged) and ``n_chars`` follows. Documents
    of which nothing is taken, also those without words, don't come. A row's key says on which
    side of its source's cut it is, so no text is shuffled but of the equal rows right at a cut.
    """
    own_source, epochs, at, n_full, rest, key, nth, cut = fresh(docs, "mix_source", "mix_epochs", "mix_at", "mix_full", "mix_rest", "mix_key", "mix_nth", "mix_cut")
    cuts = stored(source_cuts(mix(docs, word_count(F.col("text")), seed, weights, max_epochs)).toDF(own_source, epochs, at, n_full, rest), "cuts")
    rows = docs.where(F.col("text").rlike(WORD)).withColumn(key, row_key(seed)).join(few(cuts), F.col("source").eqNullSafe(F.col(own_source)))
    here = F.coalesce(F.col(key) == F.col(at), F.lit(False))
    more = lambda whole: F.array_repeat(F.lit(0), F.col(epochs) + F.coalesce(whole, F.lit(False)).cast("int"))
    beside = rows.where(~here).withColumn(cut, F.explode(more(F.col(key) < F.col(at))))
    equal = rows.where(here).withColumn(nth, F.row_number().over(W.partitionBy(own_source, key).orderBy(F.lit(1))))
    partly = (F.col(nth) == F.col(n_full) + 1) & (F.col(rest) > 0)
    lengths = F.concat(more(F.col(nth) <= F.col(n_full)), F.when(partly, F.array(F.col(rest))).otherwise(F.array().cast("array<int>")))
    rows = beside.unionByName(equal.withColumn(cut, F.explode(lengths)).drop(nth))
    begin = F.regexp_replace("text", r"^[\x20\x09-\x0D]+", "")
    words = F.slice(F.split(begin, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])"), 1, F.greatest(F.col(cut), F.lit(1)))
    text = F.when(F.col(cut) == 0, F.col("text")).otherwise(F.regexp_replace(F.array_join(words, ""), r"[\x20\x09-\x0D]+$", ""))
    rows = rows.withColumn("text", text)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col(cut) == 0, F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return rows.select(*columns_of(docs))


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, mixed by the weights 1, 2, 3."""
    docs = table(spark, sf_dir, "documents")
    return mix(docs, word_count(F.col("text"))).drop("source", "key")


OP10_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('{SEED}/' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '/' || md5(coalesce(text, ''))) AS key
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS nth FROM d GROUP BY source),
w AS (SELECT source, source_size, nth, CAST(nth % 3 + 1 AS BIGINT) AS weight, source_size * 3 AS cap FROM s),
f AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total, CAST(sum(weight) OVER () AS BIGINT) AS all_weight,
    CAST(sum(cap) OVER o AS BIGINT) - cap AS cap_before, CAST(sum(weight) OVER o AS BIGINT) - weight AS weight_before
  FROM w WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / weight, nth ROWS UNBOUNDED PRECEDING)),
g AS (SELECT *, (total - cap_before) * weight >= cap * (all_weight - weight_before) AS stops FROM f),
t AS (
  SELECT source, source_size, CASE WHEN stops THEN CAST(cap AS DOUBLE) ELSE
    CAST((total - coalesce(CAST(sum(CASE WHEN stops THEN cap END) OVER () AS BIGINT), 0)) * weight AS DOUBLE) / CAST(sum(CASE WHEN NOT stops THEN weight END) OVER () AS BIGINT) END AS target
  FROM g),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
    CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size + greatest(0, least(size, budget % source_size - before)) END AS BIGINT) AS taken
FROM p
"""

QUERIES = {"op10_mix": op10_mix}
ORACLES = {"op10_mix": OP10_SQL}
