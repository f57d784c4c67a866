"""Operators in which the order of rows matters. The order is always a column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows of one piece of a global order, about.
PIECE_ROWS = 200_000


def positions(docs: DataFrame, lines: Column, key: str = "doc_id") -> DataFrame:
    """One row for each line of each row: adds ``pos``, a struct ``(doc_id, line_no)`` that sorts, and ``line``."""
    rows = docs.select("*", F.posexplode(lines).alias("line_no", "line"))
    return rows.withColumn("pos", F.struct(F.col(key).alias("doc_id"), F.col("line_no").cast("long").alias("line_no"))).drop("line_no")


def keep_first(rows: DataFrame, value: str = "line", pos: str = "pos") -> DataFrame:
    """Distinct values with their first position: a partial aggregation, no sort."""
    return rows.groupBy(value).agg(F.min(pos).alias(pos))


def _pieces(rows: int) -> int:
    return max(1, min(4096, -(-rows // PIECE_ROWS)))


def global_rank(rows: DataFrame, by: str, name: str = "rank", pieces: int | None = None) -> DataFrame:
    """The place of every row in the order of the number ``by`` (from 0), without one task that sees all.

    Cut points of about equal shares split the order into pieces; counts of pieces are summed
    up to give each its beginning, and rows are numbered within their piece. Equal values are in one
    piece; ``by`` should be distinct for a fixed order. Nulls come first. Without ``pieces``, rows
    are counted and a piece has about ``PIECE_ROWS``.
    """
    pieces = pieces or _pieces(rows.count())
    cuts = rows.approxQuantile(by, [k / pieces for k in range(1, pieces)], 0.5 / pieces) if pieces > 1 else []
    cuts = sorted(set(cuts))
    piece = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c < F.col(by))) if cuts else F.lit(0)
    marked = rows.withColumn("gr_piece", piece)
    starts = marked.groupBy("gr_piece").count()
    starts = starts.select("gr_piece", (F.sum("count").over(W.orderBy("gr_piece")) - F.col("count")).alias("gr_start"))
    inside = F.row_number().over(W.partitionBy("gr_piece").orderBy(by)) - 1
    # at most `pieces` rows
    return marked.join(F.broadcast(starts), "gr_piece").withColumn(name, F.col("gr_start") + inside).drop("gr_piece", "gr_start")


def systematic_sample(rows: DataFrame, by: str, n: int) -> DataFrame:
    """Every ``floor(N / n)``-th row in the order of ``by``, at most ``n`` (a sampling operator)."""
    total = rows.count()
    step = max(1, total // n)
    ranked = global_rank(rows, by, "ss_rank", _pieces(total))
    return ranked.where((F.col("ss_rank") % step == 0) & (F.col("ss_rank") < n * step)).drop("ss_rank")


def even_picks(rows: DataFrame, by: str, n: int) -> DataFrame:
    """``n`` rows spread evenly over the order of ``by``, both ends included; all rows if there are no more."""
    total = rows.count()
    if total <= n:
        return rows
    wanted = sorted({i * (total - 1) // (n - 1) for i in range(n)}) if n > 1 else [0]
    return global_rank(rows, by, "ep_rank", _pieces(total)).where(F.col("ep_rank").isin(wanted)).drop("ep_rank")


def middle_per_group(rows: DataFrame, group: str, by: str, pieces: int | None = None) -> DataFrame:
    """The middle row of each group: number ``floor(count / 2)`` from 0, in the order of the number ``by``.

    Rows are counted by group and piece of the order; only the piece that holds a group's middle is
    numbered, so a group that has most rows is no task's whole work. Null groups have no middle.
    """
    pieces = pieces or _pieces(rows.count())
    cuts = sorted(set(rows.approxQuantile(by, [k / pieces for k in range(1, pieces)], 0.5 / pieces))) if pieces > 1 else []
    piece = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c < F.col(by))) if cuts else F.lit(0)
    marked = rows.withColumn("mg_piece", piece)
    counts = marked.groupBy(F.col(group).alias("mg_group"), F.col("mg_piece").alias("mg_at")).agg(F.count("*").alias("mg_n"))
    w = W.partitionBy("mg_group")
    counts = counts.withColumn("mg_before", F.sum("mg_n").over(w.orderBy("mg_at").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("mg_n")).withColumn("mg_nth", F.floor(F.sum("mg_n").over(w) / 2) - F.col("mg_before"))
    held = counts.where((F.col("mg_nth") >= 0) & (F.col("mg_nth") < F.col("mg_n"))).select("mg_group", "mg_at", "mg_nth")
    near = marked.join(held, (F.col(group) == F.col("mg_group")) & (F.col("mg_piece") == F.col("mg_at")))
    ranked = near.withColumn("mg_rank", F.row_number().over(W.partitionBy(group).orderBy(by)) - 1)
    return ranked.where("mg_rank = mg_nth").select(*rows.columns)


def head_per_group(rows: DataFrame, groups: list[str], by: str, per_group: int, most_groups: int | None = None) -> DataFrame:
    """The first rows of each group; with ``most_groups``, of the first groups of each outer group only."""
    out = rows
    if most_groups is not None:
        inner = W.partitionBy(*groups[:-1]) if len(groups) > 1 else W.partitionBy()
        firsts = rows.select(*groups).distinct().withColumn("hg_group", F.row_number().over(inner.orderBy(groups[-1]))).where(F.col("hg_group") <= most_groups)
        out = rows.join(firsts.drop("hg_group"), groups)
    return out.withColumn("hg_rank", F.row_number().over(W.partitionBy(*groups).orderBy(by))).where(F.col("hg_rank") <= per_group).drop("hg_rank")


def last_lines(rows: DataFrame, n: int, pos: str = "pos") -> DataFrame:
    """The last ``n`` rows by position, and the total: a distributed top-n."""
    total = rows.agg(F.count("*").alias("total"))
    return rows.orderBy(F.col(pos).desc()).limit(n).join(F.broadcast(total))


def hash_rank(seed: str, *key: str) -> Column:
    """A reproducible random key, the same in every engine."""
    return F.md5(F.concat_ws("/", F.lit(seed), *[F.col(k).cast("string") for k in key]))


def hash_sample(rows: DataFrame, seed: str, key: str, n: int) -> DataFrame:
    """``n`` rows by hash rank (a seeded shuffle and its head)."""
    return rows.orderBy(hash_rank(seed, key), key).limit(n)


def last_per_key(rows: DataFrame, key: str, value: str, pos: str) -> DataFrame:
    """The value at the last position of each key."""
    return rows.groupBy(key).agg(F.max_by(value, pos).alias(value))


def reading_order(boxes: DataFrame, page: str = "page") -> DataFrame:
    """Numbers a page's boxes from 0 by block, paragraph and line."""
    return boxes.withColumn("n", F.row_number().over(W.partitionBy(page).orderBy("block", "par", "line")) - 1)
