"""Training and evaluation lists, held out by group within each kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lipika.operators.ordering import hash_rank

SEED = "20260805"
RATIO = 0.9


def group_of(path: Column) -> tuple[Column, Column]:
    """Kind and group of a list entry's path: what must not straddle the split."""
    tail = F.element_at(F.split(path, "/lstmf/"), -1)
    parts = F.split(tail, "/")
    kind, second, third = F.get(parts, 0), F.get(parts, 1), F.get(parts, 2)
    page = F.regexp_extract(third, r"^page\d+", 0)
    stem = F.regexp_replace(third, r"(?<=.)\.[^.]*$", "")
    group = (
        F.when((kind == "classical") & (F.size(parts) >= 3), F.concat(second, F.lit("/"), F.when(page != "", page).otherwise(third)))
        .when((kind == "inventory") & (F.size(parts) >= 3), F.concat(second, F.lit("/"), stem))
        .when(F.size(parts) >= 2, second)
        .otherwise(tail)
    )
    return kind, group


def bucket_of(path: Column, known: list[str]) -> Column:
    """The known bucket that a path names, else ``other``."""
    name = F.get(F.split(F.element_at(F.split(path, "/lstmf/"), -1), "/"), 0)
    return F.when(name.isin(known), name).otherwise("other")


def group_split(rows: DataFrame, kind: str = "kind", group: str = "group", ratio: float = RATIO, seed: str = SEED, never: tuple[str, ...] = ("scan",)) -> DataFrame:
    """Adds ``split``: within each kind, the groups of least hash rank are for evaluation.

    Of ``n`` groups ``max(1, round(n * (1 - ratio)))`` (halves to even) are held out, none of a kind with
    one group or of the kinds in ``never``. The rank depends on seed, kind and group alone. Groups are
    counted and ranked as distinct keys, so rows are joined, not sorted.
    """
    keys = rows.select(kind, group).distinct()
    w = W.partitionBy(kind)
    ranked = keys.withColumn("gs_n", F.count("*").over(w)).withColumn("gs_rank", F.row_number().over(w.orderBy(hash_rank(seed, kind, group), group)))
    held = F.when((F.col("gs_n") < 2) | F.col(kind).isin(list(never)), 0).otherwise(F.greatest(F.lit(1), F.bround(F.col("gs_n") * (1 - ratio)).cast("int")))
    return rows.join(ranked.select(kind, group, F.when(F.col("gs_rank") <= held, "eval").otherwise("train").alias("split")), [kind, group])


def split_summary(split: DataFrame, kind: str = "kind", group: str = "group") -> DataFrame:
    """Groups and rows on either side, for each kind and in all (kind ``TOTAL``)."""
    per_group = split.groupBy(kind, group, "split").agg(F.count("*").alias("n"))
    side = lambda s, v: F.coalesce(F.sum(F.when(F.col("split") == s, v)), F.lit(0)).cast("long")
    out = per_group.rollup(kind).agg(
        F.count("*").alias("n_groups"), side("train", F.lit(1)).alias("train_groups"), side("eval", F.lit(1)).alias("eval_groups"), side("train", F.col("n")).alias("train_rows"), side("eval", F.col("n")).alias("eval_rows")
    )
    return out.withColumn(kind, F.coalesce(kind, F.lit("TOTAL")))
