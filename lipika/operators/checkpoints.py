"""Choosing among checkpoints, and reading their course."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def best(rows: DataFrame, error: str, iteration: str, name: str) -> DataFrame:
    """The checkpoint of least error, the earliest on ties."""
    order = F.struct(F.col(error), F.col(iteration))
    return rows.agg(F.min_by(name, order).alias(name), F.min(error).alias(error))


def best_capped(rows: DataFrame, error: str, iteration: str, name: str, cap: int, fallback: str) -> DataFrame:
    """The best up to ``cap`` iterations, else up to twice as many, else the rolling checkpoint."""
    order = F.struct(F.col(error), F.col(iteration))
    tier = lambda most: F.min_by(F.when((F.col(iteration) > 0) & (F.col(iteration) <= most), F.col(name)), F.when((F.col(iteration) > 0) & (F.col(iteration) <= most), order))
    chosen = rows.agg(tier(cap).alias("a"), tier(2 * cap).alias("b"))
    used = F.when(F.col("a").isNotNull(), "cap").when(F.col("b").isNotNull(), "widened").otherwise("fallback")
    return chosen.select(F.coalesce("a", "b", F.lit(fallback)).alias(name), used.alias("tier"))


def course(rows: DataFrame, by: list[str], error: str, iteration: str) -> DataFrame:
    """Within each run: the best error so far, where it was new, and how long it has been standing."""
    w = W.partitionBy(*by).orderBy(iteration).rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = W.partitionBy(*by).orderBy(iteration).rowsBetween(W.unboundedPreceding, -1)
    new = F.coalesce(F.col(error) < F.min(error).over(earlier), F.lit(True))
    rows = rows.withColumn("best_so_far", F.min(error).over(w)).withColumn("is_new_best", new)
    return rows.withColumn("since_best", F.col(iteration) - F.max(F.when(F.col("is_new_best"), F.col(iteration))).over(w))


def plateau(rows: DataFrame, by: list[str], error: str, iteration: str, patience: int) -> DataFrame:
    """Runs whose last best has been standing for ``patience`` iterations or more at their end."""
    end = rows.groupBy(*by).agg(F.max(iteration).alias("last_iteration"), F.min(error).alias("best_error"), F.min_by(iteration, F.struct(F.col(error), F.col(iteration))).alias("best_iteration"))
    return end.withColumn("on_plateau", F.col("last_iteration") - F.col("best_iteration") >= patience)


def resume_choice(candidates: DataFrame, path: str, priority: str, exists: str) -> DataFrame:
    """The existing candidate of the best priority."""
    return candidates.where(F.col(exists)).agg(F.min_by(path, priority).alias(path))


def most_files(files: DataFrame, directory: str) -> DataFrame:
    """All directories with their counts; the largest (first by name on ties) is marked."""
    counts = files.groupBy(directory).agg(F.count("*").alias("n_files"))
    top = counts.agg(F.max_by(directory, F.struct(F.col("n_files"), -F.conv(F.substring(F.md5(directory), 1, 8), 16, 10).cast("long"))).alias("mf_top"), F.max("n_files").alias("mf_max"))
    firsts = counts.join(F.broadcast(top), counts.n_files == top.mf_max).agg(F.min(directory).alias("mf_first"))
    return counts.join(F.broadcast(firsts)).withColumn("is_largest", F.col(directory) == F.col("mf_first")).drop("mf_first")


def latest(files: DataFrame, path: str, modified: str) -> DataFrame:
    """The path modified last."""
    return files.agg(F.max_by(path, F.struct(F.col(modified), F.col(path))).alias(path))


def mean_or(value: str, default: float) -> Column:
    """A mean with a default for no rows."""
    return F.coalesce(F.avg(value), F.lit(default))
