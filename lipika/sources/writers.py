"""Sinks: texts, lists, manifests and histories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lipika.functions.text import box_lines
from lipika.operators.ordering import keep_first


def write_lines(rows: DataFrame, path: str, mode: str = "overwrite", pos: str = "pos", line: str = "line") -> None:
    """Lines in order: files by range of position, sorted within, so reading them by name keeps the order."""
    rows.repartitionByRange(pos).sortWithinPartitions(pos).select(line).write.mode(mode).text(path)


def new_lines(rows: DataFrame, present: DataFrame, line: str = "line") -> DataFrame:
    """Lines that aren't there yet; whole lines are compared, not parts of them."""
    return rows.join(present.select(line), line, "left_anti")


def merge_lines(present: DataFrame, added: DataFrame, line: str = "line", pos: str = "pos") -> DataFrame:
    """Both, each line once at its first place; what was there comes first."""
    last = present.agg(F.coalesce(F.max(pos), F.lit(-1)).alias("ml_last"))
    moved = added.crossJoin(F.broadcast(last)).select(line, (F.col(pos) + F.col("ml_last") + 1).alias(pos))
    return keep_first(present.select(line, pos).unionByName(moved), line, pos)


def write_split(rows: DataFrame, path: str, split: str = "split") -> None:
    """One folder of paths for each side of a split."""
    rows.write.mode("overwrite").partitionBy(split).text(path) if len(rows.columns) == 2 else rows.write.mode("overwrite").partitionBy(split).parquet(path)


def write_manifest(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def append_history(run: DataFrame, path: str) -> None:
    """One more run, as a JSON line."""
    run.write.mode("append").json(path)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def box_files(rows: DataFrame, text: str = "gt", width: str = "w", height: str = "h") -> DataFrame:
    """``stem, n, line``: the box-file lines of every sample."""
    return rows.select("stem", F.posexplode(box_lines(F.col(text), F.col(width), F.col(height))).alias("n", "line"))


def registry_insert(present: DataFrame, entry: DataFrame) -> DataFrame:
    """The registry with one more entry. Raises if the id is taken or not of ``a-z0-9_``."""
    bad = entry.where(~F.col("id").rlike("^[a-z0-9_]+$")).limit(1).count() + entry.join(present.select("id"), "id", "left_semi").limit(1).count()
    if bad:
        raise ValueError("the id is malformed or taken")
    last = present.agg(F.coalesce(F.max("pos"), F.lit(-1)).alias("ri_last"))
    return present.unionByName(entry.drop("pos").crossJoin(F.broadcast(last)).withColumn("pos", F.col("ri_last") + 1).drop("ri_last").select(*present.columns))


def registry_delete(present: DataFrame, id_: str) -> tuple[DataFrame, DataFrame]:
    """The registry without an entry, and the entry, with which the deletion can be undone."""
    return present.where(F.col("id") != id_), present.where(F.col("id") == id_)
