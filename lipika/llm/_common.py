"""Shared pieces of the training-data operators: stored intermediates and connected components.

Intermediates are Parquet tables in the folder that the session names in
``spark.checkpoint.dir``; every executor can read them again after another one is lost.
Where the setting is absent, a private folder is used on one machine, and a cluster is refused.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch that hold whole texts; keeps a Python worker's memory bounded.
TEXT_BATCH_ROWS = 1000
TEXT_BATCH_BYTES = 16 << 20

_private: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder for stored intermediates: ``spark.checkpoint.dir``, or with a local master a private one where unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _private:
        _private.append(tempfile.mkdtemp(prefix="lipika-"))
        atexit.register(shutil.rmtree, _private[0], ignore_errors=True)
    return f"file://{_private[0]}"


def removed_at_exit(spark: SparkSession, path: str) -> None:
    """Has the session's JVM remove a path of the shared folder when it ends."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)


def stored(df: DataFrame, name: str, compression: str = "snappy", **options: str) -> DataFrame:
    """Writes ``df`` once as Parquet in the shared folder and returns the table read back.

    This cuts the lineage: what follows never repeats what came before, also when executors go.
    The table is removed when the session's JVM ends.
    """
    return _stored(df, name, compression, **options)[0]


def _stored(df: DataFrame, name: str, compression: str = "snappy", **options: str) -> tuple[DataFrame, str]:
    """A stored table and its path."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path, compression=compression)
    removed_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path), path


def few(df: DataFrame, rows: int = 1 << 20) -> DataFrame:
    """``df``, a stored table of narrow rows, to be broadcast if it is counted to have no more than so many; else Spark chooses the join."""
    return F.broadcast(df) if df.count() <= rows else df


def small_batches(spark: SparkSession) -> None:
    """Sends texts to Python in small Arrow batches, unless the session has chosen a size itself."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(TEXT_BATCH_ROWS))
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(TEXT_BATCH_BYTES))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def columns_of(df: DataFrame) -> list[Column]:
    """The columns of ``df``, also those whose names hold dots or back quotes."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row, however often the body uses it and wherever a filter is pushed."""
    return F.element_at(F.transform(F.array(value), body), 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star rounds.

    ``edges`` holds two long columns; nulls and loops are ignored, repeated edges do no harm.
    Returns ``(id, component)`` for every id that occurs in an edge with another id; the
    component is its smallest id. Each round is one partial aggregation and one join on
    the vertex, so a vertex with very many edges is no unbounded group; rounds grow with
    the logarithm of the longest chain; a round's table is removed after the next is written.
    An edge list without rows gives no rows.
    """
    spark = edges.sparkSession
    current, path = _stored(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u is not null and v is not null and u <> v").distinct(),
        "edges",
    )
    before = _digest(current)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u")
        small = small.select("u", F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        current, following = _stored(small.where("u <> v").distinct(), "edges")
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        path = following
        after = _digest(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    labels = current.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id")
    roots = current.select(F.col("v").alias("id")).distinct().join(labels.select("id"), "id", "left_anti").withColumn("component", F.col("id"))
    return labels.unionByName(roots)


def _digest(edges: DataFrame) -> tuple:
    """Row count and two order-free checksums of an edge list."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum(F.shiftrightunsigned(h, 24))).first())
