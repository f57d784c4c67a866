"""Sources: texts, wiki dumps, layouts, registries, checkpoints, logs and histories as tables."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lipika.functions.profiles import ScriptProfile
from lipika.functions.text import SPACE, strip, text_lines, wikitext_sentences


def text_files(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """``file, modified, size, text`` of whole files, folders included."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("modified"), F.col("_metadata.file_size").alias("size"), F.col("value").alias("text"))


def file_lines(files: DataFrame) -> DataFrame:
    """``file, pos, line`` of ``text_files``."""
    return files.select("file", F.posexplode(text_lines(F.col("text"))).alias("pos", "line"))


def line_counts(files: DataFrame) -> DataFrame:
    """Lines that aren't empty, and lines that aren't blank, of each file."""
    lines = F.split("text", "\n", -1)
    count = lambda keep: F.size(F.filter(lines, keep)).cast("long")
    return files.select("file", count(lambda x: x != "").alias("n_nonempty"), count(lambda x: strip(x) != "").alias("n_nonblank"))


def source_status(files: DataFrame, expected: Sequence[str]) -> DataFrame:
    """For each expected file name whether it is there, with size, time and lines."""
    spark = files.sparkSession
    names = spark.createDataFrame([(x,) for x in expected], "name string")
    have = files.withColumn("name", F.element_at(F.split("file", "/"), -1)).join(line_counts(files), "file")
    return names.join(have, "name", "left").select("name", F.col("file").isNotNull().alias("cached"), "size", "modified", F.col("n_nonblank").alias("lines"))


def wiki_pages(spark: SparkSession, path: str) -> DataFrame:
    """``ns, title, text`` of a MediaWiki dump, packed or not."""
    schema = "ns INT, title STRING, revision STRUCT<text: STRING>"
    pages = spark.read.format("xml").option("rowTag", "page").schema(schema).load(path)
    return pages.select("ns", "title", F.col("revision.text").alias("text"))


def wiki_lines(pages: DataFrame, profile: ScriptProfile, namespaces: Sequence[int] = (104,), most: int | None = None) -> DataFrame:
    """Clean sentences of the pages of some namespaces, in order of title; at most ``most`` (a limit of the source)."""
    rows = pages.where(F.col("ns").isin(list(namespaces))).select("title", F.posexplode(wikitext_sentences(F.col("text"), profile)).alias("n", "line"))
    return rows if most is None else rows.orderBy("title", "n").limit(most)


def quality_pages(pages: DataFrame, least: int, most: int) -> DataFrame:
    """Pages proofread to some level, by title, at most ``most`` (a limit of the source)."""
    return pages.where(F.col("quality") >= least).orderBy("title").limit(most)


def first_of_title(files: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    """The first text file, by path, of each folder; the folder is the title."""
    rows = files.withColumn("title", F.element_at(F.split("file", "/"), -2))
    if only is not None:
        rows = rows.where(F.col("title").isin(list(only)))
    first = F.row_number().over(W.partitionBy("title").orderBy("file"))
    return rows.withColumn("nth", first).where("nth = 1").drop("nth")


def unit_table(lines: DataFrame) -> DataFrame:
    """Units of a dictionary file: the first word of each line after the count (``pos`` 0)."""
    return lines.where("pos > 0").select(F.get(F.split("line", " "), 0).alias("unit")).where("unit <> ''").distinct()


def layout_words(lines: DataFrame) -> DataFrame:
    """Lines (level 4) of a layout in tab-separated columns; rows that don't parse are skipped."""
    names = ["level", "page_num", "block", "par", "line_num", "word_num", "x", "y", "w", "h", "conf", "text"]
    parts = F.split("line", "\t", -1)
    rows = lines.select("page", *[F.try_element_at(parts, F.lit(i + 1)).alias(n) for i, n in enumerate(names)])
    number = lambda n: F.expr(f"try_cast({n} AS INT)").alias(n if n != "line_num" else "line")
    rows = rows.select("page", *[number(n) for n in ("level", "block", "par", "line_num", "x", "y", "w", "h")])
    return rows.where("level = 4").dropna().drop("level")


def word_confidence(lines: DataFrame) -> DataFrame:
    """Mean confidence of each page's words: 0 without words, null where the rows aren't a layout."""
    parts = F.split("line", "\t", -1)
    conf, text = F.expr("try_cast(try_element_at(split(line, '\\t', -1), 11) AS DOUBLE)"), F.try_element_at(parts, F.lit(12))
    good = (F.size(parts) >= 12) & (conf >= 0) & (strip(text) != "")
    tabular = F.max(F.size(parts) >= 12)
    return lines.groupBy("page").agg(F.when(tabular, F.coalesce(F.avg(F.when(good, conf)), F.lit(0.0))).alias("confidence"))


REGISTRY = T.StructType(
    [
        T.StructField("pos", T.LongType()), T.StructField("id", T.StringType()), T.StructField("name", T.StringType()), T.StructField("description", T.StringType()), T.StructField("repo", T.StringType()),
        T.StructField("font_dir", T.StringType()), T.StructField("font_files", T.ArrayType(T.StringType())), T.StructField("degrade", T.BooleanType()), T.StructField("max_pages", T.IntegerType()), T.StructField("font_features", T.StringType()),
    ]
)


def registry(spark: SparkSession, entries: Sequence[dict]) -> DataFrame:
    """A registry as a table, in its order. Entries are what a YAML reader gives; there is no YAML source."""
    return spark.createDataFrame([tuple(i if f.name == "pos" else e.get(f.name) for f in REGISTRY) for i, e in enumerate(entries)], REGISTRY)


def yaml_registry(spark: SparkSession, path: str, key: str = "fonts") -> DataFrame:
    """The registry of a YAML file, which is small and read on the driver; needs PyYAML."""
    try:
        import yaml
    except ImportError as missing:
        raise RuntimeError("reading YAML needs the yaml package") from missing
    return registry(spark, yaml.safe_load(Path(path).read_text(encoding="utf-8"))[key])


def checkpoint_files(files: DataFrame, prefix: str) -> DataFrame:
    """``file, bcer, samples, iter`` of names ``<prefix>_<error>_<samples>_<iteration>.checkpoint``; others are none."""
    pattern = rf"^{prefix}_([\d.]+)_(\d+)_(\d+)\.checkpoint$"
    name = F.element_at(F.split("file", "/"), -1)
    part = lambda n, kind: F.regexp_extract(name, pattern, n).cast(kind)
    rest = [c for c in files.columns if c != "file"]
    return files.where(name.rlike(pattern)).select("file", part(1, "double").alias("bcer"), part(2, "long").alias("samples"), part(3, "long").alias("iter"), *rest)


PROGRESS = r"At iteration ([0-9]+)/([0-9]+)/[0-9]+.*?BCER train=([0-9.]+)%"


def training_progress(line: Column) -> Column:
    """``(iter, samples, bcer)`` of a log line that reports progress, else null."""
    part = lambda n, kind: F.regexp_extract(line, PROGRESS, n).cast(kind)
    return F.when(line.rlike(PROGRESS), F.struct(part(1, "long").alias("iter"), part(2, "long").alias("samples"), part(3, "double").alias("bcer")))


def progress_or_log(checkpoints: DataFrame, log: DataFrame) -> DataFrame:
    """Progress from checkpoints; where there are none, from the log's lines."""
    from_log = log.select(training_progress(F.col("line")).alias("p")).where("p is not null").select("p.iter", "p.bcer")
    any_file = checkpoints.limit(1).select(F.lit(1).alias("any_file"))
    return checkpoints.select("iter", "bcer").unionByName(from_log.join(F.broadcast(any_file), F.lit(True), "left_anti"))


def font_variants(files: DataFrame) -> DataFrame:
    """Variants of a folder's fonts: ``<stem>-ttf`` and ``-otf`` where a stem has both, else the stem."""
    name = F.element_at(F.split("file", "/"), -1)
    rows = files.select(F.regexp_extract(name, r"^(.*)\.([A-Za-z]+)$", 1).alias("stem"), F.lower(F.regexp_extract(name, r"\.([A-Za-z]+)$", 1)).alias("format"), "file")
    rows = rows.where(F.col("format").isin("ttf", "otf") & ~F.col("stem").rlike(r"(?i)variable|\[")).groupBy("stem", "format").agg(F.min("file").alias("file"))
    both = F.count("*").over(W.partitionBy("stem")) > 1
    return rows.withColumn("variant", F.when(both, F.concat_ws("-", "stem", "format")).otherwise(F.col("stem"))).select("variant", "stem", "format", "file")


HISTORY = "ts TIMESTAMP, label STRING, overall INT, byCategory MAP<STRING, INT>, correct INT, total INT"


def run_history(spark: SparkSession, path: str) -> DataFrame:
    """Saved runs, one JSON array a file or one object a line."""
    return spark.read.schema(HISTORY).json(path, multiLine=True)


def category_rows(history: DataFrame) -> DataFrame:
    """Long form of a history: one row for each run and category."""
    return history.select("ts", "label", F.explode("byCategory").alias("category", "percent"))


def category_accuracy(rows: DataFrame) -> DataFrame:
    """Per cent right for each category."""
    return rows.groupBy("category").agg(F.round(F.avg(F.col("ok").cast("int")) * 100).cast("int").alias("percent"), F.count("*").alias("n"))


def pair_listing(spark: SparkSession, path: str, extensions: Sequence[str] = ("png", "tif", "jpg")) -> DataFrame:
    """``stem, image, truth``: images by the first extension that exists, with their text beside them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    stem = F.regexp_replace("path", r"(\.gt)?\.[A-Za-z]+$", "")
    rank = F.array_position(F.array(*[F.lit(e) for e in extensions]), F.lower(F.element_at(F.split("path", r"\."), -1)))
    images = files.withColumn("stem", stem).withColumn("rank", rank).where("rank > 0").groupBy("stem").agg(F.min_by("path", "rank").alias("image"))
    truths = files.where(F.col("path").endswith(".gt.txt")).select(stem.alias("stem"), F.col("path").alias("truth"))
    return images.join(truths, "stem")


def image_geometry(images: DataFrame) -> DataFrame:
    """``stem, w, h, ink`` of images as rows of grey values (``pixels ARRAY<ARRAY<INT>>``).

    Decoding files needs an imaging package; here pixels come decoded.
    """
    flat = F.flatten("pixels")
    return images.select("stem", F.size(F.get("pixels", 0)).alias("w"), F.size("pixels").alias("h"), (F.size(F.filter(flat, lambda p: p < 128)) / F.nullif(F.size(flat), F.lit(0))).alias("ink"))


def blank(c: Column) -> Column:
    return F.regexp_replace(c, SPACE, "") == ""
