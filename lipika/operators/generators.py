"""Coverage text made from a script's ranges: grids, inventories and packed word lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lipika.functions.text import VIRAMA
from lipika.operators.ordering import global_rank


def code_points(spark: SparkSession, first: int, last: int, assigned: bool = True) -> DataFrame:
    """``cp, ch`` of a range of code points, unassigned ones left out."""
    rows = spark.range(first, last + 1).select(F.col("id").cast("int").alias("cp"))
    rows = rows.withColumn("ch", F.decode(F.unhex(F.lpad(F.hex("cp"), 8, "0")), "UTF-32"))
    return rows.where(~F.col("ch").rlike(r"\p{Cn}")) if assigned else rows


def grid(rows: DataFrame, columns: DataFrame, joint: str = "") -> DataFrame:
    """Every row character with every column character, in order: both sides are alphabets."""
    a = rows.select(F.col("cp").alias("a"), F.col("ch").alias("x"))
    b = columns.select(F.col("cp").alias("b"), F.col("ch").alias("y"))
    return a.crossJoin(F.broadcast(b)).select("a", "b", F.concat("x", F.lit(joint), "y").alias("text"))


def conjuncts(consonants: DataFrame) -> DataFrame:
    """Every two consonants with a virama between."""
    return grid(consonants, consonants, VIRAMA)


def labelled(units: DataFrame) -> DataFrame:
    """Units with an id of their code points."""
    label = F.array_join(F.transform(F.filter(F.split("text", ""), lambda c: c != ""), lambda c: F.lpad(F.hex(F.ascii(c)), 4, "0")), "_")
    return units.withColumn("id", F.concat(F.lit("char_"), label))


def inventory(spark: SparkSession, vowels: tuple[int, int], consonants: tuple[int, int], signs: tuple[int, int], digits: tuple[int, int], extra: Sequence[str] = ()) -> DataFrame:
    """All units of a script: vowels, consonants, consonants with signs, conjuncts, half forms, digits, and what else is given."""
    v, c, s, d = (code_points(spark, *r) for r in (vowels, consonants, signs, digits))
    single = lambda rows, kind: rows.select(F.lit(kind).alias("kind"), F.col("ch").alias("text"))
    parts = [
        single(v, "vowel"), single(c, "consonant"), grid(c, s).select(F.lit("syllable").alias("kind"), "text"), conjuncts(c).select(F.lit("conjunct").alias("kind"), "text"),
        c.select(F.lit("half").alias("kind"), F.concat("ch", F.lit(VIRAMA)).alias("text")), single(d, "digit"),
    ]
    if extra:
        parts.append(spark.createDataFrame([("extra", x) for x in extra], "kind string, text string"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return labelled(out)


def packed_lines(words: DataFrame, pos: str = "pos", word: str = "word", per_line: int = 12, bare: str = "ಾ-್", carrier: str = "◌") -> DataFrame:
    """``line_no, line``: words in order, so many to a line; a bare combining sign gets a carrier."""
    shown = F.when(F.col(word).rlike(f"^[{bare}]"), F.concat(F.lit(carrier), F.col(word))).otherwise(F.col(word))
    numbered = global_rank(words.select(F.col(pos).alias("p"), shown.alias("w")), "p", "n")
    lines = numbered.groupBy(F.floor(F.col("n") / per_line).alias("line_no")).agg(F.array_sort(F.collect_list(F.struct("n", "w"))).alias("ws"))
    return lines.select("line_no", F.array_join(F.col("ws.w"), " ").alias("line"))


def render_jobs(styles: DataFrame, titles: DataFrame) -> DataFrame:
    """One job for each style, title and page (``titles.pages`` is an array), numbered."""
    each = titles.select("title", F.posexplode("pages").alias("page_no", "text"))
    return each.crossJoin(F.broadcast(styles.select("style")))
