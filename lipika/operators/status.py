"""Status of a corpus project: counts by variant, readiness, footprints, run outcomes, and samples over models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lipika.functions.text import characters, code_point_label
from lipika.operators.ordering import hash_rank

#: Stands for a mean of nothing, so that it sorts last.
NO_ERROR_RATE = 999.0


def variant_counts(files: DataFrame, by: list[str], name: str, kinds: dict[str, str]) -> DataFrame:
    """Images of each variant by what their name begins with (``kinds``: column to beginning), and whether there are any."""
    counts = [F.count_if(F.col(name).startswith(prefix)).alias(kind) for kind, prefix in kinds.items()]
    return files.groupBy(*by).agg(*counts).withColumn("has_images", sum((F.col(k) for k in kinds), F.lit(0)) > 0)


def readiness(parts: DataFrame, part: str, n: str, needed: dict[str, int]) -> DataFrame:
    """One row: for each part whether its count reaches what is needed, the number of ready ones, and whether all are."""
    flags = [F.coalesce(F.max(F.when(F.col(part) == p, F.col(n))), F.lit(0)) >= least for p, least in needed.items()]
    ready = parts.agg(*[f.alias(f"{p}_ready") for f, p in zip(flags, needed, strict=True)])
    total = sum((F.col(f"{p}_ready").cast("int") for p in needed), F.lit(0))
    return ready.withColumn("n_ready", total.cast("long")).withColumn("all_ready", total == len(needed))


def footprint(files: DataFrame, owner: str, location: str, size: str) -> DataFrame:
    """Files and bytes of each owner by location, with a row for all locations (``*``)."""
    rows = files.rollup(owner, location).agg(F.count("*").alias("n_files"), F.sum(size).cast("long").alias("n_bytes"), F.grouping(owner).alias("fp_all"), F.grouping(location).alias("fp_total"))
    return rows.where("fp_all = 0").withColumn(location, F.when(F.col("fp_total") == 1, "*").otherwise(F.col(location))).drop("fp_all", "fp_total")


def outcome_tally(results: DataFrame, result: str) -> DataFrame:
    """One row ``ok, skip, fail, bail``: a run is given up where nothing but failures came of enough jobs (a twentieth, 20 to 200)."""
    counts = results.agg(F.count_if(F.col(result) == "ok").alias("ok"), F.count_if(F.col(result) == "skip").alias("skip"), F.count_if(~F.col(result).isin("ok", "skip")).alias("fail"))
    total = F.col("ok") + F.col("skip") + F.col("fail")
    enough = total >= F.least(F.greatest(F.round(total * 0.05), F.lit(20)), F.lit(200))
    return counts.withColumn("bail", enough & (F.col("ok") + F.col("skip") == 0) & (F.col("fail") > 0))


def top_errors(results: DataFrame, result: str, most: int = 5) -> DataFrame:
    """The most frequent messages of failures (``fail:<message>``), a report of ``most`` rows."""
    failed = results.where(~F.col(result).isin("ok", "skip"))
    message = F.regexp_replace(result, "^fail:", "")
    return failed.groupBy(message.alias("message")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "message").limit(most)


def sample_by_model(samples: DataFrame, models: DataFrame) -> DataFrame:
    """Every sample with every model. Models are a registry of a few rows, broadcast if Spark finds them small."""
    return samples.crossJoin(models)


def model_means(scores: DataFrame, model: str, rates: Sequence[str]) -> DataFrame:
    """Mean of each error rate over a model's samples, 0 without any."""
    return scores.groupBy(model).agg(F.count("*").alias("n"), *[F.round(F.coalesce(F.avg(r), F.lit(0.0)), 9).alias(f"mean_{r}") for r in rates])


def style_means(styles: DataFrame, scores: DataFrame, style: str, rate: str) -> DataFrame:
    """Mean rate of each style to one decimal, ``NO_ERROR_RATE`` where nothing was scored, and the mean of these means."""
    means = styles.select(style).join(scores.groupBy(style).agg(F.round(F.avg(rate), 1).alias("mean_rate")), style, "left").withColumn("mean_rate", F.coalesce("mean_rate", F.lit(NO_ERROR_RATE)))
    overall = means.agg(F.coalesce(F.round(F.avg("mean_rate"), 1), F.lit(NO_ERROR_RATE)).alias("overall"))
    return means.crossJoin(F.broadcast(overall))  # one row


def source_mix(rows: DataFrame, source: str, key: str, n: int, shares: dict[str, int], seed: str = "mix") -> DataFrame:
    """A sample of ``n`` rows over sources: so many of each (a sampling operator), by hash rank."""
    parts = [rows.where(F.col(source) == s).orderBy(hash_rank(seed, key), key).limit(most) for s, most in shares.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def review_shares(n: int, first: str, second: str, extra: str | None = None) -> dict[str, int]:
    """Two thirds and one third of ``n``, and at least five, or a quarter, of a further source."""
    return {first: n * 2 // 3, second: n // 3} | ({extra: max(5, n // 4)} if extra else {})


def last_wins(entries: DataFrame, found: DataFrame, key: str, order: str) -> DataFrame:
    """Entries with what was found last under their key; those without stay, with nulls."""
    others = [c for c in found.columns if c not in (key, order)]
    newest = found.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("lw_last"))
    return entries.join(newest, key, "left").select(*entries.columns, *[F.col(f"lw_last.{c}").alias(c) for c in others])


def merged_dictionary(*tables: DataFrame, word: str = "word") -> DataFrame:
    """The distinct words of all tables, with how many tables have each."""
    out = None
    for t in tables:
        rows = t.select(word).distinct()
        out = rows if out is None else out.unionByName(rows)
    return out.where(F.col(word).isNotNull()).groupBy(word).agg(F.count("*").alias("n_tables"))


def missing_characters(wanted: DataFrame, units: DataFrame, text: str, unit: str) -> DataFrame:
    """Wanted characters that no unit holds, with their code points."""
    each = lambda rows, c: rows.select(F.explode(F.array_distinct(characters(F.col(c)))).alias("ch")).distinct()
    return each(wanted, text).join(each(units, unit), "ch", "left_anti").select("ch", code_point_label(F.col("ch")).alias("code"))


def longest_unit(units: DataFrame, unit: str) -> DataFrame:
    """Length of the longest unit, 0 without any."""
    return units.agg(F.coalesce(F.max(F.length(unit)), F.lit(0)).alias("longest"))


def scan_guard(w: Column, h: Column, ink: Column) -> Column:
    """What is wrong with a line cut from a scan, else null: too low, too narrow, or blank."""
    return F.when(h < 16, "low").when(w < 40, "narrow").when(ink < 0.001, "blank")


def clonable(url: Column) -> Column:
    """Whether a URL is a repository that can be cloned: by its ending, its scheme or its host."""
    u = F.lower(F.coalesce(url, F.lit("")))
    return u.endswith(".git") | u.startswith("git@") | u.rlike(r"github\.com|gitlab\.com|bitbucket\.org|codeberg\.org")


def focused(paths: DataFrame, path: str, patterns: Sequence[str], always: str) -> DataFrame:
    """List entries that match one of some patterns, and those that contain ``always``."""
    return paths.where(F.col(path).rlike("|".join(patterns)) | F.col(path).contains(always))
