"""Pairing of samples with their ground truth, and the guards that pairs pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

STEP_HEIGHT = 48.0


def stem_pairs(samples: DataFrame, truths: DataFrame, key: str = "stem") -> DataFrame:
    """Samples that have a ground truth."""
    return samples.join(truths, key)


def without_truth(samples: DataFrame, truths: DataFrame, key: str = "stem") -> DataFrame:
    """Samples that have none."""
    return samples.join(truths.select(key), key, "left_anti")


def with_flag(rows: DataFrame, present: DataFrame, key: str, flag: str) -> DataFrame:
    """All rows, with whether the other table has their key."""
    have = present.select(key).distinct().withColumn("wf_have", F.lit(True))
    return rows.join(have, key, "left").withColumn(flag, F.coalesce("wf_have", F.lit(False))).drop("wf_have")


def not_superseded(pages: DataFrame, stem: str = "stem") -> DataFrame:
    """Without page samples of which line samples (``<page>_line<number>``) exist."""
    lines = pages.select(F.regexp_extract(stem, r"^(.+)_line\d+$", 1).alias("ns_page")).where("ns_page <> ''").distinct()
    return pages.join(lines, F.col(stem) == F.col("ns_page"), "left_anti")


def positional_zip(boxes: DataFrame, truth: DataFrame, page: str = "page", n: str = "n") -> tuple[DataFrame, DataFrame]:
    """Boxes with truth lines place by place, and the pages rejected because their counts differ."""
    counts = boxes.groupBy(page).agg(F.count("*").alias("n_boxes")).join(truth.groupBy(page).agg(F.count("*").alias("n_lines")), page, "full")
    counts = counts.na.fill(0, ["n_boxes", "n_lines"])
    good = counts.where("n_boxes = n_lines").select(page)
    return boxes.join(truth, [page, n]).join(good, page, "left_semi"), counts.where("n_boxes <> n_lines")


def prefix_semi(paths: DataFrame, path: str, prefixes: Sequence[str]) -> DataFrame:
    """Rows whose path begins with one of a registry's prefixes. The registry is small and becomes literals."""
    keep = F.lit(False)
    for p in prefixes:
        keep = keep | F.col(path).startswith(p)
    return paths.where(keep)


def prefix_first_match(path: str, prefixes: Sequence[str]) -> Column:
    """The first prefix of a registry, in its order, that a path begins with; else null."""
    return F.coalesce(*[F.when(F.col(path).startswith(p), p) for p in prefixes], F.lit(None).cast("string"))


def cross_cap(left: DataFrame, right: DataFrame, by: str, most: int) -> DataFrame:
    """Every left row with the first ``most`` right rows: the right side is bounded by ``most``."""
    return left.crossJoin(F.broadcast(right.orderBy(by).limit(most)))


def with_default(rows: DataFrame, lookup: DataFrame, key: str, value: str, default: object) -> DataFrame:
    """A lookup with a default."""
    return rows.join(lookup.select(key, value), key, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def declared_then_extra(declared: DataFrame, found: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """Declared rows in their order, present or not, and then what was found besides, by name."""
    have = with_flag(declared, found, key, "present").select(key, pos, "present")
    last = declared.agg(F.coalesce(F.max(pos), F.lit(-1)).alias("de_last"))
    extra = found.select(key).distinct().join(declared.select(key), key, "left_anti").crossJoin(F.broadcast(last))
    extra = extra.select(key, (F.col("de_last") + F.row_number().over(W.partitionBy("de_last").orderBy(key))).cast("long").alias(pos), F.lit(True).alias("present"))
    return have.select(key, F.col(pos).cast("long").alias(pos), "present").unionByName(extra)


def ctc_feasible(width: Column, height: Column, labels: Column) -> Column:
    """Whether a line image scaled to the network's height leaves a step for each label."""
    steps = F.when(height > 0, F.floor(width * (F.lit(STEP_HEIGHT) / height))).otherwise(0)
    return steps >= labels


def first_reason(guards: Sequence[tuple[Column, str]]) -> Column:
    """The reason of the first guard that fires, in order; null if none does."""
    return F.coalesce(*[F.when(bad, reason) for bad, reason in guards], F.lit(None).cast("string"))


def guard_tally(rows: DataFrame, reason: str, reasons: Sequence[str]) -> DataFrame:
    """Counts of all reasons, also of those that never fired, and the usable share in per cent."""
    counts = [F.count_if(F.col(reason) == r).alias(f"n_{r}") for r in reasons]
    usable = F.count_if(F.col(reason).isNull())
    return rows.agg(F.count("*").alias("n_rows"), *counts, usable.alias("n_usable"), F.round(usable * 100 / F.nullif(F.count("*"), F.lit(0)), 1).alias("usable_percent"))


def skip_gate(skipped: Column, total: Column, limit: float = 0.05) -> Column:
    """warn above the limit, else ok; nothing at all is empty."""
    return F.when(total == 0, "empty").when(skipped / total > limit, "warn").otherwise("ok")


def crop_box(x: Column, y: Column, w: Column, h: Column, page_w: Column, page_h: Column, pad: int) -> Column:
    """A box with a margin, within its page."""
    left, top = F.greatest(F.floor(x) - pad, F.lit(0)), F.greatest(F.floor(y) - pad, F.lit(0))
    right, bottom = F.least(F.ceil(x + w) + pad, page_w), F.least(F.ceil(y + h) + pad, page_h)
    return F.struct(left.alias("x"), top.alias("y"), (right - left).alias("w"), (bottom - top).alias("h"))


def cut_by_fold(wanted_h: Column, w: Column, h: Column) -> Column:
    """Crops that the page's end has cut too short."""
    return (h < 0.7 * wanted_h) | (h < 16) | (w < 8)


def rejects_per_page(rows: DataFrame, page: str, n: str, reason: str, text: str, clip: int = 60) -> DataFrame:
    """For each page how many rows passed, and the others as ``(n, why, snippet)`` in order."""
    one = F.when(F.col(reason).isNotNull(), F.struct(F.col(n).alias("n"), F.col(reason).alias("why"), F.substring(text, 1, clip).alias("snippet")))
    return rows.groupBy(page).agg(F.count_if(F.col(reason).isNull()).alias("kept"), F.array_sort(F.collect_list(one)).alias("rejected"))


def attested_minus(found: DataFrame, enumerated: DataFrame, key: str) -> DataFrame:
    """Distinct found values that the enumeration lacks."""
    return found.select(key).distinct().join(enumerated.select(key), key, "left_anti")


def attested_only(enumerated: DataFrame, found: DataFrame, key: str, bypass: Column) -> DataFrame:
    """Enumerated values that are attested, or that the bypass lets through."""
    have = found.select(key).distinct().withColumn("ao_have", F.lit(True))
    return enumerated.join(have, key, "left").where(F.col("ao_have") | bypass).drop("ao_have")


def new_and_known(words: DataFrame, known: DataFrame, key: str, pos: str) -> DataFrame:
    """Each word once, at its first position, with whether it is known already."""
    return with_flag(words.groupBy(key).agg(F.min(pos).alias(pos)), known, key, "known")


def first_existing(candidates: DataFrame, key: str, path: str, priority: str) -> DataFrame:
    """For each key the existing path of the best priority."""
    return candidates.groupBy(key).agg(F.min_by(path, priority).alias(path))


def exists_semi(listed: DataFrame, files: DataFrame, path: str) -> DataFrame:
    """Listed paths whose file is still there."""
    return listed.join(files.select(path), path, "left_semi")


def outcome_or_missing(checkpoints: DataFrame, scores: DataFrame, key: str, value: str, missing: str = "?") -> DataFrame:
    """All checkpoints with their score as text, or a mark where the evaluation failed."""
    return checkpoints.join(scores.select(key, value), key, "left").withColumn(value, F.coalesce(F.col(value).cast("string"), F.lit(missing)))


def latest_versions(corrections: DataFrame, key: str, at: str) -> DataFrame:
    """Corrections are rows; the latest of each key counts, earlier ones are its history."""
    newest = F.row_number().over(W.partitionBy(key).orderBy(F.col(at).desc()))
    return corrections.withColumn("lv_n", newest).where("lv_n = 1").drop("lv_n")


def worker_shards(jobs: DataFrame, group: str, workers: int) -> DataFrame:
    """Jobs of one group stay together; groups go round to the workers."""
    numbered = jobs.select(group).distinct().withColumn("worker", (F.row_number().over(W.orderBy(group)) - 1) % workers)
    return jobs.join(numbered, group)
