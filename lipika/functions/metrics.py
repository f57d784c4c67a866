"""Error rates and alignments of a text against its reference."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lipika.functions.text import SPACE, bound, escape_html, strip


def _collapsed(c: Column) -> Column:
    return strip(F.regexp_replace(c, rf"{SPACE}+", " "))


def cer(truth: Column, found: Column) -> Column:
    """Character error rate without blanks, at most 1; 0 for an empty reference."""
    t, f = F.replace(truth, F.lit(" "), F.lit("")), F.replace(found, F.lit(" "), F.lit(""))
    return bound(t, lambda t: F.when(F.length(t) == 0, 0.0).otherwise(F.least(F.levenshtein(t, f) / F.length(t), F.lit(1.0))))


def cer_review(truth: Column, found: Column) -> Column:
    """With single blanks, at most 1; for an empty reference 1 if anything was found."""
    t, f = _collapsed(truth), _collapsed(found)
    return bound(t, lambda t: F.when(F.length(t) == 0, F.when(F.length(f) > 0, 1.0).otherwise(0.0)).otherwise(F.least(F.levenshtein(t, f) / F.length(t), F.lit(1.0))))


def cer_percent(truth: Column, found: Column) -> Column:
    """With single blanks, per cent to one place, without a limit; 0 for an empty reference."""
    t, f = _collapsed(truth), _collapsed(found)
    return bound(t, lambda t: F.when(F.length(t) == 0, 0.0).otherwise(F.round(F.levenshtein(t, f) / F.length(t) * 100, 1)))


def word_distance(a: Column, b: Column) -> Column:
    """Edit distance of two arrays: one row of the table at a time, folded over the first."""
    start = F.transform(F.concat(F.array(F.lit("")), b), lambda _, j: j)

    def row(prev: Column, x: Column) -> Column:
        first = F.array(F.element_at(prev, 1) + 1)

        def cell(cur: Column, j: Column) -> Column:
            cost = F.when(x == F.element_at(b, j), 0).otherwise(1)
            best = F.least(F.element_at(prev, j) + cost, F.element_at(prev, j + 1) + 1, F.element_at(cur, -1) + 1)
            return F.concat(cur, F.array(best))

        steps = F.when(F.size(b) > 0, F.sequence(F.lit(1), F.size(b))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, first, cell)

    return F.element_at(F.aggregate(a, start, row), -1)


def words(c: Column) -> Column:
    return F.filter(F.split(c, rf"{SPACE}+"), lambda w: w != "")


def wer(truth: Column, found: Column) -> Column:
    """Word error rate, at most 1; 0 for a reference without words."""
    both = F.struct(words(truth).alias("t"), words(found).alias("f"))
    return bound(both, lambda x: F.when(F.size(x["t"]) == 0, 0.0).otherwise(F.least(word_distance(x["t"], x["f"]) / F.size(x["t"]), F.lit(1.0))))


def error_class(c: Column) -> Column:
    """good below .10, ok below .35, else bad."""
    return F.when(c < 0.10, "good").when(c < 0.35, "ok").otherwise("bad")


OPS = T.ArrayType(T.StructType([T.StructField("op", T.StringType()), *[T.StructField(k, T.IntegerType()) for k in ("i1", "i2", "j1", "j2")]]))


@F.pandas_udf(OPS)
def align_ops(truth: pd.Series, found: pd.Series) -> pd.Series:
    """Matching blocks and what lies between; not a shortest edit path, so no built-in function gives it."""
    return pd.Series(
        [
            None if a is None or b is None else [{"op": o, "i1": i1, "i2": i2, "j1": j1, "j2": j2} for o, i1, i2, j1, j2 in SequenceMatcher(None, a, b, autojunk=False).get_opcodes()]
            for a, b in zip(truth, found, strict=True)
        ]
    )


def confusions(truth: Column, found: Column, ops: Column) -> Column:
    """Pairs of unequal characters in replaced stretches, place by place."""
    replaced = F.filter(ops, lambda o: o["op"] == "replace")

    def pairs(o: Column) -> Column:
        n = F.least(o["i2"] - o["i1"], o["j2"] - o["j1"])
        return F.transform(F.sequence(F.lit(1), n), lambda k: F.struct(F.substring(truth, o["i1"] + k, F.lit(1)).alias("truth_char"), F.substring(found, o["j1"] + k, F.lit(1)).alias("found_char")))

    return F.filter(F.flatten(F.transform(replaced, pairs)), lambda p: p["truth_char"] != p["found_char"])


def diff_markup(truth: Column, found: Column, ops: Column) -> tuple[Column, Column]:
    """Both texts with their differences marked as spans."""

    def side(text: Column, a: str, b: str, alone: str, alone_class: str, replaced_class: str) -> Column:
        def one(o: Column) -> Column:
            part = escape_html(F.substring(text, o[a] + 1, o[b] - o[a]))
            span = lambda name: F.concat(F.lit(f'<span class="{name}">'), part, F.lit("</span>"))
            return F.when(o["op"] == "equal", part).when(o["op"] == "replace", span(replaced_class)).when(o["op"] == alone, span(alone_class)).otherwise("")

        return F.array_join(F.transform(ops, one), "")

    return side(truth, "i1", "i2", "delete", "del", "sub-del"), side(found, "j1", "j2", "insert", "ins", "sub-ins")
