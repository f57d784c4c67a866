"""Lines of text out of measured character boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BOX = "struct<text:string,top:double,left:double,right:double,bottom:double>"
_STATE = f"struct<lines:array<{_BOX}>,open:boolean>"
ROW_TOLERANCE, OVERLAP, LEAST_HEIGHT = 3, 0.5, 16


def _overlap(a: Column, b: Column) -> Column:
    shorter = F.least(a["bottom"] - a["top"], b["bottom"] - b["top"])
    inter = F.least(a["bottom"], b["bottom"]) - F.greatest(a["top"], b["top"])
    return F.when(shorter > 0, inter / shorter).otherwise(0.0) >= OVERLAP


def _joined(a: Column, b: Column) -> Column:
    return F.struct(
        F.concat(a["text"], b["text"]).alias("text"), F.least(a["top"], b["top"]).alias("top"), F.least(a["left"], b["left"]).alias("left"), F.greatest(a["right"], b["right"]).alias("right"), F.greatest(a["bottom"], b["bottom"]).alias("bottom")
    ).cast(_BOX)


def _replaced_last(lines: Column, box: Column) -> Column:
    return F.concat(F.slice(lines, F.lit(1), F.size(lines) - 1), F.array(box))


def group_boxes(chars: Column) -> Column:
    """Lines of one page's characters, an array of ``(text, top, left, right, bottom)`` in order.

    A character joins the open line if it covers half of the shorter height with it, or begins
    within a few pixels of it; the line's box grows. A line end closes the line; a character without
    area adds its text alone. Then lines, from the top, that cover half of each other are merged, and
    those without text, width or height enough are dropped. The state is the growing box, so
    this is a fold over the page's array.
    """
    start = F.struct(F.array().cast(f"array<{_BOX}>").alias("lines"), F.lit(False).alias("open")).cast(_STATE)

    def step(s: Column, c: Column) -> Column:
        last = F.element_at(s["lines"], -1)
        flat = (c["right"] - c["left"] == 0) & (c["bottom"] - c["top"] == 0)
        text_only = F.struct(F.concat(last["text"], c["text"]).alias("text"), last["top"].alias("top"), last["left"].alias("left"), last["right"].alias("right"), last["bottom"].alias("bottom")).cast(_BOX)
        same = s["open"] & (_overlap(last, c) | (F.abs(c["top"] - last["top"]) <= ROW_TOLERANCE))
        lines = (
            F.when(c["text"] == "\n", s["lines"])
            .when(flat, F.when(s["open"], _replaced_last(s["lines"], text_only)).otherwise(s["lines"]))
            .when(same, _replaced_last(s["lines"], _joined(last, c)))
            .otherwise(F.concat(s["lines"], F.array(c.cast(_BOX))))
        )
        return F.struct(lines.alias("lines"), F.when(c["text"] == "\n", False).when(flat, s["open"]).otherwise(True).alias("open")).cast(_STATE)

    lines = F.aggregate(chars, start, step, lambda s: s["lines"])
    order = F.array_sort(F.transform(lines, lambda b, i: F.struct(b["top"].alias("top"), i.alias("i"), b.alias("box"))))
    empty = F.array().cast(f"array<{_BOX}>")

    def merge(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        return F.when((F.size(done) > 0) & _overlap(last, x["box"]), _replaced_last(done, _joined(last, x["box"]))).otherwise(F.concat(done, F.array(x["box"])))

    merged = F.aggregate(order, empty, merge)
    shown = F.transform(merged, lambda b: F.struct(F.regexp_replace(b["text"], r"^\s+|\s+$", "").alias("text"), b["left"].alias("x"), b["top"].alias("y"), (b["right"] - b["left"]).alias("w"), (b["bottom"] - b["top"]).alias("h")))
    return F.filter(shown, lambda b: (F.length(b["text"]) > 0) & (b["w"] > 0) & (b["h"] >= LEAST_HEIGHT))


def page_lines(rows: DataFrame, page: str = "page") -> DataFrame:
    """``page, n, text, x, y, w, h``: the lines of every page's character rows (``i, ch, top, left, right, bottom``)."""
    chars = F.transform(F.array_sort(F.collect_list(F.struct("i", F.col("ch").alias("text"), "top", "left", "right", "bottom"))), lambda c: F.struct(*[c[k].alias(k) for k in ("text", "top", "left", "right", "bottom")]))
    return rows.groupBy(page).agg(chars.alias("chars")).select(page, F.posexplode(group_boxes(F.col("chars"))).alias("n", "b")).select(page, "n", "b.*")


def islands(rows: DataFrame, group: str, order: list[str], value: str, gap: float) -> DataFrame:
    """Runs of neighbouring rows: a new one begins where ``value`` leaves the running extent by more than ``gap``.

    Returns ``group, island, n, low, high``. The extent grows with the run, so rows of a group
    are folded in order, in one array of numbers a group.
    """
    kind = "array<struct<n:bigint,low:double,high:double>>"

    def step(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        near = (F.size(done) > 0) & (x["v"] >= last["low"] - gap) & (x["v"] <= last["high"] + gap)
        grown = F.struct((last["n"] + 1).alias("n"), F.least(last["low"], x["v"]).alias("low"), F.greatest(last["high"], x["v"]).alias("high"))
        new = F.struct(F.lit(1).cast("long").alias("n"), x["v"].alias("low"), x["v"].alias("high"))
        return F.when(near, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(grown))).otherwise(F.concat(done, F.array(new))).cast(kind)

    items = F.array_sort(F.collect_list(F.struct(*order, F.col(value).cast("double").alias("v"))))
    folded = rows.groupBy(group).agg(items.alias("items")).select(group, F.posexplode(F.aggregate("items", F.array().cast(kind), step)).alias("island", "b"))
    return folded.select(group, F.col("island").cast("long").alias("island"), "b.*")
