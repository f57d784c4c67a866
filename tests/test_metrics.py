"""Error rates and alignments against plain Python."""

import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from lipika.functions import metrics as M


def distance(a, b):
    row = [*range(1 + len(b))]
    for number, x in enumerate(a, 1):
        row, before = [number], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j - 1] + (x != y), before[j] + 1, row[-1] + 1))
    return row[-1]


def pairs():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abಕé") for _ in range(rng.randint(1, 4)))
    out = [("", ""), ("a", ""), ("", "a"), (" ", " x "), ("ab", "abcdefgh"), ("a b", "ab"), ("same text", "same text")]
    for _ in range(200):
        a = [word() for _ in range(rng.randint(0, 8))]
        b = [word() if rng.random() < 0.3 else w for w in a if rng.random() > 0.1]
        out.append((" ".join(a), "  ".join(b)))
    return out


def test_rates(spark):
    data = pairs()
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(data)], "i int, a string, b string")
    rows = rows.select("i", M.cer(F.col("a"), F.col("b")).alias("cer"), M.cer_review(F.col("a"), F.col("b")).alias("review"), M.cer_percent(F.col("a"), F.col("b")).alias("percent"), M.wer(F.col("a"), F.col("b")).alias("wer"))
    for r, (a, b) in zip(rows.orderBy("i").collect(), data, strict=True):
        x, y = a.replace(" ", ""), b.replace(" ", "")
        assert r.cer == (min(distance(x, y) / len(x), 1) if x else 0)
        x, y = " ".join(a.split()), " ".join(b.split())
        assert r.review == (min(distance(x, y) / len(x), 1) if x else float(bool(y)))
        assert abs(r.percent - (distance(x, y) / len(x) * 100 if x else 0)) <= 0.0500001
        assert r.wer == (min(distance(a.split(), b.split()) / len(a.split()), 1) if a.split() else 0)


def test_classes(spark):
    rows = spark.createDataFrame([(0.05,), (0.1,), (0.35,)], "v double").select(M.error_class(F.col("v")).alias("c")).collect()
    assert [r.c for r in rows] == ["good", "ok", "bad"]


def test_alignment(spark):
    data = [*pairs()[:80], ("a<b", "a&b"), ("😀x", "😀y")]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(data)], "i int, a string, b string").withColumn("ops", M.align_ops("a", "b"))
    left, right = M.diff_markup(F.col("a"), F.col("b"), F.col("ops"))
    rows = rows.select("i", "ops", M.confusions(F.col("a"), F.col("b"), F.col("ops")).alias("pairs"), left.alias("l"), right.alias("r")).orderBy("i").collect()
    for r, (a, b) in zip(rows, data, strict=True):
        ops = SequenceMatcher(None, a, b, autojunk=False).get_opcodes()
        assert [tuple(o) for o in r.ops] == ops
        want = [(x, y) for o, i1, i2, j1, j2 in ops if o == "replace" for x, y in zip(a[i1:i2], b[j1:j2], strict=False) if x != y]
        assert [tuple(p) for p in r.pairs] == want
    assert rows[-2].l == 'a<span class="sub-del">&lt;</span>b' and rows[-2].r == 'a<span class="sub-ins">&amp;</span>b'
