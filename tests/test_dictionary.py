"""The compiled walk against a walk in plain Python."""

import random

from pyspark.sql import functions as F

from lipika.functions.dictionary import Dictionary
from lipika.functions.text import VIRAMA


def walk(text, units, exempt=" \t\n", exempt_first=False):
    """Characters taken before the first failure."""
    longest, at = max(map(len, units)), 0
    while at < len(text):
        if exempt_first and text[at] in exempt:
            at += 1
            continue
        size = next((s for s in range(min(longest, len(text) - at), 0, -1) if text[at : at + s] in units), 0)
        if not size and text[at] in exempt:
            size = 1
        if not size:
            return at
        at += size
    return at


SETS = [["a", "ab", "abc", "cd"], ["aa", "aaa"], ["a.", "(", "[x]", "b"], ["ಕ", "ನ", "ನ್ನ", "ಡ", "್‌", " a"], ["ab", "b", "bc ", "c"]]


def test_walk(spark):
    rng = random.Random(5)
    for units in SETS:
        letters = sorted({c for u in units for c in u}) + [" ", "z"]
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 9))) for _ in range(800)]
        d = Dictionary(units)
        rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
        rows = rows.select("i", d.encodable(F.col("t")).alias("a"), d.encodable(F.col("t"), exempt_first=True).alias("b"), d.failure_offset(F.col("t")).alias("c")).orderBy("i").collect()
        for r, t in zip(rows, texts, strict=True):
            done = walk(t, set(units))
            assert r.a == (done == len(t)) and r.c == (None if done == len(t) else done), (units, t)
            assert r.b == (walk(t, set(units), exempt_first=True) == len(t)), (units, t)


def test_long_text_and_no_units(spark):
    rows = spark.createDataFrame([("ab" * 100_000,)], "t string")
    assert rows.select(Dictionary(["a", "ba"]).encodable(F.col("t")).alias("r")).first().r is False  # its last b is alone
    assert rows.select(Dictionary(["ab"]).encodable(F.col("t")).alias("r")).first().r is True
    assert rows.select(Dictionary([]).encodable(F.col("t")).alias("r")).first().r is True


def test_failing_cluster(spark):
    d = Dictionary(["ರ", "ಕ", "ಖ", "ಾ", "ತ"])
    words = [f"ತರ{VIRAMA}ಖಾತ", "ತಕಾ", "ತxತ", f"ಗ{VIRAMA}ಕ"]
    rows = spark.createDataFrame(list(enumerate(words)), "i int, t string").select("i", d.first_failure(F.col("t")).alias("f"), d.offending(F.col("t")).alias("o")).orderBy("i").collect()
    assert [r.f for r in rows] == [f"ರ{VIRAMA}ಖಾ", None, "ತx", f"ಗ{VIRAMA}ಕ"]
    assert [r.o for r in rows] == [VIRAMA, "", "x", f"ಗ{VIRAMA}"]


def test_from_table(spark):
    units = spark.createDataFrame([("a",), ("ab",), (None,), ("a",)], "unit string")
    assert Dictionary.from_table(units).units == ["ab", "a"]


def test_failing_words(spark):
    """Against the walk over each word; random texts, units with shared beginnings, units with a space."""
    rng = random.Random(7)
    texts = ["".join(rng.choice("abcd  \tx-😀") for _ in range(rng.randrange(40))) for _ in range(300)] + ["", " ", None, "ab " * 50_000 + "x"]
    for units in (["a", "ab", "abc", "cd", "-"], ["ab", "b c", "😀", "d"], ["b-", "a"], []):
        d = Dictionary(units)
        fails = lambda w: bool(units) and walk(w, units) < len(w)  # noqa: E731, B023
        rows = spark.createDataFrame(list(enumerate(texts)), "i int, v string").select("i", d.failing_words(F.col("v")).alias("r")).orderBy("i").collect()
        assert [r.r or [] for r in rows] == [[w for w in (t or "").split(" ") if fails(w)] for t in texts]


def test_alternatives_by_first_character():
    """A place doesn't try the whole dictionary: one class, then one alternative for each beginning."""
    assert Dictionary(["the", "th", "t", "a", "]", "er", "^"]).alternation() == r"[\]\^a]|t(?:he|h|)|e(?:r)|[ " + r"\t\n]"


def test_only_failing_words_are_sorted(spark):
    """Rows of words are those that fail; encodable words were sorted and shuffled too."""
    from lipika.plans import QUERIES

    plan = QUERIES["unencodable_words"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1 and "split(line" not in plan
