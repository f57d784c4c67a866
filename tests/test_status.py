"""Status operators on the cases that the tables don't hold."""

from pyspark.sql import functions as F

from lipika.operators import status as T


def test_outcomes(spark):
    rows = lambda *r: spark.createDataFrame([(x,) for x in r], "r string")
    assert tuple(T.outcome_tally(rows("ok", "skip", "fail:x"), "r").first()) == (1, 1, 1, False)
    assert tuple(T.outcome_tally(rows(*["fail:x"] * 19), "r").first()) == (0, 0, 19, False)
    assert tuple(T.outcome_tally(rows(*["fail:x"] * 20), "r").first()) == (0, 0, 20, True)
    assert tuple(T.outcome_tally(rows(*["fail:x"] * 20, "skip"), "r").first()) == (0, 1, 20, False)
    assert tuple(T.outcome_tally(rows().limit(0), "r").first()) == (0, 0, 0, False)
    errors = T.top_errors(rows("fail:b", "fail:a", "fail:a", "ok", "timeout"), "r", 2).collect()
    assert [tuple(x) for x in errors] == [("a", 2), ("b", 1)]


def test_means_of_nothing(spark):
    styles = spark.createDataFrame([("a",), ("b",)], "s string")
    scores = spark.createDataFrame([("a", 10.04), ("a", 10.16)], "s string, rate double")
    assert {tuple(r) for r in T.style_means(styles, scores, "s", "rate").collect()} == {("a", 10.1, 504.6), ("b", 999.0, 504.6)}
    none = T.style_means(styles.limit(0), scores, "s", "rate")
    assert none.count() == 0
    assert T.model_means(scores.limit(0), "s", ["rate"]).count() == 0


def test_shares_and_last_wins(spark):
    assert T.review_shares(12, "a", "b", "c") == {"a": 8, "b": 4, "c": 5} and T.review_shares(40, "a", "b", "c")["c"] == 10 and "c" not in T.review_shares(9, "a", "b")
    entries = spark.createDataFrame([(1,), (2,)], "k int")
    found = spark.createDataFrame([(1, 5, "old"), (1, 6, "new")], "k int, at int, v string")
    assert sorted(map(tuple, T.last_wins(entries, found, "k", "at").collect())) == [(1, "new"), (2, None)]


def test_guards_and_names(spark):
    rows = spark.createDataFrame([(15, 100, 1.0), (16, 39, 1.0), (16, 40, 0.0), (16, 40, 0.5)], "h int, w int, ink double")
    assert [r.x for r in rows.select(T.scan_guard(F.col("w"), F.col("h"), F.col("ink")).alias("x")).collect()] == ["low", "narrow", "blank", None]
    urls = spark.createDataFrame([("https://x.org/a.GIT",), ("git@x:y",), ("https://github.com/x",), ("https://x.org",), (None,)], "u string")
    assert [r.x for r in urls.select(T.clonable(F.col("u")).alias("x")).collect()] == [True, True, True, False, False]
    parts = spark.createDataFrame([("a", 3), ("b", 0)], "p string, n int")
    assert T.readiness(parts, "p", "n", {"a": 3, "b": 1}).first().asDict() == {"a_ready": True, "b_ready": False, "n_ready": 1, "all_ready": False}
