"""Benchmark containment against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lipika.llm import decontaminate as D


def grams(text):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({("short", *w)} if w else set())


def brute(docs, items):
    out = {}
    for d, t in docs:
        for i, s in items:
            q = grams(s)
            if q and 100 * len(q & grams(t)) >= 80 * len(q):
                out[d, i] = (len(q), len(q & grams(t)))
    return out


def tables(spark):
    rng = random.Random(5)
    vocabulary = [f"Wort{i}ä" for i in range(400)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(5, 60)))) for k in range(30)]
    items += [(30, None), (31, ""), (32, "two words"), (33, "one two three four five")]
    docs = []
    for k in range(120):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 300))]
        if rng.random() < 0.6:
            passage = [w.upper() + rng.choice(["", ",", "!"]) if rng.random() > 0.02 else "changed" for w in (rng.choice(items[:30])[1]).split()]
            at = rng.randint(0, len(words))
            words[at:at] = passage
        docs.append((k, " ".join(words)))
    docs += [(200, None), (201, ""), (202, "Two  words!"), (203, "say one, two: three four five six")]
    return docs, items


@pytest.mark.parametrize("pairs,leaks", [(1 << 20, 1 << 20), (60, 3)])
def test_against_brute_force(spark, monkeypatch, pairs, leaks):
    monkeypatch.setattr(D, "PAIR_BOUND", pairs)
    monkeypatch.setattr(D, "LEAK_BOUND", leaks)
    docs, items = tables(spark)
    d = spark.createDataFrame([(*r, "x", "y") for r in docs], "doc_id long, text string, shingles string, text_h1 string")
    i = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, h string")
    found = {(r.doc_id, r.item_id): (r.n_item, r.n_common) for r in D.leaks(d, i).collect()}
    want = brute(docs, items)
    assert want and found == want
    clean = D.without_leaks(d, i)
    assert clean.columns == d.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted({k for k, _ in docs} - {k for k, _ in want})


def test_large_benchmark_shuffles_no_unfiltered_shingle(spark):
    """Some 50,000 sketch hashes, in the one plan there is: shingles meet the broadcast before any exchange."""
    word = F.concat(F.lit("w"), F.pmod(F.xxhash64("id", "k"), F.lit(30_000)).cast("string"))
    text = F.array_join(F.collect_list("w"), " ").alias("text")
    items = spark.range(5000).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(50)))).select(F.col("id").alias("item_id"), word.alias("w")).groupBy("item_id").agg(text)
    docs = items.where("item_id % 500 = 7").select(F.col("item_id").alias("doc_id"), F.concat(F.lit("before it "), "text", F.lit(" and after")).alias("text")).unionByName(spark.createDataFrame([(-1, "clean text " * 50), (-2, None)], "doc_id long, text string"))
    found = D.leaks(docs, items)
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [(k, k) for k in range(7, 5000, 500)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("rightHint=(strategy=broadcast)") == 2 and plan.index("Aggregate") < plan.index("Join")


def test_long_document(spark):
    item = " ".join(f"q{k}" for k in range(40))
    docs = spark.createDataFrame([(1, "long text of it " * 100_000 + item + " and more" * 100_000)], "doc_id long, text string")
    assert [(r.doc_id, r.n_common) for r in D.leaks(docs, spark.createDataFrame([(9, item)], "item_id long, text string")).collect()] == [(1, 36)]


def test_null_ids_and_empty_tables(spark):
    text = "a b c d e f g h"
    d = spark.createDataFrame([(None, text), (None, "clean words are these ones here"), (4, text), (4, text)], "doc_id long, text string")
    i = spark.createDataFrame([(1, text), (None, text)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in D.leaks(d, i).collect()} == {(None, 1), (4, 1), (None, None), (4, None)}
    assert [r.text for r in D.without_leaks(d, i).collect()] == ["clean words are these ones here"]
    assert D.leaks(d, i.limit(0)).count() == 0
    assert D.without_leaks(d, i.limit(0)).count() == 4
    assert D.leaks(d.limit(0), i).count() == 0
