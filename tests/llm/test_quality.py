"""The rule ensemble: held-out accuracy, agreement with its compiled form, and odd inputs."""

import random
import zlib

import numpy as np

from lipika.llm import quality_rules as Q


def corpus(n=600):
    rng = random.Random(8)
    vocabulary = ["the", "house", "Grün", "walks", "tree", "a", "very", "long", "sentence", "of", "words"]
    docs, labels = [], []
    for k in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(4, 200))]
        bad = rng.random() < 0.3
        if bad:
            words = rng.choice([[w.upper() + "!!" for w in words], [w + "%%%" for w in words], [words[0]] * len(words)])
        docs.append((k, " ".join(words) + ("" if bad else ".")))
        labels.append((k, int(not bad)))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, label_y string")
    label_rows = spark.createDataFrame([*labels, (None, 1), (3, None), (99999, 0)], "doc_id long, quality int")
    rules = Q.train(d, label_rows)
    assert 0 < len(rules.weighted) < 200
    found = {r.doc_id: r for r in Q.scored(d, rules).collect()}
    assert len(found) == len(docs)
    want = dict(labels)
    held = [k for k in want if zlib.crc32(str(k).encode()) % 4 == 2]
    assert all(found[k].held_out == (k in set(held)) for k in found)
    assert np.mean([found[k].predicted == want[k] for k in held]) > 0.97
    good = Q.good_documents(d, rules)
    assert good.columns == d.columns
    assert sorted(r.doc_id for r in good.collect()) == sorted(k for k in found if found[k].score >= 0.7)


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs, labels = corpus(200)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    turned = [(k, 1 - y if zlib.crc32(str(k).encode()) % 4 == 2 else y) for k, y in labels]
    a, b = (Q.train(d, spark.createDataFrame(x, "doc_id long, quality int")) for x in (labels, turned))
    assert a == b


def test_odd_inputs(spark):
    docs, labels = corpus(200)
    rules = Q.train(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"))
    odd = spark.createDataFrame([(None, None), (1, ""), (1, " \n "), (2, "x" * 100_000), (3, "a " * 50_000)], "doc_id long, text string")
    rows = Q.scored(odd, rules).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    none = Q.train(odd, spark.createDataFrame([], "doc_id long, quality int"))
    assert all(abs(r.score - 0.5) < 1e-9 for r in Q.scored(odd, none).collect())
    assert Q.scored(odd.limit(0), rules).count() == 0


def test_compiled_rules_equal_their_meaning(spark):
    docs, labels = corpus(150)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    rules = Q.train(d, spark.createDataFrame(labels, "doc_id long, quality int"))
    rows = d.select("doc_id", Q.statistics(d.text).alias("s"), rules.score(d.text).alias("score")).collect()
    for r in rows:
        total = rules.bias + sum(w for w, c in rules.weighted if all((r.s[k] > at) == above for k, above, at in c))
        assert abs(r.score - 1 / (1 + np.exp(-total))) < 1e-9
