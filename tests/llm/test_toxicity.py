"""The random field: exact marginals, held-out accuracy, offsets."""

import itertools
import random
import zlib

import numpy as np

from lipika.llm import toxicity_crf as T


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    trans = tuple(map(tuple, rng.normal(size=(2, 2)).tolist()))
    lengths = np.array([0, 5, 1, 7, 0, 3])
    e = rng.normal(size=int(lengths.sum())) * 2
    got = T.chain_marginals(e, lengths, trans)
    at = 0
    for n in lengths:
        own = e[at : at + n]
        total, p = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=int(n)):
            s = np.exp(sum(own[k] * y[k] for k in range(n)) + sum(trans[a][b] for a, b in zip(y, y[1:], strict=False)))
            total += s
            p += s * np.array(y)
        if n:
            assert np.allclose(got[at : at + n], p / total)
        at += n


def corpus(n=900):
    rng = random.Random(9)
    syllables = ["an", "the", "ing", "er", "st", "ou", "wh", "ré", "ti"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    docs, labels = [], []
    for k in range(n):
        words = [word() for _ in range(rng.randint(5, 150))]
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words[rng.randrange(len(words))] = rng.choice(["Villain,", "villain", "zzub" + word(), "zzub" + word() + "!"])
        docs.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_offsets(spark):
    docs, labels = corpus()
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, score string")
    field = T.train(d, spark.createDataFrame([*labels, (None, 1), (5, None), (77777, 1)], "doc_id long, toxic int"))
    rows = {r.doc_id: r for r in T.tagged(d, field).collect()}
    want = dict(labels)
    held = [k for k in want if zlib.crc32(str(k).encode()) % 5 == 0]
    assert np.mean([(rows[k].score >= 0.5) == bool(want[k]) for k in held]) > 0.97
    texts = dict(docs)
    marked = [texts[k][s["start"] : s["end"]].lower() for k in held for s in rows[k].spans]
    assert marked and np.mean([m.startswith(("villain", "zzub")) for m in marked]) > 0.9
    assert not any(m.endswith((",", "!")) for m in marked)


def test_every_toxic_token_is_in_a_window():
    text = " ".join("bad" if k % 11 == 0 else f"w{k}" for k in range(700))
    words, states = T._windows([text, "only clean words", ""], np.array([1, 0, 0]), {"=bad"})
    assert sum(map(sum, states)) >= 64 and all(len(w) == len(y) <= T.WINDOW for w, y in zip(words, states, strict=True))


def test_sample_is_fixed_and_bounded(spark):
    docs, labels = corpus(200)
    both = [*docs, *[(k, "zzub other text") for k, _ in docs[:50]]]
    y = spark.createDataFrame(labels, "doc_id long, toxic int")
    fields = [T.train(spark.createDataFrame(both, "doc_id long, text string").repartition(n), y, sample_chars=20_000) for n in (1, 3)]
    assert fields[0] == fields[1] and fields[0].weights
    assert not T.train(spark.createDataFrame(both, "doc_id long, text string"), y, sample_chars=1).weights


def test_odd_inputs(spark):
    docs, labels = corpus(300)
    field = T.train(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    odd = spark.createDataFrame([(None, None), (1, ""), (1, " \n "), (2, "an " * 30_000 + "villain"), (2, "!!! ,")], "doc_id long, text string")
    rows = T.tagged(odd, field).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert max(r.score for r in rows if r.doc_id == 2) > 0.5 and all(r.score == 0 for r in rows if r.doc_id != 2)
    clean = T.tagged(spark.createDataFrame([("a", "an the ing er " * 50_000)], "doc_id string, text string"), field).first()
    assert clean.doc_id == "a" and clean.score < 0.1  # long texts don't add up to toxic ones
    none = T.train(odd, spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r.score < 0.01 for r in T.tagged(odd, none).collect())
    assert T.tagged(odd.limit(0), field).count() == 0
