"""The stages on one small corpus: every decision takes effect, and clean documents stay."""

import random

import numpy as np

import corpus_pipeline as P
from lipika.llm import training_order


def make(tmp_path, spark):
    rng = random.Random(13)
    vocabulary = [f"{a}{b}" for a in ("haus", "baum", "wald", "see", "berg") for b in ("chen", "er", "ig", "lich", "tal", "weg", "rand", "stein", "hof", "bach")]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    docs, labels, bad, copies, leaks = [], [], set(), set(), set()
    items = [(k, " ".join(words(20))) for k in range(5)]
    for k in range(400):
        w = words(rng.randint(20, 150))
        if k % 10 == 3:
            w, _ = [x.upper() + "!!" for x in w], bad.add(k)
        elif k % 20 == 5:
            w[5:5] = items[k % 5][1].split()
            leaks.add(k)
        elif k % 20 == 7 and k > 100:
            w = docs[k - 25][1].split()  # a good document
            w[0] = "anders"
            copies.add(k)
        docs.append((k, " ".join(w), "de", "ab"[k % 3 == 0], 0))
        labels.append((k, int(k % 10 != 3), 0))
    docs = [(k, t, la, s, len(t)) for k, t, la, s, _ in docs]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    return docs, bad, copies, leaks


def test_stages(spark, tmp_path):
    docs, bad, copies, leaks = make(tmp_path, spark)
    d = str(tmp_path)
    rows = spark.read.parquet(f"{d}/documents.parquet")
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    everything = set(range(len(docs)))
    seen = []
    for k, (name, stage) in enumerate(P.STAGES[:-1]):
        columns = rows.columns
        rows = stage(spark, rows, d)
        assert rows.columns == columns, name
        rows.write.parquet(f"{d}/stage-{k}")
        rows = spark.read.parquet(f"{d}/stage-{k}")
        seen.append(ids(rows))
    assert seen[0] == everything - bad
    assert seen[1] == everything - bad - copies
    assert seen[2] == everything - bad - copies - leaks
    # weights 1 and 2 for a and b, of which a has the more words: a is cut, b taken whole and repeated
    b = {k for k in seen[2] if docs[k][3] == "b"}
    assert b < seen[3] < seen[2]
    mixed = [r.text for r in rows.collect()]
    out = P.STAGES[-1][1](spark, rows, d).collect()
    code, end = training_order.encoding(training_order.VOCABULARY)
    stream = np.frombuffer(b"".join(bytes(r.tokens) for r in sorted(out, key=lambda r: r.seq)), "<u2")
    parts = np.split(stream, np.flatnonzero(stream == end) + 1)[:-1]
    assert sorted(code.decode(p[:-1].tolist()) for p in parts) == sorted(mixed)
    assert P.run(spark, d).count() == len(out)


def test_stages_on_empty_and_odd_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, `x.y` int"
    odd = [(None, None, None, None, None, None), (1, "", "de", "a", 0, 1), (1, "", "de", "a", 0, 1), (2, " \n", None, None, 2, 1), (3, "ein kurzer Text", "de", "a", 15, 1)]
    for k, rows in enumerate(([], odd)):
        d = tmp_path / str(k)
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(d / "documents.parquet"))
        spark.createDataFrame([], "doc_id long, quality int, toxic int").coalesce(1).write.parquet(str(d / "labels.parquet"))
        spark.createDataFrame([], "item_id long, text string").coalesce(1).write.parquet(str(d / "benchmark.parquet"))
        docs = spark.read.schema(schema).parquet(str(d / "documents.parquet"))
        for name, stage in P.STAGES[1:-1]:
            out = stage(spark, docs, str(d))
            assert out.columns == docs.columns, name
            out.collect()
        assert P.STAGES[0][1](spark, docs, str(d)).count() == 0  # nothing learned: the score is a half
        assert P.STAGES[-1][1](spark, docs, str(d)).count() == (1 if rows else 0)
        assert P.run(spark, str(d)).count() == 0
