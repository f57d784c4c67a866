"""Mixing: targets, exact budgets, repeats, and the mixed rows."""

import random
import re

from pyspark.sql import functions as F

from lipika.llm import mixing as X

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Water filling by rounds: give by weight, fix what exceeds its limit, share the rest again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        w = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / w for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 3.0 * sizes[s] for s in over}


def rows(seed=6):
    rng = random.Random(seed)
    out = []
    for k in range(300):
        source = rng.choice(["a", "a", "a", "a", "b", "c", "zé", "d", None])
        out.append((k, " ".join("w" for _ in range(rng.randint(0, 60))), source))
    out += [(900, None, "a"), (901, "", "b"), (902, "x " * 5000, "tiny"), (None, "three words here", "c"), (903, " \t ", "empty"), (7, out[7][1], out[7][2])]
    return out


def test_targets_and_budgets(spark):
    data = rows()
    df = spark.createDataFrame([(*r, 1) for r in data], "doc_id long, text string, source string, size int")
    found = X.mix(df, X.word_count(F.col("text"))).collect()
    assert len(found) == len(data)
    sizes = {}
    for _, text, source in data:
        sizes[source] = sizes.get(source, 0) + len(WORDS.findall(text or ""))
    want = targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in found:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert want[s] - 1 <= taken[s] <= want[s] + 1e-6
    again = X.mix(df.repartition(7), X.word_count(F.col("text"))).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken)
    assert sorted(map(key, found)) == sorted(map(key, again))


def test_mixed_documents_hold_what_is_taken(spark):
    data = [r for r in rows(11) if r[0] not in (None, 7)]
    df = spark.createDataFrame([(*r, len(r[1] or ""), 1, 2) for r in data], "doc_id long, text string, source string, n_chars long, mix_cut int, `x.y` int")
    taken = {r.doc_id: (r.size, r.taken) for r in X.mix(df, X.word_count(F.col("text"))).collect()}
    out = X.mixed_documents(df)
    assert out.columns == df.columns
    texts = {r[0]: r[1] for r in data}
    got = {}
    for r in out.collect():
        assert texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
        got.setdefault(r.doc_id, []).append(len(WORDS.findall(r.text)))
    for k, (size, words) in taken.items():
        assert sum(got.get(k, [])) == words
        assert all(n == size for n in sorted(got.get(k, []))[1:])


def test_repeated_rows_keep_the_budget(spark, monkeypatch):
    monkeypatch.setattr(X, "RANGE_ROWS", 20)
    data = [(7, "one two three four five", "a")] * 90 + [(None, f"null id {k}", "a") for k in range(90)] + [(k, "w " * 20, "b") for k in range(40)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    mixed = X.mix(df, X.word_count(F.col("text"))).collect()
    got = {}
    for r in X.mixed_documents(df).collect():
        got[r.source] = got.get(r.source, 0) + len(WORDS.findall(r.text))
    for s in "ab":
        assert got[s] == sum(r.taken for r in mixed if r.source == s) == int(next(r.target for r in mixed if r.source == s))


def test_no_rows_and_no_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert X.mix(empty, X.word_count(F.col("text"))).count() == 0
    assert X.mixed_documents(empty).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in X.mix(blank, X.word_count(F.col("text"))).collect()] == [(0.0, 0), (0.0, 0)]
