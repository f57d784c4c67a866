"""Near-duplicates against brute force, and the cases without a usual text."""

import itertools
import random

import numpy as np
import pytest

from lipika.llm import near_dup as N

SCHEMA = "doc_id long, text string, n_shingles string, component_id string, cluster string"


def brute(rows, n, percent):
    sets = {}
    for doc_id, text in rows:
        words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
        sets[doc_id] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())
    root = {d: d for d in sets}
    changed = True
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(root[a], root[b])
            if root[a] != m or root[b] != m:
                root[a] = root[b] = m
                changed = True
    return {d: (len(sets[d]), root[d], root[d] == d) for d in sets}


def corpus(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, doc_id = [], 0
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, 9)):
            words = [rng.choice(vocabulary) if rng.random() < rng.choice([0, 0.01, 0.03, 0.1]) else w for w in base]
            rows.append((doc_id, " ".join(w.upper() if rng.random() < 0.2 else w for w in words)))
            doc_id += 1
    return rows


@pytest.mark.parametrize(("n", "percent"), [(3, 85), (5, 80), (1, 50)])
def test_against_brute_force(spark, n, percent):
    rows = [*corpus(), (900, None), (901, ""), (902, "  \n\t "), (903, "one"), (904, "ONE"), (905, "one two"), (906, "x " * 4000)]
    random.Random(2).shuffle(rows)
    found = N.near_duplicates(spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA), n, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute(rows, n, percent)


@pytest.mark.parametrize(("parts", "docs"), [(2, 4), (512, 4), (2, 16)])
def test_large_cluster_in_blocks(spark, monkeypatch, parts, docs):
    monkeypatch.setattr(N, "BLOCK_DOCS", docs)
    monkeypatch.setattr(N, "PART_DOCS", parts)
    rows = corpus(3)
    found = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute(rows, 3, 85)


def test_forest_connects_what_all_links_connect(monkeypatch):
    monkeypatch.setattr(N, "PART_DOCS", 3)
    rng, words = random.Random(7), N._Words()
    sets = [s for _, t in corpus(8) if len(s := N.shingle_set(t, 3, words))]
    rng.shuffle(sets)
    all_links = [(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 70 * len(np.union1d(sets[i], sets[j]))]

    def classes(edges):
        root = list(range(len(sets)))
        for _ in sets:
            for i, j in edges:
                root[i] = root[j] = min(root[i], root[j])
        return root

    groups = np.array([k % 20 if k % 3 == 0 else 1000 + k for k in range(len(sets))])
    known = [(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if groups[i] == groups[j]]
    for split in (0, 5):
        for inner in (True, False):
            wanted = [(i, j) for i, j in all_links if (i < split <= j) or (inner and i >= split)] if split or inner else []
            assert classes(N.links_within(sets, 70, split, inner)) == classes(wanted)
            assert classes([*N.links_within(sets, 70, split, inner, groups), *known]) == classes([*wanted, *known])


def test_near_copies_are_sent_twice(spark, monkeypatch):
    """A cluster in 40 blocks whose copies are all linked: no block meets more than itself and the first."""
    monkeypatch.setattr(N, "BLOCK_DOCS", 10)
    base = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join([*base[: k % 200], f"x{k}", *base[k % 200 + 1 :]])) for k in range(400)]
    sent = []
    monkeypatch.setattr(N, "_compared", lambda texts, m, *a, f=N._compared: (sent.append(m.selectExpr("sum(size(m))").first()[0]), f(texts, m, *a))[1])
    found = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in found} == {0} and len(sent) == 1 and sent[0] <= 2.5 * len(rows)


def test_null_and_repeated_ids(spark):
    text = " ".join(f"a{i}" for i in range(30))
    docs = spark.createDataFrame([(None, text), (5, text), (5, text), (3, text), (None, None)], "doc_id long, text string")
    found = sorted(((r.doc_id, r.component_id, r.kept) for r in N.near_duplicates(docs).collect()), key=str)
    assert found == sorted([(None, None, True), (None, None, True), (5, 3, False), (5, 3, False), (3, 3, True)], key=str)


def test_no_rows(spark):
    assert N.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_one_of_each_keeps_columns(spark):
    text = " ".join(f"a{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text, "s", "t"), (2, text, "s", "t"), (3, "other words here", None, "t")], "doc_id long, text string, gone_id string, `a.b` string")
    kept = N.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_sketch_agrees_as_often_as_sets(spark):
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    for common in (50, 200, 400):
        a, b = np.unique(pool[:500]), np.unique(np.concatenate([pool[500 - common : 500], pool[1000 : 1500 - common]]))
        want = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        s = N.sketches([a, b], 2048)
        assert abs((s[0] == s[1]).mean() - want) < 0.05
    tiny = N.sketches([pool[:1], pool[:2]], 180)
    assert (tiny != N._EMPTY).all()


def test_bands_cover_the_threshold():
    for percent in (30, 50, 80, 85, 95):
        rows = N.rows_for(percent)
        assert (1 - (percent / 100) ** rows) ** N.bands_for(percent, rows) <= N.MISS * 1.01 and rows * N.bands_for(percent, rows) < 400
    assert N.rows_for(80) == N.rows_for(85) == 6
