"""Cosine links against brute force, and unusable vectors."""

import math

import numpy as np
import pytest

from lipika.llm import epsilon_join as E

SCHEMA = "vec_id long, embedding array<float>, label int, rep string, block string"


def brute(rows, threshold=0.98):
    good = {}
    for vec_id, x, label in rows:
        if vec_id is None or label is None or not x or any(v is None or not math.isfinite(v) for v in x):
            continue
        u = np.array(x, np.float32).astype(np.float64)
        if np.abs(u).max() > 0:
            good[vec_id] = (label, u)
    links = {v: set() for v in good}
    for a, (la, x) in good.items():
        for b, (lb, y) in good.items():
            if a != b and la == lb and len(x) == len(y) and x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold:
                links[a].add(b)
    out = {}
    for v in good:
        seen, todo = {v}, [v]
        while todo:
            for w in links[todo.pop()] - seen:
                seen.add(w)
                todo.append(w)
        out[v] = (len(links[v]), min(seen))
    return out


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(E, "LEAF", 8)
    rng = np.random.default_rng(7)
    rows, n = [], 0
    for _ in range(25):
        centre = rng.normal(size=16)
        label = int(rng.integers(0, 3))
        for _ in range(int(rng.integers(1, 12))):
            x = centre + rng.normal(size=16) * rng.choice([0, 0.02, 0.1, 0.2])
            rows.append((n, [float(v) for v in (x * rng.choice([1, 1, 3])).astype(np.float32)], label))
            n += 1
    one = rows[0][1]
    rows += [
        (n, None, 1), (n + 1, [0.0] * 16, 1), (n + 2, [float("nan"), *one[1:]], 1), (n + 3, [None, *one[1:]], 1), (n + 4, one, None), (n + 5, [float("inf"), *one[1:]], 0),
        (n + 6, [], 2), (n + 7, one[:8], rows[0][2]), (n + 8, one, rows[0][2]), (None, one, rows[0][2]),
    ]
    want = brute(rows)
    found = E.cosine_links(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA), interval=16).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            n_links, component = want.get(r.vec_id, (0, r.vec_id))
            assert (r.vec_id, r.n_links, r.component_id, r.kept) == (r.vec_id, n_links, component, component == r.vec_id)


@pytest.mark.parametrize(("bits", "sample"), [(0, 1), (1, 100), (4, 10_000)])
def test_many_intervals_and_any_axes(spark, monkeypatch, bits, sample):
    monkeypatch.setattr(E, "LEAF", 4)
    monkeypatch.setattr(E, "RANGE_BITS", bits)
    monkeypatch.setattr(E.principal_axes, "__defaults__", (sample,))
    rng = np.random.default_rng(3)
    base = np.concatenate([np.cumsum(rng.normal(size=(300, 6)) * 0.15, axis=0), rng.normal(size=(200, 6))])
    rows = [(k, [float(v) for v in x.astype(np.float32)], k % 7 // 6) for k, x in enumerate(base)]
    found = E.cosine_links(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA), interval=4).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == brute(rows)


@pytest.mark.parametrize(("kind", "labels"), [("string", ["a b", "a", "a b", None]), ("double", [0.5, 0.25, 0.5, None]), ("double", [0.0, 1.0, -0.0, None])])
def test_labels_of_other_types(spark, kind, labels):
    x = [1.0, 2.0, 3.0]
    rows = [(k, x, label) for k, label in enumerate(labels)]
    found = E.cosine_links(spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == {0: (1, 0), 1: (0, 1), 2: (1, 0), 3: (0, 3)}


def test_repeated_rows_and_none(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, [2.0, 0.001], 0)]
    found = sorted((r.vec_id, r.n_links, r.component_id) for r in E.cosine_links(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect())
    assert found == [(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 2, 1)]
    assert E.cosine_links(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
