"""Connected components on chains, stars and repeated edges."""

import random

from lipika.llm._common import connected_components


def brute(edges):
    root = {}
    for a, b in edges:
        if a is None or b is None or a == b:
            continue
        root.setdefault(a, a)
        root.setdefault(b, b)

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    return {x: top(x) for x in root}


def test_shapes(spark):
    rng = random.Random(4)
    chain = [(k, k + 1) for k in range(1000, 1040)]
    star = [(2000, k) for k in range(2001, 2050)]
    rest = [(rng.randint(1, 80), rng.randint(1, 80)) for _ in range(60)]
    edges = [*chain, *star, *rest, *rest, (7, 7), (None, 3), (9999, 0)]
    found = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == brute(edges)


def test_none(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
