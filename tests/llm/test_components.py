"""Connected components of edge tables."""

import random

from citeloom.llm.components import connected_components


def by_hand(pairs):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


def found(spark, pairs):
    edges = spark.createDataFrame(pairs, "a bigint, b bigint")
    rows = connected_components(edges).collect()
    assert len({r.node for r in rows}) == len(rows)
    return {r.node: r.component for r in rows}


def test_chains_hubs_and_repeated_edges(spark):
    rng = random.Random(1)
    chain = [(k, k + 1) for k in range(100, 160)]
    hub = [(500, 500 + k) for k in range(1, 200)]
    loose = [(1000 + rng.randrange(60), 1000 + rng.randrange(60)) for _ in range(40)]
    pairs = chain + hub + loose + [(a, b) for b, a in hub[:50]] + chain[:20]
    rng.shuffle(pairs)
    assert found(spark, pairs) == by_hand(pairs)


def test_nulls_loops_and_no_edges(spark):
    assert found(spark, []) == {}
    assert found(spark, [(1, 1), (None, 2), (3, None), (None, None)]) == {}
    assert found(spark, [(1, 1), (5, 4), (None, 4), (-7, 5)]) == {-7: -7, 4: -7, 5: -7}
