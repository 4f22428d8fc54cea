"""Connected components against a brute-force version."""

from __future__ import annotations

import random

from drawdown.llm.graph import components, extended


def brute(edges):
    label = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def frame(spark, edges):
    return spark.createDataFrame(edges, "a BIGINT, b BIGINT")


def found(df):
    rows = df.collect()
    assert len(rows) == len({r.node for r in rows})
    return {r.node: r.label for r in rows}


def shapes():
    rng = random.Random(7)
    path = [(k, k + 1) for k in range(40)]
    star = [(100, 100 + k) for k in range(1, 30)] + [(200, 200 - k) for k in range(1, 30)]
    zigzag = [(300 + k, 399 - k) for k in range(40)] + [(399 - k, 301 + k) for k in range(39)]
    loose = [(400 + rng.randrange(120), 400 + rng.randrange(120)) for _ in range(90)]
    return path + star + zigzag + loose + [(5, 5), (900, 900), (2, 1), (1, 2)]


def test_components(spark):
    edges = shapes()
    assert found(components(frame(spark, edges))) == brute(edges)


def test_no_edges(spark):
    none = frame(spark, [])
    assert found(components(none)) == {}
    assert found(extended(components(none), none)) == {}
    assert found(extended(components(none), frame(spark, [(2, 1)]))) == {1: 1, 2: 1}


def test_extended_is_components_of_all(spark):
    edges = shapes()
    random.Random(3).shuffle(edges)
    half = len(edges) // 2
    known = components(frame(spark, edges[:half]))
    assert found(extended(known, frame(spark, edges[half:]))) == brute(edges)
    assert found(extended(known, frame(spark, []))) == brute(edges[:half])
