"""Groups, chains and ways back of graphs, in one task and in rounds, against plain searches."""

from __future__ import annotations

import random

import pytest

from spanforge.operators import graphs as G


def plain(edges):
    """Component, depth and way back of every node by searches from each."""
    nodes = sorted({x for e in edges for x in e})
    out = {x: sorted({b for a, b in edges if a == x}) for x in nodes}

    def reach(x):
        seen, level, d = {}, [x], 0
        while level:
            d += 1
            level = sorted({y for n in level for y in out[n]} - set(seen))
            seen |= {y: d for y in level}
        return seen

    r = {x: reach(x) for x in nodes}
    comp = {x: min([x, *(y for y in r[x] if x in r[y])]) for x in nodes}

    def depth(c, memo={}):  # noqa: B006
        return max((depth_of(comp[y]) + 1 for x in nodes if comp[x] == c for y in out[x] if comp[y] != c), default=0)

    known = {}

    def depth_of(c):
        if c not in known:
            known[c] = depth(c)
        return known[c]

    return comp, {x: depth_of(comp[x]) for x in nodes}, {x: r[x][x] for x in nodes if x in r[x]}


def graph(seed):
    rng = random.Random(seed)
    n = rng.randrange(2, 25)
    return sorted({(rng.randrange(n), rng.randrange(n)) for _ in range(rng.randrange(1, 2 * n))})


@pytest.mark.parametrize("seed", range(200))
def test_in_one_task(seed):
    edges = graph(seed)
    comp, depth, back = plain(edges)
    nodes = sorted(comp)
    out = [[nodes.index(b) for a, b in edges if a == x] for x in nodes]
    group = G.groups(out)
    assert {(comp[x] == comp[y]) for i, x in enumerate(nodes) for j, y in enumerate(nodes) if (group[i] == group[j]) != (comp[x] == comp[y])} == set()
    below = G.chains(out, group)
    assert {x: below[group[i]] for i, x in enumerate(nodes)} == depth
    assert {x: d for x, d in zip(nodes, G.ways_back(out), strict=True) if d} == back


@pytest.mark.parametrize("one_task", [500_000, 0])
def test_tables(spark, monkeypatch, one_task):
    monkeypatch.setattr(G, "ONE_TASK", one_task)
    monkeypatch.setattr(G, "ONE_TASK_STEPS", one_task)
    edges = graph(77) + [(100 + k, 101 + k) for k in range(6)] + [(106, 104), (3, 100)]
    comp, depth, back = plain(edges)
    d = spark.createDataFrame(edges + edges[:3], "src long, dst long")
    assert {r.node: r.component for r in G.mutual(d).collect()} == comp
    assert {r.node: r.depth for r in G.depths(d).collect()} == depth
    assert {r.node: r.length for r in G.on_cycles(d).collect()} == back
    s = G.stats(d).first()
    assert (s.edges, s.terms, s.max_depth, s.deep, s.on_cycles) == (len(edges), len(comp), max(depth.values()), sum(x >= 3 for x in depth.values()), len(back))


def test_long_chain_and_names(spark):
    n = 20_000  # deeper than any recursion
    out = [[k + 1] for k in range(n)] + [[]]
    assert G.chains(out, G.groups(out))[G.groups(out)[0]] == n
    d = spark.createDataFrame([("EBITDA", "Net Income"), ("Net Income", "Taxes"), ("Taxes", "Net Income")], "src string, dst string")
    assert {r.node: r.depth for r in G.depths(d).collect()} == {"EBITDA": 1, "Net Income": 0, "Taxes": 0}
    none = d.limit(0)
    assert G.depths(none).count() == G.mutual(none).count() == G.on_cycles(none).count() == 0


def test_external_references(spark):
    d = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (4, 2), (5, 4)], "src long, dst long")
    starts = spark.createDataFrame([(1,), (4,)], "start long")
    external = spark.createDataFrame([(4,), (9,)], "node long")
    assert sorted(map(tuple, G.external_references(d, starts, external).collect())) == [(1, 4, 3)]


@pytest.mark.parametrize("one_task", [3, 10, 20])
def test_rounds_end_in_one_task(spark, monkeypatch, one_task):
    """What rounds have left is solved in one task as soon as it fits."""
    monkeypatch.setattr(G, "ONE_TASK", one_task)
    edges = graph(77) + graph(78) + [(100 + k, 101 + k) for k in range(6)] + [(106, 104), (3, 100)]
    comp, depth, _ = plain(edges)
    d = spark.createDataFrame(edges, "src long, dst long")
    assert {r.node: r.component for r in G.mutual(d).collect()} == comp
    assert {r.node: r.depth for r in G.depths(d).collect()} == depth


def test_a_task_holds_flat_arrays_and_statistics_solve_once(spark, monkeypatch):
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    n = 200_000
    src, dst = [pa.array(np.arange(n))], [pa.array(np.arange(n) // 2)]
    tracemalloc.start()
    nodes, out = G._numbered(src, dst)
    component, depth = G._solved(nodes, out)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert component.to_pylist() == list(range(n)) and depth.to_pylist() == [k.bit_length() for k in range(n)]
    assert most / n < 100  # bytes of an edge
    calls, own = [], G.solved
    monkeypatch.setattr(G, "solved", lambda e: calls.append(1) or own(e))
    d = spark.createDataFrame([(1, 2), (2, 1), (2, None), (None, 3)], "src long, dst long")
    assert G.stats(d.dropna()).first().asDict() == {"edges": 2, "terms": 2, "max_depth": 0, "deep": 0, "on_cycles": 2} and len(calls) == 1
    assert {(r.node, r.component) for r in own(d).collect()} == {(1, 1), (2, 1), (3, 3)}
