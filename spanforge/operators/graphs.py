"""Graphs of definitions and of precedence, as edge tables (src, dst).

Reaching is a loop of joins: each level joins the last level's new nodes to the edges and leaves
out what was reached before. Every level is kept in the checkpoint folder, so plans stay short and
the loop ends with the first empty level. Only closure, which feeds texts of definitions, has a cap
(DEPTH, the definitions' own); cycles, components, chains, external references and statistics follow ways of any length.
Groups, chains and ways back of a graph of a stated size are found in one task instead of in rounds of small jobs.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.session import durable

DEPTH = 8


def closure(edges: DataFrame, starts: DataFrame, depth: int | None = DEPTH) -> DataFrame:
    """(start, node, depth): all nodes that a start reaches within depth steps (None: any number), at their least depth.

    starts: column start. A start reaches itself at depth 0."""
    e = durable(edges.select("src", "dst").distinct())
    level = durable(starts.select("start", F.col("start").alias("node")).distinct().withColumn("depth", F.lit(0)))
    out, m, n = level, e.count(), level.count()
    total = n
    for d in count(1) if depth is None else range(1, depth + 1):
        k = _tasks(m + n)
        step = level.repartition(k, "node").join(e.repartition(k, "src"), F.col("node") == F.col("src")).select("start", F.col("dst").alias("node"))
        k = _tasks(total + 2 * n)
        level = durable(step.repartition(k, "start", "node").distinct().join(out.select("start", "node").repartition(k, "start", "node"), ["start", "node"], "left_anti").withColumn("depth", F.lit(d)))
        n = level.count()
        if not n:
            break
        total += n
        out = out.unionByName(level)
    return out


#: Rows that a task of a level's joins sorts, about.
TASK_ROWS = 200_000


def _tasks(rows: int) -> int:
    """Tasks for so many rows: what one of them holds does not grow with the graph, and small levels are few tasks."""
    return max(1, -(-rows // TASK_ROWS))


# -- graphs of a stated size, in one task
#: Edges of a graph that one task solves, of about 60 bytes each, and steps of its searches for ways back; larger ones are solved by the joins below, to the same result.
ONE_TASK, ONE_TASK_STEPS = 10_000_000, 20_000_000
#: Rows that the task hands on at a time.
BATCH_ROWS = 100_000


def _of_one_task(edges: DataFrame) -> bool:
    return edges.count() <= ONE_TASK


class Leads:
    """What each node leads to, as two flat arrays: leads[x] has the ends of the edges from x."""

    def __init__(self, n: int, a: np.ndarray, b: np.ndarray) -> None:
        self.at, self.to = array("q", bytes(8 * (n + 1))), array("i")
        np.frombuffer(self.at, np.int64)[1:] = np.cumsum(np.bincount(a, minlength=n))
        self.to.frombytes(b[np.argsort(a, kind="stable")].tobytes())

    def __len__(self) -> int:
        return len(self.at) - 1

    def __getitem__(self, x: int) -> array:
        return self.to[self.at[x] : self.at[x + 1]]


def _numbered(src: list[pa.Array], dst: list[pa.Array]) -> tuple[pa.Array, Leads]:
    """Nodes in order and what each leads to, by their ranks. A null is no node, and an edge from or to it is none."""
    m = sum(map(len, src))
    both = pa.chunked_array([*src, *dst]).dictionary_encode()
    src.clear()
    dst.clear()
    nodes = both.chunk(0).dictionary
    order = pc.sort_indices(nodes)
    rank = np.empty(len(nodes) + 1, np.int32)
    rank[order.to_numpy()] = np.arange(len(nodes), dtype=np.int32)
    rank[-1] = -1
    ends = np.concatenate([rank[c.indices.fill_null(len(nodes)).to_numpy()] for c in both.chunks])
    del both
    a, b = ends[:m], ends[m:]
    there = (a >= 0) & (b >= 0)
    if not there.all():
        a, b = a[there], b[there]
    return nodes.take(order), Leads(len(nodes), a, b)


def groups(out: Leads | list[list[int]]) -> array:
    """For each node the number of its group of nodes that reach one another; a group's number comes after those of all that it leads to.

    A depth-first walk with a stack of its own, as ways may be long."""
    n, held, path, found = len(out), array("i"), [], 0
    order, low, group = (array("i", [k]) * n for k in (0, 0, -1))
    seen = 0
    for start in range(n):
        if order[start]:
            continue
        path.append((start, iter(out[start])))
        while path:
            x, rest = path[-1]
            if not order[x]:
                seen += 1
                order[x] = low[x] = seen
                held.append(x)
            for y in rest:
                if not order[y]:
                    path.append((y, iter(out[y])))
                    break
                if group[y] < 0:
                    low[x] = min(low[x], order[y])
            else:
                path.pop()
                if path:
                    low[path[-1][0]] = min(low[path[-1][0]], low[x])
                if low[x] == order[x]:
                    while group[x] < 0:
                        group[held.pop()] = found
                    found += 1
    return group


def chains(out: Leads | list[list[int]], group: array) -> array:
    """Longest chain of groups below each group."""
    below = array("i", [0]) * (max(group, default=-1) + 1)
    for x in np.argsort(np.asarray(group, np.int32), kind="stable"):  # what a group leads to has smaller numbers
        g = group[x]
        for y in out[x]:
            if group[y] != g and below[group[y]] >= below[g]:
                below[g] = below[group[y]] + 1
    return below


def ways_back(out: Leads | list[list[int]]) -> array:
    """Length of the shortest way from each node back to itself; 0 without one."""
    found = array("i")
    for start in range(len(out)):
        level, seen, d, back = [start], {start}, 0, 0
        while level and not back:
            d += 1
            step = []
            for x in level:
                for y in out[x]:
                    if y == start:
                        back = d
                    elif y not in seen:
                        seen.add(y)
                        step.append(y)
            level = step
        found.append(back)
    return found


def _one_task(edges: DataFrame, solve, columns: str) -> DataFrame:
    """solve over all edges, in one task: (node, ...)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        src, dst = [], []
        for b in batches:
            if b.num_rows:
                src.append(b.column(0))
                dst.append(b.column(1))
        if src:
            nodes, out = _numbered(src, dst)
            yield from pa.table([nodes, *solve(nodes, out)], names=["node", *(c.split()[0] for c in columns.split(", "))]).to_batches(BATCH_ROWS)

    return edges.select("src", "dst").coalesce(1).mapInArrow(run, f"node {edges.schema['src'].dataType.simpleString()}, {columns}")


def _solved(nodes: pa.Array, out: Leads) -> list[pa.Array]:
    group = groups(out)
    own = np.asarray(group, np.int32)
    least = np.full(max(group, default=-1) + 1, len(nodes), np.int32)
    np.minimum.at(least, own, np.arange(len(nodes), dtype=np.int32))
    return [nodes.take(pa.array(least[own])), pa.array(np.asarray(chains(out, group), np.int32)[own])]


def _back(nodes: pa.Array, out: Leads) -> list[pa.Array]:
    return [pa.array(np.asarray(ways_back(out), np.int32))]


def solved(edges: DataFrame) -> DataFrame:
    """(node, component, depth) of a graph that one task solves."""
    return _one_task(edges, _solved, f"component {edges.schema['src'].dataType.simpleString()}, depth int")


def on_cycles(edges: DataFrame) -> DataFrame:
    """Nodes that reach themselves, with the length of the shortest way back. A way back never leaves the node's group, so only edges within groups are followed."""
    e = durable(edges.select("src", "dst").distinct())
    group = durable(mutual(e))
    at = group.join(e.withColumnRenamed("src", "node"), "node").withColumnRenamed("node", "src").withColumnRenamed("component", "from_")
    inner = durable(at.join(group.withColumnRenamed("node", "dst"), "dst").where("from_ = component").select("src", "dst", "component"))
    steps = inner.groupBy("component").agg((F.count("*") * F.count_distinct("src")).alias("n")).agg(F.sum("n")).first()[0] or 0
    if steps <= ONE_TASK_STEPS and _of_one_task(inner):
        return _one_task(inner, _back, "length int").where("length > 0")
    inner = inner.select("src", "dst")
    first = inner.select(F.col("src").alias("start"), F.col("dst").alias("start_next"))
    reach = closure(inner, first.select(F.col("start_next").alias("start")).distinct(), None)
    return first.join(reach, (reach.start == first.start_next) & (reach.node == first.start)).groupBy(first.start.alias("node")).agg((F.min("depth") + 1).alias("length"))


def depths(edges: DataFrame) -> DataFrame:
    """(node, depth): the longest chain below every node, where nodes that reach one another count as one.

    Beyond one task the groups' edges are peeled: of the edges whose end has a chain of k below it, the starts have one of k + 1, so
    each round takes the edges into the nodes of the round before, and a node's depth is the last round that it is in."""
    e = durable(edges.select("src", "dst").distinct())
    if _of_one_task(e):
        return solved(e).select("node", "depth")
    group = durable(mutual(e))
    ends = e.join(group.select(F.col("node").alias("src"), F.col("component").alias("a")), "src").join(group.select(F.col("node").alias("dst"), F.col("component").alias("b")), "dst")
    rest = durable(ends.where("a <> b").select("a", "b").distinct())
    level = durable(group.select("component").distinct())
    rounds = [level.withColumn("depth", F.lit(0))]
    for d in count(1):
        rest = durable(rest.join(level.withColumnRenamed("component", "b"), "b", "left_semi"))  # chains through other ends are over
        if _of_one_task(rest):  # what is left begins where a chain of d - 1 ends
            rounds.append(solved(rest.select(F.col("a").alias("src"), F.col("b").alias("dst"))).select(F.col("node").alias("component"), (F.col("depth") + (d - 1)).alias("depth")))
            break
        level = durable(rest.select(F.col("a").alias("component")).distinct())
        if level.isEmpty():
            break
        rounds.append(level.withColumn("depth", F.lit(d)))
    deepest = reduce(DataFrame.unionByName, rounds).groupBy("component").agg(F.max("depth").alias("depth"))
    return group.join(deepest, "component").select("node", "depth")


def mutual(edges: DataFrame) -> DataFrame:
    """(node, component): nodes that reach one another carry their group's smallest node.

    No pairs of nodes are made. Every node takes the least hash among those that reach it; the nodes of a colour
    that also reach the node it comes from are a group. Edges between colours or to a found group can't lie on a cycle and
    go, and the rest is coloured again. The least of random hashes halves what is left on average, so rounds are few."""
    e = durable(edges.select("src", "dst").distinct())
    if _of_one_task(e):
        return solved(e).select("node", "component")
    nodes = e.select(F.col("src").alias("node")).unionByName(e.select(F.col("dst").alias("node"))).distinct()
    rest, found = _trimmed(durable(e.where("src <> dst"))), None
    while not rest.isEmpty():
        if _of_one_task(rest):
            last = durable(solved(rest).where("node <> component").select("node", F.col("component").alias("root")))
            last = last.unionByName(last.select(F.col("root").alias("node"), "root").distinct())
            found = last if found is None else found.unionByName(last)
            break
        colour = _spread(rest, "src", "dst", durable(rest.select(F.col("src").alias("node")).unionByName(rest.select(F.col("dst").alias("node"))).distinct().withColumn("c", F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("root")))))
        coloured = rest.join(colour.select(F.col("node").alias("src"), F.col("c").alias("sc")), "src").join(colour.select(F.col("node").alias("dst"), F.col("c").alias("dc")), "dst")
        same = durable(coloured.where("sc = dc").select("src", "dst"))
        back = _spread(same, "dst", "src", durable(colour.where("node = c.root")))
        group = durable(back.select("node", F.col("c.root").alias("root")))
        found = group if found is None else found.unionByName(group)
        gone = group.select("node")
        rest = durable(same.join(gone.withColumnRenamed("node", "src"), "src", "left_anti").join(gone.withColumnRenamed("node", "dst"), "dst", "left_anti"))
    if found is None:
        return nodes.withColumn("component", F.col("node"))
    least = found.groupBy("root").agg(F.min("node").alias("least"))
    grouped = found.join(least, "root").select("node", "least")
    return nodes.join(grouped, "node", "left").select("node", F.coalesce("least", "node").alias("component"))


def _trimmed(edges: DataFrame, rounds: int = 4) -> DataFrame:
    """Edges without those whose start nothing leads to or whose end leads nowhere: they lie on no cycle."""
    for _ in range(rounds):
        n = edges.count()
        edges = durable(edges.join(edges.select(F.col("dst").alias("src")).distinct(), "src", "left_semi").join(edges.select(F.col("src").alias("dst")).distinct(), "dst", "left_semi"))
        if edges.count() == n:
            break
    return edges


def _spread(edges: DataFrame, start: str, end: str, known: DataFrame) -> DataFrame:
    """The least colour c among each node's own and those that come to it along the edges; nodes without one get the first that comes."""
    state = known.select("node", "c", F.lit(True).alias("fresh"))
    while True:
        come = edges.join(state.where("fresh").select(F.col("node").alias(start), "c"), start).groupBy(F.col(end).alias("node")).agg(F.min("c").alias("new"))
        fresh = F.col("new").isNotNull() & (F.col("c").isNull() | (F.col("new") < F.col("c")))
        state = durable(state.drop("fresh").join(come, "node", "full").select("node", F.least("c", "new").alias("c"), fresh.alias("fresh")))
        if state.where("fresh").isEmpty():
            return state.drop("fresh")


def external_references(edges: DataFrame, starts: DataFrame, external: DataFrame) -> DataFrame:
    """(start, node, depth) of external nodes on the way from a start other than itself. The search goes back from the external nodes."""
    back = closure(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")), external.select(F.col("node").alias("start")), None).where("depth > 0")
    return back.select(F.col("node").alias("start"), F.col("start").alias("node"), "depth").join(starts.select("start").distinct(), "start", "left_semi")


def stats(edges: DataFrame) -> DataFrame:
    """Terms, edges, the longest chain, terms with a chain of three and more below them, terms on cycles."""
    e = durable(edges.select("src", "dst").distinct())
    a = e.agg(F.count("*").alias("edges"))
    of_one = durable(solved(e)) if _of_one_task(e) else None
    b = (depths(e) if of_one is None else of_one).agg(F.count("*").alias("terms"), F.max("depth").alias("max_depth"), F.count_if(F.col("depth") >= 3).alias("deep"))
    group = durable(mutual(e)) if of_one is None else of_one.select("node", "component")
    members = group.groupBy("component").agg(F.count("*").alias("n"))
    loops = e.where("src = dst").select(F.col("src").alias("node"))
    c = group.join(members.where("n > 1"), "component", "left_semi").select("node").unionByName(loops).distinct().agg(F.count("*").alias("on_cycles"))
    return a.join(b).join(c)  # one row each


def governing(edges: DataFrame) -> DataFrame:
    """Sections and the first three that override them, joined in order. edges: src yields to dst, ix orders."""
    n = F.row_number().over(W.partitionBy("src").orderBy("ix", "dst"))
    first = edges.withColumn("n", n).where("n <= 3").groupBy("src").agg(F.sort_array(F.collect_list(F.struct("n", "dst"))).alias("w"))
    return first.select("src", F.array_join(F.transform("w", lambda x: x["dst"].cast("string")), "; ").alias("basis"))
