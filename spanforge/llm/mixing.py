"""Mixing sources to target weights by min-cost flow.

A document may belong to several sources. Documents are aggregated by membership pattern; the
patterns and the sources are the two sides of a network in which words flow from a pattern to the
sources it belongs to. A pattern's first pass over its words costs 1 a word, each further one as
much again and more (convex), and the flow that fills the quotas at least cost says how many
words each pattern gives. Documents are then selected in the order of a seeded hash.

A selection never sorts a source: it narrows the range of hash values in which a pattern's cut
lies, by counts over 4096 bins a round, until the range holds a few hundred documents. Those
before it are taken, those after are not, and within it documents are taken in hash order up to
the cut, around which the choice of the last few is the one that comes nearest to the quota.

Cases: a null text has size 0 and takes 0 words; a null source is a source of its own and comes
last; ties of the hash go by id and text; a source without words has target 0; an empty table
gives an empty result; other columns are passed over. Rows that agree in id and text are
interchangeable; very long texts count whole. The network is solved on the driver, so it has at most
MAX_PATTERNS patterns besides the sources: where there are more, those of the fewest words count
for one of their sources each, the neediest; the mix still takes from all of their documents.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.llm.common import Shared

MAX_PATTERNS = 20_000
BINS = 4096
POOL = 256
TOP = 1 << 63
SWAPS = 12


def words_in(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def pick_key(seed: int, doc_id: str = "doc_id", text: str = "text") -> Column:
    return F.xxhash64(F.lit(seed), F.col(doc_id).cast("string"), F.col(text))


def targets(sizes: dict[str | None, int], weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> dict[str | None, float]:
    """Each source's target: weights repeat over the sources in code point order, null last; what
    exceeds most times a source's size is shared anew among the others."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out: dict[str | None, float] = {}
    left, open_ = share * sum(sizes.values()), list(order)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if unit * weight[s] > most * sizes[s]]
        if not over:
            return out | {s: unit * weight[s] for s in open_}
        out |= {s: most * sizes[s] for s in over}
        left -= sum(most * sizes[s] for s in over)
        open_ = [s for s in open_ if s not in over]
    return out


def min_cost_flow(supply: list[int], belongs: list[list[int]], quota: list[int], passes: int) -> list[int]:
    """Words that each pattern gives when the quotas are filled as far as possible at least cost.

    supply[i] words of pattern i can be used up to passes times, the k-th time at cost k a word;
    belongs[i] lists the sources that it can feed. All that costs lies on the edges from the start, and
    there the same for all patterns, so the shortest augmenting paths of one cost are those of a
    maximum flow: one pass after the other gets its capacity, and the flow is made maximal by
    blocking flows on levels."""
    n, m = len(supply), len(quota)
    s, t = n + m, n + m + 1
    graph: list[list[list]] = [[] for _ in range(n + m + 2)]  # [to, capacity, place of the reverse]

    def edge(a: int, b: int, capacity: int) -> list:
        graph[a].append([b, capacity, len(graph[b])])
        graph[b].append([a, 0, len(graph[a]) - 1])
        return graph[a][-1]

    first = [edge(s, i, 0) for i in range(n)]
    for i in range(n):
        for j in belongs[i]:
            edge(i, n + j, passes * supply[i])
    for j in range(m):
        edge(n + j, t, quota[j])

    def levels() -> list[int]:
        level = [-1] * (n + m + 2)
        level[s], queue = 0, deque([s])
        while queue:
            a = queue.popleft()
            for b, capacity, _ in graph[a]:
                if capacity and level[b] < 0:
                    level[b] = level[a] + 1
                    queue.append(b)
        return level

    for _ in range(passes):
        for i in range(n):
            first[i][1] += supply[i]
        while (level := levels())[t] >= 0:
            at, path = [0] * (n + m + 2), []
            while True:  # a depth-first walk that gives up an edge once it leads nowhere
                a = path[-1][0] if path else s
                if a == t:
                    give = min(e[1] for e in path)
                    for e in path:
                        e[1] -= give
                        graph[e[0]][e[2]][1] += give
                    path = path[: next(k for k, e in enumerate(path) if not e[1])]
                elif at[a] < len(graph[a]):
                    e = graph[a][at[a]]
                    if e[1] and level[e[0]] == level[a] + 1:
                        path.append(e)
                    else:
                        at[a] += 1
                elif path:
                    path.pop()
                    at[path[-1][0] if path else s] += 1
                else:
                    break
    return [graph[e[0]][e[2]][1] for e in first]


def subset_sums(sizes: list[int]) -> np.ndarray:
    """Sums of all choices; bit i of a place says whether size i is in."""
    out = np.zeros(1, np.int64)
    for x in sizes:
        out = np.concatenate([out, out + x])
    return out


def chosen(sizes: list[int], want: int) -> list[int]:
    """1 for each size that is taken: all up to the cut but for the last SWAPS before it; of those and as many
    behind it, the choice whose sum comes nearest to what is wanted, from below (of equal ones the first)."""
    cut, total = 0, 0
    while cut < len(sizes) and total + sizes[cut] <= want:
        total += sizes[cut]
        cut += 1
    low, high = max(0, cut - SWAPS), min(len(sizes), cut + SWAPS)
    rest = want - sum(sizes[:low])
    before, behind = subset_sums(sizes[low:cut]), subset_sums(sizes[cut:high])
    order = np.argsort(before, kind="stable")
    behind_fits = np.flatnonzero(behind <= rest)
    k = np.searchsorted(before[order], rest - behind[behind_fits], side="right") - 1
    best = int((behind[behind_fits] + before[order][k]).argmax())
    b = int(behind_fits[best])
    top = before[order][k[best]]
    a = int(order[np.searchsorted(before[order], top, side="left")])
    return [1] * low + [a >> i & 1 for i in range(cut - low)] + [b >> i & 1 for i in range(high - cut)] + [0] * (len(sizes) - high)


def folded(rows: DataFrame, patterns: DataFrame, need: dict[str | None, float]) -> tuple[DataFrame, DataFrame]:
    """Rows and patterns where all but the MAX_PATTERNS patterns of the most words belong to one of their sources, the one
    that needs most for its size. Every document stays in the mix, and no source loses words that only it has."""
    spark = rows.sparkSession
    large = patterns.orderBy(F.desc("words"), "members").limit(MAX_PATTERNS).select(F.col("members").alias("large"))
    needs = spark.createDataFrame([(s, -v) for s, v in need.items()], "source string, need double")
    small = patterns.join(large, patterns.members.eqNullSafe(F.col("large")), "left_anti")
    ranked = small.select("members", F.explode(F.array_distinct("members")).alias("m")).join(F.broadcast(needs), F.col("m").eqNullSafe(F.col("source")))  # the sources
    to = ranked.groupBy("members").agg(F.min(F.struct("need", "m")).alias("best")).select(F.col("members").alias("of"), F.array("best.m").alias("to"))
    moved = [df.join(to, df.members.eqNullSafe(F.col("of")), "left").withColumn("members", F.coalesce("to", "members")).drop("of", "to") for df in (rows, patterns)]
    return moved[0], moved[1].groupBy("members").agg(F.sum("words").alias("words"), F.sum("n").alias("n"))


def mix_sources(docs: DataFrame, members: Column, seed: int = 17, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, doc_id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Two tables: one row for each row of docs (doc_id, key, members, size, copies, taken = copies * size,
    and the columns of carry as c0, c1 and so on), and one for each source (source, source_size, target).

    members: an array column, the sources of a document; key: pick_key(seed, doc_id, text)."""
    spark = docs.sparkSession
    shared = Shared(spark)
    key = pick_key(seed, doc_id, text)
    carried = [f"c{i}" for i in range(len(carry))]
    rows = shared.write(docs.select(F.col(doc_id).cast("long").alias("doc_id"), key.alias("key"), members.alias("members"), words_in(text).alias("size"), *(F.col(c).alias(n) for c, n in zip(carry, carried, strict=True))))
    # the order of selection: 63 bits of another hash
    rows = rows.withColumn("u", F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1), "key"), 1))
    patterns = shared.write(rows.groupBy("members").agg(F.sum("size").alias("words"), F.count("*").alias("n")))
    by_source = patterns.select(F.explode(F.array_distinct("members")).alias("source"), "words").groupBy("source").agg(F.sum("words").alias("words")).collect()  # the sources
    sizes: dict[str | None, int] = {r.source: r.words for r in by_source}
    aims = targets(sizes, weights, share, most)
    if patterns.count() > MAX_PATTERNS:
        rows, patterns = folded(rows, patterns, {s: aims[s] / max(1, sizes[s]) for s in aims})
    totals = patterns.collect()  # MAX_PATTERNS and the sources bound it
    totals.sort(key=lambda r: [(s is None, s or "") for s in r.members])
    places = {s: j for j, s in enumerate(aims)}
    flow = min_cost_flow([r.words for r in totals], [sorted(places[s] for s in set(r.members)) for r in totals], [round(a) for a in aims.values()], most)
    full = {i: (f // r.words if r.words else 1) for i, (f, r) in enumerate(zip(flow, totals, strict=True))}
    rest = {i: f - full[i] * r.words for i, (f, r) in enumerate(zip(flow, totals, strict=True))}
    numbered = spark.createDataFrame([(i, list(r.members)) for i, r in enumerate(totals)], "pattern int, members array<string>")
    tagged = rows.join(F.broadcast(numbered.withColumnRenamed("members", "of")), rows.members.eqNullSafe(F.col("of"))).drop("of")  # MAX_PATTERNS bounds it
    # narrow each pattern's cut; state: pattern -> (low, high, words still wanted before the cut)
    state = {i: (0, TOP, rest[i]) for i in rest if rest[i] > 0}
    wide = {i for i in state if totals[i].n > BINS}
    while wide:
        frame = spark.createDataFrame([(i, state[i][0], max(1, -(-(state[i][1] - state[i][0]) // BINS)), state[i][1] - 1) for i in sorted(wide)], "pattern int, low long, step long, top long")
        seen = tagged.join(F.broadcast(frame), "pattern").where("u between low and top").groupBy("pattern", "low", "step", F.expr("(u - low) div step").alias("bin")).agg(F.sum("size").alias("words"), F.count("*").alias("n"))
        want = spark.createDataFrame([(i, state[i][2]) for i in sorted(wide)], "pattern int, want long")
        order = W.partitionBy("pattern").orderBy("bin").rowsBetween(W.unboundedPreceding, 0)  # BINS bounds it
        run = seen.join(F.broadcast(want), "pattern").withColumns({"to": F.sum("words").over(order), "many": F.sum("n").over(order)}).withColumn("cut", F.col("to") > F.col("want"))
        cut = run.groupBy("pattern", "low", "step").agg(F.min(F.when(F.col("cut"), F.struct("bin", (F.col("to") - F.col("words")).alias("before"), "n", (F.col("many") - F.col("n")).alias("earlier")))).alias("c"))
        last = run.join(cut, ["pattern", "low", "step"]).where(F.col("many") - F.col("c.earlier") >= POOL).groupBy("pattern").agg(F.min("bin").alias("last"))
        for r in cut.join(last, "pattern", "left").collect():
            low, high, want_ = state[r.pattern]
            end = high if r.last is None else min(high, r.low + (max(r.last, r.c.bin) + 1) * r.step)
            state[r.pattern] = (r.low + r.c.bin * r.step, end, want_ - r.c.before)
            if r.c.n <= BINS or r.step == 1:
                wide.discard(r.pattern)
    cuts = spark.createDataFrame([(i, full[i], *((low, high - 1, want_) if (low, high, want_) != (0, 0, 0) else (0, -1, 0))) for i in sorted(full) for low, high, want_ in [state.get(i, (0, 0, 0))]], "pattern int, full long, low long, top long, want long")
    placed = tagged.join(F.broadcast(cuts), "pattern")
    outside = placed.where("not u between low and top").withColumn("copies", F.col("full") + F.when(F.col("u") < F.col("low"), 1).otherwise(0))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["u", "key", "doc_id", "size"], na_position="first")
        out = chosen(pdf["size"].tolist(), int(pdf.want.iloc[0]))
        return pdf.assign(copies=pdf.full + out)[["doc_id", "key", "members", "size", "copies", *carried]]

    fields = ", ".join(["doc_id long, key long, members array<string>, size long, copies long", *(f"{c} {kind}" for c, kind in rows.dtypes if c in carried)])
    inside = placed.where("u between low and top").select("pattern", "doc_id", "key", "members", "size", "u", "full", "want", *carried).groupBy("pattern").applyInPandas(fill, fields)
    out = outside.select("doc_id", "key", "members", "size", F.col("copies").cast("long").alias("copies"), *carried).unionByName(inside)
    dims = spark.createDataFrame([(s, int(sizes[s]), float(aims[s])) for s in aims], "source string, source_size long, target double")
    return out.withColumn("taken", F.col("copies") * F.col("size")), dims
