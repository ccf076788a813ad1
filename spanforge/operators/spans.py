"""Operators on spans: half-open [start, end) offsets, in code points from 0, into one text a document.

Joins on spans always carry the document as an equality key, so Spark shuffles by document and
checks the range within it; `contained` also cuts long documents into buckets of offsets, so one
huge document is not one task. What is read off a text alone is read in one pass over it, where its row is.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKET = 1 << 14


ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "decimal(12,4)": pa.decimal128(12, 4)}
#: Rows and characters of texts after which what was read goes on.
ROWS, CHARS = 20_000, 1 << 24


def of_each(docs: DataFrame, keys: list[str], text: str, read: Callable[[str], Iterable[tuple]], ddl: str) -> DataFrame:
    """keys, and what read finds in a row's text, a row each; null texts hold nothing. Rows stay where they are: no shuffle."""
    names, kinds = zip(*(p.split() for p in ddl.split(", ")), strict=True)
    head = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, rows, chars = [], [], 0

            def found() -> pa.RecordBatch:
                own = [b.column(k).take(pa.array(at)) for k in range(len(keys))]
                return pa.RecordBatch.from_arrays([*own, *(pa.array(c, ARROW[k]) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], names=[*keys, *names])

            for k, t in enumerate(b.column(len(keys))):
                t = t.as_py()
                if t is None:
                    continue
                n = len(rows)
                rows.extend(read(t))
                at += [k] * (len(rows) - n)
                chars += len(t)
                if rows and (len(rows) >= ROWS or chars >= CHARS):
                    yield found()
                    at, rows, chars = [], [], 0
            if rows:
                yield found()

    return docs.select(*keys, text).mapInArrow(run, f"{head}, {ddl}")


def compiled(pattern: str) -> re.Pattern:
    """A pattern as the engine's own functions read it: classes by letters of ASCII."""
    return re.compile(pattern, re.ASCII)


def matches(docs: DataFrame, pattern: str, keys: list[str], text: str = "text") -> DataFrame:
    """keys, ix, match, start, end of every match of a pattern that can't match nothing."""
    p = compiled(pattern)
    return of_each(docs, keys, text, lambda t: [(k, m[0], m.start(), m.end()) for k, m in enumerate(p.finditer(t))], "ix int, match string, start long, end long")


def sliding(docs: DataFrame, keys: list[str], window: int = 6_000, stride: int = 4_200, text: str = "text") -> DataFrame:
    """Windows of a text, each a stride after the last, until one reaches the end."""
    n = F.length(text)
    last = F.ceil(F.greatest(F.lit(0), n - window) / stride) * stride
    out = docs.where(n > 0).select(*keys, n.alias("n"), F.posexplode(F.sequence(F.lit(0), last.cast("int"), F.lit(stride))).alias("ix", "start"))
    return out.select(*keys, "ix", "start", F.least(F.col("start") + window, "n").alias("end"))


def pieces(spans: DataFrame, most: int) -> DataFrame:
    """Spans longer than most, cut into parts of that length."""
    cut = F.sequence(F.lit(0), F.greatest(F.lit(0), F.col("end") - F.col("start") - 1).cast("int"), F.lit(most))
    rest = [c for c in spans.columns if c not in ("start", "end")]
    out = spans.select(*rest, F.col("start").alias("s"), F.col("end").alias("e"), F.posexplode(cut).alias("part", "at"))
    return out.select(*rest, "part", (F.col("s") + F.col("at")).alias("start"), F.least(F.col("s") + F.col("at") + most, "e").alias("end"))


def merge(spans: DataFrame, keys: list[str], gap: int = 0) -> DataFrame:
    """Spans that overlap, or lie at most gap apart, as one; n counts those merged."""
    before = W.partitionBy(*keys).orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1)
    upto = W.partitionBy(*keys).orderBy("start", "end").rangeBetween(W.unboundedPreceding, W.currentRow)  # equal spans stay together
    fresh = F.coalesce((F.col("start") > F.max("end").over(before) + gap).cast("int"), F.lit(1))
    islands = spans.withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(upto))
    return islands.groupBy(*keys, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n")).drop("island")


def coverage(spans: DataFrame, docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Characters under spans, over the length of the text."""
    under = merge(spans, keys).groupBy(*keys).agg(F.sum(F.col("end") - F.col("start")).alias("covered"))
    out = docs.select(*keys, F.length(text).cast("long").alias("length")).join(under, keys, "left")
    covered = F.coalesce("covered", F.lit(0))
    return out.select(*keys, "length", covered.alias("covered"), F.try_divide(covered.cast("double"), F.col("length").cast("double")).alias("share"))


def closed(marks: DataFrame, docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Markers (keys, start, ...) with end: the next marker's start, or the end of the text."""
    w = W.partitionBy(*keys).orderBy("start")
    named = marks.withColumn("following", F.lead("start").over(w)).drop("end")
    return named.join(docs.select(*keys, F.length(text).alias("n")).hint("merge"), keys).withColumn("end", F.coalesce("following", "n")).drop("following", "n")


def locate(points: DataFrame, marks: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """As-of lookup: each point gets the value of the last marker at or before it, else null.

    Points and markers of a document are put in one order and the last marker carried on: one
    shuffle, no pairs."""
    p = points.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(marks.schema[value].dataType).alias("_v"), F.struct(*points.columns).alias("_row"))
    m = marks.select(*keys, F.col("start").alias("_at"), F.lit(0).alias("_kind"), F.col(value).alias("_v"), F.lit(None).cast(p.schema["_row"].dataType).alias("_row"))
    w = W.partitionBy(*keys).orderBy("_at", "_kind").rowsBetween(W.unboundedPreceding, 0)
    return p.unionByName(m).withColumn(value, F.last("_v", ignorenulls=True).over(w)).where("_kind = 1").select(*(F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in points.columns), value)


def contained(inner: DataFrame, outer: DataFrame, keys: list[str], how: str = "inner", bucket: int = BUCKET) -> DataFrame:
    """Pairs of an inner and an outer span of the same document, the inner within the outer.

    outer's own columns must not share names with inner's but for keys; its bounds are outer_start
    and outer_end. It is repeated for every bucket of offsets that it touches, the inner span falls
    into one."""
    b = outer.withColumn("_b", F.explode(F.sequence(F.floor(F.col("outer_start") / bucket), F.floor(F.greatest(F.col("outer_start"), F.col("outer_end") - 1) / bucket))))
    a = inner.withColumn("_b", F.floor(F.col("start") / bucket))
    b = b.withColumnsRenamed({k: f"_of_{k}" for k in (*keys, "_b")})
    on = [F.col(k) == F.col(f"_of_{k}") for k in (*keys, "_b")] + [F.col("start") >= F.col("outer_start"), F.col("end") <= F.col("outer_end")]
    return a.join(b, on, how).drop("_b", *(f"_of_{k}" for k in (*keys, "_b")))


def within(a: DataFrame, b: DataFrame, keys: list[str], pad: int) -> DataFrame:
    """Pairs where b's point `at` lies no more than pad before a's start or after its end."""
    on = [a[k] == b[k] for k in keys] + [b.at >= a.start - pad, b.at <= a.end + pad]
    out = a.join(b, on)
    for k in keys:
        out = out.drop(b[k])
    return out


def first_of(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in an order that must be total."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def contents_dropped(marks: DataFrame, keys: list[str]) -> DataFrame:
    """Section markers without a table of contents at the front: while each id still recurs later,
    a marker is an entry of the contents; the body starts at the first whose id does not recur
    again or had been seen already."""
    w = W.partitionBy(*keys, "section").orderBy("start")
    seen = marks.withColumns({"_k": F.row_number().over(w), "_n": F.count("*").over(W.partitionBy(*keys, "section"))})
    body = F.min(F.when((F.col("_k") > 1) | (F.col("_n") == 1), F.col("start"))).over(W.partitionBy(*keys))
    return seen.withColumn("_body", body).where(F.col("start") >= F.col("_body")).drop("_k", "_n", "_body")


def shifted(edits: DataFrame, keys: list[str]) -> DataFrame:
    """Edits (start, end, new_length) with the offset change that holds from their end on."""
    w = W.partitionBy(*keys).orderBy("start").rowsBetween(W.unboundedPreceding, 0)
    return edits.withColumn("shift", F.sum(F.col("new_length") - (F.col("end") - F.col("start"))).over(w))
