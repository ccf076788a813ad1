"""Vectors as codes of their parts' nearest codebook entries: Lloyd's rounds pruned by Elkan's bounds.

A vector is cut into parts, each with a codebook of its own. Every row keeps, for each part, the entry
that it is assigned to, an upper bound of the distance to it and one lower bound of the distance to
every entry of the codebook; they are written with the rows after each round and read in the next.
When entries move, upper bounds grow by the movement of the row's own entry and lower bounds shrink by
that of theirs. An entry is passed over only if its lower bound, or half its distance to the row's
own, is strictly larger than the upper bound; all others are compared by exact squared distances of
integers, ties to the lower index. Bounds are rounded outwards: lower bounds are kept as 255ths of
their row's and part's largest, rounded down, a byte for an entry.

Sums and counts of each entry are added up in each task before they are shuffled. What the driver holds
are the codebooks: entries x components numbers, however many vectors there are. No row moves between
tasks until errors are added up by label.

Cases: rows whose vector is null or holds null or non-finite components are dropped, and so are rows
whose vector has not as many components as that of the smallest kept vec_id; if parts don't divide it,
zeros are added at its end. Null ids come last, rows that repeat an id go by their components; with
fewer rows than entries the codebooks have as many entries as there are rows. Components beyond 2**40
after scaling count as 2**40, errors beyond the range of a long as its end. Rows that tie or repeat
get equal codes; null labels are one label; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.llm.common import Shared, hot_join

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
MOST, LONG = 1 << 40, (1 << 63) - 1
#: Relative slack of a rounded bound.
SLACK = 1e-9

STATE = pa.schema([
    ("vec_id", pa.int64()), ("label", pa.string()), ("v", pa.list_(pa.int64())), ("code", pa.binary()), ("upper", pa.binary()), ("lower", pa.binary()), ("unit", pa.binary()), ("error", pa.list_(pa.int64())),
    ("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.int64())),
])
STATE_DDL = "vec_id long, label string, v array<long>, code binary, upper binary, lower binary, unit binary, error array<long>, part int, entry int, n long, total array<long>"


def usable(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """vec_id, label as text and integer components of the rows whose vectors are whole."""
    v = F.transform(F.col(embedding), lambda x: F.floor(F.greatest(F.least(x.cast("double") * SCALE, F.lit(float(MOST))), F.lit(float(-MOST)))).cast("long"))
    whole = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & ~x.isin(float("inf"), float("-inf")))
    name = F.when(F.col(label).isNull(), "").otherwise(F.concat(F.lit("="), F.col(label).cast("string")))
    return vectors.where(F.col(embedding).isNotNull() & whole).select(F.col(vec_id).cast("long").alias("vec_id"), name.alias("label"), v.alias("v"))


def cut(rows: list[list[int]], parts: int) -> np.ndarray:
    """Vectors x parts x components."""
    x = np.asarray(rows, np.int64).reshape(len(rows), -1)
    short = -x.shape[1] % parts
    return np.pad(x, ((0, 0), (0, short))).reshape(len(rows), parts, -1)


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of paired rows: longs, or Python's integers where longs don't reach."""
    most = max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)))
    kind = np.int64 if a.shape[-1] * (2 * most) ** 2 <= LONG else object
    d = a.astype(kind) - b.astype(kind)
    return (d * d).sum(axis=-1)


def table(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all entries; doubles hold them while they are exact."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if x.shape[1] * (2 * most) ** 2 < 1 << 53:
        a, b = x.astype(float), entries.astype(float)
        return ((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    return np.stack([exact(x, np.broadcast_to(e, x.shape)) for e in entries], axis=1)


def root(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(float))


def packed(lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower bounds as 255ths, rounded down, of the largest in each row."""
    unit = lower.max(axis=1, initial=0) / 255
    unit[unit == 0] = 1
    return np.floor(lower / unit[:, None] * (1 - SLACK)).clip(0, 255).astype(np.uint8), unit


class Round:
    """Assigns rows to entries that moved, or to the first ones, and adds up what belongs to each entry."""

    def __init__(self, now: np.ndarray, before: np.ndarray | None):
        self.now = now
        self.total = np.zeros(now.shape, object)
        self.n = np.zeros(now.shape[:2], np.int64)
        if before is not None:
            self.moved = [root(exact(a, b)) * (1 + SLACK) for a, b in zip(now, before, strict=True)]
            # half the distances between entries
            self.apart = [root(table(a, a)) * (0.5 - SLACK) for a in now]

    def first(self, x: np.ndarray, p: int) -> tuple[np.ndarray, ...]:
        d = table(x, self.now[p])
        code = d.argmin(axis=1)
        error = d[np.arange(len(x)), code]
        return code, error, root(d) * (1 - SLACK)

    def again(self, x: np.ndarray, p: int, code: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, ...]:
        entries, rows = self.now[p], np.arange(len(x))
        lower = np.maximum(lower - self.moved[p], 0) * (1 - SLACK)
        upper = (upper + self.moved[p][code]) * (1 + SLACK)
        apart = self.apart[p][code]  # rows x entries
        near = (lower <= upper[:, None]) & (apart <= upper[:, None])
        near[rows, code] = False
        error = exact(x, entries[code])  # the own distance is needed anyway: it is the error, and tightens the bound
        upper = root(error) * (1 + SLACK)
        near &= (lower <= upper[:, None]) & (apart <= upper[:, None])
        i, j = np.nonzero(near)
        d = exact(x[i], entries[j])
        lower[rows, code] = root(error) * (1 - SLACK)
        lower[i, j] = root(d) * (1 - SLACK)
        kind = object if object in (d.dtype, error.dtype) else np.int64
        all_d = np.full(lower.shape, 1 << 200 if kind is object else LONG, kind)  # what is passed over is farther
        all_d[i, j], all_d[rows, code] = d, error
        own = all_d.argmin(axis=1)
        return own, all_d[rows, own], lower

    def add(self, x: np.ndarray, p: int, code: np.ndarray) -> None:
        order = np.argsort(code, kind="stable")
        used, at, n = np.unique(code[order], return_index=True, return_counts=True)
        self.total[p, used] += np.add.reduceat(x[order], at, axis=0)
        self.n[p, used] += n

    def partial(self) -> Iterator[tuple[int, int, int, list[int]]]:
        for p, e in zip(*np.nonzero(self.n), strict=True):
            yield int(p), int(e), int(self.n[p, e]), [int(t) for t in self.total[p, e]]


def assigned(rows: DataFrame, now: np.ndarray, before: np.ndarray | None) -> DataFrame:
    """Rows with codes, bounds and errors against the entries now; and rows of sums for each part and entry."""
    parts, entries, _ = now.shape
    held = rows.sparkSession.sparkContext.broadcast((now, before))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = Round(*held.value)
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            of = {name: b.column(i) for i, name in enumerate(b.schema.names)}
            x = cut(of["v"].to_pylist(), parts)
            codes, errors, bounds, units = np.empty((n, parts), np.uint8 if entries <= 256 else np.uint16), np.empty((n, parts), object), np.empty((n, parts, entries), np.uint8), np.empty((n, parts))
            if "code" in of:
                old = np.frombuffer(b"".join(of["code"].to_pylist()), codes.dtype).reshape(n, parts).astype(np.int64)
                upper = np.frombuffer(b"".join(of["upper"].to_pylist()), "<f8").reshape(n, parts)
                unit = np.frombuffer(b"".join(of["unit"].to_pylist()), "<f8").reshape(n, parts)
                lower = np.frombuffer(b"".join(of["lower"].to_pylist()), np.uint8).reshape(n, parts, entries)
            for p in range(parts):
                own = work.again(x[:, p], p, old[:, p], upper[:, p], lower[:, p] * unit[:, p, None]) if "code" in of else work.first(x[:, p], p)
                codes[:, p], errors[:, p] = own[0], own[1]
                bounds[:, p], units[:, p] = packed(own[2])
                work.add(x[:, p], p, own[0])
            uppers = root(errors) * (1 + SLACK)
            out = [of["vec_id"], of["label"], of["v"], *(pa.array([r.tobytes() for r in a], pa.binary()) for a in (codes, uppers, bounds, units)), pa.array([[min(int(e), LONG) for e in r] for r in errors], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*out, *(pa.nulls(n, f.type) for f in list(STATE)[8:])], schema=STATE)
        sums = list(work.partial())
        if sums:
            yield pa.RecordBatch.from_arrays([*(pa.nulls(len(sums), f.type) for f in list(STATE)[:8]), *(pa.array(c, f.type) for c, f in zip(zip(*sums, strict=True), list(STATE)[8:], strict=True))], schema=STATE)

    return rows.mapInArrow(run, STATE_DDL)


def moved(state: DataFrame, now: np.ndarray) -> np.ndarray:
    """The entries at the floors of their rows' means; unused ones stay."""
    width = now.shape[2]
    added = [F.sum(F.col("total")[i].cast("decimal(20,0)")).alias(f"t{i}") for i in range(width)]
    out = now.copy()
    for r in state.where("part is not null").groupBy("part", "entry").agg(F.sum("n").alias("n"), *added).collect():  # a row for each entry
        out[r["part"], r["entry"]] = [int(r[f"t{i}"]) // r["n"] for i in range(width)]
    return out


def compress(vectors: DataFrame, shared: Shared, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray | None]:
    """vec_id, label as text, code, errors by part of every whole vector, as written; and the last codebooks: part, entry, component."""
    rows = usable(vectors, vec_id, embedding, label)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v", "label").limit(entries).select("v").collect()
    if not first:
        return shared.write(rows.select("vec_id", "label", F.lit("").alias("code"), F.array(F.lit(0).cast("long")).alias("error"))), None
    width = len(first[0]["v"])
    rows = rows.where(F.size("v") == width)
    start = [r["v"] for r in first if len(r["v"]) == width]
    if len(start) < len(first):
        start = [r["v"] for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "v", "label").limit(entries).select("v").collect()]
    now, before, state = cut(start, parts).transpose(1, 0, 2), None, None
    for k in range(rounds + 1):
        new = shared.write(assigned(rows if state is None else state.where("part is null").select("vec_id", "label", "v", "code", "upper", "lower", "unit"), now, before))
        if state is not None:
            shared.drop(state)
        state = new
        if k < rounds:
            before, now = now, moved(state, now)
    return state.where("part is null").select("vec_id", "label", F.lower(F.hex("code")).alias("code"), "error"), now


def digest(codes: DataFrame, books: np.ndarray | None, shared: Shared) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256."""
    text = "" if books is None else ",".join(map(str, books.ravel().tolist()))
    exact_sum = F.aggregate("error", F.lit(0).cast("decimal(38,0)"), lambda a, x: (a + x).cast("decimal(38,0)"))
    most = F.lit(LONG).cast("decimal(38,0)")
    rows = shared.write(codes.select("vec_id", "label", "code", F.least(exact_sum, most).cast("long").alias("error")))
    by_label = rows.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(20,0)")).cast("decimal(38,0)"), most).cast("long").alias("label_error"))
    return hot_join(rows, by_label, "label").select("vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256"))


def _round(k: int) -> str:
    """Assignment k, and the codebook after it."""
    return f"""
a{k} AS MATERIALIZED (SELECT x.vec_id, x.p, min(CAST(list_dot_product(x.c, x.c) - 2 * list_dot_product(x.c, b.c) + list_dot_product(b.c, b.c) AS BIGINT) * {ENTRIES} + b.e) AS m
  FROM parts x JOIN c{k} b ON x.p = b.p GROUP BY ALL),
s{k} AS (SELECT p, e, i, floor(sum(y) / count(*)) AS y FROM (SELECT a.p, a.m % {ENTRIES} AS e, unnest(range(len(x.c))) AS i, unnest(x.c) AS y FROM a{k} a JOIN parts x ON a.vec_id = x.vec_id AND a.p = x.p) GROUP BY ALL),
c{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(s.c, b.c) AS c FROM c{k} b LEFT JOIN (SELECT p, e, list(y ORDER BY i) AS c FROM s{k} GROUP BY ALL) s ON b.p = s.p AND b.e = s.e),"""


SQL = f"""
WITH base AS MATERIALIZED (SELECT vec_id, label, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS DOUBLE) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
parts AS MATERIALIZED (SELECT vec_id, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS c FROM base, range({PARTS}) t(p)),
c0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, c FROM parts QUALIFY e < {ENTRIES}),{"".join(map(_round, range(ROUNDS)))}
last AS MATERIALIZED (SELECT x.vec_id, x.p, min(CAST(list_dot_product(x.c, x.c) - 2 * list_dot_product(x.c, b.c) + list_dot_product(b.c, b.c) AS BIGINT) * {ENTRIES} + b.e) AS m
  FROM parts x JOIN c{ROUNDS} b ON x.p = b.p GROUP BY ALL),
rows AS (SELECT b.vec_id, b.label, l.code, l.error FROM base b JOIN (SELECT vec_id, string_agg(format('{{:02x}}', m % {ENTRIES}), '' ORDER BY p) AS code, CAST(sum(m // {ENTRIES}) AS BIGINT) AS error FROM last GROUP BY vec_id) l ON b.vec_id = l.vec_id),
book AS (SELECT sha256(string_agg(CAST(CAST(y AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS h FROM (SELECT p, e, unnest(range(len(c))) AS i, unnest(c) AS y FROM c{ROUNDS}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT h FROM book) AS codebooks_sha256 FROM rows
"""
