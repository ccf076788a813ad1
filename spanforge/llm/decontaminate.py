"""Benchmark decontamination by a prefix-filtered set join.

Every item is cut into windows of its own words, and a window into shingles. Shingles are ordered
by rarity: the number of documents that hold each is counted over the whole corpus. A window that
is contained to a share t has at least o = ceil(t * k) of its k shingles in the document, so the
document must hold one of the k - o + 1 rarest: only those prefix shingles are looked up. A hit
at shingle offset p of the window and place i of the document bounds where the window can stand
(positional bound), a stretch with room for o shingles must remain (length bound), and the
stretch of the window's size is then verified, word by word where t is 1.

The index of windows is sent to every task, so its size is bounded: window-item pairs are
counted first, and beyond INDEX_PAIRS they are dealt out by hash to blocks that each fit. Each
block scans the documents; what it finds of a document is added up.

Cases: null texts have no words; very long texts are scanned whole; shingles of equal rarity go by their
hash, which changes no result; an item of fewer words than a window is one window, an item
without words none; items with a null id are left out, items that repeat an id count once; rows
of documents that repeat each get their row; an empty benchmark leaves all documents clean; other
columns, whatever their names, are ignored, and an id column may have any type that casts to a string.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.llm.common import Runs, Shared, alnum_hashes, alnum_words, few_at_once, numbered, released

SHINGLE = 5
INDEX_PAIRS = 200_000


def item_windows(benchmark: DataFrame, window: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(words, item_id): every distinct window of the items, words joined by spaces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {"words": [], "item_id": []}
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                w = alnum_words(t or "")
                for p in range(max(1, len(w) - window + 1) if w else 0):
                    out["words"].append(b" ".join(w[p : p + window]))
                    out["item_id"].append(i)
            yield pa.RecordBatch.from_arrays([pa.array(out["words"], pa.binary()), pa.array(out["item_id"], pa.string())], names=["words", "item_id"])

    rows = benchmark.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).alias("text")).where("item_id is not null")
    return rows.mapInArrow(run, "words binary, item_id string").distinct()


def member(values: np.ndarray):
    """A test which of many hashes are among values: a bit table first, then the sorted values."""
    values = np.unique(values)
    bits = max(16, int(8 * max(1, len(values))).bit_length())
    low = np.uint64((1 << bits) - 1)
    there = np.zeros(1 << bits, bool)
    there[(values & low).astype(np.int64)] = True

    def places(h: np.ndarray) -> np.ndarray:
        """Positions in h of hashes among values."""
        at = np.flatnonzero(there[(h & low).astype(np.int64)])
        if not len(at):
            return at
        k = np.searchsorted(values, h[at])
        return at[(k < len(values)) & (values[np.minimum(k, len(values) - 1)] == h[at])]

    return places, values


def shingle_size(m: int, q: int) -> int:
    """Shingles have q words, those of a window of fewer words all of its words."""
    return min(q, m)


class Index:
    """The windows of one block with their prefix shingles."""

    def __init__(self, windows: list[bytes], items: list[list[str]], frequency: dict[int, int], threshold: float, q: int):
        self.windows, self.items, self.threshold = [w.split() for w in windows], items, threshold
        self.shingles: list[np.ndarray] = []
        self.least: list[int] = []
        by: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for n, w in enumerate(self.windows):
            s = shingle_size(len(w), q)
            h = Runs(alnum_hashes(windows[n].decode("utf-8", "surrogatepass"))).of(s)
            distinct = np.unique(h)
            o = max(1, math.ceil(threshold * len(distinct) - 1e-9))
            self.shingles.append(distinct)
            self.least.append(o)
            rare = sorted(distinct.tolist(), key=lambda x: (frequency.get(x, 0), x))[: len(distinct) - o + 1]
            for x in rare:
                for p in np.flatnonzero(h == np.uint64(x)).tolist():
                    by.setdefault((s, x), []).append((n, p))
        self.by = by
        self.sizes = sorted({s for s, _ in by})
        self.places = {s: member(np.array([x for t, x in by if t == s], np.uint64))[0] for s in self.sizes}

    def find(self, text: str, h: np.ndarray) -> set[tuple[int, int]]:
        """(window, first word) of every place of the document where a window is contained. h: its words' hashes."""
        found, tried, words, runs = set(), set(), None, Runs(h)
        for s in self.sizes:
            if s > len(h) or not len(self.places[s](g := runs.of(s))):
                continue
            words = alnum_words(text) if words is None else words
            for i in self.places[s](g).tolist():
                for n, p in self.by[s, int(g[i])]:
                    m = len(self.windows[n])
                    if self.threshold >= 1:
                        starts = range(i - p, i - p + 1)
                    else:  # any stretch of the window's size that covers the shingle
                        starts = range(max(0, i - (m - s)), min(i, max(0, len(words) - m)) + 1)
                    for at in starts:
                        if at < 0 or (n, at) in tried or len(words) - at - s + 1 < self.least[n] or self.threshold >= 1 and at + m > len(words):
                            continue
                        tried.add((n, at))
                        if self.threshold >= 1:
                            ok = words[at : at + m] == self.windows[n]
                        else:
                            ok = len(np.intersect1d(g[at : at + m - s + 1], self.shingles[n])) >= self.least[n]
                        if ok:
                            found.add((n, at))
        return found


def frequencies(docs: DataFrame, shingles: dict[int, np.ndarray]) -> dict[int, int]:
    """Of each shingle of the block, how many texts of the corpus hold it."""
    sent = docs.sparkSession.sparkContext.broadcast(shingles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = {s: member(v) for s, v in sent.value.items()}
        counts = {s: np.zeros(len(values), np.int64) for s, (_, values) in tests.items()}
        for b in batches:
            for t in few_at_once(b.column(0)):
                h = alnum_hashes(t or "")
                runs = Runs(h)
                for s, (places, values) in tests.items():
                    if len(h) >= s and len(at := places(g := runs.of(s))):
                        counts[s][np.searchsorted(values, np.unique(g[at]))] += 1
        for s, (_, values) in tests.items():
            on = np.flatnonzero(counts[s])
            yield pa.RecordBatch.from_arrays([pa.array(values[on].view(np.int64)), pa.array(counts[s][on])], names=["shingle", "n"])

    rows = docs.select("text").mapInArrow(released(run), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).collect()
    return {r.shingle & (1 << 64) - 1: r.n for r in rows}


FOUND = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
FOUND_DDL = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, threshold: float = 1.0, q: int = SHINGLE, index_pairs: int = INDEX_PAIRS, doc_id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and
    the columns of carry as c0, c1 and so on.

    n_hit counts the document's words inside any occurrence of a window; items_sha256 is that of
    the ids of items with an occurrence, as strings, sorted, comma-joined."""
    spark = docs.sparkSession
    shared = Shared(spark)
    windows = shared.write(item_windows(benchmark, window))
    blocks = max(1, math.ceil(windows.count() / index_pairs))
    places: list[str] = []
    if blocks > 1:
        docs, places = numbered(docs, shared)
    carried = [F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *carried, *(F.col(c).alias(f"place{i}") for i, c in enumerate(places)))
    found = []
    for k in range(blocks):
        block = windows.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == k).groupBy("words").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
        block = block.orderBy("words").collect()  # index_pairs bounds it
        listed = [bytes(r.words) for r in block]
        shingles: dict[int, list[np.ndarray]] = {}
        for w in listed:
            h = alnum_hashes(w.decode("utf-8", "surrogatepass"))
            s = shingle_size(len(h), q)
            shingles.setdefault(s, []).append(Runs(h).of(s))
        known = frequencies(rows, {s: np.unique(np.concatenate(v)) for s, v in shingles.items()}) if shingles else {}
        sent = spark.sparkContext.broadcast((listed, [list(r["items"]) for r in block], known))
        if blocks == 1:
            return scan(rows, sent, threshold, q)
        found.append(scan_block(rows.select("text", "place0", "place1"), sent, threshold, q))
    union = found[0]
    for f in found[1:]:
        union = union.unionByName(f)
    hits = union.groupBy("place0", "place1").agg(F.array_distinct(F.flatten(F.collect_list("hit"))).alias("hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    kept = [c for c in rows.columns if c != "text"]
    base = rows.select(*kept, "text").mapInArrow(counted, ", ".join([*(f"`{c}` {kind}" for c, kind in rows.select(*kept).dtypes), "n_words long"]))
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.when(F.col("hit").isNull(), F.lit(0)).otherwise(F.size("hit")).cast("long")
    out = base.join(hits, ["place0", "place1"], "left").withColumns({"n_hit": n_hit, "n_items": F.size(items).cast("long"), "items_sha256": F.sha2(F.array_join(items, ",").cast("binary"), 256), "contaminated": n_hit > 0})
    return out.select("doc_id", *FOUND, *(f"c{i}" for i in range(len(carry))))


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column, text, as its number of words."""
    for b in batches:
        n = pa.array([len(alnum_hashes(t or "")) for t in b.column(b.num_columns - 1).to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], n], names=[*b.schema.names[:-1], "n_words"])


def hits_of(sent, threshold: float, q: int):
    """A function from a text to which of its words are hit and the sorted ids of the items."""
    windows, items, known = sent.value
    index = Index(windows, items, known, threshold, q)

    def hits(text: str | None) -> tuple[np.ndarray, list[str]]:
        h = alnum_hashes(text or "")
        on, ids = np.zeros(len(h), bool), set()
        for n, at in index.find(text or "", h):
            on[at : at + len(index.windows[n])] = True
            ids.update(items[n])
        return on, sorted(ids)

    return hits


def scan(rows: DataFrame, sent, threshold: float, q: int) -> DataFrame:
    """The result rows where one block holds all windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = hits_of(sent, threshold, q)
        for b in batches:
            out = [(len(on), int(on.sum()), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(on.any())) for on, ids in map(hits, few_at_once(b.column(1)))]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[i] for r in out], t) for i, t in enumerate(types)), *b.columns[2:]], names=["doc_id", *FOUND, *b.schema.names[2:]])

    return rows.mapInArrow(released(run), ", ".join(["doc_id long", FOUND_DDL, *(f"`{c}` {kind}" for c, kind in rows.dtypes[2:])]))


def scan_block(rows: DataFrame, sent, threshold: float, q: int) -> DataFrame:
    """What one block of several finds in rows (text, place0, place1): the hit words and the items of those with a hit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = hits_of(sent, threshold, q)
        schema = pa.schema([("place0", pa.string()), ("place1", pa.int64()), ("hit", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])
        for b in batches:
            out = [(f, p, *hits(t)) for t, f, p in zip(*(c.to_pylist() for c in b.columns), strict=True)]
            yield pa.RecordBatch.from_pylist([{"place0": f, "place1": p, "hit": np.flatnonzero(on).tolist(), "items": ids} for f, p, on, ids in out if ids], schema)

    return rows.mapInArrow(run, "place0 string, place1 long, hit array<int>, items array<string>")


#: The same for windows of 10 words as DuckDB SQL.
SQL = r"""
WITH low AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[p + 1:p + least(10, len(w))], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(greatest(1, len(w) - 9))) AS p FROM item WHERE len(w) > 0)),
m AS (SELECT DISTINCT m FROM win),
spot AS (
  SELECT rid, p, m, array_to_string(w[p + 1:p + m], ' ') AS s
  FROM (SELECT rid, w, m.m, unnest(range(len(w) - m.m + 1)) AS p FROM low, m WHERE len(w) >= m.m)),
hit AS (SELECT rid, p, spot.m, item_id FROM spot JOIN win ON spot.s = win.s AND spot.m = win.m),
places AS (SELECT rid, count(DISTINCT x) AS n_hit FROM (SELECT rid, unnest(range(p, p + m)) AS x FROM (SELECT DISTINCT rid, p, m FROM hit)) GROUP BY rid),
named AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT rid, item_id FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM low LEFT JOIN places USING (rid) LEFT JOIN named USING (rid)
"""
