"""Substring deduplication by paragraph MinHash banding.

Texts of the same words form a class and are cut once. Paragraphs are of two kinds.

Lines of at least MIN_WORDS words are sets of five-word shingles. Two minima make a band, eight
bands in all, so two lines of similarity 0.8 share none with probability (1 - 0.8**2)**8, 3e-4.
Lines that collide are joined, their Jaccard similarity is verified on the full sets, and
components of those that pass are one repeated paragraph.

Passages that were pasted into the middle of other text are no lines of their own. Each run of
MIN_WORDS words is a paragraph too, and is repeated if another class has the same words, that is if
their Jaccard similarity is 1. To find these runs without indexing them all, the banding is that of
a sliding minimum: of every REACH word pairs in a row the one of least hash is an anchor, and the
ANCHOR words from there on are its key. What marks an anchor lies within MIN_WORDS words, so a
passage of MIN_WORDS words or more has in all its copies the same anchors, one in each of its runs.
The runs that hold a key of two classes are then verified by all of their words. So passages of
MIN_WORDS words and more are found to the word; shorter ones are not reported.

The first holder of a word is the smallest id among the documents of the repeated paragraphs that
the word is in. In each document the words that touch and have the same first holder are one span,
which is kept where the document is that holder, else it is for removal. So what is removed from a
document stands in one of a smaller id, and the smallest keeps it.

Cases: null and empty texts, and texts of fewer than MIN_WORDS words, have no spans; paragraphs
repeated within one text alone are not reported; very long texts are cut whole; where minima
tie all of them are anchors, so texts of repeating words have anchors like others; rows that agree
in id and words count as one document; rows of one id with different texts are documents that hold
each other's copies, and both are kept; documents without an id come after all others, each for
itself, and as holders have a null cluster_id; an empty table gives an empty result; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.llm import common
from spanforge.llm.common import Runs, Shared, hot_join, line_hashes, membership, numbered, space_hashes
from spanforge.llm.minhash import _A, _B, REMEMBERED, Shape, linked_classes, shingle_set, short, signatures

MIN_WORDS = 24
SHINGLE = 5
REACH = 12
#: Words of an anchor's key: with the REACH - 1 places that it may stand behind, fewer than MIN_WORDS.
ANCHOR = 12
LINES = Shape(2, 8)
#: Keys of documents without an id start here.
UNNAMED = 1 << 62
#: Shingles whose minima are taken at a time.
AT_ONCE = 1 << 16


def sequence_id(h: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(h.tobytes()) - (1 << 63)


def sliding(x: np.ndarray, n: int, f: np.ufunc) -> np.ndarray:
    """f (minimum or maximum) over every n consecutive values."""
    step = 1
    while step * 2 <= n:
        x = f(x[:-step], x[step:])
        step *= 2
    return f(x[: len(x) - (n - step)], x[n - step :]) if n > step else x


def anchors(runs: Runs, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and keys of the anchors of a text of n words."""
    if n < REACH + ANCHOR - 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    pair = runs.of(2)
    least = np.pad(sliding(pair, REACH, np.minimum), REACH - 1)
    at = np.flatnonzero(sliding(least, REACH, np.maximum) == pair)
    at = at[at <= n - ANCHOR]
    return at, runs.of(ANCHOR)[at]


def runs_near(h: np.ndarray, repeated) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the runs of MIN_WORDS words whose anchors may be repeated.

    A run begins two stretches of REACH pairs whose anchors have their keys within it, at its first word and
    its second; if the run is repeated, so are both keys, and those without a key in the filter are left out."""
    runs = Runs(h)
    at, keys = anchors(runs, len(h))
    n = len(h) - MIN_WORDS + 1
    at = at[repeated.test(keys)] if len(at) else at
    if n <= 0 or not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    pair = runs.of(2)
    known = np.full(len(pair), np.iinfo(np.uint64).max)
    known[at] = pair[at]
    found = sliding(known, REACH, np.minimum) == sliding(pair, REACH, np.minimum)
    near = np.flatnonzero(found[:n] & found[1 : n + 1])
    return near, runs.of(MIN_WORDS)[near]


def long_lines(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words and lengths of the lines of enough words."""
    on = np.flatnonzero(counts >= MIN_WORDS)
    return (np.cumsum(counts) - counts)[on], counts[on]


def line_sets(text: str | None) -> list[tuple[int, np.ndarray]]:
    h, counts = line_hashes(text or "")
    return [(sequence_id(h[a : a + n]), shingle_set(h[a : a + n], SHINGLE)) for a, n in zip(*(x.tolist() for x in long_lines(counts)), strict=True)]


def line_minima(shingles: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A row of minima for each line, as minhash.minima takes them."""
    k = LINES.hashes
    out = np.empty((len(at), k), np.uint32)
    ends = np.stack([at, at + size - SHINGLE + 1], axis=1).ravel()
    padded = np.append(short(shingles), np.uint32(0))
    step = k if len(padded) <= AT_ONCE else 1
    for i in range(0, k, step):
        m = padded[None, :] * _A[i : i + step, None]
        m += _B[i : i + step, None]
        out[:, i : i + step] = np.minimum.reduceat(m, ends, axis=1)[:, ::2].T
    return out.astype(np.uint64)


PARTS = pa.schema([
    ("key", pa.int64()), ("class", pa.int64()), ("n_words", pa.int64()), ("line_id", pa.list_(pa.int64())), ("line_at", pa.list_(pa.int32())), ("line_len", pa.list_(pa.int32())),
    ("new_id", pa.list_(pa.int64())), ("new_n", pa.list_(pa.int64())), ("bands", pa.list_(pa.list_(pa.int64()))), ("planes", pa.list_(pa.list_(pa.int64()))), ("anchors", pa.list_(pa.int64())),
])
PARTS_DDL = "key long, class long, n_words long, line_id array<long>, line_at array<int>, line_len array<int>, new_id array<long>, new_n array<long>, bands array<array<long>>, planes array<array<long>>, anchors array<long>"


def parts(rows: DataFrame) -> DataFrame:
    """Class and paragraphs of every row (key, text) of enough words.

    A task gives the paragraphs of a class once, and the signature of a line once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, given = set(), set()
        for b in batches:
            if len(classes) > REMEMBERED:
                classes.clear()
            if len(given) > REMEMBERED:
                given.clear()
            out: dict[str, list] = {f.name: [] for f in PARTS}
            low: list[np.ndarray] = []
            for key, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                h, counts = line_hashes(t)
                if len(h) < MIN_WORDS:
                    continue
                name = sequence_id(h)
                out["key"].append(key)
                out["class"].append(name)
                out["n_words"].append(len(h))
                if name in classes:
                    for f in ("line_id", "line_at", "line_len", "new_id", "new_n", "anchors"):
                        out[f].append([])
                    continue
                classes.add(name)
                runs = Runs(h)
                at, size = long_lines(counts)
                ids = [sequence_id(h[a : a + n]) for a, n in zip(at.tolist(), size.tolist(), strict=True)]
                new = []
                for k, i in enumerate(ids):
                    if i not in given:
                        given.add(i)
                        new.append(k)
                if new:
                    low.append(line_minima(runs.of(SHINGLE), at[new], size[new]))
                for f, x in (("line_id", ids), ("line_at", at), ("line_len", size), ("new_id", [ids[k] for k in new]), ("new_n", size[new] - SHINGLE + 1 if new else []), ("anchors", np.unique(anchors(runs, len(h))[1]).view(np.int64))):
                    out[f].append(x)
            bands, planes = (x.tolist() for x in signatures(np.concatenate(low), LINES)) if low else ([], [])
            k = 0
            for own in out["new_id"]:
                out["bands"].append(bands[k : k + len(own)])
                out["planes"].append(planes[k : k + len(own)])
                k += len(own)
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in PARTS], schema=PARTS)

    return rows.select("key", "text").mapInArrow(run, PARTS_DDL)


def holding(cuts: DataFrame, repeated) -> DataFrame:
    """key of the rows with an anchor that passes the broadcast filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            on = repeated.value.test(lists.flatten().to_numpy())
            owner = np.repeat(np.arange(b.num_rows), lists.value_lengths().to_numpy())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.unique(owner[on])))], names=["key"])

    return cuts.select("key", "anchors").mapInArrow(run, "key long")


def runs(rows: DataFrame, keys, repeated) -> DataFrame:
    """(key, class, hash, at), as arrays, of the runs that hold an anchor in the filter, in rows whose keys pass theirs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            on = pa.array(keys.value.test(b.column(0).to_numpy()))
            own, names, got = b.column(1).filter(on), [], []
            for t in b.column(2).filter(on).to_pylist():
                h = space_hashes(t)
                names.append(sequence_id(h))
                got.append(runs_near(h, repeated.value))
            yield pa.RecordBatch.from_arrays([own, pa.array(names, pa.int64()), pa.array([x.view(np.int64) for _, x in got], pa.list_(pa.int64())), pa.array([a for a, _ in got], pa.list_(pa.int32()))], names=["key", "class", "hash", "at"])

    return rows.select(F.xxhash64("key").alias("h"), "key", "text").mapInArrow(run, "key long, class long, hash array<long>, at array<int>")


def in_two(rows: DataFrame, ids: DataFrame, total: int, shared: Shared) -> DataFrame:
    """The rows whose id two classes have, with the first_key of each; ids has class, key and id of the rows, total says how many they are.

    The ids are grouped once, for what two classes have and for what is hot in the join."""
    met = ids.groupBy("id").agg(F.min("key").alias("first_key"), F.min("class").alias("a"), F.max("class").alias("b"), F.count("*").alias("count"))
    met = shared.write(met.where((F.col("a") != F.col("b")) | (F.col("count") > common.HOT_ROWS)))
    return hot_join(rows, met.where("a <> b").select("id", "first_key"), "id", counted=met, total=total)


def repeated(docs: DataFrame, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each repeated span: doc_id, first_word, last_word, n_words, cluster_id (the
    doc_id of its words' first holder) and kept."""
    shared = Shared(docs.sparkSession)
    row, named = numbered(docs, shared)
    rows = row.select(F.coalesce(F.col(doc_id).cast("long"), F.shiftrightunsigned(F.xxhash64(*named), 2).bitwiseOR(UNNAMED)).alias("key"), F.col(text).alias("text")).where("text is not null")
    cuts = shared.write(parts(rows))
    classes = shared.write(cuts.groupBy("class").agg(F.min("key").alias("key"), F.max("key").alias("last_key"), F.first("n_words").alias("n")))
    # lines
    line = cuts.where("size(line_id) > 0").select("class", F.explode(F.arrays_zip("line_id", "line_at", "line_len")).alias("x")).select("class", F.col("x.line_id").alias("nid"), F.col("x.line_at").alias("at"), F.col("x.line_len").alias("len"))
    line = shared.write(line.join(classes.select("class", "key"), "class"))
    sigs = shared.write(cuts.select(F.explode(F.arrays_zip("new_id", "new_n", "bands", "planes")).alias("x")).select(F.col("x.new_id").alias("nid"), F.col("x.new_n").alias("n"), "x.bands", "x.planes"))
    roots = linked_classes(rows, sigs, line.groupBy("nid").agg(F.min("key").alias("key")), line_sets, percent, shared, LINES, sized=False)
    shared.drop(sigs)
    held = hot_join(line, roots, "nid", "left").select("class", "key", F.coalesce("root", "nid").alias("id"), "at", "len")
    held = shared.write(held)
    # runs of words around anchors of two classes
    anchored = cuts.select("class", F.explode("anchors").alias("id"))
    met = shared.write(anchored.groupBy("id").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a <> b").select("id"))
    found = membership(met, "id")
    near = shared.write(holding(cuts, found).join(classes.select("key").distinct(), "key", "left_semi").select(F.xxhash64("key").alias("h")).distinct())
    run = shared.write(runs(rows, membership(near, "h"), found).where("size(at) > 0"))
    each = run.select("class", F.explode(F.arrays_zip("hash", "at")).alias("x")).select("class", F.col("x.hash").alias("id"), F.col("x.at").alias("at"), F.lit(MIN_WORDS).alias("len"))
    n = run.agg(F.sum(F.size("at").cast("long"))).first()[0] or 0
    hits = in_two(held.select("class", "id", "at", "len"), held.select("class", "key", "id"), held.count(), shared).unionByName(in_two(each, run.select("class", "key", F.explode("hash").alias("id")), n, shared)).select("class", "at", "len", "first_key")
    whole = classes.where("key <> last_key").select("class", F.lit(0).alias("at"), F.col("n").cast("int").alias("len"), F.col("key").alias("first_key"))
    spans = hits.unionByName(whole).repartition("class").sortWithinPartitions("class").mapInArrow(merged, "class long, first_word long, last_word long, n_words long, first_key long")
    spans = shared.write(spans.groupBy("class").agg(F.collect_list(F.struct("first_word", "last_word", "n_words", "first_key")).alias("spans")))
    out = hot_join(shared.write(cuts.select("key", "class").distinct()), spans, "class").select("key", F.inline("spans"))
    told = lambda k: F.when(F.col(k) < UNNAMED, F.col(k))
    return out.select(told("key").alias("doc_id"), "first_word", "last_word", "n_words", told("first_key").alias("cluster_id"), (F.col("key") == F.col("first_key")).alias("kept"))


def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of touching words of each class that have the same first holder, of rows (class, at, len, first_key) that come class by class."""

    def spans(own: np.ndarray) -> np.ndarray:
        at, size, keys = own[:, 1], own[:, 2], own[:, 3]
        low, high = int(at.min()), int((at + size).max())
        first, there = np.zeros(high - low, np.int64), np.zeros(high - low, bool)
        for key in np.unique(keys)[::-1].tolist():  # the smallest is written last
            mine = keys == key
            edge = np.zeros(high - low + 1, np.int64)
            np.add.at(edge, at[mine] - low, 1)
            np.add.at(edge, at[mine] + size[mine] - low, -1)
            on = np.cumsum(edge[:-1]) > 0
            first[on], there = key, there | on
        a = np.concatenate([[0], np.flatnonzero((first[1:] != first[:-1]) | (there[1:] != there[:-1])) + 1])
        e = np.append(a[1:], high - low)
        a, e = a[there[a]], e[there[a]]
        return np.stack([np.full(len(a), own[0, 0]), low + a, low + e - 1, e - a, first[a]], axis=1)

    held: list[np.ndarray] = []
    for b in batches:
        rows = np.stack([c.to_numpy().astype(np.int64) for c in b.columns], axis=1)
        if not len(rows):
            continue
        cuts = np.flatnonzero(rows[1:, 0] != rows[:-1, 0]) + 1
        pieces = np.split(rows, cuts)
        if held and held[0][0, 0] == pieces[0][0, 0]:
            held.append(pieces.pop(0))
        if pieces:
            done = [np.concatenate(held)] if held else []
            held = [pieces.pop()]
            if done := done + pieces:
                out = np.concatenate([spans(x) for x in done])
                yield pa.RecordBatch.from_arrays([pa.array(out[:, i]) for i in range(5)], names=SPAN)
    if held:
        out = spans(np.concatenate(held))
        yield pa.RecordBatch.from_arrays([pa.array(out[:, i]) for i in range(5)], names=SPAN)


SPAN = ["class", "first_word", "last_word", "n_words", "first_key"]
