"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

Features are words and word beginnings of four to six characters; a document's value for one is
log(1 + occurrences). Of all that the labelled sample holds, those that part toxic from other
documents by LEAST_Z standard errors are kept, FEATURES at most. Grades are 0 (labelled not toxic), 1 and 2 (labelled toxic, with
fewer or at least as many marked words as the median toxic document; a marked word has a feature
that is at least twenty times as frequent among toxic documents). One weight vector is shared by
the ordered thresholds: P(grade <= k) = sigmoid(cut[k] - w.x). The output is the expected
severity, sum of k * P(grade = k), and a document is rejected where P(grade >= 1) >= 0.5.

The fit uses at most SAMPLE labelled documents, those with the smallest hashes of the id; every
document is scored, by the whole of its text.

Cases: null or empty texts have no features and get the model's base severity; null labels and
labels without a document are left out; a document with several labels counts as toxic if one of
them says so; without labels of both kinds nothing is rejected and all severities are 0; very long texts
are scored by all of their words; features of equal standing go by their name; a document at exactly one
half is rejected; repeated rows each get a row; an empty table gives an empty result; other columns,
whatever their names, are ignored.

The labels are 0 and 1 alone, so the grades above 0 are made from the counts of marked words, which are
features too: the upper threshold orders the toxic documents by how many such words they have and
learns nothing that the labels say.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.llm.common import Shared, alnum_words, few_at_once, released

#: Labelled documents, and features, that the fit uses at most; documents and standard errors that a feature needs at least.
SAMPLE = 20_000
FEATURES = 4_096
PREFIXES = (4, 5, 6)
LEAST_DOCS = 3
LEAST_Z = 4.0
STEPS = 400
RIDGE = 1e-4
#: Features that a task counts before it passes the counts on, and words whose features a task remembers.
COUNTED = 100_000
REMEMBERED = 1 << 17


def features(word: bytes) -> list[bytes]:
    """The word and its beginnings (a beginning ends in *)."""
    w = word.decode("utf-8", "replace")
    return [word, *(w[:n].encode() + b"*" for n in PREFIXES if len(w) >= n)]


class Words(dict):
    """Words to what is known of their features, REMEMBERED words at a time."""

    def __init__(self, known: dict[bytes, int]):
        super().__init__()
        self.known = known

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        out = tuple(self.known[f] for f in features(word) if f in self.known)
        self[word] = out
        return out


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(text, toxic) of at most about sample labelled documents, by the smallest hashes of the id."""
    y = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    n = y.count()
    share = min(1.0, sample / max(1, n))
    y = y.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    one = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(y), "doc_id")  # sample bounds it
    return one.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")


def chosen_features(rows: DataFrame, count: int) -> tuple[dict[bytes, int], set[int]]:
    """The features that part the grades best, numbered, and those that mark toxic words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}

        def counts() -> Iterator[pa.RecordBatch]:
            for y, n in seen.items():
                if n:
                    none = pa.array(np.zeros(len(n), np.int64))
                    own = pa.array(list(n.values()), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), none if y else own, own if y else none], names=["f", "n0", "n1"])
                    n.clear()

        for b in batches:
            for t, y in zip(few_at_once(b.column(0)), few_at_once(b.column(1)), strict=True):
                seen[y].update({f for w in set(alnum_words(t or "")) for f in features(w)})
                if len(seen[0]) + len(seen[1]) >= COUNTED:
                    yield from counts()
        yield from counts()

    n0, n1 = rows.agg(F.sum(1 - F.col("toxic")), F.sum("toxic")).first()
    if not n0 or not n1:
        return {}, set()
    sums = rows.mapInArrow(released(run), "f binary, n0 long, n1 long").groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where(F.col("n0") + F.col("n1") >= LEAST_DOCS)
    p0, p1 = (F.col("n0") + 0.5) / (n0 + 1), (F.col("n1") + 0.5) / (n1 + 1)
    p = (F.col("n0") + F.col("n1") + 1) / (n0 + n1 + 2)
    z = F.abs(p1 - p0) / F.sqrt(p * (1 - p) * (1 / n0 + 1 / n1))
    top = sums.withColumns({"z": z, "odds": p1 / p0}).where(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "f").limit(count).collect()
    return {bytes(r.f): i for i, r in enumerate(top)}, {i for i, r in enumerate(top) if r.odds >= 20}


def counts_of(words: list[bytes], memo: Words) -> dict[int, int]:
    out: dict[int, int] = {}
    for hit in filter(None, map(memo.__getitem__, words)):
        for f in hit:
            out[f] = out.get(f, 0) + 1
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit_cumulative_link(rows: list[dict[int, int]], grades: np.ndarray, n_features: int, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and rising cuts that maximise the ridge-penalised likelihood (Adam, full batches)."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    f = np.fromiter((k for r in rows for k in r), np.int64, len(at))
    v = np.log1p(np.fromiter((c for r in rows for c in r.values()), np.float64, len(at)))
    share = np.array([(grades <= k).mean() for k in range(levels - 1)])
    first = np.log(share / (1 - share))
    theta = np.concatenate([np.zeros(n_features), first[:1], np.log(np.maximum(np.diff(first), 1e-3))])
    m, s = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        w, raw = theta[:n_features], theta[n_features:]
        cuts = raw[0] + np.concatenate([[0], np.cumsum(np.exp(raw[1:]))])
        score = np.bincount(at, v * w[f], len(rows))
        edge = np.concatenate([np.full((len(rows), 1), -np.inf), cuts[None, :] - score[:, None], np.full((len(rows), 1), np.inf)], axis=1)
        cdf = np.where(np.isinf(edge), (edge > 0).astype(float), sigmoid(edge))
        pdf = cdf * (1 - cdf)
        i = np.arange(len(rows))
        p = np.maximum(cdf[i, grades + 1] - cdf[i, grades], 1e-12)
        up, down = pdf[i, grades + 1] / p, pdf[i, grades] / p
        g = np.zeros_like(theta)
        g[:n_features] = np.bincount(f, v * (up - down)[at], n_features) / len(rows) + RIDGE * w
        by_cut = np.array([down[grades == k + 1].sum() - up[grades == k].sum() for k in range(levels - 1)]) / len(rows)
        g[n_features] = by_cut.sum()
        for k in range(1, levels - 1):
            g[n_features + k] = np.exp(raw[k]) * by_cut[k:].sum()
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        theta -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    raw = theta[n_features:]
    return theta[:n_features], raw[0] + np.concatenate([[0], np.cumsum(np.exp(raw[1:]))])


class Model:
    """What scoring needs: numbered features, weights and cuts (none: nothing was learned)."""

    def __init__(self, known: dict[bytes, int], weights: np.ndarray, cuts: np.ndarray):
        self.known, self.weights, self.cuts = known, weights, cuts

    def grade_probabilities(self, counts: dict[int, int]) -> np.ndarray:
        if not len(self.cuts):
            return np.array([1.0])
        score = sum(self.weights[k] * math.log1p(c) for k, c in counts.items())
        at_most = np.append(sigmoid(self.cuts - score), 1.0)
        return np.diff(at_most, prepend=0.0)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, count: int = FEATURES) -> Model:
    rows = Shared(docs.sparkSession).write(labelled_sample(docs, labels, sample))
    known, marks = chosen_features(rows, count)
    if not known:
        return Model({}, np.zeros(0), np.zeros(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Words(known)
        for b in batches:
            got = [counts_of(alnum_words(t or ""), memo) for t in few_at_once(b.column(0))]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([list(g) for g in got], pa.list_(pa.int32())), pa.array([list(g.values()) for g in got], pa.list_(pa.int32()))], names=["toxic", "f", "c"])

    data = rows.mapInArrow(released(run), "toxic int, f array<int>, c array<int>").collect()  # sample bounds it
    data.sort(key=lambda r: (r.toxic, r.f, r.c))
    vectors = [dict(zip(r.f, r.c, strict=True)) for r in data]
    y = np.array([r.toxic for r in data])
    marked = np.array([max([0, *(c for k, c in x.items() if k in marks)]) for x in vectors])
    median = max(2.0, float(np.median(marked[y == 1]))) if (y == 1).any() else 2.0
    grades = np.where(y == 0, 0, np.where(marked >= median, 2, 1))
    kinds = np.unique(grades)
    if len(kinds) < 2:
        return Model({}, np.zeros(0), np.zeros(0))
    grades = np.searchsorted(kinds, grades)
    return Model(known, *fit_cumulative_link(vectors, grades, len(known), len(kinds)))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns of keep, then doc_id, severity, grade, p_toxic and toxic of every row."""
    sent = docs.sparkSession.sparkContext.broadcast((model.known, model.weights, model.cuts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*sent.value)
        memo = Words(model.known)
        for b in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for t in few_at_once(b.column(1)):
                p = model.grade_probabilities(counts_of(alnum_words(t or ""), memo))
                toxic = float(1 - p[0])
                for o, x in zip(out, (float((p * np.arange(len(p))).sum()), int(p.argmax()), toxic, toxic >= 0.5), strict=True):
                    o.append(x)
            yield pa.RecordBatch.from_arrays([b.column(0), *(b.column(i) for i in range(2, b.num_columns)), pa.array(out[0], pa.float64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.float64()), pa.array(out[3], pa.bool_())], names=names)

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t"), *(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)))
    kept = [f"k{i}" for i in range(len(keep))]
    names = ["id", *kept, "severity", "grade", "p_toxic", "toxic"]
    types = dict(rows.dtypes)
    ddl = ", ".join([f"{c} {types[c]}" for c in ["id", *kept]] + ["severity double, grade int, p_toxic double, toxic boolean"])
    return rows.mapInArrow(released(run), ddl).select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(keep) if c != doc_id), F.col("id").alias("doc_id"), "severity", "grade", "p_toxic", "toxic")


def grade_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
