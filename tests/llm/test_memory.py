"""What a Python worker holds of a task, and keeps after it."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql.classic.dataframe import DataFrame

from spanforge.llm import common, decontaminate, minhash, toxicity


@pytest.fixture
def run_in_tasks(monkeypatch):
    """The functions that frames were mapped with."""
    got, real = [], DataFrame.mapInArrow
    monkeypatch.setattr(DataFrame, "mapInArrow", lambda self, f, *a, **b: (got.append(f), real(self, f, *a, **b))[1])
    return got


def labelled(spark):
    rng = random.Random(8)
    rows = [(" ".join(f"term{rng.randrange(400)}" for _ in range(30)) + (" vile" if k % 4 == 0 else ""), int(k % 4 == 0)) for k in range(300)]
    return spark.createDataFrame([*rows, (None, 0)], "text string, toxic int").coalesce(2)


def test_features_are_counted_in_parts(spark, monkeypatch, run_in_tasks):
    whole = toxicity.chosen_features(labelled(spark), 50)
    monkeypatch.setattr(toxicity, "COUNTED", 100, raising=False)
    assert toxicity.chosen_features(labelled(spark), 50) == whole
    assert b"vile" in whole[0]
    texts = [" ".join(f"word{k}x{i}" for i in range(20)) for k in range(50)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([k % 2 for k in range(50)], pa.int32())], names=["text", "toxic"])
    parts = list(run_in_tasks[-1](iter([batch])))
    assert max(p.num_rows for p in parts) <= 100 + 4 * 20  # the features of one text more at most
    got: dict[bytes, list[int]] = {}
    for p in parts:
        for f, *n in zip(*(c.to_pylist() for c in p.columns), strict=True):
            got[f] = [x + y for x, y in zip(got.get(f, [0, 0]), n, strict=True)]
    want: dict[bytes, list[int]] = {}
    for k, t in enumerate(texts):
        for f in {f for w in t.encode().split() for f in toxicity.features(w)}:
            want.setdefault(f, [0, 0])[k % 2] += 1
    assert got == want


def test_words_remembered_are_bounded(monkeypatch):
    monkeypatch.setattr(toxicity, "REMEMBERED", 10, raising=False)
    memo = toxicity.Words({b"vile": 3})
    assert [memo[w] for w in [b"vile", *(b"w%d" % k for k in range(30)), b"vile"]] == [(3,), *[()] * 30, (3,)]
    assert len(memo) <= 10


def test_stages_drop_what_the_token_store_kept(spark, run_in_tasks):
    """The words of the encoder stay in a worker until a task of another kind runs there."""
    docs = spark.createDataFrame([(1, "a text")], "doc_id long, text string")
    toxicity.score(docs, toxicity.Model({}, np.zeros(0), np.zeros(0)))
    minhash.units_of(docs.selectExpr("doc_id", "doc_id AS key", "text"), minhash.document_set(common.alnum_hashes, 5))
    decontaminate.scan(docs, spark.sparkContext.broadcast(([], [], {})), 1.0, 5)
    assert len(run_in_tasks) == 3
    for k, run in enumerate(run_in_tasks):
        common.kept_in_worker(("big",), lambda k=k: k)
        list(run(iter([])))
        assert common.kept_in_worker(("big",), lambda: "anew") == "anew"


def test_values_are_made_a_few_rows_at_a_time(monkeypatch):
    monkeypatch.setattr(common, "ROWS_AT_ONCE", 3)
    for rows in ([], [None], list("abcdefg"), ["x", None, ""] * 5):
        assert list(common.few_at_once(pa.array(rows, pa.string()))) == rows
    assert list(common.few_at_once(pa.array(list("abcdefg")).slice(2, 4))) == list("cdef")
