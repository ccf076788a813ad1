"""Substring deduplication against a brute-force version, and on awkward rows."""

from __future__ import annotations

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanforge.llm import common, substrings
from tests.llm import brute

N = substrings.MIN_WORDS


def fresh(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))


def brute_spans(rows):
    """rows: [(doc_id, text)]; sorted spans by all runs of N words, all pairs of lines and whole texts."""
    docs = sorted({(i, tuple(brute.words(t))) for i, t in rows if t is not None and len(brute.words(t)) >= N}, key=str)
    lines = {d: [] for d in docs}
    for i, t in rows:
        if t is None or len(brute.words(t)) < N:
            continue
        at, own = 0, []
        for line in t.split("\n"):
            w = brute.words(line)
            if len(w) >= N:
                own.append((at, tuple(w)))
            at += len(w)
        lines[i, tuple(brute.words(t))] = own
    holders = collections.defaultdict(set)
    for i, w in docs:
        for p in range(len(w) - N + 1):
            holders[w[p : p + N]].add((i, w))
    kinds = sorted({x for own in lines.values() for _, x in own})
    up = {x: x for x in kinds}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    sets = {x: {x[p : p + 5] for p in range(len(x) - 4)} for x in kinds}
    for k, x in enumerate(kinds):
        for y in kinds[:k]:
            n = len(sets[x] & sets[y])
            if 100 * n >= 80 * (len(sets[x]) + len(sets[y]) - n):
                up[top(x)] = top(y)
    groups = collections.defaultdict(set)
    for d, own in lines.items():
        for _, x in own:
            groups[top(x)].add(d)
    same = collections.defaultdict(set)
    for d in docs:
        same[d[1]].add(d)
    out = []
    for d in docs:
        i, w = d
        first = [None] * len(w)

        def mark(a, n, who, first=first, own=same[d[1]]):
            if len({x[1] for x in who}) > 1 or len(own) > 1 and who >= own and n == len(first):
                least = min(x[0] for x in who)
                for p in range(a, a + n):
                    first[p] = least if first[p] is None else min(first[p], least)

        for p in range(len(w) - N + 1):
            mark(p, N, holders[w[p : p + N]])
        for a, x in lines[d]:
            mark(a, len(x), groups[top(x)])
        mark(0, len(w), same[w])
        cut = [p for p in range(len(w) + 1) if p in (0, len(w)) or first[p] != first[p - 1]]
        out += [(i, a, e - 1, e - a, first[a], first[a] == i) for a, e in zip(cut, cut[1:], strict=False) if first[a] is not None]
    return sorted(out)


def corpus(rng):
    """Texts with passages of many lengths, near and equal lines, copies and ties."""
    rows, passages, kept = [], [fresh(rng, n) for n in (12, 23, 24, 25, 26, 30, 40, 50, 75, 120)], [fresh(rng, n) for n in (24, 30, 60, 90)]
    for k in range(60):
        own = [fresh(rng, rng.randrange(5, 90))]
        for _ in range(rng.randrange(3)):
            own.append(rng.choice(passages))
            own.append(fresh(rng, rng.randrange(1, 40)))
        text = " ".join(own)
        if k % 4 == 0:
            w = rng.choice(kept).split(" ")
            if k % 8 == 0:
                w[rng.randrange(len(w))] = "edit"
            text += "\n" + " ".join(w) + "\n" + fresh(rng, 8)
        rows.append((k, text))
    rows += [(100 + k, rows[7][1]) for k in range(3)] + [(200, rows[8][1].upper()), (201, rows[9][1] + " " + fresh(rng, 3))]
    rows += [(300, " ".join(["to be"] * 40)), (301, fresh(rng, 20) + " " + " ".join(["to be"] * 45)), (302, "x " * 3000), (303, "x " * 70)]
    rows += [(400, None), (401, ""), (402, " \n "), (403, "short text")]
    rows += [(500, rows[1][1]), (500, rows[2][1]), (7, rows[7][1])]
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed):
    rows = corpus(random.Random(seed))
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(tuple(r) for r in substrings.repeated(d).collect())
    assert got == brute_spans(rows)
    assert {n for *_, n, _, _ in got} >= {24, 40, 50}


def test_recall_by_length(spark):
    """Share of the words of passages, pasted into texts of their own, that are found; with a word in the middle third changed."""
    rng = random.Random(5)
    kinds = [(23, 0, 0), (24, 0, 1), (30, 0, 1), (40, 0, 1), (50, 0, 1), (60, 1, 0.9), (90, 1, 0.9)]
    rows = []
    for m, (n, edits, _) in enumerate(kinds):
        for k in range(60):
            p = fresh(rng, n).split(" ")
            rows.append((1000 * m + 2 * k, f"{fresh(rng, 30)} {' '.join(p)} {fresh(rng, 30)}"))
            for _ in range(edits):
                p[rng.randrange(n // 3 + 4, 2 * n // 3 - 4)] = "edit"
            rows.append((1000 * m + 2 * k + 1, f"{fresh(rng, 17)} {' '.join(p)} {fresh(rng, 9)}"))
    got = substrings.repeated(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id % 2 = 1").collect()
    assert all(r.cluster_id == r.doc_id - 1 for r in got)
    for m, (n, edits, least) in enumerate(kinds):
        found = sum(r.n_words for r in got if r.doc_id // 1000 == m) / (60 * (n - edits))
        assert least <= found <= 1 and (found == 0 or n >= N)


def test_runs_of_every_length_meet():
    """Each shared run of MIN_WORDS words or more is near an anchor that both texts have, whatever stands around it."""
    rng = random.Random(9)
    for k in range(400):
        n = N + k % 30
        p = [str(rng.randrange(40 if k % 2 else 10**9)).encode() for _ in range(n)]
        keys, texts = [], []
        for _ in range(2):
            w = [str(rng.random()).encode() for _ in range(rng.randrange(60))] + p + [str(rng.random()).encode() for _ in range(rng.randrange(60))]
            h = common.space_hashes(b" ".join(w).decode())
            texts.append(h)
            keys.append(set(substrings.anchors(common.Runs(h), len(h))[1].tolist()))
        both = keys[0] & keys[1]
        assert both

        class Among:
            @staticmethod
            def test(x, both=both):
                return np.array([int(v) in both for v in x], bool)

        runs = [set(substrings.runs_near(h, Among)[1].tolist()) for h in texts]
        want = set(common.Runs(common.space_hashes(b" ".join(p).decode())).of(N).tolist())
        assert want <= runs[0] and want <= runs[1]


def test_bands_find_lines_at_the_threshold():
    rng = np.random.default_rng(1)
    met = 0
    for _ in range(300):
        x = rng.integers(0, 1 << 63, 90, dtype=np.uint64)
        y = np.concatenate([x[:80], rng.integers(0, 1 << 63, 10, dtype=np.uint64)])  # 80 of 100
        m = np.concatenate([substrings.line_minima(v, np.array([0]), np.array([len(v) + 4])) for v in (x, y)])
        bands, _ = substrings.signatures(m, substrings.LINES)
        met += bool(set(bands[0].tolist()) & set(bands[1].tolist()))
    assert met >= 298


def test_awkward_tables(spark, tmp_path):
    rng = random.Random(3)
    line = fresh(rng, 60)
    rows = [(None, line, 1, "a"), (None, line, 2, "b"), (3, f"{line} {fresh(rng, 30)}", 3, None), (4, None, 4, "d"), (5, fresh(rng, 40_000), 5, "e")]
    d = spark.createDataFrame(rows, "doc_id long, text string, key long, spanforge_row string")
    for c in ("class", "nid", "id", "h", "size", "hash", "at", "len", "first_key", "mix_key"):
        d = d.withColumn(c, F.lit("clash"))
    got = sorted(map(str, substrings.repeated(d).collect()))
    assert got == sorted(map(str, [*(r for r in substrings.repeated(d.select("doc_id", "text")).collect())]))
    spans = substrings.repeated(d).collect()
    assert len(spans) == 3
    assert [(r.first_word, r.last_word, r.cluster_id, r.kept) for r in spans if r.doc_id == 3] == [(0, 59, 3, True)]
    assert [(r.cluster_id, r.kept) for r in spans if r.doc_id is None] == [(3, False)] * 2
    assert substrings.repeated(d.where("false")).count() == 0
    alone = spark.createDataFrame([(None, line), (None, line)], "doc_id long, text string")
    assert sorted(r.kept for r in substrings.repeated(alone).collect()) == [False, True]


@pytest.mark.parametrize("at_once", [1 << 20, 7])
def test_word_hashes(at_once, monkeypatch):
    """Words are told apart as the splitters do, and hashed by their bytes alone."""
    monkeypatch.setattr(common, "TEXT_AT_ONCE", at_once)
    rng = random.Random(1)
    known: dict[bytes, int] = {}
    for _ in range(1500):
        t = "".join(rng.choice("abAB zZ09_-\n\t\r\x0b\x1c\u00a0é日😀.") for _ in range(rng.randrange(30)))
        for words, hashes in ((common.space_words, common.space_hashes), (common.alnum_words, common.alnum_hashes)):
            w, h = words(t), hashes(t).tolist()
            assert len(w) == len(h), t
            for x, y in zip(w, h, strict=True):
                assert known.setdefault(x, y) == y
        h, counts = common.line_hashes(t)
        assert counts.tolist() == [len(common.space_words(line)) for line in t.split("\n")]
    assert len(set(known.values())) == len(known) > 3000


def test_ids_are_grouped_once_for_joins_of_hot_keys(spark, monkeypatch):
    rng = random.Random(5)
    line, own = fresh(rng, 30), " ".join(["again and"] * 60)
    rows = [(k, f"{fresh(rng, 4)} {line} {fresh(rng, 3)}\n{line}") for k in range(8)] + [(20, own), (21, fresh(rng, 40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, substrings.repeated(docs).collect()), key=str)
    given, join = [], common.hot_join

    def seen(big, small, on, *args, **more):
        if on == "id":
            counts = {r.id: r["count"] for r in big.groupBy("id").count().collect()}
            told = {r.id: r["count"] for r in more["counted"].collect()}
            assert more["total"] == sum(counts.values())
            assert all(told[i] == n for i, n in counts.items() if n > common.HOT_ROWS)  # those of one class too
            assert {r.id for r in small.collect()} <= set(told)
            given.append(len(told))
        return join(big, small, on, *args, **more)

    monkeypatch.setattr(common, "HOT_ROWS", 3)
    monkeypatch.setattr(substrings, "hot_join", seen)
    assert sorted(map(tuple, substrings.repeated(docs).collect()), key=str) == want
    assert len(given) == 2 and min(given) > 0
    assert {r[0] for r in want} == set(range(8))
