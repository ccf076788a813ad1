"""The training-data operators against plain versions, and on awkward rows."""

from __future__ import annotations

import collections
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanforge.llm import common, components, decontaminate, language, licenses, minhash, mixing, quality, queries, token_store, toxicity, urls
from spanforge.llm.common import Shared
from tests.llm import brute

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def docs(spark):
    """The smallest documents with copies, edits, nulls, ties and odd texts."""
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    rng = random.Random(5)
    base = next(t for _, t, *_ in rows if 400 < len(t) < 900)
    for k in range(12):
        w = base.split(" ")
        for _ in range(k % 4):
            w[rng.randrange(len(w))] = f"edit{k}"
        rows.append((9000 + k, " ".join(w), "en", "src0", 0))
    odd = [None, "", " ", "one", "one", "ÀÉ é 日本語", "a\n\nb \n", "MIT License and the Apache License; MIT license.", "a b " * 3000, "<|endoftext|> x", "$$$ ### !!"]
    rows += [(9500 + k, t, None, None, None) for k, t in enumerate(odd)]
    rows += [rows[0], (None, "a text without an id", "en", "src1", 1), (None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def folder(docs, tmp_path_factory, spark):
    """A folder of tables with those documents and the other small tables."""
    d = tmp_path_factory.mktemp("tables")
    docs.withColumn("key", F.lit("clash")).write.parquet(f"{d}/documents.parquet")
    for t in ("benchmark", "labels", "pages", "embeddings"):
        os.symlink(f"{SF}/{t}.parquet", f"{d}/{t}.parquet")
    return str(d)


@pytest.fixture(scope="module")
def empty(docs, tmp_path_factory, spark):
    d = tmp_path_factory.mktemp("empty")
    docs.where("false").write.parquet(f"{d}/documents.parquet")
    for t in ("benchmark", "labels", "pages", "embeddings"):
        spark.read.parquet(f"{SF}/{t}.parquet").where("false").write.parquet(f"{d}/{t}.parquet")
    return str(d)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_empty_tables(name, spark, empty):
    assert queries.queries()[name](spark, empty).count() == 0


def test_quality(spark, folder, docs):
    got = queries.op1_quality(spark, folder).collect()
    assert len(got) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    for r in got:
        if r.doc_id is None:
            continue
        t = texts[r.doc_id] or ""
        w = brute.words(t, lower=False)
        windows = collections.Counter(tuple(w[p : p + 8]) for p in range(len(w) - 7))
        covered = {q for p in range(len(w) - 7) if windows[tuple(w[p : p + 8])] > 1 for q in range(p, p + 8)}
        seen, dup = set(), 0
        for line in t.split("\n"):
            if brute.words(line):
                dup += line in seen
                seen.add(line)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered)), r.doc_id
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        assert r.base_failed == failed
        assert not (failed and r.kept)


def test_quality_verdicts(spark, folder):
    """Posteriors of a whole table against a plain expectation-maximisation over its documents one by one."""
    import math

    got = queries.op1_quality(spark, folder).collect()
    votes = [tuple(r.votes) for r in got]
    k = len(votes[0])
    share = [sum(x < 0 for x in v) / max(1, sum(x != 0 for x in v)) for v in votes]
    p = [min(0.9, max(0.1, 0.9 - 1.6 * b)) for b in share]
    for _ in range(quality.ROUNDS):
        seen = [[{-1: 2 / 3 + (c == 0), 0: 2 / 3, 1: 2 / 3 + (c == 1)} for c in (0, 1)] for _ in range(k)]
        for v, x in zip(votes, p, strict=True):
            for j, y in enumerate(v):
                seen[j][0][y] += 1 - x
                seen[j][1][y] += x
        chance = [[{y: n / sum(d.values()) for y, n in d.items()} for d in by] for by in seen]
        prior = min(0.98, max(0.02, (sum(p) + 4) / (len(p) + 5)))
        odds = [math.log(prior / (1 - prior)) + sum(math.log(chance[j][1][y] / chance[j][0][y]) for j, y in enumerate(v)) for v in votes]
        p = [1 / (1 + math.exp(-max(-500, min(500, o)))) for o in odds]
    for r, x in zip(got, p, strict=True):
        assert abs(r.quality - x) < 1e-3
        assert r.kept == (not r.base_failed and r.quality >= 0.5)


def test_quality_learns_accuracies():
    rng = random.Random(2)
    patterns = collections.Counter()
    truth = {}
    for _ in range(4000):
        good = rng.random() < 0.8
        votes = tuple(0 if rng.random() < 0.2 else (1 if (rng.random() < a) == good else -1) for a in (0.95, 0.9, 0.85, 0.8, 0.7))
        patterns[votes] += 1
        truth.setdefault(votes, [0, 0])[good] += 1
    prior, table = quality.estimate(sorted((list(v), n) for v, n in patterns.items()))
    assert abs(prior - 0.8) < 0.05
    assert np.all(np.diff(table[:4, 2, 1] / (table[:4, 0, 1] + table[:4, 2, 1])) < 0.02)  # better rules are found to be better
    p = quality.posterior(np.array(list(truth)), prior, table)
    right = sum(truth[v][int(x >= 0.5)] for v, x in zip(truth, p, strict=True))
    assert right > 0.93 * 4000


def test_licenses(spark, folder, docs):
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    for r in queries.op2_licenses(spark, folder).where("doc_id is not null").collect():
        w = brute.tokens(texts[r.doc_id])
        at, labels = [], set()
        for phrase, label in licenses.BASE.items():
            p = phrase.split()
            places = [k for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p]
            at += places
            labels |= {label} if places else set()
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(at), ",".join(sorted(labels)))
        assert (r.first_word, r.last_word) == ((min(at), max(at)) if at else (None, None))
        assert labels <= set(r.labels.split(","))
        assert 0 <= r.score <= 1


def test_license_suppression():
    d = licenses.Scanner().detections(b"this work is licensed under the gnu general public license version 3".split())
    shown = [(s.label, s.priority) for _, _, s, hidden in d if not hidden]
    assert shown == [("gpl", 90)]
    assert any(s.base for _, _, s, _ in d)
    assert licenses.Scanner().detections([b"nothing"]) == []


def example(tree, rng):
    """A text that a parsed regular expression matches."""
    out = ""
    for op, arg in tree:
        op = str(op)
        if op == "LITERAL":
            out += chr(arg)
        elif op == "SUBPATTERN":
            out += example(arg[3], rng)
        elif op == "BRANCH":
            out += example(rng.choice(arg[1]), rng)
        elif op in ("MAX_REPEAT", "MIN_REPEAT"):
            out += "".join(example(arg[2], rng) for _ in range(rng.randint(arg[0], min(arg[1], arg[0] + 1))))
        elif op == "IN":
            out += rng.choice([chr(x) for kind, x in arg if str(kind) == "LITERAL"] or ["u"])
        elif op == "ANY":
            out += "u"
        else:
            assert op == "ASSERT_NOT", op
    return out


def test_license_gate_is_necessary():
    rng = random.Random(1)
    scanner = licenses.Scanner()
    for s in scanner.signatures:
        tree = re._parser.parse(s.pattern.pattern)
        for _ in range(60):
            text = example(tree, rng)
            assert s.pattern.search(text), text
            assert s in [d[2] for d in scanner.detections(text.encode().split())], text
    for text, label in (("released under the gnu gpl version 3", "gpl"), ("distributed under the terms of apache 2 0", "apache"), ("available under cc by sa 4 0", "cc-by-sa"), ("this is released under the unlicense", "unlicense"), ("see gpl3", "gpl"), ("opensource org licences mit", "mit"), ("released under gplv3", "gpl"), ("bsd 3 clause", "bsd-3"), ("this code uses mit", "mit"), ("spdx license identifier lgpl 2 1 or later", "lgpl"), ("licensed under agplv3", "agpl"), ("apache 2 0", "apache")):
        assert label in {d[2].label for d in scanner.detections(text.encode().split()) if not d[3]}, text


def test_license_gate_changes_nothing(spark):
    """The same detections as when every signature looks at every text, and only notices are labelled."""
    scanner = licenses.Scanner()
    rng = random.Random(8)
    names = sorted({w.decode() for s in scanner.signatures for k in s.keywords for w in k})
    texts = [[rng.choice(names) if rng.random() < 0.7 else rng.choice(["the", "under", "3", "2", "0", "of", "by"]) for _ in range(rng.randrange(30))] for _ in range(300)]
    texts += [r.text.lower().split() for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    for words in texts:
        words = [w.encode() for w in words]
        text = " ".join(w.decode() for w in words)
        plain = sorted((text[: m.start()].count(" "), s.label, s.priority) for s in scanner.signatures for m in s.pattern.finditer(text))
        assert sorted((a, s.label, s.priority) for a, _, s, _ in scanner.detections(words)) == plain
    assert not scanner.detections("das geht mit der zeit und die it this is fair enough".encode().split())


def test_targets_and_flow():
    # weights 5, 2, 1, 5: the first and the last stop at 200, the other two share 200 as 2 to 1
    t = mixing.targets({"a": 100, "b": 100, "c": 100, None: 100})
    assert t == {"a": 200, "b": pytest.approx(400 / 3), "c": pytest.approx(200 / 3), None: 200}
    assert mixing.chosen([5, 9, 4, 7], 13) == [0, 1, 1, 0]
    assert mixing.chosen([], 3) == []
    # a pattern in both sources fills what its own patterns can't without a second pass
    assert mixing.min_cost_flow([100, 100, 50], [[0], [1], [0, 1]], [140, 110], 2) == [100, 100, 50]
    assert mixing.min_cost_flow([10], [[0]], [25], 2) == [20]


def test_mixing(spark, folder, docs):
    got = queries.op3_mixing(spark, folder).collect()
    texts = {r.doc_id: r for r in docs.collect()}
    by = collections.defaultdict(lambda: [0, 0])
    target = {}
    for r in got:
        d = texts[r.doc_id]
        if r.doc_id is not None:
            assert r["size"] == len(brute.words(d.text))
            by[d.source][0] += r["size"]
            by[d.source][1] += r.taken
            target[d.source] = r.target
        assert r.taken <= 2 * r["size"]
    assert len(got) == docs.count()
    del target[None]  # one text of 6,000 words and a few of some words
    for s, t in target.items():
        assert abs(by[s][1] - t) <= max(30, 0.01 * t), s
    again = queries.op3_mixing(spark, folder).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_flow_is_cheapest():
    """Against all ways to give whole words, on small networks."""
    import itertools

    rng = random.Random(7)
    for _ in range(60):
        n, m = rng.randint(1, 3), rng.randint(1, 3)
        supply, quota = [rng.randint(0, 3) for _ in range(n)], [rng.randint(0, 4) for _ in range(m)]
        belongs = [sorted(rng.sample(range(m), rng.randint(1, m))) for _ in range(n)]
        cost = lambda give, size: sum(-(-k // size) for k in range(1, give + 1)) if give else 0
        best = None
        for give in itertools.product(*(range(2 * x + 1) for x in supply)):
            ways = [[w for w in itertools.product(*(range(g + 1) if j in belongs[i] else (0,) for j in range(m))) if sum(w) == g] for i, g in enumerate(give)]
            if any(all(sum(w[j] for w in way) <= quota[j] for j in range(m)) for way in itertools.product(*ways)):
                key = (-sum(give), sum(cost(g, x) for g, x in zip(give, supply, strict=True)))
                best = key if best is None else min(best, key)
        got = mixing.min_cost_flow(supply, belongs, quota, 2)
        assert (-sum(got), sum(cost(g, x) for g, x in zip(got, supply, strict=True))) == best


@pytest.mark.parametrize("scale", [1, 10**9])
def test_choice_is_nearest_at_every_size(scale):
    import itertools

    rng = random.Random(5)
    for _ in range(80):
        sizes = [scale * rng.randint(1, 60) for _ in range(rng.randint(0, 9))]
        want = scale * rng.randint(0, 200)
        out = mixing.chosen(sizes, want)
        sums = [sum(x for x, on in zip(sizes, c, strict=True) if on) for c in itertools.product((0, 1), repeat=len(sizes))]
        assert sum(x for x, on in zip(sizes, out, strict=True) if on) == max(x for x in sums if x <= want)


def test_mixing_beyond_the_patterns(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_PATTERNS", 3)
    rng = random.Random(2)
    rows = [(k, "w " * rng.randint(1, 30), sorted(rng.sample("abcdef", rng.randint(1, 3)))) for k in range(600)]
    d = spark.createDataFrame(rows, "doc_id long, text string, members array<string>")
    taken, sources = mixing.mix_sources(d, F.col("members"))
    got = taken.collect()
    assert sorted(r.doc_id for r in got) == list(range(600))
    assert all(r.copies in (0, 1, 2) for r in got)
    assert sum(r.taken for r in got) <= sum(r.target for r in sources.collect()) + 6
    assert sum(r.taken for r in got) > 0.8 * 1.5 * sum(r["size"] for r in got)


def test_mixing_narrows_large_patterns(spark):
    d = spark.range(30_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 9).cast("int")).alias("text"), F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("source"))
    taken, sources = mixing.mix_sources(d, F.array("source"))
    sums = {r.s: (r.t, r.n) for r in taken.groupBy(F.col("members")[0].alias("s")).agg(F.sum("taken").alias("t"), F.count("*").alias("n")).collect()}
    for r in sources.collect():
        assert abs(sums[r.source][0] - r.target) <= 2
    assert sums["a"][1] + sums["b"][1] == 30_000


def plain_leaks(docs, items, window):
    wins = collections.defaultdict(set)
    for i, t in items:
        w = brute.tokens(t)
        if i is None or not w:
            continue
        m = min(window, len(w))
        for p in range(len(w) - m + 1):
            wins[tuple(w[p : p + m])].add(str(i))
    out = {}
    for i, t in docs:
        w = brute.tokens(t)
        on, ids = set(), set()
        for m in {len(x) for x in wins}:
            for p in range(len(w) - m + 1):
                if found := wins.get(tuple(w[p : p + m])):
                    on.update(range(p, p + m))
                    ids |= found
        out[i] = (len(w), len(on), sorted(ids))
    return out


@pytest.mark.parametrize("index_pairs", [10**6, 40])
def test_decontamination(spark, index_pairs):
    items = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short item"), (3, None), (4, ""), (None, "no id here"), (10, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (2, "short item")]
    items += [(100 + k, " ".join(f"w{k}x{j}" for j in range(25))) for k in range(6)]
    rows = [(1, "Well ALPHA beta, gamma delta epsilon zeta eta theta iota kappa - so"), (2, "short item short"), (3, None), (4, "clean text"), (5, " ".join(f"w3x{j}" for j in range(4, 16))), (1, "Well ALPHA beta, gamma delta epsilon zeta eta theta iota kappa - so")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = plain_leaks(rows, items, 10)
    got = decontaminate.decontaminate(d, b, window=10, index_pairs=index_pairs).collect()
    assert len(got) == len(rows)
    import hashlib

    for r in got:
        n, hit, ids = want[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(ids), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(ids).encode()).hexdigest()


def test_decontamination_partial(spark):
    d = spark.createDataFrame([(1, "a b c d e f g X i j k l m n o p"), (2, "a b X d Y f g Z i j")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c d e f g h i j k l m n o p")], "item_id long, text string")
    got = {r.doc_id: r.contaminated for r in decontaminate.decontaminate(d, b, window=16, threshold=0.5).collect()}
    assert got == {1: True, 2: False}


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(k, k + 1) for k in range(300, 360)] + [(5, 5), (None, 3)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "a long, b long"), Shared(spark)).collect()}
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        if a is not None and a != b:
            up[max(top(a), top(b))] = min(top(a), top(b))
    assert {frozenset(k for k in got if got[k] == r) for r in set(got.values())} == {frozenset(k for k in up if top(k) == r) for r in {top(k) for k in up}}


def test_near_duplicates(spark, folder, docs):
    got = queries.op9_minhash(spark, folder).collect()
    rows = {(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None}
    want = brute.components(sorted(rows, key=str), 2, 80)
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is None:
            continue
        text = dict(rows)[r.doc_id]
        assert r.n_shingles == len(brute.shingles(text, 2))
        if not brute.shingles(text, 2):
            assert r.component_id == r.doc_id
        else:
            assert r.component_id == want[r.doc_id], r.doc_id
        assert r.kept == (r.doc_id == r.component_id)


def test_near_duplicates_beyond_leaders(spark):
    """A chain of edits whose ends don't link, among texts that share buckets without linking."""
    rng = random.Random(3)
    word = [f"w{k}" for k in range(400)]
    base = [rng.choice(word) for _ in range(120)]
    rows = []
    for k in range(60):
        w = list(base)
        for p in rng.sample(range(120), 10 + k % 9):
            w[p] = rng.choice(word)
        rows.append((k, " ".join(w)))
    chain = list(base)
    for k in range(12):
        for p in rng.sample(range(120), 5):
            chain[p] = f"c{k}"
        rows.append((100 + k, " ".join(chain)))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), common.space_hashes, 2, 80).collect()}
    assert got == brute.components(rows, 2, 80)


def test_signature_estimates():
    rng = np.random.default_rng(0)
    for s in (0.5, 0.8, 0.95):
        n = 2000
        common_ = int(2 * n * s / (1 + s))
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        b = np.concatenate([a[:common_], rng.integers(0, 1 << 63, n - common_, dtype=np.uint64)])
        shape = minhash.DOCUMENTS
        _, p = minhash.signatures(np.stack([minhash.minima(np.unique(x), shape.hashes) for x in (a, b)]), shape)
        planes = p.view(np.uint64).reshape(2, minhash.BITS, shape.words)
        differ = np.bitwise_count(np.bitwise_or.reduce(planes[0] ^ planes[1], axis=0)).sum()
        share = 1 - differ / shape.hashes
        est = (share - 1 / 16) / (1 - 1 / 16)
        assert abs(est - s) < 0.15
        assert minhash.may_link(0.8, shape.hashes) < 0.7


STATED = {("net", "/"): "block", ("example.net", "/en/"): "allow", ("example.com", "/de/"): "block", ("org", "/fr/"): "allow"}


def test_urls(spark, folder):
    pages = [(1, "http://A.Example.NET/en/x?q#f"), (2, "https://x.net"), (3, "http://x.net/"), (4, "ftp://b.example.com/de/1"), (5, "no url"), (6, None), (7, "http://org/fr/a"), (8, "http://borg/fr/a"), (9, "x://y://z/p"), (1, "http://A.Example.NET/en/x?q#f")]
    d = spark.createDataFrame(pages, "page_id long, url string")
    got = urls.judge(d, d.select("url", F.lit(None).cast("boolean").alias("block"))).collect()
    assert len(got) == len(pages)
    for r in got:
        u = dict(pages)[r.page_id] or ""
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u)
        host, path = (m[1].translate(brute.LOWER), m[2]) if m else ("", "")
        best = max(((h, p) for h, p in STATED if (host == h or host.endswith("." + h)) and path.startswith(p)), key=lambda x: len(x[0] + x[1]), default=None)
        assert (r.host, r.path) == (host, path)
        assert r.rule == ("".join(best) if best else None)
        assert r.verdict == (STATED[best] if best else "allow")


def test_urls_mined(spark):
    rows = [(f"http://spam{k % 3}.example.com/win/{k}", True) for k in range(150)] + [(f"http://good{k % 5}.example.com/win/{k}", False) for k in range(150)] + [(f"http://spam0.example.com/docs/{k}", False) for k in range(60)]
    d = spark.createDataFrame(rows, "url string, block boolean")
    pages = spark.createDataFrame([(1, "http://spam0.example.com/win/999"), (2, "http://good1.example.com/win/7"), (3, "http://spam0.example.com/docs/7")], "page_id long, url string")
    mined = urls.mine(d.select(urls.tokens(F.col("url")).alias("tokens"), "block"), 0.01, 0.8).collect()
    # every rule holds its promise on the data
    sets = [(set(r.t), r.block) for r in d.select(urls.tokens(F.col("url")).alias("t"), "block").collect()]
    assert mined
    for m in mined:
        hit = [b for t, b in sets if set(m.antecedent) <= t]
        right = sum(hit) if m.block else len(hit) - sum(hit)
        assert right / len(sets) >= 0.01
        assert right / len(hit) == pytest.approx(m.confidence)
        assert m.token in m.antecedent
    assert {r.page_id: r.verdict for r in urls.judge(pages, d, rules=[]).collect()} == {1: "block", 2: "allow", 3: "allow"}


def test_urls_mined_completely(spark):
    """Against all token sets of random URLs: each that keeps the promise is a rule or holds a part that is as sure."""
    import itertools

    rng = random.Random(4)
    rows = []
    for _ in range(150):
        t = [x for x in "abcde" if rng.random() < 0.5]
        rows.append((t, rng.random() < (0.95 if {"a", "b"} <= set(t) else 0.1)))
    d = spark.createDataFrame(rows, "tokens array<string>, block boolean")
    mined = {(frozenset(r.antecedent), r.block): r.confidence for r in urls.mine(d, 0.02, 0.8).collect()}
    rows = [(set(t), b) for t, b in rows if t]
    base = sum(b for _, b in rows) / len(rows)
    sure = {}
    for n in range(1, 6):
        for s in map(frozenset, itertools.combinations("abcde", n)):
            own = [b for t, b in rows if s <= t]
            for block in (True, False):
                right = sum(b == block for b in own)
                if not own or right / len(rows) < 0.02 or right / len(own) < 0.8:
                    continue
                p, m, z = right / len(own), len(own), urls.Z
                low = (p + z * z / (2 * m) - z * ((p * (1 - p) + z * z / (4 * m)) / m) ** 0.5) / (1 + z * z / m)
                if low > (base if block else 1 - base):
                    sure[s, block] = p
    want = {k for k, p in sure.items() if not any(q < k[0] and b == k[1] and sure[q, b] >= p - 1e-12 for q, b in sure)}
    assert want and set(mined) == want


def test_toxicity(spark):
    rng = random.Random(6)
    clean = [f"word{k}" for k in range(300)]
    bad = ["nasty", "vile", "awful", "vilest"]
    rows, labels = [], []
    for k in range(600):
        w = [rng.choice(clean) for _ in range(40)]
        toxic = k % 5 == 0
        for _ in range((k // 5) % 6 + 1 if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        rows.append((k, " ".join(w)))
        labels.append((k, int(toxic)))
    rows += [(1000, None), (1001, ""), (1002, "vile vile nasty awful " * 30)]
    labels += [(None, 1), (5, None), (99999, 1)]
    d, y = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(d, y.where("doc_id % 2 = 0"))
    got = {r.doc_id: r for r in toxicity.score(d, model).collect()}
    held = [k for k in range(600) if k % 2]
    assert sum(got[k].toxic == (k % 5 == 0) for k in held) / len(held) > 0.97
    assert not got[1000].toxic
    assert got[1002].grade == 2
    assert got[1002].severity > got[0].severity > got[1].severity
    assert np.all(np.diff(model.cuts) > 0)
    none = toxicity.score(d, toxicity.train(d, y.where("toxic = 0")))
    assert none.where("toxic").count() == 0


def test_token_store(spark, folder, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    got = sorted(queries.op8_token_store(spark, folder).collect(), key=lambda r: r.start)
    assert len(got) == docs.count()
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    texts = {r.doc_id: r.text for r in docs.where("doc_id is not null").collect()}
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
        if r.doc_id is not None:
            want = t.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [2]
            assert (r.n_tokens, r.ids_crc32) == (len(want), brute.crc_of_ids(want)), r.doc_id


def test_codes_random_access():
    rng = np.random.default_rng(1)
    for n in (0, 1, 511, 512, 513, 5000):
        ids = (rng.integers(0, 1 << 24, n) >> rng.integers(0, 24, n)).astype(np.uint32)
        c = token_store.Codes(token_store.pack(ids))
        assert len(c) == n
        assert np.array_equal(c.all(), ids)
        for i in range(0, n, 37):
            assert c[i] == ids[i]


def test_encoder_is_exact():
    e = token_store.Encoder(queries.tokenizer_path(), 2)
    rng = random.Random(3)
    parts = ["a", "B", "é", "Ā", " ", "  ", "\n", "\t", "\u00a0", ".", ",", "'s", "'", "日", "!", "<|endoftext|>", "1", "²", "-", "\x1c", "ß", "Ⅷ", "😀", "ن"]
    for _ in range(3000):
        x = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        ids = e.tokenizer.encode(x, add_special_tokens=False).ids
        assert e(x) == b"".join(i.to_bytes(4, "little") for i in [*ids, 2]), x


def test_token_store_looks_words_up_without_their_space():
    e = token_store.encoder(queries.tokenizer_path(), 2)
    assert e is token_store.encoder(queries.tokenizer_path(), 2)
    rng = random.Random(4)
    words = ["a", "Bc", "é", "Ā1", "x.", "y,", "'s", "日本", "<|endoftext|>", "12", "²", "ß!", "😀", "\x1c", "\u00a0", ""]
    for k in range(2000):
        x = "".join(rng.choice(words[: 16 if k % 2 else 13]) + rng.choice([" ", " ", "\n", "."]) for _ in range(rng.randint(0, 12))) + "z"
        ids = e.tokenizer.encode(x, add_special_tokens=False).ids
        assert e(x) == b"".join(i.to_bytes(4, "little") for i in [*ids, 2]), x
    e("one wordofitsown two\nthree")
    assert "wordofitsown" in e.spaced and " wordofitsown" not in e.known


def test_language_phrases():
    model = language.Model({"x": "abracadabra", "y": "simsalabim"})

    def parse(text, sample):
        n, i = 0, 0
        while i < len(text):
            k = 1
            while i + k < len(text) and text[i : i + k + 1] in sample:
                k += 1
            n, i = n + 1, i + k
        return n

    rng = random.Random(2)
    for _ in range(200):
        t = "".join(rng.choice("abcdrsilm") for _ in range(rng.randint(1, 60)))
        codes, _ = model.alphabet.classes(t)
        assert model.phrases([codes]).tolist() == [[parse(t, "abracadabra"), parse(t, "simsalabim")]]
    for n in (511, 512, 513, 1500, 4000):  # a text is parsed across blocks
        t = "".join(rng.choice("abcdrsilm") if rng.random() < 0.02 else "abracadabra"[k % 11] for k in range(n))
        codes, _ = model.alphabet.classes(t)
        assert model.phrases([codes, codes[:600]]).tolist() == [[parse(x, "abracadabra"), parse(x, "simsalabim")] for x in (t, t[:600])]
    long = "abra" * 600
    assert model.predict([long, "zz 12", "12", "", None])[0] == ["x", "y", "und", "und", "und"]


def test_language_of_many_letters():
    rng = random.Random(3)
    scripts = {"de": range(0x61, 0x7B), "el": range(0x3B1, 0x3C2), "ko": range(0xAC00, 0xAC00 + 400), "ru": range(0x430, 0x450), "zh": range(0x4E00, 0x4E00 + 600)}
    words = {k: ["".join(chr(rng.choice(v)) for _ in range(rng.randint(2, 6))) for _ in range(300)] for k, v in scripts.items()}
    fresh = lambda k, n: " ".join(rng.choice(words[k]) for _ in range(n))
    model = language.Model({k: fresh(k, 400 + 50 * i) for i, k in enumerate(scripts)})
    asked = [k for k in scripts for _ in range(20)]
    named, scores = model.predict([fresh(k, 12) for k in asked])
    assert named == asked
    assert min(scores) > 0.2
    move = language.suffix_automaton([2, 3, 2, 4, 2, 3])
    dense, sparse = language.Dense(move, 6), language.Sparse(move, 6)
    state, c = (x.ravel() for x in np.meshgrid(np.arange(len(move) + 1), np.arange(6)))
    assert (dense.step(state, c) == sparse.step(state, c)).all()


def test_language_held_out(spark, folder, docs):
    got = queries.op10_language(spark, folder).collect()
    assert len(got) == docs.count()
    by = {r.doc_id: r for r in docs.collect()}
    held = [r for r in got if r.held_out and by[r.doc_id].lang is not None]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum(r.lang_pred == by[r.doc_id].lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got if r.doc_id in (9500, 9501, 9502, 9510)} == {"und"}


def test_pipeline(spark, folder):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    toxic = p.reject_toxic(spark, docs, folder)
    assert toxic.columns == docs.columns
    one = p.drop_near_copies(spark, docs, folder)
    ids = [r.doc_id for r in one.collect()]
    named = [i for i in ids if i is not None]
    assert len(named) == len(set(named))
    rows = {(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None}
    want = brute.components([(i, " ".join(brute.tokens(t))) for i, t in rows], 5, 80)
    assert set(named) == {i for i in want if want[i] == i}
    clean = p.drop_leaks(spark, docs, folder)
    leaks = plain_leaks([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()], 10)
    assert {r.doc_id for r in clean.collect()} == {i for i, (_, hit, _) in leaks.items() if not hit}
    mixed = collections.Counter(r.doc_id for r in p.mix(spark, one, folder).collect())
    taken = mixing.mix_sources(one, F.array("source"))[0].where("copies > 0").collect()
    assert sum(mixed.values()) == sum(r.copies for r in taken)
    assert [n for n, _ in p.STAGES] == ["toxicity", "near_dedup", "decontaminate", "mix", "token_store"]
    got = p.run(spark, folder).collect()
    assert sum(r.n_tokens for r in got) == max(r.start + r.n_tokens for r in got)


CLASH = ["key", "nid", "h", "size", "hash", "text_", "mix_key", "kept_id", "toxic", "severity", "grade", "contaminated", "n_words", "copies", "root", "id_", "c0", "place0", "row", "spanforge_row_file"]


def test_pipeline_tells_rows_apart(spark, folder, tmp_path):
    """One id on two texts, ids that are null, equal rows and columns of any name: every stage keeps what it should."""
    import corpus_pipeline as p

    rng = random.Random(11)
    fresh = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(n))
    same = fresh(40)
    rows = [(1, fresh(40), "a"), (1, fresh(40), "a"), (2, same, "b"), (3, same, "b"), (2, same, None), (None, fresh(30), None), (None, fresh(30), None), (4, None, "a"), (5, "", "a"), (6, fresh(20_000), "c")]
    d = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], SCHEMA)
    for c in CLASH:
        d = d.withColumn(c, F.lit("clash"))
    d.write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("benchmark", "labels"):
        os.symlink(f"{SF}/{t}.parquet", f"{tmp_path}/{t}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    told = lambda df: sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in df.collect())
    want = sorted((i is None, i or 0, t or "") for i, t, _ in rows)
    for stage in (p.reject_toxic, p.drop_leaks):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert told(out) == want
    one = p.drop_near_copies(spark, docs, str(tmp_path))
    assert one.columns == docs.columns
    assert told(one) == sorted((i is None, i or 0, t or "") for k, (i, t, _) in enumerate(rows) if k not in (3, 4))
    mixed = p.mix(spark, docs, str(tmp_path))
    assert mixed.columns == docs.columns
    assert set(told(mixed)) <= set(want)
    assert all(n <= 2 * want.count(x) for x, n in collections.Counter(told(mixed)).items())
    assert {r.doc_id for r in p.run(spark, str(tmp_path)).collect()} <= {i for i, _, _ in rows}


@pytest.mark.parametrize("name", ["op1_quality", "op2_licenses", "op3_mixing", "op4_decontaminate", "op7_toxicity", "op8_token_store", "op9_minhash", "op10_language", "op11_alignment", "op12_packing"])
def test_columns_of_any_name(name, spark, docs, tmp_path):
    odd = docs.drop("n_chars").where("doc_id >= 9000 or doc_id < 60 or doc_id is null")
    for k, d in enumerate((odd, odd.select("*", *[F.lit("clash").alias(c) for c in CLASH]))):
        d.coalesce(1).write.parquet(f"{tmp_path}/{k}/documents.parquet")
        for t in ("benchmark", "labels"):
            os.symlink(f"{SF}/{t}.parquet", f"{tmp_path}/{k}/{t}.parquet")
    a, b = (sorted(map(str, queries.queries()[name](spark, f"{tmp_path}/{k}").collect())) for k in (0, 1))
    assert a == b


def test_empty_pipeline(spark, empty):
    import corpus_pipeline as p

    assert p.run(spark, empty).count() == 0
