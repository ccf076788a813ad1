"""Token alignment, packing and vector codes against plain versions, and on awkward rows."""

from __future__ import annotations

import collections
import hashlib
import math
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanforge.llm import alignment, packing, queries, vector_codes
from spanforge.llm.common import Shared

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
P = pytest.importorskip("public_tokenizers")
ODD = [None, "", " ", "  ", "x", " x", "x ", "a  b", "a\tb\n c\r\n\r\nd", "ÀÉ é 日本語 テスト", "x▁y", "<|endoftext|> <s> </s> <0x41>", "=" * 200, "no-break space  x", "\x1c a \x00 b", "don't I'll 12345 67.89", "\U0001f600\U0001f600 ok", "ab" * 500, "unbelievable " * 50, "́a ́", "a" * 5000]


def texts(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    bits = rng.choice([["un", "be", "Lie", " ", " ", "\n", ".", ",", "'s", "-", "é", "x", "(", " the", "12", "²", "*/"]] + [None]) or ["un", "be", "lie", "vable", " ", " ", "  ", "\n", ".", ",", "é", "日", "本", "=", "==", "12", "3", "'s", "▁", "<", "token", "ization", "Ä", "\t", " ", "the", " the"]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 120))) for _ in range(n)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("new")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    rows += [(5000 + k, t) for k, t in enumerate(ODD + texts(3, 80))]
    rows += [rows[0], rows[1], (None, "a text without an id"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("block", "groups", "length", "at", "n_a", "piece", "g")})
    docs.repartition(5).write.parquet(f"{d}/documents.parquet")
    docs.where("false").write.parquet(f"{d}/none.parquet")
    return str(d)


def plain_alignment(rows):
    """doc rows: (doc_id, text) to the digest, with links written out."""
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(str(P.path("byte_bpe_50k.json")))
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=str(P.path("piece_bpe_32k.model")))
    # the byte-level alphabet: printable bytes are themselves, the others follow from 256
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    out, holding = [], collections.Counter()
    for doc_id, text in rows:
        groups = []
        if text:
            a = t.encode(" " + text, add_special_tokens=False).ids
            b = sp.encode(text)
            bytes_a = [bytes(letters[c] for c in t.id_to_token(i)) for i in a]
            bytes_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
            want = (" " + text).encode()
            if b"".join(bytes_a) == want == b"".join(bytes_b):
                ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
                at = 0
                for e in sorted(set(ends_a) & set(ends_b)):
                    groups.append(([i for i, x in zip(a, ends_a, strict=True) if at < x <= e], [i for i, x in zip(b, ends_b, strict=True) if at < x <= e]))
                    at = e
        holding.update({(x, y) for g in groups for x in g[0] for y in g[1]})
        out.append((doc_id, groups))
    best = collections.defaultdict(int)
    for (x, _), n in holding.items():
        best[x] = max(best[x], n)
    for doc_id, groups in out:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        text = ";".join(f"{','.join(map(str, g[0]))}|{','.join(map(str, g[1]))}" for g in groups)
        yield (doc_id, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links), sum(holding[x] == best[x[0]] for x in links), sum(holding[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if groups else "")


def key(r):
    return tuple((x is None, x) for x in r)


@pytest.mark.parametrize("block_groups", [alignment.BLOCK_GROUPS, 150])
def test_alignment(spark, folder, block_groups, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    monkeypatch.setattr(alignment, "BLOCK_GROUPS", block_groups)
    a, b = str(P.path("byte_bpe_50k.json")), str(P.path("piece_bpe_32k.model"))
    real = alignment.encode_blocks
    monkeypatch.setattr(alignment, "encode_blocks", lambda *x, **y: real(*x, **y, block_groups=block_groups))
    got = [tuple(r) for r in alignment.align_tokens(docs, a, b, Shared(spark)).collect()]
    want = list(plain_alignment([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]))
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sum(r[3] > 0 for r in got) > 100 and sum(r[3] == 0 for r in got) > 3


def test_alignment_query(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op11_alignment(spark, folder)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain_alignment([tuple(r) for r in rows]), key=key)


def test_alignment_forgets(folder):
    """Pieces and groups that are dropped from memory come again to the same groups."""
    one, two = (alignment.Aligner(str(P.path("byte_bpe_50k.json")), str(P.path("piece_bpe_32k.model"))) for _ in range(2))
    said = lambda x, t: [x.texts[g] for g in np.frombuffer(x(t), "<i4")]
    for t in texts(9, 60) * 2:
        want = said(one, t)
        two.clear()
        assert said(two, t) == want == [one.texts[g] for g in np.frombuffer(one.whole(t) or b"", "<i4")]


def test_pair_documents():
    rng = np.random.default_rng(4)
    for _ in range(50):
        n_groups, n_docs = rng.integers(1, 9), rng.integers(1, 9)
        pairs = [np.unique(rng.integers(0, 12, rng.integers(1, 5))) for _ in range(n_groups)]
        held = sorted({(int(d), int(g)) for d, g in zip(rng.integers(0, n_docs, 20), rng.integers(0, n_groups, 20), strict=True)})
        doc, group = np.asarray(held).T
        got = alignment.pair_documents(doc, group, pairs)
        want = collections.Counter()
        for d in set(doc.tolist()):
            want.update({int(x) for dd, g in held if dd == d for x in pairs[g]})
        assert {int(p): int(n) for p, n in zip(*got, strict=True) if n} == dict(want)


def test_packing(spark, folder):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(str(P.path("byte_bpe_50k.json")))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = collections.Counter()
    for d, text in docs.select("doc_id", "text").collect():
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for k, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[d, k, s, e - s, zlib.crc32(np.asarray(ids[s:e], "<u4").tobytes())] += 1
    got = queries.op12_packing(spark, folder).collect()
    assert collections.Counter(tuple(r)[:5] for r in got) == want
    check_sequences([(r.sequence_id, r.offset, r.length) for r in got])


def check_sequences(rows, size=2048):
    by = collections.defaultdict(list)
    for s, o, n in rows:
        by[s].append((o, n))
    for own in by.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= size
    return len(by)


def plain_best_fit(lengths, size):
    """The number of sequences of best fit in decreasing order, a piece at a time."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - n)
        else:
            rooms.append(size - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_plan(seed):
    rng = random.Random(seed)
    size = rng.choice([8, 50, 2048])
    lengths = [min(size, max(1, int(rng.lognormvariate(math.log(size / 6), 1)))) for _ in range(600)] + [rng.randrange(1, size + 1)] * 250
    slots, n = packing.plan(collections.Counter(lengths), size)
    rows = [(first + k, off, length) for length, first, many, off in slots for k in range(many)]
    assert collections.Counter(x[2] for x in rows) == collections.Counter(lengths)
    assert check_sequences(rows, size) == n == plain_best_fit(lengths, size)
    assert -(-sum(lengths) // size) <= n


def test_plan_does_not_grow_with_counts():
    counts = {n: 3 + n % 5 for n in range(1, 2049)}
    slots, n = packing.plan(counts)
    more, m = packing.plan({k: v * 10**9 for k, v in counts.items()})
    assert len(more) < 4 * len(slots) + 4096 and m < 1.01 * 10**9 * n


def plain_codes(rows, parts=4, entries=256, rounds=4):
    """Lloyd's rounds with Python's integers; rows of (vec_id, label, vector)."""
    good = [(i, label, [math.floor(1024 * float(x)) for x in v]) for i, label, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2], r[1] is None, r[1] or 0))
    good = [r for r in good if len(r[2]) == len(good[0][2])]
    width = -(-len(good[0][2]) // parts)
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, _, v in ((i, x, [*v, *[0] * (width * parts - len(v))]) for i, x, v in good)]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = collections.defaultdict(list)
            for c in cut:
                own[nearest(c[p], books[p])[1]].append(c[p])
            books[p] = [[sum(y) // len(own[k]) for y in zip(*own[k], strict=True)] if k in own else e for k, e in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(y) for b in books for e in b for y in e).encode()).hexdigest()
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    total = collections.Counter()
    for (_, label, _), f in zip(good, found, strict=True):
        total[label] += sum(d for d, _ in f)
    return [(i, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), total[label], sha) for (i, label, _), f in zip(good, found, strict=True)]


VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(seed: int, n: int, dim: int, spread: float):
    rng = random.Random(seed)
    rows = [(k, [rng.choice([-1, 1]) * rng.random() * spread for _ in range(dim)], rng.choice([None, 1, 2, 3])) for k in range(n)]
    rows += [(n + k, rows[k % 7][1], 5) for k in range(40)]  # copies
    rows += [(n + 100, None, 1), (n + 101, [None] * dim, 1), (n + 102, [float("nan")] * dim, None), (n + 103, [float("inf"), *[0.0] * (dim - 1)], 2), (None, [0.5] * dim, None), (3, [0.25] * dim, 1), (n + 104, [0.0] * (dim + 1), 1)]
    return rows


@pytest.mark.parametrize(("seed", "n", "dim", "spread", "entries"), [(1, 300, 8, 1.0, 256), (2, 120, 7, 0.004, 16), (3, 60, 4, 3e6, 8), (4, 20, 8, 1.0, 256)])
def test_vector_codes(spark, seed, n, dim, spread, entries):
    rows = vectors(seed, n, dim, spread)
    df = spark.createDataFrame(rows, VECTORS).withColumns({"code": F.lit(1), "v": F.lit("x"), "error": F.lit("y")}).repartition(3)
    shared = Shared(spark)
    got = vector_codes.digest(*vector_codes.compress(df, shared, entries=entries), shared).collect()
    f32 = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    want = plain_codes([(i, label, v) for i, v, label in f32], entries=entries)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_vector_codes_of_huge_components(spark):
    rows = [(k, [3e38, -3e38, float(k), 0.0], None) for k in range(3)]
    shared = Shared(spark)
    got = vector_codes.digest(*vector_codes.compress(spark.createDataFrame(rows, VECTORS), shared), shared).collect()
    assert {r.error for r in got} == {0} and len({r.code for r in got}) == 3


def test_pruning_changes_nothing():
    """Codes after moved entries are those of a full search, and most entries are passed over."""
    rng = np.random.default_rng(1)
    x = rng.integers(-400, 400, (500, 1, 6))
    a = x[:32].transpose(1, 0, 2).copy()
    b = a + rng.integers(-15, 16, a.shape)
    code, error, lower = vector_codes.Round(a, None).first(x[:, 0], 0)
    bytes_, unit = vector_codes.packed(lower)
    kept = bytes_ * unit[:, None]
    assert (kept <= np.sqrt(vector_codes.table(x[:, 0], a[0]))).all()
    again = vector_codes.Round(b, a).again(x[:, 0], 0, code, vector_codes.root(error) * (1 + vector_codes.SLACK), kept)
    full = vector_codes.table(x[:, 0], b[0])
    assert (again[0] == full.argmin(axis=1)).all() and (again[1] == full.min(axis=1)).all()
    assert (again[2] <= np.sqrt(full)).all()


def test_vector_codes_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.sql(queries.oracle_sql()["op13_vector_codes"])
    assert want.columns == queries.op13_vector_codes(spark, SF).columns
    assert sorted(want.fetchall()) == sorted(map(tuple, queries.op13_vector_codes(spark, SF).collect()))


def test_empty(spark, folder, tmp_path):
    none = spark.read.parquet(f"{folder}/none.parquet")
    a, b = str(P.path("byte_bpe_50k.json")), str(P.path("piece_bpe_32k.model"))
    assert alignment.align_tokens(none, a, b, Shared(spark)).count() == 0
    assert packing.pack_documents(none, a, 0, Shared(spark)).count() == 0
    shared = Shared(spark)
    assert vector_codes.digest(*vector_codes.compress(spark.createDataFrame([(1, None, 1)], VECTORS), shared), shared).count() == 0
