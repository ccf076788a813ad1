"""Uses, chunks and regions against plain versions; grids that blanks set out."""

from __future__ import annotations

import random
import re
from decimal import Decimal

import pytest

from spanforge.operators import contexts as C
from spanforge.operators import extract as X

TERMS = ["Base Rate", "Alternate Base Rate", "Rate", "Loan", "Term Loan", "Term Loan Agent", "L/C"]


def plain_mentions(text, terms):
    """One alternation of all terms, longest first."""
    p = re.compile("|".join(rf"(?<![A-Za-z0-9&'’/-]){re.sub(r' ', r'\\s+', re.escape(t).replace('\\ ', ' '))}(?![A-Za-z0-9&'’/-])" for t in sorted(terms, key=len, reverse=True)))
    return [(" ".join(m[0].split()), m.start(), m.end()) for m in p.finditer(text)]


@pytest.mark.parametrize("seed", range(40))
def test_mentions(seed):
    rng = random.Random(seed)
    words = ["Base", "Rate", "Alternate", "Loan", "Term", "Agent", "the", "a", "L/C", "Loans", "Rate."]
    text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\n", ", "]) for _ in range(60))
    assert list(C.mentions(text, TERMS)) == plain_mentions(text, TERMS)


def agreement(rng, n):
    names = rng.sample(["Alpha", "Beta", "Gamma", "Delta", "Omega", "Alpha Rate"], n)
    filler = lambda k: "lorem ipsum " * rng.randrange(k)
    text = "Section 1.01 Definitions. " + "".join(f"“{t}” means {filler(6)}the {rng.choice(names)} and {rng.choice(names)}. " for t in names)
    return text + "Section 2.01 Loans. " + "".join(f"{filler(30)}The {rng.choice(names)} applies. " for _ in range(rng.randrange(25)))


def plain_chunks(text, defs, pad, most, gap):
    out = {}
    for t, (a, b) in defs.items():
        spans = [(a, b)] + [(max(0, x - pad), min(len(text), y + pad)) for x, y in [(x, y) for n, x, y in plain_mentions(text, list(defs)) if n == t and not a <= x < b][:most]]
        merged = []
        for x, y in sorted(spans):
            if merged and x - merged[-1][1] <= gap:
                merged[-1][1] = max(merged[-1][1], y)
            else:
                merged.append([x, y])
        out[t] = merged
    return out


def plain_closure(defs, edges, budget):
    out = {}
    for start in defs:
        seen, level = {start: 0}, [start]
        while level:
            level = sorted({b for a, b in edges if a in level} - set(seen))
            seen |= {t: max(seen.values()) + 1 for t in level}
        used, own = 0, []
        for t in sorted((t for t in seen if t in defs and seen[t] <= 8), key=lambda t: (seen[t], t)):
            used += defs[t][1] - defs[t][0]
            if used > budget:
                break
            own.append(t)
        out[start] = own
    return out


def test_chunks(spark):
    rng = random.Random(2)
    texts = [agreement(rng, rng.randrange(1, 7)) for _ in range(25)] + [None, "", "no terms"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    defs = X.definitions(docs).cache()
    edges = X.uses(defs).cache()
    by = {}
    for r in defs.collect():
        by.setdefault(r.doc_id, {})[r.term] = (r.start, r.end)
    links = {}
    for r in edges.collect():
        links.setdefault(r.doc_id, []).append((r.src, r.dst))
    got = {}
    for r in C.definitional(docs, defs, pad=40, most=4, gap=30).orderBy("part").collect():
        got.setdefault((r.doc_id, r.term), []).append([r.start, r.end])
    assert got == {(d, t): s for d, own in by.items() for t, s in plain_chunks(texts[d], own, 40, 4, 30).items()}
    parts = C.closures(defs, edges, budget=150).cache()
    got = {}
    for r in parts.orderBy("ix").collect():
        got.setdefault((r.doc_id, r.anchor), []).append(r.term)
    want = {(d, t): x for d, own in by.items() for t, x in plain_closure(own, links.get(d, []), 150).items()}
    assert got == {k: v for k, v in want.items() if v}
    whole = {(r.doc_id, r.anchor): r.text for r in C.texts(parts, docs, ["doc_id", "anchor"], "ix").collect()}
    assert whole == {(d, a): "\n[...]\n".join(texts[d][slice(*by[d][t])] for t in ts) for (d, a), ts in got.items()}
    none = docs.limit(0)
    assert C.definitional(none, X.definitions(none)).count() == 0 and C.text_grids(none, ["doc_id"]).count() == 0


D = "“Alpha” means one. “Beta” means two. "
REGIONS = [
    ("ARTICLE I\nDEFINITIONS\n\nSection 1.01 Defined Terms. " + D + "\n\nARTICLE II\nLOANS\n\nSection 2.01 Loans. “Gamma” means three.\n", "ARTICLE I\nD", "ARTICLE II"),
    ("Section 1.01 Definitions. None here.\nARTICLE II\nLOANS\nx\n\nEXHIBIT A\n\nARTICLE I\nDEFINITIONS\n" + D + "\nARTICLE II\nMORE\ny\n", "ARTICLE I\nD", "ARTICLE II\nMORE"),
    ("ARTICLE I\nGENERAL\nSection 1.01 Terms. none\nARTICLE II\nLOANS\n" + D + "\nARTICLE III\nFEES\n“Fee” means it.\n", "ARTICLE II\n", "ARTICLE III"),
    ("Section 1.01 Definitions. Nothing at all.\nSection 2.01 Loans. None.\n", "Section 1.01", None),
    ("No headings. " + D, "No", None),
]


def test_regions(spark):
    docs = spark.createDataFrame([(k, t) for k, (t, *_) in enumerate(REGIONS)] + [(9, None)], "doc_id long, text string")
    got = {r.doc_id: (r.start, r.end) for r in C.definitions_region(docs).collect()}
    want = {}
    for k, (t, a, b) in enumerate(REGIONS):
        want[k] = (t.index(a), t.index(b, t.index(a) + 1) if b else len(t))
    assert got == want


@pytest.mark.parametrize("seed", range(40))
def test_text_grids(seed):
    """Grids of any widths, with or without labels, among other text."""
    rng = random.Random(seed)
    labels = rng.sample(["Eurodollar Rate", "Base Rate", "Commitment Fee", "SOFR"], rng.randrange(1, 4))
    mark = rng.choice(["{r}", "Level {r}", "{n}"])
    rows = [[mark.format(r=["I", "II", "III", "IV"][k], n=k + 1), rng.choice(["> 5.50 to 1.00", "<= 5.50 and > 4.50", "less than 4.50:1.00"]), *(f"{rng.randrange(1, 6)}.{rng.randrange(100):02d}%" for _ in labels)] for k in range(rng.randrange(2, 5))]
    head = ["Level", "Leverage Ratio", *labels]
    headed = rng.random() < 0.7
    widths = [max(len(r[c]) for r in [*rows, head]) + rng.randrange(2, 6) for c in range(len(head))]
    say = lambda r: " " * 3 + "".join(x.ljust(w) for x, w in zip(r, widths, strict=True)).rstrip()
    grid = "\n".join(map(say, ([head] if headed else []) + rows))
    text = f"The margin is as follows, 5.00% at most:\n\n{grid}\n\nLevel I is 3.00% of it. Nothing more."
    got = list(C.text_grid_rows(text))
    assert [(level, band, c, label, rate) for _, _, level, band, c, label, rate in got] == [(r[0], r[1], c, head[c] if headed else "", Decimal(r[c][:-1])) for r in rows for c in range(2, len(r))]
    assert all(text[a:b].strip().startswith(level) for a, b, level, *_ in got)


def test_grids_that_are_none():
    assert list(C.text_grid_rows(None)) == list(C.text_grid_rows("")) == []
    assert list(C.text_grid_rows("I  2.00% or less  1.00%\nII  3.00% or less  2.00%")) == []  # a rate in the band
    assert list(C.text_grid_rows("I agree that 5.00% is paid.\nX of 3.00% too.")) == []
