"""Outlines, amendments and operative texts against plain versions, over texts of mixed forms."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from spanforge.operators import operative as O
from spanforge.operators import outline as L


def ids(text):
    return [s.id for s in L.sections(text)]


# -- headings
def plain_rise(keys, weights):
    """The heaviest rising subsequence by trying all of them."""
    best = (0, [])
    for n in range(len(keys) + 1):
        for at in itertools.combinations(range(len(keys)), n):
            if all(keys[a] < keys[b] for a, b in zip(at, at[1:], strict=False)):
                w = sum(weights[a] for a in at)
                if w > best[0]:
                    best = (w, list(at))
    return best


@pytest.mark.parametrize("seed", range(40))
def test_heaviest_rise(seed):
    rng = random.Random(seed)
    keys = [(rng.randrange(4), rng.randrange(4)) for _ in range(rng.randrange(11))]
    weights = [rng.randrange(1, 5) for _ in keys]
    got = L.heaviest_rise(keys, weights)
    assert all(keys[a] < keys[b] for a, b in zip(got, got[1:], strict=False)) and got == sorted(got)
    assert sum(weights[p] for p in got) == plain_rise(keys, weights)[0]


def test_roman():
    assert [L.roman(L.in_roman(n)) for n in range(1, 200)] == list(range(1, 200))
    assert L.roman("IIII") is None and L.roman("MIX") is None and L.roman("VX") is None


TITLES = ["Commitments", "Loans and Borrowings", "Use of Proceeds", "Fees, Etc", "Notices", "Governing Law"]


@pytest.mark.parametrize("seed", range(60))
def test_mixed_forms(seed):
    """Headings written in one form an agreement, with contents, wrapped citations, clauses and reserved sections between."""
    rng = random.Random(seed)
    forms = [
        ("Section {id} {t}\n", "ARTICLE {r}\n{T}\n\n"), ("SECTION {id}. {t}.", "ARTICLE {r} {T}\n\n"), ("{id} {t}\n", "Article {a} {t}\n\n"), ("Section {id}. {t}. ", "ARTICLE {r}\n\n{T}\n\n"),
        ("{id}. {t}. ", "SECTION {a}. {T}\n\n"), ("Section\t{id}   {t}\n", "ARTICLE {r} - {T}\n\n"),
    ]
    section, article = rng.choice(forms)
    body, want, contents = "", [], ""
    for a in range(1, rng.randrange(3, 6)):
        t = rng.choice(TITLES)
        want.append(f"SECTION {a}" if article.startswith("SECTION") else f"ARTICLE {a if '{a}' in article else L.in_roman(a)}")
        body += article.format(a=a, r=L.in_roman(a), t=t, T=t.upper())
        for n in range(1, rng.randrange(3, 7)):
            i = f"{a}.{n:02d}"
            want.append(i)
            t = rng.choice(TITLES) if rng.random() < 0.85 else "[Reserved]"
            contents += f"Section {i} {t} {'.' * rng.randrange(4, 20)} {n + a}\n"
            body += section.format(id=i, t=t)
            if t != "[Reserved]":
                body += rng.choice(["", "(a) The Borrower pays (i) now and (ii) later. (b) See clause (a). ", "As set out in Section 1.01 and Section 9.02, no. ", "It pays 1.50% of $2.50 on 3.25 shares. "])
                body += rng.choice(["", f"Subject to\nSection {max(1, a - 1)}.01 Hereof the Lender waits. " if a > 1 else "", "See Section 1.01.\nThe Agent acts. "])
            body += "\n\n"
    front = "CREDIT AGREEMENT\n\n" + (f"TABLE OF CONTENTS\n\n{contents}\n\n" if rng.random() < 0.6 else "")
    got = L.sections(front + body)
    assert [s.id for s in got] == want
    assert all(s.start >= len(front) for s in got)
    assert all(s.end == n for s, n in zip(got, [*(s.start for s in got[1:]), len(front + body)], strict=True))
    assert {s.id for s in got if s.reserved} == {i for i, s in ((s.id, s) for s in got) if "[Reserved]" in s.title}


def test_inline_and_cells():
    run_on = "1 " + " ".join(f"Section {a}.0{n}. {TITLES[(a + n) % 6]}. The Borrower agrees as in Section 1.01 hereof." for a in (1, 2) for n in (1, 2, 3))
    assert ids(run_on) == ["1.01", "1.02", "1.03", "2.01", "2.02", "2.03"]
    cells = "\n".join(f"| 2.{n} | {TITLES[n]} | (a) text under 1.{n} |" for n in range(1, 5))
    assert ids(cells) == ["2.1", "2.2", "2.3", "2.4"]
    assert ids("in accordance with Section 6.4. The Collateral Manager shall give notice thereof.") == []
    assert ids("1. Loans\nIt lends.\n2. Fees\nIt pays.\n") == ["1", "2"]
    assert ids("") == ids(None) == ids("no heading at all, only 12.50 dollars") == []


def test_exhibits_count_anew():
    text = "Section 1.01 Terms\nx\nSection 1.02 Loans\ny\n\nEXHIBIT A\n\nSection 1.01 Form\nz\nSection 1.02 More\n"
    got = L.sections(text)
    assert [(s.division, s.id) for s in got] == [(0, "1.01"), (0, "1.02"), (1, "1.01"), (1, "1.02")]
    assert text[got[1].start : got[1].end] == "Section 1.02 Loans\ny\n\n"


# -- clauses
KIND = {"lower": lambda n: chr(96 + n), "roman": lambda n: L.in_roman(n).lower(), "upper": lambda n: chr(64 + n), "number": str}


def written(rng, order, depth, prefix):
    """A nested list as text, and its paths in order."""
    text, paths = "", []
    for n in range(1, rng.randrange(3, 12 if depth == 0 else 5)):
        mark = f"({KIND[order[depth]](n)})"
        text += f"{mark} {rng.choice(['the fee', 'a rate under clause (b)', 'costs of Section 2.05(a) and (b)', 'it pays'])} "
        paths.append(prefix + mark)
        if depth + 1 < len(order) and rng.random() < 0.4:
            inner, own = written(rng, order, depth + 1, prefix + mark)
            text, paths = text + inner, paths + own
    return text, paths


@pytest.mark.parametrize("seed", range(60))
def test_nested_clauses(seed):
    rng = random.Random(seed)
    order = rng.choice([("lower", "roman", "upper"), ("lower", "roman", "number"), ("roman", "upper"), ("lower", "upper"), ("number", "lower", "roman")])
    text, want = written(rng, order, 0, "")
    got = L.clauses("As follows: " + text)
    assert [L.path(got, k) for k in range(len(got))] == want
    for k, c in enumerate(got):  # a clause holds its own and no others
        inside = [j for j in range(len(got)) if j != k and c.start < got[j].start < c.stop]
        assert inside == [j for j in range(len(got)) if L.path(got, j).startswith(L.path(got, k)) and j != k]


def test_clauses_of_nothing():
    assert L.clauses(None) == L.clauses("") == L.clauses("no markers, (see below), clauses (b) and (c)") == []


# -- amendments
def test_forms_of_effects():
    text = """(a) Section 2.09(a) of the Credit Agreement is hereby amended by replacing "0.50%" with "0.375%".

(b) The definition of the defined term “Floor” set forth in Section 1.01 of the Credit Agreement is hereby deleted in its entirety and replaced as follows:

“Floor” means 0.75%.

(c) Section 6.12 of the Credit Agreement is hereby amended and restated in its entirety to read as follows:

Section 6.12 Leverage. (a) No more than 7.00 to 1.00.

(b) Tested quarterly.

(d) Section 2.15(c) is hereby amended to (i) delete the reference therein to “September 30, 2015” and insert in lieu thereof a reference to “December 31, 2016” and (ii) delete the words “or later” and insert “or earlier”.

(e) The table set forth in Section 2.2(b) is hereby amended and restated in its entirety as follows:

Level | Rate
I | 2.25%

(f) The definitions of “Borrower”, “Agent” and “Loans” appearing in Section 1.01 are hereby amended in their respective entireties to read as follows:

“Borrower” means Beta.

“Agent” means Bank.

(g) Section 9.01 is hereby amended by deleting “by telex”.

(h) Section 9.05 of the Credit Agreement is hereby deleted in its entirety.

(i) Section 2.14 is hereby amended by adding the following new sentence: “One more.”

SECTION 3. Conditions. In accordance with Section 5.01 the Agent may insert “nothing”. Section 5.02 of the Credit Agreement stays as it is.
"""
    got = [(e.kind, e.section, e.element, e.old, None if e.new_start is None else text[e.new_start : e.new_end]) for e in O.effects_of(text)]
    assert got == [
        ("replace", "2.09(a)", None, "0.50%", "0.375%"),
        ("restate", "1.01", "definition:Floor", None, "“Floor” means 0.75%."),
        ("restate", "6.12", None, None, "Section 6.12 Leverage. (a) No more than 7.00 to 1.00.\n\n(b) Tested quarterly."),
        ("replace", "2.15(c)", None, "September 30, 2015", "December 31, 2016"),
        ("replace", "2.15(c)", None, "or later", "or earlier"),
        ("restate", "2.2(b)", "table", None, "Level | Rate\nI | 2.25%"),
        ("restate", "1.01", "definitions:Borrower|Agent|Loans", None, "“Borrower” means Beta.\n\n“Agent” means Bank."),
        ("delete", "9.01", None, "by telex", None),
        ("delete", "9.05", None, None, None),
        ("insert", "2.14", None, None, "One more."),
    ]
    marked = "The Credit Agreement is hereby amended to delete the stricken text and to add the double-underlined text as set forth in the pages attached hereto as Annex A."
    assert [(e.kind, e.section) for e in O.effects_of(marked)] == [("redline", "*")]
    assert O.effects_of(None) == O.effects_of("") == []


BASE = """CREDIT AGREEMENT

ARTICLE I
TERMS

Section 1.01 Defined Terms.

“Agent” means Alpha Bank.

“Floor” means 1.00%.

“Rate” means the rate in Section 2.01.

Section 1.02 Other Terms. None.

Section 2.01 Interest. (a) The rate is 0.50% per annum. (b) It accrues daily.

Section 2.02 Grid. See below.
Level | Rate
I | 2.00%
II | 3.00%
It is updated yearly. The end.

Section 2.03 Covenants. Pay on time.

EXHIBIT A
Form.
"""


def amendment(rng, n):
    """A change as text, and the same as a function of a plain text."""
    def within(text, head, after, f):
        a = text.index(head)
        b = text.index(after, a)
        return text[:a] + f(text[a:b]) + text[b:]

    k = rng.randrange(8)
    if k == 0:
        return f"Section 2.01(b) is hereby amended and restated in its entirety to read as follows: “(b) It accrues at {n}.”", lambda t: within(t, "(b) It", "\n\n", lambda _: f"(b) It accrues at {n}.")
    if k == 1:
        return f"The definition of “Floor” in Section 1.01 is hereby amended and restated in its entirety as follows:\n\n“Floor” means {n}.00%.", lambda t: within(t, "“Floor”", "\n\n“Rate”", lambda _: f"“Floor” means {n}.00%.")
    if k == 2:
        return f"Section 2.03 is hereby amended by adding the following: “Item {n}.”", lambda t: within(t, "2.03", "\n\nEXHIBIT", lambda s: f"{s} Item {n}.")
    if k == 3:
        return f"The table contained in Section 2.02 is hereby amended and restated in its entirety as follows:\n\nLevel | Rate\nI | {n}.00%", lambda t: within(t, "Level", "\nIt is", lambda _: f"Level | Rate\nI | {n}.00%")
    if k == 4:
        return f"The last sentence of Section 2.02 is hereby amended and restated as follows: The end of {n}.", lambda t: within(t, "yearly.", "\n\nSection 2.03", lambda _: f"yearly. The end of {n}.")
    if k == 5:
        return "Section 1.02 is hereby amended by replacing “None” with “None”.", lambda t: t
    if k == 6:
        return "Section 8.01 is hereby amended by deleting “x”.", None
    return f"Section 2.01 is hereby amended by deleting “never there {n}”.", None


@pytest.mark.parametrize("seed", range(40))
def test_fold_replays(seed):
    rng = random.Random(seed)
    plain, docs, told = BASE, [O.Doc(0, "base", "base", BASE, False)], []
    for n in range(1, rng.randrange(2, 7)):
        text = f"AMENDMENT NO. {n}\n\nRecitals.\n\n"
        for m in range(rng.randrange(1, 4)):
            said, f = amendment(rng, 10 * n + m)
            text += f"({chr(97 + m)}) {said}\n\n"
            told.append(f is None)
            plain = f(plain) if f else plain
        docs.append(O.Doc(n, f"d{n}", "amendment", text, False))
    text, changes = O.folded(docs, {d.doc_id: O.effects_of(d.text) for d in docs[1:]})
    pieces = [p for _, ps in text.order for p in ps]
    assert "".join(p.text for p in pieces) == plain
    assert [why is not None for *_, why in changes] == told
    source = {d.doc_id: d.text for d in docs}
    assert all(p.doc is None or source[p.doc][p.at : p.at + len(p.text)] == p.text for p in pieces)


def test_elements():
    assert O.element_bounds("no table", "table") is None and O.element_bounds("", "last sentence") is None and O.element_bounds("x", "proviso") is None
    body = "“A” means one. “B” shall mean two; “C” has the meaning of three."
    assert [body[slice(*O.element_bounds(body, f"definition:{t}"))] for t in ("a", "B", "C")] == ["“A” means one. ", "“B” shall mean two; ", "“C” has the meaning of three."]
    assert body[slice(*O.element_bounds(body, "first sentence"))] == "“A” means one."
    assert O.element_bounds(body, "definition:D") is None


SET = "set_id string, ord int, doc_id string, role string, text string, marked boolean"


def test_sets_of_documents(spark):
    rows = [
        ("s", 1, "b", "base", BASE, False), ("s", 2, "x", "amendment", "(a) Section 1.02 is hereby amended by replacing “None” with “Some”.", False), ("s", 3, "z", "amendment", None, None),
        ("no base", 1, "y", "amendment", "Section 1.02 is hereby amended by deleting “None”.", False),
        ("marked", 1, "b", "base", BASE, False), ("marked", 2, "m", "amendment", "The Credit Agreement is hereby amended to delete the stricken text.\n\nSection 1.01 New. All new.\n", True),
        ("unmarked", 1, "b", "base", "Section 1.01 Old. All old.", None), ("unmarked", 2, "m", "amendment", "The Credit Agreement is hereby amended to delete the stricken text.", False),
    ]
    folded = O.fold(spark.createDataFrame(rows, SET)).cache()
    parts = O.pieces(folded)
    texts = {r.set_id: r.text for r in O.texts(parts).collect()}
    assert texts == {"s": BASE.replace("None", "Some"), "marked": rows[5][4], "unmarked": rows[6][4]}
    why = {(r.set_id, r.doc_id): r.reason for r in O.changes(folded).collect()}
    assert why == {("s", "x"): None, ("no base", "y"): "the set has no base", ("marked", "m"): None, ("unmarked", "m"): "no marks of what is struck came with the text"}
    at = BASE.index("None")
    spans = spark.createDataFrame([("s", at - 3, at + 6, "k")], "set_id string, start long, end long, key string")
    got = sorted((r.part_start, r.part_end, r.doc_id, r.doc_start, r.doc_end) for r in O.attributed(spans, parts).collect())
    new = rows[1][4].index("Some")
    assert got == [(at - 3, at, "b", at - 3, at), (at, at + 4, "x", new, new + 4), (at + 4, at + 6, "b", at + 4, at + 6)]
    none = spark.createDataFrame([], SET)
    assert O.pieces(O.fold(none)).count() == 0 and O.effects(none).count() == 0


def test_attribution_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(O, "BUCKET", 8)
    parts = spark.createDataFrame([("s", k, 5 * k, 5 * k + 5, "1.01", f"d{k % 3}", 100 * k, "x" * 5) for k in range(20)], "set_id string, seq int, start long, end long, section string, doc_id string, doc_start long, text string")
    spans = spark.createDataFrame([("s", a, b) for a, b in [(0, 100), (3, 4), (7, 41), (99, 100)]], "set_id string, start long, end long")
    got = sorted((r.start, r.part_start, r.part_end, r.doc_start) for r in O.attributed(spans, parts).collect())
    want = sorted((a, max(a, 5 * k), min(b, 5 * k + 5), 100 * k + max(0, a - 5 * k)) for a, b in [(0, 100), (3, 4), (7, 41), (99, 100)] for k in range(20) if a < 5 * k + 5 and b > 5 * k)
    assert got == want


def test_awkward_outlines(spark):
    rows = [(1, None), (2, ""), (3, "Section 1.01 A\n(a) x (b) y\n" * 2), (3, "Section 1.01 A\n(a) x (b) y\n" * 2), (None, "ARTICLE I\nALL\n")]
    d = spark.createDataFrame(rows, "id long, text string").withColumn("title", F.lit("clash"))
    assert L.headings(d, ["id"]).groupBy("id").count().orderBy("id").collect() == [(None, 1), (3, 2)]
    assert L.nested(d, ["id"]).where("id = 3").count() in (4, 8)
    long = "Section 1.01 A. " + "word " * 400_000
    assert len(L.sections(long)) == 1
