"""Tables by topology: places of cells against a plain grid, roles, parts over pages, totals."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spanforge.operators import grids as G
from spanforge.sources import files

KEYS = ["doc_id"]


def cells(spark, *pages):
    d = spark.createDataFrame(list(enumerate(pages)), "doc_id long, html string")
    return files.parsed(d, "doc_id", "html").select("doc_id", F.explode("cells").alias("c")).select("doc_id", "c.*")


@pytest.mark.parametrize("seed", range(30))
def test_places(seed):
    """Cells of random spans against a grid that is filled a square at a time."""
    rng = random.Random(seed)
    rows = [[(rng.choice([1, 1, 2, 3]), rng.choice([1, 1, 2, 4]), rng.random() < 0.2) for _ in range(rng.randrange(1, 5))] for _ in range(rng.randrange(1, 6))]
    html, grid, want = "<table>", {}, []
    for r, row in enumerate(rows):
        html += "<tr>"
        for n, (wide, down, blank) in enumerate(row):
            name = "" if blank else f"c{r}_{n}"
            html += f"<td colspan={wide} rowspan='{down}'>{name}</td>"
            at = next(c for c in range(100) if (r, c) not in grid)
            for rr in range(r, r + down):
                for cc in range(at, at + wide):
                    grid[rr, cc] = name
            if name:
                want.append((name, r, at, wide, down))
        html += "</tr>"
    got = [(c["text"], c["row"], c["place"], c["colspan"], c["rowspan"]) for c in files.parse_html(html + "</table>").cells]
    assert got == want


def test_nested_tables_have_grids_of_their_own():
    got = {c["text"]: (c["table_id"], c["place"]) for c in files.parse_html("<table><tr><td rowspan=2>a</td><td>b</td></tr><tr><td>c<table><tr><td>x</td><td>y</td></tr></table></td><td>d</td></tr></table>").cells}
    assert got["x"][1] == 0 and got["y"][1] == 1 and got["d"] == ("T001", 2)


LAYOUTS = {
    "plain": "<table><tr><td>Payment Date</td><td>Principal Amortization Payment</td></tr>{0}</table>",
    "numbered": "<table><tr><td>No.</td><td>Installment Date</td><td colspan=2>Amount</td></tr>{1}</table>",
    "turned": "<table><tr><th>Principal</th><th>Date</th></tr>{2}</table>",
    "two rows": "<table><tr><td rowspan=2>Nr</td><td colspan=2>Amortization of the loan</td></tr><tr><td>Date</td><td>Installment</td></tr>{3}</table>",
}
PAID = [(dt.date(2024, 3, 31), "1,500.00"), (dt.date(2024, 6, 30), "1,500.00"), (dt.date(2024, 6, 30), "1,500.00"), (dt.date(2024, 9, 30), "250")]


def rows_of(k, part):
    say = lambda d: f"{d:%B} {d.day}, {d.year}"
    forms = ["<tr><td>{d}</td><td>${m}</td></tr>", "<tr><td>{n}</td><td>{d}</td><td>$</td><td>{m}</td></tr>", "<tr><td>$ {m}</td><td>{d}</td></tr>", "<tr><td>{n}</td><td>{d}</td><td>{m}</td></tr>"]
    return "".join(forms[k].format(d=say(d), m=m, n=i + 1) for i, (d, m) in part)


@pytest.mark.parametrize("broken", [False, True])
def test_layouts(spark, broken):
    part = list(enumerate(PAID))
    pages = []
    for k, (_, layout) in enumerate(LAYOUTS.items()):
        pages.append("<p>x</p>" + layout.format(*[rows_of(k, part[:2] if broken else part)] * 4) + (f"<hr><p>7</p><table>{rows_of(k, part[2:])}</table>" if broken else ""))
    got = G.amortization(cells(spark, *pages), KEYS).orderBy("doc_id", "row").collect()
    assert [(r.doc_id, r.payment_date, r.amount) for r in got] == [(k, d, Decimal(m.replace(",", ""))) for k in range(len(pages)) for d, m in PAID]
    assert all(r.start < r.end for r in got)


def test_what_does_not_go_on(spark):
    first = LAYOUTS["plain"].format(*[rows_of(0, list(enumerate(PAID))[:1])] * 4)
    more = f"<table>{rows_of(0, list(enumerate(PAID))[1:2])}</table>"
    far, wide, headed = first + f"<p>{'far ' * 150}</p>" + more, first + f"<table>{rows_of(1, [(1, PAID[1])])}</table>", first + "<table><tr><td>Item</td><td>Fee</td></tr><tr><td>June 30, 2024</td><td>$5</td></tr></table>"
    got = G.amortization(cells(spark, far, wide, headed), KEYS).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in got} == {0: 1, 1: 1, 2: 1}


def test_other_tables(spark):
    page = "<table><tr><td>Fiscal Quarter Ended</td><td>Consolidated EBITDA</td></tr><tr><td>September 30, 2016</td><td>$11,206,749</td></tr><tr><td>Note</td><td>none</td></tr></table>"
    page += "<table><tr><td>Ref</td><td>Test Period Ending</td><td>Maximum Total Leverage Ratio</td></tr><tr><td>1</td><td>March 31, 2022 and thereafter</td><td>5.50 to 1.00</td></tr></table>"
    c = cells(spark, page)
    assert [(r.label, r.amount) for r in G.ebitda(c, KEYS).collect()] == [("September 30, 2016", Decimal("11206749"))]
    assert [(r.label, r.level) for r in G.covenants(c, KEYS).collect()] == [("March 31, 2022 and thereafter", Decimal("5.5"))]


def schedule(*rows, head="<td>Name of Lender</td><td>Commitment Percentage</td><td colspan=2>Commitment</td>"):
    return f"<table><tr>{head}</tr>" + "".join(f"<tr><td>{n}</td><td>{p}%</td><td>$</td><td>{m}</td></tr>" for n, p, m in rows) + "</table>"


def test_totals(spark):
    good = schedule(("A Bank", 60, "240,000,000.00"), ("B Bank", 40, "160,000,000.00"), ("Total", 100, "400,000,000.00"))
    bad = schedule(("A Bank", 60, "240"), ("Total", 100, "400"))
    two = good + "<p>and</p>" + schedule(("C Bank", 100, "5"), ("Total", 100, "5"))
    parts = schedule(("A", 1, "1"), ("Total A", 1, "1"), ("B", 1, "2"), ("C", 1, "3"), ("Total B", 1, "5"))
    c = cells(spark, good, bad, two, parts)
    assert {r.doc_id: r.amount for r in G.scheduled_total(c.where("doc_id < 3"), KEYS).collect()} == {0: Decimal(400_000_000)}
    assert [r.holds for r in G.commitments(c.where("doc_id = 3"), KEYS).where("is_total").orderBy("row").collect()] == [True, True]
    scales = spark.createDataFrame([(1, "T001", 1000)], "doc_id long, table_id string, scale long")
    assert [int(r.amount) for r in G.commitments(c.where("doc_id = 1"), KEYS, scales).orderBy("row").collect()] == [240_000, 400_000]


def test_no_tables(spark):
    c = cells(spark, "<p>no table</p>", "", "<table><tr><td>Payment Date</td><td>Amount</td></tr></table>")
    assert G.amortization(c, KEYS).count() == G.commitments(c, KEYS).count() == G.scheduled_total(c.limit(0), KEYS).count() == 0
