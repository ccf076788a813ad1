"""Steps of round 4 that must not grow faster than the tables: quick readers against the plain ones."""

from __future__ import annotations

import random

from spanforge.sources import files


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def markup(rng: random.Random, n: int) -> str:
    tags = ["table", "tr", "td", "tr", "td", "td", "th", "p", "div", "b", "br", "hr", "span", "li", "pre", "TD", "a"]
    texts = ["a", " a", "a ", " ", "\n", "x y", "$5", "March 31, 2020", "&nbsp;", "&amp;", "a > b", "", " ", "é ü"]
    spans = ["", "", "", " colspan=2", ' rowspan="2"', " colspan=0", ' rowspan=3 colspan="2"']
    out = []
    for _ in range(n):
        t = rng.choice(tags)
        out.append(f"</{t}>" if rng.random() < 0.4 else f"<{t}{rng.choice(spans) if t in ('td', 'th', 'TD') else ''}>")
        out.append(rng.choice(texts))
    return "".join(out)


def test_simple_markup_is_read_as_by_the_reader():
    rng, quick = random.Random(4), 0
    cases = [markup(rng, rng.randrange(1, 60)) for _ in range(3_000)] + ["", "a", "<p>", "a <br> <p>b", "<table><tr><td>a <p>b</td><td></td></tr>", "<td><br><br><p>x", "<td>a | <td>b", "<td> <p> x"]
    for m in cases:
        got = files.simple_document(m)
        if got is not None:
            quick += 1
            r = files.parse_html(m)
            want = {"text": "".join(r.out).rstrip(), "pages": r.pages, "cells": r.cells, "redlines": r.redlines, "links": r.links}
            assert got == want, m
    assert quick > 0.8 * len(cases)
    for m in ("<s>a</s>", "<p style='x'>a", "<a href=x>b</a>", "<script>a<b</script>", "a < b", "<!-- c -->", "<title>t</title>", "<br/>"):
        assert files.simple_document(m) is None


def grid_page(rng: random.Random) -> str:
    heads = ["Payment Date", "Date", "Principal", "Amount", "Installment Date", "No.", "Lender", "Commitment", "Commitment Percentage", "Maturity Date", ""]
    body = ["March 31, 2020", "February 30, 2020", "1/2/21", "13/1/2020", "2020-02-29", "$5", "$", "1,000", "(4)%", "Total", "Bank", "x 7 y", "12:1", ""]
    out = []
    for _ in range(rng.randrange(1, 5)):
        wide, lead = rng.randrange(1, 4), rng.randrange(3)
        row = lambda words: "<tr>" + "".join(f"<{(t := rng.choice(['td'] * 9 + ['th']))}{rng.choice([''] * 8 + [' colspan=2', ' rowspan=2'])}>{rng.choice(words)}</{t}>" for _ in range(wide)) + "</tr>"  # noqa: B023, E731
        out.append("<table>" + "".join(row(heads) for _ in range(lead)) + "".join(row(body) for _ in range(rng.randrange(5))) + "</table>" + rng.choice(["", "<hr>", "<p>" + "far " * 120 + "</p>"]))
    return "".join(out)


def test_rows_of_a_page_are_those_of_its_cells(spark):
    from pyspark.sql import functions as F

    from spanforge.operators import grids as G

    rng = random.Random(9)
    pages = [(k, grid_page(rng)) for k in range(600)] + [(600, None), (601, "")]
    d = spark.createDataFrame(pages, "doc_id long, html string")
    cells = files.parsed(d, "doc_id", "html", parts=("cells",)).select("doc_id", F.explode("cells").alias("c")).select("doc_id", "c.*")
    for roles in (G.AMORTIZATION, G.COMMITMENTS):
        quick, whole = G.page_rows(d, "doc_id", "html", roles), G.read_rows(cells, ["doc_id"], roles)
        assert plan(quick).count("Exchange") == 0
        got, want = (sorted((tuple(r[c] for c in quick.columns) for r in df.collect()), key=str) for df in (quick, whole))
        assert got == want and len(got) > 100


def test_printed_pages_are_not_cut_into_cells(spark):
    from spanforge.plans import grid_queries as Q

    for query in (Q.printed_schedules, Q.printed_commitments, Q.scheduled_totals):
        assert "Generate" not in plan(query(spark, "/root/testdata/sf0.001"))


def test_checks_read_schedules_where_the_pages_are(spark):
    from spanforge.operators import validate as V

    html = "<table><tr><td>Payment Date</td><td>Principal</td></tr><tr><td>March 31, 2020</td><td>$5</td></tr></table>"
    docs = files.parsed(spark.createDataFrame([("1", html), ("2", None)], "doc_id string, html string"), "doc_id", "html", parts=("text", "cells"))
    paid = V.tables_of(docs)["schedule"]
    assert "Exchange" not in plan(paid) and "MapInArrow" not in plan(paid)
    assert [(r.doc_id, r.row_index, str(r.payment_date), int(r.amount)) for r in paid.collect()] == [("1", 1, "2020-03-31", 5)]
