"""Rules over forms of governing law and parties, and fiscal quarters of every kind of year."""

from __future__ import annotations

import calendar
import datetime as dt

import pytest
from pyspark.sql import functions as F

from spanforge.operators import extract as X
from spanforge.operators import readings as R

LAW = [
    ("shall be governed by, and construed in accordance with, the laws of the State of New York.", ["new york"]),
    ("governed by, and shall be construed in accordance with, the laws of the State of New York", ["new york"]),
    ("construed in accordance with the internal laws of the State of Delaware without regard to conflicts", ["delaware"]),
    ("governed by the laws of the Commonwealth of Massachusetts", ["massachusetts"]),
    ("governed by and construed under the law of the State of North Carolina and", ["north carolina"]),
    ("obligations connected with it are governed by English law.", ["english"]),
    ("any Security Agreement governed by Dutch law", []),
    ("matters governed by Applicable law", []),
    ("is governed by federal law", []),
    (None, []),
]
PARTIES = [
    ("SCHNEIDER NATIONAL CARRIERS, INC., as Borrower, and others", "borrower.legal_name", ["schneider national carriers, inc."]),
    ("Acme Holdings LLC, in its capacity as Borrower", "borrower.legal_name", ["acme holdings llc"]),
    ("Alpha, Inc., a Delaware corporation, as the Borrower", "borrower.legal_name", ["alpha, inc."]),
    ("Alpha, Inc., Beta, LLC and Gamma Corporation, as Borrowers", "borrower.legal_name", []),
    ("BANK OF THE WEST LIMITED, as Administrative Agent", "administrative_agent.legal_name", ["bank of the west limited"]),
    ("First Bank, in its capacity as Administrative Agent", "administrative_agent.legal_name", ["first bank"]),
]


def test_governing_law(spark):
    d = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(LAW)], "doc_id long, text string")
    got = X.rule_readings(d).where("field = 'facility.governing_law'").collect()
    assert sorted((r.doc_id, r.key) for r in got) == [(k, x) for k, (_, want) in enumerate(LAW) for x in want]


def test_parties(spark):
    d = spark.createDataFrame([(k, t) for k, (t, *_) in enumerate(PARTIES)], "doc_id long, text string")
    got = {(r.doc_id, r.field, r.key) for r in X.rule_readings(d).collect()}
    assert got >= {(k, f, x) for k, (_, f, want) in enumerate(PARTIES) for x in want}
    assert not [r for r in got if r[0] == 3 and r[1] == "borrower.legal_name"]
    spans = X.rule_readings(d).where("doc_id = 1").first()
    assert PARTIES[1][0][spans.start : spans.end].startswith("Acme Holdings LLC")


def plain_quarters(year, month, day, weekday, nearest):
    def end(y):
        last = dt.date(y, month, calendar.monthrange(y, month)[1])
        if weekday is None:
            return last.replace(day=min(day, last.day))
        before = next(last - dt.timedelta(days=k) for k in range(7) if (last - dt.timedelta(days=k)).weekday() == weekday)
        after = next(last + dt.timedelta(days=k) for k in range(7) if (last + dt.timedelta(days=k)).weekday() == weekday)
        return after if nearest and after - last < last - before else before

    if weekday is not None:
        return [end(year - 1) + dt.timedelta(weeks=13 * q) for q in (1, 2, 3)] + [end(year)]
    out = []
    for back in (9, 6, 3, 0):
        y, m = divmod(year * 12 + month - 1 - back, 12)
        out.append(dt.date(y, m + 1, min(day, calendar.monthrange(y, m + 1)[1])))
    return out


@pytest.mark.parametrize("month", [1, 2, 6, 9, 12])
def test_fiscal_quarters(spark, month):
    rows = [(y, month, d, w, n) for y in (2019, 2020, 2023) for d in (15, 29, 31) for w in (None, 0, 5, 6) for n in (True, False)]
    d = spark.createDataFrame(rows, "y int, m int, d int, w int, n boolean")
    got = d.select("*", R.fiscal_quarter_ends(F.col("y"), F.col("m"), F.col("d"), F.col("w"), F.col("n")).alias("q")).collect()
    assert [r.q for r in got] == [plain_quarters(*r[:5]) for r in got]
