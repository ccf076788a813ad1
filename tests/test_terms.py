"""Margins and dates of definitions, over forms that agreements use."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest

from spanforge.operators import terms as T


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ("means, for Eurodollar Loans, (a) 3.00% and, for ABR Loans, (b) 2.00%", [("eurodollar", "3.00"), ("base_rate", "2.00")]),
        ("means, per annum, (a) for Term SOFR Loans, 3.25% and (b) for Base Rate Loans, 2.25%", [("sofr", "3.25"), ("base_rate", "2.25")]),
        ("means (a) with respect to SOFR Loans, (i) during the first year, 2.00% and (ii) thereafter, 2.50% and (b) with respect to ABR Loans, (i) during the first year, 1.00% and (ii) thereafter, 1.50%.", [("sofr", "2.00"), ("sofr", "2.50"), ("base_rate", "1.00"), ("base_rate", "1.50")]),
        ("means 3.00% per annum in the case of Term Rate Loans and 2.00% per annum in the case of Base Rate Loans.", [("other", "3.00"), ("base_rate", "2.00")]),
        ("means 1.90% per annum.", [(None, "1.90")]),
        ("means (i) during the Revolving Period, 2.60% per annum and (ii) after the end of the Revolving Period, 2.80% per annum; provided that, after the occurrence and during the continuation of an Event of Default, the Applicable Margin determined pursuant to the foregoing clause (i) or clause (ii), as applicable, shall be increased by 2.00% per annum.", [(None, "2.60"), (None, "2.80")]),
        ("means, (i) prior to the Eighteenth Amendment Effective Date, 2.00% per annum and (ii) thereafter, 1.80% per annum; provided that, at any time during the existence of an Event of Default the Applicable Spread shall be increased by 2.00% per annum.", [(None, "1.80")]),
        ("means, with respect to each Advance, (i) from the Advance Date through the day on which not less than twenty percent (20%) of the rentable units are leased, 3.00%, and (ii) from the day following the Stabilization Date, 2.50%.", [(None, "3.00"), (None, "2.50")]),
        ("means, for the Initial Loans, (i) with respect to SOFR Loans, 6.50% per annum, and (ii) with respect to ABR Loans, 5.50% per annum.", [("sofr", "6.50"), ("base_rate", "5.50")]),
        ("means (a) SOFR plus 2.00% and (b) if an Event of Default is continuing, 4.00%", [("sofr", "2.00")]),
        ("has no figure", []),
        (None, []),
        ("", []),
    ],
)
def test_margins(body, want):
    got, why = T.margin_schedule(body)
    assert [(m.kind, str(m.rate)) for m in got] == want and why is None
    assert all(body[m.start :].startswith(str(m.rate)) for m in got)


@pytest.mark.parametrize(
    ("body", "why"),
    [
        ("has the meaning specified in the Fee Letter.", "in another document: Fee Letter"),
        ("means 3.00% per annum in the case of Term Rate Loans and 2.00% in the case of Base Rate Loans; provided that, at any time that the LTV is greater than the Cash Sweep LTV, the Margin shall be increased by 0.50% per annum.", "it would have to be added to"),
        ("means (a) with respect to Term Loans, 3.25% per annum and (b) with respect to Revolving Loans, 2.75% per annum.", "it prices several facilities"),
        ("means (a) any Initial Loan, 4.00% and (b) any Revolving Loan, the rate in the table set forth below", "in a table"),
    ],
)
def test_declined_margins(body, why):
    assert T.margin_schedule(body) == ([], why)


def test_top_margin():
    assert T.top_margin("means (a) for SOFR Loans, 1.83% and (b) for Base Rate Loans, 2.83%") == Decimal("1.83")
    assert T.top_margin("has no figure") is None


@pytest.mark.parametrize("seed", range(40))
def test_margin_schedules_of_any_shape(seed):
    """Schedules written from a tree: kinds at either level, said before, within or after."""
    rng = random.Random(seed)
    names = {"sofr": "Term SOFR Loans", "base_rate": "ABR Loans", "eurodollar": "Eurodollar Loans"}
    kinds = rng.sample(sorted(names), 2)
    want, text, shape = [], "means, per annum, ", rng.randrange(4)
    rate = lambda k: want.append((k, f"{rng.randrange(1, 9)}.{rng.randrange(10)}0")) or want[-1][1]
    for n, k in enumerate(kinds):
        mark, glue = f"({'ab'[n]})", ["", " and "][n]
        if shape == 0:
            text += f"{glue}{mark} for {names[k]}, {rate(k)}%"
        elif shape == 1:
            text += f"{glue}{mark} with respect to {names[k]}, (i) in the first year, {rate(k)}% and (ii) thereafter, {rate(k)}%"
        elif shape == 2:
            text += f"{glue}{mark} {rate(k)}% in the case of {names[k]}"
        else:
            text += f"{', and,' if n else ''} for {names[k]}, {mark} {rate(k)}%"
    got, why = T.margin_schedule(text + rng.choice([".", "; provided that upon an Event of Default 9.90% shall apply."]))
    assert why is None and [(m.kind, str(m.rate)) for m in got] == want


# -- dates
def day(y, m, d):
    return dt.date(y, m, d)


def read(body, agreed=None, **terms):
    found, steps = T.Dates({"Maturity Date": body} | {k.replace("_", " "): v for k, v in terms.items()}, agreed).of("Maturity Date")
    return (None if found is None else (found.date, found.open, found.counted)), [s for _, s in steps]


CLOSING = "means March 15, 2024."


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ("means June 30, 2027.", (day(2027, 6, 30), False, False)),
        (": November 6, 2028.", (day(2028, 11, 6), False, False)),
        ("means the date that is five (5) years after the Closing Date", (day(2029, 3, 15), False, True)),
        ("means the date that is 91 days prior to June 1, 2030", (day(2030, 3, 2), False, True)),
        ("means the fifth (5th) anniversary of the Closing Date", (day(2029, 3, 15), False, True)),
        ("means the 3rd anniversary of the Closing Date.", (day(2027, 3, 15), False, True)),
        ("means the five-year anniversary of the Closing Date.", (day(2029, 3, 15), False, True)),
        ("means the date that is the 36 month anniversary of the Closing Date", (day(2027, 3, 15), False, True)),
        ("means the date which is eighteen months following the Closing Date", (day(2025, 9, 15), False, True)),
        ("means the earliest of March 1, 2027 and the date of termination", (day(2027, 3, 1), True, False)),
        ("means the earlier to occur of (a) September 10, 2031 and (b) the date on which all Commitments end.", (day(2031, 9, 10), True, False)),
        ("means the earliest of (a) the second anniversary of the Closing Date, (b) January 2, 2026 and (c) the Closing Date", (day(2024, 3, 15), False, True)),
        ("means the later of (a) June 1, 2026 and (b) the second anniversary of the Closing Date", (day(2026, 6, 1), False, True)),
        ("means the later of (a) June 1, 2026 and (b) the date of a sale", None),
        ("means the first Business Day on or after August 17, 2030", (day(2030, 8, 19), False, True)),
        ("means the first Business Day after August 16, 2030", (day(2030, 8, 19), False, True)),
        ("means August 17, 2030; provided that if such date is not a Business Day, the Maturity Date shall be the immediately preceding Business Day.", (day(2030, 8, 16), False, True)),
        ("means the last day of the calendar month in which the second anniversary of the Closing Date occurs", (day(2026, 3, 31), False, True)),
        ("means 10 business days after August 16, 2030", (day(2030, 8, 30), False, True)),
        ("means two weeks before 1 June 2026", (day(2026, 5, 18), False, True)),
        ("means the date of this Agreement.", (day(2024, 1, 2), False, False)),
        ("means the Other Date.", (day(2030, 1, 31), False, False)),
        ("means one month after the Other Date", (day(2030, 2, 28), False, True)),
        ("means the date of a sale", None),
        ("means the Maturity Date", None),
        ("means February 30, 2027", None),
        ("", None),
    ],
)
def test_dates(body, want):
    assert read(body, day(2024, 1, 2), Closing_Date=CLOSING, Other_Date="means January 31, 2030.")[0] == want


def test_premises():
    got, said = read(
        "means the earlier to occur of (i) the first Business Day on or after the date that is the 36 month anniversary of the End Date and (ii) the date on which it is declared.",
        Closing_Date="means August 17, 2024.", End_Date="means the last day of the Reinvestment Period.",
        Reinvestment_Period="means the period from and including the Closing Date to and including the earlier of (a) the date that is the 3rd anniversary of the Closing Date and (b) the date of the termination of the Commitments.",
    )
    assert got == (day(2030, 8, 19), True, True)
    assert said == [
        "The text defines the Closing Date as August 17, 2024.",
        "The text defines the Reinvestment Period as a period that ends on the earliest of the third anniversary of the Closing Date and the other dates and events it lists.",
        "The text defines the End Date as the last day of the Reinvestment Period.",
        "The text defines the Maturity Date as the earliest of the first Business Day on or after the 36-month anniversary of the End Date and the other dates and events it lists.",
    ]
    two, said = read("The earliest of (a) the date that is two (2) years after the Period End, (b) the date of the declaration of the Maturity Date", Period_End=": The earlier to occur of (a) the Scheduled End and (b) the date of a declaration.", Scheduled_End=": November 6, 2028.")
    assert two == (day(2030, 11, 6), True, True) and len(said) == 3


def test_circles_and_chains():
    assert read("means the B", B="means the C", C="means the Maturity Date")[0] is None
    assert read("means the earlier of (a) the B and (b) July 1, 2030", B="means the Maturity Date")[0] == (day(2030, 7, 1), True, False)
    long = {f"T{k}": f"means the T{k + 1}" for k in range(20)}
    assert read("means the T15", **long, T20="means July 1, 2030")[0] == (day(2030, 7, 1), False, False)
    assert read("means the T0", **long, T20="means July 1, 2030")[0] is None  # deeper than DEPTH


def test_tables(spark):
    rows = [(1, 2, "Maturity Date", "means the first anniversary of the Closing Date"), (1, 1, "Closing Date", "means the date hereof"), (1, 3, "Closing Date", "means May 1, 2020"), (2, 1, "Closing Date", None), (2, 2, None, "means May 1, 2020")]
    d = spark.createDataFrame(rows, "doc_id long, at int, term string, body string")
    agreed = spark.createDataFrame([(1, dt.date(2024, 2, 29))], "doc_id long, agreed date")
    got = {(r.doc_id, r.term): (r.date, r.counted, r.route) for r in T.dates(d, agreed).collect()}
    assert got == {(1, "Closing Date"): (day(2024, 2, 29), False, ["Closing Date"]), (1, "Maturity Date"): (day(2025, 2, 28), True, ["Closing Date", "Maturity Date"])}
    m = spark.createDataFrame([(1, "means 1.5% for SOFR Loans"), (2, "as set forth in the Fee Letter"), (3, None)], "kind long, body string")
    assert [(r[0], r[1], r.reason) for r in T.margins(m.withColumnRenamed("kind", "k"), ["k"]).orderBy("k").collect()] == [(1, "sofr", None), (2, None, "in another document: Fee Letter")]
    assert T.margins(m.limit(0).withColumnRenamed("kind", "k"), ["k"]).count() == T.dates(d.limit(0), agreed).count() == 0
