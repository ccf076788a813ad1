"""Assertions, gold values, splits and segments at their edges."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from spanforge.operators import assertions as A
from spanforge.operators import evaluate as E
from spanforge.operators import segments as G


@pytest.mark.parametrize(
    ("expected", "observed", "same"),
    [("0.75%", "0.75", True), ("3.50 to 1.00", "3.5", True), ("4:2", "4", False), ("$1,000", "1000.004", True), ("1000", "1000.01", False), ("2024-01-31", "2024-01-31T00:00", True), ("2024-01-31", "2024-02-01", False), ("Acme  Corp", "acme corp ", True), (None, None, True), (None, "1", False), ("1", None, False), ("", "", True)],
)
def test_values_equal(spark, expected, observed, same):
    row = spark.createDataFrame([(expected, observed)], "a string, b string")
    assert row.select(A.values_equal(F.col("a"), F.col("b")).alias("x")).first().x is same


def asked(spark, *rows):
    return spark.createDataFrame([(1, str(i), "f", *r) for i, r in enumerate(rows)], "doc_id long, assertion string, family string, kind string, target string, tranche string, expect array<string>, at_most boolean")


def test_evaluate_without_facts(spark):
    """Nothing is known: fields fail, a null value is right where null is expected, what wasn't reported is right if so expected."""
    facts = A.field_facts(spark.createDataFrame([], "doc_id long, field string, value string, status string, external_kind string, unit string"))
    labels = asked(spark, ("field_value", "x", None, [None], False), ("tranche_value", "x", "A", ["1"], False), ("resolve", "x", None, [None], False), ("chain_finding", "x", None, ["false"], False), ("trap_caught", "x", None, ["false"], False), ("report_count", "x", None, ["3"], True), ("archetype", None, None, None, None))
    got = {r.assertion: (r.passed, r.confident) for r in A.evaluate(labels, facts).collect()}
    assert got == {"0": (False, False), "1": (False, False), "2": (True, False), "3": (True, True), "4": (False, True), "5": (False, False), "6": (True, False)}


def test_evaluate_any_of_and_nulls(spark):
    fields = spark.createDataFrame([(1, "x", "Beta LLC", "confirmed", None, None), (2, "x", "Beta LLC", None, None, None), (None, "x", "Beta LLC", "confirmed", None, None)], "doc_id long, field string, value string, status string, external_kind string, unit string")
    labels = asked(spark, ("field_value", "x", None, ["Alpha LLC", "beta llc"], False), ("field_value", "x", None, ["Alpha LLC"], False), ("field_external_kind", "x", None, [None], False))
    assert [(r.passed, r.confident) for r in A.evaluate(labels, A.field_facts(fields)).orderBy("assertion").collect()] == [(True, True), (False, True), (True, True)]


def test_closures(spark):
    labels = asked(spark, ("closure_contains", "EBITDA", None, ["net income", "Taxes"], False), ("closure_contains", "EBITDA", None, ["Rent"], False), ("closure_contains", "Debt", None, [], False), ("closure_contains", "EBITDA", None, None, False))
    closure = spark.createDataFrame([(1, "EBITDA", "Net Income"), (1, "EBITDA", "taxes"), (2, "Debt", "Liens")], "doc_id long, term string, reached string")
    assert [(r.passed, r.confident) for r in A.evaluate_closures(labels, closure).orderBy("assertion").collect()] == [(True, True), (False, True), (False, False), (True, True)]


def test_no_rows(spark):
    none = asked(spark).limit(0)
    facts = A.named_facts(spark.createDataFrame([], "doc_id long, name string, n long"), "report_count", F.col("n"))
    assert A.evaluate(none, facts).count() == 0
    assert E.fit_classes(spark.createDataFrame([], "c string, kind string, p double, correct boolean"), ["c"], 0.9).count() == 0
    assert G.page_marks(spark.createDataFrame([], "d long, text string"), ["d"]).count() == 0


def test_class_that_lacks_a_set_is_not_fitted_as_agreed(spark):
    rows = [("a", "labelled", 0.9, True)] * 40 + [("b", "in_text", 0.9, False)] * 3
    got = {r.c: (r.agreed, r.adopted) for r in E.fit_classes(spark.createDataFrame(rows, "c string, kind string, p double, correct boolean"), ["c"], 0.9).collect()}
    assert got["a"][0] and float(got["a"][1]) == 0.9
    assert got["b"] == (False, None)


def test_holdout_leaves_out_contaminated(spark):
    names = spark.createDataFrame([("A", f"A_{i}", i < 4) for i in range(7)] + [("B", "B_0", False)] + [("C", f"C_{i}", True) for i in range(5)] + [("D", f"D_{i}", None) for i in range(2)], "s string, n string, bad boolean")
    out = E.holdout(names, "s", "n", contaminated=F.col("bad")).where("side = 'holdout'").collect()
    assert sorted(r.s for r in out) == ["A", "D"]
    assert not any(r.bad for r in out)


def test_page_marks(spark):
    docs = [(1, "a\n 1 \nb\n2\nc\n\t3\nd"), (2, "a\n1\nb\n2\nc"), (3, "a\n5\nb\n9\nc\n10\nd\n11\ne\n2001\nf"), (4, None), (5, "")]
    got = G.page_marks(spark.createDataFrame(docs, "d long, text string"), ["d"]).orderBy("d", "start").collect()
    assert [(r.d, r.start, r.page) for r in got] == [(1, 0, 1), (1, 1, 1), (1, 7, 2), (1, 11, 3), (3, 0, 1), (3, 1, 5), (3, 9, 10), (3, 14, 11)]


def test_cuts():
    assert G.cuts("", 10) == []
    assert G.cuts("abc", 10) == [(0, 3)]
    assert G.cuts("abcdef\n\nghijkl", 10) == [(0, 6), (6, 14)]
    assert G.cuts("a\n\nbcdefghijkl", 10) == [(0, 10), (10, 14)]  # the gap lies in the first half
    long = "word " * 200_000
    parts = G.cuts(long, 6_000)
    assert "".join(long[a:b] for a, b in parts) == long


@pytest.mark.parametrize(("title", "after", "is_reserved"), [("[Reserved]", "", True), ("", "\n\n[Intentionally Omitted]", True), (None, "Reserved", True), ("Liens", "[Reserved]", False), ("", None, False), (None, None, False), ("", "\n" + "x" * 60 + "[Reserved]", False)])
def test_reserved(spark, title, after, is_reserved):
    assert spark.createDataFrame([(title, after)], "t string, a string").select(G.reserved(F.col("t"), F.col("a")).alias("x")).first().x is is_reserved


@pytest.mark.parametrize(
    ("text", "want"),
    [("a 52-53 week fiscal year that ends on the Saturday closest to January 31", (1, 31, 5, "weekday_nearest_month_end")), ("fiscal year ending June 31", (6, 30, None, None)), ("Fiscal Year of Borrower ends on the February 30", (2, 29, None, None)), ("the Sunday last day of May", (12, 31, None, None)), (None, (12, 31, None, None)), ("", (12, 31, None, None))],
)
def test_fiscal_calendar(spark, text, want):
    c = spark.createDataFrame([(text,)], "t string").select(G.fiscal_calendar(F.col("t")).alias("x")).first().x
    assert (c.month, c.day, c.weekday, c.convention) == want
