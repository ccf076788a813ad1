"""Margins and dates over definitions of many forms, one drawn for each order by its numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanforge.operators import terms as T
from spanforge.plans.base import query, read, spread
from spanforge.plans.economics_queries import said, text

# -- margins: nine forms; r is a rate in quarters, one less for base rate loans
MARGIN_CASES = """o AS (SELECT o_orderkey, (o_custkey + o_orderkey // 3) % 9 AS f, 2 + CAST(o_custkey % 17 AS DECIMAL(12,4)) / 4 AS r FROM orders),
m AS (SELECT o_orderkey, r, g.kind, g.less, g.reason FROM o JOIN (VALUES (0, 'eurodollar', 0, NULL), (0, 'base_rate', 1, NULL), (1, 'sofr', 0, NULL), (1, 'sofr', -0.5, NULL), (1, 'base_rate', 1, NULL), (1, 'base_rate', 0.5, NULL), (2, 'other', 0, NULL), (2, 'base_rate', 1, NULL),
  (3, NULL, 0, NULL), (3, NULL, 0.25, NULL), (4, NULL, 0, NULL), (5, NULL, NULL, 'in another document: Fee Letter'), (6, NULL, NULL, 'it would have to be added to'), (7, NULL, NULL, 'it prices several facilities'), (8, NULL, NULL, 'in a table')) g(f, kind, less, reason) ON o.f = g.f)"""


@query(f"WITH {MARGIN_CASES} SELECT o_orderkey, kind, CAST(r - less AS DECIMAL(12,4)) AS rate, reason FROM m")
def margin_schedules(spark, sf_dir):
    """Rates by kind of loan, and why a schedule is declined."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", ((F.col("o_custkey") + F.floor(F.col("o_orderkey") / 3)) % 9).alias("f"), (F.lit(2) + (F.col("o_custkey") % 17).cast("decimal(12,4)") / 4).cast("decimal(12,4)").alias("r"))
    p = lambda less: F.concat((F.col("r") - F.lit(less).cast("decimal(6,4)")).cast("decimal(12,4)").cast("string"), F.lit("%"))
    forms = [
        text("means, for Eurodollar Loans, (a) ", p("0"), " and, for ABR Loans, (b) ", p("1"), "."),
        text("means (a) with respect to SOFR Loans, (i) in the first year, ", p("0"), " and (ii) thereafter, ", p("-0.5"), " and (b) with respect to Base Rate Loans, (i) in the first year, ", p("1"), " and (ii) thereafter, ", p("0.5"), "."),
        text("means ", p("0"), " per annum in the case of Term Rate Loans and ", p("1"), " per annum in the case of Base Rate Loans."),
        text("means (i) during the Revolving Period, ", p("0"), " and (ii) after it, ", p("0.25"), "; provided that, during an Event of Default, the margin under clause (i) or (ii) shall be increased by 2.00%."),
        text("means, (i) prior to the First Amendment Effective Date, 9.00% and (ii) thereafter, ", p("0"), " where not less than fifty percent (50%) of the units are let."),
        F.lit("has the meaning specified in the Fee Letter."),
        text("means ", p("0"), " for Term Rate Loans and ", p("1"), " for Base Rate Loans; provided that, while the LTV is high, the Margin shall be increased by 0.50%."),
        text("means (a) with respect to Term Loans, ", p("0"), " and (b) with respect to Revolving Loans, ", p("1"), "."),
        F.lit("means (a) for Initial Loans, 4.00% and (b) for other Loans, the rate in the table set forth below."),
    ]
    return T.margins(o.select("o_orderkey", said(forms, F.col("f")).alias("body")), ["o_orderkey"]).select("o_orderkey", "kind", "rate", "reason")


# -- dates: twelve forms over a closing date, a period and another date
SATURDAY = "(c + CAST((13 - isodow(c)) % 7 AS INT))"
DATE_CASES = f"""o AS (SELECT o_orderkey AS doc_id, CAST(o_orderdate AS DATE) AS c, 1 + o_custkey % 6 AS n, (o_custkey + o_orderkey // 5) % 12 AS f FROM orders),
d AS (SELECT doc_id, CAST(CASE f WHEN 0 THEN c + to_years(n) WHEN 1 THEN c - to_days(91) WHEN 2 THEN c + to_years(n) WHEN 3 THEN c + to_months(n) WHEN 4 THEN least(c + to_years(n), DATE '1996-06-30') WHEN 5 THEN c + to_years(1) WHEN 6 THEN greatest(c + to_years(n), DATE '1996-06-30') WHEN 7 THEN NULL
  WHEN 8 THEN {SATURDAY} + 2 WHEN 9 THEN {SATURDAY} - 1 WHEN 10 THEN last_day(CAST(c + to_months(n) AS DATE)) ELSE CAST(c + to_years(n) AS DATE) - 1 END AS DATE) AS date,
  f IN (4, 5) AS open, f FROM o)"""


@query(f"WITH {DATE_CASES} SELECT doc_id, date, open, CAST(CASE WHEN f IN (11) THEN 3 ELSE 2 END AS INT) AS steps FROM d WHERE date IS NOT NULL")
def symbolic_dates(spark, sf_dir):
    """Maturities as spans, anniversaries, the earliest and latest of dates and events, business days and ends of periods."""
    day = F.to_date("o_orderdate")
    saturday = F.date_add(day, (F.lit(13) - (F.weekday(day) + 1)) % 7)
    o = spread(read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate"), "o_orderkey").select(F.col("o_orderkey").alias("doc_id"), day.alias("c"), saturday.alias("sat"), (1 + F.col("o_custkey") % 6).cast("int").alias("n"), ((F.col("o_custkey") + F.floor(F.col("o_orderkey") / 5)) % 12).alias("f"))
    word = F.element_at(F.array(*map(F.lit, ["one", "two", "three", "four", "five", "six"])), F.col("n"))
    nth = F.element_at(F.array(*map(F.lit, ["first", "second", "third", "fourth", "fifth", "sixth"])), F.col("n"))
    n = F.col("n").cast("string")
    other = F.date_format("sat", "MMMM d, yyyy")
    forms = [
        text("means the date that is ", word, " (", n, ") years after the Closing Date"), text("means the date that is 91 days prior to the Closing Date"), text("means the ", nth, " (", n, "th) anniversary of the Closing Date"), text("means the date which is ", n, " months following the Closing Date"),
        text("means the earliest of (a) the ", nth, " anniversary of the Closing Date, (b) June 30, 1996 and (c) the date on which all Commitments end"), text("means the earlier to occur of (i) the one-year anniversary of the Closing Date and (ii) a Change of Control"),
        text("means the later of (a) the ", nth, " anniversary of the Closing Date and (b) June 30, 1996"), text("means the later of (a) the ", nth, " anniversary of the Closing Date and (b) the date of a sale"), F.lit("means the first Business Day on or after the Other Date"),
        F.lit("means the Other Date; provided that if it is not a Business Day, the Maturity Date shall be the immediately preceding Business Day"), text("means the last day of the calendar month in which the date that is ", n, " months after the Closing Date occurs"), F.lit("means the last day of the Availability Period"),
    ]
    bodies = {"Closing Date": F.lit("means the date of this Agreement."), "Other Date": text("means ", other, "."), "Availability Period": text("means the period from the Closing Date to but excluding the ", nth, " anniversary of the Closing Date"), "Maturity Date": said(forms, F.col("f"))}
    terms = F.explode(F.array(*(F.struct(F.lit(t).alias("term"), b.alias("body")) for t, b in bodies.items())))
    d = o.select("doc_id", terms.alias("x")).select("doc_id", "x.term", "x.body", F.col("x.term").alias("at"))
    read_ = T.dates(d, o.select("doc_id", F.col("c").alias("agreed")))
    return read_.where("term = 'Maturity Date'").select("doc_id", "date", "open", F.size("route").alias("steps"))
