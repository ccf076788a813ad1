"""Tables found by their headers: schedules of orders printed in five layouts, with signs in cells of their own, headers over two rows and page breaks."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanforge.operators import grids as G
from spanforge.plans.base import query, read


def tags(*parts):
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def printed(spark, sf_dir):
    """A page an order; its layout is the order's number modulo 5, its total is wrong for every third."""
    li = read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    day, money = F.date_format("l_shipdate", "MMMM d, yyyy"), F.format_number(F.col("l_extendedprice").cast("decimal(14,2)"), 2)
    name = tags("Bank ", F.col("l_suppkey").cast("string"))
    k, n = F.col("l_orderkey") % 5, F.col("l_linenumber").cast("string")
    row = (
        F.when(k == 0, tags("<tr><td>", day, "</td><td>$", money, "</td></tr>")).when(k == 1, tags("<tr><td>", n, "</td><td>", day, "</td><td>$</td><td>", money, "</td></tr>"))
        .when(k == 2, tags("<tr><td>", name, "</td><td>$ ", money, "</td><td>", day, "</td></tr>")).when(k == 3, tags("<tr><td>", n, "</td><td>", day, "</td><td>", money, "</td></tr>"))
        .otherwise(tags("<tr><td>", name, "</td><td>", money, "</td><td>1.5%</td></tr>"))
    )
    rows = li.select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", row.alias("row")).alias("r"))
    own = rows.groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.sort_array(F.collect_list("r")).alias("rs"), F.sum(F.col("r.l_extendedprice").cast("decimal(14,2)")).alias("total"))
    own = own.select("doc_id", F.transform("rs", lambda r: r["row"]).alias("rs"), "total")
    k = F.col("doc_id") % 5
    body = lambda a, b: F.array_join(F.slice("rs", a, b), "")
    big = F.lit(1_000)
    head = (
        F.when(k == 0, "<tr><td>Payment Date</td><td>Principal Amortization Payment</td></tr>").when(k == 1, "<tr><td>No.</td><td>Payment Date</td><td colspan=2>Amount</td></tr>")
        .when(k == 2, "<tr><td>Lender</td><td>Principal</td><td>Payment Date</td></tr>").when(k == 3, "<tr><td rowspan=2>No.</td><td colspan=2>Schedule of payments</td></tr><tr><td>Installment Date</td><td>Installment</td></tr>")
        .otherwise("<tr><td>Name of Lender</td><td>Commitment</td><td>Commitment Percentage</td></tr>")
    )
    total = F.format_number(F.col("total") + F.when(F.col("doc_id") % 3 == 0, 100).otherwise(0), 2)
    last = F.when(k == 4, tags("<tr><td>Total</td><td>", total, "</td><td>100%</td></tr>")).otherwise("")
    broken = tags("<table>", head, body(F.lit(1), F.lit(2)), "</table><hr><p>2</p><table>", body(F.lit(3), big), "</table>")
    whole = tags("<table>", head, body(F.lit(1), big), last, "</table>")
    other = "<p>Fees</p><table><tr><td>Item</td><td>Rate</td></tr><tr><td>Fee</td><td>2%</td></tr></table><p>Schedule</p>"
    return own.select("doc_id", tags(other, F.when(k == 3, broken).otherwise(whole)).alias("html"))


@query("SELECT l_orderkey AS doc_id, CAST(l_shipdate AS DATE) AS payment_date, CAST(l_extendedprice AS DECIMAL(14,2)) AS amount FROM lineitem WHERE l_orderkey % 5 < 4")
def printed_schedules(spark, sf_dir):
    """Payments by the headers of their columns, over page breaks."""
    return G.payments(G.page_rows(printed(spark, sf_dir), "doc_id", "html", G.AMORTIZATION), ["doc_id"]).select("doc_id", "payment_date", F.col("amount").cast("decimal(14,2)").alias("amount"))


@query("""SELECT l_orderkey AS doc_id, concat('Bank ', l_suppkey) AS name, CAST(l_extendedprice AS DECIMAL(30,2)) AS amount, FALSE AS is_total, CAST(NULL AS BOOLEAN) AS holds FROM lineitem WHERE l_orderkey % 5 = 4
UNION ALL SELECT l_orderkey, 'Total', sum(CAST(l_extendedprice AS DECIMAL(14,2))) + CASE WHEN l_orderkey % 3 = 0 THEN 100 ELSE 0 END, TRUE, l_orderkey % 3 <> 0 FROM lineitem WHERE l_orderkey % 5 = 4 GROUP BY l_orderkey""")
def printed_commitments(spark, sf_dir):
    """Commitments beside a column of percentages, and totals with whether they hold."""
    return G.committed(G.page_rows(printed(spark, sf_dir), "doc_id", "html", G.COMMITMENTS), ["doc_id"]).select("doc_id", "name", "amount", "is_total", "holds")


@query("SELECT l_orderkey AS doc_id, sum(CAST(l_extendedprice AS DECIMAL(14,2)))::DECIMAL(30,2) AS amount FROM lineitem WHERE l_orderkey % 5 = 4 AND l_orderkey % 3 <> 0 GROUP BY l_orderkey")
def scheduled_totals(spark, sf_dir):
    return G.held_total(G.committed(G.page_rows(printed(spark, sf_dir), "doc_id", "html", G.COMMITMENTS), ["doc_id"]), ["doc_id"])
