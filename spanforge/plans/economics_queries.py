"""Economic readers over texts and tables whose form varies by row."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanforge.operators import economics as E
from spanforge.operators import terms as T
from spanforge.plans.base import query, read, spread


def said(parts: list, by):
    """The text of the form that a number picks."""
    out = F.lit(None).cast("string")
    for i, p in enumerate(parts):
        out = F.when(by == i, p if not isinstance(p, str) else F.lit(p)).otherwise(out)
    return out


def text(*parts):
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


MONEY = "CAST(o_totalprice AS DECIMAL(14,2))"


@query(f"SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 4 THEN CAST({MONEY} AS DECIMAL(38,10)) WHEN o_orderkey % 6 = 4 THEN CAST((o_custkey + 1) * 1000000 AS DECIMAL(38,10)) END AS commitment FROM orders")
def commitments(spark, sf_dir):
    """Five forms of a size, and a body that has a figure but states no size."""
    m, big = F.col("o_totalprice").cast("decimal(14,2)").cast("string"), (F.col("o_custkey") + 1).cast("string")
    forms = [
        text("means term loans in an aggregate principal amount of $", m, ", subject to Section 2.05(a)"), text("means the commitment of each Lender. The initial aggregate amount of the Commitments is $", m, "."),
        text("means each Commitment; the Revolving Commitments of all Lenders on the Closing Date shall be $", m, "."), text("means a $", m, " revolving credit facility"),
        text("means loans in an aggregate original principal amount not to exceed $", big, " million"), text("means a fee of $", m, " for each notice"),
    ]
    o = read(spark, sf_dir, "orders")
    return o.select("o_orderkey", E.commitment(said(forms, F.col("o_orderkey") % 6)).cast("decimal(38,10)").alias("commitment"))


@query("""WITH o AS (SELECT o_orderkey AS doc_id, CAST(o_orderdate AS DATE) AS c, o_orderkey % 5 AS f FROM orders), own AS (SELECT *, CAST(CASE f WHEN 0 THEN c + INTERVAL 5 YEAR WHEN 1 THEN c + INTERVAL 18 MONTH WHEN 2 THEN c + INTERVAL 7 YEAR WHEN 3 THEN least(c + INTERVAL 3 YEAR, DATE '2027-06-30') ELSE DATE '2026-03-31' END AS DATE) AS d FROM o)
SELECT doc_id, term, d AS date, CAST(s AS INT) AS steps FROM own, (VALUES ('Stated Date', 0), ('Final Date', 1), ('Maturity Date', 2)) t(term, s)""")
def maturity_chain(spark, sf_dir):
    """Terms that point to one another; two of them to each other, which have no date."""
    o = spread(read(spark, sf_dir, "orders", "o_orderkey", "o_orderdate"), "o_orderkey").select(F.col("o_orderkey").alias("doc_id"), F.col("o_orderdate").cast("date").alias("closing"))
    forms = ["means the date that is five (5) years after the Closing Date", "means the date that is 18 months after the Closing Date", "means the seventh anniversary of the Closing Date", "means the earlier of (a) the third anniversary of the Closing Date and (b) June 30, 2027", "means March 31, 2026"]
    own = o.select("doc_id", F.lit("Stated Date").alias("term"), F.replace(said(forms, F.col("doc_id") % 5), F.lit("the Closing Date"), F.lit("the date of this Agreement")).alias("body"))
    terms = [("Final Date", "means the Stated Date"), ("Maturity Date", "has the meaning of “Final Date”."), ("This Date", "means the That Date"), ("That Date", "means the This Date")]
    more = o.select("doc_id", F.explode(F.array(*[F.struct(F.lit(t).alias("term"), F.lit(b).alias("body")) for t, b in terms])).alias("x")).select("doc_id", "x.*")
    found = T.dates(own.unionByName(more).withColumn("at", F.col("term")), o.withColumnRenamed("closing", "agreed"))
    return found.where("term <> 'Closing Date'").select("doc_id", "term", "date", (F.size("route") - 1).alias("steps"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, marker, CASE marker WHEN 'a' THEN concat('means, for Loans, ', p, '% per annum under Section 2.05(b)') ELSE concat('means, for Loans, ', p + 1, '% as clause (a) says') END AS limb
FROM (SELECT *, CAST(round(l_discount * 100) AS INT) AS p FROM lineitem), (VALUES ('a'), ('b')) m(marker)""")
def limb_splitter(spark, sf_dir):
    p = F.round(F.col("l_discount") * 100).cast("int")
    body = text("means, for Loans, (a) ", p.cast("string"), "% per annum under Section 2.05(b); and (b) ", (p + 1).cast("string"), "% as clause (a) says")
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", body.alias("body"))
    return T.limb_rows(li, ["l_orderkey", "l_linenumber", "l_partkey"]).select("l_orderkey", "l_linenumber", "l_partkey", F.btrim("path", F.lit("()")).alias("marker"), "limb")


@query("""SELECT p_partkey, CAST(i AS INT) AS ix, CASE i WHEN 0 THEN concat(p_name, ' (provided that it is kept)') WHEN 1 THEN concat('provided that ', p_size, ' hold') ELSE 'provided further that none is left' END AS piece FROM part, (VALUES (0), (1), (2)) v(i)""")
def proviso_splitter(spark, sf_dir):
    body = text(F.col("p_name"), " (provided that it is kept); provided that ", F.col("p_size").cast("string"), " hold; provided further that none is left.")
    return spread(read(spark, sf_dir, "part", "p_partkey", "p_name", "p_size"), "p_partkey").select("p_partkey", F.posexplode(E.provisos(body)).alias("ix", "piece"))


@query("""WITH p AS (SELECT p_partkey, CAST(p_size AS DECIMAL(12,4)) / 8 AS r, p_partkey % 3 AS f FROM part)
SELECT p_partkey, b AS benchmark, CAST(CASE b WHEN 'base_rate' THEN r - 0.125 ELSE r END AS DECIMAL(12,4)) AS rate FROM p, (VALUES ('eurodollar', 0), ('base_rate', 0), ('sofr', 1), ('base_rate', 1)) v(b, g) WHERE f = g""")
def margin_limbs(spark, sf_dir):
    """Margins of two limbs, with a default rate beside them; where the fee letter says them there are none."""
    r = (F.col("p_size").cast("decimal(12,4)") / 8).cast("decimal(12,4)")
    low = (r - F.lit(0.125).cast("decimal(12,4)")).cast("decimal(12,4)")
    two = lambda name: text(f"means, per annum, (a) for {name} Loans, ", r.cast("string"), "%, (b) for Base Rate Loans, ", low.cast("string"), "% and (c) for overdue Base Rate Loans, 9.5%")
    body = said([two("Eurodollar"), two("Term SOFR"), "means the rate set forth in the Fee Letter"], F.col("p_partkey") % 3)
    return T.margins(read(spark, sf_dir, "part").select("p_partkey", body.alias("body")), ["p_partkey"]).where("reason is null").select("p_partkey", F.col("kind").alias("benchmark"), "rate")


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN CAST(p_size / 20.0 AS DECIMAL(12,4)) WHEN 1 THEN CAST(0.5 AS DECIMAL(12,4)) END AS fee, p_partkey % 3 = 2 AS in_letter FROM part""")
def fee_rates(spark, sf_dir):
    rate = (F.col("p_size").cast("decimal(12,4)") / 20).cast("decimal(12,4)").cast("string")
    body = said([text("a commitment fee of ", rate, "% on what is not drawn"), "where use exceeds 50% of the facility, a fee of 0.50%", "fees as agreed in the Fee Letter, not over 1.00%"], F.col("p_partkey") % 3)
    return read(spark, sf_dir, "part").select("p_partkey", E.fee(body).alias("fee"), E.in_letter(body).alias("in_letter"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 5 < 3 THEN CAST(p_size / 40.0 AS DECIMAL(12,4)) WHEN p_partkey % 5 = 3 THEN CAST(0 AS DECIMAL(12,4)) END AS floor FROM part""")
def floors(spark, sf_dir):
    r = (F.col("p_size").cast("decimal(12,4)") / 40).cast("decimal(12,4)").cast("string")
    forms = [text("the rate shall in no event be not less than ", r, "% per annum"), text("if the rate is less than ", r, "%, it shall be deemed to be that"), text("the greater of (x) the screen rate and (y) ", r, "%"), "if the rate is below zero, it shall be deemed to be zero", "the rate on the screen"]
    return read(spark, sf_dir, "part").select("p_partkey", E.floor(said(forms, F.col("p_partkey") % 5)).alias("floor"))


def cells_of(rows, *columns):
    """One table a document from rows (doc_id, row): a cell a column, behind a header row."""
    cells = F.array(*[F.struct(F.lit(i).alias("col"), c.alias("text")) for i, c in enumerate(columns)])
    return rows.select("doc_id", F.lit(0).alias("table_id"), "row", F.explode(cells).alias("c")).select("doc_id", "table_id", "row", "c.*")


def lines(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.monotonically_increasing_id().alias("row"), "*")


@query("SELECT l_orderkey AS doc_id, CAST(l_shipdate AS DATE) AS payment_date, CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS DECIMAL(20,2)) AS amount FROM lineitem WHERE l_linenumber % 4 <> 0")
def amortization_table(spark, sf_dir):
    """Rows of dates in two forms; rows that have a note in place of the date are none."""
    day = F.when(F.col("l_linenumber") % 4 == 0, "Thereafter").when(F.col("l_linenumber") % 2 == 0, F.date_format("l_shipdate", "MMMM d, yyyy")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    got = E.amortization_rows(cells_of(lines(spark, sf_dir), day, text("$", F.col("l_extendedprice").cast("decimal(14,2)").cast("string"))))
    return got.select("doc_id", "payment_date", F.col("amount").cast("decimal(20,2)").alias("amount"))


@query("SELECT l_orderkey AS doc_id, strftime(l_shipdate, '%B %-d, %Y') AS label, CAST(l_quantity * 1000 AS DECIMAL(20,2)) AS amount FROM lineitem WHERE l_linenumber % 3 <> 0")
def ebitda_table(spark, sf_dir):
    label = F.when(F.col("l_linenumber") % 3 == 0, "Total").otherwise(F.date_format("l_shipdate", "MMMM d, yyyy"))
    got = E.ebitda_rows(cells_of(lines(spark, sf_dir), label, text("$", F.format_number(F.col("l_quantity") * 1000, 0))))
    return got.select("doc_id", "label", F.col("amount").cast("decimal(20,2)").alias("amount"))


@query("SELECT l_orderkey AS doc_id, strftime(l_shipdate, '%B %-d, %Y') AS label, CAST(l_quantity / 8 AS DECIMAL(12,4)) AS level FROM lineitem WHERE l_linenumber % 3 <> 0")
def covenant_table(spark, sf_dir):
    ratio = F.when(F.col("l_linenumber") % 3 == 0, "none").otherwise(text((F.col("l_quantity") / 8).cast("decimal(12,4)").cast("string"), " to 1.00"))
    got = E.covenant_grid(cells_of(lines(spark, sf_dir), F.date_format("l_shipdate", "MMMM d, yyyy"), ratio))
    return got.select("doc_id", "label", F.col("level").cast("decimal(12,4)").alias("level"))


@query("""SELECT l_orderkey AS doc_id, concat('Level ', l_linenumber) AS level, CAST(c AS INT) AS col, CAST(round(l_discount * 100) + c AS DECIMAL(12,4)) AS rate FROM lineitem, (VALUES (1), (2)) v(c)""")
def pricing_table(spark, sf_dir):
    p = F.round(F.col("l_discount") * 100).cast("int")
    got = E.pricing_grid(cells_of(lines(spark, sf_dir), text("Level ", F.col("l_linenumber").cast("string")), text((p + 1).cast("string"), ".00%"), text((p + 2).cast("string"), "%"), F.lit("n/a")))
    return got.select("doc_id", "level", "col", F.col("rate").cast("decimal(12,4)").alias("rate"))


@query("""SELECT l_orderkey AS doc_id, concat('Facility ', l_returnflag) AS facility, CAST(l_quantity * CASE l_orderkey % 3 WHEN 0 THEN 1000 WHEN 1 THEN 1000000 ELSE 1 END AS DECIMAL(30,2)) AS amount, CAST(l_shipdate AS DATE) AS maturity FROM lineitem""")
def commitment_table(spark, sf_dir):
    """Amounts by the scale that a table declares."""
    own = cells_of(lines(spark, sf_dir), text("Facility ", F.col("l_returnflag")), text("$", F.col("l_quantity").cast("int").cast("string")), F.date_format("l_shipdate", "MMMM d, yyyy"))
    k = F.col("l_orderkey") % 3
    scales = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.lit(0).alias("table_id"), F.when(k == 0, "thousands").when(k == 1, "millions").alias("scale")).distinct()
    return E.commitment_rows(own, scales).select("doc_id", "facility", "amount", "maturity")
