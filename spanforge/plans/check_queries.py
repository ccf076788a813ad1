"""A query for each registered check that no other query runs, over tables written from orders, line items and parts."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.operators import chain as C
from spanforge.operators import checks as K
from spanforge.plans.base import query, read
from spanforge.plans.document_queries import CHAIN, read_chain
from spanforge.plans.record_queries import CLOSED, edges


def facts(spark, sf_dir):
    """Nine facts an order, right and wrong ones."""
    k, c, day = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate").cast("date")

    def one(field, kind, unit=None, value=None, date=None, span=None, base=None):
        parts = {"field": (field, "string"), "kind": (kind, "string"), "unit": (unit, "string"), "value": (value, "decimal(20,2)"), "date": (date, "date"), "span_length": (span, "long"), "base": (base, "string")}
        return F.struct(*((v if isinstance(v, type(k)) else F.lit(v)).cast(t).alias(n) for n, (v, t) in parts.items()))

    rows = F.array(
        one("revolver.maturity_date", "date", date=F.date_add(day, ((c % 7) * 100).cast("int"))), one("initial_term_loan.maturity_date", "date", date=F.date_add(day, 300)),
        one("libor_floor_pct", "percent", F.when(c % 4 != 0, "percent"), c % 250 - 50), one("opening_total_leverage_ratio", "ratio", "ratio", c % 5),
        one("mfn_threshold_pct", "percent", "percent", c % 3), one("mfn_junior_threshold_pct", "percent", "percent", k % 4), one("basket.ebitda_pct", "percent", "percent", 10, base=F.when(k % 6 != 0, "ebitda")),
        one("notes", "text", span=k % 2000), one("initial_term_loan.commitment", "money", "usd", c),
    )
    return read(spark, sf_dir, "orders").select(k.alias("doc_id"), F.explode(rows).alias("f")).select("doc_id", "f.*")


def violations(name, tables):
    return K.found_by(name, tables).select("doc_id", "detail")


@query("SELECT o_orderkey AS doc_id, CAST(CAST(o_orderdate AS DATE) + CAST((o_custkey % 7) * 100 AS INT) AS VARCHAR) AS detail FROM orders WHERE (o_custkey % 7) * 100 > 300")
def check_maturity_order(spark, sf_dir):
    return violations("revolver_maturity_before_term_maturity", {"facts": facts(spark, sf_dir)})


@query("""SELECT o_orderkey AS doc_id, concat('libor_floor_pct=', CAST(CAST(o_custkey % 250 - 50 AS DECIMAL(20,2)) AS VARCHAR)) AS detail FROM orders WHERE o_custkey % 250 - 50 NOT BETWEEN 0 AND 100
UNION ALL SELECT o_orderkey, 'opening_total_leverage_ratio=0.00' FROM orders WHERE o_custkey % 5 = 0""")
def check_ranges(spark, sf_dir):
    return violations("percentages_and_ratios_in_range", {"facts": facts(spark, sf_dir)})


@query("SELECT o_orderkey AS doc_id, CAST(CAST(o_custkey % 3 AS DECIMAL(20,2)) AS VARCHAR) AS detail FROM orders WHERE o_custkey % 3 >= o_orderkey % 4")
def check_mfn_order(spark, sf_dir):
    return violations("mfn_trigger_ordering", {"facts": facts(spark, sf_dir)})


@query("""WITH e AS (SELECT l_orderkey AS doc_id, sum(CAST(l_quantity AS DECIMAL(20,2))) AS ebitda FROM lineitem GROUP BY 1)
SELECT doc_id, CAST(CAST(o_custkey % 5 AS DECIMAL(20,2)) AS VARCHAR) AS detail FROM orders JOIN e ON doc_id = o_orderkey WHERE abs(o_custkey - (o_custkey % 5) * ebitda) * 20 > ebitda""")
def check_opening_leverage(spark, sf_dir):
    e = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_quantity").cast("decimal(20,2)").alias("amount"))
    return violations("opening_leverage_consistent", {"facts": facts(spark, sf_dir), "ebitda": e})


@query("SELECT o_orderkey AS doc_id, 'basket.ebitda_pct' AS detail FROM orders WHERE o_orderkey % 6 = 0")
def check_basket_base(spark, sf_dir):
    return violations("ebitda_baskets_have_identified_base", {"facts": facts(spark, sf_dir)})


@query("SELECT o_orderkey AS doc_id, 'libor_floor_pct' AS detail FROM orders WHERE o_custkey % 4 = 0")
def check_units(spark, sf_dir):
    return violations("every_numeric_has_a_unit", {"facts": facts(spark, sf_dir)})


@query("SELECT o_orderkey AS doc_id, 'notes' AS detail FROM orders WHERE o_orderkey % 2000 > 1000")
def check_citations(spark, sf_dir):
    return violations("citations_cite_a_value", {"facts": facts(spark, sf_dir)})


def payments(spark, sf_dir):
    """An even payment at each day of a customer's orders."""
    return read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), F.col("o_orderdate").cast("date").alias("payment_date"), F.lit(100).cast("decimal(20,2)").alias("amount"))


@query("""WITH s AS (SELECT o_custkey AS doc_id, count(*) * 100.00 AS total, (max(q) - min(q) + 1) * 100.00 AS expected FROM (SELECT o_custkey, year(o_orderdate) * 4 + quarter(o_orderdate) AS q FROM orders) GROUP BY 1)
SELECT doc_id, CAST(CAST(total AS DECIMAL(20,2)) AS VARCHAR) AS detail FROM s WHERE total <> expected""")
def check_even_total(spark, sf_dir):
    return violations("amortization_total_consistent", {"schedule": payments(spark, sf_dir)})


@query("""SELECT DISTINCT o_custkey AS doc_id, 'default calendar' AS detail FROM orders
WHERE o_custkey % 2 = 0 AND (CAST(o_orderdate AS DATE) <> last_day(CAST(o_orderdate AS DATE)) OR month(o_orderdate) % 3 <> 0)""")
def check_fiscal_calendar(spark, sf_dir):
    calendars = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc_id"), (F.col("c_custkey") % 2 == 0).alias("is_default"))
    return violations("date_invariants_use_fiscal_calendar", {"schedule": payments(spark, sf_dir), "calendars": calendars})


@query("""SELECT l_orderkey AS doc_id, concat(CASE l_suppkey % 7 WHEN 3 THEN 'reserved ' ELSE 'missing ' END, l_suppkey % 7) AS detail FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_suppkey % 7 IN (3, 5, 6)""")
def check_cross_references(spark, sf_dir):
    """Sections 0 to 4 stand in each agreement, 3 is reserved."""
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"))
    sections = orders.select("doc_id", F.explode(F.array(*map(F.lit, "01234"))).alias("section")).withColumn("reserved", F.col("section") == "3")
    refs = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), (F.col("l_suppkey") % 7).cast("string").alias("target"))
    return violations("cross_references_resolve", {"references": refs.join(orders, "doc_id", "left_semi"), "sections": sections})


@query("SELECT l_orderkey AS doc_id, CAST(l_suppkey % 10 AS VARCHAR) AS detail FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def check_unique_terms(spark, sf_dir):
    d = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), (F.col("l_suppkey") % 10).cast("string").alias("term"))
    return violations("defined_terms_are_unique", {"definition_marks": d})


@query("""WITH j AS (SELECT DISTINCT l_orderkey AS doc_id, CAST(l_linenumber AS VARCHAR) AS detail FROM lineitem), a AS (SELECT DISTINCT l_orderkey AS doc_id, CAST(l_linenumber AS VARCHAR) AS detail, 1 AS there FROM lineitem WHERE l_returnflag <> 'R'),
s AS (SELECT j.*, there, count(there) OVER w * 2 >= count(*) OVER w AS strict FROM j LEFT JOIN a USING (doc_id, detail) WINDOW w AS (PARTITION BY doc_id)) SELECT doc_id, detail FROM s WHERE there IS NULL AND strict""")
def check_schedules_present(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    cut = lambda d: d.select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").cast("string").alias("schedule"))
    return violations("referenced_schedules_present", {"cited_schedules": cut(li), "attached_schedules": cut(li.where("l_returnflag <> 'R'"))})


@query(f"{CLOSED} SELECT DISTINCT CAST(1 AS BIGINT) AS doc_id, CAST(e.src AS VARCHAR) AS detail FROM edges e JOIN c ON c.start = e.dst AND c.node = e.src")
def check_precedence_cycles(spark, sf_dir):
    e = edges(spark, sf_dir).select(F.lit(1).cast("long").alias("doc_id"), F.col("src").cast("string").alias("src"), F.col("dst").cast("string").alias("dst"))
    return violations("precedence_graph_is_acyclic", {"precedence": e})


@query("SELECT o_orderkey AS doc_id, CAST(o_orderkey % 7 AS VARCHAR) AS detail FROM orders WHERE o_orderkey % 7 >= 4")
def check_proviso_depth(spark, sf_dir):
    text = F.concat(F.lit("First. Then, "), F.expr("repeat('Provided that it holds, ', cast(o_orderkey % 7 as int))"), F.lit("so. Provided."))
    return violations("proviso_depth_is_readable", {"clauses": read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), text.alias("text"))})


@query(f"WITH {CHAIN} SELECT set_id AS doc_id, '2.09' AS detail FROM chain WHERE n > 1 AND CAST(set_id AS BIGINT) % 2 = 1")
def check_amendment_targets(spark, sf_dir):
    """Of every second chain the base lacks the section that its amendments change."""
    c = read_chain(spark, sf_dir)
    sections = c.where("role = 'base' and cast(set_id as long) % 2 = 0").select("set_id", F.lit("2.09").alias("section"))
    return violations("amendment_targets_exist", {"chain_findings": C.findings(c, C.effects(c.where("role = 'amendment'")), sections)})


@query("""WITH r AS (SELECT CAST(o_custkey AS VARCHAR) AS doc_id, o_orderstatus AS s, lag(o_orderstatus) OVER w AS ps, year(o_orderdate) AS d, lag(year(o_orderdate)) OVER w AS pd FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
SELECT doc_id, '6.12' AS detail FROM r WHERE ps <> s AND d = pd""")
def check_restatements(spark, sf_dir):
    """Orders of one year that restate a section in different words."""
    n = F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey"))
    o = read(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("set_id"), F.col("o_orderkey").cast("string").alias("doc_id"), n.alias("ord"), F.trunc("o_orderdate", "year").alias("effective_date"), F.col("o_orderstatus").alias("new"))
    chain = o.select("set_id", "doc_id", "ord", "effective_date", F.lit("amendment").alias("role"), F.col("ord").alias("amendment_number"))
    changes = o.select("set_id", "doc_id", "ord", F.lit(0).alias("seq"), F.lit("restate").alias("kind"), F.lit("6.12").alias("section"), "new")
    return violations("restatements_do_not_conflict", {"chain_findings": C.findings(chain, changes, o.select("set_id", F.lit("6.12").alias("section")))})


@query("SELECT p_partkey AS doc_id, 'term_sofr' AS detail FROM part WHERE p_size % 2 = 0 AND p_partkey % 3 = 0 AND p_partkey % 5 <> 0")
def check_spread_adjustment(spark, sf_dir):
    k = F.col("p_partkey")
    p = read(spark, sf_dir, "part").select(
        k.alias("doc_id"), F.when(F.col("p_size") % 2 == 0, "term_sofr").otherwise("libor").alias("benchmark"), F.when(k % 3 != 0, 0.1).alias("adjustment"),
        F.when(k % 5 != 0, "a credit spread adjustment of 0.10% applies").otherwise("no adjustment").alias("text"),
    )
    return violations("csa_not_silently_zero", {"pricing": p})


@query("""WITH g AS (SELECT p_brand AS doc_id, p_size AS upto, CAST(max(p_retailprice) AS DECIMAL(14,2)) AS margin FROM part GROUP BY ALL), w AS (SELECT *, lag(margin) OVER (PARTITION BY doc_id ORDER BY upto DESC) AS previous FROM g)
SELECT doc_id, CAST(margin AS VARCHAR) AS detail FROM w WHERE margin > previous""")
def check_grid_levels(spark, sf_dir):
    g = read(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("doc_id"), F.col("p_size").alias("upto")).agg(F.max("p_retailprice").cast("decimal(14,2)").alias("margin"))
    return violations("grid_levels_monotonic", {"grid": g})


@query("""SELECT p_partkey, p_partkey % 6 IN (1, 2, 3, 5) AS refused FROM part""")
def check_conditions(spark, sf_dir):
    """A condition for every part, some outside the grammar."""
    n = F.col("p_size").cast("string")
    forms = [F.concat(F.lit("size >= "), n), F.concat(F.lit("f(size) > "), n), F.concat(F.lit("size + "), n, F.lit(" > 2")), F.concat(F.lit("size => "), n), F.concat(F.lit("brand in [a, b] and not size == "), n), F.lit("")]
    source = F.element_at(F.array(*forms), (F.col("p_partkey") % 6 + 1).cast("int"))
    return read(spark, sf_dir, "part").select("p_partkey", K.refused(source).alias("refused"))


@query("SELECT o_orderkey AS doc_id, 'no struck text' AS detail FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 6 <> 0")
def check_blackline(spark, sf_dir):
    k = F.col("o_orderkey")
    o = read(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "doc_id")
    d = read(spark, sf_dir, "orders").select(k.alias("doc_id"), F.when(k % 2 == 0, "Deleted text is shown as struck through").otherwise("A clean copy").alias("text"))
    return violations("blackline_deletions_excised", {"documents": d, "redlines": o.where("doc_id % 3 = 0").select("doc_id", F.lit("struck").alias("kind"))})


@query("SELECT p_brand AS doc_id, CAST(p_partkey AS VARCHAR) AS detail FROM part WHERE p_partkey % 2 = 0 AND p_partkey % 5 <> 0")
def check_table_scales(spark, sf_dir):
    k = F.col("p_partkey")
    t = read(spark, sf_dir, "part").select(F.col("p_brand").alias("doc_id"), k.cast("string").alias("table_id"), F.when(k % 2 == 0, "Results (in thousands)").otherwise("Results").alias("before"), F.when(k % 5 == 0, 1000).alias("scale"))
    return violations("table_scale_declarations", {"tables": t})


TABLES = "t AS (SELECT p_brand AS doc_id, CAST(p_partkey AS VARCHAR) AS id, p_size * 10 AS s, p_size * 10 + p_partkey % 30 AS e FROM part)"


@query(f"WITH {TABLES} SELECT DISTINCT a.doc_id, a.id AS detail FROM t a JOIN t b ON a.doc_id = b.doc_id AND b.s < a.s AND a.e <= b.e")
def check_nested_tables(spark, sf_dir):
    start = F.col("p_size") * 10
    t = read(spark, sf_dir, "part").select(F.col("p_brand").alias("doc_id"), F.col("p_partkey").cast("string").alias("table_id"), start.alias("start"), (start + F.col("p_partkey") % 30).alias("end"))
    return violations("nested_table_flattening", {"tables": t})


@query("SELECT c_nationkey AS doc_id, concat('term ', c_custkey % 40) AS detail FROM customer GROUP BY ALL HAVING count(DISTINCT lower(c_mktsegment)) > 1")
def check_set_definitions(spark, sf_dir):
    d = read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("set_id"), F.concat(F.lit("term "), (F.col("c_custkey") % 40).cast("string")).alias("term"), F.col("c_mktsegment").alias("body"))
    return violations("conflicting_definitions_across_documents", {"set_definitions": d})
