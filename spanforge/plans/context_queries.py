"""Chunks of definitions, closures under a budget, articles that define and grids in running text, over agreements written from orders and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanforge.operators import contexts as C
from spanforge.operators import extract as X
from spanforge.plans.base import query, read, spread
from spanforge.plans.economics_queries import said, text

PAD, GAP, BUDGET = 30, 20, 160

TEXTS = """w AS (SELECT o_orderkey AS doc_id, 'SECTION 1.01 Definitions. ' AS p0, concat('“Alpha Rate” means ', o_custkey % 7, '% over the Beta Base. ') AS d1, concat('“Beta Base” means the Gamma Sum less ', o_orderkey, '. ') AS d2, '“Gamma Sum” means nothing. SECTION 2.01 Loans. ' AS d3,
  repeat('x ', CAST(o_custkey % 40 AS INT)) AS f1, 'The Alpha Rate applies. ' AS u1, repeat('y ', CAST(o_orderkey % 50 AS INT)) AS f2, 'The Alpha  Rate counts.' AS u2 FROM orders),
n AS (SELECT doc_id, length(p0) AS a1, length(p0) + length(d1) AS a2, length(p0) + length(d1) + length(d2) AS a3, length(p0) + length(d1) + length(d2) + length(d3) + length(f1) + 4 AS s1, length(p0) + length(d1) + length(d2) + length(d3) + length(f1) + length(u1) + length(f2) + 4 AS s2,
  length(concat(p0, d1, d2, d3, f1, u1, f2, u2)) AS z, length(p0) + strpos(d1, 'Beta Base') - 1 AS b1, length(p0) + length(d1) + strpos(d2, 'Gamma Sum') - 1 AS g1 FROM w)"""


def agreements(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    t = text(
        "SECTION 1.01 Definitions. “Alpha Rate” means ", (c % 7).cast("string"), "% over the Beta Base. “Beta Base” means the Gamma Sum less ", k.cast("string"), ". “Gamma Sum” means nothing. SECTION 2.01 Loans. ",
        F.repeat(F.lit("x "), (c % 40).cast("int")), "The Alpha Rate applies. ", F.repeat(F.lit("y "), (k % 50).cast("int")), "The Alpha  Rate counts.",
    )
    return o.select(k.alias("doc_id"), t.alias("text"))


@query(f"""WITH {TEXTS}, s AS (SELECT doc_id, 'Alpha Rate' AS term, a1 AS a, a2 AS b FROM n UNION ALL SELECT doc_id, 'Beta Base', a2, a3 FROM n UNION ALL SELECT doc_id, 'Gamma Sum', a3, z FROM n
  UNION ALL SELECT doc_id, 'Alpha Rate', s1 - {PAD}, s1 + 10 + {PAD} FROM n UNION ALL SELECT doc_id, 'Alpha Rate', s2 - {PAD}, least(z, s2 + 11 + {PAD}) FROM n UNION ALL SELECT doc_id, 'Beta Base', greatest(0, b1 - {PAD}), b1 + 9 + {PAD} FROM n UNION ALL SELECT doc_id, 'Gamma Sum', g1 - {PAD}, g1 + 9 + {PAD} FROM n),
f AS (SELECT *, CASE WHEN a - max(b) OVER (PARTITION BY doc_id, term ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= {GAP} THEN 0 ELSE 1 END AS fresh FROM s),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, term ORDER BY a, b) AS part FROM f)
SELECT doc_id, term, CAST(part AS INT) AS part, CAST(min(a) AS BIGINT) AS start, CAST(max(b) AS BIGINT) AS "end" FROM i GROUP BY ALL""")
def definitional_chunks(spark, sf_dir):
    """Definitions with their uses and what stands around them, joined over short gaps."""
    d = agreements(spark, sf_dir)
    return C.definitional(d, X.definitions(d), PAD, 12, GAP)


@query(f"""WITH {TEXTS}, d AS (SELECT doc_id, 1 AS k, 'Alpha Rate' AS term, a2 - a1 AS size FROM n UNION ALL SELECT doc_id, 2, 'Beta Base', a3 - a2 FROM n UNION ALL SELECT doc_id, 3, 'Gamma Sum', z - a3 FROM n),
r AS (SELECT a.doc_id, a.term AS anchor, b.term, row_number() OVER w AS ix, sum(b.size) OVER w AS used FROM d a JOIN d b ON a.doc_id = b.doc_id WINDOW w AS (PARTITION BY a.doc_id, a.k ORDER BY (b.k - a.k + 3) % 3))
SELECT doc_id, anchor, CAST(ix AS INT) AS ix, term FROM r WHERE used <= {BUDGET}""")
def closure_chunks(spark, sf_dir):
    """What a definition rests on, as far as the budget goes; each of the three rests on the next, the last on the first again."""
    return C.closures_of(spread(agreements(spark, sf_dir), "doc_id"), BUDGET).select("doc_id", "anchor", "ix", "term")


REGION = """r AS (SELECT o_orderkey AS doc_id, o_orderkey % 4 AS f, repeat('z ', CAST(o_custkey % 30 AS INT)) AS x FROM orders),
t AS (SELECT doc_id, f, CASE f WHEN 0 THEN concat('ARTICLE I', chr(10), 'DEFINITIONS', chr(10), x, '“A” means one. “B” means two. ', chr(10), 'ARTICLE II', chr(10), 'LOANS', chr(10), '“C” means three.')
  WHEN 1 THEN concat('Section 1.01 Definitions. ', x, chr(10), 'ARTICLE II', chr(10), 'LOANS', chr(10), chr(10), 'EXHIBIT A', chr(10), chr(10), 'ARTICLE I', chr(10), 'DEFINITIONS', chr(10), '“A” means one. ', x, chr(10), 'ARTICLE II', chr(10), 'MORE', chr(10))
  WHEN 2 THEN concat('ARTICLE I', chr(10), 'GENERAL', chr(10), x, chr(10), 'ARTICLE II', chr(10), 'LOANS', chr(10), '“A” means one. ', chr(10), 'ARTICLE III', chr(10), 'FEES', chr(10), x) ELSE concat('No heading. ', x, '“A” means one.') END AS text FROM r)"""


@query(f"""WITH {REGION} SELECT doc_id, CAST(CASE f WHEN 1 THEN strpos(text, concat('ARTICLE I', chr(10))) - 1 WHEN 2 THEN strpos(text, 'ARTICLE II') - 1 ELSE 0 END AS BIGINT) AS start,
  CAST(CASE f WHEN 0 THEN strpos(text, 'ARTICLE II') - 1 WHEN 1 THEN strpos(text, concat('ARTICLE II', chr(10), 'MORE')) - 1 WHEN 2 THEN strpos(text, 'ARTICLE III') - 1 ELSE length(text) END AS BIGINT) AS "end" FROM t""")
def definitions_regions(spark, sf_dir):
    """Articles that define: in place, in an exhibit, under another number, and nowhere by name."""
    k, x = F.col("o_orderkey") % 4, F.repeat(F.lit("z "), (F.col("o_custkey") % 30).cast("int"))
    forms = [
        text("ARTICLE I\nDEFINITIONS\n", x, "“A” means one. “B” means two. \nARTICLE II\nLOANS\n“C” means three."), text("Section 1.01 Definitions. ", x, "\nARTICLE II\nLOANS\n\nEXHIBIT A\n\nARTICLE I\nDEFINITIONS\n“A” means one. ", x, "\nARTICLE II\nMORE\n"),
        text("ARTICLE I\nGENERAL\n", x, "\nARTICLE II\nLOANS\n“A” means one. \nARTICLE III\nFEES\n", x), text("No heading. ", x, "“A” means one."),
    ]
    return C.definitions_region(read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), said(forms, k).alias("text")))


@query("""WITH p AS (SELECT p_partkey, p_size, v.k, v.level, v.band FROM part, (VALUES (1, 'I', '> 5.50'), (2, 'II', '<= 5.50 and > 4.50'), (3, 'III', '<= 4.50')) v(k, level, band))
SELECT p_partkey AS doc_id, CASE WHEN p_partkey % 2 = 0 THEN concat('Level ', level) ELSE level END AS level, band, CAST(c AS INT) AS col, CASE WHEN p_partkey % 3 = 0 THEN '' WHEN c = 2 THEN 'Eurodollar Rate' ELSE 'Base Rate' END AS label, CAST(p_size + k / 4.0 - (c - 2) AS DECIMAL(12,4)) AS rate FROM p, (VALUES (2), (3)) x(c)""")
def text_grids(spark, sf_dir):
    """Grids set out by blanks, with and without labels."""
    k, size = F.col("p_partkey"), F.col("p_size")
    width = (8 + k % 5).cast("int")
    cell = lambda c, more: F.rpad(c if not isinstance(c, str) else F.lit(c), width + more, " ")
    rate = lambda n, less: F.concat((size + F.lit(n) / 4 - less).cast("decimal(8,2)").cast("string"), F.lit("%"))
    level = lambda x: F.when(k % 2 == 0, f"Level {x}").otherwise(x)
    rows = [F.concat(cell(level(x), 6), cell(band, 16), cell(rate(n, 0), 12), rate(n, 1)) for n, (x, band) in enumerate([("I", "> 5.50"), ("II", "<= 5.50 and > 4.50"), ("III", "<= 4.50")], 1)]
    head = F.when(k % 3 == 0, F.lit("")).otherwise(F.concat(cell("Level", 6), cell("Leverage", 16), cell("Eurodollar Rate", 12), F.lit("Base Rate"), F.lit("\n")))
    t = F.concat(F.lit("The margin, 9.00% at most, is this:\n\n"), head, *[x for r in rows for x in (r, F.lit("\n"))], F.lit("\nI is 5.00% of it."))
    return C.text_grids(read(spark, sf_dir, "part").select(k.alias("doc_id"), t.alias("text")), ["doc_id"]).select("doc_id", "level", "band", "col", "label", "rate")
