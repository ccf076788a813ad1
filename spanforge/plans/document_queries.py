"""Readers, chains, extraction and checks, over pages and over agreements written from orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanforge.operators import agreement as A
from spanforge.operators import chain as C
from spanforge.operators import checks as K
from spanforge.operators import extract as X
from spanforge.operators import reconcile as R
from spanforge.plans.base import query, read, spread
from spanforge.plans.record_queries import ROWS, schedule
from spanforge.plans.registry import ANCHORS, FIELDS, KINDS
from spanforge.sources import files


@query()
def html_text_blocks(spark, sf_dir):
    """Text of every page, a block a row."""
    d = files.parsed(read(spark, sf_dir, "pages"), "page_id", "html", parts=("text",))
    return d.select("page_id", F.posexplode(F.split("text", r"\n\n")).alias("ix", "block"))


@query()
def html_links(spark, sf_dir):
    return files.parsed(read(spark, sf_dir, "pages"), "page_id", "html", parts=("links",)).select("page_id", F.explode("links").alias("l")).select("page_id", "l.*")


def priced_html(spark, sf_dir):
    """A page with a table for every part."""
    row = F.concat(F.lit("<tr><td>"), F.col("p_name"), F.lit("</td><td>$"), F.col("p_size").cast("string"), F.lit(".50</td><td><s>old</s>"), F.col("p_size").cast("string"), F.lit("%</td></tr>"))
    html = F.concat(F.lit("<p>Rates</p><table><tr><td>Name</td><td>Commitment</td><td>Margin</td></tr>"), row, F.lit("</table>"))
    return spread(read(spark, sf_dir, "part", "p_partkey", "p_name", "p_size"), "p_partkey").select(F.col("p_partkey").alias("doc_id"), html.alias("html"))


@query("""SELECT p_partkey AS doc_id, CAST(c AS INT) AS col, CASE c WHEN 0 THEN 'Name' WHEN 1 THEN 'Commitment' ELSE 'Margin' END AS label, CASE c WHEN 0 THEN p_name WHEN 1 THEN concat('$', p_size, '.50') ELSE concat(p_size, '%') END AS text FROM part, range(3) r(c)""")
def table_cells(spark, sf_dir):
    """HTML tables to cells with inferred header rows; struck text is left out."""
    cells = files.parsed(priced_html(spark, sf_dir), "doc_id", "html", parts=("cells",)).select("doc_id", F.explode("cells").alias("c")).select("doc_id", "c.*")
    return files.labelled_rows(cells, ["doc_id"]).select("doc_id", "col", "label", "text")


@query("""SELECT p_partkey AS doc_id, 'initial_term_loan.commitment' AS field, concat(p_size, '.5') AS key FROM part UNION ALL SELECT p_partkey, 'commitment_fee_pct', CAST(p_size AS VARCHAR) FROM part""")
def table_candidates(spark, sf_dir):
    cells = files.parsed(priced_html(spark, sf_dir), "doc_id", "html", parts=("cells",)).select("doc_id", F.explode("cells").alias("c")).select("doc_id", "c.*")
    return X.table_readings(files.labelled_rows(cells, ["doc_id"]), [("initial_term_loan.commitment", "commitment", "money"), ("commitment_fee_pct", "margin", "percent")]).select("doc_id", "field", "key")


@query("SELECT p_partkey AS doc_id, 'struck' AS kind, 'old' AS text FROM part")
def redlines(spark, sf_dir):
    return files.parsed(priced_html(spark, sf_dir), "doc_id", "html", parts=("redlines",)).select("doc_id", F.explode("redlines").alias("r")).select("doc_id", "r.kind", "r.text")


def agreements(spark, sf_dir):
    """A short credit agreement for every order."""
    k = F.col("o_orderkey").cast("string")
    day = F.date_format("o_orderdate", "MMMM d, yyyy")
    text = F.concat(
        F.lit("CREDIT AGREEMENT dated as of "), day, F.lit("\n\nSECTION 1.01 Definitions. “Closing Date” means "), day, F.lit(". “Applicable Margin” means "), (F.col("o_orderkey") % 9).cast("string"),
        F.lit(".50% per annum on the Base Amount. “Base Amount” means the Closing Date balance.\n\nSECTION 2.01 Revolving Credit Commitments in an aggregate amount of $"), F.col("o_custkey").cast("string"),
        F.lit(" million. The commitment fee is 0.50%. Notwithstanding Section 1.01 the Fee Letter governs. This Agreement "), F.lit("shall be governed by, and construed in accordance with, the laws of the State of New York."),
    )
    return spread(read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate"), "o_orderkey").select(F.col("o_orderkey").alias("doc_id"), text.alias("text"), F.col("o_orderdate").cast("date").alias("day"), F.col("o_custkey"), k.alias("k"))


@query("""SELECT o_orderkey AS doc_id, f.field, CASE f.field WHEN 'revolver.commitment' THEN CAST(o_custkey * 1000000 AS VARCHAR) WHEN 'commitment_fee_pct' THEN '0.5' WHEN 'facility.governing_law' THEN 'new york' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS key, f.confidence
FROM orders, (VALUES ('revolver.commitment', CAST(0.92 AS DECIMAL(10,4))), ('commitment_fee_pct', 0.88), ('facility.governing_law', 0.9), ('closing_date', 0.95), ('closing_date', 0.55)) f(field, confidence)""")
def rule_readings(spark, sf_dir):
    return X.rule_readings(agreements(spark, sf_dir)).select("doc_id", "field", "key", "confidence")


@query("""SELECT c_custkey AS doc_id, f AS field, CASE f WHEN 'facility.governing_law' THEN CASE c_custkey % 3 WHEN 2 THEN 'english' ELSE 'new york' END ELSE lower(concat(CASE f WHEN 'borrower.legal_name' THEN 'Alpha' WHEN 'guarantor.legal_name' THEN 'Beta' ELSE 'Gamma' END, ' ', c_custkey, CASE f WHEN 'administrative_agent.legal_name' THEN ' Bank' ELSE ', Inc.' END)) END AS key
FROM customer, (VALUES ('borrower.legal_name'), ('guarantor.legal_name'), ('administrative_agent.legal_name'), ('facility.governing_law')) v(f) WHERE f <> 'borrower.legal_name' OR c_custkey % 2 = 0""")
def party_readings(spark, sf_dir):
    """One borrower or, in every second agreement, three of them, who are not read as one; three forms of the governing law."""
    k = F.col("c_custkey")
    n = k.cast("string")
    many = F.concat(F.lit("among Alpha "), n, F.lit(", Inc., Delta "), n, F.lit(", LLC and Omega "), n, F.lit(" Corporation, as Borrowers, "))
    one = F.concat(F.lit("among Alpha "), n, F.lit(", Inc., a Delaware corporation, as Borrower, "))
    law = F.when(k % 3 == 0, "governed by, and construed in accordance with, the laws of the State of New York").when(k % 3 == 1, "governed by the laws of the State of New York").otherwise("governed by and construed in accordance with English law")
    text = F.concat(F.lit("CREDIT AGREEMENT "), F.when(k % 2 == 0, one).otherwise(many), F.lit("with Beta "), n, F.lit(", Inc., as Guarantor, and Gamma "), n, F.lit(" Bank, as Administrative Agent. It is "), law, F.lit("."))
    got = X.rule_readings(spread(read(spark, sf_dir, "customer", "c_custkey"), "c_custkey").select(k.alias("doc_id"), text.alias("text")))
    return got.select("doc_id", "field", "key")


@query("""SELECT o_orderkey AS doc_id, t AS term FROM orders, (VALUES ('Closing Date'), ('Applicable Margin'), ('Base Amount')) v(t)""")
def defined_terms(spark, sf_dir):
    return X.definitions(agreements(spark, sf_dir)).select("doc_id", "term")


@query("""SELECT o_orderkey AS doc_id, src, dst FROM orders, (VALUES ('Applicable Margin', 'Base Amount'), ('Base Amount', 'Closing Date')) v(src, dst)""")
def definition_edges(spark, sf_dir):
    return X.edges(agreements(spark, sf_dir))


@query("""SELECT o_orderkey AS doc_id, field, CASE field WHEN 'closing_date' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) ELSE concat(o_orderkey % 9, '.5') END AS key FROM orders, (VALUES ('closing_date'), ('applicable_margin.eurodollar_top_level_pct')) v(field)""")
def definition_readings(spark, sf_dir):
    anchors = spark.createDataFrame([(f, a, i) for f, names in ANCHORS.items() for i, a in enumerate(names)], "field string, anchor string, ix int")
    return X.definition_readings(X.definitions(agreements(spark, sf_dir)), anchors, KINDS).where("key is not null").select("doc_id", "field", "key")


@query("""SELECT o_orderkey AS doc_id, v.field, v.status FROM orders, (VALUES ('closing_date', 'confirmed'), ('revolver.commitment', 'confirmed'), ('commitment_fee_pct', 'confirmed'), ('facility.governing_law', 'confirmed'), ('mfn_threshold_pct', 'needs_review')) v(field, status)""")
def extracted_record(spark, sf_dir):
    """Rules and definitions, reconciled against the fields that were asked."""
    docs = agreements(spark, sf_dir)
    anchors = spark.createDataFrame([(f, a, i) for f, names in ANCHORS.items() for i, a in enumerate(names)], "field string, anchor string, ix int")
    readings = X.rule_readings(docs).unionByName(X.definition_readings(X.definitions(docs), anchors, KINDS)).withColumn("echo", F.lit(False))
    asked = docs.select("doc_id", F.explode(F.array(*map(F.lit, ["closing_date", "revolver.commitment", "commitment_fee_pct", "facility.governing_law", "mfn_threshold_pct"]))).alias("field"))
    return R.reconcile(asked, readings, ["doc_id", "field"], views=3).select("doc_id", "field", "status")


@query("SELECT o_orderkey AS doc_id, '1.01' AS src, '2.01' AS dst, 'notwithstanding' AS kind FROM orders")
def precedence_edges(spark, sf_dir):
    from spanforge.operators.spans import matches

    docs = agreements(spark, sf_dir)
    marks = matches(docs, r"SECTION [0-9]+\.[0-9]+", ["doc_id"]).select("doc_id", F.regexp_extract("match", r"([0-9.]+)$", 1).alias("section"), "start")
    return X.precedence(docs, marks)


@query("SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'redacted' WHEN 1 THEN 'by_design' END AS kind FROM part")
def external_kind(spark, sf_dir):
    k = F.col("p_size") % 3
    text = F.when(k == 0, "an amount of [***]").when(k == 1, "as set forth in the Fee Letter").otherwise("as set forth above")
    return read(spark, sf_dir, "part").select("p_partkey", X.external_kind(text).alias("kind"))


@query("SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'abl_revolver' WHEN 1 THEN 'cash_flow_term_loan' ELSE 'unknown' END AS archetype, p_size % 4 = 2 AS tied FROM part")
def archetype(spark, sf_dir):
    k = F.col("p_size") % 4
    text = F.when(k == 0, "borrowing base and eligible accounts").when(k == 1, "consolidated ebitda, term loan, leverage ratio").when(k == 2, "unitranche; pik toggle").otherwise("a lease")
    a = X.archetype(F.concat(text, F.lit(". An Event of Default. Each Event of Default.")))
    return spread(read(spark, sf_dir, "part", "p_partkey", "p_size"), "p_partkey").select("p_partkey", a["archetype"].alias("archetype"), a["tied"].alias("tied"))


def chains(spark, sf_dir):
    """A chain a customer: the first order is the base, the others amend it."""
    from pyspark.sql import Window as W

    o = read(spark, sf_dir, "orders")
    n = F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey"))
    o = o.withColumn("n", n)
    day = F.date_format("o_orderdate", "MMMM d, yyyy")
    head = F.when(F.col("n") == 1, F.lit("CREDIT AGREEMENT")).otherwise(F.concat(F.lit("AMENDMENT NO. "), (F.col("n") - 1).cast("string"), F.lit(" TO CREDIT AGREEMENT")))
    change = F.when(F.col("n") > 1, F.concat(F.lit("\n\nSection 2.09 of the Credit Agreement is amended by deleting “rate "), (F.col("n") - 1).cast("string"), F.lit("” and inserting “rate "), F.col("n").cast("string"), F.lit("” in its place."))).otherwise("")
    text = F.concat(head, F.lit(" dated as of "), day, change)
    return o.select(F.col("o_custkey").cast("string").alias("set_id"), F.lpad(F.col("n").cast("string"), 9, "0").alias("doc_id"), text.alias("text"))


CHAIN = "chain AS (SELECT CAST(o_custkey AS VARCHAR) AS set_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n, CAST(o_orderdate AS DATE) AS day FROM orders)"


def read_chain(spark, sf_dir):
    c = chains(spark, sf_dir)
    kind, number = C.role(F.col("text"))
    return C.ordered(c.withColumns({"role": kind, "amendment_number": number, "effective_date": C.effective_date(F.col("text"))}))


@query(f"WITH {CHAIN} SELECT set_id, lpad(CAST(n AS VARCHAR), 9, '0') AS doc_id, CASE WHEN n = 1 THEN 'base' ELSE 'amendment' END AS role, CASE WHEN n > 1 THEN CAST(n - 1 AS INT) END AS amendment_number, day AS effective_date FROM chain")
def chain_roles(spark, sf_dir):
    return read_chain(spark, sf_dir).select("set_id", "doc_id", "role", "amendment_number", "effective_date")


@query(f"WITH {CHAIN} SELECT set_id, lpad(CAST(n AS VARCHAR), 9, '0') AS doc_id, CAST(row_number() OVER (PARTITION BY set_id ORDER BY day, CASE WHEN n = 1 THEN 0 ELSE n - 1 END, lpad(CAST(n AS VARCHAR), 9, '0')) AS INT) AS ord FROM chain")
def chain_order(spark, sf_dir):
    return read_chain(spark, sf_dir).select("set_id", "doc_id", "ord")


@query(f"WITH {CHAIN} SELECT set_id, lpad(CAST(n AS VARCHAR), 9, '0') AS doc_id, 'replace' AS kind, '2.09' AS section, concat('rate ', n - 1) AS old, concat('rate ', n) AS new FROM chain WHERE n > 1")
def amendment_effects(spark, sf_dir):
    return C.effects(read_chain(spark, sf_dir).where("role = 'amendment'")).select("set_id", "doc_id", "kind", "section", "old", "new")


@query(f"WITH {CHAIN}, m AS (SELECT set_id, max(n) AS n FROM chain GROUP BY set_id) SELECT set_id, concat('The rate ', n, ' applies.') AS body, CASE WHEN n > 1 THEN lpad(CAST(n AS VARCHAR), 9, '0') END AS source FROM m")
def operative_text(spark, sf_dir):
    """The section after all amendments, in the order of their numbers."""
    c = read_chain(spark, sf_dir).withColumn("ord", F.coalesce("amendment_number", F.lit(0)).cast("int"))
    base = c.where("role = 'base'").select("set_id", F.lit("2.09").alias("section"), F.lit("The rate 1 applies.").alias("body"))
    return C.fold(base, C.effects(c.where("role = 'amendment'"))).select("set_id", "body", "source")


@query(f"""WITH {ROWS}, w AS (SELECT doc_id, payment_date, lag(payment_date) OVER (PARTITION BY doc_id ORDER BY row_index) AS previous FROM rows),
s AS (SELECT doc_id, count(*) AS rows, max(q) - min(q) + 1 AS quarters FROM (SELECT doc_id, year(payment_date) * 4 + quarter(payment_date) AS q FROM rows) GROUP BY doc_id)
SELECT doc_id, 'amortization_dates_strictly_increasing' AS "check", CAST(payment_date AS VARCHAR) AS detail FROM w WHERE payment_date <= previous
UNION ALL SELECT doc_id, 'amortization_row_count_matches_quarters', concat(rows, '/', quarters) FROM s WHERE rows <> quarters""")
def invariant_violations(spark, sf_dir):
    """The registry run over the tables at hand, without the checks that are skipped by name."""
    return K.run({"schedule": schedule(spark, sf_dir)}, skip={"amortization_dates_evenly_spaced", "amortization_total_consistent"})


@query("""SELECT l_orderkey AS doc_id, concat('missing ', l_partkey) AS detail, count(*) AS times FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10) GROUP BY ALL""")
def cross_refs_anti(spark, sf_dir):
    refs = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_partkey").alias("target"))
    known = read(spark, sf_dir, "part").where("p_size > 10").select("p_partkey")
    missing = refs.join(known, refs.target == known.p_partkey, "left_anti")
    return missing.select("doc_id", F.concat(F.lit("missing "), F.col("target").cast("string")).alias("detail")).groupBy("doc_id", "detail").agg(F.count("*").alias("times"))


@query("""SELECT p_partkey AS doc_id, concat(n, '/', p_size) AS detail FROM (SELECT p_partkey, p_size, CASE p_partkey % 3 WHEN 0 THEN 20 WHEN 1 THEN 25 ELSE 30 END AS n FROM part) WHERE n <> p_size""")
def numeral_words(spark, sf_dir):
    k = F.col("p_partkey") % 3
    words = F.when(k == 0, "twenty").when(k == 1, "twenty-five").otherwise("thirty")
    text = F.concat(F.lit("not more than "), words, F.lit(" percent ("), F.col("p_size").cast("string"), F.lit("%) of it"))
    c = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc_id"), text.alias("text"))
    return K.found_by("numeral_and_words_agree", {"clauses": c}).select("doc_id", "detail")


@query("WITH n AS (SELECT field, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 4 = 0 THEN 'closing_date' WHEN o_orderkey % 4 = 1 THEN 'mfn_sunset' WHEN o_orderkey % 4 = 2 THEN 'no_such_field' ELSE 'pik.rate_pct' END AS field FROM orders) GROUP BY field) SELECT coalesce(v.field, n.field) AS field, kind, field_class, CAST(criticality AS INT) AS criticality, coalesce(n, 0) AS readings, v.field IS NOT NULL AS known FROM (VALUES {}) v(field, kind, field_class, criticality) FULL JOIN n ON v.field = n.field".format(", ".join(f"('{a}', '{b}', '{c}', {d})" for a, b, c, d in FIELDS)))
def field_registry(spark, sf_dir):
    """The registered fields, how many readings there are of each, and readings of fields that are not registered."""
    names = F.element_at(F.array(*map(F.lit, ["closing_date", "mfn_sunset", "no_such_field", "pik.rate_pct"])), (F.col("o_orderkey") % 4 + 1).cast("int"))
    n = read(spark, sf_dir, "orders").groupBy(names.alias("field")).agg(F.count("*").alias("n"))
    return X.registry(spark).withColumn("known", F.lit(True)).join(n, "field", "full").select("field", "kind", "field_class", "criticality", F.coalesce("n", F.lit(0)).alias("readings"), F.coalesce("known", F.lit(False)).alias("known"))


def fields_of(spark, sf_dir):
    k = F.col("o_orderkey")
    status = F.when(k % 3 == 0, "confirmed").when(k % 3 == 1, "needs_review").otherwise("conflicted")
    names = F.array(*map(F.lit, ["revolver.commitment", "closing_date", "libor_floor_pct"]))
    return read(spark, sf_dir, "orders").select(k.alias("doc_id"), F.explode(names).alias("field"), status.alias("status"), F.col("o_custkey").cast("string").alias("value"))


FIELDS = """fields AS (SELECT o_orderkey AS doc_id, field, CASE o_orderkey % 3 WHEN 0 THEN 'confirmed' WHEN 1 THEN 'needs_review' ELSE 'conflicted' END AS status, CAST(o_custkey AS VARCHAR) AS value
  FROM orders, (VALUES ('revolver.commitment'), ('closing_date'), ('libor_floor_pct')) v(field)),
slots(path, field) AS (VALUES {}), record AS (SELECT d.doc_id, path, coalesce(status, 'needs_review') AS status, value FROM (SELECT DISTINCT doc_id FROM fields) d CROSS JOIN slots s LEFT JOIN fields f ON f.doc_id = d.doc_id AND f.field = s.field)""".format(", ".join(f"('{p}', '{f}')" for p, f in A.SLOTS))


@query(f"WITH {FIELDS} SELECT doc_id, path, CASE WHEN status IN ('confirmed', 'absent_from_document') THEN value END AS value, CASE WHEN status NOT IN ('confirmed', 'absent_from_document') THEN concat('status ', status) END AS withheld FROM record")
def exported_record(spark, sf_dir):
    return A.exported(A.record(fields_of(spark, sf_dir)))


@query(f"WITH {FIELDS} SELECT doc_id, count(*) FILTER (WHERE status = 'confirmed') AS settled, count(*) FILTER (WHERE status <> 'confirmed' AND value IS NOT NULL) AS unsettled, count(*) FILTER (WHERE status <> 'confirmed' AND value IS NULL) AS empty FROM record GROUP BY doc_id")
def leaf_coverage(spark, sf_dir):
    return A.coverage(A.record(fields_of(spark, sf_dir)))


@query("SELECT o_orderkey AS doc_id, 'revolver' AS tranche, CAST(o_custkey AS VARCHAR) AS commitment FROM orders WHERE o_orderkey % 3 = 0")
def facilities(spark, sf_dir):
    return A.facilities(A.record(fields_of(spark, sf_dir)))


@query("""SELECT o_orderkey AS doc_id, tranche, slot, CASE WHEN slot = 'floor' THEN CAST(CASE WHEN o_orderkey % 5 = 0 AND tranche = 'revolver' THEN -1 ELSE o_custkey END AS VARCHAR) END AS value,
  CASE WHEN slot = 'margin' THEN 'applicable_margin.eurodollar_top_level_pct' WHEN o_orderkey % 5 = 0 AND tranche = 'revolver' THEN NULL ELSE 'libor_floor_pct' END AS basis
FROM orders, (VALUES ('revolver'), ('initial_term_loan')) t(tranche), (VALUES ('margin'), ('floor')) s(slot)""")
def tranche_terms(spark, sf_dir):
    f = fields_of(spark, sf_dir)
    own = f.where("field = 'libor_floor_pct' and doc_id % 5 = 0").select("doc_id", "field", F.lit("revolver").alias("tranche"), F.lit("-1").alias("value"))
    return A.tranche_terms(f, own, ["revolver", "initial_term_loan"])
