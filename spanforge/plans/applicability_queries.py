"""Fields that a kind of deal rules out, and documents whose words say otherwise, over texts written from parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanforge.operators import applicability as A
from spanforge.plans.base import query, read, spread
from spanforge.plans.economics_queries import said, text
from spanforge.plans.registry import FIELDS

NAMES = [f for f, *_ in FIELDS]


def deals(spark, sf_dir):
    """Revolvers on a borrowing base: one with a term loan of its own, one that holds term loans, one with both, one with neither."""
    p = spread(read(spark, sf_dir, "part", "p_partkey", "p_name", "p_size"), "p_partkey")
    head = text("A borrowing base of eligible accounts of ", F.col("p_name"), ". An Event of Default. Each Event of Default. ")
    held = "Each Collateral Loan that is a Term Loan is held. "
    forms = [F.lit("The Term Loan matures."), F.lit(held), text(held, F.repeat(F.lit("w "), F.col("p_size") + 40), "The Term Loan is repaid."), F.lit("Nothing else.")]
    return p.select(F.col("p_partkey").alias("doc_id"), F.concat(head, said(forms, F.col("p_partkey") % 4)).alias("text"))


@query("""SELECT p_partkey AS doc_id, 'borrowing_base' AS "group", 'borrowing base' AS phrase, CAST(2 AS BIGINT) AS start FROM part
UNION ALL SELECT p_partkey, 'term_amortization', 'term loan', CAST(length(concat('A borrowing base of eligible accounts of ', p_name, '. An Event of Default. Each Event of Default. ')) + CASE WHEN p_partkey % 4 = 0 THEN 4 ELSE length('Each Collateral Loan that is a Term Loan is held. ') + 2 * (p_size + 40) + 4 END AS BIGINT) FROM part WHERE p_partkey % 4 IN (0, 2)""")
def evidence_vetoes(spark, sf_dir):
    """Groups of fields that a document shows; uses beside what the borrower holds don't count."""
    return A.evidence(deals(spark, sf_dir))


RULED_OUT = ", ".join(f"('{g}', '{f}')" for g, f in A.fields_of(NAMES) if g in ("term_amortization", "recurring_revenue", "nav_tests", "pik_mechanics"))


@query(f"""SELECT p_partkey AS doc_id, 'abl_revolver' AS archetype, v."group", v.field FROM part, (VALUES {RULED_OUT}) v("group", field) WHERE v."group" <> 'term_amortization' OR p_partkey % 4 IN (1, 3)""")
def inapplicable_fields(spark, sf_dir):
    return A.inapplicable(deals(spark, sf_dir), NAMES)


@query("""SELECT p_partkey, p_partkey % 3 = 0 OR (p_partkey % 3 = 1 AND p_size < 60) AS bare FROM part""")
def bare_amendments(spark, sf_dir):
    """Amendments with and without the agreement that they amend."""
    k = F.col("p_partkey") % 3
    body = F.when(k == 0, F.lit("")).otherwise(F.repeat(F.lit("“A” means it. "), F.when(k == 1, F.col("p_size")).otherwise(60)))
    t = text("AMENDMENT NO. ", F.col("p_size").cast("string"), "\nTO THE CREDIT AGREEMENT\n", body)
    return read(spark, sf_dir, "part").select("p_partkey", A.bare_amendment(t).alias("bare"))
