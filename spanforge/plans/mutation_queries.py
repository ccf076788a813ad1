"""Agreements written from customers as HTML, rewritten in eleven ways: what checks find in them, and where labels go."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanforge.operators import mutations as M
from spanforge.operators import validate as V
from spanforge.plans.base import query, read, spread
from spanforge.plans.economics_queries import text
from spanforge.session import durable
from spanforge.sources import files


def pages(spark, sf_dir):
    """Every fourth customer's has no schedule of payments, every fifth no percentage in words."""
    o = spread(read(spark, sf_dir, "customer", "c_custkey", "c_nationkey"), "c_custkey")
    k, c = F.col("c_custkey"), F.col("c_nationkey")
    day = F.transform(F.sequence(F.lit(0), 3 + (k % 3).cast("int")), lambda i: F.last_day(F.add_months(F.lit("2020-03-31"), 3 * i)))
    rows = F.array_join(F.transform(day, lambda d: F.concat(F.lit("<tr><td>"), F.date_format(d, "MMMM d, yyyy"), F.lit("</td><td>$"), F.format_number((c + 1) * 1000, 0), F.lit("</td></tr>"))), "")
    schedule = F.when(k % 4 == 0, "").otherwise(text("<table><tr><td>Payment Date</td><td>Principal Payment</td></tr>", rows, "</table>"))
    words = F.when(k % 5 == 0, "It is due. ").otherwise("It is fifty percent (50%) of costs. ")
    html = text(
        "<p>CREDIT AGREEMENT</p><p>Section 1.01 Definitions. “Base Fee” means ", (c % 7 + 1).cast("string"), "% of it. See what is said in Section 2.01 and on Schedule 1.1 and Schedule 2.2.</p><p>Section 2.01 Loans. ", words, "</p>", schedule,
        "<table><tr><td>Level</td><td>Band</td><td>Rate</td></tr><tr><td>I</td><td>over 5.50</td><td>4.00%</td></tr><tr><td>II</td><td>others</td><td>3.00%</td></tr></table><p>SCHEDULE 1.1</p><p>List</p><p>SCHEDULE 2.2</p><p>List of ", k.cast("string"), "</p>",
    )
    return o.select(k.alias("doc_id"), html.alias("html"))


#: Name, kind, check, and what a document must have.
SHAPES = """m(mutation, kind, expected, needs) AS (VALUES ('duplicate_table_row', 'injection', 'amortization_dates_strictly_increasing', 4), ('drop_table_row', 'injection', 'amortization_dates_evenly_spaced', 4), ('break_cross_reference', 'injection', 'cross_references_resolve', 0), ('numeral_word_mismatch', 'injection', 'numeral_and_words_agree', 5),
  ('doubly_defined_term', 'injection', 'defined_terms_are_unique', 0), ('referenced_schedule_absent', 'injection', 'referenced_schedules_present', 0), ('bps_instead_of_percent', 'invariance', NULL, 0), ('thousands_scale', 'invariance', NULL, 4), ('nested_html_tables', 'invariance', NULL, 4), ('grid_rendered_as_text', 'invariance', NULL, 0), ('table_split_across_pages', 'invariance', NULL, 4)),
d AS (SELECT c_custkey AS doc_id, c_nationkey, mutation, kind, expected FROM customer, m WHERE needs = 0 OR c_custkey % needs <> 0)"""


@query(f"WITH {SHAPES} SELECT doc_id, mutation, kind, kind = 'injection' AS found FROM d")
def mutation_findings(spark, sf_dir):
    """Whether the checks, run over the rewritten documents, find what was planted; where only the form changed, whether they find anything."""
    changed = durable(M.mutated(pages(spark, sf_dir)))
    key = F.concat_ws("/", F.col("doc_id").cast("string"), "mutation")
    read_ = durable(files.parsed(changed.select(key.alias("doc_id"), "html"), "doc_id", "html", parts=("text", "cells")))
    seen = V.violations(read_).select("doc_id", F.col("check")).distinct()
    j = changed.select("doc_id", "mutation", "kind", "expected", key.alias("key")).join(seen.withColumnRenamed("doc_id", "key"), "key", "left")
    hit = F.bool_or(F.coalesce(F.when(F.col("expected").isNull(), F.col("check").isNotNull()).otherwise(F.col("check") == F.col("expected")), F.lit(False)))
    return j.groupBy("doc_id", "mutation", "kind").agg(hit.alias("found"))


@query(f"WITH {SHAPES} SELECT doc_id, mutation, v.name, CASE WHEN v.name = 'fee' AND mutation IN ('bps_instead_of_percent') THEN TRUE ELSE FALSE END AS touched, CASE WHEN v.name = 'fee' AND mutation = 'bps_instead_of_percent' THEN NULL WHEN v.name = 'fee' THEN concat(c_nationkey % 7 + 1, '%') ELSE concat('List of ', doc_id) END AS quoted FROM d, (VALUES ('fee'), ('list')) v(name)")
def mutation_labels(spark, sf_dir):
    """Labels after the edits still stand at what they stood at, unless an edit touched them."""
    d = pages(spark, sf_dir)
    found = [("fee", F.regexp_extract("html", "means ([0-9]+%)", 1)), ("list", F.regexp_extract("html", "(List of [0-9]+)", 1))]
    label = F.explode(F.array(*(F.struct(F.lit(n).alias("name"), x.alias("said")) for n, x in found)))
    labels = d.select("doc_id", "html", label.alias("l")).select("doc_id", "l.name", (F.call_function("locate", F.col("l.said"), F.col("html")) - 1).cast("long").alias("start"), F.length("l.said").alias("n")).select("doc_id", "name", "start", (F.col("start") + F.col("n")).alias("end"))
    changed = durable(M.mutated(d))
    moved = M.moved_labels(labels, changed).join(changed.select("doc_id", "mutation", "html"), ["doc_id", "mutation"])
    return moved.select("doc_id", "mutation", "name", "touched", F.expr("substring(html, int(start) + 1, int(end - start))").alias("quoted"))
