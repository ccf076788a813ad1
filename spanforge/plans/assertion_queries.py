"""Assertions, gold values, class thresholds, splits and segments over orders, labels, documents and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanforge.operators import assertions as A
from spanforge.operators import evaluate as E
from spanforge.operators import segments as G
from spanforge.plans.base import dealt, query, read

KINDS = ["field_value", "field_status", "tranche_value", "invariant_fired", "report_count", "field_unit", "trap_caught"]
STATUS = "CASE o_orderstatus WHEN 'F' THEN 'confirmed' WHEN 'O' THEN 'needs_review' ELSE 'external_reference' END"


def asked(spark, sf_dir):
    """One assertion of each order, of a kind that goes by its number."""
    c = F.col("o_custkey")
    figure = F.concat(F.lit("$"), c.cast("string"), F.lit(".50"), F.element_at(F.array(F.lit("0"), F.lit("4"), F.lit("8")), (c % 3 + 1).cast("int")))
    one = lambda kind, target, expect, tranche=None, most=False: F.struct(F.lit(kind).alias("kind"), F.lit(target).alias("target"), F.lit(tranche).cast("string").alias("tranche"), expect.alias("expect"), F.lit(most).alias("at_most"))
    kinds = F.array(
        one("field_value", "total", F.when(c % 2 == 0, F.array(F.lit("1.25%"), figure)).otherwise(F.array(figure))), one("field_status", "total", F.array(F.lit("Confirmed"))), one("tranche_value", "margin", F.array(F.lit("f")), "R"),
        one("invariant_fired", "urgent", F.array((c % 2 == 0).cast("string"))), one("report_count", "lines", F.array(F.lit("3")), most=True), one("field_unit", "none", F.array(F.lit(None).cast("string"))), one("trap_caught", "open", F.array((c % 2 == 0).cast("string"))),
    )
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_orderkey").alias("assertion"), F.col("o_orderpriority").alias("family"), F.element_at(kinds, (F.col("o_orderkey") % len(KINDS) + 1).cast("int")).alias("k"))
    return o.select("doc_id", "assertion", "family", "k.*")


def known(spark, sf_dir, tasks):
    """Facts of orders: a field, the lines of each return flag as tranches, their number, what is urgent and what is open.

    Orders and lines are dealt by document before they are sorted and grouped: a sort of a piece of a file holds as many rows as the piece."""
    o, li = read(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "doc_id"), read(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "doc_id").repartition(tasks, "doc_id")
    status = F.when(F.col("o_orderstatus") == "F", "confirmed").when(F.col("o_orderstatus") == "O", "needs_review").otherwise("external_reference")
    none = F.lit(None).cast("string")
    fields = o.select("doc_id", F.lit("total").alias("field"), F.concat(F.col("o_custkey").cast("string"), F.lit(".5")).alias("value"), status.alias("status"), none.alias("external_kind"), F.lit("USD").alias("unit"))
    lines = li.select("doc_id", F.lit("margin").alias("field"), F.col("l_returnflag").alias("tranche"), F.col("l_linestatus").alias("value"), F.when(F.col("l_linenumber") < 3, "confirmed").otherwise("conflict").alias("status"), F.col("l_linenumber").alias("ix"))
    counts = li.groupBy("doc_id").agg(F.lit("lines").alias("name"), F.count("*").alias("n"))
    urgent = o.where("o_orderpriority = '1-URGENT'").repartition(tasks, "doc_id").withColumn("name", F.lit("urgent"))
    traps = o.repartition(tasks, "doc_id").withColumn("name", F.lit("open"))
    parts = [A.field_facts(fields), A.tranche_facts(lines), A.named_facts(counts, "report_count", F.col("n")), A.named_facts(urgent, "invariant_fired", F.lit("true")), A.named_facts(traps, "trap_caught", F.col("o_orderstatus") == "O")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(f"""WITH t AS (SELECT l_orderkey AS doc_id, arg_min(l_linestatus, (l_linenumber, l_linestatus)) AS v, min(l_linenumber) AS line FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1), n AS (SELECT l_orderkey AS doc_id, count(*) AS n FROM lineitem GROUP BY 1),
o AS (SELECT o_orderkey AS doc_id, o_orderpriority AS family, o_custkey AS c, o_orderstatus AS s, {STATUS} AS status, {KINDS}[CAST(o_orderkey % {len(KINDS)} + 1 AS INT)] AS kind FROM orders)
SELECT o.doc_id, o.doc_id AS assertion, family, kind,
  CASE kind WHEN 'field_value' THEN c % 3 < 2 OR (c % 2 = 0 AND c + 0.5 BETWEEN 1.245 AND 1.255) WHEN 'field_status' THEN status = 'confirmed' WHEN 'tranche_value' THEN coalesce(v = 'F', false)
    WHEN 'invariant_fired' THEN (family = '1-URGENT') = (c % 2 = 0) WHEN 'report_count' THEN coalesce(n <= 3, false) WHEN 'field_unit' THEN false ELSE (s = 'O') = (c % 2 = 0) END AS passed,
  CASE kind WHEN 'field_value' THEN status <> 'needs_review' WHEN 'field_status' THEN status <> 'needs_review' WHEN 'tranche_value' THEN coalesce(line < 3, false) WHEN 'report_count' THEN false WHEN 'field_unit' THEN false ELSE true END AS confident
FROM o LEFT JOIN t USING (doc_id) LEFT JOIN n USING (doc_id)""")
def assertion_outcomes(spark, sf_dir):
    tasks = dealt(read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem"))
    return A.evaluate(asked(spark, sf_dir), known(spark, sf_dir, tasks), tasks)


@query("""SELECT doc_id, doc_id AS assertion, lang AS family, CASE WHEN doc_id % 2 = 0 THEN 'text_present' ELSE 'orphan_found' END AS kind,
  CASE WHEN doc_id % 2 = 0 THEN (strpos(coalesce(text, ''), 'the') > 0) = (doc_id % 4 = 0) ELSE strpos(coalesce(text, ''), 'ing ') > 0 END AS passed, true AS confident FROM documents WHERE lang IS NOT NULL""")
def text_assertions(spark, sf_dir):
    d = read(spark, sf_dir, "documents", "doc_id", "lang", "text").where("lang is not null")
    even = F.col("doc_id") % 2 == 0
    expect = F.array(F.when(even, (F.col("doc_id") % 4 == 0).cast("string")).otherwise("ing "))
    labels = d.select("doc_id", F.col("doc_id").alias("assertion"), F.col("lang").alias("family"), F.when(even, "text_present").otherwise("orphan_found").alias("kind"), F.when(even, "the").alias("target"), expect.alias("expect"))
    return A.evaluate_texts(labels, d)


@query("""WITH c AS (SELECT l_orderkey AS doc_id, list(concat('Term ', l_suppkey % 4)) AS modes FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1)
SELECT o_orderkey AS doc_id, o_orderkey AS assertion, o_orderpriority AS family, 'closure_contains' AS kind, modes IS NOT NULL AND list_contains(modes, 'Term 1') AND (o_orderkey % 2 = 0 OR list_contains(modes, 'Term 2')) AS passed, modes IS NOT NULL AS confident
FROM orders LEFT JOIN c ON doc_id = o_orderkey""")
def closure_assertions(spark, sf_dir):
    labels = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_orderkey").alias("assertion"), F.col("o_orderpriority").alias("family"), F.lit("closure_contains").alias("kind"), F.lit("N").alias("target"), F.when(F.col("o_orderkey") % 2 == 0, F.array(F.lit("term 1"))).otherwise(F.array(F.lit("TERM 1"), F.lit("Term 2"))).alias("expect"))
    return A.evaluate_closures(labels, read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_returnflag").alias("term"), F.concat(F.lit("Term "), (F.col("l_suppkey") % 4).cast("string")).alias("reached")))


GOLD = """j AS (SELECT doc_id, quality = 1 AS good, n_chars, CASE WHEN doc_id % 4 = 1 THEN NULL ELSE n_chars + CASE WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END END AS value, ['confirmed', 'absent_from_document', 'external_reference', 'needs_review'][CAST(doc_id % 4 + 1 AS INT)] AS status, doc_id % 3 AS src, doc_id % 5 = 0 AS by_status FROM labels JOIN documents USING (doc_id)),
c AS (SELECT *, CASE WHEN by_status THEN status = 'external_reference' WHEN NOT good THEN value IS NULL AND status IN ('absent_from_document', 'external_reference') ELSE coalesce(value = n_chars, false) END AS correct FROM j)"""


@query(f"WITH {GOLD} SELECT doc_id, 'chars' AS field, status, correct, CASE src WHEN 1 THEN NOT good WHEN 2 THEN by_status ELSE correct END AS claim_correct FROM c")
def gold_scores(spark, sf_dir):
    k = F.col("doc_id")
    d = read(spark, sf_dir, "documents", "doc_id", "n_chars")
    shown = F.when(k % 4 != 1, (F.col("n_chars") + F.when(k % 7 == 0, 1).otherwise(0)).cast("string"))
    status = F.element_at(F.array(*map(F.lit, ["confirmed", "absent_from_document", "external_reference", "needs_review"])), (k % 4 + 1).cast("int"))
    source = F.element_at(F.array(*map(F.lit, ["A_span_support", "C_negative_space", "E_external_dependency"])), (k % 3 + 1).cast("int"))
    fields = d.select(k, F.lit("chars").alias("field"), shown.alias("value"), status.alias("status"), source.alias("source"))
    labels = read(spark, sf_dir, "labels").join(d, "doc_id").select(k, F.lit("chars").alias("field"), F.lit("int").alias("kind"), F.when(F.col("quality") == 1, F.concat(F.col("n_chars").cast("string"), F.lit(".0"))).alias("expected"), F.when(k % 5 == 0, "external_reference").alias("wanted_status"))
    return A.gold_score(fields, labels)


LOWER = "CASE WHEN {n} = 0 OR {k} = 0 THEN 0 ELSE greatest(0, ({k} / {n} + 3.8416 / (2 * {n}) - 1.96 * sqrt({k} / {n} * (1 - {k} / {n}) / {n} + 3.8416 / (4 * {n} * {n}))) / (1 + 3.8416 / {n})) END"
TARGET = 0.7
CLASSES = f"""WITH s AS (SELECT lang AS field_class, CAST(round((n_chars * 7 + quality * 400) % 1000 / 1000.0, 4) AS DECIMAL(6,4)) AS t, ['labelled', 'labelled', 'labelled', 'off_text', 'in_text'][CAST(doc_id % 5 + 1 AS INT)] AS kind, doc_id % 5 < 3 AND quality = 1 AS correct FROM labels JOIN documents USING (doc_id) WHERE lang IS NOT NULL),
f(fit, kind) AS (VALUES ('labelled', 'labelled'), ('off_text', 'labelled'), ('off_text', 'off_text'), ('in_text', 'labelled'), ('in_text', 'off_text'), ('in_text', 'in_text')),
b AS (SELECT field_class, fit, t, count(*) AS c, count(*) FILTER (WHERE correct) AS kk FROM s JOIN f USING (kind) GROUP BY ALL),
r AS (SELECT field_class, fit, t, CAST(sum(c) OVER w AS DOUBLE) AS n, CAST(sum(kk) OVER w AS DOUBLE) AS k FROM b WINDOW w AS (PARTITION BY field_class, fit ORDER BY t DESC ROWS UNBOUNDED PRECEDING)),
x AS (SELECT field_class, fit, t, CAST({LOWER.format(n='n', k='k')} AS DECIMAL(12,8)) AS bound FROM r),
z AS (SELECT field_class, fit, CAST(coalesce(min(t) FILTER (WHERE bound >= {TARGET}), CASE WHEN max(bound) = 0 THEN 1.0001 ELSE arg_max(t, (bound, t)) END) AS DECIMAL(6,4)) AS t FROM x GROUP BY ALL),
y AS (SELECT field_class, fit, CASE WHEN bool_and(kk = c) THEN greatest(any_value(z.t), 0.8) ELSE any_value(z.t) END AS t FROM z JOIN b USING (field_class, fit) GROUP BY ALL),
g AS (SELECT field_class, t, count(*) FILTER (WHERE kind = 'labelled' AND correct) AS rr, count(*) FILTER (WHERE kind = 'in_text' OR (kind = 'labelled' AND NOT correct)) AS ww, count(*) FILTER (WHERE kind = 'labelled' AND NOT correct) AS lw, count(*) FILTER (WHERE kind = 'labelled') AS l, count(*) FILTER (WHERE kind = 'off_text') AS o FROM s GROUP BY ALL),
h AS (SELECT field_class, t, rr + ww AS here, sum(rr) OVER d / sum(rr) OVER p AS qr, sum(ww) OVER d / sum(ww) OVER p AS qw, max(t) FILTER (WHERE o > 0) OVER p AS fl, CAST(sum(l) OVER p AS DOUBLE) AS ln, CAST(sum(l) OVER p - sum(lw) OVER p AS DOUBLE) AS lr FROM g WINDOW p AS (PARTITION BY field_class), d AS (PARTITION BY field_class ORDER BY t DESC ROWS UNBOUNDED PRECEDING)),
e AS (SELECT *, CASE WHEN ln = 0 THEN 1 ELSE 1 - ({LOWER.format(n='ln', k='lr')}) END AS rate FROM h),
v AS (SELECT field_class, min(t) FILTER (WHERE here > 0 AND t > coalesce(fl, -1) AND qr > 0 AND (1 - rate) * qr / ((1 - rate) * qr + rate * qw) + 1e-9 >= {TARGET}) AS weighted FROM e GROUP BY 1)"""


def class_samples(spark, sf_dir):
    j = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents", "doc_id", "lang", "n_chars").where("lang is not null"), "doc_id")
    kind = F.element_at(F.array(*map(F.lit, ["labelled", "labelled", "labelled", "off_text", "in_text"])), (F.col("doc_id") % 5 + 1).cast("int"))
    return j.select(F.col("lang").alias("field_class"), ((F.col("n_chars") * 7 + F.col("quality") * 400) % 1000 / 1000).alias("p"), kind.alias("kind"), ((F.col("doc_id") % 5 < 3) & (F.col("quality") == 1)).alias("correct"))


@query(CLASSES + " SELECT field_class, weighted FROM v")
def weighted_thresholds(spark, sf_dir):
    return E.weighted(class_samples(spark, sf_dir), ["field_class"], TARGET)


@query(CLASSES + " SELECT field_class, count(*) = 3 AND min(t) = max(t) AS agreed, CAST(CASE WHEN count(*) < 3 THEN NULL WHEN min(t) = max(t) THEN min(t) ELSE any_value(weighted) END AS DECIMAL(6,4)) AS adopted FROM y JOIN v USING (field_class) GROUP BY 1")
def class_thresholds(spark, sf_dir):
    return E.fit_classes(class_samples(spark, sf_dir), ["field_class"], TARGET)


@query("""WITH r AS (SELECT doc_id, source, doc_id % 4 = 0 AS bad, count(*) OVER (PARTITION BY source) AS n, count(*) FILTER (WHERE doc_id % 4 > 0) OVER (PARTITION BY source) AS e,
  row_number() OVER (PARTITION BY source ORDER BY doc_id % 4 = 0, sha256(CAST(doc_id AS VARCHAR)), CAST(doc_id AS VARCHAR)) AS r FROM documents)
SELECT doc_id, source, CASE WHEN NOT bad AND n >= 2 AND r <= greatest(1, e // 3) THEN 'holdout' ELSE 'fit' END AS side FROM r""")
def split_contaminated(spark, sf_dir):
    d = read(spark, sf_dir, "documents", "doc_id", "source").withColumn("name", F.col("doc_id").cast("string"))
    return E.holdout(d, "source", "name", contaminated=F.col("doc_id") % 4 == 0).select("doc_id", "source", "side")


@query("""WITH r AS (SELECT o_custkey AS doc_id, o_orderkey, row_number() OVER w + CASE WHEN o_orderkey % 5 = 0 THEN 7 ELSE 0 END AS page, concat(chr(10), ' ', row_number() OVER w + CASE WHEN o_orderkey % 5 = 0 THEN 7 ELSE 0 END, chr(10)) AS mark, o_orderpriority AS body FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
s AS (SELECT doc_id, page, coalesce(sum(length(mark) + length(body)) OVER (PARTITION BY doc_id ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start, lag(page) OVER (PARTITION BY doc_id ORDER BY o_orderkey) AS before FROM r),
g AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM s WHERE before IS NULL OR page = before + 1)
SELECT doc_id, CAST(start AS BIGINT) AS start, CAST(page AS INT) AS page FROM g WHERE n >= greatest(3, doc_id % 20 // 2) UNION ALL SELECT DISTINCT doc_id, 0, 1 FROM g WHERE n >= greatest(3, doc_id % 20 // 2)""")
def page_marks(spark, sf_dir):
    """Texts of a customer's orders with numbers between them, some of which don't follow."""
    o = read(spark, sf_dir, "orders", "o_custkey", "o_orderkey", "o_orderpriority").groupBy(F.col("o_custkey").alias("doc_id")).agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))).alias("all"))
    number = lambda x, i: (i + 1 + F.when(x["o_orderkey"] % 5 == 0, 7).otherwise(0)).cast("string")
    text = F.array_join(F.transform("all", lambda x, i: F.concat(F.lit("\n "), number(x, i), F.lit("\n"), x["o_orderpriority"])), "")
    return G.page_marks(o.select("doc_id", text.alias("text"), F.expr("doc_id % 20").alias("breaks")), ["doc_id"], breaks="breaks")


@query(r"""WITH RECURSIVE d AS (SELECT doc_id, replace(text, ' the ', chr(10) || chr(10)) AS text FROM documents WHERE text IS NOT NULL),
c AS (SELECT doc_id, text, 0 AS part, CAST(0 AS BIGINT) AS start, CAST(0 AS BIGINT) AS stop FROM d UNION ALL
  SELECT doc_id, text, part + 1, stop, CASE WHEN stop + 400 < length(text) AND strpos(reverse(substr(text, stop + 201, 200)), chr(10) || chr(10)) > 0 THEN stop + 399 - strpos(reverse(substr(text, stop + 201, 200)), chr(10) || chr(10)) ELSE least(stop + 400, length(text)) END FROM c WHERE stop < length(text))
SELECT doc_id, part, start, stop AS "end" FROM c WHERE part > 0""")
def paragraph_chunks(spark, sf_dir):
    d = read(spark, sf_dir, "documents", "doc_id", "text").where("text is not null")
    return G.paragraphs(d.withColumn("text", F.replace("text", F.lit(" the "), F.lit("\n\n"))), ["doc_id"], 400)


@query("""SELECT p_partkey, p_size % 5 IN (0, 1, 3) AS reserved FROM part""")
def reserved_sections(spark, sf_dir):
    k = F.col("p_size") % 5
    title = F.when(k == 0, "[Reserved]").when(k == 1, " Intentionally  omitted.").when(k == 2, F.concat(F.lit("Powers that are reserved to "), F.col("p_name")))
    after = F.when(k == 3, F.concat(F.lit("\n\n [ RESERVED ] "), F.col("p_name"))).when(k == 4, F.concat(F.rpad(F.lit("\n"), 61, " "), F.lit("[Reserved]"))).otherwise("The Borrower")
    return read(spark, sf_dir, "part").select("p_partkey", G.reserved(title, after).alias("reserved"))


@query("SELECT p_partkey, p_size % 6 IN (0, 2, 3, 5) AS statute FROM part")
def statute_citations(spark, sf_dir):
    """Sections of the Code and of regulations, beside the agreement's own."""
    k, name = F.col("p_size") % 6, F.col("p_name")
    before = F.when(k == 0, F.concat(name, F.lit(" as defined in the Treasury Regulations, "))).when(k == 1, F.concat(F.lit("the Code applies. "), name)).when(k == 2, F.lit("within 29 u.s.c. ")).otherwise(name)
    after = F.when(k == 3, " of the Bankruptcy Code").when(k == 4, " of this Agreement").when(k == 5, "-1(b) of it").otherwise(" and")
    return read(spark, sf_dir, "part").select("p_partkey", G.cites_statute(before, after).alias("statute"))


CALENDARS = """t AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN concat('a 52/53-week fiscal year ending on the ', dayname(o_orderdate), CASE WHEN o_custkey % 2 = 0 THEN ' nearest to the end of ' ELSE ' last day of ' END, monthname(o_orderdate)) WHEN 1 THEN concat('its fiscal  year ends on ', monthname(o_orderdate), ' ', CASE WHEN o_custkey % 3 = 0 THEN 31 ELSE day(o_orderdate) END) WHEN 2 THEN concat('closes on the ', dayname(o_orderdate), ' nearest to ', monthname(o_orderdate)) ELSE 'no year is named' END AS text FROM orders)"""
NAMES = "['january','february','march','april','may','june','july','august','september','october','november','december']"
DAYS = "['monday','tuesday','wednesday','thursday','friday','saturday','sunday']"


@query(f"""WITH {CALENDARS}, p AS (SELECT o_orderkey, text, regexp_extract(text, '([A-Z][a-z]+day) (nearest to|last day of) (?:the end of )?([A-Z][a-z]+)', ['w', 'c', 'm']) AS a, regexp_extract(text, 'year ends on ([A-Z][a-z]+) ([0-9]+)', ['m', 'd']) AS e, regexp_extract(text, '[A-Z].*') AS anchor, starts_with(text, 'a 52') AND regexp_matches(text, 'day (nearest to|last day of)') AS weeks FROM t),
q AS (SELECT *, list_position({NAMES}, lower(CASE WHEN weeks THEN a['m'] ELSE e['m'] END)) AS mo FROM p)
SELECT o_orderkey, CAST(coalesce(mo, 12) AS INT) AS month, CAST(CASE WHEN weeks OR mo IS NULL THEN 31 ELSE least(TRY_CAST(e['d'] AS INT), day(last_day(make_date(2024, mo, 1)))) END AS INT) AS day, CASE WHEN weeks THEN CAST(list_position({DAYS}, lower(a['w'])) - 1 AS INT) END AS weekday,
  CASE WHEN weeks THEN CASE WHEN a['c'] = 'nearest to' THEN 'weekday_nearest_month_end' ELSE 'last_weekday_of_month' END END AS convention, CASE WHEN weeks THEN concat('detected: ', anchor) WHEN mo IS NOT NULL THEN concat('detected: fiscal year ends on ', anchor) ELSE 'default (document is silent)' END AS source FROM q""")
def fiscal_calendars(spark, sf_dir):
    k, c, d = F.col("o_orderkey") % 4, F.col("o_custkey"), F.col("o_orderdate")
    day, month = F.date_format(d, "EEEE"), F.date_format(d, "MMMM")
    weeks = F.concat(F.lit("a 52/53-week fiscal year ending on the "), day, F.when(c % 2 == 0, " nearest to the end of ").otherwise(" last day of "), month)
    ends = F.concat(F.lit("its fiscal  year ends on "), month, F.lit(" "), F.when(c % 3 == 0, 31).otherwise(F.dayofmonth(d)).cast("string"))
    text = F.when(k == 0, weeks).when(k == 1, ends).when(k == 2, F.concat(F.lit("closes on the "), day, F.lit(" nearest to "), month)).otherwise("no year is named")
    return read(spark, sf_dir, "orders").select("o_orderkey", G.fiscal_calendar(text).alias("c")).select("o_orderkey", "c.*")
