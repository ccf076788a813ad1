"""Outlines and operative texts: agreements written from orders, with contents lists, citations, nested clauses and amendments of many forms."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.operators import operative as O
from spanforge.operators import outline as L
from spanforge.plans.base import query, read, spread
from spanforge.session import durable

# -- an agreement an order: a section for each line, an article for three, contents at the front
LINES = """lines AS (SELECT l_orderkey AS doc_id, l_returnflag, l_partkey % 5 AS form, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS n FROM lineitem),
named AS (SELECT *, (n - 1) // 3 + 1 AS a, concat((n - 1) // 3 + 1, '.', lpad(CAST(n AS VARCHAR), 2, '0')) AS id, concat('Carriage by ', l_returnflag) AS title FROM lines),
written AS (SELECT *, CASE WHEN n % 3 = 1 THEN concat('ARTICLE ', list_extract(['I','II','III','IV','V','VI','VII','VIII','IX','X'], a), chr(10), 'PART ', a, chr(10), chr(10)) ELSE '' END AS head,
  CASE WHEN form = 3 THEN concat('Section ', id, ' [Reserved]', chr(10), chr(10)) ELSE concat(CASE form WHEN 0 THEN 'Section ' WHEN 1 THEN 'SECTION ' WHEN 4 THEN 'Section ' ELSE '' END, id, CASE WHEN form IN (1, 4) THEN '.' ELSE '' END, ' ', title,
    '. As stated in', chr(10), 'Section 1.01 Terms Govern, (a) the buyer pays (i) at once or (ii) late, and (b) clause (a) holds.', chr(10), chr(10)) END AS body,
  concat('Section ', id, ' ', title, ' ..... ', n, chr(10)) AS entry FROM named),
front AS (SELECT doc_id, length(concat('TABLE OF CONTENTS', chr(10), chr(10), string_agg(entry, ''), chr(10))) AS n0 FROM written GROUP BY doc_id),
placed AS (SELECT w.*, n0 + coalesce(sum(length(head) + length(body)) OVER (PARTITION BY w.doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM written w JOIN front f ON w.doc_id = f.doc_id)"""


def agreements(spark, sf_dir):
    li = spread(read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"), "l_orderkey")
    n = F.row_number().over(W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"))
    a = F.floor((F.col("n") - 1) / 3) + 1
    word = F.element_at(F.array(*map(F.lit, ["Section ", "SECTION ", "", "Section ", "Section "])), (F.col("l_partkey") % 5 + 1).cast("int"))
    stop = F.when((F.col("l_partkey") % 5).isin(1, 4), ".").otherwise("")
    title = F.concat(F.lit("Carriage by "), F.col("l_returnflag"))
    said = F.lit(". As stated in\nSection 1.01 Terms Govern, (a) the buyer pays (i) at once or (ii) late, and (b) clause (a) holds.\n\n")
    head = F.when(F.col("n") % 3 == 1, F.concat(F.lit("ARTICLE "), F.element_at(F.array(*map(F.lit, ["I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X"])), F.col("a").cast("int")), F.lit("\nPART "), F.col("a").cast("string"), F.lit("\n\n"))).otherwise("")
    body = F.when(F.col("l_partkey") % 5 == 3, F.concat(F.lit("Section "), F.col("id"), F.lit(" [Reserved]\n\n"))).otherwise(F.concat(word, F.col("id"), stop, F.lit(" "), title, said))
    rows = li.withColumn("n", n).withColumn("a", a).withColumn("id", F.concat(F.col("a").cast("string"), F.lit("."), F.lpad(F.col("n").cast("string"), 2, "0")))
    rows = rows.select("l_orderkey", "n", F.concat(head, body).alias("part"), F.concat(F.lit("Section "), F.col("id"), F.lit(" "), title, F.lit(" ..... "), F.col("n").cast("string"), F.lit("\n")).alias("entry"))
    own = rows.groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.sort_array(F.collect_list(F.struct("n", "part", "entry"))).alias("rows"))
    joined = lambda c: F.array_join(F.transform("rows", lambda r: r[c]), "")
    return own.select("doc_id", F.concat(F.lit("TABLE OF CONTENTS\n\n"), joined("entry"), F.lit("\n"), joined("part")).alias("text"))


@query(f"""WITH {LINES}, all_ AS (
  SELECT doc_id, start, 'article' AS level, concat('ARTICLE ', list_extract(['I','II','III','IV','V','VI','VII','VIII','IX','X'], a)) AS id, concat('PART ', a) AS title, CAST(NULL AS VARCHAR) AS parent, FALSE AS reserved, start + length(head) AS stop FROM placed WHERE head <> ''
  UNION ALL SELECT doc_id, start + length(head), 'section', id, CASE WHEN form = 3 THEN '[Reserved]' ELSE title END, concat('ARTICLE ', list_extract(['I','II','III','IV','V','VI','VII','VIII','IX','X'], a)), form = 3, start + length(head) + length(body) FROM placed)
SELECT doc_id, CAST(start AS BIGINT) AS start, CAST(stop AS BIGINT) AS "end", level, id AS section, title, parent, reserved FROM all_""")
def section_outline(spark, sf_dir):
    """Articles and sections in five forms of heading, contents and citations at line starts left out."""
    return L.headings(agreements(spark, sf_dir), ["doc_id"]).select("doc_id", "start", "end", "level", "section", "title", "parent", "reserved")


@query(f"""WITH {LINES} SELECT doc_id, id AS section, p.path, CAST(start + length(head) + strpos(body, p.mark) - 1 AS BIGINT) AS start FROM placed, (VALUES ('(a)', '(a) the'), ('(a)(i)', '(i) at'), ('(a)(ii)', '(ii) late'), ('(b)', '(b) clause')) p(path, mark) WHERE form <> 3""")
def nested_clauses(spark, sf_dir):
    """Clauses within sections by their path; `clause (a)` is a citation."""
    return L.nested(agreements(spark, sf_dir), ["doc_id"]).select("doc_id", "section", "path", "start")


# -- a set a customer: the first order is the base, every later one amends it in one of six ways
BASE = (
    "CREDIT AGREEMENT\n\n", "Section 1.01 Terms.\n“Floor” means 0.00%.\n“Rate” means a rate.\n\n", "Section 2.01 Interest. The rate 1 applies.\n\n", "Section 2.02 Fees. A fee is due.\n\n",
    "Section 2.03 Covenants. Pay.\n\n", "Section 2.04 Grid.\nLevel | Rate\nI | 1.00%\nDone.\n\n", "Section 2.05 Notices. Write.\n",
)
FORMS = [
    "The definition of “Floor” set forth in Section 1.01 of the Credit Agreement is hereby amended and restated in its entirety as follows:\n\n“Floor” means {n}.00%.",
    "Section 2.01 of the Credit Agreement is hereby amended by deleting the words “rate {p}” and inserting in lieu thereof the words “rate {n}”.",
    "Section 2.02 is hereby amended and restated in its entirety to read as follows: “Fees. A fee of ${n} is due.”",
    "Section 2.03 of the Agreement is hereby amended by adding the following sentence at the end thereof: “Item {n} too.”",
    "The table set forth in Section 2.04 of the Credit Agreement is hereby deleted in its entirety and replaced with the following:\n\nLevel | Rate\nI | {n}.00%",
    "Section 7.07 is hereby amended by deleting “x{n}”.",
]


def sets(spark, sf_dir):
    o = read(spark, sf_dir, "orders", "o_custkey", "o_orderkey").withColumn("n", F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey")))
    n, p = F.col("n").cast("string"), (F.col("n") - 6).cast("string")
    forms = F.array(*(F.replace(F.replace(F.lit(f), F.lit("{n}"), n), F.lit("{p}"), p) for f in FORMS))
    change = F.concat(F.lit("AMENDMENT NO. "), (F.col("n") - 1).cast("string"), F.lit("\n\n(a) "), F.element_at(forms, (F.col("n") % 6 + 1).cast("int")))
    return o.select(F.col("o_custkey").cast("string").alias("set_id"), F.col("n").alias("ord"), F.lpad(n, 9, "0").alias("doc_id"), F.when(F.col("n") == 1, "base").otherwise("amendment").alias("role"), F.when(F.col("n") == 1, F.lit("".join(BASE))).otherwise(change).alias("text"), F.lit(False).alias("marked"))


SETS = """o AS (SELECT CAST(o_custkey AS VARCHAR) AS set_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders),
m AS (SELECT set_id, max(n) FILTER (WHERE n % 6 = 0) AS f0, max(n) FILTER (WHERE n % 6 = 1) AS f1, max(n) FILTER (WHERE n % 6 = 2) AS f2, max(n) FILTER (WHERE n % 6 = 4) AS f4, coalesce(string_agg(concat(' Item ', n, ' too.'), '' ORDER BY n) FILTER (WHERE n % 6 = 3), '') AS added FROM o GROUP BY set_id)"""


@query(f"""WITH {SETS} SELECT set_id, concat('CREDIT AGREEMENT', chr(10), chr(10), 'Section 1.01 Terms.', chr(10), '“Floor” means ', coalesce(f0, 0), '.00%.', chr(10), '“Rate” means a rate.', chr(10), chr(10), 'Section 2.01 Interest. The rate ', f1, ' applies.', chr(10), chr(10),
  CASE WHEN f2 IS NULL THEN 'Section 2.02 Fees. A fee is due.' ELSE concat('SECTION 2.02 Fees. A fee of $', f2, ' is due.') END, chr(10), chr(10), 'Section 2.03 Covenants. Pay.', added, chr(10), chr(10),
  'Section 2.04 Grid.', chr(10), 'Level | Rate', chr(10), 'I | ', coalesce(f4, 1), '.00%', chr(10), 'Done.', chr(10), chr(10), 'Section 2.05 Notices. Write.', chr(10)) AS text FROM m""")
def operative_documents(spark, sf_dir):
    """Whole texts after definitions, words, sections, sentences and tables were changed."""
    return O.texts(O.pieces(O.fold(sets(spark, sf_dir))))


@query(f"""WITH {SETS}, d AS (SELECT *, lpad(CAST(n AS VARCHAR), 9, '0') AS doc_id FROM o WHERE n > 1)
SELECT set_id, doc_id, CASE n % 6 WHEN 0 THEN 'restate' WHEN 1 THEN 'replace' WHEN 2 THEN 'restate' WHEN 3 THEN 'insert' WHEN 4 THEN 'restate' ELSE 'delete' END AS kind, CASE n % 6 WHEN 0 THEN '1.01' WHEN 1 THEN '2.01' WHEN 2 THEN '2.02' WHEN 3 THEN '2.03' WHEN 4 THEN '2.04' ELSE '7.07' END AS target,
  CASE WHEN n % 6 = 5 THEN 'Section 7.07 is not there' END AS reason FROM d""")
def amendment_changes(spark, sf_dir):
    """Every change that amendments state, and the reason of those that were not made."""
    return O.changes(O.fold(sets(spark, sf_dir))).select("set_id", "doc_id", "kind", "target", "reason")


@query(f"""WITH {SETS}, base AS (SELECT set_id, '000000001' AS doc_id, * EXCLUDE set_id FROM m),
s AS (SELECT set_id, '2.01' AS section, CASE WHEN f1 > 1 THEN lpad(CAST(f1 AS VARCHAR), 9, '0') ELSE doc_id END AS doc_id, length(concat('rate ', f1)) AS chars FROM base
  UNION ALL SELECT set_id, '2.01', doc_id, length('Section 2.01 Interest. The  applies.') + 2 FROM base
  UNION ALL SELECT set_id, '2.02', CASE WHEN f2 IS NULL THEN doc_id END, CASE WHEN f2 IS NULL THEN length('Section 2.02 Fees. A fee is due.') ELSE 13 END FROM base
  UNION ALL SELECT set_id, '2.02', lpad(CAST(f2 AS VARCHAR), 9, '0'), length(concat('Fees. A fee of $', f2, ' is due.')) FROM base WHERE f2 IS NOT NULL
  UNION ALL SELECT set_id, '2.02', doc_id, 2 FROM base
  UNION ALL SELECT set_id, '2.03', doc_id, length('Section 2.03 Covenants. Pay.') + 2 FROM base
  UNION ALL SELECT set_id, '2.03', NULL, 1 FROM o WHERE n % 6 = 3
  UNION ALL SELECT set_id, '2.03', lpad(CAST(n AS VARCHAR), 9, '0'), length(concat('Item ', n, ' too.')) FROM o WHERE n % 6 = 3)
SELECT set_id, section, doc_id, CAST(sum(chars) AS BIGINT) AS chars FROM s GROUP BY ALL""")
def operative_sources(spark, sf_dir):
    """How many characters of a section each document wrote; glue has none."""
    p = O.pieces(O.fold(sets(spark, sf_dir))).where("section in ('2.01', '2.02', '2.03')")
    return p.groupBy("set_id", "section", "doc_id").agg(F.sum(F.length("text")).alias("chars"))


@query(f"""WITH {SETS} SELECT set_id, CASE WHEN f1 > 1 THEN lpad(CAST(f1 AS VARCHAR), 9, '0') ELSE '000000001' END AS doc_id, concat('rate ', f1) AS quoted FROM m
UNION ALL SELECT set_id, CASE WHEN f0 > 0 THEN lpad(CAST(f0 AS VARCHAR), 9, '0') ELSE '000000001' END, concat('“Floor” means ', coalesce(f0, 0), '.00%.') FROM m""")
def span_attribution(spark, sf_dir):
    """Spans found in operative texts, quoted from the documents that wrote them."""
    docs = sets(spark, sf_dir)
    parts = durable(O.pieces(O.fold(docs)))
    text = O.texts(parts)
    found = F.array(F.regexp_extract("text", "The (rate [0-9]+) applies", 1), F.regexp_extract("text", "“Floor” means [0-9.]+%\\.", 0))
    spans = text.select("set_id", F.explode(F.transform(found, lambda x: F.struct((F.call_function("locate", x, F.col("text")) - 1).cast("long").alias("start"), F.length(x).alias("n")))).alias("s")).select("set_id", F.col("s.start").alias("start"), (F.col("s.start") + F.col("s.n")).alias("end"))
    at = O.attributed(spans, parts).select("set_id", "doc_id", "doc_start", "doc_end", "part_start")
    back = at.join(docs.select("set_id", "doc_id", "text"), ["set_id", "doc_id"])
    return back.select("set_id", "doc_id", F.expr("substring(text, int(doc_start) + 1, int(doc_end - doc_start))").alias("quoted"))
