"""Segmentation, offsets and span joins over documents and over agreements made of line items."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.operators import spans as O
from spanforge.plans.base import CLAUSES, clauses, query, read

AGREEMENTS = (
    CLAUSES
    + """, agreements AS (
  SELECT doc_id, string_agg(text, chr(10) || chr(10) ORDER BY line, l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax) AS text
  FROM clauses GROUP BY doc_id)"""
)


def spots_sql(source: str, pattern: str, name: str = "spots") -> str:
    return f"""{name} AS (
  SELECT doc_id, CAST(i - 1 AS INT) AS ix, hits[i] AS match,
         CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0) AS BIGINT) AS start
  FROM (SELECT doc_id, gaps, hits, unnest(range(1, len(hits) + 1)) AS i FROM
    (SELECT doc_id, regexp_split_to_array(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}') AS hits FROM {source})))"""


SECTION, AMOUNT = r"Section [0-9]+\.[0-9]+", r"\$[0-9]+\.[0-9][0-9]"
MARKED = f"""{AGREEMENTS}, {spots_sql("agreements", SECTION, "marks")}, {spots_sql("agreements", AMOUNT, "amounts")},
sections AS (SELECT marks.doc_id, marks.match AS section, start, coalesce(lead(start) OVER (PARTITION BY marks.doc_id ORDER BY start), length(text)) AS "end" FROM marks JOIN agreements USING (doc_id))"""
SLIDING = """slides AS (
  SELECT doc_id, CAST(s / {stride} AS INT) AS ix, CAST(s AS INT) AS start, CAST(least(s + {window}, n) AS INT) AS "end"
  FROM (SELECT doc_id, n, unnest(range(0, CAST(ceil(greatest(0, n - {window}) / {stride}) * {stride} AS BIGINT) + 1, {stride})) AS s FROM (SELECT doc_id, length(text) AS n FROM {source} WHERE length(text) > 0)))"""


def agreements(spark, sf_dir):
    c = clauses(spark, sf_dir)
    order = F.struct("line", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "text")
    rows = F.transform(F.sort_array(F.collect_list(order)), lambda x: x["text"])
    return c.groupBy("doc_id").agg(F.array_join(rows, "\n\n").alias("text"))


def sections(docs):
    marks = O.matches(docs, SECTION, ["doc_id"]).select("doc_id", F.col("match").alias("section"), "start")
    return O.closed(marks, docs, ["doc_id"])


@query("WITH " + SLIDING.format(window=6000, stride=4200, source="documents") + " SELECT * FROM slides")
def sliding_chunks(spark, sf_dir):
    return O.sliding(read(spark, sf_dir, "documents", "doc_id", "text"), ["doc_id"])


@query("WITH " + SLIDING.format(window=6000, stride=4200, source="documents") + ' SELECT d.doc_id, CAST(length(text) AS BIGINT) AS length, CAST(length(text) AS BIGINT) AS covered, CAST(1.0 AS DECIMAL(10,6)) AS share FROM documents d')
def chunk_coverage(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return O.coverage(O.sliding(docs, ["doc_id"]), docs, ["doc_id"]).withColumn("share", F.col("share").cast("decimal(10,6)"))


@query(f"WITH {spots_sql('documents', 'th[a-z]+')} SELECT doc_id, ix, match, start, start + length(match) AS \"end\" FROM spots")
def match_offsets(spark, sf_dir):
    return O.matches(read(spark, sf_dir, "documents", "doc_id", "text"), "th[a-z]+", ["doc_id"])


@query(f'WITH {MARKED} SELECT doc_id, section, start, CAST("end" AS BIGINT) AS "end" FROM sections')
def section_markers(spark, sf_dir):
    return sections(agreements(spark, sf_dir)).select("doc_id", "section", "start", F.col("end").cast("long").alias("end"))


@query(f'WITH {MARKED} SELECT a.doc_id, a.match AS amount, a.start, s.section FROM amounts a ASOF LEFT JOIN sections s ON a.doc_id = s.doc_id AND a.start >= s.start')
def locate_section(spark, sf_dir):
    docs = agreements(spark, sf_dir)
    points = O.matches(docs, AMOUNT, ["doc_id"]).select("doc_id", F.col("match").alias("amount"), "start")
    return O.locate(points, sections(docs), ["doc_id"], "start", "section")


@query(f'WITH {MARKED} SELECT s.doc_id, s.section, substr(text, CAST(start + 1 AS BIGINT), CAST("end" - start AS BIGINT)) AS body FROM sections s JOIN agreements USING (doc_id)')
def section_text(spark, sf_dir):
    docs = agreements(spark, sf_dir)
    body = F.substring("text", (F.col("start") + 1).cast("int"), (F.col("end") - F.col("start")).cast("int"))
    return sections(docs).join(docs, "doc_id").select("doc_id", "section", body.alias("body"))


@query(f"WITH {MARKED}, {SLIDING.format(window=120, stride=84, source='agreements')} SELECT a.doc_id, a.match AS amount, a.start, s.ix AS chunk FROM amounts a JOIN slides s ON a.doc_id = s.doc_id AND a.start >= s.start AND a.start + length(a.match) <= s.\"end\"")
def candidate_chunk_contributions(spark, sf_dir):
    docs = agreements(spark, sf_dir)
    found = O.matches(docs, AMOUNT, ["doc_id"]).select("doc_id", F.col("match").alias("amount"), "start", "end")
    chunks = O.sliding(docs, ["doc_id"], 120, 84).select("doc_id", F.col("ix").alias("chunk"), F.col("start").alias("outer_start"), F.col("end").alias("outer_end"))
    return O.contained(found, chunks, ["doc_id"]).select("doc_id", "amount", "start", "chunk")


@query(f"WITH {MARKED}, {SLIDING.format(window=120, stride=84, source='agreements')} SELECT s.doc_id, s.ix, s.start, s.\"end\" FROM slides s WHERE NOT EXISTS (SELECT 1 FROM amounts a WHERE a.doc_id = s.doc_id AND a.start >= s.start AND a.start + length(a.match) <= s.\"end\")")
def orphan_chunks(spark, sf_dir):
    """Chunks to which no reading contributes: an anti join on containment."""
    docs = agreements(spark, sf_dir)
    found = O.matches(docs, AMOUNT, ["doc_id"])
    chunks = O.sliding(docs, ["doc_id"], 120, 84)
    on = [chunks.doc_id == found.doc_id, found.start >= chunks.start, found.end <= chunks.end]
    return chunks.join(found, on, "left_anti")


@query(f'WITH {MARKED} SELECT a.doc_id, a.match AS amount, m.match AS section, a.start FROM amounts a JOIN marks m ON a.doc_id = m.doc_id AND m.start BETWEEN a.start - 40 AND a.start + length(a.match) + 40')
def marks_near(spark, sf_dir):
    """Band join: points within 40 characters of a span."""
    docs = agreements(spark, sf_dir)
    found = O.matches(docs, AMOUNT, ["doc_id"]).select("doc_id", F.col("match").alias("amount"), "start", "end")
    marks = O.matches(docs, SECTION, ["doc_id"]).select("doc_id", F.col("match").alias("section"), F.col("start").alias("at"))
    return O.within(found, marks, ["doc_id"], 40).select("doc_id", "amount", "section", "start")


INTERVALS = """intervals AS (SELECT l_suppkey AS doc_id, CAST(l_partkey % 1000 AS BIGINT) AS start, CAST(l_partkey % 1000 + l_quantity AS BIGINT) AS "end" FROM lineitem)"""


def intervals(spark, sf_dir):
    start = F.col("l_partkey") % 1000
    return read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("doc_id"), start.alias("start"), (start + F.col("l_quantity")).cast("long").alias("end"))


MERGED = """islands AS (
  SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY start, "end") AS island FROM (
    SELECT *, CASE WHEN start > max("end") OVER (PARTITION BY doc_id ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + {gap} THEN 1
      WHEN row_number() OVER (PARTITION BY doc_id ORDER BY start, "end") = 1 THEN 1 ELSE 0 END AS fresh FROM intervals)),
merged AS (SELECT doc_id, min(start) AS start, max("end") AS "end", count(*) AS n FROM islands GROUP BY doc_id, island)"""


@query(f"WITH {INTERVALS}, {MERGED.format(gap=5)} SELECT * FROM merged")
def merge_spans(spark, sf_dir):
    return O.merge(intervals(spark, sf_dir), ["doc_id"], 5)


@query("""
WITH runs AS (SELECT l_suppkey AS doc_id, l_returnflag AS kind, CAST(l_partkey % 1000 AS BIGINT) AS start, CAST(l_partkey % 1000 + 2 AS BIGINT) AS "end" FROM lineitem),
f AS (SELECT *, CASE WHEN start <= max("end") OVER (PARTITION BY doc_id, kind ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS fresh FROM runs),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, kind ORDER BY start, "end") AS island FROM f)
SELECT doc_id, kind, min(start) AS start, max("end") AS "end", count(*) AS n FROM i GROUP BY doc_id, kind, island""")
def redline_merge(spark, sf_dir):
    """Struck and inserted runs of one kind that touch, as one."""
    start = F.col("l_partkey") % 1000
    runs = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("doc_id"), F.col("l_returnflag").alias("kind"), start.alias("start"), (start + 2).alias("end"))
    return O.merge(runs, ["doc_id", "kind"], 1)


@query(f"""WITH {INTERVALS}, u AS (SELECT DISTINCT * FROM intervals)
SELECT a.doc_id, a.start, a."end", count(*) AS holders FROM u a JOIN u b ON a.doc_id = b.doc_id AND b.start < a.start AND a."end" <= b."end" GROUP BY a.doc_id, a.start, a."end\"""")
def nested_spans(spark, sf_dir):
    """Spans inside another one that starts earlier (tables within tables)."""
    u = intervals(spark, sf_dir).distinct()
    outer = u.select("doc_id", F.col("start").alias("outer_start"), F.col("end").alias("outer_end"))
    return O.contained(u, outer, ["doc_id"]).where("outer_start < start").groupBy("doc_id", "start", "end").agg(F.count("*").alias("holders"))


@query(f"""WITH {MARKED}, k AS (SELECT doc_id, section, start, row_number() OVER (PARTITION BY doc_id, section ORDER BY start) AS k, count(*) OVER (PARTITION BY doc_id, section) AS n FROM sections),
b AS (SELECT *, min(CASE WHEN k > 1 OR n = 1 THEN start END) OVER (PARTITION BY doc_id) AS body FROM k)
SELECT doc_id, section, start FROM b WHERE start >= body""")
def contents_dropped(spark, sf_dir):
    return O.contents_dropped(sections(agreements(spark, sf_dir)).select("doc_id", "section", "start"), ["doc_id"])


@query(f"""WITH {MARKED}, f AS (SELECT *, row_number() OVER (PARTITION BY doc_id, section ORDER BY start) AS n FROM sections) SELECT doc_id, section, start, CAST("end" AS BIGINT) AS "end" FROM f WHERE n = 1""")
def section_span(spark, sf_dir):
    """The first marker of each section id."""
    return O.first_of(sections(agreements(spark, sf_dir)), ["doc_id", "section"], F.col("start")).select("doc_id", "section", "start", F.col("end").cast("long").alias("end"))


@query(f"""WITH {MARKED} SELECT doc_id, section, CAST(p AS INT) AS part, CAST(start + p * 30 AS BIGINT) AS start, CAST(least(start + p * 30 + 30, "end") AS BIGINT) AS "end"
FROM (SELECT *, unnest(range(0, CAST(ceil(("end" - start) / 30) AS BIGINT))) AS p FROM sections)""")
def structural_chunks(spark, sf_dir):
    """Sections, cut where they are too long to send."""
    s = sections(agreements(spark, sf_dir)).select("doc_id", "section", "start", F.col("end").cast("long").alias("end"))
    return O.pieces(s, 30)


@query("""SELECT doc_id, CAST(i - 1 AS INT) AS page, p AS text FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS p, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)""")
def text_pages(spark, sf_dir):
    """A plain text reader's pages: parts between page marks, here line ends."""
    return read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("page", "text"))


@query("""WITH q AS (SELECT doc_id, text, substr(text, 11, 25) AS quote FROM documents WHERE length(text) >= 11)
SELECT doc_id, CAST(strpos(text, quote) - 1 AS INT) AS start, strpos(regexp_replace(text, '\\s+', ' ', 'g'), regexp_replace(quote, '\\s+', ' ', 'g')) > 0 AS loosely FROM q""")
def quote_offsets(spark, sf_dir):
    """Where a quotation from the eleventh character on stands, in every text that has one: exactly, or with white space collapsed."""
    d = read(spark, sf_dir, "documents").where("length(text) >= 11").withColumn("quote", F.substring("text", 11, 25))
    loose = F.expr(r"locate(regexp_replace(quote, '\\s+', ' '), regexp_replace(text, '\\s+', ' '))")
    return d.select("doc_id", (F.expr("locate(quote, text)") - 1).alias("start"), (loose > 0).alias("loosely"))


@query(f"""WITH {spots_sql('documents', 'th[a-z]+')}, r AS (SELECT doc_id, match AS term, start, row_number() OVER (PARTITION BY doc_id, match ORDER BY start) AS n FROM spots)
SELECT doc_id, term, CAST(greatest(0, start - 60) AS BIGINT) AS start, start + length(term) + 60 AS "end", CAST(n AS INT) AS site FROM r WHERE n <= 12""")
def use_sites(spark, sf_dir):
    """The first twelve uses of each term, padded."""
    m = O.matches(read(spark, sf_dir, "documents", "doc_id", "text"), "th[a-z]+", ["doc_id"])
    n = F.row_number().over(W.partitionBy("doc_id", "match").orderBy("start"))
    return m.withColumn("site", n).where("site <= 12").select("doc_id", F.col("match").alias("term"), F.greatest(F.lit(0), F.col("start") - 60).cast("long").alias("start"), (F.col("end") + 60).alias("end"), "site")


@query(f"""WITH {MARKED}, r AS (SELECT s.doc_id, s.section, a.match AS amount, row_number() OVER (PARTITION BY s.doc_id, s.section, s.start ORDER BY abs(a.start - s.start), a.start) AS n
  FROM sections s JOIN amounts a ON s.doc_id = a.doc_id) SELECT doc_id, section, amount, CAST(n AS INT) AS n FROM r WHERE n <= 3""")
def nearest_figures(spark, sf_dir):
    """The three figures nearest to each section marker."""
    docs = agreements(spark, sf_dir)
    s = sections(docs).select("doc_id", "section", "start")
    a = O.matches(docs, AMOUNT, ["doc_id"]).select("doc_id", F.col("match").alias("amount"), F.col("start").alias("at"))
    n = F.row_number().over(W.partitionBy("doc_id", "section", "start").orderBy(F.abs(F.col("at") - F.col("start")), "at"))
    return s.join(a, "doc_id").withColumn("n", n).where("n <= 3").select("doc_id", "section", "amount", "n")


@query(f"""WITH {MARKED}, d AS (SELECT doc_id, match AS marker, start FROM marks WHERE match LIKE 'Section 2.%')
SELECT d.doc_id, d.marker, d.start, max(p.start) AS mention, min(f.start) AS subject FROM d
LEFT JOIN amounts p ON p.doc_id = d.doc_id AND p.start < d.start JOIN amounts f ON f.doc_id = d.doc_id AND f.start > d.start AND f.start <= d.start + 700
WHERE p.start IS NOT NULL GROUP BY d.doc_id, d.marker, d.start""")
def override_candidates(spark, sf_dir):
    """Markers with the last mention before (as-of) and the subject that follows within 700 characters."""
    docs = agreements(spark, sf_dir)
    d = O.matches(docs, SECTION, ["doc_id"]).where(F.col("match").like("Section 2.%")).select("doc_id", F.col("match").alias("marker"), "start")
    a = O.matches(docs, AMOUNT, ["doc_id"]).select("doc_id", "start", F.col("start").alias("mention"))
    before = O.locate(d, a, ["doc_id"], "start", "mention").where("mention is not null")
    after = a.select("doc_id", F.col("start").alias("at"))
    return before.join(after, "doc_id").where("at > start and at <= start + 700").groupBy("doc_id", "marker", "start", "mention").agg(F.min("at").alias("subject"))


@query(f"""WITH {MARKED}, e AS (SELECT doc_id, start, start + length(match) AS "end", CAST(length(match) + 3 AS BIGINT) AS new_length FROM amounts)
SELECT doc_id, start, "end", new_length, CAST(sum(new_length - ("end" - start)) OVER (PARTITION BY doc_id ORDER BY start ROWS UNBOUNDED PRECEDING) AS BIGINT) AS shift FROM e""")
def offset_shifts(spark, sf_dir):
    """How far text moves behind each edit."""
    e = O.matches(agreements(spark, sf_dir), AMOUNT, ["doc_id"]).select("doc_id", "start", "end", (F.length("match") + 3).cast("long").alias("new_length"))
    return O.shifted(e, ["doc_id"])


@query(f"""WITH {MARKED}, e AS (SELECT doc_id, start, start + length(match) AS at, sum(3) OVER (PARTITION BY doc_id ORDER BY start ROWS UNBOUNDED PRECEDING) AS shift FROM amounts)
SELECT m.doc_id, m.match AS section, m.start, CAST(m.start + coalesce(max(e.shift), 0) AS BIGINT) AS moved FROM marks m LEFT JOIN e ON e.doc_id = m.doc_id AND e.at <= m.start GROUP BY m.doc_id, m.match, m.start""")
def remap_offsets(spark, sf_dir):
    """Where a marker stands after the edits before it: as-of over the running shift."""
    docs = agreements(spark, sf_dir)
    e = O.matches(docs, AMOUNT, ["doc_id"]).select("doc_id", "start", "end", (F.length("match") + 3).cast("long").alias("new_length"))
    marks = O.shifted(e, ["doc_id"]).select("doc_id", F.col("end").alias("start"), "shift")
    points = O.matches(docs, SECTION, ["doc_id"]).select("doc_id", F.col("match").alias("section"), "start")
    return O.locate(points, marks, ["doc_id"], "start", "shift").select("doc_id", "section", "start", (F.col("start") + F.coalesce("shift", F.lit(0))).alias("moved"))


@query("""WITH f(field) AS (VALUES ('view'), ('click'), ('refund'), ('purchase'))
SELECT u.user_id, f.field FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN f WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = u.user_id AND e.event_type = f.field)""")
def open_fields(spark, sf_dir):
    """Fields of a registry that a document has not answered: anti join."""
    e = read(spark, sf_dir, "events", "user_id", "event_type")
    asked = e.select("user_id").distinct().select("user_id", F.explode(F.array(*map(F.lit, ["view", "click", "refund", "purchase"]))).alias("field"))
    return asked.join(e, (asked.user_id == e.user_id) & (asked.field == e.event_type), "left_anti")
