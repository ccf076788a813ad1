"""Scalar functions over clauses derived from line items, orders and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanforge.functions import scalars as S
from spanforge.plans.base import CLAUSES, clauses, query, read

KEYS = "doc_id, line, text"


@query(f"WITH {CLAUSES} SELECT {KEYS}, CAST(replace(regexp_extract(text, '\\$([0-9.,]+)', 1), ',', '') AS DECIMAL(18,2)) AS value FROM clauses")
def parse_money(spark, sf_dir):
    c = clauses(spark, sf_dir)
    amount = F.substring("text", F.locate("$", "text"), F.length("text"))
    return c.select("doc_id", "line", "text", S.money(amount).cast("decimal(18,2)").alias("value"))


@query(f"WITH {CLAUSES} SELECT {KEYS}, CAST(regexp_extract(text, '([0-9.]+)%', 1) AS DECIMAL(10,4)) AS value FROM clauses")
def parse_percent(spark, sf_dir):
    return clauses(spark, sf_dir).select("doc_id", "line", "text", S.percent(F.col("text")).cast("decimal(10,4)").alias("value"))


@query("SELECT p_partkey, concat(CAST(p_size AS varchar), '.50 to 1.00') AS text, CAST(CAST(p_size AS DECIMAL(10,2)) + 0.5 AS DECIMAL(10,2)) AS value FROM part")
def parse_ratio(spark, sf_dir):
    text = F.concat(F.col("p_size").cast("string"), F.lit(".50 to 1.00"))
    return read(spark, sf_dir, "part").select("p_partkey", text.alias("text"), S.ratio(text).cast("decimal(10,2)").alias("value"))


@query(f"WITH {CLAUSES} SELECT {KEYS}, CAST(strptime(regexp_extract(text, 'due (.*)$', 1), '%B %d, %Y') AS DATE) AS value FROM clauses")
def parse_date(spark, sf_dir):
    return clauses(spark, sf_dir).select("doc_id", "line", "text", S.date(F.col("text")).alias("value"))


@query("""
SELECT p_partkey, u AS text, CAST(v AS DECIMAL(18,4)) AS value, unit FROM (
  SELECT p_partkey, p_size AS v, CASE p_size % 5 WHEN 0 THEN concat(p_size, ' bps') WHEN 1 THEN concat(p_size, '%') WHEN 2 THEN concat('within ', p_size, ' days') WHEN 3 THEN concat(p_size, ' months') ELSE concat(p_size, '.0x') END AS u,
         CASE p_size % 5 WHEN 0 THEN 'bps' WHEN 1 THEN 'percent' WHEN 2 THEN 'days' WHEN 3 THEN 'months' ELSE 'multiple' END AS unit FROM part)""")
def parse_quantity(spark, sf_dir):
    s = F.col("p_size").cast("string")
    k = F.col("p_size") % 5
    text = F.when(k == 0, F.concat(s, F.lit(" bps"))).when(k == 1, F.concat(s, F.lit("%"))).when(k == 2, F.concat(F.lit("within "), s, F.lit(" days"))).when(k == 3, F.concat(s, F.lit(" months"))).otherwise(F.concat(s, F.lit(".0x")))
    q = S.quantity(text)
    return read(spark, sf_dir, "part").select("p_partkey", text.alias("text"), q["value"].cast("decimal(18,4)").alias("value"), q["unit"].alias("unit"))


@query("""
SELECT p_partkey, CAST(CASE p_size % 3 WHEN 0 THEN p_size * 0.01 WHEN 1 THEN p_size * 1000 ELSE p_size * 12 END AS DECIMAL(18,4)) AS value,
       CASE p_size % 3 WHEN 0 THEN 'percent' WHEN 1 THEN 'USD' ELSE 'months' END AS unit FROM part""")
def normalize_units(spark, sf_dir):
    unit = F.when(F.col("p_size") % 3 == 0, "bps").when(F.col("p_size") % 3 == 1, "USD_thousands").otherwise("years")
    q = S.canonical(F.col("p_size").cast("decimal(18,4)"), unit)
    return read(spark, sf_dir, "part").select("p_partkey", q["value"].cast("decimal(18,4)").alias("value"), q["unit"].alias("unit"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'thousands' WHEN p_size % 3 = 1 THEN 'millions' END AS scale FROM part")
def scale_declaration(spark, sf_dir):
    k = F.col("p_size") % 3
    text = F.when(k == 0, "(Dollars in thousands)").when(k == 1, "amounts stated in Millions of dollars").otherwise("in full")
    return read(spark, sf_dir, "part").select("p_partkey", S.scale_declared(text).alias("scale"))


@query("SELECT o_orderkey, CAST(year(o_orderdate) * 4 + quarter(o_orderdate) - 1 AS INT) AS quarter_ordinal FROM orders")
def quarter_index(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", S.quarter_index(F.col("o_orderdate").cast("date")).alias("quarter_ordinal"))


@query("""
SELECT o_orderkey, CAST(year(d) * 4 + quarter(d) - 1 AS INT) AS fiscal_ordinal FROM (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH AS d FROM orders)""")
def fiscal_quarter(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", S.fiscal_quarter(F.col("o_orderdate").cast("date"), 9).alias("fiscal_ordinal"))


@query("""
WITH y AS (SELECT DISTINCT year(o_orderdate) AS fiscal_year FROM orders),
d AS (SELECT fiscal_year, unnest([CAST(x AS DATE) FOR x IN range(make_date(fiscal_year, 12, 25), make_date(fiscal_year + 1, 1, 8), INTERVAL 1 DAY)]) AS day FROM y),
s AS (SELECT * FROM d WHERE isodow(day) = 6)
SELECT CAST(fiscal_year AS INT) AS fiscal_year, max(day) FILTER (WHERE day <= make_date(fiscal_year, 12, 31)) AS last_saturday,
       min_by(day, abs(day - make_date(fiscal_year, 12, 31))) AS nearest_saturday, make_date(fiscal_year, 12, 31) AS calendar_end
FROM s GROUP BY fiscal_year""")
def fiscal_year_ends(spark, sf_dir):
    y = read(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("fiscal_year")).distinct()
    c = F.col("fiscal_year")
    return y.select(c, S.fiscal_year_end(c, 12, 5).alias("last_saturday"), S.fiscal_year_end(c, 12, 5, True).alias("nearest_saturday"), S.fiscal_year_end(c, 12).alias("calendar_end"))


@query("""
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(o_orderdate AS DATE) AS a, CAST(l_shipdate AS DATE) AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_linenumber, l_partkey, CAST((b - a) / 360 AS DECIMAL(18,6)) AS a360, CAST((b - a) / 365 AS DECIMAL(18,6)) AS a365,
       CAST(((year(b) - year(a)) * 360 + (month(b) - month(a)) * 30 + least(day(b), 30) - least(day(a), 30)) / 360 AS DECIMAL(18,6)) AS e360 FROM x""")
def year_fraction(spark, sf_dir):
    j = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    a, b = F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date")
    f = lambda c: S.year_fraction(a, b, c).cast("decimal(18,6)")
    return j.select("l_orderkey", "l_linenumber", "l_partkey", f("A360").alias("a360"), f("A365").alias("a365"), f("30E360").alias("e360"))


@query("""
SELECT o_orderkey, d AS day, CAST(d + CAST(CASE isodow(d) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END AS INT) AS DATE) AS following,
       CAST(d - CAST(CASE isodow(d) WHEN 6 THEN 1 WHEN 7 THEN 2 ELSE 0 END AS INT) AS DATE) AS preceding FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def business_day_roll(spark, sf_dir):
    d = F.col("o_orderdate").cast("date")
    return read(spark, sf_dir, "orders").select("o_orderkey", d.alias("day"), S.business_day(d).alias("following"), S.business_day(d, True).alias("preceding"))


@query("""
SELECT o_orderkey, CAST(CASE o_orderkey % 3 WHEN 0 THEN d + INTERVAL 45 DAY WHEN 1 THEN d + INTERVAL 18 MONTH ELSE d + INTERVAL 5 YEAR END AS DATE) AS shifted
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def date_shift(spark, sf_dir):
    k = F.col("o_orderkey") % 3
    n = F.when(k == 0, 45).when(k == 1, 18).otherwise(5)
    unit = F.when(k == 0, "days").when(k == 1, "months").otherwise("years")
    return read(spark, sf_dir, "orders").select("o_orderkey", S.shift(F.col("o_orderdate").cast("date"), n, unit).alias("shifted"))


@query("""
WITH w(t, n) AS (VALUES ('twenty', 20), ('thirty', 30), ('forty', 40), ('fifty', 50)), u(t, n) AS (VALUES ('one', 1), ('two', 2), ('three', 3), ('five', 5), ('nine', 9))
SELECT p_partkey, w.n + u.n AS value FROM part
JOIN w ON w.n = ((p_partkey % 4) + 2) * 10 JOIN u ON u.n = CASE p_size % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 5 ELSE 9 END""")
def words_to_number(spark, sf_dir):
    tens = F.element_at(F.array(*map(F.lit, ["twenty", "thirty", "forty", "fifty"])), (F.col("p_partkey") % 4 + 1).cast("int"))
    ones = F.element_at(F.array(*map(F.lit, ["one", "two", "three", "five", "nine"])), F.col("p_size") % 5 + 1)
    return read(spark, sf_dir, "part").select("p_partkey", S.words_value(F.concat(tens, F.lit("-"), ones)).alias("value"))


@query(f"WITH {CLAUSES} SELECT doc_id, line, text, CAST(regexp_replace(regexp_replace(CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS VARCHAR), '(\\.[0-9]*?)0+$', '\\1'), '\\.$', '') AS VARCHAR) AS value_key FROM clauses")
def value_identity(spark, sf_dir):
    amount = F.substring("text", F.locate("$", "text"), F.length("text"))
    return clauses(spark, sf_dir).select("doc_id", "line", "text", S.value_key(S.money(amount)).alias("value_key"))


@query("""
SELECT c_custkey, CAST(round(c_acctbal, 2) AS DECIMAL(14,2)) AS balance, abs(round(c_acctbal, 2) - round(c_acctbal, 1)) <= 0.005 AS same FROM customer""")
def value_equality(spark, sf_dir):
    a, b = F.round("c_acctbal", 2), F.round("c_acctbal", 1)
    return read(spark, sf_dir, "customer").select("c_custkey", a.cast("decimal(14,2)").alias("balance"), S.same_value(F.concat(F.lit("$"), a.cast("decimal(14,2)").cast("string")), b.cast("decimal(14,1)").cast("string")).alias("same"))


@query("SELECT doc_id, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS key, CAST(greatest(1, ceil(length(text) / 4)) AS INT) AS tokens FROM documents")
def flatten_and_tokens(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", S.text_key(F.col("text")).alias("key"), S.tokens_estimate(F.col("text")).alias("tokens"))


@query("""
SELECT doc_id, list_filter(list_transform(regexp_extract_all(lower(text), '([a-z0-9][a-z0-9.,%$-]*)', 1), lambda w: regexp_replace(w, '[.,;:]+$', '')),
  lambda w: length(w) > 1 AND w NOT IN ('the', 'and', 'of', 'to', 'in')) AS words FROM documents""")
def content_words(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", S.content_words(F.col("text"), ["the", "and", "of", "to", "in"]).alias("words"))


@query("""
SELECT key, count(*) AS asked, min(conv_id) AS first_conv FROM (
  SELECT conv_id, sha256(concat(length(role), ':', role, '|', length(text), ':', text)) AS key FROM conversations WHERE text IS NOT NULL) GROUP BY key""")
def answer_dedupe(spark, sf_dir):
    c = read(spark, sf_dir, "conversations").where("text is not null")
    return c.groupBy(S.answer_key(F.col("role"), F.col("text")).alias("key")).agg(F.count("*").alias("asked"), F.min("conv_id").alias("first_conv"))


@query("""
SELECT role, CAST(sum(CAST(greatest(1, ceil(length(text) / 4)) AS BIGINT)) AS BIGINT) AS tokens, CAST(sum(CAST(greatest(1, ceil(length(text) / 4)) AS BIGINT)) * 3 / 1000000.0 AS DECIMAL(18,6)) AS dollars
FROM conversations WHERE text IS NOT NULL GROUP BY role""")
def cost_ledger(spark, sf_dir):
    c = read(spark, sf_dir, "conversations").where("text is not null").groupBy("role").agg(F.sum(S.tokens_estimate(F.col("text"))).alias("tokens"))
    return c.select("role", "tokens", S.price(F.col("tokens"), F.lit(0)).cast("decimal(18,6)").alias("dollars"))


@query("""
SELECT n_nationkey, n, k, CAST(CASE WHEN n = 0 OR k = 0 THEN 0 ELSE greatest(0, (k / n + 3.8416 / (2 * n) - 1.96 * sqrt(k / n * (1 - k / n) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n)) END AS DECIMAL(12,8)) AS lower_bound
FROM (SELECT c_nationkey AS n_nationkey, count(*)::DOUBLE AS n, (count(*) FILTER (WHERE c_acctbal > 0))::DOUBLE AS k FROM customer GROUP BY 1)""")
def wilson_bound(spark, sf_dir):
    g = read(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").cast("double").alias("n"), F.count_if(F.col("c_acctbal") > 0).cast("double").alias("k"))
    return g.select("n_nationkey", "n", "k", S.wilson_lower(F.col("k"), F.col("n")).cast("decimal(12,8)").alias("lower_bound"))


@query("""
SELECT o_orderkey, CAST(CASE WHEN f = 'base' THEN greatest(base + 0.1, 3.0) + margin ELSE greatest(base + 0.1 + margin, 3.0) END AS DECIMAL(10,4)) AS rate FROM (
  SELECT o_orderkey, CAST((o_custkey % 700) / 100.0 AS DECIMAL(10,4)) AS base, CAST((o_orderkey % 5) AS DECIMAL(10,4)) AS margin, CASE WHEN o_orderkey % 2 = 0 THEN 'base' ELSE 'all_in' END AS f FROM orders)""")
def all_in_rate(spark, sf_dir):
    d = lambda c: c.cast("decimal(10,4)")
    base, margin = d(F.col("o_custkey") % 700 / 100), d(F.col("o_orderkey") % 5)
    rate = S.all_in_rate(base, margin, d(F.lit(3)), F.when(F.col("o_orderkey") % 2 == 0, "base").otherwise("all_in"), d(F.lit(0.1)))
    return read(spark, sf_dir, "orders").select("o_orderkey", d(rate).alias("rate"))


@query("""
SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'term_sofr' WHEN 1 THEN 'libor' WHEN 2 THEN 'prime' END AS benchmark FROM part""")
def benchmark_detect(spark, sf_dir):
    k = F.col("p_size") % 4
    text = F.when(k == 0, "Term SOFR for the Interest Period").when(k == 1, "the Eurodollar Rate").when(k == 2, "the Base Rate").otherwise("a fixed rate")
    return read(spark, sf_dir, "part").select("p_partkey", S.benchmark(text).alias("benchmark"))


@query("SELECT p_partkey, CAST(p_size AS DECIMAL(10,2)) AS above, CAST(p_size + 1 AS DECIMAL(10,2)) AS upto FROM part")
def leverage_band(spark, sf_dir):
    text = F.concat(F.lit("Greater than "), F.col("p_size").cast("string"), F.lit(".00 to 1.00 but less than or equal to "), (F.col("p_size") + 1).cast("string"), F.lit(".00 to 1.00"))
    b = S.band(text)
    return read(spark, sf_dir, "part").select("p_partkey", b["above"].cast("decimal(10,2)").alias("above"), b["upto"].cast("decimal(10,2)").alias("upto"))


@query("""
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'date' WHEN 1 THEN 'int' WHEN 2 THEN 'bool' ELSE 'text' END AS kind,
       CASE o_orderkey % 4 WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) WHEN 1 THEN CAST(o_custkey AS VARCHAR) WHEN 2 THEN CASE WHEN o_custkey % 2 = 0 THEN 'true' ELSE 'false' END ELSE lower(o_orderpriority) END AS value FROM orders""")
def typed_coercion(spark, sf_dir):
    k = F.col("o_orderkey") % 4
    kind = F.when(k == 0, "date").when(k == 1, "int").when(k == 2, "bool").otherwise("text")
    raw = F.when(k == 0, F.date_format("o_orderdate", "M/d/yyyy")).when(k == 1, F.concat(F.lit("No. "), F.col("o_custkey").cast("string"))).when(k == 2, F.when(F.col("o_custkey") % 2 == 0, " Yes").otherwise("no")).otherwise(F.upper("o_orderpriority"))
    return read(spark, sf_dir, "orders").select("o_orderkey", kind.alias("kind"), S.coerced(kind, raw).alias("value"))


@query("""
SELECT event_id, CASE event_id % 3 WHEN 0 THEN concat('$', v) WHEN 1 THEN concat(v, '%') ELSE concat(v, ' to 1.00') END AS described
FROM (SELECT event_id, CAST(CAST(event_id % 97 AS INT) AS VARCHAR) AS v FROM events)""")
def describe_value(spark, sf_dir):
    k = F.col("event_id") % 3
    kind = F.when(k == 0, "money").when(k == 1, "percent").otherwise("ratio")
    return read(spark, sf_dir, "events").select("event_id", S.described(kind, (F.col("event_id") % 97).cast("string")).alias("described"))


@query("SELECT c_custkey, sha256(c_name) AS rank, split_part(c_name, '#', 1) AS stratum FROM customer")
def hash_rank(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", F.sha2("c_name", 256).alias("rank"), F.split_part("c_name", F.lit("#"), F.lit(1)).alias("stratum"))


@query("""
SELECT doc_id, replace(replace(translate(text, '“”‘’–—', '""''''--'), 'ﬁ', 'fi'), 'ﬂ', 'fl') AS folded FROM (SELECT doc_id, concat('“', coalesce(text, ''), '” – ofﬁce ‘x’') AS text FROM documents)""")
def char_fold(spark, sf_dir):
    text = F.concat(F.lit("“"), F.coalesce("text", F.lit("")), F.lit("” – ofﬁce ‘x’"))
    return read(spark, sf_dir, "documents").select("doc_id", S.fold(text).alias("folded"))


@query("""
SELECT a.event_id, greatest(0, least(a.e, b.e) - greatest(a.s, b.s)) AS shared,
       CAST(greatest(0, least(a.e, b.e) - greatest(a.s, b.s)) / ((a.e - a.s) + (b.e - b.s) - greatest(0, least(a.e, b.e) - greatest(a.s, b.s))) AS DECIMAL(10,6)) AS jaccard
FROM (SELECT event_id, event_id % 50 AS s, event_id % 50 + 20 AS e FROM events) a JOIN (SELECT event_id, event_id % 37 AS s, event_id % 37 + 30 AS e FROM events) b USING (event_id)""")
def span_jaccard(spark, sf_dir):
    i = F.col("event_id")
    s = [i % 50, i % 50 + 20, i % 37, i % 37 + 30]
    return read(spark, sf_dir, "events").select("event_id", S.overlap(*s).alias("shared"), S.jaccard(*s).cast("decimal(10,6)").alias("jaccard"))


@query(f"WITH {CLAUSES} SELECT doc_id, line, text, concat('Before that. ', text) AS whole, text AS sentence FROM clauses")
def sentence_window(spark, sf_dir):
    whole = F.concat(F.lit("Before that. "), F.col("text"), F.lit(". After it."))
    c = clauses(spark, sf_dir)
    start = F.locate("$", whole) - 1
    got = S.sentence_around(whole, start, start + 3)
    return c.select("doc_id", "line", "text", F.concat(F.lit("Before that. "), F.col("text")).alias("whole"), F.rtrim(F.regexp_replace(got, r"\.$", "")).alias("sentence"))
