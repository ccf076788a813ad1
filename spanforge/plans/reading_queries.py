"""Queries over readings and values, written from orders, line items, parts, events and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanforge.operators import readings as R
from spanforge.plans.base import CLAUSES, clauses, query, read

KINDS = "CASE event_id % 4 WHEN 0 THEN 'money' WHEN 1 THEN 'percent' WHEN 2 THEN 'ratio' ELSE 'date' END"


def kind_of():
    k = F.col("event_id") % 4
    return F.when(k == 0, "money").when(k == 1, "percent").when(k == 2, "ratio").otherwise("date")


@query(f"SELECT event_id, CASE WHEN value IS NOT NULL THEN CASE {KINDS} WHEN 'money' THEN 'USD' WHEN 'percent' THEN 'percent' WHEN 'ratio' THEN 'ratio' END END AS unit FROM events")
def attach_unit(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", R.attached_unit(kind_of(), F.col("value")).alias("unit"))


@query(f"""WITH v AS (SELECT event_id, {KINDS} AS kind, event_id % 50 AS a, event_id % 47 AS b, event_id % 7 AS d FROM events)
SELECT event_id, CASE kind WHEN 'money' THEN a = b WHEN 'date' THEN d < 4 ELSE abs(a * 1000 - (a * 1000 + d)) <= 5 END AS same FROM v""")
def gold_value_match(spark, sf_dir):
    """Money by its number however it is written, percentages within half a hundredth, dates by their day."""
    a, b, d = F.col("event_id") % 50, F.col("event_id") % 47, F.col("event_id") % 7
    expected = F.when(kind_of() == "money", F.concat(a.cast("string"), F.lit(".00"))).when(kind_of() == "date", F.lit("2024-01-31")).otherwise(a.cast("string"))
    near = F.concat(a.cast("string"), F.lit(".00"), d.cast("string"))
    observed = F.when(kind_of() == "money", b.cast("string")).when((kind_of() == "date") & (d < 4), F.lit("2024-01-31T00:00:00")).when(kind_of() == "date", F.lit("2024-01-30")).otherwise(near)
    return read(spark, sf_dir, "events").select("event_id", R.value_match(kind_of(), expected, observed).alias("same"))


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN NULL WHEN 2 THEN CAST(o_custkey AS VARCHAR) WHEN 3 THEN NULL ELSE 'true' END AS restored FROM orders""")
def restore_value(spark, sf_dir):
    """Values that read back as they were written: no day 31 of February, no number with ending zeros."""
    k, c = F.col("o_orderkey") % 5, F.col("o_custkey").cast("string")
    kind = F.when(k < 2, "date").when(k < 4, "int").otherwise("bool")
    text = F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 1, "2023-02-31").when(k == 2, c).when(k == 3, F.concat(c, F.lit(".0"))).otherwise("true")
    return read(spark, sf_dir, "orders").select("o_orderkey", R.restored(kind, text).alias("restored"))


@query("SELECT c_custkey, replace(lower(c_name), '#', '-') AS key FROM customer")
def dash_keys(spark, sf_dir):
    odd = F.concat(F.lit("  "), F.regexp_replace("c_name", "#", "–"), F.lit(" "))
    return read(spark, sf_dir, "customer").select("c_custkey", R.dash_key(odd).alias("key"))


@query("SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN concat('ARTICLE ', p_size) WHEN 1 THEN concat('Section ', p_size) ELSE concat('Section ', p_size, '.01') END AS cited FROM part")
def cite_text(spark, sf_dir):
    n = F.col("p_size").cast("string")
    target = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("ARTICLE "), n)).when(F.col("p_size") % 3 == 1, F.concat(F.lit("Section "), n)).otherwise(F.concat(n, F.lit(".01")))
    return read(spark, sf_dir, "part").select("p_partkey", R.cited(target).alias("cited"))


def _year_end(year: str) -> str:
    last = f"last_day(make_date({year}, mo, 1))"
    back = f"((isodow({last}) - 1 - wd + 7) % 7)"
    return f"CASE WHEN near AND {back} > 3 THEN {last} + CAST(7 - {back} AS INT) ELSE {last} - CAST({back} AS INT) END"


@query(f"""WITH c AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS mo, CAST(15 + o_custkey % 17 AS INT) AS d, CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_custkey % 7 AS INT) END AS wd, o_orderkey % 3 = 1 AS near FROM orders),
m AS (SELECT *, CAST(i AS INT) AS quarter, CAST(make_date(y, mo, 1) - to_months(12 - 3 * i) AS DATE) AS q1 FROM c, (VALUES (1), (2), (3), (4)) v(i))
SELECT o_orderkey, quarter, CASE WHEN wd IS NULL THEN q1 + CAST(least(d, day(last_day(q1))) - 1 AS INT) WHEN quarter = 4 THEN {_year_end("y")} ELSE CAST({_year_end("y - 1")} AS DATE) + 91 * quarter END AS ends FROM m""")
def fiscal_quarter_ends(spark, sf_dir):
    """Years that end on a day, on the last weekday of a month, and on the weekday nearest to its end."""
    k, d = F.col("o_orderkey") % 3, F.col("o_orderdate")
    ends = R.fiscal_quarter_ends(F.year(d), F.month(d), (15 + F.col("o_custkey") % 17).cast("int"), F.when(k > 0, (F.col("o_custkey") % 7).cast("int")), k == 1)
    return read(spark, sf_dir, "orders").select("o_orderkey", F.posexplode(ends).alias("q", "ends")).select("o_orderkey", (F.col("q") + 1).alias("quarter"), "ends")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, list_sort(list_distinct([concat('0.', lpad(CAST(p AS VARCHAR), 2, '0')), CASE WHEN p = 0 THEN '0' WHEN p % 10 = 0 THEN concat('0.', p // 10) ELSE concat('0.', lpad(CAST(p AS VARCHAR), 2, '0')) END, CAST(p AS VARCHAR)])) AS forms
FROM (SELECT *, CAST(round(l_discount * 100) AS INT) AS p FROM lineitem)""")
def surface_forms(spark, sf_dir):
    p = F.round(F.col("l_discount") * 100).cast("int").cast("string")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", R.surface_forms(F.concat(F.lit("0."), F.lpad(p, 2, "0"))).alias("forms"))


@query(f"WITH {CLAUSES} SELECT doc_id, line, text, CAST(CAST(round(l_discount * 100) AS INT) AS DECIMAL(12,4)) AS rate FROM clauses")
def rate_list(spark, sf_dir):
    """Rates of a clause that also has a threshold, which is none."""
    return clauses(spark, sf_dir).select("doc_id", "line", "text", F.explode(R.rates(F.concat(F.col("text"), F.lit("; the ratio is not to exceed 35.5% of it")))).alias("rate"))


@query("SELECT p_partkey, CAST(CASE WHEN p_size % 5 = 0 THEN 1 WHEN p_size % 5 < 3 THEN 2 ELSE 0 END AS INT) AS level FROM part")
def rubric_levels(spark, sf_dir):
    k = F.col("p_size") % 5
    scores = F.when(k == 0, F.array(*[F.lit(0.3)] * 4)).when(k < 3, F.array(F.lit(0.1), F.lit(0.2), F.lit(0.6), F.lit(0.6))).otherwise(F.array(F.lit(0.7), F.lit(0.2), F.lit(0.1), F.lit(0.0)))
    return read(spark, sf_dir, "part").select("p_partkey", R.rubric_level(scores).alias("level"))


@query("""WITH c AS (SELECT doc_id, length(text) AS e FROM documents WHERE text IS NOT NULL) SELECT doc_id, p AS part, p * 1000 AS start, least(e, (p + 1) * 1000) AS "end" FROM (SELECT doc_id, e, unnest(range(greatest(1, CAST(ceil(e / 1000) AS BIGINT)))) AS p FROM c)""")
def sendable_chunks(spark, sf_dir):
    """Texts cut for requests of a thousand characters."""
    d = read(spark, sf_dir, "documents", "doc_id", "text").where("text is not null").select("doc_id", F.lit(0).cast("long").alias("start"), F.length("text").cast("long").alias("end"))
    return R.sendable(d, ["doc_id"], 1000).select("doc_id", "part", "start", "end")


@query("SELECT DISTINCT l_orderkey AS chunk, f AS field FROM lineitem, (VALUES ('A'), ('N'), ('R')) v(f) WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_orderkey = lineitem.l_orderkey AND b.l_returnflag = f)")
def settled_per_chunk(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    specs = li.select(F.col("l_orderkey").alias("chunk")).distinct().withColumn("field", F.explode(F.array(*map(F.lit, "ANR"))))
    return R.unsettled(specs, li.select(F.col("l_orderkey").alias("chunk"), F.col("l_returnflag").alias("field")))


@query("""WITH b AS (SELECT l_orderkey AS doc_id, arg_min(l_partkey, (-l_quantity, l_partkey)) AS v FROM lineitem GROUP BY 1)
SELECT o_orderkey AS doc_id, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE v END AS value, o_orderkey % 2 = 1 AND v IS NOT NULL AS rescued FROM orders LEFT JOIN b ON doc_id = o_orderkey""")
def rescued_fields(spark, sf_dir):
    fields = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")).alias("value"))
    found = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_partkey").alias("value"), F.col("l_quantity").alias("confidence"))
    return R.rescued(fields, found, ["doc_id"])


@query("SELECT o_custkey, o_orderstatus AS status, count(*) AS n FROM orders GROUP BY ALL")
def status_counts(spark, sf_dir):
    return R.status_counts(read(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderstatus").alias("status")), ["o_custkey"])


@query("SELECT lower(o_orderpriority) AS tier, count(DISTINCT o_custkey) AS fields FROM orders GROUP BY ALL")
def fields_per_tier(spark, sf_dir):
    passes = F.concat(F.lit("pass:"), F.col("o_orderstatus"), F.lit(":"), F.lower("o_orderpriority"))
    return R.fields_per_tier(read(spark, sf_dir, "orders").select(passes.alias("pass_id"), F.col("o_custkey").alias("field")))


@query("SELECT p_brand, max(CAST(p_retailprice AS DECIMAL(14,2))) AS margin, arg_min(p_partkey, (-CAST(p_retailprice AS DECIMAL(14,2)), p_partkey)) AS level FROM part GROUP BY ALL")
def grid_tops(spark, sf_dir):
    g = read(spark, sf_dir, "part").select("p_brand", F.col("p_partkey").alias("level"), F.col("p_retailprice").cast("decimal(14,2)").alias("margin"))
    return R.grid_top(g, ["p_brand"], "margin").select("p_brand", F.col("margin").cast("decimal(14,2)").alias("margin"), "level")


@query("""WITH s AS (SELECT l_orderkey AS doc_id, sum(CAST(l_quantity AS DECIMAL(14,2))) AS summed FROM lineitem GROUP BY 1)
SELECT doc_id, summed, CAST(o_custkey AS DECIMAL(14,2)) AS total FROM s JOIN orders ON doc_id = o_orderkey WHERE summed <> o_custkey""")
def stated_totals(spark, sf_dir):
    t = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_quantity").cast("decimal(14,2)").alias("amount"))
    return R.stated_total(t, read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_custkey").cast("decimal(14,2)").alias("total")), ["doc_id"])


@query("SELECT l_orderkey, min(1 - l_discount) AS confidence, bool_and(1 - l_discount >= 0.95) AS confirmed FROM lineitem GROUP BY ALL")
def premises_hold(spark, sf_dir):
    return R.premises(read(spark, sf_dir, "lineitem").select("l_orderkey", (1 - F.col("l_discount")).alias("p")), ["l_orderkey"], 0.95)


@query("SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'P' THEN greatest(3, o_custkey % 6) ELSE 3 END AS INT) AS criticality FROM orders")
def raised_criticality(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "needs_review").otherwise("confirmed").alias("status"), F.lit(3).alias("criticality"), (F.col("o_custkey") % 6).cast("int").alias("scored"))
    return R.criticality(o).select("o_orderkey", "criticality")


TRANCHES = """g AS (SELECT l_orderkey AS doc_id, l_returnflag AS tranche, l_linestatus AS value, count(DISTINCT l_linenumber) AS support, max(l_quantity) AS c FROM lineitem GROUP BY ALL),
t AS (SELECT doc_id, tranche, arg_min(value, (-support, -c, value)) AS value, max(support) AS support FROM g GROUP BY ALL HAVING max(support) >= 2)"""


def tranches(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    return R.per_tranche(li.select(F.col("l_orderkey").alias("doc_id"), F.col("l_returnflag").alias("tranche"), F.col("l_linestatus").alias("value"), F.col("l_linenumber").alias("pass_id"), F.col("l_quantity").alias("confidence")), ["doc_id"], 2)


@query(f"WITH {TRANCHES} SELECT * FROM t")
def per_tranche_variants(spark, sf_dir):
    return tranches(spark, sf_dir)


@query(f"WITH {TRANCHES} SELECT doc_id, CASE WHEN count(DISTINCT value) = 1 THEN min(value) END AS value, CASE WHEN count(DISTINCT value) = 1 THEN 'confirmed' ELSE 'priced_per_tranche' END AS status FROM t GROUP BY doc_id")
def attributed_only_fields(spark, sf_dir):
    return R.attributed_only(tranches(spark, sf_dir), ["doc_id"])


@query("""WITH v AS (SELECT l_orderkey, l_partkey AS value, l_returnflag = 'R' AS r FROM lineitem), m AS (SELECT DISTINCT l_orderkey, value + s AS value FROM v, (VALUES (-1), (1), (10)) x(s) WHERE r) SELECT * FROM m EXCEPT SELECT l_orderkey, value FROM v""")
def shifted_wrong_values(spark, sf_dir):
    v = read(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("value"), (F.col("l_returnflag") == "R").alias("right"))
    return R.shifted_wrong(v, [-1, 1, 10], ["l_orderkey"])


@query("""SELECT CAST(doc_id % 7 AS VARCHAR) AS field_class, count(*) AS n, CAST(count(*) FILTER (WHERE quality = 1 AND toxic = 0) / nullif(count(*) FILTER (WHERE quality = 1), 0) AS DECIMAL(10,6)) AS "precision",
  CAST(count(*) FILTER (WHERE quality = 1 AND toxic = 0) / count(*) AS DECIMAL(10,6)) AS recall, CAST(count(*) FILTER (WHERE quality = 1) / count(*) AS DECIMAL(10,6)) AS coverage, count(*) FILTER (WHERE quality = 1 AND toxic <> 0) AS silent FROM labels GROUP BY 1""")
def by_field_class(spark, sf_dir):
    return R.by_class(read(spark, sf_dir, "labels").select((F.col("doc_id") % 7).cast("string").alias("field_class"), (F.col("quality") == 1).alias("claimed"), (F.col("toxic") == 0).alias("correct")))


@query("SELECT o_custkey, CASE o_orderstatus WHEN 'F' THEN 'populated' WHEN 'O' THEN 'status needs_review' ELSE 'empty' END AS outcome, count(*) AS n FROM orders GROUP BY ALL")
def export_summaries(spark, sf_dir):
    s = F.col("o_orderstatus")
    return R.export_summary(read(spark, sf_dir, "orders").select("o_custkey", F.when(s == "F", F.col("o_orderkey")).alias("value"), F.when(s == "O", "status needs_review").alias("withheld")), ["o_custkey"])


@query("""WITH m AS (SELECT l_orderkey, max(l_suppkey % 4) AS provisos FROM lineitem GROUP BY 1) SELECT m.l_orderkey, CAST(provisos AS BIGINT) AS provisos, min(l_linenumber) AS ix FROM m JOIN lineitem b ON m.l_orderkey = b.l_orderkey AND b.l_suppkey % 4 = provisos WHERE provisos > 0 GROUP BY ALL""")
def deepest_provisos(spark, sf_dir):
    text = F.concat(F.lit("It holds"), F.expr("repeat(', Provided that it does', cast(l_suppkey % 4 as int))"), F.lit("; unprovidedly."))
    s = read(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("ix"), text.alias("text"))
    return R.deepest_proviso(s, ["l_orderkey"]).withColumn("provisos", F.col("provisos").cast("long"))


@query("""WITH t AS (SELECT p_brand, p_size * 100 AS start, max(p_size * 100 + p_partkey % 90) AS "end", bool_and(p_size % 4 <> 0) AS figures FROM part GROUP BY ALL),
b AS (SELECT *, coalesce(start - lag("end") OVER (PARTITION BY p_brand ORDER BY start) > 150 OR NOT figures, true) AS cut FROM t) SELECT p_brand, start, CAST(sum(CAST(cut AS INT)) OVER (PARTITION BY p_brand ORDER BY start) AS INT) AS run FROM b""")
def table_runs(spark, sf_dir):
    """Tables that go on behind one another, within 150 characters."""
    start = F.col("p_size") * 100
    t = read(spark, sf_dir, "part").groupBy("p_brand", start.alias("start")).agg(F.max(start + F.col("p_partkey") % 90).alias("end"), F.bool_and(F.col("p_size") % 4 != 0).alias("figures"))
    return R.continued(t, ["p_brand"], 150).select("p_brand", "start", "run")


@query("""WITH b AS (SELECT p_brand, p_partkey AS ord, p_name AS body, sum(length(p_name)) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS upto FROM part)
SELECT p_brand, coalesce(string_agg(body, chr(10) ORDER BY ord) FILTER (WHERE upto <= 200), '') AS text, bool_or(upto > 200) AS cut FROM b GROUP BY 1""")
def context_texts(spark, sf_dir):
    """Texts of a closure up to 200 characters."""
    return R.context(read(spark, sf_dir, "part").select("p_brand", F.col("p_partkey").alias("ord"), F.col("p_name").alias("body")), ["p_brand"], 200)


@query("""WITH t AS (SELECT p_brand, p_partkey AS k, p_size * 400 AS s, p_size * 400 + p_partkey % 300 AS e FROM part)
SELECT a.p_brand, r.k AS region, a.k AS "table" FROM t a JOIN t r ON a.p_brand = r.p_brand AND r.k % 2 = 1 AND r.s - 900 <= a.s AND a.e <= r.e + 900""")
def tables_in_regions(spark, sf_dir):
    start = F.col("p_size") * 400
    t = read(spark, sf_dir, "part").select("p_brand", F.col("p_partkey").alias("table"), start.alias("start"), (start + F.col("p_partkey") % 300).alias("end"))
    r = t.where("table % 2 = 1").select("p_brand", F.col("table").alias("region"), (F.col("start") - 900).alias("start"), (F.col("end") + 900).alias("end"))
    return R.contained_tables(t, r, ["p_brand"])


@query("SELECT l_orderkey, list_sort(list_distinct(flatten(list([l_returnflag, l_linestatus])))) AS fields, bool_and(l_quantity > 5) AS exhaustive FROM lineitem GROUP BY 1")
def ladder_merge(spark, sf_dir):
    return R.merged_ladder(read(spark, sf_dir, "lineitem").select("l_orderkey", F.array("l_returnflag", "l_linestatus").alias("fields"), (F.col("l_quantity") > 5).alias("exhaustive")), ["l_orderkey"])


@query("SELECT p_partkey, CASE WHEN p_partkey % 5 <> 0 THEN p_size = p_partkey - 10 * (p_partkey % 7 - 1) END AS matches FROM part")
def bullet_reconciliation(spark, sf_dir):
    k = F.col("p_partkey")
    p = read(spark, sf_dir, "part").select(k, F.col("p_size").alias("last"), F.when(k % 5 != 0, k).alias("principal"), F.lit(10).alias("level"), (k % 7).alias("n"))
    return p.select("p_partkey", R.bullet_matches(p).alias("matches"))
