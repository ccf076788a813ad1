"""Reconciliation, conditions, schedules, checks and graphs over events, orders, line items and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanforge.operators import conditions as C
from spanforge.operators import graphs as G
from spanforge.operators import reconcile as R
from spanforge.operators import schedules as P
from spanforge.plans.base import query, read

READINGS = """readings AS (SELECT user_id AS doc_id, CAST(event_id % 5 AS VARCHAR) AS field, event_type AS key, CAST(day(ts) AS VARCHAR) AS segmentation, event_id % 11 = 0 AS echo,
  CASE WHEN event_id % 7 = 0 THEN 'deterministic:rules' WHEN event_id % 29 = 0 THEN 'deterministic:definitions' ELSE 'model:1' END AS pass_id, CAST((event_id % 90) / 100.0 AS DECIMAL(10,4)) AS confidence FROM events)"""
GROUPS = READINGS + """, groups AS (
  SELECT doc_id, field, key, count(DISTINCT segmentation) FILTER (WHERE NOT echo) AS support, bool_or(pass_id LIKE 'deterministic:%') AS deterministic,
         bool_or(pass_id = 'deterministic:definitions') AS from_definition, max(confidence) AS best, count(*) AS readings FROM readings GROUP BY ALL)"""
RANKED = GROUPS + """, ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, field ORDER BY from_definition DESC, deterministic DESC, support DESC, best DESC, key) AS rank,
  count(*) OVER (PARTITION BY doc_id, field) AS vals FROM groups)"""
KEYS = ["doc_id", "field"]


def readings(spark, sf_dir):
    i = F.col("event_id")
    tier = F.when(i % 7 == 0, "deterministic:rules").when(i % 29 == 0, "deterministic:definitions").otherwise("model:1")
    return read(spark, sf_dir, "events").select(
        F.col("user_id").alias("doc_id"), (i % 5).cast("string").alias("field"), F.col("event_type").alias("key"), F.dayofmonth("ts").cast("string").alias("segmentation"), (i % 11 == 0).alias("echo"),
        tier.alias("pass_id"), (i % 90 / 100).cast("decimal(10,4)").alias("confidence"), F.lit(None).cast("string").alias("external"),
    )


@query(f"WITH {GROUPS} SELECT * FROM groups")
def value_groups(spark, sf_dir):
    return R.value_groups(readings(spark, sf_dir), KEYS)


@query(f"""WITH {RANKED}, asked AS (SELECT doc_id, CAST(f AS VARCHAR) AS field FROM (SELECT DISTINCT user_id AS doc_id FROM events), range(6) r(f))
SELECT a.doc_id, a.field, CASE WHEN key IS NULL THEN 'needs_review' WHEN vals > 1 THEN 'conflicted' WHEN support < 2 AND NOT deterministic THEN 'needs_review' ELSE 'confirmed' END AS status,
       key AS value, coalesce(support, 0) AS support, CAST(CASE WHEN deterministic THEN least(0.99, greatest(best, 0.95)) ELSE round(least(0.99, 0.45 * best + 0.55 * least(support, 30) / 30), 4) END AS DECIMAL(10,4)) AS confidence,
       coalesce(vals, 0) AS "values" FROM asked a LEFT JOIN (SELECT * FROM ranked WHERE rank = 1) USING (doc_id, field)""")
def reconcile_fields(spark, sf_dir):
    r = readings(spark, sf_dir)
    asked = r.select("doc_id").distinct().select("doc_id", F.explode(F.array(*[F.lit(str(f)) for f in range(6)])).alias("field"))
    return R.reconcile(asked, r, KEYS, views=30)


@query(f"WITH {RANKED} SELECT doc_id, field, key, CAST(rank AS INT) AS rank, support FROM ranked WHERE vals > 1")
def conflicts(spark, sf_dir):
    return R.ranked(R.value_groups(readings(spark, sf_dir), KEYS), KEYS).where("values > 1").select("doc_id", "field", "key", "rank", "support")


@query(f"WITH {RANKED} SELECT doc_id, field, key FROM ranked WHERE support < 2 AND NOT deterministic")
def single_pass_discovery(spark, sf_dir):
    return R.value_groups(readings(spark, sf_dir), KEYS).where("support < 2 and not deterministic").select("doc_id", "field", "key")


@query(f"WITH {READINGS} SELECT doc_id, field, arg_max(key, (confidence, -strpos('abcdefghijklmnopqrstuvwxyz', key[1]))) AS value FROM readings GROUP BY doc_id, field")
def best_prior(spark, sf_dir):
    return R.best_prior(readings(spark, sf_dir), KEYS)


@query("""WITH v AS (SELECT p_size AS k, lower(p_name) AS key FROM part UNION SELECT p_size, concat('the ', lower(p_name)) FROM part WHERE p_partkey % 3 = 0)
SELECT a.k, a.key FROM v a WHERE NOT EXISTS (SELECT 1 FROM v b WHERE b.k = a.k AND length(b.key) > length(a.key) AND ends_with(b.key, a.key))""")
def name_fragments(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    v = p.select(F.col("p_size").alias("k"), F.lower("p_name").alias("key")).union(p.where("p_partkey % 3 = 0").select("p_size", F.concat(F.lit("the "), F.lower("p_name")))).distinct()
    return R.fragments_dropped(v, ["k"])


@query("""WITH f AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'confirmed' WHEN 1 THEN 'needs_review' ELSE 'conflicted' END AS status, CAST(substr(o_orderpriority, 1, 1) AS INT) AS criticality, CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_custkey % 50 AS DOUBLE) / 50 END AS confidence, CAST(o_custkey AS VARCHAR) AS value FROM orders)
SELECT o_orderkey, row_number() OVER (ORDER BY criticality DESC, coalesce(confidence, 0), o_orderkey) AS place, CASE WHEN status <> 'conflicted' THEN value END AS value FROM f WHERE status <> 'confirmed'""")
def review_queue(spark, sf_dir):
    """What is unsettled, gravest first and least certain first, with each item's place; a conflict shows no value."""
    k = F.col("o_orderkey")
    status = F.when(k % 3 == 0, "confirmed").when(k % 3 == 1, "needs_review").otherwise("conflicted")
    fields = read(spark, sf_dir, "orders").select("o_orderkey", status.alias("status"), F.substring("o_orderpriority", 1, 1).cast("int").alias("criticality"), F.when(k % 7 > 0, (F.col("o_custkey") % 50).cast("double") / 50).alias("confidence"), F.col("o_custkey").cast("string").alias("value"))
    return R.queue(R.review_queue(fields), ["gravity", "sure", "o_orderkey"]).select("o_orderkey", "place", "value")


STATE = "o_totalprice >= 150_000 and (o_orderstatus in [F, P] or not o_orderpriority == '1-URGENT')"


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice >= 150000 END AND (CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus IN ('F', 'P') END OR NOT (o_orderpriority = '1-URGENT')) AS holds FROM orders""")
def condition_3vl(spark, sf_dir):
    """A parsed condition over a state map from which some variables are missing."""
    k = F.col("o_orderkey")
    state = F.map_from_entries(F.filter(F.array(
        F.struct(F.lit("o_totalprice").alias("k"), F.when(k % 5 != 0, F.col("o_totalprice").cast("decimal(20,4)").cast("string")).alias("v")),
        F.struct(F.lit("o_orderstatus").alias("k"), F.when(k % 7 != 0, F.col("o_orderstatus")).alias("v")),
        F.struct(F.lit("o_orderpriority").alias("k"), F.col("o_orderpriority").alias("v")),
    ), lambda x: x["v"].isNotNull()))
    return read(spark, sf_dir, "orders").select("o_orderkey", C.condition(STATE, C.from_map(state)).alias("holds"))


@query("""WITH v AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS since, CAST(o_orderdate AS DATE) + 400 AS until, o_orderkey % 3 <> 0 AS cond, o_orderkey FROM orders),
at AS (SELECT DISTINCT o_custkey, DATE '1997-01-01' AS d FROM orders) SELECT a.o_custkey, min(o_orderkey) AS governing FROM v a WHERE DATE '1997-01-01' BETWEEN since AND until AND cond GROUP BY a.o_custkey""".replace("at AS (SELECT DISTINCT o_custkey, DATE '1997-01-01' AS d FROM orders) ", "").replace("FROM orders),\n", "FROM orders)\n"))
def variant_as_of(spark, sf_dir):
    """The first variant, in order of precedence, that governs at a date."""
    d = F.col("o_orderdate").cast("date")
    at = F.lit("1997-01-01").cast("date")
    ok = C.governs(C.in_window(at, d, F.date_add(d, 400)), F.col("o_orderkey") % 3 != 0)
    return read(spark, sf_dir, "orders").where(ok).groupBy("o_custkey").agg(F.min("o_orderkey").alias("governing"))


@query("""WITH v AS (SELECT o_custkey, o_orderkey AS k, CAST(o_orderdate AS DATE) AS since, CAST(o_orderdate AS DATE) + 200 AS until FROM orders)
SELECT a.o_custkey, a.k AS first_key, b.k AS second_key FROM v a JOIN v b ON a.o_custkey = b.o_custkey AND a.k < b.k AND a.since <= b.until AND b.since <= a.until""")
def variant_overlaps(spark, sf_dir):
    """Unconditional variants of one field whose windows overlap."""
    d = F.col("o_orderdate").cast("date")
    v = read(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("k"), d.alias("since"), F.date_add(d, 200).alias("until"))
    b = v.select("o_custkey", F.col("k").alias("k2"), F.col("since").alias("since2"), F.col("until").alias("until2"))
    return v.join(b, "o_custkey").where("k < k2 and since <= until2 and since2 <= until").select("o_custkey", F.col("k").alias("first_key"), F.col("k2").alias("second_key"))


ORDERED = ["l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
ROWS = f"""rows AS (SELECT l_orderkey AS doc_id, CAST(l_shipdate AS DATE) AS payment_date, CAST(l_extendedprice AS DECIMAL(20,2)) AS amount,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(ORDERED)}) AS INT) AS row_index FROM lineitem),
principals AS (SELECT o_orderkey AS doc_id, CAST(o_totalprice AS DECIMAL(20,2)) AS principal FROM orders)"""


def schedule(spark, sf_dir):
    li = P.numbered(read(spark, sf_dir, "lineitem").withColumn("doc_id", F.col("l_orderkey")), ["doc_id"], ORDERED)
    return li.select("doc_id", F.col("l_shipdate").cast("date").alias("payment_date"), F.col("l_extendedprice").cast("decimal(20,2)").alias("amount"), "row_index")


def principals(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_totalprice").cast("decimal(20,2)").alias("principal"))


@query(f"""WITH {ROWS}, t AS (SELECT *, sum(amount) OVER (PARTITION BY doc_id ORDER BY row_index ROWS UNBOUNDED PRECEDING) AS total FROM rows JOIN principals USING (doc_id)),
b AS (SELECT *, CAST(greatest(0, principal - total) AS DECIMAL(20,2)) AS after, CAST(greatest(0, principal - total + amount) AS DECIMAL(20,2)) AS before FROM t)
SELECT doc_id, row_index, payment_date, CAST(before - after AS DECIMAL(20,2)) AS paid, after AS balance FROM b""")
def schedule_generate(spark, sf_dir):
    return P.generated(schedule(spark, sf_dir), principals(spark, sf_dir), ["doc_id"], 0.05).drop("interest")


@query(f"""WITH {ROWS}, f AS (SELECT *, row_number() OVER (PARTITION BY doc_id, payment_date ORDER BY row_index) AS n FROM rows)
SELECT doc_id, payment_date, amount, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY payment_date) AS INT) AS row_index FROM f WHERE n = 1""")
def schedule_dedupe(spark, sf_dir):
    return P.deduplicated(schedule(spark, sf_dir), ["doc_id"], ["row_index"])


@query(f"""WITH {ROWS}, made AS (SELECT doc_id, payment_date, amount, row_index FROM rows WHERE row_index % 4 <> 0), printed AS (SELECT doc_id, payment_date, CASE WHEN row_index % 3 = 0 THEN amount + 1 ELSE amount END AS amount, row_index FROM rows WHERE row_index % 5 <> 0)
SELECT doc_id, row_index, m.payment_date AS made_date, m.amount AS made_amount, p.payment_date AS printed_date, p.amount AS printed_amount,
  CASE WHEN m.row_index IS NULL THEN 'extra' WHEN p.row_index IS NULL THEN 'missing' WHEN m.payment_date <> p.payment_date THEN 'date' WHEN m.amount <> p.amount THEN 'amount' END AS kind
FROM made m FULL JOIN printed p USING (doc_id, row_index) WHERE kind IS NOT NULL""")
def schedule_diff(spark, sf_dir):
    s = schedule(spark, sf_dir)
    printed = s.where("row_index % 5 <> 0").withColumn("amount", F.when(F.col("row_index") % 3 == 0, F.col("amount") + 1).otherwise(F.col("amount")).cast("decimal(20,2)"))
    return P.differences(s.where("row_index % 4 <> 0"), printed, ["doc_id"])


@query(f"WITH {ROWS}, w AS (SELECT *, lag(payment_date) OVER (PARTITION BY doc_id ORDER BY row_index) AS previous FROM rows) SELECT * FROM w WHERE payment_date <= previous")
def monotonic_dates(spark, sf_dir):
    return P.not_increasing(schedule(spark, sf_dir), ["doc_id"])


@query(f"""WITH {ROWS}, f AS (SELECT DISTINCT doc_id, payment_date FROM rows), g AS (SELECT *, q - lag(q) OVER (PARTITION BY doc_id ORDER BY payment_date) AS gap FROM (SELECT *, year(payment_date) * 4 + quarter(payment_date) - 1 AS q FROM f)),
c AS (SELECT doc_id, gap, count(*) AS c FROM g WHERE gap IS NOT NULL GROUP BY ALL), m AS (SELECT doc_id, arg_max(gap, (c, -gap)) AS usual, sum(c) AS n FROM c GROUP BY doc_id HAVING sum(c) >= 2)
SELECT doc_id, payment_date, CAST(gap AS INT) AS gap, CAST(usual AS INT) AS usual FROM g JOIN m USING (doc_id) WHERE gap <> usual""")
def even_spacing(spark, sf_dir):
    rows = schedule(spark, sf_dir).select("doc_id", "payment_date").distinct()
    return P.uneven(rows, ["doc_id"]).select("doc_id", "payment_date", F.col("gap").cast("int").alias("gap"), F.col("usual").cast("int").alias("usual"))


@query(f"WITH {ROWS}, s AS (SELECT doc_id, count(*) AS rows, max(q) - min(q) + 1 AS quarters FROM (SELECT doc_id, year(payment_date) * 4 + quarter(payment_date) AS q FROM rows) GROUP BY doc_id) SELECT * FROM s WHERE rows <> quarters")
def row_count_vs_quarters(spark, sf_dir):
    return P.counts_off(schedule(spark, sf_dir), ["doc_id"])


@query(f"WITH {ROWS} SELECT doc_id, CAST(sum(amount) AS DECIMAL(20,2)) AS scheduled, principal FROM rows JOIN principals USING (doc_id) GROUP BY doc_id, principal HAVING sum(amount) > principal")
def sums_to_principal(spark, sf_dir):
    return P.totals_off(schedule(spark, sf_dir), principals(spark, sf_dir), ["doc_id"])


@query("""WITH c AS (SELECT l_suppkey AS doc_id, CAST(l_quantity AS DECIMAL(20,2)) AS amount, count(*) AS c FROM lineitem GROUP BY ALL)
SELECT doc_id, arg_max(amount, (c, -amount)) AS amount, max(c) AS times, count(*) AS levels FROM c GROUP BY doc_id""")
def level_payment(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("doc_id"), F.col("l_quantity").cast("decimal(20,2)").alias("amount"))
    return P.level_payment(rows, ["doc_id"])


@query(f"WITH {ROWS}, w AS (SELECT doc_id, row_index, amount, lag(amount) OVER (PARTITION BY doc_id ORDER BY row_index) AS previous FROM rows) SELECT * FROM w WHERE amount > previous")
def covenant_monotonic(spark, sf_dir):
    return P.rising(schedule(spark, sf_dir).select("doc_id", "row_index", "amount"), ["doc_id"], "row_index", "amount")


BANDS = """bands AS (SELECT DISTINCT p_brand AS doc_id, p_size AS above, CASE WHEN p_partkey % 4 = 0 THEN p_size + 2 ELSE p_size + 1 END AS upto FROM part)"""


@query(f"""WITH {BANDS}, w AS (SELECT *, lead(above) OVER (PARTITION BY doc_id ORDER BY above, upto) AS next_above FROM bands)
SELECT *, CASE WHEN upto < next_above THEN 'gap' ELSE 'overlap' END AS fault FROM w WHERE next_above IS NOT NULL AND upto <> next_above""")
def grid_bands(spark, sf_dir):
    upto = F.when(F.col("p_partkey") % 4 == 0, F.col("p_size") + 2).otherwise(F.col("p_size") + 1)
    return P.band_faults(read(spark, sf_dir, "part").select(F.col("p_brand").alias("doc_id"), F.col("p_size").alias("above"), upto.alias("upto")).distinct(), ["doc_id"])


#: A term a customer: each uses the term of half its number, and those of the first nations the one of twice it.
EDGES = "edges AS (SELECT c_custkey AS src, c_custkey // 2 AS dst FROM customer WHERE c_custkey >= 2 UNION SELECT c_custkey, c_custkey * 2 FROM customer WHERE c_nationkey < 5)"


def edges(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    up = c.where("c_custkey >= 2").select(F.col("c_custkey").alias("src"), F.expr("c_custkey div 2").alias("dst"))
    return up.union(c.where("c_nationkey < 5").select("c_custkey", F.col("c_custkey") * 2)).distinct()


def closed(depth: int) -> str:
    """Reaching within depth steps; 64 are more than any shortest way here has."""
    return f"""WITH RECURSIVE {EDGES}, nodes AS (SELECT src AS start FROM edges UNION SELECT dst FROM edges),
r AS (SELECT start, start AS node, 0 AS depth FROM nodes UNION SELECT r.start, e.dst, r.depth + 1 FROM r JOIN edges e ON r.node = e.src WHERE r.depth < {depth}), c AS (SELECT start, node, min(depth) AS depth FROM r GROUP BY start, node)"""


CLOSED = closed(64)


@query(f"{closed(8)} SELECT start, node, CAST(depth AS INT) AS depth FROM c")
def definition_closure(spark, sf_dir):
    e = edges(spark, sf_dir)
    starts = e.select(F.col("src").alias("start")).unionByName(e.select(F.col("dst").alias("start"))).distinct()
    return G.closure(e, starts)


@query(f"{CLOSED} SELECT start, node, CAST(depth AS INT) AS depth FROM c WHERE depth > 0 AND node % 9 = 0")
def external_refs(spark, sf_dir):
    e = edges(spark, sf_dir)
    ends = e.select(F.col("src").alias("start")).unionByName(e.select(F.col("dst").alias("start"))).distinct()
    external = ends.where("start % 9 = 0").select(F.col("start").alias("node"))
    return G.external_references(e, ends, external).select("start", "node", "depth")


@query(f"{CLOSED}, b AS (SELECT e.src AS node, min(c.depth) + 1 AS length FROM edges e JOIN c ON c.start = e.dst AND c.node = e.src GROUP BY e.src) SELECT node, CAST(length AS INT) AS length FROM b")
def definition_cycles(spark, sf_dir):
    return G.on_cycles(edges(spark, sf_dir))


@query(f"{CLOSED} SELECT a.start AS node, min(a.node) AS component FROM c a JOIN c b ON a.start = b.node AND a.node = b.start GROUP BY a.start")
def reachability_components(spark, sf_dir):
    return G.mutual(edges(spark, sf_dir))


#: Longest chains of the groups of terms that use one another.
CHAINS = f"""{CLOSED}, g AS (SELECT a.start AS node, min(a.node) AS component FROM c a JOIN c b ON a.start = b.node AND a.node = b.start GROUP BY a.start),
ge AS (SELECT DISTINCT x.component AS a, y.component AS b FROM edges e JOIN g x ON e.src = x.node JOIN g y ON e.dst = y.node WHERE x.component <> y.component),
l AS (SELECT component, 0 AS depth FROM g UNION SELECT ge.a, l.depth + 1 FROM l JOIN ge ON ge.b = l.component), d AS (SELECT g.node, max(l.depth) AS depth FROM g JOIN l ON g.component = l.component GROUP BY g.node)"""


@query(f"{CHAINS} SELECT node, CAST(depth AS INT) AS depth FROM d")
def definition_depths(spark, sf_dir):
    return G.depths(edges(spark, sf_dir))


@query(f"""{CHAINS} SELECT (SELECT count(*) FROM edges) AS edges, (SELECT count(*) FROM nodes) AS terms, (SELECT CAST(max(depth) AS INT) FROM d) AS max_depth, (SELECT count(*) FROM d WHERE depth >= 3) AS deep,
  (SELECT count(DISTINCT e.src) FROM edges e JOIN c ON c.start = e.dst AND c.node = e.src) AS on_cycles""")
def graph_stats(spark, sf_dir):
    return G.stats(edges(spark, sf_dir))


@query(f"WITH {EDGES}, n AS (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY dst) AS n FROM edges) SELECT src, string_agg(CAST(dst AS VARCHAR), '; ' ORDER BY n) AS basis FROM n WHERE n <= 3 GROUP BY src")
def governing_basis(spark, sf_dir):
    return G.governing(edges(spark, sf_dir).withColumn("ix", F.lit(0)))
