"""Calibration, splits, coverage and scoring over labels, documents, conversations and orders."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.functions.scalars import content_words
from spanforge.operators import evaluate as E
from spanforge.operators import scoring as S
from spanforge.plans.base import query, read, spread

SAMPLES = "samples AS (SELECT lang AS field_class, CAST((n_chars % 1000) / 1000.0 AS DOUBLE) AS p, quality = 1 AS correct, doc_id FROM labels JOIN documents USING (doc_id))"


def samples(spark, sf_dir):
    j = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents", "doc_id", "lang", "n_chars"), "doc_id")
    return j.select(F.col("lang").alias("field_class"), (F.col("n_chars") % 1000 / 1000).alias("p"), (F.col("quality") == 1).alias("correct"), "doc_id")


BOUND = "CASE WHEN n = 0 OR k = 0 THEN 0 ELSE greatest(0, (k / n + 3.8416 / (2 * n) - 1.96 * sqrt(k / n * (1 - k / n) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n)) END"
SWEEP = f"""WITH {SAMPLES}, b AS (SELECT field_class, CAST(round(p, 4) AS DECIMAL(6,4)) AS t, count(*) AS c, count(*) FILTER (WHERE correct) AS kk FROM samples GROUP BY 1, 2),
r AS (SELECT field_class, t, CAST(sum(c) OVER w AS DOUBLE) AS n, CAST(sum(kk) OVER w AS DOUBLE) AS k FROM b WINDOW w AS (PARTITION BY field_class ORDER BY t DESC ROWS UNBOUNDED PRECEDING)),
s AS (SELECT field_class, t, CAST(n AS BIGINT) AS n, CAST(k AS BIGINT) AS "right", CAST({BOUND} AS DECIMAL(12,8)) AS bound FROM r)"""


@query(f"""WITH {SAMPLES}, a AS (SELECT field_class, count(*) AS n, count(*) FILTER (WHERE p >= 0.8) AS accepted, count(*) FILTER (WHERE p >= 0.8 AND correct) AS k, count(*) FILTER (WHERE correct) AS c FROM samples GROUP BY 1)
SELECT field_class, n, accepted, CAST(CASE WHEN accepted = 0 THEN 1 ELSE k / accepted END AS DECIMAL(12,8)) AS precision, CAST(CASE WHEN c = 0 THEN 0 ELSE k / c END AS DECIMAL(12,8)) AS recall, CAST(accepted / n AS DECIMAL(12,8)) AS coverage FROM a""")
def evaluate_threshold(spark, sf_dir):
    return E.at_threshold(samples(spark, sf_dir), ["field_class"], 0.8)


@query(SWEEP + " SELECT * FROM s")
def threshold_sweep(spark, sf_dir):
    return E.sweep(samples(spark, sf_dir), ["field_class"])


@query(SWEEP + """, ok AS (SELECT field_class, min(t) AS t_ok FROM s WHERE bound >= 0.75 GROUP BY 1), best AS (SELECT field_class, arg_max(t, (bound, t)) AS t, max(bound) AS bound FROM s GROUP BY 1)
SELECT field_class, CAST(coalesce(t_ok, CASE WHEN bound = 0 THEN 1.0001 ELSE t END) AS DECIMAL(6,4)) AS threshold, t_ok IS NOT NULL AS met FROM best LEFT JOIN ok USING (field_class)""")
def fit_threshold(spark, sf_dir):
    return E.fit(samples(spark, sf_dir), ["field_class"], 0.75)


@query("""WITH r AS (SELECT doc_id, source, CAST(doc_id AS VARCHAR) AS name, count(*) OVER (PARTITION BY source) AS n, row_number() OVER (PARTITION BY source ORDER BY sha256(CAST(doc_id AS VARCHAR)), CAST(doc_id AS VARCHAR)) AS r FROM documents)
SELECT doc_id, source, CASE WHEN n >= 2 AND r <= greatest(1, n // 3) THEN 'holdout' ELSE 'fit' END AS side FROM r""")
def split_holdout_hash(spark, sf_dir):
    d = read(spark, sf_dir, "documents", "doc_id", "source").withColumn("name", F.col("doc_id").cast("string"))
    return E.holdout(d, "source", "name").select("doc_id", "source", "side")


OUTCOMES = "outcomes AS (SELECT lang AS family, quality = 1 AS passed, toxic = 0 AS confident FROM labels JOIN documents USING (doc_id)), register(family) AS (VALUES ('de'), ('en'), ('es'), ('fr'), ('it'))"
FAMILIES = f"""WITH {OUTCOMES}, c AS (SELECT family, count(passed) AS n, count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed, count(*) FILTER (WHERE confident) AS confident, count(*) FILTER (WHERE confident AND NOT passed) AS confident_wrong
  FROM register LEFT JOIN outcomes USING (family) GROUP BY ROLLUP (family)),
f AS (SELECT coalesce(family, 'all') AS family, n, passed, failed, confident, confident_wrong, CAST(CASE WHEN confident = 0 THEN 0 ELSE confident_wrong / confident END AS DECIMAL(12,8)) AS silent FROM c)"""


def family_counts(spark, sf_dir):
    j = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents", "doc_id", "lang"), "doc_id")
    o = j.select(F.col("lang").alias("family"), (F.col("quality") == 1).alias("passed"), (F.col("toxic") == 0).alias("confident"))
    return E.families(o, spark.createDataFrame([(x,) for x in ("de", "en", "es", "fr", "it")], "family string"))


@query(FAMILIES + " SELECT * FROM f")
def family_coverage(spark, sf_dir):
    return family_counts(spark, sf_dir)


@query(FAMILIES + " SELECT *, CASE WHEN n < 5 THEN 'too few' ELSE 'silent errors' END AS why FROM f WHERE n < 5 OR silent > 0.1")
def family_gate(spark, sf_dir):
    return E.over_budget(family_counts(spark, sf_dir), 0.1, 5)


ARMS = "arms AS (SELECT CAST(event_id % 60 AS VARCHAR) AS assertion, CAST(event_id % 4 AS VARCHAR) AS arm, user_id AS document, value > 50 AS confident, event_type = 'click' AS passed FROM events)"


def arms(spark, sf_dir):
    i = F.col("event_id")
    return read(spark, sf_dir, "events").select((i % 60).cast("string").alias("assertion"), (i % 4).cast("string").alias("arm"), F.col("user_id").alias("document"), (F.col("value") > 50).alias("confident"), (F.col("event_type") == "click").alias("passed"))


@query(f"WITH {ARMS} SELECT assertion, count(DISTINCT (coalesce(confident, false), passed)) AS kinds, count(*) AS arms FROM arms GROUP BY 1 HAVING count(DISTINCT (coalesce(confident, false), passed)) > 1")
def arm_disagreements(spark, sf_dir):
    return E.disagreements(arms(spark, sf_dir).withColumn("confident", F.coalesce("confident", F.lit(False))))


@query(f"WITH {ARMS} SELECT document FROM arms GROUP BY 1 HAVING count(DISTINCT arm) = (SELECT count(DISTINCT arm) FROM arms)")
def arm_documents(spark, sf_dir):
    return E.common_documents(arms(spark, sf_dir))


@query(f"WITH {ARMS} SELECT arm, count(*) AS n, count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE confident AND NOT passed) AS confident_wrong FROM arms GROUP BY 1")
def arm_metrics(spark, sf_dir):
    return arms(spark, sf_dir).groupBy("arm").agg(F.count("*").alias("n"), F.count_if("passed").alias("passed"), F.count_if(F.col("confident") & ~F.col("passed")).alias("confident_wrong"))


@query("SELECT CAST(doc_id % 5 AS INT) AS support, count(*) FILTER (WHERE quality = 1) AS passed, count(*) FILTER (WHERE quality <> 1) AS failed FROM labels GROUP BY 1")
def support_buckets(spark, sf_dir):
    return E.support_buckets(read(spark, sf_dir, "labels").select((F.col("doc_id") % 5).cast("int").alias("support"), (F.col("quality") == 1).alias("passed")))


@query("""WITH b AS (SELECT count(*) FILTER (WHERE doc_id % 5 < 2) AS n_below, count(*) FILTER (WHERE doc_id % 5 < 2 AND quality = 1) AS right_below FROM labels)
SELECT *, CASE WHEN n_below < 10 THEN 'INCONCLUSIVE' WHEN right_below * 20 >= n_below * 19 THEN 'LOWER' ELSE 'KEEP' END AS advice FROM b""")
def floor_advice(spark, sf_dir):
    return E.floor_advice(support_buckets(spark, sf_dir), 2)


STATEMENTS = """st AS (SELECT item_id, list_filter(list_transform(regexp_extract_all(lower(text), '([a-z0-9][a-z0-9.,%$-]*)', 1), lambda w: regexp_replace(w, '[.,;:]+$', '')), lambda w: length(w) > 1) AS words FROM benchmark)"""


#: A figure as it is, without ending zeros, and as hundredths; null if it is none.
SHORT = "regexp_replace(regexp_replace(CAST(CAST({0} AS DECIMAL(30,6)) AS VARCHAR), '(\\.[0-9]*?)0+$', '\\1'), '\\.$', '')"
N = "TRY_CAST(regexp_replace(w, '[$,%]', '', 'g') AS DECIMAL(20,6))"
FORMS = f"CASE WHEN {N} IS NOT NULL THEN [regexp_replace(w, '[$,%]', '', 'g'), {SHORT.format(N)}, {SHORT.format(N + ' * 100')}] END"


@query(f"""WITH {STATEMENTS}, x AS (SELECT d.doc_id, item_id, lower(coalesce(d.text, '')) AS t, list_transform(list_filter(words, lambda w: regexp_matches(w, '[0-9]')), lambda w: list_concat([w], coalesce({FORMS}, [regexp_replace(w, '[$,%]', '', 'g')]))) AS f, list_filter(words, lambda w: NOT regexp_matches(w, '[0-9]')) AS p FROM st, documents d WHERE len(words) > 0),
y AS (SELECT doc_id, item_id, CASE WHEN len(f) > 0 THEN len(list_filter(f, lambda ws: len(list_filter(ws, lambda w: contains(t, w))) > 0)) / len(f) END AS a, CASE WHEN len(p) > 0 THEN len(list_filter(p, lambda w: contains(t, w))) / len(p) END AS b FROM x)
SELECT doc_id, item_id, CAST(coalesce(0.75 * a + 0.25 * b, a, b, 0) AS DECIMAL(10,6)) AS support FROM y""")
def lexical_support(spark, sf_dir):
    """Every document against every item: the items are the stated questions."""
    st = read(spark, sf_dir, "benchmark").select("item_id", content_words(F.col("text"), []).alias("words")).where("size(words) > 0")
    plain, figures = S.statement_forms(F.col("words"))
    st = st.select("item_id", plain.alias("plain"), figures.alias("figures"))
    d = spread(read(spark, sf_dir, "documents", "doc_id", "text"), "doc_id").withColumn("t", F.lower(F.coalesce("text", F.lit(""))))
    return S.support(d, st).select("doc_id", "item_id", F.col("support").cast("decimal(10,6)").alias("support"))


CONCEPT = "least(0.97, 0.02 + 0.32 * (CAST(contains(t, 'the') AS INT) + CAST(contains(t, 'keit') AS INT) + CAST(contains(t, 'ción') AS INT)))"
CHUNKED = f"""chunks AS (SELECT doc_id, CAST(s // 4200 AS INT) AS chunk, lower(substr(text, CAST(s + 1 AS BIGINT), 6000)) AS t
  FROM (SELECT doc_id, text, unnest(range(0, CAST(ceil(greatest(0, length(text) - 6000) / 4200) * 4200 AS BIGINT) + 1, 4200)) AS s FROM documents WHERE length(text) > 0)),
scored AS (SELECT doc_id, chunk, CAST({CONCEPT} AS DECIMAL(10,6)) AS p FROM chunks)"""


def presence(spark, sf_dir):
    from spanforge.operators.spans import sliding

    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    part = F.lower(F.substring("text", F.col("start") + 1, F.col("end") - F.col("start")))
    score = S.concept_score(part, ["the", "keit", "ción"]).cast("decimal(10,6)")
    return sliding(docs, ["doc_id"]).join(docs, "doc_id").select("doc_id", F.col("ix").alias("chunk"), score.alias("p"))


@query(f"WITH {CHUNKED} SELECT * FROM scored")
def concept_presence(spark, sf_dir):
    return presence(spark, sf_dir)


@query(f"WITH {CHUNKED} SELECT doc_id, count(p) AS asked, CAST(1 - max(p) AS DECIMAL(10,6)) AS absent, arg_max(chunk, (p, -chunk)) AS witness FROM scored GROUP BY doc_id")
def negative_space(spark, sf_dir):
    return S.absence(presence(spark, sf_dir), ["doc_id"])


@query(f"""WITH {CHUNKED}, a AS (SELECT doc_id, CAST(1 - max(p) AS DECIMAL(10,6)) AS absent FROM scored GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN a.absent IS NULL THEN 'not_asked' WHEN d.doc_id % 17 = 0 THEN 'untypable' WHEN d.doc_id % 13 = 0 THEN 'per_tranche' WHEN d.doc_id % 11 = 0 THEN 'unsettled' WHEN a.absent >= 0.6 THEN 'absent_from_document' ELSE 'needs_review' END AS verdict
FROM documents d LEFT JOIN a USING (doc_id)""")
def absence_verdicts(spark, sf_dir):
    i = F.col("doc_id")
    f = read(spark, sf_dir, "documents", "doc_id").join(negative_space(spark, sf_dir), "doc_id", "left").withColumns({"untypable": i % 17 == 0, "per_tranche": i % 13 == 0, "unsettled": i % 11 == 0})
    return S.absence_verdict(f, 0.6).select("doc_id", "verdict")


@query("""WITH q AS (SELECT conv_id, turn, CAST(greatest(1, ceil(length(text) / 4)) AS BIGINT) AS tokens FROM conversations WHERE text IS NOT NULL),
r AS (SELECT *, CAST(floor(coalesce(sum(tokens) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 40) AS INT) AS batch FROM q) SELECT conv_id, turn AS ix, tokens, batch FROM r""")
def question_batches(spark, sf_dir):
    q = read(spark, sf_dir, "conversations").where("text is not null").select("conv_id", F.col("turn").alias("ix"), F.greatest(F.lit(1), F.ceil(F.length("text") / 4)).cast("long").alias("tokens"))
    return S.batches(q, ["conv_id"], 40)


@query("""WITH r AS (SELECT o_custkey, o_orderkey AS ix, CAST(o_totalprice AS DECIMAL(20,2)) AS cost, CAST(sum(CAST(o_totalprice AS DECIMAL(20,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS DECIMAL(30,2)) AS running FROM orders)
SELECT * FROM r WHERE running <= 500000""")
def budget_cut(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("ix"), F.col("o_totalprice").cast("decimal(20,2)").alias("cost"))
    return S.spent(o, ["o_custkey"], F.lit(500000))


@query("""WITH s AS (SELECT p_partkey, p_size / 50.0 AS a, (p_partkey % 50) / 50.0 AS b FROM part) SELECT p_partkey, CASE WHEN round((a + 1e-6) / (a + b + 0.3 + 3e-6), 4) >= greatest(round((b + 1e-6) / (a + b + 0.3 + 3e-6), 4), round((0.3 + 1e-6) / (a + b + 0.3 + 3e-6), 4)) THEN 'first'
  WHEN round((b + 1e-6) / (a + b + 0.3 + 3e-6), 4) >= round((0.3 + 1e-6) / (a + b + 0.3 + 3e-6), 4) THEN 'second' ELSE 'none' END AS chosen FROM s""")
def conflict_choice(spark, sf_dir):
    _, best = S.choice({"first": F.col("p_size") / 50, "second": F.col("p_partkey") % 50 / 50, "none": F.lit(0.3)})
    return read(spark, sf_dir, "part").select("p_partkey", best.alias("chosen"))


@query("""SELECT lang, count(*) AS documents, CAST(median(n_chars) AS DOUBLE) AS median_chars, max(n_chars) AS most_chars FROM documents GROUP BY lang""")
def corpus_summary(spark, sf_dir):
    return read(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("documents"), F.median("n_chars").cast("double").alias("median_chars"), F.max("n_chars").alias("most_chars"))


@query("""WITH r AS (SELECT conv_id, sha256(text) AS key, turn, row_number() OVER (PARTITION BY sha256(text) ORDER BY conv_id DESC, turn DESC) AS n FROM conversations WHERE text IS NOT NULL) SELECT key, conv_id, turn FROM r WHERE n = 1""")
def answer_store_latest(spark, sf_dir):
    """Insert or replace: the last answer of each key."""
    c = read(spark, sf_dir, "conversations").where("text is not null").select(F.sha2("text", 256).alias("key"), "conv_id", "turn")
    return c.withColumn("n", F.row_number().over(W.partitionBy("key").orderBy(F.desc("conv_id"), F.desc("turn")))).where("n = 1").drop("n")
