"""Steps of round 3 that must not grow faster than the tables: what their plans hold, and the same results on odd input."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from spanforge.operators import extract as X
from spanforge.operators import spans as O


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


TEXTS = [(1, "“A Term” means the B Term. “B Term” means 5%. “A Term” means C. dated as of May 1, 2020, dated as of May 2, 2020"), (2, None), (3, ""), (None, "“A Term” means it."), (4, "𝒳 “Fee Rate” means 1% of the Fee Letter and A Term.")]


def test_texts_are_read_where_they_are(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    for df in (X.definitions(docs), X.edges(docs), X.rule_readings(docs), O.matches(docs, "[0-9]+%", ["doc_id"])):
        assert "Exchange" not in plan(df) and "Window" not in plan(df)
    assert {tuple(r)[:4] for r in X.definitions(docs).collect()} == {(1, "A Term", 0, 27), (1, "B Term", 27, 46), (4, "Fee Rate", 2, 51)}
    assert {tuple(r) for r in X.edges(docs).collect()} == {(1, "A Term", "B Term")} == {tuple(r) for r in X.uses(X.definitions(docs)).collect()}
    assert [(r.doc_id, r.start, r.end) for r in X.rule_readings(docs).collect()] == [(1, k, k + 23) for k in (TEXTS[0][1].index("dated"), TEXTS[0][1].rindex("dated"))]
    assert [tuple(r) for r in O.matches(docs, "[0-9]+%", ["doc_id"]).collect()] == [(1, 0, "5%", 42, 44), (4, 0, "1%", 19, 21)]


def test_anchors_are_sent_to_the_definitions(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    anchors = spark.createDataFrame([("pik.rate_pct", "a term", 1), ("pik.rate_pct", "b term", 0), ("mfn_threshold_pct", "Fee Rate", 0)], "field string, anchor string, ix int")
    got = X.definition_readings(X.definitions(docs), anchors, {"pik.rate_pct": "percent", "mfn_threshold_pct": "percent"})
    assert "SortMergeJoin" not in plan(got)
    assert {(r.doc_id, r.field, r.key, r.external) for r in got.collect()} == {(1, "pik.rate_pct", "5", None), (4, "mfn_threshold_pct", "1", None)}


def test_sections_are_looked_up_once_for_all_kinds(spark):
    docs = spark.createDataFrame([(1, "SECTION 1.01 a. SECTION 2.01 Notwithstanding Section 1.01, b. Subject to Section 3.01 c."), (2, "Except as in Section 1.01")], "doc_id long, text string")
    marks = O.matches(docs, r"SECTION [0-9]+\.[0-9]+", ["doc_id"]).select("doc_id", F.substring("match", 9, 4).alias("section"), "start")
    got = X.precedence(docs, marks)
    assert plan(got).count("+- Window") + plan(got).count("   Window") == 1
    assert {tuple(r) for r in got.collect()} == {(1, "1.01", "2.01", "notwithstanding"), (1, "2.01", "3.01", "subject_to")}


def test_slots_are_filled_without_joins(spark):
    from spanforge.operators import agreement as A

    f = spark.createDataFrame([(1, "closing_date", "confirmed", "a"), (1, "closing_date", None, "b"), (2, "other", "confirmed", "c"), (None, "closing_date", "confirmed", "d"), (1, None, "confirmed", "e")], "doc_id long, field string, status string, value string")
    got = A.record(f)
    assert "Join" not in plan(got)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == 3 * len(A.SLOTS) + 1
    assert [r for r in sorted(rows, key=str) if r[1] == "metadata.closing_date"] == [(1, "metadata.closing_date", "confirmed", "a", "closing_date"), (1, "metadata.closing_date", "needs_review", "b", "closing_date"), (2, "metadata.closing_date", "needs_review", None, "closing_date"), (None, "metadata.closing_date", "needs_review", None, "closing_date")]
    assert all(r[2] == "needs_review" and r[3] is None for r in rows if r[1] != "metadata.closing_date")


def test_readings_are_made_once(spark):
    from spanforge.operators import reconcile as R

    r = [("d", "a", "x", "s", False, "model:1", 0.5, None), ("d", "a", "y", "s", False, "deterministic:rules", None, None), ("d", "a", "w", "s", False, "deterministic:rules", 0.1, None), ("d", "b", None, "s", False, "model:1", 0.5, "Fee Letter"), ("d", "c", None, "s", False, "model:1", 0.5, None), ("d", "e", "v", "s", True, None, 0.5, None), ("d", "e", "v", "t", False, "model:1", 0.5, None)]
    readings = spark.createDataFrame(r, "doc_id string, field string, key string, segmentation string, echo boolean, pass_id string, confidence double, external string").where("segmentation <> 'none'")
    asked = spark.createDataFrame([("d", f) for f in "abcef"], "doc_id string, field string")
    got = R.reconcile(asked, readings, ["doc_id", "field"], views=3)
    assert plan(got).count("Scan ExistingRDD") == 2  # what is asked, and the readings
    assert plan(got).count("Exchange hashpartitioning") == 2
    assert {(x.field, x.status, x.value, x["values"], x.support) for x in got.collect()} == {("a", "conflicted", "w", 3, 1), ("b", "external_reference", None, 0, 0), ("c", "needs_review", None, 0, 0), ("e", "needs_review", "v", 1, 1), ("f", "needs_review", None, 0, 0)}


def test_closures_keep_to_their_documents(spark):
    from spanforge.operators import contexts as C
    from spanforge.operators import graphs as G

    rng = random.Random(7)
    defs = [(d, f"T{k}", 10 * k, 10 * k + rng.randrange(1, 30)) for d in range(6) for k in range(12)]
    pairs = sorted({(d, f"T{rng.randrange(12)}", f"T{rng.randrange(14)}") for d in range(6) for _ in range(14)})
    d, e = spark.createDataFrame(defs, "doc_id long, term string, start long, end long"), spark.createDataFrame(pairs, "doc_id long, src string, dst string")
    got = C.closures(d, e, 60)
    assert plan(got).count("Scan ExistingRDD") == 2  # the definitions and the edges, no levels that were kept
    name = lambda c: F.struct("doc_id", F.col(c).alias("t"))
    reached = G.closure(e.select(name("src").alias("src"), name("dst").alias("dst")), d.select(F.struct("doc_id", F.col("term").alias("t")).alias("start"))).collect()
    size = {(doc, t): b - a for doc, t, a, b in defs}
    want = set()
    for start in size:
        used = 0
        for ix, (_, t) in enumerate(sorted((r.depth, tuple(r.node)) for r in reached if tuple(r.start) == start and tuple(r.node) in size), 1):
            used += size[t]
            if used <= 60:
                want.add((start[0], start[1], ix, t[1]))
    assert {(r.doc_id, r.anchor, r.ix, r.term) for r in got.collect()} == want


def test_clauses_stop_in_one_pass():
    from time import process_time

    from spanforge.operators import outline as L

    text = "".join(f"\n(a) x{k} (i) one or (ii) two and (b) last (c) {k}" for k in range(40)) + "".join(f" ({'ivxl'[k % 4]})" for k in range(400))
    found = L.clauses(text)
    for k, c in enumerate(found):
        assert c.stop == next((b.start for b in found[k + 1 :] if b.level <= c.level), len(text))
    assert L.paths(found) == [L.path(found, k) for k in range(len(found))]
    deep = "".join(f" (1) a{k}" + "".join(f" ({n}) b" for n in range(2, 99)) for k in range(60))
    began = process_time()
    assert len(L.clauses("(a) all" + deep)) > 90 and process_time() - began < 10
    assert L.heaviest_rise([(1,), (2,), (3,)], [1, 1, 1]) == [0, 1, 2] and L.heaviest_rise([(1,), (1,)], [1, 1]) == [0]
    assert "lru_cache" not in str(type(L.ordinals))


def test_agreements_are_dealt_over_tasks(spark):
    from spanforge.plans import economics_queries as E
    from spanforge.plans import structure_queries as S
    from spanforge.plans import terms_queries as T

    for df in (S.agreements(spark, "/root/testdata/sf0.001"), E.maturity_chain(spark, "/root/testdata/sf0.001"), T.symbolic_dates(spark, "/root/testdata/sf0.001")):
        assert "REPARTITION_BY_NUM" in plan(df) and "InPandas" not in plan(df)


def test_pairs_of_tables_and_regions_are_dealt(spark, monkeypatch):
    from spanforge.operators import readings as R

    rng = random.Random(3)
    t = [(k % 2, k, a := rng.randrange(6_000), a + rng.randrange(300)) for k in range(400)]
    r = [(k % 2, k, a := rng.randrange(-500, 6_000), a + rng.randrange(2_500)) for k in range(200)]
    want = {(k, region, table) for k, table, a, b in t for j, region, c, d in r if j == k and c <= a and b <= d}
    monkeypatch.setattr(R, "PAIRS", 50)
    got = R.contained_tables(spark.createDataFrame(t, "k int, table int, start int, end int"), spark.createDataFrame(r, "k int, region int, start int, end int"), ["k"])
    rows = [tuple(x) for x in got.collect()]
    assert len(rows) == len(want) and set(rows) == want
    assert "REPARTITION_BY_NUM" in plan(got) and "BroadcastHashJoin" not in plan(got).split("ShuffledHashJoin")[0]
    none = R.contained_tables(spark.createDataFrame([], "k int, table int, start int, end int"), spark.createDataFrame(r, "k int, region int, start int, end int"), ["k"])
    assert none.count() == 0


def test_support_reads_a_text_once_for_all_questions(spark):
    from spanforge.functions.scalars import content_words
    from spanforge.operators import scoring as S

    said = ["the fee is 5.50% of $1,000.00 in all", "co-operate 12 x", "figures 7% 7%", "ab ab cd", "no such thing-um"]
    texts = ["the fee: 5.5% of 1000", "x" * 30 + "12cooperate co-operate " + "z-operate", "", "0.07 abc d", "the 550 7 something-umbrella", "É abİcd $1,000.00."]
    q = spark.createDataFrame(list(enumerate(said)), "item_id int, s string").select("item_id", content_words(F.col("s"), []).alias("words"))
    plain, figures = S.statement_forms(F.col("words"))
    q = q.select("item_id", plain.alias("plain"), figures.alias("figures"))
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").withColumn("t", F.lower("text"))
    got, one_by_one = S.support(d, q), S.support(d, q, block=2)
    assert "NestedLoopJoin" not in plan(got)
    want = {(r.doc_id, r.item_id): r.s for r in S.against(d, q).select("doc_id", "item_id", S.lexical_support(F.col("t"), F.col("plain"), F.col("figures")).alias("s")).collect()}
    for df in (got, one_by_one):
        assert {(r.doc_id, r.item_id): r.support for r in df.collect()} == want


def test_levels_of_a_graph_have_tasks_by_their_rows(spark, monkeypatch):
    from spanforge.operators import graphs as G

    monkeypatch.setattr(G, "TASK_ROWS", 10)
    rng = random.Random(5)
    e = {(rng.randrange(30), rng.randrange(30)) for _ in range(60)}
    got = G.closure(spark.createDataFrame(sorted(e), "src int, dst int"), spark.range(30).select(F.col("id").cast("int").alias("start")), None)
    want = {}
    for s in range(30):
        level, d = {s}, 0
        while level:
            want |= {(s, y): d for y in level}
            level, d = {y for x in level for a, y in e if a == x and (s, y) not in want}, d + 1
    assert sorted((r.start, r.node, r.depth) for r in got.collect()) == sorted((*k, d) for k, d in want.items())
    assert got.rdd.getNumPartitions() > 30


def test_facts_are_dealt_by_rows_before_they_are_sorted(spark, monkeypatch):
    import re

    from spanforge.plans import assertion_queries as Q
    from spanforge.plans import base

    folder = "/root/testdata/sf0.001"
    monkeypatch.setattr(base, "TASK_ROWS", 500)
    rows = sum(spark.read.parquet(f"{folder}/{t}.parquet").count() for t in ("orders", "lineitem"))
    df = Q.assertion_outcomes(spark, folder)
    lines = [(len(re.match(r"[\s:|+-]*", x)[0]), x) for x in plan(df).splitlines()]
    for k, (depth, x) in enumerate(lines):
        if "FileScan" in x:
            for at, above in reversed(lines[:k]):
                if at < depth:
                    depth = at
                    if "Exchange" in above:
                        break
                    assert "Sort" not in above and "Aggregate" not in above, above
    dealt = re.findall(r"Exchange hashpartitioning\(.*, (\d+)\), (\w+)", plan(df))
    assert len(dealt) >= 5 and {(int(n), how) for n, how in dealt} == {(-(-rows // 500), "REPARTITION_BY_NUM")}
    assert df.count() == spark.read.parquet(f"{folder}/orders.parquet").count()
