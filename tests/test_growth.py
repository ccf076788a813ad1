"""Plans and pieces that must not grow faster than the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanforge.operators import checks as K
from spanforge.operators import extract as X
from spanforge.operators import operative as O
from spanforge.session import durable

SET = "set_id string, ord int, doc_id string, role string, text string, marked boolean"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_sets_are_folded_without_a_frame_each(spark):
    base = "Section 1.01 Terms. The rate 1 applies.\n\nSection 1.02 Fees. None."
    change = "Section 1.01 of the Credit Agreement is hereby amended by deleting “rate 1” and inserting “rate 2” in its place."
    rows = [r for k in range(300) for r in ((f"s{k}", 2, "b", "amendment", change, None), (f"s{k}", 1, "a", "base", base, False))] + [(None, 1, "a", "base", base, False), ("none", 1, "a", "amendment", change, False), ("blank", 1, "a", "base", None, False)]
    folded = O.fold(spark.createDataFrame(rows, SET))
    assert "InPandas" not in plan(folded)
    texts = {r.set_id: r.text for r in O.texts(O.pieces(folded)).collect()}
    assert texts == {f"s{k}": base.replace("rate 1", "rate 2") for k in range(300)} | {None: base}
    assert {r.set_id: r.reason for r in O.changes(folded).collect()} == {f"s{k}": None for k in range(300)} | {"none": "the set has no base"}


def test_nested_tables_make_no_pairs(spark):
    t = spark.range(5_000).select(F.lit("d").alias("doc_id"), F.col("id").cast("string").alias("table_id"), (F.col("id") * 3 % 1_000).alias("start"), (F.col("id") * 3 % 1_000 + F.col("id") % 7).alias("end"))
    more = spark.createDataFrame([("d", "x", None, 5), ("d", "y", 5, None), (None, "z", 1, 2)], "doc_id string, table_id string, start long, end long")
    found = K.found_by("nested_table_flattening", {"tables": t.unionByName(more)})
    assert "Window" in plan(found)
    rows = [(r.table_id, r.start, r.end) for r in t.collect()]
    spans = {(s, e) for _, s, e in rows}
    assert {r.detail for r in found.collect()} == {k for k, s, e in rows if any(a < s and e <= b for a, b in spans)}


def test_maturity_order_is_no_broadcast(spark):
    f = spark.createDataFrame([(1, "revolver.maturity_date", "2021-01-02"), (1, "initial_term_loan.maturity_date", "2021-01-01")], "doc_id long, field string, date string").withColumn("date", F.to_date("date"))
    found = K.found_by("revolver_maturity_before_term_maturity", {"facts": f})
    assert "SortMergeJoin" in plan(found) and found.count() == 1


def test_kept_tables_are_not_broadcast(spark):
    a = durable(spark.range(9).withColumn("x", F.col("id") % 3))
    assert "BroadcastHashJoin" not in plan(a.select("id").distinct().join(spark.range(9), "id"))
    assert "BroadcastHashJoin" not in plan(spark.range(9).join(a.withColumnRenamed("id", "k"), F.col("id") == F.col("k"), "left_anti"))


def test_kinds_of_deals_look_at_a_text_once(spark):
    kinds = spark.createDataFrame([("A borrowing base. Event of Default. Event of Default.",), ("unitranche, pik toggle, Event of Default, Event of Default",), (None,)], "t string").select(X.archetype(F.col("t")).alias("k"))
    assert kinds._jdf.queryExecution().optimizedPlan().toString().count("lower(") <= 4
    assert [r.k and (r.k.archetype, r.k.decisive, r.k.tied) for r in kinds.collect()] == [("abl_revolver", 1, False), ("unknown", 1, True), ("unknown", 0, False)]


def test_plain_markup_is_read_as_by_the_tolerant_parser():
    from spanforge.sources import files

    def told(r):
        return "".join(r.out), r.size, r.pages, r.cells, r.redlines, r.links

    def tolerant(markup):
        r = files.Reader()
        r.feed(markup)
        r.close()
        r.close_cell()
        return r

    plain = ["<P>a &amp; b<br/>c</p><table><tr><td colspan=2> x</td><td><s>y</s>z </td></tr></table>", '<div style="text-decoration:line-through">a<p>b</div>c<hr /><a href="u.htm">d</a>', "", "a\n b", "<td>1<td>2", '<p>a</p><del>b<span>c</span></del><ins>d</ins>']
    other = ["<p>1 < 2", "<!-- c --><p>a", "<p a='1'>b", "<style>p{}</style>a", "a<td", "<p A b>c</p>", "<td colspan=2/>a", "</ p>a", "<title>a</title>b"]
    assert all(files.plain_tags(m) is not None for m in plain) and all(files.plain_tags(m) is None for m in other)
    for m in plain + other:
        assert told(files.parse_html(m)) == told(tolerant(m)), m


def test_a_cell_is_cut_from_its_own_pieces():
    from spanforge.sources import files

    class Counted(list):
        taken = 0

        def __getitem__(self, k):
            got = list.__getitem__(self, k)
            Counted.taken += len(got) if isinstance(k, slice) else 0
            return got

        def __iter__(self):
            Counted.taken += len(self)
            return list.__iter__(self)

    r = files.Reader()
    r.out = Counted()
    r.feed("<table>" + "<tr><td>a</td><td>b c</td></tr>" * 500 + "</table>")
    assert len(r.cells) == 1_000 and Counted.taken < 20_000  # 1,000 cells of about 4 pieces each
    assert [c["text"] for c in r.cells[:2]] == ["a", "b c"]


def test_parts_and_long_batches(spark):
    from spanforge.sources import files

    page = "<p>" + "w " * 300_000 + "</p><table><tr><td>a</td><td rowspan=2>b</td></tr></table>"
    rows = spark.createDataFrame([(1, page), (2, None), (3, "<s>x</s>y"), (4, page)], "id long, html string")
    whole = {r.id: r for r in files.parsed(rows, "id", "html").collect()}
    assert [c.text for c in whole[4].cells] == ["a", "b"] and whole[3].redlines[0].text == "x" and whole[2].text == "" and whole[2].cells == []
    cells = files.parsed(rows, "id", "html", parts=("cells",))
    assert cells.columns == ["id", "cells"] and {r.id: r.cells for r in cells.collect()} == {k: r.cells for k, r in whole.items()}


def test_definitions_are_not_broadcast(spark):
    docs = spark.createDataFrame([(1, "“A Term” means the B Term. “B Term” means it.")], "doc_id long, text string")
    defs = X.definitions(docs)
    assert "BroadcastHashJoin" not in plan(X.uses(defs))
    assert [(r.src, r.dst) for r in X.uses(defs).collect()] == [("A Term", "B Term")]


def test_small_tables_are_spread_before_heavy_work(spark):
    from spanforge.plans import document_queries as D

    pages = D.priced_html(spark, "/root/testdata/sf0.001")
    assert pages.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism


def test_pages_are_parsed_once(spark):
    from spanforge.operators import grids as G
    from spanforge.sources import files

    html = "<table><tr><td>Payment Date</td><td>Principal</td></tr><tr><td>March 31, 2020</td><td>$5</td></tr></table>"
    rows = spark.createDataFrame([(1, html)], "doc_id long, html string")
    cells = files.parsed(rows, "doc_id", "html", parts=("cells",)).select("doc_id", F.explode("cells").alias("c")).select("doc_id", "c.*")
    paid = G.amortization(cells, ["doc_id"])
    assert "MapInArrow" not in plan(paid) and [(str(r.payment_date), int(r.amount)) for r in paid.collect()] == [("2020-03-31", 5)]
    labelled = files.labelled_rows(cells, ["doc_id"])
    assert "MapInArrow" not in plan(labelled) and labelled.count() == 2
