"""Operators that SQL doesn't cover, and their edges."""

from __future__ import annotations

import zipfile

import pytest
from pyspark.sql import functions as F

from spanforge.functions import scalars as S
from spanforge.operators import chain, checks, conditions, extract, reconcile, spans
from spanforge.sources import files


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'long'}" for k, v in values.items()))
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize(("text", "value"), [("$1,505,000", 1505000), ("$10.5 million", 10500000), ("(1,200)", -1200), ("no number here", None), ("$1505000", 1505000), ("1.25 %", None), (None, None), ("", None)])
def test_money(spark, text, value):
    got = one(spark, S.money(F.col("t")), t=text)
    assert (got is None and value is None) or float(got) == value


@pytest.mark.parametrize(("text", "value"), [("June 30, 2027", "2027-06-30"), ("6/30/27", "2027-06-30"), ("2027-06-30", "2027-06-30"), ("February 30, 2024", None), ("2/30/2024", None), ("", None)])
def test_date(spark, text, value):
    got = one(spark, S.date(F.col("t")), t=text)
    assert (got.isoformat() if got else None) == value


def test_ratio_and_percent(spark):
    assert float(one(spark, S.ratio(F.col("t")), t="4.50 to 1.00")) == 4.5
    assert one(spark, S.ratio(F.col("t")), t="4:0") is None
    assert float(one(spark, S.percent(F.col("t")), t="50 bps")) == 0.5


def test_words(spark):
    assert one(spark, S.words_value(F.col("t")), t="thirty-five") == 35
    assert one(spark, S.words_value(F.col("t")), t="thirty-odd") is None


@pytest.mark.parametrize(
    ("source", "holds"),
    [("debt > 25_000_000", True), ("debt > 25_000_000 and ipo", None), ("debt < 1 and ipo", False), ("debt > 1 or ipo", True), ("not debt > 1", False), ("status in [open, closed]", True), ("closing >= 2020-01-01", True), ("ipo in [yes]", None)],
)
def test_condition(spark, source, holds):
    state = F.create_map(F.lit("debt"), F.lit("30000000"), F.lit("status"), F.lit("Open"), F.lit("closing"), F.lit("2021-05-01"))
    assert one(spark, conditions.condition(source, conditions.from_map(state)), t="x") is holds


@pytest.mark.parametrize("source", ["", "f(x) > 1", "a.b() == 1", "a + 1 > 2", "a === 1", "a > ", "a > 1 b"])
def test_condition_refused(spark, source):
    with pytest.raises(conditions.ConditionError):
        conditions.condition(source, conditions.from_map(F.create_map(F.lit("a"), F.lit("1"))))


def test_conditions_parse(spark):
    assert [s for s, _ in checks.conditions_parse(["a > 1", "a >"])] == ["a >"]


def test_matches_and_locate_at_edges(spark):
    d = spark.createDataFrame([(1, "😀ab ab"), (2, ""), (3, None)], "doc_id long, text string")
    m = spans.matches(d, "ab", ["doc_id"])
    assert [(r.start, r.end) for r in m.orderBy("start").collect()] == [(1, 3), (4, 6)]
    marks = spark.createDataFrame([(1, 2, "s")], "doc_id long, start long, section string")
    got = spans.locate(m.select("doc_id", "start"), marks, ["doc_id"], "start", "section")
    assert [(r.start, r.section) for r in got.orderBy("start").collect()] == [(1, None), (4, "s")]


def test_representative(spark):
    rows = [(1, 0, 10, 0.9), (1, 1, 11, 0.8), (1, 50, 60, 0.7), (1, 100, 110, 0.6), (1, 200, 210, 0.5)]
    got = reconcile.representative(spark.createDataFrame(rows, "doc_id long, start long, end long, confidence double"), ["doc_id"])
    assert sorted(r.start for r in got.collect()) == [0, 50, 100]


@pytest.mark.parametrize(
    ("text", "role", "number"),
    [("AMENDMENT NO. 4 TO CREDIT AGREEMENT", "amendment", 4), ("THIRD AMENDMENT TO CREDIT AGREEMENT", "amendment", 3), ("AMENDED AND RESTATED CREDIT AGREEMENT", "amendment_and_restatement", None), ("CREDIT AGREEMENT dated as of August 1, 2017", "base", None), ("INTERCREDITOR DEED", "intercreditor", None), ("PLEDGE AND SECURITY AGREEMENT", "security", None), ("", "other", None)],
)
def test_role(spark, text, role, number):
    kind, n = chain.role(F.col("t"))
    assert one(spark, kind, t=text) == role
    assert one(spark, n, t=text) == number


def test_chain(spark):
    text = "AMENDMENT\n\nSection 6.12 is hereby amended and restated in its entirety as follows: New text 7.00.\n\nSection 2.14 of the Agreement is amended by replacing “0.50%” with “0.75%”.\n\nSection 9.99 is hereby deleted in its entirety"
    c = spark.createDataFrame([("s", "a1", 1, text)], "set_id string, doc_id string, ord int, text string")
    e = chain.effects(c)
    assert [(r.kind, r.section) for r in e.orderBy("seq").collect()] == [("restate", "6.12"), ("replace", "2.14"), ("delete", "9.99")]
    sections = spark.createDataFrame([("s", "6.12", "Old"), ("s", "2.14", "fee 0.50% fee")], "set_id string, section string, body string")
    got = {r.section: r for r in chain.fold(sections, e).collect()}
    assert got["6.12"].body == "New text 7.00."
    assert got["2.14"].body == "fee 0.75% fee"
    assert got["9.99"].unapplied == "a1: no section"


def test_html():
    r = files.parse_html("<p>a <b>b</b><script>x</script></p><hr><p>c<s>gone</s><ins>new</ins></p><table><tr><th>H<th>I<tr><td>1<td></table><a href='u'>l")
    text = "".join(r.out)
    assert text.startswith("a b\n\ncnew")
    assert [c["text"] for c in r.cells] == ["H", "I", "1"]
    assert all(text[c["start"] : c["end"]].strip() == c["text"] for c in r.cells)
    assert [(x["kind"], x["text"]) for x in r.redlines] == [("struck", "gone"), ("inserted", "new")]
    assert len(r.pages) == 2
    assert r.links[0]["href"] == "u"


def test_mime_and_text():
    raw = b"MIME-Version: 1.0\nContent-Type: multipart/related; boundary=b\n\n--b\nContent-Type: text/html\n\n<p>short</p>\n--b\nContent-Type: text/html\n\n<p>the longer part</p>\n--b--\n"
    assert files.one_document("a.mht", raw)["text"] == "the longer part"
    assert files.one_document("a.txt", b"one\ftwo")["pages"] == [0, 4]
    with pytest.raises(ValueError, match="can't read"):
        files.one_document("a.doc", b"")


def test_files(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>hello</p>")
    (tmp_path / "b.txt").write_text("plain")
    (tmp_path / "c.bin").write_text("no")
    got = files.read_documents(spark, str(tmp_path))
    assert sorted(r.text for r in got.collect()) == ["hello", "plain"]
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("m.txt", "x")
    assert [(r.name, bytes(r.content)) for r in files.read_zip(spark, str(tmp_path / "z.zip")).collect()] == [("m.txt", b"x")]
    names = spark.createDataFrame([("a.html",), ("q",)], "name string")
    known = spark.createDataFrame([("/d/a.html",), ("/e/b.html",)], "path string")
    assert {r.name: r.path for r in files.resolved(names, known).collect()} == {"a.html": "/d/a.html", "q": None}


def test_recordings(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"document": "1", "model": "m", "fields": [{"field": "closing_date", "value": "May 1, 2020", "quote": "on May 1, 2020", "confidence": 0.8}, {"field": "closing_date", "value": "x", "quote": "not there", "confidence": 0.8}]}')
    docs = spark.createDataFrame([("1", "It closed on May 1, 2020.")], "doc_id string, text string")
    got = extract.recorded_readings(files.read_recordings(spark, str(tmp_path)), docs, {"closing_date": "date"}).collect()
    assert [(r.key, r.start) for r in got] == [("2020-05-01", 10)]


def test_checks(spark):
    sections = spark.createDataFrame([(1, "2.01", False), (1, "2.02", True)], "doc_id long, section string, reserved boolean")
    refs = spark.createDataFrame([(1, "2.01"), (1, "2.02"), (1, "9.99")], "doc_id long, target string")
    got = checks.run({"sections": sections, "references": refs})
    assert sorted(r.detail for r in got.collect()) == ["missing 9.99", "reserved 2.02"]
    edges = spark.createDataFrame([(1, "a", "b"), (1, "b", "a"), (2, "a", "b")], "doc_id long, src string, dst string")
    assert sorted((r.doc_id, r.detail) for r in checks.found_by("precedence_graph_is_acyclic", {"precedence": edges}).collect()) == [(1, "a"), (1, "b")]


def test_streaming(spark, tmp_path):
    from spanforge.streaming import ingest

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"doc_id": 1, "text": "due $5 on May 1, 2020", "at": "2024-01-01T00:00:00"}\n')
    stream = ingest.readings_stream(ingest.text_stream(spark, str(tmp_path / "in")))
    ingest.append(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    assert [(r.doc_id, r.amount) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [(1, "5")]


def test_mutual_reach(spark):
    """Two rings, one behind the other, a chain, a loop of one node, a repeated edge; and no edges at all."""
    from spanforge.operators import graphs

    ring = [(5, 3), (3, 9), (9, 5), (9, 5), (9, 20), (20, 21), (21, 20)]
    rows = [*ring, (100, 101), (101, 102), (200, 200)]
    edges = spark.createDataFrame(rows, "src long, dst long")
    assert {r.node: r.component for r in graphs.mutual(edges).collect()} == {3: 3, 5: 3, 9: 3, 20: 20, 21: 20, 100: 100, 101: 101, 102: 102, 200: 200}
    assert {r.node: r.length for r in graphs.on_cycles(edges).collect()} == {3: 3, 5: 3, 9: 3, 20: 2, 21: 2, 200: 1}
    assert graphs.mutual(edges.limit(0)).count() == 0
