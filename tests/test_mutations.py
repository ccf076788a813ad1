"""Mutations of documents: shapes, edits, labels that move, and what the checks find."""

from __future__ import annotations

import random

import pytest

from spanforge.operators import mutations as M
from spanforge.operators import validate as V
from spanforge.sources import files

DAYS = ["March 31, 2020", "June 30, 2020", "September 30, 2020", "December 31, 2020", "March 31, 2021"]
SCHEDULE = "<table><tr><th>Payment Date</th><th>Amount</th></tr>" + "".join(f"<tr><td>{d}</td><td>$376,000</td></tr>" for d in DAYS) + "</table>"
HTML = "<p>Section 1.01 Definitions. “Fee” means 0.50% of it. See the words of Section 2.01 and Schedule 1.1 and Schedule 2.</p><p>Section 2.01 Loans. It is fifty percent (50%).</p>" + SCHEDULE + "<table><tr><td>Level</td><td>Rate</td></tr><tr><td>I</td><td>4.00%</td></tr></table><p>SCHEDULE 1.1</p><p>x</p><h2>SCHEDULE 2</h2><p>y</p>"


def test_all_shapes():
    for name, (_, _, find) in M.MUTATIONS.items():
        edits = find(HTML)
        assert edits and M.edited(HTML, edits) != HTML, name
        assert find("") == [] and find("<p>nothing of the kind</p>") == [], name


def test_forms():
    say = lambda name: M.edited(HTML, M.MUTATIONS[name][2](HTML))
    assert say("duplicate_table_row").count("September 30, 2020") == 2 and say("drop_table_row").count("September 30, 2020") == 0
    assert "of Section 99.99" in say("break_cross_reference") and "ten percent (50%)" in say("numeral_word_mismatch")
    assert "“Fee” means 0.50% of it. “Fee” means 1.50% of it." in say("doubly_defined_term")
    assert "SCHEDULE 1.1" not in say("referenced_schedule_absent") and "SCHEDULE 2" in say("referenced_schedule_absent")
    assert "means 50 basis points of it" in say("bps_instead_of_percent")
    assert "<th>Amount (in thousands)</th>" in say("thousands_scale") and say("thousands_scale").count("$376<") == 5
    assert "Level   Rate\nI       4.00%" in say("grid_rendered_as_text")
    assert M.thousands_scale(HTML.replace("$376,000", "$376,250")) == []


@pytest.mark.parametrize("seed", range(25))
def test_labels_keep_their_text(spark, seed):
    """Random edits and labels against a replay; one session job for all labels of a seed."""
    rng = random.Random(seed)
    source = "".join(rng.choice("abcdef ") for _ in range(60))
    cuts = sorted(rng.sample(range(61), 6))
    edits = [(a, b if rng.random() < 0.7 else a, "".join(rng.choice("XYZ") for _ in range(rng.randrange(5)))) for a, b in zip(cuts[::2], cuts[1::2], strict=True)]
    out = M.edited(source, edits)
    for a in range(0, 60, 3):
        for b in range(a + 1, 61, 7):
            touched = any(x < b and y > a and (x < y or x > a) for x, y, _ in edits)
            if not touched:
                by = sum(len(n) - (y - x) for x, y, n in edits if y <= a)
                assert out[a + by : b + by] == source[a:b]
    if seed:
        return
    labels = spark.createDataFrame([(1, f"{a}", a, b) for a in range(0, 60, 3) for b in range(a + 1, 61, 7)], "doc_id long, name string, start long, end long")
    changed = spark.createDataFrame([(1, "m", [{"start": a, "end": b, "new": n} for a, b, n in edits])], f"doc_id long, mutation string, edits {M.EDITS}")
    got = {(r.name, r.start, r.end, r.touched) for r in M.moved_labels(labels, changed).collect()}
    want = set()
    for a in range(0, 60, 3):
        for b in range(a + 1, 61, 7):
            touched = any(x < b and y > a and (x < y or x > a) for x, y, _ in edits)
            by = sum(len(n) - (y - x) for x, y, n in edits if y <= a)
            want.add((f"{a}", None if touched else a + by, None if touched else b + by, touched))
    assert got == want


def test_checks_find_what_is_planted(spark):
    changed = M.mutated(spark.createDataFrame([(1, HTML), (2, None), (3, "<p>plain</p>")], "doc_id long, html string")).cache()
    assert {(r.doc_id, r.mutation) for r in changed.collect()} == {(1, m) for m in M.MUTATIONS}
    rows = [(m, h) for m, h in [("clean", HTML), *((r.mutation, r.html) for r in changed.collect())]]
    parsed = files.parsed(spark.createDataFrame(rows, "doc_id string, html string"), "doc_id", "html").cache()
    found = {}
    for r in V.violations(parsed).collect():
        found.setdefault(r.doc_id, set()).add(r.check)
    for name, (kind, check, _) in M.MUTATIONS.items():
        assert check in found.get(name, set()) if kind == "injection" else name not in found, name
    assert "clean" not in found
    assert V.violations(parsed.limit(0)).count() == 0
