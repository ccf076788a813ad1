"""Evidence for groups of fields against a search phrase by phrase, and kinds of deals."""

from __future__ import annotations

import random

import pytest

from spanforge.operators import applicability as A


def plain(text):
    low, out = text.lower(), []
    for group, (_, phrases) in A.GROUPS.items():
        for p in phrases:
            at = [k for k in range(len(low)) if low.startswith(p, k) and not any(n in low[max(0, k - A.WINDOW) : k + len(p) + A.WINDOW] for n in A.HELD)]
            if at:
                out.append((group, p, at[0]))
                break
    return out


@pytest.mark.parametrize("seed", range(60))
def test_evidence(seed):
    rng = random.Random(seed)
    bits = [p for _, own in A.GROUPS.values() for p in own] + A.HELD + ["the borrower owes ", "w " * 20, "x" * 35, ". ", "Term Loan Facility", "consolidated", " "]
    text = "".join(rng.choice(bits) + rng.choice(["", " ", " of "]) for _ in range(rng.randrange(40)))
    assert list(A.evidence_in(text)) == plain(text)


def test_no_text():
    assert list(A.evidence_in(None)) == list(A.evidence_in("")) == []


def test_tables(spark):
    base = "A borrowing base of eligible accounts. Event of Default. Event of Default. "
    rows = [(1, base), (2, base + "The Term Loan is due."), (3, base + "A loan asset such as a Term Loan."), (4, None), (5, "a lease")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {}
    for r in A.inapplicable(d, ["initial_term_loan.commitment", "pik.rate_pct", "revolver.commitment"]).collect():
        got.setdefault(r.doc_id, set()).add(r.field)
    assert got == {1: {"initial_term_loan.commitment", "pik.rate_pct"}, 2: {"pik.rate_pct"}, 3: {"initial_term_loan.commitment", "pik.rate_pct"}}
    assert A.evidence(d.limit(0)).count() == 0
    heads = spark.createDataFrame([(1, "AMENDMENT NO. 2\nTO CREDIT AGREEMENT"), (2, "AMENDMENT TO CREDIT AGREEMENT " + "“A” means x. " * 60), (3, "CREDIT AGREEMENT"), (4, None)], "k long, text string")
    assert {r.k: r.bare for r in heads.select("k", A.bare_amendment(heads.text).alias("bare")).collect()} == {1: True, 2: False, 3: False, 4: False}
