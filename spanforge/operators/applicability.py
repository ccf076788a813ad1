"""Which fields a kind of deal does not have, and what in a document's own words contradicts that.

A kind of deal rules out groups of fields. A group stays if the document uses one of its phrases of the facility itself: a use counts
unless a noun of what the borrower holds stands in the window around it. All phrases and nouns of a text are found in one pass over it.

Null texts have no uses and no kind; of phrases that count the first in the group's order is told, with its first use that counts; an
empty table gives no rows.
"""

from __future__ import annotations

import fnmatch
import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.operators.extract import ARCHETYPES, archetype

#: Groups of fields by their names, and phrases that show that a deal has them.
GROUPS = {
    "ebitda_covenants": (["financial_covenant.*", "opening_total_leverage_ratio", "consolidated_ebitda.*", "incremental.leverage_based_test"], ["ebitda", "leverage ratio"]),
    "ebitda_baskets": (["indebtedness.purchase_money_basket_ebitda_pct"], ["consolidated ebitda", "combined ebitda"]),
    "term_amortization": (["amortization.*", "initial_term_loan.*", "delayed_draw.*"], ["term loan", "term note", "delayed draw"]),
    "revolver_mechanics": (["revolver.*", "commitment_fee_pct", "lc_sublimit", "fronting_fee_pct"], ["revolving credit", "revolving loan", "revolver"]),
    "borrowing_base": (["borrowing_base.*"], ["borrowing base", "advance rate", "eligible accounts"]),
    "recurring_revenue": (["arr.*"], ["recurring revenue", "annualized recurring", "arr "]),
    "nav_tests": (["nav.*"], ["net asset value", "loan-to-value", "loan to value"]),
    "pik_mechanics": (["pik.*"], ["payment-in-kind", "payment in kind", "pik "]),
    "mfn": (["mfn_*"], ["most favored nation", "most favoured nation", "mfn"]),
}
#: Nouns of what a borrower holds, how far they reach, the head of an amendment, definitions of one that carries its agreement.
HELD = ["collateral loan", "collateral obligation", "collateral debt", "loan asset", "portfolio investment", "portfolio company", "underlying loan", "eligible loan"]
WINDOW, TITLE, CARRIES = 60, 600, 60


def uses(text: str, phrases: list[str]) -> dict[str, list[int]]:
    """Where each phrase stands, by one pass that takes the longest at a place and knows which others begin it."""
    ordered = sorted(phrases, key=len, reverse=True)
    begun = {p: [q for q in phrases if p.startswith(q)] for p in phrases}
    out: dict[str, list[int]] = {p: [] for p in phrases}
    for m in re.finditer(f"(?=({'|'.join(map(re.escape, ordered))}))", text):
        for q in begun[m[1]]:
            out[q].append(m.start())
    return out


def evidence_in(text: str | None) -> Iterator[tuple[str, str, int]]:
    """group, phrase, offset of the groups that a text shows."""
    phrases = list(dict.fromkeys([p for _, own in GROUPS.values() for p in own] + HELD))
    at = uses((text or "").lower(), phrases)
    held = sorted((s, s + len(n)) for n in HELD for s in at[n])

    def beside(start: int, end: int) -> bool:
        k = bisect_left(held, (start - WINDOW, 0))
        while k < len(held) and held[k][0] < end + WINDOW:
            if held[k][1] <= end + WINDOW:
                return True
            k += 1
        return False

    for group, (_, own) in GROUPS.items():
        found = next(((p, s) for p in own for s in at[p] if not beside(s, s + len(p))), None)
        if found:
            yield (group, *found)


def evidence(docs: DataFrame) -> DataFrame:
    """(doc_id, group, phrase, start) of every group that a document's own words show."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(d, *e) for d, t in zip(f.doc_id, f.text, strict=True) for e in evidence_in(t)]
            yield pd.DataFrame(rows, columns=["doc_id", "group", "phrase", "start"])

    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, group string, phrase string, start long")


def fields_of(names: list[str]) -> list[tuple[str, str]]:
    """group, field for each field that a group's patterns name."""
    return [(g, n) for g, (patterns, _) in GROUPS.items() for n in names if any(fnmatch.fnmatchcase(n, p) for p in patterns)]


def inapplicable(docs: DataFrame, names: list[str]) -> DataFrame:
    """(doc_id, archetype, group, field): fields that the document's kind of deal does not have and that its words don't show."""
    spark = docs.sparkSession
    ruled_out = spark.createDataFrame([(a, g) for a, _, _, groups in ARCHETYPES for g in groups], "archetype string, group string")
    fields = spark.createDataFrame(fields_of(names), "group string, field string")
    kinds = docs.select("doc_id", archetype(F.col("text"))["archetype"].alias("archetype"))
    out = kinds.join(F.broadcast(ruled_out), "archetype")  # a row for each kind and group
    kept = out.join(evidence(docs).select("doc_id", "group"), ["doc_id", "group"], "left_anti")
    return kept.join(F.broadcast(fields), "group").select("doc_id", "archetype", "group", "field")


def bare_amendment(text: Column) -> Column:
    """Whether a document amends an agreement that it does not carry: so named in its head, with few definitions of its own."""
    named = F.left(text, F.lit(TITLE)).rlike(r"(?is)\bAMENDMENT\b.{0,70}?\bTO\b.{0,60}?\bAGREEMENT\b")
    return F.coalesce(named & (F.regexp_count(text, F.lit(r'(?i)["”]\s*(?:means|shall mean|:\s)')) < CARRIES), F.lit(False))
