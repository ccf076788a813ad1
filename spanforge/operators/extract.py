"""Readings of fields from rules, definitions and tables, in one long table.

A reading is (doc_id, field, key, start, end, confidence, pass_id, segmentation, external).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.functions import scalars as S
from spanforge.operators.spans import compiled, first_of, locate, of_each

AMOUNT, PERCENT, RATIO = r"\$[0-9][0-9,]*(?:\.[0-9]+)?(?: (?:thousand|million|billion))?", r"[0-9]+(?:\.[0-9]+)?%", r"[0-9]+(?:\.[0-9]+)?(?: to 1\.00|:1\.00|x)"
DAY = r"(?:January|February|March|April|May|June|July|August|September|October|November|December) [0-9]{1,2}, [0-9]{4}"
#: One name: a comma stands in it only before what ends it, so it never spans a list.
ENDINGS = ["Inc.", "INC.", "Incorporated", "LLC", "L.L.C.", "L.P.", "LP", "LLP", "Corp.", "CORP.", "Corporation", "CORPORATION", "Company", "COMPANY", "N.A.", "Ltd.", "LTD.", "Limited", "LIMITED", "Bank", "BANK", "plc", "PLC", "S.A.", "GmbH", "B.V."]
NAME = rf"[A-Z][A-Za-z0-9&.'-]*(?: (?:of|the|[A-Z0-9&][A-Za-z0-9&.'-]*)){{0,6}}?,? (?:{'|'.join(e.replace('.', r'[.]') for e in ENDINGS)})"
#: Second words of states, and laws that go by an adjective.
STATE = r"[A-Z][a-z]+(?: (?:York|Jersey|Hampshire|Mexico|Carolina|Dakota|Island|Virginia))?"
LAWS = ["English", "Scots", "Scottish", "Irish", "Norwegian", "Swedish", "Danish", "Finnish", "German", "French", "Dutch", "Belgian", "Luxembourg", "Swiss", "Austrian", "Italian", "Spanish", "Portuguese", "Singapore", "Japanese", "Australian", "Canadian", "Brazilian", "Mexican"]
#: A role in the singular alone: who is one of several is not the party.
ONE = r"(?![A-Za-z])"

#: Field, kind, anchored pattern with the value in parentheses, confidence, words without which it can't match.
RULES = [
    ("borrower.legal_name", "text", rf"({NAME}),? (?:a [A-Z]?[a-z ]{{3,40}}, )?(?:in its capacity )?(?:as (?:the )?|\(the \"?)[ \"]*Borrower{ONE}", 0.90, "Borrower"),
    ("holdings.legal_name", "text", rf"({NAME}),? (?:a [A-Z]?[a-z ]{{3,40}}, )?(?:as |\(\"?)[ \"]*Holdings{ONE}", 0.90, "Holdings"),
    ("administrative_agent.legal_name", "text", rf"({NAME}),? (?:in its capacity )?as (?:the )?Administrative Agent{ONE}", 0.90, "Administrative Agent"),
    ("guarantor.legal_name", "text", rf"({NAME}),? (?:a [A-Z]?[a-z ]{{3,40}}, )?(?:in its capacity )?as (?:the |a )?(?:Parent )?Guarantor{ONE}", 0.85, "Guarantor"),
    ("collateral_agent.legal_name", "text", rf"({NAME}),? (?:in its capacity )?as (?:the )?Collateral Agent{ONE}", 0.85, "Collateral Agent"),
    ("arranger.legal_name", "text", rf"({NAME}),? as (?:Sole |Joint )?Lead Arranger", 0.85, "Lead Arranger"),
    ("syndication_agent.legal_name", "text", rf"({NAME}),? as Syndication Agent", 0.90, "Syndication Agent"),
    ("facility.governing_law", "text", rf"(?:by|with|under),? the (?:internal |substantive |domestic )?laws? of the (?:State|Commonwealth) of ({STATE})", 0.90, " of the "),
    # said of the agreement, not of another instrument that is `governed by Dutch law`
    ("facility.governing_law", "text", rf"(?:is|are|be|been) governed by,? (?:and (?:shall be |is |are )?construed (?:in accordance with|under),? )?({'|'.join(LAWS)}) law", 0.88, "governed by"),
    ("closing_date", "date", rf"[\"“]Closing Date[\"”] means ({DAY})", 0.95, "Closing Date"),
    ("closing_date", "date", rf"dated as of ({DAY})", 0.55, "dated as of"),
    ("initial_term_loan.maturity_date", "date", rf"Initial Term Loan Maturity Date[\"”] means ({DAY})", 0.95, "Initial Term Loan Maturity Date"),
    ("revolver.maturity_date", "date", rf"Revolving Credit Maturity Date[\"”] means ({DAY})", 0.95, "Revolving Credit Maturity Date"),
    ("initial_term_loan.commitment", "money", rf"Initial Term Loan Commitments?[^.$]{{0,160}}?({AMOUNT})", 0.92, "Initial Term Loan Commitment"),
    ("delayed_draw.commitment", "money", rf"Delayed Draw Term Loan Commitments?[^.$]{{0,160}}?({AMOUNT})", 0.92, "Delayed Draw Term Loan Commitment"),
    ("revolver.commitment", "money", rf"Revolving Credit Commitments?[^.$]{{0,160}}?({AMOUNT})", 0.92, "Revolving Credit Commitment"),
    ("lc_sublimit", "money", rf"(?:Letter of Credit|L/C) Sublimit[^.$]{{0,120}}?({AMOUNT})", 0.90, "Sublimit"),
    ("libor_floor_pct", "percent", rf"(?:Floor|floor)[^.%]{{0,80}}?({PERCENT})", 0.92, "loor"),
    ("commitment_fee_pct", "percent", rf"[Cc]ommitment [Ff]ee[^.%]{{0,120}}?({PERCENT})", 0.88, "ommitment "),
    ("fronting_fee_pct", "percent", rf"[Ff]ronting [Ff]ee[^.%]{{0,120}}?({PERCENT})", 0.88, "ronting "),
    ("ticking_fee_pct", "percent", rf"[Tt]icking [Ff]ee[^.%]{{0,120}}?({PERCENT})", 0.85, "icking "),
    ("excess_cash_flow.sweep_pct", "percent", rf"({PERCENT}) of Excess Cash Flow", 0.88, "Excess Cash Flow"),
    ("financial_covenant.opening_level", "ratio", rf"Total Leverage Ratio[^.]{{0,160}}?to exceed ({RATIO})", 0.80, "Total Leverage Ratio"),
    ("opening_total_leverage_ratio", "ratio", rf"Total Leverage Ratio on the Closing Date[^.]{{0,80}}?({RATIO})", 0.90, "on the Closing Date"),
    ("incremental.leverage_based_test", "ratio", rf"First Lien Net Leverage Ratio[^.]{{0,120}}?(?:not exceed|less than or equal to) ({RATIO})", 0.85, "First Lien Net Leverage Ratio"),
    ("indebtedness.purchase_money_basket_amount", "money", rf"purchase money[^.$]{{0,200}}?({AMOUNT})", 0.82, "purchase money"),
    ("indebtedness.purchase_money_basket_ebitda_pct", "percent", rf"purchase money[^.%]{{0,260}}?({PERCENT}) of Consolidated EBITDA", 0.82, "purchase money"),
    ("incremental.free_and_clear_amount", "money", rf"[Ff]ree and [Cc]lear[^.$]{{0,120}}?({AMOUNT})", 0.85, "lear"),
    ("mfn_threshold_pct", "percent", rf"All-In Yield[^.%]{{0,240}}?by more than ({PERCENT})", 0.90, "All-In Yield"),
    ("mfn_sunset", "text", r"(?:on or prior to|within) the date that is ([a-z0-9 ()-]+ months) after the Closing Date", 0.88, "after the Closing Date"),
    ("borrowing_base.advance_rate_accounts", "percent", rf"({PERCENT}) of (?:the )?(?:value of )?Eligible Accounts", 0.88, "Eligible Accounts"),
    ("borrowing_base.advance_rate_inventory", "percent", rf"({PERCENT}) of (?:the )?(?:value of )?Eligible Inventory", 0.88, "Eligible Inventory"),
    ("borrowing_base.availability_block", "money", rf"[Aa]vailability [Bb]lock[^.$]{{0,80}}?({AMOUNT})", 0.85, "lock"),
    ("arr.minimum_liquidity", "money", rf"Liquidity[^.$]{{0,80}}?(?:less than|below) ({AMOUNT})", 0.85, "Liquidity"),
    ("arr.leverage_covenant_level", "ratio", rf"Recurring Revenue[^.]{{0,120}}?exceed ({RATIO})", 0.88, "Recurring Revenue"),
    ("nav.loan_to_value_cap", "percent", rf"[Ll]oan[- ]to[- ][Vv]alue[^.%]{{0,120}}?({PERCENT})", 0.88, "alue"),
    ("pik.toggle_step_up_pct", "percent", rf"PIK[^.%]{{0,120}}?increased? by ({PERCENT})", 0.85, "PIK"),
    ("consolidated_ebitda.addback_cap_pct", "percent", rf"not (?:to )?exceed ({PERCENT}) of Consolidated EBITDA", 0.88, "of Consolidated EBITDA"),
]

READING = "doc_id, field, key, start, end, confidence, pass_id, segmentation, external"


def rule_readings(docs: DataFrame, rules: list[tuple[str, str, str, float, str]] = RULES, segmentation: str = "structural") -> DataFrame:
    """All hits of anchored patterns: the value is group 1, the citation the whole match.

    A text is read once, by the rules whose words it has, and shuffled never; a hit's value is made once."""
    own = [(f, k, c, compiled(p), w) for f, k, p, c, w in rules]

    def read(t: str) -> Iterator[tuple]:
        for f, k, c, p, w in own:
            if w in t:
                for m in p.finditer(t):
                    yield f, k, c, m[1], m.start(), m.end()

    hits = of_each(docs, ["doc_id"], "text", read, "field string, kind string, confidence double, raw string, start long, end long")
    keyed = hits.select("doc_id", "field", F.explode(F.filter(F.array(S.coerced(F.col("kind"), F.col("raw"))), lambda k: k.isNotNull())).alias("key"), "start", "end", "confidence")
    return keyed.select(
        "doc_id", "field", "key", F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"), F.col("confidence").cast("decimal(10,4)").alias("confidence"),
        F.lit("deterministic:rules").alias("pass_id"), F.lit(segmentation).alias("segmentation"), F.lit(None).cast("string").alias("external"),
    )


DEFINED = r"[\"“]([A-Z][A-Za-z0-9 ,/&-]{1,80})[\"”] (?:means|shall mean|has the meaning)"
_DEFINED, _RUN = compiled(DEFINED), compiled(r"[A-Z][A-Za-z0-9/&-]*(?: [A-Z][A-Za-z0-9/&-]*)*")
#: Words of the longest part of a run that is looked up.
LONGEST_TERM = 8


def defined(text: str, most: int) -> list[tuple[str, int, int, str | None]]:
    """term, start, end, body of the definitions of a text."""
    marks = [(m[1], m.start()) for m in _DEFINED.finditer(text)]
    first: dict[str, tuple[str, int, int, str | None]] = {}
    for k, (term, a) in enumerate(marks):
        b = marks[k + 1][1] if k + 1 < len(marks) else len(text)
        first.setdefault(term, (term, a, b, text[a:b] if b - a <= most else None))
    return list(first.values())


def named_in(bodies: list[tuple[str, str | None]]) -> Iterator[tuple[str, str]]:
    """(src, dst) of a document's definitions (term, body): the other terms among the runs of capitalised words of a body and their parts."""
    terms = {t for t, _ in bodies}
    opening = {t.split(" ", 1)[0] for t in terms}
    for src, body in bodies:
        found: dict[str, None] = {}
        for run in {m[0] for m in _RUN.finditer(body or "")}:
            words = run.split(" ")
            for i, w in enumerate(words):
                if w in opening:
                    found |= dict.fromkeys(t for j in range(i + 1, min(len(words), i + LONGEST_TERM) + 1) if (t := " ".join(words[i:j])) in terms and t != src)
        yield from ((src, dst) for dst in found)


def definitions(docs: DataFrame, most: int = 8_000) -> DataFrame:
    """(doc_id, term, start, end, body): each quoted term that is given a meaning, up to the next; the first one
    of a term stands. Bodies longer than most are declined (null). A row is a document; those without an id have none."""
    return of_each(docs.where("doc_id is not null"), ["doc_id"], "text", lambda t: defined(t, most), "term string, start long, end long, body string")


def edges(docs: DataFrame, most: int = 8_000) -> DataFrame:
    """uses of the definitions of each text, found where the text is."""
    return of_each(docs.where("doc_id is not null"), ["doc_id"], "text", lambda t: named_in([(term, body) for term, _, _, body in defined(t, most)]), "src string, dst string")


def uses(defs: DataFrame) -> DataFrame:
    """Edges (doc_id, src, dst): the defined terms that a definition's body names, by its runs of capitalised words.

    A document's definitions, which are no longer than its text, meet in a row. Terms are looked up among the runs and all their parts."""
    kind = defs.schema["doc_id"].dataType.simpleString()
    own = defs.where("doc_id is not null").groupBy("doc_id").agg(F.collect_list(F.struct("term", "body")).alias("ds"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, pairs = [], []
            for k, ds in enumerate(b.column(1).to_pylist()):
                n = len(pairs)
                pairs.extend(named_in([(d["term"], d["body"]) for d in ds]))
                at += [k] * (len(pairs) - n)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int32())), *(pa.array([p[i] for p in pairs], pa.string()) for i in (0, 1))], names=["doc_id", "src", "dst"])

    return own.mapInArrow(run, f"doc_id {kind}, src string, dst string")


def definition_readings(defs: DataFrame, anchors: DataFrame, kinds: dict[str, str], most: int = 1_200) -> DataFrame:
    """The sole value of a field's defined term; several values or a long body give a valueless reading.

    anchors: (field, anchor, ix), the terms to try in order, a table of the size of the registry, which is sent to the definitions:
    few terms are asked for, so that a merge by them would be a few tasks. Bodies are read where they are; what is shuffled is short."""
    found = defs.withColumn("k", F.lower("term")).join(F.broadcast(anchors.withColumn("k", F.lower("anchor"))), "k")
    kind = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])[F.col("field")]
    pick = lambda p: F.array_distinct(F.regexp_extract_all("body", F.lit(f"({p})"), 1))
    values = F.when(kind == "money", pick(AMOUNT)).when(kind == "percent", pick(PERCENT)).when(kind == "ratio", pick(RATIO)).when(kind == "date", pick(DAY))
    raw = once(values, lambda v: F.when((F.length("body") <= most) & (F.size(v) == 1), v[0]))
    letter = F.nullif(F.regexp_extract("body", r"(Fee Letter|Disclosure Letter|Side Letter|Schedule [0-9.]+|Exhibit [A-Z])", 1), F.lit(""))
    one = first_of(found.select("doc_id", "field", "ix", "start", "end", raw.alias("raw"), letter.alias("letter")), ["doc_id", "field"], F.col("ix"), F.col("start"))
    return one.select(
        "doc_id", "field", S.coerced(kind, F.col("raw")).alias("key"), "start", "end", F.lit(0.9).cast("decimal(10,4)").alias("confidence"), F.lit("deterministic:definitions").alias("pass_id"),
        F.lit("definitional").alias("segmentation"), F.when(F.col("raw").isNull(), F.col("letter")).alias("external"),
    )


def table_readings(rows: DataFrame, columns: list[tuple[str, str, str]]) -> DataFrame:
    """Readings from labelled table cells (sources.files.labelled_rows with doc_id): for each (field, label pattern, kind)
    the cells of the columns whose label fits."""
    parts = [
        rows.where(F.lower("label").rlike(p)).select("doc_id", F.lit(f).alias("field"), S.coerced(F.lit(k), F.col("text")).alias("key"), "start", "end", F.lit(0.95).cast("decimal(10,4)").alias("confidence"), F.lit("deterministic:tables").alias("pass_id"), F.lit("structural").alias("segmentation"), F.lit(None).cast("string").alias("external"))
        for f, p, k in columns
    ]
    return reduce(DataFrame.unionByName, parts).where("key is not null")


def recorded_readings(recordings: DataFrame, docs: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Recorded model readings whose quotation stands in the document; others are dropped."""
    r = recordings.select(F.col("document").alias("doc_id"), F.explode("fields").alias("f")).select("doc_id", "f.*")
    kind = F.coalesce(F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])[F.col("field")], F.lit("text"))
    at = F.expr("locate(quote, text)")
    j = r.join(docs, "doc_id").where((at > 0) & F.col("field").isin(list(kinds)))
    return j.select(
        "doc_id", "field", S.coerced(kind, F.col("value")).alias("key"), (at - 1).alias("start"), (at - 1 + F.length("quote")).alias("end"), F.col("confidence").cast("decimal(10,4)").alias("confidence"),
        F.lit("model:recorded").alias("pass_id"), F.lit("sliding").alias("segmentation"), F.col("external_document").alias("external"),
    )


#: Archetype, decisive phrases, supporting phrases, field groups that don't apply; fixed values.
ARCHETYPES = [
    ("cash_flow_term_loan", [], ["consolidated ebitda", "term loan", "leverage ratio", "excess cash flow"], ["borrowing_base", "recurring_revenue", "nav_tests", "pik_mechanics"]),
    ("abl_revolver", ["borrowing base", "eligible accounts", "eligible inventory", "advance rate"], ["availability block", "dominion", "reserves established"], ["term_amortization", "recurring_revenue", "nav_tests", "pik_mechanics"]),
    ("second_lien", ["second lien credit agreement", "second priority"], ["second lien", "junior lien", "intercreditor agreement", "first lien obligations"], ["borrowing_base", "recurring_revenue", "nav_tests"]),
    ("recurring_revenue", ["annualized recurring revenue", "recurring revenue loan", "arr leverage"], ["minimum liquidity"], ["ebitda_covenants", "ebitda_baskets", "borrowing_base", "nav_tests"]),
    ("nav_or_subscription", ["net asset value", "uncalled capital", "subscription facility", "portfolio investments"], ["capital commitments", "limited partners"], ["ebitda_covenants", "ebitda_baskets", "term_amortization", "borrowing_base", "recurring_revenue"]),
    ("unitranche", ["agreement among lenders", "unitranche"], ["first out", "last out"], ["borrowing_base", "nav_tests", "recurring_revenue"]),
    ("holdco_pik", ["pik toggle", "pik interest", "paid in kind"], ["holdco", "structurally subordinated"], ["borrowing_base", "nav_tests", "recurring_revenue"]),
    ("project_finance", ["offtake agreement", "epc contract", "project company"], ["debt service coverage ratio", "completion guarantee"], ["ebitda_baskets", "borrowing_base", "nav_tests", "recurring_revenue"]),
    ("dip", ["debtor-in-possession credit agreement", "section 364", "superpriority claim", "interim order", "final order"], ["bankruptcy court", "carve-out", "chapter 11 cases", "petition date", "budget variance"], ["nav_tests", "recurring_revenue"]),
    ("venture_debt", ["loan and security agreement", "warrant to purchase", "preferred stock financing"], ["material adverse change", "investor abandonment", "minimum cash", "performance milestone"], ["ebitda_baskets", "nav_tests"]),
    ("investment_grade", ["ratings-based pricing", "debt rating", "index debt", "s&p and moody"], ["facility fee", "no borrowing base", "negative pledge"], ["borrowing_base", "nav_tests", "recurring_revenue", "ebitda_baskets"]),
    ("european_lma", ["facilities agreement", "loan market association", "majority lenders", "utilisation request"], ["utilisation date", "rollover loan", "agent's spot rate of exchange", "quotation day", "break costs"], ["borrowing_base", "nav_tests"]),
]


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use of a value that is worked out once, however often it stands in it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def archetype(text: Column) -> Column:
    """struct(archetype, decisive, tied): most decisive phrases in the first 30,000 characters; a tie is said, and
    without any the plain term loan needs three supporting phrases. What is no agreement is unknown."""

    def told(low: Column) -> Column:
        count = lambda phrases: sum((F.when(F.contains(low, F.lit(p)), 1).otherwise(0) for p in phrases), F.lit(0))
        scores = F.array(*[F.struct(count(d).alias("n"), F.lit(-i).alias("i"), F.lit(a).alias("a")) for i, (a, d, _, _) in enumerate(ARCHETYPES) if d])
        return once(scores, lambda s: once(F.array_max(s), lambda best: named(low, count, s, best)))

    def named(low: Column, count: Callable[[list[str]], Column], scores: Column, best: Column) -> Column:
        tied = F.size(F.filter(scores, lambda s: s["n"] == best["n"])) > 1
        name = F.when(F.regexp_count(F.lower(text), F.lit("event of default")) < 2, "unknown").when((best["n"] > 0) & ~tied, best["a"]).when(best["n"] > 0, "unknown").when(count(ARCHETYPES[0][2]) >= 3, ARCHETYPES[0][0]).otherwise("unknown")
        return F.struct(name.alias("archetype"), best["n"].alias("decisive"), ((best["n"] > 0) & tied).alias("tied"))

    return once(F.lower(F.left(text, F.lit(30_000))), told)


EXTERNAL = [("redacted", r"\[\*\*\*\]|\[redacted\]"), ("omitted_from_filing", r"\b(?:intentionally omitted|omitted pursuant to)\b"), ("by_design", r"\bfee letter\b|\bdisclosure letter\b|\bside letter\b|\bsponsor model\b")]


def external_kind(window: Column) -> Column:
    """Why a magnitude lies outside: redacted, omitted, elsewhere by design, or not at all."""
    low, out = F.lower(window), None
    for kind, p in EXTERNAL:
        out = F.when(low.rlike(p), kind) if out is None else out.when(low.rlike(p), kind)
    return out


PRECEDENCE = [("notwithstanding", r"[Nn]otwithstanding[^.]{0,80}?Section ([0-9]+\.[0-9]+)", True), ("subject_to", r"[Ss]ubject to[^.]{0,60}?Section ([0-9]+\.[0-9]+)", False), ("except_as", r"[Ee]xcept as[^.]{0,80}?Section ([0-9]+\.[0-9]+)", False), ("in_lieu_of", r"[Ii]n lieu of[^.]{0,80}?Section ([0-9]+\.[0-9]+)", True)]


def precedence(docs: DataFrame, sections: DataFrame) -> DataFrame:
    """(doc_id, src, dst, kind): src yields to dst. With notwithstanding and in lieu of the section that says it wins,
    else the one it cites. sections: (doc_id, section, start). A text is read once for all kinds, and its sections are looked up once."""
    own = [(kind, compiled(p), wins) for kind, p, wins in PRECEDENCE]
    said = of_each(docs, ["doc_id"], "text", lambda t: [(kind, wins, m[1], m.start()) for kind, p, wins in own for m in p.finditer(t)], "kind string, wins boolean, cited string, start long")
    here = locate(said, sections, ["doc_id"], "start", "section").where("section is not null and section <> cited")
    return here.select("doc_id", F.when(F.col("wins"), F.col("cited")).otherwise(F.col("section")).alias("src"), F.when(F.col("wins"), F.col("section")).otherwise(F.col("cited")).alias("dst"), "kind").distinct()


def registry(spark: SparkSession) -> DataFrame:
    from spanforge.plans.registry import FIELDS

    return spark.createDataFrame(FIELDS, "field string, kind string, field_class string, criticality int")
