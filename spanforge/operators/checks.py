"""Checks over facts, each a function from tables to violations (doc_id, check, detail).

A check registers itself under its name and family; `run` unions the checks whose tables are there.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.functions import scalars as S
from spanforge.operators import schedules as P

Tables = dict[str, DataFrame]
CHECKS: dict[str, tuple[str, tuple[str, ...], Callable[..., DataFrame]]] = {}


def check(name: str, family: str, *needs: str) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        CHECKS[name] = (family, needs, f)
        return f

    return add


def found(df: DataFrame, name: str, detail: Column) -> DataFrame:
    return df.select("doc_id", F.lit(name).alias("check"), detail.cast("string").alias("detail"))


def run(tables: Tables, skip: set[str] = frozenset()) -> DataFrame:
    """Violations of all checks whose tables are given. skip: names that an archetype rules out."""
    parts = [found_by(n, tables) for n, (_, needs, _) in CHECKS.items() if n not in skip and all(t in tables for t in needs)]
    return reduce(DataFrame.unionByName, parts)


def found_by(name: str, tables: Tables) -> DataFrame:
    _, needs, f = CHECKS[name]
    return f(*(tables[t] for t in needs))


# -- schedule: doc_id, row_index, payment_date, amount; facts: doc_id, field, kind, unit, value (decimal), date, span_length
@check("amortization_dates_strictly_increasing", "F01_integrity", "schedule")
def _(s):
    return found(P.not_increasing(s, ["doc_id"]), "amortization_dates_strictly_increasing", F.col("payment_date"))


@check("amortization_dates_evenly_spaced", "F08_units", "schedule")
def _(s):
    return found(P.uneven(s.select("doc_id", "payment_date").distinct(), ["doc_id"]), "amortization_dates_evenly_spaced", F.col("payment_date"))


@check("amortization_row_count_matches_quarters", "F01_integrity", "schedule")
def _(s):
    return found(P.counts_off(s, ["doc_id"]), "amortization_row_count_matches_quarters", F.concat_ws("/", "rows", "quarters"))


@check("amortization_total_consistent", "F01_integrity", "schedule")
def _(s):
    q = S.quarter_index(F.col("payment_date"))
    a = s.groupBy("doc_id").agg(F.count_distinct("amount").alias("levels"), F.sum("amount").alias("total"), (F.max("amount") * (F.max(q) - F.min(q) + 1)).alias("expected"))
    return found(a.where("levels = 1 and total <> expected"), "amortization_total_consistent", F.col("total"))


@check("amortization_sums_to_principal", "F01_integrity", "schedule", "principals")
def _(s, p):
    return found(P.totals_off(s, p, ["doc_id"]), "amortization_sums_to_principal", F.col("scheduled"))


@check("actus_schedule_matches_document", "F01_integrity", "generated", "schedule")
def _(g, s):
    return found(P.differences(g, s, ["doc_id"]), "actus_schedule_matches_document", F.concat_ws(" ", "kind", "row_index"))


@check("covenant_steps_monotonic", "F07_benchmark", "covenant_steps")
def _(c):
    return found(P.rising(c, ["doc_id"], "ord", "level"), "covenant_steps_monotonic", F.col("level"))


def fact(facts: DataFrame, field: str, value: str = "value") -> DataFrame:
    return facts.where(F.col("field") == field).select("doc_id", F.col(value).alias(field.replace(".", "_")))


@check("revolver_maturity_before_term_maturity", "F01_integrity", "facts")
def _(f):
    j = fact(f, "revolver.maturity_date", "date").join(fact(f, "initial_term_loan.maturity_date", "date").hint("merge"), "doc_id")
    return found(j.where("revolver_maturity_date > initial_term_loan_maturity_date"), "revolver_maturity_before_term_maturity", F.col("revolver_maturity_date"))


@check("percentages_and_ratios_in_range", "F08_units", "facts")
def _(f):
    bad = f.where("(kind = 'percent' and not value between 0 and 100) or (kind = 'ratio' and value <= 0)")
    return found(bad, "percentages_and_ratios_in_range", F.concat_ws("=", "field", "value"))


@check("mfn_trigger_ordering", "F07_benchmark", "facts")
def _(f):
    j = fact(f, "mfn_threshold_pct").join(fact(f, "mfn_junior_threshold_pct"), "doc_id")
    return found(j.where("mfn_threshold_pct >= mfn_junior_threshold_pct"), "mfn_trigger_ordering", F.col("mfn_threshold_pct"))


@check("opening_leverage_consistent", "F01_integrity", "facts", "ebitda")
def _(f, e):
    total = e.groupBy("doc_id").agg(F.sum("amount").alias("ebitda"))
    j = fact(f, "initial_term_loan.commitment").join(fact(f, "opening_total_leverage_ratio"), "doc_id").join(total, "doc_id")
    off = F.abs(F.try_divide(F.col("initial_term_loan_commitment"), F.col("ebitda")) - F.col("opening_total_leverage_ratio")) > 0.05
    return found(j.where(off), "opening_leverage_consistent", F.col("opening_total_leverage_ratio"))


@check("ebitda_baskets_have_identified_base", "F09_definitional_depth", "facts")
def _(f):
    return found(f.where("field like '%ebitda_pct' and base is null"), "ebitda_baskets_have_identified_base", F.col("field"))


@check("every_numeric_has_a_unit", "F08_units", "facts")
def _(f):
    return found(f.where("kind in ('money', 'percent', 'ratio') and value is not null and unit is null"), "every_numeric_has_a_unit", F.col("field"))


@check("citations_cite_a_value", "F01_integrity", "facts")
def _(f):
    return found(f.where("value is null and date is null and span_length > 1000"), "citations_cite_a_value", F.col("field"))


@check("date_invariants_use_fiscal_calendar", "F08_units", "schedule", "calendars")
def _(s, c):
    off = s.where("payment_date <> last_day(payment_date) or month(payment_date) % 3 <> 0").select("doc_id").distinct()
    return found(off.join(c.where("is_default"), "doc_id", "left_semi"), "date_invariants_use_fiscal_calendar", F.lit("default calendar"))


@check("cross_references_resolve", "F01_integrity", "references", "sections")
def _(r, s):
    known = s.select("doc_id", F.col("section").alias("target"))
    reserved = s.where("reserved").select("doc_id", F.col("section").alias("target"), F.lit(True).alias("r"))
    missing = r.join(known, ["doc_id", "target"], "left_anti").select("doc_id", F.concat(F.lit("missing "), "target").alias("d"))
    empty = r.join(reserved, ["doc_id", "target"]).select("doc_id", F.concat(F.lit("reserved "), "target").alias("d"))
    return found(missing.unionByName(empty), "cross_references_resolve", F.col("d"))


@check("numeral_and_words_agree", "F01_integrity", "clauses")
def _(c):
    p = r"([a-z]+(?:-[a-z]+)?) (?:percent|days|months|years)? ?\(([0-9]+)%?\)"
    n, w = F.regexp_extract("text", p, 2).try_cast("int"), S.words_value(F.regexp_extract("text", p, 1))
    return found(c.where(n.isNotNull() & w.isNotNull() & (n != w)), "numeral_and_words_agree", F.concat_ws("/", w, n))


@check("defined_terms_are_unique", "F01_integrity", "definition_marks")
def _(d):
    return found(d.groupBy("doc_id", "term").agg(F.count("*").alias("n")).where("n > 1"), "defined_terms_are_unique", F.col("term"))


@check("referenced_schedules_present", "F01_integrity", "cited_schedules", "attached_schedules")
def _(c, a):
    """Cited schedules that are not attached, where at least half of those cited are."""
    j = c.distinct().join(a.select("doc_id", "schedule", F.lit(True).alias("there")).distinct(), ["doc_id", "schedule"], "left")
    strict = F.count("there").over(W.partitionBy("doc_id")) * 2 >= F.count("*").over(W.partitionBy("doc_id"))
    return found(j.withColumn("strict", strict).where("there is null and strict"), "referenced_schedules_present", F.col("schedule"))


@check("precedence_graph_is_acyclic", "F02_precedence", "precedence")
def _(p):
    """Sections that yield to themselves in the end. The document is part of the node, so all graphs are one."""
    from spanforge.operators.graphs import on_cycles

    node = lambda c: F.concat_ws("|", F.col("doc_id").cast("string"), c)
    c = on_cycles(p.select(node("src").alias("src"), node("dst").alias("dst")))
    part = F.split("node", r"\|", 2)
    doc = p.select(F.col("doc_id").cast("string").alias("d"), "doc_id").distinct()
    return found(c.select(part[0].alias("d"), part[1].alias("section")).join(doc, "d"), "precedence_graph_is_acyclic", F.col("section"))


@check("proviso_depth_is_readable", "F02_precedence", "clauses")
def _(c):
    deep = F.array_max(F.transform(F.split("text", r"\. "), lambda s: F.regexp_count(s, F.lit("(?i)provided"))))
    return found(c.withColumn("deep", deep).where("deep >= 4"), "proviso_depth_is_readable", F.col("deep"))


@check("amendment_targets_exist", "F05_versioning", "chain_findings")
def _(f):
    return found(f.where("kind = 'target_missing'").withColumn("doc_id", F.col("set_id")), "amendment_targets_exist", F.col("detail"))


@check("restatements_do_not_conflict", "F05_versioning", "chain_findings")
def _(f):
    return found(f.where("kind = 'conflicting'").withColumn("doc_id", F.col("set_id")), "restatements_do_not_conflict", F.col("detail"))


@check("csa_not_silently_zero", "F07_benchmark", "pricing")
def _(p):
    return found(p.where("benchmark like '%sofr' and adjustment is null and text rlike '(?i)spread adjustment[^.]{0,80}[0-9]'"), "csa_not_silently_zero", F.col("benchmark"))


@check("grid_levels_monotonic", "F07_benchmark", "grid")
def _(g):
    w = W.partitionBy("doc_id").orderBy(F.desc_nulls_first("upto"))
    return found(g.withColumn("previous", F.lag("margin").over(w)).where("margin > previous"), "grid_levels_monotonic", F.col("margin"))


@check("grid_bands_contiguous", "F07_benchmark", "grid")
def _(g):
    return found(P.band_faults(g, ["doc_id"]), "grid_bands_contiguous", F.col("fault"))


@check("variant_ranges_do_not_overlap", "F10_conditionality", "variants")
def _(v):
    b = v.select("doc_id", "field", F.col("ix").alias("ix2"), F.col("since").alias("since2"), F.col("until").alias("until2"), F.col("condition").alias("condition2"))
    j = v.join(b, ["doc_id", "field"]).where("ix < ix2 and condition is null and condition2 is null")
    both = F.coalesce(F.col("since") <= F.col("until2"), F.lit(True)) & F.coalesce(F.col("since2") <= F.col("until"), F.lit(True))
    return found(j.where(both), "variant_ranges_do_not_overlap", F.concat_ws(" ", "field", "ix", "ix2"))


@check("blackline_deletions_excised", "F11_layout", "documents", "redlines")
def _(d, r):
    claims = d.where("text rlike '(?i)(?:deleted|stricken) text[^.]{0,80}(?:strike|struck)'")
    return found(claims.join(r.where("kind = 'struck'"), "doc_id", "left_anti"), "blackline_deletions_excised", F.lit("no struck text"))


@check("table_scale_declarations", "F11_layout", "tables")
def _(t):
    return found(t.where(S.scale_declared(F.col("before")).isNotNull() & F.col("scale").isNull()), "table_scale_declarations", F.col("table_id"))


@check("nested_table_flattening", "F11_layout", "tables")
def _(t):
    """Tables that end within one which starts before them: the furthest end of all earlier starts tells, so no pairs are made."""
    earlier = W.partitionBy("doc_id").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    ends = t.where("start is not null").groupBy("doc_id", "start").agg(F.max("end").alias("to")).withColumn("reach", F.max("to").over(earlier)).select("doc_id", "start", "reach")
    return found(t.join(ends.hint("merge"), ["doc_id", "start"]).where("end <= reach").select("doc_id", "table_id").distinct(), "nested_table_flattening", F.col("table_id"))


@check("conflicting_definitions_across_documents", "F09_definitional_depth", "set_definitions")
def _(d):
    g = d.groupBy("set_id", "term").agg(F.count_distinct(S.text_key(F.col("body"))).alias("n")).where("n > 1")
    return found(g.withColumn("doc_id", F.col("set_id")), "conflicting_definitions_across_documents", F.col("term"))


def refused(source: Column) -> Column:
    """Whether the grammar of conditions refuses a text."""
    @F.pandas_udf("boolean")
    def parse(sources: pd.Series) -> pd.Series:
        bad = {s for s, _ in conditions_parse(sorted(set(sources.dropna())))}
        return sources.map(lambda s: s is None or s in bad)

    return parse(source)


def conditions_parse(sources: list[str]) -> list[tuple[str, str]]:
    """Conditions that the grammar refuses, with why: conditions are configuration, so this runs on the driver."""
    from spanforge.operators.conditions import ConditionError, variables

    out = []
    for s in sources:
        try:
            variables(s)
        except ConditionError as e:
            out.append((s, str(e)))
    return out
