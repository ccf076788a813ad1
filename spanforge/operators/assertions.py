"""Labels against results: assertions of fourteen kinds over facts, and gold values of fields.

An assertion has doc_id, assertion, family, kind, target, tranche, expect (an array, of which one element
is enough for a field's value) and at_most. Facts have doc_id, kind, target, tranche, observed and sure. Whatever an
assertion asks of a field, a tranche, a finding or a count is one equality join; questions about texts and
closures have joins of their own, on the document, so no text meets an assertion of another one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.operators.readings import value_match

#: Statuses that are presented as settled, and the tolerance of numbers.
CONFIDENT = ["confirmed", "absent_from_document", "external_reference", "not_applicable_to_archetype"]
TOLERANCE = "0.005"
#: Kinds that ask about a column of a field, and kinds that ask whether something was reported.
FIELD_KINDS = {"field_value": "value", "field_status": "status", "field_external_kind": "external_kind", "field_unit": "unit"}
REPORTED = ["invariant_fired", "chain_finding"]


def number(text: Column) -> Column:
    """A magnitude without its decoration; a ratio over one is the number that it scales."""
    over_one = F.regexp_extract(text, r"^\s*([0-9]+(?:\.[0-9]+)?)\s*(?::|to)\s*1(?:\.0+)?\s*$", 1)
    return F.coalesce(over_one.try_cast("decimal(38,10)"), F.regexp_replace(text, r"[\s$,%]", "").try_cast("decimal(38,10)"))


def plain(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def values_equal(expected: Column, observed: Column) -> Column:
    """Whether two texts say the same: numbers within the tolerance, dates by their first ten characters, else letters without regard to case and spacing. Nulls equal each other."""
    a, b = number(expected), number(observed)
    day = (F.length(expected) >= 10) & (F.substring(expected, 5, 1) == "-")
    said = F.when(a.isNotNull() & b.isNotNull(), F.abs(a - b) <= F.lit(TOLERANCE).cast("decimal(38,10)")).when(day, F.left(expected, F.lit(10)) == F.left(observed, F.lit(10))).otherwise(plain(expected) == plain(observed))
    return F.when(expected.isNull() | observed.isNull(), expected.isNull() & observed.isNull()).otherwise(said)


def field_facts(fields: DataFrame) -> DataFrame:
    """A fact for each column of a field (doc_id, field, value, status, external_kind, unit) that an assertion may ask about."""
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("observed")) for k, c in FIELD_KINDS.items())))
    sure = F.coalesce(F.col("status").isin(CONFIDENT), F.lit(False))
    return fields.select("doc_id", F.col("field").alias("target"), F.lit(None).cast("string").alias("tranche"), sure.alias("sure"), each.alias("f")).select("doc_id", "f.kind", "target", "tranche", "f.observed", "sure")


def tranche_facts(variants: DataFrame) -> DataFrame:
    """The first variant (by ix) of each field and tranche."""
    first = variants.where("tranche is not null").groupBy("doc_id", F.col("field").alias("target"), "tranche").agg(F.min_by(F.struct("value", "status"), F.struct("ix", "value")).alias("v"))
    return first.select("doc_id", F.lit("tranche_value").alias("kind"), "target", "tranche", F.col("v.value").cast("string").alias("observed"), F.coalesce(F.col("v.status").isin(CONFIDENT), F.lit(False)).alias("sure"))


def named_facts(found: DataFrame, kind: str, observed: Column, sure: bool = True) -> DataFrame:
    """Facts of one kind by name: findings and violations, traps, counts, archetypes, values at a point in time."""
    return found.select("doc_id", F.lit(kind).alias("kind"), F.col("name").alias("target"), F.lit(None).cast("string").alias("tranche"), observed.cast("string").alias("observed"), F.lit(sure).alias("sure")).distinct()


def evaluate(assertions: DataFrame, facts: DataFrame, tasks: int | None = None) -> DataFrame:
    """doc_id, assertion, family, kind, passed, confident of assertions about facts.

    A field that is no target fails; a tranche, a point in time or an archetype without a value is null.
    A count is never confident, a finding always. If tasks is given, both sides are dealt over so many, whatever
    their size in bytes."""
    f = facts.select("doc_id", "kind", F.coalesce("target", F.lit("")).alias("t_"), F.coalesce("tranche", F.lit("")).alias("v_"), "observed", "sure", F.lit(True).alias("there"))
    asked = assertions.withColumns({"t_": F.coalesce("target", F.lit("")), "v_": F.when(F.col("kind") == "tranche_value", F.col("tranche")).otherwise("")})
    key = ["doc_id", "kind", "t_", "v_"]
    if tasks:
        asked, f = asked.repartition(tasks, *key), f.repartition(tasks, *key)
    j = asked.join(f, key, "left")
    there, expect = F.coalesce("there", F.lit(False)), F.try_element_at("expect", F.lit(1))
    any_of = F.when(F.coalesce(F.size("expect"), F.lit(0)) > 1, F.exists("expect", lambda e: values_equal(e, F.col("observed")))).otherwise(values_equal(expect, F.col("observed")))
    wanted = F.lower(expect) == "true"
    passed = (
        F.when(F.col("kind").isin(REPORTED), there == wanted)
        .when(F.col("kind") == "trap_caught", there & ((F.lower("observed") == "true") == wanted))
        .when((F.col("kind") == "report_count") & F.col("at_most"), number(F.col("observed")) <= number(expect))
        .when(F.col("kind").isin(list(FIELD_KINDS)), there & any_of)
        .otherwise(any_of)
    )
    sure = F.when(F.col("kind") == "report_count", False).when(F.col("kind").isin(*REPORTED, "trap_caught"), True).otherwise(F.coalesce("sure", F.lit(False)))
    return j.select("doc_id", "assertion", "family", "kind", F.coalesce(passed, F.lit(False)).alias("passed"), sure.alias("confident"))


def evaluate_texts(assertions: DataFrame, texts: DataFrame) -> DataFrame:
    """text_present asks whether the operative text has the target, orphan_found whether one of the texts has what is expected."""
    present = F.col("kind") == "text_present"
    expect = F.try_element_at("expect", F.lit(1))
    needle = F.when(present, F.col("target")).otherwise(expect)
    j = assertions.join(texts.select("doc_id", "text"), "doc_id", "left")
    has = j.groupBy("doc_id", "assertion", "family", "kind", expect.alias("expect")).agg(F.coalesce(F.bool_or(F.contains("text", needle)), F.lit(False)).alias("has"))
    return has.select("doc_id", "assertion", "family", "kind", F.when(present, F.col("has") == (F.coalesce(F.lower("expect"), F.lit("")) == "true")).otherwise(F.col("has")).alias("passed"), F.lit(True).alias("confident"))


def evaluate_closures(assertions: DataFrame, closure: DataFrame) -> DataFrame:
    """closure_contains: resolving the target term (doc_id, term, reached) reaches all that is expected, and anything at all."""
    reached = closure.groupBy("doc_id", F.col("term").alias("target")).agg(F.collect_set(F.lower("reached")).alias("reached"))
    j = assertions.join(reached, ["doc_id", "target"], "left")
    some = F.coalesce(F.size("reached") > 0, F.lit(False))
    missing = F.size(F.array_except(F.transform("expect", F.lower), F.coalesce("reached", F.array().cast("array<string>"))))
    return j.select("doc_id", "assertion", "family", "kind", (some & (F.coalesce(missing, F.lit(0)) == 0)).alias("passed"), some.alias("confident"))


def gold_score(fields: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled fields with correct (what was shown is right) and claim_correct (what was claimed is true, whether a threshold took it or not).

    fields: doc_id, field, value, status, source; labels: doc_id, field, kind, expected, wanted_status, where a
    wanted status is the answer. Labels of fields that were not extracted are left out."""
    j = labels.join(fields, ["doc_id", "field"])
    absent = F.col("value").isNull() & F.col("status").isin("absent_from_document", "external_reference")
    correct = F.when(F.col("wanted_status").isNotNull(), F.col("status").eqNullSafe(F.col("wanted_status"))).when(F.col("expected").isNull(), absent).otherwise(value_match(F.col("kind"), F.col("expected"), F.col("value")))
    correct = F.coalesce(correct, F.lit(False))
    claim = F.when(F.col("source") == "C_negative_space", F.col("expected").isNull()).when(F.col("source") == "E_external_dependency", F.coalesce(F.col("wanted_status") == "external_reference", F.lit(False))).otherwise(correct)
    return j.select("doc_id", "field", "status", correct.alias("correct"), claim.alias("claim_correct"))
