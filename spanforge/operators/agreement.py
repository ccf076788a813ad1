"""The structured record: slots filled from fields, and what may leave it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Statuses whose value may be exported.
SETTLED = ["confirmed", "absent_from_document"]

#: Path of the record, field that fills it; fixed values of the record's shape.
SLOTS = [
    ("metadata.borrower", "borrower.legal_name"), ("metadata.closing_date", "closing_date"), ("metadata.governing_law", "facility.governing_law"), ("metadata.administrative_agent", "administrative_agent.legal_name"),
    ("tranches.initial_term_loan.commitment", "initial_term_loan.commitment"), ("tranches.initial_term_loan.maturity", "initial_term_loan.maturity_date"), ("tranches.initial_term_loan.amortization", "amortization.quarterly_amount"),
    ("tranches.revolver.commitment", "revolver.commitment"), ("tranches.revolver.maturity", "revolver.maturity_date"), ("tranches.revolver.commitment_fee", "commitment_fee_pct"),
    ("tranches.delayed_draw.commitment", "delayed_draw.commitment"), ("tranches.letter_of_credit.commitment", "lc_sublimit"),
    ("covenants.opening_level", "financial_covenant.opening_level"), ("covenants.final_level", "financial_covenant.final_level"), ("pricing.margin", "applicable_margin.eurodollar_top_level_pct"), ("pricing.floor", "libor_floor_pct"),
]
#: Slots that each tranche takes over from the deal where it has none of its own.
INHERITED = [("margin", "applicable_margin.eurodollar_top_level_pct"), ("floor", "libor_floor_pct")]


def record(fields: DataFrame) -> DataFrame:
    """Every slot of every document in long form: doc_id, path, status, value, basis (the field).

    fields: doc_id, field, status, value. A slot without a field row is unsettled, never missing. A document's fields
    meet in one row and the slots, which are fixed, are filled from it: what is shuffled is the fields alone."""
    said = F.collect_list(F.struct("field", "status", "value"))
    own = fields.groupBy("doc_id").agg(F.when(F.col("doc_id").isNotNull(), said).alias("fs"))
    nothing = F.struct(*(F.lit(None).cast(fields.schema[c].dataType).alias(c) for c in ("field", "status", "value")))

    def filled(path: str, field: str) -> Column:
        hits = F.filter("fs", lambda f: f["field"] == field)
        each = F.when(F.coalesce(F.size(hits), F.lit(0)) > 0, hits).otherwise(F.array(nothing))
        return F.transform(each, lambda f: F.struct(F.lit(path).alias("path"), F.coalesce(f["status"], F.lit("needs_review")).alias("status"), f["value"].alias("value"), F.lit(field).alias("basis")))

    return own.select("doc_id", F.explode(F.flatten(F.array(*(filled(p, f) for p, f in SLOTS)))).alias("s")).select("doc_id", "s.*")


def tranche_terms(fields: DataFrame, attributed: DataFrame, tranches: list[str]) -> DataFrame:
    """Inherited terms of each tranche: its own value (doc_id, field, tranche, value) before the deal's."""
    spark = fields.sparkSession
    wanted = spark.createDataFrame([(t, s, f) for t in tranches for s, f in INHERITED], "tranche string, slot string, field string")
    every = fields.select("doc_id").distinct().join(F.broadcast(wanted))  # a few rows
    own = attributed.withColumnRenamed("value", "own")
    deal = fields.select("doc_id", "field", F.col("value").alias("deal"))
    j = every.join(own, ["doc_id", "field", "tranche"], "left").join(deal, ["doc_id", "field"], "left")
    return j.select("doc_id", "tranche", "slot", F.coalesce("own", "deal").alias("value"), F.when(F.col("own").isNull(), F.col("field")).alias("basis"))


def exported(slots: DataFrame) -> DataFrame:
    """What crosses into the exchange format, and why the rest is withheld."""
    ok = F.col("status").isin(SETTLED)
    return slots.select("doc_id", "path", F.when(ok, F.col("value")).alias("value"), F.when(~ok, F.concat(F.lit("status "), "status")).alias("withheld"))


def facilities(slots: DataFrame) -> DataFrame:
    """Tranches whose commitment is settled and given."""
    c = slots.where(F.col("path").rlike(r"^tranches\..*\.commitment$") & F.col("status").isin(SETTLED) & F.col("value").isNotNull())
    return c.select("doc_id", F.split("path", r"\.")[1].alias("tranche"), F.col("value").alias("commitment"))


def contract_type(tranche: str, level: bool) -> tuple[str | None, str]:
    """The cash-flow contract that a tranche maps to, with the reason."""
    if tranche in ("revolver", "letter_of_credit"):
        return None, "draws are at the borrower's option, so there is no schedule"
    return ("LAM", "level payments") if level else ("LAX", "a schedule of unequal payments")


def coverage(slots: DataFrame) -> DataFrame:
    settled = F.col("status").isin(SETTLED)
    return slots.groupBy("doc_id").agg(F.count_if(settled).alias("settled"), F.count_if(~settled & F.col("value").isNotNull()).alias("unsettled"), F.count_if(~settled & F.col("value").isNull()).alias("empty"))


def nested(slots: DataFrame) -> DataFrame:
    """One row a document: its slots as a map, last of all."""
    return slots.groupBy("doc_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("path", F.to_json(F.struct("status", "value", "basis")))))).alias("agreement"))
