"""Economic readers over definition bodies, as expressions: provisos, commitments, fees, floors. Limbs, margins and dates are in terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.functions import scalars as S

#: A fee is at most three per cent; terms that define a maturity, in their order.
FEE_CAP = 3
MATURITY_TERMS = ["Maturity Date", "Initial Term Loan Maturity Date", "Term Loan Maturity Date", "Revolving Credit Maturity Date", "Revolving Termination Date", "Final Maturity Date", "Stated Maturity Date", "Termination Date", "Commitment Termination Date"]

_MONEY = r"\$ ?[0-9][0-9,]*(?:\.[0-9]+)?(?: (?:thousand|million|billion))?"


def first(text: Column, pattern: str, group: int = 1) -> Column:
    """The first match's group, null without one."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def once(value: Column, f) -> Column:
    """f of a value that is worked out once, however often f names it."""
    return F.transform(F.array(value), f)[0]


def provisos(body: Column) -> Column:
    """The body up to its first proviso and each proviso, where none of them is in parentheses.

    A proviso's place is outside all parentheses, so the text is cut with what stands in them masked by letters of the same number."""
    def hide(parts: Column) -> Column:
        return F.aggregate(
            F.split(parts, ""), F.struct(F.lit(0).alias("depth"), F.lit("").alias("out")),
            lambda s, c: F.struct(
                (s["depth"] + F.when(c == "(", 1).when(c == ")", -1).otherwise(0)).alias("depth"),
                F.concat(s["out"], F.when((s["depth"] > 0) & (c != ")"), F.lit("x")).otherwise(c)).alias("out"),
            ),
            lambda s: s["out"],
        )

    masked = hide(body)
    starts = F.transform(F.filter(F.transform(F.split(masked, r"(?=\bprovided,? (?:further,? )?that\b)"), lambda x: F.length(x)), lambda n: n > 0), lambda n: n)
    ends = F.transform(F.sequence(F.lit(1), F.size(starts)), lambda i: F.aggregate(F.slice(starts, 1, i), F.lit(0), lambda a, x: a + x))
    pieces = F.zip_with(starts, ends, lambda n, e: F.substr(body, e - n + 1, n))
    return F.transform(pieces, lambda x: F.trim(F.regexp_replace(F.trim(x), r"[;,.]$", "")))


def commitment(body: Column) -> Column:
    """The size that a body states: an aggregate principal amount first, then an initial or aggregate commitment, then
    `commitment of`, the first figure of the first form that is there."""
    forms = [rf"aggregate (?:original |initial )?principal amount (?:of|equal to|not to exceed) ({_MONEY})", rf"(?:initial |aggregate )?(?:amount of (?:the |its )?)?[Cc]ommitments?[^.$]{{0,80}}? (?:is|was|are|of|shall be|equal to) ({_MONEY})", rf"({_MONEY}) (?:in the aggregate|(?:revolving|term|senior)[a-z ]{{0,30}}(?:facility|loan|commitment))"]
    return once(F.coalesce(*[first(body, p) for p in forms]), S.money)


def in_letter(body: Column) -> Column:
    """Whether a body leaves the figure to a fee letter."""
    return body.rlike(r"(?i)(?:set forth|specified|agreed|provided) in (?:the |a |any )?(?:separate )?fee letter")


def fee(body: Column) -> Column:
    """A fee's rate: the first percentage that a fee can have; null where a letter says it."""
    rates = F.filter(F.transform(F.regexp_extract_all(body, F.lit(r"([0-9]+(?:\.[0-9]+)?)%"), 1), lambda x: x.cast("decimal(12,4)")), lambda x: x <= FEE_CAP)
    return F.when(~in_letter(body), F.try_element_at(rates, F.lit(1)))


def floor(body: Column) -> Column:
    """A benchmark's floor: zero in words, `not be less than`, `the greater of ... and`, or `floor of`."""
    zero = body.rlike(r"(?i)(?:less than|below) zero[^.]{0,80}(?:deemed|be) (?:to be )?zero|shall not be less than zero|floor of zero")
    stated = F.coalesce(first(body, r"(?i)(?:not (?:be )?less than|floor of|no less than) ([0-9]+(?:\.[0-9]+)?)%"), first(body, r"(?i)less than ([0-9]+(?:\.[0-9]+)?)%[^.]{0,60}deemed"), first(body, r"(?i)greater of [^.]{0,80}?\b([0-9]+(?:\.[0-9]+)?)%"))
    return F.coalesce(stated.cast("decimal(12,4)"), F.when(zero, F.lit(0).cast("decimal(12,4)")))


# -- tables, as cells: doc_id, table_id, row, col, text
def paired(cells: DataFrame, left, right, label: str, value: str) -> DataFrame:
    """Rows of a table whose first cell and second cell both read: doc_id, table_id, row, label, value."""
    own = cells.where("col < 2").groupBy("doc_id", "table_id", "row").agg(F.max(F.when(F.col("col") == 0, F.col("text"))).alias("_a"), F.max(F.when(F.col("col") == 1, F.col("text"))).alias("_b"))
    return own.select("doc_id", "table_id", "row", left(F.col("_a")).alias(label), right(F.col("_b")).alias(value)).where(F.col(label).isNotNull() & F.col(value).isNotNull())


def amortization_rows(cells: DataFrame) -> DataFrame:
    """Payment dates and amounts as they are printed, rows that repeat among them."""
    return paired(cells, S.date, S.money, "payment_date", "amount")


def ebitda_rows(cells: DataFrame) -> DataFrame:
    """Quarters by their label, and amounts."""
    return paired(cells, lambda c: F.when(c.rlike("[0-9]{4}"), c), S.money, "label", "amount")


def covenant_grid(cells: DataFrame) -> DataFrame:
    """Test periods by their label, and ratios."""
    return paired(cells, lambda c: F.when(c.rlike("[0-9]{4}"), c), S.ratio, "label", "level")


def pricing_grid(cells: DataFrame) -> DataFrame:
    """Levels and the rates of all other columns: doc_id, table_id, row, level, col, rate."""
    levels = cells.where("col = 0").select("doc_id", "table_id", "row", F.col("text").alias("level"))
    rates = cells.where("col > 0").select("doc_id", "table_id", "row", "col", S.percent(F.col("text")).alias("rate")).where("rate is not null")
    return rates.join(levels, ["doc_id", "table_id", "row"])


def commitment_rows(cells: DataFrame, scales: DataFrame) -> DataFrame:
    """Facilities, their amounts by the table's declared scale, and maturities. scales: doc_id, table_id, scale (a word or null)."""
    own = cells.groupBy("doc_id", "table_id", "row").agg(*(F.max(F.when(F.col("col") == i, F.col("text"))).alias(f"c{i}") for i in range(3)))
    by = F.when(F.col("scale") == "thousands", 1_000).when(F.col("scale") == "millions", 1_000_000).otherwise(1)
    read = own.join(scales, ["doc_id", "table_id"], "left").select("doc_id", "table_id", "row", F.col("c0").alias("facility"), (S.money(F.col("c1")) * by).cast("decimal(30,2)").alias("amount"), S.date(F.col("c2")).alias("maturity"))
    return read.where("amount is not null")
