"""Payment schedules: generation, comparison, and checks over the rows in printed order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.functions.scalars import quarter_index


def numbered(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return rows.withColumn("row_index", F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("int"))


def deduplicated(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each payment date, numbered anew."""
    first = rows.withColumn("_n", F.row_number().over(W.partitionBy(*keys, "payment_date").orderBy(*order))).where("_n = 1").drop("_n", "row_index")
    return numbered(first, keys, ["payment_date"])


def generated(rows: DataFrame, principals: DataFrame, keys: list[str], rate: float) -> DataFrame:
    """What is paid and owed: a payment never exceeds what remains; interest runs on the balance before it."""
    w = W.partitionBy(*keys).orderBy("row_index").rowsBetween(W.unboundedPreceding, 0)
    j = rows.join(principals, keys).withColumn("total", F.sum("amount").over(w))
    after = F.greatest(F.lit(0), F.col("principal") - F.col("total")).cast("decimal(20,2)")
    before = F.greatest(F.lit(0), F.col("principal") - F.col("total") + F.col("amount")).cast("decimal(20,2)")
    return j.select(*keys, "row_index", "payment_date", (before - after).cast("decimal(20,2)").alias("paid"), after.alias("balance"), F.round(before.cast("double") * rate / 4, 2).cast("decimal(20,2)").alias("interest"))


def differences(made: DataFrame, printed: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer comparison by row number: rows on one side only, and rows whose date or amount differ."""
    a = made.select(*keys, "row_index", F.col("payment_date").alias("made_date"), F.col("amount").alias("made_amount"), F.lit(True).alias("in_made"))
    b = printed.select(*keys, "row_index", F.col("payment_date").alias("printed_date"), F.col("amount").alias("printed_amount"), F.lit(True).alias("in_printed"))
    j = a.join(b, [*keys, "row_index"], "full_outer")
    kind = F.when(F.col("in_made").isNull(), "extra").when(F.col("in_printed").isNull(), "missing").when(~F.col("made_date").eqNullSafe(F.col("printed_date")), "date").when(~F.col("made_amount").eqNullSafe(F.col("printed_amount")), "amount")
    return j.withColumn("kind", kind).where("kind is not null").drop("in_made", "in_printed")


def not_increasing(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose date is not after the row before."""
    w = W.partitionBy(*keys).orderBy("row_index")
    return rows.withColumn("previous", F.lag("payment_date").over(w)).where("payment_date <= previous")


def uneven(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Gaps in quarters that are not the commonest gap (the smallest of several), from three rows on."""
    w = W.partitionBy(*keys).orderBy("payment_date")
    gaps = rows.withColumn("gap", quarter_index(F.col("payment_date")) - F.lag(quarter_index(F.col("payment_date"))).over(w))
    counts = gaps.where("gap is not null").groupBy(*keys, "gap").agg(F.count("*").alias("c"))
    modal = counts.groupBy(*keys).agg(F.max(F.struct("c", (-F.col("gap")).alias("g"))).alias("m"), F.sum("c").alias("n")).where("n >= 2").select(*keys, (-F.col("m.g")).alias("usual"))
    return gaps.where("gap is not null").join(modal, keys).where("gap <> usual")


def counts_off(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Schedules whose number of rows is not the number of quarters that they span."""
    q = quarter_index(F.col("payment_date"))
    out = rows.groupBy(*keys).agg(F.count("*").alias("rows"), (F.max(q) - F.min(q) + 1).cast("long").alias("quarters"))
    return out.where("rows <> quarters")


def totals_off(rows: DataFrame, principals: DataFrame, keys: list[str]) -> DataFrame:
    """Schedules that pay more than the principal; bullet is what else would remain."""
    s = rows.groupBy(*keys).agg(F.sum("amount").cast("decimal(20,2)").alias("scheduled"))
    return s.join(principals, keys).where("scheduled > principal")


def rising(steps: DataFrame, keys: list[str], order: str, level: str) -> DataFrame:
    """Steps of a covenant that go up where they may only go down."""
    w = W.partitionBy(*keys).orderBy(order)
    return steps.withColumn("previous", F.lag(level).over(w)).where(F.col(level) > F.col("previous"))


def band_faults(bands: DataFrame, keys: list[str]) -> DataFrame:
    """Gaps and overlaps between neighbouring bands (above, upto], lowest first."""
    w = W.partitionBy(*keys).orderBy(F.coalesce("above", F.lit(-1)), "upto")
    nxt = bands.withColumn("next_above", F.lead("above").over(w)).where("next_above is not null and upto is not null")
    return nxt.withColumn("fault", F.when(F.col("upto") < F.col("next_above"), "gap").when(F.col("upto") > F.col("next_above"), "overlap")).where("fault is not null")


def level_payment(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The commonest amount of each schedule, the smallest of several."""
    c = rows.groupBy(*keys, "amount").agg(F.count("*").alias("c"))
    return c.groupBy(*keys).agg(F.max(F.struct("c", (-F.col("amount")).alias("a"))).alias("m"), F.count("*").alias("levels")).select(*keys, (-F.col("m.a")).cast("decimal(20,2)").alias("amount"), F.col("m.c").alias("times"), "levels")
