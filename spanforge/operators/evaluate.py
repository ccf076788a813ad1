"""How far stated values can be trusted: thresholds, coverage, splits and error rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.functions.scalars import wilson_lower, wilson_upper

#: A threshold that accepts nothing.
NOTHING = 1.0001


def at_threshold(samples: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """Precision (1 if nothing is accepted), recall and coverage of accepting p >= threshold."""
    taken = F.col("p") >= threshold
    out = samples.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(taken).alias("accepted"), F.count_if(taken & F.col("correct")).alias("right"), F.count_if(F.col("correct")).alias("correct"))
    d = lambda c: c.cast("decimal(12,8)")
    return out.select(
        *keys, "n", "accepted", d(F.when(F.col("accepted") == 0, 1.0).otherwise(F.try_divide("right", "accepted"))).alias("precision"),
        d(F.coalesce(F.try_divide("right", "correct"), F.lit(0.0))).alias("recall"), d(F.col("accepted") / F.col("n")).alias("coverage"),
    )


def sweep(samples: DataFrame, keys: list[str]) -> DataFrame:
    """Every distinct rounded probability as a threshold: what it accepts, and the Wilson bound of that.

    Counts are summed for each probability first, so the running sum is over those, not over samples."""
    by = samples.groupBy(*keys, F.round("p", 4).cast("decimal(6,4)").alias("t")).agg(F.count("*").alias("_c"), F.count_if("correct").alias("_k"))
    w = W.partitionBy(*keys).orderBy(F.desc("t")).rowsBetween(W.unboundedPreceding, 0)
    run = by.withColumns({"n": F.sum("_c").over(w), "right": F.sum("_k").over(w)})
    return run.select(*keys, "t", "n", "right", wilson_lower(F.col("right"), F.col("n")).cast("decimal(12,8)").alias("bound"))


def fit(samples: DataFrame, keys: list[str], target: float | Column) -> DataFrame:
    """The lowest threshold whose bound reaches the target, a number or one of the keys; else the best bound, the higher of ties.

    Where nothing is right the threshold accepts nothing."""
    s = sweep(samples, keys)
    ok = s.where(F.col("bound") >= target).groupBy(*keys).agg(F.min("t").alias("t_ok"))
    best = s.groupBy(*keys).agg(F.max(F.struct("bound", "t")).alias("b"))
    j = best.join(ok, keys, "left")
    t = F.coalesce(F.col("t_ok"), F.when(F.col("b.bound") == 0, F.lit(NOTHING)).otherwise(F.col("b.t")))
    return j.select(*keys, t.cast("decimal(6,4)").alias("threshold"), F.col("t_ok").isNotNull().alias("met"))


def holdout(names: DataFrame, stratum: str, name: str, one_in: int = 3, contaminated: Column | None = None) -> DataFrame:
    """fit or holdout: in each stratum of two or more, the first third by hash is held out, at least one.

    Contaminated documents were looked at while rules were written: they are never held out and don't count."""
    w = W.partitionBy(stratum)
    bad = F.lit(False) if contaminated is None else F.coalesce(contaminated, F.lit(False))
    flagged = names.withColumn("_bad", bad).withColumns({"_n": F.count("*").over(w), "_e": F.count_if(~F.col("_bad")).over(w)})
    ranked = flagged.withColumn("_r", F.row_number().over(w.orderBy("_bad", F.sha2(F.col(name), 256), name)))
    quota = F.greatest(F.lit(1), F.floor(F.col("_e") / one_in))
    side = F.when(~F.col("_bad") & (F.col("_n") >= 2) & (F.col("_r") <= quota), "holdout").otherwise("fit")
    return ranked.withColumn("side", side).drop("_n", "_r", "_e", "_bad")


#: The sets of wrong values that a class is fitted against, each within the next, and the least threshold of a class without any.
FITS = {"labelled": ["labelled"], "off_text": ["labelled", "off_text"], "in_text": ["labelled", "off_text", "in_text", "other_facility"]}
MISTAKES = ["in_text", "other_facility"]
DEFAULT_THRESHOLD = 0.8


def weighted(samples: DataFrame, keys: list[str], target: float) -> DataFrame:
    """keys, weighted: the lowest probability whose expected precision reaches the target, if wrong values come at the highest rate that the labels allow.

    samples: kind, p, correct. It must lie above every value that the text does not hold; null if there is none.
    Counts are summed for each probability first, so the running sums are over those."""
    labelled = F.col("kind") == "labelled"
    right, wrong = labelled & F.col("correct"), F.col("kind").isin(MISTAKES) | (labelled & ~F.col("correct"))
    t = F.round("p", 4).cast("decimal(6,4)")
    by = samples.groupBy(*keys, t.alias("t")).agg(F.count_if(right).alias("r"), F.count_if(wrong).alias("w"), F.count_if(labelled & ~F.col("correct")).alias("lw"), F.count_if(labelled).alias("l"), F.count_if(F.col("kind") == "off_text").alias("off"))
    whole = W.partitionBy(*keys)
    down = whole.orderBy(F.desc("t")).rowsBetween(W.unboundedPreceding, 0)
    run = by.withColumns({"q_r": F.try_divide(F.sum("r").over(down), F.sum("r").over(whole)), "q_w": F.try_divide(F.sum("w").over(down), F.sum("w").over(whole)), "rate": wilson_upper(F.sum("lw").over(whole), F.sum("l").over(whole)), "floor": F.max(F.when(F.col("off") > 0, F.col("t"))).over(whole)})
    precision = F.try_divide((1 - F.col("rate")) * F.col("q_r"), (1 - F.col("rate")) * F.col("q_r") + F.col("rate") * F.col("q_w"))
    ok = (F.col("r") + F.col("w") > 0) & (F.col("t") > F.coalesce("floor", F.lit(-1))) & (F.col("q_r") > 0) & (precision + 1e-9 >= target)
    return run.groupBy(*keys).agg(F.min(F.when(ok, F.col("t"))).alias("weighted"))


def fit_classes(samples: DataFrame, keys: list[str], target: float) -> DataFrame:
    """keys, agreed, adopted: one threshold for each class, fitted against three sets of wrong values.

    All three must have samples; where they differ, the weighted threshold is taken, if there is one. A fit that saw nothing
    wrong is no lower than the default."""
    sets = F.create_map(*[x for kind in ("labelled", "off_text", *MISTAKES) for x in (F.lit(kind), F.array(*(F.lit(n) for n, kinds in FITS.items() if kind in kinds)))])
    each = samples.withColumn("fit", F.explode(F.try_element_at(sets, F.col("kind"))))
    clean = each.groupBy(*keys, "fit").agg(F.bool_and("correct").alias("clean"))
    t = F.when(F.col("clean") & (F.col("threshold") < DEFAULT_THRESHOLD), F.lit(DEFAULT_THRESHOLD).cast("decimal(6,4)")).otherwise(F.col("threshold"))
    fits = fit(each, [*keys, "fit"], target).join(clean, [*keys, "fit"]).withColumn("t", t)
    three = fits.groupBy(*keys).agg(F.count("*").alias("n"), F.min("t").alias("low"), F.max("t").alias("high"))
    agreed = (F.col("n") == len(FITS)) & (F.col("low") == F.col("high"))
    adopted = F.when(agreed, F.col("low")).when(F.col("n") == len(FITS), F.col("weighted"))
    return three.join(weighted(samples, keys, target), keys, "left").select(*keys, agreed.alias("agreed"), adopted.alias("adopted"))


def families(outcomes: DataFrame, register: DataFrame) -> DataFrame:
    """Counts of every registered family, with a total; silent errors are wrong among the confident."""
    j = register.join(outcomes, "family", "left")
    there, sure = F.col("passed").isNotNull(), F.col("confident") & ~F.col("passed")
    out = j.rollup("family").agg(F.count_if(there).alias("n"), F.count_if(F.col("passed")).alias("passed"), F.count_if(there & ~F.col("passed")).alias("failed"), F.count_if(F.col("confident")).alias("confident"), F.count_if(sure).alias("confident_wrong"))
    return out.select(F.coalesce("family", F.lit("all")).alias("family"), "n", "passed", "failed", "confident", "confident_wrong", F.coalesce(F.try_divide("confident_wrong", "confident"), F.lit(0.0)).cast("decimal(12,8)").alias("silent"))


def over_budget(counts: DataFrame, budget: float, least: int) -> DataFrame:
    """Families that fail the gate: too few cases, or more silent errors than allowed."""
    why = F.when(F.col("n") < least, "too few").when(F.col("silent") > budget, "silent errors")
    return counts.withColumn("why", why).where("why is not null")


def disagreements(arms: DataFrame) -> DataFrame:
    """Assertions whose (confident, passed) differs between arms."""
    return arms.groupBy("assertion").agg(F.count_distinct(F.struct("confident", "passed")).alias("kinds"), F.count("*").alias("arms")).where("kinds > 1")


def common_documents(arms: DataFrame) -> DataFrame:
    """Documents that every arm has read; the others are dropped for all."""
    n = arms.agg(F.count_distinct("arm").alias("arms"))
    return arms.groupBy("document").agg(F.count_distinct("arm").alias("have")).join(n).where("have = arms").select("document")  # n is one row


def support_buckets(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("support").agg(F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"))


def floor_advice(buckets: DataFrame, floor: int, least: int = 10) -> DataFrame:
    """Whether the floor on support is earned: too few cases below it to tell, or how often those were right."""
    b = buckets.agg(F.coalesce(F.sum(F.when(F.col("support") < floor, F.col("passed") + F.col("failed"))), F.lit(0)).alias("n_below"), F.coalesce(F.sum(F.when(F.col("support") < floor, F.col("passed"))), F.lit(0)).alias("right_below"))
    return b.withColumn("advice", F.when(F.col("n_below") < least, "INCONCLUSIVE").when(F.col("right_below") * 20 >= F.col("n_below") * 19, "LOWER").otherwise("KEEP"))
