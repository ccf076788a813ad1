"""Independent readings of a field become one record with an explicit status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.functions.scalars import jaccard
from spanforge.session import durable

SUPPORT_FLOOR = 2
CONFIDENT = ["confirmed", "absent_from_document", "external_reference", "conflicted"]


def _grouped(readings: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    rule = F.col("pass_id").startswith("deterministic:")
    return readings.groupBy(*keys, "key").agg(
        F.count_distinct(F.when(~F.col("echo"), F.col("segmentation"))).alias("support"),
        F.bool_or(rule).alias("deterministic"), F.bool_or(F.col("pass_id") == "deterministic:definitions").alias("from_definition"),
        F.max("confidence").alias("best"), F.count("*").alias("readings"), *more,
    )


def value_groups(readings: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each value of a field. readings: keys, key, segmentation, echo, pass_id, confidence.

    Support counts the views that found the value without having been shown it."""
    return _grouped(readings.where("key is not null"), keys)


def blend(deterministic: Column, best: Column, support: Column, views: int) -> Column:
    """Confidence of a group: rules count as .95 at least, others by confidence and share of views."""
    mixed = F.round(F.least(F.lit(0.99), 0.45 * best + 0.55 * F.least(support, F.lit(views)) / views), 4)
    return F.when(deterministic, F.least(F.lit(0.99), F.greatest(best, F.lit(0.95)))).otherwise(mixed)


def ranked(groups: DataFrame, keys: list[str]) -> DataFrame:
    """Groups with their rank: a definition first, then a rule, then support, then confidence, then the key."""
    order = [F.desc("from_definition"), F.desc("deterministic"), F.desc("support"), F.desc("best"), F.asc("key")]
    return groups.withColumns({"rank": F.row_number().over(W.partitionBy(*keys).orderBy(*order)), "values": F.count("*").over(W.partitionBy(*keys))})


def reconcile(asked: DataFrame, readings: DataFrame, keys: list[str], views: int, floor: int = SUPPORT_FLOOR) -> DataFrame:
    """A row for every asked key, answered or not: status, value, support, confidence, values.

    readings may also have external (a document named instead of a value). They are made and shuffled once: what groups
    them by value also counts them, and the first value in the order of `ranked` is a least one."""
    dealt = readings.select(*keys, "key", "segmentation", "echo", "pass_id", "confidence", "external").repartition(*keys)
    groups = _grouped(dealt, keys, F.bool_and(F.col("key").isNull() & F.col("external").isNotNull()).alias("external_"))
    last = lambda c: F.when(F.col(c), 0).when(~F.col(c), 1).otherwise(2)  # noqa: E731  what is unknown comes last
    order = F.struct(last("from_definition").alias("a"), last("deterministic").alias("b"), (-F.col("support")).alias("c"), F.col("best").isNull().alias("d"), (-F.col("best")).alias("e"), "key", "deterministic", "support", "best")
    found = groups.groupBy(*keys).agg(F.sum("readings").alias("n"), F.bool_and("external_").alias("all_external"), F.count("key").alias("values"), F.min(F.when(F.col("key").isNotNull(), order)).alias("x"))
    out = asked.join(found.hint("merge"), keys, "left").select(*asked.columns, "n", "all_external", "values", *(F.col("x")[c].alias(c) for c in ("key", "deterministic", "support", "best")))
    status = (
        F.when(F.col("n").isNull(), "needs_review")
        .when(F.col("all_external"), "external_reference")
        .when(F.col("key").isNull(), "needs_review")
        .when(F.col("values") > 1, "conflicted")
        .when((F.col("support") < floor) & ~F.col("deterministic"), "needs_review")
        .otherwise("confirmed")
    )
    confidence = blend(F.col("deterministic"), F.col("best"), F.col("support"), views).cast("decimal(10,4)")
    return out.select(*keys, status.alias("status"), F.col("key").alias("value"), F.coalesce("support", F.lit(0)).alias("support"), confidence.alias("confidence"), F.coalesce("values", F.lit(0)).alias("values"))


def representative(spans: DataFrame, keys: list[str], limit: int = 3, most: float = 0.3) -> DataFrame:
    """At most limit spans of each key, best first, none that overlaps a better one by more than most."""
    sorted_ = F.sort_array(F.collect_list(F.struct((-F.col("confidence")).alias("c"), "start", "end")))
    near = lambda a, x: F.exists(a, lambda k: F.coalesce(jaccard(k["start"], k["end"], x["start"], x["end"]), F.lit(0.0)) > most)
    keep = lambda a, x: F.when((F.size(a) >= limit) | near(a, x), a).otherwise(F.concat(a, F.array(x)))
    empty = F.filter(F.col("all"), lambda x: F.lit(False))
    return spans.groupBy(*keys).agg(sorted_.alias("all")).select(*keys, F.explode(F.aggregate("all", empty, keep)).alias("k")).select(*keys, "k.start", "k.end", (-F.col("k.c")).alias("confidence"))


def fragments_dropped(values: DataFrame, keys: list[str]) -> DataFrame:
    """Values that are not the tail of a longer value of the same key."""
    a, b = values.alias("a"), values.alias("b")
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys] + [F.length("b.key") > F.length("a.key"), F.expr("endswith(b.key, a.key)")]
    return a.join(b, on, "left_anti")


def best_prior(readings: DataFrame, keys: list[str]) -> DataFrame:
    """The most confident value of each key, ties to the smallest: what later passes are shown."""
    return readings.where("key is not null").groupBy(*keys).agg(F.min(F.struct((-F.col("confidence")).alias("c"), F.col("key").alias("v"))).alias("x")).select(*keys, F.col("x.v").alias("value"))


def review_queue(fields: DataFrame) -> DataFrame:
    """Fields that a person must see, to be queued by gravity and then sure: gravest first, least certain first; a conflict shows no value."""
    shown = F.when(F.col("status") != "conflicted", F.col("value"))
    return fields.where(F.col("status").isin("needs_review", "conflicted")).withColumns({"value": shown, "gravity": -F.col("criticality"), "sure": F.coalesce("confidence", F.lit(0.0))})


def queue(items: DataFrame, order: list[str]) -> DataFrame:
    """The items with their place in an order, counted from 1: sorted by ranges, numbered within each, and moved by the
    sizes of the ranges before, which are few."""
    part, place = F.spark_partition_id(), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    kept = durable(items.orderBy(*order)).withColumns({"_part": part, "_at": place})
    before = F.coalesce(F.sum("n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sizes = kept.groupBy("_part").agg(F.count("*").alias("n")).select("_part", before.alias("_before"))
    return kept.join(F.broadcast(sizes), "_part").withColumn("place", F.col("_at") + F.col("_before") + 1).drop("_part", "_at", "_before")
