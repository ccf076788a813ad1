"""Readings, their values and what is told about them: unit, form, status, premises, tranches, export and report counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: The unit of each kind of number, the tolerance of a match.
UNITS = {"money": "USD", "percent": "percent", "ratio": "ratio"}
CLOSE = 0.005
#: Characters of one request: 32,000 tokens of four characters, two thirds of them text. Characters of a definition's context.
SENDABLE, CONTEXT = 85_333, 24_000
DASHES = "‐‑‒–—―−"


def attached_unit(kind: Column, value: Column) -> Column:
    """The unit that a kind of number has by itself; null for other kinds and without a value."""
    units = F.create_map(*[F.lit(x) for pair in UNITS.items() for x in pair])
    return F.when(value.isNotNull(), F.try_element_at(units, kind))


def value_match(kind: Column, expected: Column, observed: Column) -> Column:
    """Whether a text says the expected value: numbers exactly, percentages and ratios nearly, dates by their first ten characters, else by words without regard to case. Nulls match each other."""
    words = lambda c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    a, b = expected.try_cast("decimal(38,10)"), observed.try_cast("decimal(38,10)")
    near = F.abs(a - b) <= F.lit(CLOSE).cast("decimal(38,10)")
    by = F.when(kind.isin("money", "int"), a == b).when(kind.isin("percent", "ratio"), near).when(kind == "date", F.left(expected, F.lit(10)) == F.left(observed, F.lit(10))).otherwise(words(expected) == words(observed))
    return F.when(expected.isNull() | observed.isNull(), expected.isNull() & observed.isNull()).otherwise(F.coalesce(by, F.lit(False)))


def restored(kind: Column, text: Column) -> Column:
    """The text of a value if it reads back to the same text: dates, whole numbers, truth values and texts."""
    day, whole = F.try_to_date(text, "yyyy-MM-dd"), text.try_cast("long")
    return F.when((kind == "date") & (day.cast("string") == text), text).when((kind == "int") & (whole.cast("string") == text), text).when((kind == "bool") & text.isin("true", "false"), text).when(kind == "text", text)


def dash_key(term: Column) -> Column:
    """A term without regard to case, white space and kinds of dashes."""
    return F.lower(F.trim(F.regexp_replace(F.translate(term, DASHES, "-" * len(DASHES)), r"\s+", " ")))


def cited(target: Column) -> Column:
    """How a target is cited: as it is if it says what it is, else as a section."""
    return F.when(F.upper(target).rlike("^(ARTICLE|SECTION)"), target).otherwise(F.concat(F.lit("Section "), target))


def fiscal_year_end(year: Column, month: Column, day: Column, weekday: Column, nearest: Column) -> Column:
    """The last day of a fiscal year: the day, or the month's last where it has fewer; in a year of weeks (weekday, from Monday as 0,
    is not null) the last such weekday of the month, or the one nearest to its end."""
    last = F.last_day(F.make_date(year, month, F.lit(1)))
    back = F.pmod(F.weekday(last) - weekday, F.lit(7))
    of_weeks = F.when(nearest & (back > 3), F.date_add(last, F.lit(7) - back)).otherwise(F.date_sub(last, back))
    return F.when(weekday.isNotNull(), of_weeks).otherwise(F.make_date(year, month, F.least(day, F.dayofmonth(last))))


def fiscal_quarter_ends(year: Column, month: Column, day: Column, weekday: Column | None = None, nearest: Column | None = None) -> Column:
    """The ends of the four quarters of a fiscal year: three months apart, on the year end's day or the last of a shorter month; in a
    year of weeks thirteen weeks each, the fourth up to the year's end, which takes a fifty-third week."""
    weekday, nearest = F.lit(None).cast("int") if weekday is None else weekday, F.lit(False) if nearest is None else nearest
    end = fiscal_year_end(year, month, day, weekday, nearest)

    def by_months(k: Column) -> Column:
        last = F.last_day(F.add_months(F.make_date(year, month, F.lit(1)), k))
        return F.date_add(F.trunc(last, "month"), F.least(day, F.dayofmonth(last)) - 1)

    months = F.transform(F.array(*map(F.lit, (-9, -6, -3, 0))), by_months)
    before = fiscal_year_end(year - 1, month, day, weekday, nearest)
    weeks = F.array(*(F.date_add(before, 91 * q) for q in (1, 2, 3)), end)
    return F.when(weekday.isNotNull(), weeks).otherwise(months)


def surface_forms(value: Column) -> Column:
    """The ways in which a decimal figure is written: as it is, without ending zeros, and as hundredths or hundredfold."""
    def short(c: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(c.cast("decimal(30,6)").cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")

    n = value.try_cast("decimal(20,6)")
    return F.when(n.isNull(), F.array(value)).otherwise(F.array_sort(F.array_distinct(F.array(value, short(n), short(n * 100)))))


def rates(text: Column) -> Column:
    """Percentages of a text that are no thresholds: none after `less than`, `exceed` and the like."""
    marked = F.regexp_replace(text, r"(?i)(less than|greater than|exceeds?|exceeding|at least|in excess of) [0-9]+(?:\.[0-9]+)?%", "")
    return F.transform(F.regexp_extract_all(marked, F.lit(r"([0-9]+(?:\.[0-9]+)?)%"), 1), lambda x: x.cast("decimal(12,4)"))


def rubric_level(scores: Column) -> Column:
    """The level of the highest score, the first of ties; the middle one where all are the same."""
    flat = F.array_max(scores) == F.array_min(scores)
    return F.when(flat, F.floor((F.size(scores) - 1) / 2)).otherwise(F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def sendable(chunks: DataFrame, keys: list[str], limit: int = SENDABLE) -> DataFrame:
    """Chunks (keys, start, end) cut so that none is longer than can be sent: keys, start, end, part."""
    cuts = F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), F.ceil((F.col("end") - F.col("start")) / limit) - 1).cast("long"))
    parts = chunks.select(*keys, F.col("start").alias("s"), F.col("end").alias("e"), F.explode(cuts).alias("part"))
    return parts.select(*keys, (F.col("s") + F.col("part") * limit).alias("start"), F.least("e", F.col("s") + (F.col("part") + 1) * limit).alias("end"), "part")


def unsettled(specs: DataFrame, settled: DataFrame) -> DataFrame:
    """What is still to be asked of each chunk: fields that no rule has settled there. Both: chunk, field."""
    return specs.join(settled.select("chunk", "field").distinct(), ["chunk", "field"], "left_anti")


def rescued(fields: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Fields with empty ones filled by the surest reading that was found later, the first value of ties. found: keys, value, confidence."""
    best = found.groupBy(*keys).agg(F.min(F.struct((-F.col("confidence")).alias("c"), "value")).alias("b")).select(*keys, F.col("b.value").alias("_v"))
    out = fields.join(best, keys, "left")
    return out.withColumns({"rescued": F.col("value").isNull() & F.col("_v").isNotNull(), "value": F.coalesce("value", "_v")}).drop("_v")


def status_counts(fields: DataFrame, keys: list[str]) -> DataFrame:
    return fields.groupBy(*keys, "status").agg(F.count("*").alias("n"))


def fields_per_tier(readings: DataFrame) -> DataFrame:
    """Distinct fields that each tier of passes has read; the tier is what follows the last colon of a pass."""
    return readings.groupBy(F.element_at(F.split("pass_id", ":"), -1).alias("tier")).agg(F.count_distinct("field").alias("fields"))


def grid_top(grid: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The highest value of a grid's column with the level that has it, the first of ties."""
    top = F.min(F.struct((-F.col(column)).alias("v"), "level")).alias("t")
    return grid.where(F.col(column).isNotNull()).groupBy(*keys).agg(top).select(*keys, (-F.col("t.v")).alias(column), F.col("t.level").alias("level"))


def stated_total(table: DataFrame, stated: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of a table of figures beside the total that the text states, where they differ. table: keys, amount; stated: keys, total."""
    sums = table.groupBy(*keys).agg(F.sum("amount").alias("summed"))
    return sums.join(stated, keys).where("summed <> total")


def premises(answers: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """A computed value holds if all of its premises do; it is as sure as the least sure of them. answers: keys, p."""
    return answers.groupBy(*keys).agg(F.min("p").alias("confidence"), F.bool_and(F.col("p") >= threshold).alias("confirmed"))


def criticality(fields: DataFrame) -> DataFrame:
    """The registry's criticality, raised to the scored level where a field needs review."""
    return fields.withColumn("criticality", F.when(F.col("status") == "needs_review", F.greatest("criticality", F.coalesce("scored", F.lit(0)))).otherwise(F.col("criticality")))


def per_tranche(readings: DataFrame, keys: list[str], floor: int) -> DataFrame:
    """The best supported value of each tranche (ties: the surest, then the first value), kept from a support of floor on.

    readings: keys, tranche, value, pass_id, confidence."""
    groups = readings.groupBy(*keys, "tranche", "value").agg(F.count_distinct("pass_id").alias("support"), F.max("confidence").alias("confidence"))
    best = groups.groupBy(*keys, "tranche").agg(F.min(F.struct((-F.col("support")).alias("s"), (-F.col("confidence")).alias("c"), "value")).alias("b"))
    return best.select(*keys, "tranche", F.col("b.value").alias("value"), (-F.col("b.s")).alias("support")).where(F.col("support") >= floor)


def attributed_only(tranches: DataFrame, keys: list[str]) -> DataFrame:
    """A field that is only read for tranches: one value for the deal if all say the same, else none, and why."""
    out = tranches.groupBy(*keys).agg(F.count_distinct("value").alias("_n"), F.min("value").alias("_v"))
    return out.select(*keys, F.when(F.col("_n") == 1, F.col("_v")).alias("value"), F.when(F.col("_n") == 1, "confirmed").otherwise("priced_per_tranche").alias("status"))


def shifted_wrong(values: DataFrame, shifts: list[int], keys: list[str]) -> DataFrame:
    """Wrong values made of right ones by shifts, without those that stand in the text themselves. values: keys, value (all that stand there), right."""
    made = values.where("right").select(*keys, F.explode(F.array(*[F.col("value") + s for s in shifts])).alias("value")).distinct()
    return made.join(values.select(*keys, "value"), [*keys, "value"], "left_anti")


def by_class(outcomes: DataFrame) -> DataFrame:
    """Of each class of fields: n, precision among claims, recall, coverage and silent errors. outcomes: field_class, claimed, correct."""
    claimed, right = F.count_if("claimed"), F.count_if(F.col("claimed") & F.col("correct"))
    return outcomes.groupBy("field_class").agg(
        F.count("*").alias("n"), F.try_divide(right, claimed).cast("decimal(10,6)").alias("precision"), (right / F.count("*")).cast("decimal(10,6)").alias("recall"),
        (claimed / F.count("*")).cast("decimal(10,6)").alias("coverage"), F.count_if(F.col("claimed") & ~F.col("correct")).alias("silent"),
    )


def export_summary(leaves: DataFrame, keys: list[str]) -> DataFrame:
    """Slots that are filled, and those withheld by reason. leaves: keys, value, withheld."""
    reason = F.when(F.col("value").isNotNull(), "populated").otherwise(F.coalesce("withheld", F.lit("empty")))
    return leaves.groupBy(*keys, reason.alias("outcome")).agg(F.count("*").alias("n"))


def deepest_proviso(sentences: DataFrame, keys: list[str]) -> DataFrame:
    """The sentence of each section with the most provisos, the first of those. sentences: keys, ix, text."""
    n = F.regexp_count("text", F.lit(r"(?i)\bprovided\b"))
    best = sentences.withColumn("n", n).groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("m"), "ix")).alias("b"))
    return best.select(*keys, (-F.col("b.m")).alias("provisos"), F.col("b.ix").alias("ix")).where("provisos > 0")


def continued(tables: DataFrame, keys: list[str], gap: int = 400) -> DataFrame:
    """Tables with the number of the run that they continue: one goes on if it has figures and starts within gap of the last one's end."""
    w = W.partitionBy(*keys).orderBy("start")
    breaks = F.coalesce((F.col("start") - F.lag("end").over(w) > gap) | ~F.col("figures"), F.lit(True))
    return tables.withColumn("run", F.sum(breaks.cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)).cast("int"))


def context(bodies: DataFrame, keys: list[str], limit: int = CONTEXT) -> DataFrame:
    """Texts of a term's closure in order, as many as fit the limit, and whether some were left out. bodies: keys, ord, body."""
    upto = F.sum(F.length("body")).over(W.partitionBy(*keys).orderBy("ord").rowsBetween(W.unboundedPreceding, 0))
    kept = bodies.withColumn("_fits", upto <= limit)
    parts = F.sort_array(F.collect_list(F.when(F.col("_fits"), F.struct("ord", "body"))))
    return kept.groupBy(*keys).agg(parts.alias("p"), F.bool_or(~F.col("_fits")).alias("cut")).select(*keys, F.array_join(F.transform("p", lambda x: x["body"]), "\n").alias("text"), "cut")


#: Pairs that a task of contained_tables looks at.
PAIRS = 20_000_000


def contained_tables(tables: DataFrame, regions: DataFrame, keys: list[str], bucket: int = 1024) -> DataFrame:
    """(region, table) where a table lies inside a region, by buckets of offsets: tables: keys, table, start, end; regions: keys, region, start, end.

    The pairs grow with the square of what stands in a bucket. So they are counted first, a bucket's tables are dealt into as many parts as
    it has pairs for tasks, and its regions go to each part: no task has more than PAIRS of one bucket, and none holds more than a bucket's regions."""
    at = tables.withColumn("_b", F.floor(F.col("start") / bucket))
    wide = regions.select(*keys, "region", F.col("start").alias("_s"), F.col("end").alias("_e"), F.explode(F.sequence(F.floor(F.col("start") / bucket), F.floor(F.col("end") / bucket))).alias("_b"))
    on = [*keys, "_b"]
    met = at.groupBy(*on).agg(F.count("*").alias("_n")).join(wide.groupBy(*on).agg(F.count("*").alias("_m")), on)
    tasks = met.agg(F.ceil(F.sum(F.col("_n").cast("double") * F.col("_m")) / PAIRS)).first()[0] or 1
    parts = met.select(*on, F.ceil(F.col("_n").cast("double") * F.col("_m") / PAIRS).cast("int").alias("_k"))
    dealt = at.join(parts, on).withColumn("_p", F.pmod(F.xxhash64("table"), F.col("_k"))).drop("_k")
    sent = wide.join(parts, on).withColumn("_p", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_k").cast("bigint") - 1))).drop("_k")
    n = max(int(tables.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * tables.sparkSession.sparkContext.defaultParallelism, min(2 * tasks, 100_000))
    on = [*on, "_p"]
    pairs = dealt.repartition(n, *on).join(sent.repartition(n, *on).hint("shuffle_hash"), on)
    return pairs.where("_s <= start and end <= _e").select(*keys, "region", "table")


def merged_ladder(results: DataFrame, keys: list[str]) -> DataFrame:
    """Results of several stages as one: fields seen by any, and exhaustive only if all were. results: keys, fields (array), exhaustive."""
    return results.groupBy(*keys).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("fields")))).alias("fields"), F.bool_and("exhaustive").alias("exhaustive"))


def bullet_matches(levels: DataFrame) -> Column:
    """Whether the last payment is what the others leave of the principal; null where principal, level or count is unknown."""
    return F.col("last") == F.col("principal") - F.col("level") * (F.col("n") - 1)
