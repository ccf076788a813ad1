"""Column functions that read values out of text and bring them to one form.

All are built-in expressions. Where nothing can be read the result is null, never an error, with
ANSI mode on or off. Offsets are code points from 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"(\(?[$]?\s*[0-9][0-9,]*(?:\.[0-9]+)?)"
#: Scale words and their factors, fixed values.
SCALES = {"thousand": 1_000, "million": 1_000_000, "mm": 1_000_000, "billion": 1_000_000_000, "bn": 1_000_000_000}
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
#: Cardinal words, fixed values.
CARDINALS = {
    "zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10, "eleven": 11, "twelve": 12, "thirteen": 13,
    "fourteen": 14, "fifteen": 15, "sixteen": 16, "seventeen": 17, "eighteen": 18, "nineteen": 19, "twenty": 20, "thirty": 30, "forty": 40, "fifty": 50, "sixty": 60,
    "seventy": 70, "eighty": 80, "ninety": 90, "hundred": 100,
}
DECIMAL = "decimal(38,10)"


def decimal(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9.]", "").try_cast(DECIMAL)


def money(text: Column) -> Column:
    """The first number with its scale word; in parentheses it is negative; before a % it is none."""
    hit = F.regexp_extract(text, r"(\(?)\$?\s*([0-9][0-9,]*(?:\.[0-9]+)?)\s*(thousand|million|billion|mm|bn)?(\)?)\s*(%?)", 0)
    part = lambda i: F.regexp_extract(hit, r"^(\(?)\$?\s*([0-9][0-9,]*(?:\.[0-9]+)?)\s*(thousand|million|billion|mm|bn)?(\)?)\s*(%?)$", i)
    factor = F.lit(1)
    for word, f in SCALES.items():
        factor = F.when(part(3) == word, f).otherwise(factor)
    sign = F.when((part(1) == "(") & (part(4) == ")"), -1).otherwise(1)
    value = (decimal(part(2)) * factor * sign).cast(DECIMAL)
    return F.when((hit == "") | (part(5) == "%"), None).otherwise(value)


def percent(text: Column) -> Column:
    """The first n% or else the first n bps or basis points, divided by 100."""
    direct = F.regexp_extract(text, r"([0-9]+(?:\.[0-9]+)?)\s*%", 1)
    points = F.regexp_extract(text, r"([0-9]+(?:\.[0-9]+)?)\s*(?:bps|basis points)", 1)
    return F.when(direct != "", decimal(direct)).when(points != "", (decimal(points) / 100).cast(DECIMAL))


def ratio(text: Column) -> Column:
    """a : b or a to b as a / b; none where b is 0."""
    a = F.regexp_extract(text, r"([0-9]+(?:\.[0-9]+)?)\s*(?::|to)\s*([0-9]+(?:\.[0-9]+)?)", 1)
    b = F.regexp_extract(text, r"([0-9]+(?:\.[0-9]+)?)\s*(?::|to)\s*([0-9]+(?:\.[0-9]+)?)", 2)
    return F.try_divide(decimal(a), decimal(b)).cast("decimal(20,6)")


def date(text: Column) -> Column:
    """`Month d, yyyy`, `m/d/yyyy`, `m/d/yy` (20yy) or ISO, the first of these that there is; none if it is no day."""
    months = "|".join(MONTHS)
    long = F.regexp_extract(text, rf"((?:{months}) [0-9]{{1,2}}, [0-9]{{4}})", 1)
    slash = lambda i: F.regexp_extract(text, r"\b([0-9]{1,2})/([0-9]{1,2})/([0-9]{4}|[0-9]{2})\b", i)
    year = F.when(F.length(slash(3)) == 2, F.concat(F.lit("20"), slash(3))).otherwise(slash(3))
    iso = F.regexp_extract(text, r"\b([0-9]{4}-[0-9]{2}-[0-9]{2})\b", 1)
    return (
        F.when(long != "", F.try_to_date(long, "MMMM d, yyyy"))
        .when(slash(1) != "", F.try_to_date(F.concat_ws("-", year, F.lpad(slash(1), 2, "0"), F.lpad(slash(2), 2, "0")), "yyyy-MM-dd"))
        .when(iso != "", F.try_to_date(iso, "yyyy-MM-dd"))
    )


def quantity(text: Column) -> Column:
    """struct(value, unit): basis points, percent, multiple, ratio, days, months, years, money, in this order."""
    first = lambda p: F.regexp_extract(text, p, 1)
    out = None
    for pattern, unit in (
        (r"([0-9]+(?:\.[0-9]+)?)\s*(?:bps|basis points)", "bps"), (r"([0-9]+(?:\.[0-9]+)?)\s*%", "percent"), (r"([0-9]+(?:\.[0-9]+)?)x\b", "multiple"),
        (r"([0-9]+(?:\.[0-9]+)?)\s*:\s*[0-9]", "ratio"), (r"([0-9]+)\s+days?\b", "days"), (r"([0-9]+)\s+months?\b", "months"), (r"([0-9]+)\s+years?\b", "years"),
    ):
        value = ratio(text).cast(DECIMAL) if unit == "ratio" else decimal(first(pattern))
        pick = F.struct(value.alias("value"), F.lit(unit).alias("unit"))
        out = F.when(first(pattern) != "", pick) if out is None else out.when(first(pattern) != "", pick)
    m = money(text)
    return out.when(m.isNotNull(), F.struct(m.alias("value"), F.lit("USD").alias("unit")))


#: Unit, canonical unit and factor, fixed values.
UNITS = [
    ("bps", "percent", 0.01), ("percent", "percent", 1.0), ("ratio", "ratio", 1.0), ("multiple", "ratio", 1.0), ("USD", "USD", 1.0), ("USD_thousands", "USD", 1_000.0),
    ("USD_millions", "USD", 1_000_000.0), ("days", "days", 1.0), ("months", "months", 1.0), ("years", "months", 12.0), ("count", "count", 1.0),
]


def canonical(value: Column, unit: Column) -> Column:
    """struct(value, unit) in the canonical unit; null for an unknown unit."""
    out = None
    for name, to, factor in UNITS:
        pick = F.struct((value * F.lit(str(factor)).cast("decimal(18,6)")).cast(DECIMAL).alias("value"), F.lit(to).alias("unit"))
        out = F.when(unit == name, pick) if out is None else out.when(unit == name, pick)
    return out


def scale_declared(text: Column) -> Column:
    """thousands or millions as declared by `in thousands`, `$ in millions` and the like."""
    return F.nullif(F.regexp_extract(F.lower(text), r"\bin (thousands|millions)\b", 1), F.lit(""))


def quarter_index(d: Column) -> Column:
    return F.year(d) * 4 + F.quarter(d) - 1


def value_key(value: Column) -> Column:
    """A decimal without trailing zeros, as text."""
    plain = value.cast("decimal(38,10)").cast("string")
    return F.regexp_replace(F.regexp_replace(plain, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")


def text_key(text: Column) -> Column:
    """White space collapsed, case and dashes folded."""
    return F.lower(F.trim(F.regexp_replace(F.translate(text, "‐‑‒–—−", "------"), r"\s+", " ")))


def flat(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def fold(text: Column) -> Column:
    """Typographic quotes, dashes and spaces to plain ones; zero-width characters go; ligatures are spelt out."""
    out = F.translate(text, "“”„‘’‚–—−‐   ​‌‍﻿", "\"\"\"'''----   ")
    for a, b in (("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff"), ("ﬃ", "ffi"), ("ﬄ", "ffl")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def words_value(text: Column) -> Column:
    """Sum of the cardinal words of `twenty-five`; null if any word is no cardinal."""
    table = F.create_map(*[F.lit(x) for kv in CARDINALS.items() for x in kv])
    values = F.transform(F.split(F.lower(F.trim(text)), r"[\s-]+"), lambda w: F.try_element_at(table, w))
    return F.when(F.exists(values, lambda v: v.isNull()), None).otherwise(F.aggregate(values, F.lit(0), lambda a, v: a + v))


def content_words(text: Column, stop: list[str]) -> Column:
    """Lower-case words of two letters or more that are not stop words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"([a-z0-9][a-z0-9.,%$-]*)"), 1)
    trimmed = F.transform(words, lambda w: F.regexp_replace(w, r"[.,;:]+$", ""))
    return F.filter(trimmed, lambda w: (F.length(w) > 1) & ~w.isin(stop))


def tokens_estimate(text: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.length(text) / 4).cast("int"))


def answer_key(*parts: Column) -> Column:
    """SHA-256 over length-prefixed parts; the same question about the same state has the same key."""
    return F.sha2(F.concat_ws("|", *[F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]), 256)


def wilson_lower(successes: Column, n: Column, z: float = 1.96) -> Column:
    """Lower bound of a share; exactly 0 without trials or successes."""
    p = F.try_divide(successes.cast("double"), n.cast("double"))
    z2 = z * z
    bound = (p + z2 / (2 * n) - z * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)
    return F.when((n == 0) | (successes == 0), 0.0).otherwise(F.greatest(F.lit(0.0), bound))


def wilson_upper(successes: Column, n: Column, z: float = 1.96) -> Column:
    return F.when(n == 0, 1.0).otherwise(1 - wilson_lower(n - successes, n, z))


def overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Characters that two half-open intervals share."""
    return F.greatest(F.lit(0), F.least(a1, b1) - F.greatest(a0, b0))


def jaccard(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    both = overlap(a0, a1, b0, b1)
    return F.try_divide(both.cast("double"), ((a1 - a0) + (b1 - b0) - both).cast("double"))


def shift(d: Column, n: Column, unit: Column) -> Column:
    """n days, months or years later; a day that the month lacks becomes its last."""
    return F.when(unit == "days", F.date_add(d, n.cast("int"))).when(unit == "months", F.add_months(d, n.cast("int"))).when(unit == "years", F.add_months(d, n.cast("int") * 12))


def business_day(d: Column, back: bool = False) -> Column:
    """The day itself from Monday to Friday, else the next such day (or the last before); holidays are not known."""
    w = F.weekday(d)  # Monday 0
    if back:
        return F.date_sub(d, F.greatest(F.lit(0), w - 4))
    return F.date_add(d, F.when(w >= 5, 7 - w).otherwise(0))


def year_fraction(a: Column, b: Column, convention: str) -> Column:
    """A360, A365 or 30E360."""
    if convention == "A360":
        return (F.datediff(b, a) / 360).cast("decimal(18,8)")
    if convention == "A365":
        return (F.datediff(b, a) / 365).cast("decimal(18,8)")
    if convention == "30E360":
        day = lambda d: F.least(F.dayofmonth(d), F.lit(30))
        return (((F.year(b) - F.year(a)) * 360 + (F.month(b) - F.month(a)) * 30 + day(b) - day(a)) / 360).cast("decimal(18,8)")
    raise ValueError(f"unknown day count {convention}")


def fiscal_year_end(year: Column, month: int, weekday: int | None = None, nearest: bool = False) -> Column:
    """The month's last day, or with a weekday (Monday 0) the last such day of the month, or the one nearest to its end."""
    end = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    if weekday is None:
        return end
    back = F.pmod(F.weekday(end) - weekday, F.lit(7))
    last = F.date_sub(end, back)
    return F.when(back > 3, F.date_add(last, 7)).otherwise(last) if nearest else last


def fiscal_quarter(d: Column, end_month: int) -> Column:
    """Fiscal year times 4 plus quarter from 0, for years that end with end_month."""
    return quarter_index(F.add_months(d, 12 - end_month))


def all_in_rate(base: Column, margin: Column, floor: Column, floor_on: Column, spread_adjustment: Column) -> Column:
    """Base plus adjustment plus margin; a floor lies under the base or under the whole rate."""
    adjusted = base + F.coalesce(spread_adjustment, F.lit(0))
    on_base = F.when(floor.isNotNull() & (floor_on == "base"), F.greatest(adjusted, floor)).otherwise(adjusted)
    rate = on_base + margin
    return F.when(floor.isNotNull() & (floor_on == "all_in"), F.greatest(rate, floor)).otherwise(rate)


#: Benchmarks in the order in which they are tried, fixed values.
BENCHMARKS = [("term_sofr", r"term sofr"), ("daily_simple_sofr", r"daily simple sofr"), ("sofr", r"\bsofr\b"), ("libor", r"\blibor\b|\blibo rate\b|eurodollar"), ("prime", r"prime rate|base rate"), ("euribor", r"euribor"), ("sonia", r"sonia")]


def benchmark(text: Column) -> Column:
    t, out = F.lower(text), None
    for name, p in BENCHMARKS:
        out = F.when(t.rlike(p), name) if out is None else out.when(t.rlike(p), name)
    return out


def band(text: Column) -> Column:
    """struct(above, upto): the last `greater than x` and the last `less than or equal to y` of a leverage band."""
    last = lambda p: F.try_element_at(F.regexp_extract_all(F.lower(text), F.lit(p), 1), F.lit(-1)).try_cast("decimal(10,4)")
    return F.struct(last(r"greater than ([0-9]+(?:\.[0-9]+)?)").alias("above"), last(r"less than or equal to ([0-9]+(?:\.[0-9]+)?)").alias("upto"))


def same_value(a: Column, b: Column, tolerance: float = 0.005) -> Column:
    """Equal as numbers within a tolerance after % $ and commas go, or equal as squashed text; two nulls are equal."""
    bare = lambda c: F.regexp_replace(F.regexp_replace(c, r"[%$,\s]", ""), r"(?::1|to1)$", "")
    x, y = bare(a).try_cast("double"), bare(b).try_cast("double")
    return F.when(a.isNull() & b.isNull(), True).when(a.isNull() | b.isNull(), False).when(x.isNotNull() & y.isNotNull(), F.abs(x - y) <= tolerance).otherwise(text_key(a) == text_key(b))


def coerced(kind: Column, raw: Column) -> Column:
    """The raw text of a kind as its value key: one column for all kinds."""
    return (
        F.when(kind == "money", value_key(money(raw)))
        .when(kind == "percent", value_key(percent(raw)))
        .when(kind == "ratio", value_key(ratio(raw).cast(DECIMAL)))
        .when(kind == "date", date(raw).cast("string"))
        .when(kind == "int", F.nullif(F.regexp_replace(raw, r"[^0-9]", ""), F.lit("")))
        .when(kind == "bool", F.lower(F.trim(raw)).isin("true", "yes").cast("string"))
        .otherwise(text_key(raw))
    )


def described(kind: Column, value: Column) -> Column:
    return F.when(kind == "money", F.concat(F.lit("$"), value)).when(kind == "percent", F.concat(value, F.lit("%"))).when(kind == "ratio", F.concat(value, F.lit(" to 1.00"))).otherwise(value)


def price(input_tokens: Column, output_tokens: Column, per_input: float = 3.0, per_output: float = 15.0) -> Column:
    """Dollars of a call at prices a million tokens."""
    return (input_tokens * per_input + output_tokens * per_output) / 1_000_000


def sentence_around(text: Column, start: Column, end: Column, cap: int = 900) -> Column:
    """From after the last `. ` before a span to the next `. ` after it, within cap characters either side."""
    before = F.substring(text, F.greatest(F.lit(1), start - cap + 1), F.least(start, F.lit(cap)))
    after = F.substring(text, end + 1, F.lit(cap))
    back = F.locate(" .", F.reverse(before))
    head = F.when(back > 0, F.right(before, back - 1)).otherwise(before)
    ahead = F.locate(". ", after)
    tail = F.when(ahead > 0, F.substring(after, F.lit(1), ahead)).otherwise(after)
    return F.concat(head, F.substring(text, start + 1, end - start), tail)
