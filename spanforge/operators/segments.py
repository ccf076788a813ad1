"""How a document is cut and what its headings and calendar say: page marks, paragraphs, reserved sections, citations of statutes, fiscal years."""

from __future__ import annotations

import calendar
import re
from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Page numbers that are believed, how few marks are too few, how far a heading and a statute are looked for.
PAGES, LEAST_MARKS, HEADING_LOOK, STATUTE_LOOK, STATUTE_GAP = 2_000, 3, 60, 80, 60
#: Months, weekdays from Monday.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
#: Statutes and regulations whose sections are not the agreement's.
STATUTES = ["c.f.r.", "c.f.r", "cfr", "u.s.c.", "u.s.c", "usc", "treasury regulations", "treasury regulation", "erisa", "internal revenue code", "securities act", "exchange act", "investment company act", "bankruptcy code"]


def page_marks(docs: DataFrame, keys: list[str], text: str = "text", breaks: str | None = None) -> DataFrame:
    """(keys, start, page): numbers alone on a line that count up by one, with page 1 at the start.

    A document whose marks that follow one another are fewer than three, or than half the page breaks
    that its markup has (a column of docs), has no rows: its own breaks are better."""
    own = docs.select(*keys, (F.floor(F.col(breaks) / 2) if breaks else F.lit(0)).alias("half"), F.split(text, "\n").alias("lines"))
    lines = own.select(*keys, "half", F.size("lines").alias("of"), F.posexplode("lines").alias("ix", "line"))
    up_to = W.partitionBy(*keys).orderBy("ix").rowsBetween(W.unboundedPreceding, -1)
    placed = lines.withColumn("start", F.sum(F.length("line") + 1).over(up_to) - 1)  # of the line end before it
    inner = placed.where((F.col("ix") > 0) & (F.col("ix") < F.col("of") - 1))  # a line of its own has neighbours
    number = F.btrim("line", F.lit(" \t"))
    marks = inner.withColumn("page", F.when(F.length(number) <= 4, F.when(F.translate(number, "0123456789", "") == "", number.try_cast("int")))).where(F.col("page").between(1, PAGES))
    follows = F.col("page") == F.lag("page").over(W.partitionBy(*keys).orderBy("ix")) + 1
    runs = marks.withColumn("good", F.coalesce(follows, F.lit(True))).where("good")
    believed = runs.withColumn("n", F.count("*").over(W.partitionBy(*keys))).where(F.col("n") >= F.greatest(F.lit(LEAST_MARKS), F.col("half"))).select(*keys, F.col("start").cast("long").alias("start"), "page")
    return believed.select(*keys).distinct().select(*keys, F.lit(0).cast("long").alias("start"), F.lit(1).alias("page")).unionByName(believed)


def cuts(text: str, most: int) -> list[tuple[int, int]]:
    """Parts of at most that many characters, each to the last empty line in the second half of its window if there is one."""
    gaps = [m.start() for m in re.finditer("(?=\n\n)", text)]
    bounds = [0]
    while bounds[-1] + most < len(text):
        lo, hi = bounds[-1] + most // 2, bounds[-1] + most - 2  # an empty line is two characters, both in the window
        k = bisect_right(gaps, hi) - 1
        bounds.append(gaps[k] if k >= 0 and gaps[k] >= max(lo, bounds[-1] + 1) else bounds[-1] + most)
    return list(zip(bounds, [*bounds[1:], len(text)], strict=True)) if text else []


def paragraphs(docs: DataFrame, keys: list[str], most: int, text: str = "text") -> DataFrame:
    """(keys, part, start, end): a text cut at empty lines into parts of at most that many characters. Each cut depends on the last, so it is a loop within the text."""

    @F.pandas_udf("array<struct<start:long,end:long>>")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"start": a, "end": b} for a, b in cuts(t, most)] if t else [])

    return docs.select(*keys, F.posexplode(cut(F.col(text))).alias("part", "p")).select(*keys, (F.col("part") + 1).alias("part"), "p.start", "p.end")


def _put_aside(words: Column) -> Column:
    """Whether the first of these words set a section aside."""
    one = F.try_element_at(words, F.lit(1))
    more = F.array_join(F.slice(words, 2, 2), " ")
    return one.isin("reserved", "omitted") | ((one == "intentionally") & (more.startswith("omitted") | (more == "left blank")))


def reserved(title: Column, after: Column) -> Column:
    """Whether a section is headed as reserved or omitted, or, where it has no title, goes on so within 60 characters.

    One opening bracket may stand before the words."""

    def first_words(x: Column) -> Column:
        bare = F.lower(F.btrim(x, F.lit(" \t\r\n")))
        bare = F.when(bare.startswith("["), F.btrim(F.substr(bare, F.lit(2)), F.lit(" \t\r\n"))).otherwise(bare)
        return F.split(bare, "[^a-z]+")

    untitled = F.coalesce(F.btrim(title, F.lit(" \t\r\n")), F.lit("")) == ""
    return F.coalesce(_put_aside(first_words(F.when(untitled, F.left(after, F.lit(HEADING_LOOK))).otherwise(title))), F.lit(False))


def cites_statute(before: Column, after: Column) -> Column:
    """Whether a citation of a section means a statute: one named before it, with no full stop and at most 60 characters between, or right after it."""
    names = F.array(*map(F.lit, STATUTES))
    plain = lambda c: F.regexp_replace(F.lower(c), r"\s+", " ")
    ahead, behind = plain(F.right(before, F.lit(STATUTE_LOOK))), plain(F.left(after, F.lit(STATUTE_LOOK)))
    near = lambda rest: (F.length(rest) <= STATUTE_GAP) & ~rest.contains(".")
    named = F.exists(F.concat(names, F.array(F.lit("the code"))), lambda n: ahead.contains(n) & near(F.call_function("substring_index", ahead, n, F.lit(-1))))
    # a regulation that a letter names
    rest = F.regexp_replace(F.substring_index(ahead, "regulation", -1), "^s", "")
    lettered = ahead.contains("regulation") & near(rest) & rest.startswith(" ") & (F.length(F.split_part(F.regexp_replace(rest, "[^a-z ]", " "), F.lit(" "), F.lit(2))) == 1)
    # of or under, then what may stand before a name, a word at a time
    skipped = F.ltrim(behind)
    of = skipped.startswith("of ") | skipped.startswith("under ")
    skipped = F.ltrim(F.regexp_replace(skipped, "^[a-z]+", ""))
    for word in ("the ", "proposed ", "united states "):
        skipped = F.regexp_replace(skipped, f"^{word}", "")
    follows = of & F.exists(names, lambda n: skipped.startswith(n)) | of & (F.split(skipped, "[^a-z0-9_]+")[0] == "code")
    dashed = behind.startswith("-") & F.substring(behind, 2, 1).between("0", "9")
    return F.coalesce(named, F.lit(False)) | F.coalesce(lettered, F.lit(False)) | F.coalesce(follows, F.lit(False)) | F.coalesce(dashed, F.lit(False))


class _Words:
    """Words, numbers and marks of a text in order, and what they mean for a fiscal year."""

    def __init__(self, text: str):
        self.text = text
        found = list(re.finditer(r"[A-Za-z]+|[0-9]+|[^\sA-Za-z0-9]", text))
        self.low = [m[0].lower() for m in found]
        self.spans = [m.span() for m in found]

    def at(self, i: int) -> str:
        return self.low[i] if i < len(self.low) else ""

    def past(self, i: int, *words: str) -> int | None:
        """Where these words end, if they stand at i; `a|b` is either."""
        for w in words:
            if self.at(i) not in w.split("|"):
                return None
            i += 1
        return i

    def may(self, i: int, *words: str) -> int:
        """Where these words end if they stand at i, else i."""
        return self.past(i, *words) or i

    def said(self, i: int, end: int) -> str:
        return "detected: " + " ".join(self.text[self.spans[i][0] : self.spans[end - 1][1]].split())

    def of_weeks(self) -> bool:
        """Whether a year of 52 or 53 weeks is named, with or without marks between its words."""
        solid = [w for w in self.low if w not in "-/"]
        for k, w in enumerate(solid):
            if w in ("52", "53"):
                rest = solid[k + 1 : k + 6]
                rest = rest[rest[:1] == ["or"] :]
                rest = rest[rest[:1] in (["52"], ["53"]) :]
                if rest[:1] == ["week"] and "year" in rest[1:2] + (rest[2:3] if rest[1:2] == ["fiscal"] else []):
                    return True
        return False

    def anchor(self) -> tuple | None:
        """The weekday on which a year of weeks ends: its month, weekday, convention and words."""
        for i, w in enumerate(self.low):
            if w not in WEEKDAYS:
                continue
            nearest = self.past(i + 1, "nearest|closest", "to")
            k = nearest or self.past(i + 1, "on", "or", "before|preceding") or self.past(i + 1, "last", "in|of") or (self.at(i + 2).isalnum() and self.past(i + 3, "in|of") if self.at(i + 1) == "last" else None)
            if not k:
                continue
            k = self.may(self.may(k, "the"), "end", "of") if self.at(k) == "the" else k
            if self.at(k) in MONTHS:
                return MONTHS.index(self.at(k)) + 1, 31, WEEKDAYS.index(w), "weekday_nearest_month_end" if nearest else "last_weekday_of_month", self.said(i, k + 1)
        return None

    def stated(self) -> tuple | None:
        """The day on which a fiscal year is said to end."""
        for i in range(len(self.low)):
            k = self.past(i, "fiscal", "year")
            if not k:
                continue
            k = k + 2 if self.at(k) == "of" else k
            k = self.past(k, "end|ends|ending|ended")
            if not k:
                continue
            k = self.may(self.may(k, "on"), "the")
            if self.at(k) in MONTHS and self.at(k + 1).isdigit():
                month = MONTHS.index(self.at(k)) + 1
                day = self.low[k + 1][:2]
                end = self.spans[k + 1][0] + len(day)
                return month, min(int(day), calendar.monthrange(2024, month)[1]), None, None, "detected: " + " ".join(self.text[self.spans[i][0] : end].split())
        return None


CALENDAR = "month int, day int, weekday int, convention string, source string"


def fiscal_calendar(text: Column) -> Column:
    """The fiscal year that a text states: month, day, weekday and convention of a year of weeks, and the words that say so.

    A year of weeks needs both its name and its anchor; else a stated end of the year; else the calendar's, which the source tells.
    The words are walked in order, so this runs in Python over batches."""

    @F.pandas_udf(CALENDAR)
    def read(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            w = _Words(t or "")
            rows.append((w.anchor() if w.of_weeks() else None) or w.stated() or (12, 31, None, None, "default (document is silent)"))
        out = pd.DataFrame(rows, columns=["month", "day", "weekday", "convention", "source"])
        return out.astype({"month": "int32", "day": "int32", "weekday": "Int32"})

    return read(text)
