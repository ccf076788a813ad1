"""What definitions come to: margins from schedules of nested limbs, dates from expressions over other definitions.

A schedule is read over its clauses (outline.clauses): what stands before a clause and leads into it alone belongs to that clause,
what stands before the first of several belongs to all. A rate counts for the kind of loan that its scope names; default rates and
superseded ones are set aside; a schedule that would need arithmetic, a table or a choice between facilities is declined, with a reason.

A date is a small expression: a day, the date of the agreement, another term, the earliest or latest of some, a span before or after,
an anniversary, a business day, the end of a period. It is known, known but for events that the expression lists beside it, or not
known: the earliest of some dates and events is the earliest date, with the events open; the latest of them is not known. Terms are
followed through the document's definitions until nothing changes; a circle has no date. Each step is a premise, stated in words.

Both read a document's definitions in order, in Python, a document a row; documents are spread over tasks. Null bodies say nothing;
of definitions that repeat a term the first counts; an empty table gives no rows.
"""

from __future__ import annotations

import calendar
import datetime as dt
import re
from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.operators import outline

# -- margins
_RATE = re.compile(r"(?<![\d.])(\d{1,2}(?:\.\d+)?)\s*%")
_NOT_A_RATE_AFTER = re.compile(r"\s*\)?\s*(?:of|times|multiplied)\b", re.I)
_NOT_A_RATE_BEFORE = re.compile(r"(?:[<>≤≥]|\b(?:than|exceed(?:s|ing)?|least|most|over|above|below))\s*(?:or equal to\s*)?(?:[a-z-]+ (?:percent )?)?\(?\s*$", re.I)
_LEADS = re.compile(r"(?:^|[,;.]|\b(?:and|or))\s*((?:for|with respect to|in the case of|as to|in respect of)\s[^,;:()%]{2,80}),?\s*$", re.I)
#: Kinds of loan by the words that name them.
KINDS = {"base_rate": re.compile(r"base rate|\babr\b|prime", re.I), "sofr": re.compile(r"\bsofr\b", re.I), "eurodollar": re.compile(r"eurodollar|eurocurrency|\blibo", re.I), "other": re.compile(r"\brfr\b|\bsonia\b|euribor|term rate|benchmark", re.I)}
_SET_ASIDE = re.compile(r"event of default|overdue|default rate|\bdefault (?:is|has|shall)", re.I)
_SUPERSEDED = re.compile(r"prior to the [\w ]{0,40}amendment|before the [\w ]{0,40}amendment", re.I)
_RAISED = re.compile(r"increas(?:e|ed|ing) by|plus an additional", re.I)
_TABLE = re.compile(r"(?:table|grid|chart)\b[^.]{0,40}\b(?:below|set forth|attached)|set forth (?:below|in the (?:following )?(?:table|grid|chart))", re.I)
_LETTER = re.compile(r"(?:specified|set forth|defined|provided|meaning (?:given|assigned)[^.]{0,30}) in (?:the|such|each|any|a) (?:applicable )?(?P<doc>(?:Agency |Agent |Lender )?Fee Letter)", re.I)
_PROVIDED = re.compile(r"[;,.]?\s*\bprovided,?\s*(?:however,?\s*)?(?:further,?\s*)?that\b", re.I)


class Margin(NamedTuple):
    kind: str | None
    rate: Decimal
    start: int


def limbs(body: str) -> list[tuple[str, int, str]]:
    """(scope, start, text) of each stretch of a schedule: what is said over it, and its own words without those that lead into the next."""
    found = outline.clauses(body)
    if not found:
        return [("", 0, body)]
    own = []  # start, text, what leads into the next clause
    for a, b in [(0, found[0].start), *((c.start, c.end) for c in found)]:
        text = body[a:b]
        m = _LEADS.search(text) if b < len(body) else None
        own.append([a, text[: m.start()] if m else text, m[1] if m else ""])
    led = [o[2] for o in own[:-1]]  # into each clause
    sisters = [k for k, c in enumerate(found) if c.parent == found[0].parent]
    if led[0] and not any(led[k] for k in sisters[1:]):  # said once, before all of them
        own[0][1], led[0] = body[: found[0].start], ""
    out = [("", own[0][0], own[0][1])]
    for k, c in enumerate(found):
        over, up = [led[k]], c.parent
        while up >= 0:
            over += [own[up + 1][1], led[up]]
            up = found[up].parent
        out.append((" ".join(x for x in [own[0][1], *over[::-1]] if x), own[k + 1][0], own[k + 1][1]))
    return out


def rates(text: str) -> list[tuple[Decimal, int]]:
    """Percentages that are rates, and where; those that are shares or thresholds are left out."""
    return [(Decimal(m[1]), m.start()) for m in _RATE.finditer(text) if not _NOT_A_RATE_AFTER.match(text, m.end()) and not _NOT_A_RATE_BEFORE.search(text[max(0, m.start() - 45) : m.start()])]


def kind_of(text: str) -> str | None:
    """The kind of loan that a text names, none if it names several."""
    named = [k for k, p in KINDS.items() if p.search(text)]
    return named[0] if len(named) == 1 else "sofr" if set(named) == {"sofr", "other"} else None


def provisos(body: str) -> list[tuple[int, str]]:
    """The body up to its first proviso, and each proviso, with their starts; those within parentheses stay where they are."""
    cuts, depth, at = [0], 0, 0
    for m in _PROVIDED.finditer(body):
        depth += body.count("(", at, m.start()) - body.count(")", at, m.start())
        at = m.start()
        if depth <= 0:
            cuts.append(m.start())
    return [(a, body[a:b]) for a, b in zip(cuts, [*cuts[1:], len(body)], strict=True)]


def margin_schedule(body: str | None) -> tuple[list[Margin], str | None]:
    """The margins that a schedule states, or the reason why it states none that can be told."""
    if not body:
        return [], None
    letter = _LETTER.search(body)
    if letter and not rates(body):
        return [], f"in another document: {letter['doc']}"
    if _TABLE.search(body):
        return [], "in a table"
    out: list[Margin] = []
    facilities = set()
    for at, part in provisos(body):
        for scope, start, text in limbs(part):
            found, said = rates(text), f"{scope} {text}"
            if not found or _SET_ASIDE.search(said) or _SUPERSEDED.search(text):
                continue
            if _RAISED.search(said):
                return [], "it would have to be added to"
            facilities |= {w for w in ("revolving", "term") if re.search(rf"\b{w} (?:credit )?loan", f"{scope} {text}".lower())}
            kind = kind_of(text) or (kind_of(scope) if not any(p.search(text) for p in KINDS.values()) else None)
            for rate, place in found:
                own = kind
                if own is None and any(p.search(text) for p in KINDS.values()):  # each rate has the kind that is named next after it
                    stop = next((q for _, q in found if q > place), len(text))
                    own = kind_of(text[place:stop]) or kind_of(text[max([0, *(q for _, q in found if q < place)]) : place])
                    if own is None:
                        return [], "the kinds of loan can't be told apart"
                out.append(Margin(own, rate, at + start + place))
    if len(facilities) > 1:
        return [], "it prices several facilities"
    return out, None


def top_margin(body: str | None) -> Decimal | None:
    """The highest margin of loans that are not base rate loans."""
    found, _ = margin_schedule(body)
    return max((m.rate for m in found if m.kind != "base_rate"), default=None)


# -- dates
#: Number words and ordinals up to thirty, months.
UNITS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty".split()
COUNTS = {w: i for i, w in enumerate(UNITS)} | {f"twenty-{UNITS[i]}": 20 + i for i in range(1, 10)} | {"thirty": 30, "sixty": 60, "ninety": 90, "ninety-one": 91}
NTH = {w: i for i, w in enumerate("first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth thirteenth fourteenth fifteenth".split(), 1)}
MONTHS = {m.lower(): i for i, m in enumerate(calendar.month_name) if m}
DEPTH = 8

_DAY = re.compile(r"(?P<m>[A-Z][a-z]+)\s+(?P<d>\d{1,2}),?\s+(?P<y>\d{4})|(?P<d2>\d{1,2})\s+(?P<m2>[A-Z][a-z]+),?\s+(?P<y2>\d{4})|(?P<iso>\d{4}-\d{2}-\d{2})")
_COUNT = r"(?:(?P<word>[a-z]+(?:-[a-z]+)?)\s*)?(?:\(?(?P<num>\d+)\)?)?"
_SPAN = re.compile(_COUNT + r"[\s-]*(?P<unit>business days?|days?|weeks?|months?|years?)\s+(?P<way>after|following|from|before|prior to|preceding)\s+", re.I)
_NTH = re.compile(r"(?:(?P<word>[a-z]+)\s*)?(?:\(?(?P<num>\d+)(?:st|nd|rd|th)\)?\s*)?\s*anniversary\s+(?:date\s+)?of\s+", re.I)
_EACH = re.compile(_COUNT + r"[\s-]*(?P<unit>month|year)s?\s+anniversary\s+of\s+", re.I)
_SOME = re.compile(r"(?P<which>earli(?:er|est)|lat(?:er|est))\s+(?:(?:to\s+occur\s+)?of|to\s+occur\s+of)\b", re.I)
_WORKDAY = re.compile(r"(?:first|next)\s+business\s+day\s+(?P<how>on or after|after|following|occurring after)\s+", re.I)
_LAST = re.compile(r"last\s+day\s+of\s+", re.I)
_MONTH_OF = re.compile(r"(?:the\s+)?(?:calendar\s+)?month\s+in\s+which\s+(?P<rest>.+?)\s+(?:occurs|falls)", re.I | re.S)
_ENDS = re.compile(r"(?P<how>to and including|through and including|to but excluding|to but not including|ending on|ends on|until|through)\s+(?P<rest>.+)", re.I | re.S)
_ROLLED = re.compile(r"not a business day[^.]{0,80}?\b(?P<way>preceding|prior|next|following|succeeding)\b", re.I)
_SAID = re.compile(r"^(?:\s|[:,])*(?:means|shall\s+mean|has\s+the\s+meaning\s+(?:of|given\s+to|assigned\s+to))?[\s,:“\"]*(?:(?:that\s+)?the\s+)?(?:date\s+(?:that|which)\s+(?:is|occurs|falls)\s+)?(?:the\s+)?", re.I)


_AGREED = re.compile(r"(?:date\s+)?(?:of\s+this\s+agreement|hereof)\b|date\s+of\s+this\s+agreement\b|date\s+hereof\b", re.I)
_BARE = re.compile(r"^\s*(?:the|such|each)\s+")


class Day(NamedTuple):
    date: dt.date
    words: str
    open: bool  # events stand beside it
    counted: bool  # no text states it


def shifted(d: dt.date, n: int, unit: str) -> dt.date:
    unit = unit.lower().rstrip("s")
    if unit in ("day", "week"):
        return d + dt.timedelta(days=n * (7 if unit == "week" else 1))
    if unit == "business day":
        step = 1 if n > 0 else -1
        for _ in range(abs(n)):
            d = worked(d + dt.timedelta(days=step), step)
        return d
    months = d.year * 12 + d.month - 1 + n * (12 if unit == "year" else 1)
    y, m = divmod(months, 12)
    return dt.date(y, m + 1, min(d.day, calendar.monthrange(y, m + 1)[1]))


def worked(d: dt.date, step: int = 1) -> dt.date:
    """The next weekday that way, the day itself if it is one; holidays are not known."""
    while d.weekday() > 4:
        d += dt.timedelta(days=step)
    return d


MONTH_NAMES = tuple(calendar.month_name)


def in_words(d: dt.date) -> str:
    return f"{MONTH_NAMES[d.month]} {d.day}, {d.year}"


def _count(m: re.Match, words: dict[str, int]) -> int | None:
    return int(m["num"]) if m["num"] else words.get((m["word"] or "").lower())


class Dates:
    """The dates of a document's terms."""

    def __init__(self, definitions: dict[str, str], agreed: dt.date | None = None):
        self.bodies, self.agreed = definitions, agreed
        self.names = [(n, n.casefold()) for n in sorted(definitions, key=len, reverse=True)]
        self.known: dict[str, tuple[Day | None, tuple[tuple[str, str], ...]]] = {}
        self.steps: dict[tuple[str, str], None] = {}

    def of(self, term: str) -> tuple[Day | None, list[tuple[str, str]]]:
        """The date of a term, and the terms on the way to it with what each is read to say, deepest first."""
        self.steps = {}
        found = self.term(term, ())
        return found, list(self.steps)

    def named(self, text: str) -> str | None:
        bare = _BARE.sub("", text)
        return next((n for n, low in self.names if bare[: len(n)].casefold() == low and not bare[len(n) : len(n) + 1].isalnum()), None)

    def term(self, name: str, way: tuple[str, ...]) -> Day | None:
        if name in way or len(way) > DEPTH or name not in self.bodies:
            return None
        body = " ".join((self.bodies[name] or "").split())
        day = self.read(body, (*way, name))
        if day is None:
            return None
        rolled = (not body.isascii() or "business day" in body.lower()) and _ROLLED.search(body)
        if rolled:
            back = rolled["way"].lower() in ("preceding", "prior")
            to = worked(day.date, -1 if back else 1)
            day = Day(to, f"{day.words}, or the {'preceding' if back else 'next'} Business Day if that date is not a Business Day", day.open, day.counted or to != day.date)
        self.steps[name, f"The text defines the {name} as {day.words}."] = None
        return day

    def read(self, text: str, way: tuple[str, ...]) -> Day | None:
        text = text[_SAID.match(text).end() :]
        m = _DAY.match(text)
        if m:
            try:
                d = dt.date.fromisoformat(m["iso"]) if m["iso"] else dt.date(int(m["y"] or m["y2"]), MONTHS[(m["m"] or m["m2"]).lower()], int(m["d"] or m["d2"]))
            except (KeyError, ValueError):
                return None
            return Day(d, in_words(d), False, False)
        if _AGREED.match(text):
            if self.agreed is None:
                return None
            self.steps["", f"This Agreement is dated as of {in_words(self.agreed)}."] = None
            return Day(self.agreed, "the date of this Agreement", False, False)
        m = _SOME.match(text)
        if m:
            return self.chosen(text[m.end() :], m["which"].lower().startswith("earl"), way)
        m = _WORKDAY.match(text)
        if m:
            d = self.read(text[m.end() :], way)
            on = m["how"].lower() == "on or after"
            return d and Day(worked(d.date + dt.timedelta(days=not on)), f"the first Business Day {'on or after' if on else 'after'} {d.words}", d.open, True)
        years_on = not text.isascii() or "anniversary" in text.lower()  # nothing else is an anniversary
        for p in (_EACH, _NTH, _SPAN) if years_on else (_SPAN,):
            m = p.match(text)
            n = m and _count(m, NTH if p is _NTH else COUNTS)
            if m and n is None and p is _SPAN and not (m["word"] or m["num"]):
                continue
            if not m or n is None:
                continue
            d = self.read(text[m.end() :], way)
            if d is None:
                return None
            if p is _NTH:
                word = next((w for w, i in NTH.items() if i == n), f"{n}th")
                return Day(shifted(d.date, n, "year"), f"the {word} anniversary of {d.words}", d.open, True)
            unit = m["unit"].lower().rstrip("s")
            if p is _EACH:
                return Day(shifted(d.date, n, unit), f"the {n}-{unit} anniversary of {d.words}", d.open, True)
            back = m["way"].lower() in ("before", "prior to", "preceding")
            return Day(shifted(d.date, -n if back else n, unit), f"the date {n} {unit}{'' if n == 1 else 's'} {'before' if back else 'after'} {d.words}", d.open, True)
        m = _LAST.match(text)
        if m:
            rest = text[m.end() :]
            month = _MONTH_OF.match(rest)
            if month:
                d = self.read(month["rest"], way)
                return d and Day(d.date.replace(day=calendar.monthrange(d.date.year, d.date.month)[1]), f"the last day of the month of {d.words}", d.open, True)
            name = self.named(rest)
            d = name and self.period_end(name, way)
            return d and Day(d.date, f"the last day of the {name}", d.open, d.counted)
        name = self.named(text)
        if name is not None:
            d = self.term(name, way)
            return d and Day(d.date, f"the {name}", d.open, d.counted)
        return None

    def chosen(self, text: str, earliest: bool, way: tuple[str, ...]) -> Day | None:
        """The earliest of those that are known, with the others open; the latest only if all are known."""
        found = [c for c in outline.clauses(text) if c.level == 1]
        parts = [re.sub(r"^\([^)]*\)\s*,?", "", text[c.start : c.stop]) for c in found] if len(found) > 1 else re.split(r"\s+and\s+", text, maxsplit=1)
        if len(parts) < 2:
            return None
        read = [self.read(re.sub(r"[\s,;.]+(?:and|or)?[\s,;.]*$", "", p), way) for p in parts]
        days = [d for d in read if d is not None]
        if not days or not earliest and len(days) < len(parts):
            return None
        words = [d.words for d in days] + ["the other dates and events it lists"] * (len(days) < len(parts))
        said = words[0] if len(words) == 1 else ", ".join(words[:-1]) + " and " + words[-1]
        best = (min if earliest else max)(days, key=lambda d: d.date)
        return Day(best.date, f"the {'earliest' if earliest else 'latest'} of {said}", len(days) < len(parts) or any(d.open for d in days), any(d.counted for d in days))

    def period_end(self, name: str, way: tuple[str, ...]) -> Day | None:
        if name in way or len(way) > DEPTH:
            return None
        m = _ENDS.search(" ".join((self.bodies.get(name) or "").split()))
        d = m and self.read(m["rest"], (*way, name))
        if not d:
            return None
        if "but" in m["how"].lower():
            d = Day(d.date - dt.timedelta(days=1), f"the day before {d.words}", d.open, True)
        self.steps[name, f"The text defines the {name} as a period that ends on {d.words}."] = None
        return d


# -- over tables
MARGINS = "kind string, rate decimal(12,4), at long, reason string"
DATES = "term string, date date, open boolean, counted boolean, route array<string>, premises array<string>"


def limb_rows(definitions: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    """(keys, path, limb) of every clause of a body: what is said over it and its own words, without its marker and what joins it to the next."""
    head = ", ".join(f"`{k}` {definitions.schema[k].dataType.simpleString()}" for k in keys)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for *key, b in f.itertuples(index=False, name=None):
                found = outline.clauses(b)
                for k, (scope, _, text) in enumerate(limbs(b or "")[1:]):
                    own = re.sub(r"[\s,;.]+(?:and|or)?[\s,;.]*$", "", re.sub(r"^\([^)]*\)\s*", "", text))
                    rows.append((*key, outline.path(found, k), " ".join(f"{scope} {own}".split())))
            yield pd.DataFrame(rows, columns=[*keys, "path", "limb"])

    return definitions.select(*keys, body).mapInPandas(run, f"{head}, path string, limb string")


def margins(definitions: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    """(keys, kind, rate, at, reason) of every margin; one row with a reason where a schedule is declined, none where it states no rate."""
    head = ", ".join(f"`{k}` {definitions.schema[k].dataType.simpleString()}" for k in keys)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for *key, b in f.itertuples(index=False, name=None):
                found, why = margin_schedule(b)
                rows += [(*key, m.kind, m.rate, m.start, None) for m in found] or ([(*key, None, None, None, why)] if why else [])
            yield pd.DataFrame(rows, columns=[*keys, "kind", "rate", "at", "reason"]).astype({"at": "Int64"})

    return definitions.select(*keys, body).mapInPandas(run, f"{head}, {MARGINS}")


def dates(definitions: DataFrame, agreed: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, term, date, open, counted, route, premises) of every term that has a date; definitions: doc_id, term, body, at (their order);
    agreed: doc_id, agreed, the date of the agreement."""
    kind = definitions.schema[doc_id].dataType.simpleString()
    own = definitions.groupBy(doc_id).agg(F.sort_array(F.collect_list(F.struct("at", "term", "body"))).alias("ds"))
    own = own.select(doc_id, F.col("ds.term"), F.col("ds.body")).join(agreed.select(doc_id, "agreed").hint("merge"), doc_id, "left")
    types = {"term": pa.string(), "date": pa.date32(), "open": pa.bool_(), "counted": pa.bool_(), "route": pa.list_(pa.string()), "premises": pa.list_(pa.string())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, rows = [], []
            for k, (names, texts, day) in enumerate(zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True)):
                bodies: dict[str, str] = {}
                for t, body in zip(names, texts, strict=True):
                    if t is not None:
                        bodies.setdefault(t, body or "")
                read = Dates(bodies, day)
                for t in bodies:
                    found, steps = read.of(t)
                    if found:
                        at.append(k)
                        rows.append((t, found.date, found.open, found.counted, [n for n, _ in steps if n], [s for _, s in steps]))
            columns = zip(*rows, strict=True) if rows else ([] for _ in types)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int32())), *(pa.array(c, t) for c, t in zip(columns, types.values(), strict=True))], names=[doc_id, *types])

    return own.select(doc_id, "term", "body", "agreed").mapInArrow(run, f"{doc_id} {kind}, {DATES}")
