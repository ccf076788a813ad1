"""The outline of a text: articles, sections and the nested clauses in them.

Headings are found in two steps. Every place that could head a division is a candidate, with a weight for
how much it looks like a heading. Then, in each division of the text (what comes before the first exhibit
or schedule, and each of those), the headings are the heaviest run of candidates whose numbers rise all
the way: an ordered dynamic programme in n log n. Citations that stand like headings fall out because
their numbers don't fit; entries of a contents list are dropped before, as their ids come again.

Clauses `(a)`, `(i)`, `(A)`, `(1)` are told apart by what they follow: a marker goes on with the innermost
open list that it is next in, opens a list if it is the first of a kind, and is no clause if it is cited.

A text is read in order, so this runs in Python, a text at a time; texts are spread over tasks.
Null and empty texts have no headings and no clauses. Offsets are code points.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame

from spanforge.operators.spans import of_each

#: Sections that are fewer than this are looked for within lines too; the longest title; small words of titles.
FEW_SECTIONS, LONGEST_TITLE = 5, 80
#: Characters from an entry of a contents list to the next.
CONTENTS_GAP = 300
SMALL_WORDS = {"of", "to", "as", "and", "the", "in", "on", "for", "or", "etc"}
#: Words after which a number cites a section.
CITES = {"section", "sections", "article", "articles", "clause", "clauses", "paragraph", "paragraphs", "subsection", "subsections", "of", "in", "under", "by", "with", "and", "or", "to", "see", "pursuant"}
DIVISIONS = re.compile(r"^[ \t]*(?:EXHIBIT|SCHEDULE|ANNEX|APPENDIX)[ \t]+[A-Z0-9][-A-Z0-9.]*[ \t]*$", re.M)


class Heading(NamedTuple):
    start: int
    level: str
    id: str
    title: str
    key: tuple[int, int, int]
    weight: int


_ROMAN = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100}


def roman(s: str) -> int | None:
    """The value of a Roman numeral in its usual form."""
    total = 0
    for a, b in zip(s, [*s[1:], "I"], strict=False):
        if a not in _ROMAN:
            return None
        total += -_ROMAN[a] if _ROMAN[a] < _ROMAN.get(b, 0) else _ROMAN[a]
    return total if total and s == in_roman(total) else None


def in_roman(n: int) -> str:
    out = ""
    for v, s in ((100, "C"), (90, "XC"), (50, "L"), (40, "XL"), (10, "X"), (9, "IX"), (5, "V"), (4, "IV"), (1, "I")):
        while n >= v:
            out, n = out + s, n - v
    return out


_NUMBER = re.compile(r"(?=[AS0-9])(?:\b(?P<word>ARTICLE|Article|SECTION|Section)[ \t]+(?P<of>[0-9]{1,2}\.[0-9]{1,2}[A-Za-z]?(?![0-9.]*[0-9])|[0-9]{1,2}(?![0-9.]*[0-9])|[IVXLC]+\b)|(?<![\w.$])(?P<bare>[0-9]{1,2}\.[0-9]{1,2}[A-Za-z]?|[0-9]{1,2}(?=\.[ \t]))(?![0-9%]))(?P<stop>[ \t]*[.:\-–—|]*[ \t]*)")
_TITLE_WORD = re.compile(r"[A-Za-z'’]+")


def _titled(text: str, at: int) -> str | None:
    """A title in capitals from at that a full stop closes, in the way of headings within a line."""
    end = text.find(".", at, at + LONGEST_TITLE + 40)
    said = text[at:end] if end > 0 else ""
    words = said.replace(",", " ").replace(";", " ").split()
    if not words or len(words) > 10 or not (text[end + 1 : end + 2] == "" or text[end + 1].isspace()):
        return None
    fits = all(_TITLE_WORD.fullmatch(w) and (w[0].isupper() or w.lower() in SMALL_WORDS) for w in words)
    return said.strip() if fits and words[0][0].isupper() else None


def candidates(text: str) -> list[Heading]:
    """All places that could head an article or a section, in order."""
    anchored, inline, simple = [], [], []
    for m in _NUMBER.finditer(text):
        word, of, bare, mark = m.group("word", "of", "bare", "stop")
        word, number = (word or "").lower(), of or bare
        line = text.rfind("\n", 0, m.start()) + 1
        lead = text[line : m.start()]
        stop = text.find("\n", m.end())
        rest = text[m.end() : stop if stop >= 0 else len(text)]
        at_line, cell = not lead or lead.isspace(), "|" in mark and lead.rstrip().endswith("|")
        dotted = "." in number
        if word == "article":
            n = roman(number) or (int(number) if number.isdigit() else None)
            if n is None:
                continue
            title = rest.strip(" .:-\t")
            if at_line and not title:  # the title may stand on the next line
                after = text[stop + 1 :].lstrip("\n")[: LONGEST_TITLE + 1] if stop >= 0 else ""
                title = after.split("\n")[0].strip(" .:-\t")
                title = title if title.isupper() or title.istitle() else ""
            if at_line and len(title) <= LONGEST_TITLE:
                anchored.append(Heading(m.start(), "article", f"ARTICLE {number}", title, (n, -1, 0), 8))
            elif m["word"] == "ARTICLE" and rest[:1].isupper():
                inline.append(Heading(m.start(), "article", f"ARTICLE {number}", rest[:LONGEST_TITLE].strip(" .:-\t"), (n, -1, 0), 3))
            continue
        if not number[0].isdigit():
            continue
        if not dotted:
            if m["word"] == "SECTION" and at_line and rest[:1].isupper():
                anchored.append(Heading(m.start(), "article", f"SECTION {number}", rest[:LONGEST_TITLE].strip(" .:-\t"), (int(number), -1, 0), 8))
            elif not word and at_line and "." in m["stop"] and rest[:1].isupper():
                simple.append(Heading(m.start(), "section", number, rest[:LONGEST_TITLE].strip(" .:-\t"), (int(number), 0, 0), 4))
            continue
        letter = number[-1] if number[-1].isalpha() else ""
        a, b = number.removesuffix(letter).split(".")
        key = (int(a), int(b), ord(letter) if letter else 0)
        opens = rest[:1].isupper() or rest[:1] in "[“\""
        if at_line and (opens or word == "section" and not rest.strip()):
            short = len(rest) <= LONGEST_TITLE and not rest.rstrip().endswith((",", ";"))
            anchored.append(Heading(m.start(), "section", number, rest.split(". ")[0][:LONGEST_TITLE].strip(" .:-\t"), key, (6 if word else 5) + 2 * short))
        elif cell and rest[:1].isupper():
            inline.append(Heading(m.start(), "section", number, rest.split("|")[0].strip(), key, 4))
        elif "." in m["stop"] and (title := _titled(text, m.end())) is not None and (word or lead.split()[-1:] == [] or lead.split()[-1].lower() not in CITES):
            inline.append(Heading(m.start(), "section", number, title, key, 4))
        elif m["word"] == "SECTION" and rest[:3].isupper():
            inline.append(Heading(m.start(), "section", number, re.match(r"[^a-z\n]*", rest)[0][:LONGEST_TITLE].strip(" .:-\t"), key, 4))
    if sum(h.level == "section" for h in anchored) < FEW_SECTIONS:
        anchored += inline
    return sorted(anchored or simple)


def without_contents(text: str, found: list[Heading]) -> list[Heading]:
    """Candidates but for those of a contents list: the close entries after its title, up to the first id that comes again, if half of
    them do come again after that; and anywhere those whose line ends in leaders and a page and whose id comes again."""
    anchor = text.upper().find("TABLE OF CONTENTS")
    last = {h.id: h.start for h in found}
    block: list[Heading] = []
    seen: set[str] = set()
    for h in found if anchor >= 0 else ():
        if h.start < anchor:
            continue
        if h.id in seen or block and h.start - block[-1].start > CONTENTS_GAP:
            break
        block.append(h)
        seen.add(h.id)
    again = {h.start for h in block if last[h.id] > block[-1].start}
    dropped = again if 2 * len(again) >= len(block) else set()

    def listed(h: Heading) -> bool:
        stop = text.find("\n", h.start)
        return bool(re.search(r"(?:\.{3,}|[ \t]{3,}|\t)[ \t]*[0-9ivx]+[ \t]*$", text[h.start : stop if stop >= 0 else len(text)]))

    return [h for h in found if h.start not in dropped and (last[h.id] == h.start or not listed(h))]


def heaviest_rise(keys: list[tuple], weights: list[int]) -> list[int]:
    """Positions of the heaviest subsequence of strictly rising keys; of equally heavy ones, that whose members come first.

    Best weights that end in a key up to some rank are kept in a tree of partial maxima."""
    if all(a < b for a, b in zip(keys, keys[1:], strict=False)) and min(weights, default=1) > 0:
        return list(range(len(keys)))  # all of them rise
    ranks = {k: i + 1 for i, k in enumerate(sorted(set(keys)))}
    tree: list[tuple[int, int]] = [(0, -1)] * (len(ranks) + 1)  # weight, and the last position of the run
    before, total = [-1] * len(keys), [0] * len(keys)

    def better(a: tuple[int, int], b: tuple[int, int]) -> tuple[int, int]:
        return b if b[0] > a[0] else a

    for p, (k, w) in enumerate(zip(keys, weights, strict=True)):
        r, best = ranks[k] - 1, (0, -1)
        while r > 0:
            best = better(best, tree[r])
            r &= r - 1
        before[p], total[p] = best[1], best[0] + w
        r = ranks[k]
        while r < len(tree):
            tree[r] = better(tree[r], (total[p], p))
            r += r & -r
    at = max(range(len(keys)), key=lambda p: (total[p], -p), default=-1)
    out = []
    while at >= 0:
        out.append(at)
        at = before[at]
    return out[::-1]


class Section(NamedTuple):
    division: int
    start: int
    end: int
    level: str
    id: str
    title: str
    parent: str | None
    reserved: bool


def sections(text: str | None) -> list[Section]:
    """The headings of a text, each up to the next or to the next exhibit; a section's parent is the article of its number, if that is there."""
    if not text:
        return []
    found = without_contents(text, candidates(text))
    cuts = [m.start() for m in DIVISIONS.finditer(text)]
    kept: list[tuple[int, Heading]] = []
    for d in range(len(cuts) + 1):
        lo, hi = ([-1, *cuts][d], [*cuts, len(text)][d])
        own = [h for h in found if lo < h.start < hi]
        kept += [(d, own[p]) for p in heaviest_rise([h.key for h in own], [h.weight for h in own])]
    if not kept:
        return []
    ends = [min([n, *(c for c in cuts[d : d + 1] if c < n)]) for (d, _), n in zip(kept, [*(h.start for _, h in kept[1:]), len(text)], strict=True)]
    articles = {(d, h.key[0]): h.id for d, h in kept if h.level == "article"}
    return [Section(d, h.start, e, h.level, h.id, h.title, articles.get((d, h.key[0])) if h.level == "section" else None, _set_aside(h.title, text[h.start : e])) for (d, h), e in zip(kept, ends, strict=True)]


def _set_aside(title: str, body: str) -> bool:
    said = (title or body[:60]).strip(" [(\t\n.").lower()
    return said.startswith(("reserved", "intentionally omitted", "intentionally left blank", "omitted"))


# -- clauses
class Clause(NamedTuple):
    start: int
    end: int  # of its own text, before its first child or what follows it
    stop: int  # of all that it holds
    marker: str
    level: int
    parent: int  # position of the clause that holds it, or -1


_MARKER = re.compile(r"\(([a-zA-Z]{1,5}|[0-9]{1,2})\)(?=[\s,;.(]|$)")
_CITED = re.compile(r"(?:clauses?|sections?|paragraphs?|subsections?|articles?|foregoing|limbs?)\s*$", re.I)
#: Last letters of those words.
_CITED_ENDS = frozenset("esnhgbESNHGBſ")
_JOINED = re.compile(r"^[\s,]*(?:and|or|through|to|and/or)?[\s,]*$", re.I)
KINDS = ("lower", "roman", "upper", "big roman", "number")


def ordinals(marker: str) -> dict[str, int]:
    """What places a marker can have, by kind of list."""
    out = {}
    if marker.isdigit():
        return {"number": int(marker)}
    small, upper = marker.islower(), marker.isupper()
    if not small and not upper:
        return {}
    n = roman(marker.upper())
    if n is not None:
        out["roman" if small else "big roman"] = n
    if len(set(marker)) == 1 and len(marker) <= 2:  # (a) to (z), then (aa)
        out["lower" if small else "upper"] = ord(marker[0].lower()) - 96 + 26 * (len(marker) - 1)
    if small and marker in ("x", "y", "z"):
        out["last letters"] = "xyz".index(marker) + 1
    return out


#: What is looked up again and again, by a worker and up to a number of entries; plain tables, as functions travel by value.
_ORDINALS: dict[str, dict[str, int]] = {}
_CLAUSES: dict[str, list[tuple[Clause, str]]] = {}
KEPT = 1 << 12


def _kept(known: dict, make, key: str):
    found = known.get(key)
    if found is None:
        if len(known) >= KEPT:
            known.clear()
        found = known[key] = make(key)
    return found


def markers(text: str) -> list[re.Match]:
    """Markers that open something; those that are cited, or joined to one that is, are left out."""
    out, cited_to = [], -1
    for m in _MARKER.finditer(text):
        at = m.start()
        attached = at > 0 and text[at - 1].isalnum() or cited_to == at
        joined = cited_to >= 0 and text[cited_to:at].strip() and _JOINED.match(text[cited_to:at])
        if attached or joined or text[max(0, at - 14) : at].rstrip()[-1:] in _CITED_ENDS and _CITED.search(text[max(0, at - 14) : at]):
            cited_to = m.end()
        else:
            cited_to = -1
            out.append(m)
    return out


def clauses(text: str | None) -> list[Clause]:
    """The nested clauses of a text."""
    if not text:
        return []
    found = markers(text)
    open_: list[list] = []  # kind, ordinal, position in out
    out: list[list] = []
    for k, m in enumerate(found):
        may = _kept(_ORDINALS, ordinals, m[1])
        goes_on = first = None
        for d in range(len(open_) - 1, -1, -1):
            if may.get(open_[d][0]) == open_[d][1] + 1:
                goes_on = d
                break
        if 1 in may.values():
            first = next((kind for kind in ("lower", "roman", "upper", "big roman", "number", "last letters") if may.get(kind) == 1 and all(o[0] != kind for o in open_)), None)
        if goes_on is not None and first is not None:  # (i) after (h): does (ii) come next, or (j), or (i) once more?
            kind, n = open_[goes_on][:2]
            later = (_kept(_ORDINALS, ordinals, found[j][1]) for j in range(k + 1, len(found)))
            if next((o.get(first) == 2 for o in later if o.get(first) in (1, 2) or o.get(kind) == n + 2), False):
                goes_on = None
        if goes_on is None and first is None:  # a gap in an open list
            goes_on = next((d for d in range(len(open_) - 1, -1, -1) if may.get(open_[d][0], 0) > open_[d][1]), None)
            if goes_on is None:
                continue
        if goes_on is not None:
            kind = open_[goes_on][0]
            del open_[goes_on:]
        else:
            kind = first
        open_.append([kind, may[kind], len(out)])
        out.append([m.start(), len(text), len(text), m[1], len(open_), open_[-2][2] if len(open_) > 1 else -1])
    for a, b in zip(out, out[1:], strict=False):
        a[1] = b[0]
    still: list[list] = []
    for a in out:  # a clause stops at the next that is no deeper
        while still and still[-1][4] >= a[4]:
            still.pop()[2] = a[0]
        still.append(a)
    return [Clause(*a) for a in out]


def paths(found: list[Clause]) -> list[str]:
    """path of every clause, in one pass."""
    out: list[str] = []
    for c in found:
        out.append(f"{out[c.parent] if c.parent >= 0 else ''}({c.marker})")
    return out


def path(found: list[Clause], k: int) -> str:
    """Markers from the outermost clause to this one, `(a)(i)`."""
    c = found[k]
    return ("" if c.parent < 0 else path(found, c.parent)) + f"({c.marker})"


# -- over tables
SECTION_DDL = "division int, start long, end long, level string, section string, title string, parent string, reserved boolean"
CLAUSE_DDL = "section string, path string, level int, start long, end long, stop long"


def _each(docs: DataFrame, keys: list[str], text: str, read, ddl: str) -> DataFrame:
    return of_each(docs, keys, text, read, ddl)


def headings(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, division, start, end, level, section, title, parent, reserved) of every heading."""
    return _each(docs, keys, text, sections, SECTION_DDL)


#: Sections up to this length are remembered, as agreements of one form share them.
SHORT = 4_000


def named_clauses(text: str) -> list[tuple[Clause, str]]:
    found = clauses(text)
    return list(zip(found, paths(found), strict=True))


def outlined(text: str | None) -> Iterator[tuple]:
    for s in sections(text):
        if s.level == "section":
            own = text[s.start : s.end]
            for c, p in _kept(_CLAUSES, named_clauses, own) if len(own) <= SHORT else named_clauses(own):
                yield s.id, p, c.level, s.start + c.start, s.start + c.end, s.start + c.stop


def nested(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, section, path, level, start, end, stop) of every clause within a section."""
    return _each(docs, keys, text, outlined, CLAUSE_DDL)

