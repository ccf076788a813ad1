"""Rewrites of a document that plant a fault, or that change its form and nothing else, with labels that move along.

A mutation is a list of edits of the source (start, end, new text). Edits are found where a document has the shape for them: a schedule's
rows, a citation, a percentage in words and figures, a definition, an attachment, a grid. They are applied on the source, and labels
(spans of the source with a value) are moved through them: one that an edit touches is marked and has no place, all others keep the text
that they had. Documents are exploded by mutation, so each pair is a row of its own; a mutation for which a document has no shape, or
that would change nothing, gives no row.

Null sources have no shape; of several places the first that fits is taken; labels that touch an edit at its edge alone are moved; an
empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Edit = tuple[int, int, str]

_TABLE = re.compile(r"<table\b[^>]*>.*?</table>", re.S | re.I)
_ROW = re.compile(r"<tr\b[^>]*>.*?</tr>\s*", re.S | re.I)
_CELL = re.compile(r"<t[dh]\b[^>]*>(.*?)</t[dh]>", re.S | re.I)
#: Numbers in words that are planted against a figure, and the section and schedule that nothing is called.
WORDS = ["ten", "fifteen", "twenty", "thirty", "forty", "fifty", "sixty", "seventy"]
NO_SECTION = "99.99"


def _plain(html: str) -> str:
    return " ".join(re.sub(r"<[^>]*>", " ", html).split())


def _table(html: str, *words: str) -> tuple[int, int, list[re.Match]] | None:
    """Bounds and rows of the first table whose first row has all of these words."""
    for t in _TABLE.finditer(html):
        head = _ROW.search(html, t.start(), t.end())
        if head and all(map(_plain(head[0]).lower().__contains__, words)):
            rows = list(_ROW.finditer(html, t.start(), t.end()))
            if len(rows) > 1:
                return t.start(), t.end(), rows
    return None


def _schedule(html: str):
    return _table(html, "date", "payment") or _table(html, "date", "amount") or _table(html, "date", "principal")


def duplicate_table_row(html: str) -> list[Edit]:
    found = _schedule(html)
    if not found or len(found[2]) < 3:
        return []
    row = found[2][len(found[2]) // 2]
    return [(row.end(), row.end(), row[0])]


def drop_table_row(html: str) -> list[Edit]:
    found = _schedule(html)
    if not found or len(found[2]) < 4:
        return []
    row = found[2][len(found[2]) // 2]
    return [(row.start(), row.end(), "")]


def break_cross_reference(html: str) -> list[Edit]:
    m = re.search(r"\b(?:under|of|in|to|by|with)\s+Section\s+(\d{1,2}\.\d{1,2})", html)
    return [(m.start(1), m.end(1), NO_SECTION)] if m else []


def numeral_word_mismatch(html: str) -> list[Edit]:
    m = re.search(rf"\b({'|'.join(WORDS)})\s+percent\s+\((\d+(?:\.\d+)?)%\)", html, re.I)
    return [(m.start(1), m.end(1), next(w for w in WORDS if w != m[1].lower()))] if m else []


def doubly_defined_term(html: str) -> list[Edit]:
    m = re.search(r"([“\"][A-Z][^”\"<]{1,80}[”\"]\s+means\s+[^.<]*?)(\d+(?:\.\d+)?)(%?[^.<]*\.)(?!\d)", html)
    return [(m.end(), m.end(), f" {m[1]}{Decimal(m[2]) + 1}{m[3]}")] if m else []


def referenced_schedule_absent(html: str) -> list[Edit]:
    """Takes away the heading of an attachment that the text cites."""
    for m in re.finditer(r"<(p|h\d)\b[^>]*>\s*SCHEDULE\s+(\d+(?:\.\d+)?)\b.*?</\1>", html, re.S):
        if re.search(rf"Schedule\s+{re.escape(m[2])}\b", html):
            return [(m.start(), m.end(), "")]
    return []


def bps_instead_of_percent(html: str) -> list[Edit]:
    m = re.search(r"(?<![\d.(])(\d{1,2}(?:\.\d{1,2})?)%(?!\))", html)
    return [(m.start(), m.end(), f"{(Decimal(m[1]) * 100).normalize():f} basis points")] if m else []


def thousands_scale(html: str) -> list[Edit]:
    """A table's amounts in thousands under a header that says so, if all of them are whole thousands."""
    for words in (("commitment",), ("principal",), ("amount",)):
        found = _table(html, *words)
        if not found:
            continue
        places = [(r.start() + m.start(1), r.start() + m.end(), m[1]) for r in found[2][1:] for m in re.finditer(r"\$\s?(\d{1,3}(?:,\d{3})*)(?:\.00)?(?![\d.,])", r[0])]
        head = next((c for c in _CELL.finditer(html, found[2][0].start(), found[2][0].end()) if any(w in c[1].lower() for w in words)), None)
        if places and head and all(x.endswith(",000") for _, _, x in places):
            return [(head.end(1), head.end(1), " (in thousands)"), *((a, b, x[:-4]) for a, b, x in places)]
    return []


def nested_html_tables(html: str) -> list[Edit]:
    found = _schedule(html)
    return [(found[0], found[0], "<table><tr><td>"), (found[1], found[1], "</td></tr></table>")] if found else []


def grid_rendered_as_text(html: str) -> list[Edit]:
    """A pricing grid as lines whose columns are set out by blanks."""
    found = _table(html, "level")
    if not found:
        return []
    rows = [[_plain(c[1]) for c in _CELL.finditer(r[0])] for r in found[2]]
    if len({len(r) for r in rows}) != 1 or any(not x for r in rows for x in r):
        return []
    wide = [max(len(r[c]) for r in rows) + 3 for c in range(len(rows[0]))]
    lines = "\n".join("".join(x.ljust(w) for x, w in zip(r, wide, strict=True)).rstrip() for r in rows)
    return [(found[0], found[1], f"<pre>\n\n{lines}\n\n</pre>")]


def table_split_across_pages(html: str) -> list[Edit]:
    found = _schedule(html)
    if not found or len(found[2]) < 3:
        return []
    at = found[2][len(found[2]) // 2].end()
    return [(at, at, "</table><hr><table>")]


#: Name, whether it plants a fault or only changes the form, the check that must find it, how the edits are found.
MUTATIONS: dict[str, tuple[str, str | None, Callable[[str], list[Edit]]]] = {
    "duplicate_table_row": ("injection", "amortization_dates_strictly_increasing", duplicate_table_row),
    "drop_table_row": ("injection", "amortization_dates_evenly_spaced", drop_table_row),
    "break_cross_reference": ("injection", "cross_references_resolve", break_cross_reference),
    "numeral_word_mismatch": ("injection", "numeral_and_words_agree", numeral_word_mismatch),
    "doubly_defined_term": ("injection", "defined_terms_are_unique", doubly_defined_term),
    "referenced_schedule_absent": ("injection", "referenced_schedules_present", referenced_schedule_absent),
    "bps_instead_of_percent": ("invariance", None, bps_instead_of_percent),
    "thousands_scale": ("invariance", None, thousands_scale),
    "nested_html_tables": ("invariance", None, nested_html_tables),
    "grid_rendered_as_text": ("invariance", None, grid_rendered_as_text),
    "table_split_across_pages": ("invariance", None, table_split_across_pages),
}


def edited(source: str, edits: list[Edit]) -> str:
    out, at = [], 0
    for a, b, new in sorted(edits):
        out += [source[at:a], new]
        at = b
    return "".join([*out, source[at:]])


EDITS = "array<struct<start:bigint,end:bigint,new:string>>"


def mutated(docs: DataFrame, doc_id: str = "doc_id", source: str = "html", names: list[str] | None = None) -> DataFrame:
    """(doc_id, mutation, kind, expected, html, edits) of every document and mutation that it has the shape for."""
    kind = docs.schema[doc_id].dataType.simpleString()
    each = docs.select(doc_id, F.col(source).alias("html"), F.explode(F.array(*map(F.lit, names or list(MUTATIONS)))).alias("mutation"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for doc, html, name in zip(f[doc_id], f.html, f.mutation, strict=True):
                what, check, find = MUTATIONS[name]
                edits = sorted(find(html)) if html else []
                out = edited(html, edits) if edits else html
                if out != html:
                    rows.append((doc, name, what, check, out, [{"start": a, "end": b, "new": n} for a, b, n in edits]))
            yield pd.DataFrame(rows, columns=[doc_id, "mutation", "kind", "expected", "html", "edits"])

    return each.mapInPandas(run, f"{doc_id} {kind}, mutation string, kind string, expected string, html string, edits {EDITS}")


def moved_labels(labels: DataFrame, changed: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """labels (doc_id, name, start, end, ...) in every mutated document: mutation, touched, and start and end there, null where touched."""
    j = labels.join(changed.select(F.col(doc_id).alias("of_"), "mutation", "edits"), F.col(doc_id) == F.col("of_")).drop("of_")
    # one fold tells both: how far a label moves, and null once an edit touches it
    def step(s, e):
        touches = (e["start"] < F.col("end")) & (e["end"] > F.col("start")) & ((e["start"] < e["end"]) | (e["start"] > F.col("start")))
        return F.when(touches, F.lit(None)).when(e["end"] <= F.col("start"), s + F.length(e["new"]) - (e["end"] - e["start"])).otherwise(s)

    moved = j.withColumn("by_", F.aggregate("edits", F.lit(0).cast("long"), step))
    return moved.withColumns({"touched": F.col("by_").isNull(), "start": F.col("start") + F.col("by_"), "end": F.col("end") + F.col("by_")}).drop("edits", "by_")
