"""The operative text of a set of documents, with the source of every character.

A text is a piece table: an ordered list of pieces, each a stretch of one source document (or glue, which
no document wrote). The base is one piece for each section and for what stands between; an amendment's
changes cut out pieces of a section and put pieces of the amendment in their place, oldest first. So each
offset of the operative text leads back to a document and an offset there, and shifts need no composing.

What an amendment does is read by walking over its targets (sections, definitions, tables, sentences),
verbs and quotations in the order in which they stand: a verb says what the next quotation is. A change
that finds no place is reported with the reason, never dropped.

Changes are read a document a row, sets folded one after the other in a task that has them in order (a set is one agreement and its
amendments).
Null texts have no changes and are empty documents; a set without a base has no operative text and each
of its changes is reported; an empty table gives no rows; of several documents that tie in the order of a
set, that with the smaller id comes first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.operators import outline

#: Fixed value: the section that holds definitions where an amendment does not say which.
DEFINITIONS_SECTION = "1.01"
#: Parts of a section that an amendment can replace alone.
PARTS = {"table": "table", "chart": "table", "grid": "table", "schedule": "table", "first sentence": "first sentence", "last sentence": "last sentence", "final sentence": "last sentence", "proviso": "proviso"}
#: How far a restatement may be from its target, and bucket of offsets for attribution.
REACH, BUCKET = 400, 1 << 14
#: Rows of a batch of folded sets, and characters of their documents.
BATCH, BATCH_CHARS = 10_000, 4_000_000


class Effect(NamedTuple):
    kind: str  # restate, replace, delete, insert, redline
    section: str
    element: str | None
    old: str | None
    new_start: int | None  # of the new text in the amendment
    new_end: int | None
    start: int
    end: int


# -- reading
_TOKEN = re.compile(
    r"""(?P<quote>["“](?P<said>[^"“”]{0,8000})["”])
    | \b(?P<section>[Ss]ections?|SECTION)\s+(?P<of>[0-9]{1,2}\.[0-9]{1,2}[A-Za-z]?(?:\([A-Za-z0-9]{1,4}\))*)
    | \b(?P<definition>[Dd]efinitions?)\b
    | \b(?P<part>first\ sentence|last\ sentence|final\ sentence|table|chart|grid|schedule|proviso)\b
    | \b(?P<restate>restated|(?:to\s+)?read(?:s|ing)?(?=[^.]{0,60}as\s+follows))\b
    | \b(?P<out>delet(?:e|ed|es|ing)|strik(?:e|es|ing)|replac(?:e|es|ing|ed))\b
    | \b(?P<put>insert(?:s|ed|ing)?|add(?:s|ed|ing)?|substitut(?:e|es|ed|ing)|with)\b
    | (?P<whole>in\s+(?:its|their)(?:\s+respective)?\s+entiret(?:y|ies))
    | (?P<follows>\bas\s+follows\s*:?|\bthe\s+following\s*:)
    | (?P<struck>\b(?:stricken|struck|struck-through|deleted|lined-out)\s+text\b)
    | (?P<next>\n\n(?=(?:SECTION|Section)\s+[0-9]|\(?[a-zA-Z0-9]{1,4}\)\s))
    | (?P<blank>\n\n)""",
    re.X,
)


class _Walk:
    """What has been read of one change so far."""

    def __init__(self):
        self.start = self.section = self.part = self.verb = self.old = None
        self.terms: list[str] = []
        self.defining = self.whole = self.put = False
        self.verbs: set[str] = set()


def _element(w: _Walk) -> str | None:
    if w.defining:
        return "definitions:" + "|".join(w.terms) if len(w.terms) > 1 else f"definition:{w.terms[0]}" if w.terms else "definitions:unread"
    return PARTS[w.part] if w.part else None


def _body_end(tokens: list[re.Match], at: int, text: str) -> int:
    """Where unquoted new text that begins at an offset ends: before the next section, or the next paragraph that amends something."""
    for t in tokens:
        if t["next"] and t.start() > at:
            after = text[t.end() :]
            if after[:7].lower() == "section" or re.match(r"(?:[^\n]|\n(?!\n))*?\b(?:hereby|amended|deleted)\b", after):
                return t.start()
    return len(text)


def effects_of(text: str | None) -> list[Effect]:
    """What an amendment changes, in the order in which it says so."""
    if not text:
        return []
    tokens, out, w = list(_TOKEN.finditer(text)), [], _Walk()
    skip = 0

    def emit(kind: str, end: int, new: tuple[int, int] | None = None, old: str | None = None) -> None:
        section = w.section or (DEFINITIONS_SECTION if w.defining else None)
        if section or kind == "redline":
            out.append(Effect(kind, section or "*", _element(w) if kind in ("restate", "delete") and not old else None, old, *(new or (None, None)), w.start if w.start is not None else end, end))

    def flush(end: int) -> None:
        """What was taken out and has nothing put in its place; what is deleted as a whole."""
        if w.old is not None:
            emit("delete", end, old=w.old)
        elif w.whole and w.verbs == {"out"} and w.verb == "deleted":
            emit("delete", end)
        w.old, w.verb, w.whole, w.put = None, None, False, False
        w.verbs = set()

    for k, t in enumerate(tokens):
        if t.start() < skip:
            continue
        kind = t.lastgroup if t.lastgroup != "said" else "quote"
        kind = "section" if kind == "of" else kind
        if kind in ("section", "definition", "part"):
            names_target = w.verb is None and not w.old
            if kind == "section" and names_target and (w.section is None or not (w.defining or w.part)):
                if not (w.defining or w.part) and not _amends(text, t.end()):
                    continue
                if w.start is None or not (w.defining or w.part):
                    w.start = t.start()
                w.section = t["of"]
            elif kind == "section" and not names_target and _amends(text, t.end()):  # a new target
                flush(t.start())
                w = _Walk()
                w.start, w.section = t.start(), t["of"]
            elif kind == "definition" and _amends(text, t.end(), 700):
                flush(t.start())
                w = _Walk()
                w.start, w.defining = t.start(), True
            elif kind == "part" and names_target and re.match(r"\s+(?:(?:set\s+forth|contained|appearing)\s+)?(?:in|of|to)\s+Section", text[t.end() :]):
                flush(t.start())
                w = _Walk()
                w.start, w.part = t.start(), t["part"]
        elif kind == "quote":
            said = (t.start("said"), t.end("said"))
            if w.defining and w.verb is None and not w.section:
                w.terms.append(" ".join(t["said"].split()))
            elif w.verb is None:
                continue
            elif w.old is not None and (w.put or w.verb.startswith("replac")):
                emit("replace", t.end(), _trimmed(text, *said), w.old)
                w.old, w.put = None, False
            elif w.put:
                emit("insert", t.end(), _trimmed(text, *said))
                w.put = False
            elif "out" in w.verbs:
                if w.old is not None:
                    emit("delete", t.start(), old=w.old)
                w.old = t["said"].strip()
        elif kind in ("out", "put"):
            word = t[kind].lower()
            if kind == "put" and word == "with" and w.old is None:
                continue
            if kind == "out" and w.old is not None:
                flush(t.start())
            w.verb, w.put = word, kind == "put"
            w.verbs.add(kind)
        elif kind == "restate":
            w.verb = w.verb or "restated"
            w.verbs.add("restate")
        elif kind == "whole":
            w.whole = True
        elif kind == "struck":
            flush(t.start())
            w.start = w.start if w.start is not None else t.start()
            w.section = None
            emit("redline", t.end())
            w = _Walk()
        elif kind == "follows" and w.verbs and (w.section or w.defining):
            inserted = w.put and "restate" not in w.verbs and w.old is None and not ("out" in w.verbs and w.whole)
            at = t.end() + len(text[t.end() :]) - len(text[t.end() :].lstrip())
            quote = next((q for q in tokens[k + 1 :] if q.start() == at and q["quote"]), None)
            if quote is not None and not w.defining and not _goes_on(text, quote.end()):
                new, skip = (quote.start("said"), quote.end("said")), quote.end()
            else:
                skip = _body_end(tokens, at, text)
                new = (at, skip)
            emit("insert" if inserted else "restate", skip, _trimmed(text, *new))
            w = _Walk()
        elif kind in ("next", "blank"):
            flush(t.start())
            w = _Walk()
    flush(len(text))
    return out


def _amends(text: str, at: int, reach: int = REACH) -> bool:
    """Whether what follows says that something is amended, before the sentence ends."""
    return re.match(rf"(?:[^.\n]|\.[0-9]|\n(?!\n)){{0,{reach}}}?\b(?:(?:is|are|be)\s+(?:hereby\s+)?(?:further\s+)?(?:amended|deleted|restated|replaced))\b", text[at : at + reach + 60]) is not None


def _goes_on(text: str, at: int) -> bool:
    """Whether what was quoted is only a term that new text begins with."""
    return re.match(r"\s*(?:means|shall mean|has the meaning)\b", text[at : at + 40]) is not None


def _trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    while a < b and text[a].isspace():
        a += 1
    while b > a and text[b - 1].isspace():
        b -= 1
    return a, b


# -- pieces
class Piece(NamedTuple):
    doc: str | None  # none: glue
    at: int
    text: str


def split(pieces: list[Piece], at: int) -> tuple[list[Piece], list[Piece]]:
    """The pieces before and from an offset."""
    left, seen = [], 0
    for k, p in enumerate(pieces):
        if seen + len(p.text) > at:
            cut = at - seen
            if not cut:
                return left, pieces[k:]
            return [*left, Piece(p.doc, p.at, p.text[:cut])], [Piece(p.doc, p.at + cut, p.text[cut:]), *pieces[k + 1 :]]
        left.append(p)
        seen += len(p.text)
    return left, []


def put(pieces: list[Piece], a: int, b: int, new: list[Piece]) -> list[Piece]:
    """The pieces with those of [a, b) replaced."""
    left, rest = split(pieces, a)
    return [*left, *(p for p in new if p.text), *split(rest, b - a)[1]]


_DEFINED = re.compile(r"[\"“]\s*([A-Z][^\"”\n]{0,90}?)\s*[\"”]\s*(?:means|shall\s+mean|has\s+the\s+meaning|:)")


def element_bounds(body: str, element: str) -> tuple[int, int] | None:
    """Where a part of a section stands: its table's rows, its first or last sentence, the definition of a term."""
    if element == "table":
        at, rows = 0, []
        for line in body.splitlines(keepends=True):
            if " | " in line:
                rows.append((at, at + len(line)))
            at += len(line)
        return (rows[0][0], rows[-1][1]) if rows else None
    if element in ("first sentence", "last sentence"):
        ends = [m.end() for m in re.finditer(r"[.;](?![0-9])", body)]
        bounds = [(a + len(body[a:b]) - len(body[a:b].lstrip()), b) for a, b in zip([0, *ends], ends, strict=False) if body[a:b].strip(" \n.;")]
        return bounds[0 if element.startswith("first") else -1] if bounds else None
    if element.startswith("definition:"):
        starts = [(m.start(), " ".join(m[1].split()).casefold()) for m in _DEFINED.finditer(body)]
        term = element.split(":", 1)[1].casefold()
        for k, (at, name) in enumerate(starts):
            if name == term:
                return at, starts[k + 1][0] if k + 1 < len(starts) else len(body)
    return None


class _Text:
    """The base as it stands after the changes so far."""

    def __init__(self, doc: str, text: str):
        self.order: list[tuple[str | None, list[Piece]]] = []
        at = 0
        for s in [*outline.sections(text), None]:
            start = s.start if s else len(text)
            if start > at:  # between sections
                self.order.append((None, [Piece(doc, at, text[at:start])]))
            if s:
                self.order.append((s.id, [Piece(doc, s.start, text[s.start : s.end])]))
                at = s.end
        self.place: dict[str, int] = {}
        for k, (name, _) in enumerate(self.order):
            if name is not None:
                self.place.setdefault(name, k)

    def apply(self, e: Effect, doc: str, source: str) -> str | None:
        """Make a change; the reason if it can't be made."""
        name, sub = re.match(r"([^(]+)((?:\([^)]*\))*)$", e.section).groups()
        if name not in self.place:
            return f"Section {name} is not there"
        k = self.place[name]
        pieces = self.order[k][1]
        whole = "".join(p.text for p in pieces)
        lo, hi = 0, len(whole)
        if sub:
            found = outline.clauses(whole)
            at = [c for i, c in enumerate(found) if outline.path(found, i) == sub]
            if len(at) != 1:
                return f"{sub} is not there once in Section {name}"
            lo, hi = at[0].start, at[0].stop
        body = whole[lo:hi]
        new = [] if e.new_start is None else [Piece(doc, e.new_start, source[e.new_start : e.new_end])]
        if e.kind in ("restate", "delete") and e.element and e.element.startswith("definitions:"):
            return self.definitions(k, e, doc, source)
        if e.kind in ("restate", "delete") and e.element:
            bounds = element_bounds(body, e.element)
            if bounds is None:
                return f"the {e.element} is not there in Section {e.section}"
            gap = body[: bounds[1]][len(body[: bounds[1]].rstrip()) :] if bounds[1] < len(body) or e.element == "table" else ""
            pieces = put(pieces, lo + bounds[0], lo + bounds[1] - len(gap), new)
        elif e.kind == "restate":
            head = [] if sub or new and re.match(rf"(?i)section\s+{re.escape(name)}\b", new[0].text) else [Piece(None, 0, f"SECTION {name} ")]
            gap = body[len(body.rstrip()) :]
            pieces = put(pieces, lo, hi - len(gap), [*head, *new])
        elif e.kind in ("replace", "delete") and e.old is not None:
            at = body.find(e.old)
            if at < 0 or not e.old:
                return f"{e.old!r} is not in Section {e.section} as it reads"
            pieces = put(pieces, lo + at, lo + at + len(e.old), new)
        elif e.kind == "delete":
            pieces = put(pieces, lo, hi, [])
        else:
            end = lo + len(body.rstrip())
            pieces = put(pieces, end, end, [Piece(None, 0, " "), *new])
        self.order[k] = (self.order[k][0], pieces)
        return None

    def definitions(self, k: int, e: Effect, doc: str, source: str) -> str | None:
        """Each of several definitions on its own: those that new text carries, or all if they are deleted."""
        terms = [t for t in e.element.split(":", 1)[1].split("|") if t and t != "unread"]
        new_at = {}
        if e.kind == "restate":
            body = source[e.new_start : e.new_end]
            new_at = {t: b for t in terms if (b := element_bounds(body, f"definition:{t}"))}
        done = 0
        for t in terms:
            pieces = self.order[k][1]
            bounds = element_bounds("".join(p.text for p in pieces), f"definition:{t}")
            if bounds is None or e.kind == "restate" and t not in new_at:
                continue
            a, b = _trimmed(source, e.new_start + new_at[t][0], e.new_start + new_at[t][1]) if t in new_at else (0, 0)
            own = "".join(p.text for p in pieces)[bounds[0] : bounds[1]]
            self.order[k] = (self.order[k][0], put(pieces, bounds[0], bounds[0] + len(own.rstrip()), [Piece(doc, a, source[a:b])] if b > a else []))
            done += 1
        return None if done == len(terms) and done else f"{len(terms) - done} of {len(terms)} definitions are not there" if done else "none of the definitions is there"


class Doc(NamedTuple):
    ord: int
    doc_id: str
    role: str
    text: str
    marked: bool


def folded(docs: list[Doc], effects: dict[str, list[Effect]]) -> tuple[_Text | None, list[tuple[str, int, Effect, str | None]]]:
    """The operative text of a set, and each change with the reason why it was not made."""
    docs = sorted(docs)
    base = next((d for d in docs if d.role in ("base", "amendment_and_restatement")), None)
    told: list[tuple[str, int, Effect, str | None]] = []
    for d in docs:  # a marked copy of the whole takes the base's place
        for i, e in enumerate(effects.get(d.doc_id, [])):
            if e.kind == "redline":
                told.append((d.doc_id, i, e, None if d.marked else "no marks of what is struck came with the text"))
                base = d if d.marked else base
    text = _Text(base.doc_id, base.text) if base else None
    for d in docs:
        if d.role != "amendment":
            continue
        for i, e in enumerate(effects.get(d.doc_id, [])):
            if e.kind != "redline":
                told.append((d.doc_id, i, e, text.apply(e, d.doc_id, d.text) if text else "the set has no base"))
    return text, told


# -- over tables
EFFECTS = "set_id string, doc_id string, seq int, kind string, section string, element string, old string, new_start long, new_end long, start long, end long"
FOLDED = "set_id string, seq int, section string, doc_id string, doc_start long, text string, effect int, kind string, target string, reason string"


def effects(chain: DataFrame) -> DataFrame:
    """One row for each change that the amendments of (set_id, doc_id, role, text) state, with the place of its new text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(s, d, i, *e) for s, d, t in zip(f.set_id, f.doc_id, f.text, strict=True) for i, e in enumerate(effects_of(t))]
            out = pd.DataFrame(rows, columns=["set_id", "doc_id", "seq", *Effect._fields])
            yield out.astype({"new_start": "Int64", "new_end": "Int64"})

    return chain.where("role = 'amendment'").select("set_id", "doc_id", "text").mapInPandas(run, EFFECTS)


def _by_set(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple]]]:
    """Sets of rows that come in their order, a set at a time, across batches."""
    of, held = None, []
    for b in batches:
        for set_id, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if held and set_id != of:
                yield of, held
                held = []
            of = set_id
            held.append(tuple(row))
    if held:
        yield of, held


def fold(chain: DataFrame) -> DataFrame:
    """Pieces (seq, section, doc_id, doc_start, text) and changes (effect, kind, target, reason) of each set of (set_id, ord, doc_id,
    role, text, marked); write it before both are read from it. Sets come in order, so a task holds one at a time."""
    schema = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}[t]) for n, t in (c.split() for c in FOLDED.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        chars = 0
        for set_id, own in _by_set(batches):
            held = [Doc(int(o), d, r, t or "", bool(m)) for o, d, r, t, m in own]
            by: dict[str, list[Effect]] = {}
            for d in held:
                if d.role == "amendment":
                    by.setdefault(d.doc_id, []).extend(effects_of(d.text))
            text, told = folded(held, by)
            rows += [(set_id, k, section, p.doc, p.at if p.doc else None, p.text, None, None, None, None) for k, (section, p) in enumerate((s, p) for s, ps in (text.order if text else []) for p in ps)]
            rows += [(set_id, None, None, d, None, None, i, e.kind, e.section, why) for d, i, e, why in told]
            chars += sum(len(d.text) for d in held)
            if len(rows) >= BATCH or chars >= BATCH_CHARS:
                yield _batch(rows, schema)
                rows, chars = [], 0
        if rows:
            yield _batch(rows, schema)

    held = chain.select("set_id", "ord", "doc_id", "role", "text", "marked")
    return held.repartition("set_id").sortWithinPartitions("set_id", "ord", "doc_id").mapInArrow(run, FOLDED)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def pieces(folded_: DataFrame) -> DataFrame:
    """(set_id, seq, start, end, section, doc_id, doc_start, text): the pieces with their place in the operative text."""
    from pyspark.sql import Window as W

    end = F.sum(F.length("text")).over(W.partitionBy("set_id").orderBy("seq").rowsBetween(W.unboundedPreceding, 0))
    return folded_.where("seq is not null").select("set_id", "seq", (end - F.length("text")).alias("start"), end.alias("end"), "section", "doc_id", "doc_start", "text")


def changes(folded_: DataFrame) -> DataFrame:
    """(set_id, doc_id, effect, kind, target, reason): what was made of every change; made without a reason."""
    return folded_.where("effect is not null").select("set_id", "doc_id", "effect", "kind", "target", "reason")


def texts(parts: DataFrame) -> DataFrame:
    """(set_id, text): the operative texts of pieces."""
    ordered = F.sort_array(F.collect_list(F.struct("seq", "text")))
    return parts.groupBy("set_id").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), "").alias("text"))


def attributed(spans: DataFrame, parts: DataFrame) -> DataFrame:
    """spans (set_id, start, end, ...) of the operative text, a row for each piece that they touch: with section, doc_id, doc_start
    and doc_end there (null for glue) and part_start, part_end in the operative text.

    Spans and pieces meet by the set and a bucket of offsets; a pair that shares several buckets is kept in the first."""
    def bucketed(df: DataFrame, start: Column, end: Column) -> DataFrame:
        return df.withColumn("b_", F.explode(F.sequence(F.floor(start / BUCKET), F.floor(F.greatest(start, end - 1) / BUCKET))))

    p = bucketed(parts.select(F.col("set_id").alias("of_"), F.col("start").alias("ps"), F.col("end").alias("pe"), "section", "doc_id", "doc_start").where("pe > ps"), F.col("ps"), F.col("pe")).withColumnRenamed("b_", "pb_")
    s = bucketed(spans, F.col("start"), F.col("end"))
    meets = (s.set_id == p.of_) & (s.b_ == p.pb_) & (s.start < p.pe) & (s.end > p.ps)
    j = s.join(p, meets).where(F.col("b_") == F.floor(F.greatest("start", "ps") / BUCKET))
    a, b = F.greatest("start", "ps"), F.least("end", "pe")
    return j.select(*spans.columns, "section", "doc_id", (F.col("doc_start") + (a - F.col("ps"))).alias("doc_start"), (F.col("doc_start") + (b - F.col("ps"))).alias("doc_end"), a.alias("part_start"), b.alias("part_end"))
