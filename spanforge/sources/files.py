"""Readers of documents and side files, as DataFrames.

Files come through Spark's own readers, so any store works; formats that need a parser are parsed
in the executors from the bytes. A document's id is the first 16 hex digits of the SHA-256 of its
bytes, or of its name where only text is at hand.
"""

from __future__ import annotations

import email
import email.policy
import io
import re
import zipfile
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.session import kept

#: Suffixes that are read, fixed values.
SUFFIXES = (".htm", ".html", ".xhtml", ".mht", ".mhtml", ".pdf", ".txt")
SKIPPED = {"script", "style", "head", "meta", "link", "title", "noscript"}
BLOCKS = {"p", "div", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "header", "footer", "nav", "main", "aside", "table", "tr", "blockquote", "pre", "form", "dl", "dt", "dd", "body"}
STRUCK, INSERTED = {"s", "strike", "del"}, {"ins"}
#: The most columns or rows that a cell is believed to cover.
MOST_SPAN = 1_000
#: Characters of the markup that is read before what it holds is handed on.
BATCH_CHARS = 1_000_000
VOID = {"br", "hr", "img", "input", "meta", "link", "col", "area", "base", "embed", "source", "wbr"}


def decoded(raw: bytes) -> str:
    """UTF-8, else Windows-1252, else Latin-1."""
    for charset in ("utf-8", "cp1252"):
        try:
            return raw.decode(charset)
        except UnicodeDecodeError:
            pass
    return raw.decode("latin-1")


class Reader(HTMLParser):
    """One pass over the markup: text with white space collapsed, blocks apart by a blank line, page
    starts, table cells with their offsets, struck and inserted runs, links.

    Struck text is left out of the text and kept with its place. Unclosed tags are tolerated."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.size = 0
        self.stack: list[tuple[str, str | None]] = []
        self.special = 0  # open tags that are skipped or mark what is in them
        self.pages, self.cells, self.redlines, self.links = [0], [], [], []
        self.table, self.row, self.col, self.tables = -1, -1, -1, 0
        self.open_tables: list[tuple] = []
        self.taken: dict[int, set[int]] = {}  # columns of the open table that cells of this and earlier rows cover, by row
        self.cell: dict | None = None

    def write(self, s: str) -> None:
        self.out.append(s)
        self.size += len(s)

    def tail(self) -> str:
        return self.out[-1][-1:] if self.out else ""

    def block(self) -> None:
        """Two line ends, unless they are there."""
        while self.out and self.out[-1].endswith(" "):
            self.size -= 1
            self.out[-1] = self.out[-1][:-1]
            if not self.out[-1]:
                self.out.pop()
        if self.size and not (self.out and (self.out[-1].endswith("\n\n") or self.out[-1] == "\n" and len(self.out) > 1 and self.out[-2].endswith("\n"))):
            self.write("\n\n")

    @staticmethod
    def mark(tag: str, attrs: dict[str, str | None]) -> str | None:
        style = (attrs.get("style") or "").replace(" ", "").lower()
        if tag in STRUCK or "line-through" in style:
            return "struck"
        if tag in INSERTED or "text-decoration:underline" in style and ("font-weight:bold" in style or "color:" in style):
            return "inserted"
        return None

    def handle_starttag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        attrs = dict(attributes)
        style = (attrs.get("style") or "").replace(" ", "").lower()
        if tag == "br":
            self.write("\n")
        if tag in BLOCKS:
            self.block()
        if tag == "hr" or "page-break-before" in style:
            self.block()
            self.pages.append(self.size)
        if tag == "table":
            self.open_tables.append((self.table, self.row, self.col, self.taken))
            self.taken = {}
            self.table, self.row, self.col = self.tables, -1, -1
            self.tables += 1
        elif tag == "tr":
            self.row, self.col = self.row + 1, -1
        elif tag in ("td", "th"):
            self.close_cell()
            self.col += 1
            if self.col:
                self.write(" | ")
            self.cell = {"table_id": f"T{self.table + 1:03d}", "row": self.row, "col": self.col, "start": self.size, "is_header": tag == "th"} | self.covered(attrs)
        elif tag == "a" and attrs.get("href"):
            self.links.append({"href": attrs["href"], "start": self.size})
        if tag not in VOID:
            self.stack.append((tag, self.mark(tag, attrs) if attrs or tag in STRUCK or tag in INSERTED else None))
            self.special += self.matters(self.stack[-1])

    @staticmethod
    def matters(entry: tuple[str, str | None]) -> bool:
        return entry[0] in SKIPPED or entry[1] is not None

    def covered(self, attrs: dict[str, str | None]) -> dict:
        """Which columns and rows of the table's grid a cell covers: the first that are free in its row."""
        wide, down = (min(MOST_SPAN, max(1, int(x))) if (x := attrs.get(k) or "1").isdigit() else 1 for k in ("colspan", "rowspan"))
        place, taken = 0, self.taken.setdefault(self.row, set())
        while place in taken:
            place += 1
        for r in range(self.row, self.row + down):
            self.taken.setdefault(r, set()).update(range(place, place + wide))
        return {"colspan": wide, "rowspan": down, "place": place}

    def since(self, start: int) -> str:
        """What was written from an offset on, by the last pieces alone."""
        k, n = len(self.out), self.size - start
        while k and n > 0:
            k -= 1
            n -= len(self.out[k])
        return "".join(self.out[k:])[-n if n < 0 else 0 :] if self.size > start else ""

    def close_cell(self) -> None:
        if self.cell is not None:
            text = self.since(self.cell["start"])
            if text.strip():
                self.cells.append(self.cell | {"text": text.strip(), "end": self.size})
            self.cell = None

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th", "tr"):
            self.close_cell()
        if tag == "table" and self.open_tables:
            self.close_cell()
            self.table, self.row, self.col, self.taken = self.open_tables.pop()
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                if self.special:
                    self.special -= sum(map(self.matters, self.stack[k:]))
                del self.stack[k:]
                break
        if tag in BLOCKS:
            self.block()

    def handle_data(self, data: str) -> None:
        if self.special and any(t in SKIPPED for t, _ in self.stack):
            return
        words = " ".join(data.split())
        if not words:
            if data and self.tail() not in ("", " ", "\n"):
                self.write(" ")
            return
        kind = next((m for _, m in reversed(self.stack) if m), None) if self.special else None
        if kind == "struck":
            self.redlines.append({"kind": kind, "start": self.size, "end": self.size, "text": words[:400]})
            return
        if data[:1].isspace() and self.tail() not in ("", " ", "\n"):
            self.write(" ")
        start = self.size
        self.write(words)
        if kind:
            self.redlines.append({"kind": kind, "start": start, "end": self.size, "text": words[:400]})
        if data[-1:].isspace():
            self.write(" ")


#: A tag or a stretch of text of plain markup, which any reader takes for the same; and elements whose content is no markup.
_PLAIN = re.compile(r'''<(/)?([a-zA-Z][a-zA-Z0-9]*)(?(1)|((?:[ \n]+[a-zA-Z][-a-zA-Z]*=(?:"[^"<>&]*"|[a-zA-Z0-9%#.]+(?=[ >])))*)(?:[ \n]*(/))?)>|([^<]+)''')
_ATTRIBUTE = re.compile(r'''([a-zA-Z][-a-zA-Z]*)=(?:"([^"]*)"|([^ \n>"]+))''')
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext", "svg", "math"}


def plain_tags(markup: str) -> list[tuple] | None:
    """The tags and texts of plain markup (closes, tag, attributes, closed at once, text), None for any other."""
    at, out = 0, []
    for m in _PLAIN.finditer(markup):
        if m.start() != at:
            return None
        at = m.end()
        closes, tag, attrs, once, text = m.groups()
        if tag is not None:
            tag = tag.lower()
            if tag in RAW:
                return None
        out.append((closes, tag, [(k.lower(), v if bare == "" else bare) for k, v, bare in _ATTRIBUTE.findall(attrs)] if attrs else [], once, text))
    return out if at == len(markup) else None


#: Tags that stand alone or have the columns and rows that a cell covers; what a reader does at each: 0 nothing, 1 block, 2 table, 3 row, 4 cell, 5 header, 6 line, 7 page; closing: 11 block, 12 table, 13 row, 14 cell.
#: A whole cell of a text without blanks at its ends comes first, as most are.
_SIMPLE = re.compile(r"<td>([^\s<>&](?:[^<>&]*[^\s<>&])?)</td>|<(/?[a-zA-Z][a-zA-Z0-9]*)((?: (?:colspan|rowspan)=(?:\"[0-9]+\"|[0-9]+))*)>")
_COVERS = re.compile(r"(colspan|rowspan)=\"?([0-9]+)")
_DOES: dict[str, int | None] = {}


def _does(tag: str) -> int | None:
    """None for tags whose content is no plain text."""
    own = tag.lower().removeprefix("/")
    if own in RAW or own in SKIPPED or own in STRUCK or own in INSERTED:
        return None
    if tag[0] == "/":
        return {"table": 12, "tr": 13, "td": 14, "th": 14}.get(own, 11 if own in BLOCKS else 0)
    return {"table": 2, "tr": 3, "td": 4, "th": 5, "br": 6, "hr": 7}.get(own, 1 if own in BLOCKS else 0)


def simple_document(markup: str) -> dict | None:
    """What the reader has of markup whose tags have no attributes but the columns and rows that cells cover, none of them struck, inserted or
    skipped; None for any other. One loop without a stack, as there is nothing that an open tag would change."""
    cut = _SIMPLE.split(markup)
    out: list[str] = []
    size, tail = 0, ""  # tail: the last one or two characters
    pages, cells, opened = [0], [], []
    table, row, col, tables = -1, -1, -1, 0
    taken: dict[int, set[int]] = {}
    cell = None
    for k in range(0, len(cut), 4):
        data = cut[k]
        if data:
            if "<" in data:
                return None
            if "&" in data:
                data = unescape(data)
            words = " ".join(data.split())
            if not words:
                if data and tail[-1:] not in ("", " ", "\n"):
                    out.append(" ")
                    size += 1
                    tail = tail[-1:] + " "
            else:
                if data[:1].isspace() and tail[-1:] not in ("", " ", "\n"):
                    out.append(" ")
                    size += 1
                out.append(words)
                size += len(words)
                if data[-1:].isspace():
                    out.append(" ")
                    size += 1
                    tail = words[-1] + " "
                else:
                    tail = words[-2:]
        if k + 1 == len(cut):
            break
        if (words := cut[k + 1]) is not None and cell is None:
            words = " ".join(words.split())
            col += 1
            if col:
                out.append(" | ")
                size += 3
            here = taken.get(row)
            if here is None:
                here = taken[row] = set()
            place = 0
            while place in here:
                place += 1
            here.add(place)
            out.append(words)
            start, size, tail = size, size + len(words), words[-2:]
            cells.append({"table_id": f"T{table + 1:03d}", "row": row, "col": col, "start": start, "is_header": False, "colspan": 1, "rowspan": 1, "place": place, "text": words, "end": size})
            continue
        if words is not None:
            return None
        tag = cut[k + 2]
        try:
            does = _DOES[tag]
        except KeyError:
            if len(_DOES) < 10_000:
                does = _DOES[tag] = _does(tag)
            else:
                does = _does(tag)
        if does is None:
            return None
        if not does:
            continue
        if does >= 13 or does == 4 or does == 5 or does == 12 and opened:
            if cell is not None:
                at, first = cell["start"], cell.pop("first")
                if size > at:
                    own = ("".join(out[first:]) if first >= 0 else "".join(out)[at:]).strip()
                    if own:
                        cell["text"], cell["end"] = own, size
                        cells.append(cell)
                cell = None
            if does == 12 and opened:
                table, row, col, taken = opened.pop()
        if does in (1, 2, 3, 7, 11, 12, 13):
            while out and out[-1][-1] == " ":
                size -= 1
                if len(out[-1]) > 1:
                    out[-1] = out[-1][:-1]
                else:
                    out.pop()
                tail = ""
            if cell is not None and size < cell["start"]:
                cell["first"] = -1  # a blank before the cell is gone
            if not tail and out:
                tail = out[-1][-2:] if len(out[-1]) > 1 or len(out) < 2 else out[-2][-1] + out[-1]
            if size and tail != "\n\n":
                out.append("\n\n")
                size += 2
                tail = "\n\n"
        if does == 6:
            out.append("\n")
            size += 1
            tail = tail[-1:] + "\n"
        elif does == 7:
            pages.append(size)
        elif does == 2:
            opened.append((table, row, col, taken))
            taken = {}
            table, row, col = tables, -1, -1
            tables += 1
        elif does == 3:
            row, col = row + 1, -1
        elif does == 4 or does == 5:
            col += 1
            if col:
                out.append(" | ")
                size += 3
                tail = "| "
            wide = down = 1
            if cut[k + 3]:
                spans = dict(_COVERS.findall(cut[k + 3]))
                wide, down = (min(MOST_SPAN, max(1, int(spans.get(x, 1)))) for x in ("colspan", "rowspan"))
            place = 0
            here = taken.get(row)
            if here is None:
                here = taken[row] = set()
            while place in here:
                place += 1
            if wide == down == 1:
                here.add(place)
            else:
                for r in range(row, row + down):
                    taken.setdefault(r, set()).update(range(place, place + wide))
            cell = {"table_id": f"T{table + 1:03d}", "row": row, "col": col, "start": size, "is_header": does == 5, "colspan": wide, "rowspan": down, "place": place, "first": len(out)}
    if cell is not None and size > cell["start"]:
        first = cell.pop("first")
        own = ("".join(out[first:]) if first >= 0 else "".join(out)[cell["start"] :]).strip()
        if own:
            cells.append(cell | {"text": own, "end": size})
    return {"text": "".join(out).rstrip(), "pages": pages, "cells": cells, "redlines": [], "links": []}


def parse_html(markup: str) -> Reader:
    """Plain markup is cut by one pattern, all other by the tolerant parser; both tell the reader the same."""
    r = Reader()
    found = plain_tags(markup)
    if found is None:
        r.feed(markup)
        r.close()
    else:
        for closes, tag, attrs, once, text in found:
            if text is not None:
                r.handle_data(unescape(text) if "&" in text else text)
            elif closes:
                r.handle_endtag(tag)
            else:
                r.handle_starttag(tag, attrs)
                if once:
                    r.handle_endtag(tag)
    r.close_cell()
    return r


def mime_html(raw: bytes) -> str:
    """The longest HTML part of a MIME archive."""
    parts = [p.get_payload(decode=True) or b"" for p in email.message_from_bytes(raw, policy=email.policy.default).walk() if p.get_content_type() == "text/html"]
    return max(map(decoded, parts), key=len, default="")


def pdf_pages(raw: bytes) -> list[str]:
    try:
        from pypdf import PdfReader
    except ImportError as e:
        raise RuntimeError("reading PDF needs pypdf") from e
    return [p.extract_text() or "" for p in PdfReader(io.BytesIO(raw)).pages]


DOCUMENT = pa.schema([
    ("text", pa.string()), ("pages", pa.list_(pa.int64())),
    ("cells", pa.list_(pa.struct([("table_id", pa.string()), ("row", pa.int32()), ("col", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string()), ("is_header", pa.bool_()), ("colspan", pa.int32()), ("rowspan", pa.int32()), ("place", pa.int32())]))),
    ("redlines", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string())]))),
    ("links", pa.list_(pa.struct([("href", pa.string()), ("start", pa.int64())]))),
])
DOCUMENT_DDL = "text string, pages array<long>, cells array<struct<table_id:string,row:int,col:int,start:long,end:long,text:string,is_header:boolean,colspan:int,rowspan:int,place:int>>, redlines array<struct<kind:string,start:long,end:long,text:string>>, links array<struct<href:string,start:long>>"


def one_document(name: str, raw: bytes | str) -> dict:
    """Text, pages, cells, redlines and links of one file by its suffix."""
    low = name.lower()
    if not low.endswith(SUFFIXES):
        raise ValueError(f"can't read {name}")
    if low.endswith(".pdf"):
        pages = pdf_pages(raw if isinstance(raw, bytes) else raw.encode())
    elif low.endswith(".txt"):
        pages = (decoded(raw) if isinstance(raw, bytes) else raw).split("\f")
    else:
        markup = mime_html(raw if isinstance(raw, bytes) else raw.encode()) if low.endswith((".mht", ".mhtml")) else decoded(raw) if isinstance(raw, bytes) else raw
        if (simple := simple_document(markup)) is not None:
            return simple
        r = parse_html(markup)
        return {"text": "".join(r.out).rstrip(), "pages": r.pages, "cells": r.cells, "redlines": r.redlines, "links": r.links}
    starts, at = [], 0
    for p in pages:
        starts.append(at)
        at += len(p) + 1
    return {"text": "\n".join(pages), "pages": starts, "cells": [], "redlines": [], "links": []}


def _column(docs: list[dict], field: pa.Field) -> pa.Array:
    """A part of documents; lists of structs are put together by their columns."""
    if not (pa.types.is_list(field.type) and pa.types.is_struct(field.type.value_type)):
        return pa.array([d[field.name] for d in docs], field.type)
    ends, flat = [0], []
    for d in docs:
        flat += d[field.name]
        ends.append(len(flat))
    own = field.type.value_type
    whole = pa.StructArray.from_arrays([pa.array([x[f.name] for x in flat], f.type) for f in own], fields=list(own))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), whole, type=field.type)


def parsed(rows: DataFrame, key: str, content: str, name: str | None = None, parts: tuple[str, ...] | None = None) -> DataFrame:
    """key and the parts of each document (all, or those named); content is text or bytes, name a column of file names (HTML if none)."""
    fields = [f for f in DOCUMENT if parts is None or f.name in parts]

    def batch(keys: list, docs: list[dict], kind: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys, kind), *(_column(docs, f) for f in fields)], names=[key, *(f.name for f in fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, docs, chars = [], [], 0
            for k, n, c in zip(b.column(0), b.column(1), b.column(2), strict=True):
                raw = c.as_py()
                doc = one_document(n.as_py() or "x.html", raw if raw is not None else "")
                keys.append(k.as_py())
                docs.append({f.name: doc[f.name] for f in fields})
                chars += len(raw or "")
                if chars >= BATCH_CHARS:
                    yield batch(keys, docs, b.column(0).type)
                    keys, docs, chars = [], [], 0
            if docs:
                yield batch(keys, docs, b.column(0).type)

    kind = dict(rows.dtypes)[key]
    ddl = ", ".join(f"{f.name} {t}" for f, t in zip(DOCUMENT, re.split(r", (?=\w+ )", DOCUMENT_DDL), strict=True) for t in [t.split(" ", 1)[1]] if f in fields)
    return rows.select(key, (F.col(name) if name else F.lit("x.html")).alias("_name"), content).mapInArrow(run, f"{key} {kind}, {ddl}")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """All readable files under a path: document_id, path and the parts of each."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    ok = F.lower("path").rlike(r"(\.html?|\.xhtml|\.mhtml?|\.pdf|\.txt)$")
    rows = files.where(ok).select(F.struct(F.substring(F.sha2("content", 256), 1, 16).alias("document_id"), "path").alias("id"), "path", "content")
    return parsed(rows, "id", "content", "path").select("id.*", *DOCUMENT.names)


def headed(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Cells with is_header inferred: row 0 where a table has no header cell, no figure in row 0 and one in row 1."""
    figure = F.col("text").rlike(r"[0-9]")
    w = W.partitionBy(*keys, "table_id")
    any_header = F.max(F.col("is_header").cast("int")).over(w) == 1
    first = F.max(F.when((F.col("row") == 0) & figure, 1).otherwise(0)).over(w) == 0
    second = F.max(F.when((F.col("row") == 1) & figure, 1).otherwise(0)).over(w) == 1
    return cells.withColumn("is_header", F.col("is_header") | (~any_header & first & second & (F.col("row") == 0)))


def labelled_rows(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Body cells with the label of their column: the header cell above, or row 0 where there is none. Cells are kept: both sides read them."""
    h = headed(kept(cells), keys)
    heads = h.withColumn("_n", F.row_number().over(W.partitionBy(*keys, "table_id", "col").orderBy(F.desc("is_header"), "row"))).where("_n = 1").select(*keys, "table_id", "col", F.col("text").alias("label"), F.col("row").alias("head_row"))
    return h.where("not is_header").join(heads.hint("merge"), [*keys, "table_id", "col"]).where("row > head_row").drop("head_row")


def table_with(cells: DataFrame, keys: list[str], *groups: list[str]) -> DataFrame:
    """The first table of each document whose labels have a word of every group."""
    labels = headed(cells, keys).where("is_header or row = 0")
    low = F.lower("text")
    tests = [F.bool_or(low.rlike("|".join(g))).alias(f"g{i}") for i, g in enumerate(groups)]
    fits = labels.groupBy(*keys, "table_id").agg(*tests).where(" and ".join(f"g{i}" for i in range(len(groups))))
    return fits.groupBy(*keys).agg(F.min("table_id").alias("table_id"))


RECORDING = "document string, corpus_name string, model string, recorded_on date, recorded_before_labels boolean, note string, fields array<struct<field:string,value:string,quote:string,confidence:double,external_document:string,qualifiers:map<string,string>,notes:string>>, findings array<struct<kind:string,name:string,summary:string,quote:string,confidence:double,external_document:string>>"


def read_recordings(spark: SparkSession, path: str) -> DataFrame:
    """Recorded model readings, one JSON object a file."""
    return spark.read.schema(RECORDING).json(path, multiLine=True)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A CSV manifest with a header, all text."""
    return spark.read.csv(path, header=True)


def read_zip(spark: SparkSession, path: str) -> DataFrame:
    """(archive, name, content) of every member of the zip files under a path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with zipfile.ZipFile(io.BytesIO(c)) as z:
                    for n in z.namelist():
                        if not n.endswith("/"):
                            yield pa.RecordBatch.from_pydict({"archive": [p], "name": [n], "content": [z.read(n)]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "archive string, name string, content binary")


def resolved(names: DataFrame, known: DataFrame) -> DataFrame:
    """Each name with the known path that it means: equal, else the only one that ends with it, else null."""
    a = names.select("name").distinct()
    # a path ends with a name if their last parts are equal: that is the join key
    last = lambda c: F.element_at(F.split(c, "/"), -1)
    j = a.withColumn("k", last(F.col("name"))).join(known.select("path").distinct().withColumn("k", last(F.col("path"))), "k", "left")
    same, tail = F.col("path") == F.col("name"), F.endswith("path", F.concat(F.lit("/"), "name"))
    out = j.groupBy("name").agg(F.max(F.when(same, F.col("path"))).alias("exact"), F.min(F.when(tail, F.col("path"))).alias("one"), F.count_if(tail).alias("n"))
    return out.select("name", F.coalesce("exact", F.when(F.col("n") == 1, F.col("one"))).alias("path"))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def sidecar(docs: DataFrame) -> DataFrame:
    """What a document's offsets are, without its text, as JSON."""
    return docs.select("document_id", F.to_json(F.struct("pages", "cells", "redlines")).alias("offsets"))
