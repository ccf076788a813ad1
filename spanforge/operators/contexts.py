"""What a question is asked over: definitions with their uses, closures under a budget, the article that defines, grids in running text.

Uses are found by walking the words of a text through its terms, the longest term at a place first, so they need no pattern of all terms;
chunks are unions of intervals by document and term. A term's own definition is no use of it. Null texts hold nothing; of uses and
regions that tie the earlier counts; rows of one document id are one document and must not repeat; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.operators import graphs, outline
from spanforge.operators.extract import defined, named_in
from spanforge.operators.spans import merge, of_each

#: What stands around a use, how many uses are taken, gaps that are closed, characters of a closure, what stands between parts.
PAD, MOST_USES, GAP, BUDGET, BETWEEN = 600, 12, 200, 24_000, "\n[...]\n"

_WORD = re.compile(r"[A-Za-z0-9][A-Za-z0-9&'’/-]*")


def mentions(text: str, terms: list[str]) -> Iterator[tuple[str, int, int]]:
    """Every place of a term, none within another: from the left, the longest first. A term's words stand apart by white space only."""
    known: dict[str, list[list[str]]] = {}
    for t in terms:
        words = _WORD.findall(t)
        if words:
            known.setdefault(words[0], []).append([t, *words[1:]])
    for own in known.values():
        own.sort(key=len, reverse=True)
    found = list(_WORD.finditer(text))
    k = 0
    while k < len(found):
        hit = None
        for t, *rest in known.get(found[k][0], ()):
            if len(rest) < len(found) - k and all(found[k + 1 + i][0] == w for i, w in enumerate(rest)) and text[found[k].start() : found[k + len(rest)].end()].split() == t.split():
                hit = (t, found[k].start(), found[k + len(rest)].end())
                k += len(rest)
                break
        if hit:
            yield hit
        k += 1


def use_sites(docs: DataFrame, defs: DataFrame) -> DataFrame:
    """(doc_id, term, site, start, end) of each use of the terms of defs (doc_id, term, start, end) outside their definitions."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    own = defs.groupBy("doc_id").agg(F.collect_list(F.struct("term", "start", "end")).alias("ds"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for doc, text, ds in zip(f.doc_id, f.text, f.ds, strict=True):
                own_of = {d["term"]: (d["start"], d["end"]) for d in ds}
                n: dict[str, int] = {}
                for t, a, b in mentions(text or "", sorted(own_of)):
                    if not own_of[t][0] <= a < own_of[t][1]:
                        n[t] = n.get(t, 0) + 1
                        rows.append((doc, t, n[t], a, b))
            yield pd.DataFrame(rows, columns=["doc_id", "term", "site", "start", "end"])

    return docs.join(own, "doc_id").select("doc_id", "text", "ds").mapInPandas(run, f"doc_id {kind}, term string, site int, start long, end long")


def definitional(docs: DataFrame, defs: DataFrame, pad: int = PAD, most: int = MOST_USES, gap: int = GAP) -> DataFrame:
    """(doc_id, term, part, start, end): each definition with its first uses and what stands around them, as intervals a gap apart."""
    sites = use_sites(docs, defs).where(F.col("site") <= most)
    size = docs.select("doc_id", F.length("text").cast("long").alias("size"))
    around = sites.join(size, "doc_id").select("doc_id", "term", F.greatest(F.lit(0).cast("long"), F.col("start") - pad).alias("start"), F.least("size", F.col("end") + pad).alias("end"))
    spans = defs.select("doc_id", "term", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end")).unionByName(around)
    joined = merge(spans, ["doc_id", "term"], gap)
    return joined.select("doc_id", "term", F.row_number().over(W.partitionBy("doc_id", "term").orderBy("start")).alias("part"), "start", "end")


CLOSURE = "anchor string, ix int, term string, start long, end long"


def closed_in(own: list[tuple[str, int, int]], edges: Iterable[tuple[str, str]], budget: int, depth: int = graphs.DEPTH) -> Iterator[tuple[str, int, str, int, int]]:
    """CLOSURE of one document's definitions (term, start, end): level by level from each anchor, no further than the budget goes."""
    at = {t: (a, b) for t, a, b in own}
    out: dict[str, set[str]] = {}
    for src, dst in edges:
        out.setdefault(src, set()).add(dst)
    for anchor in at:
        seen, level, used, ix = {anchor}, [anchor], 0, 0
        for _ in range(depth + 1):
            for t in sorted(level):
                if t in at:
                    a, b = at[t]
                    used, ix = used + b - a, ix + 1
                    if used > budget:
                        break
                    yield anchor, ix, t, a, b
            level = [] if used > budget else list({y for t in level for y in out.get(t, ())} - seen)
            if not level:
                break
            seen.update(level)


def closures(defs: DataFrame, edges: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(doc_id, anchor, ix, term, start, end): the definitions that an anchor's rests on, nearest first and by name within a distance,
    up to the first that the budget of characters has no room for. edges: doc_id, src, dst. No way leaves its document, whose terms meet in a row."""
    kind = defs.schema["doc_id"].dataType.simpleString()
    own = defs.groupBy("doc_id").agg(F.collect_list(F.struct("term", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))).alias("ds"))
    j = own.join(edges.groupBy("doc_id").agg(F.collect_list(F.struct("src", "dst")).alias("es")).hint("merge"), "doc_id", "left")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(doc, *r) for doc, ds, es in zip(f.doc_id, f.ds, f.es, strict=True) for r in closed_in([(d["term"], d["start"], d["end"]) for d in ds], [(e["src"], e["dst"]) for e in (es if es is not None else ())], budget)]
            yield pd.DataFrame(rows, columns=["doc_id", "anchor", "ix", "term", "start", "end"])

    return j.select("doc_id", "ds", "es").mapInPandas(run, f"doc_id {kind}, {CLOSURE}")


def closures_of(docs: DataFrame, budget: int = BUDGET, most: int = 8_000) -> DataFrame:
    """closures of the definitions of each text and of their uses, found where the text is."""

    def read(t: str) -> Iterator[tuple[str, int, str, int, int]]:
        own = defined(t, most)
        return closed_in([(term, a, b) for term, a, b, _ in own], named_in([(term, body) for term, _, _, body in own]), budget)

    return of_each(docs.where("doc_id is not null"), ["doc_id"], "text", read, CLOSURE)


def texts(parts: DataFrame, docs: DataFrame, keys: list[str], order: str) -> DataFrame:
    """(keys, text): the parts of each chunk in order, with what stands between parts."""
    cut = parts.join(docs.select("doc_id", F.col("text").alias("whole")), "doc_id").select(*keys, order, F.expr("substring(whole, int(start) + 1, int(end - start))").alias("piece"))
    ordered = F.sort_array(F.collect_list(F.struct(order, "piece")))
    return cut.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x["piece"]), BETWEEN).alias("text"))


# -- the article that defines
DEFINES = r"[\"“]\s*[A-Z][^\"”\n]{0,90}?\s*[\"”]\s*(?:means|shall\s+mean|has\s+the\s+meaning|:)"


def definitions_region(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end): where a document's definitions stand.

    Of the sections that are named for definitions, and Article I, each up to the next article, the one that holds most definitions, the
    earliest of several; where none of them holds any, the article that holds most; else the first of those named, else the whole text."""
    from spanforge.operators.spans import matches

    heads = outline.headings(docs, ["doc_id"])
    size = docs.where("text is not null").select("doc_id", F.length("text").cast("long").alias("size"))
    later = W.partitionBy("doc_id").orderBy("start").rowsBetween(1, W.unboundedFollowing)
    stop = F.first(F.when(F.col("level") == "article", F.col("start")), ignorenulls=True).over(later)
    title = F.lower(F.trim("title"))
    named = title.contains("defined term") | (title == "definitions") | (F.upper("section") == "ARTICLE I")
    regions = heads.withColumn("stop", stop).join(size, "doc_id").select("doc_id", "start", F.coalesce("stop", "size").alias("end"), named.alias("named"), (F.col("level") == "article").alias("wide")).where("named or wide")
    marks = matches(docs, DEFINES, ["doc_id"]).select("doc_id", F.col("start").alias("at"))
    inside = regions.join(marks, "doc_id", "left").groupBy("doc_id", "start", "end", "named", "wide").agg(F.count_if((F.col("at") >= F.col("start")) & (F.col("at") < F.col("end"))).alias("n"))
    best = lambda of: F.max(F.when(of & (F.col("n") > 0), F.struct("n", (-F.col("start")).alias("from_"), "end")))
    picked = inside.groupBy("doc_id").agg(best(F.col("named")).alias("a"), best(F.col("wide")).alias("b"), F.min(F.when(F.col("named"), F.struct("start", "end"))).alias("c"))
    by_name = F.when(F.col("c").isNotNull(), F.col("b"))
    found = F.coalesce("a", by_name)
    region = F.coalesce(F.when(found.isNotNull(), F.struct((-found["from_"]).alias("start"), found["end"].alias("end"))), F.col("c"))
    out = size.join(picked.select("doc_id", region.alias("r")), "doc_id", "left")
    return out.select("doc_id", F.coalesce("r.start", F.lit(0).cast("long")).alias("start"), F.coalesce("r.end", "size").alias("end"))


# -- grids that lost their markup
_LEVEL = re.compile(r"(?:(?:Pricing\s+)?(?:Level|Tier|Category)\s+)?(?:[IVX]+|\d{1,2})\.?$")
_RATE = re.compile(r"(\d{1,2}(?:\.\d+)?)\s*%$")


def cut_by_gaps(lines: list[str], least: int = 2) -> list[list[str]]:
    """Cells of lines whose columns are apart by blanks in all of them, `least` wide."""
    width = max(map(len, lines))
    padded = [x.ljust(width) for x in lines]
    blank = [all(x[c] == " " for x in padded) for c in range(width)]
    cuts, c = [0], 0
    while c < width:
        if blank[c]:
            e = c
            while e < width and blank[e]:
                e += 1
            if e - c >= least and 0 < c and e < width:
                cuts.append(e)
            c = e
        c += 1
    return [[x[a:b].strip() for a, b in zip(cuts, [*cuts[1:], width], strict=True)] for x in padded]


def text_grid_rows(text: str | None) -> Iterator[tuple[int, int, str, str, int, str, Decimal]]:
    """start, end, level, band, column, label and rate of the rows of grids that blanks alone set out.

    A grid is a block of lines without an empty one between; its columns are the stretches that are blank in all of its rows of levels,
    its labels what the lines above have there. The columns before the first rate are the band. A block whose columns can't be told
    apart, or a row whose band has a rate in it, is left out."""
    at = 0
    for block in re.split(r"(\n[ \t]*\n+)", text or ""):
        lines, starts = [], []
        for line in block.expandtabs(8).split("\n") if "\t" not in block else [x.replace("\t", "  ") for x in block.split("\n")]:
            lines.append(line)
        place = at
        for raw in block.split("\n"):
            starts.append((place, place + len(raw)))
            place += len(raw) + 1
        at += len(block)
        rows = [k for k, line in enumerate(lines) if "%" in line and _LEVEL.match(re.split(r"\s{2,}", line.strip())[0] if re.search(r"\S\s{2,}\S", line) else line.strip().split(" ")[0] if line.strip() else "")]
        if not rows:
            continue
        shift = min(len(lines[k]) - len(lines[k].lstrip()) for k in rows)
        cells = cut_by_gaps([lines[k][shift:] for k in rows])
        heads = [lines[k][shift:] for k in range(rows[0]) if lines[k].strip()]
        wide = cut_by_gaps([*[lines[k][shift:] for k in rows], *heads]) if heads else []
        labels = [" ".join(" ".join(h[c] for h in wide[len(rows) :]).split()) for c in range(len(wide[0]))] if wide and len(wide[0]) == len(cells[0]) else None
        for k, row in zip(rows, cells, strict=True):
            if len(row) < 2 or not _LEVEL.match(row[0]):
                continue
            first = next((c for c in range(1, len(row)) if _RATE.match(row[c])), None)
            if first is None or any("%" in x for x in row[1:first]) or not all(_RATE.match(x) for x in row[first:]):
                continue
            for c in range(first, len(row)):
                yield (*starts[k], row[0], " ".join(row[1:first]), c, labels[c] if labels else "", Decimal(_RATE.match(row[c])[1]))


GRID = "start long, end long, level string, band string, col int, label string, rate decimal(12,4)"


def text_grids(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, start, end, level, band, col, label, rate) of pricing grids in running text."""
    return outline._each(docs, keys, text, text_grid_rows, GRID)
