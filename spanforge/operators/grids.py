"""Tables by their topology: which columns a header covers, which column has which role, which tables go on after a page, which totals hold.

Cells (keys, table_id, row, place, colspan, rowspan, text, start, end, is_header) as the HTML reader gives them. All steps are joins and
aggregations by document and table, so a document of many tables is many groups.

Null texts are no cells; a table without figures has headers alone and no rows; of two columns that fit a role the left one has it, and
no column has two roles; tables that start at one place come in the order of their ids; an empty table gives no rows.
"""

from __future__ import annotations

import re
from calendar import monthrange
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.functions import scalars as S
from spanforge.session import kept
from spanforge.sources import files

#: How far the next part of a table may be, and by how much a total may miss the sum of its rows.
NEXT_PART, TOTAL_SLACK = 400, 1
#: What a body cell looks like: an amount, a rate, a ratio; dates are read.
FIGURE = r"^[\(\s]*[$€£]?[\(\s]*[0-9][0-9,]*(?:\.[0-9]+)?[\)\s]*(?:%|x|bps|basis points|(?:to|:)\s*1(?:\.0+)?)?[\)\s]*$"


class Role(NamedTuple):
    """A column's role: its label has one of these words and none of those."""

    name: str
    words: tuple[str, ...]
    but: tuple[str, ...] = ()
    needed: bool = True


#: The words by which tables are known.
AMORTIZATION = (Role("day", ("payment date", "installment date", "date")), Role("amount", ("amortization", "principal", "amount", "installment"), ("date",)))
EBITDA = (Role("label", ("fiscal quarter", "quarter", "period")), Role("amount", ("ebitda",)))
COVENANT = (Role("label", ("test period", "period", "fiscal quarter")), Role("level", ("ratio", "leverage", "covenant")))
COMMITMENTS = (Role("name", ("facility", "lender", "bank", "tranche")), Role("amount", ("commitment",), ("percentage", "share", "%")), Role("maturity", ("maturity",), needed=False))


def spread(cells: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each place that a cell covers: its row and col, and the cell's own row as head."""
    down = F.sequence(F.lit(0), F.greatest(F.coalesce("rowspan", F.lit(1)), F.lit(1)) - 1)
    wide = F.sequence(F.col("place"), F.col("place") + F.greatest(F.coalesce("colspan", F.lit(1)), F.lit(1)) - 1)
    own = cells.where("text is not null").select(*keys, "table_id", F.col("row").alias("head"), "text", "start", "end", "is_header", F.explode(down).alias("down"), wide.alias("wide"))
    return own.select(*keys, "table_id", "head", (F.col("head") + F.col("down")).alias("row"), F.explode("wide").alias("col"), "text", "start", "end", "is_header")


def is_figure(text: Column) -> Column:
    return F.coalesce(text.rlike(FIGURE), F.lit(False)) | S.date(text).isNotNull()


def joined(cells: DataFrame, keys: list[str], reach: int = NEXT_PART) -> DataFrame:
    """Places with body, whether they lie below the headers; a table without headers that follows close on one with as many columns
    goes on with it, under its id and after its last row."""
    g = spread(cells, keys)
    by = [*keys, "table_id"]
    below = F.min(F.when(is_figure(F.col("text")) & ~F.coalesce("is_header", F.lit(False)), F.col("head")))
    tables = g.groupBy(*by).agg(below.alias("first"), (F.max("row") + 1).alias("rows"), (F.max("col") + 1).alias("cols"), F.min("start").alias("from_"), F.max("end").alias("to_"))
    w = W.partitionBy(*keys).orderBy("from_", "table_id")
    before = {c: F.lag(c).over(w) for c in ("cols", "to_")}
    goes_on = (F.coalesce("first", F.lit(1)) == 0) & (before["cols"] == F.col("cols")) & (F.col("from_") - before["to_"] <= reach)
    runs = tables.withColumn("fresh", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)).withColumn("run", F.sum("fresh").over(w))
    own = W.partitionBy(*keys, "run").orderBy("from_", "table_id")
    placed = runs.withColumns({"whole": F.first("table_id").over(own), "shift": F.coalesce(F.sum("rows").over(own.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))})
    out = g.join(placed.select(*by, "first", "fresh", "whole", "shift").hint("merge"), by)
    body = F.when(F.col("fresh") == 1, F.coalesce(F.col("row") >= F.col("first"), F.lit(False))).otherwise(F.lit(True))
    return out.select(*keys, F.col("whole").alias("table_id"), (F.col("row") + F.col("shift")).alias("row"), "col", "text", "start", "end", body.alias("body"))


def columns(grid: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, table_id, unit, cols, label): columns under one lowest header cell, and all headers above them from the top, in lower case."""
    heads = grid.where("not body").groupBy(*keys, "table_id", "col").agg(F.sort_array(F.collect_set(F.struct("start", "text"))).alias("hs"))
    named = heads.select(*keys, "table_id", "col", F.element_at("hs", -1)["start"].alias("unit"), F.lower(F.array_join(F.transform("hs", lambda h: h["text"]), " ")).alias("label"))
    return named.groupBy(*keys, "table_id", "unit").agg(F.sort_array(F.collect_set("col")).alias("cols"), F.min_by("label", "col").alias("label"))


def assigned(units: DataFrame, keys: list[str], roles: tuple[Role, ...]) -> DataFrame:
    """(keys, table_id, role, cols) of the tables that have a column for every needed role."""
    def fits(r: Role) -> Column:
        some = F.exists(F.array(*map(F.lit, r.words)), lambda x: F.col("label").contains(x))
        return some & ~F.exists(F.array(*map(F.lit, r.but)), lambda x: F.col("label").contains(x)) if r.but else some

    per_table = units.groupBy(*keys, "table_id").agg(*(F.sort_array(F.collect_list(F.when(fits(r), F.struct("cols", "unit")))).alias(f"m{i}") for i, r in enumerate(roles)))
    chosen = []
    for i, r in enumerate(roles):
        free = F.array_except(f"m{i}", F.array_compact(F.array(*(F.col(f"c{k}") for k in range(i))))) if i else F.col(f"m{i}")
        per_table = per_table.withColumn(f"c{i}", F.try_element_at(free, F.lit(1)))
        chosen.append(F.struct(F.lit(r.name).alias("role"), F.col(f"c{i}.cols").alias("cols")))
        if r.needed:
            per_table = per_table.where(f"c{i} is not null")
    return per_table.select(*keys, "table_id", F.explode(F.array(*chosen)).alias("c")).where("c.cols is not null").select(*keys, "table_id", F.col("c.role").alias("role"), F.explode("c.cols").alias("col"))


def read_rows(cells: DataFrame, keys: list[str], roles: tuple[Role, ...]) -> DataFrame:
    """(keys, table_id, row, a text for each role, start, end) of the body rows of fitting tables; what stands in cells of its own under
    one header, such as a currency sign, is joined to the figure. Cells are read four times, so they are kept, not parsed again each time."""
    grid = joined(kept(cells), keys)
    cast = grid.where("not body").withColumn("col", F.col("col").cast("int"))
    role_of = assigned(columns(cast, keys), keys, roles)
    own = grid.where("body").withColumn("col", F.col("col").cast("int")).join(role_of.hint("merge"), [*keys, "table_id", "col"])
    per_role = own.groupBy(*keys, "table_id", "row", "role").agg(F.sort_array(F.collect_set(F.struct("start", "text"))).alias("ts"), F.min("start").alias("start"), F.max("end").alias("end"))
    text = F.array_join(F.transform("ts", lambda t: t["text"]), "")
    wide = [F.max(F.when(F.col("role") == r.name, text)).alias(r.name) for r in roles]
    return per_role.groupBy(*keys, "table_id", "row").agg(*wide, F.min("start").alias("start"), F.max("end").alias("end"))


# -- the same, a page at a time, where the page is parsed
_FIGURE, _LONG = re.compile(FIGURE, re.A), re.compile(rf"({'|'.join(S.MONTHS)}) ([0-9]{{1,2}}), ([0-9]{{4}})")
_SLASH, _ISO = re.compile(r"\b([0-9]{1,2})/([0-9]{1,2})/([0-9]{4}|[0-9]{2})\b"), re.compile(r"\b([0-9]{4})-([0-9]{2})-([0-9]{2})\b")


def _is_day(text: str) -> bool:
    """Whether scalars.date reads a day."""
    if m := _LONG.search(text):
        y, mo, d = int(m[3]), S.MONTHS.index(m[1]) + 1, int(m[2])
    elif m := _SLASH.search(text):
        y, mo, d = int(m[3]), int(m[1]), int(m[2])
    elif m := _ISO.search(text):
        y, mo, d = map(int, m.groups())
    else:
        return False
    return 1 <= mo <= 12 and 1 <= d <= monthrange(y or 2000, mo)[1]


#: Short texts that were looked at before in this worker, as headers repeat from page to page.
_KNOWN: dict[str, bool] = {}


def _is_figure(text: str) -> bool:
    if (known := _KNOWN.get(text)) is None:
        known = _FIGURE.match(text) is not None or _is_day(text)
        if len(_KNOWN) < 10_000 and len(text) < 100:
            _KNOWN[text] = known
    return known


def rows_of(cells: list[dict], roles: tuple[Role, ...], reach: int = NEXT_PART) -> list[tuple]:
    """(table_id, row, a text for each role, start, end) of the cells of one page: what read_rows gives, without a shuffle."""
    tables: dict[str, list[dict]] = {}
    for c in cells:
        if c["text"] is not None:
            tables.setdefault(c["table_id"], []).append(c)
    bounds = []
    for t, own in tables.items():
        first, rows, cols, start, end = None, 0, 0, own[0]["start"], own[0]["end"]
        for c in own:
            row = c["row"]
            if (first is None or row < first) and not c["is_header"] and _is_figure(c["text"]):
                first = row
            if (n := row + max(c["rowspan"] or 1, 1)) > rows:
                rows = n
            if (n := c["place"] + max(c["colspan"] or 1, 1)) > cols:
                cols = n
            if c["start"] < start:
                start = c["start"]
            if c["end"] > end:
                end = c["end"]
        bounds.append((start, t, end, first, rows, cols))
    out: list[tuple] = []
    before, role_of, whole, shift = None, {}, "", 0
    for start, t, end, first, rows, cols in sorted(bounds, key=lambda b: b[:2]):
        fresh = not (before and first == 0 and before[1] == cols and start - before[0] <= reach)
        before = end, cols
        if fresh:
            whole, shift = t, 0
            role_of = _roles([c for c in tables[t] if first is None or c["row"] < first], roles)
        if role_of:
            read: dict[int, list] = {}  # of a row: start, end, the places and texts of each role
            for c in tables[t]:
                place, wide = c["place"], c["colspan"] or 1
                of = {role for col in range(place, place + wide) if (role := role_of.get(col)) is not None} if wide > 1 else () if (role := role_of.get(place)) is None else (role,)
                for row in range(c["row"], c["row"] + max(c["rowspan"] or 1, 1)) if of else ():
                    if fresh and (first is None or row < first):
                        continue
                    if (got := read.get(row)) is None:
                        got = read[row] = [c["start"], c["end"], *(None for _ in roles)]
                    got[0], got[1] = min(got[0], c["start"]), max(got[1], c["end"])
                    for role in of:
                        if got[role + 2] is None:
                            got[role + 2] = {(c["start"], c["text"])}
                        else:
                            got[role + 2].add((c["start"], c["text"]))
            for row, (a, b, *texts) in read.items():
                out.append((whole, row + shift, *(None if x is None else "".join(y for _, y in sorted(x)) for x in texts), a, b))
        shift += rows
    return out


def _roles(heads: list[dict], roles: tuple[Role, ...]) -> dict[int, int]:
    """Role by column of a table with these cells above its figures; none if a needed role has no column."""
    over: dict[int, set[tuple[int, str]]] = {}
    for c in heads:
        for col in range(c["place"], c["place"] + max(c["colspan"] or 1, 1)):
            over.setdefault(col, set()).add((c["start"], c["text"]))
    units: dict[int, tuple[list[int], str]] = {}
    for col in sorted(over):
        hs = sorted(over[col])
        units.setdefault(hs[-1][0], ([], " ".join(x for _, x in hs).lower()))[0].append(col)
    chosen: list[int] = []
    found: dict[int, int] = {}
    for i, r in enumerate(roles):
        fits = min(((cols, unit) for unit, (cols, label) in units.items() if unit not in chosen and any(w in label for w in r.words) and not any(w in label for w in r.but)), default=None)
        if fits:
            chosen.append(fits[1])
            found |= dict.fromkeys(fits[0], i)
        elif r.needed:
            return {}
    return found


def page_rows(pages: DataFrame, key: str, content: str, roles: tuple[Role, ...]) -> DataFrame:
    """read_rows of pages a row each, of HTML or of the cells that files.parsed has read from it: rows are read in one pass where the page is, so no cell is written or shuffled."""
    parse = (lambda x: files.one_document("x.html", x)["cells"]) if dict(pages.dtypes)[content] == "string" else list
    names = ["table_id", "row", *(r.name for r in roles), "start", "end"]
    types = [pa.string(), pa.int64(), *(pa.string() for _ in roles), pa.int64(), pa.int64()]

    def batch(keys: list, rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(keys, kind), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=[key, *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, rows = [], []
            for k, c in zip(b.column(0), b.column(1), strict=True):
                own = rows_of(parse(c.as_py() or ""), roles)
                keys += [k.as_py()] * len(own)
                rows += own
                if len(rows) >= BATCH_ROWS:
                    yield batch(keys, rows, b.column(0).type)
                    keys, rows = [], []
            yield batch(keys, rows, b.column(0).type)

    texts = ", ".join(f"{r.name} string" for r in roles)
    return pages.select(key, content).mapInArrow(run, f"{key} {dict(pages.dtypes)[key]}, table_id string, row bigint, {texts}, start bigint, end bigint")


def _day(c: str) -> Column:
    """scalars.date, with one pattern where the text is nothing but a day."""
    return F.when(F.col(c).rlike(rf"^(?:{'|'.join(S.MONTHS)}) [0-9]{{1,2}}, [0-9]{{4}}\z"), F.try_to_date(c, "MMMM d, yyyy")).otherwise(S.date(F.col(c)))


def _amount(c: str) -> Column:
    """scalars.money, with one pattern where the text is nothing but an amount."""
    return F.when(F.col(c).rlike(r"^\$? ?[0-9][0-9,]*(?:\.[0-9]+)?\z"), S.decimal(F.translate(c, "$ ", ""))).otherwise(S.money(F.col(c)))


#: Rows that page_rows hands on at a time.
BATCH_ROWS = 20_000


def amortization(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Payments as they are printed, rows that repeat among them: (keys, table_id, row, payment_date, amount, start, end)."""
    return payments(read_rows(cells, keys, AMORTIZATION), keys)


def payments(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of amortization tables, read by read_rows or page_rows, as amortization gives them."""
    return rows.select(*keys, "table_id", "row", _day("day").alias("payment_date"), _amount("amount").alias("amount"), "start", "end").where("payment_date is not null and amount is not null")


def ebitda(cells: DataFrame, keys: list[str]) -> DataFrame:
    rows = read_rows(cells, keys, EBITDA)
    return rows.select(*keys, "table_id", "row", "label", S.money(F.col("amount")).alias("amount"), "start", "end").where("label is not null and amount is not null")


def covenants(cells: DataFrame, keys: list[str]) -> DataFrame:
    rows = read_rows(cells, keys, COVENANT)
    return rows.select(*keys, "table_id", "row", "label", S.ratio(F.col("level")).alias("level"), "start", "end").where("label is not null and level is not null")


def commitments(cells: DataFrame, keys: list[str], scales: DataFrame | None = None) -> DataFrame:
    """(keys, table_id, row, name, amount, maturity, is_total, holds): amounts by the table's scale (keys, table_id, scale: a number);
    a total holds if the rows above it, since the last total, add up to it."""
    return committed(read_rows(cells, keys, COMMITMENTS), keys, scales)


def committed(rows: DataFrame, keys: list[str], scales: DataFrame | None = None) -> DataFrame:
    """The rows of commitment tables, read by read_rows or page_rows, as commitments gives them."""
    if scales is not None:
        rows = rows.join(scales.select(*keys, "table_id", "scale"), [*keys, "table_id"], "left")
    by = F.coalesce(F.col("scale"), F.lit(1)) if scales is not None else F.lit(1)
    read = rows.select(*keys, "table_id", "row", "name", (_amount("amount") * by).cast("decimal(30,2)").alias("amount"), S.date(F.col("maturity")).alias("maturity"), "start", "end").where("amount is not null")
    total = F.lower(F.ltrim(F.coalesce("name", F.lit("")))).startswith("total")
    w = W.partitionBy(*keys, "table_id").orderBy("row")
    part = read.withColumn("is_total", total).withColumn("part", F.coalesce(F.sum(F.col("is_total").cast("int")).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    above = F.sum(F.when(~F.col("is_total"), F.col("amount"))).over(W.partitionBy(*keys, "table_id", "part"))
    return part.withColumn("holds", F.when(F.col("is_total"), F.coalesce(F.abs(above - F.col("amount")) <= TOTAL_SLACK, F.lit(False)))).drop("part")


def scheduled_total(cells: DataFrame, keys: list[str], scales: DataFrame | None = None) -> DataFrame:
    """(keys, amount): the total of a document's commitment schedules, where it holds and all that hold are one figure."""
    return held_total(commitments(cells, keys, scales), keys)


def held_total(committed: DataFrame, keys: list[str]) -> DataFrame:
    held = committed.where("holds").groupBy(*keys).agg(F.count_distinct("amount").alias("n"), F.max("amount").alias("amount"))
    return held.where("n = 1").select(*keys, "amount")
