"""Amendment chains: what each document is, in which order they hold, and the text that is in force."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.functions.scalars import date

HEAD = 4_000
ORDINALS = ["first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth"]


def role(text: Column) -> tuple[Column, Column]:
    """Role and amendment number by the words of a document's head."""
    head = F.upper(F.left(text, F.lit(HEAD)))
    digits = F.regexp_extract(head, r"AMENDMENT (?:NO\.?|NUMBER) ?([0-9]{1,2})", 1).try_cast("int")
    number = digits
    for i, w in enumerate(ORDINALS):
        number = F.coalesce(number, F.when(head.rlike(rf"\b{w.upper()} AMENDMENT\b"), i + 1))
    facility = head.rlike(r"\b(?:CREDIT|LOAN|FACILITIES) (?:AND SECURITY )?AGREEMENT\b")
    kind = (
        F.when(number.isNotNull(), "amendment")
        .when(head.rlike(r"AMENDED AND RESTATED (?:CREDIT|LOAN|FACILITIES)"), "amendment_and_restatement")
        .when(head.rlike(r"^\s*AMENDMENT TO\b"), "amendment")
        .when(facility, "base")
        .when(head.rlike("INTERCREDITOR"), "intercreditor")
        .when(head.rlike(r"FEE LETTER"), "fee_letter")
        .when(head.rlike(r"SECURITY AGREEMENT|PLEDGE"), "security")
        .otherwise("other")
    )
    return kind, number


def effective_date(text: Column) -> Column:
    """The first `dated as of` within the head, else the defined effective date."""
    head = F.left(text, F.lit(4 * HEAD))
    first = F.regexp_extract(head, r"(?i)dated (?:as of )?([A-Z][a-z]+ [0-9]{1,2}, [0-9]{4})", 1)
    second = F.regexp_extract(head, r"(?i)effective date[^.]{0,80}?([A-Z][a-z]+ [0-9]{1,2}, [0-9]{4})", 1)
    return F.coalesce(date(first), date(second))


def ordered(chain: DataFrame, set_id: str = "set_id") -> DataFrame:
    """Documents with their place: the base first, then by date and number; by number alone where a date
    is missing and all amendments are numbered apart."""
    w = W.partitionBy(set_id)
    change = F.col("role") == "amendment"
    undated = F.max(F.col("effective_date").isNull().cast("int")).over(w) == 1
    n, numbered, distinct = F.sum(change.cast("int")).over(w), F.sum((change & F.col("amendment_number").isNotNull()).cast("int")).over(w), F.size(F.collect_set(F.when(change, F.col("amendment_number"))).over(w))
    by_number = undated & (numbered == n) & (distinct == n)
    first = F.when(F.col("role") == "base", 0).otherwise(1)
    day = F.when(by_number, F.lit(0)).otherwise(F.coalesce(F.datediff("effective_date", F.lit("1900-01-01")), F.lit(-1)))
    flagged = chain.withColumns({"_a": F.when(by_number, first).otherwise(0), "_d": day, "_k": F.coalesce("amendment_number", F.lit(0))})
    return flagged.withColumn("ord", F.row_number().over(w.orderBy("_a", "_d", "_k", "doc_id"))).drop("_a", "_d", "_k")


def operative(chain: DataFrame, as_of: Column | None = None, set_id: str = "set_id") -> DataFrame:
    """The documents that hold: from the last restatement on, and up to a date."""
    held = chain.where("role in ('base', 'amendment', 'amendment_and_restatement')")
    if as_of is not None:
        held = held.where(F.coalesce(F.col("effective_date") <= as_of, F.lit(True)))
    last = F.max(F.when(F.col("role") == "amendment_and_restatement", F.col("ord"))).over(W.partitionBy(set_id))
    return held.withColumn("_last", F.coalesce(last, F.lit(0))).where("ord >= _last").drop("_last")


_TARGET = r"[Ss]ection\s+(?P<section>[0-9]+\.[0-9]+)"
_EFFECTS = [
    ("restate", re.compile(_TARGET + r"[^\n]{0,120}?\b(?:amended and )?restated[^\n]{0,60}?as follows:\s*(?P<new>.+?)(?=\n\n[Ss]ection\s+[0-9]|\Z)", re.S)),
    ("replace", re.compile(_TARGET + r"[^\n]{0,160}?\b(?:deleting|replacing)\s+[\"“](?P<old>[^\"”]{1,200})[\"”][^\n]{0,80}?\b(?:inserting|with)\b[^\n\"“]{0,60}[\"“](?P<new>[^\"”]{0,400})[\"”]")),
    ("delete", re.compile(_TARGET + r"[^\n]{0,80}?\bis (?:hereby )?deleted in its entirety")),
    ("insert", re.compile(_TARGET + r"[^\n]{0,120}?\badding\b[^\n\"“]{0,60}[\"“](?P<new>[^\"”]{1,2000})[\"”]")),
]


def effects_of(text: str) -> list[dict]:
    """What an amendment changes, in order; of overlapping readings the earlier kind of the list stands."""
    taken: list[tuple[int, int]] = []
    out = []
    for kind, p in _EFFECTS:
        for m in p.finditer(text):
            if all(m.end() <= a or m.start() >= b for a, b in taken):
                taken.append(m.span())
                g = m.groupdict()
                out.append({"kind": kind, "section": g["section"], "old": g.get("old"), "new": (g.get("new") or "").strip() or None, "start": m.start(), "end": m.end()})
    return sorted(out, key=lambda e: e["start"])


EFFECTS = "set_id string, doc_id string, ord int, seq int, kind string, section string, old string, new string, start long, end long"


def effects(chain: DataFrame) -> DataFrame:
    """One row for each change that the amendments of (set_id, doc_id, ord, text) state."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [{"set_id": s, "doc_id": d, "ord": o, "seq": i} | e for s, d, o, t in zip(f.set_id, f.doc_id, f.ord, f.text, strict=True) for i, e in enumerate(effects_of(t or ""))]
            yield pd.DataFrame(rows, columns=["set_id", "doc_id", "ord", "seq", "kind", "section", "old", "new", "start", "end"])

    return chain.select("set_id", "doc_id", "ord", "text").mapInPandas(run, EFFECTS)


def fold(sections: DataFrame, changes: DataFrame) -> DataFrame:
    """Sections (set_id, section, body) after all changes in order: set_id, section, body, source (the document
    that wrote it last, null for the base) and unapplied, the reasons of changes that found no place.

    The changes of one section are applied one after the other, as one fold over an array of them."""
    a = sections.select("set_id", "section", F.struct(F.lit(-1).alias("ord"), F.lit(-1).alias("seq"), F.lit("base").alias("kind"), F.lit(None).cast("string").alias("old"), F.col("body").alias("new"), F.lit(None).cast("string").alias("doc_id")).alias("change"))
    b = changes.select("set_id", "section", F.struct("ord", "seq", "kind", "old", "new", "doc_id").alias("change"))
    first = F.struct(F.lit(None).cast("string").alias("body"), F.lit(None).cast("string").alias("source"), F.lit("").alias("unapplied"))

    def state(body: Column, source: Column, unapplied: Column) -> Column:
        return F.struct(body.alias("body"), source.alias("source"), unapplied.alias("unapplied"))

    def apply(s: Column, c: Column) -> Column:
        def fails(why: str) -> Column:
            told = F.concat(c["doc_id"], F.lit(f": {why}"))
            return state(s["body"], s["source"], F.when(s["unapplied"] == "", told).otherwise(F.concat(s["unapplied"], F.lit("; "), told)))

        at = F.call_function("locate", c["old"], s["body"])
        replaced = F.concat(F.left(s["body"], at - 1), F.coalesce(c["new"], F.lit("")), F.substr(s["body"], at + F.length(c["old"])))
        return (
            F.when(c["kind"] == "base", state(c["new"], s["source"], s["unapplied"]))
            .when(c["kind"] == "restate", state(c["new"], c["doc_id"], s["unapplied"]))
            .when(s["body"].isNull(), fails("no section"))
            .when((c["kind"] == "replace") & (F.coalesce(at, F.lit(0)) == 0), fails("text not found"))
            .when(c["kind"] == "replace", state(replaced, c["doc_id"], s["unapplied"]))
            .when(c["kind"] == "delete", state(F.lit(""), c["doc_id"], s["unapplied"]))
            .when(c["kind"] == "insert", state(F.trim(F.concat(s["body"], F.lit(" "), F.coalesce(c["new"], F.lit("")))), c["doc_id"], s["unapplied"]))
            .otherwise(s)
        )

    ordered = a.unionByName(b).groupBy("set_id", "section").agg(F.sort_array(F.collect_list("change")).alias("changes"))
    return ordered.select("set_id", "section", F.aggregate("changes", first, apply).alias("s")).select("set_id", "section", "s.*")


def findings(chain: DataFrame, changes: DataFrame, sections: DataFrame) -> DataFrame:
    """(set_id, kind, detail): no base, undated or twice numbered amendments, missing targets, conflicting restatements."""
    amendments = chain.where("role = 'amendment'")
    no_base = chain.groupBy("set_id").agg(F.count_if(F.col("role").isin("base", "amendment_and_restatement")).alias("n")).where("n = 0").select("set_id", F.lit("no_base").alias("kind"), F.lit("").alias("detail"))
    undated = amendments.where("effective_date is null").select("set_id", F.lit("undated").alias("kind"), F.col("doc_id").alias("detail"))
    twice = amendments.where("amendment_number is not null").groupBy("set_id", "amendment_number").agg(F.count("*").alias("n")).where("n > 1").select("set_id", F.lit("same_number").alias("kind"), F.col("amendment_number").cast("string").alias("detail"))
    parent = F.regexp_extract("section", r"^([0-9]+\.[0-9]+)", 1)
    missing = changes.where("kind <> 'restate'").withColumn("parent", parent).join(sections.select("set_id", F.col("section").alias("parent")).distinct(), ["set_id", "parent"], "left_anti").select("set_id", F.lit("target_missing").alias("kind"), F.col("section").alias("detail"))
    w = W.partitionBy("set_id", "section").orderBy("ord", "seq")
    dated = changes.where("kind = 'restate'").join(chain.select("set_id", "doc_id", "effective_date"), ["set_id", "doc_id"])
    clash = dated.withColumns({"_p": F.lag("new").over(w), "_d": F.lag("effective_date").over(w)}).where("_p is not null and _p <> new and (effective_date is null or _d is null or effective_date = _d)").select("set_id", F.lit("conflicting").alias("kind"), F.col("section").alias("detail"))
    return no_base.unionByName(undated).unionByName(twice).unionByName(missing).unionByName(clash)
