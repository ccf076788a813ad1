"""License scans by ordered signatures.

Text is brought to lower-case words joined by single spaces. A signature is a regular expression
over that with a label, a priority and a score; it runs only if the text holds a word of each of its
keyword sets, without which it cannot match, and texts without any keyword are passed over at once. Of overlapping detections, one that
lies inside the interval of another is suppressed if the other has a higher priority, or the same
and a longer interval, or both are equal and the other comes first in the order of signatures.

Cases: a null text is an empty one; texts without keywords get no labels and score 0; very long
texts are scanned whole; an interval repeated by several signatures keeps the best; repeated rows
each get a row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.llm.common import alnum_words

#: Phrases that count by contract, fixed values.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Families: label, how the name is written, versions, words of the SPDX identifier, words of which any name has one.
FAMILIES = [
    ("mit", r"(?:expat )?mit(?: x11)?", [], "mit", "mit"),
    ("apache", r"apache(?: software)?", ["1 0", "1 1", "2 0"], "apache", "apache"),
    ("gpl", r"(?:gnu )?general public|(?:gnu )?gpl", ["1", "2", "3"], "gpl", "general gpl"),
    ("lgpl", r"(?:gnu )?(?:lesser|library) general public|(?:gnu )?lgpl", ["2", "2 1", "3"], "lgpl", "lesser library lgpl"),
    ("agpl", r"(?:gnu )?affero general public|(?:gnu )?agpl", ["1", "3"], "agpl", "affero agpl"),
    ("gfdl", r"(?:gnu )?free documentation|gfdl", ["1 1", "1 2", "1 3"], "gfdl", "documentation gfdl"),
    ("bsd-2", r"(?:simplified|freebsd|2 clause|two clause) bsd|bsd 2 clause", [], "bsd 2 clause", "bsd"),
    ("bsd-3", r"(?:new|modified|revised|3 clause|three clause) bsd|bsd 3 clause", [], "bsd 3 clause", "bsd"),
    ("bsd-4", r"(?:original|old|4 clause|four clause) bsd|bsd 4 clause", [], "bsd 4 clause", "bsd"),
    ("bsd", r"bsd(?: style)?", [], "0bsd", "bsd"),
    ("isc", r"isc", [], "isc", "isc"),
    ("mpl", r"mozilla public|mpl", ["1 0", "1 1", "2 0"], "mpl", "mozilla mpl"),
    ("epl", r"eclipse public|epl", ["1 0", "2 0"], "epl", "eclipse epl"),
    ("cddl", r"common development and distribution|cddl", ["1 0", "1 1"], "cddl", "distribution cddl"),
    ("cpl", r"common public", ["1 0"], "cpl", "common"),
    ("eupl", r"european union public|eupl", ["1 0", "1 1", "1 2"], "eupl", "european eupl"),
    ("artistic", r"(?:perl )?artistic", ["1 0", "2 0"], "artistic", "artistic"),
    ("zlib", r"zlib(?: libpng)?", [], "zlib", "zlib"),
    ("boost", r"boost software", ["1 0"], "bsl", "boost"),
    ("unlicense", r"unlicense", [], "unlicense", "unlicense"),
    ("wtfpl", r"do what the f\w* you want to public|wtfpl", ["2"], "wtfpl", "want wtfpl"),
    ("psf", r"python software foundation|psf", ["2"], "psf", "python psf"),
    ("ofl", r"(?:sil )?open font|ofl", ["1 0", "1 1"], "ofl", "font ofl"),
    ("osl", r"open software", ["1 0", "2 0", "3 0"], "osl", "software"),
    ("afl", r"academic free", ["1 2", "2 0", "3 0"], "afl", "academic"),
    ("ms-pl", r"microsoft public", [], "ms pl", "microsoft"),
    ("ms-rl", r"microsoft reciprocal", [], "ms rl", "reciprocal"),
    ("cc-by-nc-nd", r"(?:creative commons|cc) (?:attribution non ?commercial no ?deriv(?:ative)?s|by nc nd)", ["2 0", "2 5", "3 0", "4 0"], "cc by nc nd", "creative cc"),
    ("cc-by-nc-sa", r"(?:creative commons|cc) (?:attribution non ?commercial share ?alike|by nc sa)", ["2 0", "2 5", "3 0", "4 0"], "cc by nc sa", "creative cc"),
    ("cc-by-nc", r"(?:creative commons|cc) (?:attribution non ?commercial|by nc)", ["2 0", "2 5", "3 0", "4 0"], "cc by nc", "creative cc"),
    ("cc-by-nd", r"(?:creative commons|cc) (?:attribution no ?deriv(?:ative)?s|by nd)", ["2 0", "2 5", "3 0", "4 0"], "cc by nd", "creative cc"),
    ("cc-by-sa", r"(?:creative commons|cc) (?:attribution share ?alike|by sa)", ["2 0", "2 5", "3 0", "4 0"], "cc by sa", "creative cc"),
    ("cc-by", r"(?:creative commons|cc) (?:attribution|by)", ["2 0", "2 5", "3 0", "4 0"], "cc by", "creative cc"),
    ("cc0", r"(?:creative commons|cc) (?:zero|0)|cc0", ["1 0"], "cc0", "creative cc cc0"),
    ("odbl", r"open (?:data commons open )?database", ["1 0"], "odbl", "database"),
]

#: Sentences of the license texts themselves: label, expression, keyword.
TEXTS = [
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby"),
    ("isc", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted", "hereby"),
    ("apache", r"you may not use this file except in compliance with the license", "compliance"),
    ("gpl", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "redistribute"),
    ("lgpl", r"this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "redistribute"),
    ("bsd", r"redistributions? (?:and use )?in source and binary forms? with or without modification are permitted", "redistribution"),
    ("bsd-3", r"neither the name of .{1,80}? nor the names of its contributors may be used to endorse", "endorse"),
    ("mpl", r"this source code form is subject to the terms of the mozilla public license", "mozilla"),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", "warranty"),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered"),
    ("public-domain", r"(?:released|placed|dedicated|is) (?:in)?to the public domain|is in the public domain", "domain"),
    ("proprietary", r"all rights reserved", "reserved"),
    ("proprietary", r"proprietary and confidential", "proprietary"),
    ("proprietary", r"unauthori[sz]ed copying of this (?:file|software|document)", "copying"),
]

#: Names and notices as people write them: label, expression, priority, keywords (a word of each is in every match).
WRITTEN = [
    ("bsd-2", r"(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd license)", 65, ["bsd freebsd"]),
    ("bsd-3", r"(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)", 65, ["bsd"]),
    ("bsd-4", r"(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)", 65, ["bsd"]),
    ("bsd-3-clear", r"(?:bsd 3 clause clear|clear bsd)", 66, ["bsd"]),
    ("0bsd", r"(?:0bsd|zero clause bsd)", 66, ["0bsd bsd"]),
    ("mit", r"mit licen[sc]ed", 60, ["mit"]),
    ("mit", r"(?:code|project|software|library|package|repo|repository|it|this|we) (?:uses?|is|are) (?:the )?mit", 45, ["mit", "code project software library package repo repository it this we"]),
    ("mit", r"licen[sc]e mit", 58, ["license licence"]),
    ("mit-0", r"mit (?:0|no attribution)", 67, ["mit"]),
    ("apache", r"(?:asl|alv?) ?2(?: 0)?", 62, ["asl asl2 al2 alv2 al alv"]),
    ("apache", r"licen[sc]ed to the apache software foundation(?: asf)?", 92, ["apache"]),
    ("apache", r"apache org licen[sc]es license 2 0", 95, ["apache"]),
    ("apache", r"apache 2(?: 0)?", 62, ["apache"]),
    ("gpl", r"gnu general public licen[sc]e", 64, ["gnu"]),
    ("gpl", r"you should have received a copy of the gnu general public licen[sc]e", 97, ["received"]),
    ("lgpl", r"you should have received a copy of the gnu (?:lesser|library) general public licen[sc]e", 98, ["received"]),
    ("agpl", r"you should have received a copy of the gnu affero general public licen[sc]e", 98, ["received"]),
    ("gpl", r"gpl ?v?[123](?: only| or later| or any later version)?", 66, ["gpl gpl1 gpl2 gpl3 gplv1 gplv2 gplv3"]),
    ("lgpl", r"lgpl ?v?(?:2 1|2|3)(?: only| or later| or any later version)?", 67, ["lgpl lgpl2 lgpl3 lgplv2 lgplv3"]),
    ("agpl", r"agpl ?v?[13](?: only| or later| or any later version)?", 67, ["agpl agpl1 agpl3 agplv1 agplv3"]),
    ("gpl-classpath", r"(?:gpl|general public licen[sc]e) (?:version 2 )?with (?:the )?classpath exception", 93, ["classpath"]),
    ("gpl-linking", r"linking this (?:library|program) statically or dynamically with other modules", 93, ["statically"]),
    ("mpl", r"mpl ?v?(?:1 1|2 0|2)", 66, ["mpl mpl1 mpl2 mplv1 mplv2"]),
    ("mpl", r"obtain one at (?:https? )?mozilla org mpl 2 0", 96, ["mozilla"]),
    ("mpl", r"the contents of this file are subject to the mozilla public licen[sc]e", 97, ["mozilla"]),
    ("epl", r"this program and the accompanying materials are made available under the terms of the eclipse", 97, ["accompanying"]),
    ("epl", r"eclipse org legal epl v(?:10|20|1 0|2 0)", 95, ["eclipse"]),
    ("cddl", r"the contents of this file are subject to the terms of the common development and distribution", 97, ["distribution"]),
    ("boost", r"boost org license 1 0", 95, ["boost"]),
    ("boost", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software", 100, ["organization"]),
    ("artistic", r"(?:same terms as perl itself|terms of the artistic licen[sc]e)", 88, ["perl artistic"]),
    ("perl", r"redistribute it and or modify it under the same terms as perl", 92, ["perl"]),
    ("zlib", r"altered source versions must be plainly marked as such", 96, ["altered"]),
    ("isc", r"isc licen[sc]ed", 60, ["isc"]),
    ("curl", r"curl (?:license|copyright)", 60, ["curl"]),
    ("openssl", r"(?:openssl|ssleay) licen[sc]e", 62, ["openssl ssleay"]),
    ("openssl", r"this product includes software developed by the openssl project", 96, ["openssl"]),
    ("php", r"php licen[sc]e(?: version)?(?: 3 01?)?", 62, ["php"]),
    ("ruby", r"ruby licen[sc]e", 62, ["ruby"]),
    ("postgresql", r"postgresql licen[sc]e", 62, ["postgresql"]),
    ("ncsa", r"(?:university of illinois ncsa open source|ncsa open source|uiuc) licen[sc]e", 66, ["ncsa uiuc"]),
    ("w3c", r"w3c (?:software notice and )?licen[sc]e", 66, ["w3c"]),
    ("unicode", r"unicode (?:license agreement|inc license|terms of use)", 62, ["unicode"]),
    ("icu", r"icu licen[sc]e", 62, ["icu"]),
    ("libpng", r"(?:lib)?png (?:reference library )?licen[sc]e", 62, ["libpng png"]),
    ("libtiff", r"libtiff licen[sc]e", 62, ["libtiff"]),
    ("ijg", r"independent jpeg group", 62, ["jpeg"]),
    ("freetype", r"(?:freetype (?:project )?licen[sc]e|freetype team)", 62, ["freetype"]),
    ("x11", r"x11 licen[sc]e", 62, ["x11"]),
    ("xfree86", r"xfree86 licen[sc]e", 62, ["xfree86"]),
    ("beerware", r"(?:beerware|beer ware licen[sc]e)", 62, ["beerware beer"]),
    ("json", r"the software shall be used for good not evil", 99, ["evil"]),
    ("sspl", r"server side public licen[sc]e|sspl", 68, ["sspl server"]),
    ("busl", r"business source licen[sc]e|busl 1 1", 68, ["business busl"]),
    ("elastic", r"elastic licen[sc]e(?: 2 0| v2)?", 66, ["elastic"]),
    ("commons-clause", r"commons clause", 66, ["commons"]),
    ("polyform", r"polyform (?:noncommercial|small business|strict|shield|perimeter|free trial|internal use)", 66, ["polyform"]),
    ("openrail", r"(?:creativeml )?open ?rail(?: m| s)?", 62, ["openrail rail"]),
    ("llama", r"llama (?:2|3|3 1) community licen[sc]e", 68, ["llama"]),
    ("hippocratic", r"hippocratic licen[sc]e", 66, ["hippocratic"]),
    ("vim", r"vim licen[sc]e", 62, ["vim"]),
    ("tcl", r"tcl tk licen[sc]e", 62, ["tcl"]),
    ("qpl", r"q public licen[sc]e", 64, ["q"]),
    ("ipl", r"ibm public licen[sc]e", 64, ["ibm"]),
    ("spl", r"sun public licen[sc]e", 64, ["sun"]),
    ("apsl", r"apple public source licen[sc]e|apsl", 66, ["apple apsl"]),
    ("npl", r"netscape public licen[sc]e", 66, ["netscape"]),
    ("lppl", r"latex project public licen[sc]e|lppl", 66, ["latex lppl"]),
    ("cecill", r"cecill(?: b| c| 2 1)?", 62, ["cecill"]),
    ("mulan", r"mulan (?:psl|permissive software licen[sc]e)", 66, ["mulan"]),
    ("ecl", r"educational community licen[sc]e", 66, ["educational"]),
    ("upl", r"universal permissive licen[sc]e", 66, ["universal"]),
    ("cpal", r"common public attribution licen[sc]e", 66, ["common"]),
    ("rpl", r"reciprocal public licen[sc]e", 66, ["reciprocal"]),
    ("bittorrent", r"bittorrent open source licen[sc]e", 66, ["bittorrent"]),
    ("intel", r"intel open source licen[sc]e", 66, ["intel"]),
    ("nasa", r"nasa open source agreement", 66, ["nasa"]),
    ("fair", r"fair licen[sc]e", 55, ["fair"]),
    ("cc0", r"cc0(?: 1 0)?", 62, ["cc0"]),
    ("cc0", r"to the extent possible under law .{1,80}? has waived all copyright", 97, ["waived"]),
    ("cc-by", r"creativecommons org licenses by (?:1|2|3|4) [05]", 96, ["creativecommons"]),
    ("cc-by-sa", r"creativecommons org licenses by sa (?:1|2|3|4) [05]", 96, ["creativecommons"]),
    ("cc-by-nc", r"creativecommons org licenses by nc (?:1|2|3|4) [05]", 96, ["creativecommons"]),
    ("cc-by-nd", r"creativecommons org licenses by nd (?:1|2|3|4) [05]", 96, ["creativecommons"]),
    ("cc-by-nc-sa", r"creativecommons org licenses by nc sa (?:1|2|3|4) [05]", 96, ["creativecommons"]),
    ("cc-by-nc-nd", r"creativecommons org licenses by nc nd (?:1|2|3|4) [05]", 96, ["creativecommons"]),
    ("cc-pd", r"creativecommons org publicdomain (?:zero|mark) 1 0", 96, ["creativecommons"]),
    ("odc-by", r"open data commons attribution licen[sc]e|odc by", 66, ["odc commons"]),
    ("pddl", r"public domain dedication and licen[sc]e|pddl", 66, ["dedication pddl"]),
    ("ogl", r"open government licen[sc]e", 66, ["government"]),
    ("etalab", r"(?:licence ouverte|open licence etalab|etalab)", 62, ["ouverte etalab"]),
    ("dl-de", r"datenlizenz deutschland", 66, ["datenlizenz"]),
    ("cdla", r"community data licen[sc]e agreement (?:permissive|sharing)", 66, ["community"]),
    ("public-domain", r"no copyright is claimed", 52, ["claimed"]),
    ("dual", r"dual licen[sc]ed under", 50, ["dual"]),
    ("see-license", r"see (?:the )?(?:accompanying )?licen[sc]e (?:file|txt|md)(?: for details)?", 30, ["see"]),
    ("proprietary", r"(?:commercial licen[sc]e required|not for redistribution|for internal use only|strictly confidential)", 41, ["commercial redistribution internal confidential"]),
    ("proprietary", r"end user licen[sc]e agreement", 42, ["agreement"]),
    ("proprietary", r"trade secrets? of", 41, ["secret secrets"]),
]


@dataclass(frozen=True)
class Signature:
    label: str
    pattern: re.Pattern
    keywords: tuple[frozenset[bytes], ...]
    priority: int
    score: float
    base: bool = False


def compiled(pattern: str) -> re.Pattern:
    return re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])")


def signatures() -> list[Signature]:
    """All signatures, in order: the forms of every family by rule, license sentences, base phrases."""
    out = []
    any_of = lambda text: frozenset(text.encode().split())
    under, one, many, tagged = any_of("licensed licenced released distributed available provided"), any_of("license licence"), any_of("licenses licences"), any_of("spdx")
    for label, name, versions, spdx, names in FAMILIES:
        name = f"(?:{name})"
        # a version may follow its name without a space
        names = any_of(" ".join([names, *(f"{w}{mark}{v.split()[0]}" for w in names.split() for v in versions for mark in ("", "v")), *(f"{w}v" for w in names.split() if versions)]))
        add = lambda p, priority, score, *keywords, label=label: out.append(Signature(label, compiled(p), keywords, priority, score))
        for v in versions:
            add(rf"(?:licen[sc]ed|released|distributed|available|provided) under (?:the )?(?:terms of )?(?:the )?{name}(?: licen[sc]e)?(?: version| ?v)? ?{v}", 90, 1.0, names, under)
            add(rf"{name}(?: licen[sc]e)?(?: version| ?v)? ?{v}", 70, 0.9, names)
            add(rf"spdx license identifier {spdx} {v}(?: only| or later)?", 95, 1.0, tagged)
        add(rf"(?:licen[sc]ed|released|distributed|available|provided) under (?:the |an |a )?(?:terms of )?(?:the )?{name}(?: licen[sc]e)?(?: international| unported)?", 80, 0.95, names, under)
        add(rf"{name} licen[sc]e", 60, 0.8, names, one)
        add(rf"licen[sc]e {name}", 50, 0.7, names, one)
        add(rf"(?:opensource org|gnu org|creativecommons org|apache org|mozilla org) licen[sc]es {name}", 85, 0.95, names, many)
        add(rf"spdx license identifier {spdx}(?: only| or later)?", 94, 1.0, tagged)
    for label, p, keyword in TEXTS:
        out.append(Signature(label, compiled(p), (frozenset({keyword.encode(), keyword.encode() + b"s"}),), 40 if label in ("proprietary", "public-domain") else 100, 0.5 if label == "proprietary" else 1.0))
    for label, p, priority, keywords in WRITTEN:
        score = 0.5 if label == "proprietary" else 0.3 if priority < 50 else 0.7 if priority < 70 else 1.0
        out.append(Signature(label, compiled(p), tuple(any_of(k) for k in keywords), priority, score))
    for phrase, label in BASE.items():
        out.append(Signature(label, compiled(phrase), (one,), 55, 0.8, True))
    return out


class Scanner:
    def __init__(self, all_signatures: list[Signature] | None = None):
        self.signatures = signatures() if all_signatures is None else all_signatures
        self.keywords = frozenset().union(*(k for s in self.signatures for k in s.keywords))

    def detections(self, words: list[bytes]) -> list[tuple[int, int, Signature, bool]]:
        """(first word, word after the last, signature, suppressed), in order."""
        if self.keywords.isdisjoint(words):
            return []
        there = self.keywords.intersection(words)
        text = b" ".join(words).decode("utf-8", "replace")
        starts = [0, *accumulate(len(w) + 1 for w in text.split(" "))]
        found = []
        for order, s in enumerate(self.signatures):
            if not any(k.isdisjoint(there) for k in s.keywords):
                for m in s.pattern.finditer(text):
                    found.append((bisect.bisect_right(starts, m.start()) - 1, bisect.bisect_left(starts, m.end() + 1), s, order))
        # best first; kept intervals never lie inside one another, so starts and ends rise together
        found.sort(key=lambda d: (-d[2].priority, d[0] - d[1], d[3], d[0]))
        kept: list[tuple[int, int]] = []
        out = []
        for a, b, s, _ in found:
            k = bisect.bisect_right(kept, (a, len(words) + 1))
            hidden = bool(k) and kept[k - 1][1] >= b
            if not hidden:
                # an interval that spans kept ones takes their place in the list; they stay detections
                while k < len(kept) and kept[k][1] <= b:
                    kept.pop(k)
                if k and kept[k - 1][0] == a:
                    kept.pop(k - 1)
                bisect.insort(kept, (a, b))
            out.append((a, b, s, hidden))
        return sorted(out, key=lambda d: (d[0], d[1], d[2].label))


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("label", pa.string()), ("priority", pa.int32()), ("score", pa.float64()), ("base", pa.bool_()), ("suppressed", pa.bool_())])))])
DDL = "doc_id long, n_words long, spans array<struct<first:long,last:long,label:string,priority:int,score:double,base:boolean,suppressed:boolean>>"


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words and spans (all detections, with what suppressed them noted) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for b in batches:
            ns, spans = [], []
            for t in b.column(1).to_pylist():
                words = alnum_words(t or "")
                ns.append(len(words))
                spans.append([{"first": x, "last": y - 1, "label": s.label, "priority": s.priority, "score": s.score, "base": s.base, "suppressed": hidden} for x, y, s, hidden in scanner.detections(words)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ns, pa.int64()), pa.array(spans, SCHEMA.field("spans").type)], schema=SCHEMA)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, DDL)


def digest(spans: DataFrame) -> DataFrame:
    """n_base, first_word, last_word, base_labels, labels and score from the spans."""
    base = F.filter("spans", lambda s: s["base"])
    shown = F.filter("spans", lambda s: ~s["suppressed"] | s["base"])
    names = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda s: s["label"]))), ",")
    return spans.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(F.transform(base, lambda s: s["first"])).alias("first_word"), F.array_max(F.transform(base, lambda s: s["first"])).alias("last_word"),
        names(base).alias("base_labels"), names(shown).alias("labels"), F.coalesce(F.array_max(F.transform(shown, lambda s: s["score"])), F.lit(0.0)).alias("score"), F.size("spans").cast("long").alias("n_detections"),
    )
