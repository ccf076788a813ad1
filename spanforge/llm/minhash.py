"""Near-duplicates by b-bit MinHash with bands, confirmed on full sets.

A unit (a document, or a paragraph) is a set of word shingles, kept as 64-bit hashes. Units with
the same set form a class, and only classes go on. Of each class 160 minima are taken; five in a
row make a band, 32 bands in all, so two sets of similarity 0.8 share none of them with
probability (1 - 0.8**5)**32, about 3e-6. Of each minimum only four bits are kept, in four bit
planes of three longs; for a candidate pair, XOR and bit counts of the planes give the share m of
minima that agree, and (m - 1/16) / (1 - 1/16) corrects it for chance. A pair whose estimate is
more than five standard deviations below the threshold goes no further; all others are confirmed
on the full sets.

A set's signature is written once in a task, and the minima of a bucket go no further than a count
if nothing else is in it: a bounded filter of the full buckets passes over the rest, as others pass
over the texts whose sets are not asked for.

Buckets may hold any number of classes. A class's weight is the size of all its buckets together;
the heaviest class of a bucket leads it, and each class is first compared to the heaviest of its
leaders alone, which is the text that the others were copied from if there is one. That yields
components; pairs within a component need no more work. Where a leader is of another component
this is done once more. In the buckets that still hold several components, every member outside
the bucket's largest component is compared to every member of another component, in packs of about
PACK and in the first bucket that both share: by the bits first, which leaves the classes that have
a candidate, then those on the full sets. No row is made for a pair, only for a link, and one link
between an outsider and a component is enough. That is the exact way for the rest; nothing is
capped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.llm.common import Runs, Shared, few_at_once, hot_join, membership, released
from spanforge.llm.components import components

BITS = 4
PACK = 128
#: Shingles in a pack, about; a larger set is a pack by itself.
PACK_ITEMS = 100_000
#: Packs of members in a group.
SALT_PACKS = 16
#: Members that meet one copy of their leader's set.
SALT = 200
HASHES = 640
_rng = np.random.default_rng(20240229)
_A = _rng.integers(1, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_MIX = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass(frozen=True)
class Shape:
    """Minima in a band, and bands."""

    rows: int
    bands: int

    @property
    def hashes(self) -> int:
        return self.rows * self.bands

    @property
    def words(self) -> int:
        """Longs in a bit plane."""
        return -(-self.hashes // 64)


#: For documents, whose sets share common shingles by chance.
DOCUMENTS = Shape(5, 32)

UNIT_SCHEMA = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("nid", pa.int64()), ("bands", pa.list_(pa.int64())), ("planes", pa.list_(pa.int64()))])
UNIT_DDL = "doc_id long, key long, n long, nid long, bands array<long>, planes array<long>"


def shingle_set(h: np.ndarray, k: int) -> np.ndarray:
    """Distinct shingles of k words, sorted; the whole sequence where there are fewer words."""
    if not len(h):
        return h
    x = np.sort(Runs(h).of(min(k, len(h))))
    keep = np.empty(len(x), bool)
    keep[0], keep[1:] = True, x[1:] != x[:-1]
    return x[keep]


def set_id(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def short(s: np.ndarray) -> np.ndarray:
    """High halves of hashes, which minima are taken of."""
    return (s >> np.uint64(32)).astype(np.uint32)


def minima(s: np.ndarray, count: int) -> np.ndarray:
    """The smallest of a*x + b over the set, modulo 2**32, one for each of the first functions."""
    x, out, step = short(s), None, max(1, 330_000 // count)
    for at in range(0, len(x), step):
        m = x[None, at : at + step] * _A[:count, None]
        m += _B[:count, None]
        m = m.min(axis=1)
        out = m if out is None else np.minimum(out, m)
    return out.astype(np.uint64)


def signatures(m: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and bit planes of many rows of minima."""
    x = (m.reshape(-1, shape.bands, shape.rows) * _MIX[: shape.hashes].reshape(shape.bands, shape.rows)).sum(axis=2, dtype=np.uint64)
    bands = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    planes = []
    for bit in range(BITS):
        on = ((m >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8)
        on = np.pad(on, ((0, 0), (0, 64 * shape.words - shape.hashes)))
        planes.append(np.packbits(on, axis=1, bitorder="little").view("<u8"))
    return bands.view(np.int64), np.concatenate(planes, axis=1).view(np.int64)


#: A text's sets with their ids.
Sets = Callable[[str | None], list[tuple[int, np.ndarray]]]


def document_set(words: Callable[[str], np.ndarray], k: int) -> Sets:
    """The set of a whole text; none for a text without words."""

    def sets(text: str | None) -> list[tuple[int, np.ndarray]]:
        s = shingle_set(words(text or ""), k)
        return [(set_id(s), s)] if len(s) else []

    return sets


#: Ids of sets that a task remembers, so that it gives a signature once.
REMEMBERED = 1 << 18


def units_of(rows: DataFrame, sets: Sets, shape: Shape = DOCUMENTS) -> DataFrame:
    """(doc_id, key, n, nid, bands, planes) and the columns after text of rows (doc_id, key, text).

    nid is null without words; bands and planes stand only where the task has not given them for that set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for b in batches:
            if len(given) > REMEMBERED:
                given.clear()
            ns, nids, low, where = [], [], [], []
            for t in few_at_once(b.column(2)):
                own = sets(t)
                nid, s = own[0] if own else (None, ())
                ns.append(len(s))
                nids.append(nid)
                if nid is None or nid in given:
                    where.append(None)
                    continue
                given.add(nid)
                where.append(len(low))
                low.append(minima(s, shape.hashes))
            if low:
                bands, planes = (x.tolist() for x in signatures(np.stack(low), shape))
                at = [[None if w is None else x[w] for w in where] for x in (bands, planes)]
            else:
                at = [[None] * len(ns)] * 2
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ns, pa.int64()), pa.array(nids, pa.int64()), *(pa.array(x, pa.list_(pa.int64())) for x in at), *b.columns[3:]], names=[*UNIT_SCHEMA.names, *b.schema.names[3:]])

    return rows.mapInArrow(released(run), ", ".join([UNIT_DDL, *(f"`{c}` {kind}" for c, kind in rows.dtypes[3:])]))


def sets_of(rows: DataFrame, sets: Sets, keys, nids) -> DataFrame:
    """(nid, items) of rows (key, text): the sets whose ids, of rows whose keys, pass the broadcast filters; a set may come twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).filter(pa.array(keys.value.test(b.column(0).to_numpy()))).to_pylist()
            own = [x for t in texts for x in sets(t)]
            ids = np.array([i for i, _ in own], np.int64)
            on = np.flatnonzero(nids.value.test(ids)) if len(ids) else []
            yield pa.RecordBatch.from_arrays([pa.array([own[k][0] for k in on], pa.int64()), pa.array([own[k][1].view(np.int64) for k in on], pa.list_(pa.int64()))], names=["nid", "items"])

    return rows.select(F.xxhash64("key").alias("h"), "text").mapInArrow(run, "nid long, items array<long>")


def bands_in(sigs: DataFrame, full) -> DataFrame:
    """(band, nid) of the signatures' bands that pass the broadcast filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            flat = lists.flatten().to_numpy()
            on = full.value.test(flat)
            nids = np.repeat(b.column(0).to_numpy(), lists.value_lengths().to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(flat[on]), pa.array(nids[on])], names=["band", "nid"])

    return sigs.select("nid", "bands").mapInArrow(run, "band long, nid long")


def estimate(x: Column, y: Column, shape: Shape) -> Column:
    """Similarity by bit counts of two arrays of planes, corrected for chance agreement."""
    differ = F.lit(0)
    for w in range(shape.words):
        word = x[w].bitwiseXOR(y[w])
        for bit in range(1, BITS):
            word = word.bitwiseOR(x[bit * shape.words + w].bitwiseXOR(y[bit * shape.words + w]))
        differ = differ + F.bit_count(word)
    chance = 1 / 2**BITS
    return ((1 - differ / shape.hashes) - chance) / (1 - chance)


def may_link(t: float, hashes: int) -> float:
    """The least estimate that is within five standard deviations of the threshold."""
    m = t + (1 - t) / 2**BITS
    return t - 5 * (m * (1 - m) / hashes) ** 0.5 / (1 - 1 / 2**BITS)


def linked_classes(rows: DataFrame, sigs: DataFrame, keys: DataFrame, sets: Sets, percent: int, shared: Shared, shape: Shape = DOCUMENTS, sized: bool = True) -> DataFrame:
    """(nid, root) of the classes that are linked to another, directly or not.

    rows: (key, text); sigs: a written table nid, n, bands, planes, where a set may come more than
    once; keys: nid and the key of one of its rows; sized: n is the size of the set; percent: links
    need 100 * intersection >= percent * union."""
    least = may_link(percent / 100, shape.hashes)

    def full_sets(nids: DataFrame) -> DataFrame:
        """(nid, items) of the classes in a table of them."""
        at = shared.write(nids.join(keys, "nid").select("nid", F.xxhash64("key").alias("h")))
        got = sets_of(rows, sets, membership(at, "h"), membership(at, "nid"))
        return got.join(at.select("nid"), "nid", "left_semi").dropDuplicates(["nid"])

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full sets pass, a table of one pair for each b.

        Of the members of a leader, SALT meet in a group, and each group has the leader's set."""
        groups = pairs.groupBy(F.col("a").alias("nid")).agg(F.ceil(F.count("*") / SALT).cast("int").alias("salts"))
        dealt = pairs.join(groups.withColumnRenamed("nid", "a"), "a").select(F.col("b").alias("nid"), F.col("a").alias("lead"), F.pmod(F.xxhash64("b"), "salts").cast("int").alias("salt"))
        asked = shared.write(dealt.join(groups, "nid", "full"))
        one = full_sets(asked.select("nid")).join(asked, "nid")
        as_lead = F.transform(F.sequence(F.lit(0), F.col("salts") - 1), lambda s: F.struct(F.col("nid").alias("lead"), s.alias("salt"), F.lit(0).alias("role")))
        as_member = F.array(F.struct("lead", "salt", F.lit(1).alias("role")))
        none = F.expr("array()").cast("array<struct<lead:long,salt:int,role:int>>")
        parts = F.concat(F.when(F.col("salts").isNull(), none).otherwise(as_lead), F.when(F.col("lead").isNull(), none).otherwise(as_member))
        met = one.select("nid", "items", F.explode(parts).alias("p")).select("p.lead", "p.salt", "p.role", "nid", "items")
        met = met.repartition("lead", "salt").sortWithinPartitions("lead", "salt", "role")
        return shared.write(met.mapInArrow(with_leader(percent), "a long, b long"))

    def led(members: DataFrame, sig: DataFrame) -> DataFrame:
        """Links of classes to the heaviest leader of their buckets that is of another component."""
        best = members.where("root <> lead_root").groupBy("nid").agg(F.max(F.struct("lead_weight", "lead")).alias("best"))
        pairs = best.select(F.col("best.lead").alias("a"), F.col("nid").alias("b"))
        a = sig.select(F.col("nid").alias("a"), F.col("n").alias("na"), F.col("planes").alias("pa"))
        b = sig.select(F.col("nid").alias("b"), F.col("n").alias("nb"), F.col("planes").alias("pb"))
        close = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent if sized else F.lit(True)
        near = shared.write(pairs.join(b, "b").join(a, "a").where(close & (estimate(F.col("pa"), F.col("pb"), shape) >= least)).select("a", "b"))
        return confirmed(near)

    def named(members: DataFrame, roots: DataFrame, *columns: str) -> DataFrame:
        """The roots of members filled in anew."""
        for c, r in zip(columns, ("root", "lead_root"), strict=False):
            to = roots.select(F.col("node").alias(c), F.col("root").alias("top"))
            members = members.drop(r).join(to, c, "left").withColumn(r, F.coalesce("top", c)).drop("top")
        return members

    many = shared.write(sigs.select(F.explode("bands").alias("band")).groupBy("band").count().where("count > 1").select("band"))
    found = bands_in(sigs, membership(many, "band")).distinct()
    shared.drop(many)
    found = shared.write(found)
    counts = found.groupBy("band").agg(F.count("*").alias("c")).where("c > 1")
    full = shared.write(found.join(counts, "band"))
    shared.drop(found)
    weight = full.groupBy("nid").agg(F.sum("c").alias("weight"))
    heavy = shared.write(full.join(weight, "nid").select("band", "nid", "weight"))
    shared.drop(full)
    lead = heavy.groupBy("band").agg(F.max(F.struct("weight", "nid")).alias("l")).select("band", F.col("l.weight").alias("lead_weight"), F.col("l.nid").alias("lead"))
    members = shared.write(heavy.join(lead, "band").select("band", "nid", "lead", "lead_weight", F.col("nid").alias("root"), F.col("lead").alias("lead_root")))
    shared.drop(heavy)
    sig = shared.write(sigs.join(members.select("nid").distinct(), "nid", "left_semi").dropDuplicates(["nid"]))
    links = led(members, sig)
    roots = components(links, shared)
    links = links.unionByName(led(named(members, roots, "nid", "lead"), sig))
    roots = components(links, shared)
    # what that leaves open: buckets with more than one component
    now = shared.write(named(members.select("band", "nid"), roots, "nid"))
    shared.drop(members)
    mains = now.groupBy("band", "root").agg(F.count("*").alias("c")).groupBy("band").agg(F.max(F.struct("c", "root")).alias("main"), F.count("*").alias("many")).where("many > 1")
    rest = shared.write(now.join(mains.select("band", F.col("main.root").alias("main")), "band"))
    shared.drop(now)
    # first by the bits alone: which classes have a candidate of another component, and in which bucket
    bits = packs(rest.join(sig.select("nid", F.lit(1).cast("long").alias("items_n"), F.col("planes").alias("items"), "bands"), "nid")).mapInArrow(by_bits(shape, least), "band long, nid long")
    flagged = shared.write(rest.join(bits.distinct(), ["band", "nid"]))
    shared.drop(rest)
    if flagged.isEmpty():
        shared.drop(sig)
        return roots.select(F.col("node").alias("nid"), "root")
    # then these on the full sets
    items = shared.write(full_sets(flagged.select("nid").distinct()).join(sig.select("nid", "bands"), "nid"))
    shared.drop(sig)
    more = shared.write(packs(flagged.join(items.withColumn("items_n", F.size("items").cast("long")), "nid")).mapInArrow(by_sets(percent), "a long, b long").distinct())
    shared.drop(items)
    if more.isEmpty():
        return roots.select(F.col("node").alias("nid"), "root")
    return components(links.unionByName(more), shared).select(F.col("node").alias("nid"), "root")


def packs(rest: DataFrame) -> DataFrame:
    """(band, outside, members): packs of a bucket's outsiders met with packs of all its members.

    rest: band, nid, root, main, bands, items, items_n. A bucket is cut into packs of about PACK classes
    or PACK_ITEMS items, and the packs of members into groups of SALT_PACKS, which the outsiders'
    packs are repeated for, so that no task has to meet all of a large bucket."""
    size = rest.groupBy("band").agg(F.ceil(F.greatest(F.count("*") / PACK, F.sum("items_n") / PACK_ITEMS)).alias("packs"))
    rest = rest.join(size, "band").withColumns({"one": F.struct("nid", "root", "bands", "items"), "pack": F.pmod(F.xxhash64("nid"), "packs")})
    salt = F.floor(F.col("pack") / SALT_PACKS).alias("salt")
    members = rest.groupBy("band", "pack").agg(F.collect_list("one").alias("members")).select("band", salt, "members")
    outside = rest.where("root <> main").groupBy("band", "pack", "packs").agg(F.collect_list("one").alias("outside"))
    outside = outside.select("band", "outside", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("packs") - 1) / SALT_PACKS))).alias("salt"))
    return outside.join(members, ["band", "salt"]).select("band", "outside", "members")


def with_leader(percent: int):
    """Of rows (lead, salt, role, nid, items) in that order, the pairs (lead, nid) that pass; a group's first row is its leader."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, x = None, None
        for b in batches:
            lead, salt, role, nid = (b.column(i).to_numpy() for i in range(4))
            lists = b.column(4)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            flat = lists.flatten().to_numpy()
            pairs = []
            for k in range(b.num_rows):
                own = flat[ends[k] : ends[k + 1]]
                if role[k] == 0:
                    at, x = (lead[k], salt[k]), np.sort(own)
                elif at == (lead[k], salt[k]) and lead[k] != nid[k]:
                    common = int((x[np.minimum(np.searchsorted(x, own), len(x) - 1)] == own).sum())
                    if common * 100 >= (len(x) + len(own) - common) * percent:
                        pairs.append((lead[k], nid[k]))
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return run


def each_outsider(b: pa.RecordBatch) -> Iterator[tuple]:
    """Of packs that met: band, then the outsider's id, items, and the ids, roots and items of the members
    of other components that share this bucket with it and none before."""
    for row in range(b.num_rows):
        band = b.column(0)[row].as_py()
        mine, theirs = (unpacked(b.column(i)[row].values) for i in (1, 2))
        nids, roots, bands, items, ends = theirs
        for nid, root, own, x in zip(mine[0].tolist(), mine[1], mine[2], np.split(mine[3], mine[4][1:-1]), strict=True):
            same = bands == own
            here = bands[np.arange(len(nids)), same.argmax(axis=1)] == band  # the first bucket that both are in
            at = np.flatnonzero((roots != root) & here)
            if len(at):
                yield band, nid, x, at, nids, roots, items, ends


def by_bits(shape: Shape, least: float):
    """(band, nid) of outsiders and members whose planes say that they may link."""
    chance = 1 / 2**BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: set[tuple[int, int]] = set()
            for band, nid, x, at, nids, _, items, _ in each_outsider(b):
                differ = (items.reshape(len(nids), BITS, shape.words)[at] ^ x.reshape(BITS, shape.words)).view(np.uint64)
                share = 1 - np.bitwise_count(np.bitwise_or.reduce(differ, axis=1)).sum(axis=1) / shape.hashes
                near = nids[at[(share - chance) / (1 - chance) >= least]]
                if len(near):
                    out.add((band, nid))
                    out.update((band, y) for y in near.tolist())
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], names=["band", "nid"])

    return run


def by_sets(percent: int):
    """Links (a, b) between two components by full sets: of each outsider one to each component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            links: set[tuple[int, int]] = set()
            for _, nid, x, at, nids, roots, items, ends in each_outsider(b):
                sizes = np.diff(ends)
                at = at[np.minimum(sizes[at], len(x)) * 100 >= np.maximum(sizes[at], len(x)) * percent]
                if not len(at):
                    continue
                x = np.sort(x)
                parts = [items[ends[k] : ends[k + 1]] for k in at.tolist()]
                flat = np.concatenate(parts)
                k = np.minimum(np.searchsorted(x, flat), len(x) - 1)
                common = np.add.reduceat(x[k] == flat, np.concatenate([[0], np.cumsum([len(p) for p in parts])[:-1]]), dtype=np.int64)
                at = at[common * 100 >= (sizes[at] + len(x) - common) * percent]
                _, first = np.unique(roots[at], return_index=True)
                links.update((min(nid, y), max(nid, y)) for y in nids[at[first]].tolist())
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in links], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return run


def unpacked(pack: pa.StructArray) -> tuple[np.ndarray, ...]:
    """Ids, roots, band keys as a matrix, and all items with where each set's begin."""
    nids, roots, bands, items = pack.flatten()
    ends = np.concatenate([[0], np.cumsum(items.value_lengths().to_numpy())])
    return nids.to_numpy(), roots.to_numpy(), bands.flatten().to_numpy().reshape(len(nids), -1), items.flatten().to_numpy(), ends


def near_duplicates(docs: DataFrame, words: Callable[[str], np.ndarray], k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id (smallest doc_id that links reach), nid,
    root (the nid that stands for the component) and the columns of carry.

    words gives the hashes of a text's words; nid is a hash of the row's set, the same for equal sets alone.

    Cases: a text without words, or null, has no shingles and is linked with nothing, so it is its
    own component and its nid is null; a text of fewer than k words is one shingle; very long texts are
    taken whole; rows with equal sets are always linked; among leaders of equal weight the larger nid
    leads, which changes no component; a null doc_id never becomes a component_id while the component
    has another; rows that repeat a doc_id each get a row; an empty table gives an empty result; other
    columns, whatever their names, are ignored."""
    shared = Shared(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(doc_id).cast("long"), F.xxhash64(text)).alias("key"), F.col(text).alias("text"), *carry)
    sets = document_set(words, k)
    units = shared.write(units_of(rows, sets))
    classes = shared.write(units.where("nid is not null").groupBy("nid").agg(F.min("key").alias("key"), F.min("doc_id").alias("least")))
    roots = linked_classes(rows, units.where("bands is not null").select("nid", "n", "bands", "planes"), classes.select("nid", "key"), sets, percent, shared)
    named = shared.write(classes.select("nid", "least").join(roots, "nid", "left").select("nid", "least", F.coalesce("root", "nid").alias("root")))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = hot_join(named, smallest, "root").select("nid", "root", "component_id")
    ids = units.select("doc_id", F.col("n").alias("n_shingles"), "nid", *carry)
    columns = ["doc_id", "n_shingles", "component_id", "nid", "root", *carry]
    out = hot_join(ids.where("nid is not null"), by_class, "nid").select(*columns)
    return out.unionByName(ids.where("nid is null").withColumns({"component_id": F.col("doc_id"), "root": F.lit(None).cast("long")}).select(*columns))


#: The same for two-word shingles and a similarity of 0.8 as DuckDB SQL, on tables where each doc_id stands once.
SQL = r"""
WITH RECURSIVE low AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p + 1:p + least(2, len(w))], ' ') AS sh FROM (SELECT doc_id, w, unnest(range(greatest(1, len(w) - 1))) AS p FROM low WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
sides AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT DISTINCT x AS doc_id, x AS node FROM sides UNION SELECT r.doc_id, e.y FROM reach r JOIN sides e ON r.node = e.x),
least_of AS (SELECT doc_id, min(node) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id, coalesce(component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least_of l ON l.doc_id = d.doc_id
"""
