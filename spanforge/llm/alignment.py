"""Tokens of two vocabularies aligned by their bytes, counted through a dictionary of groups.

Offsets at which tokens of both encodings end cut a text into groups, each some ids of A and some
of B. Every group is interned: a block of documents holds its distinct groups once and, for every
document, which of them it has and how often. Links are expanded once for each distinct group, over
distinct ids with how often they stand there, never over the occurrences of a group. The documents
that hold a pair are counted in each block (groups that share a pair are counted by distinct
documents, all others by the documents of their one group) and added up; what a group is worth is
then joined back to the dictionaries of the blocks by the group, and multiplied by frequencies.

Both encodings start a new token at a single space, or at a line end, between two characters that are
not white space, so texts are cut there and a word is aligned once while a worker remembers it. Texts
with other white space, and those with a word whose tokens spell other bytes, are encoded at once.

Cases: null and empty texts, and those whose tokens spell other bytes than a space and the text
(U+2581 is written as a space by B), have no tokens: zeros and an empty groups_sha256. Very long
texts are taken whole, as a block of their own; rows that repeat an id or a text are rows and
documents of their own; pairs that tie for the highest count of their A id all count as best; an
empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.llm.common import Shared, kept_in_worker
from spanforge.llm.token_store import LineEncoder

#: Group occurrences after which a block of documents is closed.
BLOCK_GROUPS = 2_000_000
#: Words that a Python worker remembers, in each of two generations, and distinct groups, before it starts anew.
WORDS, GROUPS = 300_000, 1_000_000
#: Longer words are not remembered.
WORD_CHARS = 80



class Aligner:
    """Groups of texts, by numbers that hold within this worker.

    What stands between single spaces and line ends is aligned once while it is remembered. No piece of B spans a space,
    a line end (which B writes as a byte), or a letter and a mark after it, and no token of A does, so a word's
    groups are the same in any text."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor

        self.a = LineEncoder(path_a, 0)
        self.a.tokenizer.encode_special_tokens = True  # their strings in a text are plain text
        letters = str.maketrans({w: chr(b) for b, w in self.byte_letters().items()})
        vocabulary = self.a.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for w, i in vocabulary.items():
            self.bytes_a[i] = w.translate(letters).encode("latin-1", "replace")
        self.b = SentencePieceProcessor(model_file=path_b)
        n = range(self.b.vocab_size())
        spelled = [self.b.id_to_piece(i) for i in n]
        self.bytes_b = [bytes([int(spelled[i][3:5], 16)]) if self.b.is_byte(i) else spelled[i].replace("▁", " ").encode() for i in n]
        self.size_a, self.size_b = list(map(len, self.bytes_a)), list(map(len, self.bytes_b))
        joined = {x for i in n if not self.b.is_byte(i) for x in re.findall(r"(?<=[A-Za-z])[^A-Za-z\s▁]", spelled[i])}
        self.marks = "".join(m for m in self.a.MARKS if m not in joined)  # that no piece of B holds after a letter
        self.by_lines = not any("\n" in x or re.search("[^▁]▁", x) for x in spelled) and len(self.b.encode("\n")) == 2
        self.clear()

    def byte_letters(self) -> dict[int, str]:
        """How the byte-level vocabulary writes each byte."""
        from tokenizers.pre_tokenizers import ByteLevel

        split = ByteLevel(add_prefix_space=False, use_regex=False)
        out = {c: split.pre_tokenize_str(chr(c))[0][0] for c in range(0x80)}
        rest = [w for w in ByteLevel.alphabet() if w not in out.values()]
        seen = {b: w for c in (*range(0x80, 0x800), *range(0x800, 0xD800, 0x40), *range(0x10000, 0x110000, 0x1000)) for b, w in zip(chr(c).encode(), split.pre_tokenize_str(chr(c))[0][0], strict=True) if b >= 0x80}
        # bytes that no text holds stand for themselves where the alphabet has them
        return out | {ord(w): w for w in rest if ord(w) < 0x100 and ord(w) not in out} | seen

    def forget(self) -> None:
        """Words, but no groups."""
        self.spaced: dict[str, bytes | None] = {}
        self.others: dict[str, bytes | None] = {}

    def clear(self) -> None:
        self.forget()
        self.older: dict[str, bytes | None] = {}
        self.number: dict[int | tuple, int] = {}
        self.texts: list[str] = []
        self.sizes: list[tuple[int, int]] = []
        self.pairs: list[np.ndarray] = []

    def group(self, key: int | tuple, a: list[int], b: list[int]) -> int:
        g = self.number[key] = len(self.texts)
        self.texts.append(f"{','.join(map(str, a))}|{','.join(map(str, b))}")
        self.sizes.append((len(a), len(b)))
        codes = [x << 32 | y for x in sorted(set(a)) for y in sorted(set(b))] if len(a) * len(b) < 64 else (np.unique(np.asarray(a, np.int64))[:, None] << 32 | np.unique(np.asarray(b, np.int64))[None, :]).ravel()
        self.pairs.append(np.asarray(codes, np.int64))
        return g

    def merged(self, a: list[int], b: list[int], want: bytes) -> bytes | None:
        """Little-endian 32-bit numbers of the groups of both encodings; none if either spells something else."""
        bytes_a, bytes_b, size_a, size_b, number = self.bytes_a, self.bytes_b, self.size_a, self.size_b, self.number
        if b"".join([bytes_a[i] for i in a]) != want or b"".join([bytes_b[i] for i in b]) != want:
            return None
        out, j, from_i, from_j, end_a, end_b = [], 0, 0, 0, 0, 0
        for i, x in enumerate(a, 1):
            end_a += size_a[x]
            while end_b < end_a:
                end_b += size_b[b[j]]
                j += 1
            if end_a == end_b:
                key = x << 32 | b[from_j] if i - from_i == 1 == j - from_j else (tuple(a[from_i:i]), tuple(b[from_j:j]))
                g = number.get(key)
                out.append(self.group(key, a[from_i:i], b[from_j:j]) if g is None else g)
                from_i, from_j = i, j
        return array("i", out).tobytes()

    def whole(self, text: str) -> bytes | None:
        """Groups of a text that a space stands before."""
        first, *rest = self.a.pieces(text)
        a = np.frombuffer(self.a.some((" " + first, *rest)), "<u4").tolist()
        return self.merged(a, self.b.encode(text), b" " + text.encode())

    def after_space(self, word: str) -> bytes | None:
        out = self.older.get(word, b"")
        if out == b"":
            out = self.new(word)
        if len(self.spaced) >= WORDS:
            self.older, self.spaced = self.spaced, {}
        if len(word) <= WORD_CHARS:
            self.spaced[word] = out
        return out

    def new(self, word: str) -> bytes | None:
        if word.isascii():
            if word.isalpha():
                return self.merged([t.id for t in self.a.model.tokenize(self.a.space + word)], self.b.encode(word), b" " + word.encode())
            body = word.rstrip(self.marks)
            if body.isalpha() and len(body) < len(word):
                marks = word[len(body) :]
                one, two = self.spaced.get(body) or self.after_space(body), self.others.get(marks) or self.unspaced(marks)
                return None if one is None or two is None else one + two
        return self.whole(word)

    def unspaced(self, piece: str) -> bytes | None:
        """Groups of a line end and the word after it, or of marks within a word."""
        line = piece[0] == "\n"
        a = (self.a.newline if line else b"") + (self.a.of(piece[1:]) if line else self.a.of(piece))
        b = self.b.encode(piece)[1:] if line else self.b.encode("\n" + piece)[2:]
        out = self.merged(np.frombuffer(a, "<u4").tolist(), b, piece.encode())
        if len(piece) <= WORD_CHARS:
            if len(self.others) >= WORDS:
                self.others = {}
            self.others[piece] = out
        return out

    def __call__(self, text: str | None) -> bytes:
        """Little-endian 32-bit group numbers; empty for a text without tokens."""
        if not text:
            return b""
        if not self.by_lines or self.a.odd(text):
            return self.whole(text) or b""
        got: list[bytes | None] = []
        for k, line in enumerate(text.split("\n")):
            words = line.split(" ")
            spaced = self.spaced
            own = list(map(spaced.get, words))
            if k:
                piece = "\n" + words[0]
                own[0] = self.others.get(piece) or self.unspaced(piece)
            if None in own:
                for i, x in enumerate(own):
                    if x is None and (i or not k):
                        own[i] = self.spaced.get(words[i]) or self.after_space(words[i])
            got += own
        return (self.whole(text) or b"") if None in got else b"".join(got)  # what the pieces don't spell the text may


BLOCK = pa.schema([
    ("block", pa.int64()), ("groups", pa.list_(pa.string())), ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64())),
    ("doc_id", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int64())), ("n_b", pa.list_(pa.int64())), ("n_groups", pa.list_(pa.int64())), ("n_links", pa.list_(pa.int64())),
    ("groups_sha256", pa.list_(pa.string())), ("held", pa.list_(pa.int64())), ("steps", pa.binary()), ("times", pa.binary()),
])
BLOCK_DDL = "block long, groups array<string>, pairs array<long>, docs array<long>, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, held array<long>, steps binary, times binary"
DOC_DDL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def planes(x: np.ndarray) -> bytes:
    """32-bit numbers by the significance of their bytes, which compresses."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of so many values."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def expanded(lists: list[np.ndarray], which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists of some numbers end to end, and at which place of which each number stood."""
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    flat, first = np.concatenate(lists), np.cumsum(n) - n
    own = n[which]
    at = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own) + np.repeat(first[which], own)
    return flat[at], np.repeat(np.arange(len(which)), own)


def pair_documents(doc: np.ndarray, group: np.ndarray, pairs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, and how many documents hold each: doc and group are the distinct groups of documents."""
    codes, owner = expanded(pairs, np.arange(len(pairs)))
    distinct, number = np.unique(codes, return_inverse=True)
    shared = np.bincount(number, minlength=len(distinct)) > 1
    in_group = np.bincount(group, minlength=len(pairs))
    count = np.zeros(len(distinct), np.int64)
    alone = ~shared[number]
    count[number[alone]] = in_group[owner[alone]]
    # pairs of several groups: each document once
    rest = [np.zeros(0, np.int64)] * len(pairs)
    if not alone.all():
        several = np.flatnonzero(~alone)
        cuts = np.flatnonzero(np.diff(owner[several])) + 1
        for g, xs in zip(owner[several][np.concatenate([[0], cuts])].tolist(), np.split(number[several], cuts), strict=True):
            rest[g] = xs
        has = np.fromiter((len(x) > 0 for x in rest), bool, len(rest))[group]
        which, at = expanded(rest, group[has])
        held = np.unique(doc[has][at] * len(distinct) + which)
        count += np.bincount(held % len(distinct), minlength=len(distinct))
    return distinct, count


def encode_blocks(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text", block_groups: int = BLOCK_GROUPS) -> DataFrame:
    """Blocks of documents: their distinct groups, documents by pair, and each document's groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = kept_in_worker(("aligner", path_a, path_b), lambda: Aligner(path_a, path_b))
        block = TaskContext.get().partitionId() << 32
        ids: list[int | None] = []
        codes: list[bytes] = []
        shas: list[str] = []
        size = 0

        def close() -> pa.RecordBatch:
            n = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
            numbers = np.frombuffer(b"".join(codes), "<i4")
            used = np.flatnonzero(np.bincount(numbers, minlength=1))
            place = np.zeros(len(align.texts) + 1, np.int64)
            place[used] = np.arange(len(used))
            local = place[numbers]
            sizes = np.asarray([align.sizes[g] for g in used.tolist()], np.int64).reshape(-1, 2)
            width = max(len(used), 1)
            held, times = np.unique(np.repeat(np.arange(len(n)), n) * width + local, return_counts=True)
            doc, group = held // width, held % width
            per_doc = np.bincount(doc, minlength=len(n))
            pairs, count = pair_documents(doc, group, [align.pairs[g] for g in used.tolist()]) if len(used) else (np.zeros(0, np.int64),) * 2
            steps = np.diff(group, prepend=0)
            firsts = (np.cumsum(per_doc) - per_doc)[per_doc > 0]
            steps[firsts] = group[firsts]
            row = {
                "block": [block], "groups": [[align.texts[g] for g in used.tolist()]], "pairs": [pairs], "docs": [count], "doc_id": [ids], "n_a": [sums(sizes[local, 0], n)], "n_b": [sums(sizes[local, 1], n)], "n_groups": [n],
                "n_links": [sums(sizes[local, 0] * sizes[local, 1], n)], "groups_sha256": [shas], "held": [per_doc], "steps": [planes(steps)], "times": [planes(times)],
            }
            return pa.RecordBatch.from_pydict(row, BLOCK)

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                code = align(t)
                ids.append(i)
                codes.append(code)
                shas.append(hashlib.sha256(";".join(map(align.texts.__getitem__, array("i", code))).encode()).hexdigest() if code else "")
                size += len(code) // 4
                if size >= block_groups:
                    yield close()
                    block, ids, codes, shas, size = block + 1, [], [], [], 0
                    if len(align.texts) > GROUPS:
                        align.clear()
        if ids:
            yield close()
        if len(align.texts) > GROUPS:
            align.clear()

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, BLOCK_DDL)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """a, b, docs: how many documents hold an id pair linked; best: whether none of a's pairs is in more."""
    each = blocks.select(F.explode(F.arrays_zip("pairs", "docs")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.docs").alias("docs"))
    split = each.select(F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b"), "docs")
    return split.withColumn("best", F.col("docs") == F.max("docs").over(W.partitionBy("a")))  # a partition has as many rows as B has ids at most


def group_worth(groups: DataFrame, pairs: DataFrame) -> DataFrame:
    """For each distinct group: best, how many of its links are of a best pair, and total, the sum of their counts."""

    def ids(k: int, name: str):
        own = F.split(F.split_part("g", F.lit("|"), F.lit(k)), ",").cast("array<long>")
        return F.transform(F.array_distinct(own), lambda x: F.struct(x.alias("id"), F.size(F.filter(own, lambda y: y == x)).alias("n"))).alias(name)

    by_a = groups.select("g", ids(2, "bs"), F.explode(ids(1, "as_")).alias("a"))
    links = by_a.select("g", F.col("a.id").alias("a"), F.col("a.n").alias("m"), F.explode("bs").alias("b")).select("g", "a", F.col("b.id").alias("b"), (F.col("m") * F.col("b.n")).cast("long").alias("n"))
    worth = links.join(pairs, ["a", "b"])
    return worth.groupBy("g").agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("best"), F.sum(F.col("n") * F.col("docs")).alias("total"))


def finish(left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents of a block, whose groups are now worth something."""
    best, total = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
    at = right.column("at").to_numpy()
    best[at], total[at] = right.column("best").to_numpy(), right.column("total").to_numpy()
    held = left.column("held")[0].values.to_numpy()
    steps, times = (from_planes(left.column(k)[0].as_py()) for k in ("steps", "times"))
    run, some = np.cumsum(steps), held[held > 0]
    firsts = np.cumsum(some) - some
    group = run - np.repeat(run[firsts] - steps[firsts], some)
    cols = {k: left.column(k)[0].values for k in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    cols |= {"n_best": pa.array(sums(best[group] * times, held)), "count_sum": pa.array(sums(total[group] * times, held)), "groups_sha256": left.column("groups_sha256")[0].values}
    return pa.table(cols)


def align_tokens(docs: DataFrame, path_a: str, path_b: str, shared: Shared, **columns: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    blocks = shared.write(encode_blocks(docs, path_a, path_b, **columns))
    entries = blocks.select("block", F.posexplode("groups").alias("at", "g"))
    worth = group_worth(entries.select("g").distinct(), pair_counts(blocks))
    back = entries.join(worth, "g").select(F.col("block").alias("of"), "at", "best", "total")
    held = blocks.select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "held", "steps", "times")
    return held.groupBy("block").cogroup(back.groupBy("of")).applyInArrow(finish, DOC_DDL)
