"""Token ids in directly addressable codes.

An id is cut into 8-bit chunks, lowest first. Level k holds the k-th chunk of every id that has
one, and a bitmap with a bit for each of them that says whether the id goes on at level k + 1.
A rank directory counts the set bits before every 512th, so the place of a continued id on the
next level costs one lookup and the bits of one 64-byte block: any id is read without decoding
its neighbours. A shard is one self-contained byte string of up to SHARD_IDS ids (a document is
never split, so a longer one makes a longer shard); shards travel in Parquet files, which Spark
commits whole or not at all, so a lost executor leaves no half-written shard.

Cases: a null text is encoded as an empty one, which leaves the end id alone; null ids sort
first; rows that repeat an id are stored one after the other, by text; an empty table gives no
shards and no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.llm.common import few_at_once, kept_in_worker, released

SHARD_IDS = 1 << 20
BLOCK_BITS = 512
MAGIC = b"DAC1"
#: Distinct pieces of text whose ids a Python worker keeps in each of two generations.
PIECES = 250_000

SHARD_SCHEMA = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("payload", pa.binary())])
SHARD_DDL = "part int, seq int, n_ids long, doc_ids array<long>, n_tokens array<long>, payload binary"


def pack(ids: np.ndarray) -> bytes:
    """The byte string of some ids: magic, counts of each level, then chunks, bitmap and ranks of each."""
    levels = []
    rest = np.ascontiguousarray(ids, "<u4")
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (BLOCK_BITS // 8), np.uint8)])
        ones = np.bitwise_count(bits).reshape(-1, BLOCK_BITS // 8).sum(axis=1, dtype=np.uint64)
        ranks = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4") if len(ones) else np.zeros(0, "<u4")
        levels.append((len(rest), (rest & 0xFF).astype(np.uint8).tobytes() + bits.tobytes() + ranks.tobytes()))
        rest = rest[more] >> 8
        if not len(rest):
            break
    return MAGIC + struct.pack("<B", len(levels)) + b"".join(struct.pack("<Q", n) for n, _ in levels) + b"".join(b for _, b in levels)


class Codes:
    """A packed byte string, read in place."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a shard of token ids")
        n, at = payload[4], 5 + 8 * payload[4]
        self.levels = []
        for size in struct.unpack_from(f"<{n}Q", payload, 5):
            blocks = -(-size // BLOCK_BITS)
            chunk = np.frombuffer(payload, np.uint8, size, at)
            bits = np.frombuffer(payload, np.uint8, blocks * BLOCK_BITS // 8, at + size)
            ranks = np.frombuffer(payload, "<u4", blocks, at + size + len(bits))
            self.levels.append((chunk, bits, ranks))
            at += size + len(bits) + 4 * blocks

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        """The i-th id alone."""
        out = 0
        for k, (chunk, bits, ranks) in enumerate(self.levels):
            out |= int(chunk[i]) << (8 * k)
            byte, bit = divmod(i, 8)
            if not bits[byte] >> bit & 1:
                break
            block = i // BLOCK_BITS
            first = block * BLOCK_BITS // 8
            i = int(ranks[block]) + int(np.bitwise_count(bits[first:byte]).sum()) + int(bits[byte] & (1 << bit) - 1).bit_count()
        return out

    def all(self) -> np.ndarray:
        """Every id."""
        out = None
        for chunk, bits, _ in reversed(self.levels):
            here = chunk.astype(np.uint32)
            if out is not None:
                here[np.unpackbits(bits, count=len(chunk), bitorder="little").astype(bool)] |= out << np.uint32(8)
            out = here
        return out


class Encoder:
    """Ids of whole texts by the tokenizers library.

    The vocabulary's own splitter always starts a new token at a single space between two
    characters that are not white space, so text cut there is encoded piece by piece to the same
    ids; pieces recur, and their ids are kept. The splitter leaves a run of letters whole and cuts
    off a mark that ends it, so such pieces go to the library's merge model directly."""

    CUT = re.compile(r"(?<=\S) (?=\S)")
    ODD = re.compile(r" \s|[^\S ] |^ | $")
    MARKS = ".,;:!?#*$%&|<>()[]{}/\\-_+=@~`^\"'"

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.model._resize_cache(0)  # the pieces are kept here
        self.end = struct.pack("<I", end_id)
        self.newline = struct.pack("<I", self.tokenizer.encode("\n", add_special_tokens=False).ids[0])
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # how the byte-level splitter writes each byte
        split = ByteLevel(add_prefix_space=False, use_regex=False)
        latin = [split.pre_tokenize_str(chr(c))[0][0] for c in range(0x80)]
        high = {b: w for c in range(0x80, 0x800) for b, w in zip(chr(c).encode(), split.pre_tokenize_str(chr(c))[0][0], strict=True)}
        self.written = str.maketrans({chr(b): latin[b] if b < 0x80 else high.get(b, "") for b in range(256)})

    def pieces(self, text: str) -> list[str]:
        """The text cut at single spaces; all but the first piece begin with theirs."""
        first, *rest = self.CUT.split(text) if self.ODD.search(text) else text.split(" ")
        return [first, *[" " + x for x in rest]]

    def by_model(self, word: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.written))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def of(self, piece: str) -> bytes:
        out = self.older.get(piece)
        if out is None:
            out = self.fresh(piece)
        if len(self.known) >= PIECES:
            self.known, self.older = {}, self.known
        self.known[piece] = out
        return out

    def fresh(self, piece: str) -> bytes:
        word = piece[1:] if piece[0] == " " else piece
        if word.isalpha() and max(word) < "\u0250":  # letters of the Latin blocks alone
            return self.by_model(piece)
        body = piece.rstrip(self.MARKS)
        if len(body) < len(piece) and len(body) > 1 and body[1:].isalpha() and (body[0] == " " or body[0].isalpha()) and max(body) < "\u0250":
            return self.some((body, piece[len(body) :]))
        if "\n" in piece:  # a line end between two characters that are not white space is a token
            parts = piece.split("\n")
            if all(parts) and not any(x[0].isspace() for x in parts[1:]) and not any(x[-1].isspace() for x in parts):
                return self.newline.join([self.some((x,)) for x in parts])
        ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def some(self, pieces: tuple[str, ...]) -> bytes:
        return b"".join([i if (i := self.known.get(x)) is not None else self.of(x) for x in pieces])

    def __call__(self, text: str | None) -> bytes:
        """Little-endian 32-bit ids, the end id last."""
        if not text:
            return self.end
        pieces = self.pieces(text)
        ids = list(map(self.known.get, pieces))
        if None in ids:
            known = self.known
            for k, i in enumerate(ids):
                if i is None:
                    x = pieces[k]
                    ids[k] = known.get(x) or self.of(x)
        return b"".join(ids) + self.end


class LineEncoder(Encoder):
    """The same ids with fewer strings made on the way.

    In a text whose only white space is single spaces and line ends between other characters, words are looked up
    without the space before them, a line at a time; other texts take the way of Encoder."""

    OTHER_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
    WORDS = 500_000

    def __init__(self, path: str, end_id: int):
        super().__init__(path, end_id)
        self.spaced: dict[str, bytes] = {}
        self.spaced_older: dict[str, bytes] = {}
        self.space = " ".translate(self.written)

    def after_space(self, word: str) -> bytes:
        out = self.spaced_older.get(word)
        if out is None:
            out = self.new(word)
        if len(self.spaced) >= self.WORDS:
            self.spaced, self.spaced_older = {}, self.spaced
        self.spaced[word] = out
        return out

    def new(self, word: str) -> bytes:
        if word.isascii():
            if word.isalpha():
                return array("I", [t.id for t in self.model.tokenize(self.space + word)]).tobytes()
            body = word.rstrip(self.MARKS)
            if body.isalpha() and len(body) < len(word):  # the splitter cuts off marks that end a word
                marks = word[len(body) :]
                return (self.spaced.get(body) or self.after_space(body)) + (self.known.get(marks) or self.of(marks))
        return self.fresh(" " + word)

    def line(self, line: str) -> bytes:
        words = line.split(" ")
        ids = list(map(self.spaced.get, words))
        ids[0] = self.known.get(words[0]) or self.of(words[0])
        if None in ids:
            for k, i in enumerate(ids):
                if i is None:
                    ids[k] = self.spaced.get(words[k]) or self.after_space(words[k])
        return b"".join(ids)

    def odd(self, text: str) -> bool:
        """Whether there is other white space."""
        return "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[0] in " \n" or text[-1] in " \n" or self.OTHER_SPACE.search(text) is not None

    def __call__(self, text: str | None) -> bytes:
        if not text or self.odd(text):
            return super().__call__(text)
        return self.newline.join(map(self.line, text.split("\n"))) + self.end


def encoder(tokenizer_path: str, end_id: int) -> LineEncoder:
    """The encoder of this Python worker; its tasks share what it remembers."""
    return kept_in_worker(("line encoder", tokenizer_path, end_id), lambda: LineEncoder(tokenizer_path, end_id))


def encode_shards(docs: DataFrame, tokenizer_path: str, end_id: int, doc_id: str = "doc_id", text: str = "text", shard_ids: int = SHARD_IDS) -> DataFrame:
    """Shards of the ids of all texts in ascending order of doc_id: (part, seq) orders them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, end_id)
        part, seq = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        lengths: list[int] = []
        held: list[bytes] = []
        total = 0

        def shard() -> pa.RecordBatch:
            payload = pack(np.frombuffer(b"".join(held), "<u4"))
            return pa.RecordBatch.from_pydict({"part": [part], "seq": [seq], "n_ids": [total], "doc_ids": [ids], "n_tokens": [lengths], "payload": [payload]}, SHARD_SCHEMA)

        for b in batches:
            for i, t in zip(few_at_once(b.column(0)), few_at_once(b.column(1)), strict=True):
                code = encode(t)
                ids.append(i)
                lengths.append(len(code) // 4)
                held.append(code)
                total += len(code) // 4
                if total >= shard_ids:
                    yield shard()
                    seq, ids, lengths, held, total = seq + 1, [], [], [], 0
        if ids:
            yield shard()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order, "text").mapInArrow(released(run, keeps=True), SHARD_DDL)


def read_documents(shards: DataFrame) -> DataFrame:
    """From the shards: doc_id, start, n_tokens and the CRC-32 of each document's ids.

    start counts ids over all shards before: a running sum over partitions, of which there are
    few, then one over the shards of each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in (r for k in range(b.num_rows) for r in b.slice(k, 1).to_pylist()):
                ids = Codes(r["payload"]).all().astype("<u4").tobytes()
                ends = np.cumsum(r["n_tokens"]) * 4
                starts = ends - np.asarray(r["n_tokens"]) * 4
                n = len(starts)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([r["part"]] * n, pa.int32()), "seq": pa.array([r["seq"]] * n, pa.int32()), "doc_id": pa.array(r["doc_ids"], pa.int64()),
                    "at": pa.array(starts // 4, pa.int64()), "n_tokens": pa.array(r["n_tokens"], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(ids[s:e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)], pa.int64()),
                })

    rows = shards.mapInArrow(released(run), "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    meta = shards.select("part", "seq", "n_ids")
    parts = meta.groupBy("part").agg(F.sum("n_ids").alias("n")).withColumn("before", F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)))
    here = F.sum("n_ids").over(W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1))
    base = meta.join(parts.select("part", "before"), "part").select("part", "seq", (F.coalesce("before", F.lit(0)) + F.coalesce(here, F.lit(0))).alias("base"))
    return rows.join(base, ["part", "seq"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
