"""Shared pieces: table reading, shared-folder tables, word splitting and word hashing."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of bytes other than ASCII white space; bytes.split() cuts exactly there.
#: The other kind of word keeps ASCII letters, digits and everything beyond ASCII.
_SEPARATORS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))
WORD_CACHE = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, else one of our own if this machine is all there is."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spanforge-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


class Shared:
    """Tables written to the shared folder: they cut lineage and outlive any executor."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{shared_dir(spark)}/spanforge-{uuid.uuid4().hex}"
        self.n = 0

    def write(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._shared_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a table that nothing will read again."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._shared_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


#: A membership filter has 2**FILTER_BITS slots at most: 16 MB in the driver and each worker.
FILTER_BITS = 27


class Membership:
    """Which of many uniform 64-bit hashes may be among those it was made of: never a false no, some false yes.

    Its size is bounded; with more hashes than slots it lets more and in the end all through, so it
    may only save work in front of an exact step."""

    def __init__(self, bits: np.ndarray, shift: int):
        self.bits, self.shift = bits, np.uint64(shift)

    def test(self, h: np.ndarray) -> np.ndarray:
        slot = h.view(np.uint64) >> self.shift
        return (self.bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def membership(hashes: DataFrame, column: str):
    """A broadcast Membership of the uniform hashes in a column of a written table."""
    k = min(FILTER_BITS, max(12, (16 * hashes.count()).bit_length()))
    slot = hashes.select(F.shiftrightunsigned(column, 64 - k).alias("slot"))
    words = slot.select(F.shiftright("slot", 6).alias("w"), F.expr("shiftleft(1L, cast(slot & 63 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()  # 2**(FILTER_BITS - 6) rows at most
    bits = np.zeros(1 << (k - 6), np.uint64)
    bits[words.column("w").to_numpy()] = words.column("b").to_numpy().view(np.uint64)
    return hashes.sparkSession.sparkContext.broadcast(Membership(bits, 64 - k))


#: Rows of a key from which a join deals them out, or a thousandth of all rows if that is more.
HOT_ROWS = 1_000


def hot_join(big: DataFrame, small: DataFrame, on: str, how: str = "inner", counted: DataFrame | None = None, total: int | None = None) -> DataFrame:
    """big.join(small, on, how), where one key may hold any share of big, a written table.

    small has a row a key. Keys of more than HOT_ROWS rows and a thousandth of all, which are a
    thousand at most, get as many salts as they need, and their rows of small are repeated. counted is
    a written table with the count of each key of more than HOT_ROWS rows, total the rows of big, where they are known."""
    limit = max(HOT_ROWS, (big.count() if total is None else total) // 1000)
    counts = big.groupBy(on).count() if counted is None else counted
    hot = counts.where((F.col("count") > limit) & F.col(on).isNotNull()).select(on, F.ceil(F.col("count") / limit).cast("int").alias("salts"))
    rows = hot.collect()
    if not rows:
        return big.join(small, on, how)
    salts = F.broadcast(big.sparkSession.createDataFrame(rows, hot.schema))
    dealt = big.join(salts, on, "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64(*big.columns), "salts"), F.lit(0).cast("long")))
    many = small.join(salts, on, "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), (F.coalesce("salts", F.lit(1)) - 1).cast("long"))))
    return dealt.drop("salts").join(many.drop("salts"), [on, "salt"], how).drop("salt")


#: Columns that tell the rows of a table apart, whatever they hold, begin so.
ROW = "spanforge_row"


def numbered(docs: DataFrame, shared: Shared) -> tuple[DataFrame, list[str]]:
    """docs with two such columns, and their names: the file and the place in it; a table that is not read from Parquet is written first."""
    name = ROW
    while any(c.lower().startswith(name) for c in docs.columns):
        name += "_"
    try:
        at = docs.metadataColumn("_metadata")
        return docs.withColumns({f"{name}_file": at["file_path"], f"{name}_place": at["row_index"]}), [f"{name}_file", f"{name}_place"]
    except AnalysisException:
        return numbered(shared.write(docs), shared)


def space_words(text: str) -> list[bytes]:
    """Words of `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def alnum_words(text: str) -> list[bytes]:
    """Words of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z."""
    return text.encode("utf-8", "surrogatepass").lower().translate(_SEPARATORS).split()


def kept_in_worker(key: tuple, make: Callable):
    """What make() returned the first time in this Python process; Spark uses a process for many tasks."""
    state = sys.modules.setdefault("_spanforge_kept", types.ModuleType("_spanforge_kept")).__dict__
    if key not in state:
        state[key] = make()
    return state[key]


def forget_kept() -> None:
    """Drop what kept_in_worker has kept: for tasks of another kind, which the process may run next."""
    sys.modules.pop("_spanforge_kept", None)


#: Rows of a batch whose texts are Python strings at a time.
ROWS_AT_ONCE = 256


def few_at_once(column: pa.Array) -> Iterator:
    """The values of a column in Python, those of a few rows at a time: a batch may hold all texts of a task."""
    for at in range(0, len(column), ROWS_AT_ONCE):
        yield from column.slice(at, ROWS_AT_ONCE).to_pylist()


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run in a process that gives back the memory of other tasks first, unless run needs what they kept, and Arrow's free memory at the end."""

    def all_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            forget_kept()
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return all_of


class WordHashes(dict):
    """Word bytes to 64-bit hashes, remembered up to WORD_CACHE words at a time."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > WORD_CACHE:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n consecutive words; of all words where there are fewer than n."""
    n = min(n, len(h))
    if not n:
        return h
    out = mix(h[: len(h) - n + 1] + np.uint64(n))
    for i in range(1, n):
        out = mix(out * _STEP + h[i : len(h) - n + 1 + i])
    return out


class Powers:
    """Powers of an odd number modulo 2**64 and their inverses, as many as were asked for so far."""

    def __init__(self, base: int):
        self.base, self.back = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def first(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            steps = np.ones((2, max(n, 1 << 12)), np.uint64)
            steps[0, 1:], steps[1, 1:] = self.base, self.back
            self.up, self.down = np.multiply.accumulate(steps, axis=1)
        return self.up[:n], self.down[:n]


#: Odd numbers that are 3 modulo 8, so that no short sequence of differences vanishes.
_OF_BYTES, _OF_WORDS = Powers(0x9E3779B97F4A7C1B), Powers(0xD6E8FEB86659FD93)
#: Bytes of a text that are hashed at a time.
TEXT_AT_ONCE = 1 << 20


def _byte_values(separates: Callable[[int], bool]) -> np.ndarray:
    values = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    values[65:91] = values[97:123]
    values[[b for b in range(256) if separates(b)]] = 0
    return values


_SPACE_VALUES = _byte_values(lambda b: b == 0x20 or 0x09 <= b <= 0x0D)
_ALNUM_VALUES = _byte_values(lambda b: b < 0x80 and not chr(b).isalnum())


def _hashes(text: str, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a text, where its words begin, and their hashes, A-Z as a-z."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    starts, hashes, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + TEXT_AT_ONCE)
        v = values[data[at:end]]
        while end < len(data) and v[-1]:  # on to the end of the word
            more = values[data[end : end + TEXT_AT_ONCE]]
            gap = np.flatnonzero(more == 0)
            v = np.concatenate([v, more[: gap[0] + 1] if len(gap) else more])
            end = at + len(v)
        solid = np.zeros(len(v) + 2, bool)
        solid[1:-1] = v != 0
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        a, e = edges[::2], edges[1::2]
        up, down = _OF_BYTES.first(len(v))
        total = np.concatenate([[np.uint64(0)], np.cumsum(v * up)])
        starts.append(a + at)
        hashes.append(mix((total[e] - total[a]) * down[a] + (e - a).astype(np.uint64)) if len(a) else np.zeros(0, np.uint64))
        at = end
    if len(starts) == 1:
        return data, starts[0], hashes[0]
    return data, np.concatenate([np.zeros(0, np.int64), *starts]), np.concatenate([np.zeros(0, np.uint64), *hashes])


def space_hashes(text: str) -> np.ndarray:
    """Hashes of the words of space_words."""
    return _hashes(text, _SPACE_VALUES)[2]


def alnum_hashes(text: str) -> np.ndarray:
    """Hashes of the words of alnum_words."""
    return _hashes(text, _ALNUM_VALUES)[2]


def line_hashes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of space_words, and how many of them each line has."""
    data, starts, h = _hashes(text, _SPACE_VALUES)
    ends = np.searchsorted(starts, np.append(np.flatnonzero(data == 10), len(data)))
    return h, np.diff(ends, prepend=0)


class Runs:
    """Hashes of runs of consecutive words."""

    def __init__(self, h: np.ndarray):
        up, self.down = _OF_WORDS.first(len(h))
        self.total = np.concatenate([[np.uint64(0)], np.cumsum(h * up)])

    def of(self, n: int) -> np.ndarray:
        """A hash of every n words; none where there are fewer."""
        size = len(self.total) - n
        if size <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.total[n:] - self.total[:size]) * self.down[:size] + np.uint64(n))


def columns(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[list, ...]]:
    """The named columns of each batch as Python lists."""
    for b in batches:
        yield tuple(b.column(b.schema.get_field_index(n)).to_pylist() for n in names)


def per_row(make: Callable[[], Callable[..., tuple]], names: list[str], schema: pa.Schema):
    """A mapInArrow function that turns the named columns of each row into one output row.

    make is called once in each task, so what it prepares is shared by the task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for cols in columns(batches, *names):
            rows = [one(*r) for r in zip(*cols, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)] if rows else [pa.array([], f.type) for f in schema], schema=schema)

    return run


def with_longs(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("long") for n in names})
