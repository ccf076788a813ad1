"""Language by cross-parsing entropy.

For every language a suffix automaton of labelled sample text is built. A text is parsed against
it into phrases, each the longest stretch that occurs in the sample (a letter that never occurs
is a phrase of its own); the number of phrases, times the log of the sample's size, over the
text's length estimates the cross entropy, and the language with the least wins.

The automaton is completed: where no transition goes on, a new phrase begins, which the
transition itself notes. So parsing is one table lookup a character, and a task parses thousands
of blocks of BLOCK characters in step. A block is first parsed as if a phrase began with it, then again
from the state that the block before it ended in, until no block's first state changes: what comes out
is the parse of the whole text, phrase by phrase. All letters of the samples are told apart. A
language whose sample holds more than DENSE of them, as with Han, has a sorted list of its transitions
in place of the table, which is slower but of the sample's size.

The fit reads at most DOCS documents a language and CHARS characters a language, fewer where there
are so many languages that TOTAL would be passed, but LEAST at least. The documents are chosen by hash
among rows that may be learned from, and so is the place of the characters that are taken from a long
one. Every value of lang is learned. Every text is predicted from all of its characters. Letters
are lower-cased, and what is not a letter counts as one space.

Cases: a null text, or one without a letter, is `und` with score 0; null languages are never
learned; rows with a null id are not learned from and not held out; with nothing learned all
texts are `und`; ties go to the language that sorts first; very long texts are parsed whole; repeated
rows each get a row; an empty table gives an empty result; other columns, whatever their names, are
ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DOCS = 64
CHARS = 24_000
TOTAL = 240_000
LEAST = 2_000
#: Letters of a sample up to which its automaton is a table.
DENSE = 94
BLOCK = 512
#: Characters of text that a task parses at a time.
AT_ONCE = 4_000_000

SPACE, OTHER = 0, 1


class Alphabet:
    """Code points to classes: 0 for what is not a letter, 1 for letters that no sample holds."""

    def __init__(self, letters: str):
        self.letters = letters
        self.lookup = np.zeros(0x110000, np.min_scalar_type(len(letters) + 2))
        for block in range(0, 0x110000, 0x10000):
            if block > 0x30000:
                break
            self.lookup[block : block + 0x10000] = [OTHER if chr(c).isalpha() else SPACE for c in range(block, block + 0x10000)]
        for i, c in enumerate(letters):
            self.lookup[ord(c)] = i + 2
        for c in letters:
            for up in {c.upper(), c.title()}:
                if len(up) == 1:
                    self.lookup[ord(up)] = self.lookup[ord(c)]

    @property
    def size(self) -> int:
        return len(self.letters) + 2

    def classes(self, text: str) -> tuple[np.ndarray, bool]:
        """Classes of a text, runs of spaces as one, and whether it has a letter."""
        codes = self.lookup[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        solid = codes != SPACE
        keep = solid.copy()
        keep[1:] |= solid[:-1]
        return codes[keep], bool(solid.any())


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of every state of the suffix automaton; state 0 is the start."""
    move: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in codes:
        here = len(move)
        move.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in move[p]:
            move[p][c] = here
            p = link[p]
        if p >= 0:
            q = move[p][c]
            if length[p] + 1 == length[q]:
                link[here] = q
            else:
                twin = len(move)
                move.append(dict(move[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and move[p].get(c) == q:
                    move[p][c] = twin
                    p = link[p]
                link[q] = link[here] = twin
        last = here
    return move


NEW = 1 << 30


def completed(move: list[dict[int, int]], size: int) -> np.ndarray:
    """The automaton as a table, flat: state * (size + 1) + class to the next state, with NEW set where
    a phrase begins. The last state has read nothing of the current phrase; class `size` is padding."""
    n = len(move)
    table = np.full((n + 1, size + 1), -1, np.int32)
    for s, row in enumerate(move):
        for c, to in row.items():
            table[s, c] = to
    first = np.where(table[0, :size] < 0, n, table[0, :size]) | NEW
    table[:, :size] = np.where(table[:, :size] < 0, first[None, :], table[:, :size])
    table[n, :size] = first
    table[:, size] = np.arange(n + 1)
    return table.ravel()


class Sparse:
    """The same automaton as a sorted list of transitions, for alphabets that make the table too large."""

    def __init__(self, move: list[dict[int, int]], size: int):
        self.size = size
        moves = sorted((s * size + c, to) for s, row in enumerate(move) for c, to in row.items())
        self.keys = np.array([k for k, _ in moves] + [np.iinfo(np.int64).max], np.int64)
        self.to = np.array([to for _, to in moves] + [0], np.int32)
        self.first = np.full(size, len(move) | NEW, np.int32)
        for c, to in move[0].items():
            self.first[c] = to | NEW

    def step(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        key = state.astype(np.int64) * self.size + c
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.to[at], self.first[c])


class Dense:
    def __init__(self, move: list[dict[int, int]], size: int):
        self.width, self.table = size + 1, completed(move, size)

    def step(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        return self.table[state * self.width + c]


def lower(c: str) -> str:
    """A letter in lower case, itself where that is not one letter."""
    low = c.lower()
    return low if len(low) == 1 else c


class Model:
    def __init__(self, samples: dict[str, str]):
        """samples: sample text by language."""
        self.languages = sorted(samples)
        seen = Counter(lower(c) for t in samples.values() for c in t if c.isalpha())
        self.alphabet = Alphabet("".join(c for c, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))))
        self.automata, self.own, self.starts, self.bits = [], [], [], []
        for lang in self.languages:
            codes, _ = self.alphabet.classes(samples[lang])
            size, own = self.alphabet.size, None
            if size > DENSE + 2:
                # the sample's own letters, numbered anew; the others are one class that matches nothing
                held = np.unique(codes[codes > OTHER])
                own = np.full(size, OTHER, np.int32)
                own[SPACE], own[held], size = SPACE, np.arange(2, len(held) + 2), len(held) + 2
            move = suffix_automaton((codes if own is None else own[codes]).tolist())
            self.automata.append((Dense if size <= DENSE + 2 else Sparse)(move, size))
            self.own.append(own)
            self.starts.append(len(move))
            self.bits.append(math.log2(max(2, len(codes))))

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (as classes) by each language."""
        sizes = np.array([len(t) for t in texts])
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        ends = np.cumsum(blocks)
        place = np.arange(len(owner)) - np.repeat(ends - blocks, blocks)
        length = np.minimum(BLOCK, sizes[owner] - place * BLOCK)
        at = np.repeat(np.cumsum(sizes) - sizes, blocks) + place * BLOCK
        last = np.ones(len(owner), bool)
        last[:-1] = owner[1:] != owner[:-1]
        flat = np.concatenate([*texts, np.zeros(BLOCK, np.uint8)])
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        for k, (automaton, own) in enumerate(zip(self.automata, self.own, strict=True)):
            first = np.full(len(owner), self.starts[k], np.int32)
            end, count = first.copy(), np.zeros(len(owner), np.int32)
            todo = np.arange(len(owner))
            while len(todo):
                todo = todo[np.argsort(-length[todo], kind="stable")]
                state, n = self.parse(automaton, own, flat, at[todo], length[todo], first[todo])
                end[todo], count[todo] = state, n
                todo = todo[~last[todo]] + 1
                todo = todo[first[todo] != end[todo - 1]]
                first[todo] = end[todo - 1]
            out[:, k] = np.bincount(owner, count, len(texts))
        return out

    @staticmethod
    def parse(automaton, own: np.ndarray | None, flat: np.ndarray, at: np.ndarray, length: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last states and phrases begun of some stretches, the longest first, from given states."""
        state, count = state.copy(), np.zeros(len(at), np.int32)
        alive = np.searchsorted(-length, -np.arange(length[0]), side="left")  # stretches longer than t
        for t, n in enumerate(alive.tolist()):
            c = flat[at[:n] + t].astype(np.int32)
            to = automaton.step(state[:n], c if own is None else own[c])
            count[:n] += to >> 30
            state[:n] = to & (NEW - 1)
        return state, count

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        codes = [self.alphabet.classes(t or "") for t in texts]
        named, scores = ["und"] * len(texts), [0.0] * len(texts)
        todo = [i for i, (_, letter) in enumerate(codes) if letter] if self.languages else []
        group: list[int] = []
        held = 0
        for i in [*todo, None]:
            if i is not None:
                group.append(i)
                held += len(codes[i][0])
            if group and (i is None or held >= AT_ONCE):
                n = np.array([len(codes[j][0]) for j in group])
                entropy = self.phrases([codes[j][0] for j in group]) * np.array(self.bits) / n[:, None]
                best = entropy.argmin(axis=1)
                two = np.partition(entropy, 1, axis=1)[:, :2] if entropy.shape[1] > 1 else np.stack([entropy[:, 0], np.full(len(group), np.inf)], axis=1)
                for j, b, (x, y) in zip(group, best.tolist(), two.tolist(), strict=True):
                    named[j], scores[j] = self.languages[b], 1 - x / y if y > 0 else 0.0
                group, held = [], 0
        return named, scores


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, may_learn: Column) -> dict[str, str]:
    """Sample text by language; DOCS, CHARS, TOTAL and LEAST bound what reaches the driver of each."""
    rows = docs.where(may_learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    picks = rows.groupBy("lang", F.pmod("h", F.lit(DOCS)).alias("slot")).agg(F.min("h").alias("h")).select("lang", "h").collect()
    if not picks:
        return {}
    chars = min(CHARS, max(LEAST, TOTAL // len({r.lang for r in picks})))
    chosen = docs.sparkSession.createDataFrame(picks, "lang string, h long")
    size = chars // 8
    start = F.pmod(F.xxhash64("h"), F.greatest(F.length("text") - size, F.lit(0)) + 1).cast("int") + 1
    texts = rows.join(F.broadcast(chosen), ["lang", "h"]).select("lang", "h", F.substring("text", start, F.lit(size)).alias("text")).distinct().collect()  # DOCS a language
    out: dict[str, str] = {}
    for r in sorted(texts, key=lambda r: (r.lang, r.h, r.text)):
        if len(have := out.get(r.lang, "")) < chars:
            out[r.lang] = (have + " " + r.text)[:chars]
    return out


def identify(docs: DataFrame, samples: dict[str, str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every row, from the text alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(samples)
        for b in batches:
            named, scores = model.predict(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(named, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")
