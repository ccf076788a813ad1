"""Quality by weak supervision.

Every document is measured (words, symbols, repeated lines and windows, letters, case, sentence
ends, vocabulary). Each rule reads the measures and votes good (1), bad (-1) or abstains (0).
Expectation-maximisation estimates each rule's accuracy for good and for bad documents, and how
many documents are good, without labels; the posterior probability of good replaces a filter that
all rules must pass. Votes meet the estimation as counts of vote patterns, of which there are at
most 3 ** len(RULES), so its cost doesn't depend on the number of documents.

Cases: a null text has no words, and like an empty one fails the base test; rules abstain where a
measure is undefined; very long texts are measured whole; repeated rows each get a row and each
count in the estimation; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.llm.common import Shared, WordHashes, ngram_hashes

#: Symbols of the base measure; the contract fixes them.
SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
WINDOW = 8
ROUNDS = 100

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_end_lines", "n_distinct", "n_upper", "n_letters", "n_exclaims"]
SCHEMA = pa.schema([("doc_id", pa.int64()), *((m, pa.int64()) for m in MEASURES)])


def repeat_words(h: np.ndarray, window: int = WINDOW) -> int:
    """Words inside any window that the text holds twice or more."""
    if len(h) <= window:
        return 0
    _, where, counts = np.unique(ngram_hashes(h, window), return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[where] > 1)
    edges = np.zeros(len(h) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges) > 0).sum())


def measure(text: str, hashes: WordHashes) -> tuple[int, ...]:
    words = text.encode("utf-8", "surrogatepass").split()
    h = hashes.of(words)
    seen: set[str] = set()
    lines = dup = ends = 0
    for line in text.split("\n"):
        if not (core := line.strip(SPACE)):
            continue
        lines += 1
        ends += core[-1] in ".!?:;\"'”"
        if line in seen:
            dup += 1
        else:
            seen.add(line)
    lower = text.lower()
    upper = sum(map(str.isupper, text)) if lower != text else 0
    letters = len(text) - sum(map(text.count, SPACE)) - sum(map(text.count, "0123456789.,;:!?'\"()[]{}/\\-_+=@~`^" + SYMBOLS))
    return (len(words), len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)), dup, repeat_words(h), lines, ends, len(np.unique(h)), upper, letters, text.count("!"))


def measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the MEASURES of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            rows = [measure(t or "", hashes) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(len(MEASURES)))], schema=SCHEMA)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))


def vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def share(a: str, b: str) -> Column:
    return F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))


def rules() -> dict[str, Column]:
    """Each rule's name and vote."""
    n = F.col("n_words")
    return {
        "length": vote((n >= 40) & (n <= 100_000), n < 20),
        "word_length": vote(share("word_chars", "n_words").between(3, 10), (share("word_chars", "n_words") < 2.5) | (share("word_chars", "n_words") > 14)),
        "symbols": vote(share("n_symbols", "n_words") < 0.05, share("n_symbols", "n_words") > 0.2),
        "repeated_lines": vote(share("n_dup_lines", "n_lines") < 0.1, share("n_dup_lines", "n_lines") > 0.3),
        "repeated_windows": vote(share("n_repeat_words", "n_words") < 0.1, share("n_repeat_words", "n_words") > 0.25),
        "letters": vote(share("n_letters", "word_chars") > 0.85, share("n_letters", "word_chars") < 0.7),
        "case": vote(share("n_upper", "n_letters") < 0.15, share("n_upper", "n_letters") > 0.4),
        "sentence_ends": vote(share("n_end_lines", "n_lines") >= 0.5, (F.col("n_lines") >= 3) & (share("n_end_lines", "n_lines") < 0.1)),
        "vocabulary": vote((n >= 40) & (share("n_distinct", "n_words") > 0.25), (n >= 40) & (share("n_distinct", "n_words") < 0.08)),
        "exclaims": vote(share("n_exclaims", "n_words") < 0.05, share("n_exclaims", "n_words") > 0.3),
    }


VOTES = (-1, 0, 1)


def estimate(patterns: list[tuple[list[int], int]], rounds: int = ROUNDS) -> tuple[float, np.ndarray]:
    """Share of good documents, and P(vote | class) for each rule, vote of VOTES and class (bad, good).

    The accuracy of a rule is thus known for each class and each vote apart, so a vote that good
    documents hardly ever get weighs much. A document without bad votes starts as good with 0.9,
    one with half or more bad votes as bad, so the first class stays the bad one; a prior of a few
    documents keeps every vote possible."""
    k = len(patterns[0][0])
    v = np.array([p for p, _ in patterns])
    c = np.array([n for _, n in patterns], float)
    on = np.stack([v == x for x in VOTES], axis=2).astype(float)
    bad = (v < 0).sum(axis=1) / np.maximum(1, (v != 0).sum(axis=1))
    p = np.clip(0.9 - 1.6 * bad, 0.1, 0.9)
    prior, table = 0.8, np.zeros((k, len(VOTES), 2))
    for _ in range(rounds):
        weight = np.stack([c * (1 - p), c * p], axis=1)
        # two documents of each class that vote at random, one more that votes as its class should
        table_new = np.einsum("njv,nc->jvc", on, weight) + 2 / 3
        table_new[:, 0, 0] += 1
        table_new[:, 2, 1] += 1
        table_new /= table_new.sum(axis=1, keepdims=True)
        prior_new = float(np.clip((weight[:, 1].sum() + 4) / (c.sum() + 5), 0.02, 0.98))
        done = abs(prior_new - prior) + np.abs(table_new - table).max() < 1e-9
        prior, table = prior_new, table_new
        p = posterior(v, prior, table)
        if done:
            break
    return prior, table


def log_odds(table: np.ndarray) -> np.ndarray:
    """What each rule's vote adds to the log odds of good."""
    return np.log(table[:, :, 1] / table[:, :, 0])


def posterior(v: np.ndarray, prior: float, table: np.ndarray) -> np.ndarray:
    adds = log_odds(table)
    odds = math.log(prior / (1 - prior)) + adds[np.arange(v.shape[1])[None, :], v + 1].sum(axis=1)
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def judge(docs: DataFrame, threshold: float = 0.5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Measures, votes, posterior, base_failed and kept of every row."""
    named = rules()
    measured = Shared(docs.sparkSession).write(measures(docs, doc_id, text))
    voted = measured.withColumn("votes", F.array(*named.values()))
    patterns = [(list(r.votes), r["count"]) for r in voted.groupBy("votes").count().collect()]  # 3 ** len(RULES) at most
    prior, adds = 0.8, np.zeros((len(named), len(VOTES)))
    if patterns:
        prior, learned = estimate(sorted(patterns))
        adds = log_odds(learned)
    odds = F.lit(math.log(prior / (1 - prior)))
    for i, (bad, none, good) in enumerate(adds.tolist()):
        v = F.col("votes")[i]
        odds = odds + F.when(v < 0, bad).when(v > 0, good).otherwise(none)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    out = voted.withColumn("quality", 1 / (1 + F.exp(-odds))).withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
