"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every text.
Expectation-maximisation over the counts of vote patterns (at most 3^8) finds
each labeller's accuracy on good texts and on every kind of bad ones without any
true label, and the posterior of a text's pattern is its soft label.  A hashed linear scorer
(words, word shapes, repeats) is trained on a bounded sample of soft labels and
scores every whole text.

Null counts as empty.  Without any rows all scores are 0.5.  Rows that repeat an id
are judged each by its own text, and however many share one, ``SAMPLE`` rows at most
come to the driver; a score equal to the threshold is kept; texts of any length are
read whole; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quarry.llm.runtime import prepare
from quarry.plans.materialize import materialize

SAMPLE = 6_000         # rows that train the scorer, lowest id hashes
BITS = 16              # hashed features
STEPS = 60
GOOD, BAD, NONE = "1", "0", "-"
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
_UPPER = bytes(range(65, 91))
_SYMBOLS = bytes(b for b in range(33, 127) if not chr(b).isalpha())
_PLAIN = _LETTERS + b"0123456789 \t\n\r\x0b\x0c"


def _vote(value: float, good: float, bad: float) -> str:
    """Good below ``good``, bad above ``bad``, nothing between."""
    return GOOD if value < good else BAD if value > bad else NONE


def votes(text: str) -> str:
    """One character per labeller: word variety, words repeated in a row,
    symbols, capitals, repeated lines, symbols a word, tokens of symbols,
    length."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    if not n:
        return NONE * 7 + BAD
    size = len(raw)
    letters = size - len(raw.translate(None, _LETTERS))
    capitals = size - len(raw.translate(None, _UPPER))
    symbols = len(raw.translate(None, _PLAIN))
    kinds = set(words)
    repeats = sum(map(bytes.__eq__, words[1:], words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    odd = {w for w in kinds if len(w.translate(None, _PLAIN)) >= 3 or not w.translate(None, _SYMBOLS)}
    bare = sum(w in odd for w in words)
    return "".join((
        _vote(1 - len(kinds) / n, 0.65, 0.8) if n >= 20 else NONE,
        _vote(repeats / n, 0.03, 0.2) if n >= 5 else NONE,
        _vote(symbols / size, 0.05, 0.08),
        _vote(capitals / max(letters, 1), 0.15, 0.4) if letters >= 10 else NONE,
        _vote(1 - len(set(lines)) / len(lines), 0.1, 0.3) if len(lines) >= 3 else NONE,
        _vote(symbols / n, 0.35, 0.6) if n >= 5 else NONE,
        _vote(bare / n, 0.05, 0.15) if n >= 5 else NONE,
        _vote(-n, -50, -3)))


#: Kinds of bad text the labellers look for; each starts from its labellers.
KINDS = ((0, 1, 4), (2, 5, 6), (3,), (7,))


@dataclass
class LabelModel:
    """Class shares (good first, then the kinds of bad) and, for each class and
    labeller, the probability that a vote says bad."""

    share: np.ndarray
    says_bad: np.ndarray

    def classes(self, pattern: str) -> np.ndarray:
        bad, good = (np.array([v == w for v in pattern], float) for w in (BAD, GOOD))
        z = np.log(self.share) + np.log(self.says_bad) @ bad + np.log(1 - self.says_bad) @ good
        p = np.exp(z - z.max())
        return p / p.sum()

    def posterior(self, pattern: str) -> float:
        """Probability that a text with these votes is good."""
        return float(self.classes(pattern)[0])


def estimate_accuracies(patterns: dict[str, int], rounds: int = 200) -> LabelModel:
    """Expectation-maximisation over pattern counts.  A labeller starts right
    four times in five on good texts and on its kind of bad ones, and says good
    nine times in ten on other kinds; two counts of prior each keep every
    probability inside (0, 1)."""
    width = max([j for kind in KINDS for j in kind]) + 1
    start = np.full((1 + len(KINDS), width), 0.1)
    for c, kind in enumerate(KINDS, 1):
        start[c, list(kind)] = 0.8
    start[0] = 0.05
    model = LabelModel(np.array([0.8] + [0.2 / len(KINDS)] * len(KINDS)), start)
    names = sorted(patterns)
    k = np.array([patterns[p] for p in names], float)
    bad, good = (np.array([[v == w for v in p] for p in names], float).reshape(len(names), width) for w in (BAD, GOOD))
    for _ in range(rounds if names else 0):
        q = np.array([model.classes(p) for p in names]) * k[:, None]
        new = LabelModel((q.sum(0) + 1) / (k.sum() + len(start)), (q.T @ bad + 2 * start) / (q.T @ (bad + good) + 2))
        change = max(np.abs(new.share - model.share).max(), np.abs(new.says_bad - model.says_bad).max())
        model = new
        if change < 1e-7:
            break
    return model


def _shape_table() -> np.ndarray:
    kinds = np.arange(256)
    kinds[65:91] = 1
    kinds[97:123] = 2
    kinds[128:] = 2
    kinds[48:58] = 3
    return kinds


_SHAPE = _shape_table()


def hashed_tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of the block's words, end to end (word, shape of first
    and last letters, repeat of the word before), and word offsets."""
    from quarry.llm.words import mix64, words_of

    block = words_of(texts, lower=True)
    mask = np.uint64((1 << BITS) - 1)
    if not len(block.hashes):
        return np.zeros((0, 3), np.int64), block.first
    ends = [_SHAPE[block.data[i]].astype(np.uint64) for i in (
        block.start, np.minimum(block.start + 1, block.end - 1), np.maximum(block.end - 2, block.start), block.end - 1)]
    shape = ends[0] | ends[1] << np.uint64(8) | ends[2] << np.uint64(16) | ends[3] << np.uint64(24)
    shape |= np.minimum(block.end - block.start, 20).astype(np.uint64) << np.uint64(32)
    same = np.zeros(len(block.hashes), np.uint64)
    same[1:] = block.hashes[1:] == block.hashes[:-1]
    same[block.first[:-1][np.diff(block.first) > 0]] = 0
    parts = (mix64(block.hashes), mix64(shape + np.uint64(1 << 40)), mix64(same + np.uint64(1 << 50)))
    return np.column_stack([(p & mask).astype(np.int64) for p in parts]), block.first


def _votes_fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from quarry.llm.quality import votes
    from quarry.llm.words import text_blocks

    for batch in batches:
        for at, texts in text_blocks(batch.column(1)):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, len(texts)), pa.array([votes(t) for t in texts.to_pylist()], pa.string())],
                names=["doc_id", "votes"])


def _sample_fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to their votes and sparse rows: feature numbers and shares of the
    words, as bytes."""
    from quarry.llm.quality import hashed_tokens, votes
    from quarry.llm.words import text_blocks

    for batch in batches:
        for _, texts in text_blocks(batch.column(0)):
            tokens, first = hashed_tokens(texts)
            at_rows, shares = [], []
            for a, b in zip(first[:-1], first[1:], strict=True):
                kinds, k = np.unique(tokens[a:b], return_counts=True)
                at_rows.append(kinds.astype(np.int32).tobytes())
                shares.append((k / max(b - a, 1)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([votes(t) for t in texts.to_pylist()], pa.string()), pa.array(at_rows, pa.binary()), pa.array(shares, pa.binary())],
                names=["votes", "at", "share"])


def train_scorer(rows, targets: np.ndarray) -> np.ndarray:
    """Logistic weights (the last is the base) by full gradient steps with
    per-weight scaling."""
    w, seen = np.zeros((1 << BITS) + 1), np.full((1 << BITS) + 1, 1e-6)
    if not len(rows):
        return w
    own = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    at, share = (np.concatenate([np.asarray(r[i]) for r in rows]) for i in (0, 1))
    at = at.astype(np.int64)
    for _ in range(STEPS):
        z = np.bincount(own, weights=w[at] * share, minlength=len(rows)) + w[-1]
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - targets
        grad = np.bincount(at, weights=error[own] * share, minlength=len(w)) / len(rows)
        grad[-1] = error.mean()
        grad += 1e-7 * w
        seen += grad ** 2
        w -= 0.5 * grad / np.sqrt(seen)
    return w


def _score_fn(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quarry.llm.quality import hashed_tokens, votes
        from quarry.llm.words import text_blocks

        weights, label = shared.value
        known: dict[str, float] = {}
        for batch in batches:
            for at, texts in text_blocks(batch.column(1)):
                tokens, first = hashed_tokens(texts)
                sums = np.concatenate(([0.0], np.cumsum(weights[tokens].sum(1))))
                n = np.diff(first)
                z = (sums[first[1:]] - sums[first[:-1]]) / np.maximum(n, 1) + weights[-1]
                pattern = [votes(t) for t in texts.to_pylist()]
                for p in set(pattern) - known.keys():
                    known[p] = label.posterior(p)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(pattern, pa.string()),
                     pa.array([known[p] for p in pattern], pa.float64()),
                     pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))],
                    names=["doc_id", "votes", "weak_label", "score"])
    return run


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Per row: doc_id, votes, weak_label (posterior of good), score and kept
    (score of at least ``threshold``)."""
    spark = docs.sparkSession
    prepare(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    voted = rows.mapInArrow(_votes_fn, f"doc_id {kind}, votes string")
    patterns = {r.votes: r["count"] for r in voted.groupBy("votes").count().collect()}  # at most 3^8
    label = estimate_accuracies(patterns)
    picked, _ = materialize(rows.select("doc_id").dropDuplicates()
                            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE), "sample")
    sample = rows.join(F.broadcast(picked), "doc_id")
    # bounded in rows, however many of them share an id: the sparse rows fit the driver
    seen = sorted((r.votes, bytes(r.at), bytes(r.share)) for r in
                  sample.select("text").mapInArrow(_sample_fn, "votes string, at binary, share binary")
                  .orderBy(F.xxhash64("at", "share"), "votes").limit(SAMPLE).toLocalIterator())
    weights = train_scorer([(np.frombuffer(a, np.int32), np.frombuffer(s)) for _, a, s in seen],
                           np.array([label.posterior(v) for v, _, _ in seen]))
    shared = spark.sparkContext.broadcast((weights, label))
    return (rows.mapInArrow(_score_fn(shared), f"doc_id {kind}, votes string, weak_label double, score double")
            .withColumn("kept", F.col("score") >= threshold))
