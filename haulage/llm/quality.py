"""Text quality from overlapping heuristic labellers, without labels.

1. Each labeller votes good, bad or nothing on every document.
2. Expectation-maximisation over the counts of all vote patterns (at most
   3 ** labellers, whatever the corpus) estimates the share of good documents
   and how often each labeller is right; that gives every pattern a posterior.
3. A linear scorer on hashed 4-byte grams is fitted to the posteriors of at most
   ``max_sample`` unlike documents of together ``MAX_SAMPLE_BYTES``, in an order fixed by a
   hash, and scores all of them.

Votes and posteriors cover all rows; only the scorer's fit uses a sample.

Defined results: null or empty text gets bad votes from the labellers that
count words and is scored like any text; repeated rows score alike; null doc_id
is kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from haulage.llm.storing import stored
from haulage.llm.words import byte_grams, chunks, flat, mix, words_of

GRAM = 4
BITS = 15
MAX_SAMPLE = 4000
MAX_SAMPLE_BYTES = 1 << 26
EPOCHS = 6
STEP = 0.5
ROUNDS = 100
PRIOR = 0.1
MOST_WRONG = 0.0005

#: Order of the votes in a pattern.
LABELLERS = ("capitals", "marks", "digits", "repeated_words", "repeated_lines", "word_length", "stops", "length")

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[65:91] = 1
_KIND[97:123] = 2
_KIND[48:58] = 3
_KIND[[33, 35, 36, 37, 38, 42, 43, 47, 60, 61, 62, 64, 91, 92, 93, 94, 95, 96, 123, 124, 125, 126]] = 4
_KIND[128:] = 2
_STOP = np.isin(np.arange(256), [46, 63, 10])


def _share(top: np.ndarray, of: np.ndarray) -> np.ndarray:
    return top / np.maximum(of, 1)


def _vote(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    return np.where(bad, 0, np.where(good, 1, 2)).astype(np.int8)


def votes(column: pa.Array) -> np.ndarray:
    """A row per text, a column per labeller: 1 good, 0 bad, 2 no vote."""
    data, starts = flat(column)
    out = []
    for chunk in words_of(column):
        a, b = starts[chunk.first], starts[chunk.last]
        part, bounds = data[a:b], starts[chunk.first : chunk.last + 1] - a
        sums = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[bounds])
        size = np.diff(bounds)
        kinds = _KIND[part]
        upper, lower, digit, mark = (sums(kinds == k) for k in (1, 2, 3, 4))
        stop = sums(_STOP[part])
        at = chunk.offsets()
        n = np.diff(at)
        same = np.zeros(len(chunk.hash), dtype=bool)
        same[1:] = (chunk.hash[1:] == chunk.hash[:-1]) & (chunk.row[1:] == chunk.row[:-1])
        repeats = np.diff(np.concatenate(([0], np.cumsum(same)))[at])
        lines = np.array([_repeated_lines(part[x:y].tobytes()) for x, y in zip(bounds[:-1], bounds[1:], strict=True)])
        capital, odd = _share(upper, upper + lower), _share(mark, size)
        figures, again = _share(digit, size), _share(repeats, n)
        letters = _share(upper + lower, n)
        sentence = _share(n, stop)
        out.append(
            np.stack(
                [
                    _vote(capital < 0.2, capital > 0.4),
                    _vote(odd < 0.01, odd > 0.05),
                    _vote(figures < 0.1, figures > 0.3),
                    _vote(again < 0.05, again > 0.2),
                    _vote(lines < 0.1, lines > 0.4),
                    _vote((letters > 2.5) & (letters < 12), (n > 0) & ((letters < 1.5) | (letters > 20))),
                    _vote((stop > 0) & (sentence < 40), (n > 60) & ((stop == 0) | (sentence > 100))),
                    _vote(n > 40, n < 4),
                ],
                axis=1,
            )
        )
    return np.concatenate(out) if out else np.zeros((0, len(LABELLERS)), dtype=np.int8)


def _repeated_lines(text: bytes) -> float:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return 1 - len(set(lines)) / len(lines) if len(lines) > 3 else 0.0


@dataclass
class LabelModel:
    """The share of good documents, and P(vote | good) and P(vote | bad) by labeller."""

    good: float
    given_good: np.ndarray
    given_bad: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        columns = np.arange(patterns.shape[1])
        voted = patterns < 2  # no vote says nothing
        logs = [(np.log(t[columns, patterns]) * voted).sum(axis=1) for t in (self.given_good, self.given_bad)]
        odds = logs[0] - logs[1] + np.log(self.good / (1 - self.good))
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> LabelModel:
    """Accuracies of the labellers by expectation-maximisation over pattern counts.

    Starts from "one bad vote is enough", as each kind of junk is seen by one
    labeller or two. Left free, two classes drift to the commonest kind against
    the rest; so labellers vote bad on clear cases only, and at most
    ``MOST_WRONG`` of their votes on good documents are taken to be bad.
    """
    total = counts.sum()
    weight = np.where((patterns == 0).any(axis=1), 0.0, 1.0)
    model = LabelModel(0.5, np.empty(0), np.empty(0))
    for _ in range(rounds):
        tables = []
        for share in (weight, 1 - weight):
            table = np.stack([((patterns == v) * (share * counts)[:, None]).sum(axis=0) for v in range(3)], axis=1) + PRIOR
            tables.append(table / table.sum(axis=1, keepdims=True))
        tables[0][:, 0] = np.minimum(tables[0][:, 0], MOST_WRONG)
        model = LabelModel(float(np.clip((weight * counts).sum() / max(total, 1), 0.01, 0.99)), *tables)
        weight = model.posterior(patterns)
    return model


def grams(column: pa.Array, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text: places of its 4-byte grams and their weights (unit length)."""
    data, starts = flat(column)
    for first, last in chunks(starts):
        a = starts[first]
        hashes = (mix(byte_grams(data[a : starts[last]], GRAM), 31) >> np.uint64(64 - bits)).astype(np.int64)
        for x, y in zip(starts[first:last] - a, starts[first + 1 : last + 1] - a, strict=True):
            places, counts = np.unique(hashes[x : max(x, y - GRAM + 1)], return_counts=True)
            weights = 1 + np.log(counts)
            yield places, weights / max(np.sqrt((weights**2).sum()), 1e-9)


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        sums = np.array([self.weights[p] @ w + self.bias for p, w in grams(column)])
        return 1 / (1 + np.exp(-np.clip(sums, -30, 30)))


def fit(column: pa.Array, posteriors: np.ndarray, epochs: int = EPOCHS, seed: int = 6) -> Scorer:
    """Logistic regression on soft labels, by Adagrad."""
    rows, random = list(grams(column)), np.random.default_rng(seed)
    scorer, seen, bias_seen = Scorer(np.zeros(1 << BITS), 0.0), np.full(1 << BITS, 1e-6), 1e-6
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            places, values = rows[i]
            error = 1 / (1 + np.exp(-np.clip(scorer.weights[places] @ values + scorer.bias, -30, 30))) - posteriors[i]
            step = error * values
            seen[places] += step * step
            scorer.weights[places] -= STEP * step / np.sqrt(seen[places])
            bias_seen += error * error
            scorer.bias -= STEP * error / bias_seen**0.5
    return scorer


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    power = 3 ** np.arange(len(LABELLERS))
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(votes(batch.column(1)).astype(np.int64) @ power)], names=["doc_id", "text", "pattern"])


def unpacked(patterns: np.ndarray) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


def learn(docs: DataFrame, max_sample: int = MAX_SAMPLE) -> tuple[LabelModel, Scorer]:
    """The label model from all documents, the scorer from a sample of them."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    voted = text.mapInArrow(_votes, "doc_id long, text string, pattern long")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes")
    ids = stored(voted.select("doc_id", F.xxhash64("doc_id", "text").alias("place"), "pattern", size), "votes")
    counted = ids.groupBy("pattern").count().toPandas()  # at most 3 ** labellers rows
    patterns = unpacked(counted["pattern"].to_numpy(dtype=np.int64))
    model = estimate(patterns, counted["count"].to_numpy(dtype=np.float64))
    sample = sampled(text, ids, max_sample)
    posteriors = model.posterior(unpacked(np.array(sample.column("pattern").to_pylist(), dtype=np.int64).reshape(-1)))
    texts = sample.column("text").combine_chunks() if sample.num_rows else pa.array([], pa.string())
    return model, fit(texts, posteriors)


def sampled(text: DataFrame, ids: DataFrame, max_sample: int, max_bytes: int = MAX_SAMPLE_BYTES) -> pa.Table:
    """place, pattern, text of unlike rows (equal rows are one), in the order of their places.

    At most ``max_sample`` rows, as far as their texts fit into ``max_bytes`` (the first always
    does); the sizes are known before any text is read.
    """
    unlike = ids.groupBy("place").agg(F.min("pattern").alias("pattern"), F.min("bytes").alias("bytes"))
    first = unlike.orderBy("place").limit(max_sample).collect()
    total, kept = 0, []
    for row in first:
        total += row["bytes"]
        if kept and total > max_bytes:
            break
        kept.append((row["place"], row["pattern"]))
    chosen = text.sparkSession.createDataFrame(kept, "place long, pattern long")
    hashed = text.withColumn("place", F.xxhash64("doc_id", "text"))
    found = hashed.join(F.broadcast(chosen), "place").groupBy("place").agg(F.min("pattern").alias("pattern"), F.min("text").alias("text"))
    return found.orderBy("place").toArrow()


def _scored(model: LabelModel, scorer: Scorer):
    def run(batches):
        for batch in batches:
            pattern = votes(batch.column(1)).astype(np.int64)
            posterior, score = model.posterior(pattern), scorer.scores(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(posterior), pa.array(score), pa.array(posterior + score >= 1)],
                names=["doc_id", "posterior", "score", "kept"],
            )

    return run


def score(docs: DataFrame, model: LabelModel, scorer: Scorer) -> DataFrame:
    """doc_id, posterior of its votes, score of the linear model, kept (their mean is 0.5 or more)."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return text.mapInArrow(_scored(model, scorer), "doc_id long, posterior double, score double, kept boolean")
