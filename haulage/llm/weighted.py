"""Document fingerprints by consistent weighted sampling.

A document is a bag of weighted terms: its word pairs, weighted by how often
they occur (a text of one word has that word). For each of ``samples`` draws,
every term has fixed random numbers r, c ~ Gamma(2, 1) and b ~ Uniform(0, 1);
a term of weight w stands at t = floor(ln w / r + b) and ranks by
c * exp(-r * (t - b + 1)). The draw keeps the term with the least rank and its
t. Two documents keep the same with probability sum(min w) / sum(max w), the
generalised Jaccard similarity of their bags.

A term is named by ``term_bits`` bits of its hash, all 64 as a rule, and its random
numbers are made from them, so unlike terms stay apart in texts of any length. A
fingerprint is four hexadecimal digits for each draw; likeness is the share of equal
draws.

Defined results: null text is empty; a text without words has a fingerprint of
zeros, like every other such text, and likeness 1 to them only; equal texts have
equal fingerprints whatever their doc_id; rows stand in ascending doc_id order,
null first, and rows that share a doc_id by text; the last is followed by the
first; a single row is its own next; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from haulage.llm.storing import stored
from haulage.llm.words import mix, sequence_hashes, words_of

SAMPLES = 64
TERM_BITS = 64
PART = 512
ROWS = 128


def _exponential(bits: np.ndarray) -> np.ndarray:
    """Exp(1) numbers from 64 random bits, in their order."""
    return -np.log1p(((bits >> np.uint64(11)) + 0.5) * -(2.0**-53))


class Sampler:
    """The random numbers of every term and draw, made from the term's hash.

    Of three Exp(1) numbers e, f and g of a term and draw, c = e + f, r (1 - b) = ln(c / e)
    and r b = g are distributed as asked, and a term of weight 1 has t = 0 and the rank e.
    So e alone, or the ``places`` it is made from, finds the least of these.
    """

    def __init__(self, samples: int = SAMPLES, term_bits: int = TERM_BITS, seed: int = 9):
        self.samples, self.term_bits, self.seed = samples, term_bits, seed
        self.factors = np.random.default_rng(seed).integers(0, 1 << 64, (samples, 1), dtype=np.uint64) | np.uint64(1)

    def places(self, terms: np.ndarray) -> np.ndarray:
        """64 bits for each draw (a row) and term (a column), a bijection of terms in each draw."""
        x = terms * self.factors
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x

    def ranks(self, places: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ln of the rank and t, for terms of the given weights (a column each)."""
        e, c = _exponential(places), _exponential(mix(places, 6))
        c += e
        g = _exponential(mix(places, 7))
        r = np.log(c / e) + g
        b = g / r
        t = np.floor(np.log(weights) / r + b)
        return np.log(c) - r * (t - b + 1), t

    def draws(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """16 bits for each draw from a bag; all zero for an empty one."""
        if not len(terms):
            return np.zeros(self.samples, dtype=np.uint16)
        terms = mix(terms.astype(np.uint64), self.seed)
        once, often = terms[weights == 1], np.flatnonzero(weights > 1)
        kept = np.full(self.samples, np.iinfo(np.uint64).max, dtype=np.uint64)
        for at in range(0, len(once), PART):
            np.minimum(kept, self.places(once[at : at + PART]).min(axis=1), out=kept)
        best = np.log(_exponential(kept)) if len(once) else np.full(self.samples, np.inf)
        level = np.zeros(self.samples, dtype=np.int64)
        each = np.arange(self.samples)
        for at in range(0, len(often), PART):
            part = often[at : at + PART]
            places = self.places(terms[part])
            rank, t = self.ranks(places, weights[part].astype(np.float64))
            first = rank.argmin(axis=1)
            least = rank[each, first]
            better = least < best
            best = np.where(better, least, best)
            kept = np.where(better, places[each, first], kept)
            level = np.where(better, t[each, first].astype(np.int64), level)
        return (mix(kept * np.uint64(65537) + level.astype(np.uint64), 3) >> np.uint64(48)).astype(np.uint16)

    def bags(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Terms and weights of each text."""
        for chunk in words_of(pa.array(texts, pa.large_string())):
            bounds = chunk.offsets()
            single = mix(chunk.hash, 5) >> np.uint64(64 - self.term_bits)
            paired = sequence_hashes(chunk.hash, 2) >> np.uint64(64 - self.term_bits)
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                yield np.unique(single[a:b] if b - a < 2 else paired[a : b - 1], return_counts=True)

    def signatures(self, texts: list[str]) -> np.ndarray:
        return np.array([self.draws(*bag) for bag in self.bags(texts)], dtype=np.uint16).reshape(len(texts), self.samples)


_samplers: dict[tuple[int, int], Sampler] = {}


def sampler(samples: int = SAMPLES, term_bits: int = TERM_BITS) -> Sampler:
    if (samples, term_bits) not in _samplers:
        _samplers[samples, term_bits] = Sampler(samples, term_bits)
    return _samplers[samples, term_bits]


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the start of the text that follows."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


COLUMNS = (
    ("doc_id", pa.int64()),
    ("n_chars", pa.int64()),
    ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()),
    ("near_next", pa.float64()),
)
RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
STREAMED = f"kind string, part int, text string, {RESULT}"


def _rows(ids, texts, following, signatures, next_signatures, made) -> list[list]:
    changed = [edited(a, b) for a, b in zip(texts, following, strict=True)]
    other = made.signatures(changed)
    like = lambda a, b: (a == b).mean(axis=1).tolist()
    text = lambda s: [x.tobytes().hex() for x in s.astype(">u2")]
    digest = [sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in changed]
    return [ids, [len(x) for x in texts], digest, text(signatures), text(other), like(signatures, other), like(signatures, next_signatures)]


def _stream(samples: int, term_bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Ordered documents in; finished rows out, then the first and the last text.

    The last document of a partition is followed by the first of the next one,
    which this task doesn't see; ``_join_ends`` finishes it.
    """

    def run(batches):
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), sampler(samples, term_bits)

        def out(kind, texts, values):
            n = len(values[0])
            arrays = [pa.array([kind] * n, pa.string()), pa.array([part] * n, pa.int32()), pa.array(texts, pa.string())]
            arrays += [pa.array(v, k) for v, (_, k) in zip(values, COLUMNS, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["kind", "part", "text", *(k for k, _ in COLUMNS)])

        waiting: tuple | None = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                ids, texts = rows.column(0).to_pylist(), [x or "" for x in rows.column(1).to_pylist()]
                signatures = made.signatures(texts)
                if waiting is None:
                    yield out("first", texts[:1], [[ids[0]], *[[None]] * 6])
                else:
                    ids, texts = [waiting[0], *ids], [waiting[1], *texts]
                    signatures = np.concatenate((waiting[2], signatures))
                n = len(ids) - 1
                waiting = (ids[n], texts[n], signatures[n:])
                if n:
                    yield out("done", [None] * n, _rows(ids[:n], texts[:n], texts[1:], signatures[:n], signatures[1:], made))
        if waiting is not None:
            yield out("last", [waiting[1]], [[waiting[0]], *[[None]] * 6])

    return run


def _join_ends(samples: int, term_bits: int):
    def run(batches):
        made = sampler(samples, term_bits)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                ids, texts, following = (c.to_pylist() for c in batch.slice(at, ROWS).columns)
                values = _rows(ids, texts, following, made.signatures(texts), made.signatures(following), made)
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, (_, k) in zip(values, COLUMNS, strict=True)], names=[k for k, _ in COLUMNS])

    return run


def fingerprints(docs: DataFrame, samples: int = SAMPLES, term_bits: int = TERM_BITS) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness.

    Documents are range-partitioned by doc_id once and streamed in order. Only
    two texts of each partition meet again, its first and its last.
    """
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "text")
        .select("doc_id", "text")
    )
    streamed = stored(ordered.mapInArrow(_stream(samples, term_bits), STREAMED), "weighted")
    ends = streamed.filter(F.col("kind") != "done").select("kind", "part", "doc_id", "text")
    # a row per partition: the next partition with rows, after the last the first
    parts = ends.filter(F.col("kind") == "first").select("part")
    by_part = Window.orderBy("part")
    everything = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follow = parts.select("part", F.coalesce(F.lead("part").over(by_part), F.min("part").over(everything)).alias("next_part"))
    first = ends.filter(F.col("kind") == "first").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    last = ends.filter(F.col("kind") == "last").select("part", "doc_id", "text")
    joined = last.join(follow, "part").join(first, "next_part").select("doc_id", "text", "following")
    finished = joined.mapInArrow(_join_ends(samples, term_bits), RESULT)
    columns = [k for k, _ in COLUMNS]
    return streamed.filter(F.col("kind") == "done").select(*columns).unionByName(finished.select(*columns))
