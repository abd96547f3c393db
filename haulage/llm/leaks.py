"""Find benchmark items in documents, by the q-gram lemma on diagonal bands.

An item is cut into segments of ``SEGMENT`` characters that overlap by half (a
shorter item is one segment). A segment of m characters leaks into a document if
some stretch of the document differs from it by at most e = floor(rate * m)
edits. Such a stretch shares at least m - q + 1 - q * e q-grams with the segment,
on diagonals (place in the document minus place in the segment) that differ by
at most e. So q-gram matches are counted in bands of 2(e + 1) diagonals that
overlap by half; bands that meet the bound are kept, and a banded alignment
decides. Grams have ``Q`` characters, or fewer where the bound of a short segment would
fall below one: floor(m / (e + 1)) always leaves it at one at least.

A-Z are folded, and a run of white space counts as one space. Texts are whole, items of
every length are searched, and nothing is sampled. Places are those of the texts as given.

The benchmark goes to every task. It is read in blocks of at most
``BLOCK_CHARS`` characters, so what is sent stays bounded; a larger benchmark
takes more passes over the documents.

Defined results: null or empty texts and items match nothing; repeated rows are judged alike;
null doc_id or item_id come back as null; empty tables give no rows; other columns pass
through ``without_leaks`` unchanged. A document is removed by items of at least ``min_chars``
characters only: a shorter one is a word or two, which clean documents use as well. ``find_leaks``
reports those, too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from haulage.llm.words import byte_grams

Q = 12
RATE = 0.06
SEGMENT = 100
MIN_CHARS = 30  # of an item that removes documents
BLOCK_CHARS = 4_000_000
CHUNK_CHARS = 1 << 19
_FILTER_BITS = 21


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The folded characters of all texts, where each text begins, and each character's place in its text."""
    sizes = np.array([len(x) for x in texts], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = codes + ((codes >= 65) & (codes <= 90)).astype(np.uint32) * np.uint32(32)
    codes[(codes >= 9) & (codes <= 13)] = 32
    again = np.zeros(len(codes) + 1, dtype=bool)  # a space after a space
    again[1:-1] = (codes[1:] == 32) & (codes[:-1] == 32)
    again[starts] = False
    kept = np.flatnonzero(~again[:-1])
    text = np.repeat(np.arange(len(texts)), sizes)[kept]
    return codes[kept], np.searchsorted(text, np.arange(len(texts) + 1)), kept - starts[text]


def edit_budget(length: int, rate: float = RATE) -> int:
    return int(length * rate)


class _Grams:
    """The grams of ``q`` characters of some segments, in order, and their places."""

    def __init__(self, q: int, chosen: np.ndarray, segments: list[np.ndarray]):
        self.q = q
        grams = [byte_grams(segments[i], q) for i in chosen]
        hashes = np.concatenate(grams)
        of = np.repeat(chosen, [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.of, self.place = hashes[order], of[order], place[order]
        self.filter = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.filter[self.hashes >> np.uint64(64 - _FILTER_BITS)] = True


class Benchmark:
    """Segments of a block of items and the places of their q-grams."""

    def __init__(self, items: list[tuple[int | None, str | None]], q: int = Q, rate: float = RATE, segment: int = SEGMENT):
        self.q = q
        self.items: list[int | None] = []
        self.segments: list[np.ndarray] = []
        self.begins: list[int] = []
        for item, text in items:
            codes, _, origin = code_points([text or ""])
            if not len(codes):
                continue
            step = segment // 2
            last = max(0, len(codes) - segment)
            for at in sorted({*range(0, last, step), last}):
                self.items.append(item)
                self.begins.append(int(origin[at]))
                self.segments.append(codes[at : at + segment])
        self.lengths = np.array([len(s) for s in self.segments], dtype=np.int64)
        self.edits = np.array([edit_budget(n, rate) for n in self.lengths], dtype=np.int64)
        sizes = np.minimum(q, self.lengths // (self.edits + 1))  # of grams, by segment
        self.bounds = self.lengths - sizes + 1 - sizes * self.edits
        self.grams = [_Grams(int(n), np.flatnonzero(sizes == n), self.segments) for n in np.unique(sizes)]
        width = int(self.lengths.max(initial=1))
        self.padded = np.zeros((len(self.segments), width), dtype=np.uint32)
        for i, s in enumerate(self.segments):
            self.padded[i, : len(s)] = s

    def bands(self, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, segment, first diagonal of the band) wherever a band meets its bound."""
        found = [self._bands(grams, codes, starts) for grams in self.grams]
        return tuple(np.concatenate(x) for x in zip((np.zeros(0, np.int64),) * 3, *found, strict=True))

    def _bands(self, own: _Grams, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        empty = (np.zeros(0, np.int64),) * 3
        grams = byte_grams(codes, own.q)
        at = np.flatnonzero(own.filter[grams >> np.uint64(64 - _FILTER_BITS)])
        if not len(at):
            return empty
        low = np.searchsorted(own.hashes, grams[at], "left")
        n = np.searchsorted(own.hashes, grams[at], "right") - low
        at, low, n = at[n > 0], low[n > 0], n[n > 0]
        text = np.searchsorted(starts, at, side="right") - 1
        inside = at + own.q <= starts[text + 1]
        at, low, n, text = at[inside], low[inside], n[inside], text[inside]
        if not len(at):
            return empty
        match = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        at, text, segment = np.repeat(at, n), np.repeat(text, n), own.of[match]
        step = self.edits[segment] + 1
        diagonal = at - starts[text] - own.place[match] + self.lengths[segment]  # never negative
        high = diagonal // step
        keys = np.concatenate([np.stack([text, segment, high], 1), np.stack([text, segment, high - 1], 1)])
        found, counts = np.unique(keys, axis=0, return_counts=True) if len(keys) < 64 else _count(keys)
        kept = found[counts >= self.bounds[found[:, 1]]]
        return kept[:, 0], kept[:, 1], kept[:, 2] * (self.edits[kept[:, 1]] + 1) - self.lengths[kept[:, 1]]

    def align(self, codes, starts, text, segment, first) -> tuple[np.ndarray, np.ndarray]:
        """Least edits of each segment within its band, and where the stretch ends.

        All alignments advance together, a segment character at a time. Column j of
        row i stands at place i + first - e + j of the document.
        """
        if not len(text):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        slack = self.edits[segment]
        width = int((4 * slack + 3).max())
        j = np.arange(width)
        origin = first - slack
        size = (starts[text + 1] - starts[text])[:, None]
        cost = np.zeros((len(text), width), dtype=np.int64)
        best, end = np.full(len(text), 1 << 20), np.zeros(len(text), dtype=np.int64)
        far = 1 << 20
        for i in range(1, self.padded.shape[1] + 1):
            place = origin[:, None] + i - 1 + j  # the character that a diagonal step reads
            valid = (place >= 0) & (place < size)
            read = codes[np.where(valid, starts[text][:, None] + place, 0)]
            diagonal = np.where(valid, cost + (read != self.padded[segment, i - 1][:, None]), far)
            up = np.concatenate((cost[:, 1:] + 1, np.full((len(text), 1), far)), axis=1)
            new = np.minimum(diagonal, up)
            new = np.where((place >= -1) & (place < size), new, far)
            cost = np.minimum.accumulate(new - j, axis=1) + j
            done = self.lengths[segment] == i
            if done.any():
                least = cost.argmin(axis=1)
                best = np.where(done, cost[np.arange(len(text)), least], best)
                end = np.where(done, origin + i + least, end)
        return best, end

    def leaks(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(text, segment, edits, end) of every segment that a text holds."""
        codes, starts, origin = code_points(texts)
        text, segment, first = self.bands(codes, starts)
        out = []
        for a in range(0, len(text), 2048):
            part = slice(a, a + 2048)
            edits, end = self.align(codes, starts, text[part], segment[part], first[part])
            good = np.flatnonzero(edits <= self.edits[segment[part]])
            last = origin[np.maximum(starts[text[part]] + end - 1, starts[text[part]])] + 1
            out += [(int(text[part][g]), int(segment[part][g]), int(edits[g]), int(last[g])) for g in good]
        return out


def _count(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort(keys.T[::-1])
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1))))
    return keys[first], np.diff(np.append(first, len(keys)))


def _parts(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``CHUNK_CHARS`` characters."""
    at, size = 0, 0
    for i, x in enumerate(texts):
        size += len(x)
        if size >= CHUNK_CHARS or i == len(texts) - 1:
            yield at, texts[at : i + 1]
            at, size = i + 1, 0


FOUND = "doc_id long, item_id long, item_start long, doc_end long, edits long"


def _find(bench: Benchmark):
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = []
            for at, texts in _parts([x or "" for x in batch.column(1).to_pylist()]):
                for text, segment, edits, end in bench.leaks(texts):
                    rows.append((ids[at + text], bench.items[segment], bench.begins[segment], end, edits))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "item_id", "item_start", "doc_end", "edits"])

    return run


def _keep(bench: Benchmark, text_at: int):
    def run(batches):
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            for at, texts in _parts([x or "" for x in batch.column(text_at).to_pylist()]):
                for text, *_ in bench.leaks(texts):
                    keep[at + text] = False
            yield batch.filter(pa.array(keep))

    return run


def blocks(benchmark: DataFrame, limit: int = BLOCK_CHARS, min_chars: int = 1) -> Iterator[list]:
    """The items, a block of at most ``limit`` characters (or one item) at a time."""
    held, size = [], 0
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).filter(F.length("text") >= min_chars)
    for row in items.toLocalIterator():
        if held and size + len(row.text) > limit:
            yield held
            held, size = [], 0
        held.append((row.item_id, row.text))
        size += len(row.text)
    yield held


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document and item it holds a segment of.

    doc_id, item_id, n_segments, edits (fewest of a segment), item_start and doc_end
    (of the first such segment).
    """
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for items in blocks(benchmark):
        part = text.mapInArrow(_find(Benchmark(items)), FOUND)
        found = part if found is None else found.unionAll(part)
    return found.groupBy("doc_id", "item_id").agg(
        F.count_distinct("item_start").alias("n_segments"),
        F.min("edits").alias("edits"),
        F.min("item_start").alias("item_start"),
        F.min("doc_end").alias("doc_end"),
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents that hold no segment of any item of ``min_chars`` or more, with all their columns."""
    kept = docs
    for items in blocks(benchmark, min_chars=min_chars):
        kept = kept.mapInArrow(_keep(Benchmark(items), docs.columns.index("text")), docs.schema)
    return kept
