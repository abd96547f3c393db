"""Remove passages that recur, by repeated-phrase automata.

A window is ``window`` consecutive words; a window whose words start at another
place too, in the same document or another, is recurring, and every word under a
recurring window goes.

1. Each window is represented by its least phrase of ``PHRASE`` words (by hash), so
   equal windows have the same phrase. Phrases are counted; one that stands at
   a single place rules out all its windows without any of them being sent.
2. Windows that share a phrase's place form a block. Blocks are compared as
   wholes first, so copies of a passage are one row; only the windows of blocks
   seen once are compared one by one. That confirms the recurring passages.
3. Documents are streamed in shards. A shard's confirmed passages, cut to the
   fewest windows that cover them, are compiled into an Aho-Corasick automaton
   over word numbers; it locates every occurrence in the shard's documents.

Documents with the same words are one row from step 1 on: all their windows
recur. Phrases and blocks are hashed to 64 bits, documents to 128.

Defined results: null text has no words; a text of fewer words than a window
loses none; repeated rows are copies of each other and lose every word if long
enough; doc_id plays no part and may be null; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from haulage.llm.storing import stored
from haulage.llm.words import chunks, flat, lists, sequence_hashes, words_of

WINDOW = 35
PHRASE = 8
SHARD_BYTES = 1 << 20


def phrase_places(words: np.ndarray, window: int, phrase: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The phrases that represent a text's windows: their places, hashes and first windows.

    A window's phrase is its leftmost least one. Places ascend with the windows,
    so each place stands for a run of windows.
    """
    hashes = sequence_hashes(words, phrase)
    width = window - phrase + 1
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    least, place, span = hashes, np.arange(len(hashes)), 1
    while span < width:
        step = min(span, width - span)
        left, right = least[: len(least) - step], least[step:]
        keep = left <= right
        least = np.where(keep, left, right)
        place = np.where(keep, place[: len(place) - step], place[step:])
        span += step
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    return place[first], least[first], first


def _read(window: int, phrase: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per row: words joined by single spaces, hashed, and the phrases of its windows."""

    def run(batches):
        for batch in batches:
            data, starts = flat(batch.column(1))
            for chunk in words_of(batch.column(1)):
                bounds, n = chunk.offsets(), chunk.last - chunk.first
                digests, keys, phrases = [], [], []
                for r in range(n):
                    at = chunk.first + r
                    text = b" ".join(data[starts[at] : starts[at + 1]].tobytes().split())
                    digest = sha256(text)
                    digests.append(digest.hexdigest())
                    keys.append(digest.digest()[:16])
                    phrases.append(phrase_places(chunk.hash[bounds[r] : bounds[r + 1]], window, phrase)[1])
                key = np.frombuffer(b"".join(keys), dtype="<i8").reshape(-1, 2)
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in phrases])))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, n),
                        batch.column(2).slice(chunk.first, n),
                        pa.array(np.ascontiguousarray(key[:, 0])),
                        pa.array(np.ascontiguousarray(key[:, 1])),
                        pa.array(np.diff(bounds).astype(np.int64)),
                        pa.array(digests, pa.string()),
                        lists(np.concatenate(phrases), offsets, pa.int64()),
                    ],
                    names=["doc_id", "text_hash", "k1", "k2", "n_words", "sha256", "phrases"],
                )

    return run


READ = "doc_id long, text_hash long, k1 long, k2 long, n_words long, sha256 string, phrases array<long>"


def _key(text: bytes) -> tuple[int, int]:
    digest = sha256(b" ".join(text.split())).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:16], "little", signed=True)


def _blocks(window: int, phrase: int):
    """The windows of a document's counted phrases, a row for each phrase."""

    def run(batches):
        for batch in batches:
            k1, k2, single, picks = (batch.column(i).to_pylist() for i in range(1, 5))
            data, starts = flat(batch.column(0))
            for chunk in words_of(batch.column(0)):
                bounds = chunk.offsets()
                out: list[list] = [[], [], [], [], [], []]
                for r in range(chunk.last - chunk.first):
                    at = chunk.first + r
                    if _key(data[starts[at] : starts[at + 1]].tobytes()) != (k1[at], k2[at]):
                        continue  # another text with the same 64-bit hash
                    words = chunk.hash[bounds[r] : bounds[r + 1]]
                    _, hashes, first = phrase_places(words, window, phrase)
                    windows = sequence_hashes(words, window).view(np.int64)
                    ends = np.append(first[1:], len(windows))
                    hashes = hashes.view(np.int64)
                    for i in picks[at]:
                        if i >= len(first):
                            continue
                        values = (k1[at], k2[at], single[at], int(first[i]), int(hashes[i]), windows[first[i] : ends[i]])
                        for column, value in zip(out, values, strict=True):
                            column.append(value)
                kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
                names = ["k1", "k2", "single", "at", "phrase", "windows"]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], names=names)

    return run


BLOCKS = "k1 long, k2 long, single boolean, at long, phrase long, windows array<long>"


def cover(starts: list[tuple[int, int]], window: int) -> list[int]:
    """The fewest windows over the runs (first window, number) that cover the same words."""
    picked: list[int] = []
    runs: list[list[int]] = []
    for first, n in sorted(starts):
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], first + n)
        else:
            runs.append([first, first + n])
    for first, end in runs:
        picked += [*range(first, end - 1, window), end - 1]
    return picked


def _remove(window: int):
    """Stream documents through automata of their shard's passages."""

    def run(batches):
        import ahocorasick

        for batch in batches:
            k1, k2, runs = (batch.column(i).to_pylist() for i in range(1, 4))
            data, starts = flat(batch.column(0))
            for first, last in chunks(starts, SHARD_BYTES):
                numbers: dict[bytes, int] = {}
                words, coded, rows = [], [], []
                for at in range(first, last):
                    text = data[starts[at] : starts[at + 1]].tobytes()
                    if _key(text) != (k1[at], k2[at]):
                        continue
                    parts = text.split()
                    rows.append(at)
                    words.append(parts)
                    coded.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in parts), np.uint32, len(parts)))
                # a character for each word number, past the surrogates, as the automaton reads text
                texts = [np.where(c < 0xD700, c + 256, c + 0x900).astype("<u4").tobytes().decode("utf-32-le") for c in coded]
                automaton = ahocorasick.Automaton()
                for at, text in zip(rows, texts, strict=True):
                    for i in cover([(x["at"], x["n"]) for x in runs[at]], window):
                        automaton.add_word(text[i : i + window], 1)
                automaton.make_automaton()
                removed, digests = [], []
                for parts, text in zip(words, texts, strict=True):
                    change = np.zeros(len(parts) + 1, dtype=np.int64)
                    ends = np.fromiter((end for end, _ in automaton.iter(text)), np.int64)
                    change[ends - window + 1] += 1
                    change[ends + 1] -= 1
                    under = np.cumsum(change)[:-1] > 0
                    removed.append(int(under.sum()))
                    digests.append(sha256(b" ".join(parts[i] for i in np.flatnonzero(~under))).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k1[at] for at in rows], pa.int64()),
                        pa.array([k2[at] for at in rows], pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(digests, pa.string()),
                    ],
                    names=["k1", "k2", "n_removed", "kept_sha256"],
                )

    return run


def recurring_runs(docs: DataFrame, texts: DataFrame, window: int, phrase: int) -> DataFrame:
    """k1, k2, runs of recurring windows: for texts that stand in one row only."""
    key = ["k1", "k2"]
    # one 64-bit key is enough here: a document with a foreign place only has more to compare
    copied = (F.col("copies") > 1).cast("int")
    phrases = texts.select("k1", copied.alias("copied"), F.posexplode("phrases").alias("i", "phrase"))
    phrases = phrases.select("k1", "phrase", (F.col("i") * 2 + F.col("copied")).alias("tag"))
    counted = phrases.groupBy("phrase").agg(F.sum(F.col("tag") % 2 + 1).alias("places"))
    # written first, so that the join reads two plain shuffles and a hot phrase can be split
    counted = stored(counted.filter("places > 1"), "phrase-places")
    # a phrase that only copies of one text hold says nothing about other texts
    known = phrases.join(counted, "phrase").filter((F.col("tag") % 2 == 0) | (F.col("places") > 2))
    picks = known.groupBy("k1").agg(F.sort_array(F.collect_set((F.col("tag") / 2).cast("int"))).alias("picks"))
    picks = picks.join(texts.select(*key, "doc_id", "text_hash", (F.col("copies") == 1).alias("single")), "k1")
    read = stored(_texts_of(docs, picks, "single", "picks").mapInArrow(_blocks(window, phrase), BLOCKS), "blocks")

    weight = F.when(F.col("single"), 1).otherwise(2)
    blocks = read.withColumn("block", F.xxhash64("windows"))
    whole = stored(
        blocks.groupBy("block").agg(F.sum(weight).alias("times"), F.min("phrase").alias("phrase"), F.first("windows").alias("windows")),
        "whole-blocks",
    )
    # equal windows have the same phrase, so a phrase with one block needs no comparison
    varied = whole.groupBy("phrase").agg(F.count("*").alias("blocks")).filter("blocks > 1").select("phrase")
    each = whole.join(varied, "phrase", "left_semi").select("block", "times", F.posexplode("windows").alias("offset", "w"))
    shared = each.groupBy("w").agg(F.sum("times").alias("times"), F.min("times").alias("least")).filter("times > 1 AND least = 1")
    alone = each.filter("times = 1").join(shared.select("w"), "w").groupBy("block").agg(F.collect_list("offset").alias("offsets"))
    run = F.struct(F.col("at").alias("at"), F.size("windows").cast("long").alias("n"))
    full = blocks.filter("single").join(whole.filter("times > 1").select("block"), "block").select(*key, run.alias("run"))
    part = blocks.filter("single").join(alone, "block").select(*key, "at", F.explode("offsets").alias("offset"))
    part = part.select(*key, F.struct((F.col("at") + F.col("offset")).alias("at"), F.lit(1).cast("long").alias("n")).alias("run"))
    return full.unionAll(part).groupBy(*key).agg(F.collect_list("run").alias("runs"))


def _texts_of(docs: DataFrame, wanted: DataFrame, *columns: str) -> DataFrame:
    """The texts of wanted keys, found by one row's doc_id and the text's hash."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    small = wanted.withColumnRenamed("doc_id", "one_id").withColumnRenamed("text_hash", "one_hash")
    same = (F.col("text_hash") == F.col("one_hash")) & F.col("doc_id").eqNullSafe(F.col("one_id"))
    return text.join(small, same).select("text", "k1", "k2", *columns)


def remove_recurring(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of ``docs``."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    read = stored(text.withColumn("text_hash", F.xxhash64("text")).mapInArrow(_read(window, phrase), READ), "passages")
    key = ["k1", "k2"]
    one = F.min(F.struct("doc_id", "text_hash")).alias("one")
    texts = read.filter(F.col("n_words") >= window).groupBy(*key).agg(F.count("*").alias("copies"), one, F.first("phrases").alias("phrases"))
    texts = stored(texts.select(*key, "copies", "one.doc_id", "one.text_hash", "phrases"), "texts")

    runs = recurring_runs(docs, texts, window, phrase)
    touched = runs.join(texts.select(*key, "doc_id", "text_hash"), key)
    removed = _texts_of(docs, touched, "runs").mapInArrow(_remove(window), "k1 long, k2 long, n_removed long, kept_sha256 string")
    copies = texts.filter("copies > 1").select(
        *key, F.lit(-1).cast("long").alias("n_removed"), F.sha2(F.lit("").cast("binary"), 256).alias("kept_sha256")
    )
    changed = removed.unionAll(copies).withColumnRenamed("kept_sha256", "changed_sha256")
    every = F.when(F.col("n_removed") == -1, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
    return (
        read.select("doc_id", *key, "n_words", "sha256")
        .join(changed, key, "left")
        .select("doc_id", "n_words", every.alias("n_removed"), F.coalesce("changed_sha256", "sha256").alias("kept_sha256"))
    )
