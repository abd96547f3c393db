"""Remove repeated byte strings, by blockwise suffix sorting with a difference cover.

A window is ``window`` bytes that start at one place of a document. A window is late if the same
bytes start earlier: in a document with a smaller doc_id, or before it in its own. Bytes under
a late window go.

1. The bucket of a suffix is the least gram (by hash) of ``GRAM`` bytes in its window, so equal
   windows meet. Neighbouring suffixes of one bucket form a run. Buckets that
   hold one run of the corpus are done: nothing in them repeats.
2. Runs of equal bytes are one form; where it stands first is a grouped minimum, and
   everywhere else all its windows are late.
3. Buckets of several forms are sorted. A task loads the texts of some buckets and ranks the
   cover sample: the suffixes at places whose remainder by 31 is in a difference cover,
   by prefix doubling. The suffixes of a load are divided by their first bytes and sorted one part
   at a time: by 32 bytes, then ties by the ranks of the sample that both
   suffixes reach after the same distance, which the cover has for any two places. Whole
   sorting needs the loaded bytes, their sample and one part. Neighbours that share a whole window are
   the same string, and the earliest place among them is the one that stays.
4. Buckets of more than ``MOST_FORMS`` forms are no task's load: their windows are rows,
   whose first place is a grouped minimum over the window's own bytes.

Documents of equal text are one from step 1 on: all windows of all but the first are late. Grams
only choose buckets; runs are told equal by 64 bits within a bucket; sorted windows are compared byte by byte.

Defined results: null text is empty; documents without doc_id come after all others; documents
that share a doc_id are documents of their own, ordered by the digest of their text, and of equal rows one is
the first; a text of fewer bytes than a window loses none; an empty table gives no rows; other
columns are not read. A long text is read in pieces, so no array grows with it but its
own bytes and the marks on them.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from haulage.llm import words
from haulage.llm.storing import dropped, stored

WINDOW = 100
GRAM = 32
LOAD_BYTES = 1 << 18
PART = 1 << 16
MOST_FORMS = 1024
PIECE = 1 << 16
#: Bits of a place in a piece; a gram is ranked by its hash's other bits.
PLACE_BITS = 20

#: A perfect difference set, so its differences cover all remainders.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)

_IN_COVER = np.isin(np.arange(PERIOD), COVER)
#: The least distance after which places of two remainders are both in the sample.
_REACH = np.array(
    [[next(d for d in range(PERIOD) if _IN_COVER[(a + d) % PERIOD] and _IN_COVER[(b + d) % PERIOD]) for b in range(PERIOD)] for a in range(PERIOD)]
)


def runs_of(data: np.ndarray, row_ends: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(place, windows, gram, hash of the run's bytes) of every run; ``row_ends`` are the ends of the texts in ``data``.

    Hashes and places share a number, so the least number of a window names its first least gram.
    """
    none = np.zeros(0, np.int64)
    n = len(data) - window + 1
    if n <= 0:
        return none, none, none, none
    if len(data) > 1 << PLACE_BITS:
        raise ValueError(f"a piece has at most {1 << PLACE_BITS} bytes")
    values = data.astype(np.uint64) + np.uint64(1)
    at = np.arange(len(data) - gram + 1)
    sums = words.prefix_sums(values, words._BYTE_POWERS)
    grams = words.range_hashes(sums, words._BYTE_POWERS, slice(0, len(at)), slice(gram, None), gram)
    bits = np.uint64((1 << PLACE_BITS) - 1)
    least, span = (grams & ~bits) | at.astype(np.uint64), 1
    width = window - gram + 1
    while span < width:
        step = min(span, width - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    place = (least & bits).view(np.int64)
    inside = np.ones(n, dtype=bool)  # windows that don't reach into the next text
    for end in row_ends:
        inside[max(end - window + 1, 0) : end] = False
    new = np.concatenate(([True], (place[1:] != place[:-1]) | ~inside[:-1]))
    first = np.flatnonzero(new & inside)
    stop = np.append(np.flatnonzero(~inside), n)
    ends = np.minimum(np.append(first[1:], n), stop[np.searchsorted(stop, first)])
    sums = words.prefix_sums(values, words._WORD_POWERS)
    form = words.range_hashes(sums, words._WORD_POWERS, first, ends + window - 1)
    return first, ends - first, grams[place[first]].view(np.int64), form.view(np.int64)


def _runs_by_row(column: pa.Array, window: int, gram: int) -> Iterator[tuple[int, bytes, list[tuple[np.ndarray, ...]]]]:
    """Each row's number, bytes and runs; places count from the row's beginning."""
    data, starts = words.flat(column)
    for first, last in words.chunks(starts, PIECE):
        begin, end = int(starts[first]), int(starts[last])
        if last == first + 1 and end - begin > 2 * PIECE:  # a long row, in pieces that share no window
            parts = []
            for at in range(begin, end - window + 1, PIECE):
                stop = min(at + PIECE + window - 1, end)
                place, *rest = runs_of(data[at:stop], np.zeros(0, np.int64), window, gram)
                parts.append((place + (at - begin), *rest))
            yield first, data[begin:end].tobytes(), parts
            continue
        place, *rest = runs_of(data[begin:end], starts[first + 1 : last + 1] - begin, window, gram)
        bounds = np.searchsorted(place, starts[first : last + 1] - begin)
        for row in range(first, last):
            a, b = bounds[row - first], bounds[row - first + 1]
            yield row, data[starts[row] : starts[row + 1]].tobytes(), [(place[a:b] - (starts[row] - begin), *(x[a:b] for x in rest))]


def _key(text: bytes) -> tuple[str, int, int]:
    digest = sha256(text)
    head = digest.digest()
    return digest.hexdigest(), int.from_bytes(head[:8], "little", signed=True), int.from_bytes(head[8:16], "little", signed=True)


def _batch(schema: str, columns: list[list]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "boolean": pa.bool_()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _gather(schema: str, rows: Iterator[tuple], most: int = 5000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield _batch(schema, list(zip(*held, strict=True)))
            held = []
    if held:
        yield _batch(schema, list(zip(*held, strict=True)))


READ = "doc_id long, text_hash long, k1 long, k2 long, n_bytes long, sha256 string, grams array<long>, twice array<long>"


def _read(window: int, gram: int):
    """Per row of (doc_id, text, text_hash): digest and the buckets of its runs; those with several runs here are told apart."""

    def rows(batches):
        for batch in batches:
            ids, hashes = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for row, text, parts in _runs_by_row(batch.column(1), window, gram):
                grams = np.sort(np.concatenate([p[2] for p in parts]) if parts else np.zeros(0, np.int64))
                first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1]))) if len(grams) else grams
                grams, times = grams[first], np.diff(np.append(first, len(grams)))
                hexed, k1, k2 = _key(text)
                yield ids[row], hashes[row], k1, k2, len(text), hexed, grams[times == 1], grams[times > 1]

    return lambda batches: _gather(READ, rows(batches), 500)


RUNS = "ordinal long, gram long, form long, n long, places array<long>"


def _among(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which values are among the sorted ``wanted``."""
    if not len(wanted):
        return np.zeros(len(values), dtype=bool)
    return wanted[np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)] == values


def _runs(window: int, gram: int):
    """The runs of (text, ordinal, k1, k2, picks) in the buckets ``picks``; equal runs of a text are one row."""

    def rows(batches):
        for batch in batches:
            ordinals, k1, k2 = (batch.column(i).to_pylist() for i in range(1, 4))
            for row, text, parts in _runs_by_row(batch.column(0), window, gram):
                if _key(text)[1:] != (k1[row], k2[row]):
                    continue  # another text with the same 64-bit hash
                wanted = np.sort(batch.column(4)[row].values.to_numpy(zero_copy_only=False))
                kept = [[x[_among(p[2], wanted)] for x in p] for p in parts]
                place, n, grams, forms = (np.concatenate(x) for x in zip(*kept, strict=True))
                order = np.lexsort((place, n, forms, grams))
                place, n, grams, forms = place[order], n[order], grams[order], forms[order]
                new = np.ones(len(order), dtype=bool)
                new[1:] = (grams[1:] != grams[:-1]) | (forms[1:] != forms[:-1]) | (n[1:] != n[:-1])
                first = np.flatnonzero(new)
                yield np.full(len(first), ordinals[row]), grams[first], forms[first], n[first], np.diff(np.append(first, len(new))), place

    def run(batches, most: int = 5000):
        held, size = [], 0
        for found in chain(rows(batches), [None]):
            if found is not None:
                held.append(found)
                size += len(found[0])
            if held and (found is None or size >= most):
                *columns, sizes, places = (np.concatenate(x) for x in zip(*held, strict=True))
                offsets = np.concatenate(([0], np.cumsum(sizes)))
                names = [x.split()[0] for x in RUNS.split(", ")]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), words.lists(places, offsets, pa.int64())], names=names)
                held, size = [], 0

    return run


FORMS = "gram long, form long, n long, ordinal long, place long, bytes binary"


def _form_bytes(window: int):
    """The bytes of the forms that first stand in (text, ordinal, k1, k2, forms)."""

    def rows(batches):
        for batch in batches:
            texts, ordinals, k1, k2, forms = (batch.column(i) for i in range(5))
            for row in range(batch.num_rows):
                text = (texts[row].as_py() or "").encode()
                if _key(text)[1:] != (k1[row].as_py(), k2[row].as_py()):
                    continue
                for x in forms[row].as_py():
                    yield x["gram"], x["form"], x["n"], ordinals[row].as_py(), x["place"], text[x["place"] : x["place"] + x["n"] + window - 1]

    return lambda batches: _gather(FORMS, rows(batches))


def _tied(same: np.ndarray) -> np.ndarray:
    """Group numbers of a sorted list, given which entries equal the one before."""
    return np.cumsum(~np.concatenate(([False], same))) - 1


class SuffixSorter:
    """Sorts suffixes of loaded bytes, so that suffixes that share ``depth`` bytes lie together."""

    def __init__(self, data: np.ndarray, depth: int):
        self.depth = depth
        padded = np.concatenate((data, np.zeros(depth + 6 * PERIOD + 8, np.uint8)))
        self.words = np.zeros(len(padded) - 7, dtype=np.uint64)  # eight bytes from each place, as a number
        for i in range(8):
            self.words |= padded[i : len(padded) - 7 + i].astype(np.uint64) << np.uint64(56 - 8 * i)
        self.ranks = self._cover_ranks(len(data))

    def _by_prefix(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places by their first 32 bytes, and a number for each group of ties."""
        order = np.argsort(self.words[at], kind="stable")
        at = at[order]
        group = _tied(self.words[at][1:] == self.words[at][:-1]) if len(at) else at
        for offset in (8, 16, 24):
            sizes = np.bincount(group) if len(at) else group
            open_ = np.flatnonzero(sizes[group] > 1) if len(at) else at
            if not len(open_):
                break
            order = np.lexsort((self.words[at[open_] + offset], group[open_]))
            at[open_] = at[open_][order]
            word = self.words[at + offset]
            same = (group[1:] == group[:-1]) & ((word[1:] == word[:-1]) | (sizes[group[1:]] == 1))
            group = _tied(same)
        return at, group

    def _cover_ranks(self, n: int) -> np.ndarray:
        """By place, the rank of sample suffixes to at least ``depth`` bytes beyond a period."""
        sample = np.flatnonzero(_IN_COVER[np.arange(n) % PERIOD])
        ranks = np.zeros(len(self.words) + PERIOD, dtype=np.int64)
        at, group = self._by_prefix(sample)
        ranks[at] = group + 1
        reach = PERIOD
        while reach < self.depth and len(at) and group[-1] + 1 < len(at):
            step = np.minimum(at + reach, len(ranks) - 1)
            order = np.lexsort((ranks[step], ranks[at]))
            at, step = at[order], step[order]
            same = (ranks[at][1:] == ranks[at][:-1]) & (ranks[step][1:] == ranks[step][:-1])
            group = _tied(same)
            ranks[at] = group + 1
            reach *= 2
        return ranks

    def _resolve(self, at: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order ties of 32 bytes: by cover ranks, against a middle suffix of each group, until none is unequal."""
        place = np.arange(len(at))  # where the entries of a group stand
        open_ = np.flatnonzero(np.bincount(group)[group] > 1)
        while len(open_):
            g, here = group[open_], at[open_]
            first = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
            size = np.diff(np.append(first, len(g)))
            pivot = np.repeat(here[first + size // 2], size)
            reach = _REACH[here % PERIOD, pivot % PERIOD]
            side = np.sign(self.ranks[here + reach] - self.ranks[pivot + reach])
            order = np.lexsort((side, g))
            at[open_] = here[order]
            side, g = side[order], g[order]
            part = _tied((g[1:] == g[:-1]) & (side[1:] == side[:-1]))
            left = (side != 0) & (np.bincount(part)[part] > 1)
            group = group.copy()
            group[open_] = part + (group.max() + 1)
            open_ = open_[left]
        return at[place]

    def sort(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in order, and a number for those whose first ``depth`` bytes are the same."""
        at, group = self._by_prefix(at)
        at = self._resolve(at, group)
        same = np.ones(max(len(at) - 1, 0), dtype=bool)
        for offset in range(0, self.depth, 8):
            pair = np.flatnonzero(same)
            word = self.words[at[pair] + offset] ^ self.words[at[pair + 1] + offset]
            same[pair] = word >> np.uint64(max(0, 8 * (offset + 8 - self.depth))) == 0
        return at, _tied(same)

    def parts(self, at: np.ndarray, most: int) -> Iterator[np.ndarray]:
        """The places divided by their first bytes, so that equal ones stay together."""
        if len(at) <= most:
            yield at
            return
        heads = self.words[at]
        ordered = np.sort(heads)
        cuts = np.unique(ordered[most::most])
        part = np.searchsorted(cuts, heads, side="right")
        for i in range(len(cuts) + 1):
            if len(own := at[part == i]):
                yield own


LATE = "gram long, form long, n long, late array<long>"


def _sorted_late(window: int, load: int, most: int):
    """Which windows of the forms of whole buckets are late: forms come bucket by bucket."""

    def loads(batches):
        held, size, bucket = [], 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != bucket and size >= load:
                    yield held
                    held, size = [], 0
                bucket = row[0]
                held.append(row)
                size += len(row[5])
        if held:
            yield held

    def rows(batches):
        for held in loads(batches):
            data = np.frombuffer(b"".join(x[5] for x in held), np.uint8)
            begin = np.concatenate(([0], np.cumsum([len(x[5]) for x in held])))[:-1]
            count = np.array([x[2] for x in held])
            which = np.repeat(np.arange(len(held)), count)
            inner = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            starts = begin[which] + inner
            ordinal, place = (np.array([x[i] for x in held], dtype=np.int64)[which] for i in (3, 4))
            earlier = np.empty(len(which), dtype=np.int64)  # places of the corpus, in order
            earlier[np.lexsort((place + inner, ordinal))] = np.arange(len(which))
            when = np.full(len(data), -1, dtype=np.int64)
            when[starts] = earlier
            late = np.zeros(len(data), dtype=bool)
            sorter = SuffixSorter(data, window)
            for part in sorter.parts(starts, most):
                at, group = sorter.sort(part)
                least = np.minimum.reduceat(when[at], np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))))
                late[at] = when[at] > least[group]
            for i in np.unique(which[late[starts]]).tolist():
                x = held[i]
                yield x[0], x[1], x[2], np.flatnonzero(late[begin[i] : begin[i] + x[2]])

    return lambda batches: _gather(LATE, rows(batches))


DONE = "ordinal long, n_removed long, n_spans long, kept_sha256 string"


def _removed(window: int):
    """What is left of (text, ordinal, k1, k2, runs) without the bytes under late windows."""

    def rows(batches):
        for batch in batches:
            ordinals, k1, k2 = (batch.column(i).to_pylist() for i in range(1, 4))
            data, starts = words.flat(batch.column(0))
            runs = batch.column(4)
            bounds, runs = runs.offsets.to_numpy(), runs.values
            place, n = (runs.field(x).to_numpy(zero_copy_only=False) for x in ("place", "n"))
            late = runs.field("late")
            whole = late.is_null().to_numpy(zero_copy_only=False)
            counts = late.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            at = np.repeat(place, counts) + late.flatten().to_numpy(zero_copy_only=False)
            ends = np.concatenate(([0], np.cumsum(counts)))
            for row in range(batch.num_rows):
                text = data[starts[row] : starts[row + 1]]
                if _key(text.tobytes())[1:] != (k1[row], k2[row]):
                    continue
                a, b = bounds[row], bounds[row + 1]
                own, each = whole[a:b], at[ends[a] : ends[b]]
                begins = np.concatenate((place[a:b][own], each))
                stops = np.concatenate(((place[a:b] + n[a:b])[own] + window - 1, each + window))
                size = len(text) + 1
                gone = np.cumsum(np.bincount(begins, minlength=size) - np.bincount(stops, minlength=size))[:-1] > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                yield ordinals[row], int(gone.sum()), spans, sha256(text[~gone].tobytes()).hexdigest()

    return lambda batches: _gather(DONE, rows(batches))


def _late_in_hot(forms: DataFrame, window: int) -> DataFrame:
    """As ``LATE``, for buckets of any size: a row for each window, grouped by its bytes."""
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))
    each = forms.withColumn("at", at).select(
        "gram", "form", "n", "at",
        F.substring("bytes", F.col("at").cast("int") + 1, F.lit(window)).alias("bytes"),
        F.struct(F.col("ordinal").alias("ordinal"), (F.col("place") + F.col("at")).alias("place")).alias("here"),
    )
    least = stored(each.groupBy("bytes").agg(F.min("here").alias("least"), F.count("*").alias("times")).filter("times > 1"), "first-windows")
    late = each.join(least, "bytes").filter("here > least")
    return late.groupBy("gram", "form", "n").agg(F.collect_list("at").alias("late"))


def late_windows(forms: DataFrame, window: int = WINDOW, most_forms: int = MOST_FORMS) -> DataFrame:
    """gram, form, n, late (offsets): the windows of forms (``FORMS``) that stand in an earlier form too."""
    sizes = forms.groupBy("gram").agg(F.count("*").alias("forms"))
    hot = stored(sizes.filter(F.col("forms") > most_forms).select("gram"), "hot-buckets")
    sorted_ = forms.join(hot, "gram", "left_anti").repartition("gram").sortWithinPartitions("gram")
    sorted_ = sorted_.select(*(x.split()[0] for x in FORMS.split(", "))).mapInArrow(_sorted_late(window, LOAD_BYTES, PART), LATE)
    return sorted_.unionAll(_late_in_hot(forms.join(hot, "gram"), window))


def remove_repeated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, most_forms: int = MOST_FORMS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs``."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    read = stored(text.mapInArrow(_read(window, gram), READ), "suffix-buckets")
    key = ["k1", "k2"]

    def texts_of(wanted: DataFrame, column: str) -> DataFrame:
        small = wanted.join(texts, "ordinal").withColumnsRenamed({"doc_id": "one_id", "text_hash": "one_hash"})
        same = (F.col("text_hash") == F.col("one_hash")) & F.col("doc_id").eqNullSafe(F.col("one_id"))
        found = text.join(small, same).select("text", "ordinal", *key, column)
        return found.dropDuplicates(["ordinal"]) if repeated_rows else found

    # texts in the order of their first documents
    rows = read.groupBy("doc_id", *key, "text_hash", "n_bytes", "sha256").agg(F.count("*").alias("rows"))
    rows = stored(rows, "rows")
    document = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "rows")
    texts = rows.groupBy(*key).agg(F.min(document).alias("first")).select(*key, "first.*")
    texts = texts.repartitionByRange("none", "doc_id", *key).sortWithinPartitions("none", "doc_id", *key)
    texts = stored(texts.select(*key, "doc_id", "text_hash", "rows", F.monotonically_increasing_id().alias("ordinal")), "texts")
    repeated_rows = not texts.filter("rows > 1").isEmpty()
    texts = texts.drop("rows")

    # buckets with several runs; copies of a text say nothing about its buckets
    one = read.select("k1", F.explode("grams").alias("gram"), F.lit(0).alias("more"))
    more = read.select("k1", F.explode("twice").alias("gram"), F.lit(1).alias("more"))
    grams = one.unionAll(more)
    shared = grams.groupBy("gram").agg(F.min("k1").alias("a"), F.max("k1").alias("b"), F.max("more").alias("more"))
    shared = stored(shared.filter("a != b OR more = 1").select("gram"), "shared-buckets")
    firsts = read.join(texts.select(*key, F.col("doc_id").alias("one_id"), "ordinal"), key).filter(F.col("doc_id").eqNullSafe(F.col("one_id")))
    of_first = firsts.select("ordinal", F.explode(F.concat("grams", "twice")).alias("gram"))
    picks = of_first.join(shared, "gram").groupBy("ordinal").agg(F.collect_set("gram").alias("picks"))
    picks = stored(picks, "picks")

    runs = stored(texts_of(picks, "picks").mapInArrow(_runs(window, gram), RUNS), "runs")
    dropped(picks, shared, read)
    form = ["gram", "form", "n"]
    places = F.struct("ordinal", F.get("places", F.lit(0)).alias("place"))
    forms = runs.groupBy(*form).agg(F.min(places).alias("first"), F.sum(F.size("places")).alias("times"))
    forms = stored(forms.select(*form, "first.ordinal", "first.place", "times"), "forms")
    several = stored(forms.groupBy("gram").agg(F.count("*").alias("forms")).filter("forms > 1").select("gram"), "several")
    firsts = forms.join(several, "gram", "left_semi").groupBy("ordinal").agg(F.collect_list(F.struct(*form, "place")).alias("forms"))
    unlike = stored(texts_of(firsts, "forms").mapInArrow(_form_bytes(window), FORMS), "unlike-forms")
    late = stored(late_windows(unlike, window, most_forms), "late-windows")
    dropped(unlike, several)

    # a form's own windows at its first place, all of them at any other
    judged = forms.withColumnsRenamed({"ordinal": "first_ordinal", "place": "first_place"}).join(late, form, "left")
    judged = stored(judged.filter("times > 1 OR late IS NOT NULL"), "judged")
    every = runs.join(judged, form).select("ordinal", *form, F.explode("places").alias("place"), "first_ordinal", "first_place", "late")
    is_first = (F.col("ordinal") == F.col("first_ordinal")) & (F.col("place") == F.col("first_place"))
    every = every.filter(~is_first | F.col("late").isNotNull())
    every = every.groupBy("ordinal").agg(F.collect_list(F.struct("place", "n", F.when(is_first, F.col("late")).alias("late"))).alias("runs"))
    changed = stored(texts_of(every, "runs").mapInArrow(_removed(window), DONE), "removed")
    dropped(runs, judged, forms, late)

    # equal rows count as often as they stand; the first row of the first document is the text itself
    result = stored(texts.join(changed, "ordinal", "left").select(*key, F.col("doc_id").alias("one_id"), "n_removed", "n_spans", "kept_sha256"), "results")
    rows = rows.join(result, key).withColumn("i", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    copy = ~(F.col("doc_id").eqNullSafe(F.col("one_id")) & (F.col("i") == 1))
    gone = copy & (F.col("n_bytes") >= window)
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return rows.select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).when(copy, 0).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, 1).when(copy, 0).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, empty).when(copy, F.col("sha256")).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
    )
