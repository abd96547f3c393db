"""Hard-negative mining with exact integer scores, by Four-Russians tables.

1. Candidates are packed: a block holds up to ``BLOCK`` rows, sorted by label, as bit planes.
   The bits that eight neighbouring components have in one plane are a byte.
2. For the anchors of a block, tables hold the sum of every subset of eight components.
   A byte of a plane looks up its subset's sum; the sums of all groups, shifted by
   the plane and added (the sign's plane subtracted), are the inner product itself.
3. Anchor blocks meet candidate blocks in groups of bounded size. The first pass scores rows
   of an anchor's own label and keeps its best, the positives; the second scores the others and
   keeps, for each positive, the best inside its band. Each task keeps the best few
   rows of an anchor, and a ranking joins these.

All anchors meet all rows, as asked; the work is the product of both and is dealt out evenly,
whatever a label's share. Groups hold ``ANCHORS`` anchors and about
``BLOCKS_PER_GROUP * BLOCK`` candidates.

Defined results: a row with a null label, a null vector or any null or non-finite component
takes no part; missing components of a shorter vector are 0, so an empty vector scores 0; a
row without vec_id is no anchor, but may be a partner (its id is null and comes last among
ties). Repeated rows count as often as they stand: a repeated anchor gives its rows
again, and a repeated candidate takes several ranks. A row with the anchor's own vec_id is never
its positive. An anchor without positives, or a positive without negatives,
gives no rows; an empty table none. Other columns are not read. Scores that could pass
62 bits stop the job.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from haulage.llm.storing import stored

BLOCK = 4096
BLOCKS_PER_GROUP = 64
ANCHORS = 4096
AT_ONCE = 64
SLICE = 1024
REDUCE_AT = 20_000
NO_ID = np.iinfo(np.int64).max

PACKED = "label_list binary, ids binary, nulls binary, planes int, groups int, bits binary"
ANCHOR_BLOCK = "block int, dims int, n int, label_list binary, ids binary, nulls binary, components binary"
FOUND = "block int, anchor int, anchor_id long, band int, id long, score long"


def usable(vectors: DataFrame, scale: int) -> DataFrame:
    """id, label, components (whole numbers) of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return vectors.filter(F.col("label").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("id"),
        F.col("label").cast("long").alias("label"),
        F.transform(vector, lambda x: F.floor(x * scale)).alias("components"),
    )


def _sorted_rows(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, null flags, labels and components (shorter rows filled with 0), by label and id."""
    nulls = batch.column(0).is_null().to_numpy(zero_copy_only=False)
    ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
    labels = batch.column(1).to_numpy(zero_copy_only=False)
    lengths = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
    dims = -(-max(int(lengths.max(initial=0)), 1) // 8) * 8
    values = np.zeros((len(ids), dims), dtype=np.int64)
    values[np.arange(dims) < lengths[:, None]] = batch.column(2).flatten().to_numpy(zero_copy_only=False)
    order = np.lexsort((ids, nulls, labels))
    return ids[order], nulls[order], labels[order], values[order]


def bit_planes(values: np.ndarray) -> tuple[int, int, np.ndarray]:
    """(planes, groups, bytes by plane, group and row); the last plane is the sign's."""
    n, dims = values.shape
    planes = max(int(values.max(initial=0)).bit_length(), int(~values.min(initial=0)).bit_length()) + 1
    bits = np.empty((planes, dims // 8, n), dtype=np.uint8)
    for plane in range(planes):
        bits[plane] = np.packbits((values >> plane & 1).astype(np.uint8), axis=1, bitorder="little").T
    return planes, dims // 8, bits


def subset_sums(anchors: np.ndarray, dtype) -> np.ndarray:
    """For each group of eight components and each byte, the sums of all anchors."""
    n, dims = anchors.shape
    table = np.zeros((dims // 8, 256, n), dtype=dtype)
    for group in range(dims // 8):
        for j in range(8):
            table[group, 1 << j : 2 << j] = table[group, : 1 << j] + anchors[:, group * 8 + j].astype(dtype)
    return table


def scores(table: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The inner products (row, anchor): shift and add over the planes, from the sign's down."""
    total = np.zeros((bits.shape[2], table.shape[2]), dtype=table.dtype)
    part = np.empty_like(total)
    groups = min(len(table), bits.shape[1])
    for plane in range(len(bits) - 1, -1, -1):
        for group in range(groups):
            np.take(table[group], bits[plane, group], axis=0, out=part)
            total += part
        if plane == len(bits) - 1:
            np.negative(total, out=total)
        if plane:
            total <<= 1
    return total


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def packed(rows):
        ids, nulls, labels, values = _sorted_rows(rows)
        planes, groups, bits = bit_planes(values)
        columns = [[labels.tobytes()], [ids.tobytes()], [nulls.tobytes()], [planes], [groups], [bits.tobytes()]]
        kinds = [pa.binary()] * 3 + [pa.int32()] * 2 + [pa.binary()]
        names = ["label_list", "ids", "nulls", "planes", "groups", "bits"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    held, n = [], 0
    for batch in batches:
        for first in range(0, batch.num_rows, BLOCK):
            held.append(batch.slice(first, BLOCK))
            n += held[-1].num_rows
            if n >= BLOCK:
                yield packed(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                held, n = [], 0
    if n:
        yield packed(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


def _pack_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition of anchors is one block."""
    from pyspark import TaskContext

    held = [b for b in batches if b.num_rows]
    if held:
        ids, nulls, labels, values = _sorted_rows(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
        block = TaskContext.get().partitionId()
        columns = [[block], [values.shape[1]], [len(ids)], [labels.tobytes()], [ids.tobytes()], [nulls.tobytes()], [values.tobytes()]]
        kinds = [pa.int32()] * 3 + [pa.binary()] * 4
        names = ["block", "dims", "n", "label_list", "ids", "nulls", "components"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


class _Best:
    """The best rows so far of ``AT_ONCE`` anchors, for each of their bands."""

    def __init__(self, low: np.ndarray, high: np.ndarray, most: int):
        self.low, self.high, self.most = low, high, most
        self.rows = [np.zeros(0, np.int64)] * 4  # anchor and band, score, no id, id
        self.waiting: list[list[np.ndarray]] = []

    def offer(self, found: np.ndarray, own: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        """Scores (row, anchor), of which ``own`` may be taken."""
        own &= (found >= self.low.min(axis=1)) & (found <= self.high.max(axis=1))
        row, anchor = np.nonzero(own)
        score, bands = found[row, anchor].astype(np.int64), self.low.shape[1]
        for band in range(bands):
            keep = (score >= self.low[anchor, band]) & (score <= self.high[anchor, band])
            if keep.any():
                self.waiting.append([anchor[keep] * bands + band, score[keep], nulls[row[keep]], ids[row[keep]]])
        if sum(len(x[0]) for x in self.waiting) > REDUCE_AT:
            self.reduce()

    def reduce(self) -> None:
        if not self.waiting:
            return
        query, score, no_id, ids = (np.concatenate(x) for x in zip(self.rows, *self.waiting, strict=True))
        self.waiting = []
        order = np.lexsort((ids, no_id, -score, query))
        query = query[order]
        first = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1])))
        rank = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
        keep = order[rank < self.most]
        last = order[rank == self.most - 1]
        bands = self.low.shape[1]
        self.rows = [query[rank < self.most], score[keep], no_id[keep], ids[keep]]
        at = query[rank == self.most - 1]
        self.low[at // bands, at % bands] = score[last]


def _whole(table: pa.Table, name: str):
    return table.column(name).to_pylist()


def _scored(same: bool, most: int, percent: tuple[int, int]):
    """Score one group: an anchor block and some candidate blocks."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = []
        for i in range(left.num_rows if right.num_rows else 0):
            row = {name: left.column(name)[i].as_py() for name in left.column_names}
            n = row["n"]
            values = np.frombuffer(row["components"], np.int64).reshape(n, row["dims"])
            labels, ids = (np.frombuffer(row[name], np.int64) for name in ("label_list", "ids"))
            if same:
                low = np.full((n, 1), np.iinfo(np.int64).min)
                high = np.full((n, 1), np.iinfo(np.int64).max)
            else:
                bands = row["bands"]
                width = 1 + max(x["band"] for x in bands)
                low, high = np.ones((n, width), np.int64), np.zeros((n, width), np.int64)  # none
                for x in bands:
                    low[x["anchor"], x["band"]] = -(-percent[0] * x["score"] // percent[1])
                    high[x["anchor"], x["band"]] = x["score"]
            best = {}
            for packed in right.to_pylist():
                theirs, their_ids = (np.frombuffer(packed[name], np.int64) for name in ("label_list", "ids"))
                nulls = np.frombuffer(packed["nulls"], bool)
                bits = np.frombuffer(packed["bits"], np.uint8).reshape(packed["planes"], packed["groups"], -1)
                bound = row["dims"] * max(int(np.abs(values).max(initial=0)), 1) << packed["planes"]
                if bound >= 1 << 62:
                    raise ValueError("components are too large for exact scores of 62 bits")
                dtype = np.int32 if bound < 1 << 30 else np.int64
                for a, b in _chunks(labels, same):
                    key = (a, b)
                    if key not in best:
                        best[key] = [_Best(low[a:b], high[a:b], most), {}]
                    kept, tables = best[key]
                    if dtype not in tables:
                        tables[dtype] = subset_sums(values[a:b], dtype)
                    lo, hi = np.searchsorted(theirs, labels[a], "left"), np.searchsorted(theirs, labels[a], "right")
                    spans = [(lo, hi)] if same else [(0, lo), (hi, len(theirs))] if labels[a] == labels[b - 1] else [(0, len(theirs))]
                    for begin, end in spans:
                        for x in range(begin, end, SLICE):
                            y = min(x + SLICE, end)
                            alike = theirs[x:y, None] == labels[a:b]
                            own = alike & (their_ids[x:y, None] != ids[a:b]) if same else ~alike
                            kept.offer(scores(tables[dtype], bits[:, :, x:y]), own, their_ids[x:y], nulls[x:y])
                    kept.reduce()
            width = low.shape[1]
            for (a, _), (kept, _) in best.items():
                query, score, no_id, found = kept.rows
                anchor = a + query // width
                out.append([np.full(len(query), row["block"]), anchor, ids[anchor], query % width, np.where(no_id, NO_ID, found), score, no_id])
        columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 7
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        arrays = [pa.array(c.astype(k.to_pandas_dtype()), k, mask=columns[6].astype(bool) if i == 4 else None) for i, (c, k) in enumerate(zip(columns, kinds, strict=False))]
        return pa.Table.from_arrays(arrays, names=["block", "anchor", "anchor_id", "band", "id", "score"])

    return run


def _chunks(labels: np.ndarray, same: bool) -> Iterator[tuple[int, int]]:
    """Ranges of up to ``AT_ONCE`` anchors; of one label, if rows of that label are wanted."""
    a = 0
    while a < len(labels):
        b = min(a + AT_ONCE, len(labels))
        if same:
            b = min(b, int(np.searchsorted(labels, labels[a], "right")))
        yield a, b
        a = b


def _ranked(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("block", "anchor", "band").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    scale: int = 256,
    positives: int = 5,
    negatives: int = 5,
    percent: tuple[int, int] = (80, 100),
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label and embedding; ``is_anchor`` is a condition on ``id``.
    ``percent[0] * positive <= percent[1] * negative <= percent[1] * positive``
    holds for every row.
    """
    rows = usable(vectors, scale)
    packed = stored(rows.mapInArrow(_pack, PACKED).withColumn("place", F.monotonically_increasing_id()), "packed")
    chosen = rows.filter(is_anchor)
    parts = max(1, -(-chosen.count() // ANCHORS))
    anchors = stored(chosen.repartition(parts).mapInArrow(_pack_anchors, ANCHOR_BLOCK), "anchors")
    salts = max(1, -(-packed.count() // BLOCKS_PER_GROUP), min(32, packed.count()))

    # every candidate block meets every anchor block, in a group of some candidate blocks
    salt = F.pmod(F.xxhash64("place"), F.lit(salts)).cast("int").alias("salt")
    theirs = packed.withColumn("salt", salt).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    theirs = theirs.groupBy("block", "salt")
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")

    ours = anchors.select("*", every).groupBy("block", "salt")
    found = ours.cogroup(theirs).applyInArrow(_scored(True, positives, percent), FOUND)
    best = _ranked(found, positives).select("block", "anchor", "anchor_id", (F.col("rank") - 1).alias("band"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    best = stored(best, "positives")

    bands = best.groupBy("block").agg(F.collect_list(F.struct("anchor", "band", F.col("positive_score").alias("score"))).alias("bands"))
    ours = anchors.join(bands, "block").select(*anchors.columns, "bands", every).groupBy("block", "salt")
    found = ours.cogroup(theirs).applyInArrow(_scored(False, negatives, percent), FOUND)
    last = _ranked(found, negatives).select("block", "anchor", "band", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return best.join(last, ["block", "anchor", "band"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
