"""Token ids in files of fixed-width bits.

Each id takes the fewest bits that hold the vocabulary. A file row is a segment:
whole documents in order, their ids packed one after another (least bit first),
where each document begins, and the byte at which every block of ``BLOCK`` ids
begins, so any range of ids is unpacked by numpy without reading what stands
before. Segments are rows of Parquet files below the shared folder; Spark's
commit makes a retried task harmless.

Documents are range-partitioned by doc_id. A segment knows its place in its
partition; adding the totals of earlier partitions (one row each) gives the
place in the whole corpus.

Defined results: null text is empty and gives the end id alone; null doc_id
comes first; rows that share a doc_id stand together, ordered by a hash of the
text, then the text; an empty table gives no segments; other columns are not
read. Texts are tokenized whole, as the tokenizer file says: a control string that it lists
gives that token's id.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

BLOCK = 4096
SEGMENT_IDS = 1 << 20
BYTES_AT_ONCE = 8 << 20
PIECES_IN_LINE = 64

SEGMENT = (
    "shard int, segment int, segment_start long, n_ids long, bits int, block_offsets array<long>, "
    "doc_ids array<long>, doc_starts array<long>, payload binary"
)


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as fixed-width bits, least bit first. Each block begins on a whole byte."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    out = []
    for at in range(0, len(ids), BLOCK):
        rows = np.unpackbits(ids[at : at + BLOCK].view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
        out.append(np.packbits(rows[:, :bits].ravel(), bitorder="little").tobytes())
    return b"".join(out)


def block_offsets(n_ids: int, bits: int) -> list[int]:
    """The byte at which each block begins, and where the last ends."""
    full, rest = divmod(n_ids, BLOCK)
    size = BLOCK * bits // 8
    return [i * size for i in range(full + 1)] + ([full * size + (rest * bits + 7) // 8] if rest else [])


def unpack(payload: bytes, offsets, bits: int, n_ids: int, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a segment; only their blocks are read."""
    stop = n_ids if stop is None else min(stop, n_ids)
    if stop <= start:
        return np.zeros(0, dtype=np.uint32)
    first, last = start // BLOCK, (stop - 1) // BLOCK
    raw = np.frombuffer(payload, np.uint8)[offsets[first] : offsets[last + 1]]
    if bits in (8, 16, 32):
        ids = raw.view(f"<u{bits // 8}").astype(np.uint32)
    else:
        size, parts = BLOCK * bits // 8, []
        for block in range(first, last + 1):
            n = min(BLOCK, n_ids - block * BLOCK)
            begin = (block - first) * size
            flags = np.unpackbits(raw[begin : begin + (n * bits + 7) // 8], count=n * bits, bitorder="little")
            rows = np.zeros((n, 32), dtype=np.uint8)
            rows[:, :bits] = flags.reshape(n, bits)
            parts.append(np.packbits(rows, axis=1, bitorder="little").view("<u4").ravel())
        ids = np.concatenate(parts)
    return ids[start - first * BLOCK : stop - first * BLOCK]


class Encoder:
    """A tokenizer file.

    A byte-level tokenizer never joins a space to what stands before it, nor a line break to
    anything visible, so a text falls into pieces before each single space or line break and
    pieces are encoded apart, once for all the texts of a call. Texts where these meet other
    white space are cut only between visible characters.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        if hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)  # a piece is encoded once a call
        marks = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not (t.lstrip or t.rstrip)}
        #: A control string of the tokenizer, before which and after which texts are encoded apart.
        self.mark, self.mark_id = next(iter(marks.items()), (None, None))

    _cut = re.compile(r"(?<=\S)(?=[ \n]\S)")
    _blank_inside = re.compile(r".\s", re.DOTALL)

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece; all pieces are one call, between control strings."""
        if self.mark and len(pieces) > 1:
            line = self.mark.join(pieces)
            if line.count(self.mark) == len(pieces) - 1:
                (made,) = self.tokenizer.encode_batch_fast([line], add_special_tokens=False)
                ids = np.array(made.ids, dtype=np.uint32)
                cuts = 4 * np.flatnonzero(ids == self.mark_id)
                raw = ids.tobytes()
                begins, ends = [0, *(cuts + 4).tolist()], [*cuts.tolist(), len(raw)]
                return [raw[a:b] for a, b in zip(begins, ends, strict=True)]
        made = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in made]

    @cached_property
    def _token_bytes(self) -> np.ndarray:
        """How many bytes of text each id stands for: a character of a byte-level token is one."""
        added = self.tokenizer.get_added_tokens_decoder()
        named = self.tokenizer.get_vocab(with_added_tokens=True)
        sizes = np.zeros(max(named.values()) + 1, dtype=np.int64)
        for token, i in named.items():
            sizes[i] = len(token.encode()) if i in added else len(token)
        return sizes

    def _ids_in_lines(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces, and how many each has.

        The pieces begin with a space or line break before something visible, and end with
        something visible: many are one line, and the bytes that each id stands for tell where a
        piece ends. If they don't, the pieces are encoded one by one.
        """
        if not len(pieces):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        bounds = np.append(np.arange(0, len(pieces), PIECES_IN_LINE), len(pieces))
        lines = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pieces), pa.scalar("", pieces.type))
        made = self.tokenizer.encode_batch_fast(lines.to_pylist(), add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(x.ids for x in made), np.uint32)
        ends, wanted = np.cumsum(self._token_bytes[ids]), np.cumsum(pc.binary_length(pieces).to_numpy())
        cuts = np.searchsorted(ends, wanted)
        if cuts[-1] == len(ids) - 1 and np.array_equal(ends[cuts], wanted):
            return ids, np.diff(cuts, prepend=-1)
        apart = self._ids(pieces.to_pylist())
        return np.frombuffer(b"".join(apart), dtype=np.uint32), _sizes(apart)

    def encode(self, texts: pa.Array) -> list[bytes]:
        """32-bit ids of each text, in this machine's byte order.

        Arrow splits all texts and numbers their distinct pieces, so a piece is encoded once
        however often it stands in them; numpy puts the ids of the pieces in order.
        """
        # a line break begins a piece as a space does, but belongs to it
        split = pc.split_pattern(pc.replace_substring(texts.cast(pa.large_string()), "\n", " \n"), " ")
        offsets = np.asarray(split.offsets)
        pieces = split.flatten().dictionary_encode()
        words, order = pieces.dictionary, pieces.indices.to_numpy().astype(np.int64)
        heads = offsets[:-1]
        first = words.take(pa.array(order[heads])).to_pylist()
        # from here on, a text's first piece is an entry of its own, odd if a space follows its end
        order[heads] = len(words) + np.arange(len(texts))
        followed = np.diff(offsets) > 1
        odd_word = pc.match_substring_regex(words, _ODD_PIECE).to_numpy(zero_copy_only=False)
        odd = np.concatenate((odd_word, followed & np.array([_open(x) for x in first], dtype=bool)))
        odd_text = np.add.reduceat(odd[order].astype(np.int64), heads) > 0 if len(texts) else np.zeros(0, bool)
        used = np.bincount(order, minlength=len(odd))[: len(words)] > 0
        asked = words.filter(pa.array(used & ~odd_word))
        spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), asked, pa.scalar(" ", pa.large_string()))
        ids, counts = self._ids_in_lines(pc.if_else(pc.starts_with(asked, "\n"), asked, spaced))
        made = self._ids(first)
        sizes = np.zeros(len(odd), dtype=np.int64)
        sizes[np.flatnonzero(used & ~odd_word)] = counts
        sizes[len(words) :] = _sizes(made)
        out = _joined(np.concatenate((ids, np.frombuffer(b"".join(made), dtype=np.uint32))), sizes, order, offsets)
        rest = np.flatnonzero(odd_text)
        for n, made_apart in zip(rest.tolist(), self._encode_odd(texts.take(pa.array(rest)).to_pylist()), strict=True):
            out[n] = made_apart
        return out

    def _encode_odd(self, texts: list[str]) -> list[bytes]:
        """Texts where a space meets other white space."""
        cut = [self._cut.split(text) for text in texts]
        plain = list({x for _, *pieces in cut for x in pieces if not self._blank_inside.search(x)})
        ids, counts = self._ids_in_lines(pa.array(plain, pa.large_string()))
        raw, ends = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
        known = {x: raw[a:b] for x, a, b in zip(plain, [0, *ends[:-1]], ends, strict=True)} if plain else {}
        rest = iter(self._ids([x for head, *pieces in cut for x in (head, *(x for x in pieces if x not in known))]))
        return [b"".join([next(rest), *(known[x] if x in known else next(rest) for x in pieces)]) for _, *pieces in cut]


#: A piece that is empty, or has white space of any script at an end (a line break before
#: something visible is none).
_BLANK = r"[\t\x0b\f\r \x1c-\x1f\x{85}\p{Z}]"
_ODD_PIECE = rf"^$|^\n?{_BLANK}|(?:{_BLANK}|\n)$"


def _sizes(entries: list[bytes]) -> np.ndarray:
    return np.fromiter(map(len, entries), np.int64, len(entries)) // 4


def _joined(ids: np.ndarray, sizes: np.ndarray, order: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """Per text, the ids of its entries one after another; ``ids`` has those of all entries."""
    begins = np.cumsum(sizes) - sizes
    each = sizes[order]
    ends = np.cumsum(each)
    places = np.repeat(begins[order] - (ends - each), each) + np.arange(int(each.sum()))
    raw = ids[places].tobytes()
    bounds = 4 * np.concatenate(([0], ends))[offsets]
    return [raw[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def _open(piece: str) -> bool:
    """Whether a space after this piece meets white space, or the text's beginning."""
    return piece == "" or piece[-1].isspace()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process, kept between its tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _parts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Where to cut texts so that a part has ``BYTES_AT_ONCE`` or little more."""
    if len(texts):
        ends = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
        cuts = np.flatnonzero(np.diff(ends // BYTES_AT_ONCE)) + 1
        yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)], strict=True)


def _segments(tokenizer: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        coder, shard = encoder(tokenizer), TaskContext.get().partitionId()
        bits, end = bits_for(coder.vocabulary), array("I", [end_id]).tobytes()
        held: list[tuple[int | None, bytes]] = []
        state = {"segment": 0, "start": 0}

        def flush():
            lengths = np.array([len(x) // 4 for _, x in held], dtype=np.int64)
            ids = np.frombuffer(b"".join(x for _, x in held), dtype=np.uint32)
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
            row = [shard, state["segment"], state["start"], len(ids), bits, block_offsets(len(ids), bits), [d for d, _ in held], starts.tolist(), pack(ids, bits)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            state["segment"] += 1
            state["start"] += len(ids)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=[x.split()[0] for x in SEGMENT.split(", ")])

        size = 0
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), pc.fill_null(batch.column(1), "")
            for begin, stop in _parts(texts):
                for doc_id, made in zip(ids[begin:stop], coder.encode(texts.slice(begin, stop - begin)), strict=True):
                    held.append((doc_id, made + end))
                    size += len(made) // 4 + 1
                    if size >= SEGMENT_IDS:
                        yield flush()
                        size = 0
        if held:
            yield flush()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Encode every text and write the segments, in ascending doc_id order."""
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "text")
        .select("doc_id", "text")
    )
    ordered.mapInArrow(_segments(tokenizer, end_id), SEGMENT).write.parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments, with ``start``: the ids of all segments before, in the whole corpus."""
    segments = spark.read.schema(SEGMENT).parquet(path)
    totals = segments.groupBy("shard").agg(F.sum("n_ids").alias("shard_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offsets = totals.select("shard", F.coalesce(F.sum("shard_ids").over(before), F.lit(0)).alias("shard_start"))
    # as many rows as the writing stage had partitions, so broadcasting them is bounded
    return segments.join(F.broadcast(offsets), "shard").withColumn("start", F.col("shard_start") + F.col("segment_start"))


DOC_DIGEST = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _doc_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(row["payload"], row["block_offsets"], row["bits"], row["n_ids"])
            begins = np.array(row["doc_starts"], dtype=np.int64)
            ends = np.append(begins[1:], row["n_ids"])
            raw = ids.astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(begins + row["start"]),
                    pa.array(ends - begins),
                    pa.array([zlib.crc32(raw[a:b]) for a, b in zip(begins, ends, strict=True)], pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def doc_digests(segments: DataFrame) -> DataFrame:
    """Per document, its place, its number of ids and their checksum, from the files."""
    columns = ("payload", "block_offsets", "bits", "n_ids", "doc_ids", "doc_starts", "start")
    return segments.select(*columns).mapInArrow(_doc_digests, DOC_DIGEST)


def read_ids(spark: SparkSession, path: str, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of the corpus; only segments that hold some are read."""
    segments = read_segments(spark, path)
    end = F.col("start") + F.col("n_ids")
    rows = segments.filter((end > start) & (F.col("start") < stop)).orderBy("start").collect()
    parts = [
        unpack(r.payload, r.block_offsets, r.bits, r.n_ids, max(0, start - r.start), stop - r.start) for r in rows
    ]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32)
