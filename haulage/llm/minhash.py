"""Near duplicates by bottom-k sketches from one hash function.

A document's set holds its distinct 5-word shingles (A-Z folded), hashed to 63
bits; its sketch keeps the ``k`` least values. Documents with equal sets are one
node. Inverted lists of the retained values give candidates, the k least values
of the union estimate their similarity, and full sets confirm it. A pair at 0.75
shares none of 64 retained values with probability 0.25**64.

Lists are as long as a value is common, so pairs within a list are not simply
emitted:

- lists of at most ``short`` nodes give all their pairs, whose number stays
  below ``short / 2`` for each entry;
- in a longer list every node meets the list's hub, the node with the most long
  lists, as the original of a group of copies has;
- nodes whose values mostly lie in long lists and that are still apart are compared
  by a filter on their full sets that leaves out no pair (``_apart``). No cap
  applies.

Each estimate filter keeps pairs 0.3 below the threshold (more than five standard
deviations for 64 values).

The hubs are written before they are joined to the lists, so that Spark can split that join; the
joins inside ``_apart`` and those of ``components`` bring the rows of one value into one task.

Defined results: null text, or a text without words, has an empty set, is linked
with nothing and is its own component; rows that share a doc_id are judged each by
its own text (``text_hash`` tells them apart), equal rows alike; a null doc_id links nothing, has the component of
documents with an equal set or none, and is kept; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from haulage.llm.components import components
from haulage.llm.storing import stored
from haulage.llm.words import lists, mix, sequence_hashes, words_of

SHINGLE = 5
K = 64
SHORT = 16
PERCENT = 75
MARGIN = 30


def shingle_sets(column: pa.Array, shingle: int = SHINGLE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per chunk: its number of rows, all sets' sorted hashes, where each row's begin."""
    for chunk in words_of(column, lower=True):
        n, bounds = chunk.last - chunk.first, chunk.offsets()
        hashes = sequence_hashes(chunk.hash, shingle)
        rows = chunk.row[: len(hashes)]
        inside = rows == chunk.row[shingle - 1 :] if len(hashes) else np.zeros(0, dtype=bool)
        hashes, rows = hashes[inside], rows[inside]
        counts = np.diff(bounds)
        few = np.flatnonzero((counts > 0) & (counts < shingle))
        if len(few):
            whole = [mix(sequence_hashes(chunk.hash[bounds[r] : bounds[r + 1]], int(counts[r])), int(counts[r])) for r in few]
            hashes, rows = np.concatenate([hashes, *whole]), np.concatenate([rows, few])
        hashes = hashes >> np.uint64(1)  # Spark's longs are signed; 63 bits have one order everywhere
        order = np.lexsort((hashes, rows))
        hashes, rows = hashes[order], rows[order]
        fresh = np.ones(len(rows), dtype=bool)
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
        hashes, rows = hashes[fresh], rows[fresh]
        yield n, hashes, np.searchsorted(rows, np.arange(n + 1))


def _sum_by_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, dtype=np.uint64, out=sums[1:])
    return (sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64)


def _sketches(k: int, shingle: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            at = 0
            for n, hashes, bounds in shingle_sets(batch.column(1), shingle):
                sizes = np.diff(bounds)
                rank = np.arange(len(hashes)) - np.repeat(bounds[:-1], sizes)
                offsets = np.concatenate(([0], np.cumsum(np.minimum(sizes, k))))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, n),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(_sum_by_row(mix(hashes, 11), bounds)),
                        pa.array(_sum_by_row(mix(hashes, 12), bounds)),
                        lists(hashes[rank < k], offsets, pa.int64()),
                        batch.column(2).slice(at, n),
                    ],
                    names=["doc_id", "n_shingles", "s1", "s2", "sketch", "text_hash"],
                )
                at += n

    return run


def sketches(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, size of the set, two checksums of it, its k least values in order, a hash of the text."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text, F.xxhash64(text).alias("text_hash")).mapInArrow(
        _sketches(k, shingle), "doc_id long, n_shingles long, s1 long, s2 long, sketch array<long>, text_hash long"
    )


def _full_sets(shingle: int):
    def run(batches):
        for batch in batches:
            at = 0
            for n, hashes, bounds in shingle_sets(batch.column(1), shingle):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, n), lists(hashes, bounds, pa.int64())], names=["node", "members"]
                )
                at += n

    return run


def _pair(x: Column, y: Column) -> list[Column]:
    """Two (node, n) structs as a, a_n, b, b_n with a < b."""
    first = x["node"] < y["node"]
    low, high = F.when(first, x).otherwise(y), F.when(first, y).otherwise(x)
    return [low["node"].alias("a"), low["n"].alias("a_n"), high["node"].alias("b"), high["n"].alias("b_n")]


def _alike_in_size(percent: int) -> Column:
    return 100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")


def likely(pairs: DataFrame, nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs whose sizes and union sketch do not rule out the threshold."""

    def side(name):
        return nodes.select(F.col("node").alias(name), F.col("n").alias(f"{name}_n"), F.col("sketch").alias(f"{name}_sketch"))

    joined = pairs.join(side("a"), "a").join(side("b"), "b").filter(_alike_in_size(percent))
    union = F.slice(F.array_sort(F.array_union("a_sketch", "b_sketch")), 1, k)
    shared = F.size(F.array_intersect(union, F.array_intersect("a_sketch", "b_sketch")))
    return joined.filter(100 * shared >= (percent - MARGIN) * F.size(union)).select("a", "b")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets meet the threshold, counted exactly."""
    side = lambda name: sets.select(F.col("node").alias(name), F.col("members").alias(f"{name}_set"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    both = F.size(F.array_intersect("a_set", "b_set"))
    union = F.size("a_set") + F.size("b_set") - both
    return joined.filter(100 * both.cast("long") >= percent * union.cast("long")).select("a", "b").distinct()


def _hubs(entries: DataFrame) -> DataFrame:
    """Of each list, the node in the most long lists; of several, the smallest."""
    rank = F.struct(F.col("n_long"), -F.col("node"))
    kept = F.max_by(F.struct("node", "n", *([F.col("component")] if "component" in entries.columns else [])), rank)
    return entries.groupBy("v").agg(kept.alias("hub"))


def _spokes(entries: DataFrame, hubs: DataFrame, percent: int) -> DataFrame:
    met = entries.join(hubs, "v").filter(F.col("node") != F.col("hub.node"))
    pairs = met.select(*_pair(F.struct("node", "n"), F.struct(F.col("hub.node").alias("node"), F.col("hub.n").alias("n"))))
    return pairs.filter(_alike_in_size(percent)).select("a", "b").distinct()


def _divided(placed: DataFrame) -> DataFrame:
    """The lists whose nodes lie in several components."""
    ends = placed.groupBy("v").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return ends.filter("low < high").select("v")


def _apart(half: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Every pair of nodes in different components that may be linked without a short list.

    If a linked pair shares no value of a short list, all it shares of either sketch
    lies in long lists, so these hold at least half of both. For such nodes (``half``)
    the full sets are put in one order, rarest member first. A linked pair shares a
    member among the first n - ceil(percent * n) + 1 of both, and from the first
    one they share on, enough members must be left to meet the threshold. That
    leaves no pair out; what it lets pass is near the threshold, as members of a
    group of copies are mostly unlike in their rarest members.
    """
    placed = half.join(labels, "node", "left").select("node", "n", F.coalesce("component", "node").alias("component"))
    each = placed.join(sets, "node").select("node", "n", "component", F.explode("members").alias("v"))
    often = each.groupBy("v").agg(F.count("*").alias("often"))
    ordered = F.sort_array(F.collect_list(F.struct("often", "v")))
    first = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    kept = F.slice("ordered", F.lit(1), first.cast("int"))
    ranked = each.join(often, "v").groupBy("node", "n", "component").agg(ordered.alias("ordered"))
    prefix = stored(ranked.select("node", "n", "component", F.posexplode(kept).alias("at", "m")).select("node", "n", "component", "at", "m.v"), "prefixes")
    near = prefix.join(_divided(prefix), "v")
    x, y = near.alias("x"), near.alias("y")
    left = F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))  # shared members at most
    met = x.join(
        y,
        (F.col("x.v") == F.col("y.v"))
        & (F.col("x.component") < F.col("y.component"))
        & (100 * left >= percent * (F.col("x.n") + F.col("y.n") - left)),
    )
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, k: int = K, short: int = SHORT, percent: int = PERCENT, shingle: int = SHINGLE
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and text_hash for every row of ``docs``."""
    rows = stored(sketches(docs, k, shingle), "sketches")
    key = ("n_shingles", "s1", "s2")
    sets_of_rows = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*key)
    first = F.min(F.struct("doc_id", "text_hash")).alias("first")
    named = stored(sets_of_rows.agg(first, F.first("sketch").alias("sketch")), "nodes").withColumnRenamed("n_shingles", "n")
    nodes, shared = _named(named)

    postings = nodes.select("node", "n", F.explode("sketch").alias("v"))
    sizes = postings.groupBy("v").agg(F.count("*").alias("length"), F.min("node").alias("a"), F.max("node").alias("b"))
    sizes = stored(sizes.filter("length > 1"), "list-sizes")
    two = sizes.filter("length = 2").select("a", "b")
    entries = stored(postings.join(sizes.filter("length > 2").select("v", "length"), "v"), "entries")
    members = F.array_sort(F.collect_list(F.struct("node", "n")))  # at most ``short`` of them
    listed = entries.filter(F.col("length") <= short).groupBy("v").agg(members.alias("m"))
    few = (
        listed.select("m", F.explode("m").alias("x"))
        .select("x", F.explode(F.filter("m", lambda y: y["node"] > F.col("x.node"))).alias("y"))
        .select(*_pair(F.col("x"), F.col("y")))
        .filter(_alike_in_size(percent))
        .select("a", "b")
    )
    long_entries = entries.filter(F.col("length") > short)
    n_long = long_entries.groupBy("node").agg(F.count("*").alias("n_long"))
    long_entries = stored(long_entries.join(n_long, "node"), "long-lists")
    spokes = _spokes(long_entries, stored(_hubs(long_entries), "hubs"), percent)
    candidates = stored(likely(two.unionAll(few).unionAll(spokes).distinct(), nodes, k, percent), "candidates")

    mostly_long = nodes.join(n_long, "node").filter(2 * F.col("n_long") >= F.size("sketch"))
    half = stored(mostly_long.select("node", "n"), "mostly-long")
    wanted = candidates.select(F.col("a").alias("node")).unionAll(candidates.select("b")).unionAll(half.select("node"))
    firsts = nodes.join(wanted.distinct(), "node", "left_semi").select("node", "first.*")
    firsts = firsts.withColumnsRenamed({"doc_id": "first_id", "text_hash": "first_hash"})
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    text = text.withColumn("text_hash", F.xxhash64("text"))
    same = (F.col("doc_id") == F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))
    # hashed by id, so texts are not sorted
    texts = text.join(firsts.hint("shuffle_hash"), same).select("node", "text")
    if not rows.groupBy("doc_id", "text_hash").count().filter("count > 1 AND doc_id IS NOT NULL").isEmpty():
        texts = texts.dropDuplicates(["node"])  # equal rows give one set
    sets = stored(texts.mapInArrow(_full_sets(shingle), "node long, members array<long>"), "sets")
    links = stored(confirmed(candidates, sets, percent), "confirmed")
    labels = components(links)

    if not half.isEmpty():
        more = stored(likely(_apart(half, labels, sets, percent), nodes, k, percent), "apart")
        found = stored(confirmed(more, sets, percent), "confirmed")
        if not found.isEmpty():
            labels = components(links.unionAll(found))

    own = nodes.select("n", "s1", "s2", "node", F.col("first.doc_id").alias("first_id")).join(labels, "node", "left")
    own = own.withColumn("component", F.coalesce("component", "node"))
    if shared:  # a component is named by its smallest doc_id, not by a node's own name
        least = stored(own.groupBy("component").agg(F.min("first_id").alias("least")), "least-ids")
        own = own.join(least, "component").withColumn("component", F.col("least"))
    component = own.select(F.col("n").alias("n_shingles"), "s1", "s2", "component")
    placed = rows.select("doc_id", "text_hash", *key).join(component, list(key), "left")
    return _finish(placed)


def _named(sets: DataFrame) -> tuple[DataFrame, bool]:
    """Sets with ``node``, a number of their own, and whether some share their first doc_id.

    A node is its set's smallest doc_id. Of unlike sets with one such id, all but one are
    named by a hash of the set.
    """
    nodes = sets.withColumn("node", F.col("first.doc_id"))
    kept = nodes.groupBy("node").agg(F.min(F.struct("n", "s1", "s2")).alias("kept"), F.count("*").alias("sets"))
    shared = stored(kept.filter("sets > 1").select(F.col("node").alias("shared_id"), "kept"), "shared-ids")
    if shared.isEmpty():
        return nodes, False
    joined = nodes.join(shared, F.col("node") == F.col("shared_id"), "left")
    other = F.col("kept").isNotNull() & (F.struct("n", "s1", "s2") != F.col("kept"))
    named = joined.withColumn("node", F.when(other, F.xxhash64("n", "s1", "s2")).otherwise(F.col("node")))
    return stored(named.select(*nodes.columns), "named-sets"), True


def _finish(placed: DataFrame) -> DataFrame:
    """A row per document with its component; an unlinked one is its own."""
    found = F.coalesce("component", "doc_id")
    alone = F.col("doc_id").isNull()
    return placed.select(
        "doc_id",
        "n_shingles",
        F.when(~alone, found).alias("component_id"),
        (alone | (F.col("doc_id") == found)).alias("kept"),
        "text_hash",
    )
