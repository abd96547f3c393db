"""Mix sources to target weights by repeating documents.

Sizes are summed per source, targets are levelled so that no source is repeated
more than ``max_repeats`` times, and each document is emitted floor(rate) times
plus once more with the probability of the fraction. The coin is a hash of the
document's id and a seed, so a rerun, or a retried task, gives the same mix.

Defined results:

- null text has size 0; a source without words has target 0 and is not emitted;
- null source is a source of its own, the last in order;
- rows that share a doc_id share the coin, and rows without one share it with equal texts, so
  repeated rows are taken or left together;
- an empty table gives an empty table; other columns pass through. A table that has a
  helper column's name (``HELPERS``) is refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from haulage.llm.storing import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
HELPERS = ("mix_source", "mix_size", "mix_source_size", "mix_target", "mix_copies", "mix_copy")


def word_count(text: str | Column) -> Column:
    """Words of a text; null has none."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """Targets per source from rows (mix_source, mix_size).

    The total is shared by weight; a source stops at ``max_repeats`` times its
    size and the rest is shared again, until none is above. Sources sorted by
    the level at which they stop are capped exactly as long as the level left
    for the others lies above. That level rises while capped sources are taken
    out and falls from the first open one on, where it is largest.
    The windows see one row per source, never the documents.
    """
    totals = sizes.groupBy("mix_source").agg(F.sum("mix_size").alias("mix_source_size"))
    position = F.row_number().over(Window.orderBy(F.col("mix_source").asc_nulls_last()))
    cycle = F.array(*map(F.lit, weights))
    ranked = totals.withColumn("position", position).select(
        "mix_source",
        "mix_source_size",
        F.element_at(cycle, ((F.col("position") - 1) % len(weights) + 1).cast("int")).alias("weight"),
    )
    everything = Window.partitionBy()
    by_stop = Window.orderBy("stop", F.col("mix_source").asc_nulls_last())
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_stop.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    sized = ranked.withColumn("most", F.col("mix_source_size") * max_repeats)
    levels = (
        sized.withColumn("stop", F.col("most") / F.col("weight"))
        .withColumn("total", F.sum("mix_source_size").over(everything))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0)))
        .withColumn("level", F.col("left") / F.sum("weight").over(onwards))
        .withColumn("open_level", F.max(F.when(F.col("stop") > F.col("level"), F.col("level"))).over(everything))
    )
    target = F.when(
        F.col("open_level").isNull() | (F.col("stop") <= F.col("open_level")), F.col("most").cast("double")
    ).otherwise(F.col("weight") * F.col("open_level"))
    return levels.select("mix_source", "mix_source_size", target.alias("mix_target"))


def coin(doc_id: str, seed: int, text: str = "text") -> Column:
    """A number in [0, 1) fixed by the id (the text, where there is none) and the seed: 52 bits of a digest."""
    no_id = F.concat(F.lit("text:"), F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")))
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), no_id))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def with_copies(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    seed: int = 1,
) -> DataFrame:
    """Documents with mix_size, mix_source_size, mix_target and mix_copies.

    The table of sources is written first, so its size is known when the join
    is planned: a small one is broadcast, a large one is joined by a shuffle
    whose hot sources are split at run time.
    """
    taken = sorted({name.lower() for name in docs.columns} & set(HELPERS))
    if taken:
        raise ValueError(f"the table has columns named {', '.join(taken)}")
    sized = docs.withColumn("mix_size", word_count("text"))
    targets = stored(
        source_targets(sized.select(F.col("source").alias("mix_source"), "mix_size"), weights, max_repeats),
        "mix-targets",
    )
    rate = F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(F.lit(0.0))
    extra = (coin("doc_id", seed) < rate - F.floor(rate)).cast("long")
    return (
        sized.join(targets, F.col("source").eqNullSafe(F.col("mix_source")), "left")
        .withColumn("mix_copies", F.floor(rate) + extra)
        .drop("mix_source")
    )


def numbered(planned: DataFrame) -> DataFrame:
    """Each document with ``mix_copy`` 0, for itself, and 1, 2, ... for its copies in the mix."""
    return planned.withColumn("mix_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("mix_copies"))))


def emit(planned: DataFrame) -> DataFrame:
    """Each document as often as planned; ``mix_copy`` counts its copies from 1."""
    return numbered(planned).filter("mix_copy > 0")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents, with the columns of ``docs``."""
    return emit(with_copies(docs, **options)).select(*docs.columns)
