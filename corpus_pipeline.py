"""A corpus in five stages: no toxic texts, no near copies, no benchmark items, mixed, tokenized.

``STAGES`` lists (name, function). Each function takes (spark, docs, sf_dir), with
docs as the stage before wrote them, and returns a DataFrame; all but the last
return the columns of documents. Nulls, repeated rows and empty tables have the
results that the operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from haulage.llm import leaks, minhash, mixing, tokens, toxicity
from haulage.llm.queries import table, tokenizer_path
from haulage.llm.storing import stored
from haulage.session import scratch_dir

#: Trained models and sketches have no SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, calibrated by language, doesn't reject."""
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; of equal rows, one.

    Rows that share a doc_id are judged each by its own text. Documents without a doc_id
    can't be told apart by it: equal rows among them become one, near copies stay.
    """
    copies = minhash.near_duplicates(docs).filter("NOT kept")
    copies = copies.select(F.col("doc_id").alias("copy_id"), F.col("text_hash").alias("copy_hash")).distinct()
    same = (docs["doc_id"].cast("long") == F.col("copy_id")) & (F.xxhash64(docs["text"].cast("string")) == F.col("copy_hash"))
    return docs.join(copies, same, "left_anti").select(*docs.columns).dropDuplicates(["doc_id", "text"])


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return leaks.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, as rows of their own."""
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files, read back: place, length and checksum of each document's ids."""
    path = scratch_dir(spark, "corpus-tokens")
    tokens.write_tokens(docs, path, tokenizer_path())
    return tokens.doc_digests(tokens.read_segments(spark, path))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("benchmark", drop_leaks),
    ("mixing", mix_sources),
    ("tokens", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
