"""Launch documents -> manifest of the image files they name.

Images are stored under the last part of their URL, so two URLs that end alike
share one file and the later one stays. The manifest says which URL each file
comes from; fetching is left to a transfer tool.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from haulage import storage
from haulage.functions import has_scheme, require, target_name
from haulage.operators import (
    assert_ready,
    distinct_count,
    field_of_each,
    last_write_wins,
    merge_latest,
    observed_metrics,
)
from haulage.schema import struct_of
from haulage.sinks import open_writers, write_parquet
from haulage.sources import read_json_documents

DOCUMENT = struct_of(results=T.ArrayType(struct_of(image=T.VariantType())))

LISTING = struct_of(
    document=struct_of(path=T.StringType(), block=T.LongType(), row=T.LongType()),
    pos=T.IntegerType(),
    url=T.StringType(),
    name=T.StringType(),
    valid=T.BooleanType(),
)


@dataclass(frozen=True)
class ManifestRun:
    """What one run wrote."""

    files: int
    valid_urls: int
    invalid_urls: int
    new_files: int = 0


def list_images(documents: DataFrame, document: str | Column) -> DataFrame:
    """``document, pos, url, name, valid`` for every launch.

    ``document`` orders the documents; ``pos`` orders the launches in one. A
    null URL, one without a scheme and one that names no file are not valid.
    A launch without the image key fails the job.
    """
    document = F.col(document) if isinstance(document, str) else document
    launches = require(F.col("results"), {"results": F.col("results")}, "launch document")
    images = field_of_each(
        documents,
        launches,
        "image",
        {"document": document},
        check=lambda launch: require(launch, {"image": launch["image"]}, "launch"),
    )
    urls = images.select("document", "pos", F.col("image").cast("string").alias("url"))
    name = target_name("url")
    return urls.select(
        "document",
        "pos",
        "url",
        name.alias("name"),
        (has_scheme("url") & name.isNotNull()).alias("valid"),
    )


def manifest(images: DataFrame) -> DataFrame:
    """``name, url``: per file name the URL that was listed last."""
    return last_write_wins(
        images.filter("valid"), "name", F.struct("document", "pos"), {"url": "url"}
    )


def file_count(images: DataFrame) -> DataFrame:
    """How many files the valid URLs make."""
    return distinct_count(images.filter("valid"), "name", "files")


def run(
    spark: SparkSession,
    documents_path: str,
    output_path: str,
    multi_line: bool = True,
    keep_earlier: bool = True,
) -> ManifestRun:
    """Write the listing of all URLs and the manifest below ``output_path``.

    The documents are parsed once, into ``listing``, split by ``valid``; the
    manifest is taken from its valid part. Documents are ordered by their path and,
    in JSON Lines, by their place in the file. The files of earlier runs stay in the manifest, as
    they do in the folder it describes; one that this run names again gets its URL. Without
    ``keep_earlier`` the manifest holds this run's files only. Listing and manifest of an
    earlier run are replaced together, and stay if this run fails.
    """
    documents = assert_ready(read_json_documents(spark, documents_path, DOCUMENT, multi_line))
    # One task reads a block from its start, so row numbers grow along the block.
    place = F.struct(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    base, valid = output_path.rstrip("/"), F.col("valid")
    with storage.replacing(spark, f"{base}/listing", f"{base}/manifest") as (listing, chosen):
        with open_writers(spark):
            counts = observed_metrics(
                list_images(documents.withColumn("document", place), "document"),
                lambda out: out.write.partitionBy("valid").parquet(listing),
                [F.count_if(valid).alias("valid"), F.count_if(~valid).alias("invalid")],
            )
        images = spark.read.schema(LISTING).parquet(listing)
        files, known = manifest(images), 0
        if keep_earlier and storage.exists(spark, f"{base}/manifest"):
            earlier = spark.read.schema(files.schema).parquet(f"{base}/manifest")
            known = earlier.count()  # read from the files' footers
            files = merge_latest(earlier, files, ["name"])
        held = write_parquet(files, chosen)
    return ManifestRun(held.rows, counts["valid"], counts["invalid"], held.rows - known)
