"""Secrets in text, with false findings removed by a random forest.

A candidate is a run of 16 or more key-like characters with a digit among them, or
a value given to a name such as ``password``, also with white space around the
sign. A token gives as many as it holds. For each the forest
sees its length, shares of characters, transitions between their kinds, the
share of its letters that are words of the corpus, whether it stands in a path
or URL, and the words before and after. It does not see the rules that label.

The forest is Spark's own, fitted on at most ``max_findings`` labelled findings in
an order fixed by a hash. ``weak_labels`` labels findings where none were labelled
by hand: well-known key formats and values given to a credential's name are
true, paths, plain numbers and dictionary text are false, others are unlabelled.

Everything is DataFrame functions: no Python runs on executors.

Defined results: null or empty text has no candidates; a token is one finding
however often its document repeats it at other places (each place is a row);
null doc_id is kept; without labelled findings of both kinds every candidate
with a weak label keeps that label's probability, others 0.5; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from haulage.llm.storing import stored
from haulage.session import scratch_dir

SEPARATOR = r"[\x20\x09-\x0D]+"
#: Matched from the beginning of a run only, so a long run is read once.
LONG = r"(?<![A-Za-z0-9+/_\-])(?=[A-Za-z+/_\-]*+[0-9])[A-Za-z0-9+/_\-]{16,}+"
NAME = r"(?i:password|passwd|pwd|secret|token|api_?key|access_?key)[\"']?"
VALUE = r"[\"']?[^\s\"',;]{6,}?(?=&[A-Za-z_]+=|[\s\"',;]|$)"
NAMED = f"{NAME}[=:]+{VALUE}"
CANDIDATE = f"{LONG}|{NAMED}"
SPACED = f"{LONG}|{NAME}[\\x20\\x09-\\x0D]*[=:]+[\\x20\\x09-\\x0D]*{VALUE}"
MATCH = f"{NAMED}|(?:\\b[A-Za-z_]+[\"']?[=:]+[\"']?)?{LONG}"
GIVEN = r"^[\"']?[A-Za-z_]*[\"']?[=:]+[\"']?([^\s\"',;]{6,})"
CREDENTIAL = r"(?i)password|passwd|pwd|secret|token|api_?key|access_?key|credential|auth"
OTHER_WORD = r"(?i)commit|sha|hash|uuid|guid|phone|tel|isbn|order|invoice|version|build|license"
KNOWN_FORMAT = r"^(?:AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^sk-[A-Za-z0-9]{20,}$"
MAX_FINDINGS = 20_000
TREES, DEPTH = 24, 6
MIN_WORD_DOCS = 3
FEATURES = (
    "length", "digits", "capitals", "small", "others", "kinds", "transitions", "distinct",
    "hexadecimal", "coverage", "in_path", "in_url", "named_before", "other_before", "assigned", "quoted", "words_around",
)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, place (word number from 1), token, value, before, after; a row per match.

    Of a token with several matches each has its own part as ``token``, but addresses
    stay whole.
    """
    text = F.col("text").cast("string")
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).filter(F.col("text").rlike(SPACED))
    split = some.select("doc_id", F.split("text", SEPARATOR).alias("t"))
    word = lambda i: F.coalesce(F.get("t", i - 1), F.lit(""))

    def named(i):
        """The name, and the sign, that words before give to a word."""
        name = lambda c: F.regexp_extract(c, f"({NAME})$", 1)
        signed = F.regexp_extract(word(i - 1), f"({NAME}[=:]+)$", 1)
        lone = F.when((name(word(i - 2)) != "") & word(i - 1).rlike("^[=:]+$"), F.concat(name(word(i - 2)), word(i - 1)))
        opened = F.when(word(i).rlike("^[=:]"), name(word(i - 1)))
        return F.coalesce(F.when(signed != "", signed), lone, opened, F.lit(""))

    places = F.filter(F.sequence(F.lit(1), F.size("t")), lambda i: F.concat(named(i), word(i)).rlike(CANDIDATE))
    near = lambda shift: word(F.col("place") + shift)
    each = split.withColumn("place", F.explode(places)).select(
        "doc_id",
        F.col("place").cast("long").alias("place"),
        near(0).alias("whole"),
        named(F.col("place")).alias("name"),
        F.concat_ws(" ", near(-3), near(-2), near(-1)).alias("before"),
        F.concat_ws(" ", near(1), near(2)).alias("after"),
    )
    found = each.withColumn("parts", F.regexp_extract_all(F.concat("name", "whole"), F.lit(MATCH), 0))
    found = found.withColumn("n_parts", F.size("parts")).withColumn("part", F.explode("parts"))
    alone = (F.col("n_parts") == 1) | F.col("whole").rlike(r"://|www\.")
    token = F.when(alone, F.col("whole")).otherwise(F.col("part"))
    of_name = F.regexp_extract("part", f"^{NAME}[=:]+[\"']?(.+)$", 1)
    given = F.regexp_extract(F.when(F.col("n_parts") == 1, F.col("whole")).otherwise(F.col("part")), GIVEN, 1)
    long = F.regexp_extract("part", f"({LONG})", 1)
    value = F.when(of_name != "", of_name).when(given != "", given).when(long != "", long).otherwise(F.col("part"))
    return found.select("doc_id", "place", token.alias("token"), "before", "after", value.alias("value"))


def dictionary(docs: DataFrame, min_docs: int = MIN_WORD_DOCS) -> DataFrame:
    """Lower-case words of 3 to 20 letters that several documents have."""
    words = F.array_distinct(F.split(F.lower(F.col("text").cast("string")), r"[^a-z]+"))
    each = docs.select(F.explode(F.filter(words, lambda w: F.length(w).between(3, 20))).alias("word"))
    return each.groupBy("word").agg(F.count("*").alias("docs")).filter(F.col("docs") >= min_docs).select("word")


def _count(column: str, pattern: str) -> Column:
    return F.regexp_count(F.col(column), F.lit(pattern)).cast("double")


def described(found: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates with the forest's features."""
    runs = F.filter(F.split(F.lower("value"), "[^a-z]+"), lambda w: F.length(w) >= 3)
    each = found.select("value").distinct().select("value", F.explode(runs).alias("word"))
    known = each.join(words, "word").groupBy("value").agg(F.sum(F.length("word")).alias("known"))
    n = F.length("value").cast("double")
    share = lambda pattern: _count("value", pattern) / n
    context = F.concat_ws(" ", "before", F.regexp_extract("token", r"^([\"']?[A-Za-z_]*[\"']?[=:])", 1))
    changes = r"(?<=[0-9])(?=[^0-9])|(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[^0-9a-zA-Z])(?=[0-9a-zA-Z])"
    flag = lambda c: c.cast("double")
    return (
        found.join(known, "value", "left")
        .withColumn("length", n)
        .withColumn("digits", share("[0-9]"))
        .withColumn("capitals", share("[A-Z]"))
        .withColumn("small", share("[a-z]"))
        .withColumn("others", share("[^0-9A-Za-z]"))
        .withColumn("kinds", sum((flag(_count("value", p) > 0) for p in ("[0-9]", "[A-Z]", "[a-z]", "[^0-9A-Za-z]")), F.lit(0.0)))
        .withColumn("transitions", _count("value", changes) / n)
        .withColumn("distinct", F.size(F.array_distinct(F.split("value", ""))).cast("double") / n)
        .withColumn("hexadecimal", flag(F.col("value").rlike("^[0-9a-fA-F]+$")))
        .withColumn("coverage", F.coalesce(F.col("known"), F.lit(0)) / F.greatest(_count("value", "[A-Za-z]"), F.lit(1.0)))
        .withColumn("in_path", _count("token", r"[/\\]"))
        .withColumn("in_url", flag(F.col("token").rlike(r"://|www\.|@")))
        .withColumn("named_before", flag(context.rlike(CREDENTIAL)))
        .withColumn("other_before", flag(context.rlike(OTHER_WORD)))
        .withColumn("assigned", flag(context.rlike(r"[=:][\"']?\s*$")))
        .withColumn("quoted", flag(F.col("token").rlike("^[\"'].*[\"'][,;.]?$")))
        .withColumn("words_around", _count("before", r"\b[a-z]{3,}\b") + _count("after", r"\b[a-z]{3,}\b"))
        .drop("known")
    )


def weak_labels(findings: DataFrame) -> DataFrame:
    """Findings with ``label``: 1, 0 or null, by format and place."""
    true = F.col("value").rlike(KNOWN_FORMAT) | ((F.col("named_before") == 1) & (F.col("assigned") == 1) & (F.col("coverage") < 0.5))
    plain = F.col("value").rlike(r"^[0-9+\-_/]*$") | (F.col("in_url") == 1) | (F.col("in_path") > 0) | (F.col("coverage") > 0.6)
    uuid = F.col("value").rlike("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")
    return findings.withColumn("label", F.when(true, 1).when(plain | uuid, 0))


def judged(labelled: DataFrame, max_findings: int = MAX_FINDINGS) -> DataFrame:
    """Findings with ``probability`` and ``secret``, by a forest fitted to those with labels.

    ``labelled`` has the features and ``label`` (1, 0, or null where unknown).
    """
    order = F.md5(F.concat_ws(":", F.lit("forest"), "value", "before").cast("binary"))
    known = labelled.filter("label IS NOT NULL").select(*FEATURES, F.col("label").cast("double").alias("label"), order.alias("order"))
    sample = stored(known.orderBy("order").limit(max_findings), "findings-sample").coalesce(4)
    kinds = sample.select("label").distinct().count()
    if kinds < 2:
        chance = F.coalesce(F.col("label").cast("double"), F.lit(0.5))
        return labelled.withColumn("probability", chance).withColumn("secret", chance >= 0.5)
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=10, featuresCol="features", labelCol="label")
    path = scratch_dir(labelled.sparkSession, "forest")
    forest.fit(assembler.transform(sample)).save(path)
    # a fitted model holds its session, which can't go to tasks once it has observed metrics
    model = RandomForestClassificationModel.load(path)
    scored = model.transform(assembler.transform(labelled))
    chance = vector_to_array("probability")[1]
    return scored.select(*labelled.columns, chance.alias("probability")).withColumn("secret", F.col("probability") >= 0.5)


def find_secrets(docs: DataFrame, max_findings: int = MAX_FINDINGS) -> DataFrame:
    """doc_id, place, value, probability, secret for every candidate of every document."""
    taken = stored(candidates(docs), "candidates")  # used twice
    found = stored(described(taken, dictionary(docs)), "findings")
    return judged(weak_labels(found), max_findings).select("doc_id", "place", "value", "label", "probability", "secret")
